"""Names, numbers and timestamps as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of a run's file name, <dataset>_<task>_<model>[_metrics](_results.json|.csv);
# only the model may contain an underscore. Spark writes a folder of that name with part files.
RUN_FILE = r"(?:^|[/=])([^_/=]+)_([^_/=]+)_([^/]+?)(?:_metrics)?(?:_results\.json|\.csv)(?:/part-[^/]*)?$"
MISSING = "N/A"


def run_of_path(path: Column) -> dict[str, Column]:
    """dataset, task and model of a log or result file; ``unknown`` where the name has too few parts."""
    # only the last two names can match; a long path would be searched from each of its folders, for every row
    tail = F.substring_index(path, "/", -2)
    found = F.regexp_extract(tail, RUN_FILE, 1) != ""

    def part(i: int) -> Column:
        return F.when(found, F.regexp_extract(tail, RUN_FILE, i)).otherwise(F.lit("unknown"))

    return {"dataset": part(1), "task": part(2), "model": part(3)}


def number(x: Column) -> Column:
    """Lenient parse: anything that is not a number is null."""
    return x.try_cast("double")


def four_places(x: Column) -> Column:
    return with_places(x, 4)


def with_places(x: Column, places: int) -> Column:
    return F.when(x.isNotNull(), F.format_string(f"%.{places}f", x)).otherwise(F.lit(MISSING))


def thousands(x: Column) -> Column:
    return F.format_number(x, 0)


def topic_name(prefix: str, dataset: Column) -> Column:
    return F.concat(F.lit(prefix), dataset)


def run_file_name(dataset: Column, task: Column, model: Column, suffix: str) -> Column:
    return F.concat(F.concat_ws("_", dataset, task, model), F.lit(suffix))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def shift_type(shift: Column) -> Column:
    """``decrease`` for a negative shift; null counts as increase."""
    return F.when(shift < 0, F.lit("decrease")).otherwise(F.lit("increase"))
