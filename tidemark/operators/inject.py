"""Concept-drift injection on labelled instances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL_DRIFT_POINT = 20000
TARGET_DRIFT_POINT = 8000


def _after(order: str, point: int, inject: bool) -> Column:
    return F.lit(inject) & (F.col(order) >= point)


def inject_label_swap(
    df: DataFrame, drift_point: int = LABEL_DRIFT_POINT, inject: bool = True, label: str = "label", order: str = "instance_id"
) -> DataFrame:
    """From ``drift_point`` on, swap the labels 0 and 1; other labels stay."""
    after = _after(order, drift_point, inject)
    swapped = F.when(after & F.col(label).isin(0, 1), 1 - F.col(label)).otherwise(F.col(label))
    return df.withColumns({label: swapped, "drift_injected": after})


def inject_target_scale(
    df: DataFrame,
    drift_point: int = TARGET_DRIFT_POINT,
    factor: float = 2.0,
    inject: bool = True,
    target: str = "target",
    order: str = "instance_id",
) -> DataFrame:
    """From ``drift_point`` on, multiply the target."""
    after = _after(order, drift_point, inject)
    return df.withColumns(
        {target: F.when(after, F.col(target) * factor).otherwise(F.col(target)), "drift_injected": after}
    )


def detection_delay(
    runs: DataFrame, events: DataFrame, keys: list[str], drift_point: int, order: str = "instance_id"
) -> DataFrame:
    """Delay of the first alarm at or after the injected point, and the number of alarms before it.

    One row for each of ``runs`` (rows that carry the keys); a run that was never alarmed has a null delay.
    """
    found = events.groupBy(*keys).agg(
        (F.min(F.when(F.col(order) >= drift_point, F.col(order))) - drift_point).alias("detection_delay"),
        F.count_if(F.col(order) < drift_point).alias("false_alarms"),
        F.count(F.lit(1)).alias("alarms"),
    )
    return runs.select(*keys).distinct().join(found, keys, "left").fillna(0, ["false_alarms", "alarms"])
