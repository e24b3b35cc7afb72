"""Run registered queries against DuckDB: ``python tests/check_oracle.py sf_dir [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def normal(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (2, f"{value:.9g}")
    if isinstance(value, int):
        return (2, f"{float(value):.9g}")
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}" if bad else f"ok {len(mine)} rows"


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main() -> None:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in names or list(queries):
        start = time.time()
        try:
            if name in oracle:
                result = compare(spark, con, sf_dir, queries[name], oracle[name])
            else:
                df = queries[name](spark, sf_dir)
                result = f"rows only {len(df.collect())}"
        except Exception as e:  # report and go on
            result = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {result} ({time.time() - start:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
