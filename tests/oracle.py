"""Compare a registered query with its DuckDB twin, value by value."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


_KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
          "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}


def compare(spark, con, run, sql, folder):
    """Empty text when both sides agree, else what differs."""
    df = run(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
        return "the plan pairs all rows"
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    for name, kind in df.dtypes:
        if _KINDS.get(kind) != kinds[name] and kinds[name] != '"NULL"':
            return f"type of {name}: {kind} / {kinds[name]}"
    want = rows_of(names, cur.fetchall())
    if not want:
        return "oracle has no rows"
    if got != want:
        return (f"{sum(got.values())} / {sum(want.values())} rows, only Spark {list((got - want).items())[:3]}, "
                f"only SQL {list((want - got).items())[:3]}")
    return ""


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            fault = compare(spark, con, run, sqls.get(name), folder)
        except Exception as exc:  # noqa: BLE001
            fault = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(fault)
        print(f"{'BAD' if fault else 'ok '} {name} {time.time() - start:.1f}s "
              f"{'' if name in sqls else '(rows only)'} {fault}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
