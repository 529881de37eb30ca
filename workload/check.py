"""Run every query on Spark and its SQL on DuckDB, and compare the rows.

Usage: ``python -m workload.check [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.queries import QUERIES, TABLES


def differences(spark: SparkSession, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL; nothing if they agree."""
    found = QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(found.columns) != sorted(columns):
        return [f"columns {sorted(found.columns)} instead of {sorted(columns)}"]
    got = Counter(tuple(row) for row in found.select(*columns).collect())
    want = Counter(expected_rows)
    return [f"unexpected {row}" for row in (got - want)] + [f"missing {row}" for row in (want - got)]


def main() -> None:
    from caretiers import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", **{"spark.master": "local[8]", "spark.ui.enabled": "false"})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            result = differences(spark, name, sf_dir) if name in ORACLES else [f"no SQL; {QUERIES[name](spark, sf_dir).count()} rows"]
        except Exception as error:  # report and go on with the next query
            result = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{name}: {'ok' if not result else f'{len(result)} differences'} ({time.time() - start:.1f} s)", flush=True)
        for line in result[:4]:
            print("   ", line[:700])


if __name__ == "__main__":
    main()
