"""Run registered queries against their SQL: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main(sf: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, oracles, bad = connect(sf_dir), oracle_sql(), []
    for name, fn in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = differences(fn(spark, sf_dir), con, oracles[name])
            else:
                problems = [] if fn(spark, sf_dir).count() else ["no rows"]
        except Exception as error:
            problems = [traceback.format_exc(limit=-3)[-900:] if len(str(error)) > 900 else repr(error)[:900]]
        took = time.time() - start
        print(f"{'ok ' if not problems else 'BAD'} {name} {took:.1f}s {'; '.join(problems)[:1200]}", flush=True)
        if problems:
            bad.append(name)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "0.001", sys.argv[2:])
