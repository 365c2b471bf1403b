"""Run every query against its SQL: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from gridtide.session import build_session  # noqa: E402
from oracle import connect, differences  # noqa: E402


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = build_session("check", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            frame = run(spark, sf_dir)
            found = differences(frame, con, sql[name]) if name in sql else []
            size = frame.count()
        except Exception as error:
            found, size = [("error", str(error)[:1500])], -1
        bad += bool(found)
        print(f"{name:32} rows={size:7} {time.time() - started:6.1f}s {'ok' if not found else found}", flush=True)
    print("different:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
