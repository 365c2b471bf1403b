"""A driver killed in the middle of its upserts loses and doubles nothing."""

import os
import signal
import subprocess
import sys
import time

from gridtide.operators import dims, lookups
from gridtide.operators.upsert import GENERATION_KEYS, latest_per_key
from gridtide.streaming.gold import fact_generation_table
from test_streams import flow, silver_rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from gridtide.session import build_session
spark = build_session("child", master="local[4]", shuffle_partitions=4)
print(spark.sparkContext._gateway.proc.pid, flush=True)
from test_streams import flow
flow(spark, {folder!r})
"""


def versions(folder):
    path = os.path.join(folder, "gold", "versions")
    return len(os.listdir(path)) if os.path.isdir(path) else 0


def test_killed_driver(spark, rows, tmp_path):
    folder = str(tmp_path)
    everything = silver_rows(spark, 300, 11).cache()
    everything.repartition(12).write.parquet(f"{folder}/silver")
    script = CHILD.format(root=ROOT, tests=os.path.join(ROOT, "tests"), folder=folder)
    with open(tmp_path / "child.log", "w") as log:
        child = subprocess.Popen(
            [sys.executable, "-c", script], stdout=subprocess.PIPE, stderr=log, text=True
        )
        jvm = int(child.stdout.readline())
        deadline = time.time() + 120
        while versions(folder) < 4 and child.poll() is None and time.time() < deadline:
            time.sleep(0.05)
        os.kill(jvm, signal.SIGKILL)
        child.kill()
        child.wait()
    assert 4 <= versions(folder) < 13

    flow(spark, folder)
    fact = fact_generation_table(f"{folder}/gold")
    expected = latest_per_key(
        lookups.generation_fact_rows(everything, dims.dim_date(spark), dims.dim_time(spark)),
        GENERATION_KEYS,
    )
    columns = [c for c in expected.columns if c != "gold_processed_timestamp"]
    assert rows(fact.read(spark), *columns) == rows(expected, *columns)
