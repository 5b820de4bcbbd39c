"""Operators run where only the driver has this library."""

import os
import pathlib
import subprocess
import sys

import pytest

pytest.importorskip("public_tokenizers")

SF = pathlib.Path("/root/testdata/sf0.001")
REPO = pathlib.Path(__file__).resolve().parents[2]
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the test tables are not here")

SCRIPT = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
spark.conf.set("spark.sql.session.timeZone", "UTC")

def known(batches):
    for batch in batches:
        try:
            import logtables
            yield batch
        except ImportError:
            pass

assert spark.range(3).mapInArrow(known, "id bigint").count() == 0, "workers find the library"
sys.path.insert(0, sys.argv[1])
import __spark_entry__
queries = __spark_entry__.LLM_QUERIES
for name in sorted(queries):
    if name.startswith("op"):
        print(name, queries[name](spark, sys.argv[2]).count(), flush=True)
"""


def test_workers_need_no_library(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYTHONPATH"] = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and pathlib.Path(p).resolve() != REPO)
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(REPO), str(SF)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout + done.stderr[-1500:]
    assert len(done.stdout.split("\n")) - 1 == 13
