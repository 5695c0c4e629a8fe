"""Operators run where workers hold no copy of the package, as on a cluster that only has PySpark."""

import os
import subprocess
import sys

import pytest

pytest.importorskip("rootline.llm")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession

spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()


def known(batches):  # asked on a worker
    import importlib.util

    for b in batches:
        yield b.set_column(0, "id", [importlib.util.find_spec("rootline") is not None] * b.num_rows)


assert not any(r.id for r in spark.range(2).mapInArrow(known, "id boolean").collect()), "workers find the package"
sys.path.insert(0, sys.argv[1])
from rootline.llm.queries import QUERIES

for name, query in QUERIES.items():
    assert query(spark, sys.argv[2]).count() > 0, name
"""


def test_workers_without_the_package(small, tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), ROOT, small], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
