"""Scratch tables live below the shared folder and go with their application."""

import os
import subprocess
import sys

from siltstone.session import run_root, work_path

RUN = """
from pyspark.sql import SparkSession
from siltstone.session import work_path
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", {root!r}).config("spark.ui.enabled", "false").getOrCreate()
path = work_path(spark, "rows")
spark.range(5).write.parquet(path)
assert spark.read.parquet(path).count() == 5
print("at", path)
"""


def test_paths_are_fresh_and_below_one_folder(spark):
    first, second = work_path(spark, "rows"), work_path(spark, "rows")
    assert first != second and {os.path.dirname(first), os.path.dirname(second)} == {run_root(spark)}


def test_scratch_goes_with_the_application(tmp_path):
    kept = tmp_path / "of-another-run"
    kept.write_text("x")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RUN.format(root=str(tmp_path))], cwd=repo, capture_output=True, text=True, timeout=120, check=True)
    path = done.stdout.split("at ")[1].strip()
    assert path.startswith(f"{tmp_path}/run-")
    assert not os.path.exists(os.path.dirname(path)) and kept.exists()
