"""Usage behind one schema, from billing or from run durations."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession

from siltstone.operators.costs import run_durations, usage_by_job
from siltstone.session import cut_lineage
from siltstone.sources.landing import path_exists

USAGE = "job_name string, usage_date timestamp, quantity double"
RUNS = "job_name string, start_date timestamp, end_date timestamp"


def fetch_usage(spark: SparkSession, billing_path: str, runs_path: str, since: Column) -> DataFrame:
    """(job_name, consumption) since a moment: billing sums, or run seconds when billing is absent or cannot be read.

    The sums, one row per job, are computed here, so that a read that fails is known now.
    """
    if path_exists(spark, billing_path):
        try:
            return cut_lineage(usage_by_job(spark.read.schema(USAGE).parquet(billing_path), since))
        except (PySparkException, Py4JJavaError) as error:
            logging.getLogger(__name__).warning("billing cannot be read, run durations are used: %s", str(error).splitlines()[0])
    return run_durations(spark.read.schema(RUNS).parquet(runs_path), since)
