"""Session helpers: where a job may put shared intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it. Only a local session may do without and gets its own."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tracklayer-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a reused frame once and read it back: cuts the lineage and survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def concurrently(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent jobs side by side, so that small ones do not wait for each other; first failure surfaces."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed frame without rows, which the optimizer knows to be empty and so plans no join or shuffle for."""
    nulls = [F.lit(None).cast(c.dataType).alias(c.name) for c in schema]
    return spark.range(1).select(*nulls).limit(0)
