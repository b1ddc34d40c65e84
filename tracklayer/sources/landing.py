"""Landed change tables: one directory per source table, partitioned by ``load_ts``; and what of them is due."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklayer.operators.status import as_stamp
from tracklayer.session import empty_frame
from tracklayer.sources import paths

SAFETY_LAG_SECONDS = 120
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_parquet_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A parquet table with lower-case names, or None where its directory is missing or empty.

    Only that is tolerated; any other failure surfaces.
    """
    try:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_THERE:
            raise
        return None
    return df.toDF(*(c.lower() for c in df.columns))


def read_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A landed table with its declared schema (``load_ts`` pinned to a long); empty if nothing landed."""
    df = read_parquet_or_none(spark, path, schema)
    return empty_frame(spark, schema) if df is None else df


def select_batch(
    landing: DataFrame, last: DataFrame | None, as_of: datetime, lag_seconds: int = SAFETY_LAG_SECONDS
) -> DataFrame:
    """Landed rows not yet processed and old enough: after the newest stamp of ``last``, before now minus the lag.

    Both bounds are exclusive and are compared as numbers on the partition column, so they prune directories. Without
    a last batch only the upper bound holds.
    """
    due = landing.filter(F.col("load_ts") < as_stamp(as_of - timedelta(seconds=lag_seconds)))
    if last is None:
        return due
    watermark = last.agg(F.coalesce(F.max("load_ts").cast("long"), F.lit(-1).cast("long"))).scalar()
    return due.filter(F.col("load_ts") > watermark)


def due_stamps(
    spark: SparkSession, path: str, after: int | None, as_of: datetime, lag_seconds: int = SAFETY_LAG_SECONDS
) -> list[int]:
    """``select_batch`` on the names of a landed table's partitions alone: no data is read."""
    names = [n for n in paths.child_names(spark, path) if n.startswith("load_ts=")]
    stamps = sorted(int(n.removeprefix("load_ts=")) for n in names)
    return [s for s in stamps if s < as_stamp(as_of - timedelta(seconds=lag_seconds)) and (after is None or s > after)]


def latest_partition(batch: DataFrame) -> DataFrame:
    """Rows carrying the newest load stamp of a batch: the watermark the next run starts from."""
    return batch.filter(F.col("load_ts") == batch.agg(F.max("load_ts")).scalar())


def write_partitions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a landed table: one directory per load stamp.

    Rows are rebalanced by stamp first, so that each directory gets few files of the advisory size, and a stamp that
    holds much of the data is split over several tasks.
    """
    df.hint("rebalance", "load_ts").write.mode(mode).partitionBy("load_ts").parquet(path)


def columns_of(spark: SparkSession, path: str) -> Sequence[str]:
    """Column order of a landed table, from its footer: what a wide table's layout is built from."""
    return [c.lower() for c in spark.read.parquet(path).columns]
