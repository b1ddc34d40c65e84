"""Master tables: full snapshots, read from a primary location with a backup behind it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tracklayer.session import empty_frame
from tracklayer.sources.landing import read_parquet_or_none


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


STATUS_SCHEMA = _strings("cstatcode", "cstattype", "cstatgroup", "cstatdesc")
CUSTOMER_SCHEMA = _strings("carea", "ccustcode", "ccompgrp")
PACK_SCHEMA = _strings(
    "cprodcode", "csubprdcd", "cpacktype", "cprodparent", "cprodcommname", "csubprdcommname", "cprodgroup"
)
GROUP_SCHEMA = _strings("ccompgrp", "ccompname")


@dataclass(frozen=True)
class Masters:
    """The four master tables the layers are enriched from."""

    status: DataFrame
    customer: DataFrame
    pack: DataFrame
    group: DataFrame


def read_master(spark: SparkSession, primary: str, backup: str, schema: T.StructType | None = None) -> DataFrame:
    """The primary snapshot, or the backup where the primary directory is missing or empty."""
    df = read_parquet_or_none(spark, primary, schema)
    if df is None:
        df = read_parquet_or_none(spark, backup, schema)
    if df is None:
        raise FileNotFoundError(f"no master table at {primary} or {backup}")
    return df


def read_masters(spark: SparkSession, primary: str, backup: str) -> Masters:
    """All masters from ``<root>/status``, ``customer``, ``pack`` and ``group``."""

    def read(name: str, schema: T.StructType) -> DataFrame:
        return read_master(spark, f"{primary}/{name}", f"{backup}/{name}", schema)

    return Masters(
        status=read("status", STATUS_SCHEMA),
        customer=read("customer", CUSTOMER_SCHEMA),
        pack=read("pack", PACK_SCHEMA),
        group=read("group", GROUP_SCHEMA),
    )


def no_masters(spark: SparkSession) -> Masters:
    """Empty masters, for jobs that run without enrichment."""
    return Masters(
        status=empty_frame(spark, STATUS_SCHEMA),
        customer=empty_frame(spark, CUSTOMER_SCHEMA),
        pack=empty_frame(spark, PACK_SCHEMA),
        group=empty_frame(spark, GROUP_SCHEMA),
    )
