"""What several operators of this package share: reading tables, shared folders, word rules."""

from __future__ import annotations

import re

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklayer.session import materialise, work_path

#: Words are runs of anything but space and the five ASCII controls from tab to carriage return.
WORD = re.compile("[^\x20\x09-\x0d]+")
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only `id` and `text` (null: empty), so that no other column of the input can clash with an operator's own."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def words_of(text: Column) -> Column:
    """The words of a text as an array, natively."""
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back: used for frames that several later jobs read."""
    return materialise(df, work_path(df.sparkSession, name))


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a shared folder and the path in it, as a task sees them."""
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
