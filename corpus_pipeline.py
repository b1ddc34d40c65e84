"""A corpus made ready for training: five stages over `documents`, each written as Parquet and read by the next.

Quality rules, line dedup, near-dedup, benchmark decontamination, byte-level BPE. All stages but the last return the columns
of their input. No SQL can express the first and third, so ORACLE_SQL is None and the stages are tested one by one.

Defined results: a document whose lines were all repeats is gone after line dedup. From near-dedup on a document is told by
its id and text together: rows with equal ids and other texts are judged apart, rows equal in both count as one, of which
one stays, and documents with a null id are compared like others, their ids last. Empty tables pass through. Columns beyond
those of `documents` are kept as they are; n_chars follows the text where it is there.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklayer.llm import bpe, decontaminate, line_crf, line_dedup, near_dup
from tracklayer.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with enough words, not too many of them repeated, and mostly in content lines."""
    return line_crf.keep_good(docs, line_crf.fit_lines(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that occur elsewhere before."""
    cut = line_dedup.dedup_lines(docs)
    left = cut.where((F.col("n_removed_chunks") == 0) | F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)))
    size = F.when(F.col("n_removed_chunks") == 0, F.col("n_chars")).otherwise(F.length("text")) if "n_chars" in docs.columns else None
    return left.select(*(size.alias(c) if c == "n_chars" else c for c in docs.columns))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """With one text column more that tells documents by id and text, and sorts as ids do, null ones last; and its name."""
    name = "row_key"
    while name in docs.columns:
        name += "_"
    number = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    key = F.concat(F.coalesce(number, F.lit("~")), F.lit(":"), F.md5(F.coalesce("text", F.lit(""))))
    return docs.withColumn(name, key), name


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the smallest id."""
    keyed, key = _keyed(docs)
    classes = near_dup.near_duplicates(keyed.select(key, "text"), id_col=key)
    heads = classes.where(F.col(key) == F.col("class_id")).select(key).distinct()
    return keyed.join(heads, key, "left_semi").dropDuplicates([key]).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    keyed, key = _keyed(docs)
    leaks = decontaminate.find_leaks(keyed.select(key, "text"), table(spark, sf_dir, "benchmark"), id_col=key).select(key).distinct()
    return keyed.join(leaks, key, "left_anti").select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizers: Callable[[str], str] = public_tokenizers.path) -> DataFrame:
    """doc_id, ids, and the digests of the ids and of the bytes decoded from them."""
    ranks = bpe.read_ranks(tokenizers("byte_bpe_multi_50k.tiktoken"))
    schema = "ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN, lambda ids, decoded: (ids, *bpe.digests(ids, decoded)), schema)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
