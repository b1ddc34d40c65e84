"""Scrub, encode, decode and re-encode of delimited records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.functions.text import or_na, record, scrubbed
from tracklayer.layouts import FIELD_SEP, NA, Layout


def scrub(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Remove both delimiters from the listed columns, in one projection."""
    return df.withColumns({c: scrubbed(c) for c in columns})


def key_text(layout: Layout) -> Column:
    key = F.col(layout.key)
    return or_na(F.trim(key) if layout.trim_key else key)


def record_text(layout: Layout, columns: Sequence[str] | None = None) -> Column:
    """The encoded record as an expression over the layout's columns."""
    columns = layout.columns if columns is None else columns
    first = F.trim(F.col(columns[0])) if layout.trim_first else F.col(columns[0])
    return record([or_na(first), *(or_na(c) for c in columns[1:])])


def encode(df: DataFrame, layout: Layout, keep: Sequence[str] = ()) -> DataFrame:
    """``(PK, CT_COL)`` plus the columns to keep for ordering."""
    return df.select(key_text(layout).alias("PK"), record_text(layout).alias("CT_COL"), *keep)


def decode(df: DataFrame, layout: Layout, source: str = "CT_COL", prefix: str = "") -> DataFrame:
    """Named columns of an encoded record by position; fields past its end are NULL. ``PK`` is kept."""
    parts = df.select("PK", F.split(F.col(source), FIELD_SEP).alias("_f"))
    named = [F.get("_f", F.lit(i)).alias(prefix + c) for i, c in enumerate(layout.columns)]
    return parts.select("PK", *named)


def reencode(encoded: Column, layout: Layout, extra: Sequence[Column] = ()) -> Column:
    """The persistent form of an incremental record: without ``load_ts``, padded to full length, extras appended.

    The record stays an array of its fields throughout, so a 200-field record costs one split and no 200-column frame.
    """
    kept = len(layout.persistent_columns)
    fields = F.split(encoded, FIELD_SEP)
    if "load_ts" in layout.columns and layout.columns[-1] != "load_ts":
        raise ValueError(f"load_ts must be the last field of {layout.family}")
    head = F.slice(fields, 1, kept)
    padding = F.array_repeat(F.lit(NA), F.lit(kept) - F.size(head))
    return F.concat_ws(FIELD_SEP, F.concat(head, padding), *(or_na(e) for e in extra))
