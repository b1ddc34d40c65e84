"""Change-data-capture operators: latest row per key, upserts with tombstones, contact pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.layouts import TOMBSTONE, Layout
from tracklayer.operators.codec import encode, key_text, record_text, scrub


def without_deletes(df: DataFrame) -> DataFrame:
    """Drops deletes, and rows whose ``op_type`` is NULL."""
    return df.filter(F.col("op_type") != "D")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties settled by the rest of the row.

    A maximum over structs is combined before the shuffle, so a key holding a large share of the rows sends one row
    per map task instead of all of them, as a window over the key would.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    columns = [F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    return df.groupBy(*keys).agg(best).select(*columns)


def split_cdc(df: DataFrame, layout: Layout, tombstone: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Encoded upserts and, where asked for, tombstones for deletes, from one pass over the changes."""
    clean = scrub(df, layout.fields)
    if not tombstone:
        return encode(without_deletes(clean), layout, keep)
    payload = F.when(F.col("op_type") == "D", F.lit(TOMBSTONE)).otherwise(record_text(layout))
    return clean.filter(F.col("op_type").isNotNull()).select(
        key_text(layout).alias("PK"), payload.alias("CT_COL"), *keep
    )


def latest_records(kv: DataFrame, order: Sequence[str] = ("op_ts",)) -> DataFrame:
    """The surviving record of each key of an encoded frame: last write wins."""
    return latest_per_key(kv, ["PK"], order).select("PK", "CT_COL")


def pivot_records(stacked: DataFrame, families: Sequence[str], order: Sequence[str] = ("op_ts",)) -> DataFrame:
    """One row per key with the latest record of every family as its own column, in a single shuffle.

    ``stacked`` holds ``(family, PK, CT_COL, *order)``. Keys that lack a family get NULL there.
    """
    ranked = F.struct(*order, "CT_COL")
    newest = [F.max(F.when(F.col("family") == name, ranked)).alias(name) for name in families]
    wide = stacked.groupBy("PK").agg(*newest)
    return wide.select("PK", *(F.col(f"{name}.CT_COL").alias(name) for name in families))


def pivot_families(frames: Mapping[str, DataFrame], order: Sequence[str] = ("op_ts",)) -> DataFrame:
    """``pivot_records`` of one frame ``(PK, CT_COL, *order)`` per family."""
    stacked = [df.select(F.lit(name).alias("family"), "PK", "CT_COL", *order) for name, df in frames.items()]
    return pivot_records(reduce(DataFrame.unionByName, stacked), list(frames), order)


def contact_pair(
    df: DataFrame,
    key: str = "nawbid",
    flag: str = "cshipper",
    name: str = "cattn",
    code: str = "ccode",
    order: Sequence[str] = ("op_ts",),
    sides: tuple[object, object] = ("Y", "N"),
) -> DataFrame:
    """Latest sender row and latest receiver row of each id, side by side; ids lacking either side vanish.

    Both sides come from one aggregation instead of two ranked subqueries and a self-join.
    """
    row = F.struct(*order, code, name)

    def side(value: object) -> Column:
        return F.max(F.when(F.col(flag) == F.lit(value), row))

    pairs = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(side(sides[0]).alias("_s"), side(sides[1]).alias("_r"))
        .filter(F.col("_s").isNotNull() & F.col("_r").isNotNull())
    )
    return pairs.select(
        key,
        F.col(f"_s.{code}").alias("ccode"),
        F.col(f"_r.{name}").alias("cattention"),
        F.col(f"_s.{name}").alias("csender"),
        F.col(f"_s.{order[0]}").alias("op_ts"),
    )
