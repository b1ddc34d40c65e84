"""The change feed: JSON envelopes ``{after, current_ts, op_ts, op_type, pos, table}`` of many tables in one stream."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklayer.layouts import ADDRESS_COLUMNS, SOURCE_TABLES, Layout, layout_from_columns


def read_feed(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """A stream of envelopes as one text column ``value``.

    ``kafka`` starts at the latest offset unless told otherwise; ``text`` reads JSON lines from a folder (``path``).
    Rate limits are the source's own options (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    if source == "kafka":
        options = {"startingOffsets": "latest", **options}
    stream = spark.readStream.format(source).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def source_table(value: Column | str = "value") -> Column:
    """Unqualified source table an envelope belongs to; the only field needed to route it."""
    value = F.col(value) if isinstance(value, str) else value
    return F.substring_index(F.get_json_object(value, "$.table"), ".", -1)


def route(values: DataFrame, tables: Collection[str] = tuple(SOURCE_TABLES)) -> DataFrame:
    """``(value, _envelope, _table, _refused)``: envelopes parsed once, for all that asks for their fields.

    ``_envelope`` is the parsed form, a VARIANT. ``_refused`` says why no table takes an envelope in: ``malformed`` text,
    or an ``unknown table``; it is NULL for those of the given tables.
    """
    parsed = values.select("value", F.try_parse_json("value").alias("_envelope"))
    name = F.substring_index(F.try_variant_get("_envelope", "$.table", "string"), ".", -1)
    known = F.coalesce(F.col("_table").isin(list(tables)), F.lit(False))
    refused = F.when(F.col("_envelope").isNull(), "malformed").when(~known, "unknown table")
    return parsed.withColumn("_table", name).withColumn("_refused", refused)


def landed_schema(layout: Layout) -> T.StructType:
    """Schema of a family's landed table. Address rows land with all their columns; their record holds a few of them."""
    if layout.family != "ADT":
        return layout.landed_schema()
    strings = [T.StructField(c, T.StringType()) for c in (*ADDRESS_COLUMNS, "op_ts", "op_type")]
    return T.StructType([*strings, T.StructField("load_ts", T.LongType())])


def parse(values: DataFrame, layout: Layout, load_ts: Column | None = None) -> DataFrame:
    """Rows of one table's envelopes: the ``after`` fields, the change columns, and the load stamp where given."""
    routed = values if "_envelope" in values.columns else route(values)
    after = ADDRESS_COLUMNS if layout.family == "ADT" else layout.fields

    def text(path: str) -> Column:
        return F.try_variant_get("_envelope", path, "string")

    fields = [text(f"$.after.{c}").alias(c) for c in after]
    rows = routed.select(*fields, *(text(f"$.{c}").alias(c) for c in ("op_ts", "op_type", "pos")))
    return rows if load_ts is None else rows.withColumn("load_ts", load_ts.cast("long"))


def demultiplex(
    values: DataFrame,
    layouts: Mapping[str, Layout],
    load_ts: Column | None = None,
    tables: Mapping[str, str] = SOURCE_TABLES,
) -> dict[str, DataFrame]:
    """One frame per family from a mixed batch, routed or not. Persist routed ``values`` when several of them are used."""
    routed = values if "_envelope" in values.columns else route(values, tables)
    return {
        family: parse(routed.filter(F.col("_table") == table), layouts[family], load_ts)
        for table, family in tables.items()
        if family in layouts
    }


def refused(routed: DataFrame) -> DataFrame:
    """``(value, reason)`` of the envelopes that no table takes in: the dead letters of a feed."""
    return routed.filter(F.col("_refused").isNotNull()).select("value", F.col("_refused").alias("reason"))


def routing_counts() -> list[Column]:
    """What to observe of a routed feed: all envelopes, and those refused."""
    seen = F.count(F.lit(1)).alias("seen")
    return [seen, *(F.count_if(F.col("_refused") == r).alias(r.split()[0]) for r in ("malformed", "unknown table"))]


def layout_from_feed(values: DataFrame, table: str, family: str) -> Layout:
    """Layout of a table whose columns nobody stated: those of its fullest envelope, in the order it has them.

    Change records name all columns of their table in its order. One envelope's column names reach the driver.
    """
    after = F.get_json_object("value", "$.after")
    own = values.filter(F.col("_table") == table if "_table" in values.columns else source_table() == table).select(F.json_object_keys(after).alias("columns"))
    fullest = own.agg(F.max(F.struct(F.size("columns").alias("n"), "columns")).alias("top")).first().top
    if fullest is None or not fullest.columns:
        raise ValueError(f"no envelope of {table} names its columns")
    return layout_from_columns(family, fullest.columns)
