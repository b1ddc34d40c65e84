"""Incremental layer -> persistent layer: re-encode with master columns, derive status, dates and load stamps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.functions.text import field, or_na
from tracklayer.layouts import CUSTOMER_EXTRA, NA, STATUS_EXTRA, TOMBSTONE, Layout
from tracklayer.operators.codec import reencode
from tracklayer.operators.enrich import enrich_shipment, with_status
from tracklayer.operators.journey import event_text
from tracklayer.operators.status import CLOSURE_CODES, AsOf, closure_ts, delivery_status, load_ts_text
from tracklayer.sources.masters import Masters

STAMPED = ("ABM", "SLT", "IBS", "OBS", "MDP", "MOD", "SFM")
PLAIN = ("MDP", "MOD", "SFM")
PROMOTED = ("ABM", "IBS", "OBS", "SLT", "MDP", "MOD", "SFM", "DLS", "DTS", "LTS")


# Fields the promotion rules read, by family.
_STATUS_FIELDS = ("cstattype", "cstatcode")
_SHIPMENT_FIELDS = ("cbtparea", "corgarea", "cbtpcode", "ccustcode", "cprodcode", "cmode", "cpacktype")
READ_FIELDS = {"IBS": _STATUS_FIELDS, "OBS": _STATUS_FIELDS, "ABM": _SHIPMENT_FIELDS, "SLT": _SHIPMENT_FIELDS}


def record_field(layouts: Mapping[str, Layout], family: str, column: str) -> Column:
    """Field of a family's encoded record."""
    return field(family, layouts[family].position(column))


def has_key(key: Column) -> Column:
    """A record with a real key; false, never NULL, without one."""
    return F.coalesce(key != NA, F.lit(False))


def batch_stamps(il: DataFrame, layouts: Mapping[str, Layout]) -> list[Column]:
    """Load stamps of all stamped families of an incremental frame, as numbers."""
    present = [f for f in STAMPED if f in il.columns and "load_ts" in layouts[f].columns]
    return [record_field(layouts, f, "load_ts").try_cast("long") for f in present]


def promote(
    il: DataFrame,
    layouts: Mapping[str, Layout],
    masters: Masters,
    *,
    as_of: AsOf,
    codes: Sequence[str] = CLOSURE_CODES,
    load_ts: Column | None = None,
    keep_status: bool = False,
) -> DataFrame:
    """Persistent form of an incremental frame: one row per key, NULL where a family brings nothing.

    ``il`` holds ``PK`` and encoded record families. A key without an inbound or outbound record has its status reset
    to the sentinel, unless ``keep_status`` leaves the stored one. ``load_ts`` defaults to the batch's greatest stamp.
    """
    present = [f for f in PROMOTED if f in il.columns and f in layouts]

    def name(family: str, column: str) -> str:
        return f"_{family}_{column}"

    def read(family: str, column: str) -> Column:
        return F.col(name(family, column)) if family in present else F.lit(None).cast("string")

    # One projection takes all fields the rules need out of the records, so that a long record is split once.
    fields = {
        name(f, c): record_field(layouts, f, c) for f in present for c in (layouts[f].key, *READ_FIELDS.get(f, ()))
    }
    out = il.withColumns(fields)

    legs = [read(f, c) for f in ("IBS", "OBS") for c in _STATUS_FIELDS]
    keyed = [has_key(read(f, layouts[f].key)) for f in ("IBS", "OBS") if f in present]
    status = F.when(keyed[0] | keyed[-1], delivery_status(*legs, codes=codes)) if keyed else F.lit(None).cast("string")
    if load_ts is None:
        stamps = batch_stamps(il, layouts)
        load_ts = load_ts_text(il, stamps) if stamps else F.lit(None).cast("string")

    for family in ("IBS", "OBS"):
        if family in present:
            out = with_status(out, masters.status, *(read(family, c) for c in _STATUS_FIELDS), single=True)
            out = _re_record(out, family, layouts[family], STATUS_EXTRA)
    for family in ("ABM", "SLT"):
        if family in present:
            out = enrich_shipment(
                out, masters.customer, masters.pack, masters.group, lambda c, f=family: read(f, c), single=True
            )
            out = _re_record(out, family, layouts[family], CUSTOMER_EXTRA)

    plain = {
        f: F.when(read(f, layouts[f].key).isNotNull(), reencode(F.col(f), layouts[f])).alias(f)
        for f in PLAIN
        if f in present
    }
    derived = {
        "DLS": (status if keep_status else or_na(status)).alias("DLS"),
        "DTS": closure_ts(status, as_of).alias("DTS"),
        "LTS": load_ts.alias("LTS"),
    }
    return out.select("PK", *({**plain, **derived}.get(f, F.col(f)) for f in PROMOTED if f in present or f in derived))


def _re_record(df: DataFrame, family: str, layout: Layout, extra: Sequence[str]) -> DataFrame:
    """The family's persistent record with the looked-up columns appended, which are then dropped."""
    first = F.col(f"_{family}_{layout.key}")
    record = reencode(F.col(family), layout, [F.col(c) for c in extra])
    text = F.when(first == TOMBSTONE, TOMBSTONE).when(first.isNotNull(), record)
    return df.withColumn(family, text).drop(*extra)


def promote_alternates(il: DataFrame, layouts: Mapping[str, Layout]) -> DataFrame:
    """``(PK, SRT, SRT_AFLG, SRJ)`` of keys with an alternate instruction: its record, a flag, and its event."""
    layout = layouts["SRT"]
    date, remark, kind, key = (record_field(layouts, "SRT", c) for c in ("dentdate", "cremarks", "op_type", layout.key))
    return il.filter(has_key(key)).select(
        "PK",
        reencode(F.col("SRT"), layout).alias("SRT"),
        F.lit("Y").alias("SRT_AFLG"),
        event_text([date, remark], op_type=kind).alias("SRJ"),
    )
