"""From changed rows to the key-value bundle a batch hands to the layers: family code -> frame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklayer.functions.text import or_na
from tracklayer.layouts import Layout
from tracklayer.operators.cdc import contact_pair, latest_records, split_cdc, without_deletes
from tracklayer.operators.codec import encode, key_text, scrub
from tracklayer.operators.enrich import enrich_pickup, with_status
from tracklayer.operators.journey import events_of, flight_event, journey_rows, pickup_event, status_event
from tracklayer.operators.status import pickup_load_ts
from tracklayer.sources.masters import Masters

RECORD_FAMILIES = ("ABM", "IBS", "OBS", "SLT", "MDP", "MOD", "SFM", "ALK", "SRT")
TOMBSTONED = frozenset({"SLT"})
LEGS = {"IBS": "@IB", "OBS": "@OB"}

# Where each family of a bundle goes. Families of the incremental layer reach the persistent one by promotion.
ROUTES = {
    **dict.fromkeys(RECORD_FAMILIES, ("incremental",)),
    "ALK": ("incremental", "persistent", "link"),
    "PDJ": ("incremental",),
    "SFJ": ("incremental",),
    "CPS": ("pickup",),
    "LTS": ("pickup",),
    "CPJ": ("pickup",),
    "ADT": ("contact",),
    "DEL": ("deleted",),
}


def order_columns(df: DataFrame) -> list[str]:
    """What makes a change the last one: its operation time, then its position in the feed where known."""
    return [c for c in ("op_ts", "pos") if c in df.columns]


def _rows_of(events: DataFrame) -> DataFrame:
    rows = journey_rows(events.filter(F.col("event").isNotNull()))
    return rows.select("PK", F.col("event").alias("CT_COL"))


def _journey_key(layout: Layout):
    # Like the record's key, but a NULL key stays NULL and so gets no journey.
    return F.when(F.col(layout.key).isNotNull(), key_text(layout))


def status_journey(changes: Mapping[str, DataFrame], layouts: Mapping[str, Layout], masters: Masters) -> DataFrame:
    """Events of the inbound and outbound legs together; a leg that is absent adds none."""
    legs = []
    for family, suffix in LEGS.items():
        if family in changes:
            rows = scrub(without_deletes(changes[family]), layouts[family].fields)
            named = with_status(rows, masters.status)
            legs.append(events_of(named, _journey_key(layouts[family]), status_event(suffix)))
    out = legs[0]
    for leg in legs[1:]:
        out = out.unionByName(leg)
    return out


def build_bundle(
    changes: Mapping[str, DataFrame], layouts: Mapping[str, Layout], masters: Masters
) -> dict[str, DataFrame]:
    """Bundle of one batch.

    Record families hold ``(PK, CT_COL)`` and ordering columns, one row per change; journeys hold ``(PK, CT_COL)``, one
    row per distinct event. Families without changes in ``changes`` are left out, which the layers read as "nothing new".
    """
    bundle = {}
    for family in RECORD_FAMILIES:
        if family in changes:
            rows = changes[family]
            bundle[family] = split_cdc(rows, layouts[family], family in TOMBSTONED, order_columns(rows))
    if "CPS" in changes:
        layout = layouts["CPS"]
        rows = scrub(without_deletes(changes["CPS"]), layout.fields)
        known = enrich_pickup(rows, masters.customer, masters.group, single=True)
        bundle["CPS"] = encode(known, layout, order_columns(rows))
        bundle["CPJ"] = _rows_of(events_of(rows, F.trim(layout.key), pickup_event()))
        bundle["LTS"] = pickup_load_ts(without_deletes(changes["CPS"]), layout.key)
    if "ADT" in changes:
        rows = scrub(without_deletes(changes["ADT"]), ["nawbid", "ccode", "cattn"])
        bundle["ADT"] = encode(contact_pair(rows, order=order_columns(rows)), layouts["ADT"], ["op_ts"])
    if "SFM" in changes:
        rows = scrub(without_deletes(changes["SFM"]), layouts["SFM"].fields)
        bundle["SFJ"] = _rows_of(events_of(rows, _journey_key(layouts["SFM"]), flight_event()))
    if LEGS.keys() & changes.keys():
        bundle["PDJ"] = _rows_of(status_journey(changes, layouts, masters))
    return bundle


def delete_bundle(rows: DataFrame, layout: Layout) -> dict[str, DataFrame]:
    """Bundle that records deleted rows in their own table."""
    deleted = scrub(rows.filter(F.col("op_type") == "D"), layout.fields)
    return {"DEL": encode(deleted, layout, order_columns(rows))}


def latest_of(frame: DataFrame, family: str) -> DataFrame:
    """``(PK, <family>)`` with one row per key."""
    order = order_columns(frame)
    rows = latest_records(frame, order) if order else frame.select(or_na("PK").alias("PK"), "CT_COL").distinct()
    return rows.select("PK", F.col("CT_COL").alias(family))

