"""Journeys: the distinct events of a key, in text order, joined into one string; and their growth over batches.

A key may hold a large share of all events, so a journey is rows first: distinct events, made so after a map-side combine
and dealt by key and event together, so a hot key spreads by the whole content of its events, dated or not. ``sorted_runs``
puts rows in order over all tasks, by ranges of key and event; that is the stored form. ``build_journey`` glues a key's
rows where one cell per key is asked for, moving each distinct event once; that cell alone has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.functions.text import is_missing, or_empty, or_na, record
from tracklayer.layouts import EVENT_SEP


def event_text(
    fields: Sequence[Column | str], suffix: Column | str = "", op_type: Column | str | None = "op_type"
) -> Column:
    """One event: its fields, NULLs kept as empty places, a suffix naming the leg and the change type.

    NULL when the change type is NULL, so such a row adds no event.
    """
    parts = [record([or_empty(f) for f in fields]), suffix if isinstance(suffix, Column) else F.lit(suffix)]
    if op_type is not None:
        parts += [F.lit(":"), F.col(op_type) if isinstance(op_type, str) else op_type]
    return F.concat(*parts)


def status_event(suffix: Column | str) -> Column:
    """Event of an inbound (``@IB``) or outbound (``@OB``) status row joined to the status master."""
    code = F.concat(or_empty("cstattype"), or_empty("cstatcode"))
    return event_text(["dstatdate", code, "cloccode", "cemplcode", "stat_cstatgroup", "stat_cstatdesc"], suffix)


def pickup_event() -> Column:
    return event_text(["dregdate", "dpudate", "crevpu"])


def flight_event() -> Column:
    fields = ["nrunid", "drundate", "corgarea", "cruncode", "cstattype", "cstatcode", "cemplcode", "cloccode"]
    return event_text([*fields, "dstatdate"])


def events_of(df: DataFrame, key: Column | str, text: Column) -> DataFrame:
    """``(PK, event)`` of every row with a key."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("PK"), text.alias("event")).filter(F.col("PK").isNotNull())


def journey_rows(events: DataFrame) -> DataFrame:
    """``(PK, event)``: the distinct events of each key, equal ones met by key and event after a map-side combine."""
    return events.select("PK", "event").distinct()


def sorted_runs(rows: DataFrame, order: Sequence[str] = ("PK", "event")) -> DataFrame:
    """Rows in order over all tasks: ranges of the whole order, each sorted, so no key has to fit in one of them."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def journey_parts(events: DataFrame, slice_chars: int) -> DataFrame:
    """``(PK, part, CT_COL)``: the journey of each key cut at leading text slices, such as its days.

    Slices sort as whole events do. A key with NULL events only gets one empty part.
    """
    sliced = journey_rows(events).select("PK", F.substring("event", 1, slice_chars).alias("part"), "event")
    text = F.concat_ws(EVENT_SEP, F.sort_array(F.collect_list("event")))
    return sliced.groupBy("PK", "part").agg(text.alias("CT_COL"))


def render(parts: DataFrame) -> DataFrame:
    """``(PK, CT_COL)``: the ordered parts of each key joined into its one-cell journey."""
    pieces = F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "CT_COL")))
    ordered = F.transform(F.sort_array(pieces), lambda p: p["CT_COL"])
    return parts.groupBy("PK").agg(F.array_join(ordered, EVENT_SEP).alias("CT_COL"))


def build_journey(events: DataFrame) -> DataFrame:
    """``(PK, CT_COL)``: distinct events per key in text order, joined by ``|``."""
    text = F.concat_ws(EVENT_SEP, F.sort_array(F.collect_list("event")))
    return journey_rows(events).groupBy("PK").agg(text.alias("CT_COL"))


def appended(stored: Column, new: Column, sentinel: str = "reference") -> Column:
    """Stored journey followed by the new one. ``reference`` treats a stored sentinel as text, ``strict`` as nothing."""
    if sentinel not in ("reference", "strict"):
        raise ValueError(f"unknown sentinel mode {sentinel!r}")
    has = stored.isNotNull() if sentinel == "reference" else ~is_missing(stored)
    return F.when(has, F.concat_ws(EVENT_SEP, stored, new)).otherwise(new)


def append_journey(delta: DataFrame, state: DataFrame, column: str, sentinel: str = "reference") -> DataFrame:
    """``(PK, CT_COL)`` of the delta's keys: the state's journey ``column`` with the delta's events appended."""
    stored = state.select("PK", F.col(column).alias("_stored"))
    joined = delta.select("PK", F.col("CT_COL").alias("_new")).join(stored, "PK", "left")
    text = appended(F.col("_stored"), F.col("_new"), sentinel)
    return joined.select(or_na("PK").alias("PK"), or_na(text).alias("CT_COL"))
