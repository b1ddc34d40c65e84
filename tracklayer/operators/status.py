"""Delivery status, status date and load timestamps; and the rules that re-derive them from a stored journey."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklayer.functions.text import (
    MINUTE_FORMAT,
    MINUTE_STAMP_FORMAT,
    STAMP_FORMAT,
    is_missing,
    last_event,
    or_na,
    restamped,
)
from tracklayer.layouts import EVENT_SEP, NA

UNDELIVERED = "UD"
IGNORED = "I"

# Closure codes in priority order, and the two held-shipment markers with their age limit in days.
CLOSURE_CODES = "123 016 026 132 074 000 135 141 021 025 099 105 070 090 098 188 178 284".split()
HELD_CODES = ("S015", "S018")
HELD_DAYS = 45
DATE_CHARS = 19  # length of an event's leading date, "yyyy-MM-dd HH:mm:ss"

AsOf = datetime | str | Column


def moment(as_of: AsOf) -> Column:
    """The job's notion of now, given from outside so that a rerun gives the same result."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def minute_text(as_of: AsOf) -> Column:
    return F.date_format(moment(as_of), MINUTE_FORMAT)


def delivery_status(
    inbound_type: Column,
    inbound_code: Column,
    outbound_type: Column,
    outbound_code: Column,
    codes: Sequence[str] = CLOSURE_CODES,
) -> Column:
    """Closure of the inbound status, else of the outbound one, else undelivered."""

    def closed(kind: Column, code: Column) -> Column:
        return (kind == "T") & code.isin(list(codes))

    return (
        F.when(closed(inbound_type, inbound_code), F.concat(inbound_type, inbound_code))
        .when(closed(outbound_type, outbound_code), F.concat(outbound_type, outbound_code))
        .otherwise(UNDELIVERED)
    )


def closure_ts(status: Column, as_of: AsOf) -> Column:
    """Now for closed rows, NULL for the rest."""
    return F.when(status != UNDELIVERED, minute_text(as_of))


def load_ts_text(df: DataFrame, stamps: Sequence[Column]) -> Column:
    """Greatest load stamp of a batch as date text: one aggregate over all families, used as a scalar subquery.

    NULL when no family carries a stamp.
    """
    tops = [F.max(s.cast("long")) for s in stamps]
    top = F.greatest(*tops) if len(tops) > 1 else tops[0]
    return df.agg(restamped(top, STAMP_FORMAT).alias("load_ts")).scalar()


def pickup_load_ts(df: DataFrame, key: str = "ntokenno") -> DataFrame:
    """``(PK, CT_COL)``: the greatest load stamp of the pickup batch, stamped on every key."""
    return df.select(F.col(key).cast("string").alias("PK"), load_ts_text(df, [F.col("load_ts")]).alias("CT_COL"))


def reformat_lts(df: DataFrame, prefix: str = "20190", column: str = "LTS") -> DataFrame:
    """``(PK, CT_COL)`` of rows whose load timestamp is still in the minute form, re-formatted."""
    old = df.filter(F.col(column).startswith(prefix))
    return old.select("PK", restamped(column, MINUTE_STAMP_FORMAT).alias("CT_COL"))


def _marker(code: str) -> str:
    """In an event, behind its date."""
    return f"~{code}~"


class JourneyCell:
    """What the rules ask of a journey, answered from its one-cell form."""

    def __init__(self, text: Column):
        self.text = text

    def missing(self) -> Column:
        return is_missing(self.text)

    def present(self) -> Column:
        return self.text.isNotNull()

    def closures(self, codes: Sequence[str]) -> list[tuple[Column, Column, Column]]:
        """For each code, the foremost first: whether it is there, the status it means, and its event's date."""
        return [(F.instr(self.text, _marker("T" + c)) > 0, F.lit("T" + c), self.before("T" + c, 16)) for c in codes]

    def mentions(self, code: str) -> Column:
        return F.instr(self.text, code) > 0

    def before(self, code: str, length: int) -> Column:
        """Text of the given length from 19 characters before the marker, where its event's date starts.

        Where that is before the journey's begin, or the marker is absent, the start is counted from the journey's end.
        """
        return F.substr(self.text, F.instr(self.text, _marker(code)) - DATE_CHARS, F.lit(length))

    def last_date(self) -> Column:
        return F.substr(last_event(self.text), F.lit(1), F.lit(16))


class JourneySummary:
    """The same answers from a row of ``journey_summary``, with no journey in a cell."""

    def __init__(self, prefix: str = ""):
        self.prefix = prefix

    def col(self, name: str) -> Column:
        return F.col(self.prefix + name)

    def missing(self) -> Column:
        return ~self.present() | ((self.col("pieces") == 1) & self.col("sentinel"))

    def present(self) -> Column:
        return F.coalesce(self.col("pieces") > 0, F.lit(False))

    def closures(self, codes: Sequence[str]) -> list[tuple[Column, Column, Column]]:
        mark = self.col("closure")
        return [(mark.isNotNull(), F.concat(F.lit("T"), mark["code"]), self._cut(mark, 16))]

    def mentions(self, code: str) -> Column:
        return self.col(f"has_{code}")

    def before(self, code: str, length: int) -> Column:
        return self._cut(self.col(f"at_{code}"), length)

    def _cut(self, mark: Column, length: int) -> Column:
        at = F.coalesce(mark["at"], F.lit(0))
        near_begin = F.substr(self.col("last.tail"), at - DATE_CHARS, F.lit(length))
        return F.when(at >= DATE_CHARS, F.substr(mark["text"], F.lit(1), F.lit(length))).otherwise(near_begin)

    def last_date(self) -> Column:
        return self.col("last.date")


def journey_summary(
    rows: DataFrame, codes: Sequence[str] = CLOSURE_CODES, place: Sequence[str] = ("number", "writer", "event")
) -> DataFrame:
    """One row per key of what the cleanup rules need to know of a journey whose events are rows in order of ``place``.

    A maximum or minimum of small structs each, combined before the shuffle: the first place of the foremost closure
    code and of each held code with the characters before it, the journey's last characters and its last date. An event
    without a whole date before its marker takes characters of the events before it; only for keys with such an event are
    rows put in order, to give each the 19 characters before it.
    """
    first = _summed(_looked_at(rows.withColumn("_lead", F.lit("")), codes), place)
    marks = [F.col("closure"), *(F.col(f"at_{c}") for c in HELD_CODES)]
    cut_short = [F.coalesce((m["at"] <= DATE_CHARS) & (m["place"] != F.col("first_place")), F.lit(False)) for m in marks]
    short = (F.col("pieces") > 1) & (reduce(Column.__or__, cut_short) | (F.length("last.tail") < DATE_CHARS))
    behind = first.filter(short).select("PK")
    in_order = Window.partitionBy("PK").orderBy(*place)
    # any row adds a separator at least, so 19 of them hold 19 characters
    leads = [F.lag("event", k).over(in_order) for k in range(DATE_CHARS, 0, -1)]
    lead = F.concat_ws(EVENT_SEP, *(F.right(e, F.lit(DATE_CHARS)) for e in leads))
    lead = F.when(F.row_number().over(in_order) > 1, F.right(F.concat(lead, F.lit(EVENT_SEP)), F.lit(DATE_CHARS))).otherwise("")
    again = rows.join(behind, "PK", "left_semi").withColumn("_lead", lead)
    return first.filter(~short).unionByName(_summed(_looked_at(again, codes), place)).drop("first_place")


def _looked_at(rows: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Each row's foremost closure code and the places of the markers, counted from the begin of the characters before it."""

    def mark(found: Column, **more: Column) -> Column:
        at = F.length("_lead") + found
        text = F.right(F.concat("_lead", F.substr("event", F.lit(1), found - 1)), F.lit(DATE_CHARS))
        return F.when(found > 0, F.struct(*(v.alias(k) for k, v in more.items()), at.alias("at"), text.alias("text")))

    listed = F.array(*map(F.lit, codes))
    foremost = F.get(F.filter(listed, lambda c: F.instr("event", F.concat(F.lit("~T"), c, F.lit("~"))) > 0), F.lit(0))
    out = rows.withColumn("_code", foremost)
    found = F.coalesce(F.instr("event", F.concat(F.lit("~T"), F.col("_code"), F.lit("~"))), F.lit(0))
    closure = mark(found, rank=F.array_position(listed, F.col("_code")), code=F.col("_code"))
    return out.withColumns({"closure": closure, **{f"at_{c}": mark(F.instr("event", _marker(c))) for c in HELD_CODES}})


def _summed(rows: DataFrame, place: Sequence[str]) -> DataFrame:
    where = F.struct(*place)

    def first(mark: str, *before: str) -> Column:
        fields = [*(F.col(f"{mark}.{b}").alias(b) for b in before), where.alias("place"), *(F.col(f"{mark}.{c}").alias(c) for c in ("at", "text"))]
        return F.min(F.when(F.col(mark).isNotNull(), F.struct(*fields))).alias(mark)

    tail = F.right(F.concat("_lead", "event"), F.lit(DATE_CHARS)).alias("tail")
    date = F.substr(last_event("event"), F.lit(1), F.lit(16)).alias("date")
    return rows.groupBy("PK").agg(
        F.count("*").alias("pieces"),
        F.bool_or(F.col("event") == NA).alias("sentinel"),
        F.min(where).alias("first_place"),
        F.max(F.struct(where.alias("place"), tail, date)).alias("last"),
        first("closure", "rank", "code"),
        *(first(f"at_{c}") for c in HELD_CODES),
        *(F.bool_or(F.instr("event", c) > 0).alias(f"has_{c}") for c in HELD_CODES),
    )


class _Rules:
    """Conditions shared by the two rule lists, over the columns ABM, SLT, DLS, DTS and a journey."""

    def __init__(self, journey: JourneyCell | JourneySummary, codes: Sequence[str], as_of: AsOf, days: int, date_length: int):
        self.journey = journey
        self.no_shipment = is_missing("ABM") & is_missing("SLT")
        self.shipment = F.col("ABM").isNotNull() | F.col("SLT").isNotNull()
        self.no_journey = journey.missing()
        self.nothing = self.no_shipment & self.no_journey
        self.journey_only = self.no_shipment & journey.present()
        held = [journey.mentions(c) for c in HELD_CODES]
        today = moment(as_of).cast("date")
        ages = [F.datediff(today, journey.before(c, date_length).try_cast("date")) > days for c in HELD_CODES]
        too_old = F.coalesce(ages[0], F.lit(False)) | F.coalesce(ages[1], F.lit(False))
        self.ignorable = ~(held[0] | held[1]) | too_old

        self.closures = [(self.shipment & there, status, date) for there, status, date in journey.closures(codes)]


def reclassified_status(
    codes: Sequence[str] = CLOSURE_CODES, *, as_of: AsOf, days: int = HELD_DAYS, journey: JourneyCell | JourneySummary | None = None
) -> Column:
    """Status from the stored families; first rule that holds wins. The journey is the cell PDJ unless given otherwise.

    The stored status is compared with the closure codes by its first three characters, so a value such as ``T123``
    compares as ``T12`` and never counts as a closure code. That is the established behaviour and is kept.
    """
    r = _Rules(journey or JourneyCell(F.col("PDJ")), codes, as_of, days, date_length=16)
    out = F.when(r.nothing, IGNORED)
    out = out.when(r.journey_only, F.when(r.ignorable, IGNORED).otherwise(UNDELIVERED))
    out = out.when(r.shipment & r.no_journey, NA)
    for there, status, _ in r.closures:
        out = out.when(there, status)
    dls = F.col("DLS")
    open_status = dls.isNull() | ~F.substr(dls, F.lit(1), F.lit(3)).isin(list(codes)) | dls.isin(IGNORED, NA)
    return or_na(out.when(r.shipment & open_status, UNDELIVERED).otherwise(dls))


def reclassified_date(
    codes: Sequence[str] = CLOSURE_CODES, *, as_of: AsOf, days: int = HELD_DAYS, journey: JourneyCell | JourneySummary | None = None
) -> Column:
    """Status date from the stored families; first rule that holds wins."""
    r = _Rules(journey or JourneyCell(F.col("PDJ")), codes, as_of, days, date_length=10)
    now = minute_text(as_of)
    last_date = r.journey.last_date()
    out = F.when(r.nothing, now).when(r.journey_only, F.when(r.ignorable, now).otherwise(last_date))
    for there, _, date in r.closures:
        out = out.when(there, date)
    return or_na(out.when(r.shipment & r.journey.present(), last_date).otherwise(F.col("DTS")))


def reclassify(
    pl: DataFrame,
    codes: Sequence[str] = CLOSURE_CODES,
    *,
    as_of: AsOf,
    days: int = HELD_DAYS,
    keep: Sequence[str] = (),
    journey: JourneyCell | JourneySummary | None = None,
) -> DataFrame:
    """``(PK, DLS, DTS)`` of every persistent row, both re-derived; stored columns to keep come as ``old_<name>``."""
    return pl.select(
        "PK",
        reclassified_status(codes, as_of=as_of, days=days, journey=journey).alias("DLS"),
        reclassified_date(codes, as_of=as_of, days=days, journey=journey).alias("DTS"),
        *(F.col(c).alias(f"old_{c}") for c in keep),
    )


def as_stamp(as_of: datetime | date) -> int:
    """``yyyyMMddHHmmss`` as a number."""
    return int(as_of.strftime("%Y%m%d%H%M%S"))
