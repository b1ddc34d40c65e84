"""Column expressions for the sentinel, delimiter and date-text conventions of encoded records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklayer.layouts import EVENT_SEP, FIELD_SEP, NA

MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
STAMP_FORMAT = "yyyyMMddHHmmss"
MINUTE_STAMP_FORMAT = "yyyyMMddHHmm"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_na(c: Column | str) -> Column:
    """The value as text, or the sentinel."""
    return F.coalesce(col(c).cast("string"), F.lit(NA))


def or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def is_missing(c: Column | str) -> Column:
    """NULL or the sentinel; never NULL itself."""
    return F.coalesce(col(c) == NA, F.lit(True))


def scrubbed(c: Column | str) -> Column:
    """Without the two delimiters."""
    return F.translate(col(c), FIELD_SEP + EVENT_SEP, "")


def record(fields: Iterable[Column]) -> Column:
    return F.concat_ws(FIELD_SEP, *fields)


def field(encoded: Column | str, position: int) -> Column:
    """Field of an encoded record, NULL past its end."""
    return F.get(F.split(col(encoded), FIELD_SEP), F.lit(position))


def last_event(journey: Column | str) -> Column:
    return F.substring_index(col(journey), EVENT_SEP, -1)


def restamped(c: Column | str, source: str, target: str = SECOND_FORMAT) -> Column:
    """Date text re-formatted; NULL where it does not parse."""
    return F.date_format(F.try_to_timestamp(col(c).cast("string"), F.lit(source)), target)
