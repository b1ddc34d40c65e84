"""Maintenance jobs over the stored layers: re-derived status, load-timestamp migration, alternate reload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklayer.functions.text import field
from tracklayer.layouts import NA
from tracklayer.operators.status import CLOSURE_CODES, HELD_DAYS, AsOf, JourneySummary, journey_summary, reclassify, reformat_lts
from tracklayer.plans.layers import Layers

ALTERNATE_FAMILIES = ("ALK", "SRT", "SRJ")


def _has_record(family: str):
    return field(family, 0) != NA


def reload_alt(pl: DataFrame, journey_filter: str = "SRT") -> DataFrame:
    """``(PK, ALK, SRT, SRJ)``: alternate families worth copying to the link table.

    The stored journey is copied where the instruction record (``journey_filter``) is real.
    """
    sources = {"ALK": "ALK", "SRT": "SRT", "SRJ": journey_filter}
    kept = {f: F.when(_has_record(by), F.col(f)).alias(f) for f, by in sources.items()}
    out = pl.select("PK", *kept.values())
    return out.filter(F.coalesce(*ALTERNATE_FAMILIES).isNotNull())


def run_cleanup(
    layers: Layers, *, as_of: AsOf, batch_id: int, codes: Sequence[str] = CLOSURE_CODES, days: int = HELD_DAYS
) -> bool:
    """Re-derive status and status date of every stored key; only what changed is written.

    Journeys are read as rows and summed up by key, so none is put in one cell.
    """
    pl = layers.persistent.read(["ABM", "SLT", "DLS", "DTS"], marks=["ABM", "SLT"])
    known = journey_summary(layers.persistent.journey_rows("PDJ"), codes)
    derived = reclassify(pl.join(known, "PK", "left"), codes, as_of=as_of, days=days, keep=["DLS", "DTS"], journey=JourneySummary())
    changed = ~(F.col("DLS").eqNullSafe(F.col("old_DLS")) & F.col("DTS").eqNullSafe(F.col("old_DTS")))
    return layers.persistent.upsert(derived.filter(changed), batch_id, "cleanup")


def run_reformat(layers: Layers, *, batch_id: int, prefix: str = "20190") -> bool:
    """Bring load timestamps that are still in the minute form to the current one."""
    changed = reformat_lts(layers.persistent.read(["LTS"]), prefix).withColumnRenamed("CT_COL", "LTS")
    return layers.persistent.upsert(changed, batch_id, "reformat")


def run_reload(layers: Layers, *, batch_id: int, journey_filter: str = "SRT") -> bool:
    """Copy alternate families from the persistent to the link table, replacing its journeys."""
    rows = reload_alt(layers.persistent.read(list(ALTERNATE_FAMILIES)), journey_filter)
    return layers.link.upsert(rows, batch_id, "reload", replace_journeys=True)
