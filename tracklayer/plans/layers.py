"""The layers a batch is merged into, and the merge of one bundle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklayer.layouts import Layout
from tracklayer.operators.cdc import pivot_families
from tracklayer.operators.status import CLOSURE_CODES, load_ts_text
from tracklayer.plans.bundle import RECORD_FAMILIES, ROUTES, latest_of
from tracklayer.plans.promote import batch_stamps, promote, promote_alternates
from tracklayer.plans.state import PARTS, StateTable
from tracklayer.session import concurrently, empty_frame, materialise
from tracklayer.sources import paths
from tracklayer.sources.masters import Masters


class Layers:
    """Incremental layer, keyed state tables and batch control below one root folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        layouts: Mapping[str, Layout],
        sentinel: str = "reference",
        parts: int = PARTS,
    ):
        self.spark, self.root, self.layouts = spark, root.rstrip("/"), dict(layouts)

        def table(name: str, latest: Sequence[str], journeys: Sequence[str] = (), parts: int = parts) -> StateTable:
            return StateTable(spark, f"{self.root}/{name}", latest, journeys, sentinel, parts)

        self.persistent = table(
            "persistent",
            [*(f for f in RECORD_FAMILIES), "SRT_AFLG", "DLS", "DTS", "LTS"],
            ["PDJ", "SFJ", "SRJ"],
        )
        self.link = table("link", ["ALK", "SRT", "SRT_AFLG"], ["SRJ"])
        self.pickup = table("pickup", ["CPS", "LTS"], ["CPJ"])
        self.contact = table("contact", ["ADT"])
        self.deleted = table("deleted", ["DEL"])
        self.control = table("control", ["PL"], parts=1)  # one row

    def tables(self) -> dict[str, StateTable]:
        return {
            "persistent": self.persistent,
            "link": self.link,
            "pickup": self.pickup,
            "contact": self.contact,
            "deleted": self.deleted,
            "batch_control": self.control,
        }

    def register_views(self, prefix: str = "") -> None:
        """Make the current state of every table queryable in SQL under its name."""
        for name, state in self.tables().items():
            state.read().createOrReplaceTempView(prefix + name)

    def incremental(self, bundle: Mapping[str, DataFrame]) -> DataFrame:
        """``PK`` and the latest record of each family of this batch, all families in one shuffle."""
        records = {f: bundle[f] for f in RECORD_FAMILIES if f in bundle}
        if not records:
            schema = T.StructType([T.StructField("PK", T.StringType())])
            return empty_frame(self.spark, schema)
        order = [c for c in ("op_ts", "pos") if any(c in df.columns for df in records.values())]
        even = {f: _with_columns(df, order) for f, df in records.items()}
        return pivot_families(even, order)

    def apply(
        self,
        bundle: Mapping[str, DataFrame],
        masters: Masters,
        *,
        as_of: datetime | str,
        batch_id: int,
        writer: str = "batch",
        codes: Sequence[str] = CLOSURE_CODES,
        keep_status: bool = False,
    ) -> bool:
        """Merge one bundle. False, and nothing done, if the writer's batch was merged before.

        Each table commits by itself and skips a batch it holds, so a run that died in between is finished by running
        it again. Batch control is written last.
        """
        unknown = bundle.keys() - ROUTES.keys()
        if unknown:
            raise ValueError(f"no route for {sorted(unknown)}")
        if self.control.committed(writer, batch_id):
            return False
        place = f"{self.root}/incremental/{writer}/{batch_id}"
        il = materialise(self.incremental(bundle), place)
        stamp = self._stamp(il)
        done = {"batch_id": batch_id, "writer": writer}

        plain = promote(
            il,
            self.layouts,
            masters,
            as_of=as_of,
            codes=codes,
            load_ts=F.lit(stamp).cast("string"),
            keep_status=keep_status,
        )
        instructions = promote_alternates(il, self.layouts) if "SRT" in il.columns else None
        journeys = [_journey(bundle[f], f) for f in ("PDJ", "SFJ") if f in bundle]
        deltas = {name: self._routed(name, bundle, il) for name in ("link", "pickup", "contact", "deleted")}
        deltas["link"].append(instructions)
        deltas["persistent"] = [*self._routed("persistent", bundle, il), plain, instructions, *journeys]
        stacked = {self.tables()[name]: _stack(frames) for name, frames in deltas.items()}
        jobs = [partial(t.upsert, df, **done) for t, df in stacked.items() if df is not None]
        concurrently(self.spark, *jobs)
        # Key 1 -> load timestamp. A batch without stamps leaves it, but is closed all the same.
        self.control.upsert(self.spark.range(1).select(F.lit("1").alias("PK"), F.lit(stamp).alias("PL")), **done)
        paths.remove(self.spark, place)
        return True

    def _routed(self, name: str, bundle: Mapping[str, DataFrame], il: DataFrame) -> list[DataFrame | None]:
        """Rows of the families that go to a table as they are."""
        table, out = self.tables()[name], []
        for family in bundle:
            if name in ROUTES[family]:
                if family in il.columns:
                    out.append(il.select("PK", family).filter(F.col(family).isNotNull()))
                else:
                    out.append((_journey if family in table.journeys else latest_of)(bundle[family], family))
        return out

    def _stamp(self, il: DataFrame) -> str | None:
        stamps = batch_stamps(il, self.layouts)
        return self.spark.range(1).select(load_ts_text(il, stamps)).first()[0] if stamps else None


def _with_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select("PK", "CT_COL", *(n if n in df.columns else F.lit(None).cast("string").alias(n) for n in names))


def _journey(rows: DataFrame, family: str) -> DataFrame:
    return rows.select("PK", F.col("CT_COL").alias(family))


def _stack(frames: Sequence[DataFrame | None]) -> DataFrame | None:
    """Rows of several frames side by side; the state folds them by key, so no join is needed."""
    out = None
    for df in frames:
        if df is not None:
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
