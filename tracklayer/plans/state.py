"""Keyed state on plain parquet: latest records hash-partitioned by key, journeys as rows of their batches.

A row key holds one *latest* column per family (last write wins, a family absent from a batch stays untouched) and one
*journey* column per growing family (batches append).

Records lie in ``part=<n>`` folders, one row per key, the part being a hash of the key. An upsert is one plain job: it joins
the batch with the parts its keys fall in and writes those parts anew; all other parts keep their files, and reading is a
scan without a shuffle. The new parts are complete before the first one is put in place; from then on the batch counts, and
if its run dies the next upsert of whichever writer puts the rest in place.

Journeys are rows, one for each event, below their writer and batch, range-partitioned and sorted by key and event, so a
hot key spreads over many files. They are put in one cell only for a reader who asks for that form. A batch tried again
overwrites its own rows; rows are visible once the batch is through. What each writer has applied is a folder name.
Batches of one writer come in order, and one process at a time upserts a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklayer.functions.text import is_missing
from tracklayer.layouts import EVENT_SEP, NA
from tracklayer.operators.journey import sorted_runs
from tracklayer.session import empty_frame
from tracklayer.sources import paths

#: Parts of a table; chosen so that one part is a few hundred megabytes, and kept for the table's life (see ``resized``).
PARTS = 16


class StateTable:
    """One keyed table of family columns.

    ``sentinel`` says what a stored journey equal to the sentinel is worth when events are appended to it:
    ``reference`` keeps it as text, ``strict`` treats it as nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        latest: Sequence[str],
        journeys: Sequence[str] = (),
        sentinel: str = "reference",
        parts: int = PARTS,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.latest, self.journeys = tuple(latest), tuple(journeys)
        self.sentinel, self.parts = sentinel, parts

    @property
    def families(self) -> tuple[str, ...]:
        return self.latest + self.journeys

    @property
    def records_path(self) -> str:
        return f"{self.path}/records-{self.parts}"

    def _stored(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_frame(self.spark, schema)

    def applied(self) -> dict[str, tuple[int, int]]:
        """Each writer's last batch and its number in the order of all batches."""
        out = {}
        for writer in paths.child_names(self.spark, f"{self.path}/applied"):
            names = paths.child_names(self.spark, f"{self.path}/applied/{writer}")
            out[writer.removeprefix("writer=")] = max(tuple(int(x) for x in n.split("-")) for n in names)
        return out

    def committed(self, writer: str, batch_id: int) -> bool:
        """Whether the writer applied this batch or a later one."""
        return self.applied().get(writer, (-1, 0))[0] >= batch_id

    def upsert(self, delta: DataFrame, batch_id: int, writer: str = "batch", replace_journeys: bool = False) -> bool:
        """Merge a batch: ``PK`` and any of the families.

        A key may have several rows, at most one of which sets a given latest family; journey columns hold one event a
        row. Where there are any, a row without a record and an event adds no key. ``replace_journeys`` makes the batch's journeys replace stored ones. False if this writer applied the batch
        (or a later one) before.
        """
        for dead in paths.child_names(self.spark, f"{self.path}/pending"):
            self._finish(dead)
        applied = self.applied()
        if applied.get(writer, (-1, 0))[0] >= batch_id:
            return False
        place = f"{self.path}/journeys/writer={writer}/batch={batch_id}"
        number = 1 + max((n for _, n in applied.values()), default=0)
        brought = [f for f in self.journeys if f in delta.columns]
        if brought:
            paths.remove(self.spark, place)  # of a run that died
            self._append(delta, brought, replace_journeys, f"{place}/number={number}")
        keys = self._stored(place, T.StructType([T.StructField("PK", T.StringType())])) if brought else None
        self._prepare(delta, keys, f"{writer}-{batch_id}-{number}")
        self._finish(f"{writer}-{batch_id}-{number}")
        return True

    def _append(self, delta: DataFrame, families: Sequence[str], replaces: bool, path: str) -> None:
        each = [F.struct(F.lit(f).alias("family"), F.col(f).cast("string").alias("event")) for f in families]
        events = delta.select("PK", F.explode(F.array(*each)).alias("e")).select("e.family", "PK", "e.event")
        runs = sorted_runs(events.filter(F.col("event").isNotNull()), ["family", "PK", "event"])
        runs.withColumn("replaces", F.lit(replaces)).write.mode("overwrite").partitionBy("family").parquet(path)

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("PK"), F.lit(self.parts)).cast("int").alias("part")

    def _prepare(self, delta: DataFrame, keys: DataFrame | None, name: str) -> None:
        """Write the parts that the batch touches, merged with it. `keys` are those that journeys bring."""
        pending = f"{self.path}/pending/{name}"
        brought = [f for f in self.latest if f in delta.columns]
        rows = delta.select("PK", *(F.col(f).cast("string").alias(f) for f in brought))
        if keys is not None:
            has_record = F.coalesce(*(F.col(f) for f in brought)).isNotNull() if brought else F.lit(False)
            rows = rows.filter(has_record).unionByName(keys.distinct(), allowMissingColumns=True)
        folded = rows.withColumn("part", self._part()).repartition("part").groupBy("part", "PK")
        folded = folded.agg(*(F.max(f).alias(f) for f in brought)) if brought else folded.agg(F.lit(0)).select("part", "PK")
        if not paths.exists(self.spark, self.records_path):  # nothing to merge with yet
            everything = folded.select("PK", *(F.col(f) if f in brought else F.lit(None).cast("string").alias(f) for f in self.latest), "part")
            everything.write.mode("overwrite").partitionBy("part").parquet(f"{pending}/new")
            return
        folded.write.mode("overwrite").partitionBy("part").parquet(f"{pending}/delta")
        touched = [int(n.removeprefix("part=")) for n in paths.child_names(self.spark, f"{pending}/delta") if n.startswith("part=")]
        fresh = self.spark.read.schema(_records(brought)).parquet(f"{pending}/delta")
        stored = self._stored(self.records_path, _records(self.latest)).filter(F.col("part").isin(touched))
        merged = merge(stored.repartition("part"), fresh.repartition("part"), self.latest, ["part", "PK"])
        merged.write.mode("overwrite").partitionBy("part").parquet(f"{pending}/new")

    def _finish(self, name: str) -> None:
        """Put new parts in place of the old ones and note the batch, or drop what was not prepared in full.

        A run that died here left parts that are in place already, or lack the old one: the rest goes on from there.
        """
        pending = f"{self.path}/pending/{name}"
        if paths.exists(self.spark, f"{pending}/new/_SUCCESS"):
            for part in paths.child_names(self.spark, f"{pending}/new"):
                if part.startswith("part="):
                    paths.remove(self.spark, f"{self.records_path}/{part}")
                    paths.move(self.spark, f"{pending}/new/{part}", f"{self.records_path}/{part}")
            writer, batch, number = name.rsplit("-", 2)
            done = f"{self.path}/applied/writer={writer}"
            before = paths.child_names(self.spark, done)
            paths.make(self.spark, f"{done}/{batch}-{number}")
            for old in before:
                if old != f"{batch}-{number}":
                    paths.remove(self.spark, f"{done}/{old}")
        paths.remove(self.spark, pending)

    def read(self, families: Sequence[str] | None = None, marks: Sequence[str] = ()) -> DataFrame:
        """One row per key with the chosen families. Records are scanned and not shuffled.

        Families named in ``marks`` are wanted for their presence only: a real record is read as ``*``, so that long
        records are not shuffled to learn whether they are there. A journey is one cell here; ``journey_rows`` has no
        such limit.
        """
        wanted = [f for f in self.families if families is None or f in families]
        latest = [f for f in wanted if f in self.latest]
        records = self._stored(self.records_path, _records(self.latest)).select("PK", *latest)
        marked = {f: F.when(F.col(f) == NA, NA).when(F.col(f).isNotNull(), "*") for f in latest if f in marks}
        records = records.withColumns(marked) if marked else records
        for family in wanted:
            if family in self.journeys:
                records = records.join(self._cells(family), "PK", "left")
        return records.select("PK", *wanted)

    def _cells(self, family: str) -> DataFrame:
        ordered = F.sort_array(F.collect_list(F.struct("number", "writer", "event")))
        text = F.array_join(F.transform(ordered, lambda e: e["event"]), EVENT_SEP)
        return self.journey_rows(family).groupBy("PK").agg(text.alias(family))

    def journey_rows(self, family: str) -> DataFrame:
        """``(PK, number, writer, event)``: a journey as rows in order of ``(number, writer, event)``, without grouping.

        Rows that a later batch replaced, and in ``strict`` mode sentinels, are left out.
        """
        strings = [T.StructField(c, T.StringType()) for c in ("PK", "event", "writer", "family")]
        longs = [T.StructField(c, T.LongType()) for c in ("batch", "number")]
        schema = T.StructType([*strings[:2], T.StructField("replaces", T.BooleanType()), *strings[2:], *longs])
        rows = self._stored(f"{self.path}/journeys", schema).filter(F.col("family") == family)
        through = [(F.col("writer") == w) & (F.col("batch") <= b) for w, (b, _) in self.applied().items()]
        rows = rows.filter(reduce(Column.__or__, through, F.lit(False)))
        if self.sentinel == "strict":
            rows = rows.filter(~is_missing("event"))
        replaced = rows.filter("replaces").groupBy("PK").agg(F.max("number").alias("since"))
        rows = rows.join(replaced, "PK", "left").filter(F.col("since").isNull() | (F.col("number") >= F.col("since")))
        return rows.select("PK", "number", "writer", "event")

    def resized(self, parts: int) -> StateTable:
        """The table with its records dealt to another number of parts, for when parts have grown too large or small.

        The old parts stay until the caller, who then uses the returned table, drops them.
        """
        if parts == self.parts:
            return self
        other = StateTable(self.spark, self.path, self.latest, self.journeys, self.sentinel, parts)
        rows = self._stored(self.records_path, _records(self.latest)).withColumn("part", other._part())
        rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(other.records_path)
        return other


def _records(families: Sequence[str]) -> T.StructType:
    strings = [T.StructField(c, T.StringType()) for c in ("PK", *families)]
    return T.StructType([*strings, T.StructField("part", T.IntegerType())])


def merge(base: DataFrame, delta: DataFrame, families: Sequence[str], keys: Sequence[str] = ("PK",)) -> DataFrame:
    """Keyed upsert of two wide frames: delta values win, families and keys missing from the delta stay."""
    joined = base.alias("b").join(delta.alias("d"), [F.col(f"b.{k}") == F.col(f"d.{k}") for k in keys], "full")
    both = [F.coalesce(f"d.{c}", f"b.{c}").alias(c) if c in delta.columns else F.col(f"b.{c}") for c in (*keys, *families)]
    return joined.select(*both)


def delete_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``PK`` is not among the given keys."""
    return df.join(keys.select("PK").distinct(), "PK", "left_anti")
