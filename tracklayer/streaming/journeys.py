"""Journeys that grow in Spark's own state: one list of events per key, appended by a stream and read back as rows.

The query's state store holds each key's events with the time of the micro-batch that brought them, which Spark notes before
it runs and keeps when it runs again; no other table is written. Within a micro-batch equal events of a key count once. A hot key is spread over `spread` lists by its events'
hash, which equal events share, so no task holds a whole key. ``read_journeys`` reads the lists through the state data
source, one row for each event, and ``render_journeys`` glues them where one cell per key is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tracklayer.layouts import EVENT_SEP

#: Lists a key's events are spread over.
SPREAD = 16
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "journey"
_ELEMENT = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("event", T.StringType())])
_ADDED = T.StructType([T.StructField("PK", T.StringType()), T.StructField("added", T.LongType())])


class _Append(StatefulProcessor):
    """Appends a micro-batch's distinct events of a key to the key's list."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.events = handle.getListState(_STATE, _ELEMENT)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timer_values) -> Iterator[Row]:  # noqa: N802
        fresh = sorted({(r.at, r.event) for r in rows})  # one time, that of the micro-batch
        self.events.appendList(fresh)
        yield Row(PK=key[0], added=len(fresh))

    def close(self) -> None:
        pass


def start_journeys(
    events: DataFrame, output: str, *, checkpoint: str, trigger: Mapping[str, object] | None = None, spread: int = SPREAD
) -> StreamingQuery:
    """Grow journeys from a stream of ``(PK, event)``; what each micro-batch added to a key's lists goes to ``output``.

    Rows without a key or an event add nothing. The session must use the RocksDB state store.
    """
    spark = events.sparkSession
    if spark.conf.get(PROVIDER) != ROCKSDB:
        raise ValueError(f"{PROVIDER} must be {ROCKSDB}")
    rows = events.filter(F.col("PK").isNotNull() & F.col("event").isNotNull())
    keyed = rows.select("PK", F.pmod(F.xxhash64("event"), F.lit(spread)).cast("int").alias("list"), F.current_timestamp().alias("at"), "event")
    grown = keyed.groupBy("PK", "list").transformWithState(_Append(), _ADDED, "Append", "None")
    writer = grown.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "300 seconds"})).start()


def read_journeys(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``(PK, at, event)`` rows of the journeys as of the last micro-batch, or of the given one."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", _STATE)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load().select("key.PK", "list_element.at", "list_element.event")


def render_journeys(rows: DataFrame) -> DataFrame:
    """``(PK, CT_COL)``: events in order of micro-batch and text, joined."""
    ordered = F.sort_array(F.collect_list(F.struct("at", "event")))
    return rows.groupBy("PK").agg(F.array_join(F.transform(ordered, lambda e: e["event"]), EVENT_SEP).alias("CT_COL"))
