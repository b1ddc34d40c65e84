"""Structured Streaming jobs: change feed -> layers, and change feed -> landed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracklayer.layouts import SOURCE_TABLES, Layout
from tracklayer.operators.status import CLOSURE_CODES, as_stamp
from tracklayer.plans.bundle import build_bundle
from tracklayer.plans.layers import Layers
from tracklayer.sources import paths
from tracklayer.sources.feed import demultiplex, landed_schema, parse, refused, route, routing_counts
from tracklayer.sources.landing import read_parquet_or_none
from tracklayer.sources.masters import Masters

BATCH_SECONDS = 300
WRITER = "stream"


def batch_time(spark: SparkSession, folder: str, batch_id: int, clock: Callable[[], datetime]) -> datetime:
    """Processing time of a micro-batch: noted when it first runs, read back when it is replayed."""
    path = f"{folder}/batch={batch_id}"
    noted = read_parquet_or_none(spark, path)
    row = noted.first() if noted is not None else None
    if row:
        return datetime.strptime(row[0], "%Y-%m-%d %H:%M:%S")
    now = clock().replace(microsecond=0, tzinfo=None)
    text = now.strftime("%Y-%m-%d %H:%M:%S")
    spark.range(1).select(F.lit(text).alias("t")).coalesce(1).write.mode("overwrite").parquet(path)
    return now


def _present(routed: DataFrame, layouts: Mapping[str, Layout], tables: Mapping[str, str], dead: str) -> list[str]:
    """Known source tables that occur in a micro-batch; each needs a layout. Refused envelopes go to `dead`."""
    kinds = {(r[0], r[1]) for r in routed.select(F.when(F.col("_refused").isNull(), F.col("_table")), "_refused").distinct().collect()}
    present = sorted(t for t, why in kinds if why is None)  # at most the known tables
    if missing := [t for t in present if tables[t] not in layouts]:
        raise ValueError(f"no layout for {missing}")
    if any(why for _, why in kinds):
        refused(routed).write.mode("overwrite").parquet(dead)
    return present


def _routed(feed: DataFrame, tables: Mapping[str, str]) -> DataFrame:
    """The feed parsed once, with counts of what is refused in the query's progress, under ``routing``."""
    return route(feed, tables).observe("routing", *routing_counts())


def _start(stream: DataFrame, handle, checkpoint: str, trigger: Mapping[str, object] | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": f"{BATCH_SECONDS} seconds"})).start()


def start_ingest(
    feed: DataFrame,
    layers: Layers,
    layouts: Mapping[str, Layout],
    masters: Masters | Callable[[], Masters],
    *,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    tables: Mapping[str, str] = SOURCE_TABLES,
    codes: Sequence[str] = CLOSURE_CODES,
    keep_status: bool = False,
    clock: Callable[[], datetime] = datetime.now,
) -> StreamingQuery:
    """Merge every micro-batch of envelopes into the layers.

    Each envelope is parsed once, whatever number of tables the feed has; those no table takes in go to ``refused`` below
    the layers' root. Deletes, scrubbing, journeys and load stamps are those of the batch job. A replayed micro-batch keeps its time and
    is skipped where it was merged before. Failures stop the query; the checkpoint lets it go on from there. Masters
    given as a function are read anew for each micro-batch.
    """

    def handle(values: DataFrame, batch_id: int) -> None:
        spark = values.sparkSession
        now = batch_time(spark, f"{layers.root}/batch_time", batch_id, clock)
        values = values.persist()
        try:
            present = _present(values, layouts, tables, f"{layers.root}/refused/batch={batch_id}")
            changes = demultiplex(values, layouts, F.lit(as_stamp(now)), {t: tables[t] for t in present})
            known = masters() if callable(masters) else masters
            layers.apply(
                build_bundle(changes, layouts, known),
                known,
                as_of=now,
                batch_id=batch_id,
                writer=WRITER,
                codes=codes,
                keep_status=keep_status,
            )
            paths.remove(spark, f"{layers.root}/batch_time/batch={batch_id - 1}")
        finally:
            values.unpersist()

    return _start(_routed(feed, tables), handle, checkpoint, trigger)


def start_landing(
    feed: DataFrame,
    landing: str,
    layouts: Mapping[str, Layout],
    *,
    checkpoint: str,
    times: str,
    trigger: Mapping[str, object] | None = None,
    tables: Mapping[str, str] = SOURCE_TABLES,
    clock: Callable[[], datetime] = datetime.now,
) -> StreamingQuery:
    """Land every micro-batch as parquet, one directory per table and load stamp, for the batch job to pick up.

    Below the stamp each micro-batch has a directory of its own, so those of one second stand side by side, and a
    replayed one overwrites itself and nothing else. A known table without a layout is an error; envelopes no table takes in
    land in ``refused``.
    """

    def handle(values: DataFrame, batch_id: int) -> None:
        now = batch_time(values.sparkSession, times, batch_id, clock)
        values = values.persist()
        try:
            for table in _present(values, layouts, tables, f"{landing}/refused/batch={batch_id}"):
                rows = parse(values.filter(F.col("_table") == table), layouts[tables[table]]).drop("pos")
                rows.write.mode("overwrite").parquet(f"{landing}/{table}/load_ts={as_stamp(now)}/b{batch_id}")
            paths.remove(values.sparkSession, f"{times}/batch={batch_id - 1}")
        finally:
            values.unpersist()

    return _start(_routed(feed, tables), handle, checkpoint, trigger)


def start_landed_ingest(
    spark: SparkSession,
    landing: str,
    layers: Layers,
    family: str,
    layouts: Mapping[str, Layout],
    masters: Masters,
    *,
    checkpoint: str,
    archive: str | None = None,
    trigger: Mapping[str, object] | None = None,
    codes: Sequence[str] = CLOSURE_CODES,
    keep_status: bool = True,
    clock: Callable[[], datetime] = datetime.now,
    **options: str,
) -> StreamingQuery:
    """Merge a landed table into the layers as files arrive; the checkpoint is the watermark.

    With ``archive`` the source moves consumed files there by itself. One table brings no status of the others, so the
    stored status is kept unless ``keep_status`` is turned off.
    """
    if archive:
        options = {"cleanSource": "archive", "sourceArchiveDir": archive, **options}
    schema = landed_schema(layouts[family])
    stream = spark.readStream.schema(schema).options(**options).parquet(landing)

    writer = f"landed-{family}"

    def handle(rows: DataFrame, batch_id: int) -> None:
        now = batch_time(spark, f"{layers.root}/{writer}_time", batch_id, clock)
        rows = rows.persist()
        try:
            bundle = build_bundle({family: rows}, layouts, masters)
            known = {"codes": codes, "keep_status": keep_status}
            layers.apply(bundle, masters, as_of=now, batch_id=batch_id, writer=writer, **known)
            paths.remove(spark, f"{layers.root}/{writer}_time/batch={batch_id - 1}")
        finally:
            rows.unpersist()

    return _start(stream, handle, checkpoint, trigger)
