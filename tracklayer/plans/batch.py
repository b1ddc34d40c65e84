"""The incremental batch job: note the due files, transform, merge, archive, move the watermark, drop the manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tracklayer.layouts import SOURCE_TABLES, Layout
from tracklayer.operators.status import CLOSURE_CODES, as_stamp
from tracklayer.plans.bundle import build_bundle
from tracklayer.plans.layers import Layers
from tracklayer.sources import paths
from tracklayer.sources.feed import landed_schema
from tracklayer.sources.landing import SAFETY_LAG_SECONDS, due_stamps
from tracklayer.sources.masters import Masters

WRITER = "batch"
MANIFEST = "table string, load_ts long, file string"


@dataclass(frozen=True)
class BatchConfig:
    """Folders of the batch protocol. Each holds one directory per source table."""

    landing: str
    staging: str
    last: str
    archive: str
    layouts: Mapping[str, Layout]
    tables: Mapping[str, str] = field(default_factory=lambda: dict(SOURCE_TABLES))
    lag_seconds: int = SAFETY_LAG_SECONDS
    codes: Sequence[str] = tuple(CLOSURE_CODES)
    keep_status: bool = False

    def sources(self) -> dict[str, str]:
        """Family -> table directory, for families with a layout."""
        return {f: t for t, f in self.tables.items() if f in self.layouts}


def newest_done(spark: SparkSession, config: BatchConfig, table: str) -> int | None:
    """The watermark of a table: the newest load stamp it was taken in up to, kept as a folder's name."""
    stamps = [int(n.removeprefix("load_ts=")) for n in paths.child_names(spark, f"{config.last}/{table}") if n.startswith("load_ts=")]
    return max(stamps, default=None)


def stage_batch(spark: SparkSession, config: BatchConfig, as_of: datetime) -> int | None:
    """Note which files of every table are due, as a manifest; its number, or None if nothing is due.

    The files stay where they landed: nothing is copied or shuffled to be staged. A file that lands in a due partition
    afterwards does not belong to the batch.
    """
    batch_id = as_stamp(as_of)
    unknown = [t for t, f in config.tables.items() if f not in config.layouts]
    if landed := [t for t in unknown if paths.child_names(spark, f"{config.landing}/{t}")]:
        raise ValueError(f"no layout for {landed}")
    rows = []
    for table in config.sources().values():
        folder = f"{config.landing}/{table}"
        for stamp in due_stamps(spark, folder, newest_done(spark, config, table), as_of, config.lag_seconds):
            rows += [(table, stamp, file) for file in paths.files_below(spark, f"{folder}/load_ts={stamp}")]
    if not rows:
        return None
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{config.staging}/{batch_id}")
    return batch_id


def unfinished_batch(spark: SparkSession, config: BatchConfig) -> int | None:
    """A batch whose manifest an earlier run left behind; manifests written in part are dropped."""
    for name in paths.child_names(spark, config.staging):
        if paths.exists(spark, f"{config.staging}/{name}/_SUCCESS"):
            return int(name)
        paths.remove(spark, f"{config.staging}/{name}")
    return None


def read_manifest(spark: SparkSession, config: BatchConfig, batch_id: int) -> dict[str, dict[int, list[str]]]:
    """Table -> load stamp -> files of a batch. As many rows as files, which whoever reads them lists on the driver too."""
    out: dict[str, dict[int, list[str]]] = {}
    for row in spark.read.schema(MANIFEST).parquet(f"{config.staging}/{batch_id}").sort("table", "load_ts", "file").collect():
        out.setdefault(row.table, {}).setdefault(row.load_ts, []).append(row.file)
    return out


def staged_changes(spark: SparkSession, config: BatchConfig, manifest: Mapping[str, Mapping[int, list[str]]]) -> dict[str, DataFrame]:
    changes = {}
    for family, table in config.sources().items():
        if table in manifest:
            files = [f for stamp in manifest[table].values() for f in stamp]
            reader = spark.read.schema(landed_schema(config.layouts[family])).option("basePath", f"{config.landing}/{table}")
            df = reader.parquet(*files)
            changes[family] = df.toDF(*(c.lower() for c in df.columns))
    return changes


def archive_batch(spark: SparkSession, config: BatchConfig, table: str, stamps: Mapping[int, Sequence[str]]) -> list[int]:
    """Move consumed files to the archive, a partition as a whole where nothing else landed in it; the stamps moved.

    What was moved already is skipped.
    """
    moved = []
    for stamp, files in stamps.items():
        source, target = (f"{root}/{table}/load_ts={stamp}" for root in (config.landing, config.archive))
        if not paths.exists(spark, source):
            continue
        if set(paths.files_below(spark, source)) <= set(files) and not paths.exists(spark, target):
            paths.move(spark, source, target)
        else:
            for file in files:
                paths.move(spark, file, f"{target}/{file.split(f'load_ts={stamp}/')[-1]}")
        moved.append(stamp)
    return moved


def run_batch(
    spark: SparkSession, config: BatchConfig, layers: Layers, masters: Masters, as_of: datetime
) -> int | None:
    """One run; its batch number, or None if nothing was due.

    A run that died after staging is finished first, from its own manifest and under its own number and time, which the
    layers recognise. So every landed row is merged exactly once.
    """
    batch_id = unfinished_batch(spark, config)
    if batch_id is None:
        batch_id = stage_batch(spark, config, as_of)
    if batch_id is None:
        return None
    manifest = read_manifest(spark, config, batch_id)
    if not layers.control.committed(WRITER, batch_id):
        layers.apply(
            build_bundle(staged_changes(spark, config, manifest), config.layouts, masters),
            masters,
            as_of=datetime.strptime(str(batch_id), "%Y%m%d%H%M%S"),
            batch_id=batch_id,
            writer=WRITER,
            codes=config.codes,
            keep_status=config.keep_status,
        )
    for table, stamps in manifest.items():
        archive_batch(spark, config, table, stamps)
        before = newest_done(spark, config, table)
        if before != max(stamps):
            paths.make(spark, f"{config.last}/{table}/load_ts={max(stamps)}")
            if before is not None:
                paths.remove(spark, f"{config.last}/{table}/load_ts={before}")
    paths.remove(spark, f"{config.staging}/{batch_id}")
    return batch_id
