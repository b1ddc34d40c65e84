"""Journeys in the state of a streaming query."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tracklayer.streaming.journeys import PROVIDER, ROCKSDB, read_journeys, render_journeys, start_journeys

SCHEMA = "PK string, event string"


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    yield
    spark.conf.set(PROVIDER, before)


def test_journeys_grow_over_restarts(spark, tmp_path, rocksdb):
    """A hot key, copies within and between batches, rows without key or event."""
    rng = random.Random(1)
    batches = [[(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *"abcdefghij"])) for _ in range(60)] for _ in range(3)]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").json(str(tmp_path / "in"))
        events = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
        start_journeys(events, str(tmp_path / "out"), checkpoint=str(tmp_path / "state"), trigger={"availableNow": True}, spread=4).awaitTermination()
    wanted = {}
    for rows in batches:
        for key in {k for k, e in rows if k and e}:
            wanted.setdefault(key, []).extend(sorted({e for k, e in rows if k == key and e}))
    rows = read_journeys(spark, str(tmp_path / "state"))
    assert {r.PK: r.CT_COL for r in render_journeys(rows).collect()} == {k: "|".join(v) for k, v in wanted.items()}
    earlier = read_journeys(spark, str(tmp_path / "state"), batch=0)
    assert earlier.count() == len({(k, e) for k, e in batches[0] if k and e})
    added = spark.read.parquet(str(tmp_path / "out"))
    assert added.agg(F.sum("added")).first()[0] == rows.count()
    assert added.filter("PK = 'hot'").count() > 3  # several lists a batch


def test_the_session_must_use_the_right_store(spark, tmp_path):
    events = spark.readStream.schema(SCHEMA).json(str(tmp_path))
    with pytest.raises(ValueError, match="RocksDB"):
        start_journeys(events, str(tmp_path / "out"), checkpoint=str(tmp_path / "state"))
