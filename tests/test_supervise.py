"""Streams that fail are started again; dead letters and rate limits."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tracklayer.layouts import Layout
from tracklayer.plans.layers import Layers
from tracklayer.sources import paths
from tracklayer.sources.feed import demultiplex, layout_from_feed, read_feed, refused, route
from tracklayer.sources.landing import write_partitions
from tracklayer.sources.masters import no_masters
from tracklayer.streaming.ingest import start_landed_ingest, start_landing
from tracklayer.streaming.supervise import run_supervised

LAYOUTS = {"IBS": Layout("IBS", ("cawbno", "cstatcode", "cstattype", "dstatdate", "cloccode", "cemplcode"), trim_first=True)}
NOW = datetime(2019, 8, 15, 9, 30)


def envelope(key, table="DB.INBOUNDSTATUSREMARK", **after):
    return json.dumps({"after": {"cawbno": key, **after}, "op_ts": "2019-08-01", "op_type": "I", "pos": "1", "table": table})


def test_parsed_once_and_refused(spark):
    values = [envelope("a", cstatcode=" x~"), envelope("b", "DB.OTHER"), "{broken", "", None, "[1]", envelope("c", "AWBLINK")]
    routed = route(spark.createDataFrame([(v,) for v in values], "value string"))
    assert sorted(r.reason for r in refused(routed).collect()) == ["malformed"] * 3 + ["unknown table"] * 2
    rows = demultiplex(routed, LAYOUTS)["IBS"]
    assert [(r.cawbno, r.cstatcode, r.cloccode, r.op_type) for r in rows.collect()] == [("a", " x~", None, "I")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "JsonToStructs" not in plan


def test_layout_from_an_unstated_table(spark):
    fields = {f"c{i:03d}": "v" for i in range(218)}
    values = spark.createDataFrame([(envelope("a", "SHIPCLT", **dict(list(fields.items())[:9])),), (envelope("b", "SHIPCLT", **fields),)], "value string")
    layout = layout_from_feed(values, "SHIPCLT", "SLT")
    assert layout.fields == ("cawbno", *fields) and layout.trim_first
    with pytest.raises(ValueError, match="names its columns"):
        layout_from_feed(values, "AWBMST", "ABM")


def landing(spark, root, fail):
    feed = read_feed(spark, "text", path=f"{root}/feed", maxFilesPerTrigger="1")
    left = iter(fail)

    def clock():
        if next(left, False):
            raise RuntimeError("no time")
        return NOW

    return lambda: start_landing(
        feed, f"{root}/landing", LAYOUTS, checkpoint=f"{root}/checkpoint", times=f"{root}/times", trigger={"availableNow": True}, clock=clock
    )


def test_a_failed_batch_is_run_again(spark, tmp_path):
    for i in range(3):
        values = [envelope(f"k{i}"), "broken"] if i == 1 else [envelope(f"k{i}")]
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "feed"))
    notes = run_supervised(spark, landing(spark, tmp_path, [False, True, True, False, True]), restarts=2, wait_seconds=0.01)
    assert {r.cawbno for r in spark.read.parquet(f"{tmp_path}/landing/INBOUNDSTATUSREMARK").collect()} == {"k0", "k1", "k2"}
    assert spark.read.parquet(f"{tmp_path}/landing/refused").count() == 1
    table = notes.table(spark)
    assert notes.failures == 3 and table.filter("kind = 'start'").count() == 4
    batches = table.filter("kind = 'batch' AND rows > 0")
    assert sorted(r.batch for r in batches.collect()) == [0, 1, 2]
    seen = batches.select(F.sum(F.get_json_object("observed", "$.routing.seen").cast("int"))).first()[0]
    assert seen == batches.agg(F.sum("rows")).first()[0] == 4


def test_it_gives_up(spark, tmp_path):
    spark.createDataFrame([(envelope("k"),)], "value string").write.text(str(tmp_path / "feed"))
    with pytest.raises(StreamingQueryException, match="no time"):
        run_supervised(spark, landing(spark, tmp_path, [True] * 9), restarts=1, wait_seconds=0.01)


def test_rate_limited_files_are_archived(spark, tmp_path):
    """Three files, one a micro-batch, over two starts; the source moves what later batches have left behind."""
    layers = Layers(spark, str(tmp_path / "layers"), LAYOUTS)

    def run(days):
        for d in days:
            row = ("k", "001", "T", f"2019-08-0{d} 10:00:00", None, None, f"2019-08-0{d} 10:00:00", "I", 20190800000000 + d * 1000000)
            write_partitions(spark.createDataFrame([row], LAYOUTS["IBS"].landed_schema()), f"{tmp_path}/landing", "append")
        start_landed_ingest(
            spark,
            f"{tmp_path}/landing",
            layers,
            "IBS",
            LAYOUTS,
            no_masters(spark),
            checkpoint=f"{tmp_path}/checkpoint",
            archive=f"{tmp_path}/archive",
            trigger={"availableNow": True},
            clock=lambda: NOW,
            maxFilesPerTrigger="1",
        ).awaitTermination()

    run([1, 2])
    run([3])
    (row,) = layers.persistent.read(["IBS", "PDJ"]).collect()
    assert [e[8:10] for e in row.PDJ.split("|")] == ["01", "02", "03"] and "2019-08-03" in row.IBS
    archived = [f.rsplit("load_ts=")[1][:8] for f in paths.files_below(spark, f"{tmp_path}/archive")]
    left = [f.rsplit("load_ts=")[1][:8] for f in paths.files_below(spark, f"{tmp_path}/landing")]
    assert sorted(archived + left) == ["20190801", "20190802", "20190803"] and "20190801" in archived
