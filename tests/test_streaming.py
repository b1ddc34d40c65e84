from __future__ import annotations

import json
from datetime import datetime

import pytest

from tracklayer.layouts import NA, Layout, default_layouts
from tracklayer.plans.layers import Layers
from tracklayer.sources.feed import demultiplex, parse, read_feed, source_table
from tracklayer.sources.masters import no_masters
from tracklayer.streaming.ingest import start_ingest, start_landed_ingest, start_landing

LAYOUTS = {
    "IBS": Layout("IBS", tuple("cawbno cstatcode cstattype dstatdate cloccode cemplcode".split()), trim_first=True),
    "SLT": Layout("SLT", tuple("cawbno cprodcode corgarea ccustcode cpacktype cmode cbtpcode cbtparea".split())),
    "ADT": default_layouts()["ADT"],
}
NOW = datetime(2019, 8, 15, 9, 30)


def envelope(table, op, ts, pos="1", **after):
    return json.dumps({"table": f"SRC.{table}", "op_type": op, "op_ts": ts, "pos": pos, "current_ts": ts, "after": after})


def scan(key, day, code="001", op="I"):
    date = f"2019-08-{day:02d} 10:00:00"
    return envelope("INBOUNDSTATUSREMARK", op, date, cawbno=key, cstattype="T", cstatcode=code, dstatdate=date, cloccode="a~b")


FEED = [
    [scan("k", 1), scan("j", 1), envelope("SHIPCLT", "I", "t1", cawbno="s", cprodcode="p")],
    [scan("k", 2, "123"), envelope("SHIPCLT", "D", "t2", cawbno="s"), envelope("OTHER", "I", "t", x="y"), "not json"],
    [
        scan("j", 3, op="D"),
        envelope("AWBADDRESSDETAILS", "I", "t1", nawbid="9", ccode="c", cattn="snd", cshipper="Y"),
        envelope("AWBADDRESSDETAILS", "I", "t1", nawbid="9", ccode="c", cattn="rcv", cshipper="N"),
    ],
]


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def ingest(spark, tmp_path, layers, clock=lambda: NOW):
    query = start_ingest(
        read_feed(spark, "text", path=str(tmp_path / "feed"), maxFilesPerTrigger="1"),
        layers,
        LAYOUTS,
        lambda: no_masters(spark),
        checkpoint=str(tmp_path / "checkpoint"),
        trigger={"availableNow": True},
        clock=clock,
    )
    query.awaitTermination()


def contents(layers):
    return {
        name: {r.PK: r.asDict() for r in table.read().collect()}
        for name, table in layers.tables().items()
        if name != "batch_control"
    }


def test_routing_and_parsing(spark):
    values = spark.createDataFrame([(v,) for part in FEED for v in part], "value string")
    assert {r[0] for r in values.select(source_table()).distinct().collect()} >= {"SHIPCLT", "OTHER", None}
    frames = demultiplex(values, LAYOUTS)
    assert set(frames) == {"IBS", "SLT", "ADT"}
    assert frames["IBS"].count() == 4 and frames["ADT"].count() == 2
    row = parse(values.filter(source_table() == "SHIPCLT"), LAYOUTS["SLT"]).sort("op_ts").first()
    assert (row.cawbno, row.cprodcode, row.cmode, row.op_type) == ("s", "p", None, "I")


@pytest.mark.parametrize("files", [1, 3])
def test_one_or_many_batches(spark, tmp_path, files):
    layers = Layers(spark, str(tmp_path / "layers"), LAYOUTS)
    if files == 1:
        write(tmp_path / "feed", "all", [v for part in FEED for v in part])
        ingest(spark, tmp_path, layers)
    else:
        for i, part in enumerate(FEED):  # the query is started anew each time and goes on from its checkpoint
            write(tmp_path / "feed", f"f{i}", part)
            ingest(spark, tmp_path, layers)
    out = contents(layers)
    pl = out["persistent"]
    assert set(pl) == {"k", "j", "s"}
    assert pl["k"]["PDJ"] == "2019-08-01 10:00:00~T001~ab~~~@IB:I|2019-08-02 10:00:00~T123~ab~~~@IB:I"
    assert pl["k"]["IBS"] == f"k~123~T~2019-08-02 10:00:00~ab~{NA}~2019-08-02 10:00:00~I~{NA}~{NA}"
    assert (pl["k"]["DLS"], pl["k"]["DTS"], pl["k"]["LTS"]) == ("T123", "2019-08-15 09:30", "2019-08-15 09:30:00")
    assert pl["j"]["PDJ"] == "2019-08-01 10:00:00~T001~ab~~~@IB:I"
    assert pl["s"]["SLT"] == "D!@#"
    assert out["contact"]["9"]["ADT"] == "9~c~rcv~snd~t1"


def test_replayed_batch_changes_nothing(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"), LAYOUTS)
    write(tmp_path / "feed", "f0", FEED[0])
    ingest(spark, tmp_path, layers)
    before = contents(layers)
    (tmp_path / "checkpoint" / "commits" / "0").unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(".0.crc"):
        crc.unlink()
    ingest(spark, tmp_path, layers, clock=lambda: datetime(2020, 1, 1))
    assert contents(layers) == before


def test_failure_stops_the_query(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"), LAYOUTS)
    write(tmp_path / "feed", "f0", FEED[0])

    def broken():
        raise RuntimeError("no masters")

    query = start_ingest(
        read_feed(spark, "text", path=str(tmp_path / "feed")),
        layers,
        LAYOUTS,
        broken,
        checkpoint=str(tmp_path / "checkpoint"),
        trigger={"availableNow": True},
    )
    with pytest.raises(Exception, match="no masters"):
        query.awaitTermination()


def test_landing_keeps_every_batch_of_one_second(spark, tmp_path):
    for i, envelopes in enumerate((FEED[0][:1], FEED[0][1:], *FEED[1:])):
        write(tmp_path / "feed", f"f{i}", envelopes)
    landing = str(tmp_path / "landing")

    def land(name, layouts):
        start_landing(
            read_feed(spark, "text", path=str(tmp_path / "feed"), maxFilesPerTrigger="1"),
            f"{landing}/{name}",
            layouts,
            checkpoint=str(tmp_path / f"c{name}"),
            times=str(tmp_path / f"times{name}"),
            trigger={"availableNow": True},
            clock=lambda: NOW,
        ).awaitTermination()

    land("all", LAYOUTS)
    inbound = [e for batch in FEED for e in batch if "INBOUNDSTATUSREMARK" in str(e)]
    rows = spark.read.parquet(f"{landing}/all/INBOUNDSTATUSREMARK")
    assert rows.count() == len(inbound) and set(rows.columns) >= {"cawbno", "load_ts"} and "batch" not in rows.columns
    assert {"nawbid", "caddresstype"} < set(spark.read.parquet(f"{landing}/all/AWBADDRESSDETAILS").columns)
    with pytest.raises(Exception, match="no layout for"):
        land("some", {"IBS": LAYOUTS["IBS"]})


def test_landing_then_file_stream(spark, tmp_path):
    write(tmp_path / "feed", "f0", FEED[0] + FEED[1])
    landing = str(tmp_path / "landing")
    start_landing(
        read_feed(spark, "text", path=str(tmp_path / "feed")),
        landing,
        LAYOUTS,
        checkpoint=str(tmp_path / "c1"),
        times=str(tmp_path / "times"),
        trigger={"availableNow": True},
        clock=lambda: NOW,
    ).awaitTermination()
    landed = spark.read.parquet(f"{landing}/INBOUNDSTATUSREMARK")
    assert {(r.cawbno, r.load_ts) for r in landed.collect()} == {("k", 20190815093000), ("j", 20190815093000)}
    layers = Layers(spark, str(tmp_path / "layers"), LAYOUTS)
    start_landed_ingest(
        spark,
        f"{landing}/INBOUNDSTATUSREMARK",
        layers,
        "IBS",
        LAYOUTS,
        no_masters(spark),
        checkpoint=str(tmp_path / "c2"),
        trigger={"availableNow": True},
        clock=lambda: NOW,
    ).awaitTermination()
    assert contents(layers)["persistent"]["k"]["LTS"] == "2019-08-15 09:30:00"
