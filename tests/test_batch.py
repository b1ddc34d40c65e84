from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException

import tracklayer.plans.batch as batch_module
from tracklayer.layouts import NA, TOMBSTONE, Layout
from tracklayer.plans.batch import BatchConfig, run_batch
from tracklayer.plans.bundle import build_bundle, delete_bundle
from tracklayer.plans.cleanup import run_cleanup, run_reformat, run_reload
from tracklayer.plans.layers import Layers
from tracklayer.sources import paths
from tracklayer.sources.jdbc import append_jdbc
from tracklayer.sources.landing import columns_of, latest_partition, read_landing, read_parquet_or_none, select_batch, write_partitions
from tracklayer.sources.masters import Masters, no_masters, read_master, read_masters

STATUS = ("cawbno", "cstatcode", "cstattype", "dstatdate", "cloccode", "cemplcode")
SHIP = ("cawbno", "cprodcode", "corgarea", "ccustcode", "cpacktype", "cmode", "cbtpcode", "cbtparea")
LAYOUTS = {
    "IBS": Layout("IBS", STATUS, trim_first=True),
    "OBS": Layout("OBS", STATUS, trim_first=True),
    "ABM": Layout("ABM", SHIP, trim_first=True),
    "SLT": Layout("SLT", SHIP, trim_first=True),
    "MDP": Layout("MDP", ("cawbno", "cpickupid"), trim_first=True),
    "ALK": Layout("ALK", ("coawbno", "cnawbno")),
    "SRT": Layout("SRT", ("cawbno", "dentdate", "cremarks")),
    "SFM": Layout(
        "SFM",
        tuple("cawbno nrunid drundate corgarea cruncode cstattype cstatcode cemplcode cloccode dstatdate".split()),
    ),
    "CPS": Layout(
        "CPS",
        ("ntokenno", "carea", "ccustcode", "dregdate", "dpudate", "crevpu"),
        tail=("op_ts", "op_type", "cust_ccompgrp", "cgrpname", "load_ts"),
        trim_key=False,
    ),
    "ADT": Layout("ADT", ("nawbid", "ccode", "cattention", "csender"), tail=("op_ts",), trim_key=False),
}
TABLES = {f: f for f in LAYOUTS}
AS_OF = datetime(2019, 8, 15, 9, 30)


def frame(spark, family, *rows):
    layout = LAYOUTS[family]
    return spark.createDataFrame(list(rows), layout.landed_schema())


def status(key, code, day, op="I", load=20190801000000, kind="T", remark=None):
    return (key, code, kind, f"2019-08-{day:02d} 10:00:00", "BOM", remark, f"2019-08-{day:02d} 10:00:00", op, load)


@pytest.fixture
def masters(spark):
    base = no_masters(spark)
    return Masters(
        spark.createDataFrame([("123", "T", "G", "Delivered")], base.status.schema),
        spark.createDataFrame([("org", "cus", "g1")], base.customer.schema),
        spark.createDataFrame([("p", None, None, "par", "com", "sub", "grp")], base.pack.schema),
        spark.createDataFrame([("g1", "Group One")], base.group.schema),
    )


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "layers"), LAYOUTS)


def stored(table, *families):
    return {r.PK: tuple(r)[1:] if len(families) > 1 else r[1] for r in table.read(list(families)).collect()}


def apply(spark, layers, masters, changes, batch_id=1, **options):
    return layers.apply(build_bundle(changes, LAYOUTS, masters), masters, as_of=AS_OF, batch_id=batch_id, **options)


def test_status_batch_reaches_the_persistent_layer(spark, layers, masters):
    ibs = frame(spark, "IBS", status(" k1 ", "123", 2), status("k1", "001", 1, "U"), status("k2", "001", 1), status("k3", "123", 3, "D"))
    obs = frame(spark, "OBS", status("k1", "016", 3, "I", 20190801000500))
    assert apply(spark, layers, masters, {"IBS": ibs, "OBS": obs})
    record = "123~T~2019-08-02 10:00:00~BOM~" + NA + "~2019-08-02 10:00:00~I~G~Delivered"
    assert stored(layers.persistent, "IBS")["k1"] == "k1~" + record
    assert stored(layers.persistent, "DLS", "DTS", "LTS") == {
        "k1": ("T123", "2019-08-15 09:30", "2019-08-01 00:05:00"),
        "k2": ("UD", None, "2019-08-01 00:05:00"),
    }
    journey = "2019-08-01 10:00:00~T001~BOM~~~@IB:U|2019-08-02 10:00:00~T123~BOM~~G~Delivered@IB:I|2019-08-03 10:00:00~T016~BOM~~~@OB:I"
    assert stored(layers.persistent, "PDJ")["k1"] == journey
    assert stored(layers.control, "PL") == {"1": "2019-08-01 00:05:00"}


def test_replay_and_journey_growth(spark, layers, masters):
    first, second = ({"IBS": frame(spark, "IBS", status("k", "001", d))} for d in (2, 1))
    assert apply(spark, layers, masters, first, 1)
    assert not apply(spark, layers, masters, first, 1)
    assert apply(spark, layers, masters, second, 2)
    days = [e[8:10] for e in stored(layers.persistent, "PDJ")["k"].split("|")]
    assert days == ["02", "01"]  # arrival order of batches


def test_a_half_applied_batch_is_finished_once(spark, layers, masters, monkeypatch):
    changes = {"IBS": frame(spark, "IBS", status("k", "001", 1)), "CPS": pickups(spark)}
    monkeypatch.setattr(layers.pickup, "upsert", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        apply(spark, layers, masters, changes)
    monkeypatch.undo()
    assert apply(spark, layers, masters, changes)
    assert stored(layers.persistent, "PDJ")["k"].count("|") == 0
    assert set(stored(layers.pickup, "CPS")) == {"7", "8"}


def test_batch_without_status_resets_it_unless_kept(spark, layers, masters):
    apply(spark, layers, masters, {"IBS": frame(spark, "IBS", status("k", "123", 1))}, 1)
    link = {"MDP": frame(spark, "MDP", ("k", "p", "t", "I", 20190802000000))}
    apply(spark, layers, masters, link, 2, keep_status=True)
    assert stored(layers.persistent, "DLS")["k"] == "T123"
    apply(spark, layers, masters, link, 3)
    assert stored(layers.persistent, "DLS", "DTS")["k"] == (NA, "2019-08-15 09:30")
    assert stored(layers.persistent, "MDP")["k"] == "k~p~t~I"


def test_shipments_are_enriched_and_deletes_become_tombstones(spark, layers, masters):
    ship = ("s", "p", "org", "cus", None, None, None, None, "t1", "I", 20190801000000)
    slt = frame(spark, "SLT", ship, ("s2", *ship[1:]), ("s2", *[None] * 7, "t2", "D", 20190801000000))
    apply(spark, layers, masters, {"ABM": frame(spark, "ABM", ship), "SLT": slt})
    record = f"s~p~org~cus~{NA}~{NA}~{NA}~{NA}~t1~I~g1~par~com~sub~grp~Group One"
    assert stored(layers.persistent, "ABM", "SLT") == {"s": (record, record), "s2": (None, TOMBSTONE)}


def test_duplicate_masters_do_not_repeat_a_stored_key(spark, layers, masters):
    twice = Masters(masters.status.union(masters.status), masters.customer, masters.pack, masters.group)
    apply(spark, layers, twice, {"IBS": frame(spark, "IBS", status("k", "123", 1))})
    rows = spark.read.parquet(layers.persistent.records_path).filter("IBS IS NOT NULL")
    assert rows.count() == 1


def pickups(spark):
    return frame(
        spark,
        "CPS",
        ("7", "org", "cus", "2019-08-01", None, "N", "t1", "I", 20190801000000),
        ("8", "x", "y", "2019-08-02", None, "N", "t1", "I", 20190801120000),
    )


def test_pickups_have_their_own_table(spark, layers, masters):
    apply(spark, layers, masters, {"CPS": pickups(spark)})
    cps = stored(layers.pickup, "CPS", "LTS", "CPJ")
    assert cps["7"] == (
        f"7~org~cus~2019-08-01~{NA}~N~t1~I~g1~Group One~20190801000000",
        "2019-08-01 12:00:00",
        "2019-08-01~~N:I",
    )
    assert stored(layers.persistent, "LTS") == {}


def test_alternates_and_links_go_to_both_tables(spark, layers, masters):
    srt = frame(spark, "SRT", ("k", "2019-08-01", "call", "t1", "I", 20190801000000))
    alk = frame(spark, "ALK", ("k", "n", "t1", "I", 20190801000000))
    apply(spark, layers, masters, {"SRT": srt, "ALK": alk})
    expected = {"k": ("k~n~t1~I~20190801000000", "k~2019-08-01~call~t1~I", "Y", "2019-08-01~call:I")}
    for table in (layers.persistent, layers.link):
        assert stored(table, "ALK", "SRT", "SRT_AFLG", "SRJ") == expected


def test_flight_and_contact_and_deletes(spark, layers, masters):
    sfm = frame(spark, "SFM", ("k", "r", "d", "o", "c", "S", "1", None, "l", "x", "t1", "U", 20190801000000))
    adt = spark.createDataFrame(
        [("9", "c", "snd", "Y", "t1", "I"), ("9", "c", "r~c|v", "N", "t1", "I")],
        "nawbid string, ccode string, cattn string, cshipper string, op_ts string, op_type string",
    )
    apply(spark, layers, masters, {"SFM": sfm, "ADT": adt})
    assert stored(layers.persistent, "SFJ") == {"k": "r~d~o~c~S~1~~l~x:U"}
    assert stored(layers.contact, "ADT") == {"9": "9~c~rcv~snd~t1"}  # without the separators
    gone = delete_bundle(frame(spark, "MDP", ("k", "p", "t", "D", 1), ("l", "p", "t", "I", 1)), LAYOUTS["MDP"])
    layers.apply(gone, masters, as_of=AS_OF, batch_id=2)
    assert stored(layers.deleted, "DEL") == {"k": "k~p~t~D~1"}
    with pytest.raises(ValueError, match="no route"):
        layers.apply({"XXX": adt}, masters, as_of=AS_OF, batch_id=3)


def test_cleanup_jobs(spark, layers, masters):
    ship = ("k", "p", "org", "cus", None, None, None, None, "t1", "I", 20190801000000)
    apply(spark, layers, masters, {"ABM": frame(spark, "ABM", ship), "OBS": frame(spark, "OBS", status("k", "132", 4), status("k2", "132", 4))})
    assert run_cleanup(layers, as_of=AS_OF, batch_id=1)
    assert not run_cleanup(layers, as_of=AS_OF, batch_id=1)
    assert stored(layers.persistent, "DLS", "DTS") == {"k": ("T132", "2019-08-04 10:00"), "k2": ("I", "2019-08-15 09:30")}
    old = spark.createDataFrame([("k", "201908150930")], "PK string, LTS string")
    layers.persistent.upsert(old, 2)
    run_reformat(layers, batch_id=1)
    assert stored(layers.persistent, "LTS")["k"] == "2019-08-15 09:30:00"


def test_reload_replaces_the_link_journey(spark, layers, masters):
    srt = frame(spark, "SRT", ("k", "2019-08-01", "call", "t1", "I", 20190801000000))
    apply(spark, layers, masters, {"SRT": srt})
    layers.persistent.upsert(spark.createDataFrame([("k", "extra")], "PK string, SRJ string"), 2)
    for batch in (1, 2):
        run_reload(layers, batch_id=batch)
        assert stored(layers.link, "SRJ") == {"k": "2019-08-01~call:I|extra"}


def test_views(spark, layers, masters):
    apply(spark, layers, masters, {"IBS": frame(spark, "IBS", status("k", "123", 1))})
    layers.register_views("now_")
    assert spark.sql("SELECT DLS FROM now_persistent").first()[0] == "T123"


# --- selection and the batch protocol


def landed(spark, path, family, *rows):
    write_partitions(frame(spark, family, *rows), f"{path}/{family}", "append")


@pytest.fixture
def config(tmp_path):
    folders = {n: str(tmp_path / n) for n in ("landing", "staging", "last", "archive")}
    return BatchConfig(**folders, layouts={"IBS": LAYOUTS["IBS"]}, tables={"IBS": "IBS"})


def test_bounds_are_exclusive(spark):
    stamps = [20190815092759, 20190815092800, 20190815092801, 20190815000000]
    df = spark.createDataFrame([(s,) for s in stamps], "load_ts long")
    assert [r[0] for r in select_batch(df, None, AS_OF).sort("load_ts").collect()] == [20190815000000, 20190815092759]
    last = spark.createDataFrame([(20190815000000,), (1,)], "load_ts long")
    assert [r[0] for r in select_batch(df, last, AS_OF).collect()] == [20190815092759]
    assert select_batch(df, last.filter("1 = 0"), AS_OF).count() == 2
    assert [r[0] for r in latest_partition(df).collect()] == [20190815092801]


def test_selection_prunes_directories(spark, tmp_path):
    landed(spark, tmp_path, "IBS", *(status("k", "001", d, load=20190800000000 + d * 1000000) for d in range(1, 9)))
    schema = LAYOUTS["IBS"].landed_schema()
    df = read_landing(spark, f"{tmp_path}/IBS", schema)
    last = spark.createDataFrame([(20190803000000,)], "load_ts long")
    due = select_batch(df, last, datetime(2019, 8, 6))
    assert {r.load_ts for r in due.collect()} == {20190804000000, 20190805000000}
    plan = due._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(load_ts" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 59), min_size=1, max_size=12), st.lists(st.integers(0, 62), min_size=1, max_size=4))
def test_successive_selections_lose_and_repeat_nothing(spark, minutes, runs):
    rows = [(20190815100000 + m * 100,) for m in minutes]
    df = spark.createDataFrame(rows, "load_ts long")
    last, seen = None, []
    for m in sorted(runs):
        as_of = datetime(2019, 8, 15, 10 + m // 60, m % 60)
        due = [tuple(r) for r in select_batch(df, last, as_of).collect()]
        seen += due
        if due:
            last = spark.createDataFrame([max(due)], "load_ts long")
    bound = 20190815100000 + (max(runs) // 60) * 10000 + (max(runs) % 60) * 100
    upper = int((datetime.strptime(str(bound), "%Y%m%d%H%M%S").timestamp() - 120))
    limit = int(datetime.fromtimestamp(upper).strftime("%Y%m%d%H%M%S"))
    assert sorted(seen) == sorted(r for r in rows if r[0] < limit)


def test_runs_archive_and_move_on(spark, config, layers, masters):
    assert run_batch(spark, config, layers, masters, AS_OF) is None
    landed(spark, config.landing, "IBS", status("k", "001", 1, load=20190801000000), status("k", "001", 2, load=20190802000000))
    assert run_batch(spark, config, layers, masters, AS_OF) == 20190815093000
    assert paths.child_names(spark, f"{config.archive}/IBS") == ["load_ts=20190801000000", "load_ts=20190802000000"]
    assert [n for n in paths.child_names(spark, f"{config.last}/IBS") if n.startswith("load")] == ["load_ts=20190802000000"]
    assert paths.is_empty(spark, config.staging)
    landed(spark, config.landing, "IBS", status("k", "123", 3, load=20190803000000))
    assert run_batch(spark, config, layers, masters, datetime(2019, 8, 15, 10)) == 20190815100000
    assert run_batch(spark, config, layers, masters, datetime(2019, 8, 15, 11)) is None
    assert [e[8:10] for e in stored(layers.persistent, "PDJ")["k"].split("|")] == ["01", "02", "03"]


def test_a_run_that_died_after_merging_is_not_merged_again(spark, config, layers, masters, monkeypatch):
    landed(spark, config.landing, "IBS", status("k", "001", 1, load=20190801000000))
    monkeypatch.setattr(batch_module, "archive_batch", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, config, layers, masters, AS_OF)
    monkeypatch.undo()
    landed(spark, config.landing, "IBS", status("k", "001", 2, load=20190802000000))
    assert run_batch(spark, config, layers, masters, datetime(2019, 8, 15, 10)) == 20190815093000
    assert run_batch(spark, config, layers, masters, datetime(2019, 8, 15, 11)) == 20190815110000
    assert [e[8:10] for e in stored(layers.persistent, "PDJ")["k"].split("|")] == ["01", "02"]


@pytest.mark.parametrize("step", ["apply", "archive", "half archived", "watermark", "manifest gone"])
def test_a_run_that_died_in_any_step_is_finished(spark, config, layers, masters, monkeypatch, step):
    """Each landed row is merged once, under the time of the run that staged it."""
    config = replace(config, layouts=LAYOUTS, tables={"IBS": "IBS", "OBS": "OBS"})
    landed(spark, config.landing, "IBS", status("k", "123", 1, load=20190801000000), status("k", "001", 2, load=20190802000000))
    landed(spark, config.landing, "OBS", status("k", "016", 3, load=20190803000000))
    real = paths.move
    target, name, broken = {
        "apply": (layers, "apply", lambda *a, **k: 1 / 0),
        "archive": (batch_module, "archive_batch", lambda *a: 1 / 0),
        "half archived": (paths, "move", lambda s, a, b: 1 / 0 if "load_ts=20190802" in a else real(s, a, b)),
        "watermark": (paths, "make", lambda s, p: 1 / 0 if "/last/" in p else s._jvm.java.io.File(p).mkdirs()),
        "manifest gone": (paths, "remove", lambda s, p: 1 / 0 if p.endswith("staging/20190815093000") else real_remove(s, p)),
    }[step]
    real_remove = paths.remove
    monkeypatch.setattr(target, name, broken)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, config, layers, masters, AS_OF)
    monkeypatch.undo()
    assert run_batch(spark, config, layers, masters, datetime(2019, 8, 15, 10)) == 20190815093000
    assert run_batch(spark, config, layers, masters, datetime(2019, 8, 15, 11)) is None
    assert [e[8:10] for e in stored(layers.persistent, "PDJ")["k"].split("|")] == ["01", "02", "03"]
    assert stored(layers.persistent, "DTS")["k"] == "2019-08-15 09:30"
    assert paths.child_names(spark, f"{config.archive}/IBS") == ["load_ts=20190801000000", "load_ts=20190802000000"]
    assert paths.is_empty(spark, config.staging)


def test_a_file_that_lands_late_is_left_where_it_is(spark, config, layers, masters):
    landed(spark, config.landing, "IBS", status("k", "001", 1, load=20190801000000))
    batch_id = batch_module.stage_batch(spark, config, AS_OF)
    landed(spark, config.landing, "IBS", status("late", "001", 1, load=20190801000000))
    changes = batch_module.staged_changes(spark, config, batch_module.read_manifest(spark, config, batch_id))
    assert [r.cawbno for r in changes["IBS"].collect()] == ["k"]
    assert "Exchange" not in changes["IBS"]._jdf.queryExecution().executedPlan().toString()
    run_batch(spark, config, layers, masters, AS_OF)
    assert [r.cawbno for r in spark.read.parquet(f"{config.landing}/IBS").collect()] == ["late"]
    assert [r.cawbno for r in spark.read.parquet(f"{config.archive}/IBS").collect()] == ["k"]


def test_masters_fail_over_to_the_backup(spark, tmp_path, masters):
    for name, df in vars(masters).items():
        df.write.parquet(f"{tmp_path}/backup/{name}")
    assert read_masters(spark, f"{tmp_path}/primary", f"{tmp_path}/backup").group.first().ccompname == "Group One"
    with pytest.raises(FileNotFoundError):
        read_master(spark, f"{tmp_path}/x", f"{tmp_path}/y")


def test_only_missing_paths_are_tolerated(spark, tmp_path):
    assert read_parquet_or_none(spark, f"{tmp_path}/none") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        read_parquet_or_none(spark, f"{tmp_path}/bad")
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() != "PATH_NOT_FOUND"


def test_columns_come_from_the_footer(spark, tmp_path):
    spark.createDataFrame([("1", "2")], "CAWBNO string, NAWBID string").write.parquet(f"{tmp_path}/t")
    assert columns_of(spark, f"{tmp_path}/t") == ["cawbno", "nawbid"]


def test_jdbc_sink_appends_to_the_given_url(spark, monkeypatch):
    calls = []
    df = spark.range(1)
    monkeypatch.setattr(type(df.write), "jdbc", lambda self, url, table, properties: calls.append((url, table, properties)))
    append_jdbc(df, "jdbc:x://host/db", "t", {"user": "u"})
    assert calls == [("jdbc:x://host/db", "t", {"user": "u"})]


def test_masters_are_broadcast_and_records_are_not_joined_to_themselves(spark, tmp_path, masters):
    written = {}
    for name, df in vars(masters).items():
        df.write.parquet(f"{tmp_path}/{name}")
        written[name] = spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")
    rows = frame(spark, "IBS", status("k", "123", 1))
    bundle = build_bundle({"IBS": rows}, LAYOUTS, Masters(**written))
    plan = bundle["PDJ"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
