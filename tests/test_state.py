from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tracklayer.layouts import NA
from tracklayer.plans.state import StateTable, delete_keys, merge
from tracklayer.sources import paths

DELTA = "PK string, A string, B string, J string"


@pytest.fixture
def state(spark, tmp_path):
    return StateTable(spark, str(tmp_path / "state"), ["A", "B"], ["J"])


def delta(spark, *rows):
    return spark.createDataFrame(list(rows), DELTA)


def content(state, families=None):
    return {r.PK: tuple(r)[1:] for r in state.read(families).collect()}


def test_empty_state(state):
    assert content(state) == {}
    assert state.read(["J"]).columns == ["PK", "J"]
    assert state.journey_rows("J").collect() == []


def test_upsert_keeps_what_a_batch_does_not_bring(spark, state):
    assert state.upsert(delta(spark, ("1", "a1", "b1", None), ("2", "a2", None, None)), 1)
    assert state.upsert(delta(spark, ("1", None, "b9", None), ("3", "a3", None, None)), 2)
    assert content(state) == {"1": ("a1", "b9", None), "2": ("a2", None, None), "3": ("a3", None, None)}
    assert content(state, ["B"])["1"] == ("b9",)


def test_journeys_append_in_batch_then_text_order(spark, state):
    state.upsert(delta(spark, ("1", None, None, "z"), ("1", None, None, "y")), 1)
    state.upsert(delta(spark, ("1", "a", None, None), ("1", None, None, "b")), 2)
    assert content(state)["1"] == ("a", None, "y|z|b")
    ordered = sorted((r.number, r.writer, r.event) for r in state.journey_rows("J").collect())
    assert [e for _, _, e in ordered] == ["y", "z", "b"]


def test_replay_is_a_no_op_per_writer(spark, state):
    rows = delta(spark, ("1", "a", None, "e"))
    assert state.upsert(rows, 5)
    assert not state.upsert(rows, 5)
    assert not state.upsert(rows, 4)
    assert state.upsert(rows, 0, writer="other")
    assert content(state)["1"] == ("a", None, "e|e")
    assert state.committed("batch", 4) and not state.committed("batch", 6)


def files(spark, state):
    parts = [n for n in paths.child_names(spark, state.records_path) if n.startswith("part=")]
    return {n: paths.child_names(spark, f"{state.records_path}/{n}") for n in parts}


def test_untouched_parts_keep_their_files(spark, state):
    state.upsert(delta(spark, *((str(k), "a", "b", None) for k in range(200))), 1)
    before = files(spark, state)
    assert len(before) == state.parts
    state.upsert(delta(spark, ("7", "z", None, None)), 2)
    after = files(spark, state)
    changed = [n for n in before if before[n] != after[n]]
    (part,) = (r.part for r in spark.createDataFrame([("7",)], "PK string").select(state._part()).collect())
    assert changed == [f"part={part}"]
    assert content(state) == {str(k): ("z" if k == 7 else "a", "b", None) for k in range(200)}
    state.upsert(delta(spark, ("7", None, None, "event")), 3)  # a journey alone adds the key to its part, which has it
    assert content(state)["7"] == ("z", "b", "event")


def test_reading_records_needs_no_shuffle(spark, state):
    state.upsert(delta(spark, ("1", "a", None, "e1"), ("2", None, "b", None)), 1)
    plan = state.read(["A"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<PK:string,A:string>" in plan


@pytest.mark.parametrize("step", ["journeys", "prepare", "publish", "half published", "mark"])
def test_an_upsert_that_died_is_finished_by_the_next(spark, state, monkeypatch, step):
    first = [(str(k), "a", "b", "e") for k in range(40)]
    second = [(str(k), None, "c", "f") for k in range(20, 60)]
    state.upsert(delta(spark, *first), 1)
    real = paths.move
    moved = []

    def move(session, source, target):
        moved.append(target)
        return 1 / 0 if len(moved) > 3 else real(session, source, target)

    target, broken = {
        "journeys": (state, {"_prepare": lambda *a: 1 / 0}),
        "prepare": (state, {"_finish": lambda *a: 1 / 0}),
        "publish": (paths, {"move": lambda *a: 1 / 0}),
        "half published": (paths, {"move": move}),
        "mark": (paths, {"make": lambda *a: 1 / 0}),
    }[step]
    for name, broke in broken.items():
        monkeypatch.setattr(target, name, broke)
    with pytest.raises(ZeroDivisionError):
        state.upsert(delta(spark, *second), 2)
    monkeypatch.undo()
    if step in ("journeys", "prepare"):
        assert content(state) == {k: (a, b, j) for k, a, b, j in first}  # nothing of it is seen
    state.upsert(delta(spark, ("x", "y", None, "g")), 0, writer="other")  # another writer comes first
    assert state.upsert(delta(spark, *second), 2) == (step == "journeys")  # what was prepared, the other one has finished
    expected = {k: (a, b, j) for k, a, b, j in first} | {"x": ("y", None, "g")}
    for k, _, b, j in second:
        old = expected.get(k)
        expected[k] = (old and old[0], b, f"{old[2]}|{j}" if old else j)
    assert content(state) == expected


def test_replaced_journeys(spark, state):
    state.upsert(delta(spark, ("1", None, None, "old"), ("2", None, None, "kept")), 1)
    state.upsert(delta(spark, ("1", None, None, "new")), 1, writer="reload", replace_journeys=True)
    state.upsert(delta(spark, ("1", None, None, "more")), 2)
    assert {k: v[2] for k, v in content(state).items()} == {"1": "new|more", "2": "kept"}


@pytest.mark.parametrize(("sentinel", "expected"), [("reference", f"{NA}|e"), ("strict", "e")])
def test_stored_sentinel_journey(spark, tmp_path, sentinel, expected):
    state = StateTable(spark, str(tmp_path / "s"), ["A"], ["J"], sentinel)
    state.upsert(delta(spark, ("1", None, None, NA)), 1)
    state.upsert(delta(spark, ("1", None, None, "e")), 2)
    assert content(state)["1"] == (None, expected)


def test_a_hot_key_is_stored_in_many_files(spark, state, uncoalesced):
    """Undated events that begin alike: ranges of key and whole event still part them."""
    n = 5000
    event = F.concat(F.lit("~~~~same begin for all~"), F.lpad(F.col("id").cast("string"), 6, "0"))
    hot = spark.range(n).select(F.lit("hot").alias("PK"), event.alias("J"))
    state.upsert(hot, 1)
    rows = spark.read.parquet(f"{state.path}/journeys").withColumn("file", F.input_file_name())
    per = rows.groupBy("file").agg(F.count("*").alias("n"), F.min("event").alias("low"), F.max("event").alias("high")).orderBy("low").collect()
    assert len(per) == 4 and sum(r.n for r in per) == n and max(r.n for r in per) < n // 2
    assert all(a.high < b.low for a, b in zip(per, per[1:]))


def test_resized(spark, state):
    state.upsert(delta(spark, *((str(k), "a", None, "e") for k in range(30))), 1)
    more = state.resized(5)
    assert content(more) == content(state) and len(files(spark, more)) == 5
    assert not more.upsert(delta(spark, ("1", "z", None, None)), 1)
    assert more.upsert(delta(spark, ("1", "z", None, "f")), 2)
    assert content(more)["1"] == ("z", None, "e|f")
    assert more.resized(5) is more


def test_marks_read_presence_only(spark, state):
    state.upsert(delta(spark, ("1", "long record", NA, None)), 1)
    assert {tuple(r) for r in state.read(["A", "B"], marks=["A", "B"]).collect()} == {("1", "*", NA)}


def test_many_batches_equal_one(spark, tmp_path):
    rows = [(str(k), f"a{i}", None if i % 2 else f"b{i}", f"e{i}") for i in range(6) for k in range(3)]
    one, many = (StateTable(spark, str(tmp_path / n), ["A", "B"], ["J"]) for n in ("one", "many"))
    for i in range(6):
        many.upsert(delta(spark, *(r for r in rows if r[3] == f"e{i}")), i)
    last = {k: (f"a{5}", "b4") for k in "012"}
    events = [(k, None, None, e) for k, _, _, e in rows]
    one.upsert(delta(spark, *[(k, *v, None) for k, v in last.items()], *events), 0)
    assert content(one) == content(many)


def test_merge_and_delete(spark):
    base = spark.createDataFrame([("1", "a", "x"), ("2", "b", None)], "PK string, A string, B string")
    new = spark.createDataFrame([("2", None, "y"), ("3", "c", None)], base.schema)
    merged = merge(base, new, ["A", "B"])
    assert sorted(map(tuple, merged.collect())) == [("1", "a", "x"), ("2", "b", "y"), ("3", "c", None)]
    keys = spark.createDataFrame([("1",), ("1",)], "PK string")
    assert sorted(r.PK for r in delete_keys(merged, keys).collect()) == ["2", "3"]
