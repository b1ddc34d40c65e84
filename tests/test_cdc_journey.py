from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklayer.layouts import NA, TOMBSTONE, Layout
from tracklayer.operators.cdc import contact_pair, latest_per_key, latest_records, pivot_families, split_cdc
from tracklayer.operators.enrich import with_status
from tracklayer.operators.journey import append_journey, build_journey, event_text, events_of, journey_parts, journey_rows, render, sorted_runs, status_event

LAYOUT = Layout("T", ("k", "a"), tail=("op_ts", "op_type"))
SCHEMA = "k string, a string, op_ts string, op_type string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_change_wins_even_over_a_delete_of_the_same_batch(spark):
    df = spark.createDataFrame(
        [("x", "1", "t1", "I"), ("x", None, "t2", "D"), ("y", None, "t1", "D"), ("y", "2", "t3", "U"), ("z", "q", "t1", None)],
        SCHEMA,
    )
    latest = latest_records(split_cdc(df, LAYOUT, tombstone=True, keep=["op_ts"]))
    assert rows(latest) == [("x", TOMBSTONE), ("y", "y~2~t3~U")]
    assert rows(split_cdc(df, LAYOUT)) == [("x", "x~1~t1~I"), ("y", "y~2~t3~U")]


def test_latest_per_key_breaks_ties_the_same_way_each_time(spark):
    data = [("k", "t", v) for v in "abcdefgh"]
    for d in (data, data[::-1]):
        df = spark.createDataFrame(d, "k string, op_ts string, v string").repartition(4)
        assert latest_per_key(df, ["k"], ["op_ts"]).collect()[0].v == "h"


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("op_ts")
    )
    plan = latest_per_key(df, ["k"], ["op_ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert latest_per_key(df, ["k"], ["op_ts"]).filter("k = 'hot'").first().op_ts == 39_999


def test_contact_pair_needs_both_sides(spark):
    df = spark.createDataFrame(
        [
            ("1", "c1", "old", "Y", "t1"),
            ("1", "c2", "send", "Y", "t2"),
            ("1", "c3", "recv", "N", "t1"),
            ("2", "c4", "only", "Y", "t1"),
            (None, "c5", "s", "Y", "t1"),
            (None, "c5", "r", "N", "t1"),
        ],
        "nawbid string, ccode string, cattn string, cshipper string, op_ts string",
    )
    assert rows(contact_pair(df)) == [("1", "c2", "recv", "send", "t2")]


def test_pivot_leaves_absent_families_null(spark):
    a = spark.createDataFrame([("1", "a1", "t1"), ("1", "a2", "t2")], "PK string, CT_COL string, op_ts string")
    b = spark.createDataFrame([("2", "b1", "t1")], a.schema)
    assert rows(pivot_families({"A": a, "B": b})) == [("1", "a2", None), ("2", None, "b1")]


def status_rows(spark):
    return spark.createDataFrame(
        [
            ("A", "2019-08-02 00:00:00", "S", "002", "BOM", None, "U"),
            ("A", "2019-08-01 00:00:00", "S", "001", None, None, "I"),
            ("A", "2019-08-01 00:00:00", "S", "001", None, None, "I"),
            (None, "2019-08-01 00:00:00", "S", "001", None, None, "I"),
        ],
        "cawbno string, dstatdate string, cstattype string, cstatcode string, cloccode string, cemplcode string, op_type string",
    )


def test_journey_drops_copies_keeps_empty_places_and_sorts(spark):
    code = F.concat("cstattype", "cstatcode")
    text = event_text(["dstatdate", code, "cloccode"], "@IB")
    assert rows(build_journey(events_of(status_rows(spark), "cawbno", text))) == [
        ("A", "2019-08-01 00:00:00~S001~@IB:I|2019-08-02 00:00:00~S002~BOM@IB:U")
    ]


def test_status_event_uses_the_master(spark):
    master = spark.createDataFrame(
        [("S", "001", "G", "Picked")], "cstattype string, cstatcode string, cstatgroup string, cstatdesc string"
    )
    events = events_of(with_status(status_rows(spark), master), "cawbno", status_event("@OB"))
    assert {r.event for r in events.collect()} == {
        "2019-08-01 00:00:00~S001~~~G~Picked@OB:I",
        "2019-08-02 00:00:00~S002~BOM~~~@OB:U",
    }


def test_slices_do_not_change_the_journey(spark):
    data = [(k, e) for k in "xy" for e in ("", "a", "ab", "abc", "abd", "b", "é", "z|")] + [("n", None), ("x", None)]
    events = spark.createDataFrame(data, "PK string, event string")
    whole = rows(build_journey(events))
    for chars in (2, 3, 100):
        assert rows(render(journey_parts(events, chars))) == whole
    assert ("n", "") in whole
    assert rows(render(journey_parts(events, 1))) == whole


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("xyz"), st.text(alphabet="ab~é", max_size=5)), min_size=1, max_size=30),
    st.integers(1, 4),
)
def test_journey_is_the_sorted_distinct_events(spark, data, chars):
    expected = {k: "|".join(sorted({e for j, e in data if j == k}, key=str.encode)) for k, _ in data}
    events = spark.createDataFrame(data, "PK string, event string")
    assert dict(rows(build_journey(events))) == dict(rows(render(journey_parts(events, chars)))) == expected


def test_hot_key_spreads_by_its_events(spark, uncoalesced):
    """A key with a third of the rows, its events undated and alike at the begin, some of them very often."""
    n = 30_000
    alike = F.concat(F.lit("~" * 30), F.lpad((F.col("id") % 9000).cast("string"), 5, "0"))
    events = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("PK"), alike.alias("event"))
    runs = sorted_runs(journey_rows(events).filter("PK = 'hot'")).withColumn("task", F.spark_partition_id())
    per = runs.groupBy("task").agg(F.count("*").alias("n"), F.min("event").alias("low"), F.max("event").alias("high")).orderBy("low").collect()
    assert sum(r.n for r in per) == 3000 and len(per) == 4 and max(r.n for r in per) < 1500
    assert all(a.high < b.low for a, b in zip(per, per[1:]))
    in_order = [r.event for r in runs.collect()]
    assert in_order == sorted(in_order)
    assert build_journey(events).filter("PK = 'hot'").first().CT_COL == "|".join(in_order)


def test_append(spark):
    delta = spark.createDataFrame([("1", "i1"), ("2", "i2"), ("3", "i3"), ("4", None)], "PK string, CT_COL string")
    state = spark.createDataFrame([("1", "p1"), ("2", None), ("3", NA), ("9", "p9")], "PK string, PDJ string")
    assert rows(append_journey(delta, state, "PDJ")) == [("1", "p1|i1"), ("2", "i2"), ("3", f"{NA}|i3"), ("4", NA)]
    assert ("3", "i3") in rows(append_journey(delta, state, "PDJ", sentinel="strict"))
