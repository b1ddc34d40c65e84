from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tracklayer.layouts import NA
from tracklayer.operators.enrich import enrich_shipment, one_per_key, with_customer, with_status
from tracklayer.operators.status import (
    closure_ts,
    delivery_status,
    load_ts_text,
    pickup_load_ts,
    reclassify,
    reformat_lts,
)

AS_OF = "2019-08-15 09:30:00"
PL = "PK string, ABM string, SLT string, PDJ string, DLS string, DTS string"


def event(date, code):
    return f"{date}~{code}~LOC~EMP~G~Desc@IB:I"


S001 = event("2019-08-01 10:00:05", "S001")
CASES = {
    "r1": ((None, None, None, None, None), ("I", "2019-08-15 09:30")),
    "r1n": ((NA, None, NA, "UD", "x"), ("I", "2019-08-15 09:30")),
    "r2a": ((None, NA, S001, "UD", None), ("I", "2019-08-15 09:30")),
    "r2b": ((None, None, event("2019-06-01 10:00:05", "S015"), "UD", None), ("I", "2019-08-15 09:30")),
    "r2c": (
        (None, None, event("2019-08-10 10:00:05", "S018") + "|" + event("2019-08-11 12:34:56", "S003"), None, None),
        ("UD", "2019-08-11 12:34"),
    ),
    "r2d": ((None, None, "S015", None, None), ("UD", "S015")),  # bare marker without a date is not too old
    "r3": (("abm", None, NA, "T123", "2019-01-01 00:00"), (NA, NA)),
    "r3n": (("abm", None, None, "T123", "2019-01-01 00:00"), (NA, "2019-01-01 00:00")),
    "r4": (
        ("abm", "slt", event("2019-08-01 10:00:05", "T016") + "|" + event("2019-08-02 11:22:33", "T123"), "UD", None),
        ("T123", "2019-08-02 11:22"),
    ),
    "r4s": ((NA, "slt", event("2019-08-01 10:00:05", "T284"), None, None), ("T284", "2019-08-01 10:00")),
    "r5": (("abm", None, S001, "T123", None), ("UD", "2019-08-01 10:00")),
    "r5n": (("abm", None, S001, None, None), ("UD", "2019-08-01 10:00")),
    "r6": ((None, "slt", S001, "123", None), ("123", "2019-08-01 10:00")),
}


@pytest.fixture(scope="module")
def reclassified(spark):
    df = spark.createDataFrame([(k, *v[0]) for k, v in CASES.items()], PL)
    return {r.PK: (r.DLS, r.DTS) for r in reclassify(df, as_of=AS_OF).collect()}


@pytest.mark.parametrize("case", CASES)
def test_reclassification_rule(reclassified, case):
    assert reclassified[case] == CASES[case][1]


def test_delivery_status_prefers_the_inbound_leg(spark):
    df = spark.createDataFrame(
        [("T", "123", "T", "016"), ("S", "123", "T", "016"), ("T", "999", None, None), (None, None, "T", "123")],
        "it string, ic string, ot string, oc string",
    )
    status = delivery_status(*(F.col(c) for c in df.columns))
    assert [r[0] for r in df.select(status).collect()] == ["T123", "T016", "UD", "T123"]
    assert [r[0] for r in df.select(closure_ts(status, AS_OF)).collect()][2] is None


def test_load_stamps(spark):
    df = spark.createDataFrame([("1", 20190815093000, None), ("2", None, 20190815100000)], "ntokenno string, load_ts long, b long")
    both = df.select(load_ts_text(df, [F.col("load_ts"), F.col("b")]))
    assert both.first()[0] == "2019-08-15 10:00:00"
    assert {tuple(r) for r in pickup_load_ts(df).collect()} == {("1", "2019-08-15 09:30:00"), ("2", "2019-08-15 09:30:00")}
    none = df.filter("1 = 0")
    assert df.select(load_ts_text(none, [F.col("load_ts")])).first()[0] is None


def test_reformat_only_touches_the_old_form(spark):
    df = spark.createDataFrame(
        [("1", "201908150930"), ("2", "2019-08-15 09:30:00"), ("3", "201912010000"), ("4", "20190bad"), ("5", None)],
        "PK string, LTS string",
    )
    assert {tuple(r) for r in reformat_lts(df).collect()} == {("1", "2019-08-15 09:30:00"), ("4", None)}


def test_sentinel_fact_key_matches_null_master_key(spark):
    facts = spark.createDataFrame([("1", NA, "c"), ("2", "a", "c"), ("3", None, "c")], "PK string, area string, code string")
    master = spark.createDataFrame([(None, "c", "g0"), ("a", "c", "g1"), ("a", "c", "g2")], "carea string, ccustcode string, ccompgrp string")
    out = sorted((r.PK, r.cust_ccompgrp) for r in with_customer(facts, master, "area", "code").collect() if r.PK != "3")
    assert out == [("1", "g0"), ("2", "g1"), ("2", "g2")]
    single = {r.PK: r.cust_ccompgrp for r in with_customer(facts, master, "area", "code", single=True).collect()}
    assert single == {"1": "g0", "2": "g2", "3": None}
    assert one_per_key(master, ["carea", "ccustcode"]).count() == 2


def test_status_join_does_not_match_nulls(spark):
    facts = spark.createDataFrame([("1", None, "001"), ("2", "S", "001")], "PK string, cstattype string, cstatcode string")
    master = spark.createDataFrame(
        [("S", "001", "G", "D"), (None, "001", "X", "X")], "cstattype string, cstatcode string, cstatgroup string, cstatdesc string"
    )
    out = {r.PK: r.stat_cstatgroup for r in with_status(facts, master).collect()}
    assert out == {"1": None, "2": "G"}


def test_billing_key_falls_back_to_origin(spark):
    names = "PK cbtparea corgarea cbtpcode ccustcode cprodcode cmode cpacktype".split()
    facts = spark.createDataFrame(
        [("1", NA, "org", NA, "cus", "p", "m", NA), ("2", "btp", "org", "bcd", "cus", "p", "m", "k")],
        ", ".join(f"{n} string" for n in names),
    )
    customer = spark.createDataFrame([("org", "cus", "g1"), ("btp", "bcd", "g2")], "carea string, ccustcode string, ccompgrp string")
    pack = spark.createDataFrame(
        [("p", "m", None, "par", "com", "sub", "grp")],
        "cprodcode string, csubprdcd string, cpacktype string, cprodparent string, cprodcommname string, csubprdcommname string, cprodgroup string",
    )
    group = spark.createDataFrame([("g1", "Group One")], "ccompgrp string, ccompname string")
    out = {r.PK: r for r in enrich_shipment(facts, customer, pack, group).collect()}
    assert (out["1"].cust_ccompgrp, out["1"].pack_cprodparent, out["1"].cgrpname) == ("g1", "par", "Group One")
    assert (out["2"].cust_ccompgrp, out["2"].pack_cprodparent, out["2"].cgrpname) == ("g2", None, None)


def test_empty_masters_cost_no_join(spark):
    from tracklayer.sources.masters import no_masters

    facts = spark.createDataFrame([("1", "S", "001")], "PK string, cstattype string, cstatcode string")
    out = with_status(facts, no_masters(spark).status)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(out.first())[3:] == (None, None)


def test_large_masters_are_merged_with_the_same_result(spark, tmp_path):
    facts = spark.range(2000).select(F.col("id").alias("PK"), F.expr("if(id % 3 = 0, 'hot', cast(id as string))").alias("area"))
    facts = facts.withColumn("code", F.lit("c"))
    master = facts.select(F.col("area").alias("carea"), F.lit("c").alias("ccustcode"), F.col("PK").cast("string").alias("ccompgrp"))
    master.write.parquet(f"{tmp_path}/m")
    master = spark.read.parquet(f"{tmp_path}/m")
    broadcast = with_customer(facts, master, "area", "code", single=True)
    expected = sorted(map(tuple, broadcast.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = with_customer(facts, master, "area", "code", single=True)
        assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, merged.collect())) == expected
        assert len(expected) == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
