from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklayer.layouts import NA, Layout, default_layouts, layout_from_columns
from tracklayer.operators.codec import decode, encode, reencode, scrub

LAYOUT = Layout("T", ("k", "a", "b"), tail=("op_ts", "load_ts"), trim_first=True)
SCHEMA = T.StructType(
    [*(T.StructField(c, T.StringType()) for c in ("k", "a", "b", "op_ts")), T.StructField("load_ts", T.LongType())]
)


def encoded(spark, *rows):
    return [tuple(r) for r in encode(spark.createDataFrame(list(rows), SCHEMA), LAYOUT).collect()]


def test_nulls_become_sentinels_and_keys_are_trimmed(spark):
    assert encoded(spark, (" k1 ", None, " b ", "t", 7)) == [("k1", f"k1~{NA}~ b ~t~7")]
    assert encoded(spark, (None, "a", None, None, None)) == [(NA, f"{NA}~a~{NA}~{NA}~{NA}")]


def test_key_and_first_field_trim_independently(spark):
    df = spark.createDataFrame([(" k ", "a", "b", "t", 1)], SCHEMA)
    plain = encode(df, Layout("T", ("k", "a"), tail=())).first()
    assert tuple(plain) == ("k", " k ~a")
    untrimmed = encode(df, Layout("T", ("k", "a"), tail=(), trim_key=False)).first()
    assert tuple(untrimmed) == (" k ", " k ~a")


def test_scrub_removes_both_delimiters_from_listed_columns_only(spark):
    df = spark.createDataFrame([("a~b|c", "x~y")], "p string, q string")
    assert tuple(scrub(df, ["p"]).first()) == ("abc", "x~y")


def test_short_record_decodes_to_nulls(spark):
    df = spark.createDataFrame([("k", "k~a")], "PK string, CT_COL string")
    assert tuple(decode(df, LAYOUT).first()) == ("k", "k", "a", None, None, None)


def test_reencode_drops_load_ts_pads_and_appends(spark):
    df = spark.createDataFrame([("k~a~b~t~1", "g"), ("k~a", None)], "r string, g string")
    out = [r[0] for r in df.select(reencode(F.col("r"), LAYOUT, [F.col("g")])).collect()]
    assert out == ["k~a~b~t~g", f"k~a~{NA}~{NA}~{NA}"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(*[st.one_of(st.none(), st.text(alphabet="ab ~|é%$.\\", max_size=6))] * 4, st.integers(0, 10**14)),
        min_size=1,
        max_size=8,
    )
)
def test_decode_inverts_encode_after_scrub(spark, rows):
    df = scrub(spark.createDataFrame(rows, SCHEMA), LAYOUT.fields)
    df = df.withColumn("op_ts", F.translate("op_ts", "~|", ""))
    back = decode(encode(df, LAYOUT), LAYOUT).drop("PK")
    clean = [F.trim("k").alias("k"), "a", "b", "op_ts", F.col("load_ts").cast("string")]
    expected = df.select(*(F.coalesce(c if not isinstance(c, str) else F.col(c), F.lit(NA)) for c in clean))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, expected.collect()))


def test_layout_sizes_and_rule():
    layouts = default_layouts({"ABM": ["nawbid", "CAWBNO", "cprodcode", "op_ts", "op_type", "load_ts"]})
    sizes = {f: len(layouts[f].columns) for f in layouts}
    assert sizes == {"IBS": 22, "OBS": 22, "MDP": 35, "ALK": 18, "SRT": 29, "MOD": 34, "SFM": 50, "ADT": 5, "ABM": 6, "CPS": 94}
    assert layouts["ABM"].columns == ("cawbno", "nawbid", "cprodcode", "op_ts", "op_type", "load_ts")
    assert len(layouts["IBS"].persistent_columns) == 21
    pickup = layout_from_columns("CPS", ["carea", "ntokenno"])
    assert pickup.columns == ("ntokenno", "carea", "op_ts", "op_type", "cust_ccompgrp", "cgrpname", "load_ts")
    assert not pickup.trim_key
    assert len(default_layouts()["ABM"].fields) == 130 and default_layouts()["ABM"].key == "cawbno"
    assert len(default_layouts()["CPS"].fields) == 89 and default_layouts()["CPS"].key == "ntokenno"


def test_schemas_follow_the_layout():
    layout = default_layouts()["ALK"]
    assert layout.envelope_schema()["after"].dataType.names == list(layout.fields)
    assert layout.landed_schema()["load_ts"].dataType == T.LongType()
