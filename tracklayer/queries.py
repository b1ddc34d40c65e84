"""The operators run over the given tables, each with the SQL it must agree with.

``events`` plays the change feed: a user is a shipment, an event one of its status changes. The master tables are
derived from the tables at hand. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklayer.functions.text import field, or_na
from tracklayer.layouts import ADDRESS_COLUMNS, COLUMNS, NA, SOURCE_TABLES, Layout, default_layouts, layout_from_columns
from tracklayer.operators.cdc import (
    contact_pair,
    latest_per_key,
    latest_records,
    pivot_families,
    pivot_records,
    split_cdc,
    without_deletes,
)
from tracklayer.operators.codec import decode, encode, reencode, scrub
from tracklayer.operators.enrich import enrich_pickup, enrich_shipment, lookup, with_customer, with_pack, with_status
from tracklayer.operators.journey import (
    append_journey,
    build_journey,
    events_of,
    flight_event,
    journey_parts,
    journey_rows,
    pickup_event,
    status_event,
)
from tracklayer.operators.status import (
    CLOSURE_CODES,
    closure_ts,
    delivery_status,
    load_ts_text,
    pickup_load_ts,
    reclassified_date,
    reclassified_status,
    reformat_lts,
)
from tracklayer.plans.batch import BatchConfig, run_batch
from tracklayer.plans.bundle import build_bundle, latest_of, status_journey
from tracklayer.plans.cleanup import reload_alt, run_cleanup, run_reload
from tracklayer.plans.layers import Layers
from tracklayer.plans.promote import promote, promote_alternates
from tracklayer.plans.state import StateTable, delete_keys, merge
from tracklayer.session import concurrently, materialise, work_path
from tracklayer.sources.feed import demultiplex, layout_from_feed, parse, read_feed, route, source_table
from tracklayer.sources.landing import latest_partition, read_landing, select_batch, write_partitions
from tracklayer.sources.masters import Masters, no_masters
from tracklayer.streaming.ingest import start_ingest, start_landing
from tracklayer.streaming.journeys import PROVIDER, ROCKSDB, read_journeys, render_journeys, start_journeys

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-02-20 09:30:00"
SPLIT = "2024-01-16 00:00:00"


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL it must agree with."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(c: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a zone-less timestamp, whatever the session's zone."""
    return F.substring(F.col(c).cast("string"), 1, 19)


def snapshot(master: DataFrame) -> DataFrame:
    """A derived master as a written table, as masters are in practice: its size is then known to the planner."""
    return materialise(master, work_path(master.sparkSession, "master"))


# --- events as a status feed -----------------------------------------------------------------------------------------


def _choose(pairs: dict[str, str], otherwise: str, on: str = "event_type") -> Column:
    chosen = [F.when(F.col(on) == value, result) for value, result in pairs.items()]
    return F.coalesce(*chosen, F.lit(otherwise))


def status_rows(events: DataFrame) -> DataFrame:
    """Status changes: purchases and errors close (type T), the rest are scans (type S)."""
    return events.select(
        F.col("user_id").cast("string").alias("cawbno"),
        _choose({"purchase": "T", "error": "T"}, "S").alias("cstattype"),
        _choose({"purchase": "123", "error": "016", "signup": "015", "view": "018"}, "001").alias("cstatcode"),
        text_of("ts").alias("dstatdate"),
        F.get_json_object("props", "$.k").alias("cloccode"),
        F.nullif(F.col("event_type"), F.lit("click")).alias("cemplcode"),
        text_of("ts").alias("op_ts"),
        _choose({"signup": "I", "error": "D"}, "U").alias("op_type"),
        F.col("event_id").alias("pos"),
        F.regexp_replace(text_of("ts"), "[^0-9]", "").cast("long").alias("load_ts"),
        "event_type",
    )


STATUS_ROWS = """
rows_ AS (
  SELECT CAST(user_id AS VARCHAR) AS cawbno,
    CASE WHEN event_type IN ('purchase', 'error') THEN 'T' ELSE 'S' END AS cstattype,
    CASE event_type WHEN 'purchase' THEN '123' WHEN 'error' THEN '016' WHEN 'signup' THEN '015'
      WHEN 'view' THEN '018' ELSE '001' END AS cstatcode,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS dstatdate,
    json_extract_string(props, '$.k') AS cloccode,
    nullif(event_type, 'click') AS cemplcode,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS op_ts,
    CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op_type,
    event_id AS pos,
    CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS load_ts,
    event_type
  FROM events)"""


def status_master(rows: DataFrame) -> DataFrame:
    """Statuses by (type, code), clicks missing."""
    known = rows.filter(F.col("event_type") != "click").select("cstattype", "cstatcode", "event_type").distinct()
    group, desc = F.concat(F.lit("G"), "cstattype"), F.upper("event_type")
    return snapshot(known.select("cstattype", "cstatcode", group.alias("cstatgroup"), desc.alias("cstatdesc")))


STATUS_MASTER = """
master AS (
  SELECT DISTINCT cstattype, cstatcode, 'G' || cstattype AS cstatgroup, upper(event_type) AS cstatdesc
  FROM rows_ WHERE event_type <> 'click')"""

EVENT_TEXT = """concat(coalesce(r.dstatdate, ''), '~', coalesce(r.cstattype, '') || coalesce(r.cstatcode, ''), '~',
      coalesce(r.cloccode, ''), '~', coalesce(r.cemplcode, ''), '~', coalesce(m.cstatgroup, ''), '~',
      coalesce(m.cstatdesc, ''))"""
JOINED = "rows_ r LEFT JOIN master m ON r.cstattype = m.cstattype AND r.cstatcode = m.cstatcode"


def status_events(rows: DataFrame, suffix: str) -> DataFrame:
    master = status_master(rows)
    return events_of(with_status(rows.filter(F.col("op_type") != "D"), master), "cawbno", status_event(suffix))


@query(
    f"""WITH {STATUS_ROWS}, {STATUS_MASTER},
e AS (SELECT DISTINCT r.cawbno AS pk, {EVENT_TEXT} || '@IB:' || r.op_type AS j FROM {JOINED} WHERE r.op_type <> 'D')
SELECT pk AS "PK", string_agg(j, '|' ORDER BY j) AS "CT_COL" FROM e GROUP BY pk"""
)
def journey_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events"))
    return build_journey(status_events(rows, "@IB"))


def _legs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    inbound = F.col("event_type").isin("purchase", "view")
    return rows.filter(inbound), rows.filter(~inbound)


LEG_EVENTS = f"""
e AS (SELECT DISTINCT r.cawbno AS pk, {EVENT_TEXT}
      || CASE WHEN r.event_type IN ('purchase', 'view') THEN '@IB:' ELSE '@OB:' END || r.op_type AS j,
      r.op_ts >= '{SPLIT}' AS late FROM {JOINED} WHERE r.op_type <> 'D')"""


def leg_events(rows: DataFrame) -> DataFrame:
    """Events of both legs in one pass."""
    suffix = F.when(F.col("event_type").isin("purchase", "view"), "@IB").otherwise("@OB")
    known = with_status(rows.filter(F.col("op_type") != "D"), status_master(rows))
    return events_of(known, "cawbno", status_event(suffix))


@query(
    f"""WITH {STATUS_ROWS}, {STATUS_MASTER}, {LEG_EVENTS}
SELECT pk AS "PK", string_agg(j, '|' ORDER BY j) AS "CT_COL" FROM e GROUP BY pk"""
)
def journey_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events"))
    inbound, outbound = _legs(rows)
    masters = Masters(status_master(rows), *_other_masters(spark))
    return build_journey(status_journey({"IBS": inbound, "OBS": outbound}, FEED_LAYOUTS, masters))


@query(
    f"""WITH {STATUS_ROWS}, {STATUS_MASTER}, {LEG_EVENTS}
SELECT pk AS "PK", substr(j, 1, 10) AS part, string_agg(j, '|' ORDER BY j) AS "CT_COL" FROM e GROUP BY ALL"""
)
def journey_parts_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journey_parts(leg_events(status_rows(table(spark, sf_dir, "events"))), slice_chars=10)


@query(
    f"""WITH {STATUS_ROWS}, {STATUS_MASTER}, {LEG_EVENTS},
stored AS (SELECT pk, string_agg(j, '|' ORDER BY j) AS p FROM e WHERE NOT late GROUP BY pk),
fresh AS (SELECT pk, string_agg(j, '|' ORDER BY j) AS i FROM e WHERE late GROUP BY pk)
SELECT f.pk AS "PK", CASE WHEN p IS NOT NULL THEN concat_ws('|', p, i) ELSE i END AS "CT_COL"
FROM fresh f LEFT JOIN stored s ON s.pk = f.pk"""
)
def journey_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events"))
    events = leg_events(rows)
    late = F.substring("event", 1, 19) >= SPLIT
    stored = build_journey(events.filter(~late)).withColumnRenamed("CT_COL", "PDJ")
    return append_journey(build_journey(events.filter(late)), stored, "PDJ")


# --- change capture --------------------------------------------------------------------------------------------------

EVENT_LAYOUT = Layout("EVT", ("cawbno", "cstattype", "cstatcode", "dstatdate", "cemplcode"), trim_first=True)
EVENT_RECORD = """concat_ws('~', cawbno, cstattype, cstatcode, dstatdate, coalesce(cemplcode, 'NA!@#'), op_ts, op_type,
    CAST(load_ts AS VARCHAR))"""


@query(
    f"""WITH {STATUS_ROWS}
SELECT cawbno, op_ts, pos, event_type, op_type FROM rows_
QUALIFY row_number() OVER (PARTITION BY cawbno ORDER BY op_ts DESC, pos DESC) = 1"""
)
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events")).select("cawbno", "op_ts", "pos", "event_type", "op_type")
    return latest_per_key(rows, ["cawbno"], ["op_ts", "pos"])


@query(
    f"""WITH {STATUS_ROWS}
SELECT cawbno AS "PK", {EVENT_RECORD} AS "CT_COL" FROM rows_ WHERE op_type <> 'D'
QUALIFY row_number() OVER (PARTITION BY cawbno ORDER BY op_ts DESC, pos DESC) = 1"""
)
def cdc_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events"))
    return latest_records(split_cdc(rows, EVENT_LAYOUT, keep=["op_ts", "pos"]), ["op_ts", "pos"])


@query(
    f"""WITH {STATUS_ROWS}
SELECT cawbno AS "PK", CASE WHEN op_type = 'D' THEN 'D!@#' ELSE {EVENT_RECORD} END AS "CT_COL" FROM rows_
QUALIFY row_number() OVER (PARTITION BY cawbno ORDER BY op_ts DESC, pos DESC) = 1"""
)
def cdc_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events"))
    return latest_records(split_cdc(rows, EVENT_LAYOUT, tombstone=True, keep=["op_ts", "pos"]), ["op_ts", "pos"])


@query(
    f"""WITH {STATUS_ROWS},
s AS (SELECT * FROM rows_ WHERE event_type = 'view'
      QUALIFY row_number() OVER (PARTITION BY cawbno ORDER BY op_ts DESC, pos DESC) = 1),
r AS (SELECT * FROM rows_ WHERE event_type = 'purchase'
      QUALIFY row_number() OVER (PARTITION BY cawbno ORDER BY op_ts DESC, pos DESC) = 1)
SELECT s.cawbno, s.cstatcode AS ccode, r.cloccode AS cattention, s.cloccode AS csender, s.op_ts
FROM s JOIN r ON s.cawbno = r.cawbno"""
)
def contact_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events"))
    return contact_pair(
        rows, "cawbno", "event_type", "cloccode", "cstatcode", order=["op_ts", "pos"], sides=("view", "purchase")
    )


@query(
    f"""WITH {STATUS_ROWS},
k AS (SELECT *, {EVENT_RECORD} AS ct FROM rows_ QUALIFY row_number() OVER
      (PARTITION BY cawbno, event_type ORDER BY op_ts DESC, pos DESC) = 1)
SELECT cawbno AS "PK", max(CASE event_type WHEN 'click' THEN ct END) AS click,
  max(CASE event_type WHEN 'error' THEN ct END) AS error, max(CASE event_type WHEN 'purchase' THEN ct END) AS purchase,
  max(CASE event_type WHEN 'signup' THEN ct END) AS signup, max(CASE event_type WHEN 'view' THEN ct END) AS view
FROM k GROUP BY cawbno"""
)
def family_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events")).withColumnRenamed("event_type", "family")
    order = ["op_ts", "pos"]
    records = encode(rows, EVENT_LAYOUT, ["family", *order])
    return pivot_records(records, ["click", "error", "purchase", "signup", "view"], order)


# --- codec -----------------------------------------------------------------------------------------------------------

PART_LAYOUT = Layout("PRT", ("p_partkey", "p_name", "p_brand", "p_type", "p_size"), tail=("op_type", "load_ts"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    kind = F.nullif(F.col("p_type"), F.lit("SMALL")).alias("p_type")
    stamp = (F.lit(20240101000000) + F.col("p_size")).alias("load_ts")
    return parts.select("p_partkey", "p_name", "p_brand", kind, "p_size", F.lit("U").alias("op_type"), stamp)


PART_RECORD = """concat_ws('~', p_partkey, p_name, p_brand, coalesce(nullif(p_type, 'SMALL'), 'NA!@#'), p_size, 'U',
    20240101000000 + p_size)"""


@query(f"""SELECT CAST(p_partkey AS VARCHAR) AS "PK", {PART_RECORD} AS "CT_COL" FROM part""")
def record_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_parts(spark, sf_dir), PART_LAYOUT)


@query(
    f"""WITH e AS (SELECT CAST(p_partkey AS VARCHAR) AS pk, {PART_RECORD} AS ct FROM part)
SELECT pk AS "PK", split_part(ct, '~', 1) AS p_partkey, split_part(ct, '~', 2) AS p_name,
  split_part(ct, '~', 3) AS p_brand, split_part(ct, '~', 4) AS p_type, split_part(ct, '~', 5) AS p_size,
  split_part(ct, '~', 6) AS op_type, split_part(ct, '~', 7) AS load_ts FROM e"""
)
def record_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(encode(_parts(spark, sf_dir), PART_LAYOUT), PART_LAYOUT)


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS "PK", concat_ws('~', p_partkey, p_name, p_brand,
  coalesce(nullif(p_type, 'SMALL'), 'NA!@#'), p_size, 'U', coalesce(nullif(p_brand, 'Brand#2'), 'NA!@#'), 'tail')
  AS "CT_COL" FROM part"""
)
def record_reencode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode(_parts(spark, sf_dir), PART_LAYOUT, keep=["p_brand"])
    extra = [F.nullif(F.col("p_brand"), F.lit("Brand#2")), F.lit("tail")]
    return records.select("PK", reencode(F.col("CT_COL"), PART_LAYOUT, extra).alias("CT_COL"))


@query("SELECT doc_id, regexp_replace(text, '[~|]', '', 'g') AS text, lang FROM documents")
def scrub_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scrub(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ["text"])


# --- masters ---------------------------------------------------------------------------------------------------------


@query(
    """WITH master AS (SELECT DISTINCT l_returnflag AS t, l_linestatus AS c, l_returnflag || l_linestatus AS g,
  lower(l_linestatus) AS d FROM lineitem WHERE l_returnflag <> 'N')
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, g AS stat_cstatgroup, d AS stat_cstatdesc
FROM lineitem LEFT JOIN master ON l_returnflag = t AND l_linestatus = c"""
)
def dim_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "lineitem")
    master = facts.filter(F.col("l_returnflag") != "N").select(
        F.col("l_returnflag").alias("cstattype"),
        F.col("l_linestatus").alias("cstatcode"),
        F.concat("l_returnflag", "l_linestatus").alias("cstatgroup"),
        F.lower("l_linestatus").alias("cstatdesc"),
    )
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"]
    return with_status(facts.select(*columns), snapshot(master.distinct()), "l_returnflag", "l_linestatus")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as shipments: area by priority, code by status, both with sentinels; product fields by part."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("cawbno"),
        or_na(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))).alias("cbtparea"),
        or_na(F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("cbtpcode"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("corgarea"),
        F.lit("F").alias("ccustcode"),
        or_na(F.nullif(F.col("o_orderstatus"), F.lit("O"))).alias("cprodcode"),
        F.substring("o_orderpriority", 1, 1).alias("cmode"),
        F.col("o_orderstatus").alias("cpacktype"),
        text_of("o_orderdate").alias("op_ts"),
    )


SHIPMENTS = """
ship AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cawbno, coalesce(nullif(o_orderpriority, '5-LOW'), 'NA!@#') AS cbtparea,
    coalesce(nullif(o_orderstatus, 'P'), 'NA!@#') AS cbtpcode, nullif(o_orderpriority, '1-URGENT') AS corgarea,
    'F' AS ccustcode, coalesce(nullif(o_orderstatus, 'O'), 'NA!@#') AS cprodcode,
    substr(o_orderpriority, 1, 1) AS cmode, o_orderstatus AS cpacktype,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS op_ts
  FROM orders)"""


def order_masters(spark: SparkSession, sf_dir: str) -> Masters:
    """Customer, pack and group masters derived from orders and regions, NULL keys included."""
    orders = table(spark, sf_dir, "orders")
    area = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    code = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    customer = (
        orders.groupBy(area.alias("carea"), code.alias("ccustcode"))
        .agg(F.min("o_orderkey").alias("low"))
        .select("carea", "ccustcode", F.substring(F.col("low").cast("string"), -1, 1).alias("ccompgrp"))
    )
    product = F.nullif(F.col("o_orderstatus"), F.lit("O"))
    mode = F.substring("o_orderpriority", 1, 1)
    pack = (
        orders.filter(F.col("o_orderpriority") != "3-MEDIUM")
        .groupBy(product.alias("cprodcode"), mode.alias("csubprdcd"), F.col("o_orderstatus").alias("cpacktype"))
        .agg(F.min("o_orderkey").cast("string").alias("cprodparent"), F.max("o_orderkey").cast("string").alias("hi"))
        .select(
            "cprodcode",
            "csubprdcd",
            "cpacktype",
            "cprodparent",
            F.concat(F.lit("N"), "hi").alias("cprodcommname"),
            F.concat(F.lit("S"), "csubprdcd").alias("csubprdcommname"),
            F.nullif(F.col("cpacktype"), F.lit("F")).alias("cprodgroup"),
        )
    )
    region = table(spark, sf_dir, "region")
    group = region.select(F.col("r_regionkey").cast("string").alias("ccompgrp"), F.col("r_name").alias("ccompname"))
    rows = status_rows(table(spark, sf_dir, "events"))
    jobs = [partial(snapshot, customer), partial(snapshot, pack), partial(status_master, rows)]
    customer, pack, status = concurrently(spark, *jobs)
    return Masters(status, customer, pack, group)


ORDER_MASTERS = """
cust AS (SELECT nullif(o_orderpriority, '5-LOW') AS carea, nullif(o_orderstatus, 'P') AS ccustcode,
    right(CAST(min(o_orderkey) AS VARCHAR), 1) AS ccompgrp FROM orders GROUP BY 1, 2),
pack AS (SELECT nullif(o_orderstatus, 'O') AS cprodcode, substr(o_orderpriority, 1, 1) AS csubprdcd,
    o_orderstatus AS cpacktype, CAST(min(o_orderkey) AS VARCHAR) AS cprodparent,
    'N' || CAST(max(o_orderkey) AS VARCHAR) AS cprodcommname, 'S' || substr(o_orderpriority, 1, 1) AS csubprdcommname,
    nullif(o_orderstatus, 'F') AS cprodgroup FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY ALL),
grp AS (SELECT CAST(r_regionkey AS VARCHAR) AS ccompgrp, r_name AS ccompname FROM region)"""


@query(
    f"""WITH {SHIPMENTS}, {ORDER_MASTERS}
SELECT cawbno, cbtparea, cbtpcode, ccompgrp AS cust_ccompgrp FROM ship
LEFT JOIN cust ON cbtparea = coalesce(carea, 'NA!@#') AND cbtpcode = coalesce(cust.ccustcode, 'NA!@#')"""
)
def dim_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = shipments(spark, sf_dir).select("cawbno", "cbtparea", "cbtpcode")
    return with_customer(facts, order_masters(spark, sf_dir).customer, "cbtparea", "cbtpcode")


@query(
    f"""WITH {SHIPMENTS}, {ORDER_MASTERS}
SELECT cawbno, ship.cprodcode, cmode, ship.cpacktype, cprodparent AS pack_cprodparent,
  cprodcommname AS pack_cprodcommname, csubprdcommname AS pack_csubprdcommname, cprodgroup AS pack_cprodgroup FROM ship
LEFT JOIN pack ON ship.cprodcode = coalesce(pack.cprodcode, 'NA!@#') AND cmode = coalesce(csubprdcd, 'NA!@#')
  AND ship.cpacktype = coalesce(pack.cpacktype, 'NA!@#')"""
)
def dim_three_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = shipments(spark, sf_dir).select("cawbno", "cprodcode", "cmode", "cpacktype")
    return with_pack(facts, order_masters(spark, sf_dir).pack, "cprodcode", "cmode", "cpacktype")


@query(
    """SELECT o_orderkey, o_custkey, c_nationkey, n_name, n_regionkey, r_name FROM orders
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def dim_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    steps = [
        ("customer", "o_custkey", "c_custkey", ["c_nationkey"]),
        ("nation", "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"]),
        ("region", "n_regionkey", "r_regionkey", ["r_name"]),
    ]
    for name, key, master_key, take in steps:
        facts = lookup(facts, table(spark, sf_dir, name), [(F.col(key), master_key)], {c: c for c in take})
    return facts


ENRICHED = """
LEFT JOIN cust ON CASE WHEN cbtparea = 'NA!@#' THEN corgarea ELSE cbtparea END = coalesce(carea, 'NA!@#')
  AND CASE WHEN cbtpcode = 'NA!@#' THEN ship.ccustcode ELSE cbtpcode END = coalesce(cust.ccustcode, 'NA!@#')
LEFT JOIN pack ON ship.cprodcode = coalesce(pack.cprodcode, 'NA!@#') AND cmode = coalesce(csubprdcd, 'NA!@#')
  AND ship.cpacktype = coalesce(pack.cpacktype, 'NA!@#')
LEFT JOIN grp ON grp.ccompgrp = cust.ccompgrp"""


@query(
    f"""WITH {SHIPMENTS}, {ORDER_MASTERS}
SELECT cawbno, cust.ccompgrp AS cust_ccompgrp, cprodparent AS pack_cprodparent, cprodcommname AS pack_cprodcommname,
  csubprdcommname AS pack_csubprdcommname, cprodgroup AS pack_cprodgroup, ccompname AS cgrpname FROM ship {ENRICHED}"""
)
def shipment_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = order_masters(spark, sf_dir)
    out = enrich_shipment(shipments(spark, sf_dir), m.customer, m.pack, m.group)
    names = ["cprodparent", "cprodcommname", "csubprdcommname", "cprodgroup"]
    return out.select("cawbno", "cust_ccompgrp", *(f"pack_{n}" for n in names), "cgrpname")


@query(
    f"""WITH {SHIPMENTS}, {ORDER_MASTERS}
SELECT cawbno, cust.ccompgrp AS cust_ccompgrp, ccompname AS cgrpname FROM ship
LEFT JOIN cust ON cbtparea = coalesce(carea, 'NA!@#') AND cbtpcode = coalesce(cust.ccustcode, 'NA!@#')
LEFT JOIN grp ON grp.ccompgrp = cust.ccompgrp"""
)
def pickup_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = order_masters(spark, sf_dir)
    calls = shipments(spark, sf_dir).withColumns({"carea": F.col("cbtparea"), "ccustcode": F.col("cbtpcode")})
    known = enrich_pickup(calls.select("cawbno", "carea", "ccustcode"), m.customer, m.group)
    return known.select("cawbno", "cust_ccompgrp", "cgrpname")


# --- pickups and flights ---------------------------------------------------------------------------------------------

PICKUP_COLUMNS = ("ntokenno", "carea", "ccustcode", "dregdate", "dpudate", "crevpu")


def pickup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pickup calls of a customer; low-priority ones are deletes."""
    day = F.substring(text_of("o_orderdate"), 1, 10)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("ntokenno"),
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("carea"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("ccustcode"),
        day.alias("dregdate"),
        F.nullif(day, F.lit("1998-01-01")).alias("dpudate"),
        F.col("o_orderstatus").alias("crevpu"),
        text_of("o_orderdate").alias("op_ts"),
        F.when(F.col("o_orderpriority") == "5-LOW", "D").otherwise("I").alias("op_type"),
        F.col("o_orderkey").alias("pos"),
        F.regexp_replace(text_of("o_orderdate"), "[^0-9]", "").cast("long").alias("load_ts"),
    )


PICKUP_ROWS = """
pick AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ntokenno, nullif(o_orderpriority, '3-MEDIUM') AS carea,
    nullif(o_orderstatus, 'P') AS ccustcode, strftime(o_orderdate, '%Y-%m-%d') AS dregdate,
    nullif(strftime(o_orderdate, '%Y-%m-%d'), '1998-01-01') AS dpudate, o_orderstatus AS crevpu,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS op_ts, 'I' AS op_type, o_orderkey AS pos,
    strftime(o_orderdate, '%Y%m%d%H%M%S') AS load_ts
  FROM orders WHERE o_orderpriority <> '5-LOW')"""


@query(
    f"""WITH {PICKUP_ROWS},
e AS (SELECT DISTINCT ntokenno, concat_ws('~', dregdate, coalesce(dpudate, ''), crevpu) || ':I' AS j FROM pick)
SELECT ntokenno AS "PK", string_agg(j, '|' ORDER BY j) AS "CT_COL" FROM e GROUP BY ntokenno"""
)
def pickup_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pickup_rows(spark, sf_dir).filter(F.col("op_type") != "D")
    return build_journey(events_of(rows, "ntokenno", pickup_event()))


@query(
    f"""WITH {PICKUP_ROWS}, {ORDER_MASTERS},
top AS (SELECT * FROM pick QUALIFY row_number() OVER (PARTITION BY ntokenno ORDER BY op_ts DESC, pos DESC) = 1)
SELECT ntokenno AS "PK", concat_ws('~', ntokenno, coalesce(top.carea, 'NA!@#'), coalesce(top.ccustcode, 'NA!@#'),
  dregdate, coalesce(dpudate, 'NA!@#'), crevpu, op_ts, op_type, coalesce(cust.ccompgrp, 'NA!@#'),
  coalesce(ccompname, 'NA!@#'), load_ts) AS "CPS" FROM top
LEFT JOIN cust ON top.carea = coalesce(cust.carea, 'NA!@#') AND top.ccustcode = coalesce(cust.ccustcode, 'NA!@#')
LEFT JOIN grp ON grp.ccompgrp = cust.ccompgrp"""
)
def pickup_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    layouts = {"CPS": layout_from_columns("CPS", PICKUP_COLUMNS)}
    bundle = build_bundle({"CPS": pickup_rows(spark, sf_dir)}, layouts, order_masters(spark, sf_dir))
    return latest_of(bundle["CPS"], "CPS")


@query(
    """WITH e AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS pk, concat_ws('~', l_suppkey,
  strftime(l_shipdate, '%Y-%m-%d'), '', l_partkey, l_returnflag, l_linestatus, coalesce(nullif(l_returnflag, 'N'), ''),
  l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) || ':U' AS j FROM lineitem)
SELECT pk AS "PK", string_agg(j, '|' ORDER BY j) AS "CT_COL" FROM e GROUP BY pk"""
)
def flight_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = text_of("l_shipdate")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("cawbno"),
        F.col("l_suppkey").alias("nrunid"),
        F.substring(date, 1, 10).alias("drundate"),
        F.lit(None).cast("string").alias("corgarea"),
        F.col("l_partkey").alias("cruncode"),
        F.col("l_returnflag").alias("cstattype"),
        F.col("l_linestatus").alias("cstatcode"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("cemplcode"),
        F.col("l_linenumber").alias("cloccode"),
        date.alias("dstatdate"),
        F.lit("U").alias("op_type"),
    )
    return build_journey(events_of(rows, "cawbno", flight_event()))


# --- status and dates ------------------------------------------------------------------------------------------------


def _leg_records(rows: DataFrame) -> DataFrame:
    """Latest inbound and outbound record of each shipment, encoded."""
    leg = F.when(F.col("event_type").isin("purchase", "view"), "IBS").otherwise("OBS")
    order = ["op_ts", "pos"]
    records = encode(rows.withColumn("family", leg), EVENT_LAYOUT, ["family", *order])
    return pivot_records(records, ["IBS", "OBS"], order)


def _latest_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leg_records(status_rows(table(spark, sf_dir, "events")))


LATEST_LEGS = f"""
leg AS (SELECT *, CASE WHEN event_type IN ('purchase', 'view') THEN 'I' ELSE 'O' END AS side FROM rows_
  QUALIFY row_number() OVER (PARTITION BY cawbno, CASE WHEN event_type IN ('purchase', 'view') THEN 'I' ELSE 'O' END
    ORDER BY op_ts DESC, pos DESC) = 1),
st AS (SELECT cawbno AS pk, CASE
    WHEN bool_or(side = 'I' AND cstattype = 'T' AND cstatcode IN ('123', '016')) THEN
      max(CASE WHEN side = 'I' THEN cstattype || cstatcode END)
    WHEN bool_or(side = 'O' AND cstattype = 'T' AND cstatcode IN ('123', '016')) THEN
      max(CASE WHEN side = 'O' THEN cstattype || cstatcode END)
    ELSE 'UD' END AS status FROM leg GROUP BY cawbno)"""


def _leg_status() -> Column:
    fields = [field(f, EVENT_LAYOUT.position(c)) for f in ("IBS", "OBS") for c in ("cstattype", "cstatcode")]
    return delivery_status(*fields, codes=CLOSURE_CODES)


@query(f"""WITH {STATUS_ROWS}, {LATEST_LEGS} SELECT pk AS "PK", status AS delivery_status FROM st""")
def closure_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_legs(spark, sf_dir).select("PK", _leg_status().alias("delivery_status"))


@query(
    f"""WITH {STATUS_ROWS}, {LATEST_LEGS}
SELECT pk AS "PK", '{AS_OF[:16]}' AS "CT_COL" FROM st WHERE status <> 'UD'"""
)
def closure_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = _latest_legs(spark, sf_dir).select("PK", _leg_status().alias("s"))
    return status.filter(F.col("s") != "UD").select("PK", closure_ts(F.col("s"), AS_OF).alias("CT_COL"))


def stored_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A persistent layer keyed by user and day: families there, missing or sentinel as its events say; and the events."""
    rows = status_rows(table(spark, sf_dir, "events")).withColumn(
        "cawbno", F.concat("cawbno", F.lit("-"), F.substring("dstatdate", 1, 10))
    )
    code = F.concat("cstattype", "cstatcode")
    event = F.concat_ws("~", "dstatdate", code, "cloccode", F.coalesce("cemplcode", F.lit("")))
    events = events_of(rows.filter(F.col("op_type") != "I"), "cawbno", F.concat(event, F.lit("@IB:U")))

    def seen(kind: str) -> Column:
        return F.max(F.col("event_type") == kind)

    facts = rows.groupBy(F.col("cawbno").alias("PK")).agg(
        F.when(seen("click"), "abm").when(seen("error"), NA).alias("ABM"),
        F.when(seen("signup"), "slt").when(seen("purchase"), NA).alias("SLT"),
        F.when(seen("error"), "T123").when(seen("purchase"), "123").when(seen("signup"), "I").alias("DLS"),
        F.substring(F.min("dstatdate"), 1, 16).alias("DTS"),
    )
    return facts, events


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each journey in a cell."""
    facts, events = stored_facts(spark, sf_dir)
    return facts.join(build_journey(events).withColumnRenamed("CT_COL", "PDJ"), "PK", "left")


STORED_ROWS = """
ev AS (SELECT cawbno || '-' || substr(dstatdate, 1, 10) AS pk, * FROM rows_),
jn AS (SELECT pk, string_agg(j, '|' ORDER BY j) AS pdj FROM (SELECT DISTINCT pk, concat_ws('~', dstatdate,
    cstattype || cstatcode, cloccode, coalesce(cemplcode, '')) || '@IB:U' AS j FROM ev WHERE op_type <> 'I') GROUP BY pk),
fx AS (SELECT pk,
    CASE WHEN bool_or(event_type = 'click') THEN 'abm' WHEN bool_or(event_type = 'error') THEN 'NA!@#' END AS abm,
    CASE WHEN bool_or(event_type = 'signup') THEN 'slt' WHEN bool_or(event_type = 'purchase') THEN 'NA!@#' END AS slt,
    CASE WHEN bool_or(event_type = 'error') THEN 'T123' WHEN bool_or(event_type = 'purchase') THEN '123'
      WHEN bool_or(event_type = 'signup') THEN 'I' END AS dls,
    substr(min(dstatdate), 1, 16) AS dts FROM ev GROUP BY pk),
pl AS (SELECT fx.*, jn.pdj, coalesce(abm = 'NA!@#', true) AND coalesce(slt = 'NA!@#', true) AS noship,
    coalesce(jn.pdj = 'NA!@#', true) AS nojourney, abm IS NOT NULL OR slt IS NOT NULL AS ship,
    CASE WHEN instr(jn.pdj, '~S015~') > 0 THEN
      try_cast(substr(jn.pdj, greatest(instr(jn.pdj, '~S015~') - 19, 1), 10) AS DATE) END AS d15,
    CASE WHEN instr(jn.pdj, '~S018~') > 0 THEN
      try_cast(substr(jn.pdj, greatest(instr(jn.pdj, '~S018~') - 19, 1), 10) AS DATE) END AS d18
  FROM fx LEFT JOIN jn ON fx.pk = jn.pk),
ig AS (SELECT *, (instr(pdj, 'S015') = 0 AND instr(pdj, 'S018') = 0)
    OR coalesce(DATE '2024-02-20' - d15 > 45, false) OR coalesce(DATE '2024-02-20' - d18 > 45, false) AS ignorable,
    list_last(string_split(pdj, '|'))[1:16] AS lastdate FROM pl)"""


def _closure_case(result: Callable[[str], str]) -> str:
    return " ".join(f"WHEN ship AND instr(pdj, '~T{c}~') > 0 THEN {result(c)}" for c in CLOSURE_CODES)


_CODES_SQL = ", ".join(f"'{c}'" for c in CLOSURE_CODES)


_STATUS_CASE = f"""coalesce(CASE WHEN noship AND nojourney THEN 'I'
  WHEN noship AND pdj IS NOT NULL THEN CASE WHEN ignorable THEN 'I' ELSE 'UD' END
  WHEN ship AND nojourney THEN 'NA!@#' {_closure_case(lambda c: f"'T{c}'")}
  WHEN ship AND (dls IS NULL OR substr(dls, 1, 3) NOT IN ({_CODES_SQL}) OR dls IN ('I', 'NA!@#')) THEN 'UD'
  ELSE dls END, 'NA!@#')"""
_DATE_CASE = f"""coalesce(CASE WHEN noship AND nojourney THEN '{AS_OF[:16]}'
  WHEN noship AND pdj IS NOT NULL THEN CASE WHEN ignorable THEN '{AS_OF[:16]}' ELSE lastdate END
  {_closure_case(lambda c: f"substr(pdj, instr(pdj, '~T{c}~') - 19, 16)")}
  WHEN ship AND pdj IS NOT NULL THEN lastdate ELSE dts END, 'NA!@#')"""


@query(f"""WITH {STATUS_ROWS}, {STORED_ROWS} SELECT pk AS "PK", {_STATUS_CASE} AS "CT_COL" FROM ig""")
def reclassify_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_rows(spark, sf_dir).select("PK", reclassified_status(as_of=AS_OF).alias("CT_COL"))


@query(f"""WITH {STATUS_ROWS}, {STORED_ROWS} SELECT pk AS "PK", {_DATE_CASE} AS "CT_COL" FROM ig""")
def reclassify_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_rows(spark, sf_dir).select("PK", reclassified_date(as_of=AS_OF).alias("CT_COL"))


@query(f"""WITH {STATUS_ROWS}, {STORED_ROWS} SELECT pk AS "PK", {_STATUS_CASE} AS "DLS", {_DATE_CASE} AS "DTS" FROM ig""")
def cleanup_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(spark, work_path(spark, "cleanup"), {})
    facts, events = stored_facts(spark, sf_dir)
    journeys = journey_rows(events).select("PK", F.col("event").alias("PDJ"))
    layers.persistent.upsert(facts.unionByName(journeys, allowMissingColumns=True), 0)
    run_cleanup(layers, as_of=AS_OF, batch_id=0)
    return layers.persistent.read(["DLS", "DTS"])


@query(
    f"""WITH {STATUS_ROWS}, {LATEST_LEGS}
SELECT pk AS "PK", (SELECT strftime(strptime(CAST(greatest(max(CASE WHEN side = 'I' THEN load_ts END),
  max(CASE WHEN side = 'O' THEN load_ts END)) AS VARCHAR), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') FROM leg) AS "CT_COL"
FROM st"""
)
def batch_load_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    il = _latest_legs(spark, sf_dir)
    stamps = [field(f, EVENT_LAYOUT.position("load_ts")).try_cast("long") for f in ("IBS", "OBS")]
    return il.select("PK", load_ts_text(il, stamps).alias("CT_COL"))


@query(
    f"""WITH {STATUS_ROWS}
SELECT cawbno AS "PK", strftime(strptime(CAST((SELECT max(load_ts) FROM rows_) AS VARCHAR), '%Y%m%d%H%M%S'),
  '%Y-%m-%d %H:%M:%S') AS "CT_COL" FROM rows_"""
)
def pickup_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pickup_load_ts(status_rows(table(spark, sf_dir, "events")).select("cawbno", "load_ts"), "cawbno")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS "PK", strftime(strptime(strftime(ts, '%Y%m%d%H%M'), '%Y%m%d%H%M'),
  '%Y-%m-%d %H:%M:%S') AS "CT_COL" FROM events WHERE strftime(ts, '%Y%m%d%H%M') LIKE '2024010%'"""
)
def load_ts_reformat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.substring(F.regexp_replace(text_of("ts"), "[^0-9]", ""), 1, 12)
    stored = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("PK"), stamp.alias("LTS"))
    return reformat_lts(stored, "2024010")


# --- incremental batches ---------------------------------------------------------------------------------------------


@query(
    f"""WITH {STATUS_ROWS}
SELECT cawbno, pos, load_ts FROM rows_ WHERE load_ts < 20240119235800
  AND load_ts > (SELECT max(load_ts) FROM rows_ WHERE op_ts < '2024-01-10')"""
)
def due_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = status_rows(table(spark, sf_dir, "events")).select("cawbno", "pos", "load_ts", "op_ts")
    last = landed.filter(F.col("op_ts") < "2024-01-10")
    return select_batch(landed, last, datetime(2024, 1, 20)).drop("op_ts")


@query(
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS load_ts FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"""
)
def newest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.regexp_replace(F.substring(text_of("ts"), 1, 10), "-", "").cast("long")
    return latest_partition(table(spark, sf_dir, "events").select("event_id", day.alias("load_ts")))


# --- state -----------------------------------------------------------------------------------------------------------


def _two_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Latest record per leg and new events of each half of the feed: the deltas of two batches."""
    rows = status_rows(table(spark, sf_dir, "events"))
    master = status_master(rows)
    out = []
    for half in (rows.filter(F.col("op_ts") < SPLIT), rows.filter(F.col("op_ts") >= SPLIT)):
        records = _leg_records(half)
        live = half.filter(F.col("op_type") != "D")
        events = journey_rows(events_of(with_status(live, master), "cawbno", status_event("@IB")))
        journeys = events.select("PK", F.col("event").alias("PDJ"))
        out.append(records.unionByName(journeys, allowMissingColumns=True))
    return out


TWO_BATCHES = f"""
rec AS (SELECT *, {EVENT_RECORD} AS ct, CASE WHEN event_type IN ('purchase', 'view') THEN 'I' ELSE 'O' END AS side
  FROM rows_),
top AS (SELECT cawbno, side, ct FROM rec
  QUALIFY row_number() OVER (PARTITION BY cawbno, side ORDER BY op_ts DESC, pos DESC) = 1),
e AS (SELECT DISTINCT r.cawbno AS pk, {EVENT_TEXT} || '@IB:' || r.op_type AS j FROM {JOINED} WHERE r.op_type <> 'D'),
jn AS (SELECT pk, string_agg(j, '|' ORDER BY j) AS pdj FROM e GROUP BY pk)
SELECT cawbno AS "PK", max(CASE side WHEN 'I' THEN ct END) AS "IBS", max(CASE side WHEN 'O' THEN ct END) AS "OBS",
  max(pdj) AS "PDJ" FROM top LEFT JOIN jn ON jn.pk = cawbno GROUP BY cawbno"""


def _state(spark: SparkSession) -> StateTable:
    return StateTable(spark, work_path(spark, "state"), ["IBS", "OBS"], ["PDJ"])


@query(f"WITH {STATUS_ROWS}, {STATUS_MASTER}, {TWO_BATCHES}")
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state(spark)
    for batch_id, delta in enumerate(_two_batches(spark, sf_dir)):
        state.upsert(delta, batch_id)
        state.upsert(delta, batch_id)  # a replay changes nothing
    return state.read()


@query(f"WITH {STATUS_ROWS}, {STATUS_MASTER}, {TWO_BATCHES}")
def state_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is dealt to more parts after each batch."""
    state = _state(spark)
    for batch_id, delta in enumerate(_two_batches(spark, sf_dir)):
        state.upsert(delta, batch_id)
        state = state.resized(2 * state.parts)
    return state.read()


@query(
    """SELECT coalesce(CAST(o.k AS VARCHAR), CAST(c_custkey AS VARCHAR)) AS "PK", coalesce(seg, c_mktsegment) AS segment,
  c_name AS name, o.n AS orders FROM customer FULL JOIN
  (SELECT o_custkey AS k, max(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END) AS seg, CAST(count(*) AS VARCHAR)
     AS n FROM orders GROUP BY o_custkey) o ON o.k = c_custkey"""
)
def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("PK"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("orders"),
    )
    status = F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    delta = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("PK"))
        .agg(status.alias("segment"), F.count("*").cast("string").alias("orders"))
        .withColumn("name", F.lit(None).cast("string"))
    )
    return merge(base, delta, ["segment", "name", "orders"])


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS "PK", c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""
)
def key_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("PK"), "c_name")
    gone = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    return delete_keys(rows, gone.select(F.col("o_custkey").cast("string").alias("PK")))


ALTERNATES = """WITH pl AS (SELECT CAST(o_orderkey AS VARCHAR) AS pk,
  CASE o_orderstatus WHEN 'F' THEN 'NA!@#~x' WHEN 'O' THEN o_orderkey || '~' || o_orderpriority END AS alk,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'NA!@#' WHEN o_orderpriority <> '5-LOW' THEN o_custkey || '~i' END AS srt,
  CASE WHEN o_orderstatus <> 'P' THEN 'j' || o_custkey END AS srj FROM orders)
SELECT * FROM (SELECT pk AS "PK", CASE WHEN split_part(alk, '~', 1) <> 'NA!@#' THEN alk END AS "ALK",
  CASE WHEN split_part(srt, '~', 1) <> 'NA!@#' THEN srt END AS "SRT",
  CASE WHEN split_part(srt, '~', 1) <> 'NA!@#' THEN srj END AS "SRJ" FROM pl)
WHERE coalesce("ALK", "SRT", "SRJ") IS NOT NULL"""


@query(ALTERNATES)
def alternate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reload_alt(stored_alternates(spark, sf_dir))


@query(ALTERNATES)
def reload_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(spark, work_path(spark, "reload"), {})
    layers.persistent.upsert(stored_alternates(spark, sf_dir), 0)
    for batch_id in range(2):
        run_reload(layers, batch_id=batch_id)  # replaces, so a second reload changes nothing
    return layers.link.read(["ALK", "SRT", "SRJ"])


def stored_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("PK"),
        F.when(status == "F", NA + "~x").when(status == "O", F.concat_ws("~", "o_orderkey", priority)).alias("ALK"),
        F.when(priority == "1-URGENT", NA).when(priority != "5-LOW", F.concat("o_custkey", F.lit("~i"))).alias("SRT"),
        F.when(status != "P", F.concat(F.lit("j"), "o_custkey")).alias("SRJ"),
    )


# --- promotion -------------------------------------------------------------------------------------------------------

SHIP_FIELDS = ("cawbno", "cprodcode", "corgarea", "ccustcode", "cpacktype", "cmode", "cbtpcode", "cbtparea")
REDUCED = {
    "ABM": Layout("ABM", SHIP_FIELDS, trim_first=True),
    "SLT": Layout("SLT", SHIP_FIELDS, trim_first=True),
    "IBS": Layout("IBS", EVENT_LAYOUT.fields, trim_first=True),
    "OBS": Layout("OBS", EVENT_LAYOUT.fields, trim_first=True),
    "SRT": Layout("SRT", ("cawbno", "dentdate", "cremarks")),
}


def promotion_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental layer: shipments by order number, status legs by user number, deletes as tombstones."""
    order = ["op_ts", "pos"]
    ship = shipments(spark, sf_dir).withColumns(
        {
            "op_type": F.when(F.col("cpacktype") == "P", "D").otherwise("U"),
            "load_ts": F.regexp_replace("op_ts", "[^0-9]", "").cast("long"),
            "pos": F.lit(0).cast("long"),
        }
    )
    inbound, outbound = _legs(status_rows(table(spark, sf_dir, "events")))
    frames = {
        "ABM": split_cdc(ship, REDUCED["ABM"], keep=order),
        "SLT": split_cdc(ship, REDUCED["SLT"], tombstone=True, keep=order),
        "IBS": split_cdc(inbound, REDUCED["IBS"], keep=order),
        "OBS": split_cdc(outbound, REDUCED["OBS"], keep=order),
    }
    return pivot_families(frames, order)


_SHIP_RECORD = """concat_ws('~', ship.cawbno, ship.cprodcode, coalesce(corgarea, 'NA!@#'), ship.ccustcode,
    ship.cpacktype, cmode, cbtpcode, cbtparea, ship.op_ts, 'U', coalesce(cust.ccompgrp, 'NA!@#'),
    coalesce(cprodparent, 'NA!@#'), coalesce(cprodcommname, 'NA!@#'), coalesce(csubprdcommname, 'NA!@#'),
    coalesce(cprodgroup, 'NA!@#'), coalesce(ccompname, 'NA!@#'))"""
_SHIP_JOIN = ENRICHED.replace("THEN corgarea", "THEN coalesce(corgarea, 'NA!@#')")


@query(
    f"""WITH {STATUS_ROWS}, {STATUS_MASTER}, {SHIPMENTS}, {ORDER_MASTERS},
live AS (SELECT *, CASE WHEN event_type IN ('purchase', 'view') THEN 'I' ELSE 'O' END AS side FROM rows_
  WHERE op_type <> 'D'),
leg AS (SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY cawbno, side ORDER BY op_ts DESC, pos DESC) = 1),
rec AS (SELECT r.*, concat_ws('~', r.cawbno, r.cstattype, r.cstatcode, r.dstatdate, coalesce(r.cemplcode, 'NA!@#'),
    r.op_ts, r.op_type, coalesce(m.cstatgroup, 'NA!@#'), coalesce(m.cstatdesc, 'NA!@#')) AS ct
  FROM leg r LEFT JOIN master m ON r.cstattype = m.cstattype AND r.cstatcode = m.cstatcode),
sts AS (SELECT cawbno, max(CASE side WHEN 'I' THEN ct END) AS ibs, max(CASE side WHEN 'O' THEN ct END) AS obs,
    CASE WHEN bool_or(side = 'I' AND cstattype = 'T') THEN max(CASE side WHEN 'I' THEN cstattype || cstatcode END)
      WHEN bool_or(side = 'O' AND cstattype = 'T') THEN max(CASE side WHEN 'O' THEN cstattype || cstatcode END)
      ELSE 'UD' END AS status FROM rec GROUP BY cawbno),
shp AS (SELECT ship.cawbno, ship.cpacktype = 'P' AS gone, {_SHIP_RECORD} AS ct FROM ship {_SHIP_JOIN}),
stamp AS (SELECT greatest((SELECT max(load_ts) FROM leg),
    (SELECT max(CAST(strftime(o_orderdate, '%Y%m%d%H%M%S') AS BIGINT)) FROM orders WHERE o_orderstatus <> 'P')) AS s)
SELECT coalesce(shp.cawbno, sts.cawbno) AS "PK", CASE WHEN NOT gone THEN ct END AS "ABM", ibs AS "IBS", obs AS "OBS",
  CASE WHEN gone THEN 'D!@#' ELSE ct END AS "SLT", coalesce(status, 'NA!@#') AS "DLS",
  CASE WHEN status <> 'UD' THEN '{AS_OF[:16]}' END AS "DTS",
  (SELECT strftime(strptime(CAST(s AS VARCHAR), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') FROM stamp) AS "LTS"
FROM shp FULL JOIN sts ON shp.cawbno = sts.cawbno"""
)
def il_to_pl(spark: SparkSession, sf_dir: str) -> DataFrame:
    il = materialise(promotion_input(spark, sf_dir), work_path(spark, "incremental"))
    return promote(il, REDUCED, order_masters(spark, sf_dir), as_of=AS_OF)


@query(
    f"""WITH {STATUS_ROWS},
top AS (SELECT * FROM rows_ WHERE op_type <> 'D'
  QUALIFY row_number() OVER (PARTITION BY cawbno ORDER BY op_ts DESC, pos DESC) = 1)
SELECT cawbno AS "PK", concat_ws('~', cawbno, dstatdate, coalesce(cemplcode, 'NA!@#'), op_ts, op_type) AS "SRT",
  'Y' AS "SRT_AFLG", concat_ws('~', dstatdate, coalesce(cemplcode, 'NA!@#')) || ':' || op_type AS "SRJ" FROM top"""
)
def alternate_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = status_rows(table(spark, sf_dir, "events"))
    rows = rows.withColumnsRenamed({"dstatdate": "dentdate", "cemplcode": "cremarks"})
    order = ["op_ts", "pos"]
    il = pivot_families({"SRT": split_cdc(rows, REDUCED["SRT"], keep=order)}, order)
    return promote_alternates(il, REDUCED)


# --- feed, batch job and stream --------------------------------------------------------------------------------------

FEED_TABLES = {"INBOUND": "IBS", "OUTBOUND": "OBS"}
FEED_FIELDS = ("cawbno", "cstattype", "cstatcode", "dstatdate", "cloccode", "cemplcode")
FEED_LAYOUTS = {f: Layout(f, FEED_FIELDS, trim_first=True) for f in FEED_TABLES.values()}


def envelopes(rows: DataFrame) -> DataFrame:
    """Status rows as JSON change envelopes."""
    inbound = F.col("event_type").isin("purchase", "view")
    name = F.when(inbound, "FEED.INBOUND").otherwise("FEED.OUTBOUND")
    pos = F.lpad(F.col("pos").cast("string"), 12, "0").alias("pos")
    body = F.struct(F.struct(*FEED_FIELDS).alias("after"), "op_ts", "op_type", pos, name.alias("table"))
    return rows.select(F.to_json(body).alias("value"))


@query(
    f"""WITH {STATUS_ROWS}
SELECT cawbno, cstatcode, cloccode, cemplcode, op_ts, op_type, lpad(CAST(pos AS VARCHAR), 12, '0') AS pos FROM rows_
WHERE event_type IN ('purchase', 'view')"""
)
def json_demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = envelopes(status_rows(table(spark, sf_dir, "events")))
    rows = parse(values.filter(source_table() == "INBOUND"), FEED_LAYOUTS["IBS"])
    return rows.select("cawbno", "cstatcode", "cloccode", "cemplcode", "op_ts", "op_type", "pos")


ALL_FIELDS = {f: layout for f, layout in default_layouts({"SLT": COLUMNS["SFM"].split()}).items()}


def wide_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed of all eleven source tables at their full width; an event's number says which table it belongs to."""
    events = table(spark, sf_dir, "events")
    out = None
    for i, (name, family) in enumerate(SOURCE_TABLES.items()):
        columns = ADDRESS_COLUMNS if family == "ADT" else ALL_FIELDS[family].fields
        key = ALL_FIELDS[family].key
        own = events.filter(F.col("event_id") % len(SOURCE_TABLES) == i)
        value = F.concat(F.lit("-"), (F.col("event_id") % 7).cast("string"))
        fields = [(F.col("user_id").cast("string") if c == key else F.concat(F.lit(c), value)).alias(c) for c in columns]
        change = F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op_type")
        pos = F.lpad(F.col("event_id").cast("string"), 12, "0").alias("pos")
        body = F.struct(F.struct(*fields).alias("after"), text_of("ts").alias("op_ts"), change, pos, F.lit(f"DB.{name}").alias("table"))
        rows = own.select(F.to_json(body).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _wide_record(family: str) -> str:
    layout = ALL_FIELDS[family]
    names = ", ".join(f"'{c}'" for c in layout.fields[1:])
    tail = ["op_ts", "op_type", "'NA!@#'"] if layout.tail[1:] else ["op_ts"]
    return f"concat_ws('~', user_id, array_to_string(list_transform([{names}], lambda c: c || k), '~'), {', '.join(tail)})"


_WIDE = [(i, f) for i, f in enumerate(SOURCE_TABLES.values()) if f not in ("CPS", "ADT")]


@query(
    f"""WITH e AS (SELECT user_id, event_id, '-' || (event_id % 7) AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS op_ts,
  event_id % {len(SOURCE_TABLES)} AS t, CASE event_type WHEN 'error' THEN 'D' ELSE 'U' END AS op_type FROM events),
r AS (SELECT CASE t {" ".join(f"WHEN {i} THEN '{f}'" for i, f in _WIDE)} END AS family, CAST(user_id AS VARCHAR) AS "PK",
  CASE WHEN op_type = 'D' THEN 'D!@#' ELSE CASE t {" ".join(f"WHEN {i} THEN {_wide_record(f)}" for i, f in _WIDE)} END END AS "CT_COL",
  op_ts, event_id FROM e WHERE op_type <> 'D' OR t = {next(i for i, f in _WIDE if f == "SLT")})
SELECT family, "PK", "CT_COL" FROM r WHERE family IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY family, "PK" ORDER BY op_ts DESC, event_id DESC) = 1"""
)
def feed_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest record of every family of a feed of eleven tables; the client detail table's columns come from the feed itself."""
    feed = materialise(route(wide_feed(spark, sf_dir)), work_path(spark, "feed"))  # each envelope is parsed here, once
    client = layout_from_feed(feed, "SHIPCLT", "SLT")
    changes = demultiplex(feed, ALL_FIELDS | {"SLT": client})
    bundle = build_bundle({f: changes[f].withColumn("load_ts", F.lit(None).cast("long")) for _, f in _WIDE}, ALL_FIELDS | {"SLT": client}, no_masters(spark))
    records = [bundle[f].select(F.lit(f).alias("family"), "PK", "CT_COL", "op_ts", "pos") for _, f in _WIDE]
    latest = latest_per_key(reduce(DataFrame.unionByName, records), ["family", "PK"], ["op_ts", "pos"])
    return latest.select("family", "PK", "CT_COL")


@query(
    """SELECT CASE WHEN event_type = 'error' THEN 'malformed' WHEN event_type = 'click' THEN 'unknown table'
  WHEN event_type IN ('purchase', 'view') THEN 'INBOUND' ELSE 'OUTBOUND' END AS kind, count(*) AS n
FROM events GROUP BY 1 UNION ALL SELECT 'seen', count(*) FROM events"""
)
def feed_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with broken and foreign envelopes, landed: what each table took in, what was refused and why, and all."""
    root = work_path(spark, "refused")
    rows = status_rows(table(spark, sf_dir, "events"))
    broken = F.col("event_type") == "error"
    foreign = F.col("event_type") == "click"
    good = envelopes(rows.filter(~broken & ~foreign))
    cut = envelopes(rows.filter(broken)).select(F.substring("value", 1, 40).alias("value"))
    other = envelopes(rows.filter(foreign)).select(F.regexp_replace("value", "FEED\\.(IN|OUT)BOUND", "FEED.OTHER").alias("value"))
    good.unionByName(cut).unionByName(other).write.text(f"{root}/feed")
    ingest = start_landing(
        read_feed(spark, "text", path=f"{root}/feed"),
        f"{root}/landing",
        FEED_LAYOUTS,
        checkpoint=f"{root}/checkpoint",
        times=f"{root}/times",
        trigger={"availableNow": True},
        tables=FEED_TABLES,
        clock=lambda: datetime(2024, 1, 16),
    )
    ingest.awaitTermination()
    seen = sum(p["observedMetrics"]["routing"]["seen"] for p in ingest.recentProgress if "routing" in p["observedMetrics"])
    landed = [spark.read.parquet(f"{root}/landing/{t}").select(F.lit(t).alias("kind")) for t in FEED_TABLES]
    refused = spark.read.parquet(f"{root}/landing/refused").select(F.col("reason").alias("kind"))
    counts = reduce(DataFrame.unionByName, [*landed, refused]).groupBy("kind").agg(F.count("*").alias("n"))
    return counts.unionByName(spark.range(1).select(F.lit("seen").alias("kind"), F.lit(seen).cast("long").alias("n")))


@query(
    f"""WITH {STATUS_ROWS}
SELECT cawbno, cstattype, cstatcode, dstatdate, cloccode, cemplcode, op_ts, op_type,
  CAST(20240116000000 AS BIGINT) AS load_ts FROM rows_ WHERE event_type NOT IN ('purchase', 'view')"""
)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "landing")
    envelopes(status_rows(table(spark, sf_dir, "events"))).write.text(f"{root}/feed")
    start_landing(
        read_feed(spark, "text", path=f"{root}/feed"),
        f"{root}/landing",
        FEED_LAYOUTS,
        checkpoint=f"{root}/checkpoint",
        times=f"{root}/times",
        trigger={"availableNow": True},
        tables=FEED_TABLES,
        clock=lambda: datetime(2024, 1, 16),
    ).awaitTermination()
    return read_landing(spark, f"{root}/landing/OUTBOUND", FEED_LAYOUTS["OBS"].landed_schema())


def _halves(rows: DataFrame) -> Sequence[DataFrame]:
    return rows.filter(F.col("op_ts") < SPLIT), rows.filter(F.col("op_ts") >= SPLIT)


def ingest_stream(spark: SparkSession, sf_dir: str, families: Sequence[str]) -> DataFrame:
    """The feed as a stream of two arrivals, merged into fresh layers; the persistent layer afterwards."""
    root = work_path(spark, "stream")
    rows = status_rows(table(spark, sf_dir, "events"))
    masters = Masters(status_master(rows), *_other_masters(spark))
    layers = Layers(spark, f"{root}/layers", FEED_LAYOUTS)
    clock = iter([datetime(2024, 1, 16), datetime(2024, 2, 1)])
    for half in _halves(rows):
        envelopes(half).write.mode("append").text(f"{root}/feed")
        start_ingest(
            read_feed(spark, "text", path=f"{root}/feed"),
            layers,
            FEED_LAYOUTS,
            masters,
            checkpoint=f"{root}/checkpoint",
            trigger={"availableNow": True},
            tables=FEED_TABLES,
            clock=lambda: next(clock),
        ).awaitTermination()
    return layers.persistent.read(families)


def _other_masters(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    none = no_masters(spark)
    return none.customer, none.pack, none.group


FEED_RECORDS = f"""
live AS (SELECT *, CASE WHEN event_type IN ('purchase', 'view') THEN 'I' ELSE 'O' END AS side FROM rows_
  WHERE op_type <> 'D'),
leg AS (SELECT r.*, concat_ws('~', r.cawbno, r.cstattype, r.cstatcode, r.dstatdate, coalesce(r.cloccode, 'NA!@#'),
    coalesce(r.cemplcode, 'NA!@#'), r.op_ts, r.op_type, coalesce(m.cstatgroup, 'NA!@#'),
    coalesce(m.cstatdesc, 'NA!@#')) AS ct
  FROM live r LEFT JOIN master m ON r.cstattype = m.cstattype AND r.cstatcode = m.cstatcode
  QUALIFY row_number() OVER (PARTITION BY r.cawbno, side ORDER BY r.op_ts DESC, r.pos DESC) = 1)"""

LATEST_FEED = f"""WITH {STATUS_ROWS}, {STATUS_MASTER}, {FEED_RECORDS}
SELECT cawbno AS "PK", max(CASE side WHEN 'I' THEN ct END) AS "IBS", max(CASE side WHEN 'O' THEN ct END) AS "OBS"
FROM leg GROUP BY cawbno"""
FEED_JOURNEY = f"""WITH {STATUS_ROWS}, {STATUS_MASTER}, {LEG_EVENTS}
SELECT pk AS "PK", string_agg(j, '|' ORDER BY late, j) AS "PDJ" FROM e GROUP BY pk"""


@query(LATEST_FEED)
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_stream(spark, sf_dir, ["IBS", "OBS"])


@query(FEED_JOURNEY)
def stream_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_stream(spark, sf_dir, ["PDJ"])


THIRDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


@query(
    f"""WITH {STATUS_ROWS}, {STATUS_MASTER},
e AS (SELECT DISTINCT r.cawbno AS pk, {EVENT_TEXT} || '@IB:' || r.op_type AS j,
      (r.op_ts >= '{THIRDS[0]}')::INT + (r.op_ts >= '{THIRDS[1]}')::INT AS third FROM {JOINED} WHERE r.op_type <> 'D')
SELECT pk AS "PK", string_agg(j, '|' ORDER BY third, j) AS "CT_COL" FROM e GROUP BY pk"""
)
def stream_state_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in three arrivals, the query begun anew for each, with journeys kept in the query's own state."""
    root = work_path(spark, "state-journeys")
    rows = status_rows(table(spark, sf_dir, "events"))
    master = status_master(rows)
    op_ts = F.col("op_ts")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        for third in (op_ts < THIRDS[0], (op_ts >= THIRDS[0]) & (op_ts < THIRDS[1]), op_ts >= THIRDS[1]):
            envelopes(rows.filter(third)).write.mode("append").text(f"{root}/feed")
            changes = parse(read_feed(spark, "text", path=f"{root}/feed"), FEED_LAYOUTS["IBS"])
            live = with_status(without_deletes(changes), master)
            start_journeys(
                events_of(live, "cawbno", status_event("@IB")),
                f"{root}/added",
                checkpoint=f"{root}/checkpoint",
                trigger={"availableNow": True},
            ).awaitTermination()
        return render_journeys(read_journeys(spark, f"{root}/checkpoint"))
    finally:
        spark.conf.set(PROVIDER, before)


def batch_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The feed landed by day and taken in by two batch runs."""
    root = work_path(spark, "batch")
    rows = status_rows(table(spark, sf_dir, "events"))
    day = F.rpad(F.substring(F.col("load_ts").cast("string"), 1, 8), 14, "0").cast("long")
    landed = rows.withColumn("load_ts", day).select(*FEED_FIELDS, "op_ts", "op_type", "load_ts", "event_type")
    for name, leg in zip(FEED_TABLES, _legs(landed)):
        write_partitions(leg.drop("event_type"), f"{root}/landing/{name}")
    config = BatchConfig(
        landing=f"{root}/landing",
        staging=f"{root}/staging",
        last=f"{root}/last",
        archive=f"{root}/archive",
        layouts=FEED_LAYOUTS,
        tables=FEED_TABLES,
    )
    layers = Layers(spark, f"{root}/layers", FEED_LAYOUTS)
    masters = Masters(status_master(rows), *_other_masters(spark))
    for as_of in (datetime(2024, 1, 16, 0, 1), datetime(2024, 2, 1)):
        run_batch(spark, config, layers, masters, as_of)
    return layers


@query(LATEST_FEED)
def batch_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_layers(spark, sf_dir).persistent.read(["IBS", "OBS"])


@query(FEED_JOURNEY)
def batch_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_layers(spark, sf_dir).persistent.read(["PDJ"])
