"""The cleanup rules answer the same from summed-up event rows as from the whole journey in one cell."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tracklayer.layouts import NA
from tracklayer.operators.status import CLOSURE_CODES, JourneySummary, journey_summary, reclassify

AS_OF = "2019-08-15 09:30:00"


def random_events(rng):
    """Dated events, undated ones, short ones, sentinels, empty text, several events in a row."""
    codes = ["T" + c for c in rng.sample(CLOSURE_CODES, 4)] + ["S015", "S018", "S001", "XS015X"]
    day = f"2019-{rng.choice(['06', '08'])}-{rng.randint(1, 28):02d} 10:{rng.randint(0, 59):02d}:00"
    date = rng.choice([day, day, day, day[:10], "", "x"])
    event = f"{date}~{rng.choice(codes)}~BOM~~G~d@IB:U"
    return rng.choice([event] * 8 + ["", "a", NA, event + "|" + date + "~T123~", "~S015~", "b~T016~"])


def test_rules_from_rows_equal_rules_from_cells(spark):
    rng = random.Random(4)
    facts, events = [], []
    for k in range(700):
        pk = f"k{k}"
        facts.append((pk, rng.choice([None, NA, "abm"]), rng.choice([None, None, NA, "slt"]), rng.choice([None, "T123", "123", "I"]), rng.choice([None, "old"])))
        for number in range(rng.choice([0, 1, 1, 2, 3, 5])):
            for event in {random_events(rng) for _ in range(rng.choice([1, 1, 2, 25 if k % 50 == 0 else 3]))}:
                events.append((pk, number, rng.choice(["batch", "stream"]), event))
    rows = spark.createDataFrame(events, "PK string, number long, writer string, event string")
    pl = spark.createDataFrame(facts, "PK string, ABM string, SLT string, DLS string, DTS string")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("number", "writer", "event"))), lambda e: e["event"])
    cells = pl.join(rows.groupBy("PK").agg(F.array_join(ordered, "|").alias("PDJ")), "PK", "left")
    wanted = {r.PK: (r.DLS, r.DTS) for r in reclassify(cells, as_of=AS_OF).collect()}
    summed = pl.join(journey_summary(rows), "PK", "left")
    found = {r.PK: (r.DLS, r.DTS) for r in reclassify(summed, as_of=AS_OF, journey=JourneySummary()).collect()}
    differing = {k: (found[k], wanted[k], sorted(e[1:] for e in events if e[0] == k)) for k in wanted if found[k] != wanted[k]}
    assert found.keys() == wanted.keys() and not differing, list(differing.items())[:3]
    assert len({v[0] for v in wanted.values()}) > 10


def test_no_journey_is_put_in_a_cell(spark):
    rows = spark.createDataFrame([("k", 1, "batch", "2019-08-01 10:00:00~T123~")], "PK string, number long, writer string, event string")
    plan = journey_summary(rows)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    assert "partial_min" in plan
