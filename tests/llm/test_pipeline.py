"""The pipeline stage by stage, and every query against its SQL."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from texts import sentence
from oracle import compare, connect

from tracklayer.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def _tables(spark, folder, docs, item):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages(spark, docs, tmp_path):
    rng = random.Random(3)
    item = sentence(rng, 40)
    base = sentence(rng, 150)
    edited = base.split(" ")
    edited[70] = "edited"
    lines = [sentence(rng, 12) for _ in range(10)]
    rows = [(200, base), (201, base), (202, " ".join(edited)), (203, sentence(rng, 60) + " " + item + " " + sentence(rng, 60)), (204, "\n".join(lines)), (205, "\n".join(lines)), (206, "few words"), (None, sentence(rng, 80))]
    rows += [(300 + i, sentence(rng, 90)) for i in range(5)]
    extra = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    folder = _tables(spark, tmp_path / "t", extra, item)
    frame, ids = extra, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, folder)
        ids[name] = sorted((r.doc_id for r in out.select("doc_id").collect()), key=str)
        if name != "byte_bpe":
            assert out.columns == docs.columns
            frame = out
    clean = [300, 301, 302, 303, 304]
    assert ids["quality_rules"] == sorted([None, 200, 201, 202, 203, 204, 205, *clean], key=str)
    assert 204 in ids["line_dedup"] and set(clean) <= set(ids["line_dedup"])
    assert {200, 201, 202} & set(ids["near_dedup"]) == {200}
    assert ids["decontamination"] == ids["byte_bpe"] and 203 not in ids["byte_bpe"]
    assert set(clean) | {None, 200, 204} <= set(ids["byte_bpe"])
    assert len(corpus_pipeline.run(spark, folder).collect()) == len(ids["byte_bpe"])


def test_stages_tell_documents_by_id_and_text(spark, docs, tmp_path):
    """Equal ids with other texts, null ids, exact repeats, very long and missing texts, a column named as the key."""
    rng = random.Random(8)
    item, base = sentence(rng, 40), sentence(rng, 150)
    near = base.replace(base.split(" ")[70], "edited", 1)
    leak = sentence(rng, 60) + " " + item + " " + sentence(rng, 60)
    clean = [sentence(rng, 90) for _ in range(3)]
    long = sentence(rng, 30_000)
    rows = [(7, base), (7, clean[0]), (7, leak), (8, near), (None, leak), (None, clean[1]), (None, near), (9, clean[2]), (9, clean[2]), (-1, long), (3, long), (11, None), (12, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", None, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row_key string")
    folder = _tables(spark, tmp_path / "t", frame, item)
    deduped = corpus_pipeline.near_dedup(spark, frame, folder)
    assert deduped.columns == frame.columns and {r.row_key for r in deduped.collect()} == {"x"}
    left = [(7, base), (7, clean[0]), (7, leak), (None, clean[1]), (9, clean[2]), (-1, long), (11, None), (12, "")]
    assert sorted(((r.doc_id, r.text) for r in deduped.collect()), key=repr) == sorted(left, key=repr)
    kept = corpus_pipeline.decontamination(spark, frame, folder)
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted((r for r in rows if r[1] != leak), key=repr)


def test_empty(spark, docs, tmp_path):
    assert corpus_pipeline.run(spark, _tables(spark, tmp_path / "t", docs.limit(0), None)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    compare(spark, connect(SF), QUERIES[name], ORACLES[name], SF)


def test_short_items_agree_with_sql(spark, docs, tmp_path):
    """Benchmark items of one to four words, one that occurs twice in a text, and one without words."""
    rng = random.Random(4)
    texts = [sentence(rng, 20) + " the short one, " + sentence(rng, 5) + " the short one", "Word", "word by word", "none of them", "two words more or less", ""]
    item = sentence(rng, 30)
    folder = _tables(spark, tmp_path, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate([*texts, item + " end"])], docs.schema).coalesce(1), item)
    rows = [(i, t) for i, t in enumerate([item, "The short one!", "word", "more or less", "two words more or", " - ", None, "WORD"])]
    spark.createDataFrame(rows, "item_id long, text string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in QUERIES["op1_decontamination"](spark, folder).collect()}
    assert found == {(6, 0), (0, 1), (1, 2), (1, 7), (2, 2), (2, 7), (4, 3), (4, 4)}
    sql = ORACLES["op1_decontamination"]
    for name in ("documents", "benchmark"):
        sql = sql.replace(f"FROM {name}", f"FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    got = connect(SF).execute(sql).fetchall()
    assert {r[:2] for r in got} == found
