"""URL filter, WARC archives and benchmark decontamination."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pyarrow as pa
from texts import sentence

from tracklayer.llm import decontaminate, url_filter, warc
from tracklayer.llm.queries import URL_RULES


def test_urls(spark):
    urls = [
        None,
        "",
        "no scheme/at all",
        "http://",
        "http://EXAMPLE.com/en/1?x=/y#z",
        "http://www.example.com/en/2",
        "http://a.www.example.com/en/2",
        "http://notexample.com/en/",
        "ftp://x.net/es/a#b",
        "http://x.net/ess/",
        "http://x.org/listed/",
        "https://www.x.org/listed?q=1",
        "http://x.org/LISTED",
        "http://net",
    ]
    pages = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(urls)] + [(4, urls[4], "again"), (None, urls[10], "x")], "page_id long, url string, block string")
    listed = spark.createDataFrame([("x.org/listed",), ("x.org/listed",), (None,), ("y.org/",)], "anything string")
    found = {(r.page_id, r.rule): r for r in url_filter.judge_urls(pages, listed, URL_RULES).collect()}
    assert [(found[k].host, found[k].path) for k in found if k[0] in (0, 1, 2)] == [("", "")] * 3
    verdicts = {k[0]: (r.rule, r.verdict) for k, r in found.items()}
    assert verdicts[4] == ("example.com/en/", "block") and verdicts[5] == ("www.example.com/en/", "allow") == verdicts[6]
    assert verdicts[7] == ("com/", "allow") and verdicts[8] == ("net/es/", "block") and verdicts[9] == (None, "allow")
    assert [verdicts[i][1] for i in (10, 11, 12, 13, None)] == ["block", "block", "allow", "allow", "block"]
    assert url_filter.judge_urls(pages, listed, URL_RULES).count() == len(urls) + 2
    assert url_filter.judge_urls(pages, listed.limit(0)).where("verdict = 'block'").count() == 0
    assert url_filter.judge_urls(pages.limit(0), listed, URL_RULES).collect() == []


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(2000).selectExpr("concat('h', id, '.org/p') AS url")
    pages = spark.range(20_000).selectExpr("id AS page_id", "concat('http://h', id, '.org/p') AS url")
    found = url_filter.judge_urls(pages, listed)
    assert found.where("page_id < 2000 and verdict <> 'block'").count() == 0
    assert found.where("page_id >= 2000 and verdict = 'block'").count() == 0
    assert 2000 <= found.where("possible").count() < 2400


def test_archives(spark):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a/ b\n", big), (2, None, big), (3, "http://c", "small"), (4, "http://d", "small"), (5, "http://e", None), (6, "http://f", "ü" * 600), (None, "http://g", big)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    files = warc.write_warc(pages)
    found = {r.record_id: r for r in warc.read_warc(files).where("kind = 'record'").collect()}
    assert len(found) == 7 and found["<urn:page:2>"].record_type == "response" and found["<urn:page:1>"].refers_to == "<urn:page:2>"
    assert found["<urn:page:1>"].payload is None and found["<urn:page:1>"].payload_bytes == 2003
    assert bytes(found["<urn:page:6>"].payload).decode() == "ü" * 600 and found["<urn:page:5>"].payload_bytes == 0
    assert found["<urn:page:3>"].record_type == found["<urn:page:4>"].record_type == "response"
    assert found["<urn:page:1>"].url == "http://a/%20b%0A" and found["<urn:page:2>"].url is None
    assert warc.read_warc(warc.write_warc(pages.limit(0))).collect() == []


def _records(n):
    return [warc.format_record(f"<urn:page:{i}>", f"http://h/{i}", bytes([65 + i]) * (50 * i), None, "2000-01-01T00:00:00Z") for i in range(n)]


def _pack(record):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _read(data):
    return [(r["kind"], r["offset"], r["length"], r.get("record_id")) for r in warc.Salvage(pa.BufferReader(data))]


def test_salvage():
    plain = _records(5)
    packed = [_pack(r) for r in plain]
    for parts in (plain, packed):
        edges = [sum(map(len, parts[:i])) for i in range(6)]
        whole = b"".join(parts)
        assert _read(whole) == [("record", edges[i], len(parts[i]), f"<urn:page:{i}>") for i in range(5)]
        for hit in (0, 2, 4):  # a damaged byte costs one record; all others are found where they are
            at = edges[hit] + len(parts[hit]) - 12
            damaged = whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1 :]
            found = _read(damaged)
            assert [r[3] for r in found if r[0] == "record"] == [f"<urn:page:{i}>" for i in range(5) if i != hit]
            assert [(r[1], r[2]) for r in found if r[0] == "gap"] == [(edges[hit], len(parts[hit]))]
        found = _read(b"noise" + whole[: edges[3] - 5])
        assert found[0] == ("gap", 0, 5, None) and found[-1][0] == "gap" and [r[3] for r in found[1:-1]] == ["<urn:page:0>", "<urn:page:1>"]
        assert sum(r[2] for r in found) == 5 + edges[3] - 5  # every byte is in a record or a gap
    assert _read(b"") == []


def test_leaks(spark, docs, clashing, no_docs):
    rng = random.Random(9)
    items = [sentence(rng, 40), sentence(rng, 12), "a short item", None, sentence(rng, 90), "uniquq", " - "]
    words = items[4].split(" ")
    near = " ".join([*words[:40], "edited", *words[41:]])
    rows = [
        (500, sentence(rng, 30) + " " + items[0].upper().replace(" ", ", ") + "! " + sentence(rng, 20)),
        (501, items[1]),
        (502, sentence(rng, 100) + "\n" + near + "\n" + sentence(rng, 10)),
        (503, " ".join(words[:30]) + " " + sentence(rng, 60)),
        (504, "A short item"),
        (505, sentence(rng, 20) + " (a short) item, uniquq uniquq"),
        (506, sentence(rng, 20) + " a short other item"),
        (500, "same id, clean"),
    ]
    more = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], docs.schema)
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*items, items[0]])], "item_id long, text string, words string")
    for frame in (docs.unionByName(more), clashing.unionByName(more, allowMissingColumns=True)):
        found = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.find_leaks(frame, bench).collect()}
        assert set(found) == {(500, 0), (500, 7), (501, 1), (502, 4), (504, 2), (505, 2), (505, 5)}
        assert found[504, 2] == (1.0, 0) and found[505, 2] == (1.0, 20) and found[505, 5] == (1.0, 23)
        assert found[500, 0] == (1.0, 30) and found[501, 1] == (1.0, 0) and 0.8 <= found[502, 4][0] < 1
    assert decontaminate.find_leaks(no_docs, bench).collect() == []
    assert decontaminate.find_leaks(docs, bench.limit(0)).collect() == []


def brute_leaks(docs, items):
    """Best similarity of all sliding windows of an item's length, over the limit."""
    out = {}
    for d, text in docs:
        words = text.split(" ")
        for b, item in items:
            own = item.split(" ")
            wanted = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
            for start in range(max(0, len(words) - len(own)) + 1):
                part = words[start : start + len(own)]
                found = Counter(tuple(part[i : i + 5]) for i in range(len(part) - 4))
                common = sum((found & wanted).values())
                value = common / (found.total() + wanted.total() - common)
                if value >= 0.8:
                    out[d, b] = max(value, out.get((d, b), 0))
    return out


def test_every_window_is_tried(spark):
    """Items in two swapped halves, moved, edited, repeated, cut off and at the ends of texts."""
    rng = random.Random(21)
    items = [(k, sentence(rng, n)) for k, n in enumerate((50, 60, 44, 90, 12))] + [(5, "again and " * 25 + "on")]
    docs = []
    for k, item in items:
        words, pad = item.split(" "), lambda: sentence(rng, 60).split(" ")
        half = len(words) // 2
        swapped = words[half:] + words[:half]
        docs += [(10 * k, [*pad(), *swapped, *pad()]), (10 * k + 1, swapped), (10 * k + 2, [*words[1:], *pad()]), (10 * k + 3, [*pad(), *words[:-1]])]
        docs += [(10 * k + 4, [*pad(), *words[:half], "edited", *words[half + 1 :], *pad()]), (10 * k + 5, [*pad(), *words[:half], *pad(), *words[half:]]), (10 * k + 6, words[1:-1] * 2)]
    docs = [(i, " ".join(w)) for i, w in docs]
    wanted = brute_leaks(docs, items)
    assert {(0, 0), (1, 0), (10, 1), (20, 2), (30, 3)} <= set(wanted)
    made = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in made.collect()} == {k: round(v, 9) for k, v in wanted.items()}
