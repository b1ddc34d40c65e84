"""Periodic runs, fill-in-middle and language identification."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from texts import sentence

from tracklayer.llm import fill_middle, language_gru, periodic_runs, queries
from tracklayer.llm.common import WORD

SF = "/root/testdata/sf0.001"


def brute_runs(words, least=12):
    """All (start, length, period), straight from the definition."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x, found = np.array([codes[w] for w in words], np.int64), {}
    for q in range(1, len(x) // 2 + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(least, 2 * q):
                found.setdefault((a, b + q), q)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(a + q <= i < a + n for a, n, q in runs)]


def repetitive(rng):
    n, size = rng.randint(0, 150), rng.choice([1, 2, 3, 9, 60])
    x = [rng.randrange(size) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        s, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 3))
        for i in range(s + p, min(n, s + p * rng.randint(2, 6) + rng.randint(0, 5))):
            x[i] = x[i - p]
    return [f"w{i}" for i in x]


@pytest.mark.parametrize("first_block", [1, 2, 4, 16])
def test_runs_at_every_scale(first_block):
    """With a first block of one word every period is found by transforms alone."""
    rng = random.Random(first_block)
    for _ in range(250):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        for words, r in zip(texts, periodic_runs._runs_of(texts, 12, first_block), strict=True):
            assert list(zip(r.start.tolist(), r.length.tolist(), r.period.tolist(), strict=True)) == brute_runs(words)


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(0, periodic_runs.PRIME, (3, 16)).astype(np.uint64)
    assert (periodic_runs.transform(periodic_runs.transform(x), inverse=True) == x).all()
    text = rng.integers(0, 3, 64).astype(np.uint64)
    starts = np.arange(0, 40, 4)
    row, offset = periodic_runs.occurrences(text[starts[:, None] + np.arange(4)], text[starts[:, None] + np.arange(20)])
    wanted = [(i, o) for i, s in enumerate(starts) for o in range(17) if (text[s : s + 4] == text[s + o : s + o + 4]).all()]
    assert list(zip(row.tolist(), offset.tolist(), strict=True)) == wanted


def test_sums_that_lie_change_nothing(monkeypatch):
    """Words that share a residue look equal to the transform and to the sums; only their comparison decides."""
    rng = random.Random(5)
    monkeypatch.setattr(periodic_runs._Prefixes, "same", lambda self, i, d, size: np.ones(len(i), bool))
    for _ in range(60):
        words = repetitive(rng)
        r = periodic_runs._runs_of([words], 12, 2)[0]
        assert set(zip(r.start.tolist(), r.length.tolist(), r.period.tolist(), strict=True)) <= set(brute_runs(words))


def test_runs_of_long_texts():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 4000, 7000)
    words = [f"w{i}" for i in np.concatenate([rng.integers(0, 4000, 500), base[np.arange(20_000) % 7000], rng.integers(0, 4000, 300)])]
    r = periodic_runs._runs_of([words], 12, 16)[0]
    assert (7000, 20_000) in zip(r.period.tolist(), r.length.tolist(), strict=True)
    same = periodic_runs._runs_of([["x"] * 50_000], 12, 16)[0]
    assert (same.start.tolist(), same.length.tolist(), same.period.tolist()) == ([0], [50_000], [1])


def test_runs_of_awkward_documents(docs, clashing, no_docs, rows):
    wanted = []
    for i, t in rows:
        words = WORD.findall(t or "")
        runs = brute_runs(words) if len(words) < 5000 else []
        wanted.append((i, len(words), str(runs), " ".join(brute_collapse(words, runs)) if runs else " ".join(words)))
    for frame in (docs, clashing):
        found = [(r.doc_id, r.n_words, str([tuple(x) for x in r.runs]), r.collapsed) for r in periodic_runs.periodic_runs(frame).collect()]
        assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert periodic_runs.periodic_runs(no_docs).collect() == []


def test_runs_query(spark):
    wanted = []
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        kept = " ".join(brute_collapse(words, runs))
        wanted.append((doc_id, len(runs), *shown, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    found = queries.op12_periodic_runs(spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert sum(w[1] for w in wanted) > 10


def test_looped_awkward_documents(docs, rows):
    found = sorted(((r.doc_id, r.text) for r in queries.looped(docs).collect()), key=repr)
    for (i, was), (_, now) in zip(sorted(rows, key=repr), found, strict=True):
        chosen = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        assert now == was or (chosen and len(WORD.findall(now)) == len(WORD.findall(was)))


def test_exception_index():
    rng = random.Random(1)
    for _ in range(500):
        texts = ["".join(rng.choice("ab<é€🙂") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 5))]
        coded = [t.encode() for t in texts]
        ends = np.cumsum([len(b) for b in coded])
        index = fill_middle.ExceptionIndex(np.frombuffer(b"".join(coded), np.uint8), ends - [len(b) for b in coded], ends)
        assert index.lengths.tolist() == [len(t) for t in texts]
        points = np.array([rng.randint(0, len(t)) for t in texts])
        assert index.to_bytes(points).tolist() == [len(t[:k].encode()) for t, k in zip(texts, points, strict=True)]
        cuts = np.array([rng.randint(0, len(b)) for b in coded])
        assert index.to_points(cuts).tolist() == [len(b[:k].decode("utf-8", "ignore")) for b, k in zip(coded, cuts, strict=True)]


def brute_fim(doc_id, text, unit):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    coded = text.encode()
    n = len(text) if unit == "characters" else len(coded)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if unit == "bytes":
        a, b = (len(coded[:k].decode("utf-8", "ignore")) for k in (a, b))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(text), "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", ["characters", "bytes"])
def test_fill_in_middle(spark, docs, clashing, no_docs, rows, unit):
    rng = random.Random(9)
    more = [(100 + i, "".join(rng.choice("ab <>PSMé€🙂\n") for _ in range(rng.randint(0, 40)))) for i in range(300)]
    wide = spark.createDataFrame(more, "doc_id long, text string")
    for frame, own in ((docs, rows), (clashing, rows), (wide, more)):
        made = fill_middle.fill_in_middle(frame, unit=unit)
        found = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restored().alias("back")).collect()
        wanted = [(i, *brute_fim(i, t, unit), t or "") for i, t in own]
        assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert fill_middle.fill_in_middle(no_docs, unit=unit).collect() == []
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(docs, unit="words")


def test_network_gradients():
    rng = np.random.default_rng(4)
    net = language_gru.first_network(3, width=4)
    net = language_gru.Network(*(p.astype(float) for p in net.parts()))
    codes = rng.integers(0, 257, (6, 5))
    labels, weight = rng.integers(0, 3, 5), rng.random((6, 5))
    _, grads = language_gru.gradients(net, codes, labels, weight)
    for part, grad in zip(net.parts(), grads.parts(), strict=True):
        seen = [i for i in np.ndindex(part.shape) if grad[i]][:40]
        for at in seen[::4]:
            kept, change = part[at], 1e-3
            losses = []
            for sign in (1, -1):
                part[at] = kept + sign * change
                logs = language_gru.log_probabilities(net, codes).astype(float)
                losses.append(-(logs[:, labels, np.arange(5)] * weight).sum())
            part[at] = kept
            assert (losses[0] - losses[1]) / (2 * change) == pytest.approx(grad[at], rel=2e-2, abs=2e-4)


def test_labels_are_those_of_a_plain_pass():
    """Every byte is labelled once, as by running its own window alone."""
    net = language_gru.first_network(3)
    texts = [b"", b"x", b"abc" * 200, bytes(range(256)) * 3, b"y" * 240, b"z" * 241]
    place = np.full(sum(map(len, texts)), -1)
    total = language_gru.label_bytes(net, texts, place)
    firsts = np.cumsum([0, *map(len, texts)])
    for k, text in enumerate(texts):
        sums = np.zeros(3)
        for begin in range(0, len(text), language_gru.OWN):
            end = min(begin + language_gru.OWN, len(text))
            own = [text[i] if 0 <= i < len(text) else language_gru.OUTSIDE for i in range(begin - language_gru.MARGIN, end + language_gru.MARGIN)]
            logs = language_gru.log_probabilities(net, np.array(own)[:, None])[language_gru.MARGIN : len(own) - language_gru.MARGIN, :, 0]
            sums += np.exp(logs).sum(axis=0)
            assert (place[firsts[k] + begin : firsts[k] + end] == logs.argmax(axis=1)).mean() > 0.99
        assert total[k] == pytest.approx(sums, abs=1e-4 * (1 + len(text)))


def test_languages_held_out(spark):
    found = {r.doc_id: r for r in queries.op11_language_id(spark, SF).collect()}
    real = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert found.keys() == real.keys()
    held = [i for i, r in found.items() if r.held_out]
    assert held == [i for i in found if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(found[i].lang_pred == real[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_of_awkward_documents(spark, docs, clashing, no_docs, rows):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    texts = [(i, sentence(rng, 30).translate(str.maketrans("abcdefghij", "klmnopqrst")) if i % 2 else sentence(rng, 30), "bb" if i % 2 else "aa") for i in range(40)]
    learned = spark.createDataFrame([*texts, *[texts[0]] * 50, (99, None, "aa"), (98, "12 34", "zz"), (97, "abc", None)], "doc_id long, text string, lang string")
    languages, net = language_gru.learn_languages(learned, F.lit(True), per_language=15, steps=40)
    assert languages == ["aa", "bb"]
    for frame in (docs, clashing):
        found = sorted(((r.doc_id, r.lang_pred, r.score == 0) for r in language_gru.predict_languages(frame, languages, net).collect()), key=repr)
        blank = sum(not any(c.isalpha() for c in t or "") for _, t in rows)
        assert len(found) == len(rows) and sum(f[1] == "und" for f in found) == sum(f[2] for f in found) == blank
    assert language_gru.predict_languages(no_docs, languages, net).collect() == []
    mixed = spark.createDataFrame([(1, "abc dea fgh " * 9 + "klm nop qrs " * 9)], "doc_id long, text string")
    (row,) = language_gru.predict_languages(mixed, languages, net, spans=True).collect()
    assert row.spans[0].start == 0 and row.spans[-1].end == 216 and {s.lang for s in row.spans} == {"aa", "bb"}
    assert all(a.end == b.start and a.lang != b.lang for a, b in zip(row.spans, row.spans[1:], strict=False))
    none = language_gru.learn_languages(learned, F.lit(False))
    assert none == ([], None)
    assert {r.lang_pred for r in language_gru.predict_languages(docs, *none).collect()} == {"und"}
    one, net = language_gru.learn_languages(learned.where("lang = 'aa'"), F.lit(True), steps=2)
    assert one == ["aa"] and {r.lang_pred for r in language_gru.predict_languages(docs, one, net).collect()} == {"aa", "und"}


def test_fill_in_middle_sql(spark):
    from oracle import compare, connect

    assert compare(spark, connect(SF), queries.op13_fill_middle, queries.ORACLES["op13_fill_middle"], SF) > 0
