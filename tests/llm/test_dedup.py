"""Substring, line and near-dedup against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from texts import sentence

from tracklayer.llm import line_dedup, near_dup, substring_dedup
from tracklayer.llm.common import WORD
from tracklayer.llm.components import star_links
from tracklayer.llm.url_filter import maybe_listed


def without_ties(frame):
    """Rows of equal ids and other texts have no order of their own."""
    return frame.where("not (doc_id <=> 12 and length(text) < 100)")


def brute_substrings(rows, window):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        words = WORD.findall(t or "")
        gone = set()
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                gone.update(range(at, at + window))
            seen.add(key)
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def test_substrings(docs, clashing, no_docs, rows):
    wanted = brute_substrings([r for r in rows if r[1] != "same id, other text"], 20)
    assert any(r[2] for r in wanted)
    for frame, options in ((docs, {}), (clashing, {"start": 5}), (docs, {"longest": 0})):
        found = substring_dedup.remove_repeats(without_ties(frame), 20, **options).drop("longest_repeat").collect()
        assert sorted(map(tuple, found), key=str) == wanted
    assert substring_dedup.remove_repeats(no_docs, 20).collect() == []


def test_window_hashes_tell_windows_apart():
    words = np.random.default_rng(1).integers(0, 2**63, 60).astype(np.uint64)
    doubled = np.concatenate([words, words])
    for length in (1, 2, 3, 5, 7, 10, 20):
        found = substring_dedup.window_hashes(doubled, length)
        assert len(found) == 120 - length + 1
        assert (found[: 60 - length + 1] == found[60 : 120 - length + 1]).all()
        assert len(set(found[:60].tolist())) == 60


def test_lines(spark, docs, clashing, no_docs, rows):
    found = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect() if r.doc_id is not None}
    passage = next(t for i, t in rows if i == 10)
    assert found[10].text == passage and found[10].n_removed_lines == 0
    assert found[11].n_removed_lines > 0 and found[11].n_lines == 14
    assert found[11].n_lines - found[11].n_removed_lines == len(found[11].text.split("\n"))
    assert found[0].text is None and found[1].text == "" and found[5].text == found[6].text
    other = line_dedup.dedup_lines(clashing)
    assert other.columns[: len(clashing.columns)] == clashing.columns
    assert sorted(map(str, other.select("doc_id", "text", "n_removed_lines").collect())) == sorted(
        map(str, line_dedup.dedup_lines(docs).select("doc_id", "text", "n_removed_lines").collect())
    )
    assert line_dedup.dedup_lines(no_docs).collect() == []
    # single lines and blank chunks stay; of many copies of a chunk the first stays
    many = spark.createDataFrame([(i, "\n".join([f"head {i}", *(f"line {k} of it" for k in range(30)), f"tail {i}"])) for i in range(50)], "doc_id long, text string")
    kept = line_dedup.dedup_lines(many).collect()
    assert sum(r.n_removed_lines == 0 for r in kept) == 1 and all(f"head {r.doc_id}" in r.text for r in kept)


def test_near_duplicates(docs, clashing, no_docs, rows):
    texts = [(i, near_dup.shingle_counts(WORD.findall(t or ""))) for i, t in rows]
    group = list(range(len(texts)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if near_dup.weighted_jaccard(texts[a][1], texts[b][1]) >= 0.8:
                group[find(a)] = find(b)
    wanted = []
    for k, (i, shingles) in enumerate(texts):
        same = [texts[j][0] for j in range(len(texts)) if find(j) == find(k) and texts[j][0] is not None]
        wanted.append((i, (min(same) if same else None) if shingles else i))
    assert (7, 5) in wanted
    for frame in (docs, clashing):
        assert sorted(map(tuple, near_dup.near_duplicates(frame).collect()), key=str) == sorted(wanted, key=str)
    assert near_dup.near_duplicates(no_docs).collect() == []


def test_every_link_of_a_bucket_is_found(spark):
    """A chain of texts, each near the next but not near the first, in one group with unrelated ones."""
    words = [f"w{i}" for i in range(300)]
    chain = [" ".join(words[4 * i : 4 * i + 120]) for i in range(30)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(chain)] + [(100 + i, f"other {i} " * 9) for i in range(5)], "doc_id long, text string")
    found = dict(map(tuple, near_dup.near_duplicates(frame).collect()))
    assert {found[i] for i in range(30)} == {0} and all(found[100 + i] == 100 + i for i in range(5))


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(5)
    elements = rng.integers(1, 2**62, 400).astype(np.uint64)
    a, b = rng.integers(1, 5, 300), rng.integers(1, 5, 300)
    docs = np.repeat([0, 1], 300)
    made = near_dup.prob_minhash(docs, np.concatenate([elements[:300], elements[100:]]), np.concatenate([a, b]), 2, 4000)
    p, q = np.zeros(400), np.zeros(400)
    p[:300], q[100:] = a, b
    exact = sum(1 / np.maximum(p / p[i], q / q[i]).sum() for i in range(400) if p[i] and q[i])
    assert abs((made[0] == made[1]).mean() - exact) < 0.04


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (7, 7)] + [(100, 100 + i) for i in range(1, 40)]
    found = dict(map(tuple, star_links(spark.createDataFrame(links, "u long, v long")).collect()))
    assert found == {2: 1, 3: 1, 4: 1, 11: 10, 12: 10} | {100 + i: 100 for i in range(1, 40)}
    assert Counter(found.values())[100] == 39


def test_sketches_keep_similar_pairs(spark):
    """Packed registers: natively counted as by hand, and no pair of the least similarity is over the limit."""
    rng = np.random.default_rng(5)
    signatures = rng.integers(0, 2**63, (60, 168)).astype(np.uint64)
    signatures[1::2] = np.where(rng.random((30, 168)) < 0.2, signatures[1::2], signatures[::2])
    packed = near_dup.sketches(signatures)
    nibbles = near_dup.mix(signatures) & np.uint64(15)
    expected = (nibbles[::2] != nibbles[1::2]).sum(axis=1).tolist()
    frame = spark.createDataFrame([(i, packed[2 * i].tolist(), packed[2 * i + 1].tolist()) for i in range(30)], "i int, a array<long>, b array<long>")
    counted = frame.orderBy("i").select(near_dup.n_differing(frame.a, frame.b, 168).alias("n")).collect()
    assert [r.n for r in counted] == expected
    assert max(expected) <= near_dup.most_differing(168, 0.8) < 168 * 0.4


def test_near_dup_links_match_brute_force(spark):
    """A large group of copies edited more and less: the classes are those of all pairs compared, but for one link in a hundred at most."""
    rng = random.Random(21)
    base = sentence(rng, 150).split(" ")
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 6, 10])):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        texts.append(" ".join(words))
    counts = [near_dup.shingle_counts(t.split(" ")) for t in texts]
    links = {(i, j) for i in range(150) for j in range(i) if near_dup.weighted_jaccard(counts[i], counts[j]) >= 0.8}
    classes = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(links) > 300 and any(c == i and sum(v == i for v in classes.values()) == 1 for i, c in classes.items())
    kept = sum(classes[i] == classes[j] for i, j in links)
    assert kept >= 0.99 * len(links)


def test_parities_never_drop_a_similar_pair():
    """Texts differ in no fewer shingles than in bits, long ones too, and the bound tells short ones apart."""
    rng = random.Random(4)
    for n in (3, 150, 3000):
        base = sentence(rng, n).split(" ")
        other = [sentence(rng, 1) if rng.random() < 0.02 else w for w in base]
        texts = [" ".join(base), " ".join(other), sentence(rng, n)]
        counts = [near_dup.shingle_counts(t.split(" ")) for t in texts]
        bits = np.unpackbits(near_dup.parities(*near_dup.weighted_shingles(texts), 3).view(np.uint8), axis=1)
        assert bits.shape == (3, near_dup.PARITY_BITS)
        for a, b in ((0, 1), (0, 2)):
            apart = sum(((counts[a] - counts[b]) + (counts[b] - counts[a])).values())
            assert (bits[a] != bits[b]).sum() <= apart
        assert n != 150 or (bits[0] != bits[2]).sum() > 2 * n / 9


def _below_shuffles(plan):
    """For each shuffle of a plan, what lies below it."""
    lines = plan.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            end = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            yield "\n".join(lines[i:end])


def test_only_what_may_be_joined_is_shuffled(spark, monkeypatch):
    """No listed value is lost by the filter and few others are kept; signatures and texts pass it before they move."""
    listed = spark.range(0, 40_000, 2).selectExpr("id as other")
    rows = spark.range(0, 40_000).selectExpr("id as key", "cast(id as string) as block_")
    kept = maybe_listed(rows, "key", listed)
    assert kept.columns == rows.columns and kept.join(listed, kept.key == listed.other).count() == 20_000
    assert kept.count() < 21_000 and maybe_listed(rows, "key", listed.limit(0)).count() == 0
    plans, stored = {}, near_dup.stored

    def seen(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(near_dup, "stored", seen)
    rng = random.Random(2)
    texts = [sentence(rng, 60) for _ in range(20)]
    near = [(20 + i, t + " end") for i, t in enumerate(texts[:5])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dict(map(tuple, near_dup.near_duplicates(spark.createDataFrame([*enumerate(texts), *near], "doc_id long, text string")).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {i: i for i in range(20)} | {20 + i: i for i in range(5)}
    for name, moved in (("nodes", "Generate explode(keys"), ("traits", "parity"), ("texts", "text"), ("similar", "text")):
        wide = [x for x in _below_shuffles(plans[name]) if moved in x]
        assert wide and all("BroadcastHashJoin" in x for x in wide), name


def test_few_pairs_of_a_large_group_are_verified(spark, monkeypatch):
    """A group of copies edited more and less: no pair of texts is compared twice, and few are at all."""
    rng = random.Random(22)
    base = sentence(rng, 150).split(" ")
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 6, 10])):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        texts.append(" ".join(words))
    compared, verify = [], near_dup.verify

    def counted(pairs, *rest):
        compared.extend(frozenset((bytes(r.u), bytes(r.v))) for r in pairs.collect())
        return verify(pairs, *rest)

    monkeypatch.setattr(near_dup, "verify", counted)
    near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(compared) == len(set(compared))
    assert len(compared) < 10 * len(texts)
