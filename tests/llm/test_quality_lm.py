"""Quality rules and language-model scoring."""

from __future__ import annotations

import math
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from texts import sentence

from tracklayer.llm import attention_lm as lm
from tracklayer.llm import line_crf
from tracklayer.llm.common import WORD


def brute_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    return len({k for i, w in enumerate(windows) if counts[w] > 1 for k in (i, i + 1, i + 2)})


def test_measures(docs, clashing, no_docs, rows):
    wanted = []
    for i, t in rows:
        t = t or ""
        words, seen, dup = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        repeats = brute_repeats(words)
        failed = len(words) < 50 or 100 * repeats > 50 * len(words)
        wanted.append((i, len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, repeats, failed, not failed))
    for frame in (docs, clashing):
        found = line_crf.judge_quality(frame, None).drop("content_share", "marks").collect()
        assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
        kept = line_crf.keep_good(frame, None)
        assert kept.columns == frame.columns and kept.count() == sum(w[-1] for w in wanted)
    assert line_crf.judge_quality(no_docs, None).collect() == []


def test_viterbi_is_the_best_sequence():
    from itertools import product

    rng = np.random.default_rng(2)
    field = line_crf.LineField(rng.normal(size=(2, line_crf.N_FEATURES)), rng.normal(size=(2, 2)), rng.normal(size=2))
    x = rng.normal(size=(7, line_crf.N_FEATURES))
    score = x @ field.emission.T

    def value(marks):
        steps = sum(field.transition[a, b] for a, b in zip(marks, marks[1:], strict=False))
        return field.start[marks[0]] + steps + sum(score[i, m] for i, m in enumerate(marks))

    assert tuple(field.decode(x)) == max(product([0, 1], repeat=7), key=value)


def test_field_separates_held_out_documents(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(120):
        good = i % 3 > 0
        lines = [sentence(rng, 12) + "." if good else " ".join(f"{w.upper()}!!" for w in sentence(rng, 10).split()) for _ in range(6)]
        rows.append((i, "\n".join(lines)))
        if i < 60:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    field = line_crf.fit_lines(docs, spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int"))
    found = {r.doc_id: r for r in line_crf.judge_quality(docs, field).collect()}
    assert all(found[i].kept == (i % 3 > 0) for i in range(60, 120))
    assert set(found[61].marks) == {"c"} and set(found[60].marks) == {"b"}
    assert line_crf.fit_lines(docs, spark.createDataFrame([], "doc_id long, quality int")) is None


def test_gradients():
    rng = np.random.default_rng(0)
    places = lm.Places.of(rng.integers(1, 100, 2000), [str(i).encode() for i in range(2000)])
    w = {k: v.astype(float) for k, v in lm.first_weights(places).items()}
    inputs, targets, scored = rng.integers(0, 1024, (2, 64)), rng.integers(0, 1024, (2, 64)), rng.random((2, 64)) < 0.7
    loss, g = lm.gradients(w, inputs, targets, scored)
    assert loss == pytest.approx(-lm.log_probabilities(w, inputs, targets, scored).mean(), rel=1e-5)
    for name, at in [("embed", (int(inputs[0, 3]), 5)), ("qkv", (3, 40)), ("out", (2, 2)), ("classes", (1, 4)), ("position", (7, 1))]:
        old, e = w[name][at], 1e-4
        both = []
        for sign in (1, -1):
            w[name][at] = old + sign * e
            both.append(-lm.log_probabilities(w, inputs, targets, scored).mean())
        w[name][at] = old
        assert g[name][at] == pytest.approx((both[0] - both[1]) / 2 / e, abs=2e-4)


def test_steps_in_place_are_those_of_adam(spark):
    """Steps on used buffers, with first windows and without, end where plain ones on fresh arrays do; tasks' weights are averaged as one row each."""
    rng = np.random.default_rng(6)
    places = lm.Places.of(rng.integers(1, 100, 2000), [str(i).encode() for i in range(2000)])
    begin = {k: v.astype(float) for k, v in lm.first_weights(places).items()}
    learner, flat, m, v = lm.Learner(begin, 4), lm.flatten(begin), 0.0, 0.0
    for step, n in enumerate((4, 4, 1, 3), 1):
        scored = rng.random((n, 64)) < 0.8
        scored[step % 2 :, : lm.OVERLAP] = False
        batch = rng.integers(0, 1024, (n, 64)), rng.integers(0, 1024, (n, 64)), scored
        g = lm.flatten(lm.gradients(lm.unflatten(flat, begin), *batch)[1])
        m, v = m + 0.1 * (g - m), v + 0.01 * (g * g - v)
        flat = flat - 0.02 * step / 20 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        learner.gradient(*batch)
        learner.step(0.02)
    assert np.abs(learner.flat - flat).max() < 1e-6
    rows = [(n, (rng.random(5) * n).tobytes()) for n in (3, 1, 2)]
    (found,) = spark.createDataFrame(rows, "n long, w binary").coalesce(1).mapInArrow(lm.add_weights, "n long, w binary").collect()
    assert found.n == 6 and np.frombuffer(found.w) == pytest.approx(sum(np.frombuffer(w) for _, w in rows))


def plain_log_probabilities(w, inputs, targets):
    """The model written down place by place, for all places of each window."""
    x = w["embed"][inputs] + w["position"]
    q, k, v = np.split(x @ w["qkv"], 3, axis=-1)
    s = q @ k.transpose(0, 2, 1) * lm.WIDTH**-0.5
    s[:, np.triu(np.ones((lm.WINDOW, lm.WINDOW), bool), 1)] = -np.inf
    a = np.exp(s - s.max(-1, keepdims=True))
    h = x + (a / a.sum(-1, keepdims=True)) @ v @ w["out"]
    c, slot = targets // lm.PLACES, targets % lm.PLACES

    def chosen(z, goal):
        z = z - z.max(-1, keepdims=True)
        return np.take_along_axis(z, goal[..., None], -1)[..., 0] - np.log(np.exp(z).sum(-1))

    return chosen(h @ w["classes"] + w["class_bias"], c) + chosen(np.einsum("nwi,nwij->nwj", h, w["slots"][c]) + w["slot_bias"][c], slot)


@pytest.mark.parametrize("factor", [1, 8, 40])
def test_scores_and_steps_are_those_of_the_plain_model(factor):
    """Also where products of queries and keys, or the last layers' numbers, are far beyond what an exponential holds."""
    rng = np.random.default_rng(5)
    places = lm.Places.of(rng.integers(1, 100, 2000), [str(i).encode() for i in range(2000)])
    w = {k: v.astype(float) * (factor if k in ("qkv", "classes", "slots") else 1) for k, v in lm.first_weights(places).items()}
    inputs, targets, scored = rng.integers(0, 1024, (5, 64)), rng.integers(0, 1024, (5, 64)), rng.random((5, 64)) < 0.7
    scored[1:3, : lm.OVERLAP] = False
    scored[3] = False
    plain = plain_log_probabilities(w, inputs, targets)[scored]
    assert lm.log_probabilities(w, inputs, targets, scored) == pytest.approx(plain, rel=1e-6, abs=1e-6)
    loss, g = lm.gradients(w, inputs, targets, scored)
    assert loss == pytest.approx(-plain.mean(), rel=1e-4) and all(np.isfinite(x).all() for x in g.values())
    if factor == 40:
        x = w["embed"][inputs] + w["position"]
        assert (x @ w["qkv"][:, : lm.WIDTH] @ (x @ w["qkv"][:, lm.WIDTH : 2 * lm.WIDTH]).transpose(0, 2, 1) * lm.WIDTH**-0.5).max() > 100


def test_weights_sent_to_tasks_are_of_numpys_own_type():
    """Others take two to three times as long: numpy copies them for each product."""
    places = lm.Places.of(np.arange(1, 2001), [str(i).encode() for i in range(2000)])
    sent = pickle.loads(pickle.dumps(lm.first_weights(places)))
    assert sent["qkv"].dtype is not np.dtype(np.float32)
    for user in (lm.Learner(sent), lm.Scorer(sent)):
        arrays = [*user.w.values(), *(x for x in vars(user).values() if isinstance(x, np.ndarray))]
        assert len(arrays) > 15 and all(a.dtype is np.dtype(np.float32) for a in arrays)


def test_words_cut_together_are_cut_as_alone():
    path = P.path("byte_bpe_50k.tiktoken")
    rng = random.Random(2)
    plain = [*sentence(rng, 300).split(" "), "don't", "'s", "'", "12a", "a1,b", "--", "été", "\u4e2d\u6587", "\U0001f600x", "\u200b", "x\u0301"]
    odd = ["a\xa0", "\u3000", "\x85b", "\x1c", "c\u2028d"]
    describe = lm.describer(path, P.PATTERN)
    describe([])
    cutter = lm._CUTTERS[path]
    for words in ([], plain, odd, plain + odd, plain * 30, odd[:1] + plain * 30):
        flat, sizes = lm.subwords_of(describe([w.encode() for w in words]), 50_256)
        found = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
        assert found == [*(cutter.cut(" " + w) for w in words), [50_256]]
    assert cutter.ids(plain)[1].sum() < len("".join(plain).encode())  # and not byte by byte


def test_chunks_hold_the_words_of_the_contract(spark):
    """Gaps are the six characters only, and only A to Z are lower-cased."""
    texts = ["", " ", "Ab\tcD\nE\x0bf\x0cG\rh  I", "\x1cA\x1d \x1eB\x1f", "\xa0Ä\xa0B\u2028Ç\x85d\u3000 \u0130I", "\ufeffX \x00Y\x7f", "\U00010400 K\u212a"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for fold in (True, False):
        (row,) = lm.make_chunks(frame, "doc_id", "text", lower=fold).toPandas().itertuples()
        chunk = lm.Chunk(row)
        words = np.array([*chunk.words, None], object)[chunk.codes].tolist()
        wanted = [WORD.findall(t.translate(lower) if fold else t) for t in texts]
        assert chunk.sizes.tolist() == [len(x) for x in wanted] and words == [w for x in wanted for w in x]


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, 3000)
    places = lm.Places.of(counts, [str(i).encode() for i in range(3000)])
    w = lm.first_weights(places)
    inputs = np.tile(rng.integers(0, 1024, 64), (1, 1))
    scored = np.zeros((1, 64), bool)
    scored[0, 9] = True
    each = [lm.log_probabilities(w, inputs, np.full((1, 64), p), scored)[0] for p in range(1024)]
    total = np.exp(np.array(each)[places.place] + places.share).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_windows_score_each_id_once():
    sizes = np.array([1, 63, 64, 65, 112, 113, 500])
    doc, start, skip = lm.windows_of(sizes)
    hits = np.zeros(sizes.sum(), int)
    ends = np.cumsum(sizes)
    for d, s, k in zip(doc, start, skip, strict=True):
        at = np.arange(s + k, min(s + lm.WINDOW, ends[d]))
        hits[at] += 1
    assert (hits == 1).all()


def test_every_training_window_is_learned_from(spark):
    training = np.random.default_rng(3).random(100) < 0.8
    for rounds in (1, 2, 3):
        seen = np.concatenate([lm.round_windows(training, r, rounds) for r in range(rounds)])
        assert sorted(seen.tolist()) == np.flatnonzero(training).tolist()
    # another order of one text's words, with the same counts, gives other weights, wherever the text stands
    rng = random.Random(8)
    ids = [i for i in range(30) if zlib.crc32(str(i).encode()) % 7 != 2][:12]
    texts = [sentence(rng, 12) for _ in ids]
    counts = rng.sample(range(1, 60_000), 50_257)
    places, path = lm.Places.of(np.array(counts), [str(i).encode() for i in range(50_257)]), P.path("byte_bpe_50k.tiktoken")

    def weights(turned):
        rows = [(i, " ".join(reversed(t.split(" "))) if k == turned else t) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        return lm.flatten(lm.train(lm.make_chunks(frame, "doc_id", "text", lower=True, describe=lm.describer(path, P.PATTERN)), places, 50_256))

    plain = weights(None)
    assert (plain == weights(None)).all()
    for turned in (0, 4, 7, 11):
        assert (plain != weights(turned)).any()


def test_scores(docs, clashing, no_docs, rows):
    path = P.path("byte_bpe_50k.tiktoken")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(i, [*WORD.findall((t or "").translate(lower)), None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for (_, t), h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    wanted = sorted(((str(i), h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for (i, t), h in zip(tokens, held, strict=True)), key=str)
    for frame in (docs, clashing):
        found = lm.score_texts(frame, path, P.PATTERN).collect()
        assert sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=str) == wanted
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert lm.score_texts(no_docs, path, P.PATTERN).collect() == []
