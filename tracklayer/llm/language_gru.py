"""Language identification by a bidirectional gated recurrent network over bytes.

Model. Each byte has a row of gate inputs; one recurrent layer of WIDTH units reads a window forwards, another backwards, both
in their first state outside of the text, so neighbours in a batch change nothing. A softmax over both states labels every
byte with a language. A document's probabilities are the mean of its bytes' probabilities; the best one is the prediction,
the first in order of names where they tie.

Windows. A text is cut in stretches of OWN bytes, read with MARGIN bytes on either side, so both directions have some context
where a stretch begins. Each byte is labelled once, in its stretch. Windows of many texts are run side by side.

Training, in numpy by backpropagation through time, takes windows from at most SAMPLE_PER_LANGUAGE documents of each
language, SNIPPETS of them from each document, spread over the whole text; which documents is decided by a hash of id and
text. The languages themselves, one row each, and these snippets (a few hundred bytes a document) reach the driver.

Defined results: null and empty texts and those without a letter are `und` with score 0, as is every text if there is
nothing to learn from; with one language learned every other text has it. Null ids and repeated rows are kept one for one.
Rows with a null language are never learned from, rows that are exact repeats are learned from once. Only text is read for
a prediction. Empty tables give none. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 16
OWN, MARGIN = 240, 8
SAMPLE_PER_LANGUAGE, SNIPPETS, SNIPPET_BYTES = 300, 3, 96
STEPS, STEP_WINDOWS, RATE, SEED = 200, 128, 0.02, 7
HASHES = 1 << 40
#: Windows run side by side: their states stay within a core's cache.
BATCH_WINDOWS = 1024
STEP_DOCS = 500
#: Stands for what is outside of a text.
OUTSIDE = 256


@dataclass
class Network:
    """Parameters for both directions: inputs[direction, gate unit, byte], recurrent[direction, gate unit, unit].

    Gate units are those of reset, update and candidate, in this order; `inner` is the candidate's bias within the reset.
    """

    inputs: np.ndarray
    recurrent: np.ndarray
    inner: np.ndarray
    output: np.ndarray  # [direction, language, unit]
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.inner, self.output, self.bias]


def first_network(languages: int, width: int = WIDTH) -> Network:
    rng = np.random.default_rng(SEED)
    draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
    recurrent = draw(2, 3 * width, width, scale=width**-0.5)
    return Network(draw(2, 3 * width, OUTSIDE + 1, scale=0.5), recurrent, np.zeros((2, width, 1), np.float32), draw(2, languages, width, scale=0.1), np.zeros((languages, 1), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def run_direction(net: Network, k: int, codes: np.ndarray, keep: list | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Places and states of one direction over codes[place, window]; `keep` collects what the way back needs."""
    size = net.recurrent.shape[2]
    table, weights, inner = net.inputs[k], net.recurrent[k], net.inner[k]
    state = np.zeros((size, codes.shape[1]), np.float32)
    outside = codes == OUTSIDE
    for t in range(len(codes)) if k == 0 else range(len(codes) - 1, -1, -1):
        x = np.take(table, codes[t], axis=1)
        pre = weights @ state
        gates = _sigmoid(np.add(x[: 2 * size], pre[: 2 * size], out=pre[: 2 * size]))
        reset, update = gates[:size], gates[size:]
        within = pre[2 * size :]
        within += inner
        candidate = x[2 * size :]
        if keep is None:
            within *= reset
            candidate += within
        else:
            candidate += reset * within
        np.tanh(candidate, out=candidate)
        if keep is not None:
            keep.append((t, state, reset, update, within, candidate))
        state = state - candidate
        state *= update
        state += candidate
        if outside[t].any():
            state[:, outside[t]] = 0
        yield t, state


def log_probabilities(net: Network, codes: np.ndarray, keep: list[list] | None = None) -> np.ndarray:
    """[place, language, window]: the log of each language's probability at each place."""
    scores = np.empty((len(codes), len(net.bias), codes.shape[1]), np.float32)
    scores[:] = net.bias
    for k in (0, 1):
        for t, state in run_direction(net, k, codes, keep[k] if keep else None):
            scores[t] += net.output[k] @ state
    scores -= scores.max(axis=1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return scores


def gradients(net: Network, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, Network]:
    """Loss and its derivatives: `weight[place, window]` times minus the log-probability of the window's label."""
    keep: list[list] = [[], []]
    logs = log_probabilities(net, codes, keep)
    windows = np.arange(codes.shape[1])
    loss = -float((logs[:, labels, windows] * weight).sum())
    wrong = np.exp(logs)
    wrong[:, labels, windows] -= 1
    wrong *= weight[:, None, :]
    out = Network(*(np.zeros_like(p) for p in net.parts()))
    out.bias[:, 0] = wrong.sum(axis=(0, 2))
    size = net.recurrent.shape[2]
    for k in (0, 1):
        back = np.zeros((size, codes.shape[1]), np.float32)
        by_place = np.empty((len(codes), 3 * size, codes.shape[1]), np.float32)
        for t, before, reset, update, within, candidate in reversed(keep[k]):
            state = candidate + update * (before - candidate)
            state[:, codes[t] == OUTSIDE] = 0
            out.output[k] += wrong[t] @ state.T
            back += net.output[k].T @ wrong[t]
            back[:, codes[t] == OUTSIDE] = 0
            to_candidate = back * (1 - update) * (1 - candidate * candidate)
            to_update = back * (before - candidate) * update * (1 - update)
            to_reset = to_candidate * within * reset * (1 - reset)
            to_within = to_candidate * reset
            by_place[t] = np.concatenate([to_reset, to_update, to_candidate])
            through = np.concatenate([to_reset, to_update, to_within])
            out.recurrent[k] += through @ before.T
            out.inner[k, :, 0] += to_within.sum(axis=1)
            back = back * update + net.recurrent[k].T @ through
        flat, by_code = codes.ravel(), by_place.transpose(1, 0, 2).reshape(3 * size, -1)
        for unit in range(3 * size):
            out.inputs[k, unit] = np.bincount(flat, by_code[unit], OUTSIDE + 1)
    return loss, out


def train(snippets: list[bytes], labels: list[int], languages: int, steps: int = STEPS) -> Network:
    """Adam on windows drawn so that each language has the same share of every step."""
    net = first_network(languages)
    rng = np.random.default_rng(SEED)
    longest = max(map(len, snippets))
    codes = np.full((longest + 2, len(snippets)), OUTSIDE, np.int64)
    for i, s in enumerate(snippets):
        codes[1 : len(s) + 1, i] = np.frombuffer(s, np.uint8)
    y = np.array(labels)
    of = [np.flatnonzero(y == k) for k in range(languages)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    each = max(1, STEP_WINDOWS // languages)
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(o, each) for o in of])
        own = codes[:, chosen]
        weight = (own != OUTSIDE).astype(np.float32)
        _, grads = gradients(net, own, y[chosen], weight / max(1.0, float(weight.sum())))
        norm = sum(float((g * g).sum()) for g in grads.parts()) ** 0.5
        rate = RATE * min(1.0, step / 20) * (1 - step / (steps + 1))
        for p, g, (m, v) in zip(net.parts(), grads.parts(), moments, strict=True):
            g /= max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _windows(sizes: np.ndarray, own: int = OWN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, begin within the text, and size of every stretch, shortest first."""
    per = -(-sizes // own)
    text = np.repeat(np.arange(len(sizes)), per)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * own
    size = np.minimum(own, sizes[text] - begin)
    order = np.argsort(size, kind="stable")
    return text[order], begin[order], size[order]


def label_bytes(net: Network, texts: list[bytes], place: np.ndarray | None = None) -> np.ndarray:
    """Sums of each text's byte probabilities: [text, language]. `place`, if given, gets the best language of every byte."""
    sizes = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    total = np.zeros((len(texts), len(net.bias)))
    text, begin, size = _windows(sizes)
    for i in range(0, len(text), BATCH_WINDOWS):
        own = slice(i, i + BATCH_WINDOWS)
        at = begin[own] + np.arange(-MARGIN, size[own].max() + MARGIN)[:, None]  # [place, window]
        inside = (at >= 0) & (at < sizes[text[own]])
        codes = np.where(inside, data[np.where(inside, at + firsts[text[own]], 0)].astype(np.int64), OUTSIDE)
        logs = log_probabilities(net, codes)[MARGIN : len(codes) - MARGIN]
        scored = np.arange(len(logs))[:, None] < size[own]
        sums = np.einsum("tlw,tw->wl", np.exp(logs), scored.astype(np.float32))
        np.add.at(total, text[own], sums)
        if place is not None:
            place[(at[MARGIN : len(codes) - MARGIN] + firsts[text[own]])[scored]] = logs.argmax(axis=1)[scored]
    return total


def _identity(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), text_col)


def learn_languages(
    docs: DataFrame,
    learn_from: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    steps: int = STEPS,
) -> tuple[list[str], Network | None]:
    """The languages of the rows that `learn_from` chooses, in order of names, and a network fitted to a sample of them."""
    rows = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    own = rows.select(F.col(lang_col).cast("string").alias("lang"), _identity(id_col, text_col).alias("key"), F.encode(F.col(text_col), "UTF-8").alias("body"))
    sizes = {r.lang: r.n for r in own.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}
    if not sizes:
        return [], None
    # about four times as many as are wanted pass a bound on the hash; the exact bound follows on those few
    bound = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 4 * per_language / max(1, n)))))
    size, last = F.octet_length("body"), SNIPPETS - 1
    cut = [F.substring(F.col("body"), (F.greatest(size - SNIPPET_BYTES, F.lit(0)) * i / last).cast("int") + 1, F.lit(SNIPPET_BYTES)) for i in range(SNIPPETS)]
    few = own.where(F.pmod("key", F.lit(HASHES)) < bound[F.col("lang")] * HASHES)
    few = few.select("lang", "key", F.array_distinct(F.array(*cut)).alias("snippets")).groupBy("lang", "key").agg(F.min("snippets").alias("snippets"))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key", "snippets"))).where(F.col("rank") <= per_language)
    found = sorted((r.lang, r.key, [bytes(s) for s in r.snippets]) for r in ranked.drop("rank").collect())
    languages = sorted({lang for lang, _, _ in found})
    samples = [(s, languages.index(lang)) for lang, _, snippets in found for s in snippets]
    if not samples:
        return [], None
    return languages, train([s for s, _ in samples], [k for _, k in samples], len(languages), steps)


def predict_languages(docs: DataFrame, languages: list[str], net: Network | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """lang_pred and score of every text; with `spans` also its stretches of bytes of one language, as start, end, lang."""
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP_DOCS):
                batch = whole.slice(start, STEP_DOCS)
                letters = np.array(batch.column("letters").to_pylist(), bool)
                texts = [t.as_buffer().to_pybytes() if ok else b"" for t, ok in zip(batch.column("text"), letters, strict=True)]
                place = np.zeros(sum(map(len, texts)), np.int64) if spans else None
                names, scores, lists = ["und"] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
                if net is not None:
                    total = label_bytes(net, texts, place)
                    best = total.argmax(axis=1)
                    names = [languages[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
                    n = np.array([max(1, len(t)) for t in texts])
                    scores = np.where(letters, np.minimum(1.0, total[np.arange(len(texts)), best] / n), 0.0)
                    at = 0
                    for own, text in zip(lists, texts, strict=True) if spans else ():
                        marks = place[at : at + len(text)]
                        edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(text)] if len(text) else []
                        own += [{"start": a, "end": b, "lang": languages[marks[a]]} for a, b in zip(edges, edges[1:], strict=False)]
                        at += len(text)
                columns = [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(lists, pa.list_(span))] if spans else [])], names=[id_col, "lang_pred", "score", *(["spans"] if spans else [])])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), text.rlike("\\p{L}").alias("letters"))
    schema = f"`{id_col}` {kind}, lang_pred string, score double" + (", spans array<struct<start:long,end:long,lang:string>>" if spans else "")
    return rows.mapInArrow(predict, schema)
