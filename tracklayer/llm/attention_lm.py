"""Language-model scoring: a small causal self-attention model on subword ids, trained and run in numpy.

Tokens. Words are lower-cased runs of anything but white space; each is cut in subwords of a public byte-level vocabulary,
and every text ends with an end id. The 992 subwords most frequent in training texts have a place of their own in 32
classes of 31, in the order of their spelling; each class has one more place for its share of all others, told apart by
their training counts. So a probability is that of the class, times that of the place, times that within the place.

Model. Embedding and position, one masked self-attention head, a residual sum, and the two softmax layers. The class and
place biases start at the counts. Training goes in rounds: each task takes the weights so far, makes Adam steps on its own
training windows of the round, and the weights of all tasks are averaged by the windows they saw. The rounds share out all
windows of all training texts: each is learned from in one round, and none is left out. A task's weights are one row; a few
tasks add them up for the driver.

Scoring. Windows of 64 ids overlap by 16. A window scores the ids behind the overlap, the first one of a text all of them,
so each id is scored once, with 16 ids of context at least where the text has them.

Base score. Exact word counts over all training texts, asked for in packed form: see `chunks`.

Defined results: null and empty texts are scored as their end alone; rows with a null id count as training texts; repeated
rows count each time they occur. Without training texts all counts are 0. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.chunks import NO_ID, Chunk, expand, make_chunks, pack_keys, shard_bits, split_by_shard, squeeze, unpack_keys, with_answers
from tracklayer.llm.common import stored

WIDTH = 32
CLASSES, PLACES = 32, 32
WINDOW, OVERLAP = 64, 16
STEP_WINDOWS = 16
SCORE_WINDOWS = 32
ROUNDS = 2
RATE = 0.02
#: So many tasks add up the weights of all others; each sends the driver one row.
SUM_TASKS = 8


#: So many words are cut in one text.
CUT_WORDS = 4096
#: White space that a word can hold.
_OTHER_GAP = re.compile("[^\\S ]")


class Subwords:
    """Cuts words in ids of a rank vocabulary; the id after the last rank is the end."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.cut = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.begins = np.zeros(max(ranks.values()) + 1, bool)
        self.begins[[i for token, i in ranks.items() if token.startswith(b" ")]] = True

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, each with a space before it, and the number of each word's.

        Words are cut in one text. No white space being in a word, each has one space, at its start, so an id that begins with a
        space is a word's first one. Words that hold white space of another kind could meet the next space: they are cut alone.
        """
        text = " ".join(["", *words])
        if not _OTHER_GAP.search(text):
            flat = np.array(self.cut(text), np.int64)
            first = np.flatnonzero(self.begins[flat])
            if len(first) == len(words):
                return flat, np.diff(first, append=len(flat))
        lists = [self.cut(" " + w) for w in words]
        return np.array([i for x in lists for i in x], np.int64), np.array([len(x) for x in lists], np.int64)

    def describe(self, words: list[bytes]) -> bytes:
        parts = [self.ids([w.decode() for w in words[i : i + CUT_WORDS]]) for i in range(0, len(words), CUT_WORDS)] or [self.ids([])]
        flat, sizes = (np.concatenate(z) for z in zip(*parts, strict=True))
        sizes = squeeze(sizes)
        return len(sizes).to_bytes(8, "little") + sizes + squeeze(flat)


_CUTTERS: dict[str, Subwords] = {}


def describer(path: str, pattern: str):
    """What `make_chunks` calls on a chunk's distinct words; the vocabulary is read once in each worker."""

    def describe(words: list[bytes]) -> bytes:
        if path not in _CUTTERS:
            with open(path, "rb") as lines:
                _CUTTERS[path] = Subwords({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}, pattern)
        return _CUTTERS[path].describe(words)

    return describe


def is_held_out(ids: np.ndarray) -> np.ndarray:
    return np.array([i != NO_ID and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids.tolist()], bool)


def subwords_of(described: bytes, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a chunk's distinct words and the number of each word's; one more word is the end."""
    n = int.from_bytes(described[:8], "little")
    return np.append(expand(described[8 + n :]).astype(np.int64), end), np.append(expand(described[8 : 8 + n]).astype(np.int64), 1)


def subword_stream(chunk: Chunk, described: bytes, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a chunk's words, the place among them of each id of its documents, and the number of these of each document.

    A document is closed by the end id.
    """
    flat, sizes = subwords_of(described, end)
    codes = np.insert(chunk.codes, chunk.ends, len(sizes) - 1)
    own = sizes[codes]
    stops = np.cumsum(own)
    at = np.repeat((np.cumsum(sizes) - sizes)[codes] - (stops - own), own)
    at += np.arange(len(at))
    return flat, at, np.diff(stops[chunk.ends + np.arange(len(chunk.ends))], prepend=0)


@dataclass
class Places:
    """Where each id stands: its place (class * PLACES + slot) and the natural logarithm of its share in the place."""

    place: np.ndarray
    share: np.ndarray
    counts: np.ndarray  # of each place

    @classmethod
    def of(cls, counts: np.ndarray, spelling: list[bytes]) -> Places:
        n = CLASSES * (PLACES - 1)
        frequent = np.argsort(-counts, kind="stable")[:n]
        frequent = np.array(sorted(frequent.tolist(), key=lambda i: spelling[i]))
        rest = np.arange(len(counts)) % CLASSES * PLACES + PLACES - 1
        place = rest.copy()
        ranks = np.arange(len(frequent))
        place[frequent] = ranks // (PLACES - 1) * PLACES + ranks % (PLACES - 1)
        smoothed = counts + 1.0
        total = np.bincount(place, smoothed, CLASSES * PLACES)
        return cls(place, np.log(smoothed / total[place]).astype(np.float32), total)


Weights = dict[str, np.ndarray]


def first_weights(places: Places) -> Weights:
    rng = np.random.default_rng(7)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    counts = (places.counts + 1e-3).reshape(CLASSES, PLACES)
    return {
        "embed": normal(CLASSES * PLACES, WIDTH, scale=0.3),
        "position": normal(WINDOW, WIDTH, scale=0.02),
        "qkv": normal(WIDTH, 3 * WIDTH, scale=WIDTH**-0.5),
        "out": normal(WIDTH, WIDTH, scale=0.1 * WIDTH**-0.5),
        "classes": normal(WIDTH, CLASSES, scale=0.02),
        "class_bias": np.log(counts.sum(1) / counts.sum()).astype(np.float32),
        "slots": normal(CLASSES, WIDTH, PLACES, scale=0.02),
        "slot_bias": np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32),
    }


def flatten(weights: Weights) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unflatten(flat: np.ndarray, like: Weights) -> Weights:
    """Views of one array, shaped as `like`."""
    out, at = {}, 0
    for name, w in like.items():
        out[name] = flat[at : at + w.size].reshape(w.shape)
        at += w.size
    return out


def native(weights: Weights) -> Weights:
    """The same in arrays of numpy's own type object.

    Arrays that came to a task pickled have a type object of their own; numpy then copies the operands of each product to buffers.
    """
    return unflatten(flatten(weights), weights)


_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))
#: Where the embeddings' numbers stand in the flat table.
_CELLS = np.arange(CLASSES * PLACES * WIDTH).reshape(-1, WIDTH)
#: Exponents up to this size need no shift: neither they nor the sum of a row leave what single precision holds.
PLAIN = 60


def _top(z: np.ndarray) -> np.ndarray:
    """The maximum of each row, the width being a power of two: by halves, which takes a fraction of the time on short rows."""
    while z.shape[-1] > 1:
        half = z.shape[-1] // 2
        z = np.maximum(z[..., :half], z[..., half:])
    return z


def _sums(z: np.ndarray) -> np.ndarray:
    """The sum of each row, as a product, which is faster on short rows."""
    return z @ np.ones((z.shape[-1], 1), z.dtype)


def _plain(z: np.ndarray) -> bool:
    return z.size == 0 or (z.max() <= PLAIN and z.min() >= -PLAIN)


def _attention(s: np.ndarray) -> np.ndarray:
    """Causal weights from the products of the last queries with all keys, in place, and the sums of their rows; not divided by them."""
    own = slice(s.shape[2] - s.shape[1], s.shape[2])
    if not _plain(s):
        s += _MASK[own, : s.shape[2]]
        s -= _top(s)
    np.exp(s, out=s)
    s *= _SEEN[own, : s.shape[2]]
    return _sums(s)


def _softmax(z: np.ndarray) -> np.ndarray:
    if not _plain(z):
        z -= _top(z)
    np.exp(z, out=z)
    z *= 1 / _sums(z)
    return z


def _by_class(targets: np.ndarray, scored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The scored places in order of their targets' classes: place, target and class of each, and the order."""
    at = np.flatnonzero(scored)
    goal = targets.ravel()[at]
    order = np.argsort((goal // PLACES).astype(np.int16), kind="stable")
    goal = goal[order]
    return at[order], goal, goal // PLACES, order


def _groups(classes: np.ndarray) -> list[tuple[int, slice]]:
    """The classes that occur among sorted ones, and the rows of each."""
    edges = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
    return [(c, slice(b, e)) for c, (b, e) in enumerate(zip(edges, edges[1:], strict=False)) if b < e]


def _turned(z: np.ndarray) -> np.ndarray:
    return z.transpose(0, 2, 1)


class Scorer:
    """The model forward over windows, in buffers that are used again: fresh large arrays cost more than the sums.

    As the weights stay, what depends on one id or one position only is multiplied once, in tables: queries, keys, and values
    that have gone through `out`.
    """

    def __init__(self, w: Weights, most: int = SCORE_WINDOWS):
        kind, w = w["qkv"].dtype.type, native(w)
        self.w = w
        turn = w["qkv"].copy()
        turn[:, :WIDTH] *= WIDTH**-0.5
        turn[:, 2 * WIDTH :] = turn[:, 2 * WIDTH :] @ w["out"]
        self.of_id, self.of_position = w["embed"] @ turn, w["position"] @ turn
        self.x, self.mixed = (np.zeros((most, WINDOW, WIDTH), kind) for _ in range(2))
        self.qkv = np.empty((most, WINDOW, 3 * WIDTH), kind)
        self.s = np.empty((most, WINDOW - OVERLAP, WINDOW), kind)
        self.kt, self.sums = np.empty((most, WIDTH, WINDOW), kind), np.ones((most, WINDOW, 1), kind)
        self.slots = list(w["slots"])
        self.h, self.part, self.z = (np.empty((most * WINDOW, size), kind) for size in (WIDTH, WIDTH, max(CLASSES, PLACES)))

    def hidden(self, inputs: np.ndarray, scored: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The last layer's inputs for the places `at` of all windows'; other windows than those scored there ask nothing of their first places."""
        n = len(inputs)
        x, mixed, qkv, s = self.x[:n], self.mixed[:n], self.qkv[:n], self.s[:n]
        np.take(self.w["embed"], inputs, axis=0, out=x, mode="clip")
        x += self.w["position"]
        np.take(self.of_id, inputs, axis=0, out=qkv, mode="clip")
        qkv += self.of_position
        q, k, v = (qkv[..., i * WIDTH : (i + 1) * WIDTH] for i in range(3))
        kt = self.kt[:n]
        np.copyto(kt, _turned(k))  # a product of operands that are not turned is the faster one
        np.matmul(q[:, OVERLAP:], kt, out=s)
        sums = self.sums[:n]
        sums[:, OVERLAP:] = _attention(s)
        np.matmul(s, v, out=mixed[:, OVERLAP:])
        early = np.flatnonzero(scored[:, :OVERLAP].any(axis=1))
        if len(early):
            s = np.matmul(q[early, :OVERLAP], _turned(k[early, :OVERLAP]))
            sums[early, :OVERLAP] = _attention(s)
            mixed[early, :OVERLAP] = np.matmul(s, v[early, :OVERLAP])
        h = np.take(x.reshape(-1, WIDTH), at, axis=0, out=self.h[: len(at)], mode="clip")
        own = np.take(mixed.reshape(-1, WIDTH), at, axis=0, out=self.part[: len(at)], mode="clip")
        own /= sums.reshape(-1, 1)[at]
        h += own
        return h

    def _chosen(self, z: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Log-softmax at each row's goal."""
        if not _plain(z):
            z -= _top(z)
        own = z[np.arange(len(z)), goal]
        np.exp(z, out=z)
        return own - np.log(_sums(z)[:, 0])

    def __call__(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """Natural logarithms for the scored places of windows: class and slot of the target."""
        at, goal, classes, order = _by_class(targets, scored)
        h, z = self.hidden(inputs, scored, at), self.z[: len(goal)]
        np.matmul(h, self.w["classes"], out=z)
        z += self.w["class_bias"]
        value = self._chosen(z, classes)
        for c, own in _groups(classes):
            np.dot(h[own], self.slots[c], out=z[own])
        z += np.take(self.w["slot_bias"], classes, axis=0, out=self.part[: len(goal)], mode="clip")
        found = np.empty(len(goal), value.dtype)
        found[order] = value + self._chosen(z, goal % PLACES)
        return found


def log_probabilities(w: Weights, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> np.ndarray:
    return Scorer(w, len(inputs))(inputs, targets, scored)


def _attend_back(vt: np.ndarray, a: np.ndarray, dots: np.ndarray, dmixed: np.ndarray, ds: np.ndarray) -> np.ndarray:
    """The gradient of the products of queries and keys, in `ds`.

    `a` are the weights before division by their sums, `dmixed` is the gradient of the mixed values divided by these, and `dots`
    its products with the mixed values: the sums over a row of what the first product gives, times the divided weights.
    """
    np.matmul(dmixed, vt, out=ds)
    ds -= dots
    ds *= a
    return ds


class Learner:
    """Weights in one array, their gradient and their Adam moments likewise, and buffers that every step uses again."""

    def __init__(self, w: Weights, most: int = STEP_WINDOWS):
        kind = w["qkv"].dtype.type
        self.flat = flatten(w).astype(kind, copy=False)
        self.w = unflatten(self.flat, w)
        self.slope, self.m, self.v, self.spare = (np.zeros_like(self.flat) for _ in range(4))
        self.g = unflatten(self.slope, w)
        self.steps = 0
        self.x, self.mixed, self.dmixed, self.dfull, self.dx = (np.zeros((most, WINDOW, WIDTH), kind) for _ in range(5))
        self.qkv, self.dqkv = (np.empty((most, WINDOW, 3 * WIDTH), kind) for _ in range(2))
        self.a, self.ds = (np.empty((most, WINDOW - OVERLAP, WINDOW), kind) for _ in range(2))
        self.kt, self.vt = (np.empty((most, WIDTH, WINDOW), kind) for _ in range(2))
        self.over, self.dots = np.ones((most, WINDOW, 1), kind), np.zeros((most, WINDOW, 1), kind)
        self.ones = np.ones(most * WINDOW, kind)
        self.h, self.dh, self.part, self.own = (np.empty((most * WINDOW, WIDTH), kind) for _ in range(4))
        # classes' rows, then slots': both are as wide, and go through softmax as one
        self.both, self.bias = np.empty((2 * most * WINDOW, PLACES), kind), np.empty((most * WINDOW, PLACES), kind)
        self.slots, self.g_slots = list(self.w["slots"]), list(self.g["slots"])

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> float:
        """Mean loss over the scored places; its gradient is left in `g`."""
        w, g, n = self.w, self.g, len(inputs)
        x, mixed, dmixed, dfull, dx, qkv, dqkv, a, ds = (b[:n] for b in (self.x, self.mixed, self.dmixed, self.dfull, self.dx, self.qkv, self.dqkv, self.a, self.ds))
        kt, vt, over, dots = self.kt[:n], self.vt[:n], self.over[:n], self.dots[:n]
        rows = lambda z: z.reshape(-1, z.shape[-1])
        (q, k, v), (dq, dk, dv) = ([z[..., i * WIDTH : (i + 1) * WIDTH] for i in range(3)] for z in (qkv, dqkv))
        turn = w["qkv"].copy()
        turn[:, :WIDTH] *= WIDTH**-0.5
        np.take(w["embed"], inputs, axis=0, out=x, mode="clip")
        x += w["position"]
        np.matmul(x, turn, out=qkv)  # a window at a time: small products are the faster ones
        late = slice(OVERLAP, None)
        np.copyto(kt, _turned(k))  # and so are those of operands that are not turned
        np.copyto(vt, _turned(v))
        np.matmul(q[:, late], kt, out=a)
        over[:, late] = _attention(a)
        np.matmul(a, v, out=mixed[:, late])
        early = np.flatnonzero(scored[:, :OVERLAP].any(axis=1))  # other windows ask nothing of their first places
        if len(early):
            begun = [z[early, :OVERLAP] for z in (q, k, v)]
            first = np.matmul(begun[0], _turned(begun[1]))
            over[early, :OVERLAP] = _attention(first)
            mixed[early, :OVERLAP] = np.matmul(first, begun[2])

        at, goal, classes, _ = _by_class(targets, scored)
        slots, many = goal % PLACES, len(goal)
        h, dh, part, own, bias = (b[:many] for b in (self.h, self.dh, self.part, self.own, self.bias))
        both = self.both[: 2 * many]
        p, z = both[:many], both[many:]
        divide = 1 / rows(over)[at]
        np.take(rows(mixed), at, axis=0, out=own, mode="clip")
        own *= divide
        np.matmul(own, w["out"], out=h)
        np.take(rows(x), at, axis=0, out=part, mode="clip")
        h += part
        np.matmul(h, w["classes"], out=p)
        p += w["class_bias"]
        groups = [(self.slots[c], h[of], z[of], self.g_slots[c], part[of]) for c, of in _groups(classes)]
        for slot, mine, to, _, _ in groups:
            np.dot(mine, slot, out=to)
        z += np.take(w["slot_bias"], classes, axis=0, out=bias, mode="clip")
        _softmax(both)
        each, goals = np.arange(2 * many), np.concatenate([classes, slots])
        loss = -np.log(both[each, goals] + 1e-30).sum()
        both[each, goals] -= 1
        both *= 1 / many
        np.matmul(h.T, p, out=g["classes"])
        np.dot(self.ones[:many], p, out=g["class_bias"])
        np.matmul(p, w["classes"].T, out=dh)
        g["slots"].fill(0)
        for slot, mine, slope, to, back in groups:
            np.dot(mine.T, slope, out=to)
            np.dot(slope, slot.T, out=back)
        dh += part
        np.dot((classes == np.arange(CLASSES)[:, None]).astype(z.dtype), z, out=g["slot_bias"])

        np.matmul(own.T, dh, out=g["out"])
        np.matmul(dh, w["out"].T, out=part)
        part *= divide
        own *= part
        for to, rest in ((dfull, dh), (dmixed, part), (dots, _sums(own))):
            to.fill(0)
            rows(to)[at] = rest
        _attend_back(vt, a, dots[:, late], dmixed[:, late], ds)
        dq[:, :OVERLAP] = 0
        np.matmul(ds, k, out=dq[:, late])
        np.matmul(_turned(ds), q[:, late], out=dk)
        np.matmul(_turned(a), dmixed[:, late], out=dv)
        if len(early):
            back = dmixed[early, :OVERLAP]
            slope = _attend_back(_turned(begun[2]), first, dots[early, :OVERLAP], back, np.empty_like(first))
            dq[early, :OVERLAP] = np.matmul(slope, begun[1])
            dk[early, :OVERLAP] += np.matmul(_turned(slope), begun[0])
            dv[early, :OVERLAP] += np.matmul(_turned(first), back)
        np.matmul(_turned(x), dqkv).sum(0, out=g["qkv"])
        g["qkv"][:, :WIDTH] *= WIDTH**-0.5
        np.matmul(dqkv, np.ascontiguousarray(turn.T), out=dx)
        dx += dfull
        dx.sum(0, out=g["position"])
        g["embed"].fill(0)
        np.add.at(g["embed"].ravel(), _CELLS[inputs.ravel()].ravel(), dx.ravel())  # on flat arrays, which are the fast ones
        return float(loss / many)

    def step(self, rate: float) -> None:
        """One step of Adam by the gradient, in place; the moments are kept undivided: `m` is ten times the mean, `v` a hundred times."""
        self.steps += 1
        t = self.spare
        self.m *= 0.9
        self.m += self.slope
        self.v *= 0.99
        np.multiply(self.slope, self.slope, out=t)
        self.v += t
        scale = (0.01 / (1 - 0.99**self.steps)) ** 0.5
        np.sqrt(self.v, out=t)
        t += 1e-8 / scale
        np.divide(self.m, t, out=t)
        t *= rate * min(1.0, self.steps / 20) * 0.1 / (1 - 0.9**self.steps) / scale
        self.flat -= t


def gradients(w: Weights, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over the scored places, and its gradient."""
    learner = Learner(w, len(inputs))
    return learner.gradient(inputs, targets, scored), learner.g


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over documents that lie one after another: document, first place, and first scored offset of each."""
    step = WINDOW - OVERLAP
    many = 1 + np.maximum(0, -(-(sizes - WINDOW) // step))
    doc = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    start = np.repeat(np.cumsum(sizes) - sizes, many) + number * step
    return doc, start, np.where(number > 0, OVERLAP, 0)


class Stream:
    """A chunk's ids as windows of inputs and targets."""

    def __init__(self, row: pd.Series, places: Places, end: int):
        self.chunk = Chunk(row)
        flat, at, self.sizes = subword_stream(self.chunk, row.described, end)
        self.share = lambda: places.share[flat][at]
        # an end, then all places, then room for what the last windows have beyond the end: targets are one place behind inputs
        shifted = np.zeros(1 + len(at) + WINDOW, np.int64)
        shifted[0] = places.place[end]
        np.take(places.place[flat], at, out=shifted[1 : 1 + len(at)], mode="clip")
        self.windows = sliding_window_view(shifted, WINDOW)
        self.doc, self.start, self.skip = windows_of(self.sizes)
        self.stop = np.cumsum(self.sizes)[self.doc]

    def batch(self, own: np.ndarray) -> tuple[np.ndarray, ...]:
        """Inputs, targets, which places are scored, and where these are in the stream."""
        start, each = self.start[own], np.arange(WINDOW)
        scored = (each < (self.stop[own] - start)[:, None]) & (each >= self.skip[own][:, None])
        return self.windows[start], self.windows[start + 1], scored, start[:, None] + each


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.Series]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pandas().iloc[0]


def count_subwords(chunks: DataFrame, end: int) -> np.ndarray:
    """Counts of all ids in training texts; at most a vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(end + 1, np.int64)
        for row in _rows(batches):
            chunk = Chunk(row)
            flat, sizes = subwords_of(row.described, end)
            training = ~is_held_out(chunk.ids)
            words = np.append(np.bincount(chunk.codes[np.repeat(training, chunk.sizes)], minlength=len(sizes) - 1), training.sum())
            total += np.bincount(flat, np.repeat(words, sizes), end + 1).astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    counts = np.zeros(end + 1, np.int64)
    for r in chunks.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r.id] = r.n
    return counts


def round_windows(training: np.ndarray, number: int, rounds: int) -> np.ndarray:
    """The windows that a round learns from, of a chunk's windows that are marked as training ones; the rounds have all of them."""
    return np.flatnonzero(training)[number::rounds]


def train(chunks: DataFrame, places: Places, end: int, rounds: int = ROUNDS) -> Weights:
    """Rounds of local Adam steps on training windows, averaged over all tasks."""
    weights = first_weights(places)
    for number in range(rounds):

        def local(batches: Iterator[pa.RecordBatch], weights=weights, number=number) -> Iterator[pa.RecordBatch]:
            learner, seen = Learner(weights), 0
            for row in _rows(batches):
                stream = Stream(row, places, end)
                own = round_windows(~is_held_out(stream.chunk.ids)[stream.doc], number, rounds)
                own = np.random.default_rng(number).permutation(own)
                for i in range(0, len(own), STEP_WINDOWS):
                    part = own[i : i + STEP_WINDOWS]
                    learner.gradient(*stream.batch(part)[:3])
                    learner.step(RATE * 0.5**number)
                    seen += len(part)
            if seen:
                yield _summed(seen, learner.flat.astype(float) * seen)

        done = chunks.mapInArrow(local, _SUM)
        found = done.repartition(SUM_TASKS).mapInArrow(add_weights, _SUM).collect()
        if found:
            flat = sum(np.frombuffer(r.w) for r in found) / sum(r.n for r in found)
            weights = unflatten(flat.astype(np.float32), weights)
    return weights


_SUM = "n long, w binary"


def _summed(n: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "w"])


def add_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the task's rows: their windows and their weights, times windows, summed."""
    n, total = 0, None
    for batch in batches:
        for many, w in zip(batch.column("n").to_pylist(), batch.column("w"), strict=True):
            own = np.frombuffer(w.as_buffer())
            n, total = n + many, own if total is None else total + own
    if n:
        yield _summed(n, total)


_REQUEST = "shard int, chunk long, keys binary, extra binary"


def word_counts(chunks: DataFrame) -> tuple[DataFrame, int, int]:
    """Training counts of each chunk's distinct words (answers), number of all training words, and of distinct ones."""
    total = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = shard_bits(total)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row)
            keys, order = _word_keys(chunk)
            training = np.repeat(~is_held_out(chunk.ids), chunk.sizes)
            counts = np.bincount(chunk.codes[training], minlength=len(keys))[order]
            rows = [{"shard": s, "chunk": row.chunk, "keys": pack_keys(keys[own]), "extra": squeeze(counts[own])} for s, own in enumerate(split_by_shard(keys, bits)) if own.stop > own.start]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["shard", "chunk", "keys", "extra"]), pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())]), preserve_index=False)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_keys(k) for k in rows["keys"]]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, np.concatenate([expand(x) for x in rows["extra"]]).astype(float)).astype(np.int64)
        replies = [squeeze(part) for part in np.split(total[which], np.cumsum([len(k) for k in keys])[:-1])]
        n = [0] * len(rows)
        out = pd.DataFrame({"chunk": rows["chunk"], "shard": rows["shard"], "answer": replies, "words": n, "distinct": n})
        out.loc[0, ["words", "distinct"]] = [int(total.sum()), int((total > 0).sum())]
        return out

    requests = chunks.mapInArrow(ask, _REQUEST)
    answers = stored(requests.groupBy("shard").applyInPandas(meet, "chunk long, shard int, answer binary, words long, distinct long"), "word-counts")
    sums = answers.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    return answers, sums[0], sums[1]


def _word_keys(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct words, and the words' order by them."""
    keys = chunk.word_hashes
    order = np.argsort(keys, kind="stable")
    return keys[order], order


def score_texts(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """held_out, n_tokens, n_known, train_tokens, base_score, n_subwords and score (base 10) of every text.

    `vocabulary` is the path of a rank file that all workers can read; texts whose crc32(id as text) mod 7 is 2 are held out.
    """
    with open(vocabulary, "rb") as lines:
        spelling = [base64.b64decode(line.split()[0]) for line in sorted(lines, key=lambda x: int(x.split()[1]))]
    end = len(spelling)
    chunks = make_chunks(docs, id_col, text_col, lower=True, describe=describer(vocabulary, pattern))
    counts = count_subwords(chunks, end)
    places = Places.of(counts, [*spelling, b""])
    weights = train(chunks, places, end, rounds)
    answers, words, distinct = word_counts(chunks)
    texts = int(counts[end])
    n_all, n_distinct = words + texts, distinct + (texts > 0)

    def score(row: pd.Series, own: pd.DataFrame) -> pd.DataFrame:
        stream = Stream(row, places, end)
        chunk = stream.chunk
        each = stream.share().astype(float)
        scorer = Scorer(weights)
        for i in range(0, len(stream.doc), SCORE_WINDOWS):
            inputs, targets, scored, at = stream.batch(np.arange(i, min(i + SCORE_WINDOWS, len(stream.doc))))
            each[at[scored]] += scorer(inputs, targets, scored)
        starts = np.cumsum(stream.sizes) - stream.sizes
        known = np.zeros(len(chunk.raw), np.int64)
        if len(own):
            known[_word_keys(chunk)[1]] = np.concatenate([expand(a) for a in own["answer"]])
        c = np.append(known, texts)
        codes = np.insert(chunk.codes, chunk.ends, len(known))  # the end of each text
        sizes = chunk.sizes + 1
        begins = np.cumsum(sizes) - sizes
        value = np.log10((c + 1.0) / (n_all + 1 * (n_distinct + 1)))
        return pd.DataFrame({
            "id": chunk.shown_ids(),
            "held_out": is_held_out(chunk.ids),
            "n_tokens": sizes,
            "n_known": np.add.reduceat((c > 0)[codes].astype(np.int64), begins),
            "train_tokens": n_all,
            "base_score": np.add.reduceat(value[codes], begins),
            "n_subwords": stream.sizes,
            "score": np.add.reduceat(each, starts) / np.log(10),
        })

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, n_subwords long, score double"
    return with_answers(chunks, answers, score, schema).withColumnRenamed("id", id_col)
