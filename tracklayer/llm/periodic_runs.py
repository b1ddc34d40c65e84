"""Periodic runs: maximal stretches of words that repeat with a smallest period, found by block convolution.

A run of period q >= 2m - 1 is longer than two periods, so it holds a whole aligned block of m words together with the
block's copy q words later. At each dyadic scale m the blocks are therefore looked up in the window of words that begins
2m - 1 later and ends before 4m - 1: the sum of squared differences between block and window is a convolution, computed
for all blocks at once by a number-theoretic transform modulo a prime. It is 0 wherever the block occurs, so no occurrence
is missed; a sum that is 0 by the modulus alone is refused later, when words are compared. The distances of occurrences
seed extensions to both sides, and an extension of two periods and the least length is a run, unless the same stretch is
a run of a smaller period, which was found before. Periods below the first block's reach take the sums directly.

What needs no convolution is left out exactly: a block with a word that does not recur in its window occurs nowhere there,
and one deep within a known run of at most m words' period occurs at the multiples of that period alone, which extend to
that run.

Texts are worked on where they lie, many short ones joined with separators that occur once each: no shuffle, one text in
memory at a time at most beyond the bound of a step.

Defined results: null and empty texts have no words and no runs; a null id is kept; repeated rows give equal results, one for
one; ties for the longest run go to the smallest start, then period. Empty tables give none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tracklayer.llm.common import WORD, id_and_text

#: A prime with roots of unity of order 2**23, and one of its generators; (q, q * q) of its residues fit in 64 bits.
PRIME, ROOT = 998_244_353, 3
LEAST_WORDS = 12
#: The smallest block that is transformed; periods of at most twice as many words, less two, are compared directly.
FIRST_BLOCK = 16
STEP_WORDS = 200_000
#: Numbers in the arrays of one batch of transforms.
TRANSFORM_CELLS = 1 << 20

_P = np.uint64(PRIME)


@dataclass
class Runs:
    """Runs by start, then period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    size = 1
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(pow(base, size, PRIME)) % _P
        size += more
    return out


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row; rows have a power of two of residues."""
    rows, n = x.shape
    root = pow(ROOT, (PRIME - 1) // n, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    y = x.reshape(rows, n, 1)  # [place within the rest, residue class done so far]
    size = n
    step = root
    while size > 1:
        half = size // 2
        a, b = y[:, :half], y[:, half:]
        twiddle = _powers(step, half)[None, :, None]
        total = a + b
        np.subtract(total, _P, out=total, where=total >= _P)
        rest = (a + _P - b) * twiddle % _P
        y = np.concatenate([total, rest], axis=2)  # even outputs' part first, then odd ones'
        step = step * step % PRIME
        size = half
    out = y.reshape(rows, n)
    return out * np.uint64(pow(n, PRIME - 2, PRIME)) % _P if inverse else out


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and offset of every place in its window where a block may occur: the squared differences sum up to 0 there.

    Rows of `blocks` and `windows` are residues; equal ones are found always, others hardly ever.
    """
    m, w = blocks.shape[1], windows.shape[1]
    n = 1 << (w - 1).bit_length()
    per = max(1, TRANSFORM_CELLS // n)
    rows, offsets = [], []
    for i in range(0, len(blocks), per):
        b, t = blocks[i : i + per], windows[i : i + per]
        padded = np.zeros((2 * len(b), n), np.uint64)
        padded[: len(b), :m] = b[:, ::-1]
        padded[len(b) :, :w] = t
        spectra = transform(padded)
        products = transform(spectra[: len(b)] * spectra[len(b) :] % _P, inverse=True)[:, m - 1 : w]
        squares = np.concatenate([np.zeros((len(t), 1), np.uint64), np.cumsum(t * t % _P, axis=1)], axis=1)
        window = (squares[:, m:] - squares[:, :-m]) % _P
        own = (b * b % _P).sum(axis=1) % _P
        found = np.nonzero((own[:, None] + window + 2 * (_P - products)) % _P == 0)
        rows.append(found[0] + i)
        offsets.append(found[1])
    return np.concatenate(rows), np.concatenate(offsets)


class _Prefixes:
    """Sums that tell whether two stretches of words are equal; a wrong yes is possible, a wrong no is not."""

    def __init__(self, residues: np.ndarray):
        self.power = _powers(1_000_003, len(residues) + 1)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(residues * self.power[:-1] % _P) % _P])

    def same(self, i: np.ndarray, d: np.ndarray, size: np.ndarray) -> np.ndarray:
        here = self.sums[i + size] + _P - self.sums[i]
        there = self.sums[i + d + size] + _P - self.sums[i + d]
        return here % _P * self.power[d] % _P == there % _P

    def forward(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How many words from i on are equal to those d later."""
        return self._most(len(self.sums) - 1 - i - d, lambda size: self.same(i, d, size))

    def backward(self, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How many words before i are equal to those d later."""
        return self._most(i, lambda size: self.same(i - size, d, size))

    @staticmethod
    def _most(limit: np.ndarray, fits: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros_like(limit), limit
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = fits(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal stretches of true values that are long enough."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= least
    return begins[long], ends[long]


def _recurs(codes: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether the same code is at a distance from low to high behind each place."""
    n = len(codes)
    base = codes * (n + 1)
    keys = np.append(np.sort(base + np.arange(n)), np.iinfo(np.int64).max)
    next_one = keys[np.searchsorted(keys, base + np.minimum(np.arange(n) + low, n))]
    return next_one <= base + np.minimum(np.arange(n) + high, n - 1)


def find_runs(codes: np.ndarray, sizes: np.ndarray, least: int = LEAST_WORDS, first_block: int = FIRST_BLOCK) -> Runs:
    """All runs in texts of non-negative codes that lie one after another, the longest text first.

    Each text's size counts a code at its end that occurs nowhere else, so no run goes from one text to the next.
    """
    ends = np.cumsum(sizes)
    runs: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period

    def reach(period: int) -> np.ndarray:
        """The leading texts, those that are long enough for a run of this period."""
        texts = int((sizes > 2 * period).sum())
        return codes[: ends[texts - 1]] if texts else codes[:0]

    for q in range(1, 2 * first_block - 1):
        x = reach(q)
        for a, b in zip(*_stretches(x[:-q] == x[q:], max(least - q, q)), strict=True):
            runs.setdefault((a, b + q), q)  # a run of a smaller period may be there already
    m, residues, prefixes = first_block, None, None
    while len(x := reach(2 * m - 1)):
        low, high = 2 * m - 1, 4 * m - 2
        starts = np.arange(0, len(x) - m - low + 1, m)
        starts = starts[_recurs(x, low, high)[: len(starts) * m].reshape(-1, m).all(axis=1)]
        known = sorted((a, b, q) for (a, b), q in runs.items() if b - a >= m + low)
        inner = np.zeros(len(starts), bool)
        for a, b, q in known:
            if q <= m:
                inner[np.searchsorted(starts, a) : np.searchsorted(starts, b - m - high, "right")] = True
        starts = starts[~inner]
        if len(starts) and residues is None:
            residues = (np.arange(1, int(codes.max()) + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(34))[codes] % _P
            prefixes = _Prefixes(residues)
            residues = np.concatenate([residues, np.zeros(3 * len(x), np.uint64)])  # windows may go on behind the last text
        per = max(1, TRANSFORM_CELLS // (4 * m))
        for i in range(0, len(starts), per):
            own = starts[i : i + per]
            row, offset = occurrences(residues[own[:, None] + np.arange(m)], residues[own[:, None] + low + np.arange(high - low + m)])
            _extend(codes, prefixes, own[row], offset + low, m, least, known, runs)
        m *= 2
    found = np.array(sorted((a, q, b - a) for (a, b), q in runs.items()), np.int64).reshape(-1, 3)
    return Runs(found[:, 0], found[:, 2], found[:, 1])


def _extend(codes: np.ndarray, prefixes: _Prefixes, at: np.ndarray, d: np.ndarray, m: int, least: int, known: list[tuple[int, int, int]], runs: dict[tuple[int, int], int]) -> None:
    """Adds the runs that grow from blocks `at` (ascending) which seem to recur d later."""
    n = len(codes)
    fits = at + d + m <= n
    at, d = at[fits], d[fits]
    new = np.ones(len(at), bool)
    for a, b, q in known:  # a multiple of a run's period within the run extends to the run itself
        own = slice(np.searchsorted(at, a), np.searchsorted(at, b))
        new[own] &= (d[own] % q != 0) | (at[own] + d[own] + m > b)
    at, d = at[new], d[new]
    right = m + prefixes.forward(at + m, d)
    left = prefixes.backward(at, d)
    good = (left + right >= d) & (left + right + d >= least)
    grown = np.unique(np.stack([d, at - left, at + right], axis=1)[good], axis=0)
    for q, a, b in grown.tolist():
        for x, y in zip(*_stretches(codes[a:b] == codes[a + q : b + q], max(q, least - q)), strict=True):
            x, y = a + x, a + y  # words are compared here: the sums decide nothing alone
            if (x == 0 or codes[x - 1] != codes[x + q - 1]) and (y + q == n or codes[y] != codes[y + q]):
                runs.setdefault((x, y + q), q)


def collapse(words: list[str], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[str]:
    """The words that no run contains after its first period."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _runs_of(texts: list[list[str]], least: int, first_block: int) -> list[Runs]:
    """Each text's runs, with places counted from its first word."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    flat: list[str] = []
    for i in order:
        flat += texts[i]
    sizes = np.array([len(texts[i]) + 1 for i in order], np.int64)
    ends = np.cumsum(sizes)
    codes = np.zeros(int(ends[-1]), np.int64)
    inside = np.ones(len(codes), bool)
    inside[ends - 1] = False
    codes[inside], distinct = pd.factorize(np.array(flat, object))
    codes[ends - 1] = len(distinct) + np.arange(len(sizes))
    runs = find_runs(codes, sizes, least, first_block)
    bounds = np.searchsorted(runs.start, [0, *ends.tolist()])
    out: list[Runs] = [None] * len(texts)
    for k, i in enumerate(order):
        own = slice(bounds[k], bounds[k + 1])
        out[i] = Runs(runs.start[own] - (ends[k] - sizes[k]), runs.length[own], runs.period[own])
    return out


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, first_block: int = FIRST_BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_words, runs (array of start, length, period, in this order) and collapsed (kept words joined by spaces) of every text."""
    kind = docs.schema[id_col].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: pa.Array, texts: list[list[str]]) -> pa.RecordBatch:
            found = _runs_of(texts, least, first_block)
            lists = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in zip(f.start.tolist(), f.length.tolist(), f.period.tolist(), strict=True)] for f in found]
            kept = [" ".join(collapse(w, f.start, f.length, f.period) if len(f.start) else w) for w, f in zip(texts, found, strict=True)]
            columns = [ids, pa.array(list(map(len, texts)), pa.int64()), pa.array(lists, pa.list_(run)), pa.array(kept, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "runs", "collapsed"])

        for batch in batches:
            names, texts, held, begin = batch.column("id"), [], 0, 0
            for i, text in enumerate(batch.column("text")):
                words = WORD.findall(text.as_py())
                if texts and held + len(words) > STEP_WORDS:
                    yield done(names.slice(begin, len(texts)), texts)
                    texts, held, begin = [], 0, i
                texts.append(words)
                held += len(words)
            if texts:
                yield done(names.slice(begin, len(texts)), texts)

    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return id_and_text(docs, id_col, text_col).mapInArrow(find, schema)
