"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

A line is described by a few plain measures; the field adds weights for neighbouring lines having equal or different marks.
It is fitted in numpy, by gradient steps on the exact likelihood (forward-backward), to a bounded sample of labelled
documents whose lines carry the label of their document. Viterbi decoding then marks the lines of every whole text, and
the share of words in content lines decides whether the document stays. Fixed rules go first: too few words, or too many
words in repeated 3-word windows.

Only the weights (a few hundred bytes) go with the tasks; texts are judged where they lie, without a shuffle.

Defined results: null, empty and blank texts have no words, so the rules reject them. Lines without a word get no mark.
Without labelled documents of both kinds there is no field, every line counts as content and the rules alone decide.
Repeated rows are judged alike. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.common import WORD, id_and_text

#: Labelled documents of each kind that the field is fitted to, at most; longer texts are fitted in pieces of so many lines.
SAMPLE_PER_LABEL = 1000
PIECE_LINES = 64
KEPT_SHARE = 0.5
LEAST_WORDS = 50
SYMBOLS = "#*$%&|<>"
N_FEATURES = 13


@dataclass
class Measures:
    """The fixed counts of one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > 50 * self.n_words


def repeated_words(words: list[str]) -> int:
    """Words covered by a 3-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(text: str) -> tuple[Measures, np.ndarray, list[int]]:
    """A text's counts, its lines' features, and the number of words in each of these lines."""
    all_words: list[str] = []
    rows, sizes, seen, dup = [], [], set(), 0
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            continue
        all_words += words
        n = len(words)
        again = line in seen
        seen.add(line)
        dup += again
        chars = sum(map(len, words))
        symbols = sum(map(line.count, SYMBOLS))
        last, first = words[-1][-1], words[0][0]
        rows.append((
            1.0,
            sum(map(str.isupper, words)) / n,
            min(1.0, line.count("!") / n),
            min(1.0, symbols / n),
            float(n <= 3),
            float(again),
            float(last in ".!?:;\"')”»…"),
            sum(map(str.isdigit, words)) / n,
            np.log1p(n) / 5,
            min(3.0, chars / n / 10),
            1 - len(set(words)) / n,
            float(first.islower()),
            min(1.0, line.count("://") / n * 5),
        ))
        sizes.append(n)
    counts = Measures(len(all_words), sum(map(len, all_words)), sum(map(text.count, SYMBOLS)), dup, repeated_words(all_words))
    return counts, np.array(rows, float).reshape(-1, N_FEATURES), sizes


@dataclass
class LineField:
    """Weights: emission[state, feature], transition[from, to], start[state]; state 1 is content."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def decode(self, features: np.ndarray) -> list[int]:
        """Viterbi: the best sequence of marks; of equal ones that with content first."""
        if not len(features):
            return []
        scores = (features @ self.emission.T).tolist()
        (t00, t01), (t10, t11) = self.transition.tolist()
        a, b = (s + e for s, e in zip(self.start.tolist(), scores[0], strict=True))
        back = []
        for e0, e1 in scores[1:]:
            to0, to1 = b + t10 >= a + t00, b + t11 >= a + t01
            back.append((int(to0), int(to1)))
            a, b = (b + t10 if to0 else a + t00) + e0, (b + t11 if to1 else a + t01) + e1
        marks = [int(b >= a)]
        for pair in reversed(back):
            marks.append(pair[marks[-1]])
        return marks[::-1]


def fit(sequences: list[tuple[np.ndarray, int]], steps: int = 100, rate: float = 0.1, penalty: float = 1e-3) -> LineField | None:
    """The field for lines' features and their document's label, by Adam on the mean log-likelihood of all pieces."""
    pieces = [(x[i : i + PIECE_LINES], y) for x, y in sequences for i in range(0, len(x), PIECE_LINES)]
    if len({y for _, y in pieces}) < 2:
        return None
    pieces.sort(key=lambda p: -len(p[0]))
    sizes = np.array([len(x) for x, _ in pieces])
    longest, n = sizes[0], len(pieces)
    active = [(sizes > t).sum() for t in range(longest)]  # pieces come longest first, so these are the leading ones
    x = np.zeros((n, longest, N_FEATURES))
    for i, (rows, _) in enumerate(pieces):
        x[i, : len(rows)] = rows
    y = np.array([label for _, label in pieces])
    weight = np.where(y == 1, 0.5 / max(1, sizes[y == 1].sum()), 0.5 / max(1, sizes[y == 0].sum()))  # either kind counts half
    on = np.arange(longest) < sizes[:, None]
    theta = np.zeros(2 * N_FEATURES + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emission, transition, start = theta[: 2 * N_FEATURES].reshape(2, -1), theta[-6:-2].reshape(2, 2), theta[-2:]
        score = x @ emission.T
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            k = active[t]
            alpha[:k, t] = np.logaddexp.reduce(alpha[:k, t - 1, :, None] + transition, axis=1) + score[:k, t]
        for t in range(longest - 2, -1, -1):
            k = active[t + 1]
            beta[:k, t] = np.logaddexp.reduce(transition + (score[:k, t + 1] + beta[:k, t + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(alpha[np.arange(n), sizes - 1], axis=1)
        p = np.where(on[:, :, None], np.exp(alpha + beta - total[:, None, None]), 0)
        pair = alpha[:, :-1, :, None] + transition + (score + beta)[:, 1:, None, :] - total[:, None, None, None]
        pair = np.where(on[:, 1:, None, None], np.exp(np.minimum(pair, 0)), 0)
        own = np.zeros_like(p)
        own[np.arange(n), :, y] = on
        grad_e = np.einsum("nts,ntf,n->sf", own - p, x, weight)
        seen = np.zeros_like(pair)
        seen[np.arange(n), :, y, y] = on[:, 1:]
        grad_t = np.einsum("ntij,n->ij", seen - pair, weight)
        grad_s = np.einsum("ns,n->s", own[:, 0] - p[:, 0], weight)
        grad = np.concatenate([grad_e.ravel(), grad_t.ravel(), grad_s]) - penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return LineField(theta[: 2 * N_FEATURES].reshape(2, -1), theta[-6:-2].reshape(2, 2), theta[-2:])


def fit_lines(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LineField | None:
    """Fits the field to at most `per_label` documents of each label, chosen by a hash of their id."""
    labels = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null").distinct()
    order = [F.xxhash64("id"), "id"]
    chosen = [labels.where(F.col("label") == k).orderBy(*order).limit(per_label) for k in (0, 1)]
    sample = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen[0].unionByName(chosen[1])), "id")  # 2 * per_label rows at most

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(text.as_py())[1] for text in batch.column("text")]
            packed = pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("label"), packed], names=["id", "label", "features"])

    found = sample.mapInArrow(features, "id string, label int, features binary").collect()
    found.sort(key=lambda r: (r.id, r.label, r.features))
    return fit([(np.frombuffer(r.features, "<f4").reshape(-1, N_FEATURES).astype(float), r.label) for r in found])


def mark_lines(docs: DataFrame, field: LineField | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text with its lines' marks: one character for each line that has a word, `c` content or `b` boilerplate."""
    return _judged(docs, field, id_col, text_col).select(id_col, "marks")


def judge_quality(docs: DataFrame, field: LineField | None, kept_share: float = KEPT_SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, share of words in content lines, and whether the document stays."""
    judged = _judged(docs, field, id_col, text_col)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= kept_share))


def keep_good(docs: DataFrame, field: LineField | None, kept_share: float = KEPT_SHARE, text_col: str = "text") -> DataFrame:
    """The rows of documents that stay, with all their columns: the verdict of `judge_quality`, without a join."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for text in batch.column(place):
                counts, share, _ = _verdict(text.as_py() or "", field)
                good.append(not counts.failed and share >= kept_share)
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def _verdict(text: str, field: LineField | None) -> tuple[Measures, float, list[int]]:
    counts, features, sizes = measure(text)
    marks = field.decode(features) if field else [1] * len(sizes)
    return counts, sum(n for n, mark in zip(sizes, marks, strict=True) if mark) / max(1, counts.n_words), marks


def _judged(docs: DataFrame, field: LineField | None, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = pa.schema([*((n, pa.int64()) for n in names), ("base_failed", pa.bool_()), ("content_share", pa.float64()), ("marks", pa.string())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                counts, share, marks = _verdict(text.as_py(), field)
                rows.append({n: getattr(counts, n) for n in names} | {"base_failed": counts.failed, "content_share": share, "marks": "".join("bc"[m] for m in marks)})
            made = pa.RecordBatch.from_pylist(rows, schema)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made.columns], names=[id_col, *schema.names])

    return id_and_text(docs, id_col, text_col).mapInArrow(judge, f"`{id_col}` {kind}, {', '.join(f'{n} long' for n in names)}, base_failed boolean, content_share double, marks string")
