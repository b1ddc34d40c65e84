"""Fill-in-middle transformation with a sparse exception index between code points and UTF-8 bytes.

A text stays the bytes it arrives as. The index of a batch of texts records the multibyte characters alone: the code-point
position of each and how many bytes it has beyond one. Between two of them every character is one byte, so a code-point cut
is its number plus the excess of the multibyte characters before it, found by `searchsorted`; a byte cut goes back the same
way. Pure ASCII texts have an empty index. Cuts, spans and outputs are then byte slices, and no text is decoded.

Each document's numbers h1 to h4 come from a digest of its id. The texts are cut where they lie: no shuffle, memory bounded
by a step of texts. Restoring needs the output and the form alone and is a native expression.

Defined results: null and empty texts are plain with n 0; texts that hold one of the marks are plain; a null id is digested
as the empty string; repeated rows give equal results, one for one; ties of the two cuts make an empty middle. Empty tables
give none. Bytes that are not UTF-8 may be cut anywhere and are restored as they were. Other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.common import id_and_text

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 documents: transformed ones, and those of them in the order suffix, prefix, middle.
TRANSFORMED, SUFFIX_FIRST = 90, 20
STEP_DOCS = 500


class ExceptionIndex:
    """Code-point and byte positions of texts that lie one after another in one array of UTF-8 bytes."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        at = np.flatnonzero(data >= 0xC0)  # first bytes of multibyte characters
        lead = data[at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.begins, self.sizes = begins, ends - begins
        self.total = np.concatenate([[0], np.cumsum(extra)])  # excess bytes before each exception
        self.points = at - self.total[:-1]  # code-point position of each exception, counted through all texts
        self.after = at + 1 + extra  # byte behind each exception
        self.first = np.searchsorted(at, begins)  # each text's first exception
        self.lengths = np.maximum(0, self.sizes - (self.total[np.searchsorted(at, ends)] - self.total[self.first]))

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """A code-point cut of each text, as bytes from the text's begin."""
        here = self.total[self.first]
        return np.minimum(self.sizes, points + self.total[np.searchsorted(self.points, self.begins - here + points)] - here)

    def to_points(self, cuts: np.ndarray) -> np.ndarray:
        """A byte cut of each text, as code points; a cut within a character counts the characters that end before it."""
        whole = np.searchsorted(self.after, self.begins + cuts, "right")  # exceptions that end by the cut
        lead = np.append(self.after - 1 - np.diff(self.total), np.iinfo(np.int64).max)[whole]  # first byte of the next one
        upto = np.minimum(lead, self.begins + cuts)
        return upto - self.total[whole] - (self.begins - self.total[self.first])


def numbers(seed: str, name: object) -> tuple[int, int, int, int]:
    """h1 to h4: the first four groups of eight hexadecimal digits of the digest of seed, colon and id."""
    digest = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def fill_in_middle(
    docs: DataFrame,
    seed: str = "1",
    unit: str = "characters",
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """n (code points), form, prefix_chars, middle_chars, prefix_bytes, middle_bytes and output of every document.

    With unit `bytes` the cuts are drawn over bytes and moved back to the begin of the character they fall in.
    """
    if unit not in ("characters", "bytes"):
        raise ValueError("unit is characters or bytes")
    kind = docs.schema[id_col].dataType.simpleString()
    spans = ["prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes"]
    names = [id_col, "n", "form", *spans, "output"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP_DOCS):
                batch = whole.slice(start, STEP_DOCS)
                texts = [t.as_buffer() for t in batch.column("text").cast(pa.large_binary())]
                sizes = np.array([len(t) for t in texts], np.int64)
                ends = np.cumsum(sizes)
                data = b"".join(texts)
                index = ExceptionIndex(np.frombuffer(data, np.uint8), ends - sizes, ends)
                h = np.array([numbers(seed, i) for i in batch.column("id").to_pylist()], np.int64).reshape(-1, 4)
                limit = index.lengths if unit == "characters" else index.sizes
                drawn = np.sort(h[:, :2] % (limit + 1)[:, None], axis=1)
                points = drawn.T if unit == "characters" else np.array([index.to_points(c) for c in drawn.T])
                cuts = np.array([index.to_bytes(p) for p in points])
                held = np.zeros(len(sizes), bool)
                for mark in (PREFIX, SUFFIX, MIDDLE):
                    if mark in data:
                        held |= [mark in bytes(t) for t in texts]
                plain = (sizes == 0) | held | (h[:, 2] % 100 >= transformed)
                last = ~plain & (h[:, 3] % 100 < suffix_first)
                outputs = []
                for begin, end, a, b, as_is, spm in zip((ends - sizes).tolist(), ends.tolist(), *cuts.tolist(), plain.tolist(), last.tolist(), strict=True):
                    prefix, middle, suffix = data[begin : begin + a], data[begin + a : begin + b], data[begin + b : end]
                    if as_is:
                        outputs.append(data[begin:end])
                    elif spm:
                        outputs.append(b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)))
                    else:
                        outputs.append(b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
                values = [points[0], points[1] - points[0], cuts[0], cuts[1] - cuts[0]]
                form = np.where(plain, "plain", np.where(last, "spm", "psm"))
                columns = [batch.column("id"), pa.array(index.lengths), pa.array(form.tolist(), pa.string())]
                columns += [pa.array(v, pa.int64(), mask=plain) for v in values]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(outputs, pa.binary()).view(pa.string())], names=names)

    schema = f"`{id_col}` {kind}, n long, form string, {', '.join(f'{s} long' for s in spans)}, output string"
    return id_and_text(docs, id_col, text_col).mapInArrow(cut, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output of this form was made from."""
    parts = F.split(output, "<[PSM]>", -1)  # neither a text nor a cut can make up another mark
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", psm).otherwise(spm)
