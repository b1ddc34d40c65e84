"""Documents in chunks of bounded size, and questions about keys asked between chunks in packed form.

A chunk is one row: the ids of some documents, their words as codes, and the distinct words. Chunks are made where the
documents lie, written once, and identified by task and number. To learn which of its keys occur elsewhere, a chunk sends
each shard (a range of the hashed keys) one row of sorted, packed keys; a shard answers each chunk with one packed array in
the same order. Rows are few and of bounded size, and a key held by a third of all documents is sent once by each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.common import id_and_text, stored

CHUNK_WORDS = 500_000
KEYS_PER_SHARD = 1 << 21
LEAST_SHARDS = 64
#: Stands for a null id in the arrays of a chunk: sorts first.
NO_ID = np.iinfo(np.int64).min

CHUNK_SCHEMA = "chunk long, n_words long, ids binary, sizes binary, words binary, codes binary"


def squeeze(array: np.ndarray) -> bytes:
    """An array of non-negative integers as bytes: byte planes, as many as the largest needs, compressed."""
    wide = array.astype("<u8")
    planes = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    data = np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()
    return np.array([len(array), planes], "<u8").tobytes() + pa.compress(data, "zstd", asbytes=True)


def expand(data: bytes) -> np.ndarray:
    n, planes = (int(x) for x in np.frombuffer(data[:16], "<u8"))
    raw = np.frombuffer(pa.decompress(data[16:], n * planes, "zstd", asbytes=True), np.uint8).reshape(planes, n)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :planes] = raw.T
    return wide.view("<u8").ravel()


class Chunk:
    """Documents in ascending order of ids, their words one after another."""

    def __init__(self, row: pd.Series):
        self.ids = np.frombuffer(row.ids, "<i8")
        self.sizes = expand(row.sizes).astype(np.int64)
        self.raw = row.words.split(b"\n") if row.words else []  # the distinct words, in UTF-8
        self.codes = expand(row.codes).astype(np.int64)
        self.ends = np.cumsum(self.sizes)

    @property
    def words(self) -> list[str]:
        return [w.decode() for w in self.raw]

    @property
    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of each distinct word."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.raw), np.uint64, len(self.raw))

    @property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word in its place."""
        return self.word_hashes[self.codes] if self.raw else np.zeros(0, np.uint64)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), self.sizes)

    def shown_ids(self) -> pd.Series:
        return pd.Series(self.ids).astype("Int64").mask(self.ids == NO_ID)


def make_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lower: bool = False, describe: Callable[[list[bytes]], bytes] | None = None) -> DataFrame:
    """All documents with their words, stored. Ids are integers; null is kept. `lower` folds A-Z first.

    `describe` makes a column `described` from the distinct words of a chunk, which are in UTF-8.
    """
    rows = id_and_text(docs, id_col, text_col)
    if rows.schema["id"].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError("ids must be integers")
    rows = rows.select(F.coalesce(F.col("id").cast("long"), F.lit(int(NO_ID))).alias("id"), "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, lists, held = [], [], 0

        def close() -> pa.RecordBatch:
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            flat = [w for i in order for w in lists[i]]
            codes, words = pd.factorize(np.array(flat, object)) if flat else (np.zeros(0, np.int64), [])
            row = {
                "chunk": number,
                "n_words": len(flat),
                "ids": np.array(ids, "<i8")[order].tobytes(),
                "sizes": squeeze(np.array([len(lists[i]) for i in order], np.int64)),
                "words": b"\n".join(words),
                "codes": squeeze(codes),
            }
            if describe:
                row["described"] = describe(list(words))
            return pa.RecordBatch.from_pandas(pd.DataFrame([row]), preserve_index=False)

        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                data = text.as_buffer().to_pybytes()
                words = (data.lower() if lower else data).split()  # of bytes: A-Z only, and just the gaps between `WORD`s
                ids.append(name)
                lists.append(words)
                held += len(words) + 10
                if held >= CHUNK_WORDS:
                    yield close()
                    number, ids, lists, held = number + 1, [], [], 0
        if ids:
            yield close()

    return stored(rows.mapInArrow(build, CHUNK_SCHEMA + (", described binary" if describe else "")), "chunks")


def shard_bits(total_keys: int) -> int:
    """log2 of the number of shards that keeps a shard's keys bounded."""
    return max(LEAST_SHARDS.bit_length() - 1, (max(1, total_keys) // KEYS_PER_SHARD).bit_length())


def split_by_shard(keys: np.ndarray, bits: int) -> list[slice]:
    """Places of each shard's keys in a sorted array of 64-bit keys."""
    bounds = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    edges = [0, *bounds.tolist(), len(keys)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return squeeze(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data), dtype=np.uint64)


def answer(requests: DataFrame, reply: Callable[[list[np.ndarray], pd.DataFrame], list[bytes]]) -> DataFrame:
    """Each shard's answers, stored: `reply` gets every chunk's keys and the shard's rows, and gives one answer for each.

    `requests` has shard, chunk, keys (packed) and extra (binary); the result has chunk, shard and answer.
    """

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk", ignore_index=True)
        replies = reply([unpack_keys(k) for k in rows["keys"]], rows)
        return pd.DataFrame({"chunk": rows["chunk"], "shard": rows["shard"], "answer": replies})

    return stored(requests.groupBy("shard").applyInPandas(meet, "chunk long, shard int, answer binary"), "answers")


def with_answers(chunks: DataFrame, answers: DataFrame, apply: Callable[[pd.Series, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """`apply` on each chunk's row and its answers in order of shards."""

    def meet(chunk: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        return apply(chunk.iloc[0], own.sort_values("shard", ignore_index=True))

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(meet, schema)
