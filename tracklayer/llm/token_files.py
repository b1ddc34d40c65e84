"""Token files: ids under one canonical, length-limited Huffman code, in blocks that decode independently.

1. Documents are range-partitioned and sorted by id, and encoded once. Text is looked up in chunks (a word with its leading
   space, other characters between white space, or white space; the pre-tokeniser never joins across them). Chunks not seen
   lately go to the tokeniser, a plain word straight to its merges, so the result is that of the whole text. The ids are stored in the shared folder.
2. The ids' counts over all documents, at most one for each vocabulary entry, give the code lengths (package-merge, so no
   code is longer than `max_bits`), and the lengths alone give the canonical code.
3. Each task writes files of bounded size: blocks of packed codes, and behind them the code lengths, the document table,
   the block offsets and the bit offset of every 128th token. Names are random; the table of files is committed by Spark,
   so files of lost or repeated tasks are never read.
4. Reading decodes all stretches between checkpoints side by side: one table lookup by the next `max_bits` bits gives the
   id and the length of a code.

Defined results: null and empty texts have only the end id; null ids sort first; documents with equal ids are ordered by a
hash of their text. An empty table gives no file. Other columns of the input are ignored.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklayer.llm.bpe import byte_characters
from tracklayer.llm.common import file_system, id_and_text, stored
from tracklayer.session import work_path

MAX_BITS = 18
BLOCK_TOKENS = 1 << 16
CHECKPOINT = 128
FILE_TOKENS = 2_000_000
MOST_TASKS = 4096
REMEMBERED = 800_000
MAGIC = b"TOKHUF01"
#: What the pre-tokeniser takes for white space.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Latin letters, each of which the pre-tokeniser takes for a letter.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = f" ?[{_LETTER}]+"
_CHUNK = re.compile(f"{_WORD}(?=[\\x00-@\\[-`{{-\\x7f]|\\Z)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class _Known(dict):
    """Packed ids of chunks; a chunk not seen yet is encoded."""

    def __init__(self, tokenizer, kind: np.dtype):
        super().__init__()
        self.tokenizer, self.model, self.code = tokenizer, tokenizer.model, {2: "H", 4: "I"}[kind.itemsize]
        self.is_word = re.compile(_WORD).fullmatch
        self.characters = {b: ord(c) for b, c in enumerate(byte_characters())}

    def __missing__(self, chunk: str) -> bytes:
        if self.is_word(chunk):  # one pre-token by itself
            ids = [t.id for t in self.model.tokenize(chunk.encode().decode("latin-1").translate(self.characters))]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        packed = array.array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        found = self[chunk] = packed.tobytes()
        return found


class TextEncoder:
    """Ids of whole texts, packed little-endian."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.tokenizer = tokenizer
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = _Known(tokenizer, self.kind)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            if any(t in text for t in self.added):  # the tokenizer takes them out before it cuts the rest
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
                continue
            yield b"".join(map(self.known.__getitem__, _CHUNK.findall(text)))


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed ids of each document in ascending order of ids: part and seq tell the place, width the bytes of one id."""
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                own = batch.slice(start, 500)
                n = own.num_rows
                ids = [x + end for x in encoder.encode(own.column("text").to_pylist())]
                places = [pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()), pa.array([encoder.kind.itemsize] * n, pa.int32())]
                yield pa.RecordBatch.from_arrays([own.column("id"), *places, pa.array(ids, pa.binary())], names=["id", "part", "seq", "width", "ids"])
                seq += n

    return stored(rows.select("id", "text").mapInArrow(encode, f"id {kind}, part int, seq long, width int, ids binary"), "token-ids")


def _unpack(ids: bytes, width: int) -> np.ndarray:
    return np.frombuffer(ids, f"<u{width}")


def count_ids(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; one number for each id, so at most a vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, width in zip(batch.column("ids"), batch.column("width").to_pylist(), strict=True):
                own = np.bincount(_unpack(ids.as_buffer(), width))
                if len(own) > len(total):
                    own, total = total, own.astype(np.int64)
                total[: len(own)] += own
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["token", "n"])

    rows = encoded.select("ids", "width").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.token for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r.token] = r.n
    return counts


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code among those without a longer code than `max_bits` (0: the id does not occur)."""
    symbols = np.flatnonzero(counts)
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    lengths, n = np.zeros(len(counts), np.uint8), len(symbols)
    if n <= 2:
        lengths[symbols] = 1
        return lengths
    max_bits = max(max_bits, int(n - 1).bit_length())
    weights = counts[symbols].astype(np.int64)
    packages, leaves = np.zeros(0, np.int64), []
    for _ in range(max_bits):  # from the deepest level up: leaves and pairs of the level below, by weight
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        leaves.append(order < n)
        both = both[order]
        even = len(both) // 2 * 2
        packages = both[0:even:2] + both[1:even:2]
    taken = 2 * n - 2
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:taken].sum())
        lengths[symbols[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length and then id."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    for size in range(1, int(lengths.max(initial=0)) + 1):
        own = np.flatnonzero(lengths == size)
        code <<= size - last
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code, last = code + len(own), size
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """One block's bits, and the bit offset of every checkpoint in it."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    at = ends - sizes
    shifted = codes[ids] << (64 - (at & 31) - sizes).astype(np.uint64)
    word = at >> 5
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(word[-1] + 2, np.uint64)
    out[word[starts]] += np.add.reduceat(shifted >> np.uint64(32), starts)
    out[word[starts] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), starts)
    return out.astype(">u4").tobytes()[: -(-int(ends[-1]) // 8)], at[::CHECKPOINT]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for each value of the next bits."""
    bits = int(lengths.max(initial=1))
    present = np.flatnonzero(lengths)
    present = present[np.argsort(lengths[present], kind="stable")]
    repeats = 1 << (bits - lengths[present].astype(np.int64))
    ids = np.zeros(1 << bits, np.uint32)
    sizes = np.ones(1 << bits, np.uint8)
    ids[: repeats.sum()] = np.repeat(present, repeats)
    sizes[: repeats.sum()] = np.repeat(lengths[present], repeats)
    return ids, sizes, bits


def unpack(data: bytes, offsets: np.ndarray, n_tokens: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The ids of stretches of CHECKPOINT tokens (the last of a block may be shorter) from their bit offsets, side by side.

    `n_tokens` counts with every stretch full; what a short stretch yields beyond its end is cut off by the caller.
    """
    ids, sizes, bits = table
    raw = np.frombuffer(data + bytes(8 + CHECKPOINT * 4), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.empty((len(offsets), CHECKPOINT), np.uint32)
    at, limit = offsets.astype(np.int64), len(window) - 1
    for k in range(CHECKPOINT):
        byte = np.minimum(at >> 3, limit)
        value = (window[byte] << (at & 7).astype(np.uint32)) >> np.uint32(32 - bits)
        out[:, k] = ids[value]
        at = at + sizes[value]
    return out.ravel()[:n_tokens]


def write_file(stream: pa.NativeFile, names: list, ids: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> int:
    """One token file; returns its size."""
    tokens = np.concatenate(ids)
    blocks, marks = [], []
    for start in range(0, len(tokens), BLOCK_TOKENS):
        data, at = pack(tokens[start : start + BLOCK_TOKENS], lengths, codes)
        blocks.append(data)
        marks.append(at.astype("<u4"))
    parts = [
        json.dumps({"tokens": len(tokens), "block_tokens": BLOCK_TOKENS, "checkpoint": CHECKPOINT, "docs": names, "blocks": [len(b) for b in blocks]}, default=str).encode(),
        lengths.tobytes(),
        np.array([len(x) for x in ids], "<u8").tobytes(),
        np.diff(np.concatenate(marks).astype(np.int64), prepend=0).astype("<i4").tobytes(),
    ]
    packed = [zlib.compress(p, 1) for p in parts]
    footer = b"".join(packed) + struct.pack("<4Q", *map(len, packed)) + MAGIC
    for data in [MAGIC, *blocks, footer]:
        stream.write(data)
    return len(MAGIC) + sum(map(len, blocks)) + len(footer)


def read_file(file: pa.NativeFile) -> tuple[list, list[np.ndarray]]:
    """Names and ids of the documents of one file."""
    size = file.size()
    file.seek(size - 40)
    tail = file.read(40)
    if tail[32:] != MAGIC:
        raise ValueError("not a token file, or cut short")
    lens = struct.unpack("<4Q", tail[:32])
    file.seek(size - 40 - sum(lens))
    head, lengths, sizes, marks = (zlib.decompress(file.read(n)) for n in lens)
    head = json.loads(head)
    marks = np.cumsum(np.frombuffer(marks, "<i4"), dtype=np.int64)
    block_bytes = np.array(head["blocks"], np.int64)
    per_block = head["block_tokens"] // head["checkpoint"]
    base = np.repeat((np.cumsum(block_bytes) - block_bytes) * 8, per_block)[: len(marks)]
    file.seek(len(MAGIC))
    tokens = unpack(file.read(int(block_bytes.sum())), marks + base, head["tokens"], decode_table(np.frombuffer(lengths, np.uint8)))
    return head["docs"], np.split(tokens, np.cumsum(np.frombuffer(sizes, "<u8").astype(np.int64))[:-1])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, folder: str | None = None) -> DataFrame:
    """Token files of all documents in ascending order of ids.

    Returns one row for each file: path, start (ids in the files before it), docs, tokens, bytes.
    """
    folder = folder or work_path(docs.sparkSession, "tokens")
    encoded = encode_documents(docs, tokenizer, end_id, id_col, text_col)
    lengths = code_lengths(count_ids(encoded), max_bits)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        codes, done = canonical_codes(lengths), []
        place, names, ids, held, after = None, [], [], 0, None

        def close() -> None:
            if ids:
                name = f"{uuid.uuid4().hex}.tok"
                with fs.open_output_stream(f"{root}/{name}", compression=None) as stream:
                    done.append((name, *place, len(ids), held, write_file(stream, names, ids, lengths, codes)))

        for batch in batches:
            for name, part, seq, width, packed in zip(*(batch.column(i) for i in range(5)), strict=True):
                part, seq = part.as_py(), seq.as_py()
                if held >= FILE_TOKENS or (part, seq) != after:
                    close()
                    place, names, ids, held = (part, seq), [], [], 0
                own = _unpack(packed.as_buffer(), width.as_py())
                names.append(name.as_py())
                ids.append(own)
                held, after = held + len(own), (part, seq + 1)
        close()
        columns = list(zip(*done, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), *[pa.int64()] * 5], strict=True)], names=["name", "part", "seq", "docs", "tokens", "bytes"])

    files = encoded.select("id", "part", "seq", "width", "ids").mapInArrow(write, "name string, part long, seq long, docs long, tokens long, bytes long")
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = stored(files, "token-files")  # one row for each file; the window over all files is over these rows only
    return files.select(F.concat(F.lit(folder + "/"), "name").alias("path"), before.alias("start"), "docs", "tokens", "bytes")


def read_tokens(files: DataFrame, id_col: str = "doc_id", id_type: str = "long") -> DataFrame:
    """Documents of the files: id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, name = file_system(path)
                with fs.open_input_file(name) as file:
                    names, ids = read_file(file)
                for i in range(0, len(names), 1000):
                    own = ids[i : i + 1000]
                    sizes = np.array([len(x) for x in own], np.int64)
                    starts = start + np.cumsum(sizes) - sizes
                    start += int(sizes.sum())
                    shown = [None if n is None else str(n) for n in names[i : i + 1000]]
                    arrays = [pa.array(shown, pa.string()), pa.array(starts), pa.array(sizes), pa.array([x.astype("<u4").tobytes() for x in own], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "start", "n_tokens", "ids"])

    tasks = max(1, min(files.count(), MOST_TASKS))
    rows = files.select("path", "start").repartition(tasks).mapInArrow(read, "id string, start long, n_tokens long, ids binary")
    return rows.select(F.col("id").cast(id_type).alias(id_col), "start", "n_tokens", "ids")
