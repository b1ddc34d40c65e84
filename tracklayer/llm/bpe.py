"""Byte-level BPE through a sentencepiece model that is serialised directly from a rank vocabulary.

Every byte is mapped to one printable character, so a token is a piece of such characters and its id is its rank. Pieces
are scored by their negative rank: sentencepiece merges the best-scored neighbours first, which is the lowest rank first.
The normaliser is the identity, so nothing of a text is changed or escaped. A pre-token that is a piece itself is that
piece; all others are encoded by the model. Decoding maps ids back to pieces and pieces back to bytes.

Text is encoded where it lies: no shuffle. The model file's bytes (about a megabyte, fixed by the vocabulary) go with the
task; encoded pre-tokens are remembered up to a bound and then forgotten, which changes no result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tracklayer.llm.common import id_and_text

REMEMBERED = 200_000
STEP_DOCS = 500


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else the next one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes, a space and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    to_char = byte_characters()
    model = model_pb2.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece="".join(to_char[b] for b in token), score=-float(rank), type=model_pb2.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=-float(len(ranks)), type=model_pb2.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type = model_pb2.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(ranks), -1, -1, -1
    spec.hard_vocab_limit = False
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes within one task."""

    def __init__(self, model: bytes, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        chars = byte_characters()
        self.to_chars = {b: ord(c) for b, c in enumerate(chars)}
        to_byte = {ord(c): b for b, c in enumerate(chars)}
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size() - 1)]
        self.token_bytes = [name.translate(to_byte).encode("latin-1") for name in names]
        self.whole = {name: i for i, name in enumerate(names)}
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, pretokens: list[str]) -> None:
        mapped = [p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.to_chars) for p in pretokens]
        hard = [m for m in mapped if m not in self.whole]
        ids = iter(self.pieces.encode(hard, num_threads=1)) if hard else iter(())
        for p, m in zip(pretokens, mapped, strict=True):
            whole = self.whole.get(m)
            self.known[p] = (whole,) if whole is not None else tuple(next(ids))

    def encode(self, text: str) -> list[int]:
        pretokens = self.find(text)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if new := set(pretokens).difference(self.known):
            self._learn(list(new))
        return list(itertools.chain.from_iterable(map(self.known.__getitem__, pretokens)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


def encode_texts(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    row: Callable[[int, list[int], bytes], tuple] | None = None,
    schema: str = "ids array<int>, decoded string",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each document's ids, and its text decoded from them again.

    `row(ids, decoded)` makes the columns of `schema`; by default the ids and the decoded text. A null or empty text has
    no ids. Rows are kept one for one, repeats and null ids too. Other columns are left out.
    """
    model = serialise_model(ranks)
    make = row or (lambda ids, decoded: (ids, decoded.decode("utf-8", "replace")))
    kind = docs.schema[id_col].dataType.simpleString()
    types = to_arrow_schema(StructType.fromDDL(schema))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, STEP_DOCS):
                batch = whole.slice(start, STEP_DOCS)
                columns = [[] for _ in types]
                for text in batch.column("text"):
                    ids = codec.encode(text.as_py())
                    for column, value in zip(columns, make(ids, codec.decode(ids)), strict=True):
                        column.append(value)
                made = [pa.array(c, t.type) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *made], names=[id_col, *types.names])

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, f"`{id_col}` {kind}, {schema}")


@functools.cache
def _decimals(size: int) -> list[str]:
    return [str(i) for i in range(size)]


def digests(ids: list[int], decoded: bytes) -> tuple[int, str, str]:
    """Count of ids, SHA-256 of the ids in decimal joined by commas, SHA-256 of the decoded bytes."""
    decimals = _decimals(1 << 17)
    joined = ",".join(map(decimals.__getitem__, ids))
    return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()
