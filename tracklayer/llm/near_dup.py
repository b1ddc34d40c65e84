"""Near-duplicates by ProbMinHash: signatures of weighted word shingles, bands, and exact verification.

Signature. Every distinct shingle of five words, weighted by its count, sends a Poisson process of arrivals whose rate is
the weight; each arrival hits one register at random, and a register keeps the shingle of its earliest arrival. A shingle
stops as soon as its next arrival comes after the latest of all registers. The share of equal registers of two documents
estimates their probability Jaccard similarity, which is never below their Jaccard similarity on sets.

Candidates. Documents with equal text are one node. Registers are cut in bands, and nodes with an equal band share a
bucket. In each round the nodes of every bucket that still holds several components face some of them, in the first round
the smallest node alone, in later ones a node of the smallest component and about 15, 255, ... others by a hash; those then
leave the bucket. A bucket is done when all its nodes are connected, so a bucket of copies takes one round and one pair at most
for each copy. Two nodes meet in the smallest of the buckets they share alone, so no pair is looked at twice. In the end every
two nodes that share a bucket were compared, were connected already, or cannot be (or hardly are) similar enough.

Parities first. A node carries PARITY_BITS bits: a shingle of odd count flips one. Two texts differ in no fewer shingles than
in bits, and a pair of the least similarity differs in (1 - similarity) / (1 + similarity) of its shingles at most, so a
pair with more unequal bits is dropped, surely rightly, before any text is joined. That tells texts of up to a thousand
shingles or so apart nearly as well as their words would; in longer ones most bits meet by chance.

Registers second. Four bits of each register travel with a node too, and a pair whose registers differ at many more places than
those of a pair of the least similarity do is dropped as well. Probability Jaccard is never below weighted
Jaccard, so the number of places that differ in a pair similar enough is at most binomial with chance (1 - similarity) * 15/16;
the limit lies PRUNE_DEVIATIONS standard deviations above its mean, which one such pair in some 100,000 exceeds.

Verification. Both texts of a pair that is left meet, and the weighted Jaccard similarity of their shingle counts is computed exactly.
Components of the verified links are the classes.

Shuffles. Buckets, signatures and texts that no join needs are left out by Bloom filters where they lie, all but a few of them;
so of the texts only those of nodes in shared buckets move, and in each round those of its pairs.

Defined results: a text of one to four words is one shingle; texts without words are in no class but their own; rows with
null ids are compared like others; the class of a row is the smallest non-null id in it (null if there is none). Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.common import WORD, id_and_text, stored
from tracklayer.llm.components import star_links
from tracklayer.llm.substring_dedup import mix, window_hashes
from tracklayer.llm.url_filter import maybe_listed

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 6
#: A task works on so many words or documents at a time.
STEP_WORDS, STEP_DOCS = 200_000, 2_000
#: Components are made anew when a round found one link for so many rows of open buckets, at least.
RELABEL = 100
#: Pairs with so many standard deviations more differing registers than one of the least similarity are not verified.
PRUNE_DEVIATIONS = 4.5
PARITY_BITS = 1024
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_counts(words: list[str], size: int = SHINGLE_WORDS) -> Counter:
    """Each window of `size` words with its count; fewer words make one shingle, none make no shingle."""
    if len(words) < size:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*(words[i:] for i in range(size)), strict=False))


def weighted_jaccard(a: Counter, b: Counter) -> float:
    if len(a) > len(b):
        a, b = b, a
    common = sum(min(n, b[k]) for k, n in a.items() if k in b)
    every = a.total() + b.total() - common
    return common / every if every else 0.0


def weighted_shingles(texts: list[str], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, hash and count of the distinct shingles of many texts."""
    lists = [WORD.findall(t) for t in texts]
    sizes = np.array([len(x) for x in lists], np.int64)
    codes, words = pd.factorize(np.array([w for x in lists for w in x], object))
    hashed = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    flat = hashed[codes] if len(codes) else np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    windows = window_hashes(flat, size)
    docs = np.repeat(np.arange(len(texts)), sizes)[: len(windows)]
    inside = np.arange(len(windows)) + size <= ends[docs]
    docs, windows = docs[inside], windows[inside]
    short = np.flatnonzero((sizes > 0) & (sizes < size))
    if len(short):
        own = [window_hashes(flat[ends[d] - sizes[d] : ends[d]], int(sizes[d]))[0] ^ np.uint64(sizes[d]) for d in short]
        docs, windows = np.concatenate([docs, short]), np.concatenate([windows, np.array(own, np.uint64)])
    order = np.lexsort((windows, docs))
    docs, windows = docs[order], windows[order]
    lead = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (windows[1:] != windows[:-1])])) if len(docs) else np.zeros(0, np.int64)
    return docs[lead], windows[lead], np.diff(np.append(lead, len(docs)))


def prob_minhash(docs: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """The element of each document's registers (0 where a document has none)."""
    earliest = np.full(n_docs * registers, np.inf)
    holds = np.zeros(n_docs * registers, np.uint64)
    time, turn = np.zeros(len(docs)), 0
    weights = weights.astype(float)
    with np.errstate(over="ignore"):
        while len(docs):
            turn += 1
            draw = mix(elements + np.uint64(2 * turn) * _GOLDEN)
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / weights
            place = docs * registers + (mix(elements + np.uint64(2 * turn + 1) * _GOLDEN) >> np.uint64(33)).astype(np.int64) % registers
            np.minimum.at(earliest, place, time)
            won = time == earliest[place]
            holds[place[won]] = elements[won]
            latest = earliest.reshape(n_docs, registers).max(axis=1)
            on = time < latest[docs]
            docs, elements, weights, time = docs[on], elements[on], weights[on], time[on]
    return holds.reshape(n_docs, registers)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    with np.errstate(over="ignore"):
        parts = signatures.reshape(len(signatures), bands, rows)
        key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN), parts.shape[:2])
        for r in range(rows):
            key = mix(key * np.uint64(31) + parts[:, :, r])
        return key.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each register, sixteen to a word; the last word is filled up with zeros."""
    n, registers = signatures.shape
    nibbles = np.zeros((n, -(-registers // 16), 16), np.uint64)
    nibbles.reshape(n, -1)[:, :registers] = mix(signatures) & np.uint64(15)
    return (nibbles << np.arange(0, 64, 4, dtype=np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)


def most_differing(registers: int, similarity: float) -> int:
    """At how many registers the sketches of a pair may differ that is still verified."""
    chance = (1 - similarity) * 15 / 16
    return int(registers * chance + PRUNE_DEVIATIONS * (registers * chance * (1 - chance)) ** 0.5 + 1)


def n_differing(a: Column, b: Column, registers: int) -> Column:
    """The number of registers at which two sketches differ, natively."""
    return reduce(Column.__add__, [_differing(F.get(a, F.lit(i)), F.get(b, F.lit(i))) for i in range(-(-registers // 16))])


def _differing(a: Column, b: Column) -> Column:
    """The number of fours of bits in which two words differ."""
    bits = a.bitwiseXOR(b)
    for step in (1, 2):  # any bit of four reaches the lowest
        bits = bits.bitwiseOR(F.shiftrightunsigned(bits, step))
    return F.bit_count(bits.bitwiseAND(F.lit(0x1111111111111111)))


def parities(docs: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_docs: int) -> np.ndarray:
    """For each document, of its shingles at each of PARITY_BITS places whether their number is odd; 64 to a word."""
    place = docs * PARITY_BITS + (mix(elements + _GOLDEN) % np.uint64(PARITY_BITS)).astype(np.int64)
    odd = np.bincount(place[weights % 2 == 1], minlength=n_docs * PARITY_BITS) % 2
    return np.packbits(odd.astype(bool)).view(np.int64).reshape(n_docs, -1)


def _alike(registers: int, similarity: float) -> Column:
    """Whether the pair of node and u_node may be similar enough, by sizes, parities and registers."""
    sizes = F.least("size", "u_size") >= F.greatest("size", "u_size") * (similarity - 1e-9)  # else it cannot be reached
    bits = [F.bit_count(F.col(f"parity{i}").bitwiseXOR(F.col(f"u_parity{i}"))) for i in range(PARITY_BITS // 64)]
    shingles = reduce(Column.__add__, bits) <= (F.col("size") + F.col("u_size")) * ((1 - similarity) / (1 + similarity) + 1e-9)
    places = [_differing(F.col(f"sketch{i}"), F.col(f"u_sketch{i}")) for i in range(-(-registers // 16))]
    return sizes & shingles & (reduce(Column.__add__, places) <= most_differing(registers, similarity))


def sign(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE_WORDS) -> DataFrame:
    """id, node (digest of the text), size (shingles), keys (one for each band), sketch and parity, all three empty without words; from id and text."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            start = 0
            while start < len(texts):
                stop, held = start, 0
                while stop < len(texts) and stop - start < STEP_DOCS and (stop == start or held < STEP_WORDS * 6):
                    held += len(texts[stop])
                    stop += 1
                own, part = texts[start:stop], batch.slice(start, stop - start)
                at, elements, weights = weighted_shingles(own, size)
                full = np.isin(np.arange(len(own)), at)
                signatures = prob_minhash(at, elements, weights, len(own), bands * rows)
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * values.shape[1])]), pa.int32()), pa.array(values[full].ravel()))
                    for values in (band_keys(signatures, bands, rows), sketches(signatures), parities(at, elements, weights, len(own)))
                ]
                sizes = pa.array(np.bincount(at, weights, len(own)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("node"), sizes, *lists], names=["id", "node", "size", "keys", "sketch", "parity"])
                start = stop

    return docs.select("id", "text", F.unhex(F.md5("text")).alias("node")).mapInArrow(run, f"id {kind}, node binary, size long, keys array<long>, sketch array<long>, parity array<long>")


def verify(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE_WORDS) -> DataFrame:
    """The pairs u, v whose texts are similar enough."""
    left, right = (maybe_listed(texts, "node", pairs.select(c)).select(F.col("node").alias(c), F.col("text").alias(f"{c}_text")) for c in ("v", "u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, counts = None, Counter()
        for batch in batches:
            good = []
            for u, u_text, v_text in zip(*(batch.column(c) for c in ("u", "u_text", "v_text")), strict=True):
                if u != last:
                    last, counts = u, shingle_counts(WORD.findall(u_text.as_py()), size)
                good.append(weighted_jaccard(counts, shingle_counts(WORD.findall(v_text.as_py()), size)) >= similarity)
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v")], names=["u", "v"])

    return pairs.join(left, "v").join(right, "u").select("u", "v", "u_text", "v_text").mapInArrow(run, "u binary, v binary")


def _verified_links(members: DataFrame, texts: DataFrame, similarity: float, size: int, registers: int) -> DataFrame | None:
    """Stars of all nodes that share a bucket and are similar; `members` has bucket, buckets (all of the node), node, size, and the words of sketch and parity.

    Labels only spare comparisons, so they are made anew after a round in which many links were found, and else at the end.
    """
    traits = [c for c in members.columns if c != "bucket"]
    members = members.withColumn("label", F.col("node"))
    stars, fresh, others = None, [], 0

    def merged() -> DataFrame | None:
        links = [*fresh, *([stars] if stars is not None else [])]
        return star_links(reduce(DataFrame.unionByName, links)) if fresh else stars

    while True:
        parts = members.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.min("node").alias("node"))
        least = F.min(F.struct("n", "label", "node")).alias("least")
        whole = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("total"), least).where("parts > 1")
        chosen = (F.col("node") == F.col("least.node")) | (F.pmod(F.xxhash64("node"), F.col("total")) < others)
        faced = stored(members.join(whole, "bucket").select("bucket", *traits, "label", chosen.alias("faces")), "faced")
        n_faced = faced.count()
        if not n_faced:
            return merged()
        faces = faced.where("faces").select("bucket", *(F.col(c).alias(f"u_{c}") for c in (*traits, "label")))
        here = F.col("bucket") == F.array_min(F.array_intersect("buckets", "u_buckets"))
        pairs = faced.join(faces, "bucket").where("label <> u_label and not (faces and node < u_node)").where(_alike(registers, similarity) & here)
        pairs = stored(pairs.select(F.col("u_node").alias("u"), F.col("node").alias("v")), "pairs")
        found = stored(verify(pairs, texts, similarity, size), "similar")
        members = faced.where("not faces").drop("faces")
        others = 16 * others + 15
        n_found = found.count()
        if n_found:
            fresh.append(found)
        if n_found * RELABEL >= n_faced:
            stars, fresh = merged(), []
            labels = stars.select(F.col("u").alias("node"), F.col("v").alias("new"))
            members = members.join(labels, "node", "left").withColumn("label", F.coalesce("new", "node")).drop("new")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    size: int = SHINGLE_WORDS,
) -> DataFrame:
    """Every row's id and its class_id, the smallest id among the documents connected by similar pairs."""
    own = id_and_text(docs, id_col, text_col)
    signed = stored(sign(own, bands, rows, size), "signatures")
    held = signed.select(F.explode("keys").alias("bucket"), F.xxhash64("node").alias("short"))
    shared = held.groupBy("bucket").agg(F.min("short").alias("a"), F.max("short").alias("b")).where("a <> b").select("bucket")
    shared = stored(shared, "shared")  # as its size is known then, a small one is broadcast
    held = maybe_listed(signed.select("node", F.explode("keys").alias("bucket")), "bucket", shared)
    held = held.join(shared, "bucket")  # not a semi-join, as that is moved below the filter
    nodes = stored(held.groupBy("node").agg(F.collect_set("bucket").alias("buckets")), "nodes")
    traits = maybe_listed(signed.select("id", "node", "size", "sketch", "parity"), "node", nodes.select("node"))
    traits = stored(traits.join(nodes.select("node"), "node").select("id", "node", "size", "sketch", "parity"), "traits")
    n_words = {"sketch": -(-bands * rows // 16), "parity": PARITY_BITS // 64}
    heads = stored(traits.groupBy("node").agg(F.min("id").alias("id")), "heads")
    traits = nodes.join(traits.drop("id").dropDuplicates(["node"]), "node")
    words = [F.get(c, F.lit(i)).alias(f"{c}{i}") for c, n in n_words.items() for i in range(n)]  # columns, as code on arrays gets too long to be compiled
    members = stored(traits.select(F.explode("buckets").alias("bucket"), "buckets", "node", "size", *words), "buckets")
    known = heads.where("id is not null")
    with_id = maybe_listed(own, "id", known.select("id")).join(known, "id").where(F.unhex(F.md5("text")) == F.col("node"))
    without = own.where("id is null").withColumn("node", F.unhex(F.md5("text")))
    unknown = heads.where("id is null").select("node")
    without = maybe_listed(without, "node", unknown).join(unknown, "node")
    texts = stored(with_id.select("node", "text").unionByName(without.select("node", "text")), "texts")
    stars = _verified_links(members, texts, similarity, size, bands * rows)
    if stars is None:
        stars = members.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    full = signed.select("id", "node", (F.size("keys") > 0).alias("full"))
    label = F.coalesce("v", "node")
    labelled = full.where("full").join(stars, F.col("node") == F.col("u"), "left").select("id", label.alias("label"))
    least = labelled.groupBy("label").agg(F.min("id").alias("class_id"))
    classed = labelled.join(least, "label").select(F.col("id").alias(id_col), "class_id")
    return classed.unionByName(full.where("not full").select(F.col("id").alias(id_col), F.col("id").alias("class_id")))
