"""Benchmark decontamination by SimHash over item-sized windows, in built-in column functions only.

1. Windows. Items' lengths slide over every document, word by word. Of all windows those are made that hold as many
   shingles of five words of items of their length as the similarity takes at least, wherever these stand in the item: the
   others cannot be similar to an item. The places of such shingles come from an exact join.
2. Fingerprints. Each window and item gets 64 bits: of the hashes of its words, repeats counting again, the majority at
   each bit. The counts are sums of columns, combined map-side.
3. Multi-index. Fingerprints are cut in `radius + 1` blocks. Two that differ in at most `radius` bits agree in a block, so
   a join on block and length finds every such pair; the Hamming distance then decides.
4. Verification: the weighted Jaccard similarity of the counts of five-word shingles, on the words themselves.

Words are runs of letters and digits, lower-cased. Items are broadcast only if their tables are small, else the same joins
are shuffled.

Defined results: null and empty texts have no words, and an item without words matches nothing; an item of one to four words
is one shingle of its own length, which a text holds or does not; repeated documents are found alike, and documents with equal ids count as one in the result; a null id is returned as
null. Of windows equally similar, one in which a shingle stands at its place in the item comes first, then the earliest. Other columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.common import stored

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
BROADCAST_ROWS = 100_000
WORD_GAP = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP), lambda w: w != "")


def _shingles(words: Column, join: bool, size: int = SHINGLE_WORDS) -> Column:
    """Shingles of an array column of words (as text) or of their hashes (as one hash), null where there are fewer words."""

    def one(i: Column) -> Column:
        parts = [F.get(words, i + k) for k in range(size)]
        return F.concat_ws(" ", *parts) if join else F.xxhash64(*parts)

    n = F.size(words)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), one))


def _own_shingles(words: Column) -> Column:
    """Shingles of a window or item as text: fewer than five words make one."""
    short = F.when(F.size(words) > 0, F.array(F.concat_ws(" ", words)))
    return F.coalesce(_shingles(words, True), short)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fingerprints(windows: DataFrame, key: list[str]) -> DataFrame:
    """SimHash of each row's `words`: key columns, n and fp. Two 32-bit counters fit in one sum."""
    bit = F.xxhash64("word")
    lanes = [(F.shiftrightunsigned(bit, b).bitwiseAND(1) + F.shiftleft(F.shiftrightunsigned(bit, b + 32).bitwiseAND(1), 32)).alias(f"c{b}") for b in range(32)]
    counted = windows.select(*key, F.explode("words").alias("word")).select(*key, *lanes)
    counted = counted.groupBy(*key).agg(F.count("*").alias("n"), *(F.sum(f"c{b}").alias(f"c{b}") for b in range(32)))
    fp = F.lit(0).cast("long")
    for b in range(64):
        ones = F.shiftrightunsigned(f"c{b % 32}", 32 * (b // 32)).bitwiseAND(0xFFFFFFFF)
        fp = fp.bitwiseOR(F.when(ones * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return counted.select(*key, "n", fp.alias("fp"))


def hamming_blocks(prints: DataFrame, radius: int) -> DataFrame:
    """Adds block and value: `radius + 1` rows for each fingerprint."""
    edges = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    blocks = [F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", a).bitwiseAND((1 << (b - a)) - 1).alias("value")) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return prints.select("*", F.inline(F.array(*blocks)))


def _window_starts(similarity: float) -> Column:
    """Of rows with n, length and at, the sorted places of shingles of items of n words: all windows that may be similar to one.

    If a window of v shingles and an item of m have similarity s, they have s / (1 + s) * (v + m) shingles in common at least.
    A window has k of the places exactly if it has, for some i, those numbered i to i + k - 1.
    """
    n, at, own = F.col("n"), F.col("at"), SHINGLE_WORDS - 1
    end = F.greatest(F.lit(0), F.col("length") - n)
    v = F.least(n, F.col("length")) - own
    k = F.greatest(F.lit(1), F.ceil((v + n - own) * F.lit(similarity / (1 + similarity)) - 1e-9)).cast("int")
    runs = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(at) - k))

    def starts(i: Column) -> Column:
        return F.sequence(F.greatest(F.lit(0), F.get(at, i + k - 1) - (v - 1)), F.least(F.get(at, i), end), F.lit(1))

    def close(i: Column) -> Column:
        return F.get(at, i + k - 1) - F.get(at, i) < v

    found = F.array_distinct(F.flatten(F.transform(F.filter(runs, close), starts)))
    return F.transform(found, lambda x: F.struct(x.alias("start"), n.alias("span"), (x == end).alias("last")))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Documents that hold an item: id, item, similarity of the best window, and its first word's place (from 0)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    bench = items.select(F.col(item_col).alias("item"), _words(F.col(item_text_col)).alias("words")).where(F.size("words") > 0)
    bench = stored(bench.groupBy("words").agg(F.collect_set("item").alias("own"), F.min("item").alias("item")), "items")  # equal items are judged once

    hashed = bench.select(F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    anchors = hashed.select("n", F.explode(_shingles(F.col("h"), False)).alias("shingle")).distinct()
    anchors = stored(anchors, "anchors")
    short = bench.where(F.size("words") < SHINGLE_WORDS).select(F.size("words").alias("n"), F.array_join("words", " ").alias("shingle"))
    lengths = [r.n for r in short.select("n").distinct().collect()]  # four at most
    texts = rows.withColumn("h", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)))
    # outer, as a plain generator gets a filter on its array, which would be moved below and computed for every element
    placed = texts.select("id", "tie", F.size("h").alias("length"), F.posexplode_outer(_shingles(F.col("h"), False)).alias("pos", "shingle"))
    met = placed.join(_small(anchors, anchors.count()), "shingle")
    hits = met.groupBy("id", "tie", "n", "length").agg(F.sort_array(F.collect_set("pos")).alias("at"))  # a text's own places
    spans = hits.select("id", "tie", F.inline(_window_starts(similarity)))
    if lengths:  # windows of the lengths of short items, found by all their words
        own = rows.select("id", "tie", _words(F.col("text")).alias("all"))
        for n in sorted(lengths):
            pieces = own.select("id", "tie", F.size("all").alias("length"), F.posexplode_outer(_shingles(F.col("all"), True, n)).alias("start", "shingle"))
            wanted = short.where(F.col("n") == n).select("shingle")
            found = pieces.join(_small(wanted, wanted.count()), "shingle").select("id", "tie", "start", F.lit(n).alias("span"), (F.col("start") == F.col("length") - n).alias("last"))
            spans = spans.unionByName(found)
        spans = spans.distinct()
    by_doc = spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "span", "last")).alias("spans"))
    by_doc = by_doc.select(F.col("id").alias("own_id"), F.col("tie").alias("own_tie"), "spans")
    held = rows.join(by_doc, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("tie") == F.col("own_tie"))).dropDuplicates(["id", "tie"])
    held = held.select("id", "tie", "spans", _words(F.col("text")).alias("all"))
    cut = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["span"].alias("span"), s["last"].alias("last"), F.slice("all", s["start"] + 1, s["span"]).alias("words")))
    key = ["id", "tie", "start", "span"]
    windows = stored(held.select("id", "tie", F.inline_outer(cut)), "windows")

    window_blocks = hamming_blocks(fingerprints(windows, key).drop("n"), radius)
    item_blocks = hamming_blocks(fingerprints(bench, ["item"]), radius).select("item", F.col("n").alias("span"), F.col("fp").alias("item_fp"), "block", "value")
    near = window_blocks.join(_small(item_blocks, bench.count() * (radius + 1)), ["span", "block", "value"])
    near = near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*key, "item").distinct()

    shown = windows.select(*key, "last", _own_shingles(F.col("words")).alias("shingles"))
    same = [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in key]
    condition = same[0] & same[1] & same[2] & same[3]
    pairs = near.join(shown.select(*(F.col(c).alias(f"w_{c}") for c in key), "last", "shingles"), condition)
    counts = pairs.select(*key, "last", "item", F.size("shingles").alias("of_window"), F.posexplode("shingles").alias("at", "shingle"))
    counts = counts.groupBy(*key, "last", "item", "of_window", "shingle").agg(F.count("*").alias("a"), F.collect_set("at").alias("at"))
    of_items = bench.select("item", F.size("words").alias("m"), F.posexplode(_own_shingles(F.col("words"))).alias("off", "shingle"))
    of_items = of_items.groupBy("item", "m", "shingle").agg(F.count("*").alias("b"), F.collect_set("off").alias("off"))
    # lined up: at its place in the item, or as near to that as the text's ends allow
    before, after = F.array_min("at") < F.array_max("off"), F.array_max("at") > F.array_min("off")
    lined = F.arrays_overlap("at", "off") | ((F.col("start") == 0) & before) | (F.col("last") & after)
    common = counts.join(of_items, ["item", "shingle"]).groupBy(*key, "item", "of_window", "m")
    common = common.agg(F.sum(F.least("a", "b")).alias("common"), F.max(lined).alias("lined"))
    value = F.col("common") / (F.col("of_window") + F.greatest(F.lit(1), F.col("m") - (SHINGLE_WORDS - 1)) - F.col("common"))
    good = common.withColumn("similarity", value).where(F.col("similarity") >= similarity)
    best = good.groupBy("id", "item").agg(F.max(F.struct("similarity", "lined", (-F.col("start")).alias("back"))).alias("best"))
    found = best.join(bench.select("item", "own"), "item").select("id", F.explode("own").alias("item"), "best")
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("best.similarity").alias("similarity"), (-F.col("best.back")).cast("long").alias("start"))
