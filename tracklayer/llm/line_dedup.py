"""Line dedup over content-defined chunks of lines, in built-in column functions only.

A rolling hash over the hashes of the last few lines decides where a chunk of lines ends. Boundaries so depend on content
alone: text put in front of a passage shifts its lines, not its boundaries. A chunk with two or more lines that hold
anything, and that occurs more than once in all documents, is kept where it comes first (by document id, then place) and
removed elsewhere, after its bytes were compared with those of the first.

Only a hash, an id and a place of each chunk are grouped, with a maximum that combines map-side; texts of repeated chunks
alone meet their first occurrence, in a join that adaptive execution can split when one chunk is in a third of all
documents. The text itself is shuffled once, to its own removals.

Defined results: a null text is empty and stays null if nothing is removed; an empty text has one blank line; documents
with equal id and text lose the same chunks; a null id comes first. All columns of the input are kept, and a column of the
input named like one that is added is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklayer.llm.common import stored

WINDOW_LINES = 2
MEAN_LINES = 3
#: The hash of a line is below this, so that rolling sums stay within 64 bits; and the factor of the sum.
LINE_RANGE = 1_000_003
FACTOR = 8191


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long") % LINE_RANGE


def _rolling(hashes: Column, i: Column, window: int) -> Column:
    """Of the lines that end at place `i` (from 0): a sum modulo LINE_RANGE; null where fewer lines are before it."""
    total = F.get(hashes, i)
    for back in range(1, window):
        total = total + F.get(hashes, i - back) * (FACTOR**back % LINE_RANGE)
    return F.when(i >= window - 1, total % LINE_RANGE)


def with_chunks(rows: DataFrame, window: int = WINDOW_LINES, mean: int = MEAN_LINES) -> DataFrame:
    """Adds chunks, an array of struct(k, body, lines), to rows that have a `text`."""
    rows = rows.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    rows = rows.withColumn("_hashes", F.transform("_lines", line_hash))
    n = F.size("_lines")
    # one-based place of the last line of each chunk
    ends = F.filter(F.sequence(F.lit(1), n), lambda e: (e == n) | F.coalesce(_rolling(F.col("_hashes"), e - 1, window) % mean == 0, F.lit(False)))
    rows = rows.withColumn("_ends", ends)

    def chunk(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get("_ends", k - 1), F.lit(0))
        own = F.slice("_lines", start + 1, end - start)
        full = F.size(F.filter(own, lambda line: F.trim(line) != ""))
        return F.struct(k.alias("k"), F.array_join(own, "\n").alias("body"), (end - start).alias("lines"), full.alias("full"))

    return rows.withColumn("chunks", F.transform("_ends", chunk)).drop("_lines", "_hashes", "_ends")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_LINES, mean: int = MEAN_LINES) -> DataFrame:
    """The documents with repeated chunks of lines removed, and n_lines, n_removed_lines, n_removed_chunks (long)."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    rows = with_chunks(rows, window, mean)
    # outer, as a plain generator gets a filter on its array, which would be moved below and computed for every element
    pieces = rows.select("id", "tie", F.inline_outer("chunks")).where("full >= 2").withColumn("key", F.xxhash64("body"))
    place = F.struct("id", "tie", "k")
    first = pieces.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("key", "first")
    met = stored(pieces.join(first, "key").select("key", "id", "tie", "k", "body", place.eqNullSafe(F.col("first")).alias("lead")), "line-chunks")
    leads = met.where("lead").groupBy("key").agg(F.min("body").alias("lead_body"))
    gone = met.where("not lead").join(leads, "key").where("body = lead_body")
    gone = gone.groupBy("id", "tie").agg(F.collect_set("k").alias("gone"))  # at most a document's own chunks
    left, right = rows.alias("l"), gone.select(F.col("id").alias("gone_id"), F.col("tie").alias("gone_tie"), "gone")
    joined = left.join(right, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("tie") == F.col("gone_tie")), "left")
    stay = F.filter("chunks", lambda c: ~F.array_contains("gone", c["k"]))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda c: c["body"]), "\n"))
    lines = F.aggregate("chunks", F.lit(0).cast("long"), lambda s, c: s + c["lines"])
    removed = F.aggregate(F.filter("chunks", lambda c: F.array_contains("gone", c["k"])), F.lit(0).cast("long"), lambda s, c: s + c["lines"])
    added = {
        "n_lines": lines,
        "n_removed_lines": F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(removed),
        "n_removed_chunks": F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(F.size("gone").cast("long")),
    }
    done = joined.select("row", text.alias("new_text"), *(v.alias(c) for c, v in added.items()))
    kept = [(F.col("new_text") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns if c not in added]
    return done.select(*kept, *added)
