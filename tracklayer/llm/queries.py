"""One query for each operator over its whole table, and the SQL that it must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklayer.llm import (
    attention_lm,
    bpe,
    decontaminate,
    fill_middle,
    language_gru,
    line_crf,
    line_dedup,
    near_dup,
    periodic_runs,
    substring_dedup,
    token_files,
    url_filter,
    warc,
)
from tracklayer.llm.common import table, words_of

#: Verdict and rule (host, leading part of the path).
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, with the item, the similarity and the place."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; the list holds the canonical URLs that several pages carry."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.repeated_urls(pages), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_token_files(spark: SparkSession, sf_dir: str, tokenizers: Callable[[str], str] = public_tokenizers.path) -> DataFrame:
    """All documents written to token files and read back."""
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizers("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, rules and verdict for every document; the field is fitted to a bounded sample of `labels`."""
    docs = table(spark, sf_dir, "documents")
    field = line_crf.fit_lines(docs, table(spark, sf_dir, "labels"))
    return line_crf.judge_quality(docs, field).drop("marks")


def op5_lm_scoring(spark: SparkSession, sf_dir: str, tokenizers: Callable[[str], str] = public_tokenizers.path) -> DataFrame:
    """Every text's log10 probability, by word counts and by the attention model."""
    return attention_lm.score_texts(table(spark, sf_dir, "documents"), tokenizers("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated 20-word windows."""
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated chunks of lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed_lines", "n_removed_chunks")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    records = warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages")), payload=False).where("kind = 'record'")
    page = [F.regexp_extract(c, "^<urn:page:(.+)>$", 1).try_cast("long") for c in ("record_id", "refers_to")]
    return records.select(page[0].alias("page_id"), "payload_bytes", "payload_digest", "record_type", page[1].alias("refers_to"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near-duplicates."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str, tokenizers: Callable[[str], str] = public_tokenizers.path) -> DataFrame:
    """Count and digests of every document's ids, and of its bytes decoded from them."""
    ranks = bpe.read_ranks(tokenizers("byte_bpe_multi_50k.tiktoken"))
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return bpe.encode_texts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, bpe.digests, schema)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's language; the network learns from documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    languages, net = language_gru.learn_languages(docs, ~held_out)
    return language_gru.predict_languages(docs, languages, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def looped(docs: DataFrame) -> DataFrame:
    """Documents in a tenth of which, chosen by a checksum of the id, the words from some place on go round."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = words_of(F.coalesce("text", F.lit("")))
    n = F.size("words")
    begin = F.floor(h / 10) % n
    turn = 1 + F.floor((n - begin) / (3 + F.floor(h / 10) % 8))
    round_trip = F.concat(
        F.slice("words", 1, F.col("begin")),
        F.transform(F.sequence(F.lit(0), n - F.col("begin") - 1), lambda i: F.element_at("words", (F.col("begin") + i % F.col("turn") + 1).cast("int"))),
    )
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    placed = chosen.withColumn("begin", F.when(n > 0, begin).cast("int")).withColumn("turn", F.when(n > 0, turn).cast("int"))
    return placed.select("doc_id", F.when(n > 0, F.array_join(round_trip, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's periodic runs of words, and the text with each run cut down to one period."""
    found = periodic_runs.periodic_runs(looped(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    placed = found.withColumn("best", longest)
    return placed.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("1000 * best.length div -best.less").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its fill-in-middle form, and restored from it."""
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_url_filter": op2_url_filter,
    "op3_token_files": op3_token_files,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_near_dup": op9_near_dup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fill_middle": op13_fill_middle,
}

_HOST = "translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"

ORACLES: dict[str, str] = {
    "op1_decontamination": f"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words FROM documents
        ), b AS (
            SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words FROM benchmark
        ), ds AS (
            SELECT doc_id, i - 1 AS pos, length, array_to_string(words[i : i + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, len(words) AS length, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)
        ), bs AS (
            SELECT item_id, i - 1 AS off, n, array_to_string(words[i : i + 4], ' ') AS shingle
            FROM (SELECT item_id, words, len(words) AS n, unnest(range(1, len(words) - 3)) AS i FROM b WHERE len(words) >= 5)
        ), windows AS (
            SELECT DISTINCT doc_id, item_id, n, greatest(0, least(pos - off, length - n)) AS start, least(n, length) AS span
            FROM ds JOIN bs USING (shingle)
        ), wc AS (
            SELECT w.doc_id, w.item_id, w.start, w.n, w.span - 4 AS of_window, s.shingle, count(*) AS a
            FROM windows w JOIN ds s ON s.doc_id = w.doc_id AND s.pos BETWEEN w.start AND w.start + w.span - 5 GROUP BY ALL
        ), bc AS (
            SELECT item_id, shingle, count(*) AS b FROM bs GROUP BY ALL
        ), common AS (
            SELECT doc_id, item_id, start, of_window, n, sum(least(a, b)) AS common FROM wc JOIN bc USING (item_id, shingle) GROUP BY ALL
        ), spans AS (
            SELECT DISTINCT len(words) AS n FROM b WHERE len(words) BETWEEN 1 AND 4
        ), pieces AS (
            SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM d JOIN spans ON len(words) >= n
        ), valued AS (
            SELECT doc_id, item_id, start, common::DOUBLE / (of_window + n - 4 - common)::DOUBLE AS similarity FROM common
            UNION ALL
            SELECT doc_id, item_id, i - 1 AS start, 1.0 AS similarity FROM pieces p JOIN b ON b.words = p.words[i : i + n - 1]
        )
        SELECT doc_id, item_id, similarity, start FROM valued WHERE similarity >= {decontaminate.SIMILARITY}
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1""",
    "op2_url_filter": f"""
        WITH parts AS (
            SELECT page_id, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path FROM pages
        ), keyed AS (
            SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') END AS key FROM parts
        ), listed AS (
            SELECT key FROM keyed WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1
        ), rules(verdict, rule) AS (
            VALUES {", ".join(f"('{v}', '{r}')" for v, r in URL_RULES)}
        ), split AS (
            SELECT verdict, rule, split_part(rule, '/', 1) AS name, substr(rule, strpos(rule, '/')) AS start FROM rules
        ), fitting AS (
            SELECT k.host, k.path, max_by(s.rule, length(s.rule)) AS rule, max_by(s.verdict, length(s.rule)) AS verdict
            FROM (SELECT DISTINCT host, path FROM keyed) k
            JOIN split s ON (k.host = s.name OR ends_with(k.host, '.' || s.name)) AND starts_with(k.path, s.start)
            GROUP BY k.host, k.path
        )
        SELECT k.page_id, k.host, k.path, f.rule,
               coalesce(f.verdict, CASE WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM keyed k LEFT JOIN fitting f ON f.host = k.host AND f.path = k.path LEFT JOIN listed l ON l.key = k.key""",
    "op6_substring_dedup": """
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS win
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w WHERE len(words) >= 20)
        ), later AS (
            SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS at FROM later
        ), placed AS (
            SELECT doc_id, unnest(range(1, len(words) + 1)) AS at, unnest(words) AS word FROM w
        ), left_over AS (
            SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.at) AS kept, count(*) AS n
            FROM placed p ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.at = p.at GROUP BY p.doc_id
        )
        SELECT w.doc_id, len(w.words) AS n_words, len(w.words) - coalesce(l.n, 0) AS n_removed,
               sha256(coalesce(l.kept, '')) AS kept_sha256
        FROM w LEFT JOIN left_over l ON l.doc_id = w.doc_id""",
    "op7_line_dedup": f"""
        WITH split AS (
            SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), placed AS (
            SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM split
        ), hashed AS (
            SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT % {line_dedup.LINE_RANGE} AS h FROM placed
        ), cut AS (
            SELECT *, coalesce((h + {line_dedup.FACTOR} * lag(h) OVER d) % {line_dedup.LINE_RANGE} % {line_dedup.MEAN_LINES} = 0, false) AS ends
            FROM hashed WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), numbered AS (
            SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM cut
        ), chunks AS (
            SELECT doc_id, k, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS lines,
                   count(*) FILTER (WHERE trim(line, ' ') <> '') AS filled
            FROM numbered GROUP BY doc_id, k
        ), judged AS (
            SELECT *, filled >= 2 AND row_number() OVER (PARTITION BY body ORDER BY doc_id, k) > 1 AS gone FROM chunks
        )
        SELECT s.doc_id, CASE WHEN bool_or(j.gone) THEN coalesce(string_agg(j.body, chr(10) ORDER BY j.k) FILTER (WHERE NOT j.gone), '') ELSE any_value(s.text) END AS text,
               sum(j.lines)::BIGINT AS n_lines, coalesce(sum(j.lines) FILTER (WHERE j.gone), 0)::BIGINT AS n_removed_lines,
               count(*) FILTER (WHERE j.gone) AS n_removed_chunks
        FROM split s JOIN judged j ON j.doc_id = s.doc_id GROUP BY s.doc_id""",
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages),
        f AS (SELECT payload, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY payload)
        SELECT p.page_id, p.n AS payload_bytes, sha1(p.payload) AS payload_digest,
               CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
        FROM p LEFT JOIN f ON f.payload = p.payload""",
    "op13_fill_middle": """
        WITH seeded AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS seed FROM documents
        ), drawn AS (
            SELECT doc_id, text, length(text) AS n, ('0x' || seed[1:8])::BIGINT AS h1, ('0x' || seed[9:16])::BIGINT AS h2,
                   ('0x' || seed[17:24])::BIGINT AS h3, ('0x' || seed[25:32])::BIGINT AS h4 FROM seeded
        ), cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
        ), spans AS (
            SELECT *, text[1:a] AS prefix, text[a + 1:b] AS middle, text[b + 1:n] AS suffix FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM spans""",
}
