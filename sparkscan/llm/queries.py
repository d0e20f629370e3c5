"""The operators of this subpackage as registered queries over whole tables, and the SQL that checks some of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import bpe, chat, filter_audit, near_dup, ngram_lm, packing, quality_model, quality_rules, spelling, substring_dedup, token_counts, topk, url_rules
from .common import remainder, table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
QUALITY_SCORE = 0.7


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode whole documents."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), decoded=True)
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count tokens through a cache that begins empty in the shared folder."""
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), fresh_path(spark, "token-counts"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack documents into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from six sevenths of the documents and score all."""
    return ngram_lm.learn_and_score(table(spark, sf_dir, "documents"), remainder("doc_id", 7) != 2)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format conversations and read them back from their tokens."""
    path = public_tokenizers.path(BYTE_BPE)
    rows = chat.probe(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.assemble(chat.format_turns(rows, path)), path)


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge the URL of every page."""
    return url_rules.url_verdicts(table(spark, sf_dir, "pages"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with three-word shingle similarity of 0.85 or more."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), 3, 85, 100)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every document by the table of thresholds."""
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn quality from three quarters of the labels and score every document."""
    docs = table(spark, sf_dir, "documents")
    weights = quality_model.train(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2))
    scored = docs.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), quality_model.score(docs, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_SCORE).cast("int"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, for each language."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the words of 35-word windows that are found twice."""
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents, grouped by spelling."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_topk, op3_token_counts, op4_packing, op5_lm, op6_chat, op7_url_rules, op8_near_duplicates,
    op9_quality_rules, op10_quality_model, op11_filter_audit, op12_substring_dedup, op13_spelling)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOP = ", ".join("'" + w + "'" for w in quality_rules.STOP_FORMS)

ORACLES = {
    "op2_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(
                list_zip(q.v, x.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5
    """,
    "op7_url_rules": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), p AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ), r(rule_host, rule_path, rule_verdict) AS (VALUES
            ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
            ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
        SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM (SELECT *, row_number() OVER () AS n FROM p) p
        LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule_host) DESC, length(rule_path) DESC) = 1
    """,
    "op9_quality_rules": rf"""
        WITH w AS (
            SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
        ), windows AS (
            SELECT n, i, array_to_string(words[i:i + 7], ' ') AS win
            FROM (SELECT n, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
        ), twice AS (
            SELECT n, i FROM windows QUALIFY count(*) OVER (PARTITION BY n, win) > 1
        ), covered AS (
            SELECT n, count(DISTINCT i + k) AS n_repeat FROM twice, range(8) t(k) GROUP BY n
        ), lines AS (
            SELECT n, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM w
        ), m AS (
            SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
                coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
                len(list_filter(words, lambda x: x IN ({_STOP}))) AS n_stop
            FROM w JOIN lines USING (n) LEFT JOIN covered USING (n)
        ), b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 16.0 AND n_symbols / n_words <= 0.40
                AND n_stop / n_words >= 0.01 AND n_dup_lines / greatest(n_lines, 1) <= 0.50 AS kept
        FROM b
    """,
    "op11_filter_audit": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
        ), least AS (
            SELECT text, min(doc_id) AS least FROM d GROUP BY text
        ), m AS (
            SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id
        ), o AS (
            SELECT part, (len(words) < 100)::INT AS a, (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
                (100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * length(d.text))::INT AS c,
                regexp_matches(d.text, '[#$%&*|]')::INT AS d, coalesce(doc_id > least, false)::INT AS e,
                coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM d JOIN least USING (text) LEFT JOIN m USING (doc_id)
        ), t AS (
            SELECT part, [a, b, c, d, e] AS failed, a + b + c + d + e AS n_failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM o GROUP BY part, a, b, c, d, e
        ), letters(k) AS (VALUES (1), (2), (3), (4), (5)
        ), orders AS (
            SELECT [p.k, q.k, r.k, s.k, u.k] AS ks, array_to_string([chr((64 + x)::INT) FOR x IN [p.k, q.k, r.k, s.k, u.k]], '') AS filter_order
            FROM letters p, letters q, letters r, letters s, letters u
            WHERE len(list_distinct([p.k, q.k, r.k, s.k, u.k])) = 5
        ), steps AS (
            SELECT filter_order, step, ks[step] AS own, ks[1:step - 1] AS earlier FROM orders, range(1, 6) x(step)
        ), f AS (
            SELECT part, filter_order, step, own,
                coalesce(sum(n) FILTER (failed[own] = 0 AND list_sum([failed[x] FOR x IN earlier || [own]]) = 0), 0) AS kept,
                coalesce(sum(n) FILTER (failed[own] = 1 AND coalesce(list_sum([failed[x] FOR x IN earlier]), 0) = 0), 0) AS removed,
                coalesce(sum(n) FILTER (failed[own] = 1 AND list_sum([failed[x] FOR x IN earlier]) > 0), 0) AS redundant,
                coalesce(sum(n) FILTER (failed[own] = 1 AND n_failed = 1), 0) AS unique_fails,
                coalesce(sum(good) FILTER (failed[own] = 1 AND coalesce(list_sum([failed[x] FOR x IN earlier]), 0) = 0), 0) AS good_lost,
                coalesce(sum(toxic) FILTER (failed[own] = 1 AND coalesce(list_sum([failed[x] FOR x IN earlier]), 0) = 0), 0) AS toxic_lost
            FROM t, steps GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
            unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
            (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM f
    """,
    "op12_substring_dedup": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
        ), windows AS (
            SELECT r, i, sha256(array_to_string(words[i:i + 34], ' ')) AS win
            FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)
        ), twice AS (
            SELECT win FROM windows GROUP BY win HAVING count(*) > 1
        ), gone AS (
            SELECT DISTINCT r, i + k AS i FROM windows JOIN twice USING (win), range(35) x(k)
        ), kept AS (
            SELECT d.r, string_agg(word, ' ' ORDER BY d.i) FILTER (gone.i IS NULL) AS text, count(gone.i) AS n
            FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d) d
            LEFT JOIN gone ON gone.r = d.r AND gone.i = d.i GROUP BY d.r
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)
    """,
}
