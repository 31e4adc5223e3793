"""Registered queries of the corpus operators, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from flowsieve.llm import (
    alignment, byte_bpe, decontamination, line_dedup, maxent, prefix_pieces, quality_rules, recompression, sharding, simhash, spelling,
    token_counts, url_filter,
)
from flowsieve.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The rules of the URL query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
BYTE_RANKS, PIECES, BYTE_LEVEL = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_50k.json"
SHARDS = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)


@register("op1_url_filter", f"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(h, p, a) AS (VALUES {_RULE_ROWS}),
best AS (SELECT host, path, max_by(h || p, length(h || p) * 1000 + length(h)) AS rule, max_by(a, length(h || p) * 1000 + length(h)) AS verdict
         FROM (SELECT DISTINCT host, path FROM parts) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
         GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
""")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@register("op2_byte_bpe")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS))


@register("op3_maxent_scores")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_texts(table(spark, sf_dir, "documents"))


@register("op4_rendezvous_shards")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
    )
    placed = sharding.assign_shards(rows, "doc_id", [1.0] * SHARDS, grown=[1.0])
    return sharding.number_slots(placed, ["doc_id", "text_crc32", "size"], SHARDS)


@register("op5_decontamination")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _quality_sql() -> str:
    """Counts by unnested words, lines and windows; the exact binomial tail by log-gamma."""
    share = quality_rules.RISK / len(quality_rules.RULES)
    rows = ", ".join(
        f"('{rule}', {c})" for rule, cutoffs in quality_rules.CUTOFFS.items() for c in cutoffs
    )
    hit = " OR ".join(
        f"(rule = '{rule}' AND ({top} * 1000 - cutoff * {bottom}) * {way} > 0)" for rule, (top, bottom, way) in quality_rules.RULES.items()
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(3) t(k) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
f AS (SELECT doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM d JOIN w USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN lc USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
rules(rule, cutoff) AS (VALUES {rows}),
truth AS (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
tests AS (SELECT lang, rule, cutoff, count(*) FILTER (q = 1) AS n, count(*) FILTER (q = 1 AND ({hit})) AS k, count(*) FILTER (q <> 1 AND ({hit})) AS caught
          FROM b JOIN truth USING (doc_id), rules WHERE NOT base_failed GROUP BY ALL),
tails AS (SELECT lang, rule, cutoff, k, caught, any_value(n) AS n,
                 sum(exp(lgamma(n + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - CASE WHEN n > i THEN lgamma(n - i + 1) ELSE 0 END + i * ln({share}) + (n - i) * ln(1 - {share}))) AS tail
          FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM tests WHERE k < n * {share} AND caught > k) GROUP BY lang, rule, cutoff, k, caught),
best AS (SELECT lang, rule, cutoff FROM tails WHERE tail <= {quality_rules.DELTA} / (SELECT greatest(count(*), 1) FROM tests)
         QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY caught - k DESC, CASE WHEN rule = 'short_words' THEN cutoff ELSE -cutoff END) = 1),
bad AS (SELECT DISTINCT doc_id FROM b JOIN best USING (lang) WHERE {hit})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM b
"""


@register("op6_quality_rules", _quality_sql())
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    features, cutoffs = quality_rules.calibrate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    judged = quality_rules.with_verdict(features, cutoffs, "lang")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op9_token_counts")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


@register("op7_simhash_components")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components_of(table(spark, sf_dir, "documents"))


@register("op8_line_dedup", f"""
WITH l AS (SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
           FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
hot AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
j AS (SELECT doc_id, i, line, coalesce(last = doc_id, true) AS stays FROM l LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256 FROM j GROUP BY doc_id
""")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op10_recompression", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(20) t(k)),
word AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recompression.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op11_prefix_pieces")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


@register("op12_tokenizer_alignment")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), *paths)


@register("op13_spelling_variants")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
