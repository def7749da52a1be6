"""The dealt operators as registered queries over whole tables, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from panelwatch.llm import compression_quality, decontaminate, hilbert, html_extract, maxent_lm, near_dedup, quality, sentencepiece_codec, source_audit, token_cache, toxicity, url_filter, whitening
from panelwatch.llm.common import table

#: rules of the URL query: host, path, verdict (fixed values)
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: hosts that the filter's own list blocks where no rule fits
URL_BLOCKED = (("spam-farm.example.org", "/"), ("cheap-pills.example.com", "/"))


def op1_decontamination(spark, sf_dir):
    """Verbatim benchmark matches in every document."""
    out = decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_sentencepiece(spark, sf_dir):
    """Every document's ids, and whether decoding them gives the text back
    (with U+2581, the space mark itself, read as a space)."""
    docs = table(spark, sf_dir, "documents")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.round_trip(docs, model)


def op3_url_filter(spark, sf_dir):
    """Verdict of the URL filter for every page."""
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES, URL_BLOCKED)


def op4_quality_rules(spark, sf_dir):
    """Figures and verdicts of the quality rules for every document."""
    out = quality.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_lm_scoring(spark, sf_dir):
    """Model and base scores of every document; fold 2 of 7 is never learnt from."""
    return maxent_lm.lm_scores(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 7, 2))


def op6_near_duplicates(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def held_out(key, folds: int, fold: int):
    """Whether a row lies in the given fold by the checksum of its id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")), F.lit(0)) % folds == fold


def op7_toxicity(spark, sf_dir):
    """Toxicity score of every document; labels of fold 1 of 3 are never learnt from."""
    docs = table(spark, sf_dir, "documents")
    model, _ = toxicity.learn(docs, table(spark, sf_dir, "labels"), train_if=lambda key: ~held_out(key, 3, 1))
    return toxicity.toxicity_scores(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op8_sharding(spark, sf_dir):
    """Eight shards of all documents in Hilbert order."""
    return hilbert.hilbert_shards(table(spark, sf_dir, "documents"), 8)


def op10_token_counts(spark, sf_dir):
    """Token counts of every document, through a cache that starts empty."""
    return token_cache.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                    token_cache.cache_path(spark, uuid.uuid4().hex))


def op11_source_audit(spark, sf_dir):
    """Divergence of every source from the other sources and from its language."""
    return source_audit.source_divergence(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark, sf_dir):
    """Whitened leading components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_quality_classifier(spark, sf_dir):
    """Quality score of every document; labels of fold 0 of 5 are never learnt from."""
    docs = table(spark, sf_dir, "documents")
    model, rows = compression_quality.fit(docs, table(spark, sf_dir, "labels"), train_if=lambda key: ~held_out(key, 5, 0))
    return compression_quality.scored(rows, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_html_extraction": op9_html_extraction,
    "op10_token_counts": op10_token_counts,
    "op11_source_audit": op11_source_audit,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_quality_classifier": op13_quality_classifier,
}

OP1_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, s AS size, array_to_string(w[i:i + s - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 13) AS s, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
dw AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
hits AS (SELECT rid, item_id, i, dw.size FROM dw JOIN win ON dw.size = win.size AND dw.g = win.g),
words AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n, sha256(string_agg(name, ',' ORDER BY name)) AS s
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS name FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       coalesce(items.s, sha256('')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

OP3_SQL = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
listed(host, path) AS (VALUES ('spam-farm.example.org', '/'), ('cheap-pills.example.com', '/')),
p AS (
  SELECT row_number() OVER () AS rid, page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fit AS (
  SELECT rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY rid),
own AS (
  SELECT DISTINCT rid FROM p JOIN listed r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN own.rid IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fit USING (rid) LEFT JOIN own ON own.rid = p.rid
"""

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))

OP4_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cover AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines, len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN cover USING (rid)),
g AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(
         word_chars / n_words BETWEEN 1.5 AND 25 AND n_symbols / n_words <= 0.5 AND n_dup_lines / n_lines <= 0.5
         AND n_stop / n_words >= 0.02 AND n_upper / word_chars <= 0.6, false) AS kept
FROM g
"""

OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cnt AS (
  SELECT lang, source, term, coalesce(n.n, 0) AS n, v.v, sum(coalesce(n.n, 0)) OVER (PARTITION BY lang, source) AS total
  FROM grp JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v))::HUGEINT AS p FROM cnt),
q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v))::HUGEINT AS q
  FROM (SELECT lang, term, v, sum(n) AS n FROM cnt GROUP BY lang, term, v)),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE = {
    "op1_decontamination": OP1_SQL,
    "op3_url_filter": OP3_SQL,
    "op4_quality_rules": OP4_SQL,
    "op11_source_audit": OP11_SQL,
}
