"""The registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import collocations, decontaminate, hard_negatives, language_model, licenses, lines, mixing, quality_rules, rule_ensemble, simhash, substrings, token_files, urls


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, max_bits=4).select(
        "doc_id", "fingerprint", "component_id"
    )


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with a repeated passage; the others have none."""
    found = substrings.repeats(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chunks", "repeated_words", "removed_words", "firsts",
        F.size("spans").alias("n_spans"), F.size("removed").alias("n_removed"),
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "line", "family", "probability", "similarity", "word")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), total_share=1.5, limit=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_read(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminations(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "distance", "edits")


#: Rules of the URL query, and of its SQL.
URL_RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of the pages whose page_id is divisible by 50; every page is judged."""
    pages = _read(spark, sf_dir, "pages")
    return urls.filter_urls(pages, pages.where(F.col("page_id") % 50 == 0), URL_RULES)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr",
    )


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.dedup_lines(_read(spark, sf_dir, "documents"))
    return left.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_deleted",
        F.size(F.split("text", "\n", -1)).alias("n_lines_left"),
        F.length("text").alias("n_chars_left"),
        F.xxhash64("text").alias("text_digest"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"), most_words=3, min_count=10, top=2000, cover_percent=50)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose vec_id is divisible by 7 go under the next label; anchors are every hundredth id."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _read(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, anchor_every=100, positives=5, negatives=10, window=(30, 90))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' ids written into a new folder and read back from its files."""
    import public_tokenizers

    folder = token_files.new_folder(spark)
    token_files.write_tokens(_read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(spark, folder, with_ids=False)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_substrings": op2_substrings,
    "op3_licenses": op3_licenses,
    "op4_mixing": op4_mixing,
    "op5_language_model": op5_language_model,
    "op6_decontaminate": op6_decontaminate,
    "op7_urls": op7_urls,
    "op8_quality_rules": op8_quality_rules,
    "op9_rule_ensemble": op9_rule_ensemble,
    "op10_lines": op10_lines,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_files": op13_token_files,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB SQL where it can express an operator; the others are tested against brute force.
SQL: dict[str, str] = {
    "op7_urls": r"""
WITH parts AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS params
  FROM pages),
named AS (
  SELECT page_id, host, path, CASE WHEN contains(url, '://') THEN
    regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
  FROM parts),
listed AS (SELECT DISTINCT canonical FROM named WHERE page_id % 50 = 0 AND canonical IS NOT NULL),
rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
ruled AS (
  SELECT n.page_id, n.host, n.path, n.canonical,
    (SELECT max_by(r.host || r.path, length(r.host || r.path)) FROM rules r
     WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)) AS rule
  FROM named n)
SELECT page_id, u.host, u.path, rule, coalesce(r.verdict, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled u LEFT JOIN rules r ON rule = r.host || r.path LEFT JOIN listed l ON u.canonical = l.canonical
""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT doc_id, text, lang, row_number() OVER () AS pid, piece FROM (
    SELECT doc_id, text, coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
words AS (SELECT lang, pid, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) ks(k))
  GROUP BY ALL),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2 AND a >= 10),
covered AS (
  SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inner_phrase FROM cand WHERE k = 3) t
  ON c.lang = t.lang AND c.phrase = t.inner_phrase AND 100 * t.a >= 50 * c.a),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut+1:k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand ANTI JOIN covered USING (lang, phrase))),
scored AS (
  SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r,
    ((1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT) // (l.a::HUGEINT * r.a::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN grams l ON c.lang = l.lang AND c.lp = l.phrase JOIN grams r ON c.lang = r.lang AND c.rp = r.phrase),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op12_hard_negatives": """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
  s.id AS negative_id, positive_score, s.score AS negative_score
FROM positives JOIN scores s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
""",
}
