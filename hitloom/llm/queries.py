"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import (
    cover_dedup,
    disclosure,
    metric_join,
    projections,
    site_spread,
    source_divergence,
    subword_quality,
    swap_packing,
    templates,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from hitloom.llm.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE_LENGTH = 2048
COUNTED_TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Workspace(spark, "tokens").folder("files")
    tokenizer = public_tokenizers.path(TOKENIZER)
    token_files.write_token_files(documents(spark, sf_dir), folder, tokenizer, 2, SEQUENCE_LENGTH)
    return token_files.read_token_files(spark, folder, SEQUENCE_LENGTH)


def op2_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.contaminated(documents(spark, sf_dir), items).drop("text_hash")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_probabilities(docs, chain)
    return scored.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def op4_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find_spans(documents(spark, sf_dir))
    counts = [f"n_{kind}" for kind in disclosure.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op5_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return projections.nearest(vectors, F.col("vec_id") % 20 == 0)


def op6_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return subword_quality.quality_scores(documents(spark, sf_dir), labels)


def op7_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.pack(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), 0, SEQUENCE_LENGTH)


def op8_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_dedup.deduplicate(documents(spark, sf_dir))


def op9_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = site_spread.remove_boilerplate(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_lines", "n_removed_lines", F.md5("text").alias("kept_md5"))


def op10_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = metric_join.components(documents(spark, sf_dir), metric_join.Similarity(words=3, percent=90))
    return joined.select("doc_id", "n_shingles", "component_id")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A new cache for each run, so that a run's rows and work do not depend on those before it.
    cache = Workspace(spark, "token-cache").folder("counts")
    counted = token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(COUNTED_TOKENIZER), cache)
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=8)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(documents(spark, sf_dir))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_token_files": op1_token_files,
        "op2_templates": op2_templates,
        "op3_toxicity": op3_toxicity,
        "op4_disclosure": op4_disclosure,
        "op5_projections": op5_projections,
        "op6_subword_quality": op6_subword_quality,
        "op7_swap_packing": op7_swap_packing,
        "op8_cover_dedup": op8_cover_dedup,
        "op9_site_spread": op9_site_spread,
        "op10_metric_join": op10_metric_join,
        "op11_token_counts": op11_token_counts,
        "op12_whitening": op12_whitening,
        "op13_source_divergence": op13_source_divergence,
    }


SITE_SPREAD_SQL = """
WITH lines AS (
    SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents
),
filled AS (SELECT DISTINCT text, source, line, length(line) AS n FROM lines WHERE trim(line) <> ''),
widespread AS (SELECT line FROM filled GROUP BY line HAVING count(DISTINCT source) >= 8),
of_texts AS (
    SELECT t.text, sum(t.n) AS total, sum(CASE WHEN w.line IS NOT NULL THEN t.n ELSE 0 END) AS shared
    FROM (SELECT DISTINCT text, line, n FROM filled) t LEFT JOIN widespread w ON t.line = w.line GROUP BY t.text
),
copied AS (SELECT text FROM of_texts WHERE shared > 0.5 * total),
boilerplate AS (
    SELECT line FROM filled SEMI JOIN widespread USING (line) ANTI JOIN copied USING (text)
    GROUP BY line HAVING count(DISTINCT source) >= 8
),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text, count(*) AS n
    FROM lines ANTI JOIN boilerplate USING (line) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
    CAST(coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed_lines,
    CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS kept_md5
FROM documents d LEFT JOIN kept k USING (doc_id)
"""


SOURCE_DIVERGENCE_SQL = """
WITH plain AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM plain),
langs AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
lang_totals AS (SELECT lang, sum(n) AS n, CAST(count(*) AS HUGEINT) AS v FROM langs GROUP BY lang),
held AS (
    SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n
    FROM words w JOIN langs l ON w.lang = l.lang AND w.term = l.term GROUP BY ALL
),
sources AS (
    SELECT s.lang, s.source, coalesce(h.n, 0) AS n, coalesce(t.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM plain) s
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM held GROUP BY ALL) h ON s.lang = h.lang AND s.source = h.source
    LEFT JOIN lang_totals t ON s.lang = t.lang
),
shares AS (
    SELECT s.lang, s.source, l.term, coalesce(h.n, 0) AS own,
        1 + 1000000000 * (coalesce(h.n, 0) + 1) // (s.n + s.v) AS p,
        1 + 1000000000 * (l.n + 1) // (t.n + t.v) AS q
    FROM sources s JOIN langs l ON s.lang = l.lang JOIN lang_totals t ON s.lang = t.lang
    LEFT JOIN held h ON h.lang = s.lang AND h.source = s.source AND h.term = l.term
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE own > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 200
"""


def llm_oracles() -> dict[str, str]:
    """Where SQL can express the operator; the others are tested against brute force in tests/llm."""
    return {"op9_site_spread": SITE_SPREAD_SQL, "op13_source_divergence": SOURCE_DIVERGENCE_SQL}
