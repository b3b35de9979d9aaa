"""The query of each operator over its whole table, and SQL where it can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from warcloom.llm import op01_suffixes, op02_weighted_minhash, op03_cover, op04_hidden_markov, op05_secrets, op06_language, op07_packing, op08_edit_counts, op09_flat_graph, op10_latent_leaks
from warcloom.llm import op11_block_max, op12_disclosure, op13_fill_in_middle


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


def op2_minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_weighted_minhash.classes(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_cover.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_hidden_markov.score(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_language.identify(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_packing.pack_documents(_table(spark, sf_dir, "documents"))


def op8_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_edit_counts.count_edits(_table(spark, sf_dir, "documents"))


def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_flat_graph.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_latent_leaks.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_block_max.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_disclosure.find_private(_table(spark, sf_dir, "documents"))


def op13_fill_in_middle_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_fill_in_middle.digests(_table(spark, sf_dir, "documents"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


OPERATORS = (
    op1_suffix_dedup,
    op2_minhash_classes,
    op3_substring_dedup,
    op4_hidden_markov_scores,
    op5_secret_scan,
    op6_language_id,
    op7_best_fit_packing,
    op8_edit_token_counts,
    op9_embedding_near_duplicates,
    op10_benchmark_leaks,
    op11_block_max_search,
    op12_private_spans,
    op13_fill_in_middle_digests,
)

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES = {
    "op11_block_max_search": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
d AS (SELECT r, doc_id, len(ts) AS n, ts FROM docs WHERE len(ts) > 0),
total AS (SELECT count(*) AS big, CAST(sum(n) AS BIGINT) AS len FROM d),
items AS (SELECT row_number() OVER () AS q, item_id, list_distinct({_TERMS}) AS ts FROM benchmark),
it AS (SELECT q, item_id, unnest(ts) AS term FROM items),
words AS (SELECT r, unnest(ts) AS term FROM d),
p AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM it) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, total GROUP BY term, big),
scores AS (
  SELECT q, item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big) // len)))) AS BIGINT) AS score
  FROM it JOIN p USING (term) JOIN w USING (term) JOIN d USING (r), total GROUP BY q, item_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN d USING (r) WHERE score > 0 QUALIFY rank <= 50""",
    "op13_fill_in_middle_digests": """
WITH given AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
hashed AS (
  SELECT doc_id, text, length(text) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM given),
planned AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
cut AS (SELECT *, left(text, CAST(a AS INTEGER)) AS p, substr(text, a + 1, z - a) AS m, substr(text, z + 1) AS s FROM planned)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM cut""",
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
