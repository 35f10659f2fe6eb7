"""One query per operator, over its whole table; they derive the digest columns from the operators' results.

``ORACLE_SQL`` has SQL where it can express the result on whole tables: op4, whose test pages hold no redirects
and no canonical links. The others are tested against brute force, round trips or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import (
    bpe,
    html_extraction,
    language,
    packing,
    period_runs,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    suffix_tree,
    unigram,
    url_filter,
    vector_dedup,
)

BPE_FILE = public_tokenizers.path("word_bpe_49k.json")
UNIGRAM_FILE = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = (
    "allow org/",
    "block example.org/es/",
    "block example.org/en/1",
    "allow com/fr/",
    "block com/de/",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"]
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", *names)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), BPE_FILE))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), [url_filter.parse(r) for r in URL_RULES])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"), UNIGRAM_FILE)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), BPE_FILE)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = docs.withColumn("held_out", language.held_out())
    model = language.train(held.where("not held_out").select("text", "lang"))
    return language.predict(docs, model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def with_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words as they are, or for about one document in ten with their end made periodic; a null doc_id changes nothing."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_runs.digests(period_runs.period_runs(table(spark, sf_dir, "documents"), with_period))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = suffix_tree.score(docs, ~suffix_tree.held_out() & F.col("doc_id").isNotNull())
    return scored.select(
        "doc_id",
        suffix_tree.held_out().alias("held_out"),
        *["n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    graft = conv - F.pmod(conv, F.lit(20)), F.crc32(conv.cast("string")) % 4
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), graft)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_packing,
        op3_html_extraction,
        op4_url_filters,
        op5_token_counts,
        op6_embedding_near_dedup,
        op7_simhash_near_dedup,
        op8_bpe,
        op9_language_id,
        op10_secret_scans,
        op11_periodic_runs,
        op12_lm_scores,
        op13_conversation_trie,
    )
}


def _url_sql() -> str:
    rules = ", ".join(
        f"('{r.host}', '{r.path}', '{r.name}', '{r.verdict}')" for r in map(url_filter.parse, URL_RULES)
    )
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH rules(h, p, name, v) AS (VALUES {rules}),
      parts AS (SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
      SELECT page_id, host, path, arg_max(name, length(name)) AS rule,
        coalesce(arg_max(v, length(name)), 'allow') AS verdict
      FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
      GROUP BY page_id, host, path"""


ORACLE_SQL: dict[str, str] = {"op4_url_filters": _url_sql()}
