"""Named queries of the corpus operators, and the same as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm import (
    decontaminate,
    filter_audit,
    hard_negatives,
    host_reputation,
    html_text,
    license_scan,
    ngram_join,
    oracle,
    packing,
    quality,
    sharding,
    substring_dedup,
    surrogates,
    warc_fixity,
)
from hourgrid.llm.common import read, stage

Query = Callable[[SparkSession, str], DataFrame]

#: On production the key is a secret of the caller.
KEY = "corpus"
ENCODER = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)
#: Hosts are blocked if the 5 % quantile of their share of bad pages lies above the share of all pages.
TAIL = 0.05
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace(read(spark, folder, "documents"), KEY).select("doc_id", "text", "n_entities")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeated_passages(read(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.ngram_components(read(spark, folder, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`pages` as an archive, and a replica with bytes changed, records cut short, lost, added and moved, all by page_id."""
    page, url, html = F.col("page_id").cast("bigint"), F.col("url"), F.col("html")
    changed = (
        F.when(page % 97 == 13, F.concat(F.lit("#"), F.substr(html, F.lit(2))))
        .when(page % 389 == 11, F.substr(html, F.lit(1), F.floor(F.length(html) / 2).cast("int")))
        .otherwise(html)
    )
    written = {
        "": warc_fixity.record(page, url, html),
        "_b": warc_fixity.record(page, url, changed),
        "_new": F.when(page % 307 == 5, warc_fixity.record(-page - 1, url, html)),
    }
    rows = pages.select(
        page.alias("number"),
        *(F.octet_length(r).cast("bigint").alias(f"bytes{k}") for k, r in written.items()),
        *(F.sha2(r, 256).alias(f"digest{k}") for k, r in written.items()),
    )
    first = stage(warc_fixity.laid_out(rows), "archive")
    moved = F.when(F.col("number") % 401 == 9, F.col("offset") + 7).otherwise(F.col("offset")).alias("offset")
    kept = first.where("number % 211 != 7").select("number", moved, F.col("bytes_b").alias("bytes"), F.col("digest_b").alias("digest"))
    added = first.where("number % 307 = 5").select(
        (-F.col("number") - 1).alias("number"),
        (F.col("offset") + F.col("bytes")).alias("offset"),
        F.col("bytes_new").alias("bytes"),
        F.col("digest_new").alias("digest"),
    )
    return first.select("number", "offset", "bytes", "digest"), kept.unionByName(added)


def op4_merkle_fixity_audit(spark: SparkSession, folder: str) -> DataFrame:
    return warc_fixity.audit(*replicas(read(spark, folder, "pages").select("page_id", "url", "html")))


def op5_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(read(spark, folder, "documents"))
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *shown)


def op6_composite_text_density(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages"))


def page_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, bad) of the pages whose document has labels; the number in a url's path names the document."""
    pages = read(spark, folder, "pages")
    number = F.regexp_extract(host_reputation.path_of(F.col("url")), r"/([0-9]+)", 1)
    placed = pages.select("page_id", number.alias("number"))
    placed = placed.select("page_id", F.expr("try_cast(number as bigint)").alias("doc_id"))
    labels = read(spark, folder, "labels")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad")
    return placed.join(labels.select("doc_id", bad), "doc_id").select("page_id", "bad")


def op7_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    judged = host_reputation.judge(read(spark, folder, "pages"), page_outcomes(spark, folder), RULES, None, TAIL)
    shown = (F.round(c, 6).alias(c) for c in ("share", "low"))
    return judged.select("page_id", "host", "path", "rule", "verdict", *shown)


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), ENCODER)


def op9_minimax_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read(spark, folder, "documents"), shards=16)


def op10_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"), window=10)
    items = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    count = F.size("items").cast("bigint").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", count, items, "contaminated")


def op11_hilbert_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.scaled(vectors.select("vec_id", shifted.alias("label"), "embedding"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(filter_audit.cells(read(spark, folder, "documents"), read(spark, folder, "labels")))


def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.scan(read(spark, folder, "documents"))
    labels = F.array_union("base_labels", F.col("matches.label"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("score"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_pii_surrogates,
        op2_substring_dedup,
        op3_ngram_jaccard_join,
        op4_merkle_fixity_audit,
        op5_robust_outliers,
        op6_composite_text_density,
        op7_host_reputation,
        op8_best_fit_packing,
        op9_minimax_sharding,
        op10_positional_index,
        op11_hilbert_hard_negatives,
        op12_filter_interaction_audit,
        op13_license_scan,
    )
}
#: Packing, sharding, extraction, surrogates and robust estimates have no plain counterpart: tests use brute force.
ORACLE: dict[str, str] = {
    "op2_substring_dedup": oracle.OP2,
    "op3_ngram_jaccard_join": oracle.OP3,
    "op4_merkle_fixity_audit": oracle.OP4,
    "op7_host_reputation": oracle.op7(RULES, TAIL, host_reputation.STRENGTH_RANGE, host_reputation.SUFFIXES),
    "op10_positional_index": oracle.OP10,
    "op11_hilbert_hard_negatives": oracle.OP11,
    "op12_filter_interaction_audit": oracle.OP12,
    "op13_license_scan": oracle.op13(license_scan.PHRASES, license_scan.TEMPLATES, 90, license_scan.BLOCK, license_scan.STEP),
}
