"""The queries of this subpackage: thin wrappers that apply each operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, language_id, license_scan, lm_score, oracles, packing, pii, quality, substring_dedup, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in source/<thousands>/<tens>/<doc_id>; one that opens with a licence
    line speaks for its folder."""
    i = F.col("doc_id")
    path = F.concat_ws("/", "source", F.floor(i / 1000).cast("string"), F.floor(F.pmod(i, F.lit(1000)) / 10).cast("string"), i.cast("string"))
    opens = F.coalesce(F.substring_index("text", "\n", 1).rlike("(?i)licensed under|public license"), F.lit(False))
    return license_scan.scan(table(spark, sf_dir, "documents"), path, opens)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.where(~language_id.held_out(F.col("doc_id"))).select(F.col("lang").alias("label"), "text")
    out = language_id.predict(docs, language_id.train(learn))
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_spans(table(spark, sf_dir, "documents"))
    counts = [pii.count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.BASE]
    return out.select("doc_id", *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_near_copies(table(spark, sf_dir, "documents"), k=5, percent=75)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), order=3, discount=0.4)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), host="source")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: Fixed values of the contract: (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), max_tokens=4096, closing_id=2)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_license_scan": op2_license_scan,
        "op3_language_id": op3_language_id,
        "op4_pii": op4_pii,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_lm_score": op6_lm_score,
        "op7_quality_rules": op7_quality_rules,
        "op8_url_filters": op8_url_filters,
        "op9_packing": op9_packing,
        "op10_decontamination": op10_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
