"""A training corpus from raw documents: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are
written as Parquet in the shared checkpoint folder and read again, so a stage starts from a
scan and a lost executor costs one task.  All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexstrata.llm import decontaminate, jaccard_join, language_id, packing, pii
from lexstrata.llm.queries import table, tokenizer_path
from lexstrata.llm.scratch import Scratch

#: Text of no known language scores far below this, text mixed of known ones above.
MIN_LANGUAGE_SCORE = 0.1


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; null texts and texts without a letter go."""
    learn = docs.where(~language_id.held_out(F.col("doc_id"))).select(F.col("lang").alias("label"), "text")
    model = language_id.train(learn)
    if not model.labels:  # nothing to learn from, so nothing is rejected but what has no letter
        return docs.where(language_id.has_letter(F.col("text").cast("string")))
    judged = language_id.annotate(docs, model, F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    kept = judged.where((F.col("lang_pred") != language_id.UND) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies; one row of repeated ones.

    Rows that share a doc_id but not the text are documents of their own.  Documents
    without doc_id, and those without words, stay.
    """
    tmp = Scratch(spark, "near")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("key"), row)
    again = tmp.save(named.groupBy("id").count().where("count > 1").select("id"), "again")
    if again.isEmpty():
        linked = jaccard_join.link_near_copies(docs)
        gone = linked.where("doc_id != component_id").select(F.col("doc_id").alias("id"))
        kept = named.join(gone, "id", "left_anti")
    else:
        # ids do not name documents here: each pair of id and text gets a number and is linked by that
        nodes = named.select("id", "key", F.col("row.text").cast("string").alias("text")).dropDuplicates(["id", "key"])
        nodes = tmp.save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        linked = jaccard_join.link_near_copies(nodes.select(F.col("node").alias("doc_id"), "text"))
        linked = linked.select(F.col("doc_id").alias("node"), "component_id").join(nodes.select("node", "id", "key"), "node")
        best = linked.groupBy("component_id").agg(F.min(F.struct("id", "key")).alias("l"))
        best = tmp.save(best.select("l.id", "l.key"), "best")
        kept = named.join(best, ["id", "key"]).dropDuplicates(["id", "key"])
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows the text."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids, none of which crosses documents."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", keep_known_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: Language model, span classifier and tokenizer are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    tmp = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tmp.save(stage(spark, docs, sf_dir), name)
    return docs
