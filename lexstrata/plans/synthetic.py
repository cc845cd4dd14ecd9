"""Legal-style lines made from the driver's documents, by one expression that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lines as L


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FORMS = [
    "'Artículo ' || CAST(line_no + 1 AS STRING) || '. ' || text",
    "'I. ' || text",
    "'a) ' || text",
    "'CAPÍTULO II'",
    "'DISPOSICIONES GENERALES'",
    "text || ' conforme al'",
    "'Artículo 7 ' || text",
    "'contri-'",
    "'buyente ' || text",
    "'Transitorios'",
    "'Primero.- ' || text",
    "'> ' || text",
    "'XIV. ' || text || ' fin: a) uno. b) dos'",
    "'| ' || text || ' |'",
    "''",
    "'ARTÍCULO SEGUNDO.- ' || text",
    "'Sección Primera De la ' || text",
    "'Transitorios Segundo. ' || text",
    "'Título IV Bis'",
    "'De la ' || lower(substr(text, 1, 30))",
    "text",
]
LEGAL = "CASE (doc_id + line_no) % {} {} END".format(len(_FORMS), " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_FORMS)))
FURNITURE = (
    "CASE line_no % 6 WHEN 0 THEN 'Secretaría General' WHEN 1 THEN text || ' del Código Penal Federal' "
    "WHEN 2 THEN 'Última Reforma DOF 01-01-2020' WHEN 3 THEN 'Ley del Impuesto sobre la Renta' ELSE text END"
)
MARKED = "text || ' 3 de ' || CAST(doc_id % 7 + 1 AS STRING) || ' fin 12 de 2024'"
HTML = (
    "'<table><tr><td>No.</td><td>Ley</td><td>Reforma</td><td><a href=\"x\">x</a></td></tr><tr><td>' || CAST(page_id AS STRING) "
    "|| '</td><td>LEY de  <b>Aguas &amp; Bosques</b> ' || CAST(page_id % 9 AS STRING) || ' DOF 05/02/1917 (Antes X)</td><td> DOF 01/02/20' "
    "|| CAST(10 + page_id % 10 AS STRING) || '</td><td><a href=\"doc/a.doc\">d</a> <a href=\"pdf/' "
    "|| CASE page_id % 3 WHEN 0 THEN 'LAB_120419' WHEN 1 THEN '123' ELSE 'CPF' END || '.pdf\">p</a></td></tr>"
    "<tr><td>x</td><td>y</td><td>z</td></tr></table>'"
)
REFORM = (
    "CASE o_orderkey % 5 WHEN 0 THEN 'Sin reforma' WHEN 1 THEN 'DOF ' || {date} WHEN 2 THEN 'DOF ' || {date} || ' Sentencia SCJN' "
    "WHEN 3 THEN 'Notificación ' || {date} || ' Sentencia SCJN' ELSE 'pendiente' END"
)
#: Words on a grid: an order is a picture, a line item a row of four words; rows are 40 apart.
OCR_WORD = (
    "CASE c WHEN 0 THEN CASE WHEN l_linenumber = 1 THEN 'Tarifa' WHEN l_linenumber = 2 THEN 'Limite' ELSE CAST(l_partkey AS STRING) END "
    "WHEN 1 THEN CASE WHEN l_linenumber = 1 THEN 'anual' WHEN l_linenumber = 2 THEN 'inferior' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END "
    "WHEN 2 THEN CASE WHEN l_linenumber <= 2 THEN 'cuota' ELSE CAST(l_suppkey AS STRING) || '%' END "
    "ELSE CASE WHEN l_linenumber % 6 = 5 THEN 'nota' ELSE '$' || CAST(l_linenumber AS STRING) END END"
)


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.explode_lines(table(spark, sf_dir, "documents"))


def legal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    # made inside the array, so that no filter behind it makes a line anew
    made = F.expr(f"transform(split(text, '\n'), (text, line_no) -> {LEGAL})")
    return docs.select("doc_id", F.posexplode(made).alias("line_no", "text"))


def ocr_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(img_id, i, text, conf, left, top, width, height).

    Items are dealt by picture first: they are fewer and smaller rows to shuffle than their words.
    """
    own = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").repartition("l_orderkey")
    items = own.groupBy("l_orderkey", "l_linenumber").agg(*(F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity")))
    texts = [F.expr(OCR_WORD.replace("CASE c ", f"CASE {c} ")) for c in range(4)]
    items = items.select("l_orderkey", "l_linenumber", F.posexplode(F.array(*texts)).alias("c", "text"))
    return items.select(
        F.col("l_orderkey").alias("img_id"),
        (F.col("l_linenumber") * 4 + F.col("c")).cast("int").alias("i"),
        "text",
        F.lit(90.0).alias("conf"),
        (F.col("c") * 100).cast("int").alias("left"),
        (F.col("l_linenumber") * 40 + F.col("c")).cast("int").alias("top"),
        F.lit(40).alias("width"),
        F.lit(12).alias("height"),
    )


# The same rows for the oracle.
SQL_LINES = "doc_lines AS (SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS line_no, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"
SQL_LEGAL = f"{SQL_LINES}, legal AS (SELECT doc_id, line_no, {LEGAL} AS text FROM doc_lines)"
SQL_WORDS = (
    f"words AS (SELECT l_orderkey AS img_id, CAST(l_linenumber * 4 + c AS INTEGER) AS i, {OCR_WORD} AS text, c * 100 AS lft, l_linenumber * 40 + c AS top, l_linenumber "
    "FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL), (SELECT unnest(range(4)) AS c))"
)
