"""Reading catalogs, listings, pages and finished Markdown.  All paths go through Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import stem

CATALOG_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("numero", "nombre", "dof", "ultima_reforma", "pdf_url", "pdf_filename", "pdf_filename_origen", "md_slug")]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_catalog(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """A JSON array of entries, with ``pos`` in file order.

    A missing file is an empty catalog, or with ``strict`` an error.
    """
    if not path_exists(spark, path):
        if strict:
            raise FileNotFoundError(f"no catalog at {path}")
        return spark.createDataFrame([], CATALOG_SCHEMA).withColumn("pos", F.lit(0))
    whole = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", T.ArrayType(CATALOG_SCHEMA))
    return whole.select(F.posexplode(entries).alias("pos", "e")).select("e.*", "pos")


def read_html(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """(page_id, html): stored pages, decoded from ``encoding``."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("page_id"), F.decode("content", encoding).alias("html"))


def list_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, pdf_filename, length) in lexicographic order; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("pdf_filename"), "length").orderBy("path")


def existing_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """(md_slug): stems of the Markdown files in a folder."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "md_slug string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder)
    return files.select(stem(F.col("path")).alias("md_slug")).distinct()


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, content) of finished documents."""
    files = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    return files.select(stem(F.col("_metadata.file_path")).alias("doc_id"), F.col("value").alias("content"))
