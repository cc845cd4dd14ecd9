"""Documents and pages to clean lines: (doc_id, line_no, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import all_caps, let, squeeze, strip, strip_cheaply


def explode_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of every document; null text has none."""
    return docs.select("doc_id", F.posexplode(F.split(text, "\n")).alias("line_no", "text"))


def lines_by_document(docs: DataFrame, text: str = "text") -> DataFrame:
    """``explode_lines`` on documents dealt by ``doc_id`` first.

    What works per document after this needs no further shuffle, and whole texts are
    fewer and smaller rows to shuffle than their lines.
    """
    return explode_lines(docs.repartition("doc_id"), text)


def page_lines(pages: DataFrame, pictures: DataFrame | None = None) -> DataFrame:
    """Extracted pages (doc_id, page, region, text, total_pages) to lines in reading order.

    Page markers go, lines are stripped, blank ones dropped, page furniture left out.
    ``pictures`` (doc_id, page, region, md: array of lines) stand between the regions of
    text as they are.
    """
    # a line is cleaned inside the array: a filter behind it would clean it anew for each of its tests
    clean = F.transform(F.split("text", "\n"), lambda line, n: F.struct(n.alias("n"), clean_markers(line, F.col("total_pages")).alias("text")))
    kept = F.filter(clean, lambda e: (e["text"] != "") & ~is_furniture(e["text"]))
    each = pages.select("doc_id", "page", "region", F.inline(kept))
    if pictures is not None:
        each = each.unionByName(pictures.select("doc_id", "page", "region", F.posexplode("md").alias("n", "text")))
    order = Window.partitionBy("doc_id").orderBy("page", "region", "n")
    return each.select("doc_id", (F.row_number().over(order) - 1).alias("line_no"), "text")


def clean_markers(line: Column, total_pages: Column, strict: bool = False) -> Column:
    """Without page markers such as ``12 de 313``; the pattern follows the document's page count."""
    left, right = (r"(?<!\d)", r"(?!\d)") if strict else ("", "")
    pattern = F.concat(F.lit(rf"(?U)\s*{left}\d{{1,4}}\s+de\s+"), total_pages.cast("string"), F.lit(rf"{right}\s*"))
    may = total_pages.isNull() | (F.contains(line, F.lit("de")) & F.contains(line, total_pages.cast("string")))
    return let(F.when(may, F.regexp_replace(line, pattern, F.lit(" "))).otherwise(line), strip_cheaply)


def is_furniture(line: Column, strict: bool = False) -> Column:
    """Whether a line is page furniture: fixed texts, the law's title, its reform date."""
    title = (P.STRICT if strict else P.COMPAT).title_line

    def test(text: Column) -> Column:
        fixed = F.lit(False)
        for words in P.FURNITURE:
            fixed = fixed | text.contains(words)
        return fixed | text.rlike(title) | text.rlike(P.REFORM_LINE)

    return let(strip_cheaply(line), test)


def running_headers(lines: DataFrame, strict: bool = False) -> DataFrame:
    """(doc_id, header, n): the most frequent long upper-case line of documents that repeat it thrice.

    Of equally frequent ones the first to appear wins.  Counts are pre-aggregated.
    """
    least = (P.STRICT if strict else P.COMPAT).running_length
    long_caps = lambda text: (F.char_length(text) >= least) & all_caps(text, 4)
    caps = lines.where(let(strip_cheaply(F.col("text")), long_caps))
    counts = caps.groupBy("doc_id", squeeze(F.col("text")).alias("header")).agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    best = counts.groupBy("doc_id").agg(F.min(F.struct((-F.col("n")).alias("k"), "first", "header")).alias("b"))
    return best.select("doc_id", "b.header", (-F.col("b.k")).alias("n")).where("n >= 3")


def drop_running_headers(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Lines without their document's running header, alone on a line or inside it."""
    joined = lines.join(running_headers(lines, strict).select("doc_id", "header"), "doc_id", "left")
    text = strip_cheaply(F.col("text"))
    joined = joined.where(F.col("header").isNull() | (squeeze(F.col("text")) != F.col("header")))
    inside = F.when(F.contains(text, F.col("header")), strip(F.replace(text, F.col("header"), F.lit(" ")))).otherwise(text)
    return joined.select("doc_id", "line_no", F.when(F.col("header").isNull(), F.col("text")).otherwise(inside).alias("text"))


def image_tables(pages: DataFrame) -> DataFrame:
    """Pages (images array, n_tables) that hold a table as a picture: large image, no vector table."""
    big = lambda i: (F.abs(F.coalesce(i["x1"], F.lit(0.0)) - F.coalesce(i["x0"], F.lit(0.0))) > 200) & (F.abs(F.coalesce(i["y1"], F.lit(0.0)) - F.coalesce(i["y0"], F.lit(0.0))) > 100)
    return pages.withColumn("is_image_table", F.exists("images", big) & (F.col("n_tables") == 0))


def interleave(regions: DataFrame) -> DataFrame:
    """Text and picture regions (doc_id, page, y, kind, text) in reading order, as ``order_no``."""
    order = Window.partitionBy("doc_id", "page").orderBy("y", F.col("kind") != "text")
    return regions.withColumn("order_no", F.row_number().over(order))


def interleave(regions: DataFrame) -> DataFrame:
    """Text and picture regions (doc_id, page, y, kind, text) in reading order, as ``order_no``."""
    order = Window.partitionBy("doc_id", "page").orderBy("y", F.col("kind") != "text")
    return regions.withColumn("order_no", F.row_number().over(order))
