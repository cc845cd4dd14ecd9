"""HTML tables to a catalog of laws, and the catalog against what is already converted."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Where the published catalog lies.
BASE_URL = "https://www.diputados.gob.mx/LeyesBiblio/"

_ROW = r"(?is)<tr\b[^>]*>((?:(?!<tr\b).)*?)</tr\s*>"
_CELL = r"(?is)<td\b[^>]*>((?:(?!<td\b).)*?)</td\s*>"
_HREF = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,30});"
#: The six references of the SQL of html_cell_text.
BASIC_REFERENCE = "&(?:nbsp|lt|gt|quot|amp|#39);"


def _character(reference: Column) -> Column:
    """The character of a reference; one that names none stays as it is."""
    body = F.substring(reference, F.lit(2), F.char_length(reference) - 2)
    code = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 6), 16, 10)).otherwise(F.substring(body, 2, 7)).try_cast("long")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    names = F.create_map(*(F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))), F.lit("apos"), F.lit("'"))
    return F.coalesce(F.when(body.startswith("#"), numbered).otherwise(F.try_element_at(names, body)), reference)


def unescape(c: Column, reference: str = _REFERENCE) -> Column:
    """Character references of the pattern resolved, once (``&amp;lt;`` is ``&lt;``)."""
    between, found = F.split(c, reference), F.regexp_extract_all(c, F.lit(reference), F.lit(0))
    parts = F.transform(F.arrays_zip(between.alias("b"), found.alias("r")), lambda z: F.concat(z["b"], F.coalesce(_character(z["r"]), F.lit(""))))
    return F.when(c.contains("&"), F.array_join(parts, "")).otherwise(c)


def cell_text(html: Column, reference: str = _REFERENCE) -> Column:
    """Text of an HTML fragment: tags out, references resolved, white space squeezed."""
    return T.squeeze(unescape(F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", ""), reference))


def links(html: Column) -> Column:
    """Non-empty link targets in order."""
    return F.transform(F.regexp_extract_all(html, F.lit(_HREF), F.lit(1)), lambda x: unescape(x))


def title(html: Column) -> Column:
    return cell_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, pos, numero, nombre_raw, ultima_reforma, links) of table rows with four closed cells or more."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all("html", F.lit(_ROW), F.lit(1))).alias("pos", "row"))
    rows = rows.withColumn("cells", F.regexp_extract_all("row", F.lit(_CELL), F.lit(1))).where("size(cells) >= 4")
    text = lambda i: cell_text(F.get("cells", F.lit(i)))
    return rows.select(key, "pos", text(0).alias("numero"), text(1).alias("nombre_raw"), text(2).alias("ultima_reforma"), links(F.get("cells", F.lit(3))).alias("links"))


def first_pdf(found: Column) -> Column:
    """First link below ``pdf/`` that ends in ``.pdf``; null without one."""
    return F.get(F.filter(found, lambda x: x.startswith("pdf/") & x.endswith(".pdf")), F.lit(0))


def build_catalog(rows: DataFrame) -> DataFrame:
    """Catalog entries in row order; header rows and rows without a PDF are left out."""
    kept = rows.withColumn("href", first_pdf(F.col("links"))).withColumn("numero", T.strip(F.col("numero")))
    kept = kept.where((F.col("numero") != "") & (F.lower("numero") != "no.") & F.col("href").isNotNull())
    file = T.basename(F.col("href"))
    nombre = T.law_name(F.col("nombre_raw"))
    slug = T.md_slug(T.stem(file), nombre)
    return kept.select(
        "pos",
        "numero",
        nombre.alias("nombre"),
        T.law_date(F.col("nombre_raw")).alias("dof"),
        T.strip(F.col("ultima_reforma")).alias("ultima_reforma"),
        F.concat(F.lit(BASE_URL), "href").alias("pdf_url"),
        F.concat(slug, F.lit(".pdf")).alias("pdf_filename"),
        file.alias("pdf_filename_origen"),
        slug.alias("md_slug"),
    )


def catalog_lookup(catalog: DataFrame, key: str = "pdf_filename") -> DataFrame:
    """One entry per key: the last one."""
    last = Window.partitionBy(key).orderBy(F.col("pos").desc())
    return catalog.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def enrich_files(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """Files (pdf_filename) with title and reform date of their entry, or defaults from the file name."""
    own = catalog_lookup(catalog).select("pdf_filename", "nombre", "ultima_reforma")
    return files.join(own, "pdf_filename", "left").select(
        "pdf_filename",
        F.coalesce("nombre", T.default_title(T.stem(F.col("pdf_filename")))).alias("title"),
        F.coalesce("ultima_reforma", F.lit("")).alias("ultima_reforma"),
    )


def coverage_index(catalog: DataFrame, existing: DataFrame, key: str = "md_slug") -> DataFrame:
    """The catalog in its order with ``md_link``: a link where an output exists, a dash elsewhere."""
    have = existing.select(F.col(key).alias("_have")).distinct()
    link = F.concat(F.lit("[`"), key, F.lit(".md`](markdown/"), key, F.lit(".md)"))
    joined = catalog.join(have, F.col(key) == F.col("_have"), "left")
    return joined.withColumn("md_link", F.when(F.col("_have").isNotNull(), link).otherwise("—")).drop("_have")


def coverage_summary(catalog: DataFrame, existing: DataFrame, key: str = "md_slug", strict: bool = True) -> DataFrame:
    """(total, done, pct): whole per cent; null for an empty catalog.

    ``strict`` counts catalog entries that have an output, else all outputs.
    """
    outputs = existing.select(key).distinct()
    counted = catalog.join(outputs, key, "left_semi") if strict else outputs
    both = catalog.select(F.lit(1).alias("t"), F.lit(0).alias("d")).union(counted.select(F.lit(0), F.lit(1)))
    sums = both.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("total"), F.coalesce(F.sum("d"), F.lit(0)).alias("done"))
    return sums.select("total", "done", F.expr("done * 100 div nullif(total, 0)").alias("pct"))


def without_output(catalog: DataFrame, existing: DataFrame, key: str = "md_slug", limit: int = 0) -> DataFrame:
    """Entries to convert: the first ``limit`` (0: all) by position, then those without output."""
    chosen = catalog.orderBy("pos").limit(limit) if limit else catalog
    return chosen.join(existing.select(key), key, "left_anti")


def with_output(catalog: DataFrame, existing: DataFrame, key: str = "md_slug") -> DataFrame:
    return catalog.join(existing.select(key), key, "left_semi")


def listing(catalog: DataFrame) -> DataFrame:
    """One line per entry: number right-aligned to three (never cut), name cut to 80."""
    number = F.when(F.char_length("numero") < 3, F.lpad("numero", 3, " ")).otherwise(F.col("numero"))
    return catalog.select("pos", F.concat(number, F.lit(". "), F.substring("nombre", 1, 80)).alias("line"))


def progress_labels(entries: DataFrame, order: str) -> DataFrame:
    """Adds ``label``: [i/n], counted from one in ``order``.  For reports: it needs one global order."""
    i, n = F.row_number().over(Window.orderBy(order)), F.count("*").over(Window.partitionBy())
    return entries.withColumn("label", F.format_string("[%d/%d]", i, n))


def status_counts(results: DataFrame, status: str = "status") -> DataFrame:
    """One row (converted, skipped, failed)."""
    one = lambda s: F.count_if(F.col(status) == s).alias(s)
    return results.agg(one("converted"), one("skipped"), one("failed"))
