"""The three pipelines end to end: catalog from HTML, documents from pages, coverage index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalog as C
from ..operators import lines as L
from ..operators import structure as S
from ..operators import tables as B


def entry_slug(entries: DataFrame) -> DataFrame:
    """Entries with ``md_slug`` from the older ``slug`` where it is missing, else empty.

    A null counts as missing (the published tool only looks whether the key is there).
    """
    for name in ("md_slug", "slug"):
        if name not in entries.columns:
            entries = entries.withColumn(name, F.lit(None).cast("string"))
    return entries.withColumn("md_slug", F.coalesce("md_slug", "slug", F.lit(""))).drop("slug")


def catalog_from_html(pages: DataFrame) -> DataFrame:
    """(page_id, html) -> catalog entries; positions follow the table rows of each page."""
    return C.build_catalog(C.html_rows(pages))


def picture_lines(pages: DataFrame, words: DataFrame | None) -> DataFrame:
    """(doc_id, page, region, md) of picture regions: the table in ``words`` (img_id, i, text,
    conf, left, top, width, height), or a line that stands for it."""
    images = pages.where("kind = 'picture'").select("img_id", "doc_id", "page", "region")
    instead = B.with_placeholder(images, images.select("img_id", F.lit(None).cast("array<string>").alias("md")).limit(0) if words is None else B.build_tables(words))
    return images.join(instead.select("img_id", "md"), "img_id")


def convert(pages: DataFrame, catalog: DataFrame, existing: DataFrame | None = None, limit: int = 0, strict: bool = False, words: DataFrame | None = None) -> DataFrame:
    """(pdf_filename, md_slug, status, content) of every file in ``pages``.

    ``pages``: (pdf_filename, page, region, text, total_pages), and where there are pictures
    kind (text, picture or error) and img_id, whose recognised ``words`` become tables in
    their places.  The limit takes the first files by name before finished ones are skipped.
    A file's name is its catalog entry's md_slug, else its own.  Files without a line, or
    with a row of kind error, fail and leave the others alone.  status: converted, skipped
    or failed.
    """
    if "kind" not in pages.columns:
        pages = pages.withColumn("kind", F.lit("text"))
    files = pages.groupBy("pdf_filename").agg(F.coalesce(F.bool_or(F.col("kind") == "error"), F.lit(False)).alias("broken"))
    if limit:
        files = files.orderBy("pdf_filename").limit(limit)
    named = C.catalog_lookup(entry_slug(catalog)).select("pdf_filename", F.nullif("md_slug", F.lit("")).alias("own"))
    files = files.join(named, "pdf_filename", "left").select("pdf_filename", "broken", F.coalesce("own", T.stem(F.col("pdf_filename"))).alias("md_slug"))
    done = files.select("md_slug").limit(0) if existing is None else existing.select("md_slug").distinct()
    todo = files.where("not broken").join(done, "md_slug", "left_anti")
    mine = pages.join(todo, "pdf_filename", "left_semi").withColumnRenamed("pdf_filename", "doc_id")
    pictures = picture_lines(mine, words) if "img_id" in pages.columns else None
    lines = L.page_lines(mine.where("kind = 'text'"), pictures)
    titles = C.enrich_files(todo, catalog).select(F.col("pdf_filename").alias("doc_id"), "title")
    filled = lines.select("doc_id").distinct()
    texts = S.render(S.markdown(lines, strict), titles.join(filled, "doc_id", "left_semi")).withColumnRenamed("doc_id", "pdf_filename")
    out = files.join(texts, "pdf_filename", "left").join(done.withColumn("done", F.lit(True)), "md_slug", "left")
    status = F.when(F.col("done"), "skipped").when(F.col("content").isNotNull(), "converted").otherwise("failed")
    return out.select("pdf_filename", "md_slug", status.alias("status"), "content")
