"""The pipelines end to end and their command line."""

import pytest
from lexstrata import __main__ as cli
from lexstrata.plans import convert as X
from lexstrata.sources import ocr
from pyspark.sql import functions as F

HTML = """<table><tr><td>No.</td><td>Ley</td><td>Reforma</td><td><a href="pdf/x.pdf">x</a></td></tr>
<tr><td>1</td><td>LEY de Amnistía DOF 22/04/2020</td><td>Sin reforma</td><td><a href="doc/a.doc">d</a><a href="pdf/LAmn.pdf">p</a></td></tr>
<tr><td>2</td><td>LEY sin archivo</td><td>-</td><td><a href="x">p</a></td></tr></table>"""


def pages(spark):
    rows = [
        ("LAmn_ley_de_amnistia.pdf", 1, 0, "Secretaría General\nTÍTULO PRIMERO\nDISPOSICIONES\n1 de 2", 2),
        ("LAmn_ley_de_amnistia.pdf", 2, 0, "Artículo 1. La pre-\nsente Ley.", 2),
        ("b.pdf", 1, 0, "x", 1),
        ("empty.pdf", 1, 0, "  ", 1),
    ]
    return spark.createDataFrame(rows, "pdf_filename string, page int, region int, text string, total_pages int")


def catalog(spark):
    return X.catalog_from_html(spark.createDataFrame([("p", HTML)], "page_id string, html string"))


def test_convert(spark):
    done = spark.createDataFrame([("b",)], "md_slug string")
    out = {r["pdf_filename"]: r for r in X.convert(pages(spark), catalog(spark), done).collect()}
    assert {k: r["status"] for k, r in out.items()} == {"LAmn_ley_de_amnistia.pdf": "converted", "b.pdf": "skipped", "empty.pdf": "failed"}
    text = out["LAmn_ley_de_amnistia.pdf"]["content"]
    assert text.startswith("# LEY de Amnistía\n") and text.endswith("\n\n## TÍTULO PRIMERO — DISPOSICIONES\n\n### Artículo 1\n. La presente Ley.")
    assert X.convert(pages(spark), catalog(spark), limit=1).count() == 1


def test_entry_slug(spark):
    rows = spark.createDataFrame([("a", "b"), (None, "c"), (None, None)], "md_slug string, slug string")
    assert [r["md_slug"] for r in X.entry_slug(rows).collect()] == ["a", "c", ""]
    assert X.entry_slug(rows.drop("md_slug")).columns == ["md_slug"]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "i.html").write_bytes(HTML.encode("latin-1"))
    at = f"file://{tmp_path}"
    cli.main(["catalog", "--html", f"{at}/i.html", "--list"])
    assert capsys.readouterr().out == "  1. LEY de Amnistía\n"
    cli.main(["catalog", "--html", f"{at}/i.html", "--out", f"{at}/catalog"])
    pages(spark).write.parquet(f"{at}/pages")
    cli.main(["convert", "--pages", f"{at}/pages", "--catalog", f"{at}/catalog", "--out", f"{at}/md"])
    assert "{'converted': 2, 'skipped': 0, 'failed': 1}" in capsys.readouterr().out
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "LAmn_ley_de_amnistia.md").write_text("x")
    cli.main(["index", "--catalog", f"{at}/catalog", "--markdown", f"{at}/done", "--out", f"{at}/index", "--today", "01/01/2026"])
    text = next((tmp_path / "index").glob("part-*")).read_text()
    assert "**1/1** leyes disponibles en Markdown (100%)" in text and "LAmn_ley_de_amnistia.md" in text


def test_ocr_is_gated(spark):
    if ocr.available():
        pytest.skip("pytesseract is here")
    with pytest.raises(ImportError):
        ocr.words(spark.createDataFrame([], "img_id long, content binary"))


def test_pictures_stand_between_the_text(spark):
    rows = [
        ("a.pdf", 1, 0, "text", "Artículo 1. Antes\n1 de 1", None),
        ("a.pdf", 1, 1, "picture", None, 7),
        ("a.pdf", 1, 2, "text", "Artículo 2. Después", None),
        ("a.pdf", 1, 3, "picture", None, 8),
        ("b.pdf", 1, 0, "text", "Artículo 1. Uno", None),
        ("b.pdf", None, None, "error", "broken", None),
    ]
    pages = spark.createDataFrame(rows, "pdf_filename string, page int, region int, kind string, text string, img_id long").withColumn("total_pages", F.lit(1))
    words = []
    for r, line in enumerate([["Concepto", "Valor"], ["10", "20"], ["30", "40"]]):
        words += [(7, 2 * r + c, w, 90.0, 200 * c, 40 * r, 80, 20) for c, w in enumerate(line)]
    words = spark.createDataFrame(words, "img_id long, i int, text string, conf double, left int, top int, width int, height int")
    entries = spark.createDataFrame([(1, "1", "LEY A", "-", "own_name", "a.pdf")], "pos int, numero string, nombre string, ultima_reforma string, md_slug string, pdf_filename string")
    out = {r["pdf_filename"]: r for r in X.convert(pages, entries, words=words).collect()}
    assert out["b.pdf"]["status"] == "failed" and out["a.pdf"]["status"] == "converted"
    assert out["a.pdf"]["md_slug"] == "own_name" and out["b.pdf"]["md_slug"] == "b"
    text = out["a.pdf"]["content"]
    table, stand_in = text.index("| 10 | 20 |"), text.index("> **[Tabla no extraíble — ver PDF original, página 1]**")
    assert text.index("Antes") < table < text.index("Después") < stand_in
    assert "no extraíble" in X.convert(pages, entries).where("pdf_filename = 'a.pdf'").first()["content"]
