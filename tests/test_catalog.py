"""HTML rows, catalog, coverage, sources and sinks."""

import json

import pytest
from lexstrata.operators import catalog as C
from lexstrata.sources import pdf, readers, sinks
from pyspark.sql import functions as F


def html(spark, text):
    return C.html_rows(spark.createDataFrame([("p", text)], "page_id string, html string")).collect()


def test_html_rows(spark):
    assert html(spark, "<tr><td>1</td><td>a  b</td><td>c</td></tr>") == []
    row = html(spark, '<TR><td>1</td>\n<td>a <b>x</b></td><td>c &amp; d</td><td><a href="pdf/z.pdf">p</a><a href="">q</a></td><td>more</td></TR>')[0]
    assert (row["numero"], row["nombre_raw"], row["ultima_reforma"], row["links"]) == ("1", "a x", "c & d", ["pdf/z.pdf"])
    assert html(spark, "<tr><td>0</td><tr><td>1<td>2</td><td>a</td><td>b</td><td>c</td></tr>")[0]["numero"] == "2"


def catalog(spark, n=5):
    rows = [(i, str(i), f"LEY {i}", "DOF", f"S{i}", f"S{i}.pdf") for i in range(n)]
    return spark.createDataFrame(rows, "pos int, numero string, nombre string, ultima_reforma string, md_slug string, pdf_filename string")


def outputs(spark, *slugs):
    return spark.createDataFrame([(s,) for s in slugs], "md_slug string")


def test_coverage(spark):
    have = outputs(spark, "S1", "S1", "S3", "other")
    index = C.coverage_index(catalog(spark), have).orderBy("pos").collect()
    assert [r["md_link"] for r in index] == ["—", "[`S1.md`](markdown/S1.md)", "—", "[`S3.md`](markdown/S3.md)", "—"]
    assert tuple(C.coverage_summary(catalog(spark), have).first()) == (5, 2, 40)
    assert tuple(C.coverage_summary(catalog(spark), have, strict=False).first()) == (5, 3, 60)
    assert tuple(C.coverage_summary(catalog(spark, 0), have).first()) == (0, 0, None)
    many = spark.range(315).selectExpr("'S' || id AS md_slug")
    assert C.coverage_summary(many, many.limit(266)).first()["pct"] == 84


def test_limit_comes_before_skip(spark):
    left = C.without_output(catalog(spark), outputs(spark, "S0"), limit=2)
    assert [r["md_slug"] for r in left.collect()] == ["S1"]
    assert C.without_output(catalog(spark), outputs(spark, "S0")).count() == 4


def test_enrich_last_entry_wins(spark):
    both = catalog(spark).union(catalog(spark, 1).selectExpr("9 AS pos", "numero", "'NEW' AS nombre", "ultima_reforma", "md_slug", "pdf_filename"))
    files = spark.createDataFrame([("S0.pdf",), ("A_b-c.pdf",)], "pdf_filename string")
    assert {r["pdf_filename"]: r["title"] for r in C.enrich_files(files, both).collect()} == {"S0.pdf": "NEW", "A_b-c.pdf": "A b c"}


def test_catalog_file_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/c.json"
    assert readers.read_catalog(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_catalog(spark, path, strict=True)
    sinks.write_catalog(catalog(spark), path, single_array=True)
    text = "".join(p.read_text() for p in (tmp_path / "c.json").glob("part-*"))
    assert [e["numero"] for e in json.loads(text)] == ["0", "1", "2", "3", "4"]
    (tmp_path / "one.json").write_text(text)
    back = readers.read_catalog(spark, f"file://{tmp_path}/one.json", strict=True)
    assert [(r["pos"], r["md_slug"]) for r in back.orderBy("pos").collect()] == [(i, f"S{i}") for i in range(5)]


def test_listings(spark, tmp_path):
    for name in ("b.pdf", "a.pdf", "A_x.md", "c.txt"):
        (tmp_path / name).write_text("x")
    assert [r["pdf_filename"] for r in readers.list_pdfs(spark, f"file://{tmp_path}").collect()] == ["a.pdf", "b.pdf"]
    assert [r["md_slug"] for r in readers.existing_outputs(spark, f"file://{tmp_path}").collect()] == ["A_x"]
    assert readers.existing_outputs(spark, f"file://{tmp_path}/none").count() == 0
    assert readers.read_markdown(spark, f"file://{tmp_path}").first()["doc_id"] == "A_x"
    (tmp_path / "p.html").write_bytes("<td>é</td>".encode("latin-1"))
    assert readers.read_html(spark, f"file://{tmp_path}/p.html").first()["html"] == "<td>é</td>"


def test_documents_and_index_sinks(spark, tmp_path):
    sinks.write_documents(spark.createDataFrame([("S1", "a\nb"), ("S2", "c")], "md_slug string, content string"), f"file://{tmp_path}/md")
    assert next((tmp_path / "md" / "md_slug=S1").glob("part-*")).read_text() == "a\nb\n"
    lines = sinks.index_lines(C.coverage_index(catalog(spark, 2), outputs(spark, "S1")), "21/03/2026", 1, 2)
    sinks.write_index(lines, f"file://{tmp_path}/index")
    text = next((tmp_path / "index").glob("part-*")).read_text().splitlines()
    assert text[3].startswith("> Última actualización: **21/03/2026** — **1/2**") and len(text) == 11
    assert text[-1] == "| 1 | LEY 1 | DOF | [`S1.md`](markdown/S1.md) |"


def test_pdf_source_is_gated(spark):
    if pdf.available():
        pytest.skip("pdfplumber is here")
    with pytest.raises(ImportError):
        pdf.register(spark)


def test_cell_text_query_resolves_the_references_of_its_sql(spark, tmp_path):
    """The operator resolves all references, the query only those that its SQL names."""
    import duckdb
    from lexstrata.plans import catalogue

    texts = ["<p>&copy; a &middot; &amp;copy; &#169;</p>", "&lt;b&gt;&nbsp;&quot;x&quot; &#39;y&#39; &amp;lt; &apos;", "<!-- &amp; -->plain", "&amp;amp;&nope;&"]
    spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = catalogue.QUERIES["html_cell_text"](spark, str(tmp_path)).orderBy("page_id").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert [tuple(r) for r in got] == con.execute(catalogue.ORACLES["html_cell_text"] + " ORDER BY page_id").fetchall()
    assert spark.createDataFrame([(texts[0],)], "x string").select(C.cell_text(F.col("x"))).first()[0] == "© a · &copy; ©"
