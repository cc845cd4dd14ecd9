"""Column builders and line predicates on hand-derived cases."""

import pytest
from lexstrata.functions import patterns as P
from lexstrata.functions import text as T
from lexstrata.operators import catalog as C
from lexstrata.operators import lines as L
from lexstrata.operators import structure as S
from pyspark.sql import functions as F


def one(spark, build, *values):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([values], names).select(build(*map(F.col, names)).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "build, values, want",
    [
        (T.slug, ["CÓDIGO Penal Federal"], "codigo_penal_federal"),
        (T.slug, ["a" * 80], "a" * 70),
        (T.slug, ["x" * 69 + " y"], "x" * 69),
        (T.slug, ["ñ ß!"], "n"),
        (T.acronym, ["ESTATUTO de Gobierno del Distrito Federal"], "EGDF"),
        (T.acronym, ["de la"], "LEY"),
        (T.acronym, ["LEY-Uno/Dos 3 (x), Y"], "LUD"),
        (T.md_slug, ["LCEC_120419", "LEY de Cámaras Empresariales y sus Confederaciones"], "LCEC_ley_de_camaras_empresariales_y_sus_confederaciones"),
        (T.md_slug, ["123", "LEY de Amnistía"], "LA_ley_de_amnistia"),
        (T.law_name, ["LEY X DOF 05/02/1917 (Antes Y)"], "LEY X"),
        (T.law_name, ["LEY X Nueva reforma"], "LEY X"),
        (T.law_name, ["LEY X ley abrogada por Z DOF 1"], "LEY X"),
        (T.law_date, ["LEY X DOF 05/02/1917 (Antes Y)"], "DOF05/02/1917"),
        (T.law_date, ["LEY X"], ""),
        (T.strip, ["  a b\t\n"], "a b"),
        (T.squeeze, [" a \n b "], "a b"),
        (T.stem, ["x/y.z.pdf"], "y.z"),
        (T.stem, ["x/.md"], ".md"),
        (T.default_title, ["A_b-c"], "A b c"),
        (T.reform_kind, ["Notificación 01/02/2020 Sentencia SCJN"], "ruling_notice"),
        (T.reform_kind, ["DOF 01/02/2020"], "gazette"),
        (lambda c, n: L.clean_markers(c, n), ["el 15 de 2024 algo", 20], "el 24 algo"),
        (lambda c, n: L.clean_markers(c, n, True), ["el 15 de 2024 algo 3 de 20", 20], "el 15 de 2024 algo"),
        (L.is_furniture, ["previsto en el Código Penal Federal, cuando:"], True),
        (lambda c: L.is_furniture(c, True), ["previsto en el Código Penal Federal, cuando:"], False),
        (lambda c: L.is_furniture(c, True), ["LEY GENERAL DE VALOR"], True),
        (L.is_furniture, ["última reforma dof 1"], True),
    ],
)
def test_builders(spark, build, values, want):
    assert one(spark, build, *values) == want


def test_roman(spark):
    good, bad = ["I", "II", "IV", "IX", "XL", "LXXXIX"], ["IIII", "XC", "C", ""]
    rows = spark.createDataFrame([(x,) for x in good + bad], ["s"]).select("s", T.is_roman(F.col("s")).alias("v")).collect()
    assert {r["s"] for r in rows if r["v"]} == set(good)


def test_first_pdf(spark):
    found = spark.createDataFrame([(["pdf_mov/a.pdf", "doc/b.doc", "pdf/c.pdf", "pdf/d.pdf"],), ([],)], "l array<string>").select(C.first_pdf(F.col("l")).alias("v"))
    assert [r["v"] for r in found.collect()] == ["pdf/c.pdf", None]


def test_headings(spark):
    p = P.COMPAT
    lines = ["Artículo 5. Texto", "Artículo 2 A. Texto", "Artículo 5 Bis. X", "ARTÍCULO 19.- X", "Sección II de este Capítulo.", "CAPÍTULO II DE LAS PARTES", "CAPÍTULO II X", "ARTÍCULO SEGUNDO.- Y"]
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "doc_id long, line_no int, text string")
    got = [(r["kind"], r["heading"], r["body"]) for r in S.classify(rows).orderBy("line_no").collect()]
    assert got == [
        ("article", "Artículo 5", ". Texto"), ("article", "Artículo 2 A", "Texto"), ("article", "Artículo 5", "Bis. X"), ("text", None, ""),
        ("text", None, ""), ("text", None, ""), ("part", "CAPÍTULO II", "X"), ("ordinal_article", "ARTÍCULO SEGUNDO", "Y"),
    ]
    strict = [(r["kind"], r["heading"], r["body"]) for r in S.classify(rows, strict=True).orderBy("line_no").collect()]
    assert strict[2:4] == [("article", "Artículo 5 Bis", "X"), ("article", "ARTÍCULO 19", "X")]
    assert strict[5][0] == "part"
    assert p.running_length == 16


def test_running_header(spark):
    short, long = ["LEY DE AMNISTÍA"] * 5, ["LEY DE  AGUAS NACIONALES", "LEY DE AGUAS  NACIONALES ", " LEY DE AGUAS NACIONALES", "ver LEY DE AGUAS NACIONALES aquí", "x"]
    rows = [(1, i, x) for i, x in enumerate(short)] + [(2, i, x) for i, x in enumerate(long)]
    data = spark.createDataFrame(rows, "doc_id long, line_no int, text string")
    assert [(r["doc_id"], r["header"], r["n"]) for r in L.running_headers(data).collect()] == [(2, "LEY DE AGUAS NACIONALES", 3)]
    assert {r["doc_id"] for r in L.running_headers(data, strict=True).collect()} == {1, 2}
    left = [r["text"] for r in L.drop_running_headers(data).where("doc_id = 2").orderBy("line_no").collect()]
    assert left == ["ver   aquí", "x"]


def test_running_header_tie_goes_to_the_first(spark):
    rows = [(1, i, x) for i, x in enumerate(["BBBB BBBB BBBB BBBB", "AAAA AAAA AAAA AAAA"] * 3)]
    found = L.running_headers(spark.createDataFrame(rows, "doc_id long, line_no int, text string"))
    assert found.first()["header"].startswith("B")


def test_page_lines(spark):
    pages = [("d", 2, 0, "c 2 de 2\n", 2), ("d", 1, 1, "b", 2), ("d", 1, 0, "Secretaría General\n a 1 de 2 ", 2)]
    out = L.page_lines(spark.createDataFrame(pages, "doc_id string, page int, region int, text string, total_pages int"))
    assert [r["text"] for r in out.orderBy("line_no").collect()] == ["a", "b", "c"]


def test_page_lines_are_cleaned_once(spark):
    """No filter repeats the patterns that clean a line."""
    from lexstrata.plans import catalogue

    plan = catalogue.QUERIES["page_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") <= 3


def test_page_lines_marks_and_nulls(spark):
    pages = [("d", 1, 0, "\u3000x 12 de 34\u2003y\u00a0\n3 de  34\n34 dedos\n1 de 3", 34), ("d", 2, 0, None, 34), ("e", 1, 0, "a", None)]
    out = L.page_lines(spark.createDataFrame(pages, "doc_id string, page int, region int, text string, total_pages int"))
    assert [(r["line_no"], r["text"]) for r in out.orderBy("line_no").collect()] == [(0, "x y"), (1, "34 dedos"), (2, "1 de 3")]


def test_image_tables_and_regions(spark):
    box = "array<struct<x0:double,x1:double,y0:double,y1:double,top:double,bottom:double>>"
    rows = [(1, [(0.0, 300.0, 0.0, 200.0, None, None)], 0), (2, [(0.0, 300.0, 0.0, 200.0, None, None)], 1), (3, [(0.0, 200.0, 0.0, 200.0, None, None)], 0), (4, [], 0)]
    out = L.image_tables(spark.createDataFrame(rows, f"page int, images {box}, n_tables int"))
    assert [r["page"] for r in out.where("is_image_table").collect()] == [1]
    regions = spark.createDataFrame([(1, 1, 50.0, "picture", "P"), (1, 1, 0.0, "text", "A"), (1, 1, 90.0, "text", "B")], "doc_id int, page int, y double, kind string, text string")
    assert [r["text"] for r in L.interleave(regions).orderBy("order_no").collect()] == ["A", "P", "B"]
