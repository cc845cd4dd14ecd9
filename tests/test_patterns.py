"""Lines whose answer is written by hand, in the published mode."""

import html
import re
import sys
import types
import unicodedata

import pytest
from lexstrata.functions import patterns as P
from lexstrata.functions import text as T
from lexstrata.operators import catalog as C
from lexstrata.operators import lines as L
from lexstrata.operators import structure as S
from lexstrata.sources import pdf
from pyspark.sql import functions as F

KINDS = [
    ("Artículo 5. Texto", "article"),
    ("Artículo 4-A", "article"),
    ("ARTÍCULO 5. Texto", "text"),
    ("artículo 96 de esta Ley", "text"),
    ("Artículo Primero.- Se reforma", "ordinal_article"),
    ("ARTÍCULO ÚNICO. Se expide", "ordinal_article"),
    ("Artículo Décimo Segundo. Uno", "ordinal_article"),
    ("Artículo Cuadragésimo. Uno", "text"),
    ("TRANSITORIOS", "transitory"),
    ("transitorio", "transitory"),
    ("Transitoriedad de la ley", "text"),
    ("TÍTULO PRIMERO", "part"),
    ("Capítulo Único", "part"),
    ("CAPÍTULO II BIS", "part"),
    ("CAPÍTULO II QUEJAS Y DENUNCIAS", "part"),
    ("Capítulo II Quejas", "part"),
    ("Capítulo II quedan vigentes", "part"),
    ("Capítulo II que regula", "text"),
    ("Capítulo II de esta Ley", "text"),
    ("Capítulo II denuncias", "text"),
    ("CAPÍTULO II DEL TRABAJO", "text"),
    ("Sección II, del Capítulo", "text"),
    ("Sección II Yucatán", "part"),
    ("Sección II y siguientes", "text"),
    ("Título III según corresponda", "text"),
    ("Título III seccional", "part"),
    ("Título III secciones", "text"),
    ("CAPITULO II", "text"),
    ("I. Uno", "fraction"),
    ("a) uno", "clause"),
    ("> nota", "quote"),
    ("| a | b |", "table"),
    ("", "blank"),
]


def test_kinds_of_lines(spark):
    rows = spark.createDataFrame([(i, 0, line) for i, (line, _) in enumerate(KINDS)], "doc_id long, line_no int, text string")
    got = {r["doc_id"]: r["kind"] for r in S.classify(rows).where("sub_no = 0").collect()}
    assert [(line, got[i]) for i, (line, _) in enumerate(KINDS)] == KINDS


@pytest.mark.parametrize(
    ("pattern", "yes", "no"),
    [
        ("roman", ["I. Uno", "XVI. Dos"], ["C. Uno", "I.Uno", "i. uno"]),
        ("clause", ["a) uno", "z) uno"], ["A) uno", "a)uno", "ab) uno"]),
        ("connector", ["conforme al", "según", "previsto en  "], ["canal", "Ley", "en la ley"]),
        ("name", ["De la Familia", "Disposiciones Generales"], ["Delitos", "Disposición", "de la Familia"]),
        ("transitory_ordinal", ["Primero.- El", "ARTÍCULO SEGUNDO. El", "único"], ["Cuadragésimo", "El primero"]),
    ],
)
def test_patterns_by_hand(spark, pattern, yes, no):
    rows = spark.createDataFrame([(x,) for x in yes + no], "x string")
    got = [r[0] for r in rows.select(F.col("x").rlike(getattr(P.COMPAT, pattern))).collect()]
    assert got == [True] * len(yes) + [False] * len(no)


def test_furniture_by_hand(spark):
    lines = [("Secretaría General", True), ("Última Reforma DOF 01-01-2020", True), ("LEY FEDERAL DEL IMPUESTO SOBRE LA RENTA", True), ("Artículo 1. Uno", False), ("Nueva reforma", False)]
    out = spark.createDataFrame([(x,) for x, _ in lines], "x string").select(L.is_furniture(F.col("x"))).collect()
    assert [r[0] for r in out] == [w for _, w in lines]


def test_slugs_fold_every_latin_letter(spark):
    name = "Őş ā Žluť Ấn Ærø"
    plain = "".join(c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn").lower()
    out = spark.createDataFrame([(name,)], "x string").select(T.slug(F.col("x"))).first()[0]
    assert out == re.sub("[^a-z0-9]+", "_", plain).strip("_")


def test_character_references(spark):
    texts = ["Constituci&oacute;n", "a&#243;b&#xF3;c", "&amp;lt;", "&Ntilde;&apos;", "a & b", "&euro;5", "plain", "&unknown;", "&#128512;"]
    rows = spark.createDataFrame([(x,) for x in [*texts, "&#0;&#55296;"]], "x string").select(C.unescape(F.col("x")))
    assert [r[0] for r in rows.collect()] == [*map(html.unescape, texts), "&#0;&#55296;"]


def test_strips_between_pictures():
    assert pdf.strips([], 800) == [(0, 800)]
    assert pdf.strips([(100, 300), (300.5, 500)], 800) == [(0, 100), None, (500, 800)]
    assert pdf.strips([(0.5, 799.5)], 800) == [None, None]
    assert pdf.extent({"top": 10, "bottom": 50, "y0": 20, "y1": 60}) == (10, 60)
    assert pdf.extent({"y0": 20, "y1": 60}) == (20, 60)


class Page:
    """Stand-in for a page: two pictures, the text of a strip is its edges."""

    width, height = 600, 800
    images = [{"x0": 0, "x1": 300, "y0": 400, "y1": 600}, {"x0": 0, "x1": 300, "y0": 100, "y1": 300}, {"x0": 0, "x1": 5, "y0": 0, "y1": 9}]

    def __init__(self, box=None):
        self.box = box

    def extract_tables(self):
        return []

    def crop(self, box):
        if box[1] == 600:
            raise ValueError("outside the page")
        return Page(box)

    def extract_text(self, **_):
        return f"{self.box[1]}-{self.box[3]}"


def test_regions_of_a_page():
    assert pdf.page_regions(Page()) == [(0, "text", "0-100", None), (1, "picture", None, None), (2, "text", "300-400", None), (3, "picture", None, None)]


def test_a_broken_file_is_one_row(monkeypatch):
    def fail(path):
        raise OSError("broken")

    monkeypatch.setitem(sys.modules, "pdfplumber", types.SimpleNamespace(open=fail))
    rows = list(pdf.PdfReader(["a.pdf"]).read(pdf.InputPartition("a.pdf")))
    assert rows == [("a.pdf", None, None, "error", "broken", None, None)]


def test_pages_with_drawn_tables_are_one_region(monkeypatch):
    monkeypatch.setattr(Page, "extract_tables", lambda self: [1])
    assert [r[:2] for r in pdf.page_regions(Page((0, 0, 600, 800)))] == [(0, "text")]
