"""The window formulation against a plain fold, and its single shuffle."""

import random

import pytest
from fold import fold
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from lexstrata.operators import structure as S

POOL = [
    "", "  ", "> cita", "| a | b |", "| x: a) uno. b) dos |", "Transitorios", "TRANSITORIO", "transitorios Primero.- Entra en vigor.", "Transitorios Segundo", "Transitorios texto",
    "Artículo 5. Texto.", "Artículo 5", "Artículo 7-A el", "Artículo 2 A. pap-", "ARTÍCULO SEGUNDO.- Se reforma el", "Artículo Primero", "ARTÍCULO PRIMERO A ARTÍCULO TERCERO.- x:", "ARTÍCULO ÚNICO .-",
    "CAPÍTULO II", "TÍTULO PRIMERO", "Capítulo I Nombre", "Sección II de este Capítulo.", "SECCIÓN 3 BIS", "Capítulo Única", "DISPOSICIONES GENERALES", "De la Violencia", "Para todos; según",
    "Primero.- Uno.", "Segundo. Dos", "décimo primero", "TERCERO", "Quinto.-", "I. Uno;", "II. Dos. a) x b) y", "IIII. no", "XC. no", "a) inciso. b) otro", "b) fin:",
    "texto en términos del", "conforme", "al", "pap-", "el", "contri-", "buyente debe", "pagar.", "Fin.", "fin;", "Otra cosa:", "otra cosa", "1. Número", "según", "é", "-", "ver el artículo 5", "ARTÍCULO 19.- X", "El de-",
]


def render(spark, docs):
    rows = [(i, n, x) for i, d in enumerate(docs) for n, x in enumerate(d)]
    lines = spark.createDataFrame(rows, "doc_id long, line_no int, text string").repartition(3)
    parts = S.markdown(lines)
    out = {i: [] for i in range(len(docs))}
    for r in parts.orderBy("doc_id", "out_no").collect():
        out[r["doc_id"]].append(r["text"])
    return out


def compare(spark, docs):
    got = render(spark, docs)
    for i, d in enumerate(docs):
        assert got[i] == fold(d), d


@pytest.mark.parametrize("seed", [7, 23])
def test_windows_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    compare(spark, [rng.choices(POOL, k=rng.randrange(1, 15)) for _ in range(2500)])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(st.lists(st.sampled_from(POOL), min_size=1, max_size=8), min_size=20, max_size=60))
def test_windows_equal_the_fold_hypothesis(spark, docs):
    compare(spark, docs)


@pytest.mark.parametrize(
    "lines, want",
    [
        (["CAPÍTULO II", "DE LAS PARTES"], ["", "## CAPÍTULO II — DE LAS PARTES"]),
        (["El contri-", "buyente debe", "pagar."], ["El contribuyente debe pagar."]),
        (["Uno.", "Dos"], ["Uno.", "Dos"]),
        (["Uno.", "dos"], ["Uno. dos"]),
        (["en términos del", "Artículo 5 de esta Ley"], ["en términos del Artículo 5 de esta Ley"]),
        (["Transitorios", "Primero.- Entra en vigor."], ["", "## Transitorios", "", "**Primero.-** Entra en vigor."]),
        (["x: a) uno. b) dos"], ["x:", "", "a) uno.", "", "b) dos"]),
    ],
)
def test_hand_cases(spark, lines, want):
    assert render(spark, [lines])[0] == want == fold(lines)


def test_render_and_chunks(spark):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["intro", "Artículo 1. A", "I. b", "Artículo 1. C"])], "doc_id long, line_no int, text string")
    titles = spark.createDataFrame([(1, "T"), (2, "U")], "doc_id long, title string")
    texts = {r["doc_id"]: r["content"] for r in S.render(S.markdown(lines), titles).collect()}
    assert texts[1].startswith("# T\n\n> ") and texts[1].endswith("### Artículo 1\n. C") and texts[2].endswith("---\n")
    chunks = S.article_chunks(S.classify(lines)).orderBy("seq").collect()
    assert [(r["seq"], r["heading"], r["n_lines"]) for r in chunks] == [(0, None, 1), (1, "Artículo 1", 2), (2, "Artículo 1", 1)]
    nodes = S.hierarchy(S.classify(lines)).orderBy("line_no").collect()
    assert [(r["level"], r["label"], r["article"]) for r in nodes] == [(4, "Artículo 1", "Artículo 1"), (5, "I.", "Artículo 1"), (4, "Artículo 1", "Artículo 1")]


def test_paragraphs_need_one_shuffle(spark):
    spark.range(3).selectExpr("id AS doc_id", "'a\nb' AS text").write.mode("overwrite").parquet("/tmp/lexstrata-plan")
    from lexstrata.operators.lines import lines_by_document

    plan = S.paragraphs(S.pieces(S.classify(lines_by_document(spark.read.parquet("/tmp/lexstrata-plan")))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_markdown_reads_its_lines_twice_at_most(spark):
    """Once for the running headers, once for the rest; one exchange of the lines."""
    spark.range(3).selectExpr("id AS doc_id", "'a\nb' AS text").write.mode("overwrite").parquet("/tmp/lexstrata-plan2")
    from lexstrata.operators.lines import lines_by_document

    plan = S.markdown(lines_by_document(spark.read.parquet("/tmp/lexstrata-plan2")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 2 and plan.count("Exchange hashpartitioning") <= 4


def test_made_lines_are_not_made_anew(spark):
    """No filter or projection repeats the expression that makes a line; both sides of the header's join read it once."""
    from lexstrata.plans import catalogue

    plan = catalogue.QUERIES["markdown_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("DISPOSICIONES GENERALES") <= 2
