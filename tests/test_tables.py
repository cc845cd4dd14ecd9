"""Tables from words: each step on small grids."""

from lexstrata.operators import tables as OCR
from pyspark.sql import functions as F

SCHEMA = "img_id long, i int, text string, conf double, left int, top int, width int, height int"


def words(spark, rows, img=1):
    """rows: (top, [(left, text), ...])."""
    flat = [(top, left, t) for top, ws in rows for left, t in ws]
    return spark.createDataFrame([(img, i, t, 90.0, left, top, 10, 10) for i, (top, left, t) in enumerate(flat)], SCHEMA)


def build(spark, rows):
    return OCR.build_tables(words(spark, rows)).first()["md"]


def test_rows_depend_on_order_of_arrival(spark):
    def keys(centres):
        rows = spark.createDataFrame([(1, i, "x", 90.0, 0, c - 5, 10, 10) for i, c in enumerate(centres)], SCHEMA)
        return [r["row_key"] for r in OCR.assign_rows(rows).orderBy("i").collect()]

    assert keys([100, 112, 124]) == [100, 100, 124]
    assert keys([112, 100, 124]) == [112, 112, 112]


def test_unsure_and_blank_words_go(spark):
    rows = spark.createDataFrame([(1, 0, " a ", 1.0, 0, 0, 1, 1), (1, 1, " ", 90.0, 0, 0, 1, 1), (1, 2, None, 90.0, 0, 0, 1, 1), (1, 3, "b", 0.5, 0, 0, 1, 1)], SCHEMA)
    assert [r["text"] for r in OCR.usable_words(rows).collect()] == ["a"]


def test_column_of_is_strict(spark):
    bounds = F.array(F.lit(10.0), F.lit(20.0))
    row = spark.range(1).select(*(OCR.column_of(F.lit(x), bounds) for x in (10.0, 10.5, 25.0))).first()
    assert tuple(row) == (0, 1, 2)


def test_whole_table(spark):
    rows = [
        (0, [(0, "TARIFA"), (60, "ANUAL")]),
        (100, [(0, "Límite"), (110, "Cuota"), (205, "Por"), (230, "ciento")]),
        (120, [(0, "inferior"), (110, "fija")]),
        (140, [(0, "$"), (100, "$"), (200, "%")]),
        (160, [(0, "1.00"), (100, "2.00"), (200, "3%")]),
        (180, [(0, "4.00"), (100, "5.00"), (200, "6%")]),
        (200, [(0, "Nota"), (50, "final")]),
        (220, [(0, "7"), (100, "8"), (200, "9")]),
    ]
    assert build(spark, rows) == [
        "", "**TARIFA ANUAL**", "| Límite inferior ($) | Cuota fija ($) | Por ciento (%) |", "| --- | --- | --- |",
        "| 1.00 | 2.00 | 3% |", "| 4.00 | 5.00 | 6% |", "", "Nota final", "7 8 9", "",
    ]


def test_plain_text_and_default_names(spark):
    assert build(spark, [(0, [(0, "uno"), (50, "dos")]), (40, [(0, "tres")])]) == ["", "uno dos", "tres", ""]
    assert build(spark, [(0, [(0, "título")]), (40, [(0, "1"), (100, "2")])]) == ["", "título", "| Col 1 | Col 2 |", "| --- | --- |", "| 1 | 2 |", ""]


def test_narrow_header_goes_right(spark):
    rows = [(0, [(0, "Base")]), (20, [(170, "Tasa"), (190, "anual")]), (40, [(0, "1"), (100, "2"), (200, "3")])]
    assert build(spark, rows)[1] == "| Base | Col 2 | Tasa anual |"


def test_modal_width_tie_goes_to_the_first(spark):
    rows = [(0, [(0, "1"), (100, "2")]), (40, [(0, "1"), (100, "2"), (200, "3")])]
    layout = OCR.column_layout(OCR.table_rows(OCR.assign_rows(words(spark, rows)))).first()
    assert layout["n_cols"] == 2


def test_placeholder(spark):
    images = spark.createDataFrame([(1, 4), (2, 5)], "img_id long, page int")
    tables = OCR.build_tables(words(spark, [(0, [(0, "a")])]))
    out = {r["img_id"]: r["md"] for r in OCR.with_placeholder(images, tables).collect()}
    assert out[1] == ["", "a", ""] and out[2] == ["> **[Tabla no extraíble — ver PDF original, página 5]**"]


def test_words_are_dealt_once(spark):
    """Rows, columns and tables of pictures need one exchange of the items, and words are grouped by picture once."""
    from lexstrata.plans import catalogue

    for name in ("ocr_rows", "ocr_columns", "ocr_tables"):
        plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        full = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert full.count("Exchange ") == 1 and "Join" not in plan and plan.count("collect_list") <= 4


def test_picture_rows_are_the_same(spark):
    """Rows made inside a picture equal those of words with row keys; close keys and ties in place included."""
    import random

    rng = random.Random(5)
    flat = [(img, i, rng.choice(["1", "22%", "$3", "uno", "nota"]), 90.0, rng.choice([0, 50, 50, 100]), rng.randrange(0, 90), 10, rng.choice([9, 10])) for img in range(60) for i in range(rng.randrange(1, 30))]
    data = spark.createDataFrame(flat, SCHEMA)
    plain = {}
    for img, i, text, _, left, top, width, height in flat:
        keys = plain.setdefault(img, {})
        y = top + height // 2
        keys.setdefault(next((k for k in keys if abs(k - y) <= 12), y), []).append((left, i, text))
    want = sorted((img, no, " ".join(w[2] for w in sorted(keys[k]))) for img, keys in plain.items() for no, k in enumerate(sorted(keys)))
    split = OCR.table_rows(OCR.assign_rows(data)).drop("ws")
    whole = OCR.picture_rows(data).select("img_id", F.inline("rows")).drop("ws")
    assert sorted((r["img_id"], r["row_no"], r["text"]) for r in whole.collect()) == want
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))
