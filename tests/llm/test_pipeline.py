import brute
import corpus_pipeline as P
import numpy as np
from lexstrata.llm.queries import tokenizer_path
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_decide_as_the_plain_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", None, None, 0), (10**6 + 2, "123", None, "s", 3)], docs.schema)
    docs = docs.unionByName(extra)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = lambda d: {r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()}

    known = P.keep_known_language(spark, docs, SF)
    assert known.columns == docs.columns and known.count() == docs.count() - 3
    single = P.drop_near_copies(spark, known, SF)
    want = {d for d, (_, c) in brute.op5(list(rows(known).items())).items() if d == c}
    assert set(rows(single)) == want and len(want) < known.count()
    clean = P.drop_contaminated(spark, single, SF)
    want = {d for d, v in brute.op10(list(rows(single).items()), items).items() if not v[4]}
    assert set(rows(clean)) == want and single.columns == docs.columns
    safe = P.redact_personal_data(spark, clean, SF)
    assert safe.columns == docs.columns
    for d, t in rows(safe).items():
        assert not any(brute.op4(t).values())
        if not any(brute.op4(rows_clean := rows(clean)[d]).values()) if d % 40 == 0 else False:
            assert rows_clean.split()[0] in t
    packed = P.pack_sequences(spark, safe, SF).collect()
    tokenizer, texts = Tokenizer.from_file(tokenizer_path()), rows(safe)
    pieces = {}
    for r in packed:
        pieces.setdefault(r["doc_id"], {})[r["start"]] = r["ids"]
    for d, t in texts.items():
        ids = np.frombuffer(b"".join(v for _, v in sorted(pieces[d].items())), "<u4").tolist()
        assert ids == [*tokenizer.encode(t, add_special_tokens=False).ids, 2]


def test_repeated_rows_leave_one(spark):
    text = "some words that stand here for a document of its own"
    docs = spark.createDataFrame([(1, text, "en"), (1, text, "en"), (2, text, "en"), (None, text, "en"), (3, None, None)], "doc_id long, text string, lang string")
    assert sorted(str(r["doc_id"]) for r in P.drop_near_copies(spark, docs, SF).collect()) == ["1", "3", "None"]


def test_repeated_ids_of_different_texts_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (2, b), (3, c), (3, a + " more"), (4, c), (4, None), (4, ""), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r) for r in P.drop_near_copies(spark, docs, SF).collect()]
    assert sorted(out, key=str) == sorted([(1, a), (2, b), (3, c), (4, None), (4, ""), (None, b)], key=str)


def test_all_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_stages_keep_columns_of_any_name(spark):
    from lexstrata.llm import decontaminate, pii

    names = ["_key", "_gone", "_hit", "_again", "_id", "_own", "_spans", "_end", "row", "key", "id", "of", "end", "spans", "a.b"]
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, *names), (2, text + " x", *names), (3, "write to ann@example.org now", *names), (3, "other text", *names), (None, None, *names)]
    kinds = ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {kinds}")
    items = spark.createDataFrame([(1, "other text")], "item_id long, text string")
    for some in (docs, docs.where("text is null or text != 'other text'")):
        out = P.drop_near_copies(spark, some, "")
        assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {1, 3, None}
    redacted = pii.redact(docs)
    assert redacted.columns == docs.columns
    assert sorted(str(r["text"]) for r in redacted.collect())[0] == "None"
    assert any(r["text"] == "write to <email> now" and r["a.b"] == "a.b" for r in redacted.collect())
    for limit in (0, 10**6):
        clean = decontaminate.drop_contaminated(docs, items, broadcast_windows=limit)
        assert clean.columns == docs.columns and clean.count() == 4
