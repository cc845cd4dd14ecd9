"""Every operator against a plain re-statement, on whole small tables and on awkward rows."""

import os
import hashlib
import math
import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from lexstrata.llm import decontaminate, jaccard_join, language_id, license_scan, lm_score, packing, pii, quality, substring_dedup, url_filter
from lexstrata.llm import kernels as K
from lexstrata.llm.queries import URL_RULES, queries, tokenizer_path
from pyspark.sql import functions as F

R = random.Random(7)
VOCABULARY = ["the", "of", "and", "Müller", "naïve", "x.", "a-b", "été", "12", "foo\x00bar", "<|", "straße,"] + [f"w{i}" for i in range(300)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, block string, n string, h1 string, score string, kept string, spans string, dir string"


def prose(n, rng=R):
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", " ", " ", "\n", "\t", "  "]) for _ in range(n))


def edit(text, k, rng=R):
    words = text.split(" ")
    for _ in range(k):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    return " ".join(words)


def awkward():
    """Copies, near copies, shared passages, nulls, blanks, short texts, a long one, repeated rows."""
    passage, base = prose(70), prose(120)
    docs = [(i, prose(R.randrange(5, 200))) for i in range(20)]
    docs += [(100 + i, base) for i in range(6)] + [(110 + i, edit(base, 2)) for i in range(12)] + [(130 + i, edit(base, 9)) for i in range(6)]
    docs += [(200 + i, prose(30) + passage + " " + prose(20)) for i in range(8)]
    docs += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "ONE"), (305, "one two three four"), (306, "12 34 !!"), (307, "w1 " * 400), (308, "w1 " * 400)]
    docs += [(309, prose(9000)), (310, "a" * 50_000), (-5, base)]
    return docs


def frame(spark, docs):
    rows = [(d, t, "en", "s", 1, *["clash"] * 9) for d, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def as_dict(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.fixture(scope="module")
def docs():
    return awkward()


def test_pieces_split_and_null():
    column = pa.array(["ab", None, "c" * 10, ""])
    assert [(a, b, bytes(d)) for a, b, d, _ in K.pieces(column, 4)] == [(0, 2, b"ab"), (2, 3, b"c" * 10), (3, 4, b"")]
    assert list(K.pieces(column.slice(0, 0))) == []


def test_words_and_window_hashes_follow_content():
    texts = ["a b c d", "x a b c", " b", "", "ab"]
    _, _, data, offsets = next(K.pieces(pa.array(texts)))
    w = K.Words(data, offsets)
    assert w.count.tolist() == [4, 4, 1, 0, 1]
    h = K.Windows(w.hashes())
    assert h.at(0, 3) == h.at(5, 3) and h.at(0, 2) != h.at(1, 2) and h.at(8, 1) == h.at(1, 1)


def test_substring_dedup(spark, docs):
    got = as_dict(substring_dedup.remove_repeats(frame(spark, docs)), "n_words", "n_removed", "kept_sha256")
    assert got == brute.op1(docs)
    assert sum(v[1] for v in got.values()) > 1000


@pytest.mark.parametrize("window", [4, 7])
def test_substring_dedup_other_windows(spark, docs, window):
    some = docs[:60]
    got = as_dict(substring_dedup.remove_repeats(frame(spark, some), window), "n_words", "n_removed", "kept_sha256")
    assert got == brute.op1(some, window)


def test_substring_dedup_repeated_rows_and_null_id(spark):
    text = prose(80)
    out = substring_dedup.remove_repeats(frame(spark, [(2, text), (2, text), (None, text), (3, text), (2, prose(60))])).collect()
    assert len(out) == 5
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in out) == [(0, 0), (2, 0), (2, 0), (2, 0), (3, 80)]


def test_substring_dedup_kept_text(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    out = {r["doc_id"]: r for r in substring_dedup.remove_repeats(frame(spark, [(1, shared), (2, f"head\n{shared} tail")])).collect()}
    assert out[2]["kept_text"] == "head tail" and out[1]["kept_text"] is None


def test_jaccard_join(spark, docs):
    got = as_dict(jaccard_join.link_near_copies(frame(spark, docs)), "n_shingles", "component_id")
    assert got == brute.op5(docs)
    assert len({v[1] for v in got.values()}) < len(docs) - 15


def test_jaccard_join_large_blocks_are_dealt(spark):
    base = prose(60)
    some = [(i, edit(base, 1 + i % 6)) for i in range(60)] + [(i, prose(60)) for i in range(100, 110)]
    got = as_dict(jaccard_join.link_near_copies(frame(spark, some), block_rows=5), "n_shingles", "component_id")
    assert got == brute.op5(some)


def tree_of(sets):
    sig = jaccard_join.Signatures([jaccard_join.bitmap(np.sort(x)) for x in sets], np.array([len(x) for x in sets]))
    return jaccard_join.Tree(sig.folded(np.arange(len(sets)), int(sig.width.min())), sig.n), sig


def test_jaccard_tree_excludes_nothing_that_links():
    rng = np.random.default_rng(3)
    tokens = K.mix(np.arange(5000, dtype=np.uint64))
    base = rng.integers(0, 5000, (6, 150))
    sets = [np.unique(tokens[np.where(rng.random(150) < 0.1, rng.integers(0, 5000, 150), base[i * 6 // 200])]) for i in range(200)]
    tree, sig = tree_of(sets)
    kept = {p for i, j in jaccard_join.dual(tree, tree, 75, True) for p in zip(i.tolist(), j.tolist(), strict=True)}
    i, j = np.triu_indices(200, 1)
    assert kept == {p for p, ok in zip(zip(i.tolist(), j.tolist(), strict=True), sig.may_link(i, j, 75), strict=True) if ok}
    both = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    linked = {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if 175 * both(a, b) >= 75 * (len(sets[a]) + len(sets[b]))}
    assert linked and linked <= kept and len(kept) < 200 * 199 // 4


@pytest.mark.parametrize("size", [60, 300, 800, 2000, 5000, 20_000])
def test_jaccard_tree_prunes_disjoint_nodes(size):
    """Two groups of near copies without a common shingle: their nodes go, from the top."""
    rng = np.random.default_rng(size)
    groups = [K.mix(np.arange(g * 10 * size, g * 10 * size + size, dtype=np.uint64)) for g in range(1, 3)]
    sets = [np.unique(np.where(rng.random(size) < 0.02, rng.integers(0, 1 << 62, size).astype(np.uint64), g)) for g in groups for _ in range(16)]
    tree, _ = tree_of(sets)
    seen = 0
    for level in range(1, len(tree.levels)):
        nodes = len(tree.levels[level][0])
        half = 16 // 4**level
        if 2 * half != nodes or not half:
            continue
        i, j = (x.reshape(-1) for x in np.meshgrid(np.arange(half), np.arange(half, nodes)))
        assert not jaccard_join._possible(tree.levels[level], i, tree.levels[level], j, 75).any()
        seen += len(i)
    assert seen
    kept = [p for i, j in jaccard_join.dual(tree, tree, 75, True) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert kept and all((a < 16) == (b < 16) for a, b in kept)


def test_jaccard_bitmaps_of_other_widths_fold():
    rng = np.random.default_rng(1)
    base = K.mix(np.arange(70, dtype=np.uint64))
    sets = [np.sort(base[: rng.integers(50, 71)]) for _ in range(30)]
    sig = jaccard_join.Signatures([jaccard_join.bitmap(x) for x in sets], np.array([len(x) for x in sets]))
    assert len(set(sig.width.tolist())) > 1
    i, j = np.triu_indices(30, 1)
    ok = sig.may_link(i, j, 75)
    for a, b, kept in zip(i, j, ok, strict=True):
        assert kept or 175 * len(np.intersect1d(sets[a], sets[b])) < 75 * (len(sets[a]) + len(sets[b]))


def test_jaccard_rows_of_one_id_are_one_node(spark):
    x, y = prose(40), prose(50)
    out = jaccard_join.link_near_copies(frame(spark, [(3, x), (5, x), (5, y), (7, y), (8, prose(30))])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in out) == [(3, 3), (5, 3), (5, 3), (7, 3), (8, 8)]


def test_jaccard_chains_of_boilerplate(spark):
    """Documents mixed from a few passages: frequent shingles everywhere, links only where the mixes agree."""
    rng = random.Random(5)
    passages = [prose(40, rng) for _ in range(8)]
    docs = [(i, " ".join(rng.sample(passages, 4))) for i in range(80)] + [(100 + i, " ".join([*passages[:3], prose(3 + i % 9, rng)])) for i in range(60)]
    for rows in (4096, 6):
        got = as_dict(jaccard_join.link_near_copies(frame(spark, docs), block_rows=rows), "n_shingles", "component_id")
        assert got == brute.op5(docs)


def test_jaccard_repeated_rows_and_null_id(spark):
    text = prose(40)
    out = jaccard_join.link_near_copies(frame(spark, [(5, text), (5, text), (None, text), (9, text)])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in out) == [(-1, 5), (5, 5), (5, 5), (9, 5)]


ITEMS = [(1, "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu"), (10, "w1 w2"), (2, None), (3, ""), (4, "!!"), (5, "w1"), (10, "w1 w2"), (7, "w3 w4 w5 w6 w7 w8")]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_decontamination(spark, docs, limit):
    mine = [*docs, (400, "x alpha-beta gamma delta epsilon Zeta eta theta iota kappa. y"), (401, "W1, W2!"), (402, prose(30) + ITEMS[0][1])]
    items = spark.createDataFrame([(i, t, "c") for i, t in ITEMS], "item_id long, text string, h1 string")
    out = decontaminate.find_contamination(frame(spark, mine), items, broadcast_windows=limit)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["item_ids"]), hashlib.sha256(",".join(r["item_ids"]).encode()).hexdigest(), r["n_hit"] > 0) for r in out.collect()}
    assert got == brute.op10(mine, ITEMS)
    assert got[400][1] == 10 and got[300][0] == 0


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_decontamination_empty_benchmark(spark, limit):
    items = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.find_contamination(frame(spark, [(1, "a b"), (None, None)]), items, broadcast_windows=limit).collect()
    assert sorted(r["n_hit"] for r in out) == [0, 0]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_contaminated_rows_go_each_on_their_own(spark, limit):
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    bad = "x " + ITEMS[0][1]
    rows = [(None, bad), (None, "clean one"), (None, None), (1, bad), (1, "clean two"), (1, "clean two"), (2, "clean one"), (3, bad), (4, "")]
    out = decontaminate.drop_contaminated(frame(spark, rows), items, broadcast_windows=limit)
    assert out.columns == frame(spark, rows).columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(r for r in rows if r[1] != bad)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_items_without_id_contaminate(spark, limit):
    items = spark.createDataFrame([(None, ITEMS[0][1]), (5, "w1 w2")], "item_id long, text string")
    docs = frame(spark, [(1, "x " + ITEMS[0][1]), (2, "w1 w2"), (3, "clean")])
    out = decontaminate.find_contamination(docs, items, broadcast_windows=limit).collect()
    assert {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in out} == {1: (12, []), 2: (2, ["5"]), 3: (0, [])}
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, items, broadcast_windows=limit).collect()] == [3]


def test_language_id(spark):
    words = {"xx": "zab zoc zid", "yy": "lum lor lin"}
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choices(words[k].split(), k=12)), k) for i, k in enumerate(["xx", "yy"] * 40)]
    data = spark.createDataFrame([*docs, (900, None, "xx"), (901, "", None), (902, "12 !!", "yy"), (903, "zab zoc", None), (None, "lum lor", "yy")], "doc_id long, text string, lang string")
    model = language_id.train(data.where(~language_id.held_out(F.col("doc_id"))).select(F.col("lang").alias("label"), "text"))
    out = {r["doc_id"]: r for r in language_id.predict(data, model).collect()}
    assert all(out[i]["lang_pred"] == k and 0.5 < out[i]["score"] <= 1 for i, _, k in docs)
    assert [out[i]["lang_pred"] for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "xx", "yy"]
    assert out[900]["score"] == 0


def test_language_id_equals_plain_naive_bayes(spark):
    texts = [("aa", "abab Cd"), ("bb", "xyxé"), ("aa", "ba")]
    data = spark.createDataFrame([(k, t) for k, t in texts], "label string, text string")
    buckets, alpha = 1 << 10, 0.5
    model = language_id.train(data, 2, buckets, alpha)
    ids = lambda t: [int(x) for n in (1, 2) for x in _grams(t, n, buckets)]
    counts = {k: Counter(i for l, t in texts if l == k for i in ids(t)) for k in ("aa", "bb")}
    out = language_id.predict(spark.createDataFrame([(1, "abx")], "doc_id long, text string"), model, 2, buckets).first()
    joint = [math.log({"aa": 2, "bb": 1}[k] / 3) + sum(math.log((counts[k][i] + alpha) / (sum(counts[k].values()) + alpha * buckets)) for i in ids("abx")) for k in ("aa", "bb")]
    assert out["lang_pred"] == "aa"
    joint.append(math.log(language_id.UNKNOWN) - len(ids("abx")) * math.log(buckets))
    assert out["score"] == pytest.approx(1 / sum(math.exp(x - joint[0]) for x in joint), rel=1e-4)


def _grams(text, n, buckets):
    _, _, data, offsets = next(K.pieces(pa.array([text])))
    codes, first = language_id._codes(data, offsets)
    return language_id._buckets(codes, first, n, buckets)[0]


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))).select(F.col("lang").alias("label"), "text"))
    both = language_id.predict(docs, model).join(docs, "doc_id").where(language_id.held_out(F.col("doc_id")))
    assert both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_language_id_nothing_to_learn(spark):
    none = spark.createDataFrame([], "label string, text string")
    out = language_id.predict(frame(spark, [(1, "abc"), (2, None)]), language_id.train(none)).collect()
    assert {r["lang_pred"] for r in out} == {"und"}


PII_TEXTS = [
    "write to a.b+c@mail.example.com, or x@y@z.org and me@host",
    "a@b.co_x@d.ef.",
    "ip 10.0.0.1 999.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.4 300.1.2.3.4",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 1234567890123456789012 and 4111111111111111",
    "call +1 (988) 555-2485 or +12 or +1234567 or +49 30 123456 or + 1 2345678",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" password=b7db7aa4a5fcc78305 é 🙂 x@y.de',
    "", None, "@" * 3000, "+1" * 500, "1." * 2000, "a@b" + ".c" * 5000, "9" * 20000, "1 " * 9000, "a" * 50000 + "@",
]


def test_pii_base_spans(spark):
    docs = list(enumerate(PII_TEXTS)) + [(None, "x@y.zz"), (3, PII_TEXTS[3])]
    out = pii.find_spans(frame(spark, docs)).collect()
    assert len(out) == len(docs)
    for r in out:
        text = "x@y.zz" if r["doc_id"] is None else PII_TEXTS[r["doc_id"]]
        spans = brute.op4(text)
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == [(k, a, b) for k, v in spans.items() for a, b in v], text
        assert set(r["base"]) <= set(r["spans"])


def test_pii_adds_secrets_and_redacts(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate(PII_TEXTS[:6])] + [(10 + i, f"token = \"{i:040x}\" of") for i in range(5)] + [(50, "clean text, no. 12"), (51, None), (52, "a@b.de")] * 2)
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[5] == "<secret>\" <secret> é 🙂 <email>" and texts[50] == "clean text, no. 12" and texts[51] is None and texts[52] == "<email>"


def test_pii_redacts_whole_long_secrets(spark):
    value = lambda n: "aB3_" * (n // 4)
    sizes = (40, 512, 516, 800, 5000, 200_000)
    docs = frame(spark, [(n, f"token = \"{value(n)}\" of") for n in sizes])
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.find_spans(docs).collect()}
    assert spans == {n: [("secret", 0, 9 + n)] for n in sizes}
    assert {r["text"] for r in pii.redact(docs).collect()} == {"<secret>\" of"}


def test_pii_redaction_of_long_texts(spark):
    rng = random.Random(5)
    parts = [rng.choice(["é🙂 word ", "a.b@mail.com ", "+1 (988) 555-2485 ", "10.0.0.1 ", "x" * 700 + " "]) for _ in range(6000)]
    text = "".join(parts)
    want, at = "", 0
    spans = pii.find_spans(frame(spark, [(1, text)])).first()["spans"]
    assert len(spans) > 2000
    for start, end, kind in sorted((x["start"], x["end"], x["kind"]) for x in spans):
        if start >= at:
            want += text[at:start] + f"<{kind}>"
        at = max(at, end)
    assert pii.redact(frame(spark, [(1, text)])).first()["text"] == want + text[at:]


def test_pii_expectation_maximisation():
    counts = {("email", 1, 1, 1): 50, ("email", 0, 0, -1): 40, ("email", 1, 0, -1): 3}
    posterior, fitted = pii.expectation_maximisation(counts)
    assert posterior["email", 1, 1, 1] > 0.95 and posterior["email", 0, 0, -1] < 0.05
    assert fitted["email"]["hit"][0] > 0.9
    assert pii.expectation_maximisation({}) == ({}, {})


def test_quality(spark, docs):
    out = quality.judge(frame(spark, docs))
    got = as_dict(out, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == brute.op7(docs)
    assert all(not r["kept"] for r in out.collect() if r["base_failed"])


def test_quality_hosts(spark):
    good, bad = prose(60), "spam " * 20
    rows = [(i, good, "clean.org") for i in range(30)] + [(100 + i, bad, "bad.org") for i in range(29)] + [(200, good, "bad.org"), (201, bad, "small.org"), (202, good, None)]
    out = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0]["kept"] and not out[200]["kept"] and out[202]["kept"] and not out[201]["kept"]
    assert out[202]["host_rate"] is None


def test_quality_empty(spark):
    assert quality.judge(frame(spark, [])).count() == 0


def test_url_rules(spark):
    urls = [
        "http://a.example.com/en/1?x#y", "https://WWW.Example.com/en/", "http://m.www.example.com/en/x", "http://x.net/es/1", "http://x.net/en/", "http://net/fr/",
        "http://notexample.com/en/", "http://example.com", "nonsense", None, "ftp://a.b://c/d", "http://host.org:80?q#f", "://", "http://examplexcom/en/",
    ]
    pages = spark.createDataFrame([(i, u, None, "c") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: tuple(r)[1:5] for r in url_filter.filter_urls(pages, URL_RULES).collect()}
    want = [
        ("a.example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"), ("m.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("x.net", "/es/1", "net/es/", "block"), ("x.net", "/en/", None, "allow"), ("net", "/fr/", "net/fr/", "block"), ("notexample.com", "/en/", "com/", "allow"),
        ("example.com", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.b:", "//c/d", None, "allow"), ("host.org:80", "", None, "allow"), ("", "", None, "allow"), ("examplexcom", "/en/", None, "allow"),
    ]
    assert [got[i] for i in range(len(urls))] == want


def test_url_aliases(spark):
    link = "<LINK href='{}' rel=canonical>".format
    pages = [
        (1, "http://x.net/fr/bad", None),
        (2, "http://alias.org/a", link("http://x.net/fr/bad")),
        (3, "http://alias.org/b#top", '<meta http-equiv="refresh" content="0; url=/a">'),
        (4, "http://ok.com/c", link("http://alias.org/a")),
        (5, "http://other.org/", link("http://other.org/")),
        (6, "https://alias.org/b", ""),
        (6, "https://alias.org/b", ""),
        (7, "http://far.org/z", None),
    ]
    redirects = spark.createDataFrame([("http://far.org/z", "http://alias.org/b"), (None, "x"), ("nonsense", None)], "from_url string, to_url string")
    out = url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES, redirects).collect()
    assert len(out) == 8
    assert {r["page_id"]: (r["verdict"], r["via"]) for r in out} == {1: ("block", "rule"), 2: ("block", "alias"), 3: ("block", "alias"), 4: ("allow", "rule"), 5: ("allow", "default"), 6: ("block", "alias"), 7: ("block", "alias")}


def test_url_aliases_are_unescaped_and_resolved(spark):
    link = '<link rel="canonical" href="{}">'.format
    pages = [
        (1, "http://s.org/a/b/p?x=1&y=2", link("http://x.net/fr/1?u=1&amp;v=2")),
        (2, "http://x.net/fr/1?u=1&v=2", None),
        (3, "http://s.org/a/b/q", link("../../a/b/p?x=1&#38;y=2")),
        (4, "http://s.org/a/b/p?z=3", link("?x=1&#x26;y=2")),
        (5, "http://s.org/a/r", '<meta http-equiv="refresh" content="0; url=./b/../b/q">'),
        (6, "http://t.org/a", link("/b?k=1&copy=2")),
        (7, "http://t.org/b?k=1&copy=2", link("http://x.net/es/")),
        (8, "http://u.org/", link("/go?to=http://x.net/fr/1")),
        (9, "http://v.org/", link("http://[x/")),
        (10, "nonsense", link("?x=1")),
        (11, None, link("../a")),
    ]
    out = url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES).collect()
    got = {r["page_id"]: r["via"] for r in out if r["verdict"] == "block"}
    assert got == {2: "rule", **dict.fromkeys((1, 3, 4, 5, 6, 7), "alias")}


def test_packing_round_trip(spark, docs):
    import numpy as np
    from tokenizers import Tokenizer

    mine = [*docs, (500, "It's. <|endoftext|>x <|ENDOFTEXT|> a<|startoftext|>. İ ΑΣ. ﬁ é e\u0301 =\u0338 \x1c\x85 \u00a0'S, x.'s don't."), (None, "hi"), (303, "one")]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack(frame(spark, mine), tokenizer_path(), 64).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    got = {}
    for r in sorted(rows, key=lambda r: (r["start"], r["sequence_id"])):
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 64 and r["offset"] == 0 and r["length"] == len(r["ids"]) // 4
        got.setdefault(r["doc_id"], []).append(r)
    for d, t in mine:
        want = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        parts = {r["start"]: r for r in got[d]}  # the repeated row's pieces are equal
        assert np.frombuffer(b"".join(parts[s]["ids"] for s in sorted(parts)), "<u4").tolist() == want
        assert all(r["doc_tokens"] == len(want) for r in got[d])


def test_piece_lengths():
    assert packing.piece_lengths(13, 8) == [8, 4, 1] and packing.piece_lengths(16, 8) == [8, 8] and packing.piece_lengths(1, 8) == [1]


def test_lm_scores(spark, docs):
    for order in (1, 2, 3):
        out = {r["doc_id"]: r for r in lm_score.score(frame(spark, docs), order=order, block_bytes=20_000).collect()}
        want = backoff(docs, order)
        assert out.keys() == want.keys()
        for d, s in want.items():
            assert out[d]["log_score"] == pytest.approx(s, rel=1e-9, abs=1e-9)
    assert out[300]["mean_log_score"] is None and out[300]["n_words"] == 0


def backoff(docs, order):
    texts = {d: brute.words(t) for d, t in docs}
    grams = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    counts = Counter(g for w in texts.values() for k in range(1, order + 1) for g in grams(w, k))
    total = sum(map(len, texts.values()))
    out = {}
    for d, w in texts.items():
        own = Counter(g for k in range(1, order + 1) for g in grams(w, k))
        left = lambda g: counts[g] - own[g]  # noqa: B023, E731
        s = 0.0
        for i in range(len(w)):
            k = min(order, i + 1)
            factor = 0.0
            while k > 1 and not left(tuple(w[i - k + 1 : i + 1])):
                k, factor = k - 1, factor + math.log(0.4)
            g, rest = tuple(w[i - k + 1 : i + 1]), total - len(w)
            if k > 1:
                s += factor + math.log(left(g) / left(g[:-1]))
            else:
                s += factor + (math.log(left(g) / rest) if left(g) else -math.log(rest + 1))
        out[d] = s
    return out


def test_lm_query_scores_with_trigrams(spark):
    sf = "/root/testdata/sf0.001"
    out = {r["doc_id"]: r for r in queries()["op6_lm_score"](spark, sf).collect()}
    want = backoff([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], 3)
    assert out.keys() == want.keys()
    for d, s in want.items():
        assert out[d]["log_score"] == pytest.approx(s, rel=1e-9, abs=1e-9)


def test_lm_single_and_empty(spark):
    assert lm_score.score(frame(spark, [(1, "a b")])).first()["log_score"] == pytest.approx(2 * 0 + math.log(0.4))
    assert lm_score.score(frame(spark, [])).count() == 0


def test_licences(spark):
    files = [
        (1, "a/LICENSE", "Licensed under the MIT License.\nmore"),
        (2, "a/b/c.py", "code"),
        (3, "a/b/d/e.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
        (4, "x/y.py", "code"),
        (5, "a/b/d/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (6, "a/b/d/f.py", None),
        (7, "a/z.py", "we license nothing of the sort to whoever may come along here"),
        (8, None, "Released under the MIT License."),
        (8, None, "Released under the MIT License."),
    ]
    data = spark.createDataFrame([(d, t, p, "c") for d, p, t in files], "doc_id long, text string, p string, path string")
    out = license_scan.scan(data, F.col("p")).collect()
    got = {r["doc_id"]: (r["licence"], r["origin"], r["licence_dir"]) for r in out}
    assert len(out) == len(files)
    assert got == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "own", None), 4: (None, None, None), 5: ("GPL-3.0", "own", None),
        6: ("GPL-3.0", "inherited", "a/b/d"), 7: ("MIT", "inherited", "a"), 8: ("MIT", "own", None),
    }


@pytest.mark.parametrize(
    "apply",
    [
        lambda d, s: substring_dedup.remove_repeats(d),
        lambda d, s: license_scan.scan(d, F.col("source")),
        lambda d, s: language_id.predict(d, language_id.train(d.select(F.col("lang").alias("label"), "text"))),
        lambda d, s: pii.find_spans(d),
        lambda d, s: pii.redact(d),
        lambda d, s: jaccard_join.link_near_copies(d),
        lambda d, s: packing.pack(d, tokenizer_path()),
        lambda d, s: decontaminate.find_contamination(d, s.createDataFrame([(1, "a b")], "item_id long, text string")),
        lambda d, s: lm_score.score(d),
    ],
)
def test_empty_table_and_all_null(spark, apply):
    assert apply(frame(spark, []), spark).count() == 0
    nulls = spark.createDataFrame([(None,) * 14] * 2, SCHEMA)
    assert apply(nulls, spark).count() == 2


def thue_morse(n, a, b):
    return [a if bin(i).count("1") % 2 == 0 else b for i in range(n)]


@pytest.mark.parametrize("size", [1024, 4096])
def test_structured_words_and_texts_have_different_hashes(size):
    words = ["".join(thue_morse(size, *p)) for p in ("ab", "ba")]
    texts = [" ".join(thue_morse(size, *p)) for p in (("x", "y"), ("y", "x"))]
    for seed in (11, 12, 21, 22, 31, 41):
        _, _, data, offsets = next(K.pieces(pa.array(words), 1 << 20))
        h = K.Words(data, offsets).hashes(seed)
        assert h[0] != h[1]
        _, _, data, offsets = next(K.pieces(pa.array(texts), 1 << 20))
        w = K.Words(data, offsets)
        h = w.hashes(seed)
        assert len(set(K.row_hashes(h, w.first).tolist())) == 2
        assert len(set(K.Windows(h).at(w.first[:-1], size).tolist())) == 2


def test_structured_texts_are_no_copies(spark):
    words = ["".join(thue_morse(1024, *p)) for p in ("ab", "ba")]
    docs = [(i, " ".join([w, *(f"w{j}" for j in range(i, i + 60))])) for i, w in enumerate(words)]
    docs += [(10 + i, " ".join(thue_morse(2048, *p))) for i, p in enumerate((("x", "y"), ("y", "x")))]
    out = substring_dedup.remove_repeats(frame(spark, docs))
    assert as_dict(out, "n_words", "n_removed", "kept_sha256") == brute.op1(docs)
    items = spark.createDataFrame([(1, words[0]), (2, docs[2][1])], "item_id long, text string")
    out = as_dict(decontaminate.find_contamination(frame(spark, docs), items), "n_words", "n_hit")
    expected = brute.op10(docs, [(1, words[0]), (2, docs[2][1])])
    assert out == {k: v[:2] for k, v in expected.items()}


def test_quality_host_verdicts_reject_documents_that_pass(spark):
    """Two sorts of hosts, some small: the shrunk rates decide as plain moments do."""
    good, bad = prose(60), "spam " * 20
    plan = {"a": (40, 1), "b": (30, 0), "c": (25, 24), "d": (50, 45), "e": (2, 1), "f": (1, 1), "g": (1, 0)}
    rows, i = [], 0
    for host, (n, failed) in plan.items():
        for j in range(n):
            rows.append((i, bad if j < failed else good, host))
            i += 1
    total, fails = sum(n for n, _ in plan.values()), sum(f for _, f in plan.values())
    mean = fails / total
    over = sum((f - n * mean) ** 2 - n * mean * (1 - mean) for n, f in plan.values())
    weight = max(1.0, mean * (1 - mean) * sum(n * (n - 1) for n, _ in plan.values()) / over - 1)
    rate = {h: (f + mean * weight) / (n + weight) for h, (n, f) in plan.items()}
    out = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for i, text, host in rows:
        assert out[i]["host_rate"] == pytest.approx(rate[host])
        assert out[i]["kept"] == (text == good and rate[host] < 0.5)
    assert sum(not out[i]["kept"] for i, text, _ in rows if text == good) == 6


def test_quality_prior_of_hosts_alike_is_strong(spark):
    hosts = spark.createDataFrame([(f"h{i}", 10, 5) for i in range(50)], "host string, n long, failed long")
    alpha, beta = quality.beta_prior(hosts)
    assert alpha == beta and alpha + beta == quality.MAX_WEIGHT


def test_url_aliases_equal_union_find(spark):
    """Chains and stars of canonical links and redirects, against a plain union-find."""
    rng = random.Random(9)
    rules = [("block", "bad.net", "/"), ("allow", "good.com", "/"), ("block", "x.org", "/private/")]
    urls = [f"https://{h}/{p}{i}" for i in range(60) for h, p in [rng.choice([("bad.net", ""), ("good.com", ""), ("x.org", ""), ("x.org", "private/"), ("y.org", ""), ("z.org", "")])]]
    links = [(rng.choice(urls), rng.choice(urls)) for _ in range(25)]
    links += list(zip(urls[:12], urls[1:13], strict=True))  # a long chain
    redirects = [(rng.choice(urls), rng.choice(urls)) for _ in range(8)]
    html = {}
    for a, b in links:
        html[a] = html.get(a, "") + rng.choice(['<link rel="canonical" href="%s">', '<meta http-equiv="refresh" content="0; url=%s">']) % b
    parent = {u: u for u in urls}

    def find(u):
        while parent[u] != u:
            u = parent[u]
        return u

    for a, b in links + redirects:
        parent[find(a)] = find(b)
    own = {u: next((v for v, h, p in rules if u.startswith(f"https://{h}{p}")), None) for u in urls}
    bad = {find(u) for u in urls if own[u] == "block"}
    pages = spark.createDataFrame([(i, u, html.get(u)) for i, u in enumerate(urls)], "page_id long, url string, html string")
    out = url_filter.filter_urls(pages, rules, spark.createDataFrame(redirects, "from_url string, to_url string")).collect()
    got = {r["page_id"]: r["verdict"] for r in out}
    assert got == {i: own[u] or ("block" if find(u) in bad else "allow") for i, u in enumerate(urls)}
    assert sum(r["via"] == "alias" for r in out) > 5
    empty = pages.limit(0)
    assert url_filter.filter_urls(empty, rules).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages.withColumn("html", F.lit(None).cast("string")), []).collect()} == {"allow"}


def test_url_rules_as_a_table_decide_alike(spark, monkeypatch):
    urls = ["http://example.com/en/a", "http://www.example.com/en/a", "http://a.b.net/es/", "http://net/fr/x", "http://x.com/", "http://x.org/", "nothing", None, "http://b.net"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    rows = lambda: sorted(map(tuple, url_filter.filter_urls(pages, URL_RULES).collect()))
    expected = rows()
    monkeypatch.setattr(url_filter, "EXPRESSION_RULES", 0)
    assert rows() == expected


def test_language_score_tells_text_from_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.train(docs.select(F.col("lang").alias("label"), "text"))
    rng = random.Random(2)
    noise = [(i, "".join(rng.choice("qxzjkvwy ") for _ in range(2000))) for i in range(5)]
    clean = {r["doc_id"]: r["score"] for r in language_id.predict(docs, model).collect()}
    odd = [r["score"] for r in language_id.predict(spark.createDataFrame(noise, "doc_id long, text string"), model).collect()]
    assert min(clean.values()) > 0.8 and max(odd) < 0.2


def _licence(spark, rows):
    files = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    return {r["path"]: r for r in license_scan.scan(files, F.col("path")).collect()}


def test_whole_licence_files_and_their_folders(spark):
    bsd, names = license_scan._BSD, license_scan._BSD_NAMES
    rest = 'The above copyright notice and this permission notice shall be included in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
    wrap = lambda t, mark="": "\n".join(mark + " ".join(t.split()[i : i + 9]) for i in range(0, len(t.split()), 9))
    files = {
        "MIT": f"MIT License\n\nCopyright (c) 2020 Ann Other\n\n{wrap(license_scan._MIT)}\n\n{rest}",
        "BSD-2-Clause": "Copyright 2020 Ann Other\n\n" + "\n\n".join(map(wrap, bsd)),
        "BSD-3-Clause": "Copyright 2020 Ann Other\n\n" + "\n\n".join(map(wrap, [*bsd[:3], names, bsd[3]])),
        "ISC": f"Copyright 2020 Ann Other\n\n{wrap(license_scan._ISC)}\n\n{rest}",
        "Apache-2.0": "   Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE\n\n" + "   1. Definitions of many words.\n\n" * 50,
        "GPL-3.0": "  GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\n Preamble\n\n" + "The licenses for most software take away your freedom to share.\n\n" * 30,
        "LGPL-3.0": "  GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\n This version incorporates the terms of the GNU General Public License.\n",
    }
    header = next(t for n, t in license_scan.TEMPLATES if n == "GPL-3.0" and t.startswith("This program"))
    rows = [(f"{n}/LICENSE", t) for n, t in files.items()] + [(f"{n}/src/x.py", "print(1)") for n in files]
    rows += [("w/a.py", wrap(header, "# ") + "\n\nimport os\n"), ("w/b.c", "/*\n" + wrap(header, " * ") + "\n */\nint x;"), ("w/c.py", "# the license of a dog\n")]
    out = _licence(spark, rows)
    for n in files:
        assert (out[f"{n}/LICENSE"]["licence"], out[f"{n}/src/x.py"]["licence"], out[f"{n}/src/x.py"]["licence_dir"]) == (n, n, n)
    assert out["w/a.py"]["licence"] == out["w/b.c"]["licence"] == "GPL-3.0" and out["w/c.py"]["licence"] is None


def test_licence_scores_equal_plain_tf_idf(spark):
    lines = ["Licensed under the MIT License.", "licensed under the apache license", "All rights reserved by nobody", "Copyright 2020 Ann", "Licensed under the MIT License."]
    terms = lambda t: __import__("re").findall(r"[^\W_]+(?:\.[^\W_]+)*", t.lower())
    units = [terms(x) for x in lines] + [terms(t) for _, t in license_scan.TEMPLATES]
    df = Counter(w for u in units for w in set(u))
    weigh = lambda u: {w: n * (math.log((len(units) + 1) / (df[w] + 1)) + 1) for w, n in Counter(u).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = _licence(spark, [(f"d{i}/f{i}.txt", x) for i, x in enumerate(lines)])
    for i, x in enumerate(lines):
        a = weigh(terms(x))
        best = max((sum(a[w] * b.get(w, 0) for w in a) / norm(a) / norm(b), n) for n, t in license_scan.TEMPLATES for b in [weigh(terms(t))])
        got = out[f"d{i}/f{i}.txt"]
        assert got["score"] == (pytest.approx(best[0], abs=1e-6) if best[0] >= 0.6 else None)


def test_lm_counts_need_little_disk(spark, monkeypatch):
    """What goes back to the blocks is smaller than the text, and n-grams themselves are never written."""
    import glob
    import random

    from lexstrata.llm.scratch import Scratch

    written, save = {}, Scratch.save

    def measured(self, df, name):
        out = save(self, df, name)
        written[name] = sum(os.path.getsize(f) for f in glob.glob(f"{self.base.removeprefix('file://').removeprefix('file:')}/{name}/*.parquet"))
        return out

    monkeypatch.setattr(Scratch, "save", measured)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    data = [(i, " ".join(rng.choices(words, k=400))) for i in range(300)]
    assert lm_score.score(frame(spark, data), block_bytes=200_000).count() == 300
    size = sum(len(t) for _, t in data)
    assert 0 < sum(n for name, n in written.items() if not name.startswith("scores")) < size
    assert not any(name.startswith("grams") for name in written)


def test_near_copies_write_few_rows(spark, monkeypatch):
    """Heads gather in one row of a class, an edge is one row, and the zone is looked at in parts."""
    from lexstrata.llm.scratch import Scratch

    written, save = {}, Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        if name.startswith(("near", "edges-near", "cc-near-0-edges-0", "zone", "classes")) and "texts" not in name:
            written[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "save", counted)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    data = [(i, " ".join(rng.choice("abc") + w if rng.random() < 0.02 else w for w in base)) for i in range(120)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_near_copies(frame(spark, data)).collect()}
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in data}
    comp = {i: i for i in sets}

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((top(i), top(j)))
                comp[y] = x
    assert got == {i: top(i) for i in sets}
    assert "near-0" not in written and written["near-pairs-0"] <= 3 * written["classes"]
    assert written["cc-near-0-edges-0"] <= written["edges-near-0"]
    assert "zone" not in written and 0 < written["zone-0"] < 0.7 * (written["zone-0"] + written["zone-1"])


def test_screen_of_near_copies_only_scans_texts(spark, monkeypatch):
    """Whole texts are not shuffled for the zone; components join the shingles that classes share."""
    from lexstrata.llm.scratch import Scratch

    plans, save = {}, Scratch.save

    def seen(self, df, name):
        if name in ("zone-0", "zone-common-0"):
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name)

    monkeypatch.setattr(Scratch, "save", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = [f"w{i}" for i in range(80)]
        data = [(1, " ".join(words)), (2, " ".join([*words[:70], "x"])), (3, " ".join(words[40:60] + ["a"] * 60)), (4, "one two three four five six")]
        got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_near_copies(frame(spark, data)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    assert not any(x in plans["zone-0"] for x in ("Join", "Exchange"))
    assert "text#" not in plans["zone-common-0"]


def test_blocks_of_near_copies_give_no_more_pairs_than_rows():
    """A pass picks the closest pair of each component, names blocks that have others, and the last pass gives all."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 200, np.uint64)
    for m in (20, 300):  # a leaf, a tree
        sets = [np.sort(np.concatenate([rng.permutation(base)[:190], rng.integers(0, 2**63, 10, np.uint64)])) for _ in range(m)]
        same = lambda v: pa.array([v] * m, pa.int64())  # noqa: B023, E731
        own = pa.array(range(m), pa.int64())
        columns = {"token": same(7), "pa": same(0), "pb": same(0), "side": same(2), "cls": own, "component": own, "n": same(200), "rank": same(0), "pos": same(0)}
        columns |= {"head": pa.array([[7]] * m, pa.list_(pa.int64())), "mh": pa.array([[i, i, i] for i in range(m)], pa.list_(pa.int64())), "bits": pa.array([jaccard_join.bitmap(s) for s in sets], pa.binary())}
        batch = pa.RecordBatch.from_pydict(columns)
        run = lambda pick: [r for out in jaccard_join._block_pairs(75, pick)([batch]) for r in out.to_pylist()]  # noqa: B023, E731
        every = {(r["a"], r["b"]) for r in run(False)}
        assert len(every) == m * (m - 1) // 2
        picked = run(True)
        pairs = [(r["a"], r["b"]) for r in picked if r["token"] is None]
        assert 0 < len(pairs) <= m and set(pairs) <= every and {x for p in pairs for x in p} == set(range(m))
        assert [r["token"] for r in picked if r["token"] is not None] == [7]
