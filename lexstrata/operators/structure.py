"""Lines to a legal hierarchy: kinds, headings, re-joined paragraphs, Markdown, chunks.

The look-behind that a line's meaning needs is one line deep, so everything is windows over
one partitioning by document: a kind per line, flags carried forward, a running sum of
breaks that numbers paragraphs, and an ordered join of their pieces.  One shuffle on
``doc_id`` serves them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import all_caps, is_roman, let, strip, strip_cheaply
from . import lines as L

JOIN = "\x01"


def _group(c: Column, pattern: str, n: int) -> Column:
    return F.regexp_extract(c, pattern, n)


def is_part_heading(x: Column, p: P.Patterns) -> Column:
    """Title, chapter or section with numeral; not if what follows reads like prose."""
    return x.rlike(p.part) & ~F.when(strip(_group(x, p.part, 2)) != "", strip(_group(x, p.part, 2)).rlike(p.prose)).otherwise(False)


def is_roman_item(x: Column, p: P.Patterns) -> Column:
    return x.rlike(p.roman) & is_roman(_group(x, p.roman, 1))


def is_part_name(x: Column, p: P.Patterns) -> Column:
    """Whether a line can be the name of the part whose heading stands above it."""
    other = x.rlike(r"(?U)^\d") | x.rlike(p.article) | is_part_heading(x, p) | x.rlike(p.ordinal_article) | x.rlike(p.transitory) | is_roman_item(x, p)
    looks = all_caps(x) | (x.rlike(p.name) & (F.char_length(x) < 80))
    return (x != "") & (F.char_length(x) <= 100) & ~other & looks


def split_transitory(lines: DataFrame, p: P.Patterns) -> DataFrame:
    """(doc_id, line_no, sub_no, x): ``Transitorios rest`` becomes a heading row and a row for the rest.

    A line that stands where a part's name is due and reads like one stays whole; such a
    line never opens with the heading, so the test needs no look-behind.
    """

    def parts(x: Column) -> Column:
        opens = x.rlike(p.transitory) & ~x.startswith(">") & ~x.startswith("|")
        head = _group(x, p.transitory, 1)
        rest = strip(F.substring(x, F.char_length(head) + 1, F.char_length(x)))
        return F.when(opens & (rest != ""), F.array(head, rest)).otherwise(F.array(x))

    return lines.select("doc_id", "line_no", F.posexplode(let(strip_cheaply(F.col("text")), parts)).alias("sub_no", "x"))


def _order(doc: str = "doc_id"):
    return Window.partitionBy(doc).orderBy("line_no", "sub_no")


def classify(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Rows (doc_id, line_no, sub_no, x, kind, heading, body, guarded, in_transitory).

    Kinds: blank, quote, table, name, transitory, ordinal_article, article, part,
    transitory_ordinal, fraction, clause, text.  ``guarded`` articles are references in a
    sentence and count as text.
    """
    p = P.STRICT if strict else P.COMPAT
    rows = split_transitory(lines, p)
    x, first = F.col("x"), F.col("sub_no") == 0
    shape = (
        F.when(first & (x == ""), "blank")
        .when(first & x.startswith(">"), "quote")
        .when(first & x.startswith("|"), "table")
        .when(first & x.rlike(p.transitory), "transitory")
        .when(x.rlike(p.ordinal_article), "ordinal_article")
        .when(x.rlike(p.article), "article")
        .when(is_part_heading(x, p), "part")
        .otherwise("text")
    )
    rows = rows.withColumn("shape", shape)
    shape = F.col("shape")
    heading = (
        F.when(shape == "ordinal_article", F.regexp_replace(strip(_group(x, p.ordinal_article, 1)), r"\.+$", ""))
        .when(shape == "article", F.regexp_replace(strip(_group(x, p.article_split, 1)), r"\.+$", ""))
        .when(shape == "part", strip(_group(x, p.part, 1)))
        .when(shape == "transitory", _group(x, p.transitory, 1))
    )
    body = (
        F.when(shape == "ordinal_article", strip(F.regexp_replace(strip(_group(x, p.ordinal_article, 2)), r"^[.\-]+", "")))
        .when(shape == "article", strip(F.regexp_replace(_group(x, p.article_split, 2), r"^[.\-\s]+" if strict else r"^$", "")))
        .when(shape == "part", strip(_group(x, p.part, 2)))
        .otherwise("")
    )
    rows = rows.withColumns({"heading": heading, "body": body, "is_ordinal": x.rlike(p.transitory_ordinal), "is_name": first & is_part_name(x, p)})

    # one line back: is a part's name due, and does the open paragraph end in a connector?
    w = _order()
    due = (F.lag("shape").over(w) == "part") & (F.lag("body").over(w) == "")
    named = F.coalesce(due, F.lit(False)) & F.col("is_name") & ~shape.isin("blank", "quote", "table")
    rows = rows.withColumn("named", named)
    text = F.when(shape.isin("article", "ordinal_article"), F.col("body")).when(shape == "text", x).otherwise("")
    rows = rows.withColumn("said", F.when(F.col("named"), "").otherwise(text))
    glued = F.lag("said").over(w).endswith("-") & (shape == "text") & ~F.col("is_ordinal")
    rows = rows.withColumn("tail", F.when(glued, F.concat(F.regexp_replace(F.lag("said").over(w), "-$", ""), F.col("said"))).otherwise(F.col("said")))
    ends = F.right("tail", F.lit(24)).rlike(p.connector)  # connectors are shorter
    rows = rows.withColumn("ends", (F.col("said") != "") & ends)
    guard = F.coalesce(F.lag("ends").over(w), F.lit(False))
    rows = rows.withColumn("guarded", shape.isin("article", "ordinal_article") & ~F.col("named") & guard)
    turn = F.when(~F.col("named") & (shape == "transitory"), True).when(~F.col("named") & (shape == "article") & ~F.col("guarded"), False)
    rows = rows.withColumn("in_transitory", F.coalesce(F.last(turn, ignorenulls=True).over(w), F.lit(False)))
    kind = (
        F.when(F.col("named"), "name")
        .when(F.col("guarded"), "text")
        .when(shape != "text", shape)
        .when(F.col("in_transitory") & F.col("is_ordinal"), "transitory_ordinal")
        .when(is_roman_item(x, p), "fraction")
        .when(x.rlike(p.clause), "clause")
        .otherwise("text")
    )
    return rows.withColumn("kind", kind).select("doc_id", "line_no", "sub_no", "x", "kind", "heading", "body", "guarded", "in_transitory")


def _transitory_piece(x: Column, p: P.Patterns) -> Column:
    """``**Primero.-** rest`` with the separator that the line has."""
    raw = _group(x, p.transitory_ordinal, 1)
    rest = strip(F.regexp_replace(strip(_group(x, p.transitory_ordinal, 2)), r"^[.\-]+", ""))
    mark = F.when(F.contains(F.substring(x, F.lit(1), F.char_length(raw) + 3), F.lit(".-")), ".-").otherwise(".")
    bold = F.concat(F.lit("**"), strip(raw), mark, F.lit("**"))
    return F.when(rest != "", F.concat(bold, F.lit(" "), rest)).otherwise(bold)


def pieces(kinds: DataFrame, strict: bool = False) -> DataFrame:
    """``classify`` rows with ``piece`` (what a line adds to a paragraph; empty: nothing),
    ``breaks`` (it starts one), ``open_before`` (a paragraph was open), ``para_no``."""
    p = P.STRICT if strict else P.COMPAT
    w = _order()
    kind, x = F.col("kind"), F.col("x")
    piece = (
        F.when(kind == "transitory_ordinal", _transitory_piece(x, p))
        .when(kind.isin("fraction", "clause", "text"), x)
        .when(kind.isin("article", "ordinal_article"), F.col("body"))
        .otherwise("")
    )
    rows = kinds.withColumn("piece", piece)
    before = F.coalesce(F.lag("piece").over(w), F.lit(""))
    sentence = before.rlike(r"[.;:]$") & x.rlike(r"^\p{IsUppercase}") & ~F.col("guarded")
    breaks = F.when(F.col("piece") == "", False).when(kind == "text", (before == "") | sentence).otherwise(True)
    rows = rows.withColumns({"open_before": before != "", "breaks": breaks, "glued": before.endswith("-") & (kind == "text") & ~F.col("guarded")})
    return rows.withColumn("para_no", F.sum(F.col("breaks").cast("int")).over(w))


def _marked() -> Column:
    """A piece, with a mark in front where it is glued to a hyphen."""
    return F.when(F.col("glued"), F.concat(F.lit(JOIN), F.col("piece"))).otherwise(F.col("piece"))


def _rejoin(marked: Column) -> Column:
    text = F.array_join(marked, " ")
    return strip(F.replace(F.replace(text, F.lit(f"- {JOIN}"), F.lit("")), F.lit(JOIN), F.lit("")))


def paragraphs(parts: DataFrame) -> DataFrame:
    """(doc_id, para_no, line_no, sub_no, kind, text): re-joined paragraphs.

    A hyphen that the next line glued on is taken out; other lines join with one space.
    """
    own = parts.where("piece != ''").groupBy("doc_id", "para_no")
    one = F.struct("line_no", "sub_no", _marked().alias("piece"), "kind")
    rows = own.agg(F.array_sort(F.collect_list(one)).alias("s"))
    text = _rejoin(F.transform("s", lambda e: e["piece"]))
    head = F.get("s", F.lit(0))
    return rows.select("doc_id", "para_no", head["line_no"].alias("line_no"), head["sub_no"].alias("sub_no"), head["kind"].alias("kind"), text.alias("text"))


def split_clauses(c: Column) -> Column:
    """Array of the parts of a paragraph at clauses that run on inside it."""
    plain = ~c.rlike(r"^(?:#|>|---|\*\*)") & (c != "")
    return F.when(plain, F.transform(F.split(c, r"(?U)(?<=[.:])\s+(?=[a-z]\)\s)"), strip)).otherwise(F.array(c))


def markdown(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Whole documents as Markdown lines: (doc_id, out_no, kind, text), without the title block.

    Rows from one paragraph's start to the next are one group: what stands above the
    paragraph, the paragraph, then lines of rows that add nothing to it.  Grouping and
    numbering keep the partitioning by document.
    """
    parts = pieces(classify(L.drop_running_headers(lines, strict), strict), strict)
    w = _order()
    kind, x, heading, body = F.col("kind"), F.col("x"), F.col("heading"), F.col("body")
    name = F.when(F.lead("kind").over(w) == "name", F.concat(F.lit(" — "), F.lead("x").over(w))).otherwise("")
    part = F.concat(F.lit("## "), heading, F.when(body != "", F.concat(F.lit(" — "), body)).otherwise(""), name)
    blank = F.lit("")
    none = F.array().cast("array<string>")
    own = (
        F.when(kind == "blank", F.array(blank))
        .when(kind == "quote", F.array(blank, x, blank))
        .when(kind == "table", _spread(split_clauses(x)))  # table rows can hold clauses, too
        .when(kind == "transitory", F.array(blank, F.concat(F.lit("## "), heading), blank))
        .when(kind.isin("article", "ordinal_article"), F.array(blank, F.concat(F.lit("### "), heading)))
        .when(kind == "part", F.array(blank, part))
        .when(kind.isin("fraction", "clause") & F.col("open_before"), F.array(blank))
        .otherwise(none)
    )
    one = F.struct("line_no", "sub_no", "kind", own.alias("own"), "breaks", _marked().alias("piece"))
    groups = parts.select("doc_id", "para_no", one.alias("e")).groupBy("doc_id", "para_no").agg(F.array_sort(F.collect_list("e")).alias("s"))
    first = F.get("s", F.lit(0))
    opens = F.filter("s", lambda e: e["breaks"])
    said = F.filter("s", lambda e: e["piece"] != "")
    labelled = lambda texts, k: F.transform(texts, lambda v: F.struct(k.alias("kind"), v.alias("text")))
    rest = F.when(F.size(opens) > 0, F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0)))).otherwise(F.col("s"))
    para = _spread(split_clauses(_rejoin(F.transform(said, lambda e: e["piece"]))))
    empty = F.array().cast("array<struct<kind:string,text:string>>")
    top = F.when(F.size(opens) > 0, F.concat(labelled(first["own"], first["kind"]), labelled(para, first["kind"]))).otherwise(empty)
    out = F.concat(top, F.flatten(F.transform(rest, lambda e: labelled(e["own"], e["kind"]))))
    rows = groups.select("doc_id", "para_no", F.posexplode(out).alias("n", "o"))
    order = Window.partitionBy("doc_id").orderBy("para_no", "n")
    return rows.select("doc_id", F.row_number().over(order).alias("out_no"), "o.kind", "o.text")


def _spread(a: Column) -> Column:
    """The elements with an empty line between them."""
    return F.flatten(F.transform(a, lambda v, i: F.when(i == 0, F.array(v)).otherwise(F.array(F.lit(""), v))))


# The block that opens every document.
SOURCE_NOTE = [
    "> Documento generado automáticamente a partir del PDF oficial.",
    "> Fuente: Cámara de Diputados del H. Congreso de la Unión — [diputados.gob.mx](https://www.diputados.gob.mx)",
]


def render(md: DataFrame, titles: DataFrame) -> DataFrame:
    """(doc_id, content): one text per document of ``titles`` (doc_id, title), without a final newline."""
    body = md.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("out_no", "text"))).alias("s"))
    body = body.select("doc_id", F.transform("s", lambda e: e["text"]).alias("body"))
    head = F.array(F.concat(F.lit("# "), F.col("title")), F.lit(""), *map(F.lit, SOURCE_NOTE), F.lit(""), F.lit("---"), F.lit(""))
    all_lines = F.concat(head, F.coalesce("body", F.array().cast("array<string>")))
    return titles.join(body, "doc_id", "left").select("doc_id", F.array_join(all_lines, "\n").alias("content"))


def article_chunks(kinds: DataFrame) -> DataFrame:
    """(doc_id, seq, heading, n_lines, text): one chunk per article heading, and what precedes the first.

    Headings repeat within a document, so (doc_id, seq) is the key.
    """
    head = F.col("kind").isin("article", "ordinal_article")
    rows = kinds.withColumn("seq", F.sum(head.cast("int")).over(_order()))
    one = F.struct("line_no", "sub_no", "x")
    out = rows.groupBy("doc_id", "seq").agg(F.max(F.when(head, F.col("heading"))).alias("heading"), F.count("*").alias("n_lines"), F.array_sort(F.collect_list(one)).alias("s"))
    return out.select("doc_id", "seq", "heading", "n_lines", F.array_join(F.transform("s", lambda e: e["x"]), "\n").alias("text"))


def hierarchy(kinds: DataFrame) -> DataFrame:
    """(doc_id, line_no, sub_no, level, label, part, article): nodes with the part and article they lie in.

    Levels: 1 title, 2 chapter, 3 section, 4 article, 5 fraction, 6 clause; transitory headings are 1.
    """
    kind = F.col("kind")
    level = (
        F.when(kind == "transitory", 1)
        .when(kind == "part", F.when(F.col("heading").rlike("(?iu)^t[íi]tulo"), 1).when(F.col("heading").rlike("(?iu)^cap[íi]tulo"), 2).otherwise(3))
        .when(kind.isin("article", "ordinal_article"), 4)
        .when(kind == "fraction", 5)
        .when(kind == "clause", 6)
    )
    w = _order()
    label = F.coalesce("heading", F.regexp_extract("x", r"^([IVXL]+\.|[a-z]\))", 1))
    part = F.last(F.when(kind.isin("part", "transitory"), F.col("heading")), ignorenulls=True).over(w)
    article = F.last(F.when(kind.isin("article", "ordinal_article"), F.col("heading")).when(kind.isin("part", "transitory"), F.lit("")), ignorenulls=True).over(w)
    rows = kinds.withColumns({"level": level, "label": label, "part": part, "article": F.nullif(article, F.lit(""))})
    return rows.where("level is not null").select("doc_id", "line_no", "sub_no", "level", "label", "part", "article")
