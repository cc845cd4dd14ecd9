"""Personal data by weak supervision, in DataFrame functions only.

1. One narrow pass finds candidate spans of each kind: the four base kinds by their fixed
   patterns, and looser ones (credentials, e-mail addresses spelled out, national phone
   numbers, social security numbers).  Positions follow from the lengths of the texts
   between the matches, summed per document and kind.
2. Three labelers vote on every candidate (1 for, 0 against, -1 abstain): the strict
   regex, a gazetteer (endings, prefixes, key words) and the words just before it.
3. Expectation-maximisation over the counts of vote patterns (kinds x 27 rows at most)
   estimates each labeler's hit and false-alarm rates and so the posterior of a pattern.
4. A final span classifier, naive Bayes over kind, length class, punctuation and votes, is
   trained on the posteriors as soft labels and scores every candidate.  Base spans that
   pass their own checks always stay; others stay at ``accept`` or more, if they touch no
   base span.

Only aggregates over bounded keys reach the driver, and only a table of as many rows goes
back.  Candidates of one document are ordered together, never those of a group.

Defined cases: null text is empty; null doc_id is kept; repeated rows are searched each on
their own; no candidate at all gives empty spans; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .quality import let
from .scratch import Scratch

BASE = ("email", "ip", "card", "phone")
EXTRA = ("email_spelled", "phone_national", "secret", "ssn")
KINDS = BASE + EXTRA

# Patterns.  ``\G`` or a look-behind starts a run at its first character, so a long run
# is read once; possessive groups don't recurse.
_NAME = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_spelled": rf"(?<!{_NAME}){_NAME}{{1,64}}+\s?(?:\[at\]|\(at\)|\{{at\}})\s?[A-Za-z0-9-]{{1,63}}+(?:\s?(?:\[dot\]|\(dot\)|\.)\s?[A-Za-z0-9-]{{1,63}}+){{1,5}}+",
    "phone_national": r"(?<![0-9A-Za-z+.-])(?<!\+[0-9]{1,3}[\x20.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"\b(?:[Pp]assword|PASSWORD|[Pp]asswd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi[_-]?[Kk]ey|API_KEY|[Aa]ccess[_-][Kk]ey)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_.=-]{8,}+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: What a text must hold before a pattern is tried.
_TRIGGERS = {
    "email": lambda t: t.contains("@"),
    "phone": lambda t: t.contains("+"),
    "email_spelled": lambda t: t.rlike(r"[\[({]at[\])}]"),
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_STRICT_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
# Gazetteers: domain endings; first digits of card schemes; country calling prefixes.
_ENDINGS = r"(?i)[.\s)\]](?:com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|us|co|mx)$"
_SCHEMES = r"^[3456]"
_CALLING = r"^\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
# Context: words that announce a kind, and words that announce another sort of number.
_CUES = {
    "email": r"(?i)\b(?:e-?mail|contact|write|reach|address|mail)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|client|from)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|account)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|contact|reach)\b",
    "secret": r"(?i)\b(?:login|credential|auth|key|user|admin)\b",
    "ssn": r"(?i)\b(?:ssn|social|security)\b",
}
_ALIKE = {"email_spelled": "email", "phone_national": "phone"}
_COUNTER = r"(?i)\b(?:version|release|isbn|issn|fig|figure|table|section|chapter|order|item|page|no)\b\.?\s*$"


def _found(text: Column, kind: str) -> Column:
    """Array of (gap before the match, its text, what stands before it)."""
    pattern = PATTERNS[kind]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    rows = F.transform(
        F.filter(F.arrays_zip(hits.alias("m"), between.alias("g")), lambda x: x["m"].isNotNull()),
        lambda x: F.struct(F.char_length(x["g"]).alias("gap"), x["m"].alias("match"), F.right(x["g"], F.lit(40)).alias("before")),
    )
    trigger = _TRIGGERS.get(kind, lambda t: t.rlike(pattern))(text)
    return F.when(trigger, rows).otherwise(F.array().cast("array<struct<gap:int,match:string,before:string>>"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _candidates(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, match, before, strict): one row per candidate."""
    each = rows.select("row", F.explode(F.filter(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("hits")) for k in KINDS)), lambda x: F.size(x["hits"]) > 0)).alias("x"))
    each = each.select("row", "x.kind", F.posexplode("x.hits").alias("i", "h"))
    size = F.char_length("h.match")
    upto = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("h.gap") + size).over(upto)
    each = each.select("row", "kind", (end - size).alias("start"), end.alias("end"), F.col("h.match").alias("match"), F.col("h.before").alias("before"))
    n = F.char_length(_digits(F.col("match")))
    strict = (
        F.when(F.col("kind") == "ip", F.col("match").rlike(_STRICT_IP))
        .when(F.col("kind") == "card", F.when(n.between(16, 19), _luhn(_digits(F.col("match")))).otherwise(False))
        .when(F.col("kind") == "phone", n.between(8, 15))
        .when(F.col("kind") == "ssn", ~F.col("match").rlike(r"^(?:000|666|9)|-00-|-0000$"))
        .when(F.col("kind") == "secret", F.col("match").rlike(r"[=:]\s*[\"']?(?=[^\s]*[0-9])(?=[^\s]*[A-Za-z])"))
        .when(F.col("kind") == "phone_national", ~F.col("match").rlike(r"^\(?[01]"))
        .otherwise(True)
    )
    return each.withColumn("strict", strict)


def _votes(c: DataFrame) -> DataFrame:
    """Adds v1..v3 and the features of the final classifier."""
    kind, match, before = F.col("kind"), F.col("match"), F.col("before")
    cue = F.lit(False)
    for k in KINDS:
        pattern = _CUES[_ALIKE.get(k, k)]
        cue = F.when(kind == k, before.rlike(pattern)).otherwise(cue)
    gazetteer = (
        F.when(kind.isin("email", "email_spelled"), match.rlike(_ENDINGS).cast("int"))
        .when(kind == "card", _digits(match).rlike(_SCHEMES).cast("int"))
        .when(kind == "phone", match.rlike(_CALLING).cast("int"))
        .when(kind == "ip", F.when(match.rlike(r"^(?:0+\.|127\.|255\.|22[4-9]\.)"), 0).otherwise(1))
        .when(kind == "secret", F.when(match.rlike(r"(?i)example|changeme|x{6}|\*{3}"), 0).otherwise(1))
        .otherwise(-1)
    )
    context = F.when(cue, 1).when(before.rlike(_COUNTER), 0).otherwise(-1)
    size = F.least(F.floor(F.char_length(match) / 8).cast("int"), F.lit(4))
    marks = F.when(match.rlike(r"[()\x20]"), 2).when(match.rlike("-"), 1).otherwise(0)
    return c.select("row", "kind", "start", "end", "strict", F.col("strict").cast("int").alias("v1"), gazetteer.alias("v2"), context.alias("v3"), size.alias("size"), marks.alias("marks"))


def expectation_maximisation(counts: dict[tuple, int], rounds: int = 50) -> tuple[dict[tuple, float], dict]:
    """Posterior of every (kind, v1, v2, v3), and each kind's prior and labeler rates.

    Two-class Dawid-Skene with abstentions; every kind starts from labelers that are
    right four times in five, and counts are smoothed by one vote of that sort.
    """
    posterior, fitted = {}, {}
    for kind in sorted({p[0] for p in counts}):
        own = {p[1:]: n for p, n in counts.items() if p[0] == kind}
        prior, hit, alarm = 0.5, [0.8] * 3, [0.2] * 3
        q: dict = {}
        for _ in range(rounds):
            for votes in own:
                yes, no = math.log(prior), math.log(1 - prior)
                for j, v in enumerate(votes):
                    if v >= 0:
                        yes += math.log(hit[j] if v else 1 - hit[j])
                        no += math.log(alarm[j] if v else 1 - alarm[j])
                q[votes] = 1 / (1 + math.exp(min(700.0, no - yes)))
            total = sum(own.values())
            prior = (sum(n * q[p] for p, n in own.items()) + 1) / (total + 2)
            for j in range(3):
                spoke = [(p[j], n, q[p]) for p, n in own.items() if p[j] >= 0]
                hit[j] = (sum(n * w for v, n, w in spoke if v) + 4) / (sum(n * w for _, n, w in spoke) + 5)
                alarm[j] = (sum(n * (1 - w) for v, n, w in spoke if v) + 1) / (sum(n * (1 - w) for _, n, w in spoke) + 5)
        posterior |= {(kind, *p): w for p, w in q.items()}
        fitted[kind] = {"prior": prior, "hit": hit, "false_alarm": alarm}
    return posterior, fitted


FEATURES = ("size", "marks", "v1", "v2", "v3")


def train_classifier(rows: list[tuple], posterior: dict[tuple, float]) -> dict[tuple, float]:
    """Score of every (kind, *FEATURES) seen, by naive Bayes per kind on soft labels.

    ``rows``: (kind, *FEATURES, count).
    """
    scores: dict[tuple, float] = {}
    for kind in sorted({r[0] for r in rows}):
        own = [(r[1:-1], r[-1], posterior[(kind, *r[3:6])]) for r in rows if r[0] == kind]
        yes, no = 1.0 + sum(n * w for _, n, w in own), 1.0 + sum(n * (1 - w) for _, n, w in own)
        table: dict = {}
        for f, n, w in own:
            for j, v in enumerate(f):
                cell = table.setdefault((j, v), [0.5, 0.5])
                cell[0] += n * w
                cell[1] += n * (1 - w)
        for f, _, _ in own:
            logit = math.log(yes / no) + sum(math.log(table[j, v][0] / yes) - math.log(table[j, v][1] / no) for j, v in enumerate(f))
            scores[(kind, *f)] = 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))
    return scores


def find_spans(docs: DataFrame, accept: float = 0.5, tmp: Scratch | None = None) -> DataFrame:
    """Per document: row, doc_id, key (hash of the text), base and spans.

    ``base`` and ``spans`` are arrays of (kind, start, end), by kind in the order of
    ``KINDS``, then start; positions count code points, the end is exclusive.
    """
    spark = docs.sparkSession
    tmp = tmp or Scratch(spark, "pii")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = tmp.save(rows.select("row", "doc_id", F.xxhash64("text").alias("key"), *(_found(F.col("text"), k).alias(k) for k in KINDS)), "found")
    each = tmp.save(_votes(_candidates(rows)), "candidates")
    seen = each.groupBy("kind", *FEATURES).count().collect()  # 8 kinds x 5 x 3 x 27 rows at most
    counts: dict = {}
    for r in seen:
        p = (r["kind"], r["v1"], r["v2"], r["v3"])
        counts[p] = counts.get(p, 0) + r["count"]
    posterior, _ = expectation_maximisation(counts)
    scores = train_classifier([tuple(r) for r in seen], posterior)
    passed = [k for k, s in scores.items() if s >= accept]
    extra = F.lit(False)
    if passed:
        values = ", ".join("('{}', {})".format(k[0], ", ".join(map(str, k[1:]))) for k in passed)
        good = spark.sql(f"SELECT *, true AS good FROM VALUES {values} AS t(kind, {', '.join(FEATURES)})")
        each = each.join(F.broadcast(good), ["kind", *FEATURES], "left")  # no longer than the collected table
        extra = F.coalesce(F.col("good"), F.lit(False))
    is_base = F.col("kind").isin(*BASE)
    each = each.withColumn("is_base", is_base).where(F.when(is_base, F.col("strict")).otherwise(extra & F.col("strict")))
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy("start", "end").rowsBetween(1, Window.unboundedFollowing)
    last = F.max(F.when(F.col("is_base"), F.col("end"))).over(before)
    following = F.min(F.when(F.col("is_base"), F.col("start"))).over(after)
    each = each.withColumns({"last": last, "following": following})
    apart = (F.coalesce("last", F.lit(0)) <= F.col("start")) & (F.coalesce("following", F.col("end")) >= F.col("end"))
    each = each.where(F.col("is_base") | apart)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(order.alias("o"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("kind"))
    lists = each.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("all"))
    plain = lambda a: F.transform(a, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("start"), x["e"].alias("end")))
    lists = lists.select("row", plain(F.col("all")).alias("spans"), plain(F.filter("all", lambda x: x["o"] <= len(BASE))).alias("base"))
    lists = tmp.save(lists, "lists")
    none = F.array().cast(T.ArrayType(lists.schema["spans"].dataType.elementType))
    return rows.select("row", "doc_id", "key").join(lists, "row", "left").select("row", "doc_id", "key", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


_CHUNK = 2048


def _cut(chunks: Column, begin: Column, end: Column) -> Column:
    """Characters [begin, end) of a text held as chunks of ``_CHUNK``: only those touched are read."""
    first, last = F.floor(begin / _CHUNK).cast("int"), F.floor((end - 1) / _CHUNK).cast("int")

    def part(k: Column) -> Column:
        low = F.greatest(begin - k * _CHUNK, F.lit(0)).cast("int")
        high = F.least(end - k * _CHUNK, F.lit(_CHUNK)).cast("int")
        return F.substring(F.get(chunks, k), low + 1, high - low)

    return F.when(begin >= end, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(first, last), part), ""))


def redact(docs: DataFrame, accept: float = 0.5) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets (column order kept).

    Overlapping spans are replaced together, under the first one's kind.  Rows without
    spans pass through; null text stays null.  The work grows with the text and the number
    of spans, not with their product.
    """
    tmp = Scratch(docs.sparkSession, "redact")
    found = find_spans(docs, accept, tmp).where(F.size("spans") > 0).select("doc_id", "key", "spans").dropDuplicates(["doc_id", "key"])
    each = found.select("doc_id", "key", F.explode("spans").alias("s")).select("doc_id", "key", "s.start", "s.end", "s.kind")
    before = Window.partitionBy("doc_id", "key").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0)))
    lists = each.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("of")).agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "from"))).alias("spans"), F.max("end").alias("end"))
    lists = tmp.save(lists, "spans")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"), whole)
    # the same join at every size: texts with spans are as many as the documents that have any
    both = rows.join(lists.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("of")), "left")

    def rebuilt(chunks: Column) -> Column:
        mask = lambda x: F.concat(_cut(chunks, x["from"], x["start"]), F.lit("<"), x["kind"], F.lit(">"))
        pieces = F.transform("spans", lambda x: F.when(x["start"] >= x["from"], mask(x)).otherwise(""))
        return F.concat(F.array_join(pieces, ""), _cut(chunks, F.col("end"), F.char_length("text")))

    chunks = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(let(chunks, rebuilt))
    return both.select(*(clean.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
