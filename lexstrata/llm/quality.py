"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document gets its rule counts in one narrow pass.  Failures are aggregated by host
(pre-aggregated before the shuffle, so a hot host is one row per task), host rates are
shrunk by a beta-binomial prior fitted to all hosts, by size, by moments, and hosts whose
shrunk rate reaches ``reject_rate`` reject their documents.  Host verdicts return by a
join of two written tables, whose hot keys adaptive execution can split.

Defined cases: null text has no words (and fails); a null host has no host verdict; with
a single host, or hosts that differ by no more than chance, the prior is strong;
repeated rows are judged and counted each on their own; null doc_id is kept; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Bounds of the prior's weight, in documents.
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1e6


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``use`` as a lambda variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def count_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def count_repeat_words(w: Column, k: int) -> Column:
    """Words inside ``k``-word windows that occur twice or more in the array ``w``."""
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))

    def repeated(x: Column) -> Column:
        ordered = F.array_sort(F.transform(x, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        marked = let(ordered, lambda s: F.transform(s, lambda e, i: F.when((F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]), e["i"])))
        places = F.array_sort(F.filter(marked, lambda i: i.isNotNull()))
        covered = let(places, lambda p: F.transform(p, lambda at, i: F.least(F.coalesce(F.get(p, i + 1) - at, F.lit(k)), F.lit(k))))
        return F.aggregate(covered, F.lit(0).cast("long"), lambda a, n: a + n)

    total = let(windows, lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), repeated(x)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(w) < k, F.lit(0).cast("long")).otherwise(total)


def rule_counts(docs: DataFrame, host: str, repeat_window: int = 5) -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), text.alias("text"))
    length = F.char_length("text")
    rows = rows.select(
        "doc_id",
        "host",
        let(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), count_repeat_words(w, repeat_window).alias("n_repeat_words"))).alias("f"),
        F.char_length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (length - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        count_dup_lines(F.col("text")).alias("n_dup_lines"),
    )
    rows = rows.select("doc_id", "host", "f.n_words", "word_chars", "n_symbols", "n_dup_lines", "f.n_repeat_words")
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) of a beta-binomial, by moments of the hosts (n, failed).

    The spread of failures around n * mean, less what binomial noise alone gives, is the
    correlation r within hosts; the prior weighs 1 / r - 1 documents.  Hosts that don't
    differ beyond that noise have a prior of ``MAX_WEIGHT``.
    """
    n, failed = F.col("n").cast("double"), F.col("failed").cast("double")
    total = hosts.agg(F.sum(n).alias("n"), F.sum(failed).alias("f")).first()
    if not total["n"]:
        return 0.5, 0.5
    mean = min(max(total["f"] / total["n"], 1e-6), 1 - 1e-6)
    row = hosts.agg(F.sum((failed - n * mean) * (failed - n * mean) - n * (mean * (1 - mean))).alias("over"), F.sum(n * (n - 1)).alias("pairs")).first()
    r = row["over"] / (mean * (1 - mean) * row["pairs"]) if row["pairs"] else 0.0
    weight = MAX_WEIGHT if r <= 1 / (MAX_WEIGHT + 1) else max(1 / r - 1, MIN_WEIGHT)
    return mean * weight, (1 - mean) * weight


def judge(docs: DataFrame, host: str = "source", reject_rate: float = 0.5) -> DataFrame:
    """``rule_counts`` with kept (boolean) and host_rate (shrunk failure rate; null without host)."""
    tmp = Scratch(docs.sparkSession, "quality")
    rows = tmp.save(rule_counts(docs, host), "counts")
    hosts = rows.where("host is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    hosts = tmp.save(hosts, "hosts")
    alpha, beta = beta_prior(hosts)
    rates = hosts.select("host", ((F.col("failed") + alpha) / (F.col("n") + (alpha + beta))).alias("host_rate"))
    kept = ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) < reject_rate)
    return rows.join(rates, "host", "left").withColumn("kept", kept)
