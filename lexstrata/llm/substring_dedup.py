"""Substring dedup by level-wise doubling.

Level 1 looks at windows of a quarter of the target length.  Of those it keeps the ones
that are the minimum of some target-length window's run, so every target window holds
one and equal windows hold equal ones; those found in one text only are dropped.  Level
2 doubles the survivors to the left and to the right (a target window contains one of
the two).  The last level takes whole target windows, only where a survivor of level 2
lies inside, and compares them by two independent 64-bit hashes.  Longer repeats are
unions of target windows, so no candidate is left after that.

Exact copies are one class with the smallest doc_id as its representative: every window
of another member starts in the representative, so all its words go, and only
representatives enter the last level.  No level ever gathers the members of a window:
minima are pre-aggregated, and survivors come back by joins between two plain scans,
which adaptive execution splits where a window is hot.

Defined cases: null or empty text has no words; a document without doc_id has no place
in the order, so it neither loses words nor makes others lose them; repeated rows of
one doc_id don't count against each other; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .scratch import Scratch

_SEEDS = (21, 22)


def _levels(window: int) -> tuple[int, int]:
    """Lengths of levels 1 and 2 (level 3 is the window itself)."""
    return max(1, window // 4), max(1, window // 2)


def _two_hashes(w: K.Words) -> tuple[K.Windows, K.Windows]:
    return tuple(K.Windows(w.hashes(s)) for s in _SEEDS)


def _summaries():
    """Documents -> class (two hashes of all words), word count, digest of the words."""

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(1)):
                w = K.Words(data, offsets)
                c1, c2 = (K.row_hashes(w.hashes(s), w.first) for s in _SEEDS)
                text = data.tobytes()
                sha = [hashlib.sha256(b" ".join(text[a:b].split())).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), batch.column(2).slice(first, last - first), K.signed(c1), K.signed(c2), pa.array(w.count.astype(np.int64)), pa.array(sha, pa.string())], names=["doc_id", "key", "c1", "c2", "n_words", "sha"])

    return run


def _anchors(window: int):
    """Documents -> level 1 windows with their doublings (null where they leave the document)."""
    short, double = _levels(window)
    back = double - short

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in K.pieces(batch.column(1)):
                w = K.Words(data, offsets)
                if w.n < window:
                    continue
                word = w.hashes(_SEEDS[0])
                h = K.Windows(word)
                i, last = np.arange(w.n), w.last_of()
                begin = np.repeat(w.first[:-1], w.count)
                grams = np.where(i + short <= last, h.at(np.minimum(i, w.n - short), short), K._MAX)
                at = K.winnow(grams, i + window <= last, window - short + 1)
                right_ok, left_ok = at + double <= last[at], at - back >= begin[at]
                right = h.at(np.where(right_ok, at, 0), double).view(np.int64)
                left = h.at(np.where(left_ok, at - back, 0), double).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [K.signed(K.row_hashes(word, w.first)[w.row_of()[at]]), K.signed(grams[at]), pa.array((at - begin[at]).astype(np.int32)), pa.array(left, mask=~left_ok), pa.array(right, mask=~right_ok)],
                    names=["c1", "h", "at", "left", "right"],
                )

    return run


def _targets(window: int):
    """(doc_id, text, first starts, last starts, c1) -> target windows starting in those ranges."""

    def run(batches):
        for batch in batches:
            ranges = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            for first, last, data, offsets in K.pieces(batch.column(1)):
                w = K.Words(data, offsets)
                if w.n < window:
                    continue
                mark = np.zeros(w.n + 1, np.int32)
                for r in range(last - first):
                    lo, hi = (np.asarray(x, np.int64) for x in ranges[first + r])
                    top = w.first[r + 1] - window
                    lo, hi = np.maximum(lo + w.first[r], w.first[r]), np.minimum(hi + w.first[r], top) + 1
                    ok = lo < hi
                    np.add.at(mark, lo[ok], 1)
                    np.add.at(mark, hi[ok], -1)
                at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                h1, h2 = _two_hashes(w)
                row = w.row_of()[at]
                ids = [batch.column(c).slice(first, last - first).take(pa.array(row)) for c in (0, 4)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array((at - w.first[row]).astype(np.int32)), K.signed(h1.at(at, window)), K.signed(h2.at(at, window))], names=["doc_id", "c1", "at", "h1", "h2"])

    return run


def _strip(window: int):
    """(c1, c2, text, starts of repeated windows) -> kept text and counts."""

    def run(batches):
        for batch in batches:
            starts = [x.as_py() for x in batch.column(3)]
            for first, last, data, offsets in K.pieces(batch.column(2)):
                text = data.tobytes()
                kept, removed = [], []
                for r in range(last - first):
                    words = text[offsets[r] : offsets[r + 1]].split()
                    mark = np.zeros(len(words) + 1, np.int32)
                    at = np.asarray(starts[first + r], np.int64)
                    np.add.at(mark, at, 1)
                    np.add.at(mark, at + window, -1)
                    go = np.cumsum(mark[:-1]) > 0
                    kept.append(b" ".join([x for x, g in zip(words, go.tolist(), strict=True) if not g]))
                    removed.append(int(go.sum()))
                cols = [batch.column(i).slice(first, last - first) for i in (0, 1)]
                sha = [hashlib.sha256(k).hexdigest() for k in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(removed, pa.int64()), pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()), pa.array(sha)], names=["c1", "c2", "n_removed", "kept_text", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, kept_text (null: all words kept)."""
    tmp = Scratch(docs.sparkSession, "substrings")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", F.xxhash64("text"))  # tells apart rows that share a doc_id
    short, double = _levels(window)
    every = tmp.save(docs.mapInArrow(_summaries(), "doc_id long, key long, c1 long, c2 long, n_words long, sha string"), "summaries")
    leaders = tmp.save(every.groupBy("c1", "c2").agg(F.min("doc_id").alias("leader"), F.first("n_words").alias("n_words")), "leaders")

    # level 1, then both doublings; a level's survivors occur in two different texts at least
    rows = tmp.save(docs.mapInArrow(_anchors(window), "c1 long, h long, at int, left long, right long"), "level1")
    again = lambda df, key: df.groupBy(key).agg(F.min("c1").alias("a"), F.max("c1").alias("b")).where("a != b").select(key)
    level1 = tmp.save(again(rows, "h"), "level1-repeated")
    sides = F.array(
        F.struct(F.col("right").alias("d"), (F.col("at") - (window - double)).alias("lo"), F.col("at").alias("hi")),
        F.struct(F.col("left").alias("d"), (F.col("at") - (window - short)).alias("lo"), (F.col("at") - (double - short)).alias("hi")),
    )
    doubled = tmp.save(rows.join(level1, "h").select("c1", F.explode(sides).alias("s")).select("c1", "s.*").where("d is not null").distinct(), "level2")
    tmp.drop("level1", "level1-repeated")
    level2 = tmp.save(again(doubled, "d"), "level2-repeated")
    ranges = doubled.join(level2, "d").groupBy("c1").agg(F.collect_set(F.struct("lo", "hi")).alias("r"))
    ranges = tmp.save(ranges.select("c1", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi")), "ranges")
    tmp.drop("level2", "level2-repeated")

    # whole windows of the representatives
    chosen = leaders.where("leader is not null").join(ranges, "c1").select(F.col("leader").alias("doc_id"), "c1", "c2", "lo", "hi")
    chosen = every.join(chosen, ["doc_id", "c1", "c2"]).select("doc_id", "key", "c1", "c2", "lo", "hi").distinct()
    texts = tmp.save(docs.join(chosen, ["doc_id", "key"]).select("doc_id", "text", "lo", "hi", "c1", "c2"), "texts")
    found = tmp.save(texts.mapInArrow(_targets(window), "doc_id long, c1 long, at int, h1 long, h2 long"), "windows")
    first = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("b")).where("owner != b").select("h1", "h2", "owner")
    first = tmp.save(first, "owners")
    starts = found.join(first, ["h1", "h2"]).where("doc_id > owner").groupBy("doc_id", "c1").agg(F.array_sort(F.collect_set("at")).alias("starts"))
    starts = tmp.save(starts, "starts")
    tmp.drop("windows", "owners", "ranges")
    cut = texts.join(starts, ["doc_id", "c1"]).select("c1", "c2", "text", "starts")
    cut = cut.mapInArrow(_strip(window), "c1 long, c2 long, n_removed long, kept_text string, kept_sha256 string").dropDuplicates(["c1", "c2"])
    verdicts = tmp.save(leaders.join(cut, ["c1", "c2"], "left").withColumnRenamed("n_words", "words"), "verdicts")

    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    copy = (F.col("doc_id") > F.col("leader")) & (F.col("n_words") >= window)
    own = (F.col("doc_id") == F.col("leader")) & F.col("n_removed").isNotNull()
    return every.join(verdicts, ["c1", "c2"]).select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).when(own, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, nothing).when(own, F.col("kept_sha256")).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).when(own, F.col("kept_text")).alias("kept_text"),
    )


K.ship(__name__)
