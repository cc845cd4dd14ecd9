"""Benchmark decontamination by winnowing.

Both sides keep the minimum k-gram hash of every run of ``window - k + 1`` k-grams, so
each span of ``window`` words contains at least one kept fingerprint, and the same span
keeps the same fingerprint wherever it occurs.  Documents that share a fingerprint with
an item are extended: each of their windows is compared with the item windows by two
independent 64-bit hashes.  Items shorter than the window are one window of their own
length, with every one of their words' prefix k-grams (k capped by length) as
fingerprint.

Small benchmark (its window count is counted first, and below ``broadcast_windows``):
fingerprints and windows go to the tasks, and the plan over documents is narrow.
Beyond it both sides' fingerprints are shuffled and joined, and the windows that a
document may hold are brought to it by joins; the results are the same.

Defined cases: null text and null items have no words; null doc_id is kept; repeated
documents are judged each on their own; repeated items count once per item_id; items
without item_id count in n_hit but are not listed in item_ids; with an empty benchmark
nothing is hit; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .scratch import Scratch

_SEEDS = (11, 12)


def _words(data, offsets):
    return K.Words(data, offsets, K.ALNUM, lower=True)


def _item_windows(window: int, gram: int):
    """Item rows -> (length, h1, h2, fp, item_id); fp is the window's winnowed fingerprint."""

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(1)):
                w = _words(data, offsets)
                if not w.n:
                    continue
                size = np.minimum(w.count, window)
                length = np.repeat(size, w.count)
                i = np.arange(w.n)
                ok = (i + length <= w.last_of()) & ((length == window) | (i == np.repeat(w.first[:-1], w.count)))
                i, length = i[ok], length[ok]
                hashes = [K.Windows(w.hashes(s)) for s in _SEEDS]
                fp = np.full(len(i), K._MAX)
                for j in range(window - gram + 1):
                    can = (j + gram <= length) & (i + j + gram <= w.n)
                    at = np.where(can, i + j, 0)
                    if w.n >= gram:
                        fp = np.where(can, np.minimum(fp, hashes[0].at(at, gram)), fp)
                short = length < gram
                fp = np.where(short, hashes[0].at(i, length), fp)
                ids = batch.column(0).slice(first, last - first).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(length.astype(np.int32)), K.signed(hashes[0].at(i, length)), K.signed(hashes[1].at(i, length)), K.signed(fp), pa.array(np.asarray(ids, object)[w.row_of()[ok]], pa.string())], names=["length", "h1", "h2", "fp", "item_id"])

    return run


def _fingerprints(w: K.Words, hashes: K.Windows, window: int, gram: int, lengths) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a piece's own fingerprints, for all window lengths that items have."""
    i, last = np.arange(w.n), w.last_of()
    where, what = [], []
    for length in lengths:
        if length < gram:  # such a window is its own fingerprint
            at = i[i + length <= last]
            where.append(at)
            what.append(hashes.at(at, length))
            continue
        grams = np.where(i + gram <= last, hashes.at(np.minimum(i, max(0, w.n - gram)), min(gram, w.n)), K._MAX)
        at = K.winnow(grams, i + length <= last, length - gram + 1)
        where.append(at)
        what.append(grams[at])
    if not where:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(where), np.concatenate(what)


def _occurrences(w: K.Words, table: dict, rows: np.ndarray):
    """Boolean per word (inside an occurrence) and (row, index into h1) of each occurrence.

    ``rows``: mask of rows worth looking at.  table: length -> (sorted h1, h2 in that order).
    """
    delta = np.zeros(w.n + 1, np.int32)
    found_row, found = [], []
    h1, h2 = (K.Windows(w.hashes(s)) for s in _SEEDS)
    last, row_of = w.last_of(), w.row_of()
    base = np.flatnonzero(rows[row_of])
    for length, (a, b, start) in table.items():
        at = base[base + length <= last[base]]
        got = h1.at(at, length)
        k = np.searchsorted(a, got)
        same = np.flatnonzero((k < len(a)) & (a[np.minimum(k, len(a) - 1)] == got))
        at, k, got = at[same], k[same], h2.at(at[same], length)
        hit = b[k] == got
        step = 1
        while len(a) > step and (a[step:] == a[:-step]).any():  # equal h1 of different windows
            nxt = np.minimum(k + step, len(a) - 1)
            other = (a[nxt] == a[k]) & (b[nxt] == got)
            k, hit = np.where(other, nxt, k), hit | other
            step += 1
        at, k = at[hit], k[hit]
        np.add.at(delta, at, 1)
        np.add.at(delta, at + length, -1)
        found_row.append(row_of[at])
        found.append(k + start)
    covered = np.cumsum(delta[:-1]) > 0
    if not found:
        return covered, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return covered, np.concatenate(found_row), np.concatenate(found)


def _table(length: np.ndarray, h1: np.ndarray, h2: np.ndarray):
    """Windows by length, each sorted by h1; and their number's order in the given arrays."""
    table, order, start = {}, [], 0
    for n in sorted(set(length.tolist())):
        own = np.flatnonzero(length == n)
        own = own[np.lexsort((h2[own], h1[own]))]
        table[int(n)] = (h1[own], h2[own], start)
        order.append(own)
        start += len(own)
    return table, np.concatenate(order) if order else np.zeros(0, np.int64)


_OUT = "doc_id long, n_words long, n_hit long, h1 array<long>, h2 array<long>"


def _result(ids, w, covered, row, hits, h1, h2):
    """A row per document with the distinct windows found in it."""
    n_hit = K.row_sums(covered.astype(np.int64), w.first)
    pairs = np.unique(np.stack([row, hits]), axis=1) if len(row) else np.zeros((2, 0), np.int64)
    at = np.searchsorted(pairs[0], np.arange(w.rows + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(at), K.signed(h[pairs[1]])) for h in (h1, h2)]
    return pa.RecordBatch.from_arrays([ids, pa.array(w.count.astype(np.int64)), pa.array(n_hit), *lists], names=["doc_id", "n_words", "n_hit", "h1", "h2"])


def _scan(shared, window: int, gram: int):
    """Documents -> results, with the whole benchmark at hand."""

    def run(batches):
        length, h1, h2, fp = shared.value
        table, order = _table(length, h1, h2)
        s1, s2, fps = h1[order], h2[order], np.unique(fp)
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(1)):
                w = _words(data, offsets)
                ids = batch.column(0).slice(first, last - first)
                rows = np.zeros(w.rows, bool)
                if w.n and len(fps):
                    at, got = _fingerprints(w, K.Windows(w.hashes(_SEEDS[0])), window, gram, table)
                    k = np.minimum(np.searchsorted(fps, got), len(fps) - 1)
                    rows[w.row_of()[at[fps[k] == got]]] = True
                covered, row, hits = _occurrences(w, table, rows) if rows.any() else (np.zeros(w.n, bool), np.zeros(0, np.int64), np.zeros(0, np.int64))
                yield _result(ids, w, covered, row, hits, s1, s2)

    return run


def _emit(window: int, gram: int, lengths):
    """Documents -> (key, fp), each fingerprint once per document."""

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(1)):
                w = _words(data, offsets)
                if not w.n:
                    continue
                at, got = _fingerprints(w, K.Windows(w.hashes(_SEEDS[0])), window, gram, lengths)
                pairs = np.unique(np.stack([w.row_of()[at].astype(np.uint64), got]), axis=1)
                keys = batch.column(0).slice(first, last - first).take(pa.array(pairs[0].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([keys, K.signed(pairs[1])], names=["key", "fp"])

    return run


def _extend():
    """(doc_id, text, windows that it may hold) -> results."""

    def run(batches):
        for batch in batches:
            cols = [batch.column(i) for i in range(3)]
            for first, last, data, offsets in K.pieces(cols[1]):
                for r in range(last - first):
                    piece = data[offsets[r] : offsets[r + 1]]
                    w = _words(piece, np.array([0, len(piece)]))
                    maybe = cols[2][first + r].as_py() or []
                    length = np.array([x["length"] for x in maybe], np.int64)
                    h1, h2 = (np.array([x[c] for x in maybe], np.int64).view(np.uint64) for c in ("h1", "h2"))
                    table, order = _table(length, h1, h2)
                    covered, row, hits = _occurrences(w, table, np.ones(1, bool))
                    yield _result(cols[0].slice(first + r, 1), w, covered, row, hits, h1[order], h2[order])

    return run


def _benchmark(spark: SparkSession, tmp: Scratch, items: DataFrame, window: int, gram: int, broadcast_windows: int):
    """Item windows with their items, the windows alone, and these as a broadcast if they are few enough."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    owned = tmp.save(items.mapInArrow(_item_windows(window, gram), "length int, h1 long, h2 long, fp long, item_id string").distinct(), "windows")
    windows = owned.select("length", "h1", "h2", "fp").distinct()
    if windows.limit(broadcast_windows + 1).count() > broadcast_windows:
        return owned, windows, None
    table = windows.toArrow()  # bounded by the count just made
    return owned, windows, spark.sparkContext.broadcast((table.column("length").to_numpy(), *(K.unsigned(table.column(c)) for c in ("h1", "h2", "fp"))))


def _by_joins(tmp: Scratch, keyed: DataFrame, name: str, windows: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows (key, text, ``name``) -> results under ``name``; rows of one key have one text."""
    lengths = [r[0] for r in windows.select("length").distinct().collect()]  # at most ``window`` values
    marks = keyed.select("key", "text").mapInArrow(_emit(window, gram, sorted(lengths)), "key string, fp long")
    maybe = marks.join(windows, "fp").select("key", F.struct("length", "h1", "h2").alias("w")).groupBy("key").agg(F.collect_set("w").alias("maybe"))
    maybe = tmp.save(maybe, "maybe")
    rows = keyed.join(maybe, "key", "left").select(F.col(name).alias("doc_id"), "text", "maybe")
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *T._parse_datatype_string(_OUT).fields[1:]])
    return rows.mapInArrow(_extend(), schema).withColumnRenamed("doc_id", name)


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 5, broadcast_windows: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows that hold an item window.

    Each row is judged by its own text, whatever its doc_id.  With a small benchmark rows
    are judged where they are and nothing is shuffled.
    """
    spark: SparkSession = docs.sparkSession
    tmp = Scratch(spark, "clean")
    _, windows, shared = _benchmark(spark, tmp, items, window, gram, broadcast_windows)
    if shared is None:
        # whether a row holds a window follows from its text alone, so rows are told apart by a digest of it
        digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
        keyed = docs.select(digest.alias("key"), F.col("text").cast("string").alias("text"))
        found = _by_joins(tmp, keyed, "key", windows, window, gram)
        hit = tmp.save(found.where("n_hit > 0").select("key").distinct(), "hit")
        whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
        return docs.select(digest.alias("key"), whole).join(hit, "key", "left_anti").select("row.*")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *T._parse_datatype_string(_OUT).fields[1:]])
    return rows.mapInArrow(_scan(shared, window, gram), schema).where("n_hit = 0").select("doc_id.*")


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 5, broadcast_windows: int = 1_000_000) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, item_ids (array of string, sorted).

    ``broadcast_windows``: item windows (28 bytes each) up to which they are broadcast.
    """
    spark: SparkSession = docs.sparkSession
    tmp = Scratch(spark, "winnow")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    owned, windows, shared = _benchmark(spark, tmp, items, window, gram, broadcast_windows)
    if shared is not None:
        found = docs.mapInArrow(_scan(shared, window, gram), _OUT)
    else:
        # rows with one id need not be the same document: a digest of the text keeps them apart
        keyed = docs.withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))
        found = _by_joins(tmp, keyed, "doc_id", windows, window, gram)
    found = found.withColumn("row", F.monotonically_increasing_id())
    found = tmp.save(found, "found")
    pairs = found.where("n_hit > 0").select("row", F.explode(F.arrays_zip("h1", "h2")).alias("w")).select("row", "w.h1", "w.h2")
    owners = pairs.join(owned.select("h1", "h2", "item_id"), ["h1", "h2"]).groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return found.join(owners, "row", "left").select("doc_id", "n_words", "n_hit", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


K.ship(__name__)
