"""Stupid-backoff scores from n-gram counts over all documents.

Documents are dealt to blocks of about ``block_bytes`` by hash.  A block's n-grams (orders
1 to ``order``) are added up and sorted by hash; each of many equal hash ranges (buckets)
gets the block's hashes and counts there as one row of two blobs.  A bucket adds them up
over blocks and gives each block, in the block's own order, how often its n-grams occur
elsewhere: one blob a block again, without hashes.  The block sorts its n-grams once more,
lays those counts beside them and sums logarithms per document.  An n-gram is one entry
per block, however frequent, and buckets hold equal shares of all hashes.  Buckets are
filled in ``rounds`` groups, and blocks scored in as many, one after the other: of the
hashes only one group's are on disk at a time.

A document's own occurrences are taken off all counts (else every n-gram would have been
seen): S(w | context) = c(context w) / c(context) where that is seen, else
``discount`` * S(w | shorter context); a word never seen elsewhere scores 1 / (N + 1).

Defined cases: null, empty and blank texts have no words, log_score 0 and a null mean; a
table of one document scores every word 1 / (0 + 1); null doc_id is kept; repeated rows
count as other documents; further columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .scratch import Scratch

_TOTAL = 0  # the hash under which a block reports its number of words
#: Buckets of a round: so many at least, and one for so much text.
_BUCKETS, _BUCKET_BYTES = 512, 16 << 20


class Grams:
    """All n-grams of a block: per order, the hash of the n-gram that ends at each word."""

    def __init__(self, text, order: int):
        words, counts = [], []
        for _, _, data, offsets in K.pieces(text):
            w = K.Words(data, offsets)
            words.append(w.hashes(41))
            counts.append(w.count)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.n = len(self.words)
        place = np.arange(self.n) - np.repeat(self.first[:-1], self.count)
        h = K.Windows(self.words)
        self.hash, self.ok = {}, {}
        for k in range(1, order + 1):
            self.ok[k] = place >= k - 1
            at = np.where(self.ok[k], np.arange(self.n) - (k - 1), 0)
            self.hash[k] = h.at(at, min(k, self.n)) if self.n else self.words

    def all(self) -> np.ndarray:
        """The n-grams of all orders, order by order."""
        return np.concatenate([self.hash[k][self.ok[k]] for k in self.hash])


def _edges(buckets: int) -> np.ndarray:
    """The least hash of each bucket."""
    return np.array([-(-(b << 32) // buckets) << 32 for b in range(buckets)], np.uint64)


def _packed(x: np.ndarray) -> bytes:
    """64-bit numbers as planes of bytes: all first bytes, all second ones, and so on, which compress well."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(blobs: list[bytes], kind=np.int64) -> list[np.ndarray]:
    return [np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(kind).reshape(-1) for b in blobs]


def _count_block(order: int, buckets: int, lo: int, hi: int):
    """A block's documents -> its hashes and counts in each of the buckets [lo, hi)."""

    def run(table: pa.Table) -> pa.Table:
        g, edges = Grams(table.column("text"), order), _edges(buckets)
        own = g.all()
        own = own[own >= edges[lo]]
        own = own[own < edges[hi]] if hi < buckets else own
        h, n = np.unique(own, return_counts=True)
        n = n.astype(np.int64)
        if not lo:
            h, n = np.concatenate([np.full(1, _TOTAL, np.uint64), h]), np.concatenate([np.full(1, g.n, np.int64), n])
        cut = np.append(np.searchsorted(h, edges[lo:hi]), len(h))
        full = np.flatnonzero(np.diff(cut))
        parts = [slice(a, b) for a, b in zip(cut[full].tolist(), cut[full + 1].tolist(), strict=True)]
        block = np.full(len(full), table.column("block")[0].as_py(), np.int32)
        blobs = (pa.array([_packed(x[part]) for part in parts], pa.binary()) for x in (h, n))
        return pa.table([pa.array((full + lo).astype(np.int32)), pa.array(block), *blobs], names=["bucket", "block", "h", "n"])

    return run


def _add_bucket(table: pa.Table) -> pa.Table:
    """The rows of a bucket -> for each block, how often its n-grams there occur in other blocks."""
    h, n = (_unpacked(table.column(c).to_pylist(), kind) for c, kind in (("h", np.uint64), ("n", np.int64)))
    cut = np.cumsum([0, *map(len, h)]).tolist()
    h, n = np.concatenate(h), np.concatenate(n)
    by = np.argsort(h, kind="stable")
    h = h[by]
    new = np.append(True, h[1:] != h[:-1])
    rest = np.empty_like(n)
    rest[by] = np.add.reduceat(n[by], np.flatnonzero(new))[np.cumsum(new) - 1]
    rest -= n
    blobs = [_packed(rest[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table([table.column("block"), table.column("bucket"), pa.array(blobs, pa.binary())], names=["block", "bucket", "elsewhere"])


def _in_other_documents(g: Grams, row: np.ndarray, elsewhere: np.ndarray) -> dict[int, np.ndarray]:
    """Per order, how often the n-gram that ends at each word occurs in other documents.

    ``elsewhere`` lies beside the block's different n-grams, ascending.
    """
    grams, rows = g.all(), np.concatenate([row[g.ok[k]] for k in g.ok])
    by = np.argsort(grams, kind="stable")  # rows ascend within an n-gram
    grams, rows = grams[by], rows[by]
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    if int(new.sum()) != len(elsewhere):
        raise ValueError("counts do not belong to this block")
    other = new.copy()
    other[1:] |= rows[1:] != rows[:-1]
    size = lambda flags: np.diff(np.append(np.flatnonzero(flags), len(flags)))
    in_block = (size(new) + elsewhere)[np.cumsum(new) - 1]
    found = np.empty(len(grams), np.int64)
    found[by] = in_block - np.repeat(size(other), size(other))
    out, done = {}, 0
    for k, ok in g.ok.items():
        n = int(ok.sum())
        out[k] = np.zeros(g.n, np.int64)
        out[k][ok] = found[done : done + n]
        done += n
    return out


def _score_block(order: int, discount: float):
    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        blobs = counts.column("elsewhere").take(pa.array(np.argsort(counts.column("bucket").to_numpy())))
        elsewhere = np.concatenate(_unpacked(blobs.to_pylist()))
        g = Grams(docs.column("text"), order)
        row = np.repeat(np.arange(len(g.count), dtype=np.int32), g.count)
        rest = (g.n + int(elsewhere[0]) - g.count)[row].astype(np.float64)  # words in other documents
        found = _in_other_documents(g, row, elsewhere[1:])
        logp, seen_at = np.zeros(g.n), np.zeros(g.n, np.int8)
        for k in range(1, order + 1):
            others = found[k]
            seen = others > 0
            if k == 1:
                logp = np.where(seen, np.log(np.maximum(others, 1) / np.maximum(rest, 1)), -np.log(rest + 1))
            else:
                context = np.zeros(g.n, np.int64)
                context[1:] = found[k - 1][:-1]
                fresh = np.log(np.maximum(others, 1) / np.maximum(context, 1))
                logp = np.where(seen, fresh, np.where(g.ok[k], logp + math.log(discount), logp))
            seen_at[seen] = k
        sums = np.bincount(row, logp, minlength=len(g.count)).astype(np.float64)
        top = np.bincount(row, seen_at == order, minlength=len(g.count)).astype(np.int64)
        mean = np.where(g.count > 0, sums / np.maximum(g.count, 1), np.nan)
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(g.count.astype(np.int64)), "n_top": pa.array(top), "log_score": pa.array(sums), "mean_log_score": pa.array(mean, from_pandas=True)})

    return run


def score(docs: DataFrame, order: int = 3, discount: float = 0.4, block_bytes: int = 4 << 20, rounds: int = 4) -> DataFrame:
    """Per document: doc_id, n_words, n_top (words whose longest n-gram is known), log_score, mean_log_score."""
    tmp = Scratch(docs.sparkSession, "lm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-size // block_bytes)))).cast("int"))
    each = max(_BUCKETS, -(-size // _BUCKET_BYTES))
    counts, scored = [], []
    for turn in range(rounds):
        run = _count_block(order, rounds * each, turn * each, (turn + 1) * each)
        rows = docs.groupBy("block").applyInArrow(run, "bucket int, block int, h binary, n binary")
        rows = rows.groupBy("bucket").applyInArrow(_add_bucket, "block int, bucket int, elsewhere binary")
        counts.append(tmp.save(rows, f"counts-{turn}"))
    shared = reduce(DataFrame.union, counts)
    for turn in range(rounds):
        group = F.col("block") % rounds == turn
        both = docs.where(group).groupBy("block").cogroup(shared.where(group).groupBy("block"))
        out = both.applyInArrow(_score_block(order, discount), "doc_id long, n_words long, n_top long, log_score double, mean_log_score double")
        scored.append(tmp.save(out, f"scores-{turn}"))
    tmp.drop(*(f"counts-{turn}" for turn in range(rounds)))
    return reduce(DataFrame.union, scored)


K.ship(__name__)
