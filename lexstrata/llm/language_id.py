"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to ``max_n`` characters (after folding A-Z), hashed to
``buckets`` columns, per label: every task adds its own dense count matrix up first, so
what is shuffled is (label, bucket) sums.  The log-probability matrix (labels x buckets;
its size is checked) is broadcast, and documents are scored as sparse count rows in
numpy: gather the matrix rows of a document's n-grams, sum them per document.

N-grams of one text overlap and repeat, so the sum of their log-probabilities is far too
sure of itself.  The score is the posterior that ``EVIDENCE`` of the text's n-grams would
give on average (all of them, if it has fewer), where text of no known language, with all
buckets alike, is one more choice of prior ``UNKNOWN``: near 1 for plain text of a known
language, low for mixed texts and for noise.  The predicted label is that of the full sum.

Defined cases: text that is null or has no letter gives ``und`` with score 0; null
labels are not learned from; with nothing to learn from every document is ``und``; a tie
goes to the label first in order; null doc_id is kept; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .scratch import bounded_batches

UND = "und"
#: Bytes that the broadcast matrix may have.
MAX_MODEL_BYTES = 256 << 20
#: Independent n-grams that a text counts for at most in its score.
EVIDENCE = 30
UNKNOWN = 0.01
_STEP = 1 << 19


def _codes(data: np.ndarray, offsets: np.ndarray):
    """Code points of a piece (A-Z folded), and the first of each row."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    upper = (codes >= 0x41) & (codes <= 0x5A)
    return np.where(upper, codes + 32, codes).astype(np.uint64), leads[offsets]


def _buckets(codes: np.ndarray, first: np.ndarray, n: int, buckets: int):
    """Bucket of the n-gram at each position, and the row bounds; n-grams stay in their row."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(len(first), np.int64)
    h = np.full(size, n, np.uint64)
    for j in range(n):
        h = (h ^ codes[j : j + size]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    at = (h & np.uint64(buckets - 1)).astype(np.int64)  # a power of two
    ok = np.ones(size, bool)
    for b in first[1:-1]:
        ok[max(0, b - n + 1) : b] = False
    kept = np.zeros(size + 1, np.int64)
    np.cumsum(ok, out=kept[1:])
    return at[ok], kept[np.minimum(first, size)]


def _counts(max_n: int, buckets: int):
    """(label, text) -> (label, bucket, n), summed over the task."""

    def run(batches):
        total: dict = {}
        for batch in batches:
            for begin, end, data, offsets in K.pieces(batch.column(1)):
                labels = batch.column(0).slice(begin, end - begin).to_pylist()
                codes, first = _codes(data, offsets)
                for n in range(1, max_n + 1):
                    at, bounds = _buckets(codes, first, n, buckets)
                    for label in set(labels):
                        rows = [r for r, x in enumerate(labels) if x == label]
                        own = np.concatenate([at[bounds[r] : bounds[r + 1]] for r in rows])
                        have = total.setdefault(label, np.zeros(buckets, np.int64))
                        have += np.bincount(own, minlength=buckets)
        for label, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["label", "bucket", "n"])

    return run


class Model:
    """labels (sorted) and a float32 matrix: buckets x labels log-probabilities; log priors."""

    def __init__(self, labels: list[str], logp: np.ndarray, prior: np.ndarray):
        self.labels, self.logp, self.prior = labels, logp, prior

    def score(self, data: np.ndarray, offsets: np.ndarray, max_n: int, buckets: int) -> np.ndarray:
        """Log-likelihood of each row and label, and the number of n-grams of each row."""
        codes, first = _codes(data, offsets)
        out, size = np.zeros((len(offsets) - 1, len(self.labels))), np.zeros(len(offsets) - 1, np.int64)
        for n in range(1, max_n + 1):
            at, bounds = _buckets(codes, first, n, buckets)
            size += np.diff(bounds)
            for lo in range(0, len(at), _STEP):
                hi = min(len(at), lo + _STEP)
                cut = np.clip(bounds, lo, hi) - lo
                for k in range(len(self.labels)):
                    out[:, k] += K.row_sums(self.logp[k][at[lo:hi]].astype(np.float64), cut)
        return out, size


def train(labelled: DataFrame, max_n: int = 3, buckets: int = 1 << 15, alpha: float = 0.5) -> Model:
    """Fit on every row of (label, text); rows without a label or text are left out."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col("label").cast("string").alias("label"), F.col("text").cast("string").alias("text")).where("label is not null and text is not null")
    sums = rows.mapInArrow(_counts(max_n, buckets), "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    priors = {r[0]: r[1] for r in rows.groupBy("label").count().limit(1 + MAX_MODEL_BYTES // (4 * buckets)).collect()}
    labels = sorted(priors)
    if len(labels) * buckets * 4 > MAX_MODEL_BYTES:
        raise ValueError(f"{len(labels)} labels or more do not fit {MAX_MODEL_BYTES} bytes: train with fewer buckets (and predict with as many)")
    counts = np.zeros((len(labels), buckets))
    table = sums.toArrow()  # labels x buckets rows at most, checked above
    index = {x: k for k, x in enumerate(labels)}
    where = np.array([index[x] for x in table.column("label").to_pylist()], np.int64)
    np.add.at(counts, (where, table.column("bucket").to_numpy()), table.column("n").to_numpy())
    logp = np.log((counts + alpha) / (counts.sum(1, keepdims=True) + alpha * buckets)) if labels else counts
    n = np.array([priors[x] for x in labels], float)
    return Model(labels, logp.astype(np.float32), np.log(n / n.sum()) if labels else n)


def _predict(shared, max_n: int, buckets: int):
    """(row, text, letters) -> (row, lang_pred, score); row goes through as it is."""

    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            for begin, end, data, offsets in K.pieces(batch.column(1)):
                row = batch.column(0).slice(begin, end - begin)
                letters = batch.column(2).slice(begin, end - begin).to_numpy(zero_copy_only=False).astype(bool)
                if model.labels:
                    likely, size = model.score(data, offsets, max_n, buckets)
                    best = (model.prior + likely).argmax(1)
                    counted = np.minimum(size, EVIDENCE)
                    mild = model.prior + likely * (counted / np.maximum(size, 1))[:, None]
                    unknown = math.log(UNKNOWN) - counted * math.log(buckets)
                    other = np.concatenate([mild, unknown[:, None]], 1) - mild[np.arange(len(best)), best][:, None]
                    score = 1 / np.exp(np.minimum(other, 700.0)).sum(1)
                    names = np.array([*model.labels, UND], object)[np.where(letters, best, len(model.labels))]
                    score = np.where(letters, score, 0.0)
                else:
                    names, score = np.array([UND] * len(row), object), np.zeros(len(row))
                yield pa.RecordBatch.from_arrays([row, pa.array(names, pa.string()), pa.array(score)], names=["row", "lang_pred", "score"])

    return run


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def annotate(docs: DataFrame, model: Model, row: Column, max_n: int = 3, buckets: int = 1 << 15) -> DataFrame:
    """Per document: row (any column of ``docs``, such as a struct of all), lang_pred, score."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, model.logp, model.prior))
    text = F.col("text").cast("string")
    rows = docs.select(row.alias("row"), text.alias("text"), has_letter(text).alias("letters"))
    kind = rows.schema["row"].dataType
    schema = T.StructType([T.StructField("row", kind), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_predict(shared, max_n, buckets), schema)


def predict(docs: DataFrame, model: Model, max_n: int = 3, buckets: int = 1 << 15) -> DataFrame:
    """Per document: doc_id, lang_pred, score (posterior of lang_pred on ``EVIDENCE`` n-grams)."""
    return annotate(docs, model, F.col("doc_id").cast("long"), max_n, buckets).withColumnRenamed("row", "doc_id")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


K.ship(__name__)
