"""Packing by power-of-two decomposition.

A document of n ids becomes full sequences of ``max_tokens`` and then one piece for
each binary digit of what is left, longest first.  Every piece is a sequence of its
own with a power-of-two length, so sequences of one length form a bucket that
batches without padding, and no sequence crosses documents.

The plan is narrow: scan -> Arrow map, no shuffle.  A lost task is redone from its
input split alone and gives the same pieces and ids.

Defined cases: null or empty text has no word ids, so its one piece is the closing
id; null ``doc_id`` is kept; repeated rows are packed each on their own; an empty
table gives an empty result; further input columns are ignored.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long"
#: Chunks between white space whose ids a worker remembers at most.
CACHE_CHUNKS = 1_200_000
_STATE: dict = {}


class ChunkTokenizer:
    """Ids of whole texts, remembered per chunk between ASCII white space.

    Exact for tokenizers whose pre-tokenizer never joins across white space, nor letters
    with punctuation, and that fold case: the ids of a text are those of its chunks in
    order.  Checked against whole-text encoding in the tests.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        self.known: dict[bytes, bytes] = {}
        vocabulary = tokenizer.get_vocab()
        #: ids that end a word
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text of a piece."""
        if b"<|" not in data.tobytes():  # else a special token could be spelled in another case
            data = K.LOWER[data]
            data, offsets = _part_marks(data, offsets)
        whole, known = data.tobytes(), self.known
        split = [whole[a:b].split() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        chunks = set().union(*split)
        missing = list(chunks.difference(known))
        if len(known) + len(missing) > CACHE_CHUNKS:
            known.clear()
            missing = list(chunks)
        self._learn(missing)
        return [b"".join(map(known.__getitem__, out)) for out in split]

    def _learn(self, chunks: list[bytes]) -> None:
        """ASCII words are encoded together, since each ends where an id ends a word."""
        plain: list[bytes] = []
        odd: list[bytes] = []
        for chunk in chunks:
            (plain if chunk.isalpha() else odd).append(chunk)
        for i in range(0, len(plain), 2000):
            part = plain[i : i + 2000]
            ids = np.array(self.encode([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(part):
                odd += part
                continue
            raw, cut = ids.tobytes(), [0, *(4 * cut).tolist()]
            self.known.update(zip(part, (raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)), strict=True))
        for i in range(0, len(odd), 20_000):
            part = odd[i : i + 20_000]
            for chunk, e in zip(part, self.encode([c.decode() for c in part], add_special_tokens=False), strict=True):
                self.known[chunk] = array("I", e.ids).tobytes()


_LETTER = K.class_table(lambda b: 0x61 <= (b | 0x20) <= 0x7A)
_MARK = K.class_table(lambda b: 0x21 <= b <= 0x7E and not 0x61 <= (b | 0x20) <= 0x7A and not 0x30 <= b <= 0x39 and b != 0x27)


def _part_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put a space between an ASCII letter and punctuation (but apostrophes).

    They are token runs of their own anyway; parted, far fewer chunks are new.
    """
    if not len(data):
        return data, offsets
    letter, mark = _LETTER[data], _MARK[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    cut[offsets[:-1][offsets[:-1] < len(data)]] = False
    at = np.flatnonzero(cut)
    return np.insert(data, at, 0x20), offsets + np.searchsorted(at, offsets)


@lru_cache(1 << 16)
def piece_lengths(n: int, longest: int) -> list[int]:
    """Full sequences, then the binary digits of the rest from the highest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _mapper(path: str, longest: int, closing: int):
    def run(batches):
        tokens = _STATE.get(path)
        if tokens is None:
            tokens = _STATE[path] = ChunkTokenizer(path)
        end = np.array([closing], "<u4").tobytes()
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(1), 4 * K.PIECE_BYTES):
                blobs = [ids + end for ids in tokens.ids(data, offsets)]
                size = [len(b) // 4 for b in blobs]
                lengths = [piece_lengths(n, longest) for n in size]
                of = np.repeat(np.arange(last - first), [len(x) for x in lengths])
                length = np.fromiter((n for x in lengths for n in x), np.int64, len(of))
                total = np.array(size, np.int64)
                before = np.cumsum(total) - total
                start = np.cumsum(length) - length - before[of]
                # the pieces of a document lie one after the other, so one buffer holds them all
                bounds = np.concatenate([[0], 4 * np.cumsum(length)]).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(bounds), pa.py_buffer(b"".join(blobs))])
                rows = pa.array(of)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first).take(rows), pa.array(start), pa.array(length), ids, pa.array(total[of])], names=["doc_id", "start", "length", "ids", "doc_tokens"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, closing_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32 blob), doc_tokens,
    sequence_id, offset, bucket (the power of two whose batches it belongs to)."""
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(_mapper(tokenizer_path, max_tokens, closing_id), SCHEMA)
    return made.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.col("length")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences in one folder per length, ready to batch."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)


K.ship(__name__)
