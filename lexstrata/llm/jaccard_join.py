"""N-gram Jaccard join with signature trees.

Documents are sets of distinct word shingles; two link at Jaccard >= ``percent``/100.

1. Equal sets are one class (two set hashes and the size).
2. Leader rounds, cheap: of the classes with an equal min-hash two are heads, at first the
   one that agrees with most others and a random one, then other random ones; of the heads
   that agree with it on most of twelve, a class tries three, by exact verification.  This
   decides nothing alone.  It only makes groups of near copies one component, whose
   members need not be paired any more.
3. Screen.  A linked pair shares a shingle among the first n - ceil(n * percent / 100) + 1
   of each, in whatever order of all shingles.  Take the shingles of one zone of the hash
   range first: a class that has so many of them that no other component holds can link
   to nothing outside its component.  Most are settled so.
4. Exact candidates among the rest.  Shingles are counted there and ordered rarest first;
   classes of different components and sizes that may link, with a common shingle in that
   prefix, form its block.
5. In a block a signature tree is built: bitmaps as wide as their sets are large, sets
   ordered by size and min-hash so that nodes hold similar ones; a node has the OR of its
   bitmaps, its range of sizes, and the most bits lost to collisions.  Two trees are
   traversed together; a pair of nodes goes when its sizes exclude a link or when common
   bits plus lost bits cannot reach the overlap that the smallest sizes need.  A pair of
   sets must also reach it with what follows the block's shingle in both orders, and is
   left to the block of an earlier common shingle.  Blocks over ``block_rows`` are dealt
   by size band and hash to pairs of parts, the top level of the tree.
6. What is left is verified on whole texts.  In two passes each block gives one pair, the
   closest, of each component in it, so no more rows than it has, and tells whether it left
   any out.  Blocks that did, and that the components made so still divide, are passed
   again with wide bitmaps, which come close to counting; the last pass leaves out none.
   Components are taken over all links.

Counts are pre-aggregated and come back by joins of written tables, which adaptive
execution splits where a shingle is hot; copies are collapsed, and connected classes are
not paired.  No group is ever gathered in one task or in the driver.

Defined cases: null, empty and blank texts have the empty set, which links with nothing;
rows that share a doc_id are one node of the graph, so their classes are one component; a
null doc_id takes the component of its class, but links no further (null if all ids of
the class are null); further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import kernels as K
from .components import connected
from .scratch import Scratch

MINHASHES = 12
#: Equal min-hashes that make a leader pair worth verifying.
AGREE = 7
LEADER_ROUNDS = 3
#: Passes over the blocks that verify one candidate pair of each component before all are.
PICK_ROUNDS = 2
#: Part of the hash range that the screen looks at; a prefix is a little over a quarter of a set.
ZONE = 0.36
#: Equal parts of the zone, looked at one after the other: only one's shingles are on disk at a time.
ZONE_ROUNDS = 2
#: Bitmaps have 4 bits a shingle or more, up to 8 kB (then fewer; sparse ones exclude less, never more).
BITS_PER_SHINGLE, MAX_BITS = 4, 1 << 16
#: Bits a shingle in blocks that are passed again, up to 16 kB.
WIDE_BITS, MAX_WIDE_BITS = 32, 1 << 17
#: First shared shingles of a set by which repeated pairs are told.
HEAD = 16
_FAN = 4
_SMALL = 32  # blocks up to this size are one leaf
_CHUNK = 1 << 15


class Sets:
    """Distinct shingle hashes of each row of a piece, ascending within the row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, k: int):
        w = K.Words(data, offsets, K.NOT_SPACE, lower=True)
        h = K.Windows(w.hashes(31))
        i, row = np.arange(w.n), w.row_of()
        size = np.minimum(w.count, k)[row] if w.n else np.zeros(0, np.int64)
        ok = i + size <= w.last_of()
        short = size < k
        ok &= ~short | (i == w.first[row])
        row, token = row[ok], h.at(i[ok], size[ok])
        edge = np.searchsorted(row, np.arange(w.rows + 1)).tolist()
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            token[a:b].sort()
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
        self.row, self.token, self.rows = row[new], token[new], w.rows
        self.first = np.searchsorted(self.row, np.arange(w.rows + 1))
        self.n = np.diff(self.first)

    def row_set(self, r: int) -> np.ndarray:
        return self.token[self.first[r] : self.first[r + 1]]

    def signature(self, seed: int) -> np.ndarray:
        return K.mix(K.row_sums(K.mix(self.token ^ np.uint64(seed)), self.first) + self.n.astype(np.uint64))


def _zone(turn: int = ZONE_ROUNDS) -> np.uint64:
    """Where a part of the zone begins; the end of the zone after the last."""
    return np.uint64(int(ZONE * 2**64) * turn // ZONE_ROUNDS)


def _summaries(k: int):
    """Documents -> set size, shingles in the zone, two set hashes, min-hashes."""
    zone = _zone()

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(1)):
                s = Sets(data, offsets, k)
                full = np.flatnonzero(s.n > 0)
                mh = np.zeros((s.rows, MINHASHES), np.uint64)
                if len(full):
                    for j in range(MINHASHES):
                        mh[full, j] = np.minimum.reduceat(s.token * np.uint64(0x9E3779B97F4A7C15 + 0x51ED2701 * 2 * j), s.first[full])
                inside = K.row_sums((s.token < zone).astype(np.int64), s.first)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(s.rows + 1, dtype=np.int32) * MINHASHES), K.signed(mh.reshape(-1)))
                ids, keys = (batch.column(c).slice(first, last - first) for c in (0, 2))
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(s.n.astype(np.int64)), pa.array(inside), K.signed(s.signature(1)), K.signed(s.signature(2)), lists], names=["doc_id", "key", "n", "z", "s1", "s2", "mh"])

    return run


def _shingles(k: int, zone: tuple[np.uint64, np.uint64] | None):
    """(text, further columns) -> (token, further columns) for the shingles from the first to below the second of ``zone``, or all."""

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(0)):
                s = Sets(data, offsets, k)
                token, row = s.token, s.row
                if zone is not None:
                    inside = (token >= zone[0]) & (token < zone[1])
                    token, row = token[inside], row[inside]
                at, more = pa.array(row), batch.schema.names[1:]
                yield pa.RecordBatch.from_arrays([K.signed(token), *(batch.column(c).slice(first, last - first).take(at) for c in more)], names=["token", *more])

    return run


def bitmap(tokens: np.ndarray, each: int = BITS_PER_SHINGLE, most: int = MAX_BITS) -> bytes:
    """A set's bitmap: a power of two of bits, at least 64."""
    bits = 64
    while bits < each * len(tokens) and bits < most:
        bits *= 2
    out = np.zeros(bits, bool)
    out[(K.mix(tokens + np.uint64(0xB175)) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def _bitmaps(k: int, each: int, most: int):
    """(text, cls) -> (cls, bits)."""

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in K.pieces(batch.column(0)):
                s = Sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, last - first), pa.array([bitmap(s.row_set(r), each, most) for r in range(s.rows)], pa.binary())], names=["cls", "bits"])

    return run


def _verify(k: int, percent: int):
    """(a, b, text of a, text of b) -> (a, b) of linked pairs."""

    def run(batches):
        for batch in batches:
            left = [x for p in K.pieces(batch.column(2)) for x in _row_sets(p, k)]
            right = [x for p in K.pieces(batch.column(3)) for x in _row_sets(p, k)]
            ok = []
            for x, y in zip(left, right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(len(x) > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return run


def _row_sets(piece, k: int):
    s = Sets(piece[2], piece[3], k)
    return [s.row_set(r) for r in range(s.rows)]


class Signatures:
    """Bitmaps of different widths (words of 64 bits), one after the other, with their set sizes."""

    def __init__(self, bits: list[bytes], n: np.ndarray):
        self.words = np.frombuffer(b"".join(bits), np.uint64)
        self.width = np.array([len(b) // 8 for b in bits], np.int64)
        self.start = np.cumsum(self.width) - self.width
        self.n = n

    def folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of rows, wider ones folded to ``width`` words (bits are hashes modulo the width)."""
        out = np.zeros((len(rows), width), np.uint64)
        for own in np.unique(self.width[rows]).tolist():
            at = np.flatnonzero(self.width[rows] == own)
            raw = self.words[self.start[rows[at], None] + np.arange(own)]
            out[at] = np.bitwise_or.reduce(raw.reshape(len(at), own // width, width), axis=1)
        return out

    def bound(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """What the bitmaps of rows i and j allow their overlap to be at most."""
        bound = np.zeros(len(i), np.int64)
        width = np.minimum(self.width[i], self.width[j])
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            step = max(1, (1 << 20) // w)
            for lo in range(0, len(own), step):
                at = own[lo : lo + step]
                a, b = self.folded(i[at], w), self.folded(j[at], w)
                count = lambda x: np.bitwise_count(x).sum(1, dtype=np.int64)
                bound[at] = count(a & b) + np.minimum(self.n[i[at]] - count(a), self.n[j[at]] - count(b))
        return bound

    def may_link(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether the bitmaps of rows i and j leave room for the overlap that a link needs."""
        return (100 + percent) * self.bound(i, j) >= percent * (self.n[i] + self.n[j])


class Tree:
    """Signature tree over sets in the order given: level 0 are the sets, each level above ORs ``_FAN``."""

    def __init__(self, bits: np.ndarray, n: np.ndarray):
        lost = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, n, n, lost)]
        while len(self.levels[-1][0]) > _FAN:
            b, lo, hi, c = self.levels[-1]
            cut = np.arange(0, len(b), _FAN)
            self.levels.append((np.bitwise_or.reduceat(b, cut, 0), np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.maximum.reduceat(c, cut)))

    def level(self, i: int):
        return self.levels[min(i, len(self.levels) - 1)]


def _possible(x, i, y, j, percent: int) -> np.ndarray:
    """Whether some set below node i of level x may link with one below node j of level y."""
    ok = (100 * x[2][i] >= percent * y[1][j]) & (100 * y[2][j] >= percent * x[1][i])
    i, j = i[ok], j[ok]
    step, bound = max(1, (1 << 20) // x[0].shape[1]), np.zeros(len(i), np.int64)
    for lo in range(0, len(i), step):
        p, q = i[lo : lo + step], j[lo : lo + step]
        bound[lo : lo + step] = np.bitwise_count(x[0][p] & y[0][q]).sum(1, dtype=np.int64) + np.minimum(x[3][p], y[3][q])
    ok[ok] = (100 + percent) * bound >= percent * (x[1][i] + y[1][j])
    return ok


def dual(x: Tree, y: Tree, percent: int, same: bool):
    """Chunks of pairs of sets that no node pair above them excludes; with ``same`` only i < j."""
    top = max(len(x.levels), len(y.levels)) - 1
    i, j = (a.reshape(-1) for a in np.meshgrid(np.arange(len(x.level(top)[0])), np.arange(len(y.level(top)[0])), indexing="ij"))
    stack = [(top, i, j)]
    while stack:
        level, i, j = stack.pop()
        if same:
            keep = i <= j if level else i < j
            i, j = i[keep], j[keep]
        ok = _possible(x.level(level), i, y.level(level), j, percent)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if not level:
            yield i, j
            continue
        for lo in range(0, len(i), _CHUNK // _FAN**2):  # depth first, so the frontier stays small
            p, q = i[lo : lo + _CHUNK // _FAN**2], j[lo : lo + _CHUNK // _FAN**2]
            if level < len(x.levels):
                p, q = _down(p, q, len(x.levels[level - 1][0]))
            if level < len(y.levels):
                q, p = _down(q, p, len(y.levels[level - 1][0]))
            stack.append((level - 1, p, q))


def _down(own: np.ndarray, other: np.ndarray, below: int):
    kids = (own[:, None] * _FAN + np.arange(_FAN)).reshape(-1)
    ok = kids < below
    return kids[ok], np.repeat(other, _FAN)[ok]


class Block:
    """Rows of one or more blocks, as arrays."""

    def __init__(self, t: pa.Table):
        column = lambda c: t.column(c).to_numpy()
        self.cls, self.component, self.n, self.rank, self.pos, self.side = (column(c) for c in ("cls", "component", "n", "rank", "pos", "side"))
        self.key = np.stack([column(c) for c in ("token", "pa", "pb")])
        self.cut = np.concatenate([[0], np.flatnonzero((self.key[:, 1:] != self.key[:, :-1]).any(0)) + 1, [t.num_rows]])
        self.block = np.repeat(np.arange(len(self.cut) - 1), np.diff(self.cut))
        self.sig = Signatures(t.column("bits").to_pylist(), self.n)
        self.near = np.array(t.column("mh").to_pylist(), np.int64).reshape(t.num_rows, -1)
        heads = t.column("head").to_pylist()
        self.head = np.zeros((t.num_rows, HEAD), np.int64)
        self.heads = np.array([len(h) for h in heads], np.int64)
        for r, h in enumerate(heads):
            self.head[r, : len(h)] = h

    def cheap(self, i, j, percent: int) -> np.ndarray:
        """Different components, and what follows the block's shingle in both orders is enough."""
        left = np.minimum(self.n[i] - self.rank[i], self.n[j] - self.rank[j])
        return (self.component[i] != self.component[j]) & ((100 + percent) * left >= percent * (self.n[i] + self.n[j]))

    def first_here(self, i, j) -> np.ndarray:
        """False where both sets are known to share an earlier shingle of their prefixes."""
        ok = np.ones(len(i), bool)
        for lo in range(0, len(i), 1 << 12):
            p, q = i[lo : lo + (1 << 12)], j[lo : lo + (1 << 12)]
            same = self.head[p][:, :, None] == self.head[q][:, None, :]
            place = np.arange(HEAD)
            same &= (place < np.minimum(self.heads[p], self.pos[p])[:, None])[:, :, None]
            same &= (place < self.heads[q][:, None])[:, None, :]
            ok[lo : lo + (1 << 12)] = ~same.any((1, 2))
        return ok

    def best(self, i, j) -> np.ndarray:
        """Whether a pair is the closest, by bitmaps, that one of its components has in its block."""
        pair = np.tile(np.arange(len(i)), 2)
        block, component = self.block[i[pair]], np.concatenate([self.component[i], self.component[j]])
        order = np.lexsort(((self.sig.bound(i, j) / (self.n[i] + self.n[j]))[pair], component, block))
        block, component = block[order], component[order]
        last = np.ones(len(order), bool)
        last[:-1] = (block[1:] != block[:-1]) | (component[1:] != component[:-1])
        ok = np.zeros(len(i), bool)
        ok[pair[order[last]]] = True
        return ok

    def found(self, i, j, left=()) -> pa.RecordBatch:
        """Pairs of classes, and a row for each block (by its first row) that left out some."""
        i, j, gone = self.cls[i], self.cls[j], pa.nulls(len(left), pa.int64())
        ends = (pa.concat_arrays([pa.array(x(i, j)), gone]) for x in (np.minimum, np.maximum))
        token = pa.concat_arrays([pa.nulls(len(i), pa.int64()), pa.array(self.key[0][np.asarray(left, np.int64)])])
        return pa.RecordBatch.from_arrays([*ends, token], names=["a", "b", "token"])

    def small(self, percent: int, starts: np.ndarray, m: int):
        """Pairs within blocks of ``m`` rows that begin at ``starts``: a leaf each."""
        u, v = np.triu_indices(m, 1)
        step = max(1, _CHUNK // len(u))
        for lo in range(0, len(starts), step):
            part = starts[lo : lo + step, None]
            i, j = (part + u).reshape(-1), (part + v).reshape(-1)
            ok = self.cheap(i, j, percent)
            i, j = i[ok], j[ok]
            ok = self.sig.may_link(i, j, percent)
            i, j = i[ok], j[ok]
            ok = self.first_here(i, j)
            yield i[ok], j[ok]

    def trees(self, percent: int, lo: int, hi: int):
        """Pairs of a larger block, by dual traversal of one tree for each width (and side)."""
        rows = lo + np.lexsort((*self.near[lo:hi].T[::-1], np.log2(self.n[lo:hi]).astype(int)))
        same = self.side[lo] == 2
        sides = (rows, rows) if same else tuple(rows[self.side[rows] == s] for s in (0, 1))
        left, right = ({w: s[self.sig.width[s] == w] for w in np.unique(self.sig.width[s]).tolist()} for s in sides)
        for w, p in left.items():
            for v, q in right.items():
                if (same and v < w) or max(v, w) > 2 * min(v, w):  # linked sets are at most a third larger
                    continue
                at = min(v, w)
                x = Tree(self.sig.folded(p, at), self.n[p])
                y = x if same and v == w else Tree(self.sig.folded(q, at), self.n[q])
                for i, j in dual(x, y, percent, x is y):
                    ok = self.cheap(p[i], q[j], percent)
                    i, j = p[i[ok]], q[j[ok]]
                    ok = self.first_here(i, j)
                    yield i[ok], j[ok]


def _block_pairs(percent: int, pick: bool):
    """Rows sorted by (token, part a, part b) -> candidate pairs (a, b) of classes not connected yet.

    A block's rows carry side 0 (in part a), 1 (in part b) or 2 (both are the same part).
    With ``pick`` only the closest of each component, and the token of blocks that have others.
    """

    def found(t: pa.Table):
        block = Block(t)
        size, start = np.diff(block.cut), block.cut[:-1]
        leaf = (size <= _SMALL) & (block.side[start] == 2)
        for m in np.unique(size[leaf & (size > 1)]).tolist():
            for i, j in block.small(percent, start[leaf & (size == m)], m):
                ok = block.best(i, j) if pick else np.ones(len(i), bool)
                yield block.found(i[ok], j[ok], start[np.unique(block.block[i[~ok]])])
        for b in np.flatnonzero(~leaf & (size > 1)).tolist():
            i = j = np.zeros(0, np.int64)
            left = []
            for p, q in block.trees(percent, block.cut[b], block.cut[b + 1]):
                if not pick:
                    yield block.found(p, q)
                    continue
                i, j = np.concatenate([i, p]), np.concatenate([j, q])
                ok = block.best(i, j)
                left = left if ok.all() else [start[b]]
                i, j = i[ok], j[ok]
            yield block.found(i, j, left)

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            held = t if held is None else pa.concat_tables([held, t])
            # the last block may go on in the next batch
            last = [held.column(c)[held.num_rows - 1].as_py() for c in ("token", "pa", "pb")]
            same = np.all([held.column(c).to_numpy() == v for c, v in zip(("token", "pa", "pb"), last, strict=True)], axis=0)
            begin = int(np.argmax(same))
            if begin:
                yield from found(held.slice(0, begin))
                held = held.slice(begin)
        if held is not None:
            yield from found(held)

    return run


def _band(percent: int) -> Column:
    """Linked sets are one band apart at most."""
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")


def _blocks(posts: DataFrame, block_rows: int, percent: int) -> DataFrame:
    """Deal blocks over ``block_rows`` (of m rows) to pairs of parts; side says in which a row is."""
    parts = F.ceil(F.col("m") / block_rows).cast("int")
    own = F.col("band") * F.lit(1 << 20) + F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    small = posts.where(F.col("m") <= block_rows).select("*", F.lit(0).alias("pa"), F.lit(0).alias("pb"), F.lit(2).alias("side"))
    big = posts.where(F.col("m") > block_rows).withColumn("band", _band(percent)).withColumn("parts", parts).withColumn("own", own)
    other = F.flatten(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: (F.col("band") + d) * F.lit(1 << 20) + p)))
    big = big.withColumn("other", F.explode(other)).select(
        *posts.columns,
        F.least("own", "other").alias("pa"),
        F.greatest("own", "other").alias("pb"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    return small.unionByName(big)


def _apart(rows: DataFrame, *by: str) -> DataFrame:
    """Keys that rows of two components have, with their number of rows m."""
    both = rows.groupBy(*by).agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"))
    return both.where("x != y").select(*by, "m")


class _Join:
    """One run over documents; every step is a written table."""

    def __init__(self, docs: DataFrame, k: int, percent: int, block_rows: int):
        self.tmp, self.k, self.percent, self.block_rows = Scratch(docs.sparkSession, "jaccard"), k, percent, block_rows
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.docs = docs.withColumn("key", F.xxhash64("text"))
        self.need = F.ceil(F.col("n") * percent / 100)

    def classes(self) -> None:
        save = self.tmp.save
        self.sums = save(self.docs.mapInArrow(_summaries(self.k), "doc_id long, key long, n long, z long, s1 long, s2 long, mh array<long>"), "sums")
        named = self.sums.where("n > 0 and doc_id is not null")
        # the text of a class is found by doc_id and key
        made = named.groupBy("s1", "s2", "n", "z").agg(F.min(F.struct("doc_id", "key")).alias("l"), F.first("mh").alias("mh"))
        made = made.select(F.monotonically_increasing_id().alias("cls"), F.col("l.doc_id").alias("leader"), F.col("l.key").alias("key"), "s1", "s2", "n", "z", "mh")
        made = save(made, "classes")
        self.made = made
        found = self.docs.join(made.select(F.col("leader").alias("doc_id"), "key", "cls", "n"), ["doc_id", "key"])
        self.texts = save(found.dropDuplicates(["doc_id", "key", "cls"]).select("cls", "n", "text"), "texts")
        self.known = made.select("cls", "leader", "n", "z", F.col("cls").alias("component"))
        # a doc_id with several texts joins their classes
        name = F.struct("s1", "s2", "n")
        several = named.groupBy("doc_id").agg(F.min(name).alias("x"), F.max(name).alias("y")).where("x != y").select("doc_id")
        several = save(named.join(several, "doc_id").select("doc_id", "s1", "s2", "n").distinct(), "several")
        if not several.isEmpty():
            several = save(several.join(made.select("s1", "s2", "n", "cls"), ["s1", "s2", "n"]).select("doc_id", "cls"), "several-classes")
            hub = several.groupBy("doc_id").agg(F.min("cls").alias("a"))
            self.link(several.join(hub, "doc_id").where("a != cls").select("a", F.col("cls").alias("b")), "cc-several")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        texts = self.tmp.save(self.texts.join(ids, "cls").select("cls", "text"), f"{name}-texts")
        both = pairs.join(texts.withColumnsRenamed({"cls": "a", "text": "ta"}), "a").join(texts.withColumnsRenamed({"cls": "b", "text": "tb"}), "b")
        edges = self.tmp.save(both.select("a", "b", "ta", "tb").mapInArrow(_verify(self.k, self.percent), "a long, b long"), name)
        self.tmp.drop(f"{name}-texts")
        return edges

    def link(self, edges: DataFrame, name: str) -> None:
        """Merge the components that edges between classes connect."""
        of = lambda c: self.known.select(F.col("cls").alias(c), F.col("component").alias(f"{c}2"))
        between = edges.join(of("a"), "a").join(of("b"), "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        labels = connected(between, self.tmp, name).select(F.col("node").alias("component"), F.col("component").alias("merged"))
        known = self.known.join(labels, "component", "left")
        self.known = self.tmp.save(known.select("cls", "leader", "n", "z", F.coalesce("merged", "component").alias("component")), f"known-{name}")

    def leader_rounds(self) -> None:
        save = self.tmp.save
        keyed = self.made.select("cls", F.posexplode("mh").alias("j", "h"))
        # written, as the heads are, else a join would take over the sum's partitioning and a hot min-hash could not be split
        groups = save(keyed.groupBy("j", "h").agg(F.count("*").alias("m")).where("m > 1"), "groups")
        keyed = save(keyed.join(groups, ["j", "h"]), "minhashes")
        self.tmp.drop("groups")
        if keyed.isEmpty():
            return
        mates = save(keyed.groupBy("cls").agg(F.sum("m").alias("mates")), "mates")
        mh = lambda c: self.made.select(F.col("cls").alias(f"{c}_cls"), F.col("mh").alias(f"{c}_mh"))
        head = lambda c: F.struct(F.col(f"{c}.cls").alias("b"), F.col(f"{c}.mates").alias("mates"), F.col(f"{c}.component").alias("component"), F.col(f"{c}_mh").alias("mh"))
        agree = lambda x: F.aggregate(F.zip_with("mh", x["mh"], lambda v, w: (v == w).cast("int")), F.lit(0), lambda n, v: n + v)
        best = lambda *by: F.array_max(F.transform("heads", lambda x: F.struct(*(x[c].alias(c) for c in by), x["b"].alias("b"))))["b"]
        for turn in range(LEADER_ROUNDS):
            now = keyed.join(mates, "cls").join(self.known.select("cls", "component"), "cls")
            by_hash = lambda i: F.xxhash64("cls", F.lit(2 * turn + i))  # noqa: B023, E731
            first = by_hash(0) if turn else F.col("mates")
            heads = now.groupBy("j", "h").agg(*(F.max(F.struct(o.alias("by"), "mates", "cls", "component")).alias(n) for n, o in (("p", first), ("q", by_hash(1)))), F.min("component").alias("x"), F.max("component").alias("y"))
            heads = heads.where("x != y").select("j", "h", "p", "q", F.col("p.cls").alias("p_cls"), F.col("q.cls").alias("q_cls")).join(mh("p"), "p_cls").join(mh("q"), "q_cls")
            heads = save(heads.select("j", "h", F.array(head("p"), head("q")).alias("heads")), f"heads-{turn}")
            # a class gathers the heads of its twelve groups, two of each, in one row
            near = now.join(heads, ["j", "h"]).select(F.col("cls").alias("a"), F.filter("heads", lambda x: x["component"] != F.col("component")).alias("heads")).where("size(heads) > 0")
            near = near.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("heads"))).alias("heads")).join(self.made.select(F.col("cls").alias("a"), "mh"), "a")
            judged = F.transform("heads", lambda x: F.struct(agree(x).alias("agree"), x["mates"].alias("mates"), F.xxhash64(x["b"]).alias("by"), x["b"].alias("b")))
            near = near.select("a", F.filter(judged, lambda x: x["agree"] >= AGREE).alias("heads")).where("size(heads) > 0")
            # it tries the closest, the one with most mates, and one by hash
            near = near.select("a", F.explode(F.array_distinct(F.array(best("agree", "mates"), best("mates"), best("by")))).alias("b"))
            near = save(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"near-pairs-{turn}")
            edges = self.verified(near, f"edges-near-{turn}")
            self.tmp.drop(f"heads-{turn}", f"near-pairs-{turn}")
            if edges.isEmpty():
                break
            self.link(edges, f"cc-near-{turn}")
        self.tmp.drop("minhashes", "mates")

    def open_texts(self) -> DataFrame:
        """Texts of the classes that the screen doesn't settle.

        Texts are only scanned here; components come to the shingles that two classes have.
        """
        save = self.tmp.save
        rows, of = self.texts.select("text", "cls"), self.known.select("cls", "component")
        parts = []
        for turn in range(ZONE_ROUNDS):
            part = save(rows.mapInArrow(_shingles(self.k, (_zone(turn), _zone(turn + 1))), "token long, cls long"), f"zone-{turn}")
            twice = part.groupBy("token").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x != y").select("token")
            twice = save(twice, f"zone-twice-{turn}")
            common = save(part.join(twice, "token").join(of, "cls"), f"zone-common-{turn}")
            self.tmp.drop(f"zone-{turn}", f"zone-twice-{turn}")
            met = save(_apart(common, "token").select("token"), f"zone-met-{turn}")
            parts.append(save(common.join(met, "token").groupBy("cls").agg(F.count("*").alias("shared")), f"zone-part-{turn}"))
            self.tmp.drop(f"zone-common-{turn}", f"zone-met-{turn}")
        shared = save(reduce(DataFrame.union, parts).groupBy("cls").agg(F.sum("shared").alias("shared")), "zone-shared")
        left = self.known.join(shared, "cls").where(F.col("z") - F.col("shared") < F.col("n") - self.need + 1)
        # a class without any shared shingle in the zone may have too few of them to tell
        few = self.known.join(shared, "cls", "left_anti").where(F.col("z") < F.col("n") - self.need + 1)
        left = left.select("cls", "component").union(few.select("cls", "component"))
        return save(self.texts.join(left, "cls").select("text", "cls", "component", "n"), "open")

    def prefixes(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows of blocks; the first shared shingles of each class that has any; open texts."""
        save = self.tmp.save
        texts = self.open_texts()
        rows = save(texts.select("text", "cls", "component").mapInArrow(_shingles(self.k, None), "token long, cls long, component long"), "rows")
        met = save(_apart(rows, "token"), "met")
        shared = rows.join(met, "token").join(texts.select("cls", "n"), "cls")
        order = Window.partitionBy("cls").orderBy("m", "token")
        own = Window.partitionBy("cls")
        # shingles that no other component has come first
        rank = (F.col("n") - F.count("*").over(own) + F.row_number().over(order) - 1).alias("rank")
        posts = shared.select("token", "cls", "component", "n", rank).where(F.col("rank") < F.col("n") - self.need + 1)
        posts = save(posts.withColumn("band", _band(self.percent)), "posts-0")
        self.tmp.drop("rows", "met")
        # a block needs sets of two components and of sizes that may link
        bands = posts.groupBy("token", "band").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        bands = bands.select("token", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"), "x", "y")
        bands = bands.groupBy("token", "band").agg(F.min("x").alias("x"), F.max("y").alias("y")).where("x != y").select("token", "band")
        posts = posts.join(bands, ["token", "band"]).drop("band")
        posts = save(posts.withColumn("pos", F.row_number().over(Window.partitionBy("cls").orderBy("rank")) - 1), "posts")
        heads = posts.where(F.col("pos") < HEAD).groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("h")).select("cls", F.col("h.token").alias("head"))
        heads = save(heads, "heads")  # a row for each class that has posts
        return posts, heads, texts.select("text", "cls")

    def candidates(self, posts: DataFrame, heads: DataFrame, texts: DataFrame, turn: int) -> DataFrame:
        """Rows of one pass over the blocks; the last gives every pair."""
        save = self.tmp.save
        width = (WIDE_BITS, MAX_WIDE_BITS) if turn else (BITS_PER_SHINGLE, MAX_BITS)
        bits = texts.join(heads.select("cls"), "cls").select("text", "cls").mapInArrow(_bitmaps(self.k, *width), "cls long, bits binary")
        signatures = save(bits.join(heads, "cls").join(self.made.select("cls", F.slice("mh", 1, 3).alias("mh")), "cls"), f"signatures-{turn}")
        # written, else the join would take over the sum's partitioning and a hot shingle could not be split
        sizes = save(posts.groupBy("token").agg(F.count("*").alias("m")), f"sizes-{turn}")
        blocks = _blocks(posts.join(sizes, "token").join(signatures, "cls"), self.block_rows, self.percent)
        blocks = blocks.select("token", "pa", "pb", "side", "cls", "component", "n", "rank", "pos", "head", "mh", "bits")
        blocks = blocks.repartition("token", "pa", "pb").sortWithinPartitions("token", "pa", "pb")
        found = save(blocks.mapInArrow(_block_pairs(self.percent, turn < PICK_ROUNDS), "a long, b long, token long"), f"found-{turn}")
        self.tmp.drop(f"signatures-{turn}", f"sizes-{turn}")
        return found

    def link_candidates(self, posts: DataFrame, heads: DataFrame, texts: DataFrame) -> None:
        """Verify the pairs of each pass; blocks that left out some, and have two components yet, are passed again."""
        save = self.tmp.save
        for turn in range(PICK_ROUNDS + 1):
            found = self.candidates(posts, heads, texts, turn)
            pairs = save(found.where("token is null").select("a", "b").distinct(), f"pairs-{turn}")
            if not pairs.isEmpty():
                edges = self.verified(pairs, f"edges-exact-{turn}")
                if not edges.isEmpty():
                    self.link(edges, f"cc-exact-{turn}")
            again = save(found.where("token is not null").select("token").distinct(), f"again-{turn}")
            if again.isEmpty():
                return
            posts = save(posts.join(again, "token").drop("component").join(self.known.select("cls", "component"), "cls"), f"posts-again-{turn}")
            met = save(_apart(posts, "token").select("token"), f"met-again-{turn}")
            posts = save(posts.join(met, "token"), f"posts-{turn + 1}")
            heads = save(heads.join(posts.select("cls").distinct(), "cls"), f"heads-again-{turn}")
            if heads.isEmpty():
                return

    def run(self) -> DataFrame:
        self.classes()
        self.leader_rounds()
        self.link_candidates(*self.prefixes())
        first = self.known.groupBy("component").agg(F.min("leader").alias("component_id"))
        named = self.made.select("cls", "s1", "s2", "n").join(self.known.select("cls", "component"), "cls").join(first, "component")
        named = self.tmp.save(named.select("s1", "s2", "n", "component_id"), "named")
        out = self.sums.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def link_near_copies(docs: DataFrame, k: int = 5, percent: int = 75, block_rows: int = 4096) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return _Join(docs, k, percent, block_rows).run()


K.ship(__name__)
