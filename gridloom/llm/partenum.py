"""Near-duplicate groups by an exact Jaccard join with PartEnum signatures.

Arasu, Ganti & Kaushik, "Efficient Exact Set-Similarity Joins" (VLDB 2006). Sets of sizes r and s with
Jaccard similarity t or more differ in at most k = (1 - t) / (1 + t) (r + s) elements. Sizes are cut
into bands so that similar sets are in one band or in neighbours; every set is signed for its own band
and the next. In a band the hashed domain is cut into n1 parts of three sub-parts each. With
n1 = k // 2 + 1 + x parts at least 1 + x hold at most one difference, so at least two of their
three sub-parts are equal: each pair of sub-parts gives one signature, and similar sets share one.
Signatures of empty pairs are left out by sets with at most x parts that have such a pair; sets with
more emit them. If neither set of a similar pair is of the second kind, or just one, a part among the
1 + x remains whose equal pair is not empty, so nothing is lost.

Exact copies are one set from the start. Signatures travel in packed runs, are sorted with numpy and
only those of two sets or more stay. Each bucket is first compared with its smallest member;
buckets that still hold sets of different groups are then compared in full, in blocks of bounded size,
on parity sketches: bit h mod m of a sketch is the parity of the set's elements there, so the bits in which
two sketches differ are never more than the elements in which the sets differ. Of the pairs that this
lower bound leaves, only the closest of each pair of groups are verified on whole sets; where more
were left, a round with more of them follows after the groups that met are united. So groups are
exact while the pairs inside them are never enumerated. Sets are compared as 64-bit hashes of shingles.

Keys that may hold a large share of all rows (a set's copies, a bucket, a set with many partners) are
salted: a bit mask of the salts in use, summed up before the shuffle, tells how often the other side
of a join is copied, so a rare key is not copied at all.

Defined results: null text has no words and is linked with nothing; rows that share an id share a
group; a row without id gets the group of its exact copies; repeated rows are kept; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .components import components
from .decontam import bit_table
from .words import SPACED, mix, raw, sequence_hash, shingles, split

ROWS = 600_000  # signature rows of one partition, and of one flush
BLOCK = 1024  # rows of a bucket that are compared with each other at a time
PARTNERS = 64  # verified partners of one set in one run of rows
_LEVELS = 64 << np.arange(9)  # bits of a sketch


class Bands:
    """Size bands for a similarity of num / den."""

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        low = [1]
        while low[-1] <= largest * den // num + 1:
            low.append(max(low[-1] + 1, (low[-1] - 1) * den // num + 1))  # the least size whose partners end in the band before
        self.low = np.array(low, np.int64)
        top = self.low[1:] - 1
        self.k = (2 * top * (den - num)) // (den + num)
        base = self.k // 2 + 1
        self.x = np.where(base < 8, 0, np.ceil(0.08 * base).astype(np.int64) + 1)
        self.n1 = base + self.x

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, side="right") - 1


def sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted in each, and the n + 1 offsets."""
    w = split(texts, SPACED)
    h = w.hashes()
    s = shingles(h, k)
    out, at = [], np.zeros(w.n + 1, np.int64)
    for i in range(w.n):
        a, b = w.at[i], w.at[i + 1]
        own = np.unique(s[a : b - k + 1]) if b - a >= k else np.array([sequence_hash(h[a:b])]) if b > a else np.zeros(0, np.uint64)
        out.append(own)
        at[i + 1] = at[i] + len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), at


def _sums(cell: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Sums of uint64 values by cell, modulo 2^64."""
    low = np.bincount(cell, (v & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(cell, (v >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the sketch of a set of n elements: two an element or more, as a power of two within bounds.
    Unrelated sets then differ in about 0.86 n bits, sets of similarity 0.7 in 0.3 n, while 0.8 allows 0.22 n."""
    return _LEVELS[np.minimum(np.searchsorted(_LEVELS, 2 * n), len(_LEVELS) - 1)]


def sketches(h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity sketches of sets (concatenated in ``h``, sizes ``n``)."""
    bits = sketch_bits(n)
    at = np.concatenate([[0], np.cumsum(bits)])
    place = np.repeat(at[:-1], n) + (h & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=at[-1]) & 1).astype(np.uint8)
    data = np.packbits(odd, bitorder="little").tobytes()
    return [data[a:b] for a, b in zip((at[:-1] // 8).tolist(), (at[1:] // 8).tolist(), strict=True)]


class Sketches:
    """Sketches of many sets, compared in pairs; a longer one is folded to the shorter one's length."""

    def __init__(self, column: pa.Array):
        buf, off = raw(column)
        self.flat, self.start = np.frombuffer(buf.tobytes(), np.uint64), off[:-1] // 8
        self.words = np.diff(off) // 8

    def _matrix(self, rows: np.ndarray, w: int) -> np.ndarray:
        out = np.zeros((len(rows), w), np.uint64)
        of = self.words[rows]
        for long in np.unique(of):
            mine = np.flatnonzero(of == long)
            out[mine] = np.bitwise_xor.reduce(self.flat[self.start[rows[mine], None] + np.arange(long)].reshape(len(mine), -1, w), axis=1)
        return out

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """A lower bound of the difference of the sets x and y, pair by pair."""
        w, out = np.minimum(self.words[x], self.words[y]), np.zeros(len(x), np.int64)
        for short in np.unique(w):
            mine = np.flatnonzero(w == short)
            rows, place = np.unique(np.concatenate([x[mine], y[mine]]), return_inverse=True)
            m, (i, j) = self._matrix(rows, int(short)), place.reshape(2, -1)
            step = max(1, (1 << 19) // int(short))
            for a in range(0, len(mine), step):
                out[mine[a : a + step]] = np.bitwise_count(m[i[a : a + step]] ^ m[j[a : a + step]]).sum(1, dtype=np.int64)
        return out


def _profile(k: int):
    """Size, identity and sketch of each set."""

    @store.lean
    def run(it):
        for b in it:
            h, at = sets(b.column("text"), k)
            n = np.diff(at)
            doc = np.repeat(np.arange(len(n)), n)
            s1, s2 = _sums(doc, h, len(n)), _sums(doc, mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), len(n))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(sketches(h, n), pa.binary())], names=["doc_id", "n", "s1", "s2", "sketch"])

    return run


def signatures(h: np.ndarray, n: np.ndarray, bands: Bands, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets (concatenated in ``h``, sizes ``n``) for the band ``shift`` beyond their own,
    and the set that each belongs to."""
    band = bands.of(n) + shift
    use = (n > 0) & (bands.k[band] > 0)
    n1 = np.where(use, bands.n1[band], 0)
    at = np.concatenate([[0], np.cumsum(3 * n1)])
    doc = np.repeat(np.arange(len(n)), n)
    keep = use[doc]
    doc, h = doc[keep], h[keep]
    r = mix(h + np.uint64(0x51ED270B) * (band[doc].astype(np.uint64) + np.uint64(1)))
    cell = at[doc] + 3 * ((r & np.uint64(0xFFFFFFFF)) % n1[doc].astype(np.uint64)).astype(np.int64) + ((r >> np.uint64(32)) % np.uint64(3)).astype(np.int64)
    total = int(at[-1])
    sums, counts = _sums(cell, r, total).reshape(-1, 3), np.bincount(cell, minlength=total).reshape(-1, 3)
    part_doc = np.repeat(np.arange(len(n)), n1)
    part = np.arange(len(part_doc)) - np.repeat(at[:-1] // 3, n1)
    tag = mix(band[part_doc].astype(np.uint64) << np.uint64(32) | part.astype(np.uint64))
    out, filled = [], []
    for t, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        out.append(mix(sums[:, a] * np.uint64(0x9E3779B97F4A7C15) + sums[:, b] * np.uint64(0xC2B2AE3D27D4EB4F) + tag + np.uint64(t)))
        filled.append(counts[:, a] + counts[:, b] > 0)
    weak = np.bincount(part_doc, ~np.logical_and.reduce(filled), len(n))
    all_ = (weak > bands.x[band])[part_doc]
    chosen = [f | all_ for f in filled]
    return np.concatenate([o[c] for o, c in zip(out, chosen, strict=True)]), np.concatenate([part_doc[c] for c in chosen])


def steps(node: np.ndarray) -> bytes:
    """Sorted ids as differences, byte plane by byte plane: the high planes are zeros, which compress to nothing."""
    return np.diff(node.view(np.uint64), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unstepped(data: np.ndarray) -> np.ndarray:
    """The ids of ``steps``."""
    return np.cumsum(np.ascontiguousarray(data.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64).view(np.int64)


def _packed(k: int, bands: Bands, parts: int, reps):
    """Signatures of representatives in packed runs, one row for each partition and flush: four bytes a
    signature (by chance some 40 pairs of a partition of ROWS are equal, which the sketches tell apart)."""

    def flush(held):
        sig, node = (np.concatenate(x) for x in zip(*held, strict=True))
        p = (sig % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((node, p))
        sig, node = sig[order], node[order]
        at = np.searchsorted(p[order], np.arange(parts + 1))
        four = (sig // np.uint64(parts)).astype(np.uint32)
        rows = [i for i in range(parts) if at[i + 1] > at[i]]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([four[at[i] : at[i + 1]].tobytes() for i in rows], pa.binary()), pa.array([steps(node[at[i] : at[i + 1]]) for i in rows], pa.binary())], names=["p", "sig", "node"])

    @store.lean
    def run(it):
        table = reps.value
        mask = np.uint64(len(table) * 64 - 1)
        held, size = [], 0
        for b in it:
            place = b.column("place").to_numpy().view(np.uint64) & mask
            mine = np.flatnonzero((table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
            h, at = sets(b.column("text").take(pa.array(mine)), k)
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)[mine]
            for shift in (0, 1):
                sig, doc = signatures(h, np.diff(at), bands, shift)
                held.append((sig, ids[doc]))
                size += len(sig)
            if size >= ROWS:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    return run


@store.lean
def _buckets(it):
    """Rows (bucket, node, pivot) of signatures that two nodes or more share."""
    held: dict[int, list] = {}
    for b in it:
        for p, s, d in zip(b.column("p").to_pylist(), b.column("sig"), b.column("node"), strict=True):
            held.setdefault(p, []).append((np.frombuffer(s.as_buffer(), np.uint32), unstepped(np.frombuffer(d.as_buffer(), np.uint8))))
    for p in sorted(held):
        sig, node = (np.concatenate(x) for x in zip(*held.pop(p), strict=True))
        sig = sig.astype(np.int64)
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node = sig[fresh], node[fresh]
        first = np.ones(len(sig), bool)
        first[1:] = sig[1:] != sig[:-1]
        head = np.flatnonzero(first)
        run = np.cumsum(first) - 1
        more = np.diff(np.append(head, len(sig)))[run] > 1
        bucket = (sig << np.int64(20)) | np.int64(p)
        yield pa.RecordBatch.from_arrays([pa.array(bucket[more]), pa.array(node[more]), pa.array(node[head[run]][more])], names=["bucket", "node", "pivot"])


_PAIR = "a long, b long"


def _near(dist: np.ndarray, nx: np.ndarray, ny: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of these sizes that differ in ``dist`` elements can be similar enough."""
    return (np.minimum(nx, ny) * den >= np.maximum(nx, ny) * num) & (dist * (den + num) <= (nx + ny) * (den - num))


def _cross(num: int, den: int, most: int):
    """Over rows sorted by (bucket, i, j, side, component), one (bucket, i, j) whole at a time: of the pairs
    of different groups that the lower bound leaves, the ``most`` closest of each two groups; a row with
    ``again`` names a bucket of others. Within a block (i = j) all rows meet, else those of side 0 meet those of side 1."""

    def block(t: pa.Table):
        key = np.stack([t.column(c).to_numpy() for c in ("bucket", "i", "j")])
        node, group, n, side = (t.column(c).to_numpy() for c in ("node", "component", "n", "side"))
        sketch = Sketches(t.column("sketch").combine_chunks())
        head = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
        run = np.searchsorted(head, np.arange(len(node)), side="right") - 1
        stop = np.append(head[1:], len(node))[run]
        part = np.concatenate([[True], (run[1:] != run[:-1]) | (side[1:] != side[:-1]) | (group[1:] != group[:-1])])
        cuts = np.append(np.flatnonzero(part), len(node))
        begin = cuts[np.cumsum(part)]  # in a block a row meets those after its group
        other = np.append(head[1:], len(node)) - np.bincount(run, side == 1, len(head)).astype(np.int64)
        begin = np.where(key[1] == key[2], begin, np.where(side == 0, other[run], stop))
        count = stop - begin
        ends = np.cumsum(count)
        found, a = [], 0
        while a < len(node):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 1_000_000, side="right")))
            x = np.repeat(np.arange(a, b), count[a:b])
            y = np.arange(len(x)) - np.repeat(ends[a:b] - count[a:b] - (ends[a - 1] if a else 0), count[a:b]) + begin[x]
            keep = (group[x] != group[y]) & _near(np.zeros(len(x), np.int64), n[x], n[y], num, den)
            x, y = x[keep], y[keep]
            d = sketch.apart(x, y)
            keep = _near(d, n[x], n[y], num, den)
            found.append(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y]), np.minimum(group[x], group[y]), np.maximum(group[x], group[y]), key[0][x], d])[:, keep])
            a = b
        a, b, g, h, at, d = np.concatenate(found, 1)
        order = np.lexsort((b, a, d, h, g))
        a, b, g, h, at = a[order], b[order], g[order], h[order], at[order]
        once = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]
        a, b, g, h, at = a[once], b[once], g[once], h[once], at[once]
        fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])])[: len(a)]
        rank = np.arange(len(a)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        again = np.unique(at[rank >= most])
        a, b = a[rank < most], b[rank < most]
        none, rest = np.zeros(len(a), bool), np.ones(len(again), bool)
        column = lambda v, w: pa.array(np.concatenate([v, np.zeros(len(again), np.int64)]) if w else np.concatenate([np.zeros(len(a), np.int64), v]), mask=np.concatenate([none, rest] if w else [~none, ~rest]))
        return pa.RecordBatch.from_arrays([column(a, True), column(b, True), column(again, False)], names=["a", "b", "again"])

    @store.lean
    def run(it):
        held, rows = [], 0
        for b in it:
            held.append(b)
            rows += b.num_rows
            if rows >= 4 * BLOCK:
                t = pa.Table.from_batches(held).combine_chunks()
                last = np.flatnonzero(np.logical_or.reduce([t.column(c).to_numpy() != t.column(c)[-1].as_py() for c in ("bucket", "i", "j")]))
                whole = int(last[-1]) + 1 if len(last) else 0
                if whole:
                    yield block(t.slice(0, whole))
                held, rows = t.slice(whole).to_batches(), t.num_rows - whole
        if rows:
            yield block(pa.Table.from_batches(held))

    return run


def _plausible(pairs: DataFrame, profile: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sizes and sketches allow the similarity."""
    p = pairs.join(profile.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
    p = p.join(profile.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    p = p.where((F.least("na", "nb") * den >= F.greatest("na", "nb") * num))

    @store.lean
    def run(it):
        for b in it:
            m = b.num_rows
            if not m:
                continue
            d = Sketches(pa.concat_arrays([b.column("sa"), b.column("sb")])).apart(np.arange(m), np.arange(m) + m)
            ok = pa.array(_near(d, b.column("na").to_numpy(), b.column("nb").to_numpy(), num, den))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(ok) for c in ("a", "b")], names=["a", "b"])

    return p.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, _PAIR)


def _sets(k: int, wanted):
    @store.lean
    def run(it):
        table = wanted.value
        mask = np.uint64(len(table) * 64 - 1)
        for b in it:
            place = b.column("place").to_numpy().view(np.uint64) & mask
            mine = pa.array(np.flatnonzero((table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)))
            h, at = sets(b.column("text").take(mine), k)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(mine), pa.array([h[at[i] : at[i + 1]].tobytes() for i in range(len(mine))], pa.binary())], names=["node", "set"])

    return run


def _verified(num: int, den: int):
    """Streams rows sorted by (a, salt); the row with null b brings a's own set."""

    @store.lean
    def run(it):
        key = own = None
        for b in it:
            a, salt, other, data = b.column("a").to_pylist(), b.column("salt").to_pylist(), b.column("b").to_pylist(), b.column("set")
            out = []
            for i, (x, y) in enumerate(zip(a, other, strict=True)):
                s = np.frombuffer(data[i].as_buffer(), np.uint64)
                if y is None:
                    key, own = (x, salt[i]), s
                elif key == (x, salt[i]):
                    both = len(np.intersect1d(own, s, assume_unique=True))
                    if den * both >= num * (len(own) + len(s) - both):
                        out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], names=["a", "b"])

    return run


def _verify(pairs: DataFrame, rows: DataFrame, k: int, num: int, den: int, parts: int) -> DataFrame:
    """The pairs (a, b) that are similar, by whole sets, read only for documents in a pair. A set with many
    partners is copied, so that no more than about PARTNERS of them follow it."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = store.share(pairs.sparkSession, bit_table(nodes.select(F.xxhash64("node").alias("h")).distinct(), "h"))
    found = store.table(rows.mapInArrow(_sets(k, wanted), "node long, set binary").join(nodes, "node", "left_semi"), "sets")
    store.unshare(wanted)
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("salts"))
    own = found.join(many.withColumnRenamed("a", "node"), "node").select(F.col("node").alias("a"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "set")
    dealt = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b")
    other = dealt.join(found.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "set")
    both = own.union(other).repartition(parts, "a", "salt").sortWithinPartitions(F.col("a"), F.col("salt"), F.col("b").asc_nulls_first())
    out = store.table(both.mapInArrow(_verified(num, den), _PAIR), "links")
    store.drop(found)
    return out


def _mixed(buckets: DataFrame, groups: DataFrame, profile: DataFrame) -> DataFrame:
    """Rows of buckets that hold different groups, dealt to pairs of blocks of a bucket."""
    label = buckets.join(groups, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    label = label.withColumn("salt", store.salt("node"))
    mixed = label.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"), store.salts_used("salt").alias("used")).where("lo <> hi and size > 2")
    mixed = mixed.select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), F.explode(store.salts("used")).alias("salt"))
    rows = label.join(mixed, ["bucket", "salt"]).join(profile, "node")
    rows = rows.withColumn("own", F.pmod(F.hash("node"), F.col("blocks"))).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("bucket", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"), (F.col("own") > F.col("met")).cast("int").alias("side"), "component", "node", "n", "sketch")


def jaccard_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 5, similarity: tuple[int, int] = (80, 100), closest: int = 4) -> DataFrame:
    """One row per document row: doc_id, n_shingles, class_id (smallest id with the same set; null
    without words), component_id (smallest id reachable by links). ``closest`` pairs of two groups are
    verified in the first round, 16 times as many in each further one, over the buckets that still hold
    others, until none is left."""
    spark = docs.sparkSession
    store.batches(spark)
    num, den = similarity
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = store.table(d.mapInArrow(_profile(k), "doc_id long, n long, s1 long, s2 long, sketch binary"), "profiles")
    salted = base.withColumn("salt", store.salt("doc_id"))
    classes = salted.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), store.salts_used("salt").alias("used"))
    classes = store.table(classes, "classes")
    profile = classes.where("node is not null").select("node", "n", "sketch")
    largest, total = base.agg(F.max("n"), F.sum("n")).first()
    bands = Bands(num, den, largest or 1)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(0.9 * (total or 0) / ROWS))
    rows = d.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("place"))
    reps = store.share(spark, bit_table(profile.select(F.xxhash64("node").alias("h")).distinct(), "h"))
    packed = rows.mapInArrow(_packed(k, bands, parts, reps), "p int, sig binary, node binary")
    buckets = store.table(packed.repartition(parts, "p").mapInArrow(_buckets, "bucket long, node long, pivot long"), "buckets")
    store.unshare(reps)

    star = buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    tried = store.table(_plausible(star, profile, num, den), "pairs")
    links = _verify(tried, rows, k, num, den, parts)
    groups, open_ = components(links), buckets
    while open_ is not None:
        dealt = _mixed(open_, groups, profile).repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side", "component")
        cross = store.table(dealt.mapInArrow(_cross(num, den, closest), f"{_PAIR}, again long"), "cross")
        again = cross.where("again is not null").select(F.col("again").alias("bucket")).distinct()
        open_ = store.table(buckets.join(again, "bucket", "left_semi"), "buckets") if again.take(1) else None
        fresh = store.table(cross.where("again is null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        if fresh.take(1):
            more = _verify(fresh, rows, k, num, den, parts)
            links, tried = links.union(more), tried.union(fresh)
            groups = components(links) if more.take(1) else groups
        closest *= 16
    store.drop(buckets)
    named = classes.join(groups, "node", "left").select("s1", "s2", "node", "component", F.explode(store.salts("used")).alias("salt"))
    return (
        salted.join(named, ["s1", "s2", "salt"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("class_id"), F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
