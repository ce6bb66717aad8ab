"""Near-duplicate vectors by sorted projection passes.

Each pass orders all vectors lexicographically by a fresh random hash, the signs of random projections
(Charikar, "Similarity Estimation Techniques from Rounding Algorithms", STOC 2002) joined into one word, and
compares each vector with those that follow it within a window; verified pairs of all passes are united.
A vector's place in the order is its rank over the whole table, so windows cross the borders of partitions:
ranks are cut into tiles of ``window`` rows, and a tile meets itself and the one before. Passes follow the
row count (``passes_for``): a pair at the threshold's cosine stands within the window of some pass with
probability ``recall``, a closer pair with more; up to ``window`` vectors are one tile, so all pairs.
Passes run in rounds, so that the shuffle of one round at a time is on disk.

Equal vectors become one class first. What travels is an 8-bit sketch with the exact norm of its
residual: it bounds the cosine from both sides, and only pairs whose bounds leave the threshold open are
compared on their own vectors in double precision. Precision is exact. The passes only settle the
components; ``n_links`` is then counted on all pairs of vectors of a component, in double precision.

Defined results: null, empty or zero vectors and those with null or non-finite components are linked with
nothing; vectors of different lengths are never linked, those of one length among themselves; rows without
id and repeated rows are vectors of their own, the former with a null component; rows that share an id are
vectors of that id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store
from .components import components

_HEAD = 8  # bytes of scale and residual norm before the components of a sketch
_SLOP = 2e-5  # float32 rounding of a dot product of unit vectors
_ROUND = 4  # passes on disk at a time
_BITS = 62  # signs in the hash of a pass
_STRIP = 256  # rows of a block product


def passes_for(n: int, least: float, recall: float, window: int) -> int:
    """Passes for n vectors: two vectors that share as many leading bits as leave half a window of unrelated
    vectors between them stand within the window."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / window)) + 1) if n > window else 0
    same = (1 - math.acos(min(1.0, max(-1.0, least))) / math.pi) ** bits
    return 1 if same == 1 or same <= 0 else math.ceil(math.log(1 - recall) / math.log(1 - same))


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as float64 rows and which of them are usable."""
    n = len(column)
    out = np.zeros((n, dim))
    sizes = np.diff(column.offsets.to_numpy()) if n else np.zeros(0, np.int64)
    ok = (sizes == dim) & ~column.is_null().to_numpy(zero_copy_only=False)
    if ok.any():
        start = column.offsets.to_numpy()[:-1][ok]
        values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
        out[ok] = values[start[:, None] + np.arange(dim)]
    ok &= np.isfinite(out).all(1) & (out != 0).any(1)
    out[~ok] = 0
    return out, ok


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to norm 1, safe for very large and very small components."""
    top = np.abs(x).max(1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    n = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(n > 0, n, 1)


def sketches(u: np.ndarray) -> np.ndarray:
    """Per row float32 scale, float32 norm of the residual (rounded up), int8 components."""
    scale = (np.abs(u).max(1) / 127).astype(np.float32)
    q = np.rint(u / np.where(scale > 0, scale, 1)[:, None].astype(np.float64)).clip(-127, 127).astype(np.int8)
    rest = np.linalg.norm(u - q * scale[:, None].astype(np.float64), axis=1)
    head = np.stack([scale, np.nextafter(rest.astype(np.float32), np.float32(np.inf))], 1)
    return np.hstack([head.view(np.uint8), q.view(np.uint8)])


def restored(packed: list | pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(packed.to_pylist() if isinstance(packed, pa.Array) else packed), np.uint8).reshape(-1, _HEAD + dim)
    head = np.ascontiguousarray(raw[:, :_HEAD]).view(np.float32)
    return np.ascontiguousarray(raw[:, _HEAD:]).view(np.int8).astype(np.float32) * head[:, :1], head[:, 1].astype(np.float64)


def _sketch(dim: int):
    def run(it):
        for b in it:
            x, ok = matrix(b.column("v"), dim)
            s = sketches(unit(x))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([s[i].tobytes() if ok[i] else None for i in range(len(s))], pa.binary()), pa.array([x[i].tobytes() if ok[i] else None for i in range(len(s))], pa.binary())], names=["key", "sketch", "raw"])

    return run


def _codes(dim: int, passes: range, seed: int):
    """Rows of each pass with its hash: 62 signs of projections."""

    def run(it):
        planes = [np.random.default_rng([seed, p]).standard_normal((dim, _BITS)).astype(np.float32) for p in passes]
        weight = np.int64(1) << np.arange(_BITS - 1, -1, -1, dtype=np.int64)
        for b in it:
            if not b.num_rows:
                continue
            x, _ = restored(b.column("sketch"), dim)
            for p, plane in zip(passes, planes, strict=True):
                code = (x @ plane > 0).astype(np.int64) @ weight
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), pa.array(code), b.column("node"), b.column("sketch")], names=["pass", "code", "node", "data"])

    return run


def _placed(it):
    """Rows with their partition and place in it."""
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), {}
    for b in it:
        p = b.column("pass").to_numpy()
        place = np.empty(len(p), np.int64)
        for k in np.unique(p).tolist():
            mine = np.flatnonzero(p == k)
            place[mine] = at.get(k, 0) + np.arange(len(mine))
            at[k] = at.get(k, 0) + len(mine)
        yield pa.RecordBatch.from_arrays([b.column("pass"), pa.array(np.full(len(p), part, np.int32)), pa.array(place), b.column("node"), b.column("data")], names=["pass", "part", "place", "node", "data"])


def _windows(solve):
    """Over rows sorted by (pass, tile, own): pairs that ``solve`` finds among the rows of a tile and between
    them and those of the tile before (own = 0)."""

    def close(own, ids, data):
        i = np.concatenate(ids)
        before = int((np.concatenate(own) == 0).sum())
        mine, other = np.stack([i[before:], i[before:]], 1), np.stack([i[:before], i[:before]], 1)
        if len(mine) > 1:
            yield from solve(mine, data[before:], mine, data[before:], True)
        if before and len(mine):
            yield from solve(other, data[:before], mine, data[before:], False)

    def run(it):
        key, held, found = None, ([], [], []), []
        for b in it:
            if not b.num_rows:
                continue
            k = np.stack([b.column("pass").to_numpy(), b.column("tile").to_numpy()])
            cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
            own, ids, data = b.column("own").to_numpy(), b.column("node").to_numpy(), b.column("data").to_pylist()
            for i, z in zip(cuts[:-1], cuts[1:], strict=True):
                if key != (int(k[0, i]), int(k[1, i])):
                    if held[0]:
                        found.extend(close(*held))
                    key, held = (int(k[0, i]), int(k[1, i])), ([], [], [])
                held[0].append(own[i:z])
                held[1].append(ids[i:z])
                held[2].extend(data[i:z])
            if sum(len(f[0]) for f in found) > 100_000:
                yield _found(*(np.concatenate(c) for c in zip(*found, strict=True)))
                found = []
        if held[0]:
            found.extend(close(*held))
        if found:
            yield _found(*(np.concatenate(c) for c in zip(*found, strict=True)))

    return run


def _passes(classes: DataFrame, dim: int, window: int, passes: range, least: float, seed: int) -> DataFrame:
    """Pairs (a, b, sure) that the windows of these passes hold."""
    spark = classes.sparkSession
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    coded = classes.select("node", "sketch").mapInArrow(_codes(dim, passes, seed), "pass int, code long, node long, data binary")
    ordered = coded.repartitionByRange(parts, "pass", "code", "node").sortWithinPartitions("pass", "code", "node")
    placed = store.table(ordered.mapInArrow(_placed, "pass int, part int, place long, node long, data binary"), "order")
    counts = placed.groupBy("pass", "part").agg(F.count("*").alias("n"))  # a row for each partition and pass
    before = counts.select("pass", "part", (F.sum("n").over(Window.partitionBy("pass").orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("pass")).alias("all"))
    ranked = placed.join(F.broadcast(before), ["pass", "part"]).withColumn("own_tile", F.floor((F.col("before") + F.col("place")) / window))
    last = F.floor((F.col("all") - 1) / window)
    at = F.array(F.struct(F.col("own_tile").alias("tile"), F.lit(1).alias("own")), F.struct((F.col("own_tile") + 1).alias("tile"), F.lit(0).alias("own")))
    tiles = ranked.withColumn("at", F.explode(F.filter(at, lambda x: x["tile"] <= last))).select("pass", "at.tile", "at.own", "node", "data")
    tiles = tiles.repartition(parts, "pass", "tile").sortWithinPartitions("pass", "tile", "own")
    return store.table(tiles.mapInArrow(_windows(_pairs(dim, least)), "a long, b long, sure boolean"), "pairs")


def _found(a: np.ndarray, b: np.ndarray, sure: np.ndarray) -> pa.RecordBatch:
    cols = [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(sure.astype(bool))]
    return pa.RecordBatch.from_arrays(cols, names=["a", "b", "sure"])


_TILED = "a long, b long, component long, tile int, ids binary, data binary"
_NAMES = ["a", "b", "component", "tile", "ids", "data"]


def _tiles(solve):
    """Over rows (component, tile, tiles, node, n, data) sorted by component and tile: what ``solve`` finds in
    components of one tile, and the packed tiles of larger ones."""

    def close(key, tiles, ids, data):
        i = np.concatenate(ids)
        if tiles == 1:
            for a, b in solve(i, data, i, data, True):
                yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), *(pa.nulls(len(a), t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=_NAMES)
        else:
            cols = zip([[None], [None], [key[0]], [key[1]], [i.tobytes()], [b"".join(data)]], (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols], names=_NAMES)

    def run(it):
        key, tiles, ids, data = None, 0, [], []
        for b in it:
            if not b.num_rows:
                continue
            k = np.stack([b.column("component").to_numpy(), b.column("tile").to_numpy()])
            cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
            own = np.stack([b.column("node").to_numpy(), b.column("n").to_numpy()], 1)
            raw, of = b.column("data").to_pylist(), b.column("tiles").to_numpy()
            for i, z in zip(cuts[:-1], cuts[1:], strict=True):
                if key != (int(k[0, i]), int(k[1, i])):
                    if key:
                        yield from close(key, tiles, ids, data)
                    key, tiles, ids, data = (int(k[0, i]), int(k[1, i])), int(of[i]), [], []
                ids.append(own[i:z])
                data.extend(raw[i:z])
        if key:
            yield from close(key, tiles, ids, data)

    return run


def _crossed(solve, width: int):
    """What ``solve`` finds in pairs of tiles."""

    def run(it):
        for b in it:
            for r in b.to_pylist():
                i, j = (np.frombuffer(r[c], np.int64).reshape(-1, 2) for c in ("ids", "ids2"))
                x, y = ([r[c][o : o + width] for o in range(0, len(r[c]), width)] for c in ("data", "data2"))
                for a, n in solve(i, x, j, y, r["tile"] == r["tile2"]):
                    yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(n.astype(np.int64))], names=["a", "b"])

    return run


def _tile_rows(dim: int) -> int:
    return max(_STRIP, min(4096, 1_000_000 // (8 * dim)))


def _all_pairs(rows: DataFrame, solve, width: int) -> DataFrame:
    """``solve`` over all pairs of rows of a component, tile by tile."""
    spark = rows.sparkSession
    parts = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartition(parts, "component", "tile").sortWithinPartitions("component", "tile")
    mixed = store.table(ordered.mapInArrow(_tiles(solve), _TILED), "counts")
    found, large = mixed.where("tile is null").select("a", "b"), mixed.where("tile is not null").drop("a", "b")
    groups = large.groupBy("component").agg(F.ceil(F.count("*") / 8).cast("int").alias("salts"))
    dealt = large.join(groups, "component")
    left = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    right = dealt.select("component", (F.col("tile") % F.col("salts")).alias("salt"), F.col("tile").alias("tile2"), F.col("ids").alias("ids2"), F.col("data").alias("data2"))
    both = left.join(right, ["component", "salt"]).where("tile <= tile2").select("tile", "tile2", "ids", "ids2", "data", "data2")
    if large.limit(1).count():
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = spark.conf.get(key)
        spark.conf.set(key, 16)  # a row is two tiles
        try:
            found = found.union(store.table(both.mapInArrow(_crossed(solve, width), "a long, b long"), "counts"))
        finally:
            spark.conf.set(key, before)
    return found


def _united(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``group`` (per node a node of its group, never a later one) after the edges (a, b)."""
    while len(a):
        x, y = group[a], group[b]
        group = group.copy()
        np.minimum.at(group, np.maximum(x, y), np.minimum(x, y))
        while (group[group] != group).any():
            group = group[group]
        apart = group[a] != group[b]
        a, b = a[apart], b[apart]
    return group


def _pairs(dim: int, least: float):
    """Edges that connect what sure pairs connect, and the open pairs between what they do not."""

    def run(i, x, j, y, same):
        (u, r), (v, s) = restored(x, dim), restored(y, dim)
        slack = r.max() + s.max() + 3 * r.max() * s.max() + 2 * _SLOP
        at = 0 if same else len(u)
        ids = i[:, 0] if same else np.concatenate([i[:, 0], j[:, 0]])
        group, left = np.arange(len(ids)), []
        for p in range(0, len(u), _STRIP):
            q = p if same else 0
            est = u[p : p + _STRIP] @ v[q:].T
            k, m = np.nonzero(est >= least - slack)
            est, k, m = est[k, m].astype(np.float64), k + p, m + q
            e = r[k] * (1 + s[m]) + s[m] * (1 + r[k]) + r[k] * s[m] + _SLOP
            keep = (est + e >= least) & ((k < m) | (not same))
            sure, k, m = (est - e)[keep] >= least, k[keep], m[keep] + at
            if sure.any():
                group = _united(group, k[sure], m[sure])
            if not sure.all():
                left.append(np.stack([k[~sure], m[~sure]]))
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, group, ids)
        star = low[group] != ids
        yield low[group][star], ids[star], np.ones(star.sum(), bool)
        for k, m in left:
            apart = group[k] != group[m]
            a, b = ids[k[apart]], ids[m[apart]]
            yield np.minimum(a, b), np.maximum(a, b), np.zeros(len(a), bool)

    return run


def _counts(dim: int, least: float):
    """Per vector the number of vectors linked to it."""

    def run(i, x, j, y, same):
        u, v = (unit(np.frombuffer(b"".join(c), np.float64).reshape(-1, dim)) for c in (x, y))
        mine, other = np.zeros(len(u), np.int64), np.zeros(len(v), np.int64)
        for p in range(0, len(u), _STRIP):
            near = u[p : p + _STRIP] @ v.T >= least
            if same:
                near[np.arange(len(near)), np.arange(p, p + len(near))] = False
            mine[p : p + _STRIP] = near @ j[:, 1]
            other += i[p : p + _STRIP, 1] @ near
        yield i[:, 0], mine
        if not same:
            yield j[:, 0], other

    return run


def _exact(dim: int, least: float):
    def run(it):
        for b in it:
            x, y = (unit(np.frombuffer(b"".join(b.column(c).to_pylist()), np.float64).reshape(-1, dim)) for c in ("x", "y"))
            keep = pa.array((x * y).sum(1) >= least)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return run


def _own(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The vector of each class, taken from the row of its first key."""
    c = classes.select("node", F.col("first").alias("key"), "h1", "h2")
    return rows.where("raw is not null").withColumns({"h1": F.xxhash64("raw"), "h2": F.hash("raw")}).join(c, ["key", "h1", "h2"]).groupBy("node").agg(F.min("raw").alias("raw"))


def _linked(v: DataFrame, dim: int, least: float, recall: float, window: int, seed: int) -> DataFrame:
    """Rows (key, more, component) of the vectors of one length: class by class, how many others a vector of it is
    linked to, and the smallest key it reaches. ``key`` is the id, or null."""
    rows = v.mapInArrow(_sketch(dim), "key long, sketch binary, raw binary")
    keyed = rows.select("key", "sketch", F.xxhash64("raw").alias("h1"), F.hash("raw").alias("h2"))
    members = store.table(keyed.groupBy("h1", "h2", "sketch", "key").agg(F.count("*").alias("k")), "members")
    usable = members.where("sketch is not null").withColumn("salt", store.salt("key"))
    classes = usable.groupBy("h1", "h2", "sketch").agg(F.min("key").alias("first"), F.sum("k").alias("n"), store.salts_used("salt").alias("used"))
    classes = store.table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    passes = passes_for(classes.count(), least, recall, window)
    found = None
    for p in range(0, passes, _ROUND):
        some = _passes(classes, dim, window, range(p, min(passes, p + _ROUND)), least, seed)
        found = some if found is None else found.union(some)
    found = store.table(found.groupBy("a", "b").agg(F.max("sure").alias("sure")), "pairs")
    open_ = found.where("not sure").select("a", "b")
    wanted = open_.select(F.col("a").alias("node")).union(open_.select(F.col("b").alias("node"))).distinct()
    own = store.table(_own(rows, classes.join(wanted, "node")), "vectors")
    both = open_.join(own.select(F.col("node").alias("a"), F.col("raw").alias("x")), "a").join(own.select(F.col("node").alias("b"), F.col("raw").alias("y")), "b")
    links = store.table(found.where("sure").select("a", "b").union(both.select("a", "b", "x", "y").mapInArrow(_exact(dim, least), "a long, b long")), "links")

    grouped = classes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    grouped = grouped.withColumn("by", store.salt("node"))
    whole = grouped.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("size"), store.salts_used("by").alias("used_by"))
    whole = whole.withColumn("by", F.explode(store.salts("used_by"))).drop("used_by")
    grouped = store.table(grouped.join(whole, ["component", "by"]).drop("by"), "groups")
    several = grouped.where("size > 1")
    tiles = F.ceil(F.col("size") / _tile_rows(dim)).cast("int")
    inside = several.join(_own(rows, several), "node").select("component", tiles.alias("tiles"), F.pmod(F.hash("node"), tiles).alias("tile"), "node", "n", F.col("raw").alias("data"))
    more = _all_pairs(inside, _counts(dim, least), 8 * dim).groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("more"))
    about = grouped.join(more, "node", "left").select("h1", "h2", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id", F.explode(store.salts("used")).alias("salt"))
    # copies of one vector may be a third of all rows: both sides of the join are salted
    out = usable.join(about, ["h1", "h2", "salt"]).select("key", "k", "n_links", "component_id")
    return out.unionByName(members.where("sketch is null").select("key", "k", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id")))


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9, recall: float = 0.99, window: int = 1024, seed: int = 5) -> DataFrame:
    """One row per row: vec_id, n_links, component_id."""
    spark = vectors.sparkSession
    store.batches(spark, 4000)
    v = vectors.select(F.col(vec_id).cast("long").alias("key"), F.col(embedding).cast("array<double>").alias("v"))
    lengths = [r[0] for r in v.where("size(v) > 0").select(F.size("v")).distinct().collect()]
    out = v.where("v is null or size(v) = 0").select(F.col("key").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    for dim in sorted(lengths):
        own = v if len(lengths) == 1 else v.where(F.size("v") == dim)
        own = own.where("size(v) > 0")
        some = _linked(own, dim, least, recall, window, seed).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k"))))
        out = out.unionByName(some.select(F.col("key").alias("vec_id"), "n_links", "component_id"))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    r = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return r.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
