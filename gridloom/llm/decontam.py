"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is cut into windows of consecutive words; the set of a window is its word shingles.
Shingles are ordered by rarity over the whole corpus. For containment t of a window with S shingles
at least r = ceil(t S) must occur, so one of its S - r + 1 rarest does: only these prefix tokens are
joined. A document's shingles first pass a bit table of the prefix tokens (its size is fixed, not the
benchmark's), then the join; the token's position in the window fixes where the window would start
in the document, which gives the length and positional bounds, and the item-sized stretch of the
document is compared word by word, as 64-bit hashes of the words.

Defined results: null text has no words; documents and items without words match nothing; items
shorter than a window are one window; repeated rows and items are each kept and an item id is
counted once; empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .words import ALNUM, Words, sequence_hash, shingles, split

_MOST_BITS = 27


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _windows(window: int, k: int):
    schema = pa.schema([("item_id", pa.string()), ("window_id", pa.int64()), ("words", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])

    @store.lean
    def run(it):
        for b in it:
            w = split(b.column("text"), ALNUM)
            h = w.hashes()
            rows: list[list] = [[], [], [], []]
            for i, item in enumerate(b.column("item_id").to_pylist()):
                own = h[w.at[i] : w.at[i + 1]]
                n = min(window, len(own))
                for a in range(len(own) - n + 1 if n else 0):
                    part = own[a : a + n]
                    for col, v in zip(rows, (item, int(_signed(sequence_hash(part).reshape(1))[0]), _signed(part), _signed(shingles(part, min(k, n)))), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema)

    return run


def bit_table(keys: DataFrame, col: str, spare: int = 10) -> np.ndarray:
    """Bits set at the hashes in ``col`` (distinct longs), about 2^``spare`` for each of them; at most 16 MB,
    whatever their number."""
    n = max(1, keys.count())
    bits = min(_MOST_BITS, max(16, math.ceil(math.log2(n)) + spare))
    place = F.col(col).bitwiseAND((1 << bits) - 1)
    rows = keys.select(F.shiftright(place, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return table


def marked(docs: DataFrame, ids: DataFrame, place: Column, mark: str) -> DataFrame:
    """``docs`` with a column ``mark``, false where ``place`` (a long) is surely not among ``ids`` (one column of
    distinct longs), by a broadcast row of bits of at most 16 MB."""
    name = store.unused(docs, "_bits")
    table = bit_table(ids, ids.columns[0], spare=6)
    bits = docs.sparkSession.createDataFrame(pa.table({name: pa.array([table.view(np.int64)], pa.list_(pa.int64()))}))
    at = place.bitwiseAND(len(table) * 64 - 1)
    word = F.get(F.col(name), F.shiftright(at, 6).cast("int"))
    hit = F.call_function("shiftright", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1
    return docs.crossJoin(F.broadcast(bits)).withColumn(mark, hit).drop(name)  # one row


def _found(w: Words, h: np.ndarray, sizes: list[int], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, word position and hash of the shingles whose bit is set."""
    text, mask = w.text_of(), np.uint64(len(table) * 64 - 1)
    parts = []
    for k in sizes:
        s = shingles(h, k)
        place = s & mask
        at = np.flatnonzero((table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))
        at = at[text[at] == text[at + k - 1]]
        parts.append((text[at], at, s[at]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _count(sizes: list[int], table):
    @store.lean
    def run(it):
        for b in it:
            w = split(b.column("text"), ALNUM)
            u, n = np.unique(_found(w, w.hashes(), sizes, table.value)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(u)), pa.array(n.astype(np.int64))], names=["token", "n"])

    return run


_PROBED = "doc_id long, text_key long, n_words long, found array<struct<pos:int,token:long,lead:int,near:array<long>>>"


def _probe(sizes: list[int], window: int, table):
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("token", pa.int64()), ("lead", pa.int32()), ("near", pa.list_(pa.int64()))]))

    @store.lean
    def run(it):
        for b in it:
            w = split(b.column("text"), ALNUM)
            h = w.hashes()
            text, at, s = _found(w, h, sizes, table.value)
            order = np.argsort(text, kind="stable")
            text, at, s = text[order], at[order], s[order]
            lo = np.maximum(at - window + 1, w.at[text])
            hi = np.minimum(at + window, w.at[text + 1])
            near_at = np.zeros(len(at) + 1, np.int32)
            np.cumsum(hi - lo, out=near_at[1:])
            flat = np.arange(near_at[-1]) + np.repeat(lo - near_at[:-1], hi - lo)
            near = pa.ListArray.from_arrays(pa.array(near_at), pa.array(_signed(h)[flat]))
            rows = pa.StructArray.from_arrays([pa.array((at - w.at[text]).astype(np.int32)), pa.array(_signed(s)), pa.array((at - lo).astype(np.int32)), near], fields=list(kind.value_type))
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(w.n + 1)).astype(np.int32)), rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(w.count.astype(np.int64)), found], names=["doc_id", "text_key", "n_words", "found"])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 3, containment: float = 1.0) -> DataFrame:
    """One row per document row: doc_id, text_key, n_words, n_hit (words in hit windows), items (ids
    as strings, sorted), spans (start, length in words, of hit windows)."""
    spark = docs.sparkSession
    store.batches(spark)
    wins = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text")).mapInArrow(_windows(window, k), "item_id string, window_id long, words array<long>, tokens array<long>")
    wins = store.table(wins, "windows")
    sizes = sorted(r[0] for r in wins.select(F.least(F.size("words"), F.lit(k))).distinct().collect())
    tokens = wins.select(F.explode("tokens").alias("token")).distinct()
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), store.text_key(text).alias("text_key"), F.col(text).alias("text"))

    table = store.share(spark, bit_table(tokens, "token"))
    seen = d.select("text").mapInArrow(_count(sizes, table), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rare = tokens.join(seen, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    whole = wins.groupBy("window_id", "words").agg(F.first("tokens").alias("tokens"))
    by = whole.select("window_id", "words", F.size("tokens").alias("S"), F.posexplode("tokens").alias("off", "token")).join(rare, "token")
    ranked = by.groupBy("window_id", "words", "S").agg(F.sort_array(F.collect_list(F.struct("n", "token", "off"))).alias("r"))
    need = F.ceil(F.lit(containment) * F.col("S") - 1e-9)
    prefix = ranked.select("window_id", "words", "S", F.explode(F.slice("r", 1, F.greatest(F.lit(1), (F.col("S") - need + 1).cast("int")))).alias("r")).select("window_id", "words", "S", F.col("r.token").alias("token"), F.col("r.off").alias("off"))
    prefix = store.table(prefix, "prefix")
    store.unshare(table)

    table = store.share(spark, bit_table(prefix.select("token").distinct(), "token"))
    probed = store.table(d.mapInArrow(_probe(sizes, window, table), _PROBED), "probed")
    store.unshare(table)
    found = probed.where(F.size("found") > 0).select("doc_id", "text_key", "n_words", F.explode("found").alias("f")).select("doc_id", "text_key", "n_words", "f.*")
    start, length = F.col("pos") - F.col("off"), F.size("words")
    inside = (length <= F.col("n_words")) & (start >= 0) & (start + length <= F.col("n_words"))
    first = F.greatest(F.col("lead") - F.col("off") + 1, F.lit(1))
    piece = F.slice("near", first, length)
    hits = found.join(prefix, "token").where(inside & _enough(piece, containment, k)).select("doc_id", "text_key", "window_id", start.alias("start"), length.alias("length")).distinct()
    hits = store.table(hits, "hits")
    spans = hits.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    names = hits.select("doc_id", "text_key", "window_id").distinct().join(wins.select("window_id", "item_id").distinct(), "window_id").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    step = lambda a, s: F.struct(F.greatest(a["end"], s["start"] + s["length"]).alias("end"), (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("n"))
    both = spans.alias("s").join(names.alias("i"), F.col("s.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("s.text_key") == F.col("i.text_key")), "left").select("s.doc_id", "s.text_key", "spans", F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step)["n"].cast("long").alias("n_hit"), "items")
    return (
        probed.alias("p").join(both.alias("b"), F.col("p.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("p.text_key") == F.col("b.text_key")), "left")
        .select("p.doc_id", "p.text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"))
    )


def _enough(piece: Column, containment: float, k: int) -> Column:
    if containment >= 1:
        return piece == F.col("words")
    size = F.least(F.lit(k), F.size("words"))
    same = F.filter(F.sequence(F.lit(1), F.size("words") - size + 1), lambda j: F.slice(piece, j, size) == F.slice("words", j, size))
    return F.size(same) >= F.ceil(F.lit(containment) * F.col("S") - 1e-9)


def query(spark, sf_dir: str) -> DataFrame:
    r = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bl AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
dw AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), h AS (SELECT rid, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
