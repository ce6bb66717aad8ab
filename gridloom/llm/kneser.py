"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

n-grams run over UTF-8 bytes, so one is an exact integer key: its context is the key shifted by a
byte, its lower-order gram the key masked. Counts, continuation counts, discounts (Chen & Goodman,
1998) and interpolated probabilities are DataFrame aggregates and joins by key. The finished model is
cut into shards by the last two context bytes, which hold all that any back-off path of a position
reads; each shard has a bounded number of entries, is broadcast on its own, and adds its positions'
part to every document's log probability; one shard at a time is on the driver. Thresholds are
quantiles, by language and length, over all trusted documents; a text's perplexity a byte varies more the
shorter it is, so the upper quantile is widened by the standard error of so few bytes.

Defined results: null or empty text has no perplexity and is not kept; null language is a language of
its own; where a class has fewer trusted texts than ``least``, the quantiles of the language hold, then
those of the length over all languages, then those of all trusted texts; with no trusted text nothing
is rejected but empty texts; repeated rows count each; an empty table gives no rows; other columns are
ignored unless kept by name, and may have any name.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .decontam import marked
from .langid import slabs
from .words import mix, raw

ORDER = 5
_EMPTY = np.int64(-1)


def codes(buf: np.ndarray, off: np.ndarray, i: int, j: int) -> np.ndarray:
    """The ORDER-byte key that ends at each byte of texts i..j; zero bytes stand before a text."""
    b = buf[off[i] : off[j]].astype(np.int64)
    at = np.arange(len(b)) - np.repeat(off[i:j] - off[i], np.diff(off[i : j + 1]))
    out = b.copy()
    for t in range(1, min(ORDER, len(b) + 1)):
        prev = np.zeros(len(b), np.int64)
        prev[t:] = b[: len(b) - t]
        prev[at < t] = 0
        out |= prev << np.int64(8 * t)
    return out


@store.lean
def _count(it):
    for b in it:
        buf, off = raw(b.column("text"))
        for i, j in slabs(off):
            u, n = np.unique(codes(buf, off, i, j), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64))], names=["g", "c"])


def _discounts(t: DataFrame) -> list[float]:
    n = [float(x or 0) for x in t.agg(*[F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4)]).first()]
    if min(n[:3]) == 0:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(k * 1.0 - 1e-3, max(1e-3, k - (k + 1) * y * n[k] / n[k - 1])) for k in (1, 2, 3)]


def train(texts: DataFrame) -> DataFrame:
    """Rows (n, kind, g, v) from column ``text``: for kind 0 the log10 probability of n-gram g, for
    kind 1 the log10 back-off weight of the context g of order-n grams."""
    counts = texts.select("text").mapInArrow(_count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
    order: dict[int, DataFrame] = {ORDER: store.table(counts, "grams")}
    for n in range(ORDER - 1, 0, -1):
        order[n] = store.table(order[n + 1].groupBy(F.col("g").bitwiseAND((1 << 8 * n) - 1).alias("g")).agg(F.count("*").alias("c")), "grams")
    lower = None
    parts = []
    for n in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(order[n])
        of = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        t = order[n].select("g", "c", of.alias("d"), F.shiftright("g", 8).alias("ctx"), F.col("g").bitwiseAND((1 << 8 * (n - 1)) - 1).alias("low"))
        ctx = t.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("off")).select("ctx", "total", (F.col("off") / F.col("total")).alias("gamma"))
        t = t.join(ctx, "ctx")
        below = F.lit(1 / 256) if lower is None else F.col("p_low")
        if lower is not None:
            t = t.join(lower.select(F.col("g").alias("low"), F.col("p").alias("p_low")), "low")
        lower = store.table(t.select("g", ((F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * below).alias("p")), "grams")
        parts.append(lower.select(F.lit(n).alias("n"), F.lit(0).alias("kind"), "g", F.log10("p").alias("v")))
        parts.append(ctx.select(F.lit(n).alias("n"), F.lit(1).alias("kind"), F.col("ctx").alias("g"), F.log10("gamma").alias("v")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return store.table(out, "model")


class Table:
    """Open-addressing map from non-negative int64 keys to float32, probed for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, 2 * len(keys))))))
        self.mask = np.int64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, _EMPTY), np.zeros(1 << bits, np.float32)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            s = slot[todo]
            free = self.keys[s] == _EMPTY
            _, first = np.unique(s[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[s[won]], self.values[s[won]] = keys[todo[won]], values[todo[won]]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo = todo[rest]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).view(np.int64) & self.mask

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether there is one."""
        s = self._slot(keys)
        k = self.keys[s]
        found = k == keys
        value = self.values[s]
        todo = np.flatnonzero(~found & (k != _EMPTY))
        while len(todo):
            s[todo] = (s[todo] + 1) & self.mask
            k = self.keys[s[todo]]
            hit = k == keys[todo]
            found[todo[hit]] = True
            value[todo[hit]] = self.values[s[todo[hit]]]
            todo = todo[~hit & (k != _EMPTY)]
        return value, found


class Shard:
    """One shard of a model: a table of each order's grams and of its contexts."""

    def __init__(self, rows: pa.Table, number: int, of: int):
        self.number, self.of = number, of
        n, kind, g, v = (rows.column(c).to_numpy() for c in ("n", "kind", "g", "v"))
        self.grams = [Table(g[(n == k) & (kind == 0)], v[(n == k) & (kind == 0)]) for k in range(1, ORDER + 1)]
        self.back = [Table(g[(n == k) & (kind == 1)], v[(n == k) & (kind == 1)]) for k in range(1, ORDER + 1)]

    def score(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each key's last byte; 0 where another shard has it."""
        out = np.zeros(len(code), np.float32)
        todo = np.arange(len(code)) if self.of == 1 else np.flatnonzero(shard_of((code >> 8) & 0xFFFF, self.of) == self.number)
        for n in range(ORDER, 0, -1):
            g = code[todo] & np.int64((1 << 8 * n) - 1)
            v, found = self.grams[n - 1].get(g)
            out[todo[found]] += v[found]
            todo, g = todo[~found], g[~found]
            if not len(todo):
                return out
            v, found = self.back[n - 1].get(g >> 8)
            out[todo[found]] += v[found]
        out[todo] += np.float32(np.log10(1 / 256))
        return out


def shard_of(pair: np.ndarray, of: int) -> np.ndarray:
    return (mix(pair.astype(np.uint64)) % np.uint64(of)).astype(np.int64)


def _shards(model: DataFrame, most: int):
    """Shards of at most about ``most`` entries; grams of one or two bytes are in each."""
    size = model.where("n > 2").count()
    of = max(1, -(-size // most))
    # the last two context bytes of an order-n gram are its second and third from the end; of a context its last two
    pair = F.when(F.col("kind") == 0, F.shiftright("g", 8)).otherwise(F.col("g")).bitwiseAND(0xFFFF)
    by_pair = {int(s): [] for s in range(of)}
    for p, s in enumerate(shard_of(np.arange(1 << 16), of).tolist() if of > 1 else []):
        by_pair[s].append(p)
    for s in range(of):
        mine = model if of == 1 else model.where((F.col("n") <= 2) | pair.isin(by_pair[s]))
        yield Shard(mine.toArrow(), s, of)


def _sum(shard):
    @store.lean
    def run(it):
        m = shard.value
        for b in it:
            buf, off = raw(b.column(b.num_columns - 1))
            total = np.zeros(len(off) - 1)
            for i, j in slabs(off):
                own = np.flatnonzero(np.diff(off[i : j + 1])) + i
                if len(own):
                    total[own] = np.add.reduceat(m.score(codes(buf, off, i, j)).astype(np.float64), off[own] - off[i])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.diff(off)), pa.array(total)], names=[*b.schema.names[:-1], "n_bytes", "log10_prob"])

    return run


def perplexities(docs: DataFrame, model: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", shard_entries: int = 1_500_000) -> DataFrame:
    """The kept columns with n_bytes, log10_prob and perplexity (a byte; null for empty texts). A model of
    more than one shard passes over numbered rows shard by shard, with one shard broadcast at a time."""
    spark = docs.sparkSession
    store.batches(spark)
    own, row = store.unused(docs, "_text"), store.unused(docs, "_row")
    d = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(own))
    shards = _shards(model, shard_entries)
    first = next(shards)
    if first.of == 1:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1])
        out = d.mapInArrow(_sum(store.share(spark, first)), f"{fields}, n_bytes long, log10_prob double")
    else:
        d = store.table(d.withColumn(row, F.monotonically_increasing_id()), "numbered")
        parts = None
        for s in chain([first], shards):
            shared = store.share(spark, s)
            part = store.table(d.select(row, own).mapInArrow(_sum(shared), f"`{row}` long, n_bytes long, log10_prob double"), "part")
            store.unshare(shared)
            parts = part if parts is None else parts.unionByName(part)
        total = parts.groupBy(row).agg(F.first("n_bytes").alias("n_bytes"), F.sum("log10_prob").alias("log10_prob"))
        out = d.drop(own).join(total, row).drop(row)
    return out.withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_bytes"))))


def _trusted(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts whose doc_id is among ``ids`` (distinct, not null). Bits of the ids leave some others, whose ids alone
    are looked up; only texts that share a bit with one of those are joined, so nearly all stay where they are."""
    place = F.xxhash64("doc_id")
    likely = marked(texts, ids.select(place.alias("id")).distinct(), place, "likely").where("likely").drop("likely")
    wrong = store.table(likely.select("doc_id").distinct().join(ids, "doc_id", "left_anti").select(place.alias("id")).distinct(), "wrong")
    split = marked(likely, wrong, place, "open")
    return split.where("not open").select("text").unionByName(split.where("open").join(ids, "doc_id").select("text"))


_RESULTS = ("n_bytes", "log10_prob", "perplexity", "low", "high", "kept")


def classify(docs: DataFrame, trusted: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", keep: tuple[str, ...] = (), upper: float = 0.999, lower: float = 0.0, slack: float = 1.05, deviation: float = 0.25, least: int = 100, bounds: tuple[int, ...] = (64, 512), shard_entries: int = 1_500_000) -> DataFrame:
    """``trusted`` has the ids of trusted documents in column doc_id. All of their texts train the
    model; the quantiles ``upper`` and ``lower`` of perplexity, widened by the
    factor ``slack``, cover all of them, by language and by length (``bounds`` cut the lengths in
    bytes), the upper one also by ten to the power of ``deviation`` by the root of the length. Returns
    doc_id, lang, the kept columns (but those named as a result), n_bytes, log10_prob, perplexity, low,
    high, kept."""
    spark = docs.sparkSession
    store.batches(spark)
    ids = trusted.select(F.col(doc_id).alias("doc_id")).where("doc_id is not null").distinct()
    ids = store.table(ids, "trusted")
    more = [c for c in keep if c not in ("doc_id", "lang", *_RESULTS)]
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), *[F.col(f"`{c}`").alias(f"more{i}") for i, c in enumerate(more)], F.col(text).alias("text"))
    texts = d.select("doc_id", "text")
    if texts.schema["doc_id"].dataType == ids.schema["doc_id"].dataType:
        model = train(_trusted(texts, ids))
    else:
        model = train(texts.join(ids, "doc_id", "left_semi").select("text"))
    names = tuple(d.columns[:-1])
    scored = store.settled(lambda: perplexities(d, model, keep=names, shard_entries=shard_entries).withColumn("size", sum((F.col("n_bytes") > b).cast("int") for b in bounds) + F.lit(0)), "perplexity")
    seen = scored.where("perplexity is not null").join(ids, "doc_id", "left_semi")
    q = [F.percentile_approx("perplexity", p, 100_000).alias(n) for p, n in ((lower, "low"), (upper, "high"))]
    out, lows, highs = scored, [], []
    for i, by in enumerate((("lang", "size"), ("lang",), ("size",))):
        at = seen.groupBy(*[F.col(c).alias(f"{c}_{i}") for c in by]).agg(F.count("*").alias("n"), *[x.alias(f"{n}_{i}") for x, n in zip(q, ("low", "high"), strict=True)]).where(F.col("n") >= least).drop("n")
        out = out.join(at, [F.col(c).eqNullSafe(F.col(f"{c}_{i}")) for c in by], "left")
        lows.append(f"low_{i}")
        highs.append(f"high_{i}")
    everywhere = seen.agg(*[x.alias(f"any_{n}") for x, n in zip(q, ("low", "high"), strict=True)])
    out = out.crossJoin(F.broadcast(everywhere))  # one row
    wide = F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), deviation / F.sqrt("n_bytes")))
    low, high = F.coalesce(*lows, "any_low", F.lit(0.0)) / slack, F.coalesce(*highs, "any_high", F.lit(float("inf"))) * slack * wide
    out = out.select("doc_id", "lang", *[F.col(f"more{i}").alias(c) for i, c in enumerate(more)], "n_bytes", "log10_prob", "perplexity", low.alias("low"), high.alias("high"))
    return out.withColumn("kept", F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(False)))


def trusted_ids(spark, sf_dir: str) -> DataFrame:
    """Documents labelled as good."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, trusted_ids(spark, sf_dir))
