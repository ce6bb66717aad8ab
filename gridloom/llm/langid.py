"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

n-grams run over the UTF-8 bytes of the text (A-Z folded), are hashed to a fixed number of features
and weighted by term frequency times inverse document frequency; document frequencies cover all
rows to learn from. Weights are trained with follow-the-regularised-leader (McMahan et al., 2013)
under an elastic-net penalty on all rows to learn from: each task learns from its own, in runs of bounded
size, and the tasks' weights are averaged feature by feature, weighted by the squared gradients seen
(Agarwal et al., 2014), so one task gives its own weights. From ``FEW`` rows up a fifth is held back, all
of which fit the softmax temperature. The driver gets the weights and one row of sums. The weights depend on
how rows lie in partitions, not on which rows are read.

Defined results: null text or a text without letters is ``und`` with score 0; so is every text where
nothing could be learnt; null languages are not learnt; repeated rows count each; an empty table
gives no rows; ids may be of any type and null; other columns are ignored unless kept by name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .words import LOWER, raw

BITS = 16
ORDERS = (3, 4)
_SLAB = 1 << 20
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # features x languages, IDF included; a last row of zeros
    bias: np.ndarray
    temperature: float


def slabs(off: np.ndarray):
    """Runs (i, j) of texts of about _SLAB bytes."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + _SLAB, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def grams(buf: np.ndarray, off: np.ndarray, i: int, j: int) -> list[np.ndarray]:
    """Feature at each byte of texts i..j, one array for each order; where an n-gram would leave its
    text the feature is one past the last."""
    b = LOWER[buf[off[i] : off[j]]].astype(np.uint32)
    left = np.repeat(off[i + 1 : j + 1], np.diff(off[i : j + 1])) - np.arange(off[i], off[j])
    out = []
    for place, k in enumerate(ORDERS):
        code = np.zeros(len(b), np.uint32)
        for t in range(k):
            code[: max(0, len(b) - t)] |= b[t:] << np.uint32(8 * t)
        h = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64) + (place << BITS)
        h[left < k] = len(ORDERS) << BITS
        out.append(h)
    return out


def _size() -> int:
    return len(ORDERS) << BITS


@store.lean
def _frequencies(it):
    df = np.zeros(_size() + 1, np.int64)
    n = 0
    for batch in it:
        buf, off = raw(batch.column("text"))
        n += len(off) - 1
        for i, j in slabs(off):
            text = np.repeat(np.arange(j - i), np.diff(off[i : j + 1])) * np.int64(_size() + 1)
            for g in grams(buf, off, i, j):
                df += np.bincount(np.unique(text + g) % (_size() + 1), minlength=_size() + 1)
    df[-1] = n
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at])], names=["feature", "n"])


def _vectors(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and term frequencies of each text."""
    buf, off = raw(texts)
    out = []
    for i in range(len(off) - 1):
        g = np.concatenate(grams(buf, off, i, i + 1)) if off[i + 1] > off[i] else np.zeros(0, np.int64)
        u, c = np.unique(g[g < _size()], return_counts=True)
        out.append((u.astype(np.int32), (c / max(1, c.sum())).astype(np.float32)))
    return out


class Ftrl:
    """FTRL-proximal on rows (features, values, class); the last weight row is the bias."""

    def __init__(self, n_langs: int, scale: float, alpha: float = 0.3, beta: float = 0.1, l1: float = 0.02, l2: float = 0.02, seed: int = 7):
        self.z, self.n = np.zeros((_size() + 1, n_langs)), np.zeros((_size() + 1, n_langs))
        self.scale, self.alpha, self.beta, self.l1, self.l2 = scale, alpha, beta, l1, l2
        self.rng = np.random.default_rng(seed)

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 3) -> None:
        z, n = self.z, self.n
        for _ in range(epochs):
            for r in self.rng.permutation(len(rows)):
                u, x, y = rows[r]
                u, x = np.append(u, _size()), np.append(x * self.scale, 1.0)
                zu, nu = z[u], n[u]
                w = self.weights(zu, nu)
                s = x @ w
                p = np.exp(s - s.max())
                p /= p.sum()
                p[y] -= 1
                g = x[:, None] * p
                n2 = nu + g * g
                z[u] = zu + g - (np.sqrt(n2) - np.sqrt(nu)) / self.alpha * w
                n[u] = n2


_SLICES = 16
_PART = "slice int, top binary, under binary"


def _learn(langs: list[str], idf: np.ndarray, scale: float, run_rows: int, run_bytes: int):
    """Each task's weights times their squared gradients, and these, in slices of features."""

    @store.lean
    def run(it):
        place = {v: i for i, v in enumerate(langs)}
        model, held, size = Ftrl(len(langs), scale), [], 0
        for b in it:
            rows = _vectors(b.column("text"))
            cut = np.cumsum([len(u) for u, _ in rows], dtype=np.int64)
            u, x = (np.concatenate(v) for v in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int32), np.zeros(0, np.float32))
            x *= idf[u].astype(np.float32)
            for i, j, v in zip((cut - np.array([len(f) for f, _ in rows], np.int64)).tolist(), cut.tolist(), b.column("lang").to_pylist(), strict=True):
                held.append((u[i:j], x[i:j], place[v]))  # views of one block a batch
                size += 8 * (j - i)
                if len(held) >= run_rows or size >= run_bytes:
                    model.learn(held)
                    held, size = [], 0
        if held:
            model.learn(held)
        if not model.n.any():
            return
        top = (model.weights(model.z, model.n) * model.n).astype(np.float32)
        parts = list(zip(np.array_split(top, _SLICES), np.array_split(model.n.astype(np.float32), _SLICES), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), *[pa.array([x[i].tobytes() for x in parts], pa.binary()) for i in (0, 1)]], names=["slice", "top", "under"])

    return run


@store.lean
def _mixed(it):
    """Sums of the tasks' slices."""
    sums: dict[int, list] = {}
    for b in it:
        for k, *x in zip(b.column("slice").to_pylist(), b.column("top"), b.column("under"), strict=True):
            x = [np.frombuffer(v.as_buffer(), np.float32).astype(np.float64) for v in x]
            sums[k] = [s + v for s, v in zip(sums[k], x, strict=True)] if k in sums else x
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), *[pa.array([x[i].tobytes() for x in sums.values()], pa.binary()) for i in (0, 1)]], names=["slice", "top", "under"])


#: Logarithms of the temperatures that are tried.
_HEATS = np.linspace(-3, 3, 121)


def _losses(shared):
    """Each task's sum of negative log likelihoods of its held-back rows, at every temperature."""

    @store.lean
    def run(it):
        m = shared.value
        place, total = {v: i for i, v in enumerate(m.langs)}, np.zeros(len(_HEATS))
        for b in it:
            logits = _logits(m, b.column("text"))
            y = np.array([place[v] for v in b.column("lang").to_pylist()], np.int64)
            for i, t in enumerate(_HEATS):
                s = logits / np.exp(t)
                s = s - s.max(1, keepdims=True)
                total[i] += float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(_HEATS)), pa.int32()), pa.array(total)], names=["i", "loss"])

    return run


def _coolest(loss: np.ndarray) -> float:
    """The temperature of the least loss, by a parabola through the least and its neighbours."""
    i = int(loss.argmin())
    step = 0.0
    if 0 < i < len(loss) - 1:
        bend = loss[i - 1] - 2 * loss[i] + loss[i + 1]
        step = 0.5 * (loss[i - 1] - loss[i + 1]) / bend if bend > 0 else 0.0
    return float(np.exp(_HEATS[i] + step * (_HEATS[1] - _HEATS[0])))


FEW = 50


def fit(docs: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", task_rows: int = 10_000, run_rows: int = 4000, run_bytes: int = 24 << 20) -> Model:
    """Learn from all rows where ``learn`` holds and text and language are not null. Partitions are put
    together, without a shuffle, to about ``task_rows`` rows a task; a task goes over its rows in runs of
    ``run_rows`` rows and ``run_bytes`` bytes of vectors."""
    spark = docs.sparkSession
    store.batches(spark)
    d = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs, total = sorted(sizes), sum(sizes.values())
    none = Model([], np.zeros((_size() + 1, 0)), np.zeros(0), 1.0)
    if not langs:
        return none
    df = np.zeros(_size() + 1)
    counts = d.select("text").mapInArrow(_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    df[counts.column("feature").to_numpy()] = counts.column("n").to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    back = (F.pmod(F.xxhash64("doc_id", "text", F.lit("back")), F.lit(5)) == 4) if total >= FEW else F.lit(False)
    scale = 30.0
    own = d.where(~back).select("text", "lang").coalesce(max(1, total // task_rows))
    got = own.mapInArrow(_learn(langs, idf, scale, run_rows, run_bytes), _PART).repartition(_SLICES, "slice").mapInArrow(_mixed, _PART).toArrow().sort_by("slice")
    if not got.num_rows:
        return none
    top, under = (np.concatenate([np.frombuffer(v.as_buffer(), np.float64) for v in got.column(c)]).reshape(-1, len(langs)) for c in ("top", "under"))
    w = np.divide(top, under, out=np.zeros_like(top), where=under > 0)
    table = np.zeros((_size() + 1, len(langs)), np.float32)
    table[:-1] = w[:-1] * idf[:, None] * scale
    model = Model(langs, table, w[-1].copy(), 1.0)
    if total >= FEW:
        shared = store.share(spark, model)
        losses = d.where(back).select("text", "lang").mapInArrow(_losses(shared), "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).orderBy("i").toArrow()
        store.unshare(shared)
        if losses.num_rows:
            model.temperature = _coolest(losses.column("loss").to_numpy())
    return model


def _logits(model: Model, texts: pa.Array) -> np.ndarray:
    buf, off = raw(texts)
    n = len(off) - 1
    total = np.zeros((n, len(model.langs)))
    for i, j in slabs(off):
        own = np.flatnonzero(np.diff(off[i : j + 1])) + i
        if not len(own):
            continue
        for g in grams(buf, off, i, j):
            for c in range(len(model.langs)):
                total[own, c] += np.add.reduceat(model.table[:, c][g].astype(np.float64), off[own] - off[i])
    size = np.diff(off)
    n_grams = sum(np.maximum(0, size - k + 1) for k in ORDERS)
    return total / np.maximum(1, n_grams)[:, None] + model.bias


def probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    s = _logits(model, texts) / model.temperature
    s = np.exp(s - s.max(1, keepdims=True))
    return s / s.sum(1, keepdims=True)


def _has_letter(texts: pa.Array) -> np.ndarray:
    buf, off = raw(texts)
    seen = np.concatenate([[0], np.cumsum(_ASCII_LETTER[buf])])
    out = seen[off[1:]] > seen[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[i] = any(ch.isalpha() for ch in buf[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with lang_pred and score (the calibrated probability of lang_pred)."""
    spark = docs.sparkSession
    store.batches(spark)
    shared = store.share(spark, model)
    d = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(store.unused(docs, "_text")))

    @store.lean
    def run(it):
        m = shared.value
        columns = [np.ascontiguousarray(m.table[:, c]) for c in range(len(m.langs))]
        m = Model(m.langs, np.stack(columns, 1) if columns else m.table, m.bias, m.temperature)
        for b in it:
            texts = b.column(b.num_columns - 1)
            known = _has_letter(texts) & bool(m.langs)
            lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if known.any():
                p = probabilities(m, texts)
                best = p.argmax(1)
                lang[known] = np.array(m.langs, object)[best[known]]
                score[known] = p[np.arange(len(p)), best][known]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1])
    return d.mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(doc_id: str, n: int) -> Column:
    """Whether crc32 of the id as text leaves 2 on division by n."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n == 2, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(docs, fit(docs, ~held_out("doc_id", 4)))
    return out.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score")
