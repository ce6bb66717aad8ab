"""Hidden Markov language model trained on all of a corpus.

Latent states emit word classes, a class emits its words: the most frequent words are classes of
their own, all others share classes by their letters, so the tables that Baum-Welch re-estimates
have a fixed size while word counts stay exact, over the whole corpus, in a sharded table. As a
word's probability in its class does not depend on the state, the likelihood of a text is that of
its class sequence, by the scaled forward recursion, times its words' probabilities in their classes.

Texts are read once into blocks of local word ids with a dictionary; only dictionaries are shuffled
to be counted and to bring the counts back. Expected counts of an iteration are summed over
partitions by key; what reaches the driver has the size of the state tables.

Defined results: null text is empty, its only token is the end; repeated rows count each; with
nothing to learn from every token has probability 1; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .langid import held_out
from .words import SPACED, mix, split

BLOCK = 3_000_000
POS = 1 << 28  # distinct words of a block
PART = 1 << 12  # blocks of a partition; references are good for 2^23 partitions
REFS = 1000  # blocks whose references to one word are one row
CHUNK = 1_000_000
_BLOCKS = "block long, doc_id array<long>, train array<boolean>, n array<int>, ids binary, n_ids long, h array<long>, c array<long>, letters array<int>"
_SEQS = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, in_class double, classes binary"


@dataclass
class Shape:
    states: int = 8
    own: int = 4096  # words that are classes of their own
    shared: int = 1024  # classes shared by all others

    @property
    def classes(self) -> int:
        return self.own + self.shared + 1

    @property
    def end(self) -> int:
        return self.own + self.shared


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x classes


def _letters(buf: np.ndarray, start: np.ndarray, end: np.ndarray, shared: int) -> np.ndarray:
    """A word's shared class, from its first and last two bytes."""
    code = buf[start].astype(np.uint64) | buf[end - 1].astype(np.uint64) << np.uint64(8) | buf[np.maximum(end - 2, start)].astype(np.uint64) << np.uint64(16)
    return (mix(code) % np.uint64(shared)).astype(np.int32)


def _block(shared: int):
    def flush(key: int, held: list) -> pa.RecordBatch:
        h, letters, n = (np.concatenate([x[k] for x in held]) for k in range(3))
        train = np.concatenate([x[3] for x in held])
        u, first, inv, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(u), np.uint32)
        rank[order] = np.arange(len(u), dtype=np.uint32)
        ids = rank[inv]
        c = np.bincount(ids[np.repeat(train, n)], minlength=len(u))
        doc = pa.concat_arrays([x[4] for x in held])
        one = lambda a, t: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a if isinstance(a, pa.Array) else pa.array(a, t))
        packed = pa.compress(ids.tobytes(), codec="zstd", asbytes=True)
        cols = [pa.array([key]), one(doc, None), one(train, pa.bool_()), one(n, pa.int32()), pa.array([packed], pa.binary()), pa.array([len(ids)]), one(u[order].view(np.int64), pa.int64()), one(c.astype(np.int64), pa.int64()), one(letters[first][order], pa.int32())]
        return pa.RecordBatch.from_arrays(cols, names=["block", "doc_id", "train", "n", "ids", "n_ids", "h", "c", "letters"])

    def run(it):
        from pyspark import TaskContext

        key, held, size = TaskContext.get().partitionId() * PART, [], 0
        last = key + PART - 1
        for b in it:
            w = split(b.column("text"), SPACED)
            held.append((w.hashes(), _letters(w.buf, w.start, w.end, shared), w.count.astype(np.int32), b.column("train").to_numpy(zero_copy_only=False), b.column("doc_id")))
            size += len(w.start)
            if size >= BLOCK:
                if key == last:
                    raise ValueError("a partition has too many blocks; read smaller partitions")
                yield flush(key, held)
                key, held, size = key + 1, [], 0
        if held:
            yield flush(key, held)

    return run


def _sequences(shape: Shape, stats: dict):
    """Class sequences and count-based scores of a block's documents."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        pos = right.column("pos").to_numpy()
        c, k = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.uint16)
        c[pos], k[pos] = right.column("c").to_numpy(), right.column("class").to_numpy()
        total, kinds = stats["N"], stats["V"]
        unigram = np.log10((c + 1) / (total + kinds + 1))
        own = k < shape.own
        bucket = np.where(own, 0, k.astype(np.int64) - shape.own)
        inside = np.where(own, 0.0, np.log10((c + 1) / (stats["n_in"][bucket] + stats["v_in"][bucket] + 1)))
        end = np.log10((stats["docs"] + 1) / (total + kinds + 1))
        for i in range(left.num_rows):
            n = left.column("n")[i].values.to_numpy()
            ids = np.frombuffer(pa.decompress(left.column("ids")[i].as_py(), left.column("n_ids")[i].as_py() * 4, codec="zstd", asbytes=True), np.uint32)
            at = np.concatenate([[0], np.cumsum(n)])
            sums = lambda v: np.concatenate([[0], np.cumsum(v[ids])])  # noqa: B023, E731
            s1, s2, known = sums(unigram), sums(inside), sums((c > 0).astype(np.int64))
            cls = k[ids]
            tail = np.array([shape.end], np.uint16).tobytes()
            out.append(pa.Table.from_arrays([
                left.column("doc_id")[i].values, left.column("train")[i].values, pa.array(n.astype(np.int64) + 1), pa.array(known[at[1:]] - known[at[:-1]] + (stats["docs"] > 0)),
                pa.array(s1[at[1:]] - s1[at[:-1]] + end), pa.array(s2[at[1:]] - s2[at[:-1]]), pa.array([cls[a:b].tobytes() + tail for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
            ], names=["doc_id", "train", "n_tokens", "n_known", "base_score", "in_class", "classes"]))
        return pa.concat_tables(out)

    return run


def _chunks(classes: list[np.ndarray]):
    """Index lists of sequences of like length, about CHUNK tokens each, longest first."""
    order = sorted(range(len(classes)), key=lambda i: -len(classes[i]))
    part, size = [], 0
    for i in order:
        part.append(i)
        size += len(classes[i])
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _grid(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes in step order (all first tokens, all second ...), where each step begins, and how many
    sequences are as long; ``seqs`` from long to short."""
    n = np.array([len(s) for s in seqs])
    active = np.searchsorted(-n, -np.arange(1, n[0] + 1), side="right")
    begin = np.concatenate([[0], np.cumsum(active)])
    flat = np.empty(begin[-1], np.uint16)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    flat[begin[step] + row] = np.concatenate(seqs)
    return flat, begin, active


def forward(m: Hmm, seqs: list[np.ndarray], keep: bool = False):
    """Natural log likelihood of each sequence (long to short) by the scaled forward recursion."""
    flat, begin, active = _grid(seqs)
    ll = np.zeros(len(seqs))
    emit, move = m.emit.astype(np.float32), np.ascontiguousarray(m.move.T.astype(np.float32))
    alphas = np.empty((emit.shape[0], begin[-1]), np.float32) if keep else None
    scales = np.empty(begin[-1], np.float32) if keep else None
    a = np.repeat(m.start.astype(np.float32)[:, None], active[0], 1)
    for t in range(len(active)):
        n = active[t]
        if t:
            a = move @ a[:, :n]
        a = a * emit[:, flat[begin[t] : begin[t + 1]]]
        s = a.sum(0)
        a /= s
        ll[:n] += np.log(s)
        if keep:
            alphas[:, begin[t] : begin[t + 1]] = a
            scales[begin[t] : begin[t + 1]] = s
    return (ll, flat, begin, active, alphas, scales) if keep else ll


def expected(m: Hmm, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch expected counts (start, moves, emissions) and the log likelihood."""
    ll, flat, begin, active, alphas, scales = forward(m, seqs, keep=True)
    emit, move = m.emit.astype(np.float32), m.move.astype(np.float32)
    k = emit.shape[0]
    moves = np.zeros((k, k))
    b = np.zeros((k, 0), np.float32)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        here = slice(begin[t], begin[t + 1])
        full = np.ones((k, n), np.float32)
        if t + 1 < len(active):
            later = slice(begin[t + 1], begin[t + 2])
            x = b * emit[:, flat[later]] / scales[later]
            moves += alphas[:, here][:, : active[t + 1]] @ x.T
            full[:, : active[t + 1]] = move @ x
        b = full
        alphas[:, here] *= b
    emissions = np.stack([np.bincount(flat, alphas[j], emit.shape[1]) for j in range(k)])
    return alphas[:, : active[0]].sum(1, dtype=np.float64), moves * m.move, emissions, float(ll.sum())


def _read(it):
    held, size = [], 0
    for b in it:
        for x in b.column("classes"):
            held.append(np.frombuffer(x.as_buffer(), np.uint16))
            size += len(held[-1])
        if size >= 4 * CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _e_step(model):
    def run(it):
        m = model.value
        total = None
        for held in _read(it):
            for part in _chunks(held):
                got = expected(m, [held[i] for i in part])
                flat = np.concatenate([got[0], got[1].ravel(), got[2].ravel(), [got[3]]])
                total = flat if total is None else total + flat
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "v"])

    return run


def _score(model):
    def run(it):
        m = model.value
        for b in it:
            seqs = [np.frombuffer(x.as_buffer(), np.uint16) for x in b.column("classes")]
            ll = np.zeros(len(seqs))
            for part in _chunks(seqs):
                ll[part] = forward(m, [seqs[i] for i in part])
            score = ll / np.log(10) + b.column("in_class").to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(score)], names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    return run


def _first(shape: Shape, count: np.ndarray, seed: int) -> Hmm:
    rng = np.random.default_rng(seed)
    emit = (count + 0.1) * rng.gamma(0.5, 1.0, (shape.states, shape.classes)) + 1e-4 * (count + 0.1)
    move = np.full((shape.states, shape.states), 0.2 / shape.states) + 0.8 * np.eye(shape.states)
    return Hmm(np.full(shape.states, 1 / shape.states), move, emit / emit.sum(1, keepdims=True))


def _maximised(shape: Shape, v: np.ndarray, count: np.ndarray) -> Hmm:
    k = shape.states
    start, move, emit = v[:k] + 0.1, v[k : k + k * k].reshape(k, k) + 0.1, v[k + k * k : -1].reshape(k, shape.classes)
    emit = emit + 20 * (count + 0.1)[None] / (count + 0.1).sum()
    return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def score_corpus(docs: DataFrame, train: Column, *, doc_id: str = "doc_id", text: str = "text", shape: Shape | None = None, rounds: int = 5, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, train, n_tokens, n_known, train_tokens, base_score (unigram with
    one added), score (the model's log10 probability of the text)."""
    spark = docs.sparkSession
    store.batches(spark)
    shape = shape or Shape()
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    blocks = store.table(d.mapInArrow(_block(shape.shared), _BLOCKS), "blocks")
    entry = blocks.select("block", F.posexplode(F.arrays_zip("h", "c", "letters")).alias("pos", "w"))
    # a frequent word is in every block: its references are cut into rows of bounded length
    cuts = max(1, blocks.count() // REFS)
    refs = entry.groupBy("w.h", F.pmod(F.hash("block"), F.lit(cuts)).alias("cut")).agg(F.sum("w.c").alias("c"), F.min("w.letters").alias("letters"), F.collect_list(F.col("block") * POS + F.col("pos")).alias("refs"))
    refs = store.table(refs, "references")
    vocab = refs.select("h", "c", "letters") if cuts == 1 else store.table(refs.groupBy("h").agg(F.sum("c").alias("c"), F.min("letters").alias("letters")), "vocab")
    n_docs = d.where("train").count()
    top = vocab.where("c > 0").orderBy(F.desc("c"), "h").select("h", "c").limit(shape.own).toArrow()
    first = spark.createDataFrame(pa.table({"h": top.column("h"), "own": pa.array(np.arange(top.num_rows), pa.int64())})) if top.num_rows else spark.createDataFrame([], "h long, own long")
    classed = vocab.join(F.broadcast(first), "h", "left").withColumn("class", F.coalesce("own", F.col("letters") + shape.own))
    n_in, v_in, count = np.zeros(shape.shared), np.zeros(shape.shared), np.zeros(shape.classes)
    count[: top.num_rows] = top.column("c").to_numpy()
    for r in classed.where("c > 0").groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).where(F.col("class") >= shape.own).collect():
        n_in[r["class"] - shape.own], v_in[r["class"] - shape.own], count[r["class"]] = r["c"], r["v"], r["c"]
    count[shape.end] = n_docs
    stats = {"N": int(count.sum()), "V": int(v_in.sum()) + top.num_rows + (n_docs > 0), "docs": n_docs, "n_in": n_in, "v_in": v_in}
    whole = refs if cuts == 1 else refs.select("h", "refs").join(vocab, "h")
    named = whole.join(F.broadcast(first), "h", "left").withColumn("class", F.coalesce("own", F.col("letters") + shape.own))
    refs = named.select("c", "class", F.explode("refs").alias("ref")).select((F.shiftright("ref", 28)).alias("block"), F.col("ref").bitwiseAND(POS - 1).alias("pos"), "c", "class")
    seqs = store.table(blocks.select("block", "doc_id", "train", "n", "ids", "n_ids").groupBy("block").cogroup(refs.groupBy("block")).applyInArrow(_sequences(shape, stats), _SEQS), "sequences")
    model = _first(shape, count, seed)
    for _ in range(rounds if n_docs else 0):
        shared = store.share(spark, model)
        got = seqs.where("train").select("classes").mapInArrow(_e_step(shared), "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        v = np.zeros(shape.states * (1 + shape.states + shape.classes) + 1)
        v[got.column("at").to_numpy()] = got.column("v").to_numpy()
        store.unshare(shared)
        model = _maximised(shape, v, count)
    if not n_docs:
        model = Hmm(model.start, model.move, np.ones_like(model.emit))
    shared = store.share(spark, model)
    out = seqs.select("doc_id", "train", "n_tokens", "n_known", "base_score", "in_class", "classes").mapInArrow(_score(shared), "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "train", "n_tokens", "n_known", F.lit(stats["N"]).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    r = score_corpus(docs, ~held_out("doc_id", 7))
    return r.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
