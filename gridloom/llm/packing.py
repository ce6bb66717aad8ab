"""Best-fit packing of token sequences by patterns fitted with non-negative least squares.

Krell et al., "Efficient Sequence Packing without Cross-contamination" (2021): patterns of up to
three lengths that fill a sequence are enumerated, repeat counts are fitted to the length histogram
by non-negative least squares (projected accelerated gradient on the sparse pattern matrix), rounded
down to what the histogram holds, and the residual counts are packed best-fit, also into what room
patterns left. Only the histogram, one row per length, reaches the driver, and only the plan, whose
size depends on the longest length alone, is broadcast; pieces find their place by their rank among
pieces of equal length.

Defined results: null text is empty and packs as its end id alone; repeated rows are packed each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store
from .words import SPACED, raw, split

_CACHED = 1 << 20  # pieces whose ids a worker keeps
_RUN = 4096  # new pieces given to the tokenizer at a time
_encoders: dict[str, "_Encoder"] = {}


#: Bytes between which the tokenizer's own rules always cut: ASCII letters and digits against ASCII
#: signs, without those that contractions and special tokens are made of.
_CUT = np.zeros(256, np.uint8)
_CUT[0x30:0x3A] = _CUT[0x41:0x5B] = _CUT[0x61:0x7B] = 1
_CUT[[ord(c) for c in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"]] = 2


class _Encoder:
    """Ids of whole texts from ids of their smallest separable pieces, each encoded once.

    The tokenizer drops white space, folds case and no rule of it reaches across the cuts, so a
    text's ids are those of its pieces in order."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()
        store.trim()

    def clear(self) -> None:
        self.key, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and their places
        self.at = np.zeros(1, np.int32)
        self.ids = np.zeros(0, np.uint16 if len(self.last) <= 1 << 16 else np.uint32)

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each piece. Letters alone are one word to the tokenizer, whose
        last token says so; they go through it as one text."""
        ids = np.array(self.tok.encode(" ".join(pieces), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self.last[ids])
        if all(map(str.isalpha, pieces)) and len(ends) == len(pieces):
            return ids, np.diff(np.concatenate([[0], ends + 1]))
        got = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.fromiter((t for x in got for t in x), np.uint32), np.array([len(x) for x in got], np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n + 1 offsets of the texts in them."""
        special = b"<|" in raw(texts)[0].tobytes()  # special tokens are told apart by case
        w = split(texts, SPACED, fold=not special, cut=_CUT)
        if max(len(self.key), len(self.ids) // 8) > _CACHED:
            self.clear()
        u, first, inv = np.unique(w.hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self.key, u)
        have = np.zeros(len(u), bool)
        inside = at < len(self.key)
        have[inside] = self.key[at[inside]] == u[inside]
        slots = np.zeros(len(u), np.int64)
        slots[have] = self.slot[at[have]]
        new = np.flatnonzero(~have)
        for a in range(0, len(new), _RUN):
            some = new[a : a + _RUN]
            text = [w.buf[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(w.start[first[some]].tolist(), w.end[first[some]].tolist(), strict=True)]
            alpha = np.array([t.isalpha() for t in text])
            for part in (np.flatnonzero(alpha), np.flatnonzero(~alpha)):
                if len(part):
                    ids, n = self._new([text[k] for k in part])
                    slots[some[part]] = len(self.at) - 1 + np.arange(len(part))
                    self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
                    self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(n, dtype=np.int32)])
        if len(new):
            self.key = np.insert(self.key, at[new], u[new])
            self.slot = np.insert(self.slot, at[new], slots[new].astype(np.int32))
        s = slots[inv]
        n = (self.at[s + 1] - self.at[s]).astype(np.int64)
        end = np.zeros(len(s) + 1, np.int64)
        np.cumsum(n, out=end[1:])
        flat = self.ids[np.arange(end[-1]) + np.repeat(self.at[s] - end[:-1], n)]
        return flat, end[w.at]


def _pieces(path: str, most: int, end_id: int):
    @store.lean
    def run(it):
        enc = _encoders.setdefault(path, None) or _Encoder(path)
        _encoders[path] = enc
        tail = np.array([end_id], np.uint32)
        for b in it:
            ids, at = enc.encode(b.column("text"))
            row, piece, start, length, crc = [], [], [], [], []
            for i in range(len(at) - 1):
                own = np.concatenate([ids[at[i] : at[i + 1]], tail]).astype("<u4")
                for k, a in enumerate(range(0, len(own), most)):
                    part = own[a : a + most]
                    row.append(i), piece.append(k), start.append(a), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def patterns(lengths: np.ndarray, most: int) -> np.ndarray:
    """Rows of three lengths in falling order (0: none) that leave no room for another length that
    occurs: the third is the longest that fits beside the first two."""
    size = np.sort(lengths)
    a, b = np.meshgrid(size, size, indexing="ij")
    ok = (a >= b) & (a + b <= most)
    a, b = a[ok], b[ok]
    rest = np.concatenate([[0], size])
    c = rest[np.searchsorted(size, most - a - b, side="right")]
    three = np.stack([a, b, np.minimum(c, b)], 1)
    alone = np.zeros((len(size), 3), three.dtype)
    alone[:, 0] = size
    alone = alone[alone[:, 0] + size[0] > most] if len(size) else alone
    out = np.concatenate([alone, three[three.sum(1) + size[0] > most] if len(size) else three])
    return out[most - out.sum(1) <= max(1, most // 64)]


def nnls(p: np.ndarray, hist: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Repeats x >= 0 of the patterns that minimise |A x - hist|^2."""
    if not len(p):
        return np.zeros(0)
    flat = p.ravel()
    used = (flat > 0).astype(float)

    def ax(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.repeat(x, 3) * used, len(hist))

    def at(r: np.ndarray) -> np.ndarray:
        r = r.copy()
        r[0] = 0
        return r[p].sum(1)

    v = np.ones(len(p))
    for _ in range(20):
        v = at(ax(v))
        v /= (lip := np.linalg.norm(v))
    x = y = np.zeros(len(p))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - at(ax(y) - hist) / (1.02 * lip))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(hist: np.ndarray, most: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, repeats) that use every length exactly as often as ``hist`` has it."""
    left = hist.astype(np.int64).copy()
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(lengths: tuple[int, ...], n: int) -> None:
        room = most - sum(lengths)
        if not open_[room]:
            insort(rooms, room)
        open_[room].append((lengths, n))

    p = patterns(np.flatnonzero(left), most)
    x = nnls(p, left.astype(float))
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        need: dict[int, int] = defaultdict(int)
        for v in p[i].tolist():
            need[v] += v > 0
        n = min(int(x[i]), *(int(left[v]) // m for v, m in need.items() if m))
        if n:
            for v, m in need.items():
                left[v] -= n * m
            put(tuple(v for v in p[i].tolist() if v), n)
    for v in np.flatnonzero(left)[::-1].tolist():
        n = int(left[v])
        while n:
            k = bisect_left(rooms, v)
            if k == len(rooms):
                m = most // v
                if n >= m:
                    put((v,) * m, n // m)
                if n % m:
                    put((v,) * (n % m), 1)
                break
            room = rooms[k]
            lengths, have = open_[room].pop()
            if not open_[room]:
                rooms.pop(k)
            take = min(n, have)
            if have > take:
                put(lengths, have - take)
            put((*lengths, v), take)
            n -= take
    return [x for room in open_.values() for x in room]


def _segments(made: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Columns length, first rank, first sequence, copies in a sequence, offset; by length and rank."""
    rows, seen, base = [], defaultdict(int), 0
    for lengths, n in made:
        offset = 0
        for v in sorted(set(lengths), reverse=True):
            m = lengths.count(v)
            rows.append((v, seen[v], base, m, offset))
            seen[v] += n * m
            offset += v * m
        base += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(segments):
    @store.lean
    def run(it):
        seg = segments.value
        scale = np.int64(1) << np.int64(44)
        keys = seg[:, 0] * scale + seg[:, 1]
        for b in it:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            s = seg[np.searchsorted(keys, length * scale + rank, side="right") - 1]
            q = rank - s[:, 1]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s[:, 2] + q // np.maximum(1, s[:, 3])), pa.array(s[:, 4] + q % np.maximum(1, s[:, 3]) * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", most: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    store.batches(spark)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = store.table(d.mapInArrow(_pieces(tokenizer, most, end_id), kind), "pieces")
    hist = np.zeros(most + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        hist[r[0]] = r[1]
    segments = store.share(spark, _segments(plan(hist, most)))
    # ranks among equal lengths: hot lengths are spread over parts, each part counted first
    parts = max(8, int(hist.max(initial=0)) // 200_000)
    p = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = p.groupBy("length", "part").count().select("length", "part", (F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = p.withColumn("own", own).join(before, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_place(segments), f"{kind}, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
