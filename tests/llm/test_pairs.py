import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

from gridloom.llm import neardup, partenum


def components_of(ids, links):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def near_vectors():
    rng = np.random.default_rng(3)
    rows = []
    for c in range(40):
        base = rng.standard_normal(32)
        for _ in range(1 + c % 6):
            rows.append(list(map(float, base + 0.12 * rng.standard_normal(32))))
    rows += [rows[7]] * 50 + [[x * 3 for x in rows[8]]] + [None, [], [0.0] * 32, [float("nan")] * 32, [None] * 32, [1.0] * 31]
    return list(enumerate(rows))


def test_vectors_against_brute_force(spark):
    rows = near_vectors()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, node string")
    got = {r.vec_id: r for r in neardup.near_duplicates(df).collect()}
    good = [(i, np.float32(v).astype(float)) for i, v in rows if v and len(v) == 32 and None not in v and np.isfinite(v).all() and any(v)]
    u = np.array([v / np.linalg.norm(v) for _, v in good])
    ids = [i for i, _ in good]
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(u @ u.T >= 0.9, 1)), strict=True)]
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    want = components_of(list(n), links)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_links for i, r in got.items()} == n
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("block, partners, closest", [(1024, 64, 4), (5, 2, 1)])
def test_jaccard_against_brute_force(spark, monkeypatch, block, partners, closest):
    monkeypatch.setattr(partenum, "BLOCK", block)
    monkeypatch.setattr(partenum, "PARTNERS", partners)
    rng = np.random.default_rng(4)
    rows = [(900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one TWO"), (905, "a " * 3000), (906, "a " * 3001)]
    for c in range(25):
        base = list(rng.integers(0, 60, rng.integers(3, 150)))
        for _ in range(1 + c % 7 if c else 40):
            t = [int(x) for x in base]
            for _ in range(rng.integers(0, 4 if c else 9)):
                t[rng.integers(0, len(t))] = 99
            rows.append((len(rows), " ".join(f"w{x}" for x in t)))
    rows += [(i + 2000, t) for i, t in rows[7:20]]
    df = spark.createDataFrame([Row(doc_id=i, text=t, node=1, n="x") for i, t in rows], "doc_id long, text string, node int, n string")
    s = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in s for b in s if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])]
    want = components_of(list(s), links)
    got = partenum.jaccard_groups(df, closest=closest).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s[i]), want[i]) for i in s}
    assert partenum.jaccard_groups(df.limit(0)).count() == 0


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 1 << 63, 12_000, dtype=np.uint64)
    own = [rng.choice(pool, n, replace=False) for n in (1, 3, 15, 16, 17, 90, 130, 4000, 9000)]
    s = partenum.Sketches(pa.array(partenum.sketches(np.concatenate(own), np.array([len(x) for x in own])), pa.binary()))
    x, y = (i.ravel() for i in np.indices((len(own), len(own))))
    apart = np.array([len(np.setxor1d(own[i], own[j])) for i, j in zip(x, y, strict=True)])
    like = np.array([0.5 < len(own[i]) / len(own[j]) < 2 for i, j in zip(x, y, strict=True)])
    assert (s.apart(x, y) <= apart).all() and (s.apart(x, y)[like] >= 0.5 * apart[like]).all()


@pytest.mark.parametrize("n", [1, 7])
def test_sketch_bounds_the_residual(n):
    u = neardup.unit(np.random.default_rng(n).standard_normal((50, n)))
    x, r = neardup.restored([s.tobytes() for s in neardup.sketches(u)], n)
    assert (np.linalg.norm(u - x.astype(float), axis=1) <= r + 1e-6).all()


def linked_pairs(n, pairs, dim=64, cosine=0.9001, seed=11):
    """``n`` random vectors, to ``pairs`` of which another one at the given cosine is added."""
    rng = np.random.default_rng(seed)
    x = neardup.unit(rng.standard_normal((n, dim)))
    y = rng.standard_normal((pairs, dim))
    y = neardup.unit(y - (y * x[:pairs]).sum(1, keepdims=True) * x[:pairs])
    return np.concatenate([x, cosine * x[:pairs] + np.sqrt(1 - cosine**2) * y]).astype(np.float32)


def test_recall_at_the_threshold(spark):
    x = linked_pairs(8000, 400)
    u = neardup.unit(x.astype(float))
    n = (u[:8000] @ u[8000:].T >= 0.9).sum()
    assert n >= 400
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    got = neardup.near_duplicates(df).where("n_links > 0").collect()
    assert sum(r.n_links for r in got) / 2 >= 0.97 * n
    assert sum(r.component_id != r.vec_id for r in got) >= 0.97 * 400


def test_passes_follow_the_row_count():
    assert neardup.passes_for(1024, 0.9, 0.99, 1024) == 1
    assert [neardup.passes_for(n, 0.9, 0.99, 1024) for n in (5_000, 500_000, 50_000_000)] == sorted({neardup.passes_for(n, 0.9, 0.99, 1024) for n in (5_000, 500_000, 50_000_000)})


def test_vectors_of_every_length_and_without_id(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0]
    rows = [(1, a), (2, a), (2, a), (None, a), (5, b), (4, b), (6, [-1.0, 2.0]), (7, [1e307, 2e307]), (None, None)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 3, 1), (2, 3, 1), (2, 3, 1), (None, 3, 1), (5, 2, 4), (4, 2, 4), (6, 0, 6), (7, 2, 4), (None, 0, None)], key=str)


def test_links_of_a_large_group_are_counted(spark):
    rng = np.random.default_rng(12)
    x = (rng.standard_normal(64) + 0.3 * rng.standard_normal((2600, 64))).astype(np.float32)
    u = neardup.unit(x.astype(float))
    want = (u @ u.T >= 0.9).sum(1) - 1
    assert 500 < want.mean() < 2500 and components_of(range(2600), zip(*np.nonzero(np.triu(u @ u.T >= 0.9, 1)), strict=True)) == dict.fromkeys(range(2600), 0)
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == {i: (n, 0) for i, n in enumerate(want.tolist())}


def test_packed_runs_are_small_and_exact():
    rng = np.random.default_rng(5)
    spread = np.sort(np.concatenate([[-(1 << 63), -5, -5, 0, (1 << 63) - 1], rng.integers(-(1 << 62), 1 << 62, 500)]).astype(np.int64))
    dense = np.sort(rng.integers(2_000_000, 2_004_000, 3_000))
    for ids in (spread, dense, dense[:1], dense[:0]):
        assert (partenum.unstepped(np.frombuffer(partenum.steps(ids), np.uint8)) == ids).all()
    assert pa.compress(partenum.steps(dense), "lz4").size < 1.1 * len(dense)
    n = np.array([5, 40, 1000, 3000])
    sets = np.sort(rng.integers(0, 1 << 63, n.sum()).astype(np.uint64))
    assert sum(map(len, partenum.sketches(sets, n))) * 8 < 4.2 * n.sum()
    bands = partenum.Bands(80, 100, 3000)

    class Reps:
        value = np.full(1024, ~np.uint64(0))

    words = [" ".join(f"w{x}" for x in rng.integers(0, 500, k)) for k in n]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(n))), pa.array(words), pa.array(range(len(n)))], names=["doc_id", "text", "place"])
    got = pa.Table.from_batches(partenum._packed(5, bands, 3, Reps)([batch]))
    h, at = partenum.sets(pa.array(words), 5)
    rows = sum(len(partenum.signatures(h, np.diff(at), bands, shift)[0]) for shift in (0, 1))
    assert sum(len(x.as_py()) for x in got["sig"]) == 4 * rows
    assert sorted(np.concatenate([partenum.unstepped(np.frombuffer(x.as_buffer(), np.uint8)) for x in got["node"].combine_chunks()]).tolist()) == sorted(np.concatenate([partenum.signatures(h, np.diff(at), bands, shift)[1] for shift in (0, 1)]).tolist())
