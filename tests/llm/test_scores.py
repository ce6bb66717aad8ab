"""Results against plain Python on whole small tables: counts, ids, likelihoods and held-out accuracy."""

import re
import zlib
from collections import Counter
from itertools import product
from math import log10

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from gridloom.llm import hmm, kneser, langid, packing

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_forward_against_all_paths():
    rng = np.random.default_rng(1)
    of = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(shape))
    m = hmm.Hmm(of(3), of(3, 3), of(3, 5))
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (6, 4, 4, 1)]
    want = []
    for s in seqs:
        total = 0.0
        for path in product(range(3), repeat=len(s)):
            p = m.start[path[0]] * m.emit[path[0], s[0]]
            for a, b, x in zip(path, path[1:], s[1:], strict=False):
                p *= m.move[a, b] * m.emit[b, x]
            total += p
        want.append(np.log(total))
    assert np.allclose(hmm.forward(m, seqs), want, rtol=1e-5)
    start, moves, emissions, ll = hmm.expected(m, seqs)
    assert np.isclose(start.sum(), 4) and np.isclose(moves.sum(), sum(len(s) - 1 for s in seqs), rtol=1e-5)
    assert np.isclose(emissions.sum(), sum(map(len, seqs)), rtol=1e-5) and np.isclose(ll, sum(want), rtol=1e-5)


def test_corpus_scores(spark, documents):
    got = {r.doc_id: r for r in hmm.query(spark, SMALL).collect()}
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    tokens = {int(i): [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), None] for i, t in zip(documents.doc_id, documents.text, strict=True)}
    count = Counter(w for i, t in tokens.items() if remainder(i, 7) != 2 for w in t)
    n, v = sum(count.values()), len(count)
    assert got.keys() == tokens.keys()
    for i, t in tokens.items():
        r = got[i]
        base = sum(log10((count[w] + 1) / (n + v + 1)) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(i, 7) == 2, len(t), sum(count[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and np.isfinite(r.score) and r.score <= 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_of_held_out_texts(spark, documents):
    lang = dict(zip(documents.doc_id, documents.lang, strict=True))
    text = dict(zip(documents.doc_id, documents.text, strict=True))
    got = langid.query(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents.doc_id)
    right = total = 0
    for r in got:
        letters = any(c.isalpha() for c in text[r.doc_id] or "")
        assert r.held_out == (remainder(r.doc_id, 4) == 2) and (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        if r.held_out and letters and lang[r.doc_id] is not None:
            right, total = right + (r.lang_pred == lang[r.doc_id]), total + 1
    assert right / total > 0.9


def test_ids_are_the_tokenizers_own(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["", None, "don't <|endoftext|> A<|startoftext|>b", "x" * 5000, "é É ß ſ K Å", "a b　c​d", "#tag @x 1,000.5% 'll 'S '", "日本語 テスト 12三", "tab\there\n\nnew\x0bline\x00nul"]
    rows = [*zip(documents.doc_id, documents.text, strict=True), *((-1 - i, t) for i, t in enumerate(odd))]
    df = spark.createDataFrame([(int(i), t) for i, t in rows], "doc_id long, text string")
    want = {}
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            want[int(i), k] = (a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes()))
    out = packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == want
    used = len({r.sequence_id for r in out})
    assert used <= -(-sum(r.length for r in out) // 2048) * 1.05 + 1


def test_trusted_texts_are_kept(spark):
    good = kneser.trusted_ids(spark, SMALL).distinct()
    got = kneser.query(spark, SMALL).join(good, "doc_id").where("n_bytes > 0")
    n, kept = got.count(), got.where("kept").count()
    assert n and kept / n > 0.99


def test_small_classes_take_the_bounds_of_their_language(spark):
    rng = np.random.default_rng(8)
    plain = lambda n: " ".join(rng.choice(["stone", "river", "garden", "winter"], n))
    noise = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 200))
    rows = [("aa", plain(30)) for _ in range(150)] + [("aa", plain(6)) for _ in range(10)] + [("bb", noise()) for _ in range(150)] + [("aa", noise()[:50])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    got = {r.doc_id: r for r in kneser.classify(df, df.where("doc_id < 310").select("doc_id")).collect()}
    assert max(got[i].high for i in range(150, 160)) < min(got[i].perplexity for i in range(160, 310))
    assert all(got[i].kept for i in range(160)) and not got[310].kept


def test_bad_texts_are_rejected(spark):
    small = "/root/testdata/sf0.01"
    got = kneser.query(spark, small).join(spark.read.parquet(f"{small}/labels.parquet"), "doc_id").select("quality", "kept").toPandas()
    assert (~got[got.quality == 0].kept).mean() > 0.9 and got[got.quality == 1].kept.mean() > 0.99


def test_probabilities_against_plain_kneser_ney(spark):
    texts = ["abracadabra alakazam", "banana bandana", "abba", "salamander abracadabra", "a", "cabana banana abacus"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    grams = Counter()
    for t in texts:
        b = b"\0" * 4 + t.encode()
        grams.update(b[i : i + 5] for i in range(len(b) - 4))
    counts = {5: grams}
    for n in (4, 3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    off = {}
    for n, c in counts.items():
        k = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = k[0] / (k[0] + 2 * k[1]) if k[0] else 0
        off[n] = [0.5, 0.75, 0.9] if min(k[:3]) == 0 else [min(j - 1e-3, max(1e-3, j - (j + 1) * y * k[j] / k[j - 1])) for j in (1, 2, 3)]

    def prob(g):
        if not g:
            return 1 / 256
        n, ctx = len(g), g[:-1]
        same = {h: v for h, v in counts[n].items() if h[:-1] == ctx}
        if not same:
            return prob(g[1:])
        d = lambda v: off[n][min(v, 3) - 1]
        c, total = counts[n].get(g, 0), sum(same.values())
        return ((c - d(c)) if c else 0) / total + sum(map(d, same.values())) / total * prob(g[1:])

    model = kneser.train(df.select("text"))
    new = [*texts, "abracadabana", "zebra", "banana abba alakazam ü"]
    out = kneser.perplexities(spark.createDataFrame([(i, t) for i, t in enumerate(new)], "doc_id long, text string"), model).collect()
    for r in out:
        b = b"\0" * 4 + new[r.doc_id].encode()
        assert r.log10_prob == pytest.approx(sum(log10(prob(b[i : i + 5])) for i in range(len(b) - 4)), abs=1e-3)


def test_all_trusted_texts_train_the_model(spark, monkeypatch):
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("row "), "id").alias("text"), F.lit("en").alias("lang"))
    train, seen = kneser.train, []
    monkeypatch.setattr(kneser, "train", lambda texts: seen.append(texts.count()) or train(texts.limit(50)))
    kneser.classify(docs, docs.select("doc_id").where("doc_id % 12 > 0"))
    kneser.classify(docs, docs.select(F.col("doc_id").cast("int")).where("doc_id % 12 > 0"))
    assert seen == [22_000, 22_000]


def test_every_row_is_learnt_from(spark):
    long = [(1, "zuqa weno xyqo " * 90_000, "xx")]
    short = [(i, f"the house number {i} by the river", "en") for i in range(2, 20)] + [(i, f"das haus nummer {i} am fluss", "de") for i in range(20, 40)]
    docs = spark.createDataFrame(long + short, "doc_id long, text string, lang string")
    new = spark.createDataFrame([(100, "weno xyqo zuqa", "xx"), (101, "the number of a house", "en"), (102, "das haus am fluss", "de")], docs.schema)
    for parts, more in ((1, {}), (3, {"task_rows": 1, "run_rows": 7})):
        model = langid.fit(docs.repartition(parts, "doc_id"), F.lit(True), **more)
        assert all(r.lang_pred == r.lang for r in langid.predict(new, model, keep=("doc_id", "lang")).collect())


def test_runs_and_slices_of_the_fit():
    words = ["ab cd", "xyz uvw", "abc abc", "only here"]
    batch = lambda t: pa.RecordBatch.from_arrays([pa.array(t), pa.array(["de" if "x" in x else "en" for x in t])], names=["text", "lang"])
    idf = np.ones(langid._size())
    both = [b for texts in (words, words[:3]) for b in langid._learn(["de", "en"], idf, 30.0, 2, 1 << 20)([batch(texts)])]
    total = next(iter(langid._mixed(both)))
    under = np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in total["under"]]).reshape(-1, 2)
    alone = [np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in b["under"]]).reshape(-1, 2) for b in both]
    assert under.shape == (langid._size() + 1, 2) and np.allclose(under, alone[0].astype(float) + alone[1])
    last, _ = langid._vectors(pa.array(words[3:]))[0]
    assert (under[last] > 0).all()


def test_temperature_is_where_the_loss_is_least():
    assert abs(langid._coolest((langid._HEATS - 0.4321) ** 2) - np.exp(0.4321)) < 1e-6
    assert langid._coolest(langid._HEATS) == np.exp(-3)


def test_trusted_texts_are_exact(spark):
    docs = spark.range(30_000).select(F.when(F.col("id") % 1000 > 0, F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    ids = spark.range(0, 60_000, 3).withColumnRenamed("id", "doc_id")
    got = [r.text for r in kneser._trusted(docs.union(docs.where("doc_id % 9 = 0")), ids).collect()]
    want = [str(i) for i in range(0, 30_000, 3) if i % 1000] + [str(i) for i in range(0, 30_000, 9) if i % 1000]
    assert sorted(got) == sorted(want)
