"""The pipeline's stages on a whole small table, each against plain Python on its own input."""

import re

import corpus_pipeline
from gridloom.llm import store

SMALL = "/root/testdata/sf0.001"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def windows(t):
    w = words(t)
    n = min(10, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def one_of_each_group(rows):
    s = {r.doc_id: shingles(r.text) for r in rows}
    up = {i: i for i in s}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in s:
        for b in s:
            if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i for i in s if top(i) == i}


def clean(rows, items):
    of: dict[int, set] = {}
    for t in items:
        for w in windows(t):
            of.setdefault(len(w), set()).add(w)
    hit = lambda w: any(tuple(w[i : i + n]) in known for n, known in of.items() for i in range(len(w) - n + 1))
    return {r.doc_id for r in rows if not hit(words(r.text))}


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = store.table(stage(spark, docs, SMALL), name)
        after = docs.collect()
        ids, kept = {r.doc_id for r in before}, {r.doc_id for r in after}
        if name == "best_fit_packing":
            assert kept == ids
            break
        assert docs.columns == columns and kept <= ids and set(after) <= set(before)
        if name == "quality":
            trusted = {r.doc_id for r in before if r.doc_id in good and r.text}
            assert len(kept & trusted) >= 0.99 * len(trusted)
        elif name == "language":
            assert all(any(c.isalpha() for c in r.text or "") for r in after)
            wordy = {r.doc_id for r in before if len(words(r.text)) >= 20}
            assert len(kept & wordy) >= 0.99 * len(wordy)
        elif name == "near_duplicates":
            assert kept == one_of_each_group(before) and len(after) == len(kept)
        else:
            assert kept == clean(before, items) and len(kept) < len(before)


def test_odd_rows_pass_through_the_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    plain = [r.text for r in docs.where("length(text) between 300 and 600 and lang = 'en'").orderBy("doc_id").limit(3).collect()]
    odd = [(None, plain[0], "en"), (None, plain[0], "en"), (90001, plain[1], None), (90001, plain[2], "en"), (90002, None, "en"), (90003, "", None)]
    odd += [(90010 + i, "Съешь ещё этих мягких французских булок, да выпей же чаю. Широкая электрификация южных губерний даст мощный толчок " + "подъёму сельского хозяйства " * i, None) for i in range(1, 6)]
    odd = spark.createDataFrame([(*r, 1, 2, 3) for r in odd], "doc_id long, text string, lang string, _key int, low int, size int")
    more = ["_key", "low", "size"]
    before = docs.selectExpr("*", *[f"0 AS {c}" for c in more]).unionByName(odd)
    kept = corpus_pipeline.language(spark, before, SMALL)
    assert kept.columns == before.columns
    kept = {r.doc_id for r in kept.collect()}
    assert not kept & set(range(90011, 90016)) and 90002 not in kept and len(kept) > 0.99 * docs.count() - 10
    apart = odd.where("doc_id is null or doc_id <= 90003")
    one = corpus_pipeline.near_duplicates(spark, apart, SMALL).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in one) == sorted([(0, plain[0]), (90001, plain[1]), (90001, plain[2]), (90002, ""), (90003, "")])
    again = odd.where("doc_id is null").unionByName(odd.where("doc_id is null").selectExpr("90005L AS doc_id", "text", "lang", *more))
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, again, SMALL).collect()] == [90005]
    for name, stage in corpus_pipeline.STAGES:
        if name != "best_fit_packing":
            got = stage(spark, before.limit(0), SMALL)
            assert got.columns == before.columns and got.count() == 0
    assert corpus_pipeline.quality(spark, before, SMALL).where("text is null").count() == 0
