import io

import numpy as np
import pytest

from gridloom.llm import blocks, decontam, hmm, kneser, langid, packing, warc


def test_archive_round_trip_and_damage():
    words = warc.dictionary([b"<p>abc</p>" * 20] * 3)
    import zstandard

    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words))
    raw = [warc.page_record(i, "http://x", b"p" * i * 50_000, i * 50_000, warc.sha1(b"p" * i * 50_000), None) for i in range(4)]
    data = warc.leading_frame(words) + b"".join(pack.compress(r) for r in raw)
    got = list(warc.read_archive(io.BytesIO(data), chunk=7))
    assert [g.block for g in got] == [warc.decode(r).block for r in raw]
    for bad in (data[8:], data[:-3], data[:20], b""):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(io.BytesIO(bad)))
    told = warc.decode(b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-RECORD-ID: <urn:1>\r\nWarc-Date: 2001-01-01T00:00:00Z\r\nWARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\ncontent-length: 2\r\n\r\nok\r\n\r\n")
    assert told.block == b"ok" and told.headers["warc-concurrent-to"] == "<a> <b>"
    for bad in (raw[1].replace(b"WARC/1.1", b"HTTP/1.1"), raw[1][:-5] + b"\r\n\r\n", raw[1].replace(b"WARC-Date", b"WARC-Type"), raw[1].replace(b"WARC-Type", b"X-Type")):
        with pytest.raises(warc.WarcError):
            warc.decode(bad)


def test_pages_written_and_read(spark):
    rows = [(5, "u", "<p>ä</p>"), (3, None, "<p>ä</p>"), (4, "u", None), (9, "u", ""), (7, "u", "x" * 300_000), (8, "u", "<p>ä</p>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    got = {r.record_id: r for r in warc.read_pages(*warc.write_pages(df)).collect()}
    text = {f"<urn:page:{i}>": (h or "").encode() for i, _, h in rows}
    first = {t: min(k for k, v in text.items() if v == t) for t in text.values()}
    for k, t in text.items():
        r = got[k]
        assert (r.payload_bytes, r.payload_digest) == (len(t), warc.sha1(t))
        assert (r.record_type, r.refers_to, bytes(r.payload)) == (("response", None, t) if first[t] == k else ("revisit", first[t], b""))
    assert len(got) == len(rows) and warc.read_pages(*warc.write_pages(df.limit(0))).count() == 0


def test_blocks_are_labelled(spark):
    w = blocks.trained()
    rng = np.random.default_rng(123)
    right = total = 0
    for _ in range(100):
        page = blocks.sample_page(rng)
        p = blocks.label(w, [[b for b, _ in page]])[0]
        right += int(((p >= 0.5) == np.array([y for _, y in page])).sum())
        total += len(page)
    assert right / total > 0.97
    html = '<html><head><title>no</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><script>var t="</p>";</script><div class="cookie">We use cookies</div><article><h1>A &amp; B</h1><p>One\n  two &eacute;.<p><b>Bold<br><p>Last one here.</article><footer>&copy; x</footer>'
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (4, "u", "<<<&&&")]
    got = {r.page_id: r for r in blocks.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect()}
    assert got[1].text == "A & B\nOne two é.\nBold\nLast one here." and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and len(got) == 4


REPORT = """<!doctype html><html><head><title>x</title><body class="tmpl-7"><div id=wrap><div class="gnb"><a href=/>Start</a> <a href=/n>News</a> <a href=/k>Contact</a></div>
<div class="xk-copy"><p>For thirty years nobody crossed the river here by boat, and the road bridge took all the traffic of the valley.</p><p>Then the bridge was closed for repairs, and the old ferryman opened his shed again.</p>
<h2>A second life</h2><p>Today four boats run from dawn to dusk, and the villages have agreed to keep them.</p></div><div class="cookie-bar">We use cookies. <button>Accept</button></div><div id="comments"><div class=comment><p>Great story, thank you!</p></div></div><footer>(c) The Valley Paper.</footer></div>"""


@pytest.mark.parametrize("start", ["<head><title>t</title>", "<svg><path d=1><div>", "<select><option>a<option>b", "<button>Go", "<head><noscript><p>no</p></noscript><title>x</title>"])
def test_elements_left_open_hide_nothing(start):
    assert [b.text for b in blocks.blocks_of(f"{start}<article><p>Main text.</p><p>More of it.</p></article>")] == ["Main text.", "More of it."]


def test_a_page_with_names_never_seen_and_a_long_page():
    w = blocks.trained()
    page = blocks.blocks_of(REPORT)
    main = {b.text for b, y in zip(page, blocks.label(w, [page])[0], strict=True) if y >= 0.5}
    want = {b.text for b in page if ".copy" in b.path}
    assert main <= want and 2 * len(main) >= len(want)
    rng = np.random.default_rng(5)
    page = [b for _ in range(10) for b, _ in blocks.sample_page(rng)]
    assert np.allclose(blocks.label(w, [page])[0], blocks.label(w, [page], cells=17)[0], atol=1e-4)


def odd_documents(spark):
    rows = [(1, "Der schnelle Fuchs läuft durch den Wald und sieht nichts.", "de"), (2, None, "en"), (3, "", None), (4, "12 34 !!", "en"), (None, "x " * 5000, "en"), (1, "The fox runs", "en"), (1, "The fox runs", "en")]
    rows += [(10 + i, f"the quick brown fox number {i} jumps over the lazy dog and runs away", "en") for i in range(30)]
    return spark.createDataFrame([(*r, "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_tokens int")


def test_packing_keeps_every_token(spark):
    import public_tokenizers

    out = packing.pack(odd_documents(spark), public_tokenizers.path("word_bpe_49k.json")).toPandas()
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 2048
    assert len(out[out.piece == 0]) == 37
    assert packing.pack(odd_documents(spark).limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_contaminated_words(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "Zz " + text.upper()), (2, "w1 w2"), (3, None), (4, "short item here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(5, 20))), (8, "short, item"), (9, None)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontam.decontaminate(docs, items).collect()}
    assert got == {1: (41, 15, ["7"]), 2: (2, 0, []), 3: (0, 0, []), 4: (3, 2, ["8"])}


def test_models_take_odd_rows(spark):
    docs = odd_documents(spark)
    pred = langid.predict(docs, langid.fit(docs, ~langid.held_out("doc_id", 4))).collect()
    assert len(pred) == 37 and all(r.lang_pred == "und" for r in pred if r.doc_id in (2, 3, 4)) and all(0 <= r.score <= 1 for r in pred)
    trusted = docs.where("doc_id > 10").select("doc_id")
    kept = kneser.classify(docs, trusted).collect()
    assert len(kept) == 37 and all(r.kept for r in kept if (r.doc_id or 0) > 10)
    scored = hmm.score_corpus(docs, ~langid.held_out("doc_id", 7)).collect()
    assert len(scored) == 37 and all(np.isfinite(r.score) and r.score <= 0 for r in scored)


def test_empty_tables_and_clashing_names(spark):
    docs = odd_documents(spark)
    none = docs.limit(0)
    items = spark.createDataFrame([(7, "a b")], "item_id long, text string")
    assert decontam.decontaminate(none, items).count() == 0 and {r.n_hit for r in decontam.decontaminate(docs, items.limit(0)).collect()} == {0}
    assert hmm.score_corpus(none, ~langid.held_out("doc_id", 7)).count() == 0
    assert langid.predict(none, langid.fit(none, ~langid.held_out("doc_id", 4))).count() == 0
    assert kneser.classify(none, docs.select("doc_id")).count() == 0
    named = docs.withColumnsRenamed({"source": "_text", "n_tokens": "kept"}).withColumn("low", docs.doc_id)
    out = kneser.classify(named, docs.select("doc_id"), keep=("_text", "low", "kept"))
    assert out.columns == ["doc_id", "lang", "_text", "n_bytes", "log10_prob", "perplexity", "low", "high", "kept"] and {r["_text"] for r in out.collect()} == {"s"}


def test_shards_add_up_to_one_model(spark):
    docs = odd_documents(spark).unionByName(odd_documents(spark).where("doc_id = 1"))
    trusted = docs.select("doc_id")
    key = lambda d: sorted((str(r.doc_id), r.n_bytes, round(r.perplexity or 0, 3), r.kept) for r in d.collect())
    assert key(kneser.classify(docs, trusted, shard_entries=2000)) == key(kneser.classify(docs, trusted))
