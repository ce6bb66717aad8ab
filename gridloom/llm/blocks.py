"""Main text of web pages by a recurrent block labeller.

A page is read as its sequence of leaf blocks. Every block is a vector of its hashed tag path (names,
classes, ids, roles of all open elements), hashed words and a few counts; a bidirectional LSTM in
numpy reads the whole sequence, so each block is judged in the context of the document. The model is
trained on pages that ``sample_page`` composes with known labels, a fixed number whatever the input.

Defined results: null or empty html, or no main block, gives an empty text; markup may be cut off or
badly nested; repeated rows are kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

TAGS, PATH, WORDS, MORE = 64, 192, 32, 8  # tag names have TAGS of the PATH places to themselves
DIM = PATH + WORDS + MORE
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
HIDDEN = frozenset("script style template noscript head title svg iframe object select textarea button".split())
_ITEM = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Fixed values of the HTML standard: what may stand in a head, and what ends svg content left open.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_ENDS_SVG = frozenset("blockquote body center dd div dl dt embed h1 h2 h3 h4 h5 h6 head hr img li menu meta ol p pre table ul".split()) | frozenset("article aside footer header main nav section form".split())
_NOT_IN_CONTROL = frozenset("article aside blockquote body dl footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split())
#: Elements left open, and the start tags that end them.
_ENDED = {"head": None, "svg": _ENDS_SVG, "select": _NOT_IN_CONTROL | {"div", "input", "textarea", "select"}, "button": _NOT_IN_CONTROL | {"button"}}
_SPLIT = re.compile(r"[^a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int
    parts: list[str] = field(default_factory=list)


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.hidden = 0
        self.links = 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, tuple(t for n, ts in self.open if n not in INLINE for t in ts), self.linked))
        self.parts, self.linked = [], 0

    def _pop(self, to: int):
        for n, _ in self.open[to:]:
            self.hidden -= n in HIDDEN
            self.links -= n == "a"
        del self.open[to:]

    def _end_implied(self, tag: str):
        """End what was left open and cannot hold ``tag``."""
        for i, (n, _) in enumerate(self.open):
            if n in _ENDED and (tag not in _IN_HEAD if n == "head" else tag in _ENDED[n]) and not any(m in ("foreignobject", "noscript", "template") for m, _ in self.open[i:]):
                self.flush()
                return self._pop(i)
        return None

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            self._end_implied(tag)
        if tag == "br":
            self.parts.append(" ")
        if tag not in INLINE:
            self.flush()
            shut = _ITEM.get(tag, set()) | {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
            for i in range(len(self.open) - 1, max(-1, len(self.open) - 12), -1):
                n = self.open[i][0]
                if n in shut:
                    self._pop(i)
                    break
                if n not in INLINE:
                    break
            if tag == "body" and self.hidden:
                self._pop(next(i for i, (n, _) in enumerate(self.open) if n in HIDDEN))
        if tag in VOID:
            return
        names = [tag]
        for k, v in attrs:
            if k in ("class", "id", "role", "itemprop") and v:
                names += [f".{w}" for w in _SPLIT.split(v.lower()) if w]
        self.open.append((tag, tuple(names)))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        if tag not in VOID:
            return self.handle_starttag(tag, attrs)
        if tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                return self._pop(i)
            if tag in INLINE and self.open[i][0] not in INLINE:
                return None
        return None

    def handle_data(self, data):
        if self.hidden and self.open[-1][0] == "head" and data.strip():
            self._end_implied("")
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def blocks_of(html: str | None) -> list[Block]:
    """Visible leaf blocks in page order, references decoded and white space collapsed."""
    r = _Reader()
    r.feed(html or "")
    r.close()
    r.flush()
    return r.blocks


def _digest(word: str, size: int) -> tuple[int, float]:
    h = xxhash.xxh64_intdigest(word)
    return h % size, 1.0 if h >> 63 else -1.0


_known = lru_cache(1 << 14)(_digest)


def _place(word: str, size: int) -> tuple[int, float]:
    return _known(word, size) if len(word) <= 64 else _digest(word, size)


def features(blocks: list[Block], first: int = 0, n: int | None = None) -> np.ndarray:
    """Vectors of blocks that stand from ``first`` on among the n of their page."""
    x = np.zeros((len(blocks), DIM), np.float32)
    n = n or len(blocks)
    for k, b in enumerate(blocks):
        i = first + k
        for t in set(b.path) | {"/".join(b.path[-2:])}:
            tag = bool(t) and t[0] != "." and "/" not in t
            p, s = _place(t, TAGS if tag else PATH - TAGS)
            x[k, p if tag else p + TAGS] += s
        words = b.text.lower().split()
        for w in words:
            p, s = _place(w, WORDS)
            x[k, PATH + p] += s
        x[k, PATH : PATH + WORDS] /= max(1, len(words)) ** 0.5
        size = len(b.text)
        x[k, PATH + WORDS :] = (np.log1p(size) / 5, min(1, b.linked / size), b.text[-1] in ".!?…\"", len(words) < 5, len(words) > 20, i / n, (n - i) / n, len(b.path) / 10)
    return x


# a page with known labels


_JUNK = {
    "nav": (["<nav>", '<div class="menu">', '<ul class="nav navbar">', '<div id="navigation">', '<div class="breadcrumb">', '<div class="pagination">'], "list"),
    "header": (["<header>", '<div class="header">', '<div id="masthead">', '<div class="top bar">', '<div class="logo branding">'], "short"),
    "footer": (["<footer>", '<div class="footer">', '<div id="footer">', '<div class="copyright">'], "short"),
    "side": (["<aside>", '<div class="sidebar">', '<div class="widget">', '<div class="related">', '<section class="recommended">'], "both"),
    "notice": (['<div class="cookie">', '<div class="consent banner">', '<div class="notice">', '<div class="popup modal">', '<div class="newsletter subscribe">', '<div role="alert">'], "both"),
    "ad": (['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="sponsored">', '<div id="promo">', '<ins class="adsbygoogle">', '<div class="advertisement">'], "both"),
    "comments": (['<section class="comments">', '<div id="comments">', '<div class="comment">', '<ol class="commentlist">', '<div class="disqus thread">', '<div class="replies">'], "long"),
    "form": (["<form>", '<form class="search">', '<form id="login">', '<form class="contact">'], "form"),
    "share": (['<div class="share">', '<div class="social">', '<ul class="tags">'], "list"),
}
_ROOTS = ["<article>", "<main>", '<div class="content">', '<div class="post entry">', '<div id="main">', '<div class="article body">', '<section class="story">', "<div>", '<div class="text">']


def sample_page(rng: np.random.Generator) -> list[tuple[Block, bool]]:
    """Blocks of a composed page and whether each is main text."""
    syllables = ["an", "re", "tion", "the", "ou", "sch", "ei", "qu", "os", "ción", "la", "er", "in", "ver", "ment", "te", "ka", "mi", "do", "lu", "ß", "é", "ñ"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 5)))
    say = lambda a, b: " ".join(word() for _ in range(rng.integers(a, b))).capitalize() + ("." if rng.random() < 0.8 else "")
    name = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 8)))
    odd = rng.random() < 0.15  # a page whose names say little
    own = lambda: f' class="{name()}-{name()}"' if odd and rng.random() < 0.5 else ""
    shut = lambda tag: f"</{re.match(r'<(\w+)', tag)[1]}>"

    def junk(kind: str) -> str:
        tags, shape = _JUNK[kind]
        tag = tags[rng.integers(len(tags))]
        link = lambda: f'<a href="/x">{say(1, 4)}</a>'
        if shape == "list" or (shape == "both" and rng.random() < 0.3):
            body = "".join(f"<li>{link()}</li>" for _ in range(rng.integers(2, 8)))
            body = body if tag.startswith(("<ul", "<ol")) or rng.random() < 0.3 else f"<ul>{body}</ul>"
        elif shape == "form":
            body = f"<label>{say(1, 4)}</label><input><p>{say(2, 9)}</p>"
        elif shape == "long":
            body = "".join(f'<div class="{rng.choice(["comment", "reply", "c"])}"><p>{say(3, 50)}</p></div>' for _ in range(rng.integers(1, 5)))
        else:
            text = say(2, 40 if shape == "both" else 14)
            if kind == "footer" and rng.random() < 0.6:
                text = rng.choice(["© ", "(c) ", "Copyright "]) + text
            body = rng.choice([text, f"<p>{text}</p>", f"<h3>{say(1, 5)}</h3><p>{text}</p>", f"{text} {link()}"])
        if odd and tag.endswith('">') and rng.random() < 0.5:
            tag = f'{tag[:-2]} {name()}">' if rng.random() < 0.5 else f'{tag[:-2]}-{name()}">'
        return tag + body + shut(tag)

    def main() -> list[tuple[str, bool]]:
        out = [(f"<h1{own()}>{say(2, 12)}</h1>" if rng.random() < 0.8 else f"<header{own()}><h1>{say(2, 9)}</h1></header>", True)] if rng.random() < 0.9 else []
        short = rng.random() < 0.1  # a long page of short paragraphs
        for _ in range(rng.integers(1, 14) if rng.random() < 0.95 else rng.integers(14, 30)):
            r = rng.random()
            text = say(1, 12) if short or rng.random() < 0.25 else say(12, 90)
            if r < 0.62:
                out.append((f"<p{own()}>{text}</p>" if rng.random() < 0.8 else f"<p><b>{text}<br>", True))
            elif r < 0.7:
                out.append((f"<h2{own()}>{say(1, 8)}</h2>", True))
            elif r < 0.77:
                out.append(("<ul>" + "".join(f"<li>{say(2, 20)}</li>" for _ in range(rng.integers(2, 6))) + "</ul>", True))
            elif r < 0.81:
                out.append((f"<blockquote><p>{text}</p></blockquote>", True))
            elif r < 0.84:
                out.append((f"<table><tr><td>{say(1, 6)}</td><td>{say(1, 6)}</td></tr></table>", True))
            elif r < 0.87:
                out.append((f"<pre>{say(3, 20)}</pre>", True))
            elif r < 0.92:
                out.append((f'<p>{text} <a href="/y">{say(1, 4)}</a> {say(3, 12)}</p>', True))
            else:
                out.append((junk(rng.choice(["ad", "side", "share", "notice", "form"])), False))
        return out

    root = _ROOTS[rng.integers(len(_ROOTS) if rng.random() < 0.7 else 2)]
    pieces = [(junk(k), False) for k in ("notice", "header", "nav", "ad", "form", "side") if rng.random() < 0.5]
    if odd:
        root = f'<div class="{name()}-{name()}">' if rng.random() < 0.6 else f'{root[:-1]}{own() if "class" not in root else ""}>'
    wrap = int(rng.integers(1, 4)) if odd else 0
    around = "".join(f'<div {rng.choice(["class", "id"])}="{name()}{rng.choice(["", "-" + name()])}">' for _ in range(wrap))
    pieces = [(around, None), *pieces] if rng.random() < 0.5 else [*pieces, (around, None)]
    pieces += [(root, None), *main()]
    if rng.random() < 0.2:
        pieces.append((junk("comments"), False))
    pieces.append((shut(root), None))
    pieces += [(junk(k), False) for k in ("share", "comments", "ad", "side", "form", "footer", "notice") if rng.random() < 0.45]
    reader, labels = _Reader(), []
    for html, good in [("<html><body>", None), *pieces]:
        reader.feed(html)
        if good is not None:
            reader.flush()
        labels += [bool(good)] * (len(reader.blocks) - len(labels))
    reader.close()
    reader.flush()
    labels += [False] * (len(reader.blocks) - len(labels))
    return list(zip(reader.blocks, labels, strict=True))


# the network


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _cell(w: dict, d: str, x: np.ndarray, mask: np.ndarray, keep: bool, state: list | None = None):
    """Run one direction over x (time, batch, DIM); states of absent steps are carried on, and from one call to
    the next in ``state``."""
    t_, b, _ = x.shape
    size = w[d + "u"].shape[0]
    h, c = state or (np.zeros((b, size), np.float32), np.zeros((b, size), np.float32))
    gates = x.reshape(-1, DIM) @ w[d + "w"] + w[d + "b"]
    gates = gates.reshape(t_, b, -1)
    out, tape = np.zeros((t_, b, size), np.float32), []
    for t in range(t_) if d == "f" else range(t_ - 1, -1, -1):
        z = gates[t] + h @ w[d + "u"]
        i, f, o = np.split(_sigmoid(z[:, : 3 * size]), 3, 1)
        g, m = np.tanh(z[:, 3 * size :]), mask[t][:, None]
        c2 = f * c + i * g
        tc = np.tanh(c2)
        if keep:
            tape.append((t, h, c, i, f, o, g, tc, m))
        h, c = m * (o * tc) + (1 - m) * h, m * c2 + (1 - m) * c
        out[t] = h
    if state is not None:
        state[:] = h, c
    return out, tape


def _cell_back(w: dict, d: str, x, tape, dout, grad):
    dh = dc = 0
    dz_all = np.zeros((x.shape[0], x.shape[1], w[d + "b"].shape[0]), np.float32)
    for t, h, c, i, f, o, g, tc, m in reversed(tape):
        dh_t = dout[t] + dh
        live = dh_t * m
        dc_t = (dc * m if not np.isscalar(dc) else 0) + live * o * (1 - tc * tc)
        dz = np.concatenate([dc_t * g * i * (1 - i), dc_t * c * f * (1 - f), live * tc * o * (1 - o), dc_t * i * (1 - g * g)], 1)
        grad[d + "u"] += h.T @ dz
        dz_all[t] = dz
        dh = dz @ w[d + "u"].T + dh_t * (1 - m)
        dc = dc_t * f + (dc * (1 - m) if not np.isscalar(dc) else 0)
    flat = dz_all.reshape(-1, dz_all.shape[2])
    grad[d + "w"] += x.reshape(-1, DIM).T @ flat
    grad[d + "b"] += flat.sum(0)


def _padded(pages: list[np.ndarray]):
    t = max(len(p) for p in pages)
    x, mask = np.zeros((t, len(pages), DIM), np.float32), np.zeros((t, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


@lru_cache(2)
def trained(pages: int = 600, epochs: int = 14, size: int = 16, seed: int = 9) -> dict:
    rng = np.random.default_rng(seed)
    data = [([b for b, _ in p], np.array([y for _, y in p], np.float32)) for p in (sample_page(rng) for _ in range(pages)) if p]
    data = [(features(b), y) for b, y in data]
    w = {}
    for d in "fb":
        w |= {d + "w": rng.normal(0, 0.1, (DIM, 4 * size)), d + "u": rng.normal(0, 0.15, (size, 4 * size)), d + "b": np.r_[np.zeros(size), np.ones(size), np.zeros(2 * size)]}
    w |= {"v": rng.normal(0, 0.2, (2 * size + DIM,)), "c": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), 25):
            some = [data[i] for i in order[a : a + 25]]
            x, mask = _padded([f for f, _ in some])
            y = np.zeros_like(mask)
            for k, (_, v) in enumerate(some):
                y[: len(v), k] = v
            hf, tf = _cell(w, "f", x, mask, True)
            hb, tb = _cell(w, "b", x, mask, True)
            full = np.concatenate([hf, hb, x], 2)
            e = (_sigmoid(full @ w["v"] + w["c"]) - y) * mask / mask.sum()
            grad = {k: np.zeros_like(v) for k, v in w.items()}
            grad["v"], grad["c"] = (full * e[:, :, None]).sum((0, 1)), e.sum(keepdims=True).reshape(1)
            dout = e[:, :, None] * w["v"][: 2 * size]
            _cell_back(w, "f", x, tf, dout[:, :, :size], grad)
            _cell_back(w, "b", x, tb, dout[:, :, size:], grad)
            step += 1
            rate = 0.01 * (1 - 0.8 * epoch / epochs)
            for k in w:
                g = grad[k] + 1e-5 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return w


def _label_long(w: dict, blocks: list[Block], run: int) -> np.ndarray:
    """A page of any number of blocks, of which the vectors of one run at a time are held."""
    n, size = len(blocks), w["fu"].shape[0]
    starts = list(range(0, n, run))
    back, state = np.zeros((n, size), np.float32), []
    part = lambda a: features(blocks[a : a + run], a, n)[:, None]
    for a in reversed(starts):
        x = part(a)
        back[a : a + run] = _cell(w, "b", x, np.ones(x.shape[:2], np.float32), False, state)[0][:, 0]
    out, state = np.zeros(n, np.float32), []
    for a in starts:
        x = part(a)
        ahead = _cell(w, "f", x, np.ones(x.shape[:2], np.float32), False, state)[0][:, 0]
        out[a : a + run] = _sigmoid(np.concatenate([ahead, back[a : a + run], x[:, 0]], 1) @ w["v"] + w["c"])
    return out


def label(w: dict, pages: list[list[Block]], cells: int = 40_000) -> list[np.ndarray]:
    """Probability of being main text for each block; pages of like length are run together."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    while order:
        top = len(pages[order[-1]])
        if top > cells:
            i = order.pop()
            out[i] = _label_long(w, pages[i], cells)
            continue
        some = order[-max(1, cells // top) :]
        del order[-len(some) :]
        x, mask = _padded([features(pages[i]) for i in some])
        full = np.concatenate([_cell(w, "f", x, mask, False)[0], _cell(w, "b", x, mask, False)[0], x], 2)
        p = _sigmoid(full @ w["v"] + w["c"])
        for k, i in enumerate(some):
            out[i] = p[: len(pages[i]), k]
    return out


def _extract(model):
    def run(it):
        w = model.value
        for b in it:
            pages = [blocks_of(h) for h in b.column("html").to_pylist()]
            texts = ["\n".join(x.text for x, y in zip(p, q, strict=True) if y >= 0.5) for p, q in zip(pages, label(w, pages), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", model: dict | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    store.batches(spark, 500)
    shared = store.share(spark, model or trained())
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return p.mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
