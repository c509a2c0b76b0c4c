"""Main text of web pages: a bidirectional LSTM labels every text block of a page, seeing the whole page.

A page is cut into blocks of text at block elements. A block is described by its tag path (the element names and words
of class, id and role of its ancestors, hashed), its words (hashed) and a few numbers. The network reads the blocks in
page order in both directions.

There are no labelled pages, so the network is trained on a bounded sample of the given pages in two ways: their text
is put into random layouts, with and without telling element and class names, in which the label of each block is
known; and pages with an ``article`` element are labelled by their elements.
"""

from __future__ import annotations

import html as entities
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.markup import Reader

#: Pages whose text the training layouts use, at most (by the digest of their id), and layouts built from it.
SAMPLED_PAGES, LAYOUTS = 300, 1200
PATH_SIZE, WORD_SIZE, NUMBERS = 192, 64, 8
HIDDEN = 24
INPUT = PATH_SIZE + WORD_SIZE + NUMBERS
#: Words whose slots are kept between pages of a task.
MOST_CACHED = 200_000

#: Elements that never hold shown text, elements that begin a block.
HIDDEN_TEXT = frozenset("script style template svg iframe title textarea select".split())
BLOCKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption section article aside header footer nav main "
    "blockquote pre figure figcaption form fieldset legend hr body html address details summary center".split()
)
#: Elements that an element of the same name closes, up to one of the containers named.
CLOSES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
#: Parts of an article that have another purpose.
OTHER_PARTS = frozenset("nav aside form footer comments comment ad ads related share".split())
WORD = re.compile(r"[^\W_]+")
MARKS, SIGNS = re.compile("[.!?]"), re.compile("[©|»·]")


def _slot(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % size


class Block(NamedTuple):
    """``path``: a bit for each hashed name on the tag path. ``linked``: characters in links. ``article``: whether it
    stands in one, and there not in a part with another purpose (None: in none)."""

    path: int
    text: str
    linked: int
    article: bool | None


class _Frame:
    """An open block element, and the open inline elements in it: what they add to the path, and how often a name is open."""

    __slots__ = ("tag", "inline", "names")

    def __init__(self, tag: str, path: int, article: bool | None):
        self.tag, self.inline, self.names = tag, [(tag, path, article)], Counter()


class _Cutter:
    """Blocks of a page, cut while it is read. An end tag finds its element by counts of open names, at any depth."""

    def __init__(self) -> None:
        self.out: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.frames = [_Frame("", 0, None)]
        self.places: dict[str, list[int]] = {}

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, path, article = self.frames[-1].inline[-1]
            self.out.append(Block(path, text, min(self.linked, len(text)), article))
        self.parts.clear()
        self.linked = 0

    def open(self, tag: str, attributes: dict[str, str]) -> None:
        names = [w.lower() for a in ("class", "id", "role") if a in attributes for w in WORD.findall(attributes[a])]
        _, path, article = self.frames[-1].inline[-1]
        if tag in BLOCKS or names:
            for name in (tag, *names):
                path |= 1 << _slot(name, PATH_SIZE)
                article = True if article is None and name == "article" else article and name not in OTHER_PARTS if article is not None else None
        if tag in BLOCKS:
            self.places.setdefault(tag, []).append(len(self.frames))
            self.frames.append(_Frame(tag, path, article))
        else:
            self.frames[-1].inline.append((tag, path, article))
            self.frames[-1].names[tag] += 1
            self.links += tag == "a"

    def close_frames(self, first: int) -> None:
        while len(self.frames) > first:
            frame = self.frames.pop()
            self.places[frame.tag].pop()
            self.links -= frame.names["a"]

    def close(self, tag: str) -> None:
        if tag in BLOCKS:
            if self.places.get(tag):
                self.close_frames(self.places[tag][-1])
            return
        frame = self.frames[-1]
        while frame.names[tag]:
            name, _, _ = frame.inline.pop()
            frame.names[name] -= 1
            self.links -= name == "a"
            if name == tag:
                return

    def close_alike(self, tag: str) -> None:
        """What a block element closes as it begins: a paragraph, or one of its own kind in the same container."""
        if tag in CLOSES:
            last = lambda name: (self.places.get(name) or [0])[-1]
            if last(tag) > max(map(last, CLOSES[tag])):
                self.close_frames(last(tag))
        elif self.frames[-1].tag == "p":
            self.close_frames(len(self.frames) - 1)


def cut(page: str | None) -> list[Block]:
    """Blocks of a page in order."""
    reader, cutter, skip = Reader(page or ""), _Cutter(), None
    for kind, value, attributes in reader:
        if skip is not None:
            skip = None if kind == "end" and value == skip else skip
        elif kind == "text":
            cutter.parts.append(value)
            if cutter.links:
                cutter.linked += len(value.strip())
        elif kind == "end":
            if value in BLOCKS:
                cutter.flush()
            cutter.close(value)
        elif value == "br":
            cutter.parts.append(" ")
        elif value in HIDDEN_TEXT:
            skip = value if kind == "start" and reader.closes(value) else None
        elif value in BLOCKS:
            cutter.flush()
            cutter.close_alike(value)
            if value != "hr":
                cutter.open(value, attributes)
        elif kind == "start":
            cutter.open(value, attributes)
    cutter.flush()
    return cutter.out


_slots: dict[str, int] = {}


def _word_slots(words: list[str]) -> list[int]:
    if len(_slots) > MOST_CACHED:
        _slots.clear()
    out = []
    for word in words:
        slot = _slots.get(word)
        if slot is None:
            slot = _slots[word] = _slot(word.lower().strip(".,:;!?()"), WORD_SIZE)
        out.append(slot)
    return out


def describe(blocks: list[Block]) -> np.ndarray:
    """Input vectors of the blocks of a page; every name, word and mark of a block counts."""
    out = np.zeros((len(blocks), INPUT), np.float32)
    for i, block in enumerate(blocks):
        path = np.frombuffer(block.path.to_bytes(PATH_SIZE // 8, "little"), np.uint8)
        out[i, :PATH_SIZE] = np.unpackbits(path, bitorder="little")
        words, n = block.text.split(), len(block.text)
        out[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.bincount(_word_slots(words), minlength=WORD_SIZE) / len(words)
        out[i, PATH_SIZE + WORD_SIZE :] = (
            np.log1p(n) / 6, np.log1p(len(words)) / 4, block.linked / n, np.log1p(len(MARKS.findall(block.text))) / 4,
            SIGNS.search(block.text) is not None, i / len(blocks), (len(blocks) - i) / len(blocks), 1.0,
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """One LSTM layer in each direction and a logistic output per block."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"out": draw(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {d + "x": draw(INPUT, 4 * HIDDEN), d + "h": draw(HIDDEN, 4 * HIDDEN), d + "c": np.zeros(4 * HIDDEN, np.float32)}
            self.p[d + "c"][HIDDEN : 2 * HIDDEN] = 1

    def _scan(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states of time-major input (T, B, 4H), already multiplied by the input weights."""
        steps, size = x.shape[0], x.shape[1]
        h, c = np.zeros((size, HIDDEN), np.float32), np.zeros((size, HIDDEN), np.float32)
        hs, trace = np.empty((steps, size, HIDDEN), np.float32), []
        for t in range(steps):
            z = x[t] + h @ self.p[d + "h"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, previous = c, h
            c = f * before + i * g
            s = np.tanh(c)
            h = o * s
            hs[t] = h
            if keep:
                trace.append((i, f, o, g, before, s, previous))
        return hs, trace

    @staticmethod
    def _turn(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each sequence backwards, the padding left at the end."""
        t = np.arange(x.shape[0])[:, None]
        at = np.where(t < lengths, lengths - 1 - t, t)
        return np.take_along_axis(x, at[:, :, None], 0)

    def forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Probability per step and sequence, of time-major input."""
        turned = self._turn(x, lengths)
        f, ft = self._scan(x @ self.p["fx"] + self.p["fc"], "f", keep)
        b, bt = self._scan(turned @ self.p["bx"] + self.p["bc"], "b", keep)
        both = np.concatenate([f, self._turn(b, lengths)], 2)
        return _sigmoid((both @ self.p["out"])[:, :, 0] + self.p["bias"]), (both, turned, ft, bt, f, b)

    def _back(self, grad: np.ndarray, trace: list, x: np.ndarray, d: str, into: dict) -> None:
        w = self.p[d + "h"]
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        dz_all = np.empty((*grad.shape[:2], 4 * HIDDEN), np.float32)
        dw = np.zeros_like(w)
        for t in range(len(trace) - 1, -1, -1):
            i, f, o, g, before, s, previous = trace[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], 1)
            dz_all[t] = dz
            dw += previous.T @ dz
            dh, dc = dz @ w.T, dc * f
        into[d + "h"] = dw
        into[d + "x"] = x.reshape(-1, INPUT).T @ dz_all.reshape(-1, 4 * HIDDEN)
        into[d + "c"] = dz_all.sum((0, 1))

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], passes: int = 5, size: int = 32, rate: float = 0.01, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(passes):
            order = rng.permutation(len(pages))
            for first in range(0, len(order), size):
                chosen = [pages[k] for k in order[first : first + size]]
                x, lengths = pad([c[0] for c in chosen])
                y, real = np.zeros(x.shape[:2], np.float32), np.arange(x.shape[0])[:, None] < lengths
                for b, (_, label) in enumerate(chosen):
                    y[: len(label), b] = label
                p, (both, turned, ft, bt, *_) = self.forward(x, lengths, True)
                error = np.where(real, p - y, 0) / real.sum()
                grad = {"out": both.reshape(-1, 2 * HIDDEN).T @ error.reshape(-1, 1), "bias": error.sum(keepdims=True)[0]}
                up = error[:, :, None] * self.p["out"][None, None, :, 0]
                self._back(up[:, :, :HIDDEN], ft, x, "f", grad)
                self._back(self._turn(up[:, :, HIDDEN:], lengths), bt, turned, "b", grad)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = g * min(1.0, 1.0 / max(norm, 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((max(1, lengths.max()), len(pages), INPUT), np.float32)
    for b, page in enumerate(pages):
        x[: len(page), b] = page
    return x, lengths


# Names that layouts of web pages use for their parts.
CONTENT_NAMES = ["content", "post", "entry-content", "article-body", "story", "main-content", "post-body", "text", "article", "body-copy", "page-content", "single-post", ""]
PARTS = {
    "top": (["header", "div", "div"], ["header", "site-header", "masthead", "top-bar", "branding", "banner-top", "logo"]),
    "menu": (["nav", "div", "ul", "div"], ["menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "main-menu", "links", "tabs"]),
    "side": (["aside", "div", "section"], ["sidebar", "side", "widget", "related", "recommended", "popular", "trending", "see-also", "tags", "teaser"]),
    "notice": (["div", "section", "div"], ["cookie", "cookie-notice", "consent", "notice", "alert", "gdpr", "popup", "modal", "newsletter", "subscribe", "banner", "promo-bar"]),
    "advert": (["div", "ins", "aside"], ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "ad-slot", "commercial"]),
    "form": (["form", "form", "div"], ["search", "signup", "login", "contact-form", "search-form", "subscribe-form"]),
    "comments": (["section", "div", "ol"], ["comments", "comment-list", "responses", "discussion", "replies", "disqus", "comment"]),
    "share": (["div", "ul"], ["share", "social", "social-links", "meta", "byline-links", "toolbar"]),
    "bottom": (["footer", "div", "footer"], ["footer", "site-footer", "copyright", "legal", "colophon", "bottom"]),
}


def layout(rng: np.random.Generator, texts: list[str], words: list[str]) -> tuple[str, list[tuple[str, bool]]]:
    """A page in a random layout, and its blocks in order: text, and whether it belongs to the main text."""
    blocks: list[tuple[str, bool]] = []
    named = rng.random() < 0.85
    pick = lambda items: items[int(rng.integers(len(items)))]
    phrase = lambda low, high: " ".join(pick(words) for _ in range(int(rng.integers(low, high)))) or "x"

    def put(tag: str, text: str, main: bool, inside: str = "") -> str:
        text = " ".join(text.split())
        blocks.append((text, main))
        shown = entities.escape(text, quote=False)
        return f"<{tag}{inside}>" + (f'<a href="/">{shown}</a>' if not main and rng.random() < 0.4 else shown) + f"</{tag}>"

    def part(kind: str) -> str:
        tags, names = PARTS[kind]
        tag, name = pick(tags), pick(names)
        attr = f' {pick(["class", "class", "id"])}="{name}"' if named or tag in ("div", "section", "ol", "ul", "ins") and rng.random() < 0.6 else ""
        inner = []
        if kind in ("menu", "share"):
            item = "li" if tag == "ul" else pick(["li", "div", "p"])
            inner = [put(item, phrase(1, 3), False) for _ in range(int(rng.integers(3, 8)))]
            if item == "li" and tag != "ul":
                inner = ["<ul>", *inner, "</ul>"]
        elif kind == "comments":
            inner = [put(pick(["h2", "h3"]), phrase(1, 3), False)]
            for _ in range(int(rng.integers(1, 5))):
                inner += ["<div class=comment>" if rng.random() < 0.6 else "<div>", put("p", pick(texts) if rng.random() < 0.7 else phrase(4, 40), False), "</div>"]
        elif kind == "form":
            inner = [put(pick(["p", "div"]), phrase(1, 8), False), '<input type="text">', put("p", phrase(1, 3), False)]
        else:
            inner = [put(pick(["p", "div", "p", "h3", "li"]), pick(texts) if kind in ("advert", "side", "notice", "bottom") and rng.random() < 0.25 else phrase(2, 25), False) for _ in range(int(rng.integers(1, 4)))]
            if kind == "bottom" and rng.random() < 0.5:
                inner.append(put("p", "© " + phrase(2, 10), False))
        if len(inner) == 1 and rng.random() < 0.5:  # text straight inside the part
            inner = [re.sub(r"^<\w+>|</\w+>$", "", inner[0])]
        return f"<{tag}{attr}>" + "".join(inner) + f"</{tag}>"

    page = [f'<!DOCTYPE html><html><head><title>{phrase(2, 8)}</title></head><body>']
    wrap = rng.random() < 0.4
    if wrap:
        page.append('<div class="' + pick(["wrapper", "container", "page", "site", "layout"]) + '">')
    before = [k for k, chance in (("notice", 0.25), ("top", 0.5), ("menu", 0.8), ("form", 0.2), ("advert", 0.45), ("side", 0.2)) if rng.random() < chance]
    page += [part(k) for k in before]
    tag = pick(["article", "article", "main", "div", "section"])
    name = pick(CONTENT_NAMES)
    outer = tag == "article" and rng.random() < 0.3
    page.append("<main>" if outer else "")
    page.append(f"<{tag}" + (f' {pick(["class", "id"])}="{name}"' if name and (tag in ("div", "section") or rng.random() < 0.4) else "") + ">")
    if rng.random() < 0.8:
        page.append(put("h1", phrase(2, 12), True))
    for k in range(int(rng.choice([1, 1, 2, 3, 4, 5, 7, 10, 14, 25]))):
        if rng.random() < 0.1:
            page.append(put(pick(["h2", "h3"]), phrase(1, 8), True))
        kind = rng.random()
        text = pick(texts) if rng.random() < 0.85 else phrase(1, 12)
        if kind < 0.8:
            page.append(put("p", text, True))
        elif kind < 0.9:
            page += ["<ul>", *(put("li", phrase(1, 15), True) for _ in range(int(rng.integers(2, 5)))), "</ul>"]
        else:
            page.append(put(pick(["blockquote", "div", "pre"]), text, True))
        if k and rng.random() < 0.05:
            page.append(part(pick(["advert", "share", "form", "notice", "side"])))
    inner_end = [k for k, chance in (("share", 0.15), ("comments", 0.12)) if rng.random() < chance]
    page += [part(k) for k in inner_end]
    page.append(f"</{tag}>" + ("</main>" if outer else ""))
    after = [k for k, chance in (("share", 0.15), ("side", 0.4), ("comments", 0.35), ("form", 0.15), ("advert", 0.25), ("notice", 0.1), ("bottom", 0.85)) if rng.random() < chance]
    page += [part(k) for k in after]
    page.append("</div>" if wrap else "")
    page.append("</body></html>")
    return "".join(page), blocks


def fit(samples: list[str], layouts: int = LAYOUTS, seed: int = 7) -> Network:
    """A network trained on layouts of the texts of ``samples`` (pages), and on those of them that have an article."""
    rng = np.random.default_rng(seed)
    sampled = [cut(page) for page in samples]
    texts = [b.text for page in sampled for b in page if len(b.text) > 60] or ["text of a page without any text to learn from."]
    words = [w for t in texts for w in t.split()]
    pages = []
    for _ in range(layouts):
        page, blocks = layout(rng, texts, words)
        found = cut(page)
        if [b.text for b in found] == [t for t, _ in blocks]:
            pages.append((describe(found), np.array([main for _, main in blocks], np.float32)))
    for found in sampled:
        if any(b.article is not None for b in found):
            pages.append((describe(found), np.array([b.article is True for b in found], np.float32)))
    network = Network(seed)
    network.train(pages, seed=seed)
    return network


CELLS = 6_000


def label(network: Network, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Per page, which blocks belong to the main text. Pages of like length share a padded batch of bounded size."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
    first = 0
    while first < len(order):
        last = first + 1
        while last < len(order) and (last - first + 1) * len(pages[order[last]]) <= CELLS:
            last += 1
        own = order[first:last]
        x, lengths = pad([pages[k] for k in own])
        p, _ = network.forward(x, lengths)
        for b, k in enumerate(own):
            out[k] = p[: lengths[b], b] >= 0.5
        first = last
    return out


def _extract(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = model.value
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                part = batch.slice(first, 128)
                found = [cut(p) for p in part.column(2).to_pylist()]
                kept = label(network, [describe(blocks) for blocks in found])
                texts = ["\n".join(block.text for block, k in zip(blocks, keep, strict=True) if k) for blocks, keep in zip(found, kept, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars", "n_blocks"],
                )

    return run


def _fit(layouts: int):
    def run(sample: pa.Table) -> pa.Table:
        return pa.table({"network": pa.array([pickle.dumps(fit(sample.sort_by("key")["html"].to_pylist(), layouts).p)], pa.binary())})

    return run


def main_text(pages: DataFrame, layouts: int = LAYOUTS, sampled: int = SAMPLED_PAGES) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars, n_blocks.

    Blocks are joined in page order by a line feed; inside a block, character references are decoded once and white
    space is one space. A null or empty page has the empty text. Broken markup is read as far as it goes: unclosed
    elements end with their container, a plain ``<`` is text. Repeated rows are read each for itself. Other columns are
    ignored. The network is trained in one task, on the whole html of at most ``sampled`` pages and on ``layouts``
    layouts of their texts; each page is then read whole.
    """
    spark = pages.sparkSession
    given = pages.select("page_id", "url", "html")
    # The pages are chosen by their ids, so that a task sends ids and no pages; then they are fetched.
    filled = given.where("html is not null").withColumn("key", F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    chosen = filled.select("key").distinct().orderBy("key").limit(sampled)
    found = filled.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("html").alias("html"))
    fitted = found.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_fit(layouts), "network binary").collect()
    network = Network()
    if fitted:
        network.p = pickle.loads(fitted[0].network)
    schema = f"page_id {given.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long, n_blocks long"
    return given.mapInArrow(_extract(spark.sparkContext.broadcast(network)), schema)
