"""Main text of web pages: a recurrent labeller over the sequence of a page's blocks.

A bidirectional LSTM in numpy reads, for every block, the mean of learnt vectors of its tag path,
a hashed vector of all its words, and a few measures, and decides for each block in the
light of the whole page whether it is part of the article. It is trained on pages of the table
whose mark-up names the article, and on the same texts in other layouts, drawn at random.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.llm import text as words
from planlens.llm.html_blocks import Block, blocks

PATHS = 2048  # hashed path names
PATH_SIZE = 24
WORD_SIZE = 32  # hashed words
MEASURES = 8
HIDDEN = 20
INPUT = PATH_SIZE + WORD_SIZE + MEASURES
SAMPLE_PAGES = 240  # pages of the table used for training, by a hash of their id
SAMPLE_CHARS = 20_000  # a longer page isn't used for training
LAYOUTS = 700  # pages drawn at random from their texts
EPOCHS = 14
BATCH = 32
MAIN = 0.5  # chance from which a block is part of the article


# -- what a block looks like ---------------------------------------------------


def path_codes(path: tuple[str, ...]) -> list[int]:
    """Hashed names of the path, with the last tag marked once more as such."""
    code = lambda x: zlib.crc32(x.encode()) % PATHS
    tags = [x for x in path if x[0] != "@"]
    return [code(x) for x in dict.fromkeys(path)] + [code(">" + (tags[-1] if tags else ""))]


@dataclass
class Pages:
    """Blocks of several pages: flat arrays, with the bounds of each page."""

    bounds: np.ndarray  # of pages in blocks
    codes: np.ndarray  # flat path codes
    code_bounds: np.ndarray  # of blocks in codes
    plain: np.ndarray  # (blocks, WORD_SIZE + MEASURES)


def describe(pages: list[list[Block]]) -> Pages:
    flat = [b for page in pages for b in page]
    codes = [path_codes(b.path) for b in flat]
    data, offsets = words.buffers(pa.array([b.text for b in flat], pa.large_string()))
    hashed, at = words.word_hashes(data, offsets)
    n = len(flat)
    counts = np.diff(at)
    owner = np.repeat(np.arange(n), counts)
    cell = owner * WORD_SIZE + (hashed % np.uint64(WORD_SIZE)).astype(np.int64)
    sign = np.where((hashed >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    bag = np.bincount(cell, sign, n * WORD_SIZE).astype(float).reshape(n, WORD_SIZE)
    bag /= np.sqrt(np.maximum(counts, 1))[:, None]
    chars = np.array([len(b.text) for b in flat], float)
    safe = np.maximum(chars, 1)
    of = lambda f: np.array([f(b.text) for b in flat], float)
    measures = np.column_stack([
        np.log1p(chars) / 4, np.log1p(counts) / 3, np.array([b.linked for b in flat], float) / safe,
        np.array([min(b.depth, 20) for b in flat], float) / 10,
        of(lambda t: t[-1:] in ".!?:;\"'") if n else np.zeros(0),
        of(lambda t: t.count(",") + t.count(". ")) / safe * 20,
        chars / max(chars.sum(), 1) if len(pages) == 1 else _share(chars, pages),
        _position(pages),
    ]) if n else np.zeros((0, MEASURES))
    return Pages(
        np.cumsum([0] + [len(p) for p in pages]), np.array([c for x in codes for c in x], np.int64),
        np.cumsum([0] + [len(x) for x in codes]), np.column_stack([bag, measures]).astype(np.float32),
    )


def _share(chars: np.ndarray, pages: list[list[Block]]) -> np.ndarray:
    """Of each block in its page's characters."""
    sizes = np.array([len(p) for p in pages])
    owner = np.repeat(np.arange(len(pages)), sizes)
    return chars / np.maximum(np.bincount(owner, chars, len(pages)), 1)[owner]


def _position(pages: list[list[Block]]) -> np.ndarray:
    return np.concatenate([np.arange(len(p)) / max(len(p), 1) for p in pages] or [np.zeros(0)])


# -- the network ---------------------------------------------------------------


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """Weights by name, forward and backward passes over padded batches of pages."""

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, by: (rng.normal(0, by, shape)).astype(np.float32)
        self.w = {"path": normal(PATHS, PATH_SIZE, by=0.5)}
        for d in "fb":
            self.w["x" + d] = normal(INPUT, 4 * HIDDEN, by=INPUT**-0.5)
            self.w["h" + d] = normal(HIDDEN, 4 * HIDDEN, by=HIDDEN**-0.5)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1  # remember at first
            self.w["c" + d] = bias
        self.w["out"] = normal(2 * HIDDEN + INPUT, by=0.1)
        self.w["bias"] = np.zeros(1, np.float32)

    def inputs(self, pages: Pages) -> np.ndarray:
        sums = np.add.reduceat(self.w["path"][pages.codes], pages.code_bounds[:-1], axis=0)
        return np.column_stack([sums / np.diff(pages.code_bounds)[:, None], pages.plain]).astype(np.float32)

    def _run(self, d: str, x: np.ndarray, keep: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states over time; ``keep`` is 0 past a page's end, where state stands still."""
        pre = x @ self.w["x" + d] + self.w["c" + d]
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        recurrent = self.w["h" + d]
        for t in range(len(x)):
            z = pre[t] + h @ recurrent
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            c_new = f * c + i * g
            tanh_c = np.tanh(c_new)
            k = keep[t][:, None]
            if trace is not None:
                trace.append((h, c, i, f, o, g, tanh_c))
            h, c = k * (o * tanh_c) + (1 - k) * h, k * c_new + (1 - k) * c
            out[t] = h
        return out

    @staticmethod
    def _pad(pages: Pages, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(forward, backward) block numbers and the mask, (time, page)."""
        sizes = np.diff(pages.bounds)[rows]
        t = np.arange(sizes.max())[:, None]
        keep = t < sizes
        starts = pages.bounds[rows]
        forward = np.where(keep, starts + t, starts)
        backward = np.where(keep, starts + sizes - 1 - t, starts)
        return forward, backward, keep

    def chances(self, pages: Pages) -> np.ndarray:
        """For every block, of being part of the article."""
        p = np.zeros(int(pages.bounds[-1]))
        sizes = np.diff(pages.bounds)
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        if not len(order):
            return p
        x = self.inputs(pages)
        at = 0
        while at < len(order):  # pages of like length together, 64 thousand places at a time
            past = at + 1
            while past < len(order) and past - at < 256 and (past + 1 - at) * sizes[order[past]] <= 65536:
                past += 1
            forward, backward, keep = self._pad(pages, order[at:past])
            states = np.zeros((len(x), 2 * HIDDEN), np.float32)
            mask = keep.astype(np.float32)
            states[forward[keep], :HIDDEN] = self._run("f", x[forward], mask)[keep]
            states[backward[keep], HIDDEN:] = self._run("b", x[backward], mask)[keep]
            mine = forward[keep]
            z = np.column_stack([states[mine], x[mine]]) @ self.w["out"] + self.w["bias"]
            p[mine] = _sigmoid(z)
            at = past
        return p

    def gradients(self, pages: Pages, rows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the blocks of ``rows``."""
        x = self.inputs(pages)
        forward, backward, keep = self._pad(pages, rows)
        mask = keep.astype(np.float32)
        traces = {"f": [], "b": []}
        places = {"f": forward, "b": backward}
        states = np.zeros((len(x), 2 * HIDDEN), np.float32)
        for k, d in enumerate("fb"):
            run = self._run(d, x[places[d]], mask, traces[d])
            states[places[d][keep], k * HIDDEN:(k + 1) * HIDDEN] = run[keep]
        mine = forward[keep]
        joined = np.column_stack([states[mine], x[mine]])
        error = (_sigmoid(joined @ self.w["out"] + self.w["bias"]) - target[mine]) / len(mine)
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["out"], grad["bias"] = joined.T @ error, np.array([error.sum()], np.float32)
        back = error[:, None] * self.w["out"][None]
        to_state = np.zeros_like(states)
        to_x = np.zeros_like(x)
        to_state[mine], to_x[mine] = back[:, :2 * HIDDEN], back[:, 2 * HIDDEN:]
        for k, d in enumerate("fb"):
            place, wx, wh = places[d], self.w["x" + d], self.w["h" + d]
            seen = to_state[:, k * HIDDEN:(k + 1) * HIDDEN]
            dh = np.zeros((len(rows), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t in range(len(place) - 1, -1, -1):
                h, c, i, f, o, g, tanh_c = traces[d][t]
                m = mask[t][:, None]
                dh = dh + m * seen[place[t]]
                through = m * dh
                dc_new = m * dc + through * o * (1 - tanh_c**2)
                dz = np.concatenate([
                    dc_new * g * i * (1 - i), dc_new * c * f * (1 - f),
                    through * tanh_c * o * (1 - o), dc_new * i * (1 - g**2),
                ], axis=1)
                now = x[place[t]]
                grad["x" + d] += now.T @ dz
                grad["h" + d] += h.T @ dz
                grad["c" + d] += dz.sum(0)
                np.add.at(to_x, place[t], dz @ wx.T)
                dh = dz @ wh.T + (1 - m) * dh
                dc = dc_new * f + (1 - m) * dc
        sizes = np.diff(pages.code_bounds)
        per_code = np.repeat(to_x[:, :PATH_SIZE] / sizes[:, None], sizes, axis=0)
        np.add.at(grad["path"], pages.codes, per_code)
        return grad


def train(pages: list[list[Block]], labels: list[list[bool]], epochs: int = EPOCHS) -> Labeller:
    """Adam over batches of pages of like length."""
    net = Labeller()
    rng = np.random.default_rng(9)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    groups = [order[k:k + BATCH] for k in range(0, len(order), BATCH)]
    ready = [
        (describe([pages[i] for i in g]), np.array([v for i in g for v in labels[i]], np.float32))
        for g in groups
    ]
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for epoch in range(epochs):
        rate = 0.02 if epoch < epochs * 0.6 else 0.005
        for k in rng.permutation(len(ready)):
            described, target = ready[k]
            grad = net.gradients(described, np.arange(len(described.bounds) - 1), target)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for name, g in grad.items():
                g = g * min(1.0, 5 / max(norm, 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                change = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                net.w[name] = (net.w[name] - rate * change).astype(np.float32)
    return net


# -- pages to learn from -------------------------------------------------------

# Names by which sites mark what isn't the article, and what is.
ASIDE = {
    "menu": "menu navbar navigation topnav breadcrumb tabs mainmenu site-nav links toc",
    "header": "header masthead banner top site-header branding logo tagline",
    "footer": "footer bottom copyright colophon site-footer legal imprint",
    "sidebar": "sidebar aside rail widget related recommended popular trending secondary more-stories",
    "notice": "cookie consent notice alert gdpr popup modal newsletter subscribe paywall message",
    "advert": "ad ads advert advertisement sponsor sponsored promo banner-ad adsbox",
    "form": "search login signup contact-form form subscribe-form",
    "comments": "comments comment replies discussion responses disqus reader-comments comment-list",
    "share": "share social author-bio byline tags meta share-buttons",
}
ARTICLE = "article content post entry main-content post-body entry-content article-body story text body-copy"
_SAID = (
    "Home|About us|Contact|Log in|Sign up|Subscribe to our newsletter|We use cookies to improve this site.|"
    "Accept all|Read more|Share|Follow us|All rights reserved.|Privacy policy|Terms of use|Search|Submit|"
    "Reply|Posted by a reader|Great article, thanks!|I do not agree with this.|Related stories|Most read|"
    "Advertisement|Buy now|Impressum|Datenschutz|Mentions légales|Aviso legal|Kommentare|Commentaires"
).split("|")
_OUTSIDE = frozenset("nav aside footer header form button select textarea label option title head dialog menu".split())
_NOT_MAIN = frozenset("@" + n for x in ASIDE.values() for n in re.findall("[a-z]+", x)) - {
    "@top", "@text", "@main", "@more", "@message", "@meta", "@stories", "@post", "@site", "@body", "@list"
}


def marked_labels(page: list[Block]) -> list[bool] | None:
    """Which blocks the page's own mark-up puts into the article; None if it names none."""
    out = []
    for b in page:
        tags = set(b.path)
        inside = ("article" in tags or "main" in tags) and not tags & _NOT_MAIN
        out.append(inside and not (tags & (_OUTSIDE - {"header"})))
    return out if any(out) else None


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


class _Layout:
    """A random page around given texts, with the label of every block it writes."""

    def __init__(self, rng: np.random.Generator, main: list[str], other: list[str]) -> None:
        self.rng, self.other = rng, other
        self.html: list[str] = []
        self.labels: list[bool] = []
        parts = [self._side(k) for k in ("header", "menu", "notice", "advert", "sidebar", "share")]
        before = [p for p in parts if rng.random() < 0.55]
        after = [self._side(k) for k in ("sidebar", "share", "advert", "notice", "form", "menu") if rng.random() < 0.4]
        if rng.random() < 0.6:
            after.append(self._side("comments"))
        rng.shuffle(after)
        after.append(self._side("footer"))
        if rng.random() < 0.9:
            self._leaf("title", main[0][:60] or "x", False, head=True)
        for part in before:
            part()
        self._article(main)
        for part in after:
            part()

    def _say(self) -> str:
        if self.rng.random() < 0.5 or not self.other:
            return str(self.rng.choice(_SAID))
        return self.other[self.rng.integers(len(self.other))]

    def _leaf(self, tag: str, text: str, label: bool, head: bool = False, link: bool = False) -> None:
        body = _escape(text)
        body = f'<a href="/x">{body}</a>' if link else body
        if label and self.rng.random() < 0.2:
            body = f"<b>{body}</b>" if self.rng.random() < 0.7 else f"<b>{body}<br>"
        close = "" if tag == "p" and self.rng.random() < 0.15 else f"</{tag}>"
        self.html.append(f"<head><{tag}>{body}</{tag}></head>" if head else f"<{tag}>{body}{close}")
        self.labels.append(label)

    def _open(self, plain: list[str], called: str) -> str:
        tag = str(self.rng.choice(plain))
        name = str(self.rng.choice(called.split()))
        how = self.rng.random()
        named = tag in ("div", "section", "ul") or how < 0.4
        attribute = f' {self.rng.choice(["class", "id"])}="{name}"' if named else ""
        self.html.append(f"<{tag}{attribute}>")
        return tag

    def _side(self, kind: str):
        plain = {
            "menu": ["nav", "div", "ul", "nav"], "header": ["header", "div"], "footer": ["footer", "div", "footer"],
            "sidebar": ["aside", "div"], "notice": ["div", "section"], "advert": ["div", "aside"],
            "form": ["form"], "comments": ["section", "div"], "share": ["div"],
        }[kind]

        def write() -> None:
            tag = self._open(plain, ASIDE[kind])
            if kind in ("menu", "sidebar", "share", "header") and self.rng.random() < 0.8:
                self.html.append("<ul>")
                for _ in range(self.rng.integers(2, 9)):
                    self._leaf("li", " ".join(self._say().split()[:3]) or "x", False, link=self.rng.random() < 0.9)
                self.html.append("</ul>")
            elif kind == "comments":
                for _ in range(self.rng.integers(1, 6)):
                    self.html.append('<div class="comment">')
                    if self.rng.random() < 0.5:
                        self._leaf("h4", "Reader", False)
                    self._leaf("p", self._say(), False)
                    self.html.append("</div>")
            elif kind == "form":
                self._leaf("label", self._say(), False)
                self._leaf("button", "Submit", False)
            elif self.rng.random() < 0.5:
                self._leaf("p", self._say(), False)
            else:  # text right inside
                self.html.append(_escape(self._say()))
                self.labels.append(False)
            self.html.append(f"</{tag}>")

        return write

    def _article(self, main: list[str]) -> None:
        how = self.rng.random()
        outer = self._open(["main", "div"], ARTICLE) if how < 0.4 else None
        tag = self._open(["article", "article", "div", "section", "main"], ARTICLE)
        if self.rng.random() < 0.8:
            self._leaf("h1", main[0][:80] or "x", True)
        for k, text in enumerate(main):
            self._leaf(str(self.rng.choice(["p", "p", "p", "p", "h2", "li", "blockquote"])) if k else "p", text, True)
            if self.rng.random() < 0.06:
                self._side(str(self.rng.choice(["advert", "share", "sidebar", "notice"])))()
        if self.rng.random() < 0.15:
            self._side("comments")()
        self.html.append(f"</{tag}>")
        if outer:
            self.html.append(f"</{outer}>")


def layouts(
    pages: list[list[Block]], labels: list[list[bool]], count: int = LAYOUTS
) -> tuple[list[list[Block]], list[list[bool]]]:
    """Pages drawn at random with the article and other texts of ``pages``."""
    rng = np.random.default_rng(13)
    mains = [[b.text for b, v in zip(p, l) if v] for p, l in zip(pages, labels)]
    mains = [m for m in mains if m] or [["A first paragraph of some words.", "And a second one."]]
    other = sorted({b.text for p, l in zip(pages, labels) for b, v in zip(p, l) if not v and len(b.text) < 400})
    drawn, marks = [], []
    for k in range(count):
        main = mains[k % len(mains)]
        start = int(rng.integers(len(main)))
        layout = _Layout(rng, main[start:start + int(rng.integers(1, 25))], other)
        found = blocks("".join(layout.html))
        if len(found) == len(layout.labels):
            drawn.append(found)
            marks.append(layout.labels)
    return drawn, marks


# -- Spark ---------------------------------------------------------------------


def learn(pages: DataFrame, *, sample: int = SAMPLE_PAGES, epochs: int = EPOCHS) -> Labeller:
    """A labeller from at most ``sample`` pages of up to ``SAMPLE_CHARS`` characters whose
    mark-up names an article, the same on every run, and random layouts of their texts.
    Repeated rows count once.
    Without such a page it learns from built-in phrases alone."""
    usable = pages.select(F.col("html").cast("string").alias("html"), F.xxhash64("html", "page_id").alias("key"))
    usable = usable.where((F.length("html") <= SAMPLE_CHARS) & F.col("html").rlike("(?i)<(article|main)[ >]"))
    # Keys first, so that no task sends pages that others outrank.
    keys = usable.select("key").distinct().orderBy("key").limit(sample)
    chosen = usable.join(F.broadcast(keys), "key").groupBy("key").agg(F.min("html").alias("html"))
    found = [blocks(r.html) for r in chosen.orderBy("key").collect()]
    labelled = [(p, l) for p in found for l in [marked_labels(p)] if l]
    real, labels = [p for p, _ in labelled], [l for _, l in labelled]
    drawn, marks = layouts(real, labels)
    return train(real + drawn, labels + marks, epochs)


def extract(pages: DataFrame, net: Labeller) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, its blocks joined by an
    empty line; the empty text if there is none. Null and empty pages have none; repeated rows
    give equal rows; there is no limit on a page's length."""
    words.small_batches(pages)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "html", 2 << 20):
                found = [blocks(x) for x in part.column("html").to_pylist()]
                described = describe(found)
                main = net.chances(described) >= MAIN
                texts = []
                for page, lo in zip(found, described.bounds):
                    texts.append("\n\n".join(b.text for b, v in zip(page, main[lo:lo + len(page)]) if v))
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
