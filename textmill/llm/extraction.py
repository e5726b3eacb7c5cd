"""Main text of web pages by a recurrent labeller of blocks.

A page is read as a sequence of leaf blocks, the runs of text between block-level tags.  Each
block has a vector from its tag path (elements, classes and ids from the root down), one from its
hashed words, and a few sizes.  A bidirectional LSTM reads the whole sequence, so a block is
judged by what stands before and behind it, and says of each whether it belongs to the main text.

No page comes with labels.  The labeller is fitted on pages put together from the table's own
words in many layouts, of which it is known what is content; see ``training_pages``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: Bounds of the training sample: pages read for words, words kept, pages put together.
SAMPLE_PAGES, SAMPLE_WORDS, TRAINING_PAGES = 200, 4_000, 400
EPOCHS, BATCH = 12, 20
PATH_BUCKETS, WORD_BUCKETS, PATH_SIZE, WORD_SIZE, HIDDEN = 1024, 512, 24, 8, 20
#: Elements that are never text on the page.
UNSEEN = {"head", "script", "style", "template", "noscript", "title", "svg", "iframe", "object", "select", "textarea", "button", "canvas"}
#: Elements whose content is not markup.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")
#: Elements without content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements within a line of text; all others begin and end a block.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Which open elements a start tag closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_OPEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(?P<close>/)?(?P<name>[a-zA-Z])")
_NAME_END = re.compile(r"[\s/>]|\Z")
#: What ends each kind of markup that is no tag.
_ENDS = {"<!--": "-->", "<![CDATA[": "]]>", "<!": ">", "<?": ">"}
_QUOTE_OR_END = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Stands in front of the content blocks of training pages; a code point for private use.
_MARK = "\ue000"
_SPACE = re.compile(r"\s+")


@dataclass
class Leaf:
    """A block: its text, the names on its path, and how much of it is links."""

    text: str
    path: tuple[str, ...]
    linked: float


class _TagEnds:
    """Where tags end, quoted values aside, in time that grows with the page whatever its markup.

    From a given quote or ``>`` outside quotes the way to the end of a tag is always the same, so
    those on a way that leads nowhere are not tried again.
    """

    def __init__(self, html: str):
        self.html = html
        self.places = [m.start() for m in _QUOTE_OR_END.finditer(html)]
        self.dead: set[int] = set()

    def after(self, at: int) -> int:
        """The place behind the tag's ``>``, or -1 if the tag does not end."""
        way = []
        while True:
            i = bisect_left(self.places, at)
            if i == len(self.places) or i in self.dead:
                break
            place = self.places[i]
            if self.html[place] == ">":
                return place + 1
            way.append(i)
            at = self.html.find(self.html[place], place + 1) + 1
            if not at:
                break
        self.dead.update(way)
        return -1


def leaves(html: str) -> list[Leaf]:
    """Leaf blocks of a page in order; broken markup is read as far as it goes."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    #: How often each name of a path, and each element, is open.
    names: Counter[str] = Counter()
    opened: Counter[str] = Counter()
    ends = _TagEnds(html)
    parts: list[str] = []
    linked = unseen = links = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        if text:
            # Each name once, and the innermost element at the end.
            path = (*names, stack[-1][0]) if stack else ()
            out.append(Leaf(text, path, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal unseen, links
        name, own = stack.pop()
        opened[name] -= 1
        for n in own:
            names[n] -= 1
            if not names[n]:
                del names[n]
        unseen -= name in UNSEEN
        links -= name == "a"

    at = scan = name_end = 0
    while at < len(html):
        found = _OPEN.search(html, scan)
        name = ""
        if found and found["name"]:
            if name_end < found.end():
                name_end = _NAME_END.search(html, found.end()).start()
            end = ends.after(name_end)
            if end < 0:
                scan = found.end()  # not a tag: part of the text
                continue
            name = html[found.start("name") : name_end].lower()
        elif found:
            mark = _ENDS[found.group()]
            end = html.find(mark, found.end())
            end = end + len(mark) if end >= 0 else len(html)
        text = html[at : found.start() if found else len(html)]
        if text and not unseen:
            parts.append(text)
            linked += len(text) if links else 0
        if not found:
            break
        at = scan = end
        if not name:
            continue
        rest = html[name_end : end - 1]
        if name not in INLINE:
            flush()
        elif name == "br":
            parts.append(" ")
        if found["close"]:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name not in INLINE and opened["p"] and name not in VOID:
            # A block ends an open paragraph, unless another block is open in it.
            inner = len(stack) - 1
            while stack[inner][0] in INLINE:
                inner -= 1
            if stack[inner][0] == "p":
                while len(stack) > inner:
                    pop()
        if name in CLOSES and stack and stack[-1][0] in CLOSES[name]:
            pop()
        if name in VOID or rest.rstrip().endswith("/") and name not in RAW:
            continue
        own = [name]
        for key, *values in _ATTRIBUTE.findall(rest):
            own += [f"{key.lower()}={w}" for w in re.split(r"[\s_-]+", "".join(values).lower()) if w]
        stack.append((name, tuple(own)))
        opened[name] += 1
        names.update(own)
        unseen += name in UNSEEN
        links += name == "a"
        if name in RAW:
            close = re.compile(rf"</{name}\b", re.I).search(html, at)
            at = scan = close.start() if close else len(html)
    flush()
    return out


@lru_cache(100_000)
def _path_buckets(path: tuple[str, ...]) -> list[int]:
    last = next((n for n in reversed(path) if "=" not in n), "")
    return [crc32(n.encode("utf-8", "replace")) % PATH_BUCKETS for n in {*path, f"last:{last}"}]


@lru_cache(200_000)
def _word_bucket(word: str) -> int:
    return crc32(word.encode("utf-8", "replace")) % WORD_BUCKETS


class Features:
    """Blocks of one page as numbers."""

    def __init__(self, page: list[Leaf]):
        self.n = len(page)
        paths, words, path_of, word_of = [], [], [], []
        sizes = np.zeros((len(page), 6))
        for i, leaf in enumerate(page):
            names = _path_buckets(leaf.path)
            paths += names
            path_of.append(len(names))
            own = leaf.text.lower().split()
            words += map(_word_bucket, own)
            word_of.append(len(own))
            stops = sum(map(leaf.text.count, ".!?;,"))
            sizes[i] = (
                np.log1p(len(leaf.text)) / 6, np.log1p(len(own)) / 4, leaf.linked, stops / (1 + len(own)), i / len(page), len(names) / 10,
            )
        blocks = np.arange(self.n)
        self.paths, self.path_of = np.array(paths, np.int64), np.repeat(blocks, path_of)
        self.words, self.word_of = np.array(words, np.int64), np.repeat(blocks, word_of)
        # Every block has a name and a word, so each has a first one.
        self.path_at = np.searchsorted(self.path_of, np.arange(self.n))
        self.word_at = np.searchsorted(self.word_of, np.arange(self.n))
        self.n_words = np.diff(np.append(self.word_at, len(self.words)))[:, None]
        self.sizes = sizes

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Names and shares of words per block as matrices."""
        names = np.bincount(self.path_of * PATH_BUCKETS + self.paths, minlength=self.n * PATH_BUCKETS)
        words = np.bincount(self.word_of * WORD_BUCKETS + self.words, minlength=self.n * WORD_BUCKETS)
        return names.reshape(self.n, -1), words.reshape(self.n, -1) / self.n_words


class BlockLabeller:
    """A bidirectional LSTM over blocks with a logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + 6
        self.w = {
            "path": r.normal(0, 0.3, (PATH_BUCKETS, PATH_SIZE)),
            "word": r.normal(0, 0.1, (WORD_BUCKETS, WORD_SIZE)),
            "out": r.normal(0, 0.3, (2 * HIDDEN, 1)),
            "bias": np.zeros(1),
        }
        for way in ("ahead", "back"):
            self.w[f"{way}_x"] = r.normal(0, size**-0.5, (size, 4 * HIDDEN))
            self.w[f"{way}_h"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            self.w[f"{way}_b"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # open forget gates

    def _inputs(self, pages: list[Features]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(p.n for p in pages)
        x = np.zeros((longest, len(pages), PATH_SIZE + WORD_SIZE + 6))
        there = np.zeros((longest, len(pages), 1))
        for i, p in enumerate(pages):
            x[: p.n, i, :PATH_SIZE] = np.add.reduceat(self.w["path"][p.paths], p.path_at)
            x[: p.n, i, PATH_SIZE:-6] = np.add.reduceat(self.w["word"][p.words], p.word_at) / p.n_words
            x[: p.n, i, -6:] = p.sizes
            there[: p.n, i] = 1
        return x, there

    def _run(self, way: str, x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states; where a page has ended (or not begun, backwards) the state stays as it was."""
        steps = range(len(x)) if way == "ahead" else range(len(x) - 1, -1, -1)
        h = c = np.zeros((x.shape[1], HIDDEN))
        gates_x = x @ self.w[f"{way}_x"] + self.w[f"{way}_b"]
        out, trace = np.zeros((*x.shape[:2], HIDDEN)), []
        for t in steps:
            a = gates_x[t] + h @ self.w[f"{way}_h"]
            s = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(a[:, 3 * HIDDEN :])
            new_c = f * c + i * g
            squashed = np.tanh(new_c)
            trace.append((t, h, c, i, f, o, g, squashed))
            c = np.where(there[t] > 0, new_c, c)
            h = np.where(there[t] > 0, o * squashed, h)
            out[t] = h
        return out, trace

    def _back(self, way: str, x, there, trace, d_out, grads) -> np.ndarray:
        d_h = d_c = np.zeros((x.shape[1], HIDDEN))
        d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN))
        for t, h, c, i, f, o, g, squashed in reversed(trace):
            m = there[t]
            full = d_h + d_out[t]
            d_state = d_c * m + full * m * o * (1 - squashed**2)
            d_gates[t] = np.concatenate(
                [d_state * g * i * (1 - i), d_state * c * f * (1 - f), full * m * squashed * o * (1 - o), d_state * i * (1 - g**2)], 1
            )
            grads[f"{way}_h"] += h.T @ d_gates[t]
            d_h = full * (1 - m) + d_gates[t] @ self.w[f"{way}_h"].T
            d_c = d_c * (1 - m) + d_state * f
        flat = d_gates.reshape(-1, 4 * HIDDEN)
        grads[f"{way}_x"] += x.reshape(-1, x.shape[2]).T @ flat
        grads[f"{way}_b"] += flat.sum(0)
        return d_gates @ self.w[f"{way}_x"].T

    def scores(self, pages: list[Features]) -> list[np.ndarray]:
        """Probability that a block is content, per page."""
        x, there = self._inputs(pages)
        both = np.concatenate([self._run("ahead", x, there)[0], self._run("back", x, there)[0]], 2)
        p = 1 / (1 + np.exp(-(both @ self.w["out"] + self.w["bias"])[..., 0]))
        return [p[: page.n, i] for i, page in enumerate(pages)]

    def fit(self, pages: list[Features], labels: list[np.ndarray], seed: int = 11) -> float:
        """Adam on the logistic loss; returns the share of blocks that come out right."""
        r = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        counts = [p.counts() for p in pages]
        step = 0
        for _ in range(EPOCHS):
            order = r.permutation(len(pages))
            for a in range(0, len(order), BATCH):
                chosen = order[a : a + BATCH]
                batch = [pages[i] for i in chosen]
                x, there = self._inputs(batch)
                ahead, trace_a = self._run("ahead", x, there)
                back, trace_b = self._run("back", x, there)
                both = np.concatenate([ahead, back], 2)
                p = 1 / (1 + np.exp(-(both @ self.w["out"] + self.w["bias"])))
                truth = np.zeros_like(p)
                for i, j in enumerate(chosen):
                    truth[: pages[j].n, i, 0] = labels[j]
                d = (p - truth) * there / there.sum()
                grads = {k: np.zeros_like(v) for k, v in self.w.items()}
                grads["out"] = both.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, 1)
                grads["bias"] = d.sum((0, 1))
                d_both = d @ self.w["out"].T
                d_x = self._back("ahead", x, there, trace_a, d_both[..., :HIDDEN], grads)
                d_x = d_x + self._back("back", x, there, trace_b, d_both[..., HIDDEN:], grads)
                for i, page in enumerate(batch):
                    names, words = counts[chosen[i]]
                    grads["path"] += names.T @ d_x[: page.n, i, :PATH_SIZE]
                    grads["word"] += words.T @ d_x[: page.n, i, PATH_SIZE:-6]
                step += 1
                for k, g in grads.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    rate = 0.01 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                    self.w[k] -= rate * mean[k] / (np.sqrt(square[k]) + 1e-8)
        right = [((s > 0.5) == t) for a in range(0, len(pages), BATCH) for s, t in
                 zip(self.scores(pages[a : a + BATCH]), labels[a : a + BATCH], strict=True)]
        return float(np.concatenate(right).mean())


#: Names that sites give to parts of a page, by what the part is.
BOILERPLATE = {
    "nav": ["menu", "nav", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs", "main-menu"],
    "header": ["header", "site-header", "masthead", "banner", "topbar", "page-header"],
    "footer": ["footer", "site-footer", "copyright", "bottom", "legal", "page-footer"],
    "aside": ["sidebar", "side", "aside", "widget", "related", "rail", "popular", "recommended"],
    "notice": ["notice", "cookie", "cookie-banner", "consent", "alert", "gdpr", "popup", "message"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad"],
    "form": ["form", "newsletter", "subscribe", "search", "login", "signup"],
    "comments": ["comments", "comment", "comment-list", "discussion", "replies", "responses"],
    "share": ["share", "social", "tags", "share-bar", "pagination"],
}
CONTENT = ["content", "post", "entry", "entry-content", "article", "article-body", "story", "main", "post-content", "text", "body"]


def training_pages(words: list[str], count: int = TRAINING_PAGES, seed: int = 5) -> list[str]:
    """Pages in random layouts with marked content.

    Parts stand in the order usual on the web; each may be missing, may be an element made for
    it or a ``div`` with one of its names, and may hold paragraphs, lists of links or bare text.
    Content blocks carry a mark in front that ``labelled`` takes away again.
    """
    r = np.random.default_rng(seed)
    pick = lambda options: options[int(r.integers(len(options)))]
    chance = lambda p: r.random() < p

    def text(low: int, high: int) -> str:
        n = int(r.integers(low, high + 1))
        out = " ".join(pick(words) for _ in range(n))
        return out.capitalize() + pick([".", ".", "", "!", "?"])

    def mark(body: str, good: bool) -> str:
        return (_MARK if good else "") + body

    def link(low: int, high: int) -> str:
        return f'<a href="/{pick(words)}">{text(low, high)}</a>'

    def items(good: bool, links: bool) -> str:
        rows = (link(1, 3) if links else text(2, 25) for _ in range(int(r.integers(2, 9))))
        return "<ul>" + "".join(f"<li>{mark(row, good)}</li>" for row in rows) + "</ul>"

    def part(kind: str) -> str:
        name = pick(BOILERPLATE[kind])
        own = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind)
        if own and chance(0.5):
            open_tag, close = f"<{own}>" if kind != "comments" and chance(0.6) else f'<{own} class="{name}">', f"</{own}>"
        else:
            tag = pick(["div", "div", "section", "ul" if kind == "nav" else "div"])
            key = pick(["class", "class", "id"])
            open_tag, close = f'<{tag} {key}="{name}">', f"</{tag}>"
        if kind == "nav":
            inner = items(False, True) if not open_tag.startswith("<ul") else "".join(f"<li>{link(1, 2)}</li>" for _ in range(5))
        elif kind == "header":
            inner = f"<h1>{text(1, 4)}</h1>" if chance(0.4) else f"<div>{text(1, 6)}</div>"
            inner += items(False, True) if chance(0.4) else ""
        elif kind == "footer":
            inner = f"&copy; {pick(words)} &middot; {text(1, 14)}" if chance(0.6) else f"<p>{text(3, 20)}</p>"
            inner += items(False, True) if chance(0.4) else ""
        elif kind == "aside":
            inner = f"<h{pick('234')}>{text(1, 4)}</h3>" + (items(False, True) if chance(0.6) else f"<p>{text(5, 40)}</p>")
        elif kind == "form":
            inner = f"<label>{text(1, 4)}</label><input name=q>" + f"<p>{text(2, 12)}</p>"
        elif kind == "comments":
            each = pick(["div", "li", "article", "p"])
            inner = f"<h3>{text(1, 3)}</h3>" * chance(0.6) + "".join(
                f'<{each} class="comment"><b>{pick(words)}</b><p>{text(3, 50)}</p></{each}>' if each != "p" else f"<p>{text(3, 50)}</p>"
                for _ in range(int(r.integers(1, 6)))
            )
        elif kind == "share":
            inner = " ".join(link(1, 2) for _ in range(4))
        else:
            inner = text(2, 30) if chance(0.6) else f"<p>{text(2, 40)}</p>"
        return open_tag + inner + close

    def content() -> str:
        out = [f"<h1>{mark(text(2, 12), True)}</h1>"] * chance(0.85)
        for n in range(int(r.integers(1, 12))):
            kind = r.random()
            if kind < 0.72:
                body = mark(text(1, 90), True)
                body = body.replace(" ", pick([" <b>", " <em>"]), 1) + pick(["</b>", "</em>", ""]) if chance(0.2) else body
                out.append(f"<p>{body}" + ("</p>" if chance(0.8) else "<br>"))
            elif kind < 0.79:
                out.append(f"<h{pick('23')}>{mark(text(1, 8), True)}</h2>")
            elif kind < 0.86:
                out.append(items(True, False))
            elif kind < 0.9:
                out.append(f"<blockquote>{mark(text(5, 40), True)}</blockquote>")
            elif kind < 0.93:
                rows = "".join(f"<tr><td>{mark(text(1, 4), True)}</td><td>{mark(text(1, 4), True)}</td></tr>" for _ in range(3))
                out.append(f"<table>{rows}</table>")
            elif kind < 0.95:
                out.append(f"<pre>{mark(text(3, 30), True)}</pre>")
            elif n:
                out.append(part(pick(["ad", "ad", "notice", "form", "aside", "share"])))
        tag = pick(["article", "article", "main", "div", "div", "section"])
        name = f' {pick(["class", "id"])}="{pick(CONTENT)}"' if tag in ("div", "section") or chance(0.3) else ""
        body = f"<{tag}{name}>" + "".join(out) + f"</{tag}>"
        return f"<main>{body}</main>" if chance(0.2) and tag != "main" else body

    pages = []
    for _ in range(count):
        before = [part(k) for k in ("header", "nav", "notice", "form", "ad", "aside") if chance(0.45)]
        behind = [part(k) for k in ("share", "ad", "comments", "aside", "form", "notice", "nav", "footer") if chance(0.4)]
        body = "".join([*before, content(), *behind])
        body = f'<div id="{pick(["page", "wrapper", "container", "root"])}">{body}</div>' if chance(0.4) else body
        pages.append(f"<!DOCTYPE html><html><head><title>{text(1, 5)}</title><style>p{{}}</style></head><body>{body}</body></html>")
    return pages


def labelled(html: str) -> tuple[list[Leaf], np.ndarray]:
    """Blocks of a training page without the marks, and which ones had one."""
    page = leaves(html)
    truth = np.array([_MARK in leaf.text for leaf in page], bool)
    return [Leaf(leaf.text.replace(_MARK, ""), leaf.path, leaf.linked) for leaf in page], truth


def fit_labeller(pages: DataFrame) -> BlockLabeller:
    """A labeller fitted on ``TRAINING_PAGES`` layouts of words from about ``SAMPLE_PAGES`` pages."""
    n = pages.count()
    bare = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)\\b.*?</\\1", " "), "<[^>]*>", " ")
    words = (
        pages.filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 40)) < F.lit((1 << 40) * SAMPLE_PAGES / max(1, n)))
        .select(F.explode(F.split(bare, r"\s+")).alias("word"))
        .filter((F.length("word") > 0) & (F.length("word") < 40) & ~F.col("word").rlike("[<>&]"))
        .groupBy("word").count()
        .orderBy(F.desc("count"), "word").limit(SAMPLE_WORDS)
    )
    found = [w for r in words.collect() for w in [r["word"]] * min(r["count"], 20)] or ["text", "word", "page"]
    made = [labelled(p) for p in training_pages(found)]
    model = BlockLabeller()
    model.fit([Features(p) for p, _ in made], [t for _, t in made])
    return model


def main_text(model: BlockLabeller, htmls: list[str]) -> list[str]:
    """Main texts of some pages; pages of about equal length go through the network together."""
    pages = [leaves(h) for h in htmls]
    out = [""] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        # At most 64 pages and about 20,000 blocks, or one page.
        size = max(1, min(64, 20_000 // len(pages[order[at]])))
        chosen = order[at : at + size]
        for i, score in zip(chosen, model.scores([Features(pages[i]) for i in chosen]), strict=True):
            out[i] = "\n".join(leaf.text for leaf, s in zip(pages[i], score, strict=True) if s > 0.5)
        at += size
    return out


def _extract(model: BlockLabeller):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html", 1 << 20):
            column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            texts = main_text(model, [h or "" for h in column("html").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [column("page_id"), column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract_main_text(pages: DataFrame, model: BlockLabeller) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Blocks that the labeller takes for content are joined by line feeds, in page order and
    whole.  Character references are decoded; any white space within a block, also a ``<br>``,
    is one space.  A null or empty page, and one without content, has the empty text.  Repeated
    rows each give a row; other columns are ignored.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_extract(model), f"page_id {kind}, url string, text string, n_chars long")
