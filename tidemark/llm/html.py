"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is parsed into leaf blocks, runs of text between block-level tags, each with
its ancestors.  The field has two states (main text, other); a block's features are its
ancestors' tags and class or id words and the shape of its text.  It is trained
on labelled pages (``labelled_pages``: a bounded, documented set of generated layouts, since the tables
carry no labels) by stochastic gradients of the log likelihood, and decoded by Viterbi.

Character references are decoded; white space inside a block (no-break spaces too) becomes one space;
kept blocks are joined by one space.  Nothing else is dropped or capped: content that browsers show, such as that of
``math``, ``object`` or ``xmp``, is text.  Parsing takes time in proportion to the page, however its tags and quotes are broken or nested;
a block's features come from its nearest ``ANCESTORS`` block-level ancestors.
A null or empty page, or one without main text, gives an empty text; repeated rows
are extracted each on their own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element classes, from the HTML standard.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "iframe label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style title template noscript iframe textarea noembed noframes".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select body html div section article aside nav main form".split())
P_STAYS = frozenset("button label option td th li".split())

ANCESTORS = 64
IMPLIED = frozenset(("html", "body"))  # a page has them whether or not it says so
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[\"'>]")
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in UNSEEN}
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


@functools.lru_cache(maxsize=50_000)
def _mark(tag: str, attrs: str) -> str:
    """A tag with the words of its class, id and role: ``div.main.content``."""
    words = []
    for name, value in _ATTR.findall(attrs):
        name = name.lower()
        if name in ("class", "id", "role"):
            words += [w.lower() for w in _NAMES.findall(value)]
        elif name == "hidden" or (name == "aria-hidden" and "true" in value) or (name == "style" and re.search(r"display\s*:\s*none", value)):
            words.append("hidden")
    return ".".join([tag, *sorted(set(words))])


class _Tags:
    """The tags of a page, each found in time in proportion to its length."""

    def __init__(self, page: str) -> None:
        self.page, self.size = page, len(page)
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()  # places outside quotes from which no end of a tag can be reached

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes begin at ``at``; the next one of any kind if quotes don't close; -1: none."""
        if at > self.last[">"]:
            return -1
        here, seen = at, []
        while here not in self.dead:
            seen.append(here)
            m = _STOP.search(self.page, here)
            if not m:
                break
            c = m[0]
            if c == ">":
                return m.start()
            if m.end() > self.last[c]:
                break
            here = self.page.find(c, m.end()) + 1
        self.dead.update(seen)
        return self.page.find(">", at)

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, closing, name, attributes) of each; comments and declarations have no name."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                stop = page.find("-->", start + 4)
                at = self.size if stop < 0 else stop + 3
                yield start, at, False, "", ""
                continue
            if page.startswith(("<!", "<?"), start):
                stop = page.find(">", start)
                at = self.size if stop < 0 else stop + 1
                yield start, at, False, "", ""
                continue
            m = _NAME.match(page, start + 1)
            stop = self.end(m.end()) if m else -1
            if stop < 0:  # no tag: text
                at = start + 1
                continue
            at, name = stop + 1, m[2].lower()
            attrs = page[m.end() : stop]
            if name in UNSEEN and not m[1] and not attrs.endswith("/"):
                close = _ENDS[name].search(page, at)
                at = close.end() if close else self.size
            yield start, at, bool(m[1]), name, attrs


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, with decoded and trimmed text."""
    stack: list[tuple[str, str]] = []
    path: list[str] = []  # marks of the block-level ones on the stack
    open_: Counter[str] = Counter()
    out: list[Block] = []
    parts: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(tuple(path[-ANCESTORS:]), text, linked))
            parts.clear()
        linked = 0

    def close(index: int) -> None:
        if any(t in BLOCK for t, _ in stack[index:]):
            flush()
        while len(stack) > index:
            tag, _ = stack.pop()
            open_[tag] -= 1
            if tag in BLOCK and tag not in IMPLIED:
                path.pop()

    def close_nearest(tags: frozenset[str] | set[str], scope: frozenset[str]) -> None:
        if not any(open_[t] for t in tags):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                close(i)
                return
            if stack[i][0] in scope:
                return

    def say(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if open_["a"]:
            linked += len(text)

    for start, end, closing, tag, attrs in _Tags(page):
        if start > at:
            say(page[at:start])
        at = end
        if not tag:
            continue
        if closing:
            close_nearest({tag}, frozenset())
        elif tag in VOID:
            if tag in BLOCK:
                flush()
            else:
                parts.append(" " if tag == "br" else "")
        elif tag not in UNSEEN:
            if tag in BLOCK:
                flush()
                if tag not in P_STAYS or tag == "li":
                    close_nearest({"p"}, BLOCK)
                if tag in CLOSES:
                    close_nearest(CLOSES[tag], SCOPE)
            mark = _mark(tag, attrs) if attrs else tag
            stack.append((tag, mark))
            open_[tag] += 1
            if tag in BLOCK and tag not in IMPLIED:
                path.append(mark)
    if at < len(page):
        say(page[at:])
    flush()
    return out


SLOTS = 1 << 16


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % SLOTS


@functools.lru_cache(maxsize=100_000)
def _path_slots(path: tuple[str, ...]) -> tuple[int, ...]:
    """Features of a block's ancestors: tags, class words, tag pairs, depth."""
    names = {"bias", f"depth:{min(len(path), 12)}", f"own:{path[-1].split('.')[0] if path else '-'}"}
    before = "-"
    for mark in path:
        tag, *words = mark.split(".")
        names |= {f"tag:{tag}", f"pair:{before}>{tag}"}
        names |= {f"word:{w}" for w in words}
        before = tag
    return tuple(_slot(n) for n in sorted(names))


_SHAPE = {name: _slot(name) for kind, n in (("len", 16), ("link", 5), ("end", 2), ("comma", 3), ("odd", 2), ("first", 1), ("last", 1)) for name in (f"{kind}:{k}" for k in range(n))}


def _text_slots(block: Block, index: int, count: int) -> list[int]:
    """Features of a block's text and place: length, share of links, sentence end, commas, copyright sign."""
    text, n = block.text, len(block.text)
    names = [f"len:{min(15, n.bit_length())}", f"link:{min(4, 4 * block.linked // n)}", f"end:{int(text[-1] in '.!?…\"')}", f"comma:{min(2, text.count(','))}"]
    if text[0] in "©|»›" or "©" in text[:40]:
        names.append("odd:1")
    if index == 0:
        names.append("first:0")
    if index == count - 1:
        names.append("last:0")
    return [_SHAPE[x] for x in names]


@dataclass
class Model:
    """Weights of main text against other, per feature, and of each step between states."""

    weight: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    memo: dict = field(default_factory=dict)

    def potentials(self, page: list[Block]) -> list[float]:
        out = []
        for i, b in enumerate(page):
            base = self.memo.get(b.path)
            if base is None:
                base = self.memo[b.path] = float(self.weight[list(_path_slots(b.path))].sum())
            out.append(base + sum(self.weight[s] for s in _text_slots(b, i, len(page))))
        if len(self.memo) > 100_000:
            self.memo.clear()
        return out

    def decode(self, page: list[Block]) -> list[int]:
        """The likeliest state sequence (Viterbi)."""
        if not page:
            return []
        (a, b), (c, d) = self.step.tolist()
        other, main, back = 0.0, 0.0, []
        for i, u in enumerate(self.potentials(page)):
            if i:
                back.append((c + main > a + other, d + main >= b + other))
                other, main = max(a + other, c + main), max(b + other, d + main)
            main += u
        state = int(main > other)
        out = [state]
        for pair in reversed(back):
            state = int(pair[state])
            out.append(state)
        return out[::-1]

    def learn(self, page: list[Block], labels: list[int], rate: float, decay: float) -> None:
        """One gradient step on the log likelihood of a page (forward-backward)."""
        n = len(page)
        slots = [[*_path_slots(b.path), *_text_slots(b, i, n)] for i, b in enumerate(page)]
        u = np.zeros((n, 2))
        u[:, 1] = [self.weight[s].sum() for s in slots]
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        alpha[0] = u[0]
        for i in range(1, n):
            alpha[i] = u[i] + np.logaddexp(alpha[i - 1, 0] + self.step[0], alpha[i - 1, 1] + self.step[1])
        for i in range(n - 2, -1, -1):
            nxt = u[i + 1] + beta[i + 1]
            beta[i] = np.logaddexp(self.step[:, 0] + nxt[0], self.step[:, 1] + nxt[1])
        z = np.logaddexp(*alpha[-1])
        p = np.exp(alpha + beta - z)[:, 1]
        for s, gradient in zip(slots, np.array(labels) - p, strict=True):
            self.weight[s] += rate * (gradient - decay * self.weight[s])
        for i in range(1, n):
            pair = np.exp(alpha[i - 1][:, None] + self.step + (u[i] + beta[i])[None, :] - z)
            self.step -= rate * 0.2 * pair
            self.step[labels[i - 1], labels[i]] += rate * 0.2


# Words that name parts of a page in class and id attributes of the generated layouts.
MAIN_NAMES = "content main article post entry story body text page-content post-body article-body entry-content main-text single blog-post".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topnav toolbar pagination skip tabs".split(),
    "top": "header site-header masthead top banner branding logo topbar".split(),
    "bottom": "footer site-footer bottom copyright legal colophon credits".split(),
    "side": "sidebar side widget related recommended trending popular tags archive rail aside".split(),
    "notice": "notice cookie cookie-notice consent alert message popup modal newsletter subscribe gdpr warning promo".split(),
    "advert": "ad ads advert advertisement sponsor sponsored banner-ad adbox promo-box".split(),
    "form": "login search-form signup contact-form form register poll".split(),
    "comments": "comments comment reply discussion commentlist responses feedback disqus thread".split(),
    "share": "share social sharing follow like buttons".split(),
}


#: Layout families of generated pages: named wrappers, wrappers with meaningless or no names, no wrapper at all, tables.
FAMILIES = ("named", "named", "named", "neutral", "neutral", "bare", "table")


class _Writer:
    """Generates one page and the label of each of its leaf blocks."""

    def __init__(self, seed: int, families: tuple[str, ...] = FAMILIES) -> None:
        self.rng, self.out, self.labels, self.families = random.Random(seed), [], [], families

    def words(self, n: int) -> str:
        return " ".join("".join(self.rng.choice("aeiou") + self.rng.choice("bcdfglmnprstv") for _ in range(self.rng.randint(1, 4))) for _ in range(n))

    def sentence(self, low: int, high: int) -> str:
        text = self.words(self.rng.randint(low, high))
        text = ", ".join([text, self.words(4)]) if self.rng.random() < 0.4 else text
        return text.capitalize() + self.rng.choice([".", ".", ".", "!", "?"])

    def block(self, tag: str, text: str, label: int, attrs: str = "") -> None:
        self.out.append(f"<{tag}{attrs}>{text}" + (f"</{tag}>" if tag != "p" or self.rng.random() < 0.9 else ""))
        self.labels.append(label)

    def named(self, names: list[str]) -> str:
        if self.rng.random() < 0.2:
            return ""
        return f' {self.rng.choice(["class", "class", "id"])}="{self.rng.choice(names)}"'

    def links(self, label: int, kind: str) -> None:
        self.out.append("<ul>")
        for _ in range(self.rng.randint(2, 8)):
            self.block("li", f'<a href="/{self.words(1)}">{self.words(self.rng.randint(1, 3))}</a>', label)
        self.out.append("</ul>")

    def other(self, kind: str) -> None:
        tag = {"menu": "nav", "top": "header", "bottom": "footer", "side": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        generic = self.rng.random() < 0.4
        tag = "div" if generic else tag
        attrs = f' {self.rng.choice(["class", "id"])}="{self.rng.choice(OTHER_NAMES[kind])}"' if generic or tag in ("div", "section") or self.rng.random() < 0.5 else ""
        if kind == "menu" and self.rng.random() < 0.15:
            attrs = self.strange()
        self.out.append(f"<{tag}{attrs}>")
        if kind == "menu":
            self.links(0, kind)
        elif kind == "top":
            self.block(self.rng.choice(["h1", "h2", "div", "p"]), self.words(self.rng.randint(1, 5)), 0)
            if self.rng.random() < 0.5:
                self.links(0, kind)
        elif kind == "side":
            for _ in range(self.rng.randint(1, 3)):
                self.block("h3", self.words(2), 0)
                if self.rng.random() < 0.6:
                    self.links(0, kind)
                else:
                    self.block("p", self.sentence(4, 30), 0)
        elif kind == "form":
            self.block("label", self.words(2), 0)
            self.out.append('<input type="text">')
            self.block("button", self.words(1), 0)
            if self.rng.random() < 0.4:
                self.block("p", self.sentence(4, 20), 0)
        elif kind == "comments":
            self.block(self.rng.choice(["h2", "h3"]), self.words(2), 0)
            for _ in range(self.rng.randint(1, 6)):
                self.out.append(f'<div class="{self.rng.choice(["comment", "reply", "comment-body"])}">' if self.rng.random() < 0.8 else "<div>")
                if self.rng.random() < 0.6:
                    self.block("span" if self.rng.random() < 0 else "div", self.words(2), 0)
                for _ in range(self.rng.randint(1, 2)):
                    self.block("p", self.sentence(4, 60), 0)
                self.out.append("</div>")
        elif kind == "bottom":
            text = f"&copy; {self.words(1)} &middot; {self.sentence(3, 14)}"
            if self.rng.random() < 0.5:
                self.block("p", text, 0)
            else:
                self.out.append(text)
                self.labels.append(0)
        else:
            text = self.sentence(2, 40)
            if self.rng.random() < 0.5:
                self.block("p", text, 0)
            else:
                self.out.append(text)
                self.labels.append(0)
        self.out.append(f"</{tag}>")

    def strange(self) -> str:
        """A class that says nothing."""
        return f' class="{self.words(1)[:4]}{self.rng.randint(0, 99)}"' if self.rng.random() < 0.6 else ""

    def main(self) -> None:
        family = self.rng.choice(self.families)
        if family == "named":
            return self.named_main()
        if family == "neutral":
            tag = self.rng.choice(["div", "div", "section"])
            deep = self.rng.randint(1, 3)
            self.out.append("".join(f"<{tag}{self.strange()}>" for _ in range(deep)))
            self.body()
            self.out.append(f"</{tag}>" * deep)
        elif family == "bare":
            self.body()
        else:
            self.block(self.rng.choice(["h1", "h2"]), self.words(self.rng.randint(2, 9)), 1)
            self.out.append(f"<table{self.strange()}>")
            for _ in range(self.rng.randint(2, 9)):
                self.out.append("<tr>")
                for _ in range(self.rng.randint(1, 3)):
                    self.block(self.rng.choice(["td", "td", "td", "th"]), self.words(self.rng.randint(1, 5)) if self.rng.random() < 0.5 else self.sentence(3, 30), 1)
                self.out.append("</tr>")
            self.out.append("</table>")
            if self.rng.random() < 0.5:
                self.block("p", self.sentence(4, 40), 1)
        return None

    def body(self) -> None:
        """A heading and paragraphs, often few and short."""
        if self.rng.random() < 0.8:
            self.block(self.rng.choice(["h1", "h1", "h2"]), self.words(self.rng.randint(1, 9)), 1)
        most = self.rng.choice([3, 4, 12, 40, 100])
        for _ in range(self.rng.choice([1, 2, 2, 3, 6, 9])):
            kind = self.rng.random()
            if kind < 0.85:
                self.block("p" if self.rng.random() < 0.8 else "div", self.sentence(2, most), 1, self.strange() if self.rng.random() < 0.2 else "")
            elif kind < 0.93:
                self.block(self.rng.choice(["h2", "h3"]), self.words(self.rng.randint(1, 5)), 1)
            else:
                self.out.append("<ul>")
                for _ in range(self.rng.randint(2, 4)):
                    self.block("li", self.sentence(2, 16), 1)
                self.out.append("</ul>")

    def named_main(self) -> None:
        shape = self.rng.random()
        tag = "article" if shape < 0.45 else "main" if shape < 0.6 else self.rng.choice(["div", "div", "section", "td"])
        attrs = self.named(MAIN_NAMES) if tag in ("article", "main") else f' {self.rng.choice(["class", "id"])}="{self.rng.choice(MAIN_NAMES)}"' if self.rng.random() < 0.75 else ""
        opening, closing = f"<{tag}{attrs}>", f"</{tag}>"
        if tag == "td":
            opening, closing = f"<table><tr>{opening}", f"{closing}</tr></table>"
        if self.rng.random() < 0.3:
            opening, closing = f"{self.rng.choice(['<main>', '<div>', '<div class=wrapper>', '<div class=container>'])}{opening}", closing
        self.out.append(opening)
        if self.rng.random() < 0.85:
            head = self.rng.random() < 0.25
            self.out.append("<header>" if head else "")
            self.block(self.rng.choice(["h1", "h1", "h2"]), self.words(self.rng.randint(2, 12)), 1)
            self.out.append("</header>" if head else "")
        count = self.rng.choice([1, 2, 3, 5, 8, 12])
        for k in range(count):
            kind = self.rng.random()
            if kind < 0.68:
                text = self.sentence(1, self.rng.choice([3, 12, 40, 120]))
                text = f"<b>{text}<br>" if self.rng.random() < 0.1 else text
                if self.rng.random() < 0.12:
                    text += f' <a href="x">{self.words(2)}</a>.'
                if self.rng.random() < 0.08:
                    text = text.replace(" ", " | ")
                self.block("p" if self.rng.random() < 0.85 else "div", text, 1)
            elif kind < 0.76:
                self.block(self.rng.choice(["h2", "h3", "h4"]), self.words(self.rng.randint(1, 6)), 1)
            elif kind < 0.84:
                self.out.append("<ul>")
                for _ in range(self.rng.randint(1, 4)):
                    self.block("li", self.sentence(2, 20), 1)
                self.out.append("</ul>")
            elif kind < 0.88:
                self.block("blockquote", self.sentence(5, 30), 1)
            elif kind < 0.91:
                self.block("pre", self.words(12), 1)
            elif k and k < count - 1 and self.rng.random() < 0.6:
                self.other(self.rng.choice(["advert", "side", "notice", "share"]))
            else:
                self.block("p", self.words(self.rng.randint(1, 3)).capitalize() + ".", 1)
        if self.rng.random() < 0.1:
            self.other("share")
        self.out.append(closing)

    def page(self) -> tuple[str, list[int]]:
        pick = self.rng.random
        before = [k for k, p in (("top", 0.5), ("menu", 0.8), ("notice", 0.3), ("advert", 0.45), ("form", 0.2), ("side", 0.15)) if pick() < p]
        after = [k for k, p in (("advert", 0.2), ("side", 0.45), ("comments", 0.4), ("form", 0.2), ("notice", 0.2), ("menu", 0.1), ("bottom", 0.85)) if pick() < p]
        if pick() < 0.25:  # nothing but the article
            before = after = []
        self.out.append(f'<!DOCTYPE html><html><head><title>{self.words(3)}</title><script>var t="</p>";</script></head><body>')
        for k in before:
            self.other(k)
        if pick() < 0.96:
            self.main()
        for k in after:
            self.other(k)
        self.out.append("</body></html>")
        return "".join(self.out), self.labels


def labelled_pages(n: int, seed: int = 1, families: tuple[str, ...] = FAMILIES) -> list[tuple[list[Block], list[int]]]:
    """``n`` generated pages as (blocks, label of each block)."""
    out = []
    for k in range(n):
        page, labels = _Writer(seed * 1_000_003 + k, families).page()
        found = blocks(page)
        if found and len(found) == len(labels):
            out.append((found, labels))
    return out


@functools.lru_cache(maxsize=4)
def train(pages: int = 1500, epochs: int = 4, rate: float = 0.1, decay: float = 1e-4, families: tuple[str, ...] = FAMILIES) -> Model:
    """The model, fitted on a bounded set of labelled pages; the same on every run."""
    data, model = labelled_pages(pages, families=families), Model()
    order = random.Random(0)
    for epoch in range(epochs):
        order.shuffle(data)
        for page, labels in data:
            model.learn(page, labels, rate / math.sqrt(1 + epoch), decay)
    return model


def extract(page: str | None, model: Model) -> str:
    if not page:
        return ""
    found = blocks(page)
    return " ".join(b.text for b, keep in zip(found, model.decode(found), strict=True) if keep)


def extract_pages(pages: DataFrame, training_pages: int = 1500) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.  No shuffle."""
    trained = train(training_pages)
    shared = pages.sparkSession.sparkContext.broadcast((trained.weight, trained.step))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            texts = [extract(p.as_py(), model) for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
