"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks: runs of text between the borders of block elements. Each block has features of its
ancestor tags and their class, id and role words, and of its text; the field scores the labels "text" and "other" of a
block with its neighbour's, is trained by maximum likelihood on labelled pages, and is decoded by Viterbi.

Defined results: null and empty pages have no text; markup that is not closed or not opened is tolerated; a page that
ends inside a tag or a comment ends before it; scripts, styles and comments never give blocks, nor do drawings, embedded
objects and hidden templates, which do not part the text around them; where one of these is never closed only its tag
goes, but a script or style goes on to the end; pages of any length are read whole, in time that grows with their
length; repeated pages have equal texts; extra columns are kept.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import read, small_batches

# Kinds of elements.
RAW = frozenset("script style textarea noscript iframe template svg math object canvas title".split())
#: Of these, those that go on to the end of a page where they are not closed, and those that a slash closes.
ENDLESS, CLOSABLE = frozenset("script style textarea title".split()), frozenset("svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: What an opening tag closes first, where it stands open in the same box.
CLOSES = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
BOXES = frozenset("ul ol dl table article section main aside nav header footer div form body html blockquote figure".split())

#: Where markup begins, and a whole tag. No part of a tag's pattern gives back what it took, so that it is read once;
#: quotes bind after an equals sign only, and only where they are closed.
MARK = re.compile(r"<(?=[A-Za-z/!?])")
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
BOGUS = re.compile(r"<!--.*?-->|<(?!!--)[/!?][^>]*+>", re.DOTALL)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
PIECE = re.compile(r"[a-z]+")

FEATURES = 1 << 14
#: Nearest ancestors that give features, as pages may nest without end; feature names that a worker remembers.
NEAREST, REMEMBERED = 48, 1 << 16
TRAIN_PAGES, SEED = 240, 17
STEPS, RATE, L2 = 120, 0.1, 1e-3


class Block:
    __slots__ = ("text", "linked", "path")

    def __init__(self, text: str, linked: int, path: tuple[tuple[str, tuple[str, ...]], ...]):
        self.text, self.linked, self.path = text, linked, path


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page with their text, the letters of it inside links, and their ancestors."""
    if not page:
        return []
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    standing: Counter[str] = Counter()  # the names on the stack
    unclosed: set[str] = set()  # names of which no closing tag is left
    parts: list[str] = []
    linked, links, at, n = 0, 0, 0, len(page)

    def pop(k: int) -> None:
        for name, _ in stack[k:]:
            standing[name] -= 1
        del stack[k:]

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, tuple(stack[-NEAREST:])))
            parts = []
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if links:
                linked += len(piece.strip())

    while at < n:
        mark = MARK.search(page, at)
        if not mark:
            add(page[at:])
            break
        add(page[at : mark.start()])
        m = TAG.match(page, mark.start())
        if not m:
            other = BOGUS.match(page, mark.start())
            if not other:  # the page ends inside it
                break
            at = other.end()
            continue
        at = m.end()
        name = m[2].lower()
        if m[1]:  # a closing tag
            if name in INLINE:
                if name == "a" and links:
                    links -= 1
                continue
            flush()
            links = 0
            for k in range(len(stack) - 1, -1, -1) if standing[name] else ():
                if stack[k][0] == name:
                    pop(k)
                    break
                if name == "p" and stack[k][0] in BOXES:
                    break
            continue
        if name in RAW:
            if name in CLOSABLE and m[3].endswith("/"):
                continue
            end = None if name in unclosed else re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.IGNORECASE).search(page, at)
            if end:
                if name == "math":
                    add(BOGUS.sub(" ", TAG.sub(" ", page[at : end.start()])))
                at = end.end()
            else:
                unclosed.add(name)
                at = n if name in ENDLESS else at
            continue
        if name in INLINE:
            if name in ("br", "img", "wbr"):
                parts.append(" " if name == "br" else "")
            elif name == "a":
                links += 1
            continue
        flush()
        links = 0
        if name in VOID:
            continue
        shut = CLOSES.get(name, ("p",))
        while stack and stack[-1][0] in shut:
            pop(len(stack) - 1)
        words: tuple[str, ...] = ()
        if m[3]:
            found = []
            for key, a, b, c in ATTRIBUTE.findall(m[3]):
                key, value = key.lower(), (a or b or c).lower()
                if key == "style":
                    found += ["hidden"] if "none" in value else []
                elif key in ("hidden", "aria-hidden"):
                    found += ["hidden"] if value != "false" else []
                else:
                    found += PIECE.findall(value)
            words = tuple(dict.fromkeys(found))
        if not m[3].endswith("/"):
            stack.append((name, words))
            standing[name] += 1
    flush()
    return out


@lru_cache(REMEMBERED)
def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def features(found: list[Block]) -> list[np.ndarray]:
    """The slots of the features that hold for each block."""
    out = []
    for block in found:
        text, n = block.text, len(block.text)
        names = ["bias"]
        depth = 0
        for tag, words in reversed(block.path):
            names.append(f"in {tag}")
            if not depth:
                names.append(f"tag {tag}")
            names += [f"near {w}" for w in words] if depth < 2 else []
            names += [f"under {w}" for w in words]
            depth += 1
        parents = [t for t, _ in block.path[-2:]]
        names.append("path " + ">".join(parents))
        words = text.count(" ") + 1
        names.append(f"words {min(words.bit_length(), 9)}")
        names.append(f"links {min(4, int(5 * block.linked / n))}")
        names.append(f"stops {min(3, text.count('.') + text.count('!') + text.count('?'))}")
        names.append("ends" if text[-1] in ".!?:\"'”»…)" else "open")
        if "©" in text or "·" in text or "|" in text:
            names.append("marks")
        if block.linked * 2 > n:
            names.append("mostly linked")
        out.append(np.unique(np.fromiter(map(_slot, names), np.int64, len(names))))
    return out


class ChainField:
    """Weights of features by label, and of label pairs; label 1 is the main text."""

    def __init__(self, pages: list[tuple[list[np.ndarray], np.ndarray]]):
        self.w, self.t = np.zeros((FEATURES, 2)), np.zeros((3, 2))  # row 2 of t: the first block of a page
        m, s = [np.zeros_like(self.w), np.zeros_like(self.t)], [np.zeros_like(self.w), np.zeros_like(self.t)]
        pages = [p for p in pages if len(p[1])]
        for step in range(1, STEPS + 1):
            gw, gt, total = np.zeros_like(self.w), np.zeros_like(self.t), 0
            for feats, y in pages[step % 4 :: 4]:
                emit = np.stack([self.w[f].sum(0) for f in feats])
                one, two = self._marginals(emit)
                total += len(y)
                one[np.arange(len(y)), y] -= 1
                for f, d in zip(feats, one, strict=True):
                    gw[f] += d
                gt[2] += one[0]
                two[np.arange(len(y) - 1), y[:-1], y[1:]] -= 1
                gt[:2] += two.sum(0)
            for i, (p, g) in enumerate(((self.w, gw), (self.t, gt))):
                g = g / max(total, 1) + L2 * p / 10
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.99 * s[i] + 0.01 * g * g
                p -= RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.99**step)) + 1e-8)

    def _marginals(self, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, t = len(emit), self.t[:2]
        fore, back = np.empty((n, 2)), np.zeros((n, 2))
        fore[0] = emit[0] + self.t[2]
        for k in range(1, n):
            fore[k] = emit[k] + np.logaddexp(fore[k - 1, 0] + t[0], fore[k - 1, 1] + t[1])
        for k in range(n - 2, -1, -1):
            x = emit[k + 1] + back[k + 1]
            back[k] = np.logaddexp(t[:, 0] + x[0], t[:, 1] + x[1])
        z = np.logaddexp(*fore[-1])
        two = np.exp(fore[:-1, :, None] + t + (emit + back)[1:, None, :] - z)
        return np.exp(fore + back - z), two

    def decode(self, feats: list[np.ndarray]) -> list[int]:
        """The labels of a page's blocks by Viterbi."""
        if not feats:
            return []
        w, t = self.w, self.t.tolist()
        flat = np.concatenate(feats)
        cuts = np.cumsum([0, *(len(f) for f in feats[:-1])])
        emit = np.add.reduceat(w[flat], cuts, axis=0).tolist()
        a, b = emit[0][0] + t[2][0], emit[0][1] + t[2][1]
        back = []
        for x, y in emit[1:]:
            a0, b0, a1, b1 = a + t[0][0], b + t[1][0], a + t[0][1], b + t[1][1]
            back.append((a0 < b0, a1 < b1))
            a, b = (b0 if a0 < b0 else a0) + x, (b1 if a1 < b1 else a1) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def labelled_pages(n: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[str, list[int]]]:
    """Labelled pages from a seeded rule: (html, label of each leaf block). The rule varies the layout, the names of
    boxes and the text; what it calls main text is the article's headings, paragraphs, lists, quotes and tables."""
    rng = random.Random(seed)
    syllables = "an be co da el fi go ha in jo ka le mi no or pa qu re sa ti un ve wi yo za ment tion ing der".split()

    def words(lo: int, hi: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(lo, hi)))

    def prose(lo: int = 1, hi: int = 8) -> str:
        text = " ".join(words(1, 22).capitalize() + rng.choice("...!?") for _ in range(rng.randint(lo, hi)))
        return text.replace(" ", " <b>", 1).replace(" ", "</b> ", 2) if rng.random() < 0.1 and text.count(" ") > 4 else text

    def named(tag: str, kinds: list[str], plain: float = 0.4) -> tuple[str, str]:
        if rng.random() < plain and tag != "div":
            return f"<{tag}>", f"</{tag}>"
        return f'<{tag} {rng.choice(("class", "id"))}="{rng.choice(kinds)}{rng.choice(("", "-box", " clearfix", "_main"))}">', f"</{tag}>"

    pages = []
    for _ in range(n):
        out, labels = [], []

        def put(markup: str, label: int, out=out, labels=labels) -> None:
            out.append(markup)
            labels.append(label)

        def link_list(tag: str, kinds: list[str], out=out, put=put) -> None:
            a, b = named(tag, kinds)
            out.append(a)
            if rng.random() < 0.2:
                put(f"<h4>{words(1, 3)}</h4>", 0)
            out.append("<ul>")
            for _ in range(rng.randint(2, 9)):
                put(f'<li><a href="/{rng.randrange(99)}">{words(1, 4)}</a>{"</li>" if rng.random() < 0.8 else ""}', 0)
            out.append("</ul>" + b)

        def note(tag: str, kinds: list[str], lo: int, hi: int, out=out, put=put) -> None:
            a, b = named(tag, kinds)
            out.append(a)
            wrap = rng.choice((("", ""), ("<p>", "</p>"), ("<div>", "</div>"), ("<span>", "</span>")))
            for _ in range(rng.randint(1, 2) if wrap[0] in ("<p>", "<div>") else 1):
                put(wrap[0] + rng.choice((prose, lambda lo=1, hi=1: words(3, 12)))(lo, hi) + wrap[1], 0)
            out.append(b)

        def form(out=out, put=put) -> None:
            a, b = rng.choice((("<form>", "</form>"), ('<form class="search">', "</form>"), ('<form class="newsletter">', "</form>")))
            out.append(a)
            put(f"<label>{words(1, 5)}</label><input type=text>" if rng.random() < 0.5 else f"<p>{words(3, 12)}</p>", 0)
            if labels and rng.random() < 0.5:
                put(f"<button>{words(1, 2)}</button>", 0)
            out.append(b)

        if rng.random() < 0.6:
            if rng.random() < 0.5:
                a, b = named("header", ["header", "masthead", "top", "banner"])
                out.append(a)
                put(f"<{(t := rng.choice(('p', 'div', 'h1', 'h2')))}>{words(1, 5)}</{t}>", 0)
                if rng.random() < 0.5:
                    link_list("nav", ["nav", "menu"])
                out.append(b)
            else:
                note("div", ["header", "masthead", "banner", "site-header", "topbar"], 1, 1)
        if rng.random() < 0.85:
            link_list(rng.choice(("nav", "nav", "div")), ["nav", "menu", "navigation", "breadcrumb", "navbar"])
        for _ in range(rng.randint(0, 2)):
            note(rng.choice(("div", "div", "aside", "section")), ["ad", "ads", "advert", "sponsor", "promo", "banner", "cookie", "notice", "consent", "alert", "popup", "modal"], 1, 3)
        side = rng.random()
        if side < 0.25:
            link_list(rng.choice(("aside", "div")), ["sidebar", "side", "widget", "related"])
        a, b = rng.choice(((*named("article", ["post", "article", "entry", "story"], 0.7),), (*named("main", ["content", "main"], 0.6),), (*named("div", ["content", "article", "post", "entry", "story", "text"]),), ("<article>", "</article>"), ("<article>", "</article>")))
        out.append(a)
        if rng.random() < 0.3:
            c, d = named("div", ["body", "content", "entry", "text"])
            out.append(c)
            b = d + b
        if rng.random() < 0.85:
            t = rng.choice(("h1", "h1", "h2"))
            put(f"<{t}>{words(2, 10)}{rng.choice(('', '.'))}</{t}>", 1)
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.72:
                put(f"<p>{'<b>' if rng.random() < 0.1 else ''}{prose()}{'</p>' if rng.random() < 0.85 else '<br>'}", 1)
            elif kind < 0.80:
                put(f"<{(t := rng.choice(('h2', 'h3')))}>{words(1, 7)}</{t}>", 1)
            elif kind < 0.86:
                out.append(t := rng.choice(("<ul>", "<ol>")))
                for _ in range(rng.randint(2, 5)):
                    put(f"<li>{rng.choice((prose(1, 2), words(2, 8)))}</li>", 1)
                out.append(t.replace("<", "</"))
            elif kind < 0.90:
                put(f"<blockquote>{prose(1, 3)}</blockquote>", 1)
            elif kind < 0.93:
                put(f"<pre>{words(3, 20)}</pre>", 1)
            elif kind < 0.95:
                out.append("<table>")
                for _ in range(rng.randint(1, 3)):
                    out.append("<tr>")
                    for _ in range(2):
                        put(f"<td>{words(1, 4)}</td>", 1)
                    out.append("</tr>")
                out.append("</table>")
            elif kind < 0.98:
                note(rng.choice(("div", "aside")), ["ad", "advert", "sponsor", "promo", "related", "share", "social", "newsletter"], 1, 2)
            else:
                put(f"<p>{words(4, 9).capitalize()} <a href='/x'>{words(1, 4)}</a> {words(2, 8)}.</p>", 1)
        if rng.random() < 0.2:
            link_list("div", ["share", "social", "tags", "related", "pagination"])
        inside = rng.random() < 0.3
        if not inside:
            out.append(b)
        if rng.random() < 0.45:
            c, d = named(rng.choice(("section", "div", "div")), ["comments", "comment-list", "discussion", "replies", "responses"], 0)
            out.append(c)
            if rng.random() < 0.6:
                put(f"<h3>{words(1, 3)}</h3>", 0)
            for _ in range(rng.randint(1, 5)):
                e, f = rng.choice((('<div class="comment">', "</div>"), ('<li class="comment">', "</li>"), ('<article class="comment">', "</article>"), ("", "")))
                out.append(e)
                if rng.random() < 0.3:
                    put(f'<div class="author">{words(1, 2)}</div>', 0)
                put(f"<p>{prose(1, 4)}</p>", 0)
                out.append(f)
            out.append(d)
        if inside:
            out.append(b)
        if 0.25 < side < 0.5:
            note(rng.choice(("aside", "div")), ["sidebar", "side", "widget", "related"], 1, 4)
        if rng.random() < 0.35:
            form()
        if rng.random() < 0.85:
            if rng.random() < 0.4:
                link_list("footer", ["footer", "bottom"])
            else:
                c, d = named(rng.choice(("footer", "footer", "div")), ["footer", "bottom", "copyright", "site-footer", "legal"], 0.7)
                put(f"{c}{rng.choice(('&copy; ', '', ''))}{rng.choice((words(2, 6) + ' &middot; ' + prose(1, 2), prose(1, 3)))}{d}", 0)
        body = "".join(out)
        pages.append((f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{}}</style></head><body>{body}</body></html>", labels))
    return pages


@cache
def default_field() -> ChainField:
    """The field trained on the labelled pages; pages whose blocks do not meet their labels one to one are left out."""
    data = []
    for page, labels in labelled_pages():
        found = blocks(page)
        if len(found) == len(labels):
            data.append((features(found), np.array(labels)))
    return ChainField(data)


def extract_text(page: str | None, field: ChainField) -> str:
    """The main text of a page: the blocks labelled so, in page order, one to a line."""
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, field.decode(features(found)), strict=True) if y)


def main_text(page: Column | str, field: ChainField | None = None) -> Column:
    """The main text of a column of pages; the empty text where there is none."""
    field = field or default_field()

    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([extract_text(p.as_py(), field) for p in pages], pa.string())

    return extract(F.col(page) if isinstance(page, str) else page)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    small_batches(spark)
    pages = read(spark, sf_dir, "pages").select("page_id", "url", main_text("html").alias("text"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
