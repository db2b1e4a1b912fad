"""Main text of web pages: boosted trees over the nodes of a page, decoded along its tree.

Every block element and every run of text (see :mod:`ledgerlens.llm.dom`) gets the log odds of
holding main text, from the density of links, punctuation and elements in its subtree, its
place and depth, its siblings, its element and the words in its attributes, and those of its
ancestors. The odds are learned for nodes whose parent holds main text, and decoding goes from
the page downwards: a node is kept if its odds are and its parent is. So nothing is kept within
something dropped, and a short line within the article is judged against its like there only.

The trees are fitted in one task on pages composed here: layouts with and without elements or
attributes that say what they are, filled with texts of at most ``sample_pages`` pages, each of
at most ``sample_texts`` texts of ``sample_chars`` characters. Extraction covers every page.

Defined cases: a null or empty page, and one without main text, gives an empty text; text
outside all elements is a block like any other; what a tag, comment or script leaves open
to the end of the page is part of it; ``br`` is white space; repeated rows give a row each; a
null id is passed on; an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.boost import Boosting, Forest, fit
from ledgerlens.llm.common import saved
from ledgerlens.llm.dom import HINT_NAMES, KIND_NAMES, Page, read_page

#: Nodes whose features stand in memory at once, and characters of the pages read at once.
CHUNK_NODES = 20_000
CHUNK_CHARS = 4_000_000
#: Marks main text in composed pages.
_MARK = "\ue000"
_FILLER = "The text of a page goes on here, and it says a little more than it did before."


@dataclass(frozen=True)
class Params:
    sample_pages: int = 300
    sample_texts: int = 30
    sample_chars: int = 400
    composed: int = 1500
    boosting: Boosting = Boosting(trees=80, depth=5)


# Features


def _node_columns(pages: list[Page]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Measures per node of all pages, and per node a mask of its own and its ancestors'
    kinds and hints."""
    sizes = np.array([len(p.parent) for p in pages])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    shift = np.repeat(starts, sizes)

    def joined(name, dtype=np.int64):
        return np.concatenate([np.asarray(getattr(p, name), dtype) for p in pages])

    n = int(sizes.sum())
    every = np.arange(n)
    parent, end = joined("parent") + shift, joined("end") + shift
    kind, hints = joined("kind"), joined("hints")
    chars = np.array([len(t) if t else 0 for p in pages for t in p.text], np.int64)
    leaf = (kind == 0).astype(np.int64)
    root = shift

    def subtree(values):
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[end] - sums[every], sums[every] - sums[root]

    # What an element says of itself holds for its own runs of text, too.
    said = (np.int64(1) << kind) | (hints << len(KIND_NAMES))
    own = np.where(leaf == 1, said[parent] | 1, said)
    above = np.zeros(n, np.int64)
    own_list, above_list = said.tolist(), above.tolist()
    root_list = root.tolist()
    for i, up in enumerate(parent.tolist()):
        if i != root_list[i]:
            above_list[i] = above_list[up] | own_list[up]
    above = np.array(above_list, np.int64)

    in_text = (leaf == 1) & np.isin(kind[parent], [KIND_NAMES.index("p"), KIND_NAMES.index("heading")])
    all_chars, before = subtree(chars)
    links, _ = subtree(joined("links"))
    marks, _ = subtree(joined("punctuation"))
    digits, _ = subtree(joined("digits"))
    leaves, _ = subtree(leaf)
    elements, _ = subtree(1 - leaf)
    prose, _ = subtree(chars * in_text)
    total = all_chars[root]
    depth = np.zeros(n, np.int64)
    for i, up in enumerate(parent.tolist()):
        if i != root_list[i]:
            depth[i] = depth[up] + 1

    # Children of one parent stand together in this order, in page order.
    order = np.argsort(np.where(every == root, -1 - every, parent), kind="stable")
    same = np.concatenate([[False], parent[order][1:] == parent[order][:-1]])
    same &= (order != root[order]) & np.concatenate([[False], (order != root[order])[:-1]])
    group = np.cumsum(~same) - 1
    count = np.bincount(group)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    place, siblings, mean = np.empty(n), np.empty(n), np.empty(n)
    place[order] = np.arange(n) - first[group]
    siblings[order] = count[group]
    mean[order] = (np.bincount(group, all_chars[order]) / count)[group]
    before_chars, after_chars = np.zeros(n), np.zeros(n)
    before_links, after_links = np.zeros(n), np.zeros(n)
    density = links / (all_chars + 1)
    has, prior = order[1:][same[1:]], order[:-1][same[1:]]
    before_chars[has], before_links[has] = all_chars[prior], density[prior]
    after_chars[prior], after_links[prior] = all_chars[has], density[has]
    alike_key = np.empty(n, np.int64)
    alike_key[order] = group
    _, at, alike = np.unique(alike_key * len(KIND_NAMES) + kind, return_inverse=True, return_counts=True)

    mean_leaf = all_chars / np.maximum(leaves, 1)
    columns = {
        "chars": np.log1p(all_chars),
        "share": all_chars / (total + 1),
        "links": density,
        "marks": marks / (all_chars + 1),
        "digits": digits / (all_chars + 1),
        "mean_leaf": np.log1p(mean_leaf),
        "leaves": np.log1p(leaves),
        "elements": elements / (all_chars + 1),
        "prose": prose / (all_chars + 1),
        "depth": depth,
        "begins": before / (total + 1),
        "ends": (before + all_chars) / (total + 1),
        "place": np.log1p(place),
        "siblings": np.log1p(siblings),
        "alike": alike[at] / siblings,
        "siblings_mean": np.log1p(mean),
        "of_parent": all_chars / (all_chars[parent] + 1),
        "parent_links": density[parent],
        "parent_mean": np.log1p(mean_leaf[parent]),
        "parent_prose": prose[parent] / (all_chars[parent] + 1),
        "before_chars": np.log1p(before_chars),
        "after_chars": np.log1p(after_chars),
        "before_links": before_links,
        "after_links": after_links,
    }
    return {k: v.astype(np.float32) for k, v in columns.items()}, own, above


_BITS = len(KIND_NAMES) + len(HINT_NAMES)


def _matrix(columns: dict[str, np.ndarray], own: np.ndarray, above: np.ndarray, part: slice) -> np.ndarray:
    places = np.arange(_BITS)
    return np.column_stack(
        [
            *(values[part] for values in columns.values()),
            (own[part, None] >> places) & 1,
            (above[part, None] >> places) & 1,
        ]
    ).astype(np.float32)


def node_odds(pages: list[Page], forest: Forest) -> list[np.ndarray]:
    """Log odds of every node, page by page."""
    columns, own, above = _node_columns(pages)
    parts = [
        forest.raw(_matrix(columns, own, above, slice(first, first + CHUNK_NODES)))
        for first in range(0, len(own), CHUNK_NODES)
    ]
    return np.split(np.concatenate(parts), np.cumsum([len(p.parent) for p in pages])[:-1])


# Decoding


def kept_nodes(page: Page, odds: np.ndarray) -> list[bool]:
    """Nodes kept from the page downwards: the odds hold for a node whose parent is kept, so
    what stands in something dropped is not asked for."""
    keep = [True] * len(page.parent)
    for i, (up, worth) in enumerate(zip(page.parent, odds.tolist(), strict=True)):
        if i:
            keep[i] = worth > 0 and keep[up]
    return keep


def main_texts(htmls: list[str | None], forest: Forest, memory: dict[str, int] | None = None) -> list[str]:
    """The main text of every page, blocks joined by line feeds."""
    out = []
    pages: list[Page] = []
    chars = 0

    def close():
        for page, odds in zip(pages, node_odds(pages, forest) if pages else (), strict=True):
            keep = kept_nodes(page, odds)
            out.append("\n".join(t for t, k in zip(page.text, keep, strict=True) if t is not None and k))
        pages.clear()

    for html in htmls:
        pages.append(read_page(html, memory))
        chars += len(html or "")
        if chars >= CHUNK_CHARS:
            close()
            chars = 0
    close()
    return out


# Composed pages to learn from


class _Composer:
    """Pages of many layouts whose main text is known."""

    def __init__(self, texts: list[str], seed: int = 0):
        self.rng = random.Random(seed)
        self.texts = [t for t in texts if t.strip()] or [_FILLER]
        self.words = [w for t in self.texts for w in t.split()]

    def pick(self, *choices):
        return self.rng.choice(choices)

    def some(self, chance: float) -> bool:
        return self.rng.random() < chance

    def prose(self) -> str:
        text = self.rng.choice(self.texts)
        if self.some(0.15):
            text = " ".join(text.split()[: self.rng.randint(1, 6)])
        return text

    def label(self, least=1, most=4) -> str:
        return " ".join(self.rng.choice(self.words) for _ in range(self.rng.randint(least, most)))

    def named(self, element: str, inside: str, *names: str) -> str:
        """An element; its class or id says what it is, unless this page says nothing."""
        name = self.rng.choice(names) if names and self.speaks else ""
        given = f' {self.pick("class", "class", "id")}="{name}"' if name else ""
        return f"<{element}{given}>{inside}</{element}>"

    def part(self, semantic: str, inside: str, *names: str) -> str:
        """A part of the page, by its own element or as a named block."""
        if self.semantic and self.some(0.8):
            return self.named(semantic, inside, *names) if self.some(0.5) else f"<{semantic}>{inside}</{semantic}>"
        return self.named(self.pick("div", "div", "section"), inside, *names)

    def links(self, least=3, most=9) -> str:
        items = [f'<a href="/{i}">{escape(self.label(1, 3))}</a>' for i in range(self.rng.randint(least, most))]
        if self.some(0.75):
            return "<ul>" + "".join(f"<li>{item}</li>" for item in items) + "</ul>"
        return self.pick(" | ", " ", " &middot; ").join(items)

    def inline(self, text: str, mark: str) -> str:
        out = mark + escape(text)
        if self.some(0.2):
            out = f"<b>{out}" + ("</b>" if self.some(0.5) else "")
        if self.some(0.1):
            out += f' <a href="/x">{escape(self.label())}</a> {escape(self.label())}.'
        if self.some(0.1):
            out += "<br>"
        return out

    def article(self, m: str = _MARK) -> str:
        """Title and body; every block of it is marked."""
        out = []
        block = self.pick("p", "p", "p", "p", "div")
        for _ in range(self.rng.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            roll = self.rng.random()
            if roll < 0.74:
                end = "" if block == "p" and self.some(0.2) else f"</{block}>"
                out.append(f"<{block}>{self.inline(self.prose(), m)}{end}")
            elif roll < 0.82:
                level = self.pick("h2", "h3")
                out.append(f"<{level}>{m}{escape(self.label(2, 8))}</{level}>")
            elif roll < 0.88:
                kind = self.pick("ul", "ol")
                items = "".join(f"<li>{m}{escape(self.label(2, 18))}</li>" for _ in range(self.rng.randint(2, 5)))
                out.append(f"<{kind}>{items}</{kind}>")
            elif roll < 0.92:
                out.append(f"<blockquote>{self.pick('', '<p>')}{m}{escape(self.prose())}</blockquote>")
            elif roll < 0.94:
                out.append(f"<pre>{m}{escape(self.prose())}</pre>")
            elif roll < 0.96:
                rows = "".join(
                    "<tr>" + "".join(f"<td>{m}{escape(self.label(1, 3))}</td>" for _ in range(3)) + "</tr>"
                    for _ in range(self.rng.randint(2, 4))
                )
                out.append(f"<table>{rows}</table>")
            elif roll < 0.98:
                out.append(f"<figure><img src=x><figcaption>{m}{escape(self.label(3, 12))}</figcaption></figure>")
            else:
                out.append(f"{m}{escape(self.prose())}<br>{escape(self.prose())}<br>")
            if self.some(0.06):
                # Only its name tells such a part from the text around it.
                speaks, self.speaks = self.speaks, True
                out.append(self.rng.choice([self.advert, self.share, self.related, self.notice, self.form])())
                self.speaks = speaks
        if self.some(0.9):
            title = f"<h1>{m}{escape(self.label(2, 10))}</h1>"
            if self.some(0.15):
                title = f"<header>{title}</header>" if self.semantic else self.named("div", title, "entry-header")
            out.insert(0, title)
        return "".join(out)

    def menu(self):
        return self.part("nav", self.links(), "menu", "navbar", "main-navigation", "topbar")

    def top(self):
        name = self.named(self.pick("div", "h1", "p", "h2"), escape(self.label(1, 4)), "logo", "brand", "site-title")
        tagline = f"<p>{escape(self.label(2, 8))}</p>" if self.some(0.4) else ""
        return self.part("header", name + tagline + (self.menu() if self.some(0.4) else ""), "header", "masthead")

    def crumbs(self):
        return self.part("nav", self.links(2, 4), "breadcrumb", "breadcrumbs")

    def advert(self):
        inside = escape(self.rng.choice([self.label(3, 12), self.prose()]))
        inside = self.pick(inside, f"<p>{inside}</p>", f'<a href="/buy">{inside}</a>')
        return self.named("div", inside, "ad", "ads", "advert", "banner", "sponsored", "ad-slot", "promo-box")

    def notice(self):
        inside = f"<p>{escape(self.rng.choice([self.prose(), self.label(4, 14)]))}</p><button>{self.label(1, 2)}</button>"
        names = ("cookie-notice", "consent", "cookie-banner", "notice", "gdpr", "privacy-popup", "alert")
        return self.part("aside" if self.some(0.3) else "div", inside, *names)

    def form(self):
        fields = "".join(
            f"<{b}><label>{escape(self.label(1, 3))}</label><input></{b}>" for b in ["p", "div", "li"] if self.some(0.6)
        )
        intro = f"<p>{escape(self.label(3, 14))}</p>" if self.some(0.6) else ""
        inside = f"{intro}{fields}{escape(self.label(1, 2))} <input type=submit><button>{self.label(1, 2)}</button>"
        return self.named("form", inside, "search", "login", "signup", "newsletter", "subscribe")

    def share(self):
        return self.named("div", self.links(2, 5), "share", "social", "sharing", "follow")

    def teaser(self):
        return self.pick(
            f'<h3><a href="/t">{escape(self.label(2, 8))}</a></h3><p>{escape(self.label(4, 20))}</p>',
            f'<p><a href="/t">{escape(self.label(2, 8))}</a></p>',
            f"<h4>{escape(self.label(1, 4))}</h4>{self.links(2, 6)}",
            f"<p>{escape(self.prose())}</p>",
        )

    def related(self):
        inside = "".join(self.teaser() for _ in range(self.rng.randint(1, 4)))
        title = f"<h3>{escape(self.label(1, 3))}</h3>"
        return self.part("aside", title + inside, "related", "recommended", "more-stories", "trending", "popular")

    def side(self):
        boxes = [self.named("div", self.teaser(), "widget", "box", "module") for _ in range(self.rng.randint(1, 4))]
        if self.some(0.4):
            boxes.append(self.advert())
        if self.some(0.3):
            boxes.append(self.form())
        return self.part("aside", "".join(boxes), "sidebar", "side", "rail", "secondary", "widgets")

    def comments(self):
        names = ("comment", "reply", "comment-body", "comment")
        one = lambda: self.pick(
            f"<p>{escape(self.label(1, 2))}</p><p>{escape(self.prose())}</p>",
            f"<div>{escape(self.label(1, 3))}</div><div>{escape(self.prose())}</div>",
            f"<b>{escape(self.label(1, 2))}</b> {escape(self.prose())}",
            f"<p>{escape(self.prose())}</p>",
        )
        n = self.rng.randint(1, 7)
        if self.some(0.4):
            inside = "<ol>" + "".join(self.named("li", one(), *names) for _ in range(n)) + "</ol>"
        else:
            element = self.pick("div", "div", "article" if self.semantic and self.speaks else "div")
            inside = "".join(self.named(element, one(), *names) for _ in range(n))
        title = f"<h2>{escape(self.label(1, 3))}</h2>" if self.some(0.7) else ""
        form = self.form() if self.some(0.4) else ""
        # A discussion is told from the article by its name alone.
        speaks, self.speaks = self.speaks, True
        names = ("comments", "comment-list", "discussion", "reader-comments", "responses")
        out = self.named(self.pick("section", "div"), title + inside + form, *names)
        self.speaks = speaks
        return out

    def foot(self):
        line = f"&copy; {self.rng.randint(1998, 2025)} {escape(self.label(1, 4))}" + self.pick(
            "", f" &middot; {escape(self.prose())}", f" &middot; {escape(self.label(2, 9))}"
        )
        line = self.pick(line, f"<p>{line}</p>", f"{self.links(2, 6)}<p>{line}</p>", f"<p>{line}</p>{self.teaser()}")
        return self.part("footer", line, "footer", "site-footer", "copyright", "legal", "colophon")

    def alike(self) -> str:
        """A page whose parts hold the same and come in any order: names alone tell them apart."""
        self.semantic, self.speaks = True, True
        inside = lambda: self.pick(
            self.article(""), self.links(), escape(self.prose()), escape(self.label()), f"<p>{escape(self.prose())}</p>",
            f"&copy; {escape(self.label())} &middot; {escape(self.prose())}",
        )
        parts = [
            f"<{element}>{inside()}</{element}>" for element in ("nav", "header", "footer", "aside") if self.some(0.7)
        ]
        for names in (("ad", "advert", "banner", "sponsored"), ("comments", "comment-list"), ("cookie-notice", "consent"),
                      ("related", "popular"), ("sidebar", "widgets"), ("menu", "breadcrumb"), ("share", "social"),
                      ("footer", "copyright"), ("newsletter", "login")):
            if self.some(0.25):
                parts.append(self.named(self.pick("div", "section"), inside(), *names))
        if self.some(0.2):
            parts.append(self.form())
        names = ("content", "post", "entry-content", "article-body", "story")
        element = self.pick("article", "article", "main", "div")
        text = self.article()
        if self.some(0.15):
            text += parts.pop() if parts else ""
        parts.append(self.named(element, text, *names) if element == "div" else f"<{element}>{text}</{element}>")
        self.rng.shuffle(parts)
        return "".join(parts)

    def page(self) -> str:
        if self.some(0.35):
            return self.alike()
        self.semantic, self.speaks = self.some(0.7), self.some(0.9)
        inside = ""
        if self.some(0.94):
            inside = self.article()
            if self.some(0.12):
                inside += self.comments()
            names = ("content", "post", "entry-content", "article-body", "story", "main-text", "post-content")
            if self.semantic and self.some(0.85):
                inside = self.part(self.pick("article", "article", "main"), inside, *names)
            elif self.some(0.85):
                inside = self.named(self.pick("div", "div", "section"), inside, *names)
        before = [f() for f, c in ((self.top, 0.6), (self.menu, 0.75), (self.crumbs, 0.2), (self.notice, 0.3),
                                   (self.advert, 0.5), (self.form, 0.2)) if self.some(c)]
        after = [f() for f, c in ((self.share, 0.25), (self.comments, 0.35), (self.related, 0.35), (self.side, 0.4),
                                  (self.advert, 0.25), (self.form, 0.2), (self.notice, 0.2)) if self.some(c)]
        if self.some(0.3) and after:
            before.append(after.pop())
        self.rng.shuffle(before)
        wrapped = inside + "".join(after)
        for _ in range(self.pick(0, 0, 1, 2)):
            if self.some(0.1):
                wrapped = f"<table><tr><td>{self.links()}</td><td>{wrapped}</td></tr></table>"
            else:
                wrapped = self.named("div", wrapped, "wrapper", "container", "row", "col-8", "inner", "page", "site")
        if self.some(0.05):
            wrapped = f"<form>{wrapped}</form>"
        foot = self.foot() if self.some(0.85) else ""
        return f"<html><body>{''.join(before)}{wrapped}{foot}" + ("</body></html>" if self.some(0.8) else "")


def composed_pages(texts: list[str], n: int, seed: int = 0) -> list[tuple[str, list[str]]]:
    """Pages with the blocks of their main text."""
    composer = _Composer(texts, seed)
    out = []
    for _ in range(n):
        html = composer.page()
        blocks = [t.replace(_MARK, "") for t in read_page(html).text if t and _MARK in t]
        out.append((html.replace(_MARK, ""), blocks))
    return out


def fit_forest(texts: list[str], p: Params = Params()) -> Forest:
    """Odds that there is main text in a node's subtree, given that there is in its parent's."""
    composer = _Composer(texts)
    pages = [read_page(composer.page()) for _ in range(p.composed)]
    labels, asked = [], []
    for page in pages:
        label = [bool(t) and _MARK in t for t in page.text]
        for i in range(len(label) - 1, 0, -1):
            label[page.parent[i]] |= label[i]
        page.text = [t and t.replace(_MARK, "") for t in page.text]
        asked += [i > 0 and (label[up] or up == 0) for i, up in enumerate(page.parent)]
        labels += label
    asked = np.array(asked, bool)
    rows = _matrix(*_node_columns(pages), slice(None))
    return fit(rows[asked], np.array(labels, float)[asked], p.boosting)


# Spark


MODEL = "tree int, feature array<int>, bound array<double>, leaf array<double>"


def sample(pages: DataFrame, p: Params) -> DataFrame:
    """``texts`` of at most ``sample_pages`` pages, chosen by a hash of the id."""
    order = [F.xxhash64("page_id"), "page_id"]
    chosen = pages.select("page_id").distinct().orderBy(*order).limit(p.sample_pages)
    found = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id")
    texts, chars = p.sample_texts, p.sample_chars

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            own = [[t[:chars] for t in read_page(h).text if t][:texts] for h in part["html"]]
            yield pd.DataFrame({"page_id": part["page_id"], "texts": own})

    rows = found.mapInPandas(over, "page_id long, texts array<string>")
    return rows.orderBy(*order, "texts").limit(p.sample_pages)


def train(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """The fitted trees, a row each, and their bias in the row of tree -1."""

    def over(parts):
        texts = [t for part in parts for own in part["texts"] for t in own]
        forest = fit_forest(sorted(texts), p)
        yield pd.DataFrame(
            {
                "tree": [-1, *range(len(forest.leaf))],
                "feature": [[], *forest.feature.tolist()],
                "bound": [[], *forest.bound.tolist()],
                "leaf": [[forest.bias], *forest.leaf.tolist()],
            }
        )

    # One task fits: the sample is bounded by its parameters.
    return saved(sample(pages, p).coalesce(1).mapInPandas(over, MODEL), "extraction-model")


def load_forest(model: DataFrame) -> Forest:
    """As many rows as there are trees, a parameter."""
    rows = sorted(model.collect())
    bias, trees = rows[0].leaf[0], rows[1:]
    return Forest(bias, *(np.array([t[name] for t in trees]) for name in ("feature", "bound", "leaf")))


def text_column(spark: SparkSession, model: DataFrame, html: Column) -> Column:
    sent = spark.sparkContext.broadcast(load_forest(model))

    def over(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory: dict[str, int] = {}
        for part in parts:
            yield pd.Series(main_texts(list(part), sent.value, memory), dtype=object)

    over.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(over, "string")(html)


def extract(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page."""
    model = train(pages, p)
    text = text_column(pages.sparkSession, model, F.col("html"))
    return pages.select("page_id", "url", text.alias("text"))
