"""Main text of web pages: flat blocks, judged by word counts and link densities of a block and its neighbours."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.text import type_of

HIDDEN = frozenset("script style noscript template title iframe object svg math select textarea button option canvas audio video head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark meter q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav footer aside form header menu dialog".split())
MAIN = frozenset("article main".split())
SELF_CLOSING = frozenset("p li dt dd tr td th".split())  # the next one of the kind ends it
HINTS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr header menu modal nav navbar navigation newsletter "
    "notice pagination popup promo related reply replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# Parts of names that say something of a wrapper's state or layout, not what it is: has-sidebar, header-fixed.
STATES = frozenset("has no not with without free is hide hidden show toggle open closed fixed sticky active enabled disabled visible layout".split())
# Parts that go with a hint without a meaning of their own: ad-slot, site-header. Beside any other word, as in social-science, a hint is a weak one.
LAYOUT = frozenset(
    "site entry page main top bottom left right center upper lower box block bar list item items section wrapper wrap container inner outer area slot unit panel content text title "
    "link links user post blog global primary secondary region group row col column card mobile desktop form button thread message messages policy js responsive".split()
)
REMARKS = frozenset("comment comments disqus reply replies respond".split())  # what readers say may come as articles of its own
OWN = REMARKS | frozenset("ad ads advert advertisement promo related sponsor sponsored".split())  # what an article itself may be
SIZE = re.compile(r"[0-9]+(x[0-9]+)?")
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")  # Thai to Khmer, kana, Han

# Blocks labelled by hand. Words and link density in percent of a block, of the one before and of the one
# after; 1 where the block stands in an article or main element; 2 where it stands in a navigation, footer, aside, form,
# page header or an element named like one, 1 where only a part of a name says so; then 1 for main text, 0 for the rest.
LABELLED = """
1 100 0 0 1 100 0 2 0
1 100 1 100 1 100 0 2 0
1 100 1 100 8 0 0 2 0
2 100 2 100 1 100 0 2 0
3 100 2 100 12 0 0 2 0
4 100 0 0 3 100 0 0 0
2 100 4 100 2 100 0 0 0
3 100 3 100 40 0 0 0 0
8 0 1 100 10 0 0 2 0
5 0 1 100 12 0 0 2 0
14 0 1 100 6 0 0 2 0
40 0 2 100 15 0 0 2 0
25 10 60 0 9 0 0 2 0
10 0 8 0 45 0 1 0 1
12 0 8 0 120 0 1 0 1
3 0 14 0 30 0 1 0 1
45 0 10 0 90 0 1 0 1
120 0 45 0 1 0 1 0 1
1 0 90 0 60 0 1 0 1
2 0 60 0 2 0 1 0 1
1 0 2 0 15 0 1 0 1
15 0 1 0 10 0 1 0 1
7 0 80 0 12 0 1 0 1
4 0 300 0 14 0 1 0 1
200 3 60 0 45 8 1 0 1
60 12 200 3 30 0 1 0 1
30 45 60 12 100 0 1 0 1
9 0 30 0 0 0 1 0 1
20 25 50 0 60 0 1 0 1
6 100 50 0 60 0 1 0 1
5 0 11 0 5 0 1 0 1
4 0 10 0 4 0 1 0 1
4 0 4 0 4 0 1 0 1
3 0 4 0 3 0 1 0 1
6 0 8 0 6 0 1 0 1
5 0 5 0 3 0 1 0 1
8 0 9 0 4 0 1 0 1
2 0 3 0 1 0 1 0 1
1 0 2 0 1 0 1 0 1
2 0 6 0 0 0 1 0 1
4 100 4 100 4 100 1 0 0
3 100 4 100 5 100 1 0 0
8 100 3 100 8 100 1 0 0
5 0 80 0 6 0 1 2 0
6 100 5 0 3 100 1 2 0
40 0 12 0 35 0 1 2 0
35 0 40 0 50 0 1 2 0
18 0 6 0 22 0 1 2 0
12 0 90 0 0 0 0 2 0
10 0 4 0 0 0 0 2 0
20 5 150 0 0 0 0 2 0
9 30 120 0 3 100 0 2 0
6 0 200 0 4 100 0 2 0
30 0 7 0 30 0 0 2 0
80 0 15 0 60 0 0 2 0
60 2 80 0 5 0 0 2 0
6 0 3 100 70 0 0 0 1
70 0 6 0 90 0 0 0 1
90 4 70 0 110 2 0 0 1
110 2 90 4 30 0 0 0 1
30 0 110 2 45 0 0 0 1
45 20 30 0 60 0 0 0 1
25 0 60 0 45 0 0 0 1
60 0 25 0 8 0 0 0 1
35 0 8 0 0 0 0 0 1
150 0 2 100 3 100 0 0 1
50 0 3 100 4 100 0 0 1
12 0 60 0 70 0 0 0 1
8 0 90 0 80 0 0 0 1
5 0 3 100 4 100 0 0 0
7 0 2 100 2 100 0 0 0
4 50 3 100 3 0 0 0 0
9 60 40 0 6 100 0 0 0
12 90 30 0 10 80 0 0 0
25 80 12 90 14 100 0 0 0
10 80 70 0 8 90 0 0 0
8 70 45 0 5 100 0 0 0
12 100 60 0 45 0 1 0 1
6 0 8 60 0 0 0 0 0
8 40 50 0 0 0 0 0 0
3 0 4 0 5 0 0 0 0
5 0 3 0 2 0 0 0 0
2 0 5 0 0 0 0 0 0
120 0 90 0 110 0 0 2 1
150 0 120 0 100 0 0 2 1
100 2 150 0 90 0 0 2 1
180 4 100 2 140 0 0 2 1
60 0 45 0 80 0 0 1 1
35 0 60 0 50 0 0 1 1
150 0 3 0 90 0 0 1 1
45 0 0 0 30 0 0 1 1
30 0 45 0 0 0 0 1 1
25 5 40 0 60 0 0 1 1
170 0 120 0 0 0 0 1 1
110 0 0 0 150 0 0 1 1
8 0 60 0 70 0 0 1 1
4 100 3 100 5 100 0 1 0
6 0 2 100 40 0 0 1 0
12 30 60 0 8 100 0 1 0
3 0 5 100 2 100 0 1 0
10 80 12 90 9 100 0 1 0
18 0 90 0 3 100 0 1 0
9 0 0 0 4 100 0 1 0
2 0 3 0 4 0 0 1 0
20 0 0 0 0 0 0 0 1
40 0 0 0 0 0 0 0 1
1 0 2 100 60 0 1 0 1
1 0 2 100 45 0 1 0 1
1 0 0 0 60 0 1 0 1
2 0 0 0 40 0 1 0 1
3 0 2 100 30 0 1 0 1
4 0 5 100 70 0 1 0 1
2 0 1 100 55 0 1 0 1
1 0 60 0 45 0 1 0 1
"""


def words_in(text: str) -> int:
    """Words by blanks; where a script does without, two characters are one."""
    return len(text.split()) + (0 if text.isascii() else len(UNSPACED.findall(text)) // 2)


def hinted(attrs: list[tuple[str, str | None]], inside: bool) -> int:
    """What the words of class, id and role say: 3 what readers say, 2 a hint, alone or beside words of layout only, 1 a hint
    beside other words, else 0. A header inside an article is its own."""
    hints = HINTS - {"header"} if inside else HINTS
    level = 0
    for word in (word for k, v in attrs if k in ("class", "id", "role") and v for word in v.lower().split()):
        parts = word.replace("_", "-").split("-")
        if not hints.isdisjoint(parts) and STATES.isdisjoint(parts):
            clear = all(p in HINTS or p in LAYOUT or not p or SIZE.fullmatch(p) for p in parts)
            level = max(level, 1 if not clear else 2 if REMARKS.isdisjoint(parts) else 3)
    return level


def own_hint(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an article is named as a comment, an advert or a pointer to other articles."""
    words = (word.replace("_", "-") for k, v in attrs if k in ("class", "id", "role") and v for word in v.lower().split())
    return any(not OWN.isdisjoint(parts) and STATES.isdisjoint(parts) and all(p in HINTS or p in LAYOUT or SIZE.fullmatch(p) for p in parts) for parts in (w.split("-") for w in words))


class Blocks(HTMLParser):
    """Flat blocks of a page in order: (words with white space as one space, words in links, in main, level of boilerplate)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, int]] = []  # tag, and hidden, main, boilerplate as they were outside it
        self.depth: Counter = Counter()  # open elements by tag
        self.hidden, self.main, self.links = False, False, 0
        self.boiler = 0  # 1 by a weak hint, 2 by a name or a form, header or dialog, 3 by a nav, footer, aside, menu or comments
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, int, bool, int]] = []

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, self.linked, self.main, min(self.boiler, 2)))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.end_block()
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in INLINE:
            if tag == "a":
                self.links = 1
            return
        if tag in SELF_CLOSING and self.open and self.open[-1][0] == tag or tag == "body" and self.depth["head"]:
            self.close_element("head" if tag == "body" else tag)
        hidden = tag in HIDDEN or any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        self.open.append((tag, self.hidden, self.main, self.boiler))
        self.depth[tag] += 1
        inside = self.main
        self.hidden |= hidden
        self.main |= tag in MAIN
        if tag in MAIN:  # what is around it was a wrapper; an article inside the main text may be a comment or a teaser
            cleared = 3 if tag == "main" else 1 if inside else 2
            self.boiler = 3 if tag == "article" and own_hint(attrs) else self.boiler if self.boiler > cleared else 0
        elif tag in ASIDE and not (tag == "header" and inside):
            self.boiler = max(self.boiler, 3 if tag in ("nav", "footer", "aside", "menu") else 2)
        elif tag not in ("html", "body"):
            self.boiler = max(self.boiler, hinted(attrs, inside))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.links = 0
            return
        self.end_block()
        if self.depth[tag]:
            self.close_element(tag)
            self.links = 0

    def close_element(self, tag: str) -> None:
        """End the innermost element of this tag and all that is open inside it."""
        name = None
        while name != tag:
            name, self.hidden, self.main, self.boiler = self.open.pop()
            self.depth[name] -= 1

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += words_in(data)


def blocks_of(html: str) -> list[tuple[str, int, bool, int]]:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.end_block()
    return parser.blocks


def features_of(blocks: list[tuple[str, int, bool, int]]) -> np.ndarray:
    """Per block: words and link density in percent of itself, the one before and the one after; in main; how clearly boilerplate."""
    words = np.array([words_in(text) for text, _, _, _ in blocks])
    density = 100 * np.minimum(np.array([linked for _, linked, _, _ in blocks]), words) / words
    own = np.stack([words, density], axis=1)
    edge = np.zeros((1, 2))
    flags = np.array([[main, boiler] for _, _, main, boiler in blocks], float)
    return np.concatenate([own, np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge]), flags], axis=1)


class Tree:
    """A binary decision tree by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2):
        self.share = float(y.mean()) if len(y) else 0.0
        self.left = self.right = None
        if depth and len(y) >= 2 * least and 0 < self.share < 1:
            best = min(self._splits(x, y, least), default=None)
            if best and best[0] < 2 * self.share * (1 - self.share) - 1e-9:
                _, self.column, self.limit = best
                low = x[:, self.column] <= self.limit
                self.left, self.right = Tree(x[low], y[low], depth - 1, least), Tree(x[~low], y[~low], depth - 1, least)

    @staticmethod
    def _splits(x: np.ndarray, y: np.ndarray, least: int) -> Iterator[tuple[float, int, float]]:
        for column in range(x.shape[1]):
            values = np.unique(x[:, column])
            for limit in (values[:-1] + values[1:]) / 2:
                low = x[:, column] <= limit
                if least <= low.sum() <= len(y) - least:
                    sides = [(part.mean(), len(part) / len(y)) for part in (y[low], y[~low])]
                    yield sum(2 * p * (1 - p) * weight for p, weight in sides), column, float(limit)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(x), self.share >= 0.5)
        low = x[:, self.column] <= self.limit
        out = np.zeros(len(x), bool)
        out[low], out[~low] = self.left.predict(x[low]), self.right.predict(x[~low])
        return out


def learn_tree(labelled: str = LABELLED) -> Tree:
    rows = np.array([line.split() for line in labelled.split("\n") if line], float)
    return Tree(rows[:, :-1], rows[:, -1])


def main_text(html: str | None, tree: Tree) -> str:
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    kept = tree.predict(features_of(blocks))
    own = np.array([main and not boiler for _, _, main, boiler in blocks])
    between = np.zeros(len(blocks), bool)  # a paragraph that is nearly all link, between two kept ones of the article
    between[1:-1] = (kept & own)[:-2] & own[1:-1] & (kept & own)[2:]
    return "\n\n".join(block[0] for block, keep in zip(blocks, kept | between) if keep)


def extract(pages: DataFrame, carry: list[str], html_col: str = "html", labelled: str = LABELLED) -> DataFrame:
    """`carry` and `text`, the main text, of every row of pages.

    A block is what stands between two tags of block elements, with character references decoded, white space as one space
    and outer white space gone; scripts, styles, titles and form controls give no text. The tree is learned from the
    labelled table, then keeps or drops each block; kept ones are joined by an empty line. Null and empty html, and
    pages without a kept block, give an empty text. Unclosed and stray tags are borne. Pages are read whole, each by itself.
    """
    tree = learn_tree(labelled)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, tree) for html in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "text"])

    read = pages.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(html_col).alias("_html"))
    return read.mapInArrow(work, ", ".join([f"`{c}` {type_of(pages, c)}" for c in carry] + ["text string"]))
