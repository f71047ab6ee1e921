"""Personal data: patterns, and a skip-chain conditional random field that carries their labels to similar tokens."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.text import type_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_DOCS = 20_000  # documents that the field is fitted on, those with the least hash of their id
ROUNDS = 30  # most sweeps of messages
DAMPING = 0.3
BOUND = 6  # of a pair's weight
SURE = 0.6  # least marginal of a label that makes a span

# The patterns of the four kinds. A leading look-behind only says where a leftmost match can begin.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"\S+")
TRIM = ".,;:!?\"'"


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, leftmost and non-overlapping within a kind; those that fail their
    check are dropped. Sorted by start, then by kind in the order of KINDS."""
    found = []
    if "@" in text:
        floor, at = 0, text.find("@")
        while at >= 0:
            match = DOMAIN.match(text, at)
            if match:
                start = at
                while start > floor and text[start - 1] in LOCAL:
                    start -= 1
                if start < at:
                    found.append((start, match.end(), "email"))
                    floor = match.end()
            at = text.find("@", at + 1)
    if DIGIT.search(text):
        for match in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (part.lstrip("0") or "0" for part in match.group().split("."))):
                found.append((*match.span(), "ip"))
        for match in CARD.finditer(text):
            if match.end() - match.start() >= 12:
                digits = match.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    found.append((*match.span(), "card"))
        if "+" in text:
            for match in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
                    found.append((*match.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def features(word: str, before: str, after: str) -> int:
    """What a token looks like, as bits; the patterns' checks are not among them."""
    digits = sum(c.isdigit() and c.isascii() for c in word)
    marks = [
        "@" in word, word.startswith("+"), "(" in word, "=" in word, '"' in word, "." in word, word.count(".") == 3, "-" in word,
        any(c.isalpha() for c in word), 1 <= digits <= 3, 4 <= digits <= 8, 9 <= digits <= 11, 12 <= digits <= 19, digits > 19,
        not word.strip("0123456789.-()+"), before.startswith("+"), before.startswith("("), after.startswith("("),
        bool(re.fullmatch(r"[0-9]{3}-[0-9]{4}", word)), bool(re.fullmatch(r"[0-9]{3}-[0-9]{4}", after)),
    ]
    return sum(bit << i for i, bit in enumerate(marks))


N_FEATURES = 20


class Nodes:
    """Tokens of a document that take part: those with digits or an @, and those that equal an address's first part."""

    def __init__(self, text: str, base: list[tuple[int, int, str]]):
        tokens = [(m.start() + len(m.group()) - len(m.group().lstrip(TRIM)), m.group().strip(TRIM)) for m in TOKEN.finditer(text)]
        locals_ = {text[s:e].split("@")[0].lower() for s, e, kind in base if kind == "email"}
        self.start, self.end, self.place, self.bits, self.label, self.keys = [], [], [], [], [], []
        at = 0
        for place, (start, word) in enumerate(tokens):
            if not ("@" in word or DIGIT.search(word) or word.lower() in locals_):
                continue
            end = start + len(word)
            while at < len(base) and base[at][1] <= start:
                at += 1
            over = [kind for s, e, kind in base[at:at + 8] if s < end and e > start]
            near = [tokens[p][1] if 0 <= p < len(tokens) else "" for p in (place - 1, place + 1)]
            self.start.append(start)
            self.end.append(end)
            self.place.append(place)
            self.bits.append(features(word, *near))
            self.label.append(LABELS.index(min(over, key=KINDS.index)) if over else 0)
            plain = "".join(c for c in word.lower() if c.isalnum())
            self.keys.append({plain, "".join(c for c in word.lower().split("@")[0] if c.isalnum())} - {""})

    def edges(self) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Chain edges between neighbouring tokens, and skip edges from a token to the next one like it, so that any
        number of repeats is linked by as many edges."""
        chain = [(i, i + 1) for i in range(len(self.place) - 1) if self.place[i + 1] == self.place[i] + 1]
        last: dict[str, int] = {}
        skip = set()
        for i, keys in enumerate(self.keys):
            skip |= {(last[k], i) for k in keys if k in last}
            last.update(dict.fromkeys(keys, i))
        return chain, sorted(skip - set(chain))


class Field:
    """Weights: one per feature and label, one table of label pairs per kind of edge."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.weights, self.chain, self.skip = weights, chain, skip

    @classmethod
    def fit(cls, tokens: list[tuple[int, int, int]], pairs: list[tuple[str, int, int, int]]) -> "Field":
        """Piecewise: a softmax over tokens (bits, label, n), and for each kind of edge how much more often two labels meet
        than by chance, from (edge, label, label, n). Where a token without a label is like one with a label, its own is
        not known, so skip edges learn from the other pairs, and expect equal labels beforehand."""
        rows = [(b, y, n) for b, y, n in tokens if n]
        weights = np.zeros((N_FEATURES + 1, len(LABELS)))
        if rows:
            x = np.array([[b >> i & 1 for i in range(N_FEATURES)] + [1] for b, _, _ in rows], float)
            y = np.eye(len(LABELS))[[y for _, y, _ in rows]]
            n = np.array([n for _, _, n in rows], float)[:, None] / sum(n for _, _, n in rows)
            speed = np.zeros_like(weights)
            for _ in range(800):
                speed = 0.9 * speed + x.T @ (n * (y - _softmax(x @ weights))) - 1e-5 * weights
                weights = weights + speed
        tables = []
        for edge in ("chain", "skip"):
            seen = 0.1 + (5 * np.eye(len(LABELS)) if edge == "skip" else 0)
            seen = seen * np.ones((len(LABELS), len(LABELS)))
            for _, a, b, n in (p for p in pairs if p[0] == edge):
                if edge == "chain" or (a > 0) == (b > 0):
                    seen[a, b] += n
            if edge == "skip":
                seen = seen + seen.T
            seen /= seen.sum()
            tables.append(np.clip(np.log(seen / np.outer(seen.sum(1), seen.sum(0))), -BOUND, BOUND))
        return cls(weights, *tables)

    def marginals(self, bits: np.ndarray, known: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Loopy sum-product over all edges at once, damped, until messages rest. Known labels (> 0) are held."""
        own = ((bits[:, None] >> np.arange(N_FEATURES)) & 1) @ self.weights[:-1] + self.weights[-1]
        own = np.where(known[:, None] > 0, np.where(np.arange(len(LABELS)) == known[:, None], 0.0, -30.0), own)
        forth = np.concatenate([chain, skip])
        if not len(forth):
            return _softmax(own)
        pair = np.concatenate([np.broadcast_to(self.chain, (len(chain), *self.chain.shape)), np.broadcast_to(self.skip, (len(skip), *self.skip.shape))])
        source, target = np.concatenate([forth[:, 0], forth[:, 1]]), np.concatenate([forth[:, 1], forth[:, 0]])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(source)), len(forth))
        messages = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, messages)
            new = _logsum((belief[source] - messages[back])[:, :, None] + pair)
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            if moved < 1e-4:
                break
        belief = own.copy()
        np.add.at(belief, target, messages)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to counts (what, a, b, n): tokens by their features and label, edges by their two labels."""
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text and ("@" in text or DIGIT.search(text)):
                nodes = Nodes(text, base_spans(text))
                counts.update(("token", b, y) for b, y in zip(nodes.bits, nodes.label))
                for what, edges in zip(("chain", "skip"), nodes.edges()):
                    counts.update((what, nodes.label[i], nodes.label[j]) for i, j in edges)
    rows = [(*key, n) for key, n in counts.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if i == 0 else pa.int64()) for i in range(4)], ["what", "a", "b", "n"])


def fit_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> Field:
    """The field, fitted on the labels that the patterns give the tokens of at most train_docs documents, those with the
    least hash of their id; counts of at most 2 ** N_FEATURES kinds of tokens come to the driver."""
    spread = F.xxhash64(F.col(id_col))
    bound = docs.select(spread.alias("h")).orderBy("h").limit(train_docs).agg(F.max("h")).first()[0]
    chosen = docs.where(spread <= F.lit(bound)).select(text_col)
    rows = chosen.mapInArrow(gather, "what string, a long, b long, n long").groupBy("what", "a", "b").agg(F.sum("n").alias("n")).orderBy("what", "a", "b").collect()
    return Field.fit([(r.a, r.b, r.n) for r in rows if r.what == "token"], [tuple(r) for r in rows if r.what != "token"])


def _added(nodes: list[Nodes], field: Field) -> list[list[tuple[int, int, str]]]:
    """Per document the spans that the field adds: runs of neighbouring tokens of one sure label, outside base spans."""
    sizes = np.cumsum([0] + [len(n.place) for n in nodes])
    edges = [n.edges() for n in nodes]
    chain, skip = (np.array([(a + at, b + at) for both, at in zip(edges, sizes) for a, b in both[i]], np.int64).reshape(-1, 2) for i in (0, 1))
    known = np.array([y for n in nodes for y in n.label], np.int64)
    likely = field.marginals(np.array([b for n in nodes for b in n.bits], np.int64), known, chain, skip)
    best = np.where((known == 0) & (likely.max(axis=1) >= SURE), likely.argmax(axis=1), 0)
    out = []
    for n, at in zip(nodes, sizes):
        spans: list[tuple[int, int, str]] = []
        before = None
        for i, place in enumerate(n.place):
            label = best[at + i]
            if label and before == (place - 1, label):
                spans[-1] = (spans[-1][0], n.end[i], LABELS[label])
            elif label:
                spans.append((n.start[i], n.end[i], LABELS[label]))
            before = (place, label) if label else None
        out.append(spans)
    return out


def find_pii(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end in code points, end exclusive) for every row of docs.

    base holds the patterns' matches; spans these and what the field adds. Null and empty texts have none. Whole texts are
    read; rows of one id, or without, are looked at each by itself. Messages pass inside a document only.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for s, e, k in spans]
        for batch in batches:
            base, nodes, at = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                base.append(base_spans(text or ""))
                if text and ("@" in text or DIGIT.search(text)):
                    nodes.append(Nodes(text, base[-1]))
                    at.append(row)
            spans = list(base)
            if any(n.place for n in nodes):
                for row, added in zip(at, _added(nodes, field)):
                    spans[row] = sorted(base[row] + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(as_rows, base)), span), pa.array(list(map(as_rows, spans)), span)], ["doc_id", "base", "spans"])

    kind = "array<struct<kind: string, start: long, end: long>>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, f"doc_id {type_of(docs, id_col)}, base {kind}, spans {kind}")
