"""The operators' results in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
WHITE = " \t\n\x0b\x0c\r"


def low(text):
    return (text or "").translate(LOWER)


def exact_groups(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[low(text)].append(i)
    out = []
    for i, text in rows:
        ids = groups[low(text)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(low(text).encode()).hexdigest()))
    return out


def line_dedup(rows, chars=40, docs=5):
    key = lambda line: low(line.strip(WHITE))
    held = defaultdict(list)
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= chars:
                held[k].append(i)
    winner = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [line for line in lines if key(line) not in winner or winner[key(line)] == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def near_groups(rows, size, percent):
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for at, (i, _) in enumerate(rows):
        if i is not None:
            least[find(at)].append(i)
    names = [min(least[find(at)], default=None) if sets[at] else i for at, (i, _) in enumerate(rows)]
    return [(i, len(sets[at]), names[at], i == names[at]) for at, (i, _) in enumerate(rows)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contamination(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[s:s + window])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def luhn(digits):
    total = 0
    for at, d in enumerate(reversed(digits)):
        d = int(d) * (1 + at % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def grams(text, longest=3):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in (text or "").lower())):
        out.update(word)
        for n in range(2, longest + 1):
            padded = f" {word} "
            out.update(padded[i:i + n] for i in range(len(padded) - n + 1))
    return out


def multiset(rows):
    return Counter(tuple(r) for r in rows)
