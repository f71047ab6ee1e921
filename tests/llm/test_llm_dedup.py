"""Exact, line and near duplicates, components and perfect hashes against plain Python."""

import random

import numpy as np
import plain
import pytest

from compare import connect, differences
from tidelog.llm import queries
from tidelog.llm.components import components
from tidelog.llm.exact import exact_groups
from tidelog.llm.lines import Shard, drop_repeated_lines
from tidelog.llm.neardup import near_duplicates
from tidelog.llm.perfect_hash import PerfectHash, halves
from tidelog.llm.shingles import MinHash, shingles, word_hashes

SCHEMA = "doc_id long, text string, digest string, line int, key string, node long, lang string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, "k", 5, None) for i, t in rows], SCHEMA)


def corpus(seed=3):
    """Copies, near copies, shared lines, nulls, empties, blanks, repeated rows and ids, long and short texts."""
    draw = random.Random(seed)
    word = lambda: draw.choice(["the", "Of", "größe", "éa", "x1"]) + str(draw.randrange(400))
    rows = [(900, None), (901, ""), (902, " \n\t "), (None, "null id"), (None, None), (903, "one"), (904, "ONE"), (905, "one two"), (906, "É"), (907, "é")]
    shared = "Read more about our terms and conditions of service HERE"
    for i in range(40):
        text = " ".join(word() for _ in range(draw.choice([3, 30, 120])))
        rows.append((i, text + ("\n  " + shared.upper() + "\r" if i % 3 == 0 else "") + ("\n" + shared[:39] if i % 4 == 0 else "")))
    base = [word() for _ in range(150)]
    for i in range(100, 190):
        copy = list(base)
        for _ in range(draw.choice([0, 0, 1, 2, 4, 8])):
            copy[draw.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy)))
    rows += [(i, "Copied Text number one\n" + shared) for i in range(200, 260)] + [(i, "copied text NUMBER one\n" + shared) for i in range(260, 270)]
    rows += [(300, "same id"), (300, "same id"), (300, "another text"), (301, "long " * 30_000 + "\n" + shared), (None, shared), (None, "copied text number one\n" + shared)]
    draw.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op4_line_dedup", "op8_near_duplicates"])
def test_matches_sql(spark, sf_dir, con, name):
    problem, _ = differences(spark, sf_dir, con, queries.QUERIES[name], queries.ORACLES[name])
    assert problem is None


@pytest.mark.parametrize("tracked,heavy", [(8192, 1024), (16, 4)])
def test_exact_groups(spark, tracked, heavy):
    rows = corpus()
    got = exact_groups(frame(spark, rows).repartition(7), tracked=tracked, heavy=heavy).collect()
    assert plain.multiset(got) == plain.multiset(plain.exact_groups(rows))


@pytest.mark.parametrize("heavy", [10_000, 4])
def test_repeated_lines(spark, monkeypatch, heavy):
    monkeypatch.setattr("tidelog.llm.lines.HEAVY", heavy)
    rows = corpus()
    got = drop_repeated_lines(frame(spark, rows), carry=["line"]).select("doc_id", "kept_text", "n_lines", "n_dropped").collect()
    assert plain.multiset(got) == plain.multiset(plain.line_dedup(rows))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    rows = corpus()
    got = near_duplicates(frame(spark, rows), size=size, percent=percent).collect()
    assert plain.multiset(got) == plain.multiset(plain.near_groups(rows, size, percent))


def test_long_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr("tidelog.llm.neardup.SHORT", 2)
    monkeypatch.setattr("tidelog.llm.neardup.BLOCK", 16)
    rows = [r for r in corpus(5) if r[0] is not None and 100 <= r[0] < 190]
    got = near_duplicates(frame(spark, rows), size=3, percent=85).collect()
    assert plain.multiset(got) == plain.multiset(plain.near_groups(rows, 3, 85))


@pytest.mark.parametrize("operator", [exact_groups, drop_repeated_lines, near_duplicates])
def test_no_rows(spark, operator):
    assert operator(frame(spark, [])).collect() == []


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if x in got} and {x for e in edges if e[0] != e[1] for x in e} == set(got)


def test_perfect_hash_is_minimal():
    keys = [random.Random(i).randbytes(16) for i in range(5000)]
    a, b = halves(keys)
    built = PerfectHash.build(a, b)
    again = PerfectHash.load(built.dump())
    assert sorted(again.index(a, b)) == list(range(5000))
    assert sum(len(bits) for bits in built.levels) < 4.5 * 5000


def test_fingerprints_tell_other_lines():
    import pyarrow as pa

    keys = [random.Random(i).randbytes(16) for i in range(400)]
    shard = Shard.load(Shard.of(pa.table({"line": keys[:200], "n": [5] * 200, "winner": pa.array([7] * 100 + [None] * 100, pa.int64())})).row())
    held, lost = shard.probe(keys, pa.array([7] * 400, pa.int64()))
    assert list(held) == [True] * 200 + [False] * 200 and list(lost) == [False] * 100 + [True] * 100 + [False] * 200


def test_shingle_hashes_follow_words():
    assert list(word_hashes(b"Ab  c\tab\n")) == list(word_hashes(b"aB C AB"))
    assert len(shingles(b"a b", 3)) == 1 and not len(shingles(b" \n", 3))
    assert shingles(b"a b", 3) != shingles(b"b a", 3)
    long = b"word other " * 200_000
    assert len(word_hashes(long)) == 400_000 and len(shingles(long, 3)) == 2


def test_signatures_estimate_similarity():
    hashes = MinHash(512)
    x, y = (np.random.default_rng(i).integers(0, 2**63, 900).astype(np.uint64) for i in (1, 2))
    x[:600] = y[:600]
    assert abs((hashes.sign(x) == hashes.sign(y)).mean() - 0.5) < 0.09
