"""Merkle manifests against trees in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import plain
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from tidelog.llm import queries
from tidelog.llm.manifest import BLOCK, Manifest, OpenTree, block_roots, folded, proofs, siblings
from tidelog.operators.ordered import ordered_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def seal(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    i, text, lang, source, n = row
    told = [None if v is None else str(v) for v in (i, source, lang, n, text)]
    return seal(["-" if v is None else f"{len(v.encode())}:{v}" for v in told])


def climb(digests):
    """Root of a tree over digests and each leaf's [(place, siblings)]."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for leaf, path in enumerate(paths):
            run, place = at[leaf] // 8, at[leaf] % 8
            others = digests[8 * run:8 * run + 8]
            path.append((place, others[:place] + others[place + 1:]))
            at[leaf] = run
        digests = [seal(digests[k:k + 8]) for k in range(0, len(digests), 8)]
    return digests[0], paths


def fold(digest, path):
    for place, others in path:
        digest = seal(others[:place] + [digest] + others[place:])
    return digest


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    for rows_of in groups.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: climb([leaf_of(r) for r in groups[lang]]) for lang in langs}
    root, tops = climb([trees[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        for row, path in zip(groups[lang], trees[lang][1]):
            path = path + top
            hit = row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            tried = leaf_of((row[0], plain.low(row[1]), *row[2:])) if hit else leaf_of(row)
            again = fold(tried, path)
            out.append((row[0], leaf_of(row), trees[lang][0], root, seal([d for _, others in path for d in others]), again, again == root))
    return out


def query_columns(found):
    found = found.withColumn("folded_root", folded(F.col("tried"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded_root", F.col("folded_root") == F.col("root"))


def test_matches_sql(spark, sf_dir):
    problem, _ = differences(spark, sf_dir, connect(sf_dir), queries.QUERIES["op11_merkle_manifest"], queries.ORACLES["op11_merkle_manifest"])
    assert problem is None


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 600])
def test_open_tree(n):
    digests = [seal([str(i)]) for i in range(n)]
    tree = OpenTree()
    witnesses = [tree.append(d) for d in digests]
    if n > 8:
        assert len(witnesses[0]) >= 1 and not witnesses[-1] or n % 8 == 0  # closed runs have told theirs, the open one not
    root, paths = climb(digests)
    assert tree.finish(0) == root and witnesses == paths


def test_documents_with_gaps(spark):
    draw = random.Random(3)
    rows = [(i, f"Text {i} " + "É" * (i % 3), "en", f"s{i % 2}", i) for i in range(0, 3 * (BLOCK + 70), 3)]
    rows += [(i, "Ab", draw.choice(["de", None, "zz", "ß"]), None, None) for i in range(9)] + [(None, "No Id", "en", "s", 1), (None, "No Id", "en", "s", 1), (5, None, None, None, None), (5, "", "", "", 0), (7, "Xx", "one", "", 3)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", pos long, grp string").repartition(5)
    assert plain.multiset(query_columns(proofs(docs)).collect()) == plain.multiset(expected(rows))


def test_lone_document_and_none(spark):
    rows = [(3, "Only", "en", "s", 4)]
    assert [tuple(r) for r in query_columns(proofs(spark.createDataFrame(rows, SCHEMA))).collect()] == expected(rows)
    assert proofs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_appends_equal_one_build(spark):
    rows = [(i, f"T{i}", "en" if i % 5 else "fr", "s", i) for i in range(2 * BLOCK + 100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    manifest, closed = Manifest(), None
    for low, high in ((0, 700), (700, 703), (703, 2 * BLOCK + 100)):
        manifest.append(docs.where((F.col("doc_id") >= low) & (F.col("doc_id") < high)))
        part = expected(rows[:high])
        found = manifest.witnesses().select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof"))
        assert sorted(map(tuple, found.collect())) == sorted(r[:5] for r in part)
        if closed is not None:  # a block that is full keeps its root through later appends
            assert closed <= {(r.grp, r.pos, r.digest) for r in manifest.levels[1].collect()}
        closed = {(r.grp, r.pos, r.digest) for r in manifest.levels[1].collect() if r.grp == "en" and r.pos == 0}


def test_many_levels_of_blocks(spark):
    n = 700
    nodes = spark.range(n).select(F.lit("a").alias("grp"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), "id")
    numbered = ordered_scan(nodes, ["grp"], ["id"], number="pos").select("grp", "pos", "digest")
    roots = {r.pos: r.digest for r in block_roots(numbered).collect()}
    digests = [seal([str(i)]) for i in range(n)]
    assert roots[0] == climb(digests[:BLOCK])[0] and len(roots) == 2
    second = digests[BLOCK:]
    for _ in range(3):
        second = [seal(second[k:k + 8]) for k in range(0, len(second), 8)]
    assert [roots[1]] == second
