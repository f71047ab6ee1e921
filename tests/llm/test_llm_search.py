"""Decontamination, personal data and the Merkle audit."""

import hashlib
import random

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import connect, differences
from tidelog.llm import queries
from tidelog.llm.decontaminate import contamination, positional_index, proximity
from tidelog.llm.merkle import audit, lay_out
from tidelog.llm.pii import Field, base_spans, find_pii, fit_field


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", ["op7_decontamination", "op9_merkle_audit"])
def test_matches_sql(spark, sf_dir, con, name):
    problem, _ = differences(spark, sf_dir, con, queries.QUERIES[name], queries.ORACLES[name])
    assert problem is None


def passages():
    draw = random.Random(2)
    word = lambda: draw.choice("ab") + draw.choice(["é", "1", "z"]) * draw.randrange(1, 3)
    items = [(1, " ".join(word() for _ in range(25))), (2, "Short, item!"), (3, None), (4, "... ---"), (None, "no id here " * 4), (5, "one"), (5, "one other"), (6, "a a a a a a a a a a a a")]
    rows = [(10, None), (11, ""), (12, "?!"), (None, "x short item y"), (13, "a " * 30), (14, "one"), (15, "SHORT-ITEM short item"), (15, "no id here no id here no id here no"), (15, "nothing")]
    for i in range(20, 60):
        text = [word() for _ in range(draw.randrange(0, 60))]
        if i % 2:
            text[5:5] = plain.words(items[0][1])[draw.randrange(8):][:draw.choice([9, 10, 14])]
        rows.append((i, " ".join(text)))
    return rows, items


def test_contamination(spark):
    rows, items = passages()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, row int, term int").repartition(3)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, pos int")
    assert plain.multiset(contamination(docs, benchmark).collect()) == plain.multiset(plain.contamination(rows, items))


def test_contamination_of_nothing(spark):
    rows, items = passages()
    docs, benchmark = (spark.createDataFrame(x, f"{c} long, text string") for x, c in ((rows, "doc_id"), (items, "item_id")))
    assert contamination(docs.limit(0), benchmark).collect() == []
    assert plain.multiset(contamination(docs, benchmark.limit(0)).collect()) == plain.multiset(plain.contamination(rows, []))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x blue x x x x red"), (2, "blue red red"), (3, "red")], "doc_id long, text string").coalesce(1)
    found = proximity(positional_index(docs), "red", "blue", 3).select("first", "second").collect()
    assert sorted(map(tuple, found)) == [(0, 3), (1, 0), (2, 0)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["@", ".", "-", "+", " ", "(", ")", "a", "Z9", "%", "1", "4111", "255", "256", "4111111111111111", "example", "\n", "é", "0"]), max_size=40).map("".join))
def test_base_spans(text):
    assert base_spans(text) == plain.personal(text)


def test_base_spans_of_long_runs():
    assert base_spans("1" * 200_000 + "a" * 200_000 + "@" * 1000 + "." * 1000) == []


def contacts():
    draw = random.Random(4)
    number = lambda n: "".join(draw.choice("0123456789") for _ in range(n))

    def card():
        while not plain.luhn(found := "4" + number(15)):
            pass
        return found

    rows = []
    for i in range(120):
        kinds = [f"u{number(2)}@mail.example.com", ".".join(str(draw.randrange(256)) for _ in range(4)), card(), f"+1 ({number(3)}) 555-{number(4)}", f"key={number(20)}", number(2)]
        rows.append((i, " and then ".join(draw.sample(kinds, 4))))
    return rows


def test_field_carries_labels(spark):
    rows = contacts()
    card = next(m for _, t in rows for m in t.split() if len(m) == 16 and m.isdigit())
    extra = [(500, f"pay {card} 53.121.55.90 or {card[:4]}-{card[4:8]}-{card[8:12]}-{card[12:]} now"), (501, None), (502, ""), (503, "write to joe.7@mail.example.com . ask joe.7 for it"), (None, "x")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows + extra], "doc_id long, text string, base int")
    found = {r.doc_id: r for r in find_pii(docs, fit_field(docs)).collect()}
    assert len(found) == len(rows) + len(extra)
    for i, text in rows + extra:
        base = [(s.start, s.end, s.kind) for s in found[i].base]
        assert base == plain.personal(text or "") and set(base) <= {(s.start, s.end, s.kind) for s in found[i].spans}
    assert (4, 20, "card") in {(s.start, s.end, s.kind) for s in found[500].spans} and not any(s.start == 4 for s in found[500].base)
    assert any(s.kind == "email" and "joe.7" == extra[3][1][s.start:s.end] for s in found[503].spans)
    assert not found[501].spans and not found[502].spans


def test_query_counts_and_digests(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_pii_spans"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and sum(r.n_card + r.n_phone for r in rows) > 0
    for r in rows:
        base = plain.personal(texts[r.doc_id])
        told = [f"{kind}:{s}:{e}" for s, e, kind in base]
        counts = plain.Counter(kind for _, _, kind in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(",")) and len(told) + r.n_added == len([x for x in r.spans.split(",") if x])


def test_field_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    field = fit_field(docs)
    assert isinstance(field, Field) and find_pii(docs, field).collect() == []


def replicas(spark, n=300):
    draw = random.Random(6)
    rows = [(f"f{i % 3}" if i % 50 else None, i, draw.randrange(1, 4000), hashlib.sha256(bytes([i % 256])).hexdigest()) for i in range(n)]
    placed = lay_out(spark.createDataFrame(rows, "file string, i long, length long, digest string"), "file", ["i"], "length").select("file", "offset", "length", "digest").collect()
    return [tuple(r) for r in placed]


def test_audit_finds_each_fault(spark):
    first = replicas(spark)
    assert sorted(first, key=str)[0][1] >= 0
    altered, missing = first[10], first[200]
    second = [r for r in first if r != missing]
    second[second.index(altered)] = (*altered[:3], "0" * 64)
    extra = ("f1", 10**9, 5, "e" * 64)
    rows = [("a", *r) for r in first] + [("b", *r) for r in second + [extra]] + [("a", "f1", None, 1, None), ("b", "f0", 10**9 + 5, 1, None)]
    got = audit(spark.createDataFrame(rows, "replica string, file string, offset long, length long, digest string"), "a", "b", range_bytes=4096).collect()
    want = [(*altered[:2], altered[3], "0" * 64, "altered"), (*missing[:2], missing[3], None, "missing"), ("f1", 10**9, None, "e" * 64, "extra"), ("f0", 10**9 + 5, None, "", "extra")]
    assert plain.multiset(got) == plain.multiset(want)


def test_audit_of_equal_replicas(spark):
    rows = [(side, *r) for r in replicas(spark) + replicas(spark)[:5] for side in "ab"]
    frame = spark.createDataFrame(rows, "replica string, file string, offset long, length long, digest string")
    assert audit(frame, "a", "b").collect() == [] and audit(frame.limit(0), "a", "b").collect() == []
    fewer = frame.unionByName(spark.createDataFrame([("a", *replicas(spark)[0])], frame.schema))
    assert [r.fault for r in audit(fewer, "a", "b").collect()] == ["missing"]


def test_all_near_pairs_and_words_beyond_ascii(spark):
    docs = spark.createDataFrame([(1, "red blue x blue RED y y y blue"), (2, "Über den Été")], "doc_id long, text string")
    index = positional_index(docs)
    got = sorted((r.first, r.second) for r in proximity(index, "Red", "BLUE", 4).collect())
    assert got == [(0, 1), (0, 3), (4, 1), (4, 3), (4, 8)]
    assert [(r.first, r.second) for r in proximity(index, "Über", "Été", 2).collect()] == [(0, 2)]
    assert proximity(index, "red", "blue", 0).collect() == []


def test_pages_without_an_id_are_in_both_replicas(spark, tmp_path):
    rows = [(None, "u", "<p>a"), (None, "u", "<p>b")] + [(i, "u", "<p>c") for i in range(20)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert [r for r in queries.QUERIES["op9_merkle_audit"](spark, str(tmp_path)).collect() if r.file is None] == []
