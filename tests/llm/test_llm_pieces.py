"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from tidelog.llm import queries
from tidelog.llm.encode import tokenizer_path
from tidelog.llm.pieces import MODEL, Pieces, encode


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=tokenizer_path(MODEL))


@pytest.fixture(scope="module")
def own():
    return Pieces(tokenizer_path(MODEL))


LETTERS = ["a", "b", "e", "t", "h", "s", "n", "ing", "the", " ", "  ", "▁", "\n", "\t", "\r", "0", "12", "é", "你", "😀", "́", "==", "==========", "<s>", "</s>", "<0x0A>", "\x00", "​", "ﬁ", "�"]


def agree(own, library, text):
    want = library.encode(text)
    got = own.ids([text])[0].tolist()
    assert got == want
    assert own.text(got) == library.decode(want)


def test_generated_texts(own, library):
    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.sampled_from(LETTERS), max_size=30).map("".join))
    def check(text):
        agree(own, library, text)

    check()


def test_texts_of_pieces(own, library):
    draw = random.Random(5)
    names = list(own.names.values())
    for _ in range(4000):
        agree(own, library, "".join(draw.choice(names) for _ in range(draw.randrange(1, 8))))
    for letter in " =-*a0e你":
        for n in [*range(1, 40), 1000, 30_011]:
            agree(own, library, letter * n)


def test_without_memory_of_parts(own, library):
    draw = random.Random(6)
    for _ in range(300):
        text = "".join(draw.choice("etaoinshr") for _ in range(draw.randrange(1, 400)))
        assert own.encode_part(" " + text) == library.encode(text)


def test_compatible_neighbours_are_what_merging_keeps_apart(own, library):
    draw = random.Random(7)
    reached = [i for i in own.plain if own.halves[i] is not None and not own.names[i].startswith(" ")]
    for _ in range(4000):
        a, b = draw.choice(reached), draw.choice(reached)
        assert own._compatible(a, b) == (library.encode("\n" + own.names[a] + own.names[b])[2:] == [a, b])


def test_any_ids_decode(own, library):
    draw = random.Random(8)
    for _ in range(8000):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(3, 259), draw.randrange(3), 29871, 259]) for _ in range(draw.randrange(0, 9))]
        assert own.text(ids) == library.decode(ids)


def test_rows(spark, library):
    long = " ".join(random.Random(1).choice(["word", "other", "é", "\n"]) for _ in range(60_000))
    rows = [(1, None), (2, ""), (None, "a  b "), (3, " "), (3, " "), (4, long), (5, "x" * 50_000), (6, "\n\n")]
    docs = spark.createDataFrame([(i, t, 7, "n") for i, t in rows], "doc_id long, text string, _ids int, names string").repartition(3)
    found = sorted(encode(docs, ["doc_id", "names"]).collect(), key=str)
    want = sorted(((i, "n", library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows), key=str)
    assert sorted(map(tuple, found), key=str) == want
    assert encode(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        encode(docs.withColumnRenamed("names", "ids"), ["ids"])


def test_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
