"""Language ID, token attribution, packing, main text and the pipeline."""

import random
import zlib
from collections import defaultdict

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import queries
from tidelog.llm.attribution import join_spans, section_tokens
from tidelog.llm.encode import UNSURE, Encoder, encoder, kinds, tokenizer_path
from tidelog.llm.encode import pieces as split
from tidelog.llm.html import extract, learn_tree, main_text
from tidelog.llm.langid import grams, held_out, identify, learn_profiles
from tidelog.llm.packing import hilbert_keys, pack

PATH = tokenizer_path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "a b ", " a", "x\n\n\ny", "a \n b", "tab\tand nbsp x", "it's we'll", "déjà vu　日本語 テキスト", "<|endoftext|> x", "a <|endoftext|>", "12 345 $%&", "퟿ \U0001f600 z", "w " * 3000, "\r\n a"]


def test_encoder_equals_tokenizer(monkeypatch):
    monkeypatch.setattr("tidelog.llm.encode.REMEMBERED", 50)
    monkeypatch.setattr("tidelog.llm.encode.KEPT", 20)
    own = Encoder(PATH)
    texts = ODD + [f"word{i} more{i % 7}, and\nthen{i}" for i in range(200)]
    for _ in range(2):
        assert [list(x) for x in own.ids(texts)] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    widths = own.byte_lengths()
    assert [int(widths[x].sum()) for x in own.ids(texts)] == [len(t.encode()) for t in texts]


def test_a_word_is_learned_once_whatever_stands_around_it():
    words, ends = ["plain", "Ünder", "don't", "日本"], ["", ",", ".", "!", ".\n", "\n", "\n\n", ")", "'ll"]
    texts = [f"A {a}{x}{b}{y} {b}" for a in words for x in ends for b in words for y in ends]
    own = Encoder(PATH)
    assert [list(x) for x in own.ids(texts)] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own.known) < 60 < len({w for t in texts for w in t.split(" ")})


@pytest.mark.parametrize("cut", [1 << 20, 40])
def test_texts_are_cut_as_the_tokenizer_cuts(monkeypatch, cut):
    monkeypatch.setattr("tidelog.llm.encode.CUT", cut)
    own, draw = Encoder(PATH), random.Random(5)
    signs = [*"abstmdrelv12!.é日٣²'' \n\t", "'s", "'ll", "'re", "'qť", "  ", "\r\n", "<|", "\x00", "\x1c", "\x85", "\xa0", " ", "　", "͸", "\U0001f600", "\U00020000"]
    texts = ["".join(draw.choices(signs, k=draw.randrange(20))) for _ in range(5000)] + [f"{t}<|endoftext|>\U0001f600" for t in ("", "a ")]
    assert [list(x) for x in own.ids(texts)] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for alike in (["", "", ""], [""], [], ["'"]):
        assert [list(x) for x in own.ids(alike)] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in alike]
    other = Encoder(tokenizer_path("word_bpe_49k.json"))
    assert [list(x) for x in other.ids(texts[:500])] == [other.tokenizer.encode(t, add_special_tokens=False).ids for t in texts[:500]]


def test_every_sure_character_is_of_its_kind():
    sure = [chr(c) for c in np.flatnonzero(kinds()[:-1] != UNSURE)]
    assert len(sure) > 50_000
    texts = ["".join(x for c in sure[at:at + 500] for x in ("a", c, "1", c, "!", c, c, " ", c, "\n")) for at in range(0, len(sure), 500)]
    assert split(["'qťa", "'rea"])[0].to_pylist() == ["'", "qťa", "'re", "a"]
    found, counts = split(texts)
    tokenizer, at = encoder(PATH).tokenizer, 0
    for text, n in zip(texts, counts.tolist()):
        assert found[at:at + n].to_pylist() == [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        at += n


def test_hilbert_curve_is_continuous():
    side = np.arange(8)
    points = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    keys = hilbert_keys(points, bits=3)
    assert sorted(keys) == list(range(512))
    walk = points[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_pieces_make_the_documents_again(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (3, "same id"), (3, "same id")] + [(100 + i, "copied text of some words") for i in range(300)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int")
    pieces = pack(docs.repartition(3), length=64).collect()
    want = [(i, encoder(PATH).tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    assert sum(p.length for p in pieces) == sum(len(x) for _, x in want)
    assert all(len(p.ids) == 4 * p.length and p.start + p.length <= p.doc_tokens for p in pieces)
    texts = defaultdict(list)
    for p in pieces:
        if p.doc_id != 3:
            texts[p.doc_id].append((p.start, list(np.frombuffer(p.ids, "<u4"))))
    for i, ids in want:
        if i != 3:
            assert [x for _, part in sorted(texts[i]) for x in part] == ids
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        ends = [0] + [o + n for o, n in sorted(parts)]
        assert ends[-1] <= 64 and [o for o, _ in sorted(parts)] == ends[:-1]
    short = [s for s, parts in sequences.items() if sum(n for _, n in parts) < 64]
    assert len({s >> 40 for s in short}) == len(short)
    assert pack(docs.limit(0)).collect() == []


def test_packed_documents(spark, sf_dir):
    pieces = queries.QUERIES["op5_curve_packing"](spark, sf_dir).collect()
    docs = {r.doc_id: encoder(PATH).ids([r.text or ""])[0].astype("<u4") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for p in pieces:
        ids = np.append(docs[p.doc_id], 0).astype("<u4")
        assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    filled = sum(p.length for p in pieces)
    assert filled == sum(len(x) + 1 for x in docs.values())


def test_neighbours_on_the_curve_are_alike(spark, sf_dir):
    """Documents that meet in a sequence are of one language more often than two drawn by chance."""
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    pieces = sorted(queries.QUERIES["op5_curve_packing"](spark, sf_dir).collect(), key=lambda p: (p.sequence_id, p.offset))
    order = list(dict.fromkeys(p.doc_id for p in pieces))
    same = np.mean([lang[a] == lang[b] for a, b in zip(order, order[1:])])
    share = np.array(list(plain.Counter(lang.values()).values())) / len(lang)
    assert same > (share**2).sum() + 0.1


def test_sections(spark):
    rows = [(i, t, "s\nr" if i % 2 else None) for i, t in enumerate(ODD)] + [(None, None, None), (1, "again", "x")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, section int")
    got = plain.multiset(section_tokens(docs, ["source", "text"]).collect())
    want = []
    tokenizer = encoder(PATH).tokenizer
    for i, text, source in rows:
        whole = f"{source or ''}\n{text or ''}"
        bounds, at = [], 0
        for field, value in (("source", source), ("text", text)):
            for number, line in enumerate((value or "").split("\n")):
                bounds.append([field, number, at, min(at + len(line) + 1, len(whole)), 0, 0])
                at += len(line) + 1
        for start, end in tokenizer.encode(whole, add_special_tokens=False).offsets:
            share = [min(b[3], end) - max(b[2], start) for b in bounds]
            best = share.index(max(share))
            bounds[best][4] += 1
            bounds[best][5] += sum(s > 0 for s in share) > 1
        want += [(i, *b) for b in bounds]
    assert got == plain.multiset(want)
    assert section_tokens(docs.limit(0), ["text"]).collect() == []


def test_tokens_go_where_most_of_them_is():
    owner, crosses = join_spans(np.array([0, 2, 6]), np.array([2, 6, 9]), np.array([0, 3, 4, 8, 9]))
    assert list(owner) == [0, 2, 2] and list(crosses) == [False, True, True]
    assert list(join_spans(np.array([0]), np.array([4]), np.array([0, 2, 4]))[0]) == [0]


def test_sections_sum_up(spark, sf_dir):
    total = queries.QUERIES["op2_token_attribution"](spark, sf_dir).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    docs = {r.doc_id: f"{r.source or ''}\n{r.lang or ''}\n{r.text or ''}" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.n for r in total} == {i: len(x) for i, x in zip(docs, encoder(PATH).ids(list(docs.values())))}


@pytest.mark.parametrize("text", ["Été, der Fluß!", "a", "", None, "12 _ 3", "a-b c'd", "ǅ İx"])
def test_grams(text):
    got = plain.Counter(grams(text).tolist())
    want = plain.Counter()
    for gram, n in plain.grams(text).items():
        number = 0
        for c in gram:
            number = number << 20 | (0 if c == " " else ord(c))
        want[number | (len(gram) - 1) << 60] += n
    assert got == want


def test_languages_of_held_out_documents(spark, sf_dir):
    rows = queries.QUERIES["op6_language_id"](spark, sf_dir).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_languages_by_hand(spark):
    train = [("a", "xyx xyx " * 5), ("a", None), ("b", "uvu vuv"), (None, "zzz"), ("c", "123")]
    profiles = learn_profiles(spark.createDataFrame(train, "lang string, text string"), ranks=20)
    docs = spark.createDataFrame([(1, "xyx", 0), (2, "VUV uvu", 0), (3, None, 0), (4, "1 2 !", 0), (None, "xy", 0), (5, "", 0)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in identify(docs, profiles, ["doc_id"]).collect()}
    assert {i: r.lang_pred for i, r in got.items()} == {1: "a", 2: "b", 3: "und", 4: "und", None: "a", 5: "und"}
    ranks = {lang: {g: i for i, (g, _) in enumerate(sorted(plain.Counter(grams(t * 1).tolist()).items(), key=lambda x: (-x[1], x[0]))[:20])} for lang, t in (("a", train[0][1]),)}
    own = [g for g, _ in sorted(plain.Counter(grams("xyx").tolist()).items(), key=lambda x: (-x[1], x[0]))]
    apart = sum(abs(ranks["a"][g] - i) if g in ranks["a"] else 20 for i, g in enumerate(own))
    assert got[1].score == pytest.approx(1 - apart / (20 * len(own)))
    nothing = learn_profiles(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in identify(docs, nothing, ["doc_id"]).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><a href="/">Home</a> Site of all things</header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two words</a></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it work for you and our many partners.</div>
<article><h1>Tea &amp; Ï&#239;</h1><p>First <b>paragraph</b>,<br>with&nbsp;a break and enough words to count as such.
<p>Second one is <a href="/x">linked</a> a little, not closed<div>Inner <em>block</em> &lt;kept&gt;</div><p>Short.</p>
<form><label>Name</label><input value="x"><button>Send</button></form><aside>Related stuff here</aside></article>
<div id="comments"><p>Great article, thanks a lot for writing this down for all of us to read!</p></div>
<footer>&copy; somebody</footer>"""


def test_main_text():
    assert main_text(PAGE, learn_tree()).split("\n\n") == [
        "Tea & Ïï", "First paragraph, with a break and enough words to count as such.", "Second one is linked a little, not closed", "Inner block <kept>", "Short.",
    ]


ARTICLE = "<article>{}<p>" + "plain words of the article " * 8 + "</p><p>" + "more words of it " * 9 + "</p></article>"


@pytest.mark.parametrize("wrapper", ['div class="content has-sidebar"', 'div class="no-sidebar"', 'section id="with-comments"', 'div class="page header-fixed"', 'div class="widget"', "form", 'div class="main-nav"'])
def test_wrappers_do_not_lose_the_article(wrapper):
    own = '<div class="entry-header"><h1>The title</h1></div>'
    for inner in (ARTICLE.format(own), f"<main>{ARTICLE.format(own)}</main>"):
        text = main_text(f"<body><nav><a>Home</a></nav><{wrapper}>{inner}</{wrapper.split()[0]}></body>", learn_tree())
        assert [b.split()[0] for b in text.split("\n\n")] == ["The", "plain", "more"]


def test_wrappers_without_an_article():
    paragraphs = "".join(f"<p>{word} " + "and many other words " * 30 + "</p>" for word in ("one", "two", "three", "four", "five"))
    text = main_text(f'<div class="content has-sidebar">{paragraphs}</div>', learn_tree())
    assert [b.split()[0] for b in text.split("\n\n")] == ["one", "two", "three", "four", "five"]
    assert [b.split()[0] for b in main_text(f'<div class="page widget">{paragraphs}</div>', learn_tree()).split("\n\n")][1:4] == ["two", "three", "four"]


@pytest.mark.parametrize("rest", ['<div class="entry-footer">Filed under tea and other things</div>', '<div id="comments"><article><p>Great article, thanks a lot</p></article></div>', "<aside><article>A teaser of another text</article></aside>"])
def test_boilerplate_in_main_goes(rest):
    assert "\n\n".join(main_text(f"<main>{ARTICLE.format('')}{rest}</main>", learn_tree()).split("\n\n")[2:]) == ""


@pytest.mark.parametrize("html", [None, "", "<", "<p", "</div></p>", "<nav>", "&", "<!-- x", "<script>", "<p>" * 5000 + "</div>" * 5000, "<div>" * 3000])
def test_odd_pages(html):
    assert main_text(html, learn_tree()) == ""


def test_articles_of_all_pages(spark, sf_dir):
    import html as entities
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = queries.QUERIES["op10_main_text"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?p>|</?h1>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_pages_with_nulls_and_clashes(spark):
    pages = spark.createDataFrame([(None, None, None, 1), (1, "u", "<p>" + "word " * 20, 2), (1, "u", "<p>" + "word " * 20, 2)], "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text) for r in extract(pages, ["page_id", "url"]).collect()) == [(0, "")] + [(1, ("word " * 20).strip())] * 2
    assert extract(pages.limit(0), ["page_id"]).collect() == []


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 120")
    extra = [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "12 34 !", "en", "s", 7), (None, "a text without an id but with words", "en", None, 3)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    lang = {None: "en"} | {r.doc_id: r.lang for r in docs.collect()}
    kept = corpus_pipeline.language_id(spark, docs, sf_dir).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert plain.multiset((r.doc_id, r.text) for r in kept) == plain.multiset(rows)
    steps = [lambda r: [x[:2] for x in plain.line_dedup(r)], lambda r: keep(r, plain.near_groups(r, 5, 80), 3), None]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    steps[2] = lambda r: keep(r, [(*x[:5], not x[5]) for x in plain.contamination(r, items)], 5)
    for (name, stage), step in zip(corpus_pipeline.STAGES[1:4], steps):
        before = spark.createDataFrame([(i, t, lang[i], "s", len(t)) for i, t in rows], docs.schema)
        got = stage(spark, before, sf_dir)
        assert got.columns == docs.columns, name
        rows = step(rows)
        assert plain.multiset((r.doc_id, r.text) for r in got.collect()) == plain.multiset(rows), name
        assert all(r.n_chars == len(r.text) and r.lang == lang[r.doc_id] for r in got.collect())
    assert len(rows) < 120
    before = spark.createDataFrame([(i, t, lang[i], "s", len(t)) for i, t in rows], docs.schema)
    pieces = corpus_pipeline.STAGES[4][1](spark, before, sf_dir)
    assert sum(p.length for p in pieces.collect()) == sum(len(x) + 1 for x in encoder(PATH).ids([t for _, t in rows]))


FOREIGN = [
    "Ο γρήγορος αλεπού πηδά πάνω από τον σκύλο και τρέχει", "быстрая лиса прыгает через ленивую собаку и убегает", "敏捷的棕色狐狸跳过了懒狗",
    "Szybki brązowy lis przeskakuje nad leniwym psem i ucieka do lasu każdego dnia", "Nopea ruskea kettu hyppää laiskan koiran yli ja juoksee metsään joka päivä",
    "xq zzkw qjx vvb wxq kkz jjq xzv",
]


def test_pipeline_drops_languages_that_were_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = [(10_000_000 + i, t, None, "s", len(t)) for i, t in enumerate(FOREIGN)]
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(extra, docs.schema)), "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id", "text").collect() if any(c.isalpha() for c in r.text or "")}


def test_pipeline_judges_rows_without_or_with_one_id_by_themselves(spark):
    first, second = ("".join(f"{w}{i} " for i in range(40)) for w in ("word", "other"))
    rows = [(None, first, 1), (None, first, 2), (None, first + "more", 3), (None, second, 4), (7, second, 5), (7, second, 6), (3, second + "end", 7), (7, "alone", 8), (9, "", 9), (9, "", 10), (8, "", 11), (None, None, 12), (None, None, 13)]
    docs = spark.createDataFrame([(i, t, "en", "s", n) for i, t, n in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    got = plain.multiset((r.doc_id, r.text) for r in kept.collect())
    copy = next(t for i, t in got if i is None and t)
    assert copy in (first, first + "more") and got == plain.multiset([(None, copy), (3, second + "end"), (7, "alone"), (9, ""), (8, ""), (None, None)])


def test_pipeline_drops_each_contaminated_row(spark, tmp_path):
    item = " ".join(f"item{i}" for i in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "clean text"), (None, f"before {item} after"), (5, item), (5, "also clean"), (None, item), (6, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert plain.multiset((r.doc_id, r.text) for r in got) == plain.multiset([(None, "clean text"), (5, "also clean")])


def keep(rows, judged, at):
    stays = defaultdict(bool)
    for row in judged:
        stays[row[0]] |= row[at]
    return [r for r in rows if stays[r[0]]]


def test_pipeline_runs_whole(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert 0 < pieces.select("doc_id").distinct().count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert held_out().__class__.__name__ == "Column"
