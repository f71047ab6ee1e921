"""Benchmark passages in training text, through a positional inverted index of the training words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.text import ascii_lower, type_of
from tidelog.session import staged_path, store

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, a-z and all beyond ASCII, of the text with A-Z lower-cased; null has none."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def positional_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored postings of all words of all documents: term (64-bit hash of the word), row, pos.

    Each file holds the documents of one task, ordered by term, so the index is made without a shuffle and a lookup of
    terms skips row groups. `row` numbers the documents. Besides, each document has one posting without a term, which
    carries its id and its number of words.
    """
    terms = F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), terms.alias("terms"))
    flat = numbered.select(
        "row", "doc_id", F.size("terms").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit(None).cast("long")), F.col("terms"))).alias("at", "term"),
    )
    first = F.col("at") == 0
    postings = flat.select(
        "term", "row", (F.col("at") - 1).alias("pos"), F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("n_words")).alias("n_words")
    )
    path = staged_path(docs.sparkSession, "postings")
    postings.sortWithinPartitions("term").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(f"term long, row long, pos int, doc_id {type_of(docs, id_col)}, n_words int").parquet(path)


def test_windows(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(item, first, second, first_term, second_term): the two rarest positions of every window that can occur.

    Neighbouring windows mostly share theirs, so there are far fewer than windows. Windows with a word that the
    training text lacks are left out.
    """
    known = items.join(counts, "term", "left")
    spans = known.select(
        "item", "pos", "term", F.coalesce("n", F.lit(0)).alias("n"),
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("pos") - window + 1), F.least(F.col("pos"), F.greatest(F.lit(0), F.col("size") - window)))).alias("start"),
    )
    rarest = F.slice(F.sort_array(F.collect_list(F.struct("n", "pos", "term"))), 1, 2)
    best = spans.groupBy("item", "start").agg(rarest.alias("r"), F.min("n").alias("least")).where("least > 0")
    second = F.when(F.size("r") > 1, F.col("r")[1])
    return best.select(
        "item", F.col("r")[0]["pos"].alias("first"), F.col("r")[0]["term"].alias("first_term"),
        second["pos"].alias("second"), second["term"].alias("second_term"),
    ).distinct()


def occurrences(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(row, item_id, start, length): where runs of words of an item, each a window or more, stand in the documents.

    For each window the list of its rarest term is shifted by the term's place in the item and intersected with the
    shifted list of the next rarest; what is left names an alignment of the item with a document. The lists of all the
    item's terms are then intersected at these alignments, and consecutive matches are joined to runs.
    """
    terms = F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w))
    numbered = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), terms.alias("terms"))
    items = store(numbered.select("item", "item_id", F.size("terms").alias("size"), F.posexplode("terms").alias("pos", "term")), "items")
    postings = index.where(F.col("term").isNotNull()).select("term", "row", "pos")
    listed = postings.join(items.select("term").distinct(), "term", "left_semi")
    anchors = store(test_windows(items, listed.groupBy("term").agg(F.count("*").alias("n")), window), "anchors")

    starts = postings.join(anchors.withColumnRenamed("first_term", "term"), "term").select(
        "row", "item", (F.col("pos") - F.col("first")).alias("shift"), "second", "second_term"
    )
    seconds = postings.join(anchors.select(F.col("second_term").alias("term")).distinct(), "term", "left_semi")
    pairs = starts.where(F.col("second").isNotNull()).withColumnsRenamed({"second_term": "term"}).withColumn("pos", F.col("shift") + F.col("second"))
    both = pairs.join(seconds, ["row", "term", "pos"], "left_semi").select("row", "item", "shift")
    single = starts.where(F.col("second").isNull()).select("row", "item", "shift")
    aligned = store(both.unionByName(single).distinct(), "alignments")

    wanted = aligned.join(items, "item").select("row", "item", "item_id", "size", "shift", F.col("pos").alias("j"), "term", (F.col("shift") + F.col("pos")).alias("pos"))
    near = listed.join(aligned.select("row").distinct(), "row", "left_semi")
    matched = wanted.join(near, ["row", "term", "pos"], "left_semi")
    place = Window.partitionBy("row", "item", "shift").orderBy("j")
    runs = matched.withColumn("run", F.col("j") - F.row_number().over(place)).groupBy("row", "item", "item_id", "size", "shift", "run").agg(
        F.min("pos").alias("start"), F.count("*").cast("int").alias("length")
    )
    return runs.where(F.col("length") >= F.least(F.lit(window), F.col("size"))).select("row", "item_id", "start", "length")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """How much of each document stands in the benchmark: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is `window` consecutive words of an item, or the whole of a shorter item; a document's word is hit if it
    lies inside an occurrence of a window. items_sha256 is over the ids of the items with occurring windows, sorted as
    strings and comma-joined. Null and empty texts have no words: such documents are clean, such items find nothing. An
    item without an id still hits, but is not listed; rows of one id are one item in the list. Every document row is
    judged by itself, whatever its id, and returned. Words are told apart by a 64-bit hash. Other columns are not read.
    """
    index = positional_index(docs, id_col, text_col)
    found = store(occurrences(index, benchmark, window, item_col, item_text_col), "occurrences")
    hit = found.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    listed = found.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    whole = index.where(F.col("term").isNull()).select("row", "doc_id", "n_words").join(hit, "row", "left").join(listed, "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return whole.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def proximity(index: DataFrame, left: str, right: str, within: int) -> DataFrame:
    """(row, first, second): all places where two words stand at most `within` positions apart, in either order.

    Places are cut into stretches of `within`, so each occurrence of `left` meets only those of `right` in its own stretch
    and the two beside it. As in the index, only A-Z is lower-cased.
    """
    width = max(1, within)
    places = {side: index.where(F.col("term") == F.xxhash64(ascii_lower(F.lit(w)))).select("row", "pos") for side, w in (("left", left), ("right", right))}
    stretch = F.floor(F.col("pos") / width)
    first = places["left"].select("row", F.col("pos").alias("first"), F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch"))
    second = places["right"].select("row", F.col("pos").alias("second"), stretch.alias("stretch"))
    near = first.join(second, ["row", "stretch"]).where((F.col("first") != F.col("second")) & (F.abs(F.col("first") - F.col("second")) <= within))
    return near.select("row", "first", "second")
