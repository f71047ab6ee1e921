"""Near-duplicates: documents posted under the coordinates of their MinHash signatures."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.components import components
from tidelog.llm.perfect_hash import mix
from tidelog.llm.shingles import MinHash, shingles
from tidelog.llm.text import type_of
from tidelog.session import store

K = 128  # coordinates of a signature
SIGMAS = 5  # how far below its mean the number of equal coordinates of a linked pair may fall
AGREE = 3  # values that two nodes have to share in short lists
COUNTERS = 1 << 17  # hashed counts of coordinate values that tell rare from frequent ones
SHORT = 64  # longest posting list of which all pairs are looked at
BLOCK = 512  # nodes of a long list that are compared with as many others in one step
SPREAD = 16  # tasks that the nodes of one list may be dealt to when what belongs to the list is joined to them
FILTER_BITS = 1 << 20  # of the filter that tells which documents' shingles are wanted again


def least_matches(k: int, percent: int) -> int:
    """Equal coordinates that a pair of just the wanted similarity has, but for about one in a million."""
    share = percent / 100
    return max(1, math.floor(k * share - SIGMAS * math.sqrt(k * share * (1 - share))))


def values_of(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit name for each coordinate and its value."""
    return mix(signatures.astype(np.uint64) + (np.arange(signatures.shape[1], dtype=np.uint64) << np.uint64(32)))


def _matrix(column: pa.Array, k: int, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, k)


def brief(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(node, signature, n_shingles) to (node, brief): the size of the set in 8 bytes, then the last byte of each coordinate.
    Equal coordinates stay equal, and of 256 others one becomes so. That is all that pairs carry until the full sets decide."""
    for batch in batches:
        if batch.num_rows:
            sizes = batch.column(2).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            rows = np.concatenate([sizes, _matrix(batch.column(1), k).astype(np.uint8)], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in rows], pa.binary())], ["node", "brief"])


def _briefs(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and coordinates."""
    rows = _matrix(column, k + 8, "u1")
    return np.ascontiguousarray(rows[:, :8]).view("<i8")[:, 0], rows[:, 8:]


def may_link(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], least: int, percent: int) -> np.ndarray:
    """Whether there are enough equal coordinates, and the sizes of the sets allow the wanted similarity."""
    small, large = np.minimum(x[0], y[0]), np.maximum(x[0], y[0])
    return ((x[1] == y[1]).sum(axis=-1) >= least) & (100 * small >= percent * large)


def sign(batches: Iterator[pa.RecordBatch], k: int, size: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, n_shingles, key, signature); key names the set, null where it is empty."""
    hashes = MinHash(k)
    for batch in batches:
        counts, keys, signatures = [], [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            found = shingles(text or b"", size)
            counts.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            signatures.append(hashes.sign(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
            ["doc_id", "n_shingles", "key", "signature"],
        )


def count_values(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Signatures to (counter, n), once per task."""
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        if batch.num_rows:
            total += np.bincount((values_of(_matrix(batch.column(0), k)) >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64).ravel(), minlength=COUNTERS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["counter", "n"])


def post(batches: Iterator[pa.RecordBatch], k: int, prefix: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(node, signature) to (value, node, rank): its rarest coordinates. rank: how frequent all its values are, then
    23 bits of the node, so that it names the node well enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column(0).to_numpy()
        values = values_of(_matrix(batch.column(1), k))
        often = counts[(values >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64)]
        order = np.lexsort((values, often), axis=1)[:, :prefix]
        rank = (often.sum(axis=1) << 23) | (mix(nodes.astype(np.uint64)) >> np.uint64(41)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.take_along_axis(values, order, 1).ravel().view(np.int64)), pa.array(np.repeat(nodes, prefix)), pa.array(np.repeat(rank, prefix))],
            ["value", "node", "rank"],
        )


def matching(batches: Iterator[pa.RecordBatch], k: int, least: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, brief of a, of b) to the pairs (a, b) that may be linked."""
    for batch in batches:
        if batch.num_rows:
            enough = may_link(_briefs(batch.column(2), k), _briefs(batch.column(3), k), least, percent)
            yield batch.select(["a", "b"]).filter(pa.array(enough))


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, set of a, of b) to the pairs whose full sets are similar enough."""
    for batch in batches:
        sets = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        good = [similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in sets]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def matches(left: pa.Table, right: pa.Table, k: int, least: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of left the rows of right that it may be linked with."""
    if left.num_rows and right.num_rows:
        theirs = _briefs(right.column("brief"), k)
        for at, own in enumerate(zip(*_briefs(left.column("brief"), k))):
            yield at, np.flatnonzero(may_link(own, theirs, least, percent))


def touching(left: pa.Table, right: pa.Table, k: int, least: int, percent: int) -> pa.Table:
    """Two blocks of (hub, node, component, brief) to the nodes that match one of another component: (hub, node)."""
    hit_left, hit_right = np.zeros(left.num_rows, bool), np.zeros(right.num_rows, bool)
    mine, theirs = (t.column("component").to_numpy() for t in (left, right))
    for at, found in matches(left, right, k, least, percent):
        found = found[theirs[found] != mine[at]]
        hit_left[at] = len(found) > 0
        hit_right[found] = True
    return pa.concat_tables([t.select(["hub", "node"]).filter(pa.array(hit)) for t, hit in ((left, hit_left), (right, hit_right))])


def across(left: pa.Table, right: pa.Table, k: int, least: int, percent: int) -> pa.Table:
    """Two blocks of (node, component, brief, items) to links (a, b) between different components. A link unites two
    components for the rest of the step, so there are at most as many links as components."""
    names: dict[int, int] = {}

    def find(x: int) -> int:
        while names.setdefault(x, x) != x:
            names[x] = x = names[names[x]]
        return x

    links = []
    mine, theirs = ([np.frombuffer(b, "<u8") for b in t.column("items").to_pylist()] for t in (left, right))
    for at, found in matches(left, right, k, least, percent):
        group = left["component"][at].as_py()
        for i in found:
            other = right["component"][int(i)].as_py()
            if find(group) != find(other) and similar(mine[at], theirs[i], percent):
                names[find(group)] = find(other)
                links.append((left["node"][at].as_py(), right["node"][int(i)].as_py()))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _bits(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS.bit_length() + 1)).astype(np.int64)


def wanted_sets(batches: Iterator[pa.RecordBatch], size: int, bits: np.ndarray, no_id: bool) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (key, items) of the documents that the filter lets through."""
    for batch in batches:
        ids = batch.column(0)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        go = np.where(known, bits[_bits(ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False))], no_id)
        sets = [shingles(text or b"", size) for text in batch.column(1).filter(pa.array(go)).cast(pa.binary()).to_pylist()]
        sets = [s.tobytes() for s in sets if len(s)]
        yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())], ["key", "items"])


def posting_lists(classes: DataFrame, k: int, prefix: int) -> DataFrame:
    """(value, node, rank, n, hub): the stored postings in lists of more than one node, with the list's length and centre."""
    counted = classes.select("signature").mapInArrow(lambda b: count_values(b, k), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    counts = np.zeros(COUNTERS, np.int64)
    for row in counted.collect():  # COUNTERS rows at most
        counts[row.counter] = row.n
    postings = classes.select("node", "signature").mapInArrow(lambda b: post(b, k, prefix, counts), "value long, node long, rank long")
    postings = postings.repartition("value")  # once, for the lists' sums and for the join with them
    lists = postings.groupBy("value").agg(F.count("node").alias("n"), F.max("rank").alias("hub")).where("n > 1")
    return store(postings.join(lists, "value"), "postings")


def spread_join(rows: DataFrame, each: DataFrame, node: str = "node") -> DataFrame:
    """rows joined by hub with `each`, which has one row per hub: the rows of one hub are dealt to SPREAD tasks."""
    copies = each.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return rows.withColumn("_deal", F.pmod(F.xxhash64(node), F.lit(SPREAD)).cast("int")).join(copies, ["hub", "_deal"]).drop("_deal")


def both_ends(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(table.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}")), end)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def shingle_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(node, items): the full sets of some nodes, drawn from the texts once more. A filter of fixed size tells which
    documents may be wanted; as it fills up more texts are read in vain, but the result is the same."""
    wanted = store(classes.select("node", "key", "rep").join(nodes, "node"), "wanted")
    slots = wanted.where(F.col("rep").isNotNull()).select("rep").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array(_bits(b.column(0).cast(pa.int64()).to_numpy()))], ["slot"]) for b in batches), "slot long"
    ).distinct()
    bits = np.zeros(FILTER_BITS, bool)
    bits[[row.slot for row in slots.collect()]] = True  # FILTER_BITS rows at most
    no_id = not wanted.where(F.col("rep").isNull()).isEmpty()
    sets = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda b: wanted_sets(b, size, bits, no_id), "key binary, items binary")
    return store(sets.join(wanted.select("node", "key"), "key").dropDuplicates(["node"]).select("node", "items"), "sets")


def in_blocks(members: DataFrame, columns: list[str], step: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """step over blocks of the members (hub, node, asks, ...) of each hub: those that ask against all of them."""
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    counts = members.groupBy("hub").agg(blocks(F.count("*")).alias("right"), blocks(F.sum(F.col("asks").cast("int"))).alias("left")).where(F.col("left") > 0)
    full = spread_join(members, store(counts, "blocks"))
    place = F.xxhash64("node")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = ["hub", "l", "r", *columns]
    asking = full.where("asks").withColumn("l", F.pmod(place, F.col("left")).cast("int")).withColumn("r", every("right")).select(names)
    asked = full.withColumn("r", F.pmod(place, F.col("right")).cast("int")).withColumn("l", every("left")).select(names).toDF(*names)
    return asking.groupBy("hub", "l", "r").cogroup(asked.groupBy("hub", "l", "r")).applyInArrow(step, schema)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) over the pairs (a, b) whose full sets are similar enough.

    First each node is compared with the least one it is paired with; of the other pairs only those are looked at whose
    ends this has not united, as no other can change a component.
    """

    def links(some: DataFrame) -> DataFrame:
        return both_ends(some, sets, "items").mapInArrow(lambda b: linked(b, percent), "a long, b long")

    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    groups = store(components(links(first)), "groups")
    apart = pairs
    for end in ("a", "b"):
        named = groups.select(F.col("node").alias(end), F.col("component").alias(f"component_{end}"))
        apart = apart.join(named, end, "left").withColumn(f"component_{end}", F.coalesce(f"component_{end}", end))
    apart = store(apart.where("component_a <> component_b").select("a", "b").join(first, ["a", "b"], "left_anti"), "apart")
    if apart.isEmpty():
        return groups
    more = links(apart).unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return store(components(more), "groups")


def similar_groups(docs: DataFrame, classes: DataFrame, size: int, percent: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the nodes of `classes` (node, key, rep, signature, n_shingles) that have a link, see near_duplicates."""
    least = least_matches(k, percent)
    lists = posting_lists(classes, k, min(k, k - least + AGREE))
    briefs = store(classes.select("node", "signature", "n_shingles").mapInArrow(lambda b: brief(b, k), "node long, brief binary"), "briefs")
    long = lists.where(F.col("n") > SHORT)
    centres = store(long.where(F.col("rank") == F.col("hub")).groupBy("hub").agg(F.min("node").alias("b")), "centres")
    stars = spread_join(long.where(F.col("rank") != F.col("hub")).select(F.col("node").alias("a"), "hub").distinct(), centres, "a").select("a", "b")
    short = lists.where(F.col("n") <= SHORT).select("value", "node")
    close = short.select("value", F.col("node").alias("a")).join(short.select("value", F.col("node").alias("b")), "value").where("a < b")
    close = close.groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= min(AGREE, least)).select("a", "b")
    pairs = stars.unionByName(close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    likely = store(both_ends(pairs, briefs, "brief").mapInArrow(lambda b: matching(b, k, least, percent), "a long, b long"), "pairs")
    nodes = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    groups = verified(likely, shingle_sets(docs, classes, nodes, size, id_col, text_col), percent)

    # Nodes of long lists outside their centre's component are a query set; they are compared with all nodes of lists of
    # this centre, first by signatures alone. What touches another component so is then compared by the full sets.
    named = long.select("hub", "node").distinct().join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    middle = centres.join(groups.withColumnRenamed("node", "b"), "b", "left").select("hub", F.coalesce("component", "b").alias("middle"))
    members = spread_join(named, store(middle, "middle")).withColumn("asks", F.col("component") != F.col("middle")).drop("middle")
    members = store(members.join(briefs, "node"), "members")
    columns = ["node", "component", "brief"]
    touched = store(in_blocks(members, columns, lambda x, y: touching(x, y, k, least, percent), "hub long, node long").distinct(), "touched")
    if touched.isEmpty():
        return groups
    sets = shingle_sets(docs, classes, touched.select("node").distinct(), size, id_col, text_col)
    members = store(members.join(touched, ["hub", "node"]).join(sets, "node"), "members")
    more = in_blocks(members, [*columns, "items"], lambda x, y: across(x, y, k, least, percent), "a long, b long")
    return components(more.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, k: int = K,
) -> DataFrame:
    """Groups of documents linked by word shingles: doc_id, n_shingles, component_id, kept.

    Words are runs of other than [\\x20\\x09-\\x0D] with A-Z lower-cased; a document's set is its distinct shingles of
    `size` words, or its whole sequence if it has fewer words. Documents are linked whose sets have
    100 * intersection >= percent * union; component_id is the least id reachable over links, kept marks it.
    Null, empty and blank texts have no shingles and are linked with nothing. Ids are integers; rows of one id are
    documents of their own; a null id is never a component's name unless the group has no other. No rows give no rows.

    Equal sets become one node first, so copies never meet as pairs. A node is posted under the rarest `prefix` of its
    k coordinate-value pairs: two nodes with at least `least` equal coordinates share AGREE of these, whatever they are.
    The other, more frequent coordinates are not merged; they are compared, by a byte each, once a pair has been found. In lists of up to
    SHORT nodes each is paired with all others that it meets AGREE times, in longer ones with the most central node (whose values
    are the most frequent, such as the origin of many copies): a pair that meets AGREE times meets so often in short lists, or in a
    long one. Pairs with enough equal coordinates are verified on the full sets. The nodes of long lists that this leaves outside their centre's component are then compared with all others there, in blocks.
    """
    signed = store(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        lambda b: sign(b, k, size), f"doc_id {type_of(docs, id_col)}, n_shingles long, key binary, signature binary"), "signatures")
    classes = signed.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
    classes = store(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    groups = similar_groups(docs, classes, size, percent, k, id_col, text_col)
    named = classes.select("node", "key", "rep").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = store(named.join(least, "component").select(F.col("key").alias("_key"), "component_id"), "components")
    joined = signed.join(named, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
