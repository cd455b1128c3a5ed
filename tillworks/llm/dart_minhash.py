"""Near copies by DartMinHash.

A document is the multiset of its five-word shingles; likeness is weighted Jaccard, the sum of the
smaller counts over the sum of the larger. Every unit of weight of every shingle is a region of
its own, at which darts are thrown: a stream of ranks with exponential gaps that depends on the
region alone, each dart landing on one of ``DARTS`` coordinates. A document keeps the earliest
dart of each coordinate. Two documents agree in a coordinate with the probability of their
likeness, and the work is one dart for most regions, not one for each pair of region and
coordinate.

Bands of the signature are joined on their hashes. Inside a bucket every text is first held
against one leader, the first in one order of all texts, so that the buckets of a large group share
theirs; links merge texts into classes, and most buckets are one class then. Buckets that aren't
pick a leader of their own. What then stays apart in a bucket is held against its other classes, in tiles of bounded size
and bounded bytes of text, so no link that the bands bring together is left out. Against leaders, signatures (a byte for each
coordinate) first sort out what is far from alike: below ``NEAR`` of agreeing coordinates, five
standard errors under the limit. Likenesses are always computed exactly from the texts; in a tile
all at once, as a product of two tables of texts by regions. A pair of likeness 0.8 shares no
band with a probability of 3e-6.

Equal texts are one node from the start, however many there are.

Cases: texts of fewer than five words have one shingle, all their words. Null texts and texts
without words are near no other: each row is a class of its own. Long texts count with all their
shingles. Repeated rows are one node. An empty table gives no rows. The class of a document is the
smallest doc_id in it (null if none of its rows has one). Extra columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import numbered, short_batches, stored, texts_of, words_of

SHINGLE = 5
LIKENESS = 0.8
BANDS, ROWS = 32, 5
DARTS = BANDS * ROWS
#: Darts that a document is thrown at first: enough to hit every coordinate but seldom.
THROWN = DARTS * np.log(DARTS) + 2 * DARTS
#: Nodes (of 16 bytes) in a list that goes to every task.
MOST_LISTED = 500_000
#: Share of agreeing coordinates from which texts are compared, and texts in a tile's two sides.
NEAR, TILE, TEXT_TILE, SMALL_TILE = 0.65, 256, 64, 32
#: Bytes of text that a tile's side holds on average, and of regions that a task remembers.
TILE_BYTES, HELD_BYTES = 1 << 20, 32 << 20
#: Cells of those tables; longer texts are compared pair by pair. And tiles handed to Python at once.
MOST_CELLS, TILE_BATCH = 16_000_000, 32

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEPS = mixed(np.arange(1, 65, dtype="u8"))
#: One odd factor for each word of a shingle; the words' hashes are mixed already.
_FACTORS = _STEPS[:SHINGLE] | _U(1)


def regions(text: str) -> np.ndarray:
    """One number for every unit of weight of every shingle, sorted."""
    words = words_of(text)
    if not words:
        return np.empty(0, "u8")
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype("u8")
    n = max(1, len(words) - SHINGLE + 1)
    sums = np.zeros(n, "u8")
    for i in range(min(SHINGLE, len(words))):
        sums += hashes[i:i + n] * _FACTORS[i]
    shingles = np.sort(mixed(sums))
    first = np.r_[True, shingles[1:] != shingles[:-1]]
    if first.all():
        return shingles
    # The second, third, ... occurrence of a shingle is a region of its own.
    starts = np.flatnonzero(first)
    nth = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
    return np.sort(np.where(nth == 0, shingles, mixed(shingles + nth.astype("u8") * _U(0x9E3779B97F4A7C15))))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two documents' regions."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def signatures(of: list[np.ndarray]) -> np.ndarray:
    """The earliest rank at every coordinate, one row per document with regions."""
    sizes = np.array([len(r) for r in of])
    found = np.full((len(of), DARTS), np.inf)
    limit = THROWN / np.maximum(sizes, 1)
    open_docs = np.flatnonzero(sizes > 0)
    while len(open_docs):
        region = np.concatenate([of[d] for d in open_docs])
        doc = np.repeat(open_docs, sizes[open_docs])
        rank, throw, flat = np.zeros(len(region)), 0, found.reshape(-1)
        while len(region):
            dart = mixed(region + _U((throw + 1) * 0xD1342543DE82EF95 % (1 << 64)))
            rank = rank - np.log(((dart >> _U(11)).astype("f8") + 0.5) * 2.0 ** -53)
            hit = rank <= limit[doc]
            region, doc, rank = region[hit], doc[hit], rank[hit]
            place = (mixed(dart[hit]) >> _U(32)) * _U(DARTS) >> _U(32)
            np.minimum.at(flat, doc * DARTS + place.astype("i8"), rank)
            throw += 1
        # A coordinate without a dart: throw on, twice as far.
        open_docs = open_docs[np.isinf(found[open_docs]).any(axis=1)]
        limit[open_docs] *= 2
    return found


def band_hashes(found: np.ndarray) -> np.ndarray:
    bits = mixed(found.view("u8").reshape(-1, BANDS, ROWS) ^ _STEPS[:ROWS])
    sums = bits[:, :, 0].copy()
    for i in range(1, ROWS):
        sums = mixed(sums + bits[:, :, i])
    return mixed(sums ^ _STEPS[:BANDS]).view("i8")


def bytes_of(found: np.ndarray) -> np.ndarray:
    """A byte for every coordinate."""
    return (mixed(found.view("u8")) >> _U(56)).astype("u1")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in texts_of(batches, 1):
        of = [regions(t) for t in texts]
        has = np.array([len(r) > 0 for r in of], bool)
        found = signatures([r for r in of if len(r)])
        bands, sketch = band_hashes(found).reshape(-1), iter(bytes_of(found))
        offsets = np.concatenate([[0], np.cumsum(has * BANDS)]).astype("i4")
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands)),
             pa.array([next(sketch).tobytes() if h else None for h in has], pa.binary())],
            names=["doc_id", "node", "bands", "sketch"])


def with_node(docs: DataFrame) -> DataFrame:
    """doc_id, text and the node of the text: rows with the same text are one node."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("node", F.unhex(F.md5("text")))


class _Regions:
    """Regions of the texts used last, ``HELD_BYTES`` of them."""

    def __init__(self) -> None:
        self.size, self.held = 0, OrderedDict()

    def of(self, node: bytes, text: str) -> np.ndarray:
        found = self.held.pop(node, None)
        if found is None:
            found = regions(text)
            self.size += found.nbytes
        self.held[node] = found
        while self.size > HELD_BYTES and len(self.held) > 1:
            self.size -= self.held.popitem(last=False)[1].nbytes
        return found


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts that are alike."""
    of = _Regions().of
    for rows in batches:
        a, b, text_a, text_b = (c.to_pylist() for c in rows.columns)
        alike = [likeness(of(x, s), regions(t)) for x, s, t in zip(a, text_a, text_b)]
        keep = [i for i, v in enumerate(alike) if v >= LIKENESS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.binary()), pa.array([b[i] for i in keep], pa.binary()),
             pa.array([alike[i] for i in keep], pa.float64())], names=["a", "b", "likeness"])


def alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those that are alike, with their likeness."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        _compare, "a binary, b binary, likeness double")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; the label is the smallest node of its component.

    Every round takes the smallest label among neighbours, then the label of the label, until
    nothing changes; paths halve each time.
    """
    links = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = links.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "m").alias("now"))
        after = stored(lower.join(labels.select(F.col("node").alias("now"), F.col("label").alias("further")), "now").select(
            "node", "before", F.least("now", "further").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where("before != label").isEmpty():
            return labels


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the texts on a tile's two sides (lists ``a`` and ``b``) the pairs of different classes
    whose sketches are near, smaller node first."""
    least = int(np.ceil(NEAR * DARTS))
    for rows in batches:
        found: set[tuple[bytes, bytes]] = set()
        for left, right in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            x, y = (np.frombuffer(b"".join([r["sketch"] for r in side]), "u1").reshape(-1, DARTS) for side in (left, right))
            for i, j in zip(*np.nonzero((x[:, None, :] == y[None, :, :]).sum(axis=2) >= least)):
                if left[i]["label"] != right[j]["label"]:
                    found.add(tuple(sorted((left[i]["node"], right[j]["node"]))))
        pairs = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"])


def _tiles(rows: DataFrame, size: int, name: str, *fields: str) -> DataFrame:
    """Rows (bucket, n, node, label, ...) in lists of about ``size``; n is the rows of the bucket, and
    ``bytes``, if there, their bytes: long texts stand in lists of few."""
    parts = F.ceil(F.col("n") / size)
    if "bytes" in rows.columns:
        parts = F.greatest(parts, F.ceil(F.col("bytes") / TILE_BYTES))
    part = F.pmod(F.xxhash64("node"), parts)
    return rows.groupBy("bucket", part.alias("part")).agg(F.collect_list(F.struct("node", "label", *fields)).alias(name)).drop("part")


def likenesses(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Weighted Jaccard of every text on the left with every text on the right."""
    different, at = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    sizes = [np.array([len(r) for r in side], "f4") for side in (left, right)]
    if len(different) * (len(left) + len(right)) > MOST_CELLS:
        return np.array([[likeness(x, y) for y in right] for x in left])
    has = np.zeros((len(left) + len(right), len(different)), "f4")
    has[np.repeat(np.arange(len(has)), np.concatenate(sizes).astype("i8")), at] = 1
    both = has[:len(left)] @ has[len(left):].T
    return both / (sizes[0][:, None] + sizes[1][None, :] - both)


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the texts on a tile's two sides the alike pairs of different classes."""
    held = _Regions()
    for rows in batches:
        found: dict[tuple[bytes, bytes], float] = {}
        for left, right in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            same = likenesses(*[[held.of(r["node"], r["text"]) for r in side] for side in (left, right)])
            for i, j in zip(*np.nonzero(same >= LIKENESS)):
                if left[i]["label"] != right[j]["label"]:
                    found[tuple(sorted((left[i]["node"], right[j]["node"])))] = float(same[i, j])
        pairs = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary()),
             pa.array(list(found.values()), pa.float64())], names=["a", "b", "likeness"])


def _near_leaders(apart: DataFrame, *order: str) -> DataFrame:
    """Pairs of a bucket's leader and its other texts, the first in the order of the hash of ``order``. Where
    that is the node alone, buckets with the same texts have the same leader, and most pairs of a large
    group are the same in all its buckets. With the bucket besides, every bucket picks anew."""
    leaders = apart.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64(*order).alias("h"), "node", "label", "sketch")).alias("l")).where("n > 1")
    one = F.array(F.struct(F.col("l.node").alias("node"), F.col("l.label").alias("label"), F.col("l.sketch").alias("sketch")))
    tiles = _tiles(apart.join(leaders.select("bucket", "n"), "bucket"), TILE, "b", "sketch")
    return tiles.join(leaders.select("bucket", one.alias("a")), "bucket").select("a", "b").mapInArrow(_meet, "a binary, b binary")


def _still_apart(apart: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of buckets that are more than one class, under their labels so far."""
    now = apart.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = now.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket")
    return stored(now.join(several, "bucket", "left_semi"), "apart")


def _links_of_rest(apart: DataFrame, texts_of_nodes) -> DataFrame:
    """Links between texts of different classes in one bucket: those outside its largest class are
    held against all others."""
    sizes = apart.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("m")).where("m.n < n").select("bucket", "n", F.col("m.label").alias("main"))
    rows = stored(apart.drop("sketch").join(largest, "bucket"), "rest")
    rows = rows.join(texts_of_nodes(rows.select("node")), "node")
    bytes_of_bucket = rows.groupBy("bucket").agg(F.sum(F.octet_length("text")).alias("bytes"))
    rows = rows.join(bytes_of_bucket, "bucket")
    few = _tiles(rows.where("label != main"), SMALL_TILE, "a", "text")
    return few.join(_tiles(rows, TEXT_TILE, "b", "text"), "bucket").select("a", "b").mapInArrow(
        _link, "a binary, b binary, likeness double").distinct()


def links(docs: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, likeness) found, and (node, label) of the classes they make."""
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    # Most buckets hold one node and leave before anything heavier is joined.
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    met = buckets.join(shared, "bucket", "left_semi").join(nodes.select("node", "sketch"), "node")
    apart = stored(met.withColumn("label", F.col("node")), "apart")

    def texts_of_nodes(wanted: DataFrame) -> DataFrame:
        wanted = stored(wanted.distinct(), "wanted")
        # Few texts have near ones; while their nodes are a short list, the others stay where they are.
        if wanted.count() <= MOST_LISTED:
            wanted = F.broadcast(wanted)
        return stored(docs.join(wanted, "node", "left_semi").groupBy("node").agg(F.any_value("text").alias("text")), "texts")

    def near(order: list[str], apart: DataFrame) -> DataFrame:
        pairs = stored(_near_leaders(apart, *order).distinct(), "pairs")
        return stored(alike(pairs, texts_of_nodes(pairs.select("a").union(pairs.select("b")).toDF("node"))), "alike")

    found = near(["node"], apart)
    labels = components(found)
    apart = _still_apart(apart, labels)
    again = near(["node", "bucket"], apart)
    if not again.isEmpty():
        found = found.union(again)
        labels = components(found)
        apart = _still_apart(apart, labels)
    short_batches(docs.sparkSession, TILE_BATCH)
    rest = stored(_links_of_rest(apart, texts_of_nodes), "alike")
    short_batches(docs.sparkSession)
    if not rest.isEmpty():
        found = found.union(rest)
        labels = components(found)
    return found, labels


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, node), nodes without words set apart by ``worded``; and the members of
    the classes: (node, first_id, n_copies, label, class_id, keeper, n_texts), keeper being the
    node that holds the class's smallest doc_id."""
    short_batches(docs.sparkSession)
    docs = with_node(docs)
    signed = stored(docs.mapInArrow(_sign, "doc_id long, node binary, bands array<long>, sketch binary"), "signed")
    rows = signed.select("doc_id", "node", (F.size("bands") > 0).alias("worded"))
    nodes = stored(signed.where(F.size("bands") > 0).groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")), "nodes")
    _, labels = links(docs, nodes)
    flat = nodes.select("node", "first_id", "n_copies")
    labelled = flat.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = F.min(F.struct(F.col("first_id").isNull(), "first_id", "node"))
    found = labelled.groupBy("label").agg(first["first_id"].alias("class_id"), first["node"].alias("keeper"), F.count(F.lit(1)).alias("n_texts"))
    return rows, labelled.join(found, "label")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_copies, n_texts): the class of every row, how many rows share its text,
    and how many different texts its class has."""
    rows, members = classes(docs)
    one = F.lit(1).cast("long")
    blank = rows.where("NOT worded").select("doc_id", F.col("doc_id").alias("class_id"), one.alias("n_copies"), one.alias("n_texts"))
    return rows.where("worded").join(members, "node").select("doc_id", "class_id", "n_copies", "n_texts").union(blank)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the smallest doc_id
    (of repeated rows one); rows without words all stay."""
    own, members = classes(docs.select("doc_id", "text"))
    copies = own.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("same"))
    keepers = members.where("node = keeper").select("node", "first_id").join(copies, "node").where(
        F.col("doc_id").eqNullSafe(F.col("first_id"))).select("node", "first_id", "same")
    keepers = stored(keepers, "keepers")
    if keepers.count() <= MOST_LISTED:  # else the documents are shuffled to their keepers
        keepers = F.broadcast(keepers)
    rows, at, names = numbered(docs, "text")
    doc_id = rows.columns[names.index("doc_id")]
    marked = rows.withColumn("node", F.unhex(F.md5(F.coalesce(at, F.lit("")))))
    blank = ~F.coalesce(at, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = marked.where(~blank).join(keepers, "node").where(F.col(doc_id).eqNullSafe(F.col("first_id")))
    # Repeated rows are few; only they have to meet for one of them to stay.
    single = kept.where("same = 1").select(rows.columns)
    repeated = kept.where("same > 1").groupBy("node").agg(F.any_value(F.struct(*rows.columns)).alias("r")).select("r.*")
    return single.union(repeated).union(marked.where(blank).select(rows.columns)).toDF(*names)
