"""Nearest neighbours by balanced posting lists.

Centroids come from a bounded sample, which is split again and again into balanced parts until each
stands for one list. There are about as many lists as a list has vectors (the root of their number), at most what
``CENTROID_BYTES`` hold. A graph over the centroids is kept in memory: each is tied to its nearest ones and
to a few far ones, and a search walks from the best entry points towards the query. Every vector goes
to the list of its nearest centroid and, as boundary vectors are what a search misses, to further lists
whose centroid is hardly farther (``CLOSE``), ``REPLICAS`` at most.

A search takes the lists whose centroid is at most ``ratio`` times as far as the nearest one. The ratio, and
how many centroids the graph has to return for it, are fitted: the true neighbours of ``PROBES`` vectors
are found by brute force over all rows, in blocks, and the least ratio is taken that reaches ``RECALL`` of them.

Lists lie in tiles of bounded size: small neighbouring lists share one, a long list is dealt over several by
hash. Queries and vectors are cogrouped by tile, and a tile returns the nearest few for each query.

Cases: vectors that are null, empty, zero or hold null or non-finite entries take no part, nor do
those whose length isn't the commonest, nor rows without an id. Equal vectors are one entry with their
smallest ids, as many as a result can hold, so a vector repeated any number of times stays one entry.
Rows that repeat id and vector count once. A query never finds rows of its own id; a query id with
several vectors gets a result for each. Ties go to the smaller id. Every query looks into lists
that hold as many vectors as it wants, however far they are, so with fewer candidates it gets all. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import short_batches, stored
from tillworks.llm.vectors import finite, usual_length

#: Vectors that the centroids are fitted to, and bytes that all centroids may take.
SAMPLE, CENTROID_BYTES = 50_000, 64 << 20
#: Parts of one split, rounds of k-means in it, and the share beyond an even one that a part may have.
PARTS, ROUNDS, SLACK = 8, 6, 1.25
NEAR_TIES, FAR_TIES, ENTRIES = 16, 4, 32
REPLICAS, CLOSE, BEAM = 6, 1.10, 32
PROBES, RECALL = 200, 0.97
TILE = 8_192
#: Distances worked out at once.
CELLS = 1 << 22


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def _split(points: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part of each point, by k-means whose parts hold at most ``SLACK`` times an even share: points
    with most to lose choose first, and one whose part is full takes the next."""
    most = int(np.ceil(len(points) / parts * SLACK))
    centres = points[rng.choice(len(points), parts, replace=False)]
    part = np.zeros(len(points), "i4")
    for _ in range(ROUNDS):
        far = _squares(points, centres)
        order = np.argsort(far, axis=1, kind="stable")
        two = np.take_along_axis(far, order[:, :2], 1)
        free = np.full(parts, most)
        for i in np.argsort(two[:, 0] - two[:, 1], kind="stable"):
            for k in order[i]:
                if free[k]:
                    part[i], free[k] = k, free[k] - 1
                    break
        centres = np.array([points[part == k].mean(0) if (part == k).any() else centres[k] for k in range(parts)])
    return part


def balanced_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """About ``lists`` centroids, neighbours next to each other."""
    rng = np.random.default_rng(0)
    size, found, open_parts = max(1.0, len(sample) / lists), [], [sample]
    while open_parts:
        points = open_parts.pop()
        wanted = int(round(len(points) / size))
        if wanted < 2 or (points == points[0]).all():
            found.append(points.mean(0))
            continue
        part = _split(points, min(PARTS, wanted), rng)
        open_parts += [points[part == k] for k in range(part.max() + 1) if (part == k).any()]
    return np.array(found, "f4")


class CentroidGraph:
    """Centroids and who is tied to whom."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids, n = centroids, len(centroids)
        near, ties = min(NEAR_TIES, n - 1), []
        for lo in range(0, n, 1024):
            far = _squares(centroids[lo:lo + 1024], centroids)
            far[np.arange(len(far)), np.arange(lo, lo + len(far))] = np.inf
            ties.append(np.argpartition(far, near - 1, axis=1)[:, :near] if near else np.empty((len(far), 0), "i8"))
        # Ties to places spread over all others keep groups that lie far apart connected.
        spread = (np.arange(n)[:, None] + (np.arange(1, FAR_TIES + 1) * max(1, n // (FAR_TIES + 1)))[None]) % n
        self.ties = np.concatenate([np.concatenate(ties), spread], axis=1).astype("i4")
        self.entries = np.unique(np.linspace(0, n - 1, min(n, ENTRIES)).astype("i4"))

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, distance) of the nearest found for each query, nearest first, ``beam`` columns."""
        beam = min(beam, len(self.centroids))
        block = max(1, min(256, CELLS // (len(self.centroids) + 1)))
        parts = [self._search(queries[lo:lo + block], beam) for lo in range(0, len(queries), block)]
        if not parts:
            return np.empty((0, beam), "i4"), np.empty((0, beam))
        return tuple(map(np.concatenate, zip(*parts)))

    def _far(self, queries: np.ndarray, which: np.ndarray) -> np.ndarray:
        off = self.centroids[which] - queries[:, None, :]
        return np.einsum("qkd,qkd->qk", off, off)

    def _search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        queries, rows = queries.astype("f4"), np.arange(len(queries))[:, None]
        at = np.broadcast_to(self.entries, (len(queries), len(self.entries)))
        seen = np.zeros((len(queries), len(self.centroids)), bool)
        seen[:, self.entries] = True
        far, done = self._far(queries, at), np.zeros(at.shape, bool)
        step = max(4, beam // 16)
        while True:
            # The nearest that haven't been left yet; a query whose beam has been walked through waits.
            ahead = np.where(done, np.inf, far)
            pick = np.argsort(ahead, axis=1, kind="stable")[:, :step]
            open_ = np.isfinite(np.take_along_axis(ahead, pick, 1))
            if not open_.any():
                break
            done[rows, pick] = True
            to = np.where(open_[:, :, None], self.ties[np.take_along_axis(at, pick, 1)], -1).reshape(len(queries), -1)
            new = (to >= 0) & ~seen[rows, to]
            seen[rows[:, [0] * to.shape[1]][new], to[new]] = True
            distance = np.where(new, self._far(queries, np.maximum(to, 0)), np.inf)
            # The same centroid may be reached twice in one step.
            order = np.argsort(to, axis=1, kind="stable")
            sorted_to = np.take_along_axis(to, order, 1)
            twice = np.zeros_like(new)
            twice[rows, order[:, 1:]] = sorted_to[:, 1:] == sorted_to[:, :-1]
            distance[twice] = np.inf
            at, far, done = np.concatenate([at, to], 1), np.concatenate([far, distance], 1), np.concatenate([done, ~np.isfinite(distance)], 1)
            if at.shape[1] > beam:
                keep = np.argsort(far, axis=1, kind="stable")[:, :beam]
                at, far, done = (np.take_along_axis(x, keep, 1) for x in (at, far, done))
            done |= ~np.isfinite(far)
        order = np.argsort(far, axis=1, kind="stable")
        at, far = np.take_along_axis(at, order, 1), np.sqrt(np.take_along_axis(far, order, 1))
        if at.shape[1] < beam:
            short = beam - at.shape[1]
            at, far = np.pad(at, ((0, 0), (0, short)), constant_values=-1), np.pad(far, ((0, 0), (0, short)), constant_values=np.inf)
        return at[:, :beam], far[:, :beam]


@dataclass
class Index:
    """What a search needs: the graph (in memory), the vectors with their lists (a stored table), the
    size of each list, and the fitted ratio and beam."""

    graph: CentroidGraph | None
    entries: DataFrame
    sizes: np.ndarray
    ratio: float
    beam: int
    most: int


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _assign(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The lists of each vector, nearest first."""
    for rows in batches:
        if not len(rows):
            continue
        at, far = shared.value.search(_matrix(rows.column("vector")), BEAM)
        near = (far <= np.maximum(far[:, :1] * CLOSE, far[:, :1])) & (np.arange(at.shape[1]) < REPLICAS) & (at >= 0)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *near.sum(1)]), pa.int32()), pa.array(at[near], pa.int32()))
        yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "lists"])


def _brute(batches: Iterator[pa.RecordBatch], probes, most: int) -> Iterator[pa.RecordBatch]:
    """Of each batch the vectors nearest to each probe, with their lists."""
    asked = probes.value
    for rows in batches:
        if not len(rows):
            continue
        far = _squares(asked, _matrix(rows.column("vector")).astype("f8"))
        pick = np.argsort(far, axis=1, kind="stable")[:, :most + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(asked)), pick.shape[1]), pa.int32()),
             pa.array(np.take_along_axis(far, pick, 1).reshape(-1)), rows.column("lists").take(pa.array(pick.reshape(-1)))],
            names=["probe", "far", "lists"])


def _fitted(graph: CentroidGraph, entries: DataFrame, probes: np.ndarray, most: int) -> tuple[float, int]:
    """Ratio and beam that reach ``RECALL`` of the probes' true neighbours."""
    shared = entries.sparkSession.sparkContext.broadcast(probes)
    near = entries.select("vector", "lists").mapInArrow(partial(_brute, probes=shared, most=most), "probe int, far double, lists array<int>")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("probe").orderBy("far"))).where(F.col("rank") <= most + 1)
    true = ranked.where("rank > 1").collect()  # the first is the probe itself; PROBES x most rows
    far = np.sqrt(_squares(probes, graph.centroids.astype("f8")))
    least = np.maximum(far.min(1), 1e-12)
    needed = np.sort([far[r.probe, r.lists].min() / least[r.probe] for r in true])
    if not len(needed):
        return float("inf"), len(graph.centroids)
    ratio = float(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)]) * (1 + 1e-6)
    within = (far <= ratio * least[:, None]).sum(1).max()
    return ratio, int(min(len(graph.centroids), max(BEAM, 1.25 * within)))


def distinct_vectors(frame: DataFrame, most: int, vector: str, ident: str) -> DataFrame:
    """(vector, ids): every different vector that takes part, with its ``most`` + 1 smallest ids."""
    v = F.col(f"`{vector}`")
    rows = frame.select(F.col(f"`{ident}`").cast("long").alias("id"), v.alias("vector")).where(
        F.col("id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda c: c != 0))
    length = usual_length(rows, "vector")
    rows = rows.where(F.size("vector") == length).distinct()
    # The bound on the rank holds in every task before rows are moved, so a hot vector stays a few rows.
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("nth") <= most + 1)
    return first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def build(frame: DataFrame, most: int = 10, vector: str = "embedding", ident: str = "vec_id") -> Index:
    """An index over all rows, for results of up to ``most``."""
    spark = frame.sparkSession
    short_batches(spark, 2048)
    different = stored(distinct_vectors(frame, most, vector, ident), "different-vectors")
    n = different.count()
    if not n:
        return Index(None, different, np.empty((0, 2), "i8"), float("inf"), 0, most)
    sample = different.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toArrow()
    points = _matrix(sample.column(0).combine_chunks()).astype("f8")
    lists = min(int(np.ceil(np.sqrt(n))), max(1, CENTROID_BYTES // (4 * points.shape[1])), len(points))
    graph = CentroidGraph(balanced_centroids(points, lists))
    shared = spark.sparkContext.broadcast(graph)
    kind = different.schema["vector"].dataType.simpleString()
    entries = stored(different.mapInArrow(partial(_assign, shared=shared), f"vector {kind}, ids array<long>, lists array<int>"), "lists")
    sizes = np.zeros(len(graph.centroids), "i8")
    ratio, beam = _fitted(graph, entries, points[:PROBES], most) if n > most + 1 else (float("inf"), len(graph.centroids))
    for r in entries.select(F.explode("lists").alias("list")).groupBy("list").count().collect():  # a row for each list
        sizes[r.list] = r["count"]
    return Index(graph, entries, sizes, ratio, beam, most)


def tiles_of(sizes: np.ndarray) -> np.ndarray:
    """(first tile, number of tiles) of each list: neighbours fill a tile together, long lists have several."""
    out, tile, filled = np.zeros((len(sizes), 2), "i8"), 0, 0
    for i, size in enumerate(sizes.tolist()):
        if filled and filled + size > TILE:
            tile, filled = tile + 1, 0
        parts = max(1, -(-size // TILE))
        out[i] = tile, parts
        if parts > 1:
            tile, filled = tile + parts, 0
        else:
            filled += size
    return out


def _probe(batches: Iterator[pa.RecordBatch], shared, sizes: np.ndarray, tiles: np.ndarray, ratio: float, beam: int, enough: int) -> Iterator[pa.RecordBatch]:
    """For each query the tiles to look into, and the lists there; beyond the ratio as many lists as hold ``enough``."""
    for rows in batches:
        if not len(rows):
            continue
        at, far = shared.value.search(_matrix(rows.column("vector")), beam)
        held = np.cumsum(np.where(at >= 0, sizes[at], 0), axis=1)
        fewer = np.pad(held, ((0, 0), (1, 0)))[:, :-1] < enough
        take = (at >= 0) & (fewer | (far <= far[:, :1] * ratio if np.isfinite(ratio) else True))
        query, tile, lists = [], [], []
        for i in range(len(rows)):
            by: dict[int, list[int]] = {}
            for c in at[i][take[i]].tolist():
                for t in range(tiles[c, 0], tiles[c].sum()):
                    by.setdefault(t, []).append(c)
            query += [i] * len(by)
            tile += by
            lists += by.values()
        yield pa.RecordBatch.from_arrays(
            [*[c.take(pa.array(query, pa.int64())) for c in rows.columns], pa.array(tile, pa.int64()), pa.array(lists, pa.list_(pa.int32()))],
            names=[*rows.schema.names, "tile", "lists"])


def nearest(queries: np.ndarray, vectors: np.ndarray, allowed: np.ndarray, most: int) -> Iterator[tuple[int, int, float]]:
    """(query, vector, distance) of the ``most`` nearest allowed vectors of each query and of those as far
    as the last. A product sorts out the far ones; what is near is measured exactly."""
    centre = vectors.mean(0)
    a, b = queries - centre, vectors - centre
    slack = 1e-12 * ((b * b).sum(1).max() + (a * a).sum(1).max())
    for i, row in enumerate(np.where(allowed, _squares(a, b), np.inf)):
        if (kth := np.partition(row, most - 1)[most - 1] if len(row) > most else np.inf) == np.inf:
            pick = np.flatnonzero(np.isfinite(row))
        else:
            pick = np.flatnonzero(row <= kth + slack)
        off = vectors[pick] - queries[i]
        score = np.sqrt((off * off).sum(1))
        if len(pick) > most:
            near = score <= np.partition(score, most - 1)[most - 1]
            pick, score = pick[near], score[near]
        yield from ((i, j, s) for j, s in zip(pick.tolist(), score.tolist()))


FOUND = "query_id long, query long, vec_id long, score double"


def _look(entries: pd.DataFrame, asked: pd.DataFrame, most: int) -> pd.DataFrame:
    """The nearest entries of one tile for each query."""
    out: list[tuple[int, int, int, float]] = []
    if len(entries) and len(asked):
        lists, at = np.unique(entries["list"].to_numpy(), return_inverse=True)
        vectors = np.array(entries["vector"].tolist(), "f8")
        ids = entries["ids"].tolist()
        step = max(1, CELLS // (4 * len(vectors)))
        for lo in range(0, len(asked), step):
            part = asked.iloc[lo:lo + step]
            probed = np.array([np.isin(lists, of) for of in part["lists"]])
            # An entry stands once in each of its lists; one more place for each makes up for that, and one for the query itself.
            found = nearest(np.array(part["vector"].tolist(), "f8"), vectors, probed[:, at], REPLICAS * (most + 1))
            query, name = part["query"].tolist(), part["query_id"].tolist()
            near: dict[int, set[tuple[float, int]]] = {}
            for i, j, score in found:
                near.setdefault(i, set()).update((score, x) for x in ids[j] if x != name[i])
            out += [(name[i], query[i], x, score) for i, of in near.items() for score, x in sorted(of)[:most]]
    return pd.DataFrame(out, columns=["query_id", "query", "vec_id", "score"])


def search(index: Index, frame: DataFrame, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for each row of ``frame``."""
    spark, most = frame.sparkSession, index.most
    schema = "query_id long, rank int, vec_id long, score double"
    if index.graph is None:
        return spark.createDataFrame([], schema)
    short_batches(spark, 2048)
    shared, tiles = spark.sparkContext.broadcast(index.graph), tiles_of(index.sizes)
    kind = index.entries.schema["vector"].dataType
    queries = frame.select(F.col(f"`{ident}`").cast("long").alias("query_id"), F.col(f"`{vector}`").cast(kind).alias("vector")).where(
        F.col("query_id").isNotNull() & finite(F.col("vector")) & F.exists("vector", lambda c: c != 0)
        & (F.size("vector") == index.graph.centroids.shape[1])).distinct().withColumn("query", F.xxhash64("vector"))
    probes = queries.mapInArrow(
        partial(_probe, shared=shared, sizes=index.sizes, tiles=tiles, ratio=index.ratio, beam=index.beam, enough=REPLICAS * (most + 1)),
        f"query_id long, vector {kind.simpleString()}, query long, tile long, lists array<int>")
    places = spark.createDataFrame([(i, *map(int, t)) for i, t in enumerate(tiles)], "list int, first long, parts long")  # a row for each list
    dealt = index.entries.select("vector", "ids", F.explode("lists").alias("list")).join(F.broadcast(places), "list").select(
        (F.col("first") + F.pmod(F.xxhash64("vector"), "parts")).alias("tile"), "list", "vector", "ids")
    found = dealt.groupBy("tile").cogroup(probes.groupBy("tile")).applyInPandas(partial(_look, most=most), FOUND).distinct()
    best = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")
