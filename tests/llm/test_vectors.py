"""Nearest neighbours, whitening and the Merkle manifest against brute force."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest

from tillworks.llm import merkle, posting_lists, queries, whitening
from tillworks.llm.positions import numbered_rows

SMALL = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int, query long, x string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)


ODD = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [NAN, 1.0, 2.0]), (6, [INF, 0.0, 1.0]), (7, [1.0, 2.0])]


def test_positions(spark):
    rows = [("a", i) for i in range(500)] + [(None, i) for i in range(7)] + [("b", 1), ("b", 1), ("b", None)]
    got = numbered_rows(spark.createDataFrame(rows, "k string, v int").repartition(5), ["k"], ["v"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.k, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"a": 500, None: 7, "b": 3}
    for k, of in by.items():
        of.sort(key=lambda r: r.position)
        assert [r.position for r in of] == list(range(len(of))) and {r.size for r in of} == {len(of)}
        assert [r.v for r in of] == sorted((v for n, v in rows if n == k), key=lambda v: (v is not None, v or 0))


def neighbours(rows, queries_, most):
    """Brute force: rows of (id, vector)."""
    usable = {(i, tuple(map(float, np.float32(v)))) for i, v in rows}
    out = {}
    for q, v in usable:
        if q % queries_ == 0:
            off = [(float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i) for i, w in usable if i != q]
            out.setdefault(q, []).extend((q, k, i, s) for k, (s, i) in enumerate(sorted(off)[:most], 1))
    return out


def test_neighbours_of_few(spark):
    same = [0.5, 0.25, 0.125]
    rows = [(10, same), (11, same), (12, same), (12, same), (20, [1.0, 0.0, 0.0]), (0, [0.0, 1.0, 0.0]), (30, [0.0, -1.0, 0.0])]
    frame = vectors(spark, rows + ODD + [(None, same)])
    got = posting_lists.search(posting_lists.build(frame, most=4), frame.where("vec_id % 10 = 0")).collect()
    want = neighbours(rows, 10, 4)
    assert sorted(map(tuple, got)) == sorted(x for of in want.values() for x in of)


def test_no_neighbours(spark):
    one = vectors(spark, [(0, [1.0, 2.0])])
    assert posting_lists.search(posting_lists.build(one), one).collect() == []
    none = vectors(spark, ODD[:6])
    assert posting_lists.search(posting_lists.build(none), none).collect() == []
    assert posting_lists.search(posting_lists.build(none.limit(0)), none.limit(0)).collect() == []


def test_hot_vector(spark, monkeypatch):
    """A third of all rows share a vector, another third nearly share one; lists are dealt over several tiles."""
    monkeypatch.setattr(posting_lists, "TILE", 40)
    r = np.random.default_rng(1)
    rows = [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(400)]
    rows += [(i, (np.array([2.0, 0, 0, 0]) + 1e-3 * r.normal(size=4)).tolist()) for i in range(400, 800)]
    rows += [(i, r.normal(size=4).tolist()) for i in range(800, 1200)]
    frame = vectors(spark, rows)
    index = posting_lists.build(frame)
    assert (posting_lists.tiles_of(index.sizes)[:, 1] > 1).any()
    assert index.entries.count() == 801
    got = posting_lists.search(index, frame.where("vec_id % 100 = 0")).collect()
    want = [x for of in neighbours(rows, 100, 10).values() for x in of]
    found = {(g.query_id, g.vec_id) for g in got}
    assert len(found & {x[:3:2] for x in want}) >= 0.9 * len(want) and len(got) == len(want) == 120
    assert {tuple(g) for g in got if g.query_id < 400} == {x for x in want if x[0] < 400}


def test_recall(spark):
    """Of the true neighbours at least 0.9 are found, scores are exact and ranks without gaps."""
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = queries.op11_posting_lists(spark, "/root/testdata/sf0.1").collect()
    rows = {r.vec_id: np.array(r.embedding, "f8") for r in frame.collect()}
    ids, matrix = np.array(list(rows)), np.array(list(rows.values()))
    hits = 0
    for q in ids[ids % 100 == 0].tolist():
        of = sorted((g for g in got if g.query_id == q), key=lambda g: g["rank"])
        assert [g["rank"] for g in of] == list(range(1, 11))
        assert [(g.score, g.vec_id) for g in of] == sorted((g.score, g.vec_id) for g in of)
        for g in of:
            assert g.score == pytest.approx(np.linalg.norm(rows[q] - rows[g.vec_id]), rel=1e-12)
        far = np.linalg.norm(matrix - rows[q], axis=1)
        far[ids == q] = np.inf
        hits += len({g.vec_id for g in of} & set(ids[np.argsort(far)[:10]].tolist()))
    assert hits >= 0.9 * len(got) and len(got) == 200


def test_graph_finds_nearest():
    """Groups far apart, as kept by the far ties."""
    r = np.random.default_rng(0)
    points = np.concatenate([r.normal(size=(80, 8)) + 100 * k for k in range(6)]).astype("f4")
    graph = posting_lists.CentroidGraph(points)
    asked = points + 0.01
    at, far = graph.search(asked, 32)
    true = np.sqrt(((asked[:, None] - points[None]) ** 2).sum(2))
    assert (at[:, 0] == true.argmin(1)).mean() > 0.97 and (np.diff(far, axis=1) >= 0).all()
    one = posting_lists.CentroidGraph(points[:1]).search(asked[:3], 5)
    assert one[0].tolist() == [[0]] * 3


def test_balance():
    r = np.random.default_rng(0)
    points = np.concatenate([r.normal(size=(3000, 6)) * 0.01, r.normal(size=(1000, 6))])
    centroids = posting_lists.balanced_centroids(points, 64)
    sizes = np.bincount(posting_lists._squares(points, centroids).argmin(1), minlength=len(centroids))
    assert 48 <= len(centroids) <= 90 and sizes.max() < 6 * sizes.mean()


def white(rows):
    x = np.floor(np.array([v for _, v in rows], "f4").astype("f8") * 1024).astype("i8") + 100_000
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return x, n, s, c, e[::-1], u[:, ::-1]


@pytest.mark.parametrize("rows_in_block, columns", [(4096, 1024), (64, 1024), (50, 16)])
def test_whitening(spark, monkeypatch, rows_in_block, columns):
    monkeypatch.setattr(whitening, "ROWS", rows_in_block)
    monkeypatch.setattr(whitening, "COLUMNS", columns)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    x, n, s, c, e, u = white(rows)
    got = queries.op12_whitening(spark, SMALL).orderBy("vec_id", "component").collect()
    assert len(got) == 8 * n and {g.n for g in got} == {n}
    deviation = [sum(int(v) ** 2 for v in row) for row in n * x - s]
    assert [g.deviation for g in got] == [d for d in deviation for _ in range(8)]
    mine, theirs = np.array([g.whitened for g in got]).reshape(n, 8), c @ u[:, :8] / np.sqrt(e[:8])
    sign = np.sign((mine * theirs).sum(0))
    assert np.abs(mine * sign - theirs).max() < 1e-9
    assert [g.explained for g in got[:8]] == pytest.approx((e[:8] / e.sum()).tolist(), rel=1e-9)
    assert {g.identity_error for g in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [2.0, 1.0, 5.0]), (9, [0.0, 0.0, 0.0]), (10, [1e6, -1e6, 0.5])]
    frame = vectors(spark, rows + [o for o in ODD if o[0] != 3] + [(11, [1e30, 0.0, 0.0])])
    got = whitening.whitened(frame).collect()
    x, n, s, c, e, u = white(rows)
    assert sorted((g.vec_id or 0, int(g.deviation)) for g in got) == sorted((i or 0, sum(int(v) ** 2 for v in row)) for (i, _), row in zip(rows, n * x - s))
    assert all(len(g.whitened) == len(g.explained) <= 3 for g in got)
    for same in (rows[:1], rows[:2], [], ODD[:2]):
        assert whitening.whitened(vectors(spark, same)).collect() == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def by_hand(rows):
    """The manifest of (doc_id, text, lang, source, n_chars) rows, level by level."""
    def leaf(r, text):
        return sha(written(r[0]) + written(r[3]) + written(r[2]) + written(r[4]) + written(text))

    def tree(level):
        ways, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for i, p in enumerate(at):
                lo = p // 3 * 3
                ways[i].append(("".join(level[lo:p]), "".join(level[p + 1:lo + 3])))
                at[i] = p // 3
            level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        return level[0], ways

    trees = []
    for source in sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode())):
        of = sorted((r for r in rows if r[3] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((of, *tree([leaf(r, r[1]) for r in of])))
    root, tops = tree([t[1] for t in trees])
    out = []
    for (of, subroot, ways), top in zip(trees, tops):
        for r, way in zip(of, ways):
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for before, after in way + top:
                folded = sha(before + folded + after)
            out.append((r[0], leaf(r, r[1]), subroot, root, sha("".join(b + a for b, a in way + top)), folded, folded == root))
    return out


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def merkle_rows():
    rows = [(i, f"text {i}\nof {i}" if i % 3 else "one line", "en", "hot", i) for i in range(200)]
    rows += [(i, "a\nb", None, f"s{i}", None) for i in range(300, 340)]
    rows += [(None, "x\ny", "en", None, 3), (None, None, None, None, None), (5, "", "de", None, 0), (7, "é\n中", "", "", -1), (7, "é\n中", "", "", -1)]
    return rows + [(400, "\n" * 100_000 + "z", "en", "ünï", 1), (-12, "\n", "en", "Z", 1)]


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_merkle(spark, depth):
    """Low superblocks make trees of superblocks of superblocks."""
    rows = merkle_rows()
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS position", "'x' AS digest", "2 AS size")
    got = merkle.manifest(frame.repartition(4), depth).collect()
    assert sorted(map(tuple, got), key=key) == sorted(by_hand(rows), key=key)


def test_merkle_folds_every_leaf():
    """A sibling that is wrong shows in the folded root of a leaf nobody touched."""
    leaves = [merkle.node(str(i)) for i in range(3)]
    rows = pd.DataFrame({"doc_id": range(3), "position": range(3), "size": 3, "digest": leaves, "now": leaves})
    root = merkle.node("".join(leaves))
    for sibling, holds in (("", True), (merkle.node("x"), False)):
        top = root if holds else merkle.node(root + merkle.node("y"))
        outer = pd.DataFrame({"path": [[{"before": sibling, "after": ""}] if sibling else []], "subroot": [root], "root": [top]})
        got = merkle._prove(rows, outer, 1)
        assert list(got["folded_root"]) == [root if holds else merkle.node(sibling + root)] * 3
        assert list(got["verified"]) == [holds] * 3


def test_merkle_of_little(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []
    for rows in ([(1, "a", "b", "c", 1)], [(i, "a", "b", "c", 1) for i in range(4)], [(i, "a", "b", f"s{i}", 1) for i in range(4)]):
        assert sorted(map(tuple, merkle.manifest(spark.createDataFrame(rows, DOCS)).collect())) == sorted(by_hand(rows))
