"""A Merkle manifest of a dataset: leaves by document, a tree for each source, one tree over sources.

A node is the lower-case hex SHA-256 of its children's hex digests, three of them, the last of a
level fewer. Leaves of a source ascend by doc_id. ``FANOUT ** DEPTH`` consecutive leaves are a
superblock, a tree of its own. First every superblock is reduced to its root in ``applyInPandas``;
the roots are the leaves of a smaller tree, which is treated the same way, up to the root. That
gives each superblock the outer nodes it needs: the siblings on its way to the root. Leaves and outer
nodes are cogrouped by superblock in a second ``applyInPandas``, which reduces the leaves again, joins
the inner and the outer siblings of each leaf to its proof and folds what stands for the leaf now up
to the root. A task holds one superblock, however many leaves a source has; only digests are moved.

Proofs keep all siblings left and right of a node apart, so a fold puts each at its place.

Cases: a null field is ``-``, an empty one ``0:``. A null source is a source and comes first. Rows
without doc_id come before the others of their source and are never tampered with. Rows that share
doc_id are ordered by leaf; repeated rows are equal leaves, each with its own proof. A lone leaf is
its own subroot, a lone subroot the root, and a leaf without any sibling has the proof of the empty
text. Long texts are hashed whole in the JVM. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import short_batches, stored
from tillworks.llm.positions import numbered_rows

FANOUT, DEPTH = 3, 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Siblings on the way to a root: for each level those before and those after, as one text each.
PATH = "array<struct<before:string,after:string>>"
Path = list[tuple[str, str]]


def node(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    return F.sha2(F.concat(*[field(F.col(f"`{c}`")) for c in FIELDS[:-1]], field(F.col("text") if text is None else text)), 256)


def tampered_leaf() -> Column:
    """The leaf after line feeds were deleted from the texts of every other document, by checksum."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(hit, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf())


def reduced(digests: list[str], depth: int, whole: bool) -> tuple[list[list[str]], str]:
    """Levels of the tree over consecutive nodes, and its root. A block of a larger tree (``whole``)
    rises exactly ``depth`` levels; a tree of its own until one node is left."""
    levels = [digests]
    while len(levels) <= depth if whole else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([node("".join(last[i:i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return levels, levels[-1][0]


def path(levels: list[list[str]], place: int) -> Path:
    """Siblings of the node at a place of the lowest level, up to the root."""
    found = []
    for level in levels[:-1]:
        lo = place - place % FANOUT
        found.append(("".join(level[lo:place]), "".join(level[place + 1:lo + FANOUT])))
        place //= FANOUT
    return found


def fold(digest: str, way: Path) -> str:
    for before, after in way:
        digest = node(before + digest + after)
    return digest


def _levels(rows: pd.DataFrame, depth: int) -> tuple[list[list[str]], str]:
    return reduced(list(rows["digest"]), depth, bool(rows["size"].iloc[0] > FANOUT ** depth))


def _reduce(rows: pd.DataFrame, keys: list[str], depth: int) -> pd.DataFrame:
    rows, block = rows.sort_values("position"), FANOUT ** depth
    _, root = _levels(rows, depth)
    first = rows.iloc[:1]
    out = first[keys].copy()
    out["position"], out["digest"], out["size"] = first["position"] // block, root, -(-first["size"] // block)
    return out


def _outer(rows: pd.DataFrame) -> tuple[Path, str | None, str | None]:
    """What leads on from a superblock: siblings, subroot and root."""
    if not len(rows):
        return [], None, None
    return [(s["before"], s["after"]) for s in rows["path"].iloc[0]], rows["subroot"].iloc[0], rows["root"].iloc[0]


def _paths(rows: pd.DataFrame, outer: pd.DataFrame, keys: list[str], depth: int) -> pd.DataFrame:
    """For inner nodes: the way of each up to the root of its tree, and that root."""
    rows = rows.sort_values("position").reset_index(drop=True)
    levels, top = _levels(rows, depth)
    further, _, root = _outer(outer)
    out = rows[[*keys, "position"]].copy()
    out["path"] = [[{"before": b, "after": a} for b, a in path(levels, i) + further] for i in range(len(rows))]
    out["subroot"] = out["root"] = root or top
    return out


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(rows: pd.DataFrame, outer: pd.DataFrame, depth: int) -> pd.DataFrame:
    """For leaves: proofs and folds."""
    rows = rows.sort_values("position").reset_index(drop=True)
    leaves = list(rows["digest"])
    levels, _ = _levels(rows, depth)
    further, subroot, root = _outer(outer)
    rest = "".join(b + a for b, a in further)
    proofs, folded = [], []
    for i, now in enumerate(rows["now"]):
        way = path(levels, i)
        proofs.append(node("".join([b + a for b, a in way]) + rest))
        folded.append(fold(now, way + further))
    return pd.DataFrame({
        "doc_id": rows["doc_id"], "leaf": leaves, "subroot": subroot, "root": root, "proof_sha256": proofs,
        "folded_root": folded, "verified": [f == root for f in folded]})


def _kinds(nodes: DataFrame, keys: list[str]) -> str:
    return "".join(f"{k} {nodes.schema[k].dataType.simpleString()}, " for k in keys)


def _block(depth: int):
    return F.expr(f"position div {FANOUT ** depth}")


def _blocks(nodes: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """Roots of the superblocks: keys, position among the superblocks of the tree, digest, size (their number)."""
    blocks = nodes.withColumn("block", _block(depth)).groupBy(*keys, "block")
    return stored(blocks.applyInPandas(
        partial(_reduce, keys=keys, depth=depth), f"{_kinds(nodes, keys)}position long, digest string, size long"), "superblocks")


def _cogrouped(nodes: DataFrame, outer: DataFrame, keys: list[str], depth: int, work, schema: str) -> DataFrame:
    """Nodes and the outer nodes of their superblock, brought together by superblock."""
    left = nodes.withColumn("block", _block(depth))
    right = outer.withColumnRenamed("position", "block")
    return left.groupBy(*keys, "block").cogroup(right.groupBy(*keys, "block")).applyInPandas(work, schema)


def _ways(nodes: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """(keys, position, path, subroot, root) of every node of the trees: its siblings up to the root
    of its tree, which is both subroot and root here. Each level of recursion holds as many nodes fewer
    as a superblock has leaves."""
    schema = f"{_kinds(nodes, keys)}position long, path {PATH}, subroot string, root string"
    if nodes.where(F.col("size") > FANOUT ** depth).isEmpty():
        outer = nodes.sparkSession.createDataFrame([], schema)
    else:
        outer = _ways(_blocks(nodes, keys, depth), keys, depth)
    return stored(_cogrouped(nodes, outer, keys, depth, partial(_paths, keys=keys, depth=depth), schema), "ways")


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; superblocks are
    ``depth`` levels high."""
    short_batches(docs.sparkSession, 4096)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf().alias("digest"), tampered_leaf().alias("now"))
    leaves = stored(numbered_rows(rows, ["source"], ["doc_id", "digest"]), "leaves")
    inner = _ways(_blocks(leaves, ["source"], depth), ["source"], depth)
    # Trees of sources under the tree over sources, in the order of their names.
    subroots = inner.where("position = 0").select("source", F.col("root").alias("digest"))
    over = numbered_rows(subroots, [], ["source"])
    upper = stored(_ways(over, [], depth).select("position", F.col("path").alias("rest"), F.col("root").alias("top")).join(
        over.select("position", F.col("source").alias("of"), F.col("digest").alias("under")), "position").drop("position"), "sources")
    outer = inner.join(upper, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "position", F.concat("path", "rest").alias("path"), F.col("under").alias("subroot"), F.col("top").alias("root"))
    return _cogrouped(leaves, outer, ["source"], depth, partial(_prove, depth=depth), PROOFS)
