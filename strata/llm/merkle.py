"""Merkle manifest of a table: leaves, a tree a source, one tree over the sources, a proof a row.

A row's leaf is the SHA-256 of its fields.  The leaves of a source, in order of their ids, are hashed
``FAN`` consecutive nodes at a time until one is left; these subroots are hashed likewise, in order of their sources, to
the root.

Trees are cut into superblocks of ``FAN ** HEIGHT`` consecutive nodes of one level, so no task holds more
than one of them, however many rows a source has.  Going up, each superblock becomes one node (one shuffle of digests
for ``HEIGHT`` levels).  Going down, every superblock is cogrouped with the nodes that it needs from outside,
the siblings on the way from its own top to the root: its levels are rebuilt, and each node's siblings are its
own ones within and the given ones outside.  The last exchange, that of the leaves, also joins the proofs and folds
the leaves of the rows as they are now.  Positions come from a range partitioning and counts by partition, so that
a source may be spread over all of them.  Texts are read once and only digests are moved.

Defined cases: a null field is ``-``, other than an empty one; rows without source are the first tree, rows
without id come first in theirs; rows of equal ids are ordered by their leaf, so repeated rows are
neighbours with equal leaves; a tree with one leaf is that leaf, the root of one source is its subroot; a long text is hashed
whole by the JVM; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpoint

FAN = 3
#: Levels of a superblock: 3 ** 7 = 2,187 nodes.
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The one tree over all sources.
FOREST = "*"

NODES = "tree string, at long, size long, digest string"
PATHS = "tree string, at long, digest string, subroot string, before array<string>, after array<string>"
PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each with its length in bytes."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def tampered(text: Column, doc_id: Column) -> Column:
    """The text without its line feeds, in rows whose id has an even CRC-32."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def levels_of(size: int, at_most: int = HEIGHT) -> int:
    """Levels that a tree of ``size`` nodes still has above them, up to ``at_most``."""
    n = 0
    while size > 1 and n < at_most:
        size, n = -(-size // FAN), n + 1
    return n


def levels(nodes: list[str], height: int) -> list[list[str]]:
    """The levels of a superblock, its own nodes first."""
    out = [nodes]
    for _ in range(height):
        last = out[-1]
        out.append([digest(*last[i:i + FAN]) for i in range(0, len(last), FAN)])
    return out


def siblings(block: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """What stands before and after a node, and the nodes above it, in their runs; the lowest level first."""
    before, after = [], []
    for level in block[:-1]:
        start = place - place % FAN
        before.append("".join(level[start:place]))
        after.append("".join(level[place + 1:start + FAN]))
        place //= FAN
    return before, after


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``at``, the place of a row within its ``tree``, and ``size``, the rows of the tree."""
    dealt = df.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = checkpoint(dealt.select("*", F.spark_partition_id().alias("part"),
                                   F.monotonically_increasing_id().alias("row")), cache=False)
    runs = rows.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    by_tree = Window.partitionBy("tree")  # one row a tree and partition
    ahead = F.sum("n").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("tree", "part", (F.coalesce(ahead, F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("n").over(by_tree).alias("size"))
    return rows.join(starts, ["tree", "part"]).select(
        *df.columns, (F.col("row") + F.col("shift")).alias("at"), "size")


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at div {FAN ** height}"))


def _nodes(block: pd.DataFrame, height: int) -> tuple[pd.DataFrame, list[list[str]]]:
    """A superblock in order, and its levels."""
    block = block.sort_values("at").reset_index(drop=True)
    return block, levels(block["digest"].tolist(), levels_of(int(block["size"].iloc[0]), height))


def climb(leaves: DataFrame, height: int) -> list[DataFrame]:
    """``(tree, at, size, digest)`` of the tops of superblocks, round by round, until each tree has one.

    Rounds: the levels of the largest tree divided by ``height``."""

    def top(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block, inner = _nodes(block, height)
        size = -(-int(block["size"].iloc[0]) // FAN ** height)
        return pd.DataFrame({"tree": [key[0]], "at": [key[1]], "size": [size], "digest": inner[-1]})

    rounds, largest = [leaves.select("tree", "at", "size", "digest")], 2
    while largest > 1:
        tops = _blocks(rounds[-1], height).groupBy("tree", "block").applyInPandas(top, NODES)
        rounds.append(checkpoint(tops, cache=False))
        largest = rounds[-1].agg(F.max("size")).first()[0] or 0
    return rounds


def _exchange(nodes: DataFrame, outer: DataFrame, height: int, work, schema: str) -> DataFrame:
    """Each superblock with the row of its own top, which holds the siblings outside."""
    above = outer.select("tree", F.col("at").alias("block"), "subroot", "before", "after")
    return _blocks(nodes, height).groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInPandas(
        work, schema)


def paths(rounds: Sequence[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """Siblings up to the root of the nodes of the first of ``rounds``; ``outer``: those of the tops of the last."""

    def work(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, inner = _nodes(block, height)
        above = above.iloc[0]
        ways = [siblings(inner, i) for i in range(len(block))]
        return pd.DataFrame({"tree": key[0], "at": block["at"], "digest": block["digest"], "subroot": above["subroot"],
                             "before": [[*b, *above["before"]] for b, _ in ways],
                             "after": [[*a, *above["after"]] for _, a in ways]})

    for nodes in reversed(rounds):
        outer = checkpoint(_exchange(nodes, outer, height, work, PATHS), cache=False)
    return outer


def _prove(root: str, height: int):
    def work(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, inner = _nodes(block, height)
        above = above.iloc[0]
        outside = list(zip(above["before"], above["after"]))
        proofs, folded = [], []
        for i, node in enumerate(block["now"]):
            way = [*zip(*siblings(inner, i)), *outside]
            proofs.append(digest(*(b + a for b, a in way)))
            for b, a in way:
                node = digest(b, node, a)
            folded.append(node)
        return pd.DataFrame({"doc_id": block["doc_id"], "leaf": block["digest"], "subroot": above["subroot"],
                             "root": root, "proof_sha256": proofs, "folded_root": folded,
                             "verified": [f == root for f in folded]})
    return work


def manifest(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: Sequence[str] = FIELDS,
             text_col: str = "text", change=tampered, height: int = HEIGHT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``change(text, id)`` gives the text as it is found later; its leaf is folded with the siblings of the
    untampered tree."""
    found = [change(df[f], df[id_col]) if f == text_col else df[f] for f in fields]
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), df[source_col].cast("string")), F.lit("-")).alias("tree"),
        df[id_col].alias("doc_id"), leaf([df[f] for f in fields]).alias("digest"), leaf(found).alias("now"))
    leaves = checkpoint(numbered(rows, ["doc_id", "digest", "now"]), cache=False)
    trees = climb(leaves, height)
    subroots = checkpoint(numbered(trees[-1].select(F.lit(FOREST).alias("tree"), F.col("tree").alias("source"),
                                                    "digest"), ["source"]), cache=False)
    forest = climb(subroots, height)
    root = forest[-1].select("digest").first()
    if root is None:
        return df.sparkSession.createDataFrame([], PROOFS)
    no = F.array().cast("array<string>")
    tops = forest[-1].select("tree", "at", "digest", F.lit("").alias("subroot"), no.alias("before"), no.alias("after"))
    of_sources = paths([subroots, *forest[1:-1]], tops, height)
    tops = of_sources.join(subroots.select("at", "source"), "at").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("at"), "digest", F.col("digest").alias("subroot"),
        "before", "after")
    outer = paths(trees[1:-1], tops, height)
    # ids travel as text, as pandas has no whole numbers beside nulls
    named = leaves.select("tree", "at", "size", F.col("doc_id").cast("string").alias("doc_id"), "digest", "now")
    return _exchange(named, outer, height, _prove(root[0], height), PROOFS.replace("doc_id long", "doc_id string")
                     ).withColumn("doc_id", F.col("doc_id").cast("long"))
