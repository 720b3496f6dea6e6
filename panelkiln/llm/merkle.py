"""Merkle manifest of a dataset: a ternary hash tree over the rows of each source, and one over the sources.

Rows are numbered within their source range by range, and the numbered rows are cut into blocks of 3**LEVELS leaves, so
a source of any size spreads over tasks. Inside a block one window serves all levels: at level l the nodes stand on the
rows whose place is a multiple of 3**l, lag and lead columns of 3**l and 2 * 3**l rows, masked by the node's slot and
the length of its run, are its siblings, and the first child's row hashes the parent. On the way down the same offsets
hand each node's siblings to the rows below it. The tops of the blocks are the leaves of the next, smaller step.

Defined results: rows with equal doc_id stand in the order of their leaf, rows without doc_id first; repeated rows are
leaves of their own, with equal digests. A null in any column is `-`, which no value can give; an empty text is `0:`.
Texts of any length are hashed whole. A null source is a source of its own, before all others. Other columns play no
part, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one window climbs.
LEVELS = 6
STEP = "struct<before:string,after:string>"


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: each field as UTF-8 byte count, colon and value, or `-` for null."""
    as_text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*(F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in as_text)), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with pos (from 0 within their tree, by order) and n (rows of the tree). Rows that order cannot tell apart must be equal."""
    spread = rows.withColumn("salt", F.monotonically_increasing_id())  # parts equal rows too
    dealt = settle(spread.repartitionByRange(partitions(rows.sparkSession), "tree", *order, "salt").withColumn("part", F.spark_partition_id()), "merkle-order")
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("m"))
    of_tree = Window.partitionBy("tree")
    earlier = F.sum("m").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("tree", "part", F.coalesce(earlier, F.lit(0)).alias("base"), F.sum("m").over(of_tree).alias("n"))
    place = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order, "salt")) - 1
    return dealt.join(offsets, ["tree", "part"]).withColumn("pos", F.col("base") + place).drop("part", "base", "salt")


def _nodes(level: int) -> Column:
    """Nodes of the row's tree at a level."""
    return F.expr(f"(n + {3**level - 1}) div {3**level}")


def _slot(level: int) -> Column:
    return F.expr(f"pos div {3**level} % 3")


def _climb(nodes: DataFrame, levels: int) -> DataFrame:
    """Adds side0, side1, ... (a node's siblings before and after it, on its first leaf's row) and top (the block's digest, on its first row)."""
    w, out = Window.partitionBy("tree", "block").orderBy("pos"), nodes.select("*", F.expr(f"pos div {3**levels}").alias("block"), F.col("digest").alias("top"))
    for level in range(levels):
        step, slot, kept = 3**level, _slot(level), [c for c in out.columns if c != "top"]
        out = out.select("*", *(f("top", k * step).over(w).alias(f"{f.__name__}{k}") for f in (F.lag, F.lead) for k in (1, 2)))
        left = F.least(F.lit(3), _nodes(level) - (F.expr(f"pos div {step}") - slot)) - slot  # nodes of the run from this one on
        before = F.when(slot == 0, "").when(slot == 1, F.col("lag1")).otherwise(F.concat("lag2", "lag1"))
        after = F.when(left == 1, "").when(left == 2, F.col("lead1")).otherwise(F.concat("lead1", "lead2"))
        many, is_node = _nodes(level) > 1, F.col("pos") % step == 0
        parent = F.when(is_node & (slot == 0), F.sha2(F.concat("top", after), 256))
        out = out.select(*kept, F.when(many & is_node, F.struct(before.alias("before"), after.alias("after"))).alias(f"side{level}"), F.when(many, parent).otherwise(F.col("top")).alias("top"))
    return out


def _descend(climbed: DataFrame, upper: DataFrame, levels: int) -> DataFrame:
    """The nodes with path (their siblings from their own level to the root), subroot and root."""
    w = Window.partitionBy("tree", "block").orderBy("pos")
    out = climbed.drop("top").join(upper.withColumnRenamed("pos", "block"), ["tree", "block"])
    kept = [c for c in out.columns if c != "path"]
    out = out.select(*kept, F.when(F.col("pos") % 3**levels == 0, F.col("path")).alias("path"))
    for level in reversed(range(levels)):
        step, slot = 3**level, _slot(level)
        out = out.select("*", *(F.lag("path", k * step).over(w).alias(f"lag{k}") for k in (1, 2)))
        above = F.when(slot == 0, F.col("path")).when(slot == 1, F.col("lag1")).otherwise(F.col("lag2"))
        own = F.when(_nodes(level) > 1, F.concat(F.array(f"side{level}"), above)).otherwise(above)
        out = out.select(*kept, F.when(F.col("pos") % step == 0, own).alias("path"))
    return out.drop("block", *(f"side{level}" for level in range(levels)))


def grow(nodes: DataFrame, crown: Callable[[DataFrame], DataFrame], levels: int = LEVELS) -> DataFrame:
    """nodes (tree, pos, n, digest, ...) with path, subroot and root.

    crown: from the trees' tops (tree, pos, n, digest) to (tree, pos, path, subroot, root), where path begins above the top.
    """
    climbed = settle(_climb(nodes, levels), "merkle-blocks")
    tops = climbed.filter(F.col("pos") % 3**levels == 0).select("tree", F.col("block").alias("pos"), _nodes(levels).alias("n"), F.col("top").alias("digest"))
    largest = climbed.agg(F.max("n")).first()[0] or 0
    upper = grow(tops, crown, levels) if largest > 3**levels else crown(tops)
    return _descend(climbed, upper.select("tree", "pos", "path", "subroot", "root"), levels)


def manifest(docs: DataFrame, changed: Column | None = None, fields: tuple[str, ...] = FIELDS, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, source, leaf, path, subroot, root, and changed_leaf: the leaf with the text `changed`, null where that is null.

    path: from the row up to the root, the digests before and after it (or the node above it) in its run.
    """
    new = F.when(changed.isNotNull(), leaf([changed if f == "text" else F.col(f) for f in fields])) if changed is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    leaves = settle(docs.select("doc_id", "source", tree.alias("tree"), leaf([F.col(f) for f in fields]).alias("digest"), new.alias("changed_leaf")), "merkle-leaves")

    def over_sources(tops: DataFrame) -> DataFrame:
        named = numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
        alone = lambda t: t.select("tree", "pos", F.array().cast(f"array<{STEP}>").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
        return grow(named, alone, levels).select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"), "root")

    grown = grow(numbered(leaves, ["doc_id", "digest"]), over_sources, levels)
    return grown.select("doc_id", "source", F.col("digest").alias("leaf"), "path", "subroot", "root", "changed_leaf")


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x.before, x.after)), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda at, x: F.sha2(F.concat(x.before, at, x.after), 256))


def audit(docs: DataFrame, changed: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the changed leaf where there is one) and verified."""
    made = manifest(docs, changed, levels=levels)
    out = made.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded(F.coalesce("changed_leaf", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
