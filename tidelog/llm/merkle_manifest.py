"""Merkle manifest of a dataset: leaf, subroot, root and proof of every document, by nested-interval labels.

Every row is a leaf, the hash of its identifying columns. Per language, leaves ascend by doc_id, every ``ARITY`` consecutive
nodes hash to their parent, and the last node standing is the language's subroot; subroots, ordered by language, make the
root in the same way.

A node is labelled with the interval ``[lo, hi)`` of leaf ranks that it covers. Ranks come from one range shuffle: rows know
their place in their partition, and counts per partition (one small row each) say how many come before. Nodes are kept level
by level. Going down, a node is joined with the one of the level above whose interval contains its own; the join is
bucketed by the width of that level, so a bucket holds one parent and its ``ARITY`` children at most, whatever a language's
share of the rows. The difference of both intervals, within the parent, is what the siblings cover. So each leaf gets its
ancestors' siblings bottom up, which is its proof, and no task sees more of a level than its own buckets.

Nulls and repeats: a null value is hashed as ``-``; a null language comes first, a null doc_id comes first in its language
and is never tampered with. Rows that share a doc_id are leaves of their own, ordered by leaf; equal ones have equal leaves
and any order, which changes no digest. Empty tables give empty results; other columns are never read.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

ARITY = 8
#: Columns of a leaf, in the order they are hashed.
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ``monotonically_increasing_id`` has the partition above this bit, and the row below it.
PLACE_BITS = 33
PATH = "array<struct<before:string,after:string>>"


class Tree(NamedTuple):
    """``levels[k]`` has ``tree, n, lo, hi, digest`` of the nodes of level ``k``, and from 1 on their ``children``."""

    leaves: DataFrame
    levels: list[DataFrame]


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: dict[str, Column]) -> Column:
    """Lowercase hex SHA-256 of the encoded ``HASHED`` values."""
    return F.sha2(F.concat(*(_encoded(values[name]) for name in HASHED)), 256)


def tampered() -> Column:
    """Whether the test of tampering rewrites the row."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves_of(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, digest, altered`` of every row; ``altered`` is the leaf after tampering, null where there was none."""
    own = docs.select(*HASHED)
    values = {name: F.col(name) for name in HASHED}
    changed = {**values, "text": F.translate("text", UPPER, LOWER)}
    return own.select(
        # A null language sorts before the empty one.
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest(values).alias("digest"),
        F.when(tampered(), leaf_digest(changed)).alias("altered"),
    )


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (a stored table) with ``lo``, the rank in its ``tree`` by ``order``, ``hi = lo + 1`` and the tree's size ``n``.

    The last key of the range shuffle tells equal rows apart, so that these spread as well.
    """
    keys = ["tree", *order, "_copy"]
    spread = rows.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(spread.drop("_copy").withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", PLACE_BITS).alias("_part")
    counts = placed.groupBy("tree", part).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = stored(
        counts.select(
            "tree",
            "_part",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(Window.partitionBy("tree")).alias("n"),
        )
    )
    lo = F.col("_place") + F.col("_shift")
    found = placed.withColumn("_part", part).join(spans, ["tree", "_part"])
    return found.withColumn("lo", lo).withColumn("hi", lo + 1).drop("_place", "_part", "_shift")


def _bucket(level: int) -> Column:
    return F.expr(f"lo div {ARITY**level}")


def build(leaves: DataFrame) -> Tree:
    """All nodes over ranked ``leaves`` (tree, n, lo, hi, digest), one written table a level."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves.select("tree", "n", "lo", "hi", "digest")]
    while ARITY ** (len(levels) - 1) < largest:
        level = len(levels)
        # Trees that have come down to one node stop below; its digest is theirs.
        open_nodes = levels[-1].where(F.col("n") > ARITY ** (level - 1))
        runs = open_nodes.groupBy("tree", "n", _bucket(level).alias("_bucket")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")
        )
        digest = F.sha2(F.concat_ws("", "children.digest"), 256)
        levels.append(stored(runs.select("tree", "n", "lo", "hi", digest.alias("digest"), "children")))
    return Tree(leaves, levels)


def tops(tree: Tree) -> DataFrame:
    """``tree, digest`` of the last node of every tree."""
    found = [nodes.where(F.col("n") <= ARITY**k).select("tree", "digest") for k, nodes in enumerate(tree.levels)]
    return reduce(DataFrame.unionByName, found)


def _digests(children: Column, wanted) -> Column:
    return F.concat_ws("", F.transform(F.filter(children, wanted), lambda c: c["digest"]))


def proofs(tree: Tree, above: DataFrame) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: what stands before and after them and each ancestor among its siblings.

    ``above`` has ``tree, subroot, path`` of the trees; a leaf's path ends in its tree's.
    """
    held = None
    for level in range(len(tree.levels) - 1, -1, -1):
        nodes = tree.levels[level] if level else tree.leaves
        last = nodes.where(F.col("n") <= ARITY**level).join(above, "tree")
        if held is None:
            inner = None
        else:
            parents = held.select(
                F.col("tree").alias("p_tree"),
                F.expr(f"lo div {ARITY ** (level + 1)}").alias("p_bucket"),
                F.col("lo").alias("p_lo"),
                F.col("hi").alias("p_hi"),
                F.col("children").alias("p_children"),
                "subroot",
                "path",
            )
            within = (
                (F.col("tree") == F.col("p_tree"))
                & (_bucket(level + 1) == F.col("p_bucket"))
                & (F.col("p_lo") <= F.col("lo"))
                & (F.col("hi") <= F.col("p_hi"))
            )
            lo, hi = F.col("lo"), F.col("hi")
            siblings = F.struct(
                _digests(F.col("p_children"), lambda c: c["hi"] <= lo).alias("before"),
                _digests(F.col("p_children"), lambda c: c["lo"] >= hi).alias("after"),
            )
            joined = nodes.where(F.col("n") > ARITY**level).join(parents, within)
            inner = joined.withColumn("path", F.concat(F.array(siblings), "path")).drop("p_tree", "p_bucket", "p_lo", "p_hi", "p_children")
        held = last if inner is None else last.unionByName(inner)
    return held


def folded(leaf: Column, path: Column) -> Column:
    """The digest that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.concat(run["before"], node, run["after"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``."""
    leaves = ranked(stored(leaves_of(docs)), "doc_id", "digest")
    tree = build(leaves)
    languages = stored(tops(tree).select(F.lit("").alias("tree"), F.col("tree").alias("lang_key"), "digest"))
    top = build(ranked(languages, "lang_key"))
    root = tops(top).first()
    none = top.leaves.select(F.lit("").alias("tree"), F.lit(None).cast("string").alias("subroot"), F.expr(f"CAST(array() AS {PATH})").alias("path")).limit(1)
    above = stored(proofs(top, none).select(F.col("lang_key").alias("tree"), F.col("digest").alias("subroot"), "path"))
    found = proofs(tree, above)
    siblings = F.concat_ws("", F.transform("path", lambda run: F.concat(run["before"], run["after"])))
    out = found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root.digest if root else None).cast("string").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("altered", "digest"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
