"""Merkle manifests: a hash tree per group of rows and one over the groups, with an inclusion proof per row.

Nodes are rows of (tree, index, nodes of the level, digest). At every level each node is equijoined with its siblings,
whose indices are computed: within a run of ``fanout`` nodes the k-th sibling stands k slots further, cyclically (for two
that is the exclusive-or with 1). The rows in slot zero then emit the parents. The keys of these joins are (tree, index),
so a tree that holds a third of all rows is spread like any other. Each level is a third of the one below it and
is written as a table. Proofs are handed down: a node takes its parent's proof by one join and adds its siblings.

Rows are numbered within their tree by one range shuffle (``common.numbered``); nothing is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import numbered, stored

FANOUT = 3


def digest(*parts: Column) -> Column:
    """SHA-256 in lower-case hex of texts written one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field_text(value: Column) -> Column:
    """A value as unambiguous text: ``-`` for null, else its bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    return digest(*[field_text(f) for f in fields])


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``nodes`` (tree, i, n, d and others) of trees that have more than one, with ``left`` and ``right``: the digests of the
    siblings before and after each node, written one after another."""
    slot = F.col("i") % fanout
    out = nodes.where(F.col("n") > 1).withColumn("slot", slot)
    others = nodes.where(F.col("n") > 1)
    for k in range(1, fanout):
        other = others.select(F.col("tree").alias("tree_k"), F.col("i").alias("i_k"), F.col("d").alias(f"d_{k}"))
        sibling = F.col("i") - F.col("slot") + (F.col("slot") + k) % fanout
        out = out.join(other, (F.col("tree") == F.col("tree_k")) & (sibling == F.col("i_k")), "left").drop("tree_k", "i_k")

    def beside(wanted) -> Column:
        def at(slot: int) -> Column:
            ks = [k for s in range(fanout) if (k := (s - slot) % fanout) and wanted(s, slot)]
            return F.concat(F.lit(""), *[F.coalesce(F.col(f"d_{k}"), F.lit("")) for k in ks])
        return reduce(lambda rest, s: F.when(F.col("slot") == s, at(s)).otherwise(rest), range(fanout - 1), at(fanout - 1))

    return out.withColumns({"left": beside(lambda s, own: s < own), "right": beside(lambda s, own: s > own)}).drop(
        *[f"d_{k}" for k in range(1, fanout)])


def parents(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The nodes above: emitted by the rows in slot zero."""
    return level.where(F.col("slot") == 0).select(
        "tree", F.expr(f"i div {fanout}").alias("i"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
        digest(F.col("d"), F.col("right")).alias("d"))


def grow(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """All levels of nodes that have siblings to meet, from the leaves up, each written as a table; and the trees' tops
    (tree, level, d)."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], []
    while True:
        tops.append(nodes.where(F.col("n") == 1).select("tree", F.lit(len(levels)).alias("level"), "d"))
        if most <= 1:
            return levels, reduce(DataFrame.unionAll, tops)
        levels.append(stored(with_siblings(nodes, fanout), "merkle-level"))
        nodes, most = parents(levels[-1], fanout), -(-most // fanout)


def proofs(levels: list[DataFrame], tops: DataFrame, keep: Sequence[str] = (), fanout: int = FANOUT) -> DataFrame:
    """``tree, i, subroot, proof`` of the leaves, with the columns ``keep`` of the lowest level. ``tops`` has ``tree, level,
    d, proof``: what is above each tree. Every node takes the proof of its parent and puts its own siblings before it.
    Trees of one leaf are not among them."""
    empty = tops.limit(0).select("tree", F.lit(0).cast("long").alias("i"), F.col("d").alias("subroot"), "proof")
    above = empty
    for k in range(len(levels) - 1, -1, -1):
        known = above.unionAll(tops.where(F.col("level") == k + 1).select(
            "tree", F.lit(0).cast("long").alias("i"), F.col("d").alias("subroot"), "proof"))
        known = known.select(F.col("tree").alias("tree_up"), F.col("i").alias("i_up"), "subroot", "proof")
        own = F.array(F.struct("left", "right"))
        joined = levels[k].join(known, (F.col("tree") == F.col("tree_up")) & (F.expr(f"i div {fanout}") == F.col("i_up")))
        above = joined.select("tree", "i", "subroot", F.concat(own, "proof").alias("proof"), *(keep if k == 0 else ()))
    return above


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda d, p: digest(p["left"], d, p["right"]))


def proof_text(proof: Column) -> Column:
    """All siblings from the leaf's level up, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def manifest(docs: DataFrame, fields: Sequence[str], group_col: str = "source", id_col: str = "doc_id",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """``id, leaf, subroot, root, proof`` per row, and the columns ``carry`` computed from the row.

    A leaf is the digest of ``fields`` (null and empty differ). Per value of ``group_col`` leaves ascend by id, null
    ids first; the order of rows that share an id follows their leaf, so repeated rows have neighbouring places.
    Groups ascend by their UTF-8 bytes, a null group first, and an empty one differs from it. ``proof`` is an array of
    (``left``, ``right``) digests from the leaf to the root; ``fold`` gives the root back. Columns that are not named are
    not read, and an empty table gives an empty table.
    """
    carry = carry or {}
    tree = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group_col).cast("string")))
    leaves = stored(docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf_digest(*[F.col(f"`{f}`") for f in fields]).alias("d"),
                                F.struct(F.lit(0).alias("_"), *[c.alias(k) for k, c in carry.items()]).alias("row")), "merkle-leaves")
    nodes = numbered(leaves, "tree", ["id", "d"])
    levels, tops = grow(nodes)
    tops = stored(tops, "merkle-tops")
    groups = numbered(tops.select(F.lit("").alias("all"), F.col("tree").alias("group"), "d"), "all", ["group"]).withColumnRenamed("all", "tree")
    up, root = grow(groups)
    root = root.first()  # one digest
    if root is None:
        return docs.limit(0).select(F.col(id_col).alias("id"), *[F.lit("").alias(c) for c in ("leaf", "subroot", "root")],
                                    F.array(F.struct(F.lit("").alias("left"), F.lit("").alias("right"))).alias("proof"),
                                    *[c.alias(k) for k, c in carry.items()])
    none = F.array().cast("array<struct<left:string,right:string>>")
    if up:
        crown = F.lit(root["d"]).alias("d")
        top = up[0].limit(0).select("tree", F.lit(len(up)).alias("level"), crown, none.alias("proof"))
        top = top.unionAll(docs.sparkSession.range(1).select(F.lit("").alias("tree"), F.lit(len(up)).alias("level"), crown, none.alias("proof")))
        over = proofs(up, top, ["group"]).select("group", "proof")
    else:
        over = groups.select("group", none.alias("proof"))
    tops = stored(tops.join(over, tops["tree"] == over["group"]).select("tree", "level", "d", "proof"), "merkle-tops")
    keep = ["id", "d", "row"]
    lone = nodes.where(F.col("n") == 1).join(tops.select("tree", "proof"), "tree").select(
        "tree", "i", F.col("d").alias("subroot"), "proof", *keep)
    rows = proofs(levels, tops, keep).unionAll(lone) if levels else lone
    return rows.select("id", F.col("d").alias("leaf"), "subroot", F.lit(root["d"]).alias("root"), "proof",
                       *[F.col(f"row.`{k}`").alias(k) for k in carry])
