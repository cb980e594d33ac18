"""Merkle manifest of a dataset: every row a leaf, a tree per group, the groups' roots under one root.

Each aligned block of a level is kept as one string of concatenated hexadecimal digests: fixed-width substrings of it are
hashed to the level above, those that flank a node's path are its sibling segments, and the roots of the blocks are the
nodes of the next round. Column expressions and joins alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import NULL_ID, id_out
from shelfmark.operators.lanes import numbered
from shelfmark.session import stage

#: Levels of a block: 2**BITS nodes, so a block's strings take 128 KB and every round has a 1024th of the nodes.
BITS = 10
#: Characters of a digest.
WIDTH = 64
#: Rows sorted in one task when leaves are numbered.
ROWS_PER_RANGE = 100_000


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value; integers are decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _parents(level: Column) -> Column:
    """The level above: digests of every two consecutive ones, the last run may have one."""
    pairs = F.sequence(F.lit(0), ((F.length(level) - 1) / (2 * WIDTH)).cast("int"))
    return F.array_join(F.transform(pairs, lambda i: F.sha2(F.substring(level, i * (2 * WIDTH) + 1, F.lit(2 * WIDTH)), 256)),
                        "").cast("binary")


def _up_to(n: Column) -> Column:
    """0 to n - 1, nothing for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def _blocks(nodes: DataFrame, carried: Sequence[str]) -> DataFrame:
    """tree, block, n, members, levels of nodes (tree, idx, node, n and what is carried); n nodes has the tree's level."""
    members = F.array_sort(F.collect_list(F.struct("idx", "node", *carried)))    # at most 2**BITS of them
    out = nodes.groupBy("tree", F.shiftright("idx", BITS).alias("block")).agg(members.alias("members"), F.max("n").alias("n"))
    whole = F.array_join(F.transform("members", lambda m: m.node), "").cast("binary")
    height = F.least(F.lit(BITS), F.ceil(F.log2(F.col("n").cast("double"))).cast("int"))
    steps = _up_to(height)
    return out.withColumn("levels", F.aggregate(
        steps, F.array(whole), lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1))))))


def _members(blocks: DataFrame, carried: Sequence[str], above: Sequence[str]) -> DataFrame:
    """The nodes of blocks, ``siblings`` from their own level up to the root of the tree, with the columns ``above``."""
    def siblings(m: Column) -> Column:
        at = m.idx.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
        return F.transform(_up_to(F.size("levels") - 1), lambda k: F.substring(
            F.get(F.col("levels"), k), F.call_function("shiftright", at, k).bitwiseXOR(F.lit(1)) * WIDTH + 1, F.lit(WIDTH)).cast("string"))

    each = F.transform("members", lambda m: F.struct(m.alias("m"), siblings(m).alias("siblings")))
    out = blocks.select("tree", *above, F.col("siblings").alias("upper"), F.explode(each).alias("e"))
    return out.select("tree", *above, *[F.col("e.m")[c].alias(c) for c in ("idx", "node", *carried)],
                      F.concat("e.siblings", "upper").alias("siblings"))


def _same_tree(a: DataFrame, b: DataFrame) -> Column:
    return a["tree"].eqNullSafe(b["tree"])


class Trees:
    """Trees over numbered nodes: ``roots`` (tree, root) at once, the members' sibling segments by ``paths``."""

    def __init__(self, nodes: DataFrame, carried: Sequence[str] = ()):
        self.carried = list(carried)
        counts = nodes.groupBy("tree").agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        rows = nodes.join(counts.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
        self.rounds: list[DataFrame] = []
        while True:
            blocks = stage(_blocks(rows, [] if self.rounds else self.carried), "merkle")
            self.rounds.append(blocks)
            rows = blocks.select("tree", F.col("block").alias("idx"), F.element_at("levels", -1).cast("string").alias("node"),
                                 F.ceil(F.col("n") / F.lit(1 << BITS)).cast("long").alias("n"))
            most = -(-most >> BITS)
            if most <= 1:
                break
        self.roots = rows.select("tree", F.col("node").alias("root"))

    def paths(self, given: DataFrame) -> DataFrame:
        """tree, idx, node, what was carried, siblings, and the columns that ``given`` has for each tree."""
        above = [c for c in given.columns if c != "tree"]
        upper = given.withColumns({"idx": F.lit(0).cast("long"), "siblings": F.array().cast("array<string>")})
        for k in reversed(range(len(self.rounds))):
            upper = upper.select(F.col("tree").alias("_tree"), F.col("idx").alias("block"), "siblings", *above)
            blocks = self.rounds[k].join(upper, "block").where(F.col("tree").eqNullSafe(F.col("_tree")))
            upper = _members(blocks, [] if k else self.carried, above)
        return upper


def fold(node: Column, idx: Column, siblings: Column) -> Column:
    """The root that a node gives with the siblings of its path: '' where it has none at a level."""
    start = F.struct(node.alias("node"), idx.cast("long").alias("idx"))

    def step(at: Column, s: Column) -> Column:
        both = F.when(at.idx.bitwiseAND(F.lit(1).cast("long")) == 0, F.concat(at.node, s)).otherwise(F.concat(s, at.node))
        return F.struct(F.sha2(both, 256).alias("node"), F.shiftright(at.idx, 1).alias("idx"))

    return F.aggregate(siblings, start, step, lambda at: at.node)


def manifest(docs: DataFrame, columns: Sequence[str], group: str, id_col: str = "doc_id", *,
             claimed: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, group_value, leaf, idx, siblings, group_idx, group_siblings, subroot, root, claimed_leaf of every row.

    A leaf is the SHA-256 of the row's ``columns`` (see ``field``). The leaves of a value of ``group`` ascend by id, null
    ids first, rows of one id by leaf; every two consecutive nodes become the digest of both, a lone last one its own
    digest, until one is left, the subroot. The subroots, ordered by group value (null first, by UTF-8 bytes), give the
    root the same way. ``siblings`` holds the sibling at every level, '' where a node has none. ``claimed`` gives other
    values of some columns, as a verifier may find them; claimed_leaf is the leaf with those.
    Repeated rows are leaves of their own, an empty table gives no rows, other columns are not read.

    The table is read once; from then on only digests move. A group of any size is numbered in ranges and hashed in
    blocks of 2**BITS nodes, and the path of a block is joined to it, not to its leaves.
    """
    claimed = claimed or {}
    hashed = stage(docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(group).cast("string").alias("tree"),
        leaf([F.col(c) for c in columns]).alias("node"),
        leaf([claimed.get(c, F.col(c)) for c in columns]).alias("claimed_leaf")), "leaves")
    ranges = max(1, -(-hashed.count() // ROWS_PER_RANGE))
    leaves = numbered(hashed, ["doc_id", "node", "claimed_leaf"], ["tree"], "rn", ranges)
    trees = Trees(leaves.select("doc_id", "tree", "node", "claimed_leaf", (F.col("rn") - 1).alias("idx")), ["doc_id", "claimed_leaf"])
    subroots = numbered(trees.roots.withColumnRenamed("tree", "grp"), ["grp"], (), "rn")
    top = Trees(subroots.select(F.lit(0).alias("tree"), (F.col("rn") - 1).alias("idx"), F.col("root").alias("node"), "grp"), ["grp"])
    given = top.paths(top.roots).select(F.col("grp").alias("tree"), "root", F.col("node").alias("subroot"),
                                        F.col("idx").alias("group_idx"), F.col("siblings").alias("group_siblings"))
    return trees.paths(given).select(
        id_out(), F.col("tree").alias("group_value"), F.col("node").alias("leaf"), "idx", "siblings", "group_idx",
        "group_siblings", "subroot", "root", "claimed_leaf")


def verified(proofs: DataFrame) -> DataFrame:
    """With proof_sha256, folded_root and verified: the claimed leaf folded with the row's siblings up to the root."""
    sub = fold(F.col("claimed_leaf"), F.col("idx"), F.col("siblings"))
    out = proofs.withColumn("proof_sha256", F.sha2(F.array_join(F.concat("siblings", "group_siblings"), ""), 256))
    out = out.withColumn("folded_root", fold(sub, F.col("group_idx"), F.col("group_siblings")))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
