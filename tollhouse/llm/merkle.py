"""Merkle dataset manifest by butterfly exchange.

Rows become leaves, in the order of (group, id). Leaves are dealt to partitions of ``fanout ** BLOCK_LEVELS`` that begin at
multiples of that number, so each partition holds one whole subtree of its group's tree. Partitions then exchange subtree
roots: in a round, the ``fanout`` neighbouring subtrees of one node meet member by member, the first member of each, the
second of each, and so on, and every member hashes the node for itself. After the rounds each partition holds the root
and all siblings above its own subtree, and nothing has to be handed down. A subtree with fewer members than its
neighbours (the last of a group, or a small group) sends its root to the members of the others in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import ranked, stored

FANOUT = 2
#: Levels that a partition hashes by itself: 1,024 leaves at a fanout of 2.
BLOCK_LEVELS = 10
#: Groups up to which their numbers are broadcast; beyond, they are joined by shuffling.
BROADCAST_GROUPS = 20_000


def framed(value: Column) -> Column:
    """A value so written that no two rows of values read alike: ``-`` if null, else its UTF-8 byte count, ``:``, itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the framed values."""
    return F.sha2(F.concat(*(framed(v) for v in values)).cast("binary"), 256)


def node_hash(children: bytes) -> bytes:
    """The hash of children's hex digests that stand one after another."""
    return hashlib.sha256(children).hexdigest().encode()


def subtree(leaves: list[bytes], fanout: int, levels: int) -> tuple[bytes, list[tuple[list[bytes], list[bytes]]]]:
    """The node ``levels`` above these leaves, and for each level what stands before and after each of its nodes."""
    beside, nodes = [], leaves
    for _ in range(levels):
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        before = [b"".join(run[:i]) for run in runs for i in range(len(run))]
        after = [b"".join(run[i + 1 :]) for run in runs for i in range(len(run))]
        beside.append((before, after))
        nodes = [node_hash(b"".join(run)) for run in runs]
    return nodes[0], beside


def _joined(left: DataFrame, groups: DataFrame, on, few: bool) -> DataFrame:
    return left.join(F.broadcast(groups) if few else groups, on)


def _levels(n: Column, fanout: int) -> Column:
    """Levels above ``n`` nodes until one remains."""
    return sum((n > fanout**k).cast("int") for k in range(63) if fanout**k < 1 << 62)


def _level_count(n: int, fanout: int) -> int:
    return next(k for k in range(64) if fanout**k >= n)


def _exchanged(state: DataFrame, parent: Column, slots: Column, own: Column, digit: Column, width: Column, active: Column) -> DataFrame:
    """One round: members of neighbouring subtrees that have the same slot meet, and each hashes their node.

    ``state`` has tree, block, member (of ``width`` in its subtree), node and the siblings before and after so far. After it
    member and width are those in the joint subtree; where ``active`` is false there is no neighbour and no level.
    """
    sent = state.select(
        "*", parent.alias("_parent"), digit.alias("_digit"), width.alias("_width"), active.alias("_active"), own.alias("_own"), F.explode(slots).alias("_slot")
    )
    mine = F.col("_own") == F.col("_slot")
    entry = F.struct(
        "_digit", "node", "_width", "_active", mine.alias("mine"),
        *(F.when(mine, F.col(c)).alias(c) for c in ("tree", "block", "blocks", "depth", "leaves", "member", "before", "after", "subroot")),
    )
    # of each subtree exactly one member has a slot: at most fanout entries meet
    met = sent.groupBy("_parent", "_slot").agg(F.array_sort(F.collect_list(entry)).alias("met"))
    met = met.withColumn("hash", F.sha2(F.array_join(F.transform("met", lambda x: x["node"]), "").cast("binary"), 256))
    member = met.select("met", "hash", F.explode(F.filter("met", lambda x: x["mine"])).alias("x"))
    x = F.col("x")

    def beside(side) -> Column:
        return F.array_join(F.transform(F.filter("met", side), lambda y: y["node"]), "")

    def add(level: Column, so_far: Column) -> Column:
        return F.when(x["_active"], F.concat(so_far, F.array(level))).otherwise(so_far)

    lower = F.aggregate(F.filter("met", lambda y: y["_digit"] < x["_digit"]), F.lit(0).cast("long"), lambda s, y: s + y["_width"])
    return member.select(
        *(x[c].alias(c) for c in ("tree", "block", "blocks", "depth", "leaves", "subroot")),
        (lower + x["member"]).alias("member"),
        F.when(x["_active"], F.col("hash")).otherwise(x["node"]).alias("node"),
        add(beside(lambda y: y["_digit"] < x["_digit"]), x["before"]).alias("before"),
        add(beside(lambda y: y["_digit"] > x["_digit"]), x["after"]).alias("after"),
    )


def _div(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("long") if n < 1 << 50 else F.lit(0).cast("long")


def _butterfly(blocks: DataFrame, groups: DataFrame, fanout: int, block_levels: int, most_leaves: int, n_groups: int) -> DataFrame:
    """(tree, block, depth, node: the root, subroot, before, after): each partition with the siblings above its subtree."""
    few = n_groups <= BROADCAST_GROUPS
    none = F.array().cast("array<string>")
    state = blocks.select("*", F.col("block").alias("member"), none.alias("before"), none.alias("after"), F.lit(None).cast("string").alias("subroot"))
    for r in range(max(_level_count(most_leaves, fanout) - block_levels, 0)):
        size = fanout**r
        here = _div(F.col("block"), size)
        parent = _div(F.col("block"), size * fanout)
        # members of a subtree that begins at block c * size
        members = F.least(F.lit(size), F.col("blocks") - here * size)
        widest = F.least(F.lit(size), F.col("blocks") - parent * size * fanout)
        at = F.col("block") - here * size
        active = F.col("depth") > block_levels + r
        slots = F.sequence(at, widest - 1, members)
        state = _exchanged(state, F.struct("tree", parent.alias("at")), slots, at, here - parent * fanout, members, active)
    # above the groups' roots: the subtrees are groups, of any number of partitions
    state = state.withColumn("subroot", F.col("node")).withColumn("member", F.col("block"))
    for r in range(_level_count(n_groups, fanout)):
        size = fanout**r
        children = groups.groupBy(_div(F.col("tree"), size).alias("_child")).agg(F.sum("blocks").alias("_members"))
        parents = children.groupBy(_div(F.col("_child"), fanout).alias("_above")).agg(F.max("_members").alias("_widest"), F.count(F.lit(1)).alias("_n"))
        state = _joined(state.withColumn("_child", _div(F.col("tree"), size)), children, "_child", few)
        state = _joined(state.withColumn("_above", _div(F.col("_child"), fanout)), parents, "_above", few)
        slots = F.sequence(F.col("member"), F.col("_widest") - 1, F.col("_members"))
        digit = F.col("_child") - F.col("_above") * fanout
        state = _exchanged(state, F.struct(F.lit(-1).cast("long").alias("tree"), F.col("_above").alias("at")), slots, F.col("member"), digit, F.col("_members"), F.lit(True))
    return state


_NODE = "tree long, block long, blocks long, depth int, leaves long, node string"


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group_col: str = "lang", id_col: str = "doc_id",
    fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS, carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, the group, leaf, subroot, root, and the proof as two arrays of strings, ``before`` and
    ``after``: for each level from the leaf up, the digests of the run that stand before and after the own one.

    Each group's leaves ascend by id (null first), rows of one id by their leaf hash; every ``fanout`` consecutive nodes, the
    last ones also if they are fewer, become the hash of their hex digests, while several remain. The subroots, ordered by
    group (null first, an empty one next, UTF-8 bytewise), become the root likewise. Null values have a mark of their own in
    the leaf. Repeated rows are leaves of their own; one row alone is its own root with an empty proof; no rows give no rows.
    ``carry``: further columns of the result, as expressions over ``docs``; other columns of ``docs`` are not read.
    """
    if fanout < 2 or block_levels < 1:
        raise ValueError("fanout is 2 or more, block_levels 1 or more")
    carry = dict(carry or {})
    extra = [f"_c{i}" for i in range(len(carry))]
    leaves = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("grp"), leaf_hash([F.col(c) for c in columns]).alias("leaf"),
        *(e.alias(n) for n, e in zip(extra, carry.values())),
    )
    kinds = [leaves.schema[n].dataType.simpleString() for n in extra]
    leaves = ranked(leaves, ["id", "leaf"], ["grp"], "place")
    span = fanout**block_levels
    counts = stored(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("leaves")))
    groups = ranked(counts, ["grp"], rank="tree").withColumn("depth", _levels(F.col("leaves"), fanout)).withColumn("blocks", _div(F.col("leaves") + span - 1, span))
    groups = stored(groups)
    most, n_groups = groups.agg(F.coalesce(F.max("leaves"), F.lit(0)), F.count(F.lit(1))).first()
    names = groups.select(F.col("grp").alias("_grp"), "tree", "depth", "blocks", "leaves")
    rows = _joined(leaves, names, leaves.grp.eqNullSafe(F.col("_grp")), n_groups <= BROADCAST_GROUPS).drop("_grp")
    rows = rows.withColumn("block", _div(F.col("place"), span))

    def sorted_leaves(table: pa.Table) -> pa.Table:
        return table.combine_chunks().sort_by("place")

    def top(table: pa.Table) -> pa.Table:
        table = sorted_leaves(table)
        first = table.slice(0, 1)
        depth = first["depth"][0].as_py()
        node, _ = subtree([x.encode() for x in table["leaf"].to_pylist()], fanout, min(depth, block_levels))
        cells = [first[c].combine_chunks() for c in ("tree", "block", "blocks", "depth", "leaves")]
        return pa.table([*cells, pa.array([node.decode()])], names=["tree", "block", "blocks", "depth", "leaves", "node"])

    # a group here is one aligned partition: span rows at most
    short = rows.select("tree", "block", "blocks", "depth", "leaves", "place", "leaf")
    blocks = short.groupBy("tree", "block").applyInArrow(top, _NODE)
    uppers = _butterfly(blocks, groups.select("tree", "blocks"), fanout, block_levels, most, n_groups)

    def levels_of(beside: list[list[bytes]], n: int, above: list[str]) -> pa.Array:
        """For each leaf, the entries of its ancestors level by level, and then those above the partition."""
        at = np.arange(n)
        parts, picks, base = [], [], 0
        for level, entries in enumerate(beside):
            parts.append(pa.array([x.decode() for x in entries], pa.string()))
            picks.append(base + at // fanout**level)
            base += len(entries)
        parts.append(pa.array(above, pa.string()))
        picks += [np.full(n, base + i) for i in range(len(above))]
        depth = len(picks)
        flat = pa.concat_arrays(parts).take(pa.array(np.stack(picks, axis=1).ravel())) if depth else pa.array([], pa.string())
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * depth, pa.int32()), flat)

    def proofs(table: pa.Table, upper: pa.Table) -> pa.Table:
        table = sorted_leaves(table)
        n, depth = len(table), table["depth"][0].as_py()
        _, beside = subtree([x.encode() for x in table["leaf"].to_pylist()], fanout, min(depth, block_levels))
        root, subroot, before, after = (upper[c][0].as_py() for c in ("node", "subroot", "before", "after"))
        out = [*(table[c] for c in ("id", "grp", "leaf")), pa.array([subroot] * n), pa.array([root] * n)]
        out += [levels_of([b for b, _ in beside], n, before), levels_of([a for _, a in beside], n, after), *(table[c] for c in extra)]
        return pa.table(out, names=["id", "grp", "leaf", "subroot", "root", "before", "after", *extra])

    ddl = "id long, grp string, leaf string, subroot string, root string, before array<string>, after array<string>"
    ddl += "".join(f", {n} {k}" for n, k in zip(extra, kinds))
    own = rows.select("tree", "block", "depth", "place", "id", "grp", "leaf", *extra).groupBy("tree", "block")
    found = own.cogroup(uppers.select("tree", "block", "node", "subroot", "before", "after").groupBy("tree", "block")).applyInArrow(proofs, ddl)
    return found.select(F.col("id").alias(id_col), F.col("grp").alias(group_col), "leaf", "subroot", "root", "before", "after", *(F.col(n).alias(c) for n, c in zip(extra, carry)))


def proof_hash(before: str = "before", after: str = "after") -> Column:
    """SHA-256 of a proof's siblings, level by level, left to right."""
    sides = F.transform(F.arrays_zip(F.col(before).alias("b"), F.col(after).alias("a")), lambda x: F.concat(x["b"], x["a"]))
    return F.sha2(F.array_join(sides, "").cast("binary"), 256)


def folded(leaf: Column, before: str = "before", after: str = "after") -> Column:
    """The root that a leaf and a proof lead to."""
    levels = F.arrays_zip(F.col(before).alias("b"), F.col(after).alias("a"))
    return F.aggregate(levels, leaf, lambda node, x: F.sha2(F.concat(x["b"], node, x["a"]).cast("binary"), 256))

