"""Merkle manifest of a dataset, by exchange of subtrees.

Every row is a leaf, and the leaves of a group, in order of their ids, are the bottom of a tree in which runs of
``FAN`` nodes become one. The trees' roots, in order of their groups, are the bottom of a last tree. Leaves are dealt in
superblocks of ``FAN ** LEVELS`` neighbours. A first pass reduces each to its top node, and the tops, a few thousandths
of the rows, grow the rest of the trees in the same way. Then the leaves and those outer nodes that their proofs need
are cogrouped by superblock: one task reduces its leaves again, joins inner and outer siblings to proofs, and folds
every leaf up to the root. No task sees more than a superblock, whatever the size of a group.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.session import stored
from surveyloom.sources.ids import ordered_index

FAN_BITS = 3
FAN = 1 << FAN_BITS
LEVELS = 4
#: Characters of a digest.
HEX = 64


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else its length in bytes, ``:`` and its value."""
    values = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves until one node remains."""
    return F.when(n <= 1, 0).otherwise(F.floor((F.length(F.bin(n - 1)) + FAN_BITS - 1) / FAN_BITS)).cast("int")


def levels(nodes: list[bytes], count: int) -> list[list[bytes]]:
    """The runs of each of the lowest ``count`` levels, joined, and last the single run of what is left."""
    out = []
    for _ in range(count):
        out.append([b"".join(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [digest(run) for run in out[-1]]
    return [*out, [b"".join(nodes)]]


def _top(most: int):
    """The top node of a superblock of ``most`` levels."""

    def work(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        last = levels([x.encode() for x in block["node"]], min(most, int(block["depth"].iloc[0])))[-1][0]
        return pd.DataFrame({"tree": block["tree"].iloc[:1], "depth": block["depth"].iloc[:1], "idx": block["block"].iloc[:1], "node": [last.decode()]})

    return work


def _nodes(start: int, most: int):
    """All nodes of a superblock of ``most`` levels whose lowest is ``start``."""

    def work(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        tree, depth, first = (int(block[c].iloc[0]) for c in ("tree", "depth", "idx"))
        rows = []
        for k, runs in enumerate(levels([x.encode() for x in block["node"]], min(most, depth - start))):
            joined = b"".join(runs).decode()
            rows += [(tree, depth, start + k, (first >> FAN_BITS * k) + i, joined[HEX * i : HEX * (i + 1)]) for i in range(len(joined) // HEX)]
        return pd.DataFrame(rows, columns=["tree", "depth", "level", "idx", "node"])

    return work


def _grow(bottom: DataFrame, start: int, deepest: int) -> DataFrame:
    """Nodes (tree, depth, level, idx, node) of all levels from ``bottom`` up, which holds level ``start``."""
    schema = "tree long, depth int, level int, idx long, node string"
    found = [bottom.withColumn("level", F.lit(start)).select("tree", "depth", "level", "idx", "node")]
    while start < deepest:
        blocks = bottom.where(F.col("depth") > start).groupBy("tree", F.shiftright("idx", FAN_BITS * LEVELS).alias("block"))
        grown = stored(blocks.applyInPandas(_nodes(start, LEVELS), schema), "manifest-nodes").where(F.col("level") > start)
        found.append(grown)
        start += LEVELS
        bottom = grown.where(F.col("level") == start).drop("level")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _siblings(blocks: DataFrame, nodes: DataFrame, kind: int, start: int) -> DataFrame:
    """The other nodes of each run on the way up from ``own`` (of level ``start`` of ``tree``): tree, block, kind, level, place, size, rest."""
    ways = blocks.withColumn("level", F.explode(F.expr(f"if(depth > {start}, sequence({start}, depth - 1), array())")))
    ways = ways.withColumn("at", F.expr(f"shiftright(own, {FAN_BITS} * (level - {start}))")).withColumn("run", F.shiftright("at", FAN_BITS))
    runs = nodes.groupBy("tree", "level", F.shiftright("idx", FAN_BITS).alias("run")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "node"))), lambda x: x["node"]), "").alias("nodes")
    ).withColumnRenamed("tree", "of")
    place = F.col("at").bitwiseAND(FAN - 1).cast("int")
    joined = ways.join(runs, (ways["in_tree"] == runs["of"]) & (ways["level"] == runs["level"]) & (ways["run"] == runs["run"]))
    rest = F.concat(F.substring("nodes", F.lit(1), place * HEX), F.substring("nodes", (place + 1) * HEX + 1, F.length("nodes")))
    return joined.select(ways["tree"], "block", F.lit(kind).alias("kind"), ways["level"], place.alias("place"), rest.alias("rest"))


def _fold(node: bytes, place: int, rest: bytes) -> bytes:
    return digest(rest[: HEX * place] + node + rest[HEX * place :])


def _prove(most: int):
    """Proof and folded root of each leaf of a superblock, from its leaves and its outer siblings."""

    def work(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves, outer = leaves.sort_values("pos"), outer.sort_values(["kind", "level"])
        nodes = [x.encode() for x in leaves["node"]]
        *inner, last = levels(nodes, min(most, int(leaves["depth"].iloc[0])))
        above = [(int(k), int(p), r.encode()) for k, p, r in zip(outer["kind"], outer["place"], outer["rest"], strict=True)]
        subroot = last[0]
        for kind, place, rest in above:
            if kind == 0:
                subroot = _fold(subroot, place, rest)
        root = subroot
        for kind, place, rest in above:
            if kind == 1:
                root = _fold(root, place, rest)
        outer_places, outer_sizes, outer_rest = [p for _, p, _ in above], [len(r) // HEX + 1 for _, _, r in above], b"".join(r for _, _, r in above)
        proofs, places, sizes, folded = [], [], [], []
        for i, shown in enumerate(leaves["shown"]):
            node, parts, own = shown.encode(), [], []
            at = i
            for runs in inner:
                run, place = runs[at >> FAN_BITS], at & FAN - 1
                parts.append(rest := run[: HEX * place] + run[HEX * (place + 1) :])
                own.append((place, len(run) // HEX))
                node = _fold(node, place, rest)
                at >>= FAN_BITS
            for _, place, rest in above:
                node = _fold(node, place, rest)
            proofs.append((b"".join(parts) + outer_rest).decode())
            places.append([p for p, _ in own] + outer_places)
            sizes.append([s for _, s in own] + outer_sizes)
            folded.append(node.decode())
        return pd.DataFrame({
            "id": leaves["id"], "leaf": leaves["node"], "subroot": subroot.decode(), "root": root.decode(),
            "proof": proofs, "places": places, "sizes": sizes, "folded_root": folded,
        })

    return work


def manifest(docs: DataFrame, leaf: Column, shown: Column | None = None, group_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: its id, ``leaf``, ``subroot``, ``root``, ``proof``, ``places``, ``sizes``, ``folded_root``.

    ``leaf`` is the digest of a row (64 hexadecimal digits), ``shown`` that of the row as someone presents it (``leaf``
    if null or left out). ``proof`` joins the siblings' digests, level by level up to the root, each from left to right;
    ``places`` and ``sizes`` have, per level, the node's place in its run and the run's size. ``folded_root`` is what
    ``shown`` gives with that proof, so the row is as it was if that equals ``root``. A group's leaves ascend by id (null
    first), rows that repeat an id by their leaf; every row is a leaf, repeated ones too. Groups ascend by their bytes,
    null first. A single leaf is its group's subroot, and a single subroot the root; their proofs lack that level. An
    empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf.alias("node"), F.coalesce(leaf if shown is None else shown, leaf).alias("shown"))
    # The number of the row cuts ties, so that a range may end between rows that repeat.
    rows = stored(rows.withColumn("spot", F.monotonically_increasing_id()), "manifest-leaves")
    ranked = ordered_index(rows, ["grp", "id", "node", "spot"], "at").drop("spot")
    trees = ranked.groupBy("grp").agg(F.min("at").alias("tree"), F.count("*").alias("n")).withColumn("depth", _depth(F.col("n")))
    trees = stored(ordered_index(trees.drop("n"), ["tree"], "rank").withColumnRenamed("grp", "of"), "manifest-trees")
    sizes = trees.agg(F.count("*").alias("trees"), F.max("depth").alias("depth")).first()
    forest_depth = max(0, (sizes.trees - 1).bit_length() + FAN_BITS - 1) // FAN_BITS

    placed = ranked.join(trees, ranked["grp"].eqNullSafe(trees["of"])).withColumn("pos", F.col("at") - F.col("tree"))
    # As text, since pandas would read integers beside a null as floats.
    placed = placed.select(F.col("id").cast("string").alias("id"), "node", "shown", "tree", "depth", "pos", F.shiftright("pos", FAN_BITS * LEVELS).alias("block"))
    tops = placed.groupBy("tree", "block").applyInPandas(_top(LEVELS), "tree long, depth int, idx long, node string")
    tops = stored(tops, "manifest-tops")
    nodes = _grow(tops, LEVELS, sizes.depth or 0)
    # A tree of few levels ends inside its only superblock, whose top is its root.
    roots = nodes.where(F.col("level") == F.greatest(F.col("depth"), F.lit(LEVELS))).select("tree", "node")
    bottom = trees.select("tree", F.col("rank").alias("idx")).join(roots, "tree").select(F.lit(0).cast("long").alias("tree"), F.lit(forest_depth).alias("depth"), "idx", "node")
    above = _grow(stored(bottom, "manifest-subroots"), 0, forest_depth)

    blocks = tops.select("tree", F.col("idx").alias("block"), "depth", F.col("idx").alias("own"), F.col("tree").alias("in_tree"))
    ranks = trees.select(F.col("tree").alias("ranked"), F.col("rank").alias("own"))
    last = blocks.drop("own").join(ranks, F.col("tree") == F.col("ranked")).select("tree", "block", F.lit(forest_depth).alias("depth"), "own", F.lit(0).cast("long").alias("in_tree"))
    outer = stored(_siblings(blocks, nodes, 0, LEVELS).unionByName(_siblings(last, above, 1, 0)), "manifest-siblings")
    schema = "id string, leaf string, subroot string, root string, proof string, places array<int>, sizes array<int>, folded_root string"
    proved = placed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(_prove(LEVELS), schema)
    return proved.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
