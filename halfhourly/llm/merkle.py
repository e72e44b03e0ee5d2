"""Merkle manifest of a table by time-forward processing.

Every row is a leaf; the leaves of a tree (a language) ascend by doc_id, each run of FAN nodes
hashes to its parent, the trees' roots are the leaves of one last tree.  A node's label is (level,
index), so a node comes after its children, and digests travel forward in label order:

* **Between tasks** the priority queue is Spark's sorted shuffle, an external one: messages are
  dealt by (tree, block of ``FAN ** LEVELS`` nodes) and sorted by label, a round delivers LEVELS
  levels, and what leaves a round is one digest a block (a 4096th of the rows).
* **Within a block** a heap holds the messages that are under way: a node takes those that carry
  its label, and sends its own digest to its parent's label.
* **The reversed sweep** takes the labels backwards: a node that has its proof (the siblings of
  each level from there to the root) sends each child that child's siblings and its own proof.
  Only the blocks' proofs are written between rounds; proofs of leaves live in their task.

Leaves get their index without a sort in one task: they are dealt by range of (tree, doc_id, digest), numbered
in each range, and the counts of the ranges before are added.  A tree may hold any share of the rows.

Defined cases: null doc_ids come first, rows of one doc_id follow by digest, equal rows are leaves each; null
fields are ``-``; null language is a tree of its own, the first; a tree of one leaf has it as root; an empty
table gives an empty result; extra columns are not hashed.
"""

from __future__ import annotations

from hashlib import sha256
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halfhourly.llm.common import ascii_lower_col, materialize, sorted_groups

FAN, LEVELS = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree string, index long, digest string, nodes long"
_PATH = "tree string, index long, lefts array<string>, rights array<string>, subroot string, root string"


def digest_of(*texts: str) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def height(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one remains."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def sweep(digests: list[str], levels: int) -> dict[tuple[int, int], str]:
    """Time-forward: the digest of every node above (and of) a block's ``digests``, by label."""
    known = {(0, i): d for i, d in enumerate(digests)}
    queue = [(1, i // FAN, i, d) for i, d in enumerate(digests)] if levels else []
    heapify(queue)
    while queue:
        level, index = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, index):
            children.append(heappop(queue)[3])
        known[level, index] = digest = digest_of(*children)
        if level < levels:
            heappush(queue, (level + 1, index // FAN, index, digest))
    return known


def sweep_back(known: dict[tuple[int, int], str], levels: int, proof: tuple) -> list[tuple]:
    """Reversed: the proof of each node of the lowest level; a proof is (left siblings, right siblings, proof above)."""
    width = [0] * (levels + 1)
    for level, _ in known:
        width[level] += 1
    queue, found = [(-levels, 0, proof)], [()] * width[0]
    while queue:
        level, index, proof = heappop(queue)
        if level == 0:
            found[-index] = proof
            continue
        first = -index * FAN
        children = [known[-level - 1, i] for i in range(first, min(first + FAN, width[-level - 1]))]
        for k in range(len(children)):
            heappush(queue, (level + 1, -(first + k), ("".join(children[:k]), "".join(children[k + 1:]), proof)))
    return found


def unlink(proof: tuple) -> tuple[list[str], list[str]]:
    lefts, rights = [], []
    while proof:
        left, right, proof = proof
        lefts.append(left)
        rights.append(right)
    return lefts, rights


def fold(digest: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf's digest and its proof lead to."""
    for left, right in zip(lefts, rights):
        digest = digest_of(left, digest, right)
    return digest


def indexed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``index`` in the tree and ``nodes`` of the tree, for rows (tree, digest, *order) in that order."""
    ranged = materialize(nodes.withColumn("row", F.monotonically_increasing_id()), "nodes")
    order = [*order, "digest", "row"]
    ranged = materialize(ranged.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    all_parts = Window.partitionBy("tree")
    before = all_parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                         F.sum("n").over(all_parts).alias("nodes"))
    at = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    return ranged.withColumn("at", at).join(parts, ["tree", "part"]).withColumn(
        "index", F.col("before") + F.col("at") - 1).drop("part", "at", "before", "row")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Dealt by block, in label order: what a round's priority queue hands out."""
    block = F.floor(F.col("index") / FAN ** LEVELS)
    return nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "index")


def _climb(nodes: DataFrame) -> DataFrame:
    """The blocks' top nodes: the next round's nodes."""
    def run(it):
        for g in sorted_groups(it, ["tree", "block"]):
            n = int(g["nodes"][0])
            levels = min(LEVELS, height(n))
            top = sweep(list(g["digest"]), levels)[levels, 0]
            yield pd.DataFrame({"tree": g["tree"][:1], "index": g["block"][:1], "digest": [top],
                                "nodes": [-(-n // FAN ** levels)]})
    return _blocks(nodes.select("tree", "index", "digest", "nodes")).mapInPandas(run, _NODE)


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and what each round leaves, down to one node a tree."""
    out = [nodes]
    largest = nodes.agg(F.max("nodes")).first()[0] or 1
    for _ in range(max(-(-height(largest) // LEVELS), 1)):
        out.append(materialize(_climb(out[-1]), "climb"))
    return out


def _descend(nodes: DataFrame, paths: DataFrame, leaves, schema: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """A round backwards: ``paths`` are the proofs of its blocks' top nodes, ``leaves(group, proofs, subroot, root)`` its rows.
    A block's proof travels as the block's first row."""
    above = paths.select("tree", F.col("index").alias("block"), F.lit(-1).cast("long").alias("index"), "lefts", "rights",
                         "subroot", "root")
    own = nodes.select("tree", F.floor(F.col("index") / FAN ** LEVELS).alias("block"), "index", "digest", "nodes", *extra)
    rows = own.unionByName(above, allowMissingColumns=True).repartition("tree", "block").sortWithinPartitions(
        "tree", "block", "index")

    def run(it):
        for g in sorted_groups(it, ["tree", "block"]):
            proof: tuple = ()
            for left, right in zip(reversed(list(g["lefts"][0])), reversed(list(g["rights"][0]))):
                proof = (left, right, proof)
            below = {c: v[1:] for c, v in g.items()}
            levels = min(LEVELS, height(int(below["nodes"][0])))
            yield leaves(below, sweep_back(sweep(list(below["digest"]), levels), levels, proof), g["subroot"][0], g["root"][0])
    return rows.mapInPandas(run, schema)


def _paths(g: dict, proofs: list[tuple], subroot: str, root: str) -> pd.DataFrame:
    lefts, rights = zip(*map(unlink, proofs))
    return pd.DataFrame({"tree": g["tree"], "index": g["index"], "lefts": lefts, "rights": rights, "subroot": subroot, "root": root})


def proofs_below(levels: list[DataFrame], paths: DataFrame) -> DataFrame:
    """From the proofs of the last of ``rounds`` to those of the second."""
    for nodes in levels[-2:0:-1]:
        paths = materialize(_descend(nodes, paths, _paths, _PATH), "paths")
    return paths


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Each field as byte count, ``:``, value; ``-`` for null."""
    def field(c: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*(field(c.cast("string")) for c in fields.values())), 256)


def _verify(g: dict, proofs: list[tuple], subroot: str, root: str) -> pd.DataFrame:
    paths = [unlink(p) for p in proofs]
    folded = [fold(d, *p) for d, p in zip(g["checked"], paths)]
    return pd.DataFrame({
        "doc_id": pd.array([None if pd.isna(d) else int(d) for d in g["doc_id"]], "Int64"), "leaf": g["digest"],
        "subroot": subroot, "root": root,
        "proof_sha256": [digest_of(*(side for level in zip(*p) for side in level)) for p in paths],
        "folded_root": folded, "verified": [f == root for f in folded]})


def manifest(docs: DataFrame, checked_text: Column | None = None) -> DataFrame:
    """Per row its leaf, its tree's root, the root, the digest of its proof, and whether ``checked_text`` (the text, if
    None) with the other fields still leads to the root by that proof."""
    fields = {f: F.col(f) for f in FIELDS}
    leaf = leaf_digest(fields)
    checked = leaf if checked_text is None else leaf_digest({**fields, "text": checked_text})
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))  # null first, else bytewise
    leaves = docs.select(tree.alias("tree"), "doc_id", leaf.alias("digest"), checked.alias("checked"))
    leaves = materialize(indexed(leaves, ["doc_id"]), "leaves")
    own = rounds(leaves)
    subroots = own[-1].select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest")
    subroots = materialize(indexed(subroots, ["key"]), "subroots")
    top = rounds(subroots)
    no_siblings = F.array().cast("array<string>")
    first = top[-1].select("tree", "index", no_siblings.alias("lefts"), no_siblings.alias("rights"),
                           F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def to_trees(g, proofs, subroot, root):
        lefts, rights = zip(*map(unlink, proofs))
        return pd.DataFrame({"tree": g["key"], "index": 0, "lefts": lefts, "rights": rights, "subroot": g["digest"], "root": root})
    paths = materialize(_descend(subroots, proofs_below(top, first), to_trees, _PATH, ("key",)), "paths")
    return _descend(
        leaves, proofs_below(own, paths), _verify,
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        ("doc_id", "checked"))


def tampered(every: int = 3) -> Column:
    """The text with A-Z lower-cased where ``every`` divides crc32(decimal doc_id)."""
    hit = F.crc32(F.col("doc_id").cast("string")) % every == 0
    return F.when(hit, ascii_lower_col(F.col("text"))).otherwise(F.col("text"))
