"""Merkle manifest of a dataset, with persistent versions made by path copying.

Every row is a leaf. Per group the leaves stand in order, and every two consecutive nodes
become the digest of their two hex digests (a last one without a neighbour becomes the digest
of itself alone) until one remains, the group's subroot. Subroots in the order of
their groups give the root in the same way.

The tree is cut into aligned blocks of ``BLOCK`` nodes, so a block is a whole subtree and one
task makes its eight levels; the tops of the blocks are the nodes of the next layer, and
so on. On the way back each block gets the upper part of its path from the layer above, by
a join on the block's own number, so a hot group is as many rows as it has blocks.

A changed leaf makes a version: its ancestors inside the block are copied, the copy goes on
through the upper layers along the path the block was given, and all other nodes are
shared with the first version. ``versions`` returns the copied nodes alone; a node
of a version is its copy where there is one, else the node of ``base_nodes``.

Defined cases: a null value counts as ``-``; a null group is a group of its own, before all
others; rows with equal keys stand in the order of their leaves (equal leaves are
interchangeable); a null id is never tampered with; the largest 64-bit length becomes
null when one is added. A text of any length is one value. A table without rows has no
leaves and no root. Only the named columns are read, so others may be called anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType

from assaymill.llm.common import small_batches, stored

BLOCK = 256
LEVELS = BLOCK.bit_length() - 1
ALONE = "-"  # a step of a path at which the node has no neighbour


class Tree(NamedTuple):
    """``layers[0]`` holds the leaves; each layer is (key, block, n, nodes), ``tops`` is (key, digest)."""

    layers: list[DataFrame]
    tops: DataFrame


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256)


def parent(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def subtree(digests: list[str], whole: bool) -> list[list[str]]:
    """The levels above some nodes; all ``LEVELS`` of them where other blocks stand beside this one."""
    levels = [digests]
    while len(levels) <= LEVELS if whole else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([parent(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def path(levels: list[list[str]], index: int) -> list[str]:
    """The neighbours on the way up: ``L`` or ``R`` (the side on which it stands) and the digest, or ``ALONE``."""
    steps = []
    for level in levels[:-1]:
        beside = index ^ 1
        steps.append(("L" if beside < index else "R") + level[beside] if beside < len(level) else ALONE)
        index >>= 1
    return steps


def copies(digest: str, steps: Sequence[str]) -> list[str]:
    """The ancestors of a node, first to last, when it is ``digest`` and its neighbours are ``steps``."""
    made = []
    for step in steps:
        if step == ALONE:
            digest = parent(digest)
        elif step[0] == "L":
            digest = parent(step[1:], digest)
        else:
            digest = parent(digest, step[1:])
        made.append(digest)
    return made


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with ``key``) and ``pos``, ``n``: the place within the key, from 0, and the key's number of rows.

    Rows are dealt into sorted slices and written once; counts per slice and key, at most a row for each
    slice and each key more, give where a slice begins.
    """
    by = ["key", *order]
    cut = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in by]).sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in by])
    cut = stored(cut.select("*", F.monotonically_increasing_id().alias("_at"), F.spark_partition_id().alias("_slice")), "slices")
    along = Window.partitionBy("key")
    counts = cut.groupBy("key", "_slice").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    starts = counts.select("key", "_slice", (F.sum("_rows").over(along.orderBy("_slice")) - F.col("_rows") - F.col("_first")).alias("_shift"),
                           F.sum("_rows").over(along).alias("n"))
    return cut.join(starts, ["key", "_slice"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_slice")


def _mapped(blocks: DataFrame, make: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    """Rows made from each block by ``make``, one block at a time, so that a few blocks bound what a task holds."""
    small_batches(blocks.sparkSession)
    target = to_arrow_schema(DataType.fromDDL(schema))

    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in target], schema=target)

    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                rows += make({name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)})
                if len(rows) >= 4 * BLOCK:
                    yield packed(rows)
                    rows = []
        yield packed(rows)

    return blocks.mapInArrow(run, schema)


def _tops(row: dict) -> list[dict]:
    levels = subtree([x["digest"] for x in row["nodes"]], row["n"] > BLOCK)
    return [{"key": row["key"], "pos": row["block"], "n": -(-row["n"] // BLOCK), "digest": levels[-1][0]}]


def build(leaves: DataFrame, carry: Sequence[str] = ()) -> Tree:
    """The layers over ``leaves`` (key, pos, n, digest and the columns to carry)."""
    layers, nodes, kept = [], leaves, ["digest", *carry]
    while True:
        block = F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block")
        sorted_nodes = F.array_sort(F.collect_list(F.struct("pos", *kept))).alias("nodes")
        layers.append(stored(nodes.groupBy("key", block).agg(F.max("n").alias("n"), sorted_nodes), "layer"))
        nodes = stored(_mapped(layers[-1].select("key", "block", "n", "nodes"), _tops,
                               "key string, pos bigint, n bigint, digest string"), "tops")
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return Tree(layers, nodes.select("key", "digest"))
        kept = ["digest"]


def _steps(row: dict) -> list[dict]:
    levels = subtree([x["digest"] for x in row["nodes"]], row["n"] > BLOCK)
    return [{"key": row["key"], "block": x["pos"], "steps": path(levels, i) + row["steps"],
             "subroot": row["subroot"], "root": row["root"]} for i, x in enumerate(row["nodes"])]


_ABOVE = "key string, block bigint, steps array<string>, subroot string, root string"


def _leaf_blocks(tree: Tree, above: DataFrame) -> DataFrame:
    """The blocks of the leaves, each with the path from its top to the root."""
    for layer in tree.layers[:0:-1]:
        above = stored(_mapped(layer.join(above, ["key", "block"]), _steps, _ABOVE), "paths")
    return tree.layers[0].join(above, ["key", "block"])


class Manifest(NamedTuple):
    """The trees of the groups, the tree over their subroots, and the leaf blocks with their paths."""

    groups: Tree
    upper: Tree
    blocks: DataFrame


def manifest(leaves: DataFrame, order: Sequence[str], carry: Sequence[str] = ()) -> Manifest:
    """The whole tree over ``leaves``: (key, digest) and the columns to order by and to carry.

    ``key`` is null or a text; keys stand in the order of their UTF-8 bytes, null first.
    """
    named = leaves.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("key")), F.lit("")))  # null apart from empty
    groups = build(placed(named, [*order, "digest"]), carry)
    top = placed(groups.tops.select(F.lit("").alias("key"), F.col("key").alias("of"), "digest"), ["of"])
    upper = build(top, ["of"])
    root = upper.tops.select("key", F.col("digest").alias("root"))
    whole = root.select("key", F.lit(0).cast("bigint").alias("block"), F.array().cast("array<string>").alias("steps"),
                        F.lit(None).cast("string").alias("subroot"), "root")

    def paths(row: dict) -> list[dict]:
        return [{**made, "key": x["of"], "block": 0, "subroot": x["digest"]} for made, x in zip(_steps(row), row["nodes"])]

    above = stored(_mapped(_leaf_blocks(upper, whole), paths, _ABOVE), "subroot-paths")
    return Manifest(groups, upper, _leaf_blocks(groups, above))


def proofs(made: Manifest, keep: str, digest: str = "digest") -> DataFrame:
    """For each leaf ``keep`` (a declaration of carried columns), its digest, steps, subroot, root and ``folded``:
    the root that the leaf ``digest`` (null: the leaf as it is) gives with its original neighbours."""
    names = [part.split()[0] for part in keep.split(", ")]

    def run(row: dict) -> list[dict]:
        levels, out = subtree([x["digest"] for x in row["nodes"]], row["n"] > BLOCK), []
        for i, x in enumerate(row["nodes"]):
            steps = path(levels, i) + row["steps"]
            folded = [x["digest"] if x[digest] is None else x[digest]]
            folded += copies(folded[0], steps)
            out.append({**{c: x[c] for c in names}, "leaf": x["digest"], "steps": steps, "subroot": row["subroot"],
                        "root": row["root"], "folded": folded[-1]})
        return out

    return _mapped(made.blocks, run, f"{keep}, leaf string, steps array<string>, subroot string, root string, folded string")


def versions(made: Manifest, changed: str) -> DataFrame:
    """The copied nodes of the version that each leaf with a digest in ``changed`` makes.

    (key, leaf, height, pos, digest): the version is the one of the group's leaf number ``leaf``, height 0 is that
    leaf, and ``pos`` numbers the nodes of a height within the group. Above the subroot heights
    go on; key is then still the group's, pos is -1. The last height is the version's root.
    """
    def run(row: dict) -> list[dict]:
        levels, out = subtree([x["digest"] for x in row["nodes"]], row["n"] > BLOCK), []
        inside = max(row["n"] - 1, 0).bit_length()  # heights of the group's own tree
        for i, x in enumerate(row["nodes"]):
            if x[changed] is not None:
                nodes = [x[changed], *copies(x[changed], path(levels, i) + row["steps"])]
                out += [{"key": row["key"], "leaf": x["pos"], "height": h, "pos": x["pos"] >> h if h <= inside else -1, "digest": d}
                        for h, d in enumerate(nodes)]
        return out

    found = _mapped(made.blocks, run, "key string, leaf bigint, height int, pos bigint, digest string")
    return found.withColumn("key", F.when(F.col("key") != "", F.substr("key", F.lit(2))))


def base_nodes(made: Manifest) -> DataFrame:
    """All nodes of the groups' trees as they were first: (key, height, pos, digest)."""
    def nodes_of(base: int):
        def run(row: dict) -> list[dict]:
            levels = subtree([x["digest"] for x in row["nodes"]], row["n"] > BLOCK)
            first = row["block"] * BLOCK
            return [{"key": row["key"], "height": base + h, "pos": (first >> h) + i, "digest": d}
                    for h, level in enumerate(levels[:-1] if row["n"] > BLOCK else levels) for i, d in enumerate(level)]
        return run

    parts = []
    for k, layer in enumerate(made.groups.layers):
        mine = layer if k == 0 else layer.where("n > 1")  # a finished group is passed through upper layers unchanged
        parts.append(_mapped(mine, nodes_of(k * LEVELS), "key string, height int, pos bigint, digest string"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("key", F.when(F.col("key") != "", F.substr("key", F.lit(2))))


TAMPERED_EVERY = 7


def dataset_manifest(docs: DataFrame) -> Manifest:
    """The manifest of a documents table; ``tampered`` is the leaf after one is added to n_chars, where the id says so."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    grown = [F.try_add(F.col("n_chars"), F.lit(1).cast(docs.schema["n_chars"].dataType)) if c == "n_chars" else F.col(c)
             for c in ("doc_id", "source", "lang", "n_chars", "text")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0
    leaves = docs.select(F.col("lang").cast("string").alias("key"), "doc_id", leaf_digest(fields).alias("digest"),
                         F.when(chosen, leaf_digest(grown)).alias("tampered"))
    return manifest(leaves, ["doc_id"], ["doc_id", "tampered"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, proof, and whether its (in part tampered) row verifies."""
    kind = dict(docs.dtypes)["doc_id"]
    found = proofs(dataset_manifest(docs), f"doc_id {kind}", "tampered")
    siblings = F.transform(F.filter("steps", lambda s: s != ALONE), lambda s: F.substr(s, F.lit(2)))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, "").cast("binary"), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
