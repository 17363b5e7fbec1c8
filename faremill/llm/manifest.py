"""A Merkle manifest of a dataset: per-language trees of row digests, joined under one root.

Leaves are put in order over all tasks and numbered, then cut into superblocks of `width`
consecutive leaves. A superblock's subtree is reduced by itself to one node; the nodes of a
language form the next, far shorter list, which is cut in the same way until a list fits one
superblock. On the way down each superblock is cogrouped with the nodes that its leaves need
from outside (the siblings between the superblock's own node and the dataset's root); the
function that gets both finishes the reduction inside, joins the proofs and folds the
presented leaves up to the root. No task ever holds more than a superblock.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.storage import discard, written

# The fields of a leaf in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree string, pos long, n long, digest string"
PROOF = "siblings string, sides string, subroot string, root string"
LEAVES = f"doc_id string, leaf string, {PROOF}, folded_root string, verified boolean"


def names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


@dataclass(frozen=True)
class Manifest:
    """levels: levels of a superblock's subtree, which has 2^levels leaves at most."""

    levels: int = 12

    def __post_init__(self):
        if not 1 <= self.levels <= 20:
            raise ValueError(f"a superblock of 2^{self.levels} leaves")

    @property
    def width(self) -> int:
        return 1 << self.levels


def digest(columns: Mapping[str, Column]) -> Column:
    """A leaf: each field as its UTF-8 byte count, a colon and its value; `-` for null."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# --- inside a superblock ---------------------------------------------------------


def join(left: str, right: str = "") -> str:
    return sha256((left + right).encode()).hexdigest()


def subtree(digests: list[str], n: int, levels: int) -> list[list[str]]:
    """The levels of a superblock's subtree, its leaves first.

    n: nodes of the whole list. Levels end where the whole list has one node left, so a
    superblock that is its list's last of several goes on with its single node.
    """
    out = [digests]
    for _ in range(levels):
        if n == 1:
            break
        below = out[-1]
        out.append([join(*below[i : i + 2]) for i in range(0, len(below), 2)])
        n = (n + 1) // 2
    return out


def path(tree: list[list[str]], at: int) -> tuple[str, str]:
    """Siblings of a leaf from below to the superblock's node, and where each stands:
    `l` left, `r` right, `-` there is none."""
    siblings, sides = [], []
    for nodes in tree[:-1]:
        other = at ^ 1
        if other < len(nodes):
            siblings.append(nodes[other])
            sides.append("l" if other < at else "r")
        else:
            sides.append("-")
        at //= 2
    return "".join(siblings), "".join(sides)


def fold(leaf: str, siblings: str, sides: str) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    for side in sides:
        if side == "-":
            leaf = join(leaf)
            continue
        other = siblings[at : at + 64]
        at += 64
        leaf = join(other, leaf) if side == "l" else join(leaf, other)
    return leaf


def top(block: pd.DataFrame, levels: int) -> pd.DataFrame:
    """The one node that a superblock's subtree leaves in the next list."""
    block = block.sort_values("pos")
    n, width = int(block["n"].iloc[0]), 1 << levels
    node = subtree(block["digest"].tolist(), n, levels)[-1][0]
    row = (block["tree"].iloc[0], int(block["pos"].iloc[0]) // width, -(-n // width), node)
    return pd.DataFrame([row], columns=names(NODES))


def finish(block: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
    """Nodes of a superblock with their proofs: up to the superblock's node, and on from there.

    outer: one row, the proof of the superblock's own node.
    """
    block = block.sort_values("pos").reset_index(drop=True)
    nodes = subtree(block["digest"].tolist(), int(block["n"].iloc[0]), levels)
    above = outer.iloc[0]
    inner = [path(nodes, i) for i in range(len(block))]
    block["siblings"] = [own + above["siblings"] for own, _ in inner]
    block["sides"] = [own + above["sides"] for _, own in inner]
    block["subroot"], block["root"] = above["subroot"], above["root"]
    return block


def folded(block: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
    """A superblock's leaves with whole proofs and the roots that the shown leaves lead to."""
    block = finish(block, outer, levels)
    shown = block["other"].where(block["other"].notna(), block["digest"])
    block["folded_root"] = [
        fold(*row) for row in zip(shown, block["siblings"], block["sides"], strict=True)
    ]
    block["leaf"] = block["digest"]
    block["verified"] = block["folded_root"] == block["root"]
    return block[names(LEAVES)]


# --- over all superblocks ----------------------------------------------------------


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows, which have a column tree, with pos (from 0, by `order` within the tree) and n
    (rows of the tree).

    Rows are dealt by ranges of (tree, order, a running number, so that equal rows are dealt
    out too), written in order, and counted by range; only the counts are windowed.
    """
    keys = ["tree", *order, "_row"]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    ordered = written(ranged.withColumn("_range", F.shiftright("_row", 33)), "ordered")
    counts = ordered.groupBy("tree", "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree",
        "_range",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("n"),
    )
    placed = ordered.join(counts, ["tree", "_range"]).withColumn("pos", F.col("_row") + F.col("_shift"))
    out = written(placed.drop("_row", "_range", "_shift"), "numbered")
    discard(ordered)
    return out


def blocks(nodes: DataFrame, plan: Manifest) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", plan.levels))


def reduced(nodes: DataFrame, plan: Manifest) -> list[DataFrame]:
    """The layers of every list: its nodes, its superblocks' nodes and so on to a single one."""
    layers, levels = [nodes], plan.levels
    while not layers[-1].where("n > 1").isEmpty():
        tops = blocks(layers[-1].select(*names(NODES)), plan).groupBy("tree", "block")
        layers.append(written(tops.applyInPandas(lambda block: top(block, levels), NODES), "subtrees"))
    return layers


def exchanged(nodes: DataFrame, outer: DataFrame, plan: Manifest, last: bool = False) -> DataFrame:
    """Superblocks cogrouped with the proofs of their own nodes, (tree, pos, siblings, sides,
    subroot, root): the nodes proved, or, at last, the leaves proved and folded."""
    levels, schema = plan.levels, LEAVES if last else f"{NODES}, {PROOF}"
    work = folded if last else finish

    def both(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        return work(block, above, levels)[names(schema)]

    above = outer.select("tree", F.col("pos").alias("block"), *names(PROOF))
    pairs = blocks(nodes, plan).groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
    return pairs.applyInPandas(both, schema)


def manifest(
    documents: DataFrame, shown: Mapping[str, Column] | None = None, plan: Manifest = Manifest()
) -> DataFrame:
    """One row per document row: doc_id, leaf, subroot (of its language), root, siblings (hex
    digests of the proof, from the leaf to the root), sides (one letter a level: sibling left,
    right or none), folded_root and verified.

    shown: columns that a holder of the documents shows instead of the dataset's; the leaf
    made of them is folded with the dataset's siblings, and verified tells whether that gives
    the root. Leaves of a language ascend by doc_id, nulls first; rows that share a doc_id are
    put in the order of their digests, so equal rows are leaves of their own next to each
    other. A null language is a language, before all others, which are ordered by their
    bytes. Any field may be null or empty. Other columns are not read; an empty table gives an
    empty result. A lone leaf is its language's subroot, a lone language's subroot the root.
    """
    held = {name: F.col(name) for name in FIELDS}
    differs = F.lit(False)
    for name, column in (shown or {}).items():
        differs = differs | ~column.eqNullSafe(F.col(name))
    rows = documents.select(
        # names of lists: the null language's comes first
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(held).alias("digest"),
        # hashed again only where something else is shown
        F.when(differs, digest({**held, **(shown or {})})).alias("other"),
    )
    hashed = written(rows, "leaves")
    leaves = numbered(hashed, ["doc_id", "digest"])
    discard(hashed)
    layers = reduced(leaves, plan)
    subroots = layers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    languages = numbered(subroots, ["name"])
    upper = reduced(languages, plan)
    roots = upper[-1].select(
        "tree", "pos", F.lit("").alias("siblings"), F.lit("").alias("sides"),
        F.col("digest").alias("subroot"), F.col("digest").alias("root"),
    )
    for layer in reversed(upper[:-1]):
        roots = written(exchanged(layer.select(*names(NODES)), roots, plan), "proofs")
    outer = languages.select("pos", F.col("name").alias("tree"), F.col("digest").alias("own"))
    outer = outer.join(roots.drop("tree", "subroot", "digest", "n"), "pos").withColumn("subroot", F.col("own"))
    outer = outer.withColumn("pos", F.lit(0).cast("long"))
    for layer in reversed(layers[1:-1]):
        outer = written(exchanged(layer, outer, plan), "proofs")
    leaves = leaves.withColumn("doc_id", F.col("doc_id").cast("string"))  # null stays apart
    return exchanged(leaves, outer, plan, last=True).withColumn("doc_id", F.col("doc_id").cast("long"))


def tampered(documents: DataFrame) -> dict[str, Column]:
    """What the holders of one document in seven show: one more character than there is."""
    number = F.crc32(documents["doc_id"].cast("long").cast("string"))
    more = documents["n_chars"].cast("long") + F.when(number % 7 == 0, 1).otherwise(0)
    return {"n_chars": F.when(number.isNull(), documents["n_chars"].cast("long")).otherwise(more)}


def with_digest(proofs: DataFrame) -> DataFrame:
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"),
        "folded_root", "verified", F.length("sides").alias("height"),
    )
