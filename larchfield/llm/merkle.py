"""Merkle manifest of a dataset: ternary hash trees per source under one root."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larchfield.llm.common import materialise

ARITY = 3
HEIGHT = 6
#: Leaves of a superblock: the largest group a task holds.
BLOCK = ARITY**HEIGHT

#: What a superblock must know of the tree around it, and what its nodes pass on.
OUTER = "tree long, place long, before array<string>, after array<string>, subroot string, root string"
PROVED = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
    "verified boolean, proof array<string>"
)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def framed(*values: Column) -> Column:
    """Values one after the other: ``-`` if null, else byte count, ``:`` and value."""
    parts = [
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
        for v in (value.cast("string") for value in values)
    ]
    return F.concat(*parts)


def leaf_hash(text: Column, *fields: str) -> Column:
    return F.sha2(framed(*(F.col(c) for c in fields), text), 256)


def tampered_text() -> Column:
    """The text without line feeds where 2 divides crc32 of the decimal doc_id."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(hit, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def hash_leaves(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """source, doc_id, leaf and, where ``altered`` differs from the text, the leaf it would give."""
    fields = ("doc_id", "source", "lang", "n_chars")
    rows = docs.select(*(F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in fields),
                       F.col("text").cast("string").alias("text"))
    own = leaf_hash(F.col("text"), *fields)
    if altered is None:
        other = F.lit(None).cast("string")
    else:
        rows = rows.withColumn("altered", altered)
        other = F.when(~F.col("altered").eqNullSafe(F.col("text")), leaf_hash(F.col("altered"), *fields))
    return rows.select("source", "doc_id", own.alias("leaf"), other.alias("other"))


def numbered(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``number`` from 0 in the given order, written once.

    Rows are sorted by range partitions; only one total per partition goes
    through a window without keys.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialise(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", at), label)
    totals = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialise(
        totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), f"{label}-parts"
    )
    joined = placed.join(bases, "part").withColumn("number", F.col("base") + F.col("at"))
    return joined.drop("part", "at", "base")


def levels_of(nodes: list[str], whole: bool) -> list[list[str]]:
    """The nodes, then each level above them.

    A ``whole`` tree is reduced to one node, a superblock of a larger one by
    exactly its height.
    """
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= HEIGHT:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + ARITY])) for i in range(0, len(last), ARITY)])
    return levels


def is_whole(nodes: pd.DataFrame) -> bool:
    return int(nodes["n"].iloc[0]) <= BLOCK


def reduce_block(nodes: pd.DataFrame) -> pd.DataFrame:
    """The node over one superblock."""
    ordered = nodes.sort_values("place")
    top = levels_of(ordered["node"].tolist(), is_whole(nodes))[-1][0]
    first = nodes.iloc[0]
    return pd.DataFrame(
        {
            "tree": [first["tree"]],
            "place": [int(first["place"]) // BLOCK],
            "n": [-(-int(first["n"]) // BLOCK)],
            "node": [top],
        }
    )


def raise_levels(nodes: DataFrame, label: str, most: int) -> list[DataFrame]:
    """Tables (tree, place, n, node) from the given one up to one node per tree.

    ``n`` counts a tree's nodes in that table; ``most`` is its largest value.
    """
    tables = [nodes]
    while most > 1:
        blocks = tables[-1].select("tree", "place", "n", "node").groupBy("tree", block_of("place"))
        reduced = blocks.applyInPandas(reduce_block, "tree long, place long, n long, node string")
        tables.append(materialise(reduced, f"{label}-nodes"))
        most = -(-most // BLOCK)
    return tables


def block_of(place: str) -> Column:
    return F.floor(F.col(place) / BLOCK).cast("long").alias("block")


def around(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """For each level below the top and each node the text of its siblings before and after."""
    out = []
    for nodes in levels[:-1]:
        runs = [(i, nodes[i - i % ARITY : i - i % ARITY + ARITY]) for i in range(len(nodes))]
        out.append([("".join(run[: i % ARITY]), "".join(run[i % ARITY + 1 :])) for i, run in runs])
    return out


def paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> Iterator[tuple[list[str], list[str]]]:
    """For each of a superblock's nodes, in order, its siblings before and after, level by level to the root."""
    local = around(levels_of(nodes["node"].tolist(), is_whole(nodes)))
    above_before, above_after = (list(outer[c].iloc[0]) for c in ("before", "after"))
    for i in range(len(nodes)):
        steps = [level[i // ARITY**height] for height, level in enumerate(local)]
        yield [b for b, _ in steps] + above_before, [a for _, a in steps] + above_after


def descend(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The paths of one superblock's inner nodes."""
    nodes = nodes.sort_values("place")
    before, after = zip(*paths(nodes, outer), strict=True)
    return pd.DataFrame(
        {
            "tree": nodes["tree"],
            "place": nodes["place"],
            "before": list(before),
            "after": list(after),
            "subroot": outer["subroot"].iloc[0],
            "root": outer["root"].iloc[0],
        }
    )


def prove(nodes: pd.DataFrame, outer: pd.DataFrame, proofs: bool) -> pd.DataFrame:
    """Finish one superblock of leaves: reduce it, join the outer path, fold every row up to the root."""
    nodes = nodes.sort_values("place")
    root, out = outer["root"].iloc[0], []
    for leaf, other, (before, after) in zip(nodes["node"], nodes["other"], paths(nodes, outer), strict=True):
        siblings = [b + a for b, a in zip(before, after, strict=True)]
        folded = other if isinstance(other, str) else leaf
        for b, a in zip(before, after, strict=True):
            folded = digest(b + folded + a)
        out.append((digest("".join(siblings)), folded, folded == root, siblings if proofs else None))
    found = pd.DataFrame(out, columns=["proof_sha256", "folded_root", "verified", "proof"], index=nodes.index)
    found["doc_id"], found["leaf"] = nodes["doc_id"], nodes["node"]
    found["subroot"], found["root"] = outer["subroot"].iloc[0], root
    return found[["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]]


def lower_paths(tables: list[DataFrame], outer: DataFrame, label: str) -> DataFrame:
    """Paths of the nodes of ``tables[0]``, from those of the nodes above the last table.

    Each table's superblocks are cogrouped with the path of the node they form.
    """
    for nodes in reversed(tables):
        exchanged = nodes.groupBy("tree", block_of("place")).cogroup(outer.groupBy("tree", F.col("place").alias("block")))
        outer = materialise(exchanged.applyInPandas(descend, OUTER), f"{label}-paths")
    return outer


def manifest(docs: DataFrame, altered: Column | None = None, proofs: bool = False) -> DataFrame:
    """Leaf, proof and check of every document against one Merkle root.

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text. The leaves of
    a source, in order of doc_id, form a tree of runs of three up to its subroot;
    the subroots in order of source (null first) form a tree up to the root.

    Leaves are numbered by a range sort and dealt into superblocks of 729
    neighbours. Superblocks reduce to one node each, those again, until every
    source has one node; the sources' tree is raised alike. Then paths come down:
    each superblock is cogrouped with the outer nodes that its proofs need, and
    one task finishes it: local levels, whole proofs, folding. No task holds more
    than 729 nodes and one path, whatever the size of a source.

    ``altered`` is the text as found later; a row's proof is folded from the leaf
    that it gives, and ``verified`` tells whether the root comes out. ``proofs``
    adds the siblings themselves, one text per level, in ``proof`` (else null).

    One row per row of ``docs``. Null fields are hashed as ``-``, empty ones as
    ``0:``. Null doc_ids come first in their source; rows that share a doc_id stand
    in order of their leaves. Repeated rows have a leaf each. Texts of any length
    are hashed whole. Other columns are ignored; an empty table gives no rows.
    """
    # Among equal rows the row's place in the scan only spreads the range sort.
    leaves = hash_leaves(docs, altered).withColumn("spread", F.monotonically_increasing_id())
    ranked = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("spread")]
    leaves = numbered(leaves, ranked, "leaves").drop("spread")
    sources = leaves.groupBy("source").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    trees = materialise(numbered(sources, [F.col("first")], "sources"), "trees")
    sizes = trees.agg(F.max("n").alias("most"), F.count("*").alias("trees")).first()
    named = leaves.alias("l").join(trees.alias("t"), F.col("l.source").eqNullSafe(F.col("t.source")))
    base = named.select(
        F.col("t.number").alias("tree"),
        (F.col("l.number") - F.col("first")).alias("place"),
        "n",
        F.col("leaf").alias("node"),
        "other",
        "doc_id",
    )
    per_source = raise_levels(base, "source", max(sizes["most"] or 0, 2))
    subroots = per_source[-1]
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        F.lit(sizes["trees"]).cast("long").alias("n"),
        "node",
    )
    over = raise_levels(tops, "root", max(sizes["trees"], 2))
    none = F.array().cast("array<string>")
    outer = over[-1].select(
        "tree", "place", none.alias("before"), none.alias("after"), F.lit("").alias("subroot"), F.col("node").alias("root")
    )
    outer = lower_paths(over[:-1], outer, "root").alias("o")
    outer = outer.join(subroots.alias("s"), F.col("o.place") == F.col("s.tree")).select(
        F.col("s.tree").alias("tree"), F.col("s.place").alias("place"), "before", "after",
        F.col("s.node").alias("subroot"), "root",
    )
    outer = lower_paths(per_source[1:-1], outer, "source")
    exchanged = base.groupBy("tree", block_of("place")).cogroup(outer.groupBy("tree", F.col("place").alias("block")))
    return exchanged.applyInPandas(partial(prove, proofs=proofs), PROVED)
