"""Merkle manifest of a table: a digest for every row, a tree for every language, one root over all trees.

Levels are concatenated strings: an aligned block of 2**DEPTH nodes keeps each of its levels as one string of hexadecimal digests.  The
parents of a level are the hashes of its substrings of two digests' width; the substrings that flank a node within its run are its siblings.
The top of a block is one node of the next stage, whose blocks are made likewise, until a tree has one block; the roots of the trees, in order,
are the leaves of a last tree.  Paths are put together from the top down: a block's path to the root is that of its node above, so a row's path
is the segments of its own block, then its block's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import ranked, written

#: Children of a node, characters of a digest.
ARITY = 2
WIDTH = 64
#: Levels of a block.
DEPTH = 8

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each "-" if null, else the number of its UTF-8 bytes, a colon and the value."""

    def tagged(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(tagged, fields)), 256)


def parents(level: Column) -> Column:
    """The level above, from one as a string."""
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / (ARITY * WIDTH)).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * (ARITY * WIDTH) + 1, F.lit(ARITY * WIDTH)), 256)), "")


def path(levels: Column, place: Column) -> Column:
    """Siblings of the node at a place of the lowest level, upwards: left, right (the others of its run on each side, as strings)."""

    def flanks(level: Column, j: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(ARITY), j)).cast("int")
        nth = at % ARITY
        left = F.substring(level, (at - nth) * WIDTH + 1, nth * WIDTH)
        return F.struct(left.alias("left"), F.substring(level, (at + 1) * WIDTH + 1, (ARITY - 1 - nth) * WIDTH).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), flanks)


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(siblings, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def _stages(nodes: DataFrame, name: str, depth: int) -> list[DataFrame]:
    """All blocks of trees (tree, idx, n, hash, item), stage by stage: tree, n, block, levels, items (those of the lowest stage, by place)."""
    size, stages = ARITY**depth, []
    while True:
        block = F.floor(F.col("idx") / size).alias("block")
        rows = nodes.groupBy("tree", "n", block).agg(F.array_sort(F.collect_list(F.struct("idx", "hash", "item"))).alias("rows"))
        whole = F.array_join(F.transform("rows", lambda r: r["hash"]), "")
        top = lambda levels: F.element_at(levels, -1)
        done = lambda levels: (F.col("n") <= size) & (F.length(top(levels)) == WIDTH)  # noqa: E731  (the root of its tree)
        step = lambda levels, _: F.when(done(levels), levels).otherwise(F.concat(levels, F.array(parents(top(levels)))))
        levels = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(whole), step)
        blocks = written(rows.select("tree", "n", "block", levels.alias("levels"), F.transform("rows", lambda r: r["item"]).alias("items")), f"{name}-blocks")
        stages.append(blocks)
        if (blocks.agg(F.max("n")).first()[0] or 0) <= size:
            return stages
        nodes = blocks.select("tree", F.col("block").alias("idx"), F.ceil(F.col("n") / size).alias("n"), F.element_at("levels", -1).alias("hash"), F.lit(None).cast("int").alias("item"))


def _paths(stages: list[DataFrame], depth: int, above: DataFrame | None) -> DataFrame:
    """Of all leaves: tree, item, leaf, path, subroot (of its tree), root.  above (tree, idx, path, root) goes on from the roots of the trees."""
    for k, blocks in reversed(list(enumerate(stages))):
        last = F.element_at("levels", -1)
        if above is None:
            rows = blocks.withColumns({"up": F.array().cast("array<struct<left:string,right:string>>"), "root": last, "subroot": last})
        else:
            rows = blocks.join(above.select("tree", F.col("idx").alias("block"), F.col("path").alias("up"), *(c for c in ("root", "subroot") if c in above.columns)), ["tree", "block"])
            rows = rows if "subroot" in rows.columns else rows.withColumn("subroot", last)
        leaf = lambda p: F.substring(F.element_at("levels", 1), p * WIDTH + 1, F.lit(WIDTH))
        each = F.transform("items", lambda item, p: F.struct(p.alias("place"), item.alias("item"), leaf(p).alias("leaf"), F.concat(path(F.col("levels"), p), F.col("up")).alias("path")))
        rows = rows.select("tree", "block", "root", "subroot", F.inline(each))
        above = rows.select("tree", (F.col("block") * ARITY**depth + F.col("place")).alias("idx"), "item", "leaf", "path", "subroot", "root")
    return above


def build_manifest(leaves: DataFrame, tree: str, order: list[str], item: Column, depth: int = DEPTH) -> DataFrame:
    """The manifest of leaves (tree, the order's columns, hash): tree, idx, item, leaf, path, subroot, root.

    tree is a string column; its null is a tree of its own, the first one.  Leaves of a tree ascend by ``order`` (null first), equal ones in any order.
    path has an entry a level, from the leaf by the root of its tree to the root of all: left, right.  All rows of a tree are never together: rows are
    ranked in ranges, and a block has 2**depth.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(tree)), F.lit(""))  # keeps the order of trees, null first
    rows = leaves.select(key.alias("tree"), *(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), "hash", item.alias("item"))
    nodes = ranked(rows, "tree", [*(f"o{k}" for k in range(len(order))), "hash"], "leaves")
    low = _stages(nodes, "leaves", depth)
    roots = low[-1].select(F.lit("").alias("tree"), F.col("tree").alias("item"), F.element_at("levels", -1).alias("hash"))
    high = _stages(ranked(roots, "tree", ["item"], "roots"), "roots", depth)
    above = _paths(high, depth, None).select(F.col("item").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", "root")
    out = _paths(low, depth, above)
    return out.withColumn("tree", F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)))


def verify_documents(docs: DataFrame, every: int = 7, depth: int = DEPTH) -> DataFrame:
    """Every row of docs (doc_id, source, lang, n_chars, text) as a leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where ``every`` divides the CRC-32 of the decimal doc_id, the row is tampered with before it is checked: n_chars grows by one.  A row without
    doc_id or n_chars is never changed.  Null fields have a digest of their own; rows without doc_id come first in their language; rows that share
    a doc_id ascend by their digests, repeated rows are leaves each; texts of any length are hashed as a stream of bytes; an empty table
    gives no rows; other columns are ignored.
    """
    fields = {c: F.col(c) for c in FIELDS}
    changed = digest(*(fields | {"n_chars": F.col("n_chars") + 1}).values())
    chosen = F.col("n_chars").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % every == 0)
    item = F.struct("doc_id", F.when(chosen, changed).alias("tampered"))
    leaves = docs.select("doc_id", "lang", digest(*fields.values()).alias("hash"), item.alias("given"))
    out = build_manifest(leaves, "lang", ["doc_id"], F.col("given"), depth)
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = fold(F.coalesce("item.tampered", "leaf"), F.col("path"))
    rows = out.select("item.doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
