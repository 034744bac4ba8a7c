"""A Merkle manifest of a table, with proofs made by checkpoint and recompute.

Every row is a leaf; the leaves of a source form a tree in the order of their
ids, and the roots of these trees form one more. Only every STRIDE-th level is
stored. The levels between are made again where a proof needs them: an aligned
subtree, which is FANOUT ** STRIDE stored nodes at most, is hashed up in a task,
gives each of its stored nodes their siblings, and is dropped. Subtrees are
shuffled by tree and place, so a source with many rows is many groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.llm.common import Rows, rows_of, schema_of, written

FANOUT = 3
#: Levels from one stored level to the next.
STRIDE = 5
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: What a leaf carries besides its place: the id of its row, its name if it is a source, and a digest to be checked against it.
_CARRIED = "doc_id long, name string, other string"
_NODE = f"tree string, pos long, n long, digest string, {_CARRIED}"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: -, or its length in UTF-8, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(fields[name]) for name in FIELDS]), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int, fanout: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n = -(-n // fanout)
        levels += 1
    return levels


def raised(nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    """An aligned subtree: its nodes, and `levels` levels made of them."""
    made = [nodes]
    for _ in range(levels):
        below = made[-1]
        made.append([digest(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return made


def placed(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """rows with their place in their tree (pos, from 0) and the number n of its nodes.

    Rows are sorted by range over all tasks and written. A place is the row's
    number in its task, moved by what the tasks before hold of the same tree;
    that table has a row for each tree in each task.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()), label)
    task = F.shiftright("at", 33)
    parts = dealt.groupBy("tree", task.alias("task")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = F.sum("rows").over(whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    moves = parts.select("tree", "task", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("move"), F.sum("rows").over(whole).alias("n"))
    found = dealt.withColumn("task", task).join(moves, ["tree", "task"])
    return found.withColumn("pos", F.col("at") + F.col("move")).drop("task", "at", "move")


def grow(leaves: DataFrame, label: str, fanout: int = FANOUT, stride: int = STRIDE) -> list[DataFrame]:
    """The stored levels of trees whose leaves are given. A row with n = 1 is the root of its tree; it is on no later level."""
    levels = [leaves]
    while not (below := levels[-1].filter("n > 1")).isEmpty():
        levels.append(written(_raise(below, fanout, stride), label))
    return levels


def _blocks(nodes: DataFrame, fanout: int, stride: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {fanout**stride}"))


def _raise(below: DataFrame, fanout: int, stride: int) -> DataFrame:
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for (tree, block), rows in groupby(rows_of(batches, 4096), key=lambda r: r[:2]):
            nodes = list(rows)
            n = nodes[0][3]
            levels = min(stride, height(n, fanout))
            out.add((tree, block, -(-n // fanout**levels), raised([r[4] for r in nodes], levels, fanout)[-1][0]))
            if out.full():
                yield out.take()
        yield out.take()

    rows = _blocks(below, fanout, stride).select("tree", "block", "pos", "n", "digest")
    dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    made = dealt.mapInArrow(fold, schema_of("tree string, pos long, n long, digest string"))
    return made.selectExpr("*", "CAST(NULL AS long) AS doc_id", "CAST(NULL AS string) AS name", "CAST(NULL AS string) AS other")


def roots(levels: list[DataFrame]) -> DataFrame:
    """tree, digest of every tree."""
    found = levels[0].filter("n = 1").select("tree", "digest")
    for level in levels[1:]:
        found = found.unionByName(level.filter("n = 1").select("tree", "digest"))
    return found


def proofs(levels: list[DataFrame], tops: DataFrame, label: str, fanout: int = FANOUT, stride: int = STRIDE) -> DataFrame:
    """The leaves with their path, from what tops (tree, path, subroot, root) say of the roots of the trees.

    A path has a step for each level, upwards, joined by |. A step is the digests of a run with * for
    the node itself. Stored levels are taken from above: the subtrees between a level and the next one
    are made again, and each node's path is its steps in the subtree and then the path of the stored node above.
    """
    found = levels[-1].join(tops, "tree")
    for at in range(len(levels) - 2, -1, -1):
        single = levels[at].filter("n = 1").join(tops, "tree")
        found = _descend(levels[at].filter("n > 1"), found, fanout, stride).unionByName(single)
        if at:
            found = written(found, label)
    return found


def _descend(nodes: DataFrame, above: DataFrame, fanout: int, stride: int) -> DataFrame:
    text = [(name, pa.string()) for name in ("path", "subroot", "root")]
    names = ["tree", "pos", "n", "digest", "doc_id", "name", "other"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema([*zip(names, kinds, strict=True), *text])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for (tree, _), rows in groupby(rows_of(batches, 1024), key=lambda r: r[:2]):
            (*_, rest, subroot, root), *members = rows
            n = members[0][3]
            levels = min(stride, height(n, fanout))
            made = raised([r[4] for r in members], levels, fanout)
            for i, row in enumerate(members):
                steps = []
                for level in made[:levels]:
                    run = i - i % fanout
                    steps.append("".join("*" if k == i else level[k] for k in range(run, min(run + fanout, len(level)))))
                    i //= fanout
                path = "|".join([*steps, rest] if rest else steps)
                out.add((tree, *row[2:8], path, subroot, root), len(path))
                if out.full():
                    yield out.take()
        yield out.take()

    blank = [F.lit(None).cast("string").alias(name) for name in ("path", "subroot", "root")]
    own = _blocks(nodes, fanout, stride).select("tree", "block", *names[1:], *blank)
    gone = [F.lit(None).cast(kind).alias(name) for name, kind in (("n", "long"), ("digest", "string"), ("doc_id", "long"), ("name", "string"), ("other", "string"))]
    heads = above.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), *gone, "path", "subroot", "root")
    dealt = own.unionByName(heads).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return dealt.mapInArrow(extract, schema_of(f"{_NODE}, path string, subroot string, root string"))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf's upwards."""
    return F.sha2(F.translate(path, "*|", ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    steps = F.filter(F.split(path, r"\|"), lambda step: step != "")
    return F.aggregate(steps, start, lambda node, step: F.sha2(F.replace(step, F.lit("*"), node), 256))


@dataclass(frozen=True)
class Manifest:
    """The stored levels of the trees of the sources and of the tree of their roots; root is None for an empty table."""

    sources: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    fanout: int
    stride: int

    def proofs(self) -> DataFrame:
        """One row per leaf: doc_id, digest (the leaf), other, path, subroot, root."""
        top = self.top[-1].select("tree", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"), F.lit(self.root).alias("root"))
        tops = proofs(self.top, top, "top-paths", self.fanout, self.stride)
        tops = written(tops.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "tops")
        return proofs(self.sources, tops, "paths", self.fanout, self.stride).drop("tree", "pos", "n", "name")


def manifest(docs: DataFrame, other: Column | None = None, fanout: int = FANOUT, stride: int = STRIDE) -> Manifest:
    """The manifest of a table of documents; `other` is a digest that each leaf carries, to be checked later.

    Null fields are a - in the leaf. The null source is a source of its own, before all others; null ids stand
    before all others of their source. Rows with equal ids are ordered by their leaves, and equal rows
    are leaves of their own. An empty table has no levels with rows and no root. Other columns are ignored.
    """
    own = leaf({name: F.col(name) for name in FIELDS})
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-"))
    other = F.lit(None).cast("string") if other is None else other
    leaves = docs.select(tree.alias("tree"), own.alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("string").alias("name"), other.alias("other"))
    leaves = written(leaves, "leaves").withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc(), F.col("copy").asc()]
    sources = grow(placed(leaves, order, "placed-leaves").drop("copy"), "level", fanout, stride)
    subroots = roots(sources).select(F.lit("").alias("tree"), "digest", F.lit(None).cast("long").alias("doc_id"), F.col("tree").alias("name"), F.lit(None).cast("string").alias("other"))
    top = grow(placed(subroots, [F.col("name").asc()], "placed-roots"), "top-level", fanout, stride)
    found = roots(top).first()
    return Manifest(sources, top, found["digest"] if found else None, fanout, stride)


def merkle_digest(docs: DataFrame, fanout: int = FANOUT, stride: int = STRIDE) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: the manifest checked against a tampered copy.

    The copy lacks the \\n characters of the texts of rows whose id, as text, has an even CRC-32. Rows without an id
    or text are as they were.
    """
    tampered = {name: F.col(name) for name in FIELDS}
    tampered["text"] = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(F.col("text").cast("string"), F.lit("\n"))
    found = manifest(docs, F.when(touched, leaf(tampered)), fanout, stride).proofs()
    back = folded(F.coalesce("other", "digest"), F.col("path"))
    rows = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
