"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Rows, lower_ascii, rows_of, schema_of, whole, written
from riskstream.llm.components import components

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Variants that one cell should hold; decides how many leading bits name a cell, and so how often a value is sent.
CELL_VARIANTS = 1 << 24
#: Variants that a task makes at a time.
CHUNK = 1 << 20
#: A cell with more rows, and with so many times the rows of the mean cell, is split by further bits before the shuffle.
HOT_ROWS, HOT_TIMES, HOT_BITS = 20_000, 4, 8


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 majority bits of the XXH64 of a text's word shingles, repeats included; 0 if it has no words."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)], dtype="<u8")
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 65_536):
        bits = np.unpackbits(h[at : at + 65_536].view(np.uint8), bitorder="little").reshape(-1, BITS)
        set_bits += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), one row per input row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        for key, body in rows_of(batches):
            value = fingerprint(body.encode("utf-8", "surrogatepass"), shingle)
            rows.add((key, value - (1 << 64) if value >> 63 else value))
            if rows.full():
                yield rows.take()
        yield rows.take()

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), lower_ascii(whole(text)).alias("text"))
    return source.mapInArrow(compute, schema_of("doc_id long, fp long"))


def flips(bits: range, most: int) -> list[int]:
    """Masks of up to `most` of the given bits."""
    return [sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(bits, n)]


def ball_links(
    prints: DataFrame, radius: int = RADIUS, cell_variants: int = CELL_VARIANTS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column fp), with the components that differing in at most `radius` bits makes.

    Meet in the middle: two values differ by at most `radius` bits if and only
    if a third is within half the radius (rounded up and down) of both. Every
    value has a variant for each such third; values that share a variant are
    verified and linked. Variants are shuffled by their leading bits, which
    name a cell: the variants of a value that fall into one cell travel as one
    row and are made there, so that a value sends 1 + p + p(p-1)/2 rows for p
    bits and not one per variant. p follows the number of values, so that a
    cell stays small; a cell with many rows, as a large group of near copies
    makes, is split by further bits in the same way, and a task makes variants
    chunk by chunk. Of the verified pairs of a cell, a star around the smallest
    value of each component goes on, not all pairs.
    """
    if radius % 2:
        raise ValueError("radius must be even")
    half = radius // 2
    prints = written(prints.select("fp").distinct(), "fingerprints")
    ball = sum(math.comb(BITS, i) for i in range(half + 1))
    n = prints.count()
    lead = min(max(6, math.ceil(math.log2(n * ball / cell_variants + 1))), 24)
    mean = n * (1 + lead + lead * (lead - 1) // 2) >> lead
    whole_ball = prints.select("fp", F.lit(0).cast("long").alias("cell"), F.lit(half).alias("left"))
    sent = _split(whole_ball, 0, lead, half)
    rows_in_cell = sent.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    hot = written(rows_in_cell.filter(F.col("rows") > max(hot_rows, HOT_TIMES * mean)).select("cell"), "hot-cells")
    if not hot.isEmpty():
        extra = _split(sent.join(hot, "cell", "left_semi"), lead, HOT_BITS, half).withColumn("lead", F.lit(lead + HOT_BITS))
        sent = sent.join(hot, "cell", "left_anti").withColumn("lead", F.lit(lead)).unionByName(extra)
    else:
        sent = sent.withColumn("lead", F.lit(lead))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bits, values, left in _cells(batches):
            pairs = _cell_links(values, left, bits, min(cell_variants, CHUNK))
            ok = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= radius
            pairs = _spanning(pairs[ok]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    dealt = sent.select("lead", "cell", "fp", "left").repartition("lead", "cell").sortWithinPartitions("lead", "cell")
    return dealt.mapInArrow(link, schema_of("a long, b long")).distinct()


def _split(sent: DataFrame, lead: int, more: int, half: int) -> DataFrame:
    """cell, fp, left, with cells named by `more` further bits: one row for each way to spend flips on these bits."""
    own = F.shiftrightunsigned("fp", BITS - lead - more).bitwiseAND(F.lit((1 << more) - 1).cast("long"))
    ways = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("spent")) for m in flips(range(more), half)])
    rows = sent.withColumn("own", own).withColumn("way", F.explode(ways)).filter(F.col("way.spent") <= F.col("left"))
    cell = F.shiftleft("cell", more).bitwiseOR(F.col("own").bitwiseXOR(F.col("way.mask")))
    return rows.select(cell.alias("cell"), "fp", (F.col("left") - F.col("way.spent")).alias("left"))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """lead, values, left for each cell of a stream that is sorted by (lead, cell)."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        edges = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
        for part in zip(*(np.split(c, edges) for c in cols), strict=True):
            if not len(part[0]):
                continue
            if held and (held[0][0][0], held[0][1][0]) != (part[0][0], part[1][0]):
                yield _joined(held)
                held = []
            held.append(list(part))
    if held:
        yield _joined(held)


def _joined(held: list[list[np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    lead, _, values, left = (np.concatenate(c) for c in zip(*held, strict=True))
    values = values.view(np.uint64)
    order = np.argsort(values)
    return int(lead[0]), values[order], left[order]


@functools.cache
def _masks(bits: int, most: int) -> np.ndarray:
    return np.array(flips(range(bits), most), dtype=np.uint64)


def _cell_links(values: np.ndarray, left: np.ndarray, lead: int, most: int) -> np.ndarray:
    """Links of one cell: its variants have the cell's leading bits, and the other bits of its values with up to `left` flips.

    values are sorted. If there are more variants than `most`, they are made and compared by the next bits in turn.
    """
    tail = BITS - lead
    counts = [sum(math.comb(tail, i) for i in range(k + 1)) for k in range(int(left.max()) + 1)]
    if sum(counts[k] for k in left.tolist()) > most and tail > 16:
        own = (values >> np.uint64(tail - 4)) & np.uint64(15)
        parts = []
        for sub in range(16):
            rest = left - np.bitwise_count(own ^ np.uint64(sub)).astype(left.dtype)
            inside = rest >= 0
            if inside.sum() > 1:
                parts.append(_cell_links(values[inside], rest[inside], lead + 4, most))
        return np.unique(np.concatenate(parts), axis=0) if parts else np.empty((0, 2), dtype=np.uint64)
    tails = values & np.uint64((1 << tail) - 1)
    index = np.arange(len(values), dtype=np.int32)
    variants, owners = [], []
    for k in range(len(counts)):
        chosen = left == k
        masks = _masks(tail, k)
        variants.append((tails[chosen][:, None] ^ masks).ravel())
        owners.append(np.repeat(index[chosen], len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant)
    variant, owner = variant[order], owner[order]
    first = np.concatenate(([True], variant[1:] != variant[:-1]))
    runs = np.flatnonzero(first)
    head = np.repeat(np.minimum.reduceat(owner, runs), np.diff(np.append(runs, len(owner))))
    other = head != owner
    pairs = np.unique(head[other].astype(np.int64) * len(values) + owner[other])
    return np.stack([values[pairs // len(values)], values[pairs % len(values)]], axis=1)


def _spanning(pairs: np.ndarray) -> np.ndarray:
    """(smallest, other) for each component of the pairs."""
    values, ends = np.unique(pairs, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            other = np.flatnonzero(label != np.arange(len(values)))
            return np.stack([values[label[other]], values[other]], axis=1)
        label = after


def _classes(docs: DataFrame, radius: int, shingle: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, component_id) of every fingerprint; root tells components of one name apart."""
    rows = written(fingerprints(docs, doc_id, text, shingle), "doc-fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = written(ball_links(rows, radius), "links")
    roots = components(links).withColumnRenamed("node", "fp")
    classes = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, written(classes.join(names, "root").select("fp", "root", "component_id"), "print-components")


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints that differ in at most `radius` bits are linked; component_id
    is the smallest doc_id that a document reaches over links, itself included.
    Null and empty texts have the fingerprint zero, which is linked like any
    other. Null doc_ids take part, but name a component only if it has no other
    id (it is null then). Repeated rows and ids give a row each. An empty table
    gives no rows; other columns are ignored.
    """
    rows, by_print = _classes(docs, radius, shingle, doc_id, text)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(by_print.drop("root"), "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all columns, whose id names their component: one row of each component that has an id.

    If several rows of a component have that id, the one with the least hash is
    kept. Rows without an id are kept in components where no row has one, all of
    them, and dropped from others. Ids on one row each are decided by id alone;
    only rows with a repeated id or none are looked up by their fingerprint.
    """
    prints, by_print = _classes(docs, radius, shingle, doc_id, text)
    names = F.when(F.col("component_id") == F.col("doc_id"), 1)
    ids = prints.join(by_print.drop("root"), "fp").groupBy(F.col("doc_id").alias("id"))
    ids = written(ids.agg(F.count(F.lit(1)).alias("n"), F.count(names).alias("named")), "ids")
    rows = docs.select(F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("id"))
    settled = rows.filter("id is not null").join(ids.filter("named = 0 or n > 1"), "id", "left_anti").select("doc.*")
    several = ids.filter("n > 1 and named > 0").select("id")
    if several.isEmpty() and ids.filter("id is null").isEmpty():
        return settled
    open_rows = rows.filter("id is null").unionByName(rows.join(several, "id", "left_semi").select("doc", "id"))
    open_rows = written(open_rows.withColumn("place", F.monotonically_increasing_id()), "open-rows")
    found = fingerprints(open_rows.select("place", F.col("doc")[text].alias("text")), "place", "text", shingle)
    found = found.withColumnRenamed("doc_id", "place").join(by_print, "fp")
    found = open_rows.select("place", "id", F.xxhash64(F.to_json("doc")).alias("hash")).join(found, "place")
    nameless = found.filter("id is null and component_id is null").select("place")
    least = found.filter("id = component_id").groupBy("root").agg(F.min(F.struct("hash", "place"))["place"].alias("place"))
    kept = open_rows.join(nameless.unionByName(least.select("place")), "place", "left_semi")
    return settled.unionByName(kept.select("doc.*"))
