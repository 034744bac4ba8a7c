"""Near-duplicates by the Jaccard similarity of word shingles, found by token combinations in extended prefixes.

Equal sets become one first. The shingles of a set are ordered by frequency class, rare
ones first. Two similar sets have their first common shingle in the prefix of both, and
their first two in the prefix that is one longer. A rare shingle of the prefix is a
signature by itself. A frequent one is not: it is one only together with a second
of the extended prefix, because whatever follows a frequent shingle is frequent
too. Sets that share a signature are candidates, which are verified on whole sets.

Sets with a common signature are not paired all with all. Each signature names a
centre, and all its sets are compared with that; sets whose components are then
the same need no further comparison. Rounds go on with what is open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Rows, rows_of, schema_of, whole, written
from riskstream.llm.components import components
from riskstream.llm.grams import CHUNK, PART, Words, added, answered, chunked, codes, distinct as distinct_codes, mixed, parts_for, read_words, reply_of, unpack

SHINGLE = 5
#: Least similarity, in hundredths.
SIMILARITY = 80
#: A shingle is frequent from 2 ** RARE different sets on.
RARE = 10
#: Sets with more shingles use frequent ones alone, as their combinations are too many.
LARGE = 100
#: Shingles of a set that are tried first, to join near copies before their signatures are compared.
LEADING = 4
#: Open pairs for each open row, below which all open pairs are compared; and the rounds after which they are in any case.
OPEN_PAIRS, ROUNDS = 32, 8

_PLACE_BITS = 22
_UPPER, _SPACES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\x09\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(_UPPER + _SPACES, _UPPER.lower() + b" " * len(_SPACES))


def folded(text: bytes) -> bytes:
    return text.translate(_FOLD)


def shingles(chunk: Words, length: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of the distinct shingles of the wanted documents of a chunk, in that order.

    A document of fewer words than `length` has one shingle, all its words.
    """
    hashes = chunk.hashes()
    owners, keys = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.uint64)]
    for size in range(1, length + 1):
        fits = wanted & ((chunk.counts >= size) if size == length else (chunk.counts == size))
        if fits.any():
            at, key = chunk.runs(size, hashes)
            inside = fits[chunk.owner[at]]
            owners.append(chunk.owner[at][inside])
            keys.append(key[inside])
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    owner, key = owner[order], key[order]
    edges = np.searchsorted(owner, np.arange(len(chunk.counts) + 1)).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        if b - a > 1:
            key[a:b].sort()
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], key[new]


def _sets(chunks: DataFrame, length: int) -> DataFrame:
    """place, doc_id, n and a 128-bit hash of the set, for every document; no hash for empty sets."""
    schema = pa.schema([(name, pa.int64()) for name in ("place", "doc_id", "n", "h1", "h2")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for chunk, *packed in rows_of(batches, 1):
            own = read_words(*packed)
            owner, key = shingles(own, length, np.ones(len(own.counts), dtype=bool))
            edges = np.searchsorted(owner, np.arange(len(own.counts) + 1)).tolist()
            for i, (doc_id, a, b) in enumerate(zip(own.tags, edges, edges[1:], strict=False)):
                h = np.frombuffer(xxhash.xxh3_128_digest(key[a:b].tobytes()), dtype="<i8").tolist() if b > a else (None, None)
                out.add((chunk << _PLACE_BITS | i, doc_id, b - a, *h))
                if out.full():
                    yield out.take()
        yield out.take()

    rows = chunks.select("chunk", "tags", "counts", "carry", "body")
    return rows.mapInArrow(measure, schema_of("place long, doc_id long, n long, h1 long, h2 long"))


def _classes(mass: int, bodies: list[bytes]):
    """The answer for a shingle: the whole part of the binary logarithm of the number of sets that hold it."""
    names, total = added(*map(np.concatenate, zip(*map(unpack, bodies), strict=True)))
    return lambda asked: np.log2(total[np.searchsorted(names, asked)] + 0.5).astype(np.uint8)


def signatures(keys: np.ndarray, classes: np.ndarray, similarity: int, rare: int, large: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Signatures of a set, how many shingles that other sets have too come before each, and the number of those.

    keys are ordered by class. A shingle that no other set has (class 0) is never common; with too many
    of them, a set is similar to no other.
    """
    n = len(keys)
    least = -(-similarity * n // 100)
    alone = int((classes == 0).sum())
    shared = n - alone
    if shared < max(least, 2):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), shared
    keys, classes = keys[alone:], classes[alone:]
    prefix = n - least + 1 - alone
    plain = int(np.searchsorted(classes[:prefix], rare))
    found, at = [mixed(keys[:plain])], [np.arange(plain)]
    if n <= large:
        common = keys[plain : min(prefix + 1, shared)]
        first, second = np.triu_indices(len(common), 1)
        inside = first < prefix - plain
        found.append(mixed(mixed(common[first[inside]]) + common[second[inside]]))
        at.append(first[inside] + plain)
    if 100 * n >= similarity * large:
        found.append(mixed(keys[plain:prefix] + np.uint64(1)))
        at.append(np.arange(plain, prefix))
    return np.concatenate(found), np.concatenate(at), shared


def _records(chunks: DataFrame, length: int, similarity: int, rare: int, large: int, part: int) -> DataFrame:
    """place, n, shared, lead, sigs, before, tokens of the sets that have signatures. `tags` of chunks are the wanted documents."""
    parts = parts_for(chunks, part)

    def wanted(own: Words) -> np.ndarray:
        mask = np.zeros(len(own.counts), dtype=bool)
        mask[own.tags] = True
        return mask

    def keys(own: Words) -> np.ndarray:
        return shingles(own, length, wanted(own))[1]

    longs = pa.list_(pa.int64())
    schema = pa.schema([("place", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("lead", longs), ("sigs", longs), ("before", longs), ("tokens", longs)])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for chunk, *packed, replies in rows_of(batches, 1):
            own = read_words(*packed)
            owner, key = shingles(own, length, wanted(own))
            code = codes(key, parts)
            level = reply_of(replies)[np.searchsorted(distinct_codes(code)[0], code)]
            edges = np.searchsorted(owner, np.arange(len(own.counts) + 1))
            others = np.concatenate(([0], np.cumsum(level > 0)))[edges]
            sizes, others = np.diff(edges), np.diff(others)
            able = np.flatnonzero((others > 1) & (100 * others >= similarity * sizes))
            for i, a, b in zip(able.tolist(), edges[able].tolist(), edges[able + 1].tolist(), strict=True):
                order = np.argsort(level[a:b], kind="stable")
                keys, levels = key[a:b][order], level[a:b][order]
                sigs, before, shared = signatures(keys, levels, similarity, rare, large)
                if len(sigs):
                    lead = np.sort(mixed(keys[levels > 0] + np.uint64(2)))[:LEADING].view(np.int64)
                    out.add((chunk << _PLACE_BITS | i, b - a, shared, lead, sigs.view(np.int64), before, key[a:b].view(np.int64)), 16 * len(sigs) + 8 * (b - a))
                if out.full():
                    yield out.take()
        yield out.take()

    longs = "array<long>"
    found = answered(chunks, keys, _classes, parts)
    return found.mapInArrow(sign, schema_of(f"place long, n long, shared long, lead {longs}, sigs {longs}, before {longs}, tokens {longs}"))


def _possible(x: str, y: str, similarity: int) -> Column:
    """Whether sizes and places of a common shingle leave room for the similarity."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    before = F.least(F.col(f"{x}.before"), F.col(f"{y}.before"))
    after = F.least(F.col(f"{x}.shared") - F.col(f"{x}.before"), F.col(f"{y}.shared") - F.col(f"{y}.before"))
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * similarity
    return sizes & ((before + after) * (100 + similarity) >= (n + m) * similarity)


def _verified(pairs: DataFrame, records: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. Shingles are compared by 64-bit hashes."""
    one = records.select(F.col("place").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    two = records.select(F.col("place").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    common = F.size(F.array_intersect("t_a", "t_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", common)
    return both.filter(F.col("common") * (100 + similarity) >= (F.col("n_a") + F.col("n_b")) * similarity).select("a", "b")


_ROW = ["place", "n", "shared", "before", "comp"]


def _centred(rows: DataFrame) -> DataFrame:
    """sig, x, y: every row of a signature beside its centre, the set that has fewest shingles of its own."""
    centre = F.struct((F.col("n") - F.col("shared")).alias("own"), F.struct(*_ROW).alias("y"))
    centres = rows.groupBy("sig").agg(F.min(centre)["y"].alias("y"))
    return rows.select("sig", F.struct(*_ROW).alias("x")).join(centres, "sig").filter("x.place <> y.place")


def _similar(tried: DataFrame, records: DataFrame, similarity: int) -> DataFrame:
    pairs = tried.filter((F.col("x.comp") != F.col("y.comp")) & _possible("x", "y", similarity))
    pairs = written(pairs.select(F.col("y.place").alias("a"), F.col("x.place").alias("b")).distinct(), "pairs")
    return written(_verified(pairs, records, similarity), "similar")


def links(records: DataFrame, similarity: int = SIMILARITY, open_pairs: int = OPEN_PAIRS) -> DataFrame:
    """Links (a, b) of similar sets, with the components that all such links make.

    The leading shingles join most near copies at little cost. Then all signatures are gone through; those whose sets
    are in one component already are left out before anything is joined.
    """
    lead = records.select(F.explode("lead").alias("sig"), "place", "n", "shared", F.lit(0).cast("long").alias("before"), F.col("place").alias("comp"))
    found = _similar(_centred(lead), records, similarity)
    roots = components(found).withColumnRenamed("node", "place")
    named = records.drop("tokens", "lead").join(roots, "place", "left").withColumn("comp", F.coalesce("root", "place"))
    rows = named.select("place", "n", "shared", "comp", F.explode(F.arrays_zip("sigs", "before")).alias("s"))
    rows = _open(rows.select(F.col("s.sigs").alias("sig"), "place", "n", "shared", F.col("s.before").alias("before"), "comp"))
    for turn in range(ROUNDS + 1):
        sizes = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("m"))
        total = sizes.agg(F.sum("m").alias("rows"), F.sum(F.expr("m * (m - 1) div 2")).alias("pairs")).first()
        if not total["rows"]:
            break
        last = turn == ROUNDS or total["pairs"] <= open_pairs * total["rows"]
        if last:
            x, y = (rows.select("sig", F.struct(*_ROW).alias(name)) for name in "xy")
            tried = x.join(y, "sig").filter("x.place < y.place")
        else:
            tried = _centred(rows)
        found = found.unionByName(_similar(tried, records, similarity))
        if last:
            break
        roots = components(found).withColumnRenamed("node", "place")
        rest = tried.select("sig", "x.*").drop("comp").join(roots, "place", "left")
        rows = _open(rest.select("sig", "place", "n", "shared", "before", F.coalesce("root", "place").alias("comp")))
    return found


def _open(rows: DataFrame) -> DataFrame:
    """The rows of signatures that sets of different components share."""
    ends = rows.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return written(rows.join(ends.filter("low < high").select("sig"), "sig", "left_semi"), "shared-signatures")


def similar_documents(
    docs: DataFrame,
    similarity: int = SIMILARITY,
    shingle: int = SHINGLE,
    doc_id: str = "doc_id",
    text: str = "text",
    rare: int = RARE,
    large: int = LARGE,
    open_pairs: int = OPEN_PAIRS,
    chunk: int = CHUNK,
    part: int = PART,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest doc_id that it reaches over links).

    A document's set is its distinct shingles of lower-cased words (fewer words: all of them as one); documents
    link if their sets' common part is at least `similarity` hundredths of their union. Null, empty and blank
    texts have no shingle and no link; their component is their own id. Null ids take part, but name a
    component only if it has no other id (it is null then). Repeated rows and ids give a row each.
    An empty table gives no rows; other columns are ignored. A document's words must fit a task.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("tag"), whole(text).alias("text"))
    chunks = chunked(rows, "long", folded, "set-chunks", size=chunk)
    sets = written(_sets(chunks, shingle), "sets")
    distinct = sets.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("place").alias("place"), F.min("doc_id").alias("least"))
    distinct = written(distinct, "distinct-sets")
    mask = (1 << _PLACE_BITS) - 1
    wanted = distinct.select(F.shiftright("place", _PLACE_BITS).alias("chunk"), F.col("place").bitwiseAND(F.lit(mask)).alias("i"))
    wanted = wanted.groupBy("chunk").agg(F.collect_list("i").alias("tags"))
    own = written(chunks.drop("tags").join(wanted, "chunk").select(*chunks.columns), "distinct-chunks")
    records = written(_records(own, shingle, similarity, rare, large, part), "set-records")
    roots = components(written(links(records, similarity, open_pairs), "set-links")).withColumnRenamed("node", "place")
    named = distinct.join(roots, "place", "left").withColumn("root", F.coalesce("root", "place"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(named.join(names, "root").select("h1", "h2", "n", "component_id"), "set-components")
    found = sets.filter("n > 0").join(named, ["h1", "h2", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
