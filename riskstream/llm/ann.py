"""Nearest neighbours by a block matrix join of int8 tiles."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import rows_of, schema_of, written

NEIGHBOURS = 5
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 16_384


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """row, vec_id, v (array of double) of the vectors that take part; row tells rows with one vec_id apart.

    Vectors that are null, empty or zero, or hold a null or non-finite
    component, and rows without an id, take no part.
    """
    v = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~odd & F.exists("v", lambda x: x != 0))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norm of what rounding lost, of vectors brought to length 1."""
    unit = v / np.abs(v).max(axis=1, keepdims=True)
    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / scale[:, None])
    lost = np.sqrt(((unit - whole * scale[:, None]) ** 2).sum(axis=1))
    return whole.astype(np.int8), scale, lost


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, in double precision, summed in the order of components.

    Rows are brought near 1 by a power of two, which changes no digit, so that no square leaves the range of doubles.
    """
    a, b = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (a, b))
    dot, na, nb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for i in range(a.shape[1]):
        x, y = a[:, i], b[:, i]
        dot += x * y
        na += x * x
        nb += y * y
    return np.clip(dot / np.sqrt(na * nb), -1.0, 1.0)


def _lead_copies(ids: np.ndarray, v: np.ndarray, most: int) -> np.ndarray:
    """Places of candidates, with only the `most` smallest ids of each group of equal vectors: no other can be in a result."""
    rows = np.ascontiguousarray(v + 0.0).view(np.dtype((np.void, v.dtype.itemsize * v.shape[1]))).ravel()
    _, group = np.unique(rows, return_inverse=True)
    order = np.lexsort((ids, group))
    sorted_group = group[order]
    start = np.flatnonzero(np.concatenate(([True], sorted_group[1:] != sorted_group[:-1])))
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < most]


def tile(
    query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, candidates: np.ndarray, neighbours: int, step: int = 256
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, vec_id, score) of the nearest candidates of one tile but for the query's own row, exact.

    The int8 product of a pair, times both scales, differs from the cosine by at
    most lost_q + lost_c + lost_q * lost_c. A candidate survives if its upper bound reaches
    the neighbours-th largest lower bound; survivors are recomputed in double.
    """
    kept = _lead_copies(ids, candidates, neighbours + 1)
    rows, ids, candidates = rows[kept], ids[kept], candidates[kept]
    q8, q_scale, q_lost = quantise(queries)
    c8, c_scale, c_lost = quantise(candidates)
    # products of int8 rows sum to less than 2**24 for up to 1,040 components, so float32 holds them exactly
    kind = np.float32 if queries.shape[1] * 127 * 127 < 1 << 24 else np.float64
    c_rows = c8.astype(kind).T
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(queries), step):
        part = slice(at, at + step)
        near = (q8[part].astype(kind) @ c_rows) * (q_scale[part, None] * c_scale).astype(np.float64)
        slack = q_lost[part, None] + c_lost + q_lost[part, None] * c_lost + 1e-9
        own = query_rows[part, None] == rows
        low = np.where(own, -np.inf, near - slack)
        k = min(neighbours, low.shape[1]) - 1
        floor = -np.partition(-low, k, axis=1)[:, k : k + 1]
        row, col = np.nonzero((near + slack >= floor) & ~own)
        for some in np.array_split(np.arange(len(row)), len(row) // 200_000 + 1):
            score = cosines(queries[at + row[some]], candidates[col[some]])
            out.append((query_rows[at + row[some]], ids[col[some]], score))
    q, c, s = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.empty(0, dtype=np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    best = rank < neighbours
    return q[best], c[best], s[best]


def nearest(
    vectors: DataFrame, neighbours: int = NEIGHBOURS, every: int = 50, query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest vectors of each query by cosine.

    Queries are the vectors whose id is divisible by `every`; candidates are
    all other rows (all, if fewer than `neighbours`). Ties go to the smaller vec_id.
    Rows that repeat a vec_id are vectors of their own: each is a candidate for the others, and
    each that is a query gives its own rows. See usable() for what takes part. Vectors of different lengths are not
    comparable: a query meets candidates of its own length only. A query without
    candidates, and an empty table, give no rows; other columns are ignored.

    Queries and candidates are dealt into blocks by a hash of their id and row; each pair of
    blocks is a tile, computed by one task, which holds one block of either
    side. A vector is sent once per block of the other side. Tiles give at most
    `neighbours` rows a query, which are merged by heaps.
    """
    rows = written(usable(vectors, vec_id, embedding).withColumn("d", F.size("v")), "vectors")
    queries = rows.filter(F.col("vec_id") % every == 0)
    n, n_queries = rows.count(), queries.count()
    down, across = max(1, -(-n_queries // query_block)), max(1, -(-n // candidate_block))
    block = lambda count: F.pmod(F.xxhash64("vec_id", "row"), F.lit(count))
    every_block = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = queries.select("d", block(down).cast("int").alias("i"), every_block(across).alias("j"), "row", "vec_id", "v")
    right = rows.select("d", every_block(down).alias("i"), block(across).cast("int").alias("j"), "row", "vec_id", "v")

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            kinds = {"row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"}
            return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in kinds.items()})
        query_rows, others = a["row"].to_numpy(), b["vec_id"].to_numpy()
        row, other, score = tile(query_rows, np.stack(a["v"].to_numpy()), b["row"].to_numpy(), others, np.stack(b["v"].to_numpy()), neighbours)
        order = np.argsort(query_rows)
        query = a["vec_id"].to_numpy()[order[np.searchsorted(query_rows[order], row)]]
        return pd.DataFrame({"row": row, "query_id": query, "vec_id": other, "score": score})

    keys = ["d", "i", "j"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(match, "row long, query_id long, vec_id long, score double")
    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for row, query, other, score in rows_of(batches, 4096):
            heap = heaps.setdefault((row, query), [])
            if len(heap) < neighbours:
                heapq.heappush(heap, (score, -other))
            else:
                heapq.heappushpop(heap, (score, -other))
        out = [(q, k, -o, s) for (_, q), heap in heaps.items() for k, (s, o) in enumerate(sorted(heap, reverse=True), 1)]
        cols = list(zip(*out, strict=True)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return parts.repartition("row").mapInArrow(merge, schema_of("query_id long, rank int, vec_id long, score double"))
