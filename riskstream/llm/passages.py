"""Finding repeated windows of texts: shards of segments that can share a window, and what to remove.

A window is `window` symbols (words or bytes) in a row. Its anchor is the
smallest hash among the runs of `gram` symbols in it, so equal windows have
equal anchors wherever they stand. Windows that follow each other and share an
anchor form a segment. Segments are dealt into shards by anchor: all places of
a window are in one shard, each exactly once, and an index of the shard decides
which windows stand in it twice.

Anchors that stand once in all texts are dropped first, by a count that is summed
in every task before the shuffle; equal segments become one row with a number, so
copies weigh as much as one. Texts are shuffled twice, compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Rows, rows_of, schema_of, whole, written

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_HASH = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"base": np.ones(1, dtype=np.uint64), "inverse": np.ones(1, dtype=np.uint64)}


def _power_table(name: str, n: int) -> np.ndarray:
    """1, b, b**2, ... modulo 2**64, at least n of them."""
    if len(_powers[name]) < n:
        factor = np.full(max(n, 1 << 16), _BASE if name == "base" else _INVERSE, dtype=np.uint64)
        factor[0] = 1
        _powers[name] = np.multiply.accumulate(factor)
    return _powers[name]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass(frozen=True)
class Symbols:
    """A text as symbols: a hash for each, and the bytes from one to another."""

    text: bytes
    hashes: np.ndarray
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def cut(self, at: int, size: int) -> bytes:
        if self.starts is None:
            return self.text[at : at + size]
        return self.text[self.starts[at] : self.ends[at + size - 1]]


def word_symbols(text: bytes) -> Symbols:
    b = np.frombuffer(text, dtype=np.uint8)
    edge = np.diff(np.concatenate(([0], (~_SPACE[b]).astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE_HASH[b] * _power_table("base", len(b))[: len(b)])))
    return Symbols(text, _mixed((sums[ends] - sums[starts]) * _power_table("inverse", len(b) + 1)[starts]), starts, ends)


def byte_symbols(text: bytes) -> Symbols:
    return Symbols(text, _BYTE_HASH[np.frombuffer(text, dtype=np.uint8)])


def run_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of `length` symbols, put together from runs of powers of two."""
    found, done, part, size = None, 0, h, 1
    n = len(h) - length + 1
    while True:
        if length & size:
            step = np.uint64(pow(_BASE, size, 1 << 64))
            found = part if found is None else found[:n] * step + part[done : done + n]
            done += size
        if done == length:
            return _mixed(found[:n])
        part = part[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size:]
        size *= 2


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return values if size == width else np.minimum(values[: len(values) - (width - size)], values[width - size :])


def segments(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, first symbol, number of symbols and how often the anchor stands in it, of each segment.

    A segment has at most `window` windows.
    """
    if len(h) < window:
        return np.empty(0, dtype=np.uint64), *(np.empty(0, dtype=np.int64) for _ in range(3))
    grams = run_hashes(h, gram)
    anchors = sliding_least(grams, window - gram + 1)
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    count = np.diff(np.append(first, len(anchors)))
    pieces = -(-count // window)
    if (pieces > 1).any():
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        count = np.minimum(np.repeat(count, pieces) - nth * window, window)
        first = np.repeat(first, pieces) + nth * window
    anchor, size = anchors[first], count + window - 1
    return anchor, first, size, _occurrences(grams, anchor, first, size - gram + 1)


def _occurrences(grams: np.ndarray, anchor: np.ndarray, first: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """How often each anchor stands among the `reach` grams from `first` on."""
    seen = np.zeros(1 << 16, dtype=bool)
    seen[anchor.astype(np.uint16)] = True
    places = np.flatnonzero(seen[grams.astype(np.uint16)])
    values = np.unique(anchor)
    rank = np.minimum(np.searchsorted(values, grams[places]), len(values) - 1)
    places, rank = places[values[rank] == grams[places]], rank[values[rank] == grams[places]]
    width = len(grams) + 1
    keys = np.sort(rank * width + places)
    low = np.searchsorted(values, anchor) * width + first
    return np.searchsorted(keys, low + reach) - np.searchsorted(keys, low)


#: (n, body) of each unit of a block -> covered places of each, as flat [start, end, start, end, ...]
Index = Callable[[list[int], list[bytes]], list[np.ndarray]]


@dataclass(frozen=True)
class Reading:
    """How texts are read, and how a shard's block is searched. block: symbols that an index holds at a time, besides one anchor's."""

    read: Callable[[bytes], Symbols]
    count: Callable[[bytes], int]
    index: Index
    window: int
    gram: int
    block: int
    hot: int


def _sized(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")


def _packed(rows: DataFrame) -> DataFrame:
    """row, doc_id, packed: texts compressed, to be shuffled."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("packed", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, press = Rows(schema), zstandard.ZstdCompressor(level=1)
        for row, key, body in rows_of(batches):
            packed = press.compress(body.encode("utf-8", "surrogatepass"))
            out.add((row, key, packed), len(packed))
            if out.full():
                yield out.take()
        yield out.take()

    return rows.mapInArrow(pack, schema_of("row long, doc_id long, packed binary"))


def _segment_table(rows: DataFrame, how: Reading) -> DataFrame:
    """row, anchor, seg (hash of its bytes), at, size, times (2, if it holds its anchor again): the segments of all texts."""
    names = ["row", "anchor", "seg", "at", "size", "times"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        waiting = 0
        for row, _, body in rows_of(batches):
            symbols = how.read(body.encode("utf-8", "surrogatepass"))
            anchor, at, size, times = segments(symbols.hashes, how.window, how.gram)
            if not len(anchor):
                continue
            piece, hashed = symbols.cut, xxhash.xxh3_64_intdigest
            seg = np.array([hashed(piece(a, s)) for a, s in zip(at.tolist(), size.tolist(), strict=True)], dtype=np.uint64)
            places = [at.astype(np.int32), size.astype(np.int32), np.minimum(times, 2).astype(np.int32)]
            held.append([np.full(len(at), row), anchor.view(np.int64), seg.view(np.int64), *places])
            waiting += len(at)
            if waiting >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names)
                held, waiting = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names)

    return rows.mapInArrow(cut, schema_of("row long, anchor long, seg long, at int, size int, times int"))


def _bodies(packed: DataFrame, wanted: DataFrame, how: Reading) -> DataFrame:
    """anchor, seg, n, body for the wanted (row, anchor, seg, n, at, size)."""
    listed = wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "seg", "n", "at", "size")).alias("list"))
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, unpack = Rows(schema), zstandard.ZstdDecompressor()
        for body, asked in rows_of(batches, 16):
            symbols = how.read(unpack.decompress(body))
            for x in asked:
                piece = symbols.cut(x["at"], x["size"]) if x["at"] + x["size"] <= len(symbols.hashes) else b""
                if xxhash.xxh3_64_intdigest(piece) == x["seg"] % (1 << 64):  # another text may share the row's hash
                    out.add((x["anchor"], x["seg"], x["n"], piece), len(piece))
                    if out.full():
                        yield out.take()
        yield out.take()

    return packed.join(listed, "row").select("packed", "list").mapInArrow(cut, schema_of("anchor long, seg long, n long, body binary"))


def _indexed(units: DataFrame, how: Reading) -> DataFrame:
    """anchor, seg, spans for units (anchor, seg, n, body): the places that repeated windows cover."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("spans", pa.list_(pa.int32()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> None:
            for (anchor, seg, _, _), spans in zip(held, how.index([u[2] for u in held], [u[3] for u in held]), strict=True):
                if len(spans):
                    out.add((anchor, seg, spans), 4 * len(spans))

        for unit in rows_of(batches, 1024):
            if last == unit[:2]:
                continue  # repeated rows give a segment more than once
            if last is not None and last[0] != unit[0] and size >= how.block:
                flush()
                held, size = [], 0
                if out.full():
                    yield out.take()
            last = unit[:2]
            held.append(unit)
            size += len(unit[3])
        if held:
            flush()
        yield out.take()

    dealt = units.repartition("anchor").sortWithinPartitions("anchor", "seg")
    return dealt.mapInArrow(search, schema_of("anchor long, seg long, spans array<int>"))


def _counted(units: DataFrame, how: Reading) -> DataFrame:
    """The same for anchors with very many different segments: their windows are counted one by one.

    Equal windows meet as one row for each task that has them.
    """
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("at", pa.int32()), ("n", pa.int64()), ("w", pa.int64()), ("v", pa.int64())])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for anchor, seg, n, body in rows_of(batches, 256):
            symbols = how.read(body)
            for at in range(len(symbols.hashes) - how.window + 1):
                part = symbols.hashes[at : at + how.window].tobytes()
                out.add((anchor, seg, at, n, signed(xxhash.xxh3_64_intdigest(part)), signed(xxhash.xxh64_intdigest(part))))
                if out.full():
                    yield out.take()
        yield out.take()

    rows = written(units.dropDuplicates(["anchor", "seg"]).mapInArrow(windows, schema_of("anchor long, seg long, at int, n long, w long, v long")), "windows")
    twice = rows.groupBy("w", "v").agg(F.sum("n").alias("total")).filter("total > 1").select("w", "v")
    hit = rows.join(twice, ["w", "v"], "left_semi").groupBy("anchor", "seg").agg(F.collect_set("at").alias("list"))
    pairs = F.flatten(F.transform(F.array_sort("list"), lambda a: F.array(a, a + how.window)))
    return hit.select("anchor", "seg", pairs.alias("spans"))


def repeated_segments(rows: DataFrame, how: Reading) -> tuple[DataFrame, DataFrame]:
    """(row, at, size, seg, spans) of all segments with places that a repeated window covers, and the packed texts."""
    packed = _packed(rows)
    table = written(_segment_table(rows, how), "segments")
    twice = table.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor")
    shared = written(table.drop("times").join(twice, "anchor", "left_semi"), "shared-segments")
    distinct = shared.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "at", "size")).alias("one"))
    distinct = written(distinct.select("anchor", "seg", "n", "one.*"), "distinct-segments")
    rivals = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"))
    distinct = written(distinct.join(rivals, "anchor"), "ranked-segments")
    # copies of a segment that is alone on its anchor repeat each other, and no other segment has a window of it
    copies = (F.col("k") == 1) & (F.col("n") > 1)
    alone = distinct.filter(copies).select("anchor", "seg", F.array(F.lit(0), F.col("size")).alias("spans"))
    found = alone.unionByName(_indexed(_bodies(packed, distinct.filter(~copies & (F.col("k") <= how.hot)), how), how))
    hot = distinct.filter(F.col("k") > how.hot)
    if not hot.isEmpty():
        found = found.unionByName(_counted(_bodies(packed, hot, how), how))
    found = written(found, "found")
    return shared.join(found, ["anchor", "seg"]).select("row", "at", "size", "seg", "spans"), packed


def covered(symbols: Symbols, hits: list[dict]) -> np.ndarray:
    """Which symbols of a text its hits cover."""
    n = len(symbols.hashes)
    steps = np.zeros(n + 1, dtype=np.int64)
    for hit in hits:
        at, size, spans = hit["at"], hit["size"], hit["spans"]
        # another text may share the row's hash, but then the segment does not stand here
        if at + size <= n and xxhash.xxh3_64_intdigest(symbols.cut(at, size)) == hit["seg"] % (1 << 64):
            for s, e in zip(spans[::2], spans[1::2], strict=True):
                steps[hit["at"] + s] += 1
                steps[hit["at"] + e] -= 1
    return np.cumsum(steps[:n]) > 0


def without_repeats(
    docs: DataFrame, how: Reading, finish: Callable[[bytes, np.ndarray], tuple], out: str, arrow: pa.Schema,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id and what `finish` makes of a text and the mask of its covered symbols."""
    rows = _sized(docs, doc_id, text)
    hits, packed = repeated_segments(rows, how)
    listed = hits.groupBy("row").agg(F.collect_set(F.struct("at", "size", "seg", "spans")).alias("list"))
    schema = pa.schema([pa.field("doc_id", pa.int64()), *arrow])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, unpack = Rows(schema), zstandard.ZstdDecompressor()
        for key, body, asked in rows_of(batches, 16):
            text = unpack.decompress(body)
            mask = covered(how.read(text), asked) if asked else np.zeros(how.count(text), dtype=bool)
            rows.add((key, *finish(text, mask)), len(text))
            if rows.full():
                yield rows.take()
        yield rows.take()

    return packed.join(listed, "row", "left").select("doc_id", "packed", "list").mapInArrow(apply, schema_of(f"doc_id long, {out}"))
