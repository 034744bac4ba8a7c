"""Chunks of words, and one question about the keys of all chunks.

Word runs of a corpus are as many as its words, so they are not shuffled as rows.
A chunk is some documents, or a stretch of a long one, as a list of words; its keys
are 64-bit hashes of its word runs. The keys of a chunk go to hash partitions as
sorted, packed arrays, one row for each partition. A task that has all arrays of a
partition answers with one byte for every key that a chunk asked about, and the
answers meet the chunk's text again. Keys that share their last bits inside a partition
get the same answer; what is decided by answers must allow for that.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Rows, rows_of, schema_of, written

#: Bytes of text in a chunk, and for each hash partition.
CHUNK, PART = 3 << 20, 32 << 20
#: Chunks that a task reads again, about.
AGAIN = 12
#: Bits of a key that name it in its partition, at most 32.
BITS = 32

_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """The words of a chunk; document i has counts[i] of them and the tag tags[i].

    The first `carry` words belong to the chunk before and are here only because runs begin in them.
    """

    tags: list
    counts: np.ndarray
    carry: int
    words: list[bytes]

    def __post_init__(self) -> None:
        #: document of each word
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)

    def number(self) -> None:
        """Number the words: `ids` by `vocabulary`, and `numbers` the other way."""
        self.numbers = dict.fromkeys(self.words)
        self.vocabulary = list(self.numbers)
        for i, word in enumerate(self.vocabulary):
            self.numbers[word] = i
        self.ids = np.fromiter(map(self.numbers.__getitem__, self.words), dtype=np.int64, count=len(self.words))

    def hashes(self) -> np.ndarray:
        """A hash for each word of the chunk."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), dtype=np.uint64, count=len(self.words))

    def runs(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of the runs of `length` words inside one document that end after the carried words, and their hashes."""
        n = len(self.words) - length + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        at = np.arange(n)
        inside = (self.owner[:n] == self.owner[length - 1 :]) & (at + length > self.carry)
        found = hashes[:n] + np.uint64(length)
        for i in range(1, length):
            found = mixed(found) * _FACTOR + hashes[i : i + n]
        return at[inside], mixed(found)[inside]


def chunked(
    docs: DataFrame, tag: str, clean: Callable[[bytes], bytes], label: str, overlap: int | None = None, size: int = CHUNK
) -> DataFrame:
    """docs (tag, text) as chunks: chunk, tags, counts, carry, size (bytes), body (packed words).

    clean makes of a text the words of it between spaces. With `overlap`, longer documents are cut
    into several chunks, each of which begins with so many words of the one before; without it, a document stays whole.
    """
    fields = [("chunk", pa.int64()), ("tags", pa.list_(pa.string() if tag == "string" else pa.int64())), ("counts", pa.list_(pa.int32()))]
    schema = pa.schema([*fields, ("carry", pa.int32()), ("size", pa.int64()), ("body", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        out, number = Rows(schema), TaskContext.get().partitionId() << 20
        tags: list = []
        texts: list[bytes] = []
        waiting = 0

        def put(carry: int = 0) -> None:
            nonlocal tags, texts, waiting, number
            body = press.compress(b" ".join(texts))
            out.add((number, tags, [len(t.split()) for t in texts], carry, waiting, body), len(body))
            number += 1
            tags, texts, waiting = [], [], 0

        for key, text in rows_of(batches):
            text = clean(text.encode("utf-8", "surrogatepass"))
            if waiting and waiting + len(text) > size:
                put()
            if overlap is not None and len(text) > size:
                for piece, carry in stretches(text, size, overlap):
                    tags, texts, waiting = [key], [piece], len(piece)
                    put(carry)
                    if out.full():
                        yield out.take()
                continue
            tags.append(key)
            texts.append(text)
            waiting += len(text) + 1
            if out.full():
                yield out.take()
        if tags:
            put()
        yield out.take()

    made = docs.mapInArrow(write, schema_of(f"chunk long, tags array<{tag}>, counts array<int>, carry int, size long, body binary"))
    return written(made, label)


def stretches(text: bytes, size: int, overlap: int) -> Iterator[tuple[bytes, int]]:
    """text in stretches of about `size` bytes that end with a word, each with the last `overlap` words before it in front."""
    at, tail = 0, []
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        piece = b" ".join([*tail, text[at:end]])
        yield piece, len(tail)
        tail = piece.rsplit(None, overlap)[-overlap:] if overlap else []
        at = end


def read_words(tags: list, counts: list[int], carry: int, body: bytes) -> Words:
    return Words(tags, np.array(counts, dtype=np.int64), carry, zstandard.ZstdDecompressor().decompress(body).split())


def parts_for(chunks: DataFrame, part: int = PART) -> int:
    """Hash partitions: as many as the text asks for."""
    return max(1, math.ceil((chunks.agg(F.sum("size")).first()[0] or 0) / part))


def codes(keys: np.ndarray, parts: int, bits: int = BITS) -> np.ndarray:
    """Hash partition (upper half) and the key's name in it (lower half)."""
    low = np.uint64((1 << bits) - 1)
    return (((keys >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)) | (keys & low)


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes, and how often each stands."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.empty(0, dtype=np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def pack(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted 32-bit keys and how often each stands, as differences, byte by byte."""
    both = np.concatenate((np.diff(keys, prepend=np.uint32(0)), times.astype(np.uint32))).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(both.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), dtype=np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<u4").ravel()
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.uint32), both[half:].astype(np.int64)


def added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 32-bit keys with the sums of their times."""
    if len(times) and int(times.max()) < 1 << 32:  # one sort of numbers is much faster than one of places
        both = np.sort(keys.astype(np.uint64) << np.uint64(32) | times.astype(np.uint64))
        keys, times = (both >> np.uint64(32)).astype(np.uint32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


#: From the mass of a partition and its packed arrays to an answer: a byte for each key of an array.
Answer = Callable[[int, list[bytes]], Callable[[np.ndarray], np.ndarray]]


def answered(chunks: DataFrame, keys: Callable[[Words], np.ndarray], answer: Answer, parts: int, bits: int = BITS) -> DataFrame:
    """chunks with `replies`: (part, reply) of the partitions that it has keys in; reply_of() puts them together."""
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("mass", pa.int64()), ("keys", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for chunk, *rest in rows_of(batches, 1):
            code, times = distinct(codes(keys(read_words(*rest)), parts, bits))
            part, key = (code >> np.uint64(32)).astype(np.int64), code.astype(np.uint32)
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.empty(0, dtype=int)
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(part)], strict=False):
                body = pack(key[a:b], times[a:b])
                out.add((int(part[a]), chunk, int(times[a:b].sum()), body), len(body))
                if out.full():
                    yield out.take()
        yield out.take()

    back = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("reply", pa.binary())])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, press = Rows(back), zstandard.ZstdCompressor(level=1)
        for part, rows in groupby(rows_of(batches, 64), key=lambda r: r[0]):
            held = [r[1:] for r in rows]
            find = answer(sum(r[1] for r in held), [r[2] for r in held])
            for chunk, _, body in held:
                found = press.compress(find(unpack(body)[0]).astype(np.uint8).tobytes())
                out.add((chunk, part, found), len(found))
                if out.full():
                    yield out.take()
        yield out.take()

    asked = chunks.select("chunk", "tags", "counts", "carry", "body").mapInArrow(ask, schema_of("part int, chunk long, mass long, keys binary"))
    dealt = asked.repartition(parts, "part").sortWithinPartitions("part", "chunk")
    replies = dealt.mapInArrow(reply, schema_of("chunk long, part int, reply binary"))
    # both sides are dealt by the number of chunks, not by their bytes, which say little of what a chunk takes when it is read
    tasks = max(1, chunks.count() // AGAIN)
    replies = replies.repartition(tasks, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("part", "reply")).alias("replies"))
    return chunks.repartition(tasks, "chunk").join(replies, "chunk", "left").select("chunk", "tags", "counts", "carry", "body", "replies")


def reply_of(replies: Iterable[dict] | None) -> np.ndarray:
    """The answers for the sorted distinct codes of a chunk."""
    press = zstandard.ZstdDecompressor()
    found = [press.decompress(r["reply"]) for r in sorted(replies or [], key=lambda r: r["part"])]
    return np.frombuffer(b"".join(found), dtype=np.uint8)
