"""Packing of tokenized documents into sequences by harmonic classes."""

from __future__ import annotations

import base64
import functools
import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Rows, rows_of, schema_of, whole, written

CAPACITY = 2048
END_ID = 1
#: A piece may leave this share of its slot empty; longer gaps are closed by cutting.
SLACK = 0.02
#: Pieces of open bins that one more round deals to a group of workers; it leaves them some 10,000 at most.
REST = 200_000
#: The pattern of the ranks fails on runs of white space of some 1,000,000 characters; runs from here on are not given to it.
LONG_GAP = 100_000
_LONG_GAP = re.compile(rf"(?<!\s)\s{{{LONG_GAP}}}")


def rank_file_encoder(path: str, pattern: str) -> Callable[[str], list[int]]:
    """Text to ids by a byte-level BPE given as a file of ranks. Strings of special tokens are ordinary text."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def public_encoder() -> Callable[[str], list[int]]:
    """The ids that `tokenizers` gives by the public 50k byte-level BPE, whose files belong to the installed package.

    The ranks give the same ids several times faster, but for texts that hold an
    added token of the vocabulary, or a run of white space too long for their
    pattern; those are left to `tokenizers` itself.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        added = [token["content"] for token in json.load(file)["added_tokens"]]
    whole_vocabulary = functools.cache(lambda: Tokenizer.from_file(path))
    by_ranks = rank_file_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

    def encode(text: str) -> list[int]:
        if any(token in text for token in added) or (len(text) >= LONG_GAP and _LONG_GAP.search(text)):
            return whole_vocabulary().encode(text, add_special_tokens=False).ids
        return by_ranks(text)

    return encode


def cuts(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """The lengths of the pieces of a document.

    A piece of length l belongs to class j = capacity // l: j of them fill a
    sequence. If j pieces would leave more than `slack` of the sequence empty,
    the piece is cut to the largest length of class j + 1, and the rest, which
    is shorter than 1 / (j * (j + 1)) of the capacity, is treated likewise.
    """
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        size = rest if capacity - j * rest <= slack * capacity else capacity // (j + 1)
        pieces.append(size)
        rest -= size
    return pieces


_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary, class int, sequence_id long, offset long"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("ids", pa.binary()), ("class", pa.int32()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


class _Bins:
    """Open bins by class; a bin of class j closes with its j-th piece and is given out."""

    def __init__(self, first_id: int):
        self.next_id = first_id
        self.open: dict[int, list[list]] = defaultdict(list)

    def add(self, piece: list, most: int) -> list[list]:
        """piece: a row of _SCHEMA without its place. The rows of the bin that it closes, if any."""
        group = self.open[piece[5]]
        group.append(piece)
        if len(group) < most:
            return []
        del self.open[piece[5]]
        return self.place(group)

    def place(self, group: list[list]) -> list[list]:
        at = 0
        for piece in group:
            piece[6], piece[7] = self.next_id, at
            at += piece[2]
        self.next_id += 1
        return group


def pack(
    docs: DataFrame, capacity: int = CAPACITY, slack: float = SLACK, end_id: int = END_ID,
    encoder: Callable[[], Callable[[str], list[int]]] = public_encoder, doc_id: str = "doc_id", text: str = "text",
    rest: int = REST,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian 32-bit), class, sequence_id, offset.

    A document is its ids and end_id (null text: end_id alone); cuts() cuts it
    into pieces, each belongs to a harmonic class, and a sequence holds a fixed
    number of pieces of one class. Workers fill sequences on their own, in the
    order in which they read, and number them in ranges of their own. What is
    left in a worker's open bins, less than one bin per class, goes through the
    same classes again in further rounds: pieces are dealt by class and a hash
    of their place into as many groups as keep a group near `rest` pieces, and
    each round leaves less than a bin per class and group. What the round of one
    group leaves, less than a bin per class in all, is packed by first fit.
    Repeated rows and ids are packed like others. An empty table gives no rows;
    other columns are ignored.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        rows, bins = Rows(_ARROW), _Bins((1 + TaskContext.get().partitionId()) << 40)
        for key, body in rows_of(batches, 16):
            ids = np.array(encode(body) + [end_id], dtype="<u4")
            at = 0
            for size in cuts(len(ids), capacity, slack):
                piece = [key, at, size, len(ids), ids[at : at + size].tobytes(), capacity // size, None, None]
                at += size
                for row in bins.add(piece, capacity // size):
                    rows.add(tuple(row), 4 * row[2])
            if rows.full():
                yield rows.take()
        for group in bins.open.values():
            for row in group:
                rows.add(tuple(row), 4 * row[2])
                if rows.full():
                    yield rows.take()
        yield rows.take()

    def refill(turn: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bins = Rows(_ARROW), _Bins((1 << 62) + (turn << 56) + (TaskContext.get().partitionId() << 40))
        for row in rows_of(batches):
            for full in bins.add(list(row), row[5]):
                rows.add(tuple(full), 4 * full[2])
                if rows.full():
                    yield rows.take()
        for group in bins.open.values():
            for row in group:
                rows.add(tuple(row), 4 * row[2])
        yield rows.take()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bins = Rows(_ARROW), _Bins(0)
        open_bins: list[tuple[int, list[list]]] = []
        for piece in sorted((list(r) for r in rows_of(batches)), key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1])):
            for k, (room, group) in enumerate(open_bins):
                if piece[2] <= room:
                    group.append(piece)
                    open_bins[k] = (room - piece[2], group)
                    break
            else:
                open_bins.append((capacity - piece[2], [piece]))
        for _, group in open_bins:
            for row in bins.place(group):
                rows.add(tuple(row), 4 * row[2])
        yield rows.take()

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    parts, left = [], written(source.mapInArrow(fill, schema_of(_SCHEMA)), "packed")
    groups = 0
    while groups != 1:
        parts.append(left.filter("sequence_id is not null"))
        left = left.filter("sequence_id is null")
        wanted = max(1, -(-left.count() // rest))
        groups = min(wanted, max(1, groups // 2)) if groups else wanted  # fewer in each round, so that rounds end
        dealt = left.repartition("class", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)))
        left = written(dealt.mapInArrow(functools.partial(refill, len(parts) - 1), schema_of(_SCHEMA)), "packed-rest")
    # less than one bin for each of the classes, of which there are at most `capacity`
    last = left.filter("sequence_id is null").repartition(1).mapInArrow(finish, schema_of(_SCHEMA))
    return functools.reduce(DataFrame.unionByName, [*parts, left.filter("sequence_id is not null"), last])


def packing_digest(pieces: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset from the result of pack()."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
