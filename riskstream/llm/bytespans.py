"""Suffix-array deduplication of bytes: column-wise construction of a collection's Burrows-Wheeler transform and common prefixes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.passages import Reading, byte_symbols, run_hashes, without_repeats
from riskstream.llm.substring import span_total

WINDOW = 400
#: Bytes of an anchor; a segment has (WINDOW - GRAM + 2) / 2 windows on average.
GRAM = 24
#: Bytes of text in a collection, besides one anchor's segments.
BLOCK = 700_000
#: Different segments of one anchor that a collection takes; beyond, its windows are counted.
HOT = 6_000
#: Most bytes that one symbol of the transform stands for.
SYMBOL = 50


def symbol_width(window: int, most: int = SYMBOL) -> int:
    return max(w for w in range(1, most + 1) if window % w == 0)


def symbol_numbers(text: np.ndarray, width: int) -> np.ndarray:
    """A number for each place, equal for equal strings of `width` bytes. The order of the numbers is arbitrary, but total."""
    if width == 1:
        return text.astype(np.int64)
    hashes = run_hashes(text.astype(np.uint64) + np.uint64(1), width)
    _, first, numbers = np.unique(hashes, return_index=True, return_inverse=True)
    same = np.ones(len(numbers), dtype=bool)
    chosen = first[numbers]
    if width >= 8:
        eight = np.ndarray(len(text) - 7, dtype="<u8", buffer=text.tobytes(), strides=(1,))
        for at in sorted({*range(0, width - 7, 8), width - 8}):
            part = eight[at : at + len(numbers)]
            same &= part == part[chosen]
    else:
        for at in range(width):
            part = text[at : at + len(numbers)]
            same &= part == part[chosen]
    if same.all():
        return numbers
    strings = np.lib.stride_tricks.sliding_window_view(text, width)  # a hash stood for two strings
    return np.unique(np.ascontiguousarray(strings).view(np.dtype((np.void, width))).ravel(), return_inverse=True)[1]


class Columns:
    """The sorted suffixes of a collection of strings, longer by one symbol of each string every round.

    For every suffix, in order: its first symbol, the place of the suffix
    without it, the symbol before it (the Burrows-Wheeler transform), the common
    prefix with the suffix above, up to `cap`, and where it stands in the text.
    """

    def __init__(self, strings: int, cap: int):
        self.cap = cap
        self.first = np.full(strings, -1, dtype=np.int32)  # the strings' ends, which differ from each other
        self.tail = np.arange(strings, dtype=np.int32)
        self.transform = np.full(strings, -1, dtype=np.int32)
        self.common = np.zeros(strings, dtype=np.uint8)
        self.source = np.full(strings, -1, dtype=np.int32)
        self.place = np.arange(strings, dtype=np.int32)  # of each string's longest suffix so far

    def insert(self, strings: np.ndarray, symbols: np.ndarray, before: np.ndarray, source: np.ndarray) -> None:
        """One symbol more for the given strings: each new suffix is put in order by its symbol and the place of the last one."""
        n, m = len(self.first), len(strings)
        tails = self.place[strings]
        self.transform[tails] = symbols
        key = symbols.astype(np.int64) * n + tails
        order = np.argsort(key)
        old = self.first.astype(np.int64) * n + self.tail
        at = np.searchsorted(old, key[order])
        moved = np.arange(n) + np.cumsum(np.bincount(at, minlength=n + 1))[:n]
        new = at + np.arange(m)

        def merged(have: np.ndarray, more: np.ndarray) -> np.ndarray:
            out = np.empty(n + m, dtype=have.dtype)
            out[moved], out[new] = have, more[order]
            return out

        first, tail = merged(self.first, symbols), merged(self.tail, tails)
        common = merged(self.common, np.zeros(m, dtype=np.uint8))
        common = self._common(first, tail, common, new)
        self.source = merged(self.source, source)
        self.transform = merged(self.transform, before)
        self.first, self.common = first, common
        self.tail = moved[tail].astype(np.int32)
        self.place[strings[order]] = new

    def _common(self, first: np.ndarray, tail: np.ndarray, common: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Common prefixes of new suffixes, and of those below them: one more than the least between their tails."""
        touched = np.zeros(len(first) + 1, dtype=bool)
        touched[new] = touched[new + 1] = True
        below = np.flatnonzero(touched[:-1])
        below = below[below > 0]
        common[below] = 0
        below = below[(first[below] == first[below - 1]) & (first[below] >= 0)]
        if not len(below):
            return common
        start, end = tail[below - 1] + 1, tail[below]
        levels = np.floor(np.log2(end - start + 1)).astype(np.int64)
        least, size = self.common, 1
        for level in range(int(levels.max()) + 1):
            here = levels == level
            value = np.minimum(least[start[here]], least[end[here] - size + 1])
            common[below[here]] = np.minimum(value + 1, self.cap)
            if level < levels.max():
                least = np.minimum(least[:-size], least[size:])
                size *= 2
        return common


def covered_by_repeats(times: list[int], bodies: list[bytes], window: int = WINDOW, most: int = SYMBOL) -> list[np.ndarray]:
    """For each string, the bytes covered by strings of `window` bytes that stand twice in the collection.

    A symbol is `width` bytes, and a body gives `width` strings of symbols, one
    for each place to begin, so that every place of a body begins a suffix.
    Suffixes with window / width common symbols are next to each other in order.
    """
    width = symbol_width(window, most)
    need = window // width
    sizes = np.array([len(b) for b in bodies])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    text = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    counts = np.maximum(sizes[:, None] - np.arange(width), 0) // width
    body, phase = np.nonzero(counts >= need)
    counts = counts[body, phase]
    base = starts[body] + phase
    steps = np.zeros(len(text) + 1, dtype=np.int64)
    for i in np.flatnonzero(np.array(times) > 1):
        if sizes[i] >= window:
            steps[starts[i]] += 1
            steps[starts[i] + sizes[i]] -= 1
    if len(counts):
        numbers = symbol_numbers(text, width).astype(np.int32)
        columns = Columns(len(counts), min(need, 255))
        for done in range(int(counts.max())):
            on = np.flatnonzero(counts > done)
            at = base[on] + (counts[on] - 1 - done) * width
            before = np.where(counts[on] - 1 > done, numbers[np.maximum(at - width, 0)], -1)
            columns.insert(on, numbers[at], before, at.astype(np.int32))
        near = columns.common >= need
        repeated = columns.source[near | np.append(near[1:], False)]
        np.add.at(steps, repeated, 1)
        np.add.at(steps, repeated + window, -1)
    inside = np.cumsum(steps[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
    first, after = edge[::2], edge[1::2]
    # runs of neighbours in the joined text are parted where a body ends
    return [_within(first, after, s, s + n) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _within(first: np.ndarray, after: np.ndarray, start: int, end: int) -> np.ndarray:
    a, b = np.searchsorted(after, start, side="right"), np.searchsorted(first, end)
    return (np.stack([np.maximum(first[a:b], start), np.minimum(after[a:b], end)], axis=1) - start).astype(np.int32).ravel()


def _kept(text: bytes, mask: np.ndarray) -> tuple:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    kept = np.frombuffer(text, dtype=np.uint8)[~mask].tobytes() if len(edge) else text
    return len(text), edge.astype(np.int32), kept


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, block: int = BLOCK, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, removed (as [start, end, start, end, ...]), kept (binary).

    Texts are UTF-8 bytes. Each byte covered by a string of `window` bytes that
    also starts anywhere else, in the same document or another, overlaps
    included, is removed; strings are judged on the input and never cross
    documents. kept has the other bytes; a character may lose some of its own.
    Null and empty texts have no bytes. Documents that repeat, in whole or as
    rows with the same id, repeat each other's strings. An empty table gives no
    rows; other columns are ignored.
    """
    how = Reading(byte_symbols, len, lambda times, bodies: covered_by_repeats(times, bodies, window), window, gram, block, hot)
    arrow = pa.schema([("n_bytes", pa.int64()), ("removed", pa.list_(pa.int32())), ("kept", pa.binary())])
    return without_repeats(docs, how, _kept, "n_bytes long, removed array<int>, kept binary", arrow, doc_id, text)


def bytespan_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 from the result of remove_repeats()."""
    spans = (F.size("removed") / 2).cast("long")
    return found.select("doc_id", "n_bytes", span_total("removed").alias("n_removed"), spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
