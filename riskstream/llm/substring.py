"""Substring deduplication of words: a compressed FM-index per shard, searched backward for matching statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.passages import Reading, without_repeats, word_symbols

WINDOW = 35
#: Words of an anchor; a segment has (WINDOW - GRAM + 2) / 2 windows on average.
GRAM = 6
#: Bytes of text that an index holds at a time, besides one anchor's segments.
BLOCK = 1_500_000
#: Different segments of one anchor that an index takes; beyond, its windows are counted.
HOT = 30_000


class WaveletTree:
    """Rank of symbols in a sequence: a level for each bit of a symbol, most significant first, as packed bits with counts."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        n = len(symbols)
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level) & 1
            packed = np.zeros((n // 64 + 1) * 8, dtype=np.uint8)
            some = np.packbits(bits.astype(bool), bitorder="little")
            packed[: len(some)] = some
            words = packed.view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.counts.append(np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int32))
            zero = bits == 0
            self.zeros.append(int(zero.sum()))
            symbols = np.concatenate((symbols[zero], symbols[~zero]))
        self.base = self._walk(np.arange(alphabet), np.zeros(alphabet, dtype=np.int64))

    def _walk(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            block = places >> 6
            low = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][block] + np.bitwise_count(self.words[k][block] & low)
            bit = (symbols >> (self.levels - 1 - k)) & 1
            places = np.where(bit == 1, self.zeros[k] + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._walk(symbols, places) - self.base[symbols]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling. The text's symbols are such that all suffixes differ soon."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    length = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:-length] = rank[length:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        key = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        rank = new
        if rank[order[-1]] == n - 1 or length >= n:
            return order
        length *= 2


class FMIndex:
    """Index of a collection of word sequences, each with the number of times that it stands in the corpus."""

    def __init__(self, bodies: list[bytes], times: list[int]):
        ids: dict[bytes, int] = {}
        number = ids.setdefault
        sequences = [[number(w, len(ids)) for w in body.split()] for body in bodies]
        sizes = np.array([len(s) for s in sequences])
        k = len(bodies)
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        self.ends = self.starts + sizes - 1
        text = np.empty(int(sizes.sum()) + k, dtype=np.int64)
        is_word = np.ones(len(text), dtype=bool)
        is_word[self.ends + 1] = False
        text[is_word] = np.fromiter((w for s in sequences for w in s), dtype=np.int64, count=int(sizes.sum())) + 1
        text[~is_word] = 0
        # ends differ from each other and come before all words
        order = suffix_order(np.where(is_word, text + k - 1, np.cumsum(~is_word) - 1))
        self.text = text
        owner = np.cumsum(~is_word) - ~is_word
        weight = np.minimum(np.array(times, dtype=np.int64), 2)[owner[order]]
        self.weights = np.concatenate(([0], np.cumsum(weight)))
        alphabet = len(ids) + 1
        self.tree = WaveletTree(text[order - 1], alphabet)  # the symbol before the first is the last, an end
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet))[:-1]))

    def extend(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the suffixes that start with each symbol and go on as before."""
        both = self.tree.rank(np.concatenate((symbols, symbols)), np.concatenate((low, high)))
        start = self.before[symbols]
        return start + both[: len(low)], start + both[len(low) :]


def covered_by_repeats(times: list[int], bodies: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each sequence, the words that are covered by runs of `window` words standing twice in the collection.

    All sequences are streamed against the index at once, a word a step. The
    matching statistic of a probe's last word is the longest run ending there
    that stands twice. A first probe takes the whole sequence; if it fails,
    windows are probed from the left. A window that fails at word i rules out
    all that start at or before i; one that succeeds is followed by a longer stretch.
    """
    fm = FMIndex(bodies, times)
    n = len(fm.text)
    steps = np.zeros(n + 1, dtype=np.int64)
    at, last = fm.starts.copy(), fm.ends - window + 1  # first undecided window, and the last
    stretch = last - at
    live = np.flatnonzero((stretch >= 0) & (np.array(times) == 1))
    whole = np.flatnonzero((stretch >= 0) & (np.array(times) > 1))  # weighs as two by itself
    steps[fm.starts[whole]] += 1
    steps[fm.ends[whole] + 1] -= 1
    end = np.zeros(len(bodies), dtype=np.int64)
    cur, low, high = end.copy(), end.copy(), end.copy()
    end[live] = fm.ends[live]
    cur[live], high[live] = end[live], n
    while len(live):
        lo, hi = fm.extend(low[live], high[live], fm.text[cur[live]])
        ok = fm.weights[hi] - fm.weights[lo] >= 2
        going = live[ok]
        low[going], high[going] = lo[ok], hi[ok]
        cur[going] -= 1
        done = cur[going] < at[going]
        won, still = going[done], going[~done]
        np.add.at(steps, at[won], 1)
        np.add.at(steps, end[won] + 1, -1)
        at[won] = end[won] - window + 2
        stretch[won] = 2 * stretch[won] + 1
        lost = live[~ok]
        long = lost[end[lost] - cur[lost] >= window]
        np.add.at(steps, cur[long] + 1, 1)
        np.add.at(steps, end[long] + 1, -1)
        single = lost[stretch[lost] == 0]
        at[single] = cur[single] + 1
        stretch[lost] = 0
        again = np.concatenate((won, lost))
        again = again[at[again] <= last[again]]
        end[again] = np.minimum(at[again] + stretch[again], last[again]) + window - 1
        cur[again], low[again], high[again] = end[again], 0, n
        live = np.concatenate((still, again))
    inside = np.cumsum(steps[:n]) > 0
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(fm.starts, first, side="right") - 1
    flat = np.stack([first - fm.starts[owner], after - fm.starts[owner]], axis=1).astype(np.int32)
    cuts = np.searchsorted(owner, np.arange(len(bodies) + 1))
    return [flat[cuts[i] : cuts[i + 1]].ravel() for i in range(len(bodies))]


def _kept(text: bytes, mask: np.ndarray) -> tuple:
    words = text.split()
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    kept = words if not len(edge) else [w for w, out in zip(words, mask.tolist(), strict=True) if not out]
    return len(words), edge.astype(np.int32), b" ".join(kept).decode("utf-8", "surrogatepass")


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, block: int = BLOCK, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_words, removed (word places as [start, end, start, end, ...]), kept.

    Words are runs without space and control white space, unchanged. Each word
    covered by `window` words in a row that also start anywhere else, in the
    same document or another, is removed; windows are judged on the input. kept
    has the other words, joined by one space. Null and empty texts have no
    words. Documents that repeat, in whole or as rows with the same id, repeat
    each other's windows. An empty table gives no rows; other columns are ignored.
    """
    how = Reading(word_symbols, lambda text: len(text.split()), lambda times, bodies: covered_by_repeats(times, bodies, window), window, gram, block, hot)
    arrow = pa.schema([("n_words", pa.int64()), ("removed", pa.list_(pa.int32())), ("kept", pa.string())])
    return without_repeats(docs, how, _kept, "n_words long, removed array<int>, kept string", arrow, doc_id, text)


def span_total(spans: str) -> Column:
    """The summed length of [start, end, start, end, ...]."""
    signed = F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def substring_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 from the result of remove_repeats()."""
    return found.select("doc_id", "n_words", span_total("removed").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
