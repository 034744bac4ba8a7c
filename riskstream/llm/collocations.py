"""Frequent phrases of a corpus and how tightly their words belong together.

Two passes. The first finds which phrases may be frequent: every hash partition of
phrases has a Misra-Gries summary, whose capacity exceeds the partition's mass
(occurrences) divided by the threshold, so that no frequent phrase is lost. The
second counts the phrases that are left, as texts. What follows is joins of
frequent phrases with their parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.llm.common import Rows, rows_of, schema_of, whole, written
from riskstream.llm.grams import CHUNK, PART, Words, added, answered, chunked, codes, distinct, parts_for, read_words, reply_of, unpack

LONGEST = 4
THRESHOLD = 30
TOP = 2000
NO_LANG = "und"
#: A phrase is dropped if a longer one has at least so many hundredths of its occurrences.
ABSORBED = 80
SCALE = 2_000_000
#: Bits of a phrase's key in its partition: enough that few rare phrases meet a frequent one, as those are counted in vain.
BITS = 26
#: Different phrases that a task counts before it gives them out.
HELD = 400_000
#: Different phrases of a chunk that are added to the counts before the task may give them out.
STEP = 50_000
#: Groups of phrases that are ranked apart before the best of each are ranked together.
RANKED_APART = 64

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes.maketrans(_UPPER + _BREAKS + b"\t", _LOWER + b"\n" * len(_BREAKS) + b" ")
#: Stands where a piece ends; no word has this character.
_END = b"."


def pieces(text: bytes) -> bytes:
    """The words of a text, lower-cased, with a dot where a piece ends."""
    return text.translate(_FOLD).replace(b"\n", b" " + _END + b" ")


class Summary:
    """A Misra-Gries summary of weighted 32-bit keys; summaries merge.

    An estimate is at most `lost` below the true count, and lost * (capacity + 1) is at most the mass added.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._rows = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._rows += len(keys)
        if self._rows > max(self.capacity, 1 << 16):
            self.settle()

    def merge(self, other: Summary) -> None:
        other.settle()
        self.add(other.keys, other.counts)
        self.settle()
        self.lost += other.lost

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self._waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self._waiting]])
        self._waiting, self._rows = [], 0
        keys, counts = added(keys, counts)
        if len(keys) > self.capacity:
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            kept = counts > cut
            keys, counts = keys[kept], counts[kept] - cut
            self.lost += cut
        self.keys, self.counts = keys, counts


def _phrase_keys(chunk: Words) -> tuple[list[np.ndarray], np.ndarray]:
    """First words of the phrases of each length, and the hashes of all of them; a language is part of the hash."""
    langs = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"), 1) for t in chunk.tags], dtype=np.uint64)
    plain = chunk.hashes()
    hashes = plain ^ langs[chunk.owner] if len(plain) else plain
    ends = np.concatenate(([0], np.cumsum(plain == np.uint64(xxhash.xxh3_64_intdigest(_END)))))
    places, keys = [], []
    for length in range(1, LONGEST + 1):
        at, key = chunk.runs(length, hashes)
        inside = ends[at + length] == ends[at]
        places.append(at[inside])
        keys.append(key[inside])
    return places, np.concatenate(keys)


def _survivors(threshold: int):
    def answer(mass: int, bodies: list[bytes]):
        summary = Summary(mass // threshold + 1)
        for body in bodies:
            summary.add(*unpack(body))
        summary.settle()
        alive = summary.keys[summary.counts + summary.lost >= threshold]
        return lambda keys: np.isin(keys, alive, assume_unique=True)

    return answer


def _count(chunk: Words, places: list[np.ndarray], alive: np.ndarray, counts: dict[str, dict[bytes, int]]) -> Iterator[None]:
    """Add the phrases that are alive, told apart by their words, to the counts of their language.

    Stops after every STEP of them, so that the caller may give out and clear the counts before a chunk is done.
    """
    names = list(dict.fromkeys(chunk.tags))
    number = {t: i for i, t in enumerate(names)}
    chunk.number()
    lang = np.array([number[t] for t in chunk.tags], dtype=np.int64)[chunk.owner] if len(chunk.ids) else chunk.ids
    symbols = np.unique(lang * max(1, len(chunk.vocabulary)) + chunk.ids, return_inverse=True)[1]
    width, done, words = len(symbols) + 1, 0, chunk.words
    for length, at in enumerate(places, 1):
        at, done = at[alive[done : done + len(at)]], done + len(at)
        same = symbols[at]
        for i in range(1, length):
            same = np.unique(same, return_inverse=True)[1] * width + symbols[at + i]
        _, first, times = np.unique(same, return_index=True, return_counts=True)
        first = at[first]
        for start in range(0, len(first), STEP):
            some, often = first[start : start + STEP], times[start : start + STEP]
            for i, name in enumerate(names):
                chosen = lang[some] == i
                own = counts.setdefault(name, {})
                for place, n in zip(some[chosen].tolist(), often[chosen].tolist(), strict=True):
                    phrase = b" ".join(words[place : place + length])
                    own[phrase] = own.get(phrase, 0) + n
            yield


def phrase_counts(
    docs: DataFrame, lang: str = "lang", text: str = "text", threshold: int = THRESHOLD, chunk: int = CHUNK, part: int = PART
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of 1 to LONGEST words that stand at least `threshold` times, and (lang, n)."""
    name = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG))
    rows = docs.select(name.alias("tag"), whole(text).alias("text"))
    chunks = chunked(rows, "string", pieces, "phrase-chunks", LONGEST - 1, chunk)
    parts = parts_for(chunks, part)
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[bytes, int]] = {}
        totals: dict[str, int] = {}

        def held() -> Iterator[pa.RecordBatch]:
            out = Rows(schema)
            for name, own in counts.items():
                for phrase, n in own.items():
                    out.add((name, phrase.count(b" ") + 1, phrase.decode("utf-8", "surrogatepass"), n))
                    if out.full():
                        yield out.take()
            yield out.take()
            counts.clear()

        for _, *packed, replies in rows_of(batches, 1):
            own = read_words(*packed)
            places, keys = _phrase_keys(own)
            code = codes(keys, parts, BITS)
            kept = distinct(code)[0][reply_of(replies) > 0]
            near = np.minimum(np.searchsorted(kept, code), max(len(kept) - 1, 0))
            alive = kept[near] == code if len(kept) else np.zeros(len(code), dtype=bool)
            for i, n in zip(*np.unique(own.owner[places[0]], return_counts=True), strict=True):
                totals[own.tags[i]] = totals.get(own.tags[i], 0) + int(n)
            for _ in _count(own, places, alive, counts):
                if sum(map(len, counts.values())) > HELD:
                    yield from held()
        yield from held()
        out = Rows(schema)
        for name, n in totals.items():
            out.add((name, 0, None, n))
        yield out.take()

    found = answered(chunks, lambda c: _phrase_keys(c)[1], _survivors(threshold), parts, BITS)
    counts = found.mapInArrow(count, schema_of("lang string, words int, phrase string, f long"))
    counts = counts.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    counts = written(counts.filter((F.col("f") >= threshold) | (F.col("words") == 0)), "phrases")
    return counts.filter("words > 0"), counts.filter("words = 0").select("lang", F.col("f").alias("n"))


def _wide(number: Column, digits: int = 20) -> Column:
    return number.cast(f"decimal({digits},0)")


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", threshold: int = THRESHOLD, top: int = TOP, chunk: int = CHUNK, part: int = PART
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of each language.

    a is how often a phrase of 2 to LONGEST words stands in the pieces of the language's texts, n the language's
    words; l and r are the counts of the first and the second part at the cut that scores least. Null texts are empty,
    the null language is `und`. Repeated rows count as often as they stand; a table without
    a frequent phrase gives no rows. Other columns are ignored.
    """
    counts, totals = phrase_counts(docs, lang, text, threshold, chunk, part)
    several = counts.filter("words > 1").withColumn("list", F.split("phrase", " "))
    cuts = several.select("lang", "phrase", "words", "list", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    left = _part(F.col("list"), F.lit(1), F.col("k"))
    right = _part(F.col("list"), F.col("k") + 1, F.col("words") - F.col("k"))
    halves = cuts.select("lang", "phrase", "words", "a", "k", F.posexplode(F.array(left, right)).alias("side", "half"))
    known = counts.select("lang", F.col("phrase").alias("half"), "f")
    halves = halves.join(known, ["lang", "half"]).groupBy("lang", "phrase", "words", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    # a is at most l and r, so the whole part of the quotient fits a long whatever the factors
    halves = halves.withColumn("up", _wide(F.col("a")) * F.lit(SCALE)).withColumn("down", _wide(F.col("l")) + _wide(F.col("r")))
    scored = halves.withColumn("score", F.expr("up div down").cast("long"))
    scored = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inner = several.filter("words > 2").select(
        "lang", "f", "list", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("length")
    )
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)))
    inner = inner.select("lang", _part(F.col("list"), F.col("start"), F.col("length")).alias("phrase"), "f")
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    absorbed = _wide(F.coalesce("longer", F.lit(0))) * 100 >= _wide(F.col("a")) * ABSORBED
    free = scored.join(longer, ["lang", "phrase"], "left").filter(~absorbed)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_APART))
    best = free.select("lang", "phrase", "a", "best.l", "best.r", "best.score").withColumn("group", group)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
