import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle_check import connect, differences

from riskstream.llm import collocations, grams
from riskstream.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, f string, n string, part string, k string, list string, phrase string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows, threshold, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, 5):
                counts.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= threshold}
    out = []
    for (lang, phrase), a in found.items():
        cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, len(phrase))]
        score, _, left, right = min((collocations.SCALE * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        out.append((lang, phrase, a, left, right, totals[lang], score))
    inside = Counter()
    for (lang, phrase), f in found.items():
        for size in range(2, len(phrase)):
            for i in range(len(phrase) - size + 1):
                inside[lang, phrase[i : i + size]] = max(inside[lang, phrase[i : i + size]], f)
    out = [r for r in out if not 100 * inside[r[0], r[1]] >= 80 * r[2]]
    rows = []
    for lang in totals:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], " ".join(r[1]).encode()))
        rows += [(lang, i, " ".join(phrase), a, x, y, n, s) for i, (_, phrase, a, x, y, n, s) in enumerate(own[:top], 1)]
    return sorted(rows)


def noise(rng, n):
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", "\n", ";", "\x0b"]
    return "".join(f"{rng.choice('abcdeABÄäé')}{rng.choice('xyz')}{rng.choice(ends)}" for _ in range(n))


@pytest.fixture(scope="module")
def table():
    rng = random.Random(3)
    rows = [(noise(rng, rng.randint(0, 200)), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(150)]
    rows += [(None, "en"), ("", None), (" \t\n", "de"), ("one", "de")] + [("New York City Hall. new york!", "en")] * 40
    return rows + [("say hello world again and again " * 3000, "en"), (noise(rng, 8000), "fr")]


@pytest.mark.parametrize(("threshold", "top", "chunk", "part"), [(30, 2000, 3 << 20, 32 << 20), (30, 25, 700, 2000), (3, 500, 5000, 300)])
def test_phrases(spark, table, threshold, top, chunk, part):
    """Whole documents, and chunks so small that long documents are cut and partitions are many."""
    df = spark.createDataFrame([(i, *r, *"abcdef") for i, r in enumerate(table)], SCHEMA).repartition(3)
    found = collocations.collocations(df, threshold=threshold, top=top, chunk=chunk, part=part).collect()
    assert sorted(map(tuple, found)) == expected(table, threshold, top)


def test_empty(spark, docs, no_docs):
    assert collocations.collocations(no_docs).collect() == []
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == expected(rows, 30, 2000)


def test_summary_keeps_what_is_frequent():
    """Whatever the order and however it is split and merged, nothing frequent is lost, and estimates stay in their bounds."""
    rng = np.random.default_rng(4)
    for threshold, splits in [(5, 1), (30, 1), (30, 7)]:
        keys = np.concatenate([rng.integers(0, 1 << 32, 40_000, dtype=np.uint32), np.repeat(rng.integers(0, 1 << 32, 300, dtype=np.uint32), rng.integers(1, 90, 300))])
        rng.shuffle(keys)
        true = dict(zip(*[x.tolist() for x in np.unique(keys, return_counts=True)], strict=True))
        parts = [collocations.Summary(len(keys) // threshold + 1) for _ in range(splits)]
        for at in range(0, len(keys), 500):
            own = parts[at // 500 % splits]
            own.add(*np.unique(keys[at : at + 500], return_counts=True))
            own.settle()
        for other in parts[1:]:
            parts[0].merge(other)
        have = dict(zip(parts[0].keys.tolist(), parts[0].counts.tolist(), strict=True))
        assert len(have) <= parts[0].capacity and 0 < parts[0].lost < threshold
        assert all(true[k] - parts[0].lost <= n <= true[k] for k, n in have.items())
        assert all(k in have for k, n in true.items() if n >= threshold)


def test_packed_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 5000, dtype=np.uint32))
    times = np.arange(len(keys)) + 1
    assert [x.tolist() for x in grams.unpack(grams.pack(keys, times))] == [keys.tolist(), times.tolist()]


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts whose products pass 64 bits: the same scores as Python's integers give."""
    a, left, right = 8_900_000_000_000_001, 9_000_000_000_000_007, 9_100_000_000_000_003
    counts = spark.createDataFrame([("en", 1, "x", left), ("en", 1, "y", right), ("en", 2, "x y", a)], "lang string, words int, phrase string, f long")
    totals = spark.createDataFrame([("en", 1 << 60)], "lang string, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: (counts, totals))
    found = collocations.collocations(None).collect()
    assert [tuple(r) for r in found] == [("en", 1, "x y", a, left, right, 1 << 60, 2_000_000 * a // (left + right))]


def test_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op12_collocations"](spark, sf_dir), connect(sf_dir), ORACLE["op12_collocations"]) is None


def test_counts_are_given_out_within_a_chunk(monkeypatch):
    monkeypatch.setattr(collocations, "STEP", 7)
    words = [f"w{i % 97}".encode() for i in range(3000)]
    chunk = grams.Words(["en"], np.array([len(words)]), 0, words)
    places, keys = collocations._phrase_keys(chunk)
    counts, total, most = {}, Counter(), 0
    for _ in collocations._count(chunk, places, np.ones(len(keys), dtype=bool), counts):
        most = max(most, sum(map(len, counts.values())))
        total.update(counts.get("en", {}))
        counts.clear()
    assert most <= 7
    expect = Counter(b" ".join(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    assert total == expect
