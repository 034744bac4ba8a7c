import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskstream.llm import bytespans, passages, substring


def repeated_mask(seqs, times, window):
    seen = Counter()
    for s, n in zip(seqs, times, strict=True):
        for i in range(len(s) - window + 1):
            seen[tuple(s[i : i + window])] += n
    masks = []
    for s in seqs:
        steps = [0] * (len(s) + 1)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                steps[i] += 1
                steps[i + window] -= 1
        masks.append((np.cumsum(steps[:-1]) > 0).tolist())
    return masks


def mask_of(spans, n):
    mask = [False] * n
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        mask[a:b] = [True] * (b - a)
    return mask


def cases():
    rng = random.Random(11)
    for _ in range(60):
        window, letters = rng.choice([3, 4, 6]), "abcdefgh"[: rng.choice([2, 3, 8])]
        seqs = [[rng.choice(letters) for _ in range(rng.randint(window, 4 * window))] for _ in range(rng.randint(1, 7))]
        seqs.append(seqs[0][1:] + ["q"])
        yield window, seqs, [rng.choice([1, 1, 2]) for _ in seqs]


def test_fm_index_finds_repeats():
    for window, seqs, times in cases():
        found = substring.covered_by_repeats(times, [" ".join(s).encode() for s in seqs], window)
        assert [mask_of(f, len(s)) for f, s in zip(found, seqs, strict=True)] == repeated_mask(seqs, times, window)


@pytest.mark.parametrize("most", [1, 2, 50])
def test_column_transform_finds_repeats(most):
    for window, seqs, times in cases():
        found = bytespans.covered_by_repeats(times, ["".join(s).encode() for s in seqs], window, most)
        assert [mask_of(f, len(s)) for f, s in zip(found, seqs, strict=True)] == repeated_mask(seqs, times, window)


def test_columns_are_the_transform_and_common_prefixes():
    texts = [[3, 1, 3, 1, 2], [1, 3, 1], [2, 2, 2, 2]]
    columns = bytespans.Columns(len(texts), 200)
    for done in range(5):
        on = np.array([i for i, t in enumerate(texts) if len(t) > done])
        at = [len(texts[i]) - 1 - done for i in on]
        before = np.array([texts[i][a - 1] if a else -1 for i, a in zip(on, at, strict=True)])
        columns.insert(on, np.array([texts[i][a] for i, a in zip(on, at, strict=True)]), before, np.array(at))
    suffixes = sorted((t[a:] + [-1, k], t[a - 1] if a else -1) for k, t in enumerate(texts) for a in range(len(t) + 1))
    suffixes = [(s[:-2], b) for s, b in sorted((t[a:] + [-1, k], t[a - 1] if a else -1) for k, t in enumerate(texts) for a in range(len(t) + 1))]
    common = [0] + [next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for (a, _), (b, _) in zip(suffixes, suffixes[1:], strict=False)]
    assert columns.transform.tolist() == [b for _, b in suffixes]
    assert columns.common.tolist() == common


def test_wavelet_rank():
    rng = np.random.default_rng(3)
    s = rng.integers(0, 23, 500)
    tree = substring.WaveletTree(s, 23)
    c, p = rng.integers(0, 23, 300), rng.integers(0, 501, 300)
    assert tree.rank(c, p).tolist() == [int((s[:b] == a).sum()) for a, b in zip(c, p, strict=True)]


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 3, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    anchor, first, size, times = passages.segments(h, 12, 3)
    windows = {}
    for a, f, s in zip(anchor.tolist(), first.tolist(), size.tolist(), strict=True):
        for i in range(f, f + s - 11):
            assert windows.setdefault(h[i : i + 12].tobytes(), a) == a
    assert sum(s - 11 for s in size) == len(h) - 11
    grams = passages.run_hashes(h, 3)
    assert times.tolist() == [int((grams[f : f + s - 2] == a).sum()) for a, f, s in zip(anchor, first, size, strict=True)]


def expected_words(texts, window):
    words = [t.encode().split() for _, t in texts]
    masks = repeated_mask(words, [1] * len(words), window)
    return Counter(
        (i, len(w), sum(m), hashlib.sha256(b" ".join(x for x, out in zip(w, m, strict=True) if not out)).hexdigest())
        for (i, _), w, m in zip(texts, words, masks, strict=True)
    )


def expected_bytes(texts, window):
    bodies = [t.encode() for _, t in texts]
    seen = Counter(b[i : i + window] for b in bodies for i in range(len(b) - window + 1))
    out = Counter()
    for (key, _), b in zip(texts, bodies, strict=True):
        steps = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                steps[i] += 1
                steps[i + window] -= 1
        mask = np.cumsum(steps[:-1]) > 0
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        kept = bytes(x for x, gone in zip(b, mask, strict=True) if not gone)
        out[(key, len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [substring.HOT, 1])
def test_words(docs, texts, hot):
    found = substring.substring_digest(substring.remove_repeats(docs, hot=hot)).collect()
    assert Counter(map(tuple, found)) == expected_words(texts, 35)


@pytest.mark.parametrize("hot", [bytespans.HOT, 1])
def test_bytes(docs, texts, hot):
    found = bytespans.bytespan_digest(bytespans.remove_repeats(docs, hot=hot)).collect()
    assert Counter(map(tuple, found)) == expected_bytes(texts, 400)


def test_all_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r["doc_id"], r["text"] or "") for r in table.select("doc_id", "text").collect()]
    assert Counter(map(tuple, bytespans.bytespan_digest(bytespans.remove_repeats(table)).collect())) == expected_bytes(texts, 400)


def test_texts_that_share_a_row_hash_keep_their_own_words(spark, monkeypatch):
    rng = random.Random(4)
    some = lambda n: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    shared = some(90)
    texts = [(1, f"{some(20)} {shared}"), (2, f"{shared} {some(30)}"), (3, some(200)), (4, some(120)), (5, shared), (6, "")]
    sized = passages._sized
    monkeypatch.setattr(passages, "_sized", lambda *a: sized(*a).withColumn("row", F.lit(7).cast("long")))
    table = spark.createDataFrame(texts, "doc_id long, text string")
    assert Counter(map(tuple, substring.substring_digest(substring.remove_repeats(table)).collect())) == expected_words(texts, 35)
    assert Counter(map(tuple, bytespans.bytespan_digest(bytespans.remove_repeats(table)).collect())) == expected_bytes(texts, 400)


def test_empty(no_docs):
    assert substring.remove_repeats(no_docs).count() == 0
    assert bytespans.remove_repeats(no_docs).count() == 0
