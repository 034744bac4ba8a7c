import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle_check import connect, differences

from riskstream.llm import jaccard
from riskstream.llm.queries import ORACLE, QUERIES


def shingle_set(text, length=5):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1)))


def expected(rows, similarity=80):
    """doc_id, n_shingles, component_id by comparing all pairs of different sets."""
    sets = [shingle_set(t) for _, t in rows]
    distinct = [s for s in dict.fromkeys(sets) if s]
    up = {s: s for s in distinct}

    def top(s):
        while up[s] is not s:
            s = up[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if min(len(a), len(b)) * 100 >= similarity * max(len(a), len(b)) and 100 * len(a & b) >= similarity * len(a | b):
                up[top(a)] = top(b)
    ids = defaultdict(list)
    for (key, _), s in zip(rows, sets, strict=True):
        if s:
            ids[top(s)].append(key)
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in ids.items()}
    return Counter((key, len(s), least[top(s)] if s else key) for (key, _), s in zip(rows, sets, strict=True))


def near_copies(rng, base, edits, vocabulary):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


@pytest.fixture(scope="module")
def table():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "One", "two words", "a b c d", "a b c d e", "a B c d e"]
    for size in (6, 12, 30, 60, 200, 700):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(size)]
            texts += [" ".join(near_copies(rng, base, rng.randint(0, max(1, size // 25)), vocabulary)) for _ in range(rng.randint(1, 12))]
    base = [rng.choice(vocabulary) for _ in range(80)]
    texts += [" ".join(near_copies(rng, base, rng.randint(0, 3), vocabulary)) for _ in range(60)]
    line = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts += [f"{line} {' '.join(rng.choice(vocabulary) for _ in range(rng.randint(5, 30)))}" for _ in range(50)]
    chain = [rng.choice(vocabulary) for _ in range(130)]
    texts += [" ".join(chain[4 * i : 4 * i + 60]) for i in range(17)]
    texts += [texts[20]] * 30 + ["long " * 50_000, " ".join(rng.choice(vocabulary) for _ in range(60_000))]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[25]), (None, None), (3, "another text of id three"), (5000, texts[-1] + " more")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "options",
    [{}, {"rare": 1, "large": 40, "open_pairs": 0}, {"rare": 3, "large": 400, "open_pairs": 2, "chunk": 4000, "part": 20_000, "similarity": 70}],
)
def test_components(spark, table, options):
    """Rare and frequent shingles, combinations and single ones, rounds of centres and open pairs: no link is lost."""
    df = spark.createDataFrame([(*r, *"abcdefg") for r in table], "doc_id long, text string, place long, n string, tags string, chunk string, sig string, h1 string, least string".replace("place long", "place string"))
    found = jaccard.similar_documents(df.repartition(3), **options).collect()
    assert Counter(map(tuple, found)) == expected(table, options.get("similarity", 80))


def test_edges(docs, no_docs, texts):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(map(tuple, jaccard.similar_documents(docs).collect())) == expected(rows)
    assert jaccard.similar_documents(no_docs).collect() == []


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(5, 60))
        pool = rng.permutation(1 << 16)[: 2 * n].astype(np.uint64)
        level = dict(zip(pool.tolist(), rng.integers(1, 9, len(pool)).tolist(), strict=True))
        x = pool[:n]
        gone = int(rng.integers(0, max(1, n // 6)))
        y = np.concatenate((x[gone:], pool[n : n + int(rng.integers(0, max(1, n // 6)))]))
        if 100 * len(set(x.tolist()) & set(y.tolist())) < 80 * len(set(x.tolist()) | set(y.tolist())):
            continue
        found = []
        for s in (x, y):
            c = np.array([level[k] for k in s.tolist()], dtype=np.uint8)
            order = np.lexsort((s, c))
            found.append({int(v) for v in jaccard.signatures(s[order], c[order], 80, int(rng.integers(0, 1)) + 4, 30)[0]})
        assert found[0] & found[1]


def test_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op11_jaccard_join"](spark, sf_dir), connect(sf_dir), ORACLE["op11_jaccard_join"]) is None
