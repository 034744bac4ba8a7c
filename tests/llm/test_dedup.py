import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from oracle_check import connect, differences
from pyspark.sql import functions as F

from riskstream.llm import ann, components, exact, simhash
from riskstream.llm.queries import ORACLE, QUERIES


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def roots(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def plain_fingerprint(text):
    words = lower(text).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_classes(texts):
    prints = [plain_fingerprint(t) for _, t in texts]
    distinct = sorted(set(prints))
    links = [(a, b) for k, a in enumerate(distinct) for b in distinct[:k] if (a ^ b).bit_count() <= 4]
    root = roots(distinct, links)
    ids = defaultdict(list)
    for (i, _), p in zip(texts, prints, strict=True):
        ids[root[p]].append(i)
    least = {r: min((i for i in group if i is not None), default=None) for r, group in ids.items()}
    return Counter((i, f"{p:016x}", least[root[p]]) for (i, _), p in zip(texts, prints, strict=True))


def test_near_duplicates(spark, sf_dir, docs, texts, no_docs):
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == near_classes(texts)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bodies = [(r[0], r[1] or "") for r in table.select("doc_id", "text").collect()]
    assert Counter(map(tuple, simhash.near_duplicates(table).collect())) == near_classes(bodies)
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize(("cell_variants", "hot_rows"), [(1 << 20, 20_000), (3000, 4)])
def test_ball_links_lose_none(spark, cell_variants, hot_rows):
    rng = random.Random(4)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(rng.randint(0, 6)):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            values.add(v)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(x,) for x in signed.values()] * 2, "fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.ball_links(df, 4, cell_variants, hot_rows).collect()]
    every = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4]
    assert roots(values, links) == roots(values, every)


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(None) == 3


def test_keep_one_of_each_component(spark):
    """Ids on several texts, rows that repeat, and rows without an id."""
    bodies = [" ".join(f"{word}{n}" for n in range(40)) for word in ("ant", "bee", "cat", "dog")]
    rows = [
        (2, bodies[0], "a"), (5, bodies[0], "b"), (5, bodies[1], "c"),  # 5 is the only document of the second text
        (7, bodies[2], "d"), (7, bodies[2], "e"), (9, bodies[2], "f"), (7, bodies[3], "g"), (7, bodies[3], "g"),  # 7 names two components
        (None, bodies[0], "h"), (None, bodies[2].upper(), "i"), (None, "a text that no id has", "j"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [sorted(r["source"] for r in simhash.keep_one(d).collect()) for d in (df, df.repartition(5), df.filter("source < 'c' or source = 'f'"))]
    assert found[0] == found[1] and found[0] in (["a", "c", "d", "g", "j"], ["a", "c", "e", "g", "j"])
    assert found[2] == ["a", "f"]


def test_components(spark):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(60)]
    links = chain + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)] + [(500, 600 + i) for i in range(50)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == roots(nodes, links)


def exact_classes(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[lower(t)].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter(
        (i, best[lower(t)], len(groups[lower(t)]), i == best[lower(t)], hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in texts
    )


@pytest.mark.parametrize("key", [exact.md5_key, lambda t: F.length(t) % 2], ids=["md5", "colliding"])
def test_exact_classes(docs, texts, no_docs, key):
    assert Counter(map(tuple, exact.text_classes(docs, key=key).collect())) == exact_classes(texts)
    assert exact.text_classes(no_docs, key=key).count() == 0


def test_deduplicate(docs, texts, no_docs):
    kept = exact.deduplicate(docs)
    assert kept.columns == docs.columns
    found = Counter((r["doc_id"], lower(r["text"] or "")) for r in kept.select("doc_id", "text").collect())
    assert found == Counter({(k[1], t) for k, t in ((x, lower(t)) for (_, t) in texts for x in exact_classes(texts) if x[4] == hashlib.sha256(lower(t).encode()).hexdigest())})
    assert exact.deduplicate(no_docs).count() == 0


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op2_nearest_neighbours", "op5_exact_dedup"])
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def test_nearest_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(120)]
    rows += [(200 + i, rows[50][1]) for i in range(30)] + [(300 + i, [2 * x for x in rows[50][1]]) for i in range(5)]
    rows += [(7, rows[7][1]), (7, [-x for x in rows[7][1]]), (100, rows[3][1]), (50, [x + 0.01 for x in rows[50][1]])]
    odd = [(400, None), (450, [0.0] * 8), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] + [1.0] * 7), (403, [float("inf")] + [1.0] * 7), (404, []), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, v string").withColumn("row", F.lit("x"))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("vec_id", "cast(embedding as array<double>) v").collect()
    want = Counter()
    for own, (q, a) in enumerate(vectors):
        if q % 50 == 0:
            near = []
            for other, (i, b) in enumerate(vectors):
                if other != own:
                    dot = na = nb = 0.0
                    for x, y in zip(a, b, strict=True):
                        dot, na, nb = dot + x * y, na + x * x, nb + y * y
                    near.append((-min(1.0, max(-1.0, dot / (na * nb) ** 0.5)), i))
            want.update((q, k, i, -s) for k, (s, i) in enumerate(sorted(near)[:5], 1))
    assert max(want.values()) == 1 and sum(q == 50 for q, *_ in want) == 10  # both rows of a repeated query
    for blocks in ({}, {"query_block": 1, "candidate_block": 17}):
        got = Counter(tuple(r) for r in ann.nearest(df, **blocks).collect())
        assert {(q, k, i) for q, k, i, _ in got} == {(q, k, i) for q, k, i, _ in want}
        assert got == want
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.filter("vec_id in (0, 1, 2)")).count() == 2


def test_rows_that_repeat_an_id_equal_sql(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(int(i) % 60, [float(x) for x in rng.normal(size=4)]) for i in range(150)]
    folder = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    assert differences(QUERIES["op2_nearest_neighbours"](spark, str(tmp_path)), con, ORACLE["op2_nearest_neighbours"]) is None


@pytest.mark.parametrize("scale", [1e-200, 1e200])
def test_nearest_at_any_magnitude(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) * 2.0 ** (i % 5) for x in rng.integers(-9, 10, size=6)]) for i in range(101)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    far = df.selectExpr("vec_id", f"transform(embedding, x -> x * {scale:e}D) AS embedding")
    plain, scaled = ({(r.query_id, r.rank): r for r in ann.nearest(d).collect()} for d in (df, far))
    assert plain.keys() == scaled.keys() and len(plain) == 15
    assert all(abs(plain[k].score - scaled[k].score) < 1e-12 for k in plain)
