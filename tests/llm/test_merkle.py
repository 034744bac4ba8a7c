import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F

from riskstream.llm import merkle
from riskstream.llm.queries import ORACLE, QUERIES


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def walk(levels, i, node, fanout):
    """The siblings of leaf i, and the root that `node` in its place gives."""
    beside = []
    for level in levels[:-1]:
        run = range(i - i % fanout, min(i - i % fanout + fanout, len(level)))
        beside += [level[k] for k in run if k != i]
        node = sha(*[node if k == i else level[k] for k in run])
        i //= fanout
    return beside, node


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def expected(rows, fanout=3):
    trees = defaultdict(list)
    for r in rows:
        text = r["text"]
        if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        head = [encoded(r[c]) for c in ("doc_id", "source", "lang", "n_chars")]
        trees[r["source"]].append((r["doc_id"], sha(*head, encoded(r["text"])), sha(*head, encoded(text))))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    own = {s: levels_of([r[1] for r in trees[s]], fanout) for s in order}
    top = levels_of([own[s][-1][0] for s in order], fanout)
    out = Counter()
    for k, s in enumerate(order):
        for i, (doc_id, leaf, other) in enumerate(trees[s]):
            beside, node = walk(own[s], i, other, fanout)
            above, node = walk(top, k, node, fanout)
            out[(doc_id, leaf, own[s][-1][0], top[-1][0], sha(*beside, *above), node, node == top[-1][0])] += 1
    return out


@pytest.mark.parametrize(("fanout", "stride"), [(3, 5), (3, 1), (2, 2), (5, 1)])
def test_proofs(docs, fanout, stride):
    found = merkle.merkle_digest(docs, fanout, stride).collect()
    assert Counter(map(tuple, found)) == expected([r.asDict() for r in docs.collect()], fanout)


def test_tree_of_many_strides(spark):
    """Leaves of one hot source and of one with a power of the fanout; several stored levels."""
    rows = spark.range(2200).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") < 1459, "b").otherwise("ä").alias("source"),
        F.lit("en").alias("lang"), F.lit(3).cast("long").alias("n_chars"), F.concat(F.lit("a\nb"), F.col("id").cast("string")).alias("text"),
    )
    for stride in (2, 5):
        found = merkle.merkle_digest(rows, stride=stride).collect()
        assert Counter(map(tuple, found)) == expected([r.asDict() for r in rows.collect()])
    stored = merkle.manifest(rows, stride=2).sources
    assert [level.agg(F.max("n")).first()[0] for level in stored][:3] == [1466, 163, 19]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_small_tables(spark, n):
    rows = [(i, None, None, None, None if i else "") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(map(tuple, merkle.merkle_digest(df).collect())) == expected([r.asDict() for r in df.collect()])


def test_long_text(spark):
    rows = [(4, "a", "en", 1, "word\n" * 600_000), (5, "a", None, None, "x" * 2_000_000), (None, "", "en", 0, "\n")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(map(tuple, merkle.merkle_digest(df).collect())) == expected([r.asDict() for r in df.collect()])


def test_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op13_merkle_manifest"](spark, sf_dir), connect(sf_dir), ORACLE["op13_merkle_manifest"]) is None
