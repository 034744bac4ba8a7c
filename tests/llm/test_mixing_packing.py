from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from riskstream.llm import exact, mixing, packing, quality, simhash
from riskstream.llm.queries import ORACLE, QUERIES


def test_mixing_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op7_mixing"](spark, sf_dir), connect(sf_dir), ORACLE["op7_mixing"]) is None


@pytest.mark.parametrize("sizes", [[100, 1, 1, 50, 30], [5, 5, 5], [0, 0, 9], [0], [1000] + [1] * 20])
def test_targets(spark, sizes):
    rows = [(f"s{i:02}" if i else None, n) for i, n in enumerate(sizes)]
    found = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    order = sorted((s for s, _ in rows if s), key=str) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free, left = {}, dict(rows), float(sum(sizes))
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] > 3 * free[s]]
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 3.0 * free.pop(s)
            left -= target[s]
    assert found == pytest.approx(target)


def test_mix_follows_its_plan(docs, no_docs):
    plan = mixing.mix_plan(docs)
    again = mixing.mix_plan(docs.repartition(5))
    assert Counter(map(tuple, plan.collect())) == Counter(map(tuple, again.collect()))
    assert plan.filter("taken > 3 * size").count() == 0 and plan.count() == docs.count()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert mixing.mix_plan(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_sizes_are_words(docs, texts):
    assert Counter(map(tuple, mixing.mix_plan(docs).select("doc_id", "size").collect())) == Counter((i, len(t.encode().split())) for i, t in texts)


def test_cuts():
    for n in [*range(1, 2100), 4096, 5000, 99_999]:
        pieces = packing.cuts(n)
        assert sum(pieces) == n
        assert all(p * (2048 // p) >= 0.98 * 2048 for p in pieces)


def check_packing(df, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, t in docs:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        want[(i, ids.tobytes())] += 1
    rows = df.collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] == len(r["ids"]) // 4
    assert sum(len(b) for group in pieces.values() for _, b in group) == sum(len(b) * n for (_, b), n in want.items())
    single = {key: group for key, group in pieces.items() if sum(len(b) for _, b in group) == 4 * key[1]}
    for (i, n), group in single.items():
        assert want[i, b"".join(b for _, b in sorted(group))] == 1 and len(group) == len(packing.cuts(n))
    for group in bins.values():
        at = 0
        for offset, length in sorted(group):
            assert offset == at
            at += length
        assert at <= 2048
    filled = [sum(n for _, n in group) for group in bins.values()]
    return sum(filled), sum(n if n & (n - 1) == 0 else 2048 for n in filled)


def test_packing_edges(docs, texts, no_docs):
    check_packing(packing.pack(docs), texts)
    assert packing.pack(no_docs).count() == 0


def packed_ids(spark, text):
    """The ids that pack() gives to a document of this text, without its end."""
    rows = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("start").collect()
    ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in rows), dtype="<u4").tolist()
    assert {r["doc_tokens"] for r in rows} == {len(ids)} and ids[-1] == packing.END_ID
    return ids[:-1]


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n <|endoftext", "<|ENDOFTEXT|> é"])
def test_packing_reads_added_tokens(spark, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packed_ids(spark, text) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_200_000, "a" + "\n" * 2_000_000 + "b", "a b " * 60_000 + "\t \u2003\x85" * 300_000 + "end"])
def test_packing_reads_long_white_space(spark, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packed_ids(spark, text) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rest", [packing.REST, 40])
def test_packing_round_trip(spark, sf_dir, rest):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(6)
    used, padded = check_packing(packing.pack(table, rest=rest), [(r[0], r[1] or "") for r in table.select("doc_id", "text").collect()])
    assert used > 0.95 * padded


def test_quality_learns(spark, sf_dir, docs, no_docs):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    table, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(table, labels)
    rows = quality.score(table, model).filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    for label in (0, 1):
        assert np.mean([r["predicted"] == label for r in rows if r["quality"] == label]) > 0.9
    scored = quality.score(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.score(no_docs, model).count() == 0
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    # what is not the text, and held-out labels, change nothing
    other = table.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.train(other, flipped).weights == model.weights).all()


def test_quality_without_usable_labels(spark, docs):
    labels = spark.createDataFrame([(None, 1), (1, None), (3, 1), (3, 0), (9, 1)], "doc_id long, quality int")
    assert quality.train(docs, labels) is None
    assert quality.keep_good(docs, None).columns == docs.columns


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 200)
    rows = [np.unique(np.concatenate((rng.integers(0, 500, 20), [1000 + y]))).astype(np.int32) for y in labels]
    model = quality.fit(rows, labels)
    assert [model.score(r) >= 0.5 for r in rows] == (labels == 1).tolist()
    assert quality.fit(rows, np.ones(200, dtype=int)) is None


def test_pipeline(spark, sf_dir):
    """Each stage against plain Python over the rows that it was given."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], sf_dir).cache())
    rows = [[r.asDict() for r in df.collect()] for df in seen]
    assert all(df.columns == docs.columns for df in seen[:-1])
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    table = np.zeros(quality.PLACES, dtype=bool)
    good = {r["doc_id"] for r in rows[0] if model.score(quality.features((r["text"] or "").encode(), table)) >= 0.5}
    assert {r["doc_id"] for r in rows[1]} == good
    best = {}
    for r in rows[1]:
        text = exact_text(r["text"])
        best[text] = max(best.get(text, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(best.values())
    prints = {r["doc_id"]: simhash.fingerprint(exact_text(r["text"]).encode()) for r in rows[2]}
    least = {i: i for i in prints}
    for _ in prints:
        after = {i: min(least[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 4) for i in prints}
        if after == least:
            break
        least = after
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(set(least.values()))
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(seen[3]).collect()}
    assert Counter(r["doc_id"] for r in rows[4]) == Counter({i: n for i, n in plan.items() if n})
    size = Counter()
    for r in rows[5]:
        size[r["doc_id"]] += r["length"]
    assert all(size[i] == plan[i] * next(r["doc_tokens"] for r in rows[5] if r["doc_id"] == i) for i in size)
    assert set(size) == {i for i, n in plan.items() if n}
    assert corpus_pipeline.run(spark, sf_dir).count() == len(rows[5])


def exact_text(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_stages_on_edge_rows(spark, docs, no_docs, sf_dir):
    for table in (docs, no_docs):
        at = table
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, sf_dir)
        at.collect()
    assert exact.deduplicate(docs).columns == docs.columns
