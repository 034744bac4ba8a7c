"""Quality scores by a linear model on n-gram indicators scaled by class log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Rows, rows_of, schema_of, whole

#: Features are hashed to so many places; the last ones are named.
PLACES = 1 << 18
_SAME_TWICE, _SAME_THRICE, _SAME_OFTEN, _FEW_WORDS, _BIAS = range(PLACES - 5, PLACES)
#: The model is fitted on at most so many labelled documents, chosen by a hash of their id.
MOST_TRAINING = 6000
COST, ROUNDS, SMOOTHING = 1.0, 20, 1.0


def features(text: bytes, table: np.ndarray) -> np.ndarray:
    """The places of a text's n-grams: 3 bytes, and words that repeat the one before.

    table: PLACES zeros, given back as such; marks each place once.
    """
    b = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    for at in range(0, max(len(b) - 2, 0), 1 << 20):
        part = b[at : at + (1 << 20) + 2]
        grams = (part[:-2] << np.uint32(16)) | (part[1:-1] << np.uint32(8)) | part[2:]
        table[((grams * np.uint32(2654435761)) >> np.uint32(14)) % np.uint32(PLACES - 5)] = True
    words = text.split()
    same = list(map(eq, words, words[1:]))
    if True in same:
        table[_SAME_TWICE] = True
        table[_SAME_THRICE] = any(map(lambda a, b: a and b, same, same[1:]))
        table[_SAME_OFTEN] = sum(same) > len(words) / 4
    table[_FEW_WORDS] = len(words) < 3
    table[_BIAS] = True
    found = np.flatnonzero(table)
    table[found] = False
    return found.astype(np.int32)


@dataclass(frozen=True)
class Model:
    """weights: by place, ratios included; a margin m gives the score 1 / (1 + exp(-(slope * m + shift)))."""

    weights: np.ndarray
    slope: float
    shift: float

    def score(self, places: np.ndarray) -> float:
        m = float(self.weights[places].sum(dtype=np.float64)) / max(1.0, len(places)) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(self.slope * m + self.shift, -500, 500))))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Naive Bayes: for each place, the log of its smoothed share of the indicators of class 1 over that of class 0."""
    counts = np.full((2, PLACES), smoothing)
    for places, label in zip(rows, labels, strict=True):
        counts[label, places] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratios[_BIAS] = 1.0
    return ratios


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = COST, rounds: int = ROUNDS, seed: int = 0) -> Model | None:
    """Hinge loss by dual coordinate descent on ratio-scaled indicators of unit-free length; None if a class is missing.

    Each step solves one row's dual variable exactly, between 0 and the cost of
    its class, which weighs both classes alike. Rows are visited in a seeded order.
    """
    if len(set(labels.tolist())) < 2:
        return None
    ratios = log_ratios(rows, labels)
    signs = np.where(labels == 1, 1.0, -1.0)
    limit = cost * len(labels) / (2 * np.where(labels == 1, (labels == 1).sum(), (labels == 0).sum()))
    scaled = [ratios[places] / max(1.0, len(places)) ** 0.5 for places in rows]
    square = np.array([max(float(x @ x), 1e-12) for x in scaled])
    w, alpha = np.zeros(PLACES), np.zeros(len(labels))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(labels)):
            places, x = rows[i], scaled[i]
            gap = signs[i] * float(w[places] @ x) - 1
            new = min(max(alpha[i] - gap / square[i], 0.0), limit[i])
            if new != alpha[i]:
                w[places] += (new - alpha[i]) * signs[i] * x
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    margins = np.array([float(w[places] @ x) for places, x in zip(rows, scaled, strict=True)])
    slope, shift = _sigmoid(margins, labels)
    return Model((w * ratios).astype(np.float32), slope, shift)


def _sigmoid(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """A logistic curve of the margins by Newton steps, both classes weighing alike, with targets short of 0 and 1."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    weight = np.where(labels == 1, 0.5 / ones, 0.5 / zeros)
    p = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(steps):
        s = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        hess = (x * (weight * s * (1 - s))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (weight * (s - target)) + 1e-6 * p)
        p = p - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(p[0]), float(p[1])


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINING, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model | None:
    """The model of at most `most` labelled documents that are not held out; None if a class has none.

    Labels other than 0 and 1, labels without an id, and ids with both labels
    are ignored. The chosen ids are bounded, so they are broadcast; features
    are made where the documents are read, and one task fits the model.
    """
    marked = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    marked = marked.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("id")))
    marked = marked.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other")
    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(most).select("id", "label")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), whole(text).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id").select("id", "label", "text")
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("places", pa.binary())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, table = Rows(schema), np.zeros(PLACES, dtype=bool)
        for key, mark, body in rows_of(batches):
            places = features(body.encode("utf-8", "surrogatepass"), table).tobytes()
            out.add((key, mark, places), len(places))
            if out.full():
                yield out.take()
        yield out.take()

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(parts)
        if not held:
            return
        rows = pd.concat(held).sort_values(["id", "label"]).drop_duplicates("id")
        model = fit([np.frombuffer(p, dtype=np.int32) for p in rows["places"]], rows["label"].to_numpy())
        if model is not None:
            yield pd.DataFrame({"weights": [model.weights.tobytes()], "slope": [model.slope], "shift": [model.shift]})

    found = rows.mapInArrow(extract, schema_of("id long, label int, places binary"))
    fitted = found.repartition(1).mapInPandas(learn, "weights binary, slope double, shift double").collect()
    return Model(np.frombuffer(bytes(fitted[0][0]), dtype=np.float32), fitted[0][1], fitted[0][2]) if fitted else None


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    The score depends on the whole text alone; null and empty texts are scored
    like others, by the few features they have. Without a model all scores are
    0.5. A null doc_id is not held out. Repeated rows get equal scores, an empty
    table gives no rows, other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # PLACES numbers, whatever the corpus

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, table, known = Rows(schema), np.zeros(PLACES, dtype=bool), sent.value
        for key, held, body in rows_of(batches):
            places = features(body.encode("utf-8", "surrogatepass"), table)
            out.add((key, held, known.score(places) if known else 0.5))
            if out.full():
                yield out.take()
        yield out.take()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), is_held_out(F.col(doc_id)).alias("held_out"), whole(text).alias("text"))
    rated = rows.mapInArrow(rate, schema_of("doc_id long, held_out boolean, score double"))
    return rated.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model | None, least: float = 0.5, text: str = "text") -> DataFrame:
    """The documents, with all columns, whose score is at least `least`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, known = np.zeros(PLACES, dtype=bool), sent.value
        for bodies in parts:
            scores = [known.score(features(b.encode("utf-8", "surrogatepass"), table)) if known else 0.5 for b in bodies]
            yield pd.Series(scores, dtype="float64")

    rows = docs.select(F.struct("*").alias("doc"), whole(text).alias("text"))
    return rows.withColumn("score", rate("text")).filter(F.col("score") >= least).select("doc.*")
