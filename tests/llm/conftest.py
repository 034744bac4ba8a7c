import pytest
from pyspark.sql import functions as F

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


def passage(n, step=1, start=0):
    return " ".join(f"{WORDS[(start + i * step) % len(WORDS)]}{(start + i * step) % 97}" for i in range(n))


#: Nulls in every column, empty and long texts, repeated rows and ids, copies that differ in case, odd white space.
ROWS = [
    (1, passage(120), "en", "b"), (2, passage(120).upper(), "en", "b"), (3, passage(120), "en", "a"), (3, passage(120), "en", "a"),
    (4, None, "en", "a"), (5, "", None, None), (None, "no id here", "en", "a"), (None, passage(60, 3, 11), None, None),
    (None, passage(60, 3, 11), None, None), (6, "x" * 3000, "en", "ä"), (7, "  \t\n ", "en", "z"), (8, "one", "en", "z"),
    (9, passage(5000, 7, 3) + " " + passage(80) + " ends", "en", "b"), (10, "a " * 400, "en", "b"),
    (11, "café au lait İ KK \U0001f600 " + passage(90, 1, 4), "fr", "z"),
    (12, passage(300, 5, 2).replace("sit", "zit"), "de", "a"), (13, passage(300, 5, 2), "de", "a"), (8, "another text of id eight", "en", "b"),
]

#: Names that operators use inside; their docs must be allowed to have them too.
CLASHING = ["row", "key", "norm", "anchor", "seg", "at", "n", "size", "kept", "doc", "id", "fp", "list", "packed", "copy", "number", "target", "label", "score"]


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHING}).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def texts():
    return [(i, t or "") for i, t, _, _ in ROWS]
