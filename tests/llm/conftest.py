"""Small hostile tables for the training-data operators."""
import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("score", T.StringType()), T.StructField("_tie", T.LongType()),
    T.StructField("shard", T.StringType()), T.StructField("n_lines", T.StringType())])

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau "
         "upsilon phi chi psi omega red green blue north south east west").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def make_rows(seed=0, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "\n".join(prose(rng, rng.randint(4, 12)) for _ in range(rng.randint(1, 9)))
        rows.append((i, text))
    base = rows[3][1]
    words = base.split(" ")
    for k in range(6):                              # near copies with a few words changed
        changed = list(words)
        for _ in range(k):
            changed[rng.randrange(len(changed))] = "x" + str(rng.randint(0, 10 ** 6))
        rows.append((100 + k, " ".join(changed)))
    rows += [(200 + k, rows[5][1]) for k in range(5)]                       # exact copies
    rows += [(300, None), (301, ""), (302, "   \n\t "), (303, "one"), (304, "One"), (305, "two words")]
    rows += [(None, "no id here at all, really none"), (None, None), (7, rows[7][1]), (8, "same id, other text")]
    rows += [(400, prose(rng, 6000)), (401, "é" * 3000), (402, "%%% 123 ..."), (403, "日本語のテキスト")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    langs = ["en", "fr", None]
    return spark.createDataFrame(
        [(i, t, langs[k % 3], None if k % 5 else "src", len(t or ""), "s", k, "sh", "nl")
         for k, (i, t) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
