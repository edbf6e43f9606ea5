"""Extra columns with the names that operators use themselves are carried along and change nothing."""
import ast
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, linededup, neardup, sharding

PACKAGE = pathlib.Path(neardup.__file__).parent
# every string in the package that looks like a helper column
HELPERS = sorted({n.value for f in PACKAGE.glob("*.py") for n in ast.walk(ast.parse(f.read_text()))
                  if isinstance(n, ast.Constant) and isinstance(n.value, str) and re.fullmatch(r"_[a-z]\w*", n.value)})


@pytest.fixture(scope="module")
def both(docs):
    plain = docs.select("doc_id", "text")
    return plain, plain.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in HELPERS])


def rows(df, columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


@pytest.mark.parametrize("name, run, added", [
    ("lines", lambda d, i: linededup.dedup_lines(d), ["n_lines", "n_removed", "removed"]),
    ("near", lambda d, i: neardup.keep_one(d), []),
    ("leaks", decontam.clean, []),
    ("shards", lambda d, i: sharding.shard(d, order=("doc_id", "text")), ["shard"]),
])
def test_helper_names_as_extra_columns(spark, both, name, run, added):
    items = spark.createDataFrame([(1, both[0].where("doc_id = 2").first().text)], "item_id long, text string")
    plain, extra = (run(d, items) for d in both)
    assert {"_gone_id", "_keep_id", "_leak_id", "_from", "_a", "_slot", "_rank", "_salt"} <= set(HELPERS)
    assert set(HELPERS) <= set(extra.columns)
    assert rows(plain, ["doc_id", "text", *added]) == rows(extra, ["doc_id", "text", *added])
    for c in HELPERS[:3] + HELPERS[-3:]:
        assert extra.where(~F.col(c).eqNullSafe(F.concat(F.lit(c), F.col("doc_id").cast("string")))).isEmpty()


def test_scores_carry_helper_names(both):
    learn = F.lit(True)
    langs, weights = langid.fit(both[1].withColumn("lang", F.lit("x")), learn)
    assert set(HELPERS) <= set(langid.predict(both[1], langs, weights).columns)
