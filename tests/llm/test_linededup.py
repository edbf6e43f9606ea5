"""Line dedup against a plain walk, on hostile rows; native plan; SQL on a driver table."""
import random
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tessera.llm import linededup
from tessera.llm.queries import ORACLE, QUERIES


def walk(rows):
    """(doc_id, text) after removing later windows; documents in (doc_id, text) order, equal rows once."""
    docs = sorted({(d is not None, d or 0, t) for d, t in rows if t is not None})
    seen, out = set(), {}
    for has, d, t in docs:
        lines = t.split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for k in range(len(solid) - 2):
            w = tuple(lines[solid[k + j]].strip(" \t\r") for j in range(3))
            if w in seen:
                gone.update((k, k + 1, k + 2))
            seen.add(w)
        kept, cut = [], False
        for i, x in enumerate(lines):
            if i in solid:
                cut = solid.index(i) in gone
            if not cut:
                kept.append(x)
        out[(d if has else None, t)] = "\n".join(kept)
    return Counter((d, out.get((d, t)) if t is not None else None) for d, t in rows)


def test_equals_walk(spark, rows, docs):
    got = linededup.dedup_lines(docs)
    assert got.columns[:9] == [c for c in docs.columns if c != "n_lines"] + ["n_lines"]
    # documents that share a doc_id are ordered by a hash of their text: leave those out of the walk
    alone = [r for r in rows if r[0] != 8 and r[0] is not None]
    want = walk(alone)
    have = Counter((r.doc_id, r.text) for r in got.where("doc_id is not null and doc_id <> 8").collect())
    assert have == want


def test_overlaps_blanks_and_repeats_inside(spark):
    rng = random.Random(4)
    lines = ["a", " b ", "c", "d", "", "  ", "e", "f"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(300)]
    rows += [(900, "x\ny\nz\n\nx\ny\nz\n"), (901, "x\ny\nz"), (902, "k\n" * 40), (903, None), (904, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.dedup_lines(df)
    have = got.collect()
    assert Counter((r.doc_id, r.text) for r in have) == walk(rows)
    for r, t in ((r, dict(rows)[r.doc_id]) for r in have):
        n = 0 if t is None else len(t.split("\n"))
        assert r.n_lines == n and r.n_removed == sum(b - a for a, b in r.removed)
        if t is not None:
            gone = {i for a, b in r.removed for i in range(a, b)}
            assert "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone) == r.text
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_and_sql(spark, empty, sf_dir):
    assert linededup.dedup_lines(empty).count() == 0
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = sorted(con.sql(ORACLE["op5_line_dedup"]).fetchall(), key=repr)
    got = QUERIES["op5_line_dedup"](spark, sf_dir).select("doc_id", "text", F.col("n_lines"), "n_removed")
    assert sorted(map(tuple, got.collect()), key=repr) == want
