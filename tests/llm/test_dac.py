"""Directly addressable codes: exact round trips, random access, documents read back from files."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import dac
from tessera.llm.tokens import encoder, tokenizer_path
from tessera.session import scratch_dir


@pytest.mark.parametrize("widths", [(8, 8, 16), (16, 16), (32,), (8, 8, 8, 8)])
@pytest.mark.parametrize("n", [1, 63, 64, 511, 512, 513, 5000])
def test_round_trip_and_random_access(n, widths):
    rng = np.random.default_rng(n)
    ids = (2 ** rng.uniform(0, 32, n)).astype(np.uint32)
    levels = dac.encode(ids, widths)
    assert (dac.decode(levels) == ids).all()
    at = rng.integers(0, n, 200)
    assert (dac.access(levels, at) == ids[at]).all()


def test_files(spark, docs, rows, monkeypatch):
    path = scratch_dir(spark, "dac-test")
    dac.write(docs, path, parts=4)
    got = dac.read_documents(spark, path, with_ids=True).orderBy("start").collect()
    enc = encoder(tokenizer_path("word_bpe_49k.json"))
    own = lambda t: np.array(enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
    want = sorted(((i is not None, i or 0, own(t)) for i, t in rows))
    have = sorted(((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got))
    assert have == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.n_tokens
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(i for i, _ in rows if i is not None)
    stream = np.frombuffer(b"".join(r.ids for r in got), "<u4")
    asked = spark.range(0, at + 50, 7).select(F.col("id").alias("position"))
    found = dac.tokens_at(spark, path, asked).collect()
    assert {r.position: r.token for r in found} == {int(p): int(stream[p]) for p in range(0, at, 7)}


def test_empty(spark, empty):
    path = scratch_dir(spark, "dac-empty")
    dac.write(empty, path, parts=2)
    assert dac.read_documents(spark, path).count() == 0
