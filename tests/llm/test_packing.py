"""Packing: exact placement rules, near the lower bound, and the planner against plain best fit."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import packing
from tessera.llm.tokens import encoder, tokenizer_path


def plain_best_fit(lengths, capacity):
    """Sequences used by best-fit decreasing, document by document."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(capacity - x)
    return len(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_plain_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 32, 100])
    lengths = [min(capacity, max(1, int(rng.expovariate(3 / capacity)) + 1)) for _ in range(rng.randint(0, 400))]
    runs, n = packing.plan_best_fit(dict(Counter(lengths)), capacity)
    assert n == plain_best_fit(lengths, capacity)
    used, placed = defaultdict(list), Counter()
    for length, first, last, per, seq, off in runs:
        for r in range(first, last):
            placed[length] += 1
            used[seq + (r - first) // per].append((off + (r - first) % per * length, length))
    assert placed == Counter(lengths) and len(used) == n
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(spans, spans[1:]))
        assert sum(spans[-1]) <= capacity


def test_pack_rules(docs, rows):
    got = packing.pack(docs, capacity=64, with_ids=True).collect()
    enc = encoder(tokenizer_path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text in rows:
        ids = enc.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 64 or min(64, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for k in range(len(cuts) - 1):
            raw = np.array(ids[cuts[k]:cuts[k + 1]], "<u4").tobytes()
            want[(doc_id, k, cuts[k], len(raw) // 4, zlib.crc32(raw))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    spans = defaultdict(list)
    for r in got:
        spans[r.sequence_id].append((r.offset, r.length))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(s, s[1:])) and sum(s[-1]) <= 64
    assert len(spans) == plain_best_fit([r.length for r in got], 64)
    seq = {r.sequence_id: r for r in packing.sequences(packing.pack(docs, capacity=64, with_ids=True)).collect()}
    assert all(len(r.ids) == 4 * r.n_tokens <= 256 for r in seq.values())


def test_hot_length_and_empty(spark, empty):
    same = spark.createDataFrame([(i, "one two") for i in range(3000)], "doc_id long, text string")
    got = packing.pack(same, capacity=10).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 3000
    assert packing.pack(empty).count() == 0
