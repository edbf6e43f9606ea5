"""The sorted orders of near-dedup: cutting large regions, whatever the batches, against a plain count."""
from collections import Counter

import numpy as np
import pytest

from tessera.llm import neardup


def keys_of(rng, m, width):
    keys = rng.integers(0, 2, (m, 1 + width)).astype(">u4")
    keys[rng.random(m) < 0.4] = keys[0]
    return keys[np.lexsort(keys.T[::-1])]


@pytest.mark.parametrize("width, depth", [(8, 3), (5, 5)])
@pytest.mark.parametrize("seed", range(25))
def test_regions_are_cut_and_kept(monkeypatch, width, depth, seed):
    monkeypatch.setattr(neardup, "REGION", 8)
    rng = np.random.default_rng(seed)
    m = int(rng.integers(1, 400))
    keys = keys_of(rng, m, width)
    prefix = [tuple(k[:1 + depth]) for k in keys]
    whole = [tuple(k) for k in keys]
    regions, full = Counter(prefix), Counter(whole)
    for size in (1, 3, 7, 50, 1000):
        order = neardup._Order(width, depth)
        parts = [order.feed([keys[k:k + size], np.arange(k, min(m, k + size)), np.full(len(keys[k:k + size]), 100),
                             np.zeros((len(keys[k:k + size]), 4), np.uint64)]) for k in range(0, m, size)]
        parts.append(order.feed())
        links = [x for p in parts for x in zip(p[0].tolist(), p[1].tolist())]
        large = [x for p in parts for x in zip(p[2], p[3])]
        deep = {x for p in parts for x in p[4].tolist()}
        assert deep == ({i for i in range(m) if regions[prefix[i]] > 8} if depth < width else set())
        assert sorted(s for _, s in large) == sorted(c for c in full.values() if c > 8)
        root = list(range(m))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in links:
            assert prefix[a] == prefix[b]
            root[find(a)] = find(b)
        for i in range(1, m):       # all sketches are equal, so what is compared is linked
            if prefix[i] == prefix[i - 1] and regions[prefix[i]] <= 8 or whole[i] == whole[i - 1] and full[whole[i]] <= 8:
                assert find(i) == find(i - 1)
