"""Near-dedup against brute force over all pairs, on hostile rows, with and without block splitting."""
import random
import re

import numpy as np
import pytest

from tessera.llm import neardup
from tessera.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * inter >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d is not None and d == c))
    return sorted(out, key=repr)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randint(0, 10 ** 9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    """Families around the threshold: copies with none to many changed words, and shared passages."""
    rng = random.Random(5)
    rows, k = [], 0
    for _ in range(12):
        base = [f"b{rng.randint(0, 10 ** 9)}" for _ in range(rng.randint(6, 150))]
        for c in range(9):
            rows.append((k, edited(rng, base, int(len(base) * c / 120))))
            k += 1
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(40):
        rows.append((k, passage + " " + " ".join(f"q{rng.randint(0, 10 ** 9)}" for _ in range(rng.randint(5, 90)))))
        k += 1
    return rows


def got(df):
    found = neardup.near_duplicates(df)
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=repr)


def test_hostile_rows(docs, rows):
    assert got(docs) == brute(rows)


@pytest.mark.parametrize("block, region", [(1 << 20, 2048), (400, 8)])
def test_families_equal_brute_force(spark, family, monkeypatch, block, region):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "REGION", region)
    assert got(spark.createDataFrame(family, "doc_id long, text string")) == brute(family)


def test_large_region_is_compared_whole(spark):
    """5,000 nodes share all min-hashes of one tree; pairs that look alike share nothing in another."""
    rng = np.random.default_rng(3)
    sig = rng.integers(0, 2 ** 32, (5000, neardup.TREES * neardup.DEPTH), dtype=np.uint32)
    sig[:, :neardup.DEPTH] = 7
    pairs = [(k, 4999 - k) for k in range(0, 1000, 50)]
    for a, b in pairs:
        sig[b, neardup.DEPTH:] = sig[a, neardup.DEPTH:] ^ 4         # other values, the same sketch
    nodes = spark.createDataFrame([(k, 100, s.astype(">u4").tobytes()) for k, s in enumerate(sig)],
                                  "node long, n long, sig binary").repartition(3)
    got = neardup.loose_links(nodes).collect()
    assert {tuple(sorted(r)) for r in got} == set(pairs)


def test_pairs_at_the_threshold_under_one_template(spark, monkeypatch):
    """2,000 documents share a template; the pairs among them are at similarity 0.75 exactly."""
    monkeypatch.setattr(neardup, "REGION", 64)
    rng = random.Random(11)
    template = [f"t{i}" for i in range(44)]
    new = lambda n: [f"u{rng.randint(0, 10 ** 12)}" for _ in range(n)]
    rows = []
    for k in range(0, 1000, 2):
        words = template + new(30)
        rows += [(k, " ".join(words)), (k + 1, " ".join(words[:64] + new(10)))]
    rows += [(k, " ".join(template + new(30))) for k in range(1000, 2000)]
    want = [(k, 70, k - k % 2 if k < 1000 else k, k % 2 == 0 or k >= 1000) for k in range(2000)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(want, key=repr)


def test_exact_links_equal_brute_force(family):
    sets = [np.array(sorted(hash(x) & 0xFFFFFFFFFFFFFFFF for x in shingles(t)), np.uint64) for _, t in family]
    root = neardup.exact_links(sets)
    want = {r[0]: r[2] for r in brute(family)}
    assert [family[r][0] for r in root] == [want[d] for d, _ in family]


def test_keep_one_and_empty(docs, rows, empty):
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    groups = {r[2] for r in brute(rows) if r[1]}
    with_words = [x for x in left if shingles(x[1])]
    assert len(with_words) == len(groups) and {d for d, _ in with_words if d is not None} == {g for g in groups if g is not None}
    assert sum(not shingles(t) for _, t in left) == sum(not shingles(t) for _, t in rows)
    assert neardup.near_duplicates(empty).count() == 0 and neardup.keep_one(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1300)]
    loop = [(2000, 2001), (2001, 2002), (2002, 2000), (2002, 2002), (2000, 2001)]
    links = chain + star + loop
    rng.shuffle(links)
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1300)}, **{i: 2000 for i in (2000, 2001, 2002)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
