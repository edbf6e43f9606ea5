"""Jaccard join against brute force over all pairs, on hostile rows and around the limit, with groups split."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import tgm


def tokens(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute(rows):
    sets = [tokens(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 85 * (len(sets[i]) + len(sets[j]) - inter):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randint(0, 10 ** 9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    """Families around the limit, and documents that share a passage."""
    rng = random.Random(5)
    rows, k = [], 0
    for _ in range(25):
        base = [f"b{rng.randint(0, 10 ** 9)}" for _ in range(rng.randint(5, 260))]
        for c in range(9):
            rows.append((k, edited(rng, base, int(len(base) * c / 160))))
            rows.append((k + 1, " ".join(base[:len(base) - int(len(base) * c / 50)])))
            k += 2
    passage = " ".join(f"p{i}" for i in range(80))
    for _ in range(120):
        rows.append((k, passage + " " + " ".join(f"q{rng.randint(0, 10 ** 9)}" for _ in range(rng.randint(2, 40)))))
        k += 1
    base = [f"z{i}" for i in range(90)]
    rows += [(k + i, edited(rng, base, 1 + i % 2)) for i in range(150)]
    return rows


def got(df):
    return sorted((tuple(r) for r in tgm.jaccard_components(df).collect()), key=repr)


def test_hostile_rows(docs, rows):
    assert got(docs) == brute(rows)


@pytest.mark.parametrize("members, size, shared, room", [(512, 1 << 18, 4, 1 << 20), (5, 400, 2, 900)])
def test_families_equal_brute_force(spark, family, monkeypatch, members, size, shared, room):
    monkeypatch.setattr(tgm, "ROOM", room)
    monkeypatch.setattr(tgm, "MEMBERS", members)
    monkeypatch.setattr(tgm, "TOKENS", size)
    monkeypatch.setattr(tgm, "SHARED", shared)
    assert got(spark.createDataFrame(family, "doc_id long, text string").repartition(5)) == brute(family)


def test_unlike_groups_are_not_opened(spark):
    """Documents that share four fifths qualify for no pair of groups but their own."""
    rng = random.Random(3)
    head = [f"h{i}" for i in range(83)]
    rows = [(k, " ".join(head + [f"u{rng.randint(0, 10 ** 12)}" for _ in range(20)])) for k in range(60)]
    entries = []
    for k, (_, t) in enumerate(rows):
        s = sorted(tokens(t), key=lambda x: (x[0][0] == "h" and x[3][0] == "h", hash(x)))
        count = len(s) - -(-85 * len(s) // 100) + 1
        entries += [(hash(x), k, len(s) - p, len(s), 1) for p, x in enumerate(s[:count])]
    frame = spark.createDataFrame(entries, "token long, group long, rest long, least long, members long")
    assert tgm.qualifying(frame).count() == 0


def test_opened_links_equal_brute_force(family):
    sets = [np.array(sorted(hash(x) & 0xFFFFFFFFFFFFFFFF for x in tokens(t)), np.uint64) for _, t in family]
    pair = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
    for cut in (1, 200, 400):
        found = tgm.opened_links(sets[:cut], sets[cut:450])
        assert all(pair(i, j) and i < cut <= j for i, j in found)
        linked = {i for i in range(cut) if any(pair(i, j) for j in range(cut, 450))}
        assert {i for i, _ in found} <= linked and (not linked or found)


def test_byte_planes_are_a_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 700):
        some = np.unique(rng.integers(0, 2 ** 64, n, np.uint64, endpoint=False))
        assert (tgm.from_planes(tgm.planes(some)) == some).all() and len(tgm.planes(some)) == 8 * len(some)
    edge = np.array([0, 1, 2 ** 64 - 1], np.uint64)
    assert (tgm.from_planes(tgm.planes(edge)) == edge).all()


def test_a_member_goes_once_to_a_home(spark):
    """A hub group with three partners: its member is sent once a part, the partners' once; all pairs meet."""
    rows = [(n, min(0, g), max(0, g), g == 0) for g in (1, 2, 3) for n in (100, 10 + g)]
    places = spark.createDataFrame([(n, g, h, n == 100) for n, g, h, _ in rows] + [(100, 0, 0, True)],
                                   "node long, g long, h long, first boolean")
    need = spark.createDataFrame([(n, n, n, 5) for n in (100, 11, 12, 13)], "node long, hi long, lo long, n long")
    got = tgm.homes(places, need).collect()
    assert sorted((r.node, r.home, r.own, sorted(r.away)) for r in got) == [
        (11, 0, False, [1]), (12, 0, False, [2]), (13, 0, False, [3]), (100, 0, True, [0, 1, 2, 3])]


def test_only_shared_tokens_are_kept(spark):
    """Tokens that agree in their upper half, or in the places of any bitmap, are not the same token."""
    token = [(5 << 40) + i for i in range(6)]
    prefix = {1: token[:3], 2: token[2:4], 3: token[4:5], 4: token[5:]}
    first = spark.createDataFrame(
        [(k % 2, k, 10, np.array(t, np.int64).tobytes()) for k, t in prefix.items()],
        "group long, node long, n long, prefix binary")
    assert sorted(map(tuple, tgm.shared_tokens(first).collect())) == [(token[2], 0, 2, 10, 10), (token[2], 1, 1, 10, 8)]


def some_sets(rng, sizes):
    return [np.unique(rng.integers(0, 2 ** 64, n, np.uint64, endpoint=False)) for n in sizes]


def test_sketches_keep_every_link():
    """Pairs at the limit and of unlike sizes are near, whatever the sketches' lengths; unlike sets are not."""
    rng = np.random.default_rng(8)
    for n in (1, 7, 64, 65, 128, 129, 500, 1025, 9000):
        own, = some_sets(rng, [n])
        cut = n - 15 * n // 100
        swapped = np.sort(np.concatenate([own[n * 15 // 185:], *some_sets(rng, [n * 15 // 185])]))
        longer = np.sort(np.concatenate([own, *some_sets(rng, [n * 15 // 85])]))
        for like in (own, own[:cut], swapped, longer):
            assert 100 * len(np.intersect1d(own, like)) >= 85 * len(np.union1d(own, like))
            some, met = tgm.near([tgm.sketch(own)], np.array([n]), [tgm.sketch(like)], np.array([len(like)]))
            assert some.all() and met.all()
    for sizes in ([300, 301], [1024, 1025], [5000, 5600]):
        sets = some_sets(rng, sizes)
        some, met = tgm.near([tgm.sketch(sets[0])], np.array(sizes[:1]), [tgm.sketch(sets[1])], np.array(sizes[1:]))
        assert not some.any() and not met.any()


def test_members_without_a_near_partner_are_not_opened():
    """Of a home and two other groups only those stay that may be linked, for the groups where they may."""
    rng = np.random.default_rng(9)
    a, b, c, d = some_sets(rng, [200] * 4)
    like = np.sort(np.concatenate([a[4:], b[:4]]))
    rows = [(0, True, [0, 1, 2], a), (1, True, [0, 1, 2], b), (2, False, [1], like), (3, False, [1], c), (4, False, [2], d)]
    table = pa.table({
        "hi": [k for k, *_ in rows], "lo": [k for k, *_ in rows], "node": [k for k, *_ in rows],
        "home": [0] * 5, "part": [0] * 5, "own": [o for _, o, _, _ in rows], "away": [g for _, _, g, _ in rows],
        "n": [len(s) for *_, s in rows], "sketch": [tgm.sketch(s) for *_, s in rows]})
    assert [(r["node"], r["own"], r["away"]) for r in tgm.home_near(table).to_pylist()] == [(0, True, [1]), (2, False, [1])]
    inside = table.slice(0, 2).set_column(6, "away", pa.array([[0], [0]]))
    assert tgm.home_near(inside).num_rows == 0
    inside = pa.concat_tables([inside, inside])
    assert tgm.home_near(inside).column("away").to_pylist() == [[0]] * 4


def test_empty(empty):
    assert tgm.jaccard_components(empty).count() == 0
