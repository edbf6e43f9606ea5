"""Decontamination: alignment against a plain dynamic program, planted exact and edited copies."""
import random

import numpy as np
import pytest

from tessera.llm import decontam


def plain_score(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(max(r) for r in h)


@pytest.mark.parametrize("seed", range(20))
def test_alignment_score(seed):
    rng = random.Random(seed)
    a = [rng.randint(0, 6) for _ in range(rng.randint(1, 14))]
    b = [rng.randint(0, 6) for _ in range(rng.randint(0, 40))]
    score, first, end = decontam.align(np.array(a, np.uint64), np.array(b, np.uint64))
    assert score == plain_score(a, b)
    assert score == plain_score(a, b[first:end])        # the span holds the alignment


WORDS = [f"{a}{b}" for a in ("the", "of", "and", "to", "in", "ba", "ke", "lu", "mo") for b in ("", "ra", "ti", "no", "se")]


@pytest.fixture(scope="module")
def planted():
    """(documents, items, expected pairs): exact, re-cased, edited, split-off and clean documents."""
    rng = random.Random(8)
    text = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = {i: text(rng.randint(14, 50)) for i in range(30)}
    docs, want = [], set()
    for d in range(400):
        body = text(rng.randint(20, 200))
        if d % 4 == 0:
            i = rng.randrange(30)
            copy = list(items[i])
            for _ in range({0: 0, 4: len(copy) // 10, 8: len(copy) // 6}.get(d % 12, 0)):
                kind, at = rng.randrange(3), rng.randrange(len(copy))
                copy[at:at + 1] = [] if kind == 0 else [f"new{rng.randint(0, 99)}"] if kind == 1 else [copy[at], "added"]
            words = [w.upper() for w in copy] if d % 8 == 0 else copy
            at = rng.randrange(len(body))
            body[at:at] = words
            want.add((d, i))
        sep = rng.choice([" ", "\n", ", ", " - "])
        docs.append((d, sep.join(body)))
    hot = " ".join(items[0])
    docs += [(1000 + k, f"{' '.join(text(5))} {hot}") for k in range(150)]      # most documents of one item
    want |= {(1000 + k, 0) for k in range(150)}
    bench = [(i, " ".join(w)) for i, w in items.items()] + [(100, "two words"), (101, None), (102, ""), (103, " ".join(items[3]))]
    want |= {(d, 103) for d, i in want if i == 3}
    return docs, bench, want


def test_planted_copies_and_clean_documents(spark, planted):
    docs, bench, want = planted
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = decontam.leaks(df, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(0.5 <= r.score <= 1.0 and r.first_word < r.end_word for r in got)
    kept = {r.doc_id for r in decontam.clean(df, items).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_long_cluster_is_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(decontam, "LONGEST_PASSAGE", 60)
    rng = random.Random(1)
    item = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(20)]
    docs = [(1, " ".join(item * 30)), (2, " ".join(item[:9]))]
    got = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in got] == [(1, 7, 1.0)]


@pytest.mark.parametrize("every", [4, 5, 6])
def test_evenly_edited_copies_equal_brute_force(spark, every):
    """Every n-th word changed, beside many intact copies of the same items: all pairs by plain_score."""
    rng = random.Random(every)
    items = {i: [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(15, 40))] for i in range(25)}
    filler = lambda n: [f"w{rng.randint(0, 300)}" for _ in range(n)]
    docs = []
    for i, words in items.items():
        docs += [(100 * i + k, filler(10) + words + filler(10)) for k in range(rng.randint(0, 4))]
        shift = rng.randrange(every)
        edited = [f"new{k}" if k % every == shift else w for k, w in enumerate(words)]
        docs.append((100 * i + 50, filler(10) + edited + filler(10)))
    want = {(d, i) for d, words in docs for i, item in items.items() if plain_score(item, words) >= len(item)}
    assert {(100 * i + 50, i) for i in items} <= want
    got = decontam.leaks(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string"),
                         spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_hostile_rows(spark, docs, rows, empty):
    items = spark.createDataFrame([(1, rows[2][1]), (2, None), (3, "same id, other text")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()}
    assert (2, 1) in got and (8, 3) in got
    clean = decontam.clean(docs, items)
    assert clean.columns == docs.columns
    left = [(r.doc_id, r.text) for r in clean.collect()]
    assert (8, "same id, other text") not in left and rows[8] in left       # the other row with id 8 stays
    assert len(left) == len(rows) - 2
    assert decontam.leaks(empty, items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(docs, none).count() == 0 and decontam.clean(docs, none).count() == len(rows)


def test_seeds_are_the_rare_grams(spark, monkeypatch):
    """Counts against sets; a phrase that most documents use is no seed beside rarer 3-grams, and every exact
    or edited copy by plain_score is still found, those of an item that most documents copy too."""
    monkeypatch.setattr(decontam, "RARE_LEAST", 5)
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]
    phrase = "on the other hand it".split()          # 3 of its 3-grams: every window of 4 holds a rarer one
    items = {i: fresh(8) + phrase + fresh(8) for i in range(12)}
    hot = fresh(24)
    items[12] = hot
    docs = [(k, fresh(10) + phrase + fresh(10)) for k in range(120)]
    docs += [(200 + k, fresh(5) + hot + fresh(5)) for k in range(100)]
    for i, words in items.items():
        docs.append((400 + i, fresh(20) + words))
        docs.append((500 + i, fresh(9) + [f"new{k}" if k % 6 == i % 6 else w for k, w in enumerate(words)] + fresh(9)))
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    grams = decontam.item_grams(decontam.item_words(bench)).cache()
    counts = decontam.gram_counts(df, grams, "text")
    in_docs = [{tuple(w[k:k + 3]) for k in range(len(w) - 2)} for _, w in docs]
    want = {}
    for words in items.values():
        for k in range(len(words) - 2):
            want[tuple(words[k:k + 3])] = sum(tuple(words[k:k + 3]) in s for s in in_docs)
    assert sorted(r.n for r in counts.collect()) == sorted(n for n in want.values() if n)
    seeds = decontam.rare_seeds(grams, counts, len(docs))
    middle = {r.gram for r in grams.where("at = 9").collect()}            # inside the phrase; one gram of the hot item
    kept = {r.gram for r in seeds.collect()}
    assert len(middle - kept) == 1 and len(middle & kept) == 1
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench).collect()}
    assert found == {(d, i) for d, words in docs for i, item in items.items() if plain_score(item, words) >= len(item)}
