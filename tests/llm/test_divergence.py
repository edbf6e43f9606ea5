"""Source divergence against a plain version, on hostile rows, with one block and with many."""
import re
from collections import Counter, defaultdict

import pytest

from tessera.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
MORE = [("Alpha alpha, ALPHA; (beta) x9y x Beta!", "en", "a"), ("alpha-beta Alpha's éa Éa", "en", "b"),
        ("beta alpha once", "en", "b"), ("once (once)", "en", "c"), ("Once", "en", "c"), ("1 2 3", "en", "d"),
        ("seul", "fr", "only"), ("rare rare, rare.", "xx", "s1"), ("RARE", "xx", "s2"), ("rare!", "xx", "s2"),
        ("one (two) one", "yy", "s1"), ("ONE", "yy", "s2"), ("(one)", "yy", None), (None, "yy", "s4")]


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def brute(rows, least=3, top=200):
    """Rows of the audit, term by term."""
    docs = [(TERM.findall(ascii_lower(t or "")), lang or "", src or "") for t, lang, src in rows]
    out = []
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        seen = Counter(t for d in own for t in set(d[0]))
        kept = {t for t, n in seen.items() if n >= least}
        count = defaultdict(Counter)
        for words, _, src in own:
            count[src].update(w for w in words if w in kept)
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in p:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in p if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


@pytest.mark.parametrize("sources, cells, terms, least", [(256, 1 << 20, 1 << 12, 3), (2, 10, 3, 3), (256, 50, 9, 5)])
def test_equals_brute_force(spark, docs, monkeypatch, sources, cells, terms, least):
    monkeypatch.setattr(divergence, "SOURCES", sources)
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "TERMS", terms)
    monkeypatch.setattr(divergence, "SLICE", 2000)
    more = spark.createDataFrame(MORE, "text string, lang string, source string")
    rows = docs.select("text", "lang", "source").unionByName(more)
    got = divergence.audit(docs.unionByName(more, allowMissingColumns=True), min_docs=least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute([tuple(r) for r in rows.collect()], least)


def test_empty_and_clashing_names(spark, empty):
    assert divergence.audit(empty).count() == 0
    names = ["n", "n_docs", "docs", "chunk", "term", "total", "terms", "_t", "p", "q", "item", "value", "rank", "part", "gid", "lang_", "times", "own", "first", "last", "_found"]
    clash = spark.createDataFrame([("a b", "en", "s") + ("x",) * len(names)] * 3,
                                  ", ".join(f"{c} string" for c in ["text", "lang", "source", *names]))
    assert divergence.audit(clash).count() == 0            # one source, no more than its language


def test_large_counts_are_exact():
    import pandas as pd
    rows = [("a", 0, None, None, 9 * 10 ** 12, 2), ("b", 0, None, None, 5 * 10 ** 12, 2),
            ("a", 0, "t", 8 * 10 ** 12, None, None), ("a", 0, "u", 10 ** 12, None, None), ("b", 0, "t", 5 * 10 ** 12, None, None)]
    frame = pd.DataFrame(rows, columns=["gid", "block", "term", "n", "total", "terms"])
    i, j, s, seen = divergence._block_sums(frame, 0, 0)
    p = lambda n, t: 1 + 10 ** 9 * (n + 1) // (t + 2)
    share = {"a": [p(8 * 10 ** 12, 9 * 10 ** 12), p(10 ** 12, 9 * 10 ** 12)], "b": [p(5 * 10 ** 12, 5 * 10 ** 12), p(0, 5 * 10 ** 12)]}
    want = {(x, y): sum((a - b) ** 2 // b for a, b in zip(share[x], share[y])) for x, y in (("a", "b"), ("b", "a"))}
    assert dict(zip(zip(i, j), s)) == want and set(seen) == {2}
