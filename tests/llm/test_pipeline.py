"""The pipeline's stages against brute-force versions on a planted corpus, and the registered queries."""
import importlib.util
import os
import random
import sys
from collections import Counter

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
import corpus_pipeline as cp  # noqa: E402
from tessera.llm import packing  # noqa: E402
from tessera.llm.tokens import encoder, tokenizer_path  # noqa: E402
from tests.llm.test_linededup import walk  # noqa: E402
from tests.llm.test_neardup import brute, edited, shingles  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(6)
    vocab = {"en": [f"the{i}ing" for i in range(300)], "fr": [f"le{i}eux" for i in range(300)]}
    line = lambda lang: " ".join(rng.choice(vocab[lang]) for _ in range(rng.randint(5, 12)))
    items = [(i, line("en") + " " + line("en") + " " + line("en")) for i in range(6)]
    boiler = [line("en") for _ in range(4)]
    rows = []
    for d in range(120):
        lang = "en" if d % 3 else "fr"
        lines = [line(lang) for _ in range(rng.randint(2, 9))]
        if d % 10 == 1:
            lines[1:1] = boiler
        if d % 10 == 2:
            lines.append(items[d % 6][1])
        rows.append((d, "\n".join(lines), lang))
    rows += [(200 + k, edited(rng, rows[k][1].split(" "), k % 3), rows[k][2]) for k in range(20)]    # near copies
    rows += [(300 + k, rows[30][1], "fr") for k in range(5)]                                        # exact copies
    rows += [(400, None, "en"), (401, "", None), (402, "123 %% 45", "en"), (403, "one", "en"), (404, "x", None)]
    docs = [(d, t, lang, None if d % 7 else "s", len(t or "")) for d, t, lang in rows]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, DOC).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages_equal_brute_force(spark, corpus):
    path, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, [(r.doc_id, r.text) for r in docs.collect()]
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    out = []
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, path)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
        if name != "packing":
            assert docs.columns == columns
            now = [(r.doc_id, r.text) for r in rows]
        if name == "language_id":
            want = [x for x in kept if x[1] and any(map(str.isalpha, x[1]))]
        elif name == "line_dedup":
            want = [x for x in walk(kept).elements() if x[1].strip()]
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "near_dedup":
            ids = {r[2] for r in brute(kept) if r[1]}
            want = [x for x in kept if x[0] in ids or not shingles(x[1])]
        elif name == "decontamination":
            flat = lambda t: f" {' '.join(t.split())} "
            want = [x for x in kept if not any(flat(t) in flat(x[1]) for _, t in items)]
        else:
            break
        assert Counter(now) == Counter(want), name
        kept = now
    enc = encoder(tokenizer_path("byte_bpe_50k.json"))
    lengths = Counter({d: len(enc.tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept})
    packed = Counter()
    for r in out[-1]:
        packed[r.doc_id] += r.length
    assert packed == lengths
    counts = dict(Counter(lengths.values()))
    assert len({r.sequence_id for r in out[-1]}) == packing.plan_best_fit(counts, 2048)[1]


def test_run_equals_its_stages_and_empty_table(spark, corpus, tmp_path):
    path, _ = corpus
    run = cp.run(spark, path)
    assert run.count() > 0 and run.columns[:4] == ["doc_id", "piece", "start", "length"]
    spark.createDataFrame([], DOC).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_all_queries_are_registered():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert {"op5_line_dedup", "op6_exact_topk"} <= set(entry.oracle_sql())
