"""Cross-tokenizer alignment against a plain per-document version, on hostile texts."""
import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest

from tessera.llm import align
from tessera.llm.tokens import _byte_alphabet, tokenizer_path

PIECES = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "  ", "\x1c", "\x00", "'s", "'ll", "é", "é",
          "3", "42", ".", "...", "<|endoftext|>", "<s>", "<0x41>", "▁", " ▁x", "ß", "日本", "\U0001f600", "​", "%%%",
          "don't", "_", ";\r", "{\r\n", " \n", "zzz"]


def brute(rows):
    """The operator's columns by the definition: whole texts, byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    back = {c: x for x, c in _byte_alphabet().items()}
    name = {i: t for t, i in json.load(open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8"))["model"]["vocab"].items()}
    docs, count = [], Counter()
    for d, t in rows:
        ids_a = a.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        bytes_a = [bytes(back[c] for c in name[i]) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                   for i in ids_b]
        if not t or any(b"".join(x) != (" " + t).encode() for x in (bytes_a, bytes_b)):
            docs.append((d, [], [], [], []))
            continue
        spans = []
        for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
            at, own = 0, []
            for i, x in zip(ids, parts):
                own.append((at, at + len(x), i))
                at += len(x)
            spans.append(own)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, links, lo = [], [], 0
        for e in ends:
            ga, gb = [[x for x in s if lo <= x[0] < e] for s in spans]
            groups.append((ga, gb))
            links += [(x[2], y[2]) for x in ga for y in gb if x[0] < y[1] and y[0] < x[1]]
            lo = e
        docs.append((d, ids_a, ids_b, groups, links))
        count.update(set(links))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for d, ids_a, ids_b, groups, links in docs:
        text = ";".join(",".join(str(x[2]) for x in ga) + "|" + ",".join(str(x[2]) for x in gb) for ga, gb in groups)
        out.append((d, len(ids_a), len(ids_b), len(groups), len(links), sum(count[x] == top[x[0]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if ids_a else ""))
    return sorted(out, key=repr)


def test_hostile_rows(spark, docs, rows):
    got = align.aligned(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("slice_, kept", [(4 << 20, 400_000), (3000, 50)])
def test_odd_texts_and_driver_rows(spark, monkeypatch, slice_, kept):
    monkeypatch.setattr(align, "SLICE", slice_)
    monkeypatch.setattr(align, "KEPT", kept)
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 25))) for _ in range(700)]
    texts += ["", " ", "\n", " x", "x ", None, "x" * 4000, "word " * 2000, "▁", "a\rb", "a \rb"]
    texts += ds.dataset("/root/testdata/sf0.001/documents.parquet").to_table(columns=["text"])["text"].to_pylist()[:60]
    rows = list(enumerate(texts))
    got = align.aligned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    for x, y in zip(sorted(map(tuple, got.collect()), key=repr), brute(rows)):
        assert x == y, rows[x[0]]


def test_empty(empty):
    assert align.aligned(empty).count() == 0


def test_coalesce():
    a = np.array([2, 5, 6, 9])
    b = np.array([1, 5, 9])
    ga, gb, la, lb = align.coalesce(np.append(0, a)[:-1], a, np.append(0, b)[:-1], b)
    assert ga.tolist() == [0, 0, 1, 1] and gb.tolist() == [0, 0, 1]
    assert list(zip(la.tolist(), lb.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2)]


def test_stored_slices_lie_in_small_row_groups(spark, monkeypatch):
    """Slices have large rows: neither a writer nor a reader may have to hold many of them at once."""
    monkeypatch.setattr(align, "SLICE", 20_000)
    monkeypatch.setattr(align, "GROUP", 100_000, raising=False)
    files, write = [], align.written

    def noted(*args):
        out = write(*args)
        files.extend(f.removeprefix("file:") for f in out.inputFiles())
        return out

    monkeypatch.setattr(align, "written", noted)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)) for _ in range(500)]
    assert align.aligned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).count() == 500
    found = [pq.ParquetFile(f).metadata for f in files if "aligned-" in f]
    groups = [m.row_group(i) for m in found for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) >= 30 and max(g.total_byte_size for g in groups) < 300_000
