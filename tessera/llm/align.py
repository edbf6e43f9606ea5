"""Cross-tokenizer alignment by interval coalescing: which ids of two tokenizers cover the same bytes.

1. Chunks. Neither tokenizer has a token across a white-space run's start, so a text is the sequence of
   its chunks (white space, then a word). Distinct chunks of a slice are encoded with both tokenizers
   and kept per worker; texts on which that cut is not known to be exact are encoded whole.
2. Interval coalescing. All A and B tokens of the new chunks are lexsorted by start; a group breaks where
   a start reaches the running maximum (``maximum.accumulate``) of the ends. Inside the groups every A
   token is expanded over the B tokens that overlap it: the links.
3. One stored row per slice of documents: the slice's distinct linked id pairs with their number of
   documents, and every document's links as counts of its distinct chunks.
4. Corpus counts: pairs are summed over the slices, the highest of every A id marked. They go back to the
   slices by a join (a hot pair is one row per slice, not per document), and each document sums its links.

Null or empty texts, and texts whose joined A or B bytes differ from space + text, have no tokens: zero
counts and an empty hash. Repeated rows are documents of their own; doc_id may be null. An empty table
gives no rows; other columns are ignored. A very long text is a slice of its own.
"""
from __future__ import annotations

import ctypes
import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import textvec as tv
from tessera.llm.common import written
from tessera.llm.tokens import _byte_alphabet, tokenizer_path

SLICE = 2 << 20             # bytes of text in a slice
KEPT = 200_000              # chunks that a worker keeps (speed only)
BATCH = 10_000              # chunks encoded at once
LONGEST = 200               # bytes of a chunk that is kept
GROUP = 16 << 20            # bytes of a row group of the stored slices (a slice's row has one or two megabytes)

SLICES = ("slice long, doc_id array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<int>, "
          "sha array<string>, pairs array<long>, pair_docs array<int>, doc_first binary, doc_chunk binary, "
          "doc_times binary, chunk_first binary, chunk_pair binary")
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
       "groups_sha256 string")


def _pool(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, length, joined bytes) of many byte strings."""
    length = np.fromiter(map(len, values), np.int64, len(values))
    return np.cumsum(length) - length, length, np.frombuffer(b"".join(values), np.uint8)


def _narrow(values: np.ndarray) -> bytes:
    """Non-negative integers in 1, 2, 4 or 8 bytes each, as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<")).tobytes()


def _wide(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // max(count, 1)}").astype(np.int64) if count else np.zeros(0, np.int64)


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of n[k] values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices first[k] .. first[k] + size[k] of all k, joined."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def coalesce(a_start, a_end, b_start, b_end):
    """Groups and links of two tokenisations of the same bytes (both sorted by start, no empty token).

    Returns (group of each A token, group of each B token, A of each link, B of each link).
    """
    start = np.concatenate([a_start, b_start])
    end = np.concatenate([a_end, b_end])
    order = np.lexsort((np.arange(len(start)), start))
    running = np.maximum.accumulate(end[order]) if len(order) else end
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= running[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    lo = np.searchsorted(b_end, a_start, side="right")
    hi = np.searchsorted(b_start, a_end, side="left")
    n = np.maximum(hi - lo, 0)
    link_a = np.repeat(np.arange(len(n)), n)
    link_b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return group[:len(a_start)], group[len(a_start):], link_a, link_b


class Aligner:
    """Chunks of both tokenizers with their alignment; one per Python worker and pair of files."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True                 # their strings in a text are plain text
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        byte_level = pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and spec["normalizer"] is None
        back = {c: b for b, c in _byte_alphabet().items()}
        vocab = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        a_bytes = [b""] * (vocab[-1][1] + 1)
        for t, i in vocab:
            a_bytes[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        self.token_a, self.token_b = _pool(a_bytes), _pool(b_bytes)
        self.digits = _pool([b"%d," % i for i in range(max(len(a_bytes), len(b_bytes)))])
        # white space that a piece joins to something before it: such texts are not cut
        normal = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        crosses = any(re.search("[^▁]▁", p) for p in normal)
        self.cut = byte_level and not crosses and self.b.encode("a") == [self.b.piece_to_id("▁a")]
        self.odd = re.compile("[%s▁]" % "".join({c for p in normal for c in p if c in "\t\n\x0b\x0c\r"}))
        self.reset()

    def reset(self) -> None:
        self.place: dict[bytes, int] = {}
        self.counts = np.zeros((0, 4), np.int32)            # A tokens (-1: bytes differ), B tokens, groups, links
        self.names: list[bytes] = []                        # groups as text
        self.pairs = np.zeros(0, np.int64)                  # links of all rows, as A << 32 | B

    def add(self, raw: list[bytes]) -> None:
        """Append a row for each whole text or chunk (UTF-8, with its white space before)."""
        texts = [r.decode("utf-8") for r in raw]
        lead = [t[:1] == " " for t in texts]
        of_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # the space before is B's own; without one, a letter stands in front and goes again
        of_b = self.b.encode([t[1:] if k else "a" + t for t, k in zip(texts, lead)], num_threads=1)
        of_b = [ids if k else ids[1:] for ids, k in zip(of_b, lead)]
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(raw)) for x in (of_a, of_b))
        ids_a = np.fromiter(chain.from_iterable(of_a), np.int64, int(n_a.sum()))
        ids_b = np.fromiter(chain.from_iterable(of_b), np.int64, int(n_b.sum()))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        equal = np.ones(len(raw), bool)
        for ids, n, token in ((ids_a, n_a, self.token_a), (ids_b, n_b, self.token_b)):
            equal &= _sums(token[1][ids], n) == size
        flat = np.frombuffer(b"".join(raw), np.uint8)
        for ids, n, (at, length, data) in ((ids_a, n_a, self.token_a), (ids_b, n_b, self.token_b)):
            own = ids[np.repeat(equal, n)]
            wrong = data[_ragged(at[own], length[own])] != flat[np.repeat(equal, size)]
            if wrong.any():
                bad = np.searchsorted(np.cumsum(size[equal]), np.flatnonzero(wrong), side="right")
                equal[np.flatnonzero(equal)[np.unique(bad)]] = False
        ids_a, ids_b = ids_a[np.repeat(equal, n_a)], ids_b[np.repeat(equal, n_b)]
        n_a, n_b = np.where(equal, n_a, 0), np.where(equal, n_b, 0)
        end_a, end_b = np.cumsum(self.token_a[1][ids_a]), np.cumsum(self.token_b[1][ids_b])
        group_a, group_b, link_a, link_b = coalesce(
            end_a - self.token_a[1][ids_a], end_a, end_b - self.token_b[1][ids_b], end_b)
        row_a = np.repeat(np.arange(len(raw)), n_a)
        opens = np.ones(len(group_a), bool)
        opens[1:] = group_a[1:] != group_a[:-1]
        counts = np.stack([np.where(equal, n_a, -1), n_b, np.bincount(row_a[opens], minlength=len(raw)),
                           np.bincount(row_a[link_a], minlength=len(raw))], 1)
        # groups as text: A ids, B ids of a group, with a mark after each
        key = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(key, kind="stable")
        key, ids = key[order], np.concatenate([ids_a, ids_b])[order]
        at, length, data = self.digits
        text = data[_ragged(at[ids], length[ids])]
        ends = np.cumsum(length[ids])
        last = np.ones(len(key), bool)
        last[:-1] = key[1:] != key[:-1]
        text[ends[last] - 1] = np.where(key[last] % 2 == 0, ord("|"), ord(";"))
        edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        text = text.tobytes()
        self.names += [text[x:y - 1] if y > x else b"" for x, y in zip(edge[:-1], edge[1:])]
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])
        self.pairs = np.concatenate([self.pairs, (ids_a[link_a] << 32) | ids_b[link_b]])

    def lookup(self, chunks: list[bytes]) -> np.ndarray:
        """Rows of distinct chunks; only those not kept are encoded."""
        if len(self.names) > KEPT or len(self.pairs) > 8 * KEPT:
            self.reset()
        row = np.fromiter((self.place.get(c, -1) for c in chunks), np.int64, len(chunks))
        new = np.flatnonzero(row < 0)
        if len(new):
            row[new] = len(self.names) + np.arange(len(new))
            fresh = [chunks[k] for k in new.tolist()]
            self.place.update((c, r) for c, r in zip(fresh, row[new].tolist()) if len(c) <= LONGEST)
            for k in range(0, len(fresh), BATCH):
                self.add(fresh[k:k + BATCH])
        return row


def release() -> None:
    """Give the memory of a finished slice back: the allocators keep it, beside the executor's own."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):        # not glibc
        pass


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def chunks_of(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(chunks of every text, a space before its first one; chunks before each text [n + 1]). A chunk is a
    run of white space and the word after it; a text of ``whole`` is one chunk, an empty one has none."""
    lo = int(offsets[0])
    rel = (offsets - lo).astype(np.int64)
    raw = data[lo:int(offsets[-1])]
    n = np.diff(rel)
    # every text with a space in front of it
    place = rel[:-1] + np.arange(len(n))
    spaced = np.full(len(raw) + len(n), 32, np.uint8)
    body = np.ones(len(spaced), bool)
    body[place] = False
    spaced[body] = raw
    space = tv.IS_SPACE[spaced]
    first = np.zeros(len(spaced), bool)
    first[1:] = space[1:] & ~space[:-1]
    if whole.any():
        first &= ~np.repeat(whole, n + 1)
    first[place] = True
    starts = np.flatnonzero(first)
    before = np.searchsorted(starts, np.append(place, len(spaced)))
    chunks = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(spaced)).astype(np.int64)), pa.py_buffer(spaced)])
    return chunks, before


def slices(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per slice of ``docs(doc_id, text)``, see SLICES."""

    def aligned(part, al):
        data, offsets = tv.utf8(part.column("text"))
        m = part.num_rows
        size = np.diff(offsets)
        if not al.cut:
            whole = np.ones(m, bool)
        else:                   # a chunk that ends in other white space than ASCII's is not safe
            odd = np.zeros(256, bool)
            odd[[0x0d, 0xe2, 0xc2, 0xe1, 0xe3, 0x1c, 0x1d, 0x1e, 0x1f]] = True
            hit = np.unique(np.searchsorted(offsets - offsets[0], np.flatnonzero(
                odd[data[int(offsets[0]):int(offsets[-1])]]), side="right") - 1)
            whole = np.zeros(m, bool)
            for k in hit.tolist():
                text = part.column("text")[k].as_py()
                whole[k] = bool(al.odd.search(text)) or bool(re.search(r"[^\S \t\n\r\x0b\x0c][ \t\n\r\x0b\x0c]", text))
        chunks, before = chunks_of(data, offsets, whole)
        coded = chunks.dictionary_encode()
        row = al.lookup(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        doc = np.repeat(np.arange(m), np.diff(before))
        none = size == 0
        # a chunk's bytes differ: what counts are the whole text's
        again = np.unique(doc[al.counts[row, 0] < 0])
        again = again[~none[again] & ~whole[again]]
        if len(again):
            keep = ~np.isin(doc, again)
            row = np.concatenate([row[keep], len(al.names) + np.arange(len(again))])
            doc = np.concatenate([doc[keep], again])
            al.add([b" " + part.column("text")[k].as_py().encode() for k in again.tolist()])
            order = np.argsort(doc, kind="stable")
            row, doc = row[order], doc[order]
        none[doc[al.counts[row, 0] < 0]] = True
        keep = ~none[doc]
        row, doc = row[keep], doc[keep]
        used, code = np.unique(row, return_inverse=True)    # the slice's chunks
        counts = al.counts[used].astype(np.int64)
        edges = np.searchsorted(doc, np.arange(m + 1))
        total = np.stack([_sums(counts[code, c], np.diff(edges)) for c in range(4)], 1)
        names, codes, edge = [al.names[r] for r in used.tolist()], code.tolist(), edges.tolist()
        sha = ["" if none[k] else hashlib.sha256(b";".join([names[c] for c in codes[edge[k]:edge[k + 1]]])).hexdigest()
               for k in range(m)]
        # links of a document: its distinct chunks, how often, and the pairs of each chunk
        n = max(len(used), 1)
        key, times = np.unique(doc * n + code, return_counts=True)
        d, c = np.divmod(key, n)
        links = counts[:, 3]
        first = (np.cumsum(al.counts[:, 3], dtype=np.int64) - al.counts[:, 3])[used]
        pairs, index = np.unique(al.pairs[_ragged(first, links)], return_inverse=True)
        start = np.cumsum(links) - links
        p = max(len(pairs), 1)
        held = np.unique(np.repeat(d, links[c]) * p + index[_ragged(start[c], links[c])])
        n_docs = np.bincount(held % p, minlength=len(pairs))
        return {"doc_id": part.column("doc_id").to_pylist(), "n_a": total[:, 0], "n_b": total[:, 1],
                "n_groups": total[:, 2], "n_links": total[:, 3], "sha": sha, "pairs": pairs, "pair_docs": n_docs,
                "doc_first": np.searchsorted(d, np.arange(m + 1)).astype("<i4").tobytes(),
                "doc_chunk": _narrow(c), "doc_times": _narrow(times),
                "chunk_first": np.append(start, links.sum()).astype("<i4").tobytes(),
                "chunk_pair": _narrow(index)}

    def rows(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        al = aligner(path_a, path_b)
        kinds = {"doc_id": pa.list_(pa.int64()), "sha": pa.list_(pa.string()), "pairs": pa.list_(pa.int64())}
        for batch in batches:
            for part in tv.bounded_slices(batch, "text", SLICE):
                out = {"slice": pa.array([number], pa.int64())}
                for name, value in aligned(part, al).items():
                    kind = pa.binary() if isinstance(value, bytes) else kinds.get(name, pa.list_(pa.int32()))
                    out[name] = pa.array([value], kind)
                number += 1
                yield pa.RecordBatch.from_pydict(out)
                del out
                release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SLICES)


def pair_counts(stored: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents an id pair (A << 32 | B) is linked; is that its A id's highest?"""
    pairs = (stored.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
             .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.pair_docs").cast("long")).alias("n"))
             .where(F.col("n") > 0).withColumn("a", F.shiftright("pair", 32)))
    pairs = written(pairs, "pair-counts")
    top = pairs.groupBy("a").agg(F.max("n").alias("top"))
    return pairs.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def aligned(docs: DataFrame, tokenizer_a: str | None = None, tokenizer_b: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``.

    ``n_best``: links whose pair is in as many documents as its A id's most frequent pair;
    ``count_sum``: the documents of every link's pair, summed.
    """
    stored = written(slices(docs, tokenizer_a or tokenizer_path("byte_bpe_50k.json"),
                            tokenizer_b or tokenizer_path("piece_bpe_32k.model")), "aligned", GROUP)
    here = stored.select(F.col("slice").alias("of"), F.posexplode("pairs").alias("pos", "pair"))
    back = here.join(pair_counts(stored), "pair").select("of", "pos", "n", "best")

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        size = row["n_pairs"]
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        pos = right.column("pos").to_numpy()
        n[pos] = right.column("n").to_numpy()
        best[pos] = right.column("best").to_numpy(zero_copy_only=False)
        of = {k: np.frombuffer(row[k], "<i4") for k in ("doc_first", "chunk_first")}
        for k, held in (("doc_chunk", "doc_first"), ("doc_times", "doc_first"), ("chunk_pair", "chunk_first")):
            of[k] = _wide(row[k], int(of[held][-1]))
        out = {k: pa.array(row[k], pa.int64()) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        for name, value in (("n_best", best), ("count_sum", n)):
            by_pair = np.concatenate([[0], np.cumsum(value[of["chunk_pair"]])])
            by_chunk = by_pair[of["chunk_first"][1:]] - by_pair[of["chunk_first"][:-1]]
            sums_ = np.concatenate([[0], np.cumsum(by_chunk[of["doc_chunk"]] * of["doc_times"])])
            out[name] = pa.array(sums_[of["doc_first"][1:]] - sums_[of["doc_first"][:-1]], pa.int64())
        out["groups_sha256"] = pa.array(row["sha"], pa.string())
        return pa.table(out)

    left = stored.withColumn("n_pairs", F.size("pairs")).drop("pairs", "pair_docs")
    return left.groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(sums, OUT)
