"""Exact, cached encoding of whole texts with a public tokenizer file.

Encoding a text from scratch costs about a microsecond a byte. Both tokenizer kinds used here cut
a text at white space before any merge is applied, so the ids of a text are the concatenation of
the ids of its white-space-delimited chunks, and chunks repeat a lot. An ``Encoder`` hashes all
words of an Arrow slice at once, looks them up in a direct-mapped table of id runs (bounded, kept
for the life of the Python worker) and encodes only unknown words, with the tokenizers library.
A text on which the shortcut is not exact (odd white space) is encoded whole by the library. The
result equals ``Tokenizer.encode(text, add_special_tokens=False)``; ``tests/llm/test_tokens.py``
checks that on hostile texts. Words are told apart by 64-bit hashes.
"""
from __future__ import annotations

import json
import re
from array import array

import numpy as np

from tessera.llm import textvec as tv

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# A word of Latin letters, then a run of ASCII marks (no apostrophe): at most three pre-tokens.
_SIMPLE = re.compile(f"([ \n]?)([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")
SLOT_BITS = 21              # slots of the word table (14 bytes each)
LONGEST = 30_000            # a longer chunk is not kept: its text is encoded whole
POOL_IDS = 4_000_000        # ids kept before the table is emptied (speed only)
MAX_CORES = 300_000         # entries of the pre-token cache before it is emptied (speed only)


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


_BYTES = _byte_alphabet()
_LATIN = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(256)}


class Encoder:
    """Encodes slices of texts; one per Python worker and tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.words = bool(spec["model"].get("end_of_word_suffix"))
        self._check(spec)
        self.cores: dict[str, list[int]] = {}
        self.pool = np.empty(1 << 20, np.uint32)
        self._reset()

    def _check(self, spec: dict) -> None:
        """Refuse a file whose pre-tokenizer is not one of the two kinds this shortcut is exact for."""
        pre = spec["pre_tokenizer"]
        kinds = [p["type"] for p in pre.get("pretokenizers", [pre])]
        ok = kinds == ["Split", "ByteLevel"] if self.words else (
            kinds == ["ByteLevel"] and pre["use_regex"] and not pre["add_prefix_space"]
            and spec["normalizer"] is None)
        stripped = any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                       for t in spec["added_tokens"])
        if not ok or stripped or spec["model"]["type"] != "BPE":
            raise ValueError("chunk-wise encoding is not known to be exact for this tokenizer file")

    def _reset(self) -> None:
        self.used = 0
        self.key = np.zeros(1 << SLOT_BITS, np.uint64)
        self.at = np.zeros(1 << SLOT_BITS, np.int32)
        self.len = np.zeros(1 << SLOT_BITS, np.int16)

    def _core(self, letters: str) -> list[int]:
        """Ids of one pre-token made of Latin letters (and a leading space), or of one mark."""
        ids = self.cores.get(letters)
        if ids is None:
            if len(self.cores) >= MAX_CORES:
                self.cores.clear()
            merged = self.tokenizer.model.tokenize(letters.translate(_LATIN))
            ids = self.cores[letters] = [t.id for t in merged]
        return ids

    def chunk_ids(self, chunk: str) -> list[int] | None:
        """Ids of one chunk (a word and the white space before it); None if it is not a safe chunk:
        it ends in white space that a later run would join, or holds what may be a special token."""
        m = _SIMPLE.fullmatch(chunk)
        if m:
            lead, letters, mark = m.groups()
            if self.words:
                ids = self._core(letters.lower())
            elif lead == "\n":
                ids = self._core("\n") + self._core(letters)
            else:
                ids = self._core(lead + letters)
            return ids + self._core(mark) if mark else ids
        if "<|" in chunk or (not self.words and chunk[-1].isspace()):
            return None
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _learn(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray):
        """Encode unknown words; returns where their ids lie in the pool and how many (-1: unsafe)."""
        found, lengths = array("I"), []
        buf = raw.tobytes()
        lead_text = ("", " ", "\n")
        for s, e, k in zip(starts.tolist(), ends.tolist(), lead.tolist()):
            ids = self.chunk_ids(lead_text[k] + buf[s:e].decode("utf-8", "replace"))
            if ids is None or len(ids) > LONGEST:
                lengths.append(-1)
            else:
                found.extend(ids)
                lengths.append(len(ids))
        length = np.array(lengths, np.int64)
        kept = np.maximum(length, 0)
        at = self.used + np.cumsum(kept) - kept
        while self.used + len(found) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(len(self.pool), np.uint32)])
        self.pool[self.used:self.used + len(found)] = np.frombuffer(found, np.uint32)
        self.used += len(found)
        return at, length

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a slice, ids before each text [n + 1])."""
        if self.used > POOL_IDS:
            self._reset()
        raw = data[int(offsets[0]):int(offsets[-1])]
        rel = offsets - offsets[0]
        h, before, starts, ends = tv.word_hashes(data, offsets, lower=self.words)
        n_docs = len(offsets) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(before))
        whole = np.zeros(n_docs, dtype=bool)            # texts that the library encodes whole
        if self.words or not len(h):
            lead = np.zeros(len(h), np.int8)
            if not len(h) and not self.words:
                whole = np.diff(rel) > 0
        else:
            first = np.zeros(len(h), dtype=bool)
            first[before[:-1][np.diff(before) > 0]] = True
            gap = np.empty(len(h), np.int64)
            gap[0] = 0
            np.subtract(starts[1:], ends[:-1], out=gap[1:])
            gap[first] = starts[first] - rel[doc[first]]
            sep = raw[starts - 1]
            lead = np.where(first, 0, np.where(sep == 10, 2, 1)).astype(np.int8)
            odd = np.where(first, gap != 0, (gap != 1) | ((sep != 32) & (sep != 10)))
            whole[doc[odd]] = True
            filled = np.diff(before) > 0
            last_end = np.zeros(n_docs, np.int64)
            last_end[filled] = ends[before[1:][filled] - 1]
            whole |= np.where(filled, last_end != rel[1:], np.diff(rel) > 0)
            h ^= lead.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at, length = self.at[slot].astype(np.int64), self.len[slot].astype(np.int64)
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            new, pos, back = np.unique(h[miss], return_index=True, return_inverse=True)
            pos = miss[pos]
            new_at, new_len = self._learn(raw, starts[pos], ends[pos], lead[pos])
            at[miss], length[miss] = new_at[back], new_len[back]
            self.key[slot[pos]], self.at[slot[pos]], self.len[slot[pos]] = new, new_at, new_len
        whole[doc[length < 0]] = True
        if whole.any():
            length[whole[doc]] = 0
        ends_at = np.cumsum(length, dtype=np.int64)
        total = int(ends_at[-1]) if len(ends_at) else 0
        ids = self.pool[np.repeat(at - (ends_at - length), length) + np.arange(total)]
        counts = np.concatenate([[0], ends_at])[before]
        if not whole.any():
            return ids, counts
        parts = []
        for i in range(n_docs):
            if whole[i]:
                text = raw[rel[i]:rel[i + 1]].tobytes().decode("utf-8", "replace")
                parts.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
            else:
                parts.append(ids[counts[i]:counts[i + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file (kept across the tasks of one Python worker)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)
