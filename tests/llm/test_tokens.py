"""The cached encoder equals the tokenizers library, on ordinary and on hostile texts."""
import random

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pytest

from tessera.llm import textvec as tv
from tessera.llm.tokens import Encoder, tokenizer_path

PIECES = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x1c", "\x00", "'s", "'ll",
          "é", "é", "́", "3", "42", ".", ",", "...", "<|endoftext|>", "<|ENDOFTEXT|>",
          "<|startoftext|>", "ß", "İ", "Σ", "日本", "\U0001f600", "᠎", "​",
          "%%%", "don't", "I'M", "_", "²", "ª", "µ", "×"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    texts += ["", " ", "\n", "x" * 5000, "one two " * 300, None]
    docs = ds.dataset("/root/testdata/sf0.001/documents.parquet").to_table(columns=["text"])
    texts += docs["text"].to_pylist()
    rng.shuffle(texts)
    enc = Encoder(tokenizer_path(name))
    for _ in range(2):                          # the second pass reads the warm table
        got = []
        for at in range(0, len(texts), 400):
            ids, before = enc.encode(*tv.utf8(pa.array(texts[at:at + 400], pa.string())))
            got += [ids[before[i]:before[i + 1]] for i in range(len(before) - 1)]
        for text, ids in zip(texts, got):
            want = enc.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids.tolist() == want, text
