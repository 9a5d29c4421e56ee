"""The encoder of runs: equal to the tokenizer whatever it remembers, within its bytes, without needless passes."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridledger.llm import packing
from gridledger.llm.queries import word_tokenizer

ODD = ["don't a$'s '$a", "a<|endoftext|>b, c", "J̌! x≠y ΑΣ", "日本語 z\x1cq 12.5%", None, "", "  ", "\n", "ẞ İi ŉ éé. ﬁ", "a\x00b c"]


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices(packing.LETTERS, k=rng.randint(1, 14))) for _ in range(300)]
    return ["".join(rng.choice(words) + rng.choice([" ", ", ", "\n", ".\t", "-", "'", "7"]) for _ in range(40)) for _ in range(n)] + ODD


def plain(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("limit", [0, 20_000, 64 << 20])
def test_ids_equal_the_tokenizer_whatever_is_remembered(monkeypatch, limit):
    monkeypatch.setattr(packing, "CACHE_BYTES", limit)
    tokenizer, encoder = Tokenizer.from_file(word_tokenizer()), packing.WordEncoder(word_tokenizer())
    for seed in (1, 2, 1, 3, 2, 1):
        rows = texts(seed)
        assert encoder.encode(pa.array(rows, pa.string())) == [plain(tokenizer, t) for t in rows]
        assert len(encoder.known) == len(encoder.ids) == len(encoder.used)
    assert encoder.encode(pa.array([None, "", " "], pa.string())) == [b""] * 3
    assert encoder.encode(pa.array([], pa.string())) == []
    assert encoder.encode(pa.array(ODD * 2, pa.string())[3:12]) == [plain(tokenizer, t) for t in (ODD * 2)[3:12]]


def test_remembered_bytes_are_limited_and_frequent_runs_stay(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 200_000)
    encoder = packing.WordEncoder(word_tokenizer())
    for i in range(40):  # long runs: few of them, many bytes
        encoder.encode(pa.array([f"the {'x' * 3000}{i} and {'日' * 2000}{i} here"]))
    assert encoder.bytes + encoder.ids.nbytes < 200_000 + 30_000 and encoder.bytes == packing._size(list(encoder.known))
    assert {"the", "and", "here"} <= set(encoder.known) and len(encoder.known) < 80
    learnt, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda runs: learnt.extend(runs) or learn(runs))
    encoder.encode(pa.array(["the and here, the new"]))
    assert sorted(learnt) == [",", "new"]


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.runs, self.model = tokenizer, [], tokenizer.model

    def encode_batch_fast(self, runs, **options):
        self.runs += runs
        return self.tokenizer.encode_batch_fast(runs, **options)


def test_runs_of_letters_need_no_normalizer():
    encoder = packing.WordEncoder(word_tokenizer())
    tokenizer = encoder.tokenizer
    encoder.tokenizer = Counting(tokenizer)
    text = "Öffentliche Straße, über ÉTÉ! façon año don't 12"
    assert encoder.encode(pa.array([text])) == [plain(tokenizer, text)]
    assert sorted(encoder.tokenizer.runs) == ["!", ",", "12", "don't"]
