"""The encoder against whole texts by the library, and how much of it runs word by word."""

from __future__ import annotations

import random
import sys

import pyarrow as pa
import pytest

from creditflow.llm import packing, records, tokens
from creditflow.llm.queries import tokenizer_path

#: Letters, endings, signs, numerals and blanks of all kinds, and special tokens.
PARTS = [
    *"aAbsSTdmMlLrevV''''  \t\n\x0b\r.,-!?<|>/w059", "'s", "'LL", "'re", "n't", "'S", "²", "½", "ª", "\u02bc", "é", "É", "e\u0301", "\u0301", "\u0130", "ß",
    "Σ", "ς", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "<|startoftext|>", "<|ENDOFTEXT|>", "</w>", "漢字", "\U0001f600", "’", "\x00", "Ж", "д", "\u0482",
    "\u0483", "\uac01", "\u1100", "…", "€", "—", "«", "µ", "÷", "×", "\u01c4", "\u017f", "\u212a", "\ufb01", "\xad", "\ufeff", "\u200b", "\u023a", "\u0663", "\U00010400", "\u2160",
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokenizer_path())


def new_words(n: int) -> list[str]:
    rnd = random.Random(5)
    return ["".join(rnd.choices("abcdefghiéß", k=9)) + rnd.choice(["", ",", "."]) for _ in range(n)]


def calls_of(function) -> int:
    """Calls of Python and C functions while ``function`` runs."""
    n = 0

    def count(_frame, event, _arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        function()
    finally:
        sys.setprofile(None)
    return n


@pytest.mark.parametrize("seed", range(6))
def test_ids_of_hard_texts(encoder, monkeypatch, seed):
    rnd = random.Random(seed)
    for _ in range(60):
        monkeypatch.setattr(tokens, "BLOCK_BYTES", rnd.choice([1, 30, 1 << 20]))
        monkeypatch.setattr(tokens, "JOINED", rnd.choice([1, 3, 256]))
        monkeypatch.setattr(tokens, "MEMORY", rnd.choice([10, 600_000]))
        some = rnd.sample(PARTS, rnd.randint(2, 25))
        texts = [None if rnd.random() < 0.05 else "".join(rnd.choices(some, k=rnd.randint(0, 30))) for _ in range(12)]
        got = []
        for at, to, ids, first in encoder.encode(pa.array(texts, pa.string()), 1):
            got += [ids[first[i] : first[i + 1]].tolist() for i in range(to - at)]
        assert got == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_pieces_of_new_words_run_on_arrays():
    """New words cost no Python calls of their own: calls grow by blocks and joined texts."""
    words = new_words(20_000)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(words)]})
    tokens.encoder(tokenizer_path()).close()
    assert calls_of(lambda: list(packing.pieces(tokenizer_path(), 1, 4096, iter([batch])))) < len(words) / 4


def test_records_of_new_words_run_on_arrays(encoder):
    """Also where many texts are encoded one behind the other: a few calls for each text."""
    words, n = new_words(20_000), 100
    texts = [" ".join(words[i::n]) for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": texts})
    encoder.close()
    got = []
    assert calls_of(lambda: got.extend(records._sequences(batch, encoder, 1))) < len(words) / 4
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert [(d, ids.tolist()) for d, ids in got] == list(enumerate(whole))
