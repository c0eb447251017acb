"""Word hashes of Arrow batches against plain splitting."""

import numpy as np
import pyarrow as pa
import pytest

from meterflow.llm import hashing
from tests.llm.tables import words

TEXTS = ["", None, "a b  c\n", "a", "ñandú é x", " lead trail ", "ab", "word" * 100 + " z", "x y", "a b", "A, b!"] * 3


@pytest.mark.parametrize("size", [7, 50, 1 << 19])
def test_words_and_offsets(monkeypatch, size):
    monkeypatch.setattr(hashing, "SLICE", size)
    texts = pa.array(TEXTS)
    hashes, rows, starts, ends = hashing.words(texts)
    raw, _ = hashing.utf8(texts)
    want = [(i, w) for i, t in enumerate(TEXTS) for w in words(t)]
    assert [(int(r), bytes(raw[s:e]).decode()) for r, s, e in zip(rows, starts, ends)] == want
    by_word = {}
    for (_, w), h in zip(want, hashes):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_folded_words_ignore_case_and_marks():
    a = hashing.words(pa.array(["The cat, sat."]), fold=True)[0]
    b = hashing.words(pa.array(["the CAT sat"]), fold=True)[0]
    assert len(a) == 3 and (a == b).all()


def test_windows_stay_within_a_row():
    hashes, rows, _, _ = hashing.words(pa.array(["a b c", "a b", "b c a b"]))
    grams, first = hashing.windows(hashes, rows, 2)
    assert first.tolist() == [0, 1, 3, 5, 6, 7]
    assert grams[0] == grams[2] == grams[5] and grams[1] == grams[3] and grams[4] != grams[0]


def test_slices_cover_all_rows():
    texts = pa.array(["x" * 10, None, "y" * 500, "", "z"])
    parts = list(hashing.slices(texts, 100))
    assert parts[0][0] == 0 and parts[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert list(hashing.slices(pa.array([], pa.string()))) == []


def test_no_texts():
    assert [len(x) for x in hashing.words(pa.array([], pa.string()))] == [0, 0, 0, 0]
    assert isinstance(hashing.mix(np.zeros(1, np.uint64)), np.ndarray)
