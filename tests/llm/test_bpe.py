"""op13: ids and decoded text equal those of the library that the file belongs to."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from meterflow.llm import bpe
from tests.llm import tables

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.load(PATH).ready()


def check(library, own, text):
    want = library.encode(text, add_special_tokens=False).ids
    packed = own.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == want, text[:80]
    assert bpe.emit(own.labels, packed) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "",
        " \n\t\x0b ",
        "don't WE'LL it's 'sad 12345 ?!... a-b_c",
        "<|startoftext|>Hello<|endoftext|><|endoftext|> <|STARTOFTEXT|>",
        "é<|endoftext|>́ İI ΣΑΣ straße ǅ",
        "x\x1cy !\x1c! \x1d\x1e \x85z w ​q ᠎﻿ \x00",
        "\U0001f600\U0001f600 日本語 ال ไทย",
        "a" * 5000 + "ha" * 3000,
    ],
)
def test_awkward_texts(library, own, text):
    check(library, own, text)


def test_random_texts(library, own):
    rng = random.Random(13)
    pools = ["abcdeinst", "aA'stremld1 !.?-\t\nÀé", "ha", "éèΣЖ一\U0001f600 ' "]
    for k in range(3000):
        check(library, own, "".join(rng.choice(pools[k % 4]) for _ in range(rng.randint(1, 60))))


def test_slices_end_between_words(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 7)
    for text in ["one two  three, four\x1c!!five six", "x" * 40 + " y", "don't we'll " * 9]:
        own._known.clear()
        check(library, own, text)


def merged(symbols, merges, word):
    """Byte-pair merging by its definition: the pair of the best rank, leftmost first, again and again."""
    rank = {pair: i for i, pair in enumerate(merges)}
    while True:
        pairs = [(rank[p], i) for i, p in enumerate(zip(word, word[1:])) if p in rank]
        if not pairs:
            return word
        _, i = min(pairs)
        word = [*word[:i], word[i] + word[i + 1], *word[i + 2 :]]


def test_automaton_accepts_exactly_right_neighbours():
    """Random small merge lists, runs of one letter included: arcs against merging by definition."""
    rng = random.Random(5)
    for _ in range(30):
        symbols, merges = list("abc"), []
        while len(merges) < 9:
            known = symbols + [x + y for x, y in merges]
            pair = (rng.choice(known), rng.choice(known))
            if pair[0] + pair[1] not in known:
                merges.append(pair)
        labels, states, bits = bpe.compile_merges(symbols, merges, "")
        right = {x: merged(symbols, merges, list(x)) == [x] for x in labels}
        for s, left in enumerate(states):
            for c, following in enumerate(labels):
                if right[left] and right[following]:
                    follows = merged(symbols, merges, list(left + following)) == [left, following]
                    assert bool(bits[c, s >> 3] >> (s & 7) & 1) == follows, (merges, left, following)


def test_improper_merges_are_refused():
    with pytest.raises(ValueError):
        bpe.compile_merges(["a", "b"], [("ab", "a"), ("a", "b")], "")
    with pytest.raises(ValueError):
        bpe.compile_merges(["a", "b"], [("a", "a"), ("aa", "a"), ("a", "aa")], "")


def test_awkward_table(spark, library):
    docs = tables.awkward(spark).withColumnRenamed("note", "token_ids")
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(got) == docs.count()
    for row in got:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(row.token_ids), "<u4").tolist() == want
        assert row.n_tokens == len(want) and row.decoded == library.decode(want, skip_special_tokens=False)
        assert row._key == "k"
    once = bpe.encode(docs, PATH, decoded=True)
    assert set(once.columns) == {*docs.columns, "n_tokens", "decoded"}
    assert sorted(r.decoded for r in once.collect()) == sorted(r.decoded for r in got)
    assert bpe.encode(tables.no_rows(spark), PATH).count() == 0


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in bpe.query(spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        found = got.pop(row.doc_id)
        assert found.n_tokens == len(ids)
        assert found.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert found.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert not got
