"""BPE by a tokenization automaton: merges compiled to a table, words read by its transitions.

A tokenization is right if and only if all its neighbours may follow each other, so
the right tokenizations of all words are the language of a deterministic automaton
over tokens. Its state is the last token's, its arcs are labelled with the next token.
``compile_merges`` builds it by one gadget per merge, in order of rank. It starts from
the automaton in which every symbol may follow every other. The gadget of ``a b -> c``

* gives c the arcs into it that a has, and the arcs out of it that b has (as they are
  at that rank), so that c stands wherever a and then b stood;
* takes the arc b from the state behind a, since that pair is always merged; if a is b,
  the arc c goes as well, since a run of a is merged from its left end.

States with equal arcs are one state, and labels that leave the same states share a
column. The table has a bit for each state and column: about 20 MB for 49,000 merges,
at most (tokens ^ 2) / 8 bytes whatever the corpus; the driver compiles it once for a
file and broadcasts it.

Encoding reads a word from left to right. Every prefix has one right tokenization, so a
position holds one state; from it the labels that match the next symbols are found in a
trie, the longest that the table allows is taken, and shorter ones if the end cannot be
reached from there. Every position is left once at most, so cost grows with the length
of the word times that of the longest token. Words met before are taken from a bounded
memory of ``CACHE`` words. Decoding emits the labels of the arcs.

``encode`` gives the ids packed as little-endian unsigned 32-bit integers, as shards of
tokens are stored. Normalising and splitting follow the tokenizer's file; files with
other parts than those read here are an error, not a guess.

Defined results: a null or empty text, or one of white space alone, has no tokens and
decodes to the empty text. Strings of the file's special tokens in a text become their
ids. Ids that the file does not have decode to nothing. What a letter or number is,
``regex`` decides; letters that only its Unicode version has may split otherwise elsewhere. Equal rows get equal results;
other columns are kept, and columns named like those added are replaced; an empty
table gives an empty table.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import scratch

#: Words whose tokens a worker remembers.
CACHE = 400_000
#: Characters of normalised text that are split into words at once.
SLICE = 1 << 18
#: The file of the registered query, among those of the installed vocabularies.
VOCABULARY = "word_bpe_49k.json"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabularies over bytes.

    Fixed rule of such files: bytes that print as Latin-1 stand for themselves, the
    others are numbered from U+0100.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def compile_merges(symbols: list[str], merges: list[tuple[str, str]], end: str):
    """Bits of the automaton: (labels, states, bits); bits[label, state] is whether the arc exists.

    ``states`` are the labels that do not end a word (nothing follows the others).
    Every merge must join labels made before it, and no label may be made twice: only
    then does the order of the ranks decide alone.
    """
    labels = [*symbols, *(a + b for a, b in merges)]
    column = {label: i for i, label in enumerate(labels)}
    if len(column) < len(labels):
        raise ValueError("two merges make the same token")
    states = [label for label in labels if not (end and label.endswith(end))]
    state = {label: i for i, label in enumerate(states)}
    bits = np.zeros((len(labels), -(-len(states) // 8)), np.uint8)
    inner = np.zeros(len(states), np.uint8)
    inner[[state[s] for s in symbols if s in state]] = 1
    bits[: len(symbols)] = np.packbits(inner, bitorder="little")
    made = len(symbols)
    for a, b in merges:
        if a not in state or max(column[a], column.get(b, made)) >= made:
            raise ValueError(f"merge of {a!r} and {b!r} comes before its parts")
        bits[made] = bits[column[a]]
        if a + b in state:
            into, like = state[a + b], state[b]
            known = bits[: made + 1]
            known[:, into >> 3] |= ((known[:, like >> 3] >> (like & 7)) & 1) << (into & 7)
        behind = state[a]
        gone = [column[b], made] if a == b else [column[b]]
        bits[gone, behind >> 3] &= np.uint8(255 ^ (1 << (behind & 7)))
        made += 1
    return labels, states, bits


def _classes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each row and the first row of each class."""
    seen: dict[bytes, int] = {}
    of = np.array([seen.setdefault(r.tobytes(), len(seen)) for r in rows], np.int32)
    return of, np.unique(of, return_index=True)[1]


@dataclass
class Tokenizer:
    """A compiled tokenizer file; ``table`` holds a row of bits for each state."""

    labels: list[str | None]
    token: dict[str, int]
    column: dict[str, int]
    state: dict[str, int]
    table: list[bytes]
    end: str
    words: str
    normal: list[str]
    special: dict[str, int]
    _trie: list | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_trie": None}

    def ready(self) -> "Tokenizer":
        """Build what is only needed where words are read."""
        if self._trie is None:
            #: A node: its children, its arc within a word, its arc at a word's end;
            #: an arc: byte and bit of its column, row of the state behind it, id.
            self._trie = [{}, None, None]
            self._letters = dict(enumerate(byte_letters()))
            self._start = bytes([255]) * (max(self.column.values()) // 8 + 1)
            size = len(self.end)
            for label, column in self.column.items():
                last = bool(size) and label.endswith(self.end)
                node = self._trie
                for letter in label[:-size] if last else label:
                    node = node[0].setdefault(letter, [{}, None, None])
                behind = self.state.get(label)
                row = b"" if behind is None else self.table[behind]
                node[1 + last] = (column >> 3, 1 << (column & 7), row, self.token[label])
            self._longest = max(map(len, self.column))
            self._split, self._space = regex.compile(self.words), regex.compile(r"\s")
            self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
            self._odd = re.compile("[\x1c-\x1f]")
            self._known: dict[str, bytes] = {}
        return self

    def word(self, word: str) -> list[int]:
        """The ids of one word, by the transitions of the automaton.

        Longest labels are tried first. A position from which the end cannot be reached is
        dead for good, since all ways to it are in the same state; so no position is left twice.
        """
        plain = word.isascii() and word.isprintable()
        symbols = word if plain else word.encode().decode("latin-1").translate(self._letters)
        n, dead, ids, held = len(symbols), set(), [], []
        i, row = 0, self._start
        while i < n:
            node, j, arcs = self._trie, i, []
            for letter in symbols[i : i + self._longest]:
                node = node[0].get(letter)
                if node is None:
                    break
                j += 1
                arc = node[1] if j < n else node[2]
                if arc is not None:
                    arcs.append((j, arc))
            while True:
                while arcs:
                    j, (byte, bit, behind, token) = arcs.pop()
                    if row[byte] & bit and j not in dead:
                        held.append((i, row, arcs))
                        ids.append(token)
                        i, row = j, behind
                        break
                else:
                    dead.add(i)
                    i, row, arcs = held.pop()
                    ids.pop()
                    continue
                break
        return ids

    def normalise(self, text: str) -> str:
        """The text as the file's normalizers leave it; white space stays, since no word holds any."""
        for step in self.normal:
            if step == "Lowercase":
                text = text.replace("Σ", "σ").lower()  # letter by letter: no form for word ends
            elif not text.isascii():
                text = unicodedata.normalize(step, text)
        return text

    def _chunks(self, text: str):
        """Normalised text between white space, a slice at a time."""
        low = 0
        while low < len(text):
            high = low + SLICE
            if high < len(text):  # a slice ends at white space, which no word holds
                space = self._space.search(text, high)
                high = space.start() if space else len(text)
            part = text[low:high]
            # Python also splits at the separators U+001C to U+001F, which are no white space here
            yield self._space.split(part) if self._odd.search(part) else part.split()
            low = high

    def _chunk(self, chunk: str) -> bytes:
        """The packed ids of the words between two white spaces; single words are remembered."""
        if chunk.isalpha():
            return self._word(chunk)
        if chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
            return self._word(chunk[:-1]) + self._word(chunk[-1])
        return b"".join(map(self._word, self._split.findall(chunk)))

    def _word(self, word: str) -> bytes:
        known = self._known.get(word)
        if known is None:
            if len(self._known) >= CACHE:
                self._known.clear()
            ids = self.word(word)
            known = self._known[word] = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text, packed."""
        known, packed, low = self._known, [], 0
        text = text or ""
        for hit in [*self._special.finditer(text), None]:
            for chunks in self._chunks(self.normalise(text[low : hit.start() if hit else len(text)])):
                packed.append(b"".join([known.get(chunk) or self._chunk(chunk) for chunk in chunks]))
            if hit:
                packed.append(np.array([self.special[hit[0]]], "<u4").tobytes())
                low = hit.end()
        return b"".join(packed)


def _expect(found, wanted, what: str) -> None:
    if found != wanted:
        raise ValueError(f"{what} of the tokenizer file: {found!r} is not supported")


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    """Compile a tokenizer file of the kind read here: word-end BPE over bytes, split by one pattern."""
    with open(path, encoding="utf-8") as lines:
        given = json.load(lines)
    model, before = given["model"], given["pre_tokenizer"]["pretokenizers"]
    _expect(model["type"], "BPE", "model")
    for key in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"):
        _expect(bool(model.get(key)), False, key)
    _expect([p["type"] for p in before], ["Split", "ByteLevel"], "pre-tokenizer")
    _expect((before[0]["behavior"], before[0]["invert"]), ("Removed", True), "split")
    _expect((before[1]["add_prefix_space"], before[1]["use_regex"]), (False, False), "byte level")
    _expect(given["decoder"], None, "decoder")
    normal = []
    for step in given["normalizer"]["normalizers"]:
        if step["type"] == "Replace":
            _expect((step["pattern"], step["content"]), ({"Regex": r"\s+"}, " "), "replacement")
        else:
            _expect(step["type"] in ("NFC", "Lowercase"), True, "normalizer")
            normal.append(step["type"])
    for added in given["added_tokens"]:
        _expect([added[k] for k in ("single_word", "lstrip", "rstrip", "normalized")], [False] * 4, "added token")
    special = {added["content"]: added["id"] for added in given["added_tokens"]}
    end, token = model["end_of_word_suffix"] or "", model["vocab"]
    letters = byte_letters()
    symbols = letters + [letter + end for letter in letters] if end else letters
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    labels, states, bits = compile_merges(symbols, merges, end)
    column, first = _classes(bits)
    arcs = np.unpackbits(bits[first], axis=1, bitorder="little")[:, : len(states)].T
    state, first = _classes(np.packbits(arcs, axis=1, bitorder="little"))
    table = [row.tobytes() for row in np.packbits(arcs[first], axis=1, bitorder="little")]
    named = {i: label for label, i in [*token.items(), *special.items()]}
    return Tokenizer(
        labels=[named.get(i) for i in range(max(named) + 1)],
        token=token,
        column=dict(zip(labels, column.tolist())),
        state=dict(zip(states, state.tolist())),
        table=table,
        end=end,
        words=before[0]["pattern"]["Regex"],
        normal=normal,
        special=special,
    )


@scratch.shielded
def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``token_ids`` (packed) and ``n_tokens`` of every whole text.

    ``decoded`` adds the text that the ids decode to, from the same pass over the rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    @F.arrow_udf("struct<ids:binary,back:string>" if decoded else "struct<ids:binary>")
    def apply(texts: pa.Array) -> pa.Array:
        reader = shared.value.ready()
        ids = [reader.encode(t.as_py()) for t in texts]
        columns = {"ids": pa.array(ids, pa.binary())}
        if decoded:
            columns["back"] = pa.array([emit(reader.labels, packed) for packed in ids], pa.string())
        return pa.StructArray.from_arrays(list(columns.values()), list(columns))

    found = docs.withColumn("_read", apply(F.col(text).cast("string"))).withColumn("token_ids", F.col("_read.ids"))
    found = found.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))
    return (found.withColumn("decoded", F.col("_read.back")) if decoded else found).drop("_read")


@scratch.shielded
def decode(rows: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``rows`` with ``decoded``: the labels of the packed ids."""
    shared = rows.sparkSession.sparkContext.broadcast(load(path).labels)

    @F.arrow_udf("string")
    def apply(packed: pa.Array) -> pa.Array:
        labels = shared.value
        return pa.array([emit(labels, p.as_py()) for p in packed], pa.string())

    return rows.withColumn("decoded", apply(F.col(ids)))


def emit(labels: list[str | None], packed: bytes | None) -> str:
    """The labels of packed ids, joined by a space, since the file names no decoder."""
    ids = np.frombuffer(packed or b"", "<u4")
    ids = ids[ids < len(labels)].tolist()
    return " ".join([label for label in map(labels.__getitem__, ids) if label is not None])


def query(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Tokens of every document and digests of its ids and of the text they decode to."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = encode(docs, path, decoded=True)
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
