"""Byte-level BPE encoding by a prefix-sharing trie traversal, and decoding.

The last token of a word's prefix determines the encoding of that prefix: token ``t`` ends the encoding of a prefix
``p`` exactly if ``t`` is a suffix of ``p`` and the last token of the rest can stand before ``t`` without the two
being merged across their border. So one state per trie node, its last token, holds the encoding of every prefix.
The distinct words of a block of texts, sorted by bytes, are the trie in depth-first order: the walk keeps the states
of the current path, drops those below the common prefix with the next word and computes each node once. Besides its
last token a node has the longest suffix that begins some token, from which its candidates follow, longest first.
Words are then read off backwards. Texts are joined from their words' ids; a worker remembers words up to a
bound in bytes. Decoding takes the ids' byte strings from the vocabulary, a batch at once.

Defined results: null and empty texts have no ids and decode to the empty text; added tokens in a text keep their own
id, as the tokenizer does by default; ids that form no valid UTF-8 decode with replacement characters. Both functions
work on a column, so rows with a null key, repeated rows and extra columns stay as they are, and an empty table gives
no rows. Texts are coded about two million bytes at a time; a longer one is coded whole, in one piece.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eligo.llm.common import Remembered, blocks, byte_letters, collector_off, table, text_of, tokenizer_path

#: White space as the pre-tokenizer's pattern understands it (fixed values).
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The public byte-level pre-tokenizer's contractions (fixed values).
SHORTENED = "'(?:s|t|re|ve|m|ll|d)"
#: Bytes of a word from which a walk's states lie in arrays, which take less room than lists.
HUGE_WORD = 1_000_000


@lru_cache(maxsize=1)
def letters_and_numbers() -> dict[str, list[tuple[int, int]]]:
    """Ranges of the characters that the tokenizers library takes as letters (L) and numbers (N), asked of its own
    pre-tokenizer, since Unicode versions differ. Neighbouring characters of one kind come as one pre-token."""
    from tokenizers.pre_tokenizers import ByteLevel

    cut = ByteLevel(add_prefix_space=False).pre_tokenize_str
    points = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    runs = [(points[a], points[b - 1]) for _, (a, b) in cut("".join(map(chr, points)))] + [(c, c) for c in range(0x80) if c != 32]
    out: dict[str, list[tuple[int, int]]] = {"L": [], "N": []}
    for first, last in sorted(runs):
        ends = [b for _, (_, b) in cut(f"a{chr(first)}1")]
        kind = "L" if ends == [2, 3] else "N" if ends == [1, 3] else None
        if kind:
            out[kind] += [(first, last)] if first > 0xFFFF or last <= 0xFFFF else [(first, 0xFFFF), (0x10000, last)]
    return out


def ranges(kind: str, beyond: bool) -> str:
    """A kind's characters from 0x10000 on, or below, as ranges of a character class."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in letters_and_numbers()[kind] if (a > 0xFFFF) == beyond)


@lru_cache(maxsize=1)
def basic_pretoken() -> re.Pattern:
    """The pre-tokenizer's cut for texts of characters under 0x10000."""
    letter, number = ranges("L", False), ranges("N", False)
    return re.compile(f" ?[{letter}]+|{SHORTENED}| ?[{number}]+| ?[^{BLANK}{letter}{number}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


@lru_cache(maxsize=1)
def full_pretoken() -> re.Pattern:
    """The same for all texts, slower."""
    letter, number, far_letter, far_number = (ranges(k, beyond) for beyond in (False, True) for k in "LN")
    other = f"(?![{far_letter}{far_number}])[^{BLANK}{letter}{number}]"
    return re.compile(f" ?(?:[{letter}]|[{far_letter}])+|{SHORTENED}| ?(?:[{number}]|[{far_number}])+| ?(?:{other})+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


def pretokens(text: str) -> list[str]:
    near = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
    return (basic_pretoken() if near else full_pretoken()).findall(text)


class TrieBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        # tokens numbered in the order in which merges apply; single bytes first
        self.text: list[bytes] = [bytes([b]) for b in range(256)] + [as_bytes(a + b) for a, b in merges]
        self.number: dict[bytes, int] = {}
        for k, t in enumerate(self.text):
            self.number.setdefault(t, k)
        self.parts = [(k, k) for k in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        for k, (a, b) in enumerate(merges, 256):
            pair = self.number[as_bytes(a)], self.number[as_bytes(b)]
            self.parts.append(pair)
            self.merged[pair] = k
        by_bytes = {as_bytes(t): i for t, i in vocab.items()}
        self.ids = [by_bytes[t] for t in self.text]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        out = {i: t for t, i in by_bytes.items()} | {i: c.encode() for c, i in self.added.items()}
        self.out = pa.array([out.get(i) for i in range(max(out) + 1)], pa.large_binary())
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.memory = Remembered()
        self.joins: dict[int, bool] = {}
        self.packed = [i.to_bytes(4, "little") for i in self.ids]
        self.sizes = [len(t) for t in self.text]
        # a token counts only if its own bytes encode to it
        self.whole = [True] * len(self.text)
        for k in range(256, len(self.text)):
            a, b = self.parts[k]
            self.whole[k] = self.whole[a] and self.whole[b] and self.stands(a, b, k)

        # beginnings of tokens, numbered; from one to the next by a byte; tokens that end each, filled as needed
        self.begins: dict[bytes, int] = {b"": 0}
        for t in self.text:
            for n in range(1, len(t) + 1):
                self.begins.setdefault(t[:n], len(self.begins))
        self.begin_text = list(self.begins)
        self.next: dict[int, int] = {}
        self.ending: list[list[tuple[int, int]] | None] = [None] * len(self.begins)

    def stands(self, a: int, b: int, below: int) -> bool:
        """Whether no merge numbered under ``below`` joins the border between tokens ``a`` and ``b``.

        The border is undone merge by merge, latest first; if an adjacent pair at any moment has a merge that comes
        before the one just undone, that merge would have happened."""
        while True:
            k = self.merged.get((a, b))
            if k is not None and k < below:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:
                below, a = a, self.parts[a][1]
            else:
                below, b = b + 1, self.parts[b][0]

    def meets(self, a: int, b: int) -> bool:
        if len(self.joins) > 2_000_000:
            self.joins.clear()
        known = self.joins[a << 20 | b] = self.stands(a, b, 1 << 30)
        return known

    def step(self, at: int, byte: int) -> int:
        """The longest beginning of a token that ends beginning ``at`` followed by ``byte``."""
        t = self.begin_text[at] + bytes([byte])
        while t not in self.begins:
            t = t[1:]
        to = self.next[at << 8 | byte] = self.begins[t]
        if self.ending[to] is None:
            ends = (self.number.get(t[k:]) for k in range(len(t)))
            self.ending[to] = [(k, len(self.text[k])) for k in ends if k is not None and self.whole[k]]
        return to

    def walk(self, words: list[bytes]):
        """The ids, as bytes, of each of the sorted distinct words: a depth-first walk of their trie."""
        forward, ending, joins, sizes, packed = self.next.get, self.ending, self.joins.get, self.sizes, self.packed
        row = (lambda x: array("i", x)) if max(map(len, words), default=0) > HUGE_WORD else list
        before, last, state = b"", row([-1]), row([0])
        for word in words:
            n = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                n += 1
            del last[n + 1 :], state[n + 1 :]
            at = state[n]
            for end, byte in enumerate(word[n:], n + 1):
                to = forward(at << 8 | byte)
                at = self.step(at, byte) if to is None else to
                state.append(at)
                for k, size in ending[at]:
                    if size == end:
                        break
                    a = last[end - size]
                    met = joins(a << 20 | k)
                    if self.meets(a, k) if met is None else met:
                        break
                last.append(k)
            before, at, tokens = word, len(word), []
            while at:
                k = last[at]
                tokens.append(packed[k])
                at -= sizes[k]
            tokens.reverse()
            yield b"".join(tokens)

    def learn(self, words: list[str]) -> list[bytes]:
        order = sorted(words)  # by code points, which is the order of their bytes
        found = dict(zip(order, self.walk([w.encode() for w in order])))
        return [found[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        special = self.special
        cut, added = [], {}
        for i, t in enumerate(texts):
            if special and special.search(t):
                added[i] = [self.added[part] if k % 2 else pretokens(part) for k, part in enumerate(special.split(t))]
                cut.append([w for part in added[i] if type(part) is list for w in part])
            else:
                cut.append(pretokens(t))
        get = self.memory.all(set().union(*cut), self.learn)
        out = [b"".join(map(get, c)) for c in cut]
        for i, parts in added.items():
            out[i] = b"".join(p.to_bytes(4, "little") if type(p) is int else b"".join(map(get, p)) for p in parts)
        return out

    def decode(self, ids: pa.Array, ends: np.ndarray) -> pa.Array:
        """The texts of rows of ids; row k holds ``ids[ends[k]:ends[k + 1]]``."""
        tokens = self.out.take(ids)
        if tokens.null_count:
            raise ValueError("an id that the vocabulary does not have")
        _, offsets, data = tokens.buffers()
        stops = np.frombuffer(offsets, np.int64, len(tokens) + 1)[ends]
        texts = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(stops), data or pa.py_buffer(b"")])
        try:
            texts.validate(full=True)
            return texts.cast(pa.string())
        except pa.ArrowInvalid:  # some row is no valid UTF-8
            raw = memoryview(data)
            return pa.array([bytes(raw[a:b]).decode("utf-8", "replace") for a, b in zip(stops, stops[1:])], pa.string())


@lru_cache(maxsize=2)
def coder(path: str) -> TrieBpe:
    return TrieBpe(path)


def encode(text: Column, tokenizer: str | None = None) -> Column:
    """array<int> of the text's ids."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    @arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        bpe, sizes, parts = coder(path), [0], []
        lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        with collector_off():
            for at, to in blocks(lengths):
                for coded in bpe.encode([t or "" for t in texts.slice(at, to - at).to_pylist()]):
                    sizes.append(len(coded) // 4)
                    parts.append(coded)
        values = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), values)

    return run(text)


def decode(ids: Column, tokenizer: str | None = None) -> Column:
    """The text that ids stand for, added tokens included; null for null."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")

    @arrow_udf("string")
    def run(arrays: pa.Array) -> pa.Array:
        bpe, parts = coder(path), []
        lengths = pa.compute.fill_null(pa.compute.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)
        for at, to in blocks(lengths):
            part = arrays.slice(at, to - at)
            parts.append(bpe.decode(part.flatten(), np.concatenate(([0], np.cumsum(lengths[at:to], dtype=np.int64)))))
        texts = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
        return pa.compute.if_else(arrays.is_valid(), texts, None) if arrays.null_count else texts

    return run(ids)


def op4_bpe_trie(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", encode(text_of(docs)).alias("ids"))
    coded = coded.select("doc_id", "ids", decode(F.col("ids")).alias("decoded"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
