"""Piece BPE (with byte fallback) encoding by vectorised merge rounds, and decoding.

A text gets a blank in front; blanks are the vocabulary's space symbol. No piece of the vocabulary has a blank after
another character, and most characters outside the Latin and Cyrillic letters stand in no piece of several characters,
so a text is cut into words that merge on their own. The distinct words of a block of texts that a worker does not
remember are encoded together, in rounds over flat numpy arrays of symbols: the least rank of an adjacent pair in each
word (a segmented minimum), all its pairs of that rank merged at once from the left, words without a pair taken out.

The library merges one pair at a time, the best one first and of equals the leftmost. To merge several at once is the
same if no merge can make a pair of the same or a better rank. Where the vocabulary has a longer piece that ranks no
worse (a "restless" piece), a merge may be followed by merges around it that come before the next pair of the old rank.
These never grow a symbol beyond the longest piece; so only pairs that have no other of their rank within twice that
length before them are merged in one round.

Defined results: null and empty texts have no ids and decode to the empty text; characters that the vocabulary lacks
become the ids of their bytes; control strings in a text are ordinary text; ids of bytes that form no valid UTF-8 decode
to a replacement character each. Both functions work on a column, so rows with a null key, repeated rows and extra
columns stay as they are, and an empty table gives no rows. Texts are coded about two million bytes at a time; a longer
one is coded whole, in one piece. Words of over 64 characters are cut again wherever two neighbours adjoin in no piece;
of an unbroken run that has not ended after ``ROUNDS`` rounds the rest is merged pair by pair from a heap, which is
exact too and takes time with its length only.
"""

from __future__ import annotations

import heapq
import re
import struct
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eligo.llm.common import Remembered, blocks, collector_off, table, text_of, tokenizer_path

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.int32(2**31 - 1)
#: What an unknown id decodes to (fixed value).
UNKNOWN_TEXT = " ⁇ "
LONG_WORD = 64
ROUNDS = 300


def messages(data: bytes):
    """(field number, value) of a protocol buffer message: whole numbers as int, everything else as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, data[at : at + size]
        at += size


class Pieces:
    """A piece vocabulary: what merges with what, and what ids stand for."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(messages(f.read()))
        found = [dict(messages(v)) for k, v in model if k == 1]
        shape = dict(messages(dict(model)[3]))
        if shape.get(2) or not shape.get(3, 1) or shape.get(4, 1):
            raise ValueError("only vocabularies without normalisation, with a blank in front, are supported")
        text = [d[1].decode() for d in found]
        score = [struct.unpack("<f", d.get(2, b"\0\0\0\0"))[0] for d in found]
        kind = [d.get(3, NORMAL) for d in found]
        if not set(kind) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only normal, control and byte pieces are supported")
        self.kind = np.array(kind, np.int8)
        normal = {t: i for i, (t, k) in enumerate(zip(text, kind)) if k == NORMAL}
        order = {s: k for k, s in enumerate(sorted({score[i] for i in normal.values()}, reverse=True))}
        several = [t for t in normal if len(t) > 1]
        if any(SPACE in t.lstrip(SPACE) for t in several):
            raise ValueError("a piece has a blank inside")

        # a symbol: the id of a piece; beyond, a character that stands in pieces only; below 0, any other character
        symbol, letters = dict(normal), sorted({c for t in several for c in t})
        for c in letters:
            symbol.setdefault(c, len(text) + len(symbol))
        self.first = -1 - np.arange(0x110000, dtype=np.int32)
        for t, s in symbol.items():
            if len(t) == 1:
                self.first[ord(t)] = s
        self.first[ord(" ")] = self.first[ord(SPACE)]
        self.span = np.int64(max(symbol.values()) + 1)

        pairs, restless = {}, set()
        for t in several:
            rank = order[score[normal[t]]]
            for k in range(1, len(t)):
                a, b = t[:k], t[k:]
                if a in symbol and b in symbol:
                    pairs[symbol[a] * int(self.span) + symbol[b]] = normal[t], rank
                    restless |= {order[score[normal[x]]] for x in (a, b) if len(x) > 1 and order[score[normal[x]]] >= rank}
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.ranks = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.restless = np.zeros(len(order), bool)
        self.restless[list(restless)] = True
        self.apart = 2 * max(map(len, several))

        # words: blanks and the letters after them; other characters
        joined = "".join(re.escape(c) for c in letters if c != SPACE)
        self.cut = re.compile(f" *[{joined}]+| +|[^ {joined}]+").findall
        self.adjoin = np.array(sorted({ord(x) << 32 | ord(y) for t in several for x, y in zip(t, t[1:])}), np.int64)

        self.bytes = np.zeros(256, np.int32)
        for i, (t, k) in enumerate(zip(text, kind)):
            if k == BYTE:
                self.bytes[int(t[3:-1], 16)] = i
        as_bytes = {NORMAL: lambda t: t.replace(SPACE, " ").encode(), UNKNOWN: lambda t: UNKNOWN_TEXT.encode(), CONTROL: lambda t: b"", BYTE: lambda t: bytes([int(t[3:-1], 16)])}
        self.out = [as_bytes[k](t) for t, k in zip(text, kind)]
        self.table = pa.array(self.out, pa.large_binary())
        self.blank = np.array([k == NORMAL and t.startswith(SPACE) for t, k in zip(text, kind)])
        self.memory = Remembered()

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of adjacent symbols; rank NONE for those that do not merge."""
        keys = left * self.span + right
        keys[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.merged[at], np.int32(0))

    def rounds(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, sizes) of words after all merges. ``symbols``: those of all words, one after the other; a word has
        ``sizes`` of them, one at least."""
        words = np.arange(len(sizes))
        done_words, done_sizes, done_symbols = [], [], []
        symbols = symbols.astype(np.int64)
        rank, piece = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int32)
        if len(symbols) > 1:
            rank[:-1], piece[:-1] = self.pairs(symbols[:-1], symbols[1:])
        rank[np.cumsum(sizes) - 1] = NONE  # the last of a word has no neighbour
        for k in range(ROUNDS):
            if not len(words):
                break
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, starts)
            over = least == NONE
            if over.any():
                gone = np.repeat(over, sizes)
                done_words.append(words[over])
                done_sizes.append(sizes[over])
                done_symbols.append(symbols[gone])
                stay = ~gone
                symbols, rank, piece, words, sizes, least = symbols[stay], rank[stay], piece[stay], words[~over], sizes[~over], least[~over]
                if not len(words):
                    break
                starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(words)), sizes)
            at = np.flatnonzero(rank == least[owner])
            own = owner[at]
            new_word = np.concatenate(([True], own[1:] != own[:-1]))
            gap = np.diff(at, prepend=at[0])
            # of neighbours that overlap, every second one
            run = np.flatnonzero(new_word | (gap > 1))
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            take = np.where(self.restless[least[own]], new_word | (gap > self.apart), place % 2 == 0)
            at = at[take]
            symbols[at] = piece[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            own = owner[at]
            sizes = sizes - np.bincount(own, minlength=len(sizes))
            # the pairs of a merged symbol with what is now to its left and to its right
            rank[at] = rank[at + 1]
            at = at - np.arange(len(at))
            symbols, rank, piece = symbols[keep], rank[keep], piece[keep]
            ends = np.cumsum(sizes) - 1
            rank[ends] = NONE
            fresh = np.concatenate((at, at[at > 0] - 1))
            last = np.zeros(len(symbols), bool)
            last[ends] = True
            fresh = fresh[~last[fresh]]
            rank[fresh], piece[fresh] = self.pairs(symbols[fresh], symbols[fresh + 1])
        ends = np.cumsum(sizes).tolist()
        for word, a, b in zip(words.tolist(), [0, *ends], ends):
            rest = self.one_by_one(symbols[a:b], rank[a:b], piece[a:b])
            done_words.append([word])
            done_sizes.append([len(rest)])
            done_symbols.append(rest)
        if not done_words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        words, sizes, symbols = map(np.concatenate, (done_words, done_sizes, done_symbols))
        # back to the words' own order
        order = np.argsort(words)
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        begin = np.cumsum(sizes) - sizes
        return symbols[np.repeat(starts - begin, sizes) + np.arange(len(symbols))], sizes

    @cached_property
    def by_key(self) -> dict[int, tuple[int, int]]:
        return {k: (p, r) for k, p, r in zip(self.keys.tolist(), self.merged.tolist(), self.ranks.tolist())}

    def one_by_one(self, symbols: np.ndarray, rank: np.ndarray, piece: np.ndarray) -> list[int]:
        """The symbols of one word after all merges, the best pair first; ``rank``, ``piece``: of each with the next."""
        size, none, span, known = len(symbols), int(NONE), int(self.span), self.by_key.get
        heap = [r * size + at for at, r in enumerate(rank.tolist()) if r != none]
        heapq.heapify(heap)
        symbols, rank, piece = symbols.tolist(), rank.tolist(), piece.tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while heap:
            best, at = divmod(heapq.heappop(heap), size)
            if rank[at] != best:
                continue  # merged or changed meanwhile
            symbols[at] = piece[at]
            gone = after[at]
            rank[gone] = rank[at] = none
            symbols[gone] = None
            after[at] = after[gone]
            if after[at] < size:
                before[after[at]] = at
            for left, right in ((before[at], at), (at, after[at])):
                if left >= 0 and right < size:
                    a, b = symbols[left], symbols[right]
                    piece[left], rank[left] = (known(a * span + b) if a >= 0 and b >= 0 else None) or (0, none)
                    if rank[left] != none:
                        heapq.heappush(heap, rank[left] * size + left)
        return [s for s in symbols if s is not None]

    def ids(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        parts, owners = sizes, None
        if len(sizes) and sizes.max() > LONG_WORD:  # cut long words where neighbours adjoin in no piece
            points = np.where(points == 32, ord(SPACE), points)
            edge = np.zeros(len(points), bool)
            edge[np.cumsum(sizes) - sizes] = True
            far = np.repeat(sizes > LONG_WORD, sizes)
            inner = np.flatnonzero(far[1:] & ~edge[1:]) + 1
            pair = points[inner - 1] << 32 | points[inner]
            found = np.searchsorted(self.adjoin, pair)
            found[found == len(self.adjoin)] = 0
            edge[inner[self.adjoin[found] != pair]] = True
            begin = np.flatnonzero(edge)
            parts = np.diff(np.append(begin, len(points)))
            owners = np.repeat(np.arange(len(words)), sizes)[begin]
        symbols, counts = self.rounds(self.first[points], parts)
        if owners is not None:
            counts = np.bincount(owners, weights=counts, minlength=len(words)).astype(np.int64)
        other = (symbols < 0) | (symbols >= len(self.kind))
        if other.any():  # characters without a piece, as the ids of their bytes
            where = np.flatnonzero(other)
            back = {int(self.first[c]): c for c in {ord(x) for w in words for x in w}}
            coded = [self.bytes[list(chr(back[int(s)]).encode())] for s in symbols[where]]
            wide = np.ones(len(symbols), np.int64)
            wide[where] = [len(c) for c in coded]
            out = np.repeat(symbols, wide)
            out[np.repeat(other, wide)] = np.concatenate(coded)
            counts = np.add.reduceat(wide, np.cumsum(counts) - counts) if len(counts) else counts
            symbols = out
        blob, ends = symbols.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [blob[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [self.cut(" " + (t.replace(SPACE, " ") if SPACE in t else t)) if t else [] for t in texts]
        get = self.memory.all(set(chain.from_iterable(cut)), self.ids)
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of rows of ids; row k holds ``ids[ends[k]:ends[k + 1]]``."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.out):
            raise ValueError("an id that the vocabulary does not have")
        tokens = self.table.take(pa.array(ids))
        _, offsets, data = tokens.buffers()
        stops = np.frombuffer(offsets, np.int64, len(tokens) + 1)[ends].tolist()
        raw = memoryview(data) if data is not None else memoryview(b"")
        out = []
        for k, (a, b) in enumerate(zip(stops, stops[1:])):
            own = ids[ends[k] : ends[k + 1]]
            shown = np.flatnonzero(self.kind[own[:64]] != CONTROL)
            if len(own) > 64 and not len(shown):
                shown = np.flatnonzero(self.kind[own] != CONTROL)
            skip = int(len(shown) > 0 and self.blank[own[shown[0]]])  # the blank put in front
            try:
                out.append(str(raw[a + skip : b], "utf-8"))
            except UnicodeDecodeError:
                out.append(self.damaged(own)[skip:])
        return out

    def damaged(self, ids: np.ndarray) -> str:
        """Ids whose bytes are no UTF-8 everywhere: runs of byte ids a character at a time, a replacement for each byte
        that begins none."""
        out, run = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.kind[i] == BYTE:
                run += self.out[i]
                continue
            while run:
                for n in range(1, 5):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    run = run[1:]
            if i is not None:
                out.append(self.out[i].decode())
        return "".join(out)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(text: Column, tokenizer: str | None = None) -> Column:
    """array<int> of the text's ids."""
    path = tokenizer or tokenizer_path("piece_bpe_32k.model")

    @arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        coder, sizes, parts = pieces(path), [0], []
        lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        with collector_off():
            for at, to in blocks(lengths):
                for coded in coder.encode([t or "" for t in texts.slice(at, to - at).to_pylist()]):
                    sizes.append(len(coded) // 4)
                    parts.append(coded)
        values = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), values)

    return run(text)


def decode(ids: Column, tokenizer: str | None = None) -> Column:
    """The text that ids stand for; null for null."""
    path = tokenizer or tokenizer_path("piece_bpe_32k.model")

    @arrow_udf("string")
    def run(arrays: pa.Array) -> pa.Array:
        coder, out = pieces(path), []
        lengths = pa.compute.fill_null(pa.compute.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)
        for at, to in blocks(lengths):
            part = arrays.slice(at, to - at)
            out += coder.decode(part.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lengths[at:to], dtype=np.int64))))
        texts = pa.array(out, pa.string())
        return pa.compute.if_else(arrays.is_valid(), texts, None) if arrays.null_count else texts

    return run(ids)


def op11_piece_rounds(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", encode(text_of(docs)).alias("ids"))
    coded = coded.select("doc_id", "ids", decode(F.col("ids")).alias("decoded"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
