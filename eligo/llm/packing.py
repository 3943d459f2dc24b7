"""Best-fit packing of documents into sequences, improved by swap-based local search.

A document's tokens (and an end token) are cut into pieces of at most ``max_tokens``; only longer documents are
cut. Full pieces are sequences of their own. The others are dealt by a hash of their row into groups of about
``group_rows`` pieces, also those that share one key, so a task holds a bounded number of (key, length) rows however large the corpus is, and
each group is packed on its own:

1. in the rows' order, each piece goes to the fullest bin that has room (best fit as the pieces arrive);
2. local search over the underfull bins: move a piece, or exchange one for one or two for one, from the emptiest
   bin into a fuller one. Each step raises the sum of squared fills; a bin that becomes empty is dropped. It stops
   when the number of bins is the lower bound ceil(tokens / max_tokens), or when no step is left;
3. if bins are left over the bound, the pieces of the underfull ones are packed anew, longest first, and searched
   again, as long as that saves bins.

``moves`` tells how many steps the search took in a piece's group. Of 60,000 pieces as the tables have them the first
packing is 0.6 % over the bound, the search's 0.05 %. Groups lose little against one global packing: a fraction of a
sequence each.

Defined results: a null or empty text is a piece that holds only the end token; a null key packs like any other;
repeated rows are packed as often as they occur; an empty table gives no rows; extra columns are ignored by
:func:`pieces` and kept by :func:`pack`, whatever their names, but for those of its results. A very long text is coded
whole, in one piece of work.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import blocks, byte_letters, checkpointed, collector_off, table, take_turns, text_of, tokenizer_path

#: Distinct words whose ids a Python worker remembers; past it the memory starts afresh.
CACHE_WORDS = 700_000


#: Words whose pre-tokens can be counted without the tokenizer: printable Latin-1.
PLAIN = re.compile("[!-~\xa1-\xff]+")
#: The public word-level pre-tokenizer pattern (fixed value).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds(dict):
    """Little-endian uint32 ids of white-space separated words, as the tokenizer gives them; a bounded memory.

    The tokenizer drops white space and no merge, normal form or added token reaches across it, so a text's ids are
    its words' ids in turn. Splitting is on ASCII white space alone; rarer kinds stay inside a word for the tokenizer.
    New words of printable Latin-1, whose normal form is their lower case, are cut into pre-tokens here, and only new
    pre-tokens are encoded, many to a text, by the same merges without the normaliser. Each ends with a token that
    carries the end-of-word suffix, which tells them apart again. Other words are encoded whole, one by one.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Tokenizer.from_file(path)
        self.merges.no_truncation()
        self.merges.no_padding()
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.pretokens = regex.compile(PRETOKEN)
        self.letters = {b: c for c, b in byte_letters().items()}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def clear(self) -> None:
        super().clear()
        self.known.clear()

    def one_by_one(self, words: list[bytes]) -> None:
        coded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        self.update((w, np.asarray(e.ids, "<u4").tobytes()) for w, e in zip(words, coded))

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(words)
        single, lone, plain, other, known = [], [], [], [], self.known
        for w in new:
            t = w.decode()
            if PLAIN.fullmatch(t) and not ("<" in t and any(a in t for a in self.added)):
                t = t.lower()
                if t.isalpha():
                    single.append(w)
                    lone.append(t)
                else:
                    plain.append((w, self.pretokens.findall(t)))
            else:
                other.append(w)
        for at in range(0, len(other), 4096):
            self.one_by_one(other[at : at + 4096])
        # letters alone are words themselves: those that are remembered as such are not remembered twice
        letters: dict[str, bytes] = {}
        parts = []
        for p in set(lone).union(*(cut for _, cut in plain)):
            held = self.get(p.encode()) if p.isalpha() else known.get(p)
            if held is None:
                parts.append(p)
            else:
                letters[p] = held
        groups = [parts[at : at + 200] for at in range(0, len(parts), 200)]
        as_letters = lambda p: p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
        for group, e in zip(groups, self.merges.encode_batch_fast([" ".join(map(as_letters, g)) for g in groups], add_special_tokens=False)):
            ids = np.asarray(e.ids, "<u4")
            coded, stops = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            assert len(stops) == len(group)
            letters.update(zip(group, map(coded.__getitem__, map(slice, [0, *stops], stops))))
        self.update(zip(single, map(letters.__getitem__, lone)))
        self.update((w, b"".join([letters[p] for p in cut])) for w, cut in plain)
        known.update((p, letters[p]) for p in parts if not p.isalpha())

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.encode().split() for t in texts]
        self.learn(set().union(*cut))
        return [b"".join(map(self.__getitem__, words)) for words in cut]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32 (of little-endian unsigned 32-bit ids)."""
    step = 4 * max_tokens
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches):
        ids, end = word_ids(tokenizer), np.asarray([end_id], "<u4").tobytes()
        take_turns(ids)
        for batch in batches:
            keys, rows = batch.column(0), []
            # a few MB of text at a time
            for at, to in blocks(pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)):
                with collector_off():
                    found = ids.encode(batch.column(1).slice(at, to - at).to_pylist())
                for i, coded in enumerate(found, at):
                    coded += end
                    for k, start in enumerate(range(0, len(coded), step)):
                        part = coded[start : start + step]
                        rows.append((i, k, start // 4, len(part) // 4, zlib.crc32(part)))
            row, k, start, length, crc = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(row, pa.int64())), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(docs[key], text_of(docs, text).alias("text")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, size: int, order: np.ndarray | None = None) -> list[list[int]]:
    """Bins of row numbers: each row in ``order``, by default longest first, goes to the fullest bin that has room."""
    bins: list[list[int]] = []
    open_at: list[list[int]] = [[] for _ in range(size + 1)]  # bins by room left
    mask = 0  # bit r: some bin has room r
    for i in (np.argsort(-lengths, kind="stable") if order is None else order).tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_at[room].pop()
            if not open_at[room]:
                mask &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = size, len(bins)
            bins.append([i])
        left = room - n
        if left:
            open_at[left].append(b)
            mask |= 1 << left
    return bins


class Rooms:
    """Bins by what they hold: for each piece length (0: any bin) the largest room of an active bin with such a piece."""

    def __init__(self, size: int):
        self.most = np.zeros(size + 1, np.int64)
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(size + 1)]
        self.version: dict[int, int] = {}  # of active bins; entries of other versions are dead

    def add(self, k: int, room: int, lengths: set[int], version: int) -> None:
        self.version[k] = version
        for y in (0, *lengths):
            heapq.heappush(self.heaps[y], (-room, k, version))
            if room > self.most[y]:
                self.most[y] = room

    def remove(self, k: int, lengths: set[int]) -> None:
        del self.version[k]
        for y in (0, *lengths):
            heap = self.heaps[y]
            while heap and self.version.get(heap[0][1]) != heap[0][2]:
                heapq.heappop(heap)
            self.most[y] = -heap[0][0] if heap else 0

    def best(self, totals: np.ndarray) -> tuple[int, int, int] | None:
        """(gain, total, length taken back) of the exchange that moves most, for sorted ``totals`` that can be given."""
        ys = np.flatnonzero(self.most)
        at = np.searchsorted(totals, ys + self.most[ys], "right") - 1
        gain = np.where(at >= 0, totals[at] - ys, 0)
        if not len(gain) or gain.max() <= 0:
            return None
        c = int(gain.argmax())
        return int(gain[c]), int(totals[at[c]]), int(ys[c])


def improve(bins: list[list[int]], lengths: np.ndarray, size: int) -> tuple[list[list[int]], int]:
    """(bins, steps): local search on the underfull bins by moves, one-for-one and two-for-one exchanges that raise the
    sum of squared fills, until no bin more than needed is left or no exchange helps.

    A sweep takes the bins emptiest first. A bin gives to bins that are at least as full until it is empty or no
    exchange is left, then rests; the last sweep is one without any exchange."""
    need = -(-int(lengths.sum()) // size)
    n = lengths.tolist()
    fill = [sum(n[i] for i in b) for b in bins]
    alive = sum(1 for b in bins if b)
    version = 0  # the steps taken
    moved = True
    while alive > need and moved:
        moved, rooms, queue = False, Rooms(size), []
        held = {k: {n[i] for i in b} for k, b in enumerate(bins) if b and fill[k] < size}
        for k in held:
            rooms.add(k, size - fill[k], held[k], version)
            queue.append((fill[k], k))
        heapq.heapify(queue)
        while queue and alive > need:
            was, a = heapq.heappop(queue)
            if a not in rooms.version or was != fill[a]:
                continue
            rooms.remove(a, held[a])
            while bins[a] and (found := rooms.best(totals_of(bins[a], n))):
                gain, total, taken = found
                b = rooms.heaps[taken][0][1]
                rooms.remove(b, held[b])
                exchange(bins, n, a, b, total, taken)
                fill[b] += gain
                fill[a] -= gain
                moved, version = True, version + 1
                if fill[b] < size:
                    held[b] = {n[i] for i in bins[b]}
                    rooms.add(b, size - fill[b], held[b], version)
                    heapq.heappush(queue, (fill[b], b))
            alive -= not bins[a]
    return [b for b in bins if b], version


def searched(lengths: np.ndarray, size: int) -> tuple[list[list[int]], int]:
    """(bins, steps) of the whole procedure; ``lengths`` in the order in which they arrive."""
    need = -(-int(lengths.sum()) // size)
    bins, steps = improve(best_fit(lengths, size, np.arange(len(lengths))), lengths, size)
    while len(bins) > need:
        full = [b for b in bins if int(lengths[b].sum()) == size]
        rest = np.asarray(sorted(i for b in bins if int(lengths[b].sum()) < size for i in b))
        again = [rest[b].tolist() for b in best_fit(lengths[rest], size)]
        if len(full) + len(again) >= len(bins):
            break
        bins, more = improve(full + again, lengths, size)
        steps += more
    return bins, steps


def totals_of(members: list[int], n: list[int]) -> np.ndarray:
    """The sums of one and of two of a bin's pieces, in order, each once."""
    kinds, count = np.unique([n[i] for i in members], return_counts=True)
    twos = kinds[:, None] + kinds[None, :]
    return np.unique(np.concatenate([kinds, twos[np.triu_indices(len(kinds), 1)], 2 * kinds[count > 1]]))


def exchange(bins: list[list[int]], n: list[int], a: int, b: int, total: int, taken: int) -> None:
    """One or two pieces of ``a`` that sum to ``total`` go to ``b``, for a piece of length ``taken`` (0: none) of it."""
    by_len: dict[int, list[int]] = {}
    for i in bins[a]:
        by_len.setdefault(n[i], []).append(i)
    if total in by_len:
        given = by_len[total][:1]
    else:
        given = next([own[0], other[-1]] for x, own in by_len.items() if (other := by_len.get(total - x)) and (other is not own or len(own) > 1))
    back = [next(i for i in bins[b] if n[i] == taken)] if taken else []
    for i in given:
        bins[a].remove(i)
    for i in back:
        bins[b].remove(i)
    bins[a] += back
    bins[b] += given


RESULTS = ("sequence_id", "offset", "moves")


def pack(rows: DataFrame, max_tokens: int = 4096, group_rows: int = 60_000, keys: tuple[str, ...] = ("doc_id", "piece"), length: str = "length") -> DataFrame:
    """``rows`` with sequence_id, offset and moves. ``rows`` are read more than once: give a checkpointed table."""
    groups = max(1, -(-rows.count() // group_rows))
    out = [f for f in rows.schema if f.name not in RESULTS]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", sequence_id long, offset long, moves long"
    names = [f.name for f in out]
    own = next(n for n in ("pack_group" + "_" * k for k in range(len(names) + 1)) if n not in names)

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop(columns=own).sort_values(list(keys), kind="stable").reset_index(drop=True)
        n = frame[length].to_numpy()
        bins, steps = searched(n, max_tokens)
        order, sequence, offset = [], [], []
        for b, members in enumerate(bins):
            at = 0
            for i in members:
                order.append(i)
                sequence.append((int(key[0]) << 32) + b)
                offset.append(at)
                at += int(n[i])
        return frame.iloc[order].assign(sequence_id=np.asarray(sequence, "int64"), offset=np.asarray(offset, "int64"), moves=steps)

    # the row number of the checkpointed rows parts those that are equal in every column
    group = F.pmod(F.xxhash64(*names, F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    packed = rows.select(*names, group.alias(own)).filter(F.col(length) < max_tokens).groupBy(own).applyInPandas(one, schema)
    # a full piece is a sequence of its own; ids below zero cannot meet those of the groups
    full = rows.select(*names).filter(F.col(length) >= max_tokens)
    full = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("moves"))
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, moves for every piece of every document."""
    cut = pieces(docs, tokenizer or tokenizer_path("word_bpe_49k.json"), max_tokens, end_id)
    return pack(checkpointed(cut), max_tokens)


def op7_best_fit_packing(spark, sf_dir) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
