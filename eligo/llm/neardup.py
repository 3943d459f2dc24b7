"""Near-duplicate groups by one-permutation MinHash with optimal densification.

A document's set holds its distinct word shingles. One hash of each shingle serves as the permutation: its high part
names a bin, each bin keeps its least hash, and an empty bin borrows from the first filled one of its own random
probe sequence (optimal densification). Bins are taken in bands; equal bands put documents in a bucket.

1. Documents with equal sets become one representative, so copies cost one row each.
2. In each bucket every member gets one candidate edge, to the bucket's least id: a star, so pairs grow in
   proportion to rows. Candidates are confirmed on the full sets, and linked documents are grouped.
3. A star can miss a link between two members that both fail against its centre. So in buckets that still hold
   several groups, all pairs of members from different groups are confirmed too. After this no pair that shares a
   bucket is unverified unless its documents are in one group already.

Before sets are read, pairs are dropped that cannot reach the similarity: a set's shingles fall into 1024 classes, and
the parity of each class is kept. Where two sets differ in the parity of c classes, at least c shingles are in one of
them only, which bounds their similarity from above. This loses no link, and it is tested inside the join on the
buckets, so a large group of texts that are almost similar enough does not turn into a table of its pairs.

With ``bands`` of ``rows`` bins a pair of similarity 0.8 shares no bucket with probability (1 - 0.8^6)^48 < 5e-7.

Nodes are sets, whatever the keys of the rows that have them: a set's node is the least number of a row with it. Rows
learn their group from their set, and a group learns its least key from its rows.

Defined results: null and empty texts have an empty set and link with nothing; fewer words than a shingle are one
shingle; repeated rows with one key and text share their group; rows of one key with different texts are judged each by
its own text, so they may be in different groups; rows with a null key are linked like others and are kept only if no
row of their group has a key, one of each such group; a very long text's set is held by one task at a time; extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import table, take_turns, text_of, written
from eligo.llm.graph import stars

#: Mixing constants (odd 64-bit numbers).
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
CACHE_WORDS = 400_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


WORDS = WordHashes()


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; A-Z count as a-z."""
    words = text.encode().lower().split()  # bytes: lowers A-Z only, splits at ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    take = min(width, len(words))
    out = np.full(len(words) - take + 1, take, np.uint64)
    for j in range(take):
        out = (out + h[j : len(h) - take + 1 + j]) * M1
        out ^= out >> np.uint64(29)
    return np.unique(mixed(out))


class Sketcher:
    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        grid = np.arange(self.bins, dtype=np.uint64)[:, None] * np.uint64(4096) + np.arange(1, 257, dtype=np.uint64)
        self.probes = (mixed(grid * M1) % np.uint64(self.bins)).astype(np.int64)
        self.weights = mixed(np.arange(1, rows + 1, dtype=np.uint64) * M1) | np.uint64(1)
        self.salt = mixed(np.arange(1, bands + 1, dtype=np.uint64) * M3)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        """The least hash of each bin, empty bins filled from others. ``hashes`` are sorted and not empty."""
        at = ((hashes >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        filled, low = np.zeros(self.bins, bool), np.zeros(self.bins, np.uint64)
        filled[at[first]] = True
        low[at[first]] = hashes[first]
        empty = np.flatnonzero(~filled)
        for start, stop in ((0, 32), (32, 256)):
            if not len(empty):
                return low
            tries = self.probes[empty, start:stop]
            hit = filled[tries]
            found = hit.argmax(1)
            got = hit[np.arange(len(empty)), found]
            low[empty[got]] = low[tries[got, found[got]]]
            empty = empty[~got]
        # very few bins are filled: the next filled one, in turn from a probed place
        places = at[first]
        low[empty] = low[places[np.searchsorted(places, self.probes[empty, 0]) % len(places)]]
        return low

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """One bucket key per band."""
        low = self.minima(hashes).reshape(self.bands, self.rows)
        return mixed((mixed(low) * self.weights).sum(axis=1, dtype=np.uint64) + self.salt).view(np.int64)


#: Keys up to which those of the texts to compare are broadcast (16 bytes each); more are joined.
BROADCAST_IDS = 2_000_000
#: Tasks to which the rows of a large group, and the pairs of a large star's centre, are dealt.
PARTS = 16
#: Pairs from which a star's centre is dealt; a larger number where there are very many pairs.
MANY_PAIRS = 10_000
PARITIES = 16  # longs of 64 classes


def parities(hashes: np.ndarray) -> np.ndarray:
    """Parities of how many hashes each class has."""
    odd = np.bincount((hashes & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def may_link(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """False only for sets whose sizes or parities rule out ``percent`` similarity."""
    apart = sum((F.bit_count(pa_[k].bitwiseXOR(pb[k])) for k in range(PARITIES)), F.lit(0))
    return (100 + percent) * F.greatest(apart.cast("long"), F.abs(na - nb)) <= (100 - percent) * (na + nb)


def sketches(docs: DataFrame, width: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """id, h (hash of the text), n (set size), d0 and d1 (digest of the set), p (parities), keys (bucket of each band;
    none for an empty set)."""

    def run(batches):
        take_turns(WORDS)
        sketcher = Sketcher(bands, rows)
        for batch in batches:
            n, d0, d1, odd, keys, sizes = [], [], [], [], [], [0]
            for at in range(0, batch.num_rows, 256):
                for t in batch.column(2).slice(at, 256).to_pylist():
                    hashes = shingles(t, width)
                    high, low = digest(hashes)
                    n.append(len(hashes))
                    d0.append(high)
                    d1.append(low)
                    odd.append(parities(hashes))
                    if len(hashes):
                        keys.append(sketcher.keys(hashes))
                    sizes.append(bands * len(keys))
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int64()))
            odd = np.concatenate(odd) if odd else np.empty(0, np.int64)
            even = pa.ListArray.from_arrays(pa.array(range(0, len(odd) + 1, PARITIES), pa.int32()), pa.array(odd, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(d0, pa.int64()), pa.array(d1, pa.int64()), even, lists], names=["id", "h", "n", "d0", "d1", "p", "keys"])

    body = text_of(docs, text)
    return docs.select(docs[key].cast("long").alias("id"), F.xxhash64(body).alias("h"), body.alias("text")).mapInArrow(run, "id long, h long, n long, d0 long, d1 long, p array<long>, keys array<long>")


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """A set's digest as two signed 64-bit numbers."""
    both = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return (both >> 64) - (1 << 63), (both & ((1 << 64) - 1)) - (1 << 63)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """d0, d1, shingles of rows of text."""

    def run(batches):
        take_turns(WORDS)
        for batch in batches:
            sets = [shingles(t, width) for t in batch.column(0).to_pylist()]
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(flat, pa.int64()))
            high, low = zip(*map(digest, sets)) if sets else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(high, pa.int64()), pa.array(low, pa.int64()), lists], names=["d0", "d1", "shingles"])

    return docs.select("text").mapInArrow(run, "d0 long, d1 long, shingles array<long>")


def spread(right: DataFrame, parts: int = PARTS) -> DataFrame:
    """``right`` once for each part, to meet left rows that are dealt to ``parts``."""
    return right.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def dealt(column: str, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def with_centres(pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(``pairs`` with part, the centres that have many of them): 0, or from 1 on for pairs of a centre with many.

    There are at most a million such centres, so they may be broadcast."""
    least = max(MANY_PAIRS, pairs.count() // 1_000_000)
    many = written(pairs.groupBy("a").count().filter(F.col("count") >= least).select("a", F.lit(True).alias("many")), "centres")
    if many.isEmpty():
        return pairs.withColumn("part", F.lit(0)), None
    return pairs.join(F.broadcast(many), "a", "left").withColumn("part", F.when(F.col("many"), 1 + dealt("b")).otherwise(0)).drop("many"), many


def met(pairs: DataFrame, many: DataFrame | None, facts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``pairs`` (a, b, part, ...) with facts (id, ...) of both sides; ``columns``: the names that they get, before an a
    or b. A centre with many pairs is met in several tasks."""
    one, two = (facts.select(F.col("id").alias(x), *(F.col(c).alias(f"{to}{x}") for c, to in columns.items())) for x in "ab")
    parted = one.withColumn("part", F.lit(0))
    if many is not None:
        again = spread(one.join(F.broadcast(many.select("a")), "a", "left_semi")).withColumn("part", 1 + F.col("part"))
        parted = parted.unionByName(again)
    return pairs.join(parted, ["a", "part"]).join(two, "b")


def confirmed(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``pairs`` (distinct a, b, ...) whose full sets have at least ``percent`` similarity, as a table.
    ``texts``: id, text; ``nodes``: id, key (the id of a text with the set), d0, d1, n, p.

    A pair that sizes or parities rule out is dropped before any set is read; so the sets of a pair are of like size,
    and carrying one of them with each pair moves no more than the pairs' own texts are worth."""
    parted, many = with_centres(pairs)
    sized = met(parted, many, nodes, {"n": "n", "p": "p"})
    sized = written(sized.filter(may_link(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent)).select(*pairs.columns), "pairs")
    wanted = sized.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = written(nodes.join(wanted, "id", "left_semi").select("id", F.coalesce("key", F.lit(0)).alias("key"), F.col("key").isNull().alias("none"), "d0", "d1"), "wanted")
    keys = wanted.select("key", "none").distinct()
    if keys.count() <= BROADCAST_IDS:
        keys = F.broadcast(keys)  # the other texts need not move to be left out
    texts = texts.select(F.coalesce("id", F.lit(0)).alias("key"), F.col("id").isNull().alias("none"), "text").join(keys, ["key", "none"], "left_semi")
    sets = shingle_sets(texts, width).join(wanted.select("id", "d0", "d1"), ["d0", "d1"]).dropDuplicates(["id"])
    sets = written(sets.select("id", "shingles"), "sets")
    parted, many = with_centres(sized)
    both = met(parted, many, sets, {"shingles": "s"})
    both = both.select(*pairs.columns, F.size(F.array_intersect("sa", "sb")).alias("same"), (F.size("sa") + F.size("sb")).alias("total"))
    return written(both.filter(100 * F.col("same") >= percent * (F.col("total") - F.col("same"))).select(*pairs.columns), "links")


def across_groups(shared: DataFrame, groups: DataFrame, sizes: DataFrame, percent: int, tile: int) -> DataFrame:
    """Distinct (a, b, ca, cb): pairs that share a bucket, are in different groups ca < cb and may be similar enough.

    ``shared``: key, id, hub, ``groups``: id, component. Pairs with a bucket's hub have been tried. A bucket's members
    are dealt to tiles of about ``tile`` members, and each pair of tiles meets in a task of its own (by a merge join: the dealt rows are many more than the table's size says)."""
    named = written(shared.join(groups, "id", "left").select("key", "id", "hub", F.coalesce("component", "id").alias("component")), "named")
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members")).filter("lo < hi and members > 2")
    several = written(several.select("key", F.ceil(F.col("members") / tile).cast("int").alias("tiles")), "several")
    left = written(named.filter("id <> hub").join(several, "key").join(sizes, "id").select("key", "tiles", "id", "component", "n", "p"), "left")
    mine, any_ = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    x, y = (left.select("key", "tiles", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "component", "n", "p")), mine.alias(f"t{s}"), any_.alias(f"t{o}")) for s, o in ("xy", "yx"))
    fits = (F.col("component_x") < F.col("component_y")) & may_link(F.col("n_x"), F.col("p_x"), F.col("n_y"), F.col("p_y"), percent)
    pairs = x.hint("merge").join(y, (x["key"] == y["key"]) & (x["tx"] == y["tx"]) & (x["ty"] == y["ty"]) & fits)
    return pairs.select(F.col("id_x").alias("a"), F.col("id_y").alias("b"), F.col("component_x").alias("ca"), F.col("component_y").alias("cb")).distinct()


def grouped_rows(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 48, rows: int = 6, key: str = "doc_id", text: str = "text", tile: int = 2_000) -> DataFrame:
    """id (the key), h (xxhash64 of the text, null as empty), n (set size), least (the group's least key), first (whether
    the row is its group's first, by key, null last) for each row of ``docs``; rows with an empty set are groups of their
    own."""
    sk = sketches(docs, width, bands, rows, key, text).withColumn("row", F.monotonically_increasing_id())
    sk = written(sk, "sketches")
    some = sk.filter("n > 0")
    copies = some.groupBy("d0", "d1").agg(F.min("row").alias("node"), F.count("*").alias("rows"))
    copies = written(copies.filter("rows > 1").select("d0", "d1", "node"), "copies")
    # of the rows that share a set all but one leave their bucket keys behind
    found = some.withColumn("part", dealt("row")).join(spread(copies), ["d0", "d1", "part"], "left")
    own = F.coalesce(F.col("node") == F.col("row"), F.lit(True))
    found = written(found.select("row", "id", "h", "n", "d0", "d1", F.coalesce("node", "row").alias("node"), F.when(own, F.col("p")).alias("p"), F.when(own, F.col("keys")).alias("keys")), "rows")
    nodes = found.filter("row = node").select(F.col("row").alias("id"), F.col("id").alias("key"), "d0", "d1", "n", "p")
    banded = found.filter("row = node").select(F.col("row").alias("id"), F.explode("keys").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last")
    hubs = written(hubs.select("key", "hub"), "hubs")
    shared = written(banded.join(hubs, "key"), "shared")

    texts = docs.select(docs[key].cast("long").alias("id"), text_of(docs, text).alias("text"))
    candidates = shared.filter("hub < id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    groups = stars(confirmed(written(candidates, "candidates"), texts, nodes, width, percent)).select(F.col("b").alias("id"), F.col("a").alias("component"))

    # members of buckets that still hold several groups: every pair across groups that no star has tried
    across = written(across_groups(shared, groups, nodes.select("id", "n", "p"), percent, tile), "across")
    more = confirmed(across, texts, nodes, width, percent)
    merged = stars(written(more.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "merged"))
    merged = merged.select(F.col("b").alias("component"), F.col("a").alias("end"))

    # from nodes to rows: a node may be that of very many rows, and so may a group
    part = dealt("row")
    out = found.select("row", "id", "h", "n", "node", part.alias("part"))
    out = out.join(spread(groups.withColumnRenamed("id", "node")), ["node", "part"], "left").withColumn("component", F.coalesce("component", "node"))
    out = out.join(spread(merged), ["component", "part"], "left").select("row", "id", "h", "n", "part", F.coalesce("end", "component").alias("component"))
    out = written(out, "grouped")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    leasts = out.groupBy("component").agg(F.min(order).alias("top"), F.count("*").alias("rows")).filter("rows > 1").select("component", "top")
    out = out.join(spread(written(leasts, "leasts")), ["component", "part"], "left")
    least, first = F.when(F.col("top").isNull(), F.col("id")).otherwise(F.col("top.id")), F.coalesce(F.col("top.row") == F.col("row"), F.lit(True))
    out = out.select("id", "h", "n", least.alias("least"), first.alias("first"))
    return out.unionByName(sk.filter("n = 0").select("id", "h", "n", F.col("id").alias("least"), F.lit(True).alias("first")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 48, rows: int = 6, key: str = "doc_id", text: str = "text", tile: int = 2_000) -> DataFrame:
    """key, n_shingles, component_id (least key of the group), kept (key = component_id) for each row of ``docs``."""
    found = grouped_rows(docs, width, percent, bands, rows, key, text, tile)
    kept = F.when(F.col("id").isNotNull(), F.col("id") == F.col("least")).otherwise(F.col("least").isNull() & F.col("first"))
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), kept.alias("kept"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """``docs`` with one row of each group, its first; of rows that repeat a key and a text one counts.

    Rows are told apart by key and text, so a row never leaves because another row of its key is a copy."""
    found = written(grouped_rows(docs, key=key, text=text, **more), "found")
    names = {"key_": F.coalesce(docs[key].cast("long"), F.lit(0)), "none_": docs[key].isNull(), "h_": F.xxhash64(text_of(docs, text))}
    rows = found.groupBy(F.coalesce("id", F.lit(0)).alias("key_"), F.col("id").isNull().alias("none_"), F.col("h").alias("h_"))
    rows = rows.agg(F.max("first").alias("stays"), F.count("*").alias("rows"))
    gone, twice = written(rows.filter("not stays").select(*names), "gone"), written(rows.filter("stays and rows > 1").select(*names), "twice")
    left = docs.withColumns(names).join(gone, list(names), "left_anti")
    if twice.isEmpty():
        return left.select(*docs.columns)
    once = left.join(twice, list(names), "left_semi").dropDuplicates(list(names))
    return left.join(twice, list(names), "left_anti").unionByName(once).select(*docs.columns)


def op5_near_duplicates(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)
