"""Comparison of two rule sets: similar pairs, greedy one-to-one matching, ordered difference, text distance.

Sets are compared within a key (a trial and cohort), so pairs are those of one key; only pairs above the threshold are
kept, since no other pair can match."""

from __future__ import annotations

import difflib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from eligo.operators.catalogue import small
from eligo.operators.graph import components
from eligo.sources.shared import checkpointed


def unit(vector: Column) -> Column:
    """The vector at length 1, in doubles."""
    v = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(v, lambda x: x / norm)


#: Products of one block of a tile that a task holds at once.
BLOCK_PRODUCTS = 2_000_000


def _vectors(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (places, matrix) of the vectors without nulls; no pair of others has a similarity."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    values, starts = lists.flatten(), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    nulls = np.concatenate([[0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))])
    good = (nulls[starts[1:]] == nulls[starts[:-1]]) & ~lists.is_null().to_numpy(zero_copy_only=False)
    flat = values.fill_null(0.0).to_numpy(zero_copy_only=False)
    out = {}
    for d in np.unique(lengths[good]).tolist():
        at = np.flatnonzero(good & (lengths == d))
        out[d] = at, flat[starts[at][:, None] + np.arange(d)]
    return out


def _products(left: pa.ChunkedArray, right: pa.ChunkedArray):
    """(places on the left, their vectors, places on the right, their vectors, products), block by block."""
    ours, theirs = _vectors(left), _vectors(right)
    for d in ours.keys() & theirs.keys():
        (at, us), (to, vs) = ours[d], theirs[d]
        step = max(1, BLOCK_PRODUCTS // max(1, len(vs)))
        for k in range(0, len(us), step):
            block = us[k : k + step]
            yield at[k : k + step], block, to, vs, block @ vs.T


def _near(left: pa.ChunkedArray, right: pa.ChunkedArray, least: float):
    """(places on the left, on the right, products) of pairs of vectors that may be above ``least``, block by block.

    A matrix product finds them with some room for its order of summing, which depends on the machine; their products are
    then summed once more in the order of the elements, so that they are the same everywhere."""
    for at, us, to, vs, products in _products(left, right):
        x, y = np.nonzero(~(products < least - 1e-6))  # what is no number is kept, as the comparison has it
        sums = np.zeros(len(x))
        for e in range(us.shape[1]):
            sums += us[x, e] * vs[y, e]
        yield at[x], to[y], sums


def in_tiles(old: DataFrame, new: DataFrame, key: str, tile: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with unit vectors, dealt to tiles: key, x, y, i, u and key, x, y, j, v."""
    a, b = ((f.filter(F.length("text") > 0) if "text" in f.columns else f).filter(F.col(key).isNotNull()) for f in (old, new))
    count = lambda f: f.groupBy(key).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiles = small(count(a).withColumnRenamed("tiles", "across").join(count(b).withColumnRenamed("tiles", "down"), key))
    deal = lambda n: F.pmod(F.xxhash64("pos"), F.col(n)).cast("int")
    all_ = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = a.select(key, "pos", unit(F.col("vector")).alias("u")).join(tiles, key).select(key, deal("across").alias("x"), all_("down").alias("y"), F.col("pos").alias("i"), "u")
    b = b.select(key, "pos", unit(F.col("vector")).alias("v")).join(tiles, key).select(F.col(key).alias(key), all_("across").alias("x"), deal("down").alias("y"), F.col("pos").alias("j"), "v")
    return a, b


def similar_pairs(old: DataFrame, new: DataFrame, key: str, least: float = 0.9, digits: int = 9, tile: int = 2_000) -> DataFrame:
    """key, i, j, similarity of pairs above ``least``. Both sides: key, pos, vector, and text if there is one: rows
    with an empty or null text are left out, as nothing can match them.

    Vectors are normalised once per row; the similarity is rounded so that it orders alike everywhere. Within a key all
    pairs are compared, since no bound on the cosine spares any; the rows of a key are dealt to tiles of about ``tile``
    rows a side, and each pair of tiles meets in a task of its own, as a product of two matrices, so a large key spreads
    over many."""
    a, b = in_tiles(old, new, key, tile)
    types = StructType([a.schema[key], a.schema["i"], b.schema["j"], StructField("dot", DoubleType())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for x, y, sums in _near(left.column("u"), right.column("v"), least - 10.0**-digits):
            if len(x):
                parts.append(pa.table({key: left.column(key).take(x), "i": left.column("i").take(x), "j": right.column("j").take(y), "dot": pa.array(sums)}))
        return pa.concat_tables(parts) if parts else pa.table({key: left.column(key)[:0], "i": left.column("i")[:0], "j": right.column("j")[:0], "dot": pa.array([], pa.float64())})

    pairs = a.groupBy(key, "x", "y").cogroup(b.groupBy(key, "x", "y")).applyInArrow(meet, types)
    return pairs.select(key, "i", "j", F.round("dot", digits).alias("similarity")).filter(F.col("similarity") > least)


#: Pairs of a group that one task matches in one pass; larger groups are made smaller first.
MANY_PAIRS = 2_000_000
#: Rows to a tile of a long list.
TILE_ROWS = 100_000


def in_one_pass(pairs: DataFrame, group: str) -> DataFrame:
    """The rows of ``pairs`` that a greedy pass takes in each group: the best first (ties: least i, then j), then the best
    of what is left. A task reads its groups one after the other, in order, and holds the rows that are taken."""
    columns = pairs.columns

    def run(frames):
        now, left, right = None, set(), set()
        for f in frames:
            keep = []
            for g, i, j in zip(f[group], f["i"], f["j"]):
                if g != now:
                    now, left, right = g, set(), set()
                keep.append(i not in left and j not in right)
                if keep[-1]:
                    left.add(i)
                    right.add(j)
            yield f[keep]

    ordered = pairs.repartition(group).sortWithinPartitions(group, F.desc("similarity"), "i", "j")
    return ordered.mapInPandas(run, pairs.schema).select(*columns)


def best_of_both(pairs: DataFrame, key: str) -> DataFrame:
    """The pairs that are the best of both their rows; they are in the greedy result whatever else is."""
    rank = [F.row_number().over(Window.partitionBy(key, side).orderBy(F.desc("similarity"), "i", "j")) for side in ("i", "j")]
    return pairs.select("*", rank[0].alias("ri"), rank[1].alias("rj")).filter("ri = 1 and rj = 1").drop("ri", "rj")


def parted(pairs: DataFrame, group: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of groups with at most ``most``, those of larger ones)."""
    large = pairs.groupBy(group).count().filter(F.col("count") > most).select(group)
    large = small(checkpointed(large))
    return pairs.join(large, group, "left_anti").select(*pairs.columns), pairs.join(large, group, "left_semi").select(*pairs.columns)


def greedy_matches(pairs: DataFrame, key: str, most: int = MANY_PAIRS) -> DataFrame:
    """One-to-one matches: the best pair first (ties: least i, then j), then the best of what is left.

    Pairs of different keys, and of different components of the graph of pairs, do not touch. So a key with at most
    ``most`` pairs is matched in one pass by one task; of a larger key each component is, if it is small enough; and of
    larger components all pairs that are the best of both their rows are taken at once, with what they block, until what
    is left falls apart into small ones. However long a chain of blocked choices is, a small group is one pass."""
    columns, taken, left = pairs.columns, [], checkpointed(pairs)
    own, left = parted(left, key, most)
    taken.append(in_one_pass(own, key))
    while not (left := checkpointed(left)).isEmpty():
        node = lambda side: F.struct(F.col(key), F.lit(side == "j").alias("right"), F.col(side).cast("string").alias("at"))
        found = components(left.select(node("i").alias("a"), node("j").alias("b"))).select(F.col("u").alias("node_"), F.sha2(F.to_json("p"), 256).alias("group_"))
        named = checkpointed(left.withColumn("node_", node("i")).join(found, "node_").drop("node_"))
        own, left = parted(named, "group_", most)
        taken.append(in_one_pass(own, "group_").select(*columns))
        left = left.select(*columns)
        for _ in range(4):
            best = checkpointed(best_of_both(left, key))
            taken.append(best.select(*columns))
            left = checkpointed(left.join(best.select(key, "i"), [key, "i"], "left_anti").join(best.select(key, "j"), [key, "j"], "left_anti").select(*columns))
    out = taken[0]
    for t in taken[1:]:
        out = out.unionAll(t)
    return out.select(*columns)


#: Bins of similarity to a unit, by which pairs are counted.
BINS = 1_000


def pair_counts(old: DataFrame, new: DataFrame, key: str, least: float, tile: int = 2_000) -> dict[int, int]:
    """bin -> pairs above ``least`` with about that similarity (bin b: from b / BINS - 1 on), over all keys."""
    a, b = in_tiles(old, new, key, tile)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        n = np.zeros(2 * BINS + 1, np.int64)
        for *_, products in _products(left.column("u"), right.column("v")):
            s = np.nan_to_num(products[~(products < least - 1e-6)], nan=1.0)
            n += np.bincount(((s + 1) * BINS).astype(np.int64).clip(0, 2 * BINS), minlength=2 * BINS + 1)
        at = np.flatnonzero(n)
        return pa.table({"bin": pa.array(at, pa.int64()), "n": pa.array(n[at])})

    found = a.groupBy(key, "x", "y").cogroup(b.groupBy(key, "x", "y")).applyInArrow(count, "bin long, n long")
    return {r["bin"]: r["n"] for r in found.groupBy("bin").agg(F.sum("n").alias("n")).collect()}


def level_of(counts: dict[int, int], least: float, most: int) -> float:
    """The least similarity above which there are at most ``most`` pairs, ``least`` if all are; one bin at least."""
    level, above = None, 0
    for b in sorted(counts, reverse=True):
        above += counts[b]
        if above > most and level is not None:
            return max(level, least)
        level = b / BINS - 1
    return least


def matched(old: DataFrame, new: DataFrame, key: str, least: float = 0.9, digits: int = 9, tile: int = 2_000, most: int = MANY_PAIRS, a_row: int = 8) -> DataFrame:
    """The greedy matches (as :func:`greedy_matches` has them) of the :func:`similar_pairs` of two sides, without all pairs.

    A greedy pass takes the pairs in descending similarity, so those above a level come first, and only rows that they
    leave unmatched have further ones. Each round counts the pairs of the rows that are left, takes a level above which
    there are at most ``most`` or ``a_row`` a row of them, matches these, and removes the matched rows. Pairs of one bin of
    similarity (a thousandth) are never parted."""
    products = old.groupBy(key).count().join(new.groupBy(key).agg(F.count("*").alias("others")), key).agg(F.sum(F.col("count") * F.col("others"))).first()[0] or 0
    if products <= most:
        return greedy_matches(similar_pairs(old, new, key, least, digits, tile), key, most)
    taken = []
    while True:
        old, new = checkpointed(old), checkpointed(new)
        level = level_of(pair_counts(old, new, key, least, tile), least, max(most, a_row * old.count()))
        found = checkpointed(greedy_matches(similar_pairs(old, new, key, level, digits, tile), key, max(most, MANY_PAIRS)))
        taken.append(found)
        if level <= least:
            return reduce(DataFrame.unionAll, taken)
        old = old.join(found.select(key, F.col("i").alias("pos")), [key, "pos"], "left_anti")
        new = new.join(found.select(key, F.col("j").alias("pos")), [key, "pos"], "left_anti")


def running(rows: DataFrame, key: str, order: list[str], value: Column, column: str, tile: int = TILE_ROWS) -> DataFrame:
    """``rows`` with ``column``: the sum of ``value`` over the rows of the key that come before, in ``order``.

    In two levels, so that a long list is no task of its own: rows are parted by ranges into tiles, summed within their
    tile, and moved on by the sums of the key's earlier tiles, of which there is one row each."""
    n = max(1, -(-rows.count() // tile))
    tiled = rows.withColumn("value_", value.cast("long")).repartitionByRange(n, key, *order).withColumn("tile_", F.spark_partition_id())
    tiled = checkpointed(tiled)
    here = F.sum("value_").over(Window.partitionBy(key, "tile_").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sums = tiled.groupBy(key, "tile_").agg(F.sum("value_").alias("sum_"))
    start = F.sum("sum_").over(Window.partitionBy(key).orderBy("tile_").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(F.col(key).alias("key_"), F.col("tile_").alias("at_"), F.coalesce(start, F.lit(0)).alias("start_"))
    out = tiled.withColumn("here_", F.coalesce(here, F.lit(0)))
    out = out.join(small(starts), out[key].eqNullSafe(F.col("key_")) & (out["tile_"] == F.col("at_")))
    return out.withColumn(column, F.col("start_") + F.col("here_")).drop("value_", "tile_", "here_", "start_", "key_", "at_")


def ordered_diff(old: DataFrame, new: DataFrame, matches: DataFrame, key: str, tile: int = TILE_ROWS) -> DataFrame:
    """key, place, old_pos, old_text, new_pos, new_text, similarity: every row of both sides once.

    A row's slot is the number of matched rows before it on its own side; a match stands in its old row's slot, after
    the removed and the added rows of that slot. Counts and places are running sums over tiles of about ``tile`` rows."""
    o = old.select(key, F.col("pos").alias("i"), F.col("text").alias("old_text")).join(matches.select(key, "i", "j", "similarity"), [key, "i"], "left")
    n = new.select(key, F.col("pos").alias("j"), F.col("text").alias("new_text")).join(matches.select(key, "j", F.lit(True).alias("met")), [key, "j"], "left")
    o = running(o, key, ["i"], F.col("j").isNotNull(), "slot", tile)
    n = running(n, key, ["j"], F.col("met").isNotNull(), "slot", tile)
    both = o.join(n.filter("met").select(key, "j", "new_text"), [key, "j"], "left")
    rows = both.select(key, "slot", F.when(F.col("j").isNull(), 0).otherwise(2).alias("kind"), F.col("i").alias("at"), "i", "old_text", "j", "new_text", "similarity")
    added = n.filter("met is null").select(key, "slot", F.lit(1).alias("kind"), F.col("j").alias("at"), F.lit(None).cast(matches.schema["i"].dataType).alias("i"), F.lit(None).cast("string").alias("old_text"), "j", "new_text", F.lit(None).cast("double").alias("similarity"))
    placed = running(rows.unionByName(added), key, ["slot", "kind", "at"], F.lit(1), "before", tile)
    return placed.select(key, (F.col("before") + 1).cast("int").alias("place"), F.col("i").alias("old_pos"), "old_text", F.col("j").alias("new_pos"), "new_text", "similarity")


def diff_entries(diff: DataFrame, key: str, same: float = 0.999) -> DataFrame:
    """key, place, entry: each row of the ordered difference as text, for reports of any length."""
    head = F.format_string("%d. ", "place")
    share = F.format_string("%.1f%%", 100 * F.coalesce("similarity", F.lit(0.0)))
    entry = (
        F.when(F.col("new_text").isNull(), F.concat(head, F.lit("Removed\n- "), F.col("old_text")))
        .when(F.col("old_text").isNull(), F.concat(head, F.lit("Added\n+ "), F.col("new_text")))
        .when(F.col("similarity") >= same, F.concat(head, F.lit("matched ("), share, F.lit(")\n  "), F.col("new_text")))
        .otherwise(F.concat(head, F.lit("Modified ("), share, F.lit(")\n- "), F.col("old_text"), F.lit("\n+ "), F.col("new_text")))
    )
    return diff.select(key, "place", entry.alias("entry"))


def diff_report(diff: DataFrame, key: str, same: float = 0.999) -> DataFrame:
    """key, report: the ordered difference of a key as one text, which one row must hold; :func:`diff_entries` has no
    such bound."""
    rows = diff_entries(diff, key, same)
    return rows.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "entry"))), lambda r: r["entry"]), "\n").alias("report"))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    masks: dict[str, int] = {}
    for k, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << k
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: Column, b: Column) -> Column:
    """0 to 100: how much of two texts insertions and deletions leave alone; 100 for two empty texts."""

    @arrow_udf("double")
    def run(xs: pa.Array, ys: pa.Array) -> pa.Array:
        out = [None if x is None or y is None else 100.0 if not x and not y else 200.0 * _common(x, y) / (len(x) + len(y)) for x, y in zip(xs.to_pylist(), ys.to_pylist())]
        return pa.array(out, pa.float64())

    return run(a, b)


def unchanged(a: Column, b: Column, least: float = 95.0) -> Column:
    """Whether a rewritten text still says what it said: an indel ratio of at least ``least``; null texts do not."""
    return F.coalesce(indel_ratio(a, b) >= least, F.lit(False))


def _line_lists(pairs) -> pa.Array:
    """list<string> of the differences of some pairs of texts, each kept as Arrow text as soon as it is made: a list of
    Python texts, one to a character, takes some ten times the memory."""
    chunks, starts, null = [pa.array([], pa.string())], [0], []
    for x, y in pairs:
        lines = pa.array([] if x is None or y is None else list(difflib.unified_diff(x, y)), pa.string())
        null.append(x is None or y is None)
        starts.append(starts[-1] + len(lines))
        chunks.append(lines)
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.concat_arrays(chunks), mask=pa.array(null, pa.bool_()))


def character_diff(a: Column, b: Column) -> Column:
    """array<string>: a unified difference of two texts, a character to a line."""

    @arrow_udf("array<string>")
    def run(xs: pa.Array, ys: pa.Array) -> pa.Array:
        return _line_lists((x.as_py(), y.as_py()) for x, y in zip(xs, ys))

    return run(a, b)
