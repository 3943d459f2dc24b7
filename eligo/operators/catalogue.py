"""The rule catalogue: a wide sheet of (category, warn flag) column pairs as a long table, and lookups against it.

A catalogue has a few hundred rules. Lookups broadcast it, or put its names into the plan, only after its size was
checked; a larger one is joined."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.functions.text import strip, truthy
from eligo.sources.shared import checkpointed

#: Rows up to which a lookup table may be broadcast.
BROADCAST_ROWS = 100_000
#: Names up to which a set may be a constant of the plan.
LITERAL_NAMES = 5_000
#: Rules, their bytes, and categories up to which a catalogue's lists may be one constant of the plan.
OFFERED_RULES, OFFERED_BYTES, OFFERED_CATEGORIES = 100_000, 8_000_000, 1_000


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` with a broadcast hint if it has at most ``rows`` rows (counting stops beyond)."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def long_catalogue(wide: DataFrame, flag_name: str = "WARN_IF") -> DataFrame:
    """category, category_pos, row_pos, rule, warn of a wide catalogue with a ``row_pos`` column.

    Columns are taken by position, since readers rename repeated headers; every second one must be a flag column."""
    names = [c for c in wide.columns if c != "row_pos"]
    pairs = list(zip(names[::2], names[1::2]))
    if len(names) % 2 or not all(flag.strip().upper().startswith(flag_name) for _, flag in pairs):
        raise ValueError(f"columns are not pairs of a category and {flag_name}: {names}")
    cells = F.array(*(F.struct(F.lit(c.strip()).alias("category"), F.lit(k).alias("category_pos"), F.col(f"`{c}`").cast("string").alias("rule"), F.col(f"`{w}`").cast("string").alias("flag")) for k, (c, w) in enumerate(pairs)))
    rows = wide.select("row_pos", F.inline(cells))
    return rows.select("category", "category_pos", "row_pos", strip(F.col("rule")).alias("rule"), truthy(F.col("flag")).alias("warn")).filter("rule is not null and rule <> ''")


def rules(long: DataFrame) -> DataFrame:
    return long.select("rule").distinct()


def warn_flags(long: DataFrame) -> DataFrame:
    """rule, warn: the flag of a rule's first cell, column by column."""
    return long.groupBy("rule").agg(F.min_by("warn", F.struct("category_pos", "row_pos")).alias("warn"))


def of_categories(long: DataFrame, wanted: list[str]) -> DataFrame:
    """The catalogue of some categories; an unknown one is an error."""
    known = {r[0] for r in long.filter(F.col("category").isin(wanted)).select("category").distinct().collect()}
    if missing := sorted(set(wanted) - known):
        raise ValueError(f"unknown categories: {missing}")
    return long.filter(F.col("category").isin(wanted))


def unknown_rules(used: DataFrame, long: DataFrame, rule: str = "rule") -> DataFrame:
    """Rows of ``used`` whose rule the catalogue lacks."""
    return used.join(small(rules(long).withColumnRenamed("rule", rule)), rule, "left_anti")


def with_names(rows: DataFrame, known: DataFrame, names: Column, column: str, among: bool, most: int = LITERAL_NAMES) -> DataFrame:
    """``rows`` with ``column``: the sorted distinct ``names`` (an array column) that are among the rules of ``known``,
    or that are not. Each row is looked up by itself, whatever its key.

    Up to ``most`` rules are a constant that array functions compare with, without a shuffle. More are joined by a row
    number that a checkpoint fixes."""
    known = known.select("rule").filter("rule is not null").distinct()
    first = [r[0] for r in known.limit(most + 1).collect()]
    if len(first) <= most:
        set_ = F.array(*map(F.lit, sorted(first))).cast("array<string>")
        return rows.withColumn(column, F.sort_array((F.array_intersect if among else F.array_except)(names, set_)))
    kept = rows.columns
    numbered = checkpointed(rows.select(F.struct(*(rows[c] for c in kept)).alias("row"), names.alias("names")).withColumn("number", F.monotonically_increasing_id()))
    named = numbered.select("number", F.explode("names").alias("rule")).join(known, "rule", "left_semi" if among else "left_anti")
    lists = named.groupBy("number").agg(F.sort_array(F.collect_set("rule")).alias("found"))
    found = F.when(F.col("names").isNotNull(), F.coalesce("found", F.array().cast("array<string>")))
    out = numbered.join(lists.hint("merge"), "number", "left")  # as many lists as rows: never broadcast
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept if c != column), found.alias(column))


def with_new_rules(rows: DataFrame, long: DataFrame, names: Column) -> DataFrame:
    """``rows`` with new_rules: sorted names (an array column) that the catalogue lacks."""
    return with_names(rows, long, F.coalesce(names, F.array().cast("array<string>")), "new_rules", among=False)


OFFERS = "array<struct<category: string, hint: string, rules: array<string>>>"


def with_offers(rows: DataFrame, long: DataFrame, categories: Column, hints: dict[str, str], column: str, most: int = OFFERED_RULES) -> DataFrame:
    """``rows`` with ``column``: for each of ``categories`` (an array column), in its order, the category, its hint and
    the catalogue's rules in their order; null rules for a category that the catalogue lacks.

    Up to ``most`` rules (and :data:`OFFERED_BYTES`, :data:`OFFERED_CATEGORIES`) are one constant of the plan, so that no
    row is moved. More are joined by a row number that a checkpoint fixes; the rows' lists, which together are many times
    the catalogue, are merged with their rows and never broadcast."""
    place = F.struct("row_pos", "rule")
    long = long.filter("category is not null")
    by_category = long.groupBy("category").agg(F.transform(F.sort_array(F.collect_list(place)), lambda r: r["rule"]).alias("rules"))
    told = F.map_from_arrays(F.array(*map(F.lit, hints)).cast("array<string>"), F.array(*map(F.lit, hints.values())).cast("array<string>"))
    size = long.agg(F.count("*").alias("rules"), F.coalesce(F.sum(F.octet_length("rule") + F.octet_length("category")), F.lit(0)).alias("bytes"), F.countDistinct("category").alias("categories")).first()
    if size["rules"] <= most and size["bytes"] <= OFFERED_BYTES and size["categories"] <= OFFERED_CATEGORIES:
        known = F.from_json(F.lit(json.dumps({r["category"]: r["rules"] for r in by_category.collect()})), "map<string,array<string>>")
        offer = lambda c: F.struct(c.alias("category"), F.try_element_at(told, c).alias("hint"), F.try_element_at(known, c).alias("rules"))
        return rows.withColumn(column, F.transform(categories, offer).cast(OFFERS))
    kept = [c for c in rows.columns if c != column]
    numbered = checkpointed(rows.select(F.struct(*(rows[c] for c in kept)).alias("row"), categories.alias("categories")).withColumn("number", F.monotonically_increasing_id()))
    each = numbered.select("number", F.posexplode("categories").alias("at", "category")).join(by_category.hint("merge"), "category", "left")
    offer = F.struct("category", F.try_element_at(told, F.col("category")).alias("hint"), "rules")
    lists = each.groupBy("number").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", offer.alias("offer")))), lambda r: r["offer"]).cast(OFFERS).alias("offers"))
    found = F.when(F.col("categories").isNotNull(), F.coalesce("offers", F.array().cast(OFFERS)))
    return numbered.join(lists.hint("merge"), "number", "left").select(*(F.col("row").getField(c).alias(c) for c in kept), found.alias(column))


def with_warn(rows: DataFrame, long: DataFrame, rule: str = "rule") -> DataFrame:
    """``rows`` with warn: the rule's flag, false for rules that the catalogue lacks."""
    flags = small(warn_flags(long).withColumnRenamed("rule", rule))
    return rows.join(flags, rule, "left").withColumn("warn", F.coalesce("warn", F.lit(False)))
