"""Nesting and unnesting, merges of curated and mapped rows, counts by node type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eligo.functions.criteria import NODES


def flattened(grouped: DataFrame, parent: list[str], children: str = "curations") -> DataFrame:
    """One row per child with its parent's columns; parents without children vanish."""
    return grouped.select(*parent, F.inline(children))


def grouped(parents: DataFrame, rows: DataFrame, key: str, order: str, children: str = "curations") -> DataFrame:
    """``parents`` with their children in order; none gives an empty list, children with a null key are left out and
    parents that share a key each get all of its children."""
    kept = [c for c in rows.columns if c not in (key, order)]
    lists = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *kept))).alias(children))
    out = parents.join(lists, key, "left")
    bare = F.transform(F.coalesce(children, F.array().cast(lists.schema[children].dataType)), lambda c: F.struct(*(c[k].alias(k) for k in kept)))
    return out.withColumn(children, bare)


def merged(curated: DataFrame, mapped: DataFrame, key: str) -> DataFrame:
    """Every row of ``mapped`` with the curated rows of its key, null meeting null; repeated keys multiply."""
    left = curated.withColumnRenamed(key, "curated_key")
    return left.join(mapped, left["curated_key"].eqNullSafe(mapped[key]), "right").drop("curated_key")


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key, value: that of each key's last row."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def stacked(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones null."""
    if not frames:
        raise ValueError("nothing to stack")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def numbered(rows: DataFrame, parts: list[str], order: str, document: str) -> DataFrame:
    """``rows`` with RuleNum (from 1, within ``parts``) and RuleId (document.number)."""
    n = F.row_number().over(Window.partitionBy(*parts).orderBy(order))
    return rows.withColumn("RuleNum", n).withColumn("RuleId", F.concat_ws(".", F.col(document), F.col("RuleNum")))


def type_counts(rows: DataFrame, types: Column, names: tuple[str, ...] = tuple(NODES)) -> DataFrame:
    """``rows`` with one column per node type: how often ``types`` (an array column) has it. No shuffle."""
    tagged = rows.withColumn("node_types_", types)
    count = lambda name: F.size(F.filter("node_types_", lambda t: t == name))
    counts = {n: count(n) for n in names}
    return tagged.withColumns(counts).drop("node_types_")


def rebuilt(rule: Column, exclude: Column, flipped: Column, cohorts: Column) -> Column:
    """An atomic rule: ``flipped`` rules are inclusions, and the flag and the cohorts stay."""
    return F.struct(rule.alias("input_rule"), F.when(flipped, False).otherwise(exclude).alias("exclude"), flipped.alias("flipped"), cohorts.alias("cohorts"))


def collapsed(results: Column) -> Column:
    """Of several mapping results the first one's rule text and the last one's tree."""
    return F.struct(F.try_element_at(results, F.lit(1))["input_rule"].alias("input_rule"), F.try_element_at(results, F.lit(-1))["rule_tree"].alias("rule_tree"))


def category_union(rows: DataFrame, categories: str, always: list[str]) -> DataFrame:
    """One row: the distinct categories of all rows' lists and those that always apply, sorted."""
    found = rows.select(F.explode(categories).alias("c")).agg(F.collect_set("c").alias("found"))
    return found.select(F.sort_array(F.array_union("found", F.array(*map(F.lit, always)))).alias("categories"))


def with_any(rows: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    """Rows whose list has any of ``wanted``."""
    return rows.filter(F.arrays_overlap(column, F.array(*map(F.lit, wanted))))
