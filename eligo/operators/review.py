"""The review table: facets, sorting, paging, overrides. Every step is a lazy DataFrame; the driver holds only what a
user chose (deselected options, sort keys, page)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.functions.criteria import NODES, parsed
from eligo.sources.shared import fresh_dir

#: The table's columns in order (fixed values): name, type, derived.
COLUMNS = [
    ("TrialId", "string", False), ("Cohort", "string", False), ("RuleNum", "string", False), ("RuleId", "string", False), ("Description", "string", False),
    *((n, "string", False) for n in NODES),
    ("Checked", "boolean", False), ("Override", "boolean", True), ("Action", "string", True), ("Code", "string", True), ("Notes", "string", False),
    ("Error", "string", True), ("LlmCode", "string", False), ("OverrideCode", "string", False),
]
EMPTY = {"boolean": False, "int": 0, "bigint": 0, "double": 0.0}


def schema(derived: bool = False) -> T.StructType:
    return T.StructType([T.StructField(n, T.BooleanType() if t == "boolean" else T.StringType()) for n, t, d in COLUMNS if derived or not d])


def back_filled(rows: DataFrame, derived: bool = False) -> DataFrame:
    """``rows`` with the declared columns that they lack, as false, zero or null by type."""
    missing = {f.name: F.lit(EMPTY.get(f.dataType.simpleString())).cast(f.dataType) for f in schema(derived) if f.name not in rows.columns}
    return rows.withColumns(missing) if missing else rows


@dataclass(frozen=True)
class AllBut:
    """Every option of a facet is deselected but those in ``kept``."""

    kept: tuple = ()


def keeps(column: str, deselected: list | AllBut) -> Column:
    """Whether a row passes a facet: its value is not deselected. Null is an option like any other."""
    if isinstance(deselected, AllBut):
        values = [v for v in deselected.kept if v is not None]
        chosen = F.coalesce(F.col(column).isin(values), F.lit(False)) if values else F.lit(False)
        return chosen | F.col(column).isNull() if None in deselected.kept else chosen
    values = [v for v in deselected if v is not None]
    passes = F.coalesce(~F.col(column).isin(values), F.lit(True)) if values else F.lit(True)
    return passes & F.col(column).isNotNull() if None in deselected else passes


def options(rows: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """The column's distinct values in order, null first, of those that begin with ``prefix`` (case matters)."""
    found = rows.select(column).distinct()
    if prefix:
        found = found.filter(F.col(column).cast("string").startswith(prefix))
    return found.orderBy(F.col(column).asc_nulls_first())


@dataclass(frozen=True)
class Review:
    """A view of a table; each method gives a changed one."""

    rows: DataFrame
    key: str
    size: int = 50
    deselected: dict = field(default_factory=dict)
    sort: tuple[tuple[str, bool], ...] = ()
    page: int = 0

    def toggled(self, column: str, option) -> Review:
        now = self.deselected.get(column, [])
        listed = list(now.kept if isinstance(now, AllBut) else now)
        listed = [o for o in listed if o != option] if option in listed else [*listed, option]
        chosen = AllBut(tuple(listed)) if isinstance(now, AllBut) else listed
        return replace(self, deselected={**self.deselected, column: chosen})

    def all_selected(self, column: str) -> Review:
        return replace(self, deselected={**self.deselected, column: []})

    def none_selected(self, column: str) -> Review:
        """Deselects every option, however many there are; options toggled afterwards are shown again."""
        return replace(self, deselected={**self.deselected, column: AllBut()})

    def sorted_by(self, column: str) -> Review:
        """One more click on a column: ascending, then descending, then not sorted; back to the first page."""
        now = dict(self.sort)
        if column not in now:
            keys = (*self.sort, (column, True))
        elif now[column]:
            keys = tuple((c, False if c == column else up) for c, up in self.sort)
        else:
            keys = tuple(k for k in self.sort if k[0] != column)
        return replace(self, sort=keys, page=0)

    def filtered(self) -> DataFrame:
        out = self.rows
        for column, values in self.deselected.items():
            if values or isinstance(values, AllBut):
                out = out.filter(keeps(column, values))
        return out

    def ordered(self) -> DataFrame:
        """Filtered rows by the sort keys in the order of clicks, nulls last both ways, ties by the key."""
        keys = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in self.sort]
        return self.filtered().orderBy(*keys, self.key)

    def pages(self) -> int:
        return ceil(self.filtered().count() / self.size)

    def at(self, page: int) -> Review:
        """The page with that number, clamped to those there are."""
        return replace(self, page=max(0, min(page, self.pages() - 1)))

    def typed_page(self, number: str) -> Review:
        """The page whose number (from 1) was typed; what is no number changes nothing."""
        return self.at(int(number) - 1) if number.strip().isdecimal() else self

    def typed_size(self, size: str) -> Review:
        """Another page size, back on the first page; what is no positive number changes nothing."""
        return replace(self, size=int(size), page=0) if size.strip().isdecimal() and int(size) > 0 else self

    def shown(self) -> DataFrame:
        return self.ordered().offset(self.page * self.size).limit(self.size)

    def loaded(self, rows: DataFrame, stay: bool = False) -> Review:
        """The view of another table: sort keys stay, facets begin anew with everything selected, and so does the page,
        or with ``stay`` the same page, clamped to those there are."""
        view = replace(self, rows=rows, deselected={}, page=0)
        return view.at(self.page) if stay else view

    def indexed(self) -> Pages:
        """The view's rows, sorted once and written by ranges, for any number of its pages."""
        ordered = self.ordered().withColumn("place_", F.monotonically_increasing_id())
        ordered = ordered.withColumns({"part_": F.shiftright("place_", 33).cast("int"), "at_": F.col("place_").bitwiseAND(F.lit((1 << 33) - 1))}).drop("place_")
        path = fresh_dir(self.rows.sparkSession, "pages")
        ordered.write.partitionBy("part_").parquet(path)
        columns = [(f.name, f.dataType) for f in ordered.schema.fields if f.name != "part_"]
        written = T.StructType([*(T.StructField(n, t) for n, t in columns), T.StructField("part_", T.IntegerType())])
        table = self.rows.sparkSession.read.schema(written).parquet(path)
        starts, before = [], 0
        for part, n in sorted(table.groupBy("part_").count().collect()):  # a row for each range
            starts.append((part, before, n))
            before += n
        return Pages(table, tuple(starts), before, self.size)

    def checked(self, code: str = "Code") -> DataFrame:
        """The page's rows with Error: why their code cannot be parsed, null if it can. Only the page is parsed."""
        return self.shown().withColumn("Error", parsed(F.col(code))["error"])


@dataclass(frozen=True)
class Pages:
    """A sorted table in ranges, and how many rows come before each: any page is read from the one or two ranges that
    hold it, however deep it lies."""

    table: DataFrame
    starts: tuple[tuple[int, int, int], ...]
    rows: int
    size: int

    def count(self) -> int:
        return ceil(self.rows / self.size)

    def page(self, number: int) -> DataFrame:
        """The rows of a page (from 0; clamped to those there are), in order."""
        first = max(0, min(number, self.count() - 1)) * self.size
        inside = F.lit(False)
        for part, start, n in self.starts:
            if start < first + self.size and first < start + n:
                inside = inside | ((F.col("part_") == part) & F.col("at_").between(first - start, first + self.size - 1 - start))
        return self.table.filter(inside).orderBy("part_", "at_").drop("part_", "at_")


def page_list(page: int, pages: int, around: int = 7) -> list[int | None]:
    """Page numbers to offer, from 1: the ends and those around the current one; None stands for a gap."""
    near = sorted({1, pages, *range(max(1, page - around), min(pages, page + around) + 1)}) if pages else []
    out: list[int | None] = []
    for n in near:
        if out and out[-1] is not None and n - out[-1] > 1:
            out.append(None)
        out.append(n)
    return out


def moved(columns: list[str], name: str, before: str | None) -> list[str]:
    """A column order after ``name`` was dragged before another column, or to the end."""
    rest = [c for c in columns if c != name]
    at = rest.index(before) if before in rest else len(rest)
    return [*rest[:at], name, *rest[at:]]


@dataclass(frozen=True)
class Columns:
    """Which of a table's columns are shown, and in what order; each method gives a changed choice."""

    declared: tuple[str, ...]
    shown: tuple[str, ...]

    def moved(self, name: str, before: str | None) -> Columns:
        return replace(self, shown=tuple(moved(list(self.shown), name, before)))

    def toggled(self, name: str) -> Columns:
        """A shown column hidden, or a hidden one put back where the declared order has it."""
        if name not in self.declared:
            raise ValueError(f"no column {name}")
        if name in self.shown:
            return replace(self, shown=tuple(c for c in self.shown if c != name))
        after = self.declared[self.declared.index(name) + 1 :]
        return replace(self, shown=tuple(moved([*self.shown, name], name, next((c for c in after if c in self.shown), None))))

    def reset(self) -> Columns:
        return replace(self, shown=self.declared)

    def saved(self) -> str:
        return json.dumps(self.shown)

    def restored(self, saved: str) -> Columns:
        """A saved choice; columns that are no longer declared are left out."""
        return replace(self, shown=tuple(c for c in json.loads(saved) if c in self.declared))

    def of(self, rows: DataFrame) -> DataFrame:
        return rows.select(*(F.col(f"`{c}`") for c in self.shown))


def overlaid(base: DataFrame, edits: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` (keys, LlmCode, ...) under the latest edit of each key.

    ``edits``: keys, version, OverrideCode, deleted. A deleted or empty override gives the base's code back."""
    latest = edits.groupBy(*keys).agg(F.max_by(F.struct("OverrideCode", "deleted"), "version").alias("edit"))
    out = base.drop("OverrideCode", "Override", "Code").join(latest, keys, "left")
    code = F.when(~F.col("edit.deleted"), F.nullif(F.col("edit.OverrideCode"), F.lit("")))
    out = out.withColumn("OverrideCode", code).drop("edit")
    return out.withColumn("Override", F.col("OverrideCode").isNotNull()).withColumn("Code", F.coalesce("OverrideCode", "LlmCode"))


def annotated(base: DataFrame, edits: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``base`` with a column (Notes, Checked) replaced by its latest edit; ``edits``: keys, version, column."""
    latest = edits.groupBy(*keys).agg(F.max_by(column, "version").alias("edited_"))
    return base.join(latest, keys, "left").withColumn(column, F.coalesce("edited_", column)).drop("edited_")


def validated(edits: DataFrame, code: str = "OverrideCode") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) edits: code that cannot be parsed is held back with its Error."""
    tried = edits.withColumn("parsed_", parsed(F.col(code)))
    wrong = F.col(code).isNotNull() & (F.col(code) != "") & F.col("parsed_.error").isNotNull()
    return tried.filter(~wrong).drop("parsed_"), tried.filter(wrong).withColumn("Error", F.col("parsed_.error")).drop("parsed_")
