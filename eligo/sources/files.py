"""Readers and writers for protocols, catalogues, review tables and reports. All paths go through Spark's file
systems, and no reader takes a whole set of files through the driver."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.functions.criteria import parsed
from eligo.functions.text import document_id, header_value, unescaped
from eligo.operators.review import back_filled, schema
from eligo.sources.ranges import read_delimited

CRITERIA = "$.protocolSection.eligibilityModule.eligibilityCriteria"


def criteria_field(text: Column) -> Column:
    """The criteria text of a registry record; a record without it is an error."""
    found = F.get_json_object(text, CRITERIA)
    return unescaped(F.when(found.isNull(), F.raise_error(F.lit("the record has no eligibilityCriteria"))).otherwise(found))


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """path, text: the criteria of each registry record, a file each."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), criteria_field(F.col("value")).alias("text"))


def read_protocols(spark: SparkSession, path: str) -> DataFrame:
    """path, trial_id (null if the text names none), text of plain protocols, a file each."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), document_id(F.col("value")).alias("trial_id"), F.col("value").alias("text"))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The wide catalogue with row_pos; rows keep the file's order. A catalogue is a small sheet: it is read in one
    piece, so that the order holds and cells may have line ends."""
    wide = spark.read.csv(path, header=True, multiLine=True)
    return wide.withColumn("row_pos", F.monotonically_increasing_id())


def read_trial_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="trial_id string")


def read_criteria(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): curated criteria, one a line of JSON {trial_id, cohort, pos, code}; bad rows keep their error.

    Code is parsed, never executed, and one bad row stops no other."""
    rows = spark.read.json(path, schema="trial_id string, cohort string, pos long, code string").withColumn("node", parsed(F.col("code")))
    return rows.filter("node.error is null").withColumn("node", F.col("node.json")), rows.filter("node.error is not null").withColumn("error", F.col("node.error")).drop("node")


def read_mappings(spark: SparkSession, path: str) -> DataFrame:
    """trial file, cohort, pos and mapping of {cohort: [mapping]} files."""
    files = spark.read.text(path, wholetext=True)
    kind = "map<string,array<struct<input_rule:string,description:string,exclude:boolean,rule_reformat:string>>>"
    by_cohort = files.select(F.col("_metadata.file_path").alias("path"), F.explode(F.from_json("value", kind)).alias("cohort", "rows"))
    return by_cohort.select("path", "cohort", F.posexplode("rows").alias("pos", "row")).select("path", "cohort", "pos", F.coalesce("row.description", "row.input_rule").alias("description"), "row.exclude", "row.rule_reformat")


TSV = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_review(spark: SparkSession, path: str, in_ranges: bool = False) -> DataFrame:
    """A review table; NULL cells are null, declared columns that the file lacks are filled in. A flag that is null is
    an error, as a damaged table must not pass for an unchecked one. ``in_ranges``: large files are read by many tasks,
    although their quoted cells hold line ends."""
    raw = read_delimited(spark, path) if in_ranges else spark.read.csv(path, nullValue="NULL", emptyValue="", **TSV)
    known = {f.name: f.dataType for f in schema(derived=True)}
    flag = lambda c: F.when(F.lower(c).isin("true", "false"), F.lower(c) == "true").otherwise(F.raise_error(F.lit("a flag is neither true nor false")).cast("boolean"))
    typed = raw.select(*(flag(F.col(f"`{c}`")).alias(c) if c in known and known[c].simpleString() == "boolean" else F.col(f"`{c}`") for c in raw.columns))
    return back_filled(typed)


def write_review(rows: DataFrame, path: str) -> None:
    """The table's stored columns; an existing path is never overwritten, as it may be what ``rows`` reads."""
    names = [f.name for f in schema() if f.name in rows.columns]
    rows.select(*names).write.mode("errorifexists").csv(path, nullValue="NULL", emptyValue="", quoteAll=False, escapeQuotes=True, **{k: v for k, v in TSV.items() if k != "multiLine"})


def write_counts(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").csv(path, sep="\t", header=True, nullValue="", emptyValue="", quote='"', escape='"')


#: Fields of a curation that its parent already says (fixed values).
REDUNDANT = ("original_input_rule", "original_input_rule_id", "section")


def json_records(rows: DataFrame, children: str = "curations") -> DataFrame:
    """record: each row as JSON text; in grouped rows the children without what their parent says."""
    if children in rows.columns:
        kept = [f.name for f in rows.schema[children].dataType.elementType.fields if f.name not in REDUNDANT]
        rows = rows.withColumn(children, F.transform(children, lambda c: F.struct(*(c[k].alias(k) for k in kept))))
    return rows.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)), {"ignoreNullFields": "false"}).alias("record"))


def write_json(rows: DataFrame, path: str) -> None:
    """Grouped or flat rows, a record to a line; an existing path is never overwritten."""
    json_records(rows).withColumnRenamed("record", "value").write.mode("errorifexists").text(path)


#: Fields of a typed rule's record (fixed values).
RULE_FIELDS = "rule_text string, exclude boolean, flipped boolean, cohorts array<string>, code string, types array<string>, errors array<string>"


def write_rules(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Typed rules, a record to a line: the keys, text, flags, cohorts, code, types and errors; fields that ``rows`` lack
    are null. An existing path is never overwritten."""
    fields = [(f.split(" ", 1)) for f in RULE_FIELDS.split(", ")]
    write_json(rows.select(*keys, *((F.col(n) if n in rows.columns else F.lit(None).cast(kind)).alias(n) for n, kind in fields)), path)


def read_rules(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """Typed rules as :func:`write_rules` wrote them, with node: the code parsed again, null where it does not parse.
    ``keys``: the keys' names and types. A line that is no record has null in every field."""
    rows = spark.read.json(path, schema=f"{keys}, {RULE_FIELDS}")
    return rows.withColumn("node", parsed(F.nullif(F.col("code"), F.lit("")))["json"])


def required(column: Column, what: str) -> Column:
    return F.coalesce(column, F.raise_error(F.lit(f"{what} is missing")).cast("string"))


def flat_report(rows: DataFrame) -> DataFrame:
    """rows with report: one mapped rule as text, with its parent if there is one."""
    line = lambda *parts: F.concat(*parts, F.lit("\n"))
    has = (F.coalesce("original_input_rule_id", F.lit("")) != "") | (F.coalesce("original_input_rule", F.lit("")) != "")
    section = F.when(F.col("section").isNotNull(), line(F.lit("Section: "), F.col("section"))).otherwise("")
    text = F.when(F.coalesce("original_input_rule", F.lit("")) != "", line(F.lit("Original text:\n"), F.col("original_input_rule"))).otherwise("")
    parent = F.when(has, F.concat(F.lit("--- Parent ["), F.coalesce("original_input_rule_id", F.lit("None")), F.lit("] ---\n"), section, text, F.lit("\n"))).otherwise("")
    body = F.concat(F.lit("Input rule:\n"), required(F.col("input_rule"), "the input rule"), F.lit("\nMapped rule:\n"), required(F.col("rule_reformat"), "the mapped rule"), F.lit("\n\n"))
    return rows.withColumn("report", F.concat(parent, body))


def grouped_report(rows: DataFrame) -> DataFrame:
    """parents with report: the parent's text and its numbered child rules, or a line that says there are none."""
    child = lambda c, k: F.concat(F.format_string("  --- Child rule #%d ---\n", k + 1), F.lit("  Input rule: "), required(c["input_rule"], "a child's input rule"), F.lit("\n  Mapped rule: "), required(c["rule_reformat"], "a child's mapped rule"), F.lit("\n"))
    body = F.when(F.size("curations") > 0, F.array_join(F.transform("curations", child), "\n")).otherwise("  (No curated rules for this statement.)\n")
    section = F.when(F.col("section").isNotNull(), F.concat(F.lit("Section: "), F.col("section"), F.lit("\n"))).otherwise("")
    head = F.concat(F.lit("=== Parent statement ["), F.coalesce("original_input_rule_id", F.lit("None")), F.lit("] ===\n"), section, F.coalesce("original_input_rule", F.lit("")), F.lit("\n"))
    return rows.withColumn("report", F.concat(head, body))


def tsv_cell(text: Column) -> Column:
    """A cell with backslash, tab, newline and carriage return escaped."""
    for raw, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def criterion_line(rule_id: Column, rule: Column, parts: Column) -> Column:
    """``criterion``, id, rule and the parts of the mapped rule, tab separated; as wide as there are parts."""
    return F.concat_ws("\t", F.lit("criterion"), tsv_cell(rule_id), tsv_cell(rule), F.transform(parts, tsv_cell))


def reformatted(docs: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """key, place, line of the reformatted table: ``trial_id`` and ``title`` head each document's criterion lines.

    ``docs``: key, text; ``lines``: key, at, line."""
    values = (("trial_id", document_id(F.col("text"))), ("title", header_value(F.col("text"), "Trial Title")))
    heads = [F.concat_ws("\t", F.lit(name), tsv_cell(F.coalesce(v, F.lit("")))) for name, v in values]
    head = docs.select(key, F.posexplode(F.array(*heads)).alias("at", "line"))
    return head.select(key, (F.col("at") - 2).cast("long").alias("place"), "line").unionByName(lines.select(key, F.col("at").cast("long").alias("place"), "line"))


def prefixed_path(path: Column, trial_id: Column) -> Column:
    """:func:`prefixed` for a column of paths."""
    name = F.substring_index(path, "/", -1)
    folder = path.substr(F.lit(1), F.length(path) - F.length(name))
    same = F.coalesce(trial_id, F.lit("")) == ""
    return F.when(same | name.startswith(trial_id), path).otherwise(F.concat(folder, trial_id, F.lit("_"), name))


def prefixed(path: str, trial_id: str | None) -> str:
    """The path with the trial's id before its file name; as it is without an id or if it has it already."""
    at = PurePosixPath(path)
    return path if not trial_id or at.name.startswith(trial_id) else str(at.with_name(f"{trial_id}_{at.name}"))
