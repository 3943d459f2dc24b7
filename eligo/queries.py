"""Registered queries over the driver's tables, and SQL that gives the same rows.

Inputs that the tables lack (protocol texts, rule trees, near-JSON, overrides) are derived from them by the same
expression on both sides, so that each query's work grows with its tables."""

from __future__ import annotations

import json
from functools import reduce
from http.server import BaseHTTPRequestHandler

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.functions import criteria, lenient, text, trees
from eligo.operators import catalogue, compare, nesting, review
from eligo.operators.edits import EditLog
from eligo.plans import curation, models
from eligo.sources import files, records
from eligo.sources.shared import checkpointed, fresh_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- review table ----------------------------------------------------------------------------------------------------
PRIORITY = "nullif(o_orderpriority, '5-LOW')"


@query(f"""SELECT o_orderkey, priority, o_orderstatus, o_totalprice FROM (SELECT *, {PRIORITY} AS priority FROM orders)
WHERE (priority NOT IN ('1-URGENT')) IS NOT FALSE AND (o_orderstatus NOT IN ('P')) IS NOT FALSE
ORDER BY priority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50 OFFSET 100""")
def facet_filter_page(spark, sf_dir):
    """F1, F2, O1, O2, L1: facets keep nulls, keys sort nulls last, the third page."""
    rows = t(spark, sf_dir, "orders").withColumn("priority", F.expr(PRIORITY)).select("o_orderkey", "priority", "o_orderstatus", "o_totalprice")
    view = review.Review(rows, "o_orderkey").toggled("priority", "1-URGENT").toggled("o_orderstatus", "P")
    view = view.sorted_by("priority").sorted_by("o_totalprice").sorted_by("o_totalprice")
    return review.replace(view, page=2).shown()


@query(f"""SELECT o_orderstatus, count(*) AS n FROM (SELECT *, {PRIORITY} AS priority FROM orders)
WHERE priority IS NOT NULL AND (priority NOT IN ('3-MEDIUM')) IS NOT FALSE GROUP BY 1""")
def facet_null_deselected(spark, sf_dir):
    """null is an option that can be deselected."""
    rows = t(spark, sf_dir, "orders").withColumn("priority", F.expr(PRIORITY))
    return rows.filter(review.keeps("priority", ["3-MEDIUM", None])).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT c_mktsegment FROM customer")
def facet_options(spark, sf_dir):
    """A4: a facet's options."""
    return review.options(t(spark, sf_dir, "customer"), "c_mktsegment")


@query("SELECT DISTINCT p_name FROM part WHERE starts_with(p_name, 'b')")
def facet_search(spark, sf_dir):
    """options by prefix."""
    return review.options(t(spark, sf_dir, "part"), "p_name", "b")


@query(f"""SELECT status, CAST(ceil(count(*) / 50.0) AS BIGINT) AS pages, count(*) AS total FROM
(SELECT o_orderstatus AS status, {PRIORITY} AS priority FROM orders) WHERE (priority NOT IN ('1-URGENT')) IS NOT FALSE GROUP BY 1""")
def page_counts(spark, sf_dir):
    """Rows and pages of each status under a facet."""
    rows = t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.expr(PRIORITY).alias("priority"))
    kept = rows.filter(review.keeps("priority", ["1-URGENT"]))
    return kept.groupBy("status").agg(F.ceil(F.count("*") / 50).cast("long").alias("pages"), F.count("*").alias("total"))


EDITS = "CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS code, event_id % 7 = 0 AS gone"


@query(f"""WITH last AS (SELECT user_id, code, gone, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM (SELECT event_id, user_id, {EDITS} FROM events WHERE event_type <> 'view')),
base AS (SELECT user_id, min(event_type) AS own FROM events GROUP BY 1)
SELECT user_id AS trial, own AS llm_code, CASE WHEN NOT gone THEN nullif(code, '') END AS override_code,
coalesce(CASE WHEN NOT gone THEN nullif(code, '') END, own) AS code FROM base LEFT JOIN (SELECT * FROM last WHERE k = 1) USING (user_id)""")
def override_overlay(spark, sf_dir):
    """The latest override of a key, tombstones and empty overrides give the base's code."""
    events = t(spark, sf_dir, "events")
    base = events.groupBy("user_id").agg(F.min("event_type").alias("LlmCode"))
    edits = events.filter("event_type <> 'view'").selectExpr("user_id", "event_id AS version", *EDITS.replace(" AS code", " AS OverrideCode").replace(" AS gone", " AS deleted").rsplit(", ", 1))
    out = review.overlaid(base, edits, ["user_id"])
    return out.select(F.col("user_id").alias("trial"), F.col("LlmCode").alias("llm_code"), F.col("OverrideCode").alias("override_code"), F.col("Code").alias("code"))


@query("""WITH edits AS (SELECT user_id, props, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events WHERE event_type = 'purchase')
SELECT u.user_id, coalesce(e.props, 'none') AS notes FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT * FROM edits WHERE k = 1) e ON u.user_id = e.user_id""")
def edited_notes(spark, sf_dir):
    """M3: the latest note of a key."""
    events = t(spark, sf_dir, "events")
    base = events.select("user_id").distinct().withColumn("notes", F.lit("none"))
    edits = events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("version"), F.col("props").alias("notes"))
    return review.annotated(base, edits, ["user_id"], "notes")


EDITED = """WITH edits AS (SELECT event_id, user_id, CASE event_id % 4 WHEN 0 THEN 'Notes' WHEN 1 THEN 'Checked' ELSE 'OverrideCode' END AS field,
CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN CASE WHEN event_id % 8 = 1 THEN 'true' ELSE 'false' END ELSE CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END END AS value, event_id % 13 = 0 AS deleted FROM events),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, field ORDER BY event_id DESC) AS k FROM edits) WHERE k = 1),
wide AS (SELECT u.user_id, 'own ' || u.user_id AS own, n.value AS note, n.deleted AS no_note, c.value AS mark, c.deleted AS no_mark, CASE WHEN NOT o.deleted THEN nullif(o.value, '') END AS code
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN last n ON n.user_id = u.user_id AND n.field = 'Notes' LEFT JOIN last c ON c.user_id = u.user_id AND c.field = 'Checked' LEFT JOIN last o ON o.user_id = u.user_id AND o.field = 'OverrideCode')
SELECT user_id, CASE WHEN NOT no_note THEN note ELSE 'none' END AS notes, CASE WHEN NOT no_mark THEN mark = 'true' ELSE false END AS checked, code IS NOT NULL AS override, coalesce(code, own) AS code FROM wide"""


def edited(spark, sf_dir, compacted: bool) -> DataFrame:
    """The users' rows under a log of three versions, between which the log may be compacted."""
    events = t(spark, sf_dir, "events")
    edits = events.selectExpr("event_id", "user_id", "CASE event_id % 4 WHEN 0 THEN 'Notes' WHEN 1 THEN 'Checked' ELSE 'OverrideCode' END AS field",
        "CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN CASE WHEN event_id % 8 = 1 THEN 'true' ELSE 'false' END ELSE CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END END AS value",
        "event_id % 13 = 0 AS deleted", "event_id AS seq")
    log, cut = EditLog(fresh_dir(spark, "edits"), ("user_id",)), events.agg(F.max("event_id").alias("n")).first()["n"] or 0
    for k in range(3):
        log.append(edits.filter((F.col("event_id") > k * cut // 3 - (k == 0)) & (F.col("event_id") <= (k + 1) * cut // 3)))
        if compacted and k < 2:
            log.compact(spark)
    base = events.select("user_id").distinct().select("user_id", F.concat(F.lit("own "), "user_id").alias("LlmCode"), F.lit("none").alias("Notes"), F.lit(False).alias("Checked"))
    return log.applied(base).select("user_id", F.col("Notes").alias("notes"), F.col("Checked").alias("checked"), F.col("Override").alias("override"), F.col("Code").alias("code"))


@query(EDITED)
def edit_log(spark, sf_dir):
    """M1, M2, M3, M4: overrides, notes and check marks from a log of versions."""
    return edited(spark, sf_dir, False)


@query(EDITED)
def compacted_edit_log(spark, sf_dir):
    """M1, M2, M3, M4: the same from a log that was compacted between its versions."""
    return edited(spark, sf_dir, True)


@query("""WITH placed AS (SELECT o_orderkey, row_number() OVER (ORDER BY nullif(o_orderpriority, '5-LOW') ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey) - 1 AS k, count(*) OVER () AS n FROM orders WHERE o_orderstatus = 'F')
SELECT CASE s.stay WHEN 0 THEN 'first' ELSE 'clamped' END AS page, o_orderkey FROM placed, (SELECT unnest([0, 1]) AS stay) s WHERE k // 50 = CASE s.stay WHEN 0 THEN 0 ELSE (n - 1) // 50 END""")
def loaded_table(spark, sf_dir):
    """M5, L3: another table in a view keeps the sort keys and selects everything; the page begins anew or is clamped."""
    rows = t(spark, sf_dir, "orders").withColumn("priority", F.expr(PRIORITY))
    view = review.Review(rows, "o_orderkey").toggled("priority", "1-URGENT").sorted_by("priority").sorted_by("o_totalprice").sorted_by("o_totalprice")
    view = view.at(10**9)
    other = rows.filter("o_orderstatus = 'F'")
    shown = [v.shown().select(F.lit(name).alias("page"), "o_orderkey") for name, v in (("first", view.loaded(other)), ("clamped", view.loaded(other, stay=True)))]
    return shown[0].unionAll(shown[1])


@query("""WITH placed AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) - 1 AS k, count(*) OVER () AS n FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, o_totalprice FROM placed WHERE k // 50 IN (0, least(17, (n - 1) // 50), (n - 1) // 50)""")
def deep_pages(spark, sf_dir):
    """L1, L2, L3, O1: pages of a sorted table by a rank index: the first, one in the middle, and the last."""
    rows = t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    pages = review.Review(rows, "o_orderkey").toggled("o_orderstatus", "P").sorted_by("o_totalprice").sorted_by("o_totalprice").indexed()
    numbers = sorted({0, min(17, pages.count() - 1), pages.count() - 1})
    return reduce(DataFrame.unionAll, [pages.page(n) for n in numbers]).select("o_orderkey", "o_totalprice")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS TrialId, nullif(c_mktsegment, 'MACHINERY') AS Cohort, c_name || chr(10) || '"q"' AS Description, c_nationkey % 2 = 0 AS Checked,
CAST(NULL AS VARCHAR) AS Notes FROM customer""")
def review_round_trip(spark, sf_dir):
    """A review table written as TSV and read again, missing columns filled in."""
    rows = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("TrialId"), F.expr("nullif(c_mktsegment, 'MACHINERY')").alias("Cohort"), F.concat("c_name", F.lit('\n"q"')).alias("Description"), (F.col("c_nationkey") % 2 == 0).alias("Checked")
    )
    at = fresh_dir(spark, "review")
    files.write_review(rows, at)
    return files.read_review(spark, at).select("TrialId", "Cohort", "Description", "Checked", "Notes")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS TrialId, CASE WHEN c_custkey % 3 = 0 THEN chr(10) || c_name || chr(10) || chr(10) || '"q"' || chr(9) ELSE c_name END AS Description, c_nationkey % 2 = 0 AS Checked,
CASE WHEN c_custkey % 4 <> 0 THEN nullif(c_mktsegment, 'MACHINERY') END AS Notes FROM customer""")
def review_in_ranges(spark, sf_dir):
    """One large review file, whose quoted cells hold line ends, read in byte ranges by many tasks."""
    description = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("\n"), "c_name", F.lit('\n\n"q"\t'))).otherwise(F.col("c_name"))
    rows = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("TrialId"), description.alias("Description"), (F.col("c_nationkey") % 2 == 0).alias("Checked"), F.when(F.col("c_custkey") % 4 != 0, F.expr("nullif(c_mktsegment, 'MACHINERY')")).alias("Notes"))
    at, name = fresh_dir(spark, "review"), "spark.sql.files.maxPartitionBytes"
    files.write_review(rows.coalesce(1), at)
    before, length = spark.conf.get(name), spark.read.format("binaryFile").load(at).agg(F.sum("length")).first()[0] or 0
    # ranges are small only so that a small table has many: of 16 kB up to 1 MB, and then as many, up to Spark's own size
    spark.conf.set(name, str(min(max(16 << 10, length // 64), 128 << 20)))
    try:
        return checkpointed(files.read_review(spark, at, in_ranges=True).select("TrialId", "Description", "Checked", "Notes"))
    finally:
        spark.conf.set(name, before)


@query("""SELECT p_partkey, 'part "' || p_name || '"' || chr(10) AS rule_text, p_size % 2 = 0 AS exclude, false AS flipped, CASE WHEN p_size % 3 = 0 THEN p_brand || ',' || p_type END AS cohorts,
CASE WHEN p_size % 5 <> 0 THEN 'Age(age=' || p_size || ', operator=">=")' END AS code, CASE WHEN p_size % 5 <> 0 THEN p_size END AS age, 'Age' AS types, CASE WHEN p_size % 5 = 0 THEN 'curate: empty code' ELSE '' END AS errors FROM part""")
def typed_records(spark, sf_dir):
    """Typed rules with code, types and errors, written as records and read back, the code parsed again."""
    size = F.col("p_size")
    rows = t(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit('part "'), "p_name", F.lit('"\n')).alias("rule_text"), (size % 2 == 0).alias("exclude"), F.lit(False).alias("flipped"), F.when(size % 3 == 0, F.array("p_brand", "p_type")).alias("cohorts"),
        F.when(size % 5 != 0, F.format_string('Age(age=%d, operator=">=")', size)).alias("code"), F.array(F.lit("Age")).alias("types"), F.when(size % 5 == 0, F.array(F.lit("curate: empty code"))).otherwise(F.array().cast("array<string>")).alias("errors"))
    at = fresh_dir(spark, "rules")
    files.write_rules(rows, at, ["p_partkey"])
    out = files.read_rules(spark, at, "p_partkey long")
    return out.select("p_partkey", "rule_text", "exclude", "flipped", F.array_join("cohorts", ",").alias("cohorts"), "code", F.get_json_object("node", "$.age").cast("int").alias("age"), F.array_join("types", ",").alias("types"), F.array_join("errors", ",").alias("errors"))


@query("""SELECT c_custkey, 'I-0' || k AS statement_id, 'INCLUSION' AS section, CASE k WHEN 1 THEN 'age over ' || c_nationkey ELSE 'weight ' || c_custkey || ' a|weight ' || c_custkey || ' b' END AS rules FROM customer, (SELECT unnest([1, 2]) AS k)""")
def grouped_rules(spark, sf_dir):
    """Protocol texts cut into statements, each with its atomic rules in order."""
    # a small file has few splits, and its texts are many times as large
    rows = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").repartition(spark.sparkContext.defaultParallelism, "c_custkey").select("c_custkey", F.format_string("Inclusion Criteria:\n1. age over %d\n2. weight %d\n", "c_nationkey", "c_custkey").alias("text"))
    lines = rows.join(t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey").select(F.explode(F.array(F.struct(F.format_string("1. age over %d", "c_nationkey").alias("s"), F.lit(1).alias("k")), F.struct(F.format_string("2. weight %d", "c_custkey").alias("s"), F.lit(2).alias("k")))).alias("x")).select("x.*").distinct()
    said = F.substring("s", 4, 99)
    tagged = F.when(F.col("k") == 1, F.format_string('[{"input_rule": "%s", "exclude": false}]', said)).otherwise(F.format_string('[{"input_rule": "%s a", "exclude": false}, {"input_rule": "%s b", "exclude": false}]', said, said))
    cache = answers(lines, "sanitise", F.col("s"), F.col("s")).unionAll(answers(lines, "tag", F.col("s"), tagged))
    out = curation.grouped_rules(rows, models.Asker(cache), "c_custkey")
    return out.select("c_custkey", "statement_id", "section", F.array_join(F.transform("curations", lambda c: c["input_rule"]), "|").alias("rules"))


@query("""SELECT c_custkey, c_acctbal < 0 AS owes FROM customer WHERE c_acctbal < 0 IS TRUE OR c_acctbal IS NULL""")
def boolean_facet(spark, sf_dir):
    """all options of a boolean facet deselected, two shown again."""
    rows = t(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") < 0).alias("owes"))
    return review.Review(rows, "c_custkey").none_selected("owes").toggled("owes", True).toggled("owes", None).filtered()


@query("""SELECT p_partkey, p_partkey % 3 = 1 AS refused FROM part""")
def validated_edits(spark, sf_dir):
    """Edits whose code cannot be parsed are held back, empty ones are not."""
    code = "CASE p_partkey % 3 WHEN 0 THEN 'Other(reason=\"' || p_brand || '\")' WHEN 1 THEN 'Other(reason=' || p_size || ')' ELSE '' END AS OverrideCode"
    good, bad = review.validated(t(spark, sf_dir, "part").selectExpr("p_partkey", code))
    return good.select("p_partkey", F.lit(False).alias("refused")).unionByName(bad.select("p_partkey", F.col("Error").isNotNull().alias("refused")))


# -- files -----------------------------------------------------------------------------------------------------------
@query("""SELECT CAST(p_partkey AS VARCHAR) AS trial_id, CASE WHEN p_partkey % 4 > 0 THEN p_brand END AS reason, p_partkey % 4 = 0 AS failed FROM part""")
def criteria_files(spark, sf_dir):
    """Curated criteria written as lines of JSON and read again; bad rows keep their error."""
    code = F.concat(F.when(F.col("p_partkey") % 4 > 0, "Other").otherwise("Others"), F.lit('(reason="'), "p_brand", F.lit('")'))
    at = fresh_dir(spark, "criteria")
    files.write_json(t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("trial_id"), F.lit("c").alias("cohort"), F.lit(0).alias("pos"), code.alias("code")), at)
    good, bad = files.read_criteria(spark, at)
    none = F.lit(None).cast("string")
    return good.select("trial_id", F.get_json_object("node", "$.reason").alias("reason"), F.lit(False).alias("failed")).unionByName(bad.select("trial_id", none.alias("reason"), F.col("error").isNotNull().alias("failed")))


@query("""SELECT c_custkey AS id, c_mktsegment AS segment, NULL AS size FROM customer UNION ALL SELECT p_partkey, NULL, CAST(p_size AS VARCHAR) FROM part""")
def count_table_file(spark, sf_dir):
    """Stacked frames as a tab-separated table, nulls as empty cells."""
    at = fresh_dir(spark, "counts")
    files.write_counts(nesting.stacked([t(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS segment"), t(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_size AS size")]), at)
    back = spark.read.csv(at, sep="\t", header=True)
    return back.select(F.col("id").cast("long").alias("id"), F.nullif("segment", F.lit("")).alias("segment"), F.nullif("size", F.lit("")).alias("size"))


@query("""SELECT 'T' || o_orderkey AS trial_id FROM orders""")
def trial_list_file(spark, sf_dir):
    """A list of trials without a head."""
    at = fresh_dir(spark, "trials")
    t(spark, sf_dir, "orders").select(F.concat(F.lit("T"), "o_orderkey")).write.csv(at)
    return files.read_trial_list(spark, at)


def one_file_each(rows: DataFrame, at: str) -> str:
    """``rows`` (name, value) written as texts, a file each."""
    rows.repartition("name").write.partitionBy("name").text(at)
    return at


@query("""SELECT n_nationkey, 'I-' || n_name || chr(10) || '[x]' AS text FROM nation""")
def trial_files(spark, sf_dir):
    """Registry records, a file each."""
    record = F.concat(F.lit('{"protocolSection": {"eligibilityModule": {"eligibilityCriteria": "I-'), "n_name", F.lit('\\n\\\\[x\\\\]"}}}'))
    at = one_file_each(t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("name"), record.alias("value")), fresh_dir(spark, "records"))
    return files.read_trials(spark, at).select(F.regexp_extract("path", r"name=(\d+)", 1).cast("int").alias("n_nationkey"), "text")


@query("""SELECT 'T_' || n_nationkey AS trial_id, 'Trial ID: T ' || n_nationkey || chr(10) || n_name AS text FROM nation""")
def protocol_files(spark, sf_dir):
    """Plain protocols, a file each."""
    body = F.concat(F.lit("Trial ID: T "), "n_nationkey", F.lit("\n"), "n_name")
    at = one_file_each(t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("name"), body.alias("value")), fresh_dir(spark, "protocols"))
    return files.read_protocols(spark, at).select("trial_id", text.strip(F.col("text")).alias("text"))


@query("""SELECT n_nationkey, c_mktsegment AS cohort, CAST(row_number() OVER (PARTITION BY n_nationkey, c_mktsegment ORDER BY c_custkey) - 1 AS INTEGER) AS pos, c_name AS description, CASE WHEN c_custkey % 2 = 0 THEN 'R' || c_custkey END AS rule_reformat
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def mapping_files(spark, sf_dir):
    """Mappings by cohort, a file for each trial; the text stands in for a missing description."""
    rule = F.struct(F.col("c_custkey"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("description"), F.col("c_name").alias("input_rule"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("R"), "c_custkey")).alias("rule_reformat"))
    lists = t(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.sort_array(F.collect_list(rule)).alias("rules"))
    lists = lists.groupBy(F.col("c_nationkey").alias("name")).agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "rules"))).alias("by_cohort"))
    at = one_file_each(lists.select("name", F.to_json("by_cohort").alias("value")), fresh_dir(spark, "mappings"))
    return files.read_mappings(spark, at).select(F.regexp_extract("path", r"name=(\d+)", 1).cast("int").alias("n_nationkey"), "cohort", "pos", "description", "rule_reformat")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE '--- Parent [' || o_orderkey || '] ---' || chr(10) || 'Section: ' || o_orderstatus || chr(10) || 'Original text:' || chr(10) || o_orderpriority || chr(10) || chr(10) END ||
'Input rule:' || chr(10) || 'rule ' || o_custkey || chr(10) || 'Mapped rule:' || chr(10) || 'R' || chr(10) || chr(10) AS report FROM orders""")
def flat_reports(spark, sf_dir):
    """Mapped rules as text, with their parent if there is one."""
    has = F.col("o_orderstatus") != "P"
    rows = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(has, F.col("o_orderkey").cast("string")).alias("original_input_rule_id"), F.when(has, F.col("o_orderpriority")).alias("original_input_rule"), F.when(has, F.col("o_orderstatus")).alias("section"),
        F.concat(F.lit("rule "), "o_custkey").alias("input_rule"), F.lit("R").alias("rule_reformat"),
    )
    return files.flat_report(rows).select("o_orderkey", "report")


# -- text ------------------------------------------------------------------------------------------------------------
TAGGED_SQL = """SELECT conv_id, string_agg(CASE role WHEN 'assistant' THEN 'EXCLUDE ' ELSE 'INCLUDE ' END || text, chr(10) ORDER BY turn) AS v FROM conversations GROUP BY 1"""
PIECES_SQL = f"""SELECT conv_id, list_filter(list_transform(string_split(regexp_replace(v, '(?m)^(INCLUDE|EXCLUDE)', chr(1) || '\\1', 'g'), chr(1)), lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS pieces FROM ({TAGGED_SQL})"""


def tagged(spark, sf_dir):
    rows = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.when(F.col("role") == "assistant", "EXCLUDE ").otherwise("INCLUDE "), "text").alias("line"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "line"))).alias("rows"))
    return lists.select("conv_id", F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("v"))


@query(f"SELECT conv_id, CAST(i - 1 AS INTEGER) AS pos, pieces[i] AS piece FROM (SELECT conv_id, pieces, unnest(range(1, len(pieces) + 1)) AS i FROM ({PIECES_SQL}))")
def tagged_split(spark, sf_dir):
    """A text cut before each tagged line."""
    return tagged(spark, sf_dir).select("conv_id", F.posexplode(text.tagged_pieces(F.col("v"))).alias("pos", "piece"))


@query(f"SELECT conv_id, CAST((i - 1) // 3 AS INTEGER) AS batch, string_agg(pieces[i], chr(10) ORDER BY i) AS piece FROM (SELECT conv_id, pieces, unnest(range(1, len(pieces) + 1)) AS i FROM ({PIECES_SQL})) GROUP BY 1, 2")
def batch_by_count(spark, sf_dir):
    """T4: three pieces to a batch."""
    return tagged(spark, sf_dir).select("conv_id", F.posexplode(text.batches_by_count(F.col("v"), 3)).alias("batch", "piece"))


@query(f"""WITH RECURSIVE texts AS ({PIECES_SQL}),
words AS (SELECT conv_id, i AS k, pieces[i] AS piece, len(list_filter(regexp_split_to_array(pieces[i], '\\s+'), lambda x: x <> '')) AS n FROM (SELECT conv_id, pieces, unnest(range(1, len(pieces) + 1)) AS i FROM texts)),
filled AS (SELECT conv_id, CAST(0 AS BIGINT) AS k, 0 AS batch, CAST(0 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS piece FROM texts
UNION ALL SELECT f.conv_id, w.k, CASE WHEN f.n + w.n < 120 THEN f.batch ELSE f.batch + 1 END, CASE WHEN f.n + w.n < 120 THEN f.n + w.n ELSE w.n END, w.piece FROM filled f JOIN words w ON w.conv_id = f.conv_id AND w.k = f.k + 1)
SELECT conv_id, CAST(batch AS INTEGER) AS batch, coalesce(string_agg(piece, chr(10) ORDER BY k), '') AS piece FROM filled GROUP BY conv_id, batch""")
def batch_by_words(spark, sf_dir):
    """T5: pieces filled greedily under a number of words."""
    return tagged(spark, sf_dir).select("conv_id", F.posexplode(text.batches_by_words(F.col("v"), 120)).alias("batch", "piece"))


PART = "(l_orderkey * 7 + l_linenumber)"


@query("""WITH parts AS (SELECT l_orderkey, l_returnflag, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag = 'R', l_linenumber, l_returnflag) AS seq FROM lineitem)
SELECT l_orderkey AS doc_id, CAST(seq AS INTEGER) AS seq, CASE WHEN l_returnflag = 'R' THEN 'E-' ELSE 'I-' END || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS statement_id,
CASE WHEN l_returnflag = 'R' THEN 'EXCLUSION' ELSE 'INCLUSION' END AS section, CAST(l_linenumber AS INTEGER) AS number,
CAST(l_linenumber AS VARCHAR) || '. rule ' || l_returnflag || chr(10) || '  - 1. child' AS statement FROM parts""")
def parent_statements(spark, sf_dir):
    """Numbered statements of protocol texts put together from order lines."""
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (F.col("l_returnflag") == "R").alias("out"), "l_linenumber", F.format_string("%d. rule %s\n  - 1. child", "l_linenumber", "l_returnflag").alias("s"))
    lists = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("out", "l_linenumber", "s"))).alias("rows"))
    part = lambda out: F.array_join(F.transform(F.filter("rows", lambda r: r["out"] == out), lambda r: r["s"]), "\n")
    docs = lists.select("doc_id", F.concat(F.lit("1. before any header\nInclusion Criteria:\n"), part(False), F.lit("\n exclusion criteria\n- no number\n"), part(True), F.lit("\n")).alias("text"))
    return text.parent_statements(docs)


@query("""SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text || text ELSE '~' || text END AS body, strpos(trim(text, chr(10) || ' '), chr(10)) > 0 AS many FROM conversations""")
def code_blocks(spark, sf_dir):
    """Bodies of fenced blocks, the text itself without any; texts of more than one line."""
    rows = t(spark, sf_dir, "conversations")
    fenced = F.concat(F.lit("x ```json"), F.col("text"), F.lit("``` y ```json"), F.col("text"), F.lit("```"))
    v = F.when(F.col("role") == "assistant", fenced).otherwise(F.concat(F.lit("~"), "text"))
    return rows.select("conv_id", "turn", text.code_blocks(v, "json").alias("body"), text.many_lines(F.col("text")).alias("many"))


@query("""SELECT c_custkey, replace(c_name, '#', '_') AS trial_id, CASE WHEN c_custkey % 2 = 0 THEN 'a/b/' || replace(c_name, '#', '_') || '_out.json' ELSE replace(c_name, '#', '_') || '.json' END AS path, c_mktsegment AS title FROM customer""")
def trial_ids(spark, sf_dir):
    """Id and title lines of a text, and a path that takes the id."""
    rows = t(spark, sf_dir, "customer")
    v = F.concat(F.lit("Trial Title: "), "c_mktsegment", F.lit("\r\n trial id :  "), F.replace("c_name", F.lit("#"), F.lit("  ")), F.lit(" \nTrial ID: second"))
    id_ = text.document_id(v)
    path = F.when(F.col("c_custkey") % 2 == 0, F.lit("a/b/out.json")).otherwise(F.concat(id_, F.lit(".json")))
    return rows.select("c_custkey", id_.alias("trial_id"), files.prefixed_path(path, id_).alias("path"), text.header_value(v, "Trial Title").alias("title"))


@query("""SELECT event_id, props || '''' || chr(10) || '[x]' AS v FROM events""")
def unescape(spark, sf_dir):
    """Backslash escapes undone."""
    return t(spark, sf_dir, "events").select("event_id", text.unescaped(F.concat(F.replace("props", F.lit('"'), F.lit('\\"')), F.lit("\\'\\n\\[x\\]"))).alias("v"))


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'EXCLUDE ' ELSE 'INCLUDE ' END || 'rule ' || doc_id AS directed, CASE WHEN quality = 0 THEN false ELSE toxic = 1 END AS exclude FROM labels""")
def direction_prefix(spark, sf_dir):
    """Direction prefix and flips."""
    rows = t(spark, sf_dir, "labels")
    out = F.col("toxic") == 1
    return rows.select("doc_id", text.directed(F.concat(F.lit("rule "), "doc_id"), out).alias("directed"), text.exclude_after_flip(out, F.col("quality") == 0).alias("exclude"))


# -- catalogue -------------------------------------------------------------------------------------------------------
CELLS = {
    "a": "CASE WHEN p_size <= 25 THEN upper(replace(p_type, ' ', '_')) END",
    "fa": "CASE p_size % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' yes ' WHEN 2 THEN '' ELSE 'no' END",
    "b": "upper(replace(p_name, ' ', '_'))",
    "fb": "CASE WHEN p_size % 2 = 0 THEN '1' END",
}
LONG_SQL = f"""SELECT p_partkey, 'Kind' AS category, 0 AS k, {CELLS['a']} AS rule, coalesce(lower(trim({CELLS['fa']})) IN ('true', 'yes'), false) AS warn FROM part WHERE {CELLS['a']} IS NOT NULL
UNION ALL SELECT p_partkey, 'Name', 1, {CELLS['b']}, coalesce({CELLS['fb']} = '1', false) FROM part"""


def wide(spark, sf_dir):
    return t(spark, sf_dir, "part").selectExpr("p_partkey AS row_pos", f"{CELLS['a']} AS Kind", f"{CELLS['fa']} AS WARN_IF1", f"{CELLS['b']} AS Name", f"{CELLS['fb']} AS WARN_IF3")


@query(f"SELECT category, CAST(k AS INTEGER) AS category_pos, p_partkey AS row_pos, rule, warn FROM ({LONG_SQL})")
def catalogue_unpivot(spark, sf_dir):
    """A wide catalogue as a long table."""
    return catalogue.long_catalogue(wide(spark, sf_dir))


@query(f"SELECT rule, warn FROM (SELECT rule, warn, row_number() OVER (PARTITION BY rule ORDER BY k, p_partkey) AS n FROM ({LONG_SQL})) WHERE n = 1")
def catalogue_flags(spark, sf_dir):
    """Distinct rules, the flag of each one's first cell."""
    return catalogue.warn_flags(catalogue.long_catalogue(wide(spark, sf_dir)))


@query(f"""WITH known AS (SELECT DISTINCT rule FROM ({LONG_SQL}) WHERE category = 'Kind')
SELECT p_partkey, used AS rule FROM (SELECT p_partkey, upper(replace(CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END, ' ', '_')) AS used FROM part) WHERE used NOT IN (SELECT rule FROM known)""")
def unknown_rules(spark, sf_dir):
    """Used rules that the catalogue's category lacks."""
    used = t(spark, sf_dir, "part").selectExpr("p_partkey", "upper(replace(CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END, ' ', '_')) AS rule")
    return catalogue.unknown_rules(used, catalogue.of_categories(catalogue.long_catalogue(wide(spark, sf_dir)), ["Kind"]))


@query(f"""WITH flags AS (SELECT rule, warn FROM (SELECT rule, warn, row_number() OVER (PARTITION BY rule ORDER BY k, p_partkey) AS n FROM ({LONG_SQL})) WHERE n = 1)
SELECT o.p_partkey, o.rule, coalesce(f.warn, false) AS warn FROM (SELECT p_partkey, upper(replace(p_type, ' ', '_')) AS rule FROM part) o LEFT JOIN flags f ON o.rule = f.rule""")
def warn_lookup(spark, sf_dir):
    """A rule's flag, false for unknown rules."""
    used = t(spark, sf_dir, "part").selectExpr("p_partkey", "upper(replace(p_type, ' ', '_')) AS rule")
    return catalogue.with_warn(used, catalogue.long_catalogue(wide(spark, sf_dir)))


FLAGGED = ("ECONOMY", "PROMO", "SMALL")


@query("""SELECT p_partkey, regexp_replace(v, '\\bNOT(\\s*)\\((\\s*(?:ECONOMY|PROMO|SMALL)\\s*(?:\\[[^\\]]*\\]\\s*)?\\))', 'WARN_IF\\1(\\2', 'g') AS v FROM
(SELECT p_partkey, 'AND(NOT(' || upper(split_part(p_type, ' ', 1)) || '), NOT (' || upper(split_part(p_type, ' ', 1)) || '[1.5, 2]), IS_NOT(PROMO), NOT(OR(SMALL, X)))' AS v FROM part)""")
def warn_rewrite(spark, sf_dir):
    """Negations of flagged rules become warnings."""
    word = F.upper(F.split_part("p_type", F.lit(" "), F.lit(1)))
    v = F.concat(F.lit("AND(NOT("), word, F.lit("), NOT ("), word, F.lit("[1.5, 2]), IS_NOT(PROMO), NOT(OR(SMALL, X)))"))
    return t(spark, sf_dir, "part").select("p_partkey", text.warn_instead_of_not(v, list(FLAGGED)).alias("v"))


# -- trees, JSON, criteria -------------------------------------------------------------------------------------------
TREE = """'{"AND": [{"' || upper(split_part(p_type, ' ', 1)) || '": [' || p_size || '.0, "x"]}, {"NOT": {"' || upper(split_part(p_brand, '#', 1)) || '": []}}, "' || upper(split_part(p_type, ' ', 2)) || '[]"]}'"""


@query("""SELECT p_partkey, 'AND(' || upper(split_part(p_type, ' ', 1)) || '[' || p_size || '.0, ''x''], NOT(' || upper(split_part(p_brand, '#', 1)) || '), ' || upper(split_part(p_type, ' ', 2)) || ')' AS v FROM part""")
def tree_render(spark, sf_dir):
    """A tree on one line, 3.0 kept apart from 3."""
    return t(spark, sf_dir, "part").selectExpr("p_partkey", f"{TREE} AS tree").select("p_partkey", trees.rendered(F.col("tree"))["json"].alias("v"))


@query("""SELECT p_partkey, CASE WHEN upper(split_part(p_brand, '#', 1)) < upper(split_part(p_type, ' ', 2)) THEN upper(split_part(p_brand, '#', 1)) || ',' || upper(split_part(p_type, ' ', 2))
ELSE upper(split_part(p_type, ' ', 2)) || ',' || upper(split_part(p_brand, '#', 1)) END AS names FROM part WHERE upper(split_part(p_type, ' ', 2)) <> upper(split_part(p_brand, '#', 1))""")
def tree_new_rules(spark, sf_dir):
    """Names in a tree that a catalogue of the first type words lacks."""
    rows = t(spark, sf_dir, "part")
    known = rows.select(F.upper(F.split_part("p_type", F.lit(" "), F.lit(1))).alias("rule")).distinct()
    rows = rows.selectExpr("p_partkey", f"{TREE} AS tree")
    out = catalogue.with_new_rules(rows, known, trees.rule_names(F.col("tree")))
    return out.filter(F.size("new_rules") == 2).select("p_partkey", F.array_join("new_rules", ",").alias("names"))


@query("""SELECT p_partkey, p_size % 4 < 3 AS hollow FROM part""")
def tree_hollow(spark, sf_dir):
    """Trees without any rule."""
    v = F.expr("""CASE p_size % 4 WHEN 0 THEN '{"AND": [{"OR": []}, " "]}' WHEN 1 THEN '[{}, {"NOT": null}]' WHEN 2 THEN ' ' ELSE '{"AND": [{"' || p_brand || '": []}]}' END""")
    return t(spark, sf_dir, "part").select("p_partkey", trees.is_hollow(v).alias("hollow"))


@query("""SELECT p_partkey, '{"AND": [{"' || p_brand || '": []}, {"K": [' || p_size || ']}]}' AS tree FROM part""")
def tree_normal(spark, sf_dir):
    """Bare rules and lone parameters in one shape."""
    v = F.expr("""'{"AND": ["' || p_brand || '", {"K": ' || p_size || '}]}'""")
    return t(spark, sf_dir, "part").select("p_partkey", trees.normalised(v).alias("tree"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def record_field(spark, sf_dir):
    """A field of a nested record by its path."""
    v = F.concat(F.lit('{"protocolSection": {"eligibilityModule": {"eligibilityCriteria": '), F.col("props").substr(F.lit(6), F.length("props") - 6), F.lit("}}}"))
    return t(spark, sf_dir, "events").select("event_id", files.criteria_field(v).cast("long").alias("k"))


@query("""SELECT event_id, CASE event_id % 7 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN '{"a": {"K": "' || chr(128512) || user_id || '"}}' WHEN 4 THEN '{"a": {"NOT": {"R": []}}, "s": "1 + 1, { \\"K\\" }"}'
ELSE '{"rule": {"R": [' || (user_id + 2) || ']}, "b": {"NOT": "X"}, "c": "D"}' END AS v FROM events""")
def json_repair(spark, sf_dir):
    """Near-JSON read by the chain of parsers; NaN and half a character are refused, two halves joined."""
    chain = F.concat(F.lit('{"rule": "R": ['), "user_id", F.lit(' + 2], "b": "NOT": "X", "c": { "D" }}'))
    part = F.pmod("event_id", F.lit(7))
    v = F.when(part == 1, '{"a": NaN}').when(part == 2, '{"a": "\\ud83d"}').when(part == 3, F.concat(F.lit('{"a": "K": "\\ud83d\\ude00'), "user_id", F.lit('"}')))
    v = v.when(part == 4, '{"a": "NOT": "R[]", "s": "1 + 1, { \\"K\\" }"}').otherwise(chain)
    return t(spark, sf_dir, "events").select("event_id", lenient.first_parse(v)["json"].alias("v"))


@query("""SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN '{"a": {"K": ' || user_id * 3 || '}, "b": [' || user_id || ', "Z' || chr(128512) || '"]}' END AS v FROM events""")
def json_lenient(spark, sf_dir):
    """Chained keys, arithmetic, a lone key, a missing brace, characters in two halves and half of one."""
    end = F.when(F.col("event_id") % 5 == 0, ', {"Z\\ud83d"}]} rest').otherwise(', {"Z\\ud83d\\ude00"}]} rest')
    v = F.concat(F.lit('{"a": "K": '), "user_id", F.lit('*3, "b": ['), "user_id", end)
    return t(spark, sf_dir, "events").select("event_id", lenient.lenient_json(v)["json"].alias("v"))


@query("""SELECT event_id, '{"x": ' || (user_id + 5) || ', "y": [' || (event_id % 100 * 2) || ', "1+1 "]}' AS v FROM events""")
def arithmetic(spark, sf_dir):
    """P5: unquoted arithmetic by its value."""
    v = F.concat(F.lit('{"x": '), "user_id", F.lit(' + 5, "y": ['), (F.col("event_id") % 100).cast("string"), F.lit(' * 2, "1+1 "]}'))
    return t(spark, sf_dir, "events").select("event_id", lenient.arithmetic_folded(v).alias("v"))


CRITERION = """'And { Age(age=' || p_size || ', operator=">="), Not { Infection(infection="' || p_brand || '", status=null) }, If { Sex(sex="male") } then { Other } else { Timing(window_days=IntRange(min_inclusive=-' || p_size || ')) { Other(reason="' || p_type || '") } } }'"""


@query("""SELECT p_partkey, CAST(p_size AS BIGINT) AS age, p_brand AS infection, p_type AS reason, CAST(-p_size AS BIGINT) AS days, 1 AS n_and, 1 AS n_age, 1 AS n_other, 1 AS n_timing, true AS same, p_partkey % 4 = 0 AS failed FROM part""")
def criterion_trees(spark, sf_dir):
    """Criteria read, written, read again and counted; a bad one keeps its error."""
    rows = t(spark, sf_dir, "part").selectExpr("p_partkey", f"{CRITERION} AS code").withColumn("first", criteria.analysed(F.col("code")))
    bad = criteria.parsed(F.when(F.col("p_partkey") % 4 == 0, F.replace("code", F.lit("Age("), F.lit("Aged("))))
    rows = rows.select("p_partkey", F.col("first.json").alias("node"), "first.types", criteria.parsed(F.col("first.code"))["json"].alias("again"), bad.alias("bad"))
    at = lambda path: F.get_json_object("node", path)
    rows = nesting.type_counts(rows, F.col("types"))
    return rows.select(
        "p_partkey",
        at("$.criteria[0].age").cast("long").alias("age"),
        at("$.criteria[1].criterion.infection").alias("infection"),
        at("$.criteria[2].else.criterion.reason").alias("reason"),
        at("$.criteria[2].else.window_days.min_inclusive").cast("long").alias("days"),
        *(F.col(n).alias(f"n_{n.lower()}") for n in ("And", "Age", "Other", "Timing")),
        (trees.without_field(F.col("again"), "description") == trees.without_field(F.col("node"), "description")).alias("same"),
        F.col("bad.error").isNotNull().alias("failed"),
    )


ONCE = ("And", "Age", "Not", "Infection", "If", "Sex", "Other", "Timing")
LLM_CODE = r"""'And(description="")\n{\n    Age(description="",\n        age=' || p_size || ',\n        operator=">="),\n    Not(description="")\n    {\n        Infection(description="",\n            infection="' || p_brand || '")\n    },\n    If(description="")\n    {\n        Sex(description="",\n            sex="male")\n    }\n    then {\n        Other(description="")\n    }\n    else {\n        Timing(description="",\n            window_days=IntRange(min_inclusive=-' || p_size || '))\n        {\n            Other(description="",\n                reason="' || p_type || '")\n        }\n    }\n}'"""


@query(f"""SELECT CAST(p_size AS VARCHAR) AS "TrialId", p_brand AS "Cohort", CAST(k AS INTEGER) AS "RuleNum", p_size || '.' || k AS "RuleId", '' AS "Description",
{", ".join(f'{int(n in ONCE)} AS "{n}"' for n in criteria.NODES)}, replace({LLM_CODE}, '\\n', chr(10)) AS "LlmCode"
FROM (SELECT *, row_number() OVER (PARTITION BY p_size, p_brand ORDER BY p_partkey) AS k FROM part)""")
def review_table(spark, sf_dir):
    """The whole review table of typed criteria, a column for each node type."""
    rows = t(spark, sf_dir, "part").selectExpr("cast(p_size as string) AS TrialId", "p_brand AS Cohort", "p_partkey AS pos", f"{CRITERION} AS code")
    out = curation.tabulated(rows.withColumn("node", criteria.parsed(F.col("code"))["json"]))
    return out.select("TrialId", "Cohort", "RuleNum", "RuleId", "Description", *criteria.NODES, "LlmCode")


@query("""SELECT event_id, props || chr(92) || '"' || chr(10) AS reason, 'OtherCriterion(' || chr(10) || '    description = "",' || chr(10) || '    reason = "' || user_id || '"' || chr(10) || ')' AS python, CASE WHEN event_id % 3 <> 0 THEN chr(128512) || user_id END AS face FROM events""")
def criterion_escapes(spark, sf_dir):
    """Quotes, backslashes and line ends survive writing and reading; the form for people."""
    rows = t(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.lit("Other").alias("type"), F.lit("").alias("description"), F.concat("props", F.lit('\\"\n')).alias("reason"))).alias("node"), F.to_json(F.struct(F.lit("Other").alias("type"), F.lit("").alias("description"), F.col("user_id").cast("string").alias("reason"))).alias("plain"))
    again = criteria.parsed(criteria.written(F.col("node")))["json"]
    halves = F.concat(F.lit('Other(reason="\\ud83d'), F.when(F.col("event_id") % 3 == 0, "").otherwise("\\ude00"), F.get_json_object("plain", "$.reason"), F.lit('")'))
    face = F.get_json_object(criteria.parsed(halves)["json"], "$.reason")
    return rows.select("event_id", F.get_json_object(again, "$.reason").alias("reason"), criteria.python_text(F.col("plain")).alias("python"), face.alias("face"))


TYPED = """CASE p_partkey % 10 WHEN 0 THEN 'Age(age=' || p_size || ', operator=">=")' WHEN 1 THEN 'Age(age="abc", operator=">=")' WHEN 2 THEN 'Age(age=1.5, operator=">=")'
WHEN 3 THEN 'TreatmentOption(treatment=Medication())' WHEN 4 THEN 'TreatmentOption(treatment=Medication(medications=["' || p_brand || '"]))' WHEN 5 THEN 'PriorTreatment(treatment="' || p_brand || '")'
WHEN 6 THEN 'Metastases(location=[1])' WHEN 7 THEN 'TreatmentOption(treatment=Surgery(treatment="x"))' WHEN 8 THEN 'LabValue(measurement="m", unit="u", value=' || p_size || ', operator="near")' ELSE 'Other(description=null)' END"""


@query("""SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN '{"type": "Age", "description": "", "age": ' || p_size || ', "operator": ">="}'
WHEN 4 THEN '{"type": "TreatmentOption", "description": "", "treatment": {"type": "Medication", "medications": ["' || p_brand || '"]}}'
WHEN 8 THEN '{"type": "LabValue", "description": "", "measurement": "m", "unit": "u", "value": ' || p_size || '.0, "operator": "near"}' END AS node,
CASE p_partkey % 10 WHEN 1 THEN 'age of Age cannot be "abc"' WHEN 2 THEN 'age of Age cannot be 1.5' WHEN 3 THEN 'Medication needs medications' WHEN 5 THEN 'treatment of PriorTreatment cannot be "' || p_brand || '"'
WHEN 6 THEN 'location of Metastases cannot be [1]' WHEN 7 THEN 'Surgery has no treatment' WHEN 9 THEN 'Other needs description' END AS error FROM part""")
def criterion_types(spark, sf_dir):
    """Fields and their types are checked; what is refused keeps its error."""
    got = criteria.parsed(F.col("code"))
    rows = t(spark, sf_dir, "part").selectExpr("p_partkey", f"{TYPED} AS code").withColumn("got", got)
    return rows.select("p_partkey", F.col("got.json").alias("node"), F.nullif(F.regexp_extract("got.error", r"column \d+: (.*)", 1), F.lit("")).alias("error"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN '"a' || '\\' || 'n' || user_id || '"' WHEN 4 THEN '{"k": 1}' END AS v,
CASE event_id % 5 WHEN 1 THEN 'line 2, column 10: expected a colon' WHEN 2 THEN 'line 1, column 2: expected a key' WHEN 3 THEN 'deep' END AS error,
event_id % 5 NOT IN (0, 4) AS no_names, event_id % 5 = 4 AS named FROM events""")
def malformed_json(spark, sf_dir):
    """Escaped line ends, two lone keys, wrong and very deep JSON: errors are values, in trees too."""
    v = F.expr("""CASE event_id % 5 WHEN 0 THEN concat('"a\\\\', chr(10), user_id, '"') WHEN 1 THEN concat('{"A",', chr(10), '      "B"', '}') WHEN 2 THEN '{a: 1}' WHEN 3 THEN repeat('[', 20000) ELSE '{"k": 1}' END""")
    rows = t(spark, sf_dir, "events").select("event_id", v.alias("v")).withColumn("got", lenient.lenient_json(F.col("v")))
    error = F.when(F.col("event_id") % 5 == 3, F.when(F.col("got.error").isNotNull(), "deep")).otherwise(F.nullif(F.regexp_extract("got.error", r"^(line \d+, column \d+: [^\n]*)\n[^^]*\^$", 1), F.lit("")))
    names = trees.rule_names(F.when(F.col("event_id") % 5 == 0, F.lit('"x"')).otherwise(F.col("v")))
    return rows.select("event_id", F.col("got.json").alias("v"), error.alias("error"), names.isNull().alias("no_names"), (F.coalesce(F.element_at(names, 1), F.lit("")) == "k").alias("named"))


# -- joins and nesting -----------------------------------------------------------------------------------------------
@query("""SELECT o_orderkey, coalesce(string_agg(l_linenumber || ':' || l_quantity, ',' ORDER BY l_linenumber, l_linenumber || ':' || l_quantity), '') AS children, count(l_linenumber) AS n
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def group_children(spark, sf_dir):
    """Children under their parents, parents without any kept."""
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("seq"), F.concat_ws(":", "l_linenumber", "l_quantity").alias("line"))
    out = nesting.grouped(t(spark, sf_dir, "orders").select("o_orderkey"), rows, "o_orderkey", "seq")
    return out.select("o_orderkey", F.array_join(F.transform("curations", lambda c: c["line"]), ",").alias("children"), F.size("curations").cast("long").alias("n"))


@query("SELECT o_orderkey, o_orderstatus, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def flatten_children(spark, sf_dir):
    """Children with their parents' columns."""
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("seq"), "l_partkey")
    grouped = nesting.grouped(t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), rows, "o_orderkey", "seq")
    return nesting.flattened(grouped, ["o_orderkey", "o_orderstatus"])


@query("""SELECT c.own, o.o_orderkey FROM (SELECT c_custkey AS own, nullif(c_custkey, 5) AS k FROM customer WHERE c_nationkey <> 3) c
RIGHT JOIN (SELECT o_orderkey, nullif(o_custkey, 7) AS k FROM orders) o ON c.k IS NOT DISTINCT FROM o.k""")
def right_merge_nullsafe(spark, sf_dir):
    """Every mapped row with its curated rows, null meeting null."""
    curated = t(spark, sf_dir, "customer").filter("c_nationkey <> 3").selectExpr("c_custkey AS own", "nullif(c_custkey, 5) AS k")
    mapped = t(spark, sf_dir, "orders").selectExpr("o_orderkey", "nullif(o_custkey, 7) AS k")
    return nesting.merged(curated, mapped, "k").select("own", "o_orderkey")


@query("""SELECT user_id AS key, last_type, n FROM (SELECT user_id, event_type AS last_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE k = 1""")
def last_duplicate_wins(spark, sf_dir):
    """The last of repeated keys in a lookup."""
    events = t(spark, sf_dir, "events").withColumn("last_type", F.col("event_type"))
    n = events.groupBy("user_id").agg(F.count("*").alias("n"))
    return n.join(nesting.last_wins(events, "user_id", "last_type", "event_id"), "user_id").withColumnRenamed("user_id", "key")


@query("""SELECT c_custkey AS id, c_name AS name, NULL AS size FROM customer UNION ALL SELECT p_partkey, NULL, p_size FROM part""")
def union_by_name(spark, sf_dir):
    """Frames with different columns as one."""
    a = t(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    b = t(spark, sf_dir, "part").selectExpr("p_size AS size", "p_partkey AS id")
    return nesting.stacked([a, b])


@query("""SELECT CAST(o_custkey AS VARCHAR) AS trial, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS RuleNum,
o_custkey || '.' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS RuleId FROM orders""")
def rule_numbers(spark, sf_dir):
    """Numbers and ids of rules within a trial."""
    rows = t(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("trial"), "o_orderkey")
    return nesting.numbered(rows, ["trial"], "o_orderkey", "trial")


@query("""SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'view') AS "view", count(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1""")
def type_count_table(spark, sf_dir):
    """A1, A2: one column per type, a fixed list of them."""
    lists = t(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list("event_type").alias("types"))
    out = nesting.type_counts(lists, F.col("types"), ("click", "view", "purchase"))
    return out.select("user_id", *(F.col(n).cast("long").alias(n) for n in ("click", "view", "purchase")))


@query("""WITH lines AS (SELECT l_orderkey, l_returnflag || l_linestatus AS input, 'R' || l_partkey AS mapped, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag || l_linestatus, 'R' || l_partkey) AS k FROM lineitem)
SELECT o_orderkey, '=== Parent statement [' || o_orderkey || '] ===' || chr(10) || 'Section: ' || o_orderstatus || chr(10) || o_orderpriority || chr(10) ||
coalesce(string_agg('  --- Child rule #' || k || ' ---' || chr(10) || '  Input rule: ' || input || chr(10) || '  Mapped rule: ' || mapped || chr(10), chr(10) ORDER BY k),
'  (No curated rules for this statement.)' || chr(10)) AS report FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus, o_orderpriority""")
def grouped_report(spark, sf_dir):
    """Parents with their child rules as text."""
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("seq"), F.concat("l_returnflag", "l_linestatus").alias("input_rule"), F.concat(F.lit("R"), "l_partkey").alias("rule_reformat"))
    parents = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("original_input_rule_id"), F.col("o_orderstatus").alias("section"), F.col("o_orderpriority").alias("original_input_rule"))
    return files.grouped_report(nesting.grouped(parents, rows, "o_orderkey", "seq")).select("o_orderkey", "report")


@query("""SELECT event_id, 'criterion' || chr(9) || 'I-' || event_id || chr(9) || 'a' || '\\' || 't' || event_type || chr(9) || user_id || chr(9) || replace(props, '"', 'q') AS line FROM events""")
def criterion_lines(spark, sf_dir):
    """Rows of the reformatted table, as wide as there are parts."""
    line = files.criterion_line(F.concat(F.lit("I-"), "event_id"), F.concat(F.lit("a\t"), "event_type"), F.array(F.col("user_id").cast("string"), F.replace("props", F.lit('"'), F.lit("q"))))
    return t(spark, sf_dir, "events").select("event_id", line.alias("line"))


@query("""SELECT user_id FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_type IN ('purchase', 'refund')) > 0""")
def lists_with_any(spark, sf_dir):
    """Rows whose list has any of the wanted values."""
    lists = t(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))
    return nesting.with_any(lists, "types", ["purchase", "refund"]).select("user_id")


@query("""SELECT string_agg(DISTINCT c, ',' ORDER BY c) AS categories FROM (SELECT event_type AS c FROM events UNION ALL SELECT 'always')""")
def category_union(spark, sf_dir):
    """The categories of all rows and those that always apply."""
    lists = t(spark, sf_dir, "events").select(F.array("event_type").alias("c"))
    return nesting.category_union(lists, "c", ["always"]).select(F.array_join("categories", ",").alias("categories"))


# -- comparison ------------------------------------------------------------------------------------------------------
def sides(spark, sf_dir):
    rows = t(spark, sf_dir, "embeddings").select(F.col("label").alias("cohort"), F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"), F.concat(F.lit("text "), "vec_id").alias("text"))
    return rows.filter("pos % 2 = 0"), rows.filter("pos % 2 = 1")


PAIRS_SQL = """SELECT a.label AS cohort, a.vec_id AS i, b.vec_id AS j, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1"""


@query(f"SELECT * FROM ({PAIRS_SQL}) WHERE similarity > 0.3")
def cosine_pairs(spark, sf_dir):
    """Similar pairs of two sides within a cohort."""
    return compare.similar_pairs(*sides(spark, sf_dir), "cohort", 0.3, digits=6)


MATCH_SQL = f"""WITH RECURSIVE scored AS (SELECT cohort, i, j, round(similarity, 9) AS similarity FROM ({PAIRS_SQL.replace(", 6) AS", ", 9) AS")}) WHERE similarity > 0.2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cohort ORDER BY similarity DESC, i, j) AS k FROM scored),
tried AS (SELECT DISTINCT cohort, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS us, CAST([] AS BIGINT[]) AS vs, false AS hit, CAST(NULL AS BIGINT) AS i, CAST(NULL AS BIGINT) AS j, CAST(NULL AS DOUBLE) AS similarity FROM ranked
UNION ALL SELECT cohort, k, CASE WHEN free THEN list_append(us, i) ELSE us END, CASE WHEN free THEN list_append(vs, j) ELSE vs END, free, i, j, similarity
FROM (SELECT t.cohort, r.k, t.us, t.vs, NOT list_contains(t.us, r.i) AND NOT list_contains(t.vs, r.j) AS free, r.i, r.j, r.similarity FROM tried t JOIN ranked r ON r.cohort = t.cohort AND r.k = t.k + 1)),
matches AS (SELECT cohort, i, j, similarity FROM tried WHERE hit)"""
DIFF_SQL = f"""{MATCH_SQL},
olds AS (SELECT e.label AS cohort, e.vec_id AS i, 'text ' || e.vec_id AS old_text, m.j, m.similarity FROM embeddings e LEFT JOIN matches m ON e.label = m.cohort AND e.vec_id = m.i WHERE e.vec_id % 2 = 0),
news AS (SELECT e.label AS cohort, e.vec_id AS j, 'text ' || e.vec_id AS new_text, m.i FROM embeddings e LEFT JOIN matches m ON e.label = m.cohort AND e.vec_id = m.j WHERE e.vec_id % 2 = 1),
slots AS (SELECT o.cohort, coalesce(sum(CASE WHEN o.j IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY o.cohort ORDER BY o.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS slot, CASE WHEN o.j IS NULL THEN 0 ELSE 2 END AS kind, o.i AS spot, o.i AS old_pos, o.old_text, o.j AS new_pos, n.new_text, o.similarity
FROM olds o LEFT JOIN news n ON n.cohort = o.cohort AND n.j = o.j
UNION ALL SELECT * FROM (SELECT cohort, coalesce(sum(CASE WHEN i IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY cohort ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 1 AS kind, j, CASE WHEN i IS NOT NULL THEN i END AS old, NULL, j, new_text, NULL FROM news) WHERE old IS NULL),
placed AS (SELECT cohort, CAST(row_number() OVER (PARTITION BY cohort ORDER BY slot, kind, spot) AS INTEGER) AS place, old_pos, old_text, new_pos, new_text, similarity FROM slots)"""


@query(f"""SELECT * FROM ({PAIRS_SQL}) WHERE similarity > 0.3 AND i % 7 <> 0 AND j % 7 <> 0""")
def embedded_pairs(spark, sf_dir):
    """Texts with vectors from a cache; empty texts match nothing."""
    cache = t(spark, sf_dir, "embeddings").select(F.sha2(F.concat(F.lit("text "), "vec_id").cast("binary"), 256).alias("text_sha"), F.col("embedding").cast("array<double>").alias("vector"))
    text_ = F.when(F.col("pos") % 7 == 0, "").otherwise(F.col("text"))
    old, new = (models.embedded(side.drop("vector").withColumn("text", text_), cache, F.col("text")) for side in sides(spark, sf_dir))
    return compare.similar_pairs(old, new, "cohort", 0.3, digits=6)


@query(f"{MATCH_SQL} SELECT * FROM matches")
def greedy_match(spark, sf_dir):
    """Greedy one-to-one matches, by a sequential pass in the SQL."""
    return compare.matched(*sides(spark, sf_dir), "cohort", 0.2)


@query(f"{DIFF_SQL} SELECT * FROM placed")
def ordered_diff(spark, sf_dir):
    """Both sides in one order."""
    old, new = sides(spark, sf_dir)
    matches = compare.matched(old, new, "cohort", 0.2)
    return compare.ordered_diff(old, new, matches, "cohort")


@query(f"""{DIFF_SQL} SELECT cohort, string_agg(place || '. ' || CASE WHEN new_text IS NULL THEN 'Removed' || chr(10) || '- ' || old_text WHEN old_text IS NULL THEN 'Added' || chr(10) || '+ ' || new_text
WHEN similarity >= 0.999 THEN 'matched (' || printf('%.1f', 100 * similarity) || '%)' || chr(10) || '  ' || new_text
ELSE 'Modified (' || printf('%.1f', 100 * similarity) || '%)' || chr(10) || '- ' || old_text || chr(10) || '+ ' || new_text END, chr(10) ORDER BY place) AS report FROM placed GROUP BY cohort""")
def diff_report(spark, sf_dir):
    """The difference as text."""
    return compare.diff_report(ordered_diff(spark, sf_dir), "cohort")


@query()
def text_distance(spark, sf_dir):
    """Indel ratio and character difference of neighbouring turns."""
    rows = t(spark, sf_dir, "conversations")
    a = rows.select("conv_id", "turn", F.col("text").alias("a"))
    b = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    return a.join(b, ["conv_id", "turn"]).select("conv_id", "turn", compare.indel_ratio(F.col("a"), F.col("b")).alias("ratio"), F.array_join(compare.character_diff(F.col("a"), F.col("b")), "\n").alias("difference"))


# -- workflows -------------------------------------------------------------------------------------------------------
def answers(rows: DataFrame, stage: str, user: Column, response: Column) -> DataFrame:
    """A cache of answers to a stage's prompts, made from the rows that will ask them."""
    return rows.select(models.prompt_key("m", F.lit(stage), user).alias("prompt_sha"), response.alias("response"))


def listed(*texts: str) -> Column:
    return F.expr(" || ".join(texts))


@query("""SELECT conv_id, CAST(k AS INTEGER) AS rule_seq, 'rule ' || turn || CASE k WHEN 0 THEN ' a' ELSE ' b' END AS input_rule, k = 1 AND turn % 2 = 0 AS exclude, turn FROM conversations, (SELECT unnest(range(0, 2)) AS k)""")
def replayed_rules(spark, sf_dir):
    """Answers replayed from a cache by prompt digest, read as atomic rules, flips applied."""
    rows = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("conv_id", F.lit("/"), "turn").alias("user"))
    answer = F.concat(F.lit('```json[{"input_rule": "rule '), "turn", F.lit(' a", "exclude": false}, {"input_rule": "rule '), "turn", F.lit(' b", "exclude": true, "flipped": '), (F.col("turn") % 2 == 1).cast("string"), F.lit("}]```"))
    got = models.Asker(answers(rows, "s", F.col("user"), answer)).ask(rows, "s", F.col("user"))
    return curation.atomic_rules(got, ["conv_id", "turn"]).select("conv_id", "rule_seq", "input_rule", "exclude", "turn")


@query("""WITH raw AS (SELECT c_custkey, c_custkey % 5 AS k, c_mktsegment AS seg FROM customer),
rules AS (
SELECT c_custkey, 0 AS spot, 'age over ' || k AS input_rule, false AS exclude, false AS flipped, NULL AS cohorts, NULL AS error, k FROM raw WHERE k <> 4
UNION ALL SELECT c_custkey, 1, 'no ' || seg, k <> 1, k = 1, 'c1', CASE WHEN k = 2 THEN 'flip: no list of rules' END, k FROM raw WHERE k <> 4
UNION ALL SELECT c_custkey, 2, CASE WHEN k = 3 THEN 'any of:' || chr(10) || '- p' || chr(10) || '- q' ELSE 'p ' || c_custkey END, false, false, NULL, CASE WHEN k = 3 THEN 'promote: no list of texts' END, k FROM raw WHERE k <> 4
UNION ALL SELECT c_custkey, 3, 'q', false, false, NULL, NULL, k FROM raw WHERE k NOT IN (3, 4)
UNION ALL SELECT c_custkey, 0, 'text ' || c_custkey, false, false, NULL, 'tag: no list of rules', k FROM raw WHERE k = 4)
SELECT c_custkey, CAST(spot AS INTEGER) AS rule_seq, input_rule, exclude, flipped, cohorts, error FROM rules""")
def prepared_rules(spark, sf_dir):
    """Texts sanitised, tagged, sub-points promoted, exclusions turned; what a stage cannot read
    stays as it was, with an error."""
    rows = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", (F.col("c_custkey") % 5).alias("k"), F.concat(F.lit("text "), "c_custkey").alias("text"))
    tagged = listed("""'[{"input_rule": "age over ' || k || '", "exclude": false}, {"input_rule": "' || c_mktsegment || ' ' || c_custkey || '", "exclude": true, "cohorts": ["c1"]}, '""", """'{"input_rule": "any of:\\\\n- p' || CASE WHEN k = 3 THEN '' ELSE ' ' || c_custkey END || '\\\\n- q", "exclude": false}]'""")
    many = listed("'any of:\\n- p' || CASE WHEN k = 3 THEN '' ELSE ' ' || c_custkey END || '\\n- q'")
    turned = listed("""'[{"input_rule": "no ' || c_mktsegment || '", "exclude": true, "flipped": ' || CASE WHEN k = 1 THEN 'true' ELSE 'false' END || '}]'""")
    cache = (
        answers(rows, "sanitise", F.col("text"), F.concat(F.lit("```text\n"), "text", F.lit("\n```")))
        .unionAll(answers(rows, "tag", F.col("text"), F.when(F.col("k") == 4, "none").otherwise(F.concat(F.lit("```json"), tagged, F.lit("```")))))
        .unionAll(answers(rows, "promote", many, F.when(F.col("k") == 3, F.lit('{"x": 1}')).otherwise(listed("""'["p ' || c_custkey || '", "q"]'"""))))
        .unionAll(answers(rows, "flip", F.concat_ws(" ", "c_mktsegment", "c_custkey"), F.when(F.col("k") == 2, "none").otherwise(turned)))
    )
    out = curation.prepared(rows.select("c_custkey", "text"), ["c_custkey"], models.Asker(checkpointed(cache)))
    rule = F.when(F.try_element_at("errors", F.lit(-1)) == "flip: no list of rules", F.concat(F.lit("no "), F.split_part("input_rule", F.lit(" "), F.lit(1)))).otherwise(F.col("input_rule"))
    return out.select("c_custkey", "rule_seq", rule.alias("input_rule"), "exclude", "flipped", F.array_join("cohorts", ",").alias("cohorts"), F.try_element_at("errors", F.lit(-1)).alias("error"))


@query("""WITH kinds AS (SELECT p_partkey, p_partkey % 8 AS k, p_size, upper(split_part(p_type, ' ', 1)) AS word FROM part)
SELECT p_partkey, CASE WHEN k = 7 THEN 'none' WHEN k NOT IN (0, 1) THEN 'kind' END AS category,
CASE k WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'AND(NEW_RULE, NOT(PROMO))' WHEN 4 THEN '' WHEN 7 THEN '' ELSE 'AND(ECONOMY[' || p_size || '.0], ' || CASE WHEN word IN ('PROMO', 'SMALL') THEN 'WARN_IF(' ELSE 'NOT(' END || word || '))' END AS rule_reformat,
CASE WHEN k = 3 THEN 'NEW_RULE' ELSE '' END AS new_rules, CASE WHEN k <> 6 THEN 0.5 END AS confidence,
CASE k WHEN 0 THEN 'category: not a list of one object' WHEN 1 THEN 'category: the rule was changed' WHEN 4 THEN 'mapping: no rule in the answer' WHEN 6 THEN 'confidence: not a list of one object' WHEN 7 THEN 'mapping: no category none' ELSE '' END AS errors FROM kinds""")
def mapping_workflow(spark, sf_dir):
    """Category, mapping with the catalogue's rules of the category, hollow trees
    blanked, rendering, new rules, warnings and confidence, each with its guard; answers that no parser reads are repaired
    first."""
    rows = t(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 8).alias("k"), "p_size", F.upper(F.split_part("p_type", F.lit(" "), F.lit(1))).alias("word"), F.concat(F.lit("rule about part "), "p_partkey").alias("input_rule"))
    words = rows.select(F.col("word").alias("rule")).distinct().unionByName(rows.select(F.explode(F.array(F.lit("ECONOMY"), F.lit("PROMO"))).alias("rule")).distinct()).distinct()
    known = words.select(F.lit("kind").alias("category"), F.lit(0).alias("category_pos"), F.lit(0).alias("row_pos"), "rule", F.col("rule").isin("PROMO", "SMALL").alias("warn"))
    hints = {"kind": "Kinds are capitals."}
    filed = listed("""CASE k WHEN 0 THEN '[{"a": ["kind"]}, {"b": ["kind"]}]' WHEN 1 THEN '[{"quite another text": ["kind"]}]' WHEN 5 THEN '<<' || input_rule WHEN 7 THEN '[{"' || input_rule || '": ["none"]}]' ELSE '[{"' || input_rule || '": ["kind"]}]' END""")
    good = listed("""'{"input_rule": "m", "rule_tree": {"AND": [{"ECONOMY": [' || p_size || '.0]}, {"NOT": {"' || word || '": []}}]}}'""")
    trees_ = F.when(F.col("k") == 2, '[{"input_rule": "m", "rule_tree": {"AND": [{"OR": []}]}}]').when(F.col("k") == 3, '[{"input_rule": "m", "rule_tree": {"X": []}}, {"input_rule": "n", "rule_tree": {"AND": [{"NEW_RULE": []}, {"NOT": {"PROMO": []}}]}}]').when(F.col("k") == 4, "[]").when(F.col("k") == 5, good).otherwise(F.concat(F.lit("["), good, F.lit("]")))
    offered = catalogue.with_offers(rows, known, F.array(F.lit("kind")), hints, "offers")
    cache = (
        answers(rows, "category", F.col("input_rule"), filed)
        .unionAll(answers(rows, "repair", F.concat(F.lit("<<"), "input_rule"), listed("""'```json[{"' || input_rule || '": ["kind"]}]```'""")))
        .unionAll(answers(offered, "mapping", curation.mapping_prompt(F.col("input_rule"), F.col("offers")), trees_))
    )
    found = curation.mapping_workflow(rows, known, models.Asker(cache), confidence=False, hints=hints)
    found = checkpointed(found)
    sure = answers(found, "confidence", F.concat_ws("\n", "input_rule", "rule_reformat"), F.when(F.col("k") == 6, "[]").otherwise('[{"confidence_level": 0.5, "confidence_explanation": "e"}]'))
    out = curation.confident(found, models.Asker(sure))
    return out.select("p_partkey", F.try_element_at("categories", F.lit(1)).alias("category"), "rule_reformat", F.array_join("new_rules", ",").alias("new_rules"), F.col("confidence_level").alias("confidence"), F.array_join("errors", "; ").alias("errors"))


@query("""WITH cells AS (SELECT DISTINCT p_brand, p_size, p_type FROM part),
lists AS (SELECT p_brand, string_agg(p_type, chr(10) ORDER BY p_size, p_type) AS rules FROM cells GROUP BY p_brand),
asked AS (SELECT p_partkey, p_brand, 'Brand#' || (p_partkey % 70) AS other FROM part)
SELECT p_partkey, CASE WHEN o.p_brand IS NOT NULL THEN sha256('rule ' || p_partkey || chr(10) || '# ' || a.other || CASE WHEN a.other = 'Brand#11' THEN chr(10) || 'Mind the first.' ELSE '' END || chr(10) || o.rules
|| chr(10) || '# ' || a.p_brand || CASE WHEN a.p_brand = 'Brand#11' THEN chr(10) || 'Mind the first.' ELSE '' END || chr(10) || l.rules) END AS prompt_sha
FROM asked a JOIN lists l ON l.p_brand = a.p_brand LEFT JOIN lists o ON o.p_brand = a.other""")
def catalogue_prompts(spark, sf_dir):
    """Mapping prompts with the catalogue's rules and hints of a row's categories, in the order of the answer; a
    category that the catalogue lacks gives no prompt."""
    part = t(spark, sf_dir, "part")
    known = part.select(F.col("p_brand").alias("category"), F.lit(0).alias("category_pos"), F.col("p_size").alias("row_pos"), F.col("p_type").alias("rule"), F.lit(False).alias("warn")).distinct()
    rows = part.select("p_partkey", F.array(F.concat(F.lit("Brand#"), F.col("p_partkey") % 70), "p_brand").alias("categories"))
    rows = catalogue.with_offers(rows, known, F.col("categories"), {"Brand#11": "Mind the first."}, "offers")
    prompt = curation.mapping_prompt(F.concat(F.lit("rule "), "p_partkey"), F.col("offers"))
    return rows.select("p_partkey", F.when(~F.exists("offers", lambda o: o["rules"].isNull()), F.sha2(prompt, 256)).alias("prompt_sha"))


def help_text(*types: str) -> str:
    """What a prompt says about the language for a rule of some types, as plain text for the SQL."""
    kinds = [t.lower() for t in (*types, "And", "Or", "Not", "If")]
    nodes = [n for n in criteria.NODES if any(k in n.lower() for k in kinds)]
    values = [v for v in criteria.VALUES if any(v in criteria.REACHED[n] for n in nodes)]
    tables = criteria.NODES | criteria.VALUES
    return "\n".join([criteria.help_line("All", criteria.COMMON), *(criteria.help_line(n, tables[n]) for n in [*values, *nodes])])


@query(f"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '{help_text("labv")}' WHEN 1 THEN '{help_text("CURRENTTREAT")}' WHEN 2 THEN '{help_text()}' ELSE '{help_text("Performance")}' END || chr(10)
|| 'rule ' || p_partkey || chr(10) || CASE p_partkey % 4 WHEN 0 THEN 'labv' WHEN 1 THEN 'CURRENTTREAT' WHEN 3 THEN 'Performance' ELSE '' END || CASE WHEN p_size > 25 THEN chr(10) || 'mind ' || p_size ELSE '' END AS prompt FROM part""")
def curate_prompts(spark, sf_dir):
    """The language's types that a row's types call for, with the value types that these reach, and a user's
    instructions, in the prompt."""
    kinds = F.expr("CASE p_partkey % 4 WHEN 0 THEN array('labv') WHEN 1 THEN array('CURRENTTREAT') WHEN 3 THEN array('Performance') ELSE array() END").cast("array<string>")
    more = F.when(F.col("p_size") > 25, F.concat(F.lit("mind "), "p_size"))
    return t(spark, sf_dir, "part").select("p_partkey", curation.curate_prompt(F.concat(F.lit("rule "), "p_partkey"), kinds, more).alias("prompt"))


def recurating(system: str, user: str) -> str:
    """A client that answers by a rule's size: good code, code that does not parse, no code, or nothing in time."""
    import time

    size = int(user.rpartition("size ")[2].split("\n")[0])
    if size == 7:
        time.sleep(30)
    if size == 8:
        raise RuntimeError("busy")
    return ["```python\nAge(age=%d, operator=\">=\")\n```" % size, "```python\nAge(age=\"x\", operator=\">=\")\n```", "```python\nimport x\n```"][size % 3]


@query("""SELECT p_partkey, 'old ' || p_partkey AS code, CASE WHEN p_size % 3 = 0 THEN p_size END AS age,
CASE WHEN p_size = 7 THEN 'the model took too long' WHEN p_size = 8 THEN 'failed: busy' WHEN p_size % 3 = 1 THEN 'age of Age cannot be "x"' WHEN p_size % 3 = 2 THEN 'empty code' END AS error FROM part""")
def recurate(spark, sf_dir):
    """Rules asked about again with instructions and a deadline: answered, refused, failed and late; the old code is
    kept, and each prompt is asked once however many rows have it."""
    rows = t(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("size "), "p_size").alias("rule_text"), F.array(F.lit("Age")).alias("types"), F.concat(F.lit("old "), "p_partkey").alias("LlmCode"))
    none = spark.createDataFrame([], "prompt_sha string, response string")
    out = curation.recurated(rows, models.Asker(none, client=recurating, store=fresh_dir(spark, "answers"), seconds=1.0), "be exact")
    error = F.when(F.col("Error").startswith("line "), F.regexp_extract("Error", r"column \d+: ([^\n]*)", 1)).otherwise(F.col("Error"))
    return out.select("p_partkey", F.col("LlmCode").alias("code"), F.regexp_extract("Proposed", r"age=(\d+)", 1).try_cast("int").alias("age"), error.alias("error"))


class Registry(BaseHTTPRequestHandler):
    """Answers for records, in place of a registry on the network. Ids divisible by 5 are unknown, every seventh is busy
    at first, and every eleventh answers with something else than JSON."""

    protocol_version = "HTTP/1.1"
    busy: set[str] = set()

    def do_GET(self):
        name = self.path.rpartition("/")[2]
        n = int(name[1:])
        status = 404 if n % 5 == 0 else 503 if n % 7 == 0 and name not in self.busy else 200
        if n % 7 == 0 and n % 5:
            # the next request for it is answered; then nothing is left to remember
            self.busy.symmetric_difference_update({name})
        text_ = f"Inclusion Criteria:\n1. record {n}"
        body = b"<html>" if n % 11 == 0 else json.dumps({"protocolSection": {"eligibilityModule": {"eligibilityCriteria": text_}}}).encode()
        self.send_response(status)
        self.send_header("Content-Length", str(len(body)))
        self.send_header("Connection", "close")
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


REGISTRY = {"url": "http://registry/studies/{id}", "handler": "eligo.queries:Registry", "wait": 0.01, "at_once": 8}


@query("""WITH n AS (SELECT c_custkey AS n FROM customer)
SELECT 'T' || n AS id, CASE WHEN n % 5 = 0 THEN 404 ELSE 200 END AS status, CASE WHEN n % 5 <> 0 AND n % 7 = 0 THEN 2 ELSE 1 END AS attempts,
CASE WHEN n % 5 <> 0 AND n % 11 <> 0 THEN 'Inclusion Criteria:' || chr(10) || '1. record ' || n END AS criteria,
CASE WHEN n % 5 = 0 THEN 'status 404' WHEN n % 11 = 0 THEN 'the answer is no JSON' END AS error FROM n""")
def fetched_records(spark, sf_dir):
    """Registry records over HTTP, a request per id; busy servers are asked again, other answers are error rows. The
    tasks' own handler answers, since there is no network."""
    ids = t(spark, sf_dir, "customer").select(F.concat(F.lit("T"), "c_custkey").alias("id"))
    # fetched once and written: a plan that is read twice must not ask twice
    got = checkpointed(records.fetched(ids, **REGISTRY))
    body = F.when(F.col("body").isNotNull(), files.criteria_field(F.col("body")))
    return got.select("id", "status", "attempts", body.alias("criteria"), "error")


@query("""SELECT 'Inclusion Criteria:' || chr(10) || '1. record ' || c_custkey AS criteria FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 11 <> 0""")
def saved_records(spark, sf_dir):
    """Fetched records saved as lines of JSON and read back."""
    ids, at = t(spark, sf_dir, "customer").select(F.concat(F.lit("T"), "c_custkey").alias("id")), fresh_dir(spark, "records")
    records.save(records.fetched(ids, **REGISTRY), at)
    return spark.read.text(at).select(files.criteria_field(F.col("value")).alias("criteria"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'EXCLUDE ' ELSE 'INCLUDE ' END || 'part ' || p_partkey AS rule_text, CASE WHEN p_partkey % 4 IN (0, 1) THEN p_size END AS age,
CASE WHEN p_partkey % 4 = 0 THEN 1 WHEN p_partkey % 4 = 1 THEN 1 END AS n_age, CASE WHEN p_partkey % 4 IN (0, 1) THEN CAST(p_partkey AS VARCHAR) || '.1' END AS rule_id,
CASE p_partkey % 4 WHEN 2 THEN 'curate: empty code' WHEN 3 THEN 'types: no object of types' ELSE '' END AS error FROM part""")
def typed_workflow(spark, sf_dir):
    """Rules directed, filed under types, curated as criterion code, cleaned, checked and
    tabulated."""
    rows = t(spark, sf_dir, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 4).alias("k"), F.concat(F.lit("part "), "p_partkey").alias("input_rule"), (F.col("p_partkey") % 4 == 1).alias("exclude"))
    asked = text.directed(F.col("input_rule"), F.col("exclude"))
    kinds = F.when(F.col("k") == 3, "none").otherwise(F.concat(F.lit('{"'), asked, F.lit('": ["Age"]}')))
    code = F.when(F.col("k") == 2, "```python\nfrom x import y\n```").otherwise(F.concat(F.lit("```python\nfrom x import y\ncriteria: List[BaseCriterion] = [\nAge(age="), "p_size", F.lit(', operator=">=")\n]\n```')))
    cache = answers(rows, "types", asked, kinds).unionAll(answers(rows, "curate", curation.curate_prompt(asked, F.array(F.lit("Age"))), code))
    done = curation.typed(rows, models.Asker(cache))
    table = curation.tabulated(done.filter("node is not null").selectExpr("cast(p_partkey as string) AS TrialId", "'c' AS Cohort", "0 AS pos", "node", "p_partkey"))
    out = done.select("p_partkey", "rule_text", F.try_element_at("errors", F.lit(1)).alias("error")).join(table.select("p_partkey", F.get_json_object("node", "$.age").cast("int").alias("age"), F.col("Age").alias("n_age"), F.col("RuleId").alias("rule_id")), "p_partkey", "left")
    return out.select("p_partkey", "rule_text", F.when(F.col("rule_id").isNotNull(), F.col("age")).alias("age"), "n_age", "rule_id", F.coalesce("error", F.lit("")).alias("error"))


@query(f"""{DIFF_SQL},
kept AS (SELECT label AS cohort, 'text ' || vec_id AS description, vec_id AS n FROM embeddings WHERE vec_id % 2 = 0)
SELECT p.cohort, p.old_text AS description, k.n, p.new_text AS mapped_text, coalesce(p.similarity, 0.0) AS similarity, CASE WHEN p.new_text IS NOT NULL THEN 'R' || p.new_pos END AS mapped_rule
FROM placed p LEFT JOIN kept k ON k.cohort = p.cohort AND k.description = p.old_text""")
def review_merge(spark, sf_dir):
    """Curated rows merged with the mapped rules of their cohort by the ordered difference."""
    old, new = sides(spark, sf_dir)
    table = old.select(F.col("cohort").alias("Cohort"), F.col("text").alias("Description"), F.col("pos").alias("n"))
    diff = checkpointed(ordered_diff(spark, sf_dir)).withColumnRenamed("cohort", "Cohort")
    rules = new.select(F.col("cohort").alias("Cohort"), "text", F.concat(F.lit("R"), "pos").alias("rule"), F.lit(1).alias("order"))
    rules = rules.unionByName(rules.withColumns({"rule": F.lit("earlier"), "order": F.lit(0)}))
    out = curation.merged_mappings(table, diff, rules)
    return out.select(F.col("Cohort").alias("cohort"), F.col("Description").alias("description"), "n", F.col("MappedText").alias("mapped_text"), F.col("Similarity").alias("similarity"), F.col("MappedRule").alias("mapped_rule"))


@query("""SELECT c_custkey, -2 AS place, 'trial_id' || chr(9) || 'T_' || c_custkey AS line FROM customer UNION ALL SELECT c_custkey, -1, 'title' || chr(9) || c_mktsegment FROM customer
UNION ALL SELECT c_custkey, k, 'criterion' || chr(9) || 'I-0' || k || chr(9) || c_name || chr(9) || 'R' FROM customer, (SELECT unnest(range(1, 3)) AS k)""")
def reformatted_table(spark, sf_dir):
    """The reformatted table with its head rows."""
    rows = t(spark, sf_dir, "customer")
    docs = rows.select("c_custkey", F.concat(F.lit("Trial ID: T "), "c_custkey", F.lit("\nTrial Title:  "), "c_mktsegment", F.lit("\n")).alias("text"))
    lines = rows.select("c_custkey", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("at"), "c_name")
    lines = lines.select("c_custkey", "at", files.criterion_line(F.concat(F.lit("I-0"), "at"), F.col("c_name"), F.array(F.lit("R"))).alias("line"))
    return files.reformatted(docs, lines, "c_custkey")


@query("""SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"section":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || ',"curations":[' || coalesce(string_agg('{"input_rule":"' || l_returnflag || l_linenumber || '"}', ',' ORDER BY l_linenumber, l_returnflag || l_linenumber), '') || ']}' AS record
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""")
def grouped_records(spark, sf_dir):
    """Grouped rows as JSON records, children without what their parent says."""
    rows = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("seq"), F.concat("l_returnflag", "l_linenumber").alias("input_rule"), F.lit("x").alias("section"))
    parents = t(spark, sf_dir, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("section"))
    record = files.json_records(nesting.grouped(parents, rows, "o_orderkey", "seq"))
    return record.select(F.get_json_object("record", "$.o_orderkey").cast("long").alias("o_orderkey"), "record")
