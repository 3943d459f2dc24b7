"""The workflows: from protocol text to mapped rules, and from rules to typed criteria and the review table.

A stage asks a model through :class:`models.Asker` (a replayed cache, a client if there is one), reads the answer and
holds it against the stage's guard. What a guard refuses stays in its row: ``errors`` says why, the stage's results are
null, and no other row stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.functions import criteria, text, trees
from eligo.functions.lenient import first_parse
from eligo.operators import catalogue, compare, nesting
from eligo.plans.models import Asker
from eligo.sources.shared import checkpointed

RULES = "array<struct<input_rule:string,exclude:boolean,flipped:boolean,cohorts:array<string>>>"
NO_TEXTS = "array<string>"


def _none() -> Column:
    return F.array().cast(NO_TEXTS)


def refused(rows: DataFrame, stage: str, error: Column) -> DataFrame:
    """``rows`` with an error added to ``errors``, if there is one."""
    had = F.col("errors") if "errors" in rows.columns else _none()
    return rows.withColumn("errors", F.concat(had, F.when(error.isNotNull(), F.array(F.concat(F.lit(f"{stage}: "), error))).otherwise(_none())))


def read_answers(rows: DataFrame, asker: Asker) -> DataFrame:
    """``rows`` (with response) with answer: the response as JSON text, null if it cannot be read.

    A response that none of the parsers reads is handed to the repair stage, and its answer goes through the same
    parsers; only such rows are asked about, and where there are none nothing is joined. The rows are checkpointed, so
    that a chain of stages runs each once."""
    read = lambda c: first_parse(text.code_blocks(F.col(c), "json"))["json"]
    rows = checkpointed(rows.withColumn("answer", read("response")))
    lost = F.col("answer").isNull() & F.col("response").isNotNull()
    if rows.filter(lost).isEmpty():
        return rows
    again = asker.ask(rows.filter(lost).withColumnRenamed("response", "broken"), "repair", F.col("broken"))
    again = again.withColumn("answer", read("response")).withColumn("response", F.col("broken"))
    return rows.filter(~lost).unionByName(again.select(*rows.columns))


def rules_of(answer: Column) -> Column:
    """The atomic rules that an answer lists, flips applied; an empty list for one that cannot be read."""
    listed = F.coalesce(F.from_json(answer, RULES), F.array().cast(RULES))
    return F.transform(listed, lambda r: nesting.rebuilt(r["input_rule"], r["exclude"], r["flipped"], r["cohorts"]))


def atomic_rules(answers: DataFrame, keys: list[str], response: str = "response") -> DataFrame:
    """keys, rule_seq and the fields of each rule of each answer, flips applied; cohorts stay with their rule."""
    read = first_parse(text.code_blocks(F.col(response), "json"))["json"]
    return answers.select(*keys, F.posexplode(rules_of(read)).alias("rule_seq", "rule")).select(*keys, "rule_seq", "rule.*")


def prepared(rows: DataFrame, keys: list[str], asker: Asker, body: str = "text") -> DataFrame:
    """keys, rule_seq, input_rule, exclude, flipped, cohorts, errors: the atomic rules of each text.

    Stages: the text is sanitised; cut into tagged rules; a rule of several lines is replaced by what its sub-points say
    (a list of texts, nothing else); an exclusion is turned round where that reads better. A rule that a stage cannot
    answer for stays as it was before, with an error. ``keys`` name the texts and should be unique; ``rule_seq``
    orders the rules of a text by the places from which the stages took them."""
    asker = asker.prepared()
    clean = asker.ask(rows.select(*keys, F.col(body).alias("raw")), "sanitise", F.col("raw"))
    clean = clean.select(*keys, text.strip(F.regexp_replace(F.coalesce("response", "raw"), r"(?m)^```\w*[ \t]*$", "")).alias("clean"), F.when(F.col("response").isNull(), "no answer").alias("e0"))
    rules = F.coalesce(F.from_json("answer", RULES), F.array().cast(RULES))
    tagged = read_answers(asker.ask(clean, "tag", F.col("clean")), asker).withColumn("listed", rules)
    whole = F.array(F.struct(F.col("clean").alias("input_rule"), F.lit(False).alias("exclude"), F.lit(False).alias("flipped"), F.lit(None).cast(NO_TEXTS).alias("cohorts")))
    listed = F.col("listed")
    tagged = refused(refused(tagged, "sanitise", F.col("e0")), "tag", F.when(F.size(listed) == 0, "no list of rules"))
    tagged = tagged.select(*keys, "errors", F.posexplode(F.when(F.size(listed) > 0, listed).otherwise(whole)).alias("at", "rule"))
    tagged = tagged.select(*keys, "errors", F.array("at").alias("place"), "rule.input_rule", F.coalesce("rule.exclude", F.lit(False)).alias("exclude"), F.col("rule.cohorts").alias("cohorts"))
    # written, as three stages read the rules
    tagged = checkpointed(tagged.withColumn("many", F.coalesce(text.many_lines(F.col("input_rule")), F.lit(False))))

    promoted = read_answers(asker.ask(tagged.filter("many"), "promote", F.col("input_rule")), asker)
    points = F.when(F.col("answer").startswith("["), F.from_json("answer", NO_TEXTS))
    fine = (F.size(points) > 0) & ~F.exists(points, lambda p: p.isNull())
    promoted = refused(promoted, "promote", F.when(~F.coalesce(fine, F.lit(False)), "no list of texts"))
    promoted = promoted.select(*keys, "errors", "place", "exclude", "cohorts", F.posexplode(F.when(fine, points).otherwise(F.array("input_rule"))).alias("at", "input_rule"))
    promoted = promoted.select(*keys, "errors", F.concat("place", F.array("at")).alias("place"), "input_rule", "exclude", "cohorts")
    points_or_rules = tagged.filter("not many").drop("many").unionByName(promoted)

    turned = read_answers(asker.ask(points_or_rules.filter("exclude"), "flip", F.col("input_rule")), asker).withColumn("listed", rules)
    kept = F.array(F.struct(F.col("input_rule"), F.lit(True).alias("exclude"), F.lit(False).alias("flipped"), F.col("cohorts")))
    turned = refused(turned, "flip", F.when(F.size(listed) == 0, "no list of rules"))
    own = F.transform(listed, lambda r: nesting.rebuilt(r["input_rule"], F.coalesce(r["exclude"], F.lit(True)), F.coalesce(r["flipped"], F.lit(False)), F.coalesce(r["cohorts"], F.col("cohorts"))))
    turned = turned.select(*keys, "errors", "place", F.posexplode(F.when(F.size(listed) > 0, own).otherwise(kept)).alias("at", "rule"))
    turned = turned.select(*keys, "errors", F.concat("place", F.array("at")).alias("place"), "rule.*")
    out = points_or_rules.filter("not exclude").withColumn("flipped", F.lit(False)).unionByName(turned)
    lists = out.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "input_rule", "exclude", "flipped", "cohorts", "errors"))).alias("rules"))
    return lists.select(*keys, F.posexplode("rules").alias("rule_seq", "rule")).select(*keys, "rule_seq", "rule.input_rule", "rule.exclude", "rule.flipped", "rule.cohorts", "rule.errors")


def grouped_rules(docs: DataFrame, asker: Asker, key: str = "doc_id") -> DataFrame:
    """Protocol texts by statement: key, statement_id, section, statement and ``curations``, its atomic rules in order."""
    parents = checkpointed(text.parent_statements(docs, key).select(key, "seq", "statement_id", "section", "statement"))
    rows = prepared(parents, [key, "seq"], asker, "statement")
    lists = rows.groupBy(key, "seq").agg(F.sort_array(F.collect_list(F.struct("rule_seq", "input_rule", "exclude", "flipped", "cohorts", "errors"))).alias("curations"))
    return parents.join(lists.hint("merge"), [key, "seq"], "left")  # as many lists as statements: never broadcast


def categorised(rows: DataFrame, asker: Asker) -> DataFrame:
    """``rows`` with categories: what the model files input_rule under. Its answer must be a list of one object, whose
    key is the rule, unchanged."""
    rows = read_answers(asker.ask(rows, "category", F.col("input_rule")), asker)
    found = F.when(F.col("answer").startswith("["), F.from_json("answer", "array<map<string,array<string>>>"))
    one = F.when((F.size(found) == 1) & (F.size(F.try_element_at(found, F.lit(1))) > 0), F.try_element_at(found, F.lit(1)))
    rows = rows.withColumn("one", one)
    changed = ~compare.unchanged(F.map_keys("one")[0], F.col("input_rule"))
    error = F.when(F.col("answer").isNull(), "no answer that can be read").when(F.col("one").isNull(), "not a list of one object").when(changed, "the rule was changed")
    return refused(rows.withColumn("error", error).withColumn("categories", F.when(F.col("error").isNull(), F.map_values("one")[0])), "category", F.col("error")).drop("one", "error", "answer", "response")


def mapping_prompt(rule: Column, offered: Column) -> Column:
    """What the mapping stage asks: the rule, then what the catalogue offers for each of its categories."""
    return F.concat_ws("\n", rule, F.array_join(F.transform(offered, lambda o: F.concat_ws("\n", F.concat(F.lit("# "), o["category"]), o["hint"], F.array_join(o["rules"], "\n"))), "\n"))


def with_trees(rows: DataFrame, asker: Asker, long_catalogue: DataFrame, hints: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with rule_tree: of several results the last one's tree; a single object counts as a list of one.

    The model is offered the catalogue's rules of the row's categories, in the order of its answer; a category that the
    catalogue lacks is an error, and the row is not asked about. Where rows have an exclude flag, the model is asked
    about the directed rule, and a missing flag is an error."""
    rule = F.col("input_rule")
    if "exclude" in rows.columns:
        rows = refused(rows, "mapping", text.direction_error(rule, F.col("exclude")))
        rule = text.directed(rule, F.col("exclude"))
    rows = catalogue.with_offers(rows, long_catalogue, F.coalesce("categories", _none()), hints or {}, "offers")
    unknown = F.array_join(F.transform(F.filter("offers", lambda o: o["rules"].isNull()), lambda o: o["category"]), ", ")
    rows = refused(rows, "mapping", F.when(unknown != "", F.concat(F.lit("no category "), unknown)))
    lost = F.exists("offers", lambda o: o["rules"].isNull())
    asked = F.when(~lost, mapping_prompt(rule, F.col("offers")))
    rows = rows.withColumn("asked", asked).drop("offers")
    wrong = rows.filter("asked is null").drop("asked").withColumns({"rule_tree": F.lit(None).cast("string"), "mapped_text": F.lit(None).cast("string")})
    rows = read_answers(asker.ask(rows.filter("asked is not null"), "mapping", F.col("asked")), asker).drop("asked")
    results = F.from_json("answer", "array<struct<input_rule:string,rule_tree:string>>")
    rows = rows.withColumn("result", nesting.collapsed(results))
    error = F.when(F.col("answer").isNull(), "no answer that can be read").when(F.col("result.rule_tree").isNull(), "no rule in the answer")
    rows = refused(rows.withColumn("rule_tree", F.col("result.rule_tree")).withColumn("mapped_text", F.col("result.input_rule")), "mapping", error).drop("result", "answer", "response")
    return rows.unionByName(wrong)


def mapped(rows: DataFrame, long_catalogue: DataFrame, tree: str = "rule_tree") -> DataFrame:
    """``rows`` with rule_tree blanked if hollow, rule_reformat, new_rules and warnings put for flagged negations.

    Rows with new rules keep their negations, as do rows without a rule."""
    rows = rows.withColumn(tree, trees.blank_if_hollow(F.col(tree)))
    shown = trees.rendered(F.nullif(F.col(tree), F.lit("")))
    rows = rows.withColumn("rule_reformat", F.coalesce(shown["json"], F.lit(""))).withColumn("render_error", shown["error"])
    names = F.coalesce(trees.rule_names(F.nullif(F.col(tree), F.lit(""))), _none())
    rows = catalogue.with_new_rules(rows, long_catalogue, names)
    rows = catalogue.with_names(rows, catalogue.warn_flags(long_catalogue).filter("warn"), names, "flagged", among=True)
    warned = text.warn_by_names(F.col("rule_reformat"), F.col("flagged"))
    return rows.withColumn("rule_reformat", F.when(F.size("new_rules") == 0, warned).otherwise(F.col("rule_reformat"))).drop("flagged")


def confident(rows: DataFrame, asker: Asker) -> DataFrame:
    """``rows`` with confidence_level and confidence_explanation, from an answer of exactly one object."""
    rows = read_answers(asker.ask(rows, "confidence", F.concat_ws("\n", "input_rule", "rule_reformat")), asker)
    found = F.when(F.col("answer").startswith("["), F.from_json("answer", "array<struct<confidence_level:double,confidence_explanation:string>>"))
    one = F.when(F.size(found) == 1, F.try_element_at(found, F.lit(1)))
    rows = rows.withColumn("one", one)
    rows = refused(rows, "confidence", F.when(F.col("one").isNull(), "not a list of one object"))
    return rows.withColumn("confidence_level", F.col("one.confidence_level")).withColumn("confidence_explanation", F.col("one.confidence_explanation")).drop("one", "answer", "response")


def mapping_workflow(rules: DataFrame, long_catalogue: DataFrame, asker: Asker, confidence: bool = True, hints: dict[str, str] | None = None) -> DataFrame:
    """``rules`` (input_rule, ...) in seven stages: category, mapping, blank if hollow, render, new rules, warnings and,
    if wanted, confidence. A row whose category stage failed is not mapped. ``hints``: what the mapping prompt says
    about a category."""
    asker = asker.prepared()
    rows = categorised(rules, asker)
    wrong = F.size("errors") > 0
    tried = with_trees(rows.filter(~wrong), asker, long_catalogue, hints)
    rows = tried.unionByName(rows.filter(wrong), allowMissingColumns=True)
    rows = mapped(rows, long_catalogue)
    rows = rows.withColumn("errors", F.when(F.col("render_error").isNotNull(), F.concat("errors", F.array(F.concat(F.lit("render: "), F.col("render_error"))))).otherwise(F.col("errors"))).drop("render_error")
    return confident(rows, asker) if confidence else rows


#: Node types that every curation may need, whatever a rule is about (fixed values).
ESSENTIAL = ("And", "Or", "Not", "If")


def curate_prompt(rule: Column, types: Column, instructions: Column | str | None = None) -> Column:
    """What the curate stage asks: the language's types that the row's types call for, the rule, its types, and what a
    user adds."""
    types = F.coalesce(types, _none())
    more = F.lit(instructions or None) if isinstance(instructions, str | None) else F.nullif(instructions, F.lit(""))
    return F.concat_ws("\n", criteria.schema_help(F.array_union(types, F.array(*map(F.lit, ESSENTIAL)))), rule, F.array_join(types, ","), more)


def curated(rows: DataFrame, asker: Asker, instructions: Column | str | None = None, errors: bool = False) -> DataFrame:
    """``rows`` (rule_text, types) with code and read, the parser's struct: the model's answer, cleaned and parsed."""
    out = asker.ask(rows, "curate", curate_prompt(F.col("rule_text"), F.col("types"), instructions), errors)
    out = out.withColumn("code", text.bare_criteria(text.code_blocks(F.col("response"), "python")))
    return out.withColumn("read", criteria.parsed(F.nullif(F.col("code"), F.lit(""))))


def typed(rows: DataFrame, asker: Asker, instructions: str = "") -> DataFrame:
    """``rows`` (input_rule, exclude) with rule_text, code, node and errors: directed, filed under criterion types,
    curated as criterion code, cleaned and checked. Empty code and code that does not parse are errors; a row without
    types is not curated. The rows are checkpointed, as a table and its errors are mostly both wanted."""
    asker = asker.prepared()
    out = rows.withColumn("rule_text", text.directed(F.col("input_rule"), F.coalesce("exclude", F.lit(False))))
    out = read_answers(asker.ask(out, "types", F.col("rule_text")), asker)
    kinds = F.from_json("answer", "map<string,array<string>>")
    out = out.withColumn("types", F.flatten(F.map_values(kinds)))
    out = refused(out, "types", F.when(F.col("types").isNull(), "no object of types")).drop("answer", "response")
    wrong = out.filter(F.size("errors") > 0)
    out = curated(out.filter(F.size("errors") == 0), asker, instructions)
    out = refused(out, "curate", F.when(F.coalesce("code", F.lit("")) == "", "empty code").otherwise(F.col("read.error")))
    return checkpointed(out.withColumn("node", F.col("read.json")).drop("read", "response").unionByName(wrong, allowMissingColumns=True))


def recurated(rows: DataFrame, asker: Asker, instructions: Column | str | None = None, code: str = "LlmCode") -> DataFrame:
    """``rows`` (rule_text, types, ``code``) asked about again, with a user's instructions: Proposed, the new code as the
    language writes it, or null with Error saying why there is none; ``code`` keeps the old one.

    The instructions are part of the prompt's key, so other instructions are another question. A call that misses the
    asker's deadline is ended and is an error of its row, as is an answer that does not parse."""
    kept = rows.withColumnRenamed(code, "old_")
    out = curated(kept, asker.prepared(), instructions, errors=True)
    late = F.when(F.col("call_error") == "late", F.lit("the model took too long")).otherwise(F.coalesce("call_error", F.lit("no answer")))
    error = F.when(F.col("response").isNull(), late).when(F.coalesce("code", F.lit("")) == "", "empty code").otherwise(F.col("read.error"))
    out = out.withColumns({"Error": error, "Proposed": F.when(error.isNull(), criteria.written(F.col("read.json")))})
    return out.drop("code", "read", "response", "call_error").withColumnRenamed("old_", code)


def tabulated(rows: DataFrame, trial: str = "TrialId", cohort: str = "Cohort", order: str = "pos") -> DataFrame:
    """Typed criteria (node: JSON) as review rows: numbers, description, a counter per node type, code."""
    out = nesting.numbered(rows, [trial, cohort], order, trial)
    out = out.withColumn("Description", F.get_json_object("node", "$.description"))
    out = nesting.type_counts(out, criteria.node_types(F.col("node")))
    return out.withColumn("LlmCode", criteria.written(F.col("node")))


def merged_mappings(table: DataFrame, diff: DataFrame, rules: DataFrame, key: str = "Cohort") -> DataFrame:
    """Review rows with the mapped rules of their cohort: MappedText, Similarity, MappedRule.

    ``diff``: the ordered difference of descriptions (old) and mapped texts (new) by ``key``. ``rules``: key, text,
    rule, order; the last rule of a text counts. A cohort that has a difference gets its rows in place of those of
    ``table``, joined by description, null meeting null; other cohorts stay as they are."""
    last = rules.groupBy(key, F.col("text").alias("MappedText")).agg(F.max_by("rule", "order").alias("MappedRule"))
    found = diff.select(key, F.col("old_text").alias("Description"), F.col("new_text").alias("MappedText"), F.coalesce("similarity", F.lit(0.0)).alias("Similarity")).join(last, [key, "MappedText"], "left")
    left = table.withColumnsRenamed({key: "own_key", "Description": "own_description"})
    met = left.join(found, left["own_key"].eqNullSafe(found[key]) & left["own_description"].eqNullSafe(found["Description"]), "right").drop("own_key", "own_description")
    rest = table.join(diff.select(key).distinct(), key, "left_anti")
    return nesting.stacked([met, rest])
