import random

import pytest
from pyspark.sql import functions as F

from eligo.operators import catalogue, compare, nesting, review
from eligo.functions import text, trees
from eligo.plans import curation, models
from eligo.sources import files


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_catalogue(spark):
    wide = spark.createDataFrame([(0, "A", "TRUE", "B", None), (1, " C ", "", "A", "no"), (2, None, "1", "D", "t")], "row_pos int, One string, WARN_IF1 string, Two string, WARN_IF3 string")
    long = catalogue.long_catalogue(wide)
    assert rows(catalogue.warn_flags(long)) == [("A", True), ("B", False), ("C", False), ("D", True)]
    assert rows(catalogue.of_categories(long, ["Two"]).select("rule")) == [("A",), ("B",), ("D",)]
    with pytest.raises(ValueError):
        catalogue.of_categories(long, ["Three"])
    with pytest.raises(ValueError):
        catalogue.long_catalogue(wide.drop("WARN_IF3"))
    with pytest.raises(ValueError):
        catalogue.long_catalogue(wide.withColumnRenamed("WARN_IF3", "Other"))


def test_review_facets_sort_pages(spark):
    data = [(i, None if i % 5 == 0 else f"p{i % 5}", float(i * 7 % 11)) for i in range(23)]
    view = review.Review(spark.createDataFrame(data, "id int, p string, x double"), "id", size=5).toggled("p", "p1")
    assert view.filtered().count() == sum(d[1] != "p1" for d in data)
    assert view.toggled("p", None).filtered().count() == sum(d[1] not in ("p1", None) for d in data)
    assert view.toggled("p", "p1").filtered().count() == 23 and view.none_selected("p").filtered().count() == 0
    view = view.sorted_by("p").sorted_by("x").sorted_by("x")
    kept = [d for d in data if d[1] != "p1"]
    want = sorted(kept, key=lambda d: (d[1] is None, d[1] or "", -d[2], d[0]))
    assert view.pages() == 4
    assert [tuple(r) for r in view.at(1).shown().collect()] == want[5:10]
    assert view.at(99).page == 3 and view.at(-1).page == 0
    assert view.sorted_by("x").sort == (("p", True),)
    assert review.page_list(10, 30) == [1, None, *range(3, 18), None, 30] and review.page_list(1, 0) == []
    assert review.moved(["a", "b", "c"], "c", "a") == ["c", "a", "b"] and review.moved(["a", "b"], "a", None) == ["b", "a"]


def test_overrides(spark):
    base = spark.createDataFrame([(k, f"c{k}") for k in "abcd"], "k string, LlmCode string")
    edits = spark.createDataFrame([("a", 1, "x", False), ("a", 2, "y", False), ("b", 1, "x", False), ("b", 2, None, True), ("c", 1, "", False)], "k string, version int, OverrideCode string, deleted boolean")
    got = rows(review.overlaid(base, edits, ["k"]).select("k", "Code", "Override"))
    assert got == [("a", "y", True), ("b", "cb", False), ("c", "cc", False), ("d", "cd", False)]


def test_checked_page(spark):
    view = review.Review(spark.createDataFrame([(1, "Other"), (2, "Bad")], "id int, Code string"), "id")
    assert [r["Error"] is None for r in view.checked().orderBy("id").collect()] == [True, False]


def test_nesting(spark):
    parents = spark.createDataFrame([("p", 1), ("q", 2), ("p", 3)], "id string, n int")
    kids = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a"), (None, 1, "z")], "id string, seq int, v string")
    got = {(r["id"], r["n"]): [c["v"] for c in r["curations"]] for r in nesting.grouped(parents, kids, "id", "seq").collect()}
    assert got == {("p", 1): ["a", "b"], ("q", 2): [], ("p", 3): ["a", "b"]}
    flat = nesting.flattened(nesting.grouped(parents, kids, "id", "seq"), ["id", "n"])
    assert flat.count() == 4
    left = spark.createDataFrame([("a", 1), (None, 2), ("x", 3)], "k string, l int")
    right = spark.createDataFrame([("a",), (None,), ("b",), ("a",)], "k string")
    assert sorted(map(str, rows(nesting.merged(left, right, "k").select("k", "l")))) == sorted(map(str, [("a", 1), ("a", 1), (None, 2), ("b", None)]))
    with pytest.raises(ValueError):
        nesting.stacked([])


def test_greedy_matches_equal_a_sequential_pass(spark):
    random.seed(3)
    pairs = [(g, i, j, round(random.random(), 1)) for g in range(3) for i in range(12) for j in range(12) if random.random() < 0.6]
    want = set()
    for g in range(3):
        a, b = set(), set()
        for _, i, j, s in sorted((p for p in pairs if p[0] == g), key=lambda p: (-p[3], p[1], p[2])):
            if i not in a and j not in b:
                a.add(i), b.add(j), want.add((g, i, j))
    got = compare.greedy_matches(spark.createDataFrame(pairs, "k int, i int, j int, similarity double"), "k")
    assert {(r["k"], r["i"], r["j"]) for r in got.collect()} == want


def test_ordered_diff_and_report(spark):
    old = spark.createDataFrame([(1, i, f"o{i}") for i in range(4)], "k int, pos int, text string")
    new = spark.createDataFrame([(1, i, f"n{i}") for i in range(4)], "k int, pos int, text string")
    matches = spark.createDataFrame([(1, 1, 0, 1.0), (1, 3, 2, 0.95)], "k int, i int, j int, similarity double")
    diff = compare.ordered_diff(old, new, matches, "k")
    got = [(r["old_text"], r["new_text"]) for r in diff.orderBy("place").collect()]
    assert got == [("o0", None), ("o1", "n0"), ("o2", None), (None, "n1"), ("o3", "n2"), (None, "n3")]
    report = compare.diff_report(diff, "k").first()["report"]
    assert report.startswith("1. Removed\n- o0\n2. matched (100.0%)\n  n0") and "5. Modified (95.0%)\n- o3\n+ n2" in report


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_indel_ratio(spark):
    random.seed(5)
    data = [("".join(random.choices("abc", k=random.randint(0, 9))), "".join(random.choices("abc", k=random.randint(0, 9)))) for _ in range(60)]
    got = spark.createDataFrame(data, "a string, b string").select("a", "b", compare.indel_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    for r in got:
        n = len(r["a"]) + len(r["b"])
        assert r["r"] == pytest.approx(100 if not n else 200 * lcs(r["a"], r["b"]) / n)
    assert len(spark.createDataFrame([("ab", "ac")], "a string, b string").select(compare.character_diff(F.col("a"), F.col("b")).alias("d")).first()["d"]) == 6


def test_model_cache(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, user string")
    cache = spark.createDataFrame([("x", "y")], "prompt_sha string, response string")
    replay = models.answered(frame, cache, "m", F.lit("s"), F.col("user"))
    assert {r["response"] for r in replay.collect()} == {None}
    store = str(tmp_path / "answers")
    got = models.answered(frame, cache, "m", F.lit("s"), F.col("user"), client=lambda s, u: f"{s}:{u}", store=store)
    assert rows(got.select("id", "response")) == [(1, "s:a"), (2, "s:b"), (3, "s:a")]
    assert models.Store(store).read(spark).count() == 2
    again = models.answered(frame, models.Store(store).answers(spark), "m", F.lit("s"), F.col("user"))
    assert rows(again.select("id", "response")) == rows(got.select("id", "response"))


def test_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.json").write_text('{"protocolSection": {"eligibilityModule": {"eligibilityCriteria": "a\\\\>b"}}}')
    assert files.read_trials(spark, str(tmp_path / "t")).first()["text"] == "a>b"
    (tmp_path / "t/b.json").write_text("{}")
    with pytest.raises(Exception, match="eligibilityCriteria"):
        files.read_trials(spark, str(tmp_path / "t")).collect()
    (tmp_path / "c.csv").write_text("One,WARN_IF,Two,WARN_IF\nA,TRUE,B,\n")
    assert rows(catalogue.warn_flags(catalogue.long_catalogue(files.read_catalogue(spark, str(tmp_path / "c.csv"))))) == [("A", True), ("B", False)]
    (tmp_path / "code.json").write_text('{"trial_id": "T", "cohort": "c", "pos": 1, "code": "Other"}\n{"trial_id": "T", "cohort": "c", "pos": 2, "code": "Nope"}\n')
    good, bad = files.read_criteria(spark, str(tmp_path / "code.json"))
    assert good.count() == 1 and "unknown criterion" in bad.first()["error"]
    (tmp_path / "m.json").write_text('{"c": [{"input_rule": "r", "rule_reformat": "R"}]}')
    assert files.read_mappings(spark, str(tmp_path / "m.json")).first()["description"] == "r"
    assert files.prefixed("a/out.json", "T1") == "a/T1_out.json" and files.prefixed("a/T1_out.json", "T1") == "a/T1_out.json" and files.prefixed("o", None) == "o"


def test_flat_report(spark):
    data = [("P", "I-01", "INCLUSION", "r", "R"), (None, None, None, "s", "S")]
    got = [r["report"] for r in files.flat_report(spark.createDataFrame(data, "original_input_rule string, original_input_rule_id string, section string, input_rule string, rule_reformat string")).collect()]
    assert got[0].startswith("--- Parent [I-01] ---\nSection: INCLUSION\nOriginal text:\nP\n\nInput rule:\nr\n") and got[1] == "Input rule:\ns\nMapped rule:\nS\n\n"


def test_small_operators(spark):
    edits = spark.createDataFrame([(1, "Other"), (2, "Othe"), (3, None), (4, "")], "k int, OverrideCode string")
    good, bad = review.validated(edits)
    assert rows(good.select("k")) == [(1,), (3,), (4,)] and rows(bad.select("k")) == [(2,)]
    lists = spark.createDataFrame([(["b", "a"],), (["c"],)], "c array<string>")
    assert nesting.category_union(lists, "c", ["z"]).first()["categories"] == ["a", "b", "c", "z"]
    assert nesting.with_any(lists, "c", ["a", "x"]).count() == 1


def test_facet_without_options_at_any_number_of_them(spark):
    view = review.Review(spark.range(12_000).selectExpr("id", "cast(id as string) as v"), "id").none_selected("v")
    assert view.filtered().count() == 0
    assert rows(view.toggled("v", "7").toggled("v", "11999").filtered().select("id")) == [(7,), (11999,)]
    assert view.toggled("v", "7").toggled("v", "7").filtered().count() == 0 and view.all_selected("v").filtered().count() == 12_000
    nulls = review.Review(spark.createDataFrame([(1, None), (2, True), (3, False)], "id int, v boolean"), "id")
    assert rows(nulls.none_selected("v").toggled("v", None).filtered().select("id")) == [(1,)]
    assert rows(nulls.toggled("v", False).filtered().select("id")) == [(1,), (2,)]


def test_typed_pages_and_columns():
    class Rows:
        def count(self):
            return 23

    view = review.Review(Rows(), "id", size=5)
    assert view.typed_page("3").page == 2 and view.typed_page("99").page == 4 and view.typed_page("x").page == 0 and view.typed_page("-1").page == 0
    assert view.typed_page("3").typed_size("10") == review.replace(view, size=10, page=0) and view.typed_size("0") == view and view.typed_size("1.5") == view
    columns = review.Columns(("a", "b", "c", "d"), ("a", "b", "c", "d"))
    assert columns.toggled("b").shown == ("a", "c", "d") and columns.toggled("b").toggled("b").shown == columns.declared
    assert columns.toggled("d").toggled("d").shown == columns.declared and columns.moved("d", "a").shown == ("d", "a", "b", "c")
    changed = columns.moved("d", "a").toggled("b")
    assert columns.restored(changed.saved()) == changed and changed.reset() == columns
    assert review.Columns(("a", "c"), ()).restored(changed.saved()).shown == ("a", "c")
    with pytest.raises(ValueError):
        columns.toggled("x")


def test_names_are_looked_up_by_row(spark):
    known = spark.createDataFrame([("A",), ("B",), (None,), ("A",)], "rule string")
    data = [(1, ["B", "X", "X"]), (1, ["Y", "A"]), (None, ["Z"]), (None, []), (2, None), (1, ["B", "X", "X"])]
    frame = spark.createDataFrame(data, "k int, names array<string>").withColumn("number", F.lit(5))
    for among, want in ((False, [["X"], ["Y"], ["Z"], [], None, ["X"]]), (True, [["B"], ["A"], [], [], None, ["B"]])):
        for most in (5, 1):
            got = catalogue.with_names(frame, known, F.col("names"), "found", among, most).collect()
            assert sorted(map(str, ((r["k"], r["names"], r["found"], r["number"]) for r in got))) == sorted(map(str, ((k, n, w, 5) for (k, n), w in zip(data, want))))


def test_every_flagged_rule_is_rewritten(spark):
    long = spark.range(6_000).selectExpr("'c' as category", "0 as category_pos", "cast(id as int) as row_pos", "concat('R_', id) as rule", "true as warn")
    frame = spark.createDataFrame([(i, '{"NOT": {"R_%d": []}}' % i) for i in (0, 5_999)], "k int, rule_tree string")
    got = curation.mapped(frame, long)
    assert rows(got.select("k", "rule_reformat")) == [(0, "WARN_IF(R_0)"), (5999, "WARN_IF(R_5999)")]
    odd = spark.createDataFrame([("NOT(A.B) NOT(A_B) NOT(AxB)", ["A", "A.B"])], "v string, f array<string>")
    assert odd.select(text.warn_by_names(F.col("v"), F.col("f"))).first()[0] == "WARN_IF(A.B) NOT(A_B) NOT(AxB)"


def test_tiles_compare_every_pair_of_a_cohort(spark):
    random.seed(8)
    data = [(k % 2 if k % 9 else None, k, [random.random() - 0.5 for _ in range(3)], "" if k % 7 == 0 else f"t{k}") for k in range(90)]
    frame = spark.createDataFrame(data, "k int, pos int, vector array<double>, text string")
    old, new = frame.filter("pos < 50"), frame.filter("pos >= 40")
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    want = {(a[0], a[1], b[1]) for a in data[:50] for b in data[40:] if a[0] is not None and a[0] == b[0] and a[3] and b[3] and cosine(a[2], b[2]) > 0.6}
    for tile in (4, 1000):
        got = compare.similar_pairs(old, new, "k", 0.6, tile=tile).collect()
        assert {(r["k"], r["i"], r["j"]) for r in got} == want and len(got) == len(want)


def test_unchanged_text(spark):
    data = [("a rule about things", "a rule about things"), ("a rule about things", "A rule about thing"), ("a", "b"), (None, "a"), ("", "")]
    got = spark.createDataFrame(data, "a string, b string").select(compare.unchanged(F.col("a"), F.col("b")).alias("u")).collect()
    assert [r["u"] for r in got] == [True, False, False, False, True]


def test_grouped_rules(spark):
    docs = spark.createDataFrame([("d", "Inclusion criteria\n1. adult\n2. any of:\n - p\n - q\nExclusion criteria\n1. ill")], "doc_id string, text string")
    known = {("sanitise", "1. adult"): "adult", ("tag", "adult"): '[{"input_rule": "adult", "exclude": false}]', ("sanitise", "1. ill"): "ill", ("tag", "ill"): '[{"input_rule": "ill", "exclude": true}]', ("flip", "ill"): '[{"input_rule": "not ill", "exclude": true, "flipped": true}]'}
    cache = spark.createDataFrame([(s, u, r) for (s, u), r in known.items()], "s string, u string, response string")
    cache = cache.select(models.prompt_key("m", F.col("s"), F.col("u")).alias("prompt_sha"), "response")
    got = {r["statement_id"]: [(c["input_rule"], c["exclude"], c["flipped"], c["errors"]) for c in r["curations"]] for r in curation.grouped_rules(docs, models.Asker(cache)).collect()}
    assert got["I-01"] == [("adult", False, False, [])] and got["E-01"] == [("not ill", False, True, [])]
    assert [(x[0], x[3]) for x in got["I-02"]] == [("2. any of:\n - p\n - q", ["sanitise: no answer", "tag: no list of rules", "promote: no list of texts"])]


def test_a_cache_is_merged_and_never_broadcast(spark):
    asked = spark.range(40).select("id", F.concat(F.lit("u"), "id").alias("u"))
    cache = asked.filter("id % 3 > 0").select(models.prompt_key("m", F.lit("s"), F.col("u")).alias("prompt_sha"), F.concat(F.lit("r"), "id").alias("response"))
    got = models.Asker(cache).prepared().ask(asked, "s", F.col("u"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert sorted((r["id"], r["response"]) for r in got.collect()) == [(i, f"r{i}" if i % 3 else None) for i in range(40)]


def test_answers_that_are_all_read_ask_for_no_repair(spark):
    data = [(1, "[1]"), (2, None), (3, "```json[2]```")]
    cache = spark.createDataFrame([], "prompt_sha string, response string")
    got = curation.read_answers(spark.createDataFrame(data, "k int, response string"), models.Asker(cache))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["k"], r["answer"]) for r in got.collect()) == [(1, "[1]"), (2, None), (3, "[2]")]


def test_writers_and_plain_readers(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p/a.txt").write_text("Trial ID: T 1\nTrial Title:  Some title\ntext")
    got = files.read_protocols(spark, str(tmp_path / "p")).first()
    assert got["trial_id"] == "T_1" and got["text"].endswith("text")
    (tmp_path / "list.csv").write_text("T1\nT2\n")
    assert rows(files.read_trial_list(spark, str(tmp_path / "list.csv"))) == [("T1",), ("T2",)]
    (tmp_path / "c.csv").write_text('One,WARN_IF\n"A\nB",TRUE\nC,\nA,no\n')
    assert [r["One"] for r in files.read_catalogue(spark, str(tmp_path / "c.csv")).orderBy("row_pos").collect()] == ["A\nB", "C", "A"]
    counts = nesting.stacked([spark.createDataFrame([("T", 1)], "TrialId string, Age int"), spark.createDataFrame([("U", 2)], "TrialId string, Sex int")])
    files.write_counts(counts.coalesce(1), str(tmp_path / "counts"))
    assert sorted(next((tmp_path / "counts").glob("part*")).read_text().split("\n")) == ["", "T\t1\t", "TrialId\tAge\tSex", "U\t\t2"]
    grouped = spark.createDataFrame([("p", [("r", "again")])], "section string, curations array<struct<input_rule: string, section: string>>")
    files.write_json(grouped, str(tmp_path / "json"))
    assert spark.read.text(str(tmp_path / "json")).first()[0] == '{"section":"p","curations":[{"input_rule":"r"}]}'
    paths = spark.createDataFrame([("a/out.json", "T1"), ("a/T1_out.json", "T1"), ("o", None), ("o", "T1")], "p string, i string")
    assert [r[0] for r in paths.select(files.prefixed_path(F.col("p"), F.col("i"))).collect()] == ["a/T1_out.json", "a/T1_out.json", "o", "T1_o"] == [files.prefixed(r["p"], r["i"]) for r in paths.collect()]


def test_trees_that_cannot_be_read_stop_no_task(spark):
    bad = spark.createDataFrame([("[" * 50_000,), ("{x",), (None,), ('{"A": []}',)], "v string")
    v = F.col("v")
    got = bad.select(trees.rule_names(v).alias("n"), trees.is_hollow(v).alias("h"), trees.normalised(v).alias("o"), trees.without_field(v, "x").alias("w"), trees.unreadable(v).isNull().alias("fine")).collect()
    assert [tuple(r) for r in got] == [(None, None, None, None, False), (None, None, None, None, False), (None, True, None, None, True), (["A"], False, '{"A": []}', '{"A": []}', True)]


def test_embeddings_are_asked_once(spark, tmp_path):
    frame = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "ab"), (4, None)], "id int, text string")
    none = spark.createDataFrame([], models.VECTORS)
    store = str(tmp_path / "vectors")
    assert {r["vector"] for r in models.embedded(frame, none, F.col("text")).collect()} == {None}
    got = models.embedded(frame, none, F.col("text"), client=lambda texts: [[float(len(x))] for x in texts], store=store)
    assert rows(got.select("id", F.col("vector")[0])) == [(1, 2.0), (2, 3.0), (3, 2.0), (4, None)]
    assert spark.read.parquet(store).count() == 2


def test_schema_help_follows_the_types(spark):
    from eligo.functions import criteria

    shown = lambda *kinds: [line.split(":")[0] for line in spark.createDataFrame([(list(kinds),)], "t array<string>").select(criteria.schema_help(F.col("t")).alias("h")).first()["h"].split("\n")]
    assert shown("LABVALUE") == ["All", "LabValue"]
    assert shown("performance") == ["All", "IntRange", "PerformanceStatus"]
    assert shown("PriorTreat") == ["All", *criteria.VALUES, "PriorTreatment"]
    assert shown("nothing") == ["All"] and shown() == ["All"]


def asking(at, answer=lambda s, u: f"{s}:{u}"):
    """A client that notes each of its calls in a folder."""
    import uuid
    from pathlib import Path

    def client(system, user):
        Path(at, f"{user}-{uuid.uuid4().hex}").touch()
        return answer(system, user)

    return client


def calls(at):
    return sorted(p.name.rsplit("-", 1)[0] for p in at.iterdir())


def test_prompts_are_asked_once_in_any_number_of_runs(spark, tmp_path):
    (seen := tmp_path / "seen").mkdir()
    frame = spark.createDataFrame([(k, f"p{k % 5}") for k in range(40)], "id int, user string")
    cache = spark.createDataFrame([], "prompt_sha string, response string")
    store = str(tmp_path / "store")
    for _ in range(3):
        got = models.answered(frame, cache, "m", F.lit("s"), F.col("user"), client=asking(seen), store=store)
        assert {(r["user"], r["response"]) for r in got.collect()} == {(f"p{k}", f"s:p{k}") for k in range(5)}
        got.count()
    assert calls(seen) == [f"p{k}" for k in range(5)]
    models.Store(store).compacted(spark)
    assert models.Store(store).answers(spark).count() == 5
    more = models.answered(frame.unionByName(spark.createDataFrame([(99, "p9")], frame.schema)), cache, "m", F.lit("s"), F.col("user"), client=asking(seen), store=store)
    assert more.filter("response is null").count() == 0 and calls(seen) == [f"p{k}" for k in (*range(5), 9)]


def test_a_late_call_is_ended_and_never_hides_an_answer(spark, tmp_path):
    import time

    (seen := tmp_path / "seen").mkdir()
    frame = spark.createDataFrame([(1, "quick"), (2, "slow"), (3, "bad")], "id int, user string")
    cache, store = spark.createDataFrame([], "prompt_sha string, response string"), str(tmp_path / "store")

    def answer(system, user):
        if user == "slow":
            time.sleep(60)
        if user == "bad":
            raise ValueError("no")
        return "first"

    ask = lambda f: {r["user"]: (r["response"], r["call_error"]) for r in models.answered(frame, cache, "m", F.lit("s"), F.col("user"), client=asking(seen, f), store=store, seconds=1.0).collect()}
    began = time.time()
    assert ask(answer) == {"quick": ("first", None), "slow": (None, "late"), "bad": (None, "failed: no")}
    assert time.time() - began < 50
    assert ask(lambda s, u: "second") == {"quick": ("first", None), "slow": ("second", None), "bad": ("second", None)}
    assert ask(answer) == {"quick": ("first", None), "slow": ("second", None), "bad": ("second", None)}
    assert calls(seen) == ["bad", "bad", "quick", "slow", "slow"]


def test_a_client_that_dies_is_an_error_of_its_row():
    import os

    call = models.Caller(lambda s, u: os._exit(3) if u == "die" else s + u, 20)
    assert call("a", "b") == ("ab", None) and call("a", "die") == (None, "failed: the client's process ended") and call("c", "d") == ("cd", None)
    call.cancel()


def test_a_task_that_is_run_again_asks_only_the_rest(tmp_path):
    """A task that dies after some commits, in a session that tries tasks again."""
    import subprocess
    import sys

    script = f"""
import os, sys
sys.path.insert(0, {str(__import__("pathlib").Path(__file__).resolve().parents[1])!r})
from pathlib import Path
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from eligo.plans import models
import uuid
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").config("spark.python.worker.reuse", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
models.COMMIT_PROMPTS = 1
seen, died = Path("{tmp_path}/seen"), Path("{tmp_path}/died")
seen.mkdir()
def client(s, u):
    Path(seen, u + "-" + uuid.uuid4().hex).touch()
    return u
real = models.Caller.__call__
def once(self, s, u):
    out = real(self, s, u)
    if u == "p13" and not died.exists():
        died.touch()
        os._exit(1)
    return out
models.Caller.__call__ = once
from pyspark import cloudpickle
cloudpickle.register_pickle_by_value(models)
frame = spark.range(20).select(F.concat(F.lit("p"), "id").alias("user"))
prompts = frame.select(models.prompt_key("m", F.lit("s"), F.col("user")).alias("prompt_sha"), F.lit("s").alias("system"), "user")
models.Store("file://{tmp_path}/store").fill(prompts, client, tasks=1)
print("answers", models.Store("file://{tmp_path}/store").answers(spark).count(), died.exists())
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240)
    assert "answers 20 True" in done.stdout, done.stderr[-3000:]
    assert sorted(calls(tmp_path / "seen")) == sorted([*(f"p{k}" for k in range(20)), "p13"])


def test_offers_by_both_ways(spark):
    from eligo.operators import catalogue

    long = spark.createDataFrame([("c", 0, 2, "B", False), ("c", 0, 1, "A", False), ("d", 1, 1, "A", False), (None, 2, 1, "X", False)], "category string, category_pos int, row_pos int, rule string, warn boolean")
    df = spark.createDataFrame([(1, ["d", "c"]), (1, ["x"]), (None, []), (2, None), (3, ["c", "c"])], "number int, offers array<string>")
    want = [(1, [("d", None, ["A"]), ("c", "h", ["A", "B"])]), (1, [("x", None, None)]), (None, []), (2, None), (3, [("c", "h", ["A", "B"])] * 2)]
    for most in (100, 0):
        got = catalogue.with_offers(df.withColumnRenamed("offers", "cats"), long, F.col("cats"), {"c": "h"}, "found", most).select("number", "found").collect()
        assert sorted(((r["number"], r["found"] and [tuple(o) for o in r["found"]] if r["found"] != [] else []) for r in got), key=str) == sorted(want, key=str)


def test_offers_of_rows_are_not_broadcast(spark):
    from eligo.operators import catalogue

    long = spark.range(6_000).selectExpr("concat('c', id % 3) AS category", "0 AS category_pos", "id AS row_pos", "concat('RULE_', id) AS rule", "false AS warn")
    rows = spark.range(50).select("id", F.array(F.concat(F.lit("c"), F.col("id") % 4)).alias("cats"))
    want = {k: [f"RULE_{n}" for n in range(k, 6_000, 3)] for k in range(3)} | {3: None}
    for most in (None, 0):
        got = catalogue.with_offers(rows, long, F.col("cats"), {}, "found", *([] if most is None else [most])).select("id", "found")
        assert all(r["found"][0]["rules"] == want[r["id"] % 4] for r in got.collect())
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan
        assert most == 0 or "Exchange" not in plan


def vector_sides(spark, n):
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 2)), k, rng.standard_normal(8).round(1).tolist()) for k in range(n)]
    df = spark.createDataFrame(rows, "cohort int, pos long, vector array<double>")
    return rows, df.filter("pos % 2 = 0"), df.filter("pos % 2 = 1")


def test_tiles_of_pairs_are_matrix_products_with_all_pairs(spark):
    rows, old, new = vector_sides(spark, 300)
    odd = spark.createDataFrame([(0, 1001, [1.0, 2.0]), (0, 1003, None), (0, 1005, [1.0] * 7 + [None])], new.schema)
    pairs = compare.similar_pairs(old, new.unionAll(odd), "cohort", 0.2, tile=40)
    got = {(r["i"], r["j"]): r["similarity"] for r in pairs.collect()}

    def cosine(a, b):
        a, b = ([x / sum(y * y for y in v) ** 0.5 for x in v] for v in (a, b))
        return round(sum(x * y for x, y in zip(a, b)), 9)

    want = {(i, j): cosine(u, v) for c, i, u in rows for d, j, v in rows if c == d and i % 2 == 0 and j % 2 == 1}
    assert got == pytest.approx({k: s for k, s in want.items() if s > 0.2}, abs=2e-9)
    assert "FlatMapCoGroupsInArrow" in pairs._jdf.queryExecution().executedPlan().toString()


def test_matches_by_levels_are_those_of_all_pairs(spark):
    _, old, new = vector_sides(spark, 400)
    want = compare.greedy_matches(compare.similar_pairs(old, new, "cohort", 0.0), "cohort").collect()
    levels = []
    counted, compare.level_of = compare.level_of, lambda *a: levels.append(counted(*a)) or levels[-1]
    try:
        got = compare.matched(old, new, "cohort", 0.0, tile=60, most=300, a_row=1).collect()
    finally:
        compare.level_of = counted
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(levels) > 2


def test_character_differences_are_kept_as_arrow_texts():
    import difflib
    import random
    import tracemalloc

    rng = random.Random(3)
    text_ = lambda: "".join(rng.choices("abcdefgh é", k=400))
    pairs = [(text_(), text_()) for _ in range(200)] + [("a", None), ("", ""), ("a", "b")]
    want = [None if x is None or y is None else list(difflib.unified_diff(x, y)) for x, y in pairs]
    compare._line_lists(pairs[:1])  # what is loaded at first use is not counted
    tracemalloc.start()
    got = compare._line_lists(pairs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == want and peak < 3_000_000


def test_records_are_written_whole_or_not_at_all(spark, tmp_path):
    from eligo.sources import records

    at, schema = str(tmp_path / "out"), records.SCHEMA
    good = [(f"T{k}", 200, 1, '{"n": %d, "s": "é"}' % k, None) for k in range(6)] + [("T9", 404, 1, None, "status 404")]
    records.save(spark.createDataFrame(good, schema).repartition(3), at)
    assert sorted(r["n"] for r in spark.read.json(at).collect()) == list(range(6))
    before = sorted(p.name for p in (tmp_path / "out").iterdir())
    with pytest.raises(Exception):
        records.save(spark.createDataFrame([*good, ("T7", 200, 1, "{broken", None)], schema).coalesce(1), at)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == before


def test_fetch_gives_errors_as_values(spark):
    from eligo.sources import records

    assert records.fetch("http://127.0.0.1:1/x", attempts=2, wait=0.01)[:3] == (None, 2, None)
    ids = spark.createDataFrame([("a",), (None,), ("a",)], "id string")
    got = sorted((r["id"] or "", r["status"], r["attempts"], r["body"]) for r in records.fetched(ids, "http://127.0.0.1:1/{id}", attempts=1).collect())
    assert got == [("", None, 0, None), ("a", None, 1, None)]


def test_requests_are_answered_in_the_process(monkeypatch):
    import socket

    from eligo.queries import Registry
    from eligo.sources import records

    monkeypatch.setattr(socket, "socket", None)
    ask = records.opener(Registry)
    for _ in range(2):  # nothing is remembered: a task that is run again gets the same answers
        got = [records.fetch(f"http://registry/studies/T{n}", wait=0.0, ask=ask) for n in (1, 5, 7, 11, 35, 77)]
        assert [(g[0], g[1], g[3]) for g in got] == [
            (200, 1, None), (404, 1, "status 404"), (200, 2, None), (200, 1, "the answer is no JSON"), (404, 1, "status 404"), (200, 2, "the answer is no JSON")]
        assert "1. record 7" in got[2][2] and not Registry.busy
    assert records.fetch("http://registry/studies/T7", attempts=1, ask=ask) == (503, 1, None, "status 503")
    Registry.busy.clear()


def test_many_ids_are_many_tasks_and_each_is_asked_once(spark):
    from eligo.sources import records

    ids = spark.range(1, 1001).selectExpr("concat('T', id % 500) as id").unionAll(spark.createDataFrame([(None,)], "id string"))
    got = records.fetched(ids, "http://registry/studies/{id}", most=20, handler="eligo.queries:Registry", wait=0.01)
    assert got.rdd.getNumPartitions() >= 25
    found = {r["id"]: (r["status"], r["attempts"]) for r in got.collect()}
    want = {f"T{n}": (404 if n % 5 == 0 else 200, 2 if n % 5 and n % 7 == 0 else 1) for n in range(500)}
    assert found == {**want, None: (None, 0)} and got.count() == 501
    assert records.fetched(ids.limit(0), "http://registry/{id}", handler="eligo.queries:Registry").count() == 0


def test_a_task_asks_for_others_while_an_id_waits(tmp_path):
    import time

    import pyarrow as pa
    import pyarrow.parquet as pq

    from eligo.sources import records

    pq.write_table(pa.table({"id": [f"T{7 * n}" for n in range(1, 33) if n % 5]}), tmp_path / "a.parquet")
    reader = records.RecordReader({"ids": str(tmp_path), "url": "http://registry/{id}", "handler": "eligo.queries:Registry", "wait": "0.2", "at_once": "8"})
    start = time.monotonic()
    got = [r for p in reader.partitions() for r in reader.read(p)]
    assert [r[2] for r in got] == [2] * 26 and time.monotonic() - start < 0.2 * 26 / 2


def test_fetched_records_pass_no_server_on_the_driver(spark, tmp_path, monkeypatch):
    import http.server

    from eligo.queries import QUERIES

    monkeypatch.setattr(http.server, "ThreadingHTTPServer", None)
    spark.range(40).toDF("c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    got = QUERIES["fetched_records"](spark, str(tmp_path))
    assert sorted(r["id"] for r in got.filter("attempts = 2").collect()) == ["T14", "T21", "T28", "T7"] and got.count() == 40


def test_saved_records_pass_no_server_on_the_driver(spark, tmp_path, monkeypatch):
    import http.server

    from eligo.queries import QUERIES

    monkeypatch.setattr(http.server, "ThreadingHTTPServer", None)
    spark.range(40).toDF("c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    got = sorted(int(r["criteria"].split()[-1]) for r in QUERIES["saved_records"](spark, str(tmp_path)).collect())
    assert got == [n for n in range(40) if n % 5 and n % 11]


def greedy(pairs):
    out, left, right = [], set(), set()
    for k, i, j, s in sorted(pairs, key=lambda p: (p[0], -p[3], p[1], p[2])):
        if (k, i) not in left and (k, j) not in right:
            left.add((k, i))
            right.add((k, j))
            out.append((k, i, j, s))
    return sorted(out)


PAIRS = "cohort string, i long, j long, similarity double"


@pytest.mark.parametrize("most", [1_000_000, 40, 3])
def test_greedy_matches_of_small_and_large_groups(spark, most):
    import random

    rng = random.Random(4)
    pairs = list({(c, i, j): (c, i, j, rng.choice([0.5, 0.7, 0.9, rng.random()])) for c in "abc" for i, j in ((rng.randrange(30), rng.randrange(30)) for _ in range(25 if c == "a" else 120))}.values())
    got = compare.greedy_matches(spark.createDataFrame(pairs, PAIRS), "cohort", most=most)
    assert rows(got) == greedy(pairs)


def test_a_long_chain_of_blocked_choices_is_few_jobs(spark):
    n = 10_000
    pairs = [("c", (k + 1) // 2, k // 2, 1 - k / (3 * n)) for k in range(n)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "")
    got = rows(compare.greedy_matches(spark.createDataFrame(pairs, PAIRS), "cohort"))
    assert got == greedy(pairs) and len(tracker.getJobIdsForGroup("chain")) < 20
    spark.sparkContext.setJobGroup("other", "")


def test_components(spark):
    from eligo.operators import graph

    edges = [(k, k + 1) for k in range(0, 300) if k % 60] + [(900, 950), (950, 930), (5, 7)]
    got = {r["u"]: r["p"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for k in range(301):
        want[k] = max(0, (k - 1) // 60 * 60 + 1) if k else 0
    assert all(got[k] == want[k] for k in range(1, 301) if k in got) and {got[x] for x in (900, 950, 930)} == {900}


def test_ordered_diff_of_one_long_cohort_over_many_tiles(spark):
    n = 100_000
    side = lambda name, step: spark.range(n).select(F.lit("c").alias("cohort"), F.col("id").alias("pos"), F.concat(F.lit(name), "id").alias("text"))
    old, new = side("o", 1), side("n", 1)
    matches = spark.range(0, n, 3).select(F.lit("c").alias("cohort"), F.col("id").alias("i"), (F.col("id") + 1).alias("j"), F.lit(0.95).alias("similarity")).filter(f"j < {n}")
    got = compare.ordered_diff(old, new, matches, "cohort", tile=4_000)
    assert got.count() == 2 * n - matches.count()
    found = {r["place"]: (r["old_pos"], r["new_pos"]) for r in got.filter("place <= 12 or place > 166660").collect()}
    want, at = {}, 0
    met = {k: k + 1 for k in range(0, n, 3) if k + 1 < n}
    nexts = set(met.values())
    olds, news = iter(range(n)), iter(range(n))
    place, o, w = 0, 0, 0
    while o < n or w < n:
        if o < n and o not in met:
            step, o = (o, None), o + 1
        elif w < n and w not in nexts:
            step, w = (None, w), w + 1
        else:
            step, o, w = (o, w), o + 1, w + 1
        place += 1
        if place <= 12 or place > 166_660:
            want[place] = step
    assert found == want


def test_edit_log_versions_snapshots_and_empty_log(spark, tmp_path):
    from eligo.operators.edits import EditLog

    log = EditLog(str(tmp_path / "log"), ("k",))
    base = spark.createDataFrame([(1, "a", None, None), (2, "b", "n", True), (None, "c", "n", False)], "k int, LlmCode string, Notes string, Checked boolean")
    edit = lambda *rows_: log.append(spark.createDataFrame(rows_, "k int, field string, value string, deleted boolean, seq long"))
    show = lambda: {r["k"]: (r["Code"], r["Override"], r["Notes"], r["Checked"]) for r in log.applied(base).collect()}
    assert show() == {1: ("a", False, None, None), 2: ("b", False, "n", True), None: ("c", False, "n", False)}
    log.compact(spark)
    assert edit((1, "OverrideCode", "x", False, 0), (1, "OverrideCode", "y", False, 1), (2, "Checked", "false", False, 0)) == 1
    assert edit((2, "Notes", None, False, 0), (1, "Checked", "TRUE", None, 0)) == 2
    want = {1: ("y", True, None, True), 2: ("b", False, None, False), None: ("c", False, "n", False)}
    assert show() == want
    log.compact(spark, drop=False)
    assert show() == want
    log.compact(spark)
    assert show() == want and sorted(p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")) == ["snapshot-2"]
    assert edit((1, "OverrideCode", "z", True, 0), (2, "OverrideCode", "", False, 0), (2, "Notes", "m", True, 0)) == 3
    want = {1: ("a", False, None, True), 2: ("b", False, "n", False), None: ("c", False, "n", False)}
    assert show() == want
    log.compact(spark)
    assert show() == want


def test_pages_by_rank_read_one_range(spark):
    table = spark.range(0, 5_000, 1, 8).select("id", F.pmod(F.xxhash64("id"), F.lit(97)).alias("v"))
    view = review.Review(table, "id", size=30).sorted_by("v")
    pages = view.indexed()
    assert pages.count() == view.pages() == 167
    for n in (0, 5, 90, 166, 10**6, -3):
        assert rows(pages.page(n)) == rows(view.at(n).shown())
        assert [r["id"] for r in pages.page(n).collect()] == [r["id"] for r in view.at(n).shown().collect()]
    plan = pages.page(90)._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "Offset" not in plan
    none = review.Review(table.limit(0), "id").indexed()
    assert none.count() == 0 and none.page(3).count() == 0


def test_quoted_files_in_ranges_equal_the_plain_reader(spark, tmp_path):
    import random

    rng = random.Random(6)
    cell = lambda: rng.choice(["a", "", 'say "x"', "two\nlines", '"\n"\n', "tab\tin", "NULL", "é" * 9, "\n\n", "x" * 60])
    data = [(str(k), cell(), cell(), rng.random() < 0.5) for k in range(900)]
    table = spark.createDataFrame(data, "TrialId string, Description string, Notes string, Checked boolean")
    at = str(tmp_path / "t")
    files.write_review(table.coalesce(1), at)
    files.write_review(spark.createDataFrame(data[:40], table.schema).coalesce(1), at + "2")
    (two,) = [p for p in (tmp_path / "t2").iterdir() if p.name.endswith(".csv")]
    two.rename(tmp_path / "t" / "part-9.csv")
    want = rows(files.read_review(spark, at))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("500", "3k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = files.read_review(spark, at, in_ranges=True)
            assert rows(got) == want
            if size == "500":
                from eligo.sources import ranges

                assert ranges._lines(spark, at).rdd.getNumPartitions() > 20
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ranges_of_a_large_review_file_stay_few(spark, tmp_path, monkeypatch):
    from eligo.queries import QUERIES
    from eligo.sources import ranges

    spark.range(60_000).selectExpr("id as c_custkey", "concat('Customer ', id) as c_name", "cast(id % 25 as int) as c_nationkey", "'BUILDING' as c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    surveyed, seen = ranges._surveyed, []
    monkeypatch.setattr(ranges, "_surveyed", lambda lines: seen.append(lines.rdd.getNumPartitions()) or surveyed(lines))
    got = QUERIES["review_in_ranges"](spark, str(tmp_path))
    assert len(seen) == 1 and 60 <= seen[0] <= 66
    assert got.count() == 60_000 and got.filter("Description like '%\\n%'").count() == 20_000


def test_a_header_of_many_lines_and_ranges_that_are_joined(spark, tmp_path, monkeypatch):
    from eligo.sources import ranges

    (tmp_path / "a.tsv").write_text("")
    (tmp_path / "b.tsv").write_text('"k"\t"two\nlines"\n1\t"x\ny"\n2\tz\n')
    (tmp_path / "c.tsv").write_text('"k"\t"two\nlines"\n3\t"\n"\n')
    want = [("1", "x\ny"), ("2", "z"), ("3", "\n")]
    for most in (0, 100_000):
        monkeypatch.setattr(ranges, "BROADCAST_ROWS", most)
        got = ranges.read_delimited(spark, str(tmp_path))
        assert got.columns == ["k", "two\nlines"] and rows(got) == want


def test_statements_and_rules_are_made_once(spark, tmp_path):
    docs = [(k, f"Inclusion criteria\n1. weight {k}\n2. age\n") for k in range(30)]
    spark.createDataFrame(docs, "doc_id int, text string").write.parquet(str(tmp_path / "docs"))
    told = [("sanitise", "2. age", "age"), ("tag", "age", '[{"input_rule": "age", "exclude": false}]')]
    cache = spark.createDataFrame(told, "s string, u string, response string")
    cache = cache.select(models.prompt_key("m", F.col("s"), F.col("u")).alias("prompt_sha"), "response")
    out = curation.grouped_rules(spark.read.parquet(str(tmp_path / "docs")), models.Asker(cache))
    plans = out._jdf.queryExecution()
    assert "Relation" not in plans.optimizedPlan().toString()
    assert "BroadcastExchange" not in plans.executedPlan().toString()
    got = {(r["doc_id"], r["statement_id"]): [(c["input_rule"], len(c["errors"])) for c in r["curations"]] for r in out.collect()}
    assert got == {(k, i): x for k in range(30) for i, x in (("I-01", [(f"1. weight {k}", 2)]), ("I-02", [("age", 0)]))}


def test_texts_of_many_lines(spark):
    data = [("a",), ("",), (None,), ("a\n",), ("a\n \n",), ("a\nb",), ("a b",), ("\r\na\r\n\r\nb",), (" \n\t",)]
    got = spark.createDataFrame(data, "v string").select(text.many_lines(F.col("v"))).collect()
    assert [bool(r[0]) for r in got] == [False, False, False, False, False, True, True, True, False]
