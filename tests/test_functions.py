import json

import pytest
from pyspark.sql import functions as F

from eligo.functions import criteria, lenient, text, trees
from eligo.functions.lenient import Scanner, arithmetic, lenient_value


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("x")).first()["x"]


def test_tagged_pieces_and_batches(spark):
    v = " INCLUDE a\n  - b\nEXCLUDE c\n EXCLUDE d\nINCLUDE e "
    pieces = one(spark, text.tagged_pieces, v)
    assert pieces == ["INCLUDE a\n  - b", "EXCLUDE c\n EXCLUDE d", "INCLUDE e"]
    assert one(spark, lambda c: text.batches_by_count(c, 2), v) == ["\n".join(pieces[:2]), pieces[2]]
    assert one(spark, text.tagged_pieces, "") == []


def greedy(pieces, most):
    out, now, n = [], [], 0
    for p in pieces:
        k = len(p.split())
        if n + k < most:
            now, n = [*now, p], n + k
        else:
            out, now, n = [*out, "\n".join(now)], [p], k
    return [*out, "\n".join(now)]


@pytest.mark.parametrize("most", [2, 3, 5, 8, 100])
def test_batches_by_words(spark, most):
    v = "INCLUDE a b c\nEXCLUDE d\nEXCLUDE e f g h i\nINCLUDE j"
    assert one(spark, lambda c: text.batches_by_words(c, most), v) == greedy(v.split("\n"), most)
    assert one(spark, lambda c: text.batches_by_words(c, most), "") == [""]


def test_parent_statements(spark):
    v = "1. lost\nInclusion criteria\n- lost\n1. a\n\n  2. child\r\n2) b\x0bmore\n3.no\n٣) c\nexclusion Criteria:\n100. d\n1. e\n"
    rows = text.parent_statements(spark.createDataFrame([(1, v), (2, "Inclusion criteria\n- a\n- b"), (3, None)], "doc_id int, text string")).orderBy("doc_id", "seq").collect()
    got = [(r["doc_id"], r["seq"], r["statement_id"], r["statement"]) for r in rows]
    assert got == [(1, 1, "I-01", "1. a\n\n  2. child"), (1, 2, "I-02", "2) b\nmore\n3.no"), (1, 3, "I-03", "٣) c"), (1, 4, "E-100", "100. d"), (1, 5, "E-01", "1. e")]


def test_statements_of_rows_that_share_a_key(spark):
    v = "Inclusion criteria\n1. a\n2. b"
    df = spark.createDataFrame([(1, v), (1, v.replace(". a", ". c")), (None, v), (None, v)], "doc_id int, text string")
    found = text.parent_statements(df)
    assert sorted((r["doc_id"] or 0, r["seq"], r["statement"]) for r in found.collect()) == sorted([(1, 1, "1. a"), (1, 2, "2. b"), (1, 1, "1. c"), (1, 2, "2. b")] + [(0, 1, "1. a"), (0, 2, "2. b")] * 2)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    long_ = "Inclusion criteria\n" + "\n".join(f"{k}. rule\n - point" for k in range(3_000))
    assert text.parent_statements(spark.createDataFrame([(1, long_)], "doc_id int, text string")).count() == 3_000


def test_small_text_functions(spark):
    assert one(spark, lambda c: text.code_blocks(c, "json"), "a ```json[1,``` b ```json2]```") == "[1,2]"
    assert one(spark, lambda c: text.code_blocks(c, "json"), "plain") == "plain"
    assert one(spark, text.document_id, "x\n  trial id :  AB  12 \n") == "AB_12"
    assert one(spark, text.document_id, "nothing") is None
    assert one(spark, text.many_lines, " a \n\n") is False
    assert one(spark, text.many_lines, "a\nb") is True
    assert one(spark, text.unescaped, r"\'\"\n\[\]\<\>\\") == "'\"\n[]<>\\\\"
    assert one(spark, text.bare_criteria, "from a import b\n\ncriteria: List[BaseCriterion] = [\n  A(),\n]") == "A(),"
    for cell, want in [("TRUE", True), (" yes ", True), ("1", True), ("1.0", True), ("0", False), ("", False), (None, False), ("no", False)]:
        assert one(spark, text.truthy, cell) is want


def test_warn_instead_of_not(spark):
    go = lambda v: one(spark, lambda c: text.warn_instead_of_not(c, ["A", "A_B"]), v)
    assert go("NOT(A)") == "WARN_IF(A)"
    assert go("NOT (A_B[1, 2] )") == "WARN_IF (A_B[1, 2] )"
    assert go("IS_NOT(A) NOT(OR(A, B)) NOT(C)") == "IS_NOT(A) NOT(OR(A, B)) NOT(C)"
    assert one(spark, lambda c: text.warn_instead_of_not(c, []), "NOT(A)") == "NOT(A)"


@pytest.mark.parametrize(
    "given, want",
    [
        ('{"a": [1, 2.5, true, null], "b": "x"}', {"a": [1, 2.5, True, None], "b": "x"}),
        ('{"a": {"B"}}', {"a": "B"}),
        ('{"a": "b": [1]}', {"a": {"b": [1]}}),
        ("[5+5, 20 // 2, 6 / 2, 7 % 4, (1+2)*3]", [10, 10, 3.0, 3, 9]),
        ('[{"a": 1, {"b": 2}]', [{"a": 1}, {"b": 2}]),
        ('[{"a": 1]', [{"a": 1}]),
        ('"open', "open"),
        ('"a\\"b\\n"', 'a"b\n'),
        ('"a\\\nb"', "a\nb"),
        ('{"a": 1, "a": 2} rest', {"a": 2}),
    ],
)
def test_lenient_value(given, want):
    assert lenient_value(Scanner(given)) == want
    assert repr(lenient_value(Scanner(given))) == repr(want)


@pytest.mark.parametrize("given", ['{"A", "B"}', "[1,]", "{a: 1}", "[x]", "", "[1 2", "2**99999"])
def test_lenient_errors(given):
    with pytest.raises(ValueError):
        lenient_value(Scanner(given))


def test_errors_show_their_place():
    with pytest.raises(ValueError) as error:
        lenient_value(Scanner('[1,\n 2,\n 3,\n  x]'))
    assert str(error.value) == "line 4, column 4: expected a value\n 2,\n 3,\n  x]\n   ^"


def test_arithmetic_is_safe():
    assert arithmetic("-3 + 2*(4 - 1)") == 3
    for bad in ("__import__('os')", "1/0", "a+1", "'x'*9", "9**9**9"):
        with pytest.raises(ValueError):
            arithmetic(bad)


def test_repairs(spark):
    assert one(spark, lenient.repaired, '[{ "K" }, "a": "R[]", "b": "R": [1], "c": "NOT": "S"]') == '["K", "a": {"R": []}, "b": {"R": [1]}, "c": {"NOT": "S"}]'
    assert one(spark, lenient.arithmetic_folded, '{"a": 5 + 5, "b": [2*3, "1+1"], "c": 1/0}') == '{"a": 10, "b": [6, "1+1"], "c": 1/0}'
    got = one(spark, lenient.first_parse, '{"a": "b": ["x"], "c": 1+1}')
    assert json.loads(got["json"]) == {"a": {"b": ["x"]}, "c": 2}
    assert one(spark, lenient.first_parse, "nothing")["json"] is None
    assert one(spark, lenient.first_parse, None) == (None, None)


@pytest.mark.parametrize(
    "given, want",
    [
        ('{"a": "b": "c": {"d": "e": 1}, "f": 2}', '{"a": {"b": {"c": {"d": {"e": 1}}}}, "f": 2}'),
        ('{"a": "b": "c"', '{"a": {"b": "c"}'),
        ('{"a": "b": [1, "x": "y": 2]}', '{"a": {"b": [1, "x": {"y": 2}]}}'),
        ('[ {"only"} , { "x" : 1 } ]', '[ "only" , { "x" : 1 } ]'),
        ('{"a": "{ \\"K\\" }, 1 + 1", "b": "x: y"}', '{"a": "{ \\"K\\" }, 1 + 1", "b": "x: y"}'),
        ('{"a": 2 * (3 + 4) , "b": [-1, 1e5, 0.50, 7 // 2]}', '{"a": 14 , "b": [-1, 1e5, 0.50, 3]}'),
        ('{"a": 1/0, "b": 9**9, "c": 1e308 * 10, "d": NaN, "e": word}', '{"a": 1/0, "b": 9**9, "c": 1e308 * 10, "d": NaN, "e": word}'),
        ('{"a": "[]", "b": "R[]"}', '{"a": "[]", "b": {"R": []}}'),
        ('} ] , "', '} ] , "'),
        ("", ""),
    ],
)
def test_mended(given, want):
    assert lenient.mended(given) == want


def test_nothing_that_cannot_be_written_stops_a_task(spark):
    """Halves of characters, NaN and infinity beside a good row, in every reader and writer."""
    half, both = "\\ud83d", "\\ud83d\\ude00"
    rows = ['{"a": "%s"}' % half, '{"a": "%s"}' % both, '{"a": NaN}', '{"a": 1e999}', '{"a": -Infinity}', '{"%s": ["%s"]}' % (half, half), '{"a": 1}', None]
    df = spark.createDataFrame([(r,) for r in rows], "v string").coalesce(1)
    good = [None, '{"a": "😀"}', None, None, None, None, '{"a": 1}', None]
    for read in (lenient.first_parse, lenient.lenient_json):
        got = [r["x"] for r in df.select(read(F.col("v")).alias("x")).collect()]
        assert [g["json"] for g in got] == good and [g["error"] is None for g in got] == [g is not None for g in good[:-1]] + [True]
    for f in (lenient.repaired, lenient.arithmetic_folded, trees.normalised, trees.rule_names, trees.blank_if_hollow, lambda c: trees.rendered(c)["json"], lambda c: trees.without_field(c, "b"), criteria.written, criteria.python_text):
        assert df.select(f(F.col("v")).alias("x")).count() == len(rows) and len(df.select(f(F.col("v")).alias("x")).collect()) == len(rows)
    texts = ['Other(reason="%s")' % half, 'Other(reason="%s")' % both, "Age(age=1e999)", 'Age(age="%s")' % half]
    df = spark.createDataFrame([(x,) for x in texts], "v string").coalesce(1)
    for read in (criteria.parsed, criteria.analysed):
        got = [r["x"] for r in df.select(read(F.col("v")).alias("x")).collect()]
        assert [g["json"] is not None for g in got] == [False, True, False, False] and json.loads(got[1]["json"])["reason"] == "😀"


def test_trees(spark):
    show = lambda v: one(spark, trees.rendered, v)["json"]
    assert show('{"AND": [{"A": []}, {"NOT": {"B": [3.0, 1, "x"]}}, "C[]"]}') == "AND(A, NOT(B[3.0, 1, 'x']), C)"
    assert show('{"A": {"OR": ["B", "C"]}}') == "A(OR(B, C))"
    assert show('{"A": 1}') is None and show('{"A": [], "B": []}') is None and show("1") is None
    names = lambda v: one(spark, trees.rule_names, v)
    assert names('{"AND": [{"A": ["p"]}, {"NOT": "B[1]"}, {"C": [{"D": []}]}]}') == ["A", "B", "C", "D"]
    hollow = {"null": True, '" "': True, "[]": True, "{}": True, '{"AND": [{}, {"NOT": ""}]}': True, '{"A": []}': False, "1": False, '{"AND": 1}': True}
    assert {v: one(spark, trees.is_hollow, v) for v in hollow} == hollow
    assert one(spark, trees.normalised, '{"AND": ["A", {"B": 1}, {"NOT": "C[]"}]}') == '{"AND": [{"A": []}, {"B": [1]}, {"NOT": {"C": []}}]}'
    assert one(spark, lambda c: trees.without_field(c, "d"), '{"a": [{"d": 1, "b": 2}]}') == '{"a": [{"b": 2}]}'


CODE = 'And(description="all") { Age(age=18, operator=">="), If { Sex(sex="male") } then { Other } else { Timing(window_days=IntRange(min_inclusive=-7)) { Symptom(symptom="a \\"b\\" \\\\") } } }'


def test_criteria_round_trip(spark):
    node = one(spark, criteria.parsed, CODE)["json"]
    code = spark.createDataFrame([(node,)], "v string").select(criteria.written(F.col("v")).alias("x")).first()["x"]
    assert one(spark, criteria.parsed, code)["json"] == node
    assert one(spark, criteria.node_types, node) == sorted(["And", "Age", "If", "Sex", "Other", "Timing"])
    assert one(spark, lambda c: criteria.node_types(c, True), node) == sorted(["And", "Age", "If", "Sex", "Other", "Timing", "Symptom"])


@pytest.mark.parametrize(
    "bad",
    ['Age(age="abc", operator=">=")', 'Age(age=1.5, operator=">=")', 'Age(age=true, operator=">=")', 'PriorTreatment(treatment="x")', "TreatmentOption(treatment=Medication())", "Metastases(location=[1])",
     "TreatmentOption(treatment=Treatment(treatment=1))", 'Metastases(location="a", additional_details=[1])', "Other(description=null)", "TreatmentOption(treatment=IntRange())", 'Histology(histology_type="a", histology_grade=2)',
     "LabValue(measurement=\"m\", unit=\"u\", value=inf, operator=\"<\")", "PerformanceStatus(scale=\"E\", value_range=3)", "TissueAvailability(confidence=1.0)"],
)
def test_criteria_have_types(spark, bad):
    assert one(spark, criteria.parsed, bad)["json"] is None


def test_criteria_that_fit_their_types(spark):
    good = ['Age(age=30.0, operator="<")', "TreatmentOption(treatment=StandardOfCare())", 'PriorTreatment(treatment=SystemicTherapy(description="d"), number_of_prior_lines=IntRange(min_inclusive=1))', 'TreatmentOption(treatment=Medication(medications=["a", "b"], dosage=null))',
            'LabValue(measurement="m", unit="u", value=3, operator="near")', 'Metastases(location="C", size_cm=2, additional_details=["a"])', "ClinicalJudgement", 'Radiotherapy(x=1)']
    got = [one(spark, criteria.parsed, g) for g in good]
    assert [g["json"] is not None for g in got] == [True] * 7 + [False]
    assert json.loads(got[0]["json"])["age"] == 30 and json.loads(got[4]["json"])["value"] == 3.0
    for code in [CODE, *good[:7], "Nope", None]:
        a = one(spark, criteria.analysed, code)
        node = one(spark, criteria.parsed, code)["json"]
        assert a["json"] == node and a["code"] == one(spark, criteria.written, node) and a["types"] == (node and one(spark, criteria.node_types, node))
    deep = "Not { " * 5_000
    assert one(spark, criteria.parsed, deep)["json"] is None and one(spark, criteria.written, "{") is None and one(spark, criteria.node_types, "[1]") is None


@pytest.mark.parametrize("bad", ["Aged(age=1)", "Age(age=1)", 'Age(age=1, operator="=")', "Not { Other, Other }", "And { Other", "Other(x=1)", "If { Other }", "Sex(sex=)"])
def test_criteria_errors(spark, bad):
    got = one(spark, criteria.parsed, bad)
    assert got["json"] is None and "line 1" in got["error"]


def test_repeated_texts_are_read_once_within_a_bound(monkeypatch):
    asked = []
    read = lenient.Remembered(lambda t: asked.append(t) or (t, None))
    assert [read(t) for t in ("a", "b", "a", None, None)] == [("a", None), ("b", None), ("a", None), (None, None), (None, None)]
    assert asked == ["a", "b", None]
    monkeypatch.setattr(lenient, "REMEMBERED_CHARS", 20)
    for k in range(30):
        assert read("x" * k) == ("x" * k, None) and read.chars <= 20
