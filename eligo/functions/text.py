"""Text segmentation and small text functions, all as native column expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Line ends as Python's splitlines() knows them (fixed values).
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


#: Decimal digits of other scripts, and what they mean.
DIGITS = [chr(c) for c in range(128, 0x10000) if unicodedata.category(chr(c)) == "Nd"]
MEANT = [str(unicodedata.decimal(c)) for c in DIGITS]


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` takes blanks only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def lines(text: Column) -> Column:
    """The text's lines; a final line end does not start one more."""
    cut = F.split(text, LINE_END)
    return F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def tagged_pieces(text: Column) -> Column:
    """Pieces that each begin with a line that starts with INCLUDE or EXCLUDE; trimmed, empty ones dropped."""
    cut = F.split(strip(text), r"(?m)(?=^(?:INCLUDE|EXCLUDE))")
    return F.filter(F.transform(cut, strip), lambda p: p != "")


def batches_by_count(text: Column, size: int) -> Column:
    """Tagged pieces, ``size`` to a batch, joined by newlines."""
    pieces = tagged_pieces(text)
    starts = F.when(F.size(pieces) > 0, F.sequence(F.lit(1), F.size(pieces), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.array_join(F.slice(pieces, k, size), "\n"))


def batches_by_words(text: Column, most: int) -> Column:
    """Tagged pieces filled greedily: one joins the open batch only while the words stay under ``most``.

    A first piece that is too long leaves an empty first batch, and no pieces give one empty batch."""
    sized = F.transform(tagged_pieces(text), lambda p: F.struct(p.alias("piece"), n_words(p).alias("n")))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("n"))

    def add(acc: Column, p: Column) -> Column:
        fits = acc["n"] + p["n"] < most
        return F.struct(
            F.when(fits, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.array_join(acc["open"], "\n")))).alias("done"),
            F.when(fits, F.concat(acc["open"], F.array(p["piece"]))).otherwise(F.array(p["piece"])).alias("open"),
            F.when(fits, acc["n"] + p["n"]).otherwise(p["n"]).alias("n"),
        )

    return F.aggregate(sized, start, add, lambda acc: F.concat(acc["done"], F.array(F.array_join(acc["open"], "\n"))))


def code_blocks(text: Column, lang: str) -> Column:
    """All bodies of fenced blocks of a language, joined without a separator; the text itself if there is none."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)```{lang}(.*?)```"), F.lit(1))
    return F.when(F.size(found) > 0, F.array_join(found, "")).otherwise(text)


def document_id(text: Column) -> Column:
    """The value of the first ``Trial ID:`` line, inner white space as underscores; null if there is none."""
    found = F.regexp_extract(text, r"(?im)^\s*Trial\s+ID\s*:\s*(.+?)\s*$", 1)
    return F.regexp_replace(F.when(found != "", found), r"(?U)\s+", "_")


def header_value(text: Column, label: str) -> Column:
    """What follows ``label:`` on its line, without blanks before it and a carriage return after it."""
    found = F.regexp_extract(text, rf"(?m)^{label}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def many_lines(text: Column) -> Column:
    """Whether more than one line is not blank. A text without a line end is not cut."""
    return F.when(~text.rlike(LINE_END), False).otherwise(F.size(F.filter(lines(text), lambda x: strip(x) != "")) > 1)


def unescaped(text: Column) -> Column:
    """Backslash escapes of quotes, newline, tab, angle and square brackets undone, in this order."""
    # fixed values: what is undone, in its order
    pairs = [("\\'", "'"), ('\\"', '"'), ("\\n", "\n"), ("\\t", "\t"), ("\\>", ">"), ("\\<", "<"), ("\\[", "["), ("\\]", "]")]
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def bare_criteria(code: Column) -> Column:
    """Curated code without import lines, blank lines, the list's opening line and its closing bracket."""
    drop = [r"(?m)^\s*(?:from|import)\s.*$", r"(?m)^\s*criteria\s*:\s*List\[\w+\]\s*=\s*\[\s*$", r"\]\s*$"]
    code = reduce(lambda t, p: F.regexp_replace(t, p, ""), drop, code)
    return strip(F.regexp_replace(code, r"(?m)^\s*\n", ""))


def statement_id(section: Column, number: Column) -> Column:
    """I-01, E-12, I-123: E for sections that begin with EXCL, else I; at least two digits."""
    letter = F.when(F.upper(section).startswith("EXCL"), "E").otherwise("I")
    return F.concat(letter, F.lit("-"), F.format_string("%02d", number))


def directed(rule: Column, exclude: Column) -> Column:
    return F.concat(F.when(exclude, "EXCLUDE ").otherwise("INCLUDE "), rule)


def direction_error(rule: Column, exclude: Column) -> Column:
    """Why a rule has no direction: its text or its flag is missing; null if it has one."""
    return F.when(exclude.isNull(), "the exclusion flag is no boolean").when(rule.isNull(), "the rule is no text")


def exclude_after_flip(exclude: Column, flipped: Column) -> Column:
    return F.when(flipped, False).otherwise(exclude)


def truthy(flag: Column) -> Column:
    """Whether a flag cell says yes: true, t, 1, yes or y in any case; blank and null do not."""
    cell = F.lower(strip(flag.cast("string")))
    number = F.coalesce(cell.try_cast("double") == 1, F.lit(False))
    return F.coalesce(cell.isin("true", "t", "1", "yes", "y"), F.lit(False)) | number


def warn_instead_of_not(expression: Column, flagged: list[str]) -> Column:
    """``NOT(R)`` as ``WARN_IF(R)`` where the parentheses hold one flagged rule and at most its parameters."""
    return warn_by_names(expression, F.array(*map(F.lit, flagged))) if flagged else expression


def warn_by_names(expression: Column, flagged: Column) -> Column:
    """The same with an array column of flagged rules, so that each row can have its own."""
    plain = F.transform(flagged, lambda r: F.regexp_replace(r, r"([^\w])", r"\\$1"))
    names = F.array_join(F.array_sort(plain, lambda a, b: F.length(b) - F.length(a)), "|")
    pattern = F.concat(F.lit(r"\bNOT(\s*)\((?=\s*(?:"), names, F.lit(r")\s*(?:\[[^\]]*\]\s*)?\))"))
    return F.when(F.size(flagged) > 0, F.regexp_replace(expression, pattern, F.lit("WARN_IF$1("))).otherwise(expression)


def parent_statements(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, seq, statement_id, section, number, statement: the numbered statements of each document.

    A line that begins with ``inclusion criteria`` or ``exclusion criteria`` opens a section, a line that begins with
    a number and ``.`` or ``)`` opens a statement, other lines belong to the open one. What precedes the first header
    and lines without an open statement are left out. Each row is cut by itself, with array functions: nothing is
    shuffled, and rows that share a key or have none stay apart. A null text has no statements."""
    rows = docs.select(F.col(key), lines(F.col(text)).alias("lines"))

    def opening(line: Column, at: Column) -> Column:
        head = F.lower(strip(line))
        section = F.when(head.startswith("inclusion criteria"), "INCLUSION").when(head.startswith("exclusion criteria"), "EXCLUSION")
        number = F.nullif(F.regexp_extract(line, r"(?U)^(\d+)[.)]\s+", 1), F.lit(""))
        return F.struct(at.alias("at"), section.alias("section"), F.when(section.isNull(), number).alias("number"))

    opens = F.filter(F.transform("lines", opening), lambda o: o["section"].isNotNull() | o["number"].isNotNull())
    rows = rows.withColumn("opens", opens)
    rows = rows.withColumn("sections", F.filter("opens", lambda o: o["section"].isNotNull()))

    def statement(o: Column, k: Column) -> Column:
        end = F.coalesce(F.try_element_at("opens", k + 2)["at"], F.size("lines"))
        section = F.try_element_at(F.filter("sections", lambda s: s["at"] < o["at"]), F.lit(-1))["section"]
        body = strip(F.array_join(F.slice("lines", o["at"] + 1, end - o["at"]), "\n"))
        number = F.translate(o["number"], "".join(DIGITS), "".join(MEANT)).try_cast("int")
        return F.struct(section.alias("section"), number.alias("number"), body.alias("statement"), o["number"].isNotNull().alias("numbered"))

    found = F.filter(F.transform("opens", statement), lambda p: p["numbered"] & p["section"].isNotNull() & (p["statement"] != ""))
    parts = rows.select(key, F.posexplode(found).alias("at", "part"))
    return parts.select(key, (F.col("at") + 1).alias("seq"), statement_id(F.col("part.section"), F.col("part.number")).alias("statement_id"), "part.section", "part.number", "part.statement")
