"""Lenient parsing of model-written JSON.

The regular repairs are native; what needs a grammar runs in Arrow UDFs, a batch at a time. Errors are values: a row
that cannot be parsed has a null result and a message."""

from __future__ import annotations

import ast
import json
import operator
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

OPERATIONS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod, ast.USub: operator.neg, ast.UAdd: operator.pos}
PARSED = "struct<json: string, error: string>"


def arithmetic(text: str):
    """The value of + - * / // % and parentheses over numbers; ValueError for anything else. Powers are refused, since
    they can grow without bound."""

    def value(node):
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            return node.value
        if isinstance(node, ast.BinOp) and type(node.op) in OPERATIONS:
            return OPERATIONS[type(node.op)](value(node.left), value(node.right))
        if isinstance(node, ast.UnaryOp) and type(node.op) in OPERATIONS:
            return OPERATIONS[type(node.op)](value(node.operand))
        raise ValueError(f"no arithmetic: {text}")

    try:
        return value(ast.parse(text.strip(), mode="eval").body)
    except (SyntaxError, ZeroDivisionError, OverflowError, RecursionError) as e:
        raise ValueError(f"no arithmetic: {text}") from e


@lru_cache(maxsize=256)
def token(pattern: str) -> re.Pattern:
    return re.compile(r"\s*(" + pattern + ")")


class Scanner:
    """A cursor over a text. Regular tokens are taken by pattern, so a grammar is a few lines on top of it."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, what: str):
        """An error with its place, the lines up to it and a mark under it."""
        line = self.text.count("\n", 0, self.at)
        column = self.at - (self.text.rfind("\n", 0, self.at) + 1)
        shown = "\n".join(self.text.split("\n")[max(0, line - 2) : line + 1])
        raise ValueError(f"line {line + 1}, column {column + 1}: {what}\n{shown}\n{' ' * column}^")

    def take(self, pattern: str) -> str | None:
        """The next token if it fits, after white space."""
        m = token(pattern).match(self.text, self.at)
        if m:
            self.at = m.end()
            return m[1]
        return None

    def need(self, pattern: str, what: str) -> str:
        got = self.take(pattern)
        return self.fail(f"expected {what}") if got is None else got

    def sees(self, pattern: str) -> bool:
        return token(pattern).match(self.text, self.at) is not None

    def string(self) -> str | None:
        """A double-quoted string with backslash escapes; the end of the text may stand for the closing quote."""
        body = self.take(r'"[^"\\]*(?:\\(?s:.)[^"\\]*)*(?:"|\\?\Z)')
        if body is None:
            return None
        body = body[1:-1] if len(body) > 1 and body.endswith('"') and not re.search(r'(?<!\\)(?:\\\\)*\\"\Z', body) else body[1:]
        body = re.sub(r"\\(u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|.)", lambda m: json_escape(m[1]), body, flags=re.S)
        try:
            return whole(body)
        except ValueError as e:
            return self.fail(str(e))

    def many(self, close: str, item, implied: str | None = None) -> list:
        """Items up to ``close``, comma separated; ``implied`` is a lookahead that stands for a missing close."""
        out: list = []
        if self.take(close):
            return out
        while True:
            out.append(item())
            if self.take(close) or (implied and self.sees(implied)):
                return out
            self.need(",", "a comma or the end of a list")


def json_escape(code: str) -> str:
    plain = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "0": "\0"}
    return chr(int(code[1:], 16)) if len(code) > 1 else plain.get(code, code)


def lenient_value(s: Scanner):
    """A JSON value with the usual slips of models: chained keys, lone keys in braces, missing closing braces,
    arithmetic where numbers belong."""
    if s.sees('"'):
        return s.string()
    if s.take(r"\["):
        return s.many(r"\]", lambda: lenient_value(s))
    if s.take(r"\{"):
        return lenient_object(s)
    token = s.take(r"[\w.+\-*/()% ]*[\w.+\-*/()%]")
    if token in ("true", "false", "null"):
        return json.loads(token)
    if token is None or re.search(r"[A-Za-z_]", token):
        s.fail("expected a value")
    return arithmetic(token)


def lenient_object(s: Scanner):
    lone: list[str] = []
    pairs: dict = {}

    def member():
        key = s.string() if s.sees('"') else s.fail("expected a key")
        if not s.take(":"):
            if lone:  # one may stand for itself; which of two is meant cannot be told
                s.fail("expected a colon")
            lone.append(key)
            return
        value = lenient_value(s)
        if isinstance(value, str) and s.take(":"):  # k1: k2: v
            value = {value: lenient_value(s)}
        pairs[key] = value

    s.many(r"\}", member, implied=r",\s*\{|\]")
    return lone[-1] if lone else pairs


#: A string, a mark, white space, or a run of anything else up to the next mark.
PIECE = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|\s+|[^\s{}\[\]:,"][^{}\[\]:,"]*|"', re.S)
NUMBER = re.compile(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?")


def is_string(piece: str | None) -> bool:
    return piece is not None and len(piece) > 1 and piece[0] == piece[-1] == '"'


def mended(text: str, shapes: bool = True, sums: bool = True) -> str:
    """Near-JSON with what models get wrong put right; strings are never looked into, but for a rule's empty brackets.

    ``shapes``: a lone key in braces is the key; a value followed by a colon begins an object of its own, which ends where
    the value's own value ends; a value "R[]" is a rule without parameters. ``sums``: bare arithmetic becomes its value,
    if it has one."""
    pieces = PIECE.findall(text)
    solid = [k for k, p in enumerate(pieces) if not p.isspace()]
    follows = dict(zip(solid, solid[1:]))
    out, owed, before, skip = [], [0], None, -1
    for k, p in enumerate(pieces):
        if k <= skip:
            continue
        if p.isspace():
            out.append(p)
            continue
        after = follows.get(k)
        if p == "{" and shapes and after is not None and is_string(pieces[after]) and pieces[follows.get(after, k)] == "}":
            out.append(pieces[after])
            skip = follows[after]
        elif p in ("{", "["):
            owed.append(0)
            out.append(p)
        elif p in (",", "}", "]"):
            out.append("}" * owed[-1])
            owed[-1] = 0
            if p != "," and len(owed) > 1:
                owed.pop()
            out.append(p)
        elif shapes and before == ":" and is_string(p) and after is not None and pieces[after] == ":":
            owed[-1] += 1
            out.append("{" + p)
        elif shapes and before == ":" and is_string(p) and p.endswith('[]"') and len(p) > 4:
            out.append(f'{{{p[:-3]}": []}}')
        elif sums and before in (":", "[", ",") and p[0] != '"':
            out.append(folded(p))
        else:
            out.append(p)
        before = pieces[skip] if k < skip else p
    return "".join(out) + "}" * owed[-1]


def folded(run: str) -> str:
    """A bare run by its value, if it is arithmetic that has a finite one; white space after it stays."""
    body = run.rstrip()
    if NUMBER.fullmatch(body):
        return run
    try:
        return json.dumps(arithmetic(body), allow_nan=False) + run[len(body) :]
    except ValueError:
        return run


def refuse(constant: str):
    raise ValueError(f"{constant} is no JSON")


def strict(text: str):
    return json.loads(text, parse_constant=refuse)


def as_json(value) -> str:
    """A value as JSON; an error for numbers and characters that JSON text cannot hold."""
    return whole(json.dumps(value, ensure_ascii=False, allow_nan=False))


def whole(text: str) -> str:
    """The text, halves of a character that meet joined; an error if a half stands alone."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        try:
            return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le")
        except UnicodeDecodeError as e:
            raise ValueError("half of a character stands alone") from e


#: What a walk over JSON of another shape than it expects raises.
UNREADABLE = (ValueError, RecursionError, TypeError, KeyError, AttributeError)


def or_null(one):
    """``one`` with null for null and for what it cannot read."""

    def tried(text):
        try:
            return None if text is None else one(text)
        except UNREADABLE:
            return None

    return tried


#: Characters and texts that one task's memory of results holds; when they are reached it starts anew.
REMEMBERED_CHARS, REMEMBERED_TEXTS = 8_000_000, 50_000


class Remembered:
    """``one``, asked once about each text for as long as its task remembers it; texts repeat a lot in rule tables."""

    def __init__(self, one):
        self.one, self.known, self.chars = one, {}, 0

    def __call__(self, t):
        if t in self.known:
            return self.known[t]
        out = self.one(t)
        size = sum(len(x) for x in (t, *(out if isinstance(out, tuple) else (out,))) if x)
        if self.chars + size > REMEMBERED_CHARS or len(self.known) >= REMEMBERED_TEXTS:
            self.known, self.chars = {}, 0
        if size <= REMEMBERED_CHARS:
            self.known[t] = out
            self.chars += size
        return out


def _texts(one):
    read = Remembered(or_null(lambda t: whole(one(t))))

    @arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(list(map(read, texts.to_pylist())), pa.string())

    return run


def _results(one):
    def result(t):
        try:
            return (None if t is None else whole(one(t))), None
        except UNREADABLE as e:
            return None, str(e) or type(e).__name__

    read = Remembered(result)

    @arrow_udf(PARSED)
    def run(texts: pa.Array) -> pa.Array:
        values, errors = zip(*map(read, texts.to_pylist())) if len(texts) else ((), ())
        return pa.StructArray.from_arrays([pa.array(values, pa.string()), pa.array(errors, pa.string())], ["json", "error"])

    return run


def repaired(text: Column) -> Column:
    """Near-JSON with lone keys, empty rules and key chains put right."""
    return _texts(lambda t: mended(t, sums=False))(text)


def arithmetic_folded(text: Column) -> Column:
    """Near-JSON with bare arithmetic by its value."""
    return _texts(lambda t: mended(t, shapes=False))(text)


def lenient_json(text: Column) -> Column:
    """struct<json, error>: the value as canonical JSON. Text after the value is ignored, the last of equal keys wins."""
    return _results(lambda t: as_json(lenient_value(Scanner(t))))(text)


#: The readers of a text, the strictest first.
READERS = (strict, lambda t: strict(mended(t)), lambda t: lenient_value(Scanner(t)))


def first_parse(text: Column) -> Column:
    """struct<json, error> of the first that parses: the text itself, its mended form, its lenient reading.

    One UDF tries them in turn, since Spark runs every UDF of an expression for every row."""

    def read(t):
        for k, reader in enumerate(READERS):
            try:
                return as_json(reader(t))
            except (ValueError, RecursionError):
                if k + 1 == len(READERS):
                    raise

    return _results(read)(text)
