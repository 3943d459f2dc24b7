"""Rule trees: AND, OR and NOT over rules with parameters, held as JSON text so that 3 and 3.0 stay apart.

Trees nest without bound, which no Spark type expresses, so the walks are Arrow UDFs over the raw JSON. A tree that
cannot be read (no JSON, or nested deeper than Python follows) fails no task: its result is null, and
:func:`unreadable` says why."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eligo.functions.lenient import _results, _texts, as_json, or_null, whole

GROUPS = ("AND", "OR")


def _nested(params: list) -> bool:
    return any(isinstance(p, (dict, list)) for p in params)


def _shown(tree) -> str:
    match tree:
        case str():
            return tree.replace("[]", "")
        case list():
            return f"[{', '.join(map(repr, tree))}]"
        case dict() if len(tree) == 1:
            (name, body), = tree.items()
        case _:
            raise ValueError(f"neither a rule nor a group of rules: {tree!r}")
    match name, body:
        case ("AND" | "OR"), _:
            return f"{name}({', '.join(map(_shown, body))})"
        case "NOT", _:
            return f"NOT({_shown(body)})"
        case _, []:
            return name
        case _, list() if not _nested(body):
            return name + _shown(body)
        case _, (dict() | list()):
            return f"{name}({_shown(body)})"
    raise ValueError(f"parameters of {name} are no list: {body!r}")


def _named(tree) -> set[str]:
    """Names that stand where rule names belong."""
    match tree:
        case str():
            return {tree.split("[")[0].strip()}
        case list():
            return set().union(*map(_named, tree))
        case dict():
            out: set[str] = set()
            for name, body in tree.items():
                group = name in GROUPS or name == "NOT"
                if not group:
                    out.add(name)
                if group or isinstance(body, dict) or isinstance(body, list) and _nested(body):
                    out |= _named(body)
            return out
    return set()


def _hollow(tree) -> bool:
    match tree:
        case None:
            return True
        case str():
            return not tree.strip()
        case list():
            return all(map(_hollow, tree))
        case dict() if not tree:
            return True
        case dict() if len(tree) == 1:
            (name, body), = tree.items()
            if name in GROUPS:
                return not isinstance(body, list) or all(map(_hollow, body))
            return name == "NOT" and _hollow(body)
    return False


def _normal(tree):
    """Bare rules as rules without parameters, lone parameters as lists, at every level."""
    match tree:
        case str():
            return {tree.removesuffix("[]"): []}
        case list():
            return [_normal(t) for t in tree]
        case dict():
            out = {}
            for name, body in tree.items():
                if name in GROUPS or name == "NOT" or isinstance(body, dict):
                    out[name] = _normal(body)
                else:
                    out[name] = body if isinstance(body, list) else [body]
            return out
    return tree


def _without(tree, field: str):
    match tree:
        case list():
            return [_without(t, field) for t in tree]
        case dict():
            return {k: _without(v, field) for k, v in tree.items() if k != field}
    return tree


def rendered(tree: Column) -> Column:
    """struct<json, error>: the tree on one line, as in AND(A, NOT(B[1.5])); an error for shapes without meaning."""
    return _results(lambda t: _shown(json.loads(t)))(tree)


def unreadable(tree: Column) -> Column:
    """Why a tree cannot be read; null if it can."""
    return _results(lambda t: str(bool(_named(json.loads(t)))))(tree)["error"]


def normalised(tree: Column) -> Column:
    return _texts(lambda t: as_json(_normal(json.loads(t))))(tree)


def without_field(tree: Column, field: str) -> Column:
    """The JSON without ``field`` at any depth, as canonical text; equal trees have equal text."""
    return _texts(lambda t: as_json(_without(json.loads(t), field)))(tree)


def rule_names(tree: Column) -> Column:
    """Sorted distinct names used as rules; compare with a catalogue by join or array_except."""

    @arrow_udf("array<string>")
    def run(trees: pa.Array) -> pa.Array:
        return pa.array(list(map(or_null(lambda t: [whole(n) for n in sorted(_named(json.loads(t)))]), trees.to_pylist())), pa.list_(pa.string()))

    return run(tree)


def is_hollow(tree: Column) -> Column:
    """Whether nothing but groups is in the tree; true for null, null for a tree that cannot be read."""

    @arrow_udf("boolean")
    def run(trees: pa.Array) -> pa.Array:
        one = or_null(lambda t: not t.strip() or _hollow(json.loads(t)))
        return pa.array([t is None or one(t) for t in trees.to_pylist()], pa.bool_())

    return run(tree)


def blank_if_hollow(tree: Column) -> Column:
    return F.when(is_hollow(tree), "").otherwise(tree)
