"""Predicate trees of declarative rules as two-valued boolean Columns.

A rule is {"all": [...]}, {"any": [...]}, {"not": ...} or {"field", "op", "value"}.  A missing
value makes every test false but the two tests for missing and blank.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.scalars import as_number, is_blank

# Types of the paths that rules may name.
NUMBERS = {
    *("created_t product_quantity serving_quantity nutriscore_score ingredients_percent_analysis ingredients_with_specified_percent_n "
      "ingredients_with_unspecified_percent_n ingredients_with_specified_percent_sum ingredients_with_unspecified_percent_sum "
      "minimum_number_of_ingredients energy_kcal fat saturated_fat trans_fat sugars fiber omega_3").split()
}
ARRAYS = {*"categories_tags labels_tags countries_tags ingredients_tags food_groups_tags packagings".split()}
BOOLEANS = {*"is_european_product has_animal_origin_category ignore_energy_calculated_error".split()}

_COMPARE: dict[str, Callable] = {"gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}
OPERATORS = ["is_missing", "is_blank", "is_true", "is_false", "eq", "ne", *_COMPARE, "contains", "in", "not_in"]


def kind_of(path: str) -> str:
    name = path.rpartition(".")[2]
    return "number" if name in NUMBERS else "array" if name in ARRAYS else "boolean" if name in BOOLEANS else "string"


def atom(path: str, op: str, value=None) -> Column:
    c, kind = F.col(path), kind_of(path)
    sure = lambda x: F.coalesce(x, F.lit(False))
    if op == "is_missing":
        return c.isNull()
    if op == "is_blank":
        return is_blank(c, kind)
    if op in ("is_true", "is_false"):
        return c.eqNullSafe(F.lit(op == "is_true"))
    if op in _COMPARE:
        x = c if kind == "number" else as_number(c.cast("string"))
        return sure(_COMPARE[op](x, F.lit(float(value))) & ~F.isnan(x))
    if op == "contains":
        return sure(F.array_contains(c, value)) if kind == "array" else F.lit(False)
    values = list(value) if op in ("in", "not_in") else [value]
    literals = [float(v) if kind == "number" and not isinstance(v, (str, bool)) else v for v in values]
    if kind == "number":
        literals = [v for v in literals if not isinstance(v, str)]
    same = c.isin(*literals) if literals else F.lit(False) & c.isNotNull()
    if kind == "number":
        same = same & ~F.isnan(c)
    return sure(same if op in ("eq", "in") else c.isNotNull() & ~same)


def compiled(tree: dict) -> Column:
    if "all" in tree:
        return functools.reduce(operator.and_, map(compiled, tree["all"]))
    if "any" in tree:
        return functools.reduce(operator.or_, map(compiled, tree["any"]))
    if "not" in tree:
        return ~compiled(tree["not"])
    return atom(tree["field"], tree["op"], tree.get("value"))


def fields(tree: dict) -> list[str]:
    """Paths that a tree reads, first seen first."""
    if "field" in tree:
        return [tree["field"]]
    parts = tree.get("all") or tree.get("any") or [tree["not"]]
    return list(dict.fromkeys(f for t in parts for f in fields(t)))


def problems(tree: dict, known: list[str]) -> list[str]:
    """What is wrong with a tree: unknown paths or operators, values that don't fit the path's type."""
    if "field" not in tree:
        parts = tree.get("all") or tree.get("any") or ([tree["not"]] if "not" in tree else [])
        return ["empty condition"] if not parts else [p for t in parts for p in problems(t, known)]
    path, op, value = tree["field"], tree["op"], tree.get("value")
    kind = kind_of(path)
    out = [f"unknown path {path}"] * (path not in known) + [f"unknown operator {op}"] * (op not in OPERATORS)
    out += [f"{op} needs a boolean path"] * (op in ("is_true", "is_false") and kind != "boolean")
    out += [f"{op} needs a number"] * (op in _COMPARE and not isinstance(value, (int, float)))
    out += [f"{op} needs an array path"] * (op == "contains" and kind != "array")
    out += [f"{op} needs a list"] * (op in ("in", "not_in") and not (isinstance(value, list) and value))
    return out
