"""The packaged rules: declarative trees and Column functions."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.scalars import is_blank, nutrient, round2, set_id
from larder.operators.context import claim_unknown, family_sets, usable_set
from larder.operators.predicates import compiled, fields
from larder.types import INPUT_SET

EMISSIONS = "array<struct<raw_code:string,severity:string>>"


@dataclass
class Rule:
    id: str
    requires: list[str]
    emit: Callable[[], Column]  # array<struct<raw_code, severity>>; a null code stands for the id
    baseline: str = "legacy"
    jurisdictions: list[str] = field(default_factory=lambda: ["global"])
    language: str = "declarative"
    #: Of rules with one emission at most: its condition and severity, which ``emit`` puts in an array.
    test: Callable[[], Column] | None = None
    severity: str | None = None
    #: Of the packaged rules in functions: (condition, code or null, severity) of each emission that has a place of its own.  Spark
    #: compiles these and interprets what stands in a list function, so ``rest`` has (condition, list) of what is left beyond the places.
    places: Callable[[], list[tuple[Column, Column, Column]]] | None = None
    rest: Callable[[], list[tuple[Column, Column]]] | None = None


@dataclass
class ArrowRule:
    """A rule in Python: ``find`` gets the required fields of one row by path and gives (code or None, severity) pairs; variants come as JSON text."""

    id: str
    requires: list[str]
    find: Callable[[dict], list[tuple[str | None, str]]]
    baseline: str = "none"
    jurisdictions: list[str] = field(default_factory=lambda: ["global"])
    language: str = "python"


def when(condition: Column, severity: str) -> Column:
    """One emission where the condition holds."""
    one = F.array(F.struct(F.lit(None).cast("string").alias("raw_code"), F.lit(severity).alias("severity")))
    return F.when(condition, one).otherwise(F.array().cast(EMISSIONS))


def placed(rule_id: str, requires: list[str], places: Callable[[], list[tuple[Column, Column, Column]]], rest: Callable[[], list[tuple[Column, Column]]] | None = None, **more) -> Rule:
    """A rule by the places of its emissions; ``emit`` lists those that hold, and the rest."""

    def emit() -> Column:
        none = F.array().cast(EMISSIONS)
        each = [F.when(hit, F.array(F.struct(code.alias("raw_code"), severity.alias("severity")))).otherwise(none) for hit, code, severity in places()]
        return F.concat(*each, *[F.when(some, listed.cast(EMISSIONS)).otherwise(none) for some, listed in (rest() if rest else [])])

    return Rule(rule_id, requires, emit, places=places, rest=rest, **more)


def _one(test: Callable[[], Column], severity: str) -> Callable[[], list[tuple[Column, Column, Column]]]:
    return lambda: [(F.coalesce(test(), F.lit(False)), F.lit(None).cast("string"), F.lit(severity))]


def declarative(rule_id: str, severity: str, tree: dict, **more) -> Rule:
    return Rule(rule_id, fields(tree), lambda: when(compiled(tree), severity), test=lambda: compiled(tree), severity=severity, **more)


def pack(entries: list[dict], baseline: str = "none", jurisdictions: tuple[str, ...] = ("global",)) -> list[Rule]:
    """Rules of a user's pack: dicts with id, severity and when."""
    return [declarative(e["id"], e["severity"], e["when"], baseline=baseline, jurisdictions=list(jurisdictions)) for e in entries]


def rule(rule_id: str, requires: tuple[str, ...], baseline: str = "none", jurisdictions: tuple[str, ...] = ("global",)):
    """Decorator: a function without arguments that returns the emissions Column is a rule."""

    def wrap(emit: Callable[[], Column]) -> Rule:
        return Rule(rule_id, list(requires), emit, baseline, list(jurisdictions), "procedural")

    return wrap


def _f(path: str, op: str, value=None) -> dict:
    return {"field": path, "op": op} | ({} if value is None else {"value": value})


def _all(*trees: dict) -> dict:
    return {"all": list(trees)}


P, A = "product.", "nutrition.as_sold."

# Rule ids, severities, tags and thresholds.
DECLARATIVE = [
    ("en:main-language-code-missing", "bug", _f(P + "lc", "is_missing")),
    ("en:main-language-missing", "bug", _f(P + "lang", "is_missing")),
    ("en:main-language-unknown", "warning", _f(P + "lang", "eq", "xx")),
    ("en:code-missing", "bug", _f("code", "is_missing")),
    ("en:code-empty", "bug", _f("code", "eq", "")),
    ("en:created-missing", "bug", _f(P + "created_t", "is_missing")),
    ("en:created-zero", "bug", _f(P + "created_t", "eq", 0)),
    ("en:no-packaging-data", "info", _f(P + "packagings", "is_blank")),
    ("en:quantity-not-recognized", "warning", _all({"not": _f(P + "quantity", "is_blank")}, _f(P + "product_quantity", "is_blank"))),
    ("en:product-quantity-over-10kg", "warning", _f(P + "product_quantity", "gt", 10000)),
    ("en:nutrition-data-per-serving-serving-quantity-is-not-recognized", "warning", _all({"not": _f(P + "serving_size", "is_blank")}, _f(P + "serving_quantity", "is_blank"))),
    ("en:serving-quantity-defined-but-quantity-undefined", "warning", _all({"not": _f(P + "serving_quantity", "is_blank")}, _f(P + "product_quantity", "is_blank"))),
    ("en:serving-quantity-under-1g", "warning", _f(P + "serving_quantity", "lt", 1)),
    ("en:product-quantity-under-1g", "warning", _f(P + "product_quantity", "lt", 1)),
    ("en:serving-quantity-over-500g", "warning", _f(P + "serving_quantity", "gt", 500)),
    ("en:alcoholic-and-non-alcoholic-categories", "warning", _all(_f(P + "categories_tags", "contains", "en:alcoholic-beverages"), _f(P + "categories_tags", "contains", "en:non-alcoholic-beverages"))),
    ("en:incompatible-categories-plant-milk-and-dairy", "warning", _all(_f(P + "categories_tags", "contains", "en:plant-milks"), _f(P + "categories_tags", "contains", "en:dairies"))),
    ("en:no-fat-label-claim-but-fat-above-0.5", "warning", _all(_f(P + "labels_tags", "contains", "en:no-fat"), _f(A + "fat", "gt", 0.5))),
    ("en:saturated-fat-free-label-claim-but-fat-above-0.1", "warning", _all(_f(P + "labels_tags", "contains", "en:saturated-fat-free"), _f(A + "saturated_fat", "gt", 0.1))),
    ("en:sugar-free-label-claim-but-sugar-above-limitation", "warning", _all(_f("flags.is_european_product", "is_true"), _f(P + "labels_tags", "contains", "en:no-sugar"), _f(A + "sugars", "gt", 0.5))),
    ("en:no-added-sugar-label-claim-but-contains-added-sugar", "warning", _all(_f("flags.is_european_product", "is_true"), _f(P + "labels_tags", "contains", "en:no-added-sugar"), _f(P + "ingredients_tags", "contains", "en:added-sugar"))),
    ("en:ingredients-percent-analysis-not-ok", "warning", _f(P + "ingredients_percent_analysis", "lt", 0)),
    ("en:ingredients-percent-analysis-ok", "info", _f(P + "ingredients_percent_analysis", "gt", 0)),
    ("en:all-ingredients-with-specified-percent", "info", _all(_f(P + "ingredients_with_specified_percent_n", "gt", 0), _f(P + "ingredients_with_unspecified_percent_n", "eq", 0))),
    ("en:all-but-one-ingredient-with-specified-percent", "info", _f(P + "ingredients_with_unspecified_percent_n", "eq", 1)),
    ("en:sum-of-ingredients-with-unspecified-percent-lesser-than-10", "info", _all(_f(P + "ingredients_with_specified_percent_n", "gt", 0), _f(P + "ingredients_with_specified_percent_sum", "gte", 90), _f(P + "ingredients_with_unspecified_percent_sum", "lt", 10))),
    ("en:sum-of-ingredients-with-specified-percent-greater-than-100", "info", _all(_f(P + "ingredients_with_specified_percent_n", "gt", 0), _f(P + "ingredients_with_specified_percent_sum", "gt", 100))),
    ("en:sum-of-ingredients-with-specified-percent-greater-than-200", "warning", _all(_f(P + "ingredients_with_specified_percent_n", "gt", 0), _f(P + "ingredients_with_specified_percent_sum", "gt", 200))),
    ("en:product-name-to-be-completed", "completeness", _f(P + "product_name", "is_blank")),
    ("en:traceability-codes-to-be-completed", "completeness", _all(_f("flags.is_european_product", "is_true"), _f("flags.has_animal_origin_category", "is_true"), _f(P + "emb_codes", "is_blank"))),
    ("en:product-quantity-over-30kg", "error", _f(P + "product_quantity", "gt", 30000)),
    ("en:quantity-to-be-completed", "completeness", _f(P + "quantity", "is_blank")),
]
CANADA = [
    ("ca:source-of-fibre-claim-but-fibre-below-threshold", "warning", _all(_f(P + "labels_tags", "contains", "en:source-of-fibre"), _f(A + "fiber", "lt", 2))),
    ("ca:source-of-omega-3-polyunsaturates-claim-but-omega-3-below-threshold", "warning", _all(_f(P + "labels_tags", "contains", "en:source-of-omega-3-polyunsaturates"), _f(A + "omega_3", "lt", 0.3))),
]


def _has_label(tag: str) -> Column:
    return F.coalesce(F.array_contains("product.labels_tags", tag), F.lit(False))


def _levels(known: bool) -> list[tuple[Column, Column, Column]]:
    have = F.coalesce(F.when(F.size("product.food_groups_tags") >= 0, F.size("product.food_groups_tags")), F.lit(0))
    word = "known" if known else "unknown"
    return [(have >= i if known else have < i, F.lit(f"en:food-groups-{i}-{word}"), F.lit("info")) for i in (1, 2, 3)]


#: How many input sets of a row have places of their own; further ones are the rest.
PLACES = 4


def _in_place(test: Callable[[Column], list[tuple[str, Column]]]) -> list[tuple[Column, Column, Column]]:
    """Emissions of the first family sets and of the aggregated one, one for every (rest of the code, condition)."""
    out = []
    for i in range(PLACES):
        s = F.get(F.col("nutrition.input_sets"), F.lit(i))
        usable = s["nutrients"].isNotNull() & ~s["source"].eqNullSafe("estimate")
        code = lambda rest, s=s: F.concat(F.lit("en:"), set_id(s["source"], s["preparation"], s["per"]), F.lit(rest))
        out += [(usable & F.coalesce(hit, F.lit(False)), code(rest), F.lit("error")) for rest, hit in test(s["nutrients"])]
    last = F.col("nutrition.aggregated_set")["nutrients"]
    return out + [(last.isNotNull() & F.coalesce(hit, F.lit(False)), F.lit(f"en:nutrition{rest}"), F.lit("warning")) for rest, hit in test(last)]


def _listed(sets: Column, test: Callable[[Column], list[tuple[str, Column]]]) -> Column:
    """The same of a list of family sets."""

    def of_set(s: Column) -> Column:
        each = [
            F.struct(F.concat(F.lit("en:"), s["set_id"], F.lit(rest)).alias("raw_code"), s["severity"].alias("severity"), F.coalesce(hit, F.lit(False)).alias("hit"))
            for rest, hit in test(s["nutrients"])
        ]
        return F.transform(F.filter(F.array(*each), lambda e: e["hit"]), lambda e: F.struct(e["raw_code"], e["severity"]))

    return F.flatten(F.transform(sets, of_set))


def _beyond(test: Callable[[Column], list[tuple[str, Column]]]) -> tuple[Column, Column]:
    """The same of the input sets beyond the places."""
    sets = F.col("nutrition.input_sets")
    more = family_sets(F.slice(sets, PLACES + 1, F.greatest(F.size(sets) - PLACES, F.lit(0))), F.lit(None).cast(INPUT_SET))
    return F.size(sets) > PLACES, _listed(more, test)


def _energy(nutrients: Column) -> list[tuple[str, Column]]:
    out = []
    for unit, low in (("kj", 55), ("kcal", 13)):
        value, computed = nutrient(nutrients, f"energy-{unit}"), nutrient(nutrients, f"energy-{unit}", "value_computed")
        far = (computed < value * 0.7 - 5) | (computed > value * 1.3 + 5)
        out.append((f"-energy-value-in-{unit}-does-not-match-value-computed-from-other-nutrients", ~((value <= low) & (computed <= low)) & far))
    return out


_ABOVE = "-sugars-plus-starch-plus-fiber-greater-than-carbohydrates-total"


def _parts_and_total(nutrients: Column) -> tuple[Column, Column]:
    """The sum of the parts, and the total with its slack."""
    part = lambda n: F.coalesce(nutrient(nutrients, n), F.lit(0.0))
    total = nutrient(nutrients, "carbohydrates-total")
    return part("sugars") + part("starch") + part("fiber"), total + F.when(total >= 10, 0.1).otherwise(0.01)


def _carbohydrates(nutrients: Column) -> list[tuple[str, Column]]:
    a, b = _parts_and_total(nutrients)
    return [(_ABOVE, round2(a) > round2(b))]


def _far_above(nutrients: Column) -> list[tuple[str, Column]]:
    """Rounding keeps the order, and numbers over a hundredth apart don't round to the same, so far ones needn't be rounded."""
    a, b = _parts_and_total(nutrients)
    return [(_ABOVE, (a > b + 0.02) & (a < 2.0**30) & (b > -(2.0**30)))]


def _near(nutrients: Column) -> Column:
    """Above, but not far enough to say so unrounded."""
    a, b = _parts_and_total(nutrients)
    return F.coalesce((a > b) & ((a <= b + 0.02) | (a >= 2.0**30) | (b <= -(2.0**30))), F.lit(False))


def _near_carbohydrates() -> list[tuple[Column, Column]]:
    """Emissions of the sets in places that are near, rounded; and of the sets beyond."""
    sets, last = F.col("nutrition.input_sets"), F.col("nutrition.aggregated_set")
    some = functools.reduce(operator.or_, [_near(s["nutrients"]) for s in (*(F.get(sets, F.lit(i)) for i in range(PLACES)), last)])
    near = lambda n: [(rest, _near(n) & above) for rest, above in _carbohydrates(n)]
    return [(some, _listed(family_sets(F.slice(sets, 1, PLACES), last), near)), _beyond(_carbohydrates)]


def _omega_3() -> Column:
    nutrients = usable_set(F.col("nutrition.input_sets"))["nutrients"]
    ala, epa, dha = (nutrient(nutrients, n) for n in ("alpha-linolenic-acid", "eicosapentaenoic-acid", "docosahexaenoic-acid"))
    low = F.coalesce(ala < 0.3, F.lit(False)) | F.coalesce(epa + dha < 0.04, F.lit(False))
    return _has_label("en:source-of-omega-3") & low


def _trans_fat() -> Column:
    kcal, saturated, trans = (F.col(A + n) for n in ("energy_kcal", "saturated_fat", "trans_fat"))
    both = saturated + trans
    known = kcal.isNotNull() & saturated.isNotNull() & trans.isNotNull()
    bad = (trans >= 0.2) | (both > 2) | ((kcal > 0) & (F.try_divide(both * 9, kcal) * 100 > 15))
    return _has_label("en:trans-fat-free") & known & F.coalesce(bad, F.lit(False))


def _grade_mismatch() -> Column:
    made, told = F.col(P + "nutriscore_grade"), F.col(P + "nutriscore_grade_producer")
    return ~is_blank(made, "string") & ~is_blank(told, "string") & (made != told)


def _few_ingredients() -> Column:
    n = F.coalesce(F.size(F.try_variant_get(P + "ingredients", "$", "array<variant>")), F.lit(0))
    return (n > 0) & (n < F.col("category_props.minimum_number_of_ingredients"))


def _compare(test: Callable[[Column, Column], Column]) -> Column:
    return test(F.col(P + "serving_quantity"), F.col(P + "product_quantity"))


def _ignored() -> Column:
    return F.col("flags.ignore_energy_calculated_error").eqNullSafe(F.lit(True))


def packaged() -> list[Rule]:
    """All 45 rules, in order of id."""
    quantities = ["product.serving_quantity", "product.product_quantity"]
    sets = ["nutrition.input_sets", "nutrition.aggregated_set"]
    out = [declarative(*entry) for entry in DECLARATIVE]
    out += [declarative(*entry, baseline="none", jurisdictions=["ca"]) for entry in CANADA]
    own = [
        placed("en:food-groups-${level}-known", ["product.food_groups_tags"], lambda: _levels(True)),
        placed("en:food-groups-${level}-unknown", ["product.food_groups_tags"], lambda: _levels(False)),
        placed("en:serving-quantity-over-product-quantity", quantities, _one(lambda: _compare(lambda s, p: s > p), "warning")),
        placed("en:nutriscore-grade-producer-mismatch-nok", ["product.nutriscore_grade", "product.nutriscore_grade_producer"], _one(_grade_mismatch, "warning")),
        placed("en:serving-quantity-less-than-product-quantity-divided-by-1000", quantities, _one(lambda: _compare(lambda s, p: s < p / 1000), "warning")),
        placed("en:ingredients-count-lower-than-expected-for-the-category", ["category_props.minimum_number_of_ingredients", "product.ingredients"], _one(_few_ingredients, "error")),
        placed(
            "en:${set_id}-energy-value-in-${unit}-does-not-match-value-computed-from-other-nutrients", ["flags.ignore_energy_calculated_error", *sets],
            lambda: [(~_ignored() & hit, *more) for hit, *more in _in_place(_energy)], lambda: [(~_ignored() & some, listed) for some, listed in [_beyond(_energy)]],
        ),
        placed("en:${set_id}-sugars-plus-starch-plus-fiber-greater-than-carbohydrates-total", sets, lambda: _in_place(_far_above), _near_carbohydrates),
        placed("en:source-of-omega-3-label-claim-but-ala-or-sum-of-epa-and-dha-below-limitation", ["product.labels_tags", "nutrition.input_sets"], _one(_omega_3, "warning")),
        placed("en:vegan-label-but-could-not-confirm-for-all-ingredients", ["product.labels_tags", "product.ingredients"], _one(lambda: _has_label("en:vegan") & claim_unknown(F.col("product.ingredients"), "vegan"), "warning")),
        placed("ca:trans-fat-free-claim-but-nutrition-does-not-meet-conditions", ["product.labels_tags", A + "energy_kcal", A + "saturated_fat", A + "trans_fat"], _one(_trans_fat, "warning"), baseline="none", jurisdictions=["ca"]),
    ]
    for r in own:
        r.language = "procedural"
    return sorted(out + own, key=lambda r: r.id)
