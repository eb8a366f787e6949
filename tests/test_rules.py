import json

import pytest
from pyspark.sql import functions as F

from larder import api
from larder.operators import context as cx
from larder.operators import findings as fi
from larder.operators import parity as pa
from larder.operators.predicates import atom, compiled, problems
from larder.operators.rules import pack, packaged


def rows_of(spark, *rows):
    names = sorted({k for r in rows for k in r})
    kinds = {n: "double" if n.endswith("_100g") else "string" for n in names}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def found(spark, *rows, **filters):
    return {(r.product_id, r.check_id) for r in api.run_checks(rows_of(spark, *rows), **filters).collect()}


def test_counts():
    rules = packaged()
    assert len(rules) == 45 and len({r.id for r in rules}) == 45
    assert len(fi.select_rules(rules, paths=cx.SOURCE_PATHS)) == 24
    assert len(fi.select_rules(rules, jurisdictions=["ca"])) == 3


def test_serving_over_product(spark):
    got = found(spark, {"code": "1", "serving_quantity": "150", "product_quantity": "100"}, {"code": "2", "serving_quantity": "100", "product_quantity": " 1_00 "})
    name = "en:serving-quantity-over-product-quantity"
    assert ("1", name) in got and ("2", name) not in got


def test_canada(spark):
    base = {"labels_tags": "en:trans-fat-free", "energy-kcal_100g": 100.0, "saturated-fat_100g": 1.0, "trans-fat_100g": 0.1}
    got = found(spark, base | {"code": "a"}, base | {"code": "b", "trans-fat_100g": 0.2}, base | {"code": "c", "saturated-fat_100g": 1.7}, base | {"code": "d", "energy-kcal_100g": 0.0}, base | {"code": "e", "trans-fat_100g": None}, jurisdictions=["ca"])
    assert {c for c, _ in got} == {"b", "c"}


def test_missing_blank_and_equality(spark):
    row = spark.createDataFrame([("", None, [], True)], "quantity string, lang string, labels_tags array<string>, is_european_product boolean")
    shaped = row.select(F.struct("quantity", "lang", "labels_tags").alias("product"), F.struct("is_european_product").alias("flags"))
    tests = [
        (("product.lang", "is_missing"), True), (("product.lang", "is_blank"), True), (("product.lang", "eq", "x"), False), (("product.lang", "ne", "x"), False),
        (("product.lang", "not_in", ["x"]), False), (("product.quantity", "is_blank"), True), (("product.labels_tags", "is_blank"), True),
        (("flags.is_european_product", "is_true"), True), (("flags.is_european_product", "is_false"), False),
    ]
    got = shaped.select(*[atom(*t).alias(str(i)) for i, (t, _) in enumerate(tests)]).first()
    assert list(got) == [want for _, want in tests]


def test_nan_compares_false(spark):
    one = spark.createDataFrame([(float("nan"),)], "fat double").select(F.struct(F.struct("fat").alias("as_sold")).alias("nutrition"))
    for op in ("gt", "gte", "lt", "lte", "eq", "ne"):
        assert one.select(atom("nutrition.as_sold.fat", op, 1)).first()[0] is (op == "ne")


def test_problems_and_selection():
    assert problems({"field": "nope", "op": "gt", "value": "x"}, cx.ENRICHED_PATHS) == ["unknown path nope", "gt needs a number"]
    assert problems({"all": []}, []) == ["empty condition"]
    assert problems({"not": {"field": "product.labels_tags", "op": "contains", "value": "x"}}, cx.ENRICHED_PATHS) == []
    with pytest.raises(ValueError):
        api.list_checks(ids=["en:main-language-missing"])
    with pytest.raises(ValueError):
        api.list_checks(ids=["nope"])


def test_no_rule_is_null_and_no_python_in_the_plan(spark):
    rows = rows_of(spark, {"code": "1"}, {"code": None, "product_name": ""})
    out = fi.evaluate(cx.project_source(api.prepare(rows)), fi.select_rules(paths=cx.SOURCE_PATHS))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert out.where("check_id is null or severity is null").count() == 0


def test_custom_pack(spark):
    rules = pack([{"id": "x:y", "severity": "bug", "when": {"not": {"field": "product.quantity", "op": "is_blank"}}}])
    got = api.run_checks(rows_of(spark, {"code": "1", "quantity": "5 g"}, {"code": "2", "quantity": " "}), rules=rules).collect()
    assert [(r.product_id, r.check_id, r.severity, r.emitted_code) for r in got] == [("1", "x:y", "bug", None)]
    tree = {"any": [{"field": "product.quantity", "op": "eq", "value": "q"}, {"field": "code", "op": "in", "value": ["2"]}]}
    assert rows_of(spark, {"code": "2", "quantity": "z"}).select("code", F.struct("quantity").alias("product")).where(compiled(tree)).count() == 1


def observed(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id string, check_id string, observed_code string, severity string")


@pytest.mark.parametrize("n_ref,n_mig,want", [(0, 2, (0, 0, 2)), (2, 1, (1, 1, 0)), (1, 1, (1, 0, 0))])
def test_multiset_difference(spark, n_ref, n_mig, want):
    one = ("p", "r", "c", "bug")
    ref = observed(spark, *[one] * n_ref) if n_ref else observed(spark, one).limit(0)
    (row,) = pa.difference(ref, observed(spark, *[one] * n_mig)).collect()
    assert (row.matched, row.missing, row.extra) == want


def test_examples_are_capped_and_counts_exact(spark):
    ref = observed(spark, ("p1", "en:code-empty", "c", "bug"), ("p2", "en:code-empty", "c", "bug"))
    mig = observed(spark, ("p3", "en:code-empty", "c", "bug"))
    diff = pa.difference(ref, mig)
    rules = fi.rules_table(spark, [r for r in packaged() if r.id in ("en:code-empty", "ca:source-of-fibre-claim-but-fibre-below-threshold")])
    summary = {r.check_id: r for r in pa.summarize(diff, rules).collect()}
    assert (summary["en:code-empty"].missing, summary["en:code-empty"].extra, summary["en:code-empty"].passed) == (2, 1, False)
    other = summary["ca:source-of-fibre-claim-but-fibre-below-threshold"]
    assert other.status == "runtime_only" and other.passed is None and other.matched == 0
    kept = pa.examples(pa.mismatches(diff), 1).collect()
    assert sorted((r.side, r.rank) for r in kept) == [("migrated", 1), ("reference", 1)]


def test_deep_ingredients(spark):
    deep = '{"id": "z", "vegan": "Unknown "}'
    for i in range(6):
        deep = f'{{"id": "n{i}", "vegan": "yes", "ingredients": [{deep}]}}'
    rows = spark.createDataFrame([("1", f"[{deep}]"), ("2", '[{"id": "a", "vegan": "yes"}]'), ("3", "[]"), ("4", None)], "code string, j string").select("code", F.parse_json("j").alias("ingredients"))
    got = {r.code: r.u for r in rows.select("code", cx.claim_unknown(F.col("ingredients"), "vegan").alias("u")).collect()}
    assert got == {"1": True, "2": False, "3": False, "4": False}
    assert cx.ingredient_nodes(rows).groupBy("code").count().orderBy("code").collect()[0]["count"] == 7


def test_unknown_claims_at_any_depth(spark):
    def nest(claim, depth):
        node = {"id": "x", "vegan": claim}
        for _ in range(depth - 1):
            node = {"id": "y", "vegan": "yes", "ingredients": [{"id": "z", "vegan": "no"}, node]}
        return [node]

    cases = {f"{c!r}{d}": (nest(c, d), str(c).strip().lower() in ("", "unknown", "none")) for c in ("yes", "unknown", "\tunknown ", None, "\u00a0", "maybe") for d in (1, 2, 8, 9, 30)}
    cases |= {"text": (["plain"], True), "inner": ([{"vegan": "yes", "ingredients": [7]}], True), "none": ([], False), "object": ({"vegan": "unknown"}, False), "null": (None, False)}
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, (v, _) in cases.items()], "code string, t string")
    got = {r.code: r.u for r in rows.select("code", cx.claim_unknown(F.parse_json("t"), "vegan").alias("u")).collect()}
    assert got == {k: want for k, (_, want) in cases.items()}


def _sets_of(spark, products):
    """Contexts of products with lists of (source, sugars, total, kcal, computed) and an aggregated set of the same kind."""
    from larder.types import INPUT_SET

    def one(x):
        source, sugars, total, kcal, computed = x
        values = {"sugars": sugars, "carbohydrates-total": total, "energy-kcal": kcal}
        return (source, "as_sold", "100g", {n: (v, "g", computed if n == "energy-kcal" else None) for n, v in values.items() if v is not None})

    rows = [(str(i), ([one(x) for x in sets], None, one(last) if last else None)) for i, (sets, last) in enumerate(products)]
    kind = f"code string, nutrition struct<input_sets:array<{INPUT_SET}>,as_sold:struct<fat:double>,aggregated_set:{INPUT_SET}>"
    flags = F.struct(F.lit(None).cast("boolean").alias("ignore_energy_calculated_error")).alias("flags")
    return spark.createDataFrame(rows, kind).select("code", "nutrition", flags)


def test_sets_beyond_the_places_and_near_totals(spark):
    """Rules on sets find the same in any place of the list, and totals that differ by little are compared rounded."""
    family = [r for r in packaged() if "${set_id}" in r.id]
    values = [10.1, 10.10000000000001, 10.104, 10.105, 10.106, 10.11, 10.115, 10.12, 10.2, 1e12, 2.0**40 + 0.5, None, float("nan"), float("inf")]
    each = [(source, a, b, k, 10.0) for source in ("packaging", "estimate") for a in values for b in (10.0, 10.005, 9.999, 1e12, 2.0**40, None) for k in (5.0, 100.0)]
    alone = fi.evaluate(_sets_of(spark, [([x], None) for x in each]), family).collect()
    want = sorted((r.check_id, r.emitted_code, r.severity) for r in alone)
    for n in (3, 7):  # within the places and beyond them
        listed = fi.evaluate(_sets_of(spark, [(each[i : i + n], None) for i in range(0, len(each), n)]), family).collect()
        assert sorted((r.check_id, r.emitted_code, r.severity) for r in listed) == want
    last = fi.evaluate(_sets_of(spark, [([], x) for x in each if x[0] == "packaging"]), family).collect()
    assert len(last) == len(want) and {(r.severity, r.emitted_code[:13]) for r in last} == {("warning", "en:nutrition-")}
    from larder.functions.scalars import round2

    totals = spark.createDataFrame([(a, b) for s, a, b, k, _ in each if s == "packaging"], "a double, b double")
    slack = F.when(F.col("b") >= 10, 0.1).otherwise(0.01)
    rounded = totals.where(round2(F.coalesce("a", F.lit(0.0)) + 0.0 + 0.0) > round2(F.col("b") + slack)).count()
    assert sum(r.check_id.endswith("carbohydrates-total") for r in alone) == rounded > 0
