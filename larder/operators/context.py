"""Product rows to the nested context that rules see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import lowered_text, nutrient, nutrient_unit, number_of, set_id, split_tags, strip
from larder.types import INPUT_SET, NUTRIENT_VALUE, NUTRIENTS, TAG_COLUMNS

#: Paths that each kind of row provides to rules.
SOURCE_PATHS = [
    "code", *(f"product.{n}" for n in (
        "code created_t product_name quantity product_quantity serving_size serving_quantity brands categories labels emb_codes "
        "ingredients_text ingredients_tags nutriscore_grade nutriscore_score categories_tags labels_tags countries_tags"
    ).split()),
    "nutrition.input_sets", *(f"nutrition.as_sold.{n}" for n in "energy_kcal fat saturated_fat trans_fat sugars fiber omega_3".split()),
]
ENRICHED_PATHS = SOURCE_PATHS + [
    *(f"product.{n}" for n in (
        "lc lang nutriscore_grade_producer ingredients_percent_analysis ingredients_with_specified_percent_n "
        "ingredients_with_unspecified_percent_n ingredients_with_specified_percent_sum ingredients_with_unspecified_percent_sum "
        "packagings ingredients food_groups_tags"
    ).split()),
    "flags.is_european_product", "flags.has_animal_origin_category", "flags.ignore_energy_calculated_error",
    "category_props.minimum_number_of_ingredients", "nutrition.aggregated_set",
]
#: Nutrients of the claim scalars, by scalar name.
CLAIMS = {
    "energy_kcal": "energy-kcal", "fat": "fat", "saturated_fat": "saturated-fat", "trans_fat": "trans-fat",
    "sugars": "sugars", "fiber": "fiber", "omega_3": "omega-3-fat",
}


def input_sets(row: DataFrame) -> Column:
    """One packaging set as sold for 100 g of every numeric nutrient column; none without nutrients."""
    kinds = dict(row.dtypes)
    have = [n for n in NUTRIENTS if f"{n}_100g" in kinds]
    values = {n: number_of(F.col(f"`{n}_100g`"), kinds[f"{n}_100g"]) for n in have}
    entries = [
        F.struct(
            F.lit(n).alias("key"),
            F.struct(value.alias("value"), nutrient_unit(F.lit(n)).alias("unit"), F.lit(None).cast("double").alias("value_computed")).alias("value"),
        )
        for n, value in values.items()
    ]
    empty = F.array().cast(f"array<{INPUT_SET}>")
    if not entries:
        return empty
    numeric = F.filter(F.array(*entries), lambda e: e["value"]["value"].isNotNull())
    one = F.struct(
        F.lit("packaging").alias("source"),
        F.lit("as_sold").alias("preparation"),
        F.lit("100g").alias("per"),
        F.map_from_entries(numeric).alias("nutrients"),
    )
    return F.when(F.coalesce(*values.values()).isNotNull(), F.array(one).cast(f"array<{INPUT_SET}>")).otherwise(empty)


def usable_set(sets: Column) -> Column:
    """First set that is no estimate and is as sold."""
    good = F.filter(sets, lambda s: ~s["source"].eqNullSafe("estimate") & s["preparation"].eqNullSafe("as_sold"))
    return F.get(good, F.lit(0))


def claim_nutrients(nutrients: Column) -> Column:
    """The claim scalars of the usable set's nutrients; these are best a column, as each scalar reads them."""
    return F.struct(*[nutrient(nutrients, n).alias(name) for name, n in CLAIMS.items()])


def family_sets(sets: Column, aggregated: Column) -> Column:
    """array<struct<set_id, nutrients, severity>>: every set but estimates, then the aggregated one."""
    usable = F.filter(sets, lambda s: ~s["source"].eqNullSafe("estimate") & s["nutrients"].isNotNull())
    each = F.transform(
        usable,
        lambda s: F.struct(
            set_id(s["source"], s["preparation"], s["per"]).alias("set_id"), s["nutrients"].alias("nutrients"), F.lit("error").alias("severity")
        ),
    )
    last = F.struct(F.lit("nutrition").alias("set_id"), aggregated["nutrients"].alias("nutrients"), F.lit("warning").alias("severity"))
    more = F.when(aggregated["nutrients"].isNotNull(), F.array(last)).otherwise(F.array().cast(f"array<struct<set_id:string,nutrients:map<string,{NUTRIENT_VALUE}>,severity:string>>"))
    return F.concat(F.coalesce(each, F.array().cast(f"array<struct<set_id:string,nutrients:map<string,{NUTRIENT_VALUE}>,severity:string>>")), more)


def project_source(rows: DataFrame) -> DataFrame:
    """Canonical rows (tags as arrays or comma-joined text) to contexts with the source paths."""
    kinds = dict(rows.dtypes)

    def text(name: str) -> Column:
        return F.nullif(F.col(name), F.lit("")) if name in kinds else F.lit(None).cast("string")

    def number(name: str) -> Column:
        return number_of(F.col(name), kinds[name]) if name in kinds else F.lit(None).cast("double")

    def tags(name: str) -> Column:
        return split_tags(F.col(name), kinds[name].startswith("array")) if name in kinds else F.array().cast("array<string>")

    product = F.struct(
        F.col("code").alias("code"),
        *[text(n).alias(n) for n in "product_name quantity serving_size brands categories labels emb_codes ingredients_text".split()],
        *[number(n).alias(n) for n in "created_t product_quantity serving_quantity nutriscore_score".split()],
        (lowered_text(F.col("nutriscore_grade")) if "nutriscore_grade" in kinds else F.lit(None).cast("string")).alias("nutriscore_grade"),
        *[tags(n).alias(n) for n in TAG_COLUMNS],
    )
    first = rows.select(F.col("code"), product.alias("product"), input_sets(rows).alias("_sets"))
    chosen = first.select("*", usable_set(F.col("_sets"))["nutrients"].alias("_nutrients"))
    return chosen.select(
        "code", "product", F.struct(F.col("_sets").alias("input_sets"), claim_nutrients(F.col("_nutrients")).alias("as_sold")).alias("nutrition")
    )


def top_ingredient_tags(ingredients: Column) -> Column:
    """Ids of top-level ingredients, non-empty."""
    nodes = F.try_variant_get(ingredients, "$", "array<struct<id:string>>")
    ids = F.filter(F.transform(nodes, lambda n: n["id"]), lambda i: i.isNotNull() & (i != ""))
    return F.coalesce(ids, F.array().cast("array<string>"))


def claim_unknown(ingredients: Column, claim: str) -> Column:
    """Some ingredient at any depth has no decisive claim: none, blank, unknown, or it is no object.

    One step a level, as many as the text of the list has opening brackets: no row nests deeper.
    """
    own = lambda n: F.coalesce(F.lower(strip(F.try_variant_get(n, f"$.{claim}", "string"))), F.lit("")).isin("", "unknown")
    unsure = lambda n: ~F.coalesce(F.schema_of_variant(n).startswith("OBJECT"), F.lit(False)) | own(n)
    below = lambda n: F.coalesce(F.try_variant_get(n, "$.ingredients", "array<variant>"), F.array().cast("array<variant>"))
    top = F.coalesce(F.try_variant_get(ingredients, "$", "array<variant>"), F.array().cast("array<variant>"))
    levels = F.regexp_count(F.to_json(ingredients), F.lit(r"\["))
    zero = F.struct(top.alias("nodes"), F.lit(False).alias("found"))
    step = lambda acc, _: F.struct(
        F.flatten(F.transform(acc["nodes"], below)).alias("nodes"), (acc["found"] | F.exists(acc["nodes"], unsure)).alias("found")
    )
    deep = F.aggregate(F.sequence(F.lit(1), levels), zero, step, lambda acc: acc["found"])
    return F.coalesce(F.when(F.size(top) > 0, deep), F.lit(False))


def gathered_nodes(ingredients: Column, objects_only: bool = False) -> Column:
    """All nested ingredients of one row: array<struct<path, id, vegan, vegetarian>>, level by level; a path counts from 0.

    One step a level, as many as the text of the list has opening brackets: no row nests deeper.  ``objects_only`` leaves
    out entries that are no objects (which have null fields otherwise).
    """
    kind = "array<struct<path:array<int>,node:variant>>"

    def below(path: Column, listed: Column) -> Column:
        placed = F.transform(listed, lambda c, i: F.struct(F.concat(path, F.array(i)).alias("path"), c.alias("node")))
        if objects_only:
            placed = F.filter(placed, lambda x: F.coalesce(F.schema_of_variant(x["node"]).startswith("OBJECT"), F.lit(False)))
        return F.coalesce(placed, F.array().cast(kind))

    fields = lambda x: F.struct(x["path"].alias("path"), *[F.try_variant_get(x["node"], f"$.{n}", "string").alias(n) for n in ("id", "vegan", "vegetarian")])
    top = below(F.array().cast("array<int>"), F.try_variant_get(ingredients, "$", "array<variant>"))
    levels = F.regexp_count(F.to_json(ingredients), F.lit(r"\["))
    zero = F.struct(top.alias("now"), F.array().cast("array<struct<path:array<int>,id:string,vegan:string,vegetarian:string>>").alias("all"))
    step = lambda acc, _: F.struct(
        F.flatten(F.transform(acc["now"], lambda x: below(x["path"], F.try_variant_get(x["node"], "$.ingredients", "array<variant>")))).alias("now"),
        F.concat(acc["all"], F.transform(acc["now"], fields)).alias("all"),
    )
    return F.aggregate(F.when(levels > 0, F.sequence(F.lit(1), levels)), zero, step, lambda acc: acc["all"])


def ingredient_nodes(rows: DataFrame, code: str = "code", column: str = "ingredients") -> DataFrame:
    """(code, depth, id, vegan, vegetarian) of all nested ingredients, in one scan of the rows."""
    nodes = rows.select(F.col(code).alias("code"), F.inline(gathered_nodes(F.col(column))))
    return nodes.select("code", F.size("path").alias("depth"), "id", "vegan", "vegetarian")


def project_enriched(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Enriched snapshots (product, flags, category_props, nutrition) to contexts with all paths, and the columns of ``keep``.

    ``code`` and ``product.code`` must agree where both are set; a row that breaks this fails the job.
    """
    agreed = rows.where(
        F.coalesce(F.assert_true(F.col("product.code").isNull() | F.col("code").eqNullSafe(F.col("product.code")), F.lit("codes differ")).isNull(), F.lit(True))
    )
    chosen = agreed.withColumn("_nutrients", usable_set(F.col("nutrition.input_sets"))["nutrients"])
    return chosen.select(
        *keep,
        "code",
        F.col("product").withField("ingredients_tags", top_ingredient_tags(F.col("product.ingredients"))).alias("product"),
        "flags",
        "category_props",
        F.struct(
            F.col("nutrition.input_sets"), claim_nutrients(F.col("_nutrients")).alias("as_sold"), F.col("nutrition.aggregated_set")
        ).alias("nutrition"),
    )
