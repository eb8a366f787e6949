"""Snapshot of a raw document after an outside system has enriched it: a typed projection that repairs shapes.

What should be a list and is none becomes empty, list entries that should be objects and are none
are dropped at every depth, numbers and numeric texts become text of 17 digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import as_number
from larder.operators.context import gathered_nodes
from larder.types import TAG_COLUMNS

#: Text that the outside system takes for a number.
_NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_TEXTS = "code lc lang product_name quantity serving_size brands categories labels emb_codes ingredients_text nutriscore_grade nutriscore_grade_producer".split()
_NUMBERS = (
    "created_t product_quantity serving_quantity ingredients_percent_analysis ingredients_with_specified_percent_n ingredients_with_unspecified_percent_n "
    "ingredients_with_specified_percent_sum ingredients_with_unspecified_percent_sum nutriscore_score"
).split()
_TAGS = [*[t for t in TAG_COLUMNS if t != "ingredients_tags"], "food_groups_tags"]
_FLAGS = ["is_european_product", "has_animal_origin_category", "ignore_energy_calculated_error"]
#: Where a document keeps the codes of each severity.
FINDINGS = {"bug": "bugs", "info": "info", "completeness": "completeness", "warning": "warnings", "error": "errors"}
_NUTRIENT = "struct<value:string,unit:string,value_computed:string>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is evaluated once: the end of an aggregation over nothing.  An array's first entry would do too, but works out its type for each row."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, then)


_SPLITTER = 2.0**27 + 1


def _halves(x: float) -> tuple[float, float]:
    """A double as two of at most 26 bits each (Veltkamp), so that products of such halves are exact."""
    high = x * _SPLITTER - (x * _SPLITTER - x)
    return high, x - high


#: Powers of ten that are exact doubles, with their halves.
_TENS = [(float(10**i), *_halves(float(10**i))) for i in range(21)]


def digits17(x: Column) -> Column:
    """A double as text of 17 significant digits, halves to even, without trailing zeros (C's ``%.17g``).

    From 0.0001 to below 10**17 by exact products of doubles; beyond, the shortest digits that give the same double.
    """
    signed = lambda x: F.concat(F.when(x < 0, "-").otherwise(""), _let(F.abs(x), _unsigned17))
    return _let(x, lambda x: F.when(x.isNull(), F.lit(None)).when(F.isnan(x), "NaN").otherwise(signed(x)))


def _unsigned17(a: Column) -> Column:
    whole = F.floor(a)
    return (
        F.when((a < F.lit(1e15)) & (a == whole.cast("double")), whole.cast("string"))
        .when(a == float("inf"), "Inf")
        .when((a >= F.lit(1e-4)) & (a < F.lit(1e17)), _fixed17(a))
        .otherwise(_let(a.cast("string"), _far))
    )


def _far(shown: Column) -> Column:
    """1.0E-5 to 1e-05, 1.25E20 to 1.25e+20."""
    power = F.regexp_extract(shown, r"E-?([0-9]+)", 1)
    sign = F.when(F.contains(shown, F.lit("E-")), "-").otherwise("+")
    return F.concat(F.regexp_replace(F.regexp_replace(shown, "E.*", ""), r"\.0$", ""), F.lit("e"), sign, F.lpad(power, F.greatest(F.length(power), F.lit(2)), "0"))


def _fixed17(a: Column) -> Column:
    """Times the power of ten that leaves 17 digits: a double of 2**53 or more, which is whole, and the error of that product, which is exact (Dekker)."""
    powers = F.array(*[F.lit(float(f"1e{i}")) for i in range(-6, 19)])
    at = lambda i: F.get(powers, i + 6)
    tens = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("ten", "high", "low"), ten, strict=True)]) for ten in _TENS])

    def placed(guess: Column) -> Column:
        """The logarithm is at most one off."""
        places = F.lit(16) - F.when(a < at(guess), guess - 1).when(a >= at(guess + 1), guess + 1).otherwise(guess)
        return _let(places, lambda places: _let(F.get(tens, places), lambda ten: _let(a * F.lit(_SPLITTER), lambda split: scaled(places, ten, split - (split - a)))))

    def scaled(places: Column, ten: Column, high: Column) -> Column:
        def erring(product: Column, high: Column) -> Column:
            low = a - high
            error = low * ten["low"] - (((product - high * ten["high"]) - low * ten["high"]) - high * ten["low"])
            return _let(error, lambda error: rounded(places, product, error))

        return _let(high, lambda high: _let(a * ten["ten"], lambda product: erring(product, high)))

    def rounded(places: Column, product: Column, error: Column) -> Column:
        def even(n: Column) -> Column:
            rest = error - F.floor(error).cast("double")
            return n + F.when((rest > 0.5) | ((rest == 0.5) & (n % 2 == 1)), 1).otherwise(0)

        return _let(_let(F.floor(product) + F.floor(error), even).cast("string"), lambda digits: shown(places, digits))

    def shown(places: Column, digits: Column) -> Column:
        padded = F.when(places < 17, digits).otherwise(F.lpad(digits, places + 1, "0"))
        return _let(padded, lambda digits: _let(F.length(digits) - places, lambda whole: pointed(digits, whole)))

    def pointed(digits: Column, whole: Column) -> Column:
        text = F.concat(F.substring(digits, F.lit(1), whole), F.lit("."), F.substring(digits, whole + 1, F.lit(20)))
        return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))

    return _let(F.floor(F.log10(a)).cast("int"), placed)


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def text_of(v: Column) -> Column:
    """Plain text, or a number or truth value as text; a structure (OBJECT<..> or ARRAY<..>) gives null."""
    return F.when(~F.contains(F.schema_of_variant(v), F.lit("<")), F.try_variant_get(v, "$", "string"))


def number_text(v: Column) -> Column:
    """Numbers and numeric texts to 17 digits, other text as it is; structures and truth values give null."""

    def shown(kind: Column) -> Column:
        number = F.when(kind.startswith("BIGINT") | kind.startswith("D") | kind.startswith("FLOAT"), F.try_variant_get(v, "$", "double"))
        either = lambda text: F.coalesce(digits17(number.when(text.rlike(_NUMERIC), text.try_cast("double"))), text)
        return _let(F.when(kind == "STRING", F.try_variant_get(v, "$", "string")), either)

    return F.when(v.isNotNull(), _let(_kind(v), shown))


def _objects(listed: Column) -> Column:
    """The objects of a list, in which other entries were read as null; what is no list was read as null."""
    return F.coalesce(F.filter(listed, lambda x: x.isNotNull()), F.array())


def _texts(listed: Column) -> Column:
    return F.coalesce(F.transform(listed, text_of), F.array().cast("array<string>"))


def _nutrients(entries: Column) -> Column:
    kept = F.map_filter(entries, lambda _, x: x.isNotNull())
    typed = F.transform_values(
        kept, lambda _, x: F.struct(number_text(x["value"]).alias("value"), text_of(x["unit"]).alias("unit"), number_text(x["value_computed"]).alias("value_computed"))
    )
    return F.coalesce(typed, F.create_map().cast(f"map<string,{_NUTRIENT}>"))


#: Levels of ingredients that are read as typed structures; deeper ones are gathered level by level, however many.
LEVELS = 4


def _ingredient_type(levels: int) -> str:
    return f"array<struct<id:string,vegan:string,vegetarian:string,ingredients:{_ingredient_type(levels - 1) if levels > 1 else 'variant'}>>"


def _ingredients(listed: Column) -> Column:
    """Nested ingredients, objects only, as a variant of id, vegan, vegetarian and ingredients."""

    def repaired(nodes: Column, levels: int) -> Column:
        below = lambda n: repaired(n["ingredients"], levels - 1) if levels > 1 else _deep_ingredients(n["ingredients"])
        return F.transform(_objects(nodes), lambda n: F.struct(*[n[f].alias(f) for f in ("id", "vegan", "vegetarian")], below(n).alias("ingredients")))

    return F.when(F.size(_objects(listed)) > 0, F.to_variant_object(repaired(listed, LEVELS))).otherwise(F.parse_json(F.lit("[]")))


def _deep_ingredients(v: Column) -> Column:
    """As :func:`_ingredients` of a variant, at any depth.

    The nodes of all levels in order of their paths are the tree in pre-order, so its JSON text is written from left to right.
    """
    fields = lambda n: F.to_json(F.struct(*[n[f].alias(f) for f in ("id", "vegan", "vegetarian")]), {"ignoreNullFields": "false"})
    opened = lambda text: F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(',"ingredients":['))
    closed = lambda was, now: F.when(now > was, F.lit("")).otherwise(F.concat(F.repeat(F.lit("]}"), was - now + 1), F.lit(",")))

    def written(s: Column) -> Column:
        """Text of the sorted nodes; ``depths`` starts with 0, the depth before the first node."""
        parts = F.transform(s["nodes"], lambda n, i: F.concat(closed(F.get(s["depths"], i), F.size(n["path"])), _let(fields(n), opened)))
        return F.concat(F.lit("["), F.array_join(parts, ""), F.repeat(F.lit("]}"), F.element_at(s["depths"], -1)), F.lit("]"))

    def placed(nodes: Column) -> Column:
        depths = F.concat(F.array(F.lit(0)), F.transform(nodes, lambda n: F.size(n["path"])))
        return _let(F.struct(nodes.alias("nodes"), depths.alias("depths")), written)

    is_list = _kind(v).startswith("ARRAY")
    text = _let(F.array_sort(gathered_nodes(F.when(is_list, v), objects_only=True)), placed)
    return F.parse_json(F.coalesce(F.when(is_list, text), F.lit("[]")))


def _struct(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">"


_ENTRY = f"map<string,{_struct(dict.fromkeys(('value', 'unit', 'value_computed'), 'variant'))}>"
#: A document's shape: what has another one at its place is read as null.
_DOCUMENT = _struct(
    dict.fromkeys([*_TEXTS, *_NUMBERS], "variant")
    | dict.fromkeys([*_TAGS, *(f"data_quality_{n}_tags" for n in FINDINGS.values())], "array<variant>")
    | {
        "packagings": f"array<{_struct(dict.fromkeys(('number', 'shape', 'material'), 'variant'))}>",
        "ingredients": _ingredient_type(LEVELS),
        "nutrition": _struct({
            "input_sets": f"array<{_struct(dict.fromkeys(('source', 'preparation', 'per'), 'variant') | {'nutrients': _ENTRY})}>",
            "aggregated_set": _struct({"nutrients": _ENTRY}),
        }),
    }
)
_HELPER = _struct(dict.fromkeys(_FLAGS, "boolean") | {"minimum_number_of_ingredients": "variant"})


def snapshot(rows: DataFrame, document: str = "document", helper: str = "helper") -> DataFrame:
    """(code, product, flags, category_props, nutrition, legacy_check_tags) of raw documents (variant) and what the helper knows of each (variant)."""
    read = rows.select(F.try_variant_get(F.col(document), "$", _DOCUMENT).alias("d"), F.try_variant_get(F.col(helper), "$", _HELPER).alias("h"))  # each in one walk
    d, h = F.col("d"), F.col("h")
    # one array: the plan holds the long expression of a number's digits once, and not once a name
    numbers = F.transform(F.array(*[d[n] for n in _NUMBERS], h["minimum_number_of_ingredients"]), number_text)
    read, number = read.select("d", "h", numbers.alias("numbers")), lambda i: F.get(F.col("numbers"), F.lit(i))
    packaging = lambda x: F.struct(number_text(x["number"]).alias("number"), text_of(x["shape"]).alias("shape"), text_of(x["material"]).alias("material"))
    nutrition_set = lambda s: F.struct(*[text_of(s[n]).alias(n) for n in ("source", "preparation", "per")], _nutrients(s["nutrients"]).alias("nutrients"))
    product = F.struct(
        *[text_of(d[n]).alias(n) for n in _TEXTS],
        *[number(i).alias(n) for i, n in enumerate(_NUMBERS)],
        F.transform(_objects(d["packagings"]), packaging).alias("packagings"),
        _ingredients(d["ingredients"]).alias("ingredients"),
        *[_texts(d[n]).alias(n) for n in _TAGS],
    )
    sets, whole = d["nutrition"]["input_sets"], d["nutrition"]["aggregated_set"]["nutrients"]
    return read.select(
        text_of(d["code"]).alias("code"),
        product.alias("product"),
        F.struct(*[h[n].alias(n) for n in _FLAGS]).alias("flags"),
        F.struct(number(len(_NUMBERS)).alias("minimum_number_of_ingredients")).alias("category_props"),
        F.struct(F.transform(_objects(sets), nutrition_set).alias("input_sets"), F.struct(_nutrients(whole).alias("nutrients")).alias("aggregated_set")).alias("nutrition"),
        F.struct(*[_texts(d[f"data_quality_{n}_tags"]).alias(s) for s, n in FINDINGS.items()]).alias("legacy_check_tags"),
    )


def typed(snapshots: DataFrame) -> DataFrame:
    """Snapshots as enriched rows: the numbers' text to doubles."""
    number = lambda n: F.struct(as_number(n["value"]).alias("value"), n["unit"].alias("unit"), as_number(n["value_computed"]).alias("value_computed"))
    nutrients = lambda m: F.transform_values(m, lambda _, n: number(n))
    packaging = lambda p: F.struct(as_number(p["number"]).alias("number"), p["shape"].alias("shape"), p["material"].alias("material"))
    product = F.struct(
        *[F.col(f"product.{n}").alias(n) for n in [*_TEXTS, "ingredients", *_TAGS]],
        *[as_number(F.col(f"product.{n}")).alias(n) for n in _NUMBERS],
        F.transform("product.packagings", packaging).alias("packagings"),
    )
    of_set = lambda s: F.struct(*[s[n].alias(n) for n in ("source", "preparation", "per")], nutrients(s["nutrients"]).alias("nutrients"))
    nutrition = F.struct(
        F.transform("nutrition.input_sets", of_set).alias("input_sets"), F.struct(nutrients(F.col("nutrition.aggregated_set.nutrients")).alias("nutrients")).alias("aggregated_set")
    )
    minimum = F.struct(as_number(F.col("category_props.minimum_number_of_ingredients")).alias("minimum_number_of_ingredients"))
    return snapshots.withColumns({"product": product, "category_props": minimum, "nutrition": nutrition})
