"""Rows of any shape to canonical rows, or to the first reason why they have none.

Each row is one object (a VARIANT, or the columns of a typed row).  It is tested as a full document and as a nested table row; one that fits wins,
else the first reason counts, else it is canonical if it has a code.  One scan gives accepted and rejected rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import as_number, strip
from larder.sources.ingest import EXPORT_COLUMNS, TEXT_COLUMNS, looks_structured, structured_cell
from larder.types import BASE_COLUMNS, DOCUMENT_ONLY, NUMBER_COLUMNS, NUTRIENT_COLUMNS, NUTRIENTS, TAG_COLUMNS

LOCALIZED = ["product_name", "ingredients_text"]
REASON = "_reject_reason"
_ENTRY = "array<variant>"


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _is(v: Column, *kinds: str) -> Column:
    """The value's type starts with one of these names; numbers are told apart by SQL types."""
    kind = _kind(v)
    found = F.lit(False)
    for k in kinds:
        found = found | kind.startswith(k)
    return found


_NUMBER = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _list(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", _ENTRY), F.array().cast(_ENTRY))


def _decoded(v: Column) -> Column:
    """A cell whose text holds a list or object as that list or object."""
    return F.when(_is(v, "STRING"), F.coalesce(structured_cell(_text(v)), v)).otherwise(v)


def _entry_text(x: Column) -> Column:
    return F.nullif(strip(_text(F.try_variant_get(x, "$.text", "variant"))), F.lit(""))


def _is_main(x: Column) -> Column:
    return (F.try_variant_get(x, "$.lang", "string") == "main") & _entry_text(x).isNotNull()


def _picked(v: Column) -> Column:
    """From a list of {lang, text}: the main language's first non-blank text, else the first non-blank one, stripped."""
    entries = _list(v)
    main = F.get(F.filter(entries, lambda x: F.coalesce(_is_main(x), F.lit(False))), F.lit(0))
    first = F.get(F.filter(entries, lambda x: _entry_text(x).isNotNull()), F.lit(0))
    return F.coalesce(_entry_text(main), _entry_text(first))


def _no_objects(v: Column) -> Column:
    """A localized list with an entry that is no object before the pick ends it."""
    entries = _list(v)
    odd = F.transform(entries, lambda x, i: F.when(~_is(x, "OBJECT"), i))
    ends = F.transform(entries, lambda x, i: F.when(F.coalesce(_is_main(x), F.lit(False)), i))
    least = F.array_min(odd)
    return least.isNotNull() & ~F.coalesce(F.array_min(ends) < least, F.lit(False))


def _first(*reasons: Column) -> Column:
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def dispatch(m: Column, cells: Column, kinds: Column) -> Column:
    """struct<contract, reason> of a row as a map of its fields, of its structured cells decoded, and of its fields' types; one of the two is null."""
    at = lambda c: F.try_element_at(m, F.lit(c))
    cell = lambda c: F.try_element_at(cells, F.lit(c))
    of = lambda c, *names: F.regexp_like(F.coalesce(F.try_element_at(kinds, F.lit(c)), F.lit("VOID")), F.lit("^(" + "|".join(names) + ")"))
    keys = F.map_keys(m)
    marked = F.arrays_overlap(keys, _names(DOCUMENT_ONLY))
    payload = F.arrays_overlap(keys, _names(["nutriments", *LOCALIZED, *TAG_COLUMNS]))
    lacks = F.array_except(_names(EXPORT_COLUMNS), keys)
    complete = F.size(lacks) == 0
    doc, exp = "a document: ", "a nested row: "

    def localized(c: str, form: str, v: Column, good: Column, plain: str = "") -> list[Column]:
        return [F.when(~good, f"{form}{c} is no {plain}localized list"), F.when(_is(v, "ARRAY") & _no_objects(v), f"{form}{c} holds other things than objects")]

    def tags(c: str, form: str, v: Column, good: Column, plain: str = "") -> list[Column]:
        odd = F.exists(_list(v), lambda x: ~_is(x, "STRING"))
        return [F.when(~good, f"{form}{c} is no {plain}list"), F.when(_is(v, "ARRAY") & odd, f"{form}{c} holds other things than text")]

    as_document = _first(
        F.when(marked & ~payload, doc + "without nutriments, names or tags"),
        F.when(~of("nutriments", "VOID", "OBJECT"), doc + "nutriments are no object"),
        *[r for c in LOCALIZED for r in localized(c, doc, at(c), of(c, "VOID", "ARRAY", "STRING"), "text or ")],
        *[r for c in TAG_COLUMNS for r in tags(c, doc, at(c), of(c, "VOID", "ARRAY", "STRING"), "text or ")],
    )
    structured = lambda c: of(c, "STRING") & looks_structured(_text(at(c)))
    unreadable = lambda c: F.when(structured(c) & _is(cell(c), "STRING"), f"{exp}{c} is an unreadable structure")
    needs = lambda c: F.concat(F.lit(f"{exp}{c} needs "), F.array_join(lacks, ", "))
    partial = _first(
        F.when(~of("nutriments", "VOID"), needs("nutriments")),
        *[unreadable(c).when(~of(c, "VOID", "STRING") | structured(c), needs(c)) for c in LOCALIZED],
        *[unreadable(c).when(~of(c, "VOID", "STRING", "ARRAY") | structured(c), needs(c)) for c in TAG_COLUMNS],
    )
    whole = _first(
        F.when(~_is(cell("nutriments"), "VOID", "ARRAY"), exp + "nutriments are no list"),
        F.when(F.exists(_list(cell("nutriments")), lambda x: ~_is(x, "OBJECT")), exp + "nutriments hold other things than objects"),
        *[r for c in LOCALIZED for r in localized(c, exp, cell(c), _is(cell(c), "VOID", "ARRAY"))],
        *[r for c in TAG_COLUMNS for r in tags(c, exp, cell(c), _is(cell(c), "VOID", "ARRAY"))],
        F.when(F.arrays_overlap(keys, _names(NUTRIENT_COLUMNS)), exp + "nutriment columns beside nutriments"),
    )
    typed = _first(
        F.when(~of("code", "STRING"), "code is no text"),
        *[F.when(~of(c, "VOID", "STRING"), f"{c} is no text") for c in TEXT_COLUMNS if c not in ("code", *LOCALIZED)],
        *[F.when(~of(c, "VOID", "STRING", "BOOLEAN", *_NUMBER), f"{c} is no number or text") for c in [*NUMBER_COLUMNS, "no_nutrition_data"]],
    )
    canonical_typed = _first(
        typed,
        *[F.when(~of(c, "VOID", "STRING"), f"{c} is no text") for c in LOCALIZED],
        *[F.when(~of(c, "VOID", "STRING", "ARRAY"), f"{c} is no text or list") for c in TAG_COLUMNS],
        _odd_nutrient(F.map_filter(m, lambda k, _: k.isin(*NUTRIENT_COLUMNS))),
    )
    is_document = marked | of("nutriments", "OBJECT")
    shapes = F.struct(
        F.when(is_document, as_document).alias("document"), F.when(~marked, F.when(complete, whole).otherwise(partial)).alias("export"), (complete & ~marked).alias("complete"),
        F.when(is_document, _first(typed, _odd_nutrient(_document_nutrients(m)))).otherwise(F.when(complete, typed).otherwise(canonical_typed)).alias("typed"),
    )

    def chosen(s: Column) -> Column:
        shape = lambda name: F.struct(F.when(s["typed"].isNull(), F.lit(name)).alias("contract"), s["typed"].alias("reason"))
        none = lambda why: F.struct(F.lit(None).cast("string").alias("contract"), why.alias("reason"))
        return (
            F.when(m.isNull(), none(F.lit("no object")))
            .when(is_document & s["document"].isNull(), shape("document"))
            .when(is_document, none(s["document"]))
            .when(s["export"].isNotNull(), none(s["export"]))
            .when(s["complete"], shape("export"))
            .when(F.array_contains(keys, "code"), shape("canonical"))
            .otherwise(none(F.lit("no supported input shape")))
        )

    return F.get(F.transform(F.array(shapes), chosen), F.lit(0))


def _document_nutrients(m: Column) -> Column:
    """Nutrient values of a document by column; what nutriments has, nulls too, overrides the plain columns."""
    nested = F.try_variant_get(F.try_element_at(m, F.lit("nutriments")), "$", "map<string,variant>")
    own = lambda x: F.map_filter(x, lambda k, _: k.isin(*NUTRIENT_COLUMNS))
    inner = own(F.coalesce(nested, F.create_map().cast("map<string,variant>")))
    return F.map_concat(F.map_filter(own(m), lambda k, _: ~F.map_contains_key(inner, k)), inner)


def _export_nutrients(v: Column) -> Column:
    """Nutrient values of a list of {name, 100g} by column: names stripped, nulls skipped, unknown names dropped, the last wins."""
    named = F.transform(
        _list(v), lambda x: F.struct(F.concat(strip(_text(F.try_variant_get(x, "$.name", "variant"))), F.lit("_100g")).alias("key"), F.try_variant_get(x, '$["100g"]', "variant").alias("value"))
    )
    kept = F.filter(named, lambda x: x["key"].isin(*NUTRIENT_COLUMNS) & ~_is(x["value"], "VOID"))
    last = F.transform(F.sequence(F.lit(0), F.lit(len(NUTRIENTS) - 1)), lambda i: F.element_at(_names(NUTRIENT_COLUMNS), i + 1))
    found = F.transform(last, lambda n: F.struct(n.alias("key"), F.get(F.reverse(F.filter(kept, lambda x: x["key"] == n)), F.lit(0))["value"].alias("value")))
    return F.map_from_entries(F.filter(found, lambda x: x["value"].isNotNull()))


def _odd_nutrient(values: Column) -> Column:
    odd = F.map_keys(F.map_filter(values, lambda _, v: _is(v, "OBJECT", "ARRAY")))
    return F.when(F.size(odd) > 0, F.concat(F.array_min(odd), F.lit(" is no number or text")))


def _number(v: Column) -> Column:
    """A number, a truth value as 0 or 1, or text by the grammar of numbers."""
    plain = F.when(_is(v, *_NUMBER), F.try_variant_get(v, "$", "double")).when(_is(v, "BOOLEAN"), F.try_variant_get(v, "$", "boolean").cast("double"))
    return F.coalesce(plain, F.when(_is(v, "STRING"), as_number(_text(v))))


def fields_of(rows: DataFrame, document: str | None = None) -> Column:
    """A row as a map of its fields: those of a VARIANT column, or its typed columns; null where that is no object."""
    whole = F.col(document) if document else F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    return F.when(_is(whole, "OBJECT"), F.try_variant_get(whole, "$", "map<string,variant>"))


def dispatched(rows: DataFrame, document: str | None = None) -> DataFrame:
    """The rows' own columns, ``_fields``, ``_cells`` (structured cells decoded), ``_contract`` and ``_reject_reason``: one of the last two is null."""
    m = F.col("_fields")
    cells = F.transform_values(F.map_filter(m, lambda k, _: k.isin("nutriments", *LOCALIZED, *TAG_COLUMNS)), lambda _, v: _decoded(v))
    own = rows.withColumn("_fields", fields_of(rows, document))
    own = own.withColumns({"_cells": cells, "_kinds": F.transform_values(m, lambda _, v: _kind(v))})
    own = own.withColumn("_shape", dispatch(m, F.col("_cells"), F.col("_kinds")))
    # from a generator: a filter on a plain column would be pushed down with all of the above in place of each field
    return own.select(*rows.columns, "_fields", "_cells", F.inline(F.array("_shape")).alias("_contract", REASON))


def accepted(found: DataFrame) -> DataFrame:
    """Canonical rows of :func:`dispatched`: texts, tag lists, numbers as text, nutrients as doubles."""
    m, contract = F.col("_fields"), F.col("_contract")
    at = lambda c: F.try_element_at(m, F.lit(c))
    cell = lambda c: F.when(contract == "export", F.try_element_at("_cells", F.lit(c))).otherwise(at(c))
    columns = []
    for c in BASE_COLUMNS:
        v = at(c)
        if c in LOCALIZED:
            text = F.when(contract == "canonical", _text(v)).when(_is(cell(c), "ARRAY"), _picked(cell(c))).otherwise(F.nullif(strip(_text(v)), F.lit("")))
            columns.append(text.alias(c))
        elif c in TAG_COLUMNS:
            listed = F.transform(_list(cell(c)), _text)
            columns.append(F.when(_is(cell(c), "ARRAY"), listed).when(_is(v, "STRING"), F.split(_text(v), ",")).alias(c))
        else:
            columns.append(_text(v).alias(c))
    own = F.map_filter(m, lambda k, _: k.isin(*NUTRIENT_COLUMNS))
    nutrients = F.when(contract == "document", _document_nutrients(m)).when(contract == "export", _export_nutrients(cell("nutriments"))).otherwise(own)
    good = found.where(contract.isNotNull()).withColumn("_n", F.transform_values(nutrients, lambda _, v: _number(v)))
    return good.select(*columns, *[F.try_element_at("_n", F.lit(n)).alias(n) for n in NUTRIENT_COLUMNS])


def rejected(found: DataFrame) -> DataFrame:
    """The rows without a shape, as they came, with their first reason."""
    return found.where(F.col(REASON).isNotNull()).drop("_fields", "_cells", "_contract")


def failfast(found: DataFrame) -> DataFrame:
    """The same rows; the first one without a shape fails the job with its reason."""
    broken = F.raise_error(F.concat(F.lit("row without an input shape: "), F.col(REASON)))
    return found.withColumn("_contract", F.when(F.col(REASON).isNull(), F.col("_contract")).otherwise(broken))
