"""Queries over raw documents, rows of mixed shapes and files, with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import fixtures as fx
from larder.plans.product_queries import _folder, query
from larder.sources import dispatch, ingest, snapshot
from larder.sources.ingest import EXPORT_COLUMNS

BASE = fx.for_duckdb(fx.BASE)

# ---------------------------------------------------------------- raw documents

#: Ingredients in every broken shape, and what is left of them.
INGREDIENTS = [
    (None, "[]"),
    ('"text"', "[]"),
    (
        '[{"id":"a","vegan":"yes","more":1,"ingredients":[{"id":"b"},7,{"id":"c","ingredients":{"no":1}}]},null,"y",{"id":"d"}]',
        '[{"id":"a","ingredients":[{"id":"b","ingredients":[],"vegan":null,"vegetarian":null},{"id":"c","ingredients":[],"vegan":null,"vegetarian":null}],'
        '"vegan":"yes","vegetarian":null},{"id":"d","ingredients":[],"vegan":null,"vegetarian":null}]',
    ),
    ("[[1],2]", "[]"),
    (
        '[{"id":"1","ingredients":[{"id":"2","ingredients":[{"id":"3","ingredients":[{"id":"4","vegetarian":"no","ingredients":[5]}]}]}]}]',
        '[{"id":"1","ingredients":[{"id":"2","ingredients":[{"id":"3","ingredients":[{"id":"4","ingredients":[],"vegan":null,"vegetarian":"no"}],"vegan":null,"vegetarian":null}],'
        '"vegan":null,"vegetarian":null}],"vegan":null,"vegetarian":null}]',
    ),
    ("[]", "[]"),
    ('{"id":"a"}', "[]"),
]
#: Text of a document for key k; pieces that are null are left out.
RAW = """concat('{', concat_ws(',',
  case when k % 13 = 0 then concat('"code":', cast(k as string)) else concat('"code":"', cast(k as string), '"') end,
  case k % 8 when 0 then '"product_quantity":"12.5"' when 1 then '"product_quantity":"0.1"' when 2 then '"product_quantity":0.1' when 3 then '"product_quantity":"abc"'
    when 4 then '"product_quantity":null' when 5 then '"product_quantity":{"a":1}' when 6 then '"product_quantity":true'
    else concat('"product_quantity":', cast(k % 1000 as string), '.3') end,
  case k % 5 when 1 then '"packagings":{"a":1}' when 2 then '"packagings":[{"number":2,"shape":"box","material":null},5,"x",{"number":"0.3"}]' when 3 then '"packagings":[]'
    when 4 then '"packagings":"text"' end,
  case k % 7 when 1 then '"nutrition":[]' when 2 then '"nutrition":{"input_sets":{},"aggregated_set":5}'
    when 3 then concat('{"input_sets":[{"source":"packaging","per":"100g","nutrients":{"fat":{"value":', cast(k % 100 as string),
      '.7,"unit":"g"},"bad":3,"salt":{"value":"0.1","value_computed":true}}},9],"aggregated_set":{"nutrients":{"energy-kj":{"value":"12"}}}}')
    when 4 then '"nutrition":{"input_sets":[{"nutrients":[1]},{}]}' when 5 then '"nutrition":"text"' end,
  case k % 4 when 0 then '"labels_tags":["en:a","en:b"]' when 1 then '"labels_tags":"en:a"' when 2 then '"labels_tags":{"en:a":1}' end,
  case k % 3 when 0 then '"data_quality_bugs_tags":["en:code-missing"],"data_quality_warnings_tags":[]' when 1 then '"data_quality_bugs_tags":"en:x"' end,
  INGREDIENTS), '}')""".replace("""when 3 then concat('{"input""", """when 3 then concat('"nutrition":{"input""").replace(
    "INGREDIENTS", "case k % 9 " + " ".join(f"""when {i} then '"ingredients":{text}'""" for i, (text, _) in enumerate(INGREDIENTS) if text) + " end"
)
HELPER = """case k % 3 when 0 then '{"is_european_product":true,"minimum_number_of_ingredients":"3"}' when 1 then '{"is_european_product":false,"minimum_number_of_ingredients":1.1}' else 'null' end"""
_NUMBER = "case json_type({0}) when 'VARCHAR' then case when try_cast({0} ->> '$' as double) is not null then format('{{:.17g}}', cast({0} ->> '$' as double)) else {0} ->> '$' end" \
    " when 'DOUBLE' then format('{{:.17g}}', cast({0} as double)) when 'UBIGINT' then format('{{:.17g}}', cast({0} as double)) end"
_OBJECTS = "case when json_type({0}) = 'ARRAY' then list_filter(json_extract({0}, '$[*]'), lambda x: json_type(x) = 'OBJECT') else [] end"
_TEXTS = "case when json_type({0}) = 'ARRAY' then array_to_string(list_transform(json_extract({0}, '$[*]'), lambda x: x ->> '$'), ',') else '' end"


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, fx.BASE).select("k", F.parse_json(F.expr(RAW)).alias("document"), F.parse_json(F.expr(HELPER)).alias("helper"))


@query("snapshot_documents", f"""
with raw as (select k, cast({RAW} as json) as d, cast({HELPER} as json) as h from ({BASE}) b),
p as (select *, {_OBJECTS.format("d -> '$.packagings'")} as packs, {_OBJECTS.format("d -> '$.nutrition.input_sets'")} as sets from raw)
select cast(k as varchar) as code, {_NUMBER.format("(d -> '$.product_quantity')")} as product_quantity, cast(len(packs) as bigint) as packagings,
  {_NUMBER.format("(packs[2] -> '$.number')")} as second_number, packs[1] ->> '$.shape' as shape, cast(len(sets) as bigint) as sets,
  {_NUMBER.format("(sets[1] -> '$.nutrients.fat.value')")} as fat, {_NUMBER.format("(sets[1] -> '$.nutrients.salt.value')")} as salt,
  coalesce(case when json_type(sets[1] -> '$.nutrients') = 'OBJECT' then len(list_filter(json_extract(sets[1] -> '$.nutrients', '$.*'), lambda x: json_type(x) = 'OBJECT')) end, 0)::bigint as nutrients,
  {_NUMBER.format("(d -> '$.nutrition.aggregated_set.nutrients.\"energy-kj\".value')")} as kj,
  {_TEXTS.format("d -> '$.labels_tags'")} as labels, {_TEXTS.format("d -> '$.data_quality_bugs_tags'")} as bugs,
  cast(h ->> '$.is_european_product' as boolean) as european, {_NUMBER.format("(h -> '$.minimum_number_of_ingredients')")} as minimum,
  case k % 9 {" ".join(f"when {i} then '{want}'" for i, (_, want) in enumerate(INGREDIENTS))} else '[]' end as ingredients
from p""")
def snapshot_documents(spark, sf_dir):
    """Documents that hold every broken shape."""
    found = snapshot.snapshot(raw_documents(spark, sf_dir))
    sets, packs = F.col("nutrition.input_sets"), F.col("product.packagings")
    nutrients = F.coalesce(F.get(sets, F.lit(0))["nutrients"], F.create_map().cast("map<string,struct<value:string,unit:string,value_computed:string>>"))
    return found.select(
        "code", "product.product_quantity", F.size(packs).cast("long").alias("packagings"), F.get(packs, F.lit(1))["number"].alias("second_number"),
        F.get(packs, F.lit(0))["shape"].alias("shape"), F.size(sets).cast("long").alias("sets"),
        *[F.try_element_at(nutrients, F.lit(n))["value"].alias(n) for n in ("fat", "salt")], F.size(nutrients).cast("long").alias("nutrients"),
        F.try_element_at("nutrition.aggregated_set.nutrients", F.lit("energy-kj"))["value"].alias("kj"),
        F.array_join("product.labels_tags", ",").alias("labels"), F.array_join("legacy_check_tags.bug", ",").alias("bugs"),
        F.col("flags.is_european_product").alias("european"), F.col("category_props.minimum_number_of_ingredients").alias("minimum"),
        F.to_json("product.ingredients").alias("ingredients"),
    )


def as_documents(rows: DataFrame) -> DataFrame:
    """Enriched rows as raw JSON documents and what the helper knows of them."""
    whole = F.struct(F.col("code"), *[F.col(f"product.{n}").alias(n) for n in rows.schema["product"].dataType.names if n not in ("code", "ingredients")], F.col("nutrition"))
    text = F.regexp_replace(F.to_json(whole), r"\}$", "")
    document = F.parse_json(F.concat(text, F.coalesce(F.concat(F.lit(',"ingredients":'), F.to_json("product.ingredients")), F.lit("")), F.lit("}")))
    return rows.select(document.alias("document"), F.parse_json(F.to_json(F.struct("flags.*", "category_props.*"))).alias("helper"))


# ---------------------------------------------------------------- rows of mixed shapes

_FULL: dict = {c: None for c in EXPORT_COLUMNS}
_LACKS = ", ".join(c for c in EXPORT_COLUMNS if c not in ("code", "nutriments"))
#: Row (CODE stands for its code), contract, reason, and name, tags, fat and salt if accepted.
SHAPES: list[tuple[dict | list, str | None, str | None, tuple]] = [
    ({"code": "CODE", "product_name": " Milk ", "fat_100g": "1_0", "labels_tags": "a,b"}, "canonical", None, (" Milk ", "a|b", 10.0, None)),
    ({"_id": "x", "code": "CODE"}, None, "a document: without nutriments, names or tags", ()),
    ({"_id": "x", "code": "CODE", "product_name": " Milk ", "labels_tags": ["a"], "nutriments": {"fat_100g": " 2.5 ", "salt_100g": None}, "salt_100g": 3}, "document", None, ("Milk", "a", 2.5, None)),
    ({"code": "CODE", "nutriments": []}, None, f"a nested row: nutriments needs {_LACKS}", ()),
    ({"code": "CODE", "nutriments": {"fat_100g": 2, "x": 1}, "salt_100g": 4}, "document", None, (None, None, 2.0, 4.0)),
    (
        _FULL | {"code": "CODE", "product_name": [{"lang": "fr", "text": " x "}, {"lang": "main", "text": " y "}, 5], "labels_tags": ["a", "b"],
                 "nutriments": [{"name": " fat ", "100g": 1}, {"name": "fat", "100g": "2_0"}, {"name": "salt"}, {"name": "?", "100g": 1}]},
        "export", None, ("y", "a|b", 20.0, None),
    ),
    (_FULL | {"code": "CODE", "product_name": "plain"}, None, "a nested row: product_name is no localized list", ()),
    (_FULL | {"code": "CODE", "labels_tags": "a"}, None, "a nested row: labels_tags is no list", ()),
    ({"code": 7}, None, "code is no text", ()),
    ({"code": "CODE", "quantity": 5}, None, "quantity is no text", ()),
    ({"code": "CODE", "labels_tags": [1, "b"], "product_quantity": 5, "fat_100g": True}, "canonical", None, (None, "1|b", 1.0, None)),
    ({"_id": "x", "code": "CODE", "labels_tags": [1, "b"]}, None, "a document: labels_tags holds other things than text", ()),
    ({"quantity": "1"}, None, "no supported input shape", ()),
    (_FULL | {"_id": "x", "code": "CODE", "nutriments": [{"name": "fat", "100g": 1}]}, None, "a document: nutriments are no object", ()),
    ({"code": "CODE", "product_name": "{broken}"}, None, "a nested row: product_name is an unreadable structure", ()),
    (_FULL | {"code": "CODE", "salt_100g": 1}, None, "a nested row: nutriment columns beside nutriments", ()),
    (_FULL | {"code": "CODE", "product_name": "[('P')]", "ingredients_text": "[{'lang': 'main', 'text': 'P'}]"}, None, "a nested row: product_name holds other things than objects", ()),
    (_FULL | {"code": "CODE", "product_name": "[{'lang': 'main', 'text': 'P'}]", "labels_tags": "['q']", "nutriments": "[{'name': 'salt', '100g': 0.5}]"}, "export", None, ("P", "q", None, 0.5)),
    ({"_id": "x", "code": "CODE", "product_name": 7, "nutriments": {}}, None, "a document: product_name is no text or localized list", ()),
    ({"_id": "x", "code": "CODE", "nutriments": {"fat_100g": {"a": 1}}}, None, "fat_100g is no number or text", ()),
    ([1, 2], None, "no object", ()),
    (_FULL | {"code": "CODE", "nutriments": {"fat_100g": 1}}, "document", None, (None, None, 1.0, None)),  # all columns of a nested row, and a document's nutriments
    ({"code": "CODE", "brands": {"a": 1}}, None, "brands is no text", ()),
]


def _sql(v) -> str:
    return "null" if v is None else str(v) if isinstance(v, float) else "'" + v.replace("'", "''") + "'"


def _cases(values: list) -> str:
    return f"case k % {len(SHAPES)} " + " ".join(f"when {i} then {_sql(v)}" for i, v in enumerate(values) if v is not None) + " end"


def mixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.array(*[F.lit(json.dumps(row)) for row, *_ in SHAPES])
    text = F.replace(F.element_at(texts, (F.col("k") % len(SHAPES) + 1).cast("int")), F.lit("CODE"), F.col("k").cast("string"))
    return fx.table(spark, sf_dir, fx.BASE).select("k", F.parse_json(text).alias("document"))


@query("rows_accepted", f"""select cast(k as varchar) as code, {_cases([s[3][0] if s[3] else None for s in SHAPES])} as product_name, {_cases([s[3][1] if s[3] else None for s in SHAPES])} as labels,
  cast({_cases([s[3][2] if s[3] else None for s in SHAPES])} as double) as fat, cast({_cases([s[3][3] if s[3] else None for s in SHAPES])} as double) as salt
  from ({BASE}) b where {_cases([s[1] for s in SHAPES])} is not null""")
def rows_accepted(spark, sf_dir):
    good = dispatch.accepted(dispatch.dispatched(mixed_rows(spark, sf_dir), "document"))
    return good.select("code", "product_name", F.array_join("labels_tags", "|").alias("labels"), F.col("fat_100g").alias("fat"), F.col("salt_100g").alias("salt"))


@query("rows_rejected", f"select k, {_cases([s[2] for s in SHAPES])} as reason from ({BASE}) b where {_cases([s[1] for s in SHAPES])} is null")
def rows_rejected(spark, sf_dir):
    return dispatch.rejected(dispatch.dispatched(mixed_rows(spark, sf_dir), "document")).select("k", F.col(dispatch.REASON).alias("reason"))


# ---------------------------------------------------------------- files

_BREAK = "chr(10)"
#: A row of a sheet by key, and its cells.
_LINE = """case k % 6 when 0 then concat(cast(k as string), ';"12"" pipe; long"') when 1 then concat(cast(k as string), ';"two', chr(10), 'lines";x') when 2 then cast(k as string)
  when 3 then concat(cast(k as string), ';a;b;c;d') when 4 then ' ; ;' else concat(cast(k as string), ';plain;"";') end"""
_FIRST = """case k % 6 when 0 then '12" pipe; long' when 1 then concat('two', chr(10), 'lines') when 2 then '' when 3 then 'a' else 'plain' end"""
_SECOND = "case k % 6 when 1 then 'x' when 3 then 'b' else '' end"


def _written(spark: SparkSession, sf_dir: str, header: str, line: str, label: str) -> str:
    """Four files of lines, each with the header."""
    folder = _folder(spark, label)
    rows = fx.table(spark, sf_dir, fx.BASE).select("k", F.expr(line).alias("value"))
    for part in range(4):
        spark.createDataFrame([(header,)], "value string").coalesce(1).union(rows.where(F.col("k") % 4 == part).select("value").coalesce(1)).coalesce(1).write.mode("append").text(folder)
    return folder


@query("read_sheet_quoted", f"select cast(k as varchar) as code, {_FIRST} as name, {_SECOND} as name_again from ({BASE}) b where k % 6 <> 4")
def read_sheet_quoted(spark, sf_dir):
    """Doubled quotes, line breaks and separators in cells, short, long and blank rows, a repeated name in the header."""
    rows = ingest.read_sheet(spark, _written(spark, sf_dir, "code;name;name", _LINE, "sheet"))
    return rows.toDF("code", "name", "name_again")


@query("read_tsv_quoted", f"select cast(k as varchar) as code, {_FIRST} as name from ({BASE}) b where k % 6 in (0, 1)")
def read_tsv_quoted(spark, sf_dir):
    line = _LINE.replace("';\"", "'\t\"").replace("\";x'", "\"'")
    folder = _written(spark, sf_dir, "code\tname", f"case when k % 6 in (0, 1) then {line} end", "tsv")
    return ingest.read_tsv(spark, folder).where("code is not null").select("code", "name")


@query("read_lines_lenient", f"select count_if(k % 4 = 0) as objects, count_if(k % 4 <> 0) as others from ({BASE}) b")
def read_lines_lenient(spark, sf_dir):
    """Objects, lists, texts and broken lines; without ``strict`` what is no object is null."""
    folder = _folder(spark, "lines")
    text = F.element_at(F.array(*[F.lit(x) for x in ('{"a": 1}', "[1, 2]", '"x"', "{broken")]), (F.col("k") % 4 + 1).cast("int"))
    fx.table(spark, sf_dir, fx.BASE).select(text.alias("value")).write.text(folder)
    rows = ingest.read_documents(spark, folder, strict=False)
    return rows.agg(F.count("document").alias("objects"), F.count_if(F.col("document").isNull()).alias("others"))
