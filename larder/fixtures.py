"""Product tables derived from the driver's tables by SQL that Spark and DuckDB read alike.

Placeholders in braces name tables, EACH(SERIES(a, b)) is one row a number; k is the product key.  Keys of ``lineitem`` repeat, so
they are grouped first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = """
select b.k as k, b.q as q, p.p_name as p_name, cast(p.p_size as bigint) as p_size
from (select l_orderkey * 10 + l_linenumber as k, max(l_quantity) as q, max(l_partkey) as pk
      from {lineitem} group by l_orderkey * 10 + l_linenumber) b
join {part} p on p.p_partkey = b.pk
"""

SOURCE = f"""
select k,
  case when k % 97 = 0 then '' when k % 89 = 0 then null else lpad(cast(k as string), 13, '0') end as code,
  case when k % 53 = 0 then '0' when k % 59 = 0 then null else cast(1500000000 + k as string) end as created_t,
  case when k % 11 = 0 then '  ' when k % 13 = 0 then null else p_name end as product_name,
  case when k % 7 = 0 then null when k % 31 = 0 then '' else concat(cast(p_size as string), ' g') end as quantity,
  case when k % 17 = 0 then 'abc' when k % 19 = 0 then '1_000' when k % 23 = 0 then '0.5' when k % 29 = 0 then ' 12000 '
       when k % 37 = 0 then '31000' when k % 43 = 1 then null else cast(p_size * 10 as string) end as product_quantity,
  case when k % 5 = 0 then null when k % 33 = 1 then ' ' else concat(cast(p_size as string), ' ml') end as serving_size,
  case when k % 41 = 0 then '' when k % 43 = 0 then '0.2' when k % 47 = 0 then '600' when k % 6 = 1 then null
       else cast(cast(q as bigint) as string) end as serving_quantity,
  case when k % 5 = 0 then ' A ' when k % 5 = 1 then 'b' when k % 5 = 2 then null when k % 5 = 3 then '' else 'E' end as nutriscore_grade,
  case when k % 4 = 0 then null when k % 4 = 1 then '' else 'FR 01' end as emb_codes,
  concat_ws(',', case when k % 3 = 0 then ' en:alcoholic-beverages' end, case when k % 4 = 0 then 'en:non-alcoholic-beverages ' end,
    case when k % 6 = 0 then 'en:plant-milks' end, case when k % 9 = 0 then 'en:dairies' end) as categories_tags,
  concat_ws(',', case when k % 3 = 0 then 'en:no-fat' end, case when k % 5 = 0 then ' en:saturated-fat-free ' end,
    case when k % 5 = 1 then 'en:no-sugar' end, case when k % 7 = 0 then 'en:no-added-sugar' end, case when k % 2 = 0 then 'en:source-of-fibre' end,
    case when k % 8 = 1 then 'en:source-of-omega-3-polyunsaturates' end, case when k % 6 = 1 then 'en:source-of-omega-3' end,
    case when k % 10 = 3 then 'en:trans-fat-free' end, case when k % 5 = 2 then 'en:vegan' end) as labels_tags,
  concat_ws(',', 'en:water', case when k % 3 = 1 then 'en:added-sugar' end, case when k % 14 = 0 then ' ' end) as ingredients_tags,
  case when k % 2 = 0 then 'en:france' else 'en:canada,en:france' end as countries_tags,
  case when k % 10 = 9 then null else cast(k % 101 as double) / 10 end as fat,
  case when k % 10 = 8 then null else cast(k % 31 as double) / 10 end as saturated_fat,
  case when k % 12 = 7 then null else cast(k % 5 as double) / 10 end as trans_fat,
  case when k % 9 = 4 then null else cast(k % 300 as double) / 10 end as sugars,
  case when k % 8 = 3 then null else cast(k % 40 as double) / 10 end as fiber,
  case when k % 15 = 2 then null else cast(k % 500 as double) end as kcal,
  case when k % 7 = 3 then null else cast(k % 60 as double) / 100 end as omega3,
  case when k % 4 = 2 then null else cast(k % 70 as double) / 100 end as ala,
  case when k % 3 = 2 then null else cast(k % 9 as double) / 100 end as epa,
  case when k % 5 = 4 then null else cast(k % 7 as double) / 100 end as dha
from ({BASE}) base
"""

#: Flat enriched fields beside those of SOURCE.
ENRICHED = f"""
select s.*,
  case when k % 61 = 0 then null else 'en' end as lc,
  case when k % 67 = 0 then null when k % 71 = 0 then 'xx' else 'en' end as lang,
  case when k % 16 = 5 then null else cast(k % 3 as double) - 1 end as percent_analysis,
  case when k % 18 = 7 then null else cast(k % 4 as double) end as specified_n,
  case when k % 22 = 9 then null else cast(k % 3 as double) end as unspecified_n,
  cast(k % 250 as double) as specified_sum,
  cast(k % 20 as double) as unspecified_sum,
  case when k % 3 = 0 then true when k % 3 = 1 then false end as european,
  case when k % 4 < 2 then true when k % 4 = 2 then false end as animal,
  case when k % 11 = 0 then true when k % 11 < 6 then false end as ignore_energy,
  case when k % 5 = 1 then null else cast(k % 6 as double) end as minimum_ingredients,
  case when k % 7 = 0 then null when k % 7 = 1 then ' ' when k % 7 = 2 then 'A' else 'b' end as producer_grade,
  case when k % 5 = 0 then null else k % 5 - 1 end as food_groups_n,
  case when k % 6 = 0 then null else k % 3 end as packagings_n,
  k % 4 as top_ingredients_n
from ({SOURCE}) s
"""

#: Columns of a nutrition set s of a product k, and whether it has the set of number i.
SET_VALUES = """  case when s = 9 then null when (k + s) % 4 = 0 then 'packaging' when (k + s) % 4 = 1 then 'estimate' when (k + s) % 4 = 2 then null else '' end as source,
  case when s = 9 then null when (k + 2 * s) % 3 = 0 then 'as_sold' when (k + 2 * s) % 3 = 1 then 'prepared' end as preparation,
  case when s = 9 then null when (k + s) % 2 = 0 then '100g' else 'Serving !' end as per,
  case when (k + s) % 9 = 0 then null else (k * 7 + s * 13) % 500 end as kcal,
  case when (k + s) % 8 = 0 then null else (k * 11 + s * 5) % 500 end as kcal_computed,
  (k * 3 + s) % 2000 as kj,
  (k * 5 + s * 7) % 2000 as kj_computed,
  case when (k + s) % 6 = 5 then null else (k * 13 + s) % 700 end as carbs10,
  case when (k + s) % 5 = 4 then null else (k + s * 3) % 300 end as sugars10,
  case when k % 7 = 0 then null else (k * 2) % 200 end as starch10,
  (k + s) % 100 as fiber10,
  k % 101 as fat10,
  k % 31 as saturated10,
  k % 5 as trans10,
  k % 60 as omega100,
  case when (k + s) % 4 = 2 then null else k % 70 end as ala100,
  case when (k + s) % 3 = 2 then null else k % 9 end as epa100,
  k % 7 as dha100"""
SET_EXISTS = "(i < 3 and k % 4 > i) or (i = 3 and k % 5 > 0)"
#: The same of an ingredient by its depth and node.
NODE_VALUES = """  case when (k + depth + node) % 10 = 3 then 'en:added-sugar' else concat('en:i', cast((k + depth * 7 + node) % 50 as string)) end as id,
  case when (k + depth + node) % 6 < 4 then 'yes' when (k + depth + node) % 12 = 4 then ' Unknown ' when (k + depth + node) % 12 = 10 then 'maybe'
       when (k + depth + node) % 12 = 5 then null else '' end as vegan"""
NODE_EXISTS = "(i < 3 and k % 4 > i) or (i = 3 and k % 4 > 0 and k % 3 = 0) or (i = 4 and k % 4 > 0 and k % 6 = 0)"

#: One row a nutrition set: s = 0, 1, 2 are input sets, 9 is the aggregated set.
NUTRITION = f"""
select k, s,
{SET_VALUES}
from (select k, cast(case i when 3 then 9 else i end as int) as s
      from (select k, EACH(SERIES(0, 3)) as i from ({BASE}) b) every_set
      where {SET_EXISTS}) sets
"""

#: One row an ingredient: node 0.. at depth 1, children of node 0 below.
INGREDIENTS = f"""
select k, depth, node,
{NODE_VALUES}
from (select k, cast(case i when 3 then 2 when 4 then 3 else 1 end as int) as depth, cast(case when i < 3 then i else 0 end as int) as node
      from (select k, EACH(SERIES(0, 4)) as i from ({BASE}) b) every_node
      where {NODE_EXISTS}) nodes
"""


def placed(text: str, **numbers: int) -> str:
    """An expression with numbers in place of these names."""
    for name, value in numbers.items():
        text = re.sub(rf"\b{name}\b", str(value), text)
    return text


def values_of(text: str, **numbers: int) -> dict[str, Column]:
    """The columns of a list of expressions, by name."""
    return {name: F.expr(placed(e, **numbers)) for e, name in re.findall(r"\s*(.+?) as (\w+)(?:,\n|\Z)", text, re.S)}


TABLES = ("lineitem", "part", "events", "orders", "customer")


def for_duckdb(sql: str) -> str:
    return sql.replace("EACH(SERIES(", "unnest(generate_series(").format(**{t: t for t in TABLES})


#: Rows of ``lineitem`` a task of derived rows: these are narrow, but what queries make of each is not, so partitions go by rows and not by bytes.
TASK_ROWS = 50_000


def partitions(spark: SparkSession, sf_dir: str) -> int:
    """How many partitions hold the derived rows."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of BASE, dealt out by k into partitions of bounded row counts; groupings and joins by k need no other shuffle.

    Rows of ``lineitem`` are dealt out before they are grouped.  The grouping would do so by itself, but into partitions that
    Spark puts together by their bytes, which leaves few tasks; the second dealing is dropped unless the join moved the rows.
    """
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part")}
    n = partitions(spark, sf_dir)
    used["lineitem"] = used["lineitem"].repartition(n, F.expr("l_orderkey * 10 + l_linenumber"))
    return spark.sql(BASE, **used).repartition(n, "k")


def table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    own = sql.replace(BASE, "select * from {base}")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in own}
    if own != sql:
        used["base"] = base(spark, sf_dir)
    return spark.sql(own.replace("EACH(SERIES(", "explode(sequence("), **used)
