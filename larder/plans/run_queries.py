"""Queries over whole runs: stored, merged from batches, streamed, by profile; with their SQL."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import fixtures as fx
from larder.functions import scalars as sc
from larder.operators import context as cx
from larder.operators import findings as fi
from larder.operators import parity as pa
from larder.operators.rules import ArrowRule, declarative, pack
from larder.plans import profiles
from larder.plans import runs as rn
from larder.plans.product_queries import (
    ALL_IDS, CTX, MISMATCH, OUTCOME, RANK, RULES, SOURCE, SOURCE_IDS, SUMMARY, _folder, _stored, enriched_contexts, findings_sql,
    parity_diff, query, source_contexts, source_rows,
)
from larder.plans.run_tables import COUNTS, ResultStore, RunTables, batch_states, merged_states
from larder.streaming.incremental import write_batches

# ---------------------------------------------------------------- a whole run

#: What an outside system is said to have found, apart from our findings: (template, code, severity), claimed for two of five keys in turn.
CLAIMS = [(r.id, r.id, r.severity or "warning") for r in RULES if r.baseline == "legacy" and "${" not in r.id]
CLAIMS += [(f"en:food-groups-${{level}}-{w}", f"en:food-groups-{n}-{w}", "info") for n in (1, 2, 3) for w in ("known", "unknown")]
CLAIMS += [
    ("en:${set_id}-energy-value-in-${unit}-does-not-match-value-computed-from-other-nutrients", f"en:{s}-energy-value-in-{u}-does-not-match-value-computed-from-other-nutrients", v)
    for s, v in (("nutrition", "warning"), ("nutrition-packaging-as-sold-100g", "error")) for u in ("kj", "kcal")
]
CLAIMS += [(CLAIMS[0][0], CLAIMS[0][1], "bug"), (None, "en:no-such-code", "bug")]  # one code at two severities, and an unknown one
_CLAIMED = "(k + {n} * 7) % 5 < 2"


def _claimed() -> Column:
    """The outside system's findings of a key k as five arrays of codes."""
    none = F.array().cast("array<string>")
    of = lambda s: F.concat(none, *[F.when(F.expr(_CLAIMED.format(n=n)), F.array(F.lit(code))).otherwise(none) for n, (_, code, sev) in enumerate(CLAIMS) if sev == s])
    return F.struct(*[of(s).alias(s) for s in sc.SEVERITIES]).alias("legacy_check_tags")


def _product() -> list[Column]:
    """A product id as its number, and as text only where that is not the number's own: shuffled by the billion, numbers are shorter."""
    number = F.expr("try_cast(product_id as bigint)")
    own = F.lpad(number.cast("string"), 13, "0") == F.col("product_id")
    return [F.when(own, number).alias("number"), F.when(~F.coalesce(own, F.lit(False)), F.col("product_id")).alias("text")]


def run_differences(rows: DataFrame, again: DataFrame | None) -> DataFrame:
    """Differences of contexts with k and legacy_check_tags; ``again`` has the codes that several rows may have, which are compared by a shuffle."""
    found = lambda some: fi.with_emissions(some, fi.emissions(RULES), "k", "legacy_check_tags")
    if again is None:
        return pa.difference_within(found(rows), "k", RULES)
    several = rows.join(again, "code", "left_semi")
    apart = pa.difference(pa.reference_findings(several, RULES), fi.observed(fi.evaluate(several, RULES)))
    return pa.difference_within(found(rows.join(again, "code", "left_anti")), "k", RULES).unionByName(apart)


def run_full(spark: SparkSession, sf_dir: str) -> tuple[RunTables, str]:
    """All 45 rules on enriched rows against the outside system's findings: differences, batches, mismatches and summaries, stored by run."""
    tables, run_id = RunTables(spark, _folder(spark, "runs")), "full"
    states = rn.RunStore(spark, tables.folder)
    rules = fi.rules_table(spark, RULES)
    # k is of one row, and so is a code that reads as its own k.  Only the others, and what they read as, may be of several rows.
    coded = fx.table(spark, sf_dir, fx.SOURCE).where("code <> ''").select("code", (~F.col("k").eqNullSafe(F.expr("try_cast(code as bigint)"))).alias("odd"))
    products, odd = coded.agg(F.count(F.lit(1)), F.count_if("odd")).first()
    again = _stored(coded.where("odd").select("code").distinct(), "codes") if odd else None
    states.start(run_id, sf_dir.rstrip("/").rpartition("/")[2], products)
    batch = F.col("product_id").cast("bigint") % 16
    rows = enriched_contexts(spark, sf_dir, with_key=True).where("code <> ''").withColumn("legacy_check_tags", _claimed())
    tables.write("run_differences", run_id, run_differences(rows, again).withColumn("batch_index", batch))
    diff = tables.read("run_differences", run_id).drop("run_id", "batch_index")
    tables.write("run_check_summaries", run_id, pa.summarize(diff, rules))
    legacy = rules.where("baseline <> 'none'").select("check_id")
    tables.write("run_mismatches", run_id, pa.mismatches(diff.join(F.broadcast(legacy), "check_id", "left_semi")).withColumn("batch_index", batch))
    counted = diff.groupBy(batch.alias("batch_index")).agg(F.sum("n_reference").alias("reference_finding_count"), F.sum("n_migrated").alias("migrated_finding_count"))
    held = diff.select(batch.alias("batch_index"), *_product()).distinct().groupBy("batch_index").agg(F.count(F.lit(1)).alias("row_count"))
    timings = counted.withColumn("run_id", F.lit(run_id))
    tables.write("run_batches", run_id, rn.with_timings(held.withColumn("run_id", F.lit(run_id)), timings).drop("run_id"))
    states.finish(run_id, sf_dir.rstrip("/").rpartition("/")[2], products, rn.artifact_text("run", 1, {"products": products}, {"run_id": run_id}))
    return tables, run_id


FULL = f"""found as (select f.*, coalesce(f.emitted_code, f.check_id) as observed_code from ({findings_sql(ALL_IDS, True)}) f where f.product_id <> ''),
claims as (select unnest([{", ".join(f"{{'n': {n}, 'check_id': {'null' if i is None else chr(39) + i + chr(39)}, 'code': '{c}', 'severity': '{s}'}}" for n, (i, c, s) in enumerate(CLAIMS))}], recursive := true)),
ref as (select s.code as product_id, c.check_id, c.code as observed_code, arg_max(c.severity, {RANK.format(c="c.severity")}) as severity
  from ({SOURCE}) s join claims c on (s.k + c.n * 7) % 5 < 2 where s.code <> '' and c.check_id is not null group by 1, 2, 3),
diff as (select check_id, product_id, observed_code, severity, sum(r) as n_reference, sum(m) as n_migrated, least(sum(r), sum(m)) as matched,
  greatest(sum(r) - sum(m), 0) as missing, greatest(sum(m) - sum(r), 0) as extra
  from (select check_id, product_id, observed_code, severity, 1 as r, 0 as m from ref union all select check_id, product_id, observed_code, severity, 0, 1 from found) x group by all),
rules as (select * from (values {", ".join(f"('{r.id}', '{r.language}', '{r.baseline}')" for r in RULES)}) r(check_id, language, baseline)),
summary as (select r.check_id, r.language, r.baseline, case when r.baseline <> 'none' then 'compared' else 'runtime_only' end as status,
  case when r.baseline <> 'none' then coalesce(sum(d.missing), 0) = 0 and coalesce(sum(d.extra), 0) = 0 end as passed,
  {", ".join(f"cast(case when r.baseline <> 'none' then coalesce(sum(d.{n}), 0) else 0 end as bigint) as {n}" for n in COUNTS)}
  from rules r left join diff d on d.check_id = r.check_id group by r.check_id, r.language, r.baseline)"""


@query("run_full", f"""with {FULL} select s.*, least(s.missing, 20) as missing_examples, least(s.extra, 20) as extra_examples, {OUTCOME} as outcome,
  (select count(distinct try_cast(product_id as bigint) % 16) from diff) as batches, (select cast(sum(n_reference) as bigint) from diff) as reference_total,
  (select count(*) from ({SOURCE}) x where code <> '') as products from summary s""")
def run_full_query(spark, sf_dir):
    """The stored run, read back: summaries, kept examples, batches, and the run's own row."""
    tables, run_id = run_full(spark, sf_dir)
    shown = pa.stored_examples(tables.read("run_mismatches", run_id))
    report = rn.report_rows(tables.read("run_check_summaries", run_id).drop("run_id"), shown).drop("card", "mismatches", "search_text")
    batches = tables.read("run_batches", run_id).groupBy("run_id").agg(F.count(F.lit(1)).alias("batches"), F.sum("reference_finding_count").alias("reference_total"))
    state = rn.RunStore(spark, tables.folder).load(run_id).select("run_id", F.col("product_count").alias("products"))
    return report.withColumn("run_id", F.lit(run_id)).join(batches, "run_id").join(state, "run_id").drop("run_id")  # one row of each side


@query("run_review", f"""with {FULL}, m as (select check_id, product_id, observed_code, severity, 'missing' as kind, missing as n from diff where missing > 0 union all
  select check_id, product_id, observed_code, severity, 'extra', extra from diff where extra > 0)
  select kind, severity, cast(sum(n) as bigint) as n, count(distinct product_id) as products from m where check_id in (select check_id from rules where baseline <> 'none') group by kind, severity""")
def run_review(spark, sf_dir):
    """Mismatches of a stored run by kind and severity."""
    tables, run_id = run_full(spark, sf_dir)
    rows = tables.read("run_mismatches", run_id)
    counted = rows.groupBy("kind", "severity").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(review_products(rows)), ["kind", "severity"])  # ten rows at most


def review_products(rows: DataFrame) -> DataFrame:
    """How many products have mismatches of a kind and severity: a product is shuffled once, with a bit for each of these."""
    sides = [(kind, severity) for kind in ("missing", "extra") for severity in sc.SEVERITIES]
    unknown = F.raise_error(F.concat_ws(" ", F.lit("unknown kind or severity:"), "kind", "severity")).cast("int")
    bit = functools.reduce(lambda acc, i: acc.when((F.col("kind") == sides[i][0]) & (F.col("severity") == sides[i][1]), 1 << i), range(1, len(sides)), F.when((F.col("kind") == sides[0][0]) & (F.col("severity") == sides[0][1]), 1))
    bits = rows.select(*_product(), bit.otherwise(unknown).alias("bit")).groupBy("number", "text").agg(F.bit_or("bit").alias("bits"))
    counts = bits.agg(*[F.count_if(F.col("bits").bitwiseAND(1 << i) != 0).alias(str(i)) for i in range(len(sides))])
    each = [F.struct(F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), F.col(str(i)).alias("products")) for i, (kind, severity) in enumerate(sides)]
    return counts.select(F.inline(F.array(*each)))


# ---------------------------------------------------------------- batches that arrive one by one

_EXAMPLES = "coalesce(string_agg(product_id || ' ' || observed_code, '|' order by rank) filter (side = '{0}'), '')"


@query("batches_merged", f"""with {SUMMARY}, mis as (select * from (with {MISMATCH} select * from mis) x where check_id in (select check_id from rules where baseline <> 'none')),
top as (select * from (select *, row_number() over (partition by check_id, side order by try_cast(product_id as bigint) % 16, product_id, observed_code, severity, copy) as rank from mis) x where rank <= 5),
ex as (select check_id, {_EXAMPLES.format('reference')} as missing_examples, {_EXAMPLES.format('migrated')} as extra_examples from top group by check_id)
select s.*, coalesce(e.missing_examples, '') as missing_examples, coalesce(e.extra_examples, '') as extra_examples from summary s left join ex e on e.check_id = s.check_id""")
def batches_merged(spark, sf_dir):
    """Sixteen batches stored one by one, three of them delivered twice, and the run that they add up to."""
    tables, run_id = RunTables(spark, _folder(spark, "batches")), "batched"
    rules = fi.rules_table(spark, [r for r in RULES if r.id in SOURCE_IDS])
    batch = F.col("product_id").cast("bigint") % 16
    states = _stored(batch_states(parity_diff(spark, sf_dir), rules, batch, 5), "states")
    for number in [*range(16), 3, 7, 11]:
        tables.write("run_batch_states", run_id, states.where(F.col("batch_index") == number), batch=number)
    merged = merged_states(tables.read("run_batch_states", run_id), rules, 5)
    text = lambda c: F.array_join(F.transform(c, lambda e: F.concat_ws(" ", e["product_id"], e["observed_code"])), "|").alias(c)
    return merged.select("check_id", "language", "baseline", "status", "passed", *COUNTS, text("missing_examples"), text("extra_examples"))


# ---------------------------------------------------------------- stored results


@query("results_upserted", f"""select code, case when k % 7 = 0 then -k when k % 3 = 0 then k * 2 else k end as result, (k % 3 = 0 or k % 7 = 0)::int as round
  from ({SOURCE}) s where code <> '' and (k % 2 = 0 or k % 3 = 0 or k % 7 = 0)""")
def results_upserted(spark, sf_dir):
    """Three rounds of results on disk; later ones replace those of the same code."""
    asked = fx.table(spark, sf_dir, fx.SOURCE).where("code <> ''")
    store = ResultStore(spark, _folder(spark, "results"), "code string, result long, round int", 16)
    for where, result, number in (("k % 2 = 0", F.col("k"), 0), ("k % 3 = 0", F.col("k") * 2, 1), ("k % 7 = 0", -F.col("k"), 1)):
        store.upsert(asked.where(where).select("code", result.alias("result"), F.lit(number).alias("round")))
    return store.read()


# ---------------------------------------------------------------- findings of a stream


@query("findings_streamed", findings_sql(SOURCE_IDS, False))
def findings_streamed(spark, sf_dir):
    """Source rows in eight files or as many as tasks, read as a stream in three micro-batches; a second start from the checkpoint finds nothing new."""
    folder = _folder(spark, "stream")
    rows = source_rows(spark, sf_dir)
    files = max(8, fx.partitions(spark, sf_dir))  # a micro-batch has as many tasks as files at least, so these grow with the rows
    rows.repartition(files).write.parquet(f"{folder}/rows")
    rules = fi.select_rules(RULES, paths=cx.SOURCE_PATHS)
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files * 3 // 8)).parquet(f"{folder}/rows")
        write_batches(stream, rules, f"{folder}/findings", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/findings").drop("batch")


# ---------------------------------------------------------------- many rules, Python rules, profiles

MANY = 5000
_CODE = """case when k % 11 = 0 then concat('x:exact-', cast(k % 7000 as string)) when k % 11 = 1 then concat('x:p', cast(k % 7000 as string), '-a b-end')
  when k % 11 = 2 then concat('x:p', cast(k % 7000 as string), '-a:b-end') when k % 11 = 3 then concat('x:p', cast(k % 7000 as string), '--end')
  when k % 11 = 4 then concat('v', cast(k % 9 as string), ':tail-', cast(k % 40 as string)) else concat('x:p', cast(k % 7000 as string), '-v', cast(k % 5 as string), '-end') end"""


@query("reference_match_many", f"""with c as (select k, {_CODE} as raw_code from ({fx.for_duckdb(fx.BASE)}) b)
  select k, raw_code, case when k % 11 = 0 then raw_code when k % 11 = 4 then '${{any}}:tail-' || (k % 40) else 'x:p' || (k % 7000) || '-${{v}}-end' end as check_id
  from c where case when k % 11 = 4 then k % 40 < 20 else k % 7000 < {MANY} end and k % 11 not in (1, 2, 3)""")
def reference_match_many(spark, sf_dir):
    """Codes against ten thousand rules of a user: exact ones, templates, and twenty that start with a placeholder."""
    ids = [f"x:exact-{n}" for n in range(MANY)] + [f"x:p{n}-${{v}}-end" for n in range(MANY)] + [f"${{any}}:tail-{n}" for n in range(20)]
    rules = [declarative(i, "info", {"field": "code", "op": "is_missing"}, baseline="legacy") for i in ids]
    raw = fx.table(spark, sf_dir, fx.BASE).select("k", F.expr(_CODE).alias("raw_code"))
    return pa.match_indexed(raw, pa.template_index(spark, rules)).select("k", "raw_code", "check_id")


def _serving_text(row: dict) -> list[tuple[str | None, str]]:
    size, quantity = row["product.serving_size"], row["product.serving_quantity"]
    return [(f"py:serving-{size.split()[0]}", "info")] if size and size.strip() and quantity is not None and quantity > 40 else []


def _two_labels(row: dict) -> list[tuple[str | None, str]]:
    return [(None, "warning")] * (len(row["product.labels_tags"]) > 4)


@query("findings_mixed_pack", f"""with {CTX} select c.code as product_id, 'x:heavy' as check_id, 'error' as severity, cast(null as varchar) as emitted_code from ctx c where c.pq > 5000 union all
  select c.code, 'py:serving', 'info', 'py:serving-' || string_split(c.serving_size, ' ')[1] from ctx c where trim(coalesce(c.serving_size, '')) <> '' and c.sq > 40 union all
  select c.code, 'py:labels', 'warning', null from ctx c where len(list_filter(string_split(c.labels_tags, ','), lambda x: trim(x) <> '')) > 4""")
def findings_mixed_pack(spark, sf_dir):
    """One built-in rule and two in Python, in one pass."""
    native = pack([{"id": "x:heavy", "severity": "error", "when": {"field": "product.product_quantity", "op": "gt", "value": 5000}}])
    python = [ArrowRule("py:serving", ["product.serving_size", "product.serving_quantity"], _serving_text), ArrowRule("py:labels", ["product.labels_tags"], _two_labels)]
    return fi.evaluate_mixed(source_contexts(spark, sf_dir), native, python)


PROFILES = {
    "default_profile": "all",
    "profiles": {
        "all": {"description": "All rules of source rows with a legacy baseline.", "mode": "all", "check_context_provider": "source_products"},
        "canada": {"description": "Rules of Canada.", "mode": "all", "check_context_provider": "source_products", "parity_baselines": ["none"], "jurisdictions": ["ca"]},
        "focus": {
            "description": "A few rules.", "mode": "include", "check_context_provider": "source_products",
            "check_ids": ["en:serving-quantity-over-product-quantity", "en:quantity-not-recognized"],
        },
    },
}
_ACTIVE = {"all": "f.check_id not like 'ca:%'", "canada": "f.check_id like 'ca:%'", "focus": "f.check_id in ('en:serving-quantity-over-product-quantity', 'en:quantity-not-recognized')"}


@query("profile_findings", f"with f as ({findings_sql(SOURCE_IDS, False)}) " + " union all ".join(
    f"select '{n}' as profile, check_id, count(*) as n from f where {c} group by check_id" for n, c in _ACTIVE.items()))
def profile_findings(spark, sf_dir):
    """Findings of each profile's rules: those of the source rows, by rule."""
    contexts = source_contexts(spark, sf_dir)
    parts = []
    for name in PROFILES["profiles"]:
        rules = profiles.active_rules(spark, RULES, profiles.profile_of(PROFILES, name))
        parts.append(fi.evaluate(contexts, rules).groupBy(F.lit(name).alias("profile"), "check_id").agg(F.count(F.lit(1)).alias("n")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
