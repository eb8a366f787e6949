"""Rules over contexts: one pass that emits a long table of findings."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.functions.scalars import apart, template_key
from larder.operators.rules import EMISSIONS, ArrowRule, Rule, packaged

ORDER = ["check_id", "product_id", "_code", "severity"]


def select_rules(
    rules: Iterable[Rule] | None = None,
    ids: Iterable[str] | None = None,
    baselines: Iterable[str] | None = None,
    jurisdictions: Iterable[str] | None = None,
    paths: Iterable[str] | None = None,
) -> list[Rule]:
    """Rules in order of id that fit the filters; an id that is unknown, filtered out or not runnable is an error."""
    every = sorted(packaged() if rules is None else rules, key=lambda r: r.id)
    if len({r.id for r in every}) < len(every):
        raise ValueError("rule ids repeat")
    fits = [
        r
        for r in every
        if (baselines is None or r.baseline in set(baselines)) and (jurisdictions is None or set(r.jurisdictions) & set(jurisdictions))
    ]
    if paths is not None:
        have = set(paths)
        fits = [r for r in fits if have.issuperset(r.requires)]
    if ids is None:
        return fits
    wanted = list(ids)
    missing = sorted(set(wanted) - {r.id for r in fits})
    if missing:
        raise ValueError(f"rules not available: {', '.join(missing)}")
    return [r for r in fits if r.id in set(wanted)]


def rules_table(spark: SparkSession, rules: list[Rule], paths: Iterable[str] | None = None) -> DataFrame:
    """Metadata of rules, with the required paths that are not among ``paths``."""
    rows = [
        (r.id, r.language, r.baseline, r.jurisdictions, r.requires, r.id if r.baseline == "legacy" else None) for r in rules
    ]
    out = spark.createDataFrame(
        rows, "check_id string, language string, baseline string, jurisdictions array<string>, requires array<string>, template string"
    )
    if paths is None:
        return out
    have = F.array(*[F.lit(p) for p in paths])
    missing = F.array_except("requires", have)
    return out.withColumn("missing", missing).withColumn("runnable", F.size(missing) == 0)


def repeated_identities(rules: DataFrame) -> DataFrame:
    """Template keys that two rules share."""
    return rules.where("template is not null").groupBy(template_key(F.col("template")).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("check_id")).alias("ids")
    ).where("n > 1")


def emissions(rules: list[Rule]) -> Column:
    """All emissions of all rules on one row: array<struct<check_id, raw_code, severity>>.

    Conditions stand in plain arrays, which Spark compiles: what is in a list function is interpreted with all its arguments.
    """
    kind = "array<struct<check_id:string,raw_code:string,severity:string>>"
    if not rules:
        return F.array().cast(kind)
    none = F.array().cast(kind)
    one = lambda r, hit, code, severity: F.when(hit, F.array(F.struct(F.lit(r.id).alias("check_id"), code.alias("raw_code"), severity.alias("severity")))).otherwise(none)

    def of(r: Rule, listed: Column) -> Column:
        named = lambda e: F.struct(F.lit(r.id).alias("check_id"), e["raw_code"].alias("raw_code"), e["severity"].alias("severity"))
        return F.transform(listed.cast(EMISSIONS), named)

    each = [one(r, r.test(), F.lit(None).cast("string"), F.lit(r.severity)) for r in rules if r.test is not None]
    each += [one(r, *place) for r in rules if r.places is not None for place in r.places()]
    each += [F.when(some, of(r, listed)).otherwise(none) for r in rules if r.rest is not None for some, listed in r.rest()]
    each += [of(r, r.emit()) for r in rules if r.test is None and r.places is None]
    return F.concat(none, *each)


def arrow_emissions(contexts: DataFrame, rules: list[ArrowRule]) -> Column:
    """Emissions of all Python rules on one row, by one Arrow function that gets the union of their fields."""
    paths = sorted({p for r in rules for p in r.requires})
    kinds = {p: contexts.select(F.col(p).alias("x")).dtypes[0][1] for p in paths}
    fields = F.struct(*[(F.to_json(F.col(p)) if kinds[p] == "variant" else F.col(p)).alias(p.replace(".", "__")) for p in paths])
    calls = [(r.id, {p: p.replace(".", "__") for p in r.requires}, r.find) for r in rules]

    def find(rows: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("check_id", pa.string()), ("raw_code", pa.string()), ("severity", pa.string())]))
        out = []
        for row in rows.to_pylist():
            one = [(i, code, severity) for i, names, f in calls for code, severity in f({p: row[n] for p, n in names.items()})]
            out.append([{"check_id": i, "raw_code": c, "severity": s} for i, c, s in one])
        return pa.array(out, kind)

    find.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(find, "array<struct<check_id:string,raw_code:string,severity:string>>")(fields)


def evaluate_mixed(contexts: DataFrame, rules: list[Rule], python: list[ArrowRule]) -> DataFrame:
    """As :func:`evaluate`, with Python rules beside the built-in ones: one pass over the rows, one Python node in the plan."""
    if not python:
        return evaluate(contexts, rules)
    both = contexts.withColumn("_python", arrow_emissions(contexts, python))
    return _long(both, F.concat(emissions(rules), F.col("_python")))


def fields_apart(contexts: DataFrame) -> DataFrame:
    """The same contexts with each field of a struct as a column first, so that a field is computed once for all rules that read it."""
    structs = {f.name: f.dataType.names for f in contexts.schema if isinstance(f.dataType, StructType)}
    names = [c for c in contexts.columns if c not in structs]
    flat = contexts.select(*names, *[F.col(c)[n].alias(f"{c}.{n}") for c, fields in structs.items() for n in fields])
    return flat.select(*names, *[F.struct(*[F.col(f"`{c}.{n}`").alias(n) for n in fields]).alias(c) for c, fields in structs.items()])


def with_emissions(contexts: DataFrame, listed: Column, *keep: str) -> DataFrame:
    """(keep, code, found): lists of emissions as a column, before they are taken apart; a generator would interpret them."""
    return fields_apart(contexts).select(*keep, apart(F.col("code")).alias("code"), listed.alias("found"))


def _long(contexts: DataFrame, listed: Column) -> DataFrame:
    """Lists of emissions as findings.  Nothing is appended to them: of a bare column Spark would test the size below, and evaluate all rules twice."""
    found = F.concat("found", F.array().cast("array<struct<check_id:string,raw_code:string,severity:string>>"))
    each = with_emissions(contexts, listed).select(F.col("code").alias("product_id"), F.explode(found).alias("e"))
    return each.select("product_id", "e.check_id", "e.severity", F.nullif("e.raw_code", "e.check_id").alias("emitted_code"))


def evaluate(contexts: DataFrame, rules: list[Rule]) -> DataFrame:
    """(product_id, check_id, severity, emitted_code); works on batch and streaming contexts, without a shuffle."""
    return _long(contexts, emissions(rules))


def ordered(findings: DataFrame) -> DataFrame:
    code = F.coalesce("emitted_code", "check_id")
    return findings.withColumn("_code", code).orderBy(*ORDER).drop("_code")


def observed(findings: DataFrame, side: str = "migrated") -> DataFrame:
    return findings.select(
        "product_id", "check_id", F.coalesce("emitted_code", "check_id").alias("observed_code"), "severity", F.lit(side).alias("side")
    )
