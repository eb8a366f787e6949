"""Rollups over emission records and the merge of assessments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.scalars import strip, template_key

FLAGS = ["has_loop", "has_branching", "has_arithmetic"]


def families(records: DataFrame) -> DataFrame:
    """One row a template key, over records with templates array, flags, counts, source_file and line range."""
    rows = records.withColumn("template", F.explode("templates")).withColumn("family", template_key(F.col("template")))
    helpers = F.flatten(F.collect_set("helper_calls"))
    return rows.groupBy("family").agg(
        F.min("template").alias("representative"),
        F.sort_array(F.collect_set("template")).alias("templates"),
        F.sort_array(F.array_distinct(helpers)).alias("helpers"),
        F.sort_array(F.collect_set("source_file")).alias("sources"),
        *[F.bool_or(f).alias(f) for f in FLAGS],
        F.sum("unsupported_count").alias("unsupported_count"),
        F.max("statement_count").alias("max_statements"),
        F.max(F.col("line_end") - F.col("line_start") + 1).alias("max_lines"),
    )


def planning_rows(rolled: DataFrame) -> DataFrame:
    return rolled.select(
        "family",
        F.concat(F.lit("c-"), F.substring(F.sha2("family", 256), 1, 8)).alias("cluster_id"),
        F.array_join("sources", "; ").alias("sources"),
        F.array_join("templates", "; ").alias("templates"),
        "max_lines",
    )


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def fill_blanks(rows: DataFrame, assessments: DataFrame, key: str, columns: list[str], overwrite: bool = False, fingerprint: str | None = None) -> DataFrame:
    """Assessed values into blank cells (or all, with ``overwrite``); adds ``changed``.

    Assessments that repeat an id, name an unknown one or, with ``fingerprint``, were made for a row of another
    fingerprint fail the job: the guards are part of the plan.
    """
    told = [F.col(c).alias(f"_new_{c}") for c in [*columns, *([fingerprint] if fingerprint else [])]]
    one = assessments.groupBy(key).agg(F.first(F.struct(F.lit(True).alias("_new"), *told)).alias("_a"), F.count(F.lit(1)).alias("_times"))
    joined = rows.withColumn("_row", F.lit(True)).join(one.select(key, "_a.*", "_times"), key, "full")
    fails = lambda text: F.raise_error(F.concat(F.lit(f"{text} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")
    known = F.when(F.col("_row").isNull(), fails("assessments name an unknown id")).when(F.col("_times") > 1, fails("assessments repeat the id"))
    if fingerprint:
        known = known.when(F.col("_new") & ~F.col(fingerprint).eqNullSafe(F.col(f"_new_{fingerprint}")), fails("another fingerprint at"))
    joined = joined.where(known.otherwise(True))
    filled = {}
    for c in columns:
        blank = F.coalesce(strip(F.col(c)), F.lit("")) == ""
        take = F.col(f"_new_{c}").isNotNull() & (F.lit(overwrite) | blank)
        filled[c] = F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c))
    changed = F.array_contains(F.array(*[~filled[c].eqNullSafe(F.col(c)) for c in columns]), True)
    out = joined.withColumn("changed", changed)
    return out.withColumns(filled).select(*rows.columns, "changed")


def merge_counts(filled: DataFrame, columns: list[str]) -> DataFrame:
    blank = F.array_contains(F.array(*[F.coalesce(strip(F.col(c)), F.lit("")) == "" for c in columns]), True)
    return filled.agg(F.count_if("changed").alias("changed_rows"), F.count_if(blank).alias("still_blank"))
