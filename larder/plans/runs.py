"""Run tables and the review queries over them."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Outcomes of a rule.
BUCKETS = ["pass", "mixed", "legacy_only", "migrated_only", "runtime_only"]
# Seconds that a run and each of its batches record, and counts of a batch.
PREPARATION = ["prepare_run_seconds", "source_snapshot_id_seconds", "dataset_profile_load_seconds", "source_row_count_seconds"]
BATCH_COUNTS = ["cache_hit_count", "backend_run_count", "reference_finding_count", "migrated_finding_count"]
BATCH_SECONDS = [
    "elapsed_seconds", "source_read_seconds", "reference_load_seconds", "reference_check_context_materialization_seconds",
    "reference_finding_materialization_seconds", "migrated_findings_seconds", "parity_compare_seconds", "record_batch_seconds",
]
PROFILE = "run_id string, profile_name string, description string, selection_kind string, selection_fingerprint string, selection_json string"


def now_utc() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


class RunStore:
    """Parquet tables of runs under one folder; rows are appended, the latest state of a run wins."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def append(self, table: str, rows: DataFrame, by_run: bool = False) -> None:
        writer = rows.write.mode("append")
        (writer.partitionBy("run_id") if by_run else writer).parquet(f"{self.folder}/{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}")

    def start(self, run_id: str, snapshot: str, products: int, at: str | None = None, seconds: dict[str, float] | None = None) -> None:
        self._state(run_id, "running", snapshot, products, None, None, None, at, seconds)

    def finish(self, run_id: str, snapshot: str, products: int, artifact: str | None = None, failure: BaseException | None = None, at: str | None = None, seconds: dict[str, float] | None = None) -> None:
        status = "completed" if failure is None else "incomplete" if isinstance(failure, KeyboardInterrupt) else "failed"
        self._state(run_id, status, snapshot, products, artifact, type(failure).__name__ if failure else None, str(failure) if failure else None, at, seconds)

    def _state(self, run_id, status, snapshot, products, artifact, kind, text, at, seconds) -> None:
        unknown = set(seconds or {}) - set(PREPARATION)
        if unknown:
            raise ValueError(f"unknown timings: {', '.join(sorted(unknown))}")
        rows = [(run_id, status, at or now_utc(), snapshot, products, artifact, kind, text, *[float((seconds or {}).get(n, 0.0)) for n in PREPARATION])]
        schema = "run_id string, status string, recorded_at_utc string, source_snapshot_id string, product_count long, run_artifact_json string, failure_type string, failure_message string"
        self.append("runs", self.spark.createDataFrame(rows, ", ".join([schema, *[f"{n} double" for n in PREPARATION]])))

    def profile(self, run_id: str, name: str, description: str, kind: str, selection: dict) -> None:
        """The selection of products that a run used; its fingerprint is that of the selection's JSON text."""
        text = json.dumps(selection, sort_keys=True)
        rows = self.spark.createDataFrame([(run_id, name, description, kind, text)], "run_id string, profile_name string, description string, selection_kind string, selection_json string")
        self.append("run_dataset_profiles", rows.withColumn("selection_fingerprint", F.sha2("selection_json", 256)).select(*self.spark.createDataFrame([], PROFILE).columns))

    def load_with_profile(self, run_id: str) -> DataFrame:
        """The completed run with its selection, nulls where none was recorded."""
        return self.load(run_id).join(self.read("run_dataset_profiles"), "run_id", "left")

    def artifact(self, run_id: str, kind: str, version: int) -> dict:
        """The artifact of a completed run, of this kind and version only."""
        return read_artifact(self.load(run_id).first()["run_artifact_json"], kind, version)

    def load(self, run_id: str) -> DataFrame:
        """The latest state of a completed run; anything else is an error."""
        state = latest_state(self.read("runs").where(F.col("run_id") == run_id))
        row = state.first()
        if row is None:
            raise LookupError(f"run {run_id} not found")
        if row["status"] != "completed":
            raise ValueError(f"run {run_id} is {row['status']}")
        if row["run_artifact_json"] is None:
            raise ValueError(f"run {run_id} has no artifact")
        return state


def latest_state(runs: DataFrame) -> DataFrame:
    """One row a run: a terminal state beats running, then the later time wins."""
    order = F.struct((F.col("status") != "running").cast("int").alias("t"), "recorded_at_utc")
    names = [c for c in runs.columns if c != "run_id"]
    best = runs.groupBy("run_id").agg(F.max_by(F.struct(*names), order).alias("s"))
    return best.select("run_id", "s.*")


def artifact_text(kind: str, version: int, source_input: dict, run: dict) -> str:
    """The JSON text of a run: kind and version, the summary of its input, and what the run holds."""
    return json.dumps({"kind": kind, "schema_version": version, "source_input": source_input, **run})


def read_artifact(text: str, kind: str, version: int) -> dict:
    """What :func:`artifact_text` wrote, without kind and version; others of these are an error."""
    found = json.loads(text)
    for name, wanted in (("kind", kind), ("schema_version", version)):
        if found.pop(name, None) != wanted:
            raise ValueError(f"the run artifact has another {name} than {wanted!r}")
    return found


def batches(findings: DataFrame, slice_of: Column, sides: str = "side") -> DataFrame:
    """Per slice of the products: rows and findings of each side."""
    return findings.groupBy(slice_of.alias("batch_index")).agg(
        F.count_distinct("product_id").alias("row_count"),
        F.count_if(F.col(sides) == "reference").alias("reference_finding_count"),
        F.count_if(F.col(sides) == "migrated").alias("migrated_finding_count"),
    )


def timing_summary(batch_rows: DataFrame) -> DataFrame:
    """Batches and summed timings and counts by run."""
    names = [c for c in batch_rows.columns if c not in ("run_id", "batch_index")]
    return batch_rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("batches"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def with_timings(batch_rows: DataFrame, timings: DataFrame) -> DataFrame:
    """Batches with the callers' seconds and counts by run_id and batch_index; what wasn't measured is zero."""
    keys = ["run_id", "batch_index"]
    both = batch_rows.join(timings, keys, "left")
    zero = [F.coalesce(n, F.lit(0)).alias(n) if n in both.columns else F.lit(0).alias(n) for n in BATCH_COUNTS]
    zero += [F.coalesce(n, F.lit(0.0)).alias(n) if n in both.columns else F.lit(0.0).alias(n) for n in BATCH_SECONDS]
    return both.select(*keys, "row_count", *zero)


def benchmark_summary(runs: DataFrame, batch_rows: DataFrame) -> DataFrame:
    """By run: its latest state, the seconds of its preparation, and the sums over its batches."""
    zero = {n: 0 for n in ("batches", *BATCH_COUNTS)} | {n: 0.0 for n in BATCH_SECONDS}
    sums = timing_summary(batch_rows.select("run_id", "batch_index", *BATCH_COUNTS, *BATCH_SECONDS))
    return latest_state(runs).select("run_id", "status", "product_count", *PREPARATION).join(sums, "run_id", "left").fillna(zero)


def outcome() -> Column:
    return (
        F.when(F.col("status") == "runtime_only", "runtime_only")
        .when((F.col("missing") == 0) & (F.col("extra") == 0), "pass")
        .when((F.col("missing") > 0) & (F.col("extra") > 0), "mixed")
        .when(F.col("missing") > 0, "legacy_only")
        .otherwise("migrated_only")
    )


def card_status() -> Column:
    return F.when(F.col("status") == "runtime_only", "runtime").when(F.col("passed"), "pass").otherwise("fail")


def report_rows(summary: DataFrame, examples: DataFrame) -> DataFrame:
    """Rules with outcome, totals, kept examples and a search text, in report order."""
    kept = examples.groupBy("check_id").agg(F.count_if(F.col("side") == "reference").alias("missing_examples"), F.count_if(F.col("side") == "migrated").alias("extra_examples"))
    rows = summary.join(kept, "check_id", "left").fillna(0, ["missing_examples", "extra_examples"])
    rows = rows.withColumn("outcome", outcome()).withColumn("card", card_status()).withColumn("mismatches", F.col("missing") + F.col("extra"))
    rows = rows.withColumn("search_text", F.lower(F.concat_ws(" ", "check_id", "language", "outcome")))
    priority = F.array_position(F.array(*[F.lit(b) for b in ("mixed", "legacy_only", "migrated_only", "runtime_only", "pass")]), F.col("outcome"))
    return rows.orderBy(F.desc("mismatches"), priority, F.desc("missing"), F.desc("extra"), "check_id")


def composition(summary: DataFrame) -> DataFrame:
    """Count and percent of each of the five outcomes, zeros included."""
    spark = summary.sparkSession
    buckets = spark.createDataFrame([(b,) for b in BUCKETS], "outcome string")
    counts = summary.groupBy(outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    rows = buckets.join(counts, "outcome", "left").fillna(0, ["n"])
    total = F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(1))  # five rows
    return rows.select("outcome", "n", (F.col("n") * 100.0 / total).alias("percent"))


def rule_counts(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_if(F.col("passed")).alias("matching"), F.count_if(~F.col("passed")).alias("mismatching"), F.count_if(F.col("passed").isNull()).alias("runtime_only")
    )


def messages(findings: DataFrame) -> DataFrame:
    """Different codes of each rule, sorted."""
    return findings.groupBy("check_id").agg(F.sort_array(F.collect_set(F.coalesce("emitted_code", "check_id"))).alias("codes"))
