"""Tables of runs with declared schemas, a partition a run; batch states that add up to a run; stored results by code.

A written partition replaces the one of an earlier attempt and no other.  Readers of one run read its
partition only.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.operators.parity import KEY, mismatches
from larder.plans.runs import BATCH_COUNTS, BATCH_SECONDS

COUNTS = ["n_reference", "n_migrated", "matched", "missing", "extra"]
#: Rows of a product lie together and repeat its id, which takes a few bytes as long as the ids of a file fit its dictionary.
PACKED = {"compression": "zstd", "parquet.dictionary.page.size": str(16 << 20)}
_FINDING = "check_id string, product_id string, observed_code string, severity string"
_EXAMPLE = "struct<batch_index:bigint,product_id:string,observed_code:string,severity:string,copy:int>"
_COUNTED = ", ".join(f"{n} long" for n in COUNTS)
#: Columns of each table beside ``run_id``.
TABLES = {
    "run_differences": f"batch_index long, {_FINDING}, {_COUNTED}",
    "run_batches": "batch_index long, row_count long, " + ", ".join([*[f"{n} long" for n in BATCH_COUNTS], *[f"{n} double" for n in BATCH_SECONDS]]),
    "run_mismatches": f"batch_index long, {_FINDING}, kind string, side string, copy int",
    "run_check_summaries": f"check_id string, language string, baseline string, status string, passed boolean, {_COUNTED}",
    "run_batch_states": f"batch_index long, check_id string, language string, baseline string, status string, {_COUNTED}, missing_examples array<{_EXAMPLE}>, extra_examples array<{_EXAMPLE}>",
}


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


class RunTables:
    """Parquet tables of many runs under one folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, table: str, run_id: str, rows: DataFrame, batch: int | None = None) -> None:
        """A run's rows of a table (or those of one of its batches) in place of what an earlier attempt wrote."""
        if not re.fullmatch(r"[\w.-]+", run_id):
            raise ValueError(f"a run id holds letters, digits, dots, dashes and underscores only, not {run_id!r}")
        want = self.spark.createDataFrame([], TABLES[table]).schema
        apart = {f.name for f in want} ^ set(rows.columns)
        if apart:
            raise ValueError(f"{table}: columns are missing or unknown: {', '.join(sorted(apart))}")
        part = f"{self.folder}/{table}/run_id={run_id}"
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want])
        typed.write.mode("overwrite").options(**PACKED).parquet(part if batch is None else f"{part}/part={batch}")

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """Rows of all runs, or of one whose partition alone is read."""
        names = [n.split()[0] for n in TABLES[table].split(", ") if " " in n]
        path = f"{self.folder}/{table}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], f"run_id string, {TABLES[table]}")
        rows = self.spark.read.schema(f"{TABLES[table]}, run_id string").parquet(path)
        rows = rows.select("run_id", *[n for n in rows.columns if n != "run_id"]) if names else rows
        return rows if run_id is None else rows.where(F.col("run_id") == run_id)


# ---------------------------------------------------------------- batches of a run


def batch_states(diff: DataFrame, rules: DataFrame, batch: Column, most: int = 20) -> DataFrame:
    """What each batch adds to a run: counts of the rules that found something, and at most ``most`` examples of each side."""
    compared = F.col("baseline") != "none"
    named = rules.select("check_id", "language", "baseline")
    counted = diff.groupBy(batch.alias("batch_index"), "check_id").agg(*[F.sum(n).alias(n) for n in COUNTS]).join(named, "check_id")
    counts = {n: F.when(compared, F.col(n)).otherwise(F.lit(0)).cast("long") for n in COUNTS}
    shown = mismatches(diff.join(named.where(compared).select("check_id"), "check_id", "left_semi"))
    first = _first_examples(shown.withColumn("batch_index", batch), ["batch_index", "check_id"], most)
    out = counted.withColumn("status", F.when(compared, "compared").otherwise("runtime_only")).withColumns(counts).join(first, ["batch_index", "check_id"], "left")
    return out.select("batch_index", "check_id", "language", "baseline", "status", *COUNTS, "missing_examples", "extra_examples")


def _first_examples(shown: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first ``most`` mismatches of each side in order of batch and key; the window is cut before it is sorted out, so lists stay short."""
    order = Window.partitionBy(*by, "side").orderBy("batch_index", *KEY, "copy")
    kept = shown.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    one = F.struct("batch_index", "product_id", "observed_code", "severity", "copy")
    listed = lambda side: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, F.struct("rank", one.alias("e"))))), lambda x: x["e"])
    return kept.groupBy(*by).agg(listed("reference").alias("missing_examples"), listed("migrated").alias("extra_examples"))


def merged_states(states: DataFrame, rules: DataFrame, most: int = 20) -> DataFrame:
    """The run that batch states add up to, a row a rule; batches that differ in a rule's status fail the job."""
    same = F.min("status") == F.max("status")
    wrong = F.raise_error(F.concat(F.lit("batches differ in the status of "), F.first("check_id"))).cast("string")
    sums = states.groupBy("check_id").agg(F.when(same, F.min("status")).otherwise(wrong).alias("status"), *[F.sum(n).alias(n) for n in COUNTS])
    sides = F.array(F.struct(F.lit("reference").alias("side"), F.col("missing_examples").alias("e")), F.struct(F.lit("migrated").alias("side"), F.col("extra_examples").alias("e")))
    shown = states.select("check_id", F.inline(sides)).select("check_id", "side", F.inline("e"))
    passed = F.when(F.col("status") == "compared", (F.col("missing") == 0) & (F.col("extra") == 0))
    none = F.array().cast(f"array<{_EXAMPLE}>")
    out = rules.select("check_id", "language", "baseline").join(sums, "check_id", "left").join(_first_examples(shown, ["check_id"], most), "check_id", "left")
    out = out.withColumns({n: F.coalesce(n, F.lit(0)).cast("long") for n in COUNTS} | {c: F.coalesce(c, none) for c in ("missing_examples", "extra_examples")})
    return out.withColumn("status", F.coalesce("status", F.when(F.col("baseline") == "none", "runtime_only").otherwise("compared"))).withColumn("passed", passed)


# ---------------------------------------------------------------- stored results


class ResultStore:
    """Results by code in hash buckets.  An upsert writes the buckets it touches to new files and then a new version.

    A version is a list of (bucket, path); readers take the latest whole one, so they see all of an upsert or
    nothing.  Two writers of the same version: the later one fails and has to try again.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, buckets: int = 64):
        self.spark, self.folder, self.schema, self.buckets = spark, folder.rstrip("/"), schema, buckets

    def version(self) -> int:
        """The latest version that was written whole; 0 is the empty store."""
        fs, p = _files(self.spark, f"{self.folder}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        whole = [int(n) for n in names if n.isdigit() and exists(self.spark, f"{self.folder}/versions/{n}/_SUCCESS")]
        return max(whole, default=0)

    def paths(self, version: int | None = None) -> dict[int, str]:
        """Bucket to folder, at most ``buckets`` entries."""
        version = self.version() if version is None else version
        if not version:
            return {}
        return {r["bucket"]: r["path"] for r in self.spark.read.schema("bucket int, path string").json(f"{self.folder}/versions/{version}").collect()}

    def read(self, version: int | None = None, only: set[int] | None = None) -> DataFrame:
        paths = [p for b, p in self.paths(version).items() if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("code"), F.lit(self.buckets)).cast("int")

    def upsert(self, new: DataFrame) -> int:
        """New results in place of those of the same codes; a code that repeats among them fails the job.  Gives the version."""
        at = self.version()
        data = f"{self.folder}/data/{uuid.uuid4().hex}"
        names = self.spark.createDataFrame([], self.schema).columns
        rest = [n for n in names if n != "code"]
        one = new.groupBy("code").agg(F.first(F.struct(*rest)).alias("r"), F.count(F.lit(1)).alias("n"))
        repeated = F.raise_error(F.concat(F.lit("results repeat code "), F.col("code"))).cast("string")
        new = one.select(F.when(F.col("n") == 1, F.col("code")).otherwise(repeated).alias("code"), "r.*")
        touched = {r["b"] for r in new.select(self.bucket().alias("b")).distinct().collect()}  # at most ``buckets``
        if not touched:
            return at
        old = self.read(at, touched).join(new.select("code"), "code", "left_anti")
        whole = old.select(*names).unionByName(new.select(*names)).withColumn("bucket", self.bucket())
        whole.repartition(min(self.buckets, len(touched)), "bucket").write.partitionBy("bucket").parquet(data)
        paths = self.paths(at) | {b: f"{data}/bucket={b}" for b in touched}
        version = self.spark.createDataFrame(sorted(paths.items()), "bucket int, path string")
        version.coalesce(1).write.mode("error").json(f"{self.folder}/versions/{at + 1}")
        return at + 1
