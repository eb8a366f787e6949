"""Rows of a sheet with their findings beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.scalars import severity_rank, strip

ANNOTATIONS = ["dq_status", "dq_severity", "dq_findings_count", "dq_findings", "dq_last_checked_at"]
# Row colours.
COLOURS = {"info": "#D9EAF7", "completeness": "#FFF2CC", "warning": "#FCE5CD", "error": "#F4CCCC", "bug": "#EA9999", "ok": "#D9EAD3"}


def blank_row(columns: list[str]) -> Column:
    return F.forall(F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]), lambda x: strip(x) == "")


def without_annotations(sheet: DataFrame) -> DataFrame:
    return sheet.drop(*ANNOTATIONS)


def annotate(sheet: DataFrame, findings: DataFrame, row: str, checked_at: str, problem: Column | None = None) -> DataFrame:
    """Annotations before the sheet's columns; ``findings`` has the row number and the rule's id and severity.

    ``problem`` is the reason why a row can't be checked, over the sheet's columns; such rows are errors.
    """
    plain = without_annotations(sheet)
    names = [c for c in plain.columns if c != row]
    by_row = findings.groupBy(row).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by("severity", severity_rank(F.col("severity"))).alias("_severity"),
        F.array_join(F.sort_array(F.collect_list("check_id")), "\n").alias("_ids"),
    )
    reason = F.lit(None).cast("string") if problem is None else problem
    joined = plain.withColumns({"_blank": blank_row(names), "_problem": reason}).join(by_row, row, "left")

    def value(error: Column, full: Column, none: str) -> Column:
        return F.when(F.col("_blank"), "").when(F.col("_problem").isNotNull(), error).when(F.col("_n") > 0, full).otherwise(none)

    return joined.select(
        row,
        value(F.lit("error"), F.lit("issue"), "ok").alias("dq_status"),
        value(F.lit("error"), F.col("_severity"), "").alias("dq_severity"),
        value(F.lit("0"), F.col("_n").cast("string"), "0").alias("dq_findings_count"),
        value(F.concat(F.lit("Validation error: "), "_problem"), F.col("_ids"), "").alias("dq_findings"),
        F.lit(checked_at).alias("dq_last_checked_at"),
        *[F.col(f"`{c}`") for c in names],
    )


def colours(annotated: DataFrame, row: str) -> DataFrame:
    colour = F.create_map(*[F.lit(x) for kv in COLOURS.items() for x in kv])
    key = F.when(F.col("dq_status") == "ok", "ok").otherwise(F.nullif("dq_severity", F.lit("")))
    return annotated.select(row, F.try_element_at(colour, key).alias("colour"))


def colour_ranges(coloured: DataFrame, row: str, block: int = 1_000_000) -> DataFrame:
    """Runs of neighbouring rows with one colour.

    Islands are found inside blocks of rows, so no task holds the whole sheet.  Only those at a
    block's border, two a block at most, are joined with their neighbours.
    """
    cut = Window.partitionBy("_block", "colour").orderBy(row)
    rows = coloured.where("colour is not null").withColumn("_block", F.floor(F.col(row) / block))
    pieces = rows.withColumn("_island", F.col(row) - F.row_number().over(cut)).groupBy("_block", "colour", "_island").agg(
        F.min(row).alias("first_row"), F.max(row).alias("last_row")
    )
    pieces = pieces.withColumn("_edge", (F.pmod("first_row", F.lit(block)) == 0) | (F.pmod(F.col("last_row") + 1, F.lit(block)) == 0))
    order = Window.partitionBy("colour").orderBy("first_row")
    marked = pieces.where("_edge").withColumn("_new", F.coalesce((F.lag("last_row").over(order) + 1 != F.col("first_row")).cast("int"), F.lit(1)))
    grouped = marked.withColumn("_run", F.sum("_new").over(order))
    joined = grouped.groupBy("colour", "_run").agg(F.min("first_row").alias("first_row"), F.max("last_row").alias("last_row")).drop("_run")
    return pieces.where("not _edge").select("colour", "first_row", "last_row").unionByName(joined)


def candidates(annotated: DataFrame) -> DataFrame:
    if "dq_status" not in annotated.columns:
        raise ValueError("the sheet has no status column")
    return without_annotations(annotated.where("dq_status = 'ok'"))


def outcome(annotated: DataFrame) -> DataFrame:
    n = lambda *s: F.count_if(F.col("dq_status").isin(*s))
    return annotated.agg(n("ok", "issue", "error").alias("validated"), n("issue").alias("issues"), n("error").alias("errors"))


def preview(sheet: DataFrame, row: str, rows: int = 3, fields: int = 8) -> DataFrame:
    """The first non-blank rows, each as its first non-empty fields."""
    names = [c for c in sheet.columns if c != row]
    some = sheet.where(~blank_row(names)).orderBy(row).limit(rows)
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias("value")) for c in names])
    return some.select(row, F.slice(F.filter(cells, lambda x: x["value"] != ""), 1, fields).alias("cells"))


def preview_counts(sheet: DataFrame, row: str, code: str = "code", codes: int = 10) -> DataFrame:
    """Non-blank rows, and the first non-empty codes of them."""
    real = sheet.where(~blank_row([c for c in sheet.columns if c != row]))
    count = real.agg(F.count(F.lit(1)).alias("candidate_count"))
    if code not in sheet.columns:
        return count.withColumn("candidate_codes", F.array().cast("array<string>"))
    first = real.where(F.col(code) != "").orderBy(row).limit(codes)  # ten rows
    listed = first.agg(F.sort_array(F.collect_list(F.struct(F.col(row).alias("r"), F.col(code).alias("c")))).alias("x"))
    return count.join(listed.select(F.transform("x", lambda x: x["c"]).alias("candidate_codes")))


def header_assessment(headers: list[str], known: list[str]) -> dict[str, int]:
    """How many headers are known columns and how many are ignored; a sheet without ``code`` is an error."""
    if "code" not in headers:
        raise ValueError("the sheet has no code column")
    plain = [h for h in headers if h not in ANNOTATIONS]
    found = sum(h in set(known) for h in plain)
    return {"recognized": found, "ignored": len(plain) - found}


def rectangular(rows: DataFrame, cells: str, width: int) -> DataFrame:
    """Arrays of cells padded with empty text or cut to the header's width."""
    fixed = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.get(F.col(cells), i), F.lit("")))
    return rows.withColumn(cells, fixed)
