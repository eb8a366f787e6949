"""Selections and samples of product rows."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.scalars import strip


def sample_key(code: Column, seed: int) -> Column:
    return F.sha2(F.concat(code, F.lit(f"::{seed}")), 256)


def stable_sample(rows: DataFrame, n: int, seed: int, position: str | None = None) -> DataFrame:
    """The n rows with the least SHA-256 of ``code::seed``: of equal codes later lines are taken first; the result is in order of hash, code and line."""
    if n <= 0:
        raise ValueError("a sample needs a positive size")
    keyed = rows.withColumn("_key", sample_key(F.col("code"), seed))
    if position is None:
        return keyed.orderBy("_key", "code").limit(n).drop("_key")
    taken = keyed.orderBy("_key", "code", F.col(position).desc()).limit(n)
    return taken.orderBy("_key", "code", position).drop("_key")


def sample_count(rows: DataFrame, n: int) -> DataFrame:
    return rows.agg(F.least(F.count(F.lit(1)), F.lit(n)).cast("long").alias("n"))


def clean_codes(codes: DataFrame, position: str, code: str = "code") -> DataFrame:
    """Codes stripped, without comments and blanks, first seen once."""
    plain = codes.select(strip(F.col(code)).alias("code"), F.col(position)).where((F.col("code") != "") & ~F.col("code").startswith("#"))
    return plain.groupBy("code").agg(F.min(position).alias(position))


def by_codes(rows: DataFrame, codes: DataFrame, trim: bool = False) -> DataFrame:
    key = strip(F.col("code")) if trim else F.col("code")
    return rows.withColumn("_code", key).join(codes.select(F.col("code").alias("_code")), "_code", "left_semi").drop("_code")


def first_shared(rows: DataFrame, other: DataFrame, position: str, n: int) -> DataFrame:
    """First occurrences, in order of position, of the first n codes that the other table has too."""
    first = rows.groupBy("code").agg(F.min(position).alias(position))
    return first.join(other.select("code"), "code", "left_semi").orderBy(position).limit(n)


def cohort(rows: DataFrame, chosen: DataFrame, order: list, position: str) -> DataFrame:
    """One row for each chosen code, in the cohort's order; of repeated codes the first by ``order``."""
    first = Window.partitionBy("code").orderBy(*order)
    joined = rows.join(chosen, "code")
    return joined.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn").orderBy(position)


def checked_codes(codes: DataFrame, position: str, code: str = "code") -> DataFrame:
    """:func:`clean_codes`; a list without codes is an error."""
    found = clean_codes(codes, position, code)
    if found.isEmpty():
        raise ValueError("the code list has no codes")
    return found


def enough_shared(rows: DataFrame, other: DataFrame, position: str, n: int) -> DataFrame:
    """:func:`first_shared`; fewer than n shared codes are an error."""
    found = first_shared(rows, other, position, n)
    have = found.count()
    if have < n:
        raise ValueError(f"only {have} of {n} codes are shared")
    return found


def fingerprint(rows: DataFrame) -> DataFrame:
    """Digest of all rows, whatever their order: count, and sum of 48 bits of each row's MD5.

    A row is its columns in order of name as text, null as \\0, each followed by \\1.
    """
    cells = [F.concat(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")), F.lit("\1")) for c in sorted(rows.columns)]
    row = F.conv(F.substring(F.md5(F.concat(*cells)), 1, 12), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("digest"))


def selection_fingerprint(selection: dict) -> str:
    text = json.dumps(selection, sort_keys=True, separators=(",", ":"))
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()[:16]


def checked_selection(kind: str, n: int | None = None, seed: int | None = None, codes: list[str] | None = None) -> dict:
    """A selection's payload; wrong combinations are errors, seed 0 stands for 42."""
    if kind == "all":
        return {"kind": "all"}
    if kind == "sample":
        if not n or n < 1 or seed is None:
            raise ValueError("a sample needs a positive size and a seed")
        return {"kind": "sample", "n": n, "seed": seed or 42}
    if kind == "codes":
        if not codes or any(not c.strip() for c in codes):
            raise ValueError("a code list needs codes")
        return {"kind": "codes", "codes": list(dict.fromkeys(c.strip() for c in codes))}
    raise ValueError(f"unknown selection {kind}")
