import math
import random
import re
import sys

from pyspark.sql import functions as F

from larder.functions import scalars as sc
from larder.types import NUTRIENT_COLUMNS, column_name, field_name


def python_number(t):
    if t is None or not t.strip():
        return None
    try:
        return float(t)
    except ValueError:
        return None


def test_as_number_follows_python(spark):
    r = random.Random(1)
    texts = [None, "", " ", "1", " 1.5 ", "1d", "1f", "1_000", "1__0", "_1", "1_", ".5", "5.", ".", "1e3", "1e", "+7", "--7", "inf", "-Infinity", "+inf", "nan", "abc", "1 2", " 3 ", "0x1", "1e400"]
    texts += ["".join(r.choice("0123456789._eE+- ") for _ in range(r.randrange(1, 7))) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in rows.select("i", "t", sc.as_number(F.col("t")).alias("x")).collect():
        want = python_number(row.t)
        assert row.x == want or (want is not None and math.isnan(want) and math.isnan(row.x)), (row.t, row.x, want)


def test_round2_follows_python(spark):
    r = random.Random(2)
    values = [0.0, 1.005, 0.125, 0.375, 2.675, 0.1 + 0.2, -1.005, -0.125, 99999.995] + [r.random() * 10 ** r.randrange(5) for _ in range(2000)] + [k / 8 for k in range(200)] + [k / 1000 for k in range(1000)]
    values += [s * r.random() * 10 ** r.randrange(5, 19) for _ in range(2000) for s in (1, -1)] + [2e11, 1e15, 1e300, -(2.0**52), 2.0**40 + 0.125, 2.0**45 + 0.375, 2.0**37 - 0.005, float("inf")]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for row in rows.select("x", sc.round2(F.col("x")).alias("y")).collect():
        assert row.y == round(row.x, 2), row


def test_set_id_and_tags(spark):
    rows = spark.createDataFrame([("Packaging", None, "100 G!!"), (None, "", "serving"), ("a--b", "_", "-")], "s string, p string, per string")
    got = [r.x for r in rows.select(sc.set_id(F.col("s"), F.col("p"), F.col("per")).alias("x")).collect()]
    want = []
    for s, p, per in [("Packaging", None, "100 G!!"), (None, "", "serving"), ("a--b", "_", "-")]:
        raw = f"nutrition-{s or 'unknown-source'}-{p or 'unknown-preparation'}-{per or 'unknown-per'}".lower()
        want.append(re.sub("[^a-z0-9]+", "-", raw).strip("-"))
    assert got == want
    tags = spark.createDataFrame([(" a , ,b,",), ("",), (None,)], "t string").select(sc.split_tags(F.col("t")).alias("t")).collect()
    assert [r.t for r in tags] == [["a", "b"], [], []]


def test_templates(spark):
    template = "en:${set_id}-x.${unit}"
    codes = ["en:a-x.b", "en:a-x-x.b", "en:-x.b", "en:a:c-x.b", "en:a b-x.c", "en:a-xzb", "en:a-x.b\n", ""]
    rows = spark.createDataFrame([(c,) for c in codes], "c string").select(sc.template_match(F.col("c"), template).alias("m")).collect()
    assert [r.m for r in rows] == [True, True, False, False, False, False, False, False]
    one = spark.range(1).select(sc.template_key(F.lit(template)).alias("k"), sc.placeholders(F.lit(template)).alias("p")).first()
    assert one.k == "en:${*}-x.${*}" and one.p == ["set_id", "unit"]


def test_column_names():
    assert all(column_name(field_name(c)) == c for c in NUTRIENT_COLUMNS if "-" in c or "_" not in c[:-5])
    assert field_name("saturated-fat_100g") == "saturated_fat_100g" and field_name("product_name") == "product_name"


def test_strip_takes_all_white_space(spark):
    white = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert sorted(sc.WHITE_SPACE) == white
    texts = [f"{w}a{w}b{w}{w}" for w in white] + ["", "\u200bx\u200b", "".join(white)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", sc.strip(F.col("t")).alias("x")).collect()
    assert [r.x for r in rows] == [r.t.strip() for r in rows]


def test_round2_near_halves(spark):
    rng = random.Random(5)
    values = [rng.randrange(10**9) / 1000 for _ in range(3000)]
    values += [math.nextafter(v, d) for v in values[:500] for d in (0.0, math.inf)]
    values += [k / 8 + 2.0**p for p in range(0, 52, 3) for k in range(16)]
    values += [-v for v in values[:200]]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", sc.round2(F.col("v")).alias("x")).collect()
    assert [r.x for r in rows] == [round(r.v, 2) for r in rows]
