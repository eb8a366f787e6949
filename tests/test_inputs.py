"""Shapes of rows, raw documents, sheets: cases that the queries' data don't hold."""

import json
import random

import pytest
from pyspark.sql import functions as F

from larder import api
from larder.operators import context as cx
from larder.sources import dispatch as ds
from larder.sources import ingest as ig
from larder.sources import snapshot as sn


def variants(spark, rows):
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, t string").select("i", F.parse_json("t").alias("document"))


def test_seventeen_digits(spark):
    r = random.Random(1)
    xs = [0.1, 0.3, 1 / 3, 1e-4, 1e16, 123456789.125, 0.5, 2.5, 99999999999999990.0, 9007199254740993.0, 0.00012345, 1e15 + 0.3, -0.1, -7.0, 0.0, 100.0, 999999999999999.9, 9.999999999999999e-4]
    xs += [r.uniform(0.1, 1) * 10 ** r.randrange(-3, 17) for _ in range(500)] + [round(r.uniform(0, 1000), 2) for _ in range(500)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", sn.digits17(F.col("x")).alias("t")).collect()
    assert [(g.x, g.t) for g in got if g.t != "%.17g" % g.x] == []
    far = [1e-5, 1.25e20, 1e300, 5e-324, float("inf"), float("nan"), None]
    shown = [g.t for g in spark.createDataFrame([(x,) for x in far], "x double").select(sn.digits17(F.col("x")).alias("t")).collect()]
    assert shown[:3] == ["1e-05", "1.25e+20", "1e+300"] and float(shown[3]) == 5e-324 and shown[4:] == ["Inf", "NaN", None]


def repaired(nodes):
    if not isinstance(nodes, list):
        return []
    return [{"id": n.get("id"), "vegan": n.get("vegan"), "vegetarian": n.get("vegetarian"), "ingredients": repaired(n.get("ingredients"))} for n in nodes if isinstance(n, dict)]


def test_nested_ingredients_of_any_shape(spark):
    r = random.Random(4)

    def some(depth):
        if r.random() < 0.25:
            return r.choice([None, "x", 5, {"id": "no list"}, []])
        return [r.choice([7, None, "y", [1]]) if r.random() < 0.2 else {"id": f'i"{r.randrange(99)}[', "vegan": r.choice(["yes", None])} | ({"ingredients": some(depth - 1)} if depth else {}) for _ in range(r.randrange(4))]

    docs = [{"code": str(i), "ingredients": some(4)} for i in range(60)]
    deep = {"id": "leaf"}
    for level in range(10):
        deep = {"id": str(level), "ingredients": [deep]}
    docs.append({"code": "deep", "ingredients": [deep]})
    rows = variants(spark, docs).withColumn("helper", F.parse_json(F.lit("{}")))
    got = {x.code: json.loads(x.t) for x in sn.snapshot(rows).select("code", F.to_json("product.ingredients").alias("t")).collect()}
    assert got == {d["code"]: repaired(d["ingredients"]) for d in docs}
    whole = variants(spark, [[deep]]).select(F.lit("c").alias("code"), F.col("document").alias("ingredients"))
    nodes = cx.ingredient_nodes(whole)
    assert sorted(x.depth for x in nodes.collect()) == list(range(1, 12))


def test_snapshot_of_any_shape(spark):
    """A document's own shape, another one at every place, texts around numbers; each column of rows is read in one walk."""
    docs = [
        {"code": 7, "packagings": [{"number": " 0.3\t", "shape": {"a": 1}}, None, [1], "x", {"number": True}], "labels_tags": ["a", 1.5, None, {"b": 1}, [2]],
         "nutrition": {"input_sets": [None, {"source": 1, "nutrients": {"fat": {"value": -0.7, "unit": ["g"]}, "no": None, "bad": [1]}}, {"nutrients": None}]}},
        {"code": "x", "packagings": {"a": 1}, "labels_tags": "a", "nutrition": [1], "nutriscore_score": -3, "created_t": "1e2", "product_name": False},
        [1, 2], None, "text",
    ]
    rows = variants(spark, docs).withColumn("helper", F.parse_json(F.lit('{"is_european_product":"true","minimum_number_of_ingredients":"+.5"}')))
    found = sn.snapshot(rows)
    first, second, *rest = (r.asDict(True) for r in found.drop("product").withColumn("t", F.to_json(F.col("nutrition"))).drop("nutrition").collect())
    assert (first["code"], second["code"], [r["code"] for r in rest]) == ("7", "x", [None] * 3)
    assert json.loads(first["t"]) == {
        "input_sets": [{"source": "1", "nutrients": {"fat": {"value": "-0.69999999999999996"}}}, {"nutrients": {}}], "aggregated_set": {"nutrients": {}},
    }
    assert all(json.loads(r["t"]) == {"input_sets": [], "aggregated_set": {"nutrients": {}}} for r in (second, *rest))
    assert first["flags"]["is_european_product"] is True and first["category_props"]["minimum_number_of_ingredients"] == "0.5"
    kept = found.select("product.packagings", "product.labels_tags", "product.nutriscore_score", "product.created_t", "product.product_name", F.to_json("product.ingredients").alias("i")).collect()
    assert [tuple(p) for p in kept[0].packagings] == [("0.29999999999999999", None, None), (None, None, None)] and kept[0].labels_tags == ["a", "1.5", None, None, None]
    assert (kept[1].nutriscore_score, kept[1].created_t, kept[1].product_name) == ("-3", "100", "false")
    assert all((r.packagings, r.labels_tags, r.i) == ([], [], "[]") for r in kept[1:])
    assert '$["' not in found._jdf.queryExecution().optimizedPlan().toString()  # no lookup a name


def test_ingredient_nodes_is_one_scan(spark, tmp_path):
    spark.range(5).selectExpr("cast(id as string) as code", """'[{"id":"a","ingredients":[{"id":"b"}]}]' as t""").write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p")).select("code", F.parse_json("t").alias("ingredients"))
    plan = cx.ingredient_nodes(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert cx.ingredient_nodes(rows).count() == 10


def test_prepare_keeps_nutriments_of_typed_frames(spark):
    one = spark.sql("select '1' as _id, '1' as code, ' x ' as product_name, named_struct('fat_100g', 2.5D, 'salt_100g', cast(null as double)) as nutriments, 7D as `salt_100g`")
    got = api.prepare(one).first()
    assert (got["fat_100g"], got["salt_100g"], got["product_name"]) == (2.5, None, "x")
    assert api.prepare(one.drop("_id")).first()["fat_100g"] == 2.5
    mapped = spark.sql("select '1' as code, map('fat_100g', '1_0') as nutriments")
    assert api.prepare(mapped).first()["fat_100g"] == 10.0
    broken = spark.sql("select '1' as code, array(named_struct('name', 'fat', '100g', 1D)) as nutriments")
    with pytest.raises(Exception, match="nutriments needs"):
        api.prepare(broken).collect()
    reasons = api.prepare(broken, rejects=True).collect()
    assert len(reasons) == 1 and reasons[0]["_reject_reason"].startswith("a nested row: nutriments needs created_t")
    for wrong in ("path/to/rows", {"code": "1"}, [{"code": "1"}]):
        with pytest.raises(TypeError):
            api.prepare(wrong)


def test_one_row_fails_or_is_kept_apart(spark):
    rows = variants(spark, [{"code": "1", "quantity": "5 g"}, {"code": "2", "quantity": 5}, {"_id": "3", "code": "3", "labels_tags": []}])
    found = ds.dispatched(rows, "document")
    assert {r.code for r in ds.accepted(found).collect()} == {"1", "3"}
    assert [(r.i, r[ds.REASON]) for r in ds.rejected(found).collect()] == [(1, "quantity is no text")]
    with pytest.raises(Exception, match="quantity is no text"):
        ds.accepted(ds.failfast(found)).collect()
    assert ds.accepted(ds.dispatched(rows.limit(0), "document")).collect() == []


def test_strict_lines(spark, tmp_path):
    for n, bad in enumerate(["[1, 2]", '"x"', "5"]):
        path = tmp_path / f"{n}.jsonl"
        path.write_text('{"a": 1}\n\n' + bad + "\n")
        with pytest.raises(Exception, match="no JSON object"):
            ig.read_documents(spark, str(path)).collect()
        assert [r.document is None for r in ig.read_documents(spark, str(path), strict=False).collect()] == [False, True]


def test_sheets_as_they_are(spark, tmp_path):
    def cells(text, **more):
        (tmp_path / "s.csv").write_text(text, newline="")
        rows = ig.read_sheet(spark, str(tmp_path / "s.csv"), **more)
        return rows.columns, [tuple(r) for r in rows.collect()]

    assert cells('a,b,b,\n"x;y;z;","1\n2","say ""hi""",5" pipe\n,,,\n1\n1,2,3,4,5\n') == (["a", "b", "b", ""], [("x;y;z;", "1\n2", 'say "hi"', '5" pipe'), ("1", "", "", ""), ("1", "2", "3", "4")])
    assert cells('﻿"a;b;c;d"\tb\n1\t2\n') == (["a;b;c;d", "b"], [("1", "2")])
    assert cells(" ; \n;\ncode;name\n1;x\n ; \n2;y\n") == (["code", "name"], [("1", "x"), ("2", "y")])
    for empty in ("", " \n", ";;\n ; \n"):
        with pytest.raises(ValueError):
            cells(empty)
    assert ig.separator_of('"a,b,c,d,e";x;y') == ";" and ig.separator_of("plain") == ","


def test_sample_order_of_equal_codes(spark):
    from larder.sources import select as se

    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "code string, line int")
    first = sorted(["a", "b"], key=lambda c: __import__("hashlib").sha256(f"{c}::42".encode()).hexdigest())
    want = [("a", 2), ("a", 3)] if first == ["a", "b"] else [("b", 4), ("a", 3)]
    assert [tuple(r) for r in se.stable_sample(rows, 2, 42, "line").collect()] == want


def test_codes_have_to_agree(spark):
    """An enriched row whose two codes differ fails the job (the guard is part of the plan)."""
    from larder.plans.product_queries import enriched_rows

    rows = enriched_rows(spark, "/root/testdata/sf0.001").limit(3)
    assert cx.project_enriched(rows).count() == 3
    apart = rows.withColumn("product", F.col("product").withField("code", F.lit("another")))
    with pytest.raises(Exception, match="codes differ"):
        cx.project_enriched(apart).collect()


def test_guards_of_assessments(spark):
    from larder.operators import inventory as iv

    rows = spark.createDataFrame([(1, "", "f1"), (2, "kept", "f2")], "id int, note string, print string")
    new = lambda *r: spark.createDataFrame(list(r), "id int, note string, print string")
    assert sorted(map(tuple, iv.fill_blanks(rows, new((1, "n", "f1")), "id", ["note"], fingerprint="print").collect())) == [(1, "n", "f1", True), (2, "kept", "f2", False)]
    for bad, text in ((new((3, "n", "f")), "unknown id 3"), (new((1, "n", "f1"), (1, "m", "f1")), "repeat the id 1"), (new((1, "n", "other")), "another fingerprint at 1")):
        with pytest.raises(Exception, match=text):
            iv.fill_blanks(rows, bad, "id", ["note"], fingerprint="print").collect()


def test_rules_on_snapshots(spark, tmp_path):
    """Rules find the same on snapshots of raw documents as on the enriched rows that these were made of."""
    from larder.operators import findings as fi
    from larder.operators.rules import packaged
    from larder.plans.input_queries import as_documents
    from larder.plans.product_queries import enriched_rows

    enriched_rows(spark, "/root/testdata/sf0.001").where("k % 40 = 1 and code <> ''").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    sn.typed(sn.snapshot(as_documents(rows))).write.parquet(str(tmp_path / "snapshots"))
    found = lambda df: sorted(map(str, fi.evaluate(cx.project_enriched(df), packaged()).collect()))
    want = found(rows)
    assert found(spark.read.parquet(str(tmp_path / "snapshots"))) == want and len(want) > 100
