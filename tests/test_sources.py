import json

import pytest
from pyspark.sql import functions as F

from larder import api
from larder.operators import findings as fi
from larder.operators import sheets as sh
from larder.plans.runs import RunStore, artifact_text, benchmark_summary, latest_state, with_timings
from larder.sources import ingest as ig
from larder.sources import select as se
from larder.streaming.incremental import write_findings


def test_three_shapes_give_equal_rows(spark, tmp_path):
    doc = {"_id": "7", "code": " 7 ", "product_name": "Tea", "quantity": "5 g", "labels_tags": ["en:vegan", "en:no-fat"], "nutriments": {"fat_100g": 0.7, "other_100g": 3}}
    (tmp_path / "d.jsonl").write_text(json.dumps(doc) + "\n\n" + json.dumps({"code": "", "x": 1}) + "\n" + json.dumps({"code": 5}) + "\n")
    docs = ig.valid_documents(ig.read_documents(spark, str(tmp_path / "d.jsonl")))
    one = ig.from_documents(docs).collect()
    (tmp_path / "t.tsv").write_text("code\tproduct_name\tquantity\tlabels_tags\tfat_100g\n7\tTea\t5 g\ten:vegan,en:no-fat\t0.7\n")
    two = ig.canonical(ig.read_tsv(spark, str(tmp_path / "t.tsv")))
    assert len(one) == 1 and one[0].code == "7" and one[0]["fat_100g"] == 0.7
    assert (two.first().product_name, two.first()["fat_100g"]) == ("Tea", "0.7")
    ids = lambda df: {(r.product_id, r.check_id) for r in api.run_checks(df).collect()}
    assert ids(ig.from_documents(docs)) == ids(two)


def test_localized_text_and_last_nutriment(spark):
    rows = spark.sql("select array(named_struct('lang','fr','text',' '), named_struct('lang','de','text','Tee'), named_struct('lang','main','text','Tea')) t, array(named_struct('name',' fat ','100g',1.0D), named_struct('name','x','100g',2.0D), named_struct('name','fat','100g',3.0D)) n")
    got = rows.select(ig.localized_text(F.col("t")).alias("t"), ig.nutriment_map(F.col("n")).alias("n")).first()
    assert got.t == "Tea" and got.n == {"fat": 3.0}


def test_bad_inputs_are_errors(spark):
    rows = spark.createDataFrame([("1", "x")], "code string, name string")
    for columns in ({"nope": "name"}, {"product_name": "absent"}, {"product_name": "name", "quantity": "name"}, {"code": "name"}):
        with pytest.raises(ValueError):
            ig.remap(rows, columns)
    with pytest.raises(ValueError):
        ig.canonical(rows.drop("code"))
    with pytest.raises(ValueError):
        ig.canonical(rows.withColumn("quantity", F.lit(3)))
    with pytest.raises(ValueError):
        se.checked_selection("sample", n=0, seed=1)
    assert se.checked_selection("sample", n=5, seed=0)["seed"] == 42
    assert se.selection_fingerprint({"kind": "all"}).startswith("sha256:") and len(se.selection_fingerprint({})) == 23


def test_sheet_reader(spark, tmp_path):
    (tmp_path / "s.csv").write_text("code;product_name\n1;a\n ; \n2\n3;b;c\n")
    got = [tuple(r) for r in ig.read_sheet(spark, str(tmp_path / "s.csv")).collect()]
    assert got == [("1", "a"), ("2", ""), ("3", "b")]


def test_sheet_annotation(spark):
    sheet = spark.createDataFrame([(2, "0001", ""), (3, "0002", "Valid product"), (4, " ", "")], "row int, code string, product_name string")
    found = spark.createDataFrame([(2, "en:b", "warning"), (2, "en:a", "completeness")], "row int, check_id string, severity string")
    rows = {r.row: r for r in sh.annotate(sheet, found, "row", "now").collect()}
    assert (rows[2].dq_status, rows[2].dq_severity, rows[2].dq_findings) == ("issue", "warning", "en:a\nen:b")
    assert rows[3].dq_status == "ok" and (rows[4].dq_status, rows[4].dq_findings, rows[4].dq_last_checked_at) == ("", "", "now")
    with pytest.raises(ValueError):
        sh.candidates(sheet)


def test_sheet_errors(spark):
    cells = [(2, "1", "[1, 2]"), (3, "2", "{broken}"), (4, "3", "fine"), (5, "", " "), (6, "4", "[open")]
    sheet = spark.createDataFrame(cells, "row int, code string, product_name string")
    found = spark.createDataFrame([(2, "en:a", "bug"), (4, "en:a", "info")], "row int, check_id string, severity string")
    out = sh.annotate(sheet, found, "row", "now", ig.shape_problem(sheet))
    rows = {r.row: r for r in out.collect()}
    assert [rows[i].dq_status for i in range(2, 7)] == ["error", "error", "issue", "", "ok"]
    assert rows[2].dq_findings.startswith("Validation error: structured product_name") and rows[2].dq_findings_count == "0"
    assert "unsupported raw structured string" in rows[3].dq_findings and rows[3].dq_severity == "error"
    assert tuple(sh.outcome(out).first()) == (4, 1, 2)
    assert {r.row: r.colour for r in sh.colours(out, "row").collect()} == {2: "#F4CCCC", 3: "#F4CCCC", 4: "#D9EAF7", 5: None, 6: "#D9EAD3"}
    with_list = sheet.withColumn("nutriments", F.lit(""))
    assert all(r.p for r in with_list.select(ig.shape_problem(with_list).alias("p")).collect())
    assert sh.header_assessment(["code", "dq_status", "x"], ["code", "quantity"]) == {"recognized": 1, "ignored": 1}
    with pytest.raises(ValueError):
        sh.header_assessment(["x"], ["code"])
    got = sh.preview_counts(sheet, "row").first()
    assert (got.candidate_count, got.candidate_codes) == (4, ["1", "2", "3", "4"])
    (cells_,) = [r.cells for r in sh.preview(spark.createDataFrame([(1, "7", " ", "")], "row int, code string, a string, b string"), "row").collect()]
    assert [(c.name, c.value) for c in cells_] == [("code", "7"), ("a", " ")]


def test_colour_ranges_join_over_blocks(spark):
    import random

    r = random.Random(3)
    colours, at = [], 0
    while at < 300:
        n = r.choice([1, 2, 3, 40])
        colours += [r.choice(["a", "b", None])] * n
        at += n
    rows = spark.createDataFrame(list(enumerate(colours)), "row int, colour string")
    want, start = [], 0
    for i in range(1, len(colours) + 1):
        if i == len(colours) or colours[i] != colours[start]:
            if colours[start]:
                want.append((colours[start], start, i - 1))
            start = i
    for block in (1, 7, 1000):
        assert sorted(map(tuple, sh.colour_ranges(rows, "row", block).collect())) == sorted(want)


def test_literals_of_python(spark):
    import ast
    import json

    texts = [
        "{'a': 'True story', \"b\": \"it's None\"}", "[1_000, 2.5, -3]", "[('x', 'y'), (1,), ()]", "['quote \"inside\"', 'back\\\\slash', 'new\\nline', 'it\\'s', '\\x41']",
        "{'n': None, 't': [True, False,],}", "[]", "{}", "{'k': {'deep': ['None', \"True\"]}}", '["json \\" quote"]',
    ]
    broken = ["[1, 2}", "{broken}", "[1 2]", "{'a': }", "['open]"]
    rows = spark.createDataFrame([(t,) for t in [*texts, *broken, "plain", "[open", None]], "t string")
    got = {r.t: (r.v, r.u) for r in rows.select("t", F.to_json(ig.structured_cell(F.col("t"))).alias("v"), ig.undecodable(F.col("t")).alias("u")).collect()}
    for t in texts:
        assert json.loads(got[t][0]) == json.loads(json.dumps(ast.literal_eval(t))) and got[t][1] is False, t
    assert all(got[t] == (None, True) for t in broken)
    assert got["plain"] == got["[open"] == got[None] == (None, False)


def test_guards(spark, tmp_path):
    from larder.operators import parity as pa

    asked = spark.createDataFrame([("a", 1), ("b", 2)], "code string, k int")
    done = spark.createDataFrame([("b", 5), ("a", 4)], "code string, result int")
    assert [tuple(r) for r in pa.in_request_order(asked, done, "k").collect()] == [("a", 1, 4), ("b", 2, 5)]
    with pytest.raises(Exception, match="no result for b"):
        pa.in_request_order(asked, done.where("code = 'a'"), "k").collect()
    pa.checked_identity({"x": 1}, {"x": 1})
    with pytest.raises(ValueError, match="y"):
        pa.checked_identity({"x": 1, "y": 2}, {"x": 1, "y": 3})
    lines = spark.createDataFrame([('{"contract_kind": "k", "contract_version": 2, "reference_result": {"code": "1"}}',)], "line string")
    assert ig.decode_envelopes(lines, "line", "k", 2, "struct<code:string>").collect()[0].code == "1"
    for kind, version in (("k", 1), ("z", 2)):
        with pytest.raises(Exception, match="expected"):
            ig.decode_envelopes(lines, "line", kind, version, "struct<code:string>").collect()
    with pytest.raises(ValueError):
        se.checked_codes(spark.createDataFrame([(" ", 1), ("# x", 2)], "code string, pos int"), "pos")
    with pytest.raises(ValueError):
        se.enough_shared(asked, done, "k", 3)
    rows = spark.createDataFrame([(2, "b", [1]), (1, "a", [2, 3])], "n int, code string, tags array<int>")
    ig.write_cohort(rows, "n", str(tmp_path / "out"))
    assert [r.code for r in spark.read.json(str(tmp_path / "out/jsonl")).collect()] == ["a", "b"]
    assert [tuple(r) for r in ig.read_tsv(spark, str(tmp_path / "out/tsv")).collect()] == [("a", "[2,3]"), ("b", "[1]")]
    assert spark.read.parquet(str(tmp_path / "out/parquet")).columns == ["code", "tags"]


def test_run_store(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    store.start("a", "snap", 5, "2024-01-01T00:00:00Z")
    store.start("b", "snap", 5, "2024-01-01T00:00:00Z")
    store.finish("a", "snap", 5, "{}", at="2024-01-01T00:00:01Z")
    store.finish("b", "snap", 5, failure=ValueError("broken"), at="2024-01-01T00:00:01Z")
    assert {r.run_id: r.status for r in latest_state(store.read("runs")).collect()} == {"a": "completed", "b": "failed"}
    assert store.load("a").first().run_artifact_json == "{}"
    with pytest.raises(ValueError):
        store.load("b")
    with pytest.raises(LookupError):
        store.load("c")


def test_run_profiles_artifacts_and_timings(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    store.start("a", "snap", 5, "2024-01-01T00:00:00Z")
    text = artifact_text("run", 1, {"processed": 4}, {"rules": 2})
    store.finish("a", "snap", 5, text, at="2024-01-01T00:00:01Z", seconds={"prepare_run_seconds": 1.5})
    store.finish("b", "snap", 5, text, at="2024-01-01T00:00:01Z")
    with pytest.raises(ValueError):
        store.finish("a", "snap", 5, text, seconds={"lunch_seconds": 1.0})
    store.profile("a", "small", "four products", "codes", {"codes": ["1", "2"]})
    row = store.load_with_profile("a").first()
    assert (row.profile_name, row.selection_json, row.prepare_run_seconds) == ("small", '{"codes": ["1", "2"]}', 1.5) and len(row.selection_fingerprint) == 64
    assert store.load_with_profile("b").first().profile_name is None
    assert store.artifact("a", "run", 1) == {"source_input": {"processed": 4}, "rules": 2}
    for kind, version in (("walk", 1), ("run", 2)):
        with pytest.raises(ValueError):
            store.artifact("a", kind, version)
    rows = spark.createDataFrame([("a", 0, 3), ("a", 1, 2)], "run_id string, batch_index int, row_count long")
    timings = spark.createDataFrame([("a", 0, 0.5, 7)], "run_id string, batch_index int, elapsed_seconds double, cache_hit_count long")
    got = {r.run_id: r for r in benchmark_summary(store.read("runs"), with_timings(rows, timings)).collect()}
    assert (got["a"].batches, got["a"].elapsed_seconds, got["a"].cache_hit_count, got["a"].record_batch_seconds, got["a"].status) == (2, 0.5, 7, 0.0, "completed")
    assert (got["b"].batches, got["b"].elapsed_seconds) == (0, 0.0)


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), "" if i % 2 else "name", str(i * 300)) for i in range(40)], "code string, product_name string, product_quantity string")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    rules = fi.select_rules(paths=__import__("larder.operators.context", fromlist=["x"]).SOURCE_PATHS)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    write_findings(stream, rules, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    key = lambda df: sorted(map(str, df.collect()))
    from larder.operators.context import project_source

    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(fi.evaluate(project_source(rows), rules))


def test_nutriments_in_one_pass(spark):
    """Entries are looked through once and not once a known name; doubles take no detour by text."""
    rows = spark.createDataFrame([([(" fat ", 1.5), ("fat", None), ("salt", 2.0), ("fat", 3.5), ("?", 4.0)],)], "n array<struct<name:string,`100g`:double>>")
    found = rows.select(ig.nutriment_map(F.col("n"), kind="double").alias("n"))
    assert found.first()["n"] == {"fat": 3.5, "salt": 2.0}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper() and "[added-sugars," not in plan
