"""Stored runs, batches, results, profiles and Python rules."""

import os
import re

import pytest
from pyspark.sql import functions as F

from larder.operators import findings as fi
from larder.operators import parity as pa
from larder.operators.rules import ArrowRule, declarative, pack, packaged
from larder.plans import profiles, run_queries
from larder.plans import run_tables as rt
from larder.streaming.incremental import write_batches

RULES = "check_id string, language string, baseline string"
DIFF = "check_id string, product_id string, observed_code string, severity string, n_reference long, n_migrated long, matched long, missing long, extra long"


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def diff_of(spark, n=60):
    rows = [("a" if i % 2 else "b", f"{i:03}", "c", "info", i % 3, i % 2, min(i % 3, i % 2), max(i % 3 - i % 2, 0), max(i % 2 - i % 3, 0)) for i in range(n)]
    return spark.createDataFrame([*rows, ("none", "001", "x", "bug", 0, 2, 0, 0, 2)], DIFF)


def test_a_run_replaces_its_own_partition(spark, tmp_path):
    tables = rt.RunTables(spark, str(tmp_path))
    diff = diff_of(spark).withColumn("batch_index", F.lit(0))
    assert tables.read("run_differences", "r1").collect() == []
    for run in ("r1", "r2", "10"):
        tables.write("run_differences", run, diff)
    other = files(tmp_path / "run_differences/run_id=r2")
    tables.write("run_differences", "r1", diff.limit(3))  # an attempt that is repeated
    assert tables.read("run_differences", "r1").count() == 3 and files(tmp_path / "run_differences/run_id=r2") == other
    tables.write("run_differences", "r1", diff.limit(0))
    assert tables.read("run_differences", "r1").count() == 0
    assert {r.run_id for r in tables.read("run_differences").select("run_id").distinct().collect()} == {"r2", "10"}
    one = tables.read("run_differences", "10")
    assert one.count() == diff.count()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = tables.read("run_differences", "10")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[isnotnull\(run_id#\d+\), \(run_id#\d+ = 10\)\]", plan)  # no other partition is read
    with pytest.raises(ValueError):
        tables.write("run_differences", "r1", diff.drop("batch_index"))
    with pytest.raises(ValueError):
        tables.write("run_differences", "../r1", diff)


def test_batches_add_up(spark, tmp_path):
    rules = spark.createDataFrame([("a", "x", "legacy"), ("b", "x", "legacy"), ("none", "x", "none"), ("unused", "x", "legacy")], RULES)
    diff, batch = diff_of(spark), F.col("product_id").cast("int") % 4
    tables = rt.RunTables(spark, str(tmp_path))
    states = rt.batch_states(diff, rules, batch, 3)
    for number in (2, 0, 1, 3, 2, 2):
        tables.write("run_batch_states", "r", states.where(F.col("batch_index") == number), batch=number)
    got = {r.check_id: r for r in rt.merged_states(tables.read("run_batch_states", "r"), rules, 3).collect()}
    want = {r.check_id: r for r in pa.summarize(diff, rules).collect()}
    for name in ("n_reference", "n_migrated", "matched", "missing", "extra", "status", "passed"):
        assert {i: r[name] for i, r in got.items()} == {i: r[name] for i, r in want.items()}, name
    missing = sorted((int(r.product_id) % 4, r.product_id, c) for r in diff.where("check_id = 'a'").collect() for c in range(1, r.missing + 1))[:3]
    assert [(e.batch_index, e.product_id, e.copy) for e in got["a"].missing_examples] == missing
    assert got["none"].missing_examples == [] and got["unused"].extra_examples == []
    odd = states.withColumn("status", F.when((F.col("batch_index") == 1) & (F.col("check_id") == "a"), "runtime_only").otherwise(F.col("status")))
    with pytest.raises(Exception, match="batches differ in the status of a"):
        rt.merged_states(odd, rules, 3).collect()


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    store = rt.ResultStore(spark, str(tmp_path), "code string, result long", 8)
    rows = lambda pairs: spark.createDataFrame(pairs, "code string, result long")
    assert store.version() == 0 and store.read().collect() == []
    assert store.upsert(rows([(str(i), i) for i in range(100)])) == 1
    before = files(tmp_path / "data")
    hit = store.read().where(store.bucket() == 3).first().code
    old = store.read(1)
    assert store.upsert(rows([(hit, -1), ("new" + hit, 5)])) == 2
    after = files(tmp_path / "data")
    assert before.items() <= after.items()  # nothing old was touched
    touched = {r.b for r in rows([(hit, 0), ("new" + hit, 0)]).select(store.bucket().alias("b")).collect()}
    paths, first = store.paths(2), store.paths(1)
    assert {b for b in paths if paths[b] != first.get(b)} == touched
    now = {r.code: r.result for r in store.read().collect()}
    assert now == {str(i): i for i in range(100)} | {hit: -1, "new" + hit: 5}
    assert {r.code: r.result for r in old.collect()} == {str(i): i for i in range(100)}  # readers of version 1 see it whole
    assert store.upsert(rows([])) == 2
    with pytest.raises(Exception, match="results repeat code 1"):
        store.upsert(rows([("1", 1), ("1", 2)]))
    assert store.version() == 2
    os.makedirs(tmp_path / "versions/3")  # a version that was begun and not ended
    assert store.version() == 2


def test_stream_restarts_without_new_rows(spark, tmp_path):
    rules = [declarative("x:code", "info", {"not": {"field": "code", "op": "is_missing"}})]
    rows = spark.range(20).selectExpr("cast(id as string) as code", "'n' as product_name")
    rows.repartition(6).write.parquet(str(tmp_path / "rows"))
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "rows"))
        write_batches(stream, rules, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == 20 and found.select("batch").distinct().count() >= 3
    rows.limit(2).write.mode("append").parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    write_batches(stream, rules, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 22


def test_index_of_templates_equals_patterns(spark):
    ids = ["en:a-${x}-b", "en:a-${x}", "en:exact", "${x}:y", "en:a-${x}${y}-z", "en:long-literal-start-of-a-template-${n}"]
    rules = [declarative(i, "info", {"field": "code", "op": "is_missing"}, baseline="legacy") for i in ids]
    codes = ["en:a-1-b", "en:a-b", "en:a--b", "en:exact", "en:exact-", "q:y", ":y", "en:a-12-z", "en:a-1 2", "en:long-literal-start-of-a-template-5", "en:long-literal-start-of-a-template-", "e", "", "a:y:y"]
    raw = spark.createDataFrame([(c,) for c in codes], "raw_code string")
    got = sorted((r.raw_code, r.check_id) for r in pa.match_indexed(raw, pa.template_index(spark, rules)).collect())
    assert got == sorted((r.raw_code, r.check_id) for r in pa.match_codes(raw, rules).collect()) and got
    size = lambda n: len(pa.match_indexed(raw, pa.template_index(spark, [declarative(f"t{i}-${{x}}", "info", {"field": "code", "op": "is_missing"}, baseline="legacy") for i in range(n)]))._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(10) == size(2000)


def test_index_tries_few_templates(spark):
    """Templates that share a start of four characters or only an end are told apart before any pattern; no code is shuffled."""
    ids = [f"x:p{n}-${{v}}-end" for n in range(500)] + [f"${{any}}:tail-{n}" for n in range(50)] + ["${a}", "${a}-${b}", "x:exact"]
    rules = [declarative(i, "info", {"field": "code", "op": "is_missing"}, baseline="legacy") for i in ids]
    codes = [f"x:p{n}-v-end" for n in range(0, 600, 7)] + [f"é{n}:tail-{n}" for n in range(60)] + ["x:p1--end", "x:p1-end", "-", "a-b", "", None, "x:exact", "ü😀"]
    raw = spark.createDataFrame([(c,) for c in codes], "raw_code string")
    index = pa.template_index(spark, rules)
    found = pa.match_indexed(raw, index)
    assert sorted((r.raw_code, r.check_id) for r in found.collect()) == sorted((r.raw_code, r.check_id) for r in pa.match_codes(raw, rules).collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    by_ends = pa.tried_templates(raw, index).where("size > 0 or tail > 0").groupBy("raw_code").count().agg(F.max("count")).first()[0]
    assert by_ends <= 2
    assert pa.match_indexed(raw, pa.template_index(spark, [])).collect() == []


def test_one_python_node(spark):
    from larder.operators.context import project_source

    rows = project_source(spark.createDataFrame([("1", "5 g", "a,b"), ("2", None, "")], "code string, quantity string, labels_tags string"))
    python = [
        ArrowRule("p:one", ["product.quantity"], lambda r: [("p:one-q", "bug")] if r["product.quantity"] else []),
        ArrowRule("p:two", ["code", "product.labels_tags"], lambda r: [(None, "info")] * len(r["product.labels_tags"])),
    ]
    native = pack([{"id": "n:all", "severity": "info", "when": {"not": {"field": "code", "op": "is_missing"}}}])
    found = fi.evaluate_mixed(rows, native, python)
    assert sorted((r.product_id, r.check_id, r.emitted_code or "") for r in found.collect()) == [
        ("1", "n:all", ""), ("1", "p:one", "p:one-q"), ("1", "p:two", ""), ("1", "p:two", ""), ("2", "n:all", ""),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_profiles(spark):
    rules, config = packaged(), {"default_profile": "all", "profiles": {"all": {"description": "d"}, "x": {"description": "d", "mode": "include", "check_ids": ["en:code-empty"], "check_context_provider": "source_products"}}}
    assert all(r.baseline == "legacy" for r in profiles.active_rules(spark, rules, profiles.profile_of(config)))
    assert [r.id for r in profiles.active_rules(spark, rules, profiles.profile_of(config, "x"))] == ["en:code-empty"]
    table = {r.check_id: r.reason for r in profiles.selection(spark, rules, profiles.profile_of(config, "x")).collect()}
    assert table["en:code-empty"] is None and table["en:created-zero"] == "not asked for"
    sources = config | {"profiles": {"s": {"description": "d", "check_context_provider": "source_products"}}}
    reasons = {r.check_id: r.reason for r in profiles.selection(spark, rules, profiles.profile_of(sources, "s")).collect()}
    assert reasons["en:main-language-missing"] == "rows lack product.lang" and reasons["ca:source-of-fibre-claim-but-fibre-below-threshold"] == "baseline none"

    def own(**more):
        return profiles.profile_of({"profiles": {"p": {"description": "d"} | more}}, "p")

    for ids in (["en:main-language-missing"], ["en:unknown"], ["ca:source-of-fibre-claim-but-fibre-below-threshold"]):
        with pytest.raises(ValueError):
            profiles.active_rules(spark, rules, own(mode="include", check_ids=ids, check_context_provider="source_products"))
    for wrong in ({"mode": "some"}, {"mode": "include"}, {"check_ids": ["a"]}, {"mode": "include", "check_ids": ["a", "a"]}, {"parity_baselines": ["x"]}, {"check_context_provider": "x"}, {"description": " "}, {"old": 1}):
        with pytest.raises(ValueError):
            own(**wrong)
    with pytest.raises(ValueError):
        profiles.profile_of(config, "absent")


def test_reference_side_hashes_its_rows(spark):
    """The highest severity is found without a sort of all rows."""
    rows = spark.createDataFrame([("1", ["en:code-missing"], ["en:code-missing", "en:food-groups-2-known", "en:food-groups-a b-known"])], "code string, info array<string>, error array<string>")
    tags = F.struct("info", F.array().cast("array<string>").alias("completeness"), F.array().cast("array<string>").alias("warning"), "error", F.array().cast("array<string>").alias("bug"))
    found = pa.reference_findings(rows.select("code", tags.alias("legacy_check_tags")), packaged())
    assert sorted((r.check_id, r.observed_code, r.severity) for r in found.collect()) == [
        ("en:code-missing", "en:code-missing", "error"), ("en:food-groups-${level}-known", "en:food-groups-2-known", "error"),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def _claims_and_findings(spark, codes):
    """Contexts by k whose code is enough for a rule, with expected codes that repeat, differ in severity or are unknown."""
    rules = [declarative("x:a", "bug", {"field": "code", "op": "eq", "value": "1"}, baseline="legacy"), declarative("x:${n}-b", "bug", {"field": "code", "op": "is_missing"}, baseline="legacy")]
    rules.append(declarative("x:mine", "error", {"not": {"field": "code", "op": "is_blank"}}, baseline="none"))
    tags = lambda i: ([["x:a", "x:a"], ["x:a"], ["x:5-b", None, ""], [], None][i % 5], [["x:a"], [], None, ["x:5-b", "x:no"], ["x:6-b"]][i % 5])
    rows = spark.createDataFrame([(i, c, *tags(i)) for i, c in enumerate(codes)], "k long, code string, info array<string>, bug array<string>")
    none = F.array().cast("array<string>")
    told = F.struct("info", none.alias("completeness"), none.alias("warning"), none.alias("error"), "bug").alias("legacy_check_tags")
    return rows.select("k", "code", told).repartition(3, "k"), rules


def _differences(rows):
    return sorted(tuple(r[n] for n in ("check_id", "product_id", "observed_code", "severity", "n_reference", "n_migrated", "matched", "missing", "extra")) for r in rows.collect())


def test_differences_are_counted_where_the_rows_lie(spark):
    """The same rows as the shuffled difference of both sides; nothing but the rows' own dealing is shuffled."""
    rows, rules = _claims_and_findings(spark, [str(i + 1) for i in range(60)])
    want = pa.difference(pa.reference_findings(rows, rules), fi.observed(fi.evaluate(rows, rules)))
    got = pa.difference_within(rows.withColumn("found", fi.emissions(rules)), "k", rules)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 1
    assert _differences(got) == _differences(want) and all(any(r[n] for r in _differences(want)) for n in (6, 7, 8))  # matched, missing and extra ones


def test_codes_of_several_rows_are_compared_together(spark, monkeypatch):
    rows, rules = _claims_and_findings(spark, ["1", "1", "2", "3", "2", "2", "4", "1"])
    monkeypatch.setattr(run_queries, "RULES", rules)
    want = pa.difference(pa.reference_findings(rows, rules), fi.observed(fi.evaluate(rows, rules)))
    again = spark.createDataFrame([("1",), ("2",), ("4",)], "code string")
    assert _differences(run_queries.run_differences(rows, again)) == _differences(want)


def test_stored_examples_are_the_first_ones(spark):
    rows = spark.createDataFrame([(f"r{i % 3}", f"{i * 7919 % 5000:04}", "c", "info", "missing", "reference" if i % 2 else "migrated", 1) for i in range(4000)] + [("rare", "9", "c", "info", "extra", "migrated", 1)],
        "check_id string, product_id string, observed_code string, severity string, kind string, side string, copy int")
    shown = lambda r: sorted(tuple(x) for x in r.select("check_id", "side", "rank", "product_id").collect())
    got = pa.stored_examples(rows, 20, share=8)
    assert shown(got) == shown(pa.examples(rows, 20))
    assert shown(pa.stored_examples(rows, 20)) == shown(pa.examples(rows, 20))


def test_review_shuffles_a_product_once(spark):
    rows = spark.createDataFrame([(p, k, s) for p in ("0000000000012", "12", "x", "0000000000013") for k, s in (("missing", "info"), ("missing", "info"), ("extra", "bug"))] + [("x", "extra", "error")], "product_id string, kind string, severity string")
    found = run_queries.review_products(rows)
    got = {(r.kind, r.severity): r.products for r in found.collect() if r.products}
    assert got == {("missing", "info"): 4, ("extra", "bug"): 4, ("extra", "error"): 1}
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="unknown kind or severity: missing x"):
        run_queries.review_products(rows.withColumn("severity", F.lit("x"))).collect()
