"""Registered product queries against DuckDB on the smallest data."""

import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from larder import fixtures as fx
from larder.plans import input_queries, run_queries  # noqa: F401  register their queries
from larder.plans.product_queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
SOME = [
    "findings_source", "findings_enriched", "parity_diff", "parity_summary", "parity_examples", "reference_findings", "report_rows", "report_composition",
    "norm_document", "norm_export", "sheet_annotate", "sheet_colour_ranges", "family_rollup", "fill_blank_merge", "cache_upsert", "select_sample", "cohort_join",
    "ingredient_nodes", "family_sets", "as_number", "template_match", "structured_cells",
    "json_text", "envelopes", "contract_of", "cache_ordered", "cache_counts", "sheet_outcome", "sheet_preview", "sheet_preview_counts", "snapshot_fingerprint",
    "read_json_lines", "read_tsv", "read_sheet", "run_benchmark", "contract_reasons",
    "snapshot_documents", "rows_accepted", "rows_rejected", "read_sheet_quoted", "read_tsv_quoted", "read_lines_lenient",
    "run_full", "batches_merged", "results_upserted", "findings_streamed", "reference_match_many", "findings_mixed_pack", "profile_findings", "rules_runnable",
]


def plain(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", SOME)
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("lineitem", "part", "events", "orders", "customer"):
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    rel = db.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    want = sorted((tuple(plain(r[names.index(n)]) for n in sorted(names)) for r in rel.fetchall()), key=repr)
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(plain(r[n]) for n in sorted(names)) for r in df.collect()), key=repr) == want and want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ["rule_40", "claim_nutrients"])
def test_nested_rows_are_not_shuffled(spark, name):
    """Nested sets and ingredients are grouped and joined where the narrow base rows lie, also if no table is broadcast."""
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    by_key = [line for line in plan.splitlines() if " Exchange hashpartitioning(k#" in line]
    assert by_key and all("REPARTITION_BY_NUM" in line for line in by_key)


def test_report_counts_all_mismatches(spark):
    """No cut at twenty: the examples of a compared rule are all of its mismatches."""
    rows = [r for r in QUERIES["report_rows"](spark, DATA).collect() if r["status"] == "compared"]
    assert all((r["missing_examples"], r["extra_examples"]) == (r["missing"], r["extra"]) for r in rows)
    assert max(r["mismatches"] for r in rows) > 40


@pytest.mark.parametrize("name", ["rows_accepted", "rows_rejected"])
def test_dispatch_is_evaluated_once(spark, name):
    """The filter on its result tests a column; the whole expression doesn't move into it."""
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert filters and max(map(len, filters)) < 1000


def test_stream_files_grow_with_the_rows(spark, monkeypatch, tmp_path):
    """Twenty files for twenty partitions of rows, not eight."""
    monkeypatch.setattr(run_queries.fx, "partitions", lambda spark, sf_dir: 20)
    monkeypatch.setattr(run_queries, "_folder", lambda spark, label: f"file://{tmp_path}")
    found = QUERIES["findings_streamed"](spark, DATA)
    assert len(list(tmp_path.glob("rows/*.parquet"))) == 20 and found.count() > 0
def test_derived_rows_keep_their_partitions(spark):
    """Groupings of the derived rows have as many tasks as these have partitions, also where that is the session's number."""
    rows = fx.base(spark, DATA).groupBy("k").agg(F.count(F.lit(1)))
    assert fx.partitions(spark, DATA) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows.rdd.getNumPartitions() == fx.partitions(spark, DATA)


def test_joins_hold_flat_sets(spark):
    """Nested sets are built after the joins, so no join sorts them."""

    def joined(node):
        children = [node.children().apply(i) for i in range(node.children().size())]
        own = [node.schema().simpleString()] if node.nodeName() == "Join" else []
        return own + [s for c in children for s in joined(c)]

    kinds = joined(QUERIES["rule_05"](spark, DATA)._jdf.queryExecution().optimizedPlan())
    assert kinds and not [k for k in kinds if "map<" in k]


def test_sorted_findings_are_evaluated_once(spark):
    plan = QUERIES["findings_sorted"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" in plan and "Generate" not in plan


@pytest.mark.parametrize("name", ["contract_of", "contract_reasons"])
def test_one_shape_a_row_is_built(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().analyzed().toString()
    assert "to_json" in plan and "array(to_json" not in plan


@pytest.mark.parametrize("name", ["reference_match"])
def test_patterns_are_compiled(spark, name):
    """Patterns of codes stand in no function that Spark interprets with all its arguments."""
    kept = spark.conf.get("spark.sql.debug.maxToStringFields")
    try:
        spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", kept)
    assert "RLIKE" in plan and not re.search(r"filter\(array\(CASE WHEN [^\n]*RLIKE", plan.split("Relation")[0].split("Aggregate")[0])


def test_run_keeps_its_findings_off_the_disk(spark, monkeypatch, tmp_path):
    """A whole run shuffles its narrow base rows, no finding; its tables take few bytes a row."""
    monkeypatch.setattr(run_queries, "_folder", lambda spark, label: f"file://{tmp_path}/{label}")
    plans = []
    write = run_queries.RunTables.write
    monkeypatch.setattr(run_queries.RunTables, "write", lambda self, t, i, rows, batch=None: (plans.append((t, rows._jdf.queryExecution().executedPlan().toString())), write(self, t, i, rows, batch))[1])
    tables, run_id = run_queries.run_full(spark, DATA)
    plan = dict(plans)["run_differences"]
    moved = [line for line in plan.splitlines() if " Exchange hashpartitioning(" in line]
    assert moved and all("REPARTITION_BY_NUM" in line for line in moved)
    for name in ("run_differences", "run_mismatches"):
        size = sum(f.stat().st_size for f in tmp_path.glob(f"runs/{name}/**/*.parquet"))
        assert size < 6 * tables.read(name, run_id).count()


def test_run_review_equals_sql(spark):
    test_equals_sql(spark, "run_review")


def test_enriched_findings_are_compiled(spark):
    """Base rows are dealt out once, no set is joined or grouped again, and no generator interprets the rules."""
    plan = QUERIES["findings_enriched"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "SortMergeJoin" not in plan and "inline(" not in plan.lower()
    assert [line for line in plan.splitlines() if "Generate explode(concat(found" in line]
    assert not [line for line in plan.splitlines() if "Filter" in line and "CASE WHEN" in line]
