"""Named profiles of rules: which rules a run evaluates, and why others are left out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.context import ENRICHED_PATHS, SOURCE_PATHS
from larder.operators.findings import rules_table
from larder.operators.rules import Rule

# Kinds of rows that a profile can be for, with the paths that they provide.
PROVIDERS = {"source_products": SOURCE_PATHS, "enriched_snapshots": ENRICHED_PATHS}
_KNOWN = {"description", "mode", "check_ids", "check_context_provider", "parity_baselines", "jurisdictions"}


def profile_of(config: dict, name: str | None = None) -> dict:
    """One profile of a configuration, its default if no name is given, with all fields filled; what makes no sense is an error."""
    profiles = config.get("profiles") or {}
    name = name or config.get("default_profile")
    if name not in profiles:
        raise ValueError(f"no profile {name!r}; there are {', '.join(sorted(profiles)) or 'none'}")
    own = dict(profiles[name])
    unknown = sorted(set(own) - _KNOWN)
    if unknown:
        raise ValueError(f"profile {name}: unknown fields {', '.join(unknown)}")
    mode, ids = own.get("mode", "all"), own.get("check_ids")
    if not str(own.get("description") or "").strip():
        raise ValueError(f"profile {name} has no description")
    if mode not in ("all", "include"):
        raise ValueError(f"profile {name}: mode is all or include, not {mode!r}")
    if mode == "all" and ids is not None:
        raise ValueError(f"profile {name}: check_ids go with mode include")
    if mode == "include" and (not ids or len(set(ids)) < len(ids)):
        raise ValueError(f"profile {name}: check_ids are missing or repeat")
    provider = own.get("check_context_provider", "enriched_snapshots")
    if provider not in PROVIDERS:
        raise ValueError(f"profile {name}: unknown provider {provider!r}")
    baselines = list(own.get("parity_baselines", ["legacy"]))
    wrong = sorted(set(baselines) - {"legacy", "none"})
    if wrong or not baselines:
        raise ValueError(f"profile {name}: baselines are legacy and none")
    return {"name": name, "mode": mode, "check_ids": ids, "provider": provider, "baselines": baselines, "jurisdictions": own.get("jurisdictions"), "description": own["description"]}


def selection(spark: SparkSession, rules: list[Rule], profile: dict) -> DataFrame:
    """All rules with ``selected`` and, where they aren't, the first ``reason``: not asked for, baseline, jurisdiction, or paths that the rows lack."""
    table = rules_table(spark, rules, PROVIDERS[profile["provider"]])
    text = lambda names: F.array(*[F.lit(n) for n in names])
    asked = F.lit(True) if profile["mode"] == "all" else F.array_contains(text(profile["check_ids"]), F.col("check_id"))
    inside = F.lit(True) if profile["jurisdictions"] is None else F.arrays_overlap("jurisdictions", text(profile["jurisdictions"]))
    reason = (
        F.when(~asked, "not asked for")
        .when(~F.array_contains(text(profile["baselines"]), F.col("baseline")), F.concat(F.lit("baseline "), "baseline"))
        .when(~inside, F.concat(F.lit("jurisdiction "), F.array_join("jurisdictions", ", ")))
        .when(~F.col("runnable"), F.concat(F.lit("rows lack "), F.array_join("missing", ", ")))
    )
    return table.withColumn("reason", reason).withColumn("selected", F.col("reason").isNull())


def active_rules(spark: SparkSession, rules: Iterable[Rule], profile: dict) -> list[Rule]:
    """The rules of a run in order of id; a rule that is asked for by name but unknown or left out is an error."""
    rules = sorted(rules, key=lambda r: r.id)
    rows = {r["check_id"]: r for r in selection(spark, rules, profile).select("check_id", "selected", "reason").collect()}  # a row a rule
    if profile["mode"] == "include":
        wrong = [f"{i}: {rows[i]['reason'] if i in rows else 'unknown'}" for i in profile["check_ids"] if i not in rows or not rows[i]["selected"]]
        if wrong:
            raise ValueError(f"profile {profile['name']}: {'; '.join(wrong)}")
    return [r for r in rules if rows[r.id]["selected"]]
