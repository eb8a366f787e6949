"""The public surface: prepare, project, list, run, compare, summarize, annotate, select."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from larder.operators.context import ENRICHED_PATHS, SOURCE_PATHS, project_enriched, project_source
from larder.operators.findings import evaluate, ordered, select_rules
from larder.operators.parity import difference, summarize
from larder.operators.rules import Rule, packaged
from larder.operators.sheets import annotate
from larder.sources import dispatch
from larder.sources.ingest import canonical, remap
from larder.types import COLUMNS, DOCUMENT_ONLY

__all__ = [
    "COLUMNS", "annotate", "difference", "list_checks", "packaged", "prepare", "project_enriched", "project_source", "run_checks", "summarize",
]


def prepare(rows: DataFrame, columns: dict[str, str] | None = None, rejects: bool = False) -> DataFrame:
    """Rows of any supported shape to canonical columns.

    A VARIANT column ``document`` holds whole objects; a typed frame that holds nutriments or document columns is read the same way, row by row.
    A row without a shape fails the job with its first reason; with ``rejects``, the result is
    the rejected rows with ``_reject_reason`` instead.  ``columns`` maps canonical names to the frame's.
    """
    if not isinstance(rows, DataFrame):
        raise TypeError(f"rows have to be a DataFrame, not {type(rows).__name__}")
    if columns is not None:
        return remap(rows, columns)
    kinds = dict(rows.dtypes)
    if kinds.get("document") == "variant":
        found = dispatch.dispatched(rows, "document")
    elif rejects or "nutriments" in kinds or any(c in kinds for c in DOCUMENT_ONLY):
        found = dispatch.dispatched(rows)
    else:
        return canonical(rows)  # flat columns, whose types the schema tells
    return dispatch.rejected(found) if rejects else dispatch.accepted(dispatch.failfast(found))


def list_checks(enriched: bool = False, rules: Iterable[Rule] | None = None, **filters) -> list[Rule]:
    return select_rules(rules, paths=ENRICHED_PATHS if enriched else SOURCE_PATHS, **filters)


def run_checks(rows: DataFrame, rules: Iterable[Rule] | None = None, enriched: bool = False, sort: bool = False, **filters) -> DataFrame:
    """Findings of all rules that the rows' shape can feed; ``ids``, ``baselines`` and ``jurisdictions`` filter."""
    chosen = list_checks(enriched, rules, **filters)
    found = evaluate(project_enriched(rows) if enriched else project_source(prepare(rows)), chosen)
    return ordered(found) if sort else found
