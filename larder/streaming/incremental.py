"""Findings of a stream of product rows: the batch expressions on a streaming DataFrame, no state."""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.operators.context import project_source
from larder.operators.findings import evaluate
from larder.operators.rules import Rule


def stream_findings(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    return evaluate(project_source(rows), rules)


def write_findings(rows: DataFrame, rules: list[Rule], path: str, checkpoint: str):
    """Append findings of every micro-batch that is available to Parquet; returns the query."""
    return (
        stream_findings(rows, rules)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_batches(rows: DataFrame, rules: list[Rule], path: str, checkpoint: str):
    """Findings of each micro-batch in a folder of its own number: a batch that is delivered again replaces itself."""

    def put(found: DataFrame, number: int) -> None:
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream_findings(rows, rules).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
