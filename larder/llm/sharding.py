"""Shards by proportional stratified interleaving.

Rows are shuffled inside their source by a seeded hash of the id and ranked; the rank over
the source's size is the fractional rank.  All rows in order of it are cut into shards of
equal counts, so every shard has each source in its share, and sizes differ by one row at
most (law ``rows``).  Ranks come from a range shuffle and the row counts of its partitions:
no source and no shard is ever held by one task.

Defined results: a null source is a source of its own; a null id is shuffled like any other;
null or empty text has no bytes; repeated rows take places of their own; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import whole_rows, written

SHARDS = 40
SEED = 20240229
#: Up to this many bytes of source names and sizes are broadcast; beyond it, rows meet them in a shuffled join.
SOURCE_BYTES = 2 << 20
#: Row positions inside a partition take these low bits of monotonically_increasing_id.
_LOW = 33


def ranked(rows: DataFrame, keys: list[str], rank: str, label: str) -> DataFrame:
    """Adds the position of every row in the total order of ``keys``."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = written(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", _LOW)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(offsets, "_part")
    inside = F.col("_at").bitwiseAND(F.lit((1 << _LOW) - 1))
    return joined.withColumn(rank, (F.col("_before") + inside).cast("long")).drop("_part", "_before", "_at")


def interleave(rows: DataFrame, source_col: str, id_col: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds ``shard`` and ``slot`` (gapless from 0 inside each shard)."""
    source, ident = F.col(f"`{source_col}`"), F.col(f"`{id_col}`")
    base = rows.select(
        whole_rows(rows).alias("_row"),
        source.isNull().alias("_null"),
        F.coalesce(source.cast("string"), F.lit("")).alias("_source"),
        F.sha2(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(f"::{seed}")), 256).alias("_h"),
        F.xxhash64(whole_rows(rows)).alias("_tie"),
    )
    first = written(ranked(base, ["_null", "_source", "_h", "_tie"], "_rank", "shard-strata"), "shard-ranks")
    sources = first.groupBy("_null", "_source").agg(F.min("_rank").alias("_from"), F.count(F.lit(1)).alias("_size"))
    sources = written(sources, "shard-sources")
    held = sources.agg(F.sum(F.octet_length("_source") + F.lit(64))).first()[0] or 0
    if held <= SOURCE_BYTES:
        sources = F.broadcast(sources)
    share = (F.col("_rank") - F.col("_from") + F.lit(0.5)) / F.col("_size")
    mixed = first.join(sources, ["_null", "_source"]).select("_row", "_h", "_tie", share.alias("_share"))
    placed = ranked(mixed, ["_share", "_h", "_tie"], "_g", "shard-order")
    total = F.lit(first.count()).cast("long")
    shard = F.expr(f"_g * {int(shards)} div _total")
    out = placed.withColumn("_total", total).withColumn("shard", shard.cast("int"))
    start = F.expr(f"(cast(shard as bigint) * _total + {int(shards) - 1}) div {int(shards)}")
    return out.withColumn("slot", F.col("_g") - start).select("_row.*", "shard", "slot")


def sharding_query(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return interleave(rows, "source", "doc_id").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
