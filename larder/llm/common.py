"""Helpers that several operators share: shared folder, written tables, text batches."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only on one machine (tests, a laptop) a temporary folder stands in for an absent setting.
    """
    setting = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if setting:
        return setting.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a shared folder")
    if "dir" not in _OWN_DIR:
        _OWN_DIR["dir"] = "file://" + tempfile.mkdtemp(prefix="larder-")
    return _OWN_DIR["dir"]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name inside the shared folder."""
    return f"{shared_dir(spark)}/larder/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it again."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/larder/" in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batch: pa.RecordBatch, texts: str | pa.Array, limit: int):
    """Cut an Arrow batch into row ranges of at most ``limit`` bytes of one string column.

    A single larger row forms a range of its own, so no row is ever split or dropped.
    """
    n = batch.num_rows
    if n == 0:
        return
    column = batch.column(texts) if isinstance(texts, str) else texts
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i in range(n):
        if held and held + int(sizes[i]) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(sizes[i])
    yield batch.slice(start, n - start)


def deal(df: DataFrame, *columns, at_least: int = 0) -> DataFrame:
    """Shuffle by key into the session's number of shuffle partitions."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), at_least)
    return df.repartition(n, *columns)


def release() -> None:
    """Give freed memory back to the system: Python workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: Tables that a worker keeps from task to task of one operator.
KEPT: list[dict] = []


def forget() -> None:
    """Work of another kind begins: the worker, which lives on, leaves what earlier tasks have kept."""
    for table in KEPT:
        table.clear()


def mapped(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` whose tasks leave no freed memory behind, nor find any that other operators keep (``keeps``: they use it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            if not keeps:
                forget()
            yield from work(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def whole_rows(df: DataFrame):
    """All columns of a table as one struct: no column of a stage can clash with a name in it."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
