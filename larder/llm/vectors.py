"""Integer vectors in files of the shared folder, searched by blocks of queries: one (block, file) pair is one unit of work.

Files and blocks are named by the rows that commit them, so a task that is tried again leaves an
orphan only.  No list of files or queries reaches the driver.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import drop_written, mapped, new_path, written
from larder.llm.shared_files import get, put

SCALE = 256.0
#: Components in one file at most (one vector more), and at least where several partitions share the work.
FILE_VALUES, LEAST_VALUES = 1 << 22, 1 << 19
#: Queries of one block.
BLOCK = 128
STRIPES = 32
#: Stands for no score.
NONE = -(1 << 63)


def usable(rows: DataFrame, vec_id: str, vector: str, **more: Column) -> DataFrame:
    """(id, vector, ...): rows with an id and a vector whose components are all finite; the others take no part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("vector"), *[c.alias(n) for n, c in more.items()]).where(
        F.col("id").isNotNull() & F.coalesce(~odd, F.lit(False))
    )


def matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of doubles to whole numbers floor(256 x); shorter vectors are padded with zeros."""
    n = len(column)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False))
    d = int(sizes.max(initial=0))
    if n and (sizes == d).all():
        return values.reshape(n, d)
    out = np.zeros((n, d))
    out[np.arange(d)[None, :] < sizes[:, None]] = values
    return out


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    d = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, d - p.shape[1]))) for p in parts]) if parts else np.zeros((0, 0))


def compact(m: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(m).max(initial=0)
    return m.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def widest(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * min(a.shape[1], b.shape[1])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b`` as 64-bit integers; one beyond these is an error."""
    d = min(a.shape[1], b.shape[1])
    if widest(a, b) < 2**53:
        return (a[:, :d] @ b[:, :d].T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    out = np.dot(whole(a[:, :d]), whole(b[:, :d]).T)
    if out.size and max(abs(x) for x in out.ravel()) >= 2**63:
        raise OverflowError("an inner product does not fit a 64-bit integer")
    return out.astype(np.int64)


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(path: str) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(get(path)), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def write_files(rows: DataFrame, order: list[Column], build: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]) -> DataFrame:
    """Vectors in ranges of ``order`` to files; ``build`` makes the arrays of a file from its columns.

    Gives (file, most): ``most`` is the file's array of that name, one number.
    """
    spark = rows.sparkSession
    total = rows.agg(F.coalesce(F.sum(F.size("vector") + 1), F.lit(0))).first()[0]
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-total // FILE_VALUES), min(shuffles, total // LEAST_VALUES))
    base = new_path(spark, "vectors")
    names = [c for c in rows.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list[np.ndarray]]] = []
        size, part = 0, TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            columns = {n: np.concatenate([h[1][i] for h in held]) for i, n in enumerate(names)}
            arrays = build(columns | {"vector": stacked([h[0] for h in held])})
            path = f"{base}/{part}-{uuid.uuid4().hex}.npz"
            put(path, packed(arrays))
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([float(arrays["most"])])], ["file", "most"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                m = matrix(piece.column("vector"))
                held.append((m, [piece.column(n).to_numpy(zero_copy_only=False) for n in names]))
                size += m.size + len(m)
                if size >= FILE_VALUES:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return written(mapped(rows.repartitionByRange(parts, *order), run, "file string, most double"), "vector-files")


def write_blocks(queries: DataFrame) -> DataFrame:
    """Queries (id, vector, any columns of numbers, lists of numbers and text) to blocks; gives (block)."""
    spark = queries.sparkSession
    queries = written(queries, "queries")
    n = queries.count()
    base = new_path(spark, "vector-blocks")
    names = [c for c in queries.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                columns = {"vector": compact(matrix(piece.column("vector")))}
                for c in names:
                    x = piece.column(c)
                    if pa.types.is_list(x.type):
                        columns |= {c: x.flatten().to_numpy(zero_copy_only=False), f"{c}_n": pc.list_value_length(x).to_numpy(zero_copy_only=False)}
                    elif pa.types.is_string(x.type):
                        columns[c] = np.array(x.to_pylist(), dtype=np.str_)
                    else:
                        columns[c] = x.to_numpy(zero_copy_only=False)
                path = f"{base}/{uuid.uuid4().hex}.npz"
                put(path, packed(columns))
                yield pa.RecordBatch.from_arrays([pa.array([path])], ["block"])

    blocks = written(mapped(queries.repartition(max(1, -(-n // BLOCK))), run, "block string"), "vector-block-list")
    drop_written(queries)
    return blocks


def searched(blocks: DataFrame, files: DataFrame, load: Callable[[dict], object], work: Callable[[dict, object], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on every block and file; pairs are names only, joined by stripes of the files and dealt out by name."""
    spark = blocks.sparkSession
    striped = files.select("file", F.pmod(F.xxhash64("file"), F.lit(STRIPES)).alias("stripe"))
    asked = blocks.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(STRIPES - 1).cast("long"))).alias("stripe"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = asked.join(striped, "stripe").select("file", "block").repartition(n, "file", "block").sortWithinPartitions("file", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = None, None
        for batch in batches:
            for file, block in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True):
                if file != at:
                    at, now = file, load(unpacked(file))
                yield work(unpacked(block), now)

    return mapped(pairs, run, schema)


def first_by(rows: DataFrame, keys: list[str], score: str, vec_id: str, k: int) -> DataFrame:
    """The first ``k`` rows of each key, higher scores first, then smaller ids, with their rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(vec_id))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def distinct_queries(rows: DataFrame) -> DataFrame:
    """Equal rows are one query; different vectors of one id are queries of their own, told apart by ``key``."""
    digest = F.substring(F.sha2(F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns if c not in ("id", "vector")], F.array_join("vector", ",")), 256), 1, 32)
    return rows.dropDuplicates().withColumn("key", digest)


def folder_of(files: DataFrame, column: str) -> list[str]:
    """The folder that holds the files (they all lie in one)."""
    row = files.select(F.regexp_replace(column, "/[^/]*$", "").alias("d")).first()
    return [row["d"]] if row else []


def drop_files(lists: list[tuple[DataFrame, str]]) -> None:
    """Delete files or blocks and the tables that list them."""
    for table, column in lists:
        spark = table.sparkSession
        for name in folder_of(table, column):
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        drop_written(table)
