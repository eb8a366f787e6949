"""Token-id files: global counts, length-limited Huffman codes, files in order of doc_id.

Texts are encoded where they are read; the packed ids are dealt out by ranges of doc_id and
content and sorted; each range becomes one or more files of bounded size in the shared folder.
Files are read back with the table-driven decoder.

Defined results: null or empty text has just the end id; a null doc_id comes first; rows with
equal doc_id follow each other in order of a hash of their ids; an empty table gives an empty
result; other columns are not read.  doc_id is an integer (or text of one); over 2**18 different ids in use are an error.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import huffman
from larder.llm.common import drop_written, mapped, new_path, slices, written
from larder.llm.shared_files import get, put
from larder.llm.tokens import Encoder

_ROUND = 4 << 20
#: Compressed bytes of ids that are counted at once.
_COUNTED = 1 << 20
#: Ids of one file, and of one task's range.
FILE_IDS = 8_000_000
TASK_IDS = 32_000_000
_MIN_ID = -(1 << 63)


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, ids): packed token ids with the end id, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        press = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for batch in slices(whole, "text", _ROUND):
                ids = [x + end for x in encoder.encode([t or "" for t in batch.column(1).to_pylist()])]
                n = [len(x) // encoder.dtype.itemsize for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array([press.compress(x) for x in ids], pa.binary())], ["doc_id", "n", "ids"]
                )

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_MIN_ID)).alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(rows, run, "doc_id long, n long, ids binary", keeps=True)


def counts(rows: DataFrame, size: int, dtype: np.dtype) -> np.ndarray:
    """How often every id occurs in all rows; at most ``size`` sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        open_ = zstandard.ZstdDecompressor()
        for whole in batches:
            for batch in slices(whole, "ids", _COUNTED):  # one sum for many texts: it takes as many steps as there are ids in the vocabulary
                raw = b"".join([open_.decompress(x) for x in batch.column(0).to_pylist()])
                total += np.bincount(np.frombuffer(raw, dtype), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    out = np.zeros(size, np.int64)
    for r in mapped(rows.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["id"]] = r["n"]
    return out


def write_files(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all token files; the result is their index (part, number, path, n_docs, n_tokens, n_bytes), in that order."""
    spark = docs.sparkSession
    rows = written(encoded(docs, tokenizer, end_id, id_col, text_col).withColumn("h", F.xxhash64("ids")), "token-ids")
    encoder = Encoder.of(tokenizer)
    dtype = encoder.dtype
    total = counts(rows, max(encoder.size, end_id + 1), dtype)
    lengths = huffman.code_lengths(total)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total.sum()) // TASK_IDS)
    folder = new_path(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        names, sizes, ids = [], [], []
        part, number, held = TaskContext.get().partitionId(), 0, 0

        def close() -> pa.RecordBatch:
            data = huffman.pack_file(np.array(names, np.int64), np.array(sizes, np.int64), np.frombuffer(b"".join(ids), dtype), lengths)
            path = f"{folder}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.tok"
            put(path, data)
            cols = [pa.array([v]) for v in (part, number, path, len(names), sum(sizes), len(data))]
            return pa.RecordBatch.from_arrays(cols, ["part", "number", "path", "n_docs", "n_tokens", "n_bytes"])

        for batch in batches:
            for name, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names.append(name)
                sizes.append(n)
                ids.append(open_.decompress(blob))
                held += n
                if held >= FILE_IDS:
                    yield close()
                    names, sizes, ids, number, held = [], [], [], number + 1, 0
        if names:
            yield close()

    # ranges of id and content, so that one id of many rows doesn't land in one task
    sorted_ = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "ids").select("doc_id", "n", "ids")
    schema = "part long, number long, path string, n_docs long, n_tokens long, n_bytes long"
    index = written(mapped(sorted_, run, schema), "token-index")
    drop_written(rows)
    return index


def read_files(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files: ids in file order, start among all ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names, sizes, ids = huffman.unpack_file(get(path))
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                cols = [
                    pa.array(names, pa.int64(), mask=names == _MIN_ID),
                    pa.array(start + ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32"])

    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row a file
    placed = written(
        index.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("start")), "token-starts"
    )
    spread = placed.repartition(max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), placed.count() // 4), "path")
    return mapped(spread, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_query(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_files(write_files(docs, tokenizer, end_id=2))
