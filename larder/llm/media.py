"""Media columns: content-addressed payloads in tar shards, with header-only range reads.

A payload of 8-bit samples is stored as a lossless grey image (PNG, 64 samples a row).  Tasks
append images to tar shards in the shared folder, each different payload once in all; rows
carry the payload's digest, the shard, offset and length.  Metadata columns come from range
reads of the image header alone; features from reading the stored range, once a payload.

Defined results: null or empty text is a payload of 64 zero bytes; equal texts have equal
values, their place included; repeated rows repeat; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import deal, mapped, new_path, slices, written
from larder.llm.shared_files import opened, put

WIDTH = 64
LEVEL = 4
#: A shard is closed beyond this many bytes.
SHARD_BYTES = 64 << 20
_ROUND = 8 << 20
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Signature and first chunk: all that metadata needs.
HEADER_BYTES = 33


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Unpadded size, and the UTF-8 bytes with zeros up to a positive multiple of WIDTH."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b"\0" * (max(1, -(-len(raw) // WIDTH)) * WIDTH - len(raw))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """Grey image of 8-bit samples, WIDTH a row, no row filter."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int]:
    """Width, height and bits of a sample from the first HEADER_BYTES."""
    if data[:8] != _SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    width, height, depth = struct.unpack(">IIB", data[16:25])
    return width, height, depth


def from_png(data: bytes) -> bytes:
    """Samples of an image that :func:`to_png` made; chunk checksums are tested."""
    width, height, _ = png_header(data)
    at, packed = 8, []
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0] != zlib.crc32(kind + body):
            raise ValueError("damaged chunk")
        if kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    return lines[:, 1:].tobytes()


def _tar_head(name: str, size: int) -> bytes:
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf(tarfile.USTAR_FORMAT)


#: Bits that tell which digests may be of several rows; 2 MB reach the driver and the tasks at any size of the table.
REPEAT_BITS = 24
#: A digest of more than one in so many rows is joined by broadcast; there are fewer than HEAVY of them.
HEAVY = 1024
_PLACE = ["shard", "offset", "length"]


class Tar:
    """A shard in memory; members are named by digest, and one digest is held once."""

    def __init__(self) -> None:
        self.out, self.places = io.BytesIO(), {}

    def add(self, digest: str, payload: bytes) -> tuple[int, int]:
        if digest not in self.places:
            media = to_png(payload)
            self.out.write(_tar_head(digest + ".png", len(media)))
            self.places[digest] = (self.out.tell(), len(media))
            self.out.write(media)
            self.out.write(b"\0" * (-len(media) % 512))
        return self.places[digest]

    def full(self) -> bool:
        return self.out.tell() > SHARD_BYTES

    def close(self, folder: str) -> str | None:
        if not self.places:
            return None
        self.out.write(b"\0" * 1024)
        path = f"{folder}/{uuid.uuid4().hex}.tar"
        put(path, self.out.getbuffer())
        return path


def _repeat_bits(rows: DataFrame) -> np.ndarray:
    """Bit set of the digests of several rows: two bits each, from the digest's first twelve hex digits."""
    several = rows.groupBy(F.unhex("digest").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    spots = F.array(*[F.conv(F.substring(F.hex("d"), at, REPEAT_BITS // 4), 16, 10).cast("long") for at in (1, 1 + REPEAT_BITS // 4)])
    spot = several.select(F.explode(spots).alias("spot"))
    words = spot.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << (REPEAT_BITS - 6), np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bits


def _may_repeat(bits: np.ndarray, digest: str) -> bool:
    step = REPEAT_BITS // 4
    return all(int(bits[spot >> 6]) >> (spot & 63) & 1 for spot in (int(digest[:step], 16), int(digest[step : 2 * step], 16)))


def _store_single(folder: str, bits, names: list[str]):
    """mapInArrow function: a payload of one row is stored at once; of others the task's first row carries the payload on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tar, rows, held, types, carried = Tar(), [], 0, None, set()

        def close() -> pa.RecordBatch:
            path = tar.close(folder)
            ids, sizes, digests, places, payloads = zip(*rows, strict=True)
            offsets, lengths = ([p and p[i] for p in places] for i in (0, 1))
            cols = [pa.array(ids, types), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array([p and path for p in places], pa.string())]
            return pa.RecordBatch.from_arrays([*cols, pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(payloads, pa.binary())], names)

        for whole in batches:
            for batch in slices(whole, "text", _ROUND):
                types = batch.column(0).type
                for ident, text, digest in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    size, payload = payload_of(text)
                    if not _may_repeat(bits.value, digest):
                        rows.append((ident, size, digest, tar.add(digest, payload), None))
                    elif digest in carried:
                        rows.append((ident, size, digest, None, None))
                    else:
                        carried.add(digest)
                        held += len(payload)
                        rows.append((ident, size, digest, None, payload))
                if tar.full() or held > _ROUND:
                    yield close()
                    tar, rows, held = Tar(), [], 0
        if rows:
            yield close()

    return run


def _store_repeated(folder: str):
    """mapInArrow function over (digest, payload) in order of digest: each digest is stored once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tar, last = Tar(), None

        def close() -> pa.RecordBatch:
            path, places = tar.close(folder), tar.places
            cols = [pa.array(list(places), pa.string()), pa.array([path] * len(places), pa.string())]
            return pa.RecordBatch.from_arrays([*cols, *(pa.array([p[i] for p in places.values()], pa.int64()) for i in (0, 1))], ["digest", *_PLACE])

        for whole in batches:
            for batch in slices(whole, "payload", _ROUND):
                for digest, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if digest != last:
                        last = digest
                        tar.add(digest, payload.as_py())
                if tar.full():
                    yield close()
                    tar = Tar()
        if tar.places:
            yield close()

    return run


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Write tar shards, each different payload once in all; gives rows and places.

    Rows are (doc_id, n_bytes, digest, shard, offset, length), without a place where the digest may be of several
    rows; places are (digest, heavy, shard, offset, length) of those digests, heavy if one row in HEAVY has it.  Which digests
    repeat is counted over all rows and told by a bit set of fixed size: a chance hit only sends a payload through the
    shuffle by digest, as all repeated ones go, once a task.  A failed attempt leaves a shard that no row names.
    """
    spark = docs.sparkSession
    folder, id_type = new_path(spark, "media"), docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text)
    padded = F.call_function("rpad", text.cast("binary"), (F.greatest(F.lit(1), F.ceil(size / WIDTH)) * WIDTH).cast("int"), F.lit(b"\0"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.sha2(padded, 256).alias("digest"))
    bits = spark.sparkContext.broadcast(_repeat_bits(rows))
    names = ["doc_id", "n_bytes", "digest", *_PLACE, "payload"]
    schema = f"doc_id {id_type}, n_bytes long, digest string, shard string, offset long, length long, payload binary"
    index = written(mapped(rows, _store_single(folder, bits, names), schema), "media-index")
    payloads = deal(index.where("payload is not null").select("digest", "payload"), "digest").sortWithinPartitions("digest")
    places = mapped(payloads, _store_repeated(folder), "digest string, shard string, offset long, length long")
    times = index.where("shard is null").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    heavy = F.col("n") * HEAVY > index.count()
    return index.drop("payload"), written(places.join(times, "digest").select("digest", heavy.alias("heavy"), *_PLACE), "media-places")


def resolved(waiting: DataFrame, places: DataFrame) -> DataFrame:
    """Rows without a place take what is known of their digest's; no digest of many rows goes to one task."""
    several = waiting.select("doc_id", "n_bytes", "digest")
    heavy, light = places.where("heavy").drop("heavy"), places.where("not heavy").drop("heavy")
    often = several.join(F.broadcast(heavy), "digest")
    rest = several.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").join(light, "digest")
    return often.unionByName(rest)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`stored`, with the place of every row: (doc_id, n_bytes, digest, shard, offset, length)."""
    rows, places = stored(docs, id_col, text_col)
    return rows.where("shard is not null").unionByName(resolved(rows.where("shard is null"), places))


def by_place(index: DataFrame) -> DataFrame:
    """Rows of one shard together, in order of place: what the readers of ranges take."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(n, "shard").sortWithinPartitions("shard", "offset")


def _reader(sizes_of, work, out_names):
    """mapInArrow function that reads one range a row, files kept open while they last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, last, value = None, None, None, None
        for batch in batches:
            out = []
            for shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "length")), strict=True):
                if shard != name:
                    store_, path = opened(shard)
                    if file is not None:
                        file.close()
                    name, file = shard, store_.open_input_file(path)
                if (shard, offset) != last:
                    last, value = (shard, offset), work(file.read_at(sizes_of(length), offset))
                out.append(value)
            cols = [pa.array(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *out_names])

    return run


def with_metadata(ranges: DataFrame) -> DataFrame:
    """Adds width, height and depth, reading HEADER_BYTES a row; rows stay where they are."""
    schema = ", ".join(f"{n} {t}" for n, t in ranges.dtypes) + ", width long, height long, depth long"
    return mapped(ranges, _reader(lambda n: min(n, HEADER_BYTES), png_header, ["width", "height", "depth"]), schema)


def _measured(data: bytes) -> tuple:
    width, height, depth = png_header(data)
    payload = from_png(data)
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    share = counts[counts > 0] / len(payload)
    mean = float((counts * np.arange(256)).sum() / len(payload))
    entropy = float(-(share * np.log2(share)).sum())
    return (
        len(payload),
        hashlib.sha256(payload).hexdigest(),
        zlib.crc32(payload[-WIDTH:]),
        len(data),
        hashlib.sha256(data).hexdigest(),
        f"png {width}x{height}x{depth} mean={mean:.4f} entropy={abs(entropy):.4f} zeros={int(counts[0])}",
    )


def with_features(ranges: DataFrame) -> DataFrame:
    """Adds what is measured on the stored bytes, read back range by range; rows stay where they are."""
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    schema = ", ".join(f"{n} {t}" for n, t in ranges.dtypes)
    schema += ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return mapped(ranges, _reader(lambda n: n, _measured, names), schema)


def media_query(docs: DataFrame) -> DataFrame:
    rows, places = stored(docs)

    def measured(ranges: DataFrame) -> DataFrame:
        return with_features(with_metadata(by_place(ranges)))

    single, known = measured(rows.where("shard is not null")), written(measured(places), "media-known")
    return single.unionByName(resolved(rows.where("shard is null"), known)).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "depth", "digest", *_PLACE
    )
