"""SimHash near-duplicates: fingerprints, bit-sliced comparison in blocks, components.

Fingerprints within the radius agree on all but ``radius`` of b bit blocks, so every choice
of b - radius blocks is an exact-match bucket and no link is lost.  b follows the number of
different fingerprints, so that a bucket holds few of them at any size.  Inside a task, the
fingerprints of all buckets lie in vertical bit planes; lane i meets lane i + k of its bucket
for k = 1, 2, ...; the differing bits of all lanes are counted by carry-save adders, and
words whose lanes all exceed the radius are dropped.  A bucket beyond ``TILE`` is dealt out
in tiles that together hold each of its pairs.  Of the links in a bucket only a spanning
forest leaves the task, which is all that components need.

Defined results: a null or empty text has fingerprint 0 and links like any other; equal
texts have equal fingerprints; repeated rows repeat; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import deal, drop_written, mapped, slices, whole_rows, written
from larder.llm.components import SHARE, components

WORDS = 4
RADIUS = 4
SEED = 42
#: Lanes of a bucket that one task compares with each other.
TILE = 2048
#: Rows of the bucket tables (16 bytes each) that one task is dealt.
TASK_ROWS = 4_000_000
_CHUNK = 1 << 16
#: Bytes of the texts that a task has as Python strings at once.
_ROUND = 4 << 20


def fingerprint_of(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of one text, as an unsigned integer."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = ends - np.fromiter(map(len, tokens), np.int64, len(tokens)) - 1
    if len(tokens) > words:
        starts, ends = starts[: len(tokens) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    a, b = starts.tolist(), (ends - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(a), _CHUNK):
        hashes = b"".join([digest(joined[x:y], seed) for x, y in zip(a[at : at + _CHUNK], b[at : at + _CHUNK], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(a)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, fp) for every row: xxhash64 of the text, and the 64 bits as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, whole.column(1), _ROUND):
                fps = np.array([fingerprint_of(t) for t in batch.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])

    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return mapped(docs.select(F.col(id_col), F.col(text_col), th), run, f"doc_id {id_type}, th long, fp long")


def block_masks(n: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of the bucket tables for n fingerprints: all choices of b - radius of b blocks.

    At least two blocks have to agree, so up to 2**26 fingerprints have the same tables.
    """
    wanted = max(0, n.bit_length() - 5)
    b = next(b for b in range(radius + 2, 64) if (64 // b) * (b - radius) >= wanted or b == radius + 8)
    edges = [64 * i // b for i in range(b + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, b - radius)]


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder on bit vectors: sum and carry."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def _within(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-bit count is at most the radius."""
    out = np.zeros_like(ones)
    for v in range(radius + 1):
        out |= (ones if v & 1 else ~ones) & (twos if v & 2 else ~twos) & (fours if v & 4 else ~fours)
    return out


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Plane b holds bit b of every fingerprint, 64 lanes a word, with a spare word behind."""
    n = len(fps)
    words = (n + 63) // 64 + 1
    planes = np.zeros((64, words * 8), np.uint8)
    for b in range(64):
        packed = np.packbits(((fps >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
        planes[b, : len(packed)] = packed
    return planes.view(np.uint64)


def _shifted(rows: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The words ``at`` of bit rows moved down by k lanes."""
    word, bit = divmod(k, 64)
    last = rows.shape[1] - 1
    low = rows[:, np.minimum(at + word, last)]
    if not bit:
        return low
    return (low >> np.uint64(bit)) | (rows[:, np.minimum(at + word + 1, last)] << np.uint64(64 - bit))


def lane_links(planes: np.ndarray, k: int, valid: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Lanes i of ``valid`` (a bit vector) whose fingerprint is within the radius of lane i + k's."""
    at = np.flatnonzero(valid)
    alive = valid[at]
    ones = twos = fours = over = np.zeros(len(at), np.uint64)
    for b in range(0, 64, 8):
        rows = planes[b : b + 8]
        x = rows[:, at] ^ _shifted(rows, at, k)
        ones, t0 = _add(ones, x[0], x[1])
        ones, t1 = _add(ones, x[2], x[3])
        twos, f0 = _add(twos, t0, t1)
        ones, t0 = _add(ones, x[4], x[5])
        ones, t1 = _add(ones, x[6], x[7])
        twos, f1 = _add(twos, t0, t1)
        fours, eights = _add(fours, f0, f1)
        over = over | eights
        alive = alive & ~over & _within(ones, twos, fours, radius)
        keep = np.flatnonzero(alive)
        if not len(keep):
            return keep
        if len(keep) < 0.75 * len(at):
            at, alive, ones, twos, fours, over = (v[keep] for v in (at, alive, ones, twos, fours, over))
    bits = np.unpackbits(alive.view(np.uint8), bitorder="little").reshape(-1, 64)
    w, lane = np.nonzero(bits)
    return at[w] * 64 + lane


def _hook(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of linked lanes, smaller root on top, all paths short."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(nxt := root[root], root):
            root = nxt


def bucket_forest(bucket: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links inside each bucket: pairs of fingerprints."""
    order = np.argsort(bucket, kind="stable")
    bucket, fps = bucket[order], fps[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, len(bucket)])
    by_size = np.argsort(-sizes, kind="stable")
    by_size = by_size[sizes[by_size] > 1]
    sizes, first = sizes[by_size], first[by_size]
    if not len(sizes):
        return fps[:0], fps[:0]
    starts = np.cumsum(sizes) - sizes
    take = np.repeat(first - starts, sizes) + np.arange(sizes.sum())
    fps = fps[take]
    left = np.repeat(starts + sizes, sizes) - np.arange(len(fps))  # lanes from here to the bucket's end
    planes, root = bit_planes(fps), np.arange(len(fps))
    for k in range(1, int(sizes[0])):
        n = int(sizes[: np.searchsorted(-sizes, -k, side="left")].sum())  # buckets of more than k lanes
        packed = np.packbits(left[:n] > k, bitorder="little")
        valid = np.zeros((n + 63) // 64 * 8, np.uint8)
        valid[: len(packed)] = packed
        hit = lane_links(planes, k, valid.view(np.uint64), radius)
        if len(hit):
            root = _hook(root, hit, hit + k)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return fps[moved], fps[root[moved]]


def links(nodes: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Spanning links (a, b) among the different fingerprints of ``nodes`` (column fp)."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(n, radius)]
    tables = F.array(*[F.struct(F.lit(i).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    rows = nodes.select("fp", F.inline(tables))
    hot = rows.groupBy("tab", "key").count().where(F.col("count") > TILE)
    hot = hot.select("tab", "key", "count", F.ceil(F.col("count") / TILE).cast("int").alias("parts"))
    # buckets of over one row in SHARE (so fewer than SHARE buckets) are told to every task; rows of theirs don't meet by key
    bar = n * len(signed) // SHARE
    known = F.broadcast(hot.where(F.col("count") > bar).select("tab", "key", F.col("parts").alias("told")))
    rest = hot.where(F.col("count") <= bar).select(F.col("tab").alias("t"), F.col("key").alias("k"), F.col("parts").alias("found"))
    rows = rows.join(known, ["tab", "key"], "left")
    t = F.when(F.col("told").isNull(), F.col("tab")).otherwise(-1)
    k = F.when(F.col("told").isNull(), F.col("key")).otherwise(F.xxhash64("fp"))
    rows = rows.withColumns({"t": t, "k": k}).join(rest, ["t", "k"], "left").withColumn("parts", F.coalesce("told", "found"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = rows.select(
        "tab",
        "key",
        "fp",
        F.explode(
            F.when(F.col("parts").isNull(), F.expr("array(struct(0 as i, 0 as j))")).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1),
                    lambda o: F.struct(F.least(part, o).cast("int").alias("i"), F.greatest(part, o).cast("int").alias("j")),
                )
            )
        ).alias("tile"),
    )
    keyed = dealt.select(F.xxhash64("tab", "key", "tile.i", "tile.j").alias("bucket"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)) for b in batches if b.num_rows]
        if held:
            a, b = bucket_forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]), radius)
            for at in range(0, len(a), _CHUNK):
                cols = [pa.array(v[at : at + _CHUNK].view(np.int64)) for v in (a, b)]
                yield pa.RecordBatch.from_arrays(cols, ["a", "b"])

    return mapped(deal(keyed, "bucket", at_least=n * len(signed) // TASK_ROWS), run, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, th, fp, root, component_id) for every row.

    th is the xxhash64 of the text, root the least fingerprint of the component, component_id the
    least id that links lead to.
    """
    fps = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp-nodes")
    roots = components(links(nodes, nodes.count(), radius))
    tied = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(tied.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least id that links lead to."""
    return classes(docs, id_col, text_col, radius).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of every component, with all columns of ``docs``: that of the least id (null last), then least text hash."""
    found = classes(docs, id_col, text_col, radius)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th"))
    chosen = written(found.groupBy("root").agg(best.alias("k")).select("k.doc_id", "k.th"), "representatives")
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(whole_rows(docs).alias("row"), F.col(id_col).alias("doc_id"), th.alias("th"))
    # the narrow side is hashed, so that texts are dealt out but not sorted
    kept = chosen.hint("shuffle_hash")
    out = rows.join(kept, rows.doc_id.eqNullSafe(kept.doc_id) & (rows.th == kept.th), "left_semi")
    repeated = found.groupBy("doc_id", "th").count().where(F.col("count") > 1)
    if not repeated.isEmpty():  # rows equal in id and text: one of them stays
        out = out.dropDuplicates(["doc_id", "th"])
    return out.select("row.*")


def simhash_query(docs: DataFrame) -> DataFrame:
    """The contract's columns: fingerprint as 16 hex digits and the component's least doc_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

