"""Prefix trie of conversations that are rebuilt from shared heads, by a skeleton of splitters.

A turn is the first 16 bytes of the SHA-256 of its role and text, a rebuilt conversation the string of
its turns' bytes (its path).  A sample of the paths gives splitters; the trie of the splitters' paths
(the skeleton) is broadcast, its bytes bounded by ``SKELETON_BYTES``.  Paths are dealt out by splitter and sorted, so
every node that isn't in the skeleton has all its members in one shard, and one walk over the sorted
shard finishes it with a stack as high as one path.  Of skeleton nodes each shard gives a partial aggregate
without what other skeleton nodes hold; they are reduced by node, and added up along the skeleton.

Results: a null role or text is empty.  Rows without a conv_id are no conversation.  Turns are ordered
by number, null first; turns of one number by their SHA-256, repeated rows count each.  A conversation that loses
all turns is a member of the root.  An empty table has no node.  Texts may be of any length: only their
hash travels.  The path of a conversation (16 bytes a turn) is one value.  The digest of the ids that end
in a skeleton node is fed in order by one task, from pieces of text that the shards have joined: a
sequential hash has no other way, and it holds one piece at a time.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import drop_written, mapped, written

TURN = 16
#: Bytes of all splitters' paths at most, of a sampled path, and of the sample (expected).
SKELETON_BYTES, LONGEST, SAMPLE_BYTES = 2 << 20, 1 << 16, 16 << 20
#: Paths of a shard, in bytes, and sampled paths for each shard.
SHARD_BYTES, SAMPLED = 32 << 20, 20
#: Bytes of joined ids that a shard hands on at once.
PIECE = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()
_SCHEMA = (
    "kind int, node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, bytes long, seq long, ends_sha256 string"
)
_KINDS = [pa.int32(), *[pa.int64()] * 10, pa.string()]
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
LOCAL, PARTIAL, IDS = 0, 1, 2


def rebuilt(rows: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): each conversation's shared head and what follows, as turn digests and UTF-8 bytes."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("numbered"),
            F.col("turn").alias("turn"),
            F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN).alias("digest"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("t"),
    ).where("conv_id is not null")
    own = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("own"))
    own = own.select("conv_id", F.transform("own", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("own"))
    heads = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("own", 1, 8).alias("head"))
    shared = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), shared), F.slice("own", F.lit(1), F.lit(0)))
    turns = F.concat(head, F.slice("own", shared + 1, F.greatest(F.size("own"), F.lit(1))))
    whole = both.select("conv_id", turns.alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return whole.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def splitters(paths: DataFrame, shards: int, count: int, total: int) -> list[tuple[bytes, int]]:
    """At most ``shards`` - 1 sampled (path, conv_id) in order; which rows are sampled depends on their ids alone."""
    share = min(1.0, SAMPLED * shards / max(count, 1), SAMPLE_BYTES / max(total, 1))
    taken = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = sorted((bytes(r["path"]), r["conv_id"]) for r in paths.where(taken & (F.octet_length("path") <= LONGEST)).select("path", "conv_id").collect())
    n = min(shards - 1, len(sample))
    while n > 0:
        chosen = [sample[(i + 1) * len(sample) // (n + 1)] for i in range(n)]
        if sum(len(p) for p, _ in chosen) <= SKELETON_BYTES:
            return sorted(set(chosen))
        n //= 2
    return []


def skeleton(borders: list[tuple[bytes, int]]) -> tuple[dict[tuple[int, bytes], int], list[int]]:
    """The trie of the splitters' paths: (parent, turn) to node, and each node's parent; node 0 is the root."""
    nodes: dict[tuple[int, bytes], int] = {}
    parents = [-1]
    for path, _ in borders:
        at = 0
        for i in range(0, len(path), TURN):
            key = at, path[i : i + TURN]
            if key not in nodes:
                nodes[key] = len(parents)
                parents.append(at)
            at = nodes[key]
    return nodes, parents


class _Node:
    __slots__ = ("ends", "first", "n_children", "n_convs", "n_leaves", "node", "pending", "piece", "saved", "seq", "size")

    def __init__(self, node: int, size: int):
        self.node, self.size = node, size  # place in the skeleton or -1, bytes of the last text
        self.first, self.n_convs, self.n_children, self.n_leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.piece, self.seq = None, [], 0
        self.pending: list[tuple] = []  # finished children that wait for this node's least member

    def take(self, first: int, n: int) -> None:
        self.first = first if self.first is None or first < self.first else self.first
        self.n_convs += n


class Walk:
    """One shard's sorted paths to rows of ``_SCHEMA``."""

    def __init__(self, nodes: dict[tuple[int, bytes], int]):
        self.nodes, self.stack, self.path, self.rows, self.any = nodes, [_Node(0, 0)], b"", [], False

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        last, k, most = self.path, 0, min(len(self.path), len(path))
        while k < most and last[k : k + TURN] == path[k : k + TURN]:
            k += TURN
        while (len(self.stack) - 1) * TURN > k:
            self.close()
        for i in range(k, len(path), TURN):
            above = self.stack[-1].node
            node = self.nodes.get((above, path[i : i + TURN]), -1) if above >= 0 else -1
            self.stack.append(_Node(node, sizes[i // TURN]))
        self.path, self.any = path, True
        end = self.stack[-1]
        end.take(conv, 1)
        if end.node < 0:
            if end.ends is None:
                end.ends = hashlib.sha256(b"%d" % conv)
            else:
                end.ends.update(b",%d" % conv)
        else:
            end.piece.append(str(conv))
            if len(end.piece) * 20 >= PIECE:
                self.hand_on(end)

    def hand_on(self, end: _Node) -> None:
        if end.piece:
            self.rows.append((IDS, end.node, None, None, None, None, None, None, None, None, end.seq, ",".join(end.piece)))
            end.piece, end.seq = [], end.seq + 1

    def close(self) -> None:
        x = self.stack.pop()
        depth = len(self.stack)
        if x.node >= 0:
            self.hand_on(x)
            if self.any:
                self.rows.append((PARTIAL, x.node, x.first, depth, None, x.n_convs, x.n_children, x.n_leaves, x.saved, x.size, None, None))
            return
        above = self.stack[-1]
        leaves = x.n_leaves if x.n_children else 1
        saved = x.saved + (x.n_convs - 1) * x.size
        above.take(x.first, x.n_convs)
        above.n_children += 1
        above.n_leaves += leaves
        above.saved += saved
        rest = (x.n_convs, x.n_children, leaves, saved, None, None, x.ends.hexdigest() if x.ends else EMPTY)
        self.rows += [(LOCAL, None, conv, d, x.first, *more) for conv, d, more in x.pending]
        if above.node < 0:
            above.pending.append((x.first, depth, rest))
        else:
            self.rows.append((LOCAL, above.node, x.first, depth, None, *rest))

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(_NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def trie(rows: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    paths = written(rebuilt(rows), "paths")
    stats = paths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("path") + 8), F.lit(0)).alias("total")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stats["total"] // SHARD_BYTES))
    borders = splitters(paths, shards, stats["n"], stats["total"])
    nodes, parents = skeleton(borders)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shard = pa.array([bisect.bisect_right(borders, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *batch.columns], ["shard", *batch.schema.names])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = Walk(nodes)
        for batch in batches:
            for conv, path, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes")), strict=True):
                at.add(conv, path, sizes)
                if len(at.rows) >= 20_000:
                    yield at.taken()
        while at.stack:
            at.close()
        yield at.taken()

    shares = mapped(paths, dealt, "shard int, conv_id long, path binary, sizes array<long>")
    sorted_ = shares.repartitionById(len(borders) + 1, F.col("shard")).sortWithinPartitions("path", "conv_id")
    found = written(mapped(sorted_, walk, _SCHEMA).withColumn("shard", F.spark_partition_id()), "trie")
    drop_written(paths)

    top = _top(found, parents)
    local = found.where(F.col("kind") == LOCAL)
    least = F.broadcast(top.select("node", F.col("conv_id").alias("least")))  # as many rows as the skeleton has nodes
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    below = local.join(least, "node", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "least"))
    return below.select(*names).unionByName(top.select(*names))


def _top(found: DataFrame, parents: list[int]) -> DataFrame:
    """The skeleton's nodes: partial aggregates reduced by node, then added up from the deepest to the root."""
    spark = found.sparkSession
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = found.where(F.col("kind") == PARTIAL).groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("bytes").alias("bytes"), *sums)
    reduced = {r["node"]: r.asDict() for r in parts.collect()}  # a row a node of the skeleton
    for node in range(len(parents) - 1, -1, -1):  # children have larger numbers than their parents
        x = reduced.get(node)
        if x is None:
            continue
        x["n_leaves"] = x["n_leaves"] if x["n_children"] else 1
        x["saved_tokens"] += (x["n_convs"] - 1) * x["bytes"]
        above = reduced.get(parents[node])
        if above is not None:
            for name in ("n_convs", "n_leaves", "saved_tokens"):
                above[name] += x[name]
            above["n_children"] += 1
            above["conv_id"] = x["conv_id"] if above["conv_id"] is None else min(above["conv_id"], x["conv_id"])
    for node, x in reduced.items():
        x["parent_conv_id"] = reduced[parents[node]]["conv_id"] if node else None
    names = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    table = pa.table([pa.array([x[c] for x in reduced.values()], pa.int64()) for c in names], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hashed = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for node, piece in zip(batch.column("node").to_pylist(), batch.column("ends_sha256").to_pylist(), strict=True):
                if node != at:
                    if at is not None:
                        done.append((at, hashed.hexdigest()))
                    at, hashed = node, hashlib.sha256(piece.encode())
                else:
                    hashed.update(f",{piece}".encode())
            yield _digests(done)
        yield _digests([] if at is None else [(at, hashed.hexdigest())])

    pieces = found.where(F.col("kind") == IDS).select("node", "shard", "seq", "ends_sha256")
    ends = mapped(pieces.repartition("node").sortWithinPartitions("node", "shard", "seq"), digests, "node long, ends_sha256 string")
    return spark.createDataFrame(table).join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))


def _digests(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["node", "ends_sha256"])


def trie_query(rows: DataFrame) -> DataFrame:
    return trie(rows)
