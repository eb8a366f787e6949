"""Removal of repeated byte strings across documents, by hash-compared suffix sorting.

A byte goes if a string of ``WINDOW`` bytes that covers it starts earlier as well (smaller
doc_id, or same document and earlier start); strings never cross documents.

1. Anchors.  Every window of a document has one anchor: the gram of ``GRAM`` bytes with the
   least hash in it.  Equal windows have equal anchors at equal offsets, and consecutive
   windows share theirs, so there are about 2 anchors for ``WINDOW - GRAM`` bytes.
2. Anchor hashes are dealt out and counted; those that occur once can't lie in a repeat.  Places
   of anchors that a sample of documents shows to be frequent are dealt out by document instead,
   so that no task gets all places of one anchor; which way they go changes no result.
3. Around the other anchors, the stretch of text that holds all windows of the anchor is dealt
   out by anchor hash.  There, the suffixes that start at equal anchors are put in order by a
   mergesort whose comparisons find the common extension by binary search over prefix
   polynomial hashes.  Neighbours' extensions part the order into runs that share what is
   right of a window's anchor; inside a run, the hash of what is left of it tells equal windows,
   of which the first stays.  Claimed windows are compared byte by byte, in groups of any size.
4. An anchor with over ``FREQUENT`` places would make a task too large.  Its stretches are cut
   where a second anchor of the windows (least under another hash) changes, and dealt out by
   both anchors; equal ones are reduced to the first in salted groups before they meet.
5. Intervals meet their documents again, which are cut and hashed.

Equal stretches inside one task are reduced to the first before they are dealt out, so a
passage that a third of all documents share costs each task one row.

Defined results: null or empty text has no bytes; texts shorter than ``WINDOW`` stay whole;
rows with equal doc_id share coordinates, so repeated rows get equal results and don't remove
each other; a null doc_id counts as the smallest; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from larder.llm.common import mapped, slices, written

WINDOW = 100
GRAM = 32
#: Places of one anchor that meet in one task; beyond it, stretches are dealt out by a second anchor too.
FREQUENT = 16_384
#: Least number of groups that the equal stretches of a frequent anchor are reduced in before they meet.
SALTS = 32
#: One document in so many tells frequent anchors ahead of the count.
SAMPLED = 1024
#: Bits of the set of anchors told ahead; anchors that share a bit share the way they are dealt out.
SLOTS = 1 << 24
#: Text of one task where stretches meet, at least as many tasks as the session's shuffle partitions.
TASK_BYTES = 64 << 20
#: Text of one round of numpy work.
_ROUND = 4 << 20
_SEGMENT = 1 << 18
_ROWS = 10_000
_MIN_ID = -(1 << 63)
#: Buckets of the table of documents; Spark allows no more by default.
MOST_BUCKETS = 100_000
#: Sets the hash of second anchors apart.
_SECOND = 0x632BE59BD9B4E019

_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15 | 1), _U(0xC2B2AE3D27D4EB4F | 1))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


_BYTE_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * _U(0x2545F4914F6CDD1D))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base = int(_BASES[which])
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        have = _POWERS[which] = (out[0], out[1])
    return have


class Prefix:
    """Prefix polynomial hashes of a byte buffer; any substring's hash in constant time.

    Sums start anew in every block, so that the powers needed are those of one block.
    """

    def __init__(self, data: np.ndarray, which: int = 0):
        n = len(data)
        self.block = min(_SEGMENT, max(1, n))
        power, self.inverse = _powers(_SEGMENT + WINDOW + GRAM, which)
        self.power = power
        self.sums = np.zeros((n // self.block + 1) * (self.block + 1), np.uint64)
        for k, at in enumerate(range(0, n, self.block)):
            piece = data[at : at + self.block]
            row = self.sums[k * (self.block + 1) + 1 :][: self.block]
            np.cumsum(_BYTE_VALUES[piece] * power[: len(piece)], out=row[: len(piece)])

    def hashes(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of substrings shorter than a block."""
        k = start // self.block
        low = start - k * self.block
        room = self.block - low
        first = np.minimum(length, room)
        at = start + k  # the row of block k begins k entries later
        out = (self.sums[at + first] - self.sums[at]) * self.inverse[low]
        rest = length - first
        if np.any(rest > 0):
            out = out + self.sums[np.where(rest > 0, (k + 1) * (self.block + 1) + rest, 0)] * self.power[np.minimum(first, len(self.power) - 1)]
        return out


def _grams_of(piece: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all substrings of one length in a piece of at most a block and a window."""
    power, inverse = _powers(_SEGMENT + WINDOW + GRAM, 0)
    sums = np.zeros(len(piece) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[piece] * power[: len(piece)], out=sums[1:])
    n = len(sums) - length
    return (sums[length:] - sums[:n]) * inverse[:n]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def span_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of many short substrings (up to two windows), with prefix sums of a segment at a time."""
    out = np.zeros(len(start), np.uint64)
    for k, i in _by_part(start // _SEGMENT):
        at = k * _SEGMENT
        out[i] = Prefix(data[at : at + _SEGMENT + 2 * WINDOW]).hashes(start[i] - at, length[i])
    return out


def anchors(data: np.ndarray, lengths: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor place, first and last window start of it, and gram hash, for concatenated documents."""
    width = WINDOW - GRAM + 1
    flags = np.tile(np.array([True, False]), len(lengths))
    parts = np.empty(2 * len(lengths), np.int64)
    parts[0::2] = np.maximum(0, lengths - WINDOW + 1)
    parts[1::2] = lengths - parts[0::2]
    valid = np.repeat(flags, parts)
    none = _U(0xFFFFFFFF)
    place, first, last, gram = [], [], [], []
    for at in range(0, max(0, len(data) - WINDOW + 1), _SEGMENT):
        piece = data[at : at + _SEGMENT + WINDOW - 1]
        hashed = _mixed(_grams_of(piece, GRAM) ^ _U(salt))
        tagged = (hashed & _U(0xFFFFFFFF00000000)) | np.arange(len(hashed), dtype=np.uint64)
        chosen = _least(tagged, width) & none
        chosen[~valid[at : at + len(chosen)]] = none
        run = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]]) if len(chosen) else np.zeros(0, np.int64)
        end = np.r_[run[1:], len(chosen)] - 1
        real = chosen[run] != none
        run, end = run[real], end[real]
        p = chosen[run].astype(np.int64)
        place.append(p + at)
        first.append(run + at)
        last.append(end + at)
        gram.append(hashed[p])
    if not place:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    p, a, b, h = (np.concatenate(v) for v in (place, first, last, gram))
    if len(p) > 1:  # runs that a segment border has cut
        new = np.r_[True, (p[1:] != p[:-1]) | (a[1:] != b[:-1] + 1)]
        b = b[np.r_[np.flatnonzero(new)[1:] - 1, len(p) - 1]]
        p, a, h = p[new], a[new], h[new]
    return p, a, b, h


def _pack(*columns: np.ndarray | bytes) -> bytes:
    raw = [c if isinstance(c, bytes) else np.ascontiguousarray(c).tobytes() for c in columns]
    head = np.array([len(r) for r in raw], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(raw))


def _unpack(blob: bytes, *types) -> list:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(types))
    out, at = [], 8 * len(types)
    for t, n in zip(types, sizes.tolist(), strict=True):
        out.append(raw[at : at + n] if t is bytes else np.frombuffer(raw, t, n // np.dtype(t).itemsize, at))
        at += n
    return out


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they are about to be dealt out."""
    press = zstandard.ZstdCompressor(level=6)
    for batch in batches:
        packed = pa.array([press.compress(t) for t in batch.column("text").to_pylist()], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", packed)


def _packed_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with a ``size`` column whose texts, unpacked, have about _ROUND bytes."""
    held = np.cumsum(batch.column("size").to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = held[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(held, before + _ROUND, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column as one buffer, and the length of each row."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8), np.fromiter(map(len, rows), np.int64, len(rows))


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]]) if len(part) else np.zeros(0, np.int64)
    for s, e in zip(cut, [*cut[1:], len(order)], strict=False):
        yield int(part[order[s]]), order[s:e]


def _anchor_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each anchor hash occurs in a batch."""
    for whole in batches:
        for batch in slices(whole, "text", _ROUND):
            h, n = np.unique(anchors(*_texts(batch.column("text")))[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])


def told_ahead(rows: DataFrame, frequent: int) -> np.ndarray:
    """Words of ``SLOTS`` bits: those of the anchors with over ``frequent`` places, by a sample of (ord, th).

    The set has a fixed size (2 MB), however many anchors are in it.
    """
    sample = rows.where(F.pmod(F.xxhash64("th", "ord"), F.lit(SAMPLED)) == 0).select("text")
    often = mapped(sample, _anchor_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") * SAMPLED > frequent)
    slot = F.col("h").bitwiseAND(F.lit(SLOTS - 1))
    bit = F.expr(f"shiftleft(1L, cast(h & {SLOTS - 1} & 63 as int))")
    words = np.zeros(SLOTS // 64, np.int64)
    for word, bits in often.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit)).collect():
        words[word] = bits
    return words.view(np.uint64)


def _told(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & _U(SLOTS - 1)
    return (words[(slot >> _U(6)).astype(np.int64)] >> (slot & _U(63))) & _U(1) == 1


def _count_rows(parts: int, frequent: int, ahead: np.ndarray):
    """Step 1: anchors of a batch, equal hashes counted, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", _ROUND):
                data, lengths = _texts(batch.column(2))
                starts = np.cumsum(lengths) - lengths
                p, _, _, h = anchors(data, lengths)
                doc = np.searchsorted(starts, p, side="right") - 1
                order = np.argsort(h, kind="stable")
                h, doc, at = h[order], doc[order], (p - starts[doc])[order]
                ids, ths = (batch.column(c).to_numpy(zero_copy_only=False)[doc] for c in (0, 1))
                new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
                own = np.diff(np.r_[new, len(h)])
                n = np.ones(len(h), np.uint32)
                # many places in this batch alone: one row speaks for the hash, the others are known to be frequent
                known = _told(ahead, h[new])
                many = np.repeat((own > frequent) | known, own)
                n[many] = 0
                speaks = (own > frequent) & ~known
                speak = new[speaks]
                key = np.where(many, _mixed(ids.astype(np.uint64) ^ ths.astype(np.uint64) ^ _U(0x5851F42D4C957F2D)), h)
                h2 = np.r_[h, h[speak]]
                key = np.r_[key, h[speak]]
                ids = np.r_[ids, np.full(len(speak), _MIN_ID)]
                ths = np.r_[ths, np.zeros(len(speak), np.int64)]
                at = np.r_[at, np.full(len(speak), -1)]
                n = np.r_[n, own[speaks].astype(np.uint32)]
                out = [(part, _pack(h2[i], ids[i].astype(np.int64), ths[i].astype(np.int64), at[i].astype(np.int32), n[i])) for part, i in _by_part((key % _U(parts)).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int32()), pa.array([y for _, y in out], pa.binary())], ["part", "blob"])

    return run


def _repeated_anchors(frequent: int):
    """Step 2: places whose anchor hash occurs more than once; bit 0 of ``place`` marks frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_unpack(blob, np.uint64, np.int64, np.int64, np.int32, np.uint32) for b in batches for blob in b.column(1).to_pylist()]
        if not held:
            return
        h, ids, ths, at, n = (np.concatenate(v) for v in zip(*held, strict=True))
        del held
        told = n == 0
        out_ids, out_ths, out_at = [ids[told]], [ths[told]], [at[told].astype(np.int64) * 2 + 1]
        h, ids, ths, at, n = h[~told], ids[~told], ths[~told], at[~told], n[~told]
        order = np.argsort(h, kind="stable")
        new = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]]) if len(h) else np.zeros(0, np.int64)
        total = np.add.reduceat(n[order].astype(np.int64), new) if len(h) else np.zeros(0, np.int64)
        total = np.repeat(total, np.diff(np.r_[new, len(h)]))
        keep = (total > 1) & (at[order] >= 0)
        out_ids.append(ids[order][keep])
        out_ths.append(ths[order][keep])
        out_at.append(at[order][keep].astype(np.int64) * 2 + (total[keep] > frequent))
        cols = [np.concatenate(c) for c in (out_ids, out_ths, out_at)]
        for s in range(0, len(cols[0]), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(c[s : s + (1 << 18)]) for c in cols], ["ord", "th", "place"])

    return run


def _merged(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals by key (an index); touching ones join."""
    if not len(key):
        return key, start, end
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    shift = key * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.flatnonzero(np.r_[True, start[1:] + shift[1:] > reach[:-1]])
    stop = reach[np.r_[new[1:] - 1, len(key) - 1]] - shift[new]
    return key[new], start[new], stop


def equal_to_earlier(data, a, b, p, h, ids, at) -> np.ndarray:
    """Which stretches (window starts a to b around the anchor p) equal one of smaller (id, at), byte by byte."""
    gone = np.zeros(len(a), bool)
    if len(a) < 2:
        return gone
    length = b + WINDOW - a
    key = _mixed(span_hashes(data, a, length) ^ (length.astype(np.uint64) << _U(40)) ^ (p - a).astype(np.uint64)) ^ h
    order = np.lexsort((at, ids, key))
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    later = np.flatnonzero(~new)
    x, y = order[later], order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))[later]]
    # what isn't earlier is a repeated row: it counts like a first place
    fits = (length[x] == length[y]) & (p[x] - a[x] == p[y] - a[y]) & ((ids[y] < ids[x]) | ((ids[y] == ids[x]) & (at[y] < at[x])))
    x, y = x[fits], y[fits]
    for i in range(0, len(x), 1 << 12):
        u, v = x[i : i + (1 << 12)], y[i : i + (1 << 12)]
        step = np.minimum(np.arange(2 * WINDOW - GRAM)[None, :], (length[u] - 1)[:, None])
        gone[u] = (data[a[u][:, None] + step] == data[a[v][:, None] + step]).all(axis=1)
    return gone


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["part", "kind", "blob"])


def _covers(parts: int, ids, ths, u, v) -> list[tuple]:
    """Rows of kind 0: intervals known to go, dealt out by document."""
    return [(part, 0, _pack(ids[i].astype(np.int64), ths[i].astype(np.int64), u[i], v[i])) for part, i in _by_part((_mixed(ids.astype(np.uint64)) % _U(parts)).astype(np.int64))]


def _dealt(parts: int, kind: int, salt: int, data, a, b, p, h, ids, ths, at) -> list[tuple]:
    """Rows of stretches, dealt out by key (and salt)."""
    rows = []
    for part, x in _by_part((_mixed(h + _U(salt)) % _U(parts)).astype(np.int64)):
        text = b"".join([data[u:v].tobytes() for u, v in zip(a[x].tolist(), (b[x] + WINDOW).tolist(), strict=True)])
        rows.append((part, kind, _pack(h[x], ids[x].astype(np.int64), ths[x].astype(np.int64), at[x].astype(np.int64), (p[x] - a[x]).astype(np.uint8), (b[x] + WINDOW - a[x]).astype(np.uint8), text)))
    return rows


_TYPES = {0: (np.int64,) * 4, 1: (np.uint64, np.int64, np.int64, np.int64, np.uint8, np.uint8, bytes)}


def _stretches(parts: int, hot: bool):
    """Step 3 (hot: 4): stretches around repeated anchors; those known to repeat in this batch are covered at once."""
    salts = max(SALTS, math.isqrt(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = 7 * TaskContext.get().partitionId()
        for whole in batches:
            for batch in _packed_slices(whole):
                salt += 1
                yield one(batch, salt % salts + 1 if hot else 0)

    def one(batch: pa.RecordBatch, salt: int) -> pa.RecordBatch:
        open_ = zstandard.ZstdDecompressor()
        texts = [open_.decompress(x) for x in batch.column("text").to_pylist()]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"".join(texts), np.uint8)
        del texts
        starts = np.cumsum(lengths) - lengths
        p, a, b, h = anchors(data, lengths)
        asked = batch.column("places")
        of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
        asked = asked.flatten().to_numpy(zero_copy_only=False)
        known = np.unique((starts[of] + (asked >> 1)) * 2 + (asked & 1))
        mark = np.zeros(len(data) + 1, np.uint8)
        mark[known >> 1] = 1 + (known & 1)
        s = np.flatnonzero(mark[p] == (2 if hot else 1))
        p, a, b, h = p[s], a[s], b[s], h[s]
        if hot and len(p):
            p2, a2, b2, h2 = anchors(data, lengths, _SECOND)
            low, high = np.searchsorted(b2, a), np.searchsorted(a2, b, side="right")
            many = high - low
            i = np.repeat(np.arange(len(p)), many)
            j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - low, many)
            a, b, h = np.maximum(a[i], a2[j]), np.minimum(b[i], b2[j]), _mixed(h[i] ^ _mixed(h2[j] + (p2[j] - p[i]).astype(np.uint64)))
            p = p[i]
        doc = np.searchsorted(starts, p, side="right") - 1
        ids = batch.column(0).to_numpy(zero_copy_only=False)[doc]
        ths = batch.column(1).to_numpy(zero_copy_only=False)[doc]
        at = a - starts[doc]
        gone = equal_to_earlier(data, a, b, p, h, ids, at)
        d, u, v = _merged(doc[gone], a[gone], b[gone] + WINDOW)
        ids_, ths_ = (batch.column(c).to_numpy(zero_copy_only=False)[d] for c in (0, 1))
        rows = _covers(parts, ids_, ths_, u - starts[d], v - starts[d])
        k = ~gone
        return _batch(rows + _dealt(parts, 1, salt, data, a[k], b[k], p[k], h[k], ids[k], ths[k], at[k]))

    return run


def _held(batches: Iterator[pa.RecordBatch]) -> tuple[list, tuple | None]:
    """The intervals of a partition, and its stretches: h, ids, ths, at, rel, length, offset in text, text."""
    held: dict[int, list] = {0: [], 1: []}
    for batch in batches:
        for kind, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            held[kind].append(_unpack(blob, *_TYPES[kind]))
    if not held[1]:
        return held[0], None
    cols = list(zip(*held.pop(1), strict=True))
    text = b"".join(cols.pop())
    h, ids, ths, at, rel, length = (np.concatenate(c) for c in cols)
    length = length.astype(np.int64)
    return held[0], (h, ids, ths, at, rel.astype(np.int64), length, np.cumsum(length) - length, text)


def _thinned(parts: int):
    """Step 4, in a salted group: of equal stretches only the first goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = _held(batches)
        rows = [row for x in known for row in _covers(parts, *x)]
        if found is not None:
            h, ids, ths, at, rel, length, offset, text = found
            data = np.frombuffer(text, np.uint8)
            a, b, p = offset, offset + length - WINDOW, offset + rel
            gone = equal_to_earlier(data, a, b, p, h, ids, at)
            rows += _covers(parts, ids[gone], ths[gone], at[gone], (at + length)[gone])
            k = ~gone
            rows += _dealt(parts, 1, 0, data, a[k], b[k], p[k], h[k], ids[k], ths[k], at[k])
        if rows:
            yield _batch(rows)

    return run


def common_extension(prefix: Prefix, x: np.ndarray, y: np.ndarray, most: np.ndarray, left: bool = False) -> np.ndarray:
    """Length of the common extension of places x and y, up to ``most``, by binary search over hashes."""
    low, high = np.zeros(len(x), np.int64), most.astype(np.int64).copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) // 2
        u, v = (x - mid, y - mid) if left else (x, y)
        same = prefix.hashes(u, mid) == prefix.hashes(v, mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)


def _precedes(prefix: Prefix, data: np.ndarray, x: np.ndarray, y: np.ndarray, end_x: np.ndarray, end_y: np.ndarray) -> np.ndarray:
    """Whether suffix x (up to end_x) sorts before suffix y; a prefix sorts first, equals don't precede."""
    most = np.minimum(end_x - x, end_y - y)
    n = common_extension(prefix, x, y, most)
    inside = n < most
    cx = data[np.minimum(x + n, len(data) - 1)]
    cy = data[np.minimum(y + n, len(data) - 1)]
    return np.where(inside, cx < cy, end_x - x < end_y - y)


def suffix_sort(prefix: Prefix, data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order of the suffixes inside each group (a run of ``size`` from ``first``): bottom-up mergesort.

    All merges of one level are done at once: an element's place in the merged run is its own
    place plus the number of the sibling run's elements before it, found by binary search.
    """
    order = np.arange(len(start))
    group = np.repeat(np.arange(len(first)), size)
    base, total = first[group], size[group]
    width = 1
    while len(size) and width < size.max():
        local = np.arange(len(start)) - base
        run = local // (2 * width) * (2 * width)
        right = (local - run) >= width
        sib_low = np.where(right, run, run + width)
        sib_high = np.minimum(np.where(right, run + width, run + 2 * width), total)
        live = np.flatnonzero(sib_low < sib_high)
        low, high = sib_low[live].copy(), sib_high[live].copy()
        mine = order[live]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            other = order[base[live[open_]] + mid]
            x, y = mine[open_], other
            # stable: of equals, the left run's come first
            before = np.where(
                right[live[open_]],
                ~_precedes(prefix, data, start[x], start[y], end[x], end[y]),
                _precedes(prefix, data, start[y], start[x], end[y], end[x]),
            )
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        target = np.arange(len(start))
        shift = low - sib_low[live]
        target[live] = base[live] + run[live] + (local[live] - run[live] - np.where(right[live], width, 0)) + shift
        out = np.empty_like(order)
        out[target] = order
        order = out
        width *= 2
    return order


def shared_windows(h, ids, at, rel, length, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For stretches around equal anchors: row, first and last offset of windows that start earlier elsewhere.

    An offset is the distance from a window's start to the anchor.
    """
    data = np.frombuffer(text, np.uint8)
    offset = np.cumsum(length) - length
    by = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.r_[True, h[by][1:] != h[by][:-1]]) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(h)])
    by, size = by[np.repeat(size > 1, size)], size[size > 1]
    first = np.cumsum(size) - size
    n = len(by)
    if not n:
        return by, by, by
    prefix = Prefix(data)
    order = suffix_sort(prefix, data, (offset + rel)[by], (offset + length)[by], first, size)
    row = by[order]
    place, end, left_room, ids, when = (offset + rel)[row], (offset + length)[row], rel[row], ids[row], (at + rel)[row]
    stop = np.repeat(first + size, size)
    # common extension with the next of the group, and the longest with anyone
    lcp = np.zeros(n, np.int64)
    i = np.flatnonzero(np.arange(n) + 1 < stop)
    lcp[i] = common_extension(prefix, place[i], place[i + 1], np.minimum(end[i] - place[i], end[i + 1] - place[i + 1]))
    reach = np.maximum(lcp, np.r_[0, lcp[:-1]])
    # dense rank of the windows in time: equal for repeated rows
    turn = np.lexsort((when, ids))
    rank = np.empty(n, np.int64)
    rank[turn] = np.cumsum(np.r_[0, (ids[turn][1:] != ids[turn][:-1]) | (when[turn][1:] != when[turn][:-1])])
    low, high = np.full(n, 1 << 30), np.full(n, -1)
    low_with, high_with = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for off in range(int(left_room.max()) + 1):
        some = np.flatnonzero((reach >= WINDOW - off) & (left_room >= off))
        if len(some) < 2:
            continue
        run = np.cumsum(np.r_[0, lcp[:-1] < WINDOW - off])[some]
        key = _mixed(prefix.hashes(place[some] - off, off) ^ _mixed(run.astype(np.uint64)))
        turn = np.lexsort((rank[some], key))
        some, key = some[turn], key[turn]
        head = some[np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(some)), 0))]
        late = rank[some] > rank[head]
        x, y = some[late], head[late]
        new = high[x] < 0
        low[x[new]], low_with[x[new]] = off, y[new]
        high[x], high_with[x] = off, y
    got = np.flatnonzero(high >= 0)
    step = np.arange(WINDOW)
    bad = np.zeros(len(got), bool)
    for s in range(0, len(got), 1 << 12):
        g = got[s : s + (1 << 12)]
        for off, other in ((low[g], low_with[g]), (high[g], high_with[g])):
            u, v = place[g] - off, place[other] - off
            bad[s : s + (1 << 12)] |= (data[u[:, None] + step] != data[np.minimum(v[:, None] + step, len(data) - 1)]).any(axis=1)
    if bad.any():  # a hash collision: these rows are compared byte by byte with their whole group
        for g in got[bad]:
            f = int(np.searchsorted(first, g, side="right") - 1)
            low[g], high[g] = 1 << 30, -1
            for y in range(first[f], first[f] + size[f]):
                if rank[y] < rank[g]:
                    for off in range(int(min(left_room[g], left_room[y])) + 1):
                        u, v = place[g] - off, place[y] - off
                        if u + WINDOW <= end[g] and v + WINDOW <= end[y] and (data[u : u + WINDOW] == data[v : v + WINDOW]).all():
                            low[g], high[g] = min(low[g], off), max(high[g], off)
        got = got[high[got] >= 0]
    return row[got], low[got], high[got]


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3 where equal anchors meet: intervals to remove."""
    known, found = _held(batches)
    out = [tuple(x) for x in known]
    if found is not None:
        h, ids, ths, at, rel, length, offset, text = found
        order = np.argsort(h, kind="stable")
        done = 0
        while done < len(order):  # whole groups, a bounded number of rows a round unless one group is larger
            stop = min(len(order), done + _ROWS)
            while stop < len(order) and h[order[stop]] == h[order[stop - 1]]:
                stop += 1
            r = order[done:stop]
            done = stop
            part = b"".join([text[o : o + n] for o, n in zip(offset[r].tolist(), length[r].tolist(), strict=True)])
            row, lo, hi = shared_windows(h[r], ids[r], at[r], rel[r], length[r], part)
            row = r[row]
            p = at[row] + rel[row]
            out.append((ids[row], ths[row], p - hi, p - lo + WINDOW))
        del found, text
    if not out:
        return
    ids, ths, u, v = (np.concatenate(c) for c in zip(*out, strict=True))
    _, key = np.unique(np.stack([ids, ths]), axis=1, return_inverse=True)
    key = key.reshape(-1)
    rep = np.zeros(int(key.max()) + 1 if len(key) else 0, np.int64)
    rep[key] = np.arange(len(key))
    k, u, v = _merged(key, u, v)
    for s in range(0, len(k), 1 << 17):
        e = s + (1 << 17)
        cols = [ids[rep[k[s:e]]], ths[rep[k[s:e]]], u[s:e], v[s:e]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["ord", "th", "start", "end"])


def _cut(with_text: bool):
    """Step 5: remaining bytes of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            for packed, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "spans")), strict=True):
                text = open_.decompress(packed)
                merged: list[list[int]] = []
                for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                kept, at = [], 0
                for s, e in merged:
                    kept.append(text[at:s])
                    at = e
                kept.append(text[at:])
                rest = b"".join(kept)
                out.append((len(text), len(text) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore") if with_text else None))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *arrays], ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            )

    return run


def cut(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int | None = None, with_text: bool = True
) -> tuple[DataFrame, str]:
    """Every row of ``docs`` without its repeats, and the name of the table that the result reads.

    Columns: row (own: all columns but the text, absent: whether the text is null), n_bytes, n_removed, n_spans, kept_sha256, and
    kept, the remaining text without what is left of split characters (null unless ``with_text``).
    """
    spark = docs.sparkSession
    frequent = frequent or FREQUENT
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    size = F.octet_length(text).cast("long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (docs.agg(F.sum(size)).first()[0] or 0) // TASK_BYTES)
    own = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(F.struct(*own).alias("own"), F.col(f"`{text_col}`").isNull().alias("absent")).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_MIN_ID)).alias("ord"),
        F.xxhash64(text).alias("th"),
        size.alias("size"),
        text.cast("binary").alias("text"),
    )
    long_enough = rows.where(F.col("size") >= WINDOW).select("ord", "th", "text")
    counted = mapped(long_enough, _count_rows(parts, frequent, told_ahead(long_enough, frequent)), "part int, blob binary")
    places = mapped(counted.repartitionById(parts, "part"), _repeated_anchors(frequent), "ord long, th long, place long")
    # rows of one id may differ in text: places are those of an id and a text
    asked = places.groupBy("ord", "th").agg(F.collect_set("place").alias("places"))
    # bucketed by id and text: the intervals join the documents without another shuffle of texts
    name = f"larder_repeats_{uuid.uuid4().hex}"
    joined = mapped(rows, _pressed, rows.schema).join(asked.hint("shuffle_hash"), ["ord", "th"], "left")
    joined.write.format("parquet").bucketBy(min(parts, MOST_BUCKETS), "ord", "th").saveAsTable(name)
    found = spark.table(name)
    suspects = found.where(F.col("places").isNotNull()).select("ord", "th", "size", "text", "places")
    blobs = "part int, kind int, blob binary"
    hot = suspects.where(F.exists("places", lambda x: x.bitwiseAND(F.lit(1)) == 1))
    thinned = mapped(mapped(hot, _stretches(parts, hot=True), blobs).repartitionById(parts, "part"), _thinned(parts), blobs)
    dealt = mapped(suspects, _stretches(parts, hot=False), blobs).unionByName(thinned).repartitionById(parts, "part")
    spans = mapped(dealt, _covered, "ord long, th long, start long, end long")
    spans = spans.groupBy("ord", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    whole = found.select("ord", "row", "th", "text").join(spans.hint("shuffle_hash"), ["ord", "th"], "left").drop("ord", "th")
    counts = [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    texts = [StructField(n, StringType()) for n in ("kept_sha256", "kept")]
    return mapped(whole, _cut(with_text), StructType([rows.schema["row"], *counts, *texts])), name


#: Tables of the warehouse that results of this session read.
_LEFT: list[str] = []


def drop_tables(spark: SparkSession) -> None:
    """Drop the tables that results of :func:`without_repeats` read; these have to be written before."""
    while _LEFT:
        spark.sql(f"DROP TABLE IF EXISTS {_LEFT.pop()}")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeats cut out of the texts (a null text stays null).

    The result reads a table of the warehouse whose name starts with ``larder_repeats_``; :func:`drop_tables` drops it once
    the result is written.
    """
    out, name = cut(docs, id_col, text_col)
    _LEFT.append(name)
    text = F.when(~F.col("row.absent"), F.col("kept")).alias(text_col)
    return out.select(*[text if c == text_col else F.col("row.own").getField(c).alias(c) for c in docs.columns])


def suffix_dedup_query(docs: DataFrame) -> DataFrame:
    """The contract's columns: bytes, removed bytes and runs, and the digest of what remains."""
    out, name = cut(docs.select("doc_id", "text"), with_text=False)
    out = written(out.select("row.own.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), "removals")
    docs.sparkSession.sql(f"DROP TABLE {name}")
    return out
