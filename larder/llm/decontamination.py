"""Benchmark decontamination by q-gram filtering in diagonal bands and banded alignment.

Texts and items are folded to lower case, and each run of other characters than letters and
digits to one space.  An occurrence of an item of m characters with at most e edits shares
m - q + 1 - e * q q-grams with it, all within e + 1 neighbouring diagonals.  Shared q-grams
are counted in bands of 2 * (e + 1) diagonals that overlap by half, so that some band holds
them all; bands that reach the bound are aligned (free start and end in the text, edits
counted within the band), and the document leaks the item if e edits suffice.  Items too
short for a positive bound at ``Q`` use the longest grams that give one, m // (e + 1).  One rule
holds at every length: an item leaks where it stands, inside words too.

The items are the stated query set: they are read in blocks of bounded size, and each block
meets all documents.  A long text goes through in pieces that overlap by more than the longest item.

Defined results: null or empty texts leak nothing; items without a letter or digit (null and
empty ones too) match nothing; repeated rows of documents repeat their
result; of repeated item ids each text is tried; empty tables give an empty result; other
columns are not read by ``leaks`` and stay as they are in ``clean``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from larder.llm.common import mapped, slices, whole_rows

Q = 8
#: Edits allowed, as a share of the item's folded characters.
EDIT_SHARE = 0.1
#: Characters of items that one pass over the documents looks for (a broadcast of a few times this size).
BLOCK_CHARS = 4_000_000
#: Text of one round of numpy work; a longer text goes through in pieces of this size.
_ROUND = 1 << 19
_CELLS = 1 << 18
_SLOTS = 20
_END = 1  # marks the end of a text; no item has it
_CUT = 2  # marks the end of a piece that its text goes beyond
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Folded character of every code point; a space where it is no letter or digit."""
    if not _FOLD:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalnum():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts with an end mark behind each, their row, and place in the row's text."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    raw = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _fold_table()[raw]
    ends = np.cumsum(sizes + 1) - 1
    out[ends] = _END
    low = out <= 32
    keep = ~((out == 32) & np.r_[True, low[:-1]])  # one space a run, none at a start
    at = np.flatnonzero(keep)
    at = at[~((out[at] == 32) & np.r_[out[at[1:]] == _END, False][: len(at)])]  # none before an end
    row = np.searchsorted(ends, at).astype(np.int32)
    return out[at], row, at - (ends - sizes)[row]


def folded_pieces(text: str, overlap: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(characters with an end mark, place in the text) of the pieces of one long text."""
    tail = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    gap = False  # has the text a separator since the tail's last character
    for s in range(0, len(text), size):
        part = text[s : s + size]
        c, _, p = folded([part])
        c, p = c[:-1], p[:-1]
        if not len(c):
            gap = True
            last = s + size >= len(text)
            if not last or not len(tail[0]):
                continue
        elif len(tail[0]) and (gap or p[0] > 0):
            tail = np.r_[tail[0], np.uint32(32)], np.r_[tail[1], s]
        if len(c):
            gap = int(p[-1]) < len(part) - 1
        chars, place = np.r_[tail[0], c], np.r_[tail[1], p + s]
        more = s + size < len(text)
        yield np.r_[chars, np.uint32(_CUT if more else _END)], np.r_[place, place[-1] + 1]
        tail = chars[-overlap:], place[-overlap:]


def _grams(chars: np.ndarray, q: int) -> np.ndarray:
    """q-grams packed in 64 bits, one byte a character (other scripts share bytes: more candidates, none lost)."""
    cls = np.where(chars < 128, chars, 128 + ((chars * np.uint32(0x9E3779B1)) >> np.uint32(25))).astype(np.uint64)
    n = max(0, len(cls) - q + 1)
    out = np.zeros(n, np.uint64)
    for i in range(q):
        out = (out << np.uint64(8)) | cls[i : i + n]
    return out


class Grams:
    """Index of the grams of one length: gram to (item, place)."""

    def __init__(self, q: int, which: list[int], chars: list[np.ndarray]):
        self.q = q
        grams = [_grams(chars[i], q) for i in which]
        every = np.concatenate(grams)
        item = np.repeat(np.array(which, np.int64), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.first = np.unique(every[order], return_index=True)
        self.count = np.diff(np.r_[self.first, len(every)])
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._hash(self.keys)] = True

    @staticmethod
    def _hash(grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (text place, item, item place) of equal grams."""
        grams = _grams(chars, self.q)
        at = np.flatnonzero(self.maybe[self._hash(grams)])
        where = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        same = self.keys[where] == grams[at]
        at, where = at[same], where[same]
        many = self.count[where]
        entry = np.repeat(self.first[where] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return np.repeat(at, many), self.item[entry], self.place[entry]


class Items:
    """A block of items with the indexes of their grams."""

    def __init__(self, ids: list, texts: list[str | None], q: int = Q, share: float = EDIT_SHARE):
        chars = [folded([t or ""])[0][:-1] for t in texts]
        #: Row of each item in ``ids``.
        self.rows = [i for i, c in enumerate(chars) if len(c)]
        self.ids = [ids[i] for i in self.rows]
        self.chars = [chars[i] for i in self.rows]
        self.length = np.array([len(c) for c in self.chars], np.int64)
        self.edits = (self.length * share).astype(np.int64)
        self.q = np.minimum(q, self.length // (self.edits + 1))
        self.bound = self.length - self.q + 1 - self.edits * self.q
        self.grams = [Grams(int(k), np.flatnonzero(self.q == k).tolist(), self.chars) for k in np.unique(self.q)]

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (text place, item, item place) of equal grams."""
        found = [g.hits(chars) for g in self.grams]
        return tuple(np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def candidate_bands(items: Items, chars: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, first diagonal) of bands that reach the item's q-gram bound."""
    x, item, y = items.hits(chars)
    if not len(x):
        return x, x, x
    width = items.edits[item] + 1
    lift = -(-int(items.length.max()) // width) + 1  # whole bands: they lie alike whatever other items there are
    band = (x - y) // width + lift
    x, item, width, lift = np.r_[x, x], np.r_[item, item], np.r_[width, width], np.r_[lift, lift]
    band = np.r_[band, band - 1]
    # a count by hashed band can only be too large
    mixed = ((item.astype(np.uint64) << np.uint64(40)) ^ (band + 1).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    slot = (mixed >> np.uint64(64 - _SLOTS)).astype(np.int64)
    enough = np.bincount(slot, minlength=1 << _SLOTS)[slot] >= items.bound[item]
    x, item, width, band, lift = x[enough], item[enough], width[enough], band[enough], lift[enough]
    if not len(x):
        return x, x, x
    order = np.lexsort((row[x], band, item))
    x, item, width, band, lift = x[order], item[order], width[order], band[order], lift[order]
    r = row[x]
    new = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (r[1:] != r[:-1])])
    full = np.diff(np.r_[new, len(x)]) >= items.bound[item[new]]
    new = new[full]
    return r[new], item[new], (band[new] - lift[new]) * width[new]


def align(items: Items, chars: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each item in its band of the text ``chars[low:high]``, with start and end there.

    The band's diagonals start at ``first``; of equal costs the latest start wins.
    """
    m, e = items.length[item], items.edits[item]
    width = int(2 * (e.max() + 1)) if len(e) else 1
    own = 2 * (e + 1)
    k = np.arange(width)
    pattern = np.zeros((len(item), int(m.max()) if len(m) else 0), np.uint32)
    for c, i in enumerate(item.tolist()):
        pattern[c, : m[c]] = items.chars[i]
    big = np.int64(1) << np.int64(60)
    one = np.int64(1) << np.int64(36)
    x = first[:, None] + k[None, :]  # text characters consumed before the next, on item row 0
    inside = (x >= low[:, None]) & (x <= high[:, None]) & (k[None, :] < own[:, None])
    # cost in high bits; below, how far before the text's end the match starts
    cost = np.where(inside, high[:, None] - x, big)
    best = np.full(len(item), big)
    end = np.zeros(len(item), np.int64)
    steps = k[None, :] * one
    for y in range(1, pattern.shape[1] + 1):
        at = x + y - 1
        real = (at >= low[:, None]) & (at < high[:, None])
        differs = chars[np.clip(at, 0, len(chars) - 1)] != pattern[:, y - 1 : y]
        step = np.where(real, cost + differs * one, big)
        drop = np.full_like(cost, big)
        drop[:, :-1] = cost[:, 1:] + one  # an item character that the text lacks
        now = np.minimum(step, drop)
        reach = (at + 1 >= low[:, None]) & (at + 1 <= high[:, None]) & (k[None, :] < own[:, None])
        now = np.where(reach, now, big)
        # text characters that the item lacks: along the row, one edit a step
        now = np.minimum.accumulate(np.where(now < big, now, big) - steps, axis=1) + steps
        cost = np.where(reach, np.minimum(now, big), big)
        done = np.flatnonzero(m == y)
        if len(done):
            j = cost[done].argmin(axis=1)
            best[done] = cost[done, j]
            end[done] = x[done, j] + y
    found = best < big
    return np.where(found, best >> np.int64(36), 1 << 30), np.where(found, high - (best & (one - 1)), 0), end


def _leaks_of(items: Items, chars: np.ndarray, row: np.ndarray, place: np.ndarray, out: dict) -> None:
    """Puts the best (edits, start, end) of each (row, item) of one round into ``out``."""
    r, item, band = candidate_bands(items, chars, row)
    from_ = np.searchsorted(row, r)
    to = np.searchsorted(row, r, side="right") - 1  # the end mark stays out
    order = np.argsort(items.length[item], kind="stable")
    at = 0
    while at < len(order):
        # as many alignments at once as fit in a bounded number of cells
        n = 1
        while at + n < len(order) and (n + 1) * 2 * (int(items.edits[item[order[at + n]]]) + 1) <= _CELLS:
            n += 1
        c = order[at : at + n]
        at += n
        edits, start, end = align(items, chars, from_[c], to[c], item[c], band[c])
        for i, d, s, e in zip(c.tolist(), edits.tolist(), start.tolist(), end.tolist(), strict=True):
            if d <= items.edits[item[i]]:
                key = (int(r[i]), int(item[i]))
                found = (d, int(place[s]) if s < len(place) else 0, int(place[max(s, e - 1)]) + 1)
                out[key] = min(out.get(key, found), found)


def leaks_in(items: Items, texts: list[str | None], size: int = _ROUND) -> list[tuple[int, int, int, int, int]]:
    """(row, item index, edits, start, end) of the best occurrence of each leaked item, by row and item."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    if items.chars and len(texts) == 1 and len(texts[0] or "") > size:
        overlap = int((items.length + items.edits).max()) + 2
        for chars, place in folded_pieces(texts[0], overlap, max(size, 2 * overlap)):
            _leaks_of(items, chars, np.zeros(len(chars), np.int32), place, out)
    elif items.chars:
        chars, row, place = folded([t or "" for t in texts])
        _leaks_of(items, chars, row, place, out)
    return [(*key, *value) for key, value in sorted(out.items())]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple]:
    """(item ids as an Arrow array, texts) of blocks with about BLOCK_CHARS characters, whatever the size of the benchmark."""
    asked = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    total = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_CHARS) or 1
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow()
        yield block.column("item_id").combine_chunks(), block.column("text").to_pylist()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    share: float = EDIT_SHARE,
) -> DataFrame:
    """(doc_id, item_id, edits, similarity, start, end): start and end are characters of the document's text."""
    kinds = {"doc_id": docs.schema[id_col].dataType, "item_id": benchmark.schema[item_id_col].dataType, "edits": LongType()}
    kinds |= {"similarity": DoubleType(), "start": LongType(), "end": LongType()}
    schema = StructType([StructField(n, t) for n, t in kinds.items()])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = [
        mapped(rows, _finder(docs.sparkSession.sparkContext.broadcast(block), share), schema)
        for block in _blocks(benchmark, item_id_col, item_text_col)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if len(parts) > 1:  # an item id with several texts can be found in several blocks
        best = F.min(F.struct("edits", "start", "end", "similarity"))
        out = out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.edits", "b.similarity", "b.start", "b.end")
    return out


def _finder(shared, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = shared.value
        items = Items(ids.to_pylist(), texts, share=share)
        for whole in batches:
            for batch in slices(whole, "text", _ROUND):
                best: dict[tuple, tuple] = {}
                for r, i, d, s, e in leaks_in(items, batch.column(1).to_pylist()):
                    value = (d, s, e, 1.0 - d / int(items.length[i]), items.rows[i])
                    best[r, items.ids[i]] = min(best.get((r, items.ids[i]), value), value)
                d, s, e, near, item = zip(*best.values(), strict=True) if best else [()] * 5
                cols = [batch.column(0).take(pa.array([k[0] for k in best], pa.int64())), ids.take(pa.array(item, pa.int64()))]
                cols += [pa.array(v, t) for v, t in ((d, pa.int64()), (near, pa.float64()), (s, pa.int64()), (e, pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "edits", "similarity", "start", "end"])

    return run


def decontamination_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text leaks no item, with all columns; decided row by row, nothing is shuffled."""
    rows = docs.select(whole_rows(docs).alias("row"))
    for block in _blocks(benchmark, item_id_col, item_text_col):
        rows = mapped(rows, _keeper(docs.sparkSession.sparkContext.broadcast(block), docs.columns.index(text_col)), rows.schema)
    return rows.select("row.*")


def _keeper(shared, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = shared.value
        items = Items(ids.to_pylist(), texts)
        for whole in batches:
            for batch in slices(whole, whole.column(0).field(column), _ROUND):
                bad = {f[0] for f in leaks_in(items, batch.column(0).field(column).to_pylist())}
                yield batch.take(pa.array([i for i in range(batch.num_rows) if i not in bad], pa.int64()))

    return run
