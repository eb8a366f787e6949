"""Hard negatives by an R-tree over vectors, packed by sort-tile-recursive.

Vectors are dealt out in ranges of label and first tile coordinate; each file sorts its rows label by label,
tiles them by its coordinates of largest spread, and packs leaves and upper levels of minimum bounding
boxes.  A box gives an interval of every coordinate, so an interval of the inner product with an
anchor.  A best-first queue opens boxes by their upper end (at most the window's); boxes outside
the score window, of labels that can't count, or strictly below the k-th best are pruned, among equal ones those
whose least id is larger.  Rows of leaves are verified by exact integer products.

Results: rows with a null id, label or vector, or any null or non-finite component take no part.  Other rows are those of
another id; repeated rows count each, so they may fill several places.  Equal anchor rows are one anchor, different ones of
one id are anchors of their own.  Shorter vectors are padded with zeros.  Ties go to the smaller id.
An anchor without positives, or a positive without negatives in its window, gives no row, and so does an
empty table.  Labels may be any integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import vectors as vs
from larder.llm.common import drop_written, written

#: Rows of a leaf and children of a node.
LEAF, FAN = 128, 16


def _tiles(m: np.ndarray, rows: np.ndarray, coordinates: list[int]) -> np.ndarray:
    """Rows in tile order: slabs of the first coordinate, each tiled by the rest."""
    if len(rows) <= LEAF or not coordinates:
        return rows
    leaves = -(-len(rows) // LEAF)
    slabs = max(2, round(leaves ** (1 / len(coordinates))))
    size = -(-leaves // slabs) * LEAF
    rows = rows[np.argsort(m[rows, coordinates[0]], kind="stable")]
    return np.concatenate([_tiles(m, rows[a : a + size], coordinates[1:]) for a in range(0, len(rows), size)])


def build(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """A packed tree: rows in leaf order and the levels of boxes, leaves first."""
    order = np.lexsort((columns["id"], columns["label"]))
    m, label = columns["vector"][order], columns["label"][order]
    borders = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(m)]
    wide = np.argsort(-m.var(axis=0), kind="stable") if m.shape[1] else np.zeros(0, int)
    placed, cuts = [], [0]
    for a, b in zip(borders, borders[1:], strict=False):
        depth = max(1, int(np.log2(max(2, (b - a) / LEAF))))
        placed.append(_tiles(m, np.arange(a, b), wide[:depth].tolist()))
        if a - cuts[-1] >= LEAF // 2:
            cuts.append(a)  # labels of many rows have leaves of their own
        while b - cuts[-1] > LEAF:
            cuts.append(cuts[-1] + LEAF)
    at = np.concatenate(placed) if placed else np.zeros(0, int)
    m, label, ids = m[at], label[at], columns["id"][order][at]
    starts = np.array(cuts)
    out = {"id": ids, "label": label, "vector": vs.compact(m), "leaf": np.array([*cuts, len(m)]), "most": np.float64(0)}
    low, high = np.minimum.reduceat(m, starts, axis=0), np.maximum.reduceat(m, starts, axis=0)
    small, large, least = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts), np.minimum.reduceat(ids, starts)
    level = 0
    while True:
        out |= {f"low{level}": vs.compact(low), f"high{level}": vs.compact(high), f"small{level}": small, f"large{level}": large, f"least{level}": least}
        if len(low) == 1:
            return out
        level, by = level + 1, np.arange(0, len(low), FAN)
        low, high = np.minimum.reduceat(low, by, axis=0), np.maximum.reduceat(high, by, axis=0)
        small, large, least = np.minimum.reduceat(small, by), np.maximum.reduceat(large, by), np.minimum.reduceat(least, by)


class Tree:
    """A file in memory."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.id, self.label, self.leaf = arrays["id"], arrays["label"], arrays["leaf"].tolist()
        self.m = arrays["vector"].astype(np.float64)
        self.levels = sum(1 for k in arrays if k.startswith("least"))
        level = lambda name: [arrays[f"{name}{i}"] for i in range(self.levels)]
        self.low, self.high = ([x.astype(np.float64) for x in level(n)] for n in ("low", "high"))
        self.small, self.large, self.least = (level(n) for n in ("small", "large", "least"))


class Anchor:
    """Boxes and leaves of a tree as one anchor sees them; what was computed is kept for its other searches."""

    def __init__(self, tree: Tree, vector: np.ndarray, own: int):
        d = min(len(vector), tree.m.shape[1])
        self.tree, self.own = tree, own
        self.vector = np.zeros(tree.m.shape[1])
        self.vector[:d] = vector[:d]
        self.plus, self.minus = np.maximum(self.vector, 0), np.minimum(self.vector, 0)
        #: Sums beyond 2**53 are not exact in doubles: their intervals are widened.
        wide = vs.widest(self.vector[None, :], tree.m)
        self.slack = 0.0 if wide < 2**53 else wide * 1e-12
        self._boxes: dict[tuple[int, int], list[tuple[float, float, int, int, int, int]]] = {}
        self._scores: dict[int, np.ndarray] = {}

    def boxes(self, level: int, first: int, last: int) -> list[tuple[float, float, int, int, int, int]]:
        """(lower, upper, small label, large label, least id, number) of boxes of a level."""
        if (level, first) not in self._boxes:
            t, s = self.tree, slice(first, last)
            low, high = t.low[level][s], t.high[level][s]
            lower = low @ self.plus + high @ self.minus - self.slack
            upper = high @ self.plus + low @ self.minus + self.slack
            of = (lower, upper, t.small[level][s], t.large[level][s], t.least[level][s])
            self._boxes[level, first] = list(zip(*(x.tolist() for x in of), range(first, min(last, len(t.low[level]))), strict=True))
        return self._boxes[level, first]

    def scores(self, leaf: int) -> np.ndarray:
        if leaf not in self._scores:
            s = slice(self.tree.leaf[leaf], self.tree.leaf[leaf + 1])
            self._scores[leaf] = vs.products(self.vector[None, :], self.tree.m[s])[0]
        return self._scores[leaf]

    def best(self, k: int, label: int, same: bool, low: int = -(1 << 62), high: int = 1 << 62) -> list[tuple[int, int]]:
        """The first k (score, id) of rows of the same or of other labels with a score in [low, high]."""
        t = self.tree
        best: list[tuple[int, int]] = []  # (score, -id), worst first
        top = t.levels - 1
        queue: list[tuple[float, int, int, int]] = []

        def offer(boxes) -> None:
            for lower, upper, small, large, least, number in boxes:
                if upper < low or lower > high or (not small <= label <= large if same else small == large == label):
                    continue
                reach = min(upper, high)
                if len(best) == k and (reach, -least) < best[0]:
                    continue
                heapq.heappush(queue, (-reach, least, level, number))

        level = top
        offer(self.boxes(top, 0, len(t.low[top])))
        while queue:
            reach, least, level, number = heapq.heappop(queue)
            if len(best) == k and -reach < best[0][0]:
                break
            if len(best) == k and (-reach, -least) < best[0]:
                continue
            if level:
                level -= 1
                offer(self.boxes(level, number * FAN, number * FAN + FAN))
                continue
            scores = self.scores(number)
            s = t.leaf[number]
            keep = (scores >= (max(low, best[0][0]) if len(best) == k else low)) & (scores <= high)
            at = np.flatnonzero(keep)
            at = at[((t.label[s + at] == label) == same) & (t.id[s + at] != self.own)]
            if len(at) > k:
                at = at[np.lexsort((t.id[s + at], -scores[at]))[:k]]
            for i in at.tolist():
                one = (int(scores[i]), -int(t.id[s + i]))
                if len(best) < k:
                    heapq.heappush(best, one)
                elif one > best[0]:
                    heapq.heapreplace(best, one)
        return [(score, -i) for score, i in best]


def mine(
    rows: DataFrame, is_anchor: Column, positives: int, negatives: int, label: Column, least_percent: int = 80, most_percent: int = 100,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, key, place, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a Column over ``id``; ``label`` one over the table's own columns.  An anchor's positives are its first
    ``positives`` rows of its label; negatives have other labels and scores between the two
    shares (in percent) of the positive's.
    """
    good = vs.usable(rows, vec_id, vector, label=label.cast("long")).where("label is not null")
    first = F.get("vector", F.lit(0))
    files = vs.write_files(good, [F.asc("label"), F.asc(first), F.asc("id")], build)
    anchors = vs.distinct_queries(good.where(is_anchor))

    def positive(block: dict[str, np.ndarray], tree: Tree) -> pa.RecordBatch:
        out: list[tuple] = []
        for i, v in enumerate(block["vector"].astype(np.float64)):
            one = Anchor(tree, v, int(block["id"][i]))
            out += [(int(block["id"][i]), str(block["key"][i]), p, s) for s, p in one.best(positives, int(block["label"][i]), True)]
        return _batch(out, ["anchor_id", "key", "positive_id", "positive_score"])

    def negative(block: dict[str, np.ndarray], tree: Tree) -> pa.RecordBatch:
        out: list[tuple] = []
        ends = np.cumsum(block["scores_n"]).tolist()
        for i, v in enumerate(block["vector"].astype(np.float64)):
            one = Anchor(tree, v, int(block["id"][i]))
            scores = block["scores"][ends[i] - int(block["scores_n"][i]) : ends[i]].tolist()
            for place, score in enumerate(scores, 1):
                low, high = -(-least_percent * score // 100), most_percent * score // 100
                if low <= high:
                    found = one.best(negatives, int(block["label"][i]), False, low, high)
                    out += [(int(block["id"][i]), str(block["key"][i]), place, n, s) for s, n in found]
        return _batch(out, ["anchor_id", "key", "place", "negative_id", "negative_score"])

    lists = [(files, "file"), (vs.write_blocks(anchors), "block")]
    found = vs.searched(lists[-1][0], files, Tree, positive, "anchor_id long, key string, positive_id long, positive_score long")
    chosen = written(
        vs.first_by(found, ["anchor_id", "key"], "positive_score", "positive_id", positives).withColumnRenamed("rank", "place"), "positives"
    )
    windows = chosen.groupBy(F.col("anchor_id").alias("id"), "key").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    asked = anchors.join(windows.select("id", "key", F.col("p.positive_score").alias("scores")), ["id", "key"])
    lists.append((vs.write_blocks(asked), "block"))
    hard = vs.searched(lists[-1][0], files, Tree, negative, "anchor_id long, key string, place long, negative_id long, negative_score long")
    ranked = vs.first_by(hard, ["anchor_id", "key", "place"], "negative_score", "negative_id", negatives)
    out = written(ranked.join(chosen, ["anchor_id", "key", "place"]), "hard-negatives")
    drop_written(chosen)
    vs.drop_files(lists)
    return out


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n == "key" else pa.int64() for n in names]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def hard_negatives_query(rows: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    out = mine(rows, F.col("id") % 100 == 0, 5, 5, label)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
