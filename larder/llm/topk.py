"""Exact top-k search by inner product in buckets of vectors of like length.

Each file holds vectors in falling order of length, cut into buckets.  A query has a threshold: its
k-th best score so far.  Divided by its own length and the bucket's greatest length it is the cosine
that a vector of the bucket has to reach (the local threshold).  Above 1 the bucket is left out.
Otherwise, from a bound on that each bucket sets itself, the vectors are those whose unit coordinates lie in the
feasible intervals of the query's largest coordinates (coordinate pruning), else those that are
long enough (length pruning).  All that are left are verified by exact integer products.

Results: vectors that are null or hold null or non-finite components, and rows without an id, take no
part.  Candidates of a query are the rows of other ids; repeated rows count each.  Equal query rows
are one query, different vectors of one id are queries of their own.  Shorter vectors are padded with zeros; an empty vector
and a zero vector score 0.  Ties go to the smaller id.  An empty table gives no rows.  A score beyond 64 bits is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import vectors as vs
from larder.llm.common import drop_written, written

#: Vectors of one bucket at most, and how short they may be against its longest.
BUCKET, SHORTEST = 2048, 0.9
#: Coordinates of a query that prune.
FOCUS = 3
#: Share of a bucket that coordinate pruning may leave for it to be chosen.
WORTH = 0.25
_SLACK = 1 + 1e-9


def _units(m: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return m / np.where(norms > 0, norms, 1.0)[:, None]


def _interval(q: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Where a coordinate of a unit vector can lie if its cosine with a unit vector of coordinate ``q`` is at least ``cosine`` > 0."""
    cosine = min(cosine, 1.0)
    wide = np.sqrt(np.maximum(1 - q * q, 0) * (1 - cosine * cosine))
    low = np.where(q <= -cosine, -1.0, q * cosine - wide) - 1e-7
    high = np.where(q >= cosine, 1.0, q * cosine + wide) + 1e-7
    return low, high


def _focus(unit: np.ndarray) -> np.ndarray:
    return np.argsort(-np.abs(unit), kind="stable")[:FOCUS]


def _worth_from(units: np.ndarray) -> float:
    """The least cosine (of tenths) from which coordinate pruning leaves few of a bucket, for directions of the bucket itself."""
    sample = units[:: max(1, len(units) // 16)]
    for cosine in np.arange(1, 10) / 10:
        left = 0
        for u in sample:
            f = _focus(u)
            low, high = _interval(u[f], cosine)
            left += int(((units[:, f] >= low) & (units[:, f] <= high)).all(axis=1).sum())
        if left <= WORTH * len(units) * len(sample):
            return float(cosine)
    return 2.0


def build(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """A file: vectors by falling length, bucket borders, the order of every coordinate in a bucket, and where it pays to use it."""
    m = columns["vector"]
    norms = np.sqrt((m * m).sum(axis=1))
    order = np.lexsort((columns["id"], -norms))
    m, norms = m[order], norms[order]
    starts, sorted_, worth = [], [], []
    at = 0
    while at < len(m):
        like = int(np.searchsorted(-norms, -norms[at] * SHORTEST, side="right"))
        end = min(at + BUCKET, max(like, min(at + 32, len(m))))
        units = _units(m[at:end], norms[at:end])
        starts.append(at)
        sorted_.append(np.argsort(units, axis=0, kind="stable").T.astype(np.int16).ravel())
        worth.append(_worth_from(units) if units.shape[1] else 2.0)
        at = end
    return {
        "id": columns["id"][order], "vector": vs.compact(m), "norm": norms, "start": np.array([*starts, len(m)]),
        "sorted": np.concatenate(sorted_) if sorted_ else np.zeros(0, np.int16), "worth": np.array(worth), "most": norms.max(initial=0.0),
    }


class Buckets:
    """A file in memory."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.id, self.norm, self.start, self.worth = arrays["id"], arrays["norm"], arrays["start"].tolist(), arrays["worth"]
        self.m = arrays["vector"].astype(np.float64)
        self.d = self.m.shape[1]
        self.sorted = arrays["sorted"]
        self._values: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, b: int, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket's rows by one unit coordinate, and the coordinates."""
        if (b, f) not in self._values:
            s, e = self.start[b], self.start[b + 1]
            rows = self.sorted[s * self.d + f * (e - s) : s * self.d + (f + 1) * (e - s)].astype(np.int64)
            norms = self.norm[s:e][rows]
            self._values[b, f] = rows, self.m[s:e, f][rows] / np.where(norms > 0, norms, 1.0)
        return self._values[b, f]

    def feasible(self, b: int, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Rows of the bucket (as offsets) whose focus coordinates all lie in their intervals."""
        focus = _focus(unit[: self.d])
        low, high = _interval(unit[focus], cosine)
        seen = np.zeros(self.start[b + 1] - self.start[b], np.int8)
        for f, lo, hi in zip(focus.tolist(), low.tolist(), high.tolist(), strict=True):
            rows, values = self.coordinate(b, f)
            seen[rows[np.searchsorted(values, lo, "left") : np.searchsorted(values, hi, "right")]] += 1
        return np.flatnonzero(seen == len(focus))


class Best:
    """The k best of each query so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.score = np.full((n, k), vs.NONE)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def threshold(self) -> np.ndarray:
        """A score below this can't be among the k best."""
        return np.maximum(self.score[:, -1], self.floor)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.threshold()[rows]
        rows, scores, ids = rows[keep], scores[keep], ids[keep]
        if not len(rows):
            return
        touched = np.unique(rows)
        rows = np.concatenate([np.repeat(touched, self.k), rows])
        scores = np.concatenate([self.score[touched].ravel(), scores])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((ids, -scores.astype(np.float64), rows)) if np.abs(scores[scores != vs.NONE]).max(initial=0) < 2**53 else np.array(sorted(range(len(rows)), key=lambda i: (rows[i], -int(scores[i]), ids[i])))
        rows, scores, ids = rows[order], scores[order], ids[order]
        first = np.searchsorted(rows, touched)
        rank = np.arange(len(rows)) - np.repeat(first, np.diff([*first, len(rows)]))
        chosen = rank < self.k
        self.score[rows[chosen], rank[chosen]] = scores[chosen]
        self.id[rows[chosen], rank[chosen]] = ids[chosen]


def search(block: dict[str, np.ndarray], file: Buckets, k: int) -> tuple[np.ndarray, Best]:
    """The k best rows of a file for each query of a block, as far as they reach the query's floor."""
    q = block["vector"].astype(np.float64)
    own = block["id"]
    norms = np.sqrt((q * q).sum(axis=1))
    units = _units(q, norms)
    if units.shape[1] < file.d:
        units = np.pad(units, ((0, 0), (0, file.d - units.shape[1])))
    best = Best(len(q), k, block["floor"])
    for b in range(len(file.start) - 1):
        s, e = file.start[b], file.start[b + 1]
        theta = best.threshold().astype(np.float64)
        reach = norms * file.norm[s] * _SLACK
        live = (theta <= reach) | (theta <= 0)
        if not live.any():
            continue
        local = np.where(theta > 0, theta / np.where(reach > 0, reach, 1.0), 0.0)
        by_coordinate = live & (local >= file.worth[b])
        by_length = np.flatnonzero(live & ~by_coordinate)
        if len(by_length):
            need = np.where(theta[by_length] > 0, theta[by_length] / np.maximum(norms[by_length] * _SLACK, 1e-300), 0.0).min()
            end = s + int(np.searchsorted(-file.norm[s:e], -need, side="right"))
            scores = vs.products(q[by_length], file.m[s:end])
            scores[own[by_length][:, None] == file.id[None, s:end]] = vs.NONE
            least = np.maximum(np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else vs.NONE, best.threshold()[by_length])
            at, col = np.nonzero((scores >= least[:, None]) & (scores != vs.NONE))
            best.add(by_length[at], scores[at, col], file.id[s + col])
        for i in np.flatnonzero(by_coordinate).tolist():
            rows = s + file.feasible(b, units[i], float(local[i]))
            rows = rows[file.id[rows] != own[i]]
            if len(rows):
                scores = vs.products(q[i : i + 1], file.m[rows])[0]
                best.add(np.full(len(rows), i), scores, file.id[rows])
    return own, best


def top_k(rows: DataFrame, is_query, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, key, rank, vec_id, score): the k rows of highest integer inner product for each row that ``is_query`` (a Column over ``id``) picks."""
    good = vs.usable(rows, vec_id, vector)
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    files = vs.write_files(good, [F.desc(length), F.asc("id")], build)
    queries = vs.distinct_queries(good.where(is_query))

    def work(block: dict[str, np.ndarray], file: Buckets) -> pa.RecordBatch:
        own, best = search(block, file, k)
        at, col = np.nonzero(best.score != vs.NONE)
        cols = [pa.array(own[at]), pa.array(block["key"][at].tolist(), pa.string()), pa.array(best.id[at, col]), pa.array(best.score[at, col])]
        return pa.RecordBatch.from_arrays(cols, ["query_id", "key", "vec_id", "score"])

    schema = "query_id long, key string, vec_id long, score long"
    # the longest vectors first: what they give is each query's floor everywhere else
    head = files.orderBy(F.desc("most"), "file").limit(1)
    rest = files.join(head.select("file"), "file", "left_anti")
    lists = [(files, "file"), (vs.write_blocks(queries.withColumn("floor", F.lit(vs.NONE))), "block")]
    first = written(vs.searched(lists[-1][0], head, Buckets, work, schema), "topk-head")
    kth = first.groupBy("query_id", "key").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    floors = kth.select(F.col("query_id").alias("id"), "key", F.when(F.col("n") >= k, F.col("least")).alias("least"))
    lowest = F.coalesce("least", F.lit(vs.NONE))
    lists.append((vs.write_blocks(queries.join(floors, ["id", "key"], "left").withColumn("floor", lowest).drop("least")), "block"))
    more = vs.searched(lists[-1][0], rest, Buckets, work, schema)
    out = written(vs.first_by(first.unionByName(more), ["query_id", "key"], "score", "vec_id", k), "topk")
    drop_written(first)
    vs.drop_files(lists)
    return out


def topk_query(rows: DataFrame) -> DataFrame:
    return top_k(rows, F.col("id") % 50 == 0, 5).select("query_id", "rank", "vec_id", "score")
