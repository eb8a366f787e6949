"""Top-k search and hard negatives against all products."""

import math
import random

import numpy as np
import pytest

from larder.llm import hard_negatives, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, key int, vector string"


def rows_of(seed=3, n=700, d=12, like=False):
    """Vectors with ties, repeats, zero and odd ones; ``like``: close to a few directions, of many lengths."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(24, d))
    out = []
    for i in range(n):
        v = (centres[i % 24] + r.normal(size=d) * 0.02) * r.choice([0.2, 1, 3]) if like else r.normal(size=d)
        out.append((i, [float(x) for x in v.astype(np.float32)], int(r.integers(0, 4)) if i % 9 else None))
    same = [0.5] * d
    out += [(i, same, 2 if i % 3 else 1) for i in range(n, n + 60)]  # ties
    out += [(n + 5, same, 2), (n + 5, same, 2), (100, out[100][1], out[100][2])]  # repeated rows
    out += [(50, [0.25] * d, 1), (n + 100, [0.0] * d, 1), (n + 200, [], 0), (n + 300, [1.0] * (d + 3), 3), (n + 301, [2.0], 3)]
    out += [(None, same, 1), (n + 400, None, 1), (n + 401, [1.0, None], 1), (n + 402, [math.nan] * d, 1), (n + 403, [math.inf] * d, 1), (1000 * n, None, None)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "z", 1, "w") for i, v, x in rows], SCHEMA)


def whole(rows):
    good = [(i, v, x) for i, v, x in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(256 * float(np.float32(c))) for c in v], x) for i, v, x in good]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def slow_topk(rows, k=5, each=50):
    good, out = whole(rows), []
    for q, v in {(i, tuple(v)) for i, v, _ in good if i % each == 0}:
        best = sorted((-dot(v, w), j) for j, w, _ in good if j != q)[:k]
        out += [(q, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


def slow_negatives(rows):
    good, out = [], []
    for i, v, x in whole(rows):
        if x is not None:
            good.append((i, v, (x + 1) % 10 if i % 7 == 0 else x))
    for a, v, x in {(i, tuple(v), x) for i, v, x in good if i % 100 == 0}:
        positives = sorted((-dot(v, w), j) for j, w, y in good if j != a and y == x)[:5]
        for s, p in positives:
            inside = sorted((-dot(v, w), j) for j, w, y in good if y != x and j != a and 80 * -s <= 100 * dot(v, w) <= 100 * -s)[:5]
            out += [(a, p, rank, j, -s, -t) for rank, (t, j) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("like", [False, True])
def test_topk_equals_all_products(spark, monkeypatch, like):
    monkeypatch.setattr(vectors, "FILE_VALUES", 3000)
    rows = rows_of(like=like)
    got = sorted(tuple(r) for r in topk.topk_query(frame(spark, rows)).collect())
    assert got == slow_topk(rows) and got


def test_coordinates_prune(monkeypatch):
    """Vectors close to few directions: coordinate pruning is chosen, leaves few rows and loses none."""
    good = whole(rows_of(like=True, n=3000))
    m = np.array([v for _, v, _ in good if len(v) == 12], float)
    ids = np.array([i for i, v, _ in good if len(v) == 12])
    arrays = topk.build({"vector": m, "id": ids})
    assert (arrays["worth"] < 1).any()
    file, left = topk.Buckets(arrays), []
    feasible = file.feasible
    monkeypatch.setattr(file, "feasible", lambda b, u, c: (left.append(len(x := feasible(b, u, c)) / (file.start[b + 1] - file.start[b])), x)[1])
    block = {"vector": m[::50], "id": ids[::50], "floor": np.full(len(m[::50]), vectors.NONE)}
    _, best = topk.search(block, file, 5)
    for v, i, scores, found in zip(m[::50], ids[::50], best.score, best.id, strict=True):
        want = sorted((-int(s), int(j)) for s, j in zip(m @ v, ids, strict=True) if j != i)[:5]
        assert [(-int(s), int(j)) for s, j in zip(scores, found, strict=True)] == want
    assert left and np.mean(left) < 0.6


@pytest.mark.parametrize("like", [False, True])
def test_negatives_equal_all_products(spark, monkeypatch, like):
    monkeypatch.setattr(vectors, "FILE_VALUES", 3000)
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    monkeypatch.setattr(hard_negatives, "FAN", 3)
    rows = rows_of(seed=4, like=like)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives_query(frame(spark, rows)).collect())
    assert got == slow_negatives(rows) and got


def test_boxes_are_pruned():
    r = np.random.default_rng(1)
    m = np.floor(256 * (r.normal(size=(40, 3))[np.arange(4000) % 40] + r.normal(size=(4000, 3)) * 0.05))
    tree = hard_negatives.Tree(hard_negatives.build({"vector": m, "id": np.arange(4000), "label": np.arange(4000) % 3}))
    one = hard_negatives.Anchor(tree, m[0], 0)
    score = one.best(1, 0, True)[0][0]
    found = one.best(5, 0, False, score * 8 // 10, score)
    want = sorted((-int(s), i) for i, s in enumerate(m @ m[0]) if i % 3 and score * 8 // 10 <= s <= score)[:5]
    assert sorted((-s, i) for s, i in found) == want
    assert len(one._scores) < len(tree.leaf) / 2  # leaves that were opened


def test_empty_and_large(spark):
    none = frame(spark, [])
    assert topk.topk_query(none).collect() == [] and hard_negatives.hard_negatives_query(none).collect() == []
    odd = frame(spark, [(0, None, 1), (None, [1.0], 1)])
    assert topk.topk_query(odd).collect() == [] and hard_negatives.hard_negatives_query(odd).collect() == []
    alone = frame(spark, [(0, [1.0], 1)])
    assert topk.topk_query(alone).collect() == []
    large = [(i * 50, [2.0**18 * (i + 1), 2.0**14, 1 / 256], i % 2) for i in range(6)]  # products beyond 2**53
    got = sorted(tuple(r) for r in topk.topk_query(frame(spark, large)).collect())
    assert got == slow_topk(large)
    assert sorted(tuple(r) for r in hard_negatives.hard_negatives_query(frame(spark, large)).collect()) == slow_negatives(large)


def test_exact_products():
    r = random.Random(2)
    a = np.array([[r.randrange(-(2**40), 2**40) for _ in range(3)] for _ in range(4)], float)
    b = np.array([[r.randrange(-(2**20), 2**20) for _ in range(3)] for _ in range(5)], float)
    assert vectors.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
    with pytest.raises(OverflowError):
        vectors.products(a * 2.0**20, b * 2.0**20)
