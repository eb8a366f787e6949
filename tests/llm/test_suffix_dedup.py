import hashlib
import random

import pytest
from pyspark.sql import functions as F

from larder.llm import suffix_dedup as sd


def slow(rows):
    """Every window in order of (doc_id, start); a window seen at an earlier place covers its bytes."""
    first = {}
    texts = {}
    for i, t in rows:
        texts.setdefault((-(1 << 63) if i is None else i, t), (t or "").encode())
    for (i, _), b in texts.items():
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = {}
    for (i, t), b in texts.items():
        gone = [False] * len(b)
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] < (i, s):
                gone[s : s + 100] = [True] * 100
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i, t] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def make_rows(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (15, 20, 40, 90)]
    rows = [(0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "y" * 700), (6, "ab" * 400)]
    for i in range(7, 60):
        text = prose(r.randrange(1, 60))
        for _ in range(r.randrange(4)):
            text += r.choice(passages) + prose(r.randrange(1, 30))
        rows.append((i, text))
    for i in range(60, 80):
        base = rows[r.randrange(7, 60)][1]
        k = r.randrange(len(base) + 1)
        rows.append((i, r.choice([base, base[:k] + "Q" + base[k:], base[k:] + base[:k], base + base])))
    rows += [rows[30], (None, rows[31][1]), (200, rows[31][1] * 2)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("frequent,seed,sampled", [(16384, 1, 1024), (2, 2, 1024), (16384, 3, 1024), (5, 4, 1), (3, 5, 2)])
def test_against_brute_force(spark, monkeypatch, frequent, seed, sampled):
    monkeypatch.setattr(sd, "FREQUENT", frequent)
    monkeypatch.setattr(sd, "SAMPLED", sampled)
    monkeypatch.setattr(sd, "_ROUND", 4000)
    monkeypatch.setattr(sd, "_ROWS", 50)
    monkeypatch.setattr(sd, "_SEGMENT", 700 + seed)
    rows = make_rows(seed)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ord int").repartition(5)
    got = sd.suffix_dedup_query(df).collect()
    want = slow(rows)
    assert len(got) == len(rows)
    mine = sorted((str(g.doc_id), g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got)
    theirs = sorted((str(i), *want[-(1 << 63) if i is None else i, t]) for i, t in rows)
    assert mine == theirs


@pytest.mark.parametrize("frequent", [16384, 2])
def test_rows_of_one_id_with_texts_of_different_length(spark, monkeypatch, frequent):
    monkeypatch.setattr(sd, "FREQUENT", frequent)
    r = random.Random(11)
    prose = lambda n: "".join(r.choice("abcde ") for _ in range(n))
    passage, other = prose(300), prose(150)
    rows = [(None, ""), (None, prose(5000) + passage + prose(60)), (None, "short " * 30), (None, passage[:120])]
    rows += [(7, prose(4000) + passage), (7, passage), (7, prose(90) + other), (7, "x"), (9, other + passage), (9, prose(20)), (10, other)]
    rows += [(7, rows[4][1])]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow(rows)
    # the order of rows inside a task decides whose bytes a place of another text points at
    for own in (df.coalesce(1), df.coalesce(1).orderBy(F.length("text")), df.coalesce(1).orderBy(F.length("text").desc()), df.repartition(4)):
        got = sd.suffix_dedup_query(own).collect()
        mine = sorted((str(g.doc_id), g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got)
        assert mine == sorted((str(i), *want[-(1 << 63) if i is None else i, t]) for i, t in rows)


def test_frequent_anchors_are_told_ahead(spark, monkeypatch):
    """With them, no task gets a place of each document that holds a shared passage."""
    monkeypatch.setattr(sd, "SAMPLED", 4)
    r = random.Random(3)
    prose = lambda n: "".join(r.choice("abcde ") for _ in range(n))
    passage = prose(200)
    docs = [(i, i * 0x9E3779B1, (prose(150) + passage).encode()) for i in range(400)]
    rows = spark.createDataFrame(docs, "ord long, th long, text binary")
    words = sd.told_ahead(rows, 200)
    _, _, _, h = sd.anchors(*sd._texts(rows.limit(1).toArrow().column("text").combine_chunks()))
    data = sd.np.frombuffer(passage.encode(), sd.np.uint8)
    _, _, _, inside = sd.anchors(data, sd.np.array([len(data)]))
    assert sd._told(words, inside[1:-1]).all() and not sd._told(words, h).all()
    batch = rows.toArrow().combine_chunks().to_batches()[0]

    def most(ahead):
        sizes = {}
        for out in sd._count_rows(64, 16384, ahead)(iter([batch])):
            for part, blob in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
                sizes[part] = sizes.get(part, 0) + len(sd._unpack(blob, sd._U, sd.np.int64, sd.np.int64, sd.np.int32, sd.np.uint32)[0])
        return max(sizes.values()), sum(sizes.values())

    (with_it, all_with), (without, all_without) = most(words), most(sd.np.zeros_like(words))
    assert all_with == all_without and without > 400 and with_it < 200


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sd.suffix_dedup_query(df).count() == 0


def test_suffix_sort_is_lexicographic():
    import numpy as np

    r = random.Random(9)
    data = np.frombuffer(bytes(r.choice(b"ab") for _ in range(900)), np.uint8)
    start = np.array([r.randrange(850) for _ in range(90)])
    end = start + np.array([r.randrange(1, 50) for _ in range(90)])
    first, size = np.array([0, 1, 34]), np.array([1, 33, 56])
    order = sd.suffix_sort(sd.Prefix(data), data, start, end, first, size)
    for f, n in zip(first, size, strict=True):
        got = [bytes(data[start[i] : end[i]]) for i in order[f : f + n]]
        assert got == sorted(bytes(data[start[i] : end[i]]) for i in range(f, f + n))


@pytest.mark.parametrize("n", [3, 60, 300])
def test_groups_of_any_size(n):
    import numpy as np

    r = random.Random(n)
    core = bytes(r.choice(b"abc") for _ in range(32))
    left, right = [bytes(r.choice(b"xy") for _ in range(80)) for _ in range(3)], [bytes(r.choice(b"xy") for _ in range(110)) for _ in range(3)]
    h, ids, at, rel, length, text = [], [], [], [], [], b""
    for i in range(n):
        b = r.randrange(30, 69)
        a = r.randrange(68 - b, 69)
        piece = r.choice(left)[-a:] * bool(a) + core + r.choice(right)[:b]
        h.append(i % 3 // 2)
        ids.append(r.randrange(20))
        at.append(i * 500)
        rel.append(a)
        length.append(len(piece))
        text += piece
    arrays = [np.array(h, np.uint64)] + [np.array(v, np.int64) for v in (ids, at, rel, length)]
    row, low, high = sd.shared_windows(*arrays, text)
    got = {int(x): (int(y), int(z)) for x, y, z in zip(row, low, high, strict=True)}
    start = np.cumsum(length) - length
    want = {}
    for i in range(n):
        shared = []
        for off in range(rel[i] + 1):
            s = start[i] + rel[i] - off
            if s + 100 > start[i] + length[i]:
                continue
            for j in range(n):
                u = start[j] + rel[j] - off
                if h[i] == h[j] and off <= rel[j] and u + 100 <= start[j] + length[j] and (ids[j], at[j] + rel[j]) < (ids[i], at[i] + rel[i]) and text[u : u + 100] == text[s : s + 100]:
                    shared.append(off)
        if shared:
            want[i] = (min(shared), max(shared))
    assert got == want and (want or n == 3)


def test_columns_of_any_name(spark):
    r = random.Random(2)
    passage = "".join(r.choice("abcde ") for _ in range(200))
    rows = [(1, "x " + passage, True, 5, "p"), (2, passage + " y", False, 6, "q"), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _null_text boolean, `a.b` int, row string")
    out = sd.without_repeats(df)
    assert out.columns == df.columns
    got = {g[0]: tuple(g) for g in out.collect()}
    assert got == {1: rows[0], 2: (2, " y", *rows[1][2:]), 3: rows[2]}
