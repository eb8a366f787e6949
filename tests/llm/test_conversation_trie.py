"""The trie against all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

from larder.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, node int, path string, shard int, T string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def slow(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children[p]
        leaves[p] = sum(leaves[k] for k in kids) if kids else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in kids)
    return sorted(
        (members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p in members
    )


def got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)
    out = ct.trie_query(df)
    assert out.columns == NAMES
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def some(seed, n=300):
    r = random.Random(seed)
    rows = []
    for c in range(-5, n):
        if c % 35 == 10:
            continue  # absent, heads too
        for t in range(r.randrange(1, 7)):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]), r.choice(["", None, "hi", "Wie geht's, ünï?", "x" * r.randrange(3)])))
    rows.append((None, 0, "user", "nobody"))
    return list({(c, t): (c, t, role, text) for c, t, role, text in rows}.values())


def test_equals_all_prefixes(spark, monkeypatch):
    monkeypatch.setattr(ct, "PIECE", 60)
    rows = some(1)
    rows += [rows[3], rows[3]]  # repeated rows
    assert got(spark, rows) == slow(rows)


def test_copies_and_long_ones(spark, monkeypatch):
    """A third of all conversations are one, one first turn is everywhere, one conversation is long."""
    monkeypatch.setattr(ct, "PIECE", 100)
    rows = [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(3)]
    rows += [(c, 0, "user", "same 0") for c in range(1400, 1800)] + [(c, 1, "user", f"own {c % 50}") for c in range(1400, 1800)]
    rows += [(2001, t, "assistant", "l" * (t % 7)) for t in range(3000)] + [(2002, t, "assistant", "l" * (t % 7)) for t in range(2500)]
    assert got(spark, rows) == slow(rows)


def test_many_shards_and_bounds(spark, monkeypatch):
    rows = some(2)
    want = slow(rows)
    monkeypatch.setattr(ct, "SHARD_BYTES", 500)
    assert got(spark, rows) == want
    monkeypatch.setattr(ct, "SKELETON_BYTES", 40)  # fewer splitters
    assert got(spark, rows) == want
    monkeypatch.setattr(ct, "SAMPLED", 0)  # none
    assert got(spark, rows) == want


def test_empty_and_turnless(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "a", "b")]) == []
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    assert got(spark, [(c, 0, "user", "gone with an absent head")]) == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
