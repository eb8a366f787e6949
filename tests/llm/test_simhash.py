import random

import numpy as np
import xxhash

from larder.llm import simhash


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    label = {i: i for i, _ in fps}
    changed = True
    while changed:
        changed = False
        for i, a in fps:
            for j, b in fps:
                if (a ^ b).bit_count() <= 4 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return {i: (f"{fp:016x}", label[i]) for i, fp in fps}


def make_rows(seed=5):
    r = random.Random(seed)
    vocab = ["alpha", "Beta", "gámma", "delta", "eps", "zeta x", "eta", "theta"]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "a b c"), (6, "a b c d e")]
    base = [r.choice(vocab) + str(r.randrange(50)) for _ in range(400)]
    for i in range(7, 60):
        words = list(base)
        for _ in range(r.randrange(4)):
            words[r.randrange(len(words))] = "x" + str(r.randrange(9))
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(r.choice(vocab) for _ in range(r.randrange(1, 30)))) for i in range(60, 140)]
    return rows


def test_against_brute_force(spark):
    rows = make_rows()
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, fp string, component_id string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_query(df).collect()}
    assert got == slow_components(rows)


def test_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    rows = make_rows(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_query(df).collect()}
    assert got == slow_components(rows)


def test_bit_sliced_kernel():
    r = np.random.default_rng(1)
    fps = r.integers(0, 2**63, 700, dtype=np.uint64)
    fps[350:] = fps[:350] ^ (np.uint64(1) << r.integers(0, 63, 350).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 63, 350).astype(np.uint64))
    planes = simhash.bit_planes(fps)
    for k in (1, 63, 64, 350, 351):
        n = len(fps) - k
        bits = np.zeros((len(fps) + 63) // 64 * 64, np.uint8)
        bits[:n] = 1
        hit = set(simhash.lane_links(planes, k, np.packbits(bits, bitorder="little").view(np.uint64)).tolist())
        assert hit == {i for i in range(n) if int(fps[i] ^ fps[i + k]).bit_count() <= 4}


def test_every_near_pair_shares_a_bucket():
    for n in (10, 10**5, 10**8, 10**10):
        masks = simhash.block_masks(n)
        r = random.Random(n)
        for _ in range(200):
            a = r.getrandbits(64)
            b = a
            for bit in r.sample(range(64), 4):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(3, "same text"), (3, "same text"), (None, "same text"), (9, "same text")], "doc_id long, text string")
    assert [r.component_id for r in simhash.simhash_query(df).collect()] == [3] * 4
    assert simhash.simhash_query(df.limit(0)).count() == 0


def test_components_of_large_stars(spark, monkeypatch):
    from larder.llm import components

    monkeypatch.setattr(components, "STAR", 3)
    r = random.Random(4)
    edges = [(1000, i) for i in range(60)] + [(i, 2000) for i in range(40, 90)] + [(3000 + i, 3001 + i) for i in range(20)] + [(5, 5), (4000, 4001)]
    r.shuffle(edges)
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: 0 for n in [*range(1, 90), 1000, 2000]} | {3000 + i: 3000 for i in range(1, 21)} | {4001: 4000}
    assert got == want


def test_buckets_told_to_all_and_joined_by_key(spark, monkeypatch):
    """Hot buckets over and under the share of rows that is broadcast, with tiny tiles, lose no link; so do a null, an empty and a very long text."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    long = [r.choice(words) for _ in range(200_000)]
    rows = [(0, None), (1, ""), (2, " ".join(long)), (3, " ".join([*long[:-1], "other"]))]
    for i in range(4, 84):
        base = words[: 30 + i % 3]
        base[i % 20] = r.choice(words)
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: c for i, (_, c) in slow_components(rows).items()}
    for share in (2, 8, 100_000):
        monkeypatch.setattr(simhash, "TILE", 3)
        monkeypatch.setattr(simhash, "SHARE", share)
        assert {x.doc_id: x.component_id for x in simhash.near_duplicates(docs).collect()} == want
    assert want[3] == 2 and want[1] == 0


def test_small_stars_are_dealt_out(spark, monkeypatch):
    """One node with many smaller neighbours, as the small star meets them; the shares bound what is broadcast."""
    from larder.llm import components

    monkeypatch.setattr(components, "STAR", 3)
    monkeypatch.setattr(components, "SHARE", 4)
    edges = [(1000, i) for i in range(300)] + [(2000 + i, 500) for i in range(300)] + [(7, 7), (1000, 5)]
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 300)}, 1000: 0, **{2000 + i: 500 for i in range(300)}}
