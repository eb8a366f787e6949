import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from larder.llm import common, huffman, packing, token_files, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(seed=1, n=400):
    r = random.Random(seed)
    bits = ["the", "The's", "don't", " ", "  ", "   ", "\n", "\n\n", "\t", " \n", "\n ", "é", "日本", "12", "3.5", "!!", " ", " ", "<|endoftext|>", "🙂", "\x1c", "\u0085", "á", "'s", " '", "x"]
    return ["".join(r.choice(bits) for _ in range(r.randrange(12))) for _ in range(n)] + ["", " ", "a ", " a", "word " * 3000]


def want(text, end):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [end]


def test_encoder_equals_the_library():
    encoder, plain = tokens.Encoder(PATH), Tokenizer.from_file(PATH)
    texts = odd_texts()
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_cut_side_by_side(monkeypatch):
    """ASCII words, with marks or behind a line break, don't go one by one; tables that are left and chunks change no ids."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abehnorstTHE") for _ in range(r.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 40])))
    texts = [" ".join(word() + r.choice(["", "", ",", ".", "...", "!" * 20, "\n" + word(), ".\n" + word() + "?", "\x00", "\n\n" + word(), ",a,", "\na,\nb"]) for _ in range(40)) for _ in range(60)]
    texts += [t + end for t in texts[:9] for end in (" ", "\n", ".")] + odd_texts(3, 200) + [" " + t for t in texts[:3]]
    plain = Tokenizer.from_file(PATH)
    wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for chunk, words in ((1 << 20, 1 << 20), (500, 100), (1, 5)):
        monkeypatch.setattr(tokens, "_CHUNK", chunk)
        monkeypatch.setattr(tokens, "REMEMBERED", words)
        monkeypatch.setattr(tokens, "OTHERS", words)
        encoder = tokens.Encoder(PATH)
        for _ in range(2):
            assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == wanted
    monkeypatch.undo()
    encoder = tokens.Encoder(PATH)
    encoder.encode(["a " + " ".join(f"word{c}, and\nthen." for c in "abcdefgh")])
    assert not encoder.known and encoder.table.n == 8 + 5


def test_ids_of_many_texts_are_counted_at_once(spark, monkeypatch):
    """A sum takes as many steps as the vocabulary has ids: one for many texts, not one a text."""
    made, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **b: made.append(1) or count(*a, **b))
    monkeypatch.setattr(token_files, "mapped", lambda rows, run, schema: spark.createDataFrame([tuple(r.values()) for b in run(iter(rows.toArrow().to_batches())) for r in b.to_pylist()], schema))
    press = zstandard.ZstdCompressor()
    rows = [np.array([i % 7, 9, i % 3], np.uint16) for i in range(500)]
    frame = spark.createDataFrame([(bytearray(press.compress(x.tobytes())),) for x in rows], "ids binary")
    got = token_files.counts(frame, 12, np.dtype(np.uint16))
    assert got.tolist() == count(np.concatenate(rows), minlength=12).tolist() and len(made) < 20


def test_other_operators_find_no_encoder_in_their_worker():
    """A worker lives on from stage to stage: tables of words don't stay there beside the next operator's own."""

    class Frame:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    def held(batches):
        for _ in batches:
            yield len(tokens._WORKERS)

    for keeps, wanted in ((True, 1), (False, 0)):
        tokens.Encoder.of(PATH)
        assert list(common.mapped(Frame(), held, "n long", keeps=keeps)(iter([None]))) == [wanted]


def test_length_limited_codes():
    r = np.random.default_rng(2)
    for n, limit in ((1, 4), (2, 4), (16, 4), (300, 9), (300, 12)):
        counts = (r.pareto(0.5, n) * 10 + 1).astype(np.int64)
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and (n == 1 or sum(2.0 ** -int(x) for x in lengths) == 1.0)
    # with room enough the cost equals plain Huffman's
    import heapq

    counts = r.integers(1, 1000, 100)
    heap, cost = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert (huffman.code_lengths(counts, 40).astype(int) * counts).sum() == cost


def test_file_round_trip():
    r = np.random.default_rng(3)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = (r.pareto(1.0, n) * 5).astype(np.int64) % 900
        sizes = np.array([n // 3, 0, n - n // 3])
        lengths = huffman.code_lengths(np.bincount(ids, minlength=1000), 14)
        a, b, c = huffman.unpack_file(huffman.pack_file(np.array([-5, 7, 9]), sizes, ids, lengths))
        assert a.tolist() == [-5, 7, 9] and b.tolist() == sizes.tolist() and c.tolist() == ids.tolist()


def rows_of(seed):
    texts = odd_texts(seed, 60)
    return [(i * 7 % 97, t) for i, t in enumerate(texts)] + [(None, "x y"), (500, None), (3, texts[0]), (3, texts[0])]


def test_token_files_query(spark):
    rows = rows_of(5)
    df = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, n_tokens int, start string").repartition(3)
    got = token_files.token_files_query(df, PATH).collect()
    assert len(got) == len(rows)
    low = -(1 << 63)
    ids = {}
    for i, t in rows:
        ids.setdefault(low if i is None else i, []).append(want(t, 2))
    at = 0
    mine = {}
    for g in got:
        mine.setdefault(low if g.doc_id is None else g.doc_id, []).append((g.start, g.n_tokens, g.ids_crc32))
    for i in sorted(ids):
        assert sorted(x[1:] for x in mine[i]) == sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[i])
        for start, n, _ in sorted(mine[i]):
            assert start == at
            at += n
    assert token_files.token_files_query(df.limit(0), PATH).count() == 0


def test_files_of_bounded_size(spark, monkeypatch, tmp_path):
    rows = [(None, f"text {i} of no id") for i in range(200)] + [(i, "words " * (i % 30)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    write = token_files.write_files
    monkeypatch.setitem(write.__globals__, "FILE_IDS", 300)
    index = write(df, PATH, 2).orderBy("part", "number").collect()
    assert sum(x.n_docs for x in index) == 300 and len(index) > 4
    # rows of one id are spread over ranges
    names = [[*huffman.unpack_file(open(x.path.removeprefix("file://"), "rb").read())[0]] for x in index]
    assert sum(-(1 << 63) in n for n in names) > 1 and len({x.part for x, n in zip(index, names, strict=True) if -(1 << 63) in n}) > 1
    assert [i for n in names for i in n] == sorted(i for n in names for i in n)


@pytest.mark.parametrize("limits", [(2048, 128, 2048), (64, 3, 64), (50, 4, 20)])
def test_pack_limits(limits):
    r = np.random.default_rng(4)
    tokens_ = r.integers(1, 3 * limits[0], 300)
    loss = (tokens_ * r.random(300)).astype(np.int64)
    item, start, length, seq, offset = packing.pack(tokens_, loss, limits)
    for i in range(300):
        mine = sorted((s, n) for k, s, n in zip(item, start, length, strict=True) if k == i)
        assert mine[0][0] == 0 and sum(n for _, n in mine) == tokens_[i]
        assert all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:], strict=False))
    for s in set(seq.tolist()):
        which = np.flatnonzero(seq == s)
        which = which[np.argsort(offset[which])]
        assert length[which].sum() <= limits[0] and len(which) <= limits[1]
        assert (np.cumsum(length[which]) - length[which] == offset[which]).all()
        bears = sum(max(0, start[k] + length[k] - max(start[k], tokens_[item[k]] - loss[item[k]])) for k in which)
        assert bears <= limits[2]


def slow_pack(tokens_, loss, limits):
    """The heuristic piece by piece: dot products by hand, then the largest head that a gap can take."""
    most, segments, most_loss = limits
    items = [{"i": i, "at": 0, "left": int(n), "quiet": int(n - b)} for i, (n, b) in enumerate(zip(tokens_, loss, strict=True))]
    bears = lambda x: x["left"] - x["quiet"]
    out, rooms = [], []

    def take(x, n, seq, offset):
        out.append((x["i"], x["at"], n, seq, offset))
        borne = max(0, n - x["quiet"])
        x["at"], x["left"], x["quiet"] = x["at"] + n, x["left"] - n, max(0, x["quiet"] - n)
        return borne

    for x in items:
        while x["left"] > most or bears(x) > most_loss:
            n = min(most, x["quiet"] + most_loss)
            rooms.append((most - n, most_loss - take(x, n, len(rooms), 0)))
    pool = [x for x in items if x["left"]]
    need = [sum(x["left"] for x in pool) / most, len(pool) / segments, sum(map(bears, pool)) / most_loss]
    weight = [v / max(max(need), 1e-9) for v in need]
    pool.sort(key=lambda x: -(x["left"] * (weight[0] / most) + bears(x) * (weight[2] / most_loss)))
    seq = 0
    while pool:
        room, room_loss = rooms[seq] if seq < len(rooms) else (most, most_loss)
        offset, parts = (most - room, 1) if seq < len(rooms) else (0, 0)
        while pool and room and parts < segments:
            fit = [x for x in pool if x["left"] <= room and bears(x) <= room_loss]
            if fit:
                x = max(fit, key=lambda x: x["left"] * (weight[0] * room / most**2) + bears(x) * (weight[2] * room_loss / most_loss**2))
                n = x["left"]
            else:
                x = max(pool, key=lambda x: min(x["left"], x["quiet"] + room_loss, room))
                n = min(x["left"], x["quiet"] + room_loss, room)
                if room <= packing.SLACK or (n <= packing.SLACK and offset):
                    break
            room_loss -= take(x, n, seq, offset)
            offset, parts, room = offset + n, parts + 1, room - n
            pool = [x for x in pool if x["left"]]
        seq += 1
    return out


@pytest.mark.parametrize("limits", [(2048, 1024, 1984), (64, 3, 40), (50, 4, 20), (100, 100, 60)])
def test_pack_against_the_heuristic_by_hand(limits):
    r = np.random.default_rng(7)
    for n in (0, 1, 2, 40, 120):
        tokens_ = r.integers(1, 2 * limits[0], n)
        loss = tokens_ - np.minimum(tokens_, r.integers(1, limits[0], n))
        got = packing.pack(tokens_, loss, limits)
        assert list(zip(*(c.tolist() for c in got), strict=True)) == slow_pack(tokens_, loss, limits)


def test_loss_limit_binds_and_fill_stays_high():
    r = np.random.default_rng(8)
    tokens_ = r.integers(20, 5000, 1500)
    quiet = np.minimum(tokens_, r.integers(1, 400, 1500))
    _, start, length, seq, _ = got = packing.pack(tokens_, tokens_ - quiet, (2048, 1024, 1984))
    bears = np.bincount(seq, length - np.clip(quiet[got[0]] - start, 0, length))
    assert (bears == 1984).mean() > 0.1 and bears.max() == 1984
    assert tokens_.sum() / 2048 / (seq.max() + 1) > 0.98
    _, _, length, seq, _ = packing.pack(np.full(20_000, 2), np.ones(20_000), (2048, 1024, 1984))
    assert length.sum() == 40_000 and seq.max() + 1 == 20


@pytest.mark.parametrize("partitions", [1, 40, 200])
def test_fill_whatever_the_layout(spark, partitions):
    """Documents of some 30 tokens: the share of filled tokens doesn't follow the number of partitions."""
    rows = [(i, " ".join(f"word{(i * 7 + j) % 90}" for j in range(15))) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = packing.packed(df, PATH, 1).groupBy("sequence_id").sum("length").collect()
    assert sum(g["sum(length)"] for g in got) / (2048 * len(got)) >= 0.98


def test_prompts():
    breaks = np.array([False, True, False])
    ids = np.array([2, 1, 2, 2, 0, 2, 2, 0, 2, 1, 0, 0])
    assert packing.prompts(ids, np.array([5, 3, 3, 1]), breaks).tolist() == [2, 1, 1, 1]


def test_packed_query(spark):
    rows = rows_of(6)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, offset int").repartition(3)
    got = packing.packed(df, PATH, 1).collect()
    by = {}
    for g in got:
        by.setdefault(g.sequence_id, []).append(g)
    for pieces in by.values():
        at = 0
        for g in sorted(pieces, key=lambda g: g.offset):
            assert g.offset == at
            at += g.length
        assert at <= 2048
    crcs = {}
    for i, t in rows:
        crcs.setdefault(i, []).append(want(t, 1))
    for g in got:
        assert any(len(x) == g.doc_tokens and zlib.crc32(np.array(x[g.start : g.start + g.length], "<u4").tobytes()) == g.ids_crc32 for x in crcs[g.doc_id])
    assert sum(g.length for g in got) == sum(len(x) for v in crcs.values() for x in v)
    assert all(sum(g.loss_tokens for g in pieces) <= packing.LOSS for pieces in by.values()) and all(0 <= g.loss_tokens <= g.length for g in got)
    assert packing.packed(df.limit(0), PATH, 1).count() == 0
