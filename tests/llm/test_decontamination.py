import random

import numpy as np

from larder.llm import decontamination as dc


def slow_fold(t):
    out = "".join(c.lower() if len(c.lower()) == 1 else c for c in (c if c.isalnum() else " " for c in (t or "")))
    return " ".join(out.split(" ")).strip() if "  " not in out else " ".join(w for w in out.split(" ") if w)


def slow_edits(item, text):
    """Least edits of item anywhere in text, by the plain table."""
    row = [0] * (len(text) + 1)
    for y, c in enumerate(item, 1):
        new = [y]
        for x, d in enumerate(text, 1):
            new.append(min(row[x - 1] + (c != d), row[x] + 1, new[x - 1] + 1))
        row = new
    return min(row)


def make(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéÉO") for _ in range(r.randrange(1, 7)))
    prose = lambda n: " ".join(word() + r.choice(["", "", ",", ".\n"]) for _ in range(n))
    items = [(i, prose(r.choice([2, 3, 5, 8, 30, 60]))) for i in range(25)] + [(100, None), (101, ""), (102, "abc"), (103, "!! ?")]
    rows = [(0, None), (1, ""), (2, " .. "), (3, "abc")]
    for i in range(4, 90):
        text = prose(r.randrange(0, 80))
        if i % 2:
            passage = list(r.choice(items[:25])[1])
            for _ in range(int(len(passage) * r.choice([0, 0.02, 0.08, 0.1, 0.13, 0.3]))):
                k = r.randrange(len(passage))
                passage[k] = r.choice(["", "x", passage[k] + "y", passage[k].upper()])
            text += " " + "".join(passage) + " " + prose(r.randrange(0, 20))
        rows.append((i, text))
    return rows, items


def test_against_full_alignment(spark):
    for seed in (1, 2):
        rows, items = make(seed)
        docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, item_id int").repartition(3)
        bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
        got = {(g.doc_id, g.item_id): g.edits for g in dc.decontamination_query(docs, bench).collect()}
        want = {}
        for i, t in rows:
            text = slow_fold(t)
            for j, u in items:
                item = slow_fold(u)
                if item:
                    d = slow_edits(item, text)
                    if d <= int(len(item) * 0.1):
                        want[i, j] = d
        assert got == want and len(want) > 20
        assert any(len(slow_fold(u)) < 40 and want[i, j] == int(len(slow_fold(u)) * 0.1) > 0 for i, j in want for k, u in items if k == j)


def test_places_and_clean(spark):
    item = "What is the tallest mountain that anyone has ever measured, in metres?"
    rows = [(1, "Intro... " + item.upper() + " Outro"), (2, "Nothing here at all."), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    (row,) = dc.decontamination_query(docs, bench).collect()
    assert (row.doc_id, row.item_id, row.edits) == (1, 7, 0)
    assert rows[0][1][row.start : row.end] == item.upper()[:-1]
    assert sorted(r.doc_id for r in dc.clean(docs, bench).collect()) == [2, 3]
    assert dc.decontamination_query(docs.limit(0), bench).count() == 0
    assert dc.decontamination_query(docs, bench.limit(0)).count() == 0 and dc.clean(docs, bench.limit(0)).count() == 3


def test_blocks_of_items(spark, monkeypatch):
    rows, items = make(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = {tuple(g) for g in dc.decontamination_query(docs, bench).collect()}
    monkeypatch.setattr(dc, "BLOCK_CHARS", 700)
    assert {tuple(g) for g in dc.decontamination_query(docs, bench).collect()} == one


def test_fold_marks_rows():
    chars, row, place = dc.folded(["", "A-b", "  ", "Ç  x"])
    assert "".join(map(chr, chars)).replace("\1", "|") == "|a b||ç x|"
    assert row.tolist() == [0, 1, 1, 1, 1, 2, 3, 3, 3, 3] and place[1:4].tolist() == [0, 1, 2]
    assert isinstance(chars, np.ndarray)


def test_all_edits_of_short_items(spark):
    item = "abcdefghij klmnopqrst uvwxyz12"  # 30 characters, so 3 edits
    rows = [(1, "zz abcd0fghij klmnopqrst uvwx0z1 yy"), (2, "zz ab0d0fghij kl0nopqrst uvw0yz12"), (3, "x ab0defghij kl0nopqrst uvw0yz12 y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "cat"), (9, "ab0d0f")], "item_id int, text string")
    got = dc.decontamination_query(docs, bench)
    assert dict(got.dtypes)["item_id"] == "int"
    assert {(g.doc_id, g.item_id): g.edits for g in got.collect()} == {(1, 7): 3, (3, 7): 3, (2, 9): 0}
    # one rule at every length: inside words too
    texts = ["A cat!", "concatenate", "dogs, cat", "the cat sat", "sat on amat", "s-at on a mat", "nothing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    short = spark.createDataFrame([(8, "cat"), (1, "at sat"), (2, "sat on am"), (3, "t"), (4, "concatenate")], "item_id long, text string")
    got = {(g.doc_id, g.item_id): g.edits for g in dc.decontamination_query(docs, short).collect()}
    want = {}
    for i, text in enumerate(texts):
        for j, item in [(r.item_id, r.text) for r in short.collect()]:
            d = slow_edits(slow_fold(item), slow_fold(text))
            if d <= int(len(slow_fold(item)) * 0.1):
                want[i, j] = d
    assert got == want and (3, 1) in want and (4, 2) in want and (1, 8) in want


def test_long_texts_in_pieces():
    rows, items = make(4)
    texts = [t or "" for _, t in rows]
    index = dc.Items([i for i, _ in items], [t for _, t in items])
    whole = "  \n".join(texts) + " cat"
    want = {i: d for _, i, d, _, _ in dc.leaks_in(index, [whole], size=1 << 30)}
    for size in (700, 1111, 4000):
        found = dc.leaks_in(index, [whole], size=size)
        assert {i: d for _, i, d, _, _ in found} == want
        for _, i, d, s, e in found:
            assert slow_edits("".join(map(chr, index.chars[i])), slow_fold("q" + whole[s:e] + "q")) <= d
    gaps = "one two" + " " * 3000 + "three four five"
    one = dc.Items([1, 2, 3], ["one two three four", "fiv", "fix"])
    assert [(i, d) for _, i, d, _, _ in dc.leaks_in(one, [gaps], size=100)] == [(0, 0), (1, 0)]


def test_columns_of_any_name(spark):
    rows = [(1, "see: the tallest mountain of all", 1, 2, 3), (2, "none", 4, 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_folded` int, `a.b` int, row int")
    bench = spark.createDataFrame([("q", "the tallest mountain of all")], "item_id string, text string")
    out = dc.clean(docs, bench)
    assert out.schema == docs.schema and [tuple(r) for r in out.collect()] == rows[1:]
    assert [(r.doc_id, r.item_id) for r in dc.leaks(docs, bench).collect()] == [(1, "q")]
