import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest

from larder.llm import language_id as li


def slow_cost(samples, order, text):
    """Code length by walking plain dictionaries, one byte at a time."""
    counts = {}
    for t in samples:
        padded = b"\0" * order + t
        for i in range(order, len(padded)):
            for n in range(order + 1):
                row = counts.setdefault((n, padded[i - n : i]), {})
                row[padded[i]] = row.get(padded[i], 0) + 1
    bits, padded = 0.0, b"\0" * order + text
    for i in range(order, len(padded)):
        for n in range(order, -1, -1):
            row = counts.get((n, padded[i - n : i]))
            if not row:
                continue
            total = sum(row.values()) + len(row)
            if padded[i] in row:
                bits -= math.log2(row[padded[i]] / total)
                break
            bits -= math.log2(len(row) / total)
        else:
            bits += 8
    return bits


def test_exact_code_lengths(monkeypatch):
    r = random.Random(3)
    make = lambda letters, n: "".join(r.choice(letters) for _ in range(n)).encode()
    samples = {"aa": [make("abc é", 300), make("abc", 40)], "bb": [make("bcd ", 300), b""], "cc": [make("xyz", 3)]}
    model = li.train(samples, 3)
    texts = [make("abcdé xyz?", n) for n in (0, 1, 2, 5, 100, 700)]
    want = np.array([[slow_cost(samples[k], 3, t) for k in sorted(samples)] for t in texts])
    assert np.allclose(li.code_lengths(model, texts), want, rtol=1e-4, atol=1e-2)
    monkeypatch.setattr(li, "_PIECE", 64)
    assert np.allclose(li.code_lengths(model, texts), want, rtol=1e-4, atol=1e-2)


def test_query_on_small_table(spark):
    r = random.Random(4)
    words = {"en": "the and of thing with that".split(), "de": "der und nicht schön über ein".split(), "fr": "le être déjà avec où une".split()}
    rows = []
    for i in range(300):
        lang = r.choice(sorted(words))
        rows.append((i, " ".join(r.choice(words[lang]) for _ in range(12)), lang if i % 9 else None, 1.0))
    rows += [(1000, None, "en", 0.0), (1001, "", "de", 0.0), (1002, "123 !!", "fr", 0.0), (1003, "the " * 40000, None, 0.0), (7, rows[7][1], "en", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = li.language_id_query(df).collect()
    assert len(got) == len(rows)
    by = {g.doc_id: g for g in got}
    for g in got:
        assert g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) and 0 <= g.score <= 1
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1003].lang_pred == "en"
    known = [(by[i].lang_pred, lang) for i, _, lang, _ in rows[:300] if lang]
    assert sum(a == b for a, b in known) > 0.97 * len(known)


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in li.language_id_query(df).collect()] == ["und"]
    assert li.language_id_query(df.limit(0)).count() == 0


def test_every_label_is_learned(spark):
    r = random.Random(6)
    names = [f"l{k:02d}" for k in range(70)]
    words = {k: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(6)] for k in names}
    prose = lambda k, n: " ".join(r.choice(words[k]) for _ in range(n))
    rows = [(i, prose(k, 20), k) for i, k in enumerate(names * 4)]
    rows += [(1000, prose("l00", 30), None), (1001, prose("l69", 30), None)]
    words["long"] = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(6)]
    rows += [(2000 + i, prose("long", 11_000), "long") for i in range(3)] + [(3000, prose("long", 30), None)]
    model = li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == [*names, "long"]
    got = li.verdicts(model, [t for _, t, _ in rows])[0]
    want = [k for _, _, k in rows if k]
    assert sum(a == b for a, b in zip(got, [k for _, _, k in rows], strict=True) if b) == len(want)
    assert [a for a, (_, _, k) in zip(got, rows, strict=True) if k is None] == ["l00", "l69", "long"]


def test_sample_is_bounded_for_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(li, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(li, "SAMPLE_BYTES", 150)
    rows = [(None, f"text {i:05d}", "en") for i in range(900)] + [(5, "same text", "de")] * 900 + [(None, f"{i:03d}" * 20, "fr") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    sample = li.training_rows(df, "doc_id", "text", "lang").collect()
    count = {k: sum(r.lang == k for r in sample) for k in ("en", "de", "fr")}
    assert count == {"en": 15, "de": 17, "fr": 3}


def test_texts_are_judged_in_parts():
    """The bytes of a batch's texts are never held all at once; the verdicts are those of one part."""
    texts = [None, "", "the and of " * 5, "x" * 50, 7.5, "der und die " * 9]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(li, "_ROUND", 60)
        parts = list(li._rounds(pd.Series(texts, dtype=object)))
    assert [t for p in parts for t in p] == [t if isinstance(t, str) else None for t in texts] and [len(p) for p in parts] == [3, 2, 1]
    assert list(li._rounds(pd.Series([], dtype=object))) == [[]]
    model = li.train({"en": [b"the and of that which"], "de": [b"der und die nicht ein"]})
    whole, each = li.verdicts(model, parts[0] + parts[1]), [li.verdicts(model, p) for p in parts[:2]]
    assert whole[0] == each[0][0] + each[1][0] and whole[1].tolist() == [*each[0][1], *each[1][1]] and whole[2].tolist() == [*each[0][2], *each[1][2]]
