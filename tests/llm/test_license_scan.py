import random
import re

from larder.llm import license_scan, oracles
from larder.llm.license_rules import BASE, CONFIDENCE, rules

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def slow(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    base = [(i, label) for label, _, phrase in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    joined = " " + " ".join(words) + " "
    hits = []
    for n, (label, tier, keys, pattern) in enumerate(rules()):
        if not set(keys) & set(words):
            continue
        for m in re.finditer(f"(?i)(?<= )(?:{pattern})(?= )", joined, re.ASCII):
            start = joined[: m.start()].count(" ") - 1
            hits.append((start, start + m[0].count(" ") + 1, tier, n, label))
    kept = [h for h in hits if not any(e != h and e[0] <= h[0] and e[1] >= h[1] and e[2] <= h[2] and (e[:2] != h[:2] or e[2:4] < h[2:4]) for e in hits)]
    labels = sorted({b for _, b in base} | {h[4] for h in kept})
    score = max((CONFIDENCE[h[2]] for h in kept), default=0.0)
    starts = [s for s, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in base})), ",".join(labels), score, len(kept))


def texts(seed=1):
    r = random.Random(seed)
    bits = [
        "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0", "cc by cc by", "GNU General Public License, version 3", "mit license", "MİT license", "mit", "License",
        "SPDX-License-Identifier: GPL-2.0-or-later", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "GNU Lesser General Public License v2.1", "https://www.apache.org/licenses/LICENSE-2.0", "the", "word", "é", "日本", "\x00", "gnu", "creative commons attribution share-alike 4.0",
        "All rights reserved", "licensed under", "BSD 3-clause", "public domain", "Copyright (c) 2019", "open source license", "CC0 1.0",
    ]
    out = [None, "", " .,\n", "mit license", "apache license apache license", "x" * 5000, "mit license " * 300]
    return out + [r.choice([" ", ", ", "\n", "-"]).join(r.choice(bits) for _ in range(r.randrange(1, 25))) for _ in range(150)]


def test_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "mit license"), (3, "mit license"), (None, "cc by")]
    df = spark.createDataFrame([(i, t, "l", 1) for i, t in rows], "doc_id long, text string, labels string, n_words int").repartition(3)
    got = license_scan.scan_query(df).collect()
    mine = sorted(map(str, [(g.doc_id, g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels, g.labels, g.score, g.n_detections) for g in got]))
    assert mine == sorted(map(str, [(i, *slow(t)) for i, t in rows]))
    assert license_scan.scan_query(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = license_scan.scan_query(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_spans(spark):
    df = spark.createDataFrame([(1, "x Licensed under the MIT License. y")], "doc_id long, text string")
    (row,) = license_scan.scan(df).collect()
    assert [(d.label, d.tier, d.start, d.end) for d in row.detections] == [("mit", 1, 1, 6)]
    assert [(b.label, b.start) for b in row.base] == [("mit", 4)]


def test_many_rules():
    assert len(rules()) > 250
    assert "license" in oracles.license_scan_sql()


def test_time_grows_with_the_text(spark):
    import time

    took = {}
    for n in (500, 50_000):
        df = spark.createDataFrame([(1, "MIT license, " * n)], "doc_id long, text string")
        began = time.time()
        (row,) = license_scan.scan_query(df).collect()
        took[n] = time.time() - began
        assert (row.n_base, row.last_word, row.labels, row.n_detections) == (n, 2 * n - 2, "mit", n)
    assert took[50_000] < took[500] + 40  # a copy of all matches at each match would take many minutes
