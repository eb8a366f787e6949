import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from larder.llm import simhash
from larder.llm import suffix_dedup as sd
from tests.llm.test_simhash import slow_components
from tests.llm.test_suffix_dedup import make_rows


def test_columns_survive_each_stage(spark, tmp_path):
    r = random.Random(3)
    words = {"en": "the and of thing with that which".split(), "de": "der und nicht schön über ein".split()}
    text = lambda lang, n: " ".join(r.choice(words[lang]) + r.choice(["", "x", "y", "zz"]) for _ in range(n))
    items = [(i, text("en", 25)) for i in range(3)]
    rows = []
    for i in range(120):
        lang = r.choice(["en", "de"])
        rows.append((i, text(lang, r.randrange(30, 80)), lang, "s", 1, "extra"))
    passage = text("en", 40)
    rows[10] = (10, rows[9][1], "en", "s", 1, "extra")  # an exact copy
    rows[20] = (20, text("en", 20) + " " + items[1][1] + " " + text("en", 20), "en", "s", 1, "leak")
    rows[30] = (30, text("en", 30) + passage, "en", "s", 1, "extra")
    rows[31] = (31, passage + text("en", 30), "en", "s", 1, "extra")
    rows += [(200, None, "en", "s", 0, None), (201, "", None, "s", 0, None), (202, "12 34 !!", "en", None, 0, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.collect()
    ids = {name: {r.doc_id for r in rows_} for name, rows_ in seen.items()}
    assert not ids["language_id"] & {200, 201, 202} and len(ids["language_id"]) > 110
    assert 10 not in ids["simhash_near_dedup"] and 9 in ids["simhash_near_dedup"]
    assert passage in {r.doc_id: r.text for r in seen["suffix_array_dedup"]}[30]
    assert passage not in {r.doc_id: r.text for r in seen["suffix_array_dedup"]}[31]
    assert ids["benchmark_decontamination"] == ids["suffix_array_dedup"] - {20}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen["benchmark_decontamination"]}
    total = {}
    for piece in seen["packing"]:
        total[piece.doc_id] = total.get(piece.doc_id, 0) + piece.length
    assert total == want
    assert cp.run(spark, str(tmp_path)).count() == len(seen["packing"])


@pytest.mark.parametrize("name,stage", cp.STAGES[:-1])
def test_empty_documents(spark, tmp_path, name, stage):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.count() == 0


def test_representatives_against_brute_force(spark):
    rows = [(i % 50, t) for i, t in enumerate(["same words here now"] * 5 + ["other words " + "abc"[i % 3] for i in range(20)] + [None, ""] + [f"w{i} x{i} y{i} z{i} v{i}" for i in range(40)])]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, root string")
    got = simhash.representatives(df)
    assert got.columns == df.columns
    # components of numbered rows; the numbers stand for rows, the ids repeat
    label = {n: c for n, (_, c) in slow_components([(n, t) for n, (_, t) in enumerate(rows)]).items()}
    groups = {}
    for n, (i, t) in enumerate(rows):
        groups.setdefault(label[n], []).append((i, t))
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == len(groups)
    for k in kept:
        (members,) = [g for g in groups.values() if k in g and k[0] == min(i for i, _ in g)][:1]
        assert k[0] == min(i for i, _ in members)


def test_texts_without_repeats(spark):
    rows = make_rows(7)
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, th string")
    out = sd.without_repeats(df).collect()
    assert len(out) == len(rows) and sum(r.text is None for r in out) == sum(t is None for _, t in rows)
    removed = {(g.doc_id, g.n_bytes): g.n_removed for g in sd.suffix_dedup_query(df).collect()}
    for (i, t), n in [((r.doc_id, r.text), removed) for r in out if r.text is not None]:
        assert any(k[0] == i and k[1] - v - 3 * 8 <= len(t.encode()) <= k[1] - v for k, v in n.items())


@pytest.mark.parametrize("name,stage", cp.STAGES[:-1])
def test_columns_of_any_name(spark, tmp_path, name, stage):
    names = "_lang_id _null_text _text_hash _id _th th fp root row verdict _folded a.b places own".split()
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names)
    r = random.Random(1)
    words = "the and of thing with that which".split()
    rows = [(i, " ".join(r.choice(words) + r.choice(["", "x", "y"]) for _ in range(40)), "en", *[f"{n}{i}" for n in names]) for i in range(12)]
    spark.createDataFrame([(1, "no such words in here at all")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    kept = out.collect()
    assert len(kept) > 8
    for k in kept:
        assert tuple(k)[2:] == rows[k.doc_id][2:]


def test_strange_texts_are_rejected(spark, tmp_path):
    r = random.Random(2)
    words = {"en": "the and of thing with that which".split(), "de": "der und nicht schön über ein".split()}
    rows = [(i, " ".join(r.choice(words[k]) for _ in range(30)), k) for i in range(60) for k in ["en", "de"][i % 2 : i % 2 + 1]]
    rows += [(100, "the thing", None), (101, "ничего из этого никогда не учили здесь", None), (102, "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(80)), None)]
    out = cp.identify_language(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), str(tmp_path))
    assert {g.doc_id for g in out.collect()} == {*range(60), 100}
