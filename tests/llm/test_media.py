import hashlib
import math
import zlib
from collections import Counter

from larder.llm import media


def test_round_trip_and_query(spark):
    texts = [None, "", "a", "x" * 64, "x" * 65, "é" * 1000, "a", "long " * 50000, None, "a\0b"]
    df = spark.createDataFrame([(i % 9, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, feature string").repartition(3)
    got = media.media_query(df).collect()
    assert len(got) == len(texts)
    want = []
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\0" * ((max(64, (len(raw) + 63) // 64 * 64)) - len(raw))
        png = media.to_png(payload)
        want.append((i % 9, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(png), hashlib.sha256(png).hexdigest(), 64, len(payload) // 64, 8))
    mine = [(g.doc_id, g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32, g.media_bytes, g.media_sha256, g.width, g.height, g.depth) for g in got]
    assert sorted(mine) == sorted(want)
    for t in texts:
        payload = media.payload_of(t)[1]
        of = [g for g in got if g.digest == hashlib.sha256(payload).hexdigest()]
        counts = Counter(payload)
        entropy = -sum(n / len(payload) * math.log2(n / len(payload)) for n in counts.values())
        shown = f"png 64x{len(payload) // 64}x8 mean={sum(payload) / len(payload):.4f} entropy={abs(entropy):.4f} zeros={counts[0]}"
        assert {g.feature for g in of} == {shown}
        assert len({(g.shard, g.offset, g.length) for g in of}) == 1 and of[0].length == of[0].media_bytes
    assert media.media_query(df.limit(0)).count() == 0


def test_shards_are_tar_files_and_hold_a_payload_once(spark, tmp_path):
    import tarfile

    texts = ["one", "two", "one", None, "", "x" * 3000, None, "three", "one"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = media.store(df).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    members = {}
    for shard in {r.shard for r in rows}:
        with tarfile.open(shard.removeprefix("file://")) as tar:
            for m in tar.getmembers():
                assert m.name not in members
                members[m.name] = (shard, m.offset_data, m.size, tar.extractfile(m).read())
    assert len(members) == 5
    for r in rows:
        shard, offset, length, data = members[r.digest + ".png"]
        assert (shard, offset, length) == (r.shard, r.offset, r.length)
        assert media.from_png(data) == media.payload_of(texts[r.doc_id])[1]


def test_payloads_of_one_row_and_chance_hits(spark, monkeypatch):
    """All bits set: every payload goes through the shuffle, and nothing else changes."""
    texts = [f"text {i % 400}" for i in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    rows, places = media.stored(df)
    assert rows.where("shard is not null").count() == 300 and places.count() == 100
    some = {r.doc_id: (r.digest, r.length) for r in media.store(df).collect()}
    monkeypatch.setattr(media, "_repeat_bits", lambda rows: media.np.full(1 << (media.REPEAT_BITS - 6), -1))
    rows, places = media.stored(df)
    assert rows.where("shard is not null").count() == 0 and places.count() == 400
    every = {r.doc_id: (r.digest, r.length) for r in media.store(df).collect()}
    assert some == every and len(every) == 500


def test_many_rows_of_one_payload(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' else cast(id % 1500 as string) end as text")
    rows, places = media.stored(df)
    assert [r.digest for r in places.where("heavy").collect()] == [hashlib.sha256(media.payload_of("hot")[1]).hexdigest()]
    assert media.resolved(rows.where("shard is null"), places).groupBy("digest").count().where("count = 1000").count() == 1
    assert media.media_query(df).select("doc_id").distinct().count() == 3000


def test_images_by_another_reader(spark, tmp_path):
    """The image source reads the stored form with the JVM's own decoder."""
    texts = ["", "a\0b", "é" * 1000, "word " * 5000]
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.png").write_bytes(media.to_png(media.payload_of(t)[1]))
    found = spark.read.format("image").load(str(tmp_path)).select("image.origin", "image.width", "image.height", "image.nChannels", "image.data").collect()
    assert len(found) == len(texts)
    for r in found:
        payload = media.payload_of(texts[int(r.origin.rpartition("/")[2][:-4])])[1]
        assert (r.width, r.height, r.nChannels, bytes(r.data)) == (64, len(payload) // 64, 1, payload)
