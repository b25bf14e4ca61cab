import hashlib
import random
import zlib

import pytest

from plumbline.llm import media


def rows():
    r = random.Random(1)
    block = lambda n: "".join(r.choice("abcdefgh é\n") for _ in range(n))
    shared = block(30_000)
    out = [(1, "é" * 10), (2, ""), (3, None), (4, block(5000)), (5, shared + block(9000)), (6, block(700) + shared), (7, shared), (8, "x" * 200_000), (9, "x" * 200_000), (9, "x" * 200_000), (None, "null id"), (10, "a" * 576), (11, shared + shared)]
    return out + [(100 + i, "copies " * 400) for i in range(40)]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "m", b"d") for i, t in rows()], "doc_id long, text string, media string, data binary")
    got = sorted(map(tuple, media.media_features(docs).select("id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32").collect()), key=str)
    want = []
    for i, t in rows():
        raw = (t or "").encode()
        pay = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        want.append((i, len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-32:])))
    assert got == sorted(want, key=str)
    equal = {r.payload_sha256: set() for r in media.media_features(docs).collect()}
    for r in media.media_features(docs).collect():
        equal[r.payload_sha256].add((r.media_bytes, r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in equal.values())
    assert media.media_features(docs.limit(0)).collect() == []


def test_shared_chunks_are_stored_once(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    lists, kept, foreign = media.store(docs)
    stored = [hashlib.sha256(c[36:]).digest() for r in kept.collect() for c in r.cells if c is not None]
    listed = {bytes(d) for r in lists.collect() for d in r.digests}
    assert len(stored) == len(set(stored)) and set(stored) == listed and foreign.count() > 10


def test_chunks():
    r = random.Random(2)
    for n in (576, 5000, 100_000):
        data = bytes(r.randrange(256) for _ in range(n))
        parts = media.chunks(data)
        assert b"".join(parts) == data and all(media.MIN_CHUNK <= len(p) <= media.MAX_CHUNK for p in parts[:-1])
        moved = media.chunks(b"inserted bytes" + data)
        if n == 100_000:
            assert len(set(parts) & set(moved)) > 0.8 * len(parts)
    h = 0
    data = bytes(r.randrange(256) for _ in range(300))
    for b in data[-32:]:
        h = (h * 2 + int(media.GEAR[b])) % 2**32
    x = media.GEAR[list(data)]
    assert h == sum(int(v) << (31 - k) for k, v in enumerate(x[-32:])) % 2**32


def test_a_wrong_byte_is_noticed(spark):
    from pyspark.sql import functions as F

    lists, kept, foreign = media.store(spark.createDataFrame([(1, "some text")], "doc_id long, text string"))
    for other in (media.cell(b"other"), media.cell(media.payload_of("some text"))[:-1]):
        with pytest.raises(Exception, match="digest"):
            media.rebuilt(kept.withColumn("cells", F.array(F.lit(other))), foreign).collect()


@pytest.mark.parametrize("limit", [media.CELL_HEAD, 16 << 20])
def test_many_rows_of_one_id_are_stored_once(spark, monkeypatch, limit):
    from plumbline.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)  # joined by a shuffle, and broadcast
    r = random.Random(4)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(800)) for _ in range(2000)]
    out = [(None, t) for t in texts] + [(7, t) for t in texts[:50]] + [(None, texts[0])] * 3 + [(7, "seven " * 500)] * 40 + [(None, "null " * 500)] * 40
    docs = spark.createDataFrame(out, "doc_id long, text string")
    lists, kept, foreign = media.store(docs)
    assert kept.count() == kept.select("media").distinct().count() == 2002
    got = media.media_features(docs).select("id", "payload_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, hashlib.sha256(media.payload_of(t)).hexdigest()) for i, t in out), key=str)


def test_the_stored_form_is_what_is_hashed(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    lists, kept, foreign = media.store(docs)
    whole = {bytes(r.media): r.cells for r in kept.collect()}
    lent = {(bytes(r.media), r.pos): whole[bytes(r.owner)][r.owner_pos] for r in foreign.collect()}
    for r in media.media_features(docs).collect():
        m = bytes.fromhex(r.payload_sha256)
        stored = b"".join(c if c is not None else lent[m, k] for k, c in enumerate(whole[m]))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
