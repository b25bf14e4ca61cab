import hashlib
import random

from plumbline.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", b"y") for i, u, h in rows], "page_id long, url string, html string, archive string, body binary")


def test_round_trip(spark):
    big = "<p>é" * 60
    rows = [(5, "http://a", big), (3, "http://b c\n", big), (9, None, big), (1, "u", "x" * 99), (2, "u", "x" * 99), (4, "u", None), (6, "u", ""), (7, "u", "z" * 3_000_000), (3, "u", big), (None, "u", big), (None, "v", "only" * 50)]
    got = warc.read_archives(warc.write_archives(pages(spark, rows))).collect()
    assert len(got) == len(rows) and all(r.gap is None for r in got)
    kind = {(r.page_id, r.url): (r.record_type, r.refers_to, r.payload) for r in got}
    assert kind[3, "http://b%20c%0A"] == ("response", None, big.encode())
    assert kind[5, "http://a"] == ("revisit", 3, None) and kind[9, ""] == ("revisit", 3, None) and kind[None, "u"] == ("revisit", 3, None)
    assert kind[1, "u"][0] == kind[2, "u"][0] == kind[None, "v"][0] == "response" and kind[4, "u"][2] == b""
    assert all(r.payload_digest == hashlib.sha256(r.payload).hexdigest() for r in got if r.payload is not None)
    assert warc.read_archives(warc.write_archives(pages(spark, rows).limit(0))).collect() == []


def records(n):
    return [warc.make_record("response", i, f"http://h/{i}", (f"page {i} " * 40).encode(), hashlib.sha256((f"page {i} " * 40).encode()).hexdigest(), None) for i in range(n)]


def test_salvage_of_damaged_files():
    r = random.Random(3)
    for make in (lambda x: x, warc.gzip_member):
        parts = [make(x) for x in records(30)]
        starts = [sum(map(len, parts[:i])) for i in range(31)]
        for _ in range(20):
            data = bytearray(b"".join(parts))
            hurt = sorted(r.sample(range(30), 3))
            for k in hurt:
                at = r.randrange(starts[k] + (0 if make is warc.gzip_member else 60), starts[k + 1] - 8)
                data[at : at + 5] = bytes(255 - b for b in data[at : at + 5])
            found = list(warc.salvage(bytes(data)))
            ids = [int(f["page-id"]) for kind, _, _, f, _ in found if kind == "record"]
            assert set(range(30)) - set(hurt) <= set(ids) and ids == sorted(ids)
            spans = [(a, b) for _, a, b, _, _ in found]
            assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_truncated_inserted_and_mixed_bytes(spark):
    a, b, c = records(3)
    mixed = b"junk WARC/1.1 junk" + a + warc.gzip_member(b) + b"\x1f\x8b\x08 broken" + c[:-40]
    df = spark.createDataFrame([("f", mixed), ("empty", b""), ("null", None)], "archive string, body binary")
    got = sorted(warc.read_archives(df).collect(), key=lambda x: x.start)
    assert [(x.page_id, x.gap is None) for x in got] == [(None, False), (0, True), (1, True), (None, False)]
    assert got[0].start == 0 and got[-1].stop == len(mixed)


def test_long_urls(spark):
    big = "data:text/plain," + "a" * 100_000
    html = "<p>long" * 60
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(pages(spark, [(1, big, html), (2, "u", html)]))).collect()}
    assert (got[1].gap, got[1].url, got[1].payload) == (None, big, html.encode()) and (got[2].record_type, got[2].refers_to) == ("revisit", 1)


def test_members_of_many_records():
    parts = records(30)
    hurt = bytearray(parts[7])
    hurt[-20:-15] = b"-----"
    ids = lambda found: [int(f["page-id"]) for kind, _, _, f, _ in found if kind == "record"]
    found = list(warc.salvage(warc.gzip_member(b"".join([*parts[:7], bytes(hurt), *parts[8:]])) + warc.gzip_member(parts[0])))
    assert ids(found) == [i for i in range(30) if i != 7] + [0]
    assert [f for kind, _, _, f, _ in found if kind == "gap"] == ["block digest differs"]
    r = random.Random(5)
    noisy = [warc.make_record("response", i, "u", x := r.randbytes(3000), hashlib.sha256(x).hexdigest(), None) for i in range(30)]
    whole = warc.gzip_member(b"".join(noisy))
    for cut in (len(whole) - 1, len(whole) // 2, len(whole) // 3):
        z = warc.zlib.decompressobj(31)
        size = len(z.decompress(whole[:cut]))
        n = next((k for k in range(30) if sum(map(len, noisy[: k + 1])) > size), 30)
        found = list(warc.salvage(whole[:cut]))
        assert n > 5 and ids(found) == list(range(n))
        assert found[-1][0] == "gap" and found[-1][2] == cut and found[-2][2] == found[-1][1]
    hurt = bytearray(whole)
    hurt[-6] ^= 255  # only the member's check sum
    found = list(warc.salvage(bytes(hurt) + warc.gzip_member(parts[3])))
    assert ids(found) == [*range(30), 3] and [k for k, *_ in found].count("gap") == 1
