import random

import numpy as np
import xxhash

from plumbline.llm import components, simhash

SCHEMA = "doc_id long, text string, id string, fp string, component_id long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 7) for i, t in rows], SCHEMA)


def brute(rows):
    fp = {}
    for i, t in rows:
        words = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fp[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    parent = {i: i for i in fp}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fp:
        for b in fp:
            if (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (f"{fp[i]:016x}", root(i)) for i in fp}


def test_against_brute_force(spark):
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefgh") * r.randint(1, 4) for _ in range(r.randint(1, 60))) for _ in range(60)]
    rows = list(enumerate(base + base[:20] + [t + " End" for t in base[:20]] + ["", None, "  \t", "One", "ÉTÉ é", "long " * 40000, "Long " * 40000]))
    got = {r.id: (r.fp.hex(), r.component_id) for r in simhash.simhash_components(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_chain_of_fingerprints_is_one_component(spark):
    fps = [0]
    for i in range(20):
        fps.append(fps[-1] ^ (0b111 << (3 * i)))
    df = spark.createDataFrame([(bytearray(x.to_bytes(8, "big")),) for x in fps], "fp binary")
    roots = components.components(simhash.fingerprint_links(df)).collect()
    assert len(roots) == len(fps) and len({bytes(r.root) for r in roots}) == 1


def test_large_blocks_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 4)  # every shared block is split in chunks
    r = np.random.default_rng(1)
    high = np.uint64(0xABCDEF12) << np.uint64(32)
    x = np.unique(high | r.integers(0, 2**10, 200).astype(np.uint64))
    df = spark.createDataFrame([(bytearray(int(v).to_bytes(8, "big")),) for v in x], "fp binary")
    got = components.components(simhash.fingerprint_links(df)).collect()
    parent = list(range(len(x)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(x)):
        for b in np.flatnonzero(np.bitwise_count(x ^ x[a]) <= 3):
            p, q = sorted((root(a), root(int(b))))
            parent[q] = p
    want = {}
    for a in range(len(x)):
        want.setdefault(root(a), set()).add(int(x[a]))
    found = {}
    for g in got:
        found.setdefault(bytes(g.root), set()).add(int.from_bytes(g.node, "big"))
    assert sorted(map(sorted, found.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)


def test_null_ids_repeats_and_empty_tables(spark):
    rows = [(None, "a b c"), (None, "a b c"), (5, "a b c"), (5, "a b c"), (9, "other words here now")]
    got = sorted((x.id is None, x.id or 0, x.component_id) for x in simhash.simhash_components(frame(spark, rows)).collect())
    assert got == [(False, 5, 5), (False, 5, 5), (False, 9, 9), (True, 0, 5), (True, 0, 5)]
    assert simhash.simhash_components(frame(spark, rows).limit(0)).collect() == []
