"""Vector codes: every step against a full search in Python integers, and odd rows."""

import hashlib
import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    """The contract by a full search: {vec_id: (code, error, label_error)}, sha."""
    kept = sorted((i, [math.floor(4096 * float(x)) for x in v], c) for i, v, c in rows if v and all(x is not None and math.isfinite(x) for x in v))
    d = len(kept[0][1]) // 8
    part = lambda v, p: v[p * d : (p + 1) * d]
    books = [[part(v, p) for _, v, _ in kept[:16]] for p in range(8)]

    def nearest(x, p):
        dist = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return dist.index(min(dist)), min(dist)

    for _ in range(6):
        sums = [defaultdict(list) for _ in range(8)]
        for _, v, _ in kept:
            for p in range(8):
                sums[p][nearest(part(v, p), p)[0]].append(part(v, p))
        for p in range(8):
            for e, xs in sums[p].items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = {}, defaultdict(int)
    for i, v, c in kept:
        found = [nearest(part(v, p), p) for p in range(8)]
        out[i] = ("".join(f"{e:02x}" for e, _ in found), sum(x for _, x in found), c)
        by_label[c] += out[i][1]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return {i: (code, error, by_label[c]) for i, (code, error, c) in out.items()}, sha


def table_of(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in vectors.op12_vector_codes(spark, str(tmp_path)).collect()}


def test_query_equals_a_full_search(spark, tmp_path):
    g = np.random.default_rng(5)
    vecs = np.float32(g.normal(size=(150, 16)) / 4)
    vecs[40:60] = vecs[40]  # repeated vectors
    rows = [(i * 3, [float(x) for x in v], None if i % 7 == 0 else i % 4) for i, v in enumerate(vecs)]
    rows += [(1, None, 1), (2, [], 1), (4, [float("nan")] * 16, 1), (5, [float("inf")] + [0.0] * 15, 2), (7, [None] + [0.0] * 15, 2), (8, [0.5] * 15, 2)]
    want, sha = plain([r for r in rows if r[0] != 8])  # its length is no multiple of eight
    got = table_of(spark, tmp_path, rows)
    assert got == {i: (*v, sha) for i, v in want.items()}


def test_few_and_equal_vectors_take_the_lowest_index(spark, tmp_path):
    rows = [(i, [0.25, -0.25] * 4, None) for i in range(5)]
    got = table_of(spark, tmp_path, rows)
    assert {v[:3] for v in got.values()} == {("00" * 8, 0, 0)} and len(got) == 5


def test_empty_table(spark, tmp_path):
    assert table_of(spark, tmp_path, []) == {}


def test_cells_never_lose_the_nearest_entry():
    g = np.random.default_rng(3)
    entries = np.int64(g.normal(size=(16, 4)) * 500)
    entries[5] = entries[2]  # a tie of entries
    v = np.concatenate([np.int64(g.normal(size=(3000, 4)) * 700), entries, (entries[:8] + entries[8:]) // 2])
    want = vectors.nearest_exact(v, entries)
    for bits in (0, 3, 6, 9, 12):
        cache = vectors.CellCache(entries, bits)
        for lo in range(0, len(v), 500):  # a later batch meets cells that are known
            best, dist = cache.nearest(v[lo : lo + 500])
            assert (best == want[0][lo : lo + 500]).all() and (dist == want[1][lo : lo + 500]).all()
        if bits == 6:
            assert cache.evaluated < 8 * cache.rows


def test_a_full_cache_is_emptied_and_cells_of_one_hash_are_told_apart(monkeypatch):
    g = np.random.default_rng(4)
    entries, v = np.int64(g.normal(size=(16, 4)) * 300), np.int64(g.normal(size=(2000, 4)) * 300)
    want = vectors.nearest_exact(v, entries)
    monkeypatch.setattr(vectors, "CACHE_CELLS", 50)
    monkeypatch.setattr(vectors, "_MIX", np.uint64(0))  # every cell hashes to zero
    cache = vectors.CellCache(entries, 5)
    got = [cache.nearest(v[lo : lo + 100]) for lo in range(0, len(v), 100)]
    assert (np.concatenate([b for b, _ in got]) == want[0]).all() and (np.concatenate([d for _, d in got]) == want[1]).all()


def test_large_components_are_exact(spark):
    rows = [(i, [float(i * 10**9 + j) for j in range(8)], 0) for i in range(20)]
    codes, books = vectors.compress(spark.createDataFrame(rows, SCHEMA.replace("float", "double")), "embedding", [F.col("vec_id")])
    want, sha = plain(rows)
    assert books.sha256 == sha
    assert {r.vec_id: (r.code, r.error) for r in codes.collect()} == {i: (v[0], v[1] if v[1] < 1 << 63 else None) for i, v in want.items()}


def test_clashing_names_other_columns_and_decoding(spark):
    g = np.random.default_rng(6)
    rows = [(i, [float(x) for x in g.normal(size=8)], i % 2, "kept", f"c{i}", 9) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, whole_numbers int, note string, code string, error int")
    codes, books = vectors.compress(df, "embedding", [F.col("vec_id")])
    assert codes.columns == ["vec_id", "whole_numbers", "note", "code", "error"]
    back = {r.vec_id: r for r in codes.withColumn("v", vectors.decode(F.col("code"), books)).collect()}
    for i, v, n, note, *_ in rows:
        ints = [math.floor(4096 * x) for x in v]
        assert (back[i].whole_numbers, back[i].note) == (n, note)
        assert sum((a - round(b * 4096)) ** 2 for a, b in zip(ints, back[i].v)) == back[i].error
