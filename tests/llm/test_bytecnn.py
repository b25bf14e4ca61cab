"""Quality scores: gradients, scores against a plain convolution, held-out accuracy, and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import bytecnn

DATA = "/root/testdata/sf0.01"


def plain_score(net, text: bytes) -> float:
    """One text, position by position."""
    p, gap = net.p, bytes(bytecnn.WIDTH - 1)
    n = -(-(len(text) + 2 * len(gap)) // bytecnn.BLOCK)
    raw = gap + text + bytes(n * bytecnn.BLOCK - len(text)) + gap
    out = [p["fb"] + sum(p["byte"][raw[i + j]] @ p["filter"][j] for j in range(bytecnn.WIDTH)) for i in range(n * bytecnn.BLOCK)]
    size = bytecnn.CHUNK_BLOCKS
    starts = [0] if n <= size else sorted({*range(0, n - size, bytecnn.STEP), n - size})
    hidden = []
    for s in starts:
        best = np.max(out[s * bytecnn.BLOCK : (s + size) * bytecnn.BLOCK], axis=0)
        x = np.r_[np.maximum(best, 0), min(1, len(text) / (bytecnn.BLOCK * size))]
        hidden.append(np.tanh(x @ p["w1"] + p["b1"]))
    z = np.r_[np.max(hidden, axis=0), np.mean(hidden, axis=0)] @ p["w2"] + p["b2"][0]
    return 1 / (1 + np.exp(-z))


def test_scores_equal_a_plain_convolution_whatever_the_neighbours():
    net = bytecnn.ByteCnn(3)
    net.p["fb"] += np.float32(0.1)
    g = np.random.default_rng(1)
    texts = [b"", b"a", bytes(g.integers(1, 256, 53, dtype=np.uint8))] + [bytes(g.integers(1, 256, n, dtype=np.uint8)) for n in (54, 200, 246, 247, 300, 511, 1000, 3000)]
    want = [plain_score(net, t) for t in texts]
    scorer = bytecnn.Scorer(net)
    assert np.allclose(scorer.scores(texts), want, atol=1e-4)
    assert np.allclose(scorer.scores(texts[::-1]), want[::-1], atol=1e-4)
    assert np.allclose([scorer.scores([t])[0] for t in texts], want, atol=1e-4)


def test_the_end_of_a_very_long_text_counts():
    net = bytecnn.ByteCnn(3)
    net.p["filter"][:] = 0
    net.p["filter"][:, :, 0] = net.p["byte"][ord("~")]  # one filter looks for ~~~~~~
    net.p["w1"][:], net.p["w2"][:] = 0, 0
    net.p["w1"][0, 0], net.p["w2"][0] = 0.01, 50
    scorer = bytecnn.Scorer(net)
    low, high = scorer.scores([b"a" * 3_000_000, b"a" * 3_000_000 + b"~" * 6])
    assert high > low + 1e-3


def test_gradients_are_those_of_the_loss():
    net = bytecnn.ByteCnn(5)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g = np.random.default_rng(2)
    texts = [bytes(g.integers(97, 123, n, dtype=np.uint8)) for n in (10, 90, 400, 700)]
    y = np.array([0, 1, 1, 0], np.float32)
    _, grad = net.gradients(texts, y)
    for name in net.p:
        flat, gr = net.p[name].reshape(-1), grad[name].reshape(-1)
        for i in np.argsort(-np.abs(gr))[:4]:
            if name == "byte" and i < bytecnn.DIM:
                continue
            kept, eps = flat[i], 1e-5
            flat[i] = kept + eps
            up = net.gradients(texts, y)[0]
            flat[i] = kept - eps
            down = net.gradients(texts, y)[0]
            flat[i] = kept
            assert (up - down) / (2 * eps) == pytest.approx(gr[i], rel=0.05, abs=1e-4), name


def test_held_out_rows_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(bytecnn, "UPDATES", 250)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = bytecnn.op11_quality(spark, DATA).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    good, junk = ([r for r in held if labels[r.doc_id] == q] for q in (1, 0))
    assert sum(r.predicted for r in good) >= 0.95 * len(good)
    assert sum(r.predicted == 0 for r in junk) >= 0.8 * len(junk)


def test_labels_without_documents_with_both_values_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "x") for i in range(60)] + [(None, "no id", "x"), (7, "a text 7", "x"), (9, None, "y")], "doc_id bigint, text string, __y string")
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(10_000 + i, i % 2) for i in range(3000)] + [(ids[0], 1), (ids[0], 0), (None, 1), (ids[1], None), (ids[2], 7)], "doc_id bigint, quality int")
    rows = bytecnn.sample(docs, labels, "quality", 3, 1000)
    assert sorted(y for _, y in rows) == [0, 0, 0, 1, 1, 1]
    every = bytecnn.sample(docs, labels, "quality", 1000, 1000)
    assert len(every) == len(ids) - 1 and (b"text %d" % ids[0]) not in [t for t, _ in every]
    assert bytecnn.fit(docs, labels.filter("quality = 1")) == 1.0 and bytecnn.fit(docs, labels.filter("doc_id < 0")) == 0.5


def test_empty_table_clashing_names_and_repeated_rows(spark):
    net = bytecnn.ByteCnn(3)
    docs = spark.createDataFrame([(1, "a", 5, 6), (1, "a", 5, 6), (None, None, None, None), (2, "", 5, 6)], "doc_id bigint, text string, score int, _score int")
    kept = bytecnn.keep_good(docs, net, 0.0)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert bytecnn.keep_good(docs.limit(0), net).count() == 0
    one = docs.select(bytecnn.score_column(F.col("text"), net).alias("s")).collect()
    assert one[0].s == one[1].s and one[2].s == one[3].s
