import random
import zlib

import numpy as np

from plumbline.llm import toxicity


def corpus(n, seed):
    r = random.Random(seed)
    syllables = ["an", "re", "th", "on", "ti", "er", "ou", "st", "ing", "ed"]
    rows = []
    for i in range(n):
        w = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 160))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(2, len(w) // 20)):
                w.insert(r.randrange(len(w) + 1), "vequ" + r.choice(syllables))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_held_out_accuracy_and_leaks(spark):
    rows = corpus(600, 1) + [(900, "", 0), (901, None, 0)]
    docs = spark.createDataFrame([(i, t, "en", 3.0) for i, t, _ in rows], "doc_id long, text string, score string, toxic double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 900] + [(None, 1), (5, None)], "doc_id long, toxic int")
    net = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in docs.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.score_column(toxicity.text_of(docs), net).alias("s")).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.s <= 1 for i, r in got.items())
    held = [(got[i].s >= 0.5, y) for i, _, y in rows if i < 900 and got[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert got[900].s == got[901].s < 0.5
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {900, 901} <= {r.doc_id for r in kept.collect()}


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels.limit(0)) == 0.0
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == 1
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0


def test_gradients():
    g, net = np.random.default_rng(0), toxicity.BiGru(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = g.standard_normal((5, 3, 6 * toxicity.HIDDEN))
    mask = np.arange(5)[:, None] < np.array([5, 3, 4])
    d = np.array([1.0, -2.0, 0.5])
    logit, saved = net.forward(x, mask, keep=True)
    grad, dx = net.backward(d, saved)
    value = lambda: float(net.forward(x, mask) @ d)
    for name in ("uf", "ub", "wa", "va", "wo", "bo"):
        w = net.p[name]
        at = tuple(int(g.integers(s)) for s in w.shape)
        old, eps = w[at], 1e-3
        w[at] = old + eps
        up = value()
        w[at] = old - eps
        down = value()
        w[at] = old
        assert abs((up - down) / (2 * eps) - grad[name][at]) < 2e-3
    dx = dx * mask[:, :, None]
    for at in ((0, 0, 3), (2, 1, 30), (4, 0, 20), (4, 2, 5)):
        old, eps = x[at], 1e-3
        x[at] = old + eps
        up = value()
        x[at] = old - eps
        down = value()
        x[at] = old
        assert abs((up - down) / (2 * eps) - dx[at]) < 2e-3


def test_every_window_counts():
    assert toxicity.windows_of(0) == [0] and toxicity.windows_of(48) == [0]
    for n in (49, 80, 81, 500):
        covered = {i for s in toxicity.windows_of(n) for i in range(s, s + toxicity.WINDOW)}
        assert covered == set(range(n))


def test_scores_do_not_depend_on_neighbours():
    net = toxicity.BiGru(1)
    net.word += np.random.default_rng(2).standard_normal(net.word.shape).astype(np.float32)
    texts = [t for _, t, _ in corpus(30, 4)] + [""]
    together = toxicity.Scorer(net).scores(texts)
    alone = [toxicity.Scorer(net).scores([t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_labels_without_documents_do_not_use_up_the_bound(spark):
    rows = corpus(40, 9)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(10_000 + i, i % 2) for i in range(5000)], "doc_id bigint, toxic int")
    assert sorted(y for _, y in toxicity.sample(docs, labels, "toxic", 3, 10_000)) == [0, 0, 0, 1, 1, 1]
    both = labels.unionByName(spark.createDataFrame([(i, 1 - y) for i, _, y in rows], "doc_id bigint, toxic int"))
    assert toxicity.sample(docs, both, "toxic", 3, 10_000) == []
