import random

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import substring

SCHEMA = "doc_id long, text string, doc long, ref long, h string"


def words(r, n):
    return ["".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(2, 8))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "h") for i, t in rows], SCHEMA)


def test_planted_passages(spark):
    r = random.Random(2)
    exact, fuzzy = words(r, 60), words(r, 120)
    edited = list(fuzzy)
    for k in (20, 47, 80):
        edited[k] = "zz"
    del edited[60]
    rows = [(1, words(r, 40) + exact + words(r, 30)), (2, words(r, 10) + exact), (3, words(r, 5) + fuzzy + words(r, 5)), (4, edited), (5, words(r, 400)), (6, exact[:30] + words(r, 50))]
    got = {(x.doc_id, x.src_doc_id): x for x in substring.passages(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()}
    assert set(got) == {(2, 1), (4, 3)}
    assert (got[2, 1].start, got[2, 1].stop, got[2, 1].src_start, got[2, 1].src_stop, got[2, 1].identity) == (10, 70, 40, 100, 1.0)
    assert (got[4, 3].start, got[4, 3].stop, got[4, 3].src_start, got[4, 3].src_stop) == (0, 119, 5, 125)
    assert 0.95 < got[4, 3].identity < 1


def test_one_passage_in_many_documents_is_linear(spark):
    r = random.Random(4)
    p = words(r, 55)
    rows = [(i, " ".join(words(r, 8) + p + words(r, 8))) for i in range(50)]
    got = substring.passages(frame(spark, rows)).collect()
    assert sorted((x.doc_id, x.src_doc_id) for x in got) == [(i, 0) for i in range(1, 50)]
    cut = {x.doc_id: x.text for x in substring.drop_passages(frame(spark, rows)).collect()}
    assert cut[0] == rows[0][1] and all(len(cut[i].split()) == 16 for i in range(1, 50))


def test_chain_against_brute_force():
    r = random.Random(6)
    for _ in range(60):
        pts = sorted({(r.randrange(40), r.randrange(40)) for _ in range(r.randint(1, 25))}, key=lambda p: (p[0], -p[1]))
        x, y = [p[0] for p in pts], [p[1] for p in pts]
        best = []
        for i in range(len(x)):
            along = [best[j] - substring.GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
            best.append(substring.SEED_SCORE + max([0, *along]))
        path = substring.chain(x, y)[0]
        assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(path, path[1:]))
        score = substring.SEED_SCORE * len(path) - substring.GAP_COST * (x[path[-1]] - x[path[0]] + y[path[-1]] - y[path[0]])
        assert abs(score - max(best)) < 1e-9
        assert sorted(i for p in substring.chain(x, y) for i in p) == list(range(len(x)))


def test_exact_runs_share_a_seed():
    import numpy as np

    r = random.Random(8)
    run = words(r, substring.K + substring.WINDOW - 1)
    seen = []
    for _ in range(2):
        w, _ = substring.word_hashes(" ".join(words(r, 50) + run + words(r, 50)).encode())
        h, _ = substring.minimisers(w, np.zeros(len(w), np.int64))
        seen.append(set(h.tolist()))
    assert seen[0] & seen[1]


def test_odd_rows(spark):
    r = random.Random(9)
    long = " ".join(words(r, 20000))
    rows = [(1, long), (2, long), (3, None), (4, ""), (None, long), (5, "the " * 5000), (6, "the " * 5000), (6, "the " * 5000), (7, " \n\t ")]
    found = substring.passages(frame(spark, rows)).collect()
    got = {(x.doc_id, x.src_doc_id): x.n_words for x in found}
    assert got[2, 1] == 20000 and got[None, 1] == 20000 and (6, 5) in got and all(a is None or a >= b for a, b in got)
    kept = substring.drop_passages(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "doc", "ref", "h"]
    assert sorted((x.doc_id or -1) for x in kept.collect() if x.doc_id != 6) == [1, 3, 4, 5, 7]
    assert substring.passages(frame(spark, rows).limit(0)).collect() == []


def test_rows_of_one_id_are_cut_one_by_one(spark):
    r = random.Random(10)
    p, other = words(r, 80), words(r, 120)
    rows = [(1, p), (2, p + words(r, 9)), (2, words(r, 5)), (2, None), (2, other), (None, p + ["end"]), (None, words(r, 70))]
    left = substring.drop_passages(frame(spark, [(i, t and " ".join(t)) for i, t in rows])).collect()
    want = [(1, 80), (2, 9), (2, 5), (2, 0), (2, 120), (None, 1), (None, 70)]
    assert sorted(((x.doc_id, len((x.text or "").split())) for x in left), key=str) == sorted(want, key=str)


def test_recall_of_substituted_passages(spark):
    r = random.Random(16)
    rows, share = [], (0.05, 0.1, 0.15, 0.18)
    for k, s in enumerate(share):
        for j in range(60):
            p = words(r, 100)
            q = list(p)
            for i in r.sample(range(100), round(100 * s)):
                q[i] = words(r, 1)[0]
            at = 1000 * k + 2 * j
            rows += [(at, words(r, 30) + p + words(r, 30)), (at + 1, words(r, 50) + q + words(r, 10))]
    got = {(x.doc_id, x.src_doc_id) for x in substring.passages(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()}
    assert all(a - b == 1 and b % 2 == 0 for a, b in got)
    for k in range(len(share)):
        assert sum((1000 * k + 2 * j + 1, 1000 * k + 2 * j) in got for j in range(60)) >= 54, share[k]


def test_any_ids(spark):
    r = random.Random(11)
    p = " ".join(words(r, 70))
    rows = [(-(2**62), p), (-5, " ".join(words(r, 70))), (2**62, p + " tail"), (2**63 - 1, p)]
    got = substring.passages(frame(spark, rows)).collect()
    assert sorted((x.doc_id, x.src_doc_id, x.n_words) for x in got) == [(2**62, -(2**62), 70), (2**63 - 1, -(2**62), 70)]


def test_insertions_do_not_end_a_passage(spark):
    r = random.Random(12)
    rows, want = [], set()
    for k, n in enumerate((13, 20, 50, 100, 200)):
        s, p, whole = words(r, 30), words(r, 60), words(r, 1000)
        rows += [(4 * k, s + p), (4 * k + 1, s + words(r, n) + p), (4 * k + 2, whole), (4 * k + 3, whole[:100] + words(r, n) + whole[100:])]
        want |= {(4 * k + 1, 30 + n, 90 + n, 30, 90), (4 * k + 3, 0, 100, 0, 100), (4 * k + 3, 100 + n, 1000 + n, 100, 1000)}
    got = substring.passages(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()
    assert {(x.doc_id, x.start, x.stop, x.src_start, x.src_stop) for x in got} == want


def test_short_parts_around_a_gap_are_one_passage_and_bad_stretches_go():
    r = random.Random(13)
    s, p = words(r, 40), words(r, 40)
    a, b = s + words(r, 15) + p, s + p
    assert substring.parts(substring.align(a, b, [2, 60], [2, 45]), 50, 0.8) == [(0, 95, 0, 80, 80)]
    runs = [(0, 0, 60), *[(60 + k, 60 + k, 1) for k in range(1, 120, 2)]]
    (x0, x1, _, _, same), *rest = substring.parts(runs, 50, 0.8)
    assert (x0, rest) == (0, []) and x1 >= 60 and same / x1 >= 0.8


def test_earlier_owners_of_single_words_do_not_hide_a_passage(spark):
    r = random.Random(14)
    p = words(r, 60)
    rows = [(1, p[:30]), (2, p[30:]), (5, p), (6, p[:30] + words(r, 20)), (7, words(r, 20) + p[30:]), (9, words(r, 9) + p)]
    q = words(r, 60)  # its source has parts of it once more, before and behind
    rows += [(20, [w for k in range(0, 48, 12) for w in [*q[k : k + 8], *words(r, 6)]] + q + q[50:58]), (21, q)]
    got = {(x.doc_id, x.src_doc_id): (x.start, x.stop, x.src_start, x.src_stop) for x in substring.passages(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()}
    brute = {(i, j) for i, a in rows for j, b in rows if j < i and any(" ".join(a[k : k + 50]) in " ".join(b) for k in range(len(a) - 49))}
    assert set(got) == brute == {(9, 5), (21, 20)}
    assert got[9, 5] == (9, 69, 0, 60)


def test_matches_against_brute_force(spark):
    r = random.Random(15)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randint(20, 60)))) for i in range(40)]
    docs = frame(spark, rows).select(F.col("doc_id").alias("id"), "text")
    by = {}
    for s in substring.seeds(docs).collect():
        by.setdefault(s.h, []).append(divmod(s.at, 1 << substring.POS_BITS))
    want = []
    for places in by.values():
        places.sort()
        ids = sorted({d for d, _ in places})
        for d, x in places:
            if d != ids[0]:
                want.append((d, *places[0], x, True))
                refs = [max(q for q in places if q[0] == e) for e in ids[: ids.index(d)][-substring.BEFORE :]]
                want += [(d, *q, x, False) for q in refs if q != places[0]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = [(m.doc, m.ref, m.y, m.x, m.least) for m in substring.matches(docs).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == sorted(want)


def test_a_passage_is_found_however_many_runs_lie_around_it():
    """The best stretch of an alignment of many runs is that of all pairs of runs."""
    r = random.Random(6)

    def all_pairs(x, ex, y, ey, done, least, identity):
        best = None
        for f in range(len(x)):
            for t in range(f, len(x)):
                wide, high, same = ex[t] - x[f], ey[t] - y[f], done[t + 1] - done[f]
                if wide >= least and round((same - identity * wide) * 1e6) >= 0 and round((same - identity * high) * 1e6) >= 0:
                    best = min(best or (0, 0, 0), (-wide, f, t))
        return (best[1], best[2] + 1) if best else None

    for n in (1, 30, 64, 65, 130):
        for _ in range(8):
            words = np.array([r.randint(1, 6) for _ in range(n)])
            x, y = (np.cumsum([r.randint(0, 3) for _ in range(n)]) + np.r_[0, np.cumsum(words)[:-1]] for _ in range(2))
            args = (x, x + words, y, y + words, np.r_[0, np.cumsum(words)], r.choice((5, 20)), r.choice((0.7, 0.8)))
            assert substring.longest(*args) == all_pairs(*args)
    # 56 of 68 words are equal amid thousands of runs that are half equal
    runs, at = [], 0
    for k in range(3000):
        wide = 3 if 1500 <= k < 1514 else 1
        runs.append((at, at, wide))
        at += wide + (1 if wide == 3 else 2)
    found = substring.parts(runs, 50, 0.7)
    assert any(a <= 1500 * 3 and b >= 1500 * 3 + 55 for a, b, *_ in found)


def test_an_edit_beside_the_edge_of_a_passage():
    a = [f"w{i}" for i in range(60)]
    b = [*a[:57], "other", a[58], "x", "y"]
    assert substring.walk(a, b)[-1] == (58, 58, 1)


def test_other_documents_that_hold_the_halves_do_not_hide_a_source(spark):
    r = random.Random(31)
    p = words(r, 90)
    halves = {i: p[:45] if i % 2 else p[45:] for i in (1, 2, 4, 5, 6, 7, 9, 10, 11, 12)}
    rows = [(i, " ".join(words(r, 20) + halves.get(i, p) + words(r, 20))) for i in range(1, 14)]  # 3, 8 and 13 hold the whole
    got = {(x.doc_id, x.src_doc_id): (x.start, x.stop, x.src_start, x.src_stop) for x in substring.passages(frame(spark, rows)).collect()}
    assert (8, 3) in got and (13, 3) in got and set(got) <= {(8, 3), (13, 3), (13, 8)} and set(got.values()) == {(20, 110, 20, 110)}


def test_surroundings_of_a_passage_are_alike():
    r = np.random.default_rng(7)
    least = substring.least_common(50, 0.8)
    assert least == (40, 19)
    text = r.integers(0, 65536, (300, 50)).astype(np.uint16)
    own, others = [], []
    for w in text:  # ten words replaced or left out anywhere, strange words around
        other = w.copy()
        other[r.choice(50, 10, replace=False)] = r.integers(0, 65536, 10)
        if len(own) % 2:
            other = np.delete(w, r.choice(50, 10, replace=False))
        own.append(np.r_[r.integers(0, 65536, 20), w].astype(np.uint16).tobytes())
        others.append(np.r_[other, r.integers(0, 65536, 30)].astype(np.uint16).tobytes())
    n = np.arange(300)
    assert substring.alike(own, n + 1, others, n, least) == {(i + 1, i) for i in range(300)}


def test_the_same_words_in_another_order_are_no_surroundings_of_a_passage():
    r = np.random.default_rng(8)
    w = r.integers(0, 65536, 60).astype(np.uint16)
    blocks = np.concatenate([w[k : k + 6] for k in range(54, -1, -6)])  # 60 words and 50 pairs of neighbours are the same
    assert substring.alike([w.tobytes()], np.array([2]), [blocks.tobytes()], np.array([1]), substring.least_common(50, 0.8)) == set()


def test_left_out_sources_behind_a_common_line_and_runs_of_one_word(spark):
    r = random.Random(33)
    line, p, q = words(r, 14), words(r, 60), words(r, 30)
    rows = [(i, line + words(r, 60)) for i in range(40)]  # the line alone is no passage, and its first and last owners are others
    rows += [(i, words(r, 20) + ["the"] * 20 + words(r, 40)) for i in range(60, 70)]
    rows[20] = (20, line + p)
    rows[35] = (35, words(r, 7) + line + p)
    rows[44] = (64, q + ["the"] * 24 + words(r, 10))
    rows += [(80, words(r, 9) + q + ["the"] * 22 + words(r, 20)), *[(90 + i, words(r, 20) + ["the"] * 20) for i in range(4)]]
    got = {(x.doc_id, x.src_doc_id) for x in substring.passages(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()}
    assert got == {(35, 20), (80, 64)}


def test_edited_copies_with_left_out_sources_give_rows_in_proportion(spark):
    r = random.Random(41)
    lines, rows, whole = [words(r, 14) for _ in range(5)], [], []
    for i in range(60):  # two documents with the lines apart lie between any two that hold all together
        text = words(r, 5)
        for line in lines:
            text += line + words(r, 1 if i % 3 == 2 else 60)
        rows.append((i, " ".join(text)))
        whole += [i] * (i % 3 == 2)
    found = substring.passages(frame(spark, rows)).collect()
    for i in whole[1:]:
        assert len({w for x in found if x.doc_id == i for w in range(x.start, x.stop)}) >= 70
    assert {x.doc_id for x in found} <= set(whole[1:]) and len(found) <= 4 * len(whole)


def test_a_run_of_one_word_is_no_surroundings_of_a_passage():
    r = np.random.default_rng(9)
    own, other = (np.r_[r.integers(2, 65536, 45), np.full(41, 7), r.integers(2, 65536, 20)].astype(np.uint16) for _ in range(2))
    same = own.copy()
    same[[60, 90, 95]] = 9
    test = substring.around_anchors([[own], [other, same]], (np.array([45]), np.array([45, 45])), 50, 0.8)
    assert test(np.array([0, 0]), np.array([0, 1])).tolist() == [False, True]


def test_long_runs_of_one_word_are_covered_whole_by_an_earlier_one(spark):
    r = random.Random(45)
    rows = [(i, words(r, 9) + ["and"] * n + words(r, 9)) for i, n in enumerate((52, 70, 300, 58, 64, 61, 55, 40))]
    rows += [(20, words(r, 30) + ["and"] * 333 + words(r, 30) + ["and"] * 75), (21, words(r, 5) + ["or"] * 90)]
    found = substring.passages(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()
    lost = {(i, k) for i, w in rows[1:9] for k, x in enumerate(w) if x == "and" and i != 7} - {(x.doc_id, k) for x in found for k in range(x.start, x.stop)}
    assert not lost and all(x.doc_id > x.src_doc_id for x in found) and {x.doc_id for x in found} == {*range(1, 7), 20}
    text = {i: " ".join(w).split() for i, w in rows}
    assert all(text[x.doc_id][x.start : x.stop] == text[x.src_doc_id][x.src_start : x.src_stop] for x in found if x.identity == 1)


def test_counts_of_shared_pairs_against_brute_force():
    r = np.random.default_rng(11)
    for rows, cols, kinds in ((40, 60, 30), (300, 400, 3000), (5, 3, 2)):
        own, others = ((np.sort(r.integers(0, n, 20 * n)), r.integers(0, kinds, 20 * n).astype(np.uint32)) for n in (rows, cols))
        held = [set(others[1][others[0] == j].tolist()) for j in range(cols)]
        count = np.array([[sum(v in s for v in own[1][own[0] == i].tolist()) for s in held] for i in range(rows)])
        for least in (1, 3, 15):
            assert set(zip(*(v.tolist() for v in substring.shared_pairs(own, others, (rows, cols), least)))) == set(zip(*(v.tolist() for v in np.nonzero(count >= least))))


def test_a_stretch_through_a_k_mer_against_all_stretches():
    r = random.Random(46)
    for _ in range(300):
        left, right = ([0] for _ in range(2))
        for side, n in ((left, 45), (right, 75)):
            share = r.choice((0.5, 0.7, 0.8, 0.9))
            for _ in range(r.randint(0, n)):
                side.append(side[-1] + (r.random() < share))
        want = any(i + 5 + j >= 50 and a + 5 + b >= 0.8 * (i + 5 + j) - 1e-9 for i, a in enumerate(left) for j, b in enumerate(right))
        assert substring.through(left, right, 50, 0.8) == want
