import random

from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import decontam, packing, similar, substring, toxicity
from plumbline.llm.common import table

from . import test_decontam, test_similar

SF = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_table(spark):
    docs = table(spark, SF, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SF), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] and counts[2] > 0.4 * counts[0]
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "text of nobody", "en", "s", 3), (3, "word " * 50000, "en", "s", 1), (4, "word " * 50000, "en", "s", 1), (5, "a b", "en", "s", 3), (5, "a b", "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        d = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            d = corpus_pipeline.written(stage(spark, d, SF), name)
        assert d.count() == 0 if empty else d.count() >= 4


def words(r, n):
    return ["".join(r.choice("bcdfghjklmnpqrst") for _ in range(7)) for _ in range(n)]


def planted(spark):
    """(doc_id, text, source) rows with copies, near copies, shared passages, test items, repeated and null ids."""
    r = random.Random(21)
    items = [x.text for x in table(spark, SF, "benchmark").orderBy("item_id").collect() if len((x.text or "").split()) >= 20][:3]
    base, other, p, q = words(r, 60), words(r, 90), words(r, 70), words(r, 55)
    near = list(base)
    near[30] = "changed"
    rows = [(1, base), (5, base), (7, near), (5, other), (5, None), (None, base), (None, words(r, 40))]
    rows += [(10, words(r, 30) + p + words(r, 12)), (11, words(r, 9) + p + words(r, 25)), (11, words(r, 80)), (12, q + words(r, 66)), (None, words(r, 20) + q), (13, p[:49] + words(r, 20))]
    rows += [(20 + k, words(r, 15) + i.split()) for k, i in enumerate(items)] + [(30, words(r, 900) + items[0].split()[:13])]
    return [(i, t if t is None else " ".join(t), f"s{k % 3}") for k, (i, t) in enumerate(rows)]


def by_id(row):
    return (row[0] is None, row[0] or 0)


def without_passages(rows):
    """Plain: each later text loses the runs of 50 words or more that it shares with an earlier one."""
    order = sorted(range(len(rows)), key=lambda k: (by_id(rows[k]), k))
    texts = [(t or "").split() for _, t, _ in rows]
    out = []
    for at, k in enumerate(order):
        lost = set()
        for e in order[:at]:
            a, b = texts[e], texts[k]
            for i in range(len(b) - 49):
                for j in range(len(a) - 49):
                    if b[i : i + 50] == a[j : j + 50]:
                        lost |= set(range(i, i + 50))
        kept = [w for i, w in enumerate(texts[k]) if i not in lost]
        if kept or not lost:
            out.append((rows[k][0], " ".join(kept) if rows[k][1] is not None else None, rows[k][2]))
    return out


def test_stages_against_plain_versions(spark):
    rows = planted(spark)
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    stages = dict(corpus_pipeline.STAGES)
    plain = lambda df: sorted(((x.doc_id, x.text and " ".join(x.text.split()), x.source) for x in df.collect()), key=str)
    heads = test_similar.brute(sorted([(i, t) for i, t, _ in rows], key=by_id))
    ordered = sorted(rows, key=by_id)
    want = [ordered[k] for k in sorted(set(heads))]
    d = corpus_pipeline.written(stages["simhash_near_dedup"](spark, docs, SF), "near")
    assert plain(d) == sorted(want, key=str) and len(want) == len(rows) - 3
    d = corpus_pipeline.written(stages["substring_dedup"](spark, d, SF), "passages")
    want = without_passages(want)
    assert plain(d) == sorted(want, key=str)
    items = [(x.item_id, x.text) for x in table(spark, SF, "benchmark").collect()]
    clean = []
    for i, t, s in want:
        n, hit, _ = test_decontam.brute(t, items)
        if not (hit and 20 * hit >= n):
            clean.append((i, t, s))
    d = corpus_pipeline.written(stages["benchmark_decontamination"](spark, d, SF), "clean")
    assert plain(d) == sorted(clean, key=str) and 0 < len(clean) < len(want)
    bins = {}
    for x in stages["best_fit_packing"](spark, d, SF).collect():
        bins.setdefault(x.bin_id, []).append(x)
    size = {i: sum(x["size"] for b in bins.values() for x in b if x.doc_id == i) for i, _, _ in clean}
    assert size == {i: sum(len((t or "").split()) for j, t, _ in clean if j == i) for i, _, _ in clean}
    assert all(sum(x["size"] for x in b) <= packing.CAPACITY for b in bins.values())


def test_toxic_rows_against_single_scores(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "UPDATES", 60)
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    net = toxicity.fit(docs, labels)
    want = [x.doc_id for x in docs.collect() if toxicity.Scorer(net).scores([x.text or ""])[0] < 0.5]
    assert sorted(x.doc_id for x in corpus_pipeline.toxic(spark, docs, SF).collect()) == sorted(want)


def test_columns_with_inner_names_pass_through_every_stage(spark):
    """Names that the stages use inside are a user's as well."""
    inner = ["__score", "score", "__hit", "hit", "__spans", "__number", "cuts", "document_number", "row_number", "__n", "__id"]
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join(words[20 * k : 20 * k + 90]) for k in range(12)] + [None, ""]
    rows = [(k, t, *[f"{c}-{k}" for c in inner]) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in inner))
    benchmark = spark.createDataFrame([("b", " ".join(words[300:313]))], "item_id string, text string")
    for stage in (lambda d: toxicity.drop_toxic(d, None, net=0.0), similar.drop_near_duplicates, substring.drop_passages, lambda d: decontam.decontaminate(d, benchmark, max_span=13)):
        out = stage(docs)
        assert out.columns == docs.columns
        kept = out.collect()
        assert kept and all(r[c] == f"{c}-{r.doc_id}" for r in kept for c in inner)
    assert packing.pack(packing.items_of(docs.withColumns({"source": F.lit("s")}))).count() >= len(texts) - 2
