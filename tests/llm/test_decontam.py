import random
import re

from plumbline.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text, items):
    low = lambda t: WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    words, hit, found = low(text), set(), set()
    for name, t in items:
        w = low(t)
        n = min(13, len(w))
        wins = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, items int")
    return d, spark.createDataFrame(items, "item_id long, text string")


def random_case(seed):
    r = random.Random(seed)
    vocab = ["a", "b", "c", "dé", "E1"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([0, 1, 3, 12, 13, 14, 30])))) for i in range(12)] + [(50, None), (3, "a b, c-dé")]
    docs = []
    for i in range(80):
        w = [r.choice([*vocab, "x", "y", "z"]) for _ in range(r.randint(0, 60))]
        if i % 3 == 0 and items[i % 12][1]:
            w[len(w) // 2 : len(w) // 2] = items[i % 12][1].split()
        docs.append((i, r.choice([" ", ", ", "\n"]).join(w)))
    return docs + [(90, None), (91, ""), (91, ""), (None, "a b c dé")], items


def check(spark, docs, items, got):
    want = sorted((str(i), *brute(t, items)) for i, t in docs)
    assert sorted((str(r.doc_id), r.h.n_words, r.n, list(r.h["items"])) for r in got) == want


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs, items = random_case(seed)
        items = [x for x in items if x[1] is None or len(x[1].split()) != 1 or seed == 2]
        d, b = tables(spark, docs, items)
        got = decontam.with_hits(d, b).select("doc_id", "__hit", decontam.n_hit().alias("n")).withColumnRenamed("__hit", "h").collect()
        check(spark, docs, items, got)


def test_several_passes_agree(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SHARD_WORDS", 10)
    monkeypatch.setattr(decontam, "PASS_WINDOWS", 40)
    monkeypatch.setattr(decontam, "GROUP_DOCS", 5)
    docs, items = random_case(3)
    d, b = tables(spark, docs, items)
    got = decontam.with_hits(d, b).select("doc_id", "__hit", decontam.n_hit().alias("n")).withColumnRenamed("__hit", "h").collect()
    check(spark, docs, items, got)


def test_rule_and_cut(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = [(1, item), (2, " ".join(["w"] * 800) + ", " + item + ". tail"), (3, "clean text"), (4, None), (5, "")]
    d, b = tables(spark, docs, [(1, item)])
    kept = {r.doc_id: r.text for r in decontam.decontaminate(d, b).collect()}
    assert set(kept) == {2, 3, 4, 5} and kept[2] == docs[1][1]
    assert decontam.decontaminate(d, b).columns == d.columns
    cut = {r.doc_id: r.text for r in decontam.decontaminate(d, b, max_span=13).collect()}
    assert cut[2] == " ".join(["w"] * 800) + ", . tail" and cut[3] == "clean text"
    assert decontam.decontaminate(d, b.limit(0)).count() == 5 and decontam.decontaminate(d.limit(0), b).count() == 0
