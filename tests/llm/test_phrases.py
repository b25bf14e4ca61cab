"""Phrase mining: automata against dictionaries, the query against brute force, and odd rows."""

import random
import re
from collections import Counter

import numpy as np

from plumbline.llm import phrases, transducer
from plumbline.llm.transducer import Transducer, Union, built

SCHEMA = "doc_id bigint, text string, lang string, n int, rank string"


def automaton(counts: dict[tuple[bytes, ...], int], width: int = 4) -> Transducer:
    vocab = sorted({w for g in counts for w in g})
    rank = {w: i for i, w in enumerate(vocab)}
    rows = sorted(counts)
    grams = np.array([[rank[w] for w in g] + [-1] * (width - len(g)) for g in rows], np.int64).reshape(-1, width)
    return built(vocab, grams, np.array([counts[g] for g in rows], np.int64))


def spelled(t: Transducer, width: int = 4) -> dict:
    return {tuple(t.vocab[i] for i in g if i >= 0): int(c) for g, c in zip(*t.grams(width))}


def drawn(r, n, letters=b"abcd", width=4):
    return {tuple(bytes([r.choice(letters)]) for _ in range(r.randint(1, width))): r.randint(1, 5) for _ in range(n)}


def test_automata_keep_every_count_and_share_states(monkeypatch):
    monkeypatch.setattr(transducer, "BLOCK", 7)
    r = random.Random(1)
    for n in (0, 1, 5, 60, 200):
        counts = drawn(r, n)
        t = automaton(counts)
        assert spelled(t) == counts == spelled(Transducer.from_bytes(t.to_bytes()))
    same = {(bytes([a]), bytes([b])): 10 * a + b for a in b"abcdefgh" for b in b"xyz"}  # equal remainders once weights are pushed
    t = automaton(same, 2)
    assert spelled(t, 2) == same and t.states == 3


def test_union_sums_weights_and_drops_rare_ones():
    r = random.Random(2)
    some, total = [drawn(r, 50, b"abcdef") for _ in range(9)], Counter()
    u = Union(4, hold=40)
    for counts in some:
        total.update(counts)
        u.add(automaton(counts))
    assert spelled(u.done(6)) == {g: c for g, c in total.items() if c >= 6}
    assert spelled(Union(3).done()) == {}


def test_composition_looks_up_what_both_accept():
    r = random.Random(3)
    counts, asked = drawn(r, 150, b"abcde"), drawn(r, 150, b"cdefg", 3)
    t, a = automaton(counts), automaton(dict.fromkeys(asked, 0))
    got = {tuple(a.vocab[i] for i in g if i >= 0): int(c) for g, c in zip(*t.compose(a, 3))}
    assert got == {g: counts[g] for g in asked if g in counts}
    assert len(t.compose(automaton({}), 3)[0]) == 0 and len(automaton({}).compose(a, 3)[0]) == 0


def brute(rows, least=30, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, 5) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = {(lang, w[i : i + m]) for (lang, w), a in cand.items() for m in range(2, len(w)) for i in range(len(w) - m + 1) if 100 * a >= 80 * f[lang, w[i : i + m]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i, p.decode(), -a, lf, rf, n[lang], -s) for lang, found in out.items() for i, (s, a, p, lf, rf) in enumerate(sorted(found)[:top], 1)}


def query(spark, tmp_path, rows):
    spark.createDataFrame([(i, t, lang, 1, "x") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in phrases.op13_phrases(spark, str(tmp_path)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


def test_query_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", 3000)
    monkeypatch.setattr(phrases, "SLICE", 50)  # texts are split in many slices
    r = random.Random(4)
    words = ["The", "of", "New", "york", "É", "ñandú", "x y", "a-b", "\u0000", "z\u001c"] + [f"w{i}" for i in range(30)]
    text = lambda n: "".join(r.choice(words[: r.choice((4, 10, 40))]) + r.choice((" ", " ", "\t ", ", ", ".\n", "  ")) for _ in range(n))
    rows = [(text(r.randint(0, 80)), r.choice(("en", "en", "fr", None, ""))) for _ in range(700)]
    rows += [("new york of the w1 " * 3000, "en"), (None, "en"), ("", None), ("  ,. ", "de"), ("y" * 5000 + " the of", "fr")] + [("Same text of copies, twice over", "fr")] * 40
    got = query(spark, tmp_path, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_ties_and_the_last_rank(spark, tmp_path):
    rows = [(f"p{i} q{i}. P{i} q{i}", "en") for i in range(60) for _ in range(15)]
    docs = spark.createDataFrame([(i, *x, 1, "x") for i, x in enumerate(rows)], SCHEMA)
    got = {tuple(r) for r in phrases.mine(docs, top=50).collect()}
    assert got == brute(rows, top=50) and len(got) == 50


def test_no_text_gives_no_row(spark, tmp_path):
    assert query(spark, tmp_path, []) == []


def test_nothing_frequent_gives_no_row(spark, tmp_path):
    assert query(spark, tmp_path, [("one two three", "en"), (None, None)]) == []
