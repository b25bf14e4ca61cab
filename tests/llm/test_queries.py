"""The registered queries without SQL, by name, over the whole smallest tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm import licences, registry, tokens
from plumbline.llm.common import table

from . import test_simhash

SF = "/root/testdata/sf0.001"
Q = registry.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def rows(spark, name):
    return Q[name](spark, SF).collect()


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in Q) == list(range(1, 14))


def test_op1_substring_dedup(spark, docs):
    words = {i: [w.lower() for w in t.split()] for i, t in docs.items() if t.isascii()}
    found = [r for r in rows(spark, "op1_substring_dedup") if r.doc_id in words and r.src_doc_id in words]
    covered = defaultdict(set)
    for r in found:
        assert r.src_doc_id < r.doc_id and r.n_words == r.stop - r.start >= 50 and 0.8 <= r.identity <= 1
        if r.identity == 1:
            assert words[r.doc_id][r.start : r.stop] == words[r.src_doc_id][r.src_start : r.src_stop]
        covered[r.doc_id].update(range(r.start, r.stop))
    first, shared = {}, 0
    for i in sorted(words):  # every run of 50 words that an earlier document has is cut
        for k in range(len(words[i]) - 49):
            run = " ".join(words[i][k : k + 50])
            if first.setdefault(run, i) != i:
                shared += 1
                assert len(covered[i].intersection(range(k, k + 50))) >= 48, (i, k)
    assert shared > 100 and any(r.identity < 1 for r in found)


def test_op3_token_ids(spark, docs):
    tok, at, want = tokens.Pieces(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")).tok, 0, []
    for i in sorted(docs):
        ids = np.array([*tok.encode(docs[i], add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op3_token_ids")) == want


@pytest.mark.parametrize("name, bound, label", [("op4_toxicity", 0.5, "toxic"), ("op11_quality", 0.3, "quality")])
def test_classifiers(spark, docs, name, bound, label):
    got = {r.doc_id: r for r in rows(spark, name)}
    assert got.keys() == docs.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= bound) for i, r in got.items())
    known = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect() if r.doc_id in got}
    learnt = [got[i].predicted == y for i, y in known.items() if not got[i].held_out]
    assert sum(learnt) > 0.85 * len(learnt)


def test_op5_licence_scan(spark, docs):
    m = licences.Matcher()
    want = sorted((i, x["licence"], x["start"], x["stop"]) for i, t in docs.items() for x in m.scan(t))
    assert sorted((r.doc_id, r.licence, r.start, r.stop) for r in rows(spark, "op5_licence_scan")) == want and want


def test_op6_best_fit_packing(spark, docs):
    parts = defaultdict(list)
    bins = defaultdict(list)
    for r in rows(spark, "op6_best_fit_packing"):
        parts[r.doc_id if "doc_id" in r else r.id].append(r)
        bins[r.bin_id].append(r)
    for i, t in docs.items():
        n = len(t.split())
        assert n == 0 or abs(sum(r.size for r in parts[i]) - n) <= 0.02 * n + 2, i
    for held in bins.values():  # what lies in a bin does not overlap
        held.sort(key=lambda r: r.start)
        assert all(a.start + a.size <= b.start for a, b in zip(held, held[1:]))


def test_op8_simhash(spark, docs):
    want = test_simhash.brute(sorted(docs.items()))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op8_simhash")} == want


def test_op10_media_chunks(spark, docs):
    for r in rows(spark, "op10_media_chunks"):
        raw = docs[r.doc_id].encode()
        padded = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
