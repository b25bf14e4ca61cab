import ast
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import tokens

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


def texts():
    r = random.Random(1)
    out = ["", None, " ", "a  b", "\n\n Z", "x\n\n\ny", "tab\tb", "<|endoftext|> hi", "we'll go, 'tis 4.0.", "日本語 😀\nx", "a\xa0b \xa0c", "word, " * 3000, "em***, en&&&."]
    for _ in range(300):
        out.append("".join(r.choice(["a", "Bc ", " ", "\n", "\t", "é", "12", "'s", ".", ",", "!", "<|", " Zoo"]) for _ in range(r.randrange(1, 14))))
    return out


def test_pieces_equal_the_tokenizer():
    p = tokens.Pieces(PATH)
    t = [x or "" for x in texts()]
    t += ["a\x01b c", "x \n y", "ß.ä, Ünder..", "don't 3,000. 中文, x", "\nlead\n\nb", "end\n", "x.,! y", "٠١. d", "is'nt ''s s'' it's.", "a<|b <|endoftext|>", "é,ñ.", "word!? Ende)."]
    for x, ids in zip(t + t, [*p.ids(pa.array(t)), *p.ids(pa.array(["first", *t]).slice(1))]):
        assert list(ids) == p.tok.encode(x, add_special_tokens=False).ids, repr(x)


def test_blocks_round_trip_and_checkpoints():
    g = np.random.default_rng(1)
    ids = np.minimum(g.geometric(0.01, 600_000), 4999).astype(np.int64)
    coder = tokens.Coder(tokens.frequencies(np.bincount(ids[:1000], minlength=5000)))
    for n in (1, tokens.LANES, tokens.LANES + 1, 300_000, 524_288):
        raw = coder.encode(ids[:n])
        parts, _, end = coder.stretches(raw, 0)
        assert end == len(raw)
        each = [coder.decode(*x) for x in reversed(parts)][::-1]  # any order: stretches are independent
        assert (np.concatenate(each) == ids[:n]).all()
    bad = bytearray(coder.encode(ids[:5000]))
    bad[-3] ^= 1
    with pytest.raises(ValueError):
        coder.stretches(bytes(bad), 0)


def test_query_form_against_brute_force(spark):
    rows = [(i * 3 % 331, t) for i, t in enumerate(texts())] + [(None, "none"), (7, "again"), (7, "once more"), (None, "other"), (7, "again")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int").coalesce(1)
    made = tokens.written(tokens.tokenised(docs, PATH), "ids")
    files, coder = tokens.encode(made, 50_257)
    got = tokens.decode(files, coder).collect()
    tok, want, at = tokens.Pieces(PATH).tok, [], 0
    assert sorted((r.doc is not None, r.doc or 0) for r in got) == sorted((i is not None, i or 0) for i, _ in rows)
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(((r.doc, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda x: x[1]) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string").limit(0)
    files, coder = tokens.encode(tokens.written(tokens.tokenised(docs, PATH), "ids"), 50_257)
    assert tokens.decode(files, coder).collect() == []


def test_an_archive_is_decoded_in_a_new_process_from_its_files_alone(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())]
    made = tokens.written(tokens.tokenised(spark.createDataFrame(rows, "doc_id long, text string"), PATH), "ids")
    tokens.save(*tokens.encode(made, 50_257), str(tmp_path / "archive"))
    want = sorted((r.doc, r.start, r.n_tokens, r.ids_crc32) for r in tokens.decode(*tokens.load(spark, str(tmp_path / "archive"))).collect())
    code = """
import sys, zlib
import pyarrow.parquet as pq
from plumbline.llm import tokens
table = pq.read_table(sys.argv[1] + "/table").to_pylist()[0]
coder = tokens.Coder.from_bytes(table["frequencies"], table["name"])
rows = [x for body in pq.read_table(sys.argv[1] + "/files")["body"].to_pylist() for x in tokens.read_file(coder, body)]
print(sorted((d, s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, s, x in rows))
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "archive")], capture_output=True, text=True, env=os.environ | {"PYTHONPATH": root}, check=True).stdout
    assert ast.literal_eval(out) == want and len(want) == len(rows)


def test_another_or_a_damaged_table_is_refused():
    a, b = (tokens.Coder(tokens.frequencies(np.array(c))) for c in ([5, 1, 1], [1, 1, 9]))
    raw = tokens.make_file(a, 0, [(1, np.array([0, 1, 2, 0]))])
    assert list(tokens.read_file(a, raw)[0][2]) == [0, 1, 2, 0]
    with pytest.raises(ValueError, match="needs the frequency table"):
        tokens.read_file(b, raw)
    with pytest.raises(ValueError, match="damaged"):
        tokens.Coder.from_bytes(a.to_bytes()[:-4] + b"\1\0\0\0", a.name)
