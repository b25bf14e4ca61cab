"""Phrase collocation mining on weighted acyclic automata.

Texts become shards of coded words. Level by level (one word, two, then three and four), each shard counts its n-grams, sorts them and
builds one count transducer for each prefix range; the transducers of a range are united and their weights summed, and the
n-grams below the least count are left out. A shard only counts n-grams whose parts may reach that count, by a bitmap of
fixed size that knows no false negative. The counts of a candidate's parts are looked up by composing, in
each range, an acceptor of the parts that are asked for with the range's transducers.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import spread_join, table, text_of, written
from .transducer import Transducer, Union, built, order_of, summed
from .toxicity import _Index

LONGEST, LEAST, TOP = 4, 30, 2000
#: A longer candidate with this share of a shorter one's count, in hundredths, drops it.
COVERED = 80
#: Words of a shard (texts are kept whole), and about as many of a prefix range.
SHARD_WORDS, RANGE_WORDS = 1 << 20, 1 << 22
#: n-grams that range bounds are drawn from, at most; bounds only balance the work.
BOUND_SAMPLE = 1 << 16
#: Bits of the bitmap of n-grams that may be frequent: 16 MB at most.
BITS = 1 << 27
#: Bytes of a text that are split at a time.
SLICE = 1 << 22
_CUT = b","
_TABLE = bytes(44 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
SHARD = "lang string, words bigint, vocab binary, ids binary"
AUTOMATON = "part int, lang string, automaton binary"
Bounds = list[tuple[str, bytes, bytes]]


def _slices(raw: bytes) -> Iterator[bytes]:
    """raw in slices that end at blanks or cuts; a longer word is a slice of its own."""
    at = 0
    while at < len(raw):
        end = at + SLICE
        if end < len(raw):
            last = max(raw.rfind(b" ", at, end), raw.rfind(_CUT, at, end))
            after = [p for p in (raw.find(b" ", end), raw.find(_CUT, end)) if p >= 0]
            end = last + 1 if last >= at else min(after) if after else len(raw)
        yield raw[at:end]
        at = end


class _Shards:
    """Coded words of texts, by language."""

    def __init__(self):
        self.langs: dict[str, tuple[_Index, list[np.ndarray]]] = {}
        self.words = 0

    def add(self, lang: str, text: bytes) -> None:
        index, ids = self.langs.setdefault(lang, (_Index({_CUT: 0}), []))
        for part in _slices(text.translate(_TABLE)):
            tokens = part.replace(_CUT, b" , ").split(b" ")
            tokens = [t for t in tokens if t]
            ids.append(np.fromiter(map(index.__getitem__, tokens), np.int32, len(tokens)))
            self.words += len(tokens)
        ids.append(np.zeros(1, np.int32))

    def flush(self) -> pa.RecordBatch:
        rows = []
        for lang, (index, parts) in self.langs.items():
            words = list(index)
            order = sorted(range(1, len(words)), key=words.__getitem__)
            rank = np.full(len(words), -1, np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            ids = rank[np.concatenate(parts)]
            rows.append((lang, int((ids >= 0).sum()), b"\n".join([words[i] for i in order]), ids.tobytes()))
        self.__init__()
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.large_binary(), pa.large_binary()))], names=["lang", "words", "vocab", "ids"])


def shards_of(docs: DataFrame) -> DataFrame:
    """docs (lang, text) -> shards; a null lang is `und`, a null text is empty. One text is never parted, so a shard holds at most
    SHARD_WORDS words and a text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Shards()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                held.add(lang.as_py(), text.as_py())
                if held.words >= SHARD_WORDS:
                    yield held.flush()
        if held.langs:
            yield held.flush()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), text_of(docs).cast("binary")).mapInArrow(cut, SHARD)


class Shard:
    def __init__(self, lang: str, vocab: bytes, ids: bytes):
        self.lang, self.vocab, self.ids = lang, vocab.split(b"\n") if vocab else [], np.frombuffer(ids, np.int32).astype(np.int64)

    def hashes(self) -> np.ndarray:
        seed = zlib.crc32(self.lang.encode())
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.vocab), np.uint64, len(self.vocab))

    def grams(self, level: int, seen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted n-grams of the level and their counts here. Level 2 takes those of words, level 3 those of pairs, that `seen` has."""
        ids, n = self.ids, len(self.vocab)
        if level == 1:
            count = np.bincount(ids[ids >= 0], minlength=n)
            return np.arange(n, dtype=np.int64)[:, None], count
        h = self.hashes()
        if level == 2:
            ok = np.r_[has(seen, h), False][ids]  # -1 is the last
            at = np.flatnonzero(ok[:-1] & ok[1:])
            pair, count = np.unique(ids[at] * n + ids[at + 1], return_counts=True)
            return np.stack([pair // n, pair % n], axis=1), count
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        pair, where = np.unique(ids[at] * n + ids[at + 1], return_inverse=True)
        good = has(seen, pair_hash(h[pair // n], h[pair % n])) if len(pair) else np.zeros(0, bool)
        pair, number = pair[good], np.cumsum(good) - 1
        code = np.full(len(ids) + 3, -1, np.int64)  # of the pair that begins here
        code[at[good[where]]] = number[where[good[where]]]
        three = np.flatnonzero((code[: len(ids)] >= 0) & (code[1 : len(ids) + 1] >= 0))
        four = three[code[three + 2] >= 0]
        k3, c3 = np.unique(code[three] * n + ids[three + 2], return_counts=True)
        k4, c4 = np.unique(code[four] * max(1, len(pair)) + code[four + 2], return_counts=True)
        a, b = pair[k3 // n] if len(k3) else k3, (pair[k4 // len(pair)], pair[k4 % len(pair)]) if len(k4) else (k4, k4)
        grams = np.concatenate([np.stack([a // n, a % n, k3 % n, np.full(len(k3), -1)], axis=1), np.stack([b[0] // n, b[0] % n, b[1] // n, b[1] % n], axis=1)]) if n else np.zeros((0, 4), np.int64)
        by = order_of(grams)
        return grams[by], np.concatenate([c3, c4])[by]


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return x ^ (x >> np.uint64(29))


def has(seen: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(BITS - 1)).astype(np.int64)
    return (seen[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(counts: DataFrame) -> np.ndarray:
    """Bits of the hashes of all n-grams (words or pairs) of the automata; at most BITS of them reach the driver."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw in zip(batch.column(0), batch.column(1)):
                t = Transducer.from_bytes(raw.as_py())
                grams, _ = t.grams(2)
                seed = zlib.crc32(lang.as_py().encode())
                h = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in t.vocab), np.uint64, len(t.vocab))
                h = np.where(grams[:, 1] < 0, h[grams[:, 0]], pair_hash(h[grams[:, 0]], h[grams[:, 1]])) if len(grams) else h
                at = (h & np.uint64(BITS - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 15), pa.array(at & 32767)], names=["block", "bit"])

    out = np.zeros(BITS // 8, np.uint8)
    for r in counts.select("lang", "automaton").mapInArrow(bits, "block bigint, bit bigint").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[r.block * 4096 : (r.block + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def bounds_of(shards: DataFrame) -> tuple[Bounds, int]:
    """(sorted (lang, first word, second word) where a new range begins, all words)."""
    n, words = shards.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    ranges = max(8, -(-words // RANGE_WORDS))
    each, every = max(1, BOUND_SAMPLE // max(1, n)), max(1, n // BOUND_SAMPLE)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, vocab, ids in zip(*(batch.column(i) for i in range(3))):
                if every > 1 and zlib.crc32(ids.as_py()) % every:
                    continue
                s = Shard(lang.as_py(), vocab.as_py(), ids.as_py())
                at = np.flatnonzero((s.ids[:-1] >= 0) & (s.ids[1:] >= 0))
                at = at[:: max(1, len(at) // each)][:each]
                pairs = sorted({(int(s.ids[i]), int(s.ids[i + 1])) for i in at})
                yield pa.RecordBatch.from_arrays([pa.array([s.lang] * len(pairs), pa.string()), pa.array([s.vocab[a] for a, _ in pairs], pa.binary()), pa.array([s.vocab[b] for _, b in pairs], pa.binary())], names=["lang", "a", "b"])

    rows = shards.select("lang", "vocab", "ids").mapInArrow(drawn, "lang string, a binary, b binary").distinct().collect()
    found = sorted((r.lang, bytes(r.a), bytes(r.b)) for r in rows)
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else [], ranges


def splits(bounds: Bounds, lang: str, vocab: list[bytes], grams: np.ndarray) -> list[tuple[int, int, int]]:
    """[(range, from, to)] of sorted n-grams."""
    n = len(vocab) + 1
    key = grams[:, 0] * n + (grams[:, 1] + 1 if grams.shape[1] > 1 else 0)
    lo, hi = bisect_left(bounds, (lang,)), bisect_left(bounds, (f"{lang}\0",))
    cuts = []
    for _, a, b in bounds[lo:hi]:
        r = bisect_left(vocab, a)
        exact = r < len(vocab) and vocab[r] == a
        cuts.append(r * n + (bisect_left(vocab, b) + 1 if exact else 0))
    at = [0, *np.searchsorted(key, cuts).tolist(), len(grams)]
    return [(lo + i, at[i], at[i + 1]) for i in range(len(at) - 1) if at[i] < at[i + 1]]


def counted(shards: DataFrame, level: int, bounds: Bounds, ranges: int, seen: np.ndarray | None) -> DataFrame:
    """(part, lang, automaton): for each prefix range, all n-grams of the level with a count of LEAST or more."""
    width = LONGEST if level == 3 else level

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, vocab, ids in zip(*(batch.column(i) for i in range(3))):
                s = Shard(lang.as_py(), vocab.as_py(), ids.as_py())
                grams, counts = s.grams(level, seen)
                rows = [(part, s.lang, built(s.vocab, grams[a:b], counts[a:b]).to_bytes()) for part, a, b in splits(bounds, s.lang, s.vocab, grams)]
                if rows:
                    yield _automata(rows)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            for part, lang, raw in zip(*(batch.column(i) for i in range(3))):
                key = (part.as_py(), lang.as_py())
                if key != now:
                    if held:
                        yield from kept(now, held)
                    now, held = key, Union(width)
                held.add(Transducer.from_bytes(raw.as_py()))
        if held:
            yield from kept(now, held)

    def kept(key, held: Union) -> Iterator[pa.RecordBatch]:
        t = held.done(LEAST)
        if t.vocab:
            yield _automata([(*key, t.to_bytes())])

    made = shards.select("lang", "vocab", "ids").mapInArrow(count, AUTOMATON)
    return written(made.repartition(ranges, "part").sortWithinPartitions("part", "lang").mapInArrow(unite, AUTOMATON), f"phrases-{level}")


def _automata(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.large_binary()))], names=["part", "lang", "automaton"])


def phrases_of(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a) of all n-grams of the automata."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw in zip(batch.column(0), batch.column(1)):
                t = Transducer.from_bytes(raw.as_py())
                grams, count = t.grams(LONGEST)
                yield _phrases(lang.as_py(), t.vocab, grams, count)

    return counts.select("lang", "automaton").mapInArrow(spell, "lang string, phrase string, a bigint")


def _phrases(lang: str, vocab: list[bytes], grams: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    text = [b" ".join([vocab[i] for i in g if i >= 0]).decode("utf-8", "replace") for g in grams.tolist()]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(text), pa.string()), pa.array(text, pa.string()), pa.array(count, pa.int64())], names=["lang", "phrase", "a"])


def part_counts(long: DataFrame, every: DataFrame, bounds: Bounds, ranges: int) -> DataFrame:
    """(lang, phrase, a) of all first and last parts of the n-grams of `long`, counted in the automata of `every`."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw in zip(batch.column(0), batch.column(1)):
                t = Transducer.from_bytes(raw.as_py())
                grams, _ = t.grams(LONGEST)
                size = (grams >= 0).sum(axis=1)
                parts = []
                for n in range(2, LONGEST + 1):
                    own = grams[size == n]
                    for k in range(1, n):
                        for piece in (own[:, :k], own[:, k:n]):
                            parts.append(np.pad(piece, ((0, 0), (0, LONGEST - 1 - piece.shape[1])), constant_values=-1))
                grams, _ = summed(np.concatenate(parts).astype(np.int64), np.ones(sum(map(len, parts)), np.int64))
                cut = splits(bounds, lang.as_py(), t.vocab, grams)
                yield _automata([(part, lang.as_py(), built(t.vocab, grams[a:b], np.zeros(b - a, np.int64)).to_bytes()) for part, a, b in cut])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, wanted = None, [], None
        for batch in batches:
            for part, lang, raw, asks in zip(*(batch.column(i) for i in range(4))):
                key = (part.as_py(), lang.as_py())
                if key != now:
                    if wanted:
                        yield from answers(now, known, wanted)
                    now, known, wanted = key, [], Union(LONGEST - 1)
                t = Transducer.from_bytes(raw.as_py())
                wanted.add(t) if asks.as_py() else known.append(t)
        if wanted:
            yield from answers(now, known, wanted)

    def answers(key, known: list[Transducer], wanted: Union) -> Iterator[pa.RecordBatch]:
        acceptor = wanted.done()
        for t in known:
            yield _phrases(key[1], acceptor.vocab, *t.compose(acceptor, LONGEST - 1))

    both = every.withColumn("asks", F.lit(False)).unionByName(long.select("lang", "automaton").mapInArrow(asked, AUTOMATON).withColumn("asks", F.lit(True)))
    return both.repartition(ranges, "part").sortWithinPartitions("part", "lang", "asks").mapInArrow(answer, "lang string, phrase string, a bigint")


def scored(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """candidates (lang, phrase, a) with l, r and score of their lowest-scoring cut."""
    key = lambda c: F.concat_ws("\0", "lang", c)
    words = F.split("phrase", " ")
    cut = candidates.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    first, last = F.array_join(F.slice("w", 1, F.col("k")), " "), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ")
    asked = cut.select("lang", "phrase", "a", "k", F.explode(F.array(F.struct(F.lit(True).alias("left"), first.alias("part")), F.struct(F.lit(False).alias("left"), last.alias("part")))).alias("p"))
    asked = written(asked.select("lang", "phrase", "a", "k", "p.left", key("p.part").alias("key")), "cuts")
    found = spread_join(asked, parts.select(key("phrase").alias("key"), F.col("a").alias("f")), "key", ["phrase"])
    by_cut = found.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = by_cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def uncovered(candidates: DataFrame) -> DataFrame:
    """Candidates without those that lie in a longer one which has COVERED hundredths of their count."""
    w = F.col("w")
    span = F.sequence(F.lit(2), F.size(w) - 1)
    inner = F.flatten(F.transform(span, lambda n: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))))
    inside = candidates.withColumn("w", F.split("phrase", " ")).filter(F.size(w) > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("f"))
    most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    return candidates.join(most, ["lang", "phrase"], "left").filter(F.col("f").isNull() | (wide("f") * 100 < wide("a") * COVERED)).drop("f")


def mine(docs: DataFrame, top: int = TOP) -> DataFrame:
    """docs (lang, text) -> (lang, rank, phrase, a, l, r, n, score), the first `top` phrases of each language.

    A null lang is `und`, a null text is empty, repeated rows count as often as they occur; no text gives no row. A
    language of any share of the texts is spread over prefix ranges of its phrases.
    """
    shards = written(shards_of(docs), "shards")
    bounds, ranges = bounds_of(shards)
    one = counted(shards, 1, bounds, ranges, None)
    two = counted(shards, 2, bounds, ranges, bitmap(one))
    long = counted(shards, 3, bounds, ranges, bitmap(two))
    candidates = written(phrases_of(two.unionByName(long)), "candidates")
    parts = part_counts(two.unionByName(long), one.unionByName(two).unionByName(long), bounds, ranges)
    left = scored(uncovered(candidates), parts)
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = left.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= top)
    n = shards.groupBy("lang").agg(F.sum("words").alias("n"))
    return first.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query over every whole text of documents."""
    return mine(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM split, range(1, {LONGEST + 1}) t(m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL),
words AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE m > 1 AND a >= {LEAST}),
cut AS (SELECT c.*, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM cand c, range(1, {LONGEST}) t(k) WHERE k < m),
val AS (SELECT c.lang, c.phrase, c.w, c.a, k, x.a AS l, y.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS BIGINT) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
low AS (SELECT * FROM val QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, a AS f FROM cand, range(1, {LONGEST + 1}) t(i), range(2, {LONGEST}) u(j) WHERE j < m AND i + j - 1 <= m) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase) WHERE f IS NULL OR 100 * f < {COVERED} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN words USING (lang) QUALIFY rank <= {TOP}
"""
