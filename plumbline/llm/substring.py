"""Substring dedup by collinear chaining: shared word k-mers seed it, a Fenwick tree chains them, alignment confirms.

Every document keeps the minimisers of its word k-mers: the least hash of each WINDOW consecutive k-mers, so an exact run
of K + WINDOW - 1 words always shares a seed. Each occurrence of a k-mer is matched with the one in the least document id and
with the last ones in the BEFORE documents before its own, so a passage in n documents gives at most (1 + BEFORE) * (n - 1)
matches a seed, not n squared. Chains without a match of the first kind are aligned only where those with one leave words
uncovered. Occurrences for which this leaves out documents, and which no passage covers by then, are held against all earlier
occurrences of their k-mer by the words around them (rest()). Documents that are left are matched in full, in rounds (ROUNDS),
until a passage covers such an occurrence or no earlier document is left.
Matches of a pair of documents are chained where both positions rise; a chain is then aligned word by word along its
matches and split where too many words in a row differ.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, bounded, fresh, numbered_rows, spread_join, table, text_of, written
from .simhash import splitmix

K, WINDOW = 5, 7
SEED_SCORE, GAP_COST = 5.0, 0.1  # a seed, and each word skipped in either document
MIN_WORDS, MIN_IDENTITY = 50, 0.8
BEFORE = 2  # documents before its own, among those with the k-mer, that an occurrence is matched with
REACH = 12  # words that an alignment may skip on a side; wider gaps split it
UNIT_ROWS = 16384  # uncovered occurrences of a k-mer that a task holds at once
BLOCK = 2048  # occurrences on a side of a table of counts
OFTEN = 256  # a pair of words that more than one in OFTEN pairs of lists share is counted by a product of matrices, others one by one
DRIFT = 12  # words that two surroundings may be shifted against each other, as REACH
FILTER_BITS = 27  # of a bitmap of k-mers, 16 MB
ROUNDS = (1, 8, None)  # earlier documents that a left-out occurrence is matched with in a round, until a passage covers it; None: all others
FURTHER = 30  # words behind those around a k-mer that are compared, too: what the k-mers behind it leave to it
MARGIN = 64  # words around a chain into which its alignment may extend
POS_BITS = 26  # words of a document, in one number with the document's number
BLANK = r"[\x20\x09-\x0D]+"
_VALUE = splitmix(np.arange(1, 257, dtype=np.uint64))
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), 0x9E3779B97F4A7C15, np.uint64)], dtype=np.uint64)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, first byte) of every word of raw, in order."""
    b = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.r_[False, _IS_WORD[b], False].astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64), start
    size = stop - start
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        v = _VALUE[b[np.repeat(start, size) + at]] * _powers(int(size.max()))[at]
        return splitmix(np.add.reduceat(v, np.cumsum(size) - size)), start


def minimisers(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of the kept k-mers; doc is the document of each word and never falls."""
    n = len(words) - K + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = words[:n].copy()
        for j in range(1, K):
            h = h * np.uint64(0xD6E8FEB86659FD93) + words[j : j + n]
    h = splitmix(h)
    inside = doc[:n] == doc[K - 1 :]
    kept = np.zeros(n, bool)
    m = n - WINDOW + 1
    if m > 0:
        low = h[:m].copy()
        for j in range(1, WINDOW):
            np.minimum(low, h[j : j + m], out=low)
        whole = doc[:m] == doc[WINDOW + K - 2 :]
        for j in range(WINDOW):
            kept[j : j + m] |= whole & (h[j : j + m] == low)
    kept |= (np.bincount(doc) < WINDOW + K - 1)[doc[:n]]  # documents too short for a window keep all
    at = np.flatnonzero(kept & inside)
    return h[at], at


def with_repeats(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, index of the k-mer each is of): all k-mers, and once more, under a hash of its own, the n-th occurrence of a
    k-mer in its document for n > 1, so that text that repeats itself meets its copy beyond the first round."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])][: len(h)]
    run = np.arange(len(h)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(h) else np.zeros(0, np.int64)
    again = order[run > 0]
    return np.r_[h, splitmix(h[again] ^ splitmix(run[run > 0].astype(np.uint64)))], np.r_[np.arange(len(h)), again]


def _minimisers_of(batches):
    """For about a megabyte of the texts of batches(id, text) at a time: (ids, word hashes, document of each word, first word and end of
    each document, hash and index of the first word of the minimisers)."""
    for b in batches:
        ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
        lo = 0
        while lo < len(ids):
            parts, size, hi = [], 0, lo
            while hi < len(ids) and (size < 1 << 20 or hi == lo):
                parts.append(texts[hi].as_py().encode("utf-8", "surrogatepass").translate(ASCII_LOWER))
                size += len(parts[-1]) + 1
                hi += 1
            words, start = word_hashes(b"\n".join(parts))
            doc = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), start, side="right")
            end = np.cumsum(np.bincount(doc, minlength=hi - lo))
            first = np.r_[0, end[:-1]]
            h, at = minimisers(words, doc)
            if len(at) and (at - first[doc[at]]).max() >> POS_BITS:
                raise ValueError(f"a text has more than 2**{POS_BITS} words")
            yield ids[lo:hi], words, doc, first, end, h, at
            lo = hi


def seeds(docs: DataFrame) -> DataFrame:
    """docs(id, text) -> (h, at): at is id * 2**POS_BITS + word position."""

    def run(batches):
        for ids, _, doc, first, _, h, at in _minimisers_of(batches):
            h, pick = with_repeats(h, doc[at])
            at = at[pick]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array((ids[doc[at]] << POS_BITS) + at - first[doc[at]])], ["h", "at"])

    return docs.mapInArrow(run, "h long, at long")


def surroundings(docs: DataFrame, around: int, wanted, open_) -> DataFrame:
    """docs(id, text) -> (h, at, own, before, told, span, run, near): the minimisers that the bitmap `wanted` may hold.

    own: whether the bitmap `open_` may hold the occurrence. before: a number for the minimiser before, if one begins at most K words
    before, and its distance; else 0. told: whether that one is wanted and own, too. span: words to the last one that is told by the
    one before, and so on from here. run: in a run of WINDOW equal
    minimisers or more, word by word, how many of them begin here and behind, negative at its start; else 0. near: the hashes of the words from `around`
    before to `around` + FURTHER behind it, two bytes each. What with_repeats() adds is left out: it begins where the k-mer itself does.
    """

    def rows(batches):
        for ids, words, doc, first, end, h, at in _minimisers_of(batches):
            place = (ids[doc[at]] << POS_BITS) + at - first[doc[at]]
            held = in_bitmap(wanted.value, h)
            own = held.copy()
            own[held] = np.logical_and.reduce([in_bitmap(open_.value, m) for m in marks(h[held], place[held])])
            step = np.r_[K + 1, np.diff(at)][: len(at)]
            near_by = (step <= K) & np.r_[False, doc[at[1:]] == doc[at[:-1]]][: len(at)]
            with np.errstate(over="ignore"):
                before = np.where(near_by, splitmix(np.roll(h, 1) + step.astype(np.uint64)) | np.uint64(1), np.uint64(0))
            told = near_by & np.roll(own, 1)
            last = np.r_[np.flatnonzero(~told)[1:], len(h)] - 1
            span = (at[last][np.cumsum(~told) - 1] - at).astype(np.int32)
            same = near_by & (step == 1) & (h == np.roll(h, 1))
            starts = np.flatnonzero(~same)
            size = np.diff(np.r_[starts, len(h)])
            run = np.repeat(starts + size, size) - np.arange(len(h))
            run = np.where(np.repeat(size, size) < WINDOW, 0, np.where(same, run, -run)).astype(np.int32)
            k = np.flatnonzero(held)
            h, at, place, own, before, told, span, run = (v[k] for v in (h, at, place, own, before, told, span, run))
            lo, hi = np.maximum(at - around, first[doc[at]]), np.minimum(at + K + around + FURTHER, end[doc[at]])
            short = (words >> np.uint64(48)).astype(np.uint16)
            near = pa.array([short[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(place), pa.array(own), pa.array(before.view(np.int64)), pa.array(told), pa.array(span), pa.array(run), near], ["h", "at", "own", "before", "told", "span", "run", "near"])

    return docs.mapInArrow(rows, "h long, at long, own boolean, before long, told boolean, span int, run int, near binary")


def marks(h: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Three hashes of an occurrence, all of which a bitmap holds for one that it is to know."""
    mark = splitmix(h ^ splitmix(at.astype(np.uint64)))
    return [mark >> np.uint64(n) for n in (0, 18, 37)]


def in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame):
    """A broadcast bitmap of the k-mers keys(h): it may hold others, but lacks none. 16 MB however many they are."""
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    low = keys.select(F.col("h").bitwiseAND((1 << FILTER_BITS) - 1).cast("long").alias("low"))
    blocks = low.groupBy(F.shiftright("low", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("low").bitwiseAND((1 << 15) - 1)).alias("bits"))
    for r in blocks.toLocalIterator():
        bits[r.block << 12 : (r.block + 1) << 12] = np.frombuffer(r.bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def matches(docs: DataFrame) -> DataFrame:
    """(doc, ref, x, y, least): word x of doc and word y of ref begin the same k-mer, ref being a lesser id. See met()."""
    return met(docs).filter("least is not null")


def met(docs: DataFrame) -> DataFrame:
    """matches(), and what they leave out.

    least: ref is the least id that has the k-mer; other refs are the BEFORE last ids below doc that have it. Where other ids
    below doc have it too, there is a row (doc, the k-mer, x, -1, null) beside. The occurrences of a k-mer pass through one
    task in order, which holds a batch and the BEFORE + 3 occurrences that later ones need.
    """
    schema = pa.schema([("doc", pa.int64()), ("ref", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("least", pa.bool_())])

    def run(batches):
        old_h, old_at = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            h, at = (np.r_[old, b.column(c).to_numpy(zero_copy_only=False)] for c, old in ((0, old_h), (1, old_at)))
            doc, pos, rows = at >> POS_BITS, at & (2**POS_BITS - 1), np.arange(len(h))
            fresh = np.r_[True, h[1:] != h[:-1]]
            turn = fresh | np.r_[True, doc[1:] != doc[:-1]]
            top = np.maximum.accumulate(np.where(fresh, rows, 0))  # first row of the k-mer
            begin = np.flatnonzero(turn)
            group = np.cumsum(turn) - 1  # (k-mer, document) of a row
            new = rows >= len(old_h)
            mine = rows[new & (doc != doc[top])]
            pairs = [(mine, top[mine], True)]
            for back in range(BEFORE):
                g = group[mine] - back
                last = begin[np.maximum(g, 0)] - 1  # last row of the document before
                ok = (g >= 0) & (last > top[mine])
                pairs.append((mine[ok], last[ok], False))
            g = group[mine] - BEFORE
            further = begin[np.maximum(g, 0)] - 1
            more = mine[(g >= 0) & (further > top[mine]) & (doc[further] != doc[top[mine]])]
            if len(more):
                n = len(more)
                yield pa.RecordBatch.from_arrays([pa.array(doc[more]), pa.array(h[more]), pa.array(pos[more].astype(np.int32)), pa.array(np.full(n, -1, np.int32)), pa.nulls(n, pa.bool_())], schema=schema)
            for one, other, least in pairs:
                if len(one):
                    yield pa.RecordBatch.from_arrays([pa.array(doc[one]), pa.array(doc[other]), pa.array(pos[one].astype(np.int32)), pa.array(pos[other].astype(np.int32)), pa.array(np.full(len(one), least))], schema=schema)
            ends = np.r_[begin[1:], len(h)] - 1
            keep = np.unique(np.r_[top[-1], ends[-BEFORE - 2 :]])
            keep = keep[keep >= top[-1]]
            old_h, old_at = h[keep], at[keep]

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return seeds(docs).repartition(parts, "h").sortWithinPartitions("h", "at").mapInArrow(run, "doc long, ref long, x int, y int, least boolean")


def with_numbers(docs: DataFrame, id_col: str) -> tuple[DataFrame, str, bool]:
    """(docs with a column that numbers its rows in the order of their ids, nulls last; that column; whether it is the id).

    Ids that are all different and from 0 to 2**(63 - POS_BITS) - 1 are the numbers themselves. Else the rows are written
    with numbers of their own, so that rows which share an id or have none stay apart.
    """
    name, key = fresh(docs, "document_number"), docs[id_col].cast("long")
    ids = docs.select(key.alias("id"))
    n, given, low, high = ids.agg(F.count("*"), F.count("id"), F.min("id"), F.max("id")).first()
    if n == given and (not n or low >= 0 and high < 1 << (63 - POS_BITS)) and ids.groupBy("id").count().filter("count > 1").limit(1).count() == 0:
        return docs.withColumn(name, key), name, True
    kept, row = numbered_rows(docs, "documents")
    rows = kept.select(row, F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{id_col}`").isNull().alias("none"))
    order = rows.repartitionByRange("none", "id", row).sortWithinPartitions("none", "id", row)
    order = written(order.select(row, F.monotonically_increasing_id().alias("m")), "row-order").withColumn("part", F.shiftright("m", 33))
    sums = order.groupBy("part").agg(F.count("*").alias("n"))
    base = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))  # one row a partition
    numbers = order.join(F.broadcast(base), "part").select(row, (F.col("base") + F.col("m").bitwiseAND((1 << 33) - 1)).alias(name))
    return written(kept.join(numbers, row).drop(row), "numbered"), name, False


def chain(x: list[int], y: list[int]) -> list[list[int]]:
    """Chains of matches, best first and without common matches; x never falls, and y falls where x stays.

    score(i) = SEED_SCORE + max(0, score(j) - GAP_COST * (x_i - x_j + y_i - y_j)) over all j with lower x and y: with
    score + GAP_COST * (x + y) as key the best j is a prefix maximum over y, which the Fenwick tree keeps.
    """
    rank = {v: i + 1 for i, v in enumerate(sorted(set(y)))}
    size = len(rank)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, before = [0.0] * len(x), [-1] * len(x)
    for i, (xi, yi) in enumerate(zip(x, y)):
        best, q = (-1e18, -1), rank[yi] - 1
        while q:
            if tree[q] > best:
                best = tree[q]
            q &= q - 1
        along = best[0] - GAP_COST * (xi + yi)
        score[i] = SEED_SCORE
        if along > 0:
            score[i] += along
            before[i] = best[1]
        entry, q = (score[i] + GAP_COST * (xi + yi), i), rank[yi]
        while q <= size:
            if entry > tree[q]:
                tree[q] = entry
            q += q & -q
    used, out = bytearray(len(x)), []
    for i in sorted(range(len(x)), key=score.__getitem__, reverse=True):
        if used[i]:
            continue
        path = []
        while i >= 0 and not used[i]:
            used[i] = 1
            path.append(i)
            i = before[i]
        out.append(path[::-1])
    return out


def chains(found: DataFrame, least_span: int) -> DataFrame:
    """(doc, ref, x0, x1, y0, y1, xs, ys, least): half-open word ranges and matches of the chains that span least_span words
    of doc, and whether one of the matches is with the least id that has its k-mer.

    A pair of documents has at most as many matches as one of them has seeds: that bounds what a task holds.
    """
    kind = "doc long, ref long, x0 int, x1 int, y0 int, y1 int, xs array<int>, ys array<int>, least boolean"

    def pair(doc, ref, x, y, least):
        order = np.lexsort((-y, x))
        xs, ys, firsts = x[order].tolist(), y[order].tolist(), least[order].tolist()
        for p in chain(xs, ys):
            if len(p) > 1 and xs[p[-1]] + K - xs[p[0]] >= least_span:
                yield doc, ref, xs[p[0]], xs[p[-1]] + K, ys[p[0]], ys[p[-1]] + K, [xs[i] for i in p], [ys[i] for i in p], any(firsts[i] for i in p)

    def run(batches):
        held: list[tuple] = []

        def close(last):
            cols = [np.concatenate(c) for c in zip(*held)]
            new = np.flatnonzero(np.r_[True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])
            cut = len(cols[0]) if last else int(new[-1])
            held[:] = [tuple(c[cut:] for c in cols)]
            doc, ref, x, y, least = (c[:cut] for c in cols)
            if not cut:
                return []
            new = new[new < cut]
            stop = np.r_[new[1:], cut]
            wide = (np.maximum.reduceat(x, new) + K - np.minimum.reduceat(x, new) >= least_span) & (stop - new > 1)
            rows = [r for a, b in zip(new[wide].tolist(), stop[wide].tolist()) for r in pair(int(doc[a]), int(ref[a]), x[a:b], y[a:b], least[a:b])]
            return [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)] if rows else []

        schema = pa.schema([("doc", pa.int64()), ("ref", pa.int64()), *[(c, pa.int32()) for c in ("x0", "x1", "y0", "y1")], *[(c, pa.list_(pa.int32())) for c in ("xs", "ys")], ("least", pa.bool_())])
        for b in batches:
            if b.num_rows:
                held.append(tuple(b.column(c).to_numpy(zero_copy_only=False) for c in range(5)))
                if sum(len(h[0]) for h in held) >= 50_000:
                    yield from close(False)
        if held:
            yield from close(True)

    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts, "doc", "ref").sortWithinPartitions("doc", "ref").mapInArrow(run, kind)


def walk(a: list, b: list, reach: int = REACH, agree: int = 2) -> list[tuple[int, int, int]]:
    """Follows a and b from their starts: runs (word of a, word of b, equal words), in order.

    At a difference the nearest pair of offsets up to `reach` after which `agree` words are equal is taken; without one, one
    equal word after one or two that are replaced.
    """
    i = j = 0
    n, m = len(a), len(b)
    runs = []
    while True:
        start = i
        while i < n and j < m and a[i] == b[j]:
            i += 1
            j += 1
        if i > start:
            runs.append((start, j - (i - start), i - start))
        if i >= n or j >= m:
            return runs
        after: dict[tuple, list[int]] = {}
        for db in range(min(reach, m - j - agree) + 1):
            after.setdefault(tuple(b[j + db : j + db + agree]), []).append(db)
        best = None
        for da in range(min(reach, n - i - agree) + 1):
            for db in after.get(tuple(a[i + da : i + da + agree]), ()):
                if 0 < da + db < 2 * reach and (best is None or (da + db, abs(da - db), da) < best):
                    best = (da + db, abs(da - db), da)
        if best is None:  # one equal word behind one or two replaced ones still belongs to a passage that ends there
            step = next((d for d in (1, 2) if i + d < n and j + d < m and a[i + d] == b[j + d]), None)
            if step is None:
                return runs
            best = (2 * step, 0, step)
        i, j = i + best[2], j + best[0] - best[2]


def align(a: list, b: list, xs: list[int], ys: list[int]) -> list[tuple[int, int, int]]:
    """Runs (word of a, word of b, equal words) along the seeds, in order; walks fill what lies between and around them."""
    runs: list[tuple[int, int, int]] = []
    i = j = 0
    for x, y in zip(xs, ys):
        over = max(i - x, j - y, 0)  # words of the seed that lie behind what is aligned
        x, y, left = x + over, y + over, K - over
        if left < 1 or len(a) < x + left or a[x : x + left] != b[y : y + left]:
            continue
        if runs:
            ahead = walk(a[i:x], b[j:y])
            runs += [(i + p, j + q, n) for p, q, n in ahead]
            if ahead:
                i, j = runs[-1][0] + runs[-1][2], runs[-1][1] + runs[-1][2]
        runs += [(x - p - n, y - q - n, n) for p, q, n in reversed(walk(a[i:x][::-1], b[j:y][::-1]))]
        n = left
        while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
            n += 1
        runs.append((x, y, n))
        i, j = x + n, y + n
    return runs + [(i + p, j + q, n) for p, q, n in walk(a[i:], b[j:])] if runs else runs


def longest(x, ex, y, ey, done, min_words: int, min_identity: float) -> tuple[int, int] | None:
    """(first, last + 1) of the runs between which the most words lie, min_words at least, with min_identity on both sides; the first
    such stretch of equal ones.

    A stretch f .. t is good where done[t] - identity * ex[t - 1] is not below done[f] - identity * x[f], and likewise for y.
    Ends are met in the order of the first value with all starts whose first value is not above it; a tree over the starts
    keeps the least second value, and its leftmost leaf that is not above the end's is the best start. n log n for n runs.
    """
    n = len(x)
    scaled = lambda d, at: np.round((d - min_identity * at) * 1e6).astype(np.int64)  # noqa: E731  equal on both sides of a bound
    sx, sy, tx, ty = scaled(done[:-1], x), scaled(done[:-1], y), scaled(done[1:], ex), scaled(done[1:], ey)
    if n <= 64:
        good = (tx[None] >= sx[:, None]) & (ty[None] >= sy[:, None]) & (ex[None] - x[:, None] >= min_words)
        if not good.any():
            return None
        f, t = np.unravel_index(int(np.where(good, ex[None] - x[:, None], -1).argmax()), good.shape)
        return int(f), int(t) + 1
    size = 1 << (n - 1).bit_length()
    none = 1 << 62
    tree, starts, at, best = [none] * (2 * size), np.argsort(sx, kind="stable").tolist(), 0, None
    sx, sy, ty, xs, exs = sx.tolist(), sy.tolist(), ty.tolist(), x.tolist(), ex.tolist()
    for t in np.argsort(tx, kind="stable").tolist():
        limit = int(tx[t])
        while at < n and sx[starts[at]] <= limit:
            leaf = size + starts[at]
            tree[leaf] = sy[starts[at]]
            while leaf > 1 and tree[leaf] < tree[leaf >> 1]:
                tree[leaf >> 1] = tree[leaf]
                leaf >>= 1
            at += 1
        if tree[1] <= ty[t]:
            leaf = 1
            while leaf < size:
                leaf = 2 * leaf + (tree[2 * leaf] > ty[t])
            f = leaf - size
            wide = exs[t] - xs[f]
            if f <= t and wide >= min_words and (best is None or (-wide, f, t) < best):
                best = (-wide, f, t)
    return (best[1], best[2] + 1) if best else None


def parts(runs: list[tuple[int, int, int]], min_words: int, min_identity: float) -> list[tuple[int, int, int, int, int]]:
    """(x0, x1, y0, y1, equal words) of the passages in the runs of an alignment.

    The runs are split at gaps of more than REACH words; neighbours that hold no passage alone are tried together. Where
    a stretch is below min_identity, its longest part that is not is taken, then what lies on both sides.
    """
    if not runs:
        return []
    x, y, n = np.array(runs, np.int64).T
    ex, ey, done = x + n, y + n, np.r_[0, np.cumsum(n)]
    gap = np.maximum(x[1:] - ex[:-1], y[1:] - ey[:-1])

    def held(lo: int, hi: int) -> list:
        todo, out = [(lo, hi)], []
        while todo:
            lo, hi = todo.pop()
            if hi <= lo or ex[hi - 1] - x[lo] < min_words:
                continue
            size = max(ex[hi - 1] - x[lo], ey[hi - 1] - y[lo])
            if (done[hi] - done[lo]) / size >= min_identity:
                out.append((int(x[lo]), int(ex[hi - 1]), int(y[lo]), int(ey[hi - 1]), int(done[hi] - done[lo])))
            else:
                at = longest(x[lo:hi], ex[lo:hi], y[lo:hi], ey[lo:hi], done[lo : hi + 1], min_words, min_identity)
                if at:
                    f, t = lo + at[0], lo + at[1]
                    out.append((int(x[f]), int(ex[t - 1]), int(y[f]), int(ey[t - 1]), int(done[t] - done[f])))
                    todo += [(lo, f), (t, hi)]
        return out

    edges = [0, *(np.flatnonzero(gap > REACH) + 1).tolist(), len(runs)]
    out, waiting = [], []
    for lo, hi in [*zip(edges, edges[1:]), (len(runs), len(runs))]:
        here = held(lo, hi)
        if not here and lo < hi:
            waiting.append((lo, hi))
            continue
        if len(waiting) > 1:
            out += held(waiting[0][0], waiting[-1][1])
        waiting = []
        out += here
    return out


def confirmed(found: DataFrame, src: DataFrame, min_words: int, min_identity: float) -> DataFrame:
    """The passages that the alignment of the chains `found` in src(id, text) gives."""
    key = ["doc", "ref", "x0", "y0"]
    sides = [
        found.select(*key, F.col(doc).alias("id"), F.lit(side).alias("side"), F.greatest(F.col(f"{p}0") - MARGIN, F.lit(0)).alias("lo"), (F.col(f"{p}1") + MARGIN).alias("hi"), *[F.when(F.lit(side == 0), F.col(c)).alias(c) for c in ("xs", "ys")])
        for side, doc, p in ((0, "doc", "x"), (1, "ref", "y"))
    ]
    words = F.split(F.regexp_replace("text", f"^{BLANK}", ""), BLANK)
    # the spans grow with the corpus, so they are never broadcast
    cut = sides[0].unionByName(sides[1]).hint("merge").join(src, "id").select(*key, "side", "lo", "xs", "ys", F.array_join(F.slice(words, F.col("lo") + 1, F.col("hi") - F.col("lo")), " ").alias("part"))
    halves = [cut.filter(F.col("side") == s).select(*key, *[F.col(c).alias(f"{c}{s}") for c in (("lo", "part"), ("lo", "part", "xs", "ys"))[s == 0]]) for s in (0, 1)]

    @F.arrow_udf("array<struct<x0:int,x1:int,y0:int,y1:int,same:int>>")
    def aligned(pa0, lo0, pa1, lo1, xs0, ys0):
        out = []
        for ta, la, tb, lb, xs, ys in zip(*(c.to_pylist() for c in (pa0, lo0, pa1, lo1, xs0, ys0))):
            a, b = (t.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() for t in (ta, tb))
            runs = align(a, b, [x - la for x in xs], [y - lb for y in ys])
            out.append([{"x0": x0 + la, "x1": x1 + la, "y0": y0 + lb, "y1": y1 + lb, "same": same} for x0, x1, y0, y1, same in parts(runs, min_words, min_identity)])
        return pa.array(out, pa.list_(pa.struct([(c, pa.int32()) for c in ("x0", "x1", "y0", "y1", "same")])))

    both = halves[0].join(halves[1], key).select("doc", "ref", F.explode(aligned.asNondeterministic()("part0", "lo0", "part1", "lo1", "xs0", "ys0")).alias("r"))
    n = F.col("r.x1") - F.col("r.x0")
    return (
        both.select(
            F.col("doc").alias("doc_id"), F.col("r.x0").alias("start"), F.col("r.x1").alias("stop"), F.col("ref").alias("src_doc_id"), F.col("r.y0").alias("src_start"), F.col("r.y1").alias("src_stop"),
            n.alias("n_words"), (F.col("r.same") / F.greatest(n, F.col("r.y1") - F.col("r.y0"))).alias("identity"),
        )
        .filter((F.col("n_words") >= min_words) & (F.col("identity") >= min_identity))
        .distinct()
    )


def least_common(min_words: int, min_identity: float) -> tuple[int, int]:
    """(words, pairs of neighbouring words) that a passage has in common on both sides at least: each word that is not, on either
    side, breaks one pair."""
    same = int(np.ceil(min_words * min_identity - 1e-9))
    return same, max(same - 1 - int(2 * (same / min_identity - same) + 1e-9), 0)


def subsequences(a: list[int], at: dict[int, int]) -> list[int]:
    """Length of the longest common subsequence of each start of a, the empty one first, and the list whose words have the bits `at`."""
    row, out = 0, [0]  # bit j: the length grows at word j of the list
    for w in a:
        m = at.get(w)
        if m:
            x = row | m
            row = x & ~(x - ((row << 1) | 1))
        out.append(row.bit_count())
    return out


def places(words: list[int]) -> dict[int, int]:
    at: dict[int, int] = {}
    for k, w in enumerate(words):
        at[w] = at.get(w, 0) | 1 << k
    return at


def through(left: list[int], right: list[int], min_words: int, min_identity: float) -> bool:
    """Whether a passage may go through a k-mer: left[i] and right[j] words can be in common in the same order among the i words
    before it and the j words behind it, and some i + K + j of min_words or more have min_identity of them."""
    rest_ = [n - min_identity * j for j, n in enumerate(right)]
    for j in range(len(rest_) - 2, -1, -1):
        rest_[j] = max(rest_[j], rest_[j + 1])
    own = K - min_identity * K + 1e-9
    return any(own + n - min_identity * i + rest_[j] >= 0 for i, n in enumerate(left) if (j := max(min_words - K - i, 0)) < len(rest_))


def columns(words: list[np.ndarray], left: np.ndarray, before: int, width: int, none: int) -> np.ndarray:
    """The words as columns of `width` rows in which word left[i] of list i is in row `before`; `none` where there is no word."""
    n = np.array([len(w) for w in words])
    out = np.full((len(words), width), none, np.uint16)
    row = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(before - left, n)
    out[row, at] = np.maximum(np.concatenate(words), 2)
    return np.ascontiguousarray(out.T)


def around_anchors(words: list[list[np.ndarray]], left: tuple[np.ndarray, np.ndarray], min_words: int, min_identity: float):
    """A test of pairs (i, j) of lists whose words left[0][i] and left[1][j] begin the same k-mer: whether min_words words of i or
    more with the k-mer, the first and the last among them, have min_identity of them in j, each at most DRIFT words from where
    it is due. Passages pass it."""
    before = max(int(x.max()) for x in left)
    width = before + max(len(w) - k for lists, x in zip(words, left) for w, k in zip(lists, x.tolist()))
    a, b = columns(words[0], left[0], before, width, 0), columns(words[1], left[1], before + DRIFT, width + 2 * DRIFT, 1)
    scale = np.int32(round(1000 * min_identity))

    def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        own, other = a[:, i], b[:, j]
        same = np.zeros(own.shape, bool)
        for d in range(2 * DRIFT + 1):
            same |= own == other[d : d + width]
        sums = np.zeros((width + 1, len(i)), np.int32)
        np.cumsum(np.where(same, 1000 - scale, -scale), axis=0, out=sums[1:])
        starts = np.minimum.accumulate(np.where(same[: before + 1], sums[: before + 1], 1 << 30))  # the least sum up to each start
        good = np.zeros(len(i), bool)
        for end in range(max(before + K, min_words), width + 1):
            good |= same[end - 1] & (sums[end] >= starts[min(end - min_words, before)])
        return good

    return test


def shared_pairs(own: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray], shape: tuple[int, int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the lists that have `least` pairs of neighbouring words in common or more, from (list, pair of words) of both sides:
    as many of i are among those of j. The pairs of words that few lists share are met one by one."""
    row, value = own
    other = np.unique(others[0].astype(np.uint64) << np.uint64(32) | others[1])
    row_j, value_j = (other >> np.uint64(32)).astype(np.int64), (other & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    known, at = np.unique(value_j, return_inverse=True)
    if not len(known):
        return tuple(np.nonzero(np.full(shape, least <= 0)))
    place = np.minimum(np.searchsorted(known, value), len(known) - 1)
    met = known[place] == value
    row, place = row[met], place[met]
    n, n_j = np.bincount(place, minlength=len(known)), np.bincount(at, minlength=len(known))
    often = n * n_j > shape[0] * shape[1] // OFTEN
    count = np.zeros(shape, np.float32)
    if often.any():
        name = np.cumsum(often) - 1
        side = [np.bincount(r[often[v]] * often.sum() + name[v[often[v]]], minlength=rows * often.sum()).reshape(rows, -1).astype(np.float32) for r, v, rows in ((row, place, shape[0]), (row_j, at, shape[1]))]
        count += side[0] @ side[1].T
    few, few_j = ~often[place], ~often[at]
    row, place, row_j, at = row[few], place[few], row_j[few_j], at[few_j]
    row_j = row_j[np.argsort(at, kind="stable")]
    n_j = np.where(often, 0, n_j)
    size, start = n_j[place], (np.cumsum(n_j) - n_j)[place]
    pick = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
    count += np.bincount(np.repeat(row, size) * shape[1] + row_j[pick], minlength=shape[0] * shape[1]).reshape(shape)
    return tuple(np.nonzero(count >= least))


def alike(own: list[bytes], ids: np.ndarray, others: list[bytes], refs: np.ndarray, least: tuple[int, int], allowed=None, anchors: tuple | None = None, names: np.ndarray | None = None, equal: dict | None = None) -> set[tuple[int, int]]:
    """(id, ref) with a lower ref, of lists of words of two bytes that have as many words in the same order and pairs of neighbours in
    common as `least` says. The pairs are counted first; one pair of lists is enough for an id and a ref. `allowed` tells which
    (i, j) are compared. With `anchors`, arguments of around_anchors(), only pairs that pass it and through() are; with `names`, own
    lists are told apart by these, not by ids. `equal` gets, for each pair found, how many words are equal from the anchors on (the
    most, of several lists of a ref)."""
    words = [[np.frombuffer(x, np.uint16) for x in lists] for lists in (own, others)]
    singles, pairs = [], []
    for lists in words:
        row = np.repeat(np.arange(len(lists)), [len(w) for w in lists])
        flat = np.concatenate(lists).astype(np.uint32)
        inside = np.flatnonzero(row[1:] == row[:-1])
        pairs.append((row[inside], flat[inside] << np.uint32(16) | flat[inside + 1]))
        at = (flat * np.uint32(0x9E3779B1) >> np.uint32(32 - 9)).astype(np.int64)
        singles.append(np.bincount((row << 9) + at, minlength=len(lists) << 9).astype(np.uint8).reshape(-1, 1 << 9))
    i, j = shared_pairs(*pairs, (len(own), len(others)), least[1])
    fine = refs[j] < ids[i]
    i, j = i[fine], j[fine]
    if allowed is not None and len(i):
        fine = allowed(i, j)
        i, j = i[fine], j[fine]
    enough = [np.minimum(singles[0][i[lo : lo + 1024]], singles[1][j[lo : lo + 1024]]).sum(axis=1, dtype=np.int32) >= least[0] for lo in range(0, len(i), 1024)]
    fine = np.concatenate([np.zeros(0, bool), *enough])
    i, j = i[fine], j[fine]
    found: set[tuple[int, int]] = set()
    of_list: dict[int, tuple] = {}
    test = around_anchors(words, *anchors) if anchors and len(i) else None
    names = ids if names is None else names
    for lo in range(0, len(i), 1024):
        x, y = i[lo : lo + 1024], j[lo : lo + 1024]
        if test:
            good = test(x, y)
            x, y = x[good], y[good]
        for p, q in zip(x.tolist(), y.tolist()):
            pair = int(names[p]), int(refs[q])
            if pair not in found:
                a, k = words[0][p].tolist(), anchors[0][1][q] if anchors else 0
                if q not in of_list:
                    b = words[1][q].tolist()
                    of_list[q] = (places(b), places(b[:k][::-1]), places(b[k + K :])) if anchors else (places(b),)
                if subsequences(a, of_list[q][0])[-1] >= least[0]:
                    if not anchors:
                        found.add(pair)
                        continue
                    at = anchors[0][0][p]
                    if through(subsequences(a[:at][::-1], of_list[q][1]), subsequences(a[at + K :], of_list[q][2]), *anchors[1:]):
                        found.add(pair)
            if equal is not None and pair in found:
                a, b = words[0][p][anchors[0][0][p] :], words[1][q][anchors[0][1][q] :]
                n = min(len(a), len(b))
                other = np.flatnonzero(a[:n] != b[:n])
                equal[pair] = max(equal.get(pair, 0), int(other[0]) if len(other) else n)
    return found


def rest(open_: DataFrame, src: DataFrame, min_words: int, min_identity: float) -> DataFrame:
    """(doc, ref, x, until): documents and earlier ones that may share a passage around the k-mer at x of open_(doc, h, x), or around
    those that are left to it, up to the one at until; written.

    Each of these occurrences is held against all earlier ones of its k-mer, in tasks that hold UNIT_ROWS of the first and a batch
    of the others: the pairs of neighbouring words that their surroundings have in common are counted, around_anchors() looks for a
    stretch around the k-mer that may be a passage, then the words in common in the same order are counted, on both sides of
    the k-mer by themselves, too. The surroundings reach so far that a passage of min_words with
    the k-mer lies inside, so it passes. Two occurrences with the same minimiser the same few words before, which is open too, are left
    to that one: the words from there on are equal, so a passage of min_words with both begins there as well. Of two runs of one
    word, equal starts and equal ends are compared: no other place of one beside the other has more words in common.
    """
    least = least_common(min_words, min_identity)
    around = max(min_words - K, 1)
    sized = open_.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > UNIT_ROWS).select("h", F.ceil(F.col("n") / UNIT_ROWS).cast("int").alias("units"))

    def marked(batches):
        for b in batches:
            h, doc, x = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(marks(h.view(np.uint64), (doc << POS_BITS) + x)).view(np.int64))], ["h"])

    sent = bitmap(open_.select("h")), bitmap(open_.select("h", "doc", "x").mapInArrow(marked, "h long"))
    rows = surroundings(src, around, *sent)
    rows = rows.join(bounded(sized, 16), "h", "left").withColumn("units", F.coalesce("units", F.lit(1)))
    dealt = rows.withColumn("unit", F.explode(F.sequence(F.lit(0), F.col("units") - 1)))
    dealt = dealt.select("h", "unit", (~F.col("own") | (F.pmod(F.xxhash64("at"), "units") != F.col("unit"))).alias("other"), "at", "before", "told", "span", "run", "near")
    schema = pa.schema([("doc", pa.int64()), ("ref", pa.int64()), ("x", pa.int32()), ("until", pa.int32())])

    def run(batches):
        key, own, others = None, {}, {}  # (document, minimiser before, run, words before, words) of a unit: a line that repeats in a document counts once

        def compared(refs_: dict):
            """The unit's own occurrences against refs_. Most have the same minimiser before, which then tells for both."""
            mine, all_ = [list(zip(*v)) for v in (own, refs_)]
            places = list(own.values())
            ids, told, run_i, left_i, refs, before, run_j, left_j = (np.array(v, np.int64) for v in (*mine[:4], *all_[:4]))
            kinds, n = np.unique(told, return_counts=True)
            most = kinds[n.argmax()]
            sides = [(told == most, before != most), (told != most, before == before)] if most else [(told == told, before == before)]
            for side, against in sides:
                i, j = np.flatnonzero(side), np.flatnonzero(against)
                for c in range(0, len(j), BLOCK):
                    y = j[c : c + BLOCK]
                    later = i[ids[i] > refs[y].min()]
                    for a in range(0, len(later), BLOCK):
                        x = later[a : a + BLOCK]

                        def allowed(p, q, x=x, y=y):
                            r, t = run_i[x[p]], run_j[y[q]]
                            return ((told[x[p]] != before[y[q]]) | (told[x[p]] == 0)) & ((r == 0) | (t == 0) | (abs(r) == abs(t)) | (r < 0) & (t < 0))

                        anchors = ((left_i[x], left_j[y]), min_words, min_identity)
                        equal: dict[tuple[int, int], int] = {}
                        alike([mine[4][k] for k in x.tolist()], ids[x], [all_[4][k] for k in y.tolist()], refs[y], least, allowed, anchors, x, equal)
                        if equal:
                            # words that are equal up to the end of the surroundings are a passage, and may go on
                            rows = [(mine[0][k], ref, at_, until if n >= min_words else min(until, at_ + n - K)) for (k, ref), n in sorted(equal.items()) for at_, until in places[k]]
                            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

        def ended():
            if own:
                yield from compared(others | {(doc, before, *rest_): None for doc, _, *rest_, before in own})

        for b in batches:
            h, unit, other, at, before, told = (b.column(c).to_numpy(zero_copy_only=False) for c in range(6))
            x = (at & (2**POS_BITS - 1)).tolist()
            spans = list(zip(x, (np.array(x, np.int64) + b.column(6).to_numpy()).tolist()))
            runs, near = b.column(7).to_pylist(), b.column(8)
            doc, told, before_, left = (at >> POS_BITS).tolist(), np.where(told, before, 0).tolist(), before.tolist(), np.minimum(at & (2**POS_BITS - 1), around).tolist()
            edges = np.r_[0, np.flatnonzero((h[1:] != h[:-1]) | (unit[1:] != unit[:-1]) | (other[1:] != other[:-1])) + 1, len(h)]
            for lo, hi in zip(edges.tolist(), edges[1:].tolist()):
                if lo == hi:
                    continue
                if key != (h[lo], unit[lo]):
                    yield from ended()
                    key, own, others = (h[lo], unit[lo]), {}, {}
                if not other[lo]:
                    for k, one in zip(range(lo, hi), zip(doc[lo:hi], told[lo:hi], runs[lo:hi], left[lo:hi], near.slice(lo, hi - lo).to_pylist(), before_[lo:hi])):
                        own.setdefault(one, []).append(spans[k])
                elif own:
                    others |= dict.fromkeys(zip(doc[lo:hi], before_[lo:hi], runs[lo:hi], left[lo:hi], near.slice(lo, hi - lo).to_pylist()))
                    if len(others) >= BLOCK:
                        yield from compared(others)
                        others = {}
        yield from ended()

    parts = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = dealt.repartition(parts, "h", "unit").sortWithinPartitions("h", "unit", "other", "at").mapInArrow(run, "doc long, ref long, x int, until int")
    pairs = written(pairs, "rest-pairs")
    for b in sent:
        b.destroy()
    return pairs


def matches_of(pairs: DataFrame, src: DataFrame) -> DataFrame:
    """matches() of the documents of pairs(doc, ref) alone: an occurrence meets the first and the last of its k-mer in ref."""
    ids = pairs.select(F.col("doc").alias("id")).unionByName(pairs.select(F.col("ref").alias("id"))).distinct()
    some = written(seeds(src.join(bounded(ids, 8), "id")).select(F.shiftright("at", POS_BITS).alias("id"), "h", F.col("at").bitwiseAND(2**POS_BITS - 1).cast("int").alias("x")), "rest-seeds")
    shared = some.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("h")
    some = written(some.hint("merge").join(shared, "h", "left_semi"), "rest-shared")
    ends = some.groupBy(F.col("id").alias("ref"), "h").agg(F.array_distinct(F.array(F.min("x"), F.max("x"))).alias("ys"))
    both = pairs.join(some.withColumnRenamed("id", "doc"), "doc").join(ends, ["ref", "h"])
    return both.select("doc", "ref", "x", F.explode("ys").alias("y"), F.lit(False).alias("least"))


def runs_of_one_word(src: DataFrame, min_words: int) -> DataFrame:
    """(doc, h, x0, x1): where a word of hash h stands min_words times or more in a row in src(id, text)."""

    def run(batches):
        for ids, words, doc, first, *_ in _minimisers_of(batches):
            if len(words):
                begin = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])])
                size = np.diff(np.r_[begin, len(words)])
                at = begin[size >= min_words]
                x = (at - first[doc[at]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(ids[doc[at]]), pa.array(words[at].view(np.int64)), pa.array(x), pa.array(x + size[size >= min_words].astype(np.int32))], ["doc", "h", "x0", "x1"])

    return src.select("id", "text").mapInArrow(run, "doc long, h long, x0 int, x1 int")


def run_passages(runs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The passages of those runs(doc, h, x0, x1) of one word that wanted(doc, h, x0) names: each is held against the longest run of its
    word in an earlier document, side by side as often as it is longer. Any other earlier run has no word of it that this one lacks."""
    earlier = Window.partitionBy("h").orderBy("doc").rangeBetween(Window.unboundedPreceding, -1)
    best = runs.withColumn("best", F.max_by(F.struct(F.col("doc").alias("ref"), "x0", "x1"), F.struct(F.col("x1") - F.col("x0"), -F.col("doc"), -F.col("x0"))).over(earlier))
    best = best.filter("best is not null").join(wanted, ["doc", "h", "x0"], "left_semi")
    n = F.least(F.col("x1") - F.col("x0"), F.col("best.x1") - F.col("best.x0"))
    each = best.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), (F.ceil((F.col("x1") - F.col("x0")) / F.col("n")) - 1).cast("int"))))
    start = F.least(F.col("x0") + F.col("i") * F.col("n"), F.col("x1") - F.col("n"))
    return each.select(
        F.col("doc").alias("doc_id"), start.alias("start"), (start + F.col("n")).alias("stop"), F.col("best.ref").alias("src_doc_id"), F.col("best.x0").alias("src_start"),
        (F.col("best.x0") + F.col("n")).alias("src_stop"), F.col("n").alias("n_words"), F.lit(1.0).alias("identity"),
    )


def _passages(src: DataFrame, min_words: int, min_identity: float) -> DataFrame:
    """passages() of src(id, text), whose ids are all different and fit beside a word position."""
    all_ = written(met(src), "matches")
    found = written(chains(all_.filter("least is not null"), 2 * K), "chains")
    first = written(confirmed(found.filter("least"), src, min_words, min_identity), "passages")
    spans_of = lambda df: df.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    covered = spans_of(first)
    inside = F.exists("spans", lambda s: (s["start"] <= F.col("x0")) & (s["stop"] >= F.col("x1")))
    uncovered = lambda df, spans, test: df.hint("merge").join(spans, "doc", "left").filter(F.coalesce(~test, F.lit(True))).drop("spans")
    others = uncovered(found.filter("not least"), covered, inside)
    out = written(first.unionByName(confirmed(others, src, min_words, min_identity)).distinct(), "first-passages")
    runs = written(runs_of_one_word(src, min_words), "runs")
    covered = spans_of(out)
    out = written(out.unionByName(run_passages(runs, uncovered(runs, covered, inside).select("doc", "h", "x0"))).distinct(), "run-passages")
    covered = spans_of(out)
    seed = F.exists("spans", lambda s: (s["start"] <= F.col("x")) & (s["stop"] >= F.col("x") + K))
    open_ = written(uncovered(all_.filter("least is null"), covered, seed).select("doc", F.col("ref").alias("h"), "x"), "open-seeds")
    if not open_.limit(1).count():
        return out
    left = rest(open_, src, min_words, min_identity)
    in_reach = F.exists("xs", lambda x: (x >= F.col("x")) & (x <= F.col("until")))
    for most in ROUNDS:  # the last one takes all that is left
        xs = open_.groupBy("doc").agg(F.collect_set("x").alias("xs"))
        left = written(left.hint("merge").join(xs, "doc").filter(in_reach).drop("xs"), "rest-left")
        if not left.limit(1).count():
            break
        pairs = left.select("doc", "ref").distinct()
        if most:
            often = left.groupBy("doc", "ref").agg(F.count("*").alias("n"))
            by = Window.partitionBy("doc", "x").orderBy(F.col("n").desc(), "ref")
            ranked = left.hint("merge").join(often, ["doc", "ref"]).withColumn("rank", F.dense_rank().over(by))
            pairs = ranked.filter(F.col("rank") <= most).select("doc", "ref").distinct()
        pairs = written(pairs, "rest-tried")
        late = written(uncovered(chains(matches_of(pairs, src), 2 * K), covered, inside), "rest-chains")
        ids = late.select(F.col("doc").alias("id")).unionByName(late.select(F.col("ref").alias("id"))).distinct()
        out = written(out.unionByName(confirmed(late, src.join(bounded(ids, 8), "id"), min_words, min_identity)).distinct(), "rest-passages")
        if most:
            covered = spans_of(out)
            open_ = written(uncovered(open_, covered, seed), "rest-open")
            left = left.hint("merge").join(pairs, ["doc", "ref"], "left_anti")
    return out


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY) -> DataFrame:
    """(doc_id, start, stop, src_doc_id, src_start, src_stop, n_words, identity): fuzzy passages of at least min_words words.

    Word ranges are half-open and count blank-separated words; identity is equal words over the longer of both ranges;
    words are compared without regard to the case of A-Z. The source is always an earlier document than the copy, in the order of
    the ids, nulls last. Rows that repeat an id or have none are documents of their own: a passage that two of them share is
    reported with their common id, or null, on both sides. Null and empty texts have no passages; repeats inside one document
    are not reported. A text of more than 2**26 words is an error. Extra columns are not read.
    """
    src, number, same = with_numbers(docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text")), "id")
    out = _passages(src.select(F.col(number).alias("id"), "text"), min_words, min_identity)
    names = src.select(F.col(number).alias("__n"), F.col("id").alias("__id"))
    if same:
        return out
    for c in ("doc_id", "src_doc_id"):
        out = spread_join(written(out, "numbered-passages"), names.withColumnRenamed("__n", c), c, ["doc_id", "src_doc_id", "start"]).withColumn(c, F.col("__id")).drop("__id")
    return out.select("doc_id", "start", "stop", "src_doc_id", "src_start", "src_stop", "n_words", "identity")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans; what stays keeps its own blanks."""
    raw = text.encode("utf-8", "surrogatepass")
    edge = np.diff(np.r_[False, _IS_WORD[np.frombuffer(raw, np.uint8)], False].astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, done = [], 0
    for a, b in sorted(spans):
        a, b = int(start[a]), int(stop[b - 1])
        if b > done:
            out.append(raw[done : max(a, done)])
            done = b
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass")


def drop_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY) -> DataFrame:
    """docs, same columns: every passage that a document shares with an earlier one is cut out of the later text.

    Each row is a document, also where ids repeat or are null; see passages(). A document of which nothing but blanks is
    left goes; all others stay. Null and empty texts stay as they are.
    """
    names = docs.columns
    src, number, _ = with_numbers(docs, id_col)
    found = _passages(src.select(F.col(number).alias("id"), text_of(src, text_col).alias("text")), min_words, min_identity)
    cuts = fresh(src, "cuts")
    spans = found.groupBy(F.col("doc_id").alias(number)).agg(F.collect_set(F.struct("start", "stop")).alias(cuts))

    @F.arrow_udf("string")
    def cut(texts, lists):
        return pa.array([cut_words(t, [(s["start"], s["stop"]) for s in x]) if x else t for t, x in zip(texts.to_pylist(), lists.to_pylist())], pa.string())

    joined = src.join(spans, number, "left")
    out = joined.withColumn(text_col, F.when(F.col(cuts).isNotNull(), cut.asNondeterministic()(F.col(text_col), F.col(cuts))).otherwise(F.col(text_col)))
    return out.filter(F.col(cuts).isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(*[F.col(f"`{c}`") for c in names])


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All fuzzy passages of 50 words or more in documents, each with its source."""
    return passages(table(spark, sf_dir, "documents"))
