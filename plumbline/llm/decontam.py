"""Benchmark decontamination with a generalised suffix automaton over the words of the test items."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, bounded, fresh, numbered_rows, once_per_worker, table, text_of, written
from .simhash import splitmix
from .substring import word_hashes

WINDOW = 13
#: Words of test items in one automaton (about 0.1 GB in a task). A larger benchmark is dealt over several automata, and a document
#: goes only to those with one of its windows, told by hashes.
SHARD_WORDS = 200_000
#: Hashes of item windows that one pass over the documents looks up: what the driver collects and broadcasts, 12 bytes each.
PASS_WINDOWS = 4_000_000
GROUP_DOCS = 256  # documents that an automaton built for one shard scans in one task
HIT = "struct<n_words:long,items:array<string>,spans:array<struct<start:long,stop:long>>>"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class Automaton:
    """All substrings of all items, in word ids. States know which items hold the window or whole item they end with."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ids = [(name, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for name, ws in items if ws]
        for _, seq in ids:
            last = 0
            for c in seq:
                last = self._add(last, c)
        self.shortest = min((min(len(s), window) for _, s in ids), default=0)
        self._own(ids)

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, c: int) -> int:
        q = self.step[last].get(c)
        if q is not None:  # an earlier item has this prefix
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        now, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = now
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[now] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return now

    def _own(self, ids) -> None:
        n, w = len(self.length), self.window
        self.of_window = [-1] * n  # the ancestor that ends with the last `window` words
        self.wholes: list[int] = [-1] * n  # the nearest state, itself included, that ends with a whole short item
        self.short: dict[int, tuple[int, set[str]]] = {}
        self.owners: dict[int, set[str]] = {}
        order = sorted(range(1, n), key=self.length.__getitem__)
        for s in order:
            if self.length[s] >= w:
                self.of_window[s] = s if self.length[self.link[s]] < w else self.of_window[self.link[s]]
        for name, seq in ids:
            s = 0
            for at, c in enumerate(seq):
                s = self.step[s][c]
                if at + 1 >= w:
                    self.owners.setdefault(self.of_window[s], set()).add(name)
            if len(seq) < w:
                self.short.setdefault(s, (len(seq), set()))[1].add(name)
        for s in order:
            self.wholes[s] = s if s in self.short else self.wholes[self.link[s]]

    def scan(self, words: list[bytes]) -> tuple[set[str], list[tuple[int, int]]]:
        """Items found, and the half-open word ranges covered by occurrences, in order and merged."""
        found: set[str] = set()
        spans: list[list[int]] = []
        if not self.shortest or len(words) < self.shortest:
            return found, []
        get = self.vocab.get
        ids = np.fromiter((get(x, -1) for x in words), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False].astype(np.int8)))
        step, link, length, w = self.step, self.link, self.length, self.window
        for start, stop in edge.reshape(-1, 2).tolist():
            if stop - start < self.shortest:  # a word that no item has ends every match
                continue
            s = size = 0
            for at, c in enumerate(ids[start:stop].tolist(), start + 1):
                while s and c not in step[s]:
                    s = link[s]
                    size = length[s]
                s = step[s].get(c, 0)
                size = size + 1 if s else 0
                longest = 0
                if size >= w:
                    longest = w
                    found |= self.owners[self.of_window[s]]
                q = self.wholes[s] if s else -1
                while q > 0:
                    n, names = self.short[q]
                    if n <= size:
                        found |= names
                        longest = max(longest, n)
                    q = self.wholes[link[q]]
                if longest:
                    a = at - longest
                    while spans and spans[-1][0] >= a:
                        spans.pop()
                    if spans and spans[-1][1] >= a:
                        spans[-1][1] = at
                    else:
                        spans.append([a, at])
        return found, [(a, b) for a, b in spans]


def _hit_column(text: Column, items: list[tuple[str, list[bytes]]]) -> Column:
    name = f"automaton-{uuid.uuid4().hex}"

    @F.arrow_udf(HIT)
    def hits(column: pa.Array) -> pa.Array:
        automaton = once_per_worker(name, lambda: Automaton(items))
        out = []
        for t in column:
            words = words_of(t.as_py() or "")
            found, spans = automaton.scan(words)
            out.append({"n_words": len(words), "items": sorted(found), "spans": [{"start": a, "stop": b} for a, b in spans]})
        kind = pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
        return pa.array(out, kind)

    return hits.asNondeterministic()(text)


def window_hashes(text: str, lengths) -> dict[int, np.ndarray]:
    """length -> hashes of all runs of so many words."""
    words, _ = word_hashes(text.encode("utf-8", "surrogatepass").translate(WORD_BYTES))
    out = {}
    with np.errstate(over="ignore"):
        for n in lengths:
            m = max(0, len(words) - n + 1)
            x = words[:m].copy()
            for j in range(1, n):
                x = x * np.uint64(0xD6E8FEB86659FD93) + words[j : j + m]
            out[n] = splitmix(x + np.uint64(n))
    return out


def _item_windows(items: DataFrame) -> DataFrame:
    """items(shard, t) -> (shard, n, h): the distinct windows of each shard, n words long, by hash."""

    def run(batches):
        for b in batches:
            for shard, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = min(WINDOW, len(words_of(t)))
                if n:
                    h = np.unique(window_hashes(t, [n])[n]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), shard, np.int32)), pa.array(np.full(len(h), n, np.int32)), pa.array(h)], ["shard", "n", "h"])

    return items.select("shard", "t").mapInArrow(run, "shard int, n int, h long").distinct()


def _with_shards(text: Column, h: np.ndarray, shard: np.ndarray, lengths: list[int]) -> Column:
    """struct(n_words, shards): which shards have a window of the text; h is sorted."""

    @F.arrow_udf("struct<n_words:long,shards:array<int>>")
    def found(column: pa.Array) -> pa.Array:
        out = []
        for t in column:
            t = t.as_py() or ""
            mine = [x for x in window_hashes(t, lengths).values() if len(x)]
            mine = np.unique(np.concatenate(mine)).view(np.int64) if mine else np.zeros(0, np.int64)
            lo, hi = np.searchsorted(h, mine), np.searchsorted(h, mine, side="right")
            hit = hi > lo
            at = np.concatenate([np.arange(a, b) for a, b in zip(lo[hit], hi[hit])]) if hit.any() else np.zeros(0, np.int64)
            out.append({"n_words": len(words_of(t)), "shards": np.unique(shard[at]).tolist()})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("shards", pa.list_(pa.int32()))]))

    return found.asNondeterministic()(text)


def _scanned(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """candidates(row, t, shard) and items(shard, n, t) -> (row, items, spans): each shard's automaton over its documents."""
    groups = candidates.groupBy("shard").agg(F.ceil(F.count("*") / GROUP_DOCS).cast("int").alias("parts"))
    groups = F.broadcast(written(groups, "shards"))  # one row a shard
    docs = candidates.join(groups, "shard").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    of = items.join(groups, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(docs: pa.Table, items: pa.Table) -> pa.Table:
        automaton = Automaton(sorted((n, words_of(t)) for n, t in zip(items["n"].to_pylist(), items["t"].to_pylist()))) if docs.num_rows else None
        hits = [automaton.scan(words_of(t)) for t in docs["t"].to_pylist()]
        return pa.table({"row": docs["row"], "items": pa.array([sorted(f) for f, _ in hits], pa.list_(pa.string())), "spans": pa.array([[{"start": a, "stop": b} for a, b in s] for _, s in hits], spans)})

    left, right = docs.select("shard", "part", "row", "t"), of.select("shard", "part", "n", "t")
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(run, "row long, items array<string>, spans array<struct<start:long,stop:long>>")


def _merged(spans: Column) -> Column:
    """Disjoint ranges, in order, of overlapping or touching ones."""
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<struct<start:long,stop:long>>"),
        lambda a, x: F.when((F.size(a) > 0) & (F.coalesce(F.get(a, F.size(a) - 1)["stop"], F.lit(-1)) >= x["start"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last(a)["start"].alias("start"), F.greatest(last(a)["stop"], x["stop"]).alias("stop"))))
        ).otherwise(F.concat(a, F.array(x))),
    )


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", name: str = "__hit") -> DataFrame:
    """docs with a struct column: n_words, items (sorted names found), spans (disjoint word ranges hit).

    A null text has no words. Items without words never occur; a null item id goes by the empty name; an id that repeats
    counts once. Everything passes through, whatever columns docs has; one called `name` is replaced.

    A benchmark of at most about SHARD_WORDS words is one automaton and one pass. A larger one is dealt by hash over shards: a
    pass looks up the hashes of the documents' windows, and only documents with a hit are scanned, by the automata of the
    shards that they hit; the documents are written once, however many shards there are.
    """
    src = benchmark.select(F.coalesce(benchmark[item_col].cast("string"), F.lit("")).alias("n"), text_of(benchmark, item_text).alias("t"))
    size = src.agg(F.sum(F.length("t"))).first()[0] or 0
    shards = max(1, -(-size // (6 * SHARD_WORDS)))
    if shards == 1:
        items = [(r.n, words_of(r.t)) for r in src.sort("n", "t").collect()]
        return docs.withColumn(name, _hit_column(text_of(docs, text_col), items))
    items = written(src.withColumn("shard", F.pmod(F.xxhash64("n", "t"), F.lit(shards)).cast("int")), "items")
    windows = written(_item_windows(items), "item-windows")
    passes = max(1, -(-windows.count() // PASS_WINDOWS))
    cell = F.pmod(F.xxhash64("h"), F.lit(passes))
    kept, row = numbered_rows(docs, "documents")
    hits = []
    for k in range(passes):
        rows = windows.filter(cell == k).select("h", "shard", "n").toPandas().sort_values(["h", "shard"])
        found = _with_shards(text_of(kept, text_col), rows["h"].to_numpy(), rows["shard"].to_numpy(), sorted(set(rows["n"].tolist())))
        hits.append(written(kept.select(F.col(row).alias("row"), found.alias("f")).select("row", "f.*"), "window-hits"))
    n_words = hits[0].select("row", "n_words")
    places = hits[0].select("row", F.explode("shards").alias("shard"))
    for more in hits[1:]:
        places = places.unionByName(more.select("row", F.explode("shards").alias("shard")))
    texts = kept.select(F.col(row).alias("row"), text_of(kept, text_col).alias("t"))
    candidates = written(texts.join(bounded(places.distinct(), 16), "row"), "candidates")
    found = _scanned(candidates, items).groupBy("row").agg(F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    found = written(found.select("row", F.array_sort(F.array_distinct("items")).alias("items"), _merged(F.col("spans")).alias("spans")), "hits")
    each = n_words.join(found, "row", "left")
    hit = F.struct("n_words", F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:long,stop:long>>")).alias("spans"))
    return kept.drop(name).join(each.select(F.col("row").alias(row), hit.alias(name)), row).drop(row)


def n_hit(hit: str = "__hit") -> Column:
    return F.aggregate(F.col(hit)["spans"], F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])


def contaminated(hit: str = "__hit") -> Column:
    """More than nothing and at least a twentieth of the words are hit."""
    return (n_hit(hit) > 0) & (20 * n_hit(hit) >= F.col(hit)["n_words"])


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the characters from the first to the last word of each span."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_span: int | None = None) -> DataFrame:
    """docs without the contaminated rows, same columns.

    A row goes if its coverage reaches a twentieth. If max_span is given, spans of at least so many words are also cut out
    of the texts of the rows that stay; other texts are left as they are. Null texts stay.
    """
    hit = fresh(docs, "hit")
    kept = with_hits(docs, benchmark, text_col, name=hit).filter(~contaminated(hit))
    if max_span is not None:

        @F.arrow_udf("string")
        def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
            out = []
            for t, s in zip(texts, spans):
                t = t.as_py()
                long = [(x["start"], x["stop"]) for x in s.as_py() or [] if x["stop"] - x["start"] >= max_span]
                out.append(cut_spans(t, long) if t and long else t)
            return pa.array(out, pa.string())

        kept = kept.withColumn(text_col, cut(F.col(text_col), F.col(hit)["spans"]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """The contract query over all documents and all test items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = with_hits(docs, table(spark, sf_dir, "benchmark"))
    return hit.select(
        "doc_id", F.col("__hit")["n_words"].alias("n_words"), n_hit().alias("n_hit"), F.size(F.col("__hit")["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.col("__hit")["items"]), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x{{7F}}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x{{7F}}]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) AS g
  FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
occ AS (SELECT doc_id, i, n, item_id FROM pos JOIN win USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
