"""SimHash near-duplicates: pivot distance tables discard pairs, the Hamming distance verifies the rest.

Pairs meet in blocks: a fingerprint has segments, and two fingerprints within the distance must agree on
one of the registered segment sets. Inside a block a table of distances to fixed reference fingerprints
is computed once per row; |d(x,p) - d(y,p)| <= d(x,y) holds for every reference p, so a pair whose largest
coordinate difference exceeds the allowed distance is discarded without looking at its bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, spread_join, text_of, written
from .components import components

SEED = 42
PIVOTS = 16
BLOCK_ROWS = 2048  # expected fingerprints of a block side; larger groups are compared block by block


def splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def reference_fingerprints(n: int, lanes: int) -> np.ndarray:
    """n fixed pseudo-random fingerprints of `lanes` 64-bit words."""
    return splitmix(np.arange(1, n * lanes + 1, dtype=np.uint64)).reshape(n, lanes)


def shingle_hashes(text: str, k: int) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([h(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - k].tolist()]
    stops = (ends[k - 1 :] - 1).tolist()
    return np.fromiter((h(line[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))


LANE_SEEDS = np.array([lane * 0xD1342543DE82EF95 % 2**64 for lane in range(64)], np.uint64)


def fingerprint_of(h: np.ndarray, lanes: int = 1) -> np.ndarray:
    """`lanes` 64-bit words of the hashes h of shingles: a bit is 1 if more than half of them have it."""
    ones = np.zeros(lanes * 64, np.int64)
    for at in range(0, len(h), 255 * 16):  # a very long text in blocks
        x = h[at : at + 255 * 16, None] ^ LANE_SEEDS[:lanes]
        x[:, 1:] = splitmix(x[:, 1:])  # the first word is that of the hashes themselves
        bits = np.unpackbits(x.astype(">u8").view(np.uint8).reshape(len(x), -1), axis=1)
        if lanes == 1:
            ones += bits.sum(axis=0, dtype=np.uint16)
            continue
        for lo in range(0, len(bits), 255):
            ones += np.add.reduce(bits[lo : lo + 255], axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h)).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp binary) for every row; a null text counts as empty and gets the zero fingerprint."""

    def run(batches):
        for b in batches:
            fps = [fingerprint_of(shingle_hashes(t.as_py(), shingle)).astype(">u8").tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.binary())], ["id", "fp"])

    src = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    return src.mapInArrow(run, "id long, fp binary")


def segment_sets(max_distance: int) -> list[np.ndarray]:
    """Bit positions of each block key: 2 * max_distance segments, taken max_distance at a time. max_distance differing bits touch
    at most that many segments, so the others agree and no linked pair is lost."""
    parts = np.array_split(np.arange(64), 2 * max_distance)
    return [np.concatenate(c) for c in combinations(parts, max_distance)]


def _keys(raw: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    bits = np.unpackbits(raw, axis=1).astype(np.int64)
    return np.stack([(i << 40) + bits[:, s] @ (1 << np.arange(len(s), dtype=np.int64)) for i, s in enumerate(sets)], axis=1)


def _links(run: np.ndarray, fp: np.ndarray, refs: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each run of equal `run` values; rows of a run need not be ordered."""
    table = np.bitwise_count(fp[:, None, :] ^ refs[None, :, :]).sum(axis=2, dtype=np.int16)
    order = np.lexsort((table[:, 0], run))
    run, table, fp = run[order], table[order], fp[order]
    n = len(run)
    label = np.arange(n)
    out_a, out_b = [], []

    def root(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    alive, shift = np.arange(n - 1), 1
    while len(alive):
        other = alive + shift
        ok = other < n
        alive, other = alive[ok], other[ok]
        ok = (run[alive] == run[other]) & (table[other, 0] - table[alive, 0] <= limit)
        alive, other = alive[ok], other[ok]
        a, b = alive, other
        for p in range(1, table.shape[1]):  # the largest coordinate difference, coordinate by coordinate
            ok = np.abs(table[a, p] - table[b, p]) <= limit
            a, b = a[ok], b[ok]
        ok = np.bitwise_count(fp[a] ^ fp[b]).sum(axis=1) <= limit
        a, b = a[ok], b[ok]
        ok = label[a] != label[b]
        for x, y in zip(a[ok].tolist(), b[ok].tolist()):
            rx, ry = root(x), root(y)
            if rx != ry:
                label[max(rx, ry)] = min(rx, ry)
                out_a.append(x)
                out_b.append(y)
        while len(a) and (label[label] != label).any():
            label = label[label]
        shift += 1
    return order[np.array(out_a, int)], order[np.array(out_b, int)]


def fingerprint_links(fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """(a, b): links between distinct fingerprints fps(fp) that connect all that lie within max_distance.

    Not every pair is returned, but a spanning forest of each block: what is connected stays connected.
    A block key shared by more than BLOCK_ROWS fingerprints is split in chunks, and each pair of chunks is a unit
    of its own, so no task holds an unbounded group.
    """
    sets, refs = segment_sets(max_distance), reference_fingerprints(PIVOTS, 1)

    def as_matrix(col) -> np.ndarray:
        return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, 8)

    def keyed(batches):
        for b in batches:
            if b.num_rows:
                k = _keys(as_matrix(b.column(0)), sets)
                rows = pa.array(np.repeat(np.arange(b.num_rows), len(sets)))
                yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), b.column(0).take(rows)], ["key", "fp"])

    def linked(batches):
        empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 8), np.uint8)
        held, size = [], 0

        def close(parts, last):
            key, i, j, raw = (np.concatenate(x) for x in zip(*parts)) if parts else empty
            if not len(key):
                return empty, []
            new = np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
            cut = len(key) if last else int(np.flatnonzero(new)[-1])
            rest = key[cut:], i[cut:], j[cut:], raw[cut:]
            if not cut:
                return rest, []
            a, b = _links(np.cumsum(new[:cut]), raw[:cut].view(">u8").astype(np.uint64).reshape(cut, 1), refs, max_distance)
            return rest, [pa.RecordBatch.from_arrays([pa.array([raw[x].tobytes() for x in s], pa.binary()) for s in (a, b)], ["a", "b"])]

        for b in batches:
            if not b.num_rows:
                continue
            held.append((*(b.column(c).to_numpy(zero_copy_only=False) for c in range(3)), as_matrix(b.column(3))))
            size += b.num_rows
            if size >= 20_000:
                rest, out = close(held, False)
                held, size = [rest], len(rest[0])
                yield from out
        yield from close(held, True)[1]

    keys = fps.select("fp").mapInArrow(keyed, "key long, fp binary")
    full = keys.groupBy("key").count().filter(F.col("count") > BLOCK_ROWS).select("key", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("chunks"))
    split = keys.join(full, "key", "left").withColumn("c", F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int"))
    units = split.withColumn("o", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))).select(
        "key", F.least("c", "o").cast("long").alias("i"), F.greatest("c", "o").cast("long").alias("j"), "fp"
    )
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(linked, "a binary, b binary")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """(id, fp, component_id): component_id is the least id that links of at most max_distance bits reach.

    One row per input row. Null and empty texts share the zero fingerprint and are linked by it; rows with a null id keep
    a row, and never become a component_id unless the whole component lacks ids (then it is null). Repeated
    ids are judged row by row. Extra columns are not read. An empty table gives no rows.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("rep")), "nodes")
    roots = components(fingerprint_links(nodes, max_distance))
    grouped = written(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_fp = written(spread_join(grouped, least, "root", ["fp"]).select("fp", "component_id"), "component-ids")
    return spread_join(fps, by_fp, "fp", ["row"]).select("id", "fp", "component_id")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """The contract query: three-word shingles, 64 bits, links at three or fewer differing bits."""
    from .common import table

    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
