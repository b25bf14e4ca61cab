"""Vector code compression: integer product quantisation whose nearest entries are looked up by memoised grid cells.

Vectors become integers, are cut into equal parts, and each part is replaced by the index of its nearest codebook entry. A
part falls into a coarse cell of a grid; for each cell the entries that can be nearest to some point of its box (those whose
least distance to the box is not above the smallest of all largest distances) are found once and kept under the cell's
hash, and only those are evaluated exactly. Results equal those of a full search whatever the cell width.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, spread_join, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Cells that a task keeps of one part; a full cache is emptied.
CACHE_CELLS = 200_000
#: Integers up to which squared distances of a part are sure to fit 64 bits (with up to 2^10 components a part).
SMALL = 1 << 25
_MIX = np.uint64(0x9E3779B97F4A7C15)


def kept_vectors(df: DataFrame, vector: str, out: str) -> DataFrame:
    """df with a column `out`: floor(SCALE * x) of each component as longs. Rows whose vector is null, empty, not divisible by
    PARTS or holds a null or non-finite component go. A component of 2^50 or more in size is an error."""
    x = F.col(f"`{vector}`")
    ok = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % PARTS == 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = lambda v: F.when(F.abs(v) < float(1 << 50), F.floor(v.cast("double") * SCALE)).otherwise(F.raise_error("a component of 2^50 or more").cast("bigint"))
    return df.filter(ok).withColumn(out, F.transform(x, whole))


class Codebooks:
    """entries: for each part, its codebook as a list of lists of Python integers."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        big = max((abs(v) for part in entries for e in part for v in e), default=0)
        self.table = np.array(entries, dtype=np.int64 if big <= SMALL else object)

    @property
    def dim(self) -> int:
        return PARTS * self.table.shape[2]

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for part in self.entries for e in part for v in e).encode()).hexdigest()

    @property
    def cell_bits(self) -> int:
        """log2 of the cell width: about a quarter of the spread of the entries' components."""
        spread = float(np.std(self.table.astype(np.float64)))
        return max(0, int(np.log2(spread)) - 2) if spread >= 1 else 0


def candidates(cells: np.ndarray, bits: int, entries: np.ndarray) -> np.ndarray:
    """cells (C, d): coarse coordinates -> (C, E) booleans: entries that no other entry dominates all over the cell's box."""
    lo = (cells << bits)[:, None, :]
    hi = lo + ((1 << bits) - 1)
    c = entries[None]
    near = np.maximum(np.maximum(lo - c, c - hi), 0)
    far = np.maximum(np.abs(c - lo), np.abs(c - hi))
    return (near * near).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1, keepdims=True)


class CellCache:
    """The candidates of one part's cells, by the hash of the cell; a cell that shares its hash with another one is told apart
    by its coordinates and gets all entries."""

    def __init__(self, entries: np.ndarray, bits: int):
        self.entries, self.bits, self.evaluated, self.rows = entries, bits, 0, 0
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.cells = np.zeros((0, self.entries.shape[1]), np.int64)
        self.masks = np.zeros((0, len(self.entries)), bool)

    def masks_of(self, v: np.ndarray) -> np.ndarray:
        cells = v >> self.bits
        with np.errstate(over="ignore"):
            h = np.zeros(len(v), np.uint64)
            for j in range(cells.shape[1]):
                h = (h ^ cells[:, j].astype(np.uint64)) * _MIX
                h ^= h >> np.uint64(29)
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.slot) + len(uniq) > CACHE_CELLS:
            self._forget()
        known = [self.slot.get(k, -1) for k in uniq.tolist()]
        new = [i for i, s in enumerate(known) if s < 0]
        if new:
            fresh_cells = cells[first[new]]
            for n, i in enumerate(new):
                known[i] = self.slot[int(uniq[i])] = len(self.cells) + n
            self.cells = np.concatenate([self.cells, fresh_cells])
            self.masks = np.concatenate([self.masks, candidates(fresh_cells, self.bits, self.entries)])
        at = np.array(known, np.int64)[inverse]
        return self.masks[at] | (self.cells[at] != cells).any(axis=1)[:, None]

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """v (B, d) -> (index of the nearest entry, squared distance); ties go to the lower index."""
        masks = self.masks_of(v)
        best, dist = np.full(len(v), -1, np.int64), np.zeros(len(v), np.int64)
        for e, entry in enumerate(self.entries):
            rows = np.flatnonzero(masks[:, e])
            d = v[rows] - entry
            d = (d * d).sum(axis=1)
            wins = (best[rows] < 0) | (d < dist[rows])
            best[rows[wins]], dist[rows[wins]] = e, d[wins]
        self.evaluated, self.rows = self.evaluated + int(masks.sum()), self.rows + len(v)
        return best, dist


def nearest_exact(v: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same by Python integers of any size, for components beyond SMALL."""
    d = ((v.astype(object)[:, None, :] - entries.astype(object)[None]) ** 2).sum(axis=2)
    best = [min(range(len(row)), key=row.__getitem__) for row in d.tolist()]
    return np.array(best, np.int64), d[np.arange(len(best)), best]


class Searcher:
    """Assigns batches of vectors to one set of codebooks, with one cache a part."""

    def __init__(self, books: Codebooks):
        self.books = books
        small = books.table.dtype != object
        self.caches = [CellCache(part, books.cell_bits) for part in books.table] if small else None

    def assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """v (B, PARTS, d) -> (indexes (B, PARTS), distances (B, PARTS), of Python integers where they may pass 64 bits)"""
        if self.caches and v.size and max(abs(int(v.max())), abs(int(v.min()))) <= SMALL and v.shape[2] <= 1024:
            found = [cache.nearest(v[:, p]) for p, cache in enumerate(self.caches)]
        else:
            found = [nearest_exact(v[:, p], part) for p, part in enumerate(self.books.table)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), PARTS, dim // PARTS)


def _sums(ints: DataFrame, col: str, books: Codebooks) -> list:
    """[(part, entry, position, count, sum)]: at most as many rows as the codebooks have numbers. Tasks send sums only."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, n, total = Searcher(books), np.zeros(books.table.shape[:2], np.int64), np.zeros(books.table.shape, object)
        for batch in batches:
            v = _matrix(batch.column(0), books.dim)
            if not len(v):
                continue
            wide = v if max(abs(int(v.max())), abs(int(v.min()))) <= SMALL else v.astype(object)
            best, _ = search.assign(v)
            for p in range(PARTS):
                for e in np.unique(best[:, p]):
                    rows = best[:, p] == e
                    n[p, e] += int(rows.sum())
                    total[p, e] += wide[rows, p].sum(axis=0)
        p, e, k = (x.ravel() for x in np.indices(total.shape))
        used = n[p, e] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[used], pa.int32()) for x in (p, e, k)] + [pa.array(n[p, e][used], pa.int64()), pa.array([str(t) for t in total.ravel()[used]], pa.string())],
            names=["part", "entry", "position", "n", "total"],
        )

    rows = ints.select(col).mapInArrow(partial, "part int, entry int, position int, n bigint, total string")
    return rows.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()


def first_entries(ints: DataFrame, col: str, order: list[Column]) -> Codebooks | None:
    """The parts of the first ENTRIES vectors in the given order (fewer where there are fewer); None without any."""
    rows = [r[0] for r in ints.orderBy(*order, F.col(col)).select(col).limit(ENTRIES).collect()]
    if not rows:
        return None
    d = len(rows[0]) // PARTS
    return Codebooks([[r[p * d : (p + 1) * d] for r in rows if len(r) == len(rows[0])] for p in range(PARTS)])


def fit(ints: DataFrame, col: str, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """Each round assigns all vectors and moves each used entry to the componentwise floor of its parts' mean. Every round is one
    pass over ints from which at most the codebooks' own size comes back."""
    for _ in range(rounds):
        entries = [[list(e) for e in part] for part in books.entries]
        for r in _sums(ints, col, books):
            entries[r.part][r.entry][r.position] = int(r.total) // r.n
        books = Codebooks(entries)
    return books


def encode(ints: DataFrame, col: str, books: Codebooks) -> DataFrame:
    """ints with `code` (two hex digits a part) and `error` (squared distances summed; null where it passes 64 bits) for col. They
    replace columns of these names."""
    names = [c for c in ints.columns if c != col and c.lower() not in ("code", "error")]
    schema = ints.select(*[F.col(f"`{c}`") for c in names]).schema.add("code", "string").add("error", "long")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(books)
        for batch in batches:
            v = _matrix(batch.column(batch.schema.get_field_index(col)), books.dim)
            best, dist = search.assign(v) if len(v) else (np.zeros((0, PARTS), np.int64), np.zeros((0, PARTS), np.int64))
            raw = best.astype(np.uint8).tobytes().hex()
            error = [x if x < 1 << 63 else None for x in (sum(row) for row in dist.tolist())]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([raw[i : i + 2 * PARTS] for i in range(0, len(raw), 2 * PARTS)], pa.string()), pa.array(error, pa.int64())], names=[*names, "code", "error"])

    return ints.mapInArrow(coded, schema)


def decode(code: Column, books: Codebooks) -> Column:
    """The vector that a code stands for, as doubles: the entries named by its digits, divided by SCALE."""
    lists = F.array(*[F.array(*[F.array(*[F.lit(v / SCALE) for v in e]) for e in part]) for part in books.entries])
    index = lambda p: F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")
    return F.flatten(F.array(*[lists[p][index(p)] for p in range(PARTS)]))


def compress(df: DataFrame, vector: str, order: list[Column]) -> tuple[DataFrame, Codebooks | None]:
    """(the columns of df but the vector, with code and error; the codebooks, None where no vector is left).

    Columns named code or error are replaced. Rows that kept_vectors() leaves out go, and so do those whose vector is not as long as the one that comes first in
    `order` (ties of it: by the vector itself). Repeated rows count as often as they occur.
    """
    col = fresh(df, "whole_numbers")
    ints = written(kept_vectors(df, vector, col).drop(vector), "vectors")
    books = first_entries(ints, col, order)
    if books is None:
        return ints.drop(col, "code", "error").withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("bigint")}), None
    ints = ints.filter(F.size(col) == books.dim)
    books = fit(ints, col, books)
    return encode(ints, col, books), books


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """The contract query. Null labels form one group; a null vec_id comes last; an error that passes 64 bits is null."""
    codes, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), "embedding", [F.col("vec_id").asc_nulls_last()])
    codes = written(codes, "codes").withColumn("__label", F.to_json(F.struct("label"), {"ignoreNullFields": "false"}))
    sums = codes.groupBy("__label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error"))
    joined = spread_join(codes, sums, "__label", ["vec_id"])  # one label may hold a third of the rows
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256 if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))


def oracle() -> str:
    """DuckDB SQL: parts as rows of (part, position, value), one pair of common table expressions a round."""
    steps = [
        f"""ints AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {PARTS} = 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS x FROM ints, range({PARTS}) t(p))""",
        f"""c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
            QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES})""",
    ]
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: CAST(z[1] - z[2] AS HUGEINT) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, p, any_value(x) AS x, min(ROW({distance}, e)) AS best FROM parts JOIN c{r} USING (p) GROUP BY vec_id, label, p)""")
        if r < ROUNDS:
            steps.append(f"""s{r} AS MATERIALIZED (SELECT p, e, list(CAST(m AS BIGINT) ORDER BY k) AS c FROM (SELECT p, best[2] AS e, k, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS m
                FROM (SELECT p, best, unnest(x) AS y, generate_subscripts(x, 1) AS k FROM a{r}) GROUP BY p, best[2], k) GROUP BY p, e)""")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(s.c, o.c) AS c FROM c{r} o LEFT JOIN s{r} s ON o.p = s.p AND o.e = s.e)")
    steps.append(f"coded AS (SELECT vec_id, label, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id, label)")
    steps.append(f"sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, sha"
