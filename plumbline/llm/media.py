"""Media columns stored as content-defined chunks.

A rolling gear hash cuts payloads where the bytes say so; chunks are known by their SHA-256, and Spark joins decide which
medium keeps the bytes of a chunk that several share. What is stored of a chunk is a cell: its length, its digest and its bytes.
The store has one row per distinct payload with the cells it keeps; an ordered chunk list per payload rebuilds it, and the
digests of all chunks and of the payload are verified on the way back.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, spread_join, table, text_of, written
from .simhash import splitmix

UNIT, PAD = 576, b"\xff"
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 512, 16384, 11
GEAR = (splitmix(np.arange(1001, 1257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
CELL_HEAD = 36  # bytes of a cell before the chunk: its length and its SHA-256


def payload_of(text: str) -> bytes:
    raw = text.encode("utf-8", "surrogatepass")
    return raw + PAD * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def cuts(data: bytes) -> list[int]:
    """Where chunks end. The gear hash of the last 32 bytes is sum(GEAR[b[i-j]] << j), built by doubling the window."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for shift in (1, 2, 4, 8, 16):
        g = h.copy()
        g[shift:] += h[:-shift] << np.uint32(shift)
        h = g
    marks = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    out, at, k = [], 0, 0
    marks = marks.tolist()
    while at < len(data):
        while k < len(marks) and marks[k] < at + MIN_CHUNK:
            k += 1
        end = min(marks[k] if k < len(marks) else len(data), at + MAX_CHUNK, len(data))
        out.append(end)
        at = end
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def payload_column(text: Column) -> Column:
    """payload_of() as a Spark expression."""
    raw = F.encode(text, "UTF-8")
    n = F.length(raw)
    return F.concat(raw, F.unhex(F.repeat(F.lit("FF"), (F.greatest(F.ceil(n / UNIT), F.lit(1)) * UNIT - n).cast("int"))))


def cell(chunk: bytes) -> bytes:
    return len(chunk).to_bytes(4, "little") + hashlib.sha256(chunk).digest() + chunk


def features(cells: list[bytes]) -> dict:
    """What the contract asks of a medium, from its stored cells; ValueError where a cell is damaged."""
    form, parts = hashlib.sha256(), []
    for c in cells:
        form.update(c)
        parts.append(c[CELL_HEAD:])
        if int.from_bytes(c[:4], "little") != len(parts[-1]) or hashlib.sha256(parts[-1]).digest() != c[4:CELL_HEAD]:
            raise ValueError("a stored chunk does not have its length and digest")
    data = b"".join(parts)
    x = np.frombuffer(data, np.uint8)
    counts = np.bincount(x >> 5, minlength=8).tolist()
    return {
        "n_bytes": len(data.rstrip(PAD)), "payload_bytes": len(data), "payload_sha256": hashlib.sha256(data).hexdigest(), "tail_crc32": zlib.crc32(data[-32:]),
        "media_bytes": sum(map(len, cells)), "media_sha256": form.hexdigest(), "feature": f"chunks={len(parts)};sum={int(x.sum(dtype=np.int64))};hist={'/'.join(map(str, counts))}",
    }


FEATURES = "n_bytes:long,payload_bytes:long,payload_sha256:string,tail_crc32:long,media_bytes:long,media_sha256:string,feature:string"
_KIND = pa.struct([(c.split(":")[0], pa.int64() if c.endswith("long") else pa.string()) for c in FEATURES.split(",")])


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """-> (lists, kept, foreign), written tables.

    lists(row, id, media, digests): one row per input row, its payload's SHA-256 and ordered chunk digests. kept(media, cells): per
    distinct payload, once, its cells in order, null where another keeps the chunk. foreign(media, pos, digest, owner, owner_pos):
    those chunks and who keeps them. The owner of a chunk is the least (media, pos) that has it.

    A payload is stored from the row of its least id, nulls last; where several rows have that id and payload, they are first
    reduced to one by a shuffle of those rows alone.
    """
    src = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))

    def listed(batches):
        for b in batches:
            rows = []
            for t in b.column(1):
                data = payload_of(t.as_py())
                rows.append((hashlib.sha256(data).digest(), [hashlib.sha256(c).digest() for c in chunks(data)]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.binary()))], ["id", "media", "digests"])

    lists = src.mapInArrow(listed, "id long, media binary, digests array<binary>")
    lists = written(lists.select(F.monotonically_increasing_id().alias("row"), "id", "media", "digests"), "chunk-lists")
    by_id = lists.groupBy("media", "id").agg(F.count("*").alias("n"), F.any_value("digests").alias("digests"))
    by_id = written(by_id, "payloads")
    recipes = by_id.groupBy("media").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("keeper"), F.any_value("digests").alias("digests"))
    recipes = written(recipes.select("media", F.col("keeper.id").alias("keeper"), "digests"), "recipes")
    each = recipes.select("media", F.posexplode("digests").alias("pos", "digest"))
    owners = each.groupBy("digest").agg(F.min(F.struct("media", "pos")).alias("o"), F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = spread_join(each, owners, "digest", ["media", "pos"]).filter("media <> o.media or pos <> o.pos")
    foreign = written(shared.select("media", "pos", "digest", F.col("o.media").alias("owner"), F.col("o.pos").alias("owner_pos")), "foreign-chunks")
    skip = foreign.groupBy("media").agg(F.collect_list("pos").alias("skip"))
    duties = by_id.select("media", "id", "n").join(recipes.select("media", "keeper"), "media").join(skip, "media", "left")
    duties = duties.select(F.col("media").alias("of"), F.col("id").alias("of_id"), F.col("id").eqNullSafe(F.col("keeper")).alias("keep"), (F.col("n") > 1).alias("many"), "skip")
    duties = written(duties.filter("not keep or many or skip is not null"), "chunk-duties")  # all others keep all their chunks

    @F.arrow_udf("array<binary>")
    def cells(texts, skips):
        out = []
        for t, s in zip(texts, skips):
            drop = set(s.as_py() or [])
            out.append([None if i in drop else cell(c) for i, c in enumerate(chunks(payload_of(t.as_py())))])
        return pa.array(out, pa.list_(pa.binary()))

    cells = cells.asNondeterministic()
    listed_ = bounded(duties, F.lit(64) + 4 * F.greatest(F.size("skip"), F.lit(0)))
    media = F.unhex(F.sha2(payload_column(F.col("text")), 256))
    joined = src.withColumn("media", media).join(listed_, (F.col("media") == F.col("of")) & F.col("id").eqNullSafe(F.col("of_id")), "left").filter("keep is null or keep")
    kept = joined.filter("many is null or not many").select("media", cells("text", "skip").alias("cells"))
    if duties.filter("keep and many").limit(1).count():
        once = joined.filter("many").groupBy("media").agg(F.any_value("text").alias("text"), F.any_value("skip").alias("skip"))
        kept = kept.unionByName(once.select("media", cells("text", "skip").alias("cells")))
    return lists, written(kept, "chunks"), foreign


def rebuilt(kept: DataFrame, foreign: DataFrame) -> DataFrame:
    """(media, f): features of every distinct payload, from the stored cells; an error where a digest does not hold."""

    @F.arrow_udf(f"struct<{FEATURES}>")
    def read(media, lists):
        out = []
        for m, cells in zip(media, lists):
            f = features(cells.as_py())
            if f["payload_sha256"] != m.as_py().hex():
                raise ValueError("a rebuilt payload does not have its digest")
            out.append(f)
        return pa.array(out, _KIND)

    read = read.asNondeterministic()
    partly = F.exists("cells", lambda c: c.isNull())
    own = kept.filter(partly).select("media", F.posexplode("cells").alias("pos", "cell")).filter("cell is not null")
    wanted = foreign.select("owner", "owner_pos").distinct().groupBy("owner").agg(F.collect_list("owner_pos").alias("need"))
    wanted = bounded(wanted, F.lit(48) + 4 * F.size("need"))
    lent = kept.join(wanted, F.col("media") == F.col("owner")).select(F.explode(F.transform("need", lambda p: F.get("cells", p))).alias("cell"))
    lent = lent.select(F.substring("cell", 5, 32).alias("digest"), "cell")
    borrowed = spread_join(foreign.select("media", "pos", "digest"), lent, "digest", ["media", "pos"]).select("media", "pos", "cell")
    joined = own.unionByName(borrowed).groupBy("media").agg(F.array_sort(F.collect_list(F.struct("pos", "cell"))).alias("c")).select("media", F.col("c.cell").alias("cells"))
    return kept.filter(~partly).select("media", read("media", "cells").alias("f")).unionByName(joined.select("media", read("media", "cells").alias("f")))


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the contract's columns): one row per input row. A null text is empty, and its payload is one unit of padding.

    Rows that repeat and null ids keep their rows; equal texts share one stored payload. Extra columns are not read.
    """
    lists, kept, foreign = store(docs, id_col, text_col)
    of = written(rebuilt(kept, foreign), "media-features")
    return spread_join(lists.select("row", "id", "media"), of, "media", ["row"]).select("id", "f.*")


def op10_media_chunks(spark, sf_dir: str) -> DataFrame:
    """The contract query over every whole text of documents."""
    return media_features(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
