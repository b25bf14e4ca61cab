"""Labelled rows that a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_bytes: int) -> list[tuple[bytes, int]]:
    """[(text, label)] of labelled rows that are not held out: at most per_class texts of each class, of at most max_bytes bytes,
    among those that documents hold. An id with both labels is left out; of an id that repeats, the least text is taken."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("__y")).filter("doc_id is not null and __y in (0, 1)").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__most")).filter("__y = __most").drop("__most")
    texts = docs.select("doc_id", text_of(docs).cast("binary").alias("__t")).filter(F.octet_length("__t") <= max_bytes)
    there = texts.select("doc_id").distinct().join(known, "doc_id")
    picked = [there.filter(F.col("__y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    rows = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").groupBy("doc_id", "__y").agg(F.min("__t").alias("__t")).collect()
    return [(bytes(r["__t"]), r["__y"]) for r in sorted(rows, key=lambda r: r.doc_id)]
