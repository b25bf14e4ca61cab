"""Best-fit packing under conflicts: no bin holds two documents of one source or of one duplicate cluster.

Bins are ordered by what is left in them and carry bitmaps of the sources and clusters they hold. For a document the
search starts at the tightest bin with room and goes on through its successors to the first compatible one.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered_rows, table, text_of

CAPACITY = 2048
#: Expected documents of a group that is packed by itself: the bound of what a task holds.
GROUP_ROWS = 8192


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item, in the given order. sources and clusters are small numbers, -1 conflicts with nothing."""
    open_bins: list[tuple[int, int]] = []  # (left, bin), ascending
    held: list[tuple[int, int]] = []  # bitmaps of sources and clusters by bin
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = 1 << source if source >= 0 else 0, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            b_s, b_c = held[open_bins[at][1]]
            if not (b_s & s or b_c & c):
                left, b = open_bins.pop(at)
                break
            at += 1
        else:
            left, b = capacity, len(held)
            held.append((0, 0))
        out.append((b, capacity - left))
        held[b] = held[b][0] | s, held[b][1] | c
        if left > size:
            insort(open_bins, (left - size, b))
    return out


def pack(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """items(id, source, cluster, size) -> (id, part, bin_id, start, size), one row per part of an item.

    An item above the capacity fills whole bins of its own; its last part is packed as any other. Items go by falling
    size, then id. A null source or cluster conflicts with nothing; a null or negative size counts as 0; an item of size 0
    has one part. Rows that repeat are items of their own. Items are dealt by a hash of their place in the table to groups of
    about group_rows, however many of them are equal, and each group has its own bins. An empty table gives no rows.
    """
    src = items.select(F.col("id").cast("long").alias("id"), F.col("source").cast("string").alias("source"), F.col("cluster").cast("string").alias("cluster"), F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    rows, row = numbered_rows(src, "items")
    groups = max(1, -(-rows.count() // group_rows))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["g"].iloc[0])
        pdf = pdf.sort_values(["size", "id", "source", "cluster"], ascending=[False, True, True, True])
        pdf = pdf.assign(rest=pdf["size"] % capacity, full=pdf["size"] // capacity)
        pdf.loc[(pdf["rest"] == 0) & (pdf["full"] > 0), "rest"] = -1
        last = pdf[pdf["rest"] >= 0].sort_values(["rest", "id", "source", "cluster"], ascending=[False, True, True, True], kind="stable")
        placed = best_fit(last["rest"].tolist(), pd.factorize(last["source"])[0].tolist(), pd.factorize(last["cluster"])[0].tolist(), capacity)
        rows = [(i, f, b, at, r) for i, f, r, (b, at) in zip(last["id"], last["full"], last["rest"], placed)]
        bins = 1 + max((b for b, _ in placed), default=-1)
        for i, f in zip(pdf["id"], pdf["full"]):
            for part in range(int(f)):
                rows.append((i, part, bins, 0, capacity))
                bins += 1
        out = pd.DataFrame(rows, columns=["id", "part", "bin_id", "start", "size"])
        out["bin_id"] += group << 32
        return out.astype({"id": "Int64"})

    dealt = rows.withColumn("g", F.pmod(F.xxhash64(row), F.lit(groups))).drop(row)
    return dealt.groupBy("g").applyInPandas(one, "id long, part long, bin_id long, start long, size long")


def items_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, cluster, size): the size counts blank-separated words; texts equal but for case and blanks are a cluster."""
    text = F.trim(F.regexp_replace(text_of(docs, text_col), r"[\x20\x09-\x0D]+", " "))
    plain = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), text.alias("text"))
    words = F.when(F.col("text") == "", 0).otherwise(F.length("text") - F.length(F.translate("text", " ", "")) + 1)
    return plain.select("id", "source", F.xxhash64(F.lower("text")).alias("cluster"), words.alias("size"))


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into bins of CAPACITY words."""
    return pack(items_of(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")
