"""Idempotent writes on plain Parquet: anti-join, then append or overwrite of the touched partitions. One writer a table."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import append_if_absent, upsert, write_back_flags
from .versions import Change, Store, part_of


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at path, or no rows where there is none yet; any other fault of reading is an error."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def append_quotes(new: DataFrame, path: str, keys: list[str], order: list[str], day: str = "period") -> tuple[int, int]:
    """Appends what the table at path lacks; (written, duplicate). Only the days of the batch are read from the table."""
    spark = new.sparkSession
    days = new.select(day).distinct()
    target = read_or_empty(spark, path, new).join(F.broadcast(days), day, "left_semi")
    fresh = append_if_absent(new, target, keys, order).persist()
    try:
        written, total = fresh.count(), new.count()
        fresh.write.mode("append").partitionBy(day).parquet(path)
    finally:
        fresh.unpersist()
    return written, total - written


def upsert_partitions(new: DataFrame, path: str, keys: list[str], partition: str, first_seen: list[str] = ()) -> None:
    """Upsert by overwriting the partitions that `new` touches, all others stay.

    The merged partitions are first written whole to a folder of this call. A run that stops before it is complete leaves the
    table as it was; one that stops while the table is overwritten leaves the merged partitions in that folder. Either
    way the same call again gives the table its end state, because an upsert may be repeated.
    """
    spark = new.sparkSession
    old = read_or_empty(spark, path, new).join(F.broadcast(new.select(partition).distinct()), partition, "left_semi")
    merged = upsert(new, old, keys, first_seen)
    stage = f"{path}.staged-{uuid.uuid4().hex}"
    merged.write.partitionBy(partition).parquet(stage)  # never overwrite what is being read
    spark.read.schema(new.schema).parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def publish(panel: DataFrame, rows: DataFrame, store: Store) -> int:
    """Stores panel_rows() by day and index_rows() by vintage as one version: no reader sees a panel without its values. A value
    that is computed again keeps its first published_at."""
    return store.commit({
        "panel": store.merged("panel", panel, ["period", "route_id", "apd"], "period"),
        "values": store.merged("values", rows, ["vintage_id", "series_id", "frequency", "period"], "vintage_id", ["published_at"]),
    })


def replace_routes(routes: DataFrame, store: Store) -> int:
    """The route table anew, a short list, which may derive from the old one: a run that stops leaves the old table."""
    return store.commit({"routes": Change(routes.coalesce(1))})


def flag_outliers(store: Store, flagged: DataFrame, schema) -> int:
    """Writes outlier flags back to the stored quotes; returns how many parts (days) were written anew. Only days with a flagged
    key are read and written, the files of all others stay."""
    days = {r[0] for r in flagged.filter("outlier").select(part_of("period")).distinct().collect()}
    days &= store.parts("quotes")
    if days:
        store.commit({"quotes": Change(write_back_flags(store.read("quotes", schema, days), flagged), "period")})
    return len(days)


def land_payloads(binary_files: DataFrame, path: str) -> int:
    """Content-addressed landing of a binaryFile frame: each new hash once, by its first two digits; returns how many. Of the
    store only the prefixes of the new payloads are read, 256 at most, and of those only the hashes."""
    spark = binary_files.sparkSession
    new = binary_files.select(F.sha2("content", 256).alias("hash"), "content").dropDuplicates(["hash"]).withColumn("prefix", F.substring("hash", 1, 2)).persist()
    try:
        known = stored_hashes(new, path)
        fresh = new.join(known, ["prefix", "hash"], "left_anti").select("hash", "content", "prefix").persist()
        n = fresh.count()
        fresh.repartition("prefix").write.mode("append").partitionBy("prefix").parquet(path)  # a file a prefix
        fresh.unpersist()
    finally:
        new.unpersist()
    return n


def stored_hashes(new: DataFrame, path: str) -> DataFrame:
    """(prefix, hash) of the stored payloads whose prefix is among those of new(hash, content, prefix)."""
    prefixes = sorted(r[0] for r in new.select("prefix").distinct().collect())
    return read_or_empty(new.sparkSession, path, new.select("hash", "content", "prefix")).filter(F.col("prefix").isin(prefixes)).select("prefix", "hash")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The files below a folder as rows of (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
