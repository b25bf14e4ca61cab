"""Folders in the shared store, and the spool layout of collected runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RUN_QUOTES = 20_000
#: Times are spooled whole: to the default milliseconds, quotes and runs would change their order.
TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_local: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset, a temporary folder, but only on a local master, where all
    tasks see it; elsewhere an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="spark-plumbline-"))
        base = f"file://{_local[0]}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once in the shared folder and read again, for stages that several others read."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """stored(), and aggregates of df's rows that the write itself observes: they cost no scan."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = stored(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
    return out, seen.get


def write_spool(quotes: DataFrame, path: str) -> None:
    """JSON documents of a run with the quotes it collected, fares as text; a long run has several of RUN_QUOTES ids each."""
    q = F.struct("quote_id", "source", "carrier", "route_id", "apd", "fare_class", "collection_ts", F.col("total_fare").cast("string").alias("total_fare"))
    runs = quotes.groupBy("run_id", F.floor(F.col("quote_id") / RUN_QUOTES).alias("part")).agg(F.min("source").alias("source"), F.min("collection_ts").alias("started_at"), F.array_sort(F.collect_list(q)).alias("quotes"))
    runs.drop("part").withColumn("status", F.lit("succeeded")).write.option("timestampFormat", TIMES).json(path)


def write_runs(runs: DataFrame, path: str) -> None:
    """JSON documents of runs that collected no quote, added to a folder; a file holds runs of one day, and the number of
    files follows the days and the size of the runs, not how the runs lay in partitions."""
    nothing = F.array().cast("array<string>")
    docs = runs.select("run_id", F.col("source").cast("string").alias("source"), "started_at", "status", "selector_relocated", "notes", nothing.alias("quotes"), F.to_date("started_at").alias("of"))
    docs.repartitionByRange("of", "run_id").write.mode("append").option("timestampFormat", TIMES).partitionBy("of").json(path)


def stored_text(lines: DataFrame, path: str) -> None:
    """Lines as they are, added to a folder of documents."""
    lines.write.mode("append").text(path)


def one_file_a_row(lines: DataFrame, path: str) -> None:
    """Each line as a file of its own, all in one folder. Tasks publish their files themselves: one by one the driver would take
    longer than all tasks. A task that is repeated writes the same names again."""
    lines.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
