"""Streams: spooled runs with their quotes into the store, once per key however late, and daily yields with a watermark."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import append_if_absent
from ..schemas import SPOOLED_RUN
from ..sources.versions import Change, Store, part_of

KEYS = ["source", "carrier", "route_id", "apd", "fare_class", "period"]
#: Fields without which a document is no run.
RUN_FIELDS = ("run_id", "source", "started_at", "status", "quotes")
RUNS = "run_id string, source string, started_at timestamp, finished_at timestamp, status string, selector_relocated boolean, notes string, day date"
QUOTES = "run_id string, started_at timestamp, quote_id bigint, source string, carrier string, route_id int, apd int, fare_class string, collection_ts timestamp, total_fare decimal(10,2), period date"
REJECTS = "file string, text string, reason string"
SENT = "run_id string, file string, day date"
LATE = "run_id string, source string, day date, watermark timestamp"
YIELD = "day date, source string, n_runs bigint, n_done bigint"


def read_spool(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """The documents below a spool folder with the file that each is in; one that cannot be read whole has its text in `broken`. A
    stream takes the oldest files first."""
    reader = (spark.readStream if stream else spark.read).schema(f"{SPOOLED_RUN}, broken string")
    return reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord="broken", recursiveFileLookup="true", **options).json(path).select("*", F.col("_metadata.file_path").alias("file"))


def malformed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs with a `day`, rejects): a document that is cut off, has a value of another type or lacks a required field is no run; it
    is kept with its file, its text and the reason, and never passes silently."""
    lacks = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in RUN_FIELDS])
    reason = F.when(F.col("broken").isNotNull(), "not readable").when(lacks != "", F.concat(F.lit("lacks "), lacks))
    out = docs.withColumn("reason", reason)
    text = F.coalesce("broken", F.to_json(F.struct(*[c for c in docs.columns if c not in ("broken", "file")])))
    good = out.filter("reason is null").drop("broken", "reason").withColumn("day", F.to_date("started_at"))
    return good, out.filter("reason is not null").select("file", text.alias("text"), "reason")


def spooled_quotes(runs: DataFrame) -> DataFrame:
    """One row per quote of spooled runs; a fare that is no number is null."""
    q = runs.select("run_id", "started_at", F.explode("quotes").alias("q")).select("run_id", "started_at", "q.*")
    return q.withColumn("total_fare", F.expr("try_cast(total_fare as decimal(10,2))")).withColumn("period", F.to_date("collection_ts"))


def stream_name(checkpoint: str) -> str:
    """What the ledger calls the stream with this checkpoint; one with a new checkpoint counts its batches anew."""
    return f"spool-{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}"


def land_batch(store: Store, docs: DataFrame, stream: str, batch: int, late_days: int = 14) -> int | None:
    """Lands one batch of documents as one version: runs, their quotes, rejected documents, sent files, late runs and the yields of
    the days that it touches. Returns the version, or None where the ledger says that the batch has landed before.

    A run is late if its day ended at or before the watermark: the latest start in earlier batches of the stream, less
    late_days. Late runs land all the same, and their days are computed anew from the stored runs.
    """
    if store.ledger(stream) >= batch:
        return None
    docs, fresh = docs.persist(), None
    try:
        good, rejects = malformed(docs)
        seen = store.ledger(f"{stream}-seconds")
        newest = good.agg(F.max(F.unix_seconds("started_at"))).first()[0]
        mark = F.timestamp_seconds(F.lit(seen - late_days * 86400))
        runs = good.select(*[c.split()[0] for c in RUNS.split(", ")])
        fresh = store.added("runs", runs, ["run_id"], ["started_at"], "day").rows.persist()
        touched = {r[0] for r in fresh.select(part_of("day")).distinct().collect()}
        late = fresh.filter((F.date_add("day", 1).cast("timestamp") <= mark) & F.lit(seen >= 0)).select("run_id", "source", "day", mark.alias("watermark"))
        sent = good.select("run_id", "file", "day").distinct()
        days = daily_yield(store.read("runs", RUNS, touched).unionByName(fresh))
        changes = {
            "runs": Change(fresh, "day", "append"),
            "quotes": store.added("quotes", spooled_quotes(good), KEYS, ["started_at", "quote_id"], "period"),
            "rejects": Change(append_if_absent(rejects, store.read("rejects", REJECTS), ["file", "text"], ["reason"]), None, "append"),
            "sent": store.added("sent", sent, ["run_id", "file"], ["day"], "day"),
            "late": Change(late, "day", "append"),
            "yield": Change(days, "day"),
        }
        return store.commit(changes, {stream: batch} | ({f"{stream}-seconds": max(seen, newest)} if newest is not None else {}))
    finally:
        docs.unpersist()
        if fresh is not None:
            fresh.unpersist()


def ingest_spool(spark: SparkSession, path: str, store: Store, checkpoint: str, per_batch: int | None = None, archive: str | None = None, late_days: int = 14):
    """Streams a spool folder into the store, oldest files first, at most per_batch files a batch. No row is dropped for being late:
    a run that waited for weeks must still land. With `archive`, files of finished batches move there."""
    options = {"latestFirst": "false"} | ({"maxFilesPerTrigger": str(per_batch)} if per_batch else {}) | ({"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {})
    name = stream_name(checkpoint)
    docs = read_spool(spark, path, stream=True, **options)
    return docs.writeStream.foreachBatch(lambda df, n: land_batch(store, df, name, n, late_days) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_yield(runs: DataFrame, late: str = "14 days") -> DataFrame:
    """(day, source, n_runs, n_done): tumbling days over event time; also counts a source's attempts of a day."""
    df = runs.withWatermark("started_at", late) if runs.isStreaming else runs
    return df.groupBy(F.window("started_at", "1 day").alias("w"), "source").agg(F.count("*").alias("n_runs"), F.count_if(F.col("status").isin("succeeded", "partial")).alias("n_done")).select(F.to_date("w.start").alias("day"), "source", "n_runs", "n_done")


def retain(store: Store, folders: list[str], today: str, keep_days: int = 14) -> int:
    """Retention: sent records older than keep_days go from the store, whole days at a time, and with them the files in `folders`
    that hold nothing younger. What is not sent is never touched. Returns how many files went."""
    spark = store.spark
    cutoff = str(spark.sql(f"select date_sub(date'{today}', {keep_days})").first()[0])
    old = sorted(p for p in store.parts("sent") if p and p < cutoff)
    if not old:
        return 0
    last = store.read("sent", SENT).groupBy("file").agg(F.max("day").alias("day")).filter(F.col("day") < F.lit(cutoff).cast("date"))
    path, conf, gone = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), 0
    for r in last.toLocalIterator():
        own = path(r.file)
        # an archived file lies below the archive under its whole former path
        for place in [own, *(path(f"{f.rstrip('/')}{own.toUri().getPath()}") for f in folders)]:
            gone += bool(place.getFileSystem(conf).delete(place, False))
    store.commit({"sent": Change(None, "day", drop=tuple(old))})
    return gone
