"""What the operators share: tables in the shared folder, row numbers, and joins on keys that may be hot."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Words as `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: every other byte becomes a blank.
WORD_BYTES = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
#: Bytes up to which a table is broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: A key with more than one in HOT_SHARE of a table's rows, and more than HOT_ROWS, is hot: there are fewer than HOT_SHARE such keys.
HOT_SHARE, HOT_ROWS = 1000, 500
_local: list[str] = []
_of_worker: dict[str, object] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, which the cluster shares. Where it is unset, a temporary folder, but only on a
    local master, where all tasks see it; elsewhere an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="spark-plumbline-"))
        base = f"file://{_local[0]}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered_rows(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """docs written with a column that numbers its rows, and that column: ids may repeat or be null, these numbers never."""
    row = fresh(docs, "row_number")
    return written(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def bounded(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """df, to be broadcast if its rows of row_bytes each fit in BROADCAST_BYTES, else to be joined by a shuffle."""
    size = df.count() * row_bytes if isinstance(row_bytes, int) else df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df.hint("merge")


def spread_join(left: DataFrame, right: DataFrame, key: str, by: list[str], how: str = "inner") -> DataFrame:
    """left joined to right, which has at most one row a key. Hot keys of left are dealt over several tasks by a hash of the
    columns `by`, and right's row is copied to each. The list of hot keys has fewer than HOT_SHARE rows; left is read twice."""
    n = left.count()
    if n <= HOT_ROWS:
        return left.join(right, key, how)
    counts, most = left.groupBy(key).agg(F.count("*").alias("__n")), max(HOT_ROWS, n // HOT_SHARE)
    hot = F.broadcast(counts.filter(F.col("__n") > most).select(key, F.ceil(F.col("__n") / most).cast("int").alias("__parts")))
    parts = F.coalesce("__parts", F.lit(1))
    dealt = left.join(hot, key, "left").withColumn("__part", F.pmod(F.xxhash64(*by), parts).cast("int")).drop("__parts")
    copied = right.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return dealt.hint("merge").join(copied, [key, "__part"], how).drop("__part")


def once_per_worker(key: str, make):
    """make() for all tasks of a Python worker that ask for the same key; the last few results are kept."""
    if key not in _of_worker:
        if len(_of_worker) >= 4:
            _of_worker.clear()
        _of_worker[key] = make()
    return _of_worker[key]


def text_of(docs: DataFrame, text: str = "text") -> Column:
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
