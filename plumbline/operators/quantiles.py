"""Exact quantiles of groups that are larger than a task: rows are sorted over all tasks, and ranks are counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.spool import stored


def ranked(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n, upto): each distinct value of a group with how often it occurs and how many rows of the group are not above it.

    The distinct values are range-partitioned by (keys, value), so a large group lies over several tasks; each task counts its
    own, and the sums of the tasks before are added, one row a task and group. The sorted rows are stored once, because a
    range partitioning that is computed twice need not be the same. Nulls are left out, in keys they are a group.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = stored(rows.repartitionByRange(parts, *keys, value).withColumn("__task", F.spark_partition_id()), "ranked")
    here = Window.partitionBy("__task", *keys).orderBy(value)
    sums = kept.groupBy("__task", *keys).agg(F.sum("n").alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__task").alias("__t"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    on = (F.col("__task") == F.col("__t")) & F.expr(" and ".join(["true", *[f"`{k}` <=> `__{k}`" for k in keys]]))
    return kept.join(offset, on).select(*keys, value, "n", (F.sum("n").over(here) + F.col("__offset")).alias("upto"))


def quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """(keys, n, q): linearly interpolated quantiles of each group, equal to those of an aggregate or window over it."""
    r = ranked(df, keys, value)
    total = r.groupBy(*keys).agg(F.max("upto").alias("__n"))
    same = F.expr(" and ".join(["true", *[f"`{k}` <=> `__{k}`" for k in keys]]))
    r = r.join(total.withColumnsRenamed({k: f"__{k}" for k in keys}), same).select(*keys, value, "upto", "__n")
    at = lambda p: (F.col("__n") - 1) * F.lit(float(p))
    of = lambda rank: F.min(F.when(F.col("upto") > rank, F.col(value)))
    picked = r.groupBy(*keys).agg(F.max("__n").alias("n"), *[of(f(at(p))).alias(f"__{side}{i}") for i, p in enumerate(probabilities) for side, f in (("lo", F.floor), ("hi", F.ceil))])
    step = lambda p: (F.col("n") - 1) * F.lit(float(p)) - F.floor((F.col("n") - 1) * F.lit(float(p)))
    between = lambda i, p: F.when(F.col(f"__lo{i}") == F.col(f"__hi{i}"), F.col(f"__lo{i}")).otherwise((1 - step(p)) * F.col(f"__lo{i}") + step(p) * F.col(f"__hi{i}"))
    return picked.select(*keys, "n", F.array(*[between(i, p) for i, p in enumerate(probabilities)]).alias("q"))
