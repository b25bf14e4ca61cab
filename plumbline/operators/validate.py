"""Validation against a benchmark series, revisions, and annotation by an event calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .smooth import change


def benchmark_join(ours: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    return ours.select(*keys, F.col("value").alias("ours")).join(theirs.select(*keys, F.col("value").alias("theirs")), keys)


def scores(ours: DataFrame, theirs: DataFrame, by: list[str]) -> DataFrame:
    """One row: share of changes with the same direction, Spearman rank correlation of the levels of the series `by` (their means
    over the common months), and mean absolute relative error of the changes, without those where the benchmark stands still."""
    a, b = change(ours, by), change(theirs, by)
    keys = [*by, "period"]
    both = a.select(*keys, F.col("value").alias("va"), F.col("change").alias("ca")).join(b.select(*keys, F.col("value").alias("vb"), F.col("change").alias("cb")), keys)
    level = both.groupBy(*by).agg(F.avg("va").alias("va"), F.avg("vb").alias("vb"))
    mean_rank = lambda c: (F.rank().over(Window.orderBy(c)) + (F.count("*").over(Window.partitionBy(c)) - 1) / 2)
    ranked = level.select(mean_rank("va").alias("ra"), mean_rank("vb").alias("rb"))  # one row a route: the basket is a short list
    moved = F.col("ca").isNotNull() & F.col("cb").isNotNull()
    changes = both.agg(
        F.avg(F.when(moved, (F.signum("ca") == F.signum("cb")).cast("double"))).alias("direction"),
        F.avg(F.when(moved & (F.col("cb") != 0), F.abs((F.col("ca") - F.col("cb")) / F.col("cb")))).alias("mape"),
    )
    return changes.crossJoin(ranked.agg(F.corr("ra", "rb").alias("spearman"))).select("direction", "spearman", "mape")


def lead_lag(ours: DataFrame, theirs: DataFrame, max_lag: int = 3) -> DataFrame:
    """(lag, correlation, n): our change against the benchmark's change `lag` months later (negative: earlier)."""
    a = change(ours, []).select("period", F.col("change").alias("ca"))
    b = change(theirs, []).select("period", F.col("change").alias("cb"))
    lags = F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag)))
    shifted = a.filter("ca is not null").withColumn("lag", lags).withColumn("period", F.expr("add_months(period, lag)"))
    return shifted.join(b.filter("cb is not null"), "period").groupBy("lag").agg(F.corr("ca", "cb").alias("correlation"), F.count("*").alias("n"))


def revisions(stored: DataFrame, recomputed: DataFrame, keys: list[str], digits: int = 6) -> DataFrame:
    """Keys whose value differs between the stored and the recomputed table, or that only one has."""
    a = stored.select(*keys, F.round("value", digits).alias("stored"))
    b = recomputed.select(*keys, F.round("value", digits).alias("recomputed"))
    return a.join(b, keys, "full_outer").filter(~F.col("stored").eqNullSafe(F.col("recomputed")))


def changed_bits(stored: DataFrame, recomputed: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of which not every value is the same double, bit by bit, or that only one table has; empty after a faithful recompute."""
    bits = lambda df, name: df.select(*keys, F.struct(*[F.col(c).cast("string").alias(c) for c in values]).alias(name))  # noqa: E731  the text of a double names it exactly
    return bits(stored, "stored").join(bits(recomputed, "recomputed"), keys, "full_outer").filter(~F.col("stored").eqNullSafe(F.col("recomputed")))


def annotated(series: DataFrame, calendar: DataFrame) -> DataFrame:
    """series with events, structural_break and regime; values are neither smoothed nor left out.

    calendar(name, starts, ends, breaks) is a list kept by hand, so it is broadcast; without an end it holds on. events: names of
    the entries that hold on the day; structural_break: one of them breaks the series (a fare band, a cap); regime: how many
    breaks have begun by then, so that changes across two regimes can be told from movements of the market.
    """
    c = F.broadcast(calendar.withColumnsRenamed({"name": "__name", "starts": "__starts", "ends": "__ends", "breaks": "__breaks"}))
    holds = F.coalesce(F.col("period") <= F.col("__ends"), F.lit(True))
    hit = series.select("period").distinct().join(c, F.col("period") >= F.col("__starts")).groupBy("period").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(holds, F.col("__name")))), ",").alias("events"), F.bool_or(holds & F.col("__breaks")).alias("structural_break"), F.count_if("__breaks").cast("int").alias("regime")
    )
    out = series.join(hit, "period", "left").withColumn("events", F.nullif("events", F.lit("")))
    return out.withColumn("structural_break", F.coalesce("structural_break", F.lit(False))).withColumn("regime", F.coalesce("regime", F.lit(0)))
