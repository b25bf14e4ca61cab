"""Collection health from the run log: decisions, missed days, alerts, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ATTEMPTS = 3
DONE = ("succeeded", "partial")


def done(c: str = "status") -> Column:
    return F.col(c).isin(*DONE)


def run_status(error: Column, relocated: Column, warnings: Column) -> Column:
    return F.when(error.isNotNull(), "failed").when(relocated | (warnings > 0), "partial").otherwise("succeeded")


def look_back(runs: DataFrame, today: str, days: int) -> DataFrame:
    return runs.filter(F.col("day") >= F.date_sub(F.lit(today).cast("date"), days))


def decisions(runs: DataFrame, limit: int = MAX_ATTEMPTS) -> DataFrame:
    """(source, day, attempts, fetch, reason): whether the source may be fetched again that day."""
    out = runs.groupBy("source", "day").agg(F.count("*").alias("attempts"), F.bool_or(done()).alias("collected"))
    reason = F.when(F.col("collected"), "already collected").when(F.col("attempts") >= limit, "attempts used up").otherwise("may try")
    return out.select("source", "day", "attempts", (reason == "may try").alias("fetch"), reason.alias("reason"))


def missed_days(runs: DataFrame, today: str) -> DataFrame:
    """(source, day) after the first success and before today without a success; today is still in progress."""
    day = F.lit(today).cast("date")
    good = runs.filter(done()).filter(F.col("day") < day).select("source", "day").distinct()
    first = good.groupBy("source").agg(F.min("day").alias("first"))
    span = first.filter(F.col("first") < F.date_sub(day, 1)).select("source", F.explode(F.sequence(F.date_add("first", 1), F.date_sub(day, 1))).alias("day"))
    return span.join(good, ["source", "day"], "left_anti")


def spans(days: DataFrame) -> DataFrame:
    """(source, n_days, text): consecutive days collapsed to ranges, in order."""
    w = Window.partitionBy("source").orderBy("day")
    island = days.withColumn("island", F.date_sub("day", F.row_number().over(w))).groupBy("source", "island").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit(" to "), F.col("b").cast("string")))
    each = island.select("source", "a", (F.datediff("b", "a") + 1).alias("n"), text.alias("text"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("a", "text"))), lambda x: x["text"])
    return each.groupBy("source").agg(F.sum("n").alias("n_days"), F.array_join(ordered, ", ").alias("text"))


def source_health(runs: DataFrame, today: str) -> DataFrame:
    """(source, last_success, collected_today, failures_today, n_missed, stale)."""
    day = F.lit(today).cast("date")
    is_today = F.col("day") == day
    out = runs.groupBy("source").agg(
        F.max(F.when(done(), F.col("day"))).alias("last_success"), F.bool_or(done() & is_today).alias("collected_today"), F.count_if((F.col("status") == "failed") & is_today).alias("failures_today")
    )
    missed = missed_days(runs, today).groupBy("source").agg(F.count("*").alias("n_missed"))
    stale = ~F.col("collected_today") & (F.col("last_success").isNull() | (F.col("last_success") < F.date_sub(day, 1)))
    return out.join(missed, "source", "left").withColumn("n_missed", F.coalesce("n_missed", F.lit(0))).withColumn("stale", stale)


def verdicts(health: DataFrame, registry: DataFrame) -> DataFrame:
    """registry(source, tripwire) -> (source, verdict); a tripwire source is expected to fail."""
    v = F.when(F.col("tripwire"), "TRIPWIRE").when(F.coalesce("stale", F.lit(True)), "STALE").when(F.col("collected_today"), "OK").otherwise("PENDING")
    return registry.join(health, "source", "left").select("source", v.alias("verdict"))


def alerts(runs: DataFrame, limit: int = MAX_ATTEMPTS) -> DataFrame:
    """(run_id, source, day, alert, gap_days): the first success of a day after missed days, and the last permitted failure.

    Runs of a day that was already collected raise nothing.
    """
    per_day = Window.partitionBy("source", "day").orderBy("started_at", "run_id")
    before = per_day.rowsBetween(Window.unboundedPreceding, -1)
    good_days = runs.filter(done()).select("source", "day").distinct()
    previous = good_days.withColumn("previous", F.lag("day").over(Window.partitionBy("source").orderBy("day"))).select("source", "day", "previous")
    out = runs.withColumn("attempt", F.row_number().over(per_day)).withColumn("earlier_done", F.coalesce(F.bool_or(done()).over(before), F.lit(False)))
    out = out.filter(~F.col("earlier_done")).join(previous, ["source", "day"], "left")
    gap = F.datediff("day", "previous") - 1
    kind = F.when(done() & (gap > 0), "gap_ended").when(~done() & (F.col("attempt") == limit), "gave_up")
    return out.withColumn("alert", kind).filter("alert is not null").select("run_id", "source", "day", "alert", F.when(F.col("alert") == "gap_ended", gap).alias("gap_days"))


def overdue(runs: DataFrame, today: str) -> DataFrame:
    """Runs that wait for their upload since before today: (n_overdue, oldest)."""
    return runs.filter(F.col("pending") & (F.col("day") < F.lit(today).cast("date"))).agg(F.count("*").alias("n_overdue"), F.min("day").alias("oldest"))


def last_success_before(runs: DataFrame, today: str) -> DataFrame:
    return runs.groupBy("source").agg(F.max(F.when(done() & (F.col("day") < F.lit(today).cast("date")), F.col("day"))).alias("last_success"))


def yield_monitor(daily: DataFrame, days: int = 7, drop: float = 0.5) -> DataFrame:
    """daily(source, day, n): days on which a source yields less than `drop` of its trailing mean."""
    w = Window.partitionBy("source").orderBy(F.unix_date("day")).rangeBetween(-days, -1)
    out = daily.withColumn("trailing", F.avg("n").over(w))
    return out.filter(F.col("n") < drop * F.col("trailing")).select("source", "day", "n", "trailing")
