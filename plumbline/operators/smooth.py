"""Series over days and months: gap-aware centred means, weekday adjustment, changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import exact_avg


def centred_mean(series: DataFrame, columns: list[str], window: int = 7, by: list[str] | None = None) -> DataFrame:
    """Means of the columns over `window` days around each day; days without a full window have no row.

    A published series has one row a day, so an unpartitioned window holds days, not data; give `by` for stacked series.
    """
    if window % 2 == 0:
        raise ValueError("a centred mean needs an odd window")
    half = window // 2
    day = F.unix_date("period")
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(day).rangeBetween(-half, half)
    full = series.withColumn("days", F.count("*").over(w))
    for c in columns:
        full = full.withColumn(c, F.avg(c).over(w))
    return full.filter(F.col("days") == window).drop("days")


def weekday_adjusted(raw: DataFrame, smooth: DataFrame) -> DataFrame:
    """raw(period, value) divided by centred weekday factors learnt from log(raw / smooth)."""
    both = raw.select("period", "value").join(smooth.select("period", F.col("value").alias("smooth")), "period").withColumn("d", F.weekday("period"))
    effect = both.groupBy("d").agg(exact_avg(F.ln(F.col("value") / F.col("smooth"))).alias("e"))
    centre = effect.agg(exact_avg("e").alias("m"))
    factors = effect.crossJoin(F.broadcast(centre)).select("d", F.exp(F.col("e") - F.col("m")).alias("factor"))
    return raw.select("period", "value").withColumn("d", F.weekday("period")).join(F.broadcast(factors), "d").select("period", "value", (F.col("value") / F.col("factor")).alias("adjusted"))


def change(series: DataFrame, by: list[str]) -> DataFrame:
    """Adds the change against the previous period of the same series."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("period")
    return series.withColumn("change", F.col("value") / F.lag("value").over(w) - 1)
