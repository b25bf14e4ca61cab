"""Read-side queries over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.eligibility import eligible
from ..operators.weights import active


def index(values: DataFrame, series: str, frequency: str = "daily", start: str | None = None, end: str | None = None, vintage: str | None = None) -> DataFrame:
    """One series within inclusive bounds; of several vintages of a day the newest published, unless one is named."""
    out = values.filter((F.col("series_id") == series) & (F.col("frequency") == frequency))
    if start is not None:
        out = out.filter(F.col("period") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("period") <= F.lit(end).cast("date"))
    if vintage is not None:
        return out.filter(F.col("vintage_id") == vintage)
    w = Window.partitionBy("period").orderBy(F.col("published_at").desc(), F.col("vintage_id").desc())
    return out.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def index_latest(values: DataFrame, series: str, frequency: str = "daily") -> DataFrame:
    """The last day's row of a series, its newest vintage."""
    out = values.filter((F.col("series_id") == series) & (F.col("frequency") == frequency))
    return out.groupBy("series_id").agg(F.max_by(F.struct("period", "value", "coverage", "suppressed"), F.struct("period", "published_at", "vintage_id")).alias("r")).select("series_id", "r.*")


def quotes(table: DataFrame, route: int | None = None, carrier: str | None = None, start: str | None = None, end: str | None = None, limit: int = 100) -> DataFrame:
    """Newest quotes first, at most 1000: a top-k report by (collection_ts, quote_id)."""
    out = table
    if route is not None:
        out = out.filter(F.col("route_id") == route)
    if carrier is not None:
        out = out.filter(F.col("carrier") == carrier)
    if start is not None:
        out = out.filter(F.col("period") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("period") <= F.lit(end).cast("date"))
    return out.orderBy(F.col("collection_ts").desc(), F.col("quote_id").desc()).limit(min(limit, 1000))


def coverage(panel: DataFrame) -> DataFrame:
    """(route_id, apd, days, mean_coverage, days_suppressed)."""
    return panel.groupBy("route_id", "apd").agg(F.count("*").alias("days"), F.avg("coverage").alias("mean_coverage"), F.count_if("suppressed").alias("days_suppressed"))


def heatmap(panel: DataFrame) -> DataFrame:
    """(route_id, period, relative): geometric mean of the route's strata, long form."""
    return panel.groupBy("route_id", "period").agg(F.exp(F.avg(F.ln("jevons"))).alias("relative"))


def lead_time_curve(obs: DataFrame) -> DataFrame:
    """(route_id, apd, p25, median, p75, n) of fares by lead window."""
    p = F.percentile("price", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return obs.groupBy("route_id", "apd").agg(p.alias("p"), F.count("*").alias("n")).select("route_id", "apd", F.col("p")[0].alias("p25"), F.col("p")[1].alias("median"), F.col("p")[2].alias("p75"), "n")


def carrier_dispersion(obs: DataFrame) -> DataFrame:
    """(route_id, period, sd_log, max_over_min, carriers) of fares."""
    return obs.groupBy("route_id", "period").agg(F.stddev_samp(F.ln("price")).alias("sd_log"), (F.max("price") / F.min("price")).alias("max_over_min"), F.countDistinct("carrier").alias("carriers"))


def routes(table: DataFrame) -> DataFrame:
    """The active basket; a route without a weight is in it, with a null weight."""
    return active(table).select("route_id", "origin", "destination", "stratum_class", "weight")


STATUS_MIX = ("observed", "no_service", "collection_failed", "imputed")


def quality_panel(table: DataFrame, panel: DataFrame) -> DataFrame:
    """(source, period, one column a status, yield, coverage, suppressed): the status mix and the share observed of each source
    and day, beside the mean coverage of that day's panel (null where it has none) and how many of its strata are suppressed."""
    mix = table.groupBy("source", "period").pivot("observation_status", list(STATUS_MIX)).count().na.fill(0)
    whole = sum((F.col(c) for c in STATUS_MIX), F.lit(0))
    day = panel.groupBy("period").agg(F.avg("coverage").alias("coverage"), F.count_if("suppressed").alias("suppressed"))
    return mix.withColumn("yield", F.col("observed") / whole).join(day, "period", "left").withColumn("suppressed", F.coalesce("suppressed", F.lit(0)))


def audit_trail(values: DataFrame, panel: DataFrame, quotes: DataFrame) -> DataFrame:
    """(vintage_id, config_hash, period, value, route_id, apd, jevons, run_id, raw_payload_hash, n_quotes): a published value with each
    stratum of its day, and every run and payload whose index-eligible quotes stand behind the stratum; null run and no quotes
    where a stratum is wholly imputed."""
    behind = eligible(quotes).groupBy("period", "route_id", "apd", "run_id", "raw_payload_hash").agg(F.count("*").alias("n_quotes"))
    cells = values.select("vintage_id", "config_hash", "period", "value").join(panel.select("period", "route_id", "apd", "jevons"), "period")
    return cells.join(behind, ["period", "route_id", "apd"], "left").withColumn("n_quotes", F.coalesce("n_quotes", F.lit(0)))


def sdmx_rows(series: DataFrame) -> DataFrame:
    """Observations in the column layout of SDMX-CSV, each series by period."""
    return series.orderBy("series_id", "period").select(
        F.lit("dataflow").alias("STRUCTURE"), F.lit("PLUMBLINE:INDEX(1.0)").alias("STRUCTURE_ID"), F.upper(F.substring("frequency", 1, 1)).alias("FREQ"), F.col("series_id").alias("SERIES"),
        F.col("period").cast("string").alias("TIME_PERIOD"), F.col("value").alias("OBS_VALUE"), F.when(F.col("suppressed"), "S").otherwise("A").alias("OBS_STATUS"),
    )
