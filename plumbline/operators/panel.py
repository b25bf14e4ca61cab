"""Elementary panel and upper level: suppressed strata leave the value but not the coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_avg, exact_sum
from ..parameters import MIN_WEIGHT_COVERAGE

BASE = 100.0


def elementary_panel(rel: DataFrame, n_expected: int, floor: float) -> DataFrame:
    """One Jevons relative per day and stratum; coverage is observed over expected items, below the floor suppressed."""
    seen = F.count_if(~F.col("imputed"))
    return rel.groupBy("period", "route_id", "apd").agg(
        F.exp(exact_avg("log_relative")).alias("jevons"), seen.alias("n_observed"), F.count_if("imputed").alias("n_imputed")
    ).withColumn("coverage", F.col("n_observed") / F.lit(n_expected) if n_expected else F.lit(0.0)).withColumn("suppressed", F.col("coverage") < floor)


def weight_coverage(routes: DataFrame) -> DataFrame:
    """One row: n_routes, n_weighted, weight_coverage, weights_real (any), weights_refused (some, but too few)."""
    a = routes.agg(F.count("*").alias("n_routes"), F.count("weight").alias("n_weighted"))
    a = a.withColumn("weight_coverage", F.when(F.col("n_routes") > 0, F.col("n_weighted") / F.col("n_routes")).otherwise(0.0))
    return a.withColumn("weights_real", F.col("n_weighted") > 0).withColumn("weights_refused", (F.col("n_weighted") > 0) & (F.col("weight_coverage") < MIN_WEIGHT_COVERAGE))


def usable_weights(routes: DataFrame, unweighted: str = "one") -> DataFrame:
    """(route_id, w): all weights null where they are refused. A route without a weight counts 1, or is dropped on request."""
    out = routes.select("route_id", "weight").crossJoin(F.broadcast(weight_coverage(routes).select("weights_refused", "n_routes")))
    out = out.withColumn("weight", F.when(~F.col("weights_refused"), F.col("weight")))
    if unweighted == "drop":
        out = out.filter("weight is not null")
    return out.select("route_id", F.coalesce("weight", F.lit(1.0)).alias("w"), "n_routes")


def _kept(x: Column) -> Column:
    return exact_sum(F.when(~F.col("suppressed"), x))


def upper_level(panel: DataFrame, weights: DataFrame, curves: DataFrame, n_windows: int = 4) -> DataFrame:
    """(period, curve, value, coverage, n_strata) for all days and curves in one aggregation.

    weights are the basket's routes, curves a parameter table. No row where nothing survives or no weight is left.
    """
    w = F.col("w") * F.col("curve_weight")
    n_routes = weights.agg(F.count("*").alias("n_expected_routes"))
    joined = panel.join(F.broadcast(curves), "apd").join(weights.select("route_id", "w"), "route_id", "left").withColumn("w", F.coalesce("w", F.lit(1.0)))
    out = joined.groupBy("period", "curve").agg(
        _kept(w).alias("sw"), _kept(w * F.col("jevons")).alias("swj"), exact_sum("coverage").alias("sc"), F.count_if(~F.col("suppressed")).alias("n_strata")
    )
    return out.filter("sw > 0").crossJoin(F.broadcast(n_routes)).select(
        "period", "curve", (BASE * F.col("swj") / F.col("sw")).alias("value"), F.least(F.lit(1.0), F.col("sc") / (F.col("n_expected_routes") * n_windows)).alias("coverage"), "n_strata"
    )


def composite(upper: DataFrame, floor: float) -> DataFrame:
    """The central value with the band over all curves; never a value without its band."""
    central = F.col("curve") == "central"
    out = upper.groupBy("period").agg(
        F.max(F.when(central, F.col("value"))).alias("value"), F.max(F.when(central, F.col("coverage"))).alias("coverage"), F.min("value").alias("low"), F.max("value").alias("high"), F.max(F.when(central, F.col("n_strata"))).alias("n_strata")
    )
    return out.filter("value is not null").withColumn("suppressed", F.col("coverage") < floor)


def window_index(panel: DataFrame, weights: DataFrame, floor: float) -> DataFrame:
    """(period, apd, value, coverage, suppressed): one lead window each, weighted by route only, so without a band."""
    joined = panel.join(weights.select("route_id", "w"), "route_id", "left").withColumn("w", F.coalesce("w", F.lit(1.0)))
    out = joined.groupBy("period", "apd").agg(_kept(F.col("w")).alias("sw"), _kept(F.col("w") * F.col("jevons")).alias("swj"), F.least(F.lit(1.0), exact_avg("coverage")).alias("coverage"))
    return out.filter("sw > 0").select("period", "apd", (BASE * F.col("swj") / F.col("sw")).alias("value"), "coverage", (F.col("coverage") < floor).alias("suppressed"))


def in_order(panel: DataFrame) -> DataFrame:
    """The panel as it is presented: by day, route and lead window."""
    return panel.orderBy("period", "route_id", "apd")


def panel_rows(panel: DataFrame) -> DataFrame:
    """The panel as it is stored: relatives to 8 decimals, coverage to 4."""
    return panel.withColumn("jevons", F.round("jevons", 8)).withColumn("coverage", F.round("coverage", 4))


def index_rows(series: DataFrame, vintage_id: str, config_hash: str, published_at: str) -> DataFrame:
    """Series rows as they are published: values and band to 6 decimals, coverage to 4, with vintage, methodology and time."""
    to = lambda digits, *names: {c: F.round(c, digits) for c in names}
    out = series.withColumns({**to(6, "value", "low", "high"), **to(4, "coverage")})
    return out.withColumns({"vintage_id": F.lit(vintage_id), "config_hash": F.lit(config_hash), "published_at": F.lit(published_at).cast("timestamp")})


def weight_label(routes: DataFrame) -> DataFrame:
    """One row (basis, source, starts, ends, n_groups): the first provenance group by source, or equal_fallback."""
    groups = routes.filter("weight is not null").groupBy("weight_basis", "weight_source").agg(F.min("weight_start").alias("starts"), F.max("weight_end").alias("ends"))
    first = groups.agg(F.min(F.struct(F.col("weight_source").alias("source"), F.col("weight_basis").alias("basis"), "starts", "ends")).alias("f"), F.count("*").alias("n_groups"))
    return first.select(F.coalesce("f.basis", F.lit("equal_fallback")).alias("basis"), "f.source", "f.starts", "f.ends", "n_groups")
