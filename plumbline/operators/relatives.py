"""Matched price relatives, robust outlier flags and class-mean imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import TERM, exact_avg
from .quantiles import quantiles

# Consistency constants of the median and the mean absolute deviation for a normal distribution.
MAD_TO_SIGMA, MEAN_AD_TO_SIGMA = 0.6745, 1.253314
STRATUM = ("route_id", "apd")


def base_period(obs: DataFrame) -> DataFrame:
    return obs.agg(F.min("period").alias("base_period"))


def build_relatives(obs: DataFrame) -> DataFrame:
    """obs(period, route_id, apd, carrier, price) -> relatives to the one global first day.

    An item without a positive price on the first day, or on its own day, has no relative; the first day has none either.
    """
    first = obs.crossJoin(F.broadcast(base_period(obs)))
    base = first.filter("period = base_period and price > 0").select(*STRATUM, "carrier", F.col("price").alias("base_price"))
    return (
        first.filter("period > base_period and price > 0")
        .join(base, [*STRATUM, "carrier"])
        .select("period", *STRATUM, "carrier", (F.col("price") / F.col("base_price")).alias("relative"))
        .withColumn("log_relative", F.ln("relative"))
    )


def flag_outliers(rel: DataFrame, threshold: float) -> DataFrame:
    """Adds modified_z and outlier within a stratum over all carriers and days, from one exchange on the stratum.

    The scale is the median absolute deviation; where it is 0, the mean absolute deviation; where that is 0, or with fewer
    than three relatives, z is null and nothing is flagged. Flagged rows stay.
    """
    w = Window.partitionBy(*STRATUM)
    df = rel.withColumn("n", F.count("*").over(w)).withColumn("med", F.median("log_relative").over(w))
    df = df.withColumn("dev", F.abs(F.col("log_relative") - F.col("med")))
    terms = F.sum(F.col("dev").cast(TERM)).over(w).cast("double")
    df = df.withColumn("mad", F.median("dev").over(w)).withColumn("mean_ad", terms / F.count("dev").over(w))
    return _judged(df, threshold).drop("dev")


def _judged(df: DataFrame, threshold: float) -> DataFrame:
    """df(log_relative, n, med, mad, mean_ad) with modified_z and outlier in their place."""
    scale = F.when(F.col("n") < 3, None).when(F.col("mad") > 0, F.col("mad") / MAD_TO_SIGMA).when(F.col("mean_ad") > 0, F.col("mean_ad") * MEAN_AD_TO_SIGMA)
    z = (F.col("log_relative") - F.col("med")) / scale
    return df.withColumn("modified_z", z).withColumn("outlier", F.coalesce(F.abs("modified_z") > threshold, F.lit(False))).drop("n", "med", "mad", "mean_ad")


def flag_outliers_of_large_strata(rel: DataFrame, threshold: float) -> DataFrame:
    """flag_outliers() for strata that outgrow a task: medians by ranks that are counted over all tasks, means by partial sums. The
    same rows; only one row a stratum is joined back, so a large stratum stays spread."""
    keys = list(STRATUM)
    middle = quantiles(rel, keys, "log_relative", [0.5]).select(*keys, F.get("q", F.lit(0)).alias("med"))
    around = rel.join(middle, keys).withColumn("dev", F.abs(F.col("log_relative") - F.col("med")))
    scale = quantiles(around, keys, "dev", [0.5]).select(*keys, F.get("q", F.lit(0)).alias("mad"))
    counts = around.groupBy(*keys).agg(F.count("*").alias("n"), exact_avg("dev").alias("mean_ad"))
    return _judged(rel.join(middle.join(scale, keys).join(counts, keys), keys).select(*rel.columns, "n", "med", "mad", "mean_ad"), threshold)


def quartile_outliers(rel: DataFrame, tau: float = 1.5) -> DataFrame:
    """The alternative rule: outside the quartiles of the stratum by more than tau times their distance."""
    w = Window.partitionBy(*STRATUM)
    q = F.percentile("log_relative", F.array(F.lit(0.25), F.lit(0.75))).over(w)
    df = rel.withColumn("q", q).withColumn("q1", F.col("q")[0]).withColumn("q3", F.col("q")[1])
    reach = tau * (F.col("q3") - F.col("q1"))
    return df.withColumn("outlier", (F.col("log_relative") < F.col("q1") - reach) | (F.col("log_relative") > F.col("q3") + reach)).drop("q", "q1", "q3")


def missing_carriers(rel: DataFrame, carriers: DataFrame) -> DataFrame:
    """(period, stratum, carrier) that are expected where the day has a relative, but have none. carriers is a parameter table."""
    cells = rel.select("period", *STRATUM).distinct()
    return cells.crossJoin(F.broadcast(carriers)).join(rel.select("period", *STRATUM, "carrier"), ["period", *STRATUM, "carrier"], "left_anti")


def impute(rel: DataFrame, carriers: DataFrame) -> DataFrame:
    """rel plus, for every missing expected carrier, the geometric mean of its day and stratum, marked imputed."""
    mean = rel.groupBy("period", *STRATUM).agg(exact_avg("log_relative").alias("log_relative"))
    filled = missing_carriers(rel, carriers).join(mean, ["period", *STRATUM]).select(
        "period", *STRATUM, "carrier", F.exp("log_relative").alias("relative"), "log_relative", F.lit(None).cast("double").alias("modified_z"), F.lit(False).alias("outlier"), F.lit(True).alias("imputed")
    )
    return rel.withColumn("imputed", F.lit(False)).select(*filled.columns).unionByName(filled)


def jevons(pairs: DataFrame, keys: list[str], price: str = "price", base: str = "base_price", strict: bool = False) -> DataFrame:
    """Geometric mean of price / base by keys. Strict raises on a null or non-positive price; else such rows are left out."""
    ok = F.coalesce((F.col(price) > 0) & (F.col(base) > 0), F.lit(False))
    pairs = pairs.filter(F.assert_true(ok, F.lit("prices must be positive")).isNull()) if strict else pairs.filter(ok)
    return pairs.groupBy(*keys).agg(F.exp(exact_avg(F.ln(F.col(price) / F.col(base)))).alias("jevons"), F.count("*").alias("n"))


def jevons_series(prices: DataFrame) -> DataFrame:
    """prices(period, item, price) -> (period, value): fixed item set of the first period, which is 100."""
    dated = prices.crossJoin(F.broadcast(prices.agg(F.min("period").alias("first"))))
    base = dated.filter("period = first and price > 0").select("item", F.col("price").alias("base_price"))
    return jevons(dated.join(base, "item"), ["period"]).select("period", (F.col("jevons") * 100).alias("value"), "n")
