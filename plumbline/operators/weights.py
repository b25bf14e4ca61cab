"""Basket weights from monthly directional traffic, and the gates before they are loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRAFFIC_CSV
from .eligibility import violations

MAX_STALENESS_MONTHS, TOTAL_TOLERANCE = 6, 0.02


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """City-pair traffic as text columns; a file without a required column is an error."""
    df = spark.read.option("header", True).csv(path)
    if missing := sorted(set(TRAFFIC_CSV) - set(df.columns)):
        raise ValueError(f"traffic file lacks columns: {missing}")
    return df


def traffic_cells(raw: DataFrame) -> DataFrame:
    """(city1, city2, period, passengers): both directions of every row; cells that are no number >= 0, and rows without a
    month, are left out, never read as zero."""
    year, month = F.expr("try_cast(trim(Year) as int)"), F.expr("try_cast(trim(Month) as int)")
    a, b = F.trim("City1"), F.trim("City2")
    ways = F.array(F.struct(a.alias("city1"), b.alias("city2"), F.col("PaxToCity2").alias("cell")), F.struct(b.alias("city1"), a.alias("city2"), F.col("PaxFromCity2").alias("cell")))
    period = F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))
    out = raw.select(period.alias("period"), F.explode(ways).alias("x")).select("x.city1", "x.city2", "period", F.expr("try_cast(trim(x.cell) as double)").alias("passengers"))
    return out.filter("period is not null and passengers >= 0")


def national_totals(cells: DataFrame) -> DataFrame:
    """(period, total) over all rows, whether their cities are known or not."""
    return cells.groupBy("period").agg(F.sum("passengers").alias("total"))


def city_report(cells: DataFrame, cities: DataFrame) -> DataFrame:
    """(city, problem): names that are refused as separate airports, and names that the mapping lacks."""
    names = cells.select(F.col("city1").alias("city")).union(cells.select("city2")).distinct()
    known = names.join(F.broadcast(cities), "city", "left")
    problem = F.when(F.col("refused"), "refused").when(F.coalesce("unknown", F.lit(True)), "unmapped")
    return known.withColumn("problem", problem).filter("problem is not null").select("city", "problem")


def mapped_flows(cells: DataFrame, cities: DataFrame) -> DataFrame:
    """(origin, destination, period, passengers) of rows with two known, different codes."""
    good = cities.filter(~F.col("refused") & ~F.col("unknown")).select("city", "code")
    a, b = (F.broadcast(good.select(F.col("city").alias(c), F.col("code").alias(n))) for c, n in (("city1", "origin"), ("city2", "destination")))
    return cells.join(a, "city1").join(b, "city2").filter("origin <> destination").select("origin", "destination", "period", "passengers")


def in_trailing_months(flows: DataFrame, months: int = 12) -> DataFrame:
    """Flows of the `months` months that end with the latest one."""
    last = flows.agg(F.max("period").alias("latest"))
    return flows.crossJoin(F.broadcast(last)).filter(F.col("period") > F.add_months("latest", -months)).drop("latest")


def basket_shares(flows: DataFrame, basket: DataFrame, months: int = 12) -> DataFrame:
    """(origin, destination, passengers, share, months_observed, missing) for every basket route.

    Shares are of the basket's own traffic; a route without any is missing, with a null share, never a zero.
    """
    totals = in_trailing_months(flows, months).groupBy("origin", "destination").agg(F.sum("passengers").alias("passengers"), F.countDistinct("period").alias("months_observed"))
    out = basket.select("origin", "destination").join(totals, ["origin", "destination"], "left")
    out = out.withColumn("missing", F.coalesce(F.col("passengers") <= 0, F.lit(True)))
    whole = out.agg(F.sum(F.when(~F.col("missing"), F.col("passengers"))).alias("whole"))
    return out.crossJoin(F.broadcast(whole)).select(
        "origin", "destination", F.when(~F.col("missing"), F.col("passengers")).alias("passengers"), F.when(~F.col("missing"), F.col("passengers") / F.col("whole")).alias("share"), F.coalesce("months_observed", F.lit(0)).alias("months_observed"), "missing"
    )


def load_gates(flows: DataFrame, shares: DataFrame, totals: DataFrame, unmapped: DataFrame, today: str, expected_total: float | None = None) -> DataFrame:
    """One row (latest, age_months, drift, n_missing, n_unmapped, failed): weights are loaded only if `failed` is empty."""
    latest = flows.agg(F.max("period").alias("latest"))
    out = latest.join(totals, F.col("latest") == F.col("period"), "left").drop("period")
    out = out.crossJoin(shares.agg(F.count_if("missing").alias("n_missing"))).crossJoin(unmapped.agg(F.count("*").alias("n_unmapped")))
    day = F.lit(today).cast("date")
    out = out.withColumn("age_months", 12 * (F.year(day) - F.year("latest")) + F.month(day) - F.month("latest"))
    drift = F.lit(None).cast("double") if expected_total is None else F.abs(F.col("total") - expected_total) / expected_total
    out = out.withColumn("drift", drift)
    gates = {"stale": F.col("age_months") <= MAX_STALENESS_MONTHS, "drift": F.col("drift") <= TOTAL_TOLERANCE, "missing_route": F.col("n_missing") == 0, "unmapped_code": F.col("n_unmapped") == 0}
    return out.select("latest", "age_months", "drift", "n_missing", "n_unmapped", F.array_join(violations(gates), ",").alias("failed"))


def unmapped_codes(basket: DataFrame, cities: DataFrame) -> DataFrame:
    """Codes of the basket that no known city has."""
    codes = basket.select(F.col("origin").alias("code")).union(basket.select("destination")).distinct()
    return codes.subtract(cities.filter(~F.col("refused") & ~F.col("unknown")).select("code"))


def weight_report(shares: DataFrame, routes: DataFrame) -> DataFrame:
    """Share against an equal share, with the weight in use."""
    n = shares.agg(F.count("*").alias("n"))
    out = shares.crossJoin(F.broadcast(n)).join(routes.select("origin", "destination", "weight"), ["origin", "destination"], "left")
    return out.select("origin", "destination", "passengers", "share", (F.col("share") * F.col("n") - 1).alias("vs_equal"), "months_observed", F.col("weight").alias("current_weight"))


def active(routes: DataFrame) -> DataFrame:
    """The basket's routes in use. A table without the column `active` has only such routes."""
    return routes.filter("active") if "active" in routes.columns else routes


def with_new_weights(routes: DataFrame, shares: DataFrame, gates: DataFrame, basis: str, source: str, starts: str, ends: str, retrieved_at: str) -> DataFrame:
    """The route table after a load: every active route gets its share and where it comes from, inactive ones stay as they are.

    All or nothing: if a gate of load_gates() failed, or an active route has no share, it is an error and nothing changes.
    """
    failed = gates.select("failed").first()[0]
    share = shares.filter("not missing").select("origin", "destination", "share")
    in_use = F.coalesce("active", F.lit(False)) if "active" in routes.columns else F.lit(True)
    out = routes.join(share, ["origin", "destination"], "left")
    if not failed and out.filter(in_use & F.col("share").isNull()).limit(1).count():
        failed = "missing_route"
    if failed:
        raise ValueError(f"weights are not loaded: {failed}")
    new = {"weight": F.col("share"), "weight_basis": F.lit(basis), "weight_source": F.lit(source), "weight_start": F.lit(starts).cast("date"), "weight_end": F.lit(ends).cast("date"), "weight_retrieved_at": F.lit(retrieved_at).cast("timestamp")}
    kept = {c: F.col(c) if c in routes.columns else F.lit(None) for c in new}
    return out.select(*[c for c in routes.columns if c not in new], *[F.when(in_use, v).otherwise(kept[c]).alias(c) for c, v in new.items()])


def expenditure_shares(shares: DataFrame, fares: DataFrame) -> DataFrame:
    """Traffic times average fare as a share: fares(origin, destination, avg_fare)."""
    out = shares.filter("not missing").join(fares, ["origin", "destination"]).withColumn("e", F.col("passengers") * F.col("avg_fare"))
    whole = out.agg(F.sum("e").alias("whole"))
    return out.crossJoin(F.broadcast(whole)).select("origin", "destination", (F.col("e") / F.col("whole")).alias("share"), F.lit("expenditure_share").alias("weight_basis"))


def seeded(current: DataFrame, config: DataFrame) -> DataFrame:
    """Routes after seeding: new ones inserted, the stratum class of known ones refreshed, the rest as it was."""
    c, n = current.alias("c"), config.alias("n")
    out = c.join(n, ["origin", "destination"], "full_outer")
    return out.select("origin", "destination", F.coalesce("n.stratum_class", "c.stratum_class").alias("stratum_class"), F.col("c.weight").alias("weight"), F.col("c.origin").isNull().alias("inserted"))
