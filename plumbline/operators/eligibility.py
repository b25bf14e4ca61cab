"""Which quotes count, and what is wrong with those that do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..parameters import NON_HEADLINE, WINDOWS

#: Fields without a form of their own that every quote must have.
REQUIRED = ("source", "carrier", "departure_date", "collection_ts", "observation_status")
STATUSES = ("observed", "no_service", "collection_failed", "imputed")


def in_windows(c: str = "apd", windows=WINDOWS) -> Column:
    return F.col(c).isin(*windows)


def not_tagged(c: str = "fare_class", tags=NON_HEADLINE) -> Column:
    """True for a missing class too; a plain NOT IN would lose it."""
    return F.col(c).isNull() | ~F.col(c).isin(*tags)


def observed() -> Column:
    return (F.col("observation_status") == "observed") & F.col("exclusion_reason").isNull() & (F.col("total_fare") > 0)


def eligible(quotes: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Index-eligible quotes collected in [start, end), all as predicates that reach the scan."""
    df = quotes.filter(observed() & in_windows() & not_tagged())
    if start is not None:
        df = df.filter((F.col("collection_ts") >= F.lit(start).cast("timestamp")) & (F.col("collection_ts") < F.lit(end).cast("timestamp")))
    return df


def observations(quotes: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """(period, route_id, apd, carrier, price): the lowest eligible fare of each key, so repeated quotes are no ambiguity."""
    return eligible(quotes, start, end).groupBy("period", "route_id", "apd", "carrier").agg(F.min("total_fare").alias("price"))


def violations(checks: dict[str, Column]) -> Column:
    """Sorted names of the checks that fail; a check that is null (cannot be made) does not fail."""
    return F.array_sort(F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in sorted(checks.items())]), lambda x: x.isNotNull()))


def row_contract() -> dict[str, Column]:
    """Checks of one quote. A required field that is missing fails by its own name or by the check of its form."""
    seen = F.col("observation_status") == "observed"
    there = lambda ok: F.coalesce(ok, F.lit(False))
    return {
        **{f"{c}_present": F.col(c).isNotNull() for c in REQUIRED},
        "origin_code": there(F.length("origin") == 3),
        "destination_code": there(F.length("destination") == 3),
        "distinct_ends": F.col("origin") != F.col("destination"),
        "lead_days": there(F.col("apd").between(0, 365)),
        "observed_has_fare": ~seen | F.col("total_fare").isNotNull(),
        "observed_has_hash": ~seen | F.col("raw_payload_hash").isNotNull(),
        "fare_not_negative": F.col("total_fare") >= 0,
    }


def table_constraints(parts: list[str]) -> dict[str, Column]:
    """Null parts mean not measured and count as nothing only in this comparison."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in parts[1:]), F.coalesce(F.col(parts[0]), F.lit(0)))
    return {
        "total_covers_parts": F.col("total_fare") >= total - F.lit(0.01),
        "total_not_negative": F.col("total_fare") >= 0,
        "known_status": F.col("observation_status").isin(*STATUSES),
    }


def coerced(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast by try_cast; `violations` names those that had text but no value of their type."""
    made = {c: F.expr(f"try_cast(`{c}` as {t})") for c, t in types.items()}
    bad = violations({f"{c}_type": F.col(c).isNull() | made[c].isNotNull() for c in types})
    keep = [c for c in raw.columns if c not in types]
    return raw.select(*keep, *[v.alias(c) for c, v in made.items()], bad.alias("violations"))


def quarantine(quotes: DataFrame, runs: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Quotes of runs whose selector moved count as failed collections until the run's source and day are confirmed."""
    moved = runs.filter("selector_relocated").select("run_id", "source", "day").join(confirmations.select("source", "day").distinct(), ["source", "day"], "left_anti").select("run_id").distinct().withColumn("held", F.lit(True))
    return quotes.join(moved, "run_id", "left").withColumn("observation_status", F.when(F.col("held"), "collection_failed").otherwise(F.col("observation_status"))).drop("held")
