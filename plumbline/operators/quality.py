"""One row per natural key: dedupe, canonical quotes, idempotent appends, write-backs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same_key(keys: list[str]) -> list[Column]:
    """Key columns with a missing value as a value of its own."""
    return [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]


def keep_earliest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*same_key(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def append_if_absent(new: DataFrame, target: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of `new` to append: one a key, and none whose key the target has. Twice the same is nothing new."""
    a = keep_earliest(new, keys, order).withColumn("__k", F.concat_ws("\x1f", *same_key(keys)))
    b = target.select(F.concat_ws("\x1f", *same_key(keys)).alias("__k")).distinct()
    return a.join(b, "__k", "left_anti").drop("__k")


def append_counts(new: DataFrame, fresh: DataFrame) -> DataFrame:
    return new.agg(F.count("*").alias("n")).crossJoin(fresh.agg(F.count("*").alias("written"))).select("written", (F.col("n") - F.col("written")).alias("duplicate"))


def upsert(new: DataFrame, old: DataFrame, keys: list[str], first_seen: list[str] = ()) -> DataFrame:
    """The table after an upsert: new rows, and old ones whose key is not among them. A key that repeats in new is an error. The
    columns first_seen keep the value that an old row of the key has, such as the time of its first publication."""
    once = F.count("*").over(Window.partitionBy(*keys)) == 1
    new = new.withColumn("__ok", once).filter(F.assert_true("__ok", F.lit("a key repeats among the new rows")).isNull()).drop("__ok")
    if first_seen:
        before = old.select(*keys, *[F.col(c).alias(f"__{c}") for c in first_seen])
        new = new.join(before, keys, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in first_seen else c for c in new.columns])
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))


def resolve_routes(quotes: DataFrame, routes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, rejected): route ids by origin and destination; what the basket lacks is reported, not guessed."""
    out = quotes.join(F.broadcast(routes.select("origin", "destination", "route_id")), ["origin", "destination"], "left")
    return out.filter("route_id is not null"), out.filter("route_id is null").drop("route_id")


def canonical_quotes(quotes: DataFrame, ranks: DataFrame) -> DataFrame:
    """One quote per route, window, carrier and day across sources: by source rank, then fare, then id."""
    w = Window.partitionBy("route_id", "apd", "carrier", "period").orderBy("rank", "total_fare", "quote_id")
    return quotes.join(F.broadcast(ranks), "source").withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "rank")


def source_agreement(quotes: DataFrame) -> DataFrame:
    """(source_a, source_b, n, mean_log_ratio): lowest fares above zero of the same product and day from two sources.

    Each source is reduced to one fare per product and day first, so the self-join meets at most one row a source. A fare of
    zero is no price and hides no other quote of its product and day.
    """
    low = quotes.filter("total_fare > 0").groupBy("source", "route_id", "apd", "carrier", "period").agg(F.min("total_fare").alias("fare"))
    a = low.withColumnsRenamed({"source": "source_a", "fare": "fare_a"})
    b = low.withColumnsRenamed({"source": "source_b", "fare": "fare_b"})
    both = a.join(b, ["route_id", "apd", "carrier", "period"]).filter("source_a < source_b")
    return both.groupBy("source_a", "source_b").agg(F.count("*").alias("n"), F.avg(F.ln(F.col("fare_a") / F.col("fare_b"))).alias("mean_log_ratio"))


def write_back_flags(quotes: DataFrame, flagged: DataFrame) -> DataFrame:
    """Quotes with outlier_flag set for flagged (period, route_id, apd, carrier). A flag that is set stays, and so do exclusion
    reasons: the flag marks what is to be reviewed, and only a reviewer takes it back."""
    hit = flagged.filter("outlier").select("period", "route_id", "apd", "carrier").distinct().withColumn("__o", F.lit(True))
    before = F.col("outlier_flag") if "outlier_flag" in quotes.columns else F.lit(False)
    return quotes.join(hit, ["period", "route_id", "apd", "carrier"], "left").withColumn("outlier_flag", F.coalesce("__o", before, F.lit(False))).drop("__o").select(*quotes.columns, *[c for c in ["outlier_flag"] if c not in quotes.columns])
