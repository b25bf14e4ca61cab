"""Monthly methods: complete-week series, rolling GEKS and time product dummies with mean splice, sub-indices."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def complete_weeks(daily: DataFrame) -> DataFrame:
    """(period, value): means of weeks (from Monday) with all seven days."""
    return daily.groupBy(F.to_date(F.date_trunc("week", F.col("period").cast("timestamp"))).alias("period")).agg(F.avg("value").alias("value"), F.countDistinct("period").alias("n")).filter("n = 7").drop("n")


def monthly_from_weeks(weekly: DataFrame) -> DataFrame:
    """(period, value, n_weeks): months as means of the complete weeks that begin in them."""
    return weekly.groupBy(F.trunc("period", "MM").alias("period")).agg(F.avg("value").alias("value"), F.count("*").alias("n_weeks"))


def bilateral(prices: DataFrame, window: int = 13) -> DataFrame:
    """(stratum, s, t, log_index, n): matched Jevons between any two months less than `window` months apart, both orders.

    prices(period, stratum, item, price) has one row per item and month. Each row names the months it may meet, so the join is
    on equal keys and an item's row meets at most 2 * window - 1 others, however long the series is.
    """
    p = prices.filter("price > 0").select("stratum", "item", "period", F.ln("price").alias("lp"), (12 * F.year("period") + F.month("period")).alias("m"))
    near = F.explode(F.sequence(F.col("m") - (window - 1), F.col("m") + (window - 1))).alias("m")
    a = p.select("stratum", "item", F.col("period").alias("s"), F.col("lp").alias("ls"), near)
    both = a.join(p.withColumnsRenamed({"period": "t", "lp": "lt"}), ["stratum", "item", "m"])
    return both.groupBy("stratum", "s", "t").agg(F.avg(F.col("lt") - F.col("ls")).alias("log_index"), F.count("*").alias("n"))


def geks(pairs: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """(stratum, s, t, log_index): mean over all link months of the window of s -> link -> t."""
    if start is not None:
        pairs = pairs.filter((F.col("s") >= start) & (F.col("t") >= start) & (F.col("s") <= end) & (F.col("t") <= end))
    left = pairs.select("stratum", "s", F.col("t").alias("k"), F.col("log_index").alias("a"))
    right = pairs.select("stratum", F.col("s").alias("k"), "t", F.col("log_index").alias("b"))
    return left.join(right, ["stratum", "k"]).groupBy("stratum", "s", "t").agg(F.avg(F.col("a") + F.col("b")).alias("log_index"))


def rolling_geks(prices: DataFrame, window: int = 13) -> DataFrame:
    """(stratum, period, value): first window as it is, each later month linked by the mean splice over the overlap.

    The mean splice of a window that ends at t is the mean over its earlier months s of log P(s) + GEKS(s, t); log P(s) is
    itself spliced, so months are solved in order, from one small matrix of GEKS values per stratum.
    """
    m = 12 * F.year("period") + F.month("period")
    pairs = bilateral(prices, window)
    month = prices.select("stratum", "period").distinct().withColumn("m", m)
    # the window that ends at `last` has links of months last - window + 1 .. last
    ends = month.select("stratum", F.col("period").alias("last"), F.col("m").alias("ml"))
    idx = lambda c: 12 * F.year(c) + F.month(c)
    inside = lambda c: (idx(c) <= F.col("ml")) & (idx(c) > F.col("ml") - window)
    to_last = pairs.withColumnRenamed("t", "last").join(ends, ["stratum", "last"]).filter(inside("s")).select("stratum", "last", F.col("s").alias("k"), F.col("log_index").alias("b"))
    from_s = pairs.select("stratum", "s", F.col("t").alias("k"), F.col("log_index").alias("a"))
    links = from_s.join(to_last, ["stratum", "k"]).join(ends, ["stratum", "last"]).filter(inside("s") & inside("k"))
    steps = links.groupBy("stratum", "last", "s").agg(F.avg(F.col("a") + F.col("b")).alias("g"))

    def solve(pdf):
        months = sorted(pdf["last"].unique())
        log_p = {}
        for t in months:
            rows = pdf[pdf["last"] == t]
            known = [(log_p[s], g) for s, g in zip(rows["s"], rows["g"]) if s in log_p]
            log_p[t] = float(np.mean([a + g for a, g in known])) if known else 0.0
        out = pdf[["stratum"]].iloc[:1].merge(pd.DataFrame({"period": months, "value": [100 * np.exp(log_p[t]) for t in months]}), how="cross")
        return out

    return steps.groupBy("stratum").applyInPandas(solve, "stratum string, period date, value double")  # months x window rows a stratum


def time_dummies(prices: DataFrame, stratum: str | None = None) -> DataFrame:
    """(stratum, period, value) of each stratum's time product dummy regression of ln price on item and month.

    Item effects are swept out by groups, so the normal matrix has months only; Spark builds it, and one small group a
    stratum (months x months rows) solves it. With a stratum given, (period, value) of that one.
    """
    rows = prices if stratum is None else prices.filter(F.col("stratum") == stratum)
    p = rows.filter("price > 0").select("stratum", "item", "period", F.ln("price").alias("lp"))
    w = Window.partitionBy("stratum", "item")
    p = p.withColumn("n", F.count("*").over(w)).withColumn("mean", F.avg("lp").over(w))
    own = p.groupBy("stratum", F.col("period").alias("s")).agg(F.sum(F.col("lp") - F.col("mean")).alias("b"), F.count("*").alias("d"))
    a, b = p.select("stratum", "item", F.col("period").alias("s"), "n"), p.select("stratum", "item", F.col("period").alias("t"))
    cross = a.join(b, ["stratum", "item"]).groupBy("stratum", "s", "t").agg(F.sum(1 / F.col("n")).alias("x"))

    def solve(g):
        own = g.drop_duplicates("s").sort_values("s")
        at = {d: i for i, d in enumerate(own["s"])}
        matrix, rhs = np.diag(own["d"].to_numpy(float)), own["b"].to_numpy(float)
        np.subtract.at(matrix, (g["s"].map(at).to_numpy(), g["t"].map(at).to_numpy()), g["x"].to_numpy(float))
        x = np.r_[0.0, np.linalg.lstsq(matrix[1:, 1:], rhs[1:], rcond=None)[0]] if len(at) > 1 else np.zeros(len(at))
        return own[["stratum", "s"]].rename(columns={"s": "period"}).assign(value=100 * np.exp(x))

    out = cross.join(own, ["stratum", "s"]).groupBy("stratum").applyInPandas(solve, "stratum string, period date, value double")
    return out if stratum is None else out.select("period", "value")


def solved(matrix: np.ndarray, rhs: np.ndarray, tiny: float = 1e-9) -> np.ndarray:
    """The solution of a symmetric system by elimination; unknowns whose pivot vanishes are 0."""
    m, n = np.c_[matrix, rhs].astype(float), len(rhs)
    good = np.zeros(n, bool)
    for k in range(n):
        if abs(m[k, k]) > tiny:
            good[k] = True
            m[k] /= m[k, k]
            others = np.arange(n) != k
            m[others] -= m[others, k : k + 1] * m[k]
    return np.where(good, m[:, n], 0.0)


def rolling_time_dummies(prices: DataFrame, window: int = 13) -> DataFrame:
    """(stratum, period, value): time product dummies over a rolling window, joined by the mean splice.

    The first window (the first `window` calendar months) is taken as it is, 100 in its first month. Each later month has a
    window that ends with it; its log value is the mean, over the window's earlier months s, of log P(s) plus the window's
    step from s to it. prices(period, stratum, item, price) has one row per item and month; prices that are not positive are
    left out. A month that shares no item with the rest of its window stays on the level of the window's first month.

    A row joins the `window` windows that its month lies in. Item effects are swept out within a window, so that Spark sums a
    normal matrix of at most window x window cells per (stratum, window); one small group a stratum solves its windows in order.
    """
    p = prices.filter("price > 0").select("stratum", "item", (12 * F.year("period") + F.month("period")).alias("m"), F.ln("price").alias("lp"))
    month = p.select("stratum", "m").distinct()
    first = month.groupBy("stratum").agg(F.min("m").alias("m0"))
    end = month.join(first, "stratum").filter(F.col("m") < F.col("m0") + window).groupBy("stratum").agg(F.max("m").alias("end"))
    ends = month.join(end, "stratum").filter("m >= end").select("stratum", F.col("m").alias("last"))
    rows = p.withColumn("last", F.explode(F.sequence("m", F.col("m") + (window - 1)))).join(ends, ["stratum", "last"])
    item = rows.groupBy("stratum", "last", "item").agg(F.array_sort(F.collect_list(F.struct("m", "lp"))).alias("x"), F.avg("lp").alias("mean"), F.count("*").alias("n"))
    pairs = item.select("stratum", "last", "mean", "n", "x", F.explode("x").alias("a")).select("stratum", "last", "mean", "n", "a", F.explode(F.filter("x", lambda b: b["m"] >= F.col("a.m"))).alias("b"))
    same = F.col("a.m") == F.col("b.m")
    cells = pairs.groupBy("stratum", "last", F.col("a.m").alias("s"), F.col("b.m").alias("t")).agg(
        F.sum(1 / F.col("n")).alias("x"), F.sum(F.when(same, F.col("a.lp") - F.col("mean"))).alias("b"), F.count_if(same).alias("d")
    )

    def solve(pdf):
        log_p: dict[int, float] = {}
        for last, g in pdf.groupby("last", sort=True):
            own = g[g["s"] == g["t"]].sort_values("s")
            months = own["s"].tolist()
            at = {m: i for i, m in enumerate(months)}
            matrix = np.diag(own["d"].to_numpy(float))
            for s, t, x in zip(g["s"], g["t"], g["x"]):
                matrix[at[s], at[t]] -= x
                if s != t:
                    matrix[at[t], at[s]] -= x
            step = np.r_[0.0, solved(matrix[1:, 1:], own["b"].to_numpy(float)[1:])]
            if not log_p:
                log_p = dict(zip(months, step.tolist()))
            else:
                known = [log_p[m] - step[i] for m, i in at.items() if m != last and m in log_p]
                log_p[last] = step[-1] + (sum(known) / len(known) if known else 0.0)
        months = sorted(log_p)
        out = pd.DataFrame({"period": [dt.date((m - 1) // 12, (m - 1) % 12 + 1, 1) for m in months], "value": [100 * np.exp(log_p[m]) for m in months]})
        out.insert(0, "stratum", pdf["stratum"].iloc[0])
        return out

    return cells.groupBy("stratum").applyInPandas(solve, "stratum string, period date, value double")  # months x window^2 / 2 rows


def sub_index(df: DataFrame, price: Column) -> DataFrame:
    """The fixed-base Jevons series of another price of the same items: df(period, item, ...)."""
    from .relatives import jevons_series

    return jevons_series(df.select("period", "item", price.alias("price")).filter("price > 0"))
