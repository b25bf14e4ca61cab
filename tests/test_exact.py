"""Results that do not depend on partitions, quantiles of large groups, and reports without scans."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.exact import exact_avg, exact_sum
from plumbline.operators import quantiles, relatives, validate
from plumbline.parameters import Methodology
from plumbline.plans.index_run import index_run

KEYS = ["route_id", "apd"]


def relatives_of(spark, sizes, seed=1):
    r = random.Random(seed)
    rows = [(dt.date(2024, 1, 1 + i % 28), k, 7, f"c{i}", 1.0, r.choice((r.gauss(0, 1), 0.25, 5.0))) for k, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "period date, route_id int, apd int, carrier string, relative double, log_relative double")


def test_sums_do_not_depend_on_order(spark):
    r = random.Random(2)
    values = [r.gauss(0, 1) * 10 ** r.randint(-6, 6) for _ in range(5000)] + [1e15, -1e15, None]
    seen = set()
    for parts in (1, 3, 50):
        r.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        seen.add(tuple(df.agg(exact_sum("v"), exact_avg("v")).first()))
    assert len(seen) == 1
    total, mean = seen.pop()
    assert total == pytest.approx(math.fsum(v for v in values if v is not None), abs=1e-9) and mean == total / 5002
    assert spark.range(0).agg(exact_sum(F.col("id").cast("double")), exact_avg(F.col("id").cast("double"))).first()[0] is None


def test_quantiles_of_large_groups_equal_aggregates(spark, monkeypatch):
    r = random.Random(3)
    rows = [("hot", r.gauss(0, 1)) for _ in range(30_000)] + [("tied", 1.5)] * 20_000 + [(None, float(i)) for i in range(10)] + [("one", 2.0), ("none", None), ("two", 1.0), ("two", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    kept = []
    plain = quantiles.stored
    monkeypatch.setattr(quantiles, "stored", lambda d, name: kept.append(plain(d, name)) or kept[-1])
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {x.k: (x.n, x.q) for x in quantiles.quantiles(df, ["k"], "v", probabilities).collect()}
    want = {x.k: (x.n, x.q) for x in df.filter("v is not null").groupBy("k").agg(F.count("*").alias("n"), F.percentile("v", F.array(*map(F.lit, probabilities))).alias("q")).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-12, abs=1e-12) for k in want)
    spread = {x.k: x.tasks for x in kept[0].groupBy("k").agg(F.countDistinct("__task").alias("tasks")).collect()}
    assert spread["hot"] > 3  # one group, several tasks
    assert quantiles.quantiles(df.limit(0), ["k"], "v", [0.5]).count() == 0


def test_large_strata_are_flagged_alike(spark):
    rel = relatives_of(spark, [9000, 300, 2, 1, 40])
    rel = rel.unionByName(rel.filter("route_id = 4").withColumn("route_id", F.lit(9)).withColumn("log_relative", F.lit(0.5)))  # no spread at all
    row = lambda df: sorted((x.route_id, x.period, x.carrier, x.modified_z, x.outlier) for x in df.select("route_id", "period", "carrier", F.round("modified_z", 9).alias("modified_z"), "outlier").collect())
    key = lambda df: [tuple(map(str, x)) for x in row(df.na.fill(-99.0, ["modified_z"]))]
    a, b = relatives.flag_outliers(rel, 2.0), relatives.flag_outliers_of_large_strata(rel, 2.0)
    assert a.columns == b.columns and key(a) == key(b)


def quotes(spark, n=4000):
    r = random.Random(5)
    rows = [(dt.date(2024, 1, d), dt.datetime(2024, 1, d, 5), r.randrange(3), r.choice((1, 7, 15, 30)), f"c{r.randint(0, 2)}", 50 + r.random() * 100, None, "observed", None) for d in [1 + i % 20 for i in range(n)]]
    return spark.createDataFrame(rows, "period date, collection_ts timestamp, route_id int, apd int, carrier string, total_fare double, fare_class string, observation_status string, exclusion_reason string")


def test_a_recompute_has_the_same_bits_with_any_partitions(spark):
    routes = spark.createDataFrame([(0, 0.1), (1, 0.7), (2, 0.2)], "route_id int, weight double")
    method, q, before = Methodology(carriers=("c0", "c1", "c2")), quotes(spark), spark.conf.get("spark.sql.shuffle.partitions")
    runs = []
    try:
        for parts in (1, 7, 200):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            runs.append(index_run(q.repartition(parts), routes, method).stack)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    values = ["value", "coverage", "low", "high"]
    assert runs[0].count() > 20
    for other in runs[1:]:
        assert validate.changed_bits(runs[0], other, ["series_id", "period"], values).count() == 0
    nudged = runs[0].withColumn("value", F.when(F.col("series_id") == runs[0].first().series_id, F.col("value") * (1 + 2**-52)).otherwise(F.col("value")))
    assert validate.changed_bits(runs[0], nudged, ["series_id", "period"], values).count() > 0
    assert validate.changed_bits(runs[0], runs[0].limit(0), ["series_id", "period"], values).count() == runs[0].count()


def test_a_report_reads_no_stage(spark):
    routes = spark.createDataFrame([(0, 0.1), (1, None), (2, 0.2)], "route_id int, weight double")
    run = index_run(quotes(spark, 900), routes, Methodology(carriers=("c0", "c1", "c2")))
    report = run.report(routes)
    plan = report._jdf.queryExecution().toString()
    assert "parquet" not in plan.lower()
    got, n = report.first(), lambda df: df.count()
    assert (got.n_observations, got.n_relatives, got.n_panel_rows) == (n(run.obs), n(run.flagged), n(run.panel))
    assert (got.n_outliers, got.n_imputed, got.n_suppressed) == (n(run.flagged.filter("outlier")), n(run.filled.filter("imputed")), n(run.panel.filter("suppressed")))
    assert (got.n_raw, got.n_window, got.n_smoothed) == (n(run.composite), n(run.windows), n(run.smoothed)) and got.base_period == dt.date(2024, 1, 1) and got.n_periods == 20
    empty = index_run(quotes(spark, 900).limit(0), routes, Methodology(carriers=("c0",))).report(routes).first()
    assert empty.n_observations == 0 and empty.base_period is None and "no_observations" in empty.warnings
