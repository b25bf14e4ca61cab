"""Golden values worked by hand, and invariants of the index run."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from plumbline import parameters
from plumbline.operators import panel, relatives, smooth
from plumbline.parameters import Methodology
from plumbline.plans.index_run import index_run

D = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]


def obs(spark, rows):
    return spark.createDataFrame([(D[p], r, a, c, float(x)) for p, r, a, c, x in rows], "period date, route_id int, apd int, carrier string, price double")


def quotes(spark, rows, **over):
    fields = {"fare_class": None, "observation_status": "observed", "exclusion_reason": None} | over
    df = spark.createDataFrame([(i, D[p], dt.datetime.combine(D[p], dt.time(9)), r, a, c, float(x)) for i, (p, r, a, c, x) in enumerate(rows)], "quote_id long, period date, collection_ts timestamp, route_id int, apd int, carrier string, total_fare double")
    for k, v in fields.items():
        df = df.withColumn(k, F.lit(v).cast("string"))
    return df


def basket(spark, weights):
    return spark.createDataFrame(list(weights.items()), "route_id int, weight double")


def week(days=8):
    return [(d, 1, a, c, (1000 if c == "x" else 1200) + (10 if c == "x" else 12) * d + a) for d in range(days) for a in (1, 7, 15, 30) for c in ("x", "y")]


def test_fixed_base_and_matching(spark):
    got = relatives.build_relatives(obs(spark, [(0, 1, 7, "a", 100), (1, 1, 7, "a", 200), (2, 1, 7, "a", 400), (1, 1, 7, "b", 5), (0, 1, 7, "z", 0), (1, 1, 7, "z", 9)])).collect()
    assert sorted((r.carrier, r.period, r.relative) for r in got) == [("a", D[1], 2.0), ("a", D[2], 4.0)]


def flagged(spark, logs):
    rel = spark.createDataFrame([(D[1 + i], 1, 7, f"c{i}", math.exp(x), x) for i, x in enumerate(logs)], "period date, route_id int, apd int, carrier string, relative double, log_relative double")
    return {r.carrier: r for r in relatives.flag_outliers(rel, 3.5).collect()}


def test_outlier_rules(spark):
    got = flagged(spark, [0.0, 0.1, -0.1, 0.05, 3.0])
    assert got["c4"].outlier and not any(got[f"c{i}"].outlier for i in range(4)) and len(got) == 5
    spike = flagged(spark, [0.0, 0.0, 0.0, 0.0, 1.0])  # the median deviation is 0: mean absolute deviation instead
    assert abs(spike["c4"].modified_z - 1 / (0.2 * 1.253314)) < 1e-9 and spike["c4"].outlier
    assert all(r.modified_z is None and not r.outlier for r in flagged(spark, [0.5, 0.5, 0.5]).values())
    assert all(r.modified_z is None for r in flagged(spark, [0.0, 9.0]).values())


def test_imputation_leaves_jevons_alone(spark):
    rel = relatives.flag_outliers(relatives.build_relatives(obs(spark, [(0, 1, 7, "a", 100), (0, 1, 7, "b", 100), (1, 1, 7, "a", 120), (1, 1, 7, "b", 270)])), 3.5)
    filled = relatives.impute(rel, Methodology(("a", "b", "c", "d")).carrier_table(spark))
    rows = panel.elementary_panel(filled, 4, 0.6).collect()
    assert len(rows) == 1 and abs(rows[0].jevons - math.sqrt(1.2 * 2.7)) < 1e-12
    assert (rows[0].n_observed, rows[0].n_imputed, rows[0].coverage, rows[0].suppressed) == (2, 2, 0.5, True)
    assert filled.filter("imputed").count() == 2


def panel_rows(spark, rows):
    return spark.createDataFrame([(D[1], r, a, float(j), 1, 0, float(c), s) for r, a, j, c, s in rows], "period date, route_id int, apd int, jevons double, n_observed int, n_imputed int, coverage double, suppressed boolean")


def upper(spark, rows, weights, curves=None):
    m = Methodology((), curves or {"central": (0.3, 0.2, 0.1, 0.4), "alt": (0.1, 0.2, 0.3, 0.4)})
    w = panel.usable_weights(basket(spark, weights))
    return panel.composite(panel.upper_level(panel_rows(spark, rows), w, m.curve_table(spark)), 0.75).collect()


def test_upper_level(spark):
    assert abs(upper(spark, [(1, 7, 1.0, 1, False), (1, 30, 2.0, 1, False)], {1: None})[0].value - 100 * (0.2 + 0.8) / 0.6) < 1e-9
    assert abs(upper(spark, [(1, 7, 1.0, 1, False), (2, 7, 3.0, 1, False)], {1: 0.75, 2: 0.25})[0].value - 150) < 1e-9
    kept = upper(spark, [(1, 7, 1.0, 1, False), (2, 7, 99.0, 0.2, True)], {1: 1.0, 2: 1.0})[0]
    assert (kept.value, kept.n_strata) == (100.0, 1) and abs(kept.coverage - 1.2 / 8) < 1e-12 and kept.suppressed
    band = upper(spark, [(1, 1, 3.0, 1, False), (1, 30, 1.0, 1, False)], {1: 1.0})[0]
    assert band.low < band.value <= band.high
    assert upper(spark, [(1, 7, 1.0, 0.1, True)], {1: 1.0}) == []


def test_refused_and_partial_weights(spark):
    some = panel.usable_weights(basket(spark, {1: 0.5, 2: 0.3, 3: None})).collect()
    assert {r.w for r in some} == {1.0}
    nearly = basket(spark, {i: (None if i == 20 else 0.05) for i in range(1, 21)})
    assert {r.route_id: r.w for r in panel.usable_weights(nearly).collect()}[20] == 1.0
    assert panel.usable_weights(nearly, "drop").count() == 19
    label = panel.weight_label(basket(spark, {1: None}).selectExpr("*", "'b' as weight_basis", "'s' as weight_source", "date'2024-01-01' as weight_start", "date'2024-02-01' as weight_end")).first()
    assert label.basis == "equal_fallback" and label.n_groups == 0


def series(spark, days):
    return spark.createDataFrame([(D[d], 100.0 + d) for d in days], "period date, value double")


def test_centred_mean(spark):
    assert [tuple(r) for r in smooth.centred_mean(series(spark, range(7)), ["value"]).collect()] == [(D[3], 103.0)]
    assert smooth.centred_mean(series(spark, [0, 1, 2, 3, 4, 5, 7]), ["value"]).collect() == []
    with pytest.raises(ValueError):
        smooth.centred_mean(series(spark, [0]), ["value"], 6)


def test_eight_days_end_to_end(spark):
    m = Methodology(("x", "y"))
    run = index_run(quotes(spark, week()), basket(spark, {1: 1.0}), m)
    rows = run.series().collect()
    by = {}
    for r in rows:
        by.setdefault(r.series_id, []).append(r)
    assert len(by["composite"]) == 1 and len(by["composite.raw"]) == 7 and len(by["window.T7"]) == 7
    assert all(r.low <= r.value <= r.high for r in by["composite.raw"] + by["composite"])
    text = lambda rs: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in rs)
    assert text(rows) == text(index_run(quotes(spark, week()), basket(spark, {1: 1.0}), m).series().collect())
    report = run.report(basket(spark, {1: 1.0})).first()
    assert report.warnings == "" and report.n_index_values == len(rows) and report.base_period == D[0]


def warnings(spark, rows, carriers=("x", "y"), weights=None):
    b = basket(spark, weights or {1: 1.0})
    return index_run(quotes(spark, rows), b, Methodology(carriers)).report(b).first().warnings.split(",")


def test_nothing_published_says_why(spark):
    assert "one_day_only" in warnings(spark, week(1))
    assert "all_suppressed" in warnings(spark, week(), ("x", "y", "p", "q", "r"))
    assert "no_complete_week" in warnings(spark, week(4))
    assert "no_match" in warnings(spark, [(0, 1, 7, "x", 10), (1, 1, 7, "y", 10)])
    assert "equal_weights" in warnings(spark, week(), weights={1: None})
    assert "no_observations" in warnings(spark, [(0, 1, 8, "x", 10)])


def test_eligibility_reaches_the_scan(spark):
    for over, n in (({"fare_class": "filed_floor"}, 0), ({"fare_class": "economy"}, 64), ({"observation_status": "collection_failed"}, 0), ({"exclusion_reason": "manual"}, 0), ({}, 64)):
        assert index_run(quotes(spark, week(), **over), basket(spark, {1: 1.0}), Methodology(("x", "y"))).obs.count() == n


def test_stamp_and_curves(spark):
    m = Methodology(("x", "y"))
    a, b = (parameters.stamp(p).first()[0] for p in (m.param_table(spark), m.param_table(spark).orderBy(F.desc("key"))))
    assert a == b != parameters.stamp(Methodology(("x",)).param_table(spark)).first()[0]
    assert parameters.curve_violations(m.curve_table(spark)).collect() == []


def test_strict_jevons(spark):
    pairs = spark.createDataFrame([(1, 120.0, 100.0), (1, 90.0, 100.0), (1, 150.0, 120.0)], "k int, price double, base_price double")
    assert abs(relatives.jevons(pairs, ["k"], strict=True).first().jevons - (1.2 * 0.9 * 1.25) ** (1 / 3)) < 1e-12
    with pytest.raises(Exception, match="positive"):
        relatives.jevons(pairs.withColumn("price", F.lit(0.0)), ["k"], strict=True).collect()
