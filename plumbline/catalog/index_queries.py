"""Queries of the index run: eligibility to stacked series."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import parameters
from ..operators import eligibility, panel, quality, relatives, smooth
from ..operators.weights import active
from ..plans.index_run import index_run
from ..plans.spool import shared_path, stored
from ..sources import driver_tables as tables
from ..sources import sinks
from ..sources.versions import Change, Store
from .common import COMP, FILL, FLAG, METHOD, OBS, PANEL, PARTIAL, QUOTES, REL, ROUTE, ROUTES, RUN, RUNS, SMOOTH, UPPER, out, routes, sql

STACK = """series AS (SELECT 'composite.raw' AS series_id, period, value, coverage, suppressed, low, high FROM comp
UNION ALL SELECT 'window.T' || CAST(apd AS VARCHAR), period, value, coverage, coverage < 0.75, NULL, NULL FROM win
UNION ALL SELECT 'composite', period, value, coverage, suppressed, low, high FROM smooth)"""

Q, S = {}, {}


def add(name, oracle=None):
    def keep(f):
        Q[name] = lambda spark, sf_dir: out(f(spark, sf_dir))
        if oracle:
            S[name] = oracle
        return f

    return keep


def run_of(spark, d, n=ROUTES, partial=False):
    return index_run(tables.quotes(spark, d, n), routes(spark, d, n, partial), METHOD)


@add("flagship_index", sql("SELECT CAST(c.period AS VARCHAR) AS period, round(c.value, 6) AS raw, round(c.low, 6) AS low, round(c.high, 6) AS high, round(c.coverage, 6) AS coverage, c.suppressed, round(s.value, 6) AS smoothed FROM comp c LEFT JOIN smooth s USING (period)", *RUN, n=2))
def flagship_index(spark, d):
    r = run_of(spark, d, 2)
    return r.composite.select("period", F.col("value").alias("raw"), "low", "high", "coverage", "suppressed").join(r.smoothed.select("period", F.col("value").alias("smoothed")), "period", "left")


@add("s1_observations", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, carrier, round(price, 6) AS price FROM obs WHERE period >= DATE '2024-01-05' AND period < DATE '2024-01-25'", QUOTES, OBS))
def s1_observations(spark, d):
    return eligibility.observations(tables.quotes(spark, d), "2024-01-05", "2024-01-25")


@add("s2_route_weights", sql("SELECT route_id, round(weight, 6) AS weight FROM routes WHERE route_id % 4 <> 3", QUOTES, ROUTE))
def s2_route_weights(spark, d):
    return active(routes(spark, d).withColumn("active", F.col("route_id") % 4 != 3)).select("route_id", "weight")


@add("s2_usable_weights", sql("SELECT route_id, round(weight, 6) AS w FROM routes", QUOTES, ROUTE))
def s2_usable_weights(spark, d):
    return panel.usable_weights(routes(spark, d)).select("route_id", "w")


@add("o1_panel_in_order", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, round(jevons, 6) AS jevons FROM panel ORDER BY panel.period, route_id, apd", *RUN[:6]))
def o1_panel_in_order(spark, d):
    return panel.in_order(run_of(spark, d).panel).select("period", "route_id", "apd", "jevons")


@add("s3_f21_stamped_panel", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, round(jevons, 6) AS jevons, true AS has_hash, 1 AS one_vintage FROM panel", *RUN[:6]))
def s3_f21_stamped_panel(spark, d):
    p = parameters.stamped(run_of(spark, d).panel, METHOD.param_table(spark), "2024-01-31")
    shuffled = parameters.stamp(METHOD.param_table(spark).orderBy(F.rand(7))).select(F.col("config_hash").alias("other"))
    ok = (F.length("config_hash") == 64) & (F.col("config_hash") == F.col("other")) & F.startswith("vintage_id", F.lit("2024-01-31-"))
    return p.crossJoin(F.broadcast(shuffled)).select("period", "route_id", "apd", "jevons", ok.alias("has_hash"), F.lit(1).alias("one_vintage"))


CONTRACT = """quoted AS (SELECT * EXCLUDE (source, carrier, observation_status, collection_ts), CASE WHEN quote_id % 131 = 0 THEN NULL WHEN quote_id % 101 = 0 THEN 'XX' ELSE 'R' || lpad(CAST(route_id AS VARCHAR), 2, '0') END AS origin,
  CASE WHEN quote_id % 137 = 0 THEN NULL WHEN quote_id % 103 = 0 THEN 'R' || lpad(CAST(route_id AS VARCHAR), 2, '0') ELSE 'HUB' END AS destination, CASE WHEN quote_id % 139 = 0 THEN NULL WHEN quote_id % 107 = 0 THEN 400 ELSE apd END AS lead,
  CASE WHEN quote_id % 149 <> 0 THEN observation_status END AS observation_status, CASE WHEN quote_id % 151 <> 0 THEN carrier END AS carrier, CASE WHEN quote_id % 157 <> 0 THEN source END AS source, CASE WHEN quote_id % 163 <> 0 THEN period + apd END AS departure_date, CASE WHEN quote_id % 167 <> 0 THEN collection_ts END AS collection_ts, CASE WHEN quote_id % 109 = 0 THEN NULL WHEN quote_id % 113 = 0 THEN -total_fare ELSE total_fare END AS fare, CASE WHEN quote_id % 127 <> 0 THEN sha256(CAST(quote_id AS VARCHAR)) END AS h FROM quotes)"""


def contract_quotes(spark, d):
    q, k = tables.quotes(spark, d), F.col("quote_id")
    code = F.concat(F.lit("R"), F.lpad(F.col("route_id").cast("string"), 2, "0"))
    return (
        q.withColumn("departure_date", F.when(k % 163 != 0, F.date_add("period", F.col("apd")))).withColumn("origin", F.when(k % 131 == 0, None).when(k % 101 == 0, "XX").otherwise(code)).withColumn("destination", F.when(k % 137 == 0, None).when(k % 103 == 0, code).otherwise("HUB"))
        .withColumns({c: F.when(k % m != 0, F.col(c)) for c, m in (("observation_status", 149), ("carrier", 151), ("source", 157), ("collection_ts", 167))})
        .withColumn("apd", F.when(k % 139 == 0, None).when(k % 107 == 0, 400).otherwise(F.col("apd"))).withColumn("total_fare", F.when(k % 109 == 0, None).when(k % 113 == 0, -F.col("total_fare")).otherwise(F.col("total_fare")))
        .withColumn("raw_payload_hash", F.when(k % 127 != 0, F.sha2(k.cast("string"), 256)))
    )


@add("p6_row_contract", sql("""SELECT quote_id, concat_ws(',', CASE WHEN carrier IS NULL THEN 'carrier_present' END, CASE WHEN collection_ts IS NULL THEN 'collection_ts_present' END, CASE WHEN departure_date IS NULL THEN 'departure_date_present' END,
  CASE WHEN destination IS NULL OR length(destination) <> 3 THEN 'destination_code' END, CASE WHEN origin = destination THEN 'distinct_ends' END, CASE WHEN fare < 0 THEN 'fare_not_negative' END,
  CASE WHEN lead IS NULL OR lead NOT BETWEEN 0 AND 365 THEN 'lead_days' END, CASE WHEN observation_status IS NULL THEN 'observation_status_present' END, CASE WHEN observation_status = 'observed' AND fare IS NULL THEN 'observed_has_fare' END,
  CASE WHEN observation_status = 'observed' AND h IS NULL THEN 'observed_has_hash' END, CASE WHEN origin IS NULL OR length(origin) <> 3 THEN 'origin_code' END, CASE WHEN source IS NULL THEN 'source_present' END) AS violations FROM quoted""", QUOTES, CONTRACT))
def p6_row_contract(spark, d):
    return contract_quotes(spark, d).select("quote_id", F.array_join(eligibility.violations(eligibility.row_contract()), ",").alias("violations"))


@add("p7_batch_contract", "SELECT event_id, TRY_CAST(regexp_extract(props, '\"k\": ?(-?[0-9]+)', 1) AS INTEGER) AS k, CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id AS INTEGER) END AS lead, CASE WHEN event_id % 13 = 0 THEN 'lead_type' ELSE '' END AS violations FROM events")
def p7_batch_contract(spark, d):
    e = tables.read(spark, d, "events")
    raw = e.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("T+"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string")).alias("lead"))
    return eligibility.coerced(raw, {"k": "int", "lead": "int"}).withColumn("violations", F.array_join("violations", ","))


@add("p8_table_constraints", """SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_extendedprice * (1 - l_discount) < l_extendedprice * 0.9 + l_extendedprice * l_tax - 0.01) AS uncovered FROM lineitem GROUP BY ALL""")
def p8_table_constraints(spark, d):
    li = tables.read(spark, d, "lineitem")
    q = li.select("l_returnflag", "l_linestatus", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_fare"), (F.col("l_extendedprice") * 0.9).alias("base_fare"), (F.col("l_extendedprice") * F.col("l_tax")).alias("gst"), F.lit(None).cast("double").alias("udf"), F.lit("observed").alias("observation_status"))
    bad = q.withColumn("v", eligibility.violations(eligibility.table_constraints(["base_fare", "gst", "udf"])))
    return bad.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.count_if(F.array_contains("v", "total_covers_parts")).alias("uncovered"))


MOVED = "moved AS (SELECT DISTINCT 'run' || CAST(user_id % 50 AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS run_id, CAST(user_id % 50 AS INTEGER) AS source, CAST(ts AS DATE) AS day FROM events WHERE event_id % 47 = 0)"


@add("p14_quarantine", sql("SELECT observation_status, count(*) AS n FROM (SELECT CASE WHEN m.run_id IS NOT NULL THEN 'collection_failed' ELSE observation_status END AS observation_status FROM quotes q LEFT JOIN (SELECT run_id FROM moved WHERE source % 5 <> 0) m USING (run_id)) GROUP BY ALL", QUOTES, MOVED))
def p14_quarantine(spark, d):
    q = tables.quotes(spark, d)
    e = tables.read(spark, d, "events")
    r = e.select(F.concat(F.lit("run"), (F.col("user_id") % 50).cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("run_id"), (F.col("user_id") % 50).alias("source"), F.to_date("ts").alias("day"), (F.col("event_id") % 47 == 0).alias("selector_relocated"))
    confirmed = r.filter("source % 5 = 0").select("source", "day").distinct()
    return eligibility.quarantine(q, r, confirmed).groupBy("observation_status").agg(F.count("*").alias("n"))


@add("j1_relatives", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, carrier, round(relative, 6) AS relative, round(lr, 6) + 0.0 AS log_relative FROM rel", QUOTES, OBS, REL))
def j1_relatives(spark, d):
    return relatives.build_relatives(eligibility.observations(tables.quotes(spark, d)))


@add("a5_a7_outlier_flags", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, carrier, round(lr, 6) + 0.0 AS log_relative, round(z, 6) + 0.0 AS modified_z, coalesce(abs(z) > 3.5, false) AS outlier FROM flagged", QUOTES, OBS, REL, FLAG))
def a5_a7_outlier_flags(spark, d):
    return run_of(spark, d).flagged.drop("relative")


@add("a5_a7_large_strata", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, carrier, round(lr, 6) + 0.0 AS log_relative, round(z, 6) + 0.0 AS modified_z, coalesce(abs(z) > 3.5, false) AS outlier FROM flagged", QUOTES, OBS, REL, FLAG))
def a5_a7_large_strata(spark, d):
    """The same flags by the form for strata that outgrow a task."""
    rel = stored(relatives.build_relatives(eligibility.observations(tables.quotes(spark, d))), "relatives")
    return relatives.flag_outliers_of_large_strata(rel, 3.5).select("period", "route_id", "apd", "carrier", "log_relative", "modified_z", "outlier")


@add("m5_quartile_outliers", sql("""SELECT route_id, apd, count(*) AS n, count(*) FILTER (lr < q1 - 1.5 * (q3 - q1) OR lr > q3 + 1.5 * (q3 - q1)) AS outliers FROM
  (SELECT *, quantile_cont(lr, 0.25) OVER s AS q1, quantile_cont(lr, 0.75) OVER s AS q3 FROM rel WINDOW s AS (PARTITION BY route_id, apd)) GROUP BY ALL""", QUOTES, OBS, REL))
def m5_quartile_outliers(spark, d):
    r = relatives.quartile_outliers(relatives.build_relatives(eligibility.observations(tables.quotes(spark, d))))
    return r.groupBy("route_id", "apd").agg(F.count("*").alias("n"), F.count_if("outlier").alias("outliers"))


@add("j3_missing_carriers", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, carrier FROM missing", QUOTES, OBS, REL, FILL))
def j3_missing_carriers(spark, d):
    return relatives.missing_carriers(run_of(spark, d).flagged, METHOD.carrier_table(spark))


@add("a8_u1_imputation", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, carrier, round(exp(lr), 6) AS relative, imputed FROM filled", QUOTES, OBS, REL, FILL))
def a8_u1_imputation(spark, d):
    return run_of(spark, d).filled.select("period", "route_id", "apd", "carrier", "relative", "imputed")


@add("a3_a4_panel", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, round(jevons, 6) AS jevons, n_observed, n_imputed, round(coverage, 6) AS coverage, suppressed FROM panel", QUOTES, OBS, REL, FILL, PANEL))
def a3_a4_panel(spark, d):
    return run_of(spark, d).panel


@add("a9_a10_upper_level", sql("SELECT CAST(period AS VARCHAR) AS period, curve, round(value, 6) AS value, round(coverage, 6) AS coverage, n_strata FROM upper_", *RUN[:8]))
def a9_a10_upper_level(spark, d):
    return run_of(spark, d).upper


@add("a11_composite", sql("SELECT CAST(period AS VARCHAR) AS period, round(value, 6) AS value, round(coverage, 6) AS coverage, round(low, 6) AS low, round(high, 6) AS high, n_strata, suppressed FROM comp", *RUN[:9]))
def a11_composite(spark, d):
    return run_of(spark, d).composite


@add("a12_window_index", sql("SELECT CAST(period AS VARCHAR) AS period, apd, round(value, 6) AS value, round(coverage, 6) AS coverage, coverage < 0.75 AS suppressed FROM win", *RUN[:10]))
def a12_window_index(spark, d):
    return run_of(spark, d).windows


@add("a13_a14_weight_gate", sql("""SELECT count(*) AS n_routes, count(weight) AS n_weighted, round(count(weight) / count(*), 6) AS weight_coverage, count(weight) > 0 AS weights_real,
  count(weight) > 0 AND count(weight) / count(*) < 0.9 AS weights_refused FROM routes""", QUOTES, PARTIAL))
def a13_a14_weight_gate(spark, d):
    return panel.weight_coverage(routes(spark, d, partial=True))


@add("a13_refused_composite", sql("SELECT CAST(period AS VARCHAR) AS period, round(value, 6) AS value, round(low, 6) AS low, round(high, 6) AS high FROM comp", *RUN[:6], "routes AS (SELECT DISTINCT route_id, 1.0 AS weight FROM quotes)", UPPER, COMP))
def a13_refused_composite(spark, d):
    return run_of(spark, d, partial=True).composite.select("period", "value", "low", "high")


@add("a15_weight_label", sql("SELECT 'value_share' AS basis, 'events' AS source, CAST(min(weight_start) AS VARCHAR) AS starts, CAST(max(weight_end) AS VARCHAR) AS ends, 1 AS n_groups FROM routes WHERE weight IS NOT NULL", QUOTES, ROUTE))
def a15_weight_label(spark, d):
    return panel.weight_label(routes(spark, d))


@add("w1_w5_centred_mean", sql("SELECT CAST(period AS VARCHAR) AS period, round(value, 6) AS value, round(low, 6) AS low, round(high, 6) AS high, round(coverage, 6) AS coverage, suppressed FROM smooth", *RUN))
def w1_w5_centred_mean(spark, d):
    return run_of(spark, d).smoothed.select("period", "value", "low", "high", "coverage", "suppressed")


@add("u2_series_stack", sql("SELECT series_id, 'daily' AS frequency, CAST(period AS VARCHAR) AS period, round(value, 6) AS value, round(coverage, 6) AS coverage, suppressed, round(low, 6) AS low, round(high, 6) AS high FROM series", *RUN, STACK))
def u2_series_stack(spark, d):
    return run_of(spark, d).series()


@add("a22_run_report", sql("""SELECT (SELECT count(*) FROM obs) AS n_observations, (SELECT CAST(min(period) AS VARCHAR) FROM obs) AS base_period, (SELECT count(*) FROM flagged) AS n_relatives,
  (SELECT count(*) FROM flagged WHERE abs(z) > 3.5) AS n_outliers, (SELECT count(*) FROM filled WHERE imputed) AS n_imputed, (SELECT count(*) FROM panel) AS n_panel_rows, (SELECT count(*) FROM panel WHERE suppressed) AS n_suppressed,
  (SELECT count(*) FROM series) AS n_index_values, concat_ws(',', CASE WHEN (SELECT count(*) FROM comp) = 0 THEN 'all_suppressed' END,
  CASE WHEN (SELECT count(*) FROM comp) > 0 AND (SELECT count(*) FROM smooth) = 0 THEN 'no_complete_week' END) AS warnings""", *RUN, STACK))
def a22_run_report(spark, d):
    r = run_of(spark, d).report(routes(spark, d))
    return r.select("n_observations", "base_period", "n_relatives", "n_outliers", "n_imputed", "n_panel_rows", "n_suppressed", "n_index_values", "warnings")


@add("a1_jevons", sql("SELECT o.route_id, o.apd, round(exp(avg(ln(o.price / b.price))), 6) AS jevons, count(*) AS n FROM obs o JOIN obs b USING (route_id, apd, carrier) WHERE b.period = (SELECT min(period) FROM obs) GROUP BY ALL", QUOTES, OBS))
def a1_jevons(spark, d):
    o = eligibility.observations(tables.quotes(spark, d))
    base = o.crossJoin(F.broadcast(relatives.base_period(o))).filter("period = base_period").select("route_id", "apd", "carrier", F.col("price").alias("base_price"))
    return relatives.jevons(o.join(base, ["route_id", "apd", "carrier"]), ["route_id", "apd"], strict=True)


@add("a2_jevons_series", sql("""SELECT CAST(o.period AS VARCHAR) AS period, round(100 * exp(avg(ln(o.price / b.price))), 6) AS value, count(*) AS n FROM (SELECT period, carrier, min(price) AS price FROM obs GROUP BY ALL) o
  JOIN (SELECT period, carrier, min(price) AS price FROM obs GROUP BY ALL) b USING (carrier) WHERE b.period = (SELECT min(period) FROM obs) GROUP BY ALL""", QUOTES, OBS))
def a2_jevons_series(spark, d):
    o = eligibility.observations(tables.quotes(spark, d)).groupBy("period", F.col("carrier").alias("item")).agg(F.min("price").alias("price"))
    return relatives.jevons_series(o)


@add("f22_curve_expectation", sql("SELECT 'bad_sum' AS curve, 'sum' AS problem UNION ALL SELECT 'bad_windows', 'windows' FROM (SELECT count(*) AS n FROM events) WHERE n > 0"))
def f22_curve_expectation(spark, d):
    q = tables.quotes(spark, d).filter(eligibility.in_windows()).groupBy("apd").agg(F.count("*").alias("n"))
    good = METHOD.curve_table(spark)
    too_much = q.select(F.lit("bad_sum").alias("curve"), "apd", F.lit(0.5).alias("curve_weight"))
    short = q.filter("apd > 1").select(F.lit("bad_windows").alias("curve"), "apd", (F.lit(1.0) / 3).alias("curve_weight"))
    return parameters.curve_violations(good.unionByName(too_much).unionByName(short))


SRC = "lowest AS (SELECT source, route_id, apd, carrier, period, min(total_fare) AS fare FROM quotes WHERE total_fare > 0 GROUP BY ALL)"


@add("j13_source_agreement", sql("SELECT a.source AS source_a, b.source AS source_b, count(*) AS n, round(avg(ln(a.fare / b.fare)), 6) + 0.0 AS mean_log_ratio FROM lowest a JOIN lowest b USING (route_id, apd, carrier, period) WHERE a.source < b.source GROUP BY ALL", QUOTES, SRC))
def j13_source_agreement(spark, d):
    return quality.source_agreement(tables.quotes(spark, d))


@add("j16_canonical_quotes", sql("SELECT quote_id, source FROM (SELECT *, row_number() OVER (PARTITION BY route_id, apd, carrier, period ORDER BY source DESC, total_fare, quote_id) AS rn FROM quotes) WHERE rn = 1", QUOTES))
def j16_canonical_quotes(spark, d):
    ranks = spark.createDataFrame([("src0", 3), ("src1", 2), ("src2", 1)], "source string, rank int")
    return quality.canonical_quotes(tables.quotes(spark, d), ranks).select("quote_id", "source")


@add("j2_resolve_routes", sql("""SELECT count(*) FILTER (code IS NOT NULL) AS resolved, count(*) FILTER (code IS NULL) AS rejected FROM (SELECT route_id, CASE WHEN route_id < 4 THEN 'HUB' END AS code FROM quotes)""", QUOTES))
def j2_resolve_routes(spark, d):
    q = tables.quotes(spark, d).withColumn("origin", F.concat(F.lit("R"), F.col("route_id").cast("string"))).withColumn("destination", F.lit("HUB")).drop("route_id")
    known = routes(spark, d).filter("route_id < 4").select(F.concat(F.lit("R"), F.col("route_id").cast("string")).alias("origin"), F.lit("HUB").alias("destination"), "route_id")
    good, bad = quality.resolve_routes(q, known)
    return good.agg(F.count("*").alias("resolved")).crossJoin(bad.agg(F.count("*").alias("rejected")))


KEY = "coalesce(fare_class, '')"


@add("w2_keep_earliest", sql(f"SELECT quote_id FROM (SELECT *, row_number() OVER (PARTITION BY source, carrier, route_id, apd, {KEY}, period ORDER BY collection_ts, quote_id) AS rn FROM quotes) WHERE rn = 1", QUOTES))
def w2_keep_earliest(spark, d):
    return quality.keep_earliest(tables.quotes(spark, d), ["source", "carrier", "route_id", "apd", "fare_class", "period"], ["collection_ts", "quote_id"]).select("quote_id")


@add("k1_k2_append_if_absent", sql(f"""SELECT count(*) AS written, (SELECT count(*) FROM quotes WHERE quote_id % 3 <> 0) - count(*) AS duplicate FROM (SELECT DISTINCT source, carrier, route_id, apd, {KEY} AS fc, period FROM quotes WHERE quote_id % 3 <> 0
  EXCEPT SELECT source, carrier, route_id, apd, {KEY}, period FROM quotes WHERE quote_id % 2 = 0)""", QUOTES))
def k1_k2_append_if_absent(spark, d):
    q, keys = tables.quotes(spark, d), ["source", "carrier", "route_id", "apd", "fare_class", "period"]
    new, target = q.filter("quote_id % 3 <> 0"), q.filter("quote_id % 2 = 0")
    return quality.append_counts(new, quality.append_if_absent(new, target, keys, ["collection_ts", "quote_id"]))


@add("k3_f4_panel_upsert", sql("SELECT CAST(period AS VARCHAR) AS period, route_id, apd, round(round(CASE WHEN route_id = 1 THEN jevons ELSE jevons + 1 END, 8), 6) AS jevons, round(coverage, 4) AS coverage, n_observed FROM panel", *RUN[:6]))
def k3_f4_panel_upsert(spark, d):
    rows = panel.panel_rows(run_of(spark, d).panel)
    store, keys = Store(spark, shared_path(spark, "store")), ["period", "route_id", "apd"]
    store.commit({"panel": store.merged("panel", panel.panel_rows(rows.withColumn("jevons", F.col("jevons") + 1)), keys, "period")})
    store.commit({"panel": store.merged("panel", rows.filter("route_id = 1"), keys, "period")})
    return store.read("panel", rows.schema).select("period", "route_id", "apd", "jevons", "coverage", "n_observed")


@add("k4_f4_published_values", sql("""SELECT series_id, CAST(period AS VARCHAR) AS period, round(CASE WHEN period >= DATE '2024-01-15' THEN value ELSE value - 1 END, 6) AS value, round(coverage, 4) AS coverage, suppressed, round(low, 6) AS low,
  CASE WHEN period >= DATE '2024-01-15' THEN 'new' ELSE 'old' END AS config_hash, '2024-02-01 00:00:00' AS published_at FROM series""", *RUN, STACK))
def k4_f4_published_values(spark, d):
    run = run_of(spark, d)
    store = Store(spark, shared_path(spark, "store"))
    s, rows = stored(run.series(), "series"), panel.panel_rows(run.panel)
    sinks.publish(rows, panel.index_rows(s.withColumn("value", F.col("value") - 1), "v1", "old", "2024-02-01"), store)
    again = panel.index_rows(s.filter("period >= date'2024-01-15'"), "v1", "new", "2024-02-02")  # later, and only a part
    sinks.publish(rows, again, store)
    out = store.read("values", again.schema)
    return out.select("series_id", "period", "value", "coverage", "suppressed", "low", "config_hash", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


@add("k5_write_back_flags", sql("""SELECT coalesce(o.outlier, quote_id % 17 = 0) AS outlier_flag, exclusion_reason, count(*) AS n FROM quotes q LEFT JOIN (SELECT DISTINCT period, route_id, apd, carrier, true AS outlier FROM flagged WHERE abs(z) > 2.0) o
  USING (period, route_id, apd, carrier) GROUP BY ALL""", QUOTES, OBS, REL, FLAG))
def k5_write_back_flags(spark, d):
    flagged = relatives.flag_outliers(relatives.build_relatives(eligibility.observations(tables.quotes(spark, d))), 2.0)
    flagged = stored(flagged, "flagged")
    store, quotes = Store(spark, shared_path(spark, "store")), tables.quotes(spark, d).withColumn("outlier_flag", F.col("quote_id") % 17 == 0)  # an earlier review
    store.commit({"quotes": Change(quotes, "period")})
    sinks.flag_outliers(store, flagged, quotes.schema)
    return store.read("quotes", quotes.schema).groupBy("outlier_flag", "exclusion_reason").agg(F.count("*").alias("n"))


@add("w8_weekday_adjusted", sql("""SELECT CAST(c.period AS VARCHAR) AS period, round(value, 6) AS value, round(value / exp(e - (SELECT avg(e) FROM eff)), 6) AS adjusted FROM comp c JOIN eff ON eff.d = isodow(c.period)""", *RUN,
  "eff AS (SELECT isodow(c.period) AS d, avg(ln(c.value / s.value)) AS e FROM comp c JOIN smooth s USING (period) GROUP BY ALL)"))
def w8_weekday_adjusted(spark, d):
    r = run_of(spark, d)
    return smooth.weekday_adjusted(r.composite, r.smoothed)
