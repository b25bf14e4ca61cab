"""Queries of weights, collection health, normalisation and the read side."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import parameters
from ..operators import health, normalise, quality, weights
from ..plans import reads
from ..plans.spool import shared_path, stored
from ..sources import driver_tables as tables
from ..sources import sinks
from ..sources.versions import Store
from .common import CURVES, FLOWS, METHOD, OBS, PANEL, QUOTES, ROUTE, RUN, RUNS, out, route_table, sql
from .index_queries import STACK, run_of

Q, S = {}, {}
TODAY = "2024-01-30"


def add(name, oracle=None):
    def keep(f):
        Q[name] = lambda spark, sf_dir: out(f(spark, sf_dir))
        if oracle:
            S[name] = oracle
        return f

    return keep


# --- weights


def basket(spark, d):
    c = tables.cities(spark, d)
    n = F.substring("code", 2, 2).cast("int")
    a, b = c.filter(n % 4 == 0).select(F.col("code").alias("origin")), c.filter(n % 5 == 1).select(F.col("code").alias("destination"))
    return a.crossJoin(F.broadcast(b)).filter("origin <> destination")  # a basket is a short list of routes


def flows(spark, d):
    """The traffic, written once: its queries read it several times, and it is short however many order lines there are."""
    return stored(tables.flows(spark, d), "traffic-cells")


def mapped(spark, d, cells=None):
    return weights.mapped_flows(flows(spark, d) if cells is None else cells, tables.cities(spark, d))


@add("s4_traffic_csv", sql("SELECT origin, destination, CAST(period AS VARCHAR) AS period, passengers FROM flows", FLOWS))
def s4_traffic_csv(spark, d):
    cells, path = flows(spark, d), shared_path(spark, "traffic")
    rows = cells.select(F.year("period").alias("Year"), F.month("period").alias("Month"), F.col("city1").alias("City1"), F.col("city2").alias("City2"), F.col("passengers").alias("PaxToCity2"), F.lit("n/a").alias("PaxFromCity2"))
    rows.write.option("header", True).csv(path)
    return weights.mapped_flows(weights.traffic_cells(weights.read_traffic(spark, path)), tables.cities(spark, d))


@add("j10_city_report", sql("SELECT DISTINCT city, CASE WHEN refused THEN 'refused' ELSE 'unmapped' END AS problem FROM (SELECT city1 AS city FROM cells UNION SELECT city2 FROM cells) JOIN cities USING (city) WHERE refused OR unknown", FLOWS))
def j10_city_report(spark, d):
    return weights.city_report(flows(spark, d), tables.cities(spark, d))


@add("a16_j11_basket_shares", sql("SELECT origin, destination, round(passengers, 6) AS passengers, round(share, 6) AS share, months_observed, missing FROM shares", FLOWS))
def a16_j11_basket_shares(spark, d):
    return weights.basket_shares(mapped(spark, d), basket(spark, d))


@add("a17_national_totals", sql("SELECT CAST(period AS VARCHAR) AS period, round(sum(passengers), 6) AS total FROM cells GROUP BY ALL", FLOWS))
def a17_national_totals(spark, d):
    return weights.national_totals(tables.flows(spark, d))


@add("a18_load_gates", sql("""SELECT CAST(latest AS VARCHAR) AS latest, 12 * (2002 - year(latest)) + 6 - month(latest) AS age_months, n_missing, n_unmapped, concat_ws(',', CASE WHEN n_missing > 0 THEN 'missing_route' END,
  CASE WHEN 12 * (2002 - year(latest)) + 6 - month(latest) > 6 THEN 'stale' END, CASE WHEN n_unmapped > 0 THEN 'unmapped_code' END) AS failed
  FROM (SELECT (SELECT max(period) FROM flows) AS latest, (SELECT count(*) FROM shares WHERE missing) AS n_missing, (SELECT count(*) FROM (SELECT origin FROM basket UNION SELECT destination FROM basket EXCEPT SELECT code FROM good)) AS n_unmapped)""", FLOWS))
def a18_load_gates(spark, d):
    cells, b = flows(spark, d), basket(spark, d)
    known = mapped(spark, d, cells)
    shares = weights.basket_shares(known, b)
    return weights.load_gates(known, shares, weights.national_totals(cells), weights.unmapped_codes(b, tables.cities(spark, d)), "2002-06-15").drop("drift")


@add("u3_unmapped_codes", sql("SELECT origin AS code FROM basket UNION SELECT destination FROM basket EXCEPT SELECT code FROM good", FLOWS))
def u3_unmapped_codes(spark, d):
    return weights.unmapped_codes(basket(spark, d), tables.cities(spark, d))


@add("a32_weight_report", sql("SELECT origin, destination, round(passengers, 6) AS passengers, round(share, 6) AS share, round(share * (SELECT count(*) FROM shares) - 1, 6) + 0.0 AS vs_equal, months_observed, round(share, 6) AS current_weight FROM shares", FLOWS))
def a32_weight_report(spark, d):
    shares = weights.basket_shares(mapped(spark, d), basket(spark, d))
    return weights.weight_report(shares, shares.select("origin", "destination", F.col("share").alias("weight")))


@add("k6_weights_write_back", sql("""SELECT origin, destination, active, CASE WHEN active THEN round(share, 6) END AS weight, CASE WHEN active THEN 'passenger_share' END AS weight_basis, CASE WHEN active THEN 'order lines' END AS weight_source,
  CASE WHEN active THEN CAST((SELECT max(period) FROM flows) - INTERVAL 11 MONTH AS DATE)::VARCHAR END AS weight_start, CASE WHEN active THEN CAST((SELECT max(period) FROM flows) AS VARCHAR) END AS weight_end
  FROM (SELECT origin, destination, NOT missing AS active, passengers / sum(passengers) OVER () AS share FROM shares)""", FLOWS))
def k6_weights_write_back(spark, d):
    cells, b, store = flows(spark, d), basket(spark, d), Store(spark, shared_path(spark, "store"))
    traffic = mapped(spark, d, cells)
    known = weights.basket_shares(traffic, b).select("origin", "destination", (~F.col("missing")).alias("active"))
    known = known.withColumn("weight", F.lit(None).cast("double"))
    sinks.replace_routes(known, store)
    routes_ = store.read("routes", known.schema)
    in_use = weights.active(routes_)
    shares = weights.basket_shares(traffic, in_use)
    last = traffic.agg(F.max("period").alias("p")).select("p", F.add_months("p", -11).alias("first"), F.add_months("p", 2).alias("today")).first()
    gates = weights.load_gates(traffic, shares, weights.national_totals(cells), weights.unmapped_codes(in_use, tables.cities(spark, d)), str(last.today))
    new = weights.with_new_weights(routes_, shares, gates, "passenger_share", "order lines", str(last.first), str(last.p), "2024-02-01")
    sinks.replace_routes(new, store)  # derived from the version that it replaces
    return store.read("routes", new.schema).drop("weight_retrieved_at")


@add("m6_expenditure_shares", sql("""SELECT origin, destination, round(passengers * f / sum(passengers * f) OVER (), 6) AS share, 'expenditure_share' AS weight_basis FROM shares
  JOIN (SELECT origin, destination, avg(passengers) AS f FROM flows GROUP BY ALL) USING (origin, destination) WHERE NOT missing""", FLOWS))
def m6_expenditure_shares(spark, d):
    traffic = mapped(spark, d)
    fares = traffic.groupBy("origin", "destination").agg(F.avg("passengers").alias("avg_fare"))
    return weights.expenditure_shares(weights.basket_shares(traffic, basket(spark, d)), fares)


@add("s10_seed_routes", sql("""SELECT coalesce(a.origin, b.origin) AS origin, coalesce(a.destination, b.destination) AS destination, coalesce(b.cls, a.cls) AS stratum_class, round(a.share, 6) AS weight, a.origin IS NULL AS inserted
  FROM (SELECT *, 'old' AS cls FROM shares WHERE NOT missing) a FULL JOIN (SELECT origin, destination, 'metro' AS cls FROM basket WHERE origin < destination) b ON a.origin = b.origin AND a.destination = b.destination""", FLOWS))
def s10_seed_routes(spark, d):
    b = basket(spark, d)
    current = weights.basket_shares(mapped(spark, d), b).filter("not missing").select("origin", "destination", F.lit("old").alias("stratum_class"), F.col("share").alias("weight"))
    return weights.seeded(current, b.filter("origin < destination").withColumn("stratum_class", F.lit("metro")))


# --- health

GOOD = "good AS (SELECT DISTINCT source, day FROM runs WHERE status IN ('succeeded', 'partial'))"
MISSED = """missed AS (SELECT source, CAST(unnest(generate_series(first + INTERVAL 1 DAY, DATE '2024-01-29', INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT source, min(day) AS first FROM good WHERE day < DATE '2024-01-30' GROUP BY source)
  WHERE first < DATE '2024-01-29' EXCEPT SELECT source, day FROM good)"""
HEALTH = """health AS (SELECT source, max(day) FILTER (status <> 'failed') AS last_success, bool_or(status <> 'failed' AND day = DATE '2024-01-30') AS collected_today, count(*) FILTER (status = 'failed' AND day = DATE '2024-01-30') AS failures_today,
  coalesce((SELECT count(*) FROM missed m WHERE m.source = runs.source), 0) AS n_missed FROM runs GROUP BY source),
verdict AS (SELECT *, NOT collected_today AND (last_success IS NULL OR last_success < DATE '2024-01-29') AS stale FROM health)"""


@add("s11_look_back", sql("SELECT run_id FROM runs WHERE day >= DATE '2024-01-23'", RUNS))
def s11_look_back(spark, d):
    return health.look_back(tables.runs(spark, d), TODAY, 7).select("run_id")


@add("a23_run_status", sql("SELECT CASE WHEN event_type = 'error' THEN 'failed' WHEN selector_relocated OR CAST(substr(run_id, 4) AS BIGINT) % 3 > 0 THEN 'partial' ELSE 'succeeded' END AS run_status, count(*) AS n FROM runs GROUP BY ALL", RUNS))
def a23_run_status(spark, d):
    r = tables.runs(spark, d)
    return r.groupBy(health.run_status(F.col("notes"), F.col("selector_relocated"), F.substring("run_id", 4, 20).cast("long") % 3).alias("run_status")).agg(F.count("*").alias("n"))


@add("a24_t4_decisions", sql("""SELECT source, CAST(day AS VARCHAR) AS day, count(*) AS attempts, NOT bool_or(status <> 'failed') AND count(*) < 3 AS fetch,
  CASE WHEN bool_or(status <> 'failed') THEN 'already collected' WHEN count(*) >= 3 THEN 'attempts used up' ELSE 'may try' END AS reason FROM runs GROUP BY source, day""", RUNS))
def a24_t4_decisions(spark, d):
    return health.decisions(tables.runs(spark, d))


@add("j12_missed_days", sql("SELECT source, CAST(day AS VARCHAR) AS day FROM missed", RUNS, GOOD, MISSED))
def j12_missed_days(spark, d):
    return health.missed_days(tables.runs(spark, d), TODAY)


@add("w4_missed_spans", sql("""SELECT source, CAST(sum(n) AS BIGINT) AS n_days, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE CAST(a AS VARCHAR) || ' to ' || CAST(b AS VARCHAR) END, ', ' ORDER BY a) AS text FROM
  (SELECT source, min(day) AS a, max(day) AS b, count(*) AS n FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY source ORDER BY day) AS INTEGER) AS g FROM missed) GROUP BY source, g) GROUP BY source""", RUNS, GOOD, MISSED))
def w4_missed_spans(spark, d):
    return health.spans(health.missed_days(tables.runs(spark, d), TODAY))


@add("a25_source_health", sql("SELECT source, CAST(last_success AS VARCHAR) AS last_success, collected_today, failures_today, n_missed, stale FROM verdict", RUNS, GOOD, MISSED, HEALTH))
def a25_source_health(spark, d):
    return health.source_health(tables.runs(spark, d), TODAY)


@add("a31_verdicts", sql("SELECT source, CASE WHEN source % 50 = 0 THEN 'TRIPWIRE' WHEN stale THEN 'STALE' WHEN collected_today THEN 'OK' ELSE 'PENDING' END AS verdict FROM verdict", RUNS, GOOD, MISSED, HEALTH))
def a31_verdicts(spark, d):
    r = tables.runs(spark, d)
    return health.verdicts(health.source_health(r, TODAY), r.select("source", (F.col("source") % 50 == 0).alias("tripwire")).distinct())


@add("a26_alerts", sql("""SELECT run_id, source, CAST(day AS VARCHAR) AS day, alert, CASE WHEN alert = 'gap_ended' THEN gap END AS gap_days FROM (SELECT r.run_id, r.source, r.day, g.gap,
  CASE WHEN r.status <> 'failed' AND g.gap > 0 THEN 'gap_ended' WHEN r.status = 'failed' AND r.attempt = 3 THEN 'gave_up' END AS alert
  FROM (SELECT *, row_number() OVER w AS attempt, coalesce(bool_or(status <> 'failed') OVER (PARTITION BY source, day ORDER BY started_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS earlier FROM runs WINDOW w AS (PARTITION BY source, day ORDER BY started_at, run_id)) r
  LEFT JOIN (SELECT source, day, day - lag(day) OVER (PARTITION BY source ORDER BY day) - 1 AS gap FROM good) g USING (source, day) WHERE NOT earlier) WHERE alert IS NOT NULL""", RUNS, GOOD))
def a26_alerts(spark, d):
    return health.alerts(tables.runs(spark, d))


@add("a27_overdue", sql("SELECT count(*) AS n_overdue, CAST(min(day) AS VARCHAR) AS oldest FROM runs WHERE pending AND day < DATE '2024-01-30'", RUNS))
def a27_overdue(spark, d):
    return health.overdue(tables.runs(spark, d), TODAY)


@add("a28_last_success", sql("SELECT source, CAST(max(day) FILTER (status <> 'failed' AND day < DATE '2024-01-30') AS VARCHAR) AS last_success FROM runs GROUP BY source", RUNS))
def a28_last_success(spark, d):
    return health.last_success_before(tables.runs(spark, d), TODAY)


@add("m9_yield_monitor", sql("""SELECT source, CAST(day AS VARCHAR) AS day, n, round(before, 6) AS "trailing" FROM (SELECT *, avg(n) OVER (PARTITION BY source ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS before
  FROM (SELECT source, day, count(*) AS n FROM runs GROUP BY ALL)) WHERE n < 0.5 * before""", RUNS))
def m9_yield_monitor(spark, d):
    return health.yield_monitor(tables.runs(spark, d).groupBy("source", "day").agg(F.count("*").alias("n")))


# --- normalisation


@add("s6_w3_sections", r"""SELECT doc_id, line_no, md5(line) AS line_md5, last_value(CASE WHEN length(line) < 40 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
  FROM (SELECT doc_id, i - 1 AS line_no, trim(parts[i], ' ') AS line FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))) WHERE line <> ''""")
def s6_w3_sections(spark, d):
    df = normalise.lines(tables.read(spark, d, "documents"))
    df = normalise.carried_section(df, F.when(F.length("line") < 40, F.col("line")))
    return df.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.md5("line").alias("line_md5"), "section")


TARIFF = """filed AS (SELECT a.n_nationkey AS doc_id, b.n_nationkey AS line_no, a.n_name AS origin, b.n_name AS destination, CAST(count(*) AS INTEGER) AS distance, CAST(round(min(l_extendedprice)) AS BIGINT) AS level1, CAST(round(max(l_extendedprice)) AS BIGINT) AS level2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON s_nationkey = a.n_nationkey JOIN customer ON o_custkey = c_custkey JOIN nation b ON c_nationkey = b.n_nationkey GROUP BY ALL)"""


def filed(spark, d):
    """One tariff sheet per supplier nation, a fare row per customer nation, from the order lines between them."""
    n = tables.read(spark, d, "nation")
    by = tables.order_lines(spark, d, "l_extendedprice").groupBy("s_nation", "c_nation").agg(F.count("*").alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))
    ends = [n.select(F.col("n_nationkey").alias(k), F.col("n_name").alias(c)) for k, c in (("s_nation", "origin"), ("c_nation", "destination"))]
    whole = lambda c: F.round(c).cast("long").alias
    fares = by.join(ends[0], "s_nation").join(ends[1], "c_nation").groupBy(F.col("s_nation").alias("doc_id"), F.col("c_nation").alias("line_no"), "origin", "destination").agg(F.sum("n").cast("int").alias("distance"), whole(F.min("lo"))("level1"), whole(F.max("hi"))("level2"))
    return stored(fares, "filed")  # read more than once, and short


def sheet(spark, d):
    """The sheets as text: an economy section with a sub-heading, then a premium one that must not be read."""
    row = F.concat_ws(" ", (F.col("line_no") + 1).cast("string"), "origin", F.concat(F.col("destination"), F.lit(" "), F.col("distance").cast("string")), F.when(F.col("line_no") % 6 == 5, "Maximum").otherwise("Minimum"), F.when(F.col("line_no") % 4 == 3, "NA").otherwise(F.col("level1").cast("string")), F.col("level2").cast("string"))
    rows = filed(spark, d).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", row.alias("row")))), lambda x: x["row"]), "\n").alias("rows"))
    return rows.select("doc_id", F.concat(F.lit("Cover page\nEconomy Base Fare (one way)\nDOMESTIC FARES\n"), "rows", F.lit("\nPREMIUM ECONOMY\n"), "rows").alias("text"))


def sheet_rows(spark, d):
    names = tables.read(spark, d, "nation").select(F.col("n_name").alias("city"))
    return normalise.tariff_rows(normalise.lines(sheet(spark, d)), names)


@add("f8_f9_f14_tariff_rows", sql("""SELECT doc_id, origin, destination, distance, CASE WHEN line_no % 6 = 5 THEN 'Maximum' ELSE 'Minimum' END AS band_type, CASE WHEN line_no % 4 <> 3 THEN CAST(level1 AS DOUBLE) END AS level1, CAST(level2 AS DOUBLE) AS level2, false AS skipped FROM filed""", TARIFF))
def f8_f9_f14_tariff_rows(spark, d):
    r = sheet_rows(spark, d)
    return r.select("doc_id", "origin", "destination", "distance", "band_type", F.get("fares", F.lit(0)).alias("level1"), F.get("fares", F.lit(1)).alias("level2"), "skipped")


@add("p13_a19_lowest_filed", sql("SELECT doc_id, origin, destination, CAST(CASE WHEN line_no % 4 = 3 THEN level2 ELSE level1 END AS DOUBLE) AS fare FROM filed WHERE line_no % 6 <> 5", TARIFF))
def p13_a19_lowest_filed(spark, d):
    return normalise.lowest_filed(sheet_rows(spark, d))


@add("q11_fare_ladder", sql("SELECT doc_id, origin, destination, CASE WHEN line_no % 6 = 5 THEN 'Maximum' ELSE 'Minimum' END AS band_type, level, CAST(fare AS DOUBLE) AS fare FROM (SELECT *, 1 AS level, CASE WHEN line_no % 4 <> 3 THEN level1 END AS fare FROM filed UNION ALL SELECT *, 2, level2 FROM filed) WHERE fare IS NOT NULL", TARIFF))
def q11_fare_ladder(spark, d):
    return normalise.fare_ladder(sheet_rows(spark, d)).select("doc_id", "origin", "destination", "band_type", F.col("level").cast("int").alias("level"), "fare")


@add("f8_pair_rows", sql("SELECT doc_id, 'ONE WAY ECONOMY FARES' AS section, origin, destination, distance, CAST(level1 AS DOUBLE) AS level1 FROM filed", TARIFF))
def f8_pair_rows(spark, d):
    row = F.concat(F.col("origin"), F.lit(" − "), F.col("destination"), F.lit(" Minimum "), F.col("distance").cast("string"), F.lit(" "), F.col("level1").cast("string"), F.lit(" NA"))
    text = filed(spark, d).groupBy("doc_id").agg(F.array_join(F.collect_list(row), "\n").alias("rows")).select("doc_id", F.concat(F.lit("ONE WAY ECONOMY FARES\nRoute FARES 1 2\n"), "rows").alias("text"))
    return normalise.pair_rows(normalise.lines(text)).select("doc_id", "section", "origin", "destination", "distance", F.get("fares", F.lit(0)).alias("level1"))


def charge_cells(spark, d):
    """A charge schedule as cell rows, one document a part type: fees from part prices, fuel bands from part sizes."""
    p = tables.read(spark, d, "part")
    k, price = F.col("p_partkey"), F.concat(F.lit("INR "), F.format_number("p_retailprice", 2))
    label = F.when(k % 7 == 0, "ASF").when(k % 7 == 1, "CUTE").when(k % 7 == 2, "RCS").when(k % 7 == 3, "PSF").otherwise("")
    frm = F.when(k % 7 == 4, F.concat(F.lit("City "), k.cast("string"))).otherwise("All")
    to = F.when(k % 7 == 5, F.concat(F.lit("C"), k.cast("string"), F.lit("*"))).otherwise("All")
    band = F.when(k % 3 == 0, F.concat(F.lit("Less than "), F.col("p_size").cast("string"))).when(k % 3 == 1, F.concat(F.col("p_size").cast("string"), F.lit(" - "), (F.col("p_size") + 100).cast("string"))).otherwise(F.concat(F.col("p_size").cast("string"), F.lit("+")))
    cells = F.when(k % 7 == 6, F.array(band, price)).otherwise(F.array(label, F.lit(""), frm, to, F.when(k % 11 == 0, "NA").otherwise(price)))
    return p.select(F.col("p_type").alias("doc_id"), k.alias("row_no"), cells.alias("cells"))


CHARGES = """charges AS (SELECT p_type AS doc_id, p_partkey AS row_no, CASE p_partkey % 7 WHEN 0 THEN 'asf' WHEN 1 THEN 'cute' WHEN 2 THEN 'rcs' WHEN 4 THEN 'departure' WHEN 5 THEN 'arrival' WHEN 6 THEN 'fuel' END AS kind,
  CASE p_partkey % 7 WHEN 4 THEN 'City ' || p_partkey WHEN 5 THEN 'C' || p_partkey END AS key, CASE WHEN p_partkey % 7 = 6 THEN CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_size END END AS lo,
  CASE WHEN p_partkey % 7 = 6 THEN CASE p_partkey % 3 WHEN 0 THEN p_size - 1 WHEN 1 THEN p_size + 100 END END AS hi, round(p_retailprice, 2) AS amount FROM part WHERE p_partkey % 7 <> 3 AND (p_partkey % 7 = 6 OR p_partkey % 11 <> 0))"""


@add("s7_f10_f11_f12_charge_rows", sql("SELECT doc_id, row_no, kind, key, lo, hi, amount FROM charges", CHARGES))
def s7_f10_f11_f12_charge_rows(spark, d):
    return normalise.charge_rows(charge_cells(spark, d))


@add("a29_a30_schedule_report", sql("SELECT doc_id, count(*) FILTER (kind = 'departure') AS n_departure, bool_or(kind = 'asf') AND bool_or(kind = 'rcs') AND bool_or(kind = 'cute') AS complete, count(*) FILTER (kind = 'departure') < 20 AS collapsed FROM charges GROUP BY doc_id", CHARGES))
def a29_a30_schedule_report(spark, d):
    return normalise.schedule_report(normalise.charge_rows(charge_cells(spark, d)))


BANDS = [(0, 499, 299.0), (501, 1000, 399.0), (1001, None, 549.0)]


@add("j6_fuel_bands", "SELECT l_linenumber, count(*) AS n, count(yq) AS in_band, CAST(sum(yq) AS DOUBLE) AS charges FROM (SELECT l_linenumber, CASE WHEN l_suppkey % 1500 <= 499 THEN 299 WHEN l_suppkey % 1500 BETWEEN 501 AND 1000 THEN 399 WHEN l_suppkey % 1500 >= 1001 THEN 549 END AS yq FROM (SELECT l_linenumber, CAST(l_partkey * 7 + l_suppkey AS BIGINT) AS l_suppkey FROM lineitem)) GROUP BY ALL")
def j6_fuel_bands(spark, d):
    bands = spark.createDataFrame(BANDS, "lo int, hi int, amount double")
    li = tables.read(spark, d, "lineitem").select("l_linenumber", ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 1500).alias("distance"))
    return normalise.in_band(li, bands).groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count("carrier_charges").alias("in_band"), F.sum("carrier_charges").alias("charges"))


@add("f3_f5_j6_j7_j8_j9_quotes", sql("""SELECT doc_id, w.origin, w.destination, CAST(DATE '2024-02-04' + CAST(doc_id AS INTEGER) AS VARCHAR) AS departure_date, 30 AS advance_purchase_days, CAST(w.level1 AS DOUBLE) AS base_fare, CAST(udf AS DOUBLE) AS udf, 236.0::DOUBLE AS asf, 170.0::DOUBLE AS rcs_levy,
  CAST(yq AS DOUBLE) AS carrier_charges, CAST(gst AS DOUBLE) AS gst, CAST(w.level1 + udf + 406 + yq + gst AS DOUBLE) AS total_fare FROM
  (SELECT *, round((level1 + udf + 406) * 0.05, 2) AS gst FROM (SELECT x.*, (CASE WHEN o.n_nationkey % 3 = 0 THEN 152 ELSE 0 END + CASE WHEN e.n_nationkey % 5 = 0 THEN 75 ELSE 0 END) AS udf,
    CASE WHEN distance % 1500 <= 499 THEN 299 WHEN distance % 1500 BETWEEN 501 AND 1000 THEN 399 WHEN distance % 1500 >= 1001 THEN 549 END AS yq FROM
    (SELECT doc_id, origin, destination, level1, distance * 7 + line_no AS distance FROM filed WHERE line_no > doc_id UNION ALL SELECT doc_id, destination, origin, level1, distance * 7 + line_no FROM filed WHERE line_no > doc_id) x
    JOIN nation o ON o.n_name = x.origin JOIN nation e ON e.n_name = x.destination) WHERE doc_id % 4 <> 3 AND yq IS NOT NULL) w""", TARIFF))
def f3_f5_j6_j7_j8_j9_quotes(spark, d):
    """Each sheet's routes in both directions with all charges; every fourth sheet lacks a flat charge and gives no quote."""
    money = lambda x: F.lit(x).cast("decimal(10,2)")
    f = filed(spark, d).filter("line_no > doc_id").select("doc_id", "origin", "destination", ((F.col("distance") * 7 + F.col("line_no")) % 1500).alias("distance"), F.col("level1").cast("decimal(10,2)").alias("base_fare"))
    f = normalise.unordered_match(f.select("origin", "destination"), f)
    f = f.withColumn("collection_ts", F.date_add(F.lit("2024-01-05").cast("date"), F.col("doc_id").cast("int")).cast("timestamp"))
    n = tables.read(spark, d, "nation")
    kinds = F.explode(F.when(F.col("n_nationkey") % 4 == 3, F.array(F.lit("asf"), F.lit("rcs"))).otherwise(F.array(F.lit("asf"), F.lit("rcs"), F.lit("cute"))))
    charges = n.select(F.col("n_nationkey").alias("doc_id"), kinds.alias("kind")).withColumn("amount", F.when(F.col("kind") == "asf", money(236)).when(F.col("kind") == "rcs", money(10)).otherwise(money(160)))
    bands = spark.createDataFrame(BANDS, "lo int, hi int, amount double").withColumn("amount", F.col("amount").cast("decimal(10,2)"))
    dep, arr = n.filter("n_nationkey % 3 = 0").select(F.col("n_name").alias("city"), money(152).alias("fee")), n.filter("n_nationkey % 5 = 0").select(F.col("n_name").alias("code"), money(75).alias("fee"))
    q = normalise.fare_quotes(f, normalise.flat_charges(charges), bands, dep, arr)
    return q.select("doc_id", "origin", "destination", "departure_date", "advance_purchase_days", "base_fare", "udf", "asf", "rcs_levy", "carrier_charges", "gst", "total_fare")


DAYS = ("2024-01-10", "2024-01-17", "2024-02-25")
SHEETS = """sheets AS (SELECT * FROM (VALUES (0, DATE '2024-01-10', 0, 152, 75, 236), (1, DATE '2024-01-17', 50, 200, 90, 250), (1, DATE '2024-02-25', 50, 200, 90, 250)) t(v, day, more, dep, arr, asf)),
way AS (SELECT doc_id, origin, destination, level1, level2, (distance * 7 + line_no) % 1500 AS distance FROM filed WHERE line_no > doc_id UNION ALL SELECT doc_id, destination, origin, level1, level2, (distance * 7 + line_no) % 1500 FROM filed WHERE line_no > doc_id),
priced AS (SELECT w.*, v, day, CASE WHEN v = 0 THEN level1 ELSE level2 END AS base, (CASE WHEN o.n_nationkey % 3 = 0 THEN dep ELSE 0 END + CASE WHEN e.n_nationkey % 5 = 0 THEN arr ELSE 0 END) AS udf, asf,
  CASE WHEN distance <= 499 THEN 299 WHEN distance BETWEEN 501 AND 1000 THEN 399 WHEN distance >= 1001 THEN 549 END + more AS yq FROM way w, sheets JOIN nation o ON o.n_name = w.origin JOIN nation e ON e.n_name = w.destination)"""


@add("f3_j7_sheets_on_the_day", sql("""SELECT doc_id * 2 + v AS doc_id, CAST(day AS VARCHAR) AS day, origin, destination, CAST(base AS DOUBLE) AS base_fare, CAST(udf AS DOUBLE) AS udf, CAST(asf AS DOUBLE) AS asf, CAST(yq AS DOUBLE) AS carrier_charges,
  CAST(base + udf + asf + 170 + yq + round((base + udf + asf + 170) * 0.05, 2) AS DOUBLE) AS total_fare FROM priced WHERE yq IS NOT NULL AND (v = 1 OR doc_id % 4 <> 3)""", TARIFF, SHEETS))
def f3_j7_sheets_on_the_day(spark, d):
    """Two sheets a carrier, the second valid before the first one ends: each route has one quote per direction and day, priced by
    the bands and fees of the sheet that counts."""
    money = lambda x: F.lit(x).cast("decimal(10,2)")
    n = tables.read(spark, d, "nation")
    v = F.explode(F.array(F.lit(0), F.lit(1))).alias("v")
    second = F.col("v") == 1
    docs = n.select(F.col("n_nationkey").alias("carrier"), v).withColumn("doc_id", F.col("carrier") * 2 + F.col("v"))
    sheets = docs.select("doc_id", "carrier", F.when(second, "2024-01-14").otherwise("2023-12-30").cast("timestamp").alias("issued"), F.when(second, "2024-01-15").otherwise("2024-01-01").cast("date").alias("valid_from"), F.when(~second, "2024-01-20").cast("date").alias("valid_until"))
    days = n.select(F.col("n_nationkey").alias("carrier"), F.explode(F.array(*[F.lit(x).cast("date") for x in DAYS])).alias("day"))
    f = filed(spark, d).filter("line_no > doc_id").withColumnRenamed("doc_id", "carrier").select("carrier", "origin", "destination", ((F.col("distance") * 7 + F.col("line_no")) % 1500).alias("distance"), "level1", "level2")
    f = f.join(normalise.sheets_on(days, sheets), "carrier").withColumn("base_fare", F.when(F.col("doc_id") % 2 == 0, F.col("level1")).otherwise(F.col("level2")).cast("decimal(10,2)")).withColumn("collection_ts", F.col("day").cast("timestamp"))
    kinds = F.explode(F.when((F.col("carrier") % 4 == 3) & ~second, F.array(F.lit("asf"), F.lit("rcs"))).otherwise(F.array(F.lit("asf"), F.lit("rcs"), F.lit("cute"))))
    charges = docs.select("doc_id", "v", kinds.alias("kind")).withColumn("amount", F.when(F.col("kind") == "asf", F.when(second, money(250)).otherwise(money(236))).when(F.col("kind") == "rcs", money(10)).otherwise(money(160)))
    bands = docs.crossJoin(F.broadcast(spark.createDataFrame(BANDS, "lo int, hi int, amount double"))).select("doc_id", "lo", "hi", (F.col("amount") + 50 * F.col("v")).cast("decimal(10,2)").alias("amount"))
    places = n.select("n_nationkey", "n_name")
    dep = docs.crossJoin(F.broadcast(places.filter("n_nationkey % 3 = 0"))).select("doc_id", F.col("n_name").alias("city"), F.when(second, money(200)).otherwise(money(152)).alias("fee"))  # a nation list is short
    arr = docs.crossJoin(F.broadcast(places.filter("n_nationkey % 5 = 0"))).select("doc_id", F.col("n_name").alias("code"), F.when(second, money(90)).otherwise(money(75)).alias("fee"))
    q = normalise.fare_quotes(f, normalise.flat_charges(charges), bands, dep, arr)
    return q.select("doc_id", F.to_date("collection_ts").alias("day"), "origin", "destination", "base_fare", "udf", "asf", "carrier_charges", "total_fare")


@add("f2_gst", "SELECT l_linenumber, count(*) AS n, CAST(sum(gst) AS DOUBLE) AS gst FROM (SELECT l_linenumber, round((CAST(l_extendedprice AS DECIMAL(12, 2)) + 558) * 0.05, 2) AS gst FROM lineitem) GROUP BY ALL")
def f2_gst(spark, d):
    c = lambda x: F.lit(x).cast("decimal(12,2)")
    gst, _ = normalise.gst_and_total(F.col("l_extendedprice").cast("decimal(12,2)"), c(152), c(236), c(170), c(0))
    return tables.read(spark, d, "lineitem").select("l_linenumber", gst.alias("gst")).groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("gst").alias("gst"))


PAGE_EVENTS = 20_000  # the page number grows with the events, so a page does not


def offer_pages(spark, d):
    """Offer pages of a route and day, each with the state blob of at most PAGE_EVENTS events; every tenth day's lack the blob."""
    e = tables.read(spark, d, "events")
    k = F.col("event_id")
    o, t = F.concat(F.lit("R"), (F.col("user_id") % 9).cast("string"), F.lit("A")), F.when(k % 6 == 0, "NMI").otherwise("HUB")
    dep = F.date_format(F.date_add(F.to_date("ts"), (k % 40).cast("int")), "yyyy-MM-dd")
    leg = F.concat_ws("$", o, t, F.concat(dep, F.lit(" 07:10")), F.concat(F.upper(F.substring("event_type", 1, 2)), F.lit("-7")))
    key = F.when(k % 4 == 0, F.concat_ws("|", leg, leg)).otherwise(leg)
    item = F.struct(F.lit("<b>Base Fare</b>").alias("text"), F.concat(F.lit("<i>₹"), F.format_number(F.col("value") * 0.8, 2), F.lit("</i>")).alias("amount"))
    journey = F.struct(F.col("value").alias("fare"), F.when(k % 3 == 0, F.array(F.lit("6E"))).alias("airlineCodes"), F.array(key).alias("journeyKeys"), F.struct(F.array(item).alias("fareBreakUpItems")).alias("fareBreakup"))
    page = F.floor(k / PAGE_EVENTS)
    by = e.select(o.alias("origin"), F.to_date("ts").alias("day"), page.alias("page"), k.alias("k"), journey.alias("j")).groupBy("origin", "day", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", F.to_json("j").alias("j")))), lambda x: x["j"]).alias("js"))
    blob = F.concat(F.lit('{"allJourneys":[['), F.array_join("js", ","), F.lit("]]}"))
    script = F.when(F.dayofmonth("day") % 10 == 0, F.lit("<script>track(1)</script>")).otherwise(F.concat(F.lit('<script id="state" type="application/json">'), blob, F.lit("</script>")))
    return by.select(F.concat_ws("/", "origin", F.col("day").cast("string"), F.col("page").cast("string")).alias("page_id"), "origin", F.lit("HUB").alias("destination"), F.col("day").cast("timestamp").alias("collection_ts"), F.concat(F.lit("<html>"), script, F.lit("</html>")).alias("html"))


OFFERS = """offer AS (SELECT 'R' || (user_id % 9) || 'A' AS origin, CAST(ts AS DATE) AS day, event_id // 20000 AS page, event_id AS k, value AS fare, event_id % 4 = 0 AS conn, event_id % 4 <> 0 AND event_id % 6 = 0 AS other,
  CASE WHEN event_id % 3 = 0 THEN '6E' ELSE upper(substr(event_type, 1, 2)) END AS carrier, CAST(event_id % 40 AS INTEGER) AS lead FROM events),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY origin, day, page ORDER BY fare, k) AS rn FROM offer WHERE NOT conn AND NOT other AND fare > 0) WHERE rn = 1)"""


@add("s5_f15_f18_a20_a21_offers", sql("""SELECT p.origin || '/' || CAST(p.day AS VARCHAR) || '/' || p.page AS page_id, CASE WHEN ok THEN round(b.fare, 6) END AS fare, CASE WHEN ok THEN b.carrier END AS carrier, CASE WHEN ok THEN b.lead END AS lead_days,
  CASE WHEN ok THEN n ELSE 0 END AS n_journeys, CASE WHEN ok THEN c ELSE 0 END AS connections, CASE WHEN ok THEN o ELSE 0 END AS other_airports, CASE WHEN NOT ok THEN 'shape_error' WHEN b.fare IS NULL THEN 'no_nonstop' END AS reason
  FROM (SELECT origin, day, page, day(day) % 10 <> 0 AS ok, count(*) AS n, count(*) FILTER (conn) AS c, count(*) FILTER (other) AS o FROM offer GROUP BY ALL) p LEFT JOIN best b ON b.origin = p.origin AND b.day = p.day AND b.page = p.page""", OFFERS))
def s5_f15_f18_a20_a21_offers(spark, d):
    r = normalise.cheapest_offers(normalise.journeys(offer_pages(spark, d)))
    return r.select("page_id", "fare", "carrier", "lead_days", "n_journeys", "connections", "other_airports", "reason")


@add("f16_offer_base_fares", sql("SELECT origin, count(*) AS n, round(sum(round(fare * 0.8, 2)), 2) AS base_fares FROM offer WHERE day(day) % 10 <> 0 GROUP BY ALL", OFFERS))
def f16_offer_base_fares(spark, d):
    j = normalise.journeys(offer_pages(spark, d)).filter("not shape_error")
    return j.groupBy("origin").agg(F.count("*").alias("n"), F.sum("base_fare").alias("base_fares"))


@add("f17_f20_page_state", r"""SELECT page_id, sha256(html) AS hash, TRY_CAST(regexp_extract(html, 'track\(([0-9]+)\)', 1) AS BIGINT) AS track FROM pages""")
def f17_f20_page_state(spark, d):
    state = normalise.page_state(tables.read(spark, d, "pages"), r"track\(([0-9]+)\)")
    return state.select("page_id", "hash", F.col("state").try_cast("long").alias("track"))


@add("f5_f19_document_dates", r"""SELECT o_orderkey, CASE WHEN k % 9 <> 0 THEN strftime(day + INTERVAL 15 HOUR + INTERVAL 29 MINUTE + INTERVAL 2 SECOND, '%Y-%m-%d %H:%M:%S') END AS issued,
  strftime(day + INTERVAL 390 MINUTE - CASE k % 3 WHEN 0 THEN INTERVAL 330 MINUTE WHEN 1 THEN -INTERVAL 210 MINUTE ELSE INTERVAL 0 MINUTE END, '%Y-%m-%d %H:%M:%S') AS created,
  CASE WHEN k % 7 <> 0 THEN CAST(CAST(day AS DATE) + CAST(k % 90 AS INTEGER) AS VARCHAR) END AS valid_until, CASE WHEN k % 9 <> 0 THEN k % 160 - 1 > 75 END AS aged, CASE WHEN k % 7 <> 0 THEN k % 160 > k % 90 END AS expired,
  CAST(CAST(day AS DATE) + CAST(k % 160 AS INTEGER) + 30 AS VARCHAR) AS departure FROM (SELECT DISTINCT o_orderkey, o_orderkey AS k, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day FROM orders)""")
def f5_f19_document_dates(spark, d):
    k, day = F.col("o_orderkey"), F.col("day")
    o = tables.read(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")).distinct()
    issued = F.when(k % 9 != 0, F.concat(F.translate(day.cast("string"), "-", "\u2212"), F.lit(" 15:29:02.126928"))).otherwise("2024\u221213\u221299 15:29:02")
    offset = F.when(k % 3 == 0, "+05'30'").when(k % 3 == 1, "-03'30'").otherwise("+00'00'")
    until = F.date_add("day", (k % 90).cast("int"))
    till = F.concat(F.dayofmonth(until).cast("string"), F.lit("th "), F.date_format(until, "MMMM yyyy"))
    text = F.concat(issued, F.lit("\nD:"), F.date_format("day", "yyyyMMdd"), F.lit("063000"), offset, F.lit("\nFares for the period W.I.E. till "), F.when(k % 7 != 0, till).otherwise("further notice"))
    docs = o.select("o_orderkey", text.alias("text"), (F.date_add("day", (k % 160).cast("int")).cast("timestamp") + F.make_dt_interval(hours=F.lit(10))).alias("collection_ts"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return normalise.document_dates(docs).select("o_orderkey", stamp("issued"), stamp("created"), "valid_until", "aged", "expired", normalise.anchor_departure(F.col("collection_ts")).alias("departure"))


# --- read side


def values(spark, d):
    s = run_of(spark, d).series()
    first = s.withColumn("vintage_id", F.lit("v1")).withColumn("published_at", F.lit("2024-02-01").cast("timestamp")).withColumn("value", F.col("value") - 1)
    second = s.filter("period >= date'2024-01-10'").withColumn("vintage_id", F.lit("v2")).withColumn("published_at", F.lit("2024-02-02").cast("timestamp"))
    return first.unionByName(second)


@add("q1_index", sql("SELECT CAST(period AS VARCHAR) AS period, round(CASE WHEN period >= DATE '2024-01-10' THEN value ELSE value - 1 END, 6) AS value, CASE WHEN period >= DATE '2024-01-10' THEN 'v2' ELSE 'v1' END AS vintage_id FROM series WHERE series_id = 'composite' AND period BETWEEN DATE '2024-01-06' AND DATE '2024-01-20'", *RUN, STACK))
def q1_index(spark, d):
    return reads.index(values(spark, d), "composite", "daily", "2024-01-06", "2024-01-20").select("period", "value", "vintage_id")


@add("q2_w6_index_latest", sql("SELECT series_id, CAST(period AS VARCHAR) AS period, round(value, 6) AS value, round(coverage, 6) AS coverage, suppressed FROM series WHERE series_id = 'window.T7' ORDER BY series.period DESC LIMIT 1", *RUN, STACK))
def q2_w6_index_latest(spark, d):
    return reads.index_latest(values(spark, d), "window.T7")


@add("q3_routes", sql("SELECT route_id, 'R0' || route_id AS origin, 'HUB' AS destination, CASE WHEN route_id % 2 = 0 THEN 'metro' ELSE 'regional' END AS stratum_class, CASE WHEN route_id <> 2 THEN round(weight, 6) END AS weight FROM routes WHERE route_id % 4 <> 3", QUOTES, ROUTE))
def q3_routes(spark, d):
    return reads.routes(route_table(spark, d))


@add("q4_o2_quotes", sql("SELECT quote_id, carrier, CAST(period AS VARCHAR) AS period, round(total_fare, 6) AS total_fare FROM quotes WHERE route_id = 1 AND carrier = 'view' AND period BETWEEN DATE '2024-01-03' AND DATE '2024-01-28' ORDER BY collection_ts DESC, quote_id DESC LIMIT 100", QUOTES))
def q4_o2_quotes(spark, d):
    return reads.quotes(tables.quotes(spark, d), 1, "view", "2024-01-03", "2024-01-28").select("quote_id", "carrier", "period", "total_fare")


@add("q5_coverage", sql("SELECT route_id, apd, count(*) AS days, round(avg(coverage), 6) AS mean_coverage, count(*) FILTER (suppressed) AS days_suppressed FROM panel GROUP BY ALL", *RUN[:6]))
def q5_coverage(spark, d):
    return reads.coverage(run_of(spark, d).panel)


@add("q7_heatmap", sql("SELECT route_id, CAST(period AS VARCHAR) AS period, round(exp(avg(ln(jevons))), 6) AS relative FROM panel GROUP BY ALL", *RUN[:6]))
def q7_heatmap(spark, d):
    return reads.heatmap(run_of(spark, d).panel)


@add("q8_lead_time_curve", sql("SELECT route_id, apd, round(quantile_cont(price, 0.25), 6) AS p25, round(quantile_cont(price, 0.5), 6) AS median, round(quantile_cont(price, 0.75), 6) AS p75, count(*) AS n FROM obs GROUP BY ALL", QUOTES, OBS))
def q8_lead_time_curve(spark, d):
    return reads.lead_time_curve(run_of(spark, d).obs)


@add("q9_carrier_dispersion", sql("SELECT route_id, CAST(period AS VARCHAR) AS period, round(stddev_samp(ln(price)), 6) AS sd_log, round(max(price) / min(price), 6) AS max_over_min, count(DISTINCT carrier) AS carriers FROM obs GROUP BY ALL", QUOTES, OBS))
def q9_carrier_dispersion(spark, d):
    return reads.carrier_dispersion(run_of(spark, d).obs)


@add("q10_quality_panel", sql("""SELECT source, CAST(q.period AS VARCHAR) AS period, count(*) FILTER (observation_status = 'observed') AS observed, 0 AS no_service, count(*) FILTER (observation_status = 'collection_failed') AS collection_failed, 0 AS imputed,
  round(count(*) FILTER (observation_status = 'observed') / count(*), 6) AS yield, round(any_value(c.coverage), 6) AS coverage, coalesce(any_value(c.suppressed), 0) AS suppressed
  FROM quotes q LEFT JOIN (SELECT period, avg(coverage) AS coverage, count(*) FILTER (suppressed) AS suppressed FROM panel GROUP BY period) c ON c.period = q.period GROUP BY source, q.period""", *RUN[:6]))
def q10_quality_panel(spark, d):
    return reads.quality_panel(tables.quotes(spark, d), run_of(spark, d).panel)


@add("q12_audit_trail", sql("""SELECT 'v1' AS vintage_id, 'hash' AS config_hash, CAST(c.period AS VARCHAR) AS period, round(c.value, 6) AS value, p.route_id, p.apd, round(p.jevons, 6) AS jevons, run_id, sha256(run_id) AS raw_payload_hash, count(run_id) AS n_quotes
  FROM comp c JOIN panel p USING (period) LEFT JOIN quotes q ON q.period = p.period AND q.route_id = p.route_id AND q.apd = p.apd AND observation_status = 'observed' AND exclusion_reason IS NULL AND total_fare > 0 AND (fare_class IS NULL OR fare_class NOT IN ('filed_floor', 'filed_base', 'uncontrolled_lead'))
  GROUP BY c.period, c.value, p.route_id, p.apd, p.jevons, run_id""", *RUN))
def q12_audit_trail(spark, d):
    run = run_of(spark, d)
    values = run.composite.select(F.lit("v1").alias("vintage_id"), F.lit("hash").alias("config_hash"), "period", "value")
    return reads.audit_trail(values, run.panel, tables.quotes(spark, d).withColumn("raw_payload_hash", F.sha2("run_id", 256)))


PARAMS = """p AS (SELECT 'stratum_floor' AS key, '0.6' AS value UNION ALL SELECT 'headline_floor', '0.75' UNION ALL SELECT 'outlier_z', '3.5' UNION ALL SELECT 'curve.' || curve || '.' || apd, CAST(CAST(cw AS DOUBLE) AS VARCHAR) FROM curves
  UNION ALL SELECT DISTINCT 'carrier.' || event_type, '1.0' FROM events)"""


@add("q6_methodology", sql("SELECT key, value, (SELECT sha256(string_agg(key || '=' || value, chr(10) ORDER BY key || '=' || value)) FROM p) AS config_hash FROM p", CURVES, PARAMS))
def q6_methodology(spark, d):
    """The parameters in use and their stamp: of the expected carriers those that the events have."""
    p = METHOD.param_table(spark)
    seen = tables.read(spark, d, "events").select(F.concat(F.lit("carrier."), "event_type").alias("key")).distinct()
    used = p.join(F.broadcast(seen), "key", "left_semi").unionByName(p.filter("key not like 'carrier.%'"))
    return used.crossJoin(F.broadcast(parameters.stamp(used)))


@add("k9_o3_sdmx_export", sql("SELECT 'dataflow' AS STRUCTURE, 'PLUMBLINE:INDEX(1.0)' AS STRUCTURE_ID, 'D' AS FREQ, series_id AS SERIES, CAST(period AS VARCHAR) AS TIME_PERIOD, round(value, 6) AS OBS_VALUE, CASE WHEN suppressed THEN 'S' ELSE 'A' END AS OBS_STATUS FROM series", *RUN, STACK))
def k9_o3_sdmx_export(spark, d):
    rows, path = reads.sdmx_rows(run_of(spark, d).series()), shared_path(spark, "sdmx")
    rows.write.option("header", True).csv(path)
    return spark.read.option("header", True).schema(rows.schema).csv(path)
