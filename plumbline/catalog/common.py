"""Shared pieces of the registered queries and of their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..parameters import Methodology
from ..sources import driver_tables as tables

METHOD = Methodology(carriers=("click", "error", "purchase", "signup", "view"))
ROUTES = 5


def out(df: DataFrame) -> DataFrame:
    """Doubles to six digits without negative zeros, decimals as doubles, dates as text: the form both engines compare in."""
    made = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        if t.startswith("decimal"):
            col = col.cast("double")
        if t == "double" or t.startswith("decimal"):
            col = F.round(col, 6) + F.lit(0.0)
        elif t in ("date", "timestamp"):
            col = col.cast("string")
        made.append(col.alias(c))
    return df.select(*made)


def routes(spark, sf_dir: str, n: int = ROUTES, partial: bool = False) -> DataFrame:
    """The basket: a route's weight is its share of all quoted value; `partial` leaves the last route without one."""
    q = tables.quotes(spark, sf_dir, n)
    whole = q.agg(F.sum("total_fare").alias("whole"))
    w = F.round(F.col("v") / F.col("whole"), 6)
    if partial:
        w = F.when(F.col("route_id") < n - 1, w)
    by = q.groupBy("route_id").agg(F.sum("total_fare").alias("v"), F.min("period").alias("weight_start"), F.max("period").alias("weight_end"))
    return by.crossJoin(F.broadcast(whole)).select("route_id", w.alias("weight"), F.lit("value_share").alias("weight_basis"), F.lit("events").alias("weight_source"), "weight_start", "weight_end")


def route_table(spark, sf_dir: str) -> DataFrame:
    """The route table with its ends and classes: every fourth route is not in use, and the third has no weight yet."""
    k = F.col("route_id")
    r = routes(spark, sf_dir).withColumn("weight", F.when(k != 2, F.col("weight")))
    return r.select("route_id", F.concat(F.lit("R0"), k.cast("string")).alias("origin"), F.lit("HUB").alias("destination"), F.when(k % 2 == 0, "metro").otherwise("regional").alias("stratum_class"), (k % 4 != 3).alias("active"), "weight")


QUOTES = """quotes AS (SELECT event_id AS quote_id, 'src' || CAST(event_id % 3 AS VARCHAR) AS source, event_type AS carrier, CAST(user_id % {R} AS INTEGER) AS route_id,
  CAST(ts AS DATE) AS period, ts AS collection_ts, CASE WHEN event_id % 29 = 0 THEN 8 WHEN event_id % 4 = 0 THEN 1 WHEN event_id % 4 = 1 THEN 7 WHEN event_id % 4 = 2 THEN 15 ELSE 30 END AS apd,
  value AS total_fare, CASE WHEN event_id % 31 = 0 THEN 'filed_floor' WHEN event_id % 37 = 0 THEN 'uncontrolled_lead' WHEN event_id % 5 = 0 THEN 'economy' END AS fare_class,
  CASE WHEN event_id % 41 = 0 THEN 'collection_failed' ELSE 'observed' END AS observation_status, CASE WHEN event_id % 43 = 0 THEN 'manual' END AS exclusion_reason,
  'run' || CAST(user_id % 50 AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS run_id FROM events)"""
OBS = """obs AS (SELECT period, route_id, apd, carrier, min(total_fare) AS price FROM quotes WHERE observation_status = 'observed' AND exclusion_reason IS NULL AND total_fare > 0
  AND apd IN (1, 7, 15, 30) AND (fare_class IS NULL OR fare_class NOT IN ('filed_floor', 'filed_base', 'uncontrolled_lead')) GROUP BY ALL)"""
REL = """rel AS (SELECT o.period, o.route_id, o.apd, o.carrier, o.price / b.price AS relative, ln(o.price / b.price) AS lr FROM obs o
  JOIN obs b USING (route_id, apd, carrier) WHERE b.period = (SELECT min(period) FROM obs) AND o.period > b.period)"""
FLAG = """f1 AS (SELECT *, count(*) OVER s AS n, median(lr) OVER s AS med FROM rel WINDOW s AS (PARTITION BY route_id, apd)),
f2 AS (SELECT *, abs(lr - med) AS dev FROM f1),
f3 AS (SELECT *, median(dev) OVER s AS mad, avg(dev) OVER s AS mean_ad FROM f2 WINDOW s AS (PARTITION BY route_id, apd)),
flagged AS (SELECT period, route_id, apd, carrier, relative, lr, (lr - med) / CASE WHEN n < 3 THEN NULL WHEN mad > 0 THEN mad / 0.6745 WHEN mean_ad > 0 THEN mean_ad * 1.253314 END AS z FROM f3)"""
FILL = """carriers AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS carrier),
cells AS (SELECT period, route_id, apd, avg(lr) AS m FROM rel GROUP BY ALL),
missing AS (SELECT c.period, c.route_id, c.apd, k.carrier, c.m FROM cells c CROSS JOIN carriers k WHERE NOT EXISTS
  (SELECT 1 FROM rel r WHERE r.period = c.period AND r.route_id = c.route_id AND r.apd = c.apd AND r.carrier = k.carrier)),
filled AS (SELECT period, route_id, apd, carrier, lr, false AS imputed FROM rel UNION ALL SELECT period, route_id, apd, carrier, m, true FROM missing)"""
PANEL = """panel AS (SELECT period, route_id, apd, exp(avg(lr)) AS jevons, count(*) FILTER (NOT imputed) AS n_observed, count(*) FILTER (imputed) AS n_imputed,
  count(*) FILTER (NOT imputed) / 5.0 AS coverage, count(*) FILTER (NOT imputed) / 5.0 < 0.6 AS suppressed FROM filled GROUP BY ALL)"""
ROUTE = """routes AS (SELECT route_id, round(sum(total_fare) / (SELECT sum(total_fare) FROM quotes), 6) AS weight, min(period) AS weight_start, max(period) AS weight_end FROM quotes GROUP BY route_id)"""
PARTIAL = """routes AS (SELECT route_id, CASE WHEN route_id < 4 THEN round(sum(total_fare) / (SELECT sum(total_fare) FROM quotes), 6) END AS weight, min(period) AS weight_start, max(period) AS weight_end FROM quotes GROUP BY route_id)"""
CURVES = """curves AS (SELECT * FROM (VALUES ('central', 1, 0.08), ('central', 7, 0.27), ('central', 15, 0.35), ('central', 30, 0.30), ('front_loaded', 1, 0.15), ('front_loaded', 7, 0.35),
  ('front_loaded', 15, 0.30), ('front_loaded', 30, 0.20), ('back_loaded', 1, 0.04), ('back_loaded', 7, 0.18), ('back_loaded', 15, 0.33), ('back_loaded', 30, 0.45)) t(curve, apd, cw))"""
UPPER = CURVES + """,
u1 AS (SELECT period, curve, sum(CASE WHEN NOT suppressed THEN weight * CAST(cw AS DOUBLE) END) AS sw, sum(CASE WHEN NOT suppressed THEN weight * CAST(cw AS DOUBLE) * jevons END) AS swj,
  sum(coverage) AS sc, count(*) FILTER (NOT suppressed) AS n_strata FROM panel JOIN routes USING (route_id) JOIN curves USING (apd) GROUP BY ALL),
upper_ AS (SELECT period, curve, 100 * swj / sw AS value, least(1.0, sc / ((SELECT count(*) FROM routes) * 4)) AS coverage, n_strata FROM u1 WHERE sw > 0)"""
COMP = """comp AS (SELECT period, max(value) FILTER (curve = 'central') AS value, max(coverage) FILTER (curve = 'central') AS coverage, min(value) AS low, max(value) AS high,
  max(n_strata) FILTER (curve = 'central') AS n_strata, max(coverage) FILTER (curve = 'central') < 0.75 AS suppressed FROM upper_ GROUP BY period)"""
WIN = """win AS (SELECT period, apd, 100 * sum(CASE WHEN NOT suppressed THEN weight * jevons END) / sum(CASE WHEN NOT suppressed THEN weight END) AS value, least(1.0, avg(coverage)) AS coverage
  FROM panel JOIN routes USING (route_id) GROUP BY ALL HAVING sum(CASE WHEN NOT suppressed THEN weight END) > 0)"""
SMOOTH = """sm AS (SELECT period, count(*) OVER w AS days, avg(value) OVER w AS value, avg(low) OVER w AS low, avg(high) OVER w AS high, coverage, suppressed FROM comp
  WINDOW w AS (ORDER BY period RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 3 DAYS FOLLOWING)),
smooth AS (SELECT period, value, coverage, low, high, suppressed FROM sm WHERE days = 7)"""
RUN = [QUOTES, OBS, REL, FLAG, FILL, PANEL, ROUTE, UPPER, COMP, WIN, SMOOTH]
RUNS = """runs AS (SELECT 'run' || CAST(event_id AS VARCHAR) AS run_id, CAST(user_id % 250 AS INTEGER) AS source, ts AS started_at, CAST(ts AS DATE) AS day,
  CASE WHEN event_type = 'purchase' THEN 'succeeded' WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'partial' ELSE 'failed' END AS status,
  event_id % 47 = 0 AS selector_relocated, event_id % 7 = 0 AS pending, event_type FROM events)"""
FLOWS = """cells AS (SELECT a.n_name AS city1, b.n_name AS city2, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, sum(l_quantity) AS passengers
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON s_nationkey = a.n_nationkey
  JOIN customer ON o_custkey = c_custkey JOIN nation b ON c_nationkey = b.n_nationkey GROUP BY ALL),
cities AS (SELECT n_name AS city, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_nationkey % 11 = 10 AS refused, n_nationkey % 7 = 6 AND n_nationkey % 11 <> 10 AS unknown FROM nation),
good AS (SELECT * FROM cities WHERE NOT refused AND NOT unknown),
flows AS (SELECT x.code AS origin, y.code AS destination, period, passengers FROM cells JOIN good x ON city1 = x.city JOIN good y ON city2 = y.city WHERE x.code <> y.code),
basket AS (SELECT DISTINCT a.code AS origin, b.code AS destination FROM cities a, cities b WHERE CAST(substr(a.code, 2) AS INTEGER) % 4 = 0 AND CAST(substr(b.code, 2) AS INTEGER) % 5 = 1 AND a.code <> b.code),
tot AS (SELECT origin, destination, sum(passengers) AS passengers, count(DISTINCT period) AS months_observed FROM flows
  WHERE period > (SELECT max(period) FROM flows) - INTERVAL 12 MONTH GROUP BY ALL),
shares AS (SELECT origin, destination, CASE WHEN passengers > 0 THEN passengers END AS passengers, CASE WHEN passengers > 0 THEN passengers / sum(CASE WHEN passengers > 0 THEN passengers END) OVER () END AS share,
  coalesce(months_observed, 0) AS months_observed, NOT coalesce(passengers > 0, false) AS missing FROM basket LEFT JOIN tot USING (origin, destination))"""
PRICES = """prices AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, p_type AS stratum, p_brand AS item, sum(l_extendedprice) / sum(l_quantity) AS price, sum(l_extendedprice) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def sql(select: str, *ctes: str, n: int = ROUTES) -> str:
    parts = ",\n".join(ctes).replace("{R}", str(n))
    return f"WITH {parts}\n{select}" if ctes else select
