"""Queries of the monthly methods, validation and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import multilateral, smooth, validate
from ..plans import spool
from ..plans.index_run import index_run
from ..sources import driver_tables as tables
from ..sources import sinks
from ..sources.versions import Store
from ..streaming import ingest
from .common import COMP, METHOD, PRICES, QUOTES, RUN, RUNS, out, routes, sql
from .index_queries import STACK, run_of

Q, S = {}, {}


def add(name, oracle=None):
    def keep(f):
        Q[name] = lambda spark, sf_dir: out(f(spark, sf_dir))
        if oracle:
            S[name] = oracle
        return f

    return keep


SUB = """li AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_returnflag || l_linestatus || l_linenumber AS item, avg(l_extendedprice) AS base, avg(l_extendedprice * l_tax) AS wedge FROM lineitem GROUP BY ALL),
b AS (SELECT item, base, wedge FROM li WHERE period = (SELECT min(period) FROM li))"""


@add("m1_sub_indices", sql("""SELECT 'base' AS part, CAST(li.period AS VARCHAR) AS period, round(100 * exp(avg(ln(li.base / b.base))), 6) AS value, count(*) AS n FROM li JOIN b USING (item) GROUP BY ALL
  UNION ALL SELECT 'wedge', CAST(li.period AS VARCHAR), round(100 * exp(avg(ln(li.wedge / b.wedge))), 6), count(*) FROM li JOIN b USING (item) WHERE li.wedge > 0 AND b.wedge > 0 GROUP BY ALL""", SUB))
def m1_sub_indices(spark, d):
    item = F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    li = tables.read(spark, d, "lineitem").groupBy(F.trunc("l_shipdate", "MM").alias("period"), item.alias("item")).agg(F.avg("l_extendedprice").alias("base"), F.avg(F.col("l_extendedprice") * F.col("l_tax")).alias("wedge"))
    each = [multilateral.sub_index(li, F.col(c)).select(F.lit(c).alias("part"), "period", "value", "n") for c in ("base", "wedge")]
    return each[0].unionByName(each[1])


WEEK = "weeks AS (SELECT CAST(date_trunc('week', period) AS DATE) AS period, avg(value) AS value FROM comp GROUP BY ALL HAVING count(DISTINCT period) = 7)".replace("count(DISTINCT period)", "count(DISTINCT comp.period)").replace("avg(value)", "avg(comp.value)").replace("date_trunc('week', period)", "date_trunc('week', comp.period)").replace("GROUP BY ALL", "GROUP BY 1")


@add("m2_weekly_monthly", sql("SELECT 'weekly' AS frequency, CAST(period AS VARCHAR) AS period, round(value, 6) AS value FROM weeks UNION ALL SELECT 'monthly', CAST(CAST(date_trunc('month', period) AS DATE) AS VARCHAR), round(avg(value), 6) FROM weeks GROUP BY ALL", *RUN, WEEK))
def m2_weekly_monthly(spark, d):
    weeks = multilateral.complete_weeks(run_of(spark, d).composite)
    months = multilateral.monthly_from_weeks(weeks)
    return weeks.select(F.lit("weekly").alias("frequency"), "period", "value").unionByName(months.select(F.lit("monthly").alias("frequency"), "period", "value"))


PAIRS = """pairs AS (SELECT a.stratum, a.period AS s, b.period AS t, avg(ln(b.price) - ln(a.price)) AS g, count(*) AS n FROM prices a JOIN prices b USING (stratum, item)
  WHERE abs(12 * (year(a.period) - year(b.period)) + month(a.period) - month(b.period)) < 13 GROUP BY ALL)"""


@add("j14_bilateral", sql("SELECT stratum, CAST(s AS VARCHAR) AS s, CAST(t AS VARCHAR) AS t, round(g, 6) + 0.0 AS log_index, n FROM pairs", PRICES, PAIRS))
def j14_bilateral(spark, d):
    return multilateral.bilateral(tables.monthly_prices(spark, d))


@add("m3_geks_window", sql("""SELECT a.stratum, CAST(a.s AS VARCHAR) AS s, CAST(b.t AS VARCHAR) AS t, round(avg(a.g + b.g), 6) + 0.0 AS log_index FROM pairs a JOIN pairs b ON a.stratum = b.stratum AND a.t = b.s
  WHERE a.s BETWEEN DATE '2000-01-01' AND DATE '2001-01-01' AND a.t BETWEEN DATE '2000-01-01' AND DATE '2001-01-01' AND b.t BETWEEN DATE '2000-01-01' AND DATE '2001-01-01' GROUP BY ALL""", PRICES, PAIRS))
def m3_geks_window(spark, d):
    return multilateral.geks(multilateral.bilateral(tables.monthly_prices(spark, d)), F.lit("2000-01-01").cast("date"), F.lit("2001-01-01").cast("date"))


ROLLING = """idx AS (SELECT stratum, period, row_number() OVER (PARTITION BY stratum ORDER BY period) AS k, 12 * year(period) + month(period) AS m FROM (SELECT DISTINCT stratum, period FROM prices)),
pr AS (SELECT p.stratum, a.k AS s, a.m AS ms, b.k AS t, b.m AS mt, g FROM pairs p JOIN idx a ON a.stratum = p.stratum AND a.period = p.s JOIN idx b ON b.stratum = p.stratum AND b.period = p.t),
step AS (SELECT x.stratum, y.t, x.s, avg(x.g + y.g) AS g FROM pr x JOIN pr y ON x.stratum = y.stratum AND x.t = y.s WHERE x.ms <= y.mt AND y.mt - x.ms < 13 AND x.mt <= y.mt AND y.mt - x.mt < 13 AND x.s < y.t GROUP BY ALL),
gl AS (SELECT i.stratum, i.k, i.period, coalesce(list({'s': s, 'g': g}) FILTER (s IS NOT NULL), []) AS steps FROM idx i LEFT JOIN step ON step.stratum = i.stratum AND step.t = i.k GROUP BY i.stratum, i.k, i.period)"""


@add("m3_rolling_geks", sql("""SELECT stratum, CAST(period AS VARCHAR) AS period, round(100 * exp(lp[k]), 6) AS value FROM (WITH RECURSIVE r(stratum, k, period, lp) AS (SELECT stratum, k, period, [0.0::DOUBLE] FROM gl WHERE k = 1 UNION ALL
  SELECT gl.stratum, gl.k, gl.period, list_append(r.lp, CASE WHEN len(gl.steps) > 0 THEN list_avg([r.lp[x.s] + x.g for x in gl.steps]) ELSE 0.0 END) FROM r JOIN gl ON gl.stratum = r.stratum AND gl.k = r.k + 1) SELECT * FROM r)""", PRICES, PAIRS, ROLLING))
def m3_rolling_geks(spark, d):
    return multilateral.rolling_geks(tables.monthly_prices(spark, d))


@add("m4_time_dummies")
def m4_time_dummies(spark, d):
    return multilateral.time_dummies(tables.monthly_prices(spark, d))


TPD = """pm AS (SELECT stratum, item, period, 12 * year(period) + month(period) AS m, ln(price) AS lp FROM prices WHERE price > 0),
mo AS (SELECT DISTINCT stratum, m, period FROM pm),
fe AS (SELECT mo.stratum, max(m) AS e FROM mo JOIN (SELECT stratum, min(m) AS m0 FROM mo GROUP BY stratum) f ON f.stratum = mo.stratum AND m < m0 + 13 GROUP BY mo.stratum),
we AS (SELECT mo.stratum, m AS last, m = e AS is_first FROM mo JOIN fe ON fe.stratum = mo.stratum AND m >= e),
wr AS MATERIALIZED (SELECT p.stratum, last, item, m, lp, count(*) OVER w AS n, avg(lp) OVER w AS mean FROM we JOIN pm p ON p.stratum = we.stratum AND m BETWEEN last - 12 AND last WINDOW w AS (PARTITION BY p.stratum, last, item)),
ow AS MATERIALIZED (SELECT stratum, last, m, sum(lp - mean) AS b, count(*) AS d, row_number() OVER (PARTITION BY stratum, last ORDER BY m) - 1 AS i FROM wr GROUP BY stratum, last, m),
cr AS (SELECT a.stratum, a.last, a.m AS s, b.m AS t, sum(1.0 / a.n) AS x FROM wr a JOIN wr b ON a.stratum = b.stratum AND a.last = b.last AND a.item = b.item GROUP BY ALL),
gr AS (SELECT a.stratum, a.last, a.i, b.i AS j, CASE WHEN a.i = b.i THEN a.d ELSE 0 END - coalesce(x, 0) AS v, a.b FROM ow a JOIN ow b ON a.stratum = b.stratum AND a.last = b.last LEFT JOIN cr ON cr.stratum = a.stratum AND cr.last = a.last AND s = a.m AND t = b.m WHERE a.i > 0 AND b.i > 0),
mx AS (SELECT stratum, last, list(r ORDER BY i) AS mat FROM (SELECT stratum, last, i, list_append(list(v ORDER BY j), any_value(b)) AS r FROM gr GROUP BY stratum, last, i) GROUP BY stratum, last),
el AS (WITH RECURSIVE e(stratum, last, k, mat, good) AS (SELECT stratum, last, 0, mat, []::BOOLEAN[] FROM mx UNION ALL SELECT stratum, last, k + 1,
  CASE WHEN abs(mat[k + 1][k + 1]) > 1e-9 THEN list_transform(mat, lambda r, i: list_transform(r, lambda c, j: CASE WHEN i = k + 1 THEN c / mat[k + 1][k + 1] ELSE c - r[k + 1] * mat[k + 1][j] / mat[k + 1][k + 1] END)) ELSE mat END,
  list_append(good, abs(mat[k + 1][k + 1]) > 1e-9) FROM e WHERE k < len(mat)) SELECT stratum, last, list_prepend(0.0::DOUBLE, list_transform(mat, lambda r, i: CASE WHEN good[i] THEN r[len(mat) + 1] ELSE 0.0 END)) AS step FROM e WHERE k = len(mat)),
ds AS MATERIALIZED (SELECT we.stratum, we.last, is_first, ow.m, CASE WHEN step IS NULL THEN 0.0 ELSE step[CAST(ow.i + 1 AS BIGINT)] END AS g FROM we JOIN ow ON ow.stratum = we.stratum AND ow.last = we.last LEFT JOIN el ON el.stratum = we.stratum AND el.last = we.last),
tl AS (SELECT a.stratum, a.last, row_number() OVER (PARTITION BY a.stratum ORDER BY a.last) AS k, list({'m': b.m, 'g': a.g - b.g} ORDER BY b.m) FILTER (b.m < a.last) AS steps FROM ds a JOIN ds b ON a.stratum = b.stratum AND a.last = b.last WHERE a.m = a.last AND NOT a.is_first GROUP BY a.stratum, a.last),
f0 AS (SELECT stratum, map_from_entries(list((m, g))) AS lp FROM ds WHERE is_first GROUP BY stratum),
sp AS (WITH RECURSIVE r(stratum, k, lp) AS (SELECT stratum, 0, lp FROM f0 UNION ALL SELECT r.stratum, r.k + 1, map_concat(r.lp, MAP {tl.last: coalesce(list_avg([r.lp[x.m] + x.g for x in tl.steps]), (SELECT g FROM ds WHERE ds.stratum = tl.stratum AND ds.last = tl.last AND ds.m = tl.last))}) FROM r JOIN tl ON tl.stratum = r.stratum AND tl.k = r.k + 1)
  SELECT stratum, lp FROM r QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY k DESC) = 1)"""


@add("m4_rolling_time_dummies", sql("SELECT sp.stratum, CAST(period AS VARCHAR) AS period, round(100 * exp(lp[mo.m]), 6) AS value FROM sp JOIN mo ON mo.stratum = sp.stratum", PRICES, TPD))
def m4_rolling_time_dummies(spark, d):
    return multilateral.rolling_time_dummies(tables.monthly_prices(spark, d))


CHG = "m AS (SELECT stratum, period, sum(price * revenue) / sum(revenue) AS value FROM prices GROUP BY ALL)"


@add("w9_changes", sql("SELECT stratum, CAST(period AS VARCHAR) AS period, round(value, 6) AS value, round(value / lag(value) OVER (PARTITION BY stratum ORDER BY period) - 1, 6) + 0.0 AS change FROM (SELECT stratum, period, value FROM m)", PRICES, CHG))
def w9_changes(spark, d):
    m = tables.monthly_prices(spark, d).groupBy("stratum", "period").agg((F.sum(F.col("price") * F.col("revenue")) / F.sum("revenue")).alias("value"))
    return smooth.change(m, ["stratum"])


HALVES = """half AS (SELECT l_linenumber % 2 AS odd, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, avg(l_extendedprice) AS value FROM lineitem GROUP BY ALL),
ch AS (SELECT *, value / lag(value) OVER (PARTITION BY odd ORDER BY period) - 1 AS c FROM half),
both_ AS (SELECT a.period, a.value AS va, b.value AS vb, a.c AS ca, b.c AS cb FROM ch a JOIN ch b USING (period) WHERE a.odd = 1 AND b.odd = 0)"""


def halves(spark, d):
    h = tables.read(spark, d, "lineitem").groupBy((F.col("l_linenumber") % 2).alias("odd"), F.trunc("l_shipdate", "MM").alias("period")).agg(F.avg("l_extendedprice").alias("value"))
    return h.filter("odd = 1").drop("odd"), h.filter("odd = 0").drop("odd")


@add("j15_benchmark_join", sql("SELECT CAST(period AS VARCHAR) AS period, round(va, 6) AS ours, round(vb, 6) AS theirs FROM both_", HALVES))
def j15_benchmark_join(spark, d):
    return validate.benchmark_join(*halves(spark, d), ["period"])


BY_ROUTE = """part_ AS (SELECT l_linenumber % 2 AS odd, l_suppkey % 25 AS route, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, avg(l_extendedprice) AS value FROM lineitem GROUP BY ALL),
rc AS (SELECT *, value / lag(value) OVER (PARTITION BY odd, route ORDER BY period) - 1 AS c FROM part_),
rb AS (SELECT a.route, a.value AS va, b.value AS vb, a.c AS ca, b.c AS cb FROM rc a JOIN rc b USING (route, period) WHERE a.odd = 1 AND b.odd = 0),
lv AS (SELECT route, avg(va) AS va, avg(vb) AS vb FROM rb GROUP BY route)"""


@add("m7_scores", sql("""SELECT round(avg(CASE WHEN ca IS NOT NULL AND cb IS NOT NULL THEN CASE WHEN sign(ca) = sign(cb) THEN 1.0 ELSE 0.0 END END), 6) AS direction, round((SELECT corr(x, y) FROM (SELECT rank() OVER (ORDER BY va) AS x, rank() OVER (ORDER BY vb) AS y FROM lv)), 6) AS spearman,
  round(avg(CASE WHEN cb <> 0 AND ca IS NOT NULL THEN abs((ca - cb) / cb) END), 6) AS mape FROM rb""", BY_ROUTE))
def m7_scores(spark, d):
    each = tables.read(spark, d, "lineitem").groupBy((F.col("l_linenumber") % 2).alias("odd"), (F.col("l_suppkey") % 25).alias("route"), F.trunc("l_shipdate", "MM").alias("period")).agg(F.avg("l_extendedprice").alias("value"))
    return validate.scores(each.filter("odd = 1").drop("odd"), each.filter("odd = 0").drop("odd"), ["route"])


@add("m8_lead_lag", sql("SELECT k AS lag, round(corr(a.ca, b.cb), 6) AS correlation, count(*) AS n FROM (SELECT *, unnest([-3, -2, -1, 0, 1, 2, 3]) AS k FROM both_ WHERE ca IS NOT NULL) a JOIN both_ b ON b.period = a.period + to_months(k) AND b.cb IS NOT NULL GROUP BY k", HALVES))
def m8_lead_lag(spark, d):
    return validate.lead_lag(*halves(spark, d))


@add("m9_revisions", sql("SELECT CAST(period AS VARCHAR) AS period, round(value + 1, 6) AS stored, round(value, 6) AS recomputed FROM comp WHERE day(period) % 7 = 0", *RUN[:9]))
def m9_revisions(spark, d):
    c = run_of(spark, d).composite.select("period", "value")
    stored = c.withColumn("value", F.when(F.dayofmonth("period") % 7 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return validate.revisions(stored, c, ["period"])


@add("m9_same_bits", sql("SELECT series_id, CAST(period AS VARCHAR) AS period, round(value, 6) AS value, true AS same FROM series", *RUN, STACK))
def m9_same_bits(spark, d):
    """The whole run twice, from quotes in 1 and in 23 partitions: every published double is the same, bit by bit."""
    quotes, basket = tables.quotes(spark, d), spool.stored(routes(spark, d), "basket")
    one, many = (index_run(q, basket, METHOD).stack for q in (quotes.coalesce(1), quotes.repartition(23)))
    keys, values = ["series_id", "period"], ["value", "coverage", "low", "high"]
    differ = validate.changed_bits(one, many, keys, values).select(*keys, F.lit(False).alias("same"))
    return one.join(differ, keys, "left").select(*keys, "value", F.coalesce("same", F.lit(True)).alias("same"))


@add("m10_event_calendar", sql("""SELECT CAST(period AS VARCHAR) AS period, round(value, 6) AS value, CASE WHEN period BETWEEN DATE '2024-01-12' AND DATE '2024-01-14' THEN 'festival,strike' WHEN period BETWEEN DATE '2024-01-10' AND DATE '2024-01-14' THEN 'festival' WHEN period BETWEEN DATE '2024-01-15' AND DATE '2024-01-16' THEN 'fare cap,festival,strike'
  WHEN period BETWEEN DATE '2024-01-17' AND DATE '2024-01-20' THEN 'fare cap,festival' WHEN period > DATE '2024-01-20' THEN 'fare cap' END AS events, period >= DATE '2024-01-15' AS structural_break, CAST(period >= DATE '2024-01-15' AS INTEGER) AS regime FROM comp""", *RUN[:9]))
def m10_event_calendar(spark, d):
    c = [("festival", "2024-01-10", "2024-01-20", False), ("strike", "2024-01-12", "2024-01-16", False), ("fare cap", "2024-01-15", None, True)]
    c = spark.createDataFrame(c, "name string, starts string, ends string, breaks boolean").selectExpr("name", "date(starts) as starts", "date(ends) as ends", "breaks")
    return validate.annotated(run_of(spark, d).composite.select("period", "value"), c)


# --- streams


def spooled(spark, quotes, times=1):
    """A store into which the quotes' spool folder was streamed, `times` times from the start."""
    folder, store = spool.shared_path(spark, "spool"), Store(spark, spool.shared_path(spark, "store"))
    spool.write_spool(quotes, folder)
    for _ in range(times):
        ingest.ingest_spool(spark, folder, store, spool.shared_path(spark, "mark")).awaitTermination()
    return store


@add("t1_s8_k7_spool_ingest", sql("SELECT quote_id, CAST(period AS VARCHAR) AS period, round(CAST(total_fare AS DECIMAL(10, 2)), 2) AS total_fare FROM (SELECT *, row_number() OVER (PARTITION BY source, carrier, route_id, apd, coalesce(fare_class, ''), period ORDER BY started_at, quote_id) AS rn FROM (SELECT q.*, min(collection_ts) OVER (PARTITION BY run_id, quote_id // 20000) AS started_at FROM quotes q)) WHERE rn = 1", QUOTES))
def t1_s8_k7_spool_ingest(spark, d):
    return spooled(spark, tables.quotes(spark, d)).read("quotes", ingest.QUOTES).select("quote_id", "period", "total_fare")


DOCS = """docs AS (SELECT run_id, quote_id // 20000 AS part, min(collection_ts) AS started_at FROM quotes GROUP BY ALL),
landed AS (SELECT * FROM (SELECT q.*, row_number() OVER (PARTITION BY source, carrier, route_id, apd, coalesce(fare_class, ''), period ORDER BY d.started_at, quote_id) AS rn FROM quotes q JOIN docs d ON d.run_id = q.run_id AND d.part = q.quote_id // 20000) WHERE rn = 1)"""


@add("k7_k2_runs_with_quotes", sql("SELECT d.run_id, strftime(min(d.started_at), '%Y-%m-%d %H:%M:%S') AS started_at, coalesce(any_value(n), 0) AS n_quotes FROM docs d LEFT JOIN (SELECT run_id, count(*) AS n FROM landed GROUP BY run_id) l ON l.run_id = d.run_id GROUP BY d.run_id", QUOTES, DOCS))
def k7_k2_runs_with_quotes(spark, d):
    """Runs and their quotes land in one step, and a replay from a lost checkpoint adds neither."""
    store = spooled(spark, tables.quotes(spark, d), times=2)
    n = store.read("quotes", ingest.QUOTES).groupBy("run_id").agg(F.count("*").alias("n_quotes"))
    return store.read("runs", ingest.RUNS).join(n, "run_id", "left").select("run_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"))


@add("s8_rejected_documents", sql("SELECT run_id, count(*) AS n, 'not readable' AS reason FROM (SELECT DISTINCT run_id, quote_id // 20000 AS part FROM quotes WHERE user_id % 50 % 10 = 0) GROUP BY run_id UNION ALL SELECT 'none', count(DISTINCT run_id), 'lacks quotes' FROM quotes WHERE user_id % 50 % 10 = 1", QUOTES.replace("SELECT event_id AS quote_id", "SELECT user_id, event_id AS quote_id")))
def s8_rejected_documents(spark, d):
    """Cut off copies of every tenth run's documents, and documents without quotes, land in the reject table with file and text."""
    folder, mark, store = spool.shared_path(spark, "spool"), spool.shared_path(spark, "mark"), Store(spark, spool.shared_path(spark, "store"))
    spool.write_spool(tables.quotes(spark, d), folder)
    number = F.regexp_extract("run_id", "^run([0-9]+)-", 1).cast("int") % 10
    cut = spark.read.text(folder).withColumn("run_id", F.get_json_object("value", "$.run_id"))
    cut = cut.filter(number == 0).select(F.expr("substring(value, 1, length(value) - 5)").alias("value"))
    bare = tables.quotes(spark, d).select("run_id").distinct().filter(number == 1).select(F.to_json(F.struct(F.lit("none").alias("run_id"), F.lit("s").alias("source"), F.lit("2024-01-01T00:00:00Z").alias("started_at"), F.col("run_id").alias("notes"), F.lit("failed").alias("status"))).alias("value"))
    spool.stored_text(cut.unionByName(bare), folder)
    ingest.ingest_spool(spark, folder, store, mark).awaitTermination()
    run_id = F.regexp_extract("text", '"run_id":"([^"]*)"', 1)
    return store.read("rejects", ingest.REJECTS).filter("file is not null").groupBy(run_id.alias("run_id"), "reason").agg(F.count("*").alias("n")).select("run_id", "n", "reason")


@add("t2_daily_yield", sql("SELECT CAST(day AS VARCHAR) AS day, source, count(*) AS n_runs, count(*) FILTER (status <> 'failed') AS n_done FROM runs GROUP BY ALL", RUNS))
def t2_daily_yield(spark, d):
    folder, table, mark = (spool.shared_path(spark, n) for n in ("runs", "yield", "mark"))
    r = tables.runs(spark, d)
    r.write.parquet(folder)
    stream = spark.readStream.schema(r.schema).parquet(folder)

    def land(batch, _):
        sinks.upsert_partitions(batch, table, ["day", "source"], "day")

    ingest.daily_yield(stream).writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(table)


LATE = """late AS (SELECT source, day, count(*) AS n FROM runs WHERE day < DATE '2024-01-20' AND day + 1 <= (SELECT max(started_at) FROM runs WHERE day >= DATE '2024-01-20') - INTERVAL 14 DAYS GROUP BY ALL)"""


@add("t3_late_rows", sql("SELECT CAST(r.day AS VARCHAR) AS day, CAST(r.source AS VARCHAR) AS source, count(*) AS n_runs, count(*) FILTER (status <> 'failed') AS n_done, coalesce(any_value(n), 0) AS n_late FROM runs r LEFT JOIN late l ON l.source = r.source AND l.day = r.day GROUP BY r.day, r.source", RUNS, LATE))
def t3_late_rows(spark, d):
    """Two batches of one stream, the second with runs from before the watermark: they are reported, and the yields of their days
    are those of a full computation."""
    folder, mark, store = spool.shared_path(spark, "spool"), spool.shared_path(spark, "mark"), Store(spark, spool.shared_path(spark, "store"))
    r = tables.runs(spark, d)
    for part in ("day >= date'2024-01-20'", "day < date'2024-01-20'"):
        spool.write_runs(r.filter(part), folder)
        ingest.ingest_spool(spark, folder, store, mark).awaitTermination()
    late = store.read("late", ingest.LATE).groupBy("day", "source").agg(F.count("*").alias("n_late"))
    return store.read("yield", ingest.YIELD).join(late, ["day", "source"], "left").na.fill(0, ["n_late"])


@add("u4_k8_retained_runs", sql("SELECT pending, count(*) AS n, 0 AS stale FROM runs WHERE pending OR day >= DATE '2024-01-16' GROUP BY ALL", RUNS))
def u4_k8_retained_runs(spark, d):
    """Sent runs older than the retention go from store and folders; `stale` counts what is left of them. Pending ones stay."""
    folder, archive, mark, store = (spool.shared_path(spark, n) for n in ("spool", "archive", "mark", "store"))
    store, r = Store(spark, store), tables.runs(spark, d)
    spool.write_runs(r.filter("not pending"), folder)
    ingest.ingest_spool(spark, folder, store, mark, per_batch=12, archive=archive).awaitTermination()
    spool.write_runs(r.filter("pending"), folder)
    ingest.retain(store, [archive], "2024-01-30")
    sent = store.read("sent", ingest.SENT)
    there = ingest.read_spool(spark, f"{folder.rsplit('/', 1)[0]}/{{{folder.rsplit('/', 1)[1]},{archive.rsplit('/', 1)[1]}}}").select("run_id", F.to_date("started_at").alias("day"))
    both = there.join(r.select("run_id", "pending"), "run_id")
    stale = both.filter("not pending and day < date'2024-01-16'").groupBy("pending").agg(F.count("*").alias("stale"))
    kept = sent.select(F.lit(False).alias("pending")).unionByName(both.filter("pending").select("pending"))
    return kept.groupBy("pending").agg(F.count("*").alias("n")).join(stale, "pending", "left").select("pending", "n", F.coalesce("stale", F.lit(0)).cast("int").alias("stale"))


@add("s9_landing", "SELECT sha256(coalesce(html, '') || chr(10)) AS hash, count(*) AS n, 0 AS again FROM (SELECT DISTINCT html FROM pages) GROUP BY ALL")
def s9_landing(spark, d):
    """One file a page, landed twice: the second time adds nothing."""
    files, path = spool.shared_path(spark, "files"), spool.shared_path(spark, "landing")
    spool.one_file_a_row(tables.read(spark, d, "pages").select("html"), files)
    payloads = sinks.read_payloads(spark, files)
    sinks.land_payloads(payloads, path)
    again = sinks.land_payloads(payloads, path)
    return spark.read.parquet(path).groupBy("hash").agg(F.count("*").alias("n")).withColumn("again", F.lit(again))
