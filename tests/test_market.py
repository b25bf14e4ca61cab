"""Weights, health, normalisation, sinks, streams and monthly methods."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.operators import eligibility, health, multilateral, normalise, quality, validate, weights
from plumbline.plans import reads
from plumbline.sources import sinks
from plumbline.sources.versions import Change, Store

DAY = dt.date(2026, 9, 14)


def test_traffic(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Year,Month,City1,City2,PaxToCity2,PaxFromCity2\n2026,7,DELHI,MUMBAI,100,80\n2026,7,MUMBAI (NAVI MUMBAI),DELHI,5,\n2026,6,DELHI,MUMBAI (MUMBAI),x,20\n2026,13,DELHI,MUMBAI,1,1\n2026,7,DELHI,ATLANTIS,7,7\n")
    cells = weights.traffic_cells(weights.read_traffic(spark, str(tmp_path / "t.csv")))
    cities = spark.createDataFrame([("DELHI", "DEL", False, False), ("MUMBAI", "BOM", False, False), ("MUMBAI (MUMBAI)", "BOM", False, False), ("MUMBAI (NAVI MUMBAI)", "NMI", True, False)], "city string, code string, refused boolean, unknown boolean")
    flows = weights.mapped_flows(cells, cities)
    assert sorted((r.origin, r.destination, r.period.month, r.passengers) for r in flows.collect()) == [("BOM", "DEL", 6, 20), ("BOM", "DEL", 7, 80), ("DEL", "BOM", 7, 100)]
    assert {tuple(r) for r in weights.city_report(cells, cities).collect()} == {("MUMBAI (NAVI MUMBAI)", "refused"), ("ATLANTIS", "unmapped")}
    assert {r.period.month: r.total for r in weights.national_totals(cells).collect()} == {7: 199, 6: 20}
    basket = spark.createDataFrame([("DEL", "BOM"), ("BOM", "DEL"), ("DEL", "GOI")], "origin string, destination string")
    shares = {(r.origin, r.destination): r for r in weights.basket_shares(flows, basket).collect()}
    assert shares["DEL", "GOI"].missing and shares["DEL", "GOI"].share is None and shares["BOM", "DEL"].months_observed == 2
    assert abs(sum(r.share for r in shares.values() if r.share) - 1) < 1e-12
    gates = weights.load_gates(flows, weights.basket_shares(flows, basket), weights.national_totals(cells), weights.unmapped_codes(basket, cities), "2027-03-01", 150.0).first()
    assert gates.failed == "drift,missing_route,stale,unmapped_code"
    (tmp_path / "bad.csv").write_text("Year,Month\n1,2\n")
    with pytest.raises(ValueError, match="lacks"):
        weights.read_traffic(spark, str(tmp_path / "bad.csv"))


def runs(spark, rows):
    made = [(f"r{i}", s, dt.datetime(2026, 9, d, 8 + i % 10), dt.date(2026, 9, d), st, False) for i, (s, d, st) in enumerate(rows)]
    return spark.createDataFrame(made, "run_id string, source string, started_at timestamp, day date, status string, pending boolean")


def test_health(spark):
    r = runs(spark, [("a", 8, "succeeded"), ("a", 9, "succeeded"), ("a", 14, "failed"), ("a", 14, "succeeded"), ("b", 14, "failed"), ("b", 14, "failed"), ("b", 14, "failed"), ("c", 12, "partial")])
    assert [tuple(x) for x in health.spans(health.missed_days(r, str(DAY))).orderBy("source").collect()] == [("a", 4, "2026-09-10 to 2026-09-13"), ("c", 1, "2026-09-13")]
    h = {x.source: x for x in health.source_health(r, str(DAY)).collect()}
    assert not h["a"].stale and h["b"].stale and h["b"].failures_today == 3 and h["c"].stale
    assert {(x.source, x.alert, x.gap_days) for x in health.alerts(r).collect()} == {("a", "gap_ended", 4), ("b", "gave_up", None)}
    assert {(x.source, x.reason) for x in health.decisions(r.filter("day = '2026-09-14'")).collect()} == {("a", "already collected"), ("b", "attempts used up")}
    registry = spark.createDataFrame([("a", False), ("b", True), ("c", False), ("new", False)], "source string, tripwire boolean")
    assert {tuple(x) for x in health.verdicts(health.source_health(r, str(DAY)), registry).collect()} == {("a", "OK"), ("b", "TRIPWIRE"), ("c", "STALE"), ("new", "STALE")}


def test_tariff_lines(spark):
    text = "Cover\nECONOMY BASE FARE\nDOMESTIC FARES\n1 Ahmedabad Bengaluru 1219 Minimum 1530 3280\n2 Ahmedabad North Goa1000 Maximum NA 900\n3 Nowhere Delhi 5 Minimum 1\nPREMIUM ECONOMY\n4 Ahmedabad Delhi 7 Minimum 9"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    cities = spark.createDataFrame([(c,) for c in ("Ahmedabad", "Bengaluru", "North Goa", "Delhi")], "city string")
    got = sorted(normalise.tariff_rows(normalise.lines(docs), cities).collect(), key=lambda r: r.line_no)
    assert [(r.origin, r.destination, r.distance, r.band_type, r.skipped) for r in got] == [("Ahmedabad", "Bengaluru", 1219, "Minimum", False), ("Ahmedabad", "North Goa", 1000, "Maximum", False), (None, None, 5, "Minimum", True)]
    assert got[1].fares == [None, Decimal("900.00")]
    pair = spark.createDataFrame([(1, "stray − row Minimum 1 2\nONE WAY FARES\nRoute FARES\nDelhi − Mumbai Minimum 1148 NA 1200 1300")], "doc_id int, text string")
    rows = normalise.pair_rows(normalise.lines(pair))
    assert [(r.section, r.origin, r.destination, r.distance) for r in rows.collect()] == [("ONE WAY FARES", "Delhi", "Mumbai", 1148)]
    assert normalise.lowest_filed(rows).first().fare == Decimal("1200.00")


def test_charges_and_construction(spark):
    rows = [["UDF", "IN", "Bengaluru", "All", "INR 152"], ["", "", "All", "DEL*", "75"], ["ASF", "x", "All", "All", "236"], ["YR", "RCS", "A, B", "All", "10"], ["YR", "CUTE", "A, B", "All", "160"], ["PSF", "", "All", "All", "5"], ["", "", "Goa", "All", "NA"], ["Less than 500", "299"], ["501 - 1000", "399"], ["1001+", "INR 549"], ["text", "1"]]
    cells = spark.createDataFrame([("d", i, c) for i, c in enumerate(rows)], "doc_id string, row_no int, cells array<string>")
    got = normalise.charge_rows(cells)
    assert [(r.kind, r.key, r.lo, r.hi, r.amount) for r in got.orderBy("row_no").collect()] == [
        ("departure", "Bengaluru", None, None, 152), ("arrival", "DEL", None, None, 75), ("asf", None, None, None, 236), ("rcs", None, None, None, 10), ("cute", None, None, None, 160), ("fuel", None, 0, 499, 299), ("fuel", None, 501, 1000, 399), ("fuel", None, 1001, None, 549)]
    report = normalise.schedule_report(got).first()
    assert report.complete and report.collapsed and report.n_departure == 1
    trips = spark.createDataFrame([(499,), (500,), (501,), (5000,)], "distance int")
    assert [r.carrier_charges for r in normalise.in_band(trips, got.filter("kind = 'fuel'")).orderBy("distance").collect()] == [299, None, 399, 549]
    lit = lambda x: F.lit(x).cast("decimal(12,2)")
    gst, total = normalise.gst_and_total(lit(1250), lit(152), lit(236), lit(170), lit(549))
    assert tuple(spark.range(1).select(gst, total).first()) == (Decimal("90.40"), Decimal("2447.40"))


def test_offers(spark):
    leg = lambda o, d, t: f"{o}${d}${t}$6E-1"
    j = lambda fare, key, codes='["6E"]': f'{{"fare":{fare},"airlineCodes":{codes},"journeyKeys":["{key}"],"fareBreakup":{{"fareBreakUpItems":[{{"text":"<b>Base Fare</b>","amount":"<i>₹7,100.50</i>"}}]}}}}'
    t = "2026-10-23 05:10"
    page = lambda *js: f'<script id="state" type="application/json">{{"allJourneys":[[{",".join(js)}]]}}</script>'
    rows = [
        ("best", page(j(7857, leg("DEL", "NAG", t) + "|" + leg("NAG", "HYD", t)), j(8933, leg("DEL", "HYD", t)), j(8933, leg("DEL", "HYD", t), "[]"), j(1, leg("DXN", "HYD", t)))),
        ("none", page(j(5, leg("DXN", "HYD", t)))), ("empty", page()), ("shape", "<html/>"), ("late", page(j(5, leg("DEL", "HYD", "2029-01-01 00:00")))), ("broken", page(j(5, leg("DEL", "HYD", "soon")))),
    ]
    pages = spark.createDataFrame([(p, "DEL", "HYD", dt.datetime(2026, 9, 23, 20), h) for p, h in rows], "page_id string, origin string, destination string, collection_ts timestamp, html string")
    got = {r.page_id: r for r in normalise.cheapest_offers(normalise.journeys(pages)).collect()}
    assert (got["best"].fare, got["best"].carrier, got["best"].lead_days, got["best"].base_fare, got["best"].reason) == (8933.0, "6E", 30, Decimal("7100.50"), None)
    assert {k: got[k].reason for k in got if k != "best"} == {"none": "no_nonstop", "empty": "no_journeys", "shape": "shape_error", "late": "implausible_lead", "broken": "no_nonstop"}


def test_contracts(spark):
    columns = "origin string, destination string, apd int, observation_status string, total_fare double, raw_payload_hash string, source string, carrier string, departure_date date, collection_ts timestamp"
    at = (DAY, dt.datetime(2026, 9, 14))
    q = spark.createDataFrame([("DEL", "BOM", 7, "observed", 5.0, "h", "s", "c", *at), ("DE", "DE", 400, "observed", None, None, "s", "c", *at), (None,) * 10], columns)
    got = [r.v for r in q.select(eligibility.violations(eligibility.row_contract()).alias("v")).collect()]
    required = ["carrier_present", "collection_ts_present", "departure_date_present", "destination_code", "lead_days", "observation_status_present", "origin_code", "source_present"]
    assert got == [[], ["destination_code", "distinct_ends", "lead_days", "observed_has_fare", "observed_has_hash", "origin_code"], required]


def test_flags_are_added_and_untouched_days_keep_their_files(spark, tmp_path):
    rows = [(d, 1, 7, c, f, "why") for d in (DAY, DAY + dt.timedelta(1)) for c, f in (("a", True), ("b", False), ("c", None))]
    quotes = spark.createDataFrame(rows, "period date, route_id int, apd int, carrier string, outlier_flag boolean, exclusion_reason string")
    flagged = spark.createDataFrame([(DAY, 1, 7, c, c == "b") for c in "abc"], "period date, route_id int, apd int, carrier string, outlier boolean")
    store = Store(spark, str(tmp_path / "store"))
    store.commit({"quotes": Change(quotes, "period")})
    before = {r.part: r.folder for r in store.entries()}
    assert sinks.flag_outliers(store, flagged, quotes.schema) == 1
    after = {r.part: r.folder for r in store.entries()}
    assert before[str(DAY)] != after[str(DAY)] and before[str(DAY + dt.timedelta(1))] == after[str(DAY + dt.timedelta(1))]
    got = {(r.period, r.carrier): (r.outlier_flag, r.exclusion_reason) for r in store.read("quotes", quotes.schema).collect()}
    assert [got[DAY, c] for c in "abc"] == [(True, "why"), (True, "why"), (False, "why")] and len(got) == 6
    assert sinks.flag_outliers(store, flagged.filter("not outlier"), quotes.schema) == 0 and store.version() == 2


def test_idempotent_sinks(spark, tmp_path):
    q = spark.createDataFrame([(i, f"s{i % 2}", None, DAY, dt.datetime(2026, 9, 14, i % 20)) for i in range(40)], "quote_id long, source string, fare_class string, period date, created_at timestamp")
    path, keys = str(tmp_path / "q"), ["source", "fare_class", "period"]
    assert sinks.append_quotes(q, path, keys, ["created_at", "quote_id"]) == (2, 38)
    assert sinks.append_quotes(q, path, keys, ["created_at", "quote_id"]) == (0, 40)
    v = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], "p string, k int, value double")
    sinks.upsert_partitions(v, str(tmp_path / "v"), ["k"], "p")
    sinks.upsert_partitions(v.filter("k = 1").withColumn("value", F.lit(9.0)), str(tmp_path / "v"), ["k"], "p")
    assert sorted((r.k, r.value) for r in spark.read.parquet(str(tmp_path / "v")).collect()) == [(1, 9.0), (2, 2.0)]


def test_index_reads(spark):
    v = spark.createDataFrame([("v1", "s", "daily", DAY, 1.0, 1.0, False, dt.datetime(2026, 9, 15)), ("v2", "s", "daily", DAY, 2.0, 1.0, False, dt.datetime(2026, 9, 16)), ("v1", "s", "daily", DAY - dt.timedelta(1), 3.0, 1.0, False, dt.datetime(2026, 9, 15))], "vintage_id string, series_id string, frequency string, period date, value double, coverage double, suppressed boolean, published_at timestamp")
    assert sorted(r.value for r in reads.index(v, "s").collect()) == [2.0, 3.0]
    assert [r.value for r in reads.index(v, "s", vintage="v1", start=str(DAY), end=str(DAY)).collect()] == [1.0]
    assert reads.index_latest(v, "s").first().value == 2.0


def months(spark, table):
    rows = [("s", f"i{k}", dt.date(2024 + (m // 12), m % 12 + 1, 1), p) for k, ps in enumerate(table) for m, p in enumerate(ps) if p]
    return spark.createDataFrame(rows, "stratum string, item string, period date, price double")


def test_geks_identities(spark):
    p = months(spark, [[10.0 * (1.1**m) for m in range(6)], [5.0 * (1.1**m) for m in range(6)], [None, 7.7, 7.7 * 1.1, None, None, None]])
    g = {(r.s, r.t): r.log_index for r in multilateral.geks(multilateral.bilateral(p)).collect()}
    assert all(abs(g[a, a]) < 1e-12 for a, b in g if a == b) and all(abs(g[a, b] + g[b, a]) < 1e-12 for a, b in g)
    assert all(abs(g[a, c] - g[a, b] - g[b, c]) < 1e-9 for a, b in g for c in {k[1] for k in g if k[0] == b} if (a, c) in g)
    got = [r.value for r in multilateral.rolling_geks(p).orderBy("period").collect()]
    assert all(abs(v - 100 * 1.1**m) < 1e-6 for m, v in enumerate(got))
    tpd = [r.value for r in multilateral.time_dummies(p, "s").orderBy("period").collect()]
    assert all(abs(v - 100 * 1.1**m) < 1e-6 for m, v in enumerate(tpd))
    two = months(spark, [[10.0, 12.0], [10.0, 27.0]])
    assert abs(multilateral.rolling_geks(two).orderBy("period").collect()[1].value - 100 * math.sqrt(1.2 * 2.7)) < 1e-9


def test_validation(spark):
    s = spark.createDataFrame([(dt.date(2024, m, 1), float(v)) for m, v in enumerate([1, 2, 1.5, 3, 4, 3.5], 1)], "period date, value double")
    r = validate.scores(s, s.withColumn("value", F.col("value") * 2), []).first()
    assert (r.direction, r.spearman, round(r.mape, 9)) == (1.0, None, 0.0)  # one series has no rank correlation
    assert {x.lag: round(x.correlation, 6) for x in validate.lead_lag(s, s, 0).collect()} == {0: 1.0}
    assert validate.revisions(s, s, ["period"]).count() == 0 and validate.revisions(s.limit(3), s, ["period"]).count() == 3


def test_time_dummies_of_all_strata_against_a_full_regression(spark):
    import datetime
    import random

    import numpy as np

    r = random.Random(3)
    months = [datetime.date(2024, m, 1) for m in range(1, 7)]
    rows = [(s, i, m, r.uniform(5, 50)) for s in ("a", "b", "c") for i in range(8) for m in months if m == months[0] or r.random() < 0.7]
    got = {(x.stratum, x.period): x.value for x in multilateral.time_dummies(spark.createDataFrame(rows, "stratum string, item long, period date, price double")).collect()}
    assert set(got) == {(s, m) for s, _, m, _ in rows}
    for s in ("a", "b", "c"):
        mine = [x for x in rows if x[0] == s]
        design = np.array([[*(i == k for k in range(8)), *(m == k for k in months[1:])] for _, i, m, _ in mine], float)
        x = np.linalg.lstsq(design, np.log([x[3] for x in mine]), rcond=None)[0]
        for k, m in enumerate(months[1:]):
            assert abs(got[s, m] - 100 * np.exp(x[8 + k])) < 1e-6
        assert got[s, months[0]] == 100


def test_rolling_time_dummies_against_plain_regressions_by_window(spark):
    import random

    import numpy as np

    r = random.Random(4)
    months = [dt.date(2023 + m // 12, m % 12 + 1, 1) for m in range(20) if m not in (6, 17)]  # two months without any price
    rows = [("long", i, m, r.uniform(5, 50)) for i in range(9) for m in months if i < 2 or r.random() < 0.5]
    rows += [("short", i, m, r.uniform(5, 50)) for i in range(3) for m in months[:4]] + [("one", 1, months[3], 7.0), ("bad", 1, months[0], 0.0)]
    rows += [("apart", 1, months[0], 5.0), ("apart", 2, months[1], 9.0), ("apart", 2, months[2], 18.0)]  # no item in common with the first month
    got = {(x.stratum, x.period): x.value for x in multilateral.rolling_time_dummies(spark.createDataFrame(rows, "stratum string, item long, period date, price double")).collect()}

    def regression(mine):
        items, at = sorted({x[1] for x in mine}), sorted({x[2] for x in mine})
        design = np.array([[*(i == k for k in items), *(m == k for k in at[1:])] for _, i, m, _ in mine], float)
        return dict(zip(at, np.r_[0, np.linalg.lstsq(design, np.log([x[3] for x in mine]), rcond=None)[0][len(items) :]]))

    n = lambda d: 12 * d.year + d.month
    for s in ("long", "short"):
        mine = [x for x in rows if x[0] == s]
        at = sorted({x[2] for x in mine})
        log_p = regression([x for x in mine if n(x[2]) < n(at[0]) + 13])
        for t in at:
            if t not in log_p:
                step = regression([x for x in mine if n(t) - 13 < n(x[2]) <= n(t)])
                log_p[t] = float(np.mean([log_p[k] + step[t] - step[k] for k in step if k != t]))
        assert {k[1]: v for k, v in got.items() if k[0] == s} == pytest.approx({t: 100 * math.exp(v) for t, v in log_p.items()}, rel=1e-9)
    assert got["one", months[3]] == 100 and not any(k[0] == "bad" for k in got)
    assert [got["apart", m] for m in months[:2]] == [100.0, pytest.approx(50.0)] and got["apart", months[2]] == pytest.approx(100.0)


def test_m4_returns_every_stratum(spark):
    from plumbline.catalog.method_queries import Q
    from plumbline.sources import driver_tables

    d = "/root/testdata/sf0.001"
    strata = {x.stratum for x in driver_tables.monthly_prices(spark, d).select("stratum").distinct().collect()}
    assert {x.stratum for x in Q["m4_time_dummies"](spark, d).select("stratum").distinct().collect()} == strata and len(strata) > 1


def test_document_dates(spark):
    at = dt.datetime(2026, 7, 23, 15, 29, 2)
    texts = [
        "2026\u221205\u221208 15:29:02.126928 x D:20260615101500+05'30' Fares for the period W.I.E. till 30th June 2027",
        "2026-05-08 15:29:03 D:20260615101500-03'30' period W.I.E. till 1st July 2026.",
        "issued 2026\u221213\u221208 15:29:02 D:2026 period W.I.E. till 31st June 2026",
        "",
        None,
    ]
    df = spark.createDataFrame([(k, t, at) for k, t in enumerate(texts)], "k int, text string, collection_ts timestamp")
    got = [tuple(r) for r in normalise.document_dates(df).orderBy("k").select("issued", "created", "valid_until", "aged", "expired").collect()]
    assert got[0] == (dt.datetime(2026, 5, 8, 15, 29, 2), dt.datetime(2026, 6, 15, 4, 45), dt.date(2027, 6, 30), True, False)
    assert got[1] == (dt.datetime(2026, 5, 8, 15, 29, 3), dt.datetime(2026, 6, 15, 13, 45), dt.date(2026, 7, 1), False, True)
    assert got[2:] == [(None,) * 5] * 3


def test_quotes_need_a_band_and_all_flat_charges(spark):
    d = Decimal
    filed = spark.createDataFrame([(1, "A", "B", 499, d("1250.00")), (1, "A", "C", 500, d("1250.00")), (2, "A", "D", 499, d("1250.00"))], "doc_id int, origin string, destination string, distance int, base_fare decimal(10,2)")
    filed = filed.withColumn("collection_ts", F.lit("2026-06-20 10:00:00").cast("timestamp"))
    charges = spark.createDataFrame([(1, "asf", d("236")), (1, "rcs", d("10")), (1, "cute", d("160")), (2, "asf", d("236")), (2, "rcs", d("10"))], "doc_id int, kind string, amount decimal(10,2)")
    bands = spark.createDataFrame([(0, 499, d("549")), (501, None, d("699"))], "lo int, hi int, amount decimal(10,2)")
    dep, arr = spark.createDataFrame([("A", d("152"))], "city string, fee decimal(10,2)"), spark.createDataFrame([("A", d("75"))], "code string, fee decimal(10,2)")
    got = {(r.origin, r.destination): r for r in normalise.fare_quotes(filed, normalise.flat_charges(charges), bands, dep, arr).collect()}
    assert set(got) == {("A", "B"), ("B", "A")}
    q = got["A", "B"]
    assert (q.udf, q.asf, q.rcs_levy, q.carrier_charges, q.gst, q.total_fare) == (d("152"), d("236"), d("170"), d("549"), d("90.40"), d("2447.40"))
    assert got["B", "A"].udf == d("75") and q.departure_date == dt.date(2026, 7, 20) and q.advance_purchase_days == 30 and q.is_nonstop


def test_overlapping_sheets_give_one_quote_per_direction_and_day(spark):
    d, day = Decimal, lambda k: dt.date(2026, 6, k)
    sheets = spark.createDataFrame(
        [(1, "AI", dt.datetime(2026, 5, 8), day(1), day(20)), (2, "AI", dt.datetime(2026, 6, 10), day(15), None), (3, "AI", dt.datetime(2026, 6, 10), day(25), None), (4, "XX", dt.datetime(2026, 1, 1), None, day(2))],
        "doc_id int, carrier string, issued timestamp, valid_from date, valid_until date",
    )
    days = spark.createDataFrame([(c, day(k)) for c in ("AI", "XX") for k in (1, 14, 15, 20, 21, 25)] + [("AI", dt.date(2026, 5, 31)), ("AI", dt.date(2026, 9, 1))], "carrier string, day date")
    on = {(r.carrier, r.day): r.doc_id for r in normalise.sheets_on(days, sheets).collect()}
    assert on == {("AI", day(1)): 1, ("AI", day(14)): 1, ("AI", day(15)): 2, ("AI", day(20)): 2, ("AI", day(21)): 2, ("AI", day(25)): 3, ("AI", dt.date(2026, 9, 1)): 3, ("XX", day(1)): 4}
    filed = spark.createDataFrame([(s, "A", "B", 300, d("1000"), "AI") for s in (1, 2, 3)], "doc_id int, origin string, destination string, distance int, base_fare decimal(10,2), carrier string")
    rows = filed.join(normalise.sheets_on(days, sheets), ["carrier", "doc_id"]).withColumn("collection_ts", F.col("day").cast("timestamp"))
    flat = spark.createDataFrame([(s, d("236"), d("170")) for s in (1, 2, 3)], "doc_id int, asf decimal(10,2), rcs_cute decimal(10,2)")
    bands = spark.createDataFrame([(1, 0, 499, d("100")), (2, 0, 299, d("1")), (2, 300, None, d("200")), (2, 250, None, d("200")), (3, 301, None, d("9"))], "doc_id int, lo int, hi int, amount decimal(10,2)")
    dep = spark.createDataFrame([(1, "A", d("10")), (2, "A", d("20")), (2, "A", d("25")), (9, "A", d("99"))], "doc_id int, city string, fee decimal(10,2)")
    arr = spark.createDataFrame([(2, "A", d("7"))], "doc_id int, code string, fee decimal(10,2)")
    got = {(r.collection_ts.day, r.origin, r.destination): (r.doc_id, r.carrier_charges, r.udf) for r in normalise.fare_quotes(rows, flat, bands, dep, arr).collect()}
    assert got == {
        **{(k, "A", "B"): (1, d("100"), d("10")) for k in (1, 14)}, **{(k, "B", "A"): (1, d("100"), d("0")) for k in (1, 14)},
        **{(k, "A", "B"): (2, d("200"), d("20")) for k in (15, 20, 21)}, **{(k, "B", "A"): (2, d("200"), d("7")) for k in (15, 20, 21)},
    }


def test_new_weights_are_all_or_nothing(spark, tmp_path):
    routes = spark.createDataFrame([("A", "B", True, None), ("B", "A", True, 0.3), ("A", "C", False, 0.1)], "origin string, destination string, active boolean, weight double")
    shares = spark.createDataFrame([("A", "B", 0.6, False), ("B", "A", 0.4, False)], "origin string, destination string, share double, missing boolean")
    load = lambda s, failed="": weights.with_new_weights(routes, s, spark.createDataFrame([(failed,)], "failed string"), "pax", "file", "2025-08-01", "2026-07-01", "2026-09-01")
    got = {(r.origin, r.destination): r for r in load(shares).collect()}
    assert (got["A", "B"].weight, got["B", "A"].weight, got["A", "C"].weight) == (0.6, 0.4, 0.1)
    assert (got["A", "B"].weight_basis, got["A", "B"].weight_end, got["A", "C"].weight_basis) == ("pax", dt.date(2026, 7, 1), None)
    for s, failed in ((shares, "stale"), (shares.filter("origin = 'A'"), "")):
        with pytest.raises(ValueError, match="not loaded"):
            load(s, failed)
    assert [r.origin for r in weights.active(routes).orderBy("origin").collect()] == ["A", "B"]


def test_published_values_keep_their_first_time(spark, tmp_path):
    from plumbline.operators import panel

    s = spark.createDataFrame([("c", "daily", dt.date(2024, 1, k), 100.12345678 + k, 0.123456, False, None, None) for k in (1, 2)], "series_id string, frequency string, period date, value double, coverage double, suppressed boolean, low double, high double")
    cells = panel.panel_rows(spark.createDataFrame([(dt.date(2024, 1, 1), 1, 7, 1.123456789, 3, 0, 0.66666)], "period date, route_id int, apd int, jevons double, n_observed int, n_imputed int, coverage double"))
    store = Store(spark, str(tmp_path / "store"))
    sinks.publish(cells, panel.index_rows(s, "v", "h1", "2024-02-01"), store)
    again = panel.index_rows(s.filter("period > date'2024-01-01'"), "v", "h2", "2024-02-02")
    sinks.publish(cells, again, store)
    got = store.read("values", again.schema).orderBy("period").collect()
    assert [(r.value, r.coverage, r.config_hash, r.published_at.day) for r in got] == [(101.123457, 0.1235, "h1", 1), (102.123457, 0.1235, "h2", 1)]
    assert [(r.jevons, r.coverage) for r in store.read("panel", cells.schema).collect()] == [(1.12345679, 0.6667)]


def test_reading_a_broken_table_is_an_error(spark, tmp_path):
    like = spark.createDataFrame([(1,)], "k int")
    assert sinks.read_or_empty(spark, str(tmp_path / "none"), like).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        sinks.read_or_empty(spark, str(tmp_path / "bad"), like).count()


def test_breaks_are_flagged_and_nothing_is_left_out(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, k), float(k)) for k in range(1, 6)], "period date, value double")
    c = spark.createDataFrame([("fair", dt.date(2024, 1, 2), dt.date(2024, 1, 3), False), ("cap", dt.date(2024, 1, 3), dt.date(2024, 1, 3), True), ("band", dt.date(2024, 1, 5), None, True)], "name string, starts date, ends date, breaks boolean")
    got = [(r.value, r.events, r.structural_break, r.regime) for r in validate.annotated(s, c).orderBy("period").collect()]
    assert got == [(1.0, None, False, 0), (2.0, "fair", False, 0), (3.0, "cap,fair", True, 1), (4.0, None, False, 1), (5.0, "band", True, 2)]


def test_ranks_compare_routes(spark):
    ours = [(r, dt.date(2024, m, 1), 100.0 * r + m) for r in (1, 2, 3) for m in (1, 2)]
    theirs = [(r, p, {1: 10.0, 2: 30.0, 3: 20.0}[r] + p.month) for r, p, _ in ours]
    f = lambda x: spark.createDataFrame(x, "route int, period date, value double")
    r = validate.scores(f(ours), f(theirs), ["route"]).first()
    assert abs(r.spearman - 0.5) < 1e-9 and r.direction == 1.0
