"""Queries against their SQL over small tables with values that the given small tables lack."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalog import SF, rows

import __spark_entry__ as entry
from plumbline import catalog
from plumbline.plans import spool
from plumbline.sources import driver_tables, sinks


@pytest.fixture
def events(tmp_path):
    """Writes events(event_id, ts, user_id, event_type, value) to a folder of tables and returns it."""

    def make(*data):
        con = duckdb.connect()
        con.sql("create table e (event_id bigint, ts timestamp, user_id bigint, event_type varchar, value double)")
        con.executemany("insert into e values (?, ?, ?, ?, ?)", [list(r) for r in data])
        con.sql(f"copy e to '{tmp_path}/events.parquet' (format parquet)")
        return str(tmp_path)

    return make


def same(spark, folder, name, tables=("events",)):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df, want = catalog.queries()[name](spark, folder), con.sql(entry.oracle_sql()[name])
    got = rows(df.columns, df.collect())
    assert got == rows(want.columns, want.fetchall())
    return got[1]


DAY = dt.datetime(2024, 1, 5, 8)


def test_a_fare_of_zero_hides_no_other_quote_of_a_source(spark, events):
    # event 1 and 13: source 1, the same product and day; event 5: source 2
    folder = events((1, DAY, 0, "view", 0.0), (13, DAY, 0, "view", 20.0), (5, DAY, 0, "view", 10.0))
    assert len(same(spark, folder, "j13_source_agreement")) == 1


def test_the_cheapest_offer_has_a_fare_above_zero(spark, events):
    # events 1, 5 and 7 are non-stop offers of route 0, 10 of route 1: a page whose only non-stop offer costs nothing has none
    folder = events((1, DAY, 0, "view", 0.0), (5, DAY, 0, "view", 30.0), (7, DAY, 0, "view", 20.0), (10, DAY, 1, "view", 0.0))
    assert [r for r in same(spark, folder, "s5_f15_f18_a20_a21_offers") if "no_nonstop" in r and "R1A/2024-01-05/0" in r]


def test_spooled_runs_keep_their_order_within_a_millisecond(spark, events):
    # one key: the run of event 7 starts 300 microseconds after that of event 20,011, so the latter's quote is the one that lands
    late, early = DAY + dt.timedelta(microseconds=500), DAY + dt.timedelta(microseconds=200)
    folder = events((7, late, 0, "view", 20.0), (20_011, early, 5, "view", 10.0))
    got = same(spark, folder, "t1_s8_k7_spool_ingest")
    assert len(got) == 1 and len(same(spark, folder, "k7_k2_runs_with_quotes")) == 2


ONCE = ["m6_expenditure_shares", "a32_weight_report", "a16_j11_basket_shares", "a18_load_gates", "s10_seed_routes", "f3_f5_j6_j7_j8_j9_quotes"]  # queries that read the traffic or the tariff sheets more than once


@pytest.mark.parametrize("name", ONCE)
def test_order_lines_are_joined_once(spark, name):
    assert not [f for f in catalog.queries()[name](spark, SF).inputFiles() if "lineitem" in f]


def test_an_order_line_is_shuffled_once(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, 100_000)  # suppliers and nations fit, orders and customers do not
    try:
        plan = driver_tables.flows(spark, "/root/testdata/sf0.1")._jdf.queryExecution().executedPlan().toString()
        assert sum("hashpartitioning(l_" in x for x in plan.splitlines()) == 1
    finally:
        spark.conf.set(key, before)


def test_files_of_spooled_runs_follow_the_days_not_the_partitions(spark, tmp_path):
    day = F.timestamp_seconds(F.lit(1704441600) + F.col("id") % 3 * 86400)
    runs = spark.range(0, 240, 1, 16).select(F.col("id").cast("string").alias("run_id"), F.lit(1).alias("source"), day.alias("started_at"), F.lit("failed").alias("status"), F.lit(False).alias("selector_relocated"), F.lit("").alias("notes"))
    spool.write_runs(runs, str(tmp_path / "spool"))
    assert len(list((tmp_path / "spool").glob("of=*/*.json"))) <= 8 + 3  # partitions of the exchange, and one more for each day


def test_payloads_land_as_a_file_a_prefix(spark, tmp_path):
    files = spark.range(0, 2000, 1, 8).select(F.col("id").cast("string").cast("binary").alias("content"))
    assert sinks.land_payloads(files, str(tmp_path / "landing")) == 2000
    folders = list((tmp_path / "landing").glob("prefix=*"))
    assert len(list((tmp_path / "landing").glob("prefix=*/*.parquet"))) == len(folders)
