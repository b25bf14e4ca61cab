"""The driver contract: every query has a callable, and a sample of them agrees with its SQL on the smallest tables."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from plumbline import catalog

SF = "/root/testdata/sf0.001"
SAMPLE = ["flagship_index", "a5_a7_outlier_flags", "a22_run_report", "a16_j11_basket_shares", "a26_alerts", "w4_missed_spans", "s5_f15_f18_a20_a21_offers", "f8_f9_f14_tariff_rows", "f3_f5_j6_j7_j8_j9_quotes", "q1_index", "k1_k2_append_if_absent", "f5_f19_document_dates", "k4_f4_published_values", "k6_weights_write_back", "q10_quality_panel", "q12_audit_trail", "m3_rolling_geks", "t2_daily_yield"]


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(float(v), 6) if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else v
    return sorted(columns), sorted(([plain(r[i]) for i in order] for r in data), key=str)


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = catalog.queries()[name](spark, SF)
    want = con.sql(catalog.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(catalog.queries()) > 90
