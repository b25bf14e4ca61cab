"""Declared schemas of the engine's tables; readers always pass them. Names and types of shared tables are fixed values."""

from __future__ import annotations

FARE_QUOTE = (
    "quote_id long, source string, carrier string, origin string, destination string, route_id int, departure_date date, "
    "collection_ts timestamp, advance_purchase_days int, fare_class string, base_fare decimal(10,2), carrier_charges decimal(10,2), "
    "udf decimal(10,2), asf decimal(10,2), rcs_levy decimal(10,2), gst decimal(10,2), total_fare decimal(10,2), "
    "observation_status string, exclusion_reason string, outlier_flag boolean, raw_payload_hash string, run_id string, created_at timestamp"
)
COLLECTION_RUN = "run_id string, source string, started_at timestamp, status string, selector_relocated boolean, notes string"
ROUTE = "route_id int, origin string, destination string, stratum_class string, active boolean, weight double, weight_basis string, weight_source string, weight_start date, weight_end date"
STRATUM_PANEL = "period date, route_id int, apd int, jevons double, n_observed int, n_imputed int, coverage double, suppressed boolean"
INDEX_VALUE = "vintage_id string, series_id string, frequency string, period date, value double, coverage double, suppressed boolean, low double, high double, published_at timestamp"
SPOOLED_RUN = (
    "run_id string, source string, started_at timestamp, finished_at timestamp, status string, selector_relocated boolean, notes string, "
    "quotes array<struct<quote_id:long,source:string,carrier:string,route_id:int,apd:int,fare_class:string,collection_ts:timestamp,total_fare:string>>"
)
OFFER_PAGE = (
    "allJourneys array<array<struct<fare:double,airlineCodes:array<string>,journeyKeys:array<string>,"
    "fareBreakup:struct<fareBreakUpItems:array<struct<text:string,amount:string>>>>>>"
)
TRAFFIC_CSV = ("Year", "Month", "City1", "City2", "PaxToCity2", "PaxFromCity2")

#: Key of a quote; a missing fare class is a class of its own, and the day is the UTC day of collection.
QUOTE_KEY = ("source", "carrier", "route_id", "departure_date", "apd", "fare_class", "period")
