"""Column functions of the source documents: money, fare levels, fuel bands, city pairs, tax."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the rate that the filed documents state.
GST_RATE = 0.05


def city_split(text: Column, known: Column) -> Column:
    """struct(origin, destination) of the one split whose halves are both known names; null where there is none or several."""
    t = F.split(F.trim(text), r"\s+")
    cut = F.transform(F.sequence(F.lit(1), F.size(t) - 1), lambda i: F.struct(F.array_join(F.slice(t, F.lit(1), i), " ").alias("origin"), F.array_join(F.slice(t, i + 1, F.size(t)), " ").alias("destination")))
    good = F.filter(cut, lambda p: F.array_contains(known, p["origin"]) & F.array_contains(known, p["destination"]))
    return F.when(F.size(t) > 1, F.when(F.size(good) == 1, good[0]))


def fare_levels(text: Column) -> Column:
    """Array of decimals in filed order; NA is null."""
    return F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.try_cast("decimal(10,2)"))


def money(text: Column) -> Column:
    """Digits and points of the text as a decimal; null where nothing numeric is left."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\d.]", "").try_cast("decimal(10,2)")


def fuel_band(text: Column) -> Column:
    """struct(lo, hi) of `Less than N`, `A - B` or `N+`; hi is null for the open band, all null for other text."""
    g = lambda p, i=1: F.regexp_extract(text, p, i).try_cast("int")
    less, lo, hi, plus = g(r"^\s*Less than\s*(\d+)\s*$"), g(r"^\s*(\d+)\s*-\s*(\d+)\s*$"), g(r"^\s*(\d+)\s*-\s*(\d+)\s*$", 2), g(r"^\s*(\d+)\s*\+\s*$")
    return F.struct(F.when(less.isNotNull(), 0).otherwise(F.coalesce(lo, plus)).alias("lo"), F.coalesce(less - 1, hi).alias("hi"))


def gst_and_total(base: Column, udf: Column, asf: Column, rcs_cute: Column, yq: Column) -> tuple[Column, Column]:
    """Tax on base and airport charges, rounded half up to cents; the fuel surcharge stays outside it."""
    taxable = (base + udf + asf + rcs_cute).cast("decimal(12,2)")
    gst = F.round(taxable * F.lit(GST_RATE).cast("decimal(3,2)"), 2)
    return gst.cast("decimal(12,2)"), (taxable + yq.cast("decimal(12,2)") + gst).cast("decimal(12,2)")
