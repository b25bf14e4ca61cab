"""From source documents to quotes: tariff lines, charge cells, offer pages, fare construction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import city_split, fare_levels, fuel_band, gst_and_total, money  # noqa: F401
from ..schemas import OFFER_PAGE

# The banners and row forms of the filed documents.
TERMINATORS = ("PREMIUM ECONOMY", "BUSINESS AND FIRST", "FIRST-CLASS BASE FARE", "OTHER RULES", "TAXES/FEES/CHARGES")
ECONOMY = "ECONOMY BASE FARE"
FARE_ROW = r"^\s*(\d+)\s+(.+?)\s*(\d+)\s+(Minimum|Maximum)\s+([\d\sNA]+)$"
PAIR_ROW = r"^(.+?) \x{2212} (.+?) (Maximum|Minimum) (\d+) (.+)$"
MIN_UDF_ROWS = 20


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, line): trimmed lines that are not empty, numbered as in the text."""
    out = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    return out.withColumn("line", F.trim("line")).filter("line <> ''")


def carried_section(df: DataFrame, header: Column) -> DataFrame:
    """Adds `section`: the last header at or before each line of its document. header is null on other lines."""
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("section", F.last(header, ignorenulls=True).over(w))


def economy_lines(df: DataFrame) -> DataFrame:
    """Lines between an economy banner and the next banner of another section; sub-headings do not end it."""
    up = F.upper("line")
    ends = up.contains(TERMINATORS[0])
    for t in TERMINATORS[1:]:
        ends = ends | up.contains(t)
    header = F.when(up.contains(ECONOMY), "economy").when(ends, "other")
    return carried_section(df.withColumn("header", header), F.col("header")).filter("section = 'economy' and header is null").drop("header", "section")


def tariff_rows(df: DataFrame, cities: DataFrame) -> DataFrame:
    """(doc_id, line_no, origin, destination, distance, band_type, fares, skipped) of the economy fare rows.

    cities(city) is a vocabulary of airports, collected to one row; rows whose cities cannot be split surely are skipped.
    """
    g = lambda i: F.regexp_extract("line", FARE_ROW, i)
    vocabulary = cities.agg(F.collect_set("city").alias("known"))
    rows = economy_lines(df).filter(F.col("line").rlike(FARE_ROW)).crossJoin(F.broadcast(vocabulary))
    rows = rows.withColumn("pair", city_split(g(2), F.col("known")))
    return rows.select("doc_id", "line_no", "pair.origin", "pair.destination", g(3).cast("int").alias("distance"), g(4).alias("band_type"), fare_levels(g(5)).alias("fares"), F.col("pair").isNull().alias("skipped"))


def pair_rows(df: DataFrame) -> DataFrame:
    """The other layout: `A − B Minimum 1148 900 NA 1200` with a real minus sign, one title line per section."""
    header = F.when(F.upper("line").contains("FARES") & ~F.col("line").contains("Route") & ~F.col("line").rlike(PAIR_ROW), F.col("line"))
    g = lambda i: F.regexp_extract("line", PAIR_ROW, i)
    rows = carried_section(df, header).filter(F.col("line").rlike(PAIR_ROW) & F.col("section").isNotNull())
    return rows.select("doc_id", "line_no", "section", g(1).alias("origin"), g(2).alias("destination"), g(3).alias("band_type"), g(4).cast("int").alias("distance"), fare_levels(g(5)).alias("fares"))


def lowest_filed(rows: DataFrame) -> DataFrame:
    """(doc_id, origin, destination, fare): the first filed level of the first Minimum row of a pair."""
    level = F.filter("fares", lambda x: x.isNotNull())[0]
    return rows.filter("band_type = 'Minimum'").withColumn("level", level).filter("level is not null").groupBy("doc_id", "origin", "destination").agg(F.min_by("level", "line_no").alias("fare"))


def fare_ladder(rows: DataFrame) -> DataFrame:
    """(doc_id, origin, destination, band_type, level, fare): every filed level as research data."""
    return rows.select("doc_id", "origin", "destination", "band_type", F.posexplode("fares").alias("pos", "fare")).filter("fare is not null").withColumn("level", F.col("pos") + 1).drop("pos")


def charge_rows(cells: DataFrame) -> DataFrame:
    """cells(doc_id, row_no, cells array<string>) -> (doc_id, row_no, kind, key, lo, hi, amount).

    Rows of five cells are classified by their label, else by shape: one city to All is a departure fee, All to a starred code
    an arrival fee. Rows of two cells are fuel bands. Rows without an amount are not filed, which is not zero.
    """
    c = F.transform("cells", lambda x: F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), "\n", " ")))
    df = cells.withColumn("c", c)
    label = F.upper(F.concat_ws(" ", F.get("c", F.lit(0)), F.get("c", F.lit(1))))
    frm, to = F.get("c", F.lit(2)), F.get("c", F.lit(3))
    wide = F.size("c") >= 5
    band = fuel_band(F.get("c", F.lit(0)))
    kind = (
        F.when(wide & (label.contains("ASF") | label.contains("SECURITY FEE")), "asf")
        .when(wide & label.contains("CUTE"), "cute")
        .when(wide & (label.contains("RCS") | label.contains("REGIONAL CONNECTIVITY")), "rcs")
        .when(wide & (label.contains("PSF") | label.contains("PASSENGER SERVICE")), None)
        .when(wide & (to == "All") & (frm != "") & (frm != "All") & ~frm.contains(","), "departure")
        .when(wide & (frm == "All") & to.endswith("*"), "arrival")
        .when((F.size("c") == 2) & band["lo"].isNotNull(), "fuel")
    )
    amount = F.when(wide, money(F.get("c", F.lit(4)))).otherwise(money(F.get("c", F.lit(1))))
    key = F.when(kind == "departure", frm).when(kind == "arrival", F.regexp_replace(to, r"\*+$", ""))
    out = df.select("doc_id", "row_no", kind.alias("kind"), key.alias("key"), F.when(kind == "fuel", band["lo"]).alias("lo"), F.when(kind == "fuel", band["hi"]).alias("hi"), amount.alias("amount"))
    return out.filter("kind is not null and amount is not null")


def schedule_report(charges: DataFrame) -> DataFrame:
    """(doc_id, n_departure, complete, collapsed): whether the three flat charges are filed and the departure block is whole."""
    has = lambda k: F.bool_or(F.col("kind") == k)
    n = F.count_if(F.col("kind") == "departure")
    return charges.groupBy("doc_id").agg(n.alias("n_departure"), (has("asf") & has("rcs") & has("cute")).alias("complete"), (n < MIN_UDF_ROWS).alias("collapsed"))


def of_sheet(rows: DataFrame, table: DataFrame, *keys: str) -> list[str]:
    """The keys by which a table of charges is joined to rows: by sheet if both name theirs in doc_id, else one sheet holds for all."""
    return [*(["doc_id"] if "doc_id" in rows.columns and "doc_id" in table.columns else []), *keys]


def in_band(df: DataFrame, bands: DataFrame, distance: str = "distance") -> DataFrame:
    """df with carrier_charges, the amount of the filed band that holds the distance; a gap between bands gives null, never a guess.

    bands(lo, hi, amount) is one list, a handful of rows, and broadcast. With a doc_id each sheet has its own list, which is
    gathered into one row a sheet and joined by the sheet; of bands that overlap in one sheet the one with the lowest `lo` counts.
    """
    keys = of_sheet(df, bands)
    if not keys:
        b = F.broadcast(bands.select(F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col("amount").alias("carrier_charges")))
        on = (F.col(distance) >= F.col("__lo")) & (F.col("__hi").isNull() | (F.col(distance) <= F.col("__hi")))
        return df.join(b, on, "left").drop("__lo", "__hi")
    lists = bands.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "amount"))).alias("__bands"))
    fits = F.filter("__bands", lambda x: (F.col(distance) >= x["lo"]) & (x["hi"].isNull() | (F.col(distance) <= x["hi"])))
    return df.join(lists, keys, "left").withColumn("carrier_charges", F.get(fits, F.lit(0))["amount"]).drop("__bands")


def with_fees(df: DataFrame, departure: DataFrame, arrival: DataFrame) -> DataFrame:
    """Adds udf: departure(city, fee) of the origin plus arrival(code, fee) of the destination, of the row's own sheet where they
    have a doc_id; unfiled counts 0 in this sum. A fee that a sheet files twice counts once, the lower one."""
    out = df
    for fees, place, end, name in ((departure, "city", "origin", "__d"), (arrival, "code", "destination", "__a")):
        keys = of_sheet(df, fees, place)
        one = fees.groupBy(*keys).agg(F.min("fee").alias(name)).withColumnRenamed(place, end)
        out = out.join(one if "doc_id" in keys else F.broadcast(one), [*keys[:-1], end], "left")  # one sheet is short
    return out.withColumn("udf", F.coalesce("__d", F.lit(0)) + F.coalesce("__a", F.lit(0))).drop("__d", "__a")


def sheets_on(days: DataFrame, sheets: DataFrame) -> DataFrame:
    """days(carrier, day) -> (carrier, day, doc_id): the carrier's sheet that is valid on the day, the latest issued one of several
    (then the greatest doc_id). Days without a valid sheet do not occur.

    sheets(doc_id, carrier, issued, valid_from, valid_until), open at an end that is null. Validity and day meet on equal
    months, so a day is compared with the sheets of its month and not with all.
    """
    span = days.agg(F.trunc(F.min("day"), "MM").alias("__from"), F.trunc(F.max("day"), "MM").alias("__to"))
    lo, hi = F.greatest(F.trunc("valid_from", "MM"), "__from"), F.least(F.trunc("valid_until", "MM"), "__to")
    months = F.explode(F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>")))
    by_month = sheets.crossJoin(F.broadcast(span)).withColumn("__month", months)  # one row of two dates
    both = days.withColumn("__month", F.trunc("day", "MM")).join(by_month, ["carrier", "__month"])
    valid = both.filter((F.col("valid_from").isNull() | (F.col("day") >= F.col("valid_from"))) & (F.col("valid_until").isNull() | (F.col("day") <= F.col("valid_until"))))
    return valid.groupBy("carrier", "day").agg(F.max(F.struct("issued", "doc_id"))["doc_id"].alias("doc_id"))


def both_directions(df: DataFrame, a: str = "origin", b: str = "destination") -> DataFrame:
    """Each filed pair as two directed rows."""
    ways = F.array(F.struct(F.col(a).alias("o"), F.col(b).alias("d")), F.struct(F.col(b).alias("o"), F.col(a).alias("d")))
    return df.withColumn("__w", F.explode(ways)).withColumn(a, F.col("__w.o")).withColumn(b, F.col("__w.d")).drop("__w")


def unordered_match(basket: DataFrame, filed: DataFrame) -> DataFrame:
    """Basket routes with the filed row of either order."""
    k = lambda df: df.withColumn("__a", F.least("origin", "destination")).withColumn("__b", F.greatest("origin", "destination"))
    return k(basket).join(k(filed).drop("origin", "destination"), ["__a", "__b"]).drop("__a", "__b")


STATE = r'(?s)<script id="state" type="application/json">(.*?)</script>'


def journeys(pages: DataFrame) -> DataFrame:
    """pages(page_id, origin, destination, collection_ts, html) -> one row per offered journey, or a shape_error row.

    A page without its state blob, or with one of another shape, is an error row and not a page without offers.
    """
    doc = F.from_json(F.nullif(F.regexp_extract("html", STATE, 1), F.lit("")), OFFER_PAGE)
    df = pages.withColumn("j", F.flatten(doc["allJourneys"])).withColumn("shape_error", F.col("j").isNull())
    df = df.select("page_id", "origin", "destination", "collection_ts", "shape_error", F.posexplode_outer("j").alias("pos", "j"))
    legs = F.split(F.get("j.journeyKeys", F.lit(0)), r"\|")
    key = F.split(F.get("j.journeyKeys", F.lit(0)), r"\$")
    strip = lambda x: F.trim(F.regexp_replace(x, "<[^>]+>|₹", ""))
    base = F.filter("j.fareBreakup.fareBreakUpItems", lambda x: F.lower(strip(x["text"])).contains("base fare"))
    number = F.regexp_replace(F.regexp_extract(strip(F.get(base, F.lit(0))["amount"]), r"([\d,]+(?:\.\d+)?)", 1), ",", "")
    return df.select(
        "page_id", "origin", "destination", "collection_ts", "shape_error", "pos", F.size(legs).alias("n_legs"), F.get(key, F.lit(0)).alias("leg_origin"), F.get(key, F.lit(1)).alias("leg_destination"),
        F.try_to_timestamp(F.get(key, F.lit(2)), F.lit("yyyy-MM-dd HH:mm")).alias("departs_local"), F.get(key, F.lit(3)).alias("flight"), F.col("j.fare").alias("fare"),
        F.coalesce(F.get("j.airlineCodes", F.lit(0)), F.split(F.get(key, F.lit(3)), "-")[0]).alias("carrier"), number.try_cast("decimal(10,2)").alias("base_fare"),
    )


def cheapest_offers(df: DataFrame) -> DataFrame:
    """One row per page: the cheapest non-stop journey of exactly its airport pair that has a fare above zero and a departure,
    first on ties, with a plausible lead time; else the reason. The lead time runs from the UTC collection day to the local departure day."""
    mine = (F.col("n_legs") == 1) & (F.col("leg_origin") == F.col("origin")) & (F.col("leg_destination") == F.col("destination"))
    good = mine & (F.col("fare") > 0) & F.col("departs_local").isNotNull()
    best = F.min(F.when(good, F.struct("fare", "pos", "carrier", "base_fare", "departs_local")))
    other = (F.col("n_legs") == 1) & ~mine
    out = df.groupBy("page_id", "origin", "destination", "collection_ts").agg(
        best.alias("b"), F.bool_or("shape_error").alias("shape_error"), F.count("pos").alias("n_journeys"), F.count_if(F.col("n_legs") > 1).alias("connections"), F.count_if(other).alias("other_airports")
    )
    lead = F.datediff(F.to_date("b.departs_local"), F.to_date("collection_ts"))
    out = out.withColumn("lead_days", lead)
    reason = F.when(F.col("shape_error"), "shape_error").when(F.col("n_journeys") == 0, "no_journeys").when(F.col("b").isNull(), "no_nonstop").when(~F.col("lead_days").between(0, 365), "implausible_lead")
    return out.select("page_id", "origin", "destination", "b.fare", "b.carrier", "b.base_fare", "lead_days", "n_journeys", "connections", "other_airports", reason.alias("reason"))


# How the documents write their dates, and the age from which an issue stamp counts as old.
ISSUE_STAMP = r"(\d{4}[\x{2212}-]\d{2}[\x{2212}-]\d{2} \d{2}:\d{2}:\d{2})"
CREATION_STAMP = r"D:(\d{14})([+-])(\d{2})'(\d{2})"
VALIDITY_END = r"(?i)period\s+W\.I\.E\.\s+till\s+(\d{1,2})\w{0,2}\s+([a-z]{3})[a-z]*\s+(\d{4})"
MAX_AGE_DAYS = 75
ANCHOR_DAYS = 30
FILED_CLASS = "filed_base"


def document_dates(df: DataFrame, text: str = "text", collected: str = "collection_ts", max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Adds issued, created (both UTC), valid_until, aged and expired from the stamps in a document's text.

    aged: whole days from issue to collection are more than max_age_days; expired: the collection day is past the validity.
    A stamp that is missing or broken is null, never the present, and what is decided from it is null too.
    """
    issued = F.try_to_timestamp(F.translate(F.regexp_extract(text, ISSUE_STAMP, 1), "\u2212", "-"), F.lit("yyyy-MM-dd HH:mm:ss"))
    part = lambda i: F.regexp_extract(text, CREATION_STAMP, i)
    sign = F.when(part(2) == "-", -1).otherwise(1)
    offset = F.make_dt_interval(hours=sign * part(3).try_cast("int"), mins=sign * part(4).try_cast("int"))
    created = F.try_to_timestamp(part(1), F.lit("yyyyMMddHHmmss")) - offset
    until = F.concat_ws(" ", *[F.initcap(F.regexp_extract(text, VALIDITY_END, i)) for i in (1, 2, 3)])
    until = F.to_date(F.try_to_timestamp(until, F.lit("d MMM yyyy")))
    out = df.withColumn("issued", issued).withColumn("created", created).withColumn("valid_until", until)
    days = F.floor((F.unix_seconds(F.col(collected)) - F.unix_seconds("issued")) / 86400)
    return out.withColumn("aged", days > max_age_days).withColumn("expired", F.to_date(collected) > F.col("valid_until"))


def anchor_departure(collected: Column, days: int = ANCHOR_DAYS) -> Column:
    """The departure day of a fare that is filed without a travel date: a fixed lead after the UTC day of collection."""
    return F.date_add(F.to_date(collected), days)


def flat_charges(charges: DataFrame) -> DataFrame:
    """(doc_id, asf, rcs_cute) of documents that file all three flat charges; a document that lacks one gets no total at all."""
    of = lambda kind: F.first(F.when(F.col("kind") == kind, F.col("amount")), ignorenulls=True)
    out = charges.groupBy("doc_id").agg(of("asf").alias("asf"), of("rcs").alias("rcs"), of("cute").alias("cute")).filter("asf is not null and rcs is not null and cute is not null")
    return out.select("doc_id", "asf", (F.col("rcs") + F.col("cute")).alias("rcs_cute"))


def fare_quotes(filed: DataFrame, flat: DataFrame, bands: DataFrame, departure: DataFrame, arrival: DataFrame) -> DataFrame:
    """filed(doc_id, origin, destination, distance, base_fare, collection_ts) -> one decomposed quote per direction.

    Fuel comes from the band of the distance: without a band there is no total, hence no quote. Fees of departure(city, fee)
    and arrival(code, fee) that are not filed count 0; flat(doc_id, asf, rcs_cute) holds one row a document. Where bands and
    fees have a doc_id, each sheet is priced by its own; sheets_on() says which sheet counts on a day.
    """
    q = in_band(filed, bands).filter("carrier_charges is not null").join(flat, "doc_id")
    q = with_fees(both_directions(q), departure, arrival).withColumn("udf", F.col("udf").cast("decimal(10,2)"))
    gst, total = gst_and_total(F.col("base_fare"), F.col("udf"), F.col("asf"), F.col("rcs_cute"), F.col("carrier_charges"))
    return q.select(
        "doc_id", "origin", "destination", anchor_departure(F.col("collection_ts")).alias("departure_date"), "collection_ts", F.lit(ANCHOR_DAYS).alias("advance_purchase_days"), F.lit(FILED_CLASS).alias("fare_class"),
        F.lit(True).alias("is_nonstop"), "base_fare", "udf", "asf", F.col("rcs_cute").alias("rcs_levy"), "carrier_charges", gst.alias("gst"), total.alias("total_fare"), F.lit("observed").alias("observation_status"),
    )


def page_state(pages: DataFrame, pattern: str = STATE) -> DataFrame:
    """pages(page_id, html) -> (page_id, hash, state): the payload's SHA-256 and the state blob, null where the page has none."""
    return pages.select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("hash"), F.nullif(F.regexp_extract("html", pattern, 1), F.lit("")).alias("state"))
