"""End-to-end loads of landed payloads into keyed tables: US listing pages, CO listing cards, US crime.

Each load parses a batch, merges it into its ``BucketTable`` and gives one summary row (a24): source, inserted, updated, failed and
status. Parsing, deduplication and merge are one pass over the batch; the numbers are observed by the merge's write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..sources import html, payloads
from ..sources.buckets import BucketTable

SUMMARY = "source string, inserted long, updated long, failed long, skipped long, status string"
LISTINGS_US = ("listing_id string, source string, scraped_at timestamp, address string, city string, state string, zip string, lat double, lon double, "
               "price_usd bigint, bedrooms int, bathrooms double, sqft int, price_per_sqft_usd double, property_type string, description string, "
               "listing_url string, days_on_market int, listing_date date, page_id string")
PAGES_US = "page_id string, raw_json string"
LISTINGS_CO = ("listing_id string, source string, scraped_at timestamp, address string, city string, departamento string, barrio string, lat double, lon double, "
               "price_cop bigint, bedrooms int, bathrooms double, area_m2 double, property_type string, description string, listing_url string, raw_html string")
CRIME_US = ("incident_id string, source string, city string, state string, zip string, lat double, lon double, crime_type string, crime_category string, "
            "incident_date date, year int, ingested_at timestamp")
REFRESHED_US = ["price_usd", "price_per_sqft_usd", "days_on_market", "scraped_at"]
REFRESHED_CO = ["scraped_at", "address", "barrio", "price_cop", "bedrooms", "bathrooms", "area_m2", "property_type", "description", "listing_url"]
AREA_REQUIRED = ["price_cop", "area_m2"]


def _stamp(at: str) -> Column:
    return F.lit(at).cast("timestamp")


def summary_rows(spark: SparkSession, counts: Sequence[tuple[str, dict[str, int]]]) -> DataFrame:
    """a24: one row a load; a load with no usable row has failed."""
    rows = [(s, c["inserted"], c["updated"], c["failed"], c["skipped"], "failed" if c["staged"] - c["failed"] <= 0 else "ok") for s, c in counts]
    return spark.createDataFrame(rows, SUMMARY)


def load_listings_us(table: BucketTable, pages_table: BucketTable, pages: DataFrame, payload_col: str, source: str, at: str, order_by: Sequence[str] = ()) -> dict[str, int]:
    """Pages of listings: every page is kept once, by its digest, and its listings name it. Known listings have their price, price an area,
    days on the market and time refreshed; ``order_by`` names columns of ``pages`` by which a batch's later rows win."""
    landed = pages.select(F.sha2(payload_col, 256).alias("page_id"), F.col(payload_col).alias("raw_json"), *order_by)
    # equal pages hold equal listings, the last of them wins: the batch is read once and parsed from its stage
    staged, distinct, _ = pages_table.stage(landed, order_by)
    pages_table.merge_staged(staged, update=[])
    parsed = payloads.parse_listing_pages(distinct, "raw_json", keep=["page_id", *order_by], position="place").drop("raw_json")
    rows = parsed.withColumns({"source": F.lit(source), "scraped_at": _stamp(at)})
    return table.merge(rows, update=REFRESHED_US, order_by=[*order_by, "place"], failed=F.col("price_usd").isNull())


def load_listings_co(table: BucketTable, pages: DataFrame, html_col: str, source: str, city: str, departamento: str, at: str, base_url: str = "",
                     order_by: Sequence[str] = ()) -> dict[str, int]:
    """Cards of listing pages. A card's HTML is kept for new listings and for cards that lack a required field, and cleared when a
    known listing is refreshed whole; a refresh leaves city, department and coordinates as they are."""
    cards = html.extract_cards(pages, html_col, keep=list(order_by), base_url=base_url, raw="raw_html")
    rows = cards.withColumnRenamed("title", "description").withColumns({
        "source": F.lit(source), "scraped_at": _stamp(at), "city": F.lit(city), "departamento": F.lit(departamento),
        "lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    bad = F.lit(False)
    for c in AREA_REQUIRED:
        bad = bad | F.col(f"s.{c}").isNull()
    update = {c: F.col(f"s.{c}") for c in REFRESHED_CO} | {"raw_html": F.when(bad, F.col("s.raw_html"))}
    missing = F.lit(False)
    for c in AREA_REQUIRED:
        missing = missing | F.col(c).isNull()
    return table.merge(rows, update=update, order_by=list(order_by), failed=missing)


def agency_rows(agencies: DataFrame, counts: DataFrame, years: Sequence[int], at: str) -> DataFrame:
    """One row an agency, year and offence with a positive count. ``agencies``: ori, city, state, lat, lon; ``counts``: ori, offense and the
    landed ``payload`` of its counts."""
    total = payloads.sum_counts_of_years(counts, "payload", [str(y) for y in years], keep=["ori", "offense"]).withColumn("year", F.col("year").cast("int"))
    found = total.where(F.col("total") > 0).join(agencies.where(F.col("ori").isNotNull()), "ori")
    return found.select(
        F.concat_ws("_", F.lit("fbi"), "ori", F.col("year").cast("string"), "offense").alias("incident_id"), F.lit("fbi_ucr").alias("source"), "city", "state",
        F.lit(None).cast("string").alias("zip"), "lat", "lon", F.col("offense").alias("crime_type"), labels.crime_category_fbi("offense").alias("crime_category"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("incident_date"), F.col("year").cast("int").alias("year"), _stamp(at).alias("ingested_at"))


def incident_rows(feed: DataFrame, payload_col: str, city: str, state: str, at: str) -> DataFrame:
    """The incidents of a city's landed feed."""
    return payloads.parse_incidents(feed, payload_col, keep=[city, state]).select(
        F.concat_ws("_", F.lit("sc"), "incident_id").alias("incident_id"), F.lit("spotcrime").alias("source"), F.col(city).alias("city"), F.col(state).alias("state"),
        F.lit(None).cast("string").alias("zip"), "lat", "lon", "crime_type", "crime_category", "incident_date", F.col("year").cast("int").alias("year"),
        _stamp(at).alias("ingested_at"))


def load_crime_us(table: BucketTable, rows: DataFrame) -> dict[str, int]:
    """Agency or incident rows: known incidents are replaced whole."""
    return table.merge(rows, failed=F.col("incident_date").isNull())
