"""Registered end-to-end loads (k03, k06, k11, k12, a24 over s07, s10, s11, s15, s22): landed batches merged into bucketed tables."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.buckets import BucketTable
from ..sources.tables import Tables
from . import loads
from .catalog import O, register
from .catalog_sources import card_pages, incident_feeds, listing_pages

FIRST, SECOND = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
BUCKETS = 16


def _table(spark, name: str, schema: str, keys: list[str]) -> BucketTable:
    return BucketTable(spark, scratch_path(spark, f"load_{name}_{uuid.uuid4().hex}"), schema, keys, BUCKETS)


def _us(spark, d):
    """Orders up to 1995 land first, then those from 1995 on with another price."""
    o = Tables.shared(spark, d).orders
    table, pages = _table(spark, "us", loads.LISTINGS_US, ["listing_id"]), _table(spark, "pages", loads.PAGES_US, ["page_id"])
    early = listing_pages(o.where("o_orderdate < '1996-01-01'"))
    late = listing_pages(o.where("o_orderdate >= '1995-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1000))
    counts = [("us_first", loads.load_listings_us(table, pages, early, "payload", "zillow", FIRST)),
              ("us_second", loads.load_listings_us(table, pages, late, "payload", "zillow", SECOND))]
    return table, pages, counts


def _co(spark, d):
    """Two overlapping sets of cards."""
    p = Tables.shared(spark, d).part
    table = _table(spark, "co", loads.LISTINGS_CO, ["listing_id", "source"])
    counts = [(f"co_{n}", loads.load_listings_co(table, card_pages(p.where(f"p_partkey % {m} {c} 0")), "html", "fincaraiz", "Bogota", "Cundinamarca", at, "https://base.co"))
              for n, m, c, at in (("first", 3, "<>", FIRST), ("second", 2, "=", SECOND))]
    return table, counts


OFFENSES = {"A": "homicide", "N": "burglary", "R": "larceny"}


def _crime(spark, d):
    """Agency counts of two overlapping spans of years, then incident feeds."""
    t = Tables.shared(spark, d)
    table = _table(spark, "crime", loads.CRIME_US, ["incident_id"])
    agencies = t.supplier.select(F.concat(F.lit("ORI"), "s_suppkey").alias("ori"), F.col("s_name").alias("city"), F.concat(F.lit("S"), "s_nationkey").alias("state"),
                                 F.col("s_acctbal").cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"))
    offense = F.lit(None).cast("string")
    for flag, kind in OFFENSES.items():
        offense = F.when(F.col("l_returnflag") == flag, F.lit(kind)).otherwise(offense)
    per = t.lineitem.groupBy("l_suppkey", offense.alias("offense"), F.year("l_shipdate").alias("y")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    actuals = per.groupBy("l_suppkey", "offense").agg(F.map_from_entries(F.collect_list(F.struct(F.col("y").cast("string").alias("y"), "n"))).alias("years"))
    landed = scratch_path(spark, f"load_counts_{uuid.uuid4().hex}")          # two loads read the counts
    counts = actuals.select(F.concat(F.lit("ORI"), "l_suppkey").alias("ori"), "offense",
                            F.to_json(F.struct(F.struct(F.create_map(F.lit("all"), "years").alias("actuals")).alias("offenses"))).alias("payload"))
    counts.write.parquet(landed)
    counts = spark.read.schema(counts.schema).parquet(landed)
    user = F.col("user_id")
    feeds = incident_feeds(t.events).withColumns({"city": F.concat(F.lit("NATION_"), (user % 25).cast("string")), "state": F.concat(F.lit("S"), (user % 25).cast("string"))})
    done = [("fbi_first", loads.load_crime_us(table, loads.agency_rows(agencies, counts, [1994, 1995], FIRST))),
            ("fbi_second", loads.load_crime_us(table, loads.agency_rows(agencies, counts, [1995, 1996], SECOND))),
            ("spotcrime", loads.load_crime_us(table, loads.incident_rows(feeds, "payload", "city", "state", SECOND)))]
    return table, done


@register("ld01_listings_us", O.rounded(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS listing_id, 'zillow' AS source, CASE WHEN late THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END AS scraped_at, p AS price_usd,
       CAST(o_orderkey % 6 AS INT) AS bedrooms, sqft, CAST(p AS DOUBLE) / sqft AS price_per_sqft_usd,
       CASE o_orderkey % 4 WHEN 0 THEN 'condo' WHEN 1 THEN 'single_family' WHEN 2 THEN 'single_family' END AS property_type,
       CAST(o_orderdate AS DATE) AS listing_date, concat('Z', CAST(o_custkey % 7 AS VARCHAR)) AS zip, true AS page_kept
FROM (SELECT *, o_orderdate >= DATE '1995-01-01' AS late, CAST(300 + o_orderkey % 2000 AS INT) AS sqft,
             CAST(trunc(o_totalprice + CASE WHEN o_orderdate >= DATE '1995-01-01' THEN 1000 ELSE 0 END) AS BIGINT) AS p FROM orders) o WHERE o_orderkey % 7 <> 0""",
    ["price_per_sqft_usd"]))
def ld01(spark, d):
    table, pages, _ = _us(spark, d)
    kept = pages.read().select("page_id", F.lit(True).alias("page_kept"))
    return table.read().join(kept, "page_id", "left").select(
        "listing_id", "source", F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"), "price_usd", "bedrooms", "sqft", "price_per_sqft_usd", "property_type",
        "listing_date", "zip", F.coalesce("page_kept", F.lit(False)).alias("page_kept"))


@register("ld02_listings_co", O.rounded(f"""
SELECT CASE WHEN k % 3 = 2 THEN concat('casa-', k) ELSE CAST(k AS VARCHAR) END AS listing_id, 'fincaraiz' AS source,
       CASE WHEN k % 2 = 0 THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END AS scraped_at, 'Bogota' AS city, 'Cundinamarca' AS departamento,
       concat('Barrio ', k % 9) AS barrio, CASE WHEN k % 10 = 0 THEN NULL ELSE 10000000 + k * 1000 END AS price_cop,
       CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(1 + k % 5 AS INT) END AS bedrooms, 1 + (k % 2) / 2e0 AS bathrooms, 40e0 + k % 100 AS area_m2,
       CASE WHEN k % 2 = 0 THEN 'apartamento' ELSE 'casa' END AS property_type, concat(CASE WHEN k % 2 = 0 THEN 'Apartamento en ' ELSE 'Casa en ' END, k) AS description,
       NOT (k % 2 = 0 AND k % 3 <> 0 AND k % 10 <> 0) AS has_html
FROM (SELECT p_partkey AS k FROM part WHERE p_partkey % 11 <> 0 AND (p_partkey % 3 <> 0 OR p_partkey % 2 = 0)) x""", ["bathrooms", "area_m2"]))
def ld02(spark, d):
    table, _ = _co(spark, d)
    return table.read().select("listing_id", "source", F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"), "city", "departamento", "barrio", "price_cop", "bedrooms",
                               "bathrooms", "area_m2", "property_type", "description", F.col("raw_html").isNotNull().alias("has_html"))


_FBI = """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CASE l_returnflag WHEN 'A' THEN 'homicide' WHEN 'N' THEN 'burglary' ELSE 'larceny' END AS offense, year(l_shipdate) AS y
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE year(l_shipdate) BETWEEN 1994 AND 1996 GROUP BY 1, 2, 3, 4, 5, 6"""
_KIND = "CASE event_type WHEN 'click' THEN 'assault' WHEN 'view' THEN 'theft' WHEN 'signup' THEN 'shooting' ELSE event_type END"


@register("ld03_crime_us", O.rounded(f"""
SELECT concat('fbi_ORI', s_suppkey, '_', y, '_', offense) AS incident_id, 'fbi_ucr' AS source, s_name AS city, concat('S', s_nationkey) AS state, CAST(s_acctbal AS DOUBLE) AS lat,
       offense AS crime_type, CASE WHEN offense = 'homicide' THEN 'violent' ELSE 'property' END AS crime_category, make_date(CAST(y AS INT), 12, 31) AS incident_date, CAST(y AS INT) AS year,
       CASE WHEN y = 1994 THEN TIMESTAMP '{FIRST}' ELSE TIMESTAMP '{SECOND}' END AS ingested_at
FROM ({_FBI}) f
UNION ALL
SELECT concat('sc_', event_id), 'spotcrime', concat('NATION_', user_id % 25), concat('S', user_id % 25), NULL, {_KIND},
       CASE WHEN {_KIND} IN ('assault', 'shooting') THEN 'violent' WHEN {_KIND} = 'theft' THEN 'property' ELSE 'other' END, CAST(ts AS DATE), CAST(year(ts) AS INT), TIMESTAMP '{SECOND}'
FROM events""", ["lat"]))
def ld03(spark, d):
    table, _ = _crime(spark, d)
    return table.read().select("incident_id", "source", "city", "state", "lat", "crime_type", "crime_category", "incident_date", "year",
                               F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


def _count(where: str) -> str:
    return f"count(*) FILTER (WHERE {where})"


@register("ld04_load_summary", f"""
SELECT 'us_first' AS source, count(*) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped, 'ok' AS status FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderdate < DATE '1996-01-01'
UNION ALL SELECT 'us_second', {_count("o_orderdate >= DATE '1996-01-01'")}, {_count("o_orderdate < DATE '1996-01-01'")}, 0, 0, 'ok'
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderdate >= DATE '1995-01-01'
UNION ALL SELECT 'co_first', count(*), 0, {_count('p_partkey % 10 = 0')}, 0, 'ok' FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 3 <> 0
UNION ALL SELECT 'co_second', {_count('p_partkey % 3 = 0')}, {_count('p_partkey % 3 <> 0')}, {_count('p_partkey % 10 = 0')}, 0, 'ok' FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 2 = 0
UNION ALL SELECT 'fbi_first', count(*), 0, 0, 0, 'ok' FROM ({_FBI}) f WHERE y <= 1995
UNION ALL SELECT 'fbi_second', {_count('y = 1996')}, {_count('y = 1995')}, 0, 0, 'ok' FROM ({_FBI}) f WHERE y >= 1995
UNION ALL SELECT 'spotcrime', count(*), 0, 0, 0, 'ok' FROM events""")
def ld04(spark, d):
    Tables.shared(spark, d)                                                   # one accessor for the three
    # the tables of the loads have nothing in common: while one of them ends a step, the others use the free cores
    with ThreadPoolExecutor(3) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(load), spark, d) for load in (_us, _co, _crime)]
        return loads.summary_rows(spark, [c for r in running for c in r.result()[-1]])
