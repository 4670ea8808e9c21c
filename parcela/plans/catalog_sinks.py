"""Registered table-maintenance queries (k01-k13): upserts, slices, diffs, writes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas
from ..operators import dedupe, diff, upsert
from ..session import scratch_path
from ..sources import bindings, sinks
from ..sources.tables import Tables
from . import silver
from .catalog import O, register


def T(spark, d) -> Tables:
    return Tables.shared(spark, d)


CUT = "1996-01-01 00:00:00"
COLS = ["listing_id", "price_usd", "bedrooms", "area_sqft", "scraped_at", "city"]


def _target_source(spark, d):
    r = bindings.listings(T(spark, d))
    cut = F.lit(CUT).cast("timestamp_ntz")
    def newest(df):
        return dedupe.latest_per_key(df.select(*COLS, "seq"), ["listing_id"], ["scraped_at", "seq"]).select(*COLS)
    return newest(r.filter(F.col("scraped_at") < cut)), newest(r.filter(F.col("scraped_at") >= cut))


_TS = f"""
t AS (SELECT {', '.join(COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY scraped_at DESC, seq DESC) AS rn
                                     FROM listings_raw WHERE scraped_at < TIMESTAMP '{CUT}') x WHERE rn = 1),
s AS (SELECT {', '.join(COLS)} FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY scraped_at DESC, seq DESC) AS rn
                                     FROM listings_raw WHERE scraped_at >= TIMESTAMP '{CUT}') x WHERE rn = 1)"""


def _sql_ts(final: str) -> str:
    base = O.sql("SELECT 1", "listings_raw")          # 'WITH listings_raw AS (...)\nSELECT 1'
    head = base[: base.rindex("\nSELECT 1")]
    return f"{head},{_TS}\n{final}"


@register("k03_upsert_subset", O.rounded(_sql_ts("""
SELECT coalesce(t.listing_id, s.listing_id) AS listing_id,
       CASE WHEN s.listing_id IS NOT NULL THEN s.price_usd ELSE t.price_usd END AS price_usd,
       CASE WHEN t.listing_id IS NOT NULL THEN t.bedrooms ELSE s.bedrooms END AS bedrooms,
       CASE WHEN t.listing_id IS NOT NULL THEN t.area_sqft ELSE s.area_sqft END AS area_sqft,
       CASE WHEN s.listing_id IS NOT NULL THEN s.scraped_at ELSE t.scraped_at END AS scraped_at,
       CASE WHEN t.listing_id IS NOT NULL THEN t.city ELSE s.city END AS city
FROM t FULL OUTER JOIN s ON t.listing_id = s.listing_id"""), ["area_sqft"]))
def k03(spark, d):
    t, s = _target_source(spark, d)
    return upsert.upsert_subset(t, s, ["listing_id"], ["price_usd", "scraped_at"])


@register("k04_upsert_all", O.rounded(_sql_ts("""
SELECT * FROM t WHERE listing_id NOT IN (SELECT listing_id FROM s) UNION ALL SELECT * FROM s"""), ["area_sqft"]))
def k04(spark, d):
    t, s = _target_source(spark, d)
    return upsert.upsert_all(t, s, ["listing_id"])


_WKEYS = ["country_code", "city", "date"]
_WVALS = ["temp_max_c", "temp_min_c", "precipitation_mm", "wind_speed_max_kmh"]


@register("k05_upsert_explicit", O.rounded(O.sql("""
SELECT coalesce(t.country_code, s.country_code) AS country_code, coalesce(t.city, s.city) AS city, coalesce(t.date, s.date) AS date,
""" + ",\n".join(f"CASE WHEN s.city IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _WVALS) + """
FROM (SELECT * FROM weather WHERE date < DATE '2024-01-15') t
FULL OUTER JOIN (SELECT country_code, city, date, temp_max_c + 1e0 AS temp_max_c, temp_min_c, precipitation_mm, wind_speed_max_kmh
                 FROM weather WHERE date >= DATE '2024-01-10') s
  ON t.country_code = s.country_code AND t.city = s.city AND t.date = s.date""", "weather"), _WVALS))
def k05(spark, d):
    w = bindings.weather(T(spark, d))
    t = w.filter(F.col("date") < F.lit("2024-01-15").cast("date"))
    s = w.filter(F.col("date") >= F.lit("2024-01-10").cast("date")).withColumn("temp_max_c", F.col("temp_max_c") + 1.0)
    return upsert.upsert_subset(t, s, _WKEYS, _WVALS)


@register("k06_update_only", O.rounded(_sql_ts("""
SELECT t.listing_id, CASE WHEN s.listing_id IS NOT NULL THEN s.price_usd ELSE t.price_usd END AS price_usd,
       CASE WHEN s.listing_id IS NOT NULL THEN s.bedrooms ELSE t.bedrooms END AS bedrooms,
       CASE WHEN s.listing_id IS NOT NULL THEN s.area_sqft ELSE t.area_sqft END AS area_sqft,
       CASE WHEN s.listing_id IS NOT NULL THEN s.scraped_at ELSE t.scraped_at END AS scraped_at, t.city
FROM t LEFT JOIN s ON t.listing_id = s.listing_id"""), ["area_sqft"]))
def k06(spark, d):
    t, s = _target_source(spark, d)
    return upsert.update_only(t, s, ["listing_id"], keep_cols=["city"])


_HCOLS = ["hazard_id", "country_code", "county_or_municipio", "zip_or_zone", "hazard_type", "risk_score"]


@register("k07_slice_replace", O.rounded(O.sql(f"""
SELECT {', '.join(_HCOLS)} FROM hazards
WHERE NOT ((country_code = 'US' AND hazard_type = 'flood') OR (country_code = 'US' AND hazard_type = 'hurricane'))
UNION ALL
SELECT hazard_id, country_code, county_or_municipio, zip_or_zone, hazard_type, risk_score / 2e0 AS risk_score
FROM hazards WHERE country_code = 'US' AND hazard_type = 'flood'""", "hazards"), ["risk_score"]))
def k07(spark, d):
    h = bindings.hazards(T(spark, d)).select(*_HCOLS)
    batch = h.filter((F.col("country_code") == "US") & (F.col("hazard_type") == "flood")) \
             .withColumn("risk_score", F.col("risk_score") / 2.0)
    slices = spark.createDataFrame([("US", "flood"), ("US", "hurricane")], "country_code string, hazard_type string")
    return upsert.slice_replace(h, batch, ["country_code", "hazard_type"], slices)


@register("k09_snapshot_diff", O.rounded(_sql_ts(f"""
, n AS (SELECT * FROM t WHERE listing_id NOT IN (SELECT listing_id FROM s) UNION ALL SELECT * FROM s)
SELECT n.listing_id, 'insert' AS _change_type, n.price_usd, n.bedrooms, n.area_sqft, n.scraped_at, n.city
FROM n LEFT JOIN t ON n.listing_id = t.listing_id WHERE t.listing_id IS NULL
UNION ALL
SELECT t.listing_id, 'delete', t.price_usd, t.bedrooms, t.area_sqft, t.scraped_at, t.city
FROM t LEFT JOIN n ON n.listing_id = t.listing_id WHERE n.listing_id IS NULL
UNION ALL
SELECT t.listing_id, 'update_preimage', t.price_usd, t.bedrooms, t.area_sqft, t.scraped_at, t.city
FROM t JOIN n ON n.listing_id = t.listing_id
WHERE row(t.price_usd, t.bedrooms, t.area_sqft, t.scraped_at, t.city) IS DISTINCT FROM row(n.price_usd, n.bedrooms, n.area_sqft, n.scraped_at, n.city)
UNION ALL
SELECT n.listing_id, 'update_postimage', n.price_usd, n.bedrooms, n.area_sqft, n.scraped_at, n.city
FROM t JOIN n ON n.listing_id = t.listing_id
WHERE row(t.price_usd, t.bedrooms, t.area_sqft, t.scraped_at, t.city) IS DISTINCT FROM row(n.price_usd, n.bedrooms, n.area_sqft, n.scraped_at, n.city)
""").replace(f"{_TS}\n,", f"{_TS},", 1).replace("\n, n AS", ", n AS", 1), ["area_sqft"]))
def k09(spark, d):
    t, s = _target_source(spark, d)
    new = upsert.upsert_all(t, s, ["listing_id"])
    return diff.snapshot_diff(t, new, ["listing_id"])


@register("k11_upsert_counts", _sql_ts("""
SELECT count(*) AS staged, count(*) FILTER (WHERE listing_id IN (SELECT listing_id FROM t)) AS updated,
       count(*) FILTER (WHERE listing_id NOT IN (SELECT listing_id FROM t)) AS inserted
FROM (SELECT DISTINCT listing_id FROM s) x"""))
def k11(spark, d):
    t, s = _target_source(spark, d)
    return upsert.upsert_counts(t, s, ["listing_id"])


@register("k12_insert_refresh_split", O.rounded(_sql_ts("""
SELECT s.*, CASE WHEN NOT (s.price_usd IS NOT NULL AND s.area_sqft IS NOT NULL) THEN 'parse_failure'
                 WHEN k.listing_id IS NULL THEN 'new' ELSE 'refresh' END AS row_status,
       CASE WHEN (s.price_usd IS NOT NULL AND s.area_sqft IS NOT NULL) AND k.listing_id IS NOT NULL THEN NULL
            ELSE concat('<html>', s.listing_id, '</html>') END AS raw_html
FROM s LEFT JOIN (SELECT DISTINCT listing_id FROM t) k ON s.listing_id = k.listing_id"""), ["area_sqft"]))
def k12(spark, d):
    t, s = _target_source(spark, d)
    s = s.withColumn("raw_html", F.concat(F.lit("<html>"), "listing_id", F.lit("</html>")))
    out = upsert.insert_refresh_split(s, t, ["listing_id"], ["price_usd", "area_sqft"], blob_col="raw_html")
    return out.select(*COLS, "row_status", "raw_html")


@register("k01_append", O.sql("SELECT date, from_currency, to_currency, rate FROM fx", "fx"))
def k01(spark, d):
    fx = bindings.fx(T(spark, d))
    path = scratch_path(spark, f"k01_fx_{uuid.uuid4().hex}")
    cut = F.lit("1995-01-01").cast("date")
    sinks.append(fx.filter(F.col("date") < cut), path)
    have = spark.read.parquet(path)
    hw = have.agg(F.max("date").alias("_hw"))
    new = fx.crossJoin(F.broadcast(hw)).filter(F.col("_hw").isNull() | (F.col("date") > F.col("_hw"))).drop("_hw")
    sinks.append(new, path)
    return spark.read.parquet(path)


@register("k02_overwrite", O.rounded(O.sql("SELECT * FROM risk", "risk"), [
    "flood_risk_score", "earthquake_risk_score", "wildfire_risk_score", "tornado_risk_score", "landslide_risk_score",
    "composite_hazard_score"]))
def k02(spark, d):
    risk = silver.risk_profile(bindings.hazards(T(spark, d)), "2024-01-01 00:00:00")
    root = scratch_path(spark, f"k02_risk_{uuid.uuid4().hex}")
    sinks.write_snapshot(risk, root)
    sinks.write_snapshot(risk, root)          # a second version; readers see the newest
    return sinks.read_current(spark, root)


@register("k08_partitioned_write", O.rounded(O.sql("""
SELECT country_code, city, date, temp_max_c, temp_min_c FROM weather WHERE country_code = 'US'""", "weather"),
    ["temp_max_c", "temp_min_c"]))
def k08(spark, d):
    w = bindings.weather(T(spark, d)).select("country_code", "city", "date", "temp_max_c", "temp_min_c")
    path = scratch_path(spark, f"k08_weather_{uuid.uuid4().hex}")
    sinks.replace_partitions(w, path, ["country_code"])
    back = spark.read.parquet(path).filter(F.col("country_code") == "US")   # partition pruning
    return back.select("country_code", "city", "date", "temp_max_c", "temp_min_c")


@register("k10_views", O.rounded(O.sql("SELECT * FROM city_summary", "city_summary"),
                                 ["avg_composite_score", "avg_crime_per_100k", "avg_school_score", "avg_amenity_density",
                                  "avg_transit_access", "avg_hazard_score", "avg_weather_extreme_days",
                                  "latest_median_price_usd"]))
def k10(spark, d):
    from .pipeline import Pipeline
    from .views import create_views
    p = Pipeline(spark, d)
    create_views(spark, p)
    return spark.sql("SELECT * FROM v_city_summary")


@register("k13_typed_ddl", O.sql("""
SELECT hazard_id, source, country_code, state_or_dept, county_or_municipio, zip_or_zone, CAST(NULL AS DOUBLE) AS lat,
       CAST(NULL AS DOUBLE) AS lon, hazard_type, CAST(NULL AS VARCHAR) AS risk_level, round(risk_score, 6) AS risk_score,
       CAST(NULL AS DATE) AS data_date, CAST(NULL AS VARCHAR) AS details_json, CAST(NULL AS TIMESTAMP) AS ingested_at
FROM hazards""", "hazards"))
def k13(spark, d):
    return schemas.conform(bindings.hazards(T(spark, d)), "bronze.hazards")
