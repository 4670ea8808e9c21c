"""Dashboard views (k10, c21-c23) as SQL text over temp views of the built tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

CITY_SUMMARY_SQL = """
CREATE OR REPLACE TEMP VIEW v_city_summary AS
WITH latest AS (
  SELECT m.country_code, m.city, AVG(m.median_price_usd) AS latest_median_price_usd
  FROM market_summary m
  JOIN (SELECT country_code, city, MAX(date) AS mx FROM market_summary GROUP BY country_code, city) x
    ON m.country_code = x.country_code AND m.city = x.city AND m.date = x.mx
  GROUP BY m.country_code, m.city)
SELECT n.country_code, n.city, COUNT(*) AS neighborhood_count,
       AVG(n.composite_score) AS avg_composite_score, AVG(n.crime_rate_per_100k) AS avg_crime_per_100k,
       AVG(n.school_score_normalized) AS avg_school_score, AVG(n.amenity_density_score) AS avg_amenity_density,
       AVG(n.transit_access_score) AS avg_transit_access, AVG(n.hazard_composite_score) AS avg_hazard_score,
       AVG(n.weather_extreme_days_per_yr) AS avg_weather_extreme_days,
       FIRST(l.latest_median_price_usd) AS latest_median_price_usd
FROM neighborhood_scorecard n
LEFT JOIN latest l ON n.country_code = l.country_code AND n.city = l.city
GROUP BY n.country_code, n.city"""


def create_views(spark: SparkSession, pipeline) -> None:
    """Register the built tables and the dashboard views as session temp views."""
    pipeline.stage("scorecard").createOrReplaceTempView("neighborhood_scorecard")
    pipeline.stage("market_summary").createOrReplaceTempView("market_summary")
    pipeline.stage("listings").createOrReplaceTempView("listings")
    pipeline.listing_map.createOrReplaceTempView("v_listing_map")
    spark.sql(CITY_SUMMARY_SQL)
