"""Registered sanity / validation queries (v01-v22) over the built tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels
from ..sources import bindings
from ..sources.tables import Tables
from .catalog import O, register
from .catalog_sessions import g05
from .pipeline import Pipeline

_BRONZE = ["listings_raw", "market_raw", "hazards", "weather", "amenities", "schools", "crime", "fx", "demographics"]
_BIND = {"listings_raw": "listings", "market_raw": "market"}


@register("v01_bronze_counts", O.sql("SELECT " + ", ".join(f"(SELECT count(*) FROM {b}) AS {b}" for b in _BRONZE), *_BRONZE))
def v01(spark, d):
    t = Tables.shared(spark, d)
    out = None
    for b in _BRONZE:
        one = getattr(bindings, _BIND.get(b, b))(t).agg(F.count(F.lit(1)).alias(b))
        out = one if out is None else out.crossJoin(one)   # one-row frames
    return out


@register("v02_fx_stats", O.rounded(O.sql("SELECT count(*) AS n, min(rate) AS lo, max(rate) AS hi, avg(rate) AS mean FROM fx", "fx"),
                                    ["lo", "hi", "mean"]))
def v02(spark, d):
    return bindings.fx(Tables.shared(spark, d)).agg(F.count(F.lit(1)).alias("n"), F.min("rate").alias("lo"), F.max("rate").alias("hi"),
                                             F.avg("rate").alias("mean"))


@register("v03_listings_by_city", O.sql("SELECT country_code, city, count(*) AS n FROM silver_listings GROUP BY 1, 2", "silver_listings"))
def v03(spark, d):
    return Pipeline(spark, d).listings.groupBy("country_code", "city").agg(F.count(F.lit(1)).alias("n"))


@register("v04_weather_days", O.sql(f"""
SELECT country_code, city, count(*) AS days, CAST(sum(CASE WHEN {O.EXTREME} THEN 1 ELSE 0 END) AS BIGINT) AS extreme_days,
       min(date) AS first_day, max(date) AS last_day FROM weather GROUP BY 1, 2""", "weather"))
def v04(spark, d):
    w = bindings.weather(Tables.shared(spark, d))
    x = labels.is_extreme_day("precipitation_mm", "wind_speed_max_kmh", "temp_max_c", "temp_min_c")
    return w.groupBy("country_code", "city").agg(F.count(F.lit(1)).alias("days"), F.sum(x.cast("int")).cast("bigint").alias("extreme_days"),
                                                 F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@register("v05_amenities_by_type", O.sql("SELECT country_code, city, amenity_type, count(*) AS n FROM amenities GROUP BY 1, 2, 3", "amenities"))
def v05(spark, d):
    return bindings.amenities(Tables.shared(spark, d)).groupBy("country_code", "city", "amenity_type").agg(F.count(F.lit(1)).alias("n"))


@register("v06_schools_by_area", O.rounded(O.sql("""
SELECT country_code, count(*) AS n, count(school_score_normalized) AS n_scored, avg(school_score_normalized) AS avg_score
FROM school_rankings GROUP BY 1""", "school_rankings"), ["avg_score"]))
def v06(spark, d):
    return Pipeline(spark, d).school_rankings.groupBy("country_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("school_score_normalized").alias("n_scored"),
        F.avg("school_score_normalized").alias("avg_score"))


@register("v07_crime_by_year", O.sql("""
SELECT country_code, category, period_year, count(*) AS n FROM
 (SELECT *, CASE WHEN raw = '' THEN 'other'
       WHEN raw LIKE '%homicid%' OR raw LIKE '%lesion%' OR raw LIKE '%secuestr%' OR raw LIKE '%violenc%' OR raw LIKE '%violacion%'
         OR raw LIKE '%feminicid%' OR raw LIKE '%delitos sexuales%' OR raw LIKE '%sexual%' THEN 'violent'
       WHEN raw LIKE '%hurto%' AND raw LIKE '%violen%' THEN 'violent'
       WHEN raw LIKE '%hurto%' OR raw LIKE '%robo%' OR raw LIKE '%dano%' OR raw LIKE '%abigeato%' OR raw LIKE '%piracy%' OR raw LIKE '%pirateria%' THEN 'property'
       ELSE 'other' END AS category FROM (SELECT *, translate(lower(trim(crime_type)), 'áéíóúñü', 'aeiounu') AS raw FROM crime) c) x
GROUP BY 1, 2, 3""", "crime"))
def v07(spark, d):
    c = bindings.crime(Tables.shared(spark, d)).withColumn("category", labels.crime_category_spanish("crime_type"))
    return c.groupBy("country_code", "category", "period_year").agg(F.count(F.lit(1)).alias("n"))


@register("v08_demographics_latest_year", O.rounded(O.sql("""
SELECT country_code, zip_or_municipio, population, pct_homeowner FROM demographics WHERE year = (SELECT max(year) FROM demographics)""",
    "demographics"), ["pct_homeowner"]))
def v08(spark, d):
    from ..operators.filters import at_scalar_max
    return at_scalar_max(bindings.demographics(Tables.shared(spark, d)), "year").select("country_code", "zip_or_municipio", "population",
                                                                                 "pct_homeowner")


@register("v09_recent_economics", O.rounded(O.sql("""
SELECT country_code, city, date, unemployment_rate, mortgage_rate_30yr FROM economic
WHERE date > (SELECT max(date) FROM economic) - INTERVAL 12 MONTH""", "economic"), ["unemployment_rate", "mortgage_rate_30yr"]))
def v09(spark, d):
    e = bindings.economic(Tables.shared(spark, d))
    mx = e.agg(F.add_months(F.max("date"), -12).alias("_lo"))
    return e.crossJoin(F.broadcast(mx)).filter(F.col("date") > F.col("_lo")).select(
        "country_code", "city", "date", "unemployment_rate", "mortgage_rate_30yr")


@register("v10_hazards_by_type", O.sql("SELECT source, hazard_type, count(*) AS n FROM hazards GROUP BY 1, 2", "hazards"))
def v10(spark, d):
    return bindings.hazards(Tables.shared(spark, d)).groupBy("source", "hazard_type").agg(F.count(F.lit(1)).alias("n"))


@register("v11_top_barrios", O.sql("""
SELECT city, barrio_or_neighborhood, count(*) AS n FROM silver_listings WHERE country_code = 'CO'
GROUP BY 1, 2 HAVING count(*) > 5 ORDER BY n DESC, city, barrio_or_neighborhood LIMIT 20""", "silver_listings"))
def v11(spark, d):
    l = Pipeline(spark, d).listings.filter(F.col("country_code") == "CO")
    g = l.groupBy("city", "barrio_or_neighborhood").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 5)
    return g.orderBy(F.col("n").desc(), "city", "barrio_or_neighborhood").limit(20)


@register("v12_silver_by_country", O.sql("""
SELECT country_code, count(*) AS n, count(DISTINCT city) AS cities FROM silver_listings GROUP BY 1""", "silver_listings"))
def v12(spark, d):
    return Pipeline(spark, d).listings.groupBy("country_code").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("city").alias("cities"))


@register("v13_risk_by_label", O.sql("SELECT risk_label, count(*) AS n FROM risk GROUP BY 1", "risk"))
def v13(spark, d):
    return Pipeline(spark, d).risk.groupBy("risk_label").agg(F.count(F.lit(1)).alias("n"))


_COV = ["crime_rate_per_100k", "school_score_normalized", "population", "weather_extreme_days_per_yr", "hazard_composite_score"]


@register("v14_profile_coverage", O.sql("SELECT count(*) AS n, " + ", ".join(f"count({c}) AS n_{c}" for c in _COV)
                                         + " FROM profile", "profile"))
def v14(spark, d):
    return Pipeline(spark, d).profile.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"n_{c}") for c in _COV])


@register("v15_market_temp_mix", O.sql("SELECT market_temp, count(*) AS n FROM market_summary GROUP BY 1", "market_summary"))
def v15(spark, d):
    return Pipeline(spark, d).market_summary.groupBy("market_temp").agg(F.count(F.lit(1)).alias("n"))


@register("v16_school_scores", O.rounded(O.sql("""
SELECT country_code, min(school_score_normalized) AS lo, max(school_score_normalized) AS hi, avg(school_score_normalized) AS mean
FROM school_rankings GROUP BY 1""", "school_rankings"), ["lo", "hi", "mean"]))
def v16(spark, d):
    return Pipeline(spark, d).school_rankings.groupBy("country_code").agg(
        F.min("school_score_normalized").alias("lo"), F.max("school_score_normalized").alias("hi"),
        F.avg("school_score_normalized").alias("mean"))


@register("v17_scorecard_top10", O.rounded(O.sql("""
SELECT profile_id, composite_score, (SELECT min(composite_score) FROM scorecard) AS lo, (SELECT max(composite_score) FROM scorecard) AS hi
FROM scorecard ORDER BY composite_score DESC, profile_id LIMIT 10""", "scorecard"), ["composite_score", "lo", "hi"]))
def v17(spark, d):
    sc = Pipeline(spark, d).stage("scorecard")
    rng = sc.agg(F.min("composite_score").alias("lo"), F.max("composite_score").alias("hi"))
    top = sc.orderBy(F.col("composite_score").desc(), "profile_id").limit(10).select("profile_id", "composite_score")
    return top.crossJoin(F.broadcast(rng))


@register("v18_recent_rolling", O.rounded(O.sql("""
SELECT country_code, city, zip_or_municipio, date, median_price_usd_rolling_6mo, median_price_usd_rolling_12mo FROM
 (SELECT *, avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS median_price_usd_rolling_6mo,
            avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS median_price_usd_rolling_12mo
  FROM market_summary) t WHERE date >= (SELECT max(date) FROM market_summary) - INTERVAL 3 MONTH""", "market_summary"),
    ["median_price_usd_rolling_6mo", "median_price_usd_rolling_12mo"]))
def v18(spark, d):
    t = Pipeline(spark, d).market_trends
    lo = t.agg(F.add_months(F.max("date"), -3).alias("_lo"))
    return t.crossJoin(F.broadcast(lo)).filter(F.col("date") >= F.col("_lo")).select(
        "country_code", "city", "zip_or_municipio", "date", "median_price_usd_rolling_6mo", "median_price_usd_rolling_12mo")


@register("v19_opportunities_by_city", O.rounded(O.sql("""
SELECT country_code, city, count(*) AS n, avg(discount_pct) AS avg_discount FROM value_opportunities GROUP BY 1, 2""",
    "value_opportunities"), ["avg_discount"]))
def v19(spark, d):
    return Pipeline(spark, d).value_opportunities(sort=False).groupBy("country_code", "city").agg(
        F.count(F.lit(1)).alias("n"), F.avg("discount_pct").alias("avg_discount"))


@register("v20_pairs_by_ratio", O.rounded(O.sql("""
SELECT us_city, co_city, price_ratio FROM city_comparison ORDER BY price_ratio DESC NULLS LAST, us_city, co_city""",
    "city_comparison"), ["price_ratio"]))
def v20(spark, d):
    return Pipeline(spark, d).city_comparison().orderBy(F.col("price_ratio").desc_nulls_last(), "us_city", "co_city") \
                             .select("us_city", "co_city", "price_ratio")


@register("v21_view_counts", O.sql("""
SELECT (SELECT count(*) FROM listing_map) AS listing_map_rows, (SELECT count(*) FROM city_summary) AS city_summary_rows""",
    "listing_map", "city_summary"))
def v21(spark, d):
    p = Pipeline(spark, d)
    return p.listing_map.agg(F.count(F.lit(1)).alias("listing_map_rows")).crossJoin(
        p.city_summary.agg(F.count(F.lit(1)).alias("city_summary_rows")))


@register("v22_session_log", O.sql("""
SELECT country_filter, count(*) AS n, CAST(sum(evidence_record_count) AS BIGINT) AS records FROM sessions GROUP BY 1""", "sessions"))
def v22(spark, d):
    return g05(spark, d).groupBy("country_filter").agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum("evidence_record_count").cast("bigint").alias("records"))
