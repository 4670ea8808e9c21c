"""Registered composite builds c01-c23."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import O, P, register

LISTING_DOUBLES = ["lat", "lon", "price_per_sqft_usd", "area_sqft", "bathrooms"]


@register("c01_silver_listings", O.rounded(O.sql("SELECT * FROM silver_listings", "silver_listings"), LISTING_DOUBLES))
def c01(spark, d):
    """US + CO listings conformed to 21 columns, newest row per listing_id."""
    return P(spark, d).listings


@register("c11_market_summary", O.rounded(O.sql("SELECT * FROM market_summary", "market_summary"),
                                          ["price_trend_3mo_pct", "price_trend_12mo_pct", "months_of_supply"]))
def c11(spark, d):
    return P(spark, d).market_summary


RISK_DOUBLES = ["flood_risk_score", "earthquake_risk_score", "wildfire_risk_score", "tornado_risk_score",
                "landslide_risk_score", "composite_hazard_score"]


@register("c12_risk_profile", O.rounded(O.sql("SELECT * FROM risk", "risk"), RISK_DOUBLES))
def c12(spark, d):
    return P(spark, d).risk


PROFILE_DOUBLES = ["lat_centroid", "lon_centroid", "crime_rate_per_100k", "school_score_normalized",
                   "pct_homeowner", "amenity_density_score", "transit_access_score",
                   "weather_extreme_days_per_yr", "hazard_composite_score"]


@register("c10_neighborhood_profile", O.rounded(O.sql("SELECT * FROM profile", "profile"), PROFILE_DOUBLES))
def c10(spark, d):
    return P(spark, d).profile


SCORE_DOUBLES = PROFILE_DOUBLES + ["composite_score", "country_percentile_rank", "global_percentile_rank"]


@register("c15_scorecard", O.rounded(O.sql("SELECT * FROM scorecard", "scorecard"), SCORE_DOUBLES))
def c15(spark, d):
    return P(spark, d).scorecard


@register("c16_market_trends", O.rounded(O.sql("""
SELECT *, avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date
                                      ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS median_price_usd_rolling_6mo,
          avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date
                                      ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS median_price_usd_rolling_12mo
FROM market_summary""", "market_summary"), ["price_trend_3mo_pct", "price_trend_12mo_pct", "months_of_supply",
                                            "median_price_usd_rolling_6mo", "median_price_usd_rolling_12mo"]))
def c16(spark, d):
    return P(spark, d).market_trends


@register("c17_value_opportunities", O.rounded(O.sql("SELECT * FROM value_opportunities", "value_opportunities"),
                                               LISTING_DOUBLES + ["discount_pct", "neighborhood_composite_score"]))
def c17(spark, d):
    """Listings under 85 % of the latest area median, with score and risk context."""
    return P(spark, d).value_opportunities(sort=True)


@register("c13_hazard_risk", O.rounded(O.sql("SELECT * FROM risk", "risk"), RISK_DOUBLES))
def c13(spark, d):
    return P(spark, d).risk


@register("c14_school_rankings", O.rounded(O.sql("SELECT * FROM school_rankings", "school_rankings"),
                                           ["lat", "lon", "school_score_normalized"]))
def c14(spark, d):
    return P(spark, d).school_rankings


INDEX_DOUBLES = ["norm_price_usd", "norm_crime_score", "norm_school_score", "norm_hazard_score", "norm_weather_score",
                 "norm_affordability_score", "norm_amenity_score", "norm_economic_score"]


@register("c18_comparison_index", O.rounded(O.sql("SELECT * FROM comparison_index", "comparison_index"), INDEX_DOUBLES))
def c18(spark, d):
    return P(spark, d).comparison_index


METRIC_DOUBLES = ["crime_per_100k", "composite_score", "hazard_score", "amenity_density_score",
                  "weather_extreme_days", "norm_school", "median_price_usd"]


@register("c19_city_metrics", O.rounded(O.sql("SELECT * FROM city_metrics", "city_metrics"), METRIC_DOUBLES + ["unemployment_rate"]))
def c19(spark, d):
    return P(spark, d).city_metrics


CMP_DOUBLES = ["price_ratio"] + [f"{s}_{n}" for n in ["crime_per_100k", "school_score", "composite_score", "hazard_score",
                                                       "unemployment_rate", "weather_extreme_days",
                                                       "amenity_density_score"] for s in ("us", "co")]


@register("c20_city_comparison", O.rounded(O.sql("SELECT * FROM city_comparison", "city_comparison"), CMP_DOUBLES))
def c20(spark, d):
    return P(spark, d).city_comparison()


@register("c21_listing_map", O.rounded(O.sql("SELECT * FROM listing_map", "listing_map"),
                                       LISTING_DOUBLES + ["composite_score", "crime_rate_per_100k",
                                                          "school_score_normalized"]))
def c21(spark, d):
    return P(spark, d).listing_map


@register("c22_city_summary", O.rounded(O.sql("SELECT * FROM city_summary", "city_summary"),
                                        ["avg_composite_score", "avg_crime_per_100k", "avg_school_score",
                                         "avg_amenity_density", "avg_transit_access", "avg_hazard_score",
                                         "avg_weather_extreme_days", "latest_median_price_usd"]))
def c22(spark, d):
    return P(spark, d).city_summary


# --- profile building blocks (c02-c09) -----------------------------------------------------
from ..sources import bindings as _b  # noqa: E402
from ..sources.tables import Tables as _T  # noqa: E402
from . import silver as _s  # noqa: E402


@register("c02_geo_units", O.rounded(O.sql("SELECT * FROM units", "units"), ["lat_centroid", "lon_centroid"]))
def c02(spark, d):
    return _s.geo_units(P(spark, d).listings)


@register("c03_crime_join", O.rounded(O.sql("""
SELECT u.profile_id, c.crime_rate_per_100k, c.crime_trend FROM units u
LEFT JOIN crime_latest c ON u.country_code = c.country_code AND u.city = c.city""", "units", "crime_latest"),
    ["crime_rate_per_100k"]))
def c03(spark, d):
    u = _s.geo_units(P(spark, d).listings)
    return u.join(_s.crime_latest(_b.crime(_T(spark, d))), ["country_code", "city"], "left") \
            .select("profile_id", "crime_rate_per_100k", "crime_trend")


@register("c04_school_rollup", O.rounded(O.sql("SELECT * FROM school_stats", "school_stats"), ["school_score_normalized"]))
def c04(spark, d):
    return _s.school_city_stats(_b.schools(_T(spark, d)))


@register("c05_amenity_rollup", O.sql("SELECT * FROM amenity_counts", "amenity_counts"))
def c05(spark, d):
    return _s.amenity_city_counts(_b.amenities(_T(spark, d)))


@register("c06_demographics_attach", O.rounded(O.sql("""
SELECT u.profile_id, d.population, d.median_income_usd, d.pct_homeowner FROM units u
LEFT JOIN demo_latest d ON u.country_code = d.country_code AND u.zip_or_municipio = d.zip_or_municipio""",
    "units", "demo_latest"), ["pct_homeowner"]))
def c06(spark, d):
    u = _s.geo_units(P(spark, d).listings)
    dm = _b.demographics(_T(spark, d)).groupBy("country_code", "zip_or_municipio").agg(
        F.max_by("population", "year").alias("population"), F.max_by("median_income_usd", "year").alias("median_income_usd"),
        F.max_by("pct_homeowner", "year").alias("pct_homeowner"))
    return u.join(dm, ["country_code", "zip_or_municipio"], "left").select("profile_id", "population", "median_income_usd",
                                                                           "pct_homeowner")


@register("c07_weather_attach", O.rounded(O.sql("SELECT * FROM weather_ext", "weather_ext"), ["weather_extreme_days_per_yr"]))
def c07(spark, d):
    return _s.weather_extremes(_b.weather(_T(spark, d)))


@register("c08_hazard_attach", O.rounded(O.sql("""
SELECT u.profile_id, r.composite_hazard_score AS hazard_composite_score FROM units u
LEFT JOIN risk_area r ON u.country_code = r.country_code AND u.zip_or_municipio = r.zip_or_municipio""",
    "units", "risk_area"), ["hazard_composite_score"]))
def c08(spark, d):
    p = P(spark, d)
    u = _s.geo_units(p.listings)
    r = _s.risk_by_area(p.risk).select("country_code", "zip_or_municipio",
                                       F.col("composite_hazard_score").alias("hazard_composite_score"))
    return u.join(r, ["country_code", "zip_or_municipio"], "left").select("profile_id", "hazard_composite_score")


@register("c09_access_scores", O.rounded(O.sql("""
SELECT profile_id, amenity_density_score, transit_access_score FROM profile""", "profile"),
    ["amenity_density_score", "transit_access_score"]))
def c09(spark, d):
    return P(spark, d).profile.select("profile_id", "amenity_density_score", "transit_access_score")
