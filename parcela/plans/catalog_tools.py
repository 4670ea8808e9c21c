"""Registered query tools (t01-t14) with fixed request parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import bindings
from ..sources.tables import Tables
from . import gold, requests, sessions, silver, tools
from .catalog import O, register
from .pipeline import Pipeline

_PM = ["composite_score", "crime_rate_per_100k", "school_score_normalized", "amenity_density_score",
       "transit_access_score", "hazard_composite_score"]
_RM = ["flood_risk_score", "earthquake_risk_score", "wildfire_risk_score", "tornado_risk_score", "landslide_risk_score",
       "composite_hazard_score"]


def T(spark, d) -> Tables:
    return Tables.shared(spark, d)


@register("t01_search_listings", O.rounded(O.sql("""
SELECT l.listing_id, l.city, l.zip_or_municipio, l.price_usd, l.bedrooms, l.bathrooms, l.area_sqft, l.property_type,
       s.composite_score AS neighborhood_score, r.risk_label AS hazard_risk_label
FROM silver_listings l
LEFT JOIN score_area s ON l.country_code = s.country_code AND l.zip_or_municipio = s.zip_or_municipio
LEFT JOIN risk_area r ON l.country_code = r.country_code AND l.zip_or_municipio = r.zip_or_municipio
WHERE l.country_code = 'US' AND lower(l.city) = 'nation_1' AND l.price_usd >= 50000 AND l.price_usd <= 300000 AND l.bedrooms >= 2
ORDER BY l.price_usd ASC NULLS LAST, l.listing_id LIMIT 10""", "silver_listings", "score_area", "risk_area"),
    ["bathrooms", "area_sqft", "neighborhood_score"]))
def t01(spark, d):
    p = Pipeline(spark, d)
    return tools.search_listings(p.stage("listings"), p.stage("scorecard"), p.risk, "US", "Nation_1",
                                 min_price_usd=50000, max_price_usd=300000, bedrooms_min=2, limit=10)


@register("t02_neighborhood_profile", O.rounded(O.sql(f"""
SELECT * FROM one UNION ALL SELECT * FROM agg WHERE (SELECT count(*) FROM one) = 0""", "scorecard", extra={
    "base": "SELECT * FROM scorecard WHERE country_code = 'CO' AND lower(city) = 'nation_0'",
    "one": f"SELECT profile_id, zip_or_municipio, barrio, {', '.join(_PM)}, 'row' AS source FROM base "
           "WHERE zip_or_municipio = 'NATION_0' ORDER BY profile_id LIMIT 1",
    "agg": f"SELECT CAST(NULL AS VARCHAR) AS profile_id, CAST(NULL AS VARCHAR) AS zip_or_municipio, CAST(NULL AS VARCHAR) AS barrio, "
           f"{', '.join(f'avg({c}) AS {c}' for c in _PM)}, 'aggregate' AS source FROM base HAVING count(*) > 0"}), _PM))
def t02(spark, d):
    return tools.neighborhood_profile(Pipeline(spark, d).stage("scorecard"), "CO", "NATION_0", zip_or_municipio="NATION_0")


@register("t03_crime_stats", O.sql("""
SELECT crime_category, CAST(sum("count") AS BIGINT) AS n, (SELECT CAST(sum("count") AS BIGINT) FROM crime WHERE country_code = 'CO' AND lower(city) = 'nation_0') AS total
FROM (SELECT *, CASE WHEN raw = '' THEN 'other'
       WHEN raw LIKE '%homicid%' OR raw LIKE '%lesion%' OR raw LIKE '%secuestr%' OR raw LIKE '%violenc%' OR raw LIKE '%violacion%'
         OR raw LIKE '%feminicid%' OR raw LIKE '%delitos sexuales%' OR raw LIKE '%sexual%' THEN 'violent'
       WHEN raw LIKE '%hurto%' AND (raw LIKE '%violen%') THEN 'violent'
       WHEN raw LIKE '%hurto%' OR raw LIKE '%robo%' OR raw LIKE '%dano%' OR raw LIKE '%abigeato%' OR raw LIKE '%piracy%' OR raw LIKE '%pirateria%' THEN 'property'
       ELSE 'other' END AS crime_category
      FROM (SELECT *, translate(lower(trim(crime_type)), 'áéíóúñü', 'aeiounu') AS raw FROM crime) c
      WHERE country_code = 'CO' AND lower(city) = 'nation_0') x
GROUP BY 1""", "crime"))
def t03(spark, d):
    return tools.crime_stats(bindings.crime(T(spark, d)), "CO", "NATION_0")


@register("t04_school_rankings", O.rounded(O.sql("""
SELECT school_id, city, school_score_normalized FROM school_rankings WHERE country_code = 'CO' AND lower(city) = 'nation_2'
ORDER BY school_score_normalized DESC NULLS LAST, school_id LIMIT 8""", "school_rankings"), ["school_score_normalized"]))
def t04(spark, d):
    return tools.school_rankings(gold.school_rankings(bindings.schools(T(spark, d))), "CO", "NATION_2", limit=8)


@register("t05_weather_summary", O.rounded(O.sql(f"""
SELECT avg(temp_max_c) AS avg_temp_max_c, avg(temp_min_c) AS avg_temp_min_c, avg(precipitation_mm) AS avg_precip_mm,
       CAST(sum(CASE WHEN {O.EXTREME} THEN 1 ELSE 0 END) AS BIGINT) AS total_extreme_days,
       count(DISTINCT year(date)) AS years_covered, min(date) AS first_date, max(date) AS last_date,
       CAST(sum(CASE WHEN {O.EXTREME} THEN 1 ELSE 0 END) AS DOUBLE) / nullif(count(DISTINCT year(date)), 0) AS extreme_days_per_year
FROM weather WHERE country_code = 'US' AND lower(city) = 'nation_1'""", "weather"),
    ["avg_temp_max_c", "avg_temp_min_c", "avg_precip_mm", "extreme_days_per_year"]))
def t05(spark, d):
    return tools.weather_summary(bindings.weather(T(spark, d)), "US", "NATION_1")


@register("t06_hazard_risks", O.rounded(O.sql("""
SELECT * FROM one UNION ALL SELECT * FROM agg WHERE (SELECT count(*) FROM one) = 0""", "risk", extra={
    "base": "SELECT * FROM risk WHERE country_code = 'CO' AND lower(city) = 'nation_3'",
    "one": f"SELECT geo_id, {', '.join(_RM)}, risk_label, 'row' AS source FROM base ORDER BY geo_id, " + ", ".join(_RM) + " LIMIT 1",
    "agg": f"SELECT CAST(NULL AS VARCHAR) AS geo_id, {', '.join(f'avg({c}) AS {c}' for c in _RM)}, "
           "CASE WHEN avg(composite_hazard_score) < 25 THEN 'low' WHEN avg(composite_hazard_score) < 50 THEN 'medium' "
           "WHEN avg(composite_hazard_score) < 75 THEN 'high' ELSE 'very_high' END AS risk_label, 'aggregate' AS source "
           "FROM base HAVING avg(composite_hazard_score) IS NOT NULL"}),
    _RM))
def t06(spark, d):
    return tools.hazard_risks(Pipeline(spark, d).risk, "CO", "NATION_3")


@register("t07_market_trends", O.sql("""
SELECT arg_max(date, (date, zip_or_municipio)) AS latest_date, arg_max(median_price_usd, (date, zip_or_municipio)) AS latest_median_price_usd,
       arg_max(market_temp, (date, zip_or_municipio)) AS latest_market_temp, round(first(price_trend_3mo_pct ORDER BY date DESC, zip_or_municipio DESC), 6) AS price_trend_3mo_pct,
       round(first(price_trend_12mo_pct ORDER BY date DESC, zip_or_municipio DESC), 6) AS price_trend_12mo_pct,
       first(median_days_on_market ORDER BY date DESC, zip_or_municipio DESC) AS median_days_on_market, CAST(count(*) AS INT) AS n_points,
       string_agg(concat_ws(':', CAST(date AS VARCHAR), zip_or_municipio, CAST(median_price_usd AS VARCHAR), CAST(inventory_count AS VARCHAR)), ',' ORDER BY date, zip_or_municipio) AS series
FROM (SELECT * FROM market_summary WHERE country_code = 'US' AND lower(city) = 'nation_1'
      ORDER BY date DESC, zip_or_municipio DESC LIMIT 12) x""", "market_summary"))
def t07(spark, d):
    return tools.market_trends(Pipeline(spark, d).market_summary, "US", "NATION_1", months_back=12)


@register("t08_area_demographics", O.rounded(O.sql("""
SELECT CAST(sum(population) AS BIGINT) AS population, CAST(NULL AS DOUBLE) AS median_age, avg(median_income_usd) AS median_income, avg(pct_homeowner) AS pct_homeowner,
       avg(median_income_usd) / (SELECT fx_rate FROM fx_latest) AS median_income_usd
FROM demographics WHERE country_code = 'CO' AND zip_or_municipio = 'NATION_2'""", "demographics", "fx_latest"),
    ["median_income", "pct_homeowner", "median_income_usd"]))
def t08(spark, d):
    t = T(spark, d)
    return tools.area_demographics(bindings.demographics(t), silver.latest_fx(bindings.fx(t)), "CO", "NATION_2")


@register("t09_nearby_amenities", O.sql("""
SELECT amenity_id, amenity_type, name FROM amenities WHERE country_code = 'CO' AND lower(city) = 'nation_4'
  AND amenity_type IN ('grocery', 'park') ORDER BY amenity_type, name, amenity_id LIMIT 20""", "amenities"))
def t09(spark, d):
    return tools.nearby_amenities(bindings.amenities(T(spark, d)), "CO", "NATION_4", ["grocery", "park"], 20)


_DIMS = tools.INDEX_DIMS


@register("t10_compare_cities", O.rounded(O.sql(f"""
SELECT r.us_city, r.co_city, CASE WHEN s.us_city IS NOT NULL THEN 'stored' WHEN u.city IS NULL OR c.city IS NULL THEN 'insufficient' ELSE 'medians' END AS source,
       s.comparison_date, s.price_ratio,
       {', '.join(f'CASE WHEN s.us_city IS NULL AND c.city IS NOT NULL THEN u.{c} END AS us_{c}' for c in _DIMS)},
       {', '.join(f'CASE WHEN s.us_city IS NULL AND u.city IS NOT NULL THEN c.{c} END AS co_{c}' for c in _DIMS)}
FROM (VALUES ('Nation_1', 'NATION_0'), ('NATION_6', 'nation_9'), ('NATION_1', 'NOWHERE')) AS r(us_city, co_city)
LEFT JOIN (SELECT lower(us_city) AS us_city, lower(co_city) AS co_city, max(comparison_date) AS comparison_date, arg_max(price_ratio, comparison_date) AS price_ratio
           FROM city_comparison GROUP BY 1, 2) s ON lower(r.us_city) = s.us_city AND lower(r.co_city) = s.co_city
LEFT JOIN (SELECT lower(city) AS city, {', '.join(f'median({c}) AS {c}' for c in _DIMS)} FROM comparison_index WHERE country_code = 'US' GROUP BY 1) u
  ON lower(r.us_city) = u.city
LEFT JOIN (SELECT lower(city) AS city, {', '.join(f'median({c}) AS {c}' for c in _DIMS)} FROM comparison_index WHERE country_code = 'CO' GROUP BY 1) c
  ON lower(r.co_city) = c.city""", "city_comparison", "comparison_index"),
    ["price_ratio"] + [f"{p}_{c}" for p in ("us", "co") for c in _DIMS]))
def t10(spark, d):
    p = Pipeline(spark, d)
    req = spark.createDataFrame([("Nation_1", "NATION_0"), ("NATION_6", "nation_9"), ("NATION_1", "NOWHERE")], "us_city string, co_city string")
    return tools.compare_cities(req, p.stage("city_pairs"), p.stage("comparison_index"))


@register("t11_affordability", O.rounded(O.sql("""
SELECT mortgage_rate, rate_note, pmt AS monthly_payment_usd,
       CASE WHEN r <= 0 THEN pmt * 360 ELSE pmt / r * (1e0 - pow(1e0 + r, -360e0)) END + 2e4 AS max_affordable_price_usd,
       area_median_price_usd,
       CASE WHEN r <= 0 THEN pmt * 360 ELSE pmt / r * (1e0 - pow(1e0 + r, -360e0)) END + 2e4 >= area_median_price_usd AS can_afford_median
FROM (SELECT mortgage_rate, mortgage_rate / 1e2 / 12e0 AS r, 7e4 * 0.28e0 / 12e0 AS pmt, area_median_price_usd, rate_note
      FROM (SELECT coalesce(arg_max(mortgage_rate_30yr, (date, city)), 7e0) AS mortgage_rate,
                   CASE WHEN count(*) > 0 THEN 'latest rate' ELSE 'default rate' END AS rate_note FROM economic
            WHERE country_code = 'US' AND mortgage_rate_30yr IS NOT NULL) a
      CROSS JOIN (SELECT median(median_price_usd) AS area_median_price_usd FROM market_summary
                  WHERE country_code = 'US' AND lower(city) = 'nation_1'
                    AND date = (SELECT max(date) FROM market_summary WHERE country_code = 'US' AND lower(city) = 'nation_1')) b) x""",
    "economic", "market_summary"), ["mortgage_rate", "monthly_payment_usd", "max_affordable_price_usd", "area_median_price_usd"]))
def t11(spark, d):
    p = Pipeline(spark, d)
    return tools.affordability(bindings.economic(p.t), p.market_summary, "US", "NATION_1", 70000, 20000)


@register("t12_value_opportunities", O.rounded(O.sql("""
SELECT listing_id, price_usd, area_median_price_usd, discount_pct FROM value_opportunities
WHERE country_code = 'CO' AND lower(city) = 'nation_0' AND price_usd <= 200000
ORDER BY discount_pct DESC NULLS LAST, listing_id LIMIT 10""", "value_opportunities"), ["discount_pct"]))
def t12(spark, d):
    return tools.value_opportunities(Pipeline(spark, d).value_opportunities(sort=False), "CO", "NATION_0", 200000, 10)


_AC = ["amenity_density_score", "transit_access_score", "grocery_count", "park_count", "hospital_count", "transit_stop_count"]


@register("t13_amenity_access", O.rounded(O.sql(f"""
SELECT {', '.join(f'avg({c}) AS avg_{c}' for c in _AC)} FROM scorecard WHERE country_code = 'US' AND lower(city) = 'nation_6'""",
    "scorecard"), [f"avg_{c}" for c in _AC]))
def t13(spark, d):
    return tools.amenity_access(Pipeline(spark, d).stage("scorecard"), "US", "NATION_6")


# CO cities that calls may name.
CO_CITIES = ["NATION_0", "NATION_2", "NATION_7", "NATION_12"]


def tool_tables(p: Pipeline) -> requests.ToolTables:
    return requests.ToolTables(
        listings=p.stage("listings"), scorecard=p.stage("scorecard"), risk=p.stage("risk"), market_summary=p.stage("market_summary"),
        opportunities=p.value_opportunities(sort=False), city_pairs=p.stage("city_pairs"), comparison_index=p.stage("comparison_index"), crime=p.crime,
        schools=p.school_rankings, weather=p.weather, demographics=p.demographics, amenities=p.amenities, economic=p.economic, fx_rate=silver.latest_fx(p.fx))


def answered_calls(p: Pipeline):
    """conv_id, turn, call_order, tool, result_json of every valid call of the plans."""
    calls = sessions.validate_calls(tools.plan_calls(bindings.plans(p.t)), CO_CITIES).where("status = 'ok'")
    typed = p.write("calls", requests.requests_of(calls, ["conv_id", "turn"]))
    answers = requests.answer_requests(p.write("requests", requests.distinct_requests(typed)), tool_tables(p))
    return typed.select("conv_id", "turn", "call_order", "tool", "rid").join(answers, "rid").drop("rid")


@register("t14_tool_dispatch", O.sql("SELECT * FROM dispatch", "dispatch"))
def t14(spark, d):
    return answered_calls(Pipeline(spark, d))
