"""Registered session-log queries (g01-g11, c23, l05) over the conversation log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import bindings
from ..sources.tables import Tables
from . import sessions, tools
from .catalog import O, register
from .gold import recent_rows
from .pipeline import Pipeline

KEYS = ["conv_id", "turn"]


def _evidence(spark, d):
    return sessions.evidence(bindings.results(Tables.shared(spark, d)))


@register("g01_cities_from_plan", O.sql("SELECT * FROM plan_cities", "plan_cities"))
def g01(spark, d):
    calls = tools.plan_calls(bindings.plans(Tables.shared(spark, d)))
    return sessions.cities_from_calls(calls).select(*KEYS, "cities_mentioned")


@register("g02_country_filter", O.sql("SELECT * FROM plan_countries", "plan_countries"))
def g02(spark, d):
    calls = tools.plan_calls(bindings.plans(Tables.shared(spark, d)))
    return sessions.cities_from_calls(calls).select(*KEYS, "country_filter")


@register("g03_record_count", O.sql("SELECT conv_id, turn, evidence_record_count FROM session_summary", "session_summary"))
def g03(spark, d):
    return sessions.session_summary(_evidence(spark, d)).select(*KEYS, "evidence_record_count")


@register("g04_numeric_facts", O.sql("SELECT conv_id, turn, structured_results_json FROM session_summary", "session_summary"))
def g04(spark, d):
    return sessions.session_summary(_evidence(spark, d)).select(*KEYS, "structured_results_json")


@register("g05_session_append", O.sql("SELECT * FROM sessions", "sessions"))
def g05(spark, d):
    t = Tables.shared(spark, d)
    return sessions.session_rows(bindings.plans(t), t.conversations, bindings.results(t))


_CITY_SQL = ("CASE WHEN lower(text) LIKE '%bogot%' THEN 'Bogota' WHEN lower(text) LIKE '%medell%' THEN 'Medellin' "
             + " ".join(f"WHEN lower(text) LIKE '%{c}%' THEN '{c.title()}'" for c in sessions.US_CITIES) + " END")


def _call_sql(tool: str, **params) -> str:
    body = " || ',' || ".join(f"""'"{k}":"' || {v} || '"'""" for k, v in params.items())
    return f"""'{{"tool":"{tool}","params":{{' || {body} || '}}}}'"""


def _route_sql() -> str:
    parts = ["CASE WHEN city IS NOT NULL THEN " + _call_sql("get_neighborhood_profile", country_code="country", city="city") + " END",
             "CASE WHEN city IS NOT NULL THEN " + _call_sql("get_market_trends", country_code="country", city="city", months_back="12") + " END"]
    more = {"get_school_rankings": {"limit": "8"}, "get_crime_stats": {"months_back": "12"},
            "get_affordability_analysis": {"annual_income_usd": "70000", "down_payment_usd": "20000"}}
    for words, tool in sessions.KEYWORD_TOOLS:
        cond = " OR ".join(f"lower(text) LIKE '%{w}%'" for w in words)
        call = _call_sql(tool, us_city="'Miami'", co_city="coalesce(city, 'Medellin')") if tool == "compare_cities" else \
            _call_sql(tool, country_code="coalesce(country, 'CO')", city="coalesce(city, 'Medellin')", **more.get(tool, {}))
        parts.append(f"CASE WHEN {cond} THEN {call} END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


_DEFAULT_SQL = "[" + _call_sql("search_listings", country_code="'CO'", city="'Medellin'", limit="10") + ", " + \
    _call_sql("get_market_trends", country_code="'CO'", city="'Medellin'", months_back="12") + "]"


@register("g06_keyword_router", f"""
SELECT conv_id, turn, city, concat('[', array_to_string(CASE WHEN len(r) = 0 THEN {_DEFAULT_SQL} ELSE r END, ','), ']') AS calls
FROM (SELECT conv_id, turn, city, {_route_sql()} AS r
      FROM (SELECT *, CASE WHEN city IN ('Bogota', 'Medellin') THEN 'CO' WHEN city IS NOT NULL THEN 'US' END AS country
            FROM (SELECT conv_id, turn, text, {_CITY_SQL} AS city FROM conversations WHERE role = 'user') c) d) x""")
def g06(spark, d):
    c = Tables.shared(spark, d).conversations.filter(F.col("role") == "user").withColumn("city", sessions.detect_city("text"))
    return c.select(*KEYS, "city", F.to_json(sessions.route_keywords("text", "city")).alias("calls"))


@register("g07_context_carry_forward", f"""
SELECT conv_id, turn, city, last_value(city IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
                                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS context_city
FROM (SELECT conv_id, turn, {_CITY_SQL} AS city FROM conversations) c""")
def g07(spark, d):
    c = Tables.shared(spark, d).conversations.select(*KEYS, sessions.detect_city("text").alias("city"))
    return sessions.with_context_city(c, block=4)


_CO = "('NATION_0', 'NATION_2', 'NATION_7', 'NATION_12')"


def _clamp_sql(c: str, lo: int, hi: int) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN greatest({lo}, least({hi}, CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS BIGINT))) END"


@register("g08_call_validation", O.sql(f"""
SELECT conv_id, turn, call_index, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY call_index) - 1 AS INT) AS call_order, 'ok' AS status, tool,
       country_code, city, us_city, co_city, {_clamp_sql('lim', 1, 50)} AS "limit", {_clamp_sql('months_back', 1, 24)} AS months_back,
       {_clamp_sql('bedrooms_min', 0, 10)} AS bedrooms_min, TRY_CAST(min_price_usd AS DOUBLE) AS min_price_usd
FROM plan_calls
WHERE tool IN ({', '.join(repr(t) for t in sessions.ALLOWED_TOOLS)})
  AND coalesce(country_code IN ('US', 'CO'), true) AND coalesce(length(city) > 0, true)
  AND NOT coalesce(country_code = 'CO' AND city NOT IN {_CO}, false) AND coalesce(co_city IN {_CO}, true)
  AND (lim IS NULL OR TRY_CAST(lim AS DOUBLE) IS NOT NULL) AND (months_back IS NULL OR TRY_CAST(months_back AS DOUBLE) IS NOT NULL)
  AND (bedrooms_min IS NULL OR TRY_CAST(bedrooms_min AS DOUBLE) IS NOT NULL)
  AND (min_price_usd IS NULL OR TRY_CAST(min_price_usd AS DOUBLE) >= 0)""", "plan_calls"))
def g08(spark, d):
    calls = tools.plan_calls(bindings.plans(Tables.shared(spark, d)))
    v = sessions.validate_calls(calls, ["NATION_0", "NATION_2", "NATION_7", "NATION_12"])
    p = {k: F.element_at("params", F.lit(k)) for k in ("country_code", "city", "us_city", "co_city", "limit", "months_back", "bedrooms_min", "min_price_usd")}
    return v.select(*KEYS, "call_index", "call_order", "status", "tool", *[p[k].alias(k) for k in ("country_code", "city", "us_city", "co_city")],
                    *[p[k].cast("bigint").alias(k) for k in ("limit", "months_back", "bedrooms_min")], p["min_price_usd"].cast("double").alias("min_price_usd"))


@register("g09_sparse_flag", O.sql("SELECT conv_id, turn, tool, sparse FROM evidence", "evidence"))
def g09(spark, d):
    return _evidence(spark, d).select(*KEYS, "tool", "sparse")


@register("g10_evidence_summary", O.sql("SELECT conv_id, turn, evidence_summary FROM session_summary", "session_summary"))
def g10(spark, d):
    return sessions.session_summary(_evidence(spark, d)).select(*KEYS, "evidence_summary")


@register("g11_relaxed_retry", O.rounded(O.sql("""
SELECT * FROM strict_r UNION ALL SELECT * FROM relaxed_r WHERE (SELECT count(*) FROM strict_r) = 0""",
    "silver_listings", "score_area", "risk_area", extra={
        "strict_r": """SELECT l.listing_id, l.city, l.zip_or_municipio, l.price_usd, l.bedrooms, l.bathrooms, l.area_sqft, l.property_type,
       s.composite_score AS neighborhood_score, r.risk_label AS hazard_risk_label, false AS relaxed
FROM silver_listings l LEFT JOIN score_area s ON l.country_code = s.country_code AND l.zip_or_municipio = s.zip_or_municipio
LEFT JOIN risk_area r ON l.country_code = r.country_code AND l.zip_or_municipio = r.zip_or_municipio
WHERE l.country_code = 'US' AND lower(l.city) = 'nation_6' AND l.price_usd >= 10000 AND l.price_usd <= 12000 AND l.bedrooms >= 5
ORDER BY l.price_usd ASC NULLS LAST, l.listing_id LIMIT 10""",
        "relaxed_r": """SELECT l.listing_id, l.city, l.zip_or_municipio, l.price_usd, l.bedrooms, l.bathrooms, l.area_sqft, l.property_type,
       s.composite_score AS neighborhood_score, r.risk_label AS hazard_risk_label, true AS relaxed
FROM silver_listings l LEFT JOIN score_area s ON l.country_code = s.country_code AND l.zip_or_municipio = s.zip_or_municipio
LEFT JOIN risk_area r ON l.country_code = r.country_code AND l.zip_or_municipio = r.zip_or_municipio
WHERE l.country_code = 'US' AND lower(l.city) = 'nation_6' AND l.price_usd >= 7000 AND l.price_usd <= 15600
ORDER BY l.price_usd ASC NULLS LAST, l.listing_id LIMIT 10"""}), ["bathrooms", "area_sqft", "neighborhood_score"]))
def g11(spark, d):
    p = Pipeline(spark, d)
    return sessions.relaxed_search(p.stage("listings"), p.stage("scorecard"), p.risk, "US", "NATION_6",
                                   min_price_usd=10000, max_price_usd=12000, bedrooms_min=5)


@register("c23_recent_sessions", O.sql("SELECT * FROM sessions ORDER BY timestamp DESC, session_id DESC LIMIT 100", "sessions"))
def c23(spark, d):
    return recent_rows(g05(spark, d), "timestamp", 100, tie=["session_id"])


@register("l05_recent_100", O.sql("SELECT session_id, timestamp FROM sessions ORDER BY timestamp DESC, session_id DESC LIMIT 100",
                                  "sessions"))
def l05(spark, d):
    return recent_rows(g05(spark, d), "timestamp", 100, tie=["session_id"]).select("session_id", "timestamp")
