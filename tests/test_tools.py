"""Query-tool edge cases: fallbacks, clamps and the relaxed retry."""

from pyspark.sql import functions as F

from parcela.plans import sessions, tools
from parcela.plans.pipeline import Pipeline


def test_profile_falls_back_to_city_average(spark, small):
    card = Pipeline(spark, small).stage("scorecard")
    some = card.filter((F.col("country_code") == "CO") & (F.col("city") == "NATION_0")).select("zip_or_municipio").first()
    hit = tools.neighborhood_profile(card, "CO", "NATION_0", zip_or_municipio=some["zip_or_municipio"]).collect()
    assert len(hit) == 1 and hit[0]["source"] == "row"
    miss = tools.neighborhood_profile(card, "CO", "NATION_0", zip_or_municipio="NO_SUCH_ZIP").collect()
    assert len(miss) == 1 and miss[0]["source"] == "aggregate" and miss[0]["profile_id"] is None
    unknown = tools.neighborhood_profile(card, "CO", "NO_SUCH_CITY").collect()
    assert unknown == []


def test_limits_are_clamped(spark, small):
    p = Pipeline(spark, small)
    rows = tools.search_listings(p.stage("listings"), p.stage("scorecard"), p.risk, "CO", "NATION_0", limit=999).count()
    assert rows <= 50
    rows = tools.search_listings(p.stage("listings"), p.stage("scorecard"), p.risk, "CO", "NATION_0", limit="abc").count()
    assert rows <= 10


def test_relaxed_retry_only_when_strict_is_empty(spark, small):
    p = Pipeline(spark, small)
    args = (p.stage("listings"), p.stage("scorecard"), p.risk, "CO", "NATION_0")
    strict = sessions.relaxed_search(*args, min_price_usd=0, max_price_usd=10_000_000).collect()
    assert strict and not any(r["relaxed"] for r in strict)
    relaxed = sessions.relaxed_search(*args, min_price_usd=1, max_price_usd=2, bedrooms_min=9).collect()
    assert all(r["relaxed"] for r in relaxed)


def test_keyword_router_default_pair(spark):
    df = spark.createDataFrame([(1, 0, "hello there"), (1, 1, "is it safe for my kids in bogota?")],
                               "conv_id long, turn long, text string")
    df = df.withColumn("city", sessions.detect_city("text"))
    out = {r["turn"]: r["t"] for r in df.select("turn", F.array_join(F.transform(sessions.route_keywords("text", "city"), lambda c: c["tool"]), ",").alias("t")).collect()}
    assert out[0] == "search_listings,get_market_trends"
    assert out[1] == "get_neighborhood_profile,get_market_trends,get_school_rankings,get_crime_stats"


def test_unknown_city_is_an_empty_frame(spark, small):
    from parcela.sources import bindings
    from parcela.plans import silver
    p = Pipeline(spark, small)
    none = ("US", "NO_SUCH_CITY")
    frames = [tools.neighborhood_profile(p.stage("scorecard"), *none), tools.weather_summary(p.weather, *none), tools.hazard_risks(p.risk, *none),
              tools.market_trends(p.stage("market_summary"), *none), tools.amenity_access(p.stage("scorecard"), *none),
              tools.area_demographics(p.demographics, silver.latest_fx(bindings.fx(p.t)), "US", "NO_SUCH_ZIP")]
    assert [f.count() for f in frames] == [0] * 6


def test_validation_drops_and_clamps(spark):
    rows = [("search_listings", {"country_code": "US", "city": "Austin", "limit": "abc"}), ("search_listings", {"limit": "999", "bathrooms_min": "11.5"}),
            ("search_listings", {"limit": "3.7", "min_price_usd": "-1"}), ("launch", {}), ("compare_cities", {"us_city": "Austin", "co_city": "Cali"}),
            ("get_market_trends", {"country_code": "CO", "city": "Bogotá", "months_back": "-4"}), ("get_nearby_amenities", {"amenity_types": '["park","x"]'}),
            ("get_nearby_amenities", {"amenity_types": '["park"]', "barrio": None, "other": "kept"})]
    calls = spark.createDataFrame([(1, 0, i, t, p) for i, (t, p) in enumerate(rows)], "conv_id long, turn long, call_index int, tool string, params map<string,string>")
    got = {r.call_index: (r.call_order, r.status, r.params) for r in sessions.validate_calls(calls, ["Bogota", "Medellin"], max_calls=2).collect()}
    assert got == {1: (0, "ok", {"limit": "50", "bathrooms_min": "10.0"}),
                   5: (1, "ok", {"country_code": "CO", "city": "Bogota", "months_back": "1"}),
                   7: (2, "over_limit", {"amenity_types": '["park"]', "barrio": None, "other": "kept"})}


def test_context_city_over_long_conversations(spark):
    turns = spark.createDataFrame([(1, t, "A" if t == 0 else "B" if t == 9 else None) for t in range(30)] + [(2, 0, None)], "conv_id long, turn long, city string")
    got = {(r.conv_id, r.turn): r.context_city for r in sessions.with_context_city(turns, block=4).collect()}
    assert got == {(1, t): "A" if t < 9 else "B" for t in range(30)} | {(2, 0): None}
    near = {r.turn: r.context_city for r in sessions.with_context_city(turns.where("conv_id = 1"), block=4, max_turns=3).collect()}
    assert near == {t: "A" if t < 4 else "B" if 9 <= t < 13 else None for t in range(30)}
