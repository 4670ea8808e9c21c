"""Declared table schemas (k13): one DDL string per table, parsed to StructType.

Keys are non-nullable; every other column is nullable. Comments travel in the
field metadata so they survive a parquet round trip.
"""

from __future__ import annotations

from pyspark.sql import types as T

_ABBR = {"s": "string", "i": "int", "l": "bigint", "d": "double", "b": "boolean", "D": "date", "T": "timestamp"}

# layer.table -> (key columns, "name type, ...") with type abbreviations s i l d b D T
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "bronze.listings_us": (("listing_id",), "listing_id s, source s, scraped_at T, address s, city s, state s, zip s, lat d, lon d, price_usd l, bedrooms i, bathrooms d, sqft i, price_per_sqft_usd d, property_type s, description s, listing_url s, days_on_market i, listing_date D, raw_json s"),
    "bronze.listings_co": (("listing_id", "source"), "listing_id s, source s, scraped_at T, address s, city s, departamento s, barrio s, lat d, lon d, price_cop l, bedrooms i, bathrooms d, area_m2 d, property_type s, description s, listing_url s, raw_html s"),
    "bronze.weather_history": (("location_key", "date"), "location_key s, city s, country_code s, lat d, lon d, date D, temp_max_c d, temp_min_c d, temp_mean_c d, precipitation_mm d, wind_speed_max_kmh d, weather_code i, is_extreme_day b"),
    "bronze.crime_us": (("incident_id",), "incident_id s, source s, city s, state s, zip s, lat d, lon d, crime_type s, crime_category s, incident_date D, year i, ingested_at T"),
    "bronze.crime_co": (("record_id",), "record_id s, source s, city s, municipio s, departamento s, crime_type s, crime_category s, count i, period_year i, period_month i, ingested_at T"),
    "bronze.schools_us": (("school_id",), "school_id s, school_name s, city s, state s, zip s, lat d, lon d, grade_levels s, enrollment i, school_type s, title1_eligible b, math_proficiency_pct d, reading_proficiency_pct d, ingested_at T"),
    "bronze.schools_co": (("school_id",), "school_id s, institution_name s, city s, municipio s, departamento s, lat d, lon d, grade_levels s, enrollment i, school_type s, icfes_score d, icfes_percentile d, icfes_year i, ingested_at T"),
    "bronze.hazards": (("hazard_id",), "hazard_id s, source s, country_code s, state_or_dept s, county_or_municipio s, zip_or_zone s, lat d, lon d, hazard_type s, risk_level s, risk_score d, data_date D, details_json s, ingested_at T"),
    "bronze.demographics_us": (("geo_id", "year"), "geo_id s, state s, county s, zip s, city s, total_population i, median_household_income_usd i, median_age d, pct_college_educated d, pct_homeowner d, median_home_value_usd i, year i, ingested_at T"),
    "bronze.demographics_co": (("geo_id", "year"), "geo_id s, departamento s, municipio s, city s, total_population i, median_household_income_cop l, pct_urban d, pct_homeowner d, year i, ingested_at T"),
    "bronze.amenities": (("amenity_id",), "amenity_id s, country_code s, city s, lat d, lon d, amenity_type s, name s, address s, ingested_at T"),
    "bronze.market_trends_us": (("geo_id", "date", "source"), "geo_id s, geo_type s, zip s, city s, state s, date D, median_list_price_usd l, median_sale_price_usd l, median_days_on_market i, homes_sold i, inventory_count i, months_of_supply d, price_reduced_pct d, source s, ingested_at T"),
    "bronze.market_trends_co": (("geo_id", "date", "source"), "geo_id s, city s, departamento s, date D, ipvn_index d, yoy_change_pct d, new_construction_price_cop l, units_sold i, source s, ingested_at T"),
    "bronze.economic_us": (("geo_id", "date"), "geo_id s, metro_area s, state s, date D, unemployment_rate d, job_growth_yoy_pct d, median_wage_usd i, mortgage_rate_30yr d, ingested_at T"),
    "bronze.economic_co": (("geo_id", "date"), "geo_id s, city s, departamento s, date D, unemployment_rate d, inflation_rate d, mortgage_rate_pct d, gdp_growth_pct d, ingested_at T"),
    "bronze.exchange_rates": (("date", "from_currency", "to_currency"), "date D, from_currency s, to_currency s, rate d, ingested_at T"),
    "silver.listings": (("listing_id",), "listing_id s, source s, country_code s, city s, state_or_dept s, zip_or_municipio s, barrio_or_neighborhood s, lat d, lon d, price_usd l, price_local l, local_currency s, price_per_sqft_usd d, area_sqft d, bedrooms i, bathrooms d, property_type s, listing_url s, days_on_market i, listing_date D, scraped_at T"),
    "silver.market_summary": (("country_code", "city", "zip_or_municipio", "date"), "geo_id s, country_code s, city s, zip_or_municipio s, date D, median_price_usd l, price_trend_3mo_pct d, price_trend_12mo_pct d, median_days_on_market i, inventory_count l, months_of_supply d, market_temp s"),
    "silver.risk_profile": (("geo_id",), "geo_id s, country_code s, city s, zip_or_municipio s, flood_risk_score d, earthquake_risk_score d, wildfire_risk_score d, tornado_risk_score d, landslide_risk_score d, composite_hazard_score d, risk_label s, profile_updated_at T"),
    "gold.agent_sessions": (("session_id",), "session_id s, timestamp T, user_question s, intent s, planner_reasoning s, plan_json s, answer_text s, structured_results_json s, country_filter s, cities_mentioned s, tool_names_used s, evidence_record_count i, refinement_applied b, context_turns_used i, latency_seconds d"),
}


def schema(name: str) -> T.StructType:
    keys, spec = TABLES[name]
    fields = []
    for part in spec.split(","):
        col, ab = part.strip().split()
        fields.append(T.StructField(col, T._parse_datatype_string(_ABBR[ab]), col not in keys,
                                    {"comment": f"{name}.{col}"}))
    return T.StructType(fields)


def conform(df, name: str):
    """Select the declared columns in order with their types; absent ones become typed NULLs."""
    from pyspark.sql import functions as F
    have = set(df.columns)
    return df.select([(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                      for f in schema(name).fields])
