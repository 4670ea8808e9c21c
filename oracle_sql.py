"""Independent DuckDB SQL for every registered query (the correctness oracle).

CTE blocks mirror the bindings and builds in plain SQL. ``sql(final, *ctes)``
assembles a statement with the CTEs it needs, in dependency order.
"""

from __future__ import annotations

from parcela.sources.bindings import PLAN_EXTRAS

UPDATED_AT = "TIMESTAMP '2024-01-01 00:00:00'"

CTE: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, body: str, deps=()):
    CTE[name] = body
    DEPS[name] = list(deps)


def _order(names):
    seen, out = set(), []

    def visit(n):
        if n in seen:
            return
        seen.add(n)
        for d in DEPS[n]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def sql(final: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``final`` preceded by the named CTEs (with dependencies) and ``extra`` local CTEs."""
    order = _order(names)
    blocks = [f"{n} AS ({CTE[n]})" for n in order] + [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not blocks:
        return final
    return "WITH " + ",\n".join(blocks) + "\n" + final


def rounded(inner: str, cols, digits: int = 6) -> str:
    """Wrap a query, rounding the listed DOUBLE columns (the Spark side rounds the same)."""
    if not cols:
        return inner
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) _q"


# --- bindings --------------------------------------------------------------------------
cte("listings_raw", """
SELECT concat_ws('_', CASE WHEN n.n_regionkey = 1 THEN 'us' ELSE 'co' END,
                 CAST(o.o_custkey AS VARCHAR), CAST(o.o_orderkey % 3 AS VARCHAR)) AS listing_id,
       o.o_orderkey AS seq,
       CASE WHEN n.n_regionkey = 1 THEN 'US' ELSE 'CO' END AS country_code,
       n.n_name AS city,
       CASE WHEN n.n_regionkey = 1 THEN concat('Z', CAST(o.o_custkey % 7 AS VARCHAR)) ELSE n.n_name END AS zip_or_municipio,
       CAST(floor(o.o_totalprice) AS BIGINT) AS price_usd,
       CAST(o.o_orderkey % 6 AS INT) AS bedrooms,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(300 + o.o_orderkey % 2000 AS DOUBLE) END AS area_sqft,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'single_family' WHEN '2-HIGH' THEN 'condo'
            WHEN '3-MEDIUM' THEN 'Town Home' WHEN '5-LOW' THEN 'casa' ELSE 'loft' END AS property_type,
       o.o_orderdate AS scraped_at,
       CAST((o.o_custkey * 7919) % 12000 AS DOUBLE) / 1e2 - 6e1 + CAST(o.o_orderkey % 10 AS DOUBLE) / 1e3 AS lat,
       CAST((o.o_custkey * 104729) % 35900 AS DOUBLE) / 1e2 - 179.5e0 + CAST(o.o_orderkey % 10 AS DOUBLE) / 1e3 AS lon,
       CASE WHEN n.n_regionkey = 1 THEN NULL ELSE concat('B', CAST(o.o_orderkey % 4 AS VARCHAR)) END AS barrio_or_neighborhood,
       CAST(1 + o.o_orderkey % 3 AS DOUBLE) AS bathrooms,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'site_a' ELSE 'site_b' END AS source,
       CASE WHEN n.n_regionkey <> 1 THEN CAST(floor(o.o_totalprice) AS BIGINT) * 4000 + o.o_orderkey % 1000 END AS price_cop,
       CASE WHEN n.n_regionkey <> 1 AND o.o_orderkey % 11 <> 0 THEN CAST(30 + o.o_orderkey % 200 AS DOUBLE) END AS area_m2,
       CASE WHEN n.n_regionkey <> 1 THEN concat('D', CAST(o.o_custkey % 5 AS VARCHAR)) END AS departamento
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("market_raw", """
SELECT *, CASE WHEN country_code = 'US' AND month(date) % 3 <> 0 THEN median_price_usd END AS median_sale_price_usd,
       CASE WHEN country_code = 'US' THEN median_price_usd + 500 END AS median_list_price_usd,
       CASE WHEN country_code <> 'US' THEN median_price_usd * 4000 + 7 END AS new_construction_price_cop,
       CASE WHEN country_code = 'US' THEN CAST(inventory_count % 90 AS INT) END AS median_days_on_market
FROM (SELECT CASE WHEN n.n_regionkey = 1 THEN 'US' ELSE 'CO' END AS country_code, n.n_name AS city,
       CASE WHEN n.n_regionkey = 1 THEN concat('Z', CAST(o.o_custkey % 7 AS VARCHAR)) ELSE n.n_name END AS zip_or_municipio,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date,
       CAST(floor(median(o.o_totalprice)) AS BIGINT) AS median_price_usd,
       COUNT(*) AS inventory_count,
       CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS homes_sold
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2, 3, 4) m""")

cte("hazards", """
SELECT concat('h_', CAST(event_id AS VARCHAR)) AS hazard_id,
       CASE WHEN user_id % 5 = 1 THEN 'US' ELSE 'CO' END AS country_code,
       concat('NATION_', CAST(user_id % 25 AS VARCHAR)) AS county_or_municipio,
       concat('Z', CAST(user_id % 7 AS VARCHAR)) AS zip_or_zone,
       CASE event_type WHEN 'click' THEN 'flood' WHEN 'view' THEN 'earthquake' WHEN 'signup' THEN 'wildfire'
            WHEN 'purchase' THEN 'tornado' ELSE 'hurricane' END AS hazard_type,
       least(value / 5e2, 1e0) AS risk_score, 'events' AS source, CAST(NULL AS VARCHAR) AS state_or_dept
FROM events""")

cte("centroids", """
SELECT c_custkey AS geo_id, CAST((c_custkey * 7919) % 12000 AS DOUBLE) / 1e2 - 6e1 AS lat,
       CAST((c_custkey * 104729) % 35900 AS DOUBLE) / 1e2 - 179.5e0 AS lon
FROM customer""")

cte("grid", """
SELECT s_suppkey AS point_id, CAST((s_suppkey * 6151) % 12000 AS DOUBLE) / 1e2 - 6e1 AS lat,
       CAST((s_suppkey * 15485863) % 35900 AS DOUBLE) / 1e2 - 179.5e0 AS lon,
       CAST(s_suppkey % 13 AS DOUBLE) / 2e1 AS pga
FROM supplier""")

cte("amenities", """
SELECT CAST(p_partkey AS VARCHAR) AS amenity_id,
       CASE WHEN p_partkey % 5 = 1 THEN 'US' ELSE 'CO' END AS country_code,
       concat('NATION_', CAST(p_partkey % 25 AS VARCHAR)) AS city,
       CASE p_size % 6 WHEN 0 THEN 'grocery' WHEN 1 THEN 'park' WHEN 2 THEN 'hospital' WHEN 3 THEN 'transit_stop'
            WHEN 4 THEN 'pharmacy' ELSE 'restaurant' END AS amenity_type,
       p_name AS name
FROM part""")

cte("schools", """
SELECT CAST(p_partkey AS VARCHAR) AS school_id,
       CASE WHEN p_partkey % 5 = 1 THEN 'US' ELSE 'CO' END AS country_code,
       concat('NATION_', CAST(p_partkey % 25 AS VARCHAR)) AS city,
       CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 9 = 0 THEN -2e0 ELSE CAST(p_size * 2 AS DOUBLE) END AS math_pct,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 101 AS DOUBLE) END AS reading_pct,
       CASE WHEN p_partkey % 5 <> 1 AND p_partkey % 7 <> 0 THEN CAST((p_partkey * 53) % 1010 AS DOUBLE) / 10 END AS icfes_percentile,
       concat(CASE WHEN p_partkey % 5 = 1 THEN 'S' ELSE 'D' END, CAST(p_partkey % 5 AS VARCHAR)) AS state_or_dept,
       CASE WHEN p_partkey % 5 = 1 THEN concat('Z', CAST(p_partkey % 7 AS VARCHAR)) ELSE concat('NATION_', CAST(p_partkey % 25 AS VARCHAR)) END AS zip_or_municipio,
       CAST((p_partkey * 7919) % 12000 AS DOUBLE) / 1e2 - 6e1 AS lat, CAST((p_partkey * 104729) % 35900 AS DOUBLE) / 1e2 - 179.5e0 AS lon,
       p_name AS school_name, CASE WHEN p_partkey % 3 = 0 THEN 'KG-05' ELSE '06-12' END AS grade_levels, CAST(p_size * 10 AS INT) AS enrollment,
       CASE WHEN p_partkey % 5 = 1 THEN 'regular' WHEN p_partkey % 2 = 0 THEN 'oficial' ELSE 'privado' END AS school_type,
       CASE WHEN p_partkey % 5 <> 1 THEN CAST(2020 + p_partkey % 4 AS INT) END AS icfes_year
FROM part""")

cte("weather", """
SELECT CASE WHEN user_id % 5 = 1 THEN 'US' ELSE 'CO' END AS country_code,
       concat('NATION_', CAST(user_id % 25 AS VARCHAR)) AS city, CAST(ts AS DATE) AS date,
       max(value) / 8e0 AS temp_max_c, min(value) / 8e0 - 1.6e1 AS temp_min_c,
       max(CASE WHEN event_type = 'view' THEN value / 4e0 END) AS precipitation_mm,
       max(CASE WHEN event_type = 'click' THEN value / 3e0 END) AS wind_speed_max_kmh
FROM events GROUP BY 1, 2, 3""")

cte("fx", """
SELECT CAST(o_orderdate AS DATE) AS date, 'COP' AS from_currency, 'USD' AS to_currency,
       CAST(3500 + (sum(o_orderkey) % 700) AS DOUBLE) AS rate
FROM orders GROUP BY 1""")

cte("crime", """
SELECT concat('NATION_', CAST(l_suppkey % 25 AS VARCHAR)) AS city,
       CASE WHEN l_suppkey % 5 = 1 THEN 'US' ELSE 'CO' END AS country_code,
       CASE l_orderkey % 6 WHEN 0 THEN 'Homicidio' WHEN 1 THEN 'Hurto a personas' WHEN 2 THEN 'Daño en bien ajeno'
            WHEN 3 THEN 'Hurto con violencia' WHEN 4 THEN 'Extorsión' ELSE 'robbery' END AS crime_type,
       CAST(l_quantity AS INT) AS "count", CAST(year(l_shipdate) AS INT) AS period_year, CAST(month(l_shipdate) AS INT) AS period_month
FROM lineitem""")

cte("plans", """
SELECT conv_id, turn, role,
       concat('{"intent":"t', CAST(turn AS VARCHAR), '","reasoning":"because ', CAST(conv_id % 9 AS VARCHAR), '","tool_calls":[{"tool":"get_market_trends","params":{"country_code":"',
              CASE WHEN conv_id % 3 = 0 THEN 'US' ELSE 'CO' END, '","city":"NATION_', CAST(conv_id % 25 AS VARCHAR),
              '"}}', CASE WHEN conv_id % 4 = 0 THEN ',{"tool":"compare_cities","params":{"us_city":"NATION_1","co_city":"NATION_2"}}' ELSE '' END,
              CASE WHEN conv_id % 5 = 2 THEN concat(',{"tool":"search_listings","params":{"country_code":"US","city":"nation_6","min_price_usd":', CAST(conv_id % 13 * 20000 AS VARCHAR),
                ',"max_price_usd":', CAST(conv_id % 13 * 20000 + 150000 AS VARCHAR), ',"limit":', CAST(conv_id % 60 + 1 AS VARCHAR), '}}') ELSE '' END,
              [""" + ", ".join(f"'{x}'" for x in PLAN_EXTRAS) + """][conv_id % """ + str(len(PLAN_EXTRAS)) + """ + 1],
              ']}') AS plan_json
FROM conversations""")

cte("demographics", """
SELECT CASE WHEN n.n_regionkey = 1 THEN 'US' ELSE 'CO' END AS country_code,
       CASE WHEN n.n_regionkey = 1 THEN concat('Z', CAST(c.c_custkey % 7 AS VARCHAR)) ELSE n.n_name END AS zip_or_municipio,
       CAST(2022 + c.c_custkey % 2 AS INT) AS year,
       CAST(count(*) * 1000 AS BIGINT) AS population,
       CAST(floor(avg(c.c_acctbal) * 10) AS BIGINT) AS median_income_usd,
       1e2 * sum(CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) / count(*) AS pct_homeowner
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2, 3""")

# --- silver ------------------------------------------------------------------------------
PROPERTY_CASE = """CASE WHEN lower(property_type) IN ('single_family','single family','sfh') THEN 'single_family'
  WHEN lower(property_type) IN ('condo','condominium','apartment','apartamento') THEN 'apartment'
  WHEN lower(property_type) IN ('townhouse','town home','town-house') THEN 'townhouse'
  WHEN lower(property_type) IN ('casa') THEN 'single_family' ELSE 'apartment' END"""

cte("fx_latest", "SELECT rate AS fx_rate FROM fx WHERE from_currency = 'COP' AND to_currency = 'USD' "
                 "ORDER BY date DESC, rate DESC LIMIT 1", ["fx"])

cte("silver_listings", f"""
SELECT listing_id, source, country_code, city, CASE WHEN country_code = 'CO' THEN departamento END AS state_or_dept, zip_or_municipio,
       barrio_or_neighborhood, lat, lon, CASE WHEN country_code = 'CO' THEN CAST(trunc(CAST(price_cop AS DOUBLE) / nullif(fx_rate, 0)) AS BIGINT) ELSE price_usd END AS price_usd,
       CASE WHEN country_code = 'CO' THEN price_cop ELSE price_usd END AS price_local,
       CASE WHEN country_code = 'CO' THEN 'COP' ELSE 'USD' END AS local_currency,
       CASE WHEN country_code = 'CO' THEN CAST(price_cop AS DOUBLE) / fx_rate / (area_m2 * 10.7639e0)
            WHEN area_sqft > 0 THEN CAST(price_usd AS DOUBLE) / area_sqft END AS price_per_sqft_usd,
       CASE WHEN country_code = 'CO' THEN area_m2 * 10.7639e0 ELSE area_sqft END AS area_sqft, bedrooms, bathrooms, {PROPERTY_CASE} AS property_type,
       CAST(NULL AS VARCHAR) AS listing_url, CAST(NULL AS INT) AS days_on_market,
       CAST(scraped_at AS DATE) AS listing_date, scraped_at
FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY scraped_at DESC, seq DESC) AS rn
      FROM listings_raw) x CROSS JOIN fx_latest
WHERE rn = 1""", ["listings_raw", "fx_latest"])

cte("market_summary", """
SELECT geo_id, country_code, city, zip_or_municipio, date, median_price_usd,
       CASE WHEN lag3 > 0 THEN 1e2 * (median_price_usd - lag3) / lag3 END AS price_trend_3mo_pct,
       CASE WHEN lag12 > 0 THEN 1e2 * (median_price_usd - lag12) / lag12 END AS price_trend_12mo_pct,
       median_days_on_market, inventory_count, months_of_supply,
       CASE WHEN months_of_supply < 2 THEN 'hot' WHEN months_of_supply < 4 THEN 'warm'
            WHEN months_of_supply < 6 THEN 'cool' WHEN months_of_supply IS NOT NULL THEN 'cold' END AS market_temp
FROM (SELECT concat_ws('_', country_code, city, zip_or_municipio) AS geo_id, country_code, city, zip_or_municipio,
             date, median_price_usd, median_days_on_market, inventory_count, homes_sold,
             lag(median_price_usd, 3) OVER w AS lag3, lag(median_price_usd, 12) OVER w AS lag12,
             CASE WHEN homes_sold IS NOT NULL AND homes_sold > 0 AND inventory_count IS NOT NULL
                  THEN CAST(inventory_count AS DOUBLE) / CAST(homes_sold AS DOUBLE) END AS months_of_supply
      FROM (SELECT country_code, city, zip_or_municipio, date, homes_sold, median_days_on_market,
                   CASE WHEN country_code = 'US' THEN inventory_count END AS inventory_count,
                   CASE WHEN country_code = 'US' THEN coalesce(median_sale_price_usd, median_list_price_usd)
                        ELSE CAST(trunc(CAST(new_construction_price_cop AS DOUBLE) / nullif(fx_rate, 0)) AS BIGINT) END AS median_price_usd
            FROM market_raw CROSS JOIN fx_latest) m WHERE median_price_usd IS NOT NULL
      WINDOW w AS (PARTITION BY country_code, city, zip_or_municipio ORDER BY date)) s""", ["market_raw", "fx_latest"])

HAZ = ["flood", "earthquake", "wildfire", "tornado", "landslide"]
_piv = ",\n".join(f"coalesce(max(CASE WHEN hazard_type = '{h}' THEN risk_score * 1e2 END), 0e0) AS {h}_risk_score" for h in HAZ)
cte("risk", f"""
SELECT geo_id, country_code, city, zip_or_municipio, flood_risk_score, earthquake_risk_score, wildfire_risk_score,
       tornado_risk_score, landslide_risk_score, composite_hazard_score,
       CASE WHEN composite_hazard_score < 25 THEN 'low' WHEN composite_hazard_score < 50 THEN 'medium'
            WHEN composite_hazard_score < 75 THEN 'high' ELSE 'very_high' END AS risk_label,
       CAST({UPDATED_AT} AS TIMESTAMP) AS profile_updated_at
FROM (SELECT *, flood_risk_score * 0.3e0 + earthquake_risk_score * 0.3e0 + wildfire_risk_score * 0.2e0
                + tornado_risk_score * 0.1e0 + landslide_risk_score * 0.1e0 AS composite_hazard_score
      FROM (SELECT CASE WHEN country_code = 'US' THEN coalesce(zip_or_zone, county_or_municipio)
                        ELSE coalesce(county_or_municipio, zip_or_zone) END AS geo_id,
                   country_code, county_or_municipio AS city,
                   CASE WHEN country_code = 'US' THEN zip_or_zone ELSE county_or_municipio END AS zip_or_municipio,
                   {_piv}
            FROM hazards GROUP BY country_code, state_or_dept, county_or_municipio, zip_or_zone) p) q""", ["hazards"])

cte("risk_area", """
SELECT country_code, zip_or_municipio, avg(composite_hazard_score) AS composite_hazard_score,
       CASE WHEN avg(composite_hazard_score) < 25 THEN 'low' WHEN avg(composite_hazard_score) < 50 THEN 'medium'
            WHEN avg(composite_hazard_score) < 75 THEN 'high' ELSE 'very_high' END AS risk_label
FROM risk GROUP BY 1, 2""", ["risk"])

cte("units", """
SELECT *, concat_ws('_', country_code, city, coalesce(zip_or_municipio, 'UNK'), coalesce(barrio, 'ALL')) AS profile_id
FROM (SELECT country_code, city, zip_or_municipio, CAST(NULL AS VARCHAR) AS barrio,
             avg(lat) AS lat_centroid, avg(lon) AS lon_centroid
      FROM silver_listings WHERE country_code = 'US' GROUP BY 1, 2, 3
      UNION ALL
      SELECT country_code, city, zip_or_municipio, barrio_or_neighborhood AS barrio,
             avg(lat) AS lat_centroid, avg(lon) AS lon_centroid
      FROM silver_listings WHERE country_code = 'CO' GROUP BY 1, 2, 3, 4) u""", ["silver_listings"])

cte("crime_latest", """
SELECT country_code, city, arg_max(n, period_year) AS crime_rate_per_100k,
       CASE WHEN regr_slope(n, period_year) > 0 THEN 'rising' WHEN regr_slope(n, period_year) < 0 THEN 'falling'
            ELSE 'stable' END AS crime_trend
FROM (SELECT country_code, city, period_year,
             CAST(CASE WHEN country_code = 'US' THEN count(*) ELSE sum("count") END AS DOUBLE) AS n
      FROM crime GROUP BY 1, 2, 3) y
GROUP BY 1, 2""", ["crime"])

cte("school_stats", """
SELECT country_code, city, count(*) AS school_count,
       avg(CASE WHEN country_code = 'US' THEN (coalesce(math_pct, 0e0) + coalesce(reading_pct, 0e0)) / 2e0 ELSE icfes_percentile END) AS school_score_normalized
FROM schools GROUP BY 1, 2""", ["schools"])

cte("amenity_counts", """
SELECT country_code, city,
       count(*) FILTER (WHERE amenity_type = 'grocery') AS grocery_count,
       count(*) FILTER (WHERE amenity_type = 'park') AS park_count,
       count(*) FILTER (WHERE amenity_type = 'hospital') AS hospital_count,
       count(*) FILTER (WHERE amenity_type = 'transit_stop') AS transit_stop_count
FROM amenities GROUP BY 1, 2""", ["amenities"])

cte("demo_latest", """
SELECT country_code, zip_or_municipio, arg_max(population, year) AS population,
       arg_max(median_income_usd, year) AS median_income_usd, arg_max(pct_homeowner, year) AS pct_homeowner
FROM demographics GROUP BY 1, 2""", ["demographics"])

EXTREME = ("(coalesce(precipitation_mm > 50, false) OR coalesce(wind_speed_max_kmh > 80, false) "
           "OR coalesce(temp_max_c > 38, false) OR coalesce(temp_min_c < -15, false))")
cte("weather_ext", f"""
SELECT country_code, city, avg(d) AS weather_extreme_days_per_yr
FROM (SELECT country_code, city, year(date) AS y, sum(CASE WHEN {EXTREME} THEN 1 ELSE 0 END) AS d
      FROM weather GROUP BY 1, 2, 3) w GROUP BY 1, 2""", ["weather"])

cte("profile_base", """
SELECT u.profile_id, u.country_code, u.city, u.zip_or_municipio, u.barrio, u.lat_centroid, u.lon_centroid,
       c.crime_rate_per_100k, c.crime_trend, coalesce(s.school_count, 0) AS school_count, s.school_score_normalized,
       coalesce(a.grocery_count, 0) AS grocery_count, coalesce(a.park_count, 0) AS park_count,
       coalesce(a.hospital_count, 0) AS hospital_count, coalesce(a.transit_stop_count, 0) AS transit_stop_count,
       d.population, d.median_income_usd, d.pct_homeowner, w.weather_extreme_days_per_yr,
       r.composite_hazard_score AS hazard_composite_score
FROM units u
LEFT JOIN crime_latest c ON u.country_code = c.country_code AND u.city = c.city
LEFT JOIN school_stats s ON u.country_code = s.country_code AND u.city = s.city
LEFT JOIN amenity_counts a ON u.country_code = a.country_code AND u.city = a.city
LEFT JOIN demo_latest d ON u.country_code = d.country_code AND u.zip_or_municipio = d.zip_or_municipio
LEFT JOIN weather_ext w ON u.country_code = w.country_code AND u.city = w.city
LEFT JOIN risk_area r ON u.country_code = r.country_code AND u.zip_or_municipio = r.zip_or_municipio""",
    ["units", "crime_latest", "school_stats", "amenity_counts", "demo_latest", "weather_ext", "risk_area"])

cte("profile", f"""
SELECT profile_id, country_code, city, zip_or_municipio, barrio, lat_centroid, lon_centroid, crime_rate_per_100k,
       crime_trend, school_count, school_score_normalized, grocery_count, park_count, hospital_count,
       transit_stop_count, population, median_income_usd, pct_homeowner,
       (CAST(aw AS DOUBLE) - coalesce(CAST(lo_a AS DOUBLE), 0e0)) / greatest(coalesce(CAST(hi_a AS DOUBLE), 0e0) - coalesce(CAST(lo_a AS DOUBLE), 0e0), 1e0) * 1e2 AS amenity_density_score,
       (CAST(transit_stop_count AS DOUBLE) - coalesce(CAST(lo_t AS DOUBLE), 0e0)) / greatest(coalesce(CAST(hi_t AS DOUBLE), 0e0) - coalesce(CAST(lo_t AS DOUBLE), 0e0), 1e0) * 1e2 AS transit_access_score,
       weather_extreme_days_per_yr, hazard_composite_score,
       CAST({UPDATED_AT} AS TIMESTAMP) AS profile_updated_at
FROM (SELECT *, grocery_count * 3 + transit_stop_count * 3 + park_count * 2 + hospital_count * 1 AS aw FROM profile_base) b
CROSS JOIN (SELECT min(grocery_count * 3 + transit_stop_count * 3 + park_count * 2 + hospital_count * 1) AS lo_a,
                   max(grocery_count * 3 + transit_stop_count * 3 + park_count * 2 + hospital_count * 1) AS hi_a,
                   min(transit_stop_count) AS lo_t, max(transit_stop_count) AS hi_t FROM profile_base) st""",
    ["profile_base"])

# --- gold --------------------------------------------------------------------------------
cte("scorecard", """
SELECT p.*,
       percent_rank() OVER (PARTITION BY country_code ORDER BY composite_score ASC NULLS LAST) * 1e2 AS country_percentile_rank,
       percent_rank() OVER (ORDER BY composite_score ASC NULLS LAST) * 1e2 AS global_percentile_rank
FROM (SELECT p.*,
             coalesce(1e2 - coalesce((crime_rate_per_100k - coalesce(lo, 0e0)) / greatest(coalesce(hi, 0e0) - coalesce(lo, 0e0), 1e0) * 1e2, 5e1), 5e1) * 0.3e0
           + coalesce(school_score_normalized, 5e1) * 0.25e0
           + coalesce(amenity_density_score, 5e1) * 0.2e0
           + coalesce(1e2 - coalesce(hazard_composite_score, 0e0), 5e1) * 0.15e0
           + coalesce(transit_access_score, 5e1) * 0.1e0 AS composite_score
      FROM profile p CROSS JOIN (SELECT CAST(min(crime_rate_per_100k) AS DOUBLE) AS lo,
                                        CAST(max(crime_rate_per_100k) AS DOUBLE) AS hi FROM profile) st) p""",
    ["profile"])

cte("score_area", """
SELECT country_code, zip_or_municipio, avg(composite_score) AS composite_score,
       avg(crime_rate_per_100k) AS crime_rate_per_100k, avg(school_score_normalized) AS school_score_normalized
FROM scorecard GROUP BY 1, 2""", ["scorecard"])

cte("market_latest_area", """
SELECT m.* FROM market_summary m
JOIN (SELECT country_code, city, zip_or_municipio, max(date) AS mx FROM market_summary GROUP BY 1, 2, 3) x
  ON m.country_code = x.country_code AND m.city = x.city AND m.zip_or_municipio = x.zip_or_municipio AND m.date = x.mx""",
    ["market_summary"])

cte("value_opportunities", """
SELECT l.*, m.median_price_usd AS area_median_price_usd,
       (m.median_price_usd - l.price_usd) / m.median_price_usd * 1e2 AS discount_pct,
       s.composite_score AS neighborhood_composite_score, r.risk_label AS hazard_risk_label
FROM silver_listings l
JOIN market_latest_area m ON l.country_code = m.country_code AND l.city = m.city AND l.zip_or_municipio = m.zip_or_municipio
LEFT JOIN score_area s ON l.country_code = s.country_code AND l.zip_or_municipio = s.zip_or_municipio
LEFT JOIN risk_area r ON l.country_code = r.country_code AND l.zip_or_municipio = r.zip_or_municipio
WHERE l.price_usd IS NOT NULL AND l.price_usd < m.median_price_usd * 0.85e0
  AND (l.area_sqft > 500 OR l.area_sqft IS NULL) AND coalesce(l.bedrooms, 0) >= 1""",
    ["silver_listings", "market_latest_area", "score_area", "risk_area"])

_NORM = [("crime_rate_per_100k", "norm_crime_score", True), ("school_score_normalized", "norm_school_score", False),
         ("hazard_composite_score", "norm_hazard_score", True), ("weather_extreme_days_per_yr", "norm_weather_score", True),
         ("amenity_density_score", "norm_amenity_score", False), ("median_income_usd", "norm_economic_score", False)]


def _scaled(c, i, inv):
    e = (f"(CAST({c} AS DOUBLE) - coalesce(lo{i}, 0e0)) / greatest(coalesce(hi{i}, 0e0) - coalesce(lo{i}, 0e0), 1e0) * 1e2")
    return f"1e2 - {e}" if inv else e


cte("comparison_index", f"""
SELECT profile_id AS geo_id, country_code, city, zip_or_municipio, CAST(NULL AS DOUBLE) AS norm_price_usd,
       {_scaled('crime_rate_per_100k', 0, True)} AS norm_crime_score,
       {_scaled('school_score_normalized', 1, False)} AS norm_school_score,
       {_scaled('hazard_composite_score', 2, True)} AS norm_hazard_score,
       {_scaled('weather_extreme_days_per_yr', 3, True)} AS norm_weather_score,
       CAST(NULL AS DOUBLE) AS norm_affordability_score,
       {_scaled('amenity_density_score', 4, False)} AS norm_amenity_score,
       {_scaled('median_income_usd', 5, False)} AS norm_economic_score
FROM scorecard CROSS JOIN (SELECT {', '.join(f'CAST(min({c}) AS DOUBLE) AS lo{i}, CAST(max({c}) AS DOUBLE) AS hi{i}' for i, (c, _, _) in enumerate(_NORM))} FROM scorecard) st""",
    ["scorecard"])

cte("city_metrics", """
SELECT * FROM
 (SELECT country_code, city, avg(crime_rate_per_100k) AS crime_per_100k, avg(composite_score) AS composite_score,
         avg(hazard_composite_score) AS hazard_score, avg(amenity_density_score) AS amenity_density_score,
         avg(weather_extreme_days_per_yr) AS weather_extreme_days FROM scorecard GROUP BY 1, 2) sc
 FULL OUTER JOIN (SELECT country_code, city, avg(norm_school_score) AS norm_school FROM comparison_index GROUP BY 1, 2) ix
   USING (country_code, city)
 FULL OUTER JOIN (SELECT m.country_code, m.city, median(m.median_price_usd) AS median_price_usd
                  FROM market_summary m
                  JOIN (SELECT country_code, city, max(date) AS mx FROM market_summary GROUP BY 1, 2) x
                    ON m.country_code = x.country_code AND m.city = x.city AND m.date = x.mx
                  GROUP BY 1, 2) mp
   USING (country_code, city)
 LEFT JOIN (SELECT e.country_code, e.city, avg(e.unemployment_rate) AS unemployment_rate FROM economic e
            JOIN (SELECT country_code, city, max(date) AS mx FROM economic GROUP BY 1, 2) x
              ON e.country_code = x.country_code AND e.city = x.city AND e.date = x.mx GROUP BY 1, 2) un
   USING (country_code, city)""", ["scorecard", "comparison_index", "market_summary", "economic"])

PAIRS_SQL = ("(VALUES ('NATION_1','NATION_0'),('NATION_6','NATION_0'),('NATION_11','NATION_0'),('NATION_16','NATION_0'),"
             "('NATION_21','NATION_0'),('NATION_1','NATION_2'),('NATION_6','NATION_2'),('NATION_11','NATION_3'),"
             "('NATION_16','NATION_4'),('NATION_21','NATION_5'),('NATION_1','NATION_7')) AS p(us_city, co_city)")
_CMP = [("crime_per_100k", "crime_per_100k"), ("norm_school", "school_score"), ("composite_score", "composite_score"),
        ("hazard_score", "hazard_score"), ("unemployment_rate", "unemployment_rate"),
        ("weather_extreme_days", "weather_extreme_days"), ("amenity_density_score", "amenity_density_score")]
cte("city_comparison", f"""
SELECT concat_ws('_', p.us_city, p.co_city, '2024-01-01') AS comparison_id, p.us_city, p.co_city,
       DATE '2024-01-01' AS comparison_date,
       CAST(trunc(CASE WHEN u.median_price_usd <> 0 THEN u.median_price_usd END) AS BIGINT) AS us_median_price_usd,
       CAST(trunc(CASE WHEN c.median_price_usd <> 0 THEN c.median_price_usd END) AS BIGINT) AS co_median_price_usd,
       CASE WHEN u.median_price_usd <> 0 AND c.median_price_usd <> 0 THEN c.median_price_usd / u.median_price_usd END AS price_ratio,
       {', '.join(f'u.{s} AS us_{n}, c.{s} AS co_{n}' for s, n in _CMP)}
FROM {PAIRS_SQL}
LEFT JOIN (SELECT * FROM city_metrics WHERE country_code = 'US') u ON p.us_city = u.city
LEFT JOIN (SELECT * FROM city_metrics WHERE country_code = 'CO') c ON p.co_city = c.city""",
    ["city_metrics"])

cte("listing_map", """
SELECT l.*, n.composite_score, n.crime_rate_per_100k, n.school_score_normalized, r.risk_label, m.market_temp,
       m.median_price_usd AS area_median_price_usd
FROM silver_listings l
LEFT JOIN score_area n ON l.country_code = n.country_code AND l.zip_or_municipio = n.zip_or_municipio
LEFT JOIN risk_area r ON l.country_code = r.country_code AND l.zip_or_municipio = r.zip_or_municipio
LEFT JOIN (SELECT ms.* FROM market_summary ms
           JOIN (SELECT country_code, city, max(date) AS mx FROM market_summary GROUP BY 1, 2) x
             ON ms.country_code = x.country_code AND ms.city = x.city AND ms.date = x.mx) m
  ON l.country_code = m.country_code AND l.city = m.city AND l.zip_or_municipio = m.zip_or_municipio""",
    ["silver_listings", "score_area", "risk_area", "market_summary"])

cte("city_summary", """
SELECT s.*, lm.latest_median_price_usd FROM
 (SELECT country_code, city, count(*) AS neighborhood_count, avg(composite_score) AS avg_composite_score,
         avg(crime_rate_per_100k) AS avg_crime_per_100k, avg(school_score_normalized) AS avg_school_score,
         avg(amenity_density_score) AS avg_amenity_density, avg(transit_access_score) AS avg_transit_access,
         avg(hazard_composite_score) AS avg_hazard_score, avg(weather_extreme_days_per_yr) AS avg_weather_extreme_days
  FROM scorecard GROUP BY 1, 2) s
LEFT JOIN (SELECT m.country_code, m.city, avg(m.median_price_usd) AS latest_median_price_usd
           FROM market_summary m JOIN (SELECT country_code, city, max(date) AS mx FROM market_summary GROUP BY 1, 2) x
             ON m.country_code = x.country_code AND m.city = x.city AND m.date = x.mx GROUP BY 1, 2) lm
  ON s.country_code = lm.country_code AND s.city = lm.city""", ["scorecard", "market_summary"])

cte("school_rankings", """
SELECT school_id, country_code, city, state_or_dept, zip_or_municipio, lat, lon, school_name, grade_levels, enrollment, school_type,
       CASE WHEN s < 0 THEN 0e0 WHEN s > 100 THEN 1e2 ELSE s END AS school_score_normalized,
       CASE WHEN country_code <> 'US' THEN icfes_year END AS score_year
FROM (SELECT *, CASE WHEN country_code <> 'US' THEN icfes_percentile WHEN math_pct IS NOT NULL OR reading_pct IS NOT NULL
                     THEN (coalesce(math_pct, 0e0) + coalesce(reading_pct, 0e0)) / 2e0 END AS s FROM schools) x""",
    ["schools"])

cte("economic", """
SELECT CASE WHEN n.n_regionkey = 1 THEN 'US' ELSE 'CO' END AS country_code, n.n_name AS city,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date,
       1e2 * sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*) / 1e1 AS unemployment_rate,
       CASE WHEN count(*) > 2 THEN avg(o.o_totalprice) / 1e5 END AS mortgage_rate_30yr
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2, 3""")


cte("plan_calls", """
SELECT conv_id, turn, CAST(i AS INT) AS call_index, json_extract_string(plan_json, '$.tool_calls[' || i || '].tool') AS tool,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.country_code') AS country_code,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.city') AS city,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.us_city') AS us_city,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.co_city') AS co_city,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.months_back') AS months_back,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.limit') AS lim,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.bedrooms_min') AS bedrooms_min,
       json_extract_string(plan_json, '$.tool_calls[' || i || '].params.min_price_usd') AS min_price_usd
FROM plans, range(CAST(json_array_length(plan_json, '$.tool_calls') AS BIGINT)) AS t(i)""", ["plans"])

cte("plan_cities", """
SELECT conv_id, turn, string_agg(DISTINCT v, ',' ORDER BY v) AS cities_mentioned
FROM (SELECT conv_id, turn, unnest([city, us_city, co_city]) AS v FROM plan_calls) x WHERE v IS NOT NULL GROUP BY 1, 2""",
    ["plan_calls"])

cte("plan_countries", """
SELECT conv_id, turn, CASE WHEN count(DISTINCT k) FILTER (WHERE k IN ('US', 'CO')) >= 2 THEN 'BOTH'
                           WHEN count(DISTINCT k) FILTER (WHERE k IN ('US', 'CO')) = 1 THEN min(k) FILTER (WHERE k IN ('US', 'CO'))
                           ELSE 'UNKNOWN' END AS country_filter
FROM (SELECT conv_id, turn, unnest([country_code, CASE WHEN us_city IS NOT NULL THEN 'US' END,
                                    CASE WHEN co_city IS NOT NULL THEN 'CO' END]) AS k FROM plan_calls) x
GROUP BY 1, 2""", ["plan_calls"])

cte("results", f"""
SELECT conv_id, turn, call_order, ['search_listings', 'get_market_trends', 'compare_cities', 'get_hazard_risks', 'get_school_rankings'][k + 1] AS tool,
       CASE WHEN k = 0 THEN concat('[', array_to_string([concat('{{"listing_id":"L', s, '","price_usd":', s * 1000 + j, ',"city":"X"}}') for j in range(1, s % 4 + 1)], ','), ']')
            WHEN k = 1 AND s % 5 = 0 THEN concat('{{"message":"No market data for CO/NATION_', s % 25, '"}}')
            WHEN k = 1 THEN concat('{{"city":"NATION_', s % 25, '","latest_median_price_usd":', s * 100, ',"market_temp":"hot","note":"{'n' * 70}","monthly_series":[{{"m":1}}],"flag":true,"zip":null}}')
            WHEN k = 2 THEN concat('{{"us_city":"NATION_1","co_city":"NATION_2","aggregate":true,"us_metrics":{{"a":1}},"price_ratio":', s, '}}')
            WHEN k = 3 AND s % 7 = 0 THEN '{{"error":"ValueError: bad"}}'
            WHEN k = 3 THEN concat('{{"composite_hazard_score":', s, ',"risk_label":null}}')
            ELSE concat('[{{"school_id":"1","school_score_normalized":', s, '}}]') END AS result_json
FROM (SELECT conv_id, turn, CAST(i AS INT) AS call_order, (conv_id + turn + i * i) % 5 AS k, conv_id * 10 + turn + i AS s
      FROM conversations, range(conv_id % 3 + 2) AS t(i)) x""")

cte("evidence", """
SELECT conv_id, turn, call_order, tool,
       CASE WHEN is_list THEN n_rows WHEN 'message' IN ks THEN 0 ELSE 1 END AS records,
       CASE WHEN is_list THEN n_rows = 0 ELSE 'message' IN ks OR 'error' IN ks END AS sparse,
       concat('{', array_to_string(list_concat(CASE WHEN is_list THEN [concat('"count":', n_rows)] ELSE [] END,
         [concat('"', CASE WHEN is_list THEN 'first_' ELSE '' END, k, '":', CAST(json_extract(o, concat('$.', k)) AS VARCHAR)) for k in list_sort(ks)
          if json_type(o, concat('$.', k)) IN ('UBIGINT', 'BIGINT', 'DOUBLE')
             or (not is_list and json_type(o, concat('$.', k)) = 'VARCHAR' and length(json_extract_string(o, concat('$.', k))) < 64)]), ','), '}') AS facts,
       CASE WHEN is_list THEN concat('- ', tool, ': ', n_rows, ' rows')
            WHEN 'message' IN ks THEN concat('- ', tool, ': ', json_extract_string(o, '$.message'))
            ELSE concat('- ', tool, ': ', len(ks), ' fields') END AS line
FROM (SELECT *, coalesce(json_keys(o), []) AS ks FROM
       (SELECT conv_id, turn, call_order, starts_with(result_json, '[') AS is_list,
               CASE WHEN row_number() OVER (PARTITION BY conv_id, turn, tool ORDER BY call_order) = 1 THEN tool ELSE concat(tool, '_', call_order) END AS tool,
               CAST(CASE WHEN starts_with(result_json, '[') THEN json_array_length(result_json) ELSE 0 END AS INT) AS n_rows,
               CASE WHEN starts_with(result_json, '[') THEN json_extract(result_json, '$[0]') ELSE CAST(result_json AS JSON) END AS o
        FROM results) x) y""", ["results"])

cte("session_summary", """
SELECT conv_id, turn, CAST(sum(records) AS INT) AS evidence_record_count,
       string_agg(tool, ',' ORDER BY call_order) AS tool_names_used,
       concat('{', string_agg(concat('"', tool, '":', facts), ',' ORDER BY call_order), '}') AS structured_results_json,
       string_agg(line, chr(10) ORDER BY call_order) AS evidence_summary,
       bool_or(sparse) AS any_sparse
FROM evidence GROUP BY 1, 2""", ["evidence"])

cte("sessions", """
SELECT concat_ws('_', CAST(u.conv_id AS VARCHAR), CAST(u.turn AS VARCHAR)) AS session_id,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(u.conv_id AS BIGINT)) + to_seconds(CAST(u.turn AS DOUBLE)) AS timestamp,
       u.text AS user_question, coalesce(json_extract_string(p.plan_json, '$.intent'), 'unknown') AS intent,
       coalesce(json_extract_string(p.plan_json, '$.reasoning'), '') AS planner_reasoning, p.plan_json,
       coalesce(CASE WHEN u.next_role = 'assistant' THEN u.next_text END, '') AS answer_text,
       coalesce(s.structured_results_json, '{}') AS structured_results_json,
       coalesce(k.country_filter, 'UNKNOWN') AS country_filter, coalesce(c.cities_mentioned, '') AS cities_mentioned,
       coalesce(s.tool_names_used, '') AS tool_names_used, coalesce(s.evidence_record_count, 0) AS evidence_record_count,
       coalesce(s.any_sparse, false) AS refinement_applied, CAST(least(u.turn, 3) AS INT) AS context_turns_used,
       CAST(NULL AS DOUBLE) AS latency_seconds
FROM (SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations) u
LEFT JOIN plans p ON u.conv_id = p.conv_id AND u.turn = p.turn
LEFT JOIN plan_cities c ON u.conv_id = c.conv_id AND u.turn = c.turn
LEFT JOIN plan_countries k ON u.conv_id = k.conv_id AND u.turn = k.turn
LEFT JOIN session_summary s ON u.conv_id = s.conv_id AND u.turn = s.turn
WHERE u.role = 'user'""", ["plans", "plan_cities", "plan_countries", "session_summary"])


# --- t14: the answers of all tools -------------------------------------------------------
def _d(column: str, name: str | None = None) -> str:
    return f"'{name or column}': CAST({column} AS DECIMAL(24,6))"


_TOOL_PARAMS = {"cc": "country_code", "city": "city", "zip": "zip_or_municipio", "usc": "us_city", "coc": "co_city", "types": "amenity_types", "ptype": "property_type",
                "lim": "limit", "months": "months_back", "years": "years_back", "minp": "min_price_usd", "maxp": "max_price_usd", "beds": "bedrooms_min",
                "baths": "bathrooms_min", "income": "annual_income_usd", "down": "down_payment_usd"}
_SUPPORTED = "('NATION_0', 'NATION_2', 'NATION_7', 'NATION_12')"
cte("calls_ok", f"""
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) - 1 AS INT) AS call_order, tool, pj, {', '.join(_TOOL_PARAMS)}
FROM (SELECT conv_id, turn, i, json_extract_string(plan_json, '$.tool_calls[' || i || '].tool') AS tool,
             CAST(json_extract(plan_json, '$.tool_calls[' || i || '].params') AS VARCHAR) AS pj,
             {', '.join(f"json_extract_string(plan_json, '$.tool_calls[' || i || '].params.{v}') AS {k}" for k, v in _TOOL_PARAMS.items())}
      FROM plans, range(CAST(json_array_length(plan_json, '$.tool_calls') AS BIGINT)) AS t(i)) x
WHERE tool <> 'launch_rocket' AND coalesce(cc IN ('US', 'CO'), true) AND NOT coalesce(cc = 'CO' AND city NOT IN {_SUPPORTED}, false)
  AND coalesce(coc IN {_SUPPORTED}, true) AND (lim IS NULL OR TRY_CAST(lim AS DOUBLE) IS NOT NULL)
  AND (minp IS NULL OR TRY_CAST(minp AS DOUBLE) >= 0)""", ["plans"])

_PROFILE = ["composite_score", "crime_rate_per_100k", "school_score_normalized", "amenity_density_score", "transit_access_score", "hazard_composite_score"]
_RISKS = ["flood_risk_score", "earthquake_risk_score", "wildfire_risk_score", "tornado_risk_score", "landslide_risk_score", "composite_hazard_score"]
_ACCESS = ["amenity_density_score", "transit_access_score", "grocery_count", "park_count", "hospital_count", "transit_stop_count"]
_DIMS = ["norm_crime_score", "norm_school_score", "norm_hazard_score", "norm_weather_score", "norm_amenity_score", "norm_economic_score"]
_INCIDENT = """CASE WHEN lower(trim(crime_type)) IN ('assault','robbery','shooting','homicide') THEN 'violent' WHEN lower(trim(crime_type)) IN ('burglary','theft','vandalism','arson') THEN 'property' ELSE 'other' END"""
_SPANISH = """CASE WHEN raw = '' THEN 'other'
       WHEN raw LIKE '%homicid%' OR raw LIKE '%lesion%' OR raw LIKE '%secuestr%' OR raw LIKE '%violenc%' OR raw LIKE '%violacion%'
         OR raw LIKE '%feminicid%' OR raw LIKE '%delitos sexuales%' OR raw LIKE '%sexual%' THEN 'violent'
       WHEN raw LIKE '%hurto%' AND (raw LIKE '%violen%') THEN 'violent'
       WHEN raw LIKE '%hurto%' OR raw LIKE '%robo%' OR raw LIKE '%dano%' OR raw LIKE '%abigeato%' OR raw LIKE '%piracy%' OR raw LIKE '%pirateria%' THEN 'property'
       ELSE 'other' END"""


def _listed(tool: str, fields: str, source: str, order: str, where: str) -> str:
    """A JSON list of at most the limit of a request's rows."""
    return f"""SELECT r.pj, r.tool, coalesce('[' || string_agg(j, ',' ORDER BY rk) || ']', '[]') AS result_json FROM reqs r
LEFT JOIN (SELECT q.pj, CAST(to_json({{{fields}}}) AS VARCHAR) AS j, row_number() OVER (PARTITION BY q.pj ORDER BY {order}) AS rk
           FROM reqs q JOIN {source} ON {where} WHERE q.tool = '{tool}') a ON a.pj = r.pj AND a.rk <= r.k
WHERE r.tool = '{tool}' GROUP BY 1, 2"""


def _answer(tool: str, hit: str, fields: str, message: str, source: str) -> str:
    return f"""SELECT r.pj, r.tool, CASE WHEN {hit} THEN CAST(to_json({{{fields}}}) AS VARCHAR) ELSE CAST(to_json({{'message': {message}}}) AS VARCHAR) END AS result_json
FROM reqs r {source} WHERE r.tool = '{tool}'"""


def _first_or_mean(tool: str, table: str, order: str, shown: list, metrics: list, has: str, none: str) -> str:
    whole = ", ".join(f"'{c}': f.{c}" for c in shown)
    return f"""SELECT r.pj, r.tool, CASE WHEN f.area IS NOT NULL THEN CAST(to_json({{{whole}, {', '.join(_d('f.' + c, c) for c in metrics)}}}) AS VARCHAR)
  WHEN m.{has} IS NOT NULL THEN CAST(to_json({{{', '.join(_d('m.' + c, c) for c in metrics)}, 'country_code': r.cc, 'city': r.city, 'aggregate': true}}) AS VARCHAR)
  ELSE CAST(to_json({{'message': '{none}' || r.cc || '/' || r.city}}) AS VARCHAR) END AS result_json
FROM reqs r LEFT JOIN (SELECT q.pj, q.area, t.*, row_number() OVER (PARTITION BY q.pj ORDER BY {order}) AS rk FROM reqs q
    JOIN {table} t ON t.country_code = q.cc AND lower(t.city) = q.area AND (q.zip IS NULL OR t.zip_or_municipio = q.zip) WHERE q.tool = '{tool}') f ON f.pj = r.pj AND f.rk = 1
LEFT JOIN (SELECT country_code, lower(city) AS area, {', '.join(f'avg({c}) AS {c}' for c in metrics)} FROM {table} GROUP BY 1, 2) m
  ON m.country_code = r.cc AND m.area = r.area
WHERE r.tool = '{tool}'"""


_HERE = "t.country_code = q.cc AND lower(t.city) = q.area"
_WHO = "'country_code': r.cc, 'city': r.city"
_PLACE = "r.cc || '/' || r.city"
_TOOL_SQL = [
    _listed("search_listings", "'listing_id': t.listing_id, 'city': t.city, 'zip_or_municipio': t.zip_or_municipio, 'price_usd': t.price_usd, 'bedrooms': t.bedrooms, "
            + _d("t.bathrooms", "bathrooms") + ", " + _d("t.area_sqft", "area_sqft") + ", 'property_type': t.property_type, " + _d("t.score", "neighborhood_score")
            + ", 'hazard_risk_label': t.label",
            """(SELECT l.*, s.composite_score AS score, k.risk_label AS label FROM silver_listings l
  LEFT JOIN score_area s ON l.country_code = s.country_code AND l.zip_or_municipio = s.zip_or_municipio
  LEFT JOIN risk_area k ON l.country_code = k.country_code AND l.zip_or_municipio = k.zip_or_municipio) t""", "t.price_usd ASC NULLS LAST, t.listing_id",
            _HERE + " AND (q.minp IS NULL OR t.price_usd >= q.minp) AND (q.maxp IS NULL OR t.price_usd <= q.maxp) AND (q.beds IS NULL OR t.bedrooms >= q.beds) "
            "AND (q.baths IS NULL OR t.bathrooms >= q.baths) AND (q.ptype IS NULL OR t.property_type = q.ptype)"),
    _first_or_mean("get_neighborhood_profile", "scorecard", "t.profile_id", ["profile_id", "zip_or_municipio", "barrio"], _PROFILE, "composite_score", "No profile found for "),
    _first_or_mean("get_hazard_risks", "risk", "t.geo_id, " + ", ".join(f"t.{c}" for c in _RISKS), ["geo_id", "risk_label"], _RISKS, "composite_hazard_score",
                   "No hazard profile for "),
    f"""SELECT r.pj, r.tool, CASE WHEN c.total IS NULL THEN CAST(to_json({{'message': 'No crime data for ' || {_PLACE}}}) AS VARCHAR)
  ELSE concat('{{"country_code":"', r.cc, '","city":"', r.city, '","category_counts":', c.kinds, ',"total_incidents":', c.total, '}}') END AS result_json
FROM reqs r LEFT JOIN (SELECT country_code, area, concat('{{', string_agg(concat('"', kind, '":', n), ',' ORDER BY kind), '}}') AS kinds, CAST(sum(n) AS BIGINT) AS total
    FROM (SELECT country_code, lower(city) AS area, CASE WHEN country_code = 'US' THEN incident ELSE {_SPANISH} END AS kind,
                 CAST(sum(CASE WHEN country_code = 'US' THEN 1 ELSE "count" END) AS BIGINT) AS n
          FROM (SELECT *, translate(lower(trim(crime_type)), 'áéíóúñü', 'aeiounu') AS raw, {_INCIDENT} AS incident FROM crime) x GROUP BY 1, 2, 3) y GROUP BY 1, 2) c
  ON c.country_code = r.cc AND c.area = r.area WHERE r.tool = 'get_crime_stats'""",
    _listed("get_school_rankings", "'school_id': t.school_id, 'city': t.city, " + _d("t.school_score_normalized", "school_score_normalized"), "school_rankings t",
            "t.school_score_normalized DESC NULLS LAST, t.school_id", _HERE + " AND (q.zip IS NULL OR t.zip_or_municipio = q.zip)"),
    _answer("get_weather_summary", "w.a IS NOT NULL", f"{_d('w.a', 'avg_temp_max_c')}, {_d('w.b', 'avg_temp_min_c')}, {_d('w.c', 'avg_precipitation_mm')}, 'total_extreme_days': w.x, "
            f"'years_covered': w.y, 'first_date': CAST(w.f AS VARCHAR), 'last_date': CAST(w.l AS VARCHAR), {_d('w.x / w.y', 'extreme_days_per_year')}, {_WHO}",
            f"'No weather data for ' || {_PLACE}", f"""
LEFT JOIN (SELECT q.pj, avg(temp_max_c) AS a, avg(temp_min_c) AS b, avg(precipitation_mm) AS c, CAST(sum(CASE WHEN {EXTREME} THEN 1 ELSE 0 END) AS BIGINT) AS x,
                  count(DISTINCT year(date)) AS y, min(date) AS f, max(date) AS l
           FROM reqs q JOIN (SELECT *, max(year(date)) OVER (PARTITION BY country_code, lower(city)) AS newest FROM weather) t ON {_HERE}
           WHERE q.tool = 'get_weather_summary' AND (q.years IS NULL OR year(date) >= newest - q.years) GROUP BY 1) w ON w.pj = r.pj"""),
    _answer("get_market_trends", "m.s IS NOT NULL", f"{_WHO}, 'zip_or_municipio': r.zip, 'latest_date': CAST(m.d AS VARCHAR), 'latest_median_price_usd': m.p, "
            f"{_d('m.t3', 'price_trend_3mo_pct')}, {_d('m.t12', 'price_trend_12mo_pct')}, 'median_days_on_market': m.dom, 'market_temp': m.temp, 'monthly_series': m.s",
            f"'No market data for ' || {_PLACE}", f"""
LEFT JOIN (SELECT pj, first(date ORDER BY rk) AS d, first(median_price_usd ORDER BY rk) AS p, first(price_trend_3mo_pct ORDER BY rk) AS t3, first(price_trend_12mo_pct ORDER BY rk) AS t12,
                  first(median_days_on_market ORDER BY rk) AS dom, first(market_temp ORDER BY rk) AS temp,
                  list({{'date': CAST(date AS VARCHAR), 'median_price_usd': median_price_usd, 'inventory_count': inventory_count}} ORDER BY rk DESC) AS s
           FROM (SELECT q.pj, q.months, t.*, row_number() OVER (PARTITION BY q.pj ORDER BY t.date DESC, t.zip_or_municipio DESC) AS rk FROM reqs q
                 JOIN market_summary t ON {_HERE} AND (q.zip IS NULL OR t.zip_or_municipio = q.zip) WHERE q.tool = 'get_market_trends') x WHERE rk <= months GROUP BY 1) m ON m.pj = r.pj"""),
    _answer("get_area_demographics", "g.p IS NOT NULL", f"'population': g.p, {_d('g.i', 'median_income')}, {_d('g.h', 'pct_homeowner')}, "
            f"{_d('CASE WHEN r.cc = ' + chr(39) + 'CO' + chr(39) + ' THEN g.i / (SELECT fx_rate FROM fx_latest) ELSE g.i END', 'median_income_usd')}, {_WHO}",
            f"'No demographics found for ' || {_PLACE}", """
LEFT JOIN (SELECT q.pj, CAST(sum(population) AS BIGINT) AS p, avg(median_income_usd) AS i, avg(pct_homeowner) AS h FROM reqs q JOIN demographics t
    ON t.country_code = q.cc AND (coalesce(q.zip, CASE WHEN q.cc = 'CO' THEN q.city END) IS NULL
                                  OR lower(t.zip_or_municipio) = lower(coalesce(q.zip, q.city))) WHERE q.tool = 'get_area_demographics' GROUP BY 1) g ON g.pj = r.pj"""),
    _listed("get_nearby_amenities", "'amenity_id': t.amenity_id, 'amenity_type': t.amenity_type, 'name': t.name", "amenities t", "t.amenity_type, t.name, t.amenity_id",
            _HERE + " AND (q.types IS NULL OR list_contains(CAST(q.types AS VARCHAR[]), t.amenity_type))"),
    f"""SELECT r.pj, r.tool, CASE WHEN s.us IS NOT NULL THEN CAST(to_json({{'us_city': r.usc, 'co_city': r.coc, 'comparison_date': CAST(s.d AS VARCHAR),
    {_d('s.ratio', 'price_ratio')}, {_d('s.u', 'us_composite_score')}, {_d('s.c', 'co_composite_score')}}}) AS VARCHAR)
  WHEN u.m IS NOT NULL AND c.m IS NOT NULL THEN CAST(to_json({{'us_city': r.usc, 'co_city': r.coc, 'us_metrics': u.m, 'co_metrics': c.m, 'aggregate': true}}) AS VARCHAR)
  ELSE CAST(to_json({{'message': 'Insufficient data to compare ' || r.usc || ' vs ' || r.coc}}) AS VARCHAR) END AS result_json
FROM reqs r LEFT JOIN (SELECT lower(us_city) AS us, lower(co_city) AS co, comparison_date AS d, price_ratio AS ratio, us_composite_score AS u, co_composite_score AS c
    FROM city_comparison) s ON s.us = lower(r.usc) AND s.co = lower(r.coc)
LEFT JOIN (SELECT lower(city) AS area, {{{', '.join(_d(f'median({c})', c) for c in _DIMS)}}} AS m FROM comparison_index WHERE country_code = 'US' GROUP BY 1) u ON u.area = lower(r.usc)
LEFT JOIN (SELECT lower(city) AS area, {{{', '.join(_d(f'median({c})', c) for c in _DIMS)}}} AS m FROM comparison_index WHERE country_code = 'CO' GROUP BY 1) c ON c.area = lower(r.coc)
WHERE r.tool = 'compare_cities'""",
    _answer("get_affordability_analysis", "r.income IS NOT NULL", f"{_WHO}, {_d('r.income', 'annual_income_usd')}, {_d('coalesce(r.down, 0)', 'down_payment_usd')}, "
            f"{_d('p.rate', 'mortgage_rate_pct')}, 'rate_note': p.note, 'max_price_usd': CAST(floor(p.most) AS BIGINT), 'estimated_monthly_payment': CAST(floor(r.income * 0.28e0 / 12e0) AS BIGINT), "
            "'median_price_usd_in_area': CAST(floor(p.med) AS BIGINT), 'can_afford_median': p.most >= p.med", "'annual_income_usd is missing'", """
LEFT JOIN (SELECT pj, rate, note, med, CASE WHEN rate <= 0 THEN pmt * 360 ELSE pmt / (rate / 1200e0) * (1e0 - pow(1e0 + rate / 1200e0, -360e0)) END + down AS most
    FROM (SELECT q.pj, q.income * 0.28e0 / 12e0 AS pmt, coalesce(q.down, 0) AS down, coalesce(e.rate, 7e0) AS rate, CASE WHEN e.rate IS NULL THEN 'default rate' ELSE 'latest rate' END AS note, m.med
          FROM reqs q LEFT JOIN (SELECT country_code, arg_max(mortgage_rate_30yr, (date, city)) AS rate FROM economic WHERE mortgage_rate_30yr IS NOT NULL GROUP BY 1) e ON e.country_code = q.cc
          LEFT JOIN (SELECT country_code, area, median(median_price_usd) AS med FROM (SELECT *, lower(city) AS area, max(date) OVER (PARTITION BY country_code, lower(city)) AS mx FROM market_summary) z
                     WHERE date = mx GROUP BY 1, 2) m ON m.country_code = q.cc AND m.area = q.area WHERE q.tool = 'get_affordability_analysis') y) p ON p.pj = r.pj"""),
    _listed("get_value_opportunities", "'listing_id': t.listing_id, 'price_usd': t.price_usd, " + _d("t.area_median_price_usd", "area_median_price_usd") + ", " + _d("t.discount_pct", "discount_pct"),
            "value_opportunities t", "t.discount_pct DESC NULLS LAST, t.listing_id", _HERE + " AND (q.maxp IS NULL OR t.price_usd <= q.maxp)"),
    _answer("get_amenity_access", "a.avg_amenity_density_score IS NOT NULL", ", ".join(_d(f"a.avg_{c}", f"avg_{c}") for c in _ACCESS) + f", {_WHO}", f"'No amenity data for ' || {_PLACE}", f"""
LEFT JOIN (SELECT country_code, lower(city) AS area, {', '.join(f'avg({c}) AS avg_{c}' for c in _ACCESS)} FROM scorecard GROUP BY 1, 2) a ON a.country_code = r.cc AND a.area = r.area"""),
]


def _bounded(column: str, low: int, high: int, default: str) -> str:
    return (f"CASE WHEN TRY_CAST({column} AS DOUBLE) IS NULL THEN {default} "
            f"ELSE greatest({low}, least({high}, CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS BIGINT))) END")


cte("reqs", f"""
SELECT DISTINCT tool, pj, cc, city, lower(city) AS area, zip, usc, coc, types, ptype, {_bounded('lim', 1, 50, "CASE WHEN tool = 'get_nearby_amenities' THEN 20 ELSE 10 END")} AS k,
       {_bounded('months', 1, 24, '12')} AS months, {_bounded('years', 1, 10, 'NULL')} AS years, {_bounded('beds', 0, 10, 'NULL')} AS beds,
       CASE WHEN TRY_CAST(baths AS DOUBLE) IS NOT NULL THEN greatest(0, least(10, TRY_CAST(baths AS DOUBLE))) END AS baths, TRY_CAST(minp AS DOUBLE) AS minp, TRY_CAST(maxp AS DOUBLE) AS maxp,
       TRY_CAST(income AS DOUBLE) AS income, TRY_CAST(down AS DOUBLE) AS down
FROM calls_ok""", ["calls_ok"])
cte("dispatch", "SELECT c.conv_id, c.turn, c.call_order, c.tool, a.result_json FROM calls_ok c JOIN (" + "\nUNION ALL ".join(f"({x})" for x in _TOOL_SQL)
    + ") a ON a.tool = c.tool AND a.pj = c.pj",
    ["reqs", "silver_listings", "score_area", "risk_area", "scorecard", "risk", "crime", "school_rankings", "weather", "market_summary", "demographics", "fx_latest",
     "amenities", "city_comparison", "comparison_index", "economic", "value_opportunities"])
