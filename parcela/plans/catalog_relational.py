"""Registered projection / filter (p01-p25) and aggregation (a01-a24) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels, numbers, text
from ..operators import dedupe, filters, median, pivot, spatial, upsert
from ..sources import bindings
from ..sources.tables import Tables
from . import silver
from .catalog import O, register


def T(spark, d) -> Tables:
    return Tables.shared(spark, d)


def B(spark, d, name):
    return getattr(bindings, name)(T(spark, d))


# --- projections and filters ---------------------------------------------------------------
@register("p01_project_cast", O.rounded("""
SELECT concat_ws('_', 'us', CAST(o_orderkey AS VARCHAR)) AS listing_id, 'US' AS country_code,
       CAST(round(o_totalprice) AS BIGINT) AS price_usd_rounded, CAST(trunc(o_totalprice) AS BIGINT) AS price_usd,
       CAST(o_orderdate AS DATE) AS listing_date, CAST(o_custkey AS VARCHAR) AS zip, o_totalprice * 1e0 AS price_double
FROM orders""", ["price_double"]))
def p01(spark, d):
    o = T(spark, d).orders
    return o.select(F.concat_ws("_", F.lit("us"), F.col("o_orderkey").cast("string")).alias("listing_id"),
                    F.lit("US").alias("country_code"),
                    F.round("o_totalprice").cast("bigint").alias("price_usd_rounded"),
                    F.col("o_totalprice").cast("bigint").alias("price_usd"),
                    F.col("o_orderdate").cast("date").alias("listing_date"),
                    F.col("o_custkey").cast("string").alias("zip"),
                    F.col("o_totalprice").cast("double").alias("price_double"))


@register("p02_typed_nulls", """
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS barrio, CAST(NULL AS INT) AS days_on_market, CAST(NULL AS DATE) AS listing_date,
       CAST(NULL AS DOUBLE) AS norm_price_usd FROM orders""")
def p02(spark, d):
    o = T(spark, d).orders
    return o.select("o_orderkey", F.lit(None).cast("string").alias("barrio"), F.lit(None).cast("int").alias("days_on_market"),
                    F.lit(None).cast("date").alias("listing_date"), F.lit(None).cast("double").alias("norm_price_usd"))


@register("p03_rename_drop", """
SELECT c_custkey AS customer_id, c_nationkey AS nation, c_acctbal FROM customer""")
def p03(spark, d):
    c = T(spark, d).customer
    return c.withColumnRenamed("c_custkey", "customer_id").withColumnRenamed("c_nationkey", "nation") \
            .drop("c_name", "c_mktsegment")


@register("p04_optional_conjunction", O.sql("""
SELECT listing_id, seq, price_usd, bedrooms, bathrooms, property_type FROM listings_raw
WHERE price_usd >= 100000 AND price_usd <= 300000 AND bedrooms >= 2 AND bathrooms >= 1.5""", "listings_raw"))
def p04(spark, d):
    r = B(spark, d, "listings")
    cond = filters.optional_conjunction({"min_price": ("price_usd >=", 100000), "max_price": ("price_usd <=", 300000),
                                         "beds": ("bedrooms >=", 2), "baths": ("bathrooms >=", 1.5),
                                         "type": ("property_type ==", None)})
    return r.filter(cond).select("listing_id", "seq", "price_usd", "bedrooms", "bathrooms", "property_type")


@register("p05_ci_equality", O.sql("""
SELECT listing_id, seq, city FROM listings_raw WHERE lower(city) = 'nation_1'""", "listings_raw"))
def p05(spark, d):
    r = B(spark, d, "listings")
    return r.filter(filters.ci_equals("city", "Nation_1")).select("listing_id", "seq", "city")


@register("p06_in_list", O.sql("""
SELECT amenity_id, amenity_type FROM amenities WHERE amenity_type IN ('grocery', 'park')""", "amenities"))
def p06(spark, d):
    a = B(spark, d, "amenities")
    return a.filter(F.col("amenity_type").isin(["grocery", "park"])).select("amenity_id", "amenity_type")


@register("p07_blank_filter", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> '' AND length(trim(c_mktsegment)) = 9""")
def p07(spark, d):
    c = T(spark, d).customer
    return c.filter(filters.not_blank("c_mktsegment", 9)).select("c_custkey", "c_mktsegment")


@register("p08_ilike_prefix", O.sql("""
SELECT count(*) AS n FROM amenities WHERE city ILIKE 'nation_1%'""", "amenities"))
def p08(spark, d):
    a = B(spark, d, "amenities")
    return a.filter(F.col("city").ilike("nation_1%")).agg(F.count(F.lit(1)).alias("n"))


@register("p09_recent_interval", """
SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - INTERVAL 14 DAY""")
def p09(spark, d):
    e = T(spark, d).events
    return e.filter(F.col("ts").cast("date") >= F.date_sub(F.lit("2024-01-20").cast("date"), 14)).select("event_id", "ts")


@register("p10_null_tolerant_or", O.sql("""
SELECT listing_id, seq FROM listings_raw WHERE (area_sqft > 500 OR area_sqft IS NULL) AND coalesce(bedrooms, 0) >= 1""",
    "listings_raw"))
def p10(spark, d):
    r = B(spark, d, "listings")
    return r.filter(((F.col("area_sqft") > 500) | F.col("area_sqft").isNull())
                    & (F.coalesce("bedrooms", F.lit(0)) >= 1)).select("listing_id", "seq")


@register("p11_discount_filter", O.sql("""
SELECT l.listing_id, l.seq FROM listings_raw l
JOIN (SELECT country_code, city, median(price_usd) AS mp FROM listings_raw GROUP BY 1, 2) m
  ON l.country_code = m.country_code AND l.city = m.city
WHERE l.price_usd < m.mp * 0.85e0""", "listings_raw"))
def p11(spark, d):
    r = B(spark, d, "listings")
    m = median.exact_median(r, ["country_code", "city"], "price_usd", "mp")
    return r.join(m, ["country_code", "city"]).filter(F.col("price_usd") < F.col("mp") * 0.85).select("listing_id", "seq")


@register("p12_case_map", O.sql(f"""
SELECT listing_id, seq, property_type AS raw_type, {O.PROPERTY_CASE} AS property_type FROM listings_raw""", "listings_raw"))
def p12(spark, d):
    r = B(spark, d, "listings")
    return r.select("listing_id", "seq", F.col("property_type").alias("raw_type"),
                    labels.property_type_norm("property_type").alias("property_type"))


@register("p13_threshold_label", O.sql("""
SELECT hazard_id, CASE WHEN risk_score >= 0.8 THEN 'very_high' WHEN risk_score >= 0.6 THEN 'high'
                       WHEN risk_score >= 0.3 THEN 'medium' WHEN risk_score IS NOT NULL THEN 'low' END AS risk_level,
       CASE WHEN risk_score * 1e2 < 25 THEN 'low' WHEN risk_score * 1e2 < 50 THEN 'medium' WHEN risk_score * 1e2 < 75 THEN 'high'
            ELSE 'very_high' END AS hazard_label,
       CASE WHEN risk_score * 1e1 < 2 THEN 'hot' WHEN risk_score * 1e1 < 4 THEN 'warm' WHEN risk_score * 1e1 < 6 THEN 'cool'
            WHEN risk_score IS NOT NULL THEN 'cold' END AS market_temp
FROM hazards""", "hazards"))
def p13(spark, d):
    h = B(spark, d, "hazards")
    return h.select("hazard_id", labels.risk_level("risk_score").alias("risk_level"),
                    labels.hazard_label(F.col("risk_score") * 100.0).alias("hazard_label"),
                    labels.market_temp(F.col("risk_score") * 10.0).alias("market_temp"))


_STATUS = ("CASE event_type WHEN 'purchase' THEN 'FOR_SALE' WHEN 'click' THEN 'FOR_RENT' ELSE '' END",
           "CASE WHEN user_id % 3 = 0 THEN 'RentalHome' ELSE '' END",
           "CASE WHEN event_id % 5 = 0 THEN 'sale' ELSE '' END")


@register("p14_sale_predicate", f"""
SELECT event_id,
  NOT (s1 LIKE '%RENT%' OR s2 LIKE '%RENT%' OR s3 LIKE '%RENT%')
  AND (s1 LIKE '%SALE%' OR s2 LIKE '%SALE%' OR s3 LIKE '%SALE%' OR (s1 = '' AND s2 = '' AND s3 = '')) AS for_sale
FROM (SELECT event_id, upper({_STATUS[0]}) AS s1, upper({_STATUS[1]}) AS s2, upper({_STATUS[2]}) AS s3 FROM events) e""")
def p14(spark, d):
    e = T(spark, d).events
    s1 = F.when(F.col("event_type") == "purchase", "FOR_SALE").when(F.col("event_type") == "click", "FOR_RENT").otherwise("")
    s2 = F.when(F.col("user_id") % 3 == 0, "RentalHome").otherwise("")
    s3 = F.when(F.col("event_id") % 5 == 0, "sale").otherwise("")
    return e.select("event_id", labels.is_for_sale(s1, s2, s3).alias("for_sale"))


@register("p15_extreme_day", O.sql(f"""
SELECT country_code, city, date, {O.EXTREME} AS is_extreme_day FROM weather""", "weather"))
def p15(spark, d):
    w = B(spark, d, "weather")
    return w.select("country_code", "city", "date",
                    labels.is_extreme_day("precipitation_mm", "wind_speed_max_kmh", "temp_max_c", "temp_min_c").alias("is_extreme_day"))


@register("p16_parse_ok_flag", O.sql("""
SELECT listing_id, seq, price_usd IS NOT NULL AND bedrooms IS NOT NULL AND area_sqft IS NOT NULL AS parse_ok FROM listings_raw""",
    "listings_raw"))
def p16(spark, d):
    r = B(spark, d, "listings")
    ok = F.col("price_usd").isNotNull() & F.col("bedrooms").isNotNull() & F.col("area_sqft").isNotNull()
    return r.select("listing_id", "seq", ok.alias("parse_ok"))


@register("p17_scalar_subquery_latest", O.sql("""
SELECT country_code, city, zip_or_municipio, date, median_price_usd FROM market_raw
WHERE country_code = 'US' AND city = 'NATION_1'
  AND date = (SELECT max(date) FROM market_raw WHERE country_code = 'US' AND city = 'NATION_1')""", "market_raw"))
def p17(spark, d):
    m = B(spark, d, "market").filter((F.col("country_code") == "US") & (F.col("city") == "NATION_1"))
    return filters.at_scalar_max(m, "date").select("country_code", "city", "zip_or_municipio", "date", "median_price_usd")


@register("p18_having", O.sql("""
SELECT city, barrio_or_neighborhood, count(*) AS n FROM listings_raw WHERE country_code = 'CO'
GROUP BY 1, 2 HAVING count(*) > 5""", "listings_raw"))
def p18(spark, d):
    r = B(spark, d, "listings").filter(F.col("country_code") == "CO")
    return r.groupBy("city", "barrio_or_neighborhood").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 5)


@register("p19_positive_guard", O.sql("""
SELECT date, rate FROM fx WHERE rate IS NOT NULL AND NOT isnan(rate) AND rate > 0""", "fx"))
def p19(spark, d):
    f = B(spark, d, "fx")
    return f.filter(filters.positive_number("rate")).select("date", "rate")


@register("p20_param_clamp", """
SELECT conv_id, turn, greatest(1, least(50, coalesce(CAST(TRY_CAST(CASE WHEN turn % 3 = 0 THEN 'abc' ELSE CAST(turn * 7 AS VARCHAR) END AS DOUBLE) AS BIGINT), 10))) AS clean_limit
FROM conversations""")
def p20(spark, d):
    c = T(spark, d).conversations
    raw = F.when(F.col("turn") % 3 == 0, F.lit("abc")).otherwise((F.col("turn") * 7).cast("string"))
    return c.select("conv_id", "turn", numbers.clamp_param(raw, 10, 1, 50).alias("clean_limit"))


@register("p21_city_filter", O.sql("""
SELECT city, country_code, crime_type, "count", period_year, period_month FROM crime
WHERE regexp_replace(translate(lower(trim(city)), 'áéíóúñü', 'aeiounu'), '[^a-z0-9]', '', 'g') IN ('nation1', 'nation6')""",
    "crime"))
def p21(spark, d):
    c = B(spark, d, "crime")
    return filters.in_alias_set(c, "city", ["nation1", "nation6"])


@register("p22_newest_available", O.sql("""
SELECT * FROM crime WHERE period_year = (SELECT max(period_year) FROM crime WHERE "count" > 0 AND period_month <= 6)""",
    "crime"))
def p22(spark, d):
    c = B(spark, d, "crime")
    return filters.newest_available(c, "period_year", (F.col("count") > 0) & (F.col("period_month") <= 6))


@register("p23_fill_null", O.sql("""
SELECT u.country_code, u.city, u.zip_or_municipio, coalesce(a.grocery_count, 0) AS grocery_count,
       coalesce(a.park_count, 0) AS park_count, coalesce(a.hospital_count, 0) AS hospital_count,
       coalesce(a.transit_stop_count, 0) AS transit_stop_count
FROM (SELECT DISTINCT country_code, city, zip_or_municipio FROM listings_raw) u
LEFT JOIN amenity_counts a ON u.country_code = a.country_code AND u.city = a.city""", "listings_raw", "amenity_counts"))
def p23(spark, d):
    u = B(spark, d, "listings").select("country_code", "city", "zip_or_municipio").distinct()
    a = silver.amenity_city_counts(B(spark, d, "amenities"))
    cols = ["grocery_count", "park_count", "hospital_count", "transit_stop_count"]
    return u.join(a, ["country_code", "city"], "left").fillna(0, subset=cols).select("country_code", "city", "zip_or_municipio", *cols)


@register("p24_qualified_star", O.sql("""
SELECT u.*, s.school_count FROM (SELECT DISTINCT country_code, city FROM listings_raw) u
LEFT JOIN school_stats s ON u.country_code = s.country_code AND u.city = s.city""", "listings_raw", "school_stats"))
def p24(spark, d):
    u = B(spark, d, "listings").select("country_code", "city").distinct().alias("u")
    s = silver.school_city_stats(B(spark, d, "schools")).alias("s")
    return u.join(s, (F.col("u.country_code") == F.col("s.country_code")) & (F.col("u.city") == F.col("s.city")), "left") \
            .select("u.*", "s.school_count")


@register("p25_stamp_now", O.sql("""
SELECT hazard_id, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at, 'events' AS source FROM hazards""", "hazards"))
def p25(spark, d):
    h = B(spark, d, "hazards")
    return h.select("hazard_id", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ingested_at"), F.lit("events").alias("source"))


# --- aggregations --------------------------------------------------------------------------
@register("a01_count_by", O.sql("""
SELECT country_code, city, count(*) AS n FROM listings_raw GROUP BY 1, 2""", "listings_raw"))
def a01(spark, d):
    return B(spark, d, "listings").groupBy("country_code", "city").agg(F.count(F.lit(1)).alias("n"))


@register("a02_sum_by", O.sql("""
SELECT city, CAST(sum("count") AS BIGINT) AS total FROM crime GROUP BY 1""", "crime"))
def a02(spark, d):
    return B(spark, d, "crime").groupBy("city").agg(F.sum("count").cast("bigint").alias("total"))


@register("a03_centroid", O.rounded(O.sql("""
SELECT country_code, city, zip_or_municipio, avg(lat) AS lat_centroid, avg(lon) AS lon_centroid FROM listings_raw GROUP BY 1, 2, 3""",
    "listings_raw"), ["lat_centroid", "lon_centroid"]))
def a03(spark, d):
    return B(spark, d, "listings").groupBy("country_code", "city", "zip_or_municipio") \
        .agg(F.avg("lat").alias("lat_centroid"), F.avg("lon").alias("lon_centroid"))


@register("a04_envelope", O.rounded(O.sql("""
SELECT city, min(lat) - greatest(0.05e0, (max(lat) - min(lat)) * 0.1e0) AS min_lat,
             max(lat) + greatest(0.05e0, (max(lat) - min(lat)) * 0.1e0) AS max_lat,
             min(lon) - greatest(0.05e0, (max(lon) - min(lon)) * 0.1e0) AS min_lon,
             max(lon) + greatest(0.05e0, (max(lon) - min(lon)) * 0.1e0) AS max_lon
FROM listings_raw GROUP BY 1""", "listings_raw"), ["min_lat", "max_lat", "min_lon", "max_lon"]))
def a04(spark, d):
    return spatial.envelope(B(spark, d, "listings"), ["city"], pad_frac=0.1, min_pad_deg=0.05)


@register("a05_high_water_mark", O.sql("""
SELECT k.country_code, k.city, w.hw AS high_water_mark
FROM (SELECT DISTINCT country_code, city FROM amenities) k
LEFT JOIN (SELECT country_code, city, max(date) AS hw FROM weather GROUP BY 1, 2) w
  ON k.country_code = w.country_code AND k.city = w.city""", "amenities", "weather"))
def a05(spark, d):
    w = B(spark, d, "weather")
    keys = B(spark, d, "amenities").select("country_code", "city")
    return dedupe.high_water_mark(w, ["country_code", "city"], "date", keys)


@register("a06_count_distinct", O.sql("""
SELECT country_code, count(DISTINCT period_year) AS n_years, count(DISTINCT city) AS n_cities FROM crime GROUP BY 1""", "crime"))
def a06(spark, d):
    return B(spark, d, "crime").groupBy("country_code").agg(F.countDistinct("period_year").alias("n_years"),
                                                            F.countDistinct("city").alias("n_cities"))


@register("a07_conditional_sum", O.sql(f"""
SELECT country_code, city, CAST(sum(CASE WHEN {O.EXTREME} THEN 1 ELSE 0 END) AS BIGINT) AS extreme_days,
       count(*) FILTER (WHERE precipitation_mm IS NOT NULL) AS wet_days
FROM weather GROUP BY 1, 2""", "weather"))
def a07(spark, d):
    w = B(spark, d, "weather")
    ext = labels.is_extreme_day("precipitation_mm", "wind_speed_max_kmh", "temp_max_c", "temp_min_c")
    return w.groupBy("country_code", "city").agg(F.sum(ext.cast("int")).cast("bigint").alias("extreme_days"),
                                                 F.count_if(F.col("precipitation_mm").isNotNull()).alias("wet_days"))


@register("a08_two_level", O.rounded(O.sql("""
SELECT city, avg(total) AS avg_per_year FROM (SELECT city, period_year, sum("count") AS total FROM crime GROUP BY 1, 2) y GROUP BY 1""",
    "crime"), ["avg_per_year"]))
def a08(spark, d):
    c = B(spark, d, "crime")
    return c.groupBy("city", "period_year").agg(F.sum("count").alias("total")) \
            .groupBy("city").agg(F.avg("total").alias("avg_per_year"))


@register("a09_pivot_count", O.sql("SELECT * FROM amenity_counts", "amenity_counts"))
def a09(spark, d):
    return pivot.pivot_count(B(spark, d, "amenities"), ["country_code", "city"], "amenity_type", silver.AMENITY_TYPES)


@register("a10_pivot_max_fill", O.rounded(O.sql("""
SELECT country_code, county_or_municipio, """ + ", ".join(
    f"coalesce(max(CASE WHEN hazard_type = '{h}' THEN risk_score * 1e2 END), 0e0) AS {h}" for h in silver.HAZARD_TYPES)
    + " FROM hazards GROUP BY 1, 2", "hazards"), silver.HAZARD_TYPES))
def a10(spark, d):
    return pivot.pivot_max_fill(B(spark, d, "hazards"), ["country_code", "county_or_municipio"], "hazard_type",
                                silver.HAZARD_TYPES, F.col("risk_score") * 100.0)


@register("a11_median", O.rounded(O.sql("""
SELECT country_code, city, median(price_usd) AS median_price_usd FROM listings_raw GROUP BY 1, 2""", "listings_raw"),
    ["median_price_usd"]))
def a11(spark, d):
    return median.exact_median(B(spark, d, "listings"), ["country_code", "city"], "price_usd", "median_price_usd")


@register("a12_mode", """
SELECT c_nationkey, arg_min(c_mktsegment, (-n, c_mktsegment)) AS segment_mode
FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1, 2) x GROUP BY 1""")
def a12(spark, d):
    c = T(spark, d).customer.filter(F.col("c_mktsegment").isNotNull())
    cnt = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    best = cnt.groupBy("c_nationkey").agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("c_mktsegment").alias("v"))).alias("m"))
    return best.select("c_nationkey", F.col("m.v").alias("segment_mode"))


@register("a13_mean_and_size", O.rounded(O.sql("""
SELECT country_code, city, avg(reading_pct) AS mean_score, count(*) AS n FROM schools GROUP BY 1, 2""", "schools"), ["mean_score"]))
def a13(spark, d):
    return B(spark, d, "schools").groupBy("country_code", "city").agg(F.avg("reading_pct").alias("mean_score"),
                                                                      F.count(F.lit(1)).alias("n"))


_SUBJ = ("CASE l_linenumber WHEN 1 THEN 'Math' WHEN 2 THEN 'mathematics' WHEN 3 THEN 'ELA' WHEN 4 THEN 'Reading' "
         "WHEN 5 THEN 'english' ELSE 'science' END")


@register("a14_best_per_subject_pivot", O.rounded(f"""
SELECT l_partkey AS school_id, max(CASE WHEN s = 'math' THEN pct END) AS math_pct, max(CASE WHEN s = 'reading' THEN pct END) AS reading_pct
FROM (SELECT l_partkey, l_discount * 1e3 AS pct,
             CASE WHEN lower(trim({_SUBJ})) IN ('math','mathematics') THEN 'math'
                  WHEN lower(trim({_SUBJ})) IN ('read','reading','ela','english') THEN 'reading' END AS s FROM lineitem) x
WHERE s IS NOT NULL GROUP BY 1""", ["math_pct", "reading_pct"]))
def a14(spark, d):
    l = T(spark, d).lineitem
    n = F.col("l_linenumber")
    raw = (F.when(n == 1, "Math").when(n == 2, "mathematics").when(n == 3, "ELA").when(n == 4, "Reading")
            .when(n == 5, "english").otherwise("science"))
    x = l.select(F.col("l_partkey").alias("school_id"), (F.col("l_discount") * 1e3).alias("pct"), labels.subject_fold(raw).alias("s")) \
         .filter(F.col("s").isNotNull())
    return pivot.pivot_max(x, ["school_id"], "s", ["math", "reading"], "pct", "_pct")


@register("a15_count_with_sample", O.rounded(O.sql("""
SELECT country_code, county_or_municipio, hazard_type, count(*) AS n, least(count(*) / 5e1, 1e0) AS risk_score,
       arg_min(hazard_id, hazard_id) AS sample_id
FROM hazards GROUP BY 1, 2, 3""", "hazards"), ["risk_score"]))
def a15(spark, d):
    h = B(spark, d, "hazards")
    g = h.groupBy("country_code", "county_or_municipio", "hazard_type").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("hazard_id", "hazard_id").alias("sample_id"))
    return g.select("country_code", "county_or_municipio", "hazard_type", "n",
                    numbers.score_from_measure("n", 50).alias("risk_score"), "sample_id")


@register("a16_month_avg", O.rounded("""
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, avg(value) AS avg_value FROM events GROUP BY 1""", ["avg_value"]))
def a16(spark, d):
    e = T(spark, d).events
    return e.groupBy(F.trunc(F.col("ts").cast("date"), "month").alias("month")).agg(F.avg("value").alias("avg_value"))


@register("a17_global_min_max", """
SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders""")
def a17(spark, d):
    o = T(spark, d).orders
    return o.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"),
                 F.min("o_orderdate").alias("first_ts"), F.max("o_orderdate").alias("last_ts"))


@register("a18_profile_summary", O.rounded(O.sql(f"""
SELECT country_code, city, avg(temp_max_c) AS avg_temp_max_c, avg(temp_min_c) AS avg_temp_min_c,
       avg(precipitation_mm) AS avg_precip_mm, CAST(sum(CASE WHEN {O.EXTREME} THEN 1 ELSE 0 END) AS BIGINT) AS total_extreme_days,
       count(DISTINCT year(date)) AS years_covered, min(date) AS first_date, max(date) AS last_date,
       CAST(sum(CASE WHEN {O.EXTREME} THEN 1 ELSE 0 END) AS DOUBLE) / count(DISTINCT year(date)) AS extreme_days_per_year
FROM weather GROUP BY 1, 2""", "weather"), ["avg_temp_max_c", "avg_temp_min_c", "avg_precip_mm", "extreme_days_per_year"]))
def a18(spark, d):
    w = B(spark, d, "weather")
    ext = labels.is_extreme_day("precipitation_mm", "wind_speed_max_kmh", "temp_max_c", "temp_min_c")
    g = w.groupBy("country_code", "city").agg(
        F.avg("temp_max_c").alias("avg_temp_max_c"), F.avg("temp_min_c").alias("avg_temp_min_c"),
        F.avg("precipitation_mm").alias("avg_precip_mm"), F.sum(ext.cast("int")).cast("bigint").alias("total_extreme_days"),
        F.countDistinct(F.year("date")).alias("years_covered"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return g.withColumn("extreme_days_per_year", F.try_divide(F.col("total_extreme_days").cast("double"), F.col("years_covered")))


@register("a19_distinct", O.sql("SELECT DISTINCT country_code, city FROM listings_raw", "listings_raw"))
def a19(spark, d):
    return B(spark, d, "listings").select("country_code", "city").distinct()


@register("a20_count_non_null", O.sql("""
SELECT country_code, count(*) AS n, count(area_sqft) AS n_with_area FROM listings_raw GROUP BY 1""", "listings_raw"))
def a20(spark, d):
    return B(spark, d, "listings").groupBy("country_code").agg(F.count(F.lit(1)).alias("n"), F.count("area_sqft").alias("n_with_area"))


@register("a21_rounded_avg", O.sql("""
SELECT c_nationkey, sign(s) * ((2 * abs(s) + n) // (2 * n)) / 1e2 AS avg_balance
FROM (SELECT c_nationkey, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS s, count(*) AS n FROM customer GROUP BY 1) x"""))
def a21(spark, d):
    """ROUND(AVG(x), 2), half away from zero, computed exactly in integer cents so the
    result does not depend on floating-point summation order."""
    c = T(spark, d).customer
    g = c.groupBy("c_nationkey").agg(F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("s"),
                                     F.count(F.lit(1)).alias("n"))
    return g.select("c_nationkey", (F.signum("s") * F.expr("(2 * abs(s) + n) div (2 * n)") / 100.0).alias("avg_balance"))


@register("a22_category_map", O.sql("""
SELECT country_code, city, string_agg(concat(cat, '=', CAST(n AS VARCHAR)), ';' ORDER BY concat(cat, '=', CAST(n AS VARCHAR))) AS by_category,
       CAST(sum(n) AS BIGINT) AS total
FROM (SELECT country_code, city, CASE WHEN raw LIKE '%homicid%' OR raw LIKE '%violenc%' THEN 'violent'
                                      WHEN raw LIKE '%hurto%' AND raw LIKE '%violen%' THEN 'violent'
                                      WHEN raw LIKE '%hurto%' OR raw LIKE '%robo%' OR raw LIKE '%dano%' THEN 'property'
                                      ELSE 'other' END AS cat, count(*) AS n
      FROM (SELECT *, translate(lower(trim(crime_type)), 'áéíóúñü', 'aeiounu') AS raw FROM crime) c GROUP BY 1, 2, 3) x
GROUP BY 1, 2""", "crime"))
def a22(spark, d):
    c = B(spark, d, "crime").withColumn("cat", labels.crime_category_spanish("crime_type"))
    n = c.groupBy("country_code", "city", "cat").agg(F.count(F.lit(1)).alias("n"))
    g = n.groupBy("country_code", "city").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("cat", "n")))).alias("m"),
        F.sum("n").cast("bigint").alias("total"))
    return g.select("country_code", "city",
                    F.array_join(F.sort_array(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ";").alias("by_category"),
                    "total")


@register("a23_city_rollup_avgs", O.rounded(O.sql("SELECT * FROM city_summary", "city_summary"),
                                            ["avg_composite_score", "avg_crime_per_100k", "avg_school_score",
                                             "avg_amenity_density", "avg_transit_access", "avg_hazard_score",
                                             "avg_weather_extreme_days", "latest_median_price_usd"]))
def a23(spark, d):
    from .pipeline import Pipeline
    return Pipeline(spark, d).city_summary


@register("a24_run_summary", O.sql("""
SELECT source, count(*) FILTER (WHERE row_status = 'new') AS inserted, count(*) FILTER (WHERE row_status = 'refresh') AS updated,
       count(*) FILTER (WHERE row_status = 'parse_failure') AS failed,
       CASE WHEN count(*) FILTER (WHERE row_status <> 'parse_failure') = 0 THEN 'failed' ELSE 'ok' END AS status
FROM (SELECT b.source, CASE WHEN NOT (b.price_usd IS NOT NULL AND b.area_sqft IS NOT NULL) THEN 'parse_failure'
                            WHEN k.listing_id IS NULL THEN 'new' ELSE 'refresh' END AS row_status
      FROM listings_raw b
      LEFT JOIN (SELECT DISTINCT listing_id FROM listings_raw WHERE scraped_at < TIMESTAMP '1995-01-01') k ON b.listing_id = k.listing_id
      WHERE b.scraped_at >= TIMESTAMP '1995-01-01') x
GROUP BY 1""", "listings_raw"))
def a24(spark, d):
    r = B(spark, d, "listings")
    cut = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    known = r.filter(F.col("scraped_at") < cut)
    batch = r.filter(F.col("scraped_at") >= cut)
    flagged = upsert.insert_refresh_split(batch, known, ["listing_id"], ["price_usd", "area_sqft"])
    g = flagged.groupBy("source").agg(F.count_if(F.col("row_status") == "new").alias("inserted"),
                                      F.count_if(F.col("row_status") == "refresh").alias("updated"),
                                      F.count_if(F.col("row_status") == "parse_failure").alias("failed"),
                                      F.count_if(F.col("row_status") != "parse_failure").alias("_ok"))
    return g.select("source", "inserted", "updated", "failed",
                    F.when(F.col("_ok") == 0, "failed").otherwise("ok").alias("status"))
