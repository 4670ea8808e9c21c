"""Registered join (j01-j20), window (w01-w12), top-k (l01-l07) and union (u01-u02) queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo, labels, text
from ..operators import dedupe, rank, spatial, windows
from ..sources import bindings
from ..sources.tables import Tables
from . import gold, silver
from .catalog import O, register
from .pipeline import Pipeline


def T(spark, d) -> Tables:
    return Tables.shared(spark, d)


def B(spark, d, name):
    return getattr(bindings, name)(T(spark, d))


KEYS3 = ["country_code", "city", "zip_or_municipio"]


# --- joins -------------------------------------------------------------------------------------
@register("j01_inner_equi_multi", O.sql("""
SELECT l.listing_id, l.seq, m.median_price_usd FROM listings_raw l
JOIN market_latest_area m ON l.country_code = m.country_code AND l.city = m.city AND l.zip_or_municipio = m.zip_or_municipio""",
    "listings_raw", "market_latest_area"))
def j01(spark, d):
    ms = silver.market_summary(B(spark, d, "market"), B(spark, d, "fx"))
    m = gold.latest_area_price(ms, "median_price_usd")
    return B(spark, d, "listings").join(m, KEYS3, "inner").select("listing_id", "seq", "median_price_usd")


@register("j02_left_equi", O.rounded(O.sql("""
SELECT u.country_code, u.city, u.zip_or_municipio, s.school_count, s.school_score_normalized
FROM (SELECT DISTINCT country_code, city, zip_or_municipio FROM listings_raw) u
LEFT JOIN school_stats s ON u.country_code = s.country_code AND u.city = s.city""", "listings_raw", "school_stats"),
    ["school_score_normalized"]))
def j02(spark, d):
    u = B(spark, d, "listings").select(*KEYS3).distinct()
    return u.join(silver.school_city_stats(B(spark, d, "schools")), ["country_code", "city"], "left")


@register("j03_left_conditional", O.sql("""
SELECT u.country_code, u.city, u.zip_or_municipio, c.n AS crime_count
FROM (SELECT DISTINCT country_code, city, zip_or_municipio FROM listings_raw) u
LEFT JOIN (SELECT city, count(*) AS n FROM crime GROUP BY 1) c ON u.country_code = 'US' AND u.city = c.city""",
    "listings_raw", "crime"))
def j03(spark, d):
    u = B(spark, d, "listings").select(*KEYS3).distinct().alias("u")
    c = B(spark, d, "crime").groupBy("city").agg(F.count(F.lit(1)).alias("n")).alias("c")
    j = u.join(c, (F.col("u.country_code") == F.lit("US")) & (F.col("u.city") == F.col("c.city")), "left")
    return j.select("u.*", F.col("c.n").alias("crime_count"))


@register("j04_latest_per_key", O.sql("""
SELECT c.* FROM crime c JOIN (SELECT city, max(period_year) AS my FROM crime GROUP BY 1) m
  ON c.city = m.city AND c.period_year = m.my""", "crime"))
def j04(spark, d):
    return dedupe.rows_at_max(B(spark, d, "crime"), ["city"], "period_year")


@register("j05_semi_in", O.sql("""
SELECT listing_id, seq FROM listings_raw WHERE seq IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "listings_raw"))
def j05(spark, d):
    f = T(spark, d).orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("seq"))
    return B(spark, d, "listings").join(f, "seq", "left_semi").select("listing_id", "seq")


@register("j06_anti_new_keys", O.sql("""
SELECT DISTINCT listing_id FROM listings_raw WHERE scraped_at >= TIMESTAMP '1996-01-01'
  AND listing_id NOT IN (SELECT listing_id FROM listings_raw WHERE scraped_at < TIMESTAMP '1996-01-01')""", "listings_raw"))
def j06(spark, d):
    r = B(spark, d, "listings")
    cut = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    batch = r.filter(F.col("scraped_at") >= cut).select("listing_id").distinct()
    return batch.join(r.filter(F.col("scraped_at") < cut).select("listing_id"), "listing_id", "left_anti")


@register("j07_registry_inner", O.rounded(O.sql("""
SELECT r.school_id, r.city, a.math_pct FROM (SELECT school_id, min(city) AS city FROM schools GROUP BY 1) r
JOIN (SELECT CAST(l_partkey AS VARCHAR) AS school_id, max(l_discount * 1e3) AS math_pct FROM lineitem GROUP BY 1) a
  ON r.school_id = a.school_id""", "schools"), ["math_pct"]))
def j07(spark, d):
    reg = dedupe.dedupe_by_key(B(spark, d, "schools").select("school_id", "city"), ["school_id"])
    ass = T(spark, d).lineitem.groupBy(F.col("l_partkey").cast("string").alias("school_id")) \
                               .agg(F.max(F.col("l_discount") * 1e3).alias("math_pct"))
    return reg.join(ass, "school_id", "inner")


@register("j08_dict_left_join", O.rounded("""
SELECT CAST(p.p_partkey AS VARCHAR) AS school_id, p.p_name AS school_name, s.math_pct, s.reading_pct
FROM part p LEFT JOIN (SELECT l_partkey, max(CASE WHEN l_linenumber <= 2 THEN l_discount * 1e3 END) AS math_pct,
                              max(CASE WHEN l_linenumber BETWEEN 3 AND 5 THEN l_discount * 1e3 END) AS reading_pct
                       FROM lineitem GROUP BY 1) s ON p.p_partkey = s.l_partkey""",
    ["math_pct", "reading_pct"]))
def j08(spark, d):
    t = T(spark, d)
    sc = t.lineitem.groupBy("l_partkey").agg(
        F.max(F.when(F.col("l_linenumber") <= 2, F.col("l_discount") * 1e3)).alias("math_pct"),
        F.max(F.when(F.col("l_linenumber").between(3, 5), F.col("l_discount") * 1e3)).alias("reading_pct"))
    part = t.part
    return part.join(sc, part.p_partkey == sc.l_partkey, "left") \
                 .select(F.col("p_partkey").cast("string").alias("school_id"), F.col("p_name").alias("school_name"),
                         "math_pct", "reading_pct")


@register("j09_month_key_join", O.rounded(O.sql("""
SELECT m.country_code, m.city, m.zip_or_municipio, m.date, m.median_price_usd, e.avg_value
FROM market_raw m JOIN (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_extendedprice) AS avg_value
                        FROM lineitem GROUP BY 1) e ON m.date = e.month""", "market_raw"), ["avg_value"]))
def j09(spark, d):
    m = B(spark, d, "market")
    e = T(spark, d).lineitem.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("date")) \
                             .agg(F.avg("l_extendedprice").alias("avg_value"))
    return m.join(e, "date").select(*KEYS3, "date", "median_price_usd", "avg_value")


@register("j10_left_join_centroid", O.rounded(O.sql("""
SELECT d.country_code, d.zip_or_municipio, d.year, avg(l.lat) AS lat, avg(l.lon) AS lon
FROM demographics d LEFT JOIN listings_raw l ON d.country_code = l.country_code AND d.zip_or_municipio = l.zip_or_municipio
GROUP BY 1, 2, 3""", "demographics", "listings_raw"), ["lat", "lon"]))
def j10(spark, d):
    dm = B(spark, d, "demographics").select("country_code", "zip_or_municipio", "year")
    # the listings of an area collapse to sums before they meet its years
    l = B(spark, d, "listings").groupBy("country_code", "zip_or_municipio").agg(
        F.sum("lat").alias("slat"), F.count("lat").alias("nlat"), F.sum("lon").alias("slon"), F.count("lon").alias("nlon"))
    years = dm.groupBy("country_code", "zip_or_municipio", "year").agg(F.count(F.lit(1)).alias("n"))
    return years.join(l, ["country_code", "zip_or_municipio"], "left").select(
        "country_code", "zip_or_municipio", "year",
        F.try_divide("slat", "nlat").alias("lat"), F.try_divide("slon", "nlon").alias("lon"))


_HAV = geo.haversine_sql("c", "g")


@register("j11_nearest_point", O.sql(f"""
SELECT geo_id, lat, lon, point_id, round(dist_km, 4) AS dist_km, pga FROM
 (SELECT c.geo_id, c.lat, c.lon, g.point_id, {_HAV} AS dist_km, g.pga,
         row_number() OVER (PARTITION BY c.geo_id ORDER BY {_HAV}, g.lat, g.lon, g.point_id) AS rn
  FROM centroids c CROSS JOIN grid g) x WHERE rn = 1""", "centroids", "grid"))
def j11(spark, d):
    c, g = B(spark, d, "centroids"), B(spark, d, "grid")
    out = spatial.nearest_point(c, g, "geo_id", "point_id", payload=["pga"])
    return out.withColumn("dist_km", F.round("dist_km", 4))


@register("j12_radius_count", O.rounded(O.sql(f"""
SELECT c.geo_id, c.lat, c.lon, count(g.point_id) AS n_within, avg(g.pga) AS avg_pga
FROM centroids c LEFT JOIN grid g ON {_HAV} <= 1500
GROUP BY 1, 2, 3""", "centroids", "grid"), ["avg_pga"]))
def j12(spark, d):
    c, g = B(spark, d, "centroids"), B(spark, d, "grid")
    return spatial.radius_count(c, g, 1500.0, "geo_id", "n_within", value_col="pga", avg_col="avg_pga")


@register("j13_bbox_containment", O.sql("""
SELECT c.geo_id, b.listing_id FROM centroids c JOIN
 (SELECT listing_id, min(lat) - greatest(0.05e0, (max(lat) - min(lat)) * 0.1e0) - 0.5e0 AS min_lat,
               max(lat) + greatest(0.05e0, (max(lat) - min(lat)) * 0.1e0) + 0.5e0 AS max_lat,
               min(lon) - greatest(0.05e0, (max(lon) - min(lon)) * 0.1e0) - 0.5e0 AS min_lon,
               max(lon) + greatest(0.05e0, (max(lon) - min(lon)) * 0.1e0) + 0.5e0 AS max_lon
  FROM listings_raw GROUP BY 1) b
ON c.lat BETWEEN b.min_lat AND b.max_lat
 AND (c.lon BETWEEN b.min_lon AND b.max_lon OR c.lon + 360 BETWEEN b.min_lon AND b.max_lon OR c.lon - 360 BETWEEN b.min_lon AND b.max_lon)""", "centroids", "listings_raw"))
def j13(spark, d):
    boxes = spatial.envelope(B(spark, d, "listings"), ["listing_id"], pad_deg=0.5, pad_frac=0.1, min_pad_deg=0.05)
    pts = B(spark, d, "centroids")
    return spatial.bbox_join(pts, boxes, ["listing_id"], cell_deg=1.0).select("geo_id", "listing_id")


@register("j14_latest_correlated", O.sql("""
SELECT l.listing_id, m.market_temp, m.median_price_usd AS area_median_price_usd
FROM silver_listings l
LEFT JOIN (SELECT ms.* FROM market_summary ms
           JOIN (SELECT country_code, city, max(date) AS mx FROM market_summary GROUP BY 1, 2) x
             ON ms.country_code = x.country_code AND ms.city = x.city AND ms.date = x.mx) m
  ON l.country_code = m.country_code AND l.city = m.city AND l.zip_or_municipio = m.zip_or_municipio""",
    "silver_listings", "market_summary"))
def j14(spark, d):
    p = Pipeline(spark, d)
    return p.listing_map.select("listing_id", "market_temp", "area_median_price_usd")


@register("j15_enrich_view", O.rounded(O.sql("SELECT * FROM listing_map", "listing_map"),
                                       ["lat", "lon", "price_per_sqft_usd", "area_sqft", "bathrooms", "composite_score",
                                        "crime_rate_per_100k", "school_score_normalized"]))
def j15(spark, d):
    return Pipeline(spark, d).listing_map


@register("j16_left_join_then_group", O.rounded(O.sql("SELECT * FROM city_summary", "city_summary"),
                                                ["avg_composite_score", "avg_crime_per_100k", "avg_school_score",
                                                 "avg_amenity_density", "avg_transit_access", "avg_hazard_score",
                                                 "avg_weather_extreme_days", "latest_median_price_usd"]))
def j16(spark, d):
    return Pipeline(spark, d).city_summary


@register("j17_pair_join", O.rounded(O.sql("""
SELECT comparison_id, us_city, co_city, us_median_price_usd, co_median_price_usd, price_ratio FROM city_comparison""",
    "city_comparison"), ["price_ratio"]))
def j17(spark, d):
    return Pipeline(spark, d).city_comparison().select("comparison_id", "us_city", "co_city", "us_median_price_usd",
                                                       "co_median_price_usd", "price_ratio")


_ZONES = ["AE", "A", "AH", "AO", "V", "VE", "X500", "X", "AE99", "XB", "", "D"]


@register("j18_lookup_map", O.rounded(f"""
SELECT p_partkey, z AS zone,
  CASE WHEN z IS NULL OR z = '' THEN 0.5e0
       {' '.join(f"WHEN z = '{k}' THEN {v}e0" for k, v in labels.FLOOD_ZONE_RISK)}
       {' '.join(f"WHEN starts_with(z, '{k}') THEN {v}e0" for k, v in labels.FLOOD_ZONE_RISK)}
       ELSE 0.5e0 END AS flood_score
FROM (SELECT p_partkey, upper(trim(list_extract([{', '.join(repr(z) for z in _ZONES)}], CAST(p_partkey % {len(_ZONES)} + 1 AS INT)))) AS z
      FROM part) p""", ["flood_score"]))
def j18(spark, d):
    p = T(spark, d).part
    z = F.element_at(F.array(*[F.lit(v) for v in _ZONES]), (F.col("p_partkey") % len(_ZONES) + 1).cast("int"))
    return p.select("p_partkey", F.upper(F.trim(z)).alias("zone"), labels.flood_zone_risk(z).alias("flood_score"))


@register("j19_fx_scalar_broadcast", O.sql("""
SELECT listing_id, seq, CAST(trunc(CAST(price_usd AS DOUBLE) * fx_rate) AS BIGINT) AS price_cop, fx_rate
FROM listings_raw CROSS JOIN fx_latest""", "listings_raw", "fx_latest"))
def j19(spark, d):
    t = T(spark, d)
    r = bindings.listings(t).crossJoin(F.broadcast(silver.latest_fx(bindings.fx(t))))  # exactly one row
    return r.select("listing_id", "seq", (F.col("price_usd").cast("double") * F.col("fx_rate")).cast("long").alias("price_cop"),
                    "fx_rate")


_DEFAULT_CITIES = ["Nation 1", "Miami", "Bogota", "nation_3"]


@register("j20_union_distinct_targets", O.sql("""
SELECT slug, arg_min(city, (prio, city)) AS city FROM (
  SELECT DISTINCT city, 0 AS prio, array_to_string(list_filter(string_split_regex(trim(replace(lower(city), ',', '')), '\\s+'), lambda x: x <> ''), '-') AS slug FROM listings_raw
  UNION ALL
  SELECT city, 1 AS prio, array_to_string(list_filter(string_split_regex(trim(replace(lower(city), ',', '')), '\\s+'), lambda x: x <> ''), '-') AS slug
  FROM (VALUES ('Nation 1'), ('Miami'), ('Bogota'), ('nation_3')) AS v(city)) u
GROUP BY 1""", "listings_raw"))
def j20(spark, d):
    existing = B(spark, d, "listings").select("city").distinct().withColumn("prio", F.lit(0))
    defaults = spark.createDataFrame([(c, 1) for c in _DEFAULT_CITIES], "city string, prio int")
    u = existing.unionByName(defaults).withColumn("slug", text.slug("city"))
    best = u.groupBy("slug").agg(F.min(F.struct("prio", "city")).alias("b"))
    return best.select("slug", F.col("b.city").alias("city"))


# --- windows ------------------------------------------------------------------------------------
@register("w01_row_number_latest", O.sql("""
SELECT listing_id, seq, price_usd FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY scraped_at DESC, seq DESC) AS rn
                                      FROM listings_raw) x WHERE rn = 1""", "listings_raw"))
def w01(spark, d):
    r = B(spark, d, "listings").select("listing_id", "seq", "price_usd", "scraped_at")
    return dedupe.latest_per_key(r, ["listing_id"], ["scraped_at", "seq"]).select("listing_id", "seq", "price_usd")


@register("w02_lag_k", O.sql("""
SELECT country_code, city, zip_or_municipio, date, lag(median_price_usd, 3) OVER w AS lag_3, lag(median_price_usd, 12) OVER w AS lag_12
FROM market_raw WINDOW w AS (PARTITION BY country_code, city, zip_or_municipio ORDER BY date)""", "market_raw"))
def w02(spark, d):
    m = B(spark, d, "market")
    w = Window.partitionBy(*KEYS3).orderBy("date")
    return m.select(*KEYS3, "date", F.lag("median_price_usd", 3).over(w).alias("lag_3"),
                    F.lag("median_price_usd", 12).over(w).alias("lag_12"))


@register("w03_pct_change", O.rounded(O.sql("""
SELECT country_code, city, zip_or_municipio, date, CASE WHEN l3 > 0 THEN 1e2 * (median_price_usd - l3) / l3 END AS price_trend_3mo_pct,
       CASE WHEN l12 > 0 THEN 1e2 * (median_price_usd - l12) / l12 END AS price_trend_12mo_pct
FROM (SELECT *, lag(median_price_usd, 3) OVER w AS l3, lag(median_price_usd, 12) OVER w AS l12 FROM market_raw
      WINDOW w AS (PARTITION BY country_code, city, zip_or_municipio ORDER BY date)) x""",
    "market_raw"), ["price_trend_3mo_pct", "price_trend_12mo_pct"]))
def w03(spark, d):
    m = B(spark, d, "market")
    out = windows.lag_change(m, KEYS3, "date", "median_price_usd", {"price_trend_3mo_pct": 3, "price_trend_12mo_pct": 12})
    return out.select(*KEYS3, "date", "price_trend_3mo_pct", "price_trend_12mo_pct")


@register("w04_rolling_avg_rows", O.rounded(O.sql("""
SELECT country_code, city, zip_or_municipio, date,
       avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS r6,
       avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS r12
FROM market_raw""", "market_raw"), ["r6", "r12"]))
def w04(spark, d):
    m = B(spark, d, "market")
    return windows.rolling_mean(m, KEYS3, "date", "median_price_usd", {"r6": 6, "r12": 12}).select(*KEYS3, "date", "r6", "r12")


@register("w05_percent_rank_partition", O.rounded(O.sql("""
SELECT listing_id, seq, percent_rank() OVER (PARTITION BY country_code ORDER BY price_usd ASC NULLS LAST) * 1e2 AS price_pct_country,
       percent_rank() OVER (PARTITION BY country_code ORDER BY area_sqft ASC NULLS LAST) * 1e2 AS area_pct_country
FROM listings_raw""", "listings_raw"), ["price_pct_country", "area_pct_country"]))
def w05(spark, d):
    r = B(spark, d, "listings").select("listing_id", "seq", "country_code", "price_usd", "area_sqft")
    r = rank.percent_rank(r, "price_usd", "price_pct_country", ["country_code"])
    r = rank.percent_rank(r, "area_sqft", "area_pct_country", ["country_code"])
    return r.select("listing_id", "seq", "price_pct_country", "area_pct_country")


@register("w06_percent_rank_global", O.rounded(O.sql("""
SELECT listing_id, seq, percent_rank() OVER (ORDER BY price_usd ASC NULLS LAST) * 1e2 AS price_pct,
       percent_rank() OVER (ORDER BY bedrooms ASC NULLS LAST) * 1e2 AS bedrooms_pct
FROM listings_raw""", "listings_raw"), ["price_pct", "bedrooms_pct"]))
def w06(spark, d):
    r = B(spark, d, "listings").select("listing_id", "seq", "price_usd", "bedrooms")
    r = rank.percent_rank(r, "price_usd", "price_pct")
    r = rank.percent_rank(r, "bedrooms", "bedrooms_pct")
    return r.select("listing_id", "seq", "price_pct", "bedrooms_pct")


@register("w07_avg_tie_percentile", O.rounded(O.sql("""
SELECT school_id, CASE WHEN reading_pct IS NULL THEN NULL
                       WHEN count(reading_pct) OVER (PARTITION BY country_code) > 1
                       THEN ((rank() OVER (PARTITION BY country_code ORDER BY reading_pct)
                              + (count(*) OVER (PARTITION BY country_code, reading_pct) - 1) / 2e0) - 1)
                            / (count(reading_pct) OVER (PARTITION BY country_code) - 1) * 1e2
                       ELSE 1e2 END AS score_percentile
FROM schools""", "schools"), ["score_percentile"]))
def w07(spark, d):
    s = B(spark, d, "schools").select("school_id", "country_code", "reading_pct")
    return rank.average_rank_percentile(s, "reading_pct", "score_percentile", ["country_code"]).select("school_id", "score_percentile")


@register("w08_centered_or_range_frame", O.rounded(O.sql("""
SELECT country_code, city, zip_or_municipio, date,
       avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS centred_6,
       avg(median_price_usd) OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY year(date) * 12 + month(date)
                                   RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS range_6mo
FROM market_raw""", "market_raw"), ["centred_6", "range_6mo"]))
def w08(spark, d):
    m = B(spark, d, "market")
    a = windows.rolling_mean(m, KEYS3, "date", "median_price_usd", {"centred_6": 6}, centered=True)
    a = windows.rolling_mean_months(a, KEYS3, "date", "median_price_usd", {"range_6mo": 6})
    return a.select(*KEYS3, "date", "centred_6", "range_6mo")


@register("w09_trend_slope", O.rounded(O.sql("""
SELECT city, regr_slope(n, period_year) AS slope,
       CASE WHEN regr_slope(n, period_year) > 1e-9 THEN 'rising' WHEN regr_slope(n, period_year) < -1e-9 THEN 'falling'
            WHEN regr_slope(n, period_year) IS NOT NULL THEN 'stable' END AS trend
FROM (SELECT city, period_year, CAST(sum("count") AS DOUBLE) AS n FROM crime GROUP BY 1, 2) y GROUP BY 1""", "crime"),
    ["slope"], 4))
def w09(spark, d):
    y = B(spark, d, "crime").groupBy("city", "period_year").agg(F.sum("count").cast("double").alias("n"))
    t = windows.trend_label(y, ["city"], "period_year", "n", "trend", tolerance=1e-9)
    return t.select("city", F.round("_slope", 4).alias("slope"), "trend")


@register("w10_last_wins_batch", O.sql("""
SELECT listing_id, arg_max(seq, seq) AS seq, arg_max(price_usd, seq) AS price_usd FROM listings_raw GROUP BY 1""", "listings_raw"))
def w10(spark, d):
    r = B(spark, d, "listings").select("listing_id", "seq", "price_usd")
    return dedupe.last_wins(r, ["listing_id"], "seq")


@register("w11_drop_duplicates", O.rounded("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM
 (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_quantity) AS rn
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem) l) x WHERE rn = 1""", ["l_quantity"]))
def w11(spark, d):
    l = T(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return dedupe.dedupe_by_key(l, ["l_orderkey", "l_linenumber"])


@register("w12_latest_n_reversed", O.sql("""
SELECT country_code, city, zip_or_municipio, date, median_price_usd, CAST(13 - rn AS INT) AS pos FROM
 (SELECT *, row_number() OVER (PARTITION BY country_code, city, zip_or_municipio ORDER BY date DESC) AS rn FROM market_raw) x
WHERE rn <= 12""", "market_raw"))
def w12(spark, d):
    m = B(spark, d, "market")
    w = Window.partitionBy(*KEYS3).orderBy(F.col("date").desc())
    top = m.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 12)  # group limit applied before the shuffle
    return top.select(*KEYS3, "date", "median_price_usd", (F.lit(13) - F.col("rn")).alias("pos"))


# --- sort / top-k (the limit is the feature) ----------------------------------------------------
@register("l01_topk_asc_nulls_last", O.sql("""
SELECT listing_id, seq, price_usd FROM listings_raw WHERE country_code = 'US' AND lower(city) = 'nation_1'
ORDER BY price_usd ASC NULLS LAST, listing_id, seq LIMIT 10""", "listings_raw"))
def l01(spark, d):
    r = B(spark, d, "listings").filter((F.col("country_code") == "US") & (F.lower("city") == "nation_1"))
    return r.orderBy(F.col("price_usd").asc_nulls_last(), "listing_id", "seq").limit(10).select("listing_id", "seq", "price_usd")


@register("l02_topk_desc_nulls_last", O.rounded(O.sql("""
SELECT school_id, school_score_normalized FROM school_rankings WHERE country_code = 'CO'
ORDER BY school_score_normalized DESC NULLS LAST, school_id LIMIT 10""", "school_rankings"), ["school_score_normalized"]))
def l02(spark, d):
    s = gold.school_rankings(B(spark, d, "schools")).filter(F.col("country_code") == "CO")
    return s.orderBy(F.col("school_score_normalized").desc_nulls_last(), "school_id").limit(10) \
            .select("school_id", "school_score_normalized")


@register("l03_multi_key_sort", O.sql("""
SELECT country_code, city, CAST(sum("count") AS BIGINT) AS total FROM crime GROUP BY 1, 2 ORDER BY country_code, total DESC""",
    "crime"))
def l03(spark, d):
    c = B(spark, d, "crime").groupBy("country_code", "city").agg(F.sum("count").cast("bigint").alias("total"))
    return c.orderBy("country_code", F.col("total").desc())


@register("l04_latest_one", O.sql("SELECT date, rate FROM fx ORDER BY date DESC, rate DESC LIMIT 1", "fx"))
def l04(spark, d):
    return B(spark, d, "fx").orderBy(F.col("date").desc(), F.col("rate").desc()).limit(1).select("date", "rate")


@register("l06_sorted_output", O.rounded(O.sql("SELECT * FROM value_opportunities", "value_opportunities"),
                                         ["lat", "lon", "price_per_sqft_usd", "area_sqft", "bathrooms", "discount_pct",
                                          "neighborhood_composite_score"]))
def l06(spark, d):
    return Pipeline(spark, d).value_opportunities(sort=True)


@register("l07_preview", """
SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""")
def l07(spark, d):
    return T(spark, d).events.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(20) \
                             .select("event_id", "ts", "event_type", "value")


# --- unions -------------------------------------------------------------------------------------
@register("u01_union_by_name_strict", O.sql("""
SELECT listing_id, seq, country_code FROM listings_raw WHERE country_code = 'US'
UNION ALL SELECT listing_id, seq, country_code FROM listings_raw WHERE country_code = 'CO'""", "listings_raw"))
def u01(spark, d):
    r = B(spark, d, "listings")
    us = r.filter(F.col("country_code") == "US").select("listing_id", "seq", "country_code")
    co = r.filter(F.col("country_code") == "CO").select("country_code", "seq", "listing_id")
    return us.unionByName(co, allowMissingColumns=False)


@register("u02_union_by_name_missing", O.sql("""
SELECT country_code, city, zip_or_municipio, CAST(NULL AS VARCHAR) AS barrio_or_neighborhood FROM
  (SELECT DISTINCT country_code, city, zip_or_municipio FROM listings_raw WHERE country_code = 'US') a
UNION ALL SELECT DISTINCT country_code, city, zip_or_municipio, barrio_or_neighborhood FROM listings_raw WHERE country_code = 'CO'""",
    "listings_raw"))
def u02(spark, d):
    r = B(spark, d, "listings")
    us = r.filter(F.col("country_code") == "US").select(*KEYS3).distinct()
    co = r.filter(F.col("country_code") == "CO").select(*KEYS3, "barrio_or_neighborhood").distinct()
    return us.unionByName(co, allowMissingColumns=True)
