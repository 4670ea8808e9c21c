"""Registered scalar-function queries (f01-f38), each over a whole driver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, geo, labels, numbers, scoring, text
from ..operators import median, scale
from ..sources import bindings
from ..sources.tables import Tables
from .catalog import O, register
from .silver import latest_fx


def T(spark, d) -> Tables:
    return Tables.shared(spark, d)


@register("f01_concat_key", O.sql("""
SELECT listing_id, seq, concat_ws('_', country_code, city, coalesce(zip_or_municipio, 'UNK'),
                                  coalesce(barrio_or_neighborhood, 'ALL')) AS profile_key,
       concat_ws('_', 'events', replace(replace(property_type, '''', ''), ' ', '_'), zip_or_municipio) AS source_key
FROM listings_raw""", "listings_raw"))
def f01(spark, d):
    r = bindings.listings(T(spark, d))
    return r.select("listing_id", "seq",
                    text.key_with_defaults(("country_code", None), ("city", None), ("zip_or_municipio", "UNK"),
                                           ("barrio_or_neighborhood", "ALL")).alias("profile_key"),
                    text.concat_key(F.lit("events"), text.id_token("property_type"), "zip_or_municipio").alias("source_key"))


@register("f02_slug", """
SELECT p_partkey, array_to_string(list_filter(string_split_regex(trim(replace(lower(p_name), ',', '')), '\\s+'), lambda x: x <> ''), '-') AS slug
FROM part""")
def f02(spark, d):
    return T(spark, d).part.select("p_partkey", text.slug("p_name").alias("slug"))


@register("f03_accent_strip", """
SELECT doc_id, md5(translate(lower(trim(text)), 'áéíóúñü', 'aeiounu')) AS folded_md5 FROM documents""")
def f03(spark, d):
    return T(spark, d).documents.select("doc_id", F.md5(text.accent_strip("text")).alias("folded_md5"))


@register("f04_token_normalize", """
SELECT conv_id, turn, md5(regexp_replace(translate(lower(trim(text)), 'áéíóúñü', 'aeiounu'), '[^a-z0-9]', '', 'g')) AS token_md5
FROM conversations""")
def f04(spark, d):
    return T(spark, d).conversations.select("conv_id", "turn", F.md5(text.token_normalize("text")).alias("token_md5"))


@register("f05_safe_parse", O.rounded("""
SELECT event_id, TRY_CAST(nullif(trim(k), '') AS DOUBLE) AS k_float,
       CAST(trunc(TRY_CAST(nullif(trim(k), '') AS DOUBLE)) AS INT) AS k_int,
       nullif(trim(event_type), '') AS event_type
FROM (SELECT event_id, event_type, CASE WHEN event_id % 10 = 0 THEN ' ' WHEN event_id % 10 = 1 THEN 'x'
                                        ELSE regexp_extract(props, ':\\s*([0-9.]+)', 1) END AS k FROM events) e""",
      ["k_float"]))
def f05(spark, d):
    e = T(spark, d).events
    k = (F.when(F.col("event_id") % 10 == 0, F.lit(" ")).when(F.col("event_id") % 10 == 1, F.lit("x"))
          .otherwise(F.regexp_extract("props", r":\s*([0-9.]+)", 1)))
    e = e.select("event_id", "event_type", k.alias("k"))
    return e.select("event_id", numbers.safe_float("k").alias("k_float"), numbers.safe_int("k").alias("k_int"),
                    text.safe_str("event_type").alias("event_type"))


@register("f06_sentinel_null", O.rounded(O.sql("""
SELECT school_id, CASE WHEN math_pct >= 0 AND math_pct NOT IN (-666666666, -999999999) THEN math_pct END AS math_pct
FROM schools""", "schools"), ["math_pct"]))
def f06(spark, d):
    s = bindings.schools(T(spark, d))
    return s.select("school_id", numbers.sentinel_null("math_pct").alias("math_pct"))


@register("f07_locale_number", O.rounded("""
SELECT o_orderkey, s, CASE WHEN s LIKE '%.%' AND s LIKE '%,%' THEN TRY_CAST(replace(replace(s, '.', ''), ',', '.') AS DOUBLE)
                           WHEN s LIKE '%,%' THEN TRY_CAST(replace(s, ',', '.') AS DOUBLE)
                           WHEN regexp_matches(s, '^-?\\d{1,3}(\\.\\d{3})+$') THEN TRY_CAST(replace(s, '.', '') AS DOUBLE)
                           ELSE TRY_CAST(s AS DOUBLE) END AS value,
       CASE WHEN regexp_matches(replace(replace(s, '.', ''), ',', ''), '^\\d+$')
            THEN TRY_CAST(replace(replace(s, '.', ''), ',', '') AS BIGINT) END AS count_value
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
                              WHEN o_orderkey % 3 = 1 THEN replace(CAST(round(o_totalprice, 2) AS VARCHAR), '.', ',')
                              ELSE concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR), '.',
                                          lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0')) END AS s
      FROM orders) o""", ["value"]))
def f07(spark, d):
    o = T(spark, d).orders
    whole = F.floor("o_totalprice").cast("bigint")
    s = (F.when(F.col("o_orderkey") % 3 == 0, whole.cast("string"))
          .when(F.col("o_orderkey") % 3 == 1, F.regexp_replace(F.round("o_totalprice", 2).cast("string"), r"\.", ","))
          .otherwise(F.concat(F.floor(F.col("o_totalprice") / 1000).cast("bigint").cast("string"), F.lit("."),
                              F.lpad((whole % 1000).cast("string"), 3, "0"))))
    o = o.select("o_orderkey", s.alias("s"))
    return o.select("o_orderkey", "s", numbers.locale_number("s").alias("value"),
                    numbers.parse_count("s").alias("count_value"))


@register("f08_bool_decode", """
SELECT doc_id, CASE WHEN lower(trim(q)) IN ('1','yes','true','y') THEN true
                    WHEN lower(trim(q)) IN ('0','no','false','n') THEN false END AS quality_flag
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CAST(quality AS VARCHAR)
                          WHEN doc_id % 3 = 1 THEN CASE WHEN quality = 1 THEN 'Yes' ELSE 'no' END
                          ELSE CASE WHEN toxic = 1 THEN 'maybe' ELSE 'TRUE' END END AS q FROM labels) l""")
def f08(spark, d):
    l = T(spark, d).labels
    q = (F.when(F.col("doc_id") % 3 == 0, F.col("quality").cast("string"))
          .when(F.col("doc_id") % 3 == 1, F.when(F.col("quality") == 1, "Yes").otherwise("no"))
          .otherwise(F.when(F.col("toxic") == 1, "maybe").otherwise("TRUE")))
    return l.select("doc_id", numbers.bool_decode(q).alias("quality_flag"))


@register("f09_grade_format", """
WITH g AS (SELECT p_partkey, CAST(p_size % 15 - 3 AS VARCHAR) AS lo, CASE WHEN p_partkey % 7 = 0 THEN 'PK' WHEN p_partkey % 7 = 1 THEN 'K'
                                                       ELSE CAST(p_size % 13 AS VARCHAR) END AS hi FROM part),
f AS (SELECT p_partkey,
        CASE WHEN upper(trim(lo)) IN ('', '-1', '-2', '-3', 'NA', 'N/A') THEN NULL WHEN upper(trim(lo)) IN ('KG','K') THEN 'KG'
             WHEN upper(trim(lo)) IN ('PK','PRE') THEN 'PK' WHEN CAST(lo AS INT) < 0 THEN NULL WHEN CAST(lo AS INT) = 0 THEN 'KG'
             ELSE lpad(CAST(CAST(lo AS INT) AS VARCHAR), 2, '0') END AS flo,
        CASE WHEN upper(trim(hi)) IN ('', '-1', '-2', '-3', 'NA', 'N/A') THEN NULL WHEN upper(trim(hi)) IN ('KG','K') THEN 'KG'
             WHEN upper(trim(hi)) IN ('PK','PRE') THEN 'PK' WHEN CAST(hi AS INT) < 0 THEN NULL WHEN CAST(hi AS INT) = 0 THEN 'KG'
             ELSE lpad(CAST(CAST(hi AS INT) AS VARCHAR), 2, '0') END AS fhi FROM g)
SELECT p_partkey, CASE WHEN flo IS NOT NULL AND fhi IS NOT NULL THEN concat(flo, '-', fhi) ELSE coalesce(flo, fhi) END AS grade_levels
FROM f""")
def f09(spark, d):
    p = T(spark, d).part
    lo = (F.col("p_size") % 15 - 3).cast("string")
    hi = (F.when(F.col("p_partkey") % 7 == 0, "PK").when(F.col("p_partkey") % 7 == 1, "K")
           .otherwise((F.col("p_size") % 13).cast("string")))
    return p.select("p_partkey", labels.grade_levels(lo, hi).alias("grade_levels"))


@register("f10_zip_pad", """
SELECT c_custkey, substr(lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0'), 1, 5) AS zip,
       substr(lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), 1, 2) AS state_fips FROM customer""")
def f10(spark, d):
    c = T(spark, d).customer
    return c.select("c_custkey", numbers.zip_pad(F.col("c_custkey") % 100000).alias("zip"),
                    numbers.zip_pad("c_nationkey", 2).alias("state_fips"))


@register("f11_date_parse", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderdate + INTERVAL 20 YEAR AS DATE)
                        ELSE CAST(o_orderdate AS DATE) END AS listing_date FROM orders""")
def f11(spark, d):
    o = T(spark, d).orders
    ep = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    raw = (F.when(F.col("o_orderkey") % 4 == 0, ep.cast("string"))
            .when(F.col("o_orderkey") % 4 == 1,  # milliseconds, which the rule recognises above 1e12 (after 2001)
                  (F.unix_timestamp(F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 20 YEARS")) * 1000).cast("string"))
            .when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "MM/dd/yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")))
    return o.select("o_orderkey", dates.parse_listing_date(raw).alias("listing_date"))


@register("f12_date_math", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) + 1 AS next_day,
       CAST(CAST(l_shipdate AS DATE) - INTERVAL 5 YEAR AS DATE) AS five_years_back,
       make_date(year(l_shipdate), 12, 31) AS year_end, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
       CAST(year(l_shipdate) AS INT) AS yr
FROM lineitem""")
def f12(spark, d):
    l = T(spark, d).lineitem
    sd = F.col("l_shipdate").cast("date")
    return l.select("l_orderkey", "l_linenumber", F.date_add(sd, 1).alias("next_day"),
                    F.add_months(sd, -60).alias("five_years_back"), dates.year_end(F.year(sd)).alias("year_end"),
                    dates.month_start(sd).alias("month_start"), F.year(sd).alias("yr"))


_MES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre",
        "noviembre", "diciembre"]


@register("f13_month_name", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN CAST(month(l_shipdate) AS INT) END AS month_from_name,
       CASE WHEN l_linenumber % 2 = 1 THEN CAST(month(l_shipdate) AS INT) END AS month_from_number
FROM lineitem""")
def f13(spark, d):
    l = T(spark, d).lineitem
    name = F.element_at(F.array(*[F.lit(m.upper() if i % 2 else m.capitalize()) for i, m in enumerate(_MES)]),
                        F.month("l_shipdate"))
    num = F.month("l_shipdate").cast("string")
    even = F.col("l_linenumber") % 2 == 0
    return l.select("l_orderkey", "l_linenumber",
                    F.when(even, labels.month_number(name)).alias("month_from_name"),
                    F.when(~even, labels.month_number(num)).alias("month_from_number"))


@register("f14_area_convert", O.rounded(O.sql("""
SELECT listing_id, seq, area_sqft / 10.7639e0 AS area_m2, (area_sqft / 10.7639e0) * 10.7639e0 AS area_sqft_back
FROM listings_raw""", "listings_raw"), ["area_m2", "area_sqft_back"]))
def f14(spark, d):
    r = bindings.listings(T(spark, d))
    m2 = F.col("area_sqft") / numbers.SQFT_PER_M2
    return r.select("listing_id", "seq", m2.alias("area_m2"), numbers.m2_to_sqft(m2).alias("area_sqft_back"))


@register("f15_fx_convert", O.sql("""
SELECT listing_id, seq, CAST(trunc(CAST(price_usd AS DOUBLE) * fx_rate) AS BIGINT) AS price_cop,
       CAST(trunc(CAST(trunc(CAST(price_usd AS DOUBLE) * fx_rate) AS DOUBLE) / fx_rate) AS BIGINT) AS price_usd_back
FROM listings_raw CROSS JOIN fx_latest""", "listings_raw", "fx_latest"))
def f15(spark, d):
    t = T(spark, d)
    r = bindings.listings(t).crossJoin(F.broadcast(latest_fx(bindings.fx(t))))  # one-row side
    cop = numbers.usd_to_cop("price_usd", "fx_rate")
    return r.select("listing_id", "seq", cop.alias("price_cop"), numbers.cop_to_usd(cop, "fx_rate").alias("price_usd_back"))


@register("f16_price_per_area", O.rounded(O.sql("""
SELECT listing_id, seq, CASE WHEN area_sqft > 0 THEN CAST(price_usd AS DOUBLE) / area_sqft END AS price_per_sqft_usd
FROM listings_raw""", "listings_raw"), ["price_per_sqft_usd"]))
def f16(spark, d):
    r = bindings.listings(T(spark, d))
    return r.select("listing_id", "seq", numbers.price_per_area("price_usd", "area_sqft").alias("price_per_sqft_usd"))


_REF = "(SELECT 4.711e0 AS lat, -74.0721e0 AS lon)"


@register("f17_haversine", O.rounded(O.sql(f"""
SELECT c.geo_id, {geo.haversine_sql('r', 'c')} AS dist_km, {geo.haversine_sql('r', 'c', geo.EARTH_RADIUS_MI)} AS dist_mi
FROM centroids c CROSS JOIN {_REF} r""", "centroids"), ["dist_km", "dist_mi"], 4))
def f17(spark, d):
    c = bindings.centroids(T(spark, d))
    return c.select("geo_id", geo.haversine(F.lit(4.711), F.lit(-74.0721), "lat", "lon").alias("dist_km"),
                    geo.haversine_miles(F.lit(4.711), F.lit(-74.0721), "lat", "lon").alias("dist_mi")) \
            .select("geo_id", F.round("dist_km", 4).alias("dist_km"), F.round("dist_mi", 4).alias("dist_mi"))


@register("f18_minmax_scale", O.rounded("""
SELECT c_custkey, (c_acctbal - lo) / greatest(hi - lo, 1e0) * 1e2 AS balance_score,
       1e2 - (c_acctbal - lo) / greatest(hi - lo, 1e0) * 1e2 AS balance_score_inv
FROM customer CROSS JOIN (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) s""",
    ["balance_score", "balance_score_inv"]))
def f18(spark, d):
    c = T(spark, d).customer.select("c_custkey", "c_acctbal")
    out = scale.minmax_scale(c, [("c_acctbal", "balance_score", False), ("c_acctbal", "balance_score_inv", True)])
    return out.select("c_custkey", "balance_score", "balance_score_inv")


@register("f19_weighted_sum", O.sql("""
SELECT country_code, city, grocery_count * 3 + transit_stop_count * 3 + park_count * 2 + hospital_count * 1 AS amenity_weighted
FROM amenity_counts""", "amenity_counts"))
def f19(spark, d):
    from .silver import amenity_city_counts
    a = amenity_city_counts(bindings.amenities(T(spark, d)))
    return a.select("country_code", "city", scoring.weighted_sum(scoring.AMENITY_WEIGHTS, default=0).alias("amenity_weighted"))


@register("f20_clamp_0_100", O.rounded("""
SELECT c_custkey, CASE WHEN c_acctbal / 1e2 < 0 THEN 0e0 WHEN c_acctbal / 1e2 > 100 THEN 1e2 ELSE c_acctbal / 1e2 END AS clamped
FROM customer""", ["clamped"]))
def f20(spark, d):
    c = T(spark, d).customer
    return c.select("c_custkey", scoring.clamp_0_100(F.col("c_acctbal") / 100.0).alias("clamped"))


@register("f21_mean_of_two", O.rounded(O.sql("""
SELECT school_id, CASE WHEN math_pct IS NOT NULL OR reading_pct IS NOT NULL
                       THEN (coalesce(math_pct, 0e0) + coalesce(reading_pct, 0e0)) / 2e0 END AS score_gold,
       (coalesce(math_pct, 0e0) + coalesce(reading_pct, 0e0)) / 2e0 AS score_silver
FROM schools""", "schools"), ["score_gold", "score_silver"]))
def f21(spark, d):
    s = bindings.schools(T(spark, d))
    return s.select("school_id", scoring.mean_of_two("math_pct", "reading_pct", True).alias("score_gold"),
                    scoring.mean_of_two("math_pct", "reading_pct", False).alias("score_silver"))


@register("f22_ratio_pct", O.rounded("""
SELECT c_nationkey, CASE WHEN count(*) <> 0 THEN 1e2 * count(*) FILTER (WHERE c_mktsegment = 'BUILDING') / count(*) END AS pct_building,
       CASE WHEN sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) <> 0
            THEN 1e2 * count(*) / sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) END AS ratio_to_negative
FROM customer GROUP BY 1""", ["pct_building", "ratio_to_negative"]))
def f22(spark, d):
    c = T(spark, d).customer
    g = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"),
                                    F.count(F.when(F.col("c_mktsegment") == "BUILDING", 1)).alias("b"),
                                    F.sum(F.when(F.col("c_acctbal") < 0, 1).otherwise(0)).alias("neg"))
    return g.select("c_nationkey", numbers.ratio_pct("b", "n").alias("pct_building"),
                    numbers.ratio_pct("n", "neg").alias("ratio_to_negative"))


@register("f23_months_of_supply", O.rounded(O.sql("""
SELECT country_code, city, zip_or_municipio, date,
       CASE WHEN homes_sold IS NOT NULL AND homes_sold > 0 AND inventory_count IS NOT NULL
            THEN CAST(inventory_count AS DOUBLE) / CAST(homes_sold AS DOUBLE) END AS months_of_supply
FROM market_raw""", "market_raw"), ["months_of_supply"]))
def f23(spark, d):
    m = bindings.market(T(spark, d))
    return m.select("country_code", "city", "zip_or_municipio", "date",
                    numbers.months_of_supply("inventory_count", "homes_sold").alias("months_of_supply"))


@register("f24_discount_pct", O.rounded(O.sql("""
SELECT l.listing_id, l.seq, (m.mp - l.price_usd) / m.mp * 1e2 AS discount_pct
FROM listings_raw l JOIN (SELECT country_code, city, zip_or_municipio, median(price_usd) AS mp FROM listings_raw GROUP BY 1, 2, 3) m
  ON l.country_code = m.country_code AND l.city = m.city AND l.zip_or_municipio = m.zip_or_municipio""",
    "listings_raw"), ["discount_pct"]))
def f24(spark, d):
    r = bindings.listings(T(spark, d))
    keys = ["country_code", "city", "zip_or_municipio"]
    m = median.exact_median(r, keys, "price_usd", "mp")
    return r.join(m, keys).select("listing_id", "seq", numbers.discount_pct("mp", "price_usd").alias("discount_pct"))


@register("f25_score_from_measure", O.rounded(O.sql("""
SELECT point_id, least(pga / 0.5e0, 1e0) AS pga_score FROM grid""", "grid"), ["pga_score"]))
def f25(spark, d):
    g = bindings.grid(T(spark, d))
    return g.select("point_id", numbers.score_from_measure("pga", 0.5).alias("pga_score"))


@register("f26_annuity_price", O.rounded("""
SELECT c_custkey, CASE WHEN r <= 0 THEN pmt * 360 ELSE pmt / r * (1e0 - pow(1e0 + r, -360e0)) END + dp AS max_price_usd
FROM (SELECT c_custkey, abs(c_acctbal) * 20e0 * 0.28e0 / 12e0 AS pmt, CAST(c_nationkey % 9 AS DOUBLE) / 1e2 / 12e0 AS r,
             CAST(c_custkey % 5 AS DOUBLE) * 1e4 AS dp FROM customer) b""", ["max_price_usd"], 2))
def f26(spark, d):
    c = T(spark, d).customer
    b = c.select("c_custkey", (F.abs("c_acctbal") * 20.0).alias("income"), (F.col("c_nationkey") % 9).cast("double").alias("rate"),
                 ((F.col("c_custkey") % 5).cast("double") * 1e4).alias("dp"))
    return b.select("c_custkey", F.round(numbers.max_affordable_price("income", "rate", "dp"), 2).alias("max_price_usd"))


@register("f27_crime_category", O.sql("""
SELECT city, country_code, crime_type, "count", period_year, period_month,
  CASE WHEN raw = '' THEN 'other'
       WHEN raw LIKE '%homicid%' OR raw LIKE '%lesion%' OR raw LIKE '%secuestr%' OR raw LIKE '%violenc%'
         OR raw LIKE '%violacion%' OR raw LIKE '%feminicid%' OR raw LIKE '%delitos sexuales%' OR raw LIKE '%sexual%' THEN 'violent'
       WHEN raw LIKE '%hurto%' AND (raw LIKE '%violen%' OR raw LIKE '%con violencia%' OR raw LIKE '%violento%') THEN 'violent'
       WHEN raw LIKE '%hurto%' OR raw LIKE '%robo%' OR raw LIKE '%dano%' OR raw LIKE '%abigeato%' OR raw LIKE '%piracy%'
         OR raw LIKE '%pirateria%' THEN 'property'
       ELSE 'other' END AS category_es,
  CASE WHEN lower(trim(crime_type)) IN ('assault','robbery','shooting','homicide') THEN 'violent'
       WHEN lower(trim(crime_type)) IN ('burglary','theft','vandalism','arson') THEN 'property' ELSE 'other' END AS category_incident,
  CASE WHEN lower(crime_type) IN ('homicide','rape','robbery','aggravated-assault') THEN 'violent'
       WHEN lower(crime_type) IN ('burglary','larceny','motor-vehicle-theft') THEN 'property' ELSE 'other' END AS category_fbi
FROM (SELECT *, translate(lower(trim(crime_type)), 'áéíóúñü', 'aeiounu') AS raw FROM crime) c""", "crime"))
def f27(spark, d):
    c = bindings.crime(T(spark, d))
    return c.select("*", labels.crime_category_spanish("crime_type").alias("category_es"),
                    labels.crime_category_incident("crime_type").alias("category_incident"),
                    labels.crime_category_fbi("crime_type").alias("category_fbi"))


_SECTORS = "CASE p_partkey % 5 WHEN 0 THEN 'No Oficial' WHEN 1 THEN 'OFICIAL' WHEN 2 THEN 'Privado' WHEN 3 THEN 'Público' ELSE ' ' END"


@register("f28_sector_type", f"""
SELECT p_partkey, CASE WHEN t = '' THEN NULL
                       WHEN t LIKE '%nooficial%' OR t LIKE '%privad%' OR t LIKE '%particular%' THEN 'privado'
                       WHEN t LIKE '%oficial%' OR t LIKE '%publico%' OR t LIKE '%estatal%' THEN 'oficial' END AS school_type
FROM (SELECT p_partkey, regexp_replace(translate(lower(trim({_SECTORS})), 'áéíóúñü', 'aeiounu'), '[^a-z0-9]', '', 'g') AS t
      FROM part) p""")
def f28(spark, d):
    p = T(spark, d).part
    k = F.col("p_partkey") % 5
    raw = (F.when(k == 0, "No Oficial").when(k == 1, "OFICIAL").when(k == 2, "Privado").when(k == 3, "Público")
            .otherwise(" "))
    return p.select("p_partkey", labels.school_sector_type(raw).alias("school_type"))


@register("f29_title_type", """
SELECT page_id, CASE WHEN t LIKE '%apartamento%' OR t LIKE '%apto%' THEN 'apartamento' WHEN t LIKE '%casa%' THEN 'casa' END AS property_type
FROM (SELECT page_id, translate(lower(trim(html)), 'áéíóúñü', 'aeiounu') AS t FROM pages) p""")
def f29(spark, d):
    p = T(spark, d).pages
    return p.select("page_id", labels.title_property_type("html").alias("property_type"))


@register("f30_subject_fold", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN s IN ('math','mathematics') THEN 'math' WHEN s IN ('read','reading','ela','english') THEN 'reading' END AS subject
FROM (SELECT l_orderkey, l_linenumber, lower(trim(CASE l_linenumber WHEN 1 THEN 'Math' WHEN 2 THEN 'mathematics ' WHEN 3 THEN 'ELA'
                                       WHEN 4 THEN 'Reading' WHEN 5 THEN 'english' ELSE 'science' END)) AS s FROM lineitem) l""")
def f30(spark, d):
    l = T(spark, d).lineitem
    n = F.col("l_linenumber")
    raw = (F.when(n == 1, "Math").when(n == 2, "mathematics ").when(n == 3, "ELA").when(n == 4, "Reading")
            .when(n == 5, "english").otherwise("science"))
    return l.select("l_orderkey", "l_linenumber", labels.subject_fold(raw).alias("subject"))


@register("f31_first_comma_segment", """
SELECT conv_id, turn, md5(nullif(trim(split_part(text, ',', 1)), '')) AS barrio_md5 FROM conversations""")
def f31(spark, d):
    c = T(spark, d).conversations
    return c.select("conv_id", "turn", F.md5(text.first_comma_segment("text")).alias("barrio_md5"))


@register("f32_filename_slug", """
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(stem), '\\.[a-z0-9]+$', ''),
                 '^[a-z]+[_\\-]', ''), '[0-9]+', '', 'g'), '[_\\-\\s]+', '_', 'g'), '^_+|_+$', '', 'g') AS crime_slug
FROM (SELECT page_id, concat('policia_', regexp_extract(url, '//([a-z.]+)', 1), '_hurto-', CAST(page_id AS VARCHAR), '.csv') AS stem
      FROM pages) p""")
def f32(spark, d):
    p = T(spark, d).pages
    stem = F.concat(F.lit("policia_"), F.regexp_extract("url", r"//([a-z.]+)", 1), F.lit("_hurto-"),
                    F.col("page_id").cast("string"), F.lit(".csv"))
    return p.select("page_id", text.filename_slug(stem).alias("crime_slug"))


@register("f33_temp_mean", O.rounded(O.sql("""
SELECT country_code, city, date, (temp_max_c + temp_min_c) / 2e0 AS temp_mean_c FROM weather""", "weather"),
    ["temp_mean_c"]))
def f33(spark, d):
    w = bindings.weather(T(spark, d))
    return w.select("country_code", "city", "date", scoring.temp_mean("temp_max_c", "temp_min_c").alias("temp_mean_c"))


@register("f34_json_text", """
SELECT doc_id, CAST(length(text) AS INT) AS n_chars,
       json_extract_string(to_json({'doc_id': doc_id, 'text': text}), '$.text') AS evidence_text, CAST(doc_id AS VARCHAR) AS evidence_id
FROM documents""")
def f34(spark, d):
    docs = T(spark, d).documents
    ev = F.to_json(F.struct("doc_id", "text"))                       # whole texts; read back from the JSON text
    return docs.select("doc_id", F.length("text").alias("n_chars"), F.get_json_object(ev, "$.text").alias("evidence_text"),
                       F.get_json_object(ev, "$.doc_id").alias("evidence_id"))


@register("f35_json_object_extract", O.sql("""
SELECT conv_id, turn, json_extract_string(nullif(regexp_extract(regexp_replace(wrapped, '```(json)?', '', 'g'), '(?s)(\\{.*\\})', 1), ''),
                                         '$.intent') AS intent
FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN concat('```json\n', plan_json, '\n```')
                                 ELSE concat('Here is the plan: ', plan_json, ' thanks') END AS wrapped FROM plans) p""",
    "plans"))
def f35(spark, d):
    p = bindings.plans(T(spark, d))
    wrapped = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("```json\n"), "plan_json", F.lit("\n```"))) \
               .otherwise(F.concat(F.lit("Here is the plan: "), "plan_json", F.lit(" thanks")))
    obj = text.json_object_text(wrapped)
    return p.select("conv_id", "turn", F.get_json_object(obj, "$.intent").alias("intent"))


@register("f36_nullish", """
SELECT c_custkey, CASE WHEN lower(trim(v)) IN ('null','none','n/a','na','unknown','not specified','') THEN NULL ELSE trim(v) END AS segment
FROM (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN ' unknown ' WHEN 2 THEN '' WHEN 3 THEN 'Not Specified'
                                          ELSE concat(' ', c_mktsegment) END AS v FROM customer) c""")
def f36(spark, d):
    c = T(spark, d).customer
    k = F.col("c_custkey") % 6
    v = (F.when(k == 0, "N/A").when(k == 1, " unknown ").when(k == 2, "").when(k == 3, "Not Specified")
          .otherwise(F.concat(F.lit(" "), "c_mktsegment")))
    return c.select("c_custkey", text.nullish(v).alias("segment"))


@register("f37_city_canonical", """
SELECT c_custkey, concat(upper(left(t, 1)), lower(substr(t, 2))) AS city FROM
 (SELECT c_custkey, translate(lower(trim(concat('BOGOTÁ', CAST(c_nationkey AS VARCHAR)))), 'áéíóúñü', 'aeiounu') AS t FROM customer) c""")
def f37(spark, d):
    c = T(spark, d).customer
    return c.select("c_custkey", text.city_canonical(F.concat(F.lit("BOGOTÁ"), F.col("c_nationkey").cast("string"))).alias("city"))


@register("f38_row_to_iso", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS order_ts_iso, CAST(o_totalprice AS DOUBLE) AS total
FROM orders""")
def f38(spark, d):
    o = T(spark, d).orders
    return o.select("o_orderkey", dates.to_iso("o_orderdate").alias("order_ts_iso"), F.col("o_totalprice").cast("double").alias("total"))
