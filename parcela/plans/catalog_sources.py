"""Registered source queries (s01-s24).

Landed payloads are produced in-plan from the driver's tables (``to_json`` of
grouped rows, CSV files written to the scratch folder), then parsed by the
library parsers; the oracle computes the same rows straight from the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..operators import unpivot
from ..session import scratch_path
from ..sources import bindings, delimited, html, payloads
from ..sources.tables import Tables, guarded_scan
from .catalog import O, register


def Tb(spark, d) -> Tables:
    return Tables.shared(spark, d)


def _scratch(spark, name):
    return scratch_path(spark, f"{name}_{uuid.uuid4().hex}")


@register("s01_table_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def s01(spark, d):
    return spark.read.parquet(Tb(spark, d).path("lineitem")).select("l_orderkey", "l_linenumber", "l_quantity")


@register("s02_guarded_scan", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_comment FROM orders""")
def s02(spark, d):
    sch = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                        T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_comment", T.StringType())])
    t = Tb(spark, d)
    have = guarded_scan(spark, t.path("orders"), sch)
    missing = guarded_scan(spark, t.path("no_such_table"), sch)
    return have.unionByName(missing)


@register("s03_csv_scan", O.rounded(O.sql("SELECT * FROM grid", "grid"), ["lat", "lon", "pga"]))
def s03(spark, d):
    g = bindings.grid(Tb(spark, d))
    path = _scratch(spark, "s03_grid_csv")
    g.write.option("header", True).csv(path)
    sch = T.StructType([T.StructField("point_id", T.LongType()), T.StructField("lat", T.DoubleType()),
                        T.StructField("lon", T.DoubleType()), T.StructField("pga", T.DoubleType())])
    return delimited.read_csv(spark, path, sch)


_CRIME_ORACLE = O.sql('SELECT city, country_code, crime_type, "count", period_year, period_month FROM crime', "crime")


def _crime_typed(df):
    return df.select("city", "country_code", "crime_type", F.col("count").cast("int").alias("count"),
                     F.col("period_year").cast("int").alias("period_year"),
                     F.col("period_month").cast("int").alias("period_month"))


@register("s04_delimiter_sniff", _CRIME_ORACLE)
def s04(spark, d):
    c = bindings.crime(Tb(spark, d))
    path = _scratch(spark, "s04_crime_mixed")                       # files of two separators and two encodings
    us = F.col("country_code") == "US"
    c.where(us).write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(f"{path}/a")
    c.where(~us).write.option("header", True).csv(f"{path}/b")
    return _crime_typed(delimited.read_sniffed(spark, f"{path}/*"))


_HEADER_CANDIDATES = {"city": ["municipio", "ciudad", "city"], "country_code": ["pais", "country"],
                      "crime_type": ["delito", "tipo_delito", "crime_type"], "count": ["casos", "cantidad", "total"],
                      "period_year": ["año", "anio", "year"], "period_month": ["mes", "month"]}


@register("s05_header_resolution", _CRIME_ORACLE)
def s05(spark, d):
    c = bindings.crime(Tb(spark, d)).toDF("Municipio ", "PAÍS", "Delito", "Cantidad de casos", "Año", "MES")
    path = _scratch(spark, "s05_crime_headers")
    c.write.option("header", True).csv(path)
    raw = delimited.read_csv(spark, path)
    return _crime_typed(delimited.resolve_columns(raw, _HEADER_CANDIDATES))


@register("s06_file_routing", O.sql("""
SELECT city, crime_type, "count", CASE WHEN country_code = 'US' THEN 'policia' ELSE 'dane' END AS route,
       CASE WHEN country_code = 'US' THEN 2021 ELSE 2022 END AS file_year FROM crime""", "crime"))
def s06(spark, d):
    c = bindings.crime(Tb(spark, d)).select("city", "country_code", "crime_type", "count")
    landing = _scratch(spark, "s06_landing")
    # a landed file of many parts is a folder of its name; the last one has no route
    for cc, fname in (("US", "policia_hurtos_2021.csv"), ("CO", "dane_delitos_2022.csv"), ("CO", "otros_2020.csv")):
        c.filter(F.col("country_code") == cc).drop("country_code").write.option("header", True).csv(f"{landing}/{fname}")
    raw = delimited.read_csv(spark, f"{landing}/*")
    routed = delimited.with_file_routing(raw, {"policia": "policia", "dane": "dane"})
    return routed.select("city", "crime_type", F.col("count").cast("int").alias("count"), "route", "file_year")


def listing_pages(o):
    """Landed pages of listings, of the orders ``o``."""
    ok = F.col("o_orderkey")
    item = F.struct(
        F.when(ok % 2 == 0, ok.cast("string")).alias("zpid"), F.when(ok % 2 == 1, ok.cast("string")).alias("listingId"),
        F.when(ok % 3 == 0, F.col("o_totalprice").cast("string")).alias("price"),
        F.when(ok % 3 != 0, F.format_string("%.2f", F.col("o_totalprice"))).alias("listPrice"),
        (F.lit(300) + ok % 2000).cast("string").alias("livingArea"), (ok % 50).alias("yearBuilt"),
        F.element_at(F.array(*[F.lit(x) for x in ("condo", "SINGLE_FAMILY", "Manufactured", "LOT")]), (ok % 4 + 1).cast("int")).alias("homeType"),
        (ok % 6).cast("string").alias("bedrooms"),
        F.when(ok % 7 == 0, F.lit("FOR_RENT")).when(ok % 7 == 1, F.lit("FOR_SALE")).alias("statusType"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("listingDate"),
        F.concat(F.lit("Z"), (F.col("o_custkey") % 7).cast("string")).alias("zipcode"))
    # few orders share a page: the orders are shuffled, not lists of items that hold one each
    placed = o.withColumn("page", (ok / 1000).cast("long")).repartition("o_custkey", "page")
    grp = placed.groupBy("o_custkey", "page").agg(F.collect_list(item).alias("items"))
    payload = (F.when(F.col("o_custkey") % 3 == 0, F.to_json(F.struct(F.col("items").alias("results"))))
                .when(F.col("o_custkey") % 3 == 1, F.to_json(F.struct(F.struct(F.col("items").alias("listings")).alias("data"),
                                                                      F.struct(F.lit(9).alias("total_pages")).alias("pagination"))))
                .when(F.col("o_custkey") % 2 == 0, F.to_json(F.col("items")))
                .otherwise(F.to_json(F.struct(F.col("items").alias("data")))))
    return grp.select("o_custkey", payload.alias("payload"))


@register("s07_json_listing_explode", """
SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS listing_id, CAST(trunc(o_totalprice) AS BIGINT) AS price_usd,
       CAST(o_orderkey % 6 AS INT) AS bedrooms, CAST(300 + o_orderkey % 2000 AS INT) AS sqft, CAST(o_orderdate AS DATE) AS listing_date,
       concat('Z', CAST(o_custkey % 7 AS VARCHAR)) AS zip,
       CASE o_orderkey % 4 WHEN 0 THEN 'condo' WHEN 1 THEN 'single_family' WHEN 2 THEN 'single_family' END AS property_type,
       CAST(o_orderkey % 50 AS VARCHAR) AS year_built_of_page, CASE WHEN o_custkey % 3 = 1 THEN '9' END AS pages
FROM orders WHERE o_orderkey % 7 <> 0""")
def s07(spark, d):
    pages = listing_pages(Tb(spark, d).orders).withColumn("page_id", F.sha2("payload", 256))
    out = payloads.parse_listing_pages(pages, "payload", keep=["o_custkey", "page_id"]).drop("raw_json")
    # the landed page is kept once, under its digest: what no rule names is read from it, page by page, and joined by key
    entry = F.lit('(?:zpid|listingId)":"([^"]*)"[^}]*?"yearBuilt":(\\d+)')
    found = F.arrays_zip(*[F.regexp_extract_all("payload", entry, F.lit(i)).alias(c) for i, c in ((1, "listing_id"), (2, "built"))])
    facts = pages.select("page_id", F.get_json_object("payload", "$.pagination.total_pages").alias("pages"), F.explode(found).alias("x"))
    facts = facts.select("page_id", "pages", F.col("x.listing_id").alias("listing_id"), F.col("x.built").alias("year_built_of_page"))
    return out.join(facts, ["page_id", "listing_id"]).select("o_custkey", "listing_id", "price_usd", "bedrooms", "sqft", "listing_date", "zip", "property_type",
                                                            "year_built_of_page", "pages")


@register("s08_json_parallel_arrays", O.rounded(O.sql(f"""
SELECT country_code, city, date, temp_max_c, temp_min_c, precipitation_mm,
       CASE WHEN city IN ('NATION_1', 'NATION_2') THEN NULL ELSE wind_speed_max_kmh END AS wind_speed_max_kmh,
       (temp_max_c + temp_min_c) / 2e0 AS temp_mean_c,
       (coalesce(precipitation_mm > 50, false) OR coalesce(CASE WHEN city IN ('NATION_1', 'NATION_2') THEN NULL ELSE wind_speed_max_kmh END > 80, false)
        OR coalesce(temp_max_c > 38, false) OR coalesce(temp_min_c < -15, false)) AS is_extreme_day
FROM weather""", "weather"), ["temp_max_c", "temp_min_c", "precipitation_mm", "wind_speed_max_kmh", "temp_mean_c"]))
def s08(spark, d):
    w = bindings.weather(Tb(spark, d))
    s = F.sort_array(F.collect_list(F.struct("date", "temp_max_c", "temp_min_c", "precipitation_mm", "wind_speed_max_kmh")))
    g = w.groupBy("country_code", "city", F.trunc("date", "month").alias("_month")).agg(s.alias("days"))  # one payload per month
    daily = F.struct(F.transform("days", lambda x: F.date_format(x["date"], "yyyy-MM-dd")).alias("time"),
                     F.transform("days", lambda x: x["temp_max_c"].cast("string")).alias("temperature_2m_max"),
                     F.transform("days", lambda x: x["temp_min_c"].cast("string")).alias("temperature_2m_min"),
                     F.transform("days", lambda x: x["precipitation_mm"].cast("string")).alias("precipitation_sum"),
                     F.when(~F.col("city").isin("NATION_1", "NATION_2"),
                            F.transform("days", lambda x: x["wind_speed_max_kmh"].cast("string"))).alias("windspeed_10m_max"))
    landed = g.select("country_code", "city", F.to_json(F.struct(daily.alias("daily"))).alias("payload"))
    out = payloads.parse_daily_arrays(landed, "payload", keep=["country_code", "city"])
    return out.drop("weather_code")


@register("s09_json_header_matrix", O.rounded(O.sql("""
SELECT country_code, zip_or_municipio, CAST(year AS VARCHAR) AS year, CAST(population AS VARCHAR) AS population,
       CASE WHEN median_income_usd < 0 THEN NULL ELSE CAST(median_income_usd AS VARCHAR) END AS median_income_usd,
       pct_homeowner
FROM demographics""", "demographics"), ["pct_homeowner"]))
def s09(spark, d):
    dm = bindings.demographics(Tb(spark, d))
    header = F.array(*[F.lit(x) for x in ["NAME", "B01003_001E", "B19013_001E", "HOMEOWN", "YEAR", "zip code tabulation area"]])
    row = F.array(F.col("zip_or_municipio"), F.col("population").cast("string"),
                  F.when(F.col("median_income_usd") < 0, F.lit("-666666666")).otherwise(F.col("median_income_usd").cast("string")),
                  F.col("pct_homeowner").cast("string"), F.col("year").cast("string"), F.col("zip_or_municipio"))
    page = F.col("zip_or_municipio")                              # a page holds the years of one zip
    g = dm.groupBy("country_code", page.alias("_page")).agg(F.collect_list(row).alias("rows"))
    landed = g.select("country_code", F.to_json(F.concat(F.array(header), F.col("rows"))).alias("payload"))
    out = payloads.parse_header_matrix(landed, "payload", {"zip_or_municipio": "zip code tabulation area", "year": "YEAR",
                                                           "population": "B01003_001E", "median_income_usd": "B19013_001E",
                                                           "pct_homeowner": "HOMEOWN"}, keep=["country_code"])
    return out.withColumn("pct_homeowner", F.col("pct_homeowner").cast("double"))


@register("s10_json_keyed_object", """
SELECT s_nationkey, concat('ORI', CAST(s_suppkey AS VARCHAR)) AS ori, s_name AS agency_name_city,
       CAST(s_acctbal AS VARCHAR) AS latitude FROM supplier""")
def s10(spark, d):
    s = Tb(spark, d).supplier
    rec = F.struct(F.col("s_name").alias("agency_name_city"), F.col("s_acctbal").cast("string").alias("latitude"))
    ori = F.concat(F.lit("ORI"), F.col("s_suppkey").cast("string"))
    g = s.groupBy("s_nationkey", (F.col("s_suppkey") / 1000).cast("long").alias("_page")).agg(
        F.collect_list(F.struct(ori.alias("ori"), rec.alias("r"))).alias("xs"))
    keyed = F.to_json(F.map_from_entries(F.transform("xs", lambda x: F.struct(x["ori"], x["r"]))))
    listed = F.to_json(F.transform("xs", lambda x: F.struct(x["ori"].alias("ori"), x["r"]["agency_name_city"].alias("agency_name_city"),
                                                           x["r"]["latitude"].alias("latitude"))))
    wrapped = F.to_json(F.struct(F.transform("xs", lambda x: F.struct(x["ori"].alias("ori"), x["r"]["agency_name_city"].alias("agency_name_city"),
                                                                     x["r"]["latitude"].alias("latitude"))).alias("results")))
    k = F.col("s_nationkey") % 3
    landed = g.select("s_nationkey", F.when(k == 0, keyed).when(k == 1, listed).otherwise(wrapped).alias("payload"))
    return payloads.parse_keyed_records(landed, "payload", ["agency_name_city", "latitude"], "ori", keep=["s_nationkey"])


@register("s11_json_nested_map_sum", """
SELECT l_suppkey, CAST(count(*) FILTER (WHERE year(l_shipdate) = 1995) AS DOUBLE) AS total FROM lineitem GROUP BY 1""")
def s11(spark, d):
    l = Tb(spark, d).lineitem
    per = l.groupBy("l_suppkey", "l_returnflag", F.year("l_shipdate").cast("string").alias("y")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    inner = per.groupBy("l_suppkey", "l_returnflag").agg(F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("years"))
    outer = inner.groupBy("l_suppkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "years"))).alias("actuals"))
    nested = F.to_json(F.struct(F.struct(F.col("actuals")).alias("offenses")))
    as_list = F.to_json(F.transform(F.filter(F.map_values("actuals"), lambda m: F.lit(True)),
                                    lambda m: F.struct(F.coalesce(F.element_at(m, F.lit("1995")), F.lit(0.0)).cast("string").alias("count"))))
    landed = outer.select("l_suppkey", F.when(F.col("l_suppkey") % 2 == 0, nested).otherwise(as_list).alias("payload"))
    return payloads.sum_year_counts(landed, "payload", "1995", keep=["l_suppkey"])


@register("s12_json_series", O.rounded("""
SELECT concat('LAU', CAST(n_nationkey AS VARCHAR)) AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
       round(avg(o_totalprice) / 1e4, 1) AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2""", ["value"]))
def s12(spark, d):
    t = Tb(spark, d)
    o, c, n = t.orders, t.customer, F.broadcast(t.nation)
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    m = j.groupBy("n_nationkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")) \
         .agg(F.round(F.avg("o_totalprice") / 1e4, 1).alias("v"))
    obs = F.struct(F.col("y").cast("string").alias("year"), F.format_string("M%02d", "m").alias("period"),
                   F.col("v").cast("string").alias("value"))
    s = m.groupBy("n_nationkey").agg(F.collect_list(obs).alias("data"))
    s = s.select(F.struct(F.concat(F.lit("LAU"), F.col("n_nationkey").cast("string")).alias("seriesID"),
                          F.concat("data", F.array(F.struct(F.lit("2024").alias("year"), F.lit("M13").alias("period"),
                                                            F.lit("9.9").alias("value")),
                                                   F.struct(F.lit("2024").alias("year"), F.lit("M01").alias("period"),
                                                            F.lit(".").alias("value")))).alias("data")).alias("series"))
    landed = s.select(F.to_json(F.struct(F.struct(F.array("series").alias("series")).alias("Results"))).alias("payload"))
    return payloads.parse_series(landed, "payload")


_ZONES = ["AE", "X", "VE", "X500", "AH12", "D"]


@register("s13_json_features", O.rounded(f"""
SELECT p_partkey, zone, CAST(p_partkey AS VARCHAR) AS area_id,
       CAST(p_size AS VARCHAR) AS other, CASE WHEN zone IN ('AE','A','AH','AO','V','VE') THEN 0.9e0 WHEN zone = 'X500' THEN 0.4e0 WHEN zone = 'X' THEN 0.1e0
            WHEN starts_with(zone, 'A') OR starts_with(zone, 'V') THEN 0.9e0 ELSE 0.5e0 END AS risk_score
FROM (SELECT p_partkey, p_size, list_extract([{', '.join(repr(z) for z in _ZONES)}], CAST(p_partkey % {len(_ZONES)} + 1 AS INT)) AS zone FROM part WHERE p_partkey % 13 <> 0) p""",
    ["risk_score"]))
def s13(spark, d):
    out = flood_features(spark, d)
    return out.select(F.col("area_id").cast("bigint").alias("p_partkey"), "zone", "area_id",
                      F.get_json_object("details_json", "$.OTHER").alias("other"), "risk_score")


def flood_features(spark, d):
    """Landed feature pages of the parts, parsed."""
    p = Tb(spark, d).part
    z = F.element_at(F.array(*[F.lit(v) for v in _ZONES]), (F.col("p_partkey") % len(_ZONES) + 1).cast("int"))
    attrs = F.struct(F.when(F.col("p_partkey") % 2 == 0, z).alias("FLD_ZONE"), F.when(F.col("p_partkey") % 2 == 1, z).alias("ZONE"),
                     F.when(F.col("p_partkey") % 13 != 0, F.col("p_partkey").cast("string")).alias("FLD_AR_ID"), F.col("p_size").alias("OTHER"))
    g = p.groupBy((F.col("p_partkey") / 100).cast("long").alias("page")).agg(
        F.collect_list(F.struct(F.col("p_partkey").alias("k"), attrs.alias("attributes"))).alias("fs"))
    landed = g.select(F.to_json(F.struct(F.transform("fs", lambda f: F.struct(f["attributes"].alias("attributes"))).alias("features"))).alias("payload"))
    return payloads.parse_features(landed, "payload")


@register("s14_osm_tags_to_rows", O.sql("""
SELECT amenity_id, amenity_type, name FROM amenities WHERE amenity_type IN ('grocery', 'park', 'hospital', 'transit_stop', 'pharmacy')""",
    "amenities"))
def s14(spark, d):
    a = bindings.amenities(Tb(spark, d))
    t = F.col("amenity_type")
    tags = (F.when(t == "grocery", F.create_map(F.lit("shop"), F.lit("supermarket")))
             .when(t == "park", F.create_map(F.lit("leisure"), F.lit("park")))
             .when(t == "hospital", F.create_map(F.lit("amenity"), F.lit("hospital")))
             .when(t == "transit_stop", F.create_map(F.lit("public_transport"), F.lit("platform")))
             .when(t == "pharmacy", F.create_map(F.lit("amenity"), F.lit("pharmacy")))
             .otherwise(F.create_map(F.lit("tourism"), F.lit("museum"))))
    node = F.struct(F.col("amenity_id").alias("id"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"),
                    F.map_concat(tags, F.create_map(F.lit("name"), F.col("name"))).alias("tags"))
    g = a.groupBy("city", (F.col("amenity_id").cast("bigint") / 1000).cast("long").alias("_page")).agg(
        F.collect_list(node).alias("elements"))
    landed = g.select(F.to_json(F.struct("elements")).alias("payload"))
    return payloads.parse_osm_elements(landed, "payload").select("amenity_id", "amenity_type", "name")


@register("s15_html_card_extract", O.rounded("""
SELECT page, CASE WHEN k % 3 = 2 THEN concat('casa-', k) ELSE CAST(k AS VARCHAR) END AS listing_id,
       concat(CASE WHEN k % 2 = 0 THEN 'https://x.co' ELSE 'https://base.co' END, '/inmueble/casa-', k, CASE WHEN k % 3 = 2 THEN '?p=1' ELSE '' END) AS listing_url,
       concat(CASE WHEN k % 2 = 0 THEN 'Apartamento en ' ELSE 'Casa en ' END, k) AS title,
       CASE WHEN k % 10 = 0 THEN NULL ELSE 10000000 + k * 1000 END AS price_cop,
       CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(1 + k % 5 AS INT) END AS bedrooms, 1 + (k % 2) / 2e0 AS bathrooms, 40e0 + k % 100 AS area_m2,
       concat('Barrio ', k % 9) AS barrio, concat('Barrio ', k % 9, ', Bogota') AS address,
       CASE WHEN k % 2 = 0 THEN 'apartamento' ELSE 'casa' END AS property_type
FROM (SELECT p_partkey AS k, CAST(p_partkey // 20 AS BIGINT) AS page FROM part WHERE p_partkey % 11 <> 0) x""", ["bathrooms", "area_m2"]))
def s15(spark, d):
    return html.extract_cards(card_pages(Tb(spark, d).part), "html", keep=["page"], base_url="https://base.co")


def card_pages(parts):
    """Landed pages of listing cards, of the parts."""
    k = F.col("p_partkey")
    card = F.concat(                                        # every card spells its facts in one of several ways
        F.lit("<article "), F.when(k % 3 == 0, F.concat(F.lit('data-id="'), k, F.lit('"')))
        .when(k % 3 == 1, F.concat(F.lit('class="x" data-listing-id="'), k, F.lit('"'))).otherwise(F.lit("")), F.lit(">"),
        F.when(k % 11 == 0, F.lit("<span>ad</span>")).otherwise(F.concat(
            F.lit('<a href="/other">x</a><a class="l" href="'), F.when(k % 2 == 0, F.lit("https://x.co")).otherwise(F.lit("")), F.lit("/inmueble/casa-"), k,
            F.when(k % 3 == 2, F.lit("?p=1")).otherwise(F.lit("")), F.lit('">see</a><h2 class="t">'),
            F.when(k % 2 == 0, F.lit("Apartamento en ")).otherwise(F.lit("Casa en ")), F.lit("<b>"), k, F.lit("</b></h2>"),
            F.when(k % 10 == 0, F.lit("<p>$ 900.000</p>")).otherwise(F.concat(F.lit("<p>$ "), F.format_number(F.lit(10000000) + k * 1000, 0), F.lit("</p>"))),
            F.when(k % 7 != 0, F.concat(F.lit("<li>"), F.lit(1) + k % 5, F.when(k % 3 == 0, F.lit(" HABITACIONES</li>"))
                                        .when(k % 3 == 1, F.lit(" alcobas</li>")).otherwise(F.lit("hab.</li>")))).otherwise(F.lit("")),
            F.lit("<li>"), F.when(k % 2 == 0, F.lit("1 baño")).otherwise(F.lit("1,5 BANOS")), F.lit("</li><li>"), F.lit(40) + k % 100,
            F.when(k % 2 == 0, F.lit(" m²")).otherwise(F.lit(" M2")), F.lit('</li><span data-testid="card-Location">Barrio '), k % 9, F.lit(", Bogota</span>"))),
        F.lit("</article>"))
    return parts.groupBy(F.floor(k / 20).cast("bigint").alias("page")).agg(
        F.concat(F.lit("<html><title>t</title><h1>Listings</h1>"), F.array_join(F.collect_list(card), "\n"), F.lit("</html>")).alias("html"))


@register("s16_literal_rows", O.rounded(O.sql("""
SELECT h.hazard_id, h.risk_score * w.weight AS weighted FROM hazards h
JOIN (VALUES ('flood', 0.3e0), ('earthquake', 0.3e0), ('wildfire', 0.2e0), ('tornado', 0.1e0), ('landslide', 0.1e0)) AS w(hazard_type, weight)
  ON h.hazard_type = w.hazard_type""", "hazards"), ["weighted"]))
def s16(spark, d):
    from ..functions.scoring import HAZARD_WEIGHTS
    w = spark.createDataFrame([(k.replace("_risk_score", ""), float(v)) for k, v in HAZARD_WEIGHTS.items()],
                              "hazard_type string, weight double")   # a lookup table: size fixed by the code
    h = bindings.hazards(Tb(spark, d))
    return h.join(F.broadcast(w), "hazard_type").select("hazard_id", (F.col("risk_score") * F.col("weight")).alias("weighted"))


@register("s17_wide_to_long", O.sql("""
SELECT country_code, city, substr(lpad(replace(zip_or_municipio, 'Z', ''), 5, '0'), 1, 5) AS zip,
       strftime(date, '%Y-%m-%d') AS date_str, CAST(median_price_usd AS DOUBLE) AS value
FROM market_raw""", "market_raw"))
def s17(spark, d):
    m = bindings.market(Tb(spark, d))                       # one column a month of the calendar
    wide = (m.withColumn("date_s", F.date_format("date", "yyyy-MM-dd"))
             .groupBy("country_code", "city", "zip_or_municipio").pivot("date_s").agg(F.max("median_price_usd")))
    cols = unpivot.date_columns(wide.columns)
    long = unpivot.wide_to_long(wide, ["country_code", "city", "zip_or_municipio"], cols, "date_str", "value")
    from ..functions.numbers import zip_pad
    return long.select("country_code", "city", zip_pad(F.regexp_replace("zip_or_municipio", "Z", "")).alias("zip"),
                       "date_str", "value")


_CRIME_TYPES = ["Homicidio", "Hurto a personas", "Daño en bien ajeno", "Hurto con violencia", "Extorsión", "robbery"]


@register("s18_wide_crime_unpivot", O.sql("""
SELECT city, crime_type, CAST(sum("count") AS DOUBLE) AS n FROM crime GROUP BY 1, 2 HAVING sum("count") > 0""", "crime"))
def s18(spark, d):
    c = bindings.crime(Tb(spark, d))
    wide = c.groupBy("city").pivot("crime_type", _CRIME_TYPES).agg(F.sum("count"))
    return unpivot.wide_to_long(wide, ["city"], _CRIME_TYPES, "crime_type", "n", positive_only=True)


_MES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre",
        "noviembre", "diciembre"]


@register("s19_long_crime_rows", O.sql("""
SELECT city, crime_type, "count", period_month, CASE WHEN period_month % 2 = 0 THEN period_year ELSE 2020 END AS period_year,
       CASE WHEN raw LIKE '%homicid%' OR raw LIKE '%violenc%' THEN 'violent' WHEN raw LIKE '%hurto%' AND raw LIKE '%violen%' THEN 'violent'
            WHEN raw LIKE '%hurto%' OR raw LIKE '%robo%' OR raw LIKE '%dano%' THEN 'property' ELSE 'other' END AS crime_category
FROM (SELECT *, translate(lower(trim(crime_type)), 'áéíóúñü', 'aeiounu') AS raw FROM crime) c WHERE "count" > 0""", "crime"))
def s19(spark, d):
    c = bindings.crime(Tb(spark, d))
    month = F.when(F.col("period_month") % 3 == 0, F.element_at(F.array(*[F.lit(m) for m in _MES]), F.col("period_month"))) \
             .otherwise(F.col("period_month").cast("string"))
    year = F.when(F.col("period_month") % 2 == 0, F.col("period_year").cast("string")).otherwise(F.lit("1850"))
    raw = c.select("city", "crime_type", F.col("count").cast("string").alias("count"), month.alias("month"),
                   year.alias("year"), F.lit(2020).alias("file_year"))
    out = delimited.long_crime_rows(raw)
    return out.select("city", "crime_type", "count", "period_month", "period_year", "crime_category")


@register("s20_ingest_stamp", O.sql("""
SELECT city, crime_type, "count", TIMESTAMP '2024-01-01 00:00:00' AS ingested_at, 'policia' AS source FROM crime""", "crime"))
def s20(spark, d):
    c = bindings.crime(Tb(spark, d)).select("city", "crime_type", "count")
    return c.withColumn("ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp")).withColumn("source", F.lit("policia"))


_DEFAULTS = [("NATION_1", 1.0, 1.0), ("NATION_2", 2.0, 2.0), ("ATLANTIS", 3.0, 3.0)]


@register("s21_fallback_rows", O.rounded(O.sql("""
SELECT coalesce(f.city, d.city) AS city, coalesce(f.lat, d.lat) AS lat, coalesce(f.lon, d.lon) AS lon,
       f.city IS NOT NULL AS discovered
FROM (SELECT city, avg(lat) AS lat, avg(lon) AS lon FROM listings_raw GROUP BY 1) f
FULL OUTER JOIN (VALUES ('NATION_1', 1e0, 1e0), ('NATION_2', 2e0, 2e0), ('ATLANTIS', 3e0, 3e0)) AS d(city, lat, lon)
  ON f.city = d.city""", "listings_raw"), ["lat", "lon"]))
def s21(spark, d):
    found = bindings.listings(Tb(spark, d)).groupBy("city").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    defaults = spark.createDataFrame(_DEFAULTS, "city string, lat double, lon double")
    j = found.alias("f").join(F.broadcast(defaults).alias("d"), "city", "full_outer")
    return j.select("city", F.coalesce("f.lat", "d.lat").alias("lat"), F.coalesce("f.lon", "d.lon").alias("lon"),
                    F.col("f.lat").isNotNull().alias("discovered"))


@register("s22_incident_json", """
SELECT CAST(event_id AS VARCHAR) AS incident_id, event_type AS crime_type,
       CASE WHEN event_type IN ('assault', 'shooting') THEN 'violent' WHEN event_type = 'theft' THEN 'property' ELSE 'other' END AS crime_category,
       CAST(ts AS DATE) AS incident_date, CAST(year(ts) AS INT) AS year
FROM (SELECT * REPLACE (CASE event_type WHEN 'click' THEN 'assault' WHEN 'view' THEN 'theft' WHEN 'signup' THEN 'shooting' ELSE event_type END AS event_type)
      FROM events) e""")
def s22(spark, d):
    return payloads.parse_incidents(incident_feeds(Tb(spark, d).events), "payload").select("incident_id", "crime_type", "crime_category", "incident_date", "year")


def incident_feeds(e):
    """Landed incident feeds of users, of the events ``e``."""
    kinds = F.create_map(*[F.lit(x) for x in ("click", "assault", "view", "theft", "signup", "shooting")])
    inc = F.struct(F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).alias("cdid"),
                   F.when(F.col("event_id") % 2 == 1, F.col("event_id").cast("string")).alias("id"),
                   F.concat(F.lit(" "), F.upper(F.coalesce(F.element_at(kinds, F.col("event_type")), F.col("event_type")))).alias("type"),
                   F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("date"))
    placed = e.withColumn("_page", (F.col("event_id") / 1000).cast("long")).repartition("user_id", "_page")
    g = placed.groupBy("user_id", "_page").agg(F.collect_list(inc).alias("crimes"))
    return g.select("user_id", F.to_json(F.struct("crimes")).alias("payload"))


@register("s23_record_json", """
SELECT CAST(p_partkey AS VARCHAR) AS school_id, p_name AS school_name, concat('NATION_', CAST(p_partkey % 25 AS VARCHAR)) AS city,
       lpad(CAST(p_partkey % 56 AS VARCHAR), 2, '0') AS zip_fips,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size * 10 END AS enrollment
FROM part""")
def s23(spark, d):
    p = Tb(spark, d).part
    rec = F.struct(F.col("p_partkey").cast("string").alias("ncessch"), F.col("p_name").alias("school_name"),
                   F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string"))).alias("city_location"),
                   F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string")).alias("city_mailing"),
                   (F.col("p_partkey") % 56).cast("string").alias("fips"),
                   F.when(F.col("p_size") % 5 == 0, F.lit("-1")).otherwise((F.col("p_size") * 10).cast("string")).alias("enrollment"))
    g = p.groupBy((F.col("p_partkey") / 200).cast("long").alias("page")).agg(F.collect_list(rec).alias("results"))
    landed = g.select(F.to_json(F.struct(F.lit("0").alias("count"), F.col("results"))).alias("payload"))
    out = payloads.parse_directory(landed, "payload")
    return out.select("school_id", "school_name", "city", F.col("state_fips").alias("zip_fips"), "enrollment")


@register("s24_market_long_rows", O.rounded(O.sql("""
SELECT substr(lpad(CAST(inventory_count % 100 AS VARCHAR), 5, '0'), 1, 5) AS zip, date, city, CAST(homes_sold AS INT) AS homes_sold,
       CAST(inventory_count AS INT) AS inventory_count, median_price_usd AS median_sale_price_usd,
       CASE WHEN homes_sold > 0 THEN CAST(inventory_count AS DOUBLE) / homes_sold END AS months_of_supply
FROM market_raw WHERE inventory_count % 100 <> 0 AND month(date) <> 2""", "market_raw"), ["months_of_supply"]))
def s24(spark, d):
    m = bindings.market(Tb(spark, d))
    bad_date = F.month("date") == 2
    raw = m.select((F.col("inventory_count") % 100).cast("string").alias("zip"),
                   F.when(bad_date, F.lit("31/02/2020")).when(F.col("homes_sold") % 2 == 0, F.date_format("date", "yyyy-MM-dd"))
                    .otherwise(F.date_format("date", "MM/dd/yyyy")).alias("period_end"),
                   "city", F.col("homes_sold").cast("string").alias("homes_sold"),
                   F.col("inventory_count").cast("string").alias("inventory"),
                   F.col("median_price_usd").cast("string").alias("median_sale_price"), F.lit("").alias("median_dom"))
    return delimited.market_long_rows(raw).drop("median_days_on_market")
