"""Registered ingest composites (c24-c36) on payloads landed from the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import labels
from ..operators import pivot, unpivot, upsert
from ..session import scratch_path
from ..sources import bindings, delimited, payloads
from ..sources.tables import Tables
from . import catalog_sources as cs
from . import ingest
from .catalog import ORACLE, O, register


def T(spark, d) -> Tables:
    return Tables.shared(spark, d)


_SECTOR_SQL = "CASE p_partkey % 3 WHEN 0 THEN 'Oficial' WHEN 1 THEN 'No Oficial' ELSE 'Privado' END"
_CITY_SETS = {"bogota": (["dept0"], ["nation0", "nation5", "nation10"]), "medellin": (["dept1"], ["nation1", "nation6"])}


@register("c24_icfes", O.rounded(f"""
WITH s AS (SELECT CAST(l_partkey AS VARCHAR) AS school_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice / 1e3 END AS score,
                  year(l_shipdate) AS year FROM lineitem),
s2 AS (SELECT * FROM s WHERE score IS NOT NULL),
md AS (SELECT CAST(arg_min(year, (-n, year)) AS INT) AS icfes_year FROM (SELECT year, count(*) AS n FROM s2 GROUP BY 1) y),
inst AS (SELECT school_id, avg(score) AS icfes_score, count(*) AS student_count FROM s2 GROUP BY 1),
pr AS (SELECT *, CASE WHEN count(*) OVER () > 1
                      THEN ((rank() OVER (ORDER BY icfes_score) + (count(*) OVER (PARTITION BY icfes_score) - 1) / 2e0) - 1)
                           / (count(*) OVER () - 1) * 1e2 ELSE 1e2 END AS icfes_percentile FROM inst),
reg AS (SELECT CAST(p_partkey AS VARCHAR) AS school_id, p_name AS institution_name,
               concat('NATION_', CAST(p_partkey % 25 AS VARCHAR)) AS municipio, concat('Dept ', CAST(p_partkey % 5 AS VARCHAR)) AS departamento,
               {_SECTOR_SQL} AS sector FROM part)
SELECT reg.school_id, institution_name, municipio, departamento, icfes_score, student_count, icfes_percentile, icfes_year,
       CASE WHEN sector = 'Oficial' THEN 'oficial' ELSE 'privado' END AS school_type
FROM reg JOIN pr ON reg.school_id = pr.school_id CROSS JOIN md
WHERE (lower(replace(departamento, ' ', '')) = 'dept0' AND lower(replace(municipio, '_', '')) IN ('nation0', 'nation5', 'nation10'))
   OR (lower(replace(departamento, ' ', '')) = 'dept1' AND lower(replace(municipio, '_', '')) IN ('nation1', 'nation6'))""",
    ["icfes_score", "icfes_percentile"]))
def c24(spark, d):
    t = T(spark, d)
    l = t.lineitem
    students = l.select(F.col("l_partkey").cast("string").alias("school_id"),
                        F.when(F.col("l_linenumber") != 7, (F.col("l_extendedprice") / 1e3).cast("string")).alias("score"),
                        F.year("l_shipdate").cast("string").alias("year"))
    p = t.part
    k = F.col("p_partkey")
    registry = p.select(k.cast("string").alias("school_id"), F.col("p_name").alias("institution_name"),
                        F.concat(F.lit("NATION_"), (k % 25).cast("string")).alias("municipio"),
                        F.concat(F.lit("Dept "), (k % 5).cast("string")).alias("departamento"),
                        F.when(k % 3 == 0, "Oficial").when(k % 3 == 1, "No Oficial").otherwise("Privado").alias("sector"))
    return ingest.icfes_institutions(students, registry, _CITY_SETS)


_SUBJ = ("CASE l_linenumber WHEN 1 THEN 'math' WHEN 2 THEN 'math' WHEN 3 THEN 'reading' WHEN 4 THEN 'reading' "
         "WHEN 5 THEN 'reading' END")


@register("c25_us_schools", O.rounded(f"""
SELECT CAST(p.p_partkey AS VARCHAR) AS school_id, p.p_name AS school_name, concat('NATION_', CAST(p.p_partkey % 25 AS VARCHAR)) AS city,
       a.math_pct, a.reading_pct
FROM part p LEFT JOIN (SELECT CAST(l_partkey AS VARCHAR) AS school_id, max(CASE WHEN s = 'math' THEN pct END) AS math_pct,
                              max(CASE WHEN s = 'reading' THEN pct END) AS reading_pct
                       FROM (SELECT l_partkey, l_discount * 1e3 AS pct, {_SUBJ} AS s FROM lineitem) x WHERE s IS NOT NULL GROUP BY 1) a
  ON CAST(p.p_partkey AS VARCHAR) = a.school_id""", ["math_pct", "reading_pct"]))
def c25(spark, d):
    t = T(spark, d)
    l = t.lineitem
    n = F.col("l_linenumber")
    subj = F.when(n <= 2, "math").when(n <= 5, "reading")
    a = l.select(F.col("l_partkey").cast("string").alias("school_id"), (F.col("l_discount") * 1e3).alias("pct"), subj.alias("s")) \
         .filter(F.col("s").isNotNull())
    best = pivot.pivot_max(a, ["school_id"], "s", ["math", "reading"], "pct", "_pct")
    p = t.part
    directory = p.select(F.col("p_partkey").cast("string").alias("school_id"), F.col("p_name").alias("school_name"),
                         F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string")).alias("city"))
    rows = directory.join(best, "school_id", "left")
    stale = rows.filter(F.col("school_id").cast("int") % 2 == 0).withColumn("math_pct", F.lit(None).cast("double"))
    return upsert.upsert_subset(stale, rows, ["school_id"], ["school_name", "city", "math_pct", "reading_pct"])


_INC = ("CASE event_type WHEN 'click' THEN 'Flood' WHEN 'view' THEN 'Severe Storm' WHEN 'signup' THEN 'Fire' "
        "WHEN 'purchase' THEN 'Tornado' ELSE 'Volcano' END")


def _hazard_target(spark, d, source: str, dataset: str):
    """A stored hazard table: some rows of the source's own slice, some of another dataset of it, the rest from elsewhere."""
    h = bindings.hazards(T(spark, d))
    k = F.substring("hazard_id", 3, 30).cast("bigint")
    return h.select(*[(F.when(k % 4 == 0, source).otherwise(F.col("source")) if c == "source" else F.col(c) if c in h.columns else F.lit(None)).cast(t).alias(c)
                      for c, t in ingest.HAZARD_ROW.items()], F.when(k % 8 == 0, dataset).otherwise("other").alias("dataset"))


def _hazard_sql(block: str, source: str, dataset: str, country: str, *ctes) -> str:
    """The stored rows outside the block's slices, and the block (a SELECT of the columns it has)."""
    cols = ", ".join(f"CAST({c} AS {t}) AS {c}" if c not in ("source", "country_code") else f"'{source if c == 'source' else country}' AS {c}"
                     for c, t in {k: {"string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP"}[v] for k, v in ingest.HAZARD_ROW.items()}.items())
    nulls = "NULL AS lat, NULL AS lon, NULL AS state_or_dept, NULL AS county_or_municipio, NULL AS zip_or_zone, NULL AS data_date, NULL AS details_json, NULL AS ingested_at"
    return O.rounded(O.sql(f"""
SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM block b WHERE b.source = s.source AND b.hazard_type = s.hazard_type AND b.dataset = s.dataset)
UNION ALL SELECT * FROM block""", "hazards", *ctes, extra={
        "rows_": block,
        "block": f"SELECT {cols}, '{dataset}' AS dataset FROM (SELECT * FROM rows_ UNION ALL BY NAME SELECT * FROM (SELECT {nulls}) z WHERE false) b0",
        "stored": f"""SELECT hazard_id, CASE WHEN k % 4 = 0 THEN '{source}' ELSE source END AS source, country_code, state_or_dept, county_or_municipio, zip_or_zone,
       CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon, hazard_type, CAST(NULL AS VARCHAR) AS risk_level, risk_score, CAST(NULL AS DATE) AS data_date,
       CAST(NULL AS VARCHAR) AS details_json, CAST(NULL AS TIMESTAMP) AS ingested_at, CASE WHEN k % 8 = 0 THEN '{dataset}' ELSE 'other' END AS dataset
FROM (SELECT *, CAST(substr(hazard_id, 3) AS BIGINT) AS k FROM hazards) h"""}), ["risk_score", "lat", "lon"])


@register("c26_disaster_frequency", _hazard_sql(f"""
SELECT concat_ws('_', 'fema', hazard_type, state, replace(county, ' ', '_')) AS hazard_id, state AS state_or_dept, county AS county_or_municipio, hazard_type,
       least(count(*) / 5e1, 1e0) AS risk_score,
       CASE WHEN least(count(*) / 5e1, 1e0) >= 0.8 THEN 'very_high' WHEN least(count(*) / 5e1, 1e0) >= 0.6 THEN 'high'
            WHEN least(count(*) / 5e1, 1e0) >= 0.3 THEN 'medium' ELSE 'low' END AS risk_level,
       concat('{{"n":', count(*), ',"sample_id":"', min(declaration_id), '"}}') AS details_json
FROM (SELECT CAST(event_id AS VARCHAR) AS declaration_id, concat('S', CAST(user_id % 5 AS VARCHAR)) AS state,
             concat('County ', CAST(user_id % 40 AS VARCHAR)) AS county,
             CASE {_INC} WHEN 'Flood' THEN 'flood' WHEN 'Severe Storm' THEN 'flood' WHEN 'Fire' THEN 'wildfire'
                         WHEN 'Tornado' THEN 'tornado' END AS hazard_type FROM events) e
WHERE hazard_type IS NOT NULL GROUP BY state, county, hazard_type""", "fema", "disasters", "US"))
def c26(spark, d):
    e = T(spark, d).events
    et = F.col("event_type")
    inc = (F.when(et == "click", "Flood").when(et == "view", "Severe Storm").when(et == "signup", "Fire")
            .when(et == "purchase", "Tornado").otherwise("Volcano"))
    dec = e.select(F.col("event_id").cast("string").alias("declaration_id"),
                   F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("state"),
                   F.concat(F.lit("County "), (F.col("user_id") % 40).cast("string")).alias("county"), inc.alias("incident_type"))
    rows = ingest.disaster_frequency(dec).withColumn("details_json", F.to_json(F.struct("n", "sample_id")))
    return ingest.load_hazards(_hazard_target(spark, d, "fema", "disasters"), ingest.hazard_block(rows, "fema", "US", "disasters", state_or_dept="state", county_or_municipio="county"))


_HAV = "(2.0 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(g.lat) - radians(c.lat)) / 2), 2) + cos(radians(c.lat)) * cos(radians(g.lat)) * pow(sin((radians(g.lon) - radians(c.lon)) / 2), 2)))))"


@register("c27_earthquake", _hazard_sql(f"""
SELECT concat('sgc_earthquake_', geo_id) AS hazard_id, lat, lon, 'earthquake' AS hazard_type, concat('{{"point_id":', point_id, '}}') AS details_json,
       least(pga / 0.5e0, 1e0) AS risk_score,
       CASE WHEN least(pga / 0.5e0, 1e0) >= 0.8 THEN 'very_high' WHEN least(pga / 0.5e0, 1e0) >= 0.6 THEN 'high'
            WHEN least(pga / 0.5e0, 1e0) >= 0.3 THEN 'medium' ELSE 'low' END AS risk_level
FROM (SELECT c.geo_id, c.lat, c.lon, g.point_id, g.pga,
             row_number() OVER (PARTITION BY c.geo_id ORDER BY {_HAV}, g.lat, g.lon, g.point_id) AS rn
      FROM centroids c CROSS JOIN grid g) x WHERE rn = 1""", "sgc", "pga", "CO", "centroids", "grid"))
def c27(spark, d):
    t = T(spark, d)
    rows = ingest.earthquake_from_grid(bindings.centroids(t), bindings.grid(t)).join(bindings.centroids(t), "geo_id") \
        .select(F.concat_ws("_", F.lit("sgc_earthquake"), "geo_id").alias("hazard_id"), "lat", "lon", F.lit("earthquake").alias("hazard_type"),
                F.to_json(F.struct("point_id")).alias("details_json"), "risk_score", "risk_level")
    return ingest.load_hazards(_hazard_target(spark, d, "sgc", "pga"), ingest.hazard_block(rows, "sgc", "CO", "pga"))


_CLASSES = ["Bajo", "MEDIO", "alto", "Muy  Alto", "muy_alto", "desconocido"]


@register("c28_ungrd", _hazard_sql(f"""
SELECT concat_ws('_', 'ungrd', 'landslide', municipio) AS hazard_id, municipio AS county_or_municipio, 'landslide' AS hazard_type, max(s) AS risk_score,
       CASE WHEN max(s) >= 0.8 THEN 'very_high' WHEN max(s) >= 0.6 THEN 'high' WHEN max(s) >= 0.3 THEN 'medium' ELSE 'low' END AS risk_level
FROM (SELECT concat('NATION_', CAST(p_partkey % 25 AS VARCHAR)) AS municipio,
             CASE regexp_replace(lower(trim(c)), '\\s+', ' ', 'g') WHEN 'bajo' THEN 0.2e0 WHEN 'medio' THEN 0.5e0 WHEN 'alto' THEN 0.8e0
                  WHEN 'muy alto' THEN 0.95e0 WHEN 'muy_alto' THEN 0.95e0 END AS s
      FROM (SELECT p_partkey, list_extract([{', '.join(repr(c) for c in _CLASSES)}], CAST(p_partkey % 6 + 1 AS INT)) AS c FROM part) p) x
WHERE s IS NOT NULL GROUP BY municipio""", "ungrd", "landslide_2021", "CO"))
def c28(spark, d):
    p = T(spark, d).part
    cls = F.element_at(F.array(*[F.lit(c) for c in _CLASSES]), (F.col("p_partkey") % 6 + 1).cast("int"))
    raw = p.select(F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string")).alias("Municipio "), cls.alias("Clasificación"))
    landing = scratch_path(spark, f"c28_{uuid.uuid4().hex}")               # landed under a routed name, headers to resolve
    raw.write.option("header", True).csv(f"{landing}/ungrd_remocion_2021.csv")
    raw.limit(1).write.option("header", True).csv(f"{landing}/leeme.csv")
    routed = delimited.with_file_routing(delimited.read_csv(spark, f"{landing}/*"), {"ungrd_remocion": "landslide"})
    rows = delimited.resolve_columns(routed, {"municipio": ["municipio"], "classification": ["clasificacion", "amenaza"]})
    return ingest.load_hazards(_hazard_target(spark, d, "ungrd", "landslide_2021"),
                               ingest.hazard_block(ingest.risk_class_rows(rows, "landslide"), "ungrd", "CO", "landslide_2021", county_or_municipio="municipio"))


@register("c29_flood_zones", _hazard_sql(f"""
SELECT concat('fema_flood_S', CAST(p_partkey % 5 AS VARCHAR), '_', area_id) AS hazard_id, concat('S', CAST(p_partkey % 5 AS VARCHAR)) AS state_or_dept,
       zone AS zip_or_zone, 'flood' AS hazard_type, risk_score, concat('{{"', CASE WHEN p_partkey % 2 = 0 THEN 'FLD_ZONE' ELSE 'ZONE' END, '":"', zone, '","FLD_AR_ID":"', area_id, '","OTHER":', other, '}}') AS details_json,
       CASE WHEN risk_score >= 0.8 THEN 'very_high' WHEN risk_score >= 0.6 THEN 'high' WHEN risk_score >= 0.3 THEN 'medium'
            WHEN risk_score IS NOT NULL THEN 'low' END AS risk_level
FROM ({ORACLE["s13_json_features"]}) f""", "fema", "flood_zones", "US"))
def c29(spark, d):
    features = cs.flood_features(spark, d).withColumn("state", F.concat(F.lit("S"), (F.col("area_id").cast("bigint") % 5).cast("string")))
    block = ingest.hazard_block(ingest.flood_zone_rows(features, "state"), "fema", "US", "flood_zones")
    return ingest.load_hazards(_hazard_target(spark, d, "fema", "flood_zones"), block)


_WCOLS = ["country_code", "city", "date", "temp_max_c", "temp_min_c", "precipitation_mm", "wind_speed_max_kmh"]


@register("c30_weather_load", O.rounded(O.sql("""
SELECT w.country_code, w.city, w.date, w.temp_max_c, w.temp_min_c, w.precipitation_mm,
       CASE WHEN w.date > coalesce(h.hw, DATE '1900-01-01') AND w.city IN ('NATION_1', 'NATION_2') THEN NULL ELSE w.wind_speed_max_kmh END AS wind_speed_max_kmh
FROM weather w LEFT JOIN (SELECT country_code, city, max(date) AS hw FROM weather WHERE date < DATE '2024-01-20' GROUP BY 1, 2) h
  ON w.country_code = h.country_code AND w.city = h.city""", "weather"),
    ["temp_max_c", "temp_min_c", "precipitation_mm", "wind_speed_max_kmh"]))
def c30(spark, d):
    w = bindings.weather(T(spark, d))
    target = w.filter(F.col("date") < F.lit("2024-01-20").cast("date")).select(*_WCOLS)
    batch = cs.s08(spark, d).select(*_WCOLS)        # parsed daily arrays (s08)
    return ingest.append_after_high_water(target, batch, ["country_code", "city"], "date")


@register("c31_fx_load", O.sql("""
SELECT * FROM clean WHERE date < DATE '1996-01-01'
UNION ALL SELECT * FROM clean WHERE date > (SELECT max(date) FROM clean WHERE date < DATE '1996-01-01')""", "fx", extra={
    "dirty": """SELECT date, from_currency, to_currency, CASE WHEN day(date) = 1 THEN 0e0 WHEN day(date) = 2 THEN 'NaN'::DOUBLE
                       ELSE rate END AS rate FROM fx""",
    "clean": "SELECT * FROM dirty WHERE rate IS NOT NULL AND NOT isnan(rate) AND rate > 0"}))
def c31(spark, d):
    fx = bindings.fx(T(spark, d))
    day = F.dayofmonth("date")
    dirty = fx.withColumn("rate", F.when(day == 1, F.lit(0.0)).when(day == 2, F.lit(float("nan"))).otherwise(F.col("rate")))
    clean = ingest.clean_rates(dirty)
    target = clean.filter(F.col("date") < F.lit("1996-01-01").cast("date"))
    return ingest.append_after_high_water(target, clean, ["from_currency", "to_currency"], "date")


_CT = ["Homicidio", "Hurto a personas", "Daño en bien ajeno", "Hurto con violencia", "Extorsión", "robbery"]
_KEEP = [f"nation{i}" for i in range(13)]
_CAT = """CASE WHEN raw LIKE '%homicid%' OR raw LIKE '%violenc%' THEN 'violent' WHEN raw LIKE '%hurto%' AND raw LIKE '%violen%' THEN 'violent'
               WHEN raw LIKE '%hurto%' OR raw LIKE '%robo%' OR raw LIKE '%dano%' THEN 'property' ELSE 'other' END"""


@register("c32_crime_co", O.sql(f"""
SELECT city, crime_type, period_year, n, source, {_CAT} AS crime_category
FROM (SELECT *, translate(lower(trim(crime_type)), 'áéíóúñü', 'aeiounu') AS raw FROM res) r""", "crime", extra={
    "batch": f"""
  SELECT city, crime_type, period_year, n, source FROM (
    SELECT city, crime_type, period_year, CAST(sum("count") AS DOUBLE) AS n, 'policia' AS source FROM crime WHERE country_code = 'CO' GROUP BY 1, 2, 3
    UNION ALL
    SELECT city, crime_type, period_year, CAST(sum("count") AS DOUBLE) AS n, 'dane' AS source FROM crime WHERE country_code = 'US'
    GROUP BY 1, 2, 3 HAVING sum("count") > 0) b
  WHERE regexp_replace(lower(city), '[^a-z0-9]', '', 'g') IN ({', '.join(repr(c) for c in _KEEP)})""",
    "tgt": f"""SELECT city, crime_type, CASE WHEN period_year < 1995 THEN period_year - 10 ELSE period_year END AS period_year,
               CAST(sum("count") * 2 AS DOUBLE) AS n, 'policia' AS source FROM crime WHERE country_code = 'CO' GROUP BY 1, 2, 3""",
    "res": f"""SELECT * FROM tgt WHERE (period_year, source) NOT IN (SELECT DISTINCT period_year, source FROM batch) UNION ALL SELECT * FROM batch"""}))
def c32(spark, d):
    from ..operators.filters import in_alias_set
    c = bindings.crime(T(spark, d))
    long_rows = c.filter(F.col("country_code") == "CO").groupBy("city", "crime_type", "period_year") \
                 .agg(F.sum("count").cast("double").alias("n")).withColumn("source", F.lit("policia"))
    wide = c.filter(F.col("country_code") == "US").groupBy("city", "period_year").pivot("crime_type", _CT).agg(F.sum("count"))
    wide_rows = unpivot.wide_to_long(wide, ["city", "period_year"], _CT, "crime_type", "n", positive_only=True) \
                       .withColumn("source", F.lit("dane"))
    batch = in_alias_set(long_rows.unionByName(wide_rows), "city", _KEEP)
    target = c.filter(F.col("country_code") == "CO").groupBy(
        "city", "crime_type", F.when(F.col("period_year") < 1995, F.col("period_year") - 10).otherwise(F.col("period_year")).alias("period_year")) \
        .agg((F.sum("count") * 2).cast("double").alias("n")).withColumn("source", F.lit("policia"))
    out = upsert.slice_replace(target, batch, ["period_year", "source"])
    return out.withColumn("crime_category", labels.crime_category_spanish("crime_type"))


@register("c33_market_load", O.sql("""
SELECT geo_id, date, source, min(value) AS value FROM (SELECT * FROM wide UNION ALL SELECT * FROM lng) u GROUP BY 1, 2, 3""",
    "market_raw", extra={
        "wide": """SELECT concat(city, '|', substr(lpad(replace(zip_or_municipio, 'Z', ''), 5, '0'), 1, 5)) AS geo_id, date,
                          CAST(median_price_usd AS DOUBLE) AS value, 'zhvi' AS source FROM market_raw""",
        "lng": """SELECT concat(city, '|', substr(lpad(CAST(inventory_count % 100 AS VARCHAR), 5, '0'), 1, 5)) AS geo_id, date,
                         CAST(median_price_usd AS DOUBLE) AS value, 'redfin' AS source FROM market_raw
                  WHERE inventory_count % 100 <> 0 AND month(date) <> 2"""}))
def c33(spark, d):
    w = cs.s17(spark, d).select(F.concat_ws("|", "city", "zip").alias("geo_id"), F.to_date("date_str").alias("date"), "value", F.lit("zhvi").alias("source"))
    l = cs.s24(spark, d).select(F.concat_ws("|", "city", "zip").alias("geo_id"), "date", F.col("median_sale_price_usd").cast("double").alias("value"),
                                F.lit("redfin").alias("source"))
    rows = w.unionByName(l).select("geo_id", "date", "source", "value")
    target = rows.filter(F.month("date") <= 6).withColumn("value", F.col("value") * 2)
    return ingest.upsert_by_key(target, rows, ["geo_id", "date", "source"])


@register("c34_economic_us", O.rounded(O.sql("""
SELECT e.city AS metro, e.date, e.unemployment_rate, m.mortgage_rate_30yr
FROM economic e LEFT JOIN (SELECT metro, CAST(date_trunc('month', week) AS DATE) AS date, avg(rate) AS mortgage_rate_30yr
                           FROM (SELECT concat('NATION_', CAST(l_suppkey % 25 AS VARCHAR)) AS metro, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
                                        avg(l_discount * 1e2) AS rate FROM lineitem GROUP BY 1, 2) w GROUP BY 1, 2) m
  ON e.city = m.metro AND e.date = m.date""", "economic"), ["unemployment_rate", "mortgage_rate_30yr"]))
def c34(spark, d):
    t = T(spark, d)
    u = bindings.economic(t).select(F.col("city").alias("metro"), "date", "unemployment_rate")
    weekly = t.lineitem.groupBy(F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 25).cast("string")).alias("metro"),
                                F.date_trunc("week", "l_shipdate").cast("date").alias("week")) \
                       .agg((F.avg(F.col("l_discount") * 100.0)).alias("rate"))
    return ingest.economic_monthly(u, weekly)


@register("c35_acs_load", O.rounded(O.sql("""
SELECT zip_or_municipio AS geo_id, year, CAST(population AS INT) AS total_population,
       CASE WHEN median_income_usd >= 0 THEN CAST(median_income_usd AS INT) END AS median_household_income_usd,
       1e2 * CAST(floor(pct_homeowner * 10) AS BIGINT) / 1000 AS pct_homeowner
FROM demographics WHERE country_code = 'US'""", "demographics"), ["pct_homeowner"]))
def c35(spark, d):
    from pyspark.sql import types as Ty
    dm = bindings.demographics(T(spark, d)).filter(F.col("country_code") == "US")
    header = F.array(*[F.lit(x) for x in ["zip code tabulation area", "YEAR", "B01003_001E", "B19013_001E", "OWN", "HH"]])
    row = F.array(F.col("zip_or_municipio"), F.col("year").cast("string"), F.col("population").cast("string"),
                  F.when(F.col("median_income_usd") < 0, F.lit("-666666666")).otherwise(F.col("median_income_usd").cast("string")),
                  F.floor(F.col("pct_homeowner") * 10).cast("bigint").cast("string"), F.lit("1000"))
    landed = dm.groupBy("country_code", "zip_or_municipio") \
               .agg(F.collect_list(row).alias("rows")) \
               .select(F.to_json(F.concat(F.array(header), F.col("rows"))).alias("payload"))
    parsed = payloads.parse_header_matrix(landed, "payload", {"geo_id": "zip code tabulation area", "year": "YEAR",
                                                              "population": "B01003_001E", "income": "B19013_001E",
                                                              "owners": "OWN", "households": "HH"})
    rows = ingest.acs_rows(parsed)
    target = rows.filter(F.col("year") == 2022).withColumn("total_population", F.lit(None).cast(Ty.IntegerType()))
    return ingest.upsert_by_key(target, rows, ["geo_id", "year"])


@register("c36_amenity_load", O.sql("""
SELECT * FROM (
  SELECT amenity_id, amenity_type, name FROM amenities WHERE amenity_type IN ('grocery', 'park', 'hospital', 'transit_stop', 'pharmacy')
  UNION ALL
  SELECT amenity_id, amenity_type, 'old' AS name FROM amenities WHERE CAST(amenity_id AS BIGINT) % 2 = 0
    AND amenity_type NOT IN ('grocery', 'park', 'hospital', 'transit_stop', 'pharmacy')) x""", "amenities"))
def c36(spark, d):
    parsed = cs.s14(spark, d)
    a = bindings.amenities(T(spark, d))
    target = a.filter(F.col("amenity_id").cast("bigint") % 2 == 0).select("amenity_id", "amenity_type", F.lit("old").alias("name"))
    return ingest.upsert_by_key(target, parsed, ["amenity_id"]).select("amenity_id", "amenity_type", "name")
