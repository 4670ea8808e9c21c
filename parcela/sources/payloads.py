"""Parsers for landed JSON payloads held in a text column (s07-s14, s22, s23).

Each parser is ``DataFrame -> DataFrame``: ``from_json`` with a tolerant schema
(every alternative field name declared, scalars read as strings), ``explode``
to rows, ``coalesce`` over the alternatives and NULL-safe casts. Parsing runs
in the executors, one payload per row, so ingest scales with the number of
landed files instead of a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, labels, numbers, text

S = T.StringType()


def _struct(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


def _first(item: str, names: Sequence[str]) -> Column:
    return F.coalesce(*[text.safe_str(F.col(f"{item}.{n}")) for n in names])


# --- s07 listing pages ---------------------------------------------------------------------
LISTING_FIELDS = {
    "listing_id": ["zpid", "listingId", "id", "propertyId"],
    "property_type": ["homeType", "propertyType"],
    "price": ["price", "listPrice"],
    "sqft": ["livingArea", "sqft", "livingAreaValue"],
    "address": ["address", "streetAddress"],
    "city": ["city"],
    "state": ["state", "stateAbbreviation"],
    "zip": ["zipcode", "postalCode", "zip"],
    "lat": ["latitude", "lat"],
    "lon": ["longitude", "lon", "lng"],
    "bedrooms": ["bedrooms", "beds"],
    "bathrooms": ["bathrooms", "baths"],
    "description": ["description", "homeStatus"],
    "listing_url": ["detailUrl", "hdpUrl", "url"],
    "days_on_market": ["daysOnZillow", "daysOnMarket"],
    "listing_date": ["listingDate", "datePosted", "listingDateMs"],
    "status_type": ["statusType", "listingStatus"],
    "home_status": ["homeStatus"],
    "listing_type": ["listingType"],
}
LISTING_NUMBERS = {"price", "sqft", "lat", "lon", "bedrooms", "bathrooms", "days_on_market"}
HOME_TYPES = {"SINGLE_FAMILY": "single_family", "CONDO": "condo", "TOWNHOUSE": "townhouse",            # fixed values
              "MULTI_FAMILY": "multi_family", "MANUFACTURED": "single_family", "APARTMENT": "condo"}
ARRAY_KEYS = ["results", "properties", "props", "listings", "data"]


def _item_schema() -> T.StructType:
    names = sorted({n for alts in LISTING_FIELDS.values() for n in alts})
    return _struct(names)


def listing_page_schema() -> T.StructType:
    arr = T.ArrayType(_item_schema())
    inner = T.StructType([T.StructField(k, arr) for k in ARRAY_KEYS if k != "data"])
    # 'data' is either the array itself or an object holding one of the arrays
    return T.StructType([T.StructField(k, arr) for k in ARRAY_KEYS if k != "data"]
                        + [T.StructField("data", S)]), inner


def parse_listing_pages(df: DataFrame, payload_col: str, keep=(), position: str | None = None) -> DataFrame:
    """s07: one row per listing item of a root-level list, or found under any of the array keys (or one
    level inside ``data``), alternative field names coalesced, home types mapped (others NULL), sale filter (p14)
    applied, the whole landed page kept as ``raw_json``, the item's place on its page as ``position``, if named."""
    outer, inner = listing_page_schema()
    arr_t = T.ArrayType(_item_schema())
    root = F.ltrim(F.col(payload_col)).startswith("[")
    p = df.select(*keep, F.col(payload_col).alias("_raw"), F.when(~root, F.from_json(F.col(payload_col), outer)).alias("_p"),
                  F.when(root, F.from_json(F.col(payload_col), arr_t)).alias("_list"))
    is_arr = F.ltrim(F.col("_p.data")).startswith("[")
    # a column of its own: a parse named by several alternatives would be run for each of them
    p = p.select("*", F.when(~is_arr, F.from_json(F.col("_p.data"), inner)).alias("_o"))
    data_arr = F.when(is_arr, F.from_json(F.col("_p.data"), arr_t))
    items = F.coalesce(F.col("_list"), *[F.col(f"_p.{k}") for k in ARRAY_KEYS if k != "data"], data_arr,
                       *[F.col(f"_o.{k}") for k in ARRAY_KEYS if k != "data"])
    # id and sale filter are resolved inside the list. The other names follow in a step that is compiled in several methods, as a
    # function over an array is among its columns: as one method they would be too long for the JVM to compile

    def named(it: Column, k: str) -> list[Column]:
        return [text.safe_str(it[n]) for n in LISTING_FIELDS[k]]
    marks = ["status_type", "home_status", "listing_type"]
    found = F.transform(items, lambda it, i: F.struct(i.alias("_place"), it.alias("_f"), *[F.coalesce(*named(it, k)).alias(k) for k in ["listing_id", *marks]]))
    kept = F.filter(found, lambda it: it["listing_id"].isNotNull() & labels.is_for_sale(*[it[k] for k in marks]))
    e = p.select(*keep, "_raw", F.explode(kept).alias("it"))
    rest = [k for k in LISTING_FIELDS if k not in ("listing_id", "listing_date", *marks)]
    listed = F.try_element_at(F.filter(F.array(*named(F.col("it._f"), "listing_date")), lambda d: d.isNotNull()), F.lit(1))
    e = e.select(*keep, "_raw", "it._place", "it.listing_id", *[F.coalesce(*named(F.col("it._f"), k)).alias(k) for k in rest], listed.alias("listing_date"))
    e = e.withColumns({k: numbers.safe_float(k) for k in sorted(LISTING_NUMBERS)} | {"listing_date": dates.parse_listing_date("listing_date")})
    g = {k: F.col(k) for k in LISTING_FIELDS}
    price = g["price"].try_cast("long")
    sqft = numbers.whole(g["sqft"])
    home_types = F.create_map(*[F.lit(x) for kv in HOME_TYPES.items() for x in kv])
    return e.select(
        *keep,
        g["listing_id"].alias("listing_id"),
        g["address"].alias("address"), g["city"].alias("city"), g["state"].alias("state"), g["zip"].alias("zip"),
        g["lat"].alias("lat"), g["lon"].alias("lon"),
        price.alias("price_usd"), numbers.whole(g["bedrooms"]).alias("bedrooms"),
        g["bathrooms"].alias("bathrooms"), sqft.alias("sqft"),
        numbers.price_per_area(price, sqft).alias("price_per_sqft_usd"),
        F.element_at(home_types, F.upper(g["property_type"])).alias("property_type"), g["description"].alias("description"),
        g["listing_url"].alias("listing_url"), numbers.whole(g["days_on_market"]).alias("days_on_market"),
        g["listing_date"],
        *([F.col("_place").alias(position)] if position else []), F.col("_raw").alias("raw_json"))


# --- s08 parallel arrays --------------------------------------------------------------------
WEATHER_ARRAYS = {"time": "date", "temperature_2m_max": "temp_max_c", "temperature_2m_min": "temp_min_c",
                  "precipitation_sum": "precipitation_mm", "windspeed_10m_max": "wind_speed_max_kmh",
                  "weathercode": "weather_code"}


def parse_daily_arrays(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """s08: ``daily.time[i]`` aligned with ``daily.<var>[i]``; a missing array gives NULLs."""
    arr = T.ArrayType(S)
    sch = T.StructType([T.StructField("daily", T.StructType([T.StructField(k, arr) for k in WEATHER_ARRAYS]))])
    p = df.select(*keep, F.from_json(F.col(payload_col), sch).alias("_p"))
    n = F.size(F.col("_p.daily.time"))
    z = p.filter(n > 0).select(*keep, F.col("_p.daily").alias("d"), F.posexplode(F.col("_p.daily.time")).alias("_i", "_t"))
    cols = [F.col("_t").try_cast("date").alias("date")]
    for k, name in WEATHER_ARRAYS.items():
        if k == "time":
            continue
        v = F.try_element_at(F.col(f"d.{k}"), F.col("_i") + 1)
        cols.append((v.try_cast("int") if name == "weather_code" else v.try_cast("double")).alias(name))
    out = z.select(*keep, *cols)
    return out.withColumn("temp_mean_c", (F.col("temp_max_c") + F.col("temp_min_c")) / 2.0) \
              .withColumn("is_extreme_day", labels.is_extreme_day("precipitation_mm", "wind_speed_max_kmh",
                                                                  "temp_max_c", "temp_min_c"))


# --- s09 header matrix ----------------------------------------------------------------------
def parse_header_matrix(df: DataFrame, payload_col: str, fields: dict[str, str], keep=(),
                        sentinels=("-666666666", "-999999999", "")) -> DataFrame:
    """s09: ``[[header...], [row...], ...]`` -> one row per data row, columns looked up by header name."""
    p = df.select(*keep, F.from_json(F.col(payload_col), T.ArrayType(T.ArrayType(S))).alias("_m"))
    p = p.withColumn("_h", F.element_at("_m", 1))
    e = p.select(*keep, "_h", F.posexplode("_m").alias("_pos", "_row")).filter(F.col("_pos") > 0)
    cols = []
    for out, name in fields.items():
        at = F.nullif(F.array_position(F.col("_h"), F.lit(name)).cast("int"), F.lit(0))
        v = F.try_element_at(F.col("_row"), at)                     # a short row has NULLs
        cols.append(F.when(~v.isin(list(sentinels)), v).alias(out))
    return e.select(*keep, *cols)


# --- s10 keyed object / list / results wrapper ---------------------------------------------
def parse_keyed_records(df: DataFrame, payload_col: str, fields: Sequence[str], key_field: str = "ori",
                        keep=()) -> DataFrame:
    """s10: object keyed by id, or a list, or ``{"results": [...]}`` -> rows with ``key_field``."""
    rec = _struct(list(fields) + [key_field])
    as_map = F.from_json(F.col(payload_col), T.MapType(S, rec))
    as_list = F.from_json(F.col(payload_col), T.ArrayType(rec))
    as_res = F.from_json(F.col(payload_col), T.StructType([T.StructField("results", T.ArrayType(rec))]))
    t = F.ltrim(F.col(payload_col))
    # A {"results": [...]} wrapper parses as a map too; prefer the wrapper when present.
    entries = (F.when(t.startswith("["), F.transform(as_list, lambda r: F.struct(r[key_field].alias("k"), r.alias("v"))))
                .when(as_res["results"].isNotNull(), F.transform(as_res["results"], lambda r: F.struct(r[key_field].alias("k"), r.alias("v"))))
                .otherwise(F.map_entries(as_map).cast(T.ArrayType(T.StructType([T.StructField("k", S), T.StructField("v", rec)])))))
    e = df.select(*keep, F.explode(entries).alias("_e"))
    return e.select(*keep, F.coalesce(F.col(f"_e.v.{key_field}"), F.col("_e.k")).alias(key_field),
                    *[F.col(f"_e.v.{f}").alias(f) for f in fields])


# --- s11 nested map sum ---------------------------------------------------------------------
def sum_year_counts(df: DataFrame, payload_col: str, year: str, keep=()) -> DataFrame:
    """s11: sum one year's value over ``offenses.actuals`` (map of maps); else the
    sum of a list of monthly ``count|value|actual`` entries."""
    return sum_counts_of_years(df, payload_col, [year], keep).drop("year")


def sum_counts_of_years(df: DataFrame, payload_col: str, years: Sequence[str], keep=()) -> DataFrame:
    """s11 for several years: one row a payload and year (``year``, as text), every payload parsed once."""
    nested = T.StructType([T.StructField("offenses", T.StructType([
        T.StructField("actuals", T.MapType(S, T.MapType(S, T.DoubleType())))]))])
    lst = T.ArrayType(_struct(["count", "value", "actual"]))
    t = F.ltrim(F.col(payload_col))
    is_list = t.startswith("[")
    p = df.select(*keep, F.when(~is_list, F.from_json(F.col(payload_col), nested)["offenses"]["actuals"]).alias("_m"),
                  F.when(is_list, F.from_json(F.col(payload_col), lst)).alias("_items"))

    def total(year: str) -> Column:
        per = F.transform(F.map_values("_m"), lambda inner: F.coalesce(F.element_at(inner, F.lit(year)), F.lit(0.0)))
        from_map = F.aggregate(per, F.lit(0.0), lambda a, x: a + x)
        from_list = F.aggregate(F.transform("_items", lambda r: F.coalesce(r["count"], r["value"], r["actual"]).try_cast("double")),
                                F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
        return F.coalesce(from_list, from_map)
    e = p.select(*keep, F.explode(F.array(*[F.struct(F.lit(y).alias("year"), total(y).alias("total")) for y in years])).alias("_y"))
    return e.select(*keep, "_y.year", "_y.total")


# --- s12 series ------------------------------------------------------------------------------
def parse_series(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """s12: ``Results.series[].data[]`` -> (series_id, month date, value); keeps M01..M12,
    '.' / '' values dropped."""
    obs = _struct(["year", "period", "value"])
    sch = T.StructType([T.StructField("Results", T.StructType([T.StructField("series", T.ArrayType(
        T.StructType([T.StructField("seriesID", S), T.StructField("data", T.ArrayType(obs))])))]))])
    p = df.select(*keep, F.explode(F.from_json(F.col(payload_col), sch)["Results"]["series"]).alias("_s"))
    e = p.select(*keep, F.col("_s.seriesID").alias("series_id"), F.explode("_s.data").alias("_o"))
    out = e.select(*keep, "series_id", dates.period_month_date(F.col("_o.year"), F.col("_o.period")).alias("date"),
                   numbers.safe_float(F.when(F.col("_o.value") != ".", F.col("_o.value"))).alias("value"))
    return out.filter(F.col("date").isNotNull() & F.col("value").isNotNull())


# --- s13 features -----------------------------------------------------------------------------
def parse_features(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """s13: ``features[].attributes`` -> zone code / area id / county coalesced; all attributes kept as JSON text;
    features without an area id are dropped."""
    attrs = _struct(["FLD_ZONE", "ZONE_SUBTY", "ZONE", "FLD_AR_ID", "DFIRM_ID", "OBJECTID", "COUNTY", "CO_FIPS"])
    sch = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("attributes", S)])))])
    e = df.select(*keep, F.explode(F.from_json(F.col(payload_col), sch)["features"]).alias("_f"))
    e = e.select(*keep, F.col("_f.attributes").alias("_raw"), F.from_json("_f.attributes", attrs).alias("_a"))
    a = "_a"
    zone = _first(a, ["FLD_ZONE", "ZONE_SUBTY", "ZONE"])
    out = e.select(*keep, zone.alias("zone"), _first(a, ["FLD_AR_ID", "DFIRM_ID", "OBJECTID"]).alias("area_id"),
                    _first(a, ["COUNTY", "CO_FIPS"]).alias("county"),
                    labels.flood_zone_risk(zone).alias("risk_score"), F.col("_raw").alias("details_json"))
    return out.where(F.col("area_id").isNotNull())


# --- s14 OSM elements --------------------------------------------------------------------------
AMENITY_TAGS = [("amenity", {"hospital": "hospital", "clinic": "hospital", "pharmacy": "pharmacy",
                             "school": "school", "restaurant": "restaurant"}),
                ("shop", {"supermarket": "grocery", "grocery": "grocery", "convenience": "grocery"}),
                ("leisure", {"park": "park"}),
                ("public_transport", {"station": "transit_stop", "stop_position": "transit_stop",
                                      "platform": "transit_stop"})]


def parse_osm_elements(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """s14: ``elements[]`` nodes -> typed amenity rows (type by tag priority, name, address);
    nodes matching no listed tag are dropped."""
    el = T.StructType([T.StructField("id", S), T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
                       T.StructField("tags", T.MapType(S, S))])
    sch = T.StructType([T.StructField("elements", T.ArrayType(el))])
    e = df.select(*keep, F.explode(F.from_json(F.col(payload_col), sch)["elements"]).alias("_n"))
    tags = F.col("_n.tags")
    typ = None
    for tag, mapping in AMENITY_TAGS:
        for raw, kind in mapping.items():
            cond = F.element_at(tags, F.lit(tag)) == raw
            typ = F.when(cond, kind) if typ is None else typ.when(cond, kind)
    out = e.select(*keep, F.col("_n.id").alias("amenity_id"), F.col("_n.lat").alias("lat"), F.col("_n.lon").alias("lon"),
                   typ.alias("amenity_type"), F.element_at(tags, F.lit("name")).alias("name"),
                   F.coalesce(F.element_at(tags, F.lit("addr:full")), F.element_at(tags, F.lit("addr:street"))).alias("address"))
    return out.filter(F.col("amenity_type").isNotNull())


# --- s22 incidents, s23 directory records ------------------------------------------------------
def parse_incidents(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """s22: ``crimes[]`` -> incident rows; id from cdid or id; ISO date with Z; category (f27)."""
    inc = _struct(["cdid", "id", "type", "date", "lat", "lon"])
    sch = T.StructType([T.StructField("crimes", T.ArrayType(inc))])
    e = df.select(*keep, F.explode(F.from_json(F.col(payload_col), sch)["crimes"]).alias("_c"))
    ts = dates.parse_iso_z(F.col("_c.date"))
    out = e.select(*keep, _first("_c", ["cdid", "id"]).alias("incident_id"), F.lower(F.trim("_c.type")).alias("crime_type"),
                   labels.crime_category_incident(F.col("_c.type")).alias("crime_category"),
                   ts.cast("date").alias("incident_date"), F.year(ts).alias("year"),
                   numbers.safe_float("_c.lat").alias("lat"), numbers.safe_float("_c.lon").alias("lon"))
    return out.filter(F.col("incident_id").isNotNull())


DIRECTORY_FIELDS = ["ncessch", "school_name", "city_location", "city_mailing", "fips", "zip_location", "latitude",
                    "longitude", "lowest_grade_offered", "highest_grade_offered", "enrollment", "charter", "magnet",
                    "title_i_eligible"]


def parse_directory(df: DataFrame, payload_col: str, keep=()) -> DataFrame:
    """s23: paged ``results[]`` -> typed directory rows with field fallbacks."""
    sch = T.StructType([T.StructField("count", S), T.StructField("next", S),
                        T.StructField("results", T.ArrayType(_struct(DIRECTORY_FIELDS)))])
    e = df.select(*keep, F.explode(F.from_json(F.col(payload_col), sch)["results"]).alias("r"))
    return e.select(*keep, text.safe_str("r.ncessch").alias("school_id"), text.safe_str("r.school_name").alias("school_name"),
                    _first("r", ["city_location", "city_mailing"]).alias("city"),
                    numbers.zip_pad("r.fips", 2).alias("state_fips"), numbers.zip_pad("r.zip_location").alias("zip"),
                    numbers.safe_float("r.latitude").alias("lat"), numbers.safe_float("r.longitude").alias("lon"),
                    labels.grade_levels(F.col("r.lowest_grade_offered"), F.col("r.highest_grade_offered")).alias("grade_levels"),
                    numbers.sentinel_null(numbers.safe_int("r.enrollment")).alias("enrollment"),
                    numbers.bool_decode("r.title_i_eligible").alias("title1_eligible"))
