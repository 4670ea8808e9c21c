"""t14: the answers of all tools for a table of validated calls, in one job.

Calls with equal parameters are one request. A tool is answered for all its requests by equi-joins with tables that are reduced first: rows
of requested cities only, one row an area for averages and first matches, a bounded number of rows an area for top-k tools; listings and
opportunities, where each request brings its own bounds, go through ``bounded_topk``. Cities match whatever their letter case. An answer is
a JSON text as the single tools give it: a list of rows, an object, or an object with a message.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels, numbers
from ..operators import median
from ..operators.topk import bounded_topk
from . import tools
from .gold import scorecard_by_area
from .silver import risk_by_area

AREA = ["country_code", "area"]
_JSON = {"ignoreNullFields": "false"}
LISTING_FIELDS = ["listing_id", "city", "zip_or_municipio", "price_usd", "bedrooms", "bathrooms", "area_sqft", "property_type",
                  "neighborhood_score", "hazard_risk_label"]
# Parameters of the calls, and what a request without them uses.
TEXTS = ["country_code", "city", "zip_or_municipio", "barrio", "property_type", "us_city", "co_city", "amenity_types"]
NUMBERS = ["min_price_usd", "max_price_usd", "bedrooms_min", "bathrooms_min", "annual_income_usd", "down_payment_usd"]
COUNTS = ["limit", "months_back", "years_back"]
LIMITS = {"get_nearby_amenities": 20}


@dataclass
class ToolTables:
    """What the tools read."""
    listings: DataFrame
    scorecard: DataFrame
    risk: DataFrame
    market_summary: DataFrame
    opportunities: DataFrame
    city_pairs: DataFrame
    comparison_index: DataFrame
    crime: DataFrame
    schools: DataFrame
    weather: DataFrame
    demographics: DataFrame
    amenities: DataFrame
    economic: DataFrame
    fx_rate: DataFrame


def requests_of(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, call_order, tool, rid (equal for equal tools and parameters) and the parameters as columns, blank texts as NULL."""
    params = F.coalesce("params", F.create_map().cast("map<string,string>"))
    rid = F.sha2(F.concat_ws("\x1f", F.col("tool"), F.to_json(F.array_sort(F.map_entries(params)))), 256)

    def text(k: str) -> Column:
        v = F.element_at("params", F.lit(k))
        return F.when(F.trim(v) != "", v)
    return calls.select(*keys, "call_order", "tool", rid.alias("rid"), *[text(k).alias(f"p_{k}") for k in TEXTS],
                        *[text(k).try_cast("double").alias(f"p_{k}") for k in NUMBERS], *[text(k).try_cast("int").alias(f"p_{k}") for k in COUNTS],
                        text("country_code").alias("country_code"), F.lower(text("city")).alias("area"))


def _number(c) -> Column:
    """A number as JSON shows it: six places."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("decimal(24,6)")


def _numbers(columns: Sequence[str]) -> list[Column]:
    return [_number(c).alias(c) for c in columns]


def _lists(asked: DataFrame, rows: DataFrame, fields: Sequence) -> DataFrame:
    """rid, result_json: the rows (rid, rank and fields) of each request as a list, which may be empty."""
    of = rows.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(*fields).alias("row")))).alias("_rows"))
    return asked.select("rid").join(of, "rid", "left").select(
        "rid", F.coalesce(F.to_json(F.transform("_rows", lambda x: x["row"]), _JSON), F.lit("[]")).alias("result_json"))


def _object(found: DataFrame, hit: Column, fields: Sequence, message: Column) -> DataFrame:
    """rid, result_json: one row a request, an object of ``fields`` or a message."""
    text = F.when(hit, F.to_json(F.struct(*fields), _JSON)).otherwise(F.to_json(F.struct(message.alias("message"))))
    return found.select("rid", text.alias("result_json"))


def _where_from() -> Column:
    return F.concat_ws("/", "p_country_code", "p_city")


def _asked_rows(asked: DataFrame, rows: DataFrame, city: str = "city") -> DataFrame:
    """The rows of requested cities, with ``area``, the city in lower case."""
    return rows.withColumn("area", F.lower(city)).join(asked.select(*AREA).distinct(), AREA, "left_semi")


def _levels(rows: DataFrame, zip_col: str, barrio: str | None = None) -> DataFrame:
    """Every row once for each set of optional parts of an address that a request may give: ``_z`` and ``_b``, NULL if not given."""
    none = F.lit(None).cast("string")
    options = [(none, none), (F.col(zip_col), none)]
    if barrio:
        options += [(none, F.lower(barrio)), (F.col(zip_col), F.lower(barrio))]
    given = [F.lit(True), F.col(zip_col).isNotNull()] + ([F.col(barrio).isNotNull(), F.col(zip_col).isNotNull() & F.col(barrio).isNotNull()] if barrio else [])
    level = F.explode(F.array_compact(F.array(*[F.when(g, F.struct(z.alias("_z"), b.alias("_b"))) for (z, b), g in zip(options, given, strict=True)])))
    return rows.withColumn("_level", level).withColumn("_z", F.col("_level._z")).withColumn("_b", F.col("_level._b")).drop("_level")


def _at_level(asked: DataFrame, rows: DataFrame, how: str, barrio: bool = False) -> DataFrame:
    """Requests with the rows of the level that their zip (and barrio) name."""
    a, r = asked.alias("a"), rows.alias("r")
    on = [F.col(f"a.{k}") == F.col(f"r.{k}") for k in AREA] + [F.col("a.p_zip_or_municipio").eqNullSafe(F.col("r._z"))]
    if barrio:
        on.append(F.lower("a.p_barrio").eqNullSafe(F.col("r._b")))
    return a.join(r, on, how).select("a.*", *[F.col(f"r.{c}") for c in rows.columns if c not in (*AREA, "_z", "_b")])


def _search(t: ToolTables, asked: DataFrame) -> DataFrame:
    rows = t.listings.withColumn("area", F.lower("city"))
    top = bounded_topk(asked.select("rid", *AREA, "p_limit", *[f"p_{c}" for c in NUMBERS], "p_property_type"),
                       rows, "rid", AREA, "price_usd", "listing_id", "p_limit", tools.MAX_LIMIT,
                       bounds=[("price_usd", "p_min_price_usd", "p_max_price_usd"), ("bedrooms", "p_bedrooms_min", None), ("bathrooms", "p_bathrooms_min", None)],
                       equals=[("property_type", "p_property_type")])
    score = scorecard_by_area(t.scorecard).select("country_code", "zip_or_municipio", F.col("composite_score").alias("neighborhood_score"))
    label = risk_by_area(t.risk).select("country_code", "zip_or_municipio", F.col("risk_label").alias("hazard_risk_label"))
    top = top.join(score, ["country_code", "zip_or_municipio"], "left").join(label, ["country_code", "zip_or_municipio"], "left")
    decimals = ("bathrooms", "area_sqft", "neighborhood_score")
    return _lists(asked, top, [_number(c).alias(c) if c in decimals else F.col(c) for c in LISTING_FIELDS])


def _first_or_mean(asked: DataFrame, rows: DataFrame, order: Sequence[str], metrics: Sequence[str], shown: Sequence[str], has: str, zip_col: str,
                   barrio: str | None, none: str) -> DataFrame:
    """The first row of the area, else the means of the whole city (if ``has`` has one), else a message."""
    rows = _asked_rows(asked, rows)
    first = _levels(rows, zip_col, barrio).groupBy(*AREA, "_z", "_b").agg(F.min(F.struct(*order, *[c for c in (*shown, *metrics) if c not in order])).alias("_row"))
    mean = rows.groupBy(*AREA).agg(*[F.avg(c).alias(c) for c in metrics])
    found = _at_level(asked, first, "left", barrio is not None).join(mean, AREA, "left")
    row = F.struct(*[F.col(f"_row.{c}").alias(c) for c in shown], *[_number(f"_row.{c}").alias(c) for c in metrics])
    means = F.struct(*_numbers(metrics), F.col("p_country_code").alias("country_code"), F.col("p_city").alias("city"), F.lit(True).alias("aggregate"))
    text = (F.when(F.col("_row").isNotNull(), F.to_json(row, _JSON)).when(F.col(has).isNotNull(), F.to_json(means, _JSON))
            .otherwise(F.to_json(F.struct(F.concat(F.lit(none), _where_from()).alias("message")))))
    return found.select("rid", text.alias("result_json"))


def _profile(t: ToolTables, asked: DataFrame) -> DataFrame:
    return _first_or_mean(asked, t.scorecard, ["profile_id"], tools.PROFILE_METRICS, ["profile_id", "zip_or_municipio", "barrio"], "composite_score",
                          "zip_or_municipio", "barrio", "No profile found for ")


def _hazards(t: ToolTables, asked: DataFrame) -> DataFrame:
    return _first_or_mean(asked, t.risk, ["geo_id", *tools.RISK_METRICS], tools.RISK_METRICS, ["geo_id", "risk_label"], "composite_hazard_score",
                          "zip_or_municipio", None, "No hazard profile for ")


def _crime(t: ToolTables, asked: DataFrame) -> DataFrame:
    us = F.col("country_code") == "US"
    kind = F.when(us, labels.crime_category_incident("crime_type")).otherwise(labels.crime_category_spanish("crime_type"))
    n = F.sum(F.when(us, F.lit(1)).otherwise(F.coalesce("count", F.lit(0)))).cast("bigint").alias("n")
    by_kind = _asked_rows(asked, t.crime).groupBy(*AREA, kind.alias("kind")).agg(n)
    of = by_kind.groupBy(*AREA).agg(F.array_sort(F.collect_list(F.struct("kind", "n"))).alias("kinds"), F.sum("n").alias("total_incidents"))
    return _object(asked.join(of, AREA, "left"), F.col("kinds").isNotNull(),
                   [F.col("p_country_code").alias("country_code"), F.col("p_city").alias("city"), F.map_from_entries("kinds").alias("category_counts"), "total_incidents"],
                   F.concat(F.lit("No crime data for "), _where_from()))


def _best_rows(asked: DataFrame, rows: DataFrame, order: Sequence[Column], most: int, zip_col: str) -> DataFrame:
    """Of each requested city, and of each of its zips, the first ``most`` rows."""
    w = Window.partitionBy(*AREA, "_z").orderBy(*order)
    return _levels(_asked_rows(asked, rows), zip_col).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).drop("_b")


def _schools(t: ToolTables, asked: DataFrame) -> DataFrame:
    rows = _best_rows(asked, t.schools, [F.col("school_score_normalized").desc_nulls_last(), F.col("school_id")], tools.MAX_LIMIT, "zip_or_municipio")
    rows = _at_level(asked, rows, "inner").where(F.col("rank") <= F.col("p_limit"))
    return _lists(asked, rows, ["school_id", "city", _number("school_score_normalized").alias("school_score_normalized")])


def _weather(t: ToolTables, asked: DataFrame) -> DataFrame:
    extreme = labels.is_extreme_day("precipitation_mm", "wind_speed_max_kmh", "temp_max_c", "temp_min_c").cast("int")
    measures = ["temp_max_c", "temp_min_c", "precipitation_mm"]
    years = _asked_rows(asked, t.weather).groupBy(*AREA, F.year("date").alias("year")).agg(
        *[f(c).alias(f"{c}_{e}") for c in measures for f, e in ((F.sum, "sum"), (F.count, "n"))],
        F.sum(extreme).alias("extreme"), F.min("date").alias("first"), F.max("date").alias("last"))
    newest = years.groupBy(*AREA).agg(F.max("year").alias("newest"))
    kept = asked.join(years, AREA).join(newest, AREA).where(F.col("p_years_back").isNull() | (F.col("year") >= F.col("newest") - F.col("p_years_back")))
    of = kept.groupBy("rid").agg(*[F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(f"avg_{c}") for c in measures],
                                 F.sum("extreme").cast("bigint").alias("total_extreme_days"), F.count("year").alias("years_covered"),
                                 F.min("first").alias("first_date"), F.max("last").alias("last_date"))
    per_year = F.try_divide(F.col("total_extreme_days").cast("double"), F.col("years_covered"))
    return _object(asked.join(of, "rid", "left"), F.col("avg_temp_max_c").isNotNull(),
                   [*_numbers([f"avg_{c}" for c in measures]), "total_extreme_days", "years_covered", F.col("first_date").cast("string").alias("first_date"),
                    F.col("last_date").cast("string").alias("last_date"), _number(per_year).alias("extreme_days_per_year"),
                    F.col("p_country_code").alias("country_code"), F.col("p_city").alias("city")], F.concat(F.lit("No weather data for "), _where_from()))


def _market(t: ToolTables, asked: DataFrame) -> DataFrame:
    rows = _best_rows(asked, t.market_summary, [F.col("date").desc(), F.col("zip_or_municipio").desc()], tools.MAX_MONTHS, "zip_or_municipio")
    rows = _at_level(asked, rows, "inner").where(F.col("rank") <= F.col("p_months_back"))
    point = F.struct(F.col("date").cast("string").alias("date"), "median_price_usd", "inventory_count")
    trends = ["price_trend_3mo_pct", "price_trend_12mo_pct"]
    of = rows.groupBy("rid").agg(F.min_by(F.struct("date", "median_price_usd", *trends, "median_days_on_market", "market_temp"), "rank").alias("l"),
                                 F.sort_array(F.collect_list(F.struct((-F.col("rank")).alias("k"), point.alias("p")))).alias("s"))
    return _object(asked.join(of, "rid", "left"), F.col("l").isNotNull(),
                   [F.col("p_country_code").alias("country_code"), F.col("p_city").alias("city"), F.col("p_zip_or_municipio").alias("zip_or_municipio"),
                    F.col("l.date").cast("string").alias("latest_date"), F.col("l.median_price_usd").alias("latest_median_price_usd"),
                    *[_number(f"l.{c}").alias(c) for c in trends], F.col("l.median_days_on_market").alias("median_days_on_market"),
                    F.col("l.market_temp").alias("market_temp"), F.transform("s", lambda x: x["p"]).alias("monthly_series")],
                   F.concat(F.lit("No market data for "), _where_from()))


def _demographics(t: ToolTables, asked: DataFrame) -> DataFrame:
    """A zip or municipio; without one, the city in CO (whose municipios bear city names) and the whole country in the US."""
    def sums(keys: list[str]) -> DataFrame:
        return t.demographics.withColumn("_place", F.lower("zip_or_municipio")).groupBy(*keys).agg(
            F.sum("population").alias("population"), F.avg("median_income_usd").alias("median_income"), F.avg("pct_homeowner").alias("pct_homeowner"))
    place = F.coalesce(F.lower("p_zip_or_municipio"), F.when(F.col("country_code") == "CO", F.col("area")))
    near = asked.withColumn("_place", place)
    found = near.where("_place IS NOT NULL").join(sums(["country_code", "_place"]), ["country_code", "_place"], "left").unionByName(
        near.where("_place IS NULL").join(sums(["country_code"]), "country_code", "left"))
    found = found.crossJoin(F.broadcast(t.fx_rate))                              # one row
    usd = F.when(F.col("country_code") == "CO", F.col("median_income") / F.col("fx_rate")).otherwise(F.col("median_income"))
    return _object(found, F.col("population").isNotNull(),
                   ["population", *_numbers(["median_income", "pct_homeowner"]), _number(usd).alias("median_income_usd"),
                    F.col("p_country_code").alias("country_code"), F.col("p_city").alias("city")], F.concat(F.lit("No demographics found for "), _where_from()))


def _amenities(t: ToolTables, asked: DataFrame) -> DataFrame:
    """Of each city and type the first rows; a request takes those of its types, or of all."""
    w = Window.partitionBy(*AREA, "amenity_type").orderBy("name", "amenity_id")
    rows = _asked_rows(asked, t.amenities).withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= tools.MAX_LIMIT)
    wanted = asked.withColumn("_types", F.from_json("p_amenity_types", "array<string>"))
    rows = wanted.join(rows, AREA).where(F.col("_types").isNull() | (F.size("_types") == 0) | F.array_contains("_types", F.col("amenity_type")))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("rid").orderBy("amenity_type", "name", "amenity_id")))
    return _lists(asked, rows.where(F.col("rank") <= F.col("p_limit")), ["amenity_id", "amenity_type", "name"])


def _compare(t: ToolTables, asked: DataFrame) -> DataFrame:
    """Stored pairs first; medians only for the cities of pairs that are not stored."""
    pairs = asked.select(F.lower("p_us_city").alias("_us"), F.lower("p_co_city").alias("_co")).distinct()
    stored = t.city_pairs.groupBy(F.lower("us_city").alias("_us"), F.lower("co_city").alias("_co")).agg(
        F.max_by(F.struct("comparison_date", "price_ratio", "us_composite_score", "co_composite_score"), "comparison_date").alias("s"))
    lacking = pairs.join(stored, ["_us", "_co"], "left_anti")
    cities = lacking.select(F.lit("US").alias("country_code"), F.col("_us").alias("area")).union(lacking.select(F.lit("CO"), "_co")).distinct()
    index = t.comparison_index.withColumn("area", F.lower("city")).join(cities, AREA, "left_semi")
    dims = tools.INDEX_DIMS
    mid = median.exact_medians(index, AREA, dims).select(*AREA, F.struct(*_numbers(dims)).alias("m"), F.coalesce(*dims).isNotNull().alias("ok"))
    us = mid.where("country_code = 'US' AND ok").select(F.col("area").alias("_us"), F.col("m").alias("us_metrics"))
    co = mid.where("country_code = 'CO' AND ok").select(F.col("area").alias("_co"), F.col("m").alias("co_metrics"))
    found = (asked.withColumn("_us", F.lower("p_us_city")).withColumn("_co", F.lower("p_co_city")).join(stored, ["_us", "_co"], "left")
             .join(us, "_us", "left").join(co, "_co", "left"))
    cities_ = [F.col("p_us_city").alias("us_city"), F.col("p_co_city").alias("co_city")]
    pair = F.struct(*cities_, F.col("s.comparison_date").cast("string").alias("comparison_date"),
                    *[_number(f"s.{c}").alias(c) for c in ("price_ratio", "us_composite_score", "co_composite_score")])
    medians = F.struct(*cities_, "us_metrics", "co_metrics", F.lit(True).alias("aggregate"))
    message = F.concat(F.lit("Insufficient data to compare "), F.concat_ws(" vs ", "p_us_city", "p_co_city"))
    text = (F.when(F.col("s").isNotNull(), F.to_json(pair, _JSON)).when(F.col("us_metrics").isNotNull() & F.col("co_metrics").isNotNull(), F.to_json(medians, _JSON))
            .otherwise(F.to_json(F.struct(message.alias("message")))))
    return found.select("rid", text.alias("result_json"))


def _affordability(t: ToolTables, asked: DataFrame) -> DataFrame:
    rate = t.economic.where("mortgage_rate_30yr IS NOT NULL").groupBy("country_code").agg(
        F.max_by("mortgage_rate_30yr", F.struct("date", "city")).alias("_rate"))
    rows = _asked_rows(asked, t.market_summary)
    latest = rows.groupBy(*AREA).agg(F.max("date").alias("date"))
    price = median.exact_median(rows.join(latest, [*AREA, "date"]), AREA, "median_price_usd", "area_median_price_usd")
    found = (asked.join(rate, "country_code", "left").join(price, AREA, "left")
             .withColumn("_r", F.coalesce("_rate", F.lit(numbers.DEFAULT_MORTGAGE_RATE))).withColumn("_down", F.coalesce("p_down_payment_usd", F.lit(0.0))))
    most = numbers.max_affordable_price(F.col("p_annual_income_usd"), "_r", F.col("_down"))
    return _object(found, F.col("p_annual_income_usd").isNotNull(),
                   [F.col("p_country_code").alias("country_code"), F.col("p_city").alias("city"), _number("p_annual_income_usd").alias("annual_income_usd"),
                    _number("_down").alias("down_payment_usd"), _number("_r").alias("mortgage_rate_pct"),
                    F.when(F.col("_rate").isNull(), tools.RATE_NOTES[0]).otherwise(tools.RATE_NOTES[1]).alias("rate_note"),
                    F.floor(most).alias("max_price_usd"), F.floor(F.col("p_annual_income_usd") * numbers.HOUSING_SHARE / 12).alias("estimated_monthly_payment"),
                    F.floor("area_median_price_usd").alias("median_price_usd_in_area"), (most >= F.col("area_median_price_usd")).alias("can_afford_median")],
                   F.lit("annual_income_usd is missing"))


def _opportunities(t: ToolTables, asked: DataFrame) -> DataFrame:
    top = bounded_topk(asked.select("rid", *AREA, "p_limit", "p_max_price_usd"), t.opportunities.withColumn("area", F.lower("city")), "rid", AREA,
                       "discount_pct", "listing_id", "p_limit", tools.MAX_LIMIT, ascending=False, bounds=[("price_usd", None, "p_max_price_usd")])
    return _lists(asked, top, ["listing_id", "price_usd", _number("area_median_price_usd").alias("area_median_price_usd"), _number("discount_pct").alias("discount_pct")])


ACCESS = ["amenity_density_score", "transit_access_score", "grocery_count", "park_count", "hospital_count", "transit_stop_count"]


def _access(t: ToolTables, asked: DataFrame) -> DataFrame:
    mean = _levels(_asked_rows(asked, t.scorecard), "zip_or_municipio").groupBy(*AREA, "_z").agg(*[F.avg(c).alias(f"avg_{c}") for c in ACCESS])
    return _object(_at_level(asked, mean, "left"), F.col("avg_amenity_density_score").isNotNull(),
                   [*_numbers([f"avg_{c}" for c in ACCESS]), F.col("p_country_code").alias("country_code"), F.col("p_city").alias("city")],
                   F.concat(F.lit("No amenity data for "), _where_from()))


ANSWERS = {"search_listings": _search, "get_neighborhood_profile": _profile, "get_crime_stats": _crime, "get_school_rankings": _schools,
           "get_weather_summary": _weather, "get_hazard_risks": _hazards, "get_market_trends": _market, "get_area_demographics": _demographics,
           "get_nearby_amenities": _amenities, "compare_cities": _compare, "get_affordability_analysis": _affordability,
           "get_value_opportunities": _opportunities, "get_amenity_access": _access}


def distinct_requests(typed: DataFrame) -> DataFrame:
    """One row a request, with the limits that a call without them gets."""
    limit = reduce(lambda c, x: c.when(F.col("tool") == x[0], x[1]), LIMITS.items(), F.when(F.lit(False), 0)).otherwise(tools.DEFAULT_LIMIT)
    names = [c for c in typed.columns if c == "rid" or c.startswith("p_") or c in ("tool", *AREA)]
    def clamped(c: str, most: int, default: Column) -> Column:            # greatest and least pass over NULL
        return F.when(F.col(c).isNull(), default).otherwise(F.greatest(F.lit(1), F.least(F.col(c), F.lit(most))))
    return (typed.select(*names).dropDuplicates(["rid"]).withColumn("p_limit", clamped("p_limit", tools.MAX_LIMIT, limit))
            .withColumn("p_months_back", clamped("p_months_back", tools.MAX_MONTHS, F.lit(12))))


def answer_requests(requests: DataFrame, t: ToolTables) -> DataFrame:
    """rid, result_json of every request (``distinct_requests``, read once a tool: a written table). Unknown tools get a message."""
    parts = [answer(t, requests.where(F.col("tool") == tool)) for tool, answer in ANSWERS.items()]
    unknown = requests.where(~F.col("tool").isin(list(ANSWERS))).select("rid", F.to_json(F.struct(F.lit("unsupported tool").alias("message"))).alias("result_json"))
    return reduce(DataFrame.unionByName, parts, unknown)
