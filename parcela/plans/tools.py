"""Query tools (t01-t14): parameterised read-only queries returning DataFrames.

Each tool filters first (partition / predicate pushdown), reduces to the few
rows it answers with, and never raises for a missing area: the result is then an
empty frame. A one-row city aggregate stands in where no single row matches, decided by
a one-row count (no driver round trip). A row limit is the caller's, and so is
``max_limit`` (50 as the source has it, None for no ceiling).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels, numbers
from ..operators import filters, median
from .gold import scorecard_by_area
from .silver import risk_by_area

DEFAULT_LIMIT = 10
MAX_LIMIT = 50
MAX_MONTHS = 24
RATE_NOTES = ("default rate", "latest rate")


def _area(df: DataFrame, country_code: str, city: str, city_col: str = "city") -> DataFrame:
    return df.filter((F.col("country_code") == country_code) & filters.ci_equals(city_col, city))


def _some(agg: DataFrame) -> DataFrame:
    """A global aggregate that carries its count ``_rows``, without the row it has over no input."""
    return agg.where("_rows > 0").drop("_rows")


def _guarded_fallback(rows: DataFrame, fallback: DataFrame) -> DataFrame:
    """``rows`` if it has any row, else the one-row ``fallback`` (a 1-row count decides)."""
    n = rows.agg(F.count(F.lit(1)).alias("_n"))
    return rows.unionByName(fallback.crossJoin(F.broadcast(n)).filter(F.col("_n") == 0).drop("_n"))


def search_listings(listings: DataFrame, card: DataFrame, risk: DataFrame, country_code: str, city: str,
                    min_price_usd=None, max_price_usd=None, bedrooms_min=None, bathrooms_min=None,
                    property_type=None, limit=DEFAULT_LIMIT, max_limit: int | None = MAX_LIMIT) -> DataFrame:
    """t01."""
    limit = numbers.clamp_limit(limit, DEFAULT_LIMIT, 1, max_limit)
    df = _area(listings, country_code, city).filter(filters.optional_conjunction({
        "min": ("price_usd >=", min_price_usd), "max": ("price_usd <=", max_price_usd),
        "beds": ("bedrooms >=", bedrooms_min), "baths": ("bathrooms >=", bathrooms_min),
        "type": ("property_type ==", property_type)}))
    s = scorecard_by_area(card).select("country_code", "zip_or_municipio", F.col("composite_score").alias("neighborhood_score"))
    r = risk_by_area(risk).select("country_code", "zip_or_municipio", F.col("risk_label").alias("hazard_risk_label"))
    df = df.join(s, ["country_code", "zip_or_municipio"], "left").join(r, ["country_code", "zip_or_municipio"], "left")
    return (df.orderBy(F.col("price_usd").asc_nulls_last(), "listing_id").limit(limit)
              .select("listing_id", "city", "zip_or_municipio", "price_usd", "bedrooms", "bathrooms", "area_sqft",
                      "property_type", "neighborhood_score", "hazard_risk_label"))


PROFILE_METRICS = ["composite_score", "crime_rate_per_100k", "school_score_normalized", "amenity_density_score",
                   "transit_access_score", "hazard_composite_score"]


def neighborhood_profile(card: DataFrame, country_code: str, city: str, zip_or_municipio=None, barrio=None) -> DataFrame:
    """t02: the first matching unit, else the city averages flagged 'aggregate'."""
    base = _area(card, country_code, city)
    m = base
    if zip_or_municipio:
        m = m.filter(F.col("zip_or_municipio") == zip_or_municipio)
    if barrio:
        m = m.filter(F.lower("barrio") == barrio.lower())
    one = m.orderBy("profile_id").limit(1).select("profile_id", "zip_or_municipio", "barrio", *PROFILE_METRICS,
                                                  F.lit("row").alias("source"))
    agg = _some(base.agg(*[F.avg(c).alias(c) for c in PROFILE_METRICS], F.count(F.lit(1)).alias("_rows"))).select(
        F.lit(None).cast("string").alias("profile_id"), F.lit(None).cast("string").alias("zip_or_municipio"),
        F.lit(None).cast("string").alias("barrio"), *PROFILE_METRICS, F.lit("aggregate").alias("source"))
    return _guarded_fallback(one, agg)


def crime_stats(crime: DataFrame, country_code: str, city: str) -> DataFrame:
    """t03: US counts incident rows by category, CO sums counts; with the total."""
    c = _area(crime, country_code, city)
    cat = labels.crime_category_incident("crime_type") if country_code == "US" else labels.crime_category_spanish("crime_type")
    measure = F.count(F.lit(1)) if country_code == "US" else F.sum("count")
    g = c.groupBy(cat.alias("crime_category")).agg(measure.cast("bigint").alias("n"))
    tot = c.agg((F.count(F.lit(1)) if country_code == "US" else F.sum("count")).cast("bigint").alias("total"))
    return g.crossJoin(F.broadcast(tot))


def school_rankings(rank: DataFrame, country_code: str, city: str, limit=DEFAULT_LIMIT, max_limit: int | None = MAX_LIMIT) -> DataFrame:
    """t04."""
    limit = numbers.clamp_limit(limit, DEFAULT_LIMIT, 1, max_limit)
    return (_area(rank, country_code, city).orderBy(F.col("school_score_normalized").desc_nulls_last(), "school_id")
            .limit(limit).select("school_id", "city", "school_score_normalized"))


def weather_summary(weather: DataFrame, country_code: str, city: str, years_back: int | None = None) -> DataFrame:
    """t05: one row of averages, extreme-day total and extreme days per covered year; ``years_back`` keeps the
    calendar years from the area's newest one minus that many on."""
    w = _area(weather, country_code, city)
    if years_back is not None:
        newest = w.agg(F.max(F.year("date")).alias("_y"))
        w = w.join(F.broadcast(newest), F.year("date") >= F.col("_y") - int(years_back)).drop("_y")
    w = w.withColumn(
        "x", labels.is_extreme_day("precipitation_mm", "wind_speed_max_kmh", "temp_max_c", "temp_min_c").cast("int"))
    g = w.agg(F.count(F.lit(1)).alias("_rows"), F.avg("temp_max_c").alias("avg_temp_max_c"), F.avg("temp_min_c").alias("avg_temp_min_c"),
              F.avg("precipitation_mm").alias("avg_precip_mm"), F.sum("x").cast("bigint").alias("total_extreme_days"),
              F.countDistinct(F.year("date")).alias("years_covered"), F.min("date").alias("first_date"),
              F.max("date").alias("last_date"))
    return _some(g).withColumn("extreme_days_per_year", F.try_divide(F.col("total_extreme_days").cast("double"), F.col("years_covered")))


RISK_METRICS = ["flood_risk_score", "earthquake_risk_score", "wildfire_risk_score", "tornado_risk_score",
                "landslide_risk_score", "composite_hazard_score"]


def hazard_risks(risk: DataFrame, country_code: str, city: str, zip_or_municipio=None) -> DataFrame:
    """t06: the first matching area, else city averages of the six scores."""
    base = _area(risk, country_code, city)
    m = base if not zip_or_municipio else base.filter(F.col("zip_or_municipio") == zip_or_municipio)
    one = m.orderBy("geo_id", *RISK_METRICS).limit(1).select("geo_id", *RISK_METRICS, "risk_label", F.lit("row").alias("source"))
    agg = base.agg(*[F.avg(c).alias(c) for c in RISK_METRICS]).where(F.col("composite_hazard_score").isNotNull()).select(
        F.lit(None).cast("string").alias("geo_id"), *RISK_METRICS,
        labels.hazard_label("composite_hazard_score").alias("risk_label"), F.lit("aggregate").alias("source"))
    return _guarded_fallback(one, agg)


def market_trends(summary: DataFrame, country_code: str, city: str, zip_or_municipio=None, months_back=12,
                  max_limit: int | None = MAX_MONTHS) -> DataFrame:
    """t07: latest row with its trends and days on market, plus the newest ``months_back`` rows, ascending, as one series."""
    months_back = numbers.clamp_limit(months_back, 12, 1, max_limit)
    m = _area(summary, country_code, city)
    if zip_or_municipio:
        m = m.filter(F.col("zip_or_municipio") == zip_or_municipio)
    top = m.orderBy(F.col("date").desc(), F.col("zip_or_municipio").desc()).limit(months_back)  # top-k
    pt = F.struct("date", "zip_or_municipio", "median_price_usd", "inventory_count")
    facts = F.struct("date", "median_price_usd", "market_temp", "price_trend_3mo_pct", "price_trend_12mo_pct", "median_days_on_market")
    g = top.agg(F.count(F.lit(1)).alias("_rows"), F.max_by(facts, F.struct("date", "zip_or_municipio")).alias("l"),
                F.sort_array(F.collect_list(pt)).alias("series"))
    return _some(g).select(F.col("l.date").alias("latest_date"), F.col("l.median_price_usd").alias("latest_median_price_usd"),
                    F.col("l.market_temp").alias("latest_market_temp"), F.col("l.price_trend_3mo_pct").alias("price_trend_3mo_pct"),
                    F.col("l.price_trend_12mo_pct").alias("price_trend_12mo_pct"),
                    F.col("l.median_days_on_market").alias("median_days_on_market"), F.size("series").alias("n_points"),
                    F.array_join(F.transform("series", lambda p: F.concat_ws(":", p["date"].cast("string"), p["zip_or_municipio"],
                                                                            p["median_price_usd"].cast("string"),
                                                                            p["inventory_count"].cast("string"))), ",").alias("series"))


def area_demographics(demo: DataFrame, fx_rate: DataFrame, country_code: str, zip_or_municipio=None, city: str | None = None) -> DataFrame:
    """t08: population total, mean income, age and homeowner share of a zip or (where the table has cities) a city;
    CO income also in USD; empty without population."""
    d = demo.filter(F.col("country_code") == country_code)
    if zip_or_municipio:
        d = d.filter(F.col("zip_or_municipio") == zip_or_municipio)
    if city and "city" in demo.columns:
        d = d.filter(filters.ci_equals("city", city))
    age = F.avg("median_age") if "median_age" in demo.columns else F.lit(None).cast("double")
    g = d.agg(F.sum("population").alias("population"), age.alias("median_age"), F.avg("median_income_usd").alias("median_income"),
              F.avg("pct_homeowner").alias("pct_homeowner"))
    g = g.crossJoin(F.broadcast(fx_rate))
    return g.where(F.col("population").isNotNull()).select("population", "median_age", "median_income", "pct_homeowner",
                    (F.col("median_income") / F.col("fx_rate") if country_code == "CO" else F.col("median_income")).alias("median_income_usd"))


def nearby_amenities(amenities: DataFrame, country_code: str, city: str, amenity_types: Sequence[str] | None = None,
                     limit: int = 20, max_limit: int | None = MAX_LIMIT) -> DataFrame:
    """t09."""
    limit = numbers.clamp_limit(limit, 20, 1, max_limit)
    a = _area(amenities, country_code, city)
    if amenity_types:
        a = a.filter(F.col("amenity_type").isin(list(amenity_types)))
    return a.orderBy("amenity_type", "name", "amenity_id").limit(limit).select("amenity_id", "amenity_type", "name")


INDEX_DIMS = ["norm_crime_score", "norm_school_score", "norm_hazard_score", "norm_weather_score", "norm_amenity_score",
              "norm_economic_score"]


def compare_cities(requests: DataFrame, comparison: DataFrame, index: DataFrame) -> DataFrame:
    """t10 in set form: per (us_city, co_city) request (letter case does not count), the newest stored pair, else
    the medians of the six index dimensions on each side; 'insufficient' if a side has none."""
    def low(c):
        return F.lower(F.col(c))
    requests = requests.select("us_city", "co_city", low("us_city").alias("_us"), low("co_city").alias("_co"))
    stored = comparison.groupBy(low("us_city").alias("_us"), low("co_city").alias("_co")).agg(
        F.max_by(F.struct("comparison_date", "price_ratio", "us_composite_score", "co_composite_score"),
                 "comparison_date").alias("s"))
    med = median.exact_medians(index.withColumn("_city", low("city")), ["country_code", "_city"], INDEX_DIMS)
    us = med.filter(F.col("country_code") == "US").select(F.col("_city").alias("_us"), *[F.col(c).alias(f"us_{c}") for c in INDEX_DIMS])
    co = med.filter(F.col("country_code") == "CO").select(F.col("_city").alias("_co"), *[F.col(c).alias(f"co_{c}") for c in INDEX_DIMS])
    j = requests.join(stored, ["_us", "_co"], "left").join(us, "_us", "left").join(co, "_co", "left")
    hit = F.col("s").isNotNull()
    both = F.coalesce(*[F.col(f"us_{c}") for c in INDEX_DIMS]).isNotNull() & F.coalesce(*[F.col(f"co_{c}") for c in INDEX_DIMS]).isNotNull()
    return j.select("us_city", "co_city", F.when(hit, "stored").when(both, "medians").otherwise("insufficient").alias("source"),
                    F.col("s.comparison_date").alias("comparison_date"), F.col("s.price_ratio").alias("price_ratio"),
                    *[F.when(~hit & both, F.col(f"{p}_{c}")).alias(f"{p}_{c}") for p in ("us", "co") for c in INDEX_DIMS])


def affordability(economic: DataFrame, summary: DataFrame, country_code: str, city: str, annual_income_usd: float,
                  down_payment_usd: float = 0.0) -> DataFrame:
    """t11: the country's latest non-NULL mortgage rate (else 7 %, as the note says), monthly payment, annuity price
    cap, latest area median."""
    e = economic.filter((F.col("country_code") == country_code) & F.col("mortgage_rate_30yr").isNotNull())
    rate = e.agg(F.max_by("mortgage_rate_30yr", F.struct("date", "city")).alias("r")).select(
        F.coalesce("r", F.lit(numbers.DEFAULT_MORTGAGE_RATE)).alias("mortgage_rate"),
        F.when(F.col("r").isNull(), RATE_NOTES[0]).otherwise(RATE_NOTES[1]).alias("rate_note"))
    m = _area(summary, country_code, city)
    mx = m.agg(F.max("date").alias("_d"))
    med = median.exact_median(m.join(F.broadcast(mx), F.col("date") == F.col("_d")), [], "median_price_usd", "area_median_price_usd")
    j = rate.crossJoin(med)
    price = numbers.max_affordable_price(F.lit(float(annual_income_usd)), "mortgage_rate", F.lit(float(down_payment_usd)))
    return j.select("mortgage_rate", "rate_note", F.lit(float(annual_income_usd) * numbers.HOUSING_SHARE / 12.0).alias("monthly_payment_usd"),
                    price.alias("max_affordable_price_usd"), "area_median_price_usd",
                    (price >= F.col("area_median_price_usd")).alias("can_afford_median"))


def value_opportunities(vo: DataFrame, country_code: str, city: str, max_price_usd=None, limit=DEFAULT_LIMIT, max_limit: int | None = MAX_LIMIT) -> DataFrame:
    """t12."""
    limit = numbers.clamp_limit(limit, DEFAULT_LIMIT, 1, max_limit)
    v = _area(vo, country_code, city)
    if max_price_usd is not None:
        v = v.filter(F.col("price_usd") <= max_price_usd)
    return v.orderBy(F.col("discount_pct").desc_nulls_last(), "listing_id").limit(limit) \
            .select("listing_id", "price_usd", "area_median_price_usd", "discount_pct")


def amenity_access(card: DataFrame, country_code: str, city: str, zip_or_municipio=None) -> DataFrame:
    """t13."""
    c = _area(card, country_code, city)
    if zip_or_municipio:
        c = c.filter(F.col("zip_or_municipio") == zip_or_municipio)
    cols = ["amenity_density_score", "transit_access_score", "grocery_count", "park_count", "hospital_count",
            "transit_stop_count"]
    return c.agg(*[F.avg(x).alias(f"avg_{x}") for x in cols]).where(F.col("avg_amenity_density_score").isNotNull())


# --- t14: a table of requests (answered in requests.py) -------------------------------------------------
CALL_SCHEMA = "array<struct<tool:string,params:map<string,string>>>"


def plan_calls(plans: DataFrame, plan_col: str = "plan_json", keys=("conv_id", "turn")) -> DataFrame:
    """Explode each plan's tool calls: (keys, call_index, tool, params map)."""
    calls = F.from_json(F.get_json_object(F.col(plan_col), "$.tool_calls"), CALL_SCHEMA)
    e = plans.select(*keys, F.posexplode(calls).alias("call_index", "c"))
    return e.select(*keys, "call_index", F.col("c.tool").alias("tool"), F.col("c.params").alias("params"))
