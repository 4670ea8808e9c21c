"""Domain-shaped inputs derived from the driver's test tables.

Each binding is a lazy DataFrame over the TPC-H-like tables (orders, customer,
nation, part, supplier, lineitem, events, conversations) whose row count grows
with the scale factor. ``nation`` is a fixed 25-row dimension, so it is the
only side we hint as broadcast; every other join is left to AQE, which only
broadcasts a side after measuring it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import median
from ..session import scratch_path
from .tables import Tables


def _country(regionkey: Column) -> Column:
    return F.when(regionkey == 1, F.lit("US")).otherwise(F.lit("CO"))


def _orders_geo(t: Tables) -> DataFrame:
    o = t.orders
    c = t.customer.select("c_custkey", "c_nationkey")
    n = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey))


def listings(t: Tables) -> DataFrame:
    """b_listings plus lat/lon, barrio, bathrooms and source (duplicated listing ids)."""
    j = _orders_geo(t)
    country = _country(F.col("n_regionkey"))
    ok = F.col("o_orderkey")
    ck = F.col("o_custkey")
    return j.select(
        F.concat_ws("_", F.when(F.col("n_regionkey") == 1, "us").otherwise("co"),
                    ck.cast("string"), (ok % 3).cast("string")).alias("listing_id"),
        ok.alias("seq"),
        country.alias("country_code"),
        F.col("n_name").alias("city"),
        F.when(F.col("n_regionkey") == 1, F.concat(F.lit("Z"), (ck % 7).cast("string"))).otherwise(F.col("n_name")).alias("zip_or_municipio"),
        F.floor("o_totalprice").cast("bigint").alias("price_usd"),
        (ok % 6).cast("int").alias("bedrooms"),
        F.when(ok % 11 == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(300) + ok % 2000).cast("double")).alias("area_sqft"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "single_family")
         .when(F.col("o_orderpriority") == "2-HIGH", "condo")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "Town Home")
         .when(F.col("o_orderpriority") == "5-LOW", "casa")
         .otherwise("loft").alias("property_type"),
        F.col("o_orderdate").alias("scraped_at"),
        # extra columns (same rule in the oracle SQL)
        ((ck * 7919) % 12000).cast("double") / 1e2 - 6e1 + (ok % 10).cast("double") / 1e3,
        ((ck * 104729) % 35900).cast("double") / 1e2 - 179.5 + (ok % 10).cast("double") / 1e3,
        F.when(F.col("n_regionkey") == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("B"), (ok % 4).cast("string"))).alias("barrio_or_neighborhood"),
        (F.lit(1) + ok % 3).cast("double").alias("bathrooms"),
        F.when(ok % 2 == 0, "site_a").otherwise("site_b").alias("source"),
        F.when(F.col("n_regionkey") != 1, F.floor("o_totalprice").cast("bigint") * 4000 + ok % 1000),
        F.when((F.col("n_regionkey") != 1) & (ok % 11 != 0), (F.lit(30) + ok % 200).cast("double")),
        F.when(F.col("n_regionkey") != 1, F.concat(F.lit("D"), (ck % 5).cast("string"))),
    ).toDF("listing_id", "seq", "country_code", "city", "zip_or_municipio", "price_usd",
           "bedrooms", "area_sqft", "property_type", "scraped_at", "lat", "lon",
           "barrio_or_neighborhood", "bathrooms", "source", "price_cop", "area_m2", "departamento")


def market(t: Tables) -> DataFrame:
    """b_market: monthly series per area (US by zip, CO by city) with gaps. ``median_price_usd`` is the plain median; beside it
    stand the prices as the two countries land them: US sale (not every month) and list prices, CO prices in COP. The counts of
    prices are written once: the median reads them several times, and each time would scan and join the orders again."""
    j = _orders_geo(t)
    keys = ["country_code", "city", "zip_or_municipio", "date"]
    us = F.col("country_code") == "US"
    counts = (j.groupBy(
                _country(F.col("n_regionkey")).alias("country_code"),
                F.col("n_name").alias("city"),
                F.when(F.col("n_regionkey") == 1, F.concat(F.lit("Z"), (F.col("o_custkey") % 7).cast("string"))).otherwise(F.col("n_name")).alias("zip_or_municipio"),
                F.date_trunc("month", "o_orderdate").cast("date").alias("date"), "o_totalprice")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("bigint").alias("f")))
    path = scratch_path(t.spark, f"market_counts_{uuid.uuid4().hex}")
    counts.write.parquet(path)
    counts = t.spark.read.schema(counts.schema).parquet(path)
    every = counts.groupBy(*keys).agg(F.sum("n").alias("inventory_count"), F.sum("f").alias("homes_sold"))
    medians = median.median_of_counts(counts, keys, "o_totalprice", "n", "m")
    return every.join(medians, keys, "left").select(
        *keys, F.floor("m").cast("bigint").alias("median_price_usd"), "inventory_count", "homes_sold") \
        .select("*", F.when(us & (F.month("date") % 3 != 0), F.col("median_price_usd")).alias("median_sale_price_usd"),
                F.when(us, F.col("median_price_usd") + 500).alias("median_list_price_usd"),
                F.when(~us, F.col("median_price_usd") * 4000 + 7).alias("new_construction_price_cop"),
                F.when(us, (F.col("inventory_count") % 90).cast("int")).alias("median_days_on_market"))


def hazards(t: Tables) -> DataFrame:
    """b_hazards: long hazard rows; 'hurricane' is outside the pivot list."""
    e = t.events
    return e.select(
        F.concat(F.lit("h_"), F.col("event_id").cast("string")).alias("hazard_id"),
        F.when(F.col("user_id") % 5 == 1, "US").otherwise("CO").alias("country_code"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("county_or_municipio"),
        F.concat(F.lit("Z"), (F.col("user_id") % 7).cast("string")).alias("zip_or_zone"),
        F.when(F.col("event_type") == "click", "flood")
         .when(F.col("event_type") == "view", "earthquake")
         .when(F.col("event_type") == "signup", "wildfire")
         .when(F.col("event_type") == "purchase", "tornado")
         .otherwise("hurricane").alias("hazard_type"),
        F.least(F.col("value") / 5e2, F.lit(1.0)).alias("risk_score"),
        F.lit("events").alias("source"),
    )


def centroids(t: Tables) -> DataFrame:
    """b_centroids: points to enrich (one per customer)."""
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("geo_id"),
        ((F.col("c_custkey") * 7919) % 12000).cast("double") / 1e2 - 6e1,
        ((F.col("c_custkey") * 104729) % 35900).cast("double") / 1e2 - 179.5,
    ).toDF("geo_id", "lat", "lon")


def grid(t: Tables) -> DataFrame:
    """b_grid: measured points (nearest / radius joins), PGA-like value."""
    s = t.supplier
    return s.select(
        F.col("s_suppkey").alias("point_id"),
        ((F.col("s_suppkey") * 6151) % 12000).cast("double") / 1e2 - 6e1,
        ((F.col("s_suppkey") * 15485863) % 35900).cast("double") / 1e2 - 179.5,
        (F.col("s_suppkey") % 13).cast("double") / 2e1,
    ).toDF("point_id", "lat", "lon", "pga")


def amenities(t: Tables) -> DataFrame:
    """b_amenities: typed points per city."""
    p = t.part
    size6 = F.col("p_size") % 6
    return p.select(
        F.col("p_partkey").cast("string").alias("amenity_id"),
        F.when(F.col("p_partkey") % 5 == 1, "US").otherwise("CO").alias("country_code"),
        F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string")).alias("city"),
        F.when(size6 == 0, "grocery").when(size6 == 1, "park").when(size6 == 2, "hospital")
         .when(size6 == 3, "transit_stop").when(size6 == 4, "pharmacy")
         .otherwise("restaurant").alias("amenity_type"),
        F.col("p_name").alias("name"),
    )


def schools(t: Tables) -> DataFrame:
    """b_schools: US schools with two nullable scores, some sentinel negatives; CO schools with a nullable percentile."""
    p = t.part
    k = F.col("p_partkey")
    us = k % 5 == 1
    return p.select(
        k.cast("string").alias("school_id"),
        F.when(k % 5 == 1, "US").otherwise("CO").alias("country_code"),
        F.concat(F.lit("NATION_"), (k % 25).cast("string")).alias("city"),
        F.when(k % 4 == 0, F.lit(None).cast("double")).when(k % 9 == 0, F.lit(-2.0))
         .otherwise((F.col("p_size") * 2).cast("double")).alias("math_pct"),
        F.when(k % 6 == 0, F.lit(None).cast("double"))
         .otherwise(((k * 37) % 101).cast("double")).alias("reading_pct"),
        F.when(~us & (k % 7 != 0), ((k * 53) % 1010).cast("double") / 10).alias("icfes_percentile"),
        F.concat(F.when(us, "S").otherwise("D"), (k % 5).cast("string")).alias("state_or_dept"),
        F.when(us, F.concat(F.lit("Z"), (k % 7).cast("string"))).otherwise(F.concat(F.lit("NATION_"), (k % 25).cast("string"))).alias("zip_or_municipio"),
        ((k * 7919) % 12000).cast("double") / 1e2 - 6e1, ((k * 104729) % 35900).cast("double") / 1e2 - 179.5,
        F.col("p_name").alias("school_name"), F.when(k % 3 == 0, "KG-05").otherwise("06-12").alias("grade_levels"),
        (F.col("p_size") * 10).cast("int").alias("enrollment"),
        F.when(us, "regular").when(k % 2 == 0, "oficial").otherwise("privado").alias("school_type"),
        F.when(~us, (F.lit(2020) + k % 4).cast("int")).alias("icfes_year"),
    ).toDF("school_id", "country_code", "city", "math_pct", "reading_pct", "icfes_percentile", "state_or_dept", "zip_or_municipio",
           "lat", "lon", "school_name", "grade_levels", "enrollment", "school_type", "icfes_year")


def weather(t: Tables) -> DataFrame:
    """b_weather: daily series per city."""
    e = t.events
    return (e.groupBy(
                F.when(F.col("user_id") % 5 == 1, "US").otherwise("CO").alias("country_code"),
                F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("city"),
                F.col("ts").cast("date").alias("date"))
             .agg((F.max("value") / 8.0).alias("temp_max_c"),
                  (F.min("value") / 8.0 - 16.0).alias("temp_min_c"),
                  F.max(F.when(F.col("event_type") == "view", F.col("value") / 4.0)).alias("precipitation_mm"),
                  F.max(F.when(F.col("event_type") == "click", F.col("value") / 3.0)).alias("wind_speed_max_kmh")))


def fx(t: Tables) -> DataFrame:
    """b_fx: daily COP per USD rate, one row per order date."""
    o = t.orders
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("date"))
             .agg((F.lit(3500) + F.sum("o_orderkey") % 700).cast("double").alias("rate"))
             .select("date", F.lit("COP").alias("from_currency"), F.lit("USD").alias("to_currency"), "rate"))


def crime(t: Tables) -> DataFrame:
    """b_crime: incidents per city with raw offence labels (one row per lineitem)."""
    l = t.lineitem
    k6 = F.col("l_orderkey") % 6
    return l.select(
        F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 25).cast("string")).alias("city"),
        F.when(F.col("l_suppkey") % 5 == 1, "US").otherwise("CO").alias("country_code"),
        F.when(k6 == 0, "Homicidio").when(k6 == 1, "Hurto a personas").when(k6 == 2, "Daño en bien ajeno")
         .when(k6 == 3, "Hurto con violencia").when(k6 == 4, "Extorsión").otherwise("robbery").alias("crime_type"),
        F.col("l_quantity").cast("int").alias("count"),
        F.year("l_shipdate").alias("period_year"),
        F.month("l_shipdate").alias("period_month"),
    )


def plans(t: Tables) -> DataFrame:
    """b_plans: plan JSON text per conversation turn."""
    c = t.conversations
    cid = F.col("conv_id")
    return c.select(
        "conv_id", "turn", "role",
        F.concat(
            F.lit('{"intent":"t'), F.col("turn").cast("string"), F.lit('","reasoning":"because '), (cid % 9).cast("string"),
            F.lit('","tool_calls":[{"tool":"get_market_trends","params":{"country_code":"'),
            F.when(cid % 3 == 0, "US").otherwise("CO"),
            F.lit('","city":"NATION_'), (cid % 25).cast("string"), F.lit('"}}'),
            F.when(cid % 4 == 0, F.lit(',{"tool":"compare_cities","params":{"us_city":"NATION_1","co_city":"NATION_2"}}'))
             .otherwise(F.lit("")),
            F.when(cid % 5 == 2, F.concat(F.lit(',{"tool":"search_listings","params":{"country_code":"US","city":"nation_6","min_price_usd":'), (cid % 13 * 20000).cast("string"),
                                          F.lit(',"max_price_usd":'), (cid % 13 * 20000 + 150000).cast("string"), F.lit(',"limit":'), (cid % 60 + 1).cast("string"), F.lit("}}")))
             .otherwise(F.lit("")),
            F.element_at(F.array(*[F.lit(x) for x in PLAN_EXTRAS]), (cid % len(PLAN_EXTRAS) + 1).cast("int")),
            F.lit("]}")).alias("plan_json"))


# Further calls of the plans: values to clamp, values that break a rule, tools and cities nobody knows, a repeated tool.
PLAN_EXTRAS = (
    ',{"tool":"search_listings","params":{"country_code":"US","city":"NATION_1","limit":999,"min_price_usd":0}}',
    ',{"tool":"search_listings","params":{"country_code":"US","city":"NATION_1","limit":"abc"}}',
    ',{"tool":"search_listings","params":{"country_code":"US","city":"NATION_6","bedrooms_min":-3,"limit":5}}',
    ',{"tool":"search_listings","params":{"country_code":"US","city":"NATION_6","min_price_usd":-5}}',
    ',{"tool":"launch_rocket","params":{"city":"NATION_6"}}',
    ',{"tool":"compare_cities","params":{"us_city":"NATION_1","co_city":"NATION_3"}}',
    ',{"tool":"get_market_trends","params":{"country_code":"US","city":"NOWHERE","months_back":30}},{"tool":"get_market_trends","params":{"country_code":"XX","city":"NATION_1"}}',
    ',{"tool":"get_neighborhood_profile","params":{"country_code":"CO","city":"NATION_0","zip_or_municipio":"NATION_0"}},{"tool":"get_crime_stats","params":{"country_code":"CO","city":"NATION_0"}}',
    ',{"tool":"get_neighborhood_profile","params":{"country_code":"US","city":"Nation_1","zip_or_municipio":"NO_ZIP"}},{"tool":"get_crime_stats","params":{"country_code":"US","city":"nation_1"}}',
    ',{"tool":"get_school_rankings","params":{"country_code":"CO","city":"NATION_2","limit":8}},{"tool":"get_weather_summary","params":{"country_code":"US","city":"nation_1","years_back":1}}',
    ',{"tool":"get_school_rankings","params":{"country_code":"US","city":"NATION_6","zip_or_municipio":"Z3"}},{"tool":"get_weather_summary","params":{"country_code":"CO","city":"NATION_7"}}',
    ',{"tool":"get_hazard_risks","params":{"country_code":"CO","city":"NATION_7"}},{"tool":"get_area_demographics","params":{"country_code":"CO","city":"NATION_2"}}',
    ',{"tool":"get_hazard_risks","params":{"country_code":"US","city":"NATION_6","zip_or_municipio":"NO_ZIP"}},{"tool":"get_area_demographics","params":{"country_code":"US","city":"NATION_6","zip_or_municipio":"Z3"}}',
    ',{"tool":"get_nearby_amenities","params":{"country_code":"CO","city":"NATION_0","amenity_types":["grocery","park"],"limit":7}},{"tool":"get_affordability_analysis","params":{"country_code":"US","city":"NATION_1","annual_income_usd":70000,"down_payment_usd":20000}}',
    ',{"tool":"get_nearby_amenities","params":{"country_code":"US","city":"nation_6"}},{"tool":"get_affordability_analysis","params":{"country_code":"CO","city":"NATION_12","annual_income_usd":12000}}',
    ',{"tool":"get_value_opportunities","params":{"country_code":"CO","city":"NATION_0","max_price_usd":200000,"limit":10}},{"tool":"get_amenity_access","params":{"country_code":"US","city":"nation_6"}}',
    ',{"tool":"get_value_opportunities","params":{"country_code":"US","city":"nation_6"}},{"tool":"get_amenity_access","params":{"country_code":"US","city":"NOWHERE"}}',
    ',{"tool":"search_listings","params":{"country_code":"CO","city":"NATION_0","bedrooms_min":3,"bathrooms_min":2,"property_type":"apartment","limit":30}},{"tool":"compare_cities","params":{"us_city":"nation_21","co_city":"NATION_12"}}',
)


def results(t: Tables) -> DataFrame:
    """JSON results of the calls of every turn: lists of some or no rows, objects, messages, errors, repeated tools."""
    c = t.conversations
    i = F.col("call_order")
    calls = c.select("conv_id", "turn", F.explode(F.sequence(F.lit(0), (F.col("conv_id") % 3 + 1).cast("int"))).alias("call_order"))
    k, s = (F.col("conv_id") + F.col("turn") + i * i) % 5, F.col("conv_id") * 10 + F.col("turn") + i
    row = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda j: F.concat(
        F.lit('{"listing_id":"L'), s.cast("string"), F.lit('","price_usd":'), (s * 1000 + j).cast("string"), F.lit(',"city":"X"}')))
    text = (F.when(k == 0, F.concat(F.lit("["), F.array_join(F.slice(row, F.lit(1), (s % 4).cast("int")), ","), F.lit("]")))
             .when((k == 1) & (s % 5 == 0), F.concat(F.lit('{"message":"No market data for CO/NATION_'), (s % 25).cast("string"), F.lit('"}')))
             .when(k == 1, F.concat(F.lit('{"city":"NATION_'), (s % 25).cast("string"), F.lit('","latest_median_price_usd":'), (s * 100).cast("string"),
                                    F.lit(',"market_temp":"hot","note":"' + "n" * 70 + '","monthly_series":[{"m":1}],"flag":true,"zip":null}')))
             .when(k == 2, F.concat(F.lit('{"us_city":"NATION_1","co_city":"NATION_2","aggregate":true,"us_metrics":{"a":1},"price_ratio":'), s.cast("string"), F.lit("}")))
             .when((k == 3) & (s % 7 == 0), F.lit('{"error":"ValueError: bad"}'))
             .when(k == 3, F.concat(F.lit('{"composite_hazard_score":'), s.cast("string"), F.lit(',"risk_label":null}')))
             .otherwise(F.concat(F.lit('[{"school_id":"1","school_score_normalized":'), s.cast("string"), F.lit("}]"))))
    tools = ["search_listings", "get_market_trends", "compare_cities", "get_hazard_risks", "get_school_rankings"]
    tool = F.element_at(F.array(*[F.lit(x) for x in tools]), (k + 1).cast("int"))
    return calls.select("conv_id", "turn", "call_order", tool.alias("tool"), text.alias("result_json"))


def demographics(t: Tables) -> DataFrame:
    """Demographics per (country, zip, year) from customers: population, income, homeowner share."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return (j.groupBy(_country(F.col("n_regionkey")).alias("country_code"),
                      F.when(F.col("n_regionkey") == 1, F.concat(F.lit("Z"), (F.col("c_custkey") % 7).cast("string"))).otherwise(F.col("n_name")).alias("zip_or_municipio"),
                      (F.lit(2022) + F.col("c_custkey") % 2).cast("int").alias("year"))
             .agg((F.count(F.lit(1)) * 1000).cast("bigint").alias("population"),
                  F.floor(F.avg("c_acctbal") * 10).cast("bigint").alias("median_income_usd"),
                  (F.lit(100.0) * F.sum(F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0))
                   / F.count(F.lit(1))).alias("pct_homeowner")))


def economic(t: Tables) -> DataFrame:
    """Monthly economics per (country, city): unemployment and a 30-year mortgage rate."""
    j = _orders_geo(t)
    return (j.groupBy(_country(F.col("n_regionkey")).alias("country_code"), F.col("n_name").alias("city"),
                      F.date_trunc("month", "o_orderdate").cast("date").alias("date"))
             .agg((F.lit(100.0) * F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)) / F.count(F.lit(1)) / 10.0)
                  .alias("unemployment_rate"),
                  F.when(F.count(F.lit(1)) > 2, F.avg("o_totalprice") / 1e5).alias("mortgage_rate_30yr")))
