"""Session-log operators (g01-g11) as Spark jobs over a conversation / plan log.

A conversation is a handful of turns, so per-conversation windows are bounded;
every other step is a per-row expression or a keyed aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tools

# Fixed values that must match the source behaviour -------------------------------
CO_CITY_MARKERS = [("bogot", "Bogota"), ("medell", "Medellin")]
US_CITIES = ["austin", "miami", "atlanta", "houston", "chicago", "new york", "los angeles", "denver", "phoenix",
             "tucson", "dallas", "nashville"]
KEYWORD_TOOLS = [
    (["school", "educat", "kid", "child", "family"], "get_school_rankings"),
    (["safe", "crime", "danger", "secur"], "get_crime_stats"),
    (["flood", "quake", "earthquake", "wildfire", "risk", "hazard", "disaster", "landslide"], "get_hazard_risks"),
    (["afford", "budget", "income", "mortgage", "down payment"], "get_affordability_analysis"),
    (["compare", "vs", "versus", "difference"], "compare_cities"),
]
DEFAULT_TOOLS = ["search_listings", "get_market_trends"]
ALLOWED_TOOLS = ["search_listings", "get_neighborhood_profile", "get_crime_stats", "get_school_rankings",
                 "get_weather_summary", "get_hazard_risks", "get_market_trends", "get_area_demographics",
                 "get_nearby_amenities", "compare_cities", "get_affordability_analysis", "get_value_opportunities",
                 "get_amenity_access"]
PROPERTY_TYPES = ["single_family", "apartment", "condo", "townhouse"]
AMENITY_TYPES = ["grocery", "hospital", "park", "transit_stop", "pharmacy", "school", "restaurant"]
CLAMP_RULES = {"limit": (1, 50), "months_back": (1, 24), "years_back": (1, 10), "bedrooms_min": (0, 10)}
FLOAT_CLAMP_RULES = {"bathrooms_min": (0.0, 10.0)}
AT_LEAST_ZERO = ["min_price_usd", "down_payment_usd"]
ABOVE_ZERO = ["max_price_usd", "annual_income_usd"]
NOT_BLANK = ["city", "us_city"]
SHORT_TEXT = ["zip_or_municipio", "barrio"]                       # 1 to 64 characters
DEFAULT_CITY, DEFAULT_COUNTRY, DEFAULT_US_CITY = "Medellin", "CO", "Miami"
ACCENTED_CITIES = {"Bogot\u00e1": "Bogota", "Medell\u00edn": "Medellin"}
SHORT_FACT = 64
# ----------------------------------------------------------------------------------


def detect_city(text_col) -> Column:
    """City named in a text (CO markers first, then the US list), else NULL."""
    q = F.lower(F.col(text_col) if isinstance(text_col, str) else text_col)
    out = None
    for marker, city in CO_CITY_MARKERS:
        out = F.when(q.contains(marker), city) if out is None else out.when(q.contains(marker), city)
    for us in US_CITIES:
        out = out.when(q.contains(us), F.initcap(F.lit(us)))
    return out


def _call(tool: str, **params) -> Column:
    pairs = [x for k, v in params.items() for x in (F.lit(k), (v if isinstance(v, Column) else F.lit(v)).cast("string"))]
    return F.struct(F.lit(tool).alias("tool"), F.create_map(*pairs).alias("params"))


def route_keywords(text_col, city_col: str, max_calls: int | None = None) -> Column:
    """g06: the calls (tool, params) chosen by keyword lists: profile and market of a named city first, the default pair
    when nothing matched. ``max_calls`` keeps the first so many; by default all are kept."""
    q = F.lower(F.col(text_col) if isinstance(text_col, str) else text_col)
    named = F.col(city_col)
    country = F.when(named.isin([c for _, c in CO_CITY_MARKERS]), "CO").when(named.isNotNull(), "US")
    city, where = F.coalesce(named, F.lit(DEFAULT_CITY)), F.coalesce(country, F.lit(DEFAULT_COUNTRY))
    extra = {"get_school_rankings": {"limit": 8}, "get_crime_stats": {"months_back": 12},
             "get_affordability_analysis": {"annual_income_usd": 70000, "down_payment_usd": 20000}}
    parts = [F.when(named.isNotNull(), _call("get_neighborhood_profile", country_code=country, city=named)),
             F.when(named.isNotNull(), _call("get_market_trends", country_code=country, city=named, months_back=12))]
    for words, tool in KEYWORD_TOOLS:
        hit = F.lit(False)
        for w in words:
            hit = hit | q.contains(w)
        call = _call(tool, us_city=DEFAULT_US_CITY, co_city=city) if tool == "compare_cities" else \
            _call(tool, country_code=where, city=city, **extra.get(tool, {}))
        parts.append(F.when(hit, call))
    default = F.array(_call(DEFAULT_TOOLS[0], country_code=DEFAULT_COUNTRY, city=DEFAULT_CITY, limit=10),
                      _call(DEFAULT_TOOLS[1], country_code=DEFAULT_COUNTRY, city=DEFAULT_CITY, months_back=12))
    chosen = F.array_compact(F.array(*parts))
    chosen = F.when(F.size(chosen) == 0, default).otherwise(chosen)
    return chosen if max_calls is None else F.slice(chosen, 1, max_calls)


def with_context_city(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", city_col: str = "city",
                      out_col: str = "context_city", max_turns: int | None = None, block: int = 1024) -> DataFrame:
    """g07: the turn's own city, else that of the most recent earlier turn that names one (of the last ``max_turns``, if given).

    A conversation is cut into blocks of turn numbers: a window inside a block, and one over the blocks' last named
    turns, so that a very long conversation is many small window partitions."""
    named = F.when(F.col(city_col).isNotNull(), F.struct(F.col(turn_col).alias("t"), F.col(city_col).alias("c")))
    t = turns.withColumn("_b", F.floor(F.col(turn_col) / block)).withColumn("_named", named)
    inside = Window.partitionBy(conv_col, "_b").orderBy(turn_col).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_in", F.last("_named", ignorenulls=True).over(inside))
    ends = t.groupBy(conv_col, "_b").agg(F.max("_named").alias("_last"))
    before = Window.partitionBy(conv_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_prev", F.last("_last", ignorenulls=True).over(before)).select(conv_col, "_b", "_prev")
    t = t.join(ends, [conv_col, "_b"], "left").withColumn("_found", F.coalesce("_in", "_prev"))
    city = F.col("_found.c")
    if max_turns is not None:
        city = F.when(F.col(turn_col) - F.col("_found.t") <= max_turns, city)
    return t.select(*turns.columns, city.alias(out_col))


def cities_from_calls(calls: DataFrame, keys: Sequence[str] = ("conv_id", "turn")) -> DataFrame:
    """g01 + g02: distinct sorted cities of a plan and its country filter."""
    p = F.col("params")
    vals = F.array_compact(F.array(F.element_at(p, F.lit("city")), F.element_at(p, F.lit("us_city")),
                                   F.element_at(p, F.lit("co_city"))))
    ctry = F.array_compact(F.array(F.element_at(p, F.lit("country_code")),
                                   F.when(F.element_at(p, F.lit("us_city")).isNotNull(), F.lit("US")),
                                   F.when(F.element_at(p, F.lit("co_city")).isNotNull(), F.lit("CO"))))
    g = calls.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(vals)))).alias("_c"),
                                 F.array_distinct(F.flatten(F.collect_list(ctry))).alias("_k"))
    kk = F.filter("_k", lambda x: x.isin("US", "CO"))
    cf = (F.when(F.size(kk) >= 2, "BOTH").when(F.size(kk) == 1, F.element_at(kk, 1)).otherwise("UNKNOWN"))
    return g.select(*keys, F.array_join("_c", ",").alias("cities_mentioned"), cf.alias("country_filter"))


def _param_ok(k: Column, v: Column, co_cities: Sequence[str]) -> Column:
    """The rule of one parameter; unknown parameters and NULL pass."""
    n = v.try_cast("double")
    types = F.from_json(v, "array<string>")
    return (F.when(v.isNull(), True)
             .when(k == "country_code", v.isin("US", "CO"))
             .when(k == "co_city", v.isin(list(co_cities)))
             .when(k.isin(NOT_BLANK), F.length(v) > 0)
             .when(k.isin(SHORT_TEXT), F.length(v).between(1, 64))
             .when(k.isin([*CLAMP_RULES, *FLOAT_CLAMP_RULES]), n.isNotNull() & ~F.isnan(n))
             .when(k.isin(AT_LEAST_ZERO), F.coalesce(n >= 0, F.lit(False)))
             .when(k.isin(ABOVE_ZERO), F.coalesce(n > 0, F.lit(False)))
             .when(k == "property_type", v.isin(PROPERTY_TYPES))
             .when(k == "amenity_types", F.coalesce(F.forall(types, lambda t: t.isin(AMENITY_TYPES)), F.lit(False)))
             .otherwise(True))


def _param_clean(k: Column, v: Column) -> Column:
    """The value of a parameter that passed: numbers within their range, city names without accents."""
    n = v.try_cast("double")
    out = F.when(v.isNull(), v)
    for name, (lo, hi) in CLAMP_RULES.items():
        whole = F.when(n > 0, F.floor(F.least(n, F.lit(float(hi))))).otherwise(F.ceil(F.greatest(n, F.lit(float(lo)))))
        out = out.when(k == name, F.greatest(F.lit(lo), F.least(F.lit(hi), whole)).cast("string"))
    for name, (lo, hi) in FLOAT_CLAMP_RULES.items():
        out = out.when(k == name, F.greatest(F.lit(lo), F.least(F.lit(hi), n)).cast("string"))
    for accented, plain in ACCENTED_CITIES.items():
        out = out.when(k.isin("city", "co_city") & (v == accented), plain)
    return out.otherwise(v)


def validate_calls(calls: DataFrame, supported_co_cities: Sequence[str], keys=("conv_id", "turn"),
                   max_calls: int | None = None) -> DataFrame:
    """g08: the valid calls with cleaned ``params`` and ``call_order`` (from 0) and a ``status``.

    Dropped: unknown tools, calls with a parameter that breaks its rule and cannot be clamped, unsupported CO cities. With
    ``max_calls``, calls of a plan beyond the first so many stay with status 'over_limit'; all others are 'ok'."""
    p = F.transform_values("params", lambda k, v: F.when(v.isin(list(ACCENTED_CITIES)), _param_clean(k, v)).otherwise(v))
    v = calls.filter(F.col("tool").isin(ALLOWED_TOOLS)).withColumn("params", p)
    v = v.filter(F.col("params").isNull() | F.forall(F.map_entries("params"), lambda e: _param_ok(e["key"], e["value"], supported_co_cities)))
    city = F.element_at("params", F.lit("city"))
    co = F.coalesce(F.element_at("params", F.lit("country_code")) == "CO", F.lit(False))
    unsupported = co & F.coalesce((city != "") & ~city.isin(list(supported_co_cities)), F.lit(False))
    v = v.filter(~unsupported).withColumn("params", F.transform_values("params", _param_clean))
    w = Window.partitionBy(*keys).orderBy("call_index")           # the calls of one plan
    v = v.withColumn("call_order", F.row_number().over(w) - 1)
    over = F.lit(False) if max_calls is None else F.col("call_order") >= max_calls
    return v.withColumn("status", F.when(over, "over_limit").otherwise("ok"))


def evidence(results: DataFrame, keys: Sequence[str] = ("conv_id", "turn")) -> DataFrame:
    """The evidence entries of every plan from (keys, call_order, tool, result_json), a result being a JSON list of rows or an object.

    A tool called again is kept under ``tool_<order>``. Numbers of a list's first row, numbers and short texts of an object
    are its facts (g04); g03, g09 and g10 count rows, objects without a message, and empty or failed results."""
    order = Window.partitionBy(*keys, "tool").orderBy("call_order")                    # the calls of one plan
    j = F.col("result_json")
    is_list = F.ltrim(j).startswith("[")
    rows = F.when(is_list, F.from_json(j, "array<variant>"))
    obj = F.from_json(F.when(is_list, F.to_json(F.get(rows, F.lit(0)))).otherwise(j), "map<string,variant>")
    typed = F.transform(F.map_entries(obj), lambda e: F.struct(e["key"].alias("k"), F.schema_of_variant(e["value"]).alias("t"),
                                                               F.to_json(e["value"]).alias("v")))
    e = results.select(*keys, "call_order", F.when(F.row_number().over(order) == 1, F.col("tool"))
                       .otherwise(F.concat_ws("_", "tool", F.col("call_order").cast("string"))).alias("tool"),
                       is_list.alias("is_list"), F.coalesce(F.size(rows), F.lit(0)).alias("n_rows"),
                       F.coalesce(typed, F.array().cast("array<struct<k:string,t:string,v:string>>")).alias("fields"),
                       F.get_json_object(j, "$.message").alias("message"))
    names = F.transform("fields", lambda f: f["k"])
    has = {k: F.array_contains(names, k) & ~F.col("is_list") for k in ("message", "error")}
    number = lambda f: f["t"].rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    short = lambda f: (f["t"] == "STRING") & (F.length(F.from_json(F.concat(F.lit("["), f["v"], F.lit("]")), "array<string>")[0]) < SHORT_FACT)
    facts = F.filter("fields", lambda f: number(f) | (~F.col("is_list") & short(f)))
    facts = F.transform(F.array_sort(facts), lambda f: F.concat(F.lit('"'), F.when(F.col("is_list"), "first_").otherwise(""), f["k"], F.lit('":'), f["v"]))
    counted = F.when(F.col("is_list"), F.concat(F.array(F.concat(F.lit('"count":'), F.col("n_rows").cast("string"))), facts)).otherwise(facts)
    return e.select(
        *keys, "call_order", "tool",
        F.when(F.col("is_list"), F.col("n_rows")).otherwise(F.when(has["message"], 0).otherwise(1)).alias("records"),
        F.when(F.col("is_list"), F.col("n_rows") == 0).otherwise(has["message"] | has["error"]).alias("sparse"),
        F.concat(F.lit("{"), F.array_join(counted, ","), F.lit("}")).alias("facts"),
        F.when(F.col("is_list"), F.format_string("- %s: %d rows", F.col("tool"), F.col("n_rows")))
         .when(has["message"], F.format_string("- %s: %s", F.col("tool"), F.col("message")))
         .otherwise(F.format_string("- %s: %d fields", F.col("tool"), F.size("fields"))).alias("line"))


def session_summary(ev: DataFrame, keys: Sequence[str] = ("conv_id", "turn")) -> DataFrame:
    """g03 record count, g04 facts of every call, g10 summary lines, and whether any result was sparse (g09)."""
    ordered = F.array_sort(F.collect_list(F.struct("call_order", "tool", "facts", "line")))
    g = ev.groupBy(*keys).agg(F.sum("records").cast("int").alias("evidence_record_count"), ordered.alias("_o"),
                              F.bool_or("sparse").alias("any_sparse"))
    return g.select(*keys, "evidence_record_count",
                    F.array_join(F.transform("_o", lambda x: x["tool"]), ",").alias("tool_names_used"),
                    F.concat(F.lit("{"), F.array_join(F.transform("_o", lambda x: F.concat(F.lit('"'), x["tool"], F.lit('":'), x["facts"])), ","),
                             F.lit("}")).alias("structured_results_json"),
                    F.array_join(F.transform("_o", lambda x: x["line"]), "\n").alias("evidence_summary"), "any_sparse")


SESSION_BASE_TS = "2024-01-01 00:00:00"


def session_rows(plans: DataFrame, conversations: DataFrame, results: DataFrame, context_turns: int = 3) -> DataFrame:
    """g05: the 15-column session log row of every user turn; ``context_turns`` is how many earlier turns a plan was given."""
    keys = ["conv_id", "turn"]
    # the reply is the next turn of the same conversation: an equi-join on (conv, turn + 1)
    # rather than a window over a whole conversation
    nxt = conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"),
                               F.col("role").alias("next_role"))
    users = conversations.filter(F.col("role") == "user").select("conv_id", "turn", "role", "text") \
                         .join(nxt, keys, "left")
    calls = tools.plan_calls(plans)
    cm = cities_from_calls(calls)
    summ = session_summary(evidence(results))
    p = plans.select(*keys, "plan_json", F.get_json_object("plan_json", "$.intent").alias("intent"),
                     F.get_json_object("plan_json", "$.reasoning").alias("reasoning"))
    j = users.join(p, keys, "left").join(cm, keys, "left").join(summ, keys, "left")
    ctx = F.least(F.col("turn"), F.lit(context_turns)).cast("int")
    return j.select(
        F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("session_id"),
        (F.lit(SESSION_BASE_TS).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("conv_id").cast("int"),
                                                                      F.col("turn").cast("decimal(18,6)"))).alias("timestamp"),
        F.col("text").alias("user_question"),
        F.coalesce("intent", F.lit("unknown")).alias("intent"),
        F.coalesce("reasoning", F.lit("")).alias("planner_reasoning"),
        "plan_json",
        F.coalesce(F.when(F.col("next_role") == "assistant", F.col("next_text")), F.lit("")).alias("answer_text"),
        F.coalesce("structured_results_json", F.lit("{}")).alias("structured_results_json"),
        F.coalesce("country_filter", F.lit("UNKNOWN")).alias("country_filter"),
        F.coalesce("cities_mentioned", F.lit("")).alias("cities_mentioned"),
        F.coalesce("tool_names_used", F.lit("")).alias("tool_names_used"),
        F.coalesce("evidence_record_count", F.lit(0)).alias("evidence_record_count"),
        F.coalesce("any_sparse", F.lit(False)).alias("refinement_applied"),
        ctx.alias("context_turns_used"),
        F.lit(None).cast("double").alias("latency_seconds"))


def relaxed_search(listings: DataFrame, card: DataFrame, risk: DataFrame, country_code: str, city: str,
                   min_price_usd=None, max_price_usd=None, bedrooms_min=None, bathrooms_min=None, limit=10,
                   widen: float = 0.30) -> DataFrame:
    """g11: strict search; when it is empty, the same search with price bounds widened by
    ``widen``, bed/bath minimums dropped; a ``relaxed`` flag marks the second set."""
    strict = tools.search_listings(listings, card, risk, country_code, city, min_price_usd, max_price_usd,
                                   bedrooms_min, bathrooms_min, limit=limit).withColumn("relaxed", F.lit(False))
    lo = None if min_price_usd is None else min_price_usd * (1 - widen)
    hi = None if max_price_usd is None else max_price_usd * (1 + widen)
    relaxed = tools.search_listings(listings, card, risk, country_code, city, lo, hi, None, None, limit=limit) \
                   .withColumn("relaxed", F.lit(True))
    return tools._guarded_fallback(strict, relaxed)
