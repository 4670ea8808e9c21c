"""Property checks (FIXTURES.md section D) and plan-shape assertions."""

import math

import pytest
from pyspark.sql import functions as F

from parcela.functions import numbers, scoring, text
from parcela.operators import dedupe, diff, rank, spatial, upsert
from parcela.plans.pipeline import Pipeline
from parcela.sources import bindings
from parcela.sources.tables import Tables


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_clamp_and_nullish(spark):
    assert numbers.clamp_limit(99, 10, 1, 50) == 50
    assert numbers.clamp_limit("abc", 10, 1, 50) == 10
    row = spark.range(1).select(text.nullish(F.lit("N/A")).alias("a"), text.nullish(F.lit(" x ")).alias("b")).first()
    assert row["a"] is None and row["b"] == "x"


def test_weights_sum_to_one():
    assert math.isclose(sum(scoring.COMPOSITE_WEIGHTS.values()), 1.0)
    assert math.isclose(sum(scoring.HAZARD_WEIGHTS.values()), 1.0)


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c"), (3, "c")], "k int, v string")
    once = upsert.upsert_all(t, s, ["k"])
    twice = upsert.upsert_all(once, s, ["k"])
    assert _sorted(once) == _sorted(twice) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_subset_updates_only_listed_columns(spark):
    t = spark.createDataFrame([(1, 10, "x")], "k int, price int, note string")
    s = spark.createDataFrame([(1, 20, "y"), (2, 5, "z")], "k int, price int, note string")
    out = _sorted(upsert.upsert_subset(t, s, ["k"], ["price"]))
    assert out == [(1, 20, "x"), (2, 5, "z")]


def test_slice_replace(spark):
    t = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)], "src string, yr int, v double")
    batch = spark.createDataFrame([("a", 1, 9.0)], "src string, yr int, v double")
    out = _sorted(upsert.slice_replace(t, batch, ["src", "yr"]))
    assert out == [("a", 1, 9.0), ("a", 2, 2.0), ("b", 1, 3.0)]
    empty = spark.createDataFrame([], "src string, yr int, v double")
    sl = spark.createDataFrame([("b", 1)], "src string, yr int")
    assert _sorted(upsert.slice_replace(t, empty, ["src", "yr"], sl)) == [("a", 1, 1.0), ("a", 2, 2.0)]


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (3, None)], "k int, v string")
    out = _sorted(diff.snapshot_diff(old, new, ["k"]))
    assert out == [(2, "update_postimage", "B"), (2, "update_preimage", "b"), (4, "insert", "d")]


def test_dedupe_count_equals_distinct_keys(spark, small):
    l = Tables(spark, small).lineitem
    d = dedupe.dedupe_by_key(l, ["l_orderkey", "l_linenumber"])
    assert d.count() == l.select("l_orderkey", "l_linenumber").distinct().count()


def test_percent_rank_matches_window(spark):
    from pyspark.sql import Window
    vals = [(i, float(i % 7) if i % 11 else None, "US" if i % 3 else "CO") for i in range(300)]
    df = spark.createDataFrame(vals, "id int, x double, c string")
    ours = rank.percent_rank(df, "x", "pr", ["c"], buckets=4)
    ref = df.withColumn("pr", F.percent_rank().over(Window.partitionBy("c").orderBy(F.col("x").asc_nulls_last())) * 100.0)
    a = {r["id"]: r["pr"] for r in ours.collect()}
    b = {r["id"]: r["pr"] for r in ref.collect()}
    assert all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in b)
    assert min(a.values()) == 0.0
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def _haversine(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (a[0], a[1], b[0], b[1]))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def test_nearest_and_radius_equal_brute_force(spark, small):
    t = Tables(spark, small)
    c, g = bindings.centroids(t), bindings.grid(t)
    cs = [(r["geo_id"], r["lat"], r["lon"]) for r in c.collect()]
    gs = [(r["point_id"], r["lat"], r["lon"]) for r in g.collect()]
    near = {r["geo_id"]: r["point_id"] for r in spatial.nearest_point(c, g, "geo_id", "point_id").collect()}
    for gid, la, lo in cs:
        best = min(gs, key=lambda p: (_haversine((la, lo), (p[1], p[2])), p[1], p[2], p[0]))
        assert near[gid] == best[0]
    rc = spatial.radius_count(c, g, 2000.0, "geo_id")
    got = {r["geo_id"]: r["n_within"] for r in rc.collect()}
    for gid, la, lo in cs:
        assert got[gid] == sum(1 for p in gs if _haversine((la, lo), (p[1], p[2])) <= 2000.0)
    plan = rc._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pipeline_properties(spark, small):
    p = Pipeline(spark, small)
    prof = p.profile
    r = prof.agg(F.min("amenity_density_score").alias("lo"), F.max("amenity_density_score").alias("hi")).first()
    assert r["lo"] == 0.0 and r["hi"] <= 100.0
    # enrich joins keep the left row count
    assert p.listing_map.count() == p.listings.count()
    # every opportunity respects the rule
    bad = p.value_opportunities(sort=False).filter(
        ~((F.col("price_usd") < F.col("area_median_price_usd") * 0.85) & (F.coalesce("bedrooms", F.lit(0)) >= 1)
          & ((F.col("area_sqft") > 500) | F.col("area_sqft").isNull())))
    assert bad.count() == 0
    # rolling mean over the first row of a series equals the value itself
    from pyspark.sql import Window
    t = p.market_trends.withColumn("rn", F.row_number().over(Window.partitionBy("country_code", "city", "zip_or_municipio").orderBy("date")))
    first = t.filter(F.col("rn") == 1)
    assert first.filter(F.col("median_price_usd_rolling_6mo") != F.col("median_price_usd")).count() == 0
    sc = p.scorecard.agg(F.min("global_percentile_rank").alias("m")).first()
    assert sc["m"] == 0.0


def test_union_count_is_sum_of_parts(spark, small):
    r = bindings.listings(Tables(spark, small))
    us = r.filter(F.col("country_code") == "US")
    co = r.filter(F.col("country_code") == "CO")
    assert us.unionByName(co).count() == us.count() + co.count()


def test_filter_pushdown_reaches_scan(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet").filter(F.col("l_quantity") > 45).select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_incremental_rerun_adds_nothing(spark, small):
    import uuid
    from parcela.session import scratch_path
    from parcela.streaming import incremental
    fx = bindings.fx(Tables(spark, small))
    root = scratch_path(spark, f"t_inc_{uuid.uuid4().hex}")
    fx.write.parquet(f"{root}/landing")
    keys = ["date", "from_currency", "to_currency"]
    incremental.run_incremental(spark, f"{root}/landing", fx.schema, f"{root}/t", f"{root}/c1", keys)
    n1 = spark.read.parquet(f"{root}/t").count()
    incremental.run_incremental(spark, f"{root}/landing", fx.schema, f"{root}/t", f"{root}/c2", keys)
    assert spark.read.parquet(f"{root}/t").count() == n1 == fx.count()


def test_nearest_brute_force_on_clustered_points(spark):
    import random
    rnd = random.Random(7)
    pts = [(i, rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 179.999)) for i in range(150)]
    pts += [(1000 + i, 10 + rnd.uniform(0, 0.01), 20 + rnd.uniform(0, 0.01)) for i in range(200)]   # dense cluster
    pts += [(2000, 89.95, 10.0), (2001, -89.95, -170.0), (2002, 0.0, 179.99), (2003, 0.0, -179.99), (2004, 10.005, 20.005),
            (2005, 10.005, 20.005)]                                                                    # poles, seam, copies
    qs = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 179.999)) for i in range(120)]
    qs += [(500, 10.004, 20.004), (501, 0.0, -179.999), (502, 89.99, -100.0), (503, 10.5, 20.5)]
    left = spark.createDataFrame(qs, "geo_id int, lat double, lon double")
    right = spark.createDataFrame(pts, "point_id int, lat double, lon double")
    got = {r["geo_id"]: r["point_id"] for r in spatial.nearest_point(left, right, "geo_id", "point_id").collect()}
    for gid, la, lo in qs:
        best = min(pts, key=lambda p: (round(_haversine((la, lo), (p[1], p[2])), 9), p[1], p[2], p[0]))
        assert got[gid] == best[0], gid


def test_radius_brute_force_on_clustered_points(spark):
    import random
    rnd = random.Random(11)
    pts = [(rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 179.999), float(i % 5)) for i in range(150)]
    pts += [(10 + rnd.uniform(0, 0.01), 20 + rnd.uniform(0, 0.01), 1.0) for _ in range(300)]
    pts += [(89.95, 10.0, 2.0), (0.0, 179.99, 3.0), (0.0, -179.99, 4.0), (10.005, 20.005, 1.0), (10.005, 20.005, 1.0)]
    qs = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 179.999)) for i in range(80)]
    qs += [(500, 10.2, 20.2), (501, 0.0, -179.999), (502, 89.99, -100.0), (503, 12.0, 22.0)]
    left = spark.createDataFrame(qs, "geo_id int, lat double, lon double")
    right = spark.createDataFrame(pts, "lat double, lon double, v double")
    for r_km in (50.0, 400.0, 3000.0):
        out = spatial.radius_count(left, right, r_km, "geo_id", "n", value_col="v", avg_col="avg_v")
        got = {row["geo_id"]: (row["n"], row["avg_v"]) for row in out.collect()}
        for gid, la, lo in qs:
            inside = [p for p in pts if _haversine((la, lo), (p[0], p[1])) <= r_km]
            n, avg = got[gid]
            assert n == len(inside), (r_km, gid)
            if inside:
                assert math.isclose(avg, sum(p[2] for p in inside) / len(inside), rel_tol=1e-9)
            else:
                assert avg is None


def test_partitioned_write_prunes_partitions(spark, small):
    import uuid
    from parcela.session import scratch_path
    from parcela.sources import sinks
    w = bindings.weather(Tables(spark, small))
    path = scratch_path(spark, f"t_part_{uuid.uuid4().hex}")
    sinks.replace_partitions(w, path, ["country_code"])
    back = spark.read.parquet(path).filter(F.col("country_code") == "US")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country_code" in plan and "(country_code" in plan
    assert back.count() == w.filter(F.col("country_code") == "US").count()
    # a second batch replaces only its own partition
    sinks.replace_partitions(w.filter(F.col("country_code") == "CO").limit(3), path, ["country_code"])
    again = spark.read.parquet(path)
    assert again.filter(F.col("country_code") == "US").count() == w.filter(F.col("country_code") == "US").count()
    assert again.filter(F.col("country_code") == "CO").count() == 3


def test_snapshot_versions_never_reuse_a_folder(spark):
    import uuid
    from parcela.session import scratch_path
    from parcela.sources import sinks
    root = scratch_path(spark, f"t_ver_{uuid.uuid4().hex}")
    df = spark.range(5)
    p0 = sinks.write_snapshot(df, root)
    p1 = sinks.write_snapshot(df.filter("id > 2"), root)
    assert p0.endswith("v=0") and p1.endswith("v=1")
    assert sinks.read_current(spark, root).count() == 2


def test_median_of_values_close_together(spark):
    """One key whose values lie within 0.01 %: no window holds more than a small share of them."""
    import statistics

    from pyspark.sql import functions as F

    from parcela.operators import median
    rows = spark.range(40_000).select(F.lit("a").alias("k"), (F.lit(250_000.0) + F.col("id") * 0.0005).alias("v"))
    rows = rows.unionAll(spark.createDataFrame([("a", 1.0), ("a", 9e9), ("b", -0.0), ("b", float("inf")), ("c", float("inf")), ("c", None), ("d", None)], "k string, v double"))
    want = {}
    for r in rows.where("v is not null").collect():
        want.setdefault(r.k, []).append(r.v)
    got = {r.k: r.m for r in median.exact_median(rows, ["k"], "v", "m").collect()}
    assert got == {k: statistics.median(v) for k, v in want.items()} | {"d": None}
    counts = rows.where("k = 'a'").groupBy("k", "v").agg(F.count("*").alias("n"))
    c = counts.select("k", F.col("v").alias("_v"), F.col("n").alias("_n"), F.col("v").alias("_x"), F.lit(0).cast("long").alias("_below"),
                      F.lit(None).cast("long").alias("_all"), median.bucket_of(F.col("v")).alias("_b"))
    first = median._middle_buckets(c, ["k"])
    again = first.withColumn("_b", F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * median.RESOLUTION)).drop("_lo", "_hi")
    assert first.count() > 10_000 and median._middle_buckets(again, ["k"]).count() < 100


def test_exact_median(spark):
    """Equal to the built-in median with a key that holds most rows, even and odd groups, NULLs and negatives."""
    import random

    from pyspark.sql import functions as F

    from parcela.operators.median import exact_median, exact_medians
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1.5, -3.0, 2.25, 1e9, 0.0, rng.uniform(-5, 5)])) for _ in range(501)]
    rows += [("hot", float(i % 77)) for i in range(3000)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m").collect()}
    assert got.keys() == want.keys() and all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-9 for k in want)
    assert exact_median(df, [], "v", "m").first().m == df.agg(F.median("v").alias("m")).first().m
    assert exact_median(df.limit(0), [], "v", "m").first().m is None
    two = exact_medians(df.withColumn("w", -F.col("v")), ["k"], ["v", "w"]).collect()
    assert all(r.v == want[r.k] and r.w == (None if want[r.k] is None else -want[r.k]) for r in two)
    plan = exact_median(df, ["k"], "v", "m")._jdf.queryExecution().toString()
    assert "median(" not in plan and "percentile" not in plan


def test_bbox_join_across_the_antimeridian(spark):
    from parcela.operators import spatial
    pts = spark.createDataFrame([(1, 0.0, 180.0), (2, 0.0, 179.9), (3, 0.0, -179.5), (4, 0.0, -178.0), (5, 0.0, -180.0), (6, 0.0, 10.0)], "geo_id long, lat double, lon double")
    boxes = spark.createDataFrame([("e", -1.0, 1.0, 179.0, 181.0), ("w", -1.0, 1.0, -181.0, -179.0), ("all", -1.0, 1.0, -200.0, 200.0)],
                                  "k string, min_lat double, max_lat double, min_lon double, max_lon double")
    got = {(r.k, r.geo_id) for r in spatial.bbox_join(pts, boxes, ["k"], cell_deg=1.0).collect()}
    near = {1, 2, 3, 5}
    assert got == {("e", i) for i in near} | {("w", i) for i in near} | {("all", i) for i in range(1, 7)}


def test_bad_values_become_null(spark):
    """One bad landed value never stops a load."""
    from pyspark.sql import functions as F

    from parcela.functions import dates, labels, numbers
    from parcela.sources import payloads
    bad = spark.createDataFrame([("1e30",), ("Infinity",), ("NaN",), ("-1e20",), ("abc",), ("",), (None,)], "x string")
    out = bad.select(labels.month_number("x").alias("m"), labels.grade_format("x").alias("g"), numbers.safe_int("x").alias("i"),
                     numbers.clamp_param("x", 7, 1, 50).alias("c"), dates.parse_listing_date("x").alias("d"),
                     dates.period_month_date(F.lit("99999"), F.lit("M03")).alias("p"), numbers.cop_to_usd(F.col("x").try_cast("double"), F.lit(0.5)).alias("u")).collect()
    assert all(r.m is None and r.d is None and r.p is None and 1 <= r.c <= 50 for r in out)
    daily = spark.createDataFrame([('{"daily":{"time":["2020-01-01","2020-13-45","x"],"temperature_2m_max":["1"]}}',)], "p string")
    assert [r.date is None for r in payloads.parse_daily_arrays(daily, "p").collect()] == [False, True, True]
    matrix = spark.createDataFrame([('[["A","B"],["1","2"],["3"],[]]',)], "p string")
    assert {(r.a, r.b, r.z) for r in payloads.parse_header_matrix(matrix, "p", {"a": "A", "b": "B", "z": "Z"}).collect()} == {("1", "2", None), ("3", None, None), (None, None, None)}
    page = spark.createDataFrame([('{"results":[{"zpid":"1","price":"1e30"},{"zpid":"2","price":"5"}]}',)], "p string")
    assert {(r.listing_id, r.price_usd) for r in payloads.parse_listing_pages(page, "p").collect()} == {("1", None), ("2", 5)}


def test_market_scans_the_orders_once(spark, small):
    """The median reads written counts of prices: its plan has no scan of the orders."""
    t = Tables.shared(spark, small)
    df = bindings.market(t)
    assert not any("orders.parquet" in f for f in df.inputFiles()) and any("market_counts_" in f for f in df.inputFiles())
    assert df.agg(F.sum("inventory_count")).first()[0] == t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).count()
