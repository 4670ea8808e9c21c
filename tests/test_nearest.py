"""The quadtree descent of the nearest-point search: brute force, and what it leaves unread."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcela.operators import spatial


def km(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * spatial.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def clusters(seed):
    rng = random.Random(seed)
    pts = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)]
    for lat, lon in ((10.0, 179.9995), (10.0, -179.9995), (89.999, 3.0), (-89.9999, 77.0), (40.0, -74.0), (0.0, 0.0)):
        pts += [(len(pts) + j, max(-90.0, min(90.0, lat + rng.uniform(-1e-3, 1e-3))), (lon + rng.uniform(-1e-3, 1e-3) + 180) % 360 - 180) for j in range(150)]
    pts += [(5000, 90.0, 0.0), (5001, -90.0, 12.0), (5002, 3.0, 180.0), (5003, 3.0, -180.0), (5004, 3.0, 180.0), (5005, None, 1.0)]
    asked = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(80)] + [(100 + i, p[1], p[2]) for i, p in enumerate(pts[::60]) if p[1] is not None]
    asked += [(200, 90.0, 100.0), (201, -90.0, -100.0), (202, 10.0, 180.0), (203, 10.0, -180.0), (204, 40.0005, -74.0005), (205, None, 2.0), (206, 40.0005, -74.0005)]
    return pts, asked


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_is_brute_force(spark, seed):
    pts, asked = clusters(seed)
    got = spatial.nearest_point(spark.createDataFrame(asked, "geo_id int, lat double, lon double"), spark.createDataFrame(pts, "point_id int, lat double, lon double"),
                                "geo_id", "point_id").collect()
    assert len(got) == len(asked)
    for r in got:
        if r.lat is None:
            assert r.point_id is None
            continue
        best = min((km((r.lat, r.lon), p[1:]), p[0]) for p in pts if p[1] is not None)
        assert r.dist_km == pytest.approx(best[0], abs=1e-6), r
    none = spatial.nearest_point(spark.createDataFrame(asked, "geo_id int, lat double, lon double"), spark.createDataFrame([], "point_id int, lat double, lon double"), "geo_id", "point_id")
    assert [r.point_id for r in none.collect()] == [None] * len(asked)


def test_a_dense_cluster_is_not_scanned(spark):
    """40,000 points within a kilometre, which hold the nearest point of locations beside and inside: a few points are compared."""
    pts = spark.range(40_000).select(F.col("id").alias("point_id"), (F.rand(1) * 0.01 + 40).alias("lat"), (F.rand(2) * 0.01 - 74).alias("lon")).cache()
    n = 1 << spatial.TREE_LEVELS
    cells = pts.select(F.col("lat").alias("_plat"), F.col("lon").alias("_plon")).withColumn("_r", F.floor((F.col("_plat") + 90) / 180 * n).cast("int")).withColumn(
        "_c", F.floor((F.col("_plon") + 180) / 180 * n).cast("int"))
    locs = spark.createDataFrame([(40.02, -73.9), (40.005, -73.995), (39.0, -74.0), (-30.0, 100.0)], "_llat double, _llon double")
    read = spatial._nearest_cells(locs, cells).join(cells, ["_r", "_c"]).groupBy("_llat", "_llon").count().collect()
    assert len(read) == 4 and max(r["count"] for r in read) < 40
