"""Grid-bucketed spatial joins (j11 nearest point, j12 radius, j13 bounding boxes).

Points are keyed by grid cell; each query point is exploded to the few cells
it can reach and equi-joined on the cell, followed by an exact haversine test.
No cartesian product is formed; a hot cell is split by AQE's skew join, and
points sharing exact coordinates are pre-aggregated before the join.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, KM_PER_DEG_LAT, haversine
from ..session import scratch_path


def snap_cell(cell_deg: float) -> float:
    """Largest cell size <= ``cell_deg`` that divides 180 degrees, so rows end at the
    poles and columns wrap exactly at the antimeridian."""
    return 180.0 / math.ceil(180.0 / max(cell_deg, 1e-6))


def _cells_for_reach(lat, lon, cell_deg: float, reach_km: float):
    """Array of (row, col) cells whose points may lie within ``reach_km`` of (lat, lon)."""
    n_rows = int(math.ceil(180.0 / cell_deg))
    n_cols = int(math.ceil(360.0 / cell_deg))
    dlat = reach_km / KM_PER_DEG_LAT
    ang = min(reach_km / EARTH_RADIUS_KM, math.pi)
    lat_c = F.col(lat) if isinstance(lat, str) else lat
    lon_c = F.col(lon) if isinstance(lon, str) else lon
    r0 = F.greatest(F.lit(0), F.floor((lat_c - dlat + 90.0) / cell_deg).cast("int"))
    r1 = F.least(F.lit(n_rows - 1), F.floor((lat_c + dlat + 90.0) / cell_deg).cast("int"))
    # longitude reach of a spherical cap; the whole circle when the cap holds a pole
    coslat = F.cos(F.radians(lat_c))
    s = math.sin(ang)
    pole = (F.abs(lat_c) + dlat >= 90.0) | (coslat <= s) | F.lit(ang >= math.pi / 2)
    dlon = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(s) / coslat)))
    c0 = F.floor((lon_c - dlon + 180.0) / cell_deg).cast("int")
    c1 = F.floor((lon_c + dlon + 180.0) / cell_deg).cast("int")
    all_cols = pole | (c1 - c0 + 1 >= n_cols)
    cols = F.when(all_cols, F.sequence(F.lit(0), F.lit(n_cols - 1))) \
            .otherwise(F.transform(F.sequence(c0, c1), lambda c: F.pmod(c, F.lit(n_cols))))
    rows = F.sequence(r0, r1)
    return rows, cols, n_cols


def _point_cells(points: DataFrame, cell_deg: float, lat="lat", lon="lon") -> DataFrame:
    n_rows = int(math.ceil(180.0 / cell_deg))
    n_cols = int(math.ceil(360.0 / cell_deg))
    return (points
            .withColumn("_row", F.least(F.lit(n_rows - 1), F.floor((F.col(lat) + 90.0) / cell_deg).cast("int")))
            .withColumn("_col", F.pmod(F.floor((F.col(lon) + 180.0) / cell_deg).cast("int"), F.lit(n_cols))))


def _explode_cells(df: DataFrame, rows, cols) -> DataFrame:
    return (df.withColumn("_row", F.explode(rows))
              .withColumn("_col", F.explode(F.array_distinct(cols))))


def radius_count(left: DataFrame, right: DataFrame, radius_km: float, left_id: str,
                 out_col: str = "n_within", value_col: str | None = None, avg_col: str | None = None,
                 left_lat="lat", left_lon="lon") -> DataFrame:
    """j12: per left row, the number of right points within ``radius_km`` (0 when none)
    and optionally the mean of ``value_col`` over them. Right points with equal
    coordinates are collapsed to one weighted point first, and left rows sharing a
    location are searched once, so copies of a location never multiply the pairs."""
    agg = [F.count(F.lit(1)).alias("_w")]
    if value_col:
        agg.append(F.sum(value_col).alias("_s"))
        agg.append(F.count(value_col).alias("_sn"))
    pts = right.groupBy("lat", "lon").agg(*agg)
    cols = ["_w"] + (["_s", "_sn"] if value_col else [])
    locs = left.select(F.col(left_lat).alias("_qlat"), F.col(left_lon).alias("_qlon")).dropna().distinct()
    # cells a quarter of the radius wide: a cell entirely inside the circle contributes its
    # pre-aggregated totals, a cell entirely outside is dropped, and only boundary cells
    # are checked point by point -- a dense cluster inside the circle costs one row
    cell = snap_cell(max(radius_km / KM_PER_DEG_LAT / 4.0, 0.01))
    rows, ccols, _ = _cells_for_reach("_qlat", "_qlon", cell, radius_km)
    q = _explode_cells(locs.withColumn("_rows", rows).withColumn("_cols", ccols), F.col("_rows"), F.col("_cols")) \
        .drop("_rows", "_cols")
    pc = _point_cells(pts, cell)
    cell_tot = pc.groupBy("_row", "_col").agg(*[F.sum(c).alias(c) for c in cols])
    qc = q.join(cell_tot, ["_row", "_col"])
    clat = (F.col("_row") + 0.5) * cell - 90.0
    clon = (F.col("_col") + 0.5) * cell - 180.0
    half = EARTH_RADIUS_KM * 2 * math.asin(min(1.0, math.sqrt(2.0) * math.sin(math.radians(cell) / 4)))
    ub = haversine("_qlat", "_qlon", clat, clon) + F.lit(half)
    lb = _cell_lower_bound(F.col("_qlat"), F.col("_qlon"), F.col("_row"), F.col("_col"), cell)
    qc = qc.withColumn("_ub", ub).withColumn("_lb", lb).filter(F.col("_lb") <= radius_km * (1 + 1e-9) + 1e-9)
    inside = qc.filter(F.col("_ub") < radius_km * (1 - 1e-9)).select("_qlat", "_qlon", *cols)
    edge = qc.filter(F.col("_ub") >= radius_km * (1 - 1e-9)).select("_qlat", "_qlon", "_row", "_col")
    near = edge.join(pc, ["_row", "_col"]).filter(haversine("_qlat", "_qlon", "lat", "lon") <= radius_km) \
               .select("_qlat", "_qlon", *cols)
    pairs = inside.unionByName(near).withColumn("_qid", F.struct("_qlat", "_qlon"))
    outs = [F.sum("_w").alias(out_col)]
    if value_col:
        outs.append((F.sum("_s") / F.sum("_sn")).alias(avg_col or f"avg_{value_col}"))
    per = pairs.groupBy("_qid").agg(*outs).select(F.col("_qid._qlat").alias("_jlat"), F.col("_qid._qlon").alias("_jlon"),
                                                   *[o for o in [out_col] + ([avg_col or f"avg_{value_col}"] if value_col else [])])
    res = left.join(per, (F.col(left_lat) == F.col("_jlat")) & (F.col(left_lon) == F.col("_jlon")), "left") \
              .drop("_jlat", "_jlon")
    return res.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(0)).cast("bigint"))


def _cell_lower_bound(lat, lon, row, col, size: float):
    """Lower bound (km) of the distance from (lat, lon) to any point of grid cell (row, col)."""
    lat0 = row * size - 90.0
    lat1 = lat0 + size
    gap_lat = F.greatest(F.lit(0.0), lat0 - lat, lat - lat1)
    lon0 = col * size - 180.0
    inside = F.pmod(lon - lon0, F.lit(360.0)) <= size
    gap_lon = F.when(inside, F.lit(0.0)).otherwise(
        F.least(F.pmod(lon0 - lon, F.lit(360.0)), F.pmod(lon - (lon0 + size), F.lit(360.0))))
    # points at least gap_lon away in longitude are at least asin(cos(lat) * sin(gap)) away
    # (for gaps of 90 degrees or more, at least the distance to the nearer pole)
    lon_lb = F.lit(EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.abs(F.cos(F.radians(lat)))
                                                      * F.sin(F.radians(F.least(gap_lon, F.lit(90.0))))))
    # a cell lies within half its diagonal of its centre: close for small cells and far points
    half = EARTH_RADIUS_KM * 2 * math.asin(min(1.0, math.sqrt(2.0) * math.sin(math.radians(size) / 4)))
    centre = haversine(lat, lon, lat0 + size / 2, lon0 + size / 2)
    return F.greatest(F.lit(KM_PER_DEG_LAT) * gap_lat, lon_lb, centre - F.lit(half))


TREE_LEVELS, TREE_STEP = 24, 3        # cells of 180 / 2 ** 24 degrees (about a metre); levels that a step of the descent goes down


def _tree(pts: DataFrame) -> DataFrame:
    """The non-empty cells of every step's level with one of their points: ``_level``, ``_nr``, ``_nc``, ``_rep``. Written once, by level."""
    levels = list(range(TREE_STEP, TREE_LEVELS + 1, TREE_STEP))
    up = F.explode(F.array(*[F.struct(F.lit(level).alias("_level"), F.shiftright("_r", TREE_LEVELS - level).alias("_nr"),
                                      F.shiftright("_c", TREE_LEVELS - level).alias("_nc")) for level in levels]))
    cells = pts.select(up.alias("_n"), F.struct("_plat", "_plon").alias("_p")).groupBy("_n._level", "_n._nr", "_n._nc").agg(F.min("_p").alias("_rep"))
    path = scratch_path(pts.sparkSession, f"quadtree_{uuid.uuid4().hex}")
    cells.write.partitionBy("_level").parquet(path)
    return pts.sparkSession.read.schema("_nr int, _nc int, _rep struct<_plat: double, _plon: double>, _level int").parquet(path)


def _nearest_cells(locs: DataFrame, pts: DataFrame) -> DataFrame:
    """Locations (``_llat``, ``_llon``) with the finest cells (``_r``, ``_c``) that may hold their nearest point."""
    tree = _tree(pts)
    open_ = locs.withColumn("_r", F.lit(0)).withColumn("_c", F.explode(F.array(F.lit(0), F.lit(1))))       # two cells cover the globe
    for level in range(TREE_STEP, TREE_LEVELS + 1, TREE_STEP):
        size = 180.0 / (1 << level)
        nodes = tree.where(F.col("_level") == level).select(F.shiftright("_nr", TREE_STEP).alias("_r"), F.shiftright("_nc", TREE_STEP).alias("_c"), "_nr", "_nc", "_rep")
        below = open_.join(nodes, ["_r", "_c"])
        below = below.withColumn("_ub", haversine("_llat", "_llon", F.col("_rep._plat"), F.col("_rep._plon"))) \
                     .withColumn("_lb", _cell_lower_bound(F.col("_llat"), F.col("_llon"), F.col("_nr"), F.col("_nc"), size))
        # a location has a few open cells, each with at most 4 ** TREE_STEP cells below it: a bounded window
        least = F.min("_ub").over(Window.partitionBy("_llat", "_llon"))
        below = below.withColumn("_u", least).where(F.col("_lb") <= F.col("_u") * (1 + 1e-9) + 1e-6)
        open_ = below.select("_llat", "_llon", F.col("_nr").alias("_r"), F.col("_nc").alias("_c"))
    return open_


def nearest_point(left: DataFrame, right: DataFrame, left_id: str, right_id: str, payload: Sequence[str] = ()) -> DataFrame:
    """j11: for each left point, the nearest right point by great-circle distance.

    The right points form a quadtree of cells; every cell knows one of its points. All left points descend together: at each level
    the nearest known point of a left point's open cells is an achievable distance, and a cell whose lower bound is beyond it is closed.
    What stays open at the finest level, cells of about a metre, is compared point by point, so a dense cluster is never scanned,
    not even when it holds the nearest point. Ties break on the smallest (distance, lat, lon, id). Left points get NULLs when the
    right side is empty or their own coordinates are NULL.
    """
    # points sharing exact coordinates collapse to the one the tie-break would pick
    # (smallest id), so a location repeated a billion times is one candidate
    n = 1 << TREE_LEVELS
    pts = (right.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy(F.col("lat").cast("double").alias("_plat"), F.col("lon").cast("double").alias("_plon"))
                .agg(F.min(F.struct(F.col(right_id).alias("_pid"), *[F.col(c) for c in payload])).alias("_p"))
                .select("_plat", "_plon", "_p._pid", *[F.col(f"_p.{c}").alias(c) for c in payload]))
    pts = (pts.withColumn("_r", F.least(F.lit(n - 1), F.floor((F.col("_plat") + 90.0) / 180.0 * n).cast("int")))
              .withColumn("_c", F.pmod(F.floor((F.col("_plon") + 180.0) / 180.0 * n).cast("int"), F.lit(2 * n))))
    # query points are searched once per distinct location and joined back at the end
    locs = left.select(F.col("lat").alias("_llat"), F.col("lon").alias("_llon")).dropna().distinct()
    j = _nearest_cells(locs, pts).join(pts, ["_r", "_c"])
    d = haversine("_llat", "_llon", "_plat", "_plon")
    best = (j.withColumn("_d", d).groupBy("_llat", "_llon")
             .agg(F.min(F.struct(F.col("_d"), F.col("_plat"), F.col("_plon"), F.col("_pid"), *[F.col(c) for c in payload])).alias("_b")))
    res = left.join(best.select(F.col("_llat").alias("_jlat"), F.col("_llon").alias("_jlon"), "_b"),
                    (F.col("lat") == F.col("_jlat")) & (F.col("lon") == F.col("_jlon")), "left")
    return res.select(*left.columns, F.col("_b._pid").alias(right_id),
                      F.col("_b._d").alias("dist_km"), *[F.col(f"_b.{c}").alias(c) for c in payload])


def envelope(df: DataFrame, keys: Sequence[str], pad_deg: float = 0.0, pad_frac: float = 0.0,
             min_pad_deg: float = 0.0) -> DataFrame:
    """a04: min/max lat/lon per key, padded by max(pad_frac * span, min_pad_deg) + pad_deg."""
    e = df.groupBy(*keys).agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
                              F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"))
    plat = F.greatest(F.lit(min_pad_deg), (F.col("max_lat") - F.col("min_lat")) * pad_frac) + pad_deg
    plon = F.greatest(F.lit(min_pad_deg), (F.col("max_lon") - F.col("min_lon")) * pad_frac) + pad_deg
    return e.select(*keys, (F.col("min_lat") - plat).alias("min_lat"), (F.col("max_lat") + plat).alias("max_lat"),
                    (F.col("min_lon") - plon).alias("min_lon"), (F.col("max_lon") + plon).alias("max_lon"))


BOX_CELLS = 4                # cells that the longer side of a box spans, or one more


def _box_levels(cell_deg: float) -> list[float]:
    """Cell sizes from the whole globe down to about ``cell_deg``, each half of the one before."""
    sizes = [180.0]
    while sizes[-1] / 2 >= min(cell_deg, 180.0) * (1 - 1e-9):
        sizes.append(sizes[-1] / 2)
    return sizes


def box_cover(boxes: DataFrame, cell_deg: float = 1.0) -> DataFrame:
    """``boxes`` with one row a cell that covers it: ``_level``, ``_row``, ``_col`` and ``_inner``, true if the whole cell lies in the box.

    The size of a box picks its level, so that any box, whatever its extent, is at most (BOX_CELLS + 2) squared cells."""
    sizes = F.array(*[F.lit(s) for s in _box_levels(cell_deg)])
    span = F.least(F.lit(360.0), F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lon") - F.col("min_lon")))
    level = F.greatest(F.lit(0), F.size(F.filter(sizes, lambda s: s >= span / BOX_CELLS)) - 1)
    b = boxes.withColumn("_level", level).withColumn("_size", F.element_at(sizes, F.col("_level") + 1))
    top, right = F.lit(180.0) / F.col("_size") - 1, F.lit(360.0) / F.col("_size")
    b = (b.withColumn("_row", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("min_lat") + 90.0) / F.col("_size")).cast("int")),
                                                   F.least(top.cast("int"), F.floor((F.col("max_lat") + 90.0) / F.col("_size")).cast("int")))))
         .withColumn("_west", F.pmod(F.col("min_lon") + 180.0, F.lit(360.0))).withColumn("_wide", F.least(F.col("max_lon") - F.col("min_lon"), F.lit(360.0)))
         .withColumn("_first", F.floor(F.col("_west") / F.col("_size")).cast("int"))
         .withColumn("_last", F.floor((F.col("_west") + F.col("_wide")) / F.col("_size")).cast("int"))
         .withColumn("_at", F.explode(F.sequence(F.col("_first"), F.least(F.col("_last"), F.col("_first") + right.cast("int") - 1)))))
    south, west = F.col("_row") * F.col("_size") - 90.0, F.col("_at") * F.col("_size")
    inner = ((south >= F.col("min_lat")) & (south + F.col("_size") <= F.col("max_lat"))
             & (F.col("_wide") >= 360.0) | (south >= F.col("min_lat")) & (south + F.col("_size") <= F.col("max_lat"))
             & (west >= F.col("_west")) & (west + F.col("_size") <= F.col("_west") + F.col("_wide")))
    b = b.withColumn("_inner", inner).withColumn("_col", F.pmod("_at", right.cast("int")))
    return b.drop("_size", "_west", "_wide", "_first", "_last", "_at")


def bbox_join(points: DataFrame, boxes: DataFrame, box_keys: Sequence[str], cell_deg: float = 1.0) -> DataFrame:
    """j13: (point, box) pairs with the point inside the box (edges included).

    Boxes are covered by a few cells of a size that fits them (``box_cover``), points take the cell of every level that some box
    uses, and the two meet by equality. Points of an inner cell need no test. Columns wrap at the antimeridian: a box may run past
    180 or -180 degrees."""
    sizes = _box_levels(cell_deg)
    cover = box_cover(boxes.select(*box_keys, "min_lat", "max_lat", "min_lon", "max_lon")
                      .where((F.col("min_lat") <= F.col("max_lat")) & (F.col("min_lon") <= F.col("max_lon"))), cell_deg)
    used = sorted(r["_level"] for r in cover.select("_level").distinct().collect())          # at most a number a level
    if not used:
        used = [0]
    level = F.explode(F.array(*[F.struct(F.lit(i).alias("_level"), F.lit(sizes[i]).alias("_size")) for i in used]))
    p = points.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).withColumn("_l", level)
    size = F.col("_l._size")
    p = (p.withColumn("_level", F.col("_l._level"))
         .withColumn("_row", F.least((F.lit(180.0) / size - 1).cast("int"), F.floor((F.col("lat") + 90.0) / size).cast("int")))
         .withColumn("_col", F.pmod(F.floor((F.col("lon") + 180.0) / size).cast("int"), (F.lit(360.0) / size).cast("int"))).drop("_l"))
    j = p.join(cover, ["_level", "_row", "_col"])
    inside = (F.col("lat").between(F.col("min_lat"), F.col("max_lat"))
              & (F.col("lon").between(F.col("min_lon"), F.col("max_lon"))
                 | (F.col("lon") + 360.0).between(F.col("min_lon"), F.col("max_lon"))
                 | (F.col("lon") - 360.0).between(F.col("min_lon"), F.col("max_lon"))))
    return j.filter(F.col("_inner") | inside).drop("_level", "_row", "_col", "_inner", "min_lat", "max_lat", "min_lon", "max_lon")
