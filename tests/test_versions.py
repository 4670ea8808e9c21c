"""Change feeds from digests, streaming loads with keyed state, box covers, files of mixed layout."""

import os
import random

from pyspark.sql import functions as F

from parcela.operators import diff, spatial
from parcela.sources import delimited
from parcela.streaming import incremental


def shown(df):
    return sorted(map(str, df.collect()))


def test_version_diff_equals_the_plain_one_and_reads_less(spark, tmp_path):
    old = spark.range(3000).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("x"), "id")).alias("b"))
    one = old.where("id <> 17").union(spark.createDataFrame([(9999, 1, None)], old.schema)).withColumn("a", F.when(F.col("id") == 40, -1).otherwise(F.col("a")))
    moved = old.withColumn("b", F.when(F.col("id") == 41, F.lit("x40")).when(F.col("id") == 40, F.lit("x41")).otherwise(F.col("b")))
    for name, df in (("old", old), ("same", old.orderBy(F.desc("id"))), ("one", one), ("moved", moved), ("none", old.limit(0)), ("all", old.withColumn("a", F.col("a") + 1))):
        diff.write_version(df, f"{tmp_path}/{name}", "id", ranges=64)
    at = lambda n: f"{tmp_path}/{n}"
    assert diff.changed_ranges(spark, at("old"), at("same")) == []
    for name, df in (("same", old), ("one", one), ("moved", moved), ("none", old.limit(0)), ("all", old.withColumn("a", F.col("a") + 1))):
        got = diff.version_diff(spark, at("old"), at(name), old.schema, ["id"])
        assert shown(got) == shown(diff.snapshot_diff(old, df, ["id"]))
    some = diff.changed_ranges(spark, at("old"), at("one"))
    want = {r.r for r in spark.createDataFrame([(17,), (9999,), (40,)], "id long").select(diff.range_of(["id"], 64).alias("r")).collect()}
    assert set(some) == want
    read = diff.version_rows(spark, at("old"), old.schema, some)
    assert len(read.inputFiles()) and read.rdd.getNumPartitions() <= len(diff.version_rows(spark, at("old"), old.schema).inputFiles())
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{diff.RANGE}" in plan


def land(spark, folder, rows):
    spark.createDataFrame(rows, "k string, d int, v int").coalesce(1).write.mode("append").parquet(folder)


SCHEMA = "k string, d int, v int"



def test_stateful_load_restarts_and_replays(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [("a", 1, 1), ("a", 2, 2), ("a", 2, 2), (None, 1, 5)])
    rows = lambda: sorted((r.k or "", r.d, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL(SCHEMA)
    go = lambda c: incremental.run_stateful(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/{c}", ["k", "d"], max_files_per_trigger=1)
    go("ckpt")
    want = [("", 1, 5), ("a", 1, 1), ("a", 2, 2)]
    assert rows() == want
    go("ckpt")                                               # nothing new
    assert rows() == want
    land(spark, f"{tmp_path}/in", [("a", 2, 99), ("b", 1, 3)])
    go("ckpt")                                               # a known key in a later epoch, told by the state alone
    want = sorted([*want, ("b", 1, 3)])
    assert rows() == want
    go("lost")                                               # a new checkpoint sees every file again
    assert rows() == want
    land(spark, f"{tmp_path}/in", [("c", 1, 4), ("a", 1, 7)])
    go("lost")
    assert rows() == sorted([*want, ("c", 1, 4)])


def test_an_epoch_that_is_replayed_overwrites_itself(spark, tmp_path):
    write = incremental.epoch_writer(f"{tmp_path}/out", ["k"], "load1")
    one, two = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("b", 2)], [("c", 3)]))
    for epoch, batch in ((0, one), (0, one), (1, two), (1, two)):
        write(batch, epoch)
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", 1), ("b", 2), ("c", 3)]
    incremental.epoch_writer(f"{tmp_path}/out", ["k"], "load2")(two.union(spark.createDataFrame([("d", 4)], two.schema)), 0)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def test_no_scan_of_the_target_in_later_epochs(spark, tmp_path):
    """The only load of a target reads nothing of it."""
    seen = []
    writer = incremental.epoch_writer(f"{tmp_path}/out", ["k"], "own")
    writer(spark.createDataFrame([("a", 1)], "k string, v int"), 0)
    real = spark.read.parquet
    batch = spark.createDataFrame([("b", 1)], "k string, v int")
    type(spark.read).parquet, kept = (lambda self, *p, **o: seen.append(p) or kept(self, *p, **o)), type(spark.read).parquet
    try:
        writer(batch, 1)
    finally:
        type(spark.read).parquet = kept
    assert seen == [] and real(f"{tmp_path}/out").count() == 2


def inside(lat, lon, box):
    _, a, z, w, e = box
    return a <= lat <= z and any(w <= lon + s <= e for s in (0, 360, -360))


def test_box_join_is_brute_force_for_boxes_of_any_size(spark):
    rng = random.Random(4)
    pts = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(600)] + [(700, 90.0, 180.0), (701, -90.0, -180.0), (702, 0.0, 0.0), (703, 45.0, -180.0), (704, None, 3.0)]
    boxes = [(0, -90.0, 90.0, -180.0, 180.0), (1, -90.0, 90.0, -400.0, 400.0), (2, 10.0, 70.0, 150.0, 260.0), (3, -60.0, -20.0, -200.0, -100.0), (4, 0.0, 0.0, 0.0, 0.0),
             (5, 45.0, 45.0, 170.0, 190.0), (6, 20.0, 10.0, 0.0, 1.0), (7, None, 1.0, 0.0, 1.0)]
    for i in range(60):
        a, w, h = rng.uniform(-90, 89), rng.uniform(-180, 180), rng.choice([0.01, 0.5, 3, 40])
        boxes.append((10 + i, a, min(90.0, a + h), w, w + rng.choice([0.02, 1, 7, 90, 200])))
    p = spark.createDataFrame(pts, "id int, lat double, lon double")
    b = spark.createDataFrame(boxes, "box int, min_lat double, max_lat double, min_lon double, max_lon double")
    want = {(i, x[0]) for i, lat, lon in pts if lat is not None for x in boxes if x[1] is not None and inside(lat, lon, x)}
    for cell in (1.0, 7.0):
        got = [(r.id, r.box) for r in spatial.bbox_join(p, b, ["box"], cell_deg=cell).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    cover = spatial.box_cover(b.where("box < 6 OR box >= 10")).groupBy("box").agg(F.count("*").alias("n"), F.max(F.col("_inner").cast("int")).alias("i"))
    assert cover.agg(F.max("n")).first()[0] <= (spatial.BOX_CELLS + 2) ** 2 and cover.agg(F.max("i")).first()[0] == 1


def test_files_of_any_layout_in_one_scan(spark, tmp_path):
    texts = {"a.csv": "x,y\n1,2\nx,y\n3,\"4,5\"\n", "b.csv": "y;z\n6;7\n\n8;9\n", "c.csv": "z|x| \n10|11|12\n", "d.csv": "only\nA\nB\n", "e.csv": "x\ty\tx\n1\t2\t3\n4\n", "f.csv": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "g.csv").write_bytes("x;ñ\ncafé;2\n".encode("latin-1"))
    df = delimited.read_sniffed(spark, str(tmp_path))
    assert set(df.columns) == {"x", "y", "z", "_c2", "only", "ñ"}
    got = sorted(tuple(r[c] for c in ("x", "y", "z", "_c2", "only", "ñ")) for r in df.fillna("-").collect())
    n = "-"
    assert got == sorted([("1", "2", n, n, n, n), ("x", "y", n, n, n, n), ("3", "4,5", n, n, n, n), (n, "6", "7", n, n, n), (n, "8", "9", n, n, n), ("11", n, "10", "12", n, n),
                          (n, n, n, n, "A", n), (n, n, n, n, "B", n), ("1", "2", n, n, n, n), ("4", n, n, n, n, n), ("café", n, n, n, n, "2")])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") <= 2                # the lines, and the headers
    assert os.listdir(tmp_path)


def test_sniffed_lines_are_neither_sorted_nor_shuffled(spark, tmp_path):
    """A large file must not come into the memory of one task: lines stay where they are read."""
    for name, text in (("a.csv", "x;y\n1;2\n3;4\n"), ("b.csv", "y,z\n5,6\n"), ("c.csv", "x,y\n")):
        (tmp_path / name).write_text(text)
    df = delimited.read_sniffed(spark, str(tmp_path))
    assert sorted(map(tuple, df.select("x", "y", "z").collect()), key=str) == [("1", "2", None), ("3", "4", None), (None, "5", "6")]
    lines = spark.read.text(str(tmp_path)).selectExpr("value", "_metadata.file_path AS file", "_metadata.file_block_start AS block", "monotonically_increasing_id() AS row")
    for plan in (df._jdf.queryExecution().executedPlan().toString(), delimited.sniff_files(lines)._jdf.queryExecution().executedPlan().toString()):
        assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
