"""Operator 4, approximate nearest neighbours: vantage-point trees per shard, pruned by a relaxed triangle inequality.

Equal vectors collapse to one point with its k + 1 smallest ids, which is all a list of k neighbours can show of them. A
routing tree, fitted on at most ``SAMPLE`` vectors, parts every point into shards by Euclidean distance; a shard is searched
by a vantage-point tree of its own, in parts of at most ``BLOCK`` points and ``CHUNK`` queries, so a hot shard is many tasks.
A query is first searched in its home shard; the distance of its k-th neighbour there bounds the second round, which visits the
other shards that the triangle bounds, multiplied by ``relax``, do not rule out. relax = 1 is the exact search; larger
factors prune more and lose recall. Distances are double precision on the original vectors.

Defined results: vectors that are null, empty, zero or hold a null or a non-finite component take no part, nor do null ids;
vectors of another length are never neighbours; rows that repeat an id with the same vector count once; rows of one id on different
vectors are candidates and queries of their own, each with its list; a query without any candidate has no rows; ties go to the
smaller id; further columns are ignored. Vectors of doubles stay doubles. A point is named by its smallest id and a hash of its vector.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize, prepare, read_table
from .vantage import Router, Tree, euclid

K = 10
RELAX = 1.25
SAMPLE = 16_384
PER_LEAF = 4096
BLOCK = 16_384
CHUNK = 4096


def _matrix(column) -> np.ndarray:
    """An Arrow list column without nulls as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def usable(v: str) -> Column:
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(v).isNotNull() & F.coalesce(good, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = K, relax: float = RELAX) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` (vec_id, embedding) where ``is_query`` holds."""
    spark = prepare(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("embedding").alias("v"), is_query.alias("q")).where(F.col("vec_id").isNotNull() & usable("v"))
    kind = "float" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "double"
    rows = rows.select("vec_id", F.transform("v", lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("v"), "q")      # -0 is 0
    by = Window.partitionBy("v").orderBy("vec_id")
    few = rows.distinct().withColumn("n", F.row_number().over(by)).where(F.col("n") <= k + 1)
    points = materialize(few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
                         .select("v", "ids", F.element_at("ids", 1).alias("pid"), F.xxhash64("v").alias("h"), F.size("v").alias("dim")), "points")
    asked = materialize(rows.where("q").select("vec_id", "v").distinct().join(points.select("v", "pid", "h"), "v")
                        .select(F.col("vec_id").alias("query_id"), "pid", "h"), "asked")
    sizes = points.groupBy("dim").count().collect()                     # a row per length of vector
    parts = [_by_shards(points.where(F.col("dim") == r["dim"]), asked, r["count"], k, relax, kind) for r in sizes]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.union, parts)


def _by_shards(points: DataFrame, asked: DataFrame, n: int, k: int, relax: float, kind: str) -> DataFrame:
    spark = points.sparkSession
    leaves = max(1, min(-(-n // PER_LEAF), SAMPLE // 16))
    every = max(1, n // SAMPLE)
    sample = points.where(F.pmod(F.xxhash64("pid"), F.lit(every)) == 0).orderBy("pid").limit(2 * SAMPLE).select("v").toPandas()["v"]
    fitted = np.stack([np.asarray(x, np.float64) for x in sample]) if len(sample) else np.zeros((0, 1))
    router = spark.sparkContext.broadcast(Router(fitted, leaves, euclid))

    def to_home(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            yield {"leaf": router.value.home(_matrix(b.column("v")))} | {c: b.column(c) for c in ("pid", "h", "v", "ids")}

    shards = materialize(map_batches(points.select("pid", "h", "v", "ids"), to_home, f"leaf int, pid long, h long, v array<{kind}>, ids array<long>"), "shards")
    blocks = {r["leaf"]: -(-r["count"] // BLOCK) for r in shards.groupBy("leaf").count().collect()}      # a row per shard
    queries = shards.select("leaf", "pid", "h", "v").join(asked.select("pid", "h").distinct(), ["pid", "h"]).withColumn("cap", F.lit(float("inf")))

    def search(routed: DataFrame) -> DataFrame:
        """pid, h, found, found_h, d, ids: the k + 1 nearest points in every block that a query is routed to."""
        routed = materialize(routed.select("leaf", "pid", "h", "v", "cap"), "routed")
        chunks = {r["leaf"]: -(-r["count"] // CHUNK) for r in routed.groupBy("leaf").count().collect()}
        grid = [(leaf, blocks[leaf], chunks[leaf]) for leaf in chunks]
        size = F.broadcast(spark.createDataFrame(grid, "leaf int, blocks int, chunks int"))            # a row per shard
        here = (shards.join(size, "leaf").withColumn("block", F.pmod(F.xxhash64("pid", "h"), F.col("blocks")))
                .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("leaf", "block", "chunk", "pid", "h", "v", "ids"))
        ask = (routed.join(size, "leaf").withColumn("chunk", F.pmod(F.xxhash64("pid", "h"), F.col("chunks")).cast("int"))
               .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - F.lit(1).cast("long")))).select("leaf", "block", "chunk", "pid", "h", "v", "cap"))

        def shard(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            if points.empty or queries.empty:
                return pd.DataFrame({"pid": [], "h": [], "found": [], "found_h": [], "d": [], "ids": np.zeros(0, object)})
            points = points.sort_values(["pid", "h"], ignore_index=True)
            tree = Tree(np.stack(points["v"].to_list()).astype(np.float64), points["pid"].to_numpy())
            d, i = tree.nearest(np.stack(queries["v"].to_list()).astype(np.float64), k + 1, relax, queries["cap"].to_numpy())
            q, at = np.nonzero((i >= 0) & (d <= queries["cap"].to_numpy()[:, None] * (1 + 1e-9)))
            rows = i[q, at]
            return pd.DataFrame({"pid": queries["pid"].to_numpy()[q], "h": queries["h"].to_numpy()[q], "found": points["pid"].to_numpy()[rows],
                                 "found_h": points["h"].to_numpy()[rows], "d": d[q, at], "ids": points["ids"].to_numpy()[rows]})

        both = here.groupBy("leaf", "block", "chunk").cogroup(ask.groupBy("leaf", "block", "chunk"))
        return materialize(both.applyInPandas(shard, "pid long, h long, found long, found_h long, d double, ids array<long>"), "found")

    def best(found: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score: ids of the found points, without the query's own."""
        w = Window.partitionBy("pid", "h").orderBy("d", "found", "found_h")
        top = found.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
        own = (F.col("vec_id") == F.col("query_id")) & (F.col("found") == F.col("pid")) & (F.col("found_h") == F.col("h"))
        names = asked.join(top, ["pid", "h"]).select("query_id", "pid", "h", "found", "found_h", "d", F.explode("ids").alias("vec_id")).where(~own)
        rank = F.row_number().over(Window.partitionBy("query_id", "pid", "h").orderBy("d", "vec_id"))
        return names.withColumn("rank", rank).where(F.col("rank") <= k)

    first = search(queries)
    caps = best(first).groupBy("pid", "h", "query_id").agg(F.max("d").alias("d"), F.count("*").alias("n"))
    caps = caps.groupBy("pid", "h").agg(F.max(F.when(F.col("n") >= k, F.col("d")).otherwise(float("inf"))).alias("cap"))

    def to_visit(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            v, home = _matrix(b.column("v")), np.asarray(b.column("leaf"))
            if not len(v):
                continue
            rows, leaf = router.value.visits(v, np.asarray(b.column("cap"), np.float64), relax)
            away = leaf != home[rows]
            b = b.take(pa.array(rows[away]))
            yield {"leaf": leaf[away]} | {c: b.column(c) for c in ("pid", "h", "v", "cap")}

    known = queries.drop("cap").join(caps, ["pid", "h"], "left").select("leaf", "pid", "h", "v", F.coalesce("cap", F.lit(float("inf"))).alias("cap"))
    second = search(map_batches(known, to_visit, f"leaf int, pid long, h long, v array<{kind}>, cap double"))
    return best(first.union(second)).select("query_id", "rank", "vec_id", F.col("d").alias("score"))


def op4_vantage_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
