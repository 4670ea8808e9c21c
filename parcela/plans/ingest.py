"""Ingest composites (c24-c36): landed payload -> typed bronze rows -> keyed merge.

Each job is one lazy plan: parse (``sources``), conform, derive scores and
labels, then merge with the existing table by key (``operators.upsert``) or by
high-water mark. Nothing loops on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels, numbers, text
from ..operators import dedupe, filters, rank, spatial, upsert


def icfes_institutions(students: DataFrame, registry: DataFrame, city_sets: dict[str, tuple[Sequence[str], Sequence[str]]],
                       buckets: int | None = None) -> DataFrame:
    """c24: student scores -> institution mean and size, national average-tie percentile,
    the exam year (mode of the student years), registry join, then the city filter.

    ``city_sets``: label -> (department aliases, municipality aliases), normalised (f04)."""
    s = students.select(text.safe_str("school_id").alias("school_id"), numbers.safe_float("score").alias("score"),
                        F.substring(F.col("year").cast("string"), 1, 4).try_cast("int").alias("year"))
    s = s.filter(F.col("school_id").isNotNull() & F.col("score").isNotNull())
    yc = s.filter(F.col("year").isNotNull()).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    mode = yc.agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("year").alias("y"))).alias("m")) \
             .select(F.col("m.y").alias("icfes_year"))                       # a12: one row
    inst = s.groupBy("school_id").agg(F.avg("score").alias("icfes_score"), F.count(F.lit(1)).alias("student_count"))
    inst = rank.average_rank_percentile(inst, "icfes_score", "icfes_percentile", buckets=buckets)
    reg = dedupe.dedupe_by_key(registry, ["school_id"])
    j = reg.join(inst, "school_id", "inner").crossJoin(F.broadcast(mode))
    dn, mn = text.token_normalize("departamento"), text.token_normalize("municipio")
    keep = F.lit(False)
    for _, (depts, munis) in city_sets.items():
        keep = keep | (dn.isin(list(depts)) & mn.isin(list(munis)))
    return j.filter(keep).withColumn("school_type", labels.school_sector_type("sector")).drop("sector")


def disaster_frequency(declarations: DataFrame, full_scale: int = 50) -> DataFrame:
    """c26: declarations -> count per (state, county, hazard), score min(n/50, 1), label,
    deterministic sample record."""
    d = declarations.withColumn("hazard_type", labels.incident_hazard_type("incident_type")).filter(F.col("hazard_type").isNotNull())
    g = d.groupBy("state", "county", "hazard_type").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.col("declaration_id"), F.col("declaration_id")).alias("sample_id"))
    score = numbers.score_from_measure("n", full_scale)
    return g.select(F.concat_ws("_", F.lit("fema"), "hazard_type", "state", text.id_token("county")).alias("hazard_id"),
                    "state", "county", "hazard_type", "n", score.alias("risk_score"), labels.risk_level(score).alias("risk_level"),
                    "sample_id")


def earthquake_from_grid(centroids: DataFrame, grid: DataFrame, full_scale: float = 0.5) -> DataFrame:
    """c27: nearest measured point per centroid -> PGA score -> label."""
    n = spatial.nearest_point(centroids, grid, "geo_id", "point_id", payload=["pga"])
    score = numbers.score_from_measure("pga", full_scale)
    return n.select("geo_id", "point_id", F.round("dist_km", 4).alias("dist_km"), "pga", score.alias("risk_score"),
                    labels.risk_level(score).alias("risk_level"))


def risk_class_rows(rows: DataFrame, hazard_type: str) -> DataFrame:
    """c28: class text -> score per municipality (max over rows), label."""
    r = rows.withColumn("risk_score", labels.risk_class_score("classification")).filter(F.col("risk_score").isNotNull())
    g = r.groupBy("municipio").agg(F.max("risk_score").alias("risk_score"))
    return g.select(F.concat_ws("_", F.lit("ungrd"), F.lit(hazard_type), text.id_token("municipio")).alias("hazard_id"),
                    "municipio", F.lit(hazard_type).alias("hazard_type"), "risk_score", labels.risk_level("risk_score").alias("risk_level"))


def flood_zone_rows(features: DataFrame, state_col: str) -> DataFrame:
    """c29: parsed flood features -> hazard id, place, score and label per area of a state."""
    return features.select(F.concat_ws("_", F.lit("fema_flood"), state_col, "area_id").alias("hazard_id"), F.col(state_col).alias("state_or_dept"),
                           F.col("county").alias("county_or_municipio"), F.col("zone").alias("zip_or_zone"), F.lit("flood").alias("hazard_type"),
                           "risk_score", labels.risk_level("risk_score").alias("risk_level"), "details_json")


HAZARD_ROW = {"hazard_id": "string", "source": "string", "country_code": "string", "state_or_dept": "string", "county_or_municipio": "string",
              "zip_or_zone": "string", "lat": "double", "lon": "double", "hazard_type": "string", "risk_level": "string", "risk_score": "double",
              "data_date": "date", "details_json": "string", "ingested_at": "timestamp"}
HAZARD_SLICE = ["source", "hazard_type", "dataset"]


def hazard_block(rows: DataFrame, source: str, country_code: str, dataset: str, **named) -> DataFrame:
    """d15: the 14 hazard columns and the dataset they come from; ``named`` gives a column another name, absent ones are NULL.

    Rows that repeat a hazard_id collapse to the largest (the order of columns decides)."""
    given = {"source": F.lit(source), "country_code": F.lit(country_code)} | {k: F.col(v) for k, v in named.items()}
    cols = [(given.get(c) if c in given else F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in HAZARD_ROW.items()]
    block = rows.select(*cols, F.lit(dataset).alias("dataset"))
    rest = [c for c in block.columns if c != "hazard_id"]
    return block.groupBy("hazard_id").agg(F.max(F.struct(*rest)).alias("r")).select("hazard_id", "r.*")


def load_hazards(target: DataFrame, block: DataFrame) -> DataFrame:
    """k07 on the hazard table: the slices (source, hazard type, dataset) of the block are replaced, all others stay."""
    return upsert.slice_replace(target, block, HAZARD_SLICE)


def append_after_high_water(target: DataFrame, batch: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """c30/c31: rows of ``batch`` newer than their key's stored maximum, appended to the target."""
    from ..streaming.incremental import high_water_mark_filter
    return target.unionByName(high_water_mark_filter(batch, target, keys, date_col))


def clean_rates(fx: DataFrame) -> DataFrame:
    """c31 / p19: drop NULL, NaN and non-positive rates."""
    return fx.filter(filters.positive_number("rate"))


def economic_monthly(unemployment: DataFrame, weekly_mortgage: DataFrame) -> DataFrame:
    """c34 (a16 + j09): monthly unemployment joined to the month average of a weekly mortgage series."""
    m = weekly_mortgage.groupBy("metro", F.trunc("week", "month").alias("date")).agg(F.avg("rate").alias("mortgage_rate_30yr"))
    return unemployment.join(m, ["metro", "date"], "left")


def acs_rows(parsed: DataFrame) -> DataFrame:
    """c35: typed demographics with ratio columns (f22) from parsed census rows."""
    pop = numbers.safe_int("population")
    return parsed.select("geo_id", F.col("year").try_cast("int").alias("year"), pop.alias("total_population"),
                         numbers.sentinel_null(numbers.safe_int("income")).alias("median_household_income_usd"),
                         numbers.ratio_pct(numbers.safe_int("owners"), numbers.safe_int("households")).alias("pct_homeowner"))


def upsert_by_key(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """c25/c33/c35/c36: keyed upsert (k04)."""
    return upsert.upsert_all(target, rows, list(keys))
