"""Delimited files: delimiter / encoding sniffing, header resolution, file routing,
long and wide layouts (s03-s06, s17-s19, s24)."""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, labels, numbers, text
from ..session import scratch_path

# Fixed values --------------------------------------------------------------------
SEPARATORS = [";", ",", "|", "\t"]
ENCODINGS = ["utf-8", "iso-8859-1"]
# ---------------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
             encoding: str = "utf-8") -> DataFrame:
    """s03: header CSV; declared schema when given, PERMISSIVE mode (bad values -> NULL)."""
    r = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE")
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", False).csv(path)


def sniff_files(lines: DataFrame, min_columns: int = 2) -> DataFrame:
    """s04: (file, header, first, is_utf8, sep) of every file, decided by all of its lines; ``first`` is the header's place in block 0.

    ``lines`` has the raw lines as ``value`` with ``file``, ``block`` (where the part of the file begins that a task reads) and ``row``. A file
    with any line that is not valid UTF-8 is ISO-8859-1. Its separator is the first of SEPARATORS that cuts its header into
    ``min_columns`` parts or more, else a comma. Only a number and a flag a file are aggregated, so no line is sorted or kept."""
    per = lines.groupBy("file").agg(F.min(F.when(F.col("block") == 0, F.col("row"))).alias("first"), F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"))
    heads = lines.join(F.broadcast(per), "file").where((F.col("block") == 0) & (F.col("row") == F.col("first")))      # one row a file
    per = heads.select("file", "first", "is_utf8", decoded("value", "is_utf8").alias("header"))
    sep = F.lit(None).cast("string")
    for s in reversed(SEPARATORS):
        sep = F.when(F.size(F.split("header", f"\\Q{s}\\E", -1)) >= min_columns, s).otherwise(sep)
    return per.withColumn("sep", F.coalesce(sep, F.lit(",")))


def decoded(line_col: str, is_utf8: str):
    """The text of a raw line in its file's encoding."""
    return F.when(F.col(is_utf8), F.col(line_col)).otherwise(F.decode(F.col(line_col).cast("binary"), ENCODINGS[1]))


def _cells(line: str, sep: str, width: int):
    """The fields of a line as an array of ``width`` strings, cut by its file's separator."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    out = F.lit(None).cast("array<string>")
    for s in SEPARATORS:
        r = F.from_csv(line, schema, {"sep": s})
        out = F.when(F.col(sep) == s, F.array(*[r[f"c{i}"] for i in range(width)])).otherwise(out)
    return out


def read_sniffed(spark: SparkSession, path: str, min_columns: int = 2) -> DataFrame:
    """s04: every file of ``path`` with its own encoding, separator and header, as strings; one record a line.

    Columns are the union of all headers. Whatever the number of layouts, the lines are parsed in one scan: a line is cut into
    an array by its file's separator, and a column is the field at its name's place in the file's header (the first one of a name). Only the
    names of the columns and the greatest number of fields reach the driver. What was found of the files, one row a file as in the scan's own
    listing, is written once and sent to the lines, which stay where they are read. The header is dropped by its place: data equal to it stays."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    found = scratch_path(spark, f"sniffed_{uuid.uuid4().hex}")
    sniff_files(lines, min_columns).write.parquet(found)
    files = spark.read.parquet(found)
    cut = F.split("header", F.concat(F.lit("\\Q"), "sep", F.lit("\\E")), -1)
    width = files.agg(F.max(F.size(cut))).first()[0]
    if width is None:
        return spark.createDataFrame([], "_c0 string")
    names = F.transform(_cells("header", "sep", width), lambda n, i: F.when(i < F.size(cut), F.coalesce(F.nullif(F.trim(n), F.lit("")), F.concat(F.lit("_c"), i.cast("string")))))
    files = files.withColumn("names", F.filter(names, lambda n: n.isNotNull()))
    columns = [r["n"] for r in files.select(F.explode("names").alias("n")).distinct().orderBy("n").collect()]
    rows = lines.join(F.broadcast(files), "file").where((F.col("block") > 0) | (F.col("row") > F.col("first"))).withColumn("line", decoded("value", "is_utf8")).where("line <> ''")
    rows = rows.withColumn("cells", _cells("line", "sep", width))
    return rows.select(*[F.get("cells", F.array_position("names", F.lit(c)).cast("int") - 1).alias(c) for c in columns])


def normalize_header(name: str) -> str:
    """f04 on a column name (driver-side metadata): accent-free, lower, alnum only."""
    s = unicodedata.normalize("NFKD", name.strip().lower())
    s = "".join(ch for ch in s if not unicodedata.combining(ch))
    return "".join(ch for ch in s if ch.isalnum())


def resolve_columns(df: DataFrame, candidates: dict[str, Sequence[str]], substring: bool = True) -> DataFrame:
    """s05: map logical fields to real columns by normalised header: exact candidate
    first, then (optionally) substring match; missing fields become NULL strings."""
    norm = {normalize_header(c): c for c in df.columns}
    cols = []
    for logical, cands in candidates.items():
        found = None
        for cand in cands:
            n = normalize_header(cand)
            if n in norm:
                found = norm[n]
                break
        if found is None and substring:
            for cand in cands:
                n = normalize_header(cand)
                hit = next((orig for k, orig in norm.items() if n and n in k), None)
                if hit:
                    found = hit
                    break
        cols.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(logical))
    return df.select(*cols)


def with_file_routing(df: DataFrame, routes: dict[str, str]) -> DataFrame:
    """s06: file name, route (by name prefix), first 20dd in the name as the year; files without a route are left out.

    A file written in many parts is a folder: its parts go by the folder's name."""
    path = F.split(F.col("_metadata.file_path"), "/")
    leaf = F.element_at(path, -1)
    name = F.when(leaf.startswith("part-") & (F.size(path) > 1), F.element_at(path, -2)).otherwise(leaf)
    route = None
    for prefix, label in routes.items():
        cond = F.lower(name).startswith(prefix)
        route = F.when(cond, label) if route is None else route.when(cond, label)
    year = F.regexp_extract(name, r"(20\d\d)", 1)
    return df.select("*", name.alias("file_name"), route.alias("route"),
                     F.nullif(year, F.lit("")).try_cast("int").alias("file_year")).where(F.col("route").isNotNull())


def long_crime_rows(df: DataFrame, file_year_col: str = "file_year", slug_col: str | None = None) -> DataFrame:
    """s19: long layout -> typed rows: count parsed (f07), month (f13), year from the row
    when 1900 < y < 2100 else the file year, crime type falling back to a file-name slug."""
    y = F.col("year").try_cast("int")
    ctype = F.coalesce(text.safe_str("crime_type"), F.col(slug_col) if slug_col else F.lit(None).cast("string"))
    return df.select(
        text.safe_str("city").alias("city"),
        ctype.alias("crime_type"),
        labels.crime_category_spanish(ctype).alias("crime_category"),
        numbers.parse_count("count").try_cast("int").alias("count"),
        labels.month_number(F.col("month")).alias("period_month"),
        F.when((y > 1900) & (y < 2100), y).otherwise(F.col(file_year_col)).alias("period_year"),
    ).filter(F.col("count").isNotNull() & (F.col("count") > 0))


def market_long_rows(df: DataFrame) -> DataFrame:
    """s24: long market rows with NULL-safe casts; blank / 00000 zips and bad dates dropped."""
    z = numbers.zip_pad(F.col("zip"))
    d = F.coalesce(F.try_to_date(F.col("period_end"), "yyyy-MM-dd"), F.try_to_date(F.col("period_end"), "MM/dd/yyyy"))
    out = df.select(z.alias("zip"), d.alias("date"), text.safe_str("city").alias("city"),
                    numbers.safe_int("homes_sold").alias("homes_sold"), numbers.safe_int("inventory").alias("inventory_count"),
                    numbers.safe_float("median_sale_price").try_cast("long").alias("median_sale_price_usd"),
                    numbers.safe_int("median_dom").alias("median_days_on_market"))
    out = out.withColumn("months_of_supply", numbers.months_of_supply("inventory_count", "homes_sold"))
    return out.filter(F.col("zip").isNotNull() & (F.trim("zip") != "") & (F.col("zip") != "00000") & F.col("date").isNotNull())
