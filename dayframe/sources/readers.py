"""Readers: raw CSV tables, the band seed, marts, city lists."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from dayframe import schemas
from dayframe.operators.order import with_position
from dayframe.session import path_missing
from dayframe.sources.sinks import stored

log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


REJECTED_LINE = "__line"


def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of header CSVs that fit the schema, and the lines that do not.

    A line is rejected if a value does not have its column's type or the number
    of values differs. The files are parsed once, with all columns (a parser
    that skips columns would not see their errors), into a work table that
    both results read: the rows, and (file, line) of the rejects.
    """
    withline = T.StructType([*schema.fields, T.StructField(REJECTED_LINE, T.StringType())])
    parsed = spark.read.schema(withline).option("header", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", REJECTED_LINE).csv(path)
    kept = stored(parsed.withColumn("__file", F.col("_metadata.file_name")), "csv")
    rows = kept.where(F.col(REJECTED_LINE).isNull()).drop(REJECTED_LINE, "__file")
    rejects = kept.where(F.col(REJECTED_LINE).isNotNull()).select(
        F.col("__file").alias("file"), F.col(REJECTED_LINE).alias("line"))
    return rows, rejects


def read_runs(spark: SparkSession, path: str, schema: T.StructType,
              run_type: T.DataType = T.StringType(), folder: str = "extracted_at",
              run_col: str = "run") -> DataFrame:
    """The files of all runs (``<path>/<folder>=<run>/...``) appended, each row with its run and file.

    The run is taken from the file's path, not from its content, so a run
    holds what was landed with it.
    """
    files = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    found = F.regexp_extract(F.col("_metadata.file_path"), rf"/{folder}=([^/]+)/", 1)
    return files.select("*", F.url_decode(found).cast(run_type).alias(run_col),
                        F.col("_metadata.file_name").alias("file"))


def newest_run(rows: DataFrame, keys: list[str], run_col: str = "run") -> DataFrame:
    """Per key the row of the newest run that has it (map-side combined; a key's rows are never
    sorted together). Equal rows of the newest run count once."""
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(run_col, *[c for c in rest if c != run_col])
    return rows.groupBy(*keys).agg(F.max(order).alias("__newest")).select(*keys, "__newest.*")


def read_raw_tables(spark: SparkSession, folder: str,
                    tables: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Load each ``<folder>/<name>.csv``; skip missing ones with a warning,
    fail when none exists."""
    tables = tables or schemas.RAW_TABLES
    out = {}
    for name, schema in tables.items():
        path = f"{folder.rstrip('/')}/{name}.csv"
        try:
            df = read_csv(spark, path, schema)
            df.schema  # resolves the path
            out[name] = df
        except AnalysisException as e:
            if not path_missing(e):
                raise
            log.warning("raw table %s not found at %s, skipped", name, path)
    if not out:
        raise FileNotFoundError(f"no raw tables found under {folder}")
    return out


# --- fixed values (must equal the reference's results) -----------------------
# European AQI health bands: order, label, lower bound (inclusive), upper bound
# (exclusive), note.
AQI_BANDS = [
    (1, "Good", 0.0, 20.0, "Air quality is satisfactory and poses little or no risk"),
    (2, "Fair", 20.0, 40.0, "Air quality is acceptable for most people"),
    (3, "Moderate", 40.0, 60.0, "Sensitive groups may experience minor effects"),
    (4, "Poor", 60.0, 80.0, "Increased likelihood of effects for sensitive groups"),
    (5, "Very Poor", 80.0, 100.0, "Health alert; everyone may begin to experience effects"),
    (6, "Extremely Poor", 100.0, 100000.0, "Serious health effects; avoid outdoor exertion"),
]
# -----------------------------------------------------------------------------


def aqi_bands(spark: SparkSession) -> DataFrame:
    """The 6-row band seed as a DataFrame."""
    return spark.createDataFrame(AQI_BANDS, schemas.AQI_BANDS)


def read_mart(spark: SparkSession, path: str, columns: list[str] | None = None,
              schema: T.StructType | None = None) -> DataFrame:
    """Parquet mart with a column subset (pruned at the scan).

    With ``schema`` given, a missing mart yields an empty typed DataFrame
    instead of an error (optional marts).
    """
    try:
        df = spark.read.parquet(path)
        df.schema
    except AnalysisException as e:
        if schema is None or not path_missing(e):
            raise
        df = spark.createDataFrame([], schema)
    return df.select(*columns) if columns else df


def city_list_with_ids(cities: DataFrame, order_col: str, base: int = 900000,
                       id_col: str = "location_id") -> DataFrame:
    """Synthesise ids ``base + 1-based position`` in the list's natural order.

    The position is computed distributed (sorted ranges + per-partition
    offsets), so it does not pull the list into one task.
    """
    ranked = with_position(cities, [F.col(order_col).asc_nulls_last()], "__pos")
    return ranked.withColumn(id_col, (F.lit(base) + F.col("__pos")).cast("int")).drop("__pos")
