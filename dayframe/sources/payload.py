"""JSON payloads with column-oriented sections (``time[]`` plus one array per
variable) turned into rows, and geocoding hits turned into location records.

Parsing is ``from_json`` with an explicit schema and ``inline(arrays_zip(...))``
so it runs per row on the executors; a payload is one row of input text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


CORRUPT = "__corrupt"


def section_schema(section: str, variables: dict[str, T.DataType]) -> T.StructType:
    inner = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))]
                         + [T.StructField(v, T.ArrayType(t)) for v, t in variables.items()])
    return T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("error", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField(section, inner),
        T.StructField(CORRUPT, T.StringType()),
    ])


def _typed(variables: Sequence[str] | dict[str, T.DataType]) -> dict[str, T.DataType]:
    return variables if isinstance(variables, dict) else {v: T.DoubleType() for v in variables}


def _parsed(df: DataFrame, json_col: str, section: str,
            variables: dict[str, T.DataType]) -> DataFrame:
    return df.withColumn("__p", F.from_json(F.col(json_col), section_schema(section, variables), {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))


def payload_problem(section: str, variables: Sequence[str]) -> Column:
    """Why a parsed payload (``__p``) is rejected, or NULL: no text, text that is no JSON of the
    expected types, an error answer, or an array that is longer than ``time``. A payload without the
    section (``{}``) is an empty one and no problem."""
    times = F.col(f"__p.{section}.time")
    longer = F.lit(False)
    for v in variables:
        longer = longer | (F.coalesce(F.size(F.col(f"__p.{section}.{v}")), F.lit(0))
                           > F.coalesce(F.size(times), F.lit(0)))
    return (F.when(F.col("__p").isNull(), F.lit("no payload"))
            .when(F.col(f"__p.{CORRUPT}").isNotNull(), F.lit("not readable"))
            .when(F.coalesce(F.col("__p.error"), F.lit(False)), F.concat(
                F.lit("error answer: "), F.coalesce(F.col("__p.reason"), F.lit(""))))
            .when(longer, F.lit("more values than times")))


def payload_rows(df: DataFrame, json_col: str, section: str,
                 variables: Sequence[str] | dict[str, T.DataType],
                 time_alias: str = "date", time_type: str = "date",
                 tags: dict[str, Column] | None = None) -> DataFrame:
    """One output row per position of the section's arrays, of the payloads
    without a problem (see ``payload_rejects`` for the others).

    ``variables`` maps the arrays to their value types, or lists arrays of
    DOUBLEs. ``time`` becomes ``time_alias`` cast to ``time_type``; a variable whose
    array is shorter than ``time`` (or missing) yields NULL at the missing
    positions; an empty payload (``{}``) yields no rows. ``tags`` are extra
    columns (source, location, run time) evaluated on the payload row.
    """
    types = _typed(variables)
    parsed = _parsed(df, json_col, section, types).where(payload_problem(section, list(types)).isNull())
    tags = tags or {}
    zipped = F.arrays_zip(
        F.col(f"__p.{section}.time").alias("__time"),
        *[F.coalesce(F.col(f"__p.{section}.{v}"), F.array().cast(T.ArrayType(t))).alias(v)
          for v, t in types.items()])
    rows = parsed.select(*[c.alias(n) for n, c in tags.items()],
                         F.col("__p.latitude").alias("__lat"),
                         F.col("__p.longitude").alias("__lon"),
                         F.col("__p.timezone").alias("__tz"),
                         F.inline(F.when(F.col(f"__p.{section}.time").isNotNull(), zipped)))
    return rows.select(
        *tags.keys(),
        F.col("__time").cast(time_type).alias(time_alias),
        F.col("__lat").alias("latitude"), F.col("__lon").alias("longitude"),
        F.col("__tz").alias("timezone"),
        *types,
    )


def payload_rejects(df: DataFrame, json_col: str, section: str,
                    variables: Sequence[str] | dict[str, T.DataType],
                    tags: dict[str, Column] | None = None) -> DataFrame:
    """The payloads that ``payload_rows`` leaves out: tags, payload text and reason."""
    types = _typed(variables)
    parsed = _parsed(df, json_col, section, types)
    found = parsed.withColumn("reason", payload_problem(section, list(types))).where(
        F.col("reason").isNotNull())
    return found.select(*[c.alias(n) for n, c in (tags or {}).items()],
                        F.col(json_col).alias("payload"), "reason")


GEOCODE_HIT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("country_code", T.StringType()),
    T.StructField("admin1", T.StringType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("timezone", T.StringType()),
    T.StructField("elevation", T.DoubleType()), T.StructField("population", T.LongType()),
])
GEOCODE = T.StructType([T.StructField("results", T.ArrayType(GEOCODE_HIT))])


def geocode_locations(df: DataFrame, json_col: str, query_col: str,
                      run_col: str = "extracted_at") -> tuple[DataFrame, DataFrame]:
    """First geocoding hit per query -> location record; queries without a hit,
    or whose answer is no JSON, go to the second (reject) DataFrame with an
    error message."""
    schema = T.StructType([*GEOCODE.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = df.withColumn("__a", F.from_json(F.col(json_col), schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})).withColumn(
        "__hit", F.when(F.col(f"__a.{CORRUPT}").isNull(), F.try_element_at("__a.results", F.lit(1))))
    ok = parsed.filter(F.col("__hit").isNotNull()).select(
        F.col("__hit.id").cast("int").alias("location_id"),
        F.col("__hit.name").alias("city_name"),
        F.col("__hit.country").alias("country"),
        F.col("__hit.country_code").alias("country_code"),
        F.col("__hit.admin1").alias("admin1"),
        F.col("__hit.latitude").alias("latitude"),
        F.col("__hit.longitude").alias("longitude"),
        F.col("__hit.timezone").alias("timezone"),
        F.col("__hit.elevation").alias("elevation"),
        F.col("__hit.population").cast("int").alias("population"),
        F.col(run_col).alias("extracted_at"),
    )
    problem = F.when(F.col(f"__a.{CORRUPT}").isNotNull(), F.lit("unreadable geocoding answer for ")) \
        .otherwise(F.lit("no geocoding result for "))
    rejects = parsed.filter(F.col("__hit").isNull()).select(
        F.col(query_col).alias("query"), F.concat(problem, F.col(query_col)).alias("error"))
    return ok, rejects
