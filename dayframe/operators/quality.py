"""Data-quality checks. A function per check returns the violating rows (0 rows
= pass); ``run_suite`` evaluates a list of ``Check``s over several tables in one
pass over each of them and returns one summary table.

Row checks are filters; ``unique`` is a partial-then-final aggregate;
``relationships`` is a left-anti join against the parent's distinct keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values (not NULL) that occur more than once, with their count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def is_missing(col: str) -> Column:
    return F.col(col).isNull()


def is_outside(col: str, values: Sequence) -> Column:
    """A value that is not in the list (NULL passes)."""
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def is_beyond(col: str, lo=None, hi=None) -> Column:
    """A value outside [lo, hi] (inclusive; NULL passes)."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    return c.isNotNull() & bad


def is_any_negative(cols: Sequence[str]) -> Column:
    return F.coalesce(reduce(Column.__or__, [F.col(c) < F.lit(0) for c in cols]), F.lit(False))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(is_missing(col))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent."""
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the list (NULL passes)."""
    return df.filter(is_outside(col, values))


def between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows outside [lo, hi] (inclusive; NULL passes)."""
    return df.filter(is_beyond(col, lo, hi))


def non_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < F.lit(0))


def any_negative(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows where any of ``cols`` is negative (singular check, OR of ranges)."""
    return df.filter(is_any_negative(cols)).select(*keep, *cols)


def out_of_range(df: DataFrame, lo_col: str, hi_col: str, lo: float, hi: float,
                 keep: Sequence[str]) -> DataFrame:
    """Rows with min < lo, max > hi, or min > max."""
    cond = (F.col(lo_col) < F.lit(lo)) | (F.col(hi_col) > F.lit(hi)) | (F.col(lo_col) > F.col(hi_col))
    return df.filter(cond).select(*keep)


def contract_violations(df: DataFrame, contract: T.StructType) -> list[str]:
    """Differences between a DataFrame's columns/types and a contract."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    problems = [f"missing column {n} ({t.simpleString()})" for n, t in want.items() if n not in have]
    problems += [f"unexpected column {n}" for n in have if n not in want]
    problems += [f"column {n}: {have[n].simpleString()} != {t.simpleString()}"
                 for n, t in want.items() if n in have and have[n] != t]
    return problems


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    problems = contract_violations(df, contract)
    if problems:
        raise ValueError("contract violated: " + "; ".join(problems))
    return df.select(*[f.name for f in contract.fields])


def freshness(df: DataFrame, ts_col: str, as_of: dt.datetime,
              warn_after: dt.timedelta = dt.timedelta(hours=36),
              error_after: dt.timedelta = dt.timedelta(days=7)) -> DataFrame:
    """One row: newest timestamp, its age in hours, and pass / warn / error."""
    latest = F.max(F.col(ts_col))
    age_s = F.lit(as_of).cast("timestamp").cast("double") - latest.cast("timestamp").cast("double")
    status = (F.when(latest.isNull(), F.lit("error"))
              .when(age_s > F.lit(error_after.total_seconds()), F.lit("error"))
              .when(age_s > F.lit(warn_after.total_seconds()), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return df.agg(latest.alias("max_loaded_at"),
                  (age_s / F.lit(3600.0)).alias("age_hours"),
                  status.alias("status"))


@dataclass(frozen=True)
class RowRule:
    """A rule about single rows: ``violated`` is true for a failing row."""
    violated: Column


@dataclass(frozen=True)
class Unique:
    """No value of the column (NULL apart) occurs twice; each that does is one failure."""
    column: str


@dataclass(frozen=True)
class Relationship:
    """Every value of the column (NULL apart) occurs in a column of the parent table; each row
    whose value does not is one failure."""
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    rule: RowRule | Unique | Relationship
    severity: str = "error"


def _entries(name: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    """What one scan of a table has to say to the checks: (check, key, side) rows. Row rules send one
    without a key for each failing row, the others one for each key."""
    def entry(i: int, key: Column, parent: bool) -> Column:
        return F.struct(F.lit(i).alias("check"), key.cast("string").alias("key"),
                        F.lit(parent).alias("parent"))

    out = []
    for i, c in enumerate(checks):
        if c.table == name:
            if isinstance(c.rule, RowRule):
                out.append(F.when(c.rule.violated, entry(i, F.lit(None), False)))
            else:
                key = F.col(c.rule.column)
                out.append(F.when(key.isNotNull(), entry(i, key, False)))
        if isinstance(c.rule, Relationship) and c.rule.parent == name:
            key = F.col(c.rule.parent_column)
            out.append(F.when(key.isNotNull(), entry(i, key, True)))
    return df.select(F.inline(F.array_compact(F.array(*out)))) if out else None


def run_suite(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: check_name, failures, status (pass, fail, or warn).

    Every table is scanned once, whatever the number of its checks; the tables'
    entries meet in one grouped aggregate (map-side combined, so a hot key or
    a rule that every row breaks costs one row a task), which a second, small
    one sums up. Keys are compared as text.
    """
    unknown = {c.table for c in checks} | {c.rule.parent for c in checks
                                           if isinstance(c.rule, Relationship)}
    if not unknown <= set(tables):
        raise ValueError(f"no such tables: {sorted(unknown - set(tables))}")
    sent = [e for e in (_entries(n, df, checks) for n, df in tables.items()) if e is not None]
    every = reduce(DataFrame.unionByName, sent)
    keys = every.groupBy("check", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.bool_or("parent").alias("known"))

    def of(kind: type) -> Column:
        return F.col("check").isin([i for i, c in enumerate(checks) if isinstance(c.rule, kind)])

    failures = F.when(of(RowRule), F.col("rows")).when(
        of(Unique), (F.col("rows") > 1).cast("long")).when(
        ~F.col("known"), F.col("rows")).otherwise(F.lit(0))
    counted = keys.groupBy("check").agg(F.sum(failures).alias("found"))
    names = df_of_checks(every.sparkSession, checks)
    n = F.coalesce("found", F.lit(0))
    return names.join(counted, "check", "left").select(
        "check_name", n.alias("failures"), F.when(n == 0, F.lit("pass")).when(
            F.col("severity") == "error", F.lit("fail")).otherwise(F.lit("warn")).alias("status"))


def df_of_checks(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """(check, check_name, severity), one row a check."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("check"), F.lit(c.name).alias("check_name"),
        F.lit(c.severity).alias("severity")) for i, c in enumerate(checks)])))
