"""Range join of a value to bands ``lo <= x < hi`` (left join: no band -> NULL)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bands are broadcast (nested-loop join, one pass over the values) only when a
# bounded count proves the band table is at most this long.
MAX_BROADCAST_BANDS = 100


def range_join(df: DataFrame, value: str, bands: DataFrame, lo: str = "aqi_min",
               hi: str = "aqi_max", bucket_width: float | None = None,
               max_broadcast: int = MAX_BROADCAST_BANDS) -> DataFrame:
    """Left join each row to the bands containing ``value``; both forms give the same rows.

    Small band tables: broadcast nested-loop left outer join (build side =
    bands), no shuffle of the value side.
    Large band tables: equi-join on ``floor(x / width)`` with every band
    exploded over the buckets it covers, plus the exact range as a residual
    condition; both sides shuffle by bucket, so no side has to fit in memory.
    Without ``bucket_width`` the width is the bands' mean width, so that all
    bands together cover at most about two buckets per band. Buckets end at
    the outermost finite bounds; what lies beyond shares the last ones.
    """
    n = bands.limit(max_broadcast + 1).count()
    if n <= max_broadcast:
        b = F.broadcast(bands)
        cond = (df[value] >= b[lo]) & (df[value] < b[hi])
        return df.join(b, cond, "left")
    real = bands.filter(F.col(lo) < F.col(hi)).withColumns(
        {"__lo": F.col(lo).cast("double"), "__hi": F.col(hi).cast("double")})
    finite = [F.when((F.abs(F.col(c)) < float("inf")), F.col(c)) for c in ("__lo", "__hi")]
    t = real.agg(F.avg(finite[1] - finite[0]).alias("width"),
                 F.min(F.least(*finite)).alias("least"),
                 F.max(F.greatest(*finite)).alias("most")).first()  # one row
    w = float(bucket_width or t["width"] or 1.0)
    ends = [float(math.floor((t["least"] or 0.0) / w)) - 1, float(math.floor((t["most"] or 0.0) / w)) + 1]

    def bucket(x):
        # rint stays a double, where floor would overflow; any monotone function serves
        return F.least(F.greatest(F.rint(x / w), F.lit(ends[0])), F.lit(ends[1])).cast("long")

    exploded = real.withColumn("__bucket", F.explode(F.sequence(
        bucket(F.col("__lo")), bucket(F.col("__hi"))))).drop("__lo", "__hi")
    keyed = df.withColumn("__bucket", bucket(F.col(value).cast("double")))
    cond = ((keyed["__bucket"] == exploded["__bucket"])
            & (keyed[value] >= exploded[lo]) & (keyed[value] < exploded[hi]))
    return keyed.join(exploded, cond, "left").drop("__bucket")
