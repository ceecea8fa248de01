"""Join helpers: null-safe key joins and the bound of forced broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast by force only when a bounded count proves that it has at
# most this many rows. Other joins have no hint: the planner broadcasts what its
# file sizes, or the sizes measured at run time, show to be small.
DEFAULT_BROADCAST_ROWS = 200_000


def join_back(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Attach per-key statistics to detail rows, NULL keys matching NULL keys.

    The statistics side is an aggregate whose size is only known at run time,
    so no broadcast is forced: AQE converts the sort-merge join to a broadcast
    when the aggregate is small and splits skewed partitions when it is not.
    """
    renamed = small.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                           *[c for c in small.columns if c not in keys])
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(renamed[f"__k_{k}"])
        cond = c if cond is None else cond & c
    out = big.join(renamed, cond, how)
    return out.drop(*[f"__k_{k}" for k in keys])
