"""Running totals over an order that is too long for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame, group: list[str], chunk: list[str], order: list[str], values: dict[str, Column]
) -> DataFrame:
    """Add, per name in ``values``, the bigint sum over all earlier rows of the row's group.

    Rows of a group are ordered by ``(*chunk, *order)``. The sum has two levels: a window inside
    each chunk, and a window over the chunk totals, one row per chunk. So the largest window holds
    one chunk of a group, even where one group has a third of all rows; callers keep chunks small
    (a file split, or a range partition of bounded size).
    """
    keys = group + chunk
    df = df.select("*", *(v.cast("bigint").alias(f"_v_{n}") for n, v in values.items()))
    totals = df.groupBy(*keys).agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values))
    before = Window.partitionBy(*group).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in values)
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.select(
        *(c for c in df.columns if not c.startswith("_v_")),
        *(F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)).alias(f"_l_{n}") for n in values),
    )
    kept = [c for c in local.columns if not c.startswith("_l_")]
    return local.join(starts, keys).select(
        *kept, *((F.col(f"_s_{n}") + F.col(f"_l_{n}")).alias(n) for n in values)
    )
