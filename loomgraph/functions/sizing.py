"""Broadcasts only behind a check of the side's size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side is broadcast only when the optimiser proves it to be below this many bytes.
BROADCAST_LIMIT = 8 << 20


def plan_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimiser's statistics bound it; needs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast when ``plan_bytes`` is within ``limit``; otherwise the planner and AQE decide."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def collect_bounded(df: DataFrame, limit: int) -> list:
    """Rows of a table with a stated bound; raises rather than collecting more than ``limit`` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; this table was stated to be bounded")
    return rows


#: Repeated keys up to which they are broadcast.
FEW_KEYS = 100_000


def one_row_each(df: DataFrame, key: str, among: DataFrame | None = None) -> DataFrame:
    """One row a key, the largest of a repeated key's rows column by column from the left; null keys go.

    The keys alone are counted first, in ``among`` where that holds all of them and is cheaper to read: rows
    of unique keys are never shuffled where few keys repeat.
    """
    df = df.filter(F.col(key).isNotNull())
    many = (df if among is None else among.filter(F.col(key).isNotNull())).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)
    rest = [c for c in df.columns if c != key]
    largest = lambda rows: rows.groupBy(key).agg(F.max(F.struct(*rest)).alias("_s")).select(*[F.col(f"_s.{c}").alias(c) if c != key else F.col(c) for c in df.columns])
    keys = [r[0] for r in many.limit(FEW_KEYS + 1).collect()]
    if not keys:
        return df
    if len(keys) > FEW_KEYS:
        return largest(df)
    few = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in keys], many.schema))  # at most FEW_KEYS rows
    return df.join(few, key, "left_anti").select(*df.columns).unionByName(largest(df.join(few, key, "left_semi")))
