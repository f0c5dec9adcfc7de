"""Set operations, total orders and limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all rows by name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def in_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows that are in every frame."""
    return reduce(lambda a, b: a.intersect(b), frames)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with their multiplicity, that are in one frame only; empty for equal frames."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def closure(frames: Mapping[str, tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct non-null ids that any of the columns refers to."""
    return reduce(lambda a, b: a.union(b), [df.select(F.col(c).alias(name)) for df, c in frames.values()]).filter(F.col(name).isNotNull()).distinct()


def summaries(frames: Mapping[str, DataFrame], season: str | None = None, key: Mapping[str, str] | None = None) -> DataFrame:
    """One row per table: name, rows, distinct keys, latest season."""
    parts = []
    for name, df in frames.items():
        k = (key or {}).get(name)
        distinct = F.countDistinct(k) if k else F.lit(None).cast("long")
        latest = F.max(season).cast("long") if season in df.columns else F.max(F.lit(None).cast("long"))
        parts.append(df.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"), distinct.alias("n_keys"), latest.alias("latest")))
    return stacked(parts)


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of a total order; each task keeps n."""
    return df.orderBy(*order).limit(n)


def next_batch(df: DataFrame, missing: str, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows that lack a key."""
    return top(df.filter(F.col(missing).isNull()), [F.col(c).asc_nulls_last() for c in order], n)


def total_order(columns: Sequence[str], descending: Sequence[str] = ()) -> list[Column]:
    """Sort columns with nulls last either way."""
    return [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in columns]
