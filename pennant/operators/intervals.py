"""Covered time as intervals: their union, what is missing of a wanted range, and windows of bounded length.

Intervals are half open, [start, end). Unions are made in two steps, first of the
intervals of one key that begin in one bucket of time, then of what is left by
key, so a key with very many intervals is shrunk before it meets in one task.
Intervals that are empty, turned round or without an end cover nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000


def _islands(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df: keys, _s, _e. Touching and overlapping intervals of one key as one."""
    before = Window.partitionBy(*keys).orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.coalesce(F.col("_s") > F.max("_e").over(before), F.lit(True)).cast("int")
    return df.withColumn("_n", begins).withColumn("_n", F.sum("_n").over(upto)).groupBy(*keys, "_n").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).drop("_n")


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _united(df: DataFrame, keys: Sequence[str], bucket: int) -> DataFrame:
    near = _islands(df.filter("_s < _e").withColumn("_b", F.floor(F.col("_s") / bucket)), [*keys, "_b"])
    return _islands(near.drop("_b"), keys)


def union(df: DataFrame, keys: Sequence[str], start: str, end: str, bucket: int = DAY) -> DataFrame:
    """keys, start, end: the least intervals that cover the same time."""
    rows = _united(df.select(*keys, _micros(start).alias("_s"), _micros(end).alias("_e")), keys, bucket)
    return rows.select(*keys, F.timestamp_micros("_s").alias(start), F.timestamp_micros("_e").alias(end))


def missing(wanted: DataFrame, covered: DataFrame, keys: Sequence[str], start: str, end: str, longest: int | None = None, bucket: int = DAY) -> DataFrame:
    """Time of `wanted` (keys, start, end) that `covered` (the same columns) doesn't cover, in windows of at most `longest` microseconds.

    Windows of one gap follow each other from its begin; only the last is shorter.
    Rows of wanted that overlap for a key count as one. Null keys are a key.
    """
    asked = _united(wanted.select(*keys, _micros(start).alias("_s"), _micros(end).alias("_e")), keys, bucket).select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.col("_s").alias("_from"), F.col("_e").alias("_to"))
    have = _united(covered.select(*keys, _micros(start).alias("_s"), _micros(end).alias("_e")), keys, bucket)
    same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    inside = have.join(asked, [*same, F.col("_s") < F.col("_to"), F.col("_e") > F.col("_from")]).select(*[f"_{i}" for i in range(len(keys))], "_from", "_to", F.greatest("_s", "_from").alias("_s"), F.least("_e", "_to").alias("_e"))
    # A wanted range's own ends, as empty intervals, bound the gaps before the first and after the last island.
    ends = asked.select("*", F.explode(F.array("_from", "_to")).alias("_s")).withColumn("_e", F.col("_s"))
    group = [*[f"_{i}" for i in range(len(keys))], "_from", "_to"]
    before = Window.partitionBy(*group).orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1)
    gaps = inside.unionByName(ends).withColumn("_open", F.max("_e").over(before)).filter("_open < _s").select(*group, F.col("_open").alias("_a"), F.col("_s").alias("_z"))
    if longest is not None:
        steps = F.explode(F.sequence(F.lit(0), F.ceil((F.col("_z") - F.col("_a")) / longest).cast("long") - 1)).alias("_k")
        gaps = gaps.select(*group, "_a", "_z", steps).select(*group, (F.col("_a") + F.col("_k") * longest).alias("_a"), F.least(F.col("_a") + (F.col("_k") + 1) * longest, F.col("_z")).alias("_z"))
    return gaps.select(*[F.col(f"_{i}").alias(k) for i, k in enumerate(keys)], F.timestamp_micros("_a").alias(start), F.timestamp_micros("_z").alias(end))
