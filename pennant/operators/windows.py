"""Window operators. Whatever describes an entity before an event leaves out the event itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[str | Column]


def _cols(names: Order) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in names]


def _ordered(keys: Order, order: Order):
    return Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))


def prior(df: DataFrame, keys: Order, order: Order, sums: Mapping[str, str | Column], rows: int | None = None, how: str = "sum") -> DataFrame:
    """Adds, by output name, an aggregate over earlier rows of the key: all of them, or the last `rows`.

    The first row has null. One window serves all columns, so there is one
    shuffle and one sort. Fewer keys widen the horizon (career instead of season).
    """
    first = Window.unboundedPreceding if rows is None else -rows
    w = _ordered(keys, order).rowsBetween(first, -1)
    aggregate = getattr(F, how)
    return df.withColumns({name: aggregate(F.col(x) if isinstance(x, str) else x).over(w) for name, x in sums.items()})


def prior_of_all(df: DataFrame, season: str, day: str, sums: Mapping[str, str]) -> DataFrame:
    """Adds sums over all rows of the season on earlier days.

    A season is one window partition, so rows are first summed by day; the window
    sees a few hundred rows per season, and the days join back.
    """
    days = df.groupBy(season, day).agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    w = Window.partitionBy(season).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(season, day, *[F.sum(f"_{name}").over(w).alias(name) for name in sums])
    return df.join(days, [season, day], "left")


def trailing_days(df: DataFrame, keys: Sequence[str], day: str, sums: Mapping[str, str], days: int) -> DataFrame:
    """One row per key and day with its sums, and for each the sum over the `days` days before, named with `prior_`."""
    daily = df.groupBy(*keys, day).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    w = Window.partitionBy(*keys).orderBy(F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))).rangeBetween(-days, -1)
    return daily.withColumns({f"prior_{name}": F.sum(name).over(w) for name in sums})


def rest_days(df: DataFrame, keys: Order, order: Order, day: str, name: str = "rest_days") -> DataFrame:
    """Days since the key's row before."""
    return df.withColumn(name, F.datediff(F.col(day), F.lag(day).over(_ordered(keys, order))).cast("long"))


def rest_of(df: DataFrame, keys: Order, order: Order, value: str, name: str) -> DataFrame:
    """Sum of value from a row to the key's last one."""
    return df.withColumn(name, F.sum(value).over(_ordered(keys, order).rowsBetween(Window.currentRow, Window.unboundedFollowing)))


def step(df: DataFrame, keys: Order, order: Order, value: str, name: str) -> DataFrame:
    """Change of a cumulative value against the row before; the first row counts from 0."""
    return df.withColumn(name, F.col(value) - F.lag(value, 1, 0).over(_ordered(keys, order)))


def prior_share(df: DataFrame, keys: Order, order: Order, hit: Column, name: str) -> DataFrame:
    """Share of earlier rows for which hit holds; null without any."""
    w = _ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    n = F.count(F.lit(1)).over(w)
    return df.withColumn(name, F.when(n > 0, F.sum(F.when(hit, 1).otherwise(0)).over(w) / n))


def pick_over(df: DataFrame, keys: Order, value: str, when: Column, name: str) -> DataFrame:
    """The largest value among the key's rows for which `when` holds, on all its rows."""
    return df.withColumn(name, F.max(F.when(when, F.col(value))).over(Window.partitionBy(*_cols(keys))))


def first_by(df: DataFrame, keys: Order, order: Order, n: int = 1) -> DataFrame:
    """The first n rows of each key in a total order (distinct on; latest snapshot; top n)."""
    return df.withColumn("_n", F.row_number().over(_ordered(keys, order))).filter(F.col("_n") <= n).drop("_n")


def with_history(df: DataFrame, keys: Order, order: Order) -> DataFrame:
    """Rows that have an earlier row of their key."""
    return df.withColumn("_n", F.row_number().over(_ordered(keys, order))).filter("_n > 1").drop("_n")


def changes(df: DataFrame, keys: Order, order: Order, value: str) -> DataFrame:
    """Rows whose value differs from the key's row before, nulls compared as values; the first one is a change."""
    w = _ordered(keys, order)
    rows = df.withColumns({"_last": F.lag(value).over(w), "_n": F.row_number().over(w)})
    return rows.filter((F.col("_n") == 1) | ~F.col(value).eqNullSafe(F.col("_last"))).drop("_last", "_n")


def open_era(df: DataFrame, last: str, open_end: int = 9999) -> DataFrame:
    """Eras that end in the table's latest year are still open.

    The latest year is one number, computed apart and joined as one row.
    """
    latest = df.agg(F.max(last).alias("_latest"))
    return df.join(F.broadcast(latest)).withColumn(last, F.when(F.col(last) == F.col("_latest"), F.lit(open_end)).otherwise(F.col(last))).drop("_latest")
