"""Join shapes: eras, histories, as-of, first match, guards against ambiguity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def era_join(facts: DataFrame, eras: DataFrame, keys: Sequence[str], at: str, first: str, last: str, how: str = "inner") -> DataFrame:
    """Facts with the era of their key that `at` lies in, both ends included."""
    f, e = facts.alias("f"), eras.alias("e")
    same = [F.col(f"f.{k}") == F.col(f"e.{k}") for k in keys]
    inside = F.col(f"f.{at}").between(F.col(f"e.{first}"), F.col(f"e.{last}"))
    on = inside
    for x in same:
        on = on & x
    rest = [F.col(f"e.{c}") for c in eras.columns if c not in keys]
    return f.join(e, on, how).select("f.*", *rest)


def trailing_seasons(df: DataFrame, key: str, season: str, means: Mapping[str, str], seasons: int = 3) -> DataFrame:
    """Adds means over the key's rows of the `seasons` seasons before.

    A range frame over the season number gives what a self-join on a season
    range would, with one shuffle.
    """
    w = Window.partitionBy(key).orderBy(F.col(season).cast("long")).rangeBetween(-seasons, -1)
    return df.withColumns({name: F.avg(c).over(w) for name, c in means.items()})


def history_sums(targets: DataFrame, history: DataFrame, key: str, at: str, when: str, sums: Mapping[str, str], days: int | None = None) -> DataFrame:
    """For each target the sums of its key's history strictly before it, at most `days` days back.

    Instead of joining each target with all of its history, both are put in one
    ordered sequence per key and day, and a range frame adds up.
    """
    epoch = F.lit("1970-01-01").cast("date")
    past = history.groupBy(key, F.datediff(F.col(when).cast("date"), epoch).alias("_day")).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()], F.count("*").alias("_rows"))
    asked = targets.withColumn("_day", F.datediff(F.col(at).cast("date"), epoch))
    days_asked = asked.select(key, "_day").distinct()
    line = past.unionByName(days_asked, allowMissingColumns=True).groupBy(key, "_day").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums], F.sum("_rows").alias("_rows"))
    w = Window.partitionBy(key).orderBy("_day").rangeBetween(Window.unboundedPreceding if days is None else -days, -1)
    line = line.select(key, "_day", *[F.sum(f"_{n}").over(w).alias(n) for n in sums], F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("n_history"))
    return asked.join(line, [key, "_day"], "left").drop("_day")


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, values: Sequence[str], strict: bool = True, prefix: str = "last_") -> DataFrame:
    """Left rows with the values of the key's latest right row before (or at) them.

    Both sides are one sequence per key in order of time; the latest right row is
    carried forward. Work is linear in the rows, where a join on `<` has a row
    for each pair.
    """
    held = F.struct(F.col(right_at).alias("at"), *[F.col(v) for v in values])
    latest = right.filter(F.col(right_at).isNotNull()).groupBy(*keys, F.col(right_at).alias("_at")).agg(F.max(held).alias("_held"))
    asked = left.select(*keys, F.col(left_at).alias("_at")).distinct()
    line = latest.withColumn("_kind", F.lit(1)).unionByName(asked.withColumn("_kind", F.lit(0 if strict else 2)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = line.withColumn("_held", F.last("_held", ignorenulls=True).over(w)).filter("_kind != 1")
    found = found.select(*keys, F.col("_at").alias(left_at), F.col("_held.at").alias(f"{prefix}{right_at}"), *[F.col(f"_held.{v}").alias(f"{prefix}{v}") for v in values])
    return left.join(found, [*keys, left_at], "left")


def first_match(left: DataFrame, right: DataFrame, on: Column, left_keys: Sequence[str], order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Each left row with one matching right row, the first in order; null where none matches.

    left_keys identify left rows, and order makes the choice total.
    """
    pairs = left.join(right, on, "left")
    w = Window.partitionBy(*[F.col(k) for k in left_keys]).orderBy(*order)
    return pairs.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*left.columns, *values)


def exists(left: DataFrame, right: DataFrame, on, negate: bool = False) -> DataFrame:
    """Left rows with (or, negated, without) a partner."""
    return left.join(right, on, "left_anti" if negate else "left_semi")


def only_unambiguous(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key no other row has; all rows of a doubled key go."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    return df.join(counts, list(keys), "left_semi")


def either_side(df: DataFrame, sides: Mapping[str, str], name: str, keep: Sequence[str]) -> DataFrame:
    """One row per side of each row: `sides` maps a side's label to its column.

    An equi-join on the result replaces a join on a = x OR b = x.
    """
    parts = F.array(*[F.struct(F.lit(label).alias("side"), F.col(c).alias(name)) for label, c in sides.items()])
    return df.select(*keep, F.explode(parts).alias("_s")).select(*keep, "_s.side", f"_s.{name}")


def by_both_names(df: DataFrame, dim: DataFrame, dim_key: str, columns: Mapping[str, str], values: Sequence[str]) -> DataFrame:
    """Left joins to one dimension under several aliases: prefix -> column of df."""
    for prefix, column in columns.items():
        side = dim.select(F.col(dim_key).alias(f"_{prefix}"), *[F.col(v).alias(f"{prefix}_{v}") for v in values])
        df = df.join(side, df[column] == side[f"_{prefix}"], "left").drop(f"_{prefix}")
    return df


def normalised(x: Column) -> Column:
    """Name as a join key: no case, no outer blanks."""
    return F.lower(F.trim(x))


def literal_map(spark, pairs: Mapping[str, str], key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(pairs.items()), f"{key} string, {value} string")


def parity(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys for which two versions of a table differ: only in one of them, or in a value (nulls compared as values)."""
    a = a.select(*keys, F.lit(True).alias("_a"), *[F.col(v).alias(f"a_{v}") for v in values])
    b = b.select(*keys, F.lit(True).alias("_b"), *[F.col(v).alias(f"b_{v}") for v in values])
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))
    status = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(~same, "differs")
    return a.join(b, list(keys), "full_outer").withColumn("status", status).filter("status is not null").drop("_a", "_b")


def prior_season(df: DataFrame, other: DataFrame, key: str, season: str, values: Sequence[str], prefix: str = "prior_") -> DataFrame:
    """Values of the key's season before."""
    past = other.select(key, (F.col(season) + 1).alias(season), *[F.col(v).alias(f"{prefix}{v}") for v in values])
    return df.join(past, [key, season], "left")


def wide(df: DataFrame, keys: Sequence[str], name: str, value: str, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """One column per name of a tall table; rows that lack a required one go."""
    out = df.groupBy(*keys).pivot(name, [*required, *optional]).agg(F.max(value))
    return out.dropna(subset=list(required)) if required else out


