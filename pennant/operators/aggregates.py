"""Aggregations: filtered counts, weights, votes, league totals, park factors, transitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_where(df: DataFrame, keys: Sequence[str | Column], conditions: Mapping[str, Column], **more: Column) -> DataFrame:
    """Per key, how many rows satisfy each condition; further aggregates by name."""
    counts = [F.count_if(c).alias(n) for n, c in conditions.items()]
    return df.groupBy(*keys).agg(*counts, *[a.alias(n) for n, a in more.items()])


def pick_where(value: Column, condition: Column) -> Column:
    """The largest value among rows that satisfy the condition."""
    return F.max(F.when(condition, value))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean by weight over rows that have both; null without weight."""
    w = F.when(value.isNotNull(), weight)
    return F.sum(value * w) / F.nullif(F.sum(w).cast("double"), F.lit(0.0))


def linear_weights(counts: Mapping[str, float], whole: Sequence[str], least: float = 1) -> Column:
    """Weighted sum of count columns per unit of the whole's columns; null under `least`."""
    top = sum((F.col(c) * F.lit(w) for c, w in counts.items()), F.lit(0.0))
    n = sum((F.col(c) for c in whole), F.lit(0))
    return F.when(n >= least, top / n)


def with_league(df: DataFrame, keys: Sequence[str], league: Sequence[str], sums: Sequence[str], prefix: str = "league_") -> DataFrame:
    """Team totals with the totals of their league; the second level adds up the first."""
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    whole = totals.groupBy(*league).agg(*[F.sum(c).alias(f"{prefix}{c}") for c in sums])
    return totals.join(whole, list(league))


def majority(df: DataFrame, entity: Sequence[str], candidate: str) -> DataFrame:
    """Each entity's most frequent candidate, with its votes; the lesser candidate wins a tie."""
    votes = df.filter(F.col(candidate).isNotNull()).groupBy(*entity, candidate).agg(F.count("*").alias("votes"))
    best = votes.groupBy(*entity).agg(F.max("votes").alias("votes"))
    return votes.join(best, [*entity, "votes"]).groupBy(*entity, "votes").agg(F.min(candidate).alias(candidate)).select(*entity, candidate, "votes")


def unambiguous(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with one distinct value, and that value."""
    return df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")).filter("_lo = _hi").select(*keys, F.col("_lo").alias(value))


def park_factor(games: DataFrame, team: str, season: str, home: Column, scored: str, seasons: int = 3) -> DataFrame:
    """Per team and season: 100 * runs per home game / runs per road game, and its mean over the seasons before."""
    rows = games.groupBy(team, season).agg(F.avg(F.when(home, F.col(scored))).alias("home_rate"), F.avg(F.when(~home, F.col(scored))).alias("road_rate"))
    rows = rows.withColumn("ratio", F.lit(100.0) * F.col("home_rate") / F.nullif(F.col("road_rate"), F.lit(0.0)))
    w = Window.partitionBy(team).orderBy(F.col(season).cast("long")).rangeBetween(-seasons, -1)
    return rows.withColumn("park_factor", F.avg("ratio").over(w))


def coverage(df: DataFrame, group: Sequence[str], season: str, covered: Column, bucket: int = 10) -> DataFrame:
    """Rows and covered rows by group and bucket of seasons."""
    decade = (F.floor(F.col(season) / bucket) * bucket).cast("long").alias("decade")
    return df.groupBy(*group, decade).agg(F.count("*").alias("n_rows"), F.count_if(covered).alias("n_covered"))


def classify(df: DataFrame, rules: Sequence[tuple[str, Column]], sample: str, otherwise: str = "other", n: int = 5) -> DataFrame:
    """Count and the n least samples by the first rule that holds.

    Samples are the least of each class by rank, so a class is never collected.
    """
    label = None
    for name, condition in rules:
        label = F.when(condition, F.lit(name)) if label is None else label.when(condition, F.lit(name))
    rows = df.select(F.coalesce(label, F.lit(otherwise)).alias("class"), F.col(sample).alias("_s"))
    counts = rows.groupBy("class").agg(F.count("*").alias("n"))
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy("class").orderBy("_s"))).filter(F.col("_k") <= n)
    samples = ranked.groupBy("class").agg(F.array_sort(F.collect_list("_s")).alias("samples"))
    return counts.join(samples, "class")


def transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str) -> DataFrame:
    """How often each state follows each other one, and the share among what follows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    steps = df.select(F.col(state).alias("pre"), F.lead(state).over(w).alias("post")).filter("post is not null")
    counts = steps.groupBy("pre", "post").agg(F.count("*").alias("n"))
    whole = counts.groupBy("pre").agg(F.sum("n").alias("_all"))
    return counts.join(whole, "pre").select("pre", "post", "n", (F.col("n") / F.col("_all")).alias("p"))


def rest_expectancy(df: DataFrame, half: Sequence[str], order: Sequence[str], value: str, cell: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean of what a half still brings, by cell (run expectancy by outs and bases)."""
    w = Window.partitionBy(*half).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = df.select(*cell, F.sum(value).over(w).alias("_rest"))
    return rows.groupBy(*cell).agg(F.round(F.avg("_rest"), digits).alias("expected"), F.count("*").alias("n"))


def rollup(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Extension: totals by each prefix of the keys."""
    return df.rollup(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
