"""Exact quantiles without a sort: ranges that hold the wanted ranks are narrowed by counts until one value is left.

A round is one pass with a map-side sum of at most BUCKETS counts for each rank,
so no state grows with the number of rows or of distinct values. Every round
leaves of a range what lies between the least and the greatest value of one of
its buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def select(df: DataFrame, column: str, ranks: Sequence[int]) -> list[float]:
    """Values at the given ranks (from 0) of the column's values in order, nulls and NaN left out."""
    rows = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    ends = [F.lit(-math.inf), F.lit(math.inf)]
    below, above, n = rows.agg(*[F.count(F.when(F.col("x") == e, 1)) for e in ends], F.count("*")).first()
    rows = rows.filter((F.col("x") > ends[0]) & (F.col("x") < ends[1]))
    least, most = rows.agg(F.min("x"), F.max("x")).first()
    # Of each rank: the range its value lies in, and its rank inside of it.
    at = {r: (-math.inf, -math.inf, 0) if r < below else (math.inf, math.inf, 0) if r >= n - above else (least, most, r - below) for r in ranks}
    while any(lo < hi for lo, hi, _ in at.values()):
        live = sorted({(lo, hi) for lo, hi, _ in at.values() if lo < hi})
        ranges = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for k, (lo, hi) in enumerate(live)])
        held = F.filter(ranges, lambda r: (F.col("x") >= r["lo"]) & (F.col("x") <= r["hi"]))
        # Halves keep the width of a range finite where its ends are of opposite sign and very large.
        share = (F.col("x") / 2 - F.col("r.lo") / 2) / (F.col("r.hi") / 2 - F.col("r.lo") / 2)
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).alias("b")
        counts: dict[int, list] = {}
        for r in rows.select("x", F.explode(held).alias("r")).groupBy("r.k", bucket).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("k", "b").collect():
            counts.setdefault(r["k"], []).append(r)
        for rank, (lo, hi, rest) in at.items():
            if lo < hi:
                for b in counts[live.index((lo, hi))]:
                    if rest < b["n"]:
                        at[rank] = (b["lo"], b["hi"], rest)
                        break
                    rest -= b["n"]
    return [at[r][0] for r in ranks]


def quantiles(df: DataFrame, column: str, continuous: Sequence[float] = (), nearest: Sequence[float] = ()) -> tuple[list[float | None], list[float | None]]:
    """Interpolated quantiles at the shares `continuous`, and values of nearest rank at the shares `nearest`; None without values."""
    n = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL AND NOT isnan(x)").count()
    if not n:
        return [None] * len(continuous), [None] * len(nearest)
    places = [q * (n - 1) for q in continuous]
    disc = [max(0, math.ceil(round(q * n, 9)) - 1) for q in nearest]
    ranks = sorted({*disc, *(math.floor(p) for p in places), *(math.ceil(p) for p in places)})
    value = dict(zip(ranks, select(df, column, ranks), strict=True))
    between = [value[math.floor(p)] + (value[math.ceil(p)] - value[math.floor(p)]) * (p - math.floor(p)) for p in places]
    return between, [value[r] for r in disc]
