"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is what its target weight asks of the whole
corpus divided by what it has. Each document gets a number in [0, 1) from a
hash of the seed and its id, and that number is inverted through the Poisson
distribution with the source's rate: the number of copies. A rate beyond
MAX_RATE is split into equal parts, each with a number of its own; their counts
add up to a Poisson count of the whole rate. Copies are dealt out
by the hash of id and copy number, and sorted by it, which is a global shuffle.

Everything follows from ids and source counts, so a task run again gives the
same copies. Sources are counted before the shuffle, one row per source and
task. The table of rates has one row per source and is written out; up to
BROADCAST_SOURCES rows it is broadcast, so documents aren't shuffled by source.
A larger one joins by source and a salt, so a source with a third of all rows
is dealt to SALTS tasks.

Null source is a source of its own. Null ids hash as the text "null". Repeated
rows are replicated alike. An empty table gives an empty result. Texts, however
long, are only carried along. Working columns, and _copy, _copies and _order of
the result, get underscores added where docs has a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import fresh, materialize

#: Rates that are broadcast; a row has a source's name, its part count and MAX_COPIES numbers.
BROADCAST_SOURCES = 20_000
SALTS = 64
#: Copies beyond this have a probability under 2**-52 for any rate up to MAX_RATE.
MAX_COPIES = 64
#: The most that one part of a rate has.
MAX_RATE = 12.0
#: Copies that are made from one array.
CHUNK = 1024
SEED = 17


def unit(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, budget: float = 1.0) -> DataFrame:
    """source, n_source, rate.

    weights: target share by source; a source that isn't named gets none. By
    default a source's share goes with its number of documents to `power`.
    budget: size of the result as a multiple of the input.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n_source"))
    if weights is None:
        target = F.pow(F.col("n_source").cast("double"), F.lit(power))
    else:
        table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
        target = F.coalesce(F.element_at(table, F.col("source")).cast("double"), F.lit(0.0))
    counts = counts.withColumn("target", target)
    total = counts.agg(F.sum("n_source").alias("n_all"), F.sum("target").alias("t_all"))
    rate = F.lit(budget) * F.col("target") / F.nullif(F.col("t_all"), F.lit(0.0)) * F.col("n_all") / F.col("n_source")
    return counts.join(F.broadcast(total)).select("source", "n_source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def cdf(rate: Column) -> Column:
    """P(copies <= k) for k = 0 .. MAX_COPIES-1."""
    step = lambda acc, k: F.struct(
        (acc.term * rate / F.greatest(k, F.lit(1)).cast("double")).alias("term"), acc.out.alias("out")
    )
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("out"))

    def add(acc: Column, k: Column) -> Column:
        term = step(acc, k).term
        return F.struct(term.alias("term"), F.concat(acc.out, F.array(F.element_at(acc.out, -1) + term)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MAX_COPIES - 1)), start, add, lambda acc: acc.out)


def replicate(
    docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, budget: float = 1.0,
    seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", partitions: int | None = None,
) -> DataFrame:
    """docs repeated: all columns, and _copy (from 0), _copies, _order in shuffled order."""
    source, n_parts, upto, salt = (fresh(docs, x) for x in ("_source", "_parts", "_cdf", "_salt"))
    chunk, copy, copies, order = (fresh(docs, x) for x in ("_chunk", "_copy", "_copies", "_order"))
    table = rates(docs.select(F.col(source_col).alias("source")), weights, power, budget)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(MAX_RATE)).cast("int"))
    table = materialize(table.select(F.col("source").alias(source), parts.alias(n_parts), cdf(F.col("rate") / parts).alias(upto)), "rates")
    same = F.col(source_col).eqNullSafe(F.col(source))
    if table.count() <= BROADCAST_SOURCES:
        rows = docs.join(F.broadcast(table), same)
    else:
        dealt = docs.withColumn(salt, F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(SALTS)))
        spread = table.withColumn(salt + "_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = dealt.join(spread, same & (F.col(salt) == F.col(salt + "_"))).drop(salt, salt + "_")

    def count(*part: Column) -> Column:
        # The number is drawn once for a row, not once for each entry of the distribution.
        start = F.struct(unit(seed, F.col(id_col), *part).alias("u"), F.lit(0).alias("n"))
        return F.aggregate(upto, start, lambda acc, c: F.struct(acc.u.alias("u"), (acc.n + (c <= acc.u).cast("int")).alias("n")), lambda acc: acc.n)

    more = F.aggregate(F.sequence(F.lit(1), F.col(n_parts) - 1), F.lit(0), lambda n, k: n + count(F.lit("part"), k))
    rows = rows.withColumn(copies, count() + F.when(F.col(n_parts) > 1, more).otherwise(F.lit(0)))
    rows = rows.drop(source, n_parts, upto).filter(F.col(copies) > 0)
    rows = rows.withColumn(chunk, F.explode(F.sequence(F.lit(0), F.col(copies) - 1, F.lit(CHUNK))))
    rows = rows.withColumn(copy, F.explode(F.sequence(F.col(chunk), F.least(F.col(copies), F.col(chunk) + CHUNK) - 1))).drop(chunk)
    rows = rows.withColumn(order, unit(seed + 1, F.col(id_col), F.col(copy)))
    shuffled = rows.repartition(order) if partitions is None else rows.repartition(partitions, order)
    return shuffled.sortWithinPartitions(order, id_col, copy)
