"""Data-quality checks. Each returns a frame with one finding per row: name, status, detail."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, MapType, NumericType, StructType, TimestampNTZType, TimestampType


def finding(df: DataFrame, name: str, failed: Column, detail: Column, warn: bool = False) -> DataFrame:
    status = F.when(failed, F.lit("WARN" if warn else "FAIL")).otherwise(F.lit("PASS"))
    return df.select(F.lit(name).alias("name"), status.alias("status"), detail.cast("string").alias("detail"))


def has_rows(df: DataFrame, name: str) -> DataFrame:
    return finding(df.agg(F.count("*").alias("n")), name, F.col("n") == 0, F.col("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("n"))
    return finding(twice, name, F.col("n") > 0, F.col("n"))


def not_null(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One finding per column from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    tall = counts.unpivot([], list(columns), "column", "n")
    return tall.select(F.concat(F.lit(f"{name}."), "column").alias("name"), F.when(F.col("n") > 0, "FAIL").otherwise("PASS").alias("status"), F.col("n").cast("string").alias("detail"))


def in_range(df: DataFrame, limits: Mapping[str, tuple[float, float]], name: str) -> DataFrame:
    """How many values lie outside of each column's limits."""
    counts = df.agg(*[F.count_if(~F.col(c).between(lo, hi)).alias(c) for c, (lo, hi) in limits.items()])
    tall = counts.unpivot([], list(limits), "column", "n")
    return tall.select(F.concat(F.lit(f"{name}."), "column").alias("name"), F.when(F.col("n") > 0, "FAIL").otherwise("PASS").alias("status"), F.col("n").cast("string").alias("detail"))


def references(child: DataFrame, parent: DataFrame, column: str, key: str) -> DataFrame:
    """rows, nulls and orphans of a foreign key."""
    keys = parent.select(F.col(key).alias("_k")).filter("_k is not null").distinct()
    found = child.join(keys, child[column] == F.col("_k"), "left")
    return found.agg(F.count("*").alias("n_rows"), F.count_if(F.col(column).isNull()).alias("n_null"), F.count_if(F.col(column).isNotNull() & F.col("_k").isNull()).alias("n_orphan"))


def join_coverage(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str, tolerance: float = 0.0) -> DataFrame:
    """Rows that join: more than there are on the left fails, and fewer beyond the tolerance."""
    n_left = left.agg(F.count("*").alias("n"))
    n_both = left.join(right, list(keys)).agg(F.count("*").alias("m"))
    both = n_left.join(F.broadcast(n_both))
    return finding(both, name, (F.col("m") > F.col("n")) | (F.col("m") < F.col("n") * (1 - tolerance)), F.concat_ws("/", "m", "n"))


def share_by(expected: DataFrame, actual: DataFrame, keys: Sequence[str], key: str, least: float = 0.5) -> DataFrame:
    """Per group: expected and actual distinct keys, their ratio, and whether it is enough."""
    e = expected.groupBy(*keys).agg(F.countDistinct(key).alias("n_expected"))
    a = actual.groupBy(*keys).agg(F.countDistinct(key).alias("n_actual"))
    both = e.join(a, list(keys), "left").withColumn("n_actual", F.coalesce("n_actual", F.lit(0)))
    ratio = F.col("n_actual") / F.col("n_expected")
    return both.withColumns({"ratio": ratio, "ok": ratio >= least})


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.0) -> DataFrame:
    """How many keys both have, how many differ by more than the tolerance, and the rate of these."""
    both = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), list(keys))
    counts = both.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("_a") - F.col("_b")) > tolerance).alias("n_off"))
    return counts.withColumn("rate", F.when(F.col("n") > 0, F.col("n_off") / F.col("n")))


def collisions(df: DataFrame, group: Sequence[str], identity: Sequence[str]) -> DataFrame:
    """Groups with fewer distinct identities than rows."""
    counts = df.groupBy(*group).agg(F.count("*").alias("n_rows"), F.countDistinct(*identity).alias("n_distinct"))
    return counts.filter("n_distinct < n_rows")


def fresh(df: DataFrame, at: str, now: Column, max_hours: float, name: str) -> DataFrame:
    """Age in hours of the latest row, by a given clock."""
    age = df.agg(F.max(at).cast("timestamp").alias("t")).select(((F.unix_micros(now.cast("timestamp")) - F.unix_micros("t")) / 3.6e9).alias("h"))
    return finding(age, name, F.col("h").isNull() | (F.col("h") > max_hours), F.round("h", 3))


def durable(ledger: DataFrame, landed: DataFrame, key: str, rows: str = "n_rows") -> DataFrame:
    """Items that are done: one loaded (or unavailable) ledger line, and as many landed rows as it says."""
    counts = landed.groupBy(key).agg(F.count("*").alias("_landed"))
    both = ledger.join(counts, key, "left").withColumn("_landed", F.coalesce("_landed", F.lit(0)))
    terminal = F.col("status").isin("loaded", "unavailable")
    done = both.groupBy(key).agg(
        F.count_if(terminal).alias("n_terminal"), F.bool_and(F.when(F.col("status") == "loaded", F.col(rows) == F.col("_landed")).otherwise(True)).alias("same")
    )
    return done.withColumn("done", (F.col("n_terminal") == 1) & F.col("same"))


def suite(*findings: DataFrame) -> DataFrame:
    from pennant.operators.sets import stacked

    return stacked(findings)


#: Longer values are told apart by their SHA-256.
SHORT = 64


def _as_text(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    return F.when(F.col(c).isNotNull(), F.to_json(F.struct(F.col(c)))) if isinstance(kind, ArrayType | MapType | StructType) else F.col(c).cast("string")


def census(tables: dict[str, DataFrame]) -> DataFrame:
    """tab, field, n, filled, kinds, least, most of all fields (as text), and low, high of those that are numbers, dates or times (seconds).

    Distinct values are the groups of one aggregate over (field, value), so rows
    aren't multiplied by the number of fields in a shuffle: what is exchanged is
    one row for each value and task.
    """
    out = None
    for tab, df in tables.items():
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), _as_text(df, c).alias("value")) for c in df.columns])).alias("x")
        short = F.when(F.length("x.value") > SHORT, F.sha2("x.value", 256)).otherwise(F.col("x.value")).alias("value")
        values = df.select(pairs).select("x.field", short).groupBy("field", "value").agg(F.count("*").alias("n"))
        kinds = values.groupBy("field").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"), F.count("value").alias("kinds"))
        ends = []
        for c in df.columns:
            kind = df.schema[c].dataType
            number = F.col(c).cast("double") if isinstance(kind, NumericType) else F.unix_micros(F.col(c).cast("timestamp")) / 1e6 if isinstance(kind, DateType | TimestampType | TimestampNTZType) else F.lit(None).cast("double")
            ends.append(F.struct(F.lit(c).alias("field"), F.min(_as_text(df, c)).alias("least"), F.max(_as_text(df, c)).alias("most"), F.min(number).alias("low"), F.max(number).alias("high")))
        edges = df.agg(F.array(*ends).alias("x")).select(F.inline("x"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
        one = edges.join(kinds, "field", "left").select(F.lit(tab).alias("tab"), "field", zero("n"), zero("filled"), zero("kinds"), "least", "most", "low", "high")
        out = one if out is None else out.unionByName(one)
    return out


def sketches(df: DataFrame) -> DataFrame:
    """field, n, filled and a sketch of the distinct values: what is kept of a part of a table, to be merged with that of others."""
    facts = [F.struct(F.lit(c).alias("field"), F.count("*").alias("n"), F.count(c).alias("filled"), F.hll_sketch_agg(_as_text(df, c)).alias("sketch")) for c in df.columns]
    return df.agg(F.array(*facts).alias("x")).select(F.inline("x"))


def merged_sketches(parts: DataFrame) -> DataFrame:
    """field, n, filled and the estimated number of distinct values over all parts."""
    return parts.groupBy("field").agg(F.sum("n").alias("n"), F.sum("filled").alias("filled"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("kinds"))


def classified(census_rows: DataFrame, wide: int = 100) -> DataFrame:
    """census_rows with the part each field plays, by the first rule that its values fit: empty, constant, key (all there, all different), reference, measure (numbers of more than `wide` values), category."""
    number = F.col("low").isNotNull()
    rules = ((F.col("filled") == 0, "empty"), (F.col("kinds") == 1, "constant"), ((F.col("kinds") == F.col("n")) & (F.col("filled") == F.col("n")), "key"), (F.col("field").rlike("(key|_id)$"), "reference"), (number & (F.col("kinds") > wide), "measure"))
    part = F.lit("category")
    for fits, name in reversed(rules):
        part = F.when(fits, name).otherwise(part)
    return census_rows.withColumn("part", part)


def lineage(spark: SparkSession, tables: dict[str, DataFrame], rules: Sequence[tuple[str, str]], otherwise: str = "unmapped") -> DataFrame:
    """tab, field, lineage of all fields, by the first rule (name, pattern) that the field's name fits."""
    fields = spark.createDataFrame([(tab, c) for tab, df in tables.items() for c in df.columns], "tab string, field string")
    kind = F.lit(otherwise)
    for name, pattern in reversed(list(rules)):
        kind = F.when(F.col("field").rlike(pattern), name).otherwise(kind)
    return fields.withColumn("lineage", kind)
