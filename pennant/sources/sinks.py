"""Load semantics on Parquet: replace, scoped replace, append with identity, upsert, snapshots.

Parquet has no MERGE, so a table is read, merged into a new version beside the
old one, and the version is named in a small pointer table; what is being read
is never overwritten.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pennant.sources.files import Files


def clean_names(names: Sequence[str]) -> list[str]:
    """Lower case, other characters than a-z, 0-9 and _ become _, a leading digit gets n; empty or equal names are refused."""
    out = []
    for name in names:
        plain = re.sub(r"[^a-z0-9_]", "_", name.strip().lower())
        plain = f"n{plain}" if plain[:1].isdigit() else plain
        if not plain.strip("_"):
            raise ValueError(f"column name {name!r} is empty")
        out.append(plain)
    double = {x for x in out if out.count(x) > 1}
    if double:
        raise ValueError(f"column names collide: {sorted(double)}")
    return out


def as_raw(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """All columns as text under clean names, and when they were loaded."""
    named = df.toDF(*clean_names(df.columns))
    return named.select(*[F.col(c).cast("string") for c in named.columns], (F.current_timestamp() if loaded_at is None else loaded_at).alias("_loaded_at"))


def drift(old: DataFrame, new: DataFrame, policy: str = "warn") -> dict[str, list[str]]:
    """Columns that came and went; policy "error" refuses both."""
    found = {"added": sorted(set(new.columns) - set(old.columns)), "missing": sorted(set(old.columns) - set(new.columns))}
    if policy == "error" and (found["added"] or found["missing"]):
        raise ValueError(f"schema drift: {found}")
    return found


def scoped_replace(old: DataFrame, new: DataFrame, scope: str, scopes: Sequence | None = None) -> DataFrame:
    """Rows of the named scopes (default: those in new) give way to new; others stay, also where new has no row for a scope."""
    spark = old.sparkSession
    if scopes is None:
        gone = new.select(scope).distinct()
    else:
        gone = spark.createDataFrame([(s,) for s in scopes], f"{scope} {old.schema[scope].dataType.simpleString()}")
    keep = old.join(gone, old[scope].eqNullSafe(gone[scope]), "left_anti")
    return keep.unionByName(new, allowMissingColumns=True)


def check_identity(new: DataFrame, identity: Sequence[str]) -> DataFrame:
    """new, if its identity columns exist, aren't null and don't repeat."""
    missing = [c for c in identity if c not in new.columns]
    if missing:
        raise ValueError(f"identity columns {missing} are missing")
    null = new.filter(" or ".join(f"`{c}` is null" for c in identity))
    if not null.isEmpty():
        raise ValueError("identity columns hold nulls")
    if not new.groupBy(*identity).count().filter("count > 1").isEmpty():
        raise ValueError("identity repeats in the batch")
    return new


def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows, and new ones whose key is absent; the first of new rows with one key."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in new.columns])
    fresh = new.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n").join(old.select(*keys), list(keys), "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], rules: dict[str, str] | None = None) -> DataFrame:
    """Merge by key. Rule per column: "new" (default), "keep" (old unless null), "fill" (new unless null), "add"."""
    rules = rules or {}
    values = [c for c in old.columns if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in values], F.lit(True).alias("_o"))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in values], F.lit(True).alias("_n"))
    out = []
    for c in values:
        a, b = F.col(f"_o_{c}"), F.col(f"_n_{c}")
        both = {"new": b, "keep": F.coalesce(a, b), "fill": F.coalesce(b, a), "add": F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))}[rules.get(c, "new")]
        out.append(F.when(F.col("_o").isNull(), b).when(F.col("_n").isNull(), a).otherwise(both).alias(c))
    return o.join(n, list(keys), "full_outer").select(*keys, *out)


def fill_missing(df: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Nulls of the columns filled from a second source, each column by itself."""
    side = other.select(*keys, *[F.col(c).alias(f"_f_{c}") for c in columns])
    return df.join(side, list(keys), "left").withColumns({c: F.coalesce(c, f"_f_{c}") for c in columns}).drop(*[f"_f_{c}" for c in columns])


def update_from(games: DataFrame, tall: DataFrame, game: str, entity: str, sides: Sequence[str], values: Sequence[str]) -> DataFrame:
    """home_/away_ columns of a game from a table with a row per game and entity; a side without a row is null."""
    for side in sides:
        one = tall.select(F.col(game), F.col(entity).alias(f"{side}_{entity}"), *[F.col(v).alias(f"{side}_{v}") for v in values])
        games = games.join(one, [game, f"{side}_{entity}"], "left")
    return games


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a table as its next version and return that version's path. Numbers are claimed before they are written, so two writers never share one."""
    spark = df.sparkSession
    try:
        last = spark.read.text(f"{path}/_versions").agg(F.max(F.col("value").cast("int"))).first()[0] or 0
    except Exception as e:  # a table without versions
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = 0
    number, own = last + 1, Files(spark, path)
    while not own.create(f"_claims/{number}.json", {}):
        number += 1
    to = f"{path}/v{number}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(to)
    spark.createDataFrame([(str(number),)], "value string").coalesce(1).write.mode("append").text(f"{path}/_versions")
    return to


def read_version(spark: SparkSession, path: str) -> DataFrame:
    last = spark.read.text(f"{path}/_versions").agg(F.max(F.col("value").cast("int"))).first()[0]
    return spark.read.parquet(f"{path}/v{last}")


def content_id(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """SHA-256 of a table's rows in any order: row digests are added up, so nothing is collected."""
    columns = sorted(columns or df.columns)
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).alias(f"p{k}") for k in range(8)]
    sums = df.select(*columns).agg(F.count("*").alias("n"), *parts)
    return sums.select(F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in sums.columns]), 256)).first()[0]


def export_csv(df: DataFrame, path: str, order: Sequence[str] = (), where: Column | None = None) -> None:
    rows = df if where is None else df.filter(where)
    (rows.orderBy(*order) if order else rows).write.csv(path, header=True)


def write_artifact(df: DataFrame, path: str) -> DataFrame:
    """Write gzip NDJSON files; name and digest (SHA-256) of each, the record that a verified replay asks for."""
    df.write.json(path, compression="gzip")
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.json.gz").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("digest"))


def write_artifacts(df: DataFrame, by: Sequence[str], order: Sequence[str], row: str, path: str) -> DataFrame:
    """One artifact for each group: its rows (a struct column) as JSON lines in order, under the SHA-256 of the text. by, name, size in bytes, and whether it was written now.

    Artifacts that the folder has are not written again. A group is one text, so it must fit a task; group by a scope that is bounded.
    """
    spark = df.sparkSession
    lines = F.array_sort(F.collect_list(F.struct(*order, F.to_json(row, {"ignoreNullFields": "false"}).alias("_line"))))
    made = df.groupBy(*by).agg(F.array_join(F.transform(lines, lambda x: x["_line"]), "\n").alias("body"))
    made = made.select(*by, F.concat(F.sha2("body", 256), F.lit(".json")).alias("name"), F.octet_length("body").cast("long").alias("size"), "body")
    try:
        there = spark.read.schema("name string, body string").parquet(path).select(F.col("name").alias("_there")).distinct()
    except Exception as e:  # a folder without artifacts
        if "PATH_NOT_FOUND" not in str(e):
            raise
        there = spark.createDataFrame([], "_there string")
    told = made.join(there, made["name"] == there["_there"], "left").withColumn("written", F.col("_there").isNull()).drop("_there")
    # The rows told are those of one evaluation, also after the folder has changed.
    batch = f"{path.rstrip('/')}-told/{uuid.uuid4().hex}"
    told.write.parquet(batch)
    told = spark.read.schema(told.schema).parquet(batch)
    told.filter("written").select("name", "body").dropDuplicates(["name"]).write.mode("append").parquet(path)
    return told.drop("body")


def record_loads(ledger: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ledger with a batch's rows by key: one row for each loaded scope, the batch's where both have it."""
    loaded = batch.groupBy(*keys).agg(F.count("*").alias("n"))
    return ledger.join(loaded, list(keys), "left_anti").select(*keys, "n").unionByName(loaded)
