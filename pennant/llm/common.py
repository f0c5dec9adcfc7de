"""Reading tables, writing intermediate tables and row identity."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows without an id sort after every row that has one.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Without one only a local session goes on, in a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = f"{tempfile.gettempdir()}/pennant-checkpoint"
    return named


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, every executor sees it. file_rows: so many rows in a file at most."""
    spark = df.sparkSession
    path = new_path(spark, label)
    (df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_key(id_col: str = "doc_id") -> Column:
    """The id as a number that is never null: a row without one sorts last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def text_key(text_col: str = "text") -> Column:
    """Second half of a row's identity, for tables in which an id comes twice with other text."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column of df has: `name`, with underscores added while it is taken in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
