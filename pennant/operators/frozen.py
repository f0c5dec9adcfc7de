"""Write-once snapshots under a digest of their rows, and results that are computed once for a snapshot and a specification.

A snapshot's digest is a tree: every row's SHA-256 is added up by bucket of its
key, a bucket's digest is that of its sums, and the root that of the buckets'
digests in order. Sums don't depend on order or partitions, need one map-side
aggregate, and tell which bucket of two snapshots differs. Rows are told apart
by the canonical JSON of their columns in order of name, nulls included. Keys
must be there and be unique; a table in which one is missing or comes twice is
refused.

Layout: <root>/snapshots/<digest>/rows and /buckets; <root>/results/<id>/rows.
A folder counts once its file `_done` is there, which is created without
overwriting: of two writers of one content the second finds the first's.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.sources.files import Files

BUCKETS = 256
PARTS = [f"p{k}" for k in range(8)]


class Damaged(ValueError):
    """What is stored isn't what its digest says."""


def _row(columns: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def buckets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """bucket, n, digest of every bucket that has rows."""
    hashed = df.select(F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int").alias("bucket"), _row(df.columns).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")).alias(p) for k, p in enumerate(PARTS)]
    rows = hashed.groupBy("bucket").agg(F.count("*").alias("n"), *sums)
    return rows.select("bucket", "n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *[F.col(p).cast("string") for p in PARTS]), 256).alias("digest"))


def root_of(rows: Sequence, columns: Sequence[str], keys: Sequence[str]) -> str:
    """rows: (bucket, n, digest), one for each bucket at most."""
    text = json.dumps([sorted(columns), list(keys), sorted((r[0], r[1], r[2]) for r in rows)], separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that come more than once or have a part that is null, and how often."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | missing)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.own = Files(spark, self.root)

    def _finish(self, folder: str, facts: dict) -> dict:
        """facts, or those of the writer that was first."""
        return facts if self.own.create(f"{folder}/_done", facts) else self.own.read(f"{folder}/_done") or facts

    def freeze(self, df: DataFrame, keys: Sequence[str]) -> str:
        """Store df and return its digest; equal rows are stored once, however often and from wherever they come."""
        if (bad := repeated(df, keys).first()) is not None:
            raise ValueError(f"key {[bad[k] for k in keys]} comes {bad['n']} times or isn't whole")
        made = [tuple(r) for r in buckets(df, keys).collect()]
        digest = root_of(made, df.columns, keys)
        folder = f"snapshots/{digest}"
        if self.own.read(f"{folder}/_done") is None:
            # Each writer has a folder of its own; the first to finish names it.
            part = uuid.uuid4().hex
            df.select(*sorted(df.columns)).write.parquet(f"{self.root}/{folder}/rows-{part}")
            stored = [tuple(r) for r in buckets(self.spark.read.parquet(f"{self.root}/{folder}/rows-{part}"), keys).collect()]
            if root_of(stored, df.columns, keys) != digest:
                raise Damaged(f"the rows changed while they were written: buckets {changed(made, stored)}")
            self._finish(folder, {"rows": f"rows-{part}", "keys": list(keys), "buckets": stored})
        return digest

    def snapshot(self, digest: str) -> DataFrame:
        facts = self._known(digest)
        return self.spark.read.parquet(f"{self.root}/snapshots/{digest}/{facts['rows']}")

    def _known(self, digest: str) -> dict:
        if (facts := self.own.read(f"snapshots/{digest}/_done")) is None:
            raise KeyError(f"no snapshot {digest}")
        return facts

    def verify(self, digest: str) -> None:
        """Raise Damaged, with the buckets that changed, if the stored rows aren't those that were frozen."""
        facts, rows = self._known(digest), self.snapshot(digest)
        now = [tuple(r) for r in buckets(rows, facts["keys"]).collect()]
        if root_of(now, rows.columns, facts["keys"]) != digest:
            raise Damaged(f"snapshot {digest}: buckets {changed(facts['buckets'], now)}")

    def difference(self, one: str, other: str) -> list[int]:
        """Buckets of two snapshots that differ, without reading their rows."""
        return changed(self._known(one)["buckets"], self._known(other)["buckets"])

    def changed_rows(self, one: str, other: str) -> DataFrame:
        """Rows of either snapshot that the other hasn't, of the buckets that differ: side (0 or 1) and the columns."""
        differ, keys = self.difference(one, other), self._known(one)["keys"]
        own = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int").isin(*differ) if differ else F.lit(False)
        x, y = self.snapshot(one).filter(own), self.snapshot(other).filter(own)
        return x.exceptAll(y).withColumn("side", F.lit(0)).unionByName(y.exceptAll(x).withColumn("side", F.lit(1)))

    def once(self, digest: str, specification: Mapping, compute: Callable[[DataFrame], DataFrame]) -> tuple[str, DataFrame, bool]:
        """Id, result and whether it was there already of compute(snapshot) under a specification.

        The id is a hash of both; a result that is there is read and compute isn't called.
        """
        text = json.dumps([digest, specification], sort_keys=True, default=str, separators=(",", ":"))
        key = hashlib.sha256(text.encode()).hexdigest()
        folder = f"results/{key}"
        facts = self.own.read(f"{folder}/_done")
        found = facts is not None
        if not found:
            part = f"rows-{uuid.uuid4().hex}"
            compute(self.snapshot(digest)).write.parquet(f"{self.root}/{folder}/{part}")
            facts = self._finish(folder, {"rows": part, "specification": json.loads(text)[1], "snapshot": digest})
        return key, self.spark.read.parquet(f"{self.root}/{folder}/{facts['rows']}"), found


def changed(one: Sequence, other: Sequence) -> list[int]:
    """Buckets whose digest differs, or that only one side has."""
    a, b = ({r[0]: tuple(r)[1:] for r in x} for x in (one, other))
    return sorted(k for k in a.keys() | b.keys() if a.get(k) != b.get(k))
