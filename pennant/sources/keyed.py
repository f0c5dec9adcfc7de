"""Keyed tables: Parquet in buckets of a key's hash, under manifests that name the files of each bucket.

A merge reads and rewrites only the buckets its batch touches; every other
bucket's files stay as they are. What readers see is one manifest, the one with
the greatest number, so a merge is seen whole or not at all. Manifests are made
by creating a file that must not exist: of two writers that began from one state
the second fails with `Conflict`, and `merge` begins again from the new state. A
batch carries its writer's name and number; a number that the manifest already
has for that writer changes nothing, so a batch that is sent again is safe.

Layout: <path>/data/<merge>/_bucket=<k>/..., <path>/manifest/<number>.json. Files
of earlier manifests stay for readers that have begun; `vacuum` removes those
that the newest manifests don't name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from pennant.sources.files import Files

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has committed since this one read the table."""


class KeyedTable:
    """A table whose rows are found by the hash of `keys`.

    buckets is fixed when the table is made; choose it so that a bucket is some
    hundred MB. Rows whose keys are null share a bucket and are equal as keys.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = 64):
        if BUCKET in schema.names:
            raise ValueError(f"{BUCKET} is the name of the bucket's folder")
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.own = Files(spark, self.path)
        if self._number() is None:
            try:
                self._commit(1, {"buckets": buckets, "keys": self.keys, "files": {}, "seen": {}, "n": 0})
            except Conflict:  # another writer has made the table meanwhile
                pass
        if (held := self.manifest()[1]["keys"]) != self.keys:
            raise ValueError(f"the table is kept by {held}, not by {self.keys}")

    def _numbers(self) -> list[int]:
        return self.own.numbers("manifest")

    def _read(self, number: int) -> dict | None:
        """A manifest, or none while its writer hasn't finished (or never will)."""
        return self.own.read(f"manifest/{number}.json")

    def _number(self) -> int | None:
        return next((n for n in self._numbers() if self._read(n)), None)

    def _commit(self, number: int, manifest: dict) -> None:
        if not self.own.create(f"manifest/{number}.json", manifest):
            raise Conflict(f"{self.path}: manifest {number} is there already")

    def manifest(self) -> tuple[int, dict]:
        for n in self._numbers():
            if held := self._read(n):
                return n, held
        raise ValueError(f"{self.path} has no manifest")

    def files(self) -> dict[int, list[str]]:
        """Folders that hold each bucket."""
        return {int(k): v for k, v in self.manifest()[1]["files"].items()}

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._rows([f for folders in self.files().values() for f in folders])

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys; only their buckets are read."""
        held = self.manifest()[1]
        asked = keys.select(*self.keys).distinct()
        touched = {r[0] for r in self._bucketed(asked, held["buckets"]).select(BUCKET).distinct().collect()}
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"k.{k}")) for k in self.keys]
        return self._rows([f for k in sorted(touched) for f in held["files"].get(str(k), [])]).alias("t").join(asked.alias("k"), same, "left_semi")

    def _bucketed(self, df: DataFrame, n: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(n)).cast("int"))

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], writer: str | None = None, number: int | None = None, tries: int = 5) -> int:
        """Rows of the touched buckets become combine(old rows, batch); the manifest's number after it.

        combine must only make rows whose keys lie in the batch's buckets, which
        any rule does that works key by key.
        """
        batch = batch.select(*self.schema.names)
        for attempt in range(tries):
            at, held = self.manifest()
            if writer is not None and held["seen"].get(writer, -1) >= number:
                return at
            try:
                return self._merge(batch, combine, at, held, writer, number)
            except Conflict:
                if attempt == tries - 1:
                    raise
        raise AssertionError

    def _merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], at: int, held: dict, writer: str | None, number: int | None) -> int:
        n = held["buckets"]
        touched = sorted(r[0] for r in self._bucketed(batch, n).select(BUCKET).distinct().collect())
        files = dict(held["files"])
        if touched:
            old = self._rows([f for k in touched for f in files.get(str(k), [])])
            # Large buckets are split over tasks by the rebalance, small ones share one.
            rows = self._bucketed(combine(old, batch).select(*self.schema.names), n).hint("rebalance", BUCKET)
            to = f"data/{uuid.uuid4().hex}"
            rows.write.partitionBy(BUCKET).parquet(f"{self.path}/{to}")
            made = self.own.names(to)
            for k in touched:
                folder = f"{BUCKET}={k}"
                files[str(k)] = [f"{to}/{folder}"] if folder in made else []
        seen = held["seen"] | ({writer: number} if writer is not None else {})
        if (newest := self._numbers()[0]) != at:
            raise Conflict(f"{self.path}: manifest {newest} came after {at}; if its writer has died before it was finished, call repair()")
        self._commit(at + 1, held | {"files": files, "seen": seen, "n": held["n"] + 1})
        return at + 1

    def repair(self) -> int:
        """Remove manifests that were begun but never finished; only while nobody writes."""
        broken = [n for n in self._numbers() if not self._read(n)]
        for n in broken:
            self.own.delete(f"manifest/{n}.json")
        return len(broken)

    def sink(self, writer: str, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """For foreachBatch: each micro-batch merged once under the writer's name."""
        return lambda batch, number: self.merge(batch, combine, writer, number) and None

    def vacuum(self, keep: int = 1) -> int:
        """Remove data that none of the `keep` newest manifests names, and older manifests; only while nobody writes. How many folders went."""
        numbers = [n for n in self._numbers() if self._read(n)]
        named = {f for n in numbers[:keep] for v in self._read(n)["files"].values() for f in v}
        gone = 0
        for merge in self.own.names("data", folders=True):
            for bucket in self.own.names(f"data/{merge}", folders=True):
                if f"data/{merge}/{bucket}" not in named:
                    self.own.delete(f"data/{merge}/{bucket}")
                    gone += 1
        for n in numbers[keep:]:
            self.own.delete(f"manifest/{n}.json")
        return gone


def latest(keys: Sequence[str], at: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Of each key the row that is last by `at`; of equal ones the batch's."""

    def combine(old: DataFrame, batch: DataFrame) -> DataFrame:
        both = old.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
        rest = [f.name for f in batch.schema if not isinstance(f.dataType, MapType)]
        last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in at], F.col("_new").desc(), *[F.col(c).desc_nulls_last() for c in rest])
        return both.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "_new")

    return combine


def scopes(scope: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Rows of the batch's scopes give way to the batch. The table must be kept by the scope."""

    def combine(old: DataFrame, batch: DataFrame) -> DataFrame:
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"b.{c}")) for c in scope]
        return old.alias("o").join(batch.select(*scope).distinct().alias("b"), same, "left_anti").unionByName(batch)

    return combine


def changed_files(before: dict[int, list[str]], after: dict[int, list[str]]) -> Iterator[int]:
    """Buckets whose files differ between two states."""
    return (k for k in sorted(before.keys() | after.keys()) if before.get(k) != after.get(k))
