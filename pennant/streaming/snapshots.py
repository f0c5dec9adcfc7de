"""Snapshot streams: append, changes only, first wins, latest per key, late corrections."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import LongType, StructField, StructType


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, or, in a local session alone, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.gettempdir()
    return f"{base}/pennant-{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """df, written once in a new shared folder and read back from there."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 8) -> DataFrame:
    """Stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def active(df: DataFrame, condition: Column) -> DataFrame:
    """Snapshots of what is open."""
    return df.filter(condition)


def first_wins(df: DataFrame, keys: Sequence[str], at: str, delay: str = "1 day") -> DataFrame:
    """The first row of each key; state older than the delay is dropped."""
    return df.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


class _Changes(StatefulProcessor):
    """Rows of a key against its last value. wait: rows stay in the state until the watermark has passed them."""

    def __init__(self, schema: StructType, at: str, order: Sequence[str], value: str, ttl_ms: int | None, wait: bool):
        self.schema, self.at, self.ttl_ms, self.wait = schema, schema.names.index(at), ttl_ms, wait
        self.order, self.value = [schema.names.index(c) for c in (at, *order)], schema.names.index(value)
        self.kept = StructType([StructField(f.name, LongType() if f.name == at else f.dataType) for f in schema])
        self.last_type = StructType([StructField("value", schema[value].dataType), StructField("at", LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.early = handle.getListState("early", self.kept)
        self.last = handle.getValueState("last", self.last_type)

    def _changed(self, rows: list[tuple], now: int) -> Iterator[pd.DataFrame]:
        """Of final rows those that change the value, if any; the state after them. Every call on the state is a round trip, every frame costs about as much."""
        if not rows:
            return
        held, out = self.last.get(), []
        for r in sorted(rows, key=lambda r: [(r[c] is not None, r[c]) for c in self.order]):
            if held is None or r[self.value] != held[0]:
                out.append(r)
            held = (r[self.value], max(r[self.at], held[1]) if held else r[self.at])
        self.last.update(held)
        if self.ttl_ms is not None:
            self.handle.registerTimer(max(held[1] // 1000 + self.ttl_ms, now + 1))
        if out:
            frame = pd.DataFrame(out, columns=self.schema.names)
            at = self.schema.names[self.at]
            frame[at] = pd.to_datetime(frame[at].astype("int64"), unit="us")
            yield frame

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        at, come = self.schema.names[self.at], []
        for frame in rows:
            times = frame[at].astype("datetime64[us]").astype("int64")
            columns = [times if n == at else frame[n] for n in self.schema.names]
            come += [tuple(None if pd.isna(v) else v for v in r) for r in zip(*(c.tolist() for c in columns), strict=True)]
        if self.wait:
            self.early.appendList(come)
            self.handle.registerTimer(min(r[self.at] for r in come) // 1000)
        else:
            yield from self._changed(come, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        early = [tuple(r) for r in self.early.get()] if self.wait else []
        due, rest = ([r for r in early if (r[self.at] // 1000 <= now) == final] for final in (True, False))
        if due and rest:
            self.early.put(rest)
            self.handle.registerTimer(min(r[self.at] for r in rest) // 1000)
        elif due:
            self.early.clear()
        if not due and not rest and self.ttl_ms is not None:
            held = self.last.get()
            if held is not None and held[1] // 1000 + self.ttl_ms <= now:
                self.last.clear()
        yield from self._changed(due, now)


def _by_state(df: DataFrame, keys: Sequence[str], at: str, value: str, delay: str, ttl_hours: float | None, order: Sequence[str], wait: bool) -> DataFrame:
    processor = _Changes(df.schema, at, order, value, None if ttl_hours is None else int(ttl_hours * 3_600_000), wait)
    return df.withWatermark(at, delay).groupBy(*keys).transformWithStateInPandas(processor, df.schema, "Append", "EventTime", eventTimeColumnName=at)


def changes(df: DataFrame, keys: Sequence[str], at: str, value: str, delay: str = "1 day", ttl_hours: float | None = 24 * 30, order: Sequence[str] = ()) -> DataFrame:
    """Rows whose value differs from their key's last one, null being a value, as soon as they come.

    Rows of one batch are taken in order of time; a row that comes after a later
    one of an earlier batch is compared with that. State is one value per key and
    is dropped when a key has been silent for ttl_hours of event time.
    """
    return _by_state(df, keys, at, value, delay, ttl_hours, order, wait=False)


def ordered_changes(df: DataFrame, keys: Sequence[str], at: str, value: str, delay: str = "1 day", ttl_hours: float | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Rows whose value differs from their key's last one in event time, null being a value.

    Rows may come out of order by up to `delay`: they wait in the state until the
    watermark has passed their time and are then taken in order of time (ties: by
    `order`), so what comes out doesn't depend on how rows fell into batches. Rows
    later than that are dropped; rows that the watermark hasn't passed when a run
    ends wait for the next run from the same checkpoint.
    """
    return _by_state(df, keys, at, value, delay, ttl_hours, order, wait=True)


def latest(df: DataFrame, keys: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """The latest values of each key (for output mode complete or update)."""
    best = F.max(F.struct(F.col(at), *[F.col(v) for v in values])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, f"_best.{at}", *[f"_best.{v}" for v in values])


def windowed(df: DataFrame, at: str, length: str, keys: Sequence[str], delay: str, slide: str | None = None, **aggregates: Column) -> DataFrame:
    """Extension: event-time windows with a watermark."""
    window = F.window(at, length, slide) if slide else F.window(at, length)
    return df.withWatermark(at, delay).groupBy(window.alias("w"), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])


def sessions(df: DataFrame, at: str, gap: str, keys: Sequence[str], delay: str, **aggregates: Column) -> DataFrame:
    """Extension: sessions that end after a gap."""
    return df.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("w"), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, which transformWithState asks for."""
    name, store = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, store)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def append(df: DataFrame, path: str, checkpoint: str):
    """Write a stream as Parquet until its source is read to the end."""
    with keyed_state(df.sparkSession):
        return _append(df, path, checkpoint)


def _append(df: DataFrame, path: str, checkpoint: str):
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replace_scopes(df: DataFrame, path: str, checkpoint: str, scope: str):
    """Each batch replaces the scopes it has rows of, so late corrections win."""
    from pennant.sources import sinks

    def merge(batch: DataFrame, _: int) -> None:
        try:
            old = sinks.read_version(batch.sparkSession, path)
        except Exception as e:  # the first batch has no version before it
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = batch.limit(0)
        sinks.write_version(sinks.scoped_replace(old, batch, scope), path)

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
