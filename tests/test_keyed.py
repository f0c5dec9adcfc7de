"""Keyed tables and the stream of changes: several batches, restarts, writers side by side."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from pennant.sources import keyed
from pennant.streaming import snapshots

SCHEMA = "k string, at int, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table(spark, path, buckets=8):
    return keyed.KeyedTable(spark, str(path), frame(spark, []).schema, ["k"], buckets)


def content(path):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(path / "data") for n in names}


LATEST = keyed.latest(["k"], ["at"])


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.merge(frame(spark, [(f"k{i}", 1, "a") for i in range(40)] + [(None, 1, "none")]), LATEST)
    before, files = t.files(), content(tmp_path / "t")
    t.merge(frame(spark, [("k3", 2, "b"), ("k3", 0, "old"), (None, 0, "late"), ("new", 1, "n")]), LATEST)
    want = {f"k{i}": (1, "a") for i in range(40)} | {None: (1, "none"), "k3": (2, "b"), "new": (1, "n")}
    assert {r.k: (r.at, r.v) for r in t.read().collect()} == want
    assert 0 < len(list(keyed.changed_files(before, t.files()))) <= 3
    assert {f: content(tmp_path / "t").get(f) for f in files} == files
    assert rows(t.lookup(frame(spark, [("k3", 9, "x"), ("nobody", 0, ""), (None, 0, "")]))) == [("k3", 2, "b"), (None, 1, "none")]
    assert t.vacuum() > 0 and {r.k: (r.at, r.v) for r in t.read().collect()} == want


def test_a_batch_counts_once(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    add = lambda old, batch: old.unionByName(batch)
    for number in (0, 1, 1, 0):
        t.merge(frame(spark, [("a", number, "x")]), add, "w", number)
    t.merge(frame(spark, [("a", 0, "x")]), add, "other", 0)
    t.merge(frame(spark, []), add, "w", 2)
    assert rows(t.read()) == [("a", 0, "x"), ("a", 0, "x"), ("a", 1, "x")] and t.manifest()[1]["seen"] == {"w": 2, "other": 0}


def test_writers_side_by_side(spark, tmp_path):
    """A writer that another one overtakes fails its commit, begins again and loses nothing."""
    one, other = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    calls = []

    def overtaken(old, batch):
        if not calls:
            other.merge(frame(spark, [("b", 1, "other")]), LATEST)
        calls.append(1)
        return LATEST(old, batch)

    one.merge(frame(spark, [("a", 1, "one")]), overtaken)
    assert len(calls) == 2 and rows(one.read()) == [("a", 1, "one"), ("b", 1, "other")]
    calls.clear()
    with pytest.raises(keyed.Conflict):
        one.merge(frame(spark, [("a", 2, "one")]), overtaken, tries=1)
    assert rows(one.read()) == [("a", 1, "one"), ("b", 1, "other")]


def test_unfinished_manifest(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.merge(frame(spark, [("a", 1, "x")]), LATEST)
    (tmp_path / "t/manifest/99.json").write_text('{"buckets": 8')
    assert rows(t.read()) == [("a", 1, "x")]
    with pytest.raises(keyed.Conflict, match="repair"):
        t.merge(frame(spark, [("a", 2, "y")]), LATEST, tries=2)
    assert t.repair() == 1
    t.merge(frame(spark, [("a", 2, "y")]), LATEST)
    assert rows(t.read()) == [("a", 2, "y")]


def test_scopes_and_shape(spark, tmp_path):
    t = table(spark, tmp_path / "t", 4)
    t.merge(frame(spark, [("s1", 1, "a"), ("s1", 2, "b"), ("s2", 1, "c"), (None, 1, "d")]), keyed.scopes(["k"]))
    t.merge(frame(spark, [("s1", 9, "z"), (None, 2, "e"), (None, 3, "f")]), keyed.scopes(["k"]))
    assert rows(t.read()) == rows(frame(spark, [("s1", 9, "z"), ("s2", 1, "c"), (None, 2, "e"), (None, 3, "f")]))
    with pytest.raises(ValueError, match="kept by"):
        keyed.KeyedTable(spark, str(tmp_path / "t"), t.schema, ["at"])
    assert keyed.KeyedTable(spark, str(tmp_path / "t"), t.schema, ["k"], 99).manifest()[1]["buckets"] == 4


def brute(events, upto):
    """Changes among the rows of up to `upto` seconds, by key and time."""
    out, last = [], {}
    for k, s, v, n in sorted((e for e in events if e[1] <= upto), key=lambda e: (e[0], e[1], e[3])):
        if k not in last or last[k] != v:
            out.append((k, s, v, n))
        last[k] = v
    return sorted(out, key=repr)


def put(spark, batch, path):
    begin = datetime.datetime(2024, 1, 1)
    made = [(k, begin + datetime.timedelta(seconds=s), v, n) for k, s, v, n in batch]
    spark.createDataFrame(made, "k int, at timestamp, v string, n int").coalesce(1).write.mode("append").parquet(path)


def test_changes_out_of_order(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    batches = [[[(1, 5, "a", 1), (1, 3, "b", 2), (2, 4, None, 3)], [(1, 4, "a", 4), (1, 12, "a", 5), (2, 7, None, 6), (2, 7, "x", 7)]], [[(1, 9, "b", 8), (3, 11, "q", 9)], [(1, 30, "c", 10), (2, 21, "x", 11)]], [[(1, 8, "too late", 12), (2, 60, "y", 13)]]]
    seen = []
    for run in batches:  # each run goes on from the checkpoint of the one before
        for batch in run:
            put(spark, batch, src)
            seen += [e for e in batch if e[2] != "too late"]
        schema = spark.read.parquet(src).schema
        snapshots.append(snapshots.ordered_changes(snapshots.read(spark, src, schema, 1), ["k"], "at", "v", "10 seconds", order=["n"]), out, cp).awaitTermination()
        got = sorted(((r.k, int((r.at - datetime.datetime(2024, 1, 1)).total_seconds()), r.v, r.n) for r in spark.read.schema(schema).parquet(out).collect()), key=repr)
        assert got == brute(seen, max(e[1] for e in seen) - 10)


def test_silent_keys_are_forgotten(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    for batch in ([(1, 0, "a", 1), (2, 0, "a", 2)], [(2, 7300, "b", 3)], [(2, 7301, "b", 4)], [(1, 7302, "a", 5), (2, 7302, "b", 6)]):
        put(spark, batch, src)
        schema = spark.read.parquet(src).schema
        snapshots.append(snapshots.changes(snapshots.read(spark, src, schema, 1), ["k"], "at", "v", "10 seconds", ttl_hours=1), out, cp).awaitTermination()
    assert sorted(r.n for r in spark.read.schema(schema).parquet(out).select(F.col("n")).collect()) == [1, 2, 3, 5]
