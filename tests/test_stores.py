"""Frozen snapshots, growing schemas, census, artifacts and missing time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampNTZType, TimestampType

from pennant.operators import frozen, intervals, quality
from pennant.sources import evolve


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_equal_rows_are_one_snapshot(spark, tmp_path):
    store = frozen.Store(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([(i, f"v{i % 7}" if i % 9 else None, i / 3) for i in range(400)], "id long, v string, x double")
    one = store.freeze(df, ["id"])
    assert store.freeze(df.repartition(7, "v").select("x", "v", "id"), ["id"]) == one
    store.verify(one)
    other = store.freeze(df.withColumn("v", F.when(F.col("id") == 17, "new").otherwise(F.col("v"))).filter("id <> 33"), ["id"])
    assert other != one and 1 <= len(store.difference(one, other)) <= 2
    assert rows(store.changed_rows(one, other), "side", "id", "v") == [(0, 17, "v3"), (0, 33, "v5"), (1, 17, "new")]
    assert rows(store.snapshot(one), "id", "v") == rows(df, "id", "v")


def test_keys_must_be_whole_and_unique(spark, tmp_path):
    store = frozen.Store(spark, str(tmp_path / "s"))
    for bad in ([(1, 2), (1, 3)], [(None, 2)]):
        with pytest.raises(ValueError, match="comes"):
            store.freeze(spark.createDataFrame(bad, "id long, v long"), ["id"])
    empty = store.freeze(spark.createDataFrame([], "id long, v long"), ["id"])
    assert store.snapshot(empty).count() == 0 and empty != store.freeze(spark.createDataFrame([], "id long, w long"), ["id"])


def test_a_changed_row_names_its_bucket(spark, tmp_path):
    store = frozen.Store(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([(i, i) for i in range(50)], "id long, v long")
    digest = store.freeze(df, ["id"])
    folder = next((tmp_path / "s/snapshots" / digest).glob("rows-*"))
    bucket = frozen.buckets(df.filter("id = 5"), ["id"]).first().bucket
    changed = store.snapshot(digest).withColumn("v", F.when(F.col("id") == 5, -1).otherwise(F.col("v")).cast("long")).toPandas()
    for f in folder.glob("*"):
        f.unlink()
    for f in folder.glob(".*"):
        f.unlink()
    changed.to_parquet(folder / "part.parquet")
    spark.catalog.refreshByPath(str(folder))
    with pytest.raises(frozen.Damaged, match=rf"buckets \[{bucket}\]"):
        store.verify(digest)


def test_an_experiment_runs_once(spark, tmp_path):
    store = frozen.Store(spark, str(tmp_path / "s"))
    digest = store.freeze(spark.createDataFrame([(1, 2), (2, 5)], "id long, v long"), ["id"])
    calls = []

    def run(df):
        calls.append(1)
        return df.agg(F.sum("v").alias("s"))

    first, again, other = (store.once(digest, spec, run) for spec in ({"a": 1, "b": 2}, {"b": 2, "a": 1}, {"a": 2}))
    assert first[0] == again[0] != other[0] and (first[2], again[2], other[2]) == (False, True, False) and len(calls) == 2
    assert rows(again[1]) == [(7,)]

    def overtaken(df):
        store.once(digest, {"race": 1}, run)
        return df.agg(F.lit(0).cast("long").alias("s"))

    assert rows(store.once(digest, {"race": 1}, overtaken)[1]) == [(7,)]
    with pytest.raises(KeyError):
        store.snapshot("unknown")


@pytest.mark.parametrize(
    "a,b,want",
    [
        (IntegerType(), LongType(), LongType()), (LongType(), DoubleType(), DoubleType()), (IntegerType(), DecimalType(5, 2), DecimalType(12, 2)), (DecimalType(38, 0), DecimalType(20, 10), DoubleType()),
        (DateType(), TimestampNTZType(), TimestampNTZType()), (DateType(), TimestampType(), TimestampType()), (BooleanType(), IntegerType(), StringType()), (ArrayType(IntegerType()), ArrayType(LongType()), ArrayType(LongType())),
        (StructType().add("x", IntegerType()), StructType().add("X", LongType()).add("y", StringType()), StructType().add("x", LongType()).add("y", StringType())), (StructType(), StringType(), StringType()),
    ],
)
def test_lattice(a, b, want):
    assert evolve.widen(a, b).simpleString() == want.simpleString()
    if not isinstance(want, StructType):
        assert evolve.widen(b, a).simpleString() == want.simpleString()


def test_old_and_new_rows_read_back_together(spark, tmp_path):
    t = evolve.EvolvingTable(spark, str(tmp_path / "t"))
    assert t.append(spark.createDataFrame([(1, (2, "a")), (2, None)], "id int, s struct<x:int,n:string>")) == 1
    assert t.append(spark.createDataFrame([(3_000_000_000, (2.5, [1]), "new")], "ID long, S struct<x:double,l:array<int>>, extra string")) == 2
    t.append(spark.createDataFrame([("three", dt.date(2024, 1, 2))], "id string, day date"))
    t.append(spark.sql("SELECT 4 AS id, NULL AS extra"))
    assert [f.name for f in t.schema()] == ["id", "s", "extra", "day"] and t.schema(1)["id"].dataType == IntegerType()
    got = {r.id: r for r in t.read().collect()}
    assert got["1"].s.x == 2.0 and got["1"].s.n == "a" and got["1"].s.l is None and got["2"].s is None
    assert got["3000000000"].s.l == [1] and got["3000000000"].extra == "new" and got["three"].day == dt.date(2024, 1, 2) and got["4"].extra is None
    assert rows(t.read(1).select("id")) == [(1,), (2,)]
    for bad in ("id string, other int", "id int", "id int, s struct<x:int,n:string>, extra string, day timestamp"):
        with pytest.raises(evolve.Drift):
            t.append(spark.createDataFrame([], bad), drift="error")
    with pytest.raises(evolve.Drift, match="case"):
        t.append(spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "A"))


def test_two_appends_never_share_a_number(spark, tmp_path):
    one, other = (evolve.EvolvingTable(spark, str(tmp_path / "t")) for _ in range(2))
    create = one.own.create

    def late(name, value):
        one.own.create = create
        other.append(spark.createDataFrame([("x",)], "v string"))
        return create(name, value)

    one.own.create = late
    assert one.append(spark.createDataFrame([(1,)], "v int")) == 2
    assert rows(one.read()) == [("1",), ("x",)]


def test_census_and_sketches(spark):
    df = spark.createDataFrame([(1, "a" * 200, None, [1]), (2, "a" * 200, 0.5, [1]), (3, "b", 0.5, None), (4, None, -1.0, [2])], "k long, s string, x double, l array<int>")
    got = {r.field: r for r in quality.census({"t": df, "none": df.limit(0)}).filter("tab = 't'").collect()}
    assert {f: (r.n, r.filled, r.kinds, r.low, r.high) for f, r in got.items()} == {"k": (4, 4, 4, 1.0, 4.0), "s": (4, 3, 2, None, None), "x": (4, 3, 2, -1.0, 0.5), "l": (4, 3, 2, None, None)}
    assert got["s"].least == "a" * 200 and got["s"].most == "b"
    assert {(r.field, r.n, r.kinds) for r in quality.census({"none": df.limit(0)}).collect()} == {(c, 0, 0) for c in df.columns}
    parts = quality.sketches(df.filter("k < 3")).unionByName(quality.sketches(df.filter("k >= 3")))
    assert {r.field: (r.n, r.filled, r.kinds) for r in quality.merged_sketches(parts).collect()} == {"k": (4, 4, 4), "s": (4, 3, 2), "x": (4, 3, 2), "l": (4, 3, 2)}


def at(m):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


@pytest.mark.parametrize("bucket", [60_000_000, intervals.DAY])
@pytest.mark.parametrize("longest", [None, 7])
def test_missing_time(spark, bucket, longest):
    covered = [("a", 5, 10), ("a", 8, 20), ("a", 20, 22), ("a", 40, 200), ("b", -50, 3), ("b", 30, 30), ("b", 35, 31), ("c", 0, 60), (None, 10, 20), ("z", 0, 9), ("a", 50, None)]
    wanted = [("a", 0, 60), ("b", 0, 60), ("c", 0, 60), (None, 0, 30), ("d", 10, 12), ("a", 55, 90)]
    frame = lambda r: spark.createDataFrame([(k, at(s), None if e is None else at(e)) for k, s, e in r], "k string, s timestamp, e timestamp")
    want = []
    for key in {k for k, _, _ in wanted}:
        asked = {m for k, s, e in wanted if k == key for m in range(s, e)}
        free = sorted(asked - {m for k, s, e in covered if k == key and e is not None for m in range(s, e)})
        runs = [[m] for m in free[:1]]
        for m in free[1:]:
            runs[-1].append(m) if m == runs[-1][-1] + 1 else runs.append([m])
        for run in runs:
            step = longest or len(run)
            want += [(key, at(run[i]), at(run[min(i + step, len(run)) - 1] + 1)) for i in range(0, len(run), step)]
    found = intervals.missing(frame(wanted), frame(covered), ["k"], "s", "e", longest and longest * 60_000_000, bucket)
    assert rows(found.select("k", F.col("s").cast("timestamp_ntz"), F.col("e").cast("timestamp_ntz"))) == sorted(want, key=repr)
    united = intervals.union(frame(covered), ["k"], "s", "e", bucket)
    assert united.filter("k = 'a'").count() == 2
