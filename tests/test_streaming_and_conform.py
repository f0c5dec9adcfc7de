from pyspark.sql import functions as F

from pennant.operators import windows
from pennant.plans import conform, reports
from pennant.sources import sinks
from pennant.streaming import snapshots


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_changes_stream_is_its_batch_twin(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    events.orderBy("ts").coalesce(1).write.parquet(src)
    stream = snapshots.changes(snapshots.read(spark, src, events.schema), ["user_id"], "ts", "event_type")
    snapshots.append(stream, out, str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(windows.changes(events, ["user_id"], ["ts"], "event_type"))


def test_first_wins_and_latest(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:05:00", "b"), (2, "2024-01-01 00:01:00", "c")], "k int, at string, v string").withColumn("at", F.col("at").cast("timestamp"))
    src = str(tmp_path / "src")
    df.coalesce(1).write.parquet(src)
    stream = snapshots.first_wins(snapshots.read(spark, src, df.schema), ["k"], "at")
    snapshots.append(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "k") == [(1,), (2,)]
    assert rows(snapshots.latest(df, ["k"], "at", ["v"]), "k", "v") == [(1, "b"), (2, "c")]


def test_late_corrections_replace_their_scope(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "t")
    schema = "season string, v int"
    for k, part in enumerate(([("2023", 1), ("2024", 2)], [("2024", 5), ("2024", 6)])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = snapshots.read(spark, src, spark.createDataFrame([], schema).schema, 1)
        snapshots.replace_scopes(stream, table, str(tmp_path / "cp"), "season").awaitTermination()
    assert rows(sinks.read_version(spark, table)) == [("2023", 1), ("2024", 5), ("2024", 6)]


def test_teams_and_era_choice(spark):
    schema = "team_code string, first_year string, last_year string"
    teams = conform.teams(spark.createDataFrame([("ATL", "1966", "2024"), ("MIL", "1953", "1965")], schema), spark.createDataFrame([("ATL", "1900", "1901"), ("NEW", "2024", "2024")], schema))
    assert rows(teams, "team_code", "last_year") == [("ATL", 9999), ("MIL", 1965), ("NEW", 9999)]
    facts = spark.createDataFrame([(1, "ATL", 2030), (2, "MIL", 1970)], "k int, code string, season int")
    found = {r.k: r.team_id is not None for r in conform.in_era(facts, teams, "code", "season", ["k"]).collect()}
    assert found == {1: True, 2: False}


def test_backfill_claims_only_unambiguous_rows(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "b", 7), (4, "z", 9)], "l int, name string, score int")
    right = spark.createDataFrame([(10, "a", 0), (11, "b", 6), (12, "c", 7), (13, "d", 9), (14, "e", 9)], "r int, name string, score int")
    got = {x.l: (x.r, x.matched_by) for x in conform.backfill(left, right, [["name"], ["score"]], "l", "r").collect()}
    assert got == {1: (10, "name"), 2: (11, "score"), 3: (12, "score"), 4: (None, None)}


def test_majority_ids_are_bridged(spark):
    df = spark.createDataFrame([("T", 2020, 5), ("T", 2020, 5), ("T", 2020, 6), ("T", 2021, None), ("U", 2020, 7), ("U", 2020, 8)], "team string, season int, cand int")
    assert rows(conform.team_ids(df, "team", "cand", "season")) == [("T", 2020, 5, False), ("T", 2021, 5, True), ("U", 2020, 7, False)]


def test_markets(spark):
    schedule = spark.createDataFrame([(1, "d", "A", "B"), (2, "d", "C", "D"), (3, "e", "A", "B"), (4, "e", "A", "B")], "game int, day string, away string, home string")
    markets = spark.createDataFrame([("m1", "d", "A", "B"), ("m2", "d", None, "D"), ("m3", "e", "A", "B")], "ref string, day string, away string, home string")
    got = {r.ref: (r.game, r.matched_by) for r in conform.market_links(markets, schedule, ["day", "away", "home"], ["day", "home"]).collect()}
    assert got == {"m1": (1, "exact"), "m2": (2, "fuzzy"), "m3": (None, None)}


def test_standings_and_instances(spark):
    raw = spark.createDataFrame([(1, "2024", "10", "5", "1", "-"), (2, "2024", "9", "6", "-", "1.0")], "team_id int, season string, wins string, losses string, rank string, games_back string")
    got = {r.team_id: r for r in conform.standings(raw).collect()}
    assert (got[1].games_back, got[1].rank, got[2].rank) == (0.0, 1, None)
    teams = spark.createDataFrame([(1, "A", "Cats", "E"), (2, "B", None, "E")], "id int, city string, nickname string, division string")
    table = {r.team_id: r for r in reports.division_standing(conform.standings(raw), teams).collect()}
    assert table[2].name == "B" and abs(table[1].win_pct - 2 / 3) < 1e-9
    keys = conform.instances(spark.createDataFrame([(1, 77, "R"), (2, None, "R"), (3, None, None)], "id int, game_pk int, retro_game_id string"))
    assert [r.instance_key for r in keys.orderBy("id").collect()] == ["mlb:77", "retro:R", "legacy-feature:3"]


def test_optional_source(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    assert conform.optional(lambda: spark.read.parquet(str(tmp_path / "none")), empty) is empty


def test_nothing_final_asks_for_no_state(spark):
    """Keys without final rows cost no frame and no call on the state."""
    schema = spark.createDataFrame([], "k long, at timestamp, v string").schema
    changes = snapshots._Changes(schema, "at", [], "v", None, True)
    assert list(changes._changed([], 0)) == []


def test_eras_are_looked_up_once_for_each_team_and_season(spark):
    """A register that repeats an era many times makes no pair of each of them with each of the team's rows."""
    eras = spark.range(500).selectExpr("'A' as team_code", "1990 as first_year", "cast(if(id % 2 = 0, 1999, 9999) as int) as last_year", "id + 7 as id")
    rows = spark.range(400).selectExpr("id as k", "case id % 4 when 0 then 'A' when 1 then 'B' when 2 then null else 'A' end as code", "cast(if(id % 8 = 7, null, 1995) as int) as season")
    out = conform.in_era(rows, eras, "code", "season", ["k"])
    got = {r.k: r.team_id for r in out.collect()}
    assert len(got) == 400 and all(got[k] == (7 if k % 4 == 0 or k % 8 == 3 else None) for k in got)
    assert max(_rows_of_joins(out)) <= 400


def _rows_of_joins(df):
    """Rows that each join of a frame that has run put out."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        if "QueryStage" in name:
            todo.append(node.plan())
        if name.endswith("Join"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found
