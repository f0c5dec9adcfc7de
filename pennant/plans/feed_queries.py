"""Registered queries of the provider feeds: nested documents made from the driver's tables, flattened again, against twins that read the tables directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.operators.sets import stacked
from pennant.plans.registry import Tables, query
from pennant.sources import readers, sinks
from pennant.streaming import snapshots


def document(df: DataFrame, by: Column, name: str, *fields: Column) -> DataFrame:
    """A JSON document for each value of `by`, with an array of the rows' fields under `name`; null fields are left out of it."""
    return df.groupBy(by.alias("doc")).agg(F.to_json(F.struct(F.collect_list(F.struct(*fields)).alias(name))).alias("body"))


def sql(expression: str, name: str) -> Column:
    return F.expr(expression).alias(name)


@query("""SELECT n_regionkey % 2 AS doc, concat('d', n_regionkey) AS entry, concat('Division ', n_regionkey) AS div_name, n_nationkey::BIGINT AS team_id, n_name AS name FROM nation""")
def src_standings(t: Tables) -> DataFrame:
    """SRC-21b: a map of divisions, each with its teams."""
    teams = t.nation.groupBy("n_regionkey").agg(F.collect_list(F.struct(sql("n_nationkey", "team_id"), sql("n_name", "name"))).alias("teams"))
    entry = F.struct(F.concat(F.lit("d"), "n_regionkey"), F.struct(sql("concat('Division ', n_regionkey)", "div_name"), F.col("teams")))
    docs = teams.groupBy((F.col("n_regionkey") % 2).alias("doc")).agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("divisions"))).alias("body"))
    schema = "struct<divisions:map<string,struct<div_name:string,teams:array<struct<team_id:bigint,name:string>>>>>"
    return readers.flatten_groups(docs, "body", schema, "divisions", "teams", {"div_name": "div_name"}, {"team_id": "team_id", "name": "name"}, ["doc"])


@query("""SELECT o_orderstatus AS doc, o_custkey % 7 AS category, o_orderkey AS person_id, o_totalprice AS value FROM orders""")
def src_leaders(t: Tables) -> DataFrame:
    """SRC-21n: a list of categories, each with its leaders."""
    leaders = t.orders.groupBy("o_orderstatus", sql("o_custkey % 7", "category")).agg(F.collect_list(F.struct(sql("o_totalprice", "value"), F.struct(sql("o_orderkey", "id")).alias("person"))).alias("leaders"))
    docs = document(leaders, F.col("o_orderstatus"), "leagueLeaders", F.col("category"), F.col("leaders"))
    schema = "struct<leagueLeaders:array<struct<category:bigint,leaders:array<struct<value:double,person:struct<id:bigint>>>>>>"
    return readers.flatten_groups(docs, "body", schema, "leagueLeaders", "leaders", {"category": "category"}, {"person_id": "person.id", "value": "value"}, ["doc"])


@query("""SELECT n_regionkey AS team_id, n_nationkey::BIGINT AS person_id, n_name AS full_name, CASE WHEN n_nationkey % 4 > 0 THEN concat('P', n_nationkey % 4) END AS position_code, 'Active' AS status FROM nation""")
def src_rosters(t: Tables) -> DataFrame:
    """SRC-21c: nested person, position and status; what a row lacks is null."""
    docs = document(
        t.nation, F.col("n_regionkey"), "roster", F.struct(sql("n_nationkey", "id"), sql("n_name", "fullName")).alias("person"),
        F.struct(sql("case when n_nationkey % 4 > 0 then concat('P', n_nationkey % 4) end", "code")).alias("position"), F.struct(F.lit("Active").alias("description")).alias("status"),
    )
    schema = "struct<roster:array<struct<person:struct<id:bigint,fullName:string>,position:struct<code:string>,status:struct<description:string>>>>"
    fields = {"person_id": "person.id", "full_name": "person.fullName", "position_code": "position.code", "status": "status.description"}
    return readers.flatten(docs, "body", schema, "roster", fields, ["doc"]).drop("_position").withColumnRenamed("doc", "team_id")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey % 30 END AS from_team, o_orderkey % 30 AS to_team FROM orders""")
def src_transactions(t: Tables) -> DataFrame:
    """SRC-21d: moves from and to a team, where the first may be absent."""
    docs = document(t.orders, F.col("o_custkey"), "transactions", sql("o_orderkey", "id"), sql("case when o_orderkey % 3 > 0 then named_struct('id', o_custkey % 30) end", "fromTeam"), F.struct(sql("o_orderkey % 30", "id")).alias("toTeam"))
    schema = "struct<transactions:array<struct<id:bigint,fromTeam:struct<id:bigint>,toTeam:struct<id:bigint>>>>"
    return readers.flatten(docs, "body", schema, "transactions", {"id": "id", "from_team": "fromTeam.id", "to_team": "toTeam.id"}, []).drop("_position")


@query("""SELECT o_orderkey AS game_id, concat('T', o_custkey) AS losing_team, concat('["A', o_orderkey % 5, '","B"]') AS broadcasts FROM orders""")
def src_schedule(t: Tables) -> DataFrame:
    """SRC-21a: a key under another name, and a list column kept as JSON text."""
    docs = document(t.orders, F.col("o_custkey"), "games", sql("o_orderkey", "game_id"), sql("concat('T', o_custkey)", "losing_Team"), sql("array(concat('A', o_orderkey % 5), 'B')", "broadcasts"))
    schema = "struct<games:array<struct<game_id:bigint,losing_Team:string,broadcasts:array<string>>>>"
    rows = readers.flatten(docs, "body", schema, "games", {"game_id": "game_id", "losing_team": "losing_Team", "broadcasts": "broadcasts"}, [])
    return rows.select("game_id", "losing_team", F.to_json("broadcasts").alias("broadcasts"))


@query("""SELECT job, n_nationkey::BIGINT AS person_id, n_name AS full_name FROM nation JOIN (VALUES (0, 'scorer'), (1, 'umpire'), (2, 'datacaster')) j(k, job) ON n_nationkey % 3 = k""")
def src_jobs(t: Tables) -> DataFrame:
    """SRC-21o, SRC-11: rosters of several jobs, one shape and one function for all."""
    parts = []
    for k, job in enumerate(("scorer", "umpire", "datacaster")):
        docs = document(t.nation.filter(f"n_nationkey % 3 = {k}"), F.lit(job), "roster", F.struct(sql("n_nationkey", "id"), sql("n_name", "fullName")).alias("person"))
        schema = "struct<roster:array<struct<person:struct<id:bigint,fullName:string>>>>"
        parts.append(readers.flatten(docs, "body", schema, "roster", {"person_id": "person.id", "full_name": "person.fullName"}, ["doc"]).drop("_position"))
    return stacked(parts).withColumnRenamed("doc", "job")


@query("""SELECT o_orderkey AS id, 'hitting' AS stat_group, concat('', o_custkey) AS at_bats, CASE WHEN o_orderkey % 2 = 0 THEN concat('', o_orderkey % 9) END AS home_runs, NULL::VARCHAR AS innings_pitched FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, 'pitching', NULL, NULL, concat('', o_custkey % 9, '.1') FROM orders WHERE o_orderstatus = 'O'""")
def src_season_stats(t: Tables) -> DataFrame:
    """SRC-21m: maps of statistics as columns, groups with different ones stacked."""
    hitting = t.orders.filter("o_orderstatus = 'F'").select(sql("o_orderkey", "id"), F.lit("hitting").alias("stat_group"), sql("to_json(named_struct('atBats', o_custkey, 'homeRuns', case when o_orderkey % 2 = 0 then o_orderkey % 9 end))", "stat"))
    pitching = t.orders.filter("o_orderstatus = 'O'").select(sql("o_orderkey", "id"), F.lit("pitching").alias("stat_group"), sql("to_json(named_struct('inningsPitched', concat(o_custkey % 9, '.1')))", "stat"))
    groups = [readers.stat_columns(g, "stat", ["id", "stat_group"], readers.stat_names(g, "stat")) for g in (hitting, pitching)]
    return groups[0].unionByName(groups[1], allowMissingColumns=True)


@query("""SELECT n_nationkey AS scope FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_custkey % 3 = 0) AND n_nationkey IN (SELECT s_nationkey FROM supplier)""")
def src_complete(t: Tables) -> DataFrame:
    """SRC-18: a scope is done only where every table has it."""
    tables = {"nation": t.nation.select(sql("n_nationkey", "scope")), "customer": t.customer.filter("c_custkey % 3 = 0").select(sql("c_nationkey", "scope")), "supplier": t.supplier.select(sql("s_nationkey", "scope"))}
    return readers.complete_scopes(tables, "scope")


@query("""WITH b AS (SELECT event_type AS dataset, user_id % 10 AS scope FROM events WHERE event_type IN ('view', 'click') AND user_id % 10 < 4),
l AS (SELECT 'view' AS dataset, n_nationkey::BIGINT AS scope, -1::BIGINT AS n FROM nation WHERE n_nationkey < 10), n AS (SELECT dataset, scope::BIGINT AS scope, count(*) AS n FROM b GROUP BY 1, 2)
SELECT * FROM n UNION ALL SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.dataset = l.dataset AND n.scope = l.scope)""")
def src_ledger(t: Tables) -> DataFrame:
    """SRC-24: documents of two datasets from one stream, and the ledger of the scopes that they load."""
    parts = readers.split_datasets(t.events.filter("user_id % 10 < 4"), "event_type", ["view", "click"])
    batch = stacked(list(parts.values())).select(sql("event_type", "dataset"), sql("cast(user_id % 10 as bigint)", "scope"))
    ledger = t.nation.filter("n_nationkey < 10").select(F.lit("view").alias("dataset"), sql("cast(n_nationkey as bigint)", "scope"), sql("-1L", "n"))
    return sinks.record_loads(ledger, batch, ["dataset", "scope"])


@query("SELECT n_nationkey, n_name FROM nation")
def src_artifact(t: Tables) -> DataFrame:
    """SRC-22: gzip NDJSON written with its digests and replayed after they are checked."""
    path = snapshots.scratch(t.spark, "artifact")
    digests = sinks.write_artifact(t.nation.select("n_nationkey", "n_name").repartition(3, "n_nationkey"), path)
    return readers.verified_ndjson(t.spark, f"{path}/*.json.gz", {r["name"]: r["digest"] for r in digests.collect()}, "n_nationkey int, n_name string")


@query("""SELECT CASE WHEN n_nationkey % 3 = 1 THEN concat('g', n_nationkey) ELSE sha256(concat('http://x/', n_nationkey)) END AS key, n_name AS title FROM nation WHERE n_nationkey % 3 < 2""")
def src_feed_items(t: Tables) -> DataFrame:
    """SRC-16: items of a feed under their guid, else the digest of their link; those with neither are left out."""
    path = snapshots.scratch(t.spark, "feed")
    item = "concat('<item>', case when n_nationkey % 3 = 1 then concat('<guid>g', n_nationkey, '</guid>') else '' end, '<title>', n_name, '</title>', case when n_nationkey % 3 < 2 then concat('<link>http://x/', n_nationkey, '</link>') else '<link/>' end, '</item>')"
    t.nation.agg(sql(f"concat('<rss><channel>', concat_ws('', collect_list({item})), '</channel></rss>')", "value")).write.text(path)
    return readers.feed_items(t.spark, path).select("key", "title")


@query("""SELECT concat('G', n_regionkey) AS game_id, 'batting' AS list, concat('b', n_nationkey) AS id, n_nationkey % 5 AS n FROM nation UNION ALL SELECT concat('G', n_regionkey), 'pitching', concat('p', n_nationkey), n_nationkey % 3 FROM nation""")
def src_box_lists(t: Tables) -> DataFrame:
    """SRC-05: each list of a box score in XML as a table of its own."""
    path = snapshots.scratch(t.spark, "box")
    one = lambda tag, p, n: f"concat_ws('', collect_list(concat('<{tag} id=\"{p}', n_nationkey, '\" n=\"', n_nationkey % {n}, '\"></{tag}>')))"
    text = f"concat('<boxscore game_id=\"G', n_regionkey, '\"><batting>', {one('player', 'b', 5)}, '</batting><pitching>', {one('player', 'p', 3)}, '</pitching></boxscore>')"
    games = t.nation.groupBy("n_regionkey").agg(sql(text, "game"))
    games.agg(sql("concat('<games>', concat_ws('', collect_list(game)), '</games>')", "value")).write.text(path)
    tables = readers.xml_lists(t.spark, path, "boxscore", {"batting.player": "id:string,n:int", "pitching.player": "id:string,n:int"}, {"game_id": "string"})
    return stacked([df.select("game_id", F.lit(name).alias("list"), "id", "n") for name, df in tables.items()])


def in_batches(rows: DataFrame, key: str, size: int, path: str, *columns: Column) -> DataFrame:
    """Documents of at most `size` elements each, as a provider answers batches of ids."""
    return document(rows, F.floor(F.col(key) / size), path, *columns)


@query("""SELECT s_suppkey AS id, s_name AS name, concat('city', s_nationkey) AS location_city, s_nationkey::BIGINT AS location_nation, CASE WHEN s_suppkey % 3 > 0 THEN (300.0 + s_suppkey % 50)::DOUBLE END AS field_info_left_line,
CASE WHEN s_suppkey % 2 = 0 THEN 'Grass' END AS field_info_turf_type, concat('tz', s_nationkey % 4) AS time_zone_id FROM supplier""")
def src_venues(t: Tables) -> DataFrame:
    """SRC-21e: a catalog of places asked for in batches of ids, with nested location, field and time zone."""
    docs = in_batches(
        t.supplier, "s_suppkey", 25, "venues", sql("s_suppkey", "id"), sql("s_name", "name"), F.struct(sql("concat('city', s_nationkey)", "city"), sql("s_nationkey", "nation")).alias("location"),
        F.struct(sql("case when s_suppkey % 3 > 0 then cast(300.0 + s_suppkey % 50 as double) end", "leftLine"), sql("case when s_suppkey % 2 = 0 then 'Grass' end", "turfType")).alias("fieldInfo"), F.struct(sql("concat('tz', s_nationkey % 4)", "id")).alias("timeZone"),
    )
    schema = "struct<venues:array<struct<id:bigint,name:string,location:struct<city:string,nation:bigint>,fieldInfo:struct<leftLine:double,turfType:string>,timeZone:struct<id:string>>>>"
    fields = {"id": "id", "name": "name", "location_city": "location.city", "location_nation": "location.nation", "field_info_left_line": "fieldInfo.leftLine", "field_info_turf_type": "fieldInfo.turfType", "time_zone_id": "timeZone.id"}
    return readers.flatten(docs, "body", schema, "venues", fields, []).drop("_position")


@query("""SELECT c_custkey AS id, c_name AS full_name, CASE WHEN c_custkey % 5 > 0 THEN (DATE '1980-01-01' + (c_custkey % 9000)::INT)::VARCHAR END AS birth_date, CASE c_custkey % 3 WHEN 0 THEN 'L' WHEN 1 THEN 'R' END AS bat_side, c_custkey IN (SELECT o_custkey FROM orders) AS active
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def src_people(t: Tables) -> DataFrame:
    """SRC-21g: biographies of the distinct persons that another table names, asked for in batches."""
    wanted = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    docs = in_batches(
        t.customer.join(wanted, "c_custkey", "left_semi"), "c_custkey", 50, "people", sql("c_custkey", "id"), sql("c_name", "fullName"), sql("case when c_custkey % 5 > 0 then cast(date_add(date'1980-01-01', cast(c_custkey % 9000 as int)) as string) end", "birthDate"),
        F.struct(sql("case c_custkey % 3 when 0 then 'L' when 1 then 'R' end", "code")).alias("batSide"), F.lit(True).alias("active"),
    )
    schema = "struct<people:array<struct<id:bigint,fullName:string,birthDate:string,batSide:struct<code:string>,active:boolean>>>"
    return readers.flatten(docs, "body", schema, "people", {"id": "id", "full_name": "fullName", "birth_date": "birthDate", "bat_side": "batSide.code", "active": "active"}, []).drop("_position")


@query("""SELECT DISTINCT c_nationkey::BIGINT AS team_id, year(o_orderdate)::BIGINT AS season, concat('name', c_nationkey, '-', year(o_orderdate)) AS name, concat('v', c_nationkey % 7) AS venue_name FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey % 6 <> 5""")
def src_team_history(t: Tables) -> DataFrame:
    """SRC-21f: the seasons of every distinct team of the rosters, one document a team; a team's rows replace those that were there, and a team without an answer keeps none."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", F.year("o_orderdate").alias("season")).distinct()
    docs = document(rows, F.col("c_nationkey"), "teams", sql("c_nationkey", "id"), sql("season", "season"), sql("concat('name', c_nationkey, '-', season)", "name"), F.struct(sql("concat('v', c_nationkey % 7)", "name")).alias("venue"))
    schema = "struct<teams:array<struct<id:bigint,season:bigint,name:string,venue:struct<name:string>>>>"
    found = readers.flatten(docs.filter("doc % 6 <> 5"), "body", schema, "teams", {"team_id": "id", "season": "season", "name": "name", "venue_name": "venue.name"}, []).drop("_position")
    stale = found.select("team_id", "season", F.lit("stale").alias("name"), "venue_name").unionByName(t.nation.select(F.col("n_nationkey").cast("long").alias("team_id"), F.lit(1900).cast("long").alias("season"), F.lit("stale").alias("name"), F.lit(None).cast("string").alias("venue_name")))
    return sinks.scoped_replace(stale, found, "team_id", list(range(25)))


@query("""SELECT c_nationkey::BIGINT AS team_id, year(o_orderdate)::BIGINT AS season, count(*) AS openings_total, sum(o_custkey)::BIGINT AS attendance_total, max(o_custkey)::BIGINT AS attendance_high, CASE WHEN c_nationkey % 4 > 0 THEN concat('R', c_nationkey) END AS game_type_id
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def src_attendance(t: Tables) -> DataFrame:
    """SRC-21k: yearly records of each team, one document a team, with scalar fields and a nested type that may be absent."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", F.year("o_orderdate").alias("season")).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("total"), F.max("o_custkey").alias("high"))
    docs = document(rows, F.col("c_nationkey"), "records", sql("season", "year"), sql("n", "openingsTotal"), sql("total", "attendanceTotal"), sql("high", "attendanceHigh"), sql("case when c_nationkey % 4 > 0 then named_struct('id', concat('R', c_nationkey)) end", "gameType"))
    schema = "struct<records:array<struct<year:bigint,openingsTotal:bigint,attendanceTotal:bigint,attendanceHigh:bigint,gameType:struct<id:string>>>>"
    fields = {"season": "year", "openings_total": "openingsTotal", "attendance_total": "attendanceTotal", "attendance_high": "attendanceHigh", "game_type_id": "gameType.id"}
    return readers.flatten(docs, "body", schema, "records", fields, ["doc"]).drop("_position").withColumn("team_id", F.col("doc").cast("long")).drop("doc")


#: Attributes of the box scores made here, by table.
BOX = {
    "game": ("game_id", "date"), "linescore": ("away_runs", "home_runs"), "batting": ("ab", "h"), "fielding": ("pos", "po"), "pitching": ("id", "so"),
    **{one: ("players",) for one in readers.BOX_LISTS.values()},
}


@query("""WITH l AS (SELECT *, concat('G', l_orderkey) AS game_id, CASE WHEN l_linenumber % 2 = 0 THEN '0' ELSE '1' END AS team FROM lineitem)
SELECT 'game' AS tab, concat('G', o_orderkey) AS game_id, NULL AS team, strftime(o_orderdate, '%Y/%m/%d') AS a, (o_custkey % 9)::VARCHAR AS b FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'batting', game_id, team, (l_quantity::BIGINT % 6)::VARCHAR, (l_partkey % 4)::VARCHAR FROM l
UNION ALL SELECT 'fielding', game_id, team, (l_suppkey % 9 + 1)::VARCHAR, '1' FROM l UNION ALL SELECT 'fielding', game_id, team, '3', NULL FROM l WHERE l_partkey % 5 = 0
UNION ALL SELECT 'pitching', game_id, team, concat('p&', l_suppkey), (l_partkey % 7)::VARCHAR FROM l WHERE l_linenumber <= 2
UNION ALL SELECT 'doubleplay', game_id, NULL, concat('a', l_partkey, ' b'), NULL FROM l WHERE l_partkey % 3 = 0 UNION ALL SELECT 'homerun', game_id, NULL, concat('c', l_partkey), NULL FROM l WHERE l_partkey % 4 = 1""")
def src_box_score(t: Tables) -> DataFrame:
    """SRC-05: box scores in XML, one a game and many to a file, as tables of games, batting, fielding, pitching and lists."""
    path = snapshots.scratch(t.spark, "box")
    x = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber % 2 = 1 as home", "l_linenumber <= 2 as pitches",
        "concat('<player id=\"b', l_linenumber, '\" lname=\"O&apos;B\"><batting ab=\"', cast(l_quantity as bigint) % 6, '\" h=\"', l_partkey % 4, '\"/><fielding pos=\"', l_suppkey % 9 + 1, '\" po=\"1\"/>', case when l_partkey % 5 = 0 then '<fielding pos=\"3\"/>' else '' end, '</player>') as player",
        "concat('<pitcher id=\"p&', l_suppkey, '\" so=\"', l_partkey % 7, '\"/>') as pitcher", "case when l_partkey % 3 = 0 then concat('<doubleplay players=\"a', l_partkey, ' b\"/>') else '' end as dp", "case when l_partkey % 4 = 1 then concat('<homerun players=\"c', l_partkey, '\"/>') else '' end as hr",
    )
    side = lambda tag, value, who, only="true": f"concat('<{tag} team=\"{who}\">', concat_ws('', collect_list(case when {'home' if who else 'not home'} and {only} then {value} end)), '</{tag}>')"
    body = ", ".join([side("players", "player", 0), side("players", "player", 1), side("pitching", "pitcher", 0, "pitches"), side("pitching", "pitcher", 1, "pitches"), "'<doubleplays>', concat_ws('', collect_list(dp)), '</doubleplays><homeruns>', concat_ws('', collect_list(hr)), '</homeruns></boxscore>'"])
    games = x.groupBy("l_orderkey").agg(sql(f"concat({body})", "body")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    games.selectExpr("concat('<boxscore game_id=\"G', o_orderkey, '\" date=\"', date_format(o_orderdate, 'yyyy/MM/dd'), '\"><linescore away_runs=\"', o_custkey % 9, '\" home_runs=\"1\"/>', body) as value").write.text(path)
    found = readers.box_tables(t.spark.read.text(path), "value", BOX, keep=lambda rows: snapshots.kept(rows, "boxes"))
    none = F.lit(None).cast("string")
    parts = [("game", none, "date", "linescore_away_runs"), ("batting", F.col("team"), "ab", "h"), ("fielding", F.col("team"), "pos", "po"), ("pitching", F.col("team"), "id", "so"), ("doubleplay", none, "players", None), ("homerun", none, "players", None)]
    return stacked([found[n].select(F.lit(n).alias("tab"), "game_id", team.alias("team"), F.col(a).alias("a"), (F.col(b) if b else none).alias("b")) for n, team, a, b in parts])
