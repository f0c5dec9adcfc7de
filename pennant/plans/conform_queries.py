"""Registered queries of conformance and of the season reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.plans import conform, reports
from pennant.plans.fixtures import GAMES_SQL, PLAYS_SQL, games, plays
from pennant.plans.registry import Tables, query

#: Two registers of team eras: the second knows more codes and repeats some of the first.
ERA = {"team_code": "concat('T', s_suppkey % 25)", "first_year": "concat('', 1990 + s_suppkey % 4 * 3)", "last_year": "concat('', 1992 + s_suppkey % 4 * 3)", "nickname": "s_name"}


def _named(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {n}" for n, e in expressions.items()])


def _sql(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in expressions.items())


def eras(t: Tables) -> DataFrame:
    one = _named(t.supplier.filter("s_suppkey < 60"), ERA)
    more = _named(t.supplier.filter("s_suppkey >= 60"), ERA | {"team_code": "concat('T', s_suppkey % 28)"})
    return conform.teams(one, more)


ERAS_SQL = f"""one AS (SELECT {_sql(ERA)} FROM supplier WHERE s_suppkey < 60), more AS (SELECT {_sql(ERA | {'team_code': "concat('T', s_suppkey % 28)"})} FROM supplier WHERE s_suppkey >= 60),
raw AS (SELECT * FROM one UNION ALL SELECT * FROM more WHERE team_code NOT IN (SELECT team_code FROM one)),
eras AS (SELECT team_code, first_year::INT AS first_year, CASE WHEN last_year::INT = max(last_year::INT) OVER () THEN 9999 ELSE last_year::INT END AS last_year, nickname FROM raw)"""


@query(f"WITH {ERAS_SQL} SELECT * FROM eras")
def cnf_teams(t: Tables) -> DataFrame:
    """CNF-01: primary register, what only the supplement has, latest eras open."""
    return eras(t).select("team_code", "first_year", "last_year", "nickname")


REGISTER = {
    "key_retro": "case when c_custkey % 9 = 0 then '' else concat('r', c_custkey % 1200) end", "key_mlbam": "concat('', c_custkey + 100000)", "key_bbref": "concat('b', c_custkey)", "key_fangraphs": "''", "key_uuid": "concat('u', 100000 + c_custkey)",
    "name_first": "c_mktsegment", "name_last": "c_name", "birth_year": "case when c_custkey % 5 = 0 then '' else concat('', 1950 + c_custkey % 40) end", "birth_month": "concat('', c_custkey % 14)", "birth_day": "concat('', 1 + c_custkey % 28)",
    "death_year": "''", "death_month": "''", "death_day": "''",
}
PLAYERS_SQL = f"""reg AS (SELECT {_sql(REGISTER)} FROM customer), players AS (SELECT key_retro, key_mlbam, key_bbref, name_last,
  CASE WHEN birth_year <> '' AND birth_month::INT BETWEEN 1 AND 12 THEN make_date(birth_year::INT, birth_month::INT, birth_day::INT) END AS birth_date
  FROM reg WHERE key_retro <> '' QUALIFY row_number() OVER (PARTITION BY key_retro ORDER BY key_uuid NULLS LAST) = 1)"""


@query(f"WITH {PLAYERS_SQL} SELECT * FROM players")
def cnf_players(t: Tables) -> DataFrame:
    """CNF-02, FLT-09: register rows with a retro id, one for each, dates only where all parts make one."""
    return conform.players(_named(t.customer, REGISTER)).select("key_retro", "key_mlbam", "key_bbref", "name_last", "birth_date")


@query(f"WITH {PLAYERS_SQL} SELECT key_retro, key_mlbam, name_last FROM players WHERE key_bbref = 'b77' OR key_mlbam = 'b77' OR key_retro = 'b77'")
def cnf_find_player(t: Tables) -> DataFrame:
    """CNF-13: a player by any of five id systems."""
    return conform.find_player(conform.players(_named(t.customer, REGISTER)), "b77").select("key_retro", "key_mlbam", "name_last")


PARK = {"park": "p_partkey", "name": "concat(upper(p_name), ' ')", "start": "case when p_partkey % 3 = 0 then '04/15/1990' when p_partkey % 3 = 1 then '1990' else '' end", "end": "'10/01/2005'"}
CATALOG = {"venue_id": "p_partkey + 5000", "name": "concat(' ', p_name, case when p_partkey % 2 = 0 then '' else ' field' end)", "season": "case when p_partkey % 7 = 0 then null else 2000 + p_partkey % 5 end"}


@query(f"""WITH k AS (SELECT {_sql(PARK | {'"end"': "'10/01/2005'"}).replace("'10/01/2005' AS end, ", '')} FROM part WHERE p_partkey < 300), c AS (SELECT {_sql(CATALOG)} FROM part),
b AS (SELECT lower(trim(name)) AS k, venue_id FROM c QUALIFY row_number() OVER (PARTITION BY lower(trim(name)) ORDER BY season DESC NULLS LAST, venue_id NULLS LAST) = 1)
SELECT park, CASE WHEN start LIKE '__/__/____' THEN 1990 END AS first_year, 2005 AS last_year, b.venue_id AS mlb_venue_id FROM k LEFT JOIN b ON lower(trim(k.name)) = b.k""")
def cnf_venues(t: Tables) -> DataFrame:
    """CNF-03, FLT-10: parks with the latest catalog row of the same name."""
    parks = t.part.filter("p_partkey < 300").selectExpr(*[f"{e} as `{n}`" for n, e in PARK.items()])
    return conform.venues(parks, _named(t.part, CATALOG)).select("park", "first_year", "last_year", "mlb_venue_id")


SOURCE = {
    "game": "o_orderkey", "season": "year(o_orderdate)", "attendance": "case o_orderkey % 4 when 0 then concat('', o_custkey, '.0') when 1 then concat('', o_custkey, '?') when 2 then '<1000' else '-1.0' end",
    "temp": "concat('', o_orderkey % 100)", "sky": "case when o_orderkey % 3 = 0 then 'Unknown' else 'sunny' end", "game_type": "case when o_orderkey % 2 = 0 then 'Regular' else 'REGULAR' end",
}


@query(f"""WITH a AS (SELECT {_sql(SOURCE)}, 'a' AS source FROM orders WHERE year(o_orderdate) < 1998), b AS (SELECT {_sql(SOURCE)}, 'b' AS source FROM orders WHERE o_orderkey % 5 = 0 AND year(o_orderdate) NOT IN (SELECT season FROM a)),
x AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT game, season, CASE WHEN regexp_matches(attendance, '^[0-9]+(\\.[0-9]+)?$') THEN attendance::DOUBLE::BIGINT END AS attendance, temp::BIGINT AS temp,
  CASE WHEN lower(sky) <> 'unknown' THEN sky END AS sky, lower(game_type) AS game_type, source FROM x""")
def cnf_games(t: Tables) -> DataFrame:
    """CNF-04, FLT-25: source A, and source B for the seasons that A lacks, with typed measures."""
    a, b = _named(t.orders.filter("year(o_orderdate) < 1998"), SOURCE), _named(t.orders.filter("o_orderkey % 5 = 0"), SOURCE)
    return conform.games(a, b).select("game", "season", "attendance", "temp", "sky", "game_type", "source")


@query(f"""WITH {ERAS_SQL}, r AS (SELECT o_orderkey AS id, concat('T', o_custkey % 28) AS code, year(o_orderdate) AS season FROM orders WHERE o_orderpriority = '5-LOW')
SELECT r.id, r.code, max(e.first_year) AS first_year, count(e.first_year) > 0 AS found FROM r LEFT JOIN eras e ON e.team_code = r.code AND r.season BETWEEN e.first_year AND e.last_year GROUP BY ALL""")
def cnf_spring_games(t: Tables) -> DataFrame:
    """CNF-05: one era of each team that the season lies in."""
    rows = t.orders.filter("o_orderpriority = '5-LOW'").selectExpr("o_orderkey as id", "concat('T', o_custkey % 28) as code", "year(o_orderdate) as season")
    e = eras(t)
    found = conform.in_era(rows, e, "code", "season", ["id"]).join(F.broadcast(e.select(F.col("id").alias("team_id"), F.col("first_year")).distinct()), "team_id", "left")
    return found.select("id", "code", "first_year", F.col("team_id").isNotNull().alias("found"))


_A = {"a": "o_orderkey", "day": "cast(o_orderdate as date)", "team": "o_custkey % 40", "number": "o_orderkey % 2"}
_B = {"b": "o_orderkey + 1000000", "day": "cast(o_orderdate as date)", "team": "case when o_orderkey % 3 = 0 then null else o_custkey % 40 end", "number": "o_orderkey % 2"}


@query(f"""WITH a AS (SELECT {_sql(_A)} FROM orders WHERE o_orderkey % 4 <> 0), b AS (SELECT {_sql(_B)} FROM orders WHERE o_orderkey % 5 <> 0),
m1 AS (SELECT x.a, y.b FROM (SELECT day, team, number, min(a) AS a FROM a GROUP BY ALL HAVING count(DISTINCT a) = 1) x JOIN (SELECT day, team, number, min(b) AS b FROM b GROUP BY ALL HAVING count(DISTINCT b) = 1) y USING (day, team, number)),
m2 AS (SELECT x.a, y.b FROM (SELECT day, number, min(a) AS a FROM a WHERE a NOT IN (SELECT a FROM m1) GROUP BY ALL HAVING count(DISTINCT a) = 1) x
  JOIN (SELECT day, number, min(b) AS b FROM b WHERE b NOT IN (SELECT b FROM m1) GROUP BY ALL HAVING count(DISTINCT b) = 1) y USING (day, number)),
m AS (SELECT *, 'day+team+number' AS matched_by FROM m1 UNION ALL SELECT *, 'day+number' FROM m2) SELECT a.a, m.b, m.matched_by FROM a LEFT JOIN m USING (a)""")
def cnf_backfill(t: Tables) -> DataFrame:
    """CNF-06: keys of the other source, pass by pass, only where both sides have one row."""
    a, b = _named(t.orders.filter("o_orderkey % 4 <> 0"), _A), _named(t.orders.filter("o_orderkey % 5 <> 0"), _B)
    return conform.backfill(a, b, [["day", "team", "number"], ["day", "number"]], "a", "b").select("a", "b", "matched_by")


@query("""WITH r AS (SELECT o_custkey % 60 AS team, CASE WHEN year(o_orderdate) IN (1996, 1999) THEN NULL ELSE o_orderkey % 4 END AS candidate, year(o_orderdate) AS season FROM orders),
v AS (SELECT team, season, candidate FROM (SELECT team, season, candidate, count(*) AS n FROM r WHERE candidate IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY team, season ORDER BY n DESC, candidate) = 1),
near AS (SELECT team, season, min(c) AS near FROM (SELECT team, season - 1 AS season, candidate AS c FROM v UNION ALL SELECT team, season + 1, candidate FROM v) GROUP BY ALL HAVING count(DISTINCT c) = 1)
SELECT s.team, s.season, coalesce(v.candidate, near.near) AS candidate, v.candidate IS NULL AS bridged FROM (SELECT DISTINCT team, season FROM r) s LEFT JOIN v USING (team, season) LEFT JOIN near USING (team, season)""")
def cnf_team_ids(t: Tables) -> DataFrame:
    """CNF-07: majority vote, bridged from the season next to it."""
    rows = t.orders.selectExpr("o_custkey % 60 as team", "case when year(o_orderdate) in (1996, 1999) then null else o_orderkey % 4 end as candidate", "year(o_orderdate) as season")
    return conform.team_ids(rows, "team", "candidate", "season")


@query("""WITH x AS (SELECT 0 AS k, year(l_shipdate) AS season, l_orderkey AS game_id, l_linenumber AS play_index, l_quantity AS q, l_partkey AS p FROM lineitem WHERE l_orderkey % 2 = 0
  UNION ALL SELECT 1, year(l_shipdate), l_orderkey, l_linenumber, l_quantity, l_partkey FROM lineitem WHERE l_orderkey % 3 = 0)
SELECT season, game_id, play_index, q, p FROM x QUALIFY row_number() OVER (PARTITION BY season, game_id, play_index ORDER BY k, q, p) = 1""")
def cnf_plays(t: Tables) -> DataFrame:
    """CNF-08: plays of two archives, the first archive's where both have one."""
    rows = t.lineitem.selectExpr("year(l_shipdate) as season", "l_orderkey as game_id", "l_linenumber as play_index", "l_quantity as q", "l_partkey as p")
    return conform.plays([rows.filter("game_id % 2 = 0"), rows.filter("game_id % 3 = 0")])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey AS game FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) ON l_orderkey = o_orderkey")
def cnf_links(t: Tables) -> DataFrame:
    """CNF-09, CNF-10: facts with their game where it is known; the others stay."""
    known = t.orders.filter("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("game"))
    return conform.with_links(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), known, "l_orderkey", "game")


MARKET = {"market_ref": "concat('m', o_orderkey)", "day": "cast(o_orderdate as date)", "home": "case when o_orderkey % 4 = 0 then o_custkey % 50 + 1 else o_custkey % 50 end", "kind": "o_orderkey % 3", "starts_at": "o_orderdate"}
SCHEDULE = {"game": "o_orderkey", "day": "cast(o_orderdate as date)", "home": "o_custkey % 50", "kind": "o_orderkey % 3"}


@query(f"""WITH m AS (SELECT {_sql(MARKET)} FROM orders), s AS (SELECT {_sql(SCHEDULE)} FROM orders),
e AS (SELECT day, home, kind, min(game) AS game FROM s GROUP BY ALL HAVING count(DISTINCT game) = 1), f AS (SELECT day, kind, min(game) AS game FROM s GROUP BY ALL HAVING count(DISTINCT game) = 1)
SELECT market_ref, coalesce(e.game, f.game) AS game, CASE WHEN e.game IS NOT NULL THEN 'exact' WHEN f.game IS NOT NULL THEN 'fuzzy' END AS matched_by FROM m LEFT JOIN e USING (day, home, kind) LEFT JOIN f USING (day, kind)""")
def cnf_markets(t: Tables) -> DataFrame:
    """CNF-11: markets by all columns, else by fewer; ambiguous keys match nothing."""
    return conform.market_links(_named(t.orders, MARKET), _named(t.orders, SCHEDULE), ["day", "home", "kind"], ["day", "kind"]).select("market_ref", "game", "matched_by")


@query("""WITH m AS (SELECT user_id, max(ts) AS starts_at FROM events GROUP BY 1) SELECT concat('u', m.user_id) AS market_ref, m.starts_at, (SELECT value FROM events e WHERE e.user_id = m.user_id AND e.ts < m.starts_at ORDER BY ts DESC LIMIT 1) AS price FROM m""")
def cnf_price_before(t: Tables) -> DataFrame:
    """CNF-11: the last price strictly before the start."""
    ref = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("market_ref")
    markets = t.events.groupBy(ref).agg(F.max("ts").alias("starts_at"))
    return conform.prices_before(markets, t.events.select(ref, "ts", F.col("value").alias("price"))).select("market_ref", "starts_at", F.col("last_price").alias("price"))


STANDING = {
    "team_id": "c_custkey", "season": "concat('', 1990 + c_custkey % 20)", "wins": "concat('', c_custkey % 100)", "losses": "case when c_custkey % 100 = 0 then '0' else concat('', c_custkey % 62) end",
    "rank": "case when c_custkey % 6 = 0 then '-' else concat('', c_custkey % 6) end", "games_back": "case when c_custkey % 6 = 1 then '-' when c_custkey % 6 = 2 then '' else concat('', c_custkey % 30, '.5') end",
}
STANDINGS_SQL = f"""s AS (SELECT {_sql(STANDING)} FROM customer), st AS (SELECT team_id, season::INT AS season, wins::INT AS wins, losses::INT AS losses, CASE WHEN rank <> '-' THEN rank::BIGINT END AS rank,
  CASE WHEN games_back = '-' THEN 0.0 WHEN games_back = '' THEN NULL ELSE games_back::DOUBLE END AS games_back FROM s)"""


@query(f"WITH {STANDINGS_SQL} SELECT * FROM st")
def cnf_standings(t: Tables) -> DataFrame:
    """CNF-12, FLT-03: typed standings."""
    return conform.standings(_named(t.customer, STANDING))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN concat('mlb:', o_custkey) WHEN o_orderkey % 3 = 1 THEN concat('retro:', 'G', o_orderkey) ELSE concat('legacy-feature:', o_orderkey) END AS instance_key FROM orders""")
def cnf_instances(t: Tables) -> DataFrame:
    """CNF-14: stable keys by the best identity there is."""
    rows = t.orders.selectExpr("o_orderkey as id", "case when o_orderkey % 3 = 0 then o_custkey end as game_pk", "case when o_orderkey % 3 = 1 then concat('G', o_orderkey) end as retro_game_id")
    return conform.instances(rows).select("id", "instance_key")


@query("SELECT n_nationkey AS id, n_name AS name FROM nation")
def cnf_optional(t: Tables) -> DataFrame:
    """CNF-15: a source that isn't there counts as empty."""
    have = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return have.unionByName(conform.optional(lambda: t.no_such_source.select("id", "name"), have.limit(0)))


LINE = {"player_key": "l_suppkey", "season": "concat('', year(l_shipdate))", "ab": "concat('', cast(l_quantity as int))", "h": "case when l_partkey % 5 = 0 then '' else concat('', l_linenumber) end", "so": "concat('', l_linenumber % 3)"}
WAR = {"player_key": "l_suppkey", "season": "year(l_shipdate)", "is_pitcher": "l_returnflag = 'R'", "war": "concat('', l_linenumber, '.25')", "waa": "''", "team_code": "concat('T', l_suppkey % 20)"}


@query(f"""WITH b AS (SELECT {_sql(LINE)} FROM lineitem WHERE l_returnflag <> 'R'), p AS (SELECT {_sql(LINE)} FROM lineitem WHERE l_returnflag = 'R'), w AS (SELECT {_sql(WAR)} FROM lineitem WHERE l_linenumber < 3),
x AS (SELECT player_key, season::INT AS season, 'bat' AS role, sum(ab::BIGINT) AS ab, sum(nullif(h, '')::BIGINT) AS h, sum(so::BIGINT) AS so FROM b GROUP BY ALL
  UNION ALL SELECT player_key, season::INT, 'pitch', NULL, NULL, sum(so::BIGINT) FROM p GROUP BY ALL),
y AS (SELECT player_key, season, CASE WHEN is_pitcher THEN 'pitch' ELSE 'bat' END AS role, sum(war::DOUBLE) AS war FROM w GROUP BY ALL)
SELECT x.player_key, x.season, x.role, x.ab::BIGINT AS ab, x.h::BIGINT AS h, x.so::BIGINT AS so, s_name AS name, y.war FROM x JOIN supplier ON s_suppkey = x.player_key LEFT JOIN y USING (player_key, season, role)""")
def rpt_player_season(t: Tables) -> DataFrame:
    """RPT-01: batting and pitching lines from text, with names and summed WAR."""
    batting, pitching = _named(t.lineitem.filter("l_returnflag <> 'R'"), LINE), _named(t.lineitem.filter("l_returnflag = 'R'"), LINE).drop("ab", "h")
    war = _named(t.lineitem.filter("l_linenumber < 3"), WAR)
    out = reports.player_season(batting, pitching, t.supplier.select(F.col("s_suppkey").alias("player_key"), F.col("s_name").alias("name")), war)
    return out.select("player_key", "season", "role", "ab", "h", "so", "name", "war")


@query(f"""WITH {ERAS_SQL}, t AS (SELECT concat('T', o_custkey % 28) AS team_code, year(o_orderdate) AS season, count(*) AS wins FROM orders GROUP BY CASE WHEN o_custkey % 28 < 9 THEN o_custkey % 56 ELSE 0 END, o_custkey % 28, year(o_orderdate))
SELECT t.team_code, t.season, t.wins, e.first_year, e.nickname FROM (SELECT * FROM t QUALIFY count(*) OVER (PARTITION BY team_code, season) = 1) t JOIN eras e ON e.team_code = t.team_code AND t.season BETWEEN e.first_year AND e.last_year""")
def rpt_team_season(t: Tables) -> DataFrame:
    """RPT-02: totals with their era; a team and year that comes twice is left out."""
    totals = t.orders.selectExpr("concat('T', o_custkey % 28) as team_code", "year(o_orderdate) as season", "case when o_custkey % 28 < 9 then o_custkey % 56 else 0 end as part")
    totals = totals.groupBy("team_code", "season", "part").agg(F.count("*").alias("wins")).drop("part")
    return reports.team_season(totals, eras(t)).select("team_code", "season", "wins", "first_year", "nickname")


@query(f"""WITH {GAMES_SQL}, {PLAYS_SQL}, x AS (SELECT season, CASE WHEN bat_home_id = '1' THEN home_team_id ELSE away_team_id END AS team_id, event_cd, ab_fl, sf_fl FROM e JOIN g ON game_id = retro_game_id),
c AS (SELECT season, team_id, {', '.join(f"count(*) FILTER (event_cd = '{c}') AS {n}" for n, c in (('ubb', 14), ('hbp', 16), ('b1', 20), ('b2', 21), ('b3', 22), ('hr', 23)))}, count(*) FILTER (ab_fl = 'T') AS ab, count(*) FILTER (sf_fl = 'T') AS sf FROM x GROUP BY ALL),
w AS (SELECT season, team_id, 0.690 * ubb + 0.722 * hbp + 0.878 * b1 + 1.242 * b2 + 1.569 * b3 + 2.015 * hr AS points, ab + ubb + sf + hbp AS n FROM c),
r AS (SELECT season, team_id, points / n AS woba, sum(points) OVER (PARTITION BY season) / sum(n) OVER (PARTITION BY season) AS league_woba FROM w)
SELECT season, team_id, round(woba, 6) AS woba, round(league_woba, 6) AS league_woba, round(((woba - league_woba) / 1.2 + 1) / ((95 + team_id % 10) / 100) * 100, 4) AS wrc_plus FROM r""")
def rpt_team_offense(t: Tables) -> DataFrame:
    """RPT-04: full-season wOBA and wRC+ against the league."""
    g = games(t)
    rows = plays(t).join(g, F.col("game_id") == F.col("retro_game_id")).select("season", F.when(F.col("bat_home_id") == "1", F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("team_id"), "event_cd", "ab_fl", "sf_fl")
    factors = rows.select("season", "team_id").distinct().withColumn("park_factor", F.lit(95.0) + F.col("team_id") % 10)
    out = reports.team_offense(rows, factors)
    return out.select("season", "team_id", F.round("woba", 6).alias("woba"), F.round("league_woba", 6).alias("league_woba"), F.round("wrc_plus", 4).alias("wrc_plus"))


@query(f"""WITH {GAMES_SQL}, s AS (SELECT season, home_team_id AS team_id, TRUE AS home, home_score + away_score AS runs FROM g UNION ALL SELECT season, away_team_id, FALSE, home_score + away_score FROM g),
y AS (SELECT team_id, season, avg(runs) FILTER (home) / nullif(avg(runs) FILTER (NOT home), 0) * 100 AS ratio FROM s GROUP BY ALL)
SELECT n.team_id, n.season, round((SELECT avg(b.ratio) FROM y b WHERE b.team_id = n.team_id AND b.season BETWEEN n.season - 3 AND n.season - 1), 6) AS park_factor FROM y n""")
def rpt_park_factor(t: Tables) -> DataFrame:
    """RPT-03: home runs against road runs, mean of the three seasons before."""
    return reports.park_factors(games(t)).select("team_id", "season", F.round("park_factor", 6).alias("park_factor"))


@query(f"""WITH w AS (SELECT {_sql(WAR)} FROM lineitem) SELECT CASE team_code WHEN 'T3' THEN 'THR' WHEN 'T7' THEN 'SEV' ELSE team_code END AS team_code, season, sum(war::DOUBLE) AS war FROM w GROUP BY ALL""")
def rpt_team_war(t: Tables) -> DataFrame:
    """RPT-05: WAR by team through a map of codes."""
    return reports.team_war(_named(t.lineitem, WAR), {"T3": "THR", "T7": "SEV"})


@query(f"""WITH {STANDINGS_SQL} SELECT season, c_mktsegment AS division, team_id, nullif(concat_ws(' ', nullif(CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'City' END, ''), c_name), '') AS name, wins, losses, rank, games_back,
  CASE WHEN wins + losses >= 1 THEN round(wins / (wins + losses), 6) END AS win_pct FROM st JOIN customer ON c_custkey = team_id""")
def rpt_division(t: Tables) -> DataFrame:
    """RPT-06: standings with names and a guarded win share."""
    teams = t.customer.selectExpr("c_custkey as id", "case when c_custkey % 4 = 0 then '' else 'City' end as city", "c_name as nickname", "c_mktsegment as division")
    return reports.division_standing(conform.standings(_named(t.customer, STANDING)), teams).withColumn("win_pct", F.round("win_pct", 6))


@query("""SELECT 'orders' AS mart, (SELECT count(*) FROM orders) AS n, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS joined, 1.0 AS coverage, 'PASS' AS status
UNION ALL SELECT 'small_suppliers', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_suppkey < 5), round((SELECT count(*) FROM lineitem WHERE l_suppkey < 5) / (SELECT count(*) FROM lineitem), 6), 'FAIL'
UNION ALL SELECT 'nothing', 0, 0, NULL, 'EMPTY'""")
def rpt_health(t: Tables) -> DataFrame:
    """RPT-07: rows and join coverage of each mart, with a tolerance."""
    few = t.supplier.filter("s_suppkey < 5")
    return reports.health({
        "orders": (t.orders, t.customer, F.col("o_custkey") == F.col("c_custkey"), 0.99), "small_suppliers": (t.lineitem, few, F.col("l_suppkey") == F.col("s_suppkey"), 0.99),
        "nothing": (t.orders.filter("o_orderkey < 0"), t.customer, F.col("o_custkey") == F.col("c_custkey"), 0.99),
    })
