"""Games, plays and their neighbours derived from the driver's tables, by expressions that Spark and SQL twins share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pennant.plans.registry import Tables

TEAMS = 30
#: Column expressions by name, in SQL that Spark and DuckDB both read.
GAME = {
    "id": "o_orderkey", "retro_game_id": "concat('G', o_orderkey)", "season": "year(o_orderdate)", "game_date": "cast(o_orderdate as date)", "game_number": "o_orderkey % 2",
    "home_team_id": f"o_custkey % {TEAMS}", "away_team_id": f"(o_custkey + 1 + o_orderkey % {TEAMS - 1}) % {TEAMS}",
    "home_score": "cast(floor(o_totalprice) as bigint) % 10", "away_score": "cast(floor(o_totalprice / 10) as bigint) % 9",
    "game_type": "case when o_orderpriority = '5-LOW' then 'spring' else 'regular' end",
}
_CODES = ("3", "14", "15", "16", "20", "21", "22", "23")
_CODE = "case l_partkey % 8 " + " ".join(f"when {k} then '{c}'" for k, c in enumerate(_CODES)) + " end"
PLAY = {
    "game_id": "concat('G', l_orderkey)", "event_cd": _CODE, "bat_home_id": "case when l_linenumber % 2 = 0 then '0' else '1' end",
    "bat_event_fl": "case when l_partkey % 11 = 0 then 'F' else 'T' end", "ab_fl": "case when l_partkey % 8 in (1, 2, 3) then 'F' else 'T' end", "sf_fl": "case when l_suppkey % 17 = 0 then 'T' else 'F' end",
    "battedball_cd": "case l_suppkey % 5 when 0 then 'G' when 1 then 'F' when 2 then 'L' when 3 then 'P' else '' end",
    "h_cd": "case l_partkey % 8 when 4 then '1' when 5 then '2' when 6 then '3' when 7 then '4' else '0' end",
    "outs_ct": "case when l_quantity < 15 then '0' when l_quantity < 35 then '1' else '2' end",
    "base1_run_id": "case when l_suppkey % 2 = 0 then 'r1' else '' end", "base2_run_id": "case when l_suppkey % 3 = 0 then 'r2' end", "base3_run_id": "case when l_suppkey % 7 = 0 then 'r3' else '' end",
    "event_outs_ct": "case when l_partkey % 8 = 0 then '1' else '0' end", "event_runs_ct": "case when l_partkey % 8 = 7 then '1' else '0' end",
    "resp_pit_id": "concat('P', l_suppkey % 40)", "resp_pit_start_fl": "case when l_linenumber <= 3 then 'T' else 'F' end",
    "pitch_seq_tx": "translate(concat('', cast(floor(l_extendedprice) as bigint)), '0123456789', 'BCFKSXMTL*')",
    "run1_sb_fl": "case when l_partkey % 13 = 0 then 'T' else 'F' end", "run2_sb_fl": "'F'", "run3_sb_fl": "'F'", "run1_cs_fl": "case when l_partkey % 29 = 0 then 'T' else 'F' end", "run2_cs_fl": "'F'", "run3_cs_fl": "'F'",
    "bat_hand_cd": "case l_suppkey % 4 when 0 then 'L' when 1 then 'R' when 2 then 'R' else '' end",
}


def _select(expressions: dict[str, str]) -> list[str]:
    return [f"{e} as {n}" for n, e in expressions.items()]


def games(t: Tables) -> DataFrame:
    return t.orders.selectExpr(*_select(GAME))


def plays(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(*_select(PLAY))


GAMES_SQL = f"g AS (SELECT {', '.join(_select(GAME))} FROM orders)"
PLAYS_SQL = f"e AS (SELECT {', '.join(_select(PLAY))} FROM lineitem)"


def half_up(sql: str) -> str:
    """Each round(x, n) of a twin over the shortest decimal text of x, as Spark rounds; DuckDB multiplies first, and ties may come out otherwise."""
    out, at = "", 0
    while (found := sql.find("round(", at)) >= 0:
        depth, k = 1, found + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        x, _, digits = sql[found + 6 : k - 1].rpartition(",")
        out += f"{sql[at:found]}round(({half_up(x)})::DOUBLE::VARCHAR::DECIMAL(38, 18),{digits})::DOUBLE"
        at = k
    return out + sql[at:]
