"""Play rows from record-typed event files: the grammar of an event text, and the walk of outs and runners along a game.

An event text has a head and, behind a dot, what runners did: the head names
the play (with a second part behind a plus sign), then modifiers behind slashes;
notes stand in parentheses. `grammar` takes it apart in column expressions, row
by row. `play_rows` adds what depends on the records before: who plays where
comes from windows over a game's records, runners and outs from a fold over the
records of each half-inning, scores and counters from sums over the game.

Rules where a text leaves something open: a batter who puts the ball in play
and isn't named among the outs reaches first; a home run brings all runners in;
every other runner without an advance stays. An out with an error among its
notes, and no fielder's out behind it, is no out. Advances of runners who aren't
on base move nobody, but outs count as the text has them. Texts that fit nothing
have event code 0 and change nothing. Records `NP` (no play) give no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The play's name as a pattern, and its event code.
EVENT_CODES = (
    (r"^NP", 1), (r"^HP", 16), (r"^S[0-9]*$", 20), (r"^(D[0-9]*|DGR[0-9]*)$", 21), (r"^T[0-9]*$", 22), (r"^HR?[0-9]*$", 23), (r"^(IW|I)$", 15), (r"^W$", 14),
    (r"^K", 3), (r"^SB", 4), (r"^DI", 5), (r"^(PO)?CS", 6), (r"^PO[123]\([0-9]*E[0-9]", 7), (r"^PO[123]", 8), (r"^WP", 9), (r"^PB", 10), (r"^BK", 11),
    (r"^OA", 12), (r"^FLE", 13), (r"^C$", 17), (r"^FC", 19), (r"^[0-9]*E[0-9]", 18), (r"^[0-9]", 2),
)
REACH = {20: 1, 21: 2, 22: 3, 23: 4, 14: 1, 15: 1, 16: 1, 17: 1, 18: 1, 19: 1}
BATTER_CODES = (2, 3, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23)
AT_BAT_CODES = (2, 3, 18, 19, 20, 21, 22, 23)
RBI_CODES = (2, 14, 15, 16, 17, 19, 20, 21, 22, 23)
#: Letters of a pitch sequence by class.
PITCHES = {"ball": "BIPV", "called_ball": "B", "intent_ball": "I", "pitchout_ball": "P", "hitbatter_ball": "H", "strike": "CSMQFLORTXYK", "called_strike": "C", "swingmiss_strike": "SMQ", "foul_strike": "FLORT", "inplay_strike": "XY", "other_strike": "K"}
TRAJECTORY = r"^(B?)([GFLP])(?:DP|TP)?([0-9][0-9A-Z]*[+-]?)?$"
ERROR, FIELDED = r"\([0-9]*E[0-9]", r"\([0-9]+(/[^)]*)?\)"


def _before(text: Column, stop: str) -> Column:
    """What stands before the first `stop` that isn't inside parentheses."""
    return F.regexp_extract(text, rf"^((?:[^{stop}(]|\([^)]*\))*)", 1)


def _rest(text: Column, head: Column) -> Column:
    return F.substring(text, F.length(head) + 2, F.length(text))


def grammar(df: DataFrame, event: str = "event") -> DataFrame:
    """df with the columns of its event texts: codes, flags, batted ball, outs, destinations, errors and fielders' credits.

    dest_b, dest_1, dest_2, dest_3: where the batter and each runner would end (0: out or not on base; 4, 5, 6: in, with an earned, an unearned, a team's unearned run).
    """
    text = F.regexp_replace(F.coalesce(F.col(event), F.lit("")), "[!?#]", "")
    df = df.withColumn("_head", _before(text, ".")).withColumn("_runs", _rest(text, F.col("_head")))
    df = df.withColumn("_basic", _before(F.col("_head"), "/"))
    df = df.withColumn("_mods", F.filter(F.split(_rest(F.col("_head"), F.col("_basic")), r"/(?![^(]*\))"), lambda m: m != ""))
    df = df.withColumn("_main", _before(F.col("_basic"), "+")).withColumn("_also", _rest(F.col("_basic"), F.col("_main")))
    moves = F.filter(F.split("_runs", ";"), lambda m: m.rlike("^[B123][-X][123H]"))

    def move(m: Column) -> Column:
        safe = (F.substring(m, 2, 1) == "-") | (m.rlike(ERROR) & ~F.regexp_replace(m, r"\([0-9]*E[0-9][^)]*\)", "").rlike(FIELDED))
        to = F.substring(m, 3, 1)
        home = F.when(m.contains("(TUR)"), 6).when(m.contains("(UR)"), 5).otherwise(4)
        dest = F.when(~safe, 0).when(to == "H", home).otherwise(to.try_cast("int"))
        return F.struct(F.substring(m, 1, 1).alias("who"), safe.alias("safe"), dest.alias("dest"), m.alias("notes"))

    df = df.withColumn("_moves", F.transform(moves, move)).withColumn("_steps", F.split(F.concat_ws(";", "_main", "_also"), ";"))
    code = reduce(lambda rest, c: F.when(F.col("_main").rlike(c[0]), c[1]).otherwise(rest), reversed(EVENT_CODES), F.lit(0))
    df = df.withColumn("event_cd", code)
    main, mods, steps, code = F.col("_main"), F.col("_mods"), F.col("_steps"), F.col("event_cd")
    said = lambda who: F.try_element_at(F.filter("_moves", lambda m: m["who"] == who), F.lit(-1))
    step = lambda pattern: F.exists(steps, lambda s: s.rlike(pattern))
    named = lambda pattern: F.try_element_at(F.filter(steps, lambda s: s.rlike(pattern)), F.lit(1))
    mod = lambda pattern: F.exists(mods, lambda m: m.rlike(pattern))

    # The batter: out by a fielder's sequence that no runner's mark ends, or by a mark of his own.
    batter_out = (code == 3) | ((code == 2) & (main.rlike(r"[0-9]$") | main.contains("(B)")))
    reach = F.create_map(*[F.lit(x) for pair in REACH.items() for x in pair])
    batter = F.when(batter_out, 0).when(code == 2, 1).otherwise(F.coalesce(F.try_element_at(reach, code), F.lit(0)))
    columns = {"dest_b": F.coalesce(said("B")["dest"], batter)}
    out = {"b": F.coalesce(~said("B")["safe"], batter_out)}
    for base, r in (("2", 1), ("3", 2), ("H", 3)):
        caught, picked = named(rf"^(PO)?CS{base}"), named(rf"^PO{r}")
        to = F.lit(4 if base == "H" else r + 1)
        implied = (
            F.when((code == 2) & main.contains(f"({r})"), 0)
            .when(caught.rlike(ERROR), to).when(caught.isNotNull(), 0)
            .when(picked.isNotNull() & ~picked.rlike(ERROR), 0)
            .when(step(rf"^SB{base}"), to)
            .when(code == 23, 4)
            .otherwise(r)
        )
        columns[f"dest_{r}"] = F.coalesce(said(str(r))["dest"], implied)
        out[str(r)] = F.coalesce(~said(str(r))["safe"], implied == 0)
        columns[f"run{r}_sb_fl"] = step(rf"^SB{base}")
        columns[f"run{r}_cs_fl"] = caught.isNotNull()
        columns[f"run{r}_pk_fl"] = step(rf"^PO({r}|CS{base})")
    outs = sum(x.cast("int") for x in out.values())
    ball = F.try_element_at(F.filter(mods, lambda m: m.rlike(TRAJECTORY)), F.lit(1))
    place = F.try_element_at(F.filter(F.transform(F.filter(mods, lambda m: m.rlike(TRAJECTORY)), lambda m: F.regexp_extract(m, TRAJECTORY, 3)), lambda x: x != ""), F.lit(1))
    columns |= {
        "bat_event_fl": code.isin(*BATTER_CODES), "sh_fl": F.array_contains(mods, "SH"), "sf_fl": F.array_contains(mods, "SF"), "event_outs_ct": outs,
        "h_cd": F.when(code >= 20, code - 19).otherwise(0), "battedball_cd": F.when(code.isin(2, 18, 19, 20, 21, 22, 23), F.regexp_extract(ball, TRAJECTORY, 2)),
        "bunt_fl": mod("^B[GFLP]"), "foul_fl": F.array_contains(mods, "FL"), "battedball_loc_tx": F.regexp_replace(place, "[+-]$", ""),
        "dp_fl": mod("^(?!NDP).*DP$") & (outs >= 2), "tp_fl": mod("TP$") & (outs >= 3),
        "wp_fl": step("^WP") | F.col("_runs").contains("(WP)"), "pb_fl": step("^PB") | F.col("_runs").contains("(PB)"),
        "fld_cd": F.when(code.isin(2, 18, 19, 20, 21, 22), F.coalesce(F.nullif(F.regexp_extract(main, "([0-9])", 1), F.lit("")).cast("int"), F.lit(0))).otherwise(0),
    }
    columns["ab_fl"] = code.isin(*AT_BAT_CODES) & ~columns["sh_fl"] & ~columns["sf_fl"]
    df = df.withColumns(columns)

    errors = F.regexp_extract_all(F.concat_ws(";", "_basic", "_runs"), F.lit(r"E([0-9](?:/TH)?)"), F.lit(1))
    # Fielders of each out in the order of the text; a later out of one ball begins with the fielder who made the one before.
    hops = F.regexp_extract_all(main, F.lit(r"([0-9]+)(?:\([B123]\))?"), F.lit(1))
    chain = F.transform(hops, lambda s, i: F.when(i > 0, F.concat(F.right(hops[i - 1], F.lit(1)), s)).otherwise(s))
    struck = F.when((code == 3) & (F.col("dest_b") == 0) & F.coalesce(said("B")["safe"].isNull(), F.lit(True)), F.array(F.when(main.rlike("^K[0-9]"), F.regexp_extract(main, "^K([0-9]+)", 1)).otherwise(F.lit("2"))))
    fields = lambda s: F.regexp_extract(s, r"\(([0-9]+)(?:/[^)]*)?\)", 1)
    thrown = F.transform(F.filter(steps, lambda s: s.rlike("^(PO|CS)") & ~s.rlike(ERROR)), fields)
    run_out = F.transform(F.filter("_moves", lambda m: ~m["safe"]), lambda m: fields(m["notes"]))
    none = F.array().cast("array<string>")
    credits = F.filter(F.concat(F.when(code == 2, chain).otherwise(none), F.coalesce(struck, none), thrown, run_out), lambda s: s != "")
    put, helped = F.transform(credits, lambda s: F.right(s, F.lit(1)).cast("int")), F.flatten(F.transform(credits, lambda s: F.transform(F.array_distinct(F.filter(F.split(F.substring(s, F.lit(1), F.length(s) - 1), ""), lambda x: x != "")), lambda x: x.cast("int"))))
    df = df.withColumns({"_errors": errors, "_put": put, "_helped": helped})
    at = lambda name, k: F.coalesce(F.try_element_at(F.col(name), F.lit(k)), F.lit(0))
    error = lambda k: F.try_element_at(F.col("_errors"), F.lit(k))
    listed = {f"po{k}_fld_cd": at("_put", k) for k in (1, 2, 3)} | {f"ass{k}_fld_cd": at("_helped", k) for k in (1, 2, 3, 4, 5)} | {"err_ct": F.size("_errors")}
    for k in (1, 2, 3):
        listed[f"err{k}_fld_cd"] = F.coalesce(F.substring(error(k), 1, 1).cast("int"), F.lit(0))
        listed[f"err{k}_cd"] = F.when(error(k).endswith("TH") | ((main.rlike("E[0-9]") & F.array_contains(mods, "TH")) if k == 1 else F.lit(False)), "T").when(error(k).isNotNull(), "F").otherwise("N")
    scored = F.filter("_moves", lambda m: m["dest"] >= 4)
    listed["_no_rbi"] = F.size(F.filter(scored, lambda m: m["notes"].rlike(r"\((NR|NORBI)\)"))) + F.size(F.filter(scored, lambda m: m["notes"].rlike(ERROR) & ~m["notes"].contains("(RBI)")))
    listed["_rbi"] = F.size(F.filter(scored, lambda m: m["notes"].contains("(RBI)")))
    listed["_grounded_dp"] = mod("^B?GDP")
    return df.withColumns(listed).drop("_head", "_runs", "_basic", "_main", "_also", "_moves", "_steps", "_errors", "_put", "_helped", "_mods")


ROWS = "array<struct<b1:string,b2:string,b3:string,p1:string,p2:string,p3:string,outs:int,runs:int,came:int,e1:string,e2:string,e3:string>>"
STATE = f"struct<b1:string,b2:string,b3:string,p1:string,p2:string,p3:string,outs:int,runs:int,rows:{ROWS}>"


def _walk(steps: Column) -> Column:
    """steps: array of (kind, player, other, pit_id, base, dest_b, dest_1, dest_2, dest_3, event_outs_ct) in order. For each what stood before and after."""

    def step(s: Column, x: Column) -> Column:
        runners = [(x["dest_b"], x["player"], x["pit_id"]), *((x[f"dest_{k}"], s[f"b{k}"], s[f"p{k}"]) for k in (1, 2, 3))]
        play = x["kind"] == "play"

        def base(k: int, of: int) -> Column:
            ends = F.coalesce(*[F.when((d == k) & r[0].isNotNull(), r[of]) for d, *r in runners])
            moved = F.when((x["kind"] == "sub") & (s[f"b{k}"] == x["other"]), x["player"] if of == 0 else s[f"p{k}"])
            placed = F.when((x["kind"] == "radj") & (x["base"] == k), x["player"] if of == 0 else x["pit_id"])
            return F.when(play, ends).otherwise(F.coalesce(moved, placed, s[f"b{k}"] if of == 0 else s[f"p{k}"]))

        came = sum(((d >= 4) & r[0].isNotNull()).cast("int") for d, *r in runners)
        after = {f"b{k}": base(k, 0) for k in (1, 2, 3)}
        row = F.struct(*[s[c].alias(c) for c in ("b1", "b2", "b3", "p1", "p2", "p3", "outs", "runs")], came.alias("came"), *[after[f"b{k}"].alias(f"e{k}") for k in (1, 2, 3)])
        return F.struct(
            *[after[f"b{k}"].alias(f"b{k}") for k in (1, 2, 3)], *[base(k, 1).alias(f"p{k}") for k in (1, 2, 3)],
            (s["outs"] + F.when(play, x["event_outs_ct"]).otherwise(0)).alias("outs"), (s["runs"] + F.when(play, came).otherwise(0)).alias("runs"),
            F.array_append(s["rows"], row).alias("rows"),
        )

    nobody = F.lit(None).cast("string")
    first = F.struct(*[nobody.alias(c) for c in ("b1", "b2", "b3", "p1", "p2", "p3")], F.lit(0).alias("outs"), F.lit(0).alias("runs"), F.array().cast(ROWS).alias("rows"))
    return F.aggregate(steps, first.cast(STATE), step, lambda s: s["rows"])


def play_rows(records: DataFrame, parts: int | None = None) -> DataFrame:
    """records: game_id, line, kind and c1.. as event_records gives them. One row per play, with typed columns under the names that such files are known by.

    Records are dealt by game once, over `parts` partitions (None: as the session
    has it), and all that follows stays there: only what the walk needs goes into
    arrays, and the texts' other columns are made of its rows.
    """
    r = records.filter(F.col("kind").isin("start", "sub", "play", "radj") & F.col("game_id").isNotNull()).withColumn("line", F.col("line").cast("long"))
    play, joins = F.col("kind") == "play", F.col("kind").isin("start", "sub")
    r = r.select(
        "game_id", "line", "kind", F.when(play, F.col("c1").try_cast("int")).alias("inning"), F.when(play, F.col("c2").try_cast("int")).when(joins, F.col("c3").try_cast("int")).alias("side"),
        F.when(play, F.col("c3")).otherwise(F.col("c1")).alias("player"), F.when(joins, F.col("c4").try_cast("int")).alias("lineup"), F.when(joins, F.col("c5").try_cast("int")).alias("fld"),
        F.when(F.col("kind") == "radj", F.col("c2").try_cast("int")).alias("base"), F.when(play, F.col("c4")).alias("count_tx"), F.when(play, F.col("c5")).alias("pitch_seq_tx"), F.when(play, F.col("c6")).alias("event_tx"),
    )
    # Every window and group below is of a game or finer, so this is the only exchange.
    r = r.repartition(parts, "game_id") if parts else r.repartition("game_id")
    # Who was in the same place of the order before, and the pitcher when the record came.
    slot = Window.partitionBy("game_id", "side", "lineup").orderBy("line")
    r = r.withColumn("other", F.when(F.col("kind") == "sub", F.lag("player").over(slot)))
    upto = Window.partitionBy("game_id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("game_id").orderBy("line").rowsBetween(0, Window.unboundedFollowing)
    fielder = lambda p, s: F.last(F.when(F.col("kind").isin("start", "sub") & (F.col("fld") == p) & (F.col("side") == s), F.col("player")), ignorenulls=True).over(upto)
    bats = F.first(F.when(F.col("kind") == "play", F.col("side")), ignorenulls=True).over(after)
    fielding = lambda p: F.when(F.col("half") == 0, F.col(f"_f{p}_1")).otherwise(F.col(f"_f{p}_0"))
    r = r.withColumns({"half": bats, "inn_ct": F.first("inning", ignorenulls=True).over(after), "_f1_0": fielder(1, 0), "_f1_1": fielder(1, 1)}).withColumn("pit_id", fielding(1))
    r = grammar(r.filter("inn_ct IS NOT NULL AND NOT (kind = 'play' AND coalesce(event_tx, '') = 'NP')"), "event_tx")

    # All records of a half-inning go along, so the windows behind the walk know the starters and substitutes, too.
    carried = ("dest_b", "dest_1", "dest_2", "dest_3", "event_outs_ct", "bat_event_fl")
    record = F.struct("line", "kind", "player", "other", "pit_id", "base", *carried, "side", "lineup", "fld", "count_tx", "pitch_seq_tx", "event_tx")
    halves = r.groupBy("game_id", "inn_ct", "half").agg(F.array_sort(F.collect_list(record)).alias("steps"))
    walked = halves.withColumn("walked", _walk(F.col("steps"))).select("game_id", "inn_ct", "half", F.inline(F.arrays_zip("steps", "walked")))
    rows = walked.select("game_id", "inn_ct", "half", "steps.*", "walked.*")
    own = Window.partitionBy("game_id", "player").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"bat_lineup_id": F.last("lineup", ignorenulls=True).over(own), "bat_fld_cd": F.last("fld", ignorenulls=True).over(own)})
    rows = rows.withColumns({f"_f{p}_{s}": fielder(p, s) for p in range(2, 10) for s in (0, 1)}).withColumns({f"pos{p}_fld_id": fielding(p) for p in range(2, 10)})
    rows = rows.filter("kind = 'play'").drop("side", "lineup", "fld", "base", "other", *[f"_f{p}_{s}" for p in range(2, 10) for s in (0, 1)])

    game = Window.partitionBy("game_id").orderBy("line")
    inning = Window.partitionBy("game_id", "inn_ct", "half").orderBy("line")
    total = Window.partitionBy("game_id", "inn_ct", "half")
    so_far = game.rowsBetween(Window.unboundedPreceding, -1)
    runs = lambda s: F.coalesce(F.sum(F.when(F.col("half") == s, F.col("came"))).over(so_far), F.lit(0)).cast("int")
    rows = rows.withColumns(
        {
            "event_id": F.row_number().over(game), "away_score_ct": runs(0), "home_score_ct": runs(1), "inn_runs_ct": F.col("runs"),
            "fate_runs_ct": (F.sum("came").over(total) - F.col("runs") - F.col("came")).cast("int"), "inn_new_fl": F.row_number().over(inning) == 1, "inn_end_fl": F.lead("line").over(inning).isNull(),
            "game_new_fl": F.row_number().over(game) == 1, "game_end_fl": F.lead("line").over(game).isNull(),
            "inn_pa_ct": F.coalesce(F.sum(F.col("bat_event_fl").cast("int")).over(inning.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"),
            "game_pa_ct": F.coalesce(F.sum(F.col("bat_event_fl").cast("int")).over(so_far), F.lit(0)).cast("int"),
        }
    )
    rows = rows.withColumn("leadoff_fl", F.col("inn_pa_ct") == 0)
    # The texts once more, for what they say beside the runners: behind the last sort, and only what is asked for.
    rows = grammar(rows.withColumnsRenamed({c: f"_{c}" for c in carried}), "event_tx").drop(*carried).withColumnsRenamed({f"_{c}": c for c in carried})
    bits = lambda a, b, c: sum(F.when(F.col(x).isNotNull(), v).otherwise(0) for x, v in ((a, 1), (b, 2), (c, 4)))
    sent = lambda k: F.when(F.col(f"b{k}").isNull(), 0).otherwise(F.col(f"dest_{k}"))
    rbi = F.when(F.col("event_cd").isin(*RBI_CODES) & ~F.col("_grounded_dp"), F.greatest(F.col("came") - F.col("_no_rbi"), F.lit(0))).otherwise(F.col("_rbi"))
    pitch = lambda letters: F.length(F.regexp_replace(F.coalesce("pitch_seq_tx", F.lit("")), f"[^{letters}]", ""))
    return rows.select(
        "game_id", "event_id", "inn_ct", F.col("half").alias("bat_home_id"), F.col("outs").alias("outs_ct"), F.substring("count_tx", 1, 1).try_cast("int").alias("balls_ct"), F.substring("count_tx", 2, 1).try_cast("int").alias("strikes_ct"),
        "count_tx", "pitch_seq_tx", "away_score_ct", "home_score_ct", F.col("player").alias("bat_id"), "bat_lineup_id", "bat_fld_cd", "pit_id", *[f"pos{p}_fld_id" for p in range(2, 10)],
        *[F.col(f"b{k}").alias(f"base{k}_run_id") for k in (1, 2, 3)], *[F.col(f"p{k}").alias(f"run{k}_resp_pit_id") for k in (1, 2, 3)], "event_tx", "event_cd", "bat_event_fl", "ab_fl", "h_cd", "sh_fl", "sf_fl", "event_outs_ct", "dp_fl", "tp_fl",
        rbi.cast("int").alias("rbi_ct"), "wp_fl", "pb_fl", "fld_cd", "battedball_cd", "bunt_fl", "foul_fl", "battedball_loc_tx", "err_ct", *[c for k in (1, 2, 3) for c in (f"err{k}_fld_cd", f"err{k}_cd")],
        F.col("dest_b").alias("bat_dest_id"), *[sent(k).alias(f"run{k}_dest_id") for k in (1, 2, 3)], *[f"run{k}_{f}_fl" for f in ("sb", "cs", "pk") for k in (1, 2, 3)],
        *[f"po{k}_fld_cd" for k in (1, 2, 3)], *[f"ass{k}_fld_cd" for k in (1, 2, 3, 4, 5)], F.col("came").alias("event_runs_ct"), "inn_runs_ct", "fate_runs_ct",
        bits("b1", "b2", "b3").alias("start_bases_cd"), bits("e1", "e2", "e3").alias("end_bases_cd"), "leadoff_fl", "inn_new_fl", "inn_end_fl", "game_new_fl", "game_end_fl", "inn_pa_ct", "game_pa_ct",
        *[pitch(letters).alias(f"pa_{name}_ct") for name, letters in PITCHES.items()],
    )
