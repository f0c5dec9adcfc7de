"""Registered queries of sources, load semantics, streams and the remaining cleaning rules.

What a source reader takes in is made from the driver's tables first, so each
query is a round trip whose twin reads the tables directly.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pennant.functions import clean
from pennant.operators import frozen, intervals, quality, sequence
from pennant.plans.registry import ORACLE_SQL, Tables, query
from pennant.sources import evolve, keyed, readers, sinks
from pennant.sources import plays as plays_source
from pennant.streaming import snapshots


def column(expression: str) -> Column:
    return F.expr(expression)


@query("""SELECT o_orderkey AS id, make_date(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE year(o_orderdate)::INT END, month(o_orderdate)::INT, day(o_orderdate)::INT) AS whole_date,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate::DATE END AS us, o_custkey % 9 * 3 + o_orderkey % 3 AS outs,
  concat(CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '_' END, CASE WHEN o_orderkey % 3 = 0 THEN '2' ELSE '_' END, CASE WHEN o_orderkey % 5 = 0 THEN '3' ELSE '_' END) AS bases,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_orderkey END AS side_pick, CASE WHEN o_orderkey % 2 = 0 THEN concat('b', o_custkey) ELSE concat('a', o_orderkey) END AS listed,
  CASE WHEN o_orderkey % 4 = 0 THEN ((o_orderkey % 10) / 10.0 + 0.5) / 2 ELSE (o_orderkey % 97 + 1) / 100.0 END AS price, o_totalprice - o_custkey AS gap,
  CASE WHEN o_orderkey % 6 > 0 THEN round(o_custkey::DOUBLE / (o_orderkey % 6), 6) END AS per_game, o_orderkey % 5 IS DISTINCT FROM nullif(o_custkey % 5, 0) AS differs FROM orders""")
def clean_more(t: Tables) -> DataFrame:
    """FLT-05, FLT-09, FLT-10, FLT-12, FLT-16, FLT-17, FLT-20, FLT-21, FLT-23: dates of parts, innings, bases, sides, lists, prices, guarded rates, null-safe inequality."""
    e = column
    home = e("o_orderkey % 2 = 0")
    names = e("concat(\"['a\", o_orderkey, \"', 'b\", o_custkey, \"']\")")
    return t.orders.select(
        F.col("o_orderkey").alias("id"), clean.date_of(e("case when o_orderkey % 7 = 0 then null else year(o_orderdate) end"), e("month(o_orderdate)"), e("day(o_orderdate)")).alias("whole_date"),
        clean.us_date(e("case when o_orderkey % 3 = 0 then '1/2/99' else date_format(o_orderdate, 'MM/dd/yyyy') end")).alias("us"), clean.outs_pitched(e("concat(o_custkey % 9, '.', o_orderkey % 3)")).cast("long").alias("outs"),
        clean.base_state(e("case when o_orderkey % 2 = 0 then 'x' else '' end"), e("case when o_orderkey % 3 = 0 then 'x' end"), e("case when o_orderkey % 5 = 0 then 'x' else ' ' end")).alias("bases"),
        clean.pick_side(home, F.col("o_custkey"), F.col("o_orderkey")).alias("side_pick"), F.get(clean.literal_list(names), F.when(home, 1).otherwise(0)).alias("listed"),
        clean.mid_price(e("case o_orderkey % 4 when 0 then '0.0000' else concat('', (o_orderkey % 97 + 1) / 100) end"), e("concat('', o_orderkey % 10 / 10)"), F.lit("0.5")).alias("price"),
        (F.col("o_totalprice") - F.col("o_custkey")).alias("gap"), F.round(clean.rate(F.col("o_custkey"), e("o_orderkey % 6")), 6).alias("per_game"), clean.distinct_from(e("o_orderkey % 5"), e("nullif(o_custkey % 5, 0)")).alias("differs"),
    )


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def clean_optional_filter(t: Tables) -> DataFrame:
    """FLT-08: a predicate holds where its parameter isn't given."""
    given = {"o_orderstatus": "F", "o_orderpriority": None}
    return t.orders.filter(clean.where_given(given)).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'Zoë' ELSE 'plain' END AS name FROM orders")
def src_escapes(t: Tables) -> DataFrame:
    """SRC-20: literal escapes of UTF-8 bytes, repaired."""
    return t.orders.select(F.col("o_orderkey").alias("id"), clean.repair_escapes(F.when(F.col("o_orderkey") % 3 == 0, F.lit("Zo\\xc3\\xab")).otherwise(F.lit("plain"))).alias("name"))


LINES = "l_orderkey, l_linenumber, l_partkey, l_quantity"


def documents(t: Tables) -> DataFrame:
    """One JSON document for each order, with its lines nested as a feed nests them."""
    line = F.struct(F.col("l_linenumber").alias("about"), F.struct(F.col("l_partkey").alias("partId"), F.col("l_quantity").alias("quantity")).alias("result"))
    return t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(line).alias("allPlays"))).alias("body"))


@query(f"SELECT {LINES} FROM lineitem")
def src_nested_feed(t: Tables) -> DataFrame:
    """SRC-07, SRC-10, SRC-11, SRC-21c, SRC-21d, SRC-21n: arrays of nested records to rows."""
    schema = "struct<allPlays:array<struct<about:int,result:struct<partId:bigint,quantity:double>>>>"
    fields = {"l_linenumber": "about", "l_partkey": "result.partId", "l_quantity": "result.quantity"}
    return readers.flatten(documents(t), "body", schema, "allPlays", fields, ["l_orderkey"]).select(*LINES.split(", "))


@query("SELECT o_custkey, concat('ID', o_orderkey) AS person, o_orderstatus AS full_name, o_totalprice AS batting_average FROM orders")
def src_map_feed(t: Tables) -> DataFrame:
    """SRC-08, SRC-21b, SRC-21m: maps of records to rows, names in snake case."""
    entry = F.struct(F.concat(F.lit("ID"), F.col("o_orderkey").cast("string")), F.struct(F.col("o_orderstatus").alias("fullName"), F.col("o_totalprice").alias("battingAverage")))
    docs = t.orders.groupBy("o_custkey").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("players"))).alias("body"))
    return readers.flatten_map(docs, "body", "struct<players:map<string,struct<fullName:string,battingAverage:double>>>", "players", ["o_custkey"], "person")


@query("""WITH r AS (SELECT o_custkey, o_orderkey % 9 AS inning, max(o_orderkey % 5) AS h, max(o_orderkey % 4) AS a FROM orders GROUP BY ALL)
SELECT o_custkey, inning::INT AS inning, 'home' AS side, h::INT AS runs, (h + 1)::INT AS hits, NULL::INT AS errors FROM r UNION ALL SELECT o_custkey, inning::INT, 'away', a::INT, (a + 2)::INT, 0 FROM r""")
def src_line_score(t: Tables) -> DataFrame:
    """SRC-09: innings by side to rows; an absent measure is null."""
    rows = t.orders.groupBy("o_custkey", (F.col("o_orderkey") % 9).alias("num")).agg(F.max(F.col("o_orderkey") % 5).alias("h"), F.max(F.col("o_orderkey") % 4).alias("a"))
    inning = F.struct("num", F.struct(F.col("h").alias("runs"), (F.col("h") + 1).alias("hits")).alias("home"), F.struct(F.col("a").alias("runs"), (F.col("a") + 2).alias("hits"), F.lit(0).alias("errors")).alias("away"))
    docs = rows.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(inning).alias("innings"))).alias("body"))
    return readers.line_scores(docs, "body", ["o_custkey"])


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS season_id, c_mktsegment AS season_abbreviation FROM customer")
def src_scalars(t: Tables) -> DataFrame:
    """SRC-21i, SRC-21j: atomic fields of a catalog entry, those of its structs prefixed, lists left out."""
    league = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("abbreviation")).alias("season"), F.array(F.lit(1)).alias("clubs"))
    return readers.scalars(t.customer.select(league.alias("league")), "league")


@query("SELECT year(o_orderdate) AS draft, o_custkey % 5 AS round, o_orderkey AS pick FROM orders")
def src_draft(t: Tables) -> DataFrame:
    """SRC-21h, SRC-21a: two levels of arrays to rows."""
    picks = t.orders.groupBy(F.year("o_orderdate").alias("draft"), (F.col("o_custkey") % 5).alias("round")).agg(F.collect_list(F.struct(F.col("o_orderkey").alias("pick"))).alias("picks"))
    docs = picks.groupBy("draft").agg(F.to_json(F.struct(F.collect_list(F.struct("round", "picks")).alias("rounds"))).alias("body"))
    rounds = readers.flatten(docs, "body", "struct<rounds:array<struct<round:bigint,picks:array<struct<pick:bigint>>>>>", "rounds", {"round": "round", "picks": "picks"}, ["draft"])
    return rounds.select("draft", "round", F.explode("picks").alias("p")).select("draft", "round", "p.pick")


@query("""SELECT user_id, event_id AS ts, value AS yes_bid_open, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value + 1 END AS yes_bid_close, value * 2 AS price_open FROM events""")
def src_candles(t: Tables) -> DataFrame:
    """SRC-15: prefixed sub-objects, sparse keys null."""
    bid = F.struct(F.col("value").alias("open"), F.when(F.col("event_id") % 3 != 0, F.col("value") + 1).alias("close"))
    rows = t.events.select("user_id", F.col("event_id").alias("ts"), bid.alias("yes_bid"), F.struct((F.col("value") * 2).alias("open")).alias("price"))
    return readers.candles(rows, {"yes_bid": ["open", "close"], "price": ["open"]}, ["user_id", "ts"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 2 WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS page FROM orders")
def src_pages(t: Tables) -> DataFrame:
    """SRC-13: several paged results, the last one wins."""
    return readers.last_page_wins([t.orders.filter(f"o_orderkey % {m} = 0").select("o_orderkey", F.lit(k).alias("page")) for k, m in enumerate((1, 2, 4))], "o_orderkey")


@query("""WITH b AS (SELECT date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS hi FROM events),
x AS (SELECT user_id, ts AS s, least(ts + INTERVAL 3 HOUR, hi) AS e FROM events, b UNION ALL SELECT DISTINCT user_id, lo, lo FROM events, b UNION ALL SELECT DISTINCT user_id, hi, hi FROM events, b),
g AS (SELECT user_id, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a, s AS z FROM x),
k AS (SELECT user_id, a, z, unnest(range(ceil(epoch_us(z) / 172800000000 - epoch_us(a) / 172800000000)::BIGINT + 1)) AS k FROM g WHERE a < z)
SELECT user_id, a + k * INTERVAL 2 DAY AS "start", least(a + (k + 1) * INTERVAL 2 DAY, z) AS "end" FROM k WHERE a + k * INTERVAL 2 DAY < z""")
def src_missing_windows(t: Tables) -> DataFrame:
    """SRC-14, SRC-19: what is still to be fetched of a range, in windows of at most two days: each user's time without an event in the three hours before."""
    rows = t.events.select("user_id", F.col("ts").alias("start"), (F.col("ts") + F.expr("INTERVAL 3 HOURS")).alias("end"))
    asked = t.events.agg(F.date_trunc("day", F.min("ts")).alias("start"), (F.date_trunc("day", F.max("ts")) + F.expr("INTERVAL 1 DAY")).alias("end"))
    wanted = t.events.select("user_id").distinct().crossJoin(F.broadcast(asked))
    found = intervals.missing(wanted, rows, ["user_id"], "start", "end", 2 * intervals.DAY)
    return found.select("user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")])


@query("SELECT event_type AS dataset, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY 1")
def src_datasets(t: Tables) -> DataFrame:
    """SRC-24: documents of several datasets in one stream, apart by name."""
    parts = readers.split_datasets(t.events, "event_type", ["view", "click"])
    return parts["view"].unionByName(parts["click"]).groupBy(F.col("event_type").alias("dataset")).agg(F.count("*").alias("n"))


@query("SELECT concat('', o_orderkey) AS o_orderkey, o_orderpriority, concat('', o_custkey) AS o_custkey FROM orders WHERE o_orderstatus = 'F'")
def snk_csv(t: Tables) -> DataFrame:
    """SNK-10, SRC-01: an export as CSV, read again as text under clean names."""
    path = snapshots.scratch(t.spark, "csv")
    sinks.export_csv(t.orders.select("o_orderkey", "o_orderpriority", "o_custkey", "o_orderstatus"), path, where=F.col("o_orderstatus") == "F")
    return readers.csv_with_header(t.spark, path).select("o_orderkey", "o_orderpriority", "o_custkey")


@query("SELECT concat('', n_nationkey) AS key, n_name AS name, concat('', n_regionkey) AS region FROM nation")
def src_headerless(t: Tables) -> DataFrame:
    """SRC-02, SRC-17, SRC-23: files without a header under given names."""
    path = snapshots.scratch(t.spark, "log")
    t.nation.repartition(3).write.csv(path)
    return readers.many_files(t.spark, f"{path}/*.csv", ["key", "name", "region"]).select("key", "name", "region")


@query("SELECT concat('', n_nationkey) AS id, n_name AS nation_name, concat('region', n_regionkey, '.csv') AS _member FROM nation")
def src_archives(t: Tables) -> DataFrame:
    """SRC-03: zip archives, each with a delimited member for some regions; members that aren't delimited text are passed over."""

    @F.pandas_udf("binary")
    def packed(names: pd.Series, bodies: pd.Series) -> pd.Series:
        def one(pairs: zip) -> bytes:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                z.writestr("readme.txt", "no rows")
                for name, body in pairs:
                    z.writestr(name, body)
            return out.getvalue()

        return pd.Series([one(zip(n, b, strict=True)) for n, b in zip(names, bodies, strict=True)])

    lines = F.array_join(F.collect_list(F.concat_ws(",", "n_nationkey", "n_name")), "\n")
    members = t.nation.groupBy("n_regionkey").agg(F.struct(F.concat(F.lit("region"), "n_regionkey", F.lit(".csv")).alias("name"), F.concat(F.lit("ID,Nation Name\n"), lines).alias("body")).alias("m"))
    archives = members.groupBy((F.col("n_regionkey") % 2).alias("path")).agg(F.collect_list("m").alias("m"))
    archives = archives.select(F.concat(F.lit("archive"), "path").alias("path"), packed("m.name", "m.body").alias("content"))
    return readers.unzipped(archives, ["id", "nation_name"]).select("id", "nation_name", "_member")


@query("""SELECT concat('G', l_orderkey) AS game_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey)::INTEGER AS play, l_linenumber::INTEGER AS inning, (l_linenumber % 2)::INTEGER AS home,
concat('p', l_suppkey) AS batter, '01' AS count, 'CX' AS pitches, concat('S', l_partkey % 9) AS event FROM lineitem""")
def src_event_files(t: Tables) -> DataFrame:
    """SRC-04: files of typed records (id, version, play), many games to a file, split into games and plays."""
    path = snapshots.scratch(t.spark, "records")
    plays = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey")))
    line = lambda x: F.concat(F.lit("play,"), x.l_linenumber, F.lit(","), x.l_linenumber % 2, F.lit(",p"), x.l_suppkey, F.lit(",01,CX,S"), x.l_partkey % 9)
    games = t.lineitem.groupBy("l_orderkey").agg(plays.alias("plays"))
    games.select(F.concat(F.lit("id,G"), "l_orderkey", F.lit("\nversion,2\n"), F.array_join(F.transform("plays", line), "\n")).alias("value")).write.text(path)
    return readers.plays_of(readers.event_records(t.spark, path))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS price, o_orderkey % 10 = 0 AS isolated FROM orders")
def src_bad_records(t: Tables) -> DataFrame:
    """SRC-06: lines that don't fit the schema are set apart, with their file, and the others go on."""
    path = snapshots.scratch(t.spark, "dirty")
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    t.orders.select(F.col("o_orderkey").alias("id"), price.alias("price")).write.csv(path, header=True)
    good, bad = readers.csv_or_quarantine(t.spark, path, StructType.fromDDL("id long, price long"))
    bad = bad.filter("_file <> ''").select(F.split("_corrupt_record", ",")[0].cast("long").alias("id"), F.lit(None).cast("long").alias("price"), F.lit(True).alias("isolated"))
    return good.select("id", "price", F.lit(False).alias("isolated")).unionByName(bad)


def halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    """An old state of the orders, and a batch that overlaps it."""
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("season"), "o_custkey", "o_totalprice")
    old = rows.filter("o_orderkey % 3 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")))
    new = rows.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return old, new


HALVES_SQL = """r AS (SELECT o_orderkey, year(o_orderdate) AS season, o_custkey, o_totalprice FROM orders),
o AS (SELECT o_orderkey, season, o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice FROM r WHERE o_orderkey % 3 <> 0),
n AS (SELECT o_orderkey, season, o_custkey, o_totalprice + 1 AS o_totalprice FROM r WHERE o_orderkey % 2 = 0)"""


@query(f"WITH {HALVES_SQL} SELECT * FROM o WHERE season NOT IN (1996, 1998) UNION ALL SELECT * FROM n WHERE season = 1996")
def snk_scoped_replace(t: Tables) -> DataFrame:
    """SNK-02, SNK-03: rows of the named scopes give way, also where the batch has none."""
    old, new = halves(t)
    return sinks.scoped_replace(old, new.filter("season = 1996"), "season", [1996, 1998])


@query("SELECT n_nationkey, concat(n_name, '!') AS n_name FROM nation")
def snk_versions(t: Tables) -> DataFrame:
    """SNK-01: a full replace is a new version beside the one being read."""
    path = snapshots.scratch(t.spark, "table")
    sinks.write_version(t.nation.select("n_nationkey", "n_name"), path)
    sinks.write_version(sinks.read_version(t.spark, path).withColumn("n_name", F.concat("n_name", F.lit("!"))), path)
    return sinks.read_version(t.spark, path)


@query(f"WITH {HALVES_SQL} SELECT * FROM o UNION ALL SELECT * FROM n WHERE o_orderkey % 3 = 0")
def snk_append(t: Tables) -> DataFrame:
    """SNK-04: append of a batch with a declared identity."""
    old, new = halves(t)
    return old.unionByName(sinks.check_identity(new.filter("o_orderkey % 3 = 0"), ["o_orderkey"]))


@query("SELECT 'added' AS change, 'c_name' AS name UNION ALL SELECT 'missing', 'n_name' UNION ALL SELECT 'missing', 'n_regionkey'")
def snk_drift(t: Tables) -> DataFrame:
    """SNK-05: columns that came and went."""
    found = sinks.drift(t.nation, t.customer.select(F.col("c_custkey").alias("n_nationkey"), "c_name"))
    return t.spark.createDataFrame([(k, n) for k, names in found.items() for n in names], "change string, name string")


@query(f"WITH {HALVES_SQL} SELECT * FROM o UNION ALL SELECT * FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)")
def snk_insert_absent(t: Tables) -> DataFrame:
    """SNK-06: rows whose key is absent."""
    old, new = halves(t)
    return sinks.insert_absent(old, new.unionByName(new), ["o_orderkey"])


@query(f"""WITH {HALVES_SQL} SELECT o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN o.season ELSE n.season END AS season, coalesce(o.o_custkey, n.o_custkey) AS o_custkey,
  CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice WHEN o.o_orderkey IS NULL THEN n.o_totalprice ELSE coalesce(o.o_totalprice, 0) + coalesce(n.o_totalprice, 0) END AS o_totalprice FROM o FULL JOIN n USING (o_orderkey)""")
def snk_upsert(t: Tables) -> DataFrame:
    """SNK-07: merge by key, with a rule for each column."""
    old, new = halves(t)
    return sinks.upsert(old, new, ["o_orderkey"], {"o_custkey": "keep", "o_totalprice": "add"})


@query(f"WITH {HALVES_SQL} SELECT o.o_orderkey, o.season, o.o_custkey, coalesce(o.o_totalprice, n.o_totalprice) AS o_totalprice FROM o LEFT JOIN n USING (o_orderkey)")
def snk_fill_missing(t: Tables) -> DataFrame:
    """SNK-08: a second source fills nulls and nothing else."""
    old, new = halves(t)
    return sinks.fill_missing(old, new, ["o_orderkey"], ["o_totalprice"]).select("o_orderkey", "season", "o_custkey", "o_totalprice")


@query("SELECT TRUE AS same, FALSE AS other")
def snk_content_id(t: Tables) -> DataFrame:
    """SNK-11, ML-04: the content's id doesn't depend on row order or partitions, but on each value."""
    first, dealt = sinks.content_id(t.nation), sinks.content_id(t.nation.repartition(5, "n_name").orderBy(F.desc("n_name")))
    other = sinks.content_id(t.nation.withColumn("n_name", F.when(F.col("n_nationkey") == 3, "x").otherwise(F.col("n_name"))))
    return t.spark.createDataFrame([(first == dealt, first == other)], "same boolean, other boolean")


def arriving(t: Tables) -> DataFrame:
    """The events as a stream of their file."""
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)


@query("SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'")
def str_append(t: Tables) -> DataFrame:
    """STR-01, STR-07: open snapshots appended as they arrive."""
    out, seen = snapshots.scratch(t.spark, "stream"), snapshots.scratch(t.spark, "progress")
    rows = snapshots.active(arriving(t), F.col("event_type") != "error").select("event_id", "user_id", "value")
    snapshots.append(rows, out, seen).awaitTermination()
    return t.spark.read.parquet(out)


@query("SELECT DISTINCT user_id, event_type FROM events")
def str_first_wins(t: Tables) -> DataFrame:
    """STR-03: one row for each key, state bounded by the watermark."""
    out, seen = snapshots.scratch(t.spark, "stream"), snapshots.scratch(t.spark, "progress")
    rows = snapshots.first_wins(arriving(t).select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")), ["user_id", "event_type"], "ts", "400 days")
    snapshots.append(rows, out, seen).awaitTermination()
    return t.spark.read.parquet(out).select("user_id", "event_type")


def in_parts(t: Tables, rows: DataFrame, part: str, parts: Sequence[int], folder: str) -> None:
    """Write the rows of each part as a file of its own, one after the other."""
    for k in parts:
        rows.filter(F.col(part) == k).drop(part).coalesce(1).write.mode("append").parquet(folder)


#: Which of five parts of six days an event arrives in, up to 18 hours late.
ARRIVAL = "CAST(least(4, floor((unix_timestamp(at) - unix_timestamp(began) + event_id % 7 * 10800) / 518400)) AS INT)"


@query("""WITH e AS (SELECT event_id, user_id, ts, event_type FROM events WHERE epoch_ms(ts) <= (SELECT max(epoch_ms(ts)) FROM events) - 86400000),
c AS (SELECT event_id, user_id, event_type, lag(event_type) OVER w AS l, row_number() OVER w AS n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type FROM c WHERE n = 1 OR event_type IS DISTINCT FROM l""")
def str_change_stream(t: Tables) -> DataFrame:
    """STR-02: the stream of changes by keyed state and timers, over events that come up to 18 hours late in several batches, stopped and started again."""
    folder, out, seen = (snapshots.scratch(t.spark, x) for x in ("arrivals", "stream", "progress"))
    rows = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("at"), "event_type")
    rows = rows.crossJoin(F.broadcast(rows.agg(F.min("at").alias("began")))).withColumn("part", F.expr(ARRIVAL)).drop("began")
    for parts in ((0, 1, 2), (3, 4)):
        in_parts(t, rows, "part", parts, folder)
        stream = snapshots.ordered_changes(snapshots.read(t.spark, folder, rows.drop("part").schema, 1), ["user_id"], "at", "event_type", "1 day", order=["event_id"])
        snapshots.append(stream, out, seen).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY 1")
def str_latest(t: Tables) -> DataFrame:
    """STR-04: the latest snapshot of each key; a batch rewrites only the buckets of its keys, and one that is sent again changes nothing."""
    path, seen = snapshots.scratch(t.spark, "table"), snapshots.scratch(t.spark, "progress")
    rows = arriving(t).select("user_id", "ts", "value")
    table = keyed.KeyedTable(t.spark, path, rows.schema, ["user_id"], 8)
    merge = table.sink("snapshots", keyed.latest(["user_id"], ["ts"]))
    rows.writeStream.foreachBatch(lambda batch, n: (merge(batch, n), merge(batch, n)) and None).option("checkpointLocation", seen).trigger(availableNow=True).start().awaitTermination()
    return table.read()


@query("SELECT n_nationkey AS id, n_regionkey AS scope, concat(n_name, CASE WHEN n_regionkey < 2 THEN '-late' ELSE '' END) AS name FROM nation WHERE n_regionkey >= 2 OR n_nationkey % 2 = 0")
def str_corrections(t: Tables) -> DataFrame:
    """STR-05: a late correction replaces its scope; buckets of other scopes keep their files."""
    folder, path, seen = (snapshots.scratch(t.spark, x) for x in ("arrivals", "table", "progress"))
    rows = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("scope"), F.col("n_name").alias("name"))
    late = rows.filter("scope < 2 and id % 2 = 0").withColumn("name", F.concat("name", F.lit("-late")))
    table = keyed.KeyedTable(t.spark, path, rows.schema, ["scope"], 16)
    for part in (rows, late):
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = snapshots.read(t.spark, folder, rows.schema).writeStream.foreachBatch(table.sink("corrections", keyed.scopes(["scope"])))
        stream.option("checkpointLocation", seen).trigger(availableNow=True).start().awaitTermination()
    return table.read()


@query("""SELECT 'events' AS tab, 'props' AS field, count(*) AS n, count(props) AS filled, count(DISTINCT props) AS kinds, min(props) AS least, max(props) AS most FROM events
UNION ALL SELECT 'events', 'event_type', count(*), count(event_type), count(DISTINCT event_type), min(event_type), max(event_type) FROM events
UNION ALL SELECT 'orders', 'o_orderstatus', count(*), count(o_orderstatus), count(DISTINCT o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM orders""")
def dq_census(t: Tables) -> DataFrame:
    """DQ-15: what each field of each table holds, one pass per table."""
    return quality.census({"events": t.events.select("props", "event_type"), "orders": t.orders.select("o_orderstatus")}).drop("low", "high")


#: Columns of the driver's tables by kind: n numbers, t times, s texts and lists.
FIELDS = {
    "region": {"n": "r_regionkey", "s": "r_name"}, "nation": {"n": "n_nationkey n_regionkey", "s": "n_name"}, "customer": {"n": "c_custkey c_nationkey c_acctbal", "s": "c_name c_mktsegment"},
    "supplier": {"n": "s_suppkey s_nationkey s_acctbal", "s": "s_name"}, "part": {"n": "p_partkey p_size p_retailprice", "s": "p_name p_brand p_type"},
    "orders": {"n": "o_orderkey o_custkey o_totalprice", "t": "o_orderdate", "s": "o_orderstatus o_orderpriority"},
    "lineitem": {"n": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax", "t": "l_shipdate", "s": "l_returnflag l_linestatus"},
    "events": {"n": "event_id user_id value", "t": "ts", "s": "event_type props"},
    "documents": {"n": "doc_id n_chars", "s": "text lang source"}, "pages": {"n": "page_id", "s": "url html"}, "benchmark": {"n": "item_id", "s": "text"}, "labels": {"n": "doc_id quality toxic"}, "conversations": {"n": "conv_id turn", "s": "role text"}, "embeddings": {"n": "vec_id label", "s": "embedding"},
}
EDGES = {"n": "min({c})::DOUBLE AS low, max({c})::DOUBLE AS high", "t": "epoch_us(min({c})) / 1e6 AS low, epoch_us(max({c})) / 1e6 AS high", "s": "NULL::DOUBLE AS low, NULL::DOUBLE AS high"}
CENSUS_SQL = " UNION ALL ".join(
    f"SELECT '{tab}' AS tab, '{c}' AS field, count(*) AS n, count({c}) AS filled, count(DISTINCT {c}) AS kinds, {EDGES[kind].format(c=c)} FROM {tab}" for tab, kinds in FIELDS.items() for kind, names in kinds.items() for c in names.split()
)


def all_tables(t: Tables) -> DataFrame:
    found = {tab: getattr(t, tab) for tab in FIELDS}
    return quality.census({tab: df.select(*[c for names in FIELDS[tab].values() for c in names.split()]) for tab, df in found.items()}).drop("least", "most")


@query(CENSUS_SQL)
def dq_census_all(t: Tables) -> DataFrame:
    """DQ-15: what every field of every table holds, distinct values counted exactly."""
    return all_tables(t)


@query(f"""SELECT tab, field, CASE WHEN filled = 0 THEN 'empty' WHEN kinds = 1 THEN 'constant' WHEN kinds = n AND filled = n THEN 'key' WHEN regexp_matches(field, '(key|_id)$') THEN 'reference'
WHEN low IS NOT NULL AND kinds > 100 THEN 'measure' ELSE 'category' END AS part FROM ({CENSUS_SQL})""")
def dq_field_parts(t: Tables) -> DataFrame:
    """DQ-20: the part each field plays, by ordered rules over its values."""
    return quality.classified(all_tables(t)).select("tab", "field", "part")


@query("""SELECT n_nationkey AS id, n_regionkey::VARCHAR AS v, NULL::VARCHAR AS name, NULL::BIGINT AS keys FROM nation
UNION ALL SELECT n_nationkey + 3000000000, concat(n_regionkey, '.5'), NULL, NULL FROM nation UNION ALL SELECT n_nationkey, concat('r', n_regionkey), n_name, n_nationkey + 1 FROM nation WHERE n_regionkey < 3""")
def snk_evolve(t: Tables) -> DataFrame:
    """SNK-05: rows of three appends under the widest schema: whole numbers become decimals and then text, columns come in later."""
    table = evolve.EvolvingTable(t.spark, snapshots.scratch(t.spark, "evolving"))
    table.append(t.nation.select(F.col("n_nationkey").cast("int").alias("id"), F.col("n_regionkey").cast("int").alias("v")))
    table.append(t.nation.select((F.col("n_nationkey") + F.lit(3000000000)).cast("bigint").alias("id"), (F.col("n_regionkey") + F.lit(0.5)).cast("double").alias("V")))
    table.append(t.nation.filter("n_regionkey < 3").select(F.col("n_name").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("v"), F.col("n_nationkey").cast("int").alias("id"), F.struct((F.col("n_nationkey") + 1).cast("bigint").alias("key")).alias("more")))
    return table.read().select("id", "v", "name", F.col("more.key").alias("keys"))


@query("""WITH c AS (SELECT *, CASE WHEN o_orderkey % 1000 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS later FROM orders)
SELECT 0 AS side, o_orderkey, o_totalprice FROM c WHERE later <> o_totalprice OR o_orderkey % 1000 = 2 UNION ALL SELECT 1, o_orderkey, later FROM c WHERE later <> o_totalprice AND o_orderkey % 1000 <> 2""")
def ml_snapshots(t: Tables) -> DataFrame:
    """ML-04: two frozen states of the orders and the rows that differ, read from the buckets whose digests do."""
    store = frozen.Store(t.spark, snapshots.scratch(t.spark, "frozen"))
    rows = t.orders.select("o_orderkey", "o_totalprice")
    later = rows.filter("o_orderkey % 1000 <> 2").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    one, other = store.freeze(rows, ["o_orderkey"]), store.freeze(later.repartition(3, "o_totalprice"), ["o_orderkey"])
    return store.changed_rows(one, other)


@query("SELECT year(o_orderdate) AS season, count(*) AS n, round(avg(o_totalprice), 6) AS mean, k = 1 AS found FROM orders, range(2) r(k) GROUP BY 1, k")
def ml_reuse(t: Tables) -> DataFrame:
    """ML-16: one experiment asked for twice, the second time from a snapshot written anew in another order: computed, then found."""
    store = frozen.Store(t.spark, snapshots.scratch(t.spark, "frozen"))
    out = None
    for rows in (t.orders, t.orders.repartition(5, "o_custkey")):
        digest = store.freeze(rows, ["o_orderkey"])
        _, result, found = store.once(digest, {"by": "season"}, lambda df: df.groupBy(F.year("o_orderdate").cast("long").alias("season")).agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 6).alias("mean")))
        part = result.withColumn("found", F.lit(found))
        out = part if out is None else out.unionByName(part)
    return out


@query("""WITH x AS (SELECT n_regionkey AS region, string_agg(concat('{"id":', n_nationkey, ',"name":"', n_name, '"}'), chr(10) ORDER BY n_nationkey) AS body FROM nation GROUP BY 1)
SELECT region, concat(sha256(body), '.json') AS name, strlen(body)::BIGINT AS size, region <> 1 AS written FROM x""")
def snk_artifacts(t: Tables) -> DataFrame:
    """SNK-11: artifacts named by the digest of what they hold, written once: those of one region are there already."""
    path = snapshots.scratch(t.spark, "artifacts")
    rows = t.nation.select(F.col("n_regionkey").alias("region"), "n_nationkey", F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")).alias("row"))
    sinks.write_artifacts(rows.filter("region = 1"), ["region"], ["n_nationkey"], "row", path)
    return sinks.write_artifacts(rows, ["region"], ["n_nationkey"], "row", path)


@query("""SELECT 'c_custkey' AS field, 'key' AS lineage UNION ALL SELECT 'c_nationkey', 'key' UNION ALL SELECT 'c_name', 'mapped' UNION ALL SELECT 'c_acctbal', 'measure' UNION ALL SELECT 'c_mktsegment', 'unmapped'""")
def dq_lineage(t: Tables) -> DataFrame:
    """DQ-20: each field under the first rule that fits."""
    rules = [("key", "key$"), ("mapped", "^c_name$"), ("measure", "bal$|price$")]
    return quality.lineage(t.spark, {"customer": t.customer}, rules).select("field", "lineage")


PLAYS_A_TASK = 100_000
#: Event texts by number, for files made of lineitem.
EVENT_TEXTS = (
    "S8/L8.3-H;2-3;1-2", "D7/F7.3-H;2-H;1-3", "T9/F9LD.3-H;2-H;1-H", "HR/F78XD", "W.3-H;2-3;1-2", "K", "63/G6.2-3", "64(1)3/GDP/G6", "54(1)/FO/G5.B-1", "E6/G6.1-2;2-3;3-H(UR)(NR)",
    "SB2", "CS2(26)", "FC5/G5.1X2(54);B-1", "WP.3-H;2-3;1-2", "8/SF/F8D.3-H", "HP.3-H;2-3;1-2",
)


@query("""WITH RECURSIVE ev(k, cd, db, d1, d2, d3, o, ball, po, ass, err, dp, wp, sf, ab, rbi) AS (VALUES
(0, 20, 1, 2, 3, 4, 0, 'L', 0, 0, 0, FALSE, FALSE, FALSE, TRUE, TRUE), (1, 21, 2, 3, 4, 4, 0, 'F', 0, 0, 0, FALSE, FALSE, FALSE, TRUE, TRUE), (2, 22, 3, 4, 4, 4, 0, 'F', 0, 0, 0, FALSE, FALSE, FALSE, TRUE, TRUE),
(3, 23, 4, 4, 4, 4, 0, 'F', 0, 0, 0, FALSE, FALSE, FALSE, TRUE, TRUE), (4, 14, 1, 2, 3, 4, 0, NULL, 0, 0, 0, FALSE, FALSE, FALSE, FALSE, TRUE), (5, 3, 0, 1, 2, 3, 1, NULL, 2, 0, 0, FALSE, FALSE, FALSE, TRUE, FALSE),
(6, 2, 0, 1, 3, 3, 1, 'G', 3, 6, 0, FALSE, FALSE, FALSE, TRUE, TRUE), (7, 2, 0, 0, 2, 3, 2, 'G', 4, 6, 0, TRUE, FALSE, FALSE, TRUE, FALSE), (8, 2, 1, 0, 2, 3, 1, 'G', 4, 5, 0, FALSE, FALSE, FALSE, TRUE, TRUE),
(9, 18, 1, 2, 3, 5, 0, 'G', 0, 0, 6, FALSE, FALSE, FALSE, TRUE, FALSE), (10, 4, 0, 2, 2, 3, 0, NULL, 0, 0, 0, FALSE, FALSE, FALSE, FALSE, FALSE), (11, 6, 0, 0, 2, 3, 1, NULL, 6, 2, 0, FALSE, FALSE, FALSE, FALSE, FALSE),
(12, 19, 1, 0, 2, 3, 1, 'G', 4, 5, 0, FALSE, FALSE, FALSE, TRUE, TRUE), (13, 9, 0, 2, 3, 4, 0, NULL, 0, 0, 0, FALSE, TRUE, FALSE, FALSE, FALSE), (14, 2, 0, 1, 2, 4, 1, 'F', 8, 0, 0, FALSE, FALSE, TRUE, FALSE, TRUE),
(15, 16, 1, 2, 3, 4, 0, NULL, 0, 0, 0, FALSE, FALSE, FALSE, FALSE, TRUE)),
p AS (SELECT l_orderkey AS g, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) AS n, concat('p', l_suppkey) AS bat, (l_partkey + l_linenumber) % 16 AS k FROM lineitem),
w AS (SELECT DISTINCT g, 0::BIGINT AS n, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3, 0 AS s_outs, NULL::VARCHAR AS b1, NULL::VARCHAR AS b2, NULL::VARCHAR AS b3, 0 AS outs, 0::BIGINT AS k FROM p
  UNION ALL
  SELECT g, n, s1, s2, s3, s_outs, CASE WHEN db = 1 THEN bat WHEN d1 = 1 THEN s1 END,
    coalesce(CASE WHEN db = 2 THEN bat END, CASE WHEN d1 = 2 THEN s1 END, CASE WHEN d2 = 2 THEN s2 END),
    coalesce(CASE WHEN db = 3 THEN bat END, CASE WHEN d1 = 3 THEN s1 END, CASE WHEN d2 = 3 THEN s2 END, CASE WHEN d3 = 3 THEN s3 END), s_outs + o, k
  FROM (SELECT w.g, p.n, p.bat, p.k, ev.db, ev.d1, ev.d2, ev.d3, ev.o, CASE WHEN p.n % 4 <> 1 THEN b1 END AS s1, CASE WHEN p.n % 4 <> 1 THEN b2 END AS s2, CASE WHEN p.n % 4 <> 1 THEN b3 END AS s3, CASE WHEN p.n % 4 <> 1 THEN outs ELSE 0 END AS s_outs
        FROM w JOIN p ON p.g = w.g AND p.n = w.n + 1 JOIN ev ON ev.k = p.k)),
x AS (SELECT *, (n + 3) // 4 AS inn, (db = 4)::INT + (s1 IS NOT NULL AND d1 >= 4)::INT + (s2 IS NOT NULL AND d2 >= 4)::INT + (s3 IS NOT NULL AND d3 >= 4)::INT AS came FROM w JOIN ev USING (k) WHERE n > 0)
SELECT concat('G', g) AS game_id, n::INT AS event_id, inn::INT AS inn_ct, s_outs AS outs_ct, s1 AS base1_run_id, s2 AS base2_run_id, s3 AS base3_run_id, cd AS event_cd, o AS event_outs_ct, db AS bat_dest_id,
CASE WHEN s1 IS NULL THEN 0 ELSE d1 END AS run1_dest_id, CASE WHEN s2 IS NULL THEN 0 ELSE d2 END AS run2_dest_id, CASE WHEN s3 IS NULL THEN 0 ELSE d3 END AS run3_dest_id, came AS event_runs_ct, CASE WHEN rbi THEN came ELSE 0 END AS rbi_ct,
coalesce(sum(came) OVER (PARTITION BY g ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS away_score_ct, coalesce(sum(came) OVER (PARTITION BY g, inn ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::INT AS fate_runs_ct,
(s1 IS NOT NULL)::INT + 2 * (s2 IS NOT NULL)::INT + 4 * (s3 IS NOT NULL)::INT AS start_bases_cd, (b1 IS NOT NULL)::INT + 2 * (b2 IS NOT NULL)::INT + 4 * (b3 IS NOT NULL)::INT AS end_bases_cd,
ball AS battedball_cd, po AS po1_fld_cd, ass AS ass1_fld_cd, err AS err1_fld_cd, dp AS dp_fl, wp AS wp_fl, sf AS sf_fl, ab AS ab_fl, greatest(cd - 19, 0) * (cd >= 20)::INT AS h_cd, concat('h', g % 5) AS pit_id, CASE WHEN s1 IS NOT NULL THEN concat('h', g % 5) END AS run1_resp_pit_id, n % 4 = 1 AS inn_new_fl
FROM x""")
def src_play_columns(t: Tables) -> DataFrame:
    """SRC-04: event texts taken apart, and the walk of outs, runners and scores along each game's half-innings."""
    path = snapshots.scratch(t.spark, "events")
    plays = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey")))
    text = F.array(*map(F.lit, EVENT_TEXTS))
    line = lambda x, i: F.concat(F.lit("play,"), F.floor(i / 4) + 1, F.lit(",0,p"), x.l_suppkey, F.lit(",01,CX,"), F.get(text, ((x.l_partkey + x.l_linenumber) % 16).cast("int")))
    games = t.lineitem.groupBy("l_orderkey").agg(plays.alias("plays"))
    start = F.concat(F.lit("id,G"), "l_orderkey", F.lit("\nversion,2\nstart,h"), F.col("l_orderkey") % 5, F.lit(',"A pitcher",1,0,1\n'))
    games.select(F.concat(start, F.array_join(F.transform("plays", line), "\n")).alias("value")).write.text(path)
    # A task walks the games of some PLAYS_A_TASK records, however many there are.
    parts = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // PLAYS_A_TASK))
    rows = plays_source.play_rows(readers.event_records(t.spark, path), parts)
    return rows.select(
        "game_id", "event_id", "inn_ct", "outs_ct", "base1_run_id", "base2_run_id", "base3_run_id", "event_cd", "event_outs_ct", "bat_dest_id", "run1_dest_id", "run2_dest_id", "run3_dest_id", "event_runs_ct", "rbi_ct", "away_score_ct",
        "fate_runs_ct", "start_bases_cd", "end_bases_cd", "battedball_cd", "po1_fld_cd", "ass1_fld_cd", "err1_fld_cd", "dp_fl", "wp_fl", "sf_fl", "ab_fl", "h_cd", "pit_id", "run1_resp_pit_id", "inn_new_fl",
    )


@query(f"""SELECT event_cd, count(*) AS n, count(*) FILTER (bit_count(start_bases_cd) + (event_cd IN (2, 3, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23))::INT <> bit_count(end_bases_cd) + event_outs_ct + event_runs_ct) AS broken,
sum(event_runs_ct)::BIGINT AS runs, sum(event_outs_ct)::BIGINT AS outs FROM ({ORACLE_SQL['src_play_columns']}) GROUP BY 1""")
def seq_conservation(t: Tables) -> DataFrame:
    """SEQ-03: of the transitions of all plays, those that lose or make a runner: who was on base or at bat is after the play on base, out or in."""
    return sequence.runners_kept(src_play_columns(t), "event_cd")
