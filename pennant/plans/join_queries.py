"""Queries on join shapes and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.operators import joins, sets, windows
from pennant.plans.registry import Tables, query



def year() -> Column:
    return F.year("o_orderdate").cast("long")



@query("""SELECT n_name, r_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def join_inner(t: Tables) -> DataFrame:
    """JON-01: facts with their dimensions."""
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return df.groupBy("n_name", "r_name").agg(F.count("*").alias("n_customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


SIDES_SQL = """g AS (SELECT l_orderkey, min(c_nationkey) AS home, min(s_nationkey) AS away, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey)"""


def games(t: Tables) -> DataFrame:
    """Orders as games: the customer's nation at home, the least nation of its suppliers away."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.groupBy("l_orderkey").agg(F.min("s_nationkey").alias("away"), F.count("*").alias("n"))
    homes = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(homes, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", F.col("c_nationkey").alias("home"), "away", "n")


@query(f"""WITH {SIDES_SQL} SELECT l_orderkey, h.n_name AS home_n_name, a.n_name AS away_n_name FROM g LEFT JOIN nation h ON home = h.n_nationkey LEFT JOIN nation a ON away = a.n_nationkey""")
def join_two_aliases(t: Tables) -> DataFrame:
    """JON-02: one dimension under two aliases."""
    return joins.by_both_names(games(t), t.nation, "n_nationkey", {"home": "home", "away": "away"}, ["n_name"]).select("l_orderkey", "home_n_name", "away_n_name")


@query("""WITH e AS (SELECT o_custkey AS k, min(year(o_orderdate)) AS a, min(year(o_orderdate)) + 2 AS b FROM orders GROUP BY 1)
SELECT o_orderkey, a::BIGINT AS era_first, b::BIGINT AS era_last FROM orders JOIN e ON o_custkey = k AND year(o_orderdate) BETWEEN a AND b""")
def join_era(t: Tables) -> DataFrame:
    """JON-03: orders inside of their customer's first three years."""
    o = t.orders.withColumns({"k": F.col("o_custkey"), "season": year()})
    eras = o.groupBy("k").agg(F.min("season").alias("era_first")).withColumn("era_last", F.col("era_first") + 2)
    return joins.era_join(o, eras, ["k"], "season", "era_first", "era_last").select("o_orderkey", "era_first", "era_last")


SEASONS_SQL = "s AS (SELECT c_nationkey AS nation, year(o_orderdate) AS season, avg(o_totalprice) AS mean FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"


def nation_seasons(t: Tables) -> DataFrame:
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("c_nationkey").alias("nation"), year().alias("season")).agg(F.avg("o_totalprice").alias("mean"))


@query(f"""WITH {SEASONS_SQL} SELECT n.nation, n.season::BIGINT AS season, round(avg(b.mean), 4) AS trailing_mean FROM s n LEFT JOIN s b
ON b.nation = n.nation AND b.season BETWEEN n.season - 3 AND n.season - 1 GROUP BY ALL""")
def join_trailing_seasons(t: Tables) -> DataFrame:
    """JON-04: mean over the three seasons before."""
    df = joins.trailing_seasons(nation_seasons(t), "nation", "season", {"m": "mean"})
    return df.select("nation", "season", F.round("m", 4).alias("trailing_mean"))


@query("""SELECT a.o_orderkey, count(b.o_orderkey) AS n_history, round(sum(b.o_totalprice), 4) AS spent_90d FROM orders a LEFT JOIN orders b
ON a.o_custkey = b.o_custkey AND b.o_orderdate < a.o_orderdate AND b.o_orderdate >= a.o_orderdate - INTERVAL 90 DAY GROUP BY 1""")
def join_history(t: Tables) -> DataFrame:
    """JON-05: history strictly before, at most 90 days back."""
    df = joins.history_sums(t.orders, t.orders, "o_custkey", "o_orderdate", "o_orderdate", {"s": "o_totalprice"}, 90)
    return df.select("o_orderkey", "n_history", F.round("s", 4).alias("spent_90d"))


@query("""WITH e AS (SELECT * FROM events WHERE event_type = 'error'), p AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT e.event_id, max(p.ts) AS last_ts, arg_max(p.value, p.ts) AS last_value FROM e LEFT JOIN p ON e.user_id = p.user_id AND p.ts < e.ts GROUP BY 1""")
def join_as_of(t: Tables) -> DataFrame:
    """JON-06: the latest purchase strictly before each error."""
    kind = lambda k: t.events.filter(F.col("event_type") == k)
    return joins.as_of(kind("error"), kind("purchase").select("user_id", "ts", "value"), ["user_id"], "ts", "ts", ["value"]).select("event_id", "last_ts", "last_value")


@query("""SELECT c_custkey, o.o_orderkey AS first_big FROM customer LEFT JOIN LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000
ORDER BY o_orderdate, o_orderkey LIMIT 1) o ON true""")
def join_lateral(t: Tables) -> DataFrame:
    """JON-07: one candidate per row, by a total order."""
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_totalprice") > 300000)
    orders = t.orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderkey")
    df = joins.first_match(t.customer, orders, on, ["c_custkey"], [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey")], ["o_orderkey"])
    return df.select("c_custkey", F.col("o_orderkey").alias("first_big"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def join_anti(t: Tables) -> DataFrame:
    """JON-08: customers without a pending order."""
    return joins.exists(t.customer, t.orders.filter("o_orderstatus = 'P'"), F.col("o_custkey") == F.col("c_custkey"), negate=True).select("c_custkey")


@query("SELECT s_suppkey FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49 AND l_discount BETWEEN 0.05 AND 0.06)")
def join_semi(t: Tables) -> DataFrame:
    """JON-09: suppliers with a matching line."""
    lines = t.lineitem.filter((F.col("l_quantity") > 49) & F.col("l_discount").between(0.05, 0.06))
    return joins.exists(t.supplier, lines, F.col("l_suppkey") == F.col("s_suppkey")).select("s_suppkey")


@query("""SELECT o_orderkey FROM orders a WHERE (SELECT count(*) FROM orders b WHERE a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate) = 1""")
def join_unique_guard(t: Tables) -> DataFrame:
    """JON-10: orders alone on their customer and day."""
    return joins.only_unambiguous(t.orders, ["o_custkey", "o_orderdate"]).select("o_orderkey")


@query(f"""WITH {SIDES_SQL} SELECT n_nationkey AS nation, count(*) AS n_games FROM nation JOIN g ON home = n_nationkey OR away = n_nationkey GROUP BY 1""")
def join_either_side(t: Tables) -> DataFrame:
    """JON-11: games in which a nation is on either side."""
    sides = joins.either_side(games(t), {"home": "home", "away": "away"}, "nation", ["l_orderkey"]).select("l_orderkey", "nation").distinct()
    return sides.groupBy("nation").agg(F.count("*").alias("n_games"))


@query("""SELECT c_custkey, n_nationkey FROM customer JOIN nation ON 'nation_' || c_nationkey = lower(trim(n_name)) WHERE c_custkey < 100000000""")
def join_derived_key(t: Tables) -> DataFrame:
    """JON-12, JON-13, JON-18: join on a key made from other columns."""
    c = t.customer.withColumn("name_key", F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")))
    n = t.nation.withColumn("name_key", joins.normalised(F.col("n_name")))
    return c.join(n, "name_key").select("c_custkey", "n_nationkey")


@query("""SELECT o_orderkey, label FROM orders JOIN (VALUES ('F', 'final'), ('P', 'partial'), ('O', 'open')) m(code, label) ON o_orderstatus = code""")
def join_literal_map(t: Tables) -> DataFrame:
    """JON-14: join to a literal map."""
    m = joins.literal_map(t.spark, {"F": "final", "P": "partial", "O": "open"}, "code", "label")
    return t.orders.join(F.broadcast(m), F.col("o_orderstatus") == F.col("code")).select("o_orderkey", "label")


@query("""WITH a AS (SELECT c_custkey AS k, c_nationkey AS v FROM customer WHERE c_custkey % 7 <> 0), b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS v
FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 10 = 0), j AS (SELECT k, a.v AS a_v, b.v AS b_v, a.p IS NULL AS na, b.p IS NULL AS nb FROM (SELECT *, 1 AS p FROM a) a FULL JOIN (SELECT *, 1 AS p FROM b) b USING (k))
SELECT k, a_v, b_v, CASE WHEN nb THEN 'only_a' WHEN na THEN 'only_b' ELSE 'differs' END AS status FROM j WHERE na OR nb OR a_v IS DISTINCT FROM b_v""")
def join_parity(t: Tables) -> DataFrame:
    """JON-15: where two versions of a table differ."""
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("v"))
    a = c.filter("k % 7 <> 0")
    b = c.filter("k % 5 <> 0 or k % 10 = 0").withColumn("v", F.when(F.col("k") % 10 != 0, F.col("v")))
    return joins.parity(a, b, ["k"], ["v"])


@query(f"""WITH {SEASONS_SQL} SELECT a.nation, a.season::BIGINT AS season, round(b.mean, 4) AS prior_mean FROM s a LEFT JOIN s b ON a.nation = b.nation AND b.season = a.season - 1""")
def join_prior_season(t: Tables) -> DataFrame:
    """JON-16: the season before."""
    s = nation_seasons(t)
    return joins.prior_season(s.select("nation", "season"), s, "nation", "season", ["mean"]).select("nation", "season", F.round("prior_mean", 4).alias("prior_mean"))


@query("""SELECT user_id, max(value) FILTER (event_type = 'purchase') AS purchase, max(value) FILTER (event_type = 'error') AS error, max(value) FILTER (event_type = 'click') AS click
FROM events GROUP BY 1 HAVING purchase IS NOT NULL AND error IS NOT NULL""")
def join_wide(t: Tables) -> DataFrame:
    """JON-17: one column per name, rows without the required ones gone."""
    return joins.wide(t.events, ["user_id"], "event_type", "value", ["purchase", "error"], ["click"])


@query("""SELECT s.side, n_name, count(*) AS n FROM (SELECT 'customer' AS side, c_nationkey AS k FROM customer UNION ALL SELECT 'supplier', s_nationkey FROM supplier) s JOIN nation ON k = n_nationkey GROUP BY ALL""")
def set_union_sides(t: Tables) -> DataFrame:
    """SET-01, SET-02: two sides as one tall table."""
    tall = sets.stacked([t.customer.select(F.lit("customer").alias("side"), F.col("c_nationkey").alias("k")), t.supplier.select(F.lit("supplier").alias("side"), F.col("s_nationkey").alias("k"))])
    return tall.join(t.nation, F.col("k") == F.col("n_nationkey")).groupBy("side", "n_name").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, year(l_shipdate)::BIGINT AS season FROM lineitem")
def set_distinct(t: Tables) -> DataFrame:
    """SET-03."""
    return t.lineitem.select("l_returnflag", "l_linestatus", F.year("l_shipdate").cast("long").alias("season")).distinct()


@query("""SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def set_in_all(t: Tables) -> DataFrame:
    """SET-04: customers in every one of three sets."""
    return sets.in_all([t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in "FPO"])


@query("""(SELECT o_custkey, o_orderstatus, 'a' AS side FROM (SELECT o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 100 <> 0))
UNION ALL (SELECT o_custkey, o_orderstatus, 'b' FROM (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 100 <> 0 EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders))""")
def set_difference(t: Tables) -> DataFrame:
    """SET-05: multiset difference in both directions."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return sets.difference(rows.drop("o_orderkey"), rows.filter("o_orderkey % 100 <> 0").drop("o_orderkey"))


@query("""SELECT 'customer' AS name, count(*) AS n_rows, count(DISTINCT c_nationkey) AS n_keys, NULL::BIGINT AS latest FROM customer
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey), max(year(o_orderdate)) FROM orders""")
def set_summaries(t: Tables) -> DataFrame:
    """SET-06: one row per table."""
    return sets.summaries({"customer": t.customer, "orders": t.orders.withColumn("season", year())}, "season", {"customer": "c_nationkey", "orders": "o_custkey"})


@query("""WITH s AS (SELECT o_orderkey, o_custkey FROM orders QUALIFY row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) <= 3),
k AS (SELECT o_custkey AS id FROM s UNION SELECT s_suppkey FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN s ON l_orderkey = o_orderkey)
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT id FROM k)""")
def set_closure_sample(t: Tables) -> DataFrame:
    """SET-07, DQ-17: a stratified sample, and the rows it refers to."""
    sample = windows.first_by(t.orders.withColumn("season", year()), ["season"], ["o_orderkey"], 3).select("o_orderkey", "o_custkey")
    suppliers = t.lineitem.join(sample, F.col("l_orderkey") == F.col("o_orderkey")).select("l_suppkey").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    ids = sets.closure({"customer": (sample, "o_custkey"), "supplier": (suppliers, "s_suppkey")}, "id")
    return joins.exists(t.customer, ids, F.col("id") == F.col("c_custkey")).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey LIMIT 25")
def sort_top(t: Tables) -> DataFrame:
    """SRT-01, SRT-02: the first rows of a total order."""
    return sets.top(t.customer, sets.total_order(["c_mktsegment", "c_acctbal", "c_custkey"], ["c_acctbal"]), 25).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("SELECT o_orderkey FROM orders LEFT JOIN (SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 10 GROUP BY 1) ON o_orderkey = k WHERE k IS NULL ORDER BY o_orderkey LIMIT 50")
def sort_next_batch(t: Tables) -> DataFrame:
    """SRT-03: the next rows that lack a key."""
    keyed = t.orders.join(t.lineitem.filter("l_quantity > 10").select(F.col("l_orderkey").alias("k")).distinct(), F.col("o_orderkey") == F.col("k"), "left")
    return sets.next_batch(keyed, "k", ["o_orderkey"], 50).select("o_orderkey")
