"""Queries on aggregates, cleaning expressions and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.functions import clean
from pennant.operators import aggregates, quality, quantile
from pennant.plans.registry import Tables, query

#: Weights of event types, as the linear weights of plate appearances are.
WEIGHTS = {"n_view": 0.69, "n_click": 0.878, "n_purchase": 2.015}
KINDS = ("view", "click", "purchase", "error")


def user_counts(t: Tables) -> DataFrame:
    kinds = {f"n_{k}": F.col("event_type") == k for k in KINDS}
    return aggregates.count_where(t.events, ["user_id"], kinds, n_events=F.count("*"))


COUNTS_SQL = "c AS (SELECT user_id, count(*) AS n_events, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS n_{k}" for k in KINDS) + " FROM events GROUP BY 1)"


@query(f"WITH {COUNTS_SQL} SELECT * FROM c")
def agg_count_where(t: Tables) -> DataFrame:
    """AGG-01: filtered counts."""
    return user_counts(t).select("user_id", "n_events", *[f"n_{k}" for k in KINDS])


@query("""SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 40 THEN 'middle' ELSE 'large' END AS size, count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1""")
def agg_by_case(t: Tables) -> DataFrame:
    """AGG-02: groups by a case expression."""
    size = F.when(F.col("l_quantity") < 10, "small").when(F.col("l_quantity") < 40, "middle").otherwise("large")
    return t.lineitem.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("""SELECT o_custkey, max(o_orderkey) FILTER (o_orderstatus = 'F') AS last_final, bool_or(o_totalprice > 400000) AS any_big,
round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS pending FROM orders GROUP BY 1""")
def agg_pick(t: Tables) -> DataFrame:
    """AGG-03, AGG-04: filtered picks, sums and any()."""
    status = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(
        aggregates.pick_where(F.col("o_orderkey"), status == "F").alias("last_final"), F.bool_or(F.col("o_totalprice") > 400000).alias("any_big"),
        F.round(F.sum(F.when(status == "P", F.col("o_totalprice"))), 2).alias("pending"),
    )


@query("SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_suppliers, max(l_quantity) AS top FROM lineitem GROUP BY 1 HAVING max(l_quantity) = 50 AND count(DISTINCT l_suppkey) > 4")
def agg_having(t: Tables) -> DataFrame:
    """AGG-05, AGG-09: groups by a condition on their aggregates."""
    rows = t.lineitem.groupBy("l_orderkey").agg(F.countDistinct("l_suppkey").alias("n_suppliers"), F.max("l_quantity").alias("top"))
    return rows.filter((F.col("top") == 50) & (F.col("n_suppliers") > 4))


@query("SELECT c_nationkey AS nation, round(sum(o_totalprice * c_acctbal) / nullif(sum(c_acctbal), 0), 3) AS weighted FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 1")
def agg_weighted_mean(t: Tables) -> DataFrame:
    """AGG-06: mean by weight."""
    df = t.orders.join(t.customer.filter("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"))
    return df.groupBy(F.col("c_nationkey").alias("nation")).agg(F.round(aggregates.weighted_mean(F.col("o_totalprice"), F.col("c_acctbal")), 3).alias("weighted"))


@query(f"WITH {COUNTS_SQL} SELECT user_id, CASE WHEN n_view + n_click + n_purchase >= 20 THEN round((0.69 * n_view + 0.878 * n_click + 2.015 * n_purchase)::DOUBLE / (n_view + n_click + n_purchase), 6) END AS weight FROM c")
def agg_linear_weights(t: Tables) -> DataFrame:
    """AGG-07: weighted sum of counts per opportunity."""
    return user_counts(t).select("user_id", F.round(aggregates.linear_weights(WEIGHTS, list(WEIGHTS), 20), 6).alias("weight"))


@query("""WITH k AS (SELECT s_suppkey, s_nationkey, round(sum(l_extendedprice), 2) AS p FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT s_suppkey, s_nationkey, round(100 * p / sum(p) OVER (PARTITION BY s_nationkey), 6) AS share FROM k""")
def agg_league(t: Tables) -> DataFrame:
    """AGG-08: team totals against league totals."""
    lines = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = aggregates.with_league(lines, ["s_nationkey", "s_suppkey"], ["s_nationkey"], ["l_extendedprice"])
    return rows.select("s_suppkey", "s_nationkey", F.round(100 * F.col("l_extendedprice") / F.col("league_l_extendedprice"), 6).alias("share"))


@query("""WITH v AS (SELECT user_id, event_type, count(*) AS votes FROM events GROUP BY ALL)
SELECT user_id, event_type, votes FROM v QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, event_type) = 1""")
def agg_majority(t: Tables) -> DataFrame:
    """AGG-10: most frequent candidate, the lesser on a tie."""
    return aggregates.majority(t.events, ["user_id"], "event_type")


@query("SELECT o_custkey, o_orderdate::DATE AS day, min(o_orderpriority) AS priority FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderpriority) = 1")
def agg_unambiguous(t: Tables) -> DataFrame:
    """AGG-11: keys with one distinct value."""
    rows = t.orders.withColumn("day", F.to_date("o_orderdate"))
    return aggregates.unambiguous(rows, ["o_custkey", "day"], "o_orderpriority").withColumnRenamed("o_orderpriority", "priority")


@query("""WITH g AS (SELECT c_nationkey AS nation, year(o_orderdate) AS season, o_orderpriority IN ('1-URGENT', '2-HIGH') AS home, o_totalprice AS p FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT nation, season, 100.0 * avg(p) FILTER (home) / nullif(avg(p) FILTER (NOT home), 0) AS ratio FROM g GROUP BY ALL)
SELECT a.nation, a.season::BIGINT AS season, round(a.ratio, 4) AS ratio, round(avg(b.ratio), 4) AS park_factor FROM r a LEFT JOIN r b ON a.nation = b.nation AND b.season BETWEEN a.season - 3 AND a.season - 1 GROUP BY ALL""")
def agg_park_factor(t: Tables) -> DataFrame:
    """AGG-12, FEA-04: home against road rate, mean over three seasons before."""
    g = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumns({"nation": F.col("c_nationkey"), "season": F.year("o_orderdate").cast("long")})
    rows = aggregates.park_factor(g, "nation", "season", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "o_totalprice")
    return rows.select("nation", "season", F.round("ratio", 4).alias("ratio"), F.round("park_factor", 4).alias("park_factor"))


@query("""SELECT o_orderstatus, (year(o_orderdate) // 10 * 10)::BIGINT AS decade, count(*) AS n_rows, count(*) FILTER (o_totalprice > 100000) AS n_covered FROM orders GROUP BY ALL""")
def agg_coverage(t: Tables) -> DataFrame:
    """AGG-13: coverage by decade and group."""
    return aggregates.coverage(t.orders.withColumn("season", F.year("o_orderdate")), ["o_orderstatus"], "season", F.col("o_totalprice") > 100000)


@query("""WITH r AS (SELECT CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_mktsegment = 'BUILDING' THEN 'building' ELSE 'other' END AS class, c_custkey FROM customer)
SELECT class, count(*) AS n, array_to_string(list_slice(list(c_custkey ORDER BY c_custkey), 1, 5), ',') AS samples FROM r GROUP BY 1""")
def agg_classify(t: Tables) -> DataFrame:
    """AGG-14, FLT-26: count and ordered samples by the first rule that holds."""
    rules = [("debt", F.col("c_acctbal") < 0), ("building", F.col("c_mktsegment") == "BUILDING")]
    rows = aggregates.classify(t.customer, rules, "c_custkey")
    return rows.withColumn("samples", F.array_join(F.col("samples").cast("array<string>"), ","))


@query("""SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1""")
def agg_range(t: Tables) -> DataFrame:
    """AGG-17: range of a group."""
    day = F.to_date("o_orderdate")
    return t.orders.groupBy("o_custkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@query("""WITH s AS (SELECT event_type AS pre, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS post FROM events),
n AS (SELECT pre, post, count(*) AS n FROM s WHERE post IS NOT NULL GROUP BY ALL) SELECT pre, post, n, round(n / sum(n) OVER (PARTITION BY pre), 8)::DOUBLE AS p FROM n""")
def seq_transitions(t: Tables) -> DataFrame:
    """AGG-16, SEQ-03, SEQ-05: transition counts and probabilities."""
    return aggregates.transitions(t.events, ["user_id"], ["ts", "event_id"], "event_type").withColumn("p", F.round("p", 8))


@query("""WITH r AS (SELECT event_type, sum(value) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM events)
SELECT event_type, round(avg(rest), 4) AS expected, count(*) AS n FROM r GROUP BY 1""")
def agg_rest_expectancy(t: Tables) -> DataFrame:
    """AGG-18, FEA-18: mean of what the rest of a day brings, by state."""
    rows = t.events.withColumn("day", F.to_date("ts"))
    return aggregates.rest_expectancy(rows, ["user_id", "day"], ["ts", "event_id"], "value", ["event_type"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def ext_rollup(t: Tables) -> DataFrame:
    """Extension: subtotals."""
    return aggregates.rollup(t.lineitem, ["l_returnflag", "l_linestatus"], n=F.count("*"), quantity=F.round(F.sum("l_quantity"), 2))


@query("""SELECT round(avg(value), 6) AS mean, quantile_cont(value, 0.5) AS median, quantile_disc(value, 0.9) AS p90, max(value) AS top FROM events""")
def seq_summary(t: Tables) -> DataFrame:
    """SEQ-07: mean, median, nearest-rank p90, maximum."""
    (median,), (p90,) = quantile.quantiles(t.events, "value", [0.5], [0.9])
    return t.events.agg(F.round(F.avg("value"), 6).alias("mean"), F.lit(median).cast("double").alias("median"), F.lit(p90).cast("double").alias("p90"), F.max("value").alias("top"))


@query(r"""WITH x AS (SELECT event_id, json_extract_string(props, '$.k') AS k, value::VARCHAR AS v FROM events)
SELECT event_id, CASE WHEN regexp_full_match(k, '[0-9]+(\.[0-9]+)?') THEN k::DOUBLE::BIGINT END AS k,
CASE WHEN k::BIGINT < 10 THEN 'low' WHEN k::BIGINT < 50 THEN 'middle' ELSE 'high' END AS band, (k::BIGINT % 2 = 0)::BIGINT AS even FROM x""")
def clean_props(t: Tables) -> DataFrame:
    """FLT-01, FLT-02, FLT-14, FLT-15, SRC-12: guarded casts out of JSON text, flags and bands."""
    k = clean.guarded_int(F.get_json_object("props", "$.k"))
    band = F.when(k < 10, "low").when(k < 50, "middle").otherwise("high")
    return t.events.select("event_id", k.alias("k"), band.alias("band"), clean.flag(k % 2 == 0).alias("even"))


@query(r"""SELECT o_orderkey, split_part(o_orderpriority, '-', 1)::INTEGER::BIGINT AS level, nullif(split_part(o_orderpriority, '-', 2), 'NOT SPECIFIED') AS name,
CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'P' THEN 'partial' ELSE 'open' END AS status, o_orderstatus IN ('F', 'P') AS counted FROM orders""")
def clean_orders(t: Tables) -> DataFrame:
    """FLT-03, FLT-04, FLT-06, FLT-07: sentinels, recodes, allow-lists, split text."""
    part = lambda k: F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(k))
    return t.orders.select(
        "o_orderkey", clean.number(part(1), "long").alias("level"), clean.sentinel(part(2), "not specified").alias("name"),
        clean.recode(F.col("o_orderstatus"), {"F": "final", "P": "partial"}, F.lit("open")).alias("status"), F.col("o_orderstatus").isin("F", "P").alias("counted"),
    )


@query(r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, nullif(regexp_extract(url, '/(\d+)', 1), '')::BIGINT AS number, nullif(concat_ws(' ', nullif(regexp_extract(url, '//([a-z-]+)\.', 1), ''),
nullif(regexp_extract(url, '\.([a-z]+)(/|$)', 1), '')), '') AS name FROM pages""")
def clean_urls(t: Tables) -> DataFrame:
    """FLT-18, FLT-19: parts of a text by pattern, joined into a name."""
    part = lambda p: F.regexp_extract("url", p, 1)
    return t.pages.select(
        "page_id", part(r"^[a-z]+://([^/?#]+)").alias("host"), clean.number(part(r"/(\d+)"), "long").alias("number"), clean.display_name(part(r"//([a-z-]+)\."), part(r"\.([a-z]+)(?:/|$)")).alias("name")
    )


@query("""SELECT doc_id, length(regexp_replace(text, '[^aeiou]', '', 'g'))::BIGINT AS vowels, length(regexp_replace(text, '[^.,;]', '', 'g'))::BIGINT AS marks, regexp_matches(substr(text, 1, 1), '[A-Z]') AS capital FROM documents""")
def clean_text_classes(t: Tables) -> DataFrame:
    """FLT-13: characters of a class, and the first one's."""
    return t.documents.select("doc_id", clean.count_class(F.col("text"), "aeiou").alias("vowels"), clean.count_class(F.col("text"), ".,;").alias("marks"), clean.first_in_class(F.col("text"), "A-Z").alias("capital"))


@query("""SELECT o_orderkey, round(date_diff('day', o_orderdate::DATE, DATE '2002-01-01') / 365.25, 6) AS age, year(o_orderdate)::BIGINT AS season, month(o_orderdate)::BIGINT AS month,
round(power(least(o_totalprice, 100000), 0.287), 4) AS scaled FROM orders""")
def clean_dates(t: Tables) -> DataFrame:
    """FLT-11, FLT-22, FLT-24: ages, seasons, powers."""
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.round(clean.age_years(F.lit("2002-01-01").cast("date"), day), 6).alias("age"), clean.season_of(day.cast("string")).cast("long").alias("season"),
        F.month(day).cast("long").alias("month"), F.round(F.pow(F.least("o_totalprice", F.lit(100000.0)), F.lit(0.287)), 4).alias("scaled"),
    )


@query("""SELECT 'customer.rows' AS name, CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END AS status, count(*)::VARCHAR AS detail FROM customer
UNION ALL SELECT 'lineitem.key', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*)::VARCHAR FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'orders.o_totalprice', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*)::VARCHAR FROM orders WHERE NOT o_totalprice BETWEEN 0 AND 400000
UNION ALL SELECT 'events.' || c, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, n::VARCHAR FROM (SELECT 'value' AS c, count(*) FILTER (value IS NULL) AS n FROM events UNION ALL SELECT 'props', count(*) FILTER (props IS NULL) FROM events)
UNION ALL SELECT 'orders.customers', CASE WHEN m > n OR m < n THEN 'FAIL' ELSE 'PASS' END, m || '/' || n FROM (SELECT (SELECT count(*) FROM orders) AS n, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS m)""")
def dq_suite(t: Tables) -> DataFrame:
    """DQ-01, DQ-03, DQ-04, DQ-08, DQ-12, DQ-14: a suite of findings."""
    return quality.suite(
        quality.has_rows(t.customer, "customer.rows"), quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem.key"),
        quality.in_range(t.orders, {"o_totalprice": (0, 400000)}, "orders"), quality.not_null(t.events, ["value", "props"], "events"),
        quality.join_coverage(t.orders, t.customer.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"], "orders.customers"),
    )


@query("""SELECT count(*) AS n_rows, count(*) FILTER (l_orderkey IS NULL) AS n_null, count(*) FILTER (l_orderkey IS NOT NULL AND o_orderkey IS NULL) AS n_orphan
FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""")
def dq_references(t: Tables) -> DataFrame:
    """DQ-13: rows, nulls and orphans of a foreign key."""
    return quality.references(t.lineitem, t.orders.filter("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey")


@query("""WITH e AS (SELECT year(o_orderdate)::BIGINT AS season, count(DISTINCT o_orderkey) AS n_expected FROM orders GROUP BY 1),
a AS (SELECT year(o_orderdate)::BIGINT AS season, count(DISTINCT l_orderkey) AS n_actual FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 40 GROUP BY 1)
SELECT season, n_expected, coalesce(n_actual, 0) AS n_actual, coalesce(n_actual, 0) / n_expected AS ratio, coalesce(n_actual, 0) / n_expected >= 0.5 AS ok FROM e LEFT JOIN a USING (season)""")
def dq_share_by(t: Tables) -> DataFrame:
    """DQ-05, DQ-09, DQ-11, DQ-19: coverage per season."""
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").cast("long").alias("season"))
    lines = t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("k")).join(o, "k")
    return quality.share_by(o, lines, ["season"], "k")


@query("""WITH a AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders)
SELECT count(*) AS n, count(*) FILTER (abs(a.v - b.v) > 100000) AS n_off, CASE WHEN count(*) > 0 THEN count(*) FILTER (abs(a.v - b.v) > 100000) / count(*) END AS rate FROM a JOIN b USING (k)""")
def dq_reconcile(t: Tables) -> DataFrame:
    """DQ-06, DQ-10: two totals of one key."""
    a = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("v"))
    return quality.reconcile(a, t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")), ["k"], "v", 100000)


@query("SELECT l_orderkey, count(*) AS n_rows, count(DISTINCT l_linenumber) AS n_distinct FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) < count(*)")
def dq_collisions(t: Tables) -> DataFrame:
    """DQ-07: groups with fewer identities than rows."""
    return quality.collisions(t.lineitem, ["l_orderkey"], ["l_linenumber"])


@query("""SELECT 'events.fresh' AS name, CASE WHEN h > 24 THEN 'FAIL' ELSE 'PASS' END AS status, round(h, 3)::VARCHAR AS detail FROM (SELECT date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') / 3.6e9 AS h FROM events)""")
def dq_fresh(t: Tables) -> DataFrame:
    """DQ-02, STR-06: age of the latest row by a given clock."""
    return quality.fresh(t.events, "ts", F.lit("2024-02-01").cast("timestamp"), 24, "events.fresh")


@query("""WITH l AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'loaded' END AS status, 4 AS n FROM orders), c AS (SELECT l_orderkey AS k, count(*) AS m FROM lineitem GROUP BY 1),
d AS (SELECT k, count(*) FILTER (status IN ('loaded', 'unavailable')) AS n_terminal, bool_and(CASE WHEN status = 'loaded' THEN n = coalesce(m, 0) ELSE true END) AS same FROM l LEFT JOIN c USING (k) GROUP BY 1)
SELECT k, n_terminal, same, n_terminal = 1 AND same AS done FROM d""")
def dq_durable(t: Tables) -> DataFrame:
    """DQ-18, STR-08: items whose ledger line agrees with what landed."""
    ledger = t.orders.select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("loaded").alias("status"), F.lit(4).alias("n_rows"))
    return quality.durable(ledger, t.lineitem.select(F.col("l_orderkey").alias("k")), "k")
