"""The registered queries of this subpackage and, where SQL can express one, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.llm import align, chat_format, decontaminate, exact_dedup, html_extract, lexical, mixing, near_dedup, ppm, secrets, substring_dedup, token_files, toxicity
from pennant.llm.common import new_path, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.decide(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


#: Words between white space, and texts with A-Z in lower case, as the twins write them.
SPACED = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.decide(table(spark, sf_dir, "documents"))


OP3_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
p AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM d),
v AS (SELECT r, doc_id, word, i, CASE WHEN i + 50 <= n THEN md5(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS win FROM p),
f AS (SELECT win, min(doc_id) AS first_id FROM v WHERE win IS NOT NULL GROUP BY win),
g AS (SELECT r, word, i, coalesce(max(CASE WHEN first_id < doc_id THEN i END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), -1) >= 0 AS gone
      FROM v LEFT JOIN f USING (win)),
k AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM g GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.repair(table(spark, sf_dir, "conversations"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.decide(table(spark, sf_dir, "documents"))


OP6_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, {SPACED}) AS w FROM documents),
p AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM d),
v AS (SELECT r, i, n, md5(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) AS shingle FROM p),
c AS (SELECT r, shingle, count(*) AS times FROM v WHERE i + 5 <= n OR i = 0 GROUP BY r, shingle),
s AS (SELECT r, shingle, times, sum(times) OVER (PARTITION BY r) AS size FROM c),
o AS (SELECT x.r AS a, y.r AS b, sum(least(x.times, y.times))::DOUBLE AS shared, any_value(x.size + y.size)::DOUBLE AS total
      FROM s x JOIN s y ON x.shingle = y.shingle AND x.r <> y.r AND 10 * least(x.size, y.size) >= 8 * greatest(x.size, y.size) GROUP BY x.r, y.r),
e AS (SELECT a, b FROM o WHERE shared / (total - shared) >= 0.8),
reach(r, c) AS (SELECT r, r FROM d UNION SELECT e.b, reach.c FROM reach JOIN e ON e.a = reach.r),
l AS (SELECT r, min(c) AS c FROM reach GROUP BY r)
SELECT doc_id, min(doc_id) OVER (PARTITION BY c) AS class_id, count(*) OVER (PARTITION BY c) AS class_size, doc_id = min(doc_id) OVER (PARTITION BY c) AS kept
FROM d JOIN l USING (r)
"""


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP7_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {LOWER} AS text FROM documents),
t AS (SELECT 'd' AS kind, r, NULL AS id, text FROM d
      UNION ALL SELECT 'b', row_number() OVER (), coalesce(item_id::VARCHAR, 'null'), {LOWER} FROM benchmark),
w AS MATERIALIZED (SELECT kind, r, id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
p AS (SELECT kind, r, id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM w),
v AS (SELECT kind, r, id, i, n, array_agg(word) OVER (PARTITION BY kind, r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS run FROM p),
b AS (SELECT r, id, i, len(run) AS size, array_to_string(run, ' ') AS win FROM v WHERE kind = 'b' AND (i + 10 <= n OR i = 0)),
o AS (SELECT v.r, v.i AS pos, b.r AS item, b.id AS item_id, b.i AS place, z.size
      FROM v JOIN (SELECT DISTINCT size FROM b) z ON v.kind = 'd' AND v.i + z.size <= v.n
      JOIN b ON b.size = z.size AND b.win = array_to_string(v.run[1:z.size], ' ')),
u AS (SELECT r, pos, max(pos + size) AS upto FROM o GROUP BY r, pos),
h AS (SELECT v.r, count(*) FILTER (covered > v.i) AS n_hit
      FROM (SELECT v.r, v.i, max(u.upto) OVER (PARTITION BY v.r ORDER BY v.i) AS covered FROM v LEFT JOIN u ON u.r = v.r AND u.pos = v.i WHERE v.kind = 'd') v GROUP BY v.r),
m AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM o GROUP BY r),
q AS (SELECT *, pos - row_number() OVER (PARTITION BY r, item, pos - place ORDER BY pos) AS run FROM o),
x AS (SELECT r, max(words) AS longest FROM (SELECT r, max(pos + size) - min(pos) AS words FROM q GROUP BY r, item, pos - place, run) GROUP BY r)
SELECT d.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest, 0)::BIGINT AS longest_match
FROM d JOIN w ON w.kind = 'd' AND w.r = d.r
LEFT JOIN h ON h.r = d.r LEFT JOIN m ON m.r = d.r LEFT JOIN x ON x.r = d.r
"""


def op8_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.replicate(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return rows.select("doc_id", "source", F.col("_copy").cast("long").alias("copy"), F.col("_copies").cast("long").alias("n_copies"), F.col("_order").alias("order_key"))


def mixing_sql(docs: str) -> str:
    """Copies of the documents in the relation docs: doc_id, source, copy, n_copies, order_key. A rate above 12 is split into equal parts, each with a number of its own."""
    unit = "(('0x' || substr(md5({}), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0"
    return f"""
n AS (SELECT source, count(*) AS n_source, sqrt(count(*)) AS target FROM {docs} GROUP BY source),
r AS (SELECT source, target / (SELECT sum(target) FROM n) * (SELECT sum(n_source) FROM n) / n_source AS rate FROM n),
s AS (SELECT source, greatest(1, ceil(rate / 12))::INT AS parts, rate / parts AS rate FROM r),
p AS (SELECT source, k, CASE WHEN k = 0 THEN exp(-rate) ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END AS term
      FROM s, range(0, 64) t(k)),
c AS (SELECT source, sum(term) OVER (PARTITION BY source ORDER BY k) AS upto FROM p),
e AS (SELECT d.doc_id, d.source, unnest(range(parts)) AS part FROM {docs} d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
u AS (SELECT *, {unit.format("'17:' || coalesce(doc_id::VARCHAR, 'null') || CASE WHEN part > 0 THEN ':part:' || part ELSE '' END")} AS u FROM e),
m AS (SELECT u.doc_id, u.source, count(*) AS n_copies FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.upto <= u.u
      GROUP BY ALL)
SELECT doc_id, source, k AS copy, n_copies, {unit.format("'18:' || coalesce(doc_id::VARCHAR, 'null') || ':' || k::VARCHAR")} AS order_key
FROM (SELECT *, unnest(range(n_copies)) AS k FROM m)
"""


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.figures(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0),
t AS (SELECT r, unnest(w) AS term FROM d),
p AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
v AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS repeats FROM (SELECT item, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
c AS (SELECT item, item_id, p.r, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * n_docs) // length))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN v USING (term) JOIN d ON d.r = p.r, s GROUP BY item, item_id, p.r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM c JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_html_extract": op4_html_extract,
    "op5_chat_format": op5_chat_format,
    "op6_near_dedup": op6_near_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_ppm": op8_ppm,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_token_files": op11_token_files,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op6_near_dedup": OP6_SQL,
    "op7_decontaminate": OP7_SQL,
    "op9_mixing": "WITH " + mixing_sql("documents"),
    "op13_lexical_search": OP13_SQL,
}
