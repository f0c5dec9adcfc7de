"""Corpus queries with a SQL twin against DuckDB, on the given tables and on small odd ones."""

import pytest

from pennant.llm import queries
from tests.compare import same


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twin(spark, sf, name):
    same(queries.QUERIES[name](spark, sf), queries.ORACLE_SQL[name], sf)


def written(spark, tmp_path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_mixing_of_rare_sources(spark, tmp_path):
    """A rate beyond 12 is the sum of several Poisson parts in both."""
    rows = [(i, "rare" if i < 2 else "few" if i < 8 else None if i < 2000 else "most") for i in range(6_000)]
    sf = written(spark, tmp_path, documents=(rows, "doc_id long, source string"))
    same(queries.op9_mixing(spark, sf), queries.ORACLE_SQL["op9_mixing"], sf)


def test_odd_texts(spark, tmp_path):
    """Short, empty, null, repeated and overlapping texts; items of fewer than ten words."""
    passage = " ".join(f"w{k % 37}" for k in range(90))
    texts = [None, "", " \t ", "one", "One", passage, passage + " tail", "head " + passage, passage + " " + passage, "a b " * 60, "a b " * 59, "short item here", "It's a short ITEM, here!", "x " + passage.upper()]
    items = [None, "", "short item", passage[40:140], passage, "never seen at all", "ITEM, here"]
    sf = written(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id long, text string"), benchmark=([(k % 5, t) for k, t in enumerate(items)], "item_id long, text string"))
    for name in ("op2_exact_dedup", "op3_substring_dedup", "op6_near_dedup", "op7_decontaminate"):
        same(queries.QUERIES[name](spark, sf), queries.ORACLE_SQL[name], sf)
