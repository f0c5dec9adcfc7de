from collections import Counter

from pennant.llm import mixing, queries
from tests.compare import same


def test_twin(spark, sf):
    same(queries.QUERIES["op9_mixing"](spark, sf), queries.ORACLE_SQL["op9_mixing"], sf)


def test_target_weights(spark):
    rows = [(i, "a" if i % 10 else "b") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = {r.source: r["count"] for r in mixing.replicate(docs, {"a": 1.0, "b": 1.0}).groupBy("source").count().collect()}
    assert abs(got["a"] - 10_000) < 400 and abs(got["b"] - 10_000) < 400
    assert {r.source for r in mixing.replicate(docs, {"a": 1.0}).select("source").distinct().collect()} == {"a"}


def test_edges(spark):
    rows = [(1, None, "x"), (None, "s", None), (2, "s", ""), (2, "s", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as rate", "2 as target")
    got = mixing.replicate(docs, budget=4.0).collect()
    assert {r._copies for r in got if r.doc_id == 2} and len([r for r in got if r.doc_id == 2]) % 2 == 0
    assert mixing.replicate(docs.limit(0)).count() == 0
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.replicate(docs, budget=4.0).collect()), key=repr)


def test_clashing_names_and_many_sources(spark, monkeypatch):
    """Documents may have the working columns' names; beyond BROADCAST_SOURCES the salted join gives the same copies."""
    docs = spark.createDataFrame([(i, f"s{i % 7}" if i % 8 else None, "x" * 50) for i in range(500)], "doc_id long, source string, text string")
    plain = sorted((r.doc_id, r._copy, r._copies, r._order) for r in mixing.replicate(docs, budget=2.0).collect())
    odd = docs.selectExpr("*", "1 as _source", "2 as _cdf", "3 as _copies", "4 as _copy", "5 as _order", "6 as _parts", "7 as _salt", "8 as _chunk")
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    got = mixing.replicate(odd, budget=2.0).collect()
    assert sorted((r.doc_id, r._copy_, r._copies_, r._order_) for r in got) == plain
    assert all((r._source, r._cdf, r._copies, r._copy, r._order, r._parts, r._salt, r._chunk) == tuple(range(1, 9)) for r in got)


def test_rates_of_rare_sources(spark):
    """Rates far beyond MAX_RATE: rare sources get their weight, and the total is the budget."""
    rows = [(i, "rare" if i < 10 else "few" if i < 60 else "most") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    out = mixing.replicate(docs, {"rare": 1.0, "few": 1.0, "most": 2.0}).select("doc_id", "source", "_copy", "_copies").collect()
    size = Counter(r.source for r in out)
    assert abs(size["rare"] - 5_000) < 350 and abs(size["few"] - 5_000) < 350 and abs(size["most"] - 10_000) < 500
    rare = {r.doc_id: r._copies for r in out if r.source == "rare"}
    assert len(rare) == 10 and len(set(rare.values())) > 1
    assert sorted((r.doc_id, r._copy) for r in out if r.source == "rare") == sorted((d, k) for d, n in rare.items() for k in range(n))
    one = mixing.replicate(docs.filter("doc_id < 1 or doc_id > 60"), {"rare": 1.0, "most": 1.0}).groupBy("source").count().collect()
    assert abs({r.source: r["count"] for r in one}["rare"] - 9_970) < 500
