import numpy as np

from pennant.llm import exact_dedup, queries
from tests.compare import same


def test_twin(spark, sf):
    same(queries.QUERIES["op2_exact_dedup"](spark, sf), queries.ORACLE_SQL["op2_exact_dedup"], sf)


def test_perfect_hash_is_minimal():
    digests = np.random.default_rng(1).integers(0, 256, (5000, 32), dtype=np.uint8)
    slot = exact_dedup.slots(exact_dedup.perfect_hash(digests), digests)
    assert sorted(slot) == list(range(5000))


def test_edges(spark):
    rows = [(1, "A"), (2, "a"), (None, "a"), (2, "a"), (3, None), (4, ""), (5, "É"), (6, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as digest", "2 as key")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.decide(df).collect()), key=repr)
    want = [(None, 2, 4, False), (1, 2, 4, False), (2, 2, 4, True), (2, 2, 4, False), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True)]
    assert got == sorted(want, key=repr)
    kept = exact_dedup.remove_repeats(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]
    assert exact_dedup.decide(df.limit(0)).count() == 0


def test_history_does_not_matter(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, f"t{i % 17}") for i in range(200)], "doc_id long, text string")
    runs = [sorted(map(tuple, exact_dedup.decide(df, is_history=h).collect())) for h in (None, F.lit(False), F.col("doc_id") < 50)]
    assert runs[0] == runs[1] == runs[2]
