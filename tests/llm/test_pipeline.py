import corpus_pipeline
from pennant.llm.common import materialize, table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = materialize(out, name)
            now = docs.count()
            assert 0 < now <= before
            before = now
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "mixing"]
    assert set(columns) <= set(out.columns) and out.count() > 0


def test_edges(spark, tmp_path):
    """Nulls, empty and repeated rows, names that the stages use themselves, and tables without rows."""
    words = [" ".join(f"w{(7 * i + 3 * k) % 211}" for k in range(40)) for i in range(30)]
    rows = [(i, w, "en", f"s{i % 3}", 1, 2, 3) for i, w in enumerate(words)] + [(100, None, None, None, 1, 2, 3), (101, "", "en", "s0", 1, 2, 3), (None, "no id here at all", "en", "s1", 1, 2, 3), (5, words[5], "en", "s2", 1, 2, 3), (102, words[7].upper(), "en", None, 1, 2, 3)]
    schema = "doc_id long, text string, lang string, source string, SCORE int, digest int, block int"
    tables = {"documents": (rows, schema), "labels": ([(i, 1, int(i % 4 == 0)) for i in range(30)], "doc_id long, quality int, toxic int"), "benchmark": ([(1, None), (2, ""), (3, words[11])], "item_id long, text string")}
    for name, (own, kinds) in tables.items():
        spark.createDataFrame(own, kinds).write.parquet(f"{tmp_path}/some/{name}.parquet")
        spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/none/{name}.parquet")
        spark.createDataFrame(own if name == "documents" else [], kinds).write.parquet(f"{tmp_path}/bare/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    kept = corpus_pipeline.run(spark, f"{tmp_path}/some")
    assert set(docs.columns) <= set(kept.columns)
    texts = {r.text for r in kept.select("text").collect()}
    assert words[11] not in texts and texts <= {r[1] for r in rows}
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    # Without labels nothing is rejected, without items nothing is contaminated: what repeats goes, all else is dealt to the mix.
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, out, f"{tmp_path}/bare"), name)
    left = out.collect()
    assert sum(r.doc_id == 5 for r in left) == 1 and {r.doc_id for r in left} >= {1, 2, 3} and (7 in {r.doc_id for r in left}) != (102 in {r.doc_id for r in left})
