import collections
import re

import numpy as np

from pennant.llm import near_dedup
from pennant.llm.common import NO_ID, table
from pennant.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return collections.Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = sum((x & sets[j]).values())
            if both and both / (x.total() + sets[j].total() - both) >= 0.8:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), NO_ID), NO_ID if d is None else d)
    return sorted(((d, None if least[find(i)] == NO_ID else least[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def check(df):
    rows = near_dedup.decide(df).collect()
    assert sorted(((r.doc_id, r.class_id) for r in rows), key=repr) == brute([(r.doc_id, r.text) for r in df.collect()])
    return rows


def test_documents(spark, sf):
    check(table(spark, sf, "documents"))


def test_edges(spark):
    rows = [(1, "a b c"), (2, "A b  c"), (None, "a b c"), (2, "A b  c"), (3, None), (4, ""), (5, "x " * 1000), (6, "x " * 900), (7, "x " * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as digest", "2 as rid")
    got = check(df)
    assert {r.doc_id: r.class_size for r in got}[1] == 4
    assert check(df.limit(0)) == []
    kept = near_dedup.remove_near(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 7]


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    a = rng.geometric(0.4, 300)
    b = np.maximum(0, a + rng.integers(-1, 2, 300))
    j, seen = np.minimum(a, b).sum() / np.maximum(a, b).sum(), []
    for k in range(30):
        h = np.concatenate([np.repeat(base, a), np.repeat(base, b)]) * np.uint64(2 * k + 1)
        s = near_dedup.signatures(h, np.repeat([0, 1], [a.sum(), b.sum()]), 2)
        seen.append((s[0] == s[1]).mean())
    assert abs(np.mean(seen) - j) < 0.02


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {r.c for r in components(edges).filter("v < 61").collect()} == {0}
    assert {r.c for r in components(edges).filter("v >= 100").collect()} == {100}


def test_links_between_groups_of_copies(spark):
    import random

    random.seed(5)
    base = [f"w{random.randrange(500)}" for _ in range(300)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in random.sample(range(300), 6 + i % 4):
            w[k] = f"v{i}-{k}"
        rows.append((i, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))
