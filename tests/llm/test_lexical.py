"""Ranked search against a plain scoring of all documents."""

import collections
import math
import re

import pytest

from pennant.llm import lexical
from pennant.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    texts = [(i, collections.Counter(terms(t))) for i, t in docs]
    texts = [(i, c, c.total()) for i, c in texts if c]
    n_docs, length = len(texts), sum(n for _, _, n in texts)
    df = collections.Counter(t for _, c, _ in texts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in texts:
            m = 25 + (75 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, math.inf if i is None else i, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=repr)


def check(docs, items, k=10):
    got = sorted(map(tuple, lexical.search(docs, items, k).collect()), key=repr)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    assert got == want
    return got


@pytest.mark.parametrize("postings", [64, 1 << 21])
def test_shards_and_blocks(spark, sf, monkeypatch, postings):
    """Small shards, a bar from other shards, and items in several blocks change nothing."""
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical, "ITEM_BYTES", 4000)
    check(table(spark, sf, "documents").repartition(5), table(spark, sf, "benchmark"), 3)


def test_edges(spark):
    docs = [(1, "a b b"), (2, "B, a."), (2, "B, a."), (None, "b b"), (4, None), (5, ""), (6, "x " * 5000 + "é"), (7, "rare É é"), (8, "..."), (9, "b a b")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, n int, TERMS int, item_id int")
    items = spark.createDataFrame([("p", "a B"), ("p", "a B"), ("q", "b b b a"), (None, "é x"), ("r", None), ("s", ""), ("t", "nowhere"), ("u", "É")], "item_id string, text string")
    assert check(docs, items, 2) and check(docs, items)
    assert check(docs.limit(0), items) == check(docs, items.limit(0)) == check(docs.filter("doc_id in (4, 5, 8)"), items) == []


def test_stops_before_the_end(spark, monkeypatch):
    """Rare terms prove the best documents while the levels of a common one are left."""
    seen = []
    whole = lexical.np.add.at

    class Watch:
        at = staticmethod(lambda score, doc, gain: (seen.append(len(doc)), whole(score, doc, gain))[1])

        def __getattr__(self, name):
            return getattr(lexical_np.add, name)

    lexical_np = lexical.np
    rows = [(i, "common " * (1 + i % 50) + ("rare words here" if i % 2000 == 7 else "")) for i in range(20_000)]
    pairs = [(i, collections.Counter(terms(t))) for i, t in rows]
    items = lexical.Items(["rare words here common"])
    names = {h: t for t in ("rare", "words", "here", "common") for h in [lexical.Items([t]).terms[0]]}
    order = [names[h] for h in items.terms]
    import pyarrow as pa

    lists = [[(k, c[t]) for k, t in enumerate(order) if c[t]] for _, c in pairs]
    rows = pa.table({"doc_id": pa.array([i for i, _ in pairs]), "n": pa.array([c.total() for _, c in pairs]), "terms": pa.array([[k for k, _ in x] for x in lists], pa.list_(pa.int32())), "tfs": pa.array([[v for _, v in x] for x in lists], pa.list_(pa.int32()))})
    n_docs, length = len(pairs), sum(c.total() for _, c in pairs)
    shard = lexical.Shard(rows, 4, n_docs, length)
    weights = lexical.np.array([100 if t == "common" else 7000 for t in order])
    monkeypatch.setattr(lexical, "np", type("np_", (), {"__getattr__": lambda self, name: Watch() if name == "add" else getattr(lexical_np, name)})())
    found, score = shard.best(items.term, weights, 1, 10)
    assert sum(seen) < 20_000 and len(found) == 10 and {int(x) % 2000 for x in shard.ids[found]} == {7} and all(score > 0)
