import hashlib
import re

import pytest

from pennant.llm import decontaminate
from pennant.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if at := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= at
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def check(docs, bench):
    got = sorted((tuple(r)[:6] for r in decontaminate.decide(docs, bench).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])


@pytest.mark.parametrize("block", [8 << 20, 2000])
def test_documents(spark, sf, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    check(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def test_edges(spark):
    docs = [(1, "The CAT sat"), (2, "x the cat sat; on"), (2, "x the cat sat; on"), (None, "the cat"), (2, None), (3, ""), (4, "é é é"), (5, "a " * 14), (6, "é, É"), (7, "b " * 100_000)]
    items = [(10, "the cat"), (9, "cat sat on"), (None, "É é"), (7, None), (8, ""), (11, "a " * 12), (10, "the cat")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as _spans", "2 as id")
    items = spark.createDataFrame(items, "item_id long, text string")
    check(docs, items)
    check(docs, items.limit(0))
    check(docs.limit(0), items)
    kept = decontaminate.remove_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7]


def test_longest_match(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x " + " ".join(f"w{i}" for i in range(5, 30)) + " y")], "doc_id long, text string")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert decontaminate.decide(docs, items).first().longest_match == 25
