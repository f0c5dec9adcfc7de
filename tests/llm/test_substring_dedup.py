import hashlib
import random
import re

from pennant.llm import substring_dedup
from pennant.llm.common import NO_ID, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    texts = [(NO_ID if i is None else i, i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for key, _, w in texts:
        for a in range(len(w) - 49):
            window = tuple(w[a : a + 50])
            first[window] = min(first.get(window, NO_ID + 1), key)
    out = []
    for key, i, w in texts:
        gone = set()
        for a in range(len(w) - 49):
            if first[tuple(w[a : a + 50])] < key:
                gone.update(range(a, a + 50))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(df):
    assert sorted(map(tuple, substring_dedup.decide(df).collect()), key=repr) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_documents(spark, sf):
    check(table(spark, sf, "documents"))


def test_edges(spark):
    random.seed(1)
    words = [f"w{i}" for i in range(300)]
    p, q = " ".join(random.choices(words, k=60)), " ".join(random.choices(words, k=120))
    rows = [
        (5, p), (3, "x " + p), (None, p + "  y"), (7, None), (8, ""), (9, "a " * 400), (10, "a " * 70), (11, q[:300] + " " + p + " " + q), (12, q), (12, q + " z"), (2, q + "\n" + p), (12, q),
        (13, "a b " * 60), (14, "a b " * 55),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as sha", "3 as rid")
    check(df)
    check(df.limit(0))


def test_doubling_ends(spark):
    text = " ".join(f"w{i}" for i in range(230))
    df = spark.createDataFrame([(1, text), (2, "x " + text)], "doc_id long, text string")
    found = {r["size"]: (r.windows, r.texts) for r in substring_dedup.repeat_lengths(df).collect()}
    assert found == {50: (362, 2), 100: (262, 2), 200: (62, 2), 400: (0, 0)}
