import random
import zlib

import numpy as np
import pyarrow as pa

from pennant.llm import toxicity


def corpus(n):
    random.seed(2)
    clean = [f"{a}{b}" for a in ("ran", "tol", "mep", "sif", "dro") for b in ("a", "eni", "os", "ulo", "ir", "et", "an")]
    rows, labels = [], []
    for i in range(n):
        w = random.choices(clean, k=random.randrange(20, 160))
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                w[random.randrange(len(w))] = "grok" + random.choice(["a", "en", "ist", "ulo", "ix"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(700)
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.decide(docs, marks).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert np.mean([got[i].predicted == dict(labels)[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_edges(spark):
    rows, labels = corpus(60)
    marks = spark.createDataFrame(labels + [(None, 1), (900, None)], "doc_id long, toxic int")
    odd = [(1000, None), (1001, ""), (None, "ran"), (1002, "!!!"), (1002, "!!!"), (1003, "rana " * 20_000)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").selectExpr("*", "1 as _score", "2 as _SCORE_", "2 as toxic")
    got = toxicity.decide(docs, marks).collect()
    assert len(got) == len(rows) + len(odd)
    empty = [r.score for r in got if r.doc_id in (1000, 1001, 1002)]
    assert len(set(empty)) == 1 and 0 < empty[0] < 1
    assert toxicity.decide(docs.limit(0), marks).count() == 0
    assert all(r.score == 0 for r in toxicity.decide(docs, marks.limit(0)).collect())
    assert toxicity.remove_toxic(docs, marks).columns == docs.columns


def test_windows_cover_every_word():
    for n in (1, 63, 64, 65, 112, 113, 500):
        w = next(toxicity.chunks(pa.array(["a " * n], pa.large_string()), toxicity.ALNUM))
        start, size, _ = toxicity.windows(w)
        assert set().union(*(range(a, a + k) for a, k in zip(start, size, strict=True))) == set(range(n))


def test_gradient():
    """Backpropagation against finite differences."""
    net = toxicity.new_network(0.1)
    rng = np.random.default_rng(3)
    inputs = rng.standard_normal((5, toxicity.INPUTS)).astype(np.float32)
    index, mask = rng.integers(0, 5, (6, 3)), np.ones((6, 3), np.float32)
    mask[4:, 1] = 0
    for p in net.parameters():
        p[...] = rng.standard_normal(p.shape) * 0.3
    logit, kept = toxicity._forward(net, inputs, index, mask, keep=True)
    grads, dinputs = toxicity._backward(net, inputs, index, mask, kept, np.ones(3, np.float32))
    for p, g in [*zip(net.parameters(), grads, strict=True), (inputs, dinputs)]:
        flat, at = p.reshape(-1), rng.integers(0, p.size)
        old = flat[at]
        ends = []
        for e in (1e-2, -1e-2):
            flat[at] = old + e
            ends.append(float(toxicity._forward(net, inputs, index, mask)[0].sum()))
        flat[at] = old
        assert abs((ends[0] - ends[1]) / 2e-2 - g.reshape(-1)[at]) < 2e-2 * max(1, abs(g.reshape(-1)[at]))
