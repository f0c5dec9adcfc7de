"""Alignment against whole texts encoded at once and links counted one by one."""

import collections
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pennant.llm import align, tokens
from pennant.llm.common import table
from tests.llm.test_token_files import ODD


def groups(text):
    """Lists of (ids of A, ids of B) that end at common byte offsets."""
    t, a_bytes = tokens.byte_level(tokens.vocabulary(align.A), False)
    sp, b_bytes = tokens.pieces(tokens.vocabulary(align.B))
    if not text:
        return []
    a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    raw = (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
        return []
    out, i, j, at_a, at_b = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            out[-1][0].append(a[i])
            at_a += len(a_bytes[a[i]])
            i += 1
        else:
            out[-1][1].append(b[j])
            at_b += len(b_bytes[b[j]])
            j += 1
        if at_a == at_b and (i < len(a) or j < len(b)):
            out.append(([], []))
    return out


def brute(docs):
    docs = [(i, groups(t)) for i, t in docs]
    held = [[(x, y) for a, b in g for x in a for y in b] for _, g in docs]
    count = collections.Counter(p for own in held for p in set(own))
    most = collections.Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (i, g), own in zip(docs, held, strict=True):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        n_best = sum(count[p] == most[p[0]] for p in own)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own), n_best, sum(count[p] for p in own), hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def check(docs):
    got = align.figures(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == brute([(r.doc_id, r.text) for r in docs.collect()])
    return rows


@pytest.mark.parametrize("size", [10_000, 8 << 20])
def test_documents(spark, sf, monkeypatch, size):
    monkeypatch.setattr(align, "BLOCK_BYTES", size)
    check(table(spark, sf, "documents").repartition(3))


def test_edges(spark):
    odd = [*ODD, "a▁b ▁c", "<s> </s> <unk> <0x41>", "Ⅷ ﬁne ①", "nul\x00 byte", "ﬀ", "▁"]
    docs = spark.createDataFrame([(k % 9 if k % 5 else None, t, 1, 2) for k, t in enumerate(odd * 2)], "doc_id long, text string, block int, PLACE int")
    assert any(r[1] == 0 for r in check(docs)) and check(docs.limit(0)) == check(docs.filter("text is null and text = ''")) == []


def test_arrays():
    length = np.array([0, 1, 2, 3])
    a, b = np.array([3, 1, 2, 2]), np.array([1, 2, 2, 1, 1, 1])
    cuts, group_a, group_b = align.align(a, b, length, length)
    assert cuts.tolist() == [3, 6, 8] and group_a.tolist() == [0, 1, 1, 2] and group_b.tolist() == [0, 0, 1, 1, 2, 2]
    place_a, place_b = align.links(a, b, group_a, group_b, 3)
    assert list(zip(place_a.tolist(), place_b.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 4), (3, 5)]


def held(texts):
    """Python bytes that a new worker keeps of its chunks after these lots of texts, and the figures of all documents."""
    paths = tokens.vocabulary(align.A), tokens.vocabulary(align.B)
    tracemalloc.start()
    try:
        memo, block, out = align.Aligned(*paths), align.Block(), []
        for lot in texts:
            for first, last, data, at in tokens.groups(pa.array(lot)):
                if block.n and memo.memo.full():
                    out.append(block.row(memo, len(out)))
                    block = align.Block()
                block.add(memo, pa.array(range(first, last)), data, at)
        out.append(block.row(memo, len(out)))
        del block
        rows = [[x for r in out for x in r.column(name)[0].values.to_pylist()] for name in (*align.FIGURES, "groups_sha256")]
        own = tracemalloc.get_traced_memory()[0]
        memo.memo.clear()
        return own - tracemalloc.get_traced_memory()[0], rows, len(out)
    finally:
        tracemalloc.stop()


def test_known_chunks_take_little_memory():
    """Some 115 bytes for each of these chunks; they took 194 while shown ids were objects and links had 64 bits."""
    words = [f"{a}{b}{c}" for a in ("re", "un", "in", "for", "over") for b in ("test", "gram", "port", "line", "cast", "work") for c in ("ing", "ed", "s", "er", "able", "")]
    texts = [[" ".join(f"{w}{k}{v}" for w in words for v in words[:20]) for k in "abcd"]]
    n = len({c for t in texts[0] for c in t.split()})
    assert held(texts)[0] < 150 * n


def test_long_chunks_do_not_pile_up(monkeypatch):
    """A worker starts anew by bytes too, with the same results."""
    rng = np.random.default_rng(3)
    texts = [["".join(chr(97 + x) for x in rng.integers(0, 26, 400)) + f" end of {k}" for k in range(100)] for _ in range(20)]
    most, rows, blocks = held(texts)
    monkeypatch.setattr(align, "MEMO_BYTES", 1 << 20, raising=False)
    bound, again, more = held(texts)
    assert again == rows and more > blocks == 1
    assert bound < 3 << 20 < most
