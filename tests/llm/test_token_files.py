"""Token files against the tokenizer itself, and the coder's round trip."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from pennant.llm import coder, queries, token_files, tokens
from pennant.llm.common import table

ODD = [
    "", None, " a", "a ", "a  b", " \n a\n\nb", "x <|endoftext|> y<|endoftext|>z", "it's we'll  'tis", "é é é 　x 中 文  ", "a" * 300 + " " + "b c\td\r\ne", "don 't", "end. \n", " ", "\n", "😀 😀 x",
    "x 😀 y", "tab\t x", "a \u0085 b", "n\u0085 b", "1 2 3,4 5", "  a   b  c", "a\nb\n c", "\x1c a\x1f b", "x ​ y", "long " * 3000,
]


def brute(docs):
    t, _ = tokens.byte_level(tokens.vocabulary(token_files.VOCABULARY), True)
    out, start = [], 0
    for i, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def check(spark, docs, path):
    token_files.write(docs, path)
    got = [tuple(r) for r in token_files.read(spark, path).orderBy("start").collect()]
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    return got


@pytest.mark.parametrize("segment", [1000, 1 << 22])
def test_documents(spark, sf, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment)
    check(spark, table(spark, sf, "documents").repartition(5), f"{tmp_path}/file")
    assert queries.op11_token_files(spark, sf).count() == table(spark, sf, "documents").count()


def test_edges(spark, tmp_path):
    rows = [(3 * k % 71, t, 1, 2) for k, t in enumerate(ODD)] + [(None, "no id", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, KEY int")
    check(spark, docs, f"{tmp_path}/odd")
    assert check(spark, docs.limit(0), f"{tmp_path}/none") == []
    again = spark.createDataFrame([(1, "same row")] * 4 + [(0, "first")], "doc_id long, text string")
    check(spark, again, f"{tmp_path}/again")


def test_chunks_have_the_ids_of_the_whole(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 40)
    for special in (True, False):
        path = tokens.vocabulary(token_files.VOCABULARY)
        t, _ = tokens.byte_level(path, special)
        memo, texts = tokens.Ids(path, special), ODD * 3
        for first, last, data, at in tokens.groups(pa.array(texts), 200):
            ids, bounds = memo.encode(data, at)
            want = [e.ids for e in t.encode_batch([x or "" for x in texts[first:last]], add_special_tokens=False)]
            assert [ids[b:e].tolist() for b, e in zip(bounds, bounds[1:], strict=False)] == want


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 63, 64, 65, 1023, 1024, 1025, 5000])
def test_coder(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), rng.integers(0, 3, n), rng.integers(0, 1 << 30, n), np.zeros(n), np.arange(n) % 7 + 40_000):
        blocks, wide = coder.encode(ids.astype(np.uint32))
        assert (coder.decode(blocks, n, wide) == ids).all()
        for k, b in enumerate(blocks[-2:], len(blocks[:-2])):
            own = ids[k * coder.BLOCK : (k + 1) * coder.BLOCK]
            assert (coder.decode([b], len(own), wide) == own).all()


def test_a_word_is_learnt_once_whatever_sign_follows():
    path = tokens.vocabulary(token_files.VOCABULARY)
    t, _ = tokens.byte_level(path, True)
    texts = [" one été", " one. été. one, été, one's x<|endoftext|>y", " one, été's. one. été,", " a×b. a÷b. ꙮ. 1. é́. Ωm. _a_b'll 'tis x|y x>y"]
    memo, learnt = tokens.Ids(path), []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        ids, bounds = memo.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
        learnt.append(len(memo.memo.keys))
    # Two words, then "." "," "'s" and the last, then no word or sign again.
    assert learnt[:3] == [2, 6, 6]


def by_hand(ids):
    """What the contexts and order 0 hold at every id of a block."""
    one, two, a, b, out = {}, {}, 0, 0, []
    for i, x in enumerate(ids):
        h1 = a >> (32 - coder.ONE_BITS)
        h2 = (a ^ (b << int(coder.SHIFT)) & 0xFFFFFFFF) >> (32 - coder.TWO_BITS)
        held = [table.get(h, (0, 0)) for table, h in ((one, h1), (two, h2))]
        n = max((k for k, _ in coder._phases(len(ids)) if k <= i), default=0)
        out.append((*(4 * p + c for p, c in held), (sum(y < x for y in ids[:n]), ids[:n].count(x)) if x in ids[:n] else (0, 0)))
        for table, h, (p, c) in ((one, h1, held[0]), (two, h2, held[1])):
            table[h] = (x, min(c + 1, 3) if p == x else 0)
        a, b = x * int(coder.HASH) & 0xFFFFFFFF, a
    return out


@pytest.mark.parametrize(("most", "n"), [(4, 300), (40, 300), (3000, 1024), (1 << 30, 100)])
def test_model_holds_what_a_walk_holds(most, n):
    ids = np.random.default_rng(most).integers(0, most, (3, n)).astype(np.uint32)
    ids[1, n // 2 :] = ids[1, : n - n // 2]
    hashed = np.zeros((3, n + 2), np.uint32)
    hashed[:, 2:] = ids * coder.HASH
    one = coder._entries(ids, hashed[:, 1:-1] >> np.uint32(32 - coder.ONE_BITS))
    two = coder._entries(ids, (hashed[:, 1:-1] ^ (hashed[:, :-2] << coder.SHIFT)) >> np.uint32(32 - coder.TWO_BITS))
    runs = coder._runs(ids, most > 0xFFFF)
    for k in range(3):
        assert list(zip(one[k].tolist(), two[k].tolist(), zip((runs[k] >> 16).tolist(), (runs[k] & 0xFFFF).tolist(), strict=True), strict=True)) == by_hand(ids[k].tolist())


def test_carries_reach_the_words_before():
    """The last interval of many equal ones ends where a carry has to pass through words that are full."""
    steps, lanes = 200, 3
    begin, width = np.full((steps, lanes), coder.TOTAL - 16, np.int32), np.full((steps, lanes), 16, np.int32)
    begin[:, 1] = np.arange(steps) % 2 * (coder.TOTAL - 16)
    begin[:, 2] = np.random.default_rng(0).integers(0, coder.TOTAL - 16, steps)
    words, count = coder._words(begin, width, steps)
    for lane, part in enumerate(np.split(words, np.cumsum(count)[:-1])):
        low, span, shift = 0, 1 << 48, 0
        for b, w in zip(begin[:, lane].tolist(), width[:, lane].tolist(), strict=True):
            low, span = low + (span >> coder.TOTAL_BITS) * b, (span >> coder.TOTAL_BITS) * w
            if span < 1 << 32:
                low, span, shift = low << 16, span << 16, shift + 1
        assert int.from_bytes(part.astype(">u2").tobytes(), "big") == low and count[lane] == shift + 3


def test_models_earn_their_shares():
    """What a context tells is cheap, what nothing tells costs two bytes and little more."""
    rng = np.random.default_rng(5)
    size = lambda ids: 8 * sum(map(len, coder.encode(ids.astype(np.uint32))[0])) / len(ids)
    assert size(np.tile(rng.integers(0, 50000, 17), 500)) < 1.5
    assert size(rng.integers(0, 16, 8192)) < 6
    assert size(rng.permutation(50000)) < 18


def test_damage_is_found(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words of document {i}") for i in range(50)], "doc_id long, text string").coalesce(1)
    token_files.write(docs, f"{tmp_path}/file")
    file = spark.read.schema(token_files.FILE).parquet(f"{tmp_path}/file")
    rows = [r.asDict() | {"blocks": [bytes(r.blocks[0][:40]) + bytes([r.blocks[0][40] ^ 1]) + bytes(r.blocks[0][41:]), *r.blocks[1:]]} for r in file.collect()]
    spark.createDataFrame(rows, file.schema).write.parquet(f"{tmp_path}/bad")
    with pytest.raises(Exception, match="damaged"):
        token_files.read(spark, f"{tmp_path}/bad").collect()
