import collections
import math
import re
import zlib

from pennant.llm import ppm
from pennant.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def symbols(t):
    return [0, 0, 0] + [b + 1 for b in low(t).encode()] + [257]


def brute(docs):
    held = [True if i is None else zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    c, trie = collections.Counter(), [collections.defaultdict(collections.Counter) for _ in range(4)]
    for (_, t), h in zip(docs, held, strict=True):
        if not h:
            c.update([*WORD.findall(low(t)), None])
            s = symbols(t)
            for p in range(3, len(s)):
                for k in range(4):
                    trie[k][tuple(s[p - k : p])][s[p]] += 1
    n, v, seen = c.total(), len(c), {}

    def log(run):
        if run not in seen:
            out, excluded = 0.0, set()
            for k in (3, 2, 1, 0):
                rest = {s: m for s, m in trie[k].get(run[3 - k : 3], {}).items() if s not in excluded}
                total, d = sum(rest.values()), len(rest)
                if run[3] in rest:
                    out += math.log10(rest[run[3]] / (total + d))
                    break
                if d:
                    out += math.log10(d / (total + d))
                    excluded |= set(rest)
            else:
                out -= math.log10(257 - len(excluded))
            seen[run] = out
        return seen[run]

    out = []
    for (i, t), h in zip(docs, held, strict=True):
        w, s = [*WORD.findall(low(t)), None], symbols(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        out.append((i, h, len(w), sum(x in c for x in w), n, base, sum(log(tuple(s[p - 3 : p + 1])) for p in range(3, len(s)))))
    return sorted(out, key=repr)


def check(df):
    got = sorted(map(tuple, ppm.score(df).collect()), key=repr)
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9, abs_tol=1e-9)


def test_documents_in_blocks(spark, sf, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 1 << 17)
    check(table(spark, sf, "documents"))


def test_edges(spark):
    rows = [(1, "a b c"), (2, "A b  c"), (None, "a b c"), (2, "A b  c"), (3, None), (4, ""), (5, "x " * 1000), (6, "é"), (7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as key")
    check(df)
    check(df.limit(0))
    check(df.filter("doc_id is null"))


def test_a_context_is_a_distribution(spark):
    """Over all 257 symbols the probabilities after a context add up to 1."""
    runs = [(1, 2, 3, s) for s in range(1, 258)]
    code = lambda r: r[0] << 27 | r[1] << 18 | r[2] << 9 | r[3]
    seen = {code((1, 2, 3, 5)): 3, code((1, 2, 3, 7)): 1, code((4, 2, 3, 9)): 2, code((4, 9, 3, 5)): 2, code((4, 9, 9, 8)): 2}
    rows = [(code(r), seen.get(code(r), 0)) for r in runs] + [(k, n) for k, n in seen.items() if k not in map(code, runs)]
    logs = {r.key: r.value for r in ppm.run_logs(spark.createDataFrame(rows, "key long, n long")).collect()}
    assert math.isclose(sum(10 ** logs[code(r)] for r in runs), 1.0, rel_tol=1e-9)
