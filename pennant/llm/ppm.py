"""Language-model scores by prediction by partial matching over byte contexts.

The trie of byte contexts up to ORDER bytes is a table of counted byte runs; the
runs of ORDER+1 hold those of all shorter ones, since texts begin with padding.
Escapes follow method C: a context that saw d symbols n times escapes with
d/(n+d), and symbols seen in the longer context are excluded in the shorter one.
As the symbols of a context are among those of any shorter one, what exclusion
takes away is a sum over the trie, so the probability of each run that occurs is
a column computed by joins and sums. Beyond order 0 all 257 symbols (bytes and
the end) are equally likely, those already seen excluded.

Neither trie nor vocabulary is ever sent whole to a task. Documents are dealt
into blocks of about BLOCK_BYTES by a hash; each block asks for the distinct
runs and words it holds, the requests are joined to the model, and the answers
come back to the block, where they score its documents. What a task holds is
bounded by a block at any corpus size.

Learning uses every document whose crc32 of the id (as text) modulo FOLDS isn't
HELD_OUT. Texts are lower-cased (A-Z). Words are compared by 64-bit hashes. Null
texts are empty and still have their end; null ids are held out. Repeated rows
each count and each get their score. Without learning rows the counts are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import materialize, text_key
from pennant.llm.words import NOT_SPACE, Words, chunks

ORDER = 3
FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES = 16 << 20
#: Symbols: 0 pads the begin, 1..256 are bytes, 257 ends the text. Nine bits each.
BITS, END, SYMBOLS = 9, 257, 257
END_TOKEN = -1
WORD, RUN = 0, 1
ANSWERS = "block long, kind int, key long, value double"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, score double"


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def _runs(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the distinct runs of ORDER+1 symbols, and for each position of the texts (with ends) its run and text."""
    n, size = w.last - w.first, np.diff(w.offsets)
    at = np.concatenate([[0], np.cumsum(size + ORDER + 1)])
    text = np.repeat(np.arange(n), size + ORDER + 1)
    symbols = np.zeros(at[-1], np.int64)
    place = np.arange(at[-1]) - at[text]
    symbols[(place >= ORDER) & (place < ORDER + size[text])] = w.data.astype(np.int64) + 1
    symbols[at[1:] - 1] = END
    present = np.flatnonzero(np.bincount(symbols, minlength=END + 1))
    dense = np.zeros(END + 1, np.int64)
    dense[present] = np.arange(len(present))
    d, a = dense[symbols], len(present)
    here = np.flatnonzero(place >= ORDER)
    context = np.zeros(len(here), np.int64)
    for k in range(ORDER, 0, -1):
        context = context * a + d[here - k]
    seen = np.flatnonzero(np.bincount(context, minlength=a**ORDER))
    number = np.zeros(a**ORDER, np.int32)
    number[seen] = np.arange(len(seen))
    pair = number[context] * a + d[here]
    used = np.flatnonzero(np.bincount(pair, minlength=len(seen) * a))
    index = np.zeros(len(seen) * a, np.int32)
    index[used] = np.arange(len(used))
    code, rest = np.zeros(len(used), np.int64), seen[used // a]
    for k in range(ORDER):
        code |= present[rest % a] << (BITS * (k + 1))
        rest = rest // a
    return code | present[used % a], index[pair], text[here]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)


def _ask(block: pa.Table) -> pa.Table:
    """Distinct words and runs of a block, and how often its learning documents have them."""
    learn = ~block.column("held_out").to_numpy(zero_copy_only=False)
    words, runs = ([np.array([END_TOKEN])], [np.array([learn.sum()])]), ([], [])
    for w in chunks(block.column("text"), NOT_SPACE, lower=True):
        mine = learn[w.first : w.last].astype(np.int64)
        key, inverse = np.unique(w.hashes().view(np.int64), return_inverse=True)
        words[0].append(key)
        words[1].append(np.bincount(inverse, weights=mine[w.of], minlength=len(key)))
        code, run, text = _runs(w)
        runs[0].append(code)
        runs[1].append(np.bincount(run, weights=mine[text], minlength=len(code)))
    (word, n_word), (code, n_code) = _summed(*words), _summed(*runs)
    n = len(word) + len(code)
    return pa.table(
        {
            "block": pa.array(np.full(n, block.column("block")[0].as_py(), np.int64)),
            "kind": pa.array(np.repeat(np.array([WORD, RUN], np.int32), [len(word), len(code)])),
            "key": pa.array(np.concatenate([word, code])),
            "n": pa.array(np.concatenate([n_word, n_code])),
        }
    )


def run_logs(runs: DataFrame) -> DataFrame:
    """runs: key (all runs of ORDER+1 symbols that occur), n (times in learning texts). key, log10 probability as value."""
    low = lambda k: F.col("key").bitwiseAND(F.lit((1 << (BITS * (k + 1))) - 1))
    rows = runs.select("key", F.col("n").cast("double").alias("c3"), *[low(k).alias(f"g{k}") for k in range(ORDER)])
    rows = rows.withColumn(f"g{ORDER}", F.col("key"))
    above = lambda k: F.shiftright(F.col(f"g{k}"), BITS)
    # Counts of the shorter runs, and of the contexts before them.
    for k in range(ORDER):
        counts = rows.groupBy(f"g{k}").agg(F.sum(f"c{ORDER}").alias(f"c{k}"))
        rows = rows.join(counts, f"g{k}")
    rows = rows.withColumns({f"x{k}": above(k) for k in range(1, ORDER + 1)}).withColumn("x0", F.lit(0).cast("long"))
    rows = materialize(rows, "runs")
    # Per context of length k: times, distinct symbols, and what its symbols weigh in the context one shorter.
    for k in range(ORDER, -1, -1):
        one = rows.groupBy(f"x{k}", f"g{k}").agg(F.first(f"c{k}").alias("c"), *([F.first(f"c{k - 1}").alias("below")] if k else []))
        held = one.filter("c > 0").groupBy(f"x{k}").agg(F.sum("c").alias(f"n{k}"), F.count("*").cast("double").alias(f"d{k}"), *([F.sum("below").alias(f"e{k}")] if k else []))
        rows = rows.join(held, f"x{k}", "left")
    value, escaped = None, F.lit(0.0)
    shorter: list[tuple[Column, Column]] = []
    zero = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    for k in range(ORDER, -1, -1):
        n, d = zero(f"n{k}"), zero(f"d{k}")
        if k < ORDER:
            n, d = n - zero(f"e{k + 1}"), d - zero(f"d{k + 1}")
        shorter.append((F.col(f"c{k}") > 0, escaped + F.log10(F.col(f"c{k}") / (n + d))))
        escaped = escaped + F.when(d > 0, F.log10(d / (n + d))).otherwise(F.lit(0.0))
    value = escaped - F.log10(F.lit(float(SYMBOLS)) - zero("d0"))
    for known, log in reversed(shorter):
        value = F.when(known, log).otherwise(value)
    return rows.select("key", value.alias("value"))


def _tell(block: pa.Table, answers: pa.Table) -> pa.Table:
    """Scores of a block's documents from the answers to its requests."""
    kind, key, value = (answers.column(c).to_numpy() for c in ("kind", "key", "value"))
    tables = []
    for which in (WORD, RUN):
        k, v = key[kind == which], value[kind == which]
        order = np.argsort(k)
        tables.append((k[order], v[order]))
    n = block.num_rows
    tokens, known, known_log, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    for w in chunks(block.column("text"), NOT_SPACE, lower=True):
        size, part = w.last - w.first, slice(w.first, w.last)
        words, inverse = np.unique(w.hashes().view(np.int64), return_inverse=True)
        count = tables[0][1][np.searchsorted(tables[0][0], words)]
        end = tables[0][1][np.searchsorted(tables[0][0], END_TOKEN)]
        tokens[part] = w.counts + 1
        known[part] = np.bincount(w.of, weights=(count > 0)[inverse], minlength=size) + (end > 0)
        known_log[part] = np.bincount(w.of, weights=np.log10(count + 1)[inverse], minlength=size) + np.log10(end + 1)
        code, run, text = _runs(w)
        score[part] = np.bincount(text, weights=tables[1][1][np.searchsorted(tables[1][0], code)][run], minlength=size)
    return pa.table(
        {
            "doc_id": block.column("doc_id"), "held_out": block.column("held_out"), "n_tokens": pa.array(tokens), "n_known": pa.array(known),
            "known_log": pa.array(known_log), "score": pa.array(score),
        }
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    n_blocks = 1 + total // BLOCK_BYTES
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col).cast("long"), text_key(text_col)), F.lit(n_blocks)).alias("block"),
    )
    asked = materialize(rows.groupBy("block").applyInArrow(_ask, "block long, kind int, key long, n long"), "asked")
    words = asked.filter(F.col("kind") == WORD).groupBy("key").agg(F.sum("n").alias("n"))
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    runs = asked.filter(F.col("kind") == RUN).groupBy("key").agg(F.sum("n").alias("n"))
    model = words.select(F.lit(WORD).alias("kind"), "key", F.col("n").cast("double").alias("value")).unionByName(run_logs(runs).select(F.lit(RUN).alias("kind"), "key", "value"))
    answers = asked.select("block", "kind", "key").join(model, ["kind", "key"]).select("block", "kind", "key", "value")
    told = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_tell, SCORES)
    train_tokens, denominator = int(size["n"]), float(size["n"] + size["v"] + 1)
    return told.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("known_log") - F.col("n_tokens") * F.log10(F.lit(denominator))).alias("base_score"), "score",
    )
