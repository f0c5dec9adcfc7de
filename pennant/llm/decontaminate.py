"""Benchmark decontamination with suffix arrays over shards of the documents.

A shard is a run of documents inside one task. Its suffix array holds the
suffixes (by words) that begin with a word sequence some benchmark window begins
with; no other suffix can match a whole window, so none is lost. Every benchmark
window is binary-searched in the array; the range found gives its locations, and
neighbouring locations on one diagonal join into the longest verbatim matches.

The benchmark is taken in blocks of bounded size (BLOCK_BYTES, or one item if
that is larger), one pass over the documents for each. A pass is written out
before the next block is read, so the driver, a plan and a task hold one block
at a time however large the benchmark is. Documents are never shuffled.

Null texts have no words. Null item ids are named "null"; items with one id
count once. Repeated documents each get their own row. Without documents the
result is empty, without a benchmark no document is hit. A very long text is
searched whole, in one shard. remove_contaminated's working columns take names
that docs doesn't have.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pennant.llm import words
from pennant.llm.common import fresh, materialize
from pennant.llm.words import ALNUM, RunHash, Words, chunks

WINDOW = 10
#: Bytes of benchmark text in one block, which bounds what is sent to tasks.
BLOCK_BYTES = 8 << 20
#: Suffixes are entered in the array by their first words; three at most.
ENTRY_WORDS = 3
ADDED = ("_spans", "_items", "_longest", "_n_words")
KINDS = ("array<int>", "array<string>", "int", "long")


@dataclass
class Block:
    """Windows of some benchmark items."""

    vocabulary: np.ndarray  # sorted word hashes; a word's id is its place from 1 on
    entry: int  # words that a suffix must share with a window's begin to be stored
    entries: np.ndarray  # sorted hashes of the windows' first words
    maybe: np.ndarray  # bits by the entries' low bits
    low: np.ndarray  # per distinct window, its key and the key past all that begin with it
    high: np.ndarray
    length: np.ndarray
    owner_at: np.ndarray  # per distinct window, where its (item, position) pairs begin
    owner: np.ndarray
    position: np.ndarray
    names: np.ndarray  # item ids as strings


MAYBE_BITS = 20


def _keys(ids: np.ndarray, pad: int) -> np.ndarray:
    """Rows of word ids as byte strings that sort as the sequences do."""
    full = np.full((len(ids), WINDOW), pad, dtype=">u4")
    full[:, : ids.shape[1]] = ids
    return np.ascontiguousarray(full).view(f"S{4 * WINDOW}").ravel()


def make_block(ids: list[str], texts: list[str | None], window: int = WINDOW) -> Block | None:
    hashes, owner, position, length, base = [], [], [], [], 0
    for w in chunks(pa.array(texts, pa.large_string()), ALNUM, lower=True):
        hashes.append(w.hashes())
        for k, (lo, n) in enumerate(zip(w.bounds[:-1].tolist(), w.counts.tolist(), strict=True)):
            if n:
                starts = np.arange(max(1, n - window + 1))
                position.append(base + lo + starts)
                owner.append(np.full(len(starts), w.first + k))
                length.append(np.full(len(starts), min(n, window)))
        base += len(w)
    if not position:
        return None
    h, at, item, size = (np.concatenate(x) for x in (hashes, position, owner, length))
    start = np.concatenate([[0], np.cumsum(np.bincount(item, minlength=len(texts)))])
    vocabulary, word_id = np.unique(h, return_inverse=True)
    steps = np.arange(window)
    inside = steps < size[:, None]
    rows = np.where(inside, word_id[np.minimum(at[:, None] + steps, len(h) - 1)] + 1, 0)
    high = np.where(inside, rows, 0xFFFFFFFF)
    low_keys = _keys(rows, 0)
    _, first, same = np.unique(low_keys, return_index=True, return_inverse=True)
    order = np.argsort(same, kind="stable")
    entry = int(min(ENTRY_WORDS, size.min()))
    entries = np.unique(RunHash(h, words.WORD_BASES[0])(at, at + entry))
    maybe = np.zeros(1 << MAYBE_BITS, bool)
    maybe[(entries & np.uint64((1 << MAYBE_BITS) - 1)).astype(np.int64)] = True
    return Block(
        vocabulary, entry, entries, maybe, low_keys[first], _keys(high, 0xFFFFFFFF)[first], size[first],
        np.concatenate([[0], np.cumsum(np.bincount(same, minlength=len(first)))]), item[order],
        (np.arange(len(item)) - start[item])[order], np.array(ids, dtype=object),
    )


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def occurrences(w: Words, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Word positions in the shard, and the block's window that occurs there."""
    none = np.zeros(0, np.int64)
    h, left = w.hashes(), w.left()
    at = np.flatnonzero(left >= block.entry)
    if not len(at):
        return none, none
    begin = RunHash(h, words.WORD_BASES[0])(at, at + block.entry)
    keep = block.maybe[(begin & np.uint64((1 << MAYBE_BITS) - 1)).astype(np.int64)]
    at, begin = at[keep], begin[keep]
    at = at[_member(begin, block.entries)]
    if not len(at):
        return none, none
    # The suffix array: word ids of each suffix up to the first unknown word or the text's end, sorted.
    steps = np.arange(WINDOW)
    seen = h[np.minimum(at[:, None] + steps, len(h) - 1)]
    ids = np.minimum(np.searchsorted(block.vocabulary, seen), len(block.vocabulary) - 1)
    known = (block.vocabulary[ids] == seen) & (steps < left[at][:, None])
    known = np.logical_and.accumulate(known, axis=1)
    suffixes = _keys(np.where(known, ids + 1, 0), 0)
    order = np.argsort(suffixes, kind="stable")
    array = suffixes[order]
    lo, hi = np.searchsorted(array, block.low, "left"), np.searchsorted(array, block.high, "right")
    n = np.maximum(hi - lo, 0)
    window = np.repeat(np.arange(len(n)), n)
    rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return at[order[rank]], window


def _pairs(window: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each occurrence every (item, position) of its window: index of the occurrence, index into owner."""
    n = np.diff(block.owner_at)[window]
    which = np.repeat(np.arange(len(window)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.owner_at[:-1][window], n)


def longest_matches(at: np.ndarray, window: np.ndarray, block: Block) -> tuple[np.ndarray, ...]:
    """Verbatim matches that can't be made longer: position in the shard, item, position in the item, words."""
    which, own = _pairs(window, block)
    p, item, i, size = at[which], block.owner[own], block.position[own], block.length[window][which]
    order = np.lexsort((p, p - i, item))
    p, item, i, size = p[order], item[order], i[order], size[order]
    fresh = np.ones(len(p), bool)
    fresh[1:] = (item[1:] != item[:-1]) | (p[1:] - i[1:] != p[:-1] - i[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(p))[: len(first)] - 1
    return p[first], item[first], i[first], p[last] + size[last] - p[first]


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _searched(texts: pa.Array, block: Block, spans: list, items: list, longest: list, counts: list) -> None:
    """Add what the block's windows hit to each text's spans, items and longest match."""
    for w in chunks(texts, ALNUM, lower=True):
        counts[w.first : w.last] = w.counts.tolist()
        at, window = occurrences(w, block)
        if not len(at):
            continue
        mask = words.spans_to_mask(len(w), at, at + block.length[window])
        edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        # Runs end where their text ends, though the next text's run may follow at once.
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            while a < b:
                doc = int(w.of[a])
                stop = min(b, int(w.bounds[doc + 1]))
                base = int(w.bounds[doc])
                spans[w.first + doc] = [*(spans[w.first + doc] or []), a - base, stop - base]
                a = stop
        which, own = _pairs(window, block)
        pair = np.unique(np.stack([w.of[at[which]], block.owner[own]]), axis=1)
        for doc, item in zip(*pair.tolist(), strict=True):
            items[w.first + doc] = [*(items[w.first + doc] or []), block.names[item]]
        p, _, _, size = longest_matches(at, window, block)
        for doc, n in zip(w.of[p].tolist(), size.tolist(), strict=True):
            longest[w.first + doc] = max(longest[w.first + doc], n)


def _pass(docs: DataFrame, block: Block | None, text_col: str, first: bool, added: Sequence[str]) -> DataFrame:
    names = docs.columns if first else docs.columns[: -len(added)]
    at = docs.columns.index(text_col)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if first:
                spans, items, longest = [None] * n, [None] * n, [0] * n
            else:
                spans, items, longest = (batch.column(k).to_pylist() for k in range(len(names), len(names) + 3))
            counts = [0] * n
            if block is not None:
                _searched(batch.column(at), block, spans, items, longest, counts)
            else:
                for w in chunks(batch.column(at), ALNUM, lower=True):
                    counts[w.first : w.last] = w.counts.tolist()
            found = [_lists(spans, pa.int32()), _lists([x and sorted(set(x)) for x in items], pa.string()), pa.array(longest, pa.int32()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *found], names=[*names, *added])

    schema = StructType([*docs.schema.fields[: len(names)], *StructType.fromDDL(", ".join(f"{n} {k}" for n, k in zip(added, KINDS, strict=True))).fields])
    return docs.mapInArrow(search, schema)


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Block]:
    """The benchmark in blocks of about BLOCK_BYTES, read one after the other."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = 1 + size // BLOCK_BYTES
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        block = make_block([r["id"] for r in rows], [r["text"] for r in rows])
        if block is not None:
            yield block


def search(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", added: Sequence[str] = ADDED) -> DataFrame:
    """docs with _spans (begin, end, begin, end, ... in words), _items, _longest (words) and _n_words, or as `added` names them."""
    first, out = True, docs
    for block in blocks(benchmark, item_col, item_text):
        if not first:
            out = materialize(out, "searched")
        out, first = _pass(out, block, text_col, first, added), False
    return _pass(docs, None, text_col, True, added) if first else out


def decide(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = search(slim, benchmark, "text", item_col, item_text)
    # Spans of several blocks may overlap: the words covered are counted in order of begin.
    pairs = F.transform(F.sequence(F.lit(0), (F.size("_spans") / 2).cast("int") - 1), lambda k: F.struct(F.get("_spans", k * 2).alias("a"), F.get("_spans", k * 2 + 1).alias("b")))
    covered = F.aggregate(
        F.array_sort(pairs), F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(F.greatest(acc.upto, x.b).alias("upto"), (acc.n + F.greatest(F.lit(0), x.b - F.greatest(x.a, acc.upto))).alias("n")),
        lambda acc: acc.n,
    )
    hit = F.when(F.col("_spans").isNull(), F.lit(0)).otherwise(covered).cast("long")
    items = F.coalesce("_items", F.array().cast("array<string>"))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), F.col("_longest").cast("long").alias("longest_match"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs in which no benchmark window occurs, with all their columns."""
    added = [fresh(docs, x) for x in ADDED]
    return search(docs, benchmark, text_col, item_col, item_text, added).filter(F.col(added[0]).isNull()).select(*docs.columns)
