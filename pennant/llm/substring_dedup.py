"""Substring dedup by level-wise doubling.

A window of 50 words can only repeat if its windows of 25 do, so windows are
judged level by level: windows of 25 words first, and those that repeat are
extended to 50. The first level looks at anchors alone: among the 26 windows of
25 words that a window of 50 holds, the one with the least hash. Equal windows
hold equal anchors, so a window stays a candidate only where its anchor repeats.
repeat_lengths() goes on doubling (100, 200, ...) until no candidate survives.

Texts with the same words are counted as one beforehand: all but the one with
the smallest id lose every word that a window covers, which is all of them.

Statistics of a window are summed before the shuffle. Rows join back to them by
the window's hash. The HOT_WINDOWS most frequent windows are broadcast instead,
and their rows go through that join under keys of their own (a hash of text and
window), so a passage that a third of all documents share goes to many tasks.
Texts are dealt out once by their identity, and every level reads that exchange.

Windows are compared by a 64-bit hash: among n candidate windows about n*n/2**65
pairs collide.

Null texts have no words. Null ids sort after all others. Rows that repeat an id
don't remove words from each other, and each gets its result. Texts under 50
words stay as they are. Empty tables give empty results. A very long text is one
row of one task; its words' hashes take 8 bytes each. No column of docs but id
and text is read, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import id_key, materialize, text_key
from pennant.llm.words import NOT_SPACE, WORD_BASES, RunHash, Words, chunks, sliding_min, spans_to_mask

WINDOW = 50
#: Windows that are joined by broadcast, the most frequent ones; any other has under 1/HOT_WINDOWS of all rows.
HOT_WINDOWS = 1000
NO_WORDS = hashlib.sha256(b"").digest()
_FAR = ~np.uint64(0)


def anchors(w: Words, run: RunHash, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors; per word the hash of the `half` words from there, and the least of the half + 1 such hashes from there."""
    left, reach = w.left(), half + 1
    g = np.full(len(w), _FAR)
    at = np.flatnonzero(left >= half)
    g[at] = run(at, at + half)
    least = sliding_min(g, reach)
    asked = np.zeros(len(w), bool)
    asked[left >= 2 * half] = True
    held = np.where(asked, least, np.uint64(0))
    most = ~np.ascontiguousarray(sliding_min(np.ascontiguousarray(~held[::-1]), reach)[::-1])
    return np.flatnonzero((most == g) & (left >= half)), g, least


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and digest of the words, for (doc_id, key, th, text)."""
    for batch in batches:
        shas, counts = [], []
        for w in chunks(batch.column(3), NOT_SPACE):
            raw, cuts = w.data.tobytes(), w.offsets.tolist()
            split = [raw[a:b].split() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            shas += [hashlib.sha256(b" ".join(x)).digest() for x in split]
            counts += [len(x) for x in split]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(shas, pa.binary()), pa.array(counts, pa.int64())], names=["doc_id", "key", "th", "sha", "n_words"])


def _anchors(half: int):
    """Distinct anchors of each text, for (key, th, rid, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, rid = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for w in chunks(batch.column(3), NOT_SPACE):
                at, g, _ = anchors(w, RunHash(w.hashes(), WORD_BASES[0]), half)
                of, g = w.of[at], g[at]
                order = np.lexsort((g, of))
                of, g = of[order], g[order]
                new = np.ones(len(g), bool)
                new[1:] = (of[1:] != of[:-1]) | (g[1:] != g[:-1])
                of, g = of[new] + w.first, g[new]
                yield pa.RecordBatch.from_arrays([_signed(g), pa.array(key[of]), pa.array(rid[of])], names=["h", "key", "rid"])

    return find


def _flat(lists: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    sizes = np.zeros(n, np.int64) if len(lists) == 0 else np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(n), sizes)


def _extend(size: int, from_anchors: bool):
    """Windows of `size` words that may repeat, for (key, th, rid, text, marks).

    marks: of each text, the hashes of its anchors that repeat, or the begins of
    windows of half the size that do.
    """
    half = size // 2

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, rid = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            marks, row = _flat(batch.column(4), batch.num_rows)
            for w in chunks(batch.column(3), NOT_SPACE):
                mine = (row >= w.first) & (row < w.last)
                run, left = RunHash(w.hashes(), WORD_BASES[0]), w.left()
                at = np.flatnonzero(left >= size)
                if from_anchors:
                    _, _, least = anchors(w, run, half)
                    at = at[np.isin(least[at], marks[mine].view(np.uint64))]
                else:
                    good = np.zeros(len(w) + 1, bool)
                    good[marks[mine] + w.bounds[row[mine] - w.first]] = True
                    at = at[good[at] & good[at + half]]
                of = w.of[at]
                yield pa.RecordBatch.from_arrays(
                    [_signed(run(at, at + size)), pa.array(key[w.first + of]), pa.array(rid[w.first + of]), pa.array((at - w.bounds[of]).astype(np.int32))],
                    names=["h", "key", "rid", "at"],
                )

    return extend


def _kept(size: int):
    """Words removed and the digest of those that stay, for (key, th, rid, text, marks)."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, row = _flat(batch.column(4), batch.num_rows)
            removed, shas = [], []
            for w in chunks(batch.column(3), NOT_SPACE):
                mine = (row >= w.first) & (row < w.last)
                start = marks[mine] + w.bounds[row[mine] - w.first]
                gone = spans_to_mask(len(w), start, start + size)
                raw = w.data.tobytes()
                for k in range(w.last - w.first):
                    lo, hi = w.bounds[k], w.bounds[k + 1]
                    stay = lo + np.flatnonzero(~gone[lo:hi])
                    removed.append(int(hi - lo - len(stay)))
                    kept = [raw[a:b] for a, b in zip(w.start[stay].tolist(), w.end[stay].tolist(), strict=True)]
                    shas.append(hashlib.sha256(b" ".join(kept)).digest())
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(removed, pa.int64()), pa.array(shas, pa.binary())], names=["rid", "removed", "kept"])

    return keep


class _Levels:
    """The texts of docs, one for each sequence of words, and what the levels have in common."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, window: int):
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), id_key(id_col).alias("key"), text_key(text_col).alias("th"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        self.survey = materialize(rows.mapInArrow(_survey, "doc_id long, key long, th long, sha binary, n_words long"), "survey")
        leads = self.survey.filter(F.col("n_words") >= window).groupBy("sha").agg(F.min(F.struct("key", "th")).alias("lead"))
        # Once written, the numbers stay what they are.
        self.leads = materialize(leads.select("sha", "lead.key", "lead.th", F.monotonically_increasing_id().alias("rid")), "leads")
        self.texts, self.half = rows.select("key", "th", "text"), window // 2

    def with_text(self, marked: DataFrame | None = None) -> DataFrame:
        """key, th, rid, text, and marks where marked (rid, marks) is given: then only of its texts."""
        side = self.leads.select("key", "th", "rid")
        if marked is not None:
            side = side.join(marked, "rid")
        found = self.texts.join(side, ["key", "th"])
        return found.select("key", "th", "rid", "text", *(["marks"] if marked is not None else []))

    def repeated_anchors(self) -> DataFrame:
        anchor = self.with_text().mapInArrow(_anchors(self.half), "h long, key long, rid long")
        return _repeats(anchor).groupBy("rid").agg(F.collect_set("h").alias("marks"))

    def windows(self, size: int, marked: DataFrame, from_anchors: bool) -> DataFrame:
        return self.with_text(marked).mapInArrow(_extend(size, from_anchors), "h long, key long, rid long, at int")


def _repeats(windows: DataFrame) -> DataFrame:
    """Rows whose window starts in texts with different ids, with the smallest of these as `first`."""
    stats = windows.groupBy("h").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("n")).filter("first < last")
    hot = stats.orderBy(F.desc("n"), "h").limit(HOT_WINDOWS).select("h", F.col("first").alias("hot_first"))
    rows = windows.join(F.broadcast(hot), "h", "left")
    # Rows of hot windows have what they need; any key that spreads them will do. Others carry their hash once, as that key.
    is_hot = F.col("hot_first").isNotNull()
    rows = rows.withColumn("k", F.when(is_hot, F.xxhash64("rid", "h")).otherwise(F.col("h"))).withColumn("h", F.when(is_hot, F.col("h")))
    found = rows.join(stats.select(F.col("h").alias("k"), "first"), "k", "left").withColumn("first", F.coalesce("hot_first", "first")).withColumn("h", F.coalesce("h", "k"))
    return found.filter(F.col("first").isNotNull()).drop("k", "hot_first")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256."""
    levels = _Levels(docs, id_col, text_col, window)
    windows = levels.windows(2 * levels.half, levels.repeated_anchors(), True)
    later = _repeats(windows).filter("key > first").groupBy("rid").agg(F.collect_set("at").alias("marks"))
    # Rows that repeat id and text come several times, with one result.
    cut = levels.with_text(later).mapInArrow(_kept(window), "rid long, removed long, kept binary").dropDuplicates(["rid"])
    cut = levels.leads.join(cut, "rid", "left").select("sha", F.col("key").alias("lead"), "removed", "kept")
    out = levels.survey.select("doc_id", "key", "sha", "n_words").join(cut, "sha", "left")
    copy = F.coalesce(F.col("key") > F.col("lead"), F.lit(False))
    removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long")
    kept = F.when(copy, F.lit(NO_WORDS)).otherwise(F.coalesce("kept", "sha"))
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.lower(F.hex(kept)).alias("kept_sha256"))


def repeat_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, levels: int = 16) -> DataFrame:
    """size, windows, texts: how many windows of 50, 100, 200, ... words start in texts with different ids.

    Texts with the same words count once. The doubling stops when no candidate
    is left, or after `levels`.
    """
    held = _Levels(docs, id_col, text_col, window)
    marked, size, found = held.repeated_anchors(), window, None
    for level in range(levels):
        both = materialize(_repeats(held.windows(size, marked, level == 0)), f"repeats-{size}")
        counts = both.agg(F.lit(size).cast("long").alias("size"), F.count("*").alias("windows"), F.countDistinct("rid").alias("texts"))
        found = counts if found is None else found.unionByName(counts)
        if both.isEmpty():
            break
        marked = both.groupBy("rid").agg(F.collect_set("at").alias("marks"))
        size *= 2
    return found
