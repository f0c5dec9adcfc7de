"""Ranked lexical search: impact-ordered postings, score at a time.

Documents are the unit of distribution. One pass over the texts leaves a forward
table with the asked terms of each document and their times, from which Spark
sums the collection's statistics. Each task then takes its documents in shards
of about SHARD_POSTINGS postings, groups a term's postings by exact impact, and
serves every item from the highest contribution down. A shard's search ends
when what is left can no longer lift a document outside the candidates over the
k-th best score; the candidates' scores are then completed from the forward
table. Tasks hand on k rows an item at most, and begin at the k-th best score
that a 64th of the documents has already reached, so most hand on fewer.

Items are read in blocks of ITEM_BYTES, one after another, so what is sent to
the tasks is bounded; every block sees every document. The SQL twin scores all
pairs that share a term.

Terms are compared by 64-bit hashes. Null and empty texts have no terms: such
documents aren't counted, such items have no rows. Repeated documents are
documents of their own; of equal scores the smaller doc_id comes first, null
last. Repeated items each have their rows. Without any document with a term the
result is empty. Other columns of the tables are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pennant.llm.common import NO_ID, materialize
from pennant.llm.words import ALNUM, chunks

K = 10
ITEM_BYTES = 4 << 20
SHARD_POSTINGS = 1 << 21
#: One of so many documents is searched first, for a score to begin at.
FIRST = 64
#: Fixed values of the score.
UNIT, PART, SLOPE, WEIGHT = 1_000_000_000, 1000, 75, 1000


class Items:
    """Terms of a block of items: sorted distinct hashes, and per item the places of its terms with their repeats."""

    def __init__(self, texts: list[str | None]):
        words = list(chunks(pa.array(texts, pa.string()), ALNUM, lower=True))
        hashes = np.concatenate([np.zeros(0, np.uint64), *(w.hashes() for w in words)])
        of = np.concatenate([np.zeros(0, np.int64), *(w.of + w.first for w in words)])
        self.terms, place = np.unique(hashes, return_inverse=True)
        pairs, self.repeats = np.unique(of * max(1, len(self.terms)) + place, return_counts=True)
        self.term = pairs % max(1, len(self.terms))
        self.bounds = np.searchsorted(pairs // max(1, len(self.terms)), np.arange(len(texts) + 1))

    def __len__(self) -> int:
        return len(self.bounds) - 1


def forward(docs: DataFrame, terms: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n (its terms with repeats), terms (those asked for, by place) and tfs (their times)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in chunks(batch.column(1), ALNUM, lower=True):
                size, hashes = w.last - w.first, w.hashes()
                place = np.searchsorted(terms, hashes)
                known = np.flatnonzero(terms[np.minimum(place, len(terms) - 1)] == hashes) if len(terms) else np.zeros(0, np.int64)
                pairs, times = np.unique(w.of[known] * len(terms) + place[known], return_counts=True)
                of, term = np.divmod(pairs, max(1, len(terms)))
                at = pa.array(np.searchsorted(of, np.arange(size + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (term, times)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, size), pa.array(w.counts.astype(np.int64)), *lists], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")


class Shard:
    """Postings of some documents, grouped by term and exact impact, the highest first."""

    def __init__(self, table: pa.Table, n_terms: int, n_docs: int, length: int):
        lists = [table.column(c).combine_chunks() for c in ("terms", "tfs")]
        lists = [x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks) for x in lists]
        term, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
        self.ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
        n = table.column("n").to_numpy()
        doc = np.repeat(np.arange(len(n)), lists[0].value_lengths().to_numpy())
        m = 100 - SLOPE + (SLOPE * n * n_docs) // length
        impact = (UNIT * tf) // (PART * tf + 8 * m[doc])
        self.n_terms, self.n_docs = n_terms, len(n)
        self.keys, self.impacts = doc * n_terms + term, impact
        order = np.lexsort((-impact, term))
        self.doc, term, impact = doc[order], term[order], impact[order]
        first = np.ones(len(order), bool)
        first[1:] = (term[1:] != term[:-1]) | (impact[1:] != impact[:-1])
        self.start = np.flatnonzero(first)
        self.size = np.diff(self.start, append=len(order))
        self.level = impact[self.start]
        self.bounds = np.searchsorted(term[self.start], np.arange(n_terms + 1))

    def best(self, term: np.ndarray, weight: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that score at least `least` and are among the k best here, and their scores."""
        here = (weight > 0) & (self.bounds[term + 1] > self.bounds[term])
        term, weight = term[here], weight[here]
        begin, count = self.bounds[term], self.bounds[term + 1] - self.bounds[term]
        ends = np.cumsum(count)
        of = np.repeat(np.arange(len(term)), count)
        level = np.arange(len(of)) + (begin - ends + count)[of]
        gain = self.level[level] * weight[of]
        order = np.argsort(-gain, kind="stable")
        after = np.cumsum(self.size[level][order])
        score = np.zeros(self.n_docs, np.int64)
        done, step, found = 0, 4096, None
        while done < len(order):
            upto = max(done + 1, int(np.searchsorted(after, (after[done - 1] if done else 0) + step, side="right")))
            now = level[order[done:upto]]
            size = self.size[now]
            at = np.arange(size.sum()) + np.repeat(self.start[now] - np.cumsum(size) + size, size)
            np.add.at(score, self.doc[at], np.repeat(gain[order[done:upto]], size))
            done, step = upto, 2 * step
            # What each term can still add to a document is the gain of its next level.
            following = np.bincount(of[order[:done]], minlength=len(term))
            left = following < count
            rest = int(gain[(ends - count + following)[left]].sum())
            bar = max(least, int(np.partition(score, -k)[-k])) if self.n_docs >= k else least
            if rest < bar:
                found = np.flatnonzero(score + rest >= bar)
                if len(found) * len(term) <= step:
                    break
        if done == len(order) or found is None:
            found, total = np.flatnonzero(score), score[score != 0]
        else:
            asked = (found[:, None] * self.n_terms + term).ravel()
            place = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            total = (np.where(self.keys[place] == asked, self.impacts[place], 0).reshape(len(found), len(term)) * weight).sum(axis=1)
        keep = total >= least
        found, total = found[keep], total[keep]
        first = np.lexsort((self.ids[found], -total))[:k]
        return found[first], total[first]


def _search(rows: DataFrame, items: Items, weights: np.ndarray, n_docs: int, length: int, least: np.ndarray, k: int) -> DataFrame:
    """rows: of the forward table. item, doc_id and score of the documents of each task that may be among an item's k best."""

    def serve(table: pa.Table, bar: np.ndarray) -> Iterator[pa.RecordBatch]:
        shard, out = Shard(table, len(items.terms), n_docs, length), []
        for i in range(len(items)):
            own = slice(items.bounds[i], items.bounds[i + 1])
            found, score = shard.best(items.term[own], weights[items.term[own]] * items.repeats[own], int(bar[i]), k)
            if len(score) == k:
                bar[i] = max(bar[i], score[-1])
            out.append((np.full(len(found), i, np.int32), shard.ids[found], score))
        item, doc, score = (np.concatenate(x) for x in zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=doc == NO_ID), pa.array(score)], ["item", "doc_id", "score"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bar, held, postings = least.copy(), [], 0
        for batch in batches:
            step = max(1, 1 + batch.num_rows * SHARD_POSTINGS // max(1, 4 * len(batch.column("terms").flatten())))
            for part in (batch.slice(at, step) for at in range(0, batch.num_rows, step)):
                held.append(part)
                postings += len(part.column("terms").flatten())
                if postings >= SHARD_POSTINGS:
                    yield from serve(pa.Table.from_batches(held), bar)
                    held, postings = [], 0
        if postings:
            yield from serve(pa.Table.from_batches(held), bar)

    return rows.mapInArrow(search, "item int, doc_id long, score long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _block(docs: DataFrame, rows: list, k: int, id_col: str, text_col: str) -> DataFrame | None:
    """rows: (item_id, text). Columns item, rank, doc_id, score; None where no document has a term."""
    items = Items([r[1] for r in rows])
    table = materialize(forward(docs, items.terms, id_col, text_col), "forward")
    n_docs, length = table.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    if not length or not len(items.terms):
        return None
    weights = np.zeros(len(items.terms), np.int64)
    for term, df in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))
    least = np.ones(len(items), np.int64)
    first = table.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST)) == 0)
    reached = _top(_search(first, items, weights, n_docs, length, least, k), k).filter(F.col("rank") == k)
    for item, score in reached.select("item", "score").collect():
        least[item] = score
    return _top(_search(table, items, weights, n_docs, length, least, k), k).select("item", "rank", "doc_id", "score")


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """Items in a fixed order, in blocks of about ITEM_BYTES."""
    rows = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    block: list = []
    size = 0
    for r in rows.orderBy("id", "text").toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1].encode())
        if size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of each item that score above 0: item_id, rank, doc_id, score."""
    spark, item_type = docs.sparkSession, items.schema[item_col].dataType.simpleString()
    parts = []
    for rows in _blocks(items, item_col, item_text):
        found = _block(docs, rows, k, id_col, text_col)
        if found is not None:
            names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], f"item int, item_id {item_type}")
            parts.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    if len(parts) > 1:
        parts = [materialize(p, "ranked") for p in parts]
    return reduce(DataFrame.unionByName, parts)
