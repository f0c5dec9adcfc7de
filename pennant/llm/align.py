"""Cross-tokenizer alignment: which ids of two vocabularies stand for the same bytes.

A encodes a space and the text, B the text, to which it adds the space itself,
so both cover the same bytes. Cumulative sums of the ids' byte lengths give
where ids end, the common ends cut a text into groups, and the ids of A and B in
one group are linked. All of this is done once for each distinct chunk of text
(see tokens) and then repeated wherever the chunk stands, as chunk ends are ends
of both.

Tasks take documents in blocks of about BLOCK_BYTES and write one row a block:
its documents, and its distinct id pairs with the number of its documents that
hold each. Pairs are summed first by pair and salt, then by pair. The counts go
back to the blocks that asked for them, where the documents' figures are summed;
no task holds more than a block and no table of pairs is sent to all. Only the
greatest count of each A id is broadcast, which A's vocabulary bounds.

A worker process keeps what it knows of chunks in flat arrays, some 100 bytes a
chunk, and starts anew at MEMO_CHUNKS or, as chunks may be long, at MEMO_BYTES of
links and shown ids. Files of blocks hold FILE_BLOCKS rows, as Spark reads a
file's rows together.

Texts that are null or empty, or whose joined bytes of A or B differ from the
space and the text, have no ids: zeros and an empty digest. Repeated rows are
documents of their own. Without documents the result is empty. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm import tokens
from pennant.llm.common import materialize
from pennant.llm.tokens import spread

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20
FILE_BLOCKS = 2
#: A worker process forgets its chunks at so many, or at so many bytes of links and shown ids.
MEMO_CHUNKS = 1 << 20
MEMO_BYTES = 96 << 20
SALTS = 16
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "sizes array<long>, places array<int>, times array<int>, a array<int>, b array<int>, n array<long>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(a: np.ndarray, b: np.ndarray, length_a: np.ndarray, length_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a, b: ids in a row that cover the same bytes. Where groups end, and each id's group."""
    end_a, end_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    return cuts, np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)


def links(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of ids that share a group, as the places of its ids."""
    size = np.bincount(group_b, minlength=n_groups)
    begin = np.cumsum(size) - size
    return np.repeat(np.arange(len(a)), size[group_a]), spread(begin[group_a], size[group_a])


class Aligned:
    """Alignments of the chunks that a worker process has seen."""

    def __init__(self, path_a: str, path_b: str):
        self.path_a, self.path_b = path_a, path_b
        self.length_a = np.array([len(x) for x in tokens.byte_level(path_a, False)[1]])
        self.length_b = np.array([len(x) for x in tokens.pieces(path_b)[1]])
        self.shown = [f"{i}{end}".encode() for i in range(len(self.length_a)) for end in ",|"] + [f"{i}{end}".encode() for i in range(len(self.length_b)) for end in ",;"]
        self.shown_length = np.array([len(x) for x in self.shown])
        #: A link of a and b is the number a * (B's ids) + b.
        self.kind = np.min_scalar_type(max(1, len(self.length_a) * len(self.length_b) - 1))
        self.memo = tokens.Memo(self._learn, self._forget, self._large)

    def _forget(self) -> None:
        self.whole = np.zeros(0, bool)
        self.figures = {name: np.zeros(0, np.int32) for name in FIGURES}
        self.text, self.text_at = bytearray(), np.zeros(1, np.int64)
        self.link, self.begin = np.zeros(0, self.kind), np.zeros(0, np.int64)

    def _large(self, chunks: int) -> bool:
        return chunks >= MEMO_CHUNKS or len(self.text) + self.link.nbytes >= MEMO_BYTES

    def shown_ids(self, number: np.ndarray) -> list[bytearray]:
        """The shown ids of each chunk."""
        return [self.text[i:j] for i, j in zip(self.text_at[number].tolist(), self.text_at[number + 1].tolist(), strict=True)]

    def _learn(self, chunks: list[bytes], plain: np.ndarray) -> None:
        a, n_a = tokens.byte_level_ids(chunks, plain, self.path_a, special=False)
        b, n_b = tokens.piece_ids(chunks, self.path_b)
        whole = self._covers(chunks, a, n_a, tokens.byte_level(self.path_a, False)[1]) & self._covers(chunks, b, n_b, tokens.pieces(self.path_b)[1])
        a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
        n_a, n_b = n_a * whole, n_b * whole
        cuts, group_a, group_b = align(a, b, self.length_a, self.length_b)
        place_a, place_b = links(a, b, group_a, group_b, len(cuts))
        of_a = np.repeat(np.arange(len(chunks)), n_a)
        n_links = np.bincount(of_a[place_a], minlength=len(chunks))
        last_a, last_b = (np.append(g[1:] != g[:-1], np.ones(min(1, len(g)), bool)) for g in (group_a, group_b))
        n_groups = np.bincount(of_a[last_a], minlength=len(chunks))
        shown = np.concatenate([2 * a + last_a, 2 * len(self.length_a) + 2 * b + last_b])[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
        ends = np.append(0, np.cumsum(self.shown_length[shown]))[np.cumsum(n_a + n_b)]
        self.text_at = np.concatenate([self.text_at, len(self.text) + ends])
        self.text += b"".join([self.shown[i] for i in shown.tolist()])
        self.begin = np.concatenate([self.begin, len(self.link) + np.cumsum(n_links) - n_links])
        self.link = np.concatenate([self.link, (a[place_a] * len(self.length_b) + b[place_b]).astype(self.kind)])
        self.whole = np.concatenate([self.whole, whole])
        for name, own in zip(FIGURES, (n_a, n_b, n_groups, n_links), strict=True):
            self.figures[name] = np.concatenate([self.figures[name], own.astype(np.int32)])

    @staticmethod
    def _covers(chunks: list[bytes], ids: np.ndarray, count: np.ndarray, named: list[bytes]) -> np.ndarray:
        """Whether the bytes of each chunk's ids are the chunk's."""
        ends = np.cumsum(count).tolist()
        ids = [named[i] for i in ids.tolist()]
        return np.array([b"".join(ids[i:j]) == c for c, i, j in zip(chunks, [0, *ends], ends, strict=False)], bool)


@functools.cache
def aligned(path_a: str, path_b: str) -> Aligned:
    return Aligned(path_a, path_b)


def _spaced(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that aren't empty, each behind a space."""
    size = np.diff(at)
    more = (size > 0).astype(np.int64)
    to = np.append(0, np.cumsum(size + more))
    out = np.full(to[-1], 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.cumsum(more), size)] = data
    return out, to


class Block:
    """Documents of one task until they are written as a row."""

    def __init__(self):
        self.bytes = 0
        self.rows: dict[str, list] = {name: [] for name in ("doc_ids", *FIGURES, "groups_sha256", "doc", "number", "times")}
        self.n = 0

    def add(self, memo: Aligned, ids: np.ndarray, data: np.ndarray, at: np.ndarray) -> None:
        data, at = _spaced(data, at)
        start, n = tokens.cut(data, at), len(ids)
        number = memo.memo.numbers(data, start, np.append(start[1:], len(data)))
        bounds = np.searchsorted(start, at)
        doc = np.repeat(np.arange(n), np.diff(bounds))
        none = np.diff(bounds) == 0
        none[doc[~memo.whole[number]]] = True
        keep = ~none[doc]
        for name in FIGURES:
            self.rows[name].append(np.bincount(doc[keep], weights=memo.figures[name][number[keep]], minlength=n).astype(np.int64))
        for empty, i, j in zip(none.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            self.rows["groups_sha256"].append("" if empty else hashlib.sha256(b"".join(memo.shown_ids(number[i:j]))[:-1]).hexdigest())
        pair, times = np.unique(doc[keep] * len(memo.whole) + number[keep], return_counts=True)
        of, number = np.divmod(pair, max(1, len(memo.whole)))
        self.rows["doc_ids"].append(ids)
        for name, own in (("doc", of), ("number", number), ("times", times)):
            self.rows[name].append(own.astype(np.int32))
        self.n += n
        self.bytes += len(data)

    def row(self, memo: Aligned, block: int) -> pa.RecordBatch:
        known = np.unique(np.concatenate(self.rows["number"]))
        count = memo.figures["n_links"][known]
        pairs, place = np.unique(memo.link[spread(memo.begin[known], count)], return_inverse=True)
        place, begin = place.astype(np.int32), np.cumsum(count) - count
        sizes, places, often = [], [], []
        for ids, doc, number, times in zip(*(self.rows[name] for name in ("doc_ids", "doc", "number", "times")), strict=True):
            own = np.searchsorted(known, number)
            key = np.repeat(doc.astype(np.int64), count[own]) * max(1, len(pairs)) + place[spread(begin[own], count[own])]
            order = np.argsort(key)
            key, times = key[order], np.repeat(times, count[own])[order]
            first = np.flatnonzero(np.append(np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))
            of, at = np.divmod(key[first], max(1, len(pairs)))
            sizes.append(np.bincount(of, minlength=len(ids)))
            places.append(at.astype(np.int32))
            often.append(np.add.reduceat(times, first) if len(first) else times)
        lists = {
            "doc_ids": pa.concat_arrays(self.rows["doc_ids"]), **{name: np.concatenate(self.rows[name]) for name in FIGURES}, "groups_sha256": self.rows["groups_sha256"],
            "sizes": np.concatenate(sizes), "places": np.concatenate(places), "times": np.concatenate(often).astype(np.int32),
            "a": (pairs // len(memo.length_b)).astype(np.int32), "b": (pairs % len(memo.length_b)).astype(np.int32), "n": sum(np.bincount(x, minlength=len(pairs)) for x in places),
        }
        lists = {name: x if isinstance(x, pa.Array) else pa.array(x, pa.string() if name == "groups_sha256" else None) for name, x in lists.items()}
        columns = [pa.array([block], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists.values())]
        return pa.RecordBatch.from_arrays(columns, ["block", *lists])


def blocks(docs: DataFrame, a: str = A, b: str = B, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block of documents (see BLOCKS): their figures, the block's id pairs, and which of them each document holds how often."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, seen, block = aligned(tokens.vocabulary(a), tokens.vocabulary(b)), TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for first, last, data, at in tokens.groups(batch.column(1), 1 << 20):
                if block.n and (block.bytes >= BLOCK_BYTES or memo.memo.full()):
                    yield block.row(memo, seen)
                    seen, block = seen + 1, Block()
                block.add(memo, batch.column(0).slice(first, last - first), data, at)
        if block.n:
            yield block.row(memo, seen)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, BLOCKS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """rows: block, a, b, n. One row per id pair: a, b, count (documents that hold it linked), best (count is the greatest of its a)."""
    salted = rows.groupBy("a", "b", F.pmod(F.xxhash64("block"), F.lit(SALTS)).alias("salt")).agg(F.sum("n").alias("n"))
    counts = salted.groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _finish(block: pa.Table, answers: pa.Table) -> pa.Table:
    get = lambda name: block.column(name)[0].values
    place, size, times = (get(name).to_numpy() for name in ("places", "sizes", "times"))
    count, best = np.zeros(len(get("a")), np.int64), np.zeros(len(get("a")), np.int64)
    at = answers.column("place").to_numpy()
    count[at], best[at] = answers.column("count").to_numpy(), answers.column("best").to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)

    def total(x: np.ndarray) -> np.ndarray:
        upto = np.append(0, np.cumsum(x * times, dtype=np.int64))
        return upto[ends] - upto[ends - size]

    own = {name: get(name) for name in FIGURES}
    return pa.table({"doc_id": get("doc_ids"), **own, "n_best": total(best[place]), "count_sum": total(count[place]), "groups_sha256": get("groups_sha256")})


def figures(docs: DataFrame, a: str = A, b: str = B, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: see RESULT."""
    done = materialize(blocks(docs, a, b, id_col, text_col), "aligned", FILE_BLOCKS)
    pairs = done.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("place", "pair")).select("block", "place", "pair.a", "pair.b", "pair.n")
    counts = pair_counts(pairs)
    answers = pairs.join(counts, ["a", "b"]).select(F.col("block").alias("asked"), "place", "count", "best")
    return done.groupBy("block").cogroup(answers.groupBy("asked")).applyInArrow(_finish, RESULT)
