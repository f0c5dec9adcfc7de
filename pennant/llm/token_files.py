"""Token files: ids of documents in order of their doc_id, coded in blocks that stand alone.

A file is Parquet, so any store that Spark writes to will do. Each row is a
segment of whole documents: part and segment give the order, start the ids that
the part holds before it, doc_ids and sizes its documents, blocks the coded
bytes of every coder.BLOCK ids and checks the crc32 of those ids as
little-endian unsigned 32-bit integers. A segment can be read without any other;
a block whose ids don't match its check raises.

Documents are dealt by ranges of the id and sorted within them; many rows with
one id, or without one, are split by a hash of their text. Tasks hold one
segment of about SEGMENT_IDS ids (more only where one document has more).

Null and empty texts have the end id alone. Documents without an id come last;
rows that repeat an id follow each other by that hash, rows repeated as a whole
each have their ids. An empty table leaves an empty file. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pennant.llm import coder, tokens
from pennant.llm.common import NO_ID, id_key, text_key

VOCABULARY = "byte_bpe_50k.json"
END = 0
SEGMENT_IDS = 1 << 22
FILE = "part long, segment int, start long, n_ids long, wide boolean, doc_ids array<long>, sizes array<long>, blocks array<binary>, checks array<long>"


def _le(ids: np.ndarray) -> memoryview:
    return memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")


def _segment(part: int, segment: int, start: int, docs: list[np.ndarray], sizes: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    blocks, wide = coder.encode(flat)
    checks = [zlib.crc32(_le(flat[i : i + coder.BLOCK])) for i in range(0, len(flat), coder.BLOCK)]
    doc = np.concatenate(docs)
    row = {
        "part": pa.array([part], pa.int64()), "segment": pa.array([segment], pa.int32()), "start": pa.array([start], pa.int64()), "n_ids": pa.array([len(flat)], pa.int64()),
        "wide": pa.array([wide]), "doc_ids": pa.array([doc], pa.list_(pa.int64())), "sizes": pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
        "blocks": pa.array([blocks], pa.list_(pa.binary())), "checks": pa.array([checks], pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_pydict(row)


def write(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode the texts, append END to each, and write the file."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = tokens.ids_of(tokens.vocabulary(vocabulary))
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        held: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            key = batch.column(0).to_numpy()
            for first, last, data, at in tokens.groups(batch.column(1)):
                ids, bounds = memo.encode(data, at)
                size = np.diff(bounds) + 1
                own = np.full(len(ids) + len(size), END, np.uint32)
                own[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size - 1)] = ids
                for kept, x in zip(held, (key[first:last], size, own), strict=True):
                    kept.append(x)
                if sum(map(len, held[2])) >= SEGMENT_IDS:
                    yield _segment(part, segment, start, *held)
                    segment, start, held = segment + 1, start + sum(map(len, held[2])), ([], [], [])
        if held[0]:
            yield _segment(part, segment, start, *held)

    order = [F.col("key"), F.col("salt"), F.col("row")]
    rows = docs.select(id_key(id_col).alias("key"), F.col(text_col).cast("string").alias("text"), text_key(text_col).alias("salt"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    rows.mapInArrow(encode, FILE).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file: doc_id, start, n_tokens, ids_crc32."""
    file = spark.read.schema(FILE).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch.column(name)[row].as_py()  # noqa: B023, E731
                doc, size = (batch.column(name)[row].values.to_numpy() for name in ("doc_ids", "sizes"))
                ids = coder.decode(get("blocks"), get("n_ids"), get("wide"))
                for i, check in enumerate(get("checks")):
                    if zlib.crc32(_le(ids[i * coder.BLOCK : (i + 1) * coder.BLOCK])) != check:
                        raise ValueError(f"block {i} of segment {get('segment')} of part {get('part')} is damaged")
                raw, ends = _le(ids), np.cumsum(size)
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(len(doc), get("part"), np.int64)), "doc_id": pa.array(doc, mask=doc == NO_ID), "start": pa.array(get("start") + ends - size),
                        "n_tokens": pa.array(size), "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    docs = file.mapInArrow(decode, "part long, doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row per part of the file: what the parts before it hold.
    parts = file.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select(F.col("part").alias("of"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return docs.join(before, docs["part"] == before["of"]).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
