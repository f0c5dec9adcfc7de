"""MinHash near-dedup of multisets of word shingles with BagMinHash signatures.

A text is the multiset of its runs of five words, lower-cased (A-Z); a text of
one to four words is one shingle. Two texts are near-duplicates when the sum of
the smaller counts is at least 0.8 of the sum of the larger ones. Classes are
the connected components.

Each shingle has a Poisson process over weight and time whose points are drawn
from hashes. Weight is cut into [0,1), [1,2), [2,4), [4,8), ...; a shingle that
occurs c times takes the points below weight c, so texts with different counts
share the points they have in common. A point goes to one of the signature's
components, and each component keeps its first point: two texts agree in a
component with the probability of their weighted Jaccard similarity. Points are
generated by slabs of time, and only up to the time by which a text of that
weight has all components filled; a text that lacks some gets more time.

Texts with the same words are one row from the start. Signatures are banded
(32 bands of 4: a pair at 0.8 is missed once in 2e7). In each bucket all members
are compared to one of them, which is linear: the one that shares most bands with
others, as copies of one original resemble it more than each other. What this
confirms gives texts labels, the same only if connected. Only buckets that still
hold several labels are compared member by member, across labels: their texts get
signatures of 1024 components, whose sketches of 2048 bits, with the sizes, rule
pairs out inside the join, and exact multiset overlap follows. Nothing is capped.

Null texts have no words; texts without words are alone in their class. Null ids
sort after all others. Rows that repeat id and text share their class and their
`kept`. Empty tables give empty results. A very long text is signed whole; its
shingles are in one task's memory, 16 bytes for each word. Working columns of
remove_near take names that docs doesn't have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import fresh, id_key, materialize, text_key
from pennant.llm.graph import components
from pennant.llm.words import NOT_SPACE, WORD_BASES, RunHash, Words, chunks, mix

SHINGLE = 5
SIMILARITY = 0.8
COMPONENTS = 128
ROWS = 4
#: Components for texts that are compared across components of the graph.
FINE = 1024
#: Rounds of the first labelling, which only spares comparisons.
EARLY_ROUNDS = 2
FIRST_SLAB = 2.0**-9
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD1B54A32D192ED03)]


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle and the text it is of."""
    run, left = RunHash(w.hashes(), WORD_BASES[0]), w.left()
    at = np.flatnonzero((left >= SHINGLE) | (left == w.counts[w.of]))
    return run(at, at + np.minimum(left[at], SHINGLE)), w.of[at]


def _counts(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, text) with the number of times."""
    order = np.argsort(mix(h + of.astype(np.uint64) * _C[3]), kind="stable")
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    return h[first], of[first], np.diff(np.append(first, len(h)))


_cdfs: dict[float, np.ndarray] = {}


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Numbers in [0, 1) inverted through a Poisson distribution."""
    if mean not in _cdfs:
        k = np.arange(1, int(mean + 12 * mean**0.5 + 24))
        terms = np.concatenate([[-mean], -mean + np.cumsum(np.log(mean / k))])
        _cdfs[mean] = np.cumsum(np.exp(terms))
    return np.searchsorted(_cdfs[mean], u, side="right")


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _points(h: np.ndarray, of: np.ndarray, count: np.ndarray, until: np.ndarray, components: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """text, component and time of all points before each text's time is over."""
    for level in range(int(count.max()).bit_length() + 1):
        low, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        have = np.flatnonzero(count > low)
        if not len(have):
            return
        start, slab = 0.0, 0
        while len(have):
            end = FIRST_SLAB * 2.0**slab
            seed = mix(h[have] + np.uint64((int(_C[0]) * (level + 1) + int(_C[1]) * (slab + 1)) % (1 << 64)))
            n = _poisson(_unit(seed), components * width * (end - start))
            which = np.repeat(np.arange(len(have)), n)
            k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            v = mix(seed[which] + _C[2] * (k.astype(np.uint64) + np.uint64(1)))
            t = start + (end - start) * _unit(v)
            v = mix(v + _C[0])
            source = have[which]
            ok = t <= until[of[source]]
            if width > 1:
                ok &= low + width * _unit(mix(v + _C[1])) < count[source]
            yield of[source[ok]], (v[ok] & np.uint64(components - 1)).astype(np.int64), t[ok]
            have = have[until[of[have]] > end]
            start, slab = end, slab + 1


def signatures(h: np.ndarray, of: np.ndarray, n: int, components: int = COMPONENTS) -> np.ndarray:
    """n x components times of first points; infinity throughout for a text without shingles."""
    h, of, count = _counts(h, of)
    weight = np.bincount(of, weights=count, minlength=n)
    out = np.full((n, components), np.inf)
    # So many points on average for each component, and few texts lack one.
    factor = np.log(components) + 4
    while len(h):
        until = factor / np.maximum(weight, 1)
        for text, component, t in _points(h, of, count, until, components):
            np.minimum.at(out.ravel(), text * components + component, t)
        lack = np.isinf(out).any(axis=1)
        again = lack[of]
        h, of, count, factor = h[again], of[again], count[again], 2 * factor
    return out


def _sketch(signature: np.ndarray) -> np.ndarray:
    """Two bits of each component, in 64-bit numbers."""
    mixed = mix(np.ascontiguousarray(signature).view(np.uint64))
    pairs = np.stack([mixed & np.uint64(1), (mixed >> np.uint64(1)) & np.uint64(1)], axis=2).reshape(len(mixed), -1).astype(np.uint8)
    return np.packbits(pairs, axis=1).view(np.uint64)


def far_bits(components: int, similarity: float) -> int:
    """Sketch bits in which a pair at that similarity differs on average, and 4.5 standard deviations more."""
    apart = 1 - similarity
    return int(components * apart + 4.5 * (components * (1.5 * apart - apart * apart)) ** 0.5)


def _banded(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (n x 32) and sketches (n x 4)."""
    bits = np.ascontiguousarray(signature).view(np.uint64)
    bands = np.zeros((len(bits), COMPONENTS // ROWS), np.uint64) + np.arange(COMPONENTS // ROWS, dtype=np.uint64)
    for k in range(ROWS):
        bands = mix(bands * _C[0] + bits[:, k::ROWS])
    return bands, _sketch(signature)


def _sketch_finely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns as they are, but for the last one: the text becomes its fine sketch."""
    for whole in batches:
        for first in range(0, whole.num_rows, 1024):
            batch = whole.slice(first, 1024)
            rows = []
            for w in chunks(batch.column(batch.num_columns - 1), NOT_SPACE, lower=True):
                rows.append(_sketch(signatures(*shingles(w), w.last - w.first, FINE)))
            flat = np.concatenate(rows).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array((np.arange(len(flat) + 1) * flat.shape[1]).astype(np.int32)), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "sketch"])


HELD = "rid long, key long, th long, n long, c long, bands array<long>, sketch array<long>"
SIGNED = "doc_id long, key long, th long, digest binary, bands array<long>, sketch array<long>, n long"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, bands, sketches, counts = [], [], [], []
        for w in chunks(batch.column(3), NOT_SPACE, lower=True):
            raw, cuts = w.data.tobytes(), w.offsets.tolist()
            digests += [hashlib.sha256(b" ".join(raw[a:b].split())).digest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            b, s = _banded(signatures(*shingles(w), w.last - w.first))
            bands.append(b)
            sketches.append(s)
            counts.append(w.counts)
        if not digests:
            continue
        bands, sketches, counts = np.concatenate(bands), np.concatenate(sketches), np.concatenate(counts)
        empty = counts == 0
        sizes = np.where(empty, 0, bands.shape[1])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(bands[~empty].ravel().view(np.int64)))
        fixed = pa.ListArray.from_arrays(pa.array((np.arange(len(empty) + 1) * 4).astype(np.int32)), pa.array(sketches.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digests, pa.binary()), lists, fixed, pa.array(np.where(empty, 0, np.maximum(counts - SHINGLE, 0) + 1))], names=["doc_id", "key", "th", "digest", "bands", "sketch", "n"])


def _shingle_lists(column: pa.Array) -> list[np.ndarray]:
    """Sorted shingle hashes of each text."""
    out: list[np.ndarray] = []
    for w in chunks(column, NOT_SPACE, lower=True):
        h, of = shingles(w)
        cuts = np.searchsorted(of, np.arange(w.last - w.first + 1))
        out += [np.sort(h[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    if not len(a) or not len(b):
        return 0.0
    values, n = np.unique(a, return_counts=True)
    at = np.searchsorted(b, values, "left")
    both = int(np.minimum(n, np.searchsorted(b, values, "right") - at).sum())
    return both / (len(a) + len(b) - both)


def _verify(similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                sides = zip(_shingle_lists(batch.column(2)), _shingle_lists(batch.column(3)), strict=True)
                keep = pa.array([overlap(x, y) >= similarity for x, y in sides], pa.bool_())
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(keep)

    return verify


def _differing(components: int) -> Column:
    """Bits in which the sketches x0, x1, ... and y0, y1, ... differ."""
    return reduce(add, (F.bit_count(F.col(f"x{k}").bitwiseXOR(F.col(f"y{k}"))) for k in range(components // 32)))


def _words(sketch: str, prefix: str, components: int) -> list[Column]:
    """A sketch as columns, which join conditions read faster than an array."""
    return [F.get(sketch, k).alias(f"{prefix}{k}") for k in range(components // 32)]


def _pair(x: Column, y: Column) -> list[Column]:
    """Columns a, key_a, th_a, b, key_b, th_b from two structs (rid, key, th)."""
    a, b = F.least(x, y), F.greatest(x, y)
    return [a["rid"].alias("a"), a["key"].alias("key_a"), a["th"].alias("th_a"), b["rid"].alias("b"), b["key"].alias("key_b"), b["th"].alias("th_b")]


class Classes:
    """Near-duplicate classes of the texts of docs. signed: each row; leads: one row per sequence of words."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY):
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), id_key(id_col).alias("key"), text_key(text_col).alias("th"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        self.signed = materialize(rows.mapInArrow(_sign, SIGNED), "signed")
        self.texts, self.similarity = rows.select("key", "th", "text"), similarity
        leads = self.signed.groupBy("digest").agg(F.min(F.struct("key", "th", "n", "bands", "sketch")).alias("lead"))
        self.leads = materialize(leads.select("digest", "lead.*", F.monotonically_increasing_id().alias("rid")), "leads")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose texts overlap enough."""
        with_a = self.texts.withColumnsRenamed({"key": "key_a", "th": "th_a", "text": "text_a"}).join(pairs, ["key_a", "th_a"])
        both = self.texts.withColumnsRenamed({"key": "key_b", "th": "th_b", "text": "text_b"}).join(with_a, ["key_b", "th_b"])
        return materialize(both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(self.similarity), "a long, b long"), "links")

    def _possible(self, components: int) -> Column:
        """Neither sizes nor sketches rule the similarity out."""
        sizes = F.least("nx", "ny") >= F.greatest("nx", "ny") * F.lit(self.similarity)
        return sizes & (_differing(components) <= far_bits(components, self.similarity))

    def shared(self) -> DataFrame:
        """Texts by the bands that they share with others; m: texts of the band."""
        member = self.leads.select("rid", "key", "th", "n", "sketch", F.explode("bands").alias("band"))
        return materialize(member.join(member.groupBy("band").agg(F.count("*").alias("m")).filter("m > 1"), "band"), "shared")

    def hub_pairs(self, shared: DataFrame) -> DataFrame:
        """Pairs of a band's hub with each other text of the band."""
        score = shared.groupBy("rid").agg(F.sum("m").alias("score"))
        best = F.max(F.struct("score", (-F.col("rid")).alias("r"), F.struct("rid", "key", "th").alias("y"), "n", "sketch")).alias("best")
        hubs = shared.join(score, "rid").groupBy("band").agg(best)
        hubs = hubs.select("band", "best.y", F.col("best.n").alias("ny"), *_words("best.sketch", "y", COMPONENTS))
        texts = shared.select("band", F.struct("rid", "key", "th").alias("x"), F.col("n").alias("nx"), *_words("sketch", "x", COMPONENTS))
        pairs = texts.join(hubs, "band").filter((F.col("x.rid") != F.col("y.rid")) & self._possible(COMPONENTS))
        return materialize(pairs.select(*_pair(F.col("x"), F.col("y"))).distinct(), "pairs")

    def mixed_pairs(self, shared: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs with different labels in buckets that hold several."""
        held = shared.join(labels, F.col("rid") == F.col("v"), "left").select("rid", "key", "th", "n", "band", F.coalesce("c", "rid").alias("c"))
        mixed = held.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("band")
        texts = held.join(mixed, "band").groupBy("rid", "key", "th", "n", "c").agg(F.collect_set("band").alias("bands"))
        texts = texts.join(self.texts, ["key", "th"]).select("rid", "key", "th", "n", "c", "bands", "text").mapInArrow(_sketch_finely, HELD).dropDuplicates(["rid"])
        texts = materialize(texts, "mixed")

        def side(s: str) -> DataFrame:
            named = [F.col("n").alias(f"n{s}"), F.col("c").alias(f"c{s}"), F.col("bands").alias(f"bands_{s}"), F.explode("bands").alias(f"band_{s}")]
            return texts.select(F.col("rid").alias(s), *named, *_words("sketch", s, FINE))

        # A pair that shares several bands comes once, in the least of them.
        once = F.array_min(F.array_intersect("bands_x", "bands_y")) == F.col("band_x")
        pairs = side("x").join(side("y"), (F.col("band_x") == F.col("band_y")) & (F.col("cx") < F.col("cy")) & self._possible(FINE) & once)
        # Few columns in that join keep its code small; ids come to the pairs that it leaves.
        pairs = materialize(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "rest")
        for s in "ab":
            pairs = pairs.join(texts.select(F.col("rid").alias(s), F.col("key").alias(f"key_{s}"), F.col("th").alias(f"th_{s}")), s)
        return pairs

    def labels(self) -> DataFrame:
        """v, c: the class, a rid, of each text that has a link."""
        shared = self.shared()
        pairs = self.hub_pairs(shared)
        first = self.verified(pairs)
        # Texts with the same label are connected, however few the rounds.
        early = components(first, rounds=EARLY_ROUNDS)
        rest = self.mixed_pairs(shared, early).join(pairs, ["a", "b"], "left_anti")
        return components(first.unionByName(self.verified(rest)), early)

    def classes(self) -> DataFrame:
        """digest, class_id (least key of the class), and key and th of the row that stays."""
        named = self.leads.join(self.labels(), F.col("rid") == F.col("v"), "left").select("digest", "key", "th", F.coalesce("c", "rid").alias("c"))
        stays = named.groupBy("c").agg(F.min(F.struct("key", "th")).alias("s"))
        return materialize(named.join(stays, "c").select("digest", F.col("s.key").alias("class_id"), F.col("s.th").alias("keep_th")), "classes")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of docs: doc_id, class_id (least id of the class), class_size (rows), kept."""
    found = Classes(docs, id_col, text_col, similarity)
    # Texts without words share a digest, but no class.
    rows = found.signed.select("doc_id", "key", "th", "digest", (F.size("bands") == 0).alias("empty"))
    named = found.classes()
    sizes = rows.groupBy("digest").agg(F.count("*").alias("n")).join(named, "digest").groupBy("class_id", "keep_th").agg(F.sum("n").alias("class_size"))
    named = named.join(sizes, ["class_id", "keep_th"])
    out = rows.join(named, "digest")
    kept = (F.col("key") == F.col("class_id")) & (F.col("th") == F.col("keep_th"))
    class_id = F.when(F.col("empty"), F.col("doc_id")).otherwise(F.when(F.col("class_id") != F.lit((1 << 63) - 1), F.col("class_id")))
    return out.select("doc_id", class_id.alias("class_id"), F.when(F.col("empty"), F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"), (kept | F.col("empty")).alias("kept"))


def remove_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of docs for each class, with all its columns; texts without words all stay."""
    k, t = fresh(docs, "_key"), fresh(docs, "_th")
    found = Classes(docs, id_col, text_col, similarity)
    stay = found.classes().select(F.col("class_id").alias(k), F.col("keep_th").alias(t)).distinct()
    empty = found.signed.filter(F.size("bands") == 0).select(F.col("key").alias(k), F.col("th").alias(t))
    keyed = docs.withColumn(k, id_key(id_col)).withColumn(t, text_key(text_col))
    return keyed.join(stay.unionByName(empty).distinct(), [k, t], "left_semi").dropDuplicates([k, t]).select(*docs.columns)
