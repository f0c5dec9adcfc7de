"""Token ids of whole Arrow batches with public tokenizers, each distinct chunk of text encoded once.

Texts are cut before a space or line feed that stands alone between two
characters that aren't white space. Byte-level tokenizers split words there in
any case, and no piece of the sentencepiece vocabulary holds such a place, so
the ids of a text are those of its chunks in order. For the byte-level ids alone
texts are also cut between a letter and a sign, as a word often stands with more
than one. A memo per worker process
keeps the ids of the chunks it has seen, found by a 64-bit hash and the length;
it starts anew when it holds MEMO_CHUNKS.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from pennant.llm.words import BYTE_BASES, RunHash, buffers

MEMO_CHUNKS = 1 << 21
SLOT_BITS = 22
#: Chunks are joined to strings of about so many bytes for the tokenizer.
JOINED = 1 << 16
#: Texts are taken together up to so many bytes.
GROUP_BYTES = 1 << 20


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def byte_level(path: str, special: bool):
    """The tokenizer of a byte-level vocabulary, and the bytes of each id. special: its special strings in a text are their ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not special
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = {i for i in t.get_added_tokens_decoder()}
    names = {i: s for s, i in t.get_vocab(with_added_tokens=True).items()}
    return t, [(names[i].encode() if i in added else bytes(of[c] for c in names[i])) if i in names else b"" for i in range(max(names) + 1)]


@functools.cache
def signs_of(path: str) -> np.ndarray:
    """The bytes at which a byte-level tokenizer ends a run of letters: ASCII that is no letter, digit or white space, nor in a special string."""
    t, _ = byte_level(path, True)
    signs = np.zeros(256, bool)
    signs[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
    signs[list("".join(x.content for x in t.get_added_tokens_decoder().values()).encode())] = False
    return signs


@functools.cache
def pieces(path: str):
    """The sentencepiece model and the bytes of each id."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any("▁" in n.lstrip("▁") or "\n" in n for n in names):
        raise ValueError(f"a piece of {path} goes on over the begin of a word, so texts can't be cut there")
    return sp, [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]


def groups(column: pa.Array | pa.ChunkedArray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The texts first .. last-1 of a batch, their bytes and where each begins, in groups of about `most` bytes."""
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _firm_end(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is surely not white space."""
    one, two, three = (data[np.maximum(end - k, 0)] for k in (1, 2, 3))
    tail = (one & 0xC0) == 0x80
    return ((one > 0x20) & (one < 0x7F)) | (tail & (((two >= 0xC3) & (two <= 0xDF)) | ((three >= 0xE4) & (three <= 0xEE))))


def _firm_begin(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that begins at each place is surely not white space."""
    b = data[np.minimum(at, len(data) - 1)]
    return ((b > 0x20) & (b < 0x7F)) | ((b >= 0xC3) & (b <= 0xDF)) | ((b >= 0xE4) & (b <= 0xEE))


def _letter_end(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is surely a letter: A-Z, a-z, or from U+00C0 up to U+027F."""
    one, two = (data[np.maximum(end - k, 0)] for k in (1, 2))
    return ((one | 0x20) >= 0x61) & ((one | 0x20) <= 0x7A) | ((one & 0xC0) == 0x80) & ((two >= 0xC4) & (two <= 0xC9) | (two == 0xC3) & (one != 0x97) & (one != 0xB7))


def cut(data: np.ndarray, at: np.ndarray, signs: np.ndarray | None = None) -> np.ndarray:
    """Where chunks begin: at every text that isn't empty, at lone spaces and line feeds inside of one, and at signs (by byte) behind a letter."""
    full = at[1:] > at[:-1]
    mark = np.zeros(len(data), bool)
    lone = np.flatnonzero((data == 0x20) | (data == 0x0A))
    mark[lone[_firm_end(data, lone) & _firm_begin(data, lone + 1)]] = True
    mark[at[1:][full] - 1] = False
    if signs is not None:
        sign = np.flatnonzero(signs[data])
        mark[sign[_letter_end(data, sign)]] = True
    mark[at[:-1][full]] = True
    return np.flatnonzero(mark)


class Memo:
    """Numbers of chunks: equal chunks have one number.

    learn is called with the new chunks in the order of their numbers, and with
    whether each would be cut off again if it stood between others. large says of
    a number of chunks whether to start anew before the next ones.
    """

    def __init__(self, learn: Callable[[list[bytes], np.ndarray], None], forget: Callable[[], None], large: Callable[[int], bool] = lambda n: n >= MEMO_CHUNKS):
        self.learn, self.forget, self.large = learn, forget, large
        self.clear()

    def full(self) -> bool:
        return self.large(len(self.keys))

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = [np.full(1 << SLOT_BITS, -1, np.int32) for _ in range(2)]
        self.over = (np.zeros(0, np.uint64), np.zeros(0, np.int32))
        self.forget()

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.full():
            self.clear()
        keys = RunHash(data.astype(np.uint64) + np.uint64(1), BYTE_BASES[0])(start, end) ^ ((end - start).astype(np.uint64) << np.uint64(40))
        out = np.full(len(keys), -1, np.int32)
        rest = self._slots(keys, np.arange(len(keys)), out)
        if len(rest) and len(self.over[0]):
            place = np.minimum(np.searchsorted(self.over[0], keys[rest]), len(self.over[0]) - 1)
            known = self.over[0][place] == keys[rest]
            out[rest[known]] = self.over[1][place[known]]
            rest = rest[~known]
        if len(rest):
            new, first, inverse = np.unique(keys[rest], return_index=True, return_inverse=True)
            have = len(self.keys)
            raw = data.tobytes()
            b, e = start[rest[first]], end[rest[first]]
            plain = ((data[b] == 0x20) | (data[b] == 0x0A)) & (e - b > 1) & _firm_begin(data, b + 1) & _firm_end(data, e)
            self.learn([raw[i:j] for i, j in zip(b.tolist(), e.tolist(), strict=True)], plain)
            number = np.arange(have, have + len(new), dtype=np.int32)
            self.keys = np.concatenate([self.keys, new])
            left = np.arange(len(new))
            for slots, shift in zip(self.slots, (0, 30), strict=True):
                slot = ((new[left] >> np.uint64(shift)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)
                free = slots[slot] < 0
                slots[slot[free]] = number[left[free]]
                left = left[slots[slot] != number[left]]
            if len(left):
                key = np.concatenate([self.over[0], new[left]])
                order = np.argsort(key, kind="stable")
                self.over = key[order], np.concatenate([self.over[1], number[left]])[order]
            out[rest] = number[inverse]
        return out

    def _slots(self, keys: np.ndarray, rest: np.ndarray, out: np.ndarray) -> np.ndarray:
        for slots, shift in zip(self.slots, (0, 30), strict=True):
            if len(rest) and len(self.keys):
                key = keys[rest]
                got = slots[((key >> np.uint64(shift)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)]
                right = (self.keys[got] == key) & (got >= 0)
                out[rest[right]] = got[right]
                rest = rest[~right]
        return rest


def _joined(chunks: list[bytes], plain: np.ndarray) -> list[np.ndarray]:
    """Numbers of the chunks to encode together: plain ones up to about JOINED bytes, any other alone."""
    size = np.array([len(c) for c in chunks], np.int64)
    which = np.flatnonzero(plain)
    return [*(np.split(which, np.flatnonzero(np.diff(np.cumsum(size[which]) // JOINED)) + 1) if len(which) else []), *np.flatnonzero(~plain)[:, None]]


def byte_level_ids(chunks: list[bytes], plain: np.ndarray, path: str, special: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks in a row, and how many each has."""
    t, named = byte_level(path, special)
    lengths = np.array([len(b) for b in named])
    parts = _joined(chunks, plain)
    encoded = t.encode_batch_fast([b"".join([chunks[i] for i in p]).decode() for p in parts], add_special_tokens=False)
    return _split(chunks, parts, [np.array(e.ids, np.int64) for e in encoded], lengths)


def _split(chunks: list[bytes], parts: list[np.ndarray], ids: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = np.zeros(len(chunks), np.int64)
    for p, got in zip(parts, ids, strict=True):
        if len(p) == 1:
            count[p[0]] = len(got)
        else:
            ends = np.cumsum([len(chunks[i]) for i in p])
            count[p] = np.diff(np.searchsorted(np.cumsum(lengths[got]), ends, side="right"), prepend=0)
    order = np.concatenate([np.zeros(0, np.int64), *parts])
    begin = np.empty(len(chunks), np.int64)
    begin[order] = np.cumsum(count[order]) - count[order]
    return np.concatenate([np.zeros(0, np.int64), *ids])[spread(begin, count)], count


def piece_ids(chunks: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks in a row, and how many each has. A chunk begins with the space that the model adds, or goes without it."""
    sp, named = pieces(path)
    space = sp.piece_to_id("▁")
    got = sp.encode([c[1:].decode() if c[:1] == b" " else c.decode() for c in chunks], num_threads=1)
    got = [g if c[:1] == b" " else g[1:] if g[:1] == [space] else None for c, g in zip(chunks, got, strict=True)]
    if None in got:
        raise ValueError("a chunk grew together with the space before it")
    count = np.array([len(g) for g in got], np.int64)
    return np.array([i for g in got for i in g], np.int64), count


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0] .. begin[0]+count[0]-1, begin[1] .. and so on in a row."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(begin - np.cumsum(count) + count, count)


class Ids:
    """Byte-level ids of texts through a memo of their chunks."""

    def __init__(self, path: str, special: bool = True):
        self.path, self.special = path, special
        self.signs = signs_of(path)
        self.memo = Memo(self._learn, self._forget)

    def _forget(self) -> None:
        self.flat, self.count, self.begin = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, chunks: list[bytes], plain: np.ndarray) -> None:
        ids, count = byte_level_ids(chunks, plain, self.path, self.special)
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(count) - count])
        self.flat, self.count = np.concatenate([self.flat, ids.astype(np.uint32)]), np.concatenate([self.count, count])

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (with the end of the last)."""
        start = cut(data, at, self.signs)
        number = self.memo.numbers(data, start, np.append(start[1:], len(data)))
        count = self.count[number]
        return self.flat[spread(self.begin[number], count)], np.append(0, np.cumsum(count))[np.searchsorted(start, at)]


@functools.cache
def ids_of(path: str, special: bool = True) -> Ids:
    """The worker process's memo of a vocabulary."""
    return Ids(path, special)
