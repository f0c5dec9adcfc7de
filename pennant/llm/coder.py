"""Adaptive context-mixing range coder for token ids, many blocks at a time.

Every block is coded by itself: its model begins empty. Three predictions share
an interval of 2**20 for each id: the id that last followed the last two ids,
the one that last followed the last id, and order 0, the block's ids so far. An
id that none of them holds takes the escape's share and stands as it is, in two
bytes (four where an id of the call needs more), behind the block's words. The
shares are those that each has earned in the block in the same cell: how often
both contexts have just been right, and whether they agree. Order 0 and the
shares are brought up to date whenever the number of ids has doubled, the
contexts with every id. Intervals drive a range coder with a window of 48 bits
and words of 16 bits, which passes carries on to the words before.

A block is its words, then its escaped ids, the last one first.

Blocks don't depend on each other, so the blocks of a call go in step: step i
codes the i-th id of all of them as array operations. Only the intervals need
that when coding: what the contexts and order 0 hold at each id is found for
whole blocks by sorting. The registers are doubles: sums and products below
2**53 are exact, and so is the whole part of the quotients here.
"""

from __future__ import annotations

import numpy as np

U32, U64 = np.uint32, np.uint64
#: Ids of a block.
BLOCK = 1024
TOTAL_BITS = 20
TOTAL = 1 << TOTAL_BITS
#: What order 0 and the escape have at least: no interval is so narrow that a step settles more than one word.
FLOOR = 1 << 13
WEIGHTS = TOTAL - 2 * FLOOR
#: Sizes of the hashed tables of one block, as powers of two.
ONE_BITS, TWO_BITS = 7, 8
CELLS = 32
#: An interval that came by the second context, the first, order 0 or the escape.
TWO, ONE, ZERO, ESCAPE = range(4)
#: Ids before the first update.
FIRST = 32
WINDOW, LEAST, WORD = float(1 << 48), float(1 << 32), float(1 << 16)
HASH, SHIFT = U32(0x9E3779B1), U32(7)
#: Blocks modelled at a time when coding, and decoded in step: what they need stays in the processor's caches.
MODEL_LANES, DECODE_LANES = 128, 4096


class Shares:
    """What each prediction has earned, by block and cell."""

    def __init__(self, lanes: int):
        self.counts = np.zeros((4, lanes, CELLS))
        self.update(None, 0)

    def update(self, came: np.ndarray | None, n: int) -> None:
        """came: (block * CELLS + cell) * 4 + kind of every id since the last update. n: ids that order 0 holds."""
        if came is not None:
            self.counts += np.bincount(came.ravel(), minlength=self.counts.size).reshape(-1, 4).T.reshape(self.counts.shape)
        of = self.counts.sum(axis=2)
        earned = 256 * self.counts + (np.floor(1024 * of / np.maximum(1, of.sum(axis=0))) + 16)[:, :, None]
        of = earned[0] + earned[1] + earned[2] + earned[3]
        two, one, zero = ((WEIGHTS * earned[k] / of).astype(np.int64) for k in (TWO, ONE, ZERO))
        one += two
        two[:, 1::2] = one[:, 1::2]
        unit = (zero + FLOOR) >> max(0, n.bit_length() - 1)
        self.packed = (two | (one << TOTAL_BITS) | (unit << (2 * TOTAL_BITS))).ravel()

    def ends(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the second and first context's shares and the unit of order 0, for block * CELLS + cell."""
        packed = self.packed.take(at)
        two, one = packed & (TOTAL - 1), (packed >> TOTAL_BITS) & (TOTAL - 1)
        return two.astype(np.int32), one.astype(np.int32), (packed >> (2 * TOTAL_BITS)).astype(np.int32)


def _cells(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cells of entries of both tables: id * 4 + how often it has just been right, up to 3."""
    return ((((two & U32(3)) << U32(3)) | ((one & U32(3)) << U32(1))) + ((one ^ two) < U32(4))).astype(np.uint8)


def _phases(steps: int) -> list[tuple[int, int]]:
    """From one update to the next."""
    at = [0]
    while (due := max(FIRST, 2 * at[-1])) < steps:
        at.append(due)
    return list(zip(at, [*at[1:], steps], strict=True))


def _in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """values: blocks x ids. Each block's places ordered by value, as places of all blocks and of the block, and where another value begins."""
    lanes, steps = values.shape
    key = np.sort((values << values.dtype.type(16)) | np.arange(steps, dtype=values.dtype), axis=1)
    place = (key & values.dtype.type(0xFFFF)).astype(np.int64)
    new = np.ones((lanes, steps), bool)
    new[:, 1:] = (key[:, 1:] ^ key[:, :-1]) > 0xFFFF
    return place + (np.arange(lanes) * steps)[:, None], place, new


def _entries(ids: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """The entry that each id finds in its slot of a table."""
    at, _, new = _in_order(slot)
    value, last = ids.take(at), np.zeros(ids.shape, U32)
    np.multiply(value[:, :-1], ~new[:, 1:], out=last[:, 1:])
    hit = np.zeros(ids.shape, bool)
    np.logical_and((last == value)[:, :-1], ~new[:, 1:], out=hit[:, 1:])
    runs = hit.astype(np.uint8)
    again = hit[:, 1:] & hit[:, :-1]
    runs[:, 1:] += again
    runs[:, 2:] += again[:, 1:] & hit[:, :-2]
    out = np.empty(ids.shape, U32)
    out.ravel()[at] = (last << U32(2)) | runs
    return out


def _runs(ids: np.ndarray, wide: bool) -> np.ndarray:
    """Where each id's run begins among the ids that order 0 holds then, in order, and how long it is, packed; 0 if it isn't there."""
    lanes, steps = ids.shape
    out = np.zeros(ids.size, U32)
    at, place, new = (x.ravel() for x in _in_order(ids.astype(U64) if wide else ids))
    first = np.flatnonzero(new)
    start = np.repeat(first, np.diff(first, append=len(new)))
    place = place.astype(np.int32)
    for n, _ in _phases(steps)[1:]:
        # The ids that order 0 holds come first in their run.
        held = place < n
        upto = np.cumsum(held, dtype=np.int32)
        which = np.flatnonzero((place & -n) == n)
        run = start[which]
        before = upto[run] - held[run]
        size = upto[which] - before
        out[at[which]] = (((before - which // steps * n) << 16) | size) * (size > 0)
    return out.reshape(lanes, steps)


def _model(ids: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids: blocks x ids. Begin and width of each id's interval, and which ids came by the escape."""
    lanes, steps = ids.shape
    hashed = ids * HASH
    slot = np.zeros((2, lanes, steps), U32)
    slot[0, :, 1:] = hashed[:, :-1] >> U32(32 - ONE_BITS)
    slot[1, :, 1:] = hashed[:, :-1]
    slot[1, :, 2:] ^= hashed[:, :-2] << SHIFT
    slot[1] >>= U32(32 - TWO_BITS)
    one, two, runs = _entries(ids, slot[0]), _entries(ids, slot[1]), _runs(ids, wide)
    kind = ((one >> U32(2)) != ids).astype(np.uint8)
    kind += kind * (runs == 0)
    kind = ((two >> U32(2)) != ids) * (kind + np.uint8(1))
    at = _cells(one, two) + (np.arange(lanes) * CELLS)[:, None]
    shares, begin, width = Shares(lanes), np.empty(ids.shape, np.int32), np.empty(ids.shape, np.int32)
    for i, j in _phases(steps):
        if i:
            shares.update(at[:, last:i] * 4 + kind[:, last:i], i)
        last = i
        k, run = kind[:, i:j], runs[:, i:j]
        two, one, unit = shares.ends(at[:, i:j])
        end0 = one + unit * np.int32(i)
        zero = one + unit * (run >> U32(16)).astype(np.int32)
        begin[:, i:j] = np.where(k < ZERO, two * (k == ONE), np.where(k == ZERO, zero, end0))
        size = np.where(k == ZERO, unit * (run & U32(0xFFFF)).astype(np.int32), TOTAL - end0)
        width[:, i:j] = np.where(k < ZERO, np.where(k == ONE, one - two, two), size)
    return begin, width, kind == ESCAPE


def _words(begin: np.ndarray, width: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """begin, width: ids x blocks. The words of every block in a row, and how many each has. last: ids of the last block."""
    steps, lanes = begin.shape
    low, span, who, what = np.zeros(lanes), np.full(lanes, WINDOW), [], []

    def settle(idx: np.ndarray) -> None:
        """Pass on the top word of these blocks; it may be 2**16 or more, with a carry."""
        x = low[idx]
        word = np.floor(x / LEAST)
        low[idx] = (x - word * LEAST) * WORD
        who.append(idx.astype(np.int32))
        what.append(word.astype(np.int32))

    live = lanes
    for i in range(steps):
        if i == last:
            live = lanes - 1
        unit = np.floor(span[:live] * (1 / TOTAL))
        low[:live] += unit * begin[i, :live]
        np.multiply(unit, width[i, :live], out=span[:live])
        idx = np.flatnonzero(span[:live] < LEAST)
        if idx.size:
            span[idx] *= WORD
            settle(idx)
    for _ in range(3):
        settle(np.arange(lanes))
    lane = np.concatenate(who)
    out = np.concatenate(what)[np.argsort(lane.astype(np.uint16) if lanes <= 0xFFFF else lane, kind="stable")]
    over = np.flatnonzero(out > 0xFFFF)
    while over.size:
        out[over] &= 0xFFFF
        over = over - 1
        out[over] += 1
        over = over[out[over] > 0xFFFF]
    return out.astype("<u2"), np.bincount(lane, minlength=lanes)


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[list[bytes], bool]:
    """Coded bytes of each block of `block` ids (the last may be shorter), and whether ids take four bytes."""
    if not len(ids):
        return [], False
    wide = int(ids.max()) > 0xFFFF
    lanes, steps = -(-len(ids) // block), min(block, len(ids))
    last = len(ids) - (lanes - 1) * block
    grid = np.zeros((lanes, steps), U32)
    grid.ravel()[: len(ids)] = ids
    begin, width = np.empty((steps, lanes), np.int32), np.empty((steps, lanes), np.int32)
    plain, sizes = [], []
    for k in range(0, lanes, MODEL_LANES):
        part = grid[k : k + MODEL_LANES]
        b, w, escaped = _model(part, wide)
        begin[:, k : k + MODEL_LANES], width[:, k : k + MODEL_LANES] = b.T, w.T
        if k + MODEL_LANES >= lanes:
            escaped[-1, last:] = False
        plain.append(part[:, ::-1][escaped[:, ::-1]].astype("<u4" if wide else "<u2"))
        sizes.append(escaped.sum(axis=1))
    words, count = _words(begin, width, last)
    words, plain = words.tobytes(), np.concatenate(plain).tobytes()
    ends, plain_ends = 2 * np.cumsum(count), (4 if wide else 2) * np.cumsum(np.concatenate(sizes))
    cuts = lambda at: zip([0, *at.tolist()], at.tolist())  # noqa: B905, E731
    return [words[a:b] + plain[c:d] for (a, b), (c, d) in zip(cuts(ends), cuts(plain_ends), strict=True)], wide


def _table(history: np.ndarray) -> np.ndarray:
    """history: blocks x ids, a power of two. Per block the ids in order, each with where its run begins and how long it is, packed."""
    ids = np.sort(history, axis=1, kind="stable")
    n = ids.shape[1]
    new = np.ones(ids.shape, bool)
    new[:, 1:] = ids[:, 1:] != ids[:, :-1]
    flat = np.flatnonzero(new)
    size = np.diff(flat, append=ids.size)
    run = ((flat & (n - 1)) << 16 | size).astype(U64)
    return ((ids.astype(U64) << U64(32)) | np.repeat(run, size).reshape(ids.shape)).ravel()


def _decode(blocks: list[bytes], steps: int, wide: bool) -> np.ndarray:
    """Blocks x steps. What stands after the end of a shorter block means nothing."""
    lanes, lane = len(blocks), np.arange(len(blocks))
    coded = np.frombuffer(b"".join(blocks) + bytes(2), "<u2").astype(np.uint16)
    back = np.cumsum([len(b) // 2 for b in blocks])
    at = np.append(0, back[:-1])
    code = np.zeros(lanes)
    for k in range(3):
        code = code * WORD + coded.take(at + k, mode="clip")
    at += 3
    span = np.full(lanes, WINDOW)
    out, came = np.zeros((steps, lanes), U32 if wide else np.uint16), np.empty((steps, lanes), np.uint8)
    shares, cells = Shares(lanes), lane * CELLS
    # Both tables of a block, one after the other.
    each = (1 << ONE_BITS) + (1 << TWO_BITS)
    entries, base = np.zeros(lanes * each, U32), np.stack([lane * each, lane * each + (1 << ONE_BITS)])
    slot, hashed, before = np.zeros((2, lanes), U32), np.zeros(lanes, U32), np.zeros(lanes, U32)
    ends = np.zeros((5, lanes), np.int32)
    ends[4] = TOTAL
    right = np.array([1, 2, 3, 3, 0], U32)
    phases, n, last, table = {i for i, _ in _phases(steps)} - {0}, 0, 0, None
    for i in range(steps):
        if i in phases:
            n, table = i, _table(np.ascontiguousarray(out[:i].T))
            shares.update(came[last:i] + lane * (4 * CELLS), n)
            last = i
        np.right_shift(hashed, U32(32 - ONE_BITS), out=slot[0])
        np.right_shift(hashed ^ before, U32(32 - TWO_BITS), out=slot[1])
        place = base + slot
        found = entries.take(place)
        cell = _cells(found[0], found[1])
        ends[1], ends[2], step = shares.ends(cells + cell)
        np.add(ends[2], step * np.int32(n), out=ends[3])
        unit = np.floor(span * (1 / TOTAL))
        v = np.minimum(code / unit, TOTAL - 1).astype(np.int32)
        not2 = v >= ends[1]
        kind = not2.view(np.uint8) + (v >= ends[2]).view(np.uint8) + (v >= ends[3]).view(np.uint8)
        came[i] = (cell << np.uint8(2)) | kind
        to = kind * np.int64(lanes) + lane
        begin = ends.take(to)
        width = ends.take(to + lanes) - begin
        guess = found >> U32(2)
        x = np.where(not2, guess[0], guess[1])
        if n:
            idx = np.flatnonzero(kind == ZERO)
            one, u = begin[idx], step[idx]
            run = table.take(idx * n + ((v[idx] - one) / u).astype(np.int64))
            x[idx] = run >> U64(32)
            begin[idx] = one + u * ((run >> U64(16)) & U64(0xFFFF)).astype(np.int32)
            width[idx] = u * (run & U64(0xFFFF)).astype(np.int32)
        idx = np.flatnonzero(kind == ESCAPE)
        if idx.size:
            p = back[idx] - (2 if wide else 1)
            back[idx] = p
            x[idx] = coded.take(p, mode="clip").astype(U32) | (coded.take(p + 1, mode="clip").astype(U32) << U32(16) if wide else U32(0))
        code -= unit * begin
        np.multiply(unit, width, out=span)
        idx = np.flatnonzero(span < LEAST)
        if idx.size:
            p = at[idx]
            code[idx] = code[idx] * WORD + coded.take(p, mode="clip")
            span[idx] *= WORD
            at[idx] = p + 1
        out[i] = x
        new = x << U32(2)
        entries[place] = new + right.take(np.minimum(found - new, U32(4)))
        np.left_shift(hashed, SHIFT, out=before)
        np.multiply(x, HASH, out=hashed)
    return np.ascontiguousarray(out.T)


def decode(blocks: list[bytes], n_ids: int, wide: bool, block: int = BLOCK) -> np.ndarray:
    """The ids of encode's blocks."""
    if not n_ids:
        return np.zeros(0, U32)
    steps = min(block, n_ids)
    out = np.empty((len(blocks), steps), U32)
    for k in range(0, len(blocks), DECODE_LANES):
        out[k : k + DECODE_LANES] = _decode(blocks[k : k + DECODE_LANES], steps, wide)
    return out.ravel()[:n_ids]
