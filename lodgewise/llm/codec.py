"""Adaptive context-mixing range coder for token ids, many independent blocks side by side.

A block starts from an empty model and can be read alone. For each id, the id last seen behind the last two ids
(order 2) or behind the last one (order 1) is guessed; how far the guesses were right so far, with and without
regard to order (order 0), is mixed into the chance of a hit, with weights that follow the evidence. An id that was
not guessed is coded by the order-0 model: a tree over all ids, four bits of the id at a node, from the highest on. Each node
counts what followed it, so that an id costs what its frequency in the block asks for; nodes share a bounded table by their
hash. All numbers are integers, so that every machine computes the same; words have 16 bits, and carries are added up at the
end of a block.
"""

from __future__ import annotations

import numpy as np

LANES = 2048
_BITS2, _BITS1, _NODES = 11, 11, 10  # sizes of the tables of guesses and of the nodes of order 0
_SEEN = 12  # what one sight of four bits adds to their count, which starts from 1
_RAMP = np.arange(1, 17, dtype=np.uint16)  # a node holds the sums of its counts up to each of the 16: a fresh one
_STEP = (np.arange(16) >= np.arange(16)[:, None]).astype(np.uint16) * np.uint16(_SEEN)
_SURE = np.array([1, 1, 1, 2, 1, 2, 3, 3], np.int32)  # how sure a guess is: after a miss from 0, 1, 2, 3, and after a hit
_TOP, _MASK32 = 1 << 32, (1 << 32) - 1


class _Coder:
    """Range coder of several lanes: range and low (or the code less low) of each, and the place of its next word."""

    def __init__(self, lanes: int, steps: int, words: np.ndarray | None):
        self.lanes, self.decoding = lanes, words is not None
        self.range = np.full(lanes, (1 << 48) - 1, np.int64)
        self.lane = np.arange(lanes)
        if words is None:
            self.words = np.zeros((steps + steps // 4 + 64, lanes), np.int32)
            self.low, self.at = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        else:
            self.words = words
            first = words[:3].astype(np.int64)
            self.low = first[0] << 32 | first[1] << 16 | first[2]
            self.at = np.full(lanes, 3, np.int64)

    def room(self, more: int) -> None:
        if not self.decoding and self.at.max() + more >= len(self.words):
            self.words = np.concatenate([self.words, np.zeros_like(self.words[: len(self.words) // 2 + more])])

    def bit(self, part: tuple, chance: np.ndarray, bit: np.ndarray | None) -> tuple[tuple, np.ndarray]:
        low, size = part
        bound = (size >> 16) * chance
        if self.decoding:
            bit = low < bound
            low = np.where(bit, low, low - bound)
        else:
            low = np.where(bit, low, low + bound)
        return (low, np.where(bit, bound, size - bound)), bit

    def shift(self, part: tuple, at: np.ndarray, lane: np.ndarray) -> tuple[tuple, np.ndarray]:
        """Move 16 bits where the range is short of 32 (it is never short of 16)."""
        low, size = part
        need = size < _TOP
        flat = self.words.reshape(-1)
        place = at * self.lanes + lane
        if self.decoding:
            low = np.where(need, low << 16 | flat[np.minimum(place, len(flat) - 1)], low)
        else:
            flat[place] = low >> 32  # written over later where no word was due
            low = np.where(need, (low & _MASK32) << 16, low)
        return (low, size << (need.view(np.int8) << 4)), at + need

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Words (steps x lanes) with all carries added, and how many each lane has."""
        self.room(4)
        for k, value in enumerate((self.low >> 32, self.low >> 16 & 0xFFFF, self.low & 0xFFFF)):
            self.words[self.at + k, self.lane] = value
        used = self.at + 3
        top = int(used.max())
        words = self.words[:top]
        words[np.arange(top)[:, None] >= used] = 0
        carry = np.zeros(self.lanes, np.int32)
        for i in range(top - 1, -1, -1):
            total = words[i] + carry
            carry = total >> 16
            words[i] = total & 0xFFFF
        return words, used


def _order0(coder: _Coder, nodes: np.ndarray, lane: np.ndarray, deep: int, value: np.ndarray | None) -> np.ndarray:
    """Code (or find) values below 16 ** deep by the tree over all of them."""
    low, size, at = coder.low[lane], coder.range[lane], coder.at[lane]
    node, every = np.zeros(len(lane), np.int64), np.arange(0, 16 * len(lane), 16)
    for i in range(deep):
        if i < 2:  # the first two levels have all their nodes
            slot = lane if i == 0 else (lane << 4) + node + coder.lanes
        else:
            slot = (node + (1 << 4 * i)) * 0x9E3779B1
            slot >>= 11
            slot &= (1 << _NODES) - 1
            slot += (lane << _NODES) + 17 * coder.lanes
        row = nodes.take(slot)
        seen = row.view(np.uint16)
        total = seen[15::16].astype(np.int64)
        if int(total.max()) > 65535 - _SEEN:  # halved, each count stays at least 1
            full = np.flatnonzero(total > 65535 - _SEEN)
            wide = seen.reshape(-1, 16)
            wide[full] = (wide[full].astype(np.int64) + _RAMP >> 1).astype(np.uint16)
            total = seen[15::16].astype(np.int64)
        unit = size // total
        if value is None:
            goal, place = low // unit, every.copy()
            for w in (8, 4, 2, 1):
                place += (seen.take(place + (w - 1)) <= goal) * w
            four = place - every
        else:
            four = value >> 4 * (deep - 1 - i) & 15
            place = every + four
        below = seen.take(place - 1).astype(np.int64)
        below *= four > 0
        own = seen.take(place) - below
        below *= unit
        if value is None:
            low -= below
        else:
            low += below
        size = own * unit
        seen.reshape(-1, 16)[:] += _STEP.take(four, axis=0)
        nodes[slot] = row
        (low, size), at = coder.shift((low, size), at, lane)
        node = node * 16 + four
    coder.low[lane], coder.range[lane], coder.at[lane] = low, size, at
    return node


def _run(sizes: np.ndarray, bits: int, ids: np.ndarray | None, words: np.ndarray | None):
    """Code lanes whose sizes don't rise; ids below 2 ** bits - 1 (steps x lanes) go in, or come out of words."""
    lanes, steps = len(sizes), int(sizes.max(initial=0))
    coder = _Coder(lanes, steps, words)
    decoding = coder.decoding
    out = np.zeros((steps, lanes), np.int32) if decoding else ids
    table2, table1 = np.zeros(lanes << _BITS2, np.int32), np.zeros(lanes << _BITS1, np.int32)  # guesses, and how sure (2 bits)
    hit2, hit1, hit0 = np.full(lanes * 4, 8192, np.int64), np.full(lanes * 8, 8192, np.int64), np.full(lanes, 8192, np.int64)
    weight = np.full((3, lanes), 1 << 14, np.int64)
    deep = -(-bits // 4)
    nodes = np.tile(_RAMP, lanes * (17 + (1 << _NODES))).view("V32")
    every = np.arange(lanes)
    last, older = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    for t in range(steps):
        k = int(active[t])
        if t % 64 == 0:
            coder.room(64 * 8)
        lane, a, b = every[:k], last[:k], older[:k]
        x = None if decoding else ids[t, :k].astype(np.int64)
        s2 = (((b * 0x2C9277B5 + a * 0x5F356495) >> 11) & ((1 << _BITS2) - 1)) + (lane << _BITS2)
        s1 = ((a * 0x5F356495 >> 13) & ((1 << _BITS1) - 1)) + (lane << _BITS1)
        e2, e1 = table2.take(s2), table1.take(s1)
        g2, n2, g1, n1 = e2 >> 2, e2 & 3, e1 >> 2, e1 & 3
        guess = np.where(n2 > 0, g2, g1)  # the longer context first
        j2, j1 = lane * 4 + n2, lane * 8 + n1 + (g1 == g2) * 4
        p, w = np.stack((hit2.take(j2), hit1.take(j1), hit0[:k])), weight[:, :k]
        chance = (w * p).sum(0) // w.sum(0)
        part, hit = coder.bit((coder.low[:k], coder.range[:k]), chance, None if decoding else x == guess)
        part, coder.at[:k] = coder.shift(part, coder.at[:k], lane)
        coder.low[:k], coder.range[:k] = part
        goal = np.where(hit, 65280, 256)
        w += (np.where(hit, p, 65536 - p) >> 5) - (w >> 5)
        p += (goal - p) >> 5
        hit2[j2], hit1[j1] = p[0], p[1]
        hit0[:k] += (goal - hit0[:k]) >> 6
        if decoding:
            x = np.where(hit, guess, 0).astype(np.int64)
        left = np.flatnonzero(~hit)
        if len(left):
            found = _order0(coder, nodes, left, deep, None if decoding else x[left])
            if decoding:
                x[left] = found
        if decoding:
            out[t, :k] = x
        for table, slot, guess_, n in ((table2, s2, g2, n2), (table1, s1, g1, n1)):
            table[slot] = np.where(n > 1, guess_, x) << 2 | _SURE.take((guess_ == x) * 4 + n)
        older[:k], last[:k] = a, x
    return out if decoding else coder.finish()


def _runs(sizes: list[int]) -> list[list[int]]:
    """Blocks with ids, the longest first, in runs of about LANES, as even as can be: a run of few costs nearly as much."""
    order = sorted((i for i, n in enumerate(sizes) if n), key=lambda i: -sizes[i])
    each = -(-len(order) // max(1, round(len(order) / LANES)))
    return [order[at : at + each] for at in range(0, len(order), max(1, each))]


def encode(blocks: list[np.ndarray], bits: int) -> list[bytes]:
    """Code each block of ids below 2 ** bits - 1 alone."""
    out: list[bytes] = [b""] * len(blocks)
    for some in _runs([len(b) for b in blocks]):
        sizes = np.array([len(blocks[i]) for i in some])
        ids = np.zeros((int(sizes[0]), len(some)), np.int32)
        for lane, i in enumerate(some):
            ids[: sizes[lane], lane] = blocks[i]
        words, used = _run(sizes, bits, ids, None)
        words = words.T.astype("<u2")
        for lane, i in enumerate(some):
            out[i] = words[lane, : used[lane]].tobytes()
    return out


def decode(payloads: list[bytes], sizes: list[int], bits: int) -> list[np.ndarray]:
    """The ids of each block."""
    out = [np.zeros(0, np.int64)] * len(payloads)
    for some in _runs(sizes):
        counts = np.array([sizes[i] for i in some])
        words = np.zeros((max(len(payloads[i]) for i in some) // 2 + 8, len(some)), np.int32)
        for lane, i in enumerate(some):
            own = np.frombuffer(payloads[i], "<u2")
            words[: len(own), lane] = own
        ids = _run(counts, bits, None, words)
        for lane, i in enumerate(some):
            out[i] = ids[: counts[lane], lane].copy()
    return out
