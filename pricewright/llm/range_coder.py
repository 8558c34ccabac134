"""Adaptive context-mixing range coder for token ids, many blocks in step.

Blocks are independent: each starts with an empty model, so a task codes
thousands of them side by side with one array operation per step of the model.

The model of a block predicts the next id from its last two ids (order 2) and
from its last id (order 1): the id that followed last time, with a confidence
from 0 to 3. Which of the predictions is right, or neither, is coded with adaptive
shares for each pair of confidences, which mixes the two. An id that neither
predicted is coded by order 0: adaptive counts of its upper eight bits, turned
into shares after 16, 32, 64, 128 and every further 256 ids, the rest as it is.

Shares are parts of a power of two, so that coding an id takes no division. The
range has 63 bits and is refilled by one word of 32 bits at most for each id; a
word is held with its carry until the end, when carries go into the words before.

A coded block is: magic, version, bits of an id, number of ids, CRC-32 of the ids
as little-endian unsigned 32-bit integers, then the words of the range coder.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TIDB"
VERSION = 2
HEADER = struct.Struct("<4sBBHII")

SLOT_BITS1, SLOT_BITS2 = 10, 11
#: Odd multipliers of the hashes of the last id and of the last two.
MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
WORD, RANGE_BITS = 32, 63
BOTTOM = 1 << RANGE_BITS - WORD
#: A prediction is an id and, below it, the confidence at the place that it has in a context.
ID_SHIFT, CONTEXTS = 5, 32
#: Of orders 1 and 2.
ONE, MOST = np.array([[2], [8]], np.int32), np.array([[6], [24]], np.int32)
#: A context holds where the shares of the second and the third event begin, in parts of
#: 2 ** EVENT_BITS; they lie in 32 bits each of one number and move by 2 ** -EVENT_RATE.
EVENT_BITS, EVENT_RATE = 14, 5
EVENT_MASK = (1 << EVENT_BITS) - 1
EVENT_START = 1 << EVENT_BITS - 2 | 1 << 32 + EVENT_BITS - 1
EVENT_STEPS = ((1 << EVENT_BITS) >> EVENT_RATE) - 2
#: Added when the first, second or third event comes; the shares stay one part or more.
EVENT_ADDED = np.array([a | b << 32 for a, b in ((EVENT_STEPS - 1, EVENT_STEPS), (1, EVENT_STEPS), (1, 2))], np.uint64)
EVENT_MOVES = (EVENT_MASK >> EVENT_RATE) * (1 | 1 << 32)
CLASSES, SHARE_BITS = 256, 11
#: 9 bits of event, 11 of class and the rest of an id fit into the 31 that a range has at least.
MOST_BITS = 19
#: Lanes that share a cache line, turned from blocks to steps and back together.
TURNED = 16


class _Model:
    """Predictions and counts of ``lanes`` blocks."""

    def __init__(self, lanes: int, bits: int, decoding: bool = False):
        self.decoding, self.lanes = decoding, lanes
        self.rest = max(0, bits - 8)
        slots1, slots2 = 1 << SLOT_BITS1, 1 << SLOT_BITS2
        self.known = np.zeros(lanes * (slots1 + slots2), np.int32)
        self.events = np.full(lanes * CONTEXTS, EVENT_START, np.uint64)
        self.classes = np.zeros((lanes, CLASSES), np.float32)
        self.kinds = np.tile(np.arange(CLASSES, dtype=np.uint8), lanes) if decoding else None
        self.waiting: list[np.ndarray] = []  # places in the classes, not counted so far
        self.share()
        # the last ids, multiplied for the hashes
        self.last1, self.last2 = np.zeros(lanes, np.uint64), np.zeros(lanes, np.uint64)
        lane = np.arange(lanes, dtype=np.uint64)
        self.base, self.contexts = np.stack((lane * slots1, lane * slots2 + lanes * slots1)), lane.view(np.int64) * CONTEXTS

    def keep(self, k: int) -> None:
        """Go on with the first ``k`` blocks; the others have ended."""
        self.last1, self.last2, self.base, self.contexts = self.last1[:k], self.last2[:k], self.base[:, :k], self.contexts[:k]

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Predictions of orders 1 and 2, and the event shares of their context."""
        at = np.empty(self.base.shape, np.uint64)
        np.right_shift(self.last1, 64 - SLOT_BITS1, out=at[0])
        second = np.multiply(self.last1, MIX2, out=at[1])
        second += self.last2
        second >>= 64 - SLOT_BITS2
        at += self.base
        self.at = at.view(np.int64)
        self.known_there = p = self.known.take(self.at)
        self.sure = p & MOST
        context = self.sure[0] | self.sure[1]
        context |= (p[0] ^ p[1]) < 1 << ID_SHIFT
        self.context = self.contexts + context
        self.shares = self.events.take(self.context)
        return p, self.shares

    def learn(self, ids: np.ndarray, not_first: np.ndarray, third: np.ndarray) -> None:
        moved = self.shares >> EVENT_RATE
        moved &= EVENT_MOVES
        shares = self.shares - moved
        shares += EVENT_ADDED.take(not_first.view(np.uint8) + third.view(np.uint8))
        self.events[self.context] = shares
        anew = ids << ID_SHIFT
        p = self.known_there
        wrong = np.where(self.sure, p - ONE, anew)
        self.known[self.at] = np.where((p ^ anew) < 1 << ID_SHIFT, np.minimum(p + ONE, anew | MOST), wrong)
        self.last2 = self.last1
        self.last1 = ids.astype(np.uint64)
        self.last1 *= MIX1

    def share(self) -> None:
        """Turn the counts of classes into shares of 2 ** SHARE_BITS, one at least."""
        spare = np.float32((1 << SHARE_BITS) - CLASSES)
        # single precision: the rounding is the same wherever a block is read
        each = (self.classes * (spare / np.maximum(np.float32(1), self.classes.sum(axis=1, keepdims=True)))).astype(np.int32)
        each += 1
        each[np.arange(len(each)), self.classes.argmax(axis=1)] += (1 << SHARE_BITS) - each.sum(axis=1, dtype=np.int32)
        # where a share begins, and its size
        parts = np.cumsum(each, axis=1, dtype=np.int32)
        parts -= each
        parts <<= 16
        parts |= each
        self.parts = parts.ravel()
        self.slots = np.repeat(self.kinds, each.ravel()) if self.decoding else None

    def due(self, t: int) -> None:
        """Count the classes that waited, at the steps that ask for it."""
        if (t in (16, 32, 64, 128) or t and t % 256 == 0) and self.waiting:
            self.classes += np.bincount(np.concatenate(self.waiting), minlength=self.classes.size).reshape(self.classes.shape)
            self.waiting = []
            self.share()


def _span(size: np.ndarray, second: np.ndarray, third: np.ndarray, not_first: np.ndarray, is_third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of the event's share of a range."""
    begin = np.where(is_third, third, second * not_first)
    end = np.where(is_third, size, np.where(not_first, third, second))
    end -= begin
    return begin, end


def encode_blocks(blocks: list[np.ndarray], bits: int) -> list[bytes]:
    """Coded form of each block of ids below 2 ** bits."""
    if not blocks:
        return []
    if bits > MOST_BITS:
        raise ValueError(f"ids have {MOST_BITS} bits at most")
    order = sorted(range(len(blocks)), key=lambda b: -len(blocks[b]))
    lengths = np.array([len(blocks[b]) for b in order])
    steps, lanes = int(lengths[0]), len(blocks)
    ids = np.zeros((steps, lanes), np.int32)
    for a in range(0, lanes, TURNED):
        some = np.zeros((len(order[a : a + TURNED]), steps), np.int32)
        for row, b in zip(some, order[a : a + TURNED]):
            row[: len(blocks[b])] = blocks[b]
        ids[:, a : a + TURNED] = some.T
    model = _Model(lanes, bits)
    rest_mask = (1 << model.rest) - 1
    lows, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << RANGE_BITS) - 1, np.uint64)
    low = lows
    width_words = steps + 2
    words, used = np.zeros(lanes * width_words, np.uint64), np.arange(lanes) * width_words
    active = np.searchsorted(-lengths, -np.arange(steps), side="left").tolist()
    k = lanes
    for t in range(steps):
        if active[t] < k:
            k = active[t]
            model.keep(k)
            low, size = low[:k], size[:k]
        x = ids[t, :k]
        model.due(t)
        p, shares = model.predict()
        x_high = x << ID_SHIFT
        not_first = (p[1] ^ x_high) >= 1 << ID_SHIFT
        third = (p[0] ^ x_high) >= 1 << ID_SHIFT
        third &= not_first
        r = size >> EVENT_BITS
        begin, size = _span(size, r * (shares & EVENT_MASK), r * (shares >> 32), not_first, third)
        plain = third.nonzero()[0]
        if len(plain):
            y = x[plain]
            at = plain * CLASSES
            at += y >> model.rest
            model.waiting.append(at)
            part = model.parts.take(at).astype(np.uint64)
            r = size[plain] >> SHARE_BITS
            a = r * (part >> 16)
            r *= part & 0xFFFF
            r >>= model.rest
            a += r * (y & rest_mask).astype(np.uint64)
            begin[plain] += a
            size[plain] = r
        low += begin
        go = (size < BOTTOM).nonzero()[0]
        if len(go):
            a, at = low[go], used[go]
            # 33 bits: the first is a carry
            words[at] = a >> RANGE_BITS - WORD
            used[go] = at + 1
            low[go] = (a & BOTTOM - 1) << WORD
            size[go] <<= WORD
        model.learn(x, not_first, third)
    words[used] = lows >> RANGE_BITS - WORD
    words[used + 1] = (lows & BOTTOM - 1) << 1
    used += 2 - np.arange(lanes) * width_words
    final = _carried(words.reshape(lanes, width_words)[:, : used.max()])
    out: list[bytes] = [b""] * lanes
    for lane, b in enumerate(order):
        crc = zlib.crc32(np.asarray(blocks[b], "<u4").tobytes())
        out[b] = HEADER.pack(MAGIC, VERSION, bits, 0, len(blocks[b]), crc) + final[lane, : used[lane]].tobytes()
    return out


def _carried(words: np.ndarray) -> np.ndarray:
    """Words of 32 bits after all carries, moved by the bit by which two are wider than the range."""
    words = words.copy()
    while True:
        carry = words[:, 1:] >> WORD
        if not carry.any():
            break
        words[:, 1:] &= (1 << WORD) - 1
        words[:, :-1] += carry
    final = words >> 1
    final[:, 1:] |= (words[:, :-1] & 1) << WORD - 1
    return final.astype("<u4")


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """Ids of each coded block; a damaged block raises ValueError."""
    if not coded:
        return []
    heads = [HEADER.unpack_from(c) for c in coded]
    if any(h[0] != MAGIC or h[1] != VERSION or h[2] != heads[0][2] for h in heads):
        raise ValueError("not a coded block of this version, or blocks of different id widths")
    order = sorted(range(len(coded)), key=lambda b: -heads[b][4])
    lengths = np.array([heads[b][4] for b in order])
    steps, lanes = int(lengths[0]), len(coded)
    bodies = [np.frombuffer(coded[b], "<u4", offset=HEADER.size) for b in order]
    width_words = max(len(w) for w in bodies) + 2
    words = np.zeros((lanes, width_words), np.uint64)
    for lane, w in enumerate(bodies):
        words[lane, : len(w)] = w
    words = words.ravel()
    used = np.arange(lanes) * width_words
    model = _Model(lanes, heads[0][2], True)
    rest_mask = (1 << model.rest) - 1
    size = np.full(lanes, (1 << RANGE_BITS) - 1, np.uint64)
    # the code, less the low end of the range
    ahead = words[used] << WORD | words[used + 1]
    used += 2
    ids = np.zeros((steps, lanes), np.int32)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left").tolist()
    k = lanes
    for t in range(steps):
        if active[t] < k:
            k = active[t]
            model.keep(k)
            ahead, size = ahead[:k], size[:k]
        model.due(t)
        p, shares = model.predict()
        r = size >> EVENT_BITS
        second, last = r * (shares & EVENT_MASK), r * (shares >> 32)
        not_first, third = ahead >= second, ahead >= last
        begin, size = _span(size, second, last, not_first, third)
        ahead -= begin
        x = np.where(not_first, p[0], p[1])
        x >>= ID_SHIFT
        plain = third.nonzero()[0]
        if len(plain):
            a = ahead[plain]
            r = size[plain] >> SHARE_BITS
            slot = np.minimum(a // r, (1 << SHARE_BITS) - 1).view(np.int64)
            slot += plain << SHARE_BITS
            kind = model.slots.take(slot)
            at = plain * CLASSES
            at += kind
            model.waiting.append(at)
            part = model.parts.take(at).astype(np.uint64)
            a -= r * (part >> 16)
            r *= part & 0xFFFF
            r >>= model.rest
            tail = np.minimum(a // r, rest_mask)
            a -= r * tail
            ahead[plain] = a
            size[plain] = r
            x[plain] = kind.astype(np.int32) << model.rest | tail.astype(np.int32)
        go = (size < BOTTOM).nonzero()[0]
        if len(go):
            at = used[go]
            ahead[go] = ahead[go] << WORD | words.take(at, mode="clip")
            used[go] = at + 1
            size[go] <<= WORD
        model.learn(x, not_first, third)
        ids[t, :k] = x
    out: list[np.ndarray] = [np.zeros(0, "<u4")] * lanes
    for a in range(0, lanes, TURNED):
        some = np.ascontiguousarray(ids[:, a : a + TURNED].T).astype("<u4")
        for lane, (row, b) in enumerate(zip(some, order[a : a + TURNED]), a):
            found = row[: lengths[lane]]
            if zlib.crc32(found.tobytes()) != heads[b][5]:
                raise ValueError("checksum of a block does not match its ids")
            out[b] = found
    return out
