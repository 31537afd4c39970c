"""Adaptive context-mixing range coder for token ids.

A block of ids is cut into lanes of equal length that are coded side by side,
one id of every lane a step, so each step is a handful of numpy operations.
All lanes share one model, which starts empty in every block and learns from
every id coded so far:

* order 2: the id last seen after the two ids before (hashed slots), with a
  confidence that counts how often it was right;
* order 1: the same for the id before;
* order 0: adaptive frequencies of all ids.

The mix gives weights to "order 2 is right", "order 1 is right" and "neither"
from how often each was so under the same two confidences; under "neither" the
id is coded by its order-0 frequency.  Frequencies are turned into coding
ranges every ``REFRESH`` steps.  Each lane has its own 64-bit range coder that
puts out 32-bit words; the decoder repeats the same steps.

A block: ``b"VTB1"``, ids, vocabulary and lanes as unsigned 32-bit numbers,
the lanes' word counts, their words, and a CRC-32 of all that (little-endian).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"VTB1"
LANES = 8192
LANE = 64  # ids of a lane at least, where a block has few
SLOTS = 1 << 18  # 32-bit hash, upper 18 bits
REFRESH = 16
KIND_BITS, ID_BITS, WORD = 12, 20, 32
SURE = 7
U = np.uint64
LOW = U((1 << WORD) - 1)
NEXT = np.minimum(np.arange(SURE + 1) + 1, SURE).astype(np.uint8)


class Model:
    """What both directions know before the next id of every lane."""

    def __init__(self, vocabulary: int, lanes: int):
        self.vocabulary = vocabulary
        self.guess1, self.sure1 = np.zeros(vocabulary, np.int32), np.zeros(vocabulary, np.uint8)
        self.guess2, self.sure2 = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.uint8)
        self.one, self.two = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        self.kinds = np.ones((2 * (SURE + 1) ** 2, 3), np.int64)
        self.seen, self.waiting, self.steps = np.zeros(vocabulary, np.int64), [], 0
        self.refresh()

    def refresh(self) -> None:
        if self.waiting:
            self.seen += np.bincount(np.concatenate(self.waiting), minlength=self.vocabulary)
            self.waiting = []
        # products with one factor, rounded down: the same in both directions, and never over the sum
        width = 1 + (self.seen * (((1 << ID_BITS) - self.vocabulary) / max(1, int(self.seen.sum())))).astype(np.int64)
        self.id_freq = width.astype(U)
        ends = np.cumsum(width)
        self.ends, self.id_of = ends, None
        self.id_from = (ends - width).astype(U)
        k = 1 + self.kinds * ((1 << KIND_BITS) - 3) // self.kinds.sum(1, keepdims=True)
        self.kind_freq = k.astype(U).ravel()
        ends = np.cumsum(k, 1)
        self.kind_from = (ends - k).astype(U).ravel()
        self.first, self.second = ends[:, 0].astype(U), ends[:, 1].astype(U)

    def drawn(self, place: np.ndarray) -> np.ndarray:
        """Ids whose coding ranges hold the places."""
        if self.id_of is None:
            self.id_of = np.repeat(np.arange(self.vocabulary, dtype=np.int32), np.diff(self.ends, prepend=0))
        return self.id_of[np.minimum(place, len(self.id_of) - 1)]

    def look(self) -> np.ndarray:
        """The lanes' contexts: both confidences and whether the guesses agree."""
        self.slot = ((self.two.astype(np.uint32) * np.uint32(0x9E3779B1) + self.one.astype(np.uint32) * np.uint32(0x85EBCA6B)) >> np.uint32(14)).astype(np.int64)
        self.by2, self.by1 = self.guess2[self.slot], self.guess1[self.one]
        self.c2, self.c1 = self.sure2[self.slot], self.sure1[self.one]
        self.agree = self.by2 == self.by1
        return ((self.c2 << 4) | (self.c1 << 1) | self.agree).astype(np.int64)

    def learn(self, context: np.ndarray, kind: np.ndarray, x: np.ndarray, rare: np.ndarray) -> None:
        for guess, sure, at, by, c in ((self.guess2, self.sure2, self.slot, self.by2, self.c2), (self.guess1, self.sure1, self.one, self.by1, self.c1)):
            right = x == by
            guess[at] = np.where(right | (c > 1), by, x)
            sure[at] = np.where(right, NEXT[c], c >> 1)
        self.kinds += np.bincount(context * 3 + kind, minlength=self.kinds.size).reshape(self.kinds.shape)
        self.waiting.append(rare)
        self.two, self.one = self.one, x
        self.steps += 1
        if self.steps % REFRESH == 0:
            self.refresh()


def _lanes(n: int) -> int:
    return max(1, min(LANES, n // LANE))


def _settle(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Lanes whose range is used up; a range over a word's edge is cut there."""
    m = np.flatnonzero(size <= LOW)
    if len(m):
        lo, n = low[m], size[m]
        over = ((lo ^ (lo + n - U(1))) >> U(WORD)) != 0
        size[m] = np.where(over, (LOW ^ (lo & LOW)) + U(1), n) << U(WORD)
    return m


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    n = len(ids)
    lanes = _lanes(n)
    steps = -(-n // lanes)
    table = np.zeros(lanes * steps, np.int32)
    table[:n] = ids
    table = np.ascontiguousarray(table.reshape(lanes, steps).T)
    vocabulary = max(vocabulary, int(ids.max()) + 1 if n else 1)
    model = Model(vocabulary, lanes)
    low, size = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
    words, lane_of = [], []
    for x in table:
        context = model.look()
        kind = np.where(x == model.by2, 0, 2 - (x == model.by1))
        k = context * 3 + kind
        r = size >> U(KIND_BITS)
        low += model.kind_from[k] * r
        size = model.kind_freq[k] * r
        e = np.flatnonzero(kind == 2)
        rare = x[e]
        r = size[e] >> U(ID_BITS)
        low[e] += model.id_from[rare] * r
        size[e] = model.id_freq[rare] * r
        m = _settle(low, size)
        if len(m):
            words.append((low[m] >> U(WORD)).astype(np.uint32))
            lane_of.append(m)
            low[m] <<= U(WORD)
        model.learn(context, kind, x, rare)
    every = np.arange(lanes)
    words += [(low >> U(WORD)).astype(np.uint32), (low & LOW).astype(np.uint32)]
    lane_of += [every, every]
    lane = np.concatenate(lane_of)
    body = np.concatenate(words)[np.argsort(lane, kind="stable")]
    out = MAGIC + struct.pack("<III", n, vocabulary, lanes) + np.bincount(lane, minlength=lanes).astype("<u4").tobytes() + body.astype("<u4").tobytes()
    return out + struct.pack("<I", zlib.crc32(out))


def decode(block: bytes) -> np.ndarray:
    if block[:4] != MAGIC or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("token block is damaged: magic or checksum differs")
    n, vocabulary, lanes = struct.unpack_from("<III", block, 4)
    counts = np.frombuffer(block, "<u4", lanes, 16).astype(np.int64)
    words = np.frombuffer(block[16 + 4 * lanes : -4], "<u4").astype(U)
    at = np.cumsum(counts) - counts
    words = np.r_[words, U(0)]
    steps = -(-n // lanes)
    table = np.empty((steps, lanes), np.int32)
    model = Model(vocabulary, lanes)
    low, size = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)
    code = (words[at] << U(WORD)) | words[at + 1]
    at += 2
    for t in range(steps):
        context = model.look()
        r = size >> U(KIND_BITS)
        v = code - low
        kind = (v >= model.first[context] * r).astype(np.int64) + (v >= model.second[context] * r)
        k = context * 3 + kind
        low += model.kind_from[k] * r
        size = model.kind_freq[k] * r
        x = np.where(kind == 0, model.by2, model.by1)
        e = np.flatnonzero(kind == 2)
        r = size[e] >> U(ID_BITS)
        rare = model.drawn(((code[e] - low[e]) // r).astype(np.int64))
        x[e] = rare
        low[e] += model.id_from[rare] * r
        size[e] = model.id_freq[rare] * r
        m = _settle(low, size)
        if len(m):
            low[m] <<= U(WORD)
            code[m] = (code[m] << U(WORD)) | words[np.minimum(at[m], len(words) - 1)]
            at[m] += 1
        model.learn(context, kind, x, rare)
        table[t] = x
    return table.T.reshape(-1)[:n].astype(np.int64)
