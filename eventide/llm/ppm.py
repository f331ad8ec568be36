"""Prediction by partial matching over bytes, as arrays.

A model of depth K holds, for every context of 0..K bytes seen in training, how often each
symbol followed it.  A symbol is coded by the longest context that was seen: with T counted
followers of d kinds there, a known follower with count n gets n / (T + d), and the escape
d / (T + d) (escape method C) passes to the context one byte shorter, where the symbols of
the longer context are excluded.  Whatever is left after the empty context is uniform over
the symbols not yet excluded.  The probabilities of all symbols sum to 1.

Texts are coded as K start marks, their bytes, and one end mark.

All symbols that followed a context also followed its suffix.  So what an exclusion removes
from a context depends only on the next longer context, and each trie node can hold the
logarithms ready for use: scoring a byte is one table look-up when its longest context knows
it, and one more for every escape.
"""

from __future__ import annotations

import numpy as np

START, END = 0xFE, 0xFF     # bytes that UTF-8 never uses
SYMBOLS = 255               # all byte values but START


def lay_out(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end with marks; and where each one's first symbol stands."""
    lead = bytes([START]) * depth
    data = np.frombuffer(b"".join([lead + t + b"\xff" for t in texts]), np.uint8)
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + depth + 1
    return data, np.cumsum(lengths) - lengths + depth


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """Code of the ``size`` bytes that end at each place from ``size - 1`` on."""
    n = len(data) - size + 1
    code = np.zeros(max(n, 0), np.int64)
    for j in range(size):
        code <<= 8
        code |= data[j:j + n]
    return code


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts of equal codes."""
    code = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def count_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, symbol) codes of full depth, with counts."""
    data, _ = lay_out(texts, depth)
    code = grams(data, depth + 1)
    code = code[(code & 255) != START]
    return np.unique(code, return_counts=True)


class CodeMap:
    """Vectorised look-up of non-negative integers below 2**62 (open addressing)."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 2 - 1).bit_length()) if len(keys) else 4
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rows = np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slots(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[left[free]]      # the last writer stays
            won = self.keys[slot] == keys[left]
            self.rows[slot[won]] = left[won]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Row of each code, -1 where it is unknown."""
        slot = self._slots(codes)
        seen = self.keys[slot]
        out = np.where(seen == codes, self.rows[slot], np.int32(-1))
        left = np.flatnonzero((seen != codes) & (seen >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            seen = self.keys[slot[left]]
            hit = seen == codes[left]
            out[left[hit]] = self.rows[slot[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out


class Level:
    """Nodes of one context length: followers (pairs) and contexts."""

    def __init__(self, code: np.ndarray, n: np.ndarray):
        self.code, self.n = code, n
        ctx = code >> 8
        self.first = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1])) if len(ctx) else np.zeros(0, np.int64)
        self.ctx = ctx[self.first]
        self.total = np.add.reduceat(n, self.first) if len(ctx) else n
        self.kinds = np.diff(np.append(self.first, len(code)))


def trie(code: np.ndarray, n: np.ndarray, depth: int) -> list[Level]:
    """Levels 0..depth from the sorted codes of full depth."""
    levels = [Level(code, n)]
    for k in range(depth - 1, -1, -1):
        short = code & ((1 << 8 * (k + 1)) - 1)
        levels.append(Level(*merge_counts([(short, n)])))
    return levels[::-1]


class Model:
    """Frozen statistics, ready for scoring (natural logarithms).

    With ``base``, a shallower model of all counts, ``code`` may be a part of the trie: all codes
    of some contexts one byte longer than those of ``base``.  Codes of these contexts are valued
    as by the model of all counts.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray, depth: int, base: Model | None = None):
        self.depth = depth
        levels = trie(code, n, depth)
        self.pairs, self.hit, self.ctxs, self.escape, self.step = [], [], [], [], []
        if base is not None:
            for mine, theirs in zip((self.pairs, self.hit, self.ctxs, self.escape, self.step),
                                    (base.pairs, base.hit, base.ctxs, base.escape, base.step)):
                mine.extend(theirs)
            levels[base.depth] = base.top
        self.top = levels[-1]
        for k in range(len(self.pairs), depth + 1):
            lv = levels[k]
            whole = (lv.total + lv.kinds).astype(float)
            row = np.repeat(np.arange(len(lv.ctx)), lv.kinds)
            self.pairs.append(CodeMap(lv.code))
            # as the longest seen context, and (below) under the exclusions of a longer one
            self.hit.append((np.log(lv.n / whole[row]).astype(np.float32), np.log(lv.n).astype(np.float32)))
            self.ctxs.append(CodeMap(lv.ctx))
            self.escape.append(np.log(lv.kinds / whole).astype(np.float32))
            if k:
                below = levels[k - 1]
                short = lv.code & ((1 << 8 * k) - 1)
                at = np.searchsorted(below.code, short)
                taken = np.add.reduceat(below.n[at], lv.first)
                home = np.searchsorted(below.ctx, lv.ctx & ((1 << 8 * (k - 1)) - 1)) if k > 1 else np.zeros(len(lv.ctx), np.int64)
                left = below.total[home] - taken
                kinds = below.kinds[home] - lv.kinds
                denom = np.maximum(left + kinds, 1).astype(float)
                # (log of what divides a count one level down, log of the escape there)
                self.step.append((np.log(denom).astype(np.float32),
                                  np.where(kinds > 0, np.log(np.maximum(kinds, 1) / denom), 0.0).astype(np.float32)))
            else:
                self.step.append(None)
        if base is None:
            known = len(levels[0].code) if len(code) else 0
            self.unseen = np.float32(-np.log(max(SYMBOLS - known, 1)))
        else:
            self.unseen = base.unseen

    def values(self, full: np.ndarray) -> np.ndarray:
        """Natural log probability of each (context, symbol) code of full depth."""
        value_of, _ = self.hit[self.depth]
        row = self.pairs[self.depth].find(full)
        known = row >= 0
        out = np.zeros(len(full), np.float32)
        out[known] = value_of[row[known]]
        left = np.flatnonzero(~known)
        out[left] = self._escaped(full[left])
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Natural log probability of each text."""
        if not texts:
            return np.zeros(0)
        data, first = lay_out(texts, self.depth)
        full = grams(data, self.depth + 1)
        coded = (full & 255) != START
        value = np.zeros(len(full))
        value[coded] = self.values(full[coded])
        return np.add.reduceat(value, first - self.depth)

    def _escaped(self, full: np.ndarray) -> np.ndarray:
        """Symbols that their longest context does not know."""
        out = np.zeros(len(full), np.float32)
        open_ = np.arange(len(full))
        above = np.full(len(full), -1, np.int64)      # row of the next longer seen context
        for k in range(self.depth, -1, -1):
            code = full[open_] & ((1 << 8 * (k + 1)) - 1)
            ctx = self.ctxs[k].find(code >> 8)
            pair = self.pairs[k].find(code)
            under = above[open_] >= 0
            hit = pair >= 0
            plain, bare = self.hit[k]
            a, b = hit & ~under, hit & under
            out[open_[a]] += plain[pair[a]]
            if b.any():
                out[open_[b]] += bare[pair[b]] - self.step[k + 1][0][above[open_[b]]]
            a, b = ~hit & ~under & (ctx >= 0), ~hit & under
            out[open_[a]] += self.escape[k][ctx[a]]
            if b.any():
                out[open_[b]] += self.step[k + 1][1][above[open_[b]]]
            above[open_] = ctx
            open_ = open_[~hit]
        out[open_] += self.unseen
        return out


class Frozen:
    """Counts as they travel to the workers; each worker process builds its model once."""

    def __init__(self, code: np.ndarray, n: np.ndarray, depth: int):
        self.code, self.n, self.depth, self._model = code, n, depth, None

    def model(self) -> Model:
        if self._model is None:
            self._model = Model(self.code, self.n, self.depth)
            self.code = self.n = None
        return self._model


def dense(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """A model of depth 2 as a table: the row of every two-byte context, and the log
    probability of each symbol in each row.

    A context never seen as two bytes is coded by its last byte alone and shares a row with
    all such contexts, so there are at most 65,536 + 256 rows of 256 values (64 MiB).
    """
    seen = model.ctxs[2].keys[model.ctxs[2].keys >= 0]
    row = len(seen) + (np.arange(1 << 16) & 255)
    row[seen] = np.arange(len(seen))
    never = 0xC0 << 8                       # 0xC0 is no byte of UTF-8
    ctx = np.concatenate([seen, never | np.arange(256)])
    code = (ctx[:, None] << 8 | np.arange(256)[None, :]).ravel()
    return row.astype(np.int32), model.values(code).reshape(-1, 256)


def dense_score(tables: list[tuple[np.ndarray, np.ndarray]], texts: list[bytes]) -> np.ndarray:
    """Natural log probability of each text (rows) under each table (columns)."""
    data, first = lay_out(texts, 2)
    code = grams(data, 3)
    ctx, symbol = code >> 8, code & 255
    off = symbol == START
    out = np.empty((len(texts), len(tables)))
    for j, (row, value) in enumerate(tables):
        v = value.ravel()[row[ctx].astype(np.int64) * 256 + symbol].astype(np.float64)
        v[off] = 0
        out[:, j] = np.add.reduceat(v, first - 2)
    return out
