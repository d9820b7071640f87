"""A two-level n-gram trie: Elias-Fano sequences and quantised probabilities in one mapped file."""

from __future__ import annotations

import tempfile

import numpy as np

STEPS = 28  # codes per power of ten; code 0 means absent, 1 is probability one
_POP = np.array([bin(b).count("1") for b in range(256)], np.int64)
#: Place of the k-th set bit, and of the k-th zero bit, of a byte, bits counted from the low end.
_ONE = np.array([([i for i in range(8) if b >> i & 1] + [8] * 8)[:8] for b in range(256)], np.int64)
_ZERO = np.array([([i for i in range(8) if not b >> i & 1] + [8] * 8)[:8] for b in range(256)], np.int64)


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes of probabilities on a logarithmic scale of 8 bits."""
    with np.errstate(divide="ignore"):
        level = np.rint(-STEPS * np.log10(np.minimum(p, 1)))
    return np.where(p > 0, np.clip(level + 1, 1, 255), 0).astype(np.uint8)


def value(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) / STEPS), 0.0)


class Level:
    """A non-decreasing sequence: low bits as they are, high bits in unary.

    Bit ``high + i`` of the bitmap is set for element ``i``; the zeros part the
    elements by high bits, so the elements of one high value lie between two
    zeros, which are found from zero counts per 64 bits.
    """

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n = n
        self.bits = min(32, max(0, (universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        kind = np.uint8 if self.bits <= 8 else np.uint16 if self.bits <= 16 else np.uint32
        self.low = (values & np.uint64((1 << self.bits) - 1)).astype(kind)
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        size = n + (universe >> self.bits) + 2
        bitmap = np.zeros(-(-size // 64) * 64, np.uint8)
        bitmap[high + np.arange(n)] = 1
        self.bitmap = np.packbits(bitmap, bitorder="little")
        self.zeros = np.cumsum(64 - _POP[self.bitmap].reshape(-1, 8).sum(1)).astype(np.int64)

    def parts(self) -> list[np.ndarray]:
        return [self.low, self.bitmap, self.zeros]

    def before(self, high: np.ndarray) -> np.ndarray:
        """How many elements have smaller high bits: the elements before zero number ``high - 1``."""
        nth = np.maximum(high - 1, 0)
        word = np.searchsorted(self.zeros, nth, side="right")
        rest = nth - np.where(word > 0, self.zeros[np.maximum(word - 1, 0)], 0)
        place = word * 64
        byte = word * 8
        for _ in range(8):
            own = 8 - _POP[self.bitmap[byte]]
            on = rest >= own
            rest, byte, place = np.where(on, rest - own, rest), byte + on, place + 8 * on
            byte = np.minimum(byte, len(self.bitmap) - 1)
        place += _ZERO[self.bitmap[byte], np.minimum(rest, 7)]
        return np.where(high > 0, place - nth, 0)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the first element not below ``x``, if it equals ``x``; -1 otherwise."""
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.bits)).astype(np.int64)
        low = (x & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        at, end = self.before(high), self.before(high + 1)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            go = self.low[at[open_]].astype(np.int64) < low[open_]
            at[open_[go]] += 1
            open_ = open_[go]
            open_ = open_[at[open_] < end[open_]]
        inside = at < end
        found = np.full(len(x), -1, np.int64)
        found[inside] = np.where(self.low[at[inside]].astype(np.int64) == low[inside], at[inside], -1)
        return found

    def get(self, i: np.ndarray) -> np.ndarray:
        """Elements by place: the place of one bit in the bitmap, less the ones before it, is the element's high bits."""
        ones = np.arange(1, len(self.zeros) + 1) * 64 - self.zeros
        word = np.searchsorted(ones, i, side="right")
        rest = i - np.where(word > 0, ones[np.maximum(word - 1, 0)], 0)
        place, byte = word * 64, word * 8
        for _ in range(8):
            own = _POP[self.bitmap[byte]]
            on = rest >= own
            rest, byte, place = np.where(on, rest - own, rest), byte + on, place + 8 * on
            byte = np.minimum(byte, len(self.bitmap) - 1)
        place += _ONE[self.bitmap[byte], np.minimum(rest, 7)]
        return ((place - i) << self.bits) + self.low[i].astype(np.int64)


class Trie:
    """Contexts, pointers to their successors, successors relative to their context, and codes.

    Contexts and pointers are monotone sequences. A query finds its context,
    reads from two neighbouring pointers where the successors of this context
    begin and end, and searches between them.
    """

    def __init__(self, contexts: np.ndarray, kinds: np.ndarray, successors: np.ndarray, probability: np.ndarray, backoff: np.ndarray, context_bits: int):
        """Ascending contexts with their number of successors and back-off; successors and probabilities, context after context, ascending in each."""
        self.contexts = Level(contexts, 1 << context_bits)
        self.pointers = Level(np.concatenate([[0], np.cumsum(kinds)]), len(successors) + 1)
        self.successors = successors.astype(np.uint32)
        self.codes, self.backoffs = quantise(probability), quantise(backoff)
        self._map()

    def _map(self) -> None:
        """Move all levels into one file and read them through the page cache; the file has no name and goes with the task."""
        owners = [(level, name) for level in (self.contexts, self.pointers) for name in ("low", "bitmap", "zeros")]
        owners += [(self, "successors"), (self, "codes"), (self, "backoffs")]
        with tempfile.TemporaryFile() as f:
            at = []
            for owner, name in owners:
                data = np.ascontiguousarray(getattr(owner, name))
                f.write(b"\0" * (-f.tell() % 8))
                at.append((f.tell(), data.dtype, data.shape))
                f.write(data.tobytes())
            f.flush()
            for (owner, name), (offset, kind, shape) in zip(owners, at):
                if shape[0]:
                    setattr(owner, name, np.memmap(f, kind, "r", offset, shape))

    def query(self, contexts: np.ndarray, number: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of pairs' probabilities and of their contexts' back-off; 0 where absent.

        ``number`` says how many of the successors belong to each context.
        """
        first, last, back = np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.uint8)
        distinct, place = np.unique(contexts, return_inverse=True)
        if self.contexts.n and len(distinct):
            rank = self.contexts.find(distinct)
            on = rank >= 0
            begin, end, own = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64), np.zeros(len(rank), np.uint8)
            begin[on], end[on], own[on] = self.pointers.get(rank[on]), self.pointers.get(rank[on] + 1), self.backoffs[rank[on]]
            first, last, back = begin[place], end[place], own[place]
        code = np.zeros(len(successors), np.uint8)
        low, stop = np.repeat(first, number), np.repeat(last, number)
        high, open_ = stop.copy(), np.flatnonzero(low < stop)
        while len(open_):
            a, b = low[open_], high[open_]
            mid = (a + b) >> 1
            less = self.successors[mid] < successors[open_]
            low[open_], high[open_] = np.where(less, mid + 1, a), np.where(less, b, mid)
            open_ = open_[low[open_] < high[open_]]
        inside = np.flatnonzero(low < stop)
        hit = inside[self.successors[low[inside]] == successors[inside]]
        code[hit] = self.codes[low[hit]]
        return code, np.repeat(back, number)
