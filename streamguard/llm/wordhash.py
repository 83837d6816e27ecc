"""Words, lines and windows of many texts at once, as numpy arrays over their UTF-8 bytes.

Hashes are polynomial (Rabin-Karp) in 64 bits over a table of random byte
values: a range's hash comes from two prefix sums, so every word, line and
word window of a chunk costs a few vector operations.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)  # odd
_BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes whose prefix sums are held at once (8 bytes each, with their values and powers).
BLOCK_BYTES = 1 << 18
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over all 64 bits."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, U)
        steps[0] = 1
        have = np.cumprod(steps, dtype=U)
        if n <= 16 << 20:
            _powers[int(base)] = have
    return have[:n]


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each range, by prefix sums of values times powers."""
    prefix = np.zeros(len(values) + 1, U)
    np.cumsum(values * _power(_BASE, len(values)), dtype=U, out=prefix[1:])
    h = (prefix[end] - prefix[start]) * _power(_BASE_INV, len(values) + 1)[start]
    return mix(h + (end - start).astype(U) * U(0xA0761D6478BD642F))


class Texts:
    """The words of a chunk of texts (null counts as empty); all offsets are in the chunk's bytes."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.fill_null("")
        if len(texts) == 0:
            self.data, self.bounds = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        else:
            wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
            bounds = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
            raw = texts.buffers()[2]
            data = np.frombuffer(raw, np.uint8)[bounds[0]:bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
            self.data, self.bounds = data, bounds - bounds[0]
        if lower:
            self.data = np.where((self.data >= 65) & (self.data <= 90), self.data + np.uint8(32), self.data)
        self._words()

    def _words(self) -> None:
        n = len(self.data)
        self.separator = _SEPARATOR[self.data]
        before = np.empty(n + 1, bool)
        before[0] = True
        before[1:] = self.separator
        before[self.bounds] = True
        inside = ~self.separator
        self.start = np.flatnonzero(inside & before[:-1])
        after = np.empty(n + 1, bool)
        after[-1] = True
        after[:-1] = self.separator
        after[self.bounds] = True
        self.end = np.flatnonzero(inside & after[1:]) + 1
        #: first word of each text, and one more for the end
        self.first = np.searchsorted(self.start, self.bounds)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)

    def byte_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each range; ranges in ascending order are taken block by block (a range's hash does not depend on its place)."""
        if not len(start) or (start[1:] < start[:-1]).any():
            return range_hashes(_byte_values()[self.data], start, end)
        out, i = np.empty(len(start), U), 0
        while i < len(start):
            lo = start[i]
            j = int(np.searchsorted(start, lo + BLOCK_BYTES))
            out[i:j] = range_hashes(_byte_values()[self.data[lo:end[i:j].max()]], start[i:j] - lo, end[i:j] - lo)
            i = j
        return out

    def word_hashes(self) -> np.ndarray:
        return self.byte_hashes(self.start, self.end)

    def windows(self, width: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``width`` consecutive words of one text."""
        hashes = self.word_hashes() if hashes is None else hashes
        at = np.arange(max(0, len(hashes) - width + 1))
        at = at[self.text[at] == self.text[at + width - 1]] if len(at) else at
        return at, range_hashes(hashes, at, at + width)

    def per_text(self, flags: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        """Sums of ``flags`` (over bytes, or over what ``bounds`` delimits) by text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.bounds if bounds is None else bounds])

    def decoded(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8", "replace")


class Sorted:
    """Sorted hashes with an index on their leading bits: a lookup is one jump and a few steps."""

    def __init__(self, keys: np.ndarray, ended: bool = False):
        """``ended``: the keys already close with the largest hash as a stop."""
        self.keys = keys if ended else np.append(keys, U(0xFFFFFFFFFFFFFFFF))
        self.bits = max(1, min(22, int(len(keys)).bit_length()))
        self.jump = np.empty(1 << self.bits, np.int32 if len(keys) < 1 << 31 else np.int64)
        for lo in range(0, 1 << self.bits, 1 << 16):  # in blocks: the index itself is all that is held
            edge = np.arange(lo, min(lo + (1 << 16), 1 << self.bits), dtype=U) << U(64 - self.bits)
            self.jump[lo:lo + len(edge)] = np.searchsorted(self.keys, edge)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.jump[(h >> U(64 - self.bits)).astype(np.int64)].astype(np.int64)
        live = np.flatnonzero(self.keys[at] < h)
        while len(live):
            at[live] += 1
            live = live[self.keys[at[live]] < h[live]]
        return at, self.keys[at] == h


def joined(texts: Texts, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of every text joined by one blank each: bytes, and the bounds of the texts in them."""
    n = len(texts.data)
    steps = np.zeros(n + 1, np.int8)
    steps[texts.start[keep]] += 1
    np.add.at(steps, texts.end[keep], -1)  # a word may start where another text's word ends
    take = np.cumsum(steps[:-1], dtype=np.int8) > 0
    kept = np.flatnonzero(keep)
    gap = texts.end[kept[:-1]][texts.text[kept[:-1]] == texts.text[kept[1:]]]  # a separator follows: the text goes on
    data = texts.data.copy()
    data[gap] = 32
    take[gap] = True
    at = np.zeros(n + 1, np.int64)
    np.cumsum(take, out=at[1:])
    return data[take].tobytes(), at[texts.bounds]


def covered(n: int, at: np.ndarray, width: int) -> np.ndarray:
    """Which of n words lie in a window of ``width`` words that starts at one of ``at``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + width, n), -1)
    return np.cumsum(steps[:-1]) > 0


def repeated(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items (group, key): whether another item of the group has the key; whether an earlier one has it."""
    k = mix(key ^ mix(group.astype(U) + U(1)))
    order = np.argsort(k, kind="stable")
    same = k[order][1:] == k[order][:-1]
    any_other, earlier = np.zeros(len(k), bool), np.zeros(len(k), bool)
    any_other[order[1:][same]] = True
    any_other[order[:-1][same]] = True
    earlier[order[1:][same]] = True
    return any_other, earlier
