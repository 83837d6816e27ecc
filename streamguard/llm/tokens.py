"""Token ids of many texts with a public tokenizer, each distinct piece of a chunk encoded once.

Both tokenizers split a text into pre-tokens before any merging, and no
pre-token crosses the cuts made here, so the ids of a text are its pieces'
ids in order: ``word`` cuts at white space (for tokenizers that drop it),
``blank`` cuts before a blank with a printable ASCII neighbour (for byte-level
ones, whose pre-tokens may begin with one blank but never span one).
"""

from __future__ import annotations

import os

import numpy as np

from . import common
from .wordhash import Sorted, Texts, U

END_ID = 2
#: Distinct pieces that a worker remembers between chunks (about 20 bytes each), and new ones before they are sorted in.
REMEMBER, RECENT = 3_000_000, 100_000
#: Stands between words that are encoded in one call; words that hold it are encoded alone.
_MARK = "\x01"


def _cuts(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all texts for ``blank``."""
    data, n = texts.data, len(texts.data)
    printable = (data > 0x20) & (data < 0x7F)
    cut = np.zeros(n + 1, bool)
    if n:
        cut[1:-1] = (data[1:] == 0x20) & printable[:-1]
        cut[:-2] |= (data[:-1] == 0x20) & printable[1:]
    cut[texts.bounds] = True
    edges = np.flatnonzero(cut)
    return edges[:-1], edges[1:]


class Encoder:
    """Encodes chunks with a tokenizer file; keeps the ids of pieces it has met."""

    def __init__(self, path: str, cuts: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the tokenizer takes as one token wherever they stand: texts that hold one are encoded whole.
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = cuts
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if cuts == "word" and len(mark) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.keys, self.sizes, self.flat = np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.index, self.begin = Sorted(self.keys), np.zeros(0, np.int64)
        self.recent: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _settle(self) -> None:
        """Sort recent pieces in among the known ones."""
        parts = [(self.keys, self.sizes, self.flat), *self.recent]
        keys, sizes, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        if len(keys) > REMEMBER:
            return self._forget()
        order = np.argsort(keys, kind="stable")
        begin = np.cumsum(sizes, dtype=np.int64) - sizes
        blocks = [order[i:i + RECENT] for i in range(0, len(order), RECENT)]
        self.flat = np.concatenate([flat[_spans(begin[o], sizes[o])] for o in blocks])
        self.keys, self.sizes = keys[order], sizes[order]
        self.index, self.begin, self.recent = Sorted(self.keys), np.cumsum(self.sizes, dtype=np.int64) - self.sizes, []

    def _fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of pieces that are not known."""
        if self.mark is None:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            return np.array([len(x) for x in got], np.int32), np.array([i for x in got for i in x], np.uint32)
        odd = [i for i, p in enumerate(pieces) if _MARK in p]
        text = f" {_MARK} ".join(p if _MARK not in p else "" for p in pieces)
        ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        edge = np.flatnonzero(ids == self.mark)
        sizes = (np.diff(np.concatenate([[-1], edge, [len(ids)]])) - 1).astype(np.int32)
        ids = ids[ids != self.mark]
        for i in odd:
            alone = np.array(self.tokenizer.encode(pieces[i], add_special_tokens=False).ids, np.uint32)
            at = int(sizes[:i].sum())
            ids, sizes[i] = np.concatenate([ids[:at], alone, ids[at:]]), len(alone)
        return sizes, ids

    def _with_added(self, texts: Texts) -> list[int]:
        """The texts that hold an added token's string, in any case of letters."""
        body, found = texts.data.tobytes().lower(), set()
        for name in self.added:
            at = body.find(name)
            while at >= 0:
                i = int(np.searchsorted(texts.bounds, at, side="right")) - 1
                found.add(i)
                at = body.find(name, int(texts.bounds[i + 1]))  # on with the next text
        return sorted(found)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): all texts' ids one after another (uint32), without an end id, as the tokenizer gives them."""
        ids, bounds = self._by_piece(texts)
        whole = self._with_added(texts)
        if not whole:
            return ids, bounds
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in whole:
            text = texts.data[texts.bounds[i]:texts.bounds[i + 1]].tobytes().decode("utf-8", "replace")
            parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)

    def _by_piece(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` for texts without added tokens."""
        start, end = (texts.start, texts.end) if self.cuts == "word" else _cuts(texts)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts.counts) + 1, np.int64)
        h = texts.byte_hashes(start, end)
        order = np.argsort(h)
        new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
        which = np.empty(len(h), np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        keys = h[first]
        if sum(len(r[0]) for r in self.recent) > RECENT:
            self._settle()
        sizes, begin, flats, base = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), [self.flat], len(self.flat)
        at, found = self.index.find(keys)
        sizes[found], begin[found] = self.sizes[at[found]], self.begin[at[found]]
        todo = np.flatnonzero(~found)
        for k, s, f in self.recent:
            at = np.minimum(np.searchsorted(k, keys[todo]), len(k) - 1)
            hit = k[at] == keys[todo]
            sizes[todo[hit]], begin[todo[hit]] = s[at[hit]], base + (np.cumsum(s, dtype=np.int64) - s)[at[hit]]
            flats.append(f)
            base += len(f)
            todo = todo[~hit]
        if len(todo):
            body = texts.data.tobytes()
            parts = []
            for lo in range(0, len(todo), 1024):
                pick = first[todo[lo:lo + 1024]]
                parts.append(self._fresh([body[a:b].decode() for a, b in zip(start[pick].tolist(), end[pick].tolist(), strict=True)]))
            s, f = (np.concatenate(x) for x in zip(*parts, strict=True))
            sizes[todo], begin[todo] = s, base + np.cumsum(s, dtype=np.int64) - s
            flats.append(f)
            self.recent.append((keys[todo], s, f))  # keys are sorted within a chunk
        flat = np.concatenate(flats) if len(flats) > 1 else flats[0]
        n = sizes[which]
        ids = flat[_spans(begin[which], n)]
        edges = np.concatenate([[0], np.cumsum(n)])
        return ids, edges[np.searchsorted(start, texts.bounds)]


def _spans(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for n[0] places, then those of begin[1], and so on."""
    n = n.astype(np.int64)
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


#: Name under which a worker keeps its encoder between tasks.
KEPT = "encoder"


def encoder(path: str, cuts: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return common.kept(KEPT, (path, cuts), lambda: Encoder(path, cuts))


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The end id after every text's ids."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    grown = bounds + np.arange(n + 1)
    take = np.ones(len(out), bool)
    take[grown[1:] - 1] = False
    out[take] = ids
    return out, grown
