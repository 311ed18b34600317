"""Words and shingles of an Arrow column of texts as 64-bit hashes, computed over whole buffers.

The functions run inside tasks, on one Arrow batch at a time; memory follows the batch.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes hashed at a time
SHINGLE = 5

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

# Space and the characters 9 to 13 end a word; A-Z have lower-case forms.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
KEEP = np.arange(256, dtype=np.uint8)
LOWER = KEEP.copy()
LOWER[0x41:0x5B] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the offset of each (one more than texts)."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    marks = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[marks[0] : marks[-1]], marks - marks[0]


class Words:
    """Words of a batch: ``hashes``, byte ``starts`` and ``ends``, and ``first`` word of each text.

    ``prefixes`` holds, for each asked length in bytes, the hashes of the words' beginnings
    (0 for words that are no longer). ``space`` tells which bytes end a word.
    """

    def __init__(
        self, texts: pa.Array, fold: np.ndarray = KEEP, space: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()
    ):
        self.data, self.offsets = buffers(texts)
        self.space = space
        n, hashes, starts, ends = len(self.data), [], [], []
        cut: dict[int, list[np.ndarray]] = {k: [] for k in prefixes}
        up = down = np.zeros(0, np.uint64)
        at = 0
        while at < n:
            stop = min(at + PIECE, n)
            if stop < n:  # cut after a space or between two texts
                blank = np.flatnonzero(space[self.data[at:stop]])
                if len(blank):
                    stop = at + int(blank[-1]) + 1
                else:
                    stop = int(self.offsets[np.searchsorted(self.offsets, stop)])
            if len(up) < stop - at:
                up, down = _powers(_BASE, stop - at), _powers(_INVERSE, stop - at)
            s, e = self._bounds(at, stop)
            if len(s):
                # Words of a piece are sums of byte values times powers, shifted to the word's start.
                values = fold[self.data[at:stop]].astype(np.uint64) + np.uint64(1)
                values[space[self.data[at:stop]]] = 0
                values *= up[: stop - at]
                back = down[s - at]
                sums = np.add.reduceat(values, s - at) * back
                hashes.append(mix(sums + (e - s).astype(np.uint64)))
                run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values))) if prefixes else None
                for k in prefixes:
                    longer = e - s > k
                    part = (run[np.where(longer, s - at + k, 0)] - run[s - at]) * back
                    cut[k].append(np.where(longer, mix(part + np.uint64((k << 32) + 1)), np.uint64(0)))
                starts.append(s)
                ends.append(e)
            at = stop
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.hashes = join(hashes, np.uint64)
        self.starts, self.ends = join(starts, np.int64), join(ends, np.int64)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.prefixes = {k: join(parts, np.uint64) for k, parts in cut.items()}

    def _bounds(self, at: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        inside = ~self.space[self.data[at:stop]]
        edge = np.zeros(stop - at + 1, bool)
        cuts = self.offsets[np.searchsorted(self.offsets, at) : np.searchsorted(self.offsets, stop, "right")]
        edge[cuts - at] = True
        before = np.concatenate(([False], inside[:-1]))
        after = np.concatenate((inside[1:], [False]))
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts + at, ends + at

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; with fewer words, of the whole sequence."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(out)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in smaller batches of about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        texts = batch.column(column)
        _, marks = buffers(texts)
        at = 0
        while at < len(texts):
            stop = max(int(np.searchsorted(marks, marks[at] + limit, "right")) - 1, at + 1)
            stop = min(stop, len(texts))
            yield batch.slice(at, stop - at)
            at = stop
