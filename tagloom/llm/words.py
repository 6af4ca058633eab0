"""Words of many texts at once: spans and 128-bit hashes of words and of windows of words, in numpy."""

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes that separate words: tab to carriage return, and the space.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[*range(9, 14), 32]] = True
#: Longer words are hashed one by one.
LONG_WORD = 64

_rng = np.random.default_rng(20240229)
_BYTES = _rng.integers(0, 2**64, (2, 256), np.uint64)
_BASES = _rng.integers(0, 2**62, (2, 2), np.uint64) * np.uint64(4) + np.uint64(3)
_powers = {}


def _powered(base, n):
    """base^i and base^-i modulo 2^64 for i < n."""
    key = int(base)
    if key not in _powers or len(_powers[key][0]) < n:
        size = (n + 0xFFFF) >> 16 << 16
        pair = []
        for b in (key, pow(key, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=np.uint64))
        _powers[key] = pair
    up, down = _powers[key]
    return up[:n], down[:n]


def mix(x):
    """Spread the bits of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column):
    """An Arrow string column's bytes and row offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """Words of a column of texts.

    rows: the row of each word; place: its number within the row; first: of each row its first word,
    with the number of all words at the end.
    """

    def __init__(self, column):
        data, offsets = text_bytes(column)
        n = len(data)
        inside = ~IS_SPACE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[cuts < n]
        begins[cuts] = inside[cuts]
        cuts = cuts[cuts > 0]
        ends[cuts - 1] = inside[cuts - 1]
        self._data = data
        self._starts = np.flatnonzero(begins)
        self._ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self._starts, offsets)
        self.rows = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.place = np.arange(len(self._starts)) - self.first[self.rows]

    def __len__(self):
        return len(self._starts)

    def hashes(self, which):
        """64-bit hashes of the words; `which` (0 or 1) chooses one of two independent functions."""
        up, down = _powered(_BASES[which, 0], len(self._data) + 1)
        sums = np.zeros(len(self._data) + 1, np.uint64)
        np.cumsum(_BYTES[which][self._data] * up[:-1], out=sums[1:])
        out = (sums[self._ends] - sums[self._starts]) * down[self._starts]
        for i in np.flatnonzero(self._ends - self._starts > LONG_WORD):
            out[i] = xxhash.xxh3_64_intdigest(self._data[self._starts[i]: self._ends[i]].tobytes(), seed=which)
        return mix(out)

    def windows(self, size, which):
        """Hashes of `size` consecutive words from each word on; those that leave the row mean nothing."""
        own = self.hashes(which)
        if len(own) < size:
            return np.zeros(0, np.uint64)
        up, down = _powered(_BASES[which, 1], len(own) + 1)
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * up[:-1], out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * down[: len(own) - size + 1])

    def whole(self, size):
        """Whether the window of `size` words from each word on stays in its row."""
        if len(self) < size:
            return np.zeros(0, bool)
        return self.rows[size - 1:] == self.rows[: len(self) - size + 1]
