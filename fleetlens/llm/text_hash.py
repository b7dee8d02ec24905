"""Words, shingles and universal-hash minima of UTF-8 texts, vectorised over Arrow string columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken together; bytes whose words are hashed in one pass, cut between words.
STEP, RUN = 1 << 21, 1 << 17

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_random = np.random.default_rng(20240607)
_BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64)
#: What a white-space character adds to a word's hash is nothing; A-Z add what a-z do.
_ADDS = np.where(_SPACE, np.uint64(0), _BYTE[_LOWER])
_STEP_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(int(_STEP_MUL), -1, 1 << 64))
_PLACE_MUL = _random.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def steps(offsets: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes together; a longer row comes alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space."""
    return np.frombuffer(data.tobytes().translate(_SPACE.tobytes()), bool)


_RUN_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, ...]:
    """The first ``n`` powers of the multiplier and of its inverse; those of a usual run are kept."""

    def first(m: int) -> list[np.ndarray]:
        return [np.multiply.accumulate(np.r_[np.uint64(1), np.full(m - 1, x)]) for x in (_STEP_MUL, _STEP_INVERSE)]

    if not _RUN_POWERS:
        _RUN_POWERS.extend(first(2 * RUN))
    return tuple(x[:n] for x in (_RUN_POWERS if n <= len(_RUN_POWERS[0]) else first(n)))


def _hash_run(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of ``data``; a new word also begins at each of ``cuts``."""
    inside = ~_spaces(data)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    # A byte's weight is a power by its place in the run; dividing by the power of the word's start
    # makes it one by its place in the word. The multiplier is odd, so it has an inverse.
    weights, inverse = _powers(len(data))
    return mix(np.add.reduceat(_ADDS[data] * weights, starts) * inverse[starts]), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z lower-cased), and each text's first word."""
    found, begins, at = [], [], 0
    rows = offsets[:-1][offsets[:-1] < len(data)]
    while at < len(data):
        end = min(at + RUN, len(data))
        # Cut between words: just after the last white space, or else after the next one.
        back = np.flatnonzero(_spaces(data[at:end])) if end < len(data) else ()
        if len(back):
            end = at + int(back[-1]) + 1
        while not len(back) and end < len(data):
            back = np.flatnonzero(_spaces(data[end : end + RUN]))
            end = end + int(back[0]) + 1 if len(back) else min(end + RUN, len(data))
        cuts = rows[np.searchsorted(rows, at) : np.searchsorted(rows, end)] - at
        hashes, starts = _hash_run(data[at:end], cuts)
        found.append(hashes)
        begins.append(starts + at)
        at = end
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    starts = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words within a text, and each text's first one.

    A text with fewer words has its whole sequence as one shingle; a text without words has none.
    """
    lengths = np.diff(firsts)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    begins = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(firsts[:-1] - begins[:-1], counts) + np.arange(begins[-1])
    left = np.repeat(np.minimum(lengths, size), counts)
    total = np.zeros(len(at), np.uint64)
    for j in range(size):
        part = words[np.minimum(at + j, max(len(words) - 1, 0))] * _PLACE_MUL[j] if len(at) else total
        total += np.where(j < left, part, np.uint64(0))
    total += left.astype(np.uint64) * _PLACE_MUL[63]
    return mix(total), begins


class Minima:
    """``n`` universal hash functions a*x+b over 32-bit shingles and their minima over a set."""

    def __init__(self, n: int, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        self.n = n
        self.a = (random.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = random.integers(0, 2**32, n, dtype=np.uint32)[:, None]

    def of(self, shingles: np.ndarray, block: int = 4096) -> np.ndarray:
        """The minima of a set; of the empty set, the largest value throughout."""
        low = np.full(self.n, 0xFFFFFFFF, np.uint32)
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(x), block):
            low = np.minimum(low, (x[None, i : i + block] * self.a + self.b).min(axis=1))
        return low


def band_keys(minima: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of consecutive minima, told apart by the band's number."""
    rows = minima.reshape(bands, -1).astype(np.uint64) + np.uint64(1)
    total = (mix(rows) * _PLACE_MUL[: rows.shape[1]]).sum(axis=1, dtype=np.uint64)
    return mix(total + np.arange(bands, dtype=np.uint64) * _STEP_MUL).view(np.int64)
