"""Periodic runs of words: longest common extensions on a difference cover, found from harmonic grids.

A run is a stretch of consecutive words with smallest period q and a length of at least ``max(least, times*q)``
that cannot be extended with that period. The words of a text become numbers. For each period p the grid of its
multiples is laid over the text: a run of three or more periods holds two neighbouring points i and i+p of the grid
of its period, and the longest common extensions of the two, forwards and backwards, give its ends. All grids of a
text of n words have some n*ln(n) points.

An extension is found by a *difference cover* of ``SIDE**2``: a set of residues in which every difference occurs, so
any two places reach, within less than SIDE**2 words, two places of the cover that lie as far apart. Only the
suffixes at places of the cover are sorted (blocks of words first, then doubling). Their common prefixes with the
next in order are kept in a sparse table of minima. A query compares the few words up to the synchronised places and
then asks the table. The index is made once a query of a text gets that far, for the text and for the text
reversed.

Defined results: a null text, and one without words, has no run and nothing is left; words are taken as they are,
not lower-cased; equal rows get equal results, one row each; other columns are not read. The work on one text
takes memory in proportion to it; grids of long texts are gone through in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import kept, ship

#: The least length of a run in words, and in periods.
LEAST, TIMES = 24, 3
#: The side of the difference cover: 2*SIDE-1 of SIDE**2 suffixes are sorted.
SIDE = 5
#: Grid points that are looked at together; texts up to so many words share one table of grids.
BLOCK, TABLE_WORDS = 1 << 20, 1 << 14


def difference_cover(side: int) -> tuple[np.ndarray, np.ndarray]:
    """(the cover's residues, for each difference d the residue a of the cover with a+d in it too), modulo side**2.

    The numbers below ``side`` and the multiples of ``side``: any d is a multiple less a number below ``side``.
    """
    v = side * side
    cover = np.unique(np.r_[np.arange(side), np.arange(side) * side])
    held = np.zeros(v, bool)
    held[cover] = True
    start = np.array([next(int(a) for a in cover if held[(a + d) % v]) for d in range(v)])
    return cover, start


class Extensions:
    """Longest common extensions of places of one sequence of numbers."""

    def __init__(self, words: np.ndarray, side: int = SIDE) -> None:
        self.words = words
        self.n = len(words)
        self.v = side * side
        self.cover, self.start = difference_cover(side)
        self._table: list[np.ndarray] | None = None

    def _first_differing(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words agree from i and j on (i < j), up to ``limit`` and the text's end."""
        limit = np.minimum(limit, self.n - j)
        agree = np.zeros(len(i), np.int64)
        active = np.flatnonzero(limit > 0)
        while len(active):
            t = agree[active]
            active = active[self.words[i[active] + t] == self.words[j[active] + t]]
            agree[active] += 1
            active = active[agree[active] < limit[active]]
        return agree

    def _index(self) -> None:
        """Sort the suffixes at places of the cover; common prefixes of neighbours in a sparse table."""
        n, v, words = self.n, self.v, self.words
        inside = np.zeros(v, bool)
        inside[self.cover] = True
        places = np.flatnonzero(inside[np.arange(n) % v])
        m = len(places)
        # The first v words of each suffix, packed several to a key; 0 stands for the text's end.
        bits = max(int(words.max()) + 1, 1).bit_length() if n else 1
        per = max(1, 63 // bits)
        padded = np.r_[words.astype(np.int64) + 1, np.zeros(v + per, np.int64)]
        packed = np.zeros(n + v, np.int64)
        for t in range(per):
            packed = (packed << bits) | padded[t : t + n + v]
        keys = [packed[places + t] >> (bits * max(0, t + per - v)) for t in range(0, v, per)]
        order = np.lexsort(keys[::-1])
        changes = np.zeros(m, bool)
        for key in keys:
            changes[1:] |= key[order[1:]] != key[order[:-1]]
        # Ranks by place, one row a level: after 0 and then twice as many blocks. 0 is beyond the end.
        rank = np.zeros(n + 1, np.int64)
        rank[places[order]] = np.cumsum(changes) + 1
        levels, width = [rank], v
        while m and rank[places[order[-1]]] < m and width < n:
            key = rank[places] * (m + 1) + rank[np.minimum(places + width, n)]
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            changes = np.r_[False, sorted_key[1:] != sorted_key[:-1]]
            rank = np.zeros(n + 1, np.int64)
            rank[places[order]] = np.cumsum(changes) + 1
            levels.append(rank)
            width *= 2
        # Common prefixes of neighbours: whole blocks by the ranks of the levels, the rest word by word.
        lcp = np.zeros(m, np.int64)
        if m > 1:
            a, b = places[order[:-1]], places[order[1:]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            off = np.zeros(m - 1, np.int64)
            for level in range(len(levels) - 1, -1, -1):
                # Equal blocks end inside the text, as the end has a number of its own.
                x, y = levels[level][low + off], levels[level][np.minimum(high + off, n)]
                off += (v << level) * (x == y)
            lcp[1:] = off + self._first_differing(low + off, high + off, np.full(m - 1, v))
        self._at = np.zeros(n + 1, np.int64)
        self._at[places[order]] = np.arange(m)
        table, span = [lcp.astype(np.int32)], 1
        while 2 * span <= m:
            last = table[-1]
            table.append(np.minimum(last[:-span], last[span:]))
            span *= 2
        self._table = table

    def _by_order(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common extension of places of the cover: the least common prefix between them in order."""
        if self._table is None:
            self._index()
        x, y = self._at[i], self._at[j]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.zeros(len(i), np.int64)
        for k in np.unique(level):
            own, row = np.flatnonzero(level == k), self._table[k]
            found[own] = np.minimum(row[low[own]], row[high[own] - (1 << int(k))])
        return found

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from i and from j on, for i < j <= n."""
        i, j = np.asarray(i, np.int64), np.asarray(j, np.int64)
        to_cover = (self.start[(j - i) % self.v] - i) % self.v
        agree = self._first_differing(i, j, to_cover)
        on = np.flatnonzero((agree == to_cover) & (j + to_cover < self.n))
        if len(on):
            at, to = i[on] + to_cover[on], j[on] + to_cover[on]
            same = self.words[at] == self.words[to]
            on, at, to = on[same], at[same], to[same]
            if len(on):
                agree[on] += self._by_order(at, to)
        return agree


def _grid_table(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and periods of all grids up to n, ordered by place, and where each place begins.

    The points j of grids are the multiples of their periods: the grid points of texts of any length are a prefix.
    """
    period = np.repeat(np.arange(1, n), [(n - 1) // p for p in range(1, n)])
    begins = np.flatnonzero(np.r_[True, period[1:] != period[:-1]])
    place = (np.arange(len(period)) - np.repeat(begins, np.diff(np.r_[begins, len(period)])) + 1) * period
    order = np.argsort(place, kind="stable")
    return place[order].astype(np.int32), period[order].astype(np.int32), np.searchsorted(place[order], np.arange(n + 1))


def _grids(n: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places j, periods p) of the neighbouring grid points j-p and j of a text of n words, in blocks."""
    most = n // times
    if n <= TABLE_WORDS:
        place, period, upto = kept(("grids", TABLE_WORDS), lambda: _grid_table(TABLE_WORDS))
        place, period = place[: upto[n]], period[: upto[n]]
        held = period <= most
        yield place[held].astype(np.int64), period[held].astype(np.int64)
        return
    first = 1
    while first <= most:
        # So many periods that their grids have about BLOCK points; a period alone may have more.
        periods = np.arange(first, min(most, first + BLOCK) + 1)
        points = (n - 1) // periods
        last = max(1, int(np.searchsorted(np.cumsum(points), BLOCK, side="right")))
        periods, points = periods[:last], points[:last]
        ends = np.cumsum(points)
        period = np.repeat(periods, points)
        yield (np.arange(ends[-1]) - np.repeat(ends - points, points) + 1) * period, period
        first += last


def runs(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, smallest period) of each run of a sequence of numbers, by start, then period."""
    n = len(words)
    found = []
    if n >= least:
        ahead, back = Extensions(words), Extensions(words[::-1].copy())
        for j, p in _grids(n, times):
            same = words[j] == words[j - p]
            j, p = j[same], p[same]
            if not len(j):
                continue
            forward = ahead.of(j - p, j)
            # Of the points of one run the first one is enough: where the point before, one period back, agrees
            # with this one throughout, both are of the same run. So a run begins less than p before its first.
            order = np.lexsort((j, p))
            j, p, forward = j[order], p[order], forward[order]
            follows = np.r_[False, (p[1:] == p[:-1]) & (j[1:] - j[:-1] == p[1:]) & (forward[:-1] >= p[:-1])]
            enough = ~follows & (forward + 2 * p - 1 >= np.maximum(least, times * p))
            j, p, forward = j[enough], p[enough], forward[enough]
            if not len(j):
                continue
            behind = back.of(n - j, n - j + p)
            start, end = j - p - behind, j + forward
            long = end - start >= np.maximum(least, times * p)
            found.append(np.stack([start[long], end[long], p[long]], axis=1))
    if not found or not sum(map(len, found)):
        return np.zeros((0, 3), np.int64)
    every = np.concatenate(found)
    # One stretch may show several multiples of its period: the least of them is the smallest period.
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.r_[True, (every[1:, :2] != every[:-1, :2]).any(axis=1)]
    every = every[new]
    every = np.stack([every[:, 0], every[:, 1] - every[:, 0], every[:, 2]], axis=1)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def uncovered(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words stay: those in no run after the run's first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def strongest(found: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest exact length/period; ties go to the smallest start, then period."""
    best = None
    for start, length, period in found.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def repeated_tail(number: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the repetition that a tenth of the documents get, by a checksum of their number."""
    if number is None or n == 0 or number % 10:
        return None
    g = number // 10
    first = g % n
    return first, 1 + (n - first) // (3 + g % 8)


def periodic_runs(docs: DataFrame, tail: Column | None = None) -> DataFrame:
    """One row per document: doc_id, n_runs, its strongest run, digests of the runs and of the words that are left.

    ``tail`` is a whole number by which some texts are first made periodic from some word on (``repeated_tail``);
    without it, and where it is null, texts are taken as they are. ``runs`` lists every run, ``collapsed`` is the
    text that is left.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
    kinds = ["long"] * 6 + ["array<struct<start: long, length: long, period: long>>", "string"]
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds, strict=True))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches):
        for batch in batches:
            rows = []
            for text, number in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                ids = numbered(words)
                if (shape := repeated_tail(number, len(words))) is not None:
                    first, period = shape
                    places = np.arange(len(words))
                    places[first:] = first + (places[first:] - first) % period
                    ids, words = ids[places], [words[i] for i in places.tolist()]
                found = runs(ids)
                best = strongest(found)
                stays = words
                if len(found):
                    stays = [words[i] for i in np.flatnonzero(uncovered(len(words), found)).tolist()]
                milli = None if best is None else 1000 * best[1] // best[2]
                rows.append((len(found), *(best or (None,) * 3), milli, found.tolist(), b" ".join(stays).decode()))
            n, start, length, period, milli, every, text = zip(*rows, strict=True) if rows else ((),) * 7
            lists = [[{"start": s, "length": m, "period": p} for s, m, p in one] for one in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, start, length, period, milli))]
                + [pa.array(lists, pa.list_(run)), pa.array(text, pa.string())],
                names=names,
            )

    number = F.lit(None).cast("long") if tail is None else tail.cast("long")
    return docs.select(F.col("doc_id").cast("long"), "text", number.alias("number")).mapInArrow(find, schema)


def digests(found: DataFrame) -> DataFrame:
    """The digest columns of ``periodic_runs``: every run as ``start,length,period`` and a line feed; the text left."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
