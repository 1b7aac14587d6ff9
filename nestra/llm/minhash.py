"""MinHash banding over positions.

A record's shingles are, on each axis, the fine cells at most ``HALF`` away from its own, so near records share most of them. A band has one MinHash per axis: the least hash among the shingles of that axis. Records whose
bands are equal are candidates; each is held against the next ones in its bucket (in the order of position), never all against all. The exact Jaccard of the sets verifies a candidate, and its exact distance decides.
What banding misses by chance or by that order, the caller completes exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FINE = 8  # fine cells along the distance at which records may still be linked
HALF = 8  # shingles on either side of a record's own cell
WIDTH = 2 * HALF + 1
BANDS = 16
AHEAD = (1, 2)  # places in a bucket at which a record looks for partners

_U = np.uint64


def _scramble(v: np.ndarray, *seed: int) -> np.ndarray:
    v = np.asarray(v).astype(np.int64).view(_U)
    for s in (*seed, 7):
        v = (v + _U((s + 1) * 0x9E3779B97F4A7C15 % 2**64)) * _U(0xD6E8FEB86659FD93)
        v = v ^ (v >> _U(32))
    return v


class Shingles:
    """The distinct shingle sets of records; ``of`` has the set of each record, ``first`` a record of each set. Sets are in the order of event and position."""

    def __init__(self, event: np.ndarray, p: np.ndarray, reach: float, turn: float | None = None):
        self.fine, self.cells, self.turn = reach / FINE, [], 0
        if turn:  # one axis that closes on itself
            self.turn = max(1, int(turn / self.fine))
            columns = [np.minimum(np.floor(np.mod(p[:, 0], turn) * (self.turn / turn)), self.turn - 1)]
        else:
            columns = [np.floor(p[:, k] / self.fine) for k in range(p.shape[1])]
        key = np.unique(event, return_inverse=True)[1].astype(np.int64)
        event = key
        for c in columns:
            if not turn:  # gaps that no two sets bridge close up
                u, at = np.unique(c, return_inverse=True)
                c = np.r_[0.0, np.cumsum(np.minimum(np.diff(u), WIDTH))][: max(1, len(u))][at]
            c = c.astype(np.int64)
            span = int(c.max()) + 1 if len(c) else 1
            if len(key) and int(key.max()) >= 2**62 // span:
                key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            key = key * span + c
            self.cells.append(c)
        self.first, self.of = np.unique(key, return_index=True, return_inverse=True)[1:]
        self.event, self.cells = event[self.first], [c[self.first] for c in self.cells]

    def __len__(self) -> int:
        return len(self.first)

    @property
    def least(self) -> float:
        """No two records within the reach have a smaller Jaccard."""
        d = len(self.cells)
        apart = int(FINE * d**0.5) + d
        return (d * WIDTH - apart) / (d * WIDTH + apart)

    def gaps(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        out = [np.abs(c[a] - c[b]) for c in self.cells]
        return [np.minimum(g, self.turn - g) for g in out] if self.turn else out

    def jaccard(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact: on each axis two sets share as many cells as their windows overlap."""
        both = sum(np.maximum(0, WIDTH - g) for g in self.gaps(a, b))
        return both / (2 * len(self.cells) * WIDTH - both)

    def bands(self) -> Iterator[np.ndarray]:
        """The bucket of every set, band by band."""
        for band in range(BANDS):
            bucket = _scramble(self.event, band)
            for axis, c in enumerate(self.cells):
                if self.turn:
                    h = _scramble(np.arange(-HALF, self.turn + HALF) % self.turn, band, axis)
                else:
                    h = _scramble(np.arange(-HALF, (int(c.max()) if len(c) else 0) + HALF + 1), band, axis)
                low = np.lib.stride_tricks.sliding_window_view(h, WIDTH).min(1)
                bucket = bucket + _scramble(low.view(np.int64), axis)[c]
            yield bucket

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for bucket in self.bands():
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            for step in AHEAD:
                at = np.flatnonzero(bucket[step:] == bucket[:-step])
                yield order[at], order[at + step]

    def share_a_bucket(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of sets is a candidate in some band."""
        out = np.zeros(len(a), bool)
        for bucket in self.bands():
            out |= bucket[a] == bucket[b]
        return out

    def neighbours(self, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of sets (each once) of an event whose own cells are at most ``apart`` steps from each other over all axes, exactly; only without a turn and with three axes."""
        x, y, z = self.cells
        if not len(x):
            return
        wy, wz = int(y.max()) + 2 * apart + 2, int(z.max()) + 2 * apart + 2
        rows, row = np.unique((self.event * (int(x.max()) + 2 * apart + 2) + x) * wy + y, return_inverse=True)
        key = row.astype(np.int64) * wz + z
        line = (self.event * (int(x.max()) + 2 * apart + 2) + x) * wy + y
        for dx in range(apart + 1):
            for dy in range(-(apart - dx), apart - dx + 1):
                if dx == 0 and dy < 0:
                    continue
                rest = apart - dx - abs(dy)
                want = line + dx * wy + dy
                at = np.searchsorted(rows, want)
                at[at == len(rows)] = 0
                a = np.flatnonzero(rows[at] == want)
                base = at[a] * wz + z[a]
                lo = np.searchsorted(key, base - np.minimum(rest, z[a])) if (dx or dy) else a + 1
                hi = np.searchsorted(key, base + rest, "right")
                n = np.maximum(hi - lo, 0)
                owner = np.repeat(np.arange(len(a)), n)
                yield a[owner], np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + lo[owner]

    def around(self, some: np.ndarray, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of each of ``some`` sets and every other set whose own cell is at most ``steps`` away on each of three axes, exactly."""
        x, y, z = self.cells
        if not len(x) or not len(some):
            return
        wy, wz = int(y.max()) + 2 * steps + 2, int(z.max()) + 2 * steps + 2
        line = (self.event * (int(x.max()) + 2 * steps + 2) + x) * wy + y
        rows, row = np.unique(line, return_inverse=True)
        key = row.astype(np.int64) * wz + z
        for dx in range(-steps, steps + 1):
            for dy in range(-steps, steps + 1):
                want = line[some] + dx * wy + dy
                at = np.searchsorted(rows, want)
                at[at == len(rows)] = 0
                k = np.flatnonzero(rows[at] == want)
                a, base = some[k], at[k] * wz + z[some[k]]
                lo, hi = np.searchsorted(key, base - np.minimum(steps, z[a])), np.searchsorted(key, base + steps, "right")
                n = hi - lo
                owner = np.repeat(np.arange(len(a)), n)
                b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + lo[owner]
                yield a[owner][a[owner] != b], b[a[owner] != b]
