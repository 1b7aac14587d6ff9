"""Mean-shift per event, in space or in (eta, phi), on NumPy inside grouped Arrow functions.

All seeds of an event climb at once. Neighbours are looked up through a grid of cells as wide as the radius, so a step compares a seed with the points of the cells around it, in blocks of bounded size.

Many small events share a task. The rows of an event with more points than ``MOST_POINTS`` do not meet in one task: its points are divided into chunks whose labels are found chunk by chunk. Its centres come from the bare coordinates
of its points in one task; with more than ``MOST_GATHERED`` points not even those meet, and each step sums up what every chunk has around the seeds that still climb (a table of at most one row per bin). Only centres, at most one per
bin, are gathered then. Sums are added in another order, so positions agree to rounding.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from nestra.runtime import Workspace

PAIRS = 1 << 18
# Steps at most, the shift (as a part of the bandwidth) at which a climb ends, and the share of points that counts as neighbours when a bandwidth is estimated.
MAX_ITER = 300
STOP = 1e-3
QUANTILE = 0.3
TURN = 2 * math.pi
MOST_POINTS = 1 << 18  # of an event, or of a chunk of one, in a task
MOST_GATHERED = 1 << 22  # of an event whose bare coordinates meet in a task
BUCKET_POINTS = 1 << 16  # of small events that share a task, about


def wrap(a: np.ndarray) -> np.ndarray:
    x = np.asarray(math.pi - a)
    out = (x < 0) | (x >= TURN)  # of the others the remainder is the number itself
    if out.any():
        x = np.where(out, np.mod(x, TURN, where=out, out=np.zeros_like(x)), x)
    return math.pi - x


def _delta(a: np.ndarray, b: np.ndarray, angular: bool) -> np.ndarray:
    """Distances of rows; the second coordinate is an angle if ``angular``."""
    d = a - b
    if angular:
        d = np.stack([d[..., 0], wrap(d[..., 1])], -1)
    return np.sqrt((d * d).sum(-1))


def _unique_rows(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique over rows of whole numbers (rows in order, inverse, counts), by one number a row where that has room."""
    low = a.min(0)
    span = a.max(0) - low + 1
    if not np.isfinite(span).all() or np.prod(span.astype(float)) >= 2.0**62 or np.abs(a).max() >= 2.0**52:
        rows, inverse, n = np.unique(a, axis=0, return_inverse=True, return_counts=True)
        return rows, inverse.ravel(), n
    code = np.zeros(len(a), np.int64)
    for k in range(a.shape[1]):
        code *= int(span[k])
        code += (a[:, k] - low[k]).astype(np.int64)
    if (room := int(np.prod(span.astype(float)))) <= 4 * len(a) + 1024:  # counted in place, without sorting
        n = np.bincount(code, minlength=room)
        there = np.flatnonzero(n)
        place = np.zeros(room, np.int64)
        place[there] = np.arange(len(there))
        rows, left = np.empty((len(there), a.shape[1]), a.dtype), there
        for k in reversed(range(a.shape[1])):
            left, rows[:, k] = np.divmod(left, int(span[k]))
        return rows + low, place[code], n[there]
    _, first, inverse, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    return a[first], inverse.ravel(), n


class _Grid:
    """Points in cells of the radius; an angle's cells close on themselves."""

    def __init__(self, p: np.ndarray, radius: float, angular: bool):
        self.p, self.radius, self.angular = p, radius, angular
        self.columns = np.ascontiguousarray(p.T)
        self.low = p.min(0)
        self.n_phi = max(1, int(TURN // radius)) if angular else 0
        cells = self._cell(p)
        self.keys, inverse, self.size = _unique_rows(cells)
        self.order = np.argsort(inverse, kind="stable")
        self.start = np.cumsum(self.size) - self.size
        self.span = self.keys.max(0) + 4
        self.code = self._code(self.keys)
        by = np.argsort(self.code)
        self.code, self.at = self.code[by], by
        dims = p.shape[1]
        self.steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * dims, indexing="ij"), -1).reshape(-1, dims)

    def _cell(self, q: np.ndarray) -> np.ndarray:
        c = np.floor((q - self.low) / self.radius).astype(np.int64)
        if self.angular:
            width = TURN / self.n_phi
            c[:, 1] = np.minimum(np.floor((wrap(q[:, 1]) + math.pi) / width), self.n_phi - 1)
        return c

    def _code(self, c: np.ndarray) -> np.ndarray:
        code = c[:, 0] + 2
        for k in range(1, c.shape[1]):
            code = code * self.span[k] + c[:, k] + 2
        return code

    def near(self, q: np.ndarray):
        """Blocks of (seed, point) pairs within the radius."""
        base = self._cell(q)
        for i in range(0, len(q), 4096):
            b = base[i : i + 4096]
            cells = b[:, None] + self.steps[None]
            if self.angular:
                cells[..., 1] %= self.n_phi
            owner = np.repeat(np.arange(i, i + len(b)), len(self.steps))
            flat = cells.reshape(-1, b.shape[1])
            inside = ((flat >= -2) & (flat < self.span - 2)).all(1)
            owner, flat = owner[inside], flat[inside]
            if self.angular and self.n_phi < 3:
                pair = np.unique(np.c_[owner, flat], axis=0)
                owner, flat = pair[:, 0], pair[:, 1:]
            code = self._code(flat)
            at = np.searchsorted(self.code, code)
            at[at == len(self.code)] = 0
            ok = self.code[at] == code
            owner, cell = owner[ok], self.at[at[ok]]
            total = np.cumsum(self.size[cell])
            j = 0
            while j < len(cell):
                done = total[j - 1] if j else 0
                k = max(j + 1, int(np.searchsorted(total, done + PAIRS, "right")))
                n = self.size[cell[j:k]]
                seed = np.repeat(owner[j:k], n)
                point = self.order[np.arange(int(n.sum())) + np.repeat(self.start[cell[j:k]] - (np.cumsum(n) - n), n)]
                if self.angular:
                    close = _delta(q[seed], self.p[point], True) <= self.radius
                else:  # as _delta, column by column
                    d = reduce(np.add, ((np.take(a, seed) - np.take(b, point)) ** 2 for a, b in zip(q.T, self.columns, strict=True)))
                    close = np.flatnonzero(np.sqrt(d, out=d) <= self.radius)
                yield seed[close], point[close]
                j = k


class _Few:
    """As _Grid, of so few points that a grid does not pay."""

    MOST = 256

    def __init__(self, p: np.ndarray, radius: float, angular: bool):
        self.p, self.radius, self.angular = p, radius, angular

    def near(self, q: np.ndarray):
        step = max(1, PAIRS // len(self.p))
        for i in range(0, len(q), step):
            seed, point = np.nonzero(_delta(q[i : i + step, None], self.p[None], self.angular) <= self.radius)
            yield seed + i, point


def _lookup(p: np.ndarray, radius: float, angular: bool) -> _Few | _Grid:
    return (_Few if len(p) <= _Few.MOST else _Grid)(p, radius, angular)


BOX_POINTS = 1024  # points that are held together against the centres that may be nearest to one of them


def _boxes(p: np.ndarray):
    """Indices of the points in boxes of at most BOX_POINTS, halved along the longest side."""
    left = [np.arange(len(p))]
    while left:
        at = left.pop()
        if len(at) <= BOX_POINTS:
            yield at
            continue
        x = p[at]
        by = np.argpartition(x[:, (x.max(0) - x.min(0)).argmax()], len(at) // 2)
        left += [at[by[: len(at) // 2]], at[by[len(at) // 2 :]]]


RASTER_CELLS, RASTER_POINTS, RASTER_PAIRS = 1 << 16, 32, 1 << 23  # cells at most, points in one on average at least, (cell, centre) pairs at most


def _far_apart(mid: np.ndarray, half: np.ndarray, centres: np.ndarray, angular: bool) -> np.ndarray:
    """Which centres may be nearest to a point of each box: those not farther from it than another one's farthest corner."""
    near, far = 0.0, 0.0
    for k in range(2):
        d = np.abs(mid[:, k, None] - centres[None, :, k])
        if angular and k:
            d = np.abs(wrap(d))
        to = np.minimum(d + half[k], math.pi) if angular and k else d + half[k]
        near, far = near + np.maximum(d - half[k], 0) ** 2, far + to**2
    return ~(np.sqrt(near) > np.sqrt(far).min(1, keepdims=True) * (1 + 1e-9) + 1e-12)


def _nearest_by_raster(p: np.ndarray, centres: np.ndarray, angular: bool, low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As _nearest, in two dimensions. Points lie in a raster of cells; where only one centre may be nearest to a cell it is that of all its points."""
    side = max(1, int(math.sqrt(min(RASTER_CELLS, len(p) / RASTER_POINTS, RASTER_PAIRS / len(centres)))))
    width = np.maximum(span, 1e-12) / side

    def code(x: np.ndarray) -> np.ndarray:
        c = np.minimum(((x[:, 0] - low[0]) / width[0]).astype(np.int64), side - 1) * side
        return c + np.minimum(((x[:, 1] - low[1]) / width[1]).astype(np.int64), side - 1)

    some = [slice(i, i + PAIRS) for i in range(0, len(p), PAIRS)]
    there = np.flatnonzero(reduce(np.add, (np.bincount(code(p[x]), minlength=side * side) for x in some)))
    mid = low + (np.stack([there // side, there % side], 1) + 0.5) * width
    half = width / 2 * (1 + 1e-6) + 1e-12 + 8 * np.finfo(float).eps * (np.abs(low) + span)  # rounding of cell borders
    cells, of = [], []
    step = max(1, PAIRS // len(centres))
    for i in range(0, len(there), step):
        a, b = np.nonzero(_far_apart(mid[i : i + step], half, centres, angular))
        cells.append(a + i)
        of.append(b)
    cells, of = np.concatenate(cells), np.concatenate(of)
    n = np.bincount(cells, minlength=len(there))
    first = np.cumsum(n) - n
    place = np.zeros(side * side, np.int64)
    place[there] = np.arange(len(there))
    label, best = np.zeros(len(p), np.int64), np.zeros(len(p))
    for x in some:
        label[x], best[x] = _nearest_of_cells(p[x], place[code(p[x])], centres, of, first, n, angular)
    return label, best


def _nearest_of_cells(p: np.ndarray, cell: np.ndarray, centres: np.ndarray, of: np.ndarray, first: np.ndarray, n: np.ndarray, angular: bool) -> tuple[np.ndarray, np.ndarray]:
    """As _nearest, where those centres are looked at that ``of`` has from ``first`` on, ``n`` of them, for each point's cell."""
    label = of[first[cell]]
    best = _columns_delta(p.T, centres[label].T, angular)
    more = np.flatnonzero(n[cell] > 1)
    total, j = np.cumsum(n[cell[more]]), 0
    while j < len(more):
        done = total[j - 1] if j else 0
        e = max(j + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        at = more[j:e]
        m = n[cell[at]]
        c = of[_pairs(m, first[cell[at]])]
        d = _columns_delta((np.repeat(x, m) for x in p[at].T), centres[c].T, angular)
        best[at], k = _first_least(d, np.cumsum(m) - m, m)
        label[at] = c[k]
        j = e
    return label, best


def _columns_delta(a, b, angular: bool) -> np.ndarray:
    """As _delta, of columns."""
    d = [x - y for x, y in zip(a, b, strict=True)]
    if angular:
        d[1] = wrap(d[1])
    return np.sqrt(reduce(np.add, (x * x for x in d)))


def _first_least(d: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least of each run of numbers, where it stands first)."""
    least = np.minimum.reduceat(d, start)
    where = np.flatnonzero(d == np.repeat(least, n))
    return least, where[np.searchsorted(where, start)]


def _nearest(p: np.ndarray, centres: np.ndarray, angular: bool) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre of each point, its distance), in blocks of bounded size; of equally near centres the first.

    Points are put into boxes; a centre farther from a box than another one's farthest corner is nearest to none of its points.
    """
    few = len(p) * len(centres) <= 1 << 14
    if not few and p.shape[1] == 2 and len(centres) <= 4096:
        low = p.min(0)
        span = p.max(0) - low
        if np.isfinite(span).all() and np.isfinite(centres).all():
            return _nearest_by_raster(p, centres, angular, low, span)
    label, best = np.zeros(len(p), np.int64), np.full(len(p), np.inf)
    for box in [np.arange(len(p))] if few else _boxes(p):
        near = np.arange(len(centres))
        if not few:
            low, high = p[box].min(0), p[box].max(0)
            half = (high - low) / 2 * (1 + 1e-9) + 1e-12
            d = np.abs(low + (high - low) / 2 - centres)
            if angular:
                d[:, 1] = np.abs(wrap(d[:, 1]))
            to = d + half
            if angular:
                to[:, 1] = np.minimum(to[:, 1], math.pi)
            far = np.sqrt((to * to).sum(1)).min() * (1 + 1e-9) + 1e-12
            d = np.maximum(d - half, 0)
            near = np.flatnonzero(~(np.sqrt((d * d).sum(1)) > far))
        step = max(1, PAIRS // len(near))
        for i in range(0, len(box), step):
            at = box[i : i + step]
            d = _delta(p[at, None], centres[near][None], angular)
            k = d.argmin(1)
            label[at], best[at] = near[k], d[np.arange(len(at)), k]
    return label, best


def bin_seeds(p: np.ndarray, size: float, least: int = 1) -> np.ndarray:
    """Centres of the occupied bins (rounded half to even); all points if each is alone in its bin."""
    bins, _, n = _unique_rows(np.rint(p / size))
    return p.copy() if len(bins) == len(p) else bins[n >= least] * size


def angular_seeds(p: np.ndarray, size: float) -> np.ndarray:
    """Starting points in (eta, phi): each bin centre moves to the plain mean of the points nearest to it the short way round; one that is nearest to none stays. All points if each is alone in its bin."""
    p = p if np.isfinite(p).all() else np.nan_to_num(p, nan=0.0)
    seeds = bin_seeds(p, size)
    if len(seeds) == len(p):
        return seeds
    label, _ = _nearest(p, seeds, True)
    count = np.bincount(label, minlength=len(seeds))
    has = count > 0
    for k in range(p.shape[1]):
        seeds[has, k] = np.bincount(label, p[:, k], len(seeds))[has] / count[has]
    return seeds


def _kth_brute(q: np.ndarray, p: np.ndarray, k: int, angular: bool) -> float:
    """The sum, over q, of the distance to the k-th nearest of p."""
    total, step = 0.0, max(1, PAIRS // max(1, len(p)))
    for i in range(0, len(q), step):
        d = _delta(q[i : i + step, None], p[None], angular)
        total += np.partition(d, k - 1, axis=1)[:, k - 1].sum()
    return total


CELL_POINTS = 64  # in a cell of the grid by which bandwidths are estimated, about


def estimate_bandwidth(p: np.ndarray, angular: bool = True, quantile: float = QUANTILE) -> float:
    """The mean distance to the k-th nearest point (itself included), k = max(1, floor(n * quantile)); 0 without points.

    Points are put into cells. For all points of a cell the k-th nearest lies between two bounds that the other cells' boxes give; cells wholly nearer are only counted, cells wholly farther are left out, and distances are computed to
    the points of the ring in between. The result is that of all pairs.
    """
    n = len(p)
    if not n:
        return 0.0
    k = max(1, int(n * quantile))
    if n < 32 * CELL_POINTS:
        return _kth_brute(p, p, k, angular) / n
    lo, hi = p.min(0), p.max(0)
    side = max(1, int(math.sqrt(n / CELL_POINTS)))
    width = np.maximum(hi - lo, 1e-12) / side
    cell = np.minimum(((p - lo) / width).astype(np.int64), side - 1)
    order = np.argsort(cell[:, 0] * side + cell[:, 1], kind="stable")
    p, code = p[order], (cell[:, 0] * side + cell[:, 1])[order]
    start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    size = np.diff(np.r_[start, n])
    low, high = np.minimum.reduceat(p, start), np.maximum.reduceat(p, start)
    mid, half = (low + high) / 2, (high - low) / 2 * (1 + 1e-9) + 1e-12
    of, total = np.repeat(np.arange(len(start)), size), 0.0
    for c in range(len(start)):
        d = np.abs(mid - mid[c])
        if angular:
            d[:, 1] = np.abs(wrap(mid[:, 1] - mid[c, 1]))
        reach = half + half[c]
        near, far = np.maximum(d - reach, 0), d + reach
        if angular:
            far[:, 1] = np.minimum(far[:, 1], math.pi)
        near, far = np.sqrt((near * near).sum(1)), np.sqrt((far * far).sum(1))
        by = np.argsort(near)
        least = near[by[np.searchsorted(np.cumsum(size[by]), k)]]
        by = np.argsort(far)
        most = far[by[np.searchsorted(np.cumsum(size[by]), k)]]
        inside = far < least
        ring = ~inside & (near <= most)
        total += _kth_brute(p[start[c] : start[c] + size[c]], p[ring[of]], k - int(size[inside].sum()), angular)
    return total / n


class _Strips:
    """Sums over discs in (eta, phi) without looking at each of their points.

    Points lie in strips of eta, in a strip by phi. Of a strip's cells those that are wholly within a disc are summed by differences of running totals; only points of cells on the rim are held against the radius. Totals are whole
    numbers (coordinates times a power of two), so discs around the same points have the same sums to the bit, and climbs that meet go on as one.
    """

    def __init__(self, p: np.ndarray, radius: float):
        self.p, self.radius = p, radius
        phi = wrap(p[:, 1])
        # What lies near the seam is listed on its other side too; a disc is narrower than the circle and meets one of the two.
        edge = radius * (1 + 1e-6) + 1e-6
        low, high = np.flatnonzero(phi < edge - math.pi), np.flatnonzero(phi > math.pi - edge)
        self.at = np.concatenate([np.arange(len(p), dtype=np.int32), low.astype(np.int32), high.astype(np.int32)])
        phi = np.concatenate([phi, phi[low] + TURN, phi[high] - TURN])
        self.low, self.left = p[:, 0].min(), phi.min()
        span = max(p[:, 0].max() - self.low, 1e-9), max(phi.max() - self.left, 1e-9)
        m = min(128.0, max(4.0, 0.7 * math.sqrt(len(p)) / 4))  # cells along the radius
        m = min(m, math.sqrt((1 << 22) / max(1.0, (span[0] / radius + 1) * (span[1] / radius + 1))))
        self.side = max(radius / m, span[0] / (1 << 20), span[1] / (1 << 20))
        self.n = int(span[0] / self.side) + 1, int(span[1] / self.side) + 1
        code = np.minimum(((p[:, 0] - self.low) / self.side).astype(np.int64), self.n[0] - 1)[self.at]
        code *= self.n[1]
        code += np.minimum(((phi - self.left) / self.side).astype(np.int64), self.n[1] - 1)
        del phi, low, high
        self.at = self.at[np.argsort(code, kind="stable")]
        self.start = np.zeros(self.n[0] * self.n[1] + 1, np.int64)
        np.cumsum(np.bincount(code, minlength=len(self.start) - 1), out=self.start[1:])
        del code
        bound = max(1.0, float(np.abs(p[:, 0]).max())) * len(p)
        self.scale = 2.0 ** (61 - math.ceil(math.log2(bound)))
        self.totals = []
        for k, f in ((0, None), (1, np.sin), (1, np.cos)):
            x = p[self.at, k] if f is None else f(p[self.at, k])
            x *= self.scale
            total = np.zeros(len(x) + 1, np.int64)
            np.cumsum(np.rint(x, out=x).astype(np.int64), out=total[1:])  # may run over; differences do not
            self.totals.append(total)

    def sums(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _around, without weights."""
        out, n = np.zeros((len(q), 3), np.int64), np.zeros(len(q), np.int64)
        reach = int(self.radius / self.side) + 2
        step = max(1, (1 << 19) // (2 * reach + 1))
        for i in range(0, len(q), step):
            self._block(q[i : i + step], np.arange(-reach, reach + 1), out[i : i + step], n[i : i + step])
        return out / self.scale, n.astype(float), n

    def _block(self, q: np.ndarray, around: np.ndarray, out: np.ndarray, n: np.ndarray) -> None:
        r, side, (rows, cols) = self.radius, self.side, self.n
        tiny = 1e-9 * side  # rounding of cell borders: such cells count as rim
        eta, phi = q[:, 0], wrap(q[:, 1])
        strip = np.floor((np.clip(eta, self.low - 2 * r, self.low + rows * side + 2 * r) - self.low) / side).astype(np.int64)[:, None] + around
        below = self.low + strip * side - eta[:, None]
        least = np.maximum(np.maximum(below, -below - side) - tiny, 0)
        most = np.maximum(np.abs(below), np.abs(below + side)) + tiny
        seed, k = np.nonzero((strip >= 0) & (strip < rows) & (least <= r))
        least, most, base, phi = least[seed, k], most[seed, k], strip[seed, k] * cols, phi[seed] - self.left
        outer = np.sqrt(r * r - least * least) + tiny + 1e-12
        inner = np.sqrt(np.maximum(r * r - most * most, 0)) - tiny - 1e-12
        a = np.clip(np.floor((phi - outer) / side - 1e-9), 0, cols).astype(np.int64)
        d = np.clip(np.floor((phi + outer) / side + 1e-9) + 1, 0, cols).astype(np.int64)
        d = np.maximum(a, d)
        b = np.clip(np.ceil((phi - inner) / side + 1e-9).astype(np.int64), a, d)
        c = np.clip(np.floor((phi + inner) / side - 1e-9).astype(np.int64), b, d)
        # No point lies outside the cells, and the last one along each side is cut off by the points' own bounds.
        whole = inner > 0
        b, c = np.where(whole, b, d), np.where(whole, c, d)
        a, b, c, d = (self.start[base + v] for v in (a, b, c, d))
        full = np.flatnonzero(c > b)
        for t in range(3):
            x = self.totals[t]
            self._add(out[:, t], seed[full], x[c[full]] - x[b[full]])
        self._add(n, seed[full], c[full] - b[full])
        owner, first, size = np.concatenate([seed, seed]), np.concatenate([a, c]), np.concatenate([b - a, d - c])
        some = np.flatnonzero(size)
        owner, first, size = owner[some], first[some], size[some]
        total, j = np.cumsum(size), 0
        while j < len(size):
            done = total[j - 1] if j else 0
            e = max(j + 1, int(np.searchsorted(total, done + PAIRS, "right")))
            m = size[j:e]
            s = np.repeat(owner[j:e], m)
            i = np.arange(int(m.sum())) + np.repeat(first[j:e] - (np.cumsum(m) - m), m)
            close = np.flatnonzero(_delta(q[s], self.p[self.at[i]], True) <= r)
            s, i = s[close], i[close]
            for t in range(3):
                x = self.totals[t]
                self._add(out[:, t], s, x[i + 1] - x[i])
            self._add(n, s, np.ones(len(s), np.int64))
            j = e

    @staticmethod
    def _add(to: np.ndarray, s: np.ndarray, x: np.ndarray) -> None:
        """Whole numbers are added where they belong, without going through floats."""
        if len(s):
            by = np.argsort(s, kind="stable")
            s, x = s[by], x[by]
            first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            to[s[first]] += np.add.reduceat(x, first)


STRIPS_FROM = 4096  # points from which strips pay


def _around(grid: _Few | _Grid, p: np.ndarray, w: np.ndarray | None, q: np.ndarray, angular: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What lies around each q: weighted sums (of an angle's sine and cosine), mass and number of points."""
    sums, mass, n = np.zeros((len(q), 3)), np.zeros(len(q)), np.zeros(len(q), np.int64)
    for s, i in grid.near(q):
        x = p[i]
        terms = [x[:, 0], np.sin(x[:, 1]), np.cos(x[:, 1])] if angular else [*x.T]
        for c, t in enumerate(terms):
            sums[:, c] += np.bincount(s, t if w is None else t * w[i], len(q))
        if w is not None:
            mass += np.bincount(s, w[i], len(q))
        n += np.bincount(s, minlength=len(q))
    return sums, n.astype(float) if w is None else mass, n


def _moved(q: np.ndarray, sums: np.ndarray, mass: np.ndarray, angular: bool) -> np.ndarray:
    """Where seeds go; one without mass around it stays."""
    new, has = q.copy(), mass > 0
    if angular:
        new[has, 0] = sums[has, 0] / mass[has]
        new[has, 1] = np.arctan2(sums[has, 1], sums[has, 2])
    else:
        new[has] = sums[has, : q.shape[1]] / mass[has, None]
    return new


def _winners(at: np.ndarray, count: np.ndarray, bandwidth: float, angular: bool) -> np.ndarray:
    """The centres among ends of climbs, in descending order of support: each silences those behind it within the bandwidth."""
    at, count = at[count > 0], count[count > 0]
    if not len(at):
        raise ValueError("no point lies within the bandwidth of any seed")
    order = np.lexsort((*[-at[:, k] for k in reversed(range(at.shape[1]))], -count))
    at = at[order]
    keep = np.ones(len(at), bool)
    if len(at) > 1024:  # only what lies around centres is looked at: pairs of many ends of one climb would be too many
        grid = _Grid(at, bandwidth, angular)
        for i in range(len(at)):
            if keep[i]:
                for _, b in grid.near(at[i : i + 1]):
                    keep[b[b > i]] = False
        return at[keep]
    pairs = [np.stack(x) for x in _lookup(at, bandwidth, angular).near(at)]
    a, b = np.concatenate(pairs, 1)
    behind = b > a
    a, b = a[behind], b[behind]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    first = np.searchsorted(a, np.arange(len(at) + 1))
    for i in range(len(at)):
        if keep[i]:
            keep[b[first[i] : first[i + 1]]] = False
    return at[keep]


def fit(p: np.ndarray, bandwidth: float, angular: bool, seeds: np.ndarray | None = None, weights: np.ndarray | None = None, cluster_all: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(label of each point, centres). NaN counts as 0; centres are in descending order of support; without ``cluster_all`` a point beyond the bandwidth of every centre is labelled -1. Without ``seeds`` climbs start at the centres of bins."""
    p = np.nan_to_num(np.asarray(p, float), nan=0.0)
    if not len(p):
        return np.zeros(0, np.int64), np.zeros((0, p.shape[1]))
    at = bin_seeds(p, bandwidth) if seeds is None else np.array(seeds, float)
    centres = _climb(p, bandwidth, angular, at, weights)
    label, best = _nearest(p, centres, angular)
    if not cluster_all:
        label[best > bandwidth] = -1
    return label, centres


def _pairs(n: np.ndarray, first: np.ndarray) -> np.ndarray:
    """first, first + 1, ... n of them, of each."""
    return np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)


def _batches(n: np.ndarray):
    """Slices of events whose points make about PAIRS pairs with the seeds."""
    total, i = np.cumsum(n.astype(np.int64) * np.minimum(n, 32)), 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
        yield i, j
        i = j


def fit_many(p: np.ndarray, n: np.ndarray, bandwidth: float, angular: bool, weights: np.ndarray | None = None, cluster_all: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(label within the event, centre) of each point: ``fit`` of many events of few points at once, with the same sums in the same order. Points lie event by event, ``n`` of each; climbs start as in mean_shift."""
    p = np.nan_to_num(np.asarray(p, float), nan=0.0)
    label, at = np.zeros(len(p), np.int64), np.full(p.shape, np.nan)
    start = np.cumsum(n) - n
    for i, j in _batches(n):
        rows = slice(int(start[i]), int(start[j - 1] + n[j - 1]))
        label[rows], at[rows] = _fit_batch(p[rows], n[i:j], bandwidth, angular, None if weights is None else weights[rows], cluster_all)
    return label, at


def _fit_batch(p: np.ndarray, n: np.ndarray, bandwidth: float, angular: bool, w: np.ndarray | None, cluster_all: bool) -> tuple[np.ndarray, np.ndarray]:
    first, event, columns = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n), np.ascontiguousarray(p.T)
    q, of = _seeds_of_many(p, n, event, bandwidth, angular)
    terms = [columns[0], np.sin(columns[1]), np.cos(columns[1])] if angular else [*columns]
    ends, counts, owners = [], [], []
    for k in range(MAX_ITER):
        if not len(q):
            break
        m = n[of]
        near = _pairs(m, first[of])
        d = np.repeat(q[:, 0], m) - columns[0][near]
        close = np.flatnonzero(np.abs(d) <= bandwidth)  # most pairs are this far apart already
        s, near = np.repeat(np.arange(len(q)), m)[close], near[close]
        close = _columns_delta((x[s] for x in q.T), (x[near] for x in columns), angular) <= bandwidth
        s, near = s[close], near[close]
        sums, found = np.zeros((len(q), 3)), np.bincount(s, minlength=len(q))
        for c, t in enumerate(terms):
            sums[:, c] += np.bincount(s, t[near] if w is None else t[near] * w[near], len(q))
        mass = found.astype(float) if w is None else np.bincount(s, w[near], len(q))
        new = _moved(q, sums, mass, angular)
        goes = (mass > 0) & (_delta(new, q, angular) >= STOP * bandwidth) & (k < MAX_ITER - 1)
        ends.append(new[~goes])
        counts.append(found[~goes])
        owners.append(of[~goes])
        q, of = new[goes], of[goes]
    ends, counts, owners = np.concatenate(ends), np.concatenate(counts), np.concatenate(owners)
    centres, of = _winners_of_many(ends, counts, owners, len(n), bandwidth, angular)
    m = np.bincount(of, minlength=len(n))
    begin = np.cumsum(m) - m
    each = m[event]
    c = _pairs(each, begin[event])
    best, k = _first_least(_columns_delta((np.repeat(x, each) for x in columns), centres[c].T, angular), np.cumsum(each) - each, each)
    k = c[k]
    label, at = k - begin[event], centres[k]
    if not cluster_all:
        label[best > bandwidth], at[best > bandwidth] = -1, np.nan
    return label, at


def _seeds_of_many(p: np.ndarray, n: np.ndarray, event: np.ndarray, size: float, angular: bool) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, event of each): bin_seeds, with ``angular`` angular_seeds, of each event."""
    bins, own, _ = _unique_rows(np.column_stack([event, np.rint(p / size)]))
    of, seeds = bins[:, 0].astype(np.int64), bins[:, 1:] * size
    m = np.bincount(of, minlength=len(n))
    alone = m == n
    seeds[alone[of]] = p[alone[event]]
    at = np.flatnonzero(~alone[event])
    if not angular or not len(at):
        return seeds, of
    x, each = p[at], m[event[at]]
    reach = _delta(x, seeds[own[at]], True)  # a seed farther in eta is not the nearest
    c = _pairs(each, (np.cumsum(m) - m)[event[at]])
    close = np.flatnonzero(np.abs(np.repeat(x[:, 0], each) - seeds[c, 0]) <= np.repeat(reach, each))
    s, c = np.repeat(np.arange(len(at)), each)[close], c[close]
    each = np.bincount(s, minlength=len(at))
    _, k = _first_least(_columns_delta((x[s, 0], x[s, 1]), (seeds[c, 0], seeds[c, 1]), True), np.cumsum(each) - each, each)
    label = c[k]
    count = np.bincount(label, minlength=len(seeds))
    has = count > 0
    for k in range(2):
        seeds[has, k] = np.bincount(label, x[:, k], len(seeds))[has] / count[has]
    return seeds, of


def _winners_of_many(at: np.ndarray, count: np.ndarray, of: np.ndarray, n_events: int, bandwidth: float, angular: bool) -> tuple[np.ndarray, np.ndarray]:
    """(centres, event of each): _winners of each event, in the order of events."""
    has = count > 0
    at, count, of = at[has], count[has], of[has]
    n = np.bincount(of, minlength=n_events)
    if not n.all():
        raise ValueError("no point lies within the bandwidth of any seed")
    order = np.lexsort((*[-at[:, k] for k in reversed(range(at.shape[1]))], -count, of))
    at, of = at[order], of[order]
    last = np.cumsum(n)[of]
    m = last - np.arange(len(at)) - 1
    a, b = np.repeat(np.arange(len(at)), m), _pairs(m, np.arange(len(at)) + 1)
    close = _columns_delta((x[a] for x in at.T), (x[b] for x in at.T), angular) <= bandwidth
    a, b = a[close], b[close]
    keep = np.ones(len(at), bool)
    those, first = np.unique(a, return_index=True)
    bounds = [*first.tolist(), len(a)]
    for i, j, k in zip(those.tolist(), bounds[:-1], bounds[1:], strict=True):
        if keep[i]:
            keep[b[j:k]] = False
    return at[keep], of[keep]


def _climb(p: np.ndarray, bandwidth: float, angular: bool, at: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    """The centres to which seeds climb."""
    if angular and weights is None and len(p) >= STRIPS_FROM and bandwidth < 3:
        around = _Strips(p, bandwidth).sums
    else:
        grid = _lookup(p, bandwidth, angular)
        around = lambda q: _around(grid, p, weights, q, angular)
    ends, counts, q = [], [], at
    for _ in range(MAX_ITER):
        if not len(q):
            break
        q = _distinct(q)  # climbs that met end at one place, as one
        sums, mass, n = around(q)
        new = _moved(q, sums, mass, angular)
        goes = (mass > 0) & (_delta(new, q, angular) >= STOP * bandwidth)
        if _ == MAX_ITER - 1:
            goes[:] = False
        ends.append(new[~goes])
        counts.append(n[~goes])
        q = new[goes]
    return _winners(np.concatenate(ends), np.concatenate(counts), bandwidth, angular)


def _distinct(q: np.ndarray) -> np.ndarray:
    if len(q) < 256:
        return q
    by = np.lexsort(q.T)
    q = q[by]
    return q[np.r_[True, (q[1:] != q[:-1]).any(1)]]


def _column(t: pa.Table, c: str) -> np.ndarray:
    return t.column(c).combine_chunks().to_numpy(zero_copy_only=False)


def _events(t: pa.Table):
    """(event, row numbers) of each event of a table."""
    code = t.column("event_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(code[order])) + 1)


def _sized(points: DataFrame, most_points: int, ws: Workspace) -> tuple[DataFrame, DataFrame, int, int]:
    """(points, written once as several plans read them; ``event_id, _n`` of the events with more than most_points; their number; the number of buckets of the others)."""
    points = ws.write(points)
    seen = Observation()
    per_event = points.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("n"), F.count_if(F.col("_n") > most_points).alias("large"))
    sizes = ws.write(per_event.where(F.col("event_id").isNotNull() & (F.col("_n") > most_points)))  # at most (all points) / most_points rows
    return points, sizes, seen.get["large"] or 0, max(1, math.ceil((seen.get["n"] or 0) / BUCKET_POINTS))


def _by_bucket(points: DataFrame, buckets: int, function, out: str) -> DataFrame:
    """``function`` on whole events, many of them at once."""
    kept = points.columns
    bucketed = points.withColumn("_bucket", F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int")).repartition(buckets, "_bucket")
    return bucketed.groupBy("_bucket").applyInArrow(lambda t: function(t.select(kept)), out)


def mean_shift(points: DataFrame, coordinates: tuple[str, ...], bandwidth: float, angular: bool = False, weight: str | None = None, cluster_all: bool = True, most_points: int = MOST_POINTS, most_gathered: int = MOST_GATHERED, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Labels of the points of each event: the input's columns, then ``cluster_id`` and the centre's coordinates as ``c_<name>``; with ``keep`` only those of them.

    An event with one point has one cluster; a negative bandwidth puts all points of an event into cluster 0. Climbs start at the centres of bins, with ``angular`` at angular_seeds. Points with a null coordinate should be filtered before.
    """
    kinds = {f.name: f.dataType.simpleString() for f in points.schema.fields} | {"cluster_id": "int"} | {f"c_{c}": "double" for c in coordinates}
    keep = list(keep or kinds)
    out = ", ".join(f"{c} {kinds[c]}" for c in keep)

    def labelled(t: pa.Table, label: np.ndarray, centres: np.ndarray) -> pa.Table:
        t = t.append_column("cluster_id", pa.array(label.astype(np.int32)))
        for k, c in enumerate(coordinates):
            t = t.append_column(f"c_{c}", pa.array(np.where(label >= 0, centres[label, k], np.nan)))
        return t.select(keep)

    def whole(t: pa.Table) -> pa.Table:
        p = np.stack([_column(t, c) for c in coordinates], 1).astype(float)
        w = _column(t, weight) if weight else None
        label, at = np.zeros(len(p), np.int64), np.full(p.shape, np.nan)
        events = list(_events(t))
        if bandwidth >= 0:
            few = [i for i in events if len(i) <= _Few.MOST]
            if few:
                i = np.concatenate(few)
                label[i], at[i] = fit_many(p[i], np.array([len(x) for x in few]), bandwidth, angular, w[i] if weight else None, cluster_all)
            events = [i for i in events if len(i) > _Few.MOST]
        for i in events:
            x = p[i]
            if bandwidth < 0:
                at[i] = x.mean(0)
                continue
            label[i], c = fit(x, bandwidth, angular, seeds=angular_seeds(x, bandwidth) if angular else None, weights=w[i] if weight else None, cluster_all=cluster_all)
            has = label[i] >= 0
            at[i[has]] = c[label[i[has]]]
        t = t.append_column("cluster_id", pa.array(label.astype(np.int32)))
        for k, c in enumerate(coordinates):
            t = t.append_column(f"c_{c}", pa.array(at[:, k]))
        return t.select(keep)

    ws = Workspace(points.sparkSession)
    points, sizes, n_large, buckets = _sized(points, most_points, ws)
    if not n_large:
        return _by_bucket(points, buckets, whole, out)
    small = _by_bucket(points.join(sizes, "event_id", "left_anti"), buckets, whole, out)
    chunks = sizes.select("event_id", F.ceil(F.col("_n") / most_points).cast("int").alias("_chunks"))
    # Chunks by position, so that equal points, which sums do not tell apart, are all that a hash may leave together.
    divided = points.join(chunks, "event_id").withColumn("_chunk", F.pmod(F.xxhash64(*[c for c in points.columns if c != "event_id"]), "_chunks").cast("int")).drop("_chunks")
    if bandwidth < 0:
        means = divided.groupBy("event_id").agg(*[F.avg(c).alias(f"c_{c}") for c in coordinates])
        return small.unionByName(divided.drop("_chunk").withColumn("cluster_id", F.lit(0)).join(means, "event_id").select(*small.columns))
    coords = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in coordinates]
    slim = points.select("event_id", *coords, *([F.col(weight).cast("double").alias("_w")] if weight else []))

    def climbed(t: pa.Table) -> pa.Table:
        p = np.stack([_column(t, c) for c in coordinates], 1)
        at = _climb(p, bandwidth, angular, angular_seeds(p, bandwidth) if angular else bin_seeds(p, bandwidth), _column(t, "_w") if weight else None)
        event = pa.array(np.full(len(at), t.column("event_id")[0].as_py()))
        return pa.Table.from_arrays([event, pa.array(np.arange(len(at), dtype=np.int32)), *(pa.array(at[:, k]) for k in range(len(coordinates)))], ["event_id", "place", *[f"c_{c}" for c in coordinates]])

    gathered = slim.join(sizes.where(F.col("_n") <= most_gathered).select("event_id"), "event_id").repartition(4 * n_large, "event_id").groupBy("event_id")
    centres = ws.write(gathered.applyInArrow(lambda t: climbed(t), "event_id bigint, place int, " + ", ".join(f"c_{c} double" for c in coordinates)))
    beyond = sizes.where(F.col("_n") > most_gathered).select("event_id")
    if not beyond.isEmpty():
        centres = centres.unionByName(_large_centres(divided.join(beyond, "event_id", "left_semi"), chunks.join(beyond, "event_id", "left_semi"), coordinates, bandwidth, angular, weight, ws))

    def chunk(t: pa.Table, c: pa.Table) -> pa.Table:
        order = np.argsort(_column(c, "place"))
        at = np.stack([_column(c, f"c_{x}") for x in coordinates], 1)[order]
        p = np.nan_to_num(np.stack([_column(t, x) for x in coordinates], 1).astype(float), nan=0.0)
        label, best = _nearest(p, at, angular) if len(p) else (np.zeros(0, np.int64), np.zeros(0))
        if not cluster_all:
            label[best > bandwidth] = -1
        return labelled(t.drop_columns(["_chunk"]), label, at)

    each = centres.join(chunks, "event_id").withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    return small.unionByName(divided.groupBy("event_id", "_chunk").cogroup(each.groupBy("event_id", "_chunk")).applyInArrow(lambda t, c: chunk(t, c), out))


def _large_centres(divided: DataFrame, chunks: DataFrame, coordinates: tuple[str, ...], bandwidth: float, angular: bool, weight: str | None, ws: Workspace) -> DataFrame:
    """``event_id, place`` and ``c_<name>``: the centres of events whose points lie in chunks."""
    names = [f"c_{c}" for c in coordinates]
    key = ["event_id", "_chunk"]
    num = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in coordinates]
    slim = ws.write(divided.select(*key, *num, (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w")))
    bins = slim.select("event_id", *[F.rint(F.col(c) / bandwidth).alias(c) for c in coordinates]).distinct()
    full = slim.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).join(bins.groupBy("event_id").agg(F.count(F.lit(1)).alias("b")), "event_id")
    alone = full.where("n = b").select("event_id")  # each point is alone in its bin
    start = bins.join(alone, "event_id", "left_anti").select("event_id", *[(F.col(c) * bandwidth).alias(f"c_{c}") for c in coordinates]).unionByName(slim.join(alone, "event_id", "left_semi").select("event_id", *[F.col(c).alias(f"c_{c}") for c in coordinates]))
    seeds = ws.write(start.withColumn("seed", F.xxhash64(*names)))
    spread = lambda df: df.join(chunks, "event_id").withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks").groupBy(*key)
    fields = ["event_id", "seed", "s0", "s1", "s2", "mass", "n"]
    ddl = "event_id bigint, seed bigint, s0 double, s1 double, s2 double, mass double, n bigint"

    def table(t: pa.Table, q: pa.Table, sums: np.ndarray, mass: np.ndarray, n: np.ndarray) -> pa.Table:
        there = np.flatnonzero(n)
        cols = [q.column("event_id").take(pa.array(there)), q.column("seed").take(pa.array(there)), *(pa.array(sums[there, k]) for k in range(3)), pa.array(mass[there]), pa.array(n[there])]
        return pa.Table.from_arrays(cols, fields)

    def read(t: pa.Table, q: pa.Table):
        return np.stack([_column(t, c) for c in coordinates], 1), np.stack([_column(q, c) for c in names], 1)

    def nearest(t: pa.Table, q: pa.Table) -> pa.Table:
        p, at = read(t, q)
        sums, n = np.zeros((len(at), 3)), np.zeros(len(at), np.int64)
        if len(p) and len(at):
            label, _ = _nearest(p, at, True)
            n = np.bincount(label, minlength=len(at))
            for k in range(p.shape[1]):
                sums[:, k] = np.bincount(label, p[:, k], len(at))
        return table(t, q, sums, n.astype(float), n)

    def climb(t: pa.Table, q: pa.Table) -> pa.Table:
        p, at = read(t, q)
        if not len(p) or not len(at):
            return table(t, q, np.zeros((len(at), 3)), np.zeros(len(at)), np.zeros(len(at), np.int64))
        return table(t, q, *_around(_Grid(p, bandwidth, angular), p, _column(t, "_w"), at, angular))

    def step(seeds: DataFrame, kernel) -> DataFrame:
        parts = slim.groupBy(*key).cogroup(spread(seeds)).applyInArrow(lambda t, q: kernel(t, q), ddl)
        return seeds.select("event_id", "seed", *names).join(parts.groupBy("event_id", "seed").agg(*[F.sum(c).alias(c) for c in fields[2:]]), ["event_id", "seed"], "left")

    has = F.coalesce(F.col("mass") > 0, F.lit(False))
    if angular:  # the seeds that are not points move to the plain mean of their nearest points
        several = step(seeds.join(alone, "event_id", "left_anti"), nearest)
        mean = [F.when(has, F.col(f"s{k}") / F.col("mass")).otherwise(F.col(c)).alias(c) for k, c in enumerate(names)]
        seeds = ws.write(several.select("event_id", "seed", *mean).unionByName(seeds.join(alone, "event_id", "left_semi").select("event_id", "seed", *names)))
    ends, live = [], seeds
    for k in range(MAX_ITER):
        if angular:
            new = [F.col("s0") / F.col("mass"), F.atan2("s1", "s2")]
            d = F.abs(new[1] - F.col(names[1]))
            far = F.sqrt((new[0] - F.col(names[0])) ** 2 + F.least(F.pmod(d, F.lit(TURN)), TURN - F.pmod(d, F.lit(TURN))) ** 2)
        else:
            new = [F.col(f"s{k}") / F.col("mass") for k in range(len(names))]
            far = F.sqrt(sum(((v - F.col(c)) ** 2 for v, c in zip(new, names, strict=True)), F.lit(0.0)))
        goes = has & (far >= STOP * bandwidth) if k < MAX_ITER - 1 else F.lit(False)
        moved = step(live, climb).select("event_id", "seed", *[F.when(has, v).otherwise(F.col(c)).alias(c) for v, c in zip(new, names, strict=True)], F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(goes, F.lit(False)).alias("goes"))
        moved, n_live = ws.count(moved, "goes")
        ends.append(moved.where("not goes").select("event_id", *names, "n"))
        live = moved.where("goes").select("event_id", "seed", *names)
        if not n_live:
            break
    ddl = "event_id bigint, place int, " + ", ".join(f"{c} double" for c in names)

    def choose(t: pa.Table) -> pa.Table:
        at = _winners(np.stack([_column(t, c) for c in names], 1), _column(t, "n"), bandwidth, angular)
        return pa.Table.from_arrays([pa.array(np.full(len(at), t.column("event_id")[0].as_py())), pa.array(np.arange(len(at), dtype=np.int32)), *(pa.array(at[:, k]) for k in range(len(names)))], ["event_id", "place", *names])

    return ws.write(reduce(DataFrame.unionByName, ends).groupBy("event_id").applyInArrow(lambda t: choose(t), ddl))


def not_nearest(labelled: DataFrame, coordinates: tuple[str, ...], most_points: int = MOST_POINTS) -> DataFrame:
    """``event_id, block_no, pos`` of the points of mean_shift in space that are nearer to another centre of their event than to their own. A right clustering gives no rows.

    The centres of an event are gathered (they are few: no two within a bandwidth); the points of an event with more than ``most_points`` are held against them chunk by chunk.
    """
    own, kept = [f"c_{c}" for c in coordinates], ["event_id", "block_no", "pos"]
    labelled = labelled.where("cluster_id >= 0").select(*kept, *coordinates, *own)
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in labelled.select(*kept).schema.fields)
    read = lambda t, names: np.stack([_column(t, c) for c in names], 1).astype(float)

    def far(p: np.ndarray, mine: np.ndarray, centres: np.ndarray) -> np.ndarray:
        d = p - mine
        _, best = _nearest(p, centres, False)
        return best * best < (d * d).sum(1) * (1 - 1e-9) - 1e-9

    def whole(t: pa.Table) -> pa.Table:
        p, mine = read(t, coordinates), read(t, own)
        wrong = [i[far(p[i], mine[i], np.unique(mine[i], axis=0))] for i in _events(t)]
        return t.select(kept).take(pa.array(np.concatenate(wrong)))

    def chunk(t: pa.Table, c: pa.Table) -> pa.Table:
        wrong = far(read(t, coordinates), read(t, own), read(c, own)) if t.num_rows else np.zeros(0, bool)
        return t.select(kept).filter(pa.array(wrong))

    ws = Workspace(labelled.sparkSession)
    labelled, sizes, n_large, buckets = _sized(labelled, most_points, ws)
    if not n_large:
        return _by_bucket(labelled, buckets, whole, out)
    small = _by_bucket(labelled.join(sizes, "event_id", "left_anti"), buckets, whole, out)
    chunks = sizes.select("event_id", F.ceil(F.col("_n") / most_points).cast("int").alias("_chunks"))
    divided = labelled.join(chunks, "event_id").withColumn("_chunk", F.pmod(F.xxhash64("block_no", "pos"), "_chunks").cast("int")).drop("_chunks")
    centres = ws.write(labelled.join(sizes.select("event_id"), "event_id").select("event_id", *own).distinct())
    each = centres.join(chunks, "event_id").withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    return small.unionByName(divided.groupBy("event_id", "_chunk").cogroup(each.groupBy("event_id", "_chunk")).applyInArrow(lambda t, c: chunk(t, c), out))


def two_level(points: DataFrame, first: float = 0.2, second: float = 0.05, large: int = 2000, top_percent: float = 4.0, most_points: int = MOST_POINTS) -> DataFrame:
    """Two-level clustering in (eta, phi): seeded by the hits of highest energy; clusters with more than ``large`` hits are divided again, all members together, seeded by the top ``top_percent`` percent of their hits. Adds ``cluster_id, sub_id``.

    With a column ``is_calo`` points without it (tracks) take part in both levels, but neither count against ``large`` nor seed; without the column all points are hits. An event without hits starts at angular_seeds. An event with more than ``most_points`` points is a task of its own.
    """
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields) + ", cluster_id int, sub_id int"

    def top(e: np.ndarray) -> np.ndarray:
        return np.lexsort((np.arange(len(e)), -e))[: max(1, math.ceil(top_percent / 100 * len(e)))]

    def one(p: np.ndarray, e: np.ndarray, calo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hits = np.flatnonzero(calo)
        label, _ = fit(p, first, True, seeds=p[hits[top(e[hits])]] if hits.size else angular_seeds(p, first))
        sub = np.zeros(len(p), np.int64)
        for k in np.flatnonzero(np.bincount(label[hits]) > large).tolist():
            at = np.flatnonzero(label == k)
            own = at[calo[at]]
            sub[at], _ = fit(p[at], second, True, seeds=p[own[top(e[own])]])
        return label, sub

    def whole(t: pa.Table) -> pa.Table:
        p, e = np.stack([_column(t, c) for c in ("eta", "phi")], 1), _column(t, "energy")
        calo = _column(t, "is_calo").astype(bool) if "is_calo" in t.column_names else np.ones(len(p), bool)
        label, sub = np.zeros(len(p), np.int32), np.zeros(len(p), np.int32)
        for i in _events(t):
            label[i], sub[i] = one(p[i], e[i], calo[i])
        return t.append_column("cluster_id", pa.array(label)).append_column("sub_id", pa.array(sub))

    points, sizes, n_large, buckets = _sized(points, most_points, Workspace(points.sparkSession))
    if not n_large:
        return _by_bucket(points, buckets, whole, out)
    alone = points.join(sizes.select("event_id"), "event_id").select(*points.columns).repartition(4 * n_large, "event_id").groupBy("event_id").applyInArrow(lambda t: whole(t), out)
    return _by_bucket(points.join(sizes, "event_id", "left_anti"), buckets, whole, out).unionByName(alone)


def bandwidths(points: DataFrame, coordinates: tuple[str, str] = ("eta", "phi")) -> DataFrame:
    """``event_id, n_points, bandwidth``: the estimated bandwidth of each event."""

    def one(t: pa.Table) -> pa.Table:
        p = np.stack([_column(t, c) for c in coordinates], 1)
        return pa.table({"event_id": t.column("event_id").slice(0, 1), "n_points": pa.array([len(p)], pa.int64()), "bandwidth": pa.array([estimate_bandwidth(p)])})

    return points.groupBy("event_id").applyInArrow(lambda t: one(t), "event_id bigint, n_points bigint, bandwidth double")


def seed_bins(points: DataFrame, coordinates: tuple[str, ...], size: float, least: int = 1) -> DataFrame:
    """Occupied bins per event, ``event_id, bin_<name>.., n``; bins of fewer than ``least`` points are left out. Needs no Python."""
    bins = [F.rint(F.col(c) / size).cast("bigint").alias(f"bin_{c}") for c in coordinates]
    return points.groupBy("event_id", *bins).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
