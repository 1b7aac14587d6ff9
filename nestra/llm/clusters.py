"""Similarity clusters of hits (in space) and tracks (in angle): MinHash bands, exact Jaccard, components, medoids.

Records carry the fine cells around them as shingles; equal MinHash bands make candidates, exact Jaccard and then the exact distance verify them, and links join groups (see minhash). The wanted clusters are exact: the finest
division in which records nearer than the limit are never apart, and one link lost by chance would split a cluster. So the groups are completed on a coarse grid: two records nearer than the limit share a coarse cell or lie in
cells at most two apart, and only pairs of cells that are not in one group yet are looked at. ``band_recall`` measures what the bands find by themselves.

Typical members are those nearest to a cluster's mean position. Loose clusters, those with several peaks, are split around their medoids (``medoid_groups``): the hits of most links of a Jaccard of at least ``SIMILAR``.

Hits: whole events are hashed into buckets of bounded size, each solved by vectorised NumPy. An event with more hits than ``MOST_HITS`` is cut into tiles of cells with a margin of two cells; tiles are solved alone and
labels of cells that several tiles see are joined by random-mate contraction. Tracks: angles are reduced to bins (about 2 pi / limit per event) before bands join them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from nestra.llm.contraction import components
from nestra.llm.minhash import FINE, WIDTH, Shingles
from nestra.arrow import array, list_lengths, zip_lists
from nestra.runtime import Workspace, pieces

HIT_LIMIT, HIT_LEAST = 40.0, 5  # mm, members
TRACK_LIMIT, TRACK_LEAST = 0.02, 3  # rad, members
BUCKET_BYTES = 2 << 20  # of compressed coordinates in a bucket of whole events, about
MOST_HITS = 1 << 19  # hits of an event, or of a tile, that meet in one task
PAIRS = 1 << 21  # distances computed at once
TILES = (64, 16, 4)  # cells along a tile's edge
SIMILAR = 0.8  # Jaccard from which two hits are linked in medoid_groups

MEMBERS = "event_id bigint, first_block_no int, first_pos int, block_no int, pos int, n_members bigint"


# The kernel: connected components of cells.


def _roots(parent: np.ndarray) -> np.ndarray:
    while not np.array_equal(up := parent[parent], parent):
        parent = up
    return parent


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of a[k] and b[k] for all k."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        hi, lo = np.maximum(ra[apart], rb[apart]), np.minimum(ra[apart], rb[apart])
        np.minimum.at(parent, hi, lo)
        parent = _roots(parent)


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices starts[k] .. starts[k] + counts[k] - 1 for all k, and k for each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner], owner


def _linked(p: np.ndarray, start: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Which pairs of cells (a[k], b[k]) have points nearer than the limit."""
    out = np.zeros(len(a), bool)
    # Only points within the limit of the other cell's bounding box can be near one of its points.
    near = []
    for own, other in ((a, b), (b, a)):
        at, k = _spread(start[own], size[own])
        d = np.maximum(np.maximum(lo[other[k]] - p[at], p[at] - hi[other[k]]), 0)
        d2 = np.einsum("ij,ij->i", d, d)
        keep = d2 < limit * limit
        at, k, d2 = at[keep], k[keep], d2[keep]
        order = np.lexsort((d2, k))
        near.append((at[order], np.bincount(k, minlength=len(a))))
    (pa_, na), (pb, nb) = near
    sa, sb = np.cumsum(na) - na, np.cumsum(nb) - nb
    open_ = np.flatnonzero((na > 0) & (nb > 0))
    if open_.size:  # the two points nearest to the other's box usually decide
        d = p[pa_[sa[open_]]] - p[pb[sb[open_]]]
        hit = np.einsum("ij,ij->i", d, d) < limit * limit
        out[open_[hit]] = True
        open_ = open_[~hit]
    cost = na[open_].astype(np.int64) * nb[open_]
    i = 0
    while i < len(open_):
        j = max(i + 1, int(np.searchsorted(np.cumsum(cost[i:]), PAIRS, "right")) + i)
        k = open_[i:j]
        if len(k) == 1 and cost[i] > PAIRS:  # one large pair of cells: in strips
            step = max(1, PAIRS // int(nb[k[0]]))
            mine, theirs = pa_[sa[k[0]] : sa[k[0]] + na[k[0]]], p[pb[sb[k[0]] : sb[k[0]] + nb[k[0]]]]
            for s in range(0, len(mine), step):
                d = p[mine[s : s + step], None] - theirs[None]
                if (np.einsum("ijk,ijk->ij", d, d) < limit * limit).any():
                    out[k[0]] = True
                    break
        else:
            row, of = _spread(sa[k], na[k])
            col, r = _spread(sb[k][of], nb[k][of])
            d = p[pa_[row[r]]] - p[pb[col]]
            hit = np.einsum("ij,ij->i", d, d) < limit * limit
            out[k[of[r[hit]]]] = True
        i = j
    return out


def band_groups(sets: Shingles, linked) -> np.ndarray:
    """The group of each set from banding alone: candidates are verified by exact Jaccard, then by ``linked(a, b)``."""
    parent = np.arange(len(sets))
    for a, b in sets.candidates():
        apart = parent[a] != parent[b]
        a, b = a[apart], b[apart]
        similar = sets.jaccard(a, b) >= sets.least
        a, b = a[similar], b[similar]
        good = linked(a, b)
        parent = _hook(parent, a[good], b[good])
    return parent


def _hit_groups(event: np.ndarray, p: np.ndarray, limit: float) -> tuple[Shingles, np.ndarray]:
    sets = Shingles(event, p, limit)

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = p[sets.first[a]] - p[sets.first[b]]
        return np.einsum("ij,ij->i", d, d) < limit * limit

    return sets, band_groups(sets, near)


def cell_components(event: np.ndarray, p: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points of any number of events -> (order, cell of each ordered point, root cell of each cell): groups of the bands, completed exactly."""
    if not len(p):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sets, group = _hit_groups(event, p, limit)
    side = limit / math.sqrt(3) * (1 - 1e-9)
    c = np.floor(p / side)
    e = np.unique(event, return_inverse=True)[1]
    low = c.min(0) - 2
    width = c.max(0) - low + 3
    if float(width[0]) * width[1] * width[2] * (e.max() + 1) < 2**62:
        c = (c - low).astype(np.int64)
        span = width.astype(np.int64)
    else:  # far-flung coordinates: only gaps of up to two cells matter, so larger ones close up
        packed = []
        for k in range(3):
            u, inv = np.unique(c[:, k], return_inverse=True)
            packed.append((2 + np.r_[0, np.cumsum(np.minimum(np.diff(u), 3))]).astype(np.int64)[inv])
        c = np.stack(packed, 1)
        span = c.max(0) + 3
    strides = np.array([span[1] * span[2], span[2], 1])
    key = e * (span[0] * span[1] * span[2]) + c @ strides
    order = np.argsort(key, kind="stable")
    key, q = key[order], p[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    cells, size = key[start], np.diff(np.r_[start, len(key)])
    cell = np.repeat(np.arange(len(cells)), size)
    lo, hi = np.minimum.reduceat(q, start), np.maximum.reduceat(q, start)
    # Cells with points of one group are one; a cell's diagonal is below the limit, so all of its points belong together.
    of = group[sets.of][order]
    some = np.zeros(len(sets), np.int64)
    some[of] = cell
    parent = _hook(np.arange(len(cells)), cell, some[of])
    steps = [(x, y, z) for x in range(-2, 3) for y in range(-2, 3) for z in range(-2, 3) if (x, y, z) > (0, 0, 0)]
    for step in sorted(steps, key=lambda s: sum(v * v for v in s)):
        want = cells + int(np.dot(step, strides))
        at = np.searchsorted(cells, want)
        at[at == len(cells)] = 0
        a = np.flatnonzero(cells[at] == want)
        b = at[a]
        apart = parent[a] != parent[b]
        a, b = a[apart], b[apart]
        if a.size:
            gap = np.maximum(np.maximum(lo[b] - hi[a], lo[a] - hi[b]), 0)
            close = np.einsum("ij,ij->i", gap, gap) < limit * limit
            a, b = a[close], b[close]
        for i in range(0, len(a), 1 << 16):
            x, y = a[i : i + (1 << 16)], b[i : i + (1 << 16)]
            hit = _linked(q, start, size, lo, hi, x, y, limit)
            parent = _hook(parent, x[hit], y[hit])
    return order, cell, _roots(parent)


def _np(col) -> np.ndarray:
    return array(col).to_numpy(zero_copy_only=False)


def _points(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks (copies among them) -> event, block_no, pos and coordinates of the hits with all three."""
    e, b, a = (_np(t.column(c)) for c in ("event_id", "block_no", "arrival"))
    order = np.lexsort((a, b, e))
    ee, bb = e[order], b[order]
    t = t.take(pa.array(order[np.r_[True, (ee[1:] != ee[:-1]) | (bb[1:] != bb[:-1])][: len(order)]]))
    lists = [array(t.column(c)) for c in "xyz"]
    sizes = [list_lengths(c) for c in lists]
    n, cols = zip_lists(lists, sizes)
    p = np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) if c.null_count == 0 else c.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in cols], 1)
    row = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    ok = np.isfinite(p).all(1)
    return _np(t.column("event_id"))[row[ok]], _np(t.column("block_no"))[row[ok]].astype(np.int64), pos[ok], p[ok]


def _cluster_events(limit: float, least: int, t: pa.Table) -> pa.Table:
    """Whole events -> members of their clusters."""
    event, block, pos, p = _points(t)
    order, cell, root = cell_components(event, p, limit)
    event, block, pos, label = event[order], block[order], pos[order], root[cell]
    key = (block << 32) | pos
    n = np.bincount(label, minlength=len(root))
    first = np.full(len(root), np.iinfo(np.int64).max)
    np.minimum.at(first, label, key)
    keep = n[label] >= least
    f = first[label[keep]]
    ints = [pa.array(v.astype(np.int32)) for v in (f >> 32, f & 0xFFFFFFFF, block[keep], pos[keep])]
    return pa.Table.from_arrays([pa.array(event[keep]), *ints, pa.array(n[label[keep]].astype(np.int64))], [c.split()[0] for c in MEMBERS.split(", ")])


_TILE_OUT = "event_id bigint, point bigint, label bigint, is_link boolean"


def _cluster_tile(limit: float, t: pa.Table) -> pa.Table:
    """One tile with its margin -> labels of the tile's own hits, and links (cell, label) of the cells that other tiles see too."""
    event, point, own, shared = (_np(t.column(c)) for c in ("event_id", "point", "own", "shared"))
    p = np.stack([_np(t.column(c)) for c in "xyz"], 1)
    order, cell, root = cell_components(event, p, limit)
    event, point, own, shared = event[order], point[order], own[order], shared[order]
    name = np.full(len(root), np.iinfo(np.int64).max)  # a cell is named by its first hit; every tile that sees a cell sees all of it
    np.minimum.at(name, cell, point)
    label = np.full(len(root), np.iinfo(np.int64).max)
    np.minimum.at(label, root, name)
    label = label[root]
    of = np.flatnonzero(own)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]][: len(cell)])
    link = first[shared[first] & (name[cell[first]] != label[cell[first]])]
    cols = [np.r_[event[of], event[link]], np.r_[point[of], name[cell[link]]], np.r_[label[cell[of]], label[cell[link]]], np.r_[np.zeros(len(of), bool), np.ones(len(link), bool)]]
    return pa.Table.from_arrays([pa.array(c) for c in cols], ["event_id", "point", "label", "is_link"])


_CELLS = [f"c{c}" for c in "xyz"]


def _flat_points(blocks: DataFrame, limit: float) -> DataFrame:
    """``event_id, point, x, y, z`` and the cell of every hit with all coordinates, copies once."""
    side = limit / math.sqrt(3) * (1 - 1e-9)
    once = blocks.groupBy("event_id", "block_no").agg(F.min_by(F.struct("x", "y", "z"), "arrival").alias("b"))
    empty = lambda c: F.coalesce(F.col(f"b.{c}"), F.array()).alias(c)
    hits = once.select("event_id", "block_no", F.posexplode(F.arrays_zip(*[empty(c) for c in "xyz"])).alias("pos", "h"))
    point = F.shiftleft(F.col("block_no").cast("bigint"), 32).bitwiseOR(F.col("pos").cast("bigint")).alias("point")
    there = F.lit(True)
    for c in "xyz":
        there = there & F.col(f"h.{c}").isNotNull() & (F.abs(f"h.{c}") < float("inf"))  # NaN is above infinity
    return hits.where(there).select("event_id", point, *[F.col(f"h.{c}").alias(c) for c in "xyz"], *[F.floor(F.col(f"h.{c}") / side).alias(f"c{c}") for c in "xyz"])


def _edges(hits: DataFrame, most_hits: int, ws: Workspace) -> DataFrame:
    """``event_id, edge``: the largest tile edge at which no tile of the event has too many hits."""
    counts, best = hits.select("event_id", *[F.floor(F.col(f"c{c}") / TILES[-1]).alias(f"t{c}") for c in "xyz"]).groupBy("event_id", "tx", "ty", "tz").agg(F.count(F.lit(1)).alias("n")), F.lit(TILES[-1])
    level = counts.select("event_id").distinct()
    for edge in reversed(TILES[:-1]):
        f = edge // TILES[-1]
        most = counts.groupBy("event_id", *[F.floor(F.col(f"t{c}") / f).alias(f"u{c}") for c in "xyz"]).agg(F.sum("n").alias("n")).groupBy("event_id").agg((F.max("n") <= most_hits).alias(f"fits{edge}"))
        best = F.when(F.col(f"fits{edge}"), edge).otherwise(best)
        level = level.join(most, "event_id")
    return ws.write(level.select("event_id", best.cast("bigint").alias("edge")))


def _tiles(hits: DataFrame, edges: DataFrame, below: int, above: int):
    """Hits by tile. A hit also goes to the tile below (above) where it is within so many cells of that border; ``own`` tells its tile proper, ``shared`` that the tile below sees it too."""
    tiled = hits.join(edges, "event_id")
    shared = F.lit(False)
    for c in "xyz":
        tiled = tiled.withColumn(f"t{c}", F.floor(F.col(f"c{c}") / F.col("edge"))).withColumn(f"m{c}", F.col(f"c{c}") - F.col(f"t{c}") * F.col("edge"))
        shared = shared | (F.col(f"m{c}") < below)
        beside = F.array(F.lit(0), F.when(F.col(f"m{c}") < below, -1), F.when(F.col(f"m{c}") >= F.col("edge") - above, 1))
        tiled = tiled.withColumn(f"d{c}", F.explode(F.array_compact(beside)))
    own = (F.col("dx") == 0) & (F.col("dy") == 0) & (F.col("dz") == 0)
    return tiled.select("event_id", *[(F.col(f"t{c}") + F.col(f"d{c}")).alias(f"t{c}") for c in "xyz"], "point", *"xyz", own.alias("own"), shared.alias("shared")).groupBy("event_id", "tx", "ty", "tz")


def _parts(c: str) -> tuple[Column, Column]:
    """block_no and pos of a point."""
    return F.shiftright(c, 32).cast("int"), F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def _large_events(hits: DataFrame, edges: DataFrame, limit: float, least: int, ws: Workspace) -> DataFrame:
    """The same for events that are too large for a task, by tiles: two cells within two of each other meet in a tile. ``event_id, point, first, n_members``."""
    out = ws.write(_tiles(hits, edges, 2, 0).applyInArrow(lambda t: _cluster_tile(limit, t), _TILE_OUT))
    links = out.where("is_link").select(F.col("event_id").alias("g"), F.col("point").alias("u"), F.col("label").alias("v"))
    roots = components(links, ws).select(F.col("g").alias("event_id"), F.col("vertex").alias("label"), "root")
    labels = out.where("not is_link").groupBy("event_id", "label").agg(F.count(F.lit(1)).alias("n"), F.min("point").alias("first"))
    named = ws.write(labels.join(roots, ["event_id", "label"], "left").select("event_id", "label", "n", "first", F.coalesce("root", "label").alias("root")))
    whole = named.groupBy("event_id", "root").agg(F.sum("n").alias("n_members"), F.min("first").alias("first")).where(F.col("n_members") >= least)
    final = named.select("event_id", "label", "root").join(whole, ["event_id", "root"]).select("event_id", "label", "first", "n_members")
    return out.where("not is_link").join(final, ["event_id", "label"]).select("event_id", "point", "first", "n_members")


class _Events:
    """Blocks of calo_hits, whole events in buckets or, beyond ``most_hits``, their hits in tiles."""

    def __init__(self, calo_hits: DataFrame, limit: float, bucket_bytes: int, most_hits: int):
        self.ws = Workspace(calo_hits.sparkSession)
        arrival = F.coalesce(F.unix_micros("ingested_at"), F.lit(2**63 - 1)).alias("arrival")
        blocks = calo_hits.where("event_id is not null and block_no is not null").select("event_id", "block_no", arrival, "x", "y", "z")
        n = pieces(calo_hits.select("event_id", "block_no", "x", "y", "z"), bucket_bytes, 8)
        # Events above the bound (counted with copies): at most (all hits) / most_hits rows.
        large = self.ws.write(blocks.groupBy("event_id").agg(F.sum(F.coalesce(F.array_size("x"), F.lit(0))).alias("n")).where(F.col("n") > most_hits).select("event_id"))
        self.any_large = not large.isEmpty()
        self.small = _in_buckets(blocks.join(large, "event_id", "left_anti") if self.any_large else blocks, n)
        if self.any_large:
            self.hits = self.ws.write(_flat_points(blocks.join(large, "event_id", "left_semi"), limit))
            self.edges = _edges(self.hits, most_hits, self.ws)


def _in_buckets(df: DataFrame, n: int):
    """Whole events in ``n`` buckets, which as many tasks read."""
    return df.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(n)).cast("int")).repartition(n, "bucket").groupBy("bucket")


def hit_clusters(calo_hits: DataFrame, limit: float = HIT_LIMIT, least: int = HIT_LEAST, bucket_bytes: int = BUCKET_BYTES, most_hits: int = MOST_HITS) -> DataFrame:
    """Members of the clusters of hits: ``event_id, first_block_no, first_pos, block_no, pos, n_members``.

    Two hits of an event nearer than ``limit`` are in one cluster, and clusters are as fine as that allows; those with fewer than ``least`` members are left out. A hit without all of x, y, z (null, NaN, infinite
    or beyond the end of a list) is in no cluster. Copies of a block count once; equal positions are at distance 0; rows without event_id or block_no are left out; empty tables give no rows.
    """
    e = _Events(calo_hits, limit, bucket_bytes, most_hits)
    out = e.small.applyInArrow(lambda t: _cluster_events(limit, least, t), MEMBERS)
    if not e.any_large:
        return out
    (fb, fp), (b, p) = _parts("first"), _parts("point")
    return out.unionByName(_large_events(e.hits, e.edges, limit, least, e.ws).select("event_id", fb.alias("first_block_no"), fp.alias("first_pos"), b.alias("block_no"), p.alias("pos"), "n_members"))


def _bin_groups(event: np.ndarray, lo: np.ndarray, hi: np.ndarray, limit: float) -> tuple[Shingles, np.ndarray, np.ndarray]:
    """Bins in the order of event and angle -> (their shingles, their groups by banding, their groups completed)."""
    # Two linked bins start less than two limits apart, as a bin is narrower than the limit.
    sets = Shingles(event, lo[:, None] + math.pi, 2 * limit, 2 * math.pi)

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = sets.first[a], sets.first[b]
        x, y = np.where(lo[x] <= lo[y], x, y), np.where(lo[x] <= lo[y], y, x)
        return (lo[y] - hi[x] < limit) | (lo[x] + 2 * math.pi - hi[y] < limit)

    banded = band_groups(sets, near)[sets.of]
    # Bins of one set start so near to each other that they are linked.
    group = np.arange(len(event))
    some = np.zeros(len(sets), np.int64)
    some[banded] = group
    group = _hook(group, group.copy(), some[banded])
    same = np.flatnonzero(event[1:] == event[:-1])
    same = same[lo[same + 1] - hi[same] < limit]
    group = _hook(group, same, same + 1)
    ends = np.flatnonzero(np.r_[True, event[1:] != event[:-1], True][: len(event) + 1]) if len(event) else np.zeros(1, np.int64)
    a, b = ends[:-1], ends[1:] - 1
    round_ = lo[a] + 2 * math.pi - hi[b] < limit
    return sets, banded, _hook(group, a[round_], b[round_])


def _cluster_bins(limit: float, least: int, t: pa.Table) -> pa.Table:
    """Bins of whole events -> size and first member of the cluster of each, where it has ``least`` members."""
    t = t.take(pa.array(np.lexsort((_np(t.column("bin")), _np(t.column("event_id"))))))
    event, lo, hi, n, first = (_np(t.column(c)) for c in ("event_id", "lo", "hi", "n", "first"))
    group = _bin_groups(event, lo, hi, limit)[2]
    total, lowest = np.zeros(len(event), np.int64), np.full(len(event), np.iinfo(np.int64).max)
    np.add.at(total, group, n)
    np.minimum.at(lowest, group, first)
    keep = pa.array(np.flatnonzero(total[group] >= least))
    cols = [t.column("event_id"), t.column("bin"), pa.array(total[group]), pa.array(lowest[group])]
    return pa.Table.from_arrays([c.take(keep) for c in cols], ["event_id", "bin", "n_members", "first"])


def _binned(tracks: DataFrame, limit: float) -> tuple[DataFrame, GroupedData]:
    """Tracks with their angle brought into [-pi, pi], and their bins, whole events in buckets."""
    turn, width = 2 * math.pi, limit * (1 - 1e-9)
    arrival = F.coalesce(F.unix_micros("ingested_at"), F.lit(2**63 - 1))
    once = tracks.where("event_id is not null and block_no is not null").groupBy("event_id", "block_no").agg(F.min_by("phi", arrival).alias("phi"))
    inner = F.when(F.abs("phi") <= math.pi, F.col("phi")).otherwise(F.pmod(F.col("phi") + math.pi, F.lit(turn)) - math.pi)
    each = once.select("event_id", "block_no", F.posexplode("phi").alias("pos", "phi")).where(F.col("phi").isNotNull() & (F.abs("phi") < float("inf")))
    each = each.select("event_id", F.shiftleft(F.col("block_no").cast("bigint"), 32).bitwiseOR(F.col("pos").cast("bigint")).alias("point"), inner.alias("phi")).withColumn("bin", F.floor((F.col("phi") + math.pi) / width).cast("int"))
    bins = each.groupBy("event_id", "bin").agg(F.min("phi").alias("lo"), F.max("phi").alias("hi"), F.count(F.lit(1)).alias("n"), F.min("point").alias("first"))
    n = pieces(tracks.select("event_id", "block_no", "phi"), BUCKET_BYTES, 8)
    return each, _in_buckets(bins, n)


def _track_members(tracks: DataFrame, limit: float, least: int) -> DataFrame:
    """The columns of track_clusters and each member's ``phi``."""
    each, bins = _binned(tracks, limit)
    final = bins.applyInArrow(lambda t: _cluster_bins(limit, least, t), "event_id bigint, bin int, n_members bigint, first bigint")
    (fb, fp), (b, p) = _parts("first"), _parts("point")
    return each.join(final, ["event_id", "bin"]).select("event_id", fb.alias("first_block_no"), fp.alias("first_pos"), b.alias("block_no"), p.alias("pos"), "n_members", "phi")


def track_clusters(tracks: DataFrame, limit: float = TRACK_LIMIT, least: int = TRACK_LEAST) -> DataFrame:
    """Members of the clusters of tracks by phi, which closes on itself; columns and rules as hit_clusters.

    Angles outside [-pi, pi] are brought in; a track without phi (null, NaN, infinite) is in no cluster. An event has at most 2 pi / limit bins, however many tracks it has.
    """
    return _track_members(tracks, limit, least).drop("phi")


_RECALL = "n_near bigint, n_candidates bigint, n_band_groups bigint, n_clusters bigint"


def _recall_row(near: int, candidates: int, banded: np.ndarray, final: np.ndarray) -> pa.Table:
    pairs = len(np.unique(np.stack([final, banded], 1), axis=0)) if len(final) else 0
    return pa.table({c.split()[0]: pa.array([v], pa.int64()) for c, v in zip(_RECALL.split(", "), (near, candidates, pairs, len(np.unique(final))), strict=True)})


def _hit_recall(limit: float, event: np.ndarray, key: np.ndarray, p: np.ndarray, own: np.ndarray) -> pa.Table:
    sets, group = _hit_groups(event, p, limit)
    ask = np.unique(sets.of[own & (((key >> 32) + (key & 0xFFFFFFFF)) % 100 == 0)])
    near = []
    for a, b in sets.around(ask, FINE + 1):
        d = p[sets.first[a]] - p[sets.first[b]]
        close = np.einsum("ij,ij->i", d, d) < limit * limit
        near.append(np.stack([a[close], b[close]]))
    a, b = np.concatenate(near, 1) if near else np.zeros((2, 0), np.int64)
    order, cell, root = cell_components(event, p, limit)
    return _recall_row(len(a), int(sets.share_a_bucket(a, b).sum()), group[sets.of][order], root[cell])


def _track_recall(limit: float, t: pa.Table) -> pa.Table:
    t = t.take(pa.array(np.lexsort((_np(t.column("bin")), _np(t.column("event_id"))))))
    event, lo, hi = (_np(t.column(c)) for c in ("event_id", "lo", "hi"))
    sets, banded, group = _bin_groups(event, lo, hi, limit)
    k = np.flatnonzero((event[1:] == event[:-1]) & (lo[1:] - hi[:-1] < limit))
    a, b = sets.of[k], sets.of[k + 1]
    return _recall_row(len(k), int(((a == b) | sets.share_a_bucket(a, b)).sum()), banded, group)


def band_recall(calo_hits: DataFrame, tracks: DataFrame, limit: float = HIT_LIMIT, track_limit: float = TRACK_LIMIT, bucket_bytes: int = BUCKET_BYTES, most_hits: int = MOST_HITS) -> DataFrame:
    """What the bands find by themselves: ``record_kind, n_near, n_candidates, recall, n_band_groups, n_clusters``.

    n_near: pairs of near records, found by brute force over neighbouring cells (hits: for every hit whose block_no + pos is divisible by 100, against all hits of its event or tile; tracks: all pairs of neighbouring bins);
    n_candidates: those that share a bucket in a band; recall is their share, null if there is no pair. n_band_groups: groups that bands, Jaccard and distance make of the n_clusters completed ones (of any size).
    """
    e = _Events(calo_hits, limit, bucket_bytes, most_hits)

    def events(t: pa.Table) -> pa.Table:
        event, block, pos, p = _points(t)
        return _hit_recall(limit, event, (block << 32) | pos, p, np.ones(len(event), bool))

    def tile(t: pa.Table) -> pa.Table:
        return _hit_recall(limit, _np(t.column("event_id")), _np(t.column("point")), np.stack([_np(t.column(c)) for c in "xyz"], 1), _np(t.column("own")).astype(bool))

    hits = e.small.applyInArrow(lambda t: events(t), _RECALL)
    if e.any_large:
        hits = hits.unionByName(_tiles(e.hits, e.edges, 2, 0).applyInArrow(lambda t: tile(t), _RECALL))
    of_tracks = _binned(tracks, track_limit)[1].applyInArrow(lambda t: _track_recall(track_limit, t), _RECALL)
    both = hits.withColumn("record_kind", F.lit("hit")).unionByName(of_tracks.withColumn("record_kind", F.lit("track")))
    sums = [F.sum(c.split()[0]).alias(c.split()[0]) for c in _RECALL.split(", ")]
    return both.groupBy("record_kind").agg(*sums).select("record_kind", "n_near", "n_candidates", F.try_divide("n_candidates", "n_near").alias("recall"), "n_band_groups", "n_clusters")


_PEAKS = "event_id bigint, point bigint, base bigint, up bigint, n_links bigint"


def _peaks(event: np.ndarray, key: np.ndarray, p: np.ndarray, limit: float, similar: float) -> tuple[Shingles, np.ndarray, np.ndarray, np.ndarray]:
    """(sets, first hit of each, links of each, the set that each points to). A set points to the one of most links among those of a Jaccard of at least ``similar`` and itself; of equally many links that with the first hit."""
    sets = Shingles(event, p, limit)
    # Only sums of gaps decide a Jaccard as long as no single gap exceeds a window.
    apart = int(3 * WIDTH * (1 - similar) / (1 + similar) + 1e-9)
    base = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(base, sets.of, key)
    own = np.bincount(sets.of, minlength=len(sets))
    links = own.copy()
    for a, b in sets.neighbours(apart):
        np.add.at(links, a, own[b])
        np.add.at(links, b, own[a])
    order = np.lexsort((base, -links))
    rank = np.empty(len(sets), np.int64)
    rank[order] = np.arange(len(sets))
    best = rank.copy()
    for a, b in sets.neighbours(apart):
        np.minimum.at(best, a, rank[b])
        np.minimum.at(best, b, rank[a])
    return sets, base, links, order[best]


def _peak_table(event, key, sets, base, links, up, keep) -> pa.Table:
    of = sets.of[keep]
    return pa.Table.from_arrays([pa.array(v) for v in (event[keep], key[keep], base[of], base[up[of]], links[of])], [c.split()[0] for c in _PEAKS.split(", ")])


GROUPS = "event_id, first_block_no, first_pos, n_members, medoid_block_no, medoid_pos, n_links, n_group"


def medoid_groups(calo_hits: DataFrame, limit: float = HIT_LIMIT, least: int = HIT_LEAST, similar: float = SIMILAR, bucket_bytes: int = BUCKET_BYTES, most_hits: int = MOST_HITS) -> DataFrame:
    """Clusters of hits described by size and medoids, loose ones split around them: ``event_id, first_block_no, first_pos, n_members, medoid_block_no, medoid_pos, n_links, n_group``.

    Two hits are linked if the exact Jaccard of their shingles is at least ``similar`` (which puts them well within the limit). Hits of one fine cell have one set; each set points to the linked one of most links, and where that
    chain ends is a medoid, named by its first hit. A cluster whose hits all point to one medoid stays whole; a loose one has a row for each of its medoids with the n_group hits around it. The n_group of a cluster sum up to
    n_members; hits without a position and clusters below ``least`` are left out as in hit_clusters. Copies count once; empty tables give no rows.
    """
    e = _Events(calo_hits, limit, bucket_bytes, most_hits)

    def events(t: pa.Table) -> pa.Table:
        event, block, pos, p = _points(t)
        key = (block << 32) | pos
        sets, base, links, up = _peaks(event, key, p, limit, similar)
        top = _roots(up)
        order, cell, root = cell_components(event, p, limit)
        label = np.empty(len(event), np.int64)
        label[order] = root[cell]
        n, first = np.bincount(label, minlength=len(root)), np.full(len(root), np.iinfo(np.int64).max)
        np.minimum.at(first, label, key)
        group = top[sets.of]  # linked hits are near, so a medoid's hits are in its cluster
        size = np.bincount(group, minlength=len(sets))
        tops = np.flatnonzero(size)
        mine = label[sets.first[tops]]
        tops, mine = tops[n[mine] >= least], mine[n[mine] >= least]
        cols = [event[sets.first[tops]], first[mine] >> 32, first[mine] & 0xFFFFFFFF, n[mine], base[tops] >> 32, base[tops] & 0xFFFFFFFF, links[tops], size[tops]]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)).cast(k) for c, k in zip(cols, kinds, strict=True)], GROUPS.split(", "))

    ddl = "event_id bigint, first_block_no int, first_pos int, n_members bigint, medoid_block_no int, medoid_pos int, n_links bigint, n_group bigint"
    out = e.small.applyInArrow(lambda t: events(t), ddl)
    if not e.any_large:
        return out

    def tile(t: pa.Table) -> pa.Table:
        event, key, p = _np(t.column("event_id")), _np(t.column("point")), np.stack([_np(t.column(c)) for c in "xyz"], 1)
        return _peak_table(event, key, *_peaks(event, key, p, limit, similar), np.flatnonzero(_np(t.column("own"))))

    # Links of a hit's partners reach two Jaccard steps, which three cells of margin hold.
    hits = e.ws.write(_tiles(e.hits, e.edges, 3, 3).applyInArrow(lambda t: tile(t), _PEAKS))
    steps = hits.select("event_id", "base", "up", "n_links").distinct()
    roots = components(steps.where("base <> up").select(F.col("event_id").alias("g"), F.col("base").alias("u"), F.col("up").alias("v")), e.ws).select(F.col("g").alias("event_id"), F.col("vertex").alias("base"), "root")
    named = e.ws.write(steps.join(roots, ["event_id", "base"], "left").withColumn("root", F.coalesce("root", "base")))
    medoids = named.where("base = up").select("event_id", "root", F.col("base").alias("medoid"), "n_links")
    members = _large_events(e.hits, e.edges, limit, least, e.ws)
    of = hits.select("event_id", "point", "base").join(named.select("event_id", "base", "root"), ["event_id", "base"]).join(members, ["event_id", "point"])
    sizes = of.groupBy("event_id", "root", "first", "n_members").agg(F.count(F.lit(1)).alias("n_group")).join(medoids, ["event_id", "root"])
    (fb, fp), (mb, mp) = _parts("first"), _parts("medoid")
    return out.unionByName(sizes.select("event_id", fb.alias("first_block_no"), fp.alias("first_pos"), "n_members", mb.alias("medoid_block_no"), mp.alias("medoid_pos"), "n_links", "n_group"))


def found(calo_hits: DataFrame, tracks: DataFrame, **tuning) -> DataFrame:
    """``record_kind, event_id, first_block_no, first_pos, block_no, pos``: every member of a cluster with the cluster's first member."""
    cols = ["event_id", "first_block_no", "first_pos", "block_no", "pos"]
    kind = lambda df, k: df.select(F.lit(k).alias("record_kind"), *cols)
    return kind(hit_clusters(calo_hits, **tuning), "hit").unionByName(kind(track_clusters(tracks), "track"))


def typical_hits(calo_hits: DataFrame, k: int = 3, salts: int = 64, **tuning) -> DataFrame:
    """Each cluster of hits by size, mean position and its ``k`` most typical members, nearest to the mean first (ties: by block_no, pos).

    ``event_id, first_block_no, first_pos, n_members, rank, block_no, pos``. Positions are compared on means rounded to 1e-6 mm, so the order of summing does not matter.
    """
    ws = Workspace(calo_hits.sparkSession)
    members = hit_clusters(calo_hits, **tuning)
    arrival = F.coalesce(F.unix_micros("ingested_at"), F.lit(2**63 - 1))
    once = calo_hits.where("event_id is not null and block_no is not null").groupBy("event_id", "block_no").agg(F.min_by(F.struct("x", "y", "z"), arrival).alias("b"))
    # One row per block with its members as a list: the join is by block, which no hot event skews.
    per_block = members.groupBy("event_id", "block_no").agg(F.collect_list(F.struct("pos", "first_block_no", "first_pos", "n_members")).alias("m"))
    placed = per_block.join(once, ["event_id", "block_no"]).select("event_id", "block_no", "b", F.explode("m").alias("m"))
    placed = ws.write(placed.select("event_id", "m.first_block_no", "m.first_pos", "m.n_members", "block_no", "m.pos", *[F.get(F.col(f"b.{c}"), F.col("m.pos")).alias(c) for c in "xyz"]))
    cluster = ["event_id", "first_block_no", "first_pos"]
    means = placed.groupBy(*cluster).agg(*[F.round(F.avg(c), 6).alias(f"a{c}") for c in "xyz"])
    d2 = sum(((F.col(c) - F.col(f"a{c}")) * (F.col(c) - F.col(f"a{c}")) for c in "xyz"), F.lit(0.0))
    return _nearest(placed.join(means, cluster), F.round(d2, 4), k, salts)


def typical_tracks(tracks: DataFrame, k: int = 3, salts: int = 64, limit: float = TRACK_LIMIT, least: int = TRACK_LEAST) -> DataFrame:
    """Each cluster of tracks by size and its ``k`` most typical members, nearest to the mean of phi the short way round first (ties: by block_no, pos).

    Columns as typical_hits. The mean is that of directions (atan2 of the sums of sines and cosines); both are summed as whole 1e-9, so the order of summing does not matter, and distances are compared to 1e-9 rad.
    Where the directions of a cluster cancel out there is no mean, and 0 stands for it.
    """
    ws = Workspace(tracks.sparkSession)
    members = ws.write(_track_members(tracks, limit, least))
    cluster = ["event_id", "first_block_no", "first_pos"]
    units = lambda c: F.sum(F.floor(c * 1e9 + 0.5).cast("bigint"))
    means = members.groupBy(*cluster).agg(F.atan2(units(F.sin("phi")), units(F.cos("phi"))).alias("mean"))
    apart = F.abs(F.col("phi") - F.col("mean"))
    return _nearest(members.join(means, cluster), F.round(F.least(apart, 2 * math.pi - apart), 9), k, salts)


def _nearest(members: DataFrame, distance: Column, k: int, salts: int) -> DataFrame:
    """The ``k`` members of least distance of each cluster, with their rank."""
    cluster = ["event_id", "first_block_no", "first_pos"]
    ranked = members.select(*cluster, "n_members", F.pmod(F.xxhash64("block_no", "pos"), F.lit(salts)).alias("salt"), F.struct(distance.alias("d"), "block_no", "pos").alias("s"))
    top = lambda df, keys: df.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("s"))).where(F.col("r") <= k)
    # The best of each salt first, then the best of those: no cluster is sorted in one task.
    best = top(top(ranked, [*cluster, "salt"]).drop("r"), cluster)
    return best.select(*cluster, "n_members", F.col("r").alias("rank"), "s.block_no", "s.pos")
