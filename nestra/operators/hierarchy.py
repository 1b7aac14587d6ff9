"""Parent-child links to full hierarchies by bottom-up leaf peeling.

Leaves are peeled round by round; a peeled node sends its subtree size to its parent and the peel order is kept. What is never peeled lies on a cycle. In reverse peel order (roots first)
every node takes root and depth from its parent and a place in one shared pre-order, in which the descendants of a node are the slice right behind it: a
descendant list is sent upwards as the bounds of that slice and copied out once.

Events are independent, so whole events are hashed into buckets of bounded size and each bucket is peeled by vectorised rounds. An event with more particles than ``MOST_NODES`` never meets
in one task: it is peeled by DataFrame rounds, with the same results. There a round peels all leaves and then also takes out single children in between (of a chain about every fourth node), so the number of
rounds grows with the logarithm of the particles, not with the depth; on a cycle that ends with a link of one node to itself.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestra.runtime import Workspace, pieces

BUCKET_BYTES = 4 << 20  # of compressed input in a bucket, about
MOST_NODES = 1 << 20  # particles of an event that are peeled in one task
LIST_MOST = 100_000  # descendants in one row; a node with more has several rows (parts)

LINEAGE = "event_id bigint, particle_id bigint, parent_id bigint, root_id bigint, depth int, on_cycle boolean, n_descendants bigint, path array<bigint>, part int, descendants array<bigint>"
PATHS = "event_id bigint, particle_id bigint, parent_id bigint, root_id bigint, depth int, on_cycle boolean, n_descendants bigint, path array<bigint>"
SLIM = "event_id bigint, particle_id bigint, parent_id bigint, root_id bigint, depth int, on_cycle boolean, n_descendants bigint"


class Forest:
    """Nodes of any number of events, peeled. Arrays are in the order of (event, id); ``parent`` is an index or -1."""

    def __init__(self, event: np.ndarray, ident: np.ndarray, parent_id: np.ndarray, has_parent: np.ndarray, mark: np.ndarray | None = None, peel: bool = True):
        order = np.lexsort((ident, event))
        event, ident, parent_id, has_parent = event[order], ident[order], parent_id[order], has_parent[order]
        keep = np.r_[True, (event[1:] != event[:-1]) | (ident[1:] != ident[:-1])][: len(event)]
        self.mark = None if mark is None else mark[order][keep]
        self.event, self.ident = event[keep], ident[keep]
        parent_id, has_parent = parent_id[keep], has_parent[keep]
        n = self.n = len(self.event)
        lo, hi = np.searchsorted(self.event, self.event, "left"), np.searchsorted(self.event, self.event, "right")
        end = hi.copy()
        while (k := np.flatnonzero(lo < hi)).size:  # binary search for the parent within the event
            mid = (lo[k] + hi[k]) // 2
            low = self.ident[mid] < parent_id[k]
            lo[k], hi[k] = np.where(low, mid + 1, lo[k]), np.where(low, hi[k], mid)
        ok = has_parent & (parent_id != 0) & (parent_id != self.ident) & (lo < end)
        ok[ok] = self.ident[lo[ok]] == parent_id[ok]
        self.parent = np.where(ok, lo, -1)
        if peel:
            self._peel()
            self._descend()

    def find(self, event: np.ndarray, ident: np.ndarray) -> np.ndarray:
        """The index of each (event, id), -1 if it is no node."""
        lo, hi = np.searchsorted(self.event, event, "left"), np.searchsorted(self.event, event, "right")
        end = hi.copy()
        while (k := np.flatnonzero(lo < hi)).size:
            mid = (lo[k] + hi[k]) // 2
            low = self.ident[mid] < ident[k]
            lo[k], hi[k] = np.where(low, mid + 1, lo[k]), np.where(low, hi[k], mid)
        there = lo < end
        there[there] = self.ident[lo[there]] == ident[there]
        return np.where(there, lo, -1)

    def _peel(self) -> None:
        n, parent = self.n, self.parent
        children = np.bincount(parent[parent >= 0], minlength=n)
        self.size, self.rounds, gone = np.ones(n, np.int64), [], np.zeros(n, bool)
        leaves = np.flatnonzero(children == 0)
        while leaves.size:
            self.rounds.append(leaves)
            gone[leaves] = True
            up = leaves[parent[leaves] >= 0]
            to = parent[up]
            np.add.at(self.size, to, self.size[up])
            np.subtract.at(children, to, 1)
            to = np.unique(to)
            leaves = to[(children[to] == 0) & ~gone[to]]
        self.on_cycle = ~gone

    def _descend(self) -> None:
        n, parent = self.n, self.parent
        self.depth, self.root = np.zeros(n, np.int64), np.arange(n)
        cyc = np.flatnonzero(self.on_cycle)
        if cyc.size:  # the smallest id of each cycle, by doubling the step
            low, step = np.arange(n), parent.copy()  # indices are in the order of ids within an event
            reach = 1
            while reach < cyc.size:
                low[cyc] = np.minimum(low[cyc], low[step[cyc]])
                step[cyc] = step[step[cyc]]
                reach *= 2
            low[cyc] = np.minimum(low[cyc], low[step[cyc]])
            self.root[cyc], self.depth[cyc] = low[cyc], -1
        # Pre-order: tops (roots and nodes on cycles) one after another, children one after another behind their parent.
        is_top = (parent < 0) | self.on_cycle
        tops = np.flatnonzero(is_top)
        span = self.size.copy()
        if cyc.size:
            # On a cycle only what was peeled hangs below a node here; peeling never sent sizes along cycle links.
            span[cyc] = self.size[cyc]
        self.place = np.zeros(n, np.int64)
        self.place[tops] = np.r_[0, np.cumsum(span[tops])[:-1]] if tops.size else 0
        child = np.flatnonzero(~is_top)
        order = child[np.lexsort((child, parent[child]))]
        before = np.zeros(n, np.int64)
        if order.size:
            run = np.cumsum(span[order]) - span[order]
            start = np.r_[True, parent[order][1:] != parent[order][:-1]]
            before[order] = run - np.repeat(run[start], np.diff(np.r_[np.flatnonzero(start), len(order)]))
        for level in reversed(self.rounds):
            k = level[~is_top[level]]
            p = parent[k]
            self.place[k] = self.place[p] + 1 + before[k]
            self.root[k] = self.root[p]
            self.depth[k] = np.where(self.depth[p] < 0, -1, self.depth[p] + 1)
        self.preorder = np.empty(n, np.int64)
        self.preorder[self.place] = np.arange(n)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, flat ids) of the paths from the root to each node; none where no root is reached."""
        length = np.where(self.depth < 0, 0, self.depth + 1)
        end = np.cumsum(length)
        flat, at, node = np.empty(int(end[-1]) if self.n else 0, np.int64), end - 1, np.arange(self.n)
        live = np.flatnonzero(length > 0)
        k = 0
        while live.size:
            flat[at[live] - k] = self.ident[node[live]]
            k += 1
            live = live[length[live] > k]
            node[live] = self.parent[node[live]]
        return length, flat


def _forest(t: pa.Table, peel: bool = True) -> Forest:
    """Blocks (copies among them) of whole events -> their forest; of a pair named twice the first by block_no counts. Marks are 1, 0 and -1 for true, false and null."""
    e, b, o, a = (t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("event_id", "block_no", "own", "arrival"))
    order = np.lexsort((a, o, b, e))
    ee, bb, oo = e[order], b[order], o[order]
    order = order[np.r_[True, (ee[1:] != ee[:-1]) | (bb[1:] != bb[:-1]) | (oo[1:] != oo[:-1])][: len(order)]]
    t = t.take(pa.array(order))
    links = t.column("links").combine_chunks()
    n = links.value_lengths().to_numpy(zero_copy_only=False)
    flat = links.flatten()
    ident, parent = flat.field("id").to_numpy(zero_copy_only=False), flat.field("parent")
    event = np.repeat(t.column("event_id").combine_chunks().to_numpy(zero_copy_only=False), n)
    mark = flat.field("mark").cast(pa.int8()).fill_null(-1).to_numpy(zero_copy_only=False) if flat.type.get_field_index("mark") >= 0 else None
    return Forest(event, ident, parent.fill_null(0).to_numpy(zero_copy_only=False), parent.is_valid().to_numpy(zero_copy_only=False), mark, peel)


def _slim(f: Forest) -> list[pa.Array]:
    has = f.parent >= 0
    up = pa.array(np.where(has, f.ident[f.parent], 0), mask=~has) if f.n else pa.array([], pa.int64())
    return [pa.array(f.event), pa.array(f.ident), up, pa.array(f.ident[f.root]), pa.array(f.depth.astype(np.int32)), pa.array(f.on_cycle), pa.array(f.size - 1)]


_NAMES = [c.split()[0] for c in LINEAGE.split(", ")]


def _peel_slim(t: pa.Table) -> pa.Table:
    return pa.Table.from_arrays(_slim(_forest(t)), _NAMES[:7])


def _list(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int64)), pa.array(values)).cast(pa.list_(pa.int64()))


def _peel_paths(t: pa.Table) -> pa.Table:
    f = _forest(t)
    return pa.Table.from_arrays([*_slim(f), _list(*f.paths())], _NAMES[:8])


def _peel_full(list_most: int, t: pa.Table) -> pa.Table:
    f = _forest(t)
    length, flat = f.paths()
    below = f.size - 1
    parts = np.maximum(1, -(-below // list_most))
    row = np.repeat(np.arange(f.n), parts)
    part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    size = np.minimum(list_most, below[row] - part * list_most)
    # All descendants of each node in the order of id (indices are in that order); its parts follow one another.
    owner = np.repeat(np.arange(f.n), below)
    at = f.preorder[np.repeat(f.place + 1 - (np.cumsum(below) - below), below) + np.arange(len(owner))]
    at = at[np.lexsort((at, owner))]
    take = pa.array(row)
    out = [c.take(take) for c in _slim(f)] + [_list(length, flat).take(take), pa.array(part.astype(np.int32)), _list(size, f.ident[at])]
    return pa.Table.from_arrays(out, _NAMES)


def _blocks(particles: DataFrame, mark: Column | None = None) -> DataFrame:
    """``event_id, block_no, own, arrival, links``: id and parent of each particle, with a list of flags as their ``mark``; rows without block_no are told apart by ``own``, a hash of their links."""
    lists = [F.coalesce("particle_id", F.array()).alias("id"), F.coalesce("parent_id", F.array()).alias("parent"), *([mark.alias("mark")] if mark is not None else [])]
    own = F.filter(F.arrays_zip(*lists), lambda p: p["id"].isNotNull())
    arrival = F.coalesce(F.unix_micros("ingested_at"), F.lit(2**63 - 1)).alias("arrival")
    rows = particles.where("event_id is not null").select("event_id", "block_no", arrival, own.alias("links")).where("size(links) > 0")
    apart = F.when(F.col("block_no").isNull(), F.xxhash64("links")).otherwise(F.lit(0)).alias("own")
    return rows.select("event_id", F.coalesce("block_no", F.lit(-(2**31))).alias("block_no"), apart, "arrival", "links")


class _Events:
    """Blocks of particles, whole events in buckets or, beyond ``most_nodes``, apart."""

    def __init__(self, particles: DataFrame, bucket_bytes: int, most_nodes: int, mark: Column | None = None):
        blocks = _blocks(particles, mark)
        self.n = pieces(particles.select("event_id", "particle_id", "parent_id"), bucket_bytes, 8)
        # Only one number per oversize event is kept; there are at most (all particles) / most_nodes of them.
        large = blocks.groupBy("event_id").agg(F.sum(F.size("links")).alias("n")).where(F.col("n") > most_nodes).select("event_id")
        self.oversize = Workspace(particles.sparkSession).write(large)
        self.any_large = not self.oversize.isEmpty()
        self.small = self.in_buckets(self.of_small(blocks))
        self.large = blocks.join(self.oversize, "event_id", "left_semi") if self.any_large else None

    def of_small(self, df: DataFrame) -> DataFrame:
        return df.join(self.oversize, "event_id", "left_anti") if self.any_large else df

    def in_buckets(self, df: DataFrame):
        return df.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(self.n)).cast("int")).repartition(self.n, "bucket").groupBy("bucket")


def lineage(particles: DataFrame, descendants: bool = True, paths: bool = True, bucket_bytes: int = BUCKET_BYTES, most_nodes: int = MOST_NODES, list_most: int = LIST_MOST) -> DataFrame:
    """Root, depth, path and descendants of every particle.

    ``event_id, particle_id, parent_id, root_id, depth, on_cycle, n_descendants, path, part, descendants``; without ``descendants`` the last two are left out, without ``paths`` as well path. parent_id is null unless it is a
    parent: not null, not 0, not the particle's own id, and a particle of the event. path goes from the root to the particle itself. If the parents never end, depth is -1, path is
    empty, root_id is the smallest id of the cycle they come back to, and on_cycle tells its members. Descendants are those below a node, in the order of id, over all parts; for a
    member of a cycle only what hangs below it outside the cycle. A node with more than ``list_most`` descendants has several rows, numbered by ``part``.

    Copies of a block count once; rows without block_no are blocks of their own, first in order; null particle ids are no particles; a pair (event_id, particle_id) named twice counts as its first; lists of different length are padded with nulls;
    rows without event_id are left out; empty tables give no rows.
    """
    schema, kernel = (LINEAGE, partial(_peel_full, list_most)) if descendants else (PATHS, _peel_paths) if paths else (SLIM, _peel_slim)
    e = _Events(particles, bucket_bytes, most_nodes)
    out = e.small.applyInArrow(lambda t: kernel(t), schema)
    return out.unionByName(_lineage_by_rounds(e.large, descendants, paths, list_most)) if e.any_large else out


_KEY = ["event_id", "particle_id"]
_IDS = "array<bigint>"


def _contract(nodes: DataFrame, ws: Workspace) -> tuple[list[tuple[DataFrame, DataFrame | None]], list[DataFrame]]:
    """Peel ``event_id, particle_id, parent_id`` (a parent is there or null) until nothing is left; returns (peeled leaves, taken out) of each round.

    A node that is left has ``up``, what it hangs on now, over ``dist`` links with the nodes ``via`` in between (from above) and the least of them, ``low``; ``acc`` is its own size as far as it has been sent, ``off`` what the nodes
    in between add to it on the way up. ``busy`` counts what still hangs on a node. A link of a node to itself is all that is left of a cycle.
    """
    left = nodes.select(*_KEY, F.col("parent_id").alias("up"), F.lit(1).cast("bigint").alias("acc"), F.lit(0).cast("bigint").alias("off"), F.lit(1).alias("dist"), F.lit(None).cast("bigint").alias("low"), F.array().cast(_IDS).alias("via"))
    state, hangs = ["up", "acc", "off", "dist", "low", "via"], (F.col("up").isNotNull()) & (F.col("up") != F.col("particle_id"))
    below = lambda df, *aggs: df.where(hangs).groupBy("event_id", F.col("up").alias("particle_id")).agg(*aggs)
    coin = lambda c, r: F.pmod(F.xxhash64("event_id", c, F.lit(r)), F.lit(2))
    rounds, r = [], 0
    while True:
        marked, n_left = ws.count(left.select(*_KEY, *state).join(below(left, F.count(F.lit(1)).alias("busy")), _KEY, "left"), "busy is not null")
        leaves = marked.where("busy is null")
        if not n_left:
            rounds.append((leaves, None))
            return rounds
        stay = marked.where("busy is not null").drop("busy")
        sent = below(leaves, F.sum(F.col("acc") + F.col("off")).alias("sent"))
        only = below(stay, F.count(F.lit(1)).alias("children"), F.min("particle_id").alias("child"))
        rest = stay.join(sent, _KEY, "left").join(only, _KEY, "left").withColumn("acc", F.col("acc") + F.coalesce("sent", F.lit(0)))
        out = hangs & (F.col("children") == 1) & (coin("particle_id", r) == 1) & (coin("up", r) == 0)
        rest = ws.write(rest.drop("sent").withColumn("out", F.coalesce(out, F.lit(False))))
        between = rest.where("out").select("event_id", F.col("child").alias("particle_id"), F.struct(F.col("particle_id").alias("id"), *state).alias("b"))
        kept = rest.where("not out").select(*_KEY, *state).join(between, _KEY, "left")
        new = {
            "up": F.col("b.up"), "acc": F.col("acc"), "off": F.col("off") + F.col("b.acc") + F.col("b.off"), "dist": F.col("dist") + F.col("b.dist"), "low": F.least("low", "b.id", "b.low"),
            "via": F.concat("b.via", F.array("b.id"), "via"),
        }
        kept = kept.select(*_KEY, F.col("off").alias("off_before"), "b", *[F.when(F.col("b").isNotNull(), v).otherwise(F.col(k)).alias(k) for k, v in new.items()])
        left, n_out = ws.count(kept, "b is not null")
        ws.drop(rest)
        taken = left.where("b is not null").select("event_id", F.col("b.id").alias("particle_id"), *[F.col(f"b.{k}").alias(k) for k in state], F.col("particle_id").alias("child"), "off_before")
        rounds.append((leaves, taken if n_out else None))
        r += 1


def _lineage_by_rounds(blocks: DataFrame, descendants: bool, paths: bool, list_most: int) -> DataFrame:
    """The same for events that are too large for a task: every round is a few joins over particles spread by (event_id, particle_id)."""
    ws = Workspace(blocks.sparkSession)
    first = blocks.groupBy("event_id", "block_no", "own").agg(F.min_by("links", "arrival").alias("links"))
    nodes = first.select("event_id", "block_no", "own", F.posexplode("links").alias("pos", "l")).groupBy("event_id", F.col("l.id").alias("particle_id")).agg(F.min_by("l.parent", F.struct("block_no", "own", "pos")).alias("named"))
    ids = nodes.select("event_id", F.col("particle_id").alias("named"), F.lit(True).alias("there"))
    nodes = nodes.where("true").join(ids, ["event_id", "named"], "left")
    nodes = ws.write(nodes.select("event_id", "particle_id", F.when(F.col("there") & (F.col("named") != 0) & (F.col("named") != F.col("particle_id")), F.col("named")).alias("parent_id")))
    rounds = _contract(nodes, ws)
    # In reverse order every node takes root, depth and the chain of nodes above it from what it hung on.
    cols = [*_KEY, "size", "root_id", "depth", "on_cycle", "chain"]
    tops = [
        leaves.where("up is null or up = particle_id").select(
            *_KEY, F.col("acc").alias("size"), F.when(F.col("up").isNull(), F.col("particle_id")).otherwise(F.least("particle_id", "low")).alias("root_id"), F.when(F.col("up").isNull(), 0).otherwise(-1).alias("depth"),
            F.col("up").isNotNull().alias("on_cycle"), F.array("particle_id").alias("chain"),
        )
        for leaves, _ in rounds
    ]
    done = [ws.write(reduce(DataFrame.unionByName, tops))]
    depth = F.when(F.col("p.depth") < 0, -1).otherwise(F.col("p.depth") + F.col("dist"))
    chain = F.concat("p.chain", "via", F.array("particle_id"))

    def with_parent(df: DataFrame, every: DataFrame) -> DataFrame:
        return df.join(every.select("event_id", F.col("particle_id").alias("up"), F.struct("root_id", "depth", "chain").alias("p")), ["event_id", "up"])

    for leaves, taken in reversed(rounds):
        if taken is not None:
            every = reduce(DataFrame.unionByName, done)
            child = every.select("event_id", F.col("particle_id").alias("child"), F.col("size").alias("child_size"), "on_cycle")
            size = F.when(F.col("on_cycle"), F.col("acc")).otherwise(F.col("child_size") + F.col("off_before") + F.col("acc"))
            own = F.when(F.col("on_cycle"), F.array("particle_id")).otherwise(chain)
            done.append(ws.write(with_parent(taken, every).join(child, ["event_id", "child"]).select(*_KEY, size.alias("size"), F.col("p.root_id").alias("root_id"), depth.alias("depth"), "on_cycle", own.alias("chain"))))
        hung = leaves.where("up is not null and up <> particle_id")
        done.append(ws.write(with_parent(hung, reduce(DataFrame.unionByName, done)).select(*_KEY, F.col("acc").alias("size"), F.col("p.root_id").alias("root_id"), depth.alias("depth"), F.lit(False).alias("on_cycle"), chain.alias("chain"))))
        if len(done) > 8:  # many small tables become one
            old, done = done, [ws.write(reduce(DataFrame.unionByName, done).select(*cols))]
            ws.drop(*old)
    every = reduce(DataFrame.unionByName, done)
    path = F.when(F.col("depth") < 0, F.array().cast(_IDS)).otherwise(F.col("chain")).alias("path")
    slim = nodes.join(every, _KEY).select(*_KEY, "parent_id", "root_id", "depth", "on_cycle", (F.col("size") - 1).alias("n_descendants"), path)
    if not descendants:
        return slim if paths else slim.drop("path")
    # A chain names all that a node is a descendant of.
    pairs = every.select("event_id", F.col("particle_id").alias("descendant"), F.explode(F.slice("chain", F.lit(1), F.size("chain") - 1)).alias("above"))
    n_parts = F.greatest(F.lit(1), F.ceil(F.col("n_descendants") / list_most)).cast("int")
    # Parts by rank of id: ranks form within bands of ids, counts of bands are summed before, so no node's descendants are sorted in one task.
    banded = pairs.withColumn("band", F.shiftright("descendant", 16))
    node = ["event_id", "above"]
    counts = banded.groupBy(*node, "band").agg(F.count(F.lit(1)).alias("in_band"))
    before = counts.select(*node, "band", (F.sum("in_band").over(Window.partitionBy(*node).orderBy("band")) - F.col("in_band")).alias("before"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy(*node, "band").orderBy("descendant")) - 1
    parted = banded.join(before, [*node, "band"]).select(*node, "descendant", F.floor(rank / list_most).cast("int").alias("part"))
    lists = parted.groupBy("event_id", F.col("above").alias("particle_id"), "part").agg(F.array_sort(F.collect_list("descendant")).alias("descendants"))
    each = slim.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
    return each.join(lists, [*_KEY, "part"], "left").select(*[c for c in _NAMES if c != "descendants"], F.coalesce("descendants", F.array().cast(_IDS)).alias("descendants"))


def _sums(t: pa.Table, values: pa.Table) -> pa.Table:
    names = ["event_id", "particle_id", "own", "total"]
    if not t.num_rows:
        return pa.Table.from_arrays([pa.array([], pa.int64())] * 4, names)
    f = _forest(t)
    own = np.zeros(f.n, np.int64)
    e, i, v = (values.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("event_id", "particle_id", "units"))
    at = f.find(e, i)
    np.add.at(own, at[at >= 0], v[at >= 0])
    total = own.copy()
    for level in f.rounds:  # leaves first
        up = level[f.parent[level] >= 0]
        np.add.at(total, f.parent[up], total[up])
    ends = f.depth >= 0
    return pa.Table.from_arrays([pa.array(c[ends]) for c in (f.event, f.ident, own, total)], names)


def subtree_sums(particles: DataFrame, values: DataFrame, bucket_bytes: int = BUCKET_BYTES, most_nodes: int = MOST_NODES) -> DataFrame:
    """``event_id, particle_id, own, total`` of particles whose parents end: the sum of ``units`` (of ``event_id, particle_id, units``) of each particle, and with all its descendants, sent upwards while leaves are peeled.

    Units of what is no particle count nowhere, null units as 0; particles whose parents never end have no row. Other rules are those of lineage.
    """
    values = values.where("event_id is not null and particle_id is not null and units is not null").select(*_KEY, "units")
    e = _Events(particles, bucket_bytes, most_nodes)
    out = e.small.cogroup(e.in_buckets(e.of_small(values))).applyInArrow(lambda a, b: _sums(a, b), "event_id bigint, particle_id bigint, own bigint, total bigint")
    if not e.any_large:
        return out
    tree = Workspace(particles.sparkSession).write(_lineage_by_rounds(e.large, False, True, LIST_MOST).where("depth >= 0").select(*_KEY, "path"))
    summed = values.groupBy(*_KEY).agg(F.sum("units").alias("own"))
    sent = tree.join(summed, _KEY).select("event_id", F.explode("path").alias("particle_id"), "own").groupBy(*_KEY).agg(F.sum("own").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.unionByName(tree.select(*_KEY).join(summed, _KEY, "left").join(sent, _KEY, "left").select(*_KEY, zero("own"), zero("total")))


def descendant_pairs(particles: DataFrame, cycles: bool = False, **tuning) -> DataFrame:
    """``event_id, particle_id, descendant_id``: one row per descendant of each particle whose parents end; with ``cycles`` of every particle, also on and below cycles (descendants as in lineage)."""
    rows = lineage(particles, **tuning)
    return (rows if cycles else rows.where("depth >= 0")).select("event_id", "particle_id", F.explode("descendants").alias("descendant_id"))


def found(particles: DataFrame, **tuning) -> DataFrame:
    """``event_id, particle_id, root_id, depth`` of each particle that has a parent."""
    return lineage(particles, descendants=False, paths=False, **tuning).where("parent_id is not null").select("event_id", "particle_id", "root_id", "depth")
