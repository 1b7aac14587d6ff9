"""Ancestry maps over the per-event forest of parent links.

The three closures (ultimate, nearest with a track, first outside) are one operator with different seeds: follow ``next`` until a fixed point. Whole events are hashed into buckets of bounded size, their blocks as they are, and
solved there by pointer doubling on arrays: one shuffle in all. Events above ``MOST_NODES`` particles are flattened and doubled by DataFrame joins, one per round. Chains that never end give null in both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestra.arrow import numpy
from nestra.functions.kinematics import inside_calo
from nestra.operators import hierarchy
from nestra.operators.masks import KEY, orphans, tracked
from nestra.operators.nested import contributions_flat, particles_flat
from nestra.runtime import Workspace

MOST_NODES = 1 << 20
BUCKET_BYTES = 4 << 20


_ENDS = "event_id bigint, particle_id bigint, target bigint, target_mark boolean"


def _ends(to_marked: bool, t: pa.Table, marked: pa.Table | None = None) -> pa.Table:
    """Blocks of whole events -> where the way up from each particle ends: at the first marked one, itself included, or at the top. Marks come with the blocks or as (event_id, id)."""
    if not t.num_rows:
        return pa.Table.from_arrays([pa.array([], pa.int64())] * 3 + [pa.array([], pa.bool_())], ["event_id", "particle_id", "target", "target_mark"])
    f = hierarchy._forest(t, peel=False)
    n, mark = f.n, f.mark
    if marked is not None:
        at = f.find(numpy(marked.column("event_id")), numpy(marked.column("id")))
        mark = np.zeros(n, np.int8)
        mark[at[at >= 0]] = 1
    self_ = np.arange(n)
    up = np.where(f.parent >= 0, f.parent, n)
    stop = mark == 1 if to_marked else f.parent < 0
    to = np.r_[np.where(stop, self_, up), n]  # n: nothing
    fixed = to == np.arange(n + 1)
    for _ in range(max(1, int(n).bit_length() + 1)):
        to = to[to]
    to = to[:n]
    there = fixed[to] & (to < n)
    safe = np.where(there, to, 0)
    target_mark = pa.array(mark[safe] == 1, mask=~there | (mark[safe] < 0))
    return pa.Table.from_arrays([pa.array(f.event), pa.array(f.ident), pa.array(f.ident[safe], mask=~there), target_mark], ["event_id", "particle_id", "target", "target_mark"])


def closure(pointers: DataFrame) -> DataFrame:
    """``event_id, particle_id, target`` from ``event_id, particle_id, next``, by joins: next = itself is a fixed point, null a dead end; target is null where no fixed point is reached (dead ends and cycles)."""
    ws = Workspace(pointers.sparkSession)
    now = ws.write(pointers.groupBy(*KEY).agg(F.min("next").alias("next")))
    fixed = now.where("next = particle_id").select(*KEY, F.lit(True).alias("_fixed"))
    longest = now.groupBy("event_id").count().agg(F.max("count")).first()[0] or 1
    for _ in range(int(longest).bit_length() + 1):
        ahead = now.select("event_id", F.col("particle_id").alias("next"), F.col("next").alias("_next2"))
        moved = now.join(ahead, ["event_id", "next"], "left").select(*KEY, F.col("_next2").alias("next"), (~F.col("next").eqNullSafe(F.col("_next2"))).alias("_moved"))
        now, n = ws.count(moved, "_moved")
        if not n:
            break
    ends = now.join(fixed.select("event_id", F.col("particle_id").alias("next"), "_fixed"), ["event_id", "next"], "left")
    return ends.select(*KEY, F.when(F.col("_fixed"), F.col("next")).alias("target"))


def _events(particles: DataFrame, mark: Column, most_nodes: int = MOST_NODES) -> tuple[hierarchy._Events, DataFrame | None]:
    """Events in buckets, and the particles of those that are too large for a task."""
    e = hierarchy._Events(particles, BUCKET_BYTES, most_nodes, mark)
    return e, particles.join(e.oversize, "event_id", "left_semi") if e.any_large else None


def _flag_list(flag) -> Column:
    """A list of flags from the vertices of a block's particles."""
    own = lambda c: F.coalesce(F.col(c), F.array()).alias(c)
    return F.transform(F.arrays_zip(own("vx"), own("vy"), own("vz")), lambda v: flag(v["vx"], v["vy"], v["vz"]))


def _goes_up():
    """There is a parent to go to; a particle that is its own parent is a dead end unless it is what is looked for."""
    return ~F.col("is_parent_missing") & (F.col("parent_id") != F.col("particle_id"))


def ultimate(particles: DataFrame, **tuning) -> DataFrame:
    """``event_id, particle_id, ultimate_ancestor_id, ancestor_created_inside_calo``: the orphan at the end of the parents (a particle that is its own parent ends there too); null if they never end."""
    names = [*KEY, "ultimate_ancestor_id", "ancestor_created_inside_calo"]
    e, large = _events(particles, _flag_list(lambda x, y, z: inside_calo(x, y, z, "legacy")), **tuning)
    out = e.small.applyInArrow(lambda t: _ends(False, t), _ENDS).toDF(*names)
    if large is None:
        return out
    flat = orphans(particles_flat(large, ("parent_id", "vx", "vy", "vz")))
    nxt = F.when(F.col("is_parent_missing"), F.col("particle_id")).otherwise(F.col("parent_id")).alias("next")
    ends = closure(flat.select(*KEY, nxt)).withColumnRenamed("target", "ultimate_ancestor_id")
    of = flat.select("event_id", F.col("particle_id").alias("ultimate_ancestor_id"), inside_calo("vx", "vy", "vz", "legacy").alias("ancestor_created_inside_calo"))
    return out.unionByName(ends.join(of, ["event_id", "ultimate_ancestor_id"], "left").select(*names))


def nearest_tracked(particles: DataFrame, tracks: DataFrame, **tuning) -> DataFrame:
    """``event_id, particle_id, ancestor_with_track_id``: the particle itself or its nearest ancestor with a track; particles without one have no row."""
    names = [*KEY, "ancestor_with_track_id"]
    e, large = _events(particles, F.array().cast("array<boolean>"), **tuning)
    ids = tracks.where("event_id is not null").select("event_id", F.explode("majority_particle_id").alias("id")).where("id is not null").distinct()
    with_tracks = e.in_buckets(e.of_small(ids))
    out = e.small.cogroup(with_tracks).applyInArrow(lambda a, b: _ends(True, a, b), _ENDS).where("target is not null").select(*KEY, "target").toDF(*names)
    if large is None:
        return out
    flat = tracked(orphans(particles_flat(large, ("parent_id",))), tracks)
    nxt = F.when(F.col("has_track"), F.col("particle_id")).when(_goes_up(), F.col("parent_id")).alias("next")
    return out.unionByName(closure(flat.select(*KEY, nxt)).where("target is not null").toDF(*names))


def first_outside(particles: DataFrame, calo_hits: DataFrame, **tuning) -> DataFrame:
    """``event_id, particle_id, ancestor_outside_calo_id`` of the particles that contributed to hits: the first ancestor (itself included) created outside; null if the way up ends inside."""
    names = [*KEY, "ancestor_outside_calo_id"]
    e, large = _events(particles, _flag_list(lambda x, y, z: ~inside_calo(x, y, z)), **tuning)
    out = e.small.applyInArrow(lambda t: _ends(True, t), _ENDS).select(*KEY, "target").toDF(*names)
    if large is not None:
        flat = orphans(particles_flat(large, ("parent_id", "vx", "vy", "vz"))).withColumn("inside", inside_calo("vx", "vy", "vz"))
        nxt = F.when(~F.col("inside"), F.col("particle_id")).when(_goes_up(), F.col("parent_id")).alias("next")
        out = out.unionByName(closure(flat.select(*KEY, nxt)).toDF(*names))
    return out.join(contributions_flat(calo_hits, ()).select(*KEY).distinct(), KEY, "left_semi")


def ancestors_with_cycles(particles: DataFrame) -> DataFrame:
    """``event_id, particle_id, ancestor_id, in_cycle``: the walk that reports cycles. The end of a chain whose last parent is named but absent is that absent id; a natural root (no parent, or its own) is itself; chains into a cycle have no ancestor."""
    flat = particles_flat(particles, ("parent_id",)).select(*KEY, F.col("parent_id").alias("named"))
    tree = hierarchy.lineage(particles, descendants=False, paths=False).select(*KEY, "root_id", "depth")
    ends = tree.join(flat.select("event_id", F.col("particle_id").alias("root_id"), F.col("named").alias("beyond")), ["event_id", "root_id"], "left")
    absent = F.when(F.col("beyond").isNull() | (F.col("beyond") == 0) | (F.col("beyond") == F.col("root_id")), F.col("root_id")).otherwise(F.col("beyond"))
    return ends.select(*KEY, F.when(F.col("depth") >= 0, absent).alias("ancestor_id"), (F.col("depth") < 0).alias("in_cycle"))


def ancestor_distribution(lineage: DataFrame) -> DataFrame:
    """``n_events, mean_n, median_n, max_n`` of the number of different ultimate ancestors per event."""
    per = lineage.groupBy("event_id").agg(F.count_distinct("ultimate_ancestor_id").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_events"), F.avg("n").alias("mean_n"), F.median("n").alias("median_n"), F.max("n").alias("max_n"))


def generation_map(particles: DataFrame, selected: DataFrame) -> DataFrame:
    """``event_id, selected_id, particle_id, generation`` around each selected (event_id, particle_id): +n for descendants, -n for ancestors, 0 for itself. Particles whose parents never end have no generations."""
    tree = hierarchy.lineage(particles, descendants=False).where("depth >= 0").select(*KEY, "depth", "path")
    chosen = selected.select("event_id", F.col("particle_id").alias("selected_id")).distinct()
    # Every particle's path holds its ancestors: one look at the paths gives both directions.
    steps = tree.select("event_id", "particle_id", "depth", F.posexplode("path").alias("at", "above"))
    down = steps.join(chosen.withColumnRenamed("selected_id", "above"), ["event_id", "above"]).select("event_id", F.col("above").alias("selected_id"), "particle_id", (F.col("depth") - F.col("at")).alias("generation"))
    up = steps.join(chosen.withColumnRenamed("selected_id", "particle_id"), KEY).where("at < depth").select("event_id", F.col("particle_id").alias("selected_id"), F.col("above").alias("particle_id"), (F.col("at") - F.col("depth")).alias("generation"))
    return down.unionByName(up)


def data_jumps(particles: DataFrame, visible: DataFrame) -> DataFrame:
    """``event_id, particle_id, ancestor_id, gap``: for each visible (event_id, particle_id) its nearest visible proper ancestor and how many generations lie between; 1 is a direct link, more is a jump."""
    tree = hierarchy.lineage(particles, descendants=False).where("depth > 0").select(*KEY, "depth", "path")
    seen = visible.select(*KEY).distinct()
    steps = tree.join(seen, KEY, "left_semi").select(*KEY, "depth", F.posexplode("path").alias("at", "above")).where("at < depth")
    near = steps.join(seen.withColumnRenamed("particle_id", "above"), ["event_id", "above"], "left_semi").groupBy(*KEY).agg(F.max_by("above", "at").alias("ancestor_id"), F.min(F.col("depth") - F.col("at")).alias("gap"))
    return near.select(*KEY, "ancestor_id", "gap")


def inclusive_energy(particles: DataFrame, calo_hits: DataFrame) -> DataFrame:
    """``event_id, particle_id, direct_energy, inclusive_energy``: what a particle deposited itself, and with all its descendants. Sums are in whole millionths, so exact. Particles whose parents never end have no row."""
    sums = hierarchy.subtree_sums(particles, deposits(calo_hits))
    return sums.select(*KEY, (F.col("own") / F.lit(1e6)).alias("direct_energy"), (F.col("total") / F.lit(1e6)).alias("inclusive_energy"))


def deposits(calo_hits: DataFrame) -> DataFrame:
    """``event_id, particle_id, units``: uncalibrated energy per contributing particle, in whole millionths."""
    units = F.floor(F.col("energy") * 1e6 + 0.5)
    return contributions_flat(calo_hits, ()).groupBy(*KEY).agg(F.coalesce(F.sum(units), F.lit(0).cast("bigint")).alias("units"))


def cells_of_particles(calo_hits: DataFrame) -> DataFrame:
    """``event_id, particle_id, n_cells``: in how many hits a particle took part."""
    return contributions_flat(calo_hits, ()).select(*KEY, "block_no", "pos").distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_cells"))


def forest_edges(particles: DataFrame) -> DataFrame:
    """``event_id, parent_id, particle_id``: valid links only (parent not 0, not itself, a particle of the event)."""
    flat = particles_flat(particles, ("parent_id",))
    ids = flat.select("event_id", F.col("particle_id").alias("parent_id"))
    return flat.where("parent_id <> 0 and parent_id <> particle_id").join(ids, ["event_id", "parent_id"], "left_semi").select("event_id", "parent_id", "particle_id")


def lineage_exists(lineage: DataFrame, flat: DataFrame) -> DataFrame:
    """Particles that are some particle's ultimate ancestor."""
    return flat.join(lineage.select("event_id", F.col("ultimate_ancestor_id").alias("particle_id")), KEY, "left_semi").select(*KEY)


def untracked_entering(particles: DataFrame, tracks: DataFrame, calo_hits: DataFrame) -> DataFrame:
    """Particles that enter the calorimeter and have no tracked ancestor (nor a track)."""
    from nestra.operators.masks import entering

    flat = entering(particles_flat(particles, ("parent_id", "vx", "vy", "vz")), calo_hits)
    return flat.where("enter_calo").join(nearest_tracked(particles, tracks), KEY, "left_anti").select(*KEY)


def outside_check(particles: DataFrame, calo_hits: DataFrame) -> DataFrame:
    """``created_inside_calo, n``: whether the first outside ancestors really were created outside; one row, false, if all were."""
    flat = particles_flat(particles, ("vx", "vy", "vz")).select("event_id", F.col("particle_id").alias("ancestor_outside_calo_id"), inside_calo("vx", "vy", "vz").alias("created_inside_calo"))
    return first_outside(particles, calo_hits).join(flat, ["event_id", "ancestor_outside_calo_id"]).groupBy("created_inside_calo").agg(F.count(F.lit(1)).alias("n"))


def tracked_descendants(particles: DataFrame, tracks: DataFrame) -> DataFrame:
    """``event_id, ancestor_with_track_id, n_particles``: how many particles each tracked ancestor stands for."""
    return nearest_tracked(particles, tracks).groupBy("event_id", "ancestor_with_track_id").agg(F.count(F.lit(1)).alias("n_particles"))


def members_of(lineage: DataFrame, event_id: int, ancestor_id: int) -> DataFrame:
    return lineage.where((F.col("event_id") == event_id) & (F.col("ultimate_ancestor_id") == ancestor_id))


def grandparents(particles: DataFrame) -> DataFrame:
    """``event_id, particle_id, time_ns, parent_id, parent_time_ns, grandparent_id, grandparent_time_ns`` where a parent is there."""
    flat = particles_flat(particles, ("parent_id", "time_ns")).select(*KEY, "parent_id", "time_ns")
    p = flat.select("event_id", F.col("particle_id").alias("parent_id"), F.col("time_ns").alias("parent_time_ns"), F.col("parent_id").alias("grandparent_id"))
    g = flat.select("event_id", F.col("particle_id").alias("grandparent_id"), F.col("time_ns").alias("grandparent_time_ns"))
    out = flat.join(p, ["event_id", "parent_id"]).join(g, ["event_id", "grandparent_id"], "left")
    return out.select(*KEY, "time_ns", "parent_id", "parent_time_ns", "grandparent_id", "grandparent_time_ns")


def hits_by_ancestor(calo_hits: DataFrame, lineage: DataFrame) -> DataFrame:
    """Contributions with the ultimate ancestor of the contributor: ``event_id, block_no, pos, particle_id, energy, ultimate_ancestor_id``; contributors without one are left out."""
    c = contributions_flat(calo_hits, ())
    return c.join(lineage.select(*KEY, "ultimate_ancestor_id").where("ultimate_ancestor_id is not null"), KEY).select("event_id", "block_no", "pos", "particle_id", "energy", "ultimate_ancestor_id")


