"""Masks and features: one added list column, aligned with the other lists of the block.

Row-local masks are ``transform`` expressions and need no shuffle. Masks that ask for other rows (parents, tracks, hits) are joins of flat keys on (event_id, particle_id).
Every builder replaces an existing column of its name, so it may be applied again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestra.functions import kinematics as K
from nestra.operators.nested import attach, contributions_flat, flatten, particles_flat, tracks_flat
from nestra.runtime import Workspace

KEY = ["event_id", "particle_id"]


def cast_parent_ids(particles: DataFrame) -> DataFrame:
    """parent_id as list<bigint>; NaN and what does not fit become null."""
    return particles.withColumn("parent_id", F.transform("parent_id", lambda x: x.try_cast("bigint")))


def _zipped(*cols: str):
    return F.arrays_zip(*[F.coalesce(F.col(c), F.array()).alias(c) for c in cols])


def add_eta_phi_pt(particles: DataFrame) -> DataFrame:
    """eta, phi, pt from px, py, pz; a null list gives an empty one."""
    p = _zipped("px", "py", "pz")
    made = {
        "pt": F.transform(p, lambda m: K.pt(m["px"], m["py"])), "phi": F.transform(p, lambda m: K.phi(m["px"], m["py"])), "eta": F.transform(p, lambda m: K.eta(m["px"], m["py"], m["pz"])),
    }
    return particles.withColumns(made)


def add_inside_calo(particles: DataFrame, rule: str = "current", name: str = "created_inside_calo") -> DataFrame:
    """Whether each particle was created inside the calorimeter, by the named geometry rule."""
    return particles.withColumn(name, F.transform(_zipped("vx", "vy", "vz"), lambda v: K.inside_calo(v["vx"], v["vy"], v["vz"], rule)))


def orphans(flat: DataFrame) -> DataFrame:
    """Flat particles with ``is_parent_missing``: the parent is null or no particle of the event."""
    ids = flat.select("event_id", F.col("particle_id").alias("parent_id"), F.lit(True).alias("_there")).distinct()
    return flat.join(ids, ["event_id", "parent_id"], "left").withColumn("is_parent_missing", F.col("_there").isNull()).drop("_there")


def tracked(flat: DataFrame, tracks: DataFrame) -> DataFrame:
    """Flat particles with ``has_track``."""
    ids = tracks_flat(tracks).where("majority_particle_id is not null").select("event_id", F.col("majority_particle_id").alias("particle_id"), F.lit(True).alias("has_track")).distinct()
    return flat.join(ids, KEY, "left").withColumn("has_track", F.coalesce("has_track", F.lit(False)))


def entering(flat: DataFrame, calo_hits: DataFrame | None = None) -> DataFrame:
    """Flat particles with ``enter_calo``: outside, and parent of one inside or (given calo_hits) a contributor itself. Needs vx, vy, vz."""
    inside = K.inside_calo("vx", "vy", "vz")
    flat = flat.withColumn("created_inside_calo", inside)
    ids = flat.where("created_inside_calo and parent_id is not null").select("event_id", F.col("parent_id").alias("particle_id"))
    if calo_hits is not None:
        ids = ids.unionByName(contributions_flat(calo_hits, ()).select(*KEY))
    ids = ids.distinct().withColumn("_enters", F.lit(True))
    return flat.join(ids, KEY, "left").withColumn("enter_calo", F.coalesce(~F.col("created_inside_calo") & F.col("_enters"), F.lit(False))).drop("_enters")


def targets(particles: DataFrame, tracks: DataFrame, calo_hits: DataFrame, cols: tuple[str, ...] = ()) -> DataFrame:
    """Flat particles with all masks and ``is_target_particle``: (enter_calo or has_track) and (no tracked ancestor or has_track)."""
    from nestra.operators.ancestry import nearest_tracked

    # Flattened once: the table is read for the particles, for their ids and for the parents of inside ones.
    flat = Workspace(particles.sparkSession).write(particles_flat(particles, ("parent_id", "vx", "vy", "vz", *cols)))
    flagged = entering(tracked(orphans(flat), tracks), calo_hits)
    up = nearest_tracked(particles, tracks).select(*KEY, F.lit(True).alias("_above"))
    want = (F.col("enter_calo") | F.col("has_track")) & (F.col("_above").isNull() | F.col("has_track"))
    return flagged.join(up, KEY, "left").withColumn("is_target_particle", want).drop("_above")


def add_orphan_mask(particles: DataFrame) -> DataFrame:
    return attach(particles, orphans(particles_flat(particles, ("parent_id",))), "is_parent_missing")


def add_track_mask(particles: DataFrame, tracks: DataFrame) -> DataFrame:
    return attach(particles, tracked(particles_flat(particles, ()), tracks), "has_track")


def add_enter_mask(particles: DataFrame, calo_hits: DataFrame | None = None) -> DataFrame:
    """Without calo_hits the first form (parents of inside particles only)."""
    return attach(particles, entering(particles_flat(particles, ("parent_id", "vx", "vy", "vz")), calo_hits), "enter_calo")


def add_target_mask(particles: DataFrame, tracks: DataFrame, calo_hits: DataFrame) -> DataFrame:
    return attach(particles, targets(particles, tracks, calo_hits), "is_target_particle")


def all_masks(particles: DataFrame, tracks: DataFrame, calo_hits: DataFrame) -> DataFrame:
    """All masks and features in one pass: one flat plan, one regrouping."""
    names = ("is_parent_missing", "created_inside_calo", "has_track", "enter_calo", "is_target_particle")
    flat = targets(particles, tracks, calo_hits)
    from nestra.operators.nested import regroup

    lists = regroup(flat.select("event_id", "block_no", "pos", *names), names)
    out = add_eta_phi_pt(particles).drop(*names).join(lists, ["event_id", "block_no"], "left")
    return out.withColumns({n: F.coalesce(n, F.array().cast("array<boolean>")) for n in names})


def mask_values(jagged: DataFrame, *names: str) -> DataFrame:
    """A jagged table's masks as flat rows ``event_id, particle_id, *names``."""
    return flatten(jagged.dropDuplicates(["event_id", "block_no"]), ("particle_id", *names)).where("particle_id is not null").select("event_id", "particle_id", *names)
