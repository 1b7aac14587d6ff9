"""Point clouds for clustering, and what is read off labelled points."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestra.functions import kinematics as K
from nestra.operators.meanshift import mean_shift
from nestra.operators.nested import hits_flat, tracks_flat
from nestra.runtime import Workspace


def hit_points(calo_hits: DataFrame, least_energy: float | None = None) -> DataFrame:
    """``event_id, block_no, pos, x, y, z, eta, phi, energy, is_calo`` of hits with all coordinates (and at least the given energy)."""
    h = hits_flat(calo_hits, ("x", "y", "z", "total_energy")).where("x is not null and y is not null and z is not null")
    if least_energy is not None:
        h = h.where(F.col("total_energy") >= least_energy)
    return h.select("event_id", "block_no", "pos", "x", "y", "z", K.eta("x", "y", "z").alias("eta"), K.phi("x", "y").alias("phi"), F.coalesce("total_energy", F.lit(0.0)).alias("energy"), F.lit(True).alias("is_calo"))


def track_points(tracks: DataFrame) -> DataFrame:
    """The same of tracks with phi and theta: no position, energy 0."""
    t = tracks_flat(tracks).where("phi is not null and theta is not null")
    none = [F.lit(None).cast("double").alias(c) for c in "xyz"]
    return t.select("event_id", "block_no", "pos", *none, K.to_eta("theta").alias("eta"), "phi", F.lit(0.0).alias("energy"), F.lit(False).alias("is_calo"))


def cluster_points(calo_hits: DataFrame, tracks: DataFrame, least_energy: float | None = None) -> DataFrame:
    """Hits and tracks together in (eta, phi)."""
    both = hit_points(calo_hits, least_energy).unionByName(track_points(tracks))
    return both.where(F.abs("eta") < float("inf"))


def _ranked(points: DataFrame, energy: str, descending: bool) -> DataFrame:
    """Adds ``_rank`` (0, 1, ... within the event; ties by block_no, pos) and ``_all`` (points of the event).

    Rows are ranked within bands of similar energy only, bands of one energy (zero, missing) within ranges of blocks, and bands are counted per event: no event is sorted in one task.
    """
    e = F.col(energy)
    size = F.floor(F.log2(F.abs(e)) * 64)
    band = F.when(F.isnan(e) | e.isNull(), F.lit(-4000000)).when(e > 0, size).when(e < 0, F.lit(-2000000) - size).otherwise(F.lit(-1000000)).cast("bigint")
    banded = points.withColumn("_band", band).withColumn("_sub", F.when(F.col("_band").isin(-1000000, -4000000), F.floor(F.col("block_no") / 64)).otherwise(F.lit(0)))
    keys = ["event_id", "_band", "_sub"]
    counts = banded.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("event_id")
    order = (lambda c: F.desc_nulls_last(c)) if descending else (lambda c: F.asc_nulls_first(c))
    before = counts.select(*keys, (F.sum("_n").over(w.orderBy(order("_band"), "_sub")) - F.col("_n")).alias("_before"), F.sum("_n").over(w).alias("_all"))
    inner = F.row_number().over(Window.partitionBy(*keys).orderBy(order(energy), "block_no", "pos")) - 1
    return banded.join(before, keys).withColumn("_rank", F.col("_before") + inner).drop("_band", "_sub", "_before")


def percentile_mask(points: DataFrame, percent: float, energy: str = "energy") -> DataFrame:
    """Adds ``is_top``: the max(1, ceil(percent / 100 * n)) points of highest energy of each event (ties: by block_no, pos). Missing energies come last."""
    ranked = _ranked(points, energy, descending=True)
    most = F.greatest(F.lit(1), F.ceil(F.lit(percent) / 100 * F.col("_all")))
    return ranked.withColumn("is_top", F.col("_rank") < most).drop("_rank", "_all")


def percentile_clip(points: DataFrame, energy: str = "energy", low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Adds ``clipped``: the energy kept between the event's percentiles (linear interpolation)."""
    ranked = _ranked(points.where(F.col(energy).isNotNull()), energy, descending=False)
    sides = []
    for name, share in (("_low", low), ("_high", high)):
        at = F.lit(share) * (F.col("_all") - 1)
        below = F.max(F.when(F.col("_rank") == F.floor(at), F.col(energy)))
        above = F.max(F.when(F.col("_rank") == F.ceil(at), F.col(energy)))
        sides.append((below + (above - below) * F.max(at - F.floor(at))).alias(name))
    bounds = ranked.groupBy("event_id").agg(*sides)
    return points.join(bounds, "event_id", "left").withColumn("clipped", F.when(F.col(energy).isNotNull(), F.greatest(F.least(F.col(energy), F.col("_high")), F.col("_low")))).drop("_low", "_high")


def split_events(points: DataFrame, bandwidth: float, decorate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``event_id, cluster_id, n_calo, n_tracks, calo, tracks``: each event divided by clusters in (eta, phi), with the positions (block_no, pos) of its hits and tracks. Events without points have no row; a negative bandwidth keeps events whole.

    ``decorate`` is the place for one's own work on every part of an event: it gets the result as a frame and returns what takes its place.
    """
    labelled = mean_shift(points.select("event_id", "block_no", "pos", "eta", "phi", "is_calo"), ("eta", "phi"), bandwidth, angular=True, keep=("event_id", "block_no", "pos", "is_calo", "cluster_id"))
    member = F.struct("block_no", "pos")
    lists = [F.array_sort(F.collect_list(F.when(cond, member))).alias(n) for n, cond in (("calo", F.col("is_calo")), ("tracks", ~F.col("is_calo")))]
    parts = labelled.groupBy("event_id", "cluster_id").agg(*lists).select("event_id", "cluster_id", F.size("calo").alias("n_calo"), F.size("tracks").alias("n_tracks"), "calo", "tracks")
    return decorate(parts) if decorate else parts


def large_clusters(labelled: DataFrame, least: int) -> DataFrame:
    """Hits of clusters with at least ``least`` hits; the sizes are counted first, so that no cluster is gathered in one task."""
    sizes = labelled.groupBy("event_id", "cluster_id").agg(F.count(F.lit(1)).alias("n_hits")).where(F.col("n_hits") >= least)
    return labelled.join(sizes, ["event_id", "cluster_id"])


def cardinality(labelled: DataFrame, keep_noise: bool = False) -> DataFrame:
    """``event_id, cluster_id, n_hits``; noise (-1) is left out unless it is to be kept."""
    return (labelled if keep_noise else labelled.where("cluster_id <> -1")).groupBy("event_id", "cluster_id").agg(F.count(F.lit(1)).alias("n_hits"))


def cardinality_of_events(labelled: DataFrame, mask: DataFrame | None = None, keep_noise: bool = False) -> DataFrame:
    """``event_id, cluster_id, n_hits, index``: the clusters of all events, numbered through in the order of (event_id, cluster_id).

    ``labelled`` has ``event_id, block_no, pos, cluster_id``; ``mask`` has ``event_id, block_no, pos, is_on`` for exactly the same points, of which those that are on count. A point that is in one of the two only is an error.
    Events of which no point counts have no row.
    """
    if mask is not None:
        at = ["event_id", "block_no", "pos"]
        # Both sides meet by aggregating them together: a later filter cannot take a point out before it has been checked.
        sides = labelled.select(*at, "cluster_id", F.lit(None).cast("boolean").alias("is_on"), F.lit(1).alias("_l"), F.lit(0).alias("_m"))
        sides = sides.unionByName(mask.select(*at, F.lit(None).cast("int").alias("cluster_id"), "is_on", F.lit(0).alias("_l"), F.lit(1).alias("_m")))
        both = sides.groupBy(*at).agg(F.max("cluster_id").alias("cluster_id"), F.max("is_on").alias("is_on"), F.sum("_l").alias("_l"), F.sum("_m").alias("_m"))
        fits = F.assert_true((F.col("_l") == 1) & (F.col("_m") == 1), F.lit("the mask and the labels are not of the same points"))
        labelled = both.where(fits.isNull() & F.col("is_on")).drop("_l", "_m")
    return with_global_index(cardinality(labelled, keep_noise))


RANGES = 4096


def with_global_index(per_cluster: DataFrame) -> DataFrame:
    """Adds ``index``: 0, 1, ... over all clusters in the order of (event_id, cluster_id).

    Counts are summed over at most RANGES ranges of event_ids, within a range over bands of cluster_ids, and clusters are sorted within a band only, so neither many events nor an event of many clusters meet in one task.
    """
    per_cluster = Workspace(per_cluster.sparkSession).write(per_cluster)  # read several times below; clusters are not to be found anew each time
    edges = per_cluster.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, width = edges.lo or 0, max(1, -(-((edges.hi or 0) - (edges.lo or 0) + 1) // RANGES))
    banded = per_cluster.withColumn("_range", F.floor((F.col("event_id") - lo) / width)).withColumn("_band", F.shiftright("cluster_id", 16))
    keys = ["_range", "event_id", "_band"]
    counts = banded.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = lambda w: F.sum("_n").over(w) - F.col("_n")
    starts = counts.groupBy("_range").agg(F.sum("_n").alias("_n")).select("_range", before(Window.orderBy("_range")).alias("_start"))
    within = counts.select(*keys, before(Window.partitionBy("_range").orderBy("event_id", "_band")).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("cluster_id")) - 1
    return banded.join(within, keys).join(starts, "_range").withColumn("index", F.col("_start") + F.col("_before") + place).drop("_range", "_band", "_start", "_before")


def cluster_summary(labelled: DataFrame) -> DataFrame:
    """``event_id, cluster_id, n_hits, cx, cy, cz``: size and mean position."""
    return labelled.groupBy("event_id", "cluster_id").agg(F.count(F.lit(1)).alias("n_hits"), *[F.round(F.avg(c), 4).alias(f"c{c}") for c in "xyz"])


def track_pairs(tracks: DataFrame, limit: float) -> DataFrame:
    """``event_id, block_a, pos_a, block_b, pos_b, delta_r``: pairs of tracks of an event nearer than ``limit`` in (eta, phi).

    Tracks are put into bins of phi as wide as the limit; each meets only its own and the next bin, which closes on itself.
    """
    n = max(1, math.floor(2 * math.pi / limit))
    t = track_points(tracks).where(F.abs("eta") < float("inf")).select("event_id", "block_no", "pos", "eta", "phi")
    t = t.withColumn("bin", F.least(F.floor((F.col("phi") + math.pi) / (2 * math.pi / n)), F.lit(n - 1)).cast("int")).withColumn("band", F.floor(F.col("eta") / limit).cast("int"))
    # Every pair meets once: b is registered in its own cell, a looks into the nine cells around its own.
    a = t.select("event_id", *[F.col(c).alias(f"{c}_a") for c in ("block_no", "pos", "eta", "phi", "bin")], F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])).alias("band"))
    around: list[Column] = [F.pmod(F.col("bin_a") + k, F.lit(n)) for k in (-1, 0, 1)]
    a = a.withColumn("bin", F.explode(F.array_distinct(F.array(*around)))).drop("bin_a")
    b = t.select("event_id", "bin", "band", *[F.col(c).alias(f"{c}_b") for c in ("block_no", "pos", "eta", "phi")])
    d = K.delta_r("eta_a", "phi_a", "eta_b", "phi_b")
    near = a.join(b, ["event_id", "bin", "band"]).where("block_no_a < block_no_b or (block_no_a = block_no_b and pos_a < pos_b)").withColumn("delta_r", d).where(F.col("delta_r") < limit)
    return near.select("event_id", F.col("block_no_a").alias("block_a"), "pos_a", F.col("block_no_b").alias("block_b"), "pos_b", F.round("delta_r", 6).alias("delta_r"))
