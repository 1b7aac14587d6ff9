"""Energy attribution: deposits of particles and clusters.

Energies are summed as whole millionths (bigint), so results do not depend on the order of summing; divisions by 0 give null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestra.functions.kinematics import histogram_bin
from nestra.operators.masks import KEY, orphans, targets
from nestra.operators.nested import contributions_flat, hits_flat, particles_flat
from nestra.schema import pdg_classes


def units(energy: Column | str) -> Column:
    e = F.col(energy) if isinstance(energy, str) else energy
    return F.floor(e * 1e6 + 0.5)


def as_energy(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0)) / F.lit(1e6)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def calibrated_deposits(calo_hits: DataFrame, calibration: DataFrame) -> DataFrame:
    """``event_id, particle_id, units``: calibrated energy per contributor; an unknown detector counts 0."""
    c = contributions_flat(calo_hits).join(F.broadcast(calibration.select("detector", "calib_factor")), "detector", "left")  # a fixed table of a few rows
    return c.groupBy(*KEY).agg(F.coalesce(F.sum(units(F.col("energy") * F.col("calib_factor"))), F.lit(0).cast("bigint")).alias("units"))


def particle_purity(calo_hits: DataFrame, lineage: DataFrame, particles: DataFrame, calibration: DataFrame) -> DataFrame:
    """``event_id, ultimate_ancestor_id, total_energy_in_calo, total_particle_energy, purity``: what all particles of an ancestor deposited, over the ancestor's own energy. Particles without hits count 0."""
    # Deposits are summed per particle before the join with the ancestors, so that the join is of particles, not of contributions.
    known = lineage.where("ultimate_ancestor_id is not null").select(*KEY, "ultimate_ancestor_id")
    sums = known.join(calibrated_deposits(calo_hits, calibration), KEY, "left").groupBy("event_id", "ultimate_ancestor_id").agg(F.sum("units").alias("units"))
    own = particles_flat(particles, ("energy",)).select("event_id", F.col("particle_id").alias("ultimate_ancestor_id"), F.col("energy").alias("total_particle_energy"))
    out = sums.join(own, ["event_id", "ultimate_ancestor_id"], "left").withColumn("total_energy_in_calo", as_energy("units"))
    return out.select("event_id", "ultimate_ancestor_id", "total_energy_in_calo", "total_particle_energy", ratio(F.col("total_energy_in_calo"), F.col("total_particle_energy")).alias("purity"))


def purity_by_class(purity: DataFrame, particles: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Purity with ``pdg_id`` of the ancestor and its ``class_id`` (-1 if in no class; a code in two classes has two rows)."""
    classes = pdg_classes(particles.sparkSession) if classes is None else classes
    codes = particles_flat(particles, ("pdg_id",)).select("event_id", F.col("particle_id").alias("ultimate_ancestor_id"), "pdg_id")
    return purity.join(codes, ["event_id", "ultimate_ancestor_id"], "left").join(F.broadcast(classes), "pdg_id", "left").withColumn("class_id", F.coalesce("class_id", F.lit(-1)))


# Bounds of the energy intervals [low, high) of the report, in GeV.
INTERVALS = (-0.1, 0.001, 5.0, 10.0, 20.0, 50.0, 100.0)


def interval_of(energy: str) -> Column:
    """0 .. 6, null below the first bound or for null."""
    out = F.lit(None).cast("int")
    for k, low in enumerate(INTERVALS):
        out = F.when(F.col(energy) >= low, k).otherwise(out)
    return out


def purity_intervals(by_class: DataFrame, names: DataFrame, n_bins: int = 49) -> tuple[DataFrame, DataFrame]:
    """(``class_id, interval, bin, n``; ``class_id, interval, name, n``): histograms over the class's own range of purity, and the ten most frequent names (ties by name)."""
    rows = by_class.where("purity is not null").withColumn("interval", interval_of("total_particle_energy")).where("interval is not null")
    bounds = rows.groupBy("class_id").agg(F.min("purity").alias("_lo"), F.max("purity").alias("_hi"))
    binned = rows.join(F.broadcast(bounds), "class_id")  # one row per class
    flat = F.when(F.col("_lo") == F.col("_hi"), F.lit(0).cast("bigint")).otherwise(histogram_bin("purity", F.col("_lo"), F.when(F.col("_lo") < F.col("_hi"), F.col("_hi")).otherwise(F.col("_lo") + 1), n_bins))
    histogram = binned.groupBy("class_id", "interval", flat.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    named = rows.join(F.broadcast(names), "pdg_id", "left").groupBy("class_id", "interval", F.coalesce("name", F.col("pdg_id").cast("string")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("class_id", "interval").orderBy(F.desc("n"), "name")
    return histogram, named.withColumn("r", F.row_number().over(w)).where("r <= 10").drop("r")


def with_grid_clusters(calo_hits: DataFrame, cell: float = 500.0) -> DataFrame:
    """Hits with a deterministic ``cluster_id``: numbered cubes of space; -1 (noise) where a coordinate is missing or the hit lies in the outer shell."""
    h = hits_flat(calo_hits)
    k = lambda c: F.floor(F.col(c) / cell) + 16
    inner = (F.abs("x") < 16 * cell) & (F.abs("y") < 16 * cell) & (F.abs("z") < 9 * cell)
    return h.withColumn("cluster_id", F.coalesce(F.when(inner, k("x") * 1024 + k("y") * 32 + k("z")), F.lit(-1)).cast("bigint"))


def cluster_contributions(labelled: DataFrame) -> DataFrame:
    """``event_id, cluster_id, block_no, pos, particle_id, energy`` of labelled hits."""
    pairs = F.arrays_zip(F.coalesce("contrib_particle_ids", F.array()).alias("i"), F.coalesce("contrib_energies", F.array()).alias("e"))
    rows = labelled.select("event_id", "cluster_id", "block_no", "pos", F.explode(pairs).alias("_r"))
    return rows.select("event_id", "cluster_id", "block_no", "pos", F.col("_r.i").alias("particle_id"), F.col("_r.e").alias("energy")).where("particle_id is not null")


def with_labels(calo_hits: DataFrame, labels: DataFrame) -> DataFrame:
    """Flat hits with the ``cluster_id`` of any clustering (``event_id, block_no, pos, cluster_id``), as all cluster reports take them; a hit without a label is noise (-1)."""
    hits = hits_flat(calo_hits, ("x", "y", "z", "total_energy", "contrib_particle_ids", "contrib_energies"))
    at = ["event_id", "block_no", "pos"]
    return hits.join(labels.select(*at, "cluster_id"), at, "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)).cast("bigint"))


def cluster_purity(labelled: DataFrame, lineage: DataFrame) -> DataFrame:
    """``event_id, cluster_id, ultimate_ancestor_id, total_energy_deps_in_cluster, total_energy_deps, purity``: an ancestor's energy in a cluster over its energy in all clusters of the event."""
    parts = cluster_contributions(labelled).groupBy("event_id", "cluster_id", "particle_id").agg(F.coalesce(F.sum(units("energy")), F.lit(0).cast("bigint")).alias("u"))
    known = lineage.where("ultimate_ancestor_id is not null").select(*KEY, "ultimate_ancestor_id")
    sums = parts.join(known, KEY).groupBy("event_id", "cluster_id", "ultimate_ancestor_id").agg(F.sum("u").alias("u"))
    total = F.sum("u").over(Window.partitionBy("event_id", "ultimate_ancestor_id"))
    out = sums.withColumn("t", total)
    return out.select("event_id", "cluster_id", "ultimate_ancestor_id", as_energy("u").alias("total_energy_deps_in_cluster"), as_energy("t").alias("total_energy_deps"), ratio(as_energy("u"), as_energy("t")).alias("purity"))


def best_cluster(purity: DataFrame) -> DataFrame:
    """The cluster with the highest purity per (event, ancestor); ties: the smaller cluster_id."""
    best = purity.groupBy("event_id", "ultimate_ancestor_id").agg(F.min(F.struct((-F.coalesce("purity", F.lit(-1.0))).alias("p"), "cluster_id")).alias("b"))
    return best.select("event_id", "ultimate_ancestor_id", "b.cluster_id", F.when(F.col("b.p") < 1, -F.col("b.p")).alias("purity"))


def particle_completeness(labelled: DataFrame) -> DataFrame:
    """``event_id, particle_id, completeness, is_perfect``: the largest share of a particle's energy in one cluster; noise (-1) counts in the total only; particles without energy have no row."""
    parts = cluster_contributions(labelled).groupBy("event_id", "particle_id", "cluster_id").agg(F.coalesce(F.sum(units("energy")), F.lit(0).cast("bigint")).alias("u"))
    per = parts.groupBy("event_id", "particle_id").agg(F.sum("u").alias("t"), F.coalesce(F.max(F.when(F.col("cluster_id") != -1, F.col("u"))), F.lit(0)).alias("m")).where("t <> 0")
    c = F.col("m") / F.col("t")
    return per.select("event_id", "particle_id", c.alias("completeness"), (F.abs(c - 1.0) <= 1e-6 + 1e-5).alias("is_perfect"))


def cluster_energy_purity(labelled: DataFrame) -> DataFrame:
    """``event_id, cluster_id, purity``: a cluster's hit energy over all that its contributing particles deposited in the event; 0 if that is not positive; noise has no row."""
    hits = labelled.where("cluster_id <> -1").groupBy("event_id", "cluster_id").agg(F.coalesce(F.sum(units("total_energy")), F.lit(0).cast("bigint")).alias("h"))
    parts = cluster_contributions(labelled)
    totals = parts.groupBy("event_id", "particle_id").agg(F.sum(units("energy")).alias("t"))
    named = parts.where("cluster_id <> -1").select("event_id", "cluster_id", "particle_id").distinct().join(totals, KEY).groupBy("event_id", "cluster_id").agg(F.sum("t").alias("t"))
    return hits.join(named, ["event_id", "cluster_id"], "left").select("event_id", "cluster_id", F.when(F.col("t") > 0, F.col("h") / F.col("t")).otherwise(F.lit(0.0)).alias("purity"))


def cell_residuals(calo_hits: DataFrame) -> DataFrame:
    """``event_id, block_no, pos, residual_units``: total_energy less the sum of contributions, in whole millionths; a missing total has none."""
    add = lambda s, v: s + F.coalesce(units(v), F.lit(0).cast("bigint"))
    total = F.aggregate(F.coalesce("contrib_energies", F.array().cast("array<double>")), F.lit(0).cast("bigint"), add)
    return hits_flat(calo_hits, ("total_energy", "contrib_energies")).where("total_energy is not null").select("event_id", "block_no", "pos", (units("total_energy") - total).alias("residual_units"))


def orphan_energy_fraction(particles: DataFrame, calo_hits: DataFrame) -> DataFrame:
    """``event_id, fraction``: hit energy over the energy of orphans, for events with both."""
    hits = hits_flat(calo_hits, ("total_energy",)).groupBy("event_id").agg(F.sum(units("total_energy")).alias("h"))
    own = orphans(particles_flat(particles, ("parent_id", "energy"))).where("is_parent_missing").groupBy("event_id").agg(F.sum(units("energy")).alias("o"))
    return hits.join(own, "event_id").select("event_id", ratio(as_energy("h"), as_energy("o")).alias("fraction"))


def target_truth_ratio(particles: DataFrame, tracks: DataFrame, calo_hits: DataFrame, max_eta: float = 3.5, min_pt: float = 0.5) -> DataFrame:
    """``event_id, target_energy, truth_energy, ratio``: energy of targets over that of orphans within the acceptance, for events that have both; one pass over the particles."""
    from nestra.functions import kinematics as K

    flat = targets(particles, tracks, calo_hits, ("px", "py", "pz", "energy"))
    ok = (F.abs(K.eta("px", "py", "pz")) < max_eta) & (K.pt("px", "py") > min_pt)
    sums = flat.where(ok).groupBy("event_id").agg(
        F.sum(F.when(F.col("is_target_particle"), units("energy"))).alias("t"), F.sum(F.when(F.col("is_parent_missing"), units("energy"))).alias("o"),
        F.count_if("is_target_particle").alias("nt"), F.count_if("is_parent_missing").alias("no"),
    ).where("nt > 0 and no > 0")
    return sums.select("event_id", as_energy("t").alias("target_energy"), as_energy("o").alias("truth_energy"), ratio(as_energy("t"), as_energy("o")).alias("ratio"))


def cutoff_scan(calo_hits: DataFrame, high: float = 0.005, n: int = 100) -> DataFrame:
    """``cutoff_no, cutoff, mean_ratio, mean_left``: per cutoff, the share of energy above it and the number of hits above it, averaged over events with energy (0 if there is none)."""
    # A hit is counted once, at the last cutoff below its energy; cumulative sums over the n bins per event then give all cutoffs, so hits are not multiplied by cutoffs.
    e = F.col("total_energy")
    step = F.lit(high) / F.lit(float(n - 1))
    k = F.least(F.floor(e / step) + 1, F.lit(n))
    exact = F.when((k > 0) & ~(e > (k - 1) * step), k - 1).when((k < n) & (e > k * step), k + 1).otherwise(k)  # cutoffs 0 .. exact - 1 are below e
    hits = hits_flat(calo_hits, ("total_energy",)).where("total_energy is not null").select("event_id", F.greatest(exact, F.lit(0)).alias("k"), units("total_energy").alias("u"))
    bins = hits.groupBy("event_id", "k").agg(F.sum("u").alias("u"), F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("event_id")
    above = bins.withColumn("t", F.sum("u").over(w)).where("t > 0")
    # Bin k passes cutoffs 0 .. k - 1; sums over the events come first, so that at most n + 1 rows are spread.
    per = above.groupBy("event_id", "t").agg(F.collect_list(F.struct("k", "u", "c")).alias("b"))
    lists = per.select("t", F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(i.alias("i"), F.aggregate("b", F.lit(0).cast("bigint"), lambda s, x: s + F.when(x["k"] > i, x["u"]).otherwise(F.lit(0).cast("bigint"))).alias("u"), F.aggregate("b", F.lit(0).cast("bigint"), lambda s, x: s + F.when(x["k"] > i, x["c"]).otherwise(F.lit(0).cast("bigint"))).alias("c")))).alias("r"))
    out = lists.groupBy(F.col("r.i").alias("cutoff_no")).agg(F.round(F.avg(F.col("r.u") / F.col("t")), 9).alias("mean_ratio"), F.avg("r.c").alias("mean_left"))
    return out.select("cutoff_no", (F.col("cutoff_no") * step).alias("cutoff"), "mean_ratio", "mean_left")


def detector_envelope(calo_hits: DataFrame, calibration: DataFrame) -> DataFrame:
    """Per detector the mean, least and greatest z and radius, with its label (null if unknown)."""
    r = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    h = hits_flat(calo_hits, ("detector", "x", "y", "z")).where("detector is not null").withColumn("r", r)
    stats = [f(c).alias(f"{n}_{c}") for c in ("z", "r") for n, f in (("min", F.min), ("max", F.max))] + [F.round(F.avg(c), 4).alias(f"mean_{c}") for c in ("z", "r")]
    return h.groupBy("detector").agg(*stats).join(F.broadcast(calibration.select("detector", "system_label")), "detector", "left")
