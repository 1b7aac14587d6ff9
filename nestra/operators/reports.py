"""Counts, confusion matrices, top lists and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestra.functions.kinematics import histogram_bin
from nestra.operators.masks import KEY, orphans
from nestra.operators.nested import hits_flat, particles_flat


def count_rows() -> Column:
    return F.count(F.lit(1))


def confusion(flags: DataFrame, a: str, b: str) -> DataFrame:
    """``both_true, a_only, b_only, both_false, accuracy, jaccard`` of two masks; rows where either is null are in no cell."""
    x, y = F.col(a), F.col(b)
    cells = {"both_true": x & y, "a_only": x & ~y, "b_only": ~x & y, "both_false": ~x & ~y}
    out = flags.agg(*[F.count_if(c).alias(n) for n, c in cells.items()])
    every = F.col("both_true") + F.col("a_only") + F.col("b_only") + F.col("both_false")
    return out.withColumns({"accuracy": F.try_divide(F.col("both_true") + F.col("both_false"), every), "jaccard": F.try_divide(F.col("both_true"), F.col("both_true") + F.col("a_only") + F.col("b_only"))})


def primary_pairs(particles: DataFrame, head: int = 20) -> DataFrame:
    """The ``head`` most frequent (pdg_id, parent_pdg_id) of primary particles whose parent is there; ties by the codes."""
    flat = particles_flat(particles, ("parent_id", "pdg_id", "is_primary")).select(*KEY, "parent_id", "pdg_id", "is_primary")
    parents = flat.select("event_id", F.col("particle_id").alias("parent_id"), F.col("pdg_id").alias("parent_pdg_id"))
    n = flat.where("is_primary").join(parents, ["event_id", "parent_id"]).groupBy("pdg_id", "parent_pdg_id").agg(count_rows().alias("n"))
    return n.orderBy(F.desc("n"), "pdg_id", "parent_pdg_id").limit(head)


def top_primary_codes(particles: DataFrame, head: int = 10) -> DataFrame:
    """The most frequent pdg_id of primary particles whose parent is there; ties by the code."""
    flat = orphans(particles_flat(particles, ("parent_id", "pdg_id", "is_primary")))
    return flat.where("is_primary and not is_parent_missing").groupBy("pdg_id").agg(count_rows().alias("n")).orderBy(F.desc("n"), "pdg_id").limit(head)


def per_event(particles: DataFrame, predicate: Column | str, cols: tuple[str, ...]) -> DataFrame:
    """``event_id, n``: particles that satisfy ``predicate``, for events that have any."""
    return particles_flat(particles, cols).where(predicate).groupBy("event_id").agg(count_rows().alias("n"))


def histogram(values: DataFrame, column: str, low: float, high: float, n: int) -> DataFrame:
    """``bin, n`` over equal widths, the last bin closed; values outside and nulls are left out, empty bins too."""
    return values.select(histogram_bin(column, low, high, n).alias("bin")).where("bin is not null").groupBy("bin").agg(count_rows().alias("n"))


def production_times(particles: DataFrame, first_events: int | None = None, predicate: Column | str | None = None) -> DataFrame:
    """``n, mean_time, max_time`` of known production times; of the first events by event_id if a number is given."""
    flat = particles_flat(particles, ("time_ns", "is_primary")).where("time_ns is not null")
    if predicate is not None:
        flat = flat.where(predicate)
    if first_events is not None:
        flat = flat.join(first(particles, first_events), "event_id", "left_semi")
    return flat.agg(count_rows().alias("n"), F.round(F.avg("time_ns"), 6).alias("mean_time"), F.max("time_ns").alias("max_time"))


def first(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest event_ids; a ValueError for n < 1."""
    if n < 1:
        raise ValueError("at least one event is needed")
    return df.where("event_id is not null").select("event_id").distinct().orderBy("event_id").limit(n)


def unique_cells(calo_hits: DataFrame, first_events: int | None = None) -> DataFrame:
    """``detector, kx, ky, kz, event_id, block_no, pos``: each cell (position in whole 10 nm) once, at its first hit by (event_id, block_no, pos)."""
    h = hits_flat(calo_hits, ("detector", "x", "y", "z")).where("x is not null and y is not null and z is not null")
    if first_events is not None:
        h = h.join(first(calo_hits, first_events), "event_id", "left_semi")
    keys = [F.floor(F.col(c) * 1e5 + 0.5).alias(f"k{c}") for c in "xyz"]
    best = h.groupBy("detector", *keys).agg(F.min(F.struct("event_id", "block_no", "pos")).alias("f"))
    return best.select("detector", "kx", "ky", "kz", "f.event_id", "f.block_no", "f.pos")


def named(df: DataFrame, names: DataFrame, code: str = "pdg_id") -> DataFrame:
    """Adds ``name`` of a code, or the code itself as text."""
    return df.join(F.broadcast(names.select(F.col("pdg_id").alias(code), "name")), code, "left").withColumn("name", F.coalesce("name", F.col(code).cast("string")))  # a fixed table of a few rows


def code_of(names: DataFrame, *wanted: str) -> DataFrame:
    """``name, pdg_id`` of the given names."""
    return names.where(F.col("name").isin(*wanted)).select("name", "pdg_id")


def purity_detail(purity: DataFrame, n_bins: int = 50, high: float = 1.5, most: int = 15) -> DataFrame:
    """``bin, n, clusters, n_more``: left-closed bins of cluster purity over [0, high), with the first ``most`` clusters (event_id, cluster_id) of each and how many more there are."""
    rows = purity.where((F.col("purity") >= 0) & (F.col("purity") < high)).withColumn("bin", F.floor(F.col("purity") / (high / n_bins)))
    w = Window.partitionBy("bin", "_salt").orderBy("event_id", "cluster_id")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("event_id", "cluster_id"), F.lit(64))).withColumn("_r", F.row_number().over(w))
    n = rows.groupBy("bin").agg(count_rows().alias("n"))
    heads = salted.where(F.col("_r") <= most).groupBy("bin").agg(F.slice(F.array_sort(F.collect_list(F.struct("event_id", "cluster_id"))), 1, most).alias("c"))  # at most 64 * most in each list
    text = F.array_join(F.transform("c", lambda c: F.concat(c["event_id"].cast("string"), F.lit(":"), c["cluster_id"].cast("string"))), ",")
    return n.join(heads, "bin").select("bin", "n", text.alias("clusters"), F.greatest(F.col("n") - most, F.lit(0)).alias("n_more"))
