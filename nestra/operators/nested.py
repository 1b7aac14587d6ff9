"""Jagged tables to flat ones and back, keeping positions.

A block is a delivered row, named by (event_id, block_no); copies of it count once. Flat tables carry block_no and pos, so they regroup in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestra.runtime import UNKNOWN, Workspace, size_in_bytes
from nestra.schema import list_columns, require_columns

PARTICLE_LISTS = ("particle_id", "parent_id", "pdg_id", "is_primary", "energy", "time_ns", "vx", "vy", "vz", "px", "py", "pz")
HIT_LISTS = ("detector", "x", "y", "z", "total_energy", "contrib_particle_ids", "contrib_energies")
TRACK_LISTS = ("majority_particle_id", "phi", "theta")


#: From this size on copies are found by their narrow keys first, so that lists of blocks delivered once are not shuffled.
NARROW_FROM = 256 << 20


def repeated_blocks(df: DataFrame, ws: Workspace) -> DataFrame:
    """The (event_id, block_no) that occur more than once. Only the two columns are read and shuffled; the table is written, so that its size is known to whoever joins it."""
    named = df.where("event_id is not null and block_no is not null")
    return ws.write(named.groupBy("event_id", "block_no").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("event_id", "block_no"))


def single_and_repeated(df: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Rows of blocks that were delivered once, where they lie, and of the others one each; a row without event_id or block_no is no copy of another.

    Spark broadcasts the repeated keys if their table is small and joins by key otherwise. Copies meet by key after one row of each has been picked in every task, so a block delivered very often is no hot group.
    """
    repeated = repeated_blocks(df, ws)
    return df.join(repeated, ["event_id", "block_no"], "left_anti"), df.join(repeated, ["event_id", "block_no"], "left_semi").dropDuplicates(["event_id", "block_no"])


def distinct_blocks(df: DataFrame, narrow_from: int = NARROW_FROM) -> DataFrame:
    """One row per (event_id, block_no); copies have the same lists, so any will do. A row without event_id or block_no is no copy of another."""
    if narrow_from <= size_in_bytes(df) < UNKNOWN:
        once, one_each = single_and_repeated(df, Workspace(df.sparkSession))
        return once.unionByName(one_each)
    own = F.when(F.col("event_id").isNull() | F.col("block_no").isNull(), F.monotonically_increasing_id())
    return df.withColumn("_own", own).dropDuplicates(["event_id", "block_no", "_own"]).drop("_own")


def _empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.array()).alias(c)


def flatten(df: DataFrame, cols: tuple[str, ...] | None = None, keep: tuple[str, ...] = ("event_id", "block_no")) -> DataFrame:
    """Explode aligned list columns (default: all) together: ``*keep, pos, *cols``.

    Shorter and null lists are padded with nulls; an empty block has no rows.
    """
    cols = tuple(cols or list_columns(df))
    require_columns(df, *keep, *cols)
    return df.select(*keep, F.posexplode(F.arrays_zip(*[_empty(c) for c in cols])).alias("pos", "_r")).select(*keep, "pos", *[F.col("_r")[c].alias(c) for c in cols])


def regroup(flat: DataFrame, cols: tuple[str, ...], by: tuple[str, ...] = ("event_id", "block_no")) -> DataFrame:
    """Flat rows back to lists in the order of pos; null elements stay."""
    rows = F.array_sort(F.collect_list(F.struct("pos", *cols)))
    return flat.groupBy(*by).agg(rows.alias("_r")).select(*by, *[F.col("_r")[c].alias(c) for c in cols])  # a field of a list of records is a list


def attach(df: DataFrame, flat: DataFrame, name: str, default: Column | None = None) -> DataFrame:
    """Add the flat column ``name`` to jagged ``df`` as a list; an existing column of that name is replaced, an empty block gets an empty list."""
    lists = regroup(flat.select("event_id", "block_no", "pos", name), (name,))
    kind = lists.schema[name].dataType
    out = df.drop(name).join(lists, ["event_id", "block_no"], "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(kind)))


def particles_flat(particles: DataFrame, cols: tuple[str, ...] = PARTICLE_LISTS) -> DataFrame:
    """``event_id, block_no, pos, *cols``, one row per particle; rows without a particle_id are none."""
    cols = tuple(dict.fromkeys(("particle_id", *cols)))
    return flatten(distinct_blocks(particles.select("event_id", "block_no", *cols)), cols).where("particle_id is not null")


def hits_flat(calo_hits: DataFrame, cols: tuple[str, ...] = HIT_LISTS) -> DataFrame:
    """``event_id, block_no, pos, *cols``, one row per hit (position of x)."""
    wanted = tuple(dict.fromkeys(("x", *cols)))
    blocks = distinct_blocks(calo_hits.select("event_id", "block_no", *wanted))
    size = F.coalesce(F.array_size("x"), F.lit(0)).alias("_n")
    rows = blocks.select("event_id", "block_no", size, F.posexplode(F.arrays_zip(*[_empty(c) for c in wanted])).alias("pos", "_r")).where("pos < _n")
    return rows.select("event_id", "block_no", "pos", *[F.col("_r")[c].alias(c) for c in cols])


def contributions_flat(calo_hits: DataFrame, cols: tuple[str, ...] = ("detector",)) -> DataFrame:
    """``event_id, block_no, pos, child_pos, *cols, particle_id, energy``, one row per contribution that has an id."""
    hits = hits_flat(calo_hits, (*cols, "contrib_particle_ids", "contrib_energies"))
    pairs = F.arrays_zip(F.coalesce("contrib_particle_ids", F.array()).alias("i"), F.coalesce("contrib_energies", F.array()).alias("e"))
    rows = hits.select("event_id", "block_no", "pos", *cols, F.posexplode(pairs).alias("child_pos", "_r"))
    return rows.select("event_id", "block_no", "pos", "child_pos", *cols, F.col("_r.i").alias("particle_id"), F.col("_r.e").alias("energy")).where("particle_id is not null")


def tracks_flat(tracks: DataFrame) -> DataFrame:
    """``event_id, block_no, pos, majority_particle_id, phi, theta``."""
    return flatten(distinct_blocks(tracks.select("event_id", "block_no", *TRACK_LISTS)), TRACK_LISTS)


def list_sums(df: DataFrame, lists: str, name: str) -> DataFrame:
    """Add the sum of each inner list of a list of lists; nulls count as 0."""
    one = lambda inner: F.aggregate(F.coalesce(inner, F.array().cast("array<double>")), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    return df.withColumn(name, F.transform(lists, one))


def pick_events(df: DataFrame, *event_ids: int) -> DataFrame:
    """The rows of named events; positional rows do not exist in a distributed table."""
    return df.where(F.col("event_id").isin(*event_ids))
