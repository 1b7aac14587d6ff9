"""Per-key sums where a few keys hold most rows: multi-level tree aggregation.

A chunk is what a task reads (a split of bounded size of the files), never the rows of a key, so a hot key is spread over all chunks. Each chunk is combined where it lies, before anything is
shuffled; its per-key states then merge in rounds of ``fan_in``: after round i a node holds the states of ``fan_in ** i`` chunks. A key, however hot, therefore reaches any task as at most about ``fan_in`` states instead of one
per chunk. States are sums of whole numbers, so the result depends on the rows alone and not on how they were cut.

Redelivered blocks are found by their narrow keys first (see nested), so only their rows are shuffled whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestra.operators.nested import single_and_repeated
from nestra.runtime import Workspace, pieces

#: Bytes of input in a chunk, about (what a task reads is for Spark's settings to say; this gives the number of rounds), and states merged at once.
CHUNK_BYTES = 4 << 20
FAN_IN = 8
#: Energies are summed as whole numbers of this fraction, so that the order of merging does not matter.
ENERGY_UNIT = 1_000_000


def tree_levels(n_chunks: int, fan_in: int = FAN_IN) -> int:
    """Rounds until one node is left."""
    return max(1, math.ceil(math.log(max(2, n_chunks), fan_in) - 1e-9))


def tree_sum(df: DataFrame, chunk: str, keys: list[str], sums: list[str], levels: int, fan_in: int = FAN_IN) -> DataFrame:
    """Sum ``sums`` by ``keys`` through ``levels`` rounds of merging; ``chunk`` has the leaf (0 .. fan_in ** levels - 1) of each row.

    If each task of ``df`` has rows of one chunk, each round shuffles one state per node and key. Nulls count as 0; a null key is a key; an empty frame gives no rows.
    """
    state = df
    for _ in range(levels):
        state = state.withColumn(chunk, F.floor(F.col(chunk) / fan_in).cast("int")).groupBy(chunk, *keys).agg(*[F.sum(c).alias(c) for c in sums])
    return state.select(*keys, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in sums])


def whole_units(energy: Column | str) -> Column:
    """An energy as a whole number of units; null, NaN, infinite and energies of 9e12 or more (which no number of units holds) are null."""
    e = F.col(energy) if isinstance(energy, str) else energy
    return F.when(F.abs(e) < 9e12, F.floor(e * ENERGY_UNIT + 0.5).cast("bigint"))


def key_sums(calo_hits: DataFrame, chunk_bytes: int = CHUNK_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """Sums of calo_hits per event_id ('event') and per id in contrib_particle_ids ('contributor').

    Result: ``key_kind, key_id, n_blocks, n_hits, n_contribs, energy_units``. Redelivered blocks count once. For an event n_hits and energy_units are of its hits
    (total_energy), n_contribs the non-null ids in it; for a contributor n_blocks and n_hits are null, n_contribs how often the id occurs and energy_units the energies at
    the same positions. Null ids are no keys; an id without an energy counts with energy 0; blocks without hits count as blocks; null event ids make one
    key of their own; a row without event_id or block_no is no copy of another. Only the columns named here are read, others may be there.
    """
    leaves = fan_in ** (levels := tree_levels(pieces(calo_hits, chunk_bytes, 2), fan_in))
    rows = calo_hits.select("event_id", "block_no", "x", "total_energy", "contrib_particle_ids", "contrib_energies")
    once, one_each = single_and_repeated(rows, Workspace(calo_hits.sparkSession))
    blocks = once.unionByName(one_each).withColumn("chunk", F.pmod(F.spark_partition_id(), F.lit(leaves)))
    own = lambda c: F.coalesce(c, F.array()).alias(c)
    hits = blocks.select(
        "chunk", "event_id", F.coalesce(F.array_size("x"), F.lit(0)).alias("n_x"),
        F.posexplode_outer(F.arrays_zip(own("x"), own("total_energy"), own("contrib_particle_ids"), own("contrib_energies"))).alias("hit_pos", "h"),
    )
    first_hit = F.coalesce(F.col("hit_pos") == 0, F.lit(True))
    empty = lambda c: F.coalesce(c, F.array())
    parts = hits.select(
        "chunk", "event_id", first_hit.alias("first_hit"), (F.col("hit_pos") < F.col("n_x")).alias("is_hit"), F.col("h.total_energy").alias("hit_energy"),
        F.posexplode_outer(F.arrays_zip(empty(F.col("h.contrib_particle_ids")).alias("i"), empty(F.col("h.contrib_energies")).alias("e"))).alias("pos", "c"),
    )
    first = F.coalesce(F.col("pos") == 0, F.lit(True))
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    units = lambda cond, e: F.coalesce(F.sum(F.when(cond, whole_units(F.col(e)))), F.lit(0).cast("bigint"))
    leaf = parts.groupBy("chunk", "event_id", F.col("c.i").alias("id")).agg(
        count(F.col("first_hit") & first).alias("n_blocks"), count(F.col("is_hit") & first).alias("n_hits"), count(F.col("c.i").isNotNull()).alias("n_contribs"),
        units(F.col("is_hit") & first, "hit_energy").alias("hit_units"), units(F.col("c.i").isNotNull(), "c.e").alias("contrib_units"),
    )
    none = F.lit(0).cast("bigint")
    as_event = F.struct(F.lit("event").alias("key_kind"), F.col("event_id").alias("key_id"), "n_blocks", "n_hits", "n_contribs", F.col("hit_units").alias("energy_units"))
    as_id = F.struct(F.lit("contributor").alias("key_kind"), F.col("id").alias("key_id"), none.alias("n_blocks"), none.alias("n_hits"), "n_contribs", F.col("contrib_units").alias("energy_units"))
    state = leaf.select("chunk", F.explode(F.array(as_event, as_id)).alias("s")).select("chunk", "s.*").where("key_kind = 'event' or key_id is not null")
    sums, keys = ["n_blocks", "n_hits", "n_contribs", "energy_units"], ["key_kind", "key_id"]
    out = tree_sum(state, "chunk", keys, sums, levels, fan_in)
    of_event = F.col("key_kind") == "event"
    return out.select(*keys, F.when(of_event, F.col("n_blocks")).alias("n_blocks"), F.when(of_event, F.col("n_hits")).alias("n_hits"), "n_contribs", "energy_units")


def hot_keys(calo_hits: DataFrame, event_per_mille: int = 40, contributor_per_mille: int = 15, **tuning) -> DataFrame:
    """Keys with at least the given thousandths of all blocks (events) or of all non-null contributing ids (contributors): ``key_kind, key_id``.

    Totals are exact and over all rows; a key exactly at the limit is in. A null event_id counts in the total and is not reported.
    """
    sums = key_sums(calo_hits, **tuning)
    count = F.when(F.col("key_kind") == "event", F.col("n_blocks")).otherwise(F.col("n_contribs"))
    least = F.when(F.col("key_kind") == "event", F.lit(event_per_mille)).otherwise(F.lit(contributor_per_mille))
    # One row per key is written once; the totals and the comparison both read it.
    sized = Workspace(calo_hits.sparkSession).write(sums.select("key_kind", "key_id", count.alias("n"), least.alias("least")))
    totals = sized.groupBy("key_kind").agg(F.sum("n").alias("total"))  # two rows
    return sized.join(F.broadcast(totals), "key_kind").where("n * 1000 >= total * least and key_id is not null").select("key_kind", "key_id")
