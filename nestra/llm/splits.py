"""Splits that keep related records together: events of common origin by contraction, then whole groups by cumulative weight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestra.llm.contraction import components
from nestra.runtime import Workspace

SHARES = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
#: A group with at least total / HEAVY rows is placed one by one; there are at most HEAVY of them.
HEAVY = 1000
BUCKETS = 4096


def _labels(origins: DataFrame, ws: Workspace) -> DataFrame:
    """``vertex, root`` of the events that have a relative."""
    known = origins.where("event_id is not null").select("event_id", "gen_seed", "resim_of")
    seeded = known.where("gen_seed is not null and gen_seed <> 0").select("event_id", "gen_seed").distinct()
    hubs = seeded.groupBy("gen_seed").agg(F.min("event_id").alias("hub"))
    same_seed = seeded.join(hubs, "gen_seed").select(F.col("event_id").alias("u"), F.col("hub").alias("v"))
    again = known.where("resim_of is not null").select(F.col("event_id").alias("u"), F.col("resim_of").alias("v"))
    edges = same_seed.unionByName(again).select(F.lit(0).cast("bigint").alias("g"), "u", "v")
    return components(edges, ws).select("vertex", "root")


def common_origin(origins: DataFrame) -> DataFrame:
    """``first_event_id, event_id``: each listed event that is not the smallest listed one of its group, with that smallest one.

    Events have common origin if they share a recorded gen_seed (not null, not 0), if one is resim_of the other, if both are resim_of the same event (listed or not), or through further events. Rows
    without event_id list nothing; repeated rows and an event that is resim_of itself change nothing; an empty table gives no rows.
    """
    ws = Workspace(origins.sparkSession)
    labels = _labels(origins, ws)
    listed = origins.where("event_id is not null").select("event_id").distinct()
    named = listed.join(labels.withColumnRenamed("vertex", "event_id"), "event_id", "left").select("event_id", F.coalesce("root", "event_id").alias("root"))
    firsts = named.groupBy("root").agg(F.min("event_id").alias("first_event_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return named.join(firsts, "root").where("event_id <> first_event_id").select("first_event_id", "event_id")


def _place_heavy(heavy: list[tuple[int, int]], total: int) -> tuple[dict[int, str], dict[str, float]]:
    """Largest first into the split that lacks most; returns the places and what of the rest each split is due: lacks, scaled so that they sum up to the rest. A split that has too much gets none of it."""
    lack = {name: share * total for name, share in SHARES}
    places = {}
    for weight, group in sorted(((w, g) for g, w in heavy), key=lambda x: (-x[0], x[1])):
        name = max(lack, key=lack.get)
        places[group] = name
        lack[name] -= weight
    due = {name: max(0.0, x) for name, x in lack.items()}
    rest, lacking = total - sum(w for _, w in heavy), sum(due.values())
    return places, {name: x * rest / lacking if lacking else 0.0 for name, x in due.items()}


def splits(particles: DataFrame, calo_hits: DataFrame, origins: DataFrame) -> DataFrame:
    """``event_id, split, group_id``: train, validation or test of every event_id of particles and calo_hits.

    Events of common origin share a group and thereby a split; 80/10/10 is met by the number of blocks of calo_hits (copies once). Groups with at least a thousandth of the rows go, largest first, to the split that
    lacks most; all others follow in hashed order by cumulative weight, so the shares are met to about a thousandth. Where one group holds more than a split's share, what is left is divided between the other splits in proportion to
    their shares. If no block is in calo_hits, every group counts as one. Null event ids are no events; an
    event without blocks has weight 0; empty tables give no rows. The same data give the same splits.
    """
    spark = particles.sparkSession
    ws = Workspace(spark)
    labels = _labels(origins, ws).withColumnRenamed("vertex", "event_id")
    weights = calo_hits.where("event_id is not null").select("event_id", "block_no").distinct().groupBy("event_id").agg(F.count(F.lit(1)).alias("w"))
    every = particles.where("event_id is not null").select("event_id").distinct().join(weights, "event_id", "full")
    events = ws.write(every.join(labels, "event_id", "left").select("event_id", F.coalesce("root", "event_id").alias("group_id"), F.coalesce("w", F.lit(0)).alias("w")))
    groups = ws.write(events.groupBy("group_id").agg(F.sum("w").alias("w")))
    count, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    if not total:
        groups, total = groups.withColumn("w", F.lit(1).cast("bigint")), count
    heavy = [(r.group_id, r.w) for r in groups.where(F.col("w") * HEAVY >= total).collect()] if total else []  # at most HEAVY rows
    places, due = _place_heavy(heavy, total)
    # Cumulative weight of the rest in two steps: over buckets, then within each bucket.
    placed = spark.createDataFrame(list(places.items()), "group_id bigint, split string")
    light = groups.where(F.col("w") * HEAVY < total).withColumn("h", F.xxhash64("group_id")).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    starts = light.groupBy("bucket").agg(F.sum("w").alias("bw")).withColumn("start", F.sum("bw").over(Window.orderBy("bucket")) - F.col("bw")).select("bucket", "start")  # BUCKETS rows
    run = F.sum("w").over(Window.partitionBy("bucket").orderBy("h", "group_id").rowsBetween(Window.unboundedPreceding, 0))
    middle = light.join(F.broadcast(starts), "bucket").withColumn("middle", F.col("start") + run - F.col("w") / 2)
    train, validation = due["train"], due["validation"]
    split = F.when(F.col("middle") < train, "train").when(F.col("middle") < train + validation, "validation").otherwise("test")
    chosen = middle.select("group_id", split.alias("split")).unionByName(placed)
    return events.join(chosen, "group_id").select("event_id", "split", "group_id")


def crossing(assigned: DataFrame, origins: DataFrame) -> DataFrame:
    """``event_id, n_splits``: events in several splits, and listed events whose gen_seed or resim_of leads to an event in another split (with the number of splits there). Right splits give no rows."""
    known = assigned.select("event_id", "split")
    twice = known.groupBy("event_id").agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")
    listed = origins.where("event_id is not null").join(known, "event_id")
    shared = listed.where("gen_seed is not null and gen_seed <> 0").select(F.lit("seed").alias("kind"), F.col("gen_seed").alias("key"), "event_id", "split")
    again = listed.where("resim_of is not null").select(F.lit("event").alias("kind"), F.col("resim_of").alias("key"), "event_id", "split")
    itself = known.select(F.lit("event").alias("kind"), F.col("event_id").alias("key"), "event_id", "split")
    apart = shared.unionByName(again).unionByName(itself).groupBy("kind", "key").agg(F.min("event_id").alias("event_id"), F.count_distinct("split").alias("n_splits")).where("n_splits > 1")
    return twice.unionByName(apart.select("event_id", "n_splits"))


def shares_met(assigned: DataFrame, calo_hits: DataFrame, within: float = 0.02) -> DataFrame:
    """``split, is_met``: whether each split's part of the blocks of calo_hits is its share to ``within`` of all blocks (no group larger than a share may stand in the way)."""
    total = F.sum("n_blocks").over(Window.partitionBy(F.lit(0)))  # of three rows
    want = F.create_map(*[F.lit(x) for pair in SHARES for x in pair])[F.col("split")]
    return split_report(assigned, calo_hits).select("split", (F.abs(F.col("n_blocks") - want * total) <= within * total).alias("is_met"))


def split_report(assigned: DataFrame, calo_hits: DataFrame) -> DataFrame:
    """``split, n_events, n_blocks``: what each split got."""
    weights = calo_hits.where("event_id is not null").select("event_id", "block_no").distinct().groupBy("event_id").agg(F.count(F.lit(1)).alias("w"))
    return assigned.join(weights, "event_id", "left").groupBy("split").agg(F.count(F.lit(1)).alias("n_events"), F.coalesce(F.sum("w"), F.lit(0)).cast("bigint").alias("n_blocks"))
