"""Row-local masks on a stream of blocks: the same expressions as in batch, since they look at one row only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestra import schema
from nestra.operators.masks import add_eta_phi_pt, add_inside_calo


def stream_particles(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of particles as they arrive."""
    return spark.readStream.schema(schema.PARTICLES).parquet(path)


def with_masks(blocks: DataFrame) -> DataFrame:
    """eta, phi, pt and created_inside_calo of each block."""
    return add_inside_calo(add_eta_phi_pt(blocks))


def distinct_deliveries(blocks: DataFrame, within: str = "1 hour") -> DataFrame:
    """Copies of a block that come within ``within`` of each other count once; state older than that is dropped by the watermark."""
    return blocks.withWatermark("ingested_at", within).dropDuplicatesWithinWatermark(["event_id", "block_no"])


def arrivals(blocks: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """``start, n_blocks, n_particles`` per window of arrival."""
    per = blocks.withWatermark("ingested_at", late).groupBy(F.window("ingested_at", window).alias("w")).agg(F.count(F.lit(1)).alias("n_blocks"), F.sum(F.coalesce(F.array_size("particle_id"), F.lit(0))).alias("n_particles"))
    return per.select(F.col("w.start").alias("start"), "n_blocks", "n_particles")
