"""Connected components by random-mate contraction.

Each round every vertex tosses a coin (a hash of vertex and round). A vertex with tails that has neighbours with heads collapses into the smallest of them; edges are renamed by two joins, loops and
repeats vanish. In expectation at least a quarter of the vertices that still have edges collapse per round, however long the chains and however large the hubs are. A round is one job: the edges that are left and the moves are written as
one table, and how many edges there are is counted on the way. The moves of all rounds are then unwound: moves of ``TOGETHER`` consecutive rounds become one, until a single one is left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestra.runtime import Workspace

TOGETHER = 4  # rounds


def _coin(v: str, r: int) -> Column:
    return F.pmod(F.xxhash64("g", v, F.lit(r)), F.lit(2))


def _simple(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select("g", F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _compose(moves: list[DataFrame]) -> DataFrame:
    """Moves of consecutive rounds as one: what moved in a round is looked up in each later one."""
    out = []
    for i, move in enumerate(moves):
        for later in moves[i + 1 :]:
            onward = later.select("g", F.col("vertex").alias("root"), F.col("root").alias("next"))
            move = move.join(onward, ["g", "root"], "left").select("g", "vertex", F.coalesce("next", "root").alias("root"))
        out.append(move)
    return reduce(DataFrame.unionByName, out)


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """``g, vertex, root`` for every vertex that collapsed, from undirected edges ``g, u, v`` (bigint; a vertex is (g, u)).

    A vertex that does not come out is its own root. All vertices of a component share one root, which is one of them but not a particular one. Nulls are no vertices; loops and repeated edges
    change nothing; no edges give no rows.
    """
    round_, n = ws.count(_simple(edges.where("g is not null and u is not null and v is not null")).withColumn("moved", F.lit(False)), "true")
    empty, rounds, r = round_.select("g", F.col("u").alias("vertex"), F.col("v").alias("root")).where("false"), [], 0
    while n:
        left = round_.where("not moved").select("g", "u", "v")
        tossed = left.select("g", "u", "v", _coin("u", r).alias("cu"), _coin("v", r).alias("cv")).where("cu <> cv")
        tails = F.col("cu") == 0
        mates = tossed.groupBy("g", F.when(tails, F.col("u")).otherwise(F.col("v")).alias("child")).agg(F.min(F.when(tails, F.col("v")).otherwise(F.col("u"))).alias("parent"))
        by = lambda c: mates.select("g", F.col("child").alias(c), F.col("parent").alias(f"{c}2"))  # noqa: E731, B023
        renamed = left.join(by("u"), ["g", "u"], "left").join(by("v"), ["g", "v"], "left")
        edges = _simple(renamed.select("g", F.coalesce("u2", "u").alias("u"), F.coalesce("v2", "v").alias("v"))).withColumn("moved", F.lit(False))
        round_, n = ws.count(edges.unionByName(mates.select("g", F.col("child").alias("u"), F.col("parent").alias("v"), F.lit(True).alias("moved"))), "not moved")
        rounds.append(round_)
        r += 1
    moves = [x.where("moved").select("g", F.col("u").alias("vertex"), F.col("v").alias("root")) for x in rounds]
    while len(moves) > 1:
        moves = [ws.write(_compose(moves[k : k + TOGETHER])) for k in range(0, len(moves), TOGETHER)]
        if rounds:
            ws.drop(*rounds)
            rounds = []
    return moves[0] if moves else empty
