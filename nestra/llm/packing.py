"""Filling fixed-capacity containers: vector best-fit.

A container has three capacities: tokens, documents and attention cost (the sum of squared lengths). Texts go, largest first, into the open container that fits under every constraint and is left with the smallest weighted
residual norm (or has the largest weighted dot product of demand and residual). A text longer than a container is cut into full containers and one remainder, which is packed like a text.

Texts are divided by a hash into groups of about ``RUN``, each packed by itself: about one container per group is not filled well. Equal rows are counted before they are divided, so a document repeated very often is no hot
group. Groups, containers and their numbers depend on the data alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestra.arrow import numpy
from nestra.llm.tokenizer import token_counts
from nestra.runtime import Workspace

CAPACITY = 1024  # tokens
MOST_DOCS = 4096  # documents in a container
WEIGHTS = (1.0, 0.01, 0.01)  # of tokens, documents and attention cost
RUN = 20_000  # texts packed together, about
MOST_TASKS = 20_000

PACKED = "doc_id bigint, piece int, n_tokens int, container_id bigint"


class _Open:
    """Open containers by what they have left: for each number of tokens the states (documents, cost) with the containers in them."""

    def __init__(self, caps: tuple[int, int, int], weights: tuple[float, float, float], norm: bool):
        self.caps, self.weights, self.norm = caps, weights, norm
        self.states: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.there = 0  # bit r: some container has r tokens left

    def put(self, container: int, tokens: int, docs: int, cost: int) -> None:
        if docs:
            self.states.setdefault(tokens, {}).setdefault((docs, cost), []).append(container)
            self.there |= 1 << tokens

    def take(self, size: int) -> tuple[int, int, int, int] | None:
        """The best container for a text, with what it has left: of least residual norm, or of largest dot product of demand and residual. Tokens left are gone through from the best on, until no other can be better."""
        (t, d, c), (wt, wd, wc), square = self.caps, self.weights, size * size
        best, found, bits = float("inf"), None, self.there >> size
        while bits:
            k = (bits & -bits).bit_length() - 1 if self.norm else bits.bit_length() - 1
            bits ^= 1 << k
            own = wt * (k / t) ** 2 if self.norm else -wt * ((k + size) / t) * (size / t)
            if own - (0 if self.norm else wd / d + wc * square / c) >= best:
                break
            for docs, cost in self.states[k + size]:
                if cost >= square:
                    score = own + (wd * ((docs - 1) / d) ** 2 + wc * ((cost - square) / c) ** 2 if self.norm else -wd * (docs / d) / d - wc * (cost / c) * (square / c))
                    if score < best:
                        best, found = score, (k + size, docs, cost)
        if found is None:
            return None
        tokens, docs, cost = found
        level = self.states[tokens]
        container = level[docs, cost].pop()
        if not level[docs, cost]:
            del level[docs, cost]
            if not level:
                del self.states[tokens]
                self.there ^= 1 << tokens
        return container, tokens, docs, cost


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY, most_docs: int = MOST_DOCS, most_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm") -> np.ndarray:
    """The container (0, 1, ...) of each item; sizes are at most ``capacity`` and their squares at most ``most_cost`` (default: capacity squared)."""
    caps = (capacity, most_docs, most_cost or capacity * capacity)
    out = np.full(len(sizes), -1)
    order = np.lexsort((np.arange(len(sizes)), -sizes))
    open_, docs_left = _Open(caps, weights, rule == "norm"), []
    for i in order[sizes[order] > 0].tolist():
        s = int(sizes[i])
        if (got := open_.take(s)) is None:
            got = (len(docs_left), *caps)
            docs_left.append(most_docs)
        container, tokens, docs, cost = got
        out[i], docs_left[container] = container, docs - 1
        open_.put(container, tokens - s, docs - 1, cost - s * s)
    # Items of size 0 take up places only: into whatever has some, in order.
    empty = order[sizes[order] == 0]
    if len(empty):
        room, n = np.array(docs_left, np.int64), len(docs_left)
        new = max(0, -(-(len(empty) - int(room.sum())) // most_docs))
        places = np.repeat(np.arange(n + new), np.r_[room, np.full(new, most_docs)].astype(np.int64))
        out[empty] = places[: len(empty)]
    return out


def _pack(capacity: int, most_docs: int, most_cost: int | None, rule: str, t: pa.Table) -> pa.Table:
    """One group of texts -> their pieces and containers."""
    group, part, n, copies = (numpy(t.column(c)) for c in ("group", "part", "n_tokens", "copies"))
    doc = t.column("doc_id").combine_chunks()
    order = np.lexsort((part, numpy(doc.fill_null(0)), numpy(doc.is_null()), n))
    take = np.repeat(order, copies[order])
    doc, n = doc.take(pa.array(take)), n[take]
    # The largest piece that every capacity admits; only a text beyond it is cut.
    most = capacity if most_cost is None else min(capacity, math.isqrt(most_cost))
    whole = np.maximum(0, -(-n // most) - 1)
    row = np.repeat(np.arange(len(n)), whole + 1)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(whole + 1) - (whole + 1), whole + 1)
    size = np.where(piece < whole[row], most, n[row] - whole[row] * most)
    where = best_fit(size, capacity, most_docs, most_cost, rule=rule) + (int(group[0]) << 32)
    return pa.Table.from_arrays([doc.take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(where)], ["doc_id", "piece", "n_tokens", "container_id"])


def pack(documents: DataFrame, capacity: int = CAPACITY, most_docs: int = MOST_DOCS, most_cost: int | None = None, rule: str = "norm", **tokens) -> DataFrame:
    """``doc_id, piece, n_tokens, container_id``: the container of every text.

    A text has one row (piece 0) unless it alone exceeds the capacity; then its pieces of full containers and the remainder have a row each. No container exceeds ``capacity`` tokens, ``most_docs`` pieces or
    ``most_cost`` attention cost (default: capacity squared, which the tokens imply); a text whose own cost exceeds ``most_cost`` is cut, too. Null and empty texts have size 0 and take a place only. One text per row of ``documents``, repeated rows and null doc_ids included; an
    empty table gives no rows.
    """
    sizes, total = Workspace(documents.sparkSession).count(token_counts(documents, **tokens), "true")
    n = max(1, -(-total // RUN))
    equal = sizes.groupBy("doc_id", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    divided = equal.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / RUN)))).withColumn("copies", F.least(F.lit(RUN), F.col("copies") - F.col("part") * RUN))
    grouped = divided.withColumn("group", F.pmod(F.xxhash64("doc_id", "n_tokens", "part"), F.lit(n))).repartition(min(n, MOST_TASKS), "group").groupBy("group")
    return grouped.applyInArrow(lambda t: _pack(capacity, most_docs, most_cost, rule, t), PACKED)


def violations(packed: DataFrame, documents: DataFrame, capacity: int = CAPACITY, most_docs: int = MOST_DOCS, most_cost: int | None = None) -> DataFrame:
    """``kind, id``: containers over a capacity, and documents that are not packed exactly as often as they occur (pieces 0) or have an empty piece beyond the first. A right packing gives no rows."""
    n = F.col("n_tokens").cast("bigint")
    per = packed.groupBy("container_id").agg(F.sum(n).alias("t"), F.count(F.lit(1)).alias("d"), F.sum(n * n).alias("c"))
    over = per.where((F.col("t") > capacity) | (F.col("d") > most_docs) | (F.col("c") > (most_cost or capacity * capacity))).select(F.lit("container").alias("kind"), F.col("container_id").alias("id"))
    packed_as = packed.groupBy("doc_id").agg(F.count_if(F.col("piece") == 0).alias("a"), F.count_if((F.col("piece") > 0) & (F.col("n_tokens") == 0)).alias("e"))
    there = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("b"))
    both = packed_as.join(there, packed_as["doc_id"].eqNullSafe(there["doc_id"]), "full")
    wrong = both.where("a is null or b is null or a <> b or e > 0").select(F.lit("document").alias("kind"), F.coalesce(packed_as["doc_id"], there["doc_id"]).alias("id"))
    return over.unionByName(wrong)


def pack_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``n_containers, n_least, n_tokens, n_pieces``: containers used, the least that could hold all tokens, and totals."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("p"))
    tokens = F.coalesce(F.sum("t"), F.lit(0)).cast("bigint")
    return per.agg(F.count(F.lit(1)).alias("n_containers"), F.ceil(tokens / capacity).cast("bigint").alias("n_least"), tokens.alias("n_tokens"), F.coalesce(F.sum("p"), F.lit(0)).cast("bigint").alias("n_pieces"))
