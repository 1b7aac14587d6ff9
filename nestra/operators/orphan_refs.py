"""References to records that do not exist: range-partitioned keys, sorted arrays, binary search.

1. Keys (event_id, particle_id) with their earliest arrival are range-partitioned into at most ``MOST_RANGES`` ranges and sorted there; each range becomes rows (chunks) of sorted arrays of about ``RANGE_KEYS`` keys, written as
   a table. Copies of a key always fall into one chunk. Only the first key of each range, a list of bounded length, is sent with the code.
2. Blocks of references are read in Arrow batches; binary search over the first keys gives each reference its range. Nearly always a whole block goes to one range and stays one row; only where an event spans several ranges
   are its blocks divided. Where ranges have several chunks, references and the chunks' first keys meet by range (salted), and the same search gives the chunk.
3. Chunks with many references are divided into salts, by the block, so that the copies of a block stay together; the chunk's arrays are given to each of its salts. A hot event's references therefore never meet in one task.
4. Each (range, chunk, salt) probes its references by one vectorised binary search and returns the misses.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestra.arrow import array, numpy
from nestra.runtime import Workspace, pieces

RANGE_KEYS = 1 << 17  # keys in a chunk, about
MOST_RANGES = 4096  # ranges of the first level; all that the driver ever holds is one key of each
TASK_REFS = 1 << 20  # references in a (range, chunk, salt), about
BYTES_A_KEY = 2  # of compressed input, for the number of ranges

NEVER = np.iinfo(np.int64).max  # arrival of what never arrived
KINDS = ("particles", "calo_hits")

_STORE = "chunk int, first_event bigint, first_id bigint, events array<bigint>, ids array<bigint>, arrivals array<bigint>, withdrawn array<boolean>"
_REFS = "range_id int, chunk int, spread int, kind int, event_id bigint, block_no int, run_no int, arrival bigint, n int, holders array<bigint>, refs array<bigint>"
_MISSES = "ref_table string, run_no int, event_id bigint, holder_id bigint, ref_id bigint, status string"


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and flat values of a list column without null lists and elements."""
    col = array(col)
    return numpy(col.value_lengths()).astype(np.int64), numpy(col.flatten())


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values))


def _chunk(number: int, e, i, a, w) -> pa.RecordBatch:
    cols = [pa.array([number], pa.int32()), pa.array(e[:1]), pa.array(i[:1]), *(_lists(x, np.array([len(x)])) for x in (e, i, a)), pa.ListArray.from_arrays(pa.array([0, len(w)], pa.int32()), pa.array(w))]
    return pa.RecordBatch.from_arrays(cols, ["chunk", "first_event", "first_id", "events", "ids", "arrivals", "withdrawn"])


def _store(range_keys: int, batches):
    """All keys of one range, sorted by key and arrival, as chunks. No more than a chunk and a batch is held."""
    number, held = 0, [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
    for b in batches:
        if not b.num_rows:
            continue
        e, i, a, w = (np.concatenate([h, numpy(b.column(c))]) for h, c in zip(held, ("event_id", "particle_id", "arrival", "withdrawn"), strict=True))
        at = np.flatnonzero(np.r_[True, (e[1:] != e[:-1]) | (i[1:] != i[:-1])])
        held = [e[at], i[at], a[at], np.logical_or.reduceat(w, at)]  # of a key the earliest arrival
        while len(held[0]) > range_keys:  # the last key may go on, so it stays
            yield _chunk(number, *(h[:range_keys] for h in held))
            number, held = number + 1, [h[range_keys:] for h in held]
    if len(held[0]):
        yield _chunk(number, *held)


def _numbered(bound_e: np.ndarray, bound_i: np.ndarray, batches):
    """Chunks with the number of their range."""
    for b in batches:
        rng = _rank(bound_e, bound_i, numpy(b.column("first_event")), numpy(b.column("first_id"))) - 1
        yield pa.RecordBatch.from_arrays([pa.array(rng.astype(np.int32)), *b.columns], ["range_id", *b.schema.names])


def _rank(events: np.ndarray, ids: np.ndarray, e: np.ndarray, i: np.ndarray) -> np.ndarray:
    """How many of the sorted keys (events, ids) are at or before each (e, i): a binary search on both parts at once."""
    lo, hi = np.searchsorted(events, e, "left"), np.searchsorted(events, e, "right")
    while (open_ := lo < hi).any():
        k = np.flatnonzero(open_)
        mid = (lo[k] + hi[k]) // 2
        right = ids[mid] <= i[k]
        lo[k] = np.where(right, mid + 1, lo[k])
        hi[k] = np.where(right, hi[k], mid)
    return lo


def _route(bound_e: np.ndarray, bound_i: np.ndarray, second: bool, t) -> pa.Table | None:
    """Blocks with (holders and) refs lists -> rows of one range, or at the second level of one chunk, each."""
    if not t.num_rows:
        return None
    e, kind = numpy(t.column("event_id")), numpy(t.column("kind"))
    n, refs = _flat(t.column("refs"))
    n_holders, some = _flat(t.column("holders"))
    row = np.repeat(np.arange(len(e)), n)
    holders = np.zeros(len(row), np.int64)
    holders[np.repeat(n_holders > 0, n)] = some
    if len(bound_e):
        lo, hi = np.searchsorted(bound_e, e, "left"), np.searchsorted(bound_e, e, "right")
        to = np.maximum(lo - 1, 0)[row]
        if len(k := np.flatnonzero((lo < hi)[row])):  # events in which a range begins
            to[k] = np.maximum(_rank(bound_e, bound_i, e[row[k]], refs[k]) - 1, 0)
    else:
        to = np.zeros(len(row), np.int64)
    child = (kind == 0)[row]
    order = np.lexsort((np.where(child, 0, refs), to, row))
    row, to, refs, holders, child = row[order], to[order], refs[order], holders[order], child[order]
    keep = np.r_[True, (row[1:] != row[:-1]) | (refs[1:] != refs[:-1]) | child[1:]][: len(row)]  # a contributing id counts once in a block
    row, to, refs, holders, child = row[keep], to[keep], refs[keep], holders[keep], child[keep]
    if not len(row):
        return None
    at = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (to[1:] != to[:-1])])
    size, own = np.diff(np.r_[at, len(row)]), pa.array(row[at])
    cols = {c: t.column(c).take(own) for c in ("spread", "kind", "event_id", "block_no", "run_no", "arrival")}
    cols |= {"n": pa.array(size.astype(np.int32)), "holders": _lists(holders[child], np.where(child[at], size, 0)), "refs": _lists(refs, size)}
    to = pa.array(to[at].astype(np.int32))
    cols |= {"range_id": t.column("range_id").take(own), "chunk": to} if second else {"range_id": to, "chunk": pa.array(np.zeros(len(at), np.int32))}
    return pa.Table.from_pydict({c.split()[0]: cols[c.split()[0]] for c in _REFS.split(", ")})


def _to_ranges(bound_e: np.ndarray, bound_i: np.ndarray, batches):
    for b in batches:
        if (out := _route(bound_e, bound_i, False, b)) is not None:
            yield from out.to_batches()


def _to_chunks(refs: pa.Table, fences: pa.Table) -> pa.Table:
    """References of one range, given the first keys of its chunks."""
    if not refs.num_rows:
        return refs.select([c.split()[0] for c in _REFS.split(", ")])
    order = np.argsort(numpy(fences.column("chunk"))) if fences.num_rows else np.zeros(0, np.int64)
    e, i = (numpy(fences.column(c))[order] if fences.num_rows else np.zeros(0, np.int64) for c in ("first_event", "first_id"))
    return _route(e, i, True, refs)


def _probe(refs: pa.Table, store: pa.Table) -> pa.Table:
    """The misses of one (range, salt)."""
    names = ["ref_table", "run_no", "event_id", "holder_id", "ref_id", "status"]
    schema = pa.schema(list(zip(names, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)))
    if not refs.num_rows:
        return schema.empty_table()
    kind, e, block, arrival = (numpy(refs.column(c)) for c in ("kind", "event_id", "block_no", "arrival"))
    order = np.lexsort((arrival, block, e, kind))  # of a block's copies the earliest counts
    k, ee, bb = kind[order], e[order], block[order]
    refs = refs.take(pa.array(order[np.r_[True, (k[1:] != k[:-1]) | (ee[1:] != ee[:-1]) | (bb[1:] != bb[:-1])]]))
    kind, e, block, arrival = (numpy(refs.column(c)) for c in ("kind", "event_id", "block_no", "arrival"))
    n, ids = _flat(refs.column("refs"))
    row = np.repeat(np.arange(len(n)), n)
    holder = block[row].astype(np.int64)
    if (kind == 0).any():
        holder[kind[row] == 0] = _flat(refs.column("holders"))[1]
    there, gone = np.full(len(row), NEVER), np.zeros(len(row), bool)
    if store.num_rows:
        se, si, sa, sw = (_flat(store.column(c))[1] for c in ("events", "ids", "arrivals", "withdrawn"))
        at = _rank(se, si, e[row], ids) - 1
        found = at >= 0
        found[found] = (se[at[found]] == e[row][found]) & (si[at[found]] == ids[found])
        there[found], gone[found] = sa[at[found]], sw[at[found]]
    bad = np.flatnonzero(there > arrival[row])
    status = np.where(there[bad] != NEVER, 0, np.where(gone[bad], 1, 2))
    run = refs.column("run_no").combine_chunks().take(pa.array(row[bad]))
    pick = lambda words, codes: pa.array(np.array(words, object)[codes], pa.string())
    out = [pick(KINDS, kind[row][bad]), run, pa.array(e[row][bad]), pa.array(holder[bad]), pa.array(ids[bad]), pick(("late", "withdrawn", "missing"), status)]
    return pa.Table.from_arrays(out, schema=schema)


def _micros(c: str):
    # A row of unknown arrival is taken to have arrived last, just before "never".
    return F.coalesce(F.unix_micros(c), F.lit(int(NEVER) - 1))


def orphan_references(particles: DataFrame, calo_hits: DataFrame, withdrawn: DataFrame, range_keys: int = RANGE_KEYS, task_refs: int = TASK_REFS, most_ranges: int = MOST_RANGES) -> DataFrame:
    """References that have no particle when their row arrives: ``ref_table, run_no, event_id, holder_id, ref_id, status``.

    One row per distinct reference. A reference is a parent_id of particles (holder: the child's particle_id) or an id among contrib_particle_ids of a block of calo_hits
    (holder: block_no); null and 0 refer to nothing. status: 'late' - the particle arrived after the referring row; 'withdrawn' - it never arrived and is named in
    ``withdrawn``; 'missing' - neither. Copies count once, at their earliest ingested_at. A null ingested_at counts as the last possible arrival. Rows without event_id or block_no, and children
    without a particle_id, name no holder and are left out; parent lists shorter than particle_id refer to nothing beyond their end. Empty tables give no keys or no references.
    """
    spark = particles.sparkSession
    ws = Workspace(spark)
    known = particles.where("event_id is not null").select("event_id", F.explode("particle_id").alias("particle_id"), _micros("ingested_at").alias("arrival"), F.lit(False).alias("withdrawn"))
    taken = withdrawn.where("event_id is not null").select("event_id", "particle_id", F.lit(int(NEVER)).alias("arrival"), F.lit(True).alias("withdrawn"))
    keys = known.unionByName(taken).where("particle_id is not null")
    n_ranges = min(most_ranges, pieces(particles.select("event_id", "particle_id"), range_keys * BYTES_A_KEY))
    sorted_keys = keys.repartitionByRange(n_ranges, "event_id", "particle_id").sortWithinPartitions("event_id", "particle_id", "arrival")
    store = ws.write(sorted_keys.mapInArrow(partial(_store, range_keys), _STORE))
    firsts = store.where("chunk <= 1").select("first_event", "first_id", "chunk").collect()  # at most two keys of each of at most MOST_RANGES ranges
    bounds = sorted((r[0], r[1]) for r in firsts if r.chunk == 0)
    bound_e, bound_i = np.array([b[0] for b in bounds], np.int64), np.array([b[1] for b in bounds], np.int64)
    store = store.mapInArrow(partial(_numbered, bound_e, bound_i), f"range_id int, {_STORE}")

    spread = F.pmod(F.xxhash64("event_id", "block_no"), F.lit(1 << 20)).cast("int").alias("spread")
    base = ["event_id", "block_no", "run_no", _micros("ingested_at").alias("arrival"), spread]
    pairs = F.filter(F.arrays_zip(F.col("particle_id").alias("h"), F.col("parent_id").alias("r")), lambda p: p["h"].isNotNull() & p["r"].isNotNull() & (p["r"] != 0))
    named = "event_id is not null and block_no is not null"
    children = particles.where(named).select(*base, pairs.alias("p")).where("size(p) > 0").select("event_id", "block_no", "run_no", "arrival", "spread", F.lit(0).alias("kind"), F.col("p.h").alias("holders"), F.col("p.r").alias("refs"))
    ids = F.filter(F.flatten(F.filter("contrib_particle_ids", lambda a: a.isNotNull())), lambda i: i.isNotNull() & (i != 0))
    contribs = calo_hits.where(named).select(*base, F.lit(1).alias("kind"), F.array().cast("array<bigint>").alias("holders"), ids.alias("refs")).where("size(refs) > 0")
    route = lambda df: df.mapInArrow(partial(_to_ranges, bound_e, bound_i), _REFS)
    refs = ws.write(route(children).unionByName(route(contribs)))

    def salted(refs: DataFrame, store: DataFrame, key: list[str]):
        """Both sides with salts. The table that says how many has a row for each key with more than one; Spark broadcasts it if its written size is small, else joins by key."""
        salts = ws.write(refs.groupBy(*key).agg(F.ceil(F.sum("n") / task_refs).cast("int").alias("salts")).where("salts > 1"))
        many = F.coalesce("salts", F.lit(1))
        left = refs.join(salts, key, "left").withColumn("salt", F.pmod("spread", many).cast("int")).drop("salts")
        right = store.join(salts, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), many - 1))).drop("salts")
        return left.groupBy(*key, "salt"), right.groupBy(*key, "salt")

    if len(firsts) > len(bounds):
        left, right = salted(refs, store.select("range_id", "chunk", "first_event", "first_id"), ["range_id"])
        refs = ws.write(left.cogroup(right).applyInArrow(lambda a, b: _to_chunks(a, b), _REFS))
    left, right = salted(refs, store.select("range_id", "chunk", "events", "ids", "arrivals", "withdrawn"), ["range_id", "chunk"])
    return left.cogroup(right).applyInArrow(lambda a, b: _probe(a, b), _MISSES)


def orphan_report(misses: DataFrame) -> DataFrame:
    """The number of orphan references per table, run and status: ``ref_table, run_no, status, n_refs``."""
    return misses.groupBy("ref_table", "run_no", "status").agg(F.count(F.lit(1)).alias("n_refs"))
