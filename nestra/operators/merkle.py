"""Deeply nested blocks to flat tables, by Merkle subtree identities.

Every object gets an identity from its own canonical values and the identities of its children, bottom-up: contribution -> hit -> block, particle -> block. Equal objects have equal identities and
are stored once; every occurrence is a bridge row (parent, ordinal, child). A redelivered block is the same object as its first delivery, so copies vanish where bridges are made distinct; the flat tables of all rows leave them out
before, by their narrow keys, so that an object that stands in very many places is no hot group: objects are picked in every task before they meet, and occurrences only meet them in a join, which Spark divides where it is skewed. An identity has 128 bits (two independently seeded 64-bit chains over kind, presence and value of each field): among 10^14 objects a collision has a chance of about 10^-11. The chains are no cryptographic hash: whoever wants to can make up two objects of one identity, so they do not serve against hostile input.
Identities form batch by batch from flat Arrow columns, without any shuffle; nested SQL lambdas over the same arrays were measured to be far slower.

A `shape` stands beside each identity in the bridges: what the object lacks. It is a function of the object, so rows that lack something are found before anything is shuffled.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestra.arrow import array, list_lengths, zip_lists
from nestra.operators.nested import single_and_repeated
from nestra.runtime import Workspace

#: Shapes. A contribution: both parts, id only, energy only, neither. A hit: sound, with unpaired contributions, without any. A particle: sound, without px.
PAIRED, ID_ONLY, ENERGY_ONLY, NEITHER = 0, 1, 2, 3
SOUND, UNPAIRED, BARE = 0, 1, 2

HIT_FIELDS = ("detector", "x", "y", "z", "total_energy")
PARTICLE_FIELDS = ("particle_id", "parent_id", "pdg_id", "is_primary", "energy", "time_ns", "vx", "vy", "vz", "px", "py", "pz")


OID = "struct<hi:bigint,lo:bigint>"
_PARTS = f"array<struct<oid:{OID},shape:int,particle_id:bigint,energy:double>>"
_HITS = f"array<struct<oid:{OID},shape:int,pos:int,detector:int,x:double,y:double,z:double,total_energy:double,n_ids:int,n_energies:int,parts:{_PARTS}>>"
NESTED_HITS = f"oid {OID}, event_id bigint, block_no int, run_no int, children {_HITS}"
_PARTICLE_TYPES = {"is_primary": "boolean"} | dict.fromkeys(("particle_id", "parent_id", "pdg_id"), "bigint")
_PARTICLES = f"array<struct<oid:{OID},shape:int,pos:int,{','.join(f'{f}:{_PARTICLE_TYPES.get(f, "double")}' for f in PARTICLE_FIELDS)}>>"
NESTED_PARTICLES = f"oid {OID}, event_id bigint, block_no int, run_no int, children {_PARTICLES}"

_U = np.uint64
SEEDS = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))


def _mix(v: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    v = (v ^ (v >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> _U(27))) * _U(0x94D049BB133111EB)
    return v ^ (v >> _U(31))


def _words(col: pa.Array) -> np.ndarray:
    """A column's values as 64-bit words; equal values have equal words (-0.0 and 0.0, all NaN)."""
    if pa.types.is_floating(col.type):
        v = col.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        return np.where(np.isnan(v), np.nan, v).view(_U)
    return col.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).view(_U)


class Identity:
    """Identities of one kind of object: fields and lists of children are folded in, in a fixed order."""

    def __init__(self, kind: int, n: int):
        self.h = [_mix(np.full(n, s) + _U(kind)) for s in SEEDS]
        self.k = 0

    def _fold(self, words: list[np.ndarray]) -> None:
        self.k += 1
        step = _U(2 * self.k + 1)
        self.h = [_mix((h ^ w) + np.array([s]) * step) for h, w, s in zip(self.h, words, SEEDS, strict=True)]

    def field(self, col: pa.Array) -> "Identity":
        there = col.is_valid().to_numpy(zero_copy_only=False)
        w = _words(col)
        self._fold([np.where(there, _mix(w + s), s) for s in SEEDS])
        self._fold([there.astype(_U)] * 2)
        return self

    def children(self, child: "Identity", lengths: np.ndarray) -> "Identity":
        """Children in order: each is scrambled together with its place, so another order is another sum."""
        at = np.cumsum(lengths) - lengths
        place = (np.arange(int(lengths.sum())) - np.repeat(at, lengths)).astype(_U)
        sums = []
        for c, s in zip(child.h, SEEDS, strict=True):
            total = np.r_[np.zeros(1, _U), np.cumsum(_mix(c + _mix(place + s)))]
            sums.append(total[at + lengths] - total[at])
        self._fold(sums)
        self._fold([lengths.astype(_U)] * 2)
        return self

    def column(self) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(h.view(np.int64)) for h in self.h], ["hi", "lo"])


def _listed(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), values)


def _segment_any(flags: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags)]
    at = np.cumsum(lengths) - lengths
    return total[at + lengths] > total[at]


def _blocks_of(b: pa.RecordBatch, oid: Identity, kept: np.ndarray | None, n: np.ndarray, children: pa.Array) -> pa.RecordBatch:
    """One row per block; with ``kept`` only the children it names, and no block without any."""
    if kept is not None:
        row = np.repeat(np.arange(len(n)), n)
        n, children = np.bincount(row[kept], minlength=len(n)), children.take(pa.array(np.flatnonzero(kept)))
    out = pa.RecordBatch.from_arrays([oid.column(), *(b.column(c) for c in ("event_id", "block_no", "run_no")), _listed(children, n)], ["oid", "event_id", "block_no", "run_no", "children"])
    return out if kept is None else out.filter(pa.array(n > 0))


def _name_hits(lacking: bool, batches):
    for b in batches:
        lists = [array(b.column(c)) for c in (*HIT_FIELDS, "contrib_particle_ids", "contrib_energies")]
        sizes = [list_lengths(c) for c in lists]
        n, (*fields, ids, energies) = zip_lists(lists, sizes)
        n_ids, n_energies = list_lengths(ids), list_lengths(energies)
        n_parts, (i, e) = zip_lists([ids, energies], [n_ids, n_energies])
        part = Identity(1, len(i)).field(i).field(e)
        has_i, has_e = (c.is_valid().to_numpy(zero_copy_only=False) for c in (i, e))
        part_shape = np.where(has_i, np.where(has_e, PAIRED, ID_ONLY), np.where(has_e, ENERGY_ONLY, NEITHER)).astype(np.int32)
        hit = Identity(2, len(n_ids))
        for f in (*fields, pa.array(n_ids), pa.array(n_energies)):
            hit.field(f)
        hit.children(part, n_parts)
        row = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        bare = (n_parts == 0) & (pos < sizes[1][row])
        shape = np.where(bare, BARE, np.where(_segment_any(has_i != has_e, n_parts), UNPAIRED, SOUND)).astype(np.int32)
        block = Identity(3, len(n))
        for f in (*(b.column(c) for c in ("event_id", "block_no", "run_no")), *(pa.array(s) for s in sizes)):
            block.field(f)
        block.children(hit, n)
        parts = pa.StructArray.from_arrays([part.column(), pa.array(part_shape), i, e], ["oid", "shape", "particle_id", "energy"])
        ints = [pa.array(v.astype(np.int32)) for v in (n_ids, n_energies)]
        children = pa.StructArray.from_arrays([hit.column(), pa.array(shape), pa.array(pos.astype(np.int32)), *fields, *ints, _listed(parts, n_parts)], ["oid", "shape", "pos", *HIT_FIELDS, "n_ids", "n_energies", "parts"])
        yield _blocks_of(b, block, shape != SOUND if lacking else None, n, children)


def _name_particles(lacking: bool, batches):
    for b in batches:
        lists = [array(b.column(c)) for c in PARTICLE_FIELDS]
        sizes = [list_lengths(c) for c in lists]
        n, fields = zip_lists(lists, sizes)
        oid, block = Identity(4, int(n.sum())), Identity(5, len(n))
        for f in fields:
            oid.field(f)
        for f in (*(b.column(c) for c in ("event_id", "block_no", "run_no")), *(pa.array(s) for s in sizes)):
            block.field(f)
        block.children(oid, n)
        row = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        px = fields[PARTICLE_FIELDS.index("px")].is_valid().to_numpy(zero_copy_only=False)
        shape = np.where(~px & (pos < sizes[0][row]), BARE, SOUND).astype(np.int32)
        children = pa.StructArray.from_arrays([oid.column(), pa.array(shape), pa.array(pos.astype(np.int32)), *fields], ["oid", "shape", "pos", *PARTICLE_FIELDS])
        yield _blocks_of(b, block, shape != SOUND if lacking else None, n, children)


def nested_hits(calo_hits: DataFrame, lacking: bool = False) -> DataFrame:
    """Each delivered block of calo_hits with its tree of identified objects: ``oid, event_id, block_no, run_no, children``.

    The children of a block are the positions of its longest list; values beyond the end of a shorter list are null. No row is dropped and nothing is shuffled. With ``lacking``
    only the children that lack something come out, and the blocks that have any; identities are those of the whole objects.
    """
    cols = ["event_id", "block_no", "run_no", *HIT_FIELDS, "contrib_particle_ids", "contrib_energies"]
    return calo_hits.select(*cols).mapInArrow(partial(_name_hits, lacking), NESTED_HITS)


def nested_particles(particles: DataFrame, lacking: bool = False) -> DataFrame:
    """Each delivered block of particles with its identified particles: ``oid, event_id, block_no, run_no, children``; as nested_hits."""
    return particles.select("event_id", "block_no", "run_no", *PARTICLE_FIELDS).mapInArrow(partial(_name_particles, lacking), NESTED_PARTICLES)


def _own(c: str):
    return F.coalesce(c, F.array())


# Flat tables of a nested frame. Objects are distinct by identity, bridges by (parent, ordinal).


def blocks(nested: DataFrame) -> DataFrame:
    """Block objects: ``oid, event_id, block_no, run_no``, one row per distinct block."""
    return nested.select("oid", "event_id", "block_no", "run_no").distinct()


def block_children(nested: DataFrame) -> DataFrame:
    """Bridge block -> hit or particle: ``parent, ordinal, child, shape``, one row per position of a distinct block."""
    rows = nested.select("oid", F.explode("children").alias("c"))
    return rows.select(F.col("oid").alias("parent"), F.col("c.pos").alias("ordinal"), F.col("c.oid").alias("child"), F.col("c.shape").alias("shape")).distinct()


def child_objects(nested: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Hit or particle objects: ``oid`` and fields, each distinct object once."""
    return nested.select(F.explode("children").alias("c")).select("c.oid", *[f"c.{f}" for f in fields]).distinct()


def hit_contributions(nested: DataFrame) -> DataFrame:
    """Bridge hit -> contribution: ``parent, ordinal, child, shape``, one row per position of a distinct hit."""
    rows = nested.select(F.explode("children").alias("c")).select("c.oid", F.posexplode("c.parts").alias("ordinal", "p"))
    return rows.select(F.col("oid").alias("parent"), "ordinal", F.col("p.oid").alias("child"), F.col("p.shape").alias("shape")).distinct()


def contribution_objects(nested: DataFrame) -> DataFrame:
    """Contribution objects: ``oid, particle_id, energy``, each distinct pair once."""
    return nested.select(F.explode("children").alias("c")).select(F.explode("c.parts").alias("p")).select("p.oid", "p.particle_id", "p.energy").distinct()


def flat_contributions(calo_hits: DataFrame) -> DataFrame:
    """Every contribution with its links: ``event_id, block_no, pos, child_pos, particle_id, energy``; positions as they stand, copies of a block once.

    Identities are only needed to drop copies here, so a block is read back from one of its deliveries instead of joining bridges to objects.
    """
    rows = nested_hits(calo_hits).select(F.col("oid.hi").alias("hi"), F.col("oid.lo").alias("lo"), "event_id", "block_no", F.transform("children", lambda h: F.transform(h["parts"], lambda p: F.struct(p["particle_id"].alias("particle_id"), p["energy"].alias("energy")))).alias("hits"))
    once = rows.dropDuplicates(["hi", "lo"])
    parts = once.select("event_id", "block_no", F.posexplode("hits").alias("pos", "h")).select("event_id", "block_no", "pos", F.posexplode("h").alias("child_pos", "p"))
    return parts.select("event_id", "block_no", "pos", "child_pos", "p.particle_id", "p.energy")


def _delivered_once(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each block once: by (event_id, block_no), of rows that lack one of them each different row."""
    rows = df.select("event_id", "block_no", "run_no", *cols)
    named = F.col("event_id").isNotNull() & F.col("block_no").isNotNull()
    once, one_each = single_and_repeated(rows.where(named), Workspace(df.sparkSession))
    return once.unionByName(one_each).unionByName(rows.where(~named).dropDuplicates())


def _occurrences(nested: DataFrame) -> DataFrame:
    """Bridge block -> hit or particle with the block's own values: ``event_id, block_no, run_no, pos`` and the child's ``hi, lo``, one row per position."""
    rows = nested.select("event_id", "block_no", "run_no", F.explode(F.transform("children", lambda c: F.struct(c["oid"].alias("oid"), c["pos"].alias("pos")))).alias("c"))
    return rows.select("event_id", "block_no", "run_no", F.col("c.pos").alias("pos"), F.col("c.oid.hi").alias("hi"), F.col("c.oid.lo").alias("lo"))


def _objects(nested: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``hi, lo`` and fields of every distinct child. -0.0 comes back as 0.0, which has the same identity."""
    kinds = {f.name: f.dataType.simpleString() for f in nested.schema["children"].dataType.elementType.fields}
    own = [(F.col(f"c.{f}") + 0.0 if kinds[f] == "double" else F.col(f"c.{f}")).alias(f) for f in fields]
    return nested.select(F.explode("children").alias("c")).select(F.col("c.oid.hi").alias("hi"), F.col("c.oid.lo").alias("lo"), *own).dropDuplicates(["hi", "lo"])


def _hits_once(calo_hits: DataFrame) -> DataFrame:
    return nested_hits(_delivered_once(calo_hits, [*HIT_FIELDS, "contrib_particle_ids", "contrib_energies"]))


def hit_links(calo_hits: DataFrame) -> DataFrame:
    """The bridge block -> hit by the block's own values: ``event_id, block_no, run_no, pos, hi, lo``, one row per position of a distinct block; hi and lo are the identity of the object that stands there."""
    return _occurrences(_hits_once(calo_hits))


def particle_links(particles: DataFrame) -> DataFrame:
    """The bridge block -> particle; as hit_links."""
    return _occurrences(nested_particles(_delivered_once(particles, list(PARTICLE_FIELDS))))


def flat_hits(calo_hits: DataFrame) -> DataFrame:
    """Every hit, rebuilt through the bridge from its object: ``event_id, block_no, run_no, pos, detector, x, y, z, total_energy, n_ids, n_energies``; copies of a block once.

    Positions are those of the longest of the block's lists, values beyond the end of a shorter list are null; hits without contributions are there. n_ids and n_energies are the lengths of the contribution lists,
    -1 for a list that is null; (event_id, block_no, pos) links to flat_contributions.
    """
    nested, fields = _hits_once(calo_hits), (*HIT_FIELDS, "n_ids", "n_energies")
    return _occurrences(nested).join(_objects(nested, fields), ["hi", "lo"]).select("event_id", "block_no", "run_no", "pos", *fields)


def flat_particles(particles: DataFrame) -> DataFrame:
    """Every particle, rebuilt through the bridge from its object: ``event_id, block_no, run_no, pos`` and PARTICLE_FIELDS; as flat_hits. parent_id links to particle_id of the event."""
    nested = nested_particles(_delivered_once(particles, list(PARTICLE_FIELDS)))
    return _occurrences(nested).join(_objects(nested, PARTICLE_FIELDS), ["hi", "lo"]).select("event_id", "block_no", "run_no", "pos", *PARTICLE_FIELDS)


def linked_contributions(calo_hits: DataFrame) -> DataFrame:
    """flat_contributions rebuilt through both bridges: block -> hit -> contribution -> the object that each distinct pair is stored as. A hit object holds its bridge rows as one list."""
    nested = _hits_once(calo_hits)
    hits = nested.select(F.explode(F.transform("children", lambda c: F.struct(c["oid"].alias("oid"), F.transform(c["parts"], lambda p: p["oid"]).alias("parts")))).alias("c"))
    hits = hits.select(F.col("c.oid.hi").alias("hi"), F.col("c.oid.lo").alias("lo"), "c.parts").where("size(parts) > 0").dropDuplicates(["hi", "lo"])
    parts = nested.select(F.explode(F.flatten(F.transform("children", lambda c: c["parts"]))).alias("p"))
    objects = parts.select(F.col("p.oid.hi").alias("part_hi"), F.col("p.oid.lo").alias("part_lo"), "p.particle_id", (F.col("p.energy") + 0.0).alias("energy")).dropDuplicates(["part_hi", "part_lo"])
    rows = _occurrences(nested).join(hits, ["hi", "lo"]).select("event_id", "block_no", "pos", F.posexplode("parts").alias("child_pos", "o"))
    rows = rows.select("event_id", "block_no", "pos", "child_pos", F.col("o.hi").alias("part_hi"), F.col("o.lo").alias("part_lo"))
    return rows.join(objects, ["part_hi", "part_lo"]).select("event_id", "block_no", "pos", "child_pos", "particle_id", "energy")


def unmatched(calo_hits: DataFrame, particles: DataFrame) -> DataFrame:
    """What has no counterpart: ``kind, event_id, block_no, pos, child_pos``.

    'contribution': exactly one of id and energy is there; 'hit': a position of x for which neither list has any position, child_pos -1; 'particle': a position of particle_id without px, child_pos
    -1. A null, a missing position and a missing list are all "not there". Copies of a block count once. Lists that are null or empty are of length 0; empty tables give no rows.
    """
    # Of each block only the children that lack something are kept, with their identities; what is written holds these alone.
    ws = Workspace(calo_hits.sparkSession)
    slim_part = lambda p: F.struct(p["oid"].alias("oid"), p["shape"].alias("shape"))
    slim = lambda h: F.struct(h["oid"].alias("oid"), h["shape"].alias("shape"), h["pos"].alias("pos"), F.transform(h["parts"], slim_part).alias("parts"))
    slim_p = lambda h: F.struct(h["oid"].alias("oid"), h["shape"].alias("shape"), h["pos"].alias("pos"))
    hits = ws.write(nested_hits(calo_hits, lacking=True).withColumn("children", F.transform("children", slim)))
    parts = ws.write(nested_particles(particles, lacking=True).withColumn("children", F.transform("children", slim_p)))
    named = lambda df: blocks(df).withColumnRenamed("oid", "parent")
    hit_rows = block_children(hits).join(named(hits), "parent")
    single = hit_contributions(hits).where(F.col("shape").isin(ID_ONLY, ENERGY_ONLY)).select(F.col("parent").alias("child"), F.col("ordinal").alias("child_pos"))
    whole = lambda df, kind: df.where(F.col("shape") == BARE).select(F.lit(kind).alias("kind"), "event_id", "block_no", F.col("ordinal").alias("pos"), F.lit(-1).alias("child_pos"))
    of_contributions = hit_rows.where(F.col("shape") == UNPAIRED).join(single, "child").select(F.lit("contribution").alias("kind"), "event_id", "block_no", F.col("ordinal").alias("pos"), "child_pos")
    return of_contributions.unionByName(whole(hit_rows, "hit")).unionByName(whole(block_children(parts).join(named(parts), "parent"), "particle"))


def object_counts(calo_hits: DataFrame, particles: DataFrame) -> DataFrame:
    """How much storing each object once saves: ``kind, n_links, n_objects`` of contributions, hits and particles (links of distinct blocks)."""
    # Copies hold the same objects, so objects are counted without dropping copies; links are counted from the sizes of distinct blocks, which are short rows.
    oids = F.concat(
        F.transform("children", lambda h: F.struct(F.lit("hit").alias("kind"), h["oid"].alias("oid"))),
        F.flatten(F.transform("children", lambda h: F.transform(h["parts"], lambda p: F.struct(F.lit("contribution").alias("kind"), p["oid"].alias("oid"))))),
    )
    of_particles = nested_particles(particles).select(F.explode(F.transform("children", lambda p: F.struct(F.lit("particle").alias("kind"), p["oid"].alias("oid")))).alias("o"))
    objects = nested_hits(calo_hits).select(F.explode(oids).alias("o")).unionByName(of_particles).select("o.kind", F.col("o.oid.hi").alias("hi"), F.col("o.oid.lo").alias("lo")).distinct()
    n_objects = objects.groupBy("kind").agg(F.count(F.lit(1)).alias("n_objects"))
    longest = lambda *cols: F.greatest(*[F.coalesce(F.array_size(c), F.lit(0)) for c in cols])
    lists = F.arrays_zip(_own("contrib_particle_ids").alias("i"), _own("contrib_energies").alias("e"))
    n_parts = F.aggregate(lists, F.lit(0).cast("bigint"), lambda n, h: n + longest(h["i"], h["e"]))
    sizes = calo_hits.select("event_id", "block_no", longest(*HIT_FIELDS, "contrib_particle_ids", "contrib_energies").cast("bigint").alias("hit"), n_parts.alias("contribution")).dropDuplicates(["event_id", "block_no"])
    p_sizes = particles.select("event_id", "block_no", longest(*PARTICLE_FIELDS).cast("bigint").alias("particle")).dropDuplicates(["event_id", "block_no"])
    total = lambda df, kind: df.agg(F.coalesce(F.sum(kind), F.lit(0)).cast("bigint").alias("n_links")).select(F.lit(kind).alias("kind"), "n_links")
    n_links = total(sizes, "contribution").unionByName(total(sizes, "hit")).unionByName(total(p_sizes, "particle"))
    return n_links.join(n_objects, "kind", "left").select("kind", "n_links", F.coalesce("n_objects", F.lit(0)).cast("bigint").alias("n_objects"))
