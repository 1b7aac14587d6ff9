"""Problems 1, 3, 4 and 6: brute force, dirty rows, empty tables and clashing names."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import at
from nestra.operators import hierarchy, merkle, nested, orphan_refs, tree_aggregate

CLASH = ("chunk", "bucket", "pos", "h", "n", "key_id", "word", "refs", "links", "children", "oid")


# Problem 1


def dirty_hits(make, more=CLASH):
    return make.hits(
        {"event_id": 1, "x": [1.0, 2.0], "total_energy": [0.5, None], "contrib_particle_ids": [[5, None, 0], None], "contrib_energies": [[0.1], [0.2]]},
        {"event_id": 1, "x": [1.0, 2.0], "total_energy": [0.5, None], "contrib_particle_ids": [[5, None, 0], None], "contrib_energies": [[0.1], [0.2]], "ingested_at": at(9)},
        {"event_id": 1, "block_no": 1, "x": None, "contrib_particle_ids": [[5]], "contrib_energies": None},
        {"event_id": 2, "x": [], "contrib_particle_ids": [], "contrib_energies": []},
        {"event_id": None, "block_no": 3, "x": [float("nan")], "total_energy": [float("nan")], "contrib_particle_ids": [[]], "contrib_energies": [[]]}, more=more,
    )


def test_key_sums_of_dirty_rows(make, rows):
    got = rows(tree_aggregate.key_sums(dirty_hits(make)))
    assert set(got) == {("event", 1, 2, 2, 3, 500000), ("event", 2, 1, 0, 0, 0), ("event", None, 1, 1, 0, 0), ("contributor", 5, None, None, 2, 100000), ("contributor", 0, None, None, 1, 0)}


def test_blocks_without_a_number_are_no_copies(make, rows):
    h = make.hits(*[{"event_id": 1, "block_no": None, "x": [float(k)], "total_energy": [1.0]} for k in range(3)], {"event_id": 1, "x": []}, {"event_id": 1, "x": [], "ingested_at": at(2)}, *[{"event_id": None, "block_no": 0, "x": []}] * 2)
    assert set(rows(tree_aggregate.key_sums(h))) == {("event", 1, 4, 3, 0, 3000000), ("event", None, 2, 0, 0, 0)}
    for narrow_from in (0, 1 << 60):
        assert nested.distinct_blocks(h.withColumn("n", nested.F.lit(1)), narrow_from).count() == 6


def test_sums_do_not_depend_on_the_tree(make, rows):
    r = random.Random(1)
    blocks = [{"event_id": 1 if r.random() < 0.4 else r.randrange(2, 9), "block_no": k, "x": [0.0] * 3, "total_energy": [r.random() for _ in range(3)], "contrib_particle_ids": [[r.randrange(4)] for _ in range(3)], "contrib_energies": [[r.random()] for _ in range(3)]} for k in range(200)]
    df = make.hits(*blocks)
    a, b = rows(tree_aggregate.key_sums(df)), rows(tree_aggregate.key_sums(df, chunk_bytes=64, fan_in=2))
    assert a == b and tree_aggregate.tree_levels(64, 2) == 6
    assert sum(x[2] for x in a if x[0] == "event") == 200


def test_hot_keys_at_the_limit(make, rows):
    df = make.hits(*[{"event_id": 1 if k < 1 else 100 + k, "block_no": k, "x": []} for k in range(25)])
    assert len(rows(tree_aggregate.hot_keys(df))) == 25  # each has exactly 4 %
    assert rows(tree_aggregate.hot_keys(make.hits())) == []


# Problem 3


def test_orphans_of_every_kind(make, rows, spark):
    p = make.particles(
        {"event_id": 1, "particle_id": [1, 2, 3, 4], "parent_id": [None, 0, 9, 5], "ingested_at": at(0)}, {"event_id": 1, "block_no": 1, "particle_id": [5], "parent_id": [1], "ingested_at": at(5)},
        {"event_id": 1, "block_no": 1, "particle_id": [5], "parent_id": [1], "ingested_at": at(7)}, {"event_id": 2, "particle_id": [1], "parent_id": [1], "run_no": None}, {"event_id": None, "particle_id": [1], "parent_id": [8]},
        {"event_id": 3, "particle_id": [None, 7], "parent_id": [4]}, more=CLASH,
    )
    h = make.hits({"event_id": 1, "block_no": 4, "x": [0.0], "contrib_particle_ids": [[5, 5, 0, None, 8], None], "ingested_at": at(3)}, {"event_id": 1, "block_no": 5, "x": None, "contrib_particle_ids": [[5]], "ingested_at": at(5)}, more=CLASH)
    w = spark.createDataFrame([(1, 8, None, None, "x"), (1, 8, None, "again", "x"), (1, 5, None, None, "x"), (None, 1, None, None, "x"), (1, None, None, None, "x")], "event_id bigint, particle_id bigint, withdrawn_at timestamp, reason string, arrival string")
    want = [("calo_hits", 1, 1, 4, 5, "late"), ("calo_hits", 1, 1, 4, 8, "withdrawn"), ("particles", 1, 1, 3, 9, "missing"), ("particles", 1, 1, 4, 5, "late")]
    for tuning in ({}, {"range_keys": 1, "task_refs": 1}, {"range_keys": 1, "task_refs": 1, "most_ranges": 2}, {"range_keys": 2, "most_ranges": 1}):
        out = orphan_refs.orphan_references(p, h, w, **tuning)
        assert rows(out) == want
    assert rows(orphan_refs.orphan_report(out)) == [("calo_hits", 1, "late", 1), ("calo_hits", 1, "withdrawn", 1), ("particles", 1, "late", 1), ("particles", 1, "missing", 1)]


def test_orphans_of_empty_tables(make, rows, spark):
    w = spark.createDataFrame([], "event_id bigint, particle_id bigint, withdrawn_at timestamp, reason string")
    assert rows(orphan_refs.orphan_references(make.particles(), make.hits(), w)) == []
    h = make.hits({"event_id": 1, "x": [0.0], "contrib_particle_ids": [[3]]})
    assert rows(orphan_refs.orphan_references(make.particles(), h, w)) == [("calo_hits", 1, 1, 0, 3, "missing")]


# Problem 4


def walk(par):
    """id -> (root, depth, path) by naive walking."""
    has = lambda x: par[x] not in (None, 0, x) and par[x] in par
    out = {}
    for x in par:
        path, y = [x], x
        while has(y) and par[y] not in path:
            y = par[y]
            path.append(y)
        if has(y):
            out[x] = (min(path[path.index(par[y]) :]), -1, [])
        else:
            out[x] = (y, len(path) - 1, path[::-1])
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=12), min_size=1, max_size=3))
def test_random_forests(make, events):
    p = make.particles(*[{"event_id": e, "particle_id": list(range(1, len(par) + 1)), "parent_id": [x or None for x in par]} for e, par in enumerate(events)])
    got = {(r.event_id, r.particle_id): r for r in hierarchy.lineage(p).collect()}
    for e, par in enumerate(events):
        want = walk(dict(zip(range(1, len(par) + 1), par, strict=True)))
        below = {x: set() for x in want}
        for x, (_, d, path) in want.items():
            if d >= 0:
                for a in path[:-1]:
                    below[a].add(x)
        for x, (root, depth, path) in want.items():
            r = got[e, x]
            assert (r.root_id, r.depth, list(r.path)) == (root, depth, path)
            if depth >= 0:
                assert set(r.descendants) == below[x] and r.n_descendants == len(below[x])


def test_both_ways_of_peeling_agree(make, rows):
    nodes = [(1, None, 0), (2, 1, 0), (3, 2, 0), (4, 2, 0), (5, 4, 0), (6, 7, 0), (7, 8, 0), (8, 6, 0), (9, 8, 0), (10, 9, 0), (11, 11, 0), (12, 0, 0)]
    p = make.particles(make.forest(1, *nodes), make.forest(1, *nodes, ingested_at=at(4)), make.forest(2, (1, 2, 0)), make.forest(None, (1, 2, 0)), {"event_id": 3, "particle_id": None, "parent_id": [1]}, {"event_id": 4, "particle_id": [1, None], "parent_id": None}, more=CLASH)
    form = lambda df: sorted((r.event_id, r.particle_id, r.parent_id or 0, r.root_id, r.depth, r.on_cycle, r.n_descendants, tuple(r.path), r.part, tuple(r.descendants)) for r in df.collect())
    a = form(hierarchy.lineage(p))
    assert a == form(hierarchy.lineage(p, most_nodes=3))
    cut = hierarchy.lineage(p, list_most=2).where("event_id = 1 and particle_id = 1").collect()
    assert sorted(x for r in cut for x in r.descendants) == [2, 3, 4, 5] and sorted(r.part for r in cut) == [0, 1]
    assert hierarchy.lineage(make.particles()).count() == 0


def test_parts_of_both_ways_are_the_same(make):
    p = make.particles(make.forest(1, (1, None, 0), (9, 1, 0), (2, 9, 0), (70000, 2, 0), (4, 1, 0), (3, 4, 0), (6, 7, 0), (7, 6, 0), (5, 7, 0), (8, 5, 0)))
    form = lambda **tuning: sorted((r.event_id, r.particle_id, r.part, tuple(r.descendants)) for r in hierarchy.lineage(p, list_most=2, **tuning).collect())
    a = form()
    assert a == form(most_nodes=3)
    assert [x[2:] for x in a if x[1] == 1] == [(0, (2, 3)), (1, (4, 9)), (2, (70000,))] and [x[2:] for x in a if x[1] == 7] == [(0, (5, 8))]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 14), min_size=3, max_size=14))
def test_random_forests_by_rounds(make, par):
    p = make.particles({"event_id": 1, "particle_id": list(range(1, len(par) + 1)), "parent_id": [x or None for x in par]})
    form = lambda **tuning: sorted((r.particle_id, r.parent_id or 0, r.root_id, r.depth, r.on_cycle, r.n_descendants, tuple(r.path), r.part, tuple(r.descendants)) for r in hierarchy.lineage(p, **tuning).collect())
    assert form() == form(most_nodes=2)


def test_deep_chains_and_long_cycles_end_in_few_rounds(make):
    from nestra.runtime import Workspace

    n = 3000
    ids, parents = list(range(1, n + 401)), [k or None for k in range(n)] + [n + 1 + (k + 1) % 400 for k in range(400)]
    p = make.particles({"event_id": 1, "particle_id": ids, "parent_id": parents})
    e = hierarchy._Events(p, 1 << 20, 2)
    nodes = e.large.select("event_id", hierarchy.F.explode("links").alias("l")).select("event_id", hierarchy.F.col("l.id").alias("particle_id"), hierarchy.F.col("l.parent").alias("parent_id"))
    assert len(hierarchy._contract(nodes, Workspace(p.sparkSession))) <= 45


def test_sums_over_subtrees(make, spark, rows):
    p = make.particles(make.forest(1, (1, None, 0), (2, 1, 0), (3, 2, 0), (4, 2, 0), (6, 7, 0), (7, 6, 0), (8, 7, 0), (9, 8, 0)), make.forest(2, (1, 5, 0)))
    v = spark.createDataFrame([(1, 3, 10), (1, 4, 5), (1, 1, 1), (1, 9, 2), (1, 6, 3), (1, 77, 9), (1, 3, None), (2, 1, 4), (3, 1, 1), (None, 1, 1)], "event_id bigint, particle_id bigint, units bigint")
    for tuning in ({}, {"most_nodes": 1}):
        assert rows(hierarchy.subtree_sums(p, v, **tuning)) == [(1, 1, 1, 16), (1, 2, 0, 15), (1, 3, 10, 10), (1, 4, 5, 5), (2, 1, 4, 4)]
    assert rows(hierarchy.subtree_sums(make.particles(), v)) == []


def test_particles_of_rows_without_a_block_number(make, rows):
    p = make.particles(*[{"event_id": 1, "block_no": None, "particle_id": ids, "parent_id": parents} for ids, parents in (([1], [None]), ([2, 3], [1, 2]), ([2, 3], [1, 2]))], {"event_id": 1, "particle_id": [4], "parent_id": [3]})
    for tuning in ({}, {"most_nodes": 1}):
        assert rows(hierarchy.found(p, **tuning)) == [(1, 2, 1, 1), (1, 3, 1, 2), (1, 4, 1, 3)]


def test_descendants_below_cycles(make, rows):
    p = make.particles(make.forest(1, (1, None, 0), (2, 1, 0), (6, 7, 0), (7, 6, 0), (8, 7, 0), (9, 8, 0)))
    assert rows(hierarchy.descendant_pairs(p, cycles=True)) == [(1, 1, 2), (1, 7, 8), (1, 7, 9), (1, 8, 9)]
    assert rows(hierarchy.descendant_pairs(p)) == [(1, 1, 2)]


# Problem 6


def test_unmatched(make, rows):
    h = make.hits(
        {"event_id": 1, "x": [1.0, 2.0, 3.0, 4.0], "contrib_particle_ids": [[1, None, 2], None, [], [None]], "contrib_energies": [[0.1, 0.2], [0.3], None, [None]]},
        {"event_id": 1, "x": [1.0, 2.0, 3.0, 4.0], "contrib_particle_ids": [[1, None, 2], None, [], [None]], "contrib_energies": [[0.1, 0.2], [0.3], None, [None]], "ingested_at": at(3)},
        {"event_id": 1, "block_no": 1, "x": [1.0]}, {"event_id": 2, "x": None, "contrib_particle_ids": [[7]]}, {"event_id": None, "block_no": None, "x": [None], "contrib_particle_ids": [[]], "contrib_energies": [[]]}, more=CLASH,
    )
    p = make.particles({"event_id": 1, "particle_id": [1, 2, 3], "px": [1.0, None]}, {"event_id": 2, "particle_id": [1], "px": None}, {"event_id": 3, "particle_id": None, "px": [1.0]}, more=CLASH)
    c = lambda *x: ("contribution", *x)
    assert set(rows(merkle.unmatched(h, p))) == {
        c(1, 0, 0, 1), c(1, 0, 0, 2), c(1, 0, 1, 0), ("hit", 1, 0, 2, -1), ("hit", 1, 1, 0, -1), c(2, 0, 0, 0), ("hit", None, None, 0, -1), ("particle", 1, 0, 1, -1), ("particle", 1, 0, 2, -1), ("particle", 2, 0, 0, -1),
    }
    assert rows(merkle.unmatched(make.hits(), make.particles())) == []


def test_objects_are_stored_once_and_come_back(make, rows):
    block = {"x": [1.0, 1.0, 1.0], "y": [0.0, -0.0, 0.0], "detector": [9, 9, 10], "contrib_particle_ids": [[1, 2], [1, 2], [2, 1]], "contrib_energies": [[0.5, None], [0.5, None], [None, 0.5]]}
    h = make.hits({"event_id": 1} | block, {"event_id": 2} | block, {"event_id": 2, "ingested_at": at(3)} | block)
    n = merkle.nested_hits(h)
    assert merkle.blocks(n).count() == 2 and merkle.block_children(n).count() == 6
    assert merkle.child_objects(n, merkle.HIT_FIELDS).count() == 2 and merkle.contribution_objects(n).count() == 2
    assert merkle.hit_contributions(n).count() == 4
    # Every occurrence comes back through the bridges.
    b, k, o = merkle.block_children(n), merkle.hit_contributions(n), merkle.contribution_objects(n)
    joined = merkle.blocks(n).withColumnRenamed("oid", "parent").join(b, "parent").select("event_id", "block_no", "ordinal", "child").withColumnRenamed("ordinal", "pos").withColumnRenamed("child", "parent")
    full = joined.join(k, "parent").withColumnRenamed("ordinal", "child_pos").join(o.withColumnRenamed("oid", "child"), "child")
    cols = ("event_id", "block_no", "pos", "child_pos", "particle_id", "energy")
    assert rows(full, *cols) == rows(merkle.flat_contributions(h), *cols)
    counts = {r.kind: (r.n_links, r.n_objects) for r in merkle.object_counts(h, make.particles()).collect()}
    assert counts == {"contribution": (12, 2), "hit": (6, 2), "particle": (0, 0)}


def test_flat_tables_lose_nothing(make, rows):
    block = {"detector": [9, 9], "x": [1.0, 1.0, 2.0], "y": [0.0, -0.0], "contrib_particle_ids": [[1, 2], [1, 2], None, []], "contrib_energies": [[0.5], [0.5]]}
    h = make.hits({"event_id": 1} | block, {"event_id": 1, "ingested_at": at(3)} | block, {"event_id": 1, "block_no": 1} | block, {"event_id": 2, "x": None}, {"event_id": None, "block_no": None, "run_no": None, "x": [5.0]}, {"event_id": 7, "block_no": None, "x": [5.0]}, {"event_id": 7, "block_no": None, "x": [5.0, 6.0]}, more=CLASH)
    one = lambda b: [(1, b, 1, 0, 9, 1.0, 0.0, 2, 1), (1, b, 1, 1, 9, 1.0, 0.0, 2, 1), (1, b, 1, 2, None, 2.0, None, -1, -1), (1, b, 1, 3, None, None, None, 0, -1)]
    assert rows(merkle.flat_hits(h), "event_id", "block_no", "run_no", "pos", "detector", "x", "y", "n_ids", "n_energies") == [
        (None, None, None, 0, None, 5.0, None, -1, -1), *one(0), *one(1), *[(7, None, 1, pos, None, x, None, -1, -1) for pos, x in ((0, 5.0), (0, 5.0), (1, 6.0))],
    ]
    got = rows(merkle.linked_contributions(h))
    assert len(got) == 8 and got == rows(merkle.flat_contributions(h))
    p = make.particles({"event_id": 1, "particle_id": [1, 2, 2], "px": [0.5, None], "pdg_id": [22, 22, 22, 11]}, {"event_id": 1, "particle_id": [1, 2, 2], "px": [0.5, None], "pdg_id": [22, 22, 22, 11], "ingested_at": at(2)}, more=CLASH)
    assert rows(merkle.flat_particles(p), "event_id", "block_no", "pos", "particle_id", "px", "pdg_id") == [(1, 0, 0, 1, 0.5, 22), (1, 0, 1, 2, None, 22), (1, 0, 2, 2, None, 22), (1, 0, 3, None, None, 11)]
    assert rows(merkle.flat_hits(make.hits())) == [] and rows(merkle.flat_particles(make.particles())) == []


def test_links_name_equal_objects_alike(make, rows):
    block = {"x": [1.0, 1.0, 2.0], "contrib_particle_ids": [[1], [1], [1]], "contrib_energies": [[0.5], [0.5], [0.5]]}
    h = make.hits({"event_id": 1} | block, {"event_id": 1, "ingested_at": at(3)} | block, {"event_id": 2} | block, {"event_id": 3, "block_no": None, "x": [1.0]}, {"event_id": 3, "block_no": None, "x": [1.0]}, more=CLASH)
    got = {(r.event_id, r.pos): (r.hi, r.lo) for r in merkle.hit_links(h).collect()}
    assert merkle.hit_links(h).count() == 7 and got[1, 0] == got[1, 1] == got[2, 0] != got[1, 2] == got[2, 2] != got[3, 0]
    p = make.particles({"event_id": 1, "particle_id": [1, 2]}, {"event_id": 1, "particle_id": [1, 2], "ingested_at": at(1)}, more=CLASH)
    assert [r[:4] for r in rows(merkle.particle_links(p))] == [(1, 0, 1, 0), (1, 0, 1, 1)]


def test_null_and_missing_are_other_objects(make):
    one = lambda i, e: {"event_id": 1, "x": [1.0], "contrib_particle_ids": [i], "contrib_energies": [e]}
    h = make.hits(one([1], [0.5]), one([1, None], [0.5, None]), one([1, None], [0.5]), one(None, None), one([], []), one(None, []))
    assert merkle.blocks(merkle.nested_hits(h)).count() == 6


@pytest.mark.parametrize("n", [0, 1, 5])
def test_identity_depends_on_order(n):
    import numpy as np
    import pyarrow as pa

    a = merkle.Identity(1, 2).field(pa.array([1, 2]))
    b = merkle.Identity(1, 2).field(pa.array([2, 1]))
    whole = [merkle.Identity(2, 1).children(x, np.array([2])).h[0][0] for x in (a, b)]
    assert whole[0] != whole[1]
