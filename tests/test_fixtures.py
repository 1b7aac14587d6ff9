"""Hand-made events with known answers."""

import math

import pytest

from nestra import schema
from nestra.functions import kinematics as K
from nestra.operators import ancestry, energy, masks, nested, points, reports


def pairs(df, *cols):
    return {tuple(r[:-1]): r[-1] for r in df.select(*cols).collect()}


def ult(p):
    return pairs(ancestry.ultimate(p), "event_id", "particle_id", "ultimate_ancestor_id")


@pytest.mark.parametrize("most", [1 << 20, 1])
def test_chain_and_dead_ends(make, most):
    p = make.particles(make.forest(1, (1, None, False), (2, 1, False), (3, 2, True), (4, 3, True)), make.forest(2, (7, None, True), (8, 7, True)))
    t = make.tracks({"event_id": 1, "majority_particle_id": [2, None], "phi": [0.1, 0.2], "theta": [1.0, 1.0]})
    h = make.hits(*({"event_id": e, "x": [0.0], "contrib_particle_ids": [ids], "contrib_energies": [[1.0] * len(ids)]} for e, ids in ((1, [1, 2, 3, 4]), (2, [7, 8]))))
    assert pairs(ancestry.ultimate(p, most_nodes=most), "event_id", "particle_id", "ultimate_ancestor_id") == {(1, k): 1 for k in (1, 2, 3, 4)} | {(2, 7): 7, (2, 8): 7}
    assert pairs(ancestry.nearest_tracked(p, t, most_nodes=most), "event_id", "particle_id", "ancestor_with_track_id") == {(1, k): 2 for k in (2, 3, 4)}
    out = pairs(ancestry.first_outside(p, h, most_nodes=most), "event_id", "particle_id", "ancestor_outside_calo_id")
    assert out == {(1, 1): 1, (1, 2): 2, (1, 3): 2, (1, 4): 2, (2, 7): None, (2, 8): None}


@pytest.mark.parametrize("most", [1 << 20, 1])
def test_loops_end(make, most):
    p = make.particles(make.forest(1, (9, 9, False)), make.forest(2, (10, 11, False), (11, 10, False)), make.forest(3, (12, 13, False), (13, 14, False), (14, 12, False), (15, 12, False)))
    got = pairs(ancestry.ultimate(p, most_nodes=most), "event_id", "particle_id", "ultimate_ancestor_id")
    assert got == {(1, 9): 9, (2, 10): None, (2, 11): None} | {(3, k): None for k in (12, 13, 14, 15)}


def test_orphans_and_entering(make):
    p = make.particles(make.forest(1, (5, 99, False), (6, 5, True)), make.forest(2, (1, None, False)), {"event_id": 3, "particle_id": [], "parent_id": []})
    m = masks.add_enter_mask(masks.add_orphan_mask(p))
    assert pairs(masks.mask_values(m, "is_parent_missing"), "event_id", "particle_id", "is_parent_missing") == {(1, 5): True, (1, 6): False, (2, 1): True}
    assert pairs(masks.mask_values(m, "enter_calo"), "event_id", "particle_id", "enter_calo")[(1, 5)] is True
    assert m.where("event_id = 3").first().is_parent_missing == []
    again = masks.add_orphan_mask(m)
    assert again.columns.count("is_parent_missing") == 1


def test_absent_parent_is_reported_by_the_cycle_walk(make):
    p = make.particles(make.forest(1, (5, 99, False), (6, 5, False), (7, 7, False), (8, 9, False), (9, 8, False)))
    got = {r.particle_id: (r.ancestor_id, r.in_cycle) for r in ancestry.ancestors_with_cycles(p).collect()}
    assert got == {5: (99, False), 6: (99, False), 7: (7, False), 8: (None, True), 9: (None, True)}


def test_ids_repeat_between_events(make):
    p = make.particles(make.forest(1, (1, None, False), (2, 1, False)), make.forest(2, (2, None, False)))
    assert ult(p)[(2, 2)] == 2


def test_nan_parents(spark):
    df = spark.createDataFrame([([float("nan"), None, 1.0],)], "parent_id array<double>")
    assert masks.cast_parent_ids(df).first().parent_id == [None, None, 1]


def test_calibrated_purity(make, spark):
    p = make.particles(make.forest(1, (1, None, False), (2, None, False), (3, None, False), energy=[150.0, 4.0, 0.0]))
    h = make.hits({"event_id": 1, "detector": [10, 15, 10], "x": [0.0] * 3, "contrib_particle_ids": [[1], [1], [3]], "contrib_energies": [[2.0], [3.0], [1.0]]})
    r = {x.ultimate_ancestor_id: x for x in energy.particle_purity(h, ancestry.ultimate(p), p, schema.calibration(spark)).collect()}
    assert (r[1].total_energy_in_calo, r[1].purity) == (75.0, 0.5)
    assert (r[2].total_energy_in_calo, r[2].purity) == (0.0, 0.0)
    assert r[3].purity is None


def test_kinematics(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(3.0, 4.0, 0.0), (0.0, 0.0, 1.0), (0.0, 0.0, -1.0)], "px double, py double, pz double")
    a, up, down = df.select(K.pt("px", "py").alias("pt"), K.phi("px", "py").alias("phi"), K.eta("px", "py", "pz").alias("eta")).collect()
    assert a.pt == 5 and a.phi == math.atan2(4, 3) and abs(a.eta) < 1e-12
    assert up.eta == float("inf") and down.eta == float("-inf")
    d = spark.createDataFrame([(0.0, math.pi - 0.1, 0.0, -math.pi + 0.1)], "a double, b double, c double, d double").select(K.delta_r(*"abcd").alias("d")).first().d
    assert abs(d - 0.2) < 1e-12
    edge = spark.createDataFrame([(1250.0, 0.0), (315.0, 3201.0), (316.0, 3200.0), (316.0, 3201.0)], "r double, z double").select(K.inside_calo("r", F.lit(0.0), "z").alias("i"))
    assert [r.i for r in edge.collect()] == [False, False, False, True]


def test_top_percent(spark):
    df = spark.createDataFrame([(1, 0, k, float(k)) for k in range(10)] + [(2, 0, 0, 5.0), (2, 0, 1, 5.0), (2, 0, 2, None)], "event_id bigint, block_no int, pos int, energy double")
    got = {(r.event_id, r.pos) for r in points.percentile_mask(df, 4.0).where("is_top").collect()}
    assert got == {(1, 9), (2, 0)}
    assert points.percentile_mask(df.where("false"), 4.0).count() == 0


def test_completeness_and_cluster_purity(spark):
    kind = "event_id bigint, cluster_id bigint, block_no int, pos int, total_energy double, contrib_particle_ids array<bigint>, contrib_energies array<double>"
    hits = spark.createDataFrame([(1, 0, 0, 0, 3.0, [1], [3.0]), (1, 1, 0, 1, 1.0, [1], [1.0]), (1, -1, 0, 2, 4.0, [1], [4.0])], kind)
    r = energy.particle_completeness(hits).first()
    assert (r.completeness, r.is_perfect) == (3 / 8, False)
    hits = spark.createDataFrame([(1, 0, 0, 0, 2.0, [1, 2], [1.0, 0.5]), (1, -1, 0, 1, 2.5, [1, 2], [2.0, 0.5])], kind)
    assert energy.cluster_energy_purity(hits).first().purity == 0.5


def test_confusion(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "a boolean, b boolean")
    r = reports.confusion(df, "a", "b").first()
    assert tuple(r) == (1, 1, 1, 1, 0.5, 1 / 3)


def test_first_events_need_one(make):
    with pytest.raises(ValueError):
        reports.unique_cells(make.hits(), 0)


def test_flatten_and_regroup_are_inverse(make, rows):
    p = make.particles({"event_id": 1, "particle_id": [3, 1, 2], "parent_id": [None, 3, None], "energy": [None, 2.0, 1.0]}, {"event_id": 2, "particle_id": [], "energy": []})
    flat = nested.flatten(p, ("particle_id", "parent_id", "energy"))
    back = nested.regroup(flat, ("particle_id", "parent_id", "energy"))
    assert [tuple(r) for r in back.collect()] == [(1, 0, [3, 1, 2], [None, 3, None], [None, 2.0, 1.0])]


def test_missing_columns_are_named(make):
    with pytest.raises(ValueError, match="nothing_here"):
        schema.require_columns(make.tracks(), "nothing_here")
