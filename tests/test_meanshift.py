import math

import numpy as np
import pytest

from nestra.operators import meanshift as M
from nestra.operators import points


def test_blobs_across_the_seam():
    p = np.array([(0, math.pi - 0.02), (0, -math.pi + 0.02), (0.01, math.pi - 0.01), (3, 0), (3.01, 0.01)])
    label, centres = M.fit(p, 0.4, True)
    assert len(centres) == 2 and len(set(label[:3])) == 1 and label[3] == label[4] != label[0]


def brute(p, bandwidth, angular):
    """One seed at a time, without a grid."""
    out = []
    for s in M.bin_seeds(p, bandwidth):
        q = s.copy()
        for _ in range(M.MAX_ITER):
            near = p[M._delta(p, q[None], angular) <= bandwidth]
            if not len(near):
                break
            new = near.mean(0)
            if angular:
                new[1] = math.atan2(np.sin(near[:, 1]).sum(), np.cos(near[:, 1]).sum())
            done = M._delta(new[None], q[None], angular)[0] < M.STOP * bandwidth
            q = new
            if done:
                break
        if len(near):
            out.append((len(near), *np.round(q, 6)))
    return sorted(out)


@pytest.mark.parametrize(("angular", "bandwidth"), [(True, 0.3), (True, 2.5), (False, 0.5)])
def test_climbs_like_brute_force(angular, bandwidth):
    r = np.random.default_rng(3)
    p = np.c_[r.normal(0, 1, 150), r.uniform(-math.pi, math.pi, 150)]
    label, centres = M.fit(p, bandwidth, angular)
    tops = np.array([b[1:] for b in brute(p, bandwidth, angular)])
    for c in centres:
        assert (M._delta(tops, c[None], angular) < 1e-5).any()
    assert (label == np.array([M._delta(centres, x[None], angular).argmin() for x in p])).all()


def test_edges():
    assert len(M.fit(np.zeros((0, 2)), 1.0, True)[0]) == 0
    assert M.fit(np.array([[np.nan, 1.0]]), 1.0, True)[0].tolist() == [0]
    with pytest.raises(ValueError):
        M.fit(np.zeros((3, 2)), 0.1, False, seeds=np.array([[9.0, 9.0]]))
    label, _ = M.fit(np.array([[0.0, 0.0], [0.1, 0.0], [5.0, 0.0]]), 1.0, False, seeds=np.array([[0.0, 0.0]]), cluster_all=False)
    assert label.tolist() == [0, 0, -1]
    assert M.estimate_bandwidth(np.array([[0.0, 0.0], [1.0, 0.0], [3.0, 0.0], [3.5, 0.0]]), False, 0.5) == pytest.approx((1 + 1 + 0.5 + 0.5) / 4)


def test_split_and_two_levels(make, spark):
    h = make.hits({"event_id": 1, "x": [100.0, 101.0, -100.0], "y": [0.0, 1.0, 0.0], "z": [0.0, 0.0, 0.0], "total_energy": [1.0, 2.0, 3.0]})
    t = make.tracks({"event_id": 1, "majority_particle_id": [1], "phi": [0.0], "theta": [math.pi / 2]})
    both = points.cluster_points(h, t)
    got = sorted((r.n_calo, r.n_tracks) for r in points.split_events(both, 0.4).collect())
    assert got == [(1, 0), (2, 1)]
    assert [(r.n_calo, r.n_tracks) for r in points.split_events(both, -1.0).collect()] == [(3, 1)]
    two = M.two_level(points.hit_points(h).select("event_id", "block_no", "pos", "eta", "phi", "energy"), large=1).collect()
    assert len(two) == 3


def test_angular_seeds_move_to_the_mean_of_their_points():
    r = np.random.default_rng(5)
    p = np.c_[r.normal(0, 1, 200), r.uniform(-math.pi, math.pi, 200)]
    size, bins = 0.6, {}
    for x in p:
        bins.setdefault(tuple(np.round(x / size)), []).append(x)
    seeds = np.array(list(bins)) * size
    near = np.array([[math.hypot(s[0] - x[0], min(abs(s[1] - x[1]) % M.TURN, M.TURN - abs(s[1] - x[1]) % M.TURN)) for s in seeds] for x in p]).argmin(1)
    want = np.array([p[near == k].mean(0) if (near == k).any() else s for k, s in enumerate(seeds)])
    got = M.angular_seeds(p, size)
    by = lambda a: a[np.lexsort(a.T.round(9))]
    assert len(seeds) < 200 and np.allclose(by(got), by(want)) and not np.allclose(by(got), by(seeds))


def test_clusters_of_events_start_from_the_moved_seeds(spark):
    r = np.random.default_rng(3)
    p = np.c_[r.normal(0, 1, 150), r.uniform(-math.pi, math.pi, 150)]
    df = spark.createDataFrame([(1, k, float(a), float(b)) for k, (a, b) in enumerate(p)], "event_id bigint, pos int, eta double, phi double")
    got = {x.pos: x.cluster_id for x in M.mean_shift(df, ("eta", "phi"), 0.3, angular=True).collect()}
    moved, still = M.fit(p, 0.3, True, seeds=M.angular_seeds(p, 0.3))[0], M.fit(p, 0.3, True)[0]
    assert [got[k] for k in range(150)] == moved.tolist() != still.tolist()


def test_two_levels_of_hits_and_tracks(make, spark):
    from nestra.plans import reference

    # Hits at phi 0 and 0.1, tracks beside them: two hits more than `large`, three points with tracks.
    hit = lambda e, pos, phi, energy: (e, 0, pos, True, 0.0, phi, energy)
    track = lambda e, pos, phi: (e, 1, pos, False, 0.0, phi, 0.0)
    rows = [hit(1, 0, 0.0, 2.0), hit(1, 1, 0.1, 1.0), track(1, 0, 0.101), hit(2, 0, 0.0, 1.0), track(2, 0, 0.1), track(2, 1, 0.1), track(3, 0, 1.0)]
    df = spark.createDataFrame(rows, "event_id bigint, block_no int, pos int, is_calo boolean, eta double, phi double, energy double")
    got = {(r.event_id, r.is_calo, r.pos): (r.cluster_id, r.sub_id) for r in M.two_level(df, large=1, top_percent=100.0).collect()}
    assert len(got) == 7 and {v[0] for v in got.values()} == {0}
    assert got[1, True, 0][1] != got[1, True, 1][1] == got[1, False, 0][1]
    assert {v[1] for k, v in got.items() if k[0] > 1} == {0}  # one hit only: not divided
    d = "/root/testdata/sf0.001"
    n = points.cluster_points(spark.read.parquet(f"{d}/calo_hits.parquet"), spark.read.parquet(f"{d}/tracks.parquet")).groupBy("event_id").count()
    n = {r["event_id"]: r["count"] for r in n.collect()}
    assert {r.event_id: r.n_points for r in reference.QUERIES["bandwidth_estimate"](spark, d).collect()} == n
    two = reference.QUERIES["hierarchical_meanshift"](spark, d).groupBy("event_id").count().collect()
    assert {r["event_id"]: r["count"] for r in two} == n


@pytest.mark.parametrize(("angular", "weight", "bandwidth"), [(True, None, 0.5), (True, "w", 0.5), (False, None, 0.7), (False, "w", -1.0)])
def test_large_events_in_chunks(spark, angular, weight, bandwidth):
    r = np.random.default_rng(8)
    p = np.c_[r.normal(0, 1, 120), r.uniform(-math.pi, math.pi, 120)]
    rows = [(e, k, float(a), float(b), float(w)) for e in (1, 2) for k, ((a, b), w) in enumerate(zip(p[: 120 if e == 1 else 15], r.uniform(0.1, 2, 120)))]
    df = spark.createDataFrame(rows, "event_id bigint, pos int, eta double, phi double, w double")
    run = lambda **kw: {(x.event_id, x.pos): (x.cluster_id, round(x.c_eta, 6), round(x.c_phi, 6)) for x in M.mean_shift(df, ("eta", "phi"), bandwidth, angular=angular, weight=weight, cluster_all=weight is not None, **kw).collect()}
    whole, divided = run(), run(most_points=40)
    assert len(whole) == 135 and str(whole) == str({k: divided[k] for k in whole})


def test_reports_over_any_labels(make, spark, rows):
    h = make.hits({"event_id": 1, "x": [0.0, 1.0, 500.0], "y": [0.0] * 3, "z": [0.0] * 3, "total_energy": [1.0, 2.0, 3.0], "contrib_particle_ids": [[1], [1, 2], [1]], "contrib_energies": [[1.0], [1.0, 1.0], [2.0]]}, {"event_id": 2, "x": [0.0], "y": [0.0], "z": [0.0]})
    labels = M.mean_shift(points.hit_points(h).select("event_id", "block_no", "pos", "x", "y", "z"), ("x", "y", "z"), 100.0)
    assert M.not_nearest(labels, ("x", "y", "z")).count() == 0
    from pyspark.sql import functions as F

    assert M.not_nearest(labels.withColumn("c_x", F.when(F.col("pos") == 2, 0.0).otherwise(F.col("c_x") + F.col("pos"))), ("x", "y", "z")).count() > 0
    on = labels.select("event_id", "block_no", "pos", (F.col("pos") != 1).alias("is_on"))
    assert rows(points.cardinality_of_events(labels)) == [(1, 0, 2, 0), (1, 1, 1, 1), (2, 0, 1, 2)]
    assert rows(points.cardinality_of_events(labels, on)) == [(1, 0, 1, 0), (1, 1, 1, 1), (2, 0, 1, 2)]
    noisy = labels.withColumn("cluster_id", F.lit(-1))
    assert rows(points.cardinality_of_events(noisy)) == [] and rows(points.cardinality_of_events(noisy, keep_noise=True)) == [(1, -1, 3, 0), (2, -1, 1, 1)]
    with pytest.raises(Exception, match="not of the same points"):
        points.cardinality_of_events(labels, on.where("pos < 2")).collect()
    from nestra.operators import energy

    got = rows(energy.particle_completeness(energy.with_labels(h, labels.where("event_id = 1"))))
    assert got == [(1, 1, 0.5, False), (1, 2, 1.0, True)]


@pytest.mark.parametrize(("angular", "quantile"), [(True, 0.3), (False, 0.3), (True, 0.0), (True, 1.0)])
def test_bandwidth_by_rings_is_that_of_all_pairs(angular, quantile):
    r = np.random.default_rng(4)
    p = np.r_[np.c_[r.normal(0, 1, 1500), r.uniform(-math.pi, math.pi, 1500)], np.c_[r.normal(2, 0.05, 1500), np.asarray(M.wrap(r.normal(math.pi, 0.05, 1500)))], np.zeros((20, 2))]
    k = max(1, int(len(p) * quantile))
    assert M.estimate_bandwidth(p, angular, quantile) == pytest.approx(M._kth_brute(p, p, k, angular) / len(p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize(("angular", "weight", "bandwidth"), [(True, None, 0.5), (True, "w", 0.5), (False, None, 0.7)])
def test_centres_of_a_large_event_need_rounds_only_beyond_most_gathered(spark, monkeypatch, angular, weight, bandwidth):
    r = np.random.default_rng(8)
    p = np.c_[r.normal(0, 1, 120), r.uniform(-math.pi, math.pi, 120)]
    rows = [(e, k, float(a), float(b), float(w)) for e in (1, 2, None) for k, ((a, b), w) in enumerate(zip(p[: 120 if e == 1 else 15], r.uniform(0.1, 2, 120)))]
    df = spark.createDataFrame(rows, "event_id bigint, pos int, eta double, phi double, w double")
    run = lambda df, **kw: {(x.event_id, x.pos): (x.cluster_id, round(x.c_eta, 6), round(x.c_phi, 6)) for x in M.mean_shift(df, ("eta", "phi"), bandwidth, angular=angular, weight=weight, cluster_all=weight is not None, **kw).collect()}
    whole, rounds, seen = run(df), M._large_centres, []
    monkeypatch.setattr(M, "_large_centres", lambda *a: seen.append(1) or rounds(*a))
    assert len(whole) == 150 and str(whole) == str({k: v for k, v in sorted(run(df, most_points=40).items(), key=lambda i: list(whole).index(i[0]))}) and not seen
    divided = run(df, most_points=40, most_gathered=100)
    assert str(whole) == str({k: divided[k] for k in whole}) and seen
    assert run(df.where("pos < 0")) == {}


@pytest.mark.parametrize(("angular", "n_centres"), [(True, 300), (False, 300), (True, 3)])
def test_nearest_by_boxes_is_that_of_all_pairs(angular, n_centres):
    r = np.random.default_rng(6)
    p = np.r_[np.c_[r.normal(0, 1, 9000), r.uniform(-math.pi, math.pi, 9000)], np.zeros((3000, 2)), np.c_[r.integers(-3, 3, (3000, 2)) / 2]]
    c = np.r_[r.integers(-6, 6, (n_centres, 2)) / 2, [[0.0, math.pi], [0.0, -math.pi]]]
    label, best = M._nearest(p, c, angular)
    d = np.stack([M._delta(p, x[None], angular) for x in c], 1)
    assert (label == d.argmin(1)).all() and (best == d.min(1)).all()


@pytest.mark.parametrize("radius", [0.05, 0.2, 2.9])
def test_strips_sum_what_a_grid_sums(radius):
    r = np.random.default_rng(9)
    p = np.r_[np.c_[r.normal(0, 1, 4000), r.uniform(-math.pi, math.pi, 4000)], np.c_[r.normal(1, 0.05, 3000), np.asarray(M.wrap(r.normal(math.pi, 0.05, 3000)))], np.full((50, 2), 0.5), [[0.0, math.pi], [0.0, -math.pi], [9.0, 0.0]]]
    q = np.r_[p[::20], p[-3:], r.uniform(-12, 12, (50, 2)), [[0.5, 0.5 + radius], [0.5 - radius, 0.5]]]
    want, got = M._around(M._Grid(p, radius, True), p, np.ones(len(p)), q, True), M._Strips(p, radius).sums(q)
    assert (got[2] == want[2]).all() and (got[1] == want[1]).all() and np.allclose(got[0], want[0], rtol=0, atol=1e-8)


def test_two_levels_of_a_dense_event_look_at_few_pairs(spark, monkeypatch):
    r = np.random.default_rng(2)
    p = np.r_[np.c_[r.normal(0, 0.1, 12000), r.normal(math.pi, 0.1, 12000)], np.c_[r.normal(1, 0.3, 3000), r.normal(0, 0.3, 3000)]]
    e = r.uniform(0, 1, len(p))
    seeds = p[np.argsort(-e)[:600]]
    pairs, delta = [0], M._delta

    def counted(a, b, angular):
        d = delta(a, b, angular)
        pairs[0] += d.size
        return d

    monkeypatch.setattr(M, "_delta", counted)
    label, centres = M.fit(p, 0.2, True, seeds=seeds)
    assert pairs[0] < 6e6  # a grid of cells as wide as the radius alone looks at more than 1e7 in the first step
    for c in centres:  # each is the mean of what lies around it
        x = p[delta(p, c[None], True) <= 0.2]
        mean = np.array([[x[:, 0].mean(), math.atan2(np.sin(x[:, 1]).sum(), np.cos(x[:, 1]).sum())]])
        assert delta(mean, c[None], True)[0] < 4 * M.STOP * 0.2
    assert (label == delta(p[:, None], centres[None], True).argmin(1)).all()
    rows = [(k % 2, k, float(a), float(b), float(x)) for k, ((a, b), x) in enumerate(zip(p[::10], e[::10]))]
    df = spark.createDataFrame(rows, "event_id bigint, pos int, eta double, phi double, energy double")
    run = lambda **kw: sorted((x.event_id, x.pos, x.cluster_id, x.sub_id) for x in M.two_level(df, large=100, **kw).collect())
    assert run() == run(most_points=100) and len({x[3] for x in run()}) > 1


def test_many_ends_of_climbs_have_the_centres_of_all_pairs():
    r = np.random.default_rng(1)
    at, n = np.r_[r.normal(0, 1, (1500, 2)), r.normal(0, 1e-3, (1500, 2))], r.integers(0, 50, 3000)
    want, left = [], sorted(((int(k), *x) for k, x in zip(n, at.tolist()) if k), reverse=True)
    while left:
        want.append(left[0][1:])
        left = [x for x in left if math.hypot(x[1] - left[0][1], x[2] - left[0][2]) > 0.3]
    assert M._winners(at, n, 0.3, False).tolist() == [list(x) for x in want]


def test_points_nearer_to_another_centre_are_found_without_lists_of_centres(spark, monkeypatch):
    r = np.random.default_rng(4)
    at, c = r.normal(0, 3, (90, 2)), np.array([[-2.0, 0.0], [0.0, 1.0], [2.0, -1.0], [0.0, 0.0]])
    label = r.integers(-1, 4, 90)
    rows = [(k % 3 or None, k % 2, k, int(i), *map(float, at[k]), *(map(float, c[i]) if i >= 0 else (math.nan, math.nan))) for k, i in enumerate(label)]
    df = spark.createDataFrame(rows, "event_id bigint, block_no int, pos int, cluster_id int, x double, y double, c_x double, c_y double")
    df = df.where("event_id is not null")
    want = set()
    for e in (1, 2):
        of = [x for x in rows if x[0] == e and x[3] >= 0]
        for x in of:
            if any(math.dist(x[4:6], y[6:]) < math.dist(x[4:6], x[6:]) * (1 - 1e-6) for y in of):
                want.add(x[:3])
    monkeypatch.setattr(M.F, "collect_list", None)
    for most in (1000, 10):
        assert {tuple(x) for x in M.not_nearest(df, ("x", "y"), most_points=most).collect()} == want
    assert want


def test_clusters_are_found_once_for_their_index(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(20).selectExpr("id div 4 as event_id", "cast(0 as int) as block_no", "cast(id as int) as pos", "cast(id % 2 as int) as cluster_id")
    got = sorted(tuple(x) for x in points.cardinality_of_events(df.mapInArrow(once, df.schema)).collect())
    assert [x[3] for x in got] == list(range(10)) and seen.value == 20


@pytest.mark.parametrize(("angular", "n_centres"), [(True, 300), (False, 300), (True, 3), (True, 1)])
def test_nearest_by_raster_is_that_of_all_pairs_without_boxes(monkeypatch, angular, n_centres):
    r = np.random.default_rng(16)
    p = np.r_[np.c_[r.normal(0, 1, 9000), r.uniform(-math.pi, math.pi, 9000)], np.zeros((3000, 2)), np.c_[r.integers(-3, 3, (3000, 2)) / 2], [[4.0, math.pi], [-4.0, -math.pi]]]
    c = np.r_[r.integers(-6, 6, (n_centres, 2)) / 2, [[0.0, math.pi], [0.0, -math.pi], [1e6, 0.0]]]
    monkeypatch.setattr(M, "_boxes", None)  # their halving took most of a large event's time
    for x in (p, p * [1, 0], p + [1e6, 0]):
        label, best = M._nearest(x, c, angular)
        d = np.stack([M._delta(x, y[None], angular) for y in c], 1)
        assert (label == d.argmin(1)).all() and (best == d.min(1)).all()


@pytest.mark.parametrize("bandwidth", [0.5, -1.0])
def test_kept_columns_are_those_of_all(spark, rows, bandwidth):
    df = spark.range(60).selectExpr("id % 2 as event_id", "cast(id as int) as pos", "cast(sin(id) as double) as eta", "cast(cos(id * 3) as double) as phi").where("event_id = 0 or pos < 9")
    keep, run = ("cluster_id", "event_id", "pos"), lambda **kw: M.mean_shift(df, ("eta", "phi"), bandwidth, angular=True, **kw)
    for most in (1000, 10):
        got = run(most_points=most, keep=keep)
        assert got.columns == [*keep] and rows(got) == rows(run(most_points=most), *keep)


@pytest.mark.parametrize("spread", [3, 3000])
def test_unique_rows_with_and_without_sorting(spread):
    a = np.rint(np.random.default_rng(2).normal(-5, spread, (2000, 2)))
    rows, inverse, n = M._unique_rows(a)
    want = np.unique(a, axis=0, return_counts=True)
    assert (rows == want[0]).all() and (n == want[1]).all() and (rows[inverse] == a).all()


@pytest.mark.parametrize(("angular", "weighted", "cluster_all", "bandwidth"), [(True, False, False, 0.2), (True, False, True, 0.4), (True, True, True, 0.4), (True, False, True, 2.9), (False, False, False, 0.5)])
def test_many_small_events_at_once_are_those_one_by_one(monkeypatch, angular, weighted, cluster_all, bandwidth):
    r = np.random.default_rng(12)
    n = np.r_[1, 2, 1, r.integers(1, 120, 300), M._Few.MOST]
    p = np.c_[r.normal(0, 1.5, n.sum()), np.asarray(M.wrap(r.normal(math.pi, 1, n.sum())))]
    p[10:40], p[50, 0], p[60, 1], p[70:90] = p[10], np.nan, math.pi, np.rint(p[70:90] * 2) / 2
    w, parts = r.uniform(0, 2, len(p)) if weighted else None, np.split(np.arange(len(p)), np.cumsum(n)[:-1])
    one = lambda i: M.fit(p[i], bandwidth, angular, seeds=M.angular_seeds(p[i], bandwidth) if angular else None, weights=None if w is None else w[i], cluster_all=cluster_all)
    want = [one(i) for i in parts]
    monkeypatch.setattr(M, "_climb", None)  # no climb of an event's own
    label, at = M.fit_many(p, n, bandwidth, angular, w, cluster_all)
    assert label.tolist() == np.concatenate([x[0] for x in want]).tolist()
    assert np.array_equal(at, np.concatenate([np.where((x[0] >= 0)[:, None], x[1][x[0]], np.nan) for x in want]), equal_nan=True)


def test_small_events_of_a_task_do_not_climb_one_by_one(spark):
    r = np.random.default_rng(13)
    rows = [(e or None, k, float(a), float(b)) for e in range(40) for k, (a, b) in enumerate(r.normal(0, 1, (300 if e == 7 else 20, 2)))]
    df = spark.createDataFrame(rows, "event_id bigint, pos int, eta double, phi double")
    got = {(x.event_id, x.pos): x.cluster_id for x in M.mean_shift(df, ("eta", "phi"), 0.5, angular=True).collect()}
    for e in range(40):
        x = np.array([y[2:] for y in rows if y[0] == (e or None)])
        assert [got[e or None, k] for k in range(len(x))] == M.fit(x, 0.5, True, seeds=M.angular_seeds(x, 0.5))[0].tolist()
