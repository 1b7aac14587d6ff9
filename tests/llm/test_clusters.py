import math

import numpy as np
import pytest

from conftest import at
from nestra.llm import clusters


def brute(records, near, least):
    """records: {event: [(block, pos, value)]} -> rows with the first member."""
    out = set()
    for e, rs in records.items():
        up = list(range(len(rs)))

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for i in range(len(rs)):
            for j in range(i):
                if near(rs[i][2], rs[j][2]):
                    up[top(i)] = top(j)
        groups = {}
        for i, (b, p, _) in enumerate(rs):
            groups.setdefault(top(i), []).append((b, p))
        for g in groups.values():
            if len(g) >= least:
                out |= {(e, *min(g), *m) for m in g}
    return out


@pytest.mark.parametrize(("seed", "scale"), [(1, 60.0), (2, 300.0), (3, 15.0), (4, 1e7)])
def test_hits_like_brute_force(make, seed, scale):
    r = np.random.default_rng(seed)
    blocks, records = [], {}
    for e in (1, 2):
        for b in range(6):
            p = r.normal(0, scale, (25, 3)).round(1)
            p[r.random(p.shape) < 0.02] = np.nan
            xyz = [[None if np.isnan(v) else float(v) for v in p[:, k]] for k in range(3)]
            blocks.append({"event_id": e, "block_no": b, "x": xyz[0], "y": xyz[1], "z": xyz[2]})
            records.setdefault(e, []).extend((b, i, p[i]) for i in range(25) if not np.isnan(p[i]).any())
    h = make.hits(*blocks, blocks[0] | {"ingested_at": at(4)}, {"event_id": None, "x": [0.0], "y": [0.0], "z": [0.0]}, {"event_id": 3, "x": [1.0], "y": None, "z": [1.0, 2.0]}, more=("bucket", "point", "label", "cx"))
    want = brute(records, lambda a, b: ((a - b) ** 2).sum() < 1600, 5)
    cols = ("event_id", "first_block_no", "first_pos", "block_no", "pos")
    for tuning in ({}, {"most_hits": 20}):
        got = [tuple(x) for x in clusters.hit_clusters(h, **tuning).select(*cols).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_limit_is_strict_and_equal_positions_join(make):
    line = [0.0, 40.0, 79.9, 119.8, 159.7, 199.6, 199.6]
    h = make.hits({"event_id": 1, "x": line, "y": [0.0] * 7, "z": [0.0] * 7})
    got = {x.pos: x.n_members for x in clusters.hit_clusters(h).collect()}
    assert got == dict.fromkeys(range(1, 7), 6)


def test_dense_cells_meet_in_strips(make, monkeypatch):
    r = np.random.default_rng(0)
    a, b = r.uniform(0, 20, (400, 3)), r.uniform(0, 20, (400, 3)) + [59.0, 0, 0]
    p = np.r_[a, b]
    monkeypatch.setattr(clusters, "PAIRS", 64)
    order, cell, root = clusters.cell_components(np.zeros(800, np.int64), p, 40.0)
    near = any((((a - y) ** 2).sum(1) < 1600).any() for y in b)
    label = np.empty(800, np.int64)
    label[order] = root[cell]
    assert (label[0] == label[-1]) == near and len(set(label)) == (1 if near else 2)


def test_tracks_close_on_themselves(make):
    pi = math.pi
    t = make.tracks(
        {"event_id": 1, "phi": [pi - 0.001, -pi + 0.01, -pi + 0.025, None, 1.0, 1.03, 1.05]}, {"event_id": 1, "phi": [pi - 0.001, -pi + 0.01, -pi + 0.025, None, 1.0, 1.03, 1.05], "ingested_at": at(1)},
        {"event_id": 1, "block_no": 1, "phi": [pi - 0.02, 3 * pi - 0.015, float("nan")]}, {"event_id": 2, "phi": [k * 0.0199 - pi for k in range(320)]}, {"event_id": 3, "phi": None}, {"event_id": None, "phi": [0.0]}, more=("bin", "lo", "c"),
    )
    got = {(x.event_id, x.block_no, x.pos): (x.first_block_no, x.first_pos, x.n_members) for x in clusters.track_clusters(t).collect()}
    assert {k: v for k, v in got.items() if k[0] == 1} == dict.fromkeys([(1, 0, 0), (1, 0, 1), (1, 0, 2), (1, 1, 0), (1, 1, 1)], (0, 0, 5))
    assert {v[2] for k, v in got.items() if k[0] == 2} == {320}


def test_empty(make):
    assert clusters.found(make.hits(), make.tracks()).count() == 0


def test_typical_members(make):
    h = make.hits({"event_id": 1, "x": [0.0, 1.0, 2.0, 3.0, 30.0], "y": [0.0] * 5, "z": [0.0] * 5}, more=("salt", "m"))
    got = sorted((x.rank, x.pos) for x in clusters.typical_hits(h).collect())
    assert got == [(1, 3), (2, 2), (3, 1)]


def test_typical_tracks(make):
    pi = math.pi
    phi = [pi - 0.015, -pi + 0.001, -pi + 0.01, None, 1.0, 1.01, 1.012, 1.029, 2.0]
    t = make.tracks({"event_id": 1, "phi": phi}, {"event_id": 1, "phi": phi, "ingested_at": at(1)}, {"event_id": 1, "block_no": 1, "phi": [3 * pi - 0.012]}, more=("salt", "mean", "d"))
    got = sorted(tuple(x) for x in clusters.typical_tracks(t).collect())
    assert got == [(1, 0, 0, 4, 1, 0, 1), (1, 0, 0, 4, 2, 1, 0), (1, 0, 0, 4, 3, 0, 0), (1, 0, 4, 4, 1, 0, 6), (1, 0, 4, 4, 2, 0, 5), (1, 0, 4, 4, 3, 0, 4)]
    assert clusters.typical_tracks(t, k=1, salts=1).count() == 2 and clusters.typical_tracks(make.tracks()).count() == 0


def cloud(make, seed=7, scale=60.0):
    r = np.random.default_rng(seed)
    blocks = [{"event_id": e, "block_no": b, **{c: [float(v) for v in r.normal(0, scale, 40).round(1)] for c in "xyz"}} for e in (1, 2) for b in range(5)]
    return make.hits(*blocks, blocks[0] | {"ingested_at": at(3)}, {"event_id": 3, "x": None}, {"event_id": 4, "x": [0.0] * 6, "y": [1.0] * 6, "z": [2.0] * 6}, more=("root", "base", "up", "first")), blocks


def naive_medoids(blocks, fine, similar=0.8):
    """Sets as Python sets, Jaccard of all pairs: {(event, block, pos): (medoid block, medoid pos, links)}."""
    out = {}
    for e in {b["event_id"] for b in blocks}:
        hits = [((b["block_no"], k), tuple(math.floor(b[c][k] / fine) for c in "xyz")) for b in blocks if b["event_id"] == e for k in range(len(b["x"]))]
        sets = {}
        for h, cell in hits:
            sets.setdefault(cell, []).append(h)
        shingles = {cell: {(axis, cell[axis] + d) for axis in range(3) for d in range(-8, 9)} for cell in sets}
        near = {a: [b for b in sets if len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b]) >= similar] for a in sets}
        links = {a: sum(len(sets[b]) for b in near[a]) for a in sets}
        up = {a: min(near[a], key=lambda b: (-links[b], min(sets[b]))) for a in sets}
        for a, hs in sets.items():
            top = a
            while up[top] != top:
                top = up[top]
            out |= {(e, *h): (*min(sets[top]), links[top]) for h in hs}
    return out


def test_medoids_like_brute_force(make):
    h, blocks = cloud(make)
    blocks = [*blocks, {"event_id": 4, "block_no": 0, "x": [0.0] * 6, "y": [1.0] * 6, "z": [2.0] * 6}]
    medoid = naive_medoids(blocks, 5.0)
    want = {}
    for r in clusters.hit_clusters(h).collect():
        key = (r.event_id, r.first_block_no, r.first_pos, r.n_members, *medoid[r.event_id, r.block_no, r.pos])
        want[key] = want.get(key, 0) + 1
    assert len(want) > 20 and (4, 0, 0, 6, 0, 0, 6) in want
    for tuning in ({}, {"most_hits": 30}):
        got = [tuple(r) for r in clusters.medoid_groups(h, **tuning).collect()]
        assert len(got) == len(want) and {r[:7]: r[7] for r in got} == want
    assert clusters.medoid_groups(make.hits()).count() == 0


def test_bands_find_most_links(make):
    h, _ = cloud(make, scale=150.0)
    pi = math.pi
    r = np.random.default_rng(1)
    t = make.tracks(*[{"event_id": e, "phi": [float(v) for v in r.uniform(-pi, pi, 200)]} for e in range(5)], more=("lo", "hi"))
    for tuning in ({}, {"most_hits": 30}):
        got = {x.record_kind: x for x in clusters.band_recall(h, t, **tuning).collect()}
        assert got["hit"].recall >= 0.9 and got["track"].recall >= 0.9 and got["hit"].n_near >= got["hit"].n_candidates > 0
        assert got["hit"].n_clusters <= got["hit"].n_band_groups <= 1.05 * got["hit"].n_clusters
    assert clusters.band_recall(make.hits(), make.tracks()).count() == 0


def test_jaccard_is_that_of_the_sets():
    r = np.random.default_rng(2)
    p = r.normal(0, 40, (60, 3))
    s = clusters.Shingles(np.zeros(60, np.int64), p, 40.0)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(s)), np.arange(len(s))))
    cells = np.floor(p[s.first] / 5.0).astype(int)
    sets = [{(k, c[k] + d) for k in range(3) for d in range(-8, 9)} for c in cells]
    assert np.allclose(s.jaccard(a, b), [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in zip(a, b, strict=True)])
    near = (((p[s.first][a] - p[s.first][b]) ** 2).sum(1) < 1600)
    assert (s.jaccard(a, b)[near] >= s.least).all()
    found = {(min(i, j), max(i, j)) for x, y in s.neighbours(5) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
    assert found == {(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if i < j and np.abs(cells[i] - cells[j]).sum() <= 5}
