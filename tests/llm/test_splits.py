import random

from nestra.llm import splits
from nestra.llm.contraction import components
from nestra.runtime import Workspace

ORIGINS = "event_id bigint, run_no int, campaign string, gen_seed bigint, resim_of bigint, generated_at timestamp, root string, g string, vertex string"


def origins(spark, *links):
    return spark.createDataFrame([(e, None, None, s, r, None, "clash", "clash", "clash") for e, s, r in links], ORIGINS)


def naive(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for u, v in edges:
        up[top(u)] = top(v)
    return {x: top(x) for x in list(up)}


def test_chains_stars_and_noise(spark):
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 80)] + [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(60)] + [(5, 5), (0, 1)]
    df = spark.createDataFrame([(0, *e) for e in edges] + [(1, *e) for e in edges[:5]] + [(0, None, 3), (None, 1, 2)], "g bigint, u bigint, v bigint")
    got = {(x.g, x.vertex): x.root for x in components(df, Workspace(spark)).collect()}
    want = naive(edges)
    for x in want:
        for y in want:
            same = got.get((0, x), x) == got.get((0, y), y)
            assert same == (want[x] == want[y])
    assert len({got.get((1, x), x) for x in range(6)}) == 1
    assert components(df.where("false"), Workspace(spark)).count() == 0


def test_common_origin(spark, rows):
    df = origins(spark, (1, 7, None), (1, 7, None), (2, 7, None), (3, 0, None), (4, 0, None), (5, None, 99), (6, None, 99), (8, None, 8), (9, None, 2), (None, 7, 3), (10, None, 11), (11, 5, None), (12, 5, None))
    assert rows(splits.common_origin(df)) == [(1, 2), (1, 9), (5, 6), (10, 11), (10, 12)]
    assert rows(splits.common_origin(origins(spark))) == []


def test_splits_keep_groups_and_shares(spark, make):
    r = random.Random(2)
    sizes = [400, 200, 100] + [r.randrange(1, 4) for _ in range(400)]
    h = make.hits(*[{"event_id": e, "block_no": b, "x": []} for e, n in enumerate(sizes) for b in range(n)], {"event_id": 0, "block_no": 0, "x": []}, {"event_id": None, "x": []}, more=("w", "h", "bucket"))
    p = make.particles({"event_id": 5000, "particle_id": [1]}, {"event_id": 3, "particle_id": [1]}, more=("split", "group_id"))
    o = origins(spark, (10, 1, None), (11, 1, None), (5000, 1, None))
    got = {x.event_id: x.split for x in splits.splits(p, h, o).collect()}
    assert len(got) == len(sizes) + 1 and got[10] == got[11] == got[5000]
    total = sum(sizes)
    for name, share in splits.SHARES:
        assert abs(sum(n for e, n in enumerate(sizes) if got[e] == name) - share * total) <= 0.01 * total
    assert got == {x.event_id: x.split for x in splits.splits(p, h, o).collect()}
    report = {x.split: x.n_blocks for x in splits.split_report(splits.splits(p, h, o), h).collect()}
    assert sum(report.values()) == total
    assert splits.splits(make.particles(), make.hits(), origins(spark)).count() == 0
    assert {x.split for x in splits.splits(make.particles(*[{"event_id": e, "particle_id": [1]} for e in range(200)]), make.hits(), origins(spark)).collect()} == {"train", "validation", "test"}


def test_a_group_beyond_its_share_leaves_the_rest_to_the_others(spark, make, rows):
    sizes = [1900] + [1] * 100
    h = make.hits(*[{"event_id": e, "block_no": b, "x": []} for e, n in enumerate(sizes) for b in range(n)])
    got = splits.splits(make.particles(), h, origins(spark, (3, 1, None), (4, 1, None), (5, None, 3)))
    n = {x.split: x.n_blocks for x in splits.split_report(got, h).collect()}
    assert n["train"] == 1900 and abs(n["validation"] - 50) <= 3 and abs(n["test"] - 50) <= 3
    o = origins(spark, (3, 1, None), (4, 1, None), (5, None, 3))
    assert splits.crossing(got, o).count() == 0
    wrong = spark.createDataFrame([(3, "train"), (4, "test"), (7, "train"), (7, "test"), (8, "train")], "event_id bigint, split string")
    assert rows(splits.crossing(wrong, o)) == [(3, 2), (7, 2), (7, 2)]
    assert rows(splits.shares_met(got, h)) == [("test", False), ("train", False), ("validation", False)]
