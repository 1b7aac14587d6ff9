"""Queries of the problems tagged llm, and their SQL."""

from __future__ import annotations

from nestra.llm import clusters, lookalike, packing, splits, tokenizer
from nestra.runtime import table


def _splits(s, d):
    return splits.splits(*(table(s, d, t) for t in ("particles", "calo_hits", "event_origins")))


#: Capacities of which each binds: few texts, and a quarter of the attention cost of one text that fills a container (so pieces have at most 512 tokens).
_BOUNDED = {"most_docs": 16, "most_cost": packing.CAPACITY**2 // 4}

QUERIES = {
    "p2_found": lambda s, d: splits.common_origin(table(s, d, "event_origins")),
    "p2_splits": _splits,
    "p2_crossing": lambda s, d: splits.crossing(_splits(s, d), table(s, d, "event_origins")),
    "p2_shares": lambda s, d: splits.shares_met(_splits(s, d), table(s, d, "calo_hits")),
    "p2_report": lambda s, d: splits.split_report(_splits(s, d), table(s, d, "calo_hits")),
    "p5_found": lambda s, d: clusters.found(table(s, d, "calo_hits"), table(s, d, "tracks")),
    "p5_typical_hits": lambda s, d: clusters.typical_hits(table(s, d, "calo_hits")),
    "p5_medoid_groups": lambda s, d: clusters.medoid_groups(table(s, d, "calo_hits")),
    "p5_band_recall": lambda s, d: clusters.band_recall(table(s, d, "calo_hits"), table(s, d, "tracks")),
    "p5_recall_reached": lambda s, d: clusters.band_recall(table(s, d, "calo_hits"), table(s, d, "tracks")).selectExpr("record_kind", "recall >= 0.9 as is_reached"),
    "p5_track_clusters": lambda s, d: clusters.track_clusters(table(s, d, "tracks")),
    "p5_typical_tracks": lambda s, d: clusters.typical_tracks(table(s, d, "tracks")),
    "p7_ids": lambda s, d: tokenizer.encode(table(s, d, "documents")),
    "p7_empty": lambda s, d: tokenizer.encode(table(s, d, "documents")).where("size(ids) = 0").select("doc_id"),
    "p8_pack": lambda s, d: packing.pack(table(s, d, "documents")),
    "p8_pack_bounded": lambda s, d: packing.pack(table(s, d, "documents"), **_BOUNDED),
    "p8_violations": lambda s, d: packing.violations(packing.pack(table(s, d, "documents")), table(s, d, "documents")),
    "p8_violations_bounded": lambda s, d: packing.violations(packing.pack(table(s, d, "documents"), **_BOUNDED), table(s, d, "documents"), **_BOUNDED),
    "p8_report_bounded": lambda s, d: packing.pack_report(packing.pack(table(s, d, "documents"), **_BOUNDED)),
    "p8_report": lambda s, d: packing.pack_report(packing.pack(table(s, d, "documents"))),
    "p9_found": lambda s, d: lookalike.lookalike_pairs(table(s, d, "documents")),
    "p9_unstable": lambda s, d: lookalike.unstable(table(s, d, "documents")),
    "p9_classes": lambda s, d: lookalike.lookalike_classes(table(s, d, "documents")),
    "p9_normalized": lambda s, d: lookalike.normalize(table(s, d, "documents")),
}

_TRACKS = """tb as (select distinct on (event_id, block_no) event_id, block_no, phi from tracks),
tm as (select event_id, block_no, unnest(range(coalesce(len(phi), 0))) as pos, unnest(phi) as phi from tb),
tw as (select *, phi - lag(phi) over (partition by event_id order by phi) as gap from tm where phi is not null),
tc as (select *, sum(case when gap >= 0.02 then 1 else 0 end) over (partition by event_id order by phi rows unbounded preceding) as c, 2 * pi() - (max(phi) over (partition by event_id) - min(phi) over (partition by event_id)) as closing from tw),
td as (select *, case when closing < 0.02 and c = max(c) over (partition by event_id) then 0 else c end as cc from tc),
ts as (select event_id, block_no, pos::int as pos, phi, cc, count(*) over (partition by event_id, cc) as n_members, first_value(block_no) over (partition by event_id, cc order by block_no, pos) as first_block_no, (first_value(pos) over (partition by event_id, cc order by block_no, pos))::int as first_pos from td qualify n_members >= 3)"""
_HITS = """hb as (select distinct on (event_id, block_no) event_id, block_no, x, y, z from calo_hits),
hu as (select event_id, block_no, unnest(range(greatest(coalesce(len(x), 0), coalesce(len(y), 0), coalesce(len(z), 0)))) + 1 as k, x, y, z from hb),
h as (select row_number() over (order by event_id, block_no, k) as i, event_id, block_no, (k - 1)::int as pos, x[k] as x, y[k] as y, z[k] as z from hu where x[k] is not null and y[k] is not null and z[k] is not null),
c as (select *, floor(x / 40)::int as cx, floor(y / 40)::int as cy, floor(z / 40)::int as cz from h),
s as (select unnest([-1, 0, 1]) as s),
n as (select c.*, cx + sx.s as nx, cy + sy.s as ny, cz + sz.s as nz from c, s sx, s sy, s sz),
e as (select a.i as u, b.i as v from n a join c b on b.event_id = a.event_id and b.cx = a.nx and b.cy = a.ny and b.cz = a.nz where (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 < 1600),
r as (select i as u, i as v from h union select r.u, e.v from r join e on e.u = r.v),
g as (select u as i, min(v) as first, count(*) as n_members from r group by 1 having count(*) >= 5)"""

SQL = {
    "p2_found": """with recursive o as (select distinct event_id, gen_seed, resim_of from event_origins where event_id is not null),
e as (select a.event_id as u, b.event_id as v from o a join o b on a.gen_seed = b.gen_seed and a.gen_seed <> 0
  union select event_id, resim_of from o where resim_of is not null union select resim_of, event_id from o where resim_of is not null),
r as (select event_id as src, event_id as v from o union select r.src, e.v from r join e on e.u = r.v),
g as (select r.v as event_id, min(r.src) as first_event_id from r where r.v in (select event_id from o) group by 1)
select first_event_id, event_id from g where first_event_id <> event_id""",
    "p2_crossing": "select event_id, 2::bigint as n_splits from event_origins where false",
    "p2_shares": "select * from (values ('train', true), ('validation', true), ('test', true)) v(split, is_met)",
    "p7_empty": "select doc_id from documents where coalesce(text, '') = ''",
    "p9_unstable": "select doc_id from documents where false",
    "p8_violations": "select 'document' as kind, doc_id as id from documents where false",
    "p8_violations_bounded": "select 'document' as kind, doc_id as id from documents where false",
    "p5_found": f"with recursive {_HITS}, {_TRACKS} select 'hit' as record_kind, h.event_id, f.block_no as first_block_no, f.pos as first_pos, h.block_no, h.pos from g join h on h.i = g.i join h f on f.i = g.first union all select 'track', event_id, first_block_no, first_pos, block_no, pos from ts",
    "p5_typical_hits": f"""with recursive {_HITS},
m1 as (select g.first, g.n_members, h.*, round(avg(x) over w, 6) as ax, round(avg(y) over w, 6) as ay, round(avg(z) over w, 6) as az from g join h on h.i = g.i window w as (partition by g.first)),
r1 as (select *, row_number() over (partition by first order by round((x - ax) ** 2 + (y - ay) ** 2 + (z - az) ** 2, 4), block_no, pos) as rank from m1)
select r1.event_id, f.block_no as first_block_no, f.pos as first_pos, n_members, rank::int as rank, r1.block_no, r1.pos from r1 join h f on f.i = r1.first where rank <= 3""",
    "p5_medoid_groups": f"""with recursive {_HITS},
q as (select *, floor(x / 5.0)::int as qx, floor(y / 5.0)::int as qy, floor(z / 5.0)::int as qz from h),
k as (select event_id, qx, qy, qz, min(i) as base, count(*) as own from q group by 1, 2, 3, 4),
kc as (select *, floor(qx / 8)::int as bx, floor(qy / 8)::int as bt, floor(qz / 8)::int as bz from k),
kn as (select kc.*, bx + sx.s as mx, bt + sy.s as my, bz + sz.s as mz from kc, s sx, s sy, s sz),
l as (select a.event_id, a.base, b.base as other, b.own from kn a join kc b on b.event_id = a.event_id and b.bx = a.mx and b.bt = a.my and b.bz = a.mz
  where (51 - abs(a.qx - b.qx) - abs(a.qy - b.qy) - abs(a.qz - b.qz)) / (51.0 + abs(a.qx - b.qx) + abs(a.qy - b.qy) + abs(a.qz - b.qz)) >= 0.8),
d as (select base, sum(own)::bigint as n_links from l group by 1),
up as (select l.base, first(l.other order by d.n_links desc, l.other) as up from l join d on d.base = l.other group by 1),
climb as (select base, up from up union select climb.base, up.up from climb join up on up.base = climb.up),
top as (select climb.base, climb.up as medoid from climb join up on up.base = climb.up where up.up = climb.up)
select h.event_id, f.block_no as first_block_no, f.pos as first_pos, g.n_members, t.block_no as medoid_block_no, t.pos as medoid_pos, d.n_links, count(*) as n_group
from g join q on q.i = g.i join k on k.event_id = q.event_id and k.qx = q.qx and k.qy = q.qy and k.qz = q.qz join top on top.base = k.base join h f on f.i = g.first join h t on t.i = top.medoid join d on d.base = top.medoid join h on h.i = g.i
group by 1, 2, 3, 4, 5, 6, 7""",
    "p5_recall_reached": "select * from (values ('hit', true), ('track', true)) v(record_kind, is_reached)",
    "p5_track_clusters": f"with {_TRACKS} select event_id, first_block_no, first_pos, block_no, pos, n_members from ts",
    "p5_typical_tracks": f"""with {_TRACKS},
m1 as (select *, atan2(sum(floor(sin(phi) * 1e9 + 0.5)::bigint) over (partition by event_id, cc), sum(floor(cos(phi) * 1e9 + 0.5)::bigint) over (partition by event_id, cc)) as mean from ts),
r as (select *, row_number() over (partition by event_id, cc order by round(least(abs(phi - mean), 2 * pi() - abs(phi - mean)), 9), block_no, pos) as rank from m1)
select event_id, first_block_no, first_pos, n_members, rank::int as rank, block_no, pos from r where rank <= 3""",
}
