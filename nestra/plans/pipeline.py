"""Queries of the general training-data problems 1, 3, 4 and 6, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestra.operators import hierarchy, merkle, orphan_refs, tree_aggregate
from nestra.runtime import table


def _orphans(spark, d):
    return orphan_refs.orphan_references(*(table(spark, d, t) for t in ("particles", "calo_hits", "withdrawn_particles")))


def _as_text(lineage):
    """Paths as 1/2/3 and descendants as 4,5."""
    return lineage.withColumns({"path": F.array_join("path", "/"), "descendants": F.array_join("descendants", ",")})


QUERIES = {
    "p1_found": lambda s, d: tree_aggregate.hot_keys(table(s, d, "calo_hits")),
    "p1_key_sums": lambda s, d: tree_aggregate.key_sums(table(s, d, "calo_hits")),
    "p3_found": _orphans,
    "p3_report": lambda s, d: orphan_refs.orphan_report(_orphans(s, d)),
    "p4_found": lambda s, d: hierarchy.found(table(s, d, "particles")),
    "p4_descendants": lambda s, d: hierarchy.descendant_pairs(table(s, d, "particles")),
    "p4_all_descendants": lambda s, d: hierarchy.descendant_pairs(table(s, d, "particles"), cycles=True),
    "p4_lineage": lambda s, d: _as_text(hierarchy.lineage(table(s, d, "particles"))),
    "p6_found": lambda s, d: merkle.unmatched(table(s, d, "calo_hits"), table(s, d, "particles")),
    "p6_contributions": lambda s, d: merkle.flat_contributions(table(s, d, "calo_hits")),
    "p6_hits": lambda s, d: merkle.flat_hits(table(s, d, "calo_hits")),
    "p6_particles": lambda s, d: merkle.flat_particles(table(s, d, "particles")),
    "p6_linked_contributions": lambda s, d: merkle.linked_contributions(table(s, d, "calo_hits")),
    "p6_hit_links": lambda s, d: merkle.hit_links(table(s, d, "calo_hits")),
    "p6_particle_links": lambda s, d: merkle.particle_links(table(s, d, "particles")),
    "p6_object_counts": lambda s, d: merkle.object_counts(table(s, d, "calo_hits"), table(s, d, "particles")),
}

_HIT_BLOCKS = """b as (select event_id, block_no, arg_min(x, ingested_at) as x, arg_min(total_energy, ingested_at) as te, arg_min(contrib_particle_ids, ingested_at) as ids,
  arg_min(contrib_energies, ingested_at) as es from calo_hits group by 1, 2)"""
_CONTRIBS = """h as (select event_id, block_no, coalesce(len(x), 0) as n_x, ids, es, unnest(range(greatest(coalesce(len(x), 0), coalesce(len(ids), 0), coalesce(len(es), 0)))) as pos from b),
g as (select event_id, block_no, n_x, pos, ids[pos + 1] as i, es[pos + 1] as e from h),
c as (select event_id, block_no, pos, i, e, unnest(range(greatest(coalesce(len(i), 0), coalesce(len(e), 0)))) as child_pos from g)"""

_ORPHANS = """pb as (select event_id, block_no, min(ingested_at) as arr, arg_min(run_no, ingested_at) as run_no, arg_min(particle_id, ingested_at) as ids, arg_min(parent_id, ingested_at) as parents
  from particles group by 1, 2),
cb as (select event_id, block_no, min(ingested_at) as arr, arg_min(run_no, ingested_at) as run_no, arg_min(contrib_particle_ids, ingested_at) as ids from calo_hits group by 1, 2),
k as (select event_id, id, min(arr) as arr from (select event_id, arr, unnest(ids) as id from pb) where id is not null group by 1, 2),
w as (select distinct event_id, particle_id from withdrawn_particles),
r as (select 'particles' as ref_table, run_no, event_id, h as holder_id, r as ref_id, arr from (select run_no, event_id, arr, unnest(ids) as h, unnest(parents) as r from pb) where h is not null
  union all select distinct 'calo_hits', run_no, event_id, block_no::bigint, id, arr from (select run_no, event_id, block_no, arr, unnest(flatten(ids)) as id from cb)),
o as (select r.ref_table, r.run_no, r.event_id, r.holder_id, r.ref_id, case when k.id is not null then 'late' when w.particle_id is not null then 'withdrawn' else 'missing' end as status
  from r left join k on k.event_id = r.event_id and k.id = r.ref_id left join w on w.event_id = r.event_id and w.particle_id = r.ref_id
  where r.ref_id is not null and r.ref_id <> 0 and (k.id is null or k.arr > r.arr))"""

_FOREST = """n as (select distinct on (event_id, id) event_id, id, parent from (select event_id, block_no, unnest(particle_id) as id, unnest(parent_id) as parent from particles) where id is not null order by event_id, id, block_no),
e as (select n.event_id, n.id, p.id as up from n left join n p on p.event_id = n.event_id and p.id = n.parent and n.parent <> 0 and n.parent <> n.id),
walk as (select event_id, id, id as cur from e union select w.event_id, w.id, e.up from walk w join e on e.event_id = w.event_id and e.id = w.cur where e.up is not null),
cyc as (select distinct w.event_id, w.id from walk w join e on e.event_id = w.event_id and e.id = w.cur where e.up = w.id),
ends as (select w.event_id, w.id, max(w.cur) filter (e.up is null) as root_id, count(*) - 1 as depth from walk w join e on e.event_id = w.event_id and e.id = w.cur group by 1, 2 having count(*) filter (e.up is null) > 0),
loops as (select w.event_id, w.id, min(w.cur) as root_id from walk w join cyc on cyc.event_id = w.event_id and cyc.id = w.cur group by 1, 2),
f as (select e.event_id, e.id as particle_id, e.up as parent_id, coalesce(ends.root_id, loops.root_id) as root_id, coalesce(ends.depth, -1)::int as depth
  from e left join ends on ends.event_id = e.event_id and ends.id = e.id left join loops on loops.event_id = e.event_id and loops.id = e.id),
tree as (select * from walk w anti join cyc on cyc.event_id = w.event_id and cyc.id = w.id),
below as (select w.event_id, w.cur as particle_id, w.id as descendant_id from tree w anti join cyc on cyc.event_id = w.event_id and cyc.id = w.cur where w.cur <> w.id
  union select w.event_id, e.up, w.id from tree w join e on e.event_id = w.event_id and e.id = w.cur join cyc on cyc.event_id = e.event_id and cyc.id = e.up anti join cyc c2 on c2.event_id = w.event_id and c2.id = w.cur)"""

SQL = {
    "p1_found": f"""with {_HIT_BLOCKS}, i as (select unnest(flatten(ids)) as id from b)
select 'event' as key_kind, event_id as key_id from b where event_id is not null group by 2 having count(*) * 1000 >= 40 * (select count(*) from b)
union all select 'contributor', id from i where id is not null group by 2 having count(*) * 1000 >= 15 * (select count(*) from i where id is not null)""",
    "p1_key_sums": f"""with {_HIT_BLOCKS}, {_CONTRIBS},
t as (select event_id, coalesce(sum(floor(v * 1000000 + 0.5)), 0)::bigint as units from (select event_id, unnest(te) as v from b) group by 1)
select 'event' as key_kind, b.event_id as key_id, count(*) as n_blocks, sum(coalesce(len(x), 0))::bigint as n_hits, sum(coalesce(list_count(flatten(ids)), 0))::bigint as n_contribs,
  coalesce(any_value(t.units), 0)::bigint as energy_units from b left join t on t.event_id = b.event_id group by 2
union all select 'contributor', i[child_pos + 1], null, null, count(*), coalesce(sum(floor(e[child_pos + 1] * 1000000 + 0.5)), 0)::bigint from c where i[child_pos + 1] is not null group by 2""",
    "p3_found": f"with {_ORPHANS} select * from o",
    "p3_report": f"with {_ORPHANS} select ref_table, run_no, status, count(*) as n_refs from o group by 1, 2, 3",
    "p4_found": f"with recursive {_FOREST} select event_id, particle_id, root_id, depth from f where parent_id is not null",
    "p4_descendants": f"with recursive {_FOREST} select b.event_id, b.particle_id, b.descendant_id from below b semi join ends on ends.event_id = b.event_id and ends.id = b.descendant_id",
    "p4_all_descendants": f"with recursive {_FOREST} select event_id, particle_id, descendant_id from below",
    "p4_lineage": f"""with recursive {_FOREST},
way as (select w.event_id, w.id, string_agg(w.cur::varchar, '/' order by c.depth) as path from walk w semi join ends on ends.event_id = w.event_id and ends.id = w.id join ends c on c.event_id = w.event_id and c.id = w.cur group by 1, 2),
under as (select event_id, particle_id, count(*) as n, string_agg(descendant_id::varchar, ',' order by descendant_id) as descendants from below group by 1, 2)
select f.event_id, f.particle_id, f.parent_id, f.root_id, f.depth, cyc.id is not null as on_cycle, coalesce(under.n, 0) as n_descendants, coalesce(way.path, '') as path, 0 as part, coalesce(under.descendants, '') as descendants
from f left join cyc on cyc.event_id = f.event_id and cyc.id = f.particle_id left join way on way.event_id = f.event_id and way.id = f.particle_id left join under on under.event_id = f.event_id and under.particle_id = f.particle_id""",
    "p6_found": f"""with {_HIT_BLOCKS}, {_CONTRIBS},
p as (select event_id, block_no, arg_min(px, ingested_at) as px, unnest(range(coalesce(len(arg_min(particle_id, ingested_at)), 0))) as pos from particles group by 1, 2)
select 'contribution' as kind, event_id, block_no, pos::int as pos, child_pos::int as child_pos from c where (i[child_pos + 1] is null) <> (e[child_pos + 1] is null)
union all select 'hit', event_id, block_no, pos::int, -1 from g where pos < n_x and coalesce(len(i), 0) = 0 and coalesce(len(e), 0) = 0
union all select 'particle', event_id, block_no, pos::int, -1 from p where px[pos + 1] is null""",
    "p6_object_counts": """with b as (select distinct on (event_id, block_no) * from calo_hits),
h as (select *, unnest(range(greatest(coalesce(len(detector), 0), coalesce(len(x), 0), coalesce(len(y), 0), coalesce(len(z), 0), coalesce(len(total_energy), 0), coalesce(len(contrib_particle_ids), 0), coalesce(len(contrib_energies), 0)))) + 1 as k from b),
g as (select detector[k] as a, x[k] + 0.0 as x, y[k] + 0.0 as y, z[k] + 0.0 as z, total_energy[k] + 0.0 as t, contrib_particle_ids[k] as i, contrib_energies[k] as e from h),
c as (select i, e, unnest(range(greatest(coalesce(len(i), 0), coalesce(len(e), 0)))) + 1 as k from g),
q as (select distinct on (event_id, block_no) * from particles),
p as (select *, unnest(range(coalesce(len(particle_id), 0))) + 1 as k from q),
o as (select particle_id[k] as a, parent_id[k] as b, pdg_id[k] as c, is_primary[k] as d, energy[k] as e, time_ns[k] as f, vx[k] + 0.0 as g, vy[k] + 0.0 as h, vz[k] + 0.0 as i, px[k] + 0.0 as j, py[k] + 0.0 as k, pz[k] + 0.0 as l from p)
select 'contribution' as kind, count(*) as n_links, (select count(*) from (select distinct i[k], e[k] from c)) as n_objects from c
union all select 'hit', count(*), (select count(*) from (select distinct a, x, y, z, t, coalesce(len(i), -1), coalesce(len(e), -1), i, e from g)) from g
union all select 'particle', count(*), (select count(*) from (select distinct * from o)) from o""",
    "p6_contributions": f"""with {_HIT_BLOCKS}, {_CONTRIBS}
select event_id, block_no, pos::int as pos, child_pos::int as child_pos, i[child_pos + 1] as particle_id, e[child_pos + 1] as energy from c""",
    "p6_linked_contributions": f"""with {_HIT_BLOCKS}, {_CONTRIBS}
select event_id, block_no, pos::int as pos, child_pos::int as child_pos, i[child_pos + 1] as particle_id, e[child_pos + 1] + 0.0 as energy from c""",
    "p6_hits": """with b as (select distinct on (event_id, block_no) * from calo_hits),
h as (select *, unnest(range(greatest(coalesce(len(detector), 0), coalesce(len(x), 0), coalesce(len(y), 0), coalesce(len(z), 0), coalesce(len(total_energy), 0), coalesce(len(contrib_particle_ids), 0), coalesce(len(contrib_energies), 0)))) + 1 as k from b)
select event_id, block_no, run_no, (k - 1)::int as pos, detector[k] as detector, x[k] + 0.0 as x, y[k] + 0.0 as y, z[k] + 0.0 as z, total_energy[k] + 0.0 as total_energy, coalesce(len(contrib_particle_ids[k]), -1)::int as n_ids, coalesce(len(contrib_energies[k]), -1)::int as n_energies from h""",
    "p6_particles": """with b as (select distinct on (event_id, block_no) * from particles),
p as (select *, unnest(range(greatest(coalesce(len(particle_id), 0), coalesce(len(parent_id), 0), coalesce(len(pdg_id), 0), coalesce(len(is_primary), 0), coalesce(len(energy), 0), coalesce(len(time_ns), 0), coalesce(len(vx), 0), coalesce(len(vy), 0), coalesce(len(vz), 0), coalesce(len(px), 0), coalesce(len(py), 0), coalesce(len(pz), 0)))) + 1 as k from b)
select event_id, block_no, run_no, (k - 1)::int as pos, particle_id[k] as particle_id, parent_id[k] as parent_id, pdg_id[k] as pdg_id, is_primary[k] as is_primary, energy[k] + 0.0 as energy, time_ns[k] + 0.0 as time_ns, vx[k] + 0.0 as vx, vy[k] + 0.0 as vy, vz[k] + 0.0 as vz, px[k] + 0.0 as px, py[k] + 0.0 as py, pz[k] + 0.0 as pz from p""",
}
