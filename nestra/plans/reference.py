"""Queries of the mask, ancestry, energy, report and clustering operators over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestra import schema

from nestra.operators import ancestry, energy, masks, meanshift, nested, points, reports
from nestra.operators.masks import KEY
from nestra.runtime import Workspace, table
from nestra.sources import readers, writers


def _t(*names):
    """A query from a function of the named tables."""

    def use(f):
        return lambda s, d: f(*(table(s, d, n) for n in names))

    return use


P, H, T, C, N = "particles", "calo_hits", "tracks", "calibration", "pdg_names"


def _flags(p, t, h):
    return masks.targets(p, t, h, ("is_primary",))


def _purity(h, p, c):
    return energy.particle_purity(h, ancestry.ultimate(p), p, c)


def _by_class(h, p, c):
    return energy.purity_by_class(_purity(h, p, c), p)


def _cluster_purity(h, p):
    return energy.cluster_purity(energy.with_grid_clusters(h), ancestry.ultimate(p))


def _muons(p):
    return nested.particles_flat(p, ("pdg_id", "is_primary")).where("is_primary and pdg_id in (13, -13)").select(*KEY)


def _tracked(p, t):
    return masks.tracked(nested.particles_flat(p, ()), t).where("has_track").select(*KEY)


def _detail(h):
    return energy.cluster_energy_purity(energy.with_grid_clusters(h))


def _kinematics(p):
    flat = masks.mask_values(masks.add_eta_phi_pt(p), "eta", "phi", "pt")
    return flat.select(*KEY, *[F.round(c, 6).alias(c) for c in ("eta", "phi", "pt")])


def _regrouped(p):
    flat = nested.particles_flat(p, ("energy",))
    return nested.regroup(flat, ("particle_id", "energy")).select("event_id", "block_no", F.size("particle_id").cast("bigint").alias("n"), F.get("particle_id", F.lit(0)).alias("first_id"), F.element_at("energy", -1).alias("last_energy"))


def _classes_of(p):
    return nested.particles_flat(p, ("pdg_id",)).join(F.broadcast(schema.pdg_classes(p.sparkSession)), "pdg_id", "left").groupBy(F.coalesce("class_id", F.lit(-1)).alias("class_id")).agg(reports.count_rows().alias("n"))


def _cells(h):
    return points.cardinality(energy.with_grid_clusters(h))


def _top(h):
    return points.percentile_mask(points.hit_points(h), 4.0).where("is_top").select("event_id", "block_no", "pos")


def _clip(h):
    return points.percentile_clip(points.hit_points(h)).select("event_id", "block_no", "pos", F.round("clipped", 6).alias("clipped"))


def _meanshift_xyz(h):
    return meanshift.mean_shift(points.hit_points(h).select("event_id", "block_no", "pos", "x", "y", "z"), ("x", "y", "z"), 100.0)


def _meanshift_angles(h, t):
    return meanshift.mean_shift(points.cluster_points(h, t).select("event_id", "block_no", "pos", "is_calo", "eta", "phi"), ("eta", "phi"), 0.2, angular=True, cluster_all=False)


_cloud = points.cluster_points


def _members(p):
    """The particles of the first ancestor of the first event."""
    lineage = ancestry.ultimate(p)
    first = lineage.where("ultimate_ancestor_id is not null").agg(F.min(F.struct("event_id", "ultimate_ancestor_id")).alias("f")).first().f
    return ancestry.members_of(lineage, *(first or (-1, -1))).select(*KEY, "ultimate_ancestor_id")


def _picked(p):
    ids = [r.event_id for r in p.where("event_id is not null").select("event_id").distinct().orderBy("event_id").limit(3).collect()]
    return nested.particles_flat(nested.pick_events(p, *ids), ()).select("event_id", "block_no", "pos", "particle_id")


def _written_and_read(s, d):
    """Tracks through the narrowing sink and back."""
    path = f"{Workspace(s).root}/sink"
    writers.write_jagged(nested.distinct_blocks(table(s, d, T).select("event_id", "block_no", *nested.TRACK_LISTS)), path)
    return nested.flatten(readers.read_table(s, path), nested.TRACK_LISTS).withColumns({"majority_particle_id": F.col("majority_particle_id").cast("bigint"), "phi": F.col("phi").cast("double"), "theta": F.col("theta").cast("double")})


def _catalogue(s, d):
    tables = readers.read_catalogue(s, d, (P, H, T), n_events=5)
    counts = [df.groupBy("event_id").agg(reports.count_rows().alias("n")).select(F.lit(name).alias("table_name"), "event_id", "n") for name, df in tables.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


QUERIES = {
    # Flattening and lists.
    "flatten_particles": _t(P)(lambda p: nested.particles_flat(p).drop("vx", "vy", "vz").withColumns({c: F.col(c) + 0.0 for c in ("px", "py", "pz")})),
    "double_explode_hits": _t(H)(nested.contributions_flat),
    "regrouped_particles": _t(P)(_regrouped),
    "contribution_sums": _t(H)(lambda h: nested.hits_flat(h, ("contrib_energies",)).select("event_id", "block_no", "pos", F.round(F.aggregate(F.coalesce("contrib_energies", F.array().cast("array<double>")), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0))), 6).alias("energy"))),
    # Masks and features.
    "orphan_mask": _t(P)(lambda p: masks.mask_values(masks.add_orphan_mask(p), "is_parent_missing")),
    "eta_phi_pt": _t(P)(_kinematics),
    "inside_calo_mask": _t(P)(lambda p: masks.mask_values(masks.add_inside_calo(p), "created_inside_calo")),
    "inside_calo_mask_legacy": _t(P)(lambda p: masks.mask_values(masks.add_inside_calo(p, "legacy", "inside_legacy"), "inside_legacy")),
    "has_track_mask": _t(P, T)(lambda p, t: masks.mask_values(masks.add_track_mask(p, t), "has_track")),
    "enter_calo_v1": _t(P)(lambda p: masks.mask_values(masks.add_enter_mask(p), "enter_calo")),
    "enter_calo_v2": _t(P, H)(lambda p, h: masks.mask_values(masks.add_enter_mask(p, h), "enter_calo")),
    "target_mask": _t(P, T, H)(lambda p, t, h: masks.mask_values(masks.add_target_mask(p, t, h), "is_target_particle")),
    "all_masks": _t(P, T, H)(lambda p, t, h: masks.mask_values(masks.all_masks(p, t, h), "is_parent_missing", "created_inside_calo", "has_track", "enter_calo", "is_target_particle")),
    "parent_ids_cast": _t(P)(lambda p: masks.mask_values(masks.cast_parent_ids(p.withColumn("parent_id", F.col("parent_id").cast("array<double>"))), "parent_id")),
    # Ancestry.
    "ultimate_ancestor": _t(P)(lambda p: ancestry.ultimate(p).drop("ancestor_created_inside_calo")),
    "ultimate_ancestor_mask": _t(P)(ancestry.ultimate),
    "nearest_track_ancestor": _t(P, T)(ancestry.nearest_tracked),
    "outside_ancestor": _t(P, H)(ancestry.first_outside),
    "ancestors_with_cycles": _t(P)(ancestry.ancestors_with_cycles),
    "ancestor_distribution": _t(P)(lambda p: ancestry.ancestor_distribution(ancestry.ultimate(p))),
    "generation_map": _t(P)(lambda p: ancestry.generation_map(p, _muons(p))),
    "data_jumps": _t(P, T)(lambda p, t: ancestry.data_jumps(p, _tracked(p, t))),
    "inclusive_energy": _t(P, H)(ancestry.inclusive_energy),
    "cells_of_particles": _t(H)(ancestry.cells_of_particles),
    "forest_edges": _t(P)(ancestry.forest_edges),
    "lineage_existence": _t(P)(lambda p: ancestry.lineage_exists(ancestry.ultimate(p), nested.particles_flat(p, ()))),
    "untracked_entering": _t(P, T, H)(ancestry.untracked_entering),
    "outside_check": _t(P, H)(ancestry.outside_check),
    "tracked_descendants": _t(P, T)(ancestry.tracked_descendants),
    "grandparents": _t(P)(ancestry.grandparents),
    # Energy.
    "particle_purity": _t(H, P, C)(_purity),
    "particle_purity_by_class": _t(H, P, C)(_by_class),
    "purity_energy_intervals": _t(H, P, C, N)(lambda h, p, c, n: energy.purity_intervals(_by_class(h, p, c), n)[0]),
    "purity_interval_names": _t(H, P, C, N)(lambda h, p, c, n: energy.purity_intervals(_by_class(h, p, c), n)[1]),
    "purity_histogram": _t(H, P, C)(lambda h, p, c: reports.histogram(_purity(h, p, c), "purity", 0.0, 2.0, 50)),
    "cluster_purity": _t(H, P)(_cluster_purity),
    "best_cluster_per_ancestor": _t(H, P)(lambda h, p: energy.best_cluster(_cluster_purity(h, p))),
    "particle_completeness": _t(H)(lambda h: energy.particle_completeness(energy.with_grid_clusters(h))),
    "cluster_energy_purity": _t(H)(_detail),
    "cluster_purity_detail": _t(H)(lambda h: reports.purity_detail(_detail(h))),
    "cell_residual": _t(H)(energy.cell_residuals),
    "orphan_energy_fraction": _t(P, H)(energy.orphan_energy_fraction),
    "target_truth_ratio": _t(P, T, H)(energy.target_truth_ratio),
    "energy_cutoff_scan": _t(H)(energy.cutoff_scan),
    "detector_envelope": _t(H, C)(energy.detector_envelope),
    # Reports.
    "mask_confusion": _t(P, T, H)(lambda p, t, h: reports.confusion(_flags(p, t, h), "enter_calo", "has_track")),
    "primary_orphan_confusion": _t(P)(lambda p: reports.confusion(masks.orphans(nested.particles_flat(p, ("parent_id", "is_primary"))), "is_primary", "is_parent_missing")),
    "primary_child_parent_topk": _t(P)(reports.primary_pairs),
    "top_pdg_primary": _t(P)(reports.top_primary_codes),
    "particles_per_event_filtered": _t(P)(lambda p: reports.per_event(p, "is_primary and energy > 1.0", ("is_primary", "energy"))),
    "time_statistics": _t(P)(reports.production_times),
    "time_statistics_first_events": _t(P)(lambda p: reports.production_times(p, 20, "is_primary")),
    "time_histogram": _t(P)(lambda p: reports.histogram(nested.particles_flat(p, ("time_ns",)), "time_ns", 0.0, 25.0, 50)),
    "energy_histogram": _t(P)(lambda p: reports.histogram(nested.particles_flat(p, ("energy", "is_primary")).where("is_primary"), "energy", 0.0, 50.0, 100)),
    "cluster_cardinality": _t(H)(_cells),
    "cluster_index": _t(H)(lambda h: points.with_global_index(_cells(h))),
    "cluster_count": _t(H)(lambda h: _cells(h).groupBy("event_id").agg(reports.count_rows().alias("n_clusters"))),
    "cluster_size_filter": _t(H)(lambda h: points.large_clusters(energy.with_grid_clusters(h).select("event_id", "cluster_id", "block_no", "pos"), 10)),
    "cluster_summary": _t(H)(lambda h: points.cluster_summary(energy.with_grid_clusters(h))),
    "unique_cells": _t(H)(reports.unique_cells),
    "unique_cells_first_events": _t(H)(lambda h: reports.unique_cells(h, 10)),
    "pdg_name_lookup": _t(P, N)(lambda p, n: reports.named(nested.particles_flat(p, ("pdg_id",)).groupBy("pdg_id").agg(reports.count_rows().alias("n")), n)),
    "distinct_pdg": _t(P)(lambda p: nested.particles_flat(p, ("pdg_id",)).select("pdg_id").distinct()),
    "all_pdg_names": lambda s, d: reports.named(nested.particles_flat(table(s, d, P), ("pdg_id",)).select("pdg_id").distinct(), schema.pdg_names(s)),
    "pdg_code_of_name": _t(N)(lambda n: reports.code_of(n, "muon-", "muon+", "photon")),
    "class_counts": _t(P)(_classes_of),
    "members_of_ancestor": _t(P)(_members),
    "picked_events": _t(P)(_picked),
    "written_and_read": _written_and_read,
    "catalogue_counts": _catalogue,
    "cardinality_of_events": _t(H)(lambda h: points.cardinality_of_events(energy.with_grid_clusters(h).select("event_id", "block_no", "pos", "cluster_id"), nested.hits_flat(h, ("total_energy",)).select("event_id", "block_no", "pos", F.coalesce(F.col("total_energy") > 0.01, F.lit(False)).alias("is_on")))),
    # Points.
    "percentile_threshold_mask": _t(H)(_top),
    "percentile_clip": _t(H)(_clip),
    "delta_r_pairs": _t(T)(lambda t: points.track_pairs(t, 0.05)),
    "bin_seed_counts": _t(H)(lambda h: meanshift.seed_bins(points.hit_points(h), ("x", "y", "z"), 100.0)),
    "track_eta": _t(T)(lambda t: points.track_points(t).select("event_id", "block_no", "pos", F.round("eta", 6).alias("eta"), "phi")),
    "hit_eta_phi": _t(H)(lambda h: points.hit_points(h).select("event_id", "block_no", "pos", F.round("eta", 6).alias("eta"), F.round("phi", 6).alias("phi"))),
    "union_distinct_flags": _t(P, T)(lambda p, t: nested.particles_flat(p, ()).select(*KEY).unionByName(nested.tracks_flat(t).where("majority_particle_id is not null").select("event_id", F.col("majority_particle_id").alias("particle_id"))).distinct()),
    # Clustering, which SQL cannot express.
    "meanshift_xyz": _t(H)(_meanshift_xyz),
    "meanshift_etaphi_weighted": _t(H, T)(lambda h, t: meanshift.mean_shift(_cloud(h, t).select("event_id", "block_no", "pos", "is_calo", "eta", "phi", "energy"), ("eta", "phi"), 0.2, angular=True, weight="energy")),
    "meanshift_not_nearest": _t(H)(lambda h: meanshift.not_nearest(_meanshift_xyz(h), ("x", "y", "z"))),
    "meanshift_coverage": _t(H, T)(lambda h, t: _meanshift_angles(h, t).groupBy("event_id").agg(reports.count_rows().alias("n"), F.count_if(F.col("cluster_id") < -1).alias("n_wrong"))),
    "meanshift_cluster_cardinality": _t(H)(lambda h: points.cardinality_of_events(_meanshift_xyz(h).select("event_id", "block_no", "pos", "cluster_id"), points.hit_points(h).select("event_id", "block_no", "pos", (F.col("energy") > 0.01).alias("is_on")))),
    "meanshift_cluster_purity": _t(H, P)(lambda h, p: energy.cluster_purity(energy.with_labels(h, _meanshift_xyz(h)), ancestry.ultimate(p))),
    "meanshift_completeness": _t(H)(lambda h: energy.particle_completeness(energy.with_labels(h, _meanshift_xyz(h)))),
    "meanshift_purity_totals": _t(H, P)(lambda h, p: energy.cluster_purity(energy.with_labels(h, _meanshift_xyz(h)), ancestry.ultimate(p)).groupBy("event_id", "ultimate_ancestor_id").agg(F.max("total_energy_deps").alias("total_energy_deps"), F.round(F.sum("purity"), 6).alias("all_purity"))),
    "event_split_coverage": _t(H, T)(lambda h, t: points.split_events(_cloud(h, t), 0.4, decorate=lambda parts: parts.groupBy("event_id").agg(F.sum("n_calo").alias("n_calo"), F.sum("n_tracks").alias("n_tracks")))),
    "hierarchical_coverage": _t(H, T)(lambda h, t: meanshift.two_level(_cloud(h, t).select("event_id", "block_no", "pos", "is_calo", "eta", "phi", "energy")).groupBy("event_id").agg(F.count_if("is_calo").alias("n_calo"), F.count_if(~F.col("is_calo")).alias("n_tracks"))),
    "meanshift_etaphi": _t(H, T)(_meanshift_angles),
    "hierarchical_meanshift": _t(H, T)(lambda h, t: meanshift.two_level(points.cluster_points(h, t).select("event_id", "block_no", "pos", "is_calo", "eta", "phi", "energy"))),
    "event_split": _t(H, T)(lambda h, t: points.split_events(points.cluster_points(h, t), 0.4)),
    "bandwidth_estimate": _t(H, T)(lambda h, t: meanshift.bandwidths(_cloud(h, t).select("event_id", "eta", "phi")).withColumn("bandwidth", F.round("bandwidth", 6))),
}


# SQL: flat views of the jagged tables, then one statement per query.

_P = """pb as (select distinct on (event_id, block_no) * from particles),
p as (select * from (select event_id, block_no, unnest(range(len(particle_id)))::int as pos, unnest(particle_id) as particle_id, unnest(parent_id) as parent_id, unnest(pdg_id) as pdg_id, unnest(is_primary) as is_primary,
  unnest(energy) as energy, unnest(time_ns) as time_ns, unnest(vx) as vx, unnest(vy) as vy, unnest(vz) as vz, unnest(px) as px, unnest(py) as py, unnest(pz) as pz from pb) where particle_id is not null),
longest as (select max(n) as m from (select count(*) as n from p group by event_id))"""
_H = """hb as (select distinct on (event_id, block_no) * from calo_hits),
hp as (select *, unnest(range(coalesce(len(x), 0)))::int as pos from hb),
h as (select event_id, block_no, pos, detector[pos + 1] as detector, x[pos + 1] as x, y[pos + 1] as y, z[pos + 1] as z, total_energy[pos + 1] as total_energy, contrib_particle_ids[pos + 1] as i, contrib_energies[pos + 1] as e from hp)"""
_C = f"""{_H}, cp as (select *, unnest(range(greatest(coalesce(len(i), 0), coalesce(len(e), 0))))::int as child_pos from h),
c as (select event_id, block_no, pos, child_pos, detector, i[child_pos + 1] as particle_id, e[child_pos + 1] as energy from cp where i[child_pos + 1] is not null)"""
_T = """tb as (select distinct on (event_id, block_no) * from tracks),
t as (select event_id, block_no, unnest(range(len(phi)))::int as pos, unnest(majority_particle_id) as majority_particle_id, unnest(phi) as phi, unnest(theta) as theta from tb)"""
_INSIDE = "(vx * vx + vy * vy > 1250 * 1250 or (abs(vz) > 3200 and vx * vx + vy * vy > 315 * 315))"
_LEGACY = "(vx * vx + vy * vy > 1400 * 1400 or abs(vz) > 3000)"
_O = f"""{_P}, o as (select p.*, q.particle_id is null as is_parent_missing, {_INSIDE.replace('v', 'p.v')} as inside, {_LEGACY.replace('v', 'p.v')} as legacy
  from p left join p q on q.event_id = p.event_id and q.particle_id = p.parent_id)"""
_TRACKED = "tr as (select distinct event_id, majority_particle_id as particle_id from t where majority_particle_id is not null)"
_F = f"""{_O}, {_T}, {_TRACKED}, f as (select o.*, tr.particle_id is not null as has_track from o left join tr on tr.event_id = o.event_id and tr.particle_id = o.particle_id)"""


def _walk(name: str, stop: str, dead: str, of: str) -> str:
    """``name(event_id, particle_id, target)``: the first particle on the way up (itself included) for which ``stop`` holds; none beyond ``dead``."""
    return f"""{name}_w as (select event_id, particle_id, particle_id as cur, 0 as d from {of}
  union all select w.event_id, w.particle_id, f.parent_id, w.d + 1 from {name}_w w join {of} f on f.event_id = w.event_id and f.particle_id = w.cur where not ({stop}) and not ({dead}) and w.d < (select m from longest)),
{name} as (select w.event_id, w.particle_id, w.cur as target, w.d from {name}_w w join {of} f on f.event_id = w.event_id and f.particle_id = w.cur where {stop})"""


_ULT = f"{_O}, {_walk('u', 'f.is_parent_missing or f.parent_id = f.particle_id', 'false', 'o')}"
_NEAR = f"{_F}, {_walk('n', 'f.has_track', 'f.is_parent_missing or f.parent_id = f.particle_id', 'f')}"
_ENTER = f"""{_F}, {_C}, en as (select distinct event_id, parent_id as particle_id from o where inside and parent_id is not null union select distinct event_id, particle_id from c),
g as (select f.*, coalesce(not f.inside and en.particle_id is not null, false) as enter_calo from f left join en on en.event_id = f.event_id and en.particle_id = f.particle_id)"""
_TARGET = f"""{_ENTER}, {_walk('n', 'f.has_track', 'f.is_parent_missing or f.parent_id = f.particle_id', 'f')},
k as (select g.*, (g.enter_calo or g.has_track) and (n.target is null or g.has_track) as is_target_particle from g left join n on n.event_id = g.event_id and n.particle_id = g.particle_id)"""
_PURITY = f"""{_ULT}, {_C}, dep as (select event_id, particle_id, coalesce(sum(floor(energy * calib_factor * 1e6 + 0.5)), 0)::bigint as units from c left join calibration using (detector) group by 1, 2),
s as (select u.event_id, u.target, coalesce(sum(dep.units), 0)::bigint as units from u left join dep on dep.event_id = u.event_id and dep.particle_id = u.particle_id group by 1, 2),
pu as (select s.event_id, s.target as ultimate_ancestor_id, s.units / 1e6 as total_energy_in_calo, p.energy as total_particle_energy, (s.units / 1e6) / nullif(p.energy, 0) as purity, p.pdg_id
  from s left join p on p.event_id = s.event_id and p.particle_id = s.target)"""
_CLASSES = ", ".join(f"({code}, {k})" for k, codes in enumerate(schema.PDG_CLASSES) for code in codes)
_BY_CLASS = f"{_PURITY}, cl as (select * from (values {_CLASSES}) v(pdg_id, class_id)), bc as (select pu.*, coalesce(cl.class_id, -1)::int as class_id from pu left join cl on cl.pdg_id = pu.pdg_id)"
_NAMES = ", ".join(f"({code}, '{name}')" for code, name in schema.PDG_NAME_ROWS)
_CASES = " ".join(f"when total_particle_energy >= {low} then {k}" for k, low in reversed(list(enumerate(energy.INTERVALS))))
_INTERVALS = f"{_BY_CLASS}, iv as (select * from (select *, (case {_CASES} end)::int as \"interval\" from bc where purity is not null) where \"interval\" is not null)"
_LABEL = """l as (select *, coalesce(case when abs(x) < 8000 and abs(y) < 8000 and abs(z) < 4500 then (floor(x / 500) + 16) * 1024 + (floor(y / 500) + 16) * 32 + floor(z / 500) + 16 end, -1)::bigint as cluster_id from h),
lp as (select *, unnest(range(greatest(coalesce(len(i), 0), coalesce(len(e), 0))))::int as child_pos from l),
lc as (select event_id, cluster_id, block_no, pos, i[child_pos + 1] as particle_id, e[child_pos + 1] as energy from lp where i[child_pos + 1] is not null)"""
_L = f"{_H}, {_LABEL}"
_CLUSTER = f"""{_ULT}, {_L}, cs as (select lc.event_id, lc.cluster_id, u.target as ultimate_ancestor_id, coalesce(sum(floor(energy * 1e6 + 0.5)), 0)::bigint as u from lc join u on u.event_id = lc.event_id and u.particle_id = lc.particle_id group by 1, 2, 3),
cu as (select event_id, cluster_id, ultimate_ancestor_id, u / 1e6 as total_energy_deps_in_cluster, t / 1e6 as total_energy_deps, (u / 1e6) / nullif(t / 1e6, 0) as purity
  from (select *, (sum(u) over (partition by event_id, ultimate_ancestor_id))::bigint as t from cs))"""
_EPURITY = f"""{_L}, lh as (select event_id, cluster_id, coalesce(sum(floor(total_energy * 1e6 + 0.5)), 0)::bigint as hu from l where cluster_id <> -1 group by 1, 2),
lt as (select event_id, particle_id, sum(floor(energy * 1e6 + 0.5))::bigint as tu from lc group by 1, 2),
ln as (select event_id, cluster_id, sum(tu)::bigint as tu from (select distinct event_id, cluster_id, particle_id from lc where cluster_id <> -1) join lt using (event_id, particle_id) group by 1, 2),
ep as (select lh.event_id, lh.cluster_id, case when ln.tu > 0 then hu / ln.tu else 0.0 end as purity from lh left join ln using (event_id, cluster_id))"""
_ETA = "case when sqrt(px * px + py * py) = 0 then case when pz < 0 then '-inf'::double when pz is not null then 'inf'::double end when px is null or py is null or pz is null then null else -ln(tan(atan2(sqrt(px * px + py * py), pz) / 2)) end"


def _confusion(a: str, b: str, of: str) -> str:
    return f"""select both_true, a_only, b_only, both_false, (both_true + both_false) / nullif(both_true + a_only + b_only + both_false, 0) as accuracy, both_true / nullif(both_true + a_only + b_only, 0) as jaccard from (
  select count(*) filter ({a} and {b}) as both_true, count(*) filter ({a} and not {b}) as a_only, count(*) filter (not {a} and {b}) as b_only, count(*) filter (not {a} and not {b}) as both_false from {of})"""


def _histogram(column: str, low: float, high: float, n: int, of: str) -> str:
    return f"select least(floor(({column} - {low}) / (({high} - {low}) / {n}.0))::bigint, {n - 1}) as bin, count(*) as n from {of} where {column} >= {low} and {column} <= {high} group by 1"


_XYZ = "x is not null and y is not null and z is not null"
_HIT_ETA = "case when sqrt(x * x + y * y) = 0 then case when z < 0 then '-inf'::double else 'inf'::double end else -ln(tan(atan2(sqrt(x * x + y * y), z) / 2)) end"
_TRACK_ETA = "case when theta <= 0 then 'inf'::double when theta >= pi() then '-inf'::double else -ln(tan(theta / 2)) end"

SQL = {
    "flatten_particles": f"with {_P} select event_id, block_no, pos, particle_id, parent_id, pdg_id, is_primary, energy, time_ns, px + 0.0 as px, py + 0.0 as py, pz + 0.0 as pz from p",
    "double_explode_hits": f"with {_C} select event_id, block_no, pos, child_pos, detector, particle_id, energy from c",
    "regrouped_particles": f"with {_P} select event_id, block_no, count(*) as n, arg_min(particle_id, pos) as first_id, last(energy order by pos) as last_energy from p group by 1, 2",
    "contribution_sums": f"with {_H} select event_id, block_no, pos, round(coalesce(list_sum(e), 0), 6) as energy from h",
    "orphan_mask": f"with {_O} select event_id, particle_id, is_parent_missing from o",
    "eta_phi_pt": f"with {_P} select event_id, particle_id, round({_ETA}, 6) as eta, round(atan2(py, px), 6) as phi, round(sqrt(px * px + py * py), 6) as pt from p",
    "inside_calo_mask": f"with {_P} select event_id, particle_id, {_INSIDE} as created_inside_calo from p",
    "inside_calo_mask_legacy": f"with {_P} select event_id, particle_id, {_LEGACY} as inside_legacy from p",
    "has_track_mask": f"with {_F} select event_id, particle_id, has_track from f",
    "enter_calo_v1": f"with {_O}, en as (select distinct event_id, parent_id as particle_id from o where inside and parent_id is not null) select o.event_id, o.particle_id, coalesce(not o.inside and en.particle_id is not null, false) as enter_calo from o left join en on en.event_id = o.event_id and en.particle_id = o.particle_id",
    "enter_calo_v2": f"with {_ENTER} select event_id, particle_id, enter_calo from g",
    "target_mask": f"with recursive {_TARGET} select event_id, particle_id, is_target_particle from k",
    "all_masks": f"with recursive {_TARGET} select event_id, particle_id, is_parent_missing, inside as created_inside_calo, has_track, enter_calo, is_target_particle from k",
    "parent_ids_cast": f"with {_P} select event_id, particle_id, parent_id from p",
    "ultimate_ancestor": f"with recursive {_ULT} select o.event_id, o.particle_id, u.target as ultimate_ancestor_id from o left join u on u.event_id = o.event_id and u.particle_id = o.particle_id",
    "ultimate_ancestor_mask": f"with recursive {_ULT} select o.event_id, o.particle_id, u.target as ultimate_ancestor_id, a.legacy as ancestor_created_inside_calo from o left join u on u.event_id = o.event_id and u.particle_id = o.particle_id left join o a on a.event_id = o.event_id and a.particle_id = u.target",
    "nearest_track_ancestor": f"with recursive {_NEAR} select event_id, particle_id, target as ancestor_with_track_id from n",
    "outside_ancestor": f"with recursive {_O}, {_C}, {_walk('x', 'not f.inside', 'f.is_parent_missing or f.parent_id = f.particle_id', 'o')} select o.event_id, o.particle_id, x.target as ancestor_outside_calo_id from o join (select distinct event_id, particle_id from c) c on c.event_id = o.event_id and c.particle_id = o.particle_id left join x on x.event_id = o.event_id and x.particle_id = o.particle_id",
    "ancestors_with_cycles": f"with recursive {_ULT} select o.event_id, o.particle_id, case when u.target is null then null when r.parent_id is null or r.parent_id = 0 or r.parent_id = r.particle_id then u.target else r.parent_id end as ancestor_id, u.target is null as in_cycle from o left join u on u.event_id = o.event_id and u.particle_id = o.particle_id left join o r on r.event_id = o.event_id and r.particle_id = u.target",
    "ancestor_distribution": f"with recursive {_ULT}, per as (select o.event_id, count(distinct u.target) as n from o left join u on u.event_id = o.event_id and u.particle_id = o.particle_id group by 1) select count(*) as n_events, avg(n) as mean_n, median(n)::double as median_n, max(n) as max_n from per",
    "generation_map": f"with recursive {_ULT}, s as (select event_id, particle_id from p where is_primary and pdg_id in (13, -13)), w as (select w.* from u_w w semi join u on u.event_id = w.event_id and u.particle_id = w.particle_id) select w.event_id, s.particle_id as selected_id, w.particle_id, w.d::int as generation from w join s on s.event_id = w.event_id and s.particle_id = w.cur union all select w.event_id, s.particle_id, w.cur, -w.d::int from w join s on s.event_id = w.event_id and s.particle_id = w.particle_id where w.d > 0",
    "data_jumps": f"with recursive {_ULT}, {_T}, {_TRACKED}, v as (select tr.* from tr semi join p on p.event_id = tr.event_id and p.particle_id = tr.particle_id), w as (select w.* from u_w w semi join u on u.event_id = w.event_id and u.particle_id = w.particle_id where w.d > 0) select w.event_id, w.particle_id, arg_min(w.cur, w.d) as ancestor_id, min(w.d)::int as gap from w join v a on a.event_id = w.event_id and a.particle_id = w.cur semi join v b on b.event_id = w.event_id and b.particle_id = w.particle_id group by 1, 2",
    "inclusive_energy": f"with recursive {_ULT}, {_C}, dd as (select event_id, particle_id, coalesce(sum(floor(energy * 1e6 + 0.5)), 0)::bigint as units from c group by 1, 2), w as (select w.* from u_w w semi join u on u.event_id = w.event_id and u.particle_id = w.particle_id), a as (select w.event_id, w.cur, sum(dd.units)::bigint as units from w join dd on dd.event_id = w.event_id and dd.particle_id = w.particle_id group by 1, 2) select u.event_id, u.particle_id, coalesce(dd.units, 0) / 1e6 as direct_energy, coalesce(a.units, 0) / 1e6 as inclusive_energy from u left join dd on dd.event_id = u.event_id and dd.particle_id = u.particle_id left join a on a.event_id = u.event_id and a.cur = u.particle_id",
    "cells_of_particles": f"with {_C} select event_id, particle_id, count(distinct (block_no, pos)) as n_cells from c group by 1, 2",
    "forest_edges": f"with {_O} select event_id, parent_id, particle_id from o where not is_parent_missing and parent_id <> 0 and parent_id <> particle_id",
    "lineage_existence": f"with recursive {_ULT} select distinct event_id, target as particle_id from u",
    "untracked_entering": f"with recursive {_ENTER}, {_walk('n', 'f.has_track', 'f.is_parent_missing or f.parent_id = f.particle_id', 'f')} select g.event_id, g.particle_id from g anti join n on n.event_id = g.event_id and n.particle_id = g.particle_id where g.enter_calo",
    "outside_check": f"with recursive {_O}, {_C}, {_walk('x', 'not f.inside', 'f.is_parent_missing or f.parent_id = f.particle_id', 'o')} select a.inside as created_inside_calo, count(*) as n from x semi join c on c.event_id = x.event_id and c.particle_id = x.particle_id join o a on a.event_id = x.event_id and a.particle_id = x.target group by 1",
    "tracked_descendants": f"with recursive {_NEAR} select event_id, target as ancestor_with_track_id, count(*) as n_particles from n group by 1, 2",
    "grandparents": f"with {_P} select c.event_id, c.particle_id, c.time_ns, c.parent_id, a.time_ns as parent_time_ns, a.parent_id as grandparent_id, g.time_ns as grandparent_time_ns from p c join p a on a.event_id = c.event_id and a.particle_id = c.parent_id left join p g on g.event_id = a.event_id and g.particle_id = a.parent_id",
    "particle_purity": f"with recursive {_PURITY} select event_id, ultimate_ancestor_id, total_energy_in_calo, total_particle_energy, purity from pu",
    "particle_purity_by_class": f"with recursive {_BY_CLASS} select * from bc",
    "purity_energy_intervals": f"""with recursive {_INTERVALS}, b as (select class_id, min(purity) as lo, max(purity) as hi from iv group by 1)
select class_id, "interval", case when lo = hi then 0 else least(floor((purity - lo) / ((hi - lo) / 49.0))::bigint, 48) end as bin, count(*) as n from iv join b using (class_id) group by 1, 2, 3""",
    "purity_interval_names": f"""with recursive {_INTERVALS}, c2 as (select class_id, "interval", coalesce(name, iv.pdg_id::varchar) as name, count(*) as n from iv left join pdg_names on pdg_names.pdg_id = iv.pdg_id group by 1, 2, 3)
select * from c2 qualify row_number() over (partition by class_id, "interval" order by n desc, name) <= 10""",
    "purity_histogram": f"with recursive {_PURITY} " + _histogram("purity", 0.0, 2.0, 50, "pu"),
    "cluster_purity": f"with recursive {_CLUSTER} select * from cu",
    "best_cluster_per_ancestor": f"with recursive {_CLUSTER} select event_id, ultimate_ancestor_id, cluster_id, purity from cu qualify row_number() over (partition by event_id, ultimate_ancestor_id order by coalesce(purity, -1) desc, cluster_id) = 1",
    "particle_completeness": f"""with {_L}, pc as (select event_id, particle_id, cluster_id, coalesce(sum(floor(energy * 1e6 + 0.5)), 0)::bigint as u from lc group by 1, 2, 3),
pt as (select event_id, particle_id, sum(u)::bigint as t, coalesce(max(u) filter (cluster_id <> -1), 0) as m from pc group by 1, 2)
select event_id, particle_id, m / t as completeness, abs(m / t - 1.0) <= 1e-6 + 1e-5 as is_perfect from pt where t <> 0""",
    "cluster_energy_purity": f"with {_EPURITY} select * from ep",
    "cluster_purity_detail": f"""with {_EPURITY}, b as (select *, floor(purity / (1.5 / 50))::bigint as bin from ep where purity >= 0 and purity < 1.5)
select bin, count(*) as n, array_to_string(list(event_id || ':' || cluster_id order by event_id, cluster_id)[1:15], ',') as clusters, greatest(count(*) - 15, 0) as n_more from b group by 1""",
    "cell_residual": f"with {_H} select event_id, block_no, pos, (floor(total_energy * 1e6 + 0.5) - coalesce(list_sum([floor(v * 1e6 + 0.5) for v in e]), 0))::bigint as residual_units from h where total_energy is not null",
    "orphan_energy_fraction": f"""with {_O}, {_H}, a as (select event_id, sum(floor(total_energy * 1e6 + 0.5))::bigint as hu from h group by 1), b as (select event_id, sum(floor(energy * 1e6 + 0.5))::bigint as ou from o where is_parent_missing group by 1)
select event_id, (coalesce(hu, 0) / 1e6) / nullif(coalesce(ou, 0) / 1e6, 0) as fraction from a join b using (event_id)""",
    "target_truth_ratio": f"""with recursive {_TARGET}, a as (select * from k where abs({_ETA}) < 3.5 and sqrt(px * px + py * py) > 0.5),
s as (select event_id, coalesce(sum(floor(energy * 1e6 + 0.5)) filter (is_target_particle), 0)::bigint as tu, coalesce(sum(floor(energy * 1e6 + 0.5)) filter (is_parent_missing), 0)::bigint as ou, count(*) filter (is_target_particle) as nt, count(*) filter (is_parent_missing) as no from a group by 1)
select event_id, tu / 1e6 as target_energy, ou / 1e6 as truth_energy, (tu / 1e6) / nullif(ou / 1e6, 0) as ratio from s where nt > 0 and no > 0""",
    "energy_cutoff_scan": f"""with {_H}, u as (select event_id, total_energy as e, floor(total_energy * 1e6 + 0.5)::bigint as u from h where total_energy is not null), tot as (select event_id, sum(u)::bigint as t from u group by 1 having sum(u) > 0),
k as (select unnest(range(100))::int as i), x as (select i, event_id, coalesce(sum(u) filter (e > i * (0.005::double / 99.0::double)), 0)::bigint as s, count(*) filter (e > i * (0.005::double / 99.0::double)) as c from u cross join k group by 1, 2)
select i as cutoff_no, i * (0.005::double / 99.0::double) as cutoff, round(avg(s / t), 9) as mean_ratio, avg(c) as mean_left from x join tot using (event_id) group by 1""",
    "detector_envelope": f"""with {_H}, r as (select *, sqrt(x * x + y * y) as r from h where detector is not null)
select r.detector, min(z) as min_z, max(z) as max_z, round(avg(z), 4) as mean_z, min(r) as min_r, max(r) as max_r, round(avg(r), 4) as mean_r, any_value(system_label) as system_label from r left join calibration c on c.detector = r.detector group by 1""",
    "mask_confusion": f"with {_ENTER} " + _confusion("enter_calo", "has_track", "g"),
    "primary_orphan_confusion": f"with {_O} " + _confusion("is_primary", "is_parent_missing", "o"),
    "primary_child_parent_topk": f"with {_P} select c.pdg_id, a.pdg_id as parent_pdg_id, count(*) as n from p c join p a on a.event_id = c.event_id and a.particle_id = c.parent_id where c.is_primary group by 1, 2 order by n desc, 1, 2 limit 20",
    "top_pdg_primary": f"with {_O} select pdg_id, count(*) as n from o where is_primary and not is_parent_missing group by 1 order by n desc, 1 limit 10",
    "particles_per_event_filtered": f"with {_P} select event_id, count(*) as n from p where is_primary and energy > 1.0 group by 1",
    "time_statistics": f"with {_P} select count(*) as n, round(avg(time_ns), 6) as mean_time, max(time_ns) as max_time from p where time_ns is not null",
    "time_statistics_first_events": f"with {_P} select count(*) as n, round(avg(time_ns), 6) as mean_time, max(time_ns) as max_time from p where time_ns is not null and is_primary and event_id in (select distinct event_id from particles where event_id is not null order by event_id limit 20)",
    "time_histogram": f"with {_P} " + _histogram("time_ns", 0.0, 25.0, 50, "p"),
    "energy_histogram": f"with {_P}, q as (select * from p where is_primary) " + _histogram("energy", 0.0, 50.0, 100, "q"),
    "cluster_cardinality": f"with {_L} select event_id, cluster_id, count(*) as n_hits from l where cluster_id <> -1 group by 1, 2",
    "cluster_index": f"with {_L}, n as (select event_id, cluster_id, count(*) as n_hits from l where cluster_id <> -1 group by 1, 2) select *, row_number() over (order by event_id, cluster_id) - 1 as index from n",
    "cluster_count": f"with {_L} select event_id, count(distinct cluster_id) as n_clusters from l where cluster_id <> -1 group by 1",
    "cluster_size_filter": f"with {_L}, n as (select event_id, cluster_id, block_no, pos, count(*) over (partition by event_id, cluster_id) as n_hits from l) select * from n where n_hits >= 10",
    "cluster_summary": f"with {_L} select event_id, cluster_id, count(*) as n_hits, round(avg(x), 4) as cx, round(avg(y), 4) as cy, round(avg(z), 4) as cz from l group by 1, 2",
    "unique_cells": f"with {_H}, k as (select *, floor(x * 1e5 + 0.5)::bigint as kx, floor(y * 1e5 + 0.5)::bigint as ky, floor(z * 1e5 + 0.5)::bigint as kz from h where {_XYZ}) select detector, kx, ky, kz, event_id, block_no, pos from k qualify row_number() over (partition by detector, kx, ky, kz order by event_id, block_no, pos) = 1",
    "unique_cells_first_events": f"with {_H}, k as (select *, floor(x * 1e5 + 0.5)::bigint as kx, floor(y * 1e5 + 0.5)::bigint as ky, floor(z * 1e5 + 0.5)::bigint as kz from h where {_XYZ} and event_id in (select distinct event_id from calo_hits where event_id is not null order by event_id limit 10)) select detector, kx, ky, kz, event_id, block_no, pos from k qualify row_number() over (partition by detector, kx, ky, kz order by event_id, block_no, pos) = 1",
    "pdg_name_lookup": f"with {_P} select p.pdg_id, coalesce(any_value(n.name), p.pdg_id::varchar) as name, count(*) as n from p left join pdg_names n on n.pdg_id = p.pdg_id group by p.pdg_id",
    "distinct_pdg": f"with {_P} select distinct pdg_id from p",
    "all_pdg_names": f"with {_P}, v as (select * from (values {_NAMES}) v(pdg_id, name)) select distinct p.pdg_id, coalesce(v.name, p.pdg_id::varchar) as name from p left join v on v.pdg_id = p.pdg_id",
    "pdg_code_of_name": "select name, pdg_id from pdg_names where name in ('muon-', 'muon+', 'photon')",
    "class_counts": f"with {_P}, cl as (select * from (values {_CLASSES}) v(pdg_id, class_id)) select coalesce(cl.class_id, -1)::int as class_id, count(*) as n from p left join cl on cl.pdg_id = p.pdg_id group by 1",
    "percentile_threshold_mask": f"with {_H}, q as (select *, coalesce(total_energy, 0) as en from h where {_XYZ}) select event_id, block_no, pos from q qualify row_number() over (partition by event_id order by en desc, block_no, pos) <= greatest(1, ceil(0.04 * count(*) over (partition by event_id)))",
    "percentile_clip": f"with {_H}, q as (select *, coalesce(total_energy, 0) as en from h where {_XYZ}), b as (select event_id, quantile_cont(en, 0.05) as lo, quantile_cont(en, 0.95) as hi from q group by 1) select event_id, block_no, pos, round(greatest(least(en, hi), lo), 6) as clipped from q join b using (event_id)",
    "delta_r_pairs": f"""with {_T}, q as (select event_id, block_no, pos, phi, {_TRACK_ETA} as eta from t where phi is not null and theta is not null), r as (select * from q where abs(eta) < 'inf'::double),
d as (select a.event_id, a.block_no as block_a, a.pos as pos_a, b.block_no as block_b, b.pos as pos_b, sqrt((a.eta - b.eta) ** 2 + (least(abs(a.phi - b.phi), 2 * pi() - abs(a.phi - b.phi))) ** 2) as dr from r a join r b on a.event_id = b.event_id and (a.block_no, a.pos) < (b.block_no, b.pos))
select event_id, block_a, pos_a, block_b, pos_b, round(dr, 6) as delta_r from d where dr < 0.05""",
    "bin_seed_counts": f"with {_H} select event_id, round_even(x / 100, 0)::bigint as bin_x, round_even(y / 100, 0)::bigint as bin_y, round_even(z / 100, 0)::bigint as bin_z, count(*) as n from h where {_XYZ} group by 1, 2, 3, 4",
    "track_eta": f"with {_T} select event_id, block_no, pos, round({_TRACK_ETA}, 6) as eta, phi from t where phi is not null and theta is not null",
    "hit_eta_phi": f"with {_H} select event_id, block_no, pos, round({_HIT_ETA}, 6) as eta, round(atan2(y, x), 6) as phi from h where {_XYZ}",
    "members_of_ancestor": f"with recursive {_ULT} select event_id, particle_id, target as ultimate_ancestor_id from u where (event_id, target) = (select (event_id, target) from u order by event_id, target limit 1)",
    "picked_events": f"with {_P} select event_id, block_no, pos, particle_id from p where event_id in (select distinct event_id from particles where event_id is not null order by event_id limit 3)",
    "written_and_read": f"with {_T} select event_id, block_no, pos, majority_particle_id, phi::float::double as phi, theta::float::double as theta from t",
    "catalogue_counts": " union all ".join(f"select '{t}' as table_name, event_id, count(*) as n from {t} where event_id in (select distinct event_id from {t} order by event_id limit 5) group by 2" for t in (P, H, T)),
    "cardinality_of_events": f"with {_L}, n as (select event_id, cluster_id, count(*) as n_hits from l where cluster_id <> -1 and total_energy > 0.01 group by 1, 2) select *, row_number() over (order by event_id, cluster_id) - 1 as index from n",
    # What any right clustering must give.
    "meanshift_not_nearest": "select event_id, block_no, 0 as pos from calo_hits where false",
    "meanshift_coverage": f"with {_H}, {_T}, a as (select event_id, {_HIT_ETA} as eta from h where {_XYZ} union all select event_id, {_TRACK_ETA} from t where phi is not null and theta is not null) select event_id, count(*) as n, 0::bigint as n_wrong from a where abs(eta) < 'inf'::double group by 1",
    "meanshift_purity_totals": f"with recursive {_ULT}, {_C}, a as (select c.event_id, u.target, coalesce(sum(floor(energy * 1e6 + 0.5)), 0)::bigint as t from c join u on u.event_id = c.event_id and u.particle_id = c.particle_id group by 1, 2) select event_id, target as ultimate_ancestor_id, t / 1e6 as total_energy_deps, case when t <> 0 then 1.0::double end as all_purity from a",
    "bandwidth_estimate": f"""with {_H}, {_T}, a as (select event_id, {_HIT_ETA} as eta, atan2(y, x) as phi from h where {_XYZ} union all select event_id, {_TRACK_ETA}, phi from t where phi is not null and theta is not null),
q as (select *, row_number() over () as i, count(*) over (partition by event_id) as n from a where abs(eta) < 'inf'::double),
d as (select a.event_id, a.i, a.n, list_sort(list(sqrt((a.eta - b.eta) ** 2 + least(abs(a.phi - b.phi), 2 * pi() - abs(a.phi - b.phi)) ** 2))) as ds from q a join q b on b.event_id = a.event_id group by 1, 2, 3)
select event_id, n as n_points, round(avg(ds[greatest(1, floor(n * 0.3))::int]), 6) as bandwidth from d group by 1, 2""",
    "event_split_coverage": f"with {_H}, {_T}, a as (select event_id, true as is_calo, {_HIT_ETA} as eta from h where {_XYZ} union all select event_id, false, {_TRACK_ETA} from t where phi is not null and theta is not null) select event_id, count(*) filter (is_calo) as n_calo, count(*) filter (not is_calo) as n_tracks from a where abs(eta) < 'inf'::double group by 1",
    "hierarchical_coverage": f"with {_H}, {_T}, a as (select event_id, true as is_calo, {_HIT_ETA} as eta from h where {_XYZ} union all select event_id, false, {_TRACK_ETA} from t where phi is not null and theta is not null) select event_id, count(*) filter (is_calo) as n_calo, count(*) filter (not is_calo) as n_tracks from a where abs(eta) < 'inf'::double group by 1",
    "union_distinct_flags": f"with {_P}, {_T} select event_id, particle_id from p union select event_id, majority_particle_id from t where majority_particle_id is not null",
}
