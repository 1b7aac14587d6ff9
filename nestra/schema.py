"""Table schemas, column checks and dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L = lambda t: f"array<{t}>"
PARTICLES = (
    "event_id bigint, block_no int, run_no int, ingested_at timestamp, " + ", ".join(f"{c} {_L('bigint')}" for c in ("particle_id", "parent_id", "pdg_id"))
    + f", is_primary {_L('boolean')}, " + ", ".join(f"{c} {_L('double')}" for c in ("energy", "time_ns", "vx", "vy", "vz", "px", "py", "pz"))
)
CALO_HITS = (
    f"event_id bigint, block_no int, run_no int, ingested_at timestamp, detector {_L('int')}, " + ", ".join(f"{c} {_L('double')}" for c in ("x", "y", "z", "total_energy"))
    + f", contrib_particle_ids {_L(_L('bigint'))}, contrib_energies {_L(_L('double'))}"
)
TRACKS = f"event_id bigint, block_no int, run_no int, ingested_at timestamp, majority_particle_id {_L('bigint')}, phi {_L('double')}, theta {_L('double')}"
TRACKER_HITS = f"event_id bigint, block_no int, run_no int, ingested_at timestamp, x {_L('double')}, y {_L('double')}, z {_L('double')}"
CALIBRATION = "detector int, system_label string, calib_factor double"
PDG_NAMES = "pdg_id bigint, name string"

# Particle codes that are reported together; the class number is the place in the list.
PDG_CLASSES = ((11, -11), (13, -13), (22,), (211, -211, 111), (130, 310))
# Factor per detector of the reference set-up (code, label, factor).
CALIBRATION_ROWS = (
    (10, "Ecal Barrel", 37.5), (9, "Ecal Endcap (Neg)", 38.7), (11, "Ecal Endcap (Pos)", 38.7), (13, "Hcal Barrel", 45.0), (12, "Hcal Endcap (Neg)", 46.9), (14, "Hcal Endcap (Pos)", 46.9),
)

# Names of particle codes.
PDG_NAME_ROWS = (
    (-20213, "a1(1260)-"), (-3222, "anti-Σ+"), (-3112, "anti-Σ-"), (-2224, "anti-Δ++"), (-2212, "anti-p"), (-2112, "anti-n"), (-1114, "anti-Δ-"), (-521, "anti-B+"), (-423, "anti-D*+"),
    (-421, "anti-D0"), (-413, "anti-D*-"), (-323, "anti-K*+"), (-321, "anti-K+"), (-313, "anti-K*0"), (-311, "anti-K0"), (-213, "anti-ρ+"), (-211, "anti-π+"), (-14, "anti-νμ"), (-13, "anti-μ-"),
    (-12, "anti-νe"), (-11, "anti-e-"), (11, "e-"), (13, "μ-"), (14, "νμ"), (22, "γ"), (111, "π0"), (113, "ρ0"), (130, "K0L"), (211, "π+"), (213, "ρ+"), (221, "η"), (223, "ω"), (310, "K0S"),
    (311, "K0"), (313, "K*0"), (321, "K+"), (323, "K*+"), (331, "η′"), (333, "φ"), (421, "D0"), (521, "B+"), (523, "B*+"), (2112, "n"), (2212, "p"), (3112, "Σ-"), (3122, "Λ"), (3212, "Σ0"),
    (3222, "Σ+"), (1000010020, "deuteron"), (1000010030, "triton"), (1000020030, "helium-3"), (1000020040, "helium-4"), (1000030060, "lithium-6"), (1000090190, "fluorine-19"),
    (1000120250, "magnesium-25"), (1000120260, "magnesium-26"), (1000130260, "aluminum-26"), (1000140280, "silicon-28"), (1000140290, "silicon-29"), (1000140300, "silicon-30"),
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself; a ValueError that names the missing columns otherwise."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df


def list_columns(df: DataFrame) -> list[str]:
    """All list columns, by type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def calibration(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CALIBRATION_ROWS), CALIBRATION)


def pdg_names(spark: SparkSession) -> DataFrame:
    """``pdg_id, name`` of the known codes; names are unique, so it serves both ways."""
    return spark.createDataFrame(list(PDG_NAME_ROWS), PDG_NAMES)


def pdg_classes(spark: SparkSession, classes=PDG_CLASSES) -> DataFrame:
    """``pdg_id, class_id``: a code in two lists has two rows."""
    return spark.createDataFrame([(p, i) for i, c in enumerate(classes) for p in c], "pdg_id bigint, class_id int")
