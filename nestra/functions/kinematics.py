"""Column functions on momenta and positions. All run in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pt(px, py) -> Column:
    return F.sqrt(_c(px) * _c(px) + _c(py) * _c(py))


def phi(px, py) -> Column:
    return F.atan2(_c(py), _c(px))


def theta(px, py, pz) -> Column:
    return F.atan2(pt(px, py), _c(pz))


def to_eta(th) -> Column:
    """Pseudo-rapidity of a polar angle: plus and minus infinity at 0 and pi."""
    th = _c(th)
    return F.when(th <= 0, F.lit(INF)).when(th >= math.pi, F.lit(-INF)).otherwise(-F.log(F.tan(th / 2)))


def eta(px, py, pz) -> Column:
    """Pseudo-rapidity of a momentum; on the beam axis plus or minus infinity by the sign of pz, null if a part is null."""
    on_axis = pt(px, py) == 0
    return F.when(on_axis, F.when(_c(pz) < 0, F.lit(-INF)).when(_c(pz).isNotNull(), F.lit(INF))).otherwise(-F.log(F.tan(theta(px, py, pz) / 2)))


def wrap(angle) -> Column:
    """An angle brought into (-pi, pi]."""
    two = F.lit(2 * math.pi)
    return F.lit(math.pi) - F.pmod(F.lit(math.pi) - _c(angle), two)


def delta_r(eta1, phi1, eta2, phi2) -> Column:
    """Distance in (eta, phi); phi closes on itself."""
    d = F.abs(wrap(_c(phi1) - _c(phi2)))
    deta = _c(eta1) - _c(eta2)
    return F.sqrt(deta * deta + d * d)


# Geometry in mm. 'current': beyond the barrel radius, or beyond the end cap's face and its inner radius; 'legacy': one radius or one length.
RULES = {"current": (1250, 3200, 315), "legacy": (1400, 3000, None)}


def inside_calo(vx, vy, vz, rule: str = "current") -> Column:
    """Whether a vertex lies inside the calorimeter; squares are compared, no root is taken. Null if the coordinates do not decide it."""
    barrel, face, inner = RULES[rule]
    r2 = _c(vx) * _c(vx) + _c(vy) * _c(vy)
    beyond = F.abs(_c(vz)) > face
    if inner is not None:
        beyond = beyond & (r2 > inner * inner)
    return (r2 > barrel * barrel) | beyond


def histogram_bin(x, low: float | Column, high: float | Column, n: int) -> Column:
    """0 .. n - 1 for low <= x <= high (the last bin is closed), else null."""
    lo, hi = (v if isinstance(v, Column) else F.lit(float(v)) for v in (low, high))
    k = F.floor((_c(x) - lo) / ((hi - lo) / F.lit(float(n))))
    return F.when((_c(x) >= lo) & (_c(x) <= hi), F.least(k, F.lit(n - 1).cast("bigint")))
