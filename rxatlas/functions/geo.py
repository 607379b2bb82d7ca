"""WGS84 longitude/latitude <-> British National Grid metres.

Published Ordnance Survey method: geodetic -> cartesian on WGS84, a
seven-parameter Helmert shift to OSGB36, back to geodetic on Airy 1830
(fixed-point latitude iteration), then the National Grid transverse
Mercator series. A few metres from the grid-shift product, which is fine
for the kilometre-scale distances of area interpolation.

The steps are SQL expressions so the same text runs as Spark column
expressions (``F.expr``) and anywhere else that speaks SQL.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the published transformation.
WGS84_A, WGS84_B = 6378137.000, 6356752.314245
AIRY_A, AIRY_B = 6377563.396, 6356256.909
HELMERT_T = (-446.448, 125.157, -542.060)       # metres
HELMERT_S = 20.4894e-6                          # scale, ppm
HELMERT_R = (-0.1502, -0.2470, -0.8421)         # arc seconds
NG_F0 = 0.9996012717
NG_LAT0, NG_LON0 = 49.0, -2.0
NG_E0, NG_N0 = 400000.0, -100000.0
LAT_ITERATIONS = 4


def _lit(v: float) -> str:
    return repr(float(v))


def bng_steps(lat: str = "lat", lon: str = "long") -> list[tuple[str, str]]:
    """Ordered (column, SQL expression) pairs ending in ``bng_x`` and ``bng_y``."""
    e2w = 1 - WGS84_B ** 2 / WGS84_A ** 2
    e2a = 1 - AIRY_B ** 2 / AIRY_A ** 2
    sec = math.pi / (180 * 3600)
    rx, ry, rz = (r * sec for r in HELMERT_R)
    tx, ty, tz = HELMERT_T
    s1 = 1 + HELMERT_S
    n = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
    phi0, lam0 = math.radians(NG_LAT0), math.radians(NG_LON0)
    aF, bF = AIRY_A * NG_F0, AIRY_B * NG_F0
    L = _lit
    steps = [
        ("_phi", f"radians({lat})"),
        ("_lam", f"radians({lon})"),
        ("_nuw", f"{L(WGS84_A)} / sqrt(1 - {L(e2w)} * sin(_phi) * sin(_phi))"),
        ("_X", "_nuw * cos(_phi) * cos(_lam)"),
        ("_Y", "_nuw * cos(_phi) * sin(_lam)"),
        ("_Z", f"(1 - {L(e2w)}) * _nuw * sin(_phi)"),
        ("_X2", f"{L(tx)} + {L(s1)} * _X - {L(rz)} * _Y + {L(ry)} * _Z"),
        ("_Y2", f"{L(ty)} + {L(rz)} * _X + {L(s1)} * _Y - {L(rx)} * _Z"),
        ("_Z2", f"{L(tz)} - {L(ry)} * _X + {L(rx)} * _Y + {L(s1)} * _Z"),
        ("_p", "sqrt(_X2 * _X2 + _Y2 * _Y2)"),
        ("_lam2", "atan2(_Y2, _X2)"),
        ("_phi2", f"atan2(_Z2, _p * (1 - {L(e2a)}))"),
    ]
    for _ in range(LAT_ITERATIONS):
        steps.append(("_phi2", f"atan2(_Z2 + {L(e2a)} * ({L(AIRY_A)} / sqrt(1 - {L(e2a)} * "
                               f"sin(_phi2) * sin(_phi2))) * sin(_phi2), _p)"))
    steps += [
        ("_s", "sin(_phi2)"), ("_c", "cos(_phi2)"), ("_t", "tan(_phi2)"),
        ("_w", f"1 - {L(e2a)} * _s * _s"),
        ("_nu", f"{L(aF)} / sqrt(_w)"),
        ("_rho", f"{L(aF * (1 - e2a))} / (_w * sqrt(_w))"),
        ("_eta2", "_nu / _rho - 1"),
        ("_dp", f"_phi2 - {L(phi0)}"), ("_sp", f"_phi2 + {L(phi0)}"),
        ("_M", f"{L(bF)} * ({L(1 + n + 1.25 * n**2 + 1.25 * n**3)} * _dp"
               f" - {L(3 * n + 3 * n**2 + 21 / 8 * n**3)} * sin(_dp) * cos(_sp)"
               f" + {L(15 / 8 * n**2 + 15 / 8 * n**3)} * sin(2 * _dp) * cos(2 * _sp)"
               f" - {L(35 / 24 * n**3)} * sin(3 * _dp) * cos(3 * _sp))"),
        ("_dl", f"_lam2 - {L(lam0)}"),
        ("bng_y", f"_M + {L(NG_N0)} + (_nu / 2) * _s * _c * power(_dl, 2)"
                  " + (_nu / 24) * _s * power(_c, 3) * (5 - _t * _t + 9 * _eta2) * power(_dl, 4)"
                  " + (_nu / 720) * _s * power(_c, 5) * (61 - 58 * _t * _t + power(_t, 4)) * power(_dl, 6)"),
        ("bng_x", f"{L(NG_E0)} + _nu * _c * _dl"
                  " + (_nu / 6) * power(_c, 3) * (_nu / _rho - _t * _t) * power(_dl, 3)"
                  " + (_nu / 120) * power(_c, 5) * (5 - 18 * _t * _t + power(_t, 4) + 14 * _eta2"
                  " - 58 * _t * _t * _eta2) * power(_dl, 5)"),
    ]
    return steps


#: Steps of the two fixed-point iterations of the inverse; each gains more than two digits.
FOOTPOINT_ITERATIONS, INVERSE_LAT_ITERATIONS = 7, 7


def _inverse_shift() -> list[list[float]]:
    """The inverse of the Helmert matrix (scale and rotations), by cofactors."""
    sec = math.pi / (180 * 3600)
    rx, ry, rz = (r * sec for r in HELMERT_R)
    k = 1 + HELMERT_S
    m = [[k, -rz, ry], [rz, k, -rx], [-ry, rx, k]]
    cof = [[m[(i + 1) % 3][(j + 1) % 3] * m[(i + 2) % 3][(j + 2) % 3] - m[(i + 1) % 3][(j + 2) % 3] * m[(i + 2) % 3][(j + 1) % 3]
            for j in range(3)] for i in range(3)]
    det = sum(m[0][j] * cof[0][j] for j in range(3))
    return [[cof[j][i] / det for j in range(3)] for i in range(3)]


def wgs84_steps(x: str = "x", y: str = "y") -> list[tuple[str, str]]:
    """Ordered (column, SQL expression) pairs from grid metres to ``wgs_lat``
    and ``wgs_lon``: footpoint latitude by iteration of the meridian arc, the
    inverse series, the exact inverse of the datum shift. The forward way drops
    the height that the shift gives a point, so the way back finds the height on
    Airy for which the point lies on WGS84, in a second pass."""
    e2w = 1 - WGS84_B ** 2 / WGS84_A ** 2
    e2a = 1 - AIRY_B ** 2 / AIRY_A ** 2
    n = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
    phi0, lam0 = math.radians(NG_LAT0), math.radians(NG_LON0)
    aF, bF = AIRY_A * NG_F0, AIRY_B * NG_F0
    L, inv = _lit, _inverse_shift()
    arc = (f"{L(bF)} * ({L(1 + n + 1.25 * n**2 + 1.25 * n**3)} * (_f - {L(phi0)})"
           f" - {L(3 * n + 3 * n**2 + 21 / 8 * n**3)} * sin(_f - {L(phi0)}) * cos(_f + {L(phi0)})"
           f" + {L(15 / 8 * n**2 + 15 / 8 * n**3)} * sin(2 * (_f - {L(phi0)})) * cos(2 * (_f + {L(phi0)}))"
           f" - {L(35 / 24 * n**3)} * sin(3 * (_f - {L(phi0)})) * cos(3 * (_f + {L(phi0)})))")
    steps = [("_f", f"{L(phi0)} + ({y} - {L(NG_N0)}) / {L(aF)}")]
    steps += [("_f", f"_f + ({y} - {L(NG_N0)} - {arc}) / {L(aF)}")] * FOOTPOINT_ITERATIONS
    steps += [
        ("_t", "tan(_f)"), ("_sec", "1 / cos(_f)"), ("_w", f"1 - {L(e2a)} * sin(_f) * sin(_f)"),
        ("_nu", f"{L(aF)} / sqrt(_w)"), ("_rho", f"{L(aF * (1 - e2a))} / (_w * sqrt(_w))"), ("_eta2", "_nu / _rho - 1"),
        ("_d", f"({x} - {L(NG_E0)}) / _nu"),
        ("_phi2", "_f - _t * _nu / _rho * (power(_d, 2) / 2"
                  " - power(_d, 4) / 24 * (5 + 3 * _t * _t + _eta2 - 9 * _t * _t * _eta2)"
                  " + power(_d, 6) / 720 * (61 + 90 * _t * _t + 45 * power(_t, 4)))"),
        ("_lam2", f"{L(lam0)} + _sec * (_d - power(_d, 3) / 6 * (_nu / _rho + 2 * _t * _t)"
                  " + power(_d, 5) / 120 * (5 + 28 * _t * _t + 24 * power(_t, 4))"
                  " - power(_d, 7) / 5040 * (61 + 662 * _t * _t + 1320 * power(_t, 4) + 720 * power(_t, 6)))"),
        ("_nua", f"{L(AIRY_A)} / sqrt(1 - {L(e2a)} * sin(_phi2) * sin(_phi2))"),
        ("_h", "0D"),
    ]
    for _ in range(2):  # once for the height, once with it
        steps += [
            ("_X2", f"(_nua + _h) * cos(_phi2) * cos(_lam2) - {L(HELMERT_T[0])}"),
            ("_Y2", f"(_nua + _h) * cos(_phi2) * sin(_lam2) - {L(HELMERT_T[1])}"),
            ("_Z2", f"({L(1 - e2a)} * _nua + _h) * sin(_phi2) - {L(HELMERT_T[2])}"),
            *[(c, " + ".join(f"{L(inv[i][j])} * {d}" for j, d in enumerate(("_X2", "_Y2", "_Z2")))) for i, c in enumerate(("_X", "_Y", "_Z"))],
            ("_p", "sqrt(_X * _X + _Y * _Y)"), ("_phi", f"atan2(_Z, _p * {L(1 - e2w)})"),
            *[("_phi", f"atan2(_Z + {L(e2w)} * ({L(WGS84_A)} / sqrt(1 - {L(e2w)} * sin(_phi) * sin(_phi))) * sin(_phi), _p)")] * INVERSE_LAT_ITERATIONS,
            ("_h", f"_h - (_p / cos(_phi) - {L(WGS84_A)} / sqrt(1 - {L(e2w)} * sin(_phi) * sin(_phi)))"),
        ]
    return steps + [("wgs_lat", "degrees(_phi)"), ("wgs_lon", "degrees(atan2(_Y, _X))")]


#: Steps that one expression nests; longer chains go on from the struct of the one before.
NESTED_STEPS = 16


def _run_steps(df: DataFrame, start: dict[str, str], steps: list[tuple[str, str]], out: dict[str, str]) -> DataFrame:
    """``df`` with the columns ``out`` (name: step): the steps run inside
    structs, so that each is evaluated once a row."""
    keep, fields = df.columns, list(start)
    cur = "named_struct(" + ", ".join(f"'{k}', `{v}`" for k, v in start.items()) + ")"
    for k, (name, expr) in enumerate(steps):
        names = sorted(set(fields), key=len, reverse=True)
        body = re.sub(r"\b(" + "|".join(re.escape(n) for n in names) + r")\b", r"s.\1", expr)
        keep_f = [f for f in dict.fromkeys(fields) if f != name]
        parts = ", ".join(f"'{f}', s.{f}" for f in keep_f)
        cur = f"transform(array({cur}), s -> named_struct({parts}, '{name}', {body}))[0]"
        fields = keep_f + [name]
        if k % NESTED_STEPS == NESTED_STEPS - 1:
            df, cur = df.select(*keep, F.expr(cur).alias("_steps")), "_steps"
    df = df.select(*keep, F.expr(cur).alias("_steps"))
    return df.select(*keep, *[F.col(f"_steps.{step}").alias(c) for c, step in out.items()])


def to_bng(df: DataFrame, lat: str = "lat", lon: str = "long",
           x: str = "x", y: str = "y") -> DataFrame:
    """Add projected ``x``, ``y`` (metres) to ``df``."""
    return _run_steps(df, {"lat": lat, "long": lon}, bng_steps("lat", "long"), {x: "bng_x", y: "bng_y"})


def from_bng(df: DataFrame, x: str = "x", y: str = "y", lat: str = "lat", lon: str = "long") -> DataFrame:
    """Add WGS84 ``lat``, ``lon`` (degrees) of the grid points ``x``, ``y``: the inverse of :func:`to_bng`."""
    return _run_steps(df, {"x": x, "y": y}, wgs84_steps("x", "y"), {lat: "wgs_lat", lon: "wgs_lon"})


def valid_point(x: str = "x", y: str = "y") -> F.Column:
    """both coordinates present, not NaN, finite."""
    ok = F.lit(True)
    for c in (x, y):
        col = F.col(c)
        ok = ok & col.isNotNull() & ~F.isnan(col) & (F.abs(col) < F.lit(float("inf")))
    return ok
