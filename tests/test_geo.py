import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rxatlas.operators import adjacency as adj
from rxatlas.operators import knn
from rxatlas.schemas import AREA


def _targets(spark, pts):
    return spark.createDataFrame(pts, "code string, tx double, ty double")


def _sources(spark, rows):
    return spark.createDataFrame(rows, "YEAR string, PRACTICE_CODE string, x double, y double, v double")


def _brute(targets, sources, k=None, limit=None, exact_hit="null"):
    out = {}
    for code, tx, ty in targets:
        d = sorted((math.hypot(x - tx, y - ty), v) for _, _, x, y, v in sources)
        if k:
            kth = d[min(k, len(d)) - 1][0]
            d = [p for p in d if p[0] <= kth]
        if limit:
            d = [p for p in d if p[0] <= limit]
        if not d:
            out[code] = None
        elif any(p[0] == 0 for p in d):
            hits = [v for dd, v in d if dd == 0]
            out[code] = sum(hits) / len(hits) if exact_hit == "value" else None
        else:
            out[code] = sum(v / dd for dd, v in d) / sum(1 / dd for dd, v in d)
    return out


def _run(spark, t, s, **kw):
    got = knn.interpolate(_targets(spark, t), _sources(spark, s), ["YEAR"], "v", **kw).collect()
    return {r.code: r.value for r in got}


def test_ties_at_k_are_kept(spark):
    t = [("A", 0.0, 0.0)]
    s = [("Y", "p1", 1.0, 0.0, 1.0), ("Y", "p2", 0.0, 2.0, 2.0), ("Y", "p3", -2.0, 0.0, 5.0),
         ("Y", "p4", 10.0, 0.0, 9.0)]
    pts = knn.fold_points(_sources(spark, s), ["YEAR"], "v")
    kept = knn.knn_points(_targets(spark, t), pts, ["YEAR"], k=2).collect()
    assert len(kept) == 3
    assert _run(spark, t, s, k=2) == pytest.approx(_brute(t, s, k=2))


def test_k_larger_than_practices_uses_all(spark):
    t = [("A", 0.0, 0.0), ("B", 50.0, 50.0)]
    s = [("Y", "p1", 1.0, 0.0, 1.0), ("Y", "p2", 3.0, 4.0, 2.0)]
    assert _run(spark, t, s, k=10) == pytest.approx(_brute(t, s, k=10))


def test_exact_hit(spark):
    t = [("A", 1.0, 1.0)]
    s = [("Y", "p1", 1.0, 1.0, 4.0), ("Y", "p2", 3.0, 4.0, 2.0)]
    assert _run(spark, t, s, k=2)["A"] is None
    assert _run(spark, t, s, k=2, exact_hit="value")["A"] == pytest.approx(4.0)


def test_no_practice_within_limit_is_null(spark):
    t = [("A", 0.0, 0.0)]
    s = [("Y", "p1", 100.0, 0.0, 1.0)]
    assert _run(spark, t, s, distance_limit=10.0).get("A") is None


@pytest.mark.parametrize("k,limit", [(3, None), (7, None), (None, 250.0), (4, 300.0), (None, None)])
def test_grid_knn_matches_brute_force(spark, k, limit):
    rng = np.random.default_rng(3)
    s = [("Y", f"p{i}", float(x), float(y), float(v))
         for i, (x, y, v) in enumerate(zip(rng.integers(0, 1000, 150), rng.integers(0, 1000, 150),
                                           rng.normal(size=150)))]
    s += [("Y", "dup1", 500.0, 500.0, 1.0), ("Y", "dup2", 500.0, 500.0, 3.0)]  # shared location
    t = [(f"a{i}", float(x) + 0.5, float(y) + 0.25) for i, (x, y) in
         enumerate(zip(rng.integers(-200, 1200, 25), rng.integers(-200, 1200, 25)))]
    got = _run(spark, t, s, k=k, distance_limit=limit)
    exp = _brute(t, s, k=k, limit=limit)
    for code, v in exp.items():
        if v is None:
            assert got.get(code) is None
        else:
            assert got[code] == pytest.approx(v, rel=1e-9)


def _square(x0, y0, s):
    x0, y0, s = float(x0), float(y0), float(s)
    return [{"x": x0, "y": y0}, {"x": x0 + s, "y": y0}, {"x": x0 + s, "y": y0 + s},
            {"x": x0, "y": y0 + s}, {"x": x0, "y": y0}]


def test_centroids_hole_and_two_parts(spark):
    hole = list(reversed(_square(2, 2, 2)))
    rows = [("holed", [[_square(0, 0, 10), hole]]),
            ("two", [[_square(0, 0, 2)], [_square(10, 0, 2)]])]
    out = {r.code: r for r in adj.centroids(spark.createDataFrame(rows, AREA)).collect()}
    ax = (100 * 5 - 4 * 3) / 96
    assert out["holed"].cx == pytest.approx(ax) and out["holed"].cy == pytest.approx(ax)
    assert out["holed"].area == pytest.approx(96)
    assert out["two"].cx == pytest.approx(6.0) and out["two"].cy == pytest.approx(1.0)


def test_neighbours_hole_and_island(spark):
    rows = [("big", [[_square(0, 0, 100), list(reversed(_square(40, 40, 20)))]]),
            ("inhole", [[_square(45, 45, 5)]]),          # inside the hole, no contact
            ("touchhole", [[_square(40, 55, 5)]]),       # touches the hole's edge
            ("inside", [[_square(5, 5, 5)]]),            # inside the solid part, no contact
            ("island", [[_square(500, 500, 5)]])]
    areas = spark.createDataFrame(rows, AREA)
    pairs = {(r.code, r.nb) for r in adj.neighbour_pairs(areas).collect()}
    assert ("big", "inhole") not in pairs
    assert ("big", "touchhole") in pairs and ("touchhole", "big") in pairs
    assert ("big", "inside") in pairs and ("inside", "big") in pairs
    assert ("island", "island") in pairs
    vals = spark.createDataFrame([("Y", c, 1.0) for c, _ in rows], "YEAR string, code string, v double")
    lisa = {r.code: r for r in adj.lisa(vals, adj.neighbour_pairs(areas), ["YEAR"], "v", 0.0).collect()}
    assert lisa["island"].LISA_support == 1 and lisa["island"].LISA_score == 1.0


def test_missing_value_flag_is_false(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.0,)], "v double")
    assert [r.h for r in df.select(adj.high_flag("v", 0.0).alias("h")).collect()] == [False, False, True]


def test_idw_all_in_target_blocks(spark):
    rng = np.random.default_rng(11)
    s = [("Y", f"p{i}", float(x), float(y), float(v)) for i, (x, y, v) in
         enumerate(zip(rng.integers(0, 100, 40), rng.integers(0, 100, 40), rng.normal(size=40)))]
    t = [(f"a{i}", float(x) + 0.5, float(y)) for i, (x, y) in
         enumerate(zip(rng.integers(0, 100, 7), rng.integers(0, 100, 7)))]
    pts = knn.fold_points(_sources(spark, s), ["YEAR"], "v")
    got = {r.code: r.value for r in knn.idw_all(_targets(spark, t), pts, ["YEAR"], block=3).collect()}
    exp = _brute(t, s)
    assert set(got) == set(exp)
    for c, v in exp.items():
        assert got[c] == pytest.approx(v, rel=1e-9)


def test_hot_cells_are_split_and_pairs_unchanged(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(12):           # a dense cluster of small squares plus a few large ones
        x, y = float(rng.integers(0, 40)), float(rng.integers(0, 40))
        rows.append((f"s{i}", [[_square(x, y, 3)]]))
    rows += [("L1", [[_square(0, 0, 50)]]), ("L2", [[_square(50, 0, 50)]]), ("L3", [[_square(200, 200, 10)]])]
    areas = spark.createDataFrame(rows, AREA)
    plain = {(r.code, r.nb) for r in adj.neighbour_pairs(areas, cell=100.0, hot_limit=10 ** 9).collect()}
    split = {(r.code, r.nb) for r in adj.neighbour_pairs(areas, cell=100.0, hot_limit=4).collect()}
    assert plain == split
    assert ("L1", "L2") in split and ("L3", "L3") in split


def test_candidates_of_a_far_cluster_stay_near_k(spark):
    """Targets far from a crowd of locations: the search refines to about k of them."""
    from rxatlas.session import materialize
    rng = np.random.RandomState(3)
    crowd = [("2030", f"P{i}", float(x), float(y), 1.0) for i, (x, y) in enumerate(rng.uniform(0, 50, (4000, 2)))]
    targets = [(f"E{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(5e4, 9e4, (40, 2)))]
    pts = materialize(knn.fold_points(_sources(spark, crowd), ["YEAR"], "v"))
    t = _targets(spark, targets)
    cells, located = knn.candidate_cells(t, pts, ["YEAR"], 10, knn._frame(pts, t))
    per = cells.join(located, ["YEAR", "cx", "cy"]).groupBy("code").count().collect()
    assert len(per) == 40 and all(10 <= r["count"] <= knn.SETTLED * 10 for r in per)
    got = {r.code: r.value for r in knn.interpolate(t, _sources(spark, crowd), ["YEAR"], "v", k=10).collect()}
    assert got == pytest.approx(_brute(targets, crowd, k=10))


def test_known_grid_point(spark):
    """A published worked example: 52.65798, 1.71605 is about E 651409.8, N 313177.4."""
    from rxatlas.functions.geo import to_bng
    r = to_bng(spark.createDataFrame([(52.65798, 1.71605)], "lat double, long double")).first()
    assert abs(r.x - 651409.76) < 0.1 and abs(r.y - 313177.42) < 0.1


def test_edges_of_a_hot_cell_split(spark):
    """Neighbours are the same with hot cells split to the limit."""
    sq = lambda x, y: [[[{"x": float(x + a), "y": float(y + b)} for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]]]
    areas = spark.createDataFrame([(f"E{i}{j}", sq(i, j)) for i in range(4) for j in range(4)], AREA)
    plain = {(r.code, r.nb) for r in adj.neighbour_pairs(areas).collect()}
    split = {(r.code, r.nb) for r in adj.neighbour_pairs(areas, hot_limit=8, max_splits=3).collect()}
    assert plain == split and ("E00", "E11") in plain and ("E00", "E02") not in plain
