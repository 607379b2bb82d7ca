import pytest
from pyspark.sql import functions as F

from rxatlas.operators import area as ar
from rxatlas.operators import index as idx
from rxatlas.operators.illness import IllnessSpec


def _spec():
    return [IllnessSpec("A", ("T",), ("x",)), IllnessSpec("B", ("T",), ("y",))]


def test_constant_percentage_gives_null_z_and_zero_contribution(spark):
    rows = [("P1", "2030", "PC1", 5, 1, 10), ("P2", "2030", "PC2", 5, 2, 10), ("P3", "2030", "PC3", 5, 3, 10)]
    yc = spark.createDataFrame(rows, "PRACTICE_CODE string, YEAR string, POSTCODE string, a bigint, b bigint, ITEMS bigint")
    pct = idx.illness_percent(yc, _spec())
    z = idx.composite_index(idx.illness_zscore(idx.illness_clip(pct, _spec()), _spec()), _spec())
    out = {r.PRACTICE_CODE: r for r in z.collect()}
    assert all(out[p]["a_perc_trim_zscore"] is None for p in out)
    assert out["P2"]["b_perc_trim_zscore"] == pytest.approx(0.0)
    assert out["P1"][idx.INDEX_COLUMN] == pytest.approx(out["P1"]["b_perc_trim_zscore"])


def test_zero_items_percent_is_null(spark):
    yc = spark.createDataFrame([("P1", "2030", "PC", 0, 0, 0)],
                               "PRACTICE_CODE string, YEAR string, POSTCODE string, a bigint, b bigint, ITEMS bigint")
    r = idx.illness_percent(yc, _spec()).first()
    assert r.a_perc is None


def test_month_filters_use_all_illnesses_per_month(spark):
    spec = [IllnessSpec("A", (), ("x",)), IllnessSpec("Addiction", (), ("m",))]
    counts = spark.createDataFrame(
        [("P", "2030", "01", "PC", 300, 250, 600), ("P", "2030", "02", "PC", 100, 300, 400),
         ("P", "2030", "03", "PC", 50, 10, 70)],
        "PRACTICE_CODE string, YEAR string, MONTH string, POSTCODE string, a bigint, addiction bigint, ITEMS bigint")
    kept = idx.practice_month_kept(counts, spec, min_items=100)
    assert [r.MONTH for r in kept.collect()] == ["01"]


def test_null_area_code_left_out(spark):
    g = spark.createDataFrame([("2030", "E1", 1.0, 10), ("2030", None, 5.0, 7), ("2030", "E1", 3.0, 5)],
                              "YEAR string, laua string, z double, ITEMS bigint")
    areas = spark.createDataFrame([("E1",), ("E2",)], "code string")
    out = {r.code: r for r in ar.area_mean_index(g, areas, "laua", ["z"], years=["2030"]).collect()}
    assert set(out) == {"E1", "E2"}
    assert out["E1"].loneliness == pytest.approx(2.0) and out["E1"].ITEMS == 15
    assert out["E2"].loneliness is None and out["E2"].ITEMS is None
