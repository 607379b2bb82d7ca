import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rxatlas.functions import text as T
from rxatlas.operators.quantiles import exact_percentiles


def test_percentile_micro_case(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 10)], "g int, v double")
    got = {r.p: r.v for r in exact_percentiles(df, ["g"], "v", [0.005, 0.5, 0.995]).collect()}
    assert got[0.005] == pytest.approx(1.015)
    assert got[0.5] == pytest.approx(2.5)
    assert got[0.995] == pytest.approx(9.895)


def test_percentiles_match_pandas_with_ties_nulls(spark):
    rng = np.random.default_rng(7)
    rows = [(g, float(v)) for g in range(4) for v in rng.integers(0, 20, 300 * (g + 1))]
    rows += [(9, None), (9, float("nan")), (9, 4.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.005, 0.25, 0.5, 0.995, 1.0]
    got = {(r.g, r.p): r.v for r in exact_percentiles(df, ["g"], "v", probs, accuracy=500).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, sub in pdf.groupby("g"):
        for p in probs:
            assert got[(g, p)] == pytest.approx(sub.v.quantile(p))


def test_postcode_normalisation(spark):
    df = spark.createDataFrame([("ab1 2cd",), ("AB1\t2CD",)], "p string")
    assert {r[0] for r in df.select(T.normalise_postcode("p")).collect()} == {"AB12CD"}


def test_dataset_name_rejections(spark):
    df = spark.createDataFrame([("EPD_201312",), ("EPD_202413",), ("XPD_202401",), ("EPD_2024",),
                                ("EPD_202401",)], "name string")
    got = {r.name: r.reason for r in df.select("name", T.name_rejection("name").alias("reason")).collect()}
    assert got == {"EPD_201312": "year", "EPD_202413": "month", "XPD_202401": "prefix",
                   "EPD_2024": "length", "EPD_202401": None}


def test_staleness(spark):
    df = spark.createDataFrame([("AUG_2025", "2026-01-31"), ("AUG_2025", "2026-03-01")], "a string, r string")
    out = df.select(T.is_stale(T.as_of_date("a"), F.col("r").cast("date")).alias("s")).collect()
    assert [r.s for r in out] == [False, True]


def test_dataset_name_parts(spark):
    df = spark.createDataFrame([(2024, 3)], "y int, m int")
    n = df.select(T.dataset_name("y", "m").alias("n")).first().n
    assert n == "EPD_202403"


def test_name_rejection_accepts_columns(spark):
    df = spark.createDataFrame([("epd_202401",), ("EPD_202401",)], "n string")
    got = [r.r for r in df.select(T.name_rejection(F.upper("n")).alias("r")).collect()]
    assert got == [None, None]
