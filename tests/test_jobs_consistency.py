"""The user-facing jobs give the same rows as the registered queries."""
from pyspark.sql import functions as F

from rxatlas.plans import jobs
from rxatlas.plans import register as R
from rxatlas.sources import fixtures as fx
from rxatlas.sources import lookups as lk

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in R.rounded(df).collect())


def test_aggregate_job(spark):
    R._MEMO.clear()
    got = jobs.aggregate_job(R._pindex_geo(spark, SF), R._areas_e(spark, SF), "laua", R._index_spec())
    assert _rows(got) == _rows(R.QUERIES["area_aggregated"](spark, SF))


def test_interpolate_job(spark):
    R._MEMO.clear()
    got = jobs.interpolate_job(R._sources(spark, SF), R._areas_e(spark, SF), k=R.K,
                               threshold=R.LISA_THRESHOLD)
    assert _rows(got) == _rows(R.QUERIES["area_interpolated"](spark, SF))


def test_map_practice_files(spark):
    got = jobs.map_practice_files(R._grouped(spark, SF), lk.ods_select(fx.ods_raw(spark, SF)),
                                  fx.illness_dimension(spark, SF), "pcn_name", tag=R.TAG)
    assert _rows(got) == _rows(R.QUERIES["map_to_practice_area"](spark, SF))
    one_year = jobs.map_practice_files(R._grouped(spark, SF), lk.ods_select(fx.ods_raw(spark, SF)),
                                       fx.illness_dimension(spark, SF), "pcn_name", year=2035, tag=R.TAG)
    assert {r.year for r in one_year.collect()} <= {2035}
