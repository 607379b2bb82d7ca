import json
import os

import pytest
from pyspark.sql import functions as F

from rxatlas.operators import adjacency as adj
from rxatlas.operators import grouping as grp
from rxatlas.plans import jobs
from rxatlas.schemas import GROUP_MANIFEST
from rxatlas.sources.boundaries import read_boundaries_geojson
from rxatlas.sources.manifests import load_manifest


def test_geojson_polygon_and_multipolygon(spark, tmp_dir):
    os.makedirs(tmp_dir)
    sq = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"LAD": "E01"}, "geometry": {"type": "Polygon", "coordinates": [sq]}},
        {"type": "Feature", "properties": {"LAD": "E02"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[20, 0], [22, 0], [22, 2], [20, 2], [20, 0]]],
                                                             [[[30, 0], [32, 0], [32, 2], [30, 2], [30, 0]]]]}},
        {"type": "Feature", "properties": {"LAD": "W01"}, "geometry": {"type": "Polygon", "coordinates": [sq]}}]}
    p = os.path.join(tmp_dir, "b.geojson")
    with open(p, "w") as fh:
        json.dump(doc, fh)
    areas = read_boundaries_geojson(spark, p, "LAD")
    got = {r.code: r for r in adj.centroids(areas).collect()}
    assert set(got) == {"E01", "E02"}
    assert got["E01"].cx == pytest.approx(5.0) and got["E02"].cx == pytest.approx(26.0)


def test_missing_manifest_reads_empty(spark, tmp_dir):
    assert load_manifest(spark, tmp_dir, GROUP_MANIFEST).count() == 0


def test_prepare_months_is_incremental(spark, tmp_dir):
    landing, target, man = (os.path.join(tmp_dir, x) for x in ("landing", "grouped", "manifest"))
    os.makedirs(landing)
    hdr = "PRACTICE_CODE,POSTCODE,YEAR_MONTH,CHEMICAL_SUBSTANCE_BNF_DESCR,BNF_DESCRIPTION,ITEMS,TOTAL_QUANTITY,ACTUAL_COST\n"
    for ym, items in (("203001", 2), ("203002", 3)):
        with open(os.path.join(landing, f"EPD_{ym}.csv"), "w") as fh:
            fh.write(hdr + f"P1,AB1 2CD,{ym},A,a,{items},1,1\n")
    first = {r.name for r in jobs.prepare_months(spark, landing, target, man, [2030]).collect()}
    assert first == {"EPD_203001", "EPD_203002"}
    with open(os.path.join(landing, "EPD_203003.csv"), "w") as fh:
        fh.write(hdr + "P1,AB1 2CD,203003,A,a,7,1,1\n")
    second = {r.name for r in jobs.prepare_months(spark, landing, target, man, [2030]).collect()}
    assert second == {"EPD_203003"}
    got = {(r.month, r.total_items) for r in grp.read_grouped(spark, target).collect()}
    assert got == {(1, 2), (2, 3), (3, 7)}
    assert {r.medication for r in jobs.analyst_totals(spark, target, 2030).collect()} == {"A"}


def test_month_files_are_read_by_name(spark, tmp_dir):
    """Files with other column orders, further columns and compression."""
    import gzip
    import os

    from rxatlas.sources.epd import read_epd_csv
    os.makedirs(tmp_dir)
    with open(f"{tmp_dir}/EPD_203001.csv", "w") as f:
        f.write("PRACTICE_CODE,YEAR_MONTH,ITEMS\nA1,203001,2\n")
    with open(f"{tmp_dir}/EPD_203002.csv", "w") as f:
        f.write("YEAR_MONTH,REGIONAL_OFFICE_NAME,ITEMS,PRACTICE_CODE\n203002,LONDON,3,B1\n")
    with gzip.open(f"{tmp_dir}/EPD_203003.csv.gz", "wt") as f:
        f.write("ITEMS,YEAR_MONTH,PRACTICE_CODE\n4,203003,C1\n")
    got = read_epd_csv(spark, tmp_dir, year=2030).select("PRACTICE_CODE", "YEAR_MONTH", "ITEMS").collect()
    assert sorted((r[0], r[1], int(r[2])) for r in got) == [("A1", "203001", 2), ("B1", "203002", 3), ("C1", "203003", 4)]


def test_area_without_geometry_stays(spark, tmp_dir):
    import json
    import os

    from rxatlas.sources.boundaries import read_boundaries_geojson
    os.makedirs(tmp_dir)
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    with open(f"{tmp_dir}/a.json", "w") as f:
        json.dump({"features": [{"properties": {"LAD": "E1"}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
                                {"properties": {"LAD": "E2"}, "geometry": None}]}, f)
    got = {r.code: r.parts for r in read_boundaries_geojson(spark, f"{tmp_dir}/a.json", "LAD").collect()}
    assert set(got) == {"E1", "E2"} and got["E2"] is None


def test_missing_lookup_column_is_reported(spark):
    from rxatlas.sources import fixtures as fx
    from rxatlas.sources import lookups as lk
    raw = fx.nspl_raw(spark, "/root/testdata/sf0.001")
    gone = next(iter(lk.NSPL_COLUMNS.values()))
    rows = lk.schema_contract({"nspl": raw.drop(gone)}).collect()
    assert len(rows) == len(lk.NSPL_COLUMNS) and [r.source for r in rows if not r.present] == [gone]
