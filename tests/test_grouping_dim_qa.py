import os

import pytest
from pyspark.sql import functions as F

from rxatlas.operators import grouping as grp
from rxatlas.operators import illness as ill
from rxatlas.operators import qa
from rxatlas.sources import epd as src_epd


def _epd(spark, rows):
    return spark.createDataFrame(rows, "PRACTICE_CODE string, POSTCODE string, YEAR_MONTH string, "
                                       "CHEMICAL_SUBSTANCE_BNF_DESCR string, BNF_DESCRIPTION string, ITEMS bigint, "
                                       "TOTAL_QUANTITY double, ACTUAL_COST double")


def test_month_rewrite_removes_vanished_medication(spark, tmp_dir):
    rows = [("P", "ab1 2cd", "203001", "A", "a", 1, 1.0, 1.0), ("P", "ab1 2cd", "203001", "B", "b", 2, 1.0, 1.0),
            ("P", "ab1 2cd", "203002", "B", "b", 3, 1.0, 1.0)]
    grp.write_grouped(grp.group_month(_epd(spark, rows)), tmp_dir)
    redo = [("P", "ab1 2cd", "203001", "A", "a", 5, 1.0, 1.0)]
    grp.write_grouped(grp.group_month(_epd(spark, redo)), tmp_dir)
    got = {(r.month, r.medication, r.total_items) for r in grp.read_grouped(spark, tmp_dir).collect()}
    assert got == {(1, "A", 5), (2, "B", 3)}
    assert dict(grp.read_grouped(spark, tmp_dir).dtypes)["year"] == "smallint"


def test_csv_source_types_and_year_glob(spark, tmp_dir):
    os.makedirs(tmp_dir)
    hdr = "PRACTICE_CODE,POSTCODE,YEAR_MONTH,CHEMICAL_SUBSTANCE_BNF_DESCR,BNF_DESCRIPTION,ITEMS,TOTAL_QUANTITY,ACTUAL_COST\n"
    for ym in ("203001", "203101"):
        with open(os.path.join(tmp_dir, f"EPD_{ym}.csv"), "w") as fh:
            fh.write(hdr + f"P1,AB1 2CD,{ym},Zopiclone,Zopiclone 7.5mg tablets,3,84,1.5\n")
    df = src_epd.read_epd_csv(spark, tmp_dir, year=2030)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].ITEMS == 3 and rows[0].TOTAL_QUANTITY == 84.0
    assert dict(df.dtypes)["ITEMS"] == "bigint"


def test_flat_drug_list_bom_and_trailing_blank(spark, tmp_dir):
    os.makedirs(tmp_dir)
    p = os.path.join(tmp_dir, "drugs.csv")
    with open(p, "w", encoding="utf-8-sig") as fh:
        fh.write("Depression,Fluoxetine\nBlood pressure,enalapril \n")
    rows = ill.read_flat_csv(spark, p).collect()
    assert rows[0].illness == "Depression"
    assert rows[1].medication == "Enalapril"


def test_tag_and_illness_errors(spark):
    dim = ill.dimension_df(spark, ill.default_spec())
    with pytest.raises(ValueError):
        ill.medications(dim, tag="loneliness", illness="insomnia")
    with pytest.raises(KeyError):
        ill.medications(dim, illness="not an illness")
    meds = {r.medication for r in ill.medications(dim, illness="social anxiety").collect()}
    assert meds == {"Escitalopram", "Sertraline"}
    lonely = {r.medication for r in ill.medications(dim, tag="loneliness").collect()}
    assert "Zopiclone" in lonely and "Metformin" not in lonely


def test_yaml_roundtrip(spark, tmp_dir):
    os.makedirs(tmp_dir)
    p = os.path.join(tmp_dir, "drugs.yml")
    ill.save_spec_yaml(ill.default_spec(), p)
    assert ill.load_spec_yaml(p) == ill.default_spec()


def test_exact_mode_does_not_duplicate_rows(spark):
    spec = ill.normalise_spec([("Depression", ["Loneliness"], ["Sertraline"]),
                               ("Social Anxiety", ["Loneliness"], ["Sertraline"])])
    e = _epd(spark, [("P", "X", "203001", "Sertraline", "Sertraline 50mg", 4, 1.0, 1.0),
                     ("P", "X", "203001", "Other", "Other", 2, 1.0, 1.0)])
    out = ill.flag_items_exact(e, ill.dimension_df(spark, spec), spec).collect()
    assert len(out) == 2
    s = {r.CHEMICAL_SUBSTANCE_BNF_DESCR: (r.depression, r.social_anxiety) for r in out}
    assert s == {"Sertraline": (4, 4), "Other": (0, 0)}


def test_histogram_min_equals_max_and_max_in_last_bin(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 3.0), ("b", 0.0), ("b", 1.0), ("b", 10.0)], "g string, v double")
    h = {(r.g, r.bin): r for r in qa.histogram(df, ["g"], "v").collect()}
    assert h[("a", 25)]["count"] == 2 and h[("a", 0)].bin_lo == pytest.approx(2.5)
    assert h[("b", 49)]["count"] == 1 and h[("b", 0)]["count"] == 1 and h[("b", 5)]["count"] == 1
    assert sum(r["count"] for (g, _), r in h.items() if g == "b") == 3
