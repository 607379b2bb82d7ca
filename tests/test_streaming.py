import os

from rxatlas.operators.grouping import read_grouped
from rxatlas.operators.manifest import latest_state
from rxatlas.streaming.incremental import run_incremental_grouping

HDR = "PRACTICE_CODE,POSTCODE,YEAR_MONTH,CHEMICAL_SUBSTANCE_BNF_DESCR,BNF_DESCRIPTION,ITEMS,TOTAL_QUANTITY,ACTUAL_COST\n"


def _land(d, name, rows):
    with open(os.path.join(d, name), "w") as fh:
        fh.write(HDR + "".join(",".join(map(str, r)) + "\n" for r in rows))


def test_incremental_grouping(spark, tmp_dir):
    landing, target, ckpt, man = (os.path.join(tmp_dir, x) for x in ("landing", "grouped", "ckpt", "manifest"))
    os.makedirs(landing)
    _land(landing, "EPD_203001.csv", [("P1", "AB1 2CD", "203001", "A", "a", 2, 1.0, 1.0),
                                       ("P1", "AB1 2CD", "203001", "A", "a", 3, 1.0, 1.0)])
    _land(landing, "EPD_203002.csv", [("P1", "AB1 2CD", "203002", "B", "b", 4, 1.0, 1.0)])
    run_incremental_grouping(spark, landing, target, ckpt, man)
    got = {(r.month, r.medication, r.total_items) for r in read_grouped(spark, target).collect()}
    assert got == {(1, "A", 5), (2, "B", 4)}
    # a second file for January and a new month: January is re-grouped whole
    _land(landing, "EPD_203001_b.csv", [("P1", "AB1 2CD", "203001", "A", "a", 10, 1.0, 1.0)])
    _land(landing, "EPD_203003.csv", [("P2", "AB1 2CD", "203003", "C", "c", 1, 1.0, 1.0)])
    run_incremental_grouping(spark, landing, target, ckpt, man)
    got = {(r.month, r.medication, r.total_items) for r in read_grouped(spark, target).collect()}
    assert got == {(1, "A", 15), (2, "B", 4), (3, "C", 1)}
    log = spark.read.parquet(man)
    assert log.count() == 4  # January was processed twice
    names = {r.name for r in latest_state(log, order="latest_process_date").collect()}
    assert names == {"EPD_203001", "EPD_203002", "EPD_203003"}
