"""Landed files, the load's log, the stream's file index, written tables."""
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from rxatlas.operators import adjacency as adj
from rxatlas.operators import grouping as grp
from rxatlas.operators import illness as ill
from rxatlas.operators import quantiles as qu
from rxatlas.functions.geo import from_bng, to_bng
from rxatlas.plans import jobs
from rxatlas.plans import register as reg
from rxatlas.plans import register_storage as rs
from rxatlas.schemas import LEDGER
from rxatlas.sources import boundaries, epd, storage
from rxatlas.sources import fixtures as fx
from rxatlas.sources import manifests as man
from rxatlas.streaming.incremental import run_incremental_grouping

SF = "/root/testdata/sf0.001"
HDR = "PRACTICE_CODE,POSTCODE,YEAR_MONTH,CHEMICAL_SUBSTANCE_BNF_DESCR,BNF_DESCRIPTION,ITEMS,TOTAL_QUANTITY,ACTUAL_COST\n"


def land(folder, name, *rows, header=HDR):
    os.makedirs(folder, exist_ok=True)
    opener = gzip.open if name.endswith(".gz") else open
    with opener(os.path.join(folder, name), "wt", encoding="utf-8") as f:
        f.write(header + "".join(",".join(map(str, r)) + "\n" for r in rows))


def row(ym, items=1, med="A", practice="P1"):
    return practice, "AB1 2CD", ym, med, "a", items, 1.0, 1.0


def base_table(spark, path):
    return {(r.year, r.month, r.medication): r.total_items for r in grp.read_grouped(spark, path).collect()}


# ---- landed scan --------------------------------------------------------------------

def test_headers_of_many_files_in_one_job(spark, tmp_dir):
    land(tmp_dir, "EPD_203001.csv", *[row("203001")] * 3000)
    land(tmp_dir, "EPD_203002.csv.gz", *[row("203002")] * 3000, header="﻿" + HDR)
    land(tmp_dir, "EPD_203003.csv", header="ITEMS,\"YEAR_MONTH\",\"A,B\"\n")
    open(os.path.join(tmp_dir, "EPD_203004.csv"), "w").close()
    got = {os.path.basename(r.path): list(r.names) for r in epd.file_headers(spark, tmp_dir).collect()}
    assert got == {"EPD_203001.csv": HDR.strip().split(","), "EPD_203002.csv.gz": HDR.strip().split(","), "EPD_203003.csv": ["ITEMS", "YEAR_MONTH", "A,B"]}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != epd._WHOLE_FILE


def test_files_are_named_without_a_pattern_and_not_packed(spark, tmp_dir, monkeypatch):
    for k in range(1, 7):
        land(tmp_dir, f"EPD_20300{k}.csv" + (".gz" if k % 2 else ""), *[(*row(f"20300{k}", k), "x")] * k, header=HDR.strip() + f",{fx.FURTHER_COLUMN}\n")
    monkeypatch.setattr(rs, "_landed", lambda *_: tmp_dir)
    seen, keep = [], rs.reg.materialize
    monkeypatch.setattr(rs.reg, "materialize", lambda df: (seen.append((df._jdf.queryExecution().toString(), epd.read_epd_csv(spark, tmp_dir).rdd.getNumPartitions())),
                                                             keep(df))[1])
    got = sorted(tuple(r) for r in rs.q_landed_rows_by_file(spark, SF).select("file", "YEAR_MONTH", "n_rows", "items", "n_further").collect())
    assert got == [(f"EPD_20300{k}.csv" + (".gz" if k % 2 else ""), f"20300{k}", k, k * k, k) for k in range(1, 7)]
    assert "regexp" not in seen[0][0].lower() and seen[0][1] == 6
    assert spark.conf.get("spark.sql.files.openCostInBytes") != spark.conf.get("spark.sql.files.maxPartitionBytes")


def test_months_are_loaded_a_file_a_task(spark, tmp_dir, monkeypatch):
    for k in range(1, 7):
        land(f"{tmp_dir}/landing", f"EPD_20300{k}.csv.gz", *[row(f"20300{k}", k)] * 2)
    tasks, write = [], grp.write_grouped
    monkeypatch.setattr(grp, "write_grouped", lambda df, path: (tasks.append(epd.read_epd_csv(spark, f"{tmp_dir}/landing").rdd.getNumPartitions()), write(df, path)))
    jobs.load_months(spark, f"{tmp_dir}/landing", f"{tmp_dir}/base", [f"20300{k}" for k in range(1, 7)], "CHEMICAL_SUBSTANCE_BNF_DESCR", "ITEMS")
    assert tasks == [6] and base_table(spark, f"{tmp_dir}/base") == {(2030, k, "A"): 2 * k for k in range(1, 7)}


def test_rows_carry_their_file_and_repeated_headers_go(spark, tmp_dir):
    land(tmp_dir, "EPD_203001.csv", ("203001", 2), ("YEAR_MONTH", "ITEMS"), ("203001", 3), header="YEAR_MONTH,ITEMS\n")  # two deliveries put together
    land(tmp_dir, "EPD_203002.csv", (5, "203002", "x"), header="ITEMS,YEAR_MONTH,NOTE\n")
    rows = epd.read_epd_csv(spark, tmp_dir, keep_source=True).collect()
    assert sorted((os.path.basename(r.source_file), r.YEAR_MONTH, r.ITEMS, r.NOTE) for r in rows) == [
        ("EPD_203001.csv", "203001", 2, None), ("EPD_203001.csv", "203001", 3, None), ("EPD_203002.csv", "203002", 5, "x")]
    assert [r.YEAR_MONTH for r in epd.read_epd_csv(spark, tmp_dir, months=["203002"]).collect()] == ["203002"]
    with pytest.raises(epd.BadHeader, match="EPD_203001.csv: lacks NOTE"):
        epd.landed_scan(spark, tmp_dir, required=["NOTE"])
    with pytest.raises(FileNotFoundError):
        epd.read_epd_csv(spark, tmp_dir, year=1999)


def test_splits_of_one_file_know_their_header(spark, tmp_dir):
    land(tmp_dir, "EPD_203001.csv", *[(i, "203001") for i in range(40000)], header="ITEMS,YEAR_MONTH\n")
    with epd._conf(spark, **{"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "0"}):
        df = epd.read_epd_csv(spark, tmp_dir)
        assert df.rdd.getNumPartitions() > 4
        r = df.agg(F.count("*"), F.sum("ITEMS")).first()
    assert tuple(r) == (40000, sum(range(40000)))


# ---- the load's log ---------------------------------------------------------------------

def test_a_run_that_dies_before_its_commit_is_taken_up(spark, tmp_dir, monkeypatch):
    landing, target, log = (os.path.join(tmp_dir, x) for x in ("landing", "base", "log"))
    land(landing, "EPD_203001.csv", row("203001", 2))
    land(landing, "EPD_203002.csv", row("203002", 3))
    with monkeypatch.context() as m:
        def dies(*_):
            raise RuntimeError("killed")
        m.setattr(jobs, "commit_months", dies)
        with pytest.raises(RuntimeError, match="killed"):
            jobs.prepare_months(spark, landing, target, log, [2030])
    assert base_table(spark, target) == {(2030, 1, "A"): 2, (2030, 2, "A"): 3}  # written, not committed
    state = {r.name: r.status for r in man.month_state(man.load_manifest(spark, log, LEDGER)).collect()}
    assert state == {"EPD_203001": "open", "EPD_203002": "open"}
    land(landing, "EPD_203003.csv", row("203003", 4))
    assert {r.name for r in jobs.prepare_months(spark, landing, target, log, [2030]).collect()} == {"EPD_203001", "EPD_203002", "EPD_203003"}
    rows = {r.name: (r.status, r.n_runs, r.n_groups, r.total) for r in man.month_state(man.load_manifest(spark, log, LEDGER)).collect()}
    assert rows == {"EPD_203001": ("committed", 2, 1, 2.0), "EPD_203002": ("committed", 2, 1, 3.0), "EPD_203003": ("committed", 1, 1, 4.0)}
    assert jobs.prepare_months(spark, landing, target, log, [2030]).count() == 0


def test_a_run_that_dies_while_writing(spark, tmp_dir, monkeypatch):
    landing, target, log = (os.path.join(tmp_dir, x) for x in ("landing", "base", "log"))
    land(landing, "EPD_203001.csv", row("203001", 2))
    jobs.prepare_months(spark, landing, target, log, [2030])
    land(landing, "EPD_203001_more.csv", row("203001", 5, "B"))  # the month's files are others now
    with monkeypatch.context() as m:
        m.setattr(jobs.grp, "write_grouped", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            jobs.prepare_months(spark, landing, target, log, [2030])
    assert base_table(spark, target) == {(2030, 1, "A"): 2}
    assert jobs.prepare_months(spark, landing, target, log, [2030]).count() == 1
    assert base_table(spark, target) == {(2030, 1, "A"): 2, (2030, 1, "B"): 5}


def test_months_without_rows_or_files(spark, tmp_dir):
    landing, target, log = (os.path.join(tmp_dir, x) for x in ("landing", "base", "log"))
    land(landing, "EPD_203001.csv", row("203001"))
    land(landing, "EPD_203002.csv")  # a header alone
    assert [r.name for r in jobs.prepare_months(spark, landing, target, log, [2030]).collect()] == ["EPD_203001"]
    state = {r.name: r.status for r in man.month_state(man.load_manifest(spark, log, LEDGER)).collect()}
    assert state == {"EPD_203001": "committed", "EPD_203002": "empty"}
    assert jobs.prepare_months(spark, landing, target, log, [2030]).count() == 0
    assert jobs.prepare_months(spark, landing, target, log, [2030], overwrite=True).count() == 1


def test_rows_of_an_older_log_are_commits(spark, tmp_dir):
    old = spark.createDataFrame([("EPD_203001", False), ("EPD_203002", True)], "name string, update_required boolean").select(
        "name", F.lit("grouped_epds").alias("record_type"), F.current_timestamp().alias("latest_process_date"), "update_required")
    old.write.parquet(tmp_dir)
    got = {r.name: (r.status, r.update_required) for r in man.month_state(man.load_manifest(spark, tmp_dir, LEDGER)).collect()}
    assert got == {"EPD_203001": ("committed", False), "EPD_203002": ("committed", True)}


def test_storage_listing(spark, tmp_dir):
    assert storage.list_files(spark, tmp_dir).count() == 0 and storage.table_months(spark, tmp_dir).count() == 0
    land(tmp_dir, "EPD_203001.csv", row("203001"))
    land(tmp_dir, "EPD_203001_b.csv", row("203001"))
    land(tmp_dir, "other.csv", row("203001"))
    open(os.path.join(tmp_dir, "EPD_203002.csv"), "w").close()
    assert [(r.name, r.n_files) for r in storage.landed_months(spark, tmp_dir).collect()] == [("EPD_203001", 2)]


# ---- the stream's file index ---------------------------------------------------------------

def test_stream_opens_only_files_of_touched_months(spark, tmp_dir):
    landing, target, ckpt, log = (os.path.join(tmp_dir, x) for x in ("landing", "base", "ckpt", "log"))
    land(landing, "EPD_203001.csv", row("203001", 2), row("203002", 1))
    land(landing, "EPD_203002.csv", row("203002", 4))
    land(landing, "EPD_203003.csv", row("203003", 9))
    run_incremental_grouping(spark, landing, target, ckpt, log)
    assert base_table(spark, target) == {(2030, 1, "A"): 2, (2030, 2, "A"): 5, (2030, 3, "A"): 9}
    os.remove(os.path.join(landing, "EPD_203003.csv"))  # March isn't touched below, its file may go
    land(landing, "EPD_203002_b.csv", row("203002", 10))
    run_incremental_grouping(spark, landing, target, ckpt, log)
    assert base_table(spark, target) == {(2030, 1, "A"): 2, (2030, 2, "A"): 15, (2030, 3, "A"): 9}
    land(landing, "EPD_203004.csv", row("203004", 7))
    os.remove(os.path.join(landing, "EPD_203002.csv"))
    run_incremental_grouping(spark, landing, target, ckpt, log)
    assert base_table(spark, target)[2030, 4, "A"] == 7 and len(base_table(spark, target)) == 4
    runs = {r.name: r.n_runs for r in man.month_state(man.load_manifest(spark, log, LEDGER)).collect()}
    assert runs == {"EPD_203001": 1, "EPD_203002": 2, "EPD_203003": 1, "EPD_203004": 1}


# ---- boundaries -----------------------------------------------------------------------------

def test_a_large_collection_is_many_tasks(spark, tmp_dir):
    rng = random.Random(1)
    ring = lambda x, y, n=40: [[x + rng.random(), y + rng.random()] for _ in range(n)]
    feats = []
    for k in range(300):
        r = ring(k, k)
        geometry = {"type": "Polygon", "coordinates": [r + [r[0]]]} if k % 3 else {"type": "MultiPolygon", "coordinates": [[r + [r[0]]], [r + [r[0]], r[:3] + [r[0]]]]}
        feats.append({"type": "Feature", "id": k, "properties": {"LAD": f"E{k}", "note": "}]{ \"x\" Feature"}, "geometry": geometry if k % 50 else None})
    os.makedirs(tmp_dir)
    for name, indent in (("compact", None), ("pretty", 1)):
        path = os.path.join(tmp_dir, f"{name}.geojson")
        with open(path, "w") as f:
            json.dump({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "27700"}}, "features": feats}, f, indent=indent)
        with epd._conf(spark, **{"spark.sql.files.maxPartitionBytes": "32768", "spark.sql.files.openCostInBytes": "0"}):
            split = boundaries.read_boundaries_geojson(spark, path, "LAD")
            assert boundaries.split_features(spark, path).rdd.getNumPartitions() > 4
            got = {r.code: r.parts for r in split.collect()}
        whole = {r.code: r.parts for r in boundaries.read_boundaries_geojson(spark, path, "LAD", split=False).collect()}
        assert got == whole and len(got) == 300 and got["E50"] is None


def test_a_collection_that_cannot_be_split_is_read_whole(spark, tmp_dir):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    os.makedirs(tmp_dir)
    path = os.path.join(tmp_dir, "a.geojson")
    with open(path, "w") as f:
        json.dump({"features": [{"geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"LAD": "E1", "kind": "Feature"}, "type": "Feature"}]}, f)
    assert boundaries.split_features(spark, path) is None
    assert [r.code for r in boundaries.read_boundaries_geojson(spark, path, "LAD").collect()] == ["E1"]


# ---- written tables, names, projection, percentiles --------------------------------------------

def test_written_table_plans_prune_partitions(spark, tmp_dir):
    grp.write_grouped(reg._grouped(spark, SF), tmp_dir)
    g = grp.read_grouped(spark, tmp_dir)
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plan = text(ill.medication_totals(g, reg._dim(spark, SF), tag=reg.TAG, year=reg.YEAR))
    assert f"PartitionFilters: [isnotnull(year" in plan and f"= {reg.YEAR})" in plan
    plan = text(jobs.period_totals(g, rs._calendar(spark), ["2015/16"]))
    assert "dynamicpruning" in plan
    assert jobs.period_totals(g, rs._calendar(spark), ["1901/02"]).count() == 0


def test_automaton_equals_substrings_and_exact_names(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(3, 9)))
    names = sorted({word() + " " + word() for _ in range(5200)})[:5000]
    spec = [ill.IllnessSpec(f"Ill {k}", (), tuple(names[k::20])) for k in range(20)]
    spec[3] = ill.IllnessSpec("Ill 3", (), (*spec[3].medications, "Ärztlich", "a.b"))
    texts = [f"{rng.choice(names).upper()} {rng.choice(names)} 5mg" for _ in range(300)] + rng.sample(names, 200) + ["", "nothing", "ärztlich", "Ärztlich", "A.B", "axb", None]
    df = spark.createDataFrame([(t, k + 1) for k, t in enumerate(texts)], "BNF_DESCRIPTION string, ITEMS bigint")
    got = {r.ITEMS: tuple(r[s.column] for s in spec) for r in ill.flag_items_automaton(df, spec).collect()}
    want = {}
    for k, t in enumerate(texts):
        hit = [t is not None and any((m.lower() in t.lower()) if m.isascii() else m in t for m in s.medications) for s in spec]
        want[k + 1] = tuple(k + 1 if h else 0 for h in hit)
    assert got == want
    # a text that is a name alone: the exact mode's hit is among the automaton's
    dim = ill.dimension_df(spark, spec)
    exact = ill.flag_items_exact(df.withColumn("CHEMICAL_SUBSTANCE_BNF_DESCR", F.col("BNF_DESCRIPTION")), dim, spec).collect()
    assert all(got[r.ITEMS][i] >= r[s.column] for r in exact for i, s in enumerate(spec)) and sum(r[s.column] > 0 for r in exact for s in spec) >= 200
    few = [ill.IllnessSpec(s.illness, s.tags, s.medications[:3]) for s in spec]
    one = df.select(*[c for c in ill.illness_item_columns(few)]).collect()
    assert [tuple(r) for r in ill.flag_items_automaton(df, few).select(*[s.column for s in few]).collect()] == [tuple(r) for r in one]


def test_projection_there_and_back(spark):
    points = [(52.657977, 1.716038), (50.0, -5.5), (58.5, -3.0), (55.0, -2.0), (51.5, -0.1)]
    df = spark.createDataFrame(points, "lat double, long double")
    for r in from_bng(to_bng(df), lat="lat2", lon="long2").collect():
        assert abs(r.lat2 - r.lat) * 111_000 < 0.001 and abs(r.long2 - r.long) * 111_000 < 0.001


def test_sketches_keep_to_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("y"), (F.col("id") % 12).alias("m"), F.pow(F.col("id") % 9973, 2.0).alias("v"))
    months = qu.sketch_values(df, ["y", "m"], "v")
    year = qu.merged_sketches(months, ["y"])
    rows = qu.sketch_percentiles(year, ["y"], [0.005, 0.5, 0.995]).collect()
    values = {y: sorted(r.v for r in df.where(F.col("y") == y).collect()) for y in range(3)}
    assert len(rows) == 9
    for r in rows:
        v = values[r.y]
        below, upto = sum(x < r.value for x in v) / len(v), sum(x <= r.value for x in v) / len(v)
        assert below <= r.p + qu.SKETCH_RANK_ERROR and upto >= r.p - qu.SKETCH_RANK_ERROR


# ---- adjacency --------------------------------------------------------------------------------------

def square(code, x, y, s):
    p = [(float(x), float(y)), (float(x + s), float(y)), (float(x + s), float(y + s)), (float(x), float(y + s)), (float(x), float(y))]
    return code, [[p]]


AREA = "code string, parts array<array<array<struct<x:double,y:double>>>>"


def test_a_nation_among_small_areas_has_few_cells(spark):
    rows = [square(f"s{i}", 20 * (i % 40), 20 * (i // 40), 10) for i in range(800)] + [square("nation", -5000, -5000, 1_000_000)]
    areas = spark.createDataFrame(rows, AREA)
    e = adj.edges(areas)
    g = adj.default_cell(e)
    cells = adj.edge_cells(e, g)
    assert cells.count() <= 4 * 1.25 * e.count() and cells.where("code = 'nation'").count() < 3 * 4 * 1_000_000 / g
    at = adj._at_levels(adj.boxes(areas).withColumn("L", adj._level(10.0)), 10.0).groupBy("code").count().agg(F.max("count")).first()[0]
    assert at <= 4
    pairs = {(r.code, r.nb) for r in adj.neighbour_pairs(areas).collect()}
    assert pairs == {(f"s{i}",) * 2 for i in range(800)} | {("nation", "nation")} | {(f"s{i}", "nation") for i in range(800)} | {("nation", f"s{i}") for i in range(800)}


def test_update_joins_only_what_is_near(spark, monkeypatch):
    rows = [square(f"s{i}", 10 * (i % 20), 10 * (i // 20), 10) for i in range(200)]
    before = spark.createDataFrame(rows, AREA)
    stored, pairs = adj.boundary_digests(before).persist(), adj.neighbour_pairs(before).persist()
    after = spark.createDataFrame([square("s0", 2, 2, 5), *[r for r in rows if r[0] not in ("s0", "s199")], square("new", 195, 95, 3)], AREA)
    seen = []
    full = adj.neighbour_pairs
    monkeypatch.setattr(adj, "neighbour_pairs", lambda a, *x, **k: (seen.append(a.count()), full(a, *x, **k))[1])
    got = {(r.code, r.nb) for r in adj.update_pairs(after, stored, pairs).collect()}
    assert seen and seen[0] <= 6
    assert got == {(r.code, r.nb) for r in full(after).collect()}
    assert {(r.code, r.nb) for r in adj.update_pairs(before, stored, pairs).collect()} == {(r.code, r.nb) for r in pairs.collect()}


def shapes(n, seed):
    """Squares, triangles, squares with a hole, two-part areas; some within others, some within holes."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        x, y, s = float(rnd.randrange(0, 200)), float(rnd.randrange(0, 200)), float(rnd.choice([1, 3, 8, 20, 60]))
        code, parts = square(f"a{i}", x, y, s)
        if i % 4 == 1:
            parts = [[[(x, y), (x + s, y), (x + s / 3, y + s), (x, y)]]]
        elif i % 4 == 2:
            parts = [[parts[0][0], square("", x + s / 4, y + s / 4, s / 2)[1][0][0]]]
        elif i % 4 == 3:
            parts = [parts[0], square("", x + 2 * s, y, s / 2)[1][0]]
        out.append((code, parts))
    return out


def test_pairs_are_listed_once_whatever_the_blocks(spark, monkeypatch):
    rows = shapes(120, 5) + [square("hole", 50, 50, 0.5), square("big", -10, -10, 500)]
    areas = spark.createDataFrame(rows, AREA)
    plain = adj.inner_boxes
    with monkeypatch.context() as m:  # no inner box is known: every pair by its edges
        m.setattr(adj, "inner_boxes", lambda a: plain(a).withColumn("inner", F.when(F.lit(False), F.col("inner"))).withColumn("full", F.lit(False)))
        by_edges = sorted((r.code, r.nb) for r in adj.neighbour_pairs(areas).collect())
    monkeypatch.setattr(adj, "BLOCK_BOXES", 3)
    monkeypatch.setattr(adj, "TASK_TESTS", 100)
    assert sorted((r.code, r.nb) for r in adj.neighbour_pairs(areas).collect()) == by_edges
    full = {r.code for r in plain(areas).where("full").collect()}
    assert {"a0", "big", "hole"} <= full and not full & {"a1", "a2", "a3"}
    touched = {"a0", "a1", "a2", "a7", "hole"}
    only = spark.createDataFrame([(c,) for c in touched], "code string")
    assert sorted((r.code, r.nb) for r in adj.neighbour_pairs(areas, only=only).collect()) == [p for p in by_edges if touched & set(p)]


def test_a_code_that_comes_twice_has_the_pairs_of_both(spark):
    rows = [square("a", 0, 0, 10), square("a", 100, 0, 10), square("b", 5, 5, 10), square("c", 105, 5, 1), square("c", 105, 5, 1), square("d", 300, 0, 1)]
    got = sorted((r.code, r.nb) for r in adj.neighbour_pairs(spark.createDataFrame(rows, AREA)).collect())
    assert got == [("a", "a"), ("a", "b"), ("a", "c"), ("b", "a"), ("b", "b"), ("c", "a"), ("c", "c"), ("d", "d")]


def test_pairs_of_squares_pass_no_shuffle(spark):
    rows = [square(f"s{i}", 3 * (i % 20), 3 * (i // 20), 10) for i in range(200)]
    pairs = adj.neighbour_pairs(spark.createDataFrame(rows, AREA))
    got = sorted((r.code, r.nb) for r in pairs.collect())
    assert got == sorted((a[0], b[0]) for a in rows for b in rows if all(abs(p - q) <= 10 for p, q in zip(a[1][0][0][0], b[1][0][0][0])))
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") == 0 and plan.count("Aggregate") == 1  # that of the areas themselves
