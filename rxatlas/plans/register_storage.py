"""Queries over what lies in storage: landed files, written tables, logs.

Each lands the fixture the way deliveries arrive (or writes the table a job
writes) below the shared scratch folder, then runs the library's own reader or
job on it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rxatlas.functions.geo import from_bng, to_bng, valid_point
from rxatlas.functions.text import normalise_postcode
from rxatlas.operators import adjacency as adj
from rxatlas.operators import area as ar
from rxatlas.operators import grouping as grp
from rxatlas.operators import illness as ill
from rxatlas.operators import index as idx
from rxatlas.operators import knn
from rxatlas.operators import manifest as mf
from rxatlas.operators import quantiles as qu
from rxatlas.operators.vintage import VINTAGES, keep_fitting_years, vintage_check
from rxatlas.plans import jobs
from rxatlas.plans import register as reg
from rxatlas.plans.register import query, rounded
from rxatlas.schemas import LEDGER, POSTCODE_AREA_TYPES, PRACTICE_AREA_TYPES
from rxatlas.session import scratch_path
from rxatlas.sources import boundaries, storage
from rxatlas.sources import epd as src_epd
from rxatlas.sources import fixtures as fx
from rxatlas.sources import lookups as lk
from rxatlas.sources import manifests as man


def _landed(spark, sf, condition="true"):
    return fx.land_epd(spark, sf, scratch_path(spark, "landing"), condition)


def _years(spark, sf):
    return sorted(r.y for r in fx.catalogue_months(spark, sf).select("y").distinct().collect())


def _written(spark, sf, condition="true"):
    path = scratch_path(spark, "grouped")
    grp.write_grouped(reg._grouped(spark, sf).where(condition), path)
    return path


# ---- landed files -----------------------------------------------------------------

@query("scan_epd_typed")
def q_scan_epd_typed(spark, sf):
    """Landed months with three header layouts, one of them compressed."""
    return rounded(src_epd.read_epd_csv(spark, _landed(spark, sf)).select(*fx.EPD_COLUMNS))


@query("epd_year_slice")
def q_epd_year_slice(spark, sf):
    """S3: each year read by its file names alone."""
    path, out = _landed(spark, sf), None
    for y in _years(spark, sf):
        one = src_epd.slice_summary(src_epd.read_epd_csv(spark, path, year=y))
        out = one if out is None else out.unionByName(one)
    return out


@query("landed_headers")
def q_landed_headers(spark, sf):
    """Every landed file's header against the table shape."""
    h = src_epd.check_epd_headers(spark, _landed(spark, sf))
    return h.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "n_columns", F.array_join("missing", ",").alias("missing"),
                    F.array_join("further", ",").alias("further"))


@query("landed_rows_by_file")
def q_landed_rows_by_file(spark, sf):
    """The union of all months, each row with the file it comes from."""
    rows = src_epd.read_epd_csv(spark, _landed(spark, sf), keep_source=True)
    # the name is cut off, not searched: a pattern tried at every position of a path costs more than the row's scan
    by_file = rows.groupBy(F.substring_index(src_epd.SOURCE_FILE, "/", -1).alias("file"), "YEAR_MONTH").agg(
        F.count("*").alias("n_rows"), F.sum("ITEMS").alias("items"), F.count(fx.FURTHER_COLUMN).alias("n_further"))
    with src_epd.unpacked(spark):
        return reg.materialize(by_file)  # a few rows a file


def _lookup(spark, raw, key, **options):
    return lk.read_lookup_csv(spark, fx.land_csv(raw, scratch_path(spark, "lookup"), key), **options)


@query("nspl_england")
def q_nspl_england(spark, sf):
    """The legacy lookup from its CSV."""
    return rounded(lk.nspl_england(_lookup(spark, fx.nspl_legacy_raw(spark, sf), "pcd")))


@query("nspl_select")
def q_nspl_select(spark, sf):
    """The postcode lookup from its CSV."""
    return rounded(lk.nspl_select(_lookup(spark, fx.nspl_raw(spark, sf), "pcds")))


@query("ods_select")
def q_ods_select(spark, sf):
    """The organisation lookup from its CSV, its options passed through."""
    return lk.ods_select(_lookup(spark, fx.ods_raw(spark, sf), "Code", typed={}, nullValue=""))


@query("lookup_columns")
def q_lookup_columns(spark, sf):
    """Header and first row of a new lookup file."""
    path = fx.land_csv(fx.nspl_raw(spark, sf).select("pcds", "lsoa21cd", "msoa21cd", "cty25cd", "lad25cd", "wd25cd"), scratch_path(spark, "lookup"), "pcds")
    return lk.landed_columns(spark, path, "*.csv").select("position", "column", "first_value")


@query("boundaries_geojson")
def q_boundaries_geojson(spark, sf):
    """S10 + F4 + P19: irregular polygons with holes and several parts, landed
    as one feature collection, read in splits."""
    path = fx.land_geojson(fx.irregular_areas(spark, sf), scratch_path(spark, "boundaries"), "LAD25CD")
    areas = boundaries.read_boundaries_geojson(spark, path, "LAD25CD")
    c = adj.centroids(areas).select("code", "cx", "cy", "area")
    return rounded(areas.select("code", F.size("parts").alias("n_parts"), F.size(F.flatten("parts")).alias("n_rings"),
                                F.size(F.flatten(F.flatten("parts"))).alias("n_vertices")).join(c, "code"))


# ---- incremental state --------------------------------------------------------------

@query("prepare_months_state")
def q_prepare_months_state(spark, sf):
    """C1 + K6: every year but the last is loaded; a run then dies in the last
    year's first half between writing and committing; the next run takes those
    months up again and loads the rest. State by month, from the log."""
    landing, target, log = _landed(spark, sf), scratch_path(spark, "base"), scratch_path(spark, "log")
    years, how = _years(spark, sf), ("CHEMICAL_SUBSTANCE_BNF_DESCR", "ITEMS")
    jobs.prepare_months(spark, landing, target, log, years[:-1])
    half = storage.landed_months(spark, landing).where(F.col("name").like(f"EPD_{years[-1]}%") & (F.substring("name", 9, 2) <= "06"))
    half = spark.createDataFrame(half.collect(), half.schema)  # at most six names
    jobs.begin_months(half, log, "dies", *how)
    jobs.load_months(spark, landing, target, [r.name[4:] for r in half.collect()], *how)
    jobs.prepare_months(spark, landing, target, log, years)
    state = man.month_state(man.load_manifest(spark, log, LEDGER))
    held = grp.read_grouped(spark, target).groupBy("year", "month").agg(F.sum("total_items").alias("held"))
    held = held.select(F.format_string("EPD_%04d%02d", "year", "month").alias("name"), "held")
    return state.join(held, "name", "full").select("name", "status", "n_runs", "update_required", "n_files", "n_groups",
                                                   F.col("total").cast("bigint").alias("total"), "held")


@query("months_to_load")
def q_months_to_load(spark, sf):
    """M3 + M4 + F12 from storage: loaded months whose partition went missing,
    whose files changed, months of a run that died, and months never loaded."""
    landing, target, log = _landed(spark, sf), scratch_path(spark, "base"), scratch_path(spark, "log")
    how = ("CHEMICAL_SUBSTANCE_BNF_DESCR", "ITEMS")
    month = F.substring("name", 9, 2).cast("int")
    seen = storage.landed_months(spark, landing).withColumn("m", month)
    grp.write_grouped(reg._grouped(spark, sf).where("month % 4 != 1"), target)  # the partitions of month 1, 5 and 9 are missing
    man.append_manifest(man.ledger_rows(seen.where("m <= 10"), "first", man.INTENT, *how), log)
    done = seen.where("m <= 8").withColumn("bytes", F.when(F.col("m") == 3, F.col("bytes") - 1).otherwise(F.col("bytes")))
    man.append_manifest(man.ledger_rows(done, "first", man.COMMIT, *how), log)
    wanted = mf.month_spine(spark.createDataFrame([(y,) for y in _years(spark, sf)], "year int"))
    todo = jobs.months_to_load(wanted, man.load_manifest(spark, log, LEDGER), storage.table_months(spark, target),
                               storage.landed_months(spark, landing))
    return todo.select("name", "landed", "reason")


def _archives(spark, sf):
    """Names whose archive is landed: all but those of month 4."""
    names = fx.catalogue_months(spark, sf).where("m != 4").select(F.concat(F.lit("EPD_"), "YEAR_MONTH").alias("name"))
    return storage.landed_months(spark, fx.land_archives(spark, names, scratch_path(spark, "archives")))


@query("manifest_reconcile")
def q_manifest_reconcile(spark, sf):
    """M1 + J7 + M2 with the archives that storage holds."""
    return mf.reconcile_downloads(reg._wanted(spark, sf), fx.catalogue_resources(spark, sf), fx.download_manifest(spark, sf), _archives(spark, sf))


@query("manifest_ready")
def q_manifest_ready(spark, sf):
    """J8 + M2 with the archives that storage holds."""
    return mf.ready_to_group(fx.group_manifest(spark, sf), fx.download_manifest(spark, sf), _archives(spark, sf))


@query("manifest_pending")
def q_manifest_pending(spark, sf):
    """M3 + M4 + F12 with the partitions that storage holds: those of month 8 are missing."""
    written = storage.table_months(spark, _written(spark, sf, "month != 8"))
    return mf.pending_months(fx.catalogue_resources(spark, sf).select("name"), fx.group_manifest(spark, sf), written)


@query("manifest_log_saved")
def q_manifest_log_saved(spark, sf):
    """K6 + S12: an empty log, then two appends, read back; the latest row a name is its state."""
    path, schema = scratch_path(spark, "log"), fx.download_manifest(spark, sf).schema
    m = fx.download_manifest(spark, sf)
    before = man.load_manifest(spark, path, schema)  # nothing written yet
    man.append_manifest(before.unionByName(m), path)
    man.append_manifest(m.where("update_required").withColumn("update_required", F.lit(False))
                        .withColumn("latest_download_date", F.col("latest_download_date") + F.expr("interval 1 day")), path)
    log = man.load_manifest(spark, path, schema).withColumn("t", F.coalesce("latest_download_date", F.to_timestamp(F.lit("1970-01-01"))))
    return mf.latest_state(log, order="t").select("name", "url", F.to_date("latest_download_date").alias("downloaded"), "update_required")


# ---- written tables ------------------------------------------------------------------

@query("meds_filter_year_totals")
def q_meds_filter_year_totals(spark, sf):
    """S8 + F5 + F7 on the written base table: the year is a partition filter."""
    g = grp.read_grouped(spark, _written(spark, sf))
    return ill.medication_totals(g, reg._dim(spark, sf), tag=reg.TAG, year=reg.YEAR)


def _calendar(spark):
    """Financial years (April to March) of the months they hold: fixed values of the calendar."""
    return spark.createDataFrame([(y, m, f"{y if m >= 4 else y - 1}/{(y + 1 if m >= 4 else y) % 100:02d}") for y in range(2000, 2060) for m in range(1, 13)],
                                 "year smallint, month tinyint, period string")


@query("period_totals")
def q_period_totals(spark, sf):
    """C5/C6 over financial years: a calendar picks the months, and its join
    prunes the base table's partitions at run time."""
    g = grp.read_grouped(spark, _written(spark, sf))
    return jobs.period_totals(g, _calendar(spark), [f"{reg.YEAR}/{(reg.YEAR + 1) % 100:02d}", f"{reg.YEAR + 2}/{(reg.YEAR + 3) % 100:02d}"])


@query("map_written_by_period")
def q_map_written_by_period(spark, sf):
    """C5 (J6 + A13) from the written base table for one year."""
    g = grp.read_grouped(spark, _written(spark, sf))
    return jobs.map_practice_files(g, lk.nspl_select(fx.nspl_raw(spark, sf)), reg._dim(spark, sf), "lad", year=reg.YEAR, tag=reg.TAG)


@query("map_to_all_areas")
def q_map_to_all_areas(spark, sf):
    """Items of a tag's medicines for every area type, by practice and by postcode."""
    g = grp.read_grouped(spark, _written(spark, sf))
    meds = ill.medications(reg._dim(spark, sf), tag=reg.TAG)
    nspl, ods, out = lk.nspl_select(fx.nspl_raw(spark, sf)), lk.ods_select(fx.ods_raw(spark, sf)), None
    for t in (*PRACTICE_AREA_TYPES, *POSTCODE_AREA_TYPES):
        one = ar.area_totals(g, ods if t in PRACTICE_AREA_TYPES else nspl, t, meds)
        out = one if out is None else out.unionByName(one)
    return out


@query("area_aggregated_saved")
def q_area_aggregated_saved(spark, sf):
    """C4 + K5: the area means, written and read back."""
    path = scratch_path(spark, "aggregated")
    jobs.aggregate_job(reg._pindex_geo(spark, sf), reg._areas_e(spark, sf), reg.AREA_COL, reg._index_spec(), path)
    return rounded(spark.read.parquet(path))


@query("illness_dim_saved")
def q_illness_dim_saved(spark, sf):
    """K7 + S11: the dimension, saved and loaded."""
    path = scratch_path(spark, "dimension")
    ill.save_dimension(reg._dim(spark, sf), path)
    f = ill.flat_dimension(ill.load_dimension(spark, path))
    return f.select("illness", F.array_join(F.array_sort("tags"), ",").alias("tags"), "medication")


# ---- matching many names ---------------------------------------------------------------

@query("illness_item_flags_exact")
def q_illness_item_flags_exact(spark, sf):
    """P9 in exact mode (D11): the medicine equals one of the illness's names."""
    flagged = ill.flag_items_exact(reg._epd(spark, sf), reg._dim(spark, sf), reg._spec())
    return flagged.groupBy("PRACTICE_CODE", "YEAR_MONTH").agg(*[F.sum(s.column).alias(s.column) for s in reg._spec()])


@query("illness_item_flags_automaton")
def q_illness_item_flags_automaton(spark, sf):
    """P9 over every full medicine name of its illness, matched in one pass a text."""
    names = {r.illness: tuple(sorted(m.name for m in r.medications)) for r in reg._dim(spark, sf).collect()}  # the dimension is configuration
    spec = [ill.IllnessSpec(s.illness, s.tags, names.get(s.illness, ())) for s in reg._spec()]
    flagged = ill.flag_items_automaton(reg._epd(spark, sf), spec)
    return flagged.groupBy("PRACTICE_CODE", "YEAR_MONTH").agg(*[F.sum(s.column).alias(s.column) for s in spec])


# ---- vintages ----------------------------------------------------------------------------

@query("vintage_check")
def q_vintage_check(spark, sf):
    """The data's years against the vintages of the geographies in use."""
    vintages = spark.createDataFrame(fx.AREA_VINTAGES, VINTAGES)
    years = fx.catalogue_months(spark, sf).select(F.col("y").alias("year")).distinct()
    used = vintages.select("area_type", "vintage").union(spark.createDataFrame([("ward", "1999")], "area_type string, vintage string"))
    uses = years.select("year", F.explode(F.array(*[F.struct(F.lit(r.area_type).alias("area_type"), F.lit(r.vintage).alias("vintage"))
                                                    for r in used.collect()])).alias("u")).select("u.*", "year")  # a fixed handful
    return vintage_check(uses, vintages)


@query("vintage_rejects")
def q_vintage_rejects(spark, sf):
    """X4 applied: the reject list of the practice years that a 2021 geography does not fit."""
    epd = reg._epd(spark, sf).withColumn("YEAR", F.substring("YEAR_MONTH", 1, 4))
    uses = epd.select(F.lit("msoa").alias("area_type"), F.lit(fx.LATE_VINTAGE).alias("vintage"), F.col("YEAR").alias("year")).distinct()
    checked = vintage_check(uses, spark.createDataFrame(fx.AREA_VINTAGES, VINTAGES))
    kept, rejects = keep_fitting_years(epd, checked, "YEAR", "msoa", fx.LATE_VINTAGE)
    fits = kept.groupBy(F.col("YEAR").cast("int").alias("year")).agg(F.count("*").alias("n_rows"))
    return rejects.unionByName(fits.select("year", F.lit("fits").alias("reason"), F.lit(fx.LATE_VINTAGE).alias("fitting"), "n_rows"))


# ---- projection, percentiles -----------------------------------------------------------------

@query("practice_points_back")
def q_practice_points_back(spark, sf):
    """P18 both ways: the positions that come back from the grid, and whether they are within a millimetre."""
    codes = reg._epd(spark, sf).select("PRACTICE_CODE", normalise_postcode("POSTCODE").alias("POSTCODE")).distinct()
    p = codes.join(lk.dedup_on_key(reg._nspl_e(spark, sf), "POSTCODE"), "POSTCODE").where(valid_point("lat", "long"))
    back = from_bng(to_bng(p.select("PRACTICE_CODE", "POSTCODE", "lat", "long")), lat="lat2", lon="long2")
    metres = F.hypot(F.radians(F.col("lat2") - F.col("lat")) * 6378137.0, F.radians(F.col("long2") - F.col("long")) * 6378137.0 * F.cos(F.radians("lat")))
    return back.select("PRACTICE_CODE", "POSTCODE", F.round("lat2", 7).alias("lat"), F.round("long2", 7).alias("long"), (metres < 0.001).alias("within_mm"))


@query("month_percentiles_sketched")
def q_month_percentiles_sketched(spark, sf):
    """A5, opt-in: sketches stored with each month, merged by year; whether each
    percentile's rank among all values is within the stated error."""
    spec = reg._spec()
    counts = idx.practice_month_counts(idx.flag_items(reg._epd(spark, sf), spec), spec)
    pct = idx._long(idx.illness_percent(counts, reg._index_spec()).withColumn("YEAR", F.concat("YEAR", "MONTH")), reg._index_spec(), idx.perc)
    pct = reg.materialize(pct.withColumnRenamed("YEAR", "ym"))
    path = scratch_path(spark, "sketches")
    qu.sketch_values(pct, ["ym", "illness"], "value").write.partitionBy("ym").parquet(path)
    stored = spark.read.parquet(path).withColumn("YEAR", F.substring(F.col("ym").cast("string"), 1, 4))
    year = reg.materialize(qu.merged_sketches(stored, ["YEAR", "illness"]))
    got = qu.sketch_percentiles(year, ["YEAR", "illness"], [0.005, 0.5, 0.995]).withColumnRenamed("value", "estimate")
    ranks = pct.select(F.substring("ym", 1, 4).alias("YEAR"), "illness", "value").where("value is not null").join(F.broadcast(got), ["YEAR", "illness"])
    r = ranks.groupBy("YEAR", "illness", "p").agg(F.count("*").alias("n"), F.avg((F.col("value") < F.col("estimate")).cast("int")).alias("below"),
                                                  F.avg((F.col("value") <= F.col("estimate")).cast("int")).alias("upto"))
    e = qu.SKETCH_RANK_ERROR
    return r.select("YEAR", "illness", "p", "n", ((F.col("below") <= F.col("p") + e) & (F.col("upto") >= F.col("p") - e)).alias("within"))


# ---- geometry -----------------------------------------------------------------------------------

@query("practice_area_distance_all")
def q_practice_area_distance_all(spark, sf):
    """J4 whole: every area's distance to every practice."""
    return rounded(knn.all_distances(reg._targets(spark, sf), fx.practice_xy(spark, sf).where(valid_point()), "PRACTICE_CODE"))


@query("area_neighbours_mixed")
def q_area_neighbours_mixed(spark, sf):
    """J5 over areas from 50 m to 1000 km."""
    return adj.neighbour_pairs(fx.mixed_areas(spark, sf))


@query("area_neighbours_updated")
def q_area_neighbours_updated(spark, sf):
    """J5 kept up to date: pairs stored for one set of areas; two of them
    change, one goes, one comes; only what lies near is joined again."""
    before = fx.mixed_areas(spark, sf)
    digests, pairs = scratch_path(spark, "digests"), scratch_path(spark, "pairs")
    adj.boundary_digests(before).write.parquet(digests)
    adj.neighbour_pairs(before).write.parquet(pairs)
    return adj.update_pairs(fx.mixed_areas(spark, sf, changed=True), spark.read.parquet(digests), spark.read.parquet(pairs))
