"""The jobs users call, composed from the operators.

Each job takes its inputs as DataFrames or paths and its parameters as
arguments (year, area code columns, k) and writes its result where asked.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.functions.geo import to_bng, valid_point
from rxatlas.functions.text import dataset_name
from rxatlas.operators import adjacency as adj
from rxatlas.operators import area as ar
from rxatlas.operators import grouping as grp
from rxatlas.operators import illness as ill
from rxatlas.operators import index as idx
from rxatlas.operators import knn
from rxatlas.operators import manifest as mf
from rxatlas.schemas import LEDGER
from rxatlas.session import materialize
from rxatlas.sources import storage
from rxatlas.sources.epd import read_epd_csv, unpacked
from rxatlas.sources.manifests import COMMIT, EMPTY, INTENT, append_manifest, ledger_rows, load_manifest, month_state

log = logging.getLogger(__name__)


def months_to_load(wanted: DataFrame, ledger: DataFrame, written: DataFrame, landed: DataFrame,
                   force_update: bool = False) -> DataFrame:
    """M3 + M4 from storage: (name, landed, reason) of the wanted months that
    are not done.

    Done is a month whose latest run ended, whose partition (``written``: year,
    month) is there, and whose landed files (``landed``: name, n_files, bytes)
    are those that run saw. ``landed`` says whether there is a file to load.
    """
    state = month_state(ledger).select("name", "status", "update_required", F.col("n_files").alias("seen_files"), F.col("bytes").alias("seen_bytes"))
    parts = written.select(dataset_name(F.col("year"), F.col("month")).alias("name")).distinct().withColumn("partition", F.lit(True))
    files = landed.select("name", "n_files", "bytes")
    j = wanted.select("name").distinct().join(state, "name", "left").join(parts, "name", "left").join(files, "name", "left")
    other = F.col("seen_files").isNotNull() & F.col("n_files").isNotNull() & ((F.col("seen_files") != F.col("n_files")) | (F.col("seen_bytes") != F.col("bytes")))
    reason = (F.when(F.lit(force_update), "forced").when(F.col("status").isNull(), "new").when(F.col("status") == "open", "interrupted")
              .when(F.col("update_required"), "flagged").when(other, "files_changed")
              .when((F.col("status") == "committed") & F.col("partition").isNull(), "no_partition"))
    return j.select("name", F.col("n_files").isNotNull().alias("landed"), reason.alias("reason"), "n_files", "bytes").where("reason is not null")


def prepare_months(spark: SparkSession, landing_dir: str, target_dir: str, manifest_dir: str,
                   years: list[int], medication_column: str = "CHEMICAL_SUBSTANCE_BNF_DESCR",
                   measure: str = "ITEMS", overwrite: bool = False) -> DataFrame:
    """C1 (batch form): group every pending month of ``years`` in one job.

    V6 month spine -> :func:`months_to_load` against the log, the landing folder
    and the table's partitions -> intents (K6) -> one scan of those months'
    files -> A1 -> K1 with dynamic overwrite -> commits with what the written
    partitions hold. A run that died in between left its months open; they are
    taken up again here. Returns the names processed: the pending months that
    had rows; the others are logged as missing.
    """
    wanted = mf.month_spine(spark.createDataFrame([(y,) for y in years], "year int"))
    ledger = load_manifest(spark, manifest_dir, LEDGER)
    todo = months_to_load(wanted, ledger, storage.table_months(spark, target_dir), storage.landed_months(spark, landing_dir), overwrite)
    # a handful of names (<= 12 per year): fixed now, so that what this run
    # writes below cannot change what it does
    pending = sorted((tuple(r) for r in todo.collect()), key=lambda r: r[0])
    for name, is_landed, reason, *_ in pending:
        if not is_landed:
            log.warning("no file landed for %s (%s)", name, reason)
        elif reason == "interrupted":
            log.warning("taking up %s again, which an earlier run left open", name)
    todo = spark.createDataFrame([(r[0], r[3], r[4]) for r in pending if r[1]], "name string, n_files bigint, bytes bigint")
    yms = [r[0][4:] for r in pending if r[1]]
    if not yms:
        return todo.select("name")
    run_id = uuid.uuid4().hex
    begin_months(todo, manifest_dir, run_id, medication_column, measure)
    load_months(spark, landing_dir, target_dir, yms, medication_column, measure)
    return commit_months(spark, todo, target_dir, manifest_dir, run_id, medication_column, measure)


def begin_months(months: DataFrame, manifest_dir: str, run_id: str, medication_column: str, measure: str) -> None:
    append_manifest(ledger_rows(months, run_id, INTENT, medication_column, measure), manifest_dir)


def load_months(spark: SparkSession, landing_dir: str, target_dir: str, yms: list[str], medication_column: str, measure: str) -> None:
    """Group the given months (YYYYMM) and replace their partitions."""
    rows = read_epd_csv(spark, landing_dir, months=yms).filter(F.col("YEAR_MONTH").isin(yms))
    with unpacked(spark):
        grp.write_grouped(grp.group_month(rows, medication_column, measure), target_dir)


def commit_months(spark: SparkSession, months: DataFrame, target_dir: str, manifest_dir: str, run_id: str,
                  medication_column: str, measure: str) -> DataFrame:
    """Append the end of each month: what its partition holds now."""
    kind = "bigint" if measure == "ITEMS" else "double"
    parts = months.select("*", F.substring("name", 5, 4).cast("smallint").alias("year"), F.substring("name", 9, 2).cast("tinyint").alias("month"))
    held = storage.table_months(spark, target_dir).select("year", "month").join(F.broadcast(parts.select("year", "month")), ["year", "month"])
    found = spark.createDataFrame([], "year smallint, month tinyint, n_groups bigint, total double")
    if held.limit(1).count():
        table = grp.read_grouped(spark, target_dir, kind).join(F.broadcast(parts.select("year", "month")), ["year", "month"])  # <= 12 rows a year
        found = table.groupBy("year", "month").agg(F.count("*").alias("n_groups"), F.sum("total_items").cast("double").alias("total"))
    ends = materialize(parts.join(found, ["year", "month"], "left").drop("year", "month"))
    done = ends.where("n_groups is not null")
    rows = ledger_rows(done, run_id, COMMIT, medication_column, measure).unionByName(
        ledger_rows(ends.where("n_groups is null"), run_id, EMPTY, medication_column, measure))
    append_manifest(rows, manifest_dir)
    return done.select("name")


def practice_index_job(epd: DataFrame, lookup: DataFrame, out_path: str | None = None,
                       spec: list | None = None, tag: str = "Loneliness", min_items: int = 500,
                       lower_clip: float = 0.005, upper_clip: float = 0.995) -> DataFrame:
    """Practice index with geography, every year present, written
    partitioned by YEAR (K3) when ``out_path`` is given."""
    spec = spec or ill.default_spec()
    res = idx.attach_geography(
        idx.practice_index(epd, spec, ill.spec_by_tag(spec, tag), min_items, lower_clip, upper_clip), lookup)
    if out_path:
        res.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("YEAR").parquet(out_path)
    return res


def read_practice_index(spark: SparkSession, path: str, gp_col: str, boundary_col: str) -> DataFrame:
    """Re-read the saved index, renaming its area key to the boundary's."""
    return spark.read.parquet(path).withColumnRenamed(gp_col, boundary_col)


def _write_sorted(df: DataFrame, out_path: str | None) -> DataFrame:
    res = ar.order_areas(df)
    if out_path:
        res.write.mode("overwrite").parquet(out_path)   # K4/K5
    return res


def aggregate_job(index_geo: DataFrame, areas: DataFrame, area_col: str, spec: list,
                  out_path: str | None = None) -> DataFrame:
    """C4: area mean index and support per year."""
    scores = [idx.zscore(s.column) for s in spec]
    res = ar.area_mean_index(index_geo, areas, area_col, scores).select("YEAR", "code", "loneliness", "ITEMS")
    return _write_sorted(res, out_path)


def interpolate_job(index_xy: DataFrame, areas: DataFrame, k: int, threshold: float = 0.0,
                    distance_limit: float | None = None, pairs: DataFrame | None = None,
                    out_path: str | None = None) -> DataFrame:
    """IDW of the practice index at area centroids from the k nearest
    practices, LISA over adjacent areas. ``index_xy`` has YEAR, x, y and
    the index column; ``pairs`` may be a stored adjacency table."""
    c = adj.centroids(areas).select("code", F.col("cx").alias("tx"), F.col("cy").alias("ty"))
    vals = knn.interpolate(c, index_xy, ["YEAR"], idx.INDEX_COLUMN, k=k, distance_limit=distance_limit)
    spine = ar.area_year_spine(areas, ar.years_of(index_xy))
    v = materialize(spine.join(vals.withColumnRenamed("value", "loneliness"), ["YEAR", "code"], "left"))  # read by LISA twice
    pairs = pairs if pairs is not None else adj.neighbour_pairs(areas)
    res = v.join(adj.lisa(v, pairs, ["YEAR"], "loneliness", threshold), ["YEAR", "code"], "left")
    return _write_sorted(res.select("YEAR", "code", "loneliness", "LISA_score", "LISA_support"), out_path)


def interpolate_geo_job(index_geo: DataFrame, areas: DataFrame, k: int, **kw) -> DataFrame:
    """C3 from the index with geography, as :func:`practice_index_job` writes
    it: valid lat/long (F6) -> National Grid metres (P18) -> :func:`interpolate_job`.
    Practices without a valid position carry no weight."""
    placed = index_geo.filter(valid_point("lat", "long")).select("YEAR", "PRACTICE_CODE", "lat", "long", idx.INDEX_COLUMN)
    xy = materialize(to_bng(placed).filter(valid_point()))  # one row per practice and year
    return interpolate_job(xy, areas, k, **kw)


def map_practice_files(grouped: DataFrame, mapper: DataFrame, dim: DataFrame, area_type: str,
                       year: int | None = None, tag: str | None = None,
                       illness: str | None = None) -> DataFrame:
    """Items of a tag's or an illness's medicines by area (year optional:
    a partition filter on the base table)."""
    g = grouped if year is None else grouped.filter(F.col("year") == year)
    return ar.map_to_area(g, mapper, area_type, ill.medications(dim, tag, illness))


def analyst_totals(spark: SparkSession, grouped_path: str, year: int) -> DataFrame:
    """Items by medication for one year (partition-pruned scan)."""
    return grp.year_medication_totals(grp.read_grouped(spark, grouped_path), year)


def period_totals(grouped: DataFrame, calendar: DataFrame, periods: list[str]) -> DataFrame:
    """C5/C6 by period (financial year, quarter, any): (period, medication,
    n_months, total_items). ``calendar`` (year, month, period) is a table of the
    calendar, so it is broadcast, and its filter prunes the base table's
    partitions at run time."""
    months = F.broadcast(calendar.where(F.col("period").isin(periods)))  # twelve rows a year
    return grouped.join(months, ["year", "month"]).groupBy("period", "medication").agg(
        F.countDistinct("year", "month").alias("n_months"), F.sum("total_items").alias("total_items"))
