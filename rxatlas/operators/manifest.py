"""Incremental-load bookkeeping.

The manifests are tables: one row per dataset name (download, grouping),
or an append-only event log whose latest row per name is the state. The
reference's per-record Python loops become joins and ``when`` chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxatlas.functions import text as T
from rxatlas.schemas import CATALOGUE


def month_spine(years: DataFrame, year_col: str = "year") -> DataFrame:
    """V6 + P16: the twelve dataset names of each year."""
    return (years.select(F.col(year_col).cast("int").alias("year")).distinct()
            .select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
            .withColumn("name", T.dataset_name("year", "month")))


def name_parts(names: DataFrame, name: str = "name") -> DataFrame:
    """V1 + V3 (valid names only; see :func:`name_quality`)."""
    return names.select(
        name, T.date_suffix(name).alias("suffix"),
        T.name_year_text(name).alias("year_text"), T.name_year_text(name).cast("int").alias("year"),
        T.name_month_text(name).alias("month_text"), T.name_month_text(name).cast("int").alias("month"),
        T.name_date(name).alias("first_day"))


def name_quality(names: DataFrame, name: str = "name") -> DataFrame:
    """V2: split names into valid and rejected with a reason."""
    reason = T.name_rejection(name)
    return names.select(name, reason.isNull().alias("valid"), reason.alias("reason"))


def parse_catalogue(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Landed catalogue JSON -> resource rows; unsuccessful responses
    are dropped (the reference raises on them)."""
    d = docs.select(F.from_json(json_col, CATALOGUE).alias("d")).filter(F.col("d.success"))
    return d.select(F.inline("d.result.resources"))


def reconcile_downloads(wanted: DataFrame, catalogue: DataFrame, manifest: DataFrame,
                        archives: DataFrame, force_update: bool = False) -> DataFrame:
    """M1 + J7 + M2: the download state of every wanted name.

    new -> inserted from the catalogue; url changed -> url and zip url
    replaced (D6) and flagged; then anything not valid to use (no download
    date, flagged, or archive missing) or forced is flagged. Names missing
    from the catalogue come out with ``found = false`` (the error list).
    """
    c = catalogue.select("name", F.col("url").alias("c_url"), F.col("zip_url").alias("c_zip"))
    m = manifest.select("name", F.col("url").alias("m_url"), F.col("zip_url").alias("m_zip"),
                        "latest_download_date", F.col("update_required").alias("m_flag"))
    a = archives.select("name").distinct().withColumn("archive", F.lit(True))
    j = (wanted.select("name").distinct().join(c, "name", "left").join(m, "name", "left")
         .join(a, "name", "left"))
    found = F.col("c_url").isNotNull()
    is_new = found & F.col("m_url").isNull()
    changed = found & ~is_new & (F.col("m_url") != F.col("c_url"))
    url = F.when(is_new | changed, F.col("c_url")).otherwise(F.col("m_url"))
    zip_url = F.when(is_new | changed, F.col("c_zip")).otherwise(F.col("m_zip"))
    flag0 = F.when(is_new | changed, F.lit(True)).otherwise(F.coalesce("m_flag", F.lit(True)))
    has_date = F.col("latest_download_date").isNotNull() & ~is_new
    has_archive = F.coalesce("archive", F.lit(False))
    valid = has_date & ~flag0 & has_archive
    reason = (F.when(~found, F.lit("not_found")).when(is_new, F.lit("new"))
              .when(changed, F.lit("url_changed")).when(F.lit(force_update), F.lit("forced"))
              .when(~has_date, F.lit("no_download_date")).when(flag0, F.lit("flagged"))
              .when(~has_archive, F.lit("no_archive")))
    return j.select("name", found.alias("found"),
                    F.when(found, url).alias("url"), F.when(found, zip_url).alias("zip_url"),
                    F.when(found, ~valid | F.lit(force_update)).alias("update_required"),
                    reason.alias("reason"))


def valid_downloads(manifest: DataFrame, archives: DataFrame) -> DataFrame:
    """M2: names whose download is usable (date, no flag, archive present)."""
    ok = manifest.filter(F.col("latest_download_date").isNotNull() & ~F.col("update_required"))
    return ok.select("name").join(archives.select("name").distinct(), "name", "left_semi")


def valid_groups(group_manifest: DataFrame, written: DataFrame) -> DataFrame:
    """M3: names whose grouped month is usable (date, no flag, and its
    (year, month) partition present in the base table, compared as ints, D5)."""
    ok = group_manifest.filter(F.col("latest_process_date").isNotNull() & ~F.col("update_required"))
    ok = ok.select("name", T.name_year_text("name").cast("int").alias("year"),
                   T.name_month_text("name").cast("int").alias("month"))
    w = written.select(F.col("year").cast("int").alias("year"),
                       F.col("month").cast("int").alias("month")).distinct()
    return ok.join(w, ["year", "month"], "left_semi").select("name")


def ready_to_group(group_manifest: DataFrame, download_manifest: DataFrame,
                   archives: DataFrame) -> DataFrame:
    """Each grouping record with its download's validity: ready rows
    (semi-join) and the error rows a missing/invalid download raises (anti)."""
    good = valid_downloads(download_manifest, archives).withColumn("_ok", F.lit(True))
    g = group_manifest.select("name").join(good, "name", "left")
    ready = F.coalesce("_ok", F.lit(False))
    return g.select("name", ready.alias("download_valid"),
                    F.when(ready, F.lit("ready")).otherwise(F.lit("missing_download")).alias("status"))


def pending_months(wanted: DataFrame, group_manifest: DataFrame, written: DataFrame,
                   force_update: bool = False) -> DataFrame:
    """M4 + F12: wanted names still to group (anti-join with the done set)."""
    w = wanted.select("name").distinct()
    if force_update:
        return w
    return w.join(valid_groups(group_manifest, written), "name", "left_anti")


def latest_state(log: DataFrame, key: str = "name", order: str = "event_time",
                 tie_break: str | None = None) -> DataFrame:
    """K6: append-only manifest log -> latest row per name. A name's window
    holds only its own few events."""
    cols = [F.col(order).desc()] + ([F.col(tie_break).desc()] if tie_break else [])
    w = Window.partitionBy(key).orderBy(*cols)
    return log.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def lookup_staleness(lookups: DataFrame, run_date, as_of_col: str = "as_of_text",
                     months: int = 6) -> DataFrame:
    """V7 + V8: parse the as-of text and flag lookups older than ``months``."""
    d = T.as_of_date(as_of_col)
    rd = F.lit(run_date).cast("date") if not isinstance(run_date, F.Column) else run_date
    return lookups.select("*", d.alias("as_of"), T.is_stale(d, rd, months).alias("stale"))
