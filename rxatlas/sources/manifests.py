"""Manifests as tables; a missing manifest reads as empty.

The grouping manifest is a log of events. A run first writes an ``intent`` for
each month it takes up, then the months' partitions, then a ``commit`` (or
``empty``, where no row was found) with what it wrote. A run that dies leaves
intents without an end: those months are open, whatever their partitions hold,
and the next run takes them up again. Writing a month replaces its partition, so
doing it twice is harmless. One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rxatlas.schemas import LEDGER

INTENT, COMMIT, EMPTY = "intent", "commit", "empty"


def load_manifest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a manifest (parquet) with its schema, or an empty frame of that
    schema when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_manifest(df: DataFrame, path: str) -> None:
    """K6: append state rows; the latest row per name is the state."""
    df.write.mode("append").parquet(path)


def ledger_rows(months: DataFrame, run_id: str, event: str, medication_column: str, measure: str) -> DataFrame:
    """LEDGER rows of one event for ``months`` (name, and any of n_files, bytes, n_groups, total)."""
    have = set(months.columns)
    given = {"record_type": F.lit("grouped_epds"),
             "group_method": F.struct(F.lit("items_by_prescription").alias("name"), F.lit(medication_column).alias("medication_to_use"),
                                      F.lit(measure).alias("aggregation_type")),
             "latest_process_date": F.current_timestamp(), "update_required": F.lit(event == INTENT),
             "run_id": F.lit(run_id), "event": F.lit(event)}
    return months.select(*[given.get(f.name, F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in LEDGER.fields])


def month_state(ledger: DataFrame) -> DataFrame:
    """(name, status, n_runs, run_id, latest_process_date, update_required,
    n_files, bytes, n_groups, total): the state the log leaves each month in.

    status is that of the month's latest run: ``committed``, ``empty``, or
    ``open`` if it never ended. Rows without an event (an older log) count as
    commits of runs of their own.
    """
    at = F.col("latest_process_date")
    rows = ledger.withColumn("event", F.coalesce("event", F.lit(COMMIT))).withColumn("run_id", F.coalesce("run_id", at.cast("string"), F.lit("")))
    ended = F.col("event") != F.lit(INTENT)
    last = lambda c: F.max_by(c, F.when(ended, at)).alias(c)
    runs = rows.groupBy("name", "run_id").agg(
        F.min(at).alias("began"), F.max(F.when(ended, at)).alias("latest_process_date"),
        *[last(c) for c in ("event", "update_required", "n_files", "bytes", "n_groups", "total")])
    w = Window.partitionBy("name").orderBy(F.col("began").desc_nulls_last(), F.col("run_id").desc())  # a month has few runs
    runs = runs.withColumn("r", F.row_number().over(w)).withColumn("n_runs", F.count("*").over(Window.partitionBy("name")))
    ends = F.col("latest_process_date").isNotNull()
    status = F.when(~ends, "open").when(F.col("event") == EMPTY, "empty").otherwise("committed")
    return runs.where("r = 1").select("name", status.alias("status"), "n_runs", "run_id", "latest_process_date",
                                      F.coalesce(F.when(ends, F.col("update_required")), F.lit(True)).alias("update_required"),
                                      "n_files", "bytes", "n_groups", "total")
