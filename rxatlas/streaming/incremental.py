"""C1 as a stream: landed month CSVs -> grouped base table + manifest log.

A file-source stream over the landing folder with an ``availableNow``
trigger processes whatever has landed since the last run and stops; the
stream checkpoint remembers which files are done (the job of the download
and grouping manifests' ``update_required`` flags).

An index table keeps which months each file holds. A micro-batch opens its own
new files, adds their months to the index, looks up which other files hold the
same months, and re-groups those months from these files alone: no other landed
file is opened, or needs to be there any more. The months are written with
dynamic partition overwrite (M5), so a month that arrives in several files, or
is delivered again, is still exact. Index rows are written under the batch's
number and log rows carry it (K6), so a batch that is run again after a failure
replaces its own rows and repeats its own work.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rxatlas.functions.text import dataset_name, month_part, year_part
from rxatlas.operators.grouping import group_month, write_grouped
from rxatlas.session import materialize
from rxatlas.sources.epd import SOURCE_FILE, landed_scan, read_epd_files
from rxatlas.sources.manifests import COMMIT, append_manifest, ledger_rows

#: The fixed columns of Spark's binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
INDEX = "path string, ym string, epoch bigint"


def file_index(spark: SparkSession, index_dir: str) -> DataFrame:
    """(path, ym): the months of each landed file, by the latest batch that read it."""
    try:
        log = spark.read.schema(INDEX).parquet(index_dir)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], INDEX)
    latest = F.max("epoch").over(Window.partitionBy("path"))  # a file has a few rows
    return log.withColumn("_latest", latest).where("epoch = _latest").select("path", "ym").distinct()


def touched_files(index: DataFrame, before: DataFrame, new: DataFrame) -> tuple[list[str], list[str]]:
    """The months that the files ``new`` (path) hold now or held ``before``, and all files that hold them."""
    months = index.join(new, "path", "left_semi").select("ym").union(before.join(new, "path", "left_semi").select("ym")).distinct()
    yms = sorted(r.ym for r in months.collect())
    paths = sorted(r.path for r in index.where(F.col("ym").isin(yms)).select("path").distinct().collect())
    return yms, paths


def _regroup(spark: SparkSession, target_dir: str, index_dir: str, manifest_dir: str | None, medication_column: str,
             measure: str, batch: DataFrame, epoch: int) -> None:
    new = sorted(r.path for r in batch.select("path").distinct().collect())  # newly landed month files
    if not new:
        return
    before = materialize(file_index(spark, index_dir))  # as it was before this batch's rows
    own = landed_scan(spark, new).select(F.col(SOURCE_FILE).alias("path"), F.col("YEAR_MONTH").alias("ym")).distinct()
    (own.select("path", "ym", F.lit(epoch).cast("bigint").alias("epoch")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(index_dir))
    index = file_index(spark, index_dir)
    mine = spark.read.schema(INDEX).parquet(index_dir).where(F.col("epoch") == epoch).select("path").distinct()
    yms, paths = touched_files(index, before, mine)
    if not yms:
        return
    rows = read_epd_files(spark, paths).filter(F.col("YEAR_MONTH").isin(yms))
    write_grouped(group_month(rows, medication_column, measure), target_dir)
    if manifest_dir:
        done = spark.createDataFrame([(m,) for m in yms], "ym string").select(dataset_name(year_part("ym"), month_part("ym")).alias("name"))
        append_manifest(ledger_rows(done, f"stream-{epoch}", COMMIT, medication_column, measure), manifest_dir)


def run_incremental_grouping(spark: SparkSession, landing_dir: str, target_dir: str,
                             checkpoint_location: str, manifest_dir: str | None = None,
                             medication_column: str = "CHEMICAL_SUBSTANCE_BNF_DESCR",
                             measure: str = "ITEMS", index_dir: str | None = None):
    """Process every newly landed file once, then stop. Returns the query
    (already finished). ``checkpoint_location`` must be shared storage; the file
    index is kept in ``index_dir``, beside it by default."""
    index_dir = index_dir or checkpoint_location.rstrip("/") + "-files"
    # the stream carries file names only; columns are resolved from each file's header
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.csv*").load(landing_dir))
    q = (stream.select("path").writeStream
         .foreachBatch(lambda df, epoch: _regroup(spark, target_dir, index_dir, manifest_dir, medication_column, measure, df, epoch))
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
