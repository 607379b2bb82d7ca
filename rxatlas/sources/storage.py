"""What storage holds, as relations: files of a folder, partitions of a table.

Listing is Spark's own (parallel for many paths) and reads no content, so the
manifests' "exists" (M2, M3) are joins with these instead of a question per
record.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "path string, name string, length bigint, modified timestamp"


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, name, length, modified) of every file below ``path``; no rows if there is no such folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length",
                        F.col("modificationTime").alias("modified"))


def landed_months(spark: SparkSession, path: str) -> DataFrame:
    """(name, n_files, bytes): the dataset names (``EPD_YYYYMM``) that files below ``path`` are of."""
    f = list_files(spark, path)
    name = F.regexp_extract("name", r"(EPD_\d{6})(?!\d)", 1)
    return (f.select(name.alias("name"), "length").where("name <> '' and length > 0")
            .groupBy("name").agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes")))


def table_months(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, n_files, bytes): the partitions of the base table at
    ``path`` that hold a file, whatever a manifest says."""
    f = list_files(spark, path, "*.parquet")
    part = lambda c, t: F.regexp_extract("path", rf"/{c}=(\d+)/", 1).cast(t)
    f = f.where(F.col("path").rlike(r"/year=\d+/month=\d+/[^/]+$"))
    return (f.select(part("year", "smallint").alias("year"), part("month", "tinyint").alias("month"), "length")
            .groupBy("year", "month").agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes")))


def rename_parts(spark: SparkSession, stage: str, target: str, name_of) -> list[str]:
    """Moves the part files of the one-column partitions below ``stage``
    (``column=value/part-*``) to ``target``, named by ``name_of(value, k)`` for
    the k-th file of a value. Renames only; the file system is the path's own."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(stage).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(target))
    out = []
    for folder in fs.listStatus(path(stage)):
        if not folder.isDirectory():
            continue
        value = folder.getPath().getName().split("=", 1)[1]
        parts = sorted(f.getPath().toString() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
        for k, part in enumerate(parts):
            to = path(target, name_of(value, k))
            if not fs.rename(path(part), to):
                raise OSError(f"could not move {part} to {to}")
            out.append(to.toString())
    fs.delete(path(stage), True)
    return out
