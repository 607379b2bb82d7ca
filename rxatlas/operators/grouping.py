"""The grouped monthly base table.

Grouping keeps the reference's null-key behaviour (nulls form a group) and
sums an all-null measure to 0. The hash aggregate combines map-side, so a
hot (practice, medication) key collapses before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.functions.text import month_part, strip_whitespace, year_part
from rxatlas.schemas import EPD_MEDICATION_COLUMNS, grouped_schema

MEASURES = ("ITEMS", "TOTAL_QUANTITY", "ACTUAL_COST")
GROUP_KEYS = ("practice_code", "postcode", "medication", "year", "month")


def group_month(epd: DataFrame, medication_column: str = "CHEMICAL_SUBSTANCE_BNF_DESCR",
                measure: str = "ITEMS") -> DataFrame:
    """A1/A2 (P1, P4, P6): sum one measure per practice, postcode, medication,
    year and month. The output column is ``total_items`` for every measure."""
    if medication_column not in EPD_MEDICATION_COLUMNS:
        raise ValueError(f"medication column must be one of {EPD_MEDICATION_COLUMNS}")
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    return (epd.groupBy(
        F.col("PRACTICE_CODE").alias("practice_code"),
        strip_whitespace("POSTCODE").alias("postcode"),
        F.col(medication_column).alias("medication"),
        year_part("YEAR_MONTH").alias("year"),
        month_part("YEAR_MONTH").alias("month"))
        .agg(F.coalesce(F.sum(measure), F.lit(0).cast("bigint" if measure == "ITEMS" else "double"))
             .alias("total_items")))


def write_grouped(grouped: DataFrame, path: str) -> None:
    """K1 + M5: write partitioned by year and month, sorted by medication.

    Rebalanced by month: the adaptive plan joins small months' partitions and
    splits large ones to the advisory partition size, so the number of files
    follows the data. Each file is sorted by medication (row-group statistics
    then prune it). Dynamic overwrite replaces exactly the months present in
    ``grouped``.
    """
    (grouped.hint("rebalance", "year", "month")
     .sortWithinPartitions("year", "month", "medication", "practice_code")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month").parquet(path))


def read_grouped(spark: SparkSession, path: str, measure_type: str = "bigint") -> DataFrame:
    """The base table with typed partition columns."""
    return spark.read.schema(grouped_schema(measure_type)).parquet(path)


def year_medication_totals(grouped: DataFrame, year: int | None = None) -> DataFrame:
    """C6 (F5 + A12): items per medication; a given year is a partition filter."""
    g = grouped if year is None else grouped.filter(F.col("year") == year)
    return g.groupBy("year", "medication").agg(F.sum("total_items").alias("total_items"))
