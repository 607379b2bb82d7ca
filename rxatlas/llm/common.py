"""Helpers that the operators of this folder share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxatlas.session import ensure_checkpoint_dir

#: Rows of one Arrow batch. Texts are long; small batches keep a worker's memory bounded.
BATCH_ROWS = 1000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Session settings the Arrow operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    env = spark.sparkContext.environment  # workers find this package where the driver has it
    env["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([ROOT, *filter(None, env.get("PYTHONPATH", "").split(os.pathsep))]))
    ensure_checkpoint_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; columns that are missing are null. Any
    further columns of the input, whatever their names, are left behind."""
    have = set(df.columns)
    return df.select(*[(df[c] if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def fold(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh Parquet table in the shared folder and read
    back: cuts the lineage, and later steps survive the loss of executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rxatlas-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, key: str, n: int, seed: int = 17) -> DataFrame:
    """At most ``n`` rows, those with the smallest hash of ``key``: the same
    rows whatever the partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)
