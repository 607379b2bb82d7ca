"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: AQE for runtime re-planning and skew splits,
# dynamic partition overwrite so a rewritten month replaces only its own
# partition, ANSI arithmetic (errors instead of silent nulls) and UTC.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "rxatlas", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own builder
    settings and call :func:`apply_core_conf` instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g"))
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session without the
    setting (tests, laptop runs) gets a private folder under the temp dir.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        d = tempfile.mkdtemp(prefix="rxatlas-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001  (some deployments lock core confs)
            pass
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"rxatlas-{name}-{uuid.uuid4().hex}")


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it
    back (reliable checkpoint, survives executor loss). For small derived
    tables that several later steps read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

