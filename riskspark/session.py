"""Session helpers: builder for local runs and the lineage-cut helper."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "riskspark") -> SparkSession:
    """Session used by tests and the bench; on a cluster pass your own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = str(partitions or int(cpus))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that wins.
    Only a local master may fall back to a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- a Connect session: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskspark-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, deleted when the session's file
    system closes."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("name a shared folder in spark.checkpoint.dir")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def cut_lineage(df: DataFrame, columnar: bool = False) -> DataFrame:
    """Cut the lineage at a fit barrier; never a local checkpoint, so the
    result survives executor loss without replaying upstream shuffles.

    Default: ``checkpoint(eager=True)`` into the shared checkpoint folder
    (fastest to write; re-reads are whole rows).  ``columnar=True`` writes a
    Parquet table under the same folder instead, for inputs that later
    actions read only a few columns of (pruning + pushdown on re-read).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not columnar:
        return df.checkpoint(eager=True)
    path = fresh_folder(spark, "riskspark-table")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer-inference job
