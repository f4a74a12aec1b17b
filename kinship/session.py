"""Session helpers: configuration for scale, checkpoint folder, table loading."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package expects. AQE re-plans joins and shuffle
# partition counts from runtime statistics and splits skewed partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # a selective join side prunes the large side's scan before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # broadcast only on measured sizes: no static broadcast from file-size
    # estimates; AQE converts a join to broadcast when a finished shuffle
    # stage is small
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kinship") -> SparkSession:
    """Return (or create) a session with the package's settings.

    On a cluster the master and memory come from ``spark-submit``; ``master``
    is only for local runs and tests.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("KINSHIP_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A missing setting is an error: a machine-local folder would not survive
    the loss of that machine, nor be seen by the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                           "object store) for checkpoints")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One driver parquet table, only ``columns`` of it, over all cores."""
    from kinship.operators.strategy import spread

    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    # project before any spread so that the scan reads only these
    return spread(df.select(*columns) if columns else df)
