"""Session helpers shared by every operator: reading tables, and cutting lineage where the cluster says."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "corvida", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder named by spark.checkpoint.dir, so that a lost executor loses nothing.

    A folder of our own is set only in a local session that names none, as in tests; a cluster must name a shared one.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="corvida-checkpoint-"))
    return df.checkpoint(eager=True)
