"""Session helpers: one place for the engine-wide settings every builder relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the builders assume. AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed join partitions; the session time
# zone is pinned so date arithmetic does not depend on the host.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ENGINE_CONF to an existing session (runtime-settable keys only)."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sparkbook", shared: str | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters build their own. ``shared`` sets ``spark.checkpoint.dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.ansi.enabled", "true")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share, named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    return root.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once under the shared folder and read it back.

    Cuts lineage, so a lost executor does not replay the upstream plan, and lets
    several branches of one query read a small derived table in place of the facts.
    """
    path = f"{checkpoint_root(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a frame that ``materialise`` returned; anything else is left alone."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    ours = path(f"{checkpoint_root(spark)}/tables").toUri().getPath()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        at = path(folder)
        if at.getParent().toUri().getPath() == ours:
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
