"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lakewarden")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


# The JVM does not compile methods over this many bytes of code; Spark then takes its split form instead.
HUGE_METHOD = "8000"


def prepare(spark: SparkSession) -> None:
    """Settings the queries rely on.

    The zone is pinned, as timestamps without zone are read as UTC when their
    epoch is taken; and wide rule sets are kept out of methods that would run
    uncompiled.
    """
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the cluster's own setting.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="lakewarden-")
    spark.conf.set(CHECKPOINT_CONF, made)
    return made


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: computed once, and safe from lost executors."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
