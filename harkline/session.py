"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: Catalog names of the bucketed tables in the scratch folder.
BUCKETED: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine, with a checkpoint folder of its own.

    On a cluster the caller brings a session of their own; nothing in the
    package depends on the settings below but the checkpoint folder.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("harkline")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="harkline-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by all executors.

    This is the checkpoint folder the session names in ``spark.checkpoint.dir``. A temporary folder stands
    in only where none is named in local mode, where driver and executors are one process.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if context.master.partition("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
            named = tempfile.mkdtemp(prefix="harkline-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def tables_dir(spark: SparkSession) -> str:
    """Where this session keeps its intermediate tables."""
    return f"{scratch_dir(spark)}/tables"


def release_tables(spark: SparkSession) -> None:
    """Deletes the intermediate tables of this session.

    Spark does not clear a checkpoint folder by itself. Call this once no frame
    that was built on such tables is needed any more.
    """
    while BUCKETED:
        spark.sql(f"DROP TABLE IF EXISTS {BUCKETED.pop()}")
    path = spark._jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
