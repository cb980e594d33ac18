"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName("shelfmark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset (local tests) is a temporary folder set for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="shelfmark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Folders written by ``stage`` in this process and not cleared yet.
_staged: list[str] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executor loss.

    The folder stays until ``clear_staged``, as what is returned reads it.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> int:
    """Delete what ``stage`` has written since the last call, at the end of a job whose results are written; the number of folders."""
    folders, _staged[:] = list(_staged), []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in folders:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(folders)
