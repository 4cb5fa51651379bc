"""Session helpers: local sessions for tests and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", name: str = "genomeframe") -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; only a session without one gets a folder of its own.

    A session that runs on one machine may use a temporary folder. On a cluster the folder must be shared by all
    executors, so a cluster session without the setting is refused.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    It is used where a result is read more than once and must be the same each time, and keeps an executor's loss from
    repeating the work before it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package: its source travels to the executors once a session, as an archive.

    Workers that have the package installed use their own.
    """
    sc = spark.sparkContext
    if getattr(sc, "_genomeframe_sent", False):
        return
    root = Path(__file__).resolve().parent
    # the driver serves the archive as long as the session lives, so it is not removed here
    archive = f"{tempfile.mkdtemp(prefix='spark-genomeframe-')}/genomeframe.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    sc.addPyFile(archive)
    sc._genomeframe_sent = True


def shared_folder(spark: SparkSession) -> str:
    """The path of a new folder in the shared checkpoint folder, for files that executors write and read."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Rows on at least as many partitions as there are cores, for work in Python on a small file; large scans stay as they are.

    ``df`` should be a scan: finding its number of partitions would run a shuffle before it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
