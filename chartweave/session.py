"""Session factory, table loader and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "chartweave", cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings that every operator assumes (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CHARTWEAVE_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_of(df: DataFrame) -> int:
    """The optimizer's estimate of a plan's bytes; of a file scan, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, least: int = 16 << 20) -> DataFrame:
    """Rows dealt out to all cores where the input is so small (under ``least`` bytes a core) that its files would leave most of
    them idle; any larger input stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size_of(df) < least * cores else df


def _shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; in local mode a folder of our own where the session names none (as in tests), which
    is removed at the end.  Elsewhere that is an error, since a machine-local folder can't be read by another executor."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    made = tempfile.mkdtemp(prefix="chartweave-checkpoint-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, for files that are written and read again."""
    return f"{_shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex[:12]}/{name}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the cluster's ``spark.checkpoint.dir``."""
    folder, sc = _shared_folder(df.sparkSession), df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager)
