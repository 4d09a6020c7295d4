"""Session, table loading and the few helpers every operator shares."""

from __future__ import annotations

import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "inkstream", cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitting session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session's spark.checkpoint.dir; a folder of our own only where that is unset and all runs on
    one machine. On a cluster without a shared folder this is an error: a machine's own folder would lose data with the machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="inkstream-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from the files: later steps survive a lost executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a table that may be broadcast when its rows are narrow (a few dozen bytes): some 20 MB in each executor.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast when a count shows at most max_rows rows; beyond that it is joined by a shuffle.

    df should be cheap to count (a checkpoint, or a small table).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def fence(df: DataFrame) -> DataFrame:
    """df unchanged, behind a generator: the optimizer neither repeats the columns' expressions above it nor pushes filters below."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session; local mode shares the driver's path."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_inkstream_shipped", False):
        return
    import shutil
    from pathlib import Path

    here = Path(__file__).resolve().parent
    made = shutil.make_archive(tempfile.mkdtemp(prefix="inkstream-") + "/inkstream", "zip", here.parent, here.name)
    sc.addPyFile(made)
    sc._inkstream_shipped = True
