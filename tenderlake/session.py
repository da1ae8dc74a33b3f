"""Session defaults shared by scripts, tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

_own_folder: list[str] = []


def session(app: str = "tenderlake", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the submitter's own settings win."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TENDERLAKE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    A local session without that setting gets a temporary one; elsewhere there is none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return None
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="tenderlake-"))
        atexit.register(shutil.rmtree, _own_folder[0], True)
    return f"file://{_own_folder[0]}"
