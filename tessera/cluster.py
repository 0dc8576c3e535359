"""What a cluster needs: the package on its executors, and a folder that all of them see."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once for each Spark context; a local master gets a checkpoint folder if it has none."""
    context = spark.sparkContext
    if context.master.split("[")[0] == "local":
        shared_folder(spark)
    if not getattr(context, "_tessera_shipped", False):
        folder = tempfile.mkdtemp(prefix="tessera-code-")
        package = Path(__file__).parent
        context.addPyFile(shutil.make_archive(f"{folder}/tessera", "zip", package.parent, package.name))
        context._tessera_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local master may do without and gets a temporary folder, a cluster gets an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")
