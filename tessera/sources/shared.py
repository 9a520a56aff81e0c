"""What driver and executors share: a folder, and this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ready(spark: SparkSession) -> None:
    """Takes the shared folder from spark.checkpoint.dir; sends the package to the executors.

    Where the setting is unset, a local master gets a folder of this machine. On a cluster that is an error: executors don't
    see each other's disks.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    if not getattr(context, "_tessera_sent", False):
        package = Path(__file__).resolve().parents[1]
        target = f"{tempfile.mkdtemp(prefix='tessera-')}/tessera_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(target)
        context._tessera_sent = True


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder, without what it was made from: read any number of times, made once."""
    ready(df.sparkSession)
    return df.checkpoint()


def spread_out(rows: DataFrame) -> DataFrame:
    """rows of a scan with fewer partitions than there are cores (one small file), dealt to all cores before a heavy expression.

    Larger tables have more partitions than cores and stay as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    ready(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
