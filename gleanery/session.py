"""Session settings and the shared scratch folder every job works under."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "gleanery", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the settings the library assumes.

    ``conf`` keys use ``__`` for ``.``, e.g. ``spark__sql__shuffle__partitions="8"``.
    Cluster sizing (executors, memory, shuffle partitions) is left to the submitter.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a cluster where it is not installed."""
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gleanery-")) / "gleanery.zip"  # read by the driver alone, which serves it
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(top.rglob("*.py")):
            packed.write(file, file.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` where the cluster names one.

    Only a local-mode session without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="gleanery-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for written intermediates."""
    return f"{shared_folder(spark)}/gleanery/{label}-{uuid.uuid4().hex}"
