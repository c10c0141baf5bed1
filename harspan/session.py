"""Session helpers shared by every operator: table reading, checkpoints and bounded collects."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``directory``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers once per application, unless they find it on their ``PYTHONPATH``."""
    root = Path(__file__).resolve().parents[1]
    application = spark.sparkContext.applicationId
    if application in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    target = Path(tempfile.mkdtemp(prefix="harspan-package-")) / "harspan.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(Path(__file__).resolve().parent.rglob("*.py")):
            out.write(path, path.relative_to(root).as_posix())
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(application)


def local_session(name: str = "harspan", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and the command line; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for ``checkpoint()``: the one that the session names, else (local mode only) a temporary one.

    A cluster without ``spark.checkpoint.dir`` is an error: a folder of one machine would not outlive its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="harspan-checkpoint-")
    context.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that later stages neither recompute it nor need its executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def collect_bounded(df: DataFrame, bound: int, what: str) -> list:
    """The rows of a table that must be small; more than ``bound`` rows is an error, never a silent cut."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows; it is meant to be a small table")
    return rows
