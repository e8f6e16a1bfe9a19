"""Session helpers: building a session, cutting lineage, shipping the package."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("gridloom")
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Only a local master (one process) without the setting, as in tests, gets a
    folder of its own, removed at exit; elsewhere a missing setting is an error,
    since a machine-local folder would not be seen by other machines.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="gridloom-checkpoint-")
            atexit.register(shutil.rmtree, folder, True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table to the shared folder and read it back.

    What follows is planned from the table alone, whose size is known, and
    recomputed from it if executors are lost.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make the package importable by the Python workers, wherever they run and whatever their folder.

    The archive is served by the driver and fetched by each executor; it is made once for a context.
    """
    sc = spark.sparkContext
    if any(f.endswith("gridloom.zip") for f in sc._python_includes):
        return
    folder = tempfile.mkdtemp(prefix="gridloom-zip-")
    stage = os.path.join(folder, "stage")
    shutil.copytree(_PACKAGE, os.path.join(stage, "gridloom"), ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(os.path.join(folder, "gridloom"), "zip", stage)
    sc.addPyFile(archive)
    shutil.rmtree(stage)


def spread(df: DataFrame, *keys: str, times: int = 4) -> DataFrame:
    """Rows over several times as many partitions as a shuffle has, which adaptive execution then leaves alone.

    For what costs much time for few bytes (comparing texts), where partitions
    put together by size would leave cores idle.
    """
    return df.repartition(times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
