"""Stage tables in the folder that driver and executors share."""

from __future__ import annotations

import hashlib
import json
import platform
import tempfile
import uuid
from dataclasses import asdict
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .config import Settings


def importable(spark: SparkSession) -> None:
    """Python workers find this package, wherever the driver was started."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only in local mode, where driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="stages-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back: cuts the lineage and outlives executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settings_key(settings: Settings) -> str:
    """A short digest of the settings, so that stage tables of other settings are never taken for these."""
    return hashlib.sha256(json.dumps(asdict(settings), sort_keys=True).encode()).hexdigest()[:12]


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def listed(spark: SparkSession, path: str) -> list[tuple[str, bool, int, int]]:
    """(path, is a folder, bytes, time of change) of what lies in a folder, by path; nothing if there is no such folder."""
    if not path or not exists(spark, path):
        return []
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    return sorted((f.getPath().toString(), f.isDirectory(), f.getLen(), f.getModificationTime()) for f in found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of text on any file system that Spark writes."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def fingerprint(*inputs: DataFrame | str) -> str:
    """A digest of what a stage reads: its plan, and the names, sizes and times of the files below it."""
    seen: list = []
    for x in inputs:
        if isinstance(x, str):
            seen.append(x)
            continue
        folders = {f.rsplit("/", 1)[0] for f in x.inputFiles()}
        seen += [x.semanticHash(), sorted(row for folder in folders for row in listed(x.sparkSession, folder))]
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()[:12]


def stage(df_of, spark: SparkSession, path: str, *by: str) -> DataFrame:
    """The table at path, dealt out by the columns by, if it was committed whole, else df_of() written there first."""
    if not exists(spark, f"{path}/_SUCCESS"):
        out = df_of().write.mode("overwrite")
        (out.partitionBy(*by) if by else out).parquet(path)
    return spark.read.parquet(path)


def run_metadata(settings: Settings) -> str:
    """What a run was started with, as JSON."""
    return json.dumps({"settings": asdict(settings), "started": datetime.now(UTC).isoformat(timespec="seconds"), "platform": platform.platform(), "python": platform.python_version()}, indent=2)
