"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tickweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator expects.

    On a cluster pass no ``master``; shuffle width is left to AQE, which merges small partitions and
    splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return utc(spark)


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: local times are derived from UTC by the functions themselves."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for a path; there is no public way to it from Python."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything a pattern stands for, exists in whatever store it names."""
    place, files = _file_system(spark, path)
    found = files.globStatus(place)
    return found is not None and len(found) > 0


def delete_folder(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file if there is none."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        files.create(place).close()


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """The names in a folder with their modification times in milliseconds; nothing if it is absent."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return {}
    return {x.getPath().getName(): x.getModificationTime() for x in files.listStatus(place)}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Only a local master without that setting falls back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = os.path.join(tempfile.gettempdir(), "tickweave")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
