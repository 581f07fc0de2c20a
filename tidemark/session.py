"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHECKPOINT_DIR_CONF = "spark.checkpoint.dir"


def build(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings below; extra settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    Naive timestamps are read as UTC, AQE may split skewed joins and coalesce small shuffles, and
    streaming state lives in RocksDB (required by ``transformWithState``).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set(STATE_STORE_CONF, ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    return spark


_MADE: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``; it is removed when the program ends.

    A local session without that setting is its only machine, and gets a folder there.
    """
    base = spark.conf.get(CHECKPOINT_DIR_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_DIR_CONF} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    if not _MADE:
        atexit.register(remove_folders)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _MADE.append((spark, path))
    return path


def remove_folder(name: str) -> None:
    """Remove the shared folder of this name, which ends its path, if it was made here."""
    for made in [x for x in _MADE if x[1].rpartition("/")[2] == name]:
        _MADE.remove(made)
        _remove(*made)


def remove_folders() -> None:
    """Remove all shared folders made so far; what was read from them can't be read again."""
    while _MADE:
        _remove(*_MADE.pop())


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(place, True)
