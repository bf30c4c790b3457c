"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from clickloom.files import delete

# Settings every clickloom session wants; sizes (shuffle partitions, memory) belong to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # With bounds in row groups; the default type has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_dirs: dict[str, str] = {}
_settled: ContextVar[list[str] | None] = ContextVar("settled", default=None)


def build_session(app_name: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with SESSION_CONF; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day and hour buckets are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder reachable by every executor: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="clickloom-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, so that runs never meet each other's files; deleted at the end of ``cleared``."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (kept := _settled.get()) is not None:
        kept.append(path)
    return path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it again, so that later jobs see one and the same table."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Folders made inside, those of ``settle`` and ``run_dir``, are deleted at the end.

    A job that writes its result inside leaves nothing else behind. What is computed later must not lean on them.
    """
    paths: list[str] = []
    token = _settled.set(paths)
    try:
        yield
    finally:
        _settled.reset(token)
        for path in paths:
            delete(spark, path)
