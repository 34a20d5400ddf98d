"""Session settings, and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Calendar keys and day boundaries are UTC everywhere, so the session zone must be too.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def pin(spark: SparkSession) -> SparkSession:
    """Set the runtime options every plan here relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "hearthlake", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session; cluster sizing comes from ``conf`` or spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can see, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a temporary folder; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _OWN_DIRS:
        _OWN_DIRS[application] = tempfile.mkdtemp(prefix="hearthlake-")
    return _OWN_DIRS[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, grouped by application so that an operator can expire whole runs."""
    return f"{shared_dir(spark)}/hearthlake/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


_SCRATCH = threading.local()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`materialise` writes inside the block (and thread) once it is over; nothing lazy may leave it."""
    outer = getattr(_SCRATCH, "paths", None)
    _SCRATCH.paths = []
    try:
        yield
    finally:
        written, _SCRATCH.paths = _SCRATCH.paths, outer
        for path in written:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder.getParent(), True)


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; with ``keep`` it outlives a :func:`scratch` block.

    Cuts lineage in a way that survives executor loss, and gives the optimizer the table's true size, so that joins
    against it are broadcast only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if not keep and getattr(_SCRATCH, "paths", None) is not None:
        _SCRATCH.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
