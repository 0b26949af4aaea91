"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that hold for a laptop and for a large cluster alike. AQE coalesces
# the many initial shuffle partitions on small inputs and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20, minimum: int = 200) -> int:
    """Shuffle partitions that keep one reduce task near ``target_bytes``.

    100 TB at 128 MB is about 800,000 partitions of raw data; the operators
    shuffle pruned columns only, so callers pass the bytes that are shuffled.
    """
    return max(minimum, -(-int(input_bytes) // target_bytes))


def session(app_name: str, conf: dict[str, str] | None = None, shuffle_bytes: int | None = None) -> SparkSession:
    """Build (or get) a session. No master is forced: spark-submit decides.

    Connector packages and store credentials go in ``conf``
    (see :func:`object_store_conf`).
    """
    settings = dict(DEFAULT_CONF)
    if shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(shuffle_bytes))
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    packages: tuple[str, ...] = (),
) -> dict[str, str]:
    """Settings for an S3-compatible store reached by path-style addresses."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }
    if packages:
        conf["spark.jars.packages"] = ",".join(packages)
    return conf


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    ``spark.checkpoint.dir`` names it. Where that is unset, as in tests, the
    warehouse holds it: every node of a Spark application must reach that one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Paths of the tables that each open scope has to remove, innermost last.
_scopes: ContextVar[tuple[set[str], ...]] = ContextVar("scratch_scopes", default=())
# Spark then removes the shuffle files of a query when it ends, not when the driver's garbage collector finds it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, label: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a checkpoint does, but columnar: later readers prune
    columns and count rows from the footers. Within a :func:`scratch_scope` the
    table is removed when the scope ends.
    """
    path = scratch_path(df.sparkSession, label)
    scopes = _scopes.get()
    if scopes:
        scopes[-1].add(path)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that are materialized within the block at its end, also after an error.

    Only what the block itself made is removed. What it returns must be
    :func:`kept`, or not read any of its tables. Shuffle files are removed as
    soon as the query that made them has ended.
    """
    mine: set[str] = set()
    token = _scopes.set((*_scopes.get(), mine))
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        _scopes.reset(token)
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
        for path in sorted(mine):
            remove(spark, path)


def kept(table: DataFrame) -> DataFrame:
    """A materialized table that outlives the innermost scope; the next one removes it, if there is one."""
    scopes = _scopes.get()
    if scopes and table.scratch_path in scopes[-1]:
        scopes[-1].discard(table.scratch_path)
        if len(scopes) > 1:
            scopes[-2].add(table.scratch_path)
    return table


def discard(*tables: DataFrame) -> None:
    """Remove materialized tables that nothing reads any more before their scope ends."""
    for table in tables:
        for paths in _scopes.get():
            paths.discard(table.scratch_path)
        remove(table.sparkSession, table.scratch_path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of whatever store the path names, if it exists."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
