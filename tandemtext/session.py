"""Session helpers and the durable scratch area.

Some operators need a result that no longer changes when an executor is lost
(row numbers, calls to an outside translator). They write it once as Parquet
below the shared folder named by ``spark.checkpoint.dir`` and go on from the
written table, so nothing upstream of it is ever run again.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and single-machine runs; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tandemtext")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    ``spark.checkpoint.dir`` decides. Only a local master may run without it;
    it then gets a folder of its own for the life of the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tandemtext-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that were written below the scratch folder inside the block when it ends.

    Write or collect the result inside: afterwards its intermediate tables are gone.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Spark 4.1 has it, others ignore it.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside the block go when it is written, not when the driver collects garbage.

    Nobody reads them again: every write plans its own exchanges, and later steps read the written table.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet, with the writer's ``options``, and return the written table.

    Columnar on purpose: later steps read back only the columns they use.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
