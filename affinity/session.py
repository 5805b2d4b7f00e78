"""Spark session helpers.

The library never assumes a master, core count or scratch folder: operators
receive a ``SparkSession`` (or DataFrames) from the caller.  ``get_session`` is a
convenience for tests, the bench and notebooks.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()

#: Settings every job wants.  AQE re-plans joins and partition counts from
#: runtime sizes, so no shuffle-partition count is hard-coded for the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "affinity",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for tables that cut lineage.

    ``spark.checkpoint.dir`` names it on a cluster and is used as is.  Where it
    is unset, a private folder is made for a ``local[...]`` master only; any
    other master raises, because its executors would not share such a folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="affinity-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``checkpoint_root`` the folder of ``DataFrame.checkpoint()``."""
    path = checkpoint_root(spark)
    spark.sparkContext.setCheckpointDir(path)
    return path


def with_package(df: DataFrame) -> DataFrame:
    """``df``, after making this package importable in the Python workers of
    its application (as ``--py-files`` would), for functions run on it."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        folder = tempfile.mkdtemp(prefix="affinity-py-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        here = os.path.dirname(os.path.abspath(__file__))
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "affinity"), "zip",
                                         os.path.dirname(here), os.path.basename(here)))
        _SHIPPED.add(sc.applicationId)
    return df


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Record batches of about ``most`` bytes at most for what is written meanwhile;
    Spark's own limit, of 64 MB, is held twice in a task, and set back after."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back;
    ``options`` are those of the Parquet writer.

    The table survives lost executors, cuts lineage, and gives Spark measured
    file sizes to choose joins by.  One folder per application holds the
    tables, so it can be removed when the application has ended.
    """
    spark = df.sparkSession
    path = (f"{checkpoint_root(spark)}/affinity-{spark.sparkContext.applicationId}/"
            f"{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
