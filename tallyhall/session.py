"""Session settings and the shared scratch folder every job writes to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tallyhall

# Arrow kernels travel inside the task closure, so executors need no install.
cloudpickle.register_pickle_by_value(tallyhall)

_OWN_ROOTS: dict[str, str] = {}  # temporary folder of each local session without a shared one


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyhall")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYHALL_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, shared by all executors.

    Only a local-mode session may fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOTS:
        _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="tallyhall-")
    return _OWN_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so retries cannot clash."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def table_path(spark: SparkSession, table: str) -> str:
    """A fresh path for a version of a published table, beside the warehouse's own folders.

    Scratch may be cleaned at any time, so tables never live there.
    """
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{root}/_versions/{table.replace('.', '/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends here and survives lost executors.

    Parquet rather than ``checkpoint()`` so later reads still prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
