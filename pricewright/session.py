"""Session settings and the shared folder for intermediate tables."""

import contextlib
import os
import shutil
import tempfile
import uuid
import warnings
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()
_scratches: list[list[str]] = []
_drops: Counter[str] = Counter()


def build_session(master: str | None = None, **settings) -> SparkSession:
    """A session with adaptive execution, UTC timestamps and skew handling.

    Cluster sizing (shuffle partitions, executor memory) is left to the
    caller: pass it as keyword settings with dots written as ``__``.
    """
    builder = SparkSession.builder.appName("pricewright")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in defaults.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A session of one machine that names none gets a temporary folder and a
    warning; on a cluster, whose executors could not see it, this fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="pricewright-")
        warnings.warn(f"spark.checkpoint.dir is not set: intermediate tables go to {_local_roots[app]}", stacklevel=2)
    return _local_roots[app]


def _stages(spark: SparkSession) -> str:
    return f"{stage_root(spark)}/pricewright/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A fresh path for one intermediate table of this application; with ``keep`` no ``scratch`` deletes it."""
    path = f"{_stages(spark)}/{label}-{uuid.uuid4().hex}"
    if _scratches and not keep:
        _scratches[-1].append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what the body stored; nothing may read it afterwards."""
    _scratches.append([])
    try:
        yield
    finally:
        for path in _scratches.pop():
            _delete(spark, path)


def drop_stages(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once nothing reads them."""
    _delete(spark, _stages(spark))
    _drops[spark.sparkContext.applicationId] += 1


def stage_generation(spark: SparkSession) -> tuple[str, int]:
    """Changes when the stages of an application are dropped."""
    app = spark.sparkContext.applicationId
    return app, _drops[app]


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors, and unlike a checkpoint lets later
    readers prune columns. Use before an operator that scans its input twice.
    """
    spark = df.sparkSession
    path = stage_path(spark, label, keep)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="pricewright-code-"), "pricewright"), "zip",
            os.path.dirname(package), os.path.basename(package),
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
