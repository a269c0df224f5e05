"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "kestrel", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run, from the input size and core count.

    Scan splits of ``target_partition_bytes``; initial shuffle partitions so that
    each holds about that much (at least 3 waves of the cores), which AQE then
    coalesces towards 128 MB; skewed partitions above 5x the median and 512 MB
    are split (skew join); AQE may broadcast a join side measured under 64 MB.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def _is_local(spark: SparkSession) -> bool:
    return (spark.sparkContext.master or "").split("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be there: executors cannot see a folder of the
    driver's machine, so without it this raises. Only a local master, where
    driver and executors are one process, gets a private folder instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def _hadoop(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist in its own store (local, HDFS, object store)?"""
    fs, hpath = _hadoop(spark, path)
    return fs.exists(hpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, hpath = _hadoop(spark, source)
    if not fs.rename(hpath, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


#: Tables written by ``materialize`` and not yet released, in order.
_MATERIALIZED: list[str] = []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into a Parquet table in the shared checkpoint folder
    and continue from that table (lineage cut, survives lost executors).

    Unlike an eager ``DataFrame.checkpoint()``, which evaluates the plan once
    for its count and again to write the checkpoint unless it is also
    persisted, the write evaluates the plan exactly once. The read uses the
    known schema, so it starts no schema-inference job.
    """
    spark = df.sparkSession
    path = shared_path(spark, "materialized", f"{label}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _MATERIALIZED.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Join sides of up to so many rows are left to Spark, which may broadcast them: ids take up to 70 bytes a row in the driver,
#: with a text beside them 140.
LOOKUP_ROWS = 500_000


def lookup(side: DataFrame, rows: int) -> DataFrame:
    """A join side of unique keys and at most ``rows`` rows. Spark decides on a broadcast, which the driver builds, by the size
    of the files; well packed columns of millions of rows pass as small. So a side of more than ``LOOKUP_ROWS`` is dealt out by key: each
    task holds its part of it, and the other side is not sorted."""
    return side if rows <= LOOKUP_ROWS else side.hint("shuffle_hash")


def at_once(spark: SparkSession, steps: dict[str, Callable]) -> dict:
    """The results of independent steps that start jobs of their own, run side by side so that one step's last tasks leave no
    core idle. All steps have ended when this returns or raises what the first failed one raised."""
    if not steps:
        return {}
    with ThreadPoolExecutor(len(steps)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
    return {name: r.result() for name, r in running.items()}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that functions and
    broadcast models can be unpickled there however the driver came to import it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="kestrel-package-"), "kestrel.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Deletes, on leaving, the tables materialized inside: for callers that have
    consumed their result by then (command line, benchmark, load)."""
    mark = len(_MATERIALIZED)
    try:
        yield
    finally:
        for path in _MATERIALIZED[mark:]:
            delete_path(spark, path)
        del _MATERIALIZED[mark:]
