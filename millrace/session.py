"""Session helpers shared by the engine: worker import path, shared folder, written tables, spreading of few partitions."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


#: Bounds on the Arrow batches between the JVM and Python workers, so that long texts don't add up.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2048, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}
#: Python workers give Arrow's memory back between batches, and run as many native threads as an executor has cores to spare.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "RAYON_NUM_THREADS": "2"}
#: Input bytes that a task should at least have before rows are dealt out anew, a row group of the usual size, and an
#: estimate that stands for none.
SPREAD_BYTES, ROW_GROUP, UNKNOWN_BYTES = 1 << 20, 128 << 20, 1 << 50


def _bytes(spark: SparkSession, value: str) -> int:
    """A size setting in bytes, as Spark reads it (``8m``, ``64kb``, plain numbers)."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's checkout (clusters use --py-files); bound batches
    and workers' memory."""
    for key, most in BATCH.items():
        now = _bytes(spark, spark.conf.get(key))
        if not 0 < now <= most:
            spark.conf.set(key, most)
    env = spark.sparkContext.environment
    for key, value in WORKER_ENV.items():
        env.setdefault(key, value)
    have = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in have.split(":"):
        env["PYTHONPATH"] = f"{PACKAGE_ROOT}:{have}" if have else PACKAGE_ROOT


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, an own one on a local master;
    on a cluster that is an error, as executors don't see the driver's disk."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends in files that survive a lost executor."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete materialised tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        where = jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(conf).delete(where, True)


def size_of(df: DataFrame) -> int:
    """Spark's estimate of the bytes of ``df``; for a table just read, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """``df``, a table just read, dealt out to all cores where it is so small that its row groups (of ``ROW_GROUP`` bytes) may be
    fewer than these, and large enough to be worth it; otherwise as it is. A file's splits don't tell: those without the start of a
    row group are empty. Meant for before costly row-local steps. like: the same table where ``df`` is a stream of it, of which Spark
    has no estimate."""
    cores, size = df.sparkSession.sparkContext.defaultParallelism, size_of(df if like is None else like)
    wanted = min(cores, size // SPREAD_BYTES)
    return df.repartition(wanted) if wanted > 1 and size < cores * ROW_GROUP else df
