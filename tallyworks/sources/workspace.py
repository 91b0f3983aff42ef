"""Folders for written tables: hand-over between jobs and lineage cuts.

On a cluster the folder is the shared one named by `spark.checkpoint.dir`. Only a local session may
fall back to a temporary folder of the machine. Tables of an application lie below one folder of its
own; `clear` deletes that folder once its results have been read.
"""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a partition that a model is fitted on. Fits depend on how rows are dealt, so the number of partitions
#: follows from the number of rows alone, and not from the cores, the files or the session.
FIT_ROWS = 20_000
#: Partitions up to which each has so many rows. A pass of a tree fit shuffles every partition to as many others, so
#: beyond it their number grows with the square root of the rows, and the blocks of a pass with the rows.
FIT_PARTITIONS = 32


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    if folder:
        if not local:
            check_shared(spark, folder, context.applicationId)
        return folder
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyworks-"))
    return context.getCheckpointDir()


@lru_cache(maxsize=64)
def check_shared(spark: SparkSession, folder: str, application: str) -> None:
    """Raises if the folder is a plain disk folder of which every machine has its own.

    Stores that are shared by nature need no trial. For disk folders, tasks write a row each, and the
    driver has to find them all.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        return
    trial, rows = f"{folder.rstrip('/')}/tallyworks/{application}/trial-{uuid.uuid4().hex}", 16
    try:
        spark.range(0, rows, 1, rows).write.parquet(trial)
        found = spark.read.schema("id long").parquet(trial).count()
    except Exception as problem:
        raise RuntimeError(f"{folder} cannot be used by all executors") from problem
    if found != rows:
        raise RuntimeError(f"{folder} is not shared: {found} of {rows} trial rows came back")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the application's part of the shared folder."""
    own = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/tallyworks/{own}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; frames that still read them fail from then on."""
    own = f"{shared_folder(spark).rstrip('/')}/tallyworks/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the frame as Parquet and read it back.

    Several consumers then share one computation, and a lost executor costs a re-read of some files,
    not a replay of the plan that made them.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let the driver collect its garbage, between two steps of a long job: its heap grows by what each step leaves."""
    gc.collect()
    spark._jvm.System.gc()


def released_everywhere(spark: SparkSession) -> None:
    """The same, and on the executors: their heaps stay as large as the largest step has made them until a full
    collection, and later steps need the room for their Python workers.

    A task for each core collects; Spark deals them to all executors that are idle, as between two steps they are.
    """
    released(spark)
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        cores = context.defaultParallelism
        spark.range(0, cores, 1, cores).select(F.expr("reflect('java.lang.System', 'gc')")).collect()


def spread(stored: DataFrame) -> DataFrame:
    """A frame read from files, over at least as many partitions as there are cores.

    For work whose result does not depend on partitions and costs far more than a shuffle of its input.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return stored if stored.rdd.getNumPartitions() >= cores else stored.repartition(cores)


def placed(df: DataFrame, *keys: str) -> DataFrame:
    """The rows in a place that depends on their content only: the partition by a hash of the keys (all
    columns without any), the order within it by them. Fits then give the same model on any cluster."""
    chosen = keys or df.columns
    return df.repartition(fit_partitions(df.count()), *chosen).sortWithinPartitions(*chosen)


def fit_partitions(rows: int) -> int:
    """One for every FIT_ROWS up to FIT_PARTITIONS, then as many as keep their square in proportion to the rows."""
    full = -(-rows // FIT_ROWS) or 1
    return full if full <= FIT_PARTITIONS else math.isqrt(full * FIT_PARTITIONS)
