"""Tables kept in the folder that the cluster shares: each is written once, and lost executors cost no recomputation."""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Where the tables of stored() lie.
_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: A table in so many files or fewer is small enough to be dealt anew.
FEW_FILES = 4
#: Rows of a stored table that may be broadcast.
FEW_ROWS = 200_000
#: Rows that a task of spread() is given, more or less.
TASK_ROWS = 500_000


def dealt(df: DataFrame) -> DataFrame:
    """A table that comes in a few files, dealt to all cores: a file may be one task, however many cores there are. What comes
    in more files stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df._jdf.inputFiles()) <= min(FEW_FILES, cores - 1) else df


def spread(df: DataFrame, rows: int, *keys: Column | str) -> DataFrame:
    """df dealt by these keys to as many tasks as ``rows`` rows fill. What a task sorts stays the same however large the table is,
    and whatever number of partitions the session has; tasks are not joined again, as they are by their compressed size else."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); one of our own only in a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def few(df: DataFrame, most: int = FEW_ROWS) -> DataFrame:
    """A stored table as a side of a join: broadcast if it has at most ``most`` rows, else left to be shuffled."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def forget(*tables: DataFrame) -> None:
    """Delete tables of stored(), or all that something was made from, when nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in [_WRITTEN[df]] if df in _WRITTEN else {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete the files of shuffles that nothing refers to any more: Spark does so when the driver collects its garbage, which with
    enough memory it would do much later."""
    gc.collect()
    spark._jvm.System.gc()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an error if the target exists, so of two writers one succeeds."""
    source, target = spark._jvm.org.apache.hadoop.fs.Path(source), spark._jvm.org.apache.hadoop.fs.Path(target)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target) or not files.rename(source, target):
        raise ValueError(f"{target} cannot be published: it exists, or the rename failed")
