"""SparkSession construction and cluster-safe helpers."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON objects: a repeated key keeps the last value (Python dict semantics).
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "taxorule",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.variant.allowDuplicateKeys", "spark.sql.mapKeyDedupPolicy",
              "spark.sql.session.timeZone"):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only where the session has none and its master is local (tests, a laptop) is a
    scratch folder created and registered; on a cluster a machine-local folder would be
    a different one on every node, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master.startswith("local") and not master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
    path = tempfile.mkdtemp(prefix="taxorule-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_folders: set[str] = set()


def table_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table that lives as long as the session: in the shared checkpoint
    folder, under the application's id. DataFrames may read it until the driver ends; then the
    application's folder is deleted."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/taxorule-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_delete, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def _delete(jvm, conf, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of an input with fewer splits than cores out to all cores.

    One Parquet row group or one compressed file cannot be split, so everything up to the
    first shuffle would run in one task. Inputs with a split per core or more, that is all
    large ones, are returned as they are. The split count is known from planning: no job
    runs, and nothing is copied ahead of the query.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores, *keys) if splits < cores else df


def fixed_splits(df: DataFrame) -> DataFrame:
    """A scan whose splits are those planned now, however often it runs and whatever the session's
    settings or the number of cores are by then. Nothing is read or kept."""
    spark = df.sparkSession
    rows = df._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


#: Bytes of input, as files hold them, that become one task where every word of a text becomes a row.
WORD_TASK_BYTES = 8 << 20


def word_tasks(table: DataFrame) -> int:
    """How many tasks the words of a table's texts are dealt out to: so many that the memory of one
    does not grow with the table. From the files' sizes, as planning knows them; no job runs."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(-(-size // WORD_TASK_BYTES), 1)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Queries that run inside give up their shuffle files as they end, not when the driver next
    happens to collect garbage. For writes: nothing reads a written query's shuffles again."""
    was = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, was)


def write_table(df: DataFrame, path: str, partition: str | None = None, mode: str = "errorifexists") -> None:
    """Write ``df`` as a Parquet table that takes little disk while it is written and after."""
    writer = df.write.mode(mode).option("compression", "zstd")
    with freed_shuffles(df.sparkSession):
        (writer.partitionBy(partition) if partition else writer).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Later plans start from the written copy: they stay shallow, do not recompute
    ``df``, and survive the loss of any executor (the files live in the shared folder).
    """
    spark = df.sparkSession
    path = table_path(spark, "table")
    write_table(df, path)
    return spark.read.parquet(path)
