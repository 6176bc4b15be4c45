"""Spark session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from typing import Optional

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; everything else is left to the cluster config.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: Optional[str] = None, app: str = "wordtide",
              shuffle_partitions: Optional[int] = None,
              extra: Optional[dict] = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so on a cluster the submit-time master wins.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> Optional[str]:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # unset
        return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, fallback: Optional[str] = None) -> str:
    """Use the session's ``spark.checkpoint.dir``; set ``fallback`` only where it is unset (tests)."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder as fallback")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only a local master may run without it; then a temporary folder is set.
    """
    if not checkpoint_dir(spark):
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="wordtide-shared-"))
    return ensure_checkpoint_dir(spark)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again; deleted when the driver ends.

    Cuts lineage, survives lost executors, and gives later plans one narrow scan with a
    known size instead of the chain that made it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


class Stages:
    """``stage`` that remembers its folders, so a job can delete them when its results are stored."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        while self.paths:
            drop_path(self.spark, self.paths.pop())


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop file system that ``path`` belongs to."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files in a folder."""
    fs, p = _file_system(spark, path)
    return fs.getContentSummary(p).getLength()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; empty when the folder is not there."""
    if not path_exists(spark, path):
        return []
    fs, p = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p))


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for an input volume, so every task's shuffle block fits in
    executor memory without relying on spills (e.g. 100 TB on 1000 x 16 cores).

    * splits of ``target_partition_bytes`` for scans;
    * an initial shuffle width of input / target (at least 2 x cores), which AQE
      then coalesces towards the advisory size;
    * AQE skew splitting for partitions over 4 x the median and the advisory size.
    """
    width = max(2 * total_cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
