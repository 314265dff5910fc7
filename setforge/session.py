"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, name: str = "setforge") -> SparkSession:
    """A session for tests and benchmarks; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder in ``spark.checkpoint.dir``; make one only for a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="setforge-checkpoint-")
    context.setCheckpointDir(folder)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the checkpoint folder that nothing uses yet."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


_made: list[str] = []
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def remove_stages(spark: SparkSession) -> None:
    """Delete all stages written so far. Call it when their results are written; frames over them are dead then."""
    for folder in _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _made.clear()


def remove_stage(df: DataFrame) -> None:
    """Delete the stage that ``cut_lineage`` returned, once all that read it is written."""
    context, name = df.sparkSession.sparkContext, {f.rpartition("/")[2]: f for f in _made}
    if (files := df.inputFiles()) and (folder := name.get(files[0].split("/")[-2])):
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        _made.remove(folder)


def cut_lineage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as a table into the checkpoint folder and go on from there.

    The folder is shared and reliable, so a lost executor loses nothing. Unlike an RDD
    checkpoint the table is columnar: later stages read only their columns, filters reach the
    scan, and the planner knows the size. Readers of one value of ``partition_by`` read its files only.
    What was shuffled to make it is deleted as soon as it is written, not at some later collection in the driver.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "stage")
    _made.append(folder)
    was = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(folder)
    finally:
        spark.conf.set(SHUFFLES_GO, was)
    return spark.read.schema(df.schema).parquet(folder)
