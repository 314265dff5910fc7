"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def require_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """The parquet table at ``path``; a missing one, or one without a needed column, is named in the error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        raise FileNotFoundError(f"source table {path} does not exist")
    df = spark.read.parquet(path)
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"source table {path} has no column {', '.join(missing)}")
    return df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, staging: str, partition_by: Sequence[str], touched: Sequence[dict] = ()) -> None:
    """Overwrite the partitions ``df`` has rows for, and those in ``touched``, which may have none left.

    A touched partition without rows is dropped; all others stay as they are. ``df`` may read
    ``path`` itself, so it is written to ``staging`` first; the second write only copies finished files'
    rows and can be repeated after a failure.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(staging)
    spark = df.sparkSession
    staged = spark.read.schema(df.schema).parquet(staging)
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    text = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for values in touched:
        if staged.where(reduce(and_, [F.col(c).eqNullSafe(F.lit(values[c])) for c in partition_by])).isEmpty():
            names = [text.getPartitionPathString(c, None if values[c] is None else str(values[c])) for c in partition_by]
            remove_folder(spark, "/".join([path, *names]))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reaches; nothing happens if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Spark does not enforce keys; this looks for the first one met twice."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key {dict(zip(keys, twice[0]))}")


def write_text(spark: SparkSession, text: str, folder: str) -> str:
    """Path of a new file in ``folder`` that holds a short text, such as a schema, where all executors see it."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    return spark.read.text(folder).select("_metadata.file_path").first()[0]
