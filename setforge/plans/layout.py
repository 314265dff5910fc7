"""How well a dataset's files are laid out, and rewriting the partitions that are not.

The share of files below the target size stands for fragmentation and the number of files for
the page count; a partition folder stands for an index.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from setforge.operators.ordered import Order, rank_global
from setforge.session import cut_lineage
from setforge.sources.tables import append, remove_folder

# Bounds of the report and of the job, in percent and files.
REPORT_SKIP, REPORT_REBUILD = 5, 30
JOB_MIN, JOB_REBUILD, JOB_MIN_FILES = 15, 40, 50
REORGANIZE, REBUILD, SKIP = "REORGANIZE", "REBUILD", "SKIP"
TARGET_BYTES = 128 * 1024 * 1024


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, partition, file, bytes) of every data file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    partition = F.regexp_extract(folder, r"((?:/[^/=]+=[^/]*)+)$", 1)
    dataset = F.regexp_replace(folder, r"(/[^/=]+=[^/]*)+$", "")
    return files.select(dataset.alias("dataset"), partition.alias("partition"), "path", F.col("length").alias("bytes"))


def layout_stats(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(dataset, partition, files, bytes, small_files, largest, mean, small_percent); sizes in bytes."""
    small = F.col("bytes") < target_bytes
    stats = files.groupBy("dataset", "partition").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.count_if(small).alias("small_files"),
        F.max("bytes").alias("largest"), F.avg("bytes").alias("mean"),
    )
    return stats.withColumn("small_percent", F.round(F.col("small_files") * 100 / F.col("files"), 4))


def classify_action(percent: Column, rebuild: float, inclusive: bool, skip_to: float | None = None) -> Column:
    """REBUILD from (``inclusive``) or above the bound, else REORGANIZE; SKIP up to ``skip_to``."""
    heavy = percent >= rebuild if inclusive else percent > rebuild
    action = F.when(heavy, REBUILD).otherwise(REORGANIZE)
    return action if skip_to is None else F.when(percent <= skip_to, SKIP).otherwise(action)


def over_threshold(
    stats: DataFrame, percent: str = "small_percent", min_percent: float = 0, count: str = "files", min_count: int = 0
) -> DataFrame:
    """At least ``min_percent`` and more than ``min_count``."""
    return stats.filter((F.col(percent) >= min_percent) & (F.col(count) > min_count))


def command_text(action: Column, dataset: Column, partition: Column | None = None) -> Column:
    """The note and command a person would run, one text per row (lines end in CR LF)."""
    quoted = F.concat(F.lit("'"), F.replace(dataset, F.lit("'"), F.lit("''")), F.lit("'"))
    scope = F.lit("ALL") if partition is None else F.concat(F.lit("["), partition, F.lit("]"))
    return F.concat(F.lit("COMPACT "), scope, F.lit(" ON "), quoted, F.lit(" "), action, F.lit(";\r\n"))


def layout_report(
    stats: DataFrame,
    min_percent: float = 0,
    rebuild: float = REPORT_REBUILD,
    skip_to: float = REPORT_SKIP,
    whole_dataset: bool = False,
) -> DataFrame:
    """Ranked report with an action and its command text; ``whole_dataset`` gives one row per dataset
    with the worst partition's share."""
    kept = over_threshold(stats, min_percent=min_percent)
    if whole_dataset:
        kept = kept.groupBy("dataset").agg(
            F.lit("").alias("partition"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"),
            F.sum("small_files").alias("small_files"), F.max("largest").alias("largest"),
            (F.sum("bytes") / F.sum("files")).alias("mean"), F.max("small_percent").alias("small_percent"),
        )
    ranked = rank_global(kept, [Order("small_percent", descending=True), Order("dataset"), Order("partition")], out="rank")
    action = classify_action(F.col("small_percent"), rebuild, True, skip_to)
    text = command_text(F.col("action"), F.col("dataset"), None if whole_dataset else F.col("partition"))
    return ranked.withColumn("action", action).withColumn("command", F.when(F.col("action") != SKIP, text))


def compaction_plan(
    stats: DataFrame, min_percent: float = JOB_MIN, rebuild: float = JOB_REBUILD, min_files: int = JOB_MIN_FILES
) -> DataFrame:
    """Partitions the job takes on. A dataset without any is passed over, not the end of the run."""
    chosen = over_threshold(stats, min_percent=min_percent, min_count=min_files)
    return chosen.withColumn("action", classify_action(F.col("small_percent"), rebuild, False))


def layout_compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before and after side by side, by dataset and partition, with the largest and the mean file."""
    keys = ["dataset", "partition"]

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{c}_{suffix}") for c in ("small_percent", "files", "bytes", "largest", "mean")])

    return before.select(*keys, "action").join(side(before, "before"), keys).join(side(after, "after"), keys)


def folder_values(partition: Column, partition_by: Sequence[str]) -> list[Column]:
    """The values that a partition folder names, as text; its escapes are undone, NULL is told from text."""
    out = []
    for c in partition_by:
        text = F.regexp_extract(partition, rf"(^|/)\Q{c}\E=([^/]*)", 2)
        plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        out.append(F.when(text != "__HIVE_DEFAULT_PARTITION__", plain))
    return out


def read_by_folder(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """A dataset whose partition values are the folders' texts: ``p=01`` stays apart from ``p=1``."""
    fields = spark.read.parquet(path).schema.fields
    schema = StructType([StructField(f.name, StringType()) if f.name in partition_by else f for f in fields])
    return spark.read.schema(schema).parquet(path)


def small_file_groups(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Files below the target with the number of the new file they go into, counted per partition from 0.

    Running sums of the sizes in the order of names cut a partition's small files into stretches of about the target. A
    file that would go alone is left out. The window sees one row per file of a partition.
    """
    folder = Window.partitionBy("dataset", "partition")
    before = F.coalesce(F.sum("bytes").over(folder.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    small = files.where(F.col("bytes") < target_bytes).withColumn("group", F.floor(before / target_bytes).cast("int"))
    together = F.count(F.lit(1)).over(Window.partitionBy("dataset", "partition", "group"))
    return small.withColumn("__n", together).where("__n > 1").drop("__n")


def compact(
    spark: SparkSession,
    path: str,
    plan: DataFrame,
    partition_by: Sequence[str],
    staging: str,
    sort_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
    dry_run: bool = True,
    audit: str | None = None,
) -> DataFrame:
    """Rewrite the planned partitions of one parquet dataset and return the audit rows.

    REBUILD spreads a partition's rows over as many files as its bytes call for (so a huge partition is no
    single task) and sorts each file. REORGANIZE merges files below the target and leaves the others as they are, name and time
    included. All goes through one job into ``staging``, with the list of the files to replace; ``finish_compaction`` then
    puts the new files in place and takes the old ones away, and can be called again after a failure.
    """
    if dry_run:
        return plan
    # the plan comes from the very files the rewrite replaces, so fix it first
    plan = cut_lineage(plan)
    started = spark.sql("SELECT current_timestamp() AS t").first().t
    name = F.regexp_extract("path", "([^/]+)$", 1)
    files = cut_lineage(file_list(spark, path).join(plan.select("dataset", "partition", "action"), ["dataset", "partition"]).withColumn("name", name))
    groups = small_file_groups(files.where(F.col("action") == REORGANIZE), target_bytes)
    rebuilt = files.where(F.col("action") == REBUILD)
    old = cut_lineage(groups.select("path", "partition", "name", "group").unionByName(rebuilt.select("path", "partition", "name", F.lit(None).cast("int").alias("group"))))

    data = read_by_folder(spark, path, partition_by)
    columns = data.columns

    def of_partitions(action: str) -> DataFrame:
        """The rows of the partitions with an action; the values themselves prune the scan, one row per partition comes back."""
        values = plan.where(F.col("action") == action).select(*[v.alias(c) for v, c in zip(folder_values(F.col("partition"), partition_by), partition_by)]).distinct().collect()
        rows = data.select(*columns, F.col("_metadata.file_name").alias("__name"), F.col("_metadata.file_size").alias("__size"), F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("__row"))
        for c in partition_by:
            known = {r[c] for r in values}
            match = F.col(c).isin(sorted(known - {None}))
            rows = rows.where(match | F.col(c).isNull() if None in known else match)
        return rows

    keyed = [v.alias(f"__{c}") for v, c in zip(folder_values(F.col("partition"), partition_by), partition_by)]
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in partition_by])
    counts = plan.where(F.col("action") == REBUILD).select(*keyed, F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int").alias("__files"))
    rebuild = of_partitions(REBUILD).join(counts, same).withColumn("__file", F.pmod("__row", F.col("__files")).cast("int"))
    merge_to = old.where("group IS NOT NULL").select(*keyed, F.col("name").alias("__from"), F.col("group").alias("__file"))
    # only files below the target are opened
    merged = of_partitions(REORGANIZE).where(F.col("__size") < target_bytes).join(merge_to, same & (F.col("__name") == F.col("__from")))
    picked = rebuild.select(*columns, "__file", F.lit(True).alias("__sorted")).unionByName(merged.select(*columns, "__file", F.lit(False).alias("__sorted")))
    placed = picked.repartition(*partition_by, "__file", "__sorted")
    placed = placed.sortWithinPartitions(*partition_by, "__sorted", "__file", *[F.when(F.col("__sorted"), F.col(c)) for c in sort_by])
    placed.select(*columns).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{staging}/new")
    old.select("path").write.mode("overwrite").parquet(f"{staging}/old")
    finish_compaction(spark, path, staging)
    after = layout_stats(file_list(spark, path), target_bytes)
    log = layout_compare(plan, after).withColumns({"start_time": F.lit(started), "end_time": F.current_timestamp()})
    log = cut_lineage(log)
    if audit is not None:
        append(log, audit)
    return log


def finish_compaction(spark: SparkSession, path: str, staging: str) -> None:
    """Move the new files of ``staging`` into the dataset, then delete the files they replace, then ``staging``.

    Every step skips what is done already, so that a broken run is healed by calling this again; staging that was not
    written to its end is refused and the dataset is as it was. Until it ends readers may see rows twice, never too few.
    Only names pass through the driver.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new_path = jvm.org.apache.hadoop.fs.Path
    store = new_path(staging).getFileSystem(conf)
    if not all(store.exists(new_path(f"{staging}/{part}/_SUCCESS")) for part in ("new", "old")):
        raise ValueError(f"{staging} holds no finished compaction")
    base = store.makeQualified(new_path(f"{staging}/new")).toString()
    found = store.listFiles(new_path(base), True)
    while found.hasNext():
        file = found.next().getPath()
        if file.getName().startswith(("_", ".")):
            continue
        to = new_path(path + file.toString().removeprefix(base))
        if not store.exists(to):
            store.mkdirs(to.getParent())
            store.rename(file, to)
    for row in spark.read.parquet(f"{staging}/old").select("path").toLocalIterator():
        store.delete(new_path(row["path"]), False)
    remove_folder(spark, staging)
    spark.catalog.refreshByPath(path)
