import os

import pytest
from pyspark.sql import functions as F

from setforge.plans.layout import compact, compaction_plan, file_list, finish_compaction, layout_report, layout_stats, read_by_folder, small_file_groups


def test_report_and_compaction(spark, tmp_path):
    path, staging, audit = (str(tmp_path / n) for n in ("data", "staging", "audit"))
    rows = spark.range(600).select("id", (F.col("id") % 2).cast("int").alias("p"))
    rows.filter("p = 0").repartition(12).write.partitionBy("p").parquet(path)
    rows.filter("p = 1").repartition(1).write.mode("append").partitionBy("p").parquet(path)
    stats = layout_stats(file_list(spark, path))
    assert {r.partition: r.files for r in stats.collect()} == {"/p=0": 12, "/p=1": 1}
    report = layout_report(stats).collect()
    assert {r.action for r in report} == {"REBUILD"} and {r["rank"] for r in report} == {1, 2}
    assert layout_report(stats, whole_dataset=True).count() == 1
    plan = compaction_plan(stats, min_files=5)
    assert [r.partition for r in plan.collect()] == ["/p=0"]
    assert compact(spark, path, plan, ["p"], staging).count() == 1  # a dry run shows the plan
    assert layout_stats(file_list(spark, path)).filter("files = 12").count() == 1
    log = compact(spark, path, plan, ["p"], staging, sort_by=["id"], dry_run=False, audit=audit).collect()
    assert [(r.files_before, r.files_after) for r in log] == [(12, 1)]
    assert spark.read.parquet(path).count() == 600
    assert spark.read.parquet(audit).count() == 1


def test_folders_of_any_name_are_found(spark, tmp_path):
    """Leading zeros, escapes and NULL name partitions like any other value; others stay untouched."""
    path, staging = str(tmp_path / "data"), str(tmp_path / "staging")
    names = ["01", "a/b", "c:d e+f%", None, "z"]
    rows = spark.createDataFrame([(i, names[i % 5]) for i in range(500)], "id long, p string")
    rows.repartition(12).write.partitionBy("p").parquet(path)
    stats = layout_stats(file_list(spark, path))
    plan = compaction_plan(stats, min_files=5).where("partition <> '/p=z'")
    log = compact(spark, path, plan, ["p"], staging, sort_by=["id"], dry_run=False).collect()
    assert len(log) == 4 and {(r.files_before, r.files_after) for r in log} == {(12, 1)}
    assert all(r.largest_after >= r.largest_before and r.mean_after > r.mean_before for r in log)
    after = {r.partition: r.files for r in layout_stats(file_list(spark, path)).collect()}
    assert sorted(after.values()) == [1, 1, 1, 1, 12] and after["/p=z"] == 12 and after["/p=01"] == 1
    back = read_by_folder(spark, path, ["p"])
    assert sorted((r.id, r.p or "") for r in back.collect()) == sorted((i, names[i % 5] or "") for i in range(500))


def test_small_files_are_merged_and_large_ones_stay(spark, tmp_path):
    path, staging = str(tmp_path / "data"), str(tmp_path / "staging")
    rows = spark.range(20000).select("id", F.md5(F.col("id").cast("string")).alias("t"), (F.col("id") % 2).cast("int").alias("p"))
    rows.where("id < 16000").repartition(1).write.partitionBy("p").parquet(path)
    rows.where("id >= 16000").repartition(8).write.mode("append").partitionBy("p").parquet(path)
    sizes = [r.bytes for r in file_list(spark, path).collect()]
    target = sorted(sizes)[-2]
    large = {r.path: os.path.getmtime(r.path.removeprefix("file:")) for r in file_list(spark, path).where(f"bytes >= {target}").collect()}
    assert len(large) == 2
    plan = compaction_plan(layout_stats(file_list(spark, path), target), min_files=2, rebuild=95)
    assert {r.action for r in plan.collect()} == {"REORGANIZE"}
    log = compact(spark, path, plan, ["p"], staging, target_bytes=target, dry_run=False).collect()
    assert [(r.files_before, r.files_after) for r in log] == [(9, 2), (9, 2)]
    left = {r.path for r in file_list(spark, path).collect()}
    assert set(large) < left and all(os.path.getmtime(f.removeprefix("file:")) == t for f, t in large.items())
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(20000))
    assert not os.path.exists(staging)


def test_broken_compaction_is_finished_by_a_second_call(spark, tmp_path):
    path, staging = str(tmp_path / "data"), str(tmp_path / "staging")
    spark.range(10).repartition(5).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(path)
    old = file_list(spark, path).select("path")
    old.write.parquet(f"{staging}/old")
    with pytest.raises(ValueError):
        finish_compaction(spark, path, staging)
    spark.read.parquet(path).coalesce(2).write.partitionBy("p").parquet(f"{staging}/new")
    # the first call broke after one new file was in place and one old one was gone
    from_new = [r.path.removeprefix("file:") for r in file_list(spark, f"{staging}/new").collect()]
    os.rename(from_new[0], f"{path}/p=1/{os.path.basename(from_new[0])}")
    os.remove(old.first().path.removeprefix("file:"))
    finish_compaction(spark, path, staging)
    assert file_list(spark, path).count() == len(from_new) and spark.read.parquet(path).count() == 10
    with pytest.raises(ValueError):
        finish_compaction(spark, path, staging)


def test_groups_by_running_sums(spark):
    files = spark.createDataFrame([("d", "/p=1", f"f{i}", b) for i, b in enumerate([6, 6, 3, 12, 9, 2, 5])] + [("d", "/p=2", "g", 1)], "dataset string, partition string, path string, bytes long")
    assert sorted((r.path, r.group) for r in small_file_groups(files, 10).collect()) == [("f0", 0), ("f1", 0), ("f2", 1), ("f4", 1), ("f5", 2), ("f6", 2)]


def test_files_of_flags(spark, tmp_path):
    from setforge.queries.core import flagged_files

    rows = spark.range(100).selectExpr("id", "CASE id % 2 WHEN 0 THEN 'a/b' ELSE 'n' END AS flag")
    flagged_files(rows, "flag", 3, str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(tuple(r) for r in got.select("id", "flag").collect()) == sorted(tuple(r) for r in rows.collect())
    assert got.select("_metadata.file_path").distinct().count() == 6
