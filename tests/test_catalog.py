"""Catalog tables: whole versions for readers, days by themselves, a schema that widens."""

import os
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from stratum.sources import catalog, tables
from tests.conftest import plan_of, rows


def name_of(request):
    return f"catalog_tests.{request.node.name.replace('[', '_').replace(']', '')}"


def by_third(spark, n):
    return spark.range(n).withColumn("p", F.col("id") % 3)


def test_a_reader_always_gets_one_whole_version(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "t")
    versions = range(1, 7)
    catalog.publish_table(by_third(spark, 1000).withColumn("v", F.lit(1)), name, root, "p")
    seen, failures, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                got = spark.table(name).agg(
                    F.count(F.lit(1)), F.min("v"), F.max("v"), F.count_distinct("p")
                ).first()
            except Exception as error:  # a reader must not see a table half done
                failures.append(error)
                return
            seen.add(tuple(got))

    reader = threading.Thread(target=read)
    reader.start()
    for v in versions[1:]:
        assert catalog.publish_table(by_third(spark, 1000 * v).withColumn("v", F.lit(v)), name, root, "p") == 1000 * v
    done.set()
    reader.join()
    assert not failures
    assert seen <= {(1000 * v, v, v, 3) for v in versions} and len(seen) > 1
    assert spark.table(name).count() == 6000


def test_published_table_reads_itself_and_prunes(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "t")
    assert catalog.publish_table(by_third(spark, 30), name, root, "p") == 30
    assert catalog.publish_table(spark.table(name).filter("id >= 20"), name, root, "p") == 10
    assert tables.source_table(spark, *name.split(".")).count() == 10
    assert "PartitionFilters: [isnotnull(p" in plan_of(spark.table(name).filter("p = 1"))
    assert catalog.publish_table(spark.table(name).filter("id < 0"), name, root, "p") == 0
    assert spark.table(name).count() == 0


def test_failed_publish_leaves_the_old_version(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "t")
    catalog.publish_table(spark.range(4), name, root)
    broken = spark.range(4).select(F.when(F.col("id") > 2, F.raise_error(F.lit("boom"))).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        catalog.publish_table(broken, name, root)
    assert spark.table(name).count() == 4 and len(os.listdir(root)) == 1


def test_schema_widens_and_refuses_what_does_not_fit(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "t")
    catalog.publish_table(spark.range(2).withColumn("nothing", F.lit(None)), name, root)
    narrow = spark.range(3).select(F.col("id").cast("int").alias("ID"), F.lit("x").alias("new one"))
    catalog.publish_table(narrow, name, root)
    assert spark.table(name).dtypes == [("id", "bigint"), ("nothing", "string"), ("new one", "string")]
    assert rows(spark.table(name)) == [(0, None, "x"), (1, None, "x"), (2, None, "x")]
    with pytest.raises(ValueError, match="id is bigint"):
        catalog.publish_table(spark.range(1).select(F.lit("a").alias("id")), name, root)


def test_days_land_by_themselves_without_footers(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "src")
    day_1, day_2 = "2024-01-01", "2024-01-02"
    assert catalog.land_partition(spark.range(3), name, root, "ingest_date", day_1) == 3
    drifted = spark.range(2).withColumn("x", F.lit("new"))
    assert catalog.land_partition(drifted, name, root, "ingest_date", day_2) == 2
    assert catalog.partition_values(spark, name) == [day_1, day_2]
    assert catalog.land_partition(spark.range(5, 6), name, root, "ingest_date", day_1) == 1
    table = spark.table(name)
    assert rows(table.select("id", "x", "ingest_date")) == [
        (0, "new", date(2024, 1, 2)), (1, "new", date(2024, 1, 2)), (5, None, date(2024, 1, 1)),
    ]
    newest = catalog.newest_partition(spark, name)
    assert newest.count() == 2 and "InMemoryFileIndex(1 paths)" in plan_of(newest)
    assert catalog.land_partition(spark.range(0), name, root, "ingest_date", day_2) == 0
    assert table.sparkSession.table(name).count() == 1


def test_same_rows_as_merged_schemas(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "src")
    plain = str(tmp_path / "plain")
    days = {
        "2024-01-01": spark.range(3).withColumn("a", F.lit("x")),
        "2024-01-02": spark.range(3).withColumn("b", F.lit(2.5)),
        "2024-01-03": spark.range(2).withColumn("a", F.lit("y")).withColumn("c", F.lit(date(2024, 1, 3))),
    }
    for day, df in days.items():
        catalog.land_partition(df, name, root, "ingest_date", day)
        df.write.parquet(f"{plain}/ingest_date={day}")
    merged = tables.load_table_files(spark, plain)
    assert rows(spark.table(name).select(merged.columns)) == rows(merged)


def test_expired_partitions_go_with_their_folders(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "src")
    for day in ("2024-01-01", "2024-01-02", "2024-02-01"):
        catalog.land_partition(spark.range(2), name, root, "ingest_date", day)
    assert catalog.expire_partitions(spark, name, "2024-01-15") == ["2024-01-01", "2024-01-02"]
    assert catalog.expire_partitions(spark, name, "2024-01-15") == []
    assert os.listdir(root) == ["ingest_date=2024-02-01"] and spark.table(name).count() == 2


def test_old_versions_go_after_their_grace(spark, tmp_path, request):
    name, root = name_of(request), str(tmp_path / "t")
    for n in (1, 2, 3):
        catalog.publish_table(spark.range(n), name, root)
    assert catalog.remove_old_versions(spark, name, root) == 0
    assert catalog.remove_old_versions(spark, name, root, grace_hours=0) == 2
    assert spark.table(name).count() == 3
    name, root = f"{name}_days", str(tmp_path / "src")
    for n in (1, 2):
        catalog.land_partition(spark.range(n), name, root, "ingest_date", "2024-01-01")
    catalog.land_partition(spark.range(7), name, root, "ingest_date", "2024-01-02")
    assert catalog.remove_old_versions(spark, name, root, grace_hours=0) == 1
    assert spark.table(name).count() == 9


def test_partitions_replaced_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int"))
    tables.overwrite_table(spark.range(40).withColumn("day", F.when(F.col("id") % 4 < 3, day)), path, "day")
    untouched = set(os.listdir(f"{path}/day=2024-01-03"))
    moved = tables.read_table(spark, path).filter("day = '2024-01-01' or day is null").withColumn(
        "day", F.lit(None).cast("date")
    )
    assert tables.replace_partitions(moved, path, "day", [date(2024, 1, 1), None]) == 20
    assert rows(tables.read_table(spark, path).groupBy("day").count()) == [
        (None, 20), (date(2024, 1, 2), 10), (date(2024, 1, 3), 10),
    ]
    assert set(os.listdir(f"{path}/day=2024-01-03")) == untouched
    assert not os.path.exists(f"{path}/day=2024-01-01")


def test_newest_and_last_written_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, day in enumerate(("2024-01-03", "2024-01-01", "2024-01-02")):
        spark.range(n + 1).write.parquet(f"{path}/day={day}")
        os.utime(f"{path}/day={day}", (1000 + n, 1000 + n))
    newest = tables.newest_folder(spark, path, "day")
    assert (newest.count(), newest.first()["day"]) == (1, date(2024, 1, 3))
    last = tables.last_written_folder(spark, path, "day")
    assert (last.count(), last.first()["day"]) == (3, date(2024, 1, 2))
    assert "InMemoryFileIndex(1 paths)" in plan_of(newest)
    os.makedirs(f"{path}/day=2024-01-04")
    assert tables.newest_folder(spark, path, "day").count() == 1
    assert tables.expire_folders(spark, path, "day", "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert sorted(os.listdir(path)) == ["day=2024-01-03", "day=2024-01-04"]
    assert tables.folder_values(spark, f"{path}/absent", "day") == {}
