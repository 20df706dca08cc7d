import os
from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stratum.operators.unions import union_by_name
from stratum.session import scratch_path
from stratum.sources import tables
from stratum.sources.bronze import (
    expired_partitions,
    ingest,
    land,
    results_frame,
    retained_partitions,
    stamp,
)
from stratum.sources.registry import SourceSpec
from stratum.streaming import land_new_files
from stratum.streaming import landing as landing_module
from tests.conftest import plan_of, rows

DAY_1, DAY_2 = datetime(2020, 1, 1, 6), datetime(2020, 1, 2, 6)


def test_overwrite_counts_rows_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.overwrite_table(spark.range(5), path) == 5
    assert tables.overwrite_table(spark.range(3).withColumn("x", F.lit(1)), path) == 3
    assert tables.read_table(spark, path).columns == ["id", "x"]
    assert os.listdir(tmp_path) == ["t"]


def test_overwrite_of_the_table_being_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(10).withColumn("p", F.col("id") % 2), path, "p")
    assert tables.overwrite_table(tables.read_table(spark, path).filter("id > 6"), path, "p") == 3
    assert rows(tables.read_table(spark, path)) == [(7, 1), (8, 0), (9, 1)]


def test_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(4), path)
    broken = spark.range(4).select(F.when(F.col("id") > 2, F.raise_error(F.lit("boom"))).alias("id"))
    with pytest.raises(Exception, match="boom"):
        tables.overwrite_table(broken, path)
    assert tables.read_table(spark, path).count() == 4
    assert os.listdir(tmp_path) == ["t"]


def test_table_moved_away_by_a_lost_driver_comes_back(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(4), path)
    os.rename(path, tables._sibling(path, "retired"))
    assert tables.table_exists(spark, path)
    assert tables.read_table(spark, path).count() == 4
    os.rename(path, tables._sibling(path, "retired"))
    assert tables.overwrite_table(spark.range(2), path) == 2
    assert os.listdir(tmp_path) == ["t"]
    assert not tables.table_exists(spark, str(tmp_path / "other"))
    os.rename(path, tables._sibling(f"{path}_longer", "retired"))
    assert not tables.table_exists(spark, path)
    assert tables.table_exists(spark, f"{path}_longer")


def test_versions_left_by_a_lost_driver_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(9).write.parquet(tables._sibling(path, "retired"))
    tables.overwrite_table(spark.range(4), path)
    assert tables.read_table(spark, path).count() == 4
    assert os.listdir(tmp_path) == ["t"]


def test_empty_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.overwrite_table(spark.range(5).filter("id < 0"), path) == 0
    assert tables.read_table(spark, path).count() == 0


def test_rows_are_counted_behind_the_rebalancing_shuffle(spark):
    written = tables.written_rows(spark.range(10).withColumn("p", F.lit(1)), Observation(), "p")
    plan = plan_of(written)
    assert 0 < plan.index("CollectMetrics") < plan.index("REBALANCE_PARTITIONS_BY_COL")


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "t"
    hot = F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1)
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 60_000, 1, 8).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
        assert tables.overwrite_table(df.withColumn("p", hot), str(path), "p") == 60_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = {
        folder.name: len(list(folder.glob("*.parquet"))) for folder in path.iterdir() if folder.is_dir()
    }
    assert files.pop("p=-1") > 4
    assert sum(files.values()) <= 2 * len(files)


def test_load_table_files(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.load_table_files(spark, path)
    os.makedirs(path)
    with pytest.raises(FileNotFoundError):
        tables.load_table_files(spark, path)
    spark.range(2).write.parquet(f"{path}/day=2020-01-01")
    spark.range(1).withColumn("x", F.lit("new")).write.parquet(f"{path}/day=2020-01-02")
    assert rows(tables.load_table_files(spark, path)) == [
        (0, "new", date(2020, 1, 2)), (0, None, date(2020, 1, 1)), (1, None, date(2020, 1, 1)),
    ]
    nested = str(tmp_path / "n")
    spark.range(2).write.parquet(f"{nested}/a/b")
    assert tables.load_table_files(spark, nested, recursive=True).count() == 2


def test_source_table_and_materialisations(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver_layer")
    spark.range(3).write.mode("overwrite").saveAsTable("silver_layer.numbers")
    assert tables.source_table(spark, "silver_layer", "numbers").count() == 3
    df = spark.range(2)
    assert tables.materialize(df, "m", "ephemeral") is df
    assert tables.materialize(df, "m_view", "view").count() == 2
    assert spark.table("m_view").count() == 2
    assert tables.materialize(df, "m", "table", str(tmp_path / "m")).count() == 2
    with pytest.raises(ValueError):
        tables.materialize(df, "m", "table")
    with pytest.raises(ValueError):
        tables.materialize(df, "m", "incremental")


def test_export(spark, tmp_path):
    out = str(tmp_path / "out")
    tables.export_table(spark.range(3), "parquet", {"path": out}, "numbers")
    tables.export_table(spark.range(2), "parquet", {"path": out}, "numbers")
    assert spark.read.parquet(out).count() == 2


def test_stamp_uses_one_batch_time(spark):
    got = stamp(spark.range(2), "src", "2020-01-01 06:00:00").collect()
    assert {(r._ingested_at, r._source_system) for r in got} == {(DAY_1, "src")}


def test_landing_a_day_again_replaces_only_that_day(spark, tmp_path):
    root = str(tmp_path)
    land(spark.range(3), root, "s", DAY_1)
    land(spark.range(5), root, "s", DAY_2)
    result = land(spark.range(1), root, "s", DAY_1)
    assert (result.row_count, result.status) == (1, "success")
    assert result.landed_path.endswith("/s/ingest_date=2020-01-01")
    counts = tables.read_table(spark, f"{root}/s").groupBy("ingest_date").count()
    assert rows(counts) == [(date(2020, 1, 1), 1), (date(2020, 1, 2), 5)]


def test_landing_an_empty_day_replaces_it_too(spark, tmp_path):
    land(spark.range(3), str(tmp_path), "s", DAY_1)
    land(spark.range(3).filter("id < 0"), str(tmp_path), "s", DAY_1)
    assert tables.read_table(spark, f"{tmp_path}/s").count() == 0


def test_ingest_reports_failures_and_skips_unknown_types(spark, tmp_path):
    landing = tmp_path / "a.csv"
    landing.write_text("a,b\n1,2\n3,4\n", encoding="utf-8")
    specs = [
        SourceSpec("bad", "flat_file", str(tmp_path / "missing.csv")),
        SourceSpec("odd", "queue"),
        SourceSpec("xml", "flat_file", str(landing), "xml"),
        SourceSpec("env", "database", connection_string="${STRATUM_UNSET}", query="q"),
        SourceSpec("good", "flat_file", str(landing)),
    ]
    results = ingest(spark, specs, str(tmp_path / "bronze"), DAY_1)
    got = rows(results_frame(spark, results).select("source_name", "row_count", "status"))
    assert got == [
        ("bad", 0, "failed"), ("env", 0, "failed"), ("good", 2, "success"), ("xml", 0, "failed"),
    ]
    stored = tables.read_table(spark, str(tmp_path / "bronze/good")).first()
    assert (stored._source_system, stored._ingested_at) == ("good", DAY_1)


def test_retention_reads_only_expired_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.date_sub(F.lit("2020-04-30").cast("date"), F.col("id").cast("int"))
    days = spark.range(100).select("id", day.alias("ingest_date"))
    days.write.partitionBy("ingest_date").parquet(path)
    table = tables.read_table(spark, path)
    expired = expired_partitions(table, "2020-04-30", 90)
    assert expired.count() == 9
    assert retained_partitions(table, "2020-04-30", 90).count() == 91
    assert "PartitionFilters: [isnotnull(ingest_date" in plan_of(expired)


def test_union_by_name(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(union_by_name(left, right, left)) == [(1, "x", None), (1, "x", None), (None, "y", 2.0)]


def test_scratch_is_below_the_configured_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch_path(spark, "x")


def test_stream_lands_only_new_files(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    spec = SourceSpec("s", "flat_file", str(landing), schema="a string, b bigint")
    root, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "state")
    (landing / "1.csv").write_text("a,b\n1,2\n3,4\n", encoding="utf-8")
    assert land_new_files(spark, spec, root, checkpoint) == 2
    assert land_new_files(spark, spec, root, checkpoint) == 0
    (landing / "2.csv").write_text("a,b\nNA,x\n", encoding="utf-8")
    assert land_new_files(spark, spec, root, checkpoint) == 1
    landed = tables.read_table(spark, f"{root}/s")
    assert rows(landed.select("a", "b", "_source_system")) == [
        ("1", 2, "s"), ("3", 4, "s"), (None, None, "s"),
    ]
    assert "ingest_date" in landed.columns
    with pytest.raises(ValueError, match="needs a schema"):
        land_new_files(spark, SourceSpec("s", "flat_file", str(landing)), root, checkpoint)


@pytest.mark.parametrize("lines", ["true", "false"])
def test_stream_of_json(spark, tmp_path, lines):
    landing = tmp_path / "in"
    landing.mkdir()
    records = ['{"a": 1}', '{"a": 2}']
    text = "\n".join(records) if lines == "true" else f"[{', '.join(records)}]"
    (landing / "1.json").write_text(text, encoding="utf-8")
    spec = SourceSpec("s", "flat_file", str(landing), "json", "a bigint", options={"lines": lines})
    land_new_files(spark, spec, str(tmp_path / "bronze"), str(tmp_path / "state"))
    landed = tables.read_table(spark, f"{tmp_path}/bronze/s")
    assert rows(landed.select("a")) == [(1,), (2,)]


def test_repeated_batch_is_neither_doubled_nor_counted_twice(spark, tmp_path, monkeypatch):
    landing = tmp_path / "in"
    landing.mkdir()
    spec = SourceSpec("s", "flat_file", str(landing), schema="a string")
    root, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "state")
    (landing / "1.csv").write_text("a\n1\n2\n", encoding="utf-8")
    store, calls = landing_module._store, []

    def lost_before_the_count(spark, path, record):
        calls.append(record)
        if "rows" in record and len(calls) == 2:
            raise OSError("the driver is gone")
        store(spark, path, record)

    monkeypatch.setattr(landing_module, "_store", lost_before_the_count)
    with pytest.raises(Exception, match="the driver is gone"):
        land_new_files(spark, spec, root, checkpoint)
    assert tables.read_table(spark, f"{root}/s").count() == 2  # written, not yet recorded
    (landing / "2.csv").write_text("a\n3\n", encoding="utf-8")
    assert land_new_files(spark, spec, root, checkpoint) == 3
    landed = tables.read_table(spark, f"{root}/s")
    assert rows(landed.select("a")) == [("1",), ("2",), ("3",)]
    ledger = landing_module.batch_ledger(spark, f"{root}/s")
    assert rows(ledger.select("batch", "rows")) == [(0, 2), (1, 1)]
    first = landed.filter("a < 3").select("_ingested_at").distinct().collect()
    assert [r[0] for r in first] == [r["loaded_at"] for r in ledger.filter("batch = 0").collect()]
    os.makedirs(f"{root}/old/_spark_metadata")
    with pytest.raises(ValueError, match="file sink"):
        land_new_files(spark, SourceSpec("old", "flat_file", str(landing), schema="a string"), root, checkpoint)
    assert landing_module.batch_ledger(spark, f"{root}/old").count() == 0
