from datetime import date

import pytest
from conftest import as_dicts, at, day, plan_of
from pyspark.sql import functions as F

from appkpi.operators import keep_latest
from appkpi.plans.build import refresh
from appkpi.plans.catalog import TABLES, raw_name
from appkpi.plans.contracts import CONTRACTS
from appkpi.session import require_utc
from appkpi.sources import Load, land, publish_view, read_csv_report, read_raw, read_table, write_table
from appkpi.sources.landing import METADATA, append_raw, stamp
from appkpi.sources.versions import newest_version, read_version
from appkpi.streaming import checkpoint_folder, stream_csv_to_raw, stream_latest

# ---- tables ----


def test_partitioned_table_comes_back_whole_and_is_read_pruned(spark, folder):
    df = spark.range(1000).select(
        F.when(F.col("id") > 0, F.date_add(F.lit(day(1)), (F.col("id") % 5).cast("int"))).alias("d"),
        (F.col("id") % 7).alias("k"),
        "id",
    )
    write_table(df, folder, "d", ["k"])
    write_table(df, folder, "d", ["k"])  # a full refresh replaces
    back = read_table(spark, folder, df.schema)
    assert back.dtypes == df.dtypes
    assert as_dicts(back) == as_dicts(df)
    two_days = read_table(spark, folder, df.schema, "d", day(2), day(3)).filter("k = 3")
    plan = plan_of(two_days.select("id"))
    assert "PartitionFilters: [isnotnull(d" in plan and "PushedFilters: [IsNotNull(k)" in plan
    assert "ReadSchema: struct<k:bigint,id:bigint>" in plan
    assert two_days.count() == df.filter("k = 3 AND d BETWEEN '2026-06-02' AND '2026-06-03'").count()


def test_unpartitioned_table(spark, folder):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    write_table(df, folder, cluster_by=["k"])
    assert as_dicts(read_table(spark, folder)) == as_dicts(df)


def test_a_day_with_most_rows_is_not_one_task(spark, folder):
    """Rebalancing splits the hot day once it is larger than the advisory size."""
    keys = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    }
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, F.lit(day(1)))
            .otherwise(F.date_add(F.lit(day(2)), (F.col("id") % 9).cast("int")))
            .alias("d"),
            F.xxhash64("id").alias("v"),
        )
        write_table(df, folder, "d")
        files = spark.read.parquet(folder).filter(F.col("d") == F.lit(day(1))).inputFiles()
        hot = [f for f in files if "d=2026-06-01" in f]
        assert len(hot) > 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_raw_table_is_append_only_by_load_day(spark, folder):
    df = spark.createDataFrame([("x",)], "a string")
    for n in (1, 2):
        load = Load("s", day(1), day(1), ingested_at=at(n, 23))
        assert append_raw(stamp(df, load), folder) == 1
    assert read_raw(spark, folder).count() == 2
    newer = read_raw(spark, folder, ingested_from=day(2))
    assert newer.count() == 1 and "_ingest_date" not in newer.columns


def test_view(spark):
    publish_view(spark.range(3), "three")
    assert spark.sql("SELECT count(*) AS n FROM three").first()["n"] == 3


def test_days_are_only_cut_in_utc(spark):
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        with pytest.raises(ValueError, match="Asia/Jakarta"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# ---- streams ----


def test_new_files_are_landed_once(spark, tmp_path, folder):
    incoming = tmp_path / "in"
    incoming.mkdir()
    load = Load("s", day(1), day(2), "app", "ios")

    def run():
        stream_csv_to_raw(
            spark, str(incoming), ["Id", "Name"], folder, load, f"{folder}-cp"
        ).awaitTermination()
        return as_dicts(read_raw(spark, folder), "Id")

    (incoming / "1.csv").write_text('Id,Name\n1,"a\nb"\n2,\n')
    assert [(r["Id"], r["Name"], r["_platform"]) for r in run()] == [
        ("1", "a\nb", "ios"), ("2", "", "ios")
    ]
    (incoming / "2.csv").write_text("Id,Name\n3,c\n")
    assert [r["Id"] for r in run()] == ["1", "2", "3"]
    assert [r["Id"] for r in run()] == ["1", "2", "3"]


def test_a_repeated_batch_replaces_what_it_had_landed(spark, tmp_path, folder):
    incoming, progress = tmp_path / "in", tmp_path / "progress"
    incoming.mkdir()
    load = Load("s", day(1), day(2))

    def run():
        stream_csv_to_raw(spark, str(incoming), ["Id"], folder, load, str(progress)).awaitTermination()
        return as_dicts(spark.read.parquet(folder), "Id")

    (incoming / "1.csv").write_text("Id\n1\n2\n")
    first = run()
    # As if the run had stopped before it noted that the batch is done.
    for mark in ("0", ".0.crc"):
        (progress / "commits" / mark).unlink(missing_ok=True)
    (incoming / "2.csv").write_text("Id\n3\n")
    again = run()
    assert again[:2] == first and [r["Id"] for r in again] == ["1", "2", "3"]


def test_ties_settle_alike_in_streamed_and_landed_tables(spark, tmp_path, folder):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "1.csv").write_text("k,v\na,9\na,1\na,5\n,2\n,1\n")
    load = Load("s", day(1), day(2))
    stream_csv_to_raw(spark, str(incoming), ["k", "v"], folder, load, f"{folder}-cp").awaitTermination()
    land(read_csv_report(spark, str(incoming)), f"{folder}-landed", load)
    found = [
        as_dicts(keep_latest(read_raw(spark, path), ["k"]).select("k", "v"), "k")
        for path in (folder, f"{folder}-landed")
    ]
    assert found[0] == found[1] == [{"k": "", "v": "1"}, {"k": "a", "v": "5"}]


def test_a_file_sinks_table_is_not_landed_into(spark, tmp_path):
    (tmp_path / "raw" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="file sink"):
        stream_csv_to_raw(spark, str(tmp_path), ["k"], str(tmp_path / "raw"), Load("s", day(1), day(2)))


SCHEMA = "k string, d date, v int, _ingested_at timestamp, _run_id string"


def fold(spark, source, path, keys, partition_by):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    stream_latest(
        rows, path, f"{path}-work", keys, partition_by=partition_by, checkpoint=f"{path}-cp"
    ).awaitTermination()


@pytest.mark.parametrize(("keys", "partition_by"), [(["k", "d"], "d"), (["k"], None)])
def test_incremental_latest_equals_the_full_one(spark, tmp_path, keys, partition_by):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    everything = []
    for n, rows in enumerate([
        [("a", day(1), 1, at(1), "r1"), ("b", day(1), 2, at(1), "r1"), ("c", None, 3, at(1), "r1")],
        [("a", day(1), 4, at(2), "r2"), ("d", day(2), 5, at(2), "r2")],
        [("b", day(1), 6, at(0 + 1, 0), "r0"), ("c", None, 7, at(3), "r3"), ("a", day(3), 8, at(3), "r3")],
    ]):
        everything += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if n != 1:  # the second and third file come in one run, in two batches
            fold(spark, source, path, keys, partition_by)
    full = keep_latest(spark.createDataFrame(everything, SCHEMA), keys)
    back = read_table(spark, path, full.schema)
    assert as_dicts(back, "k", "d") == as_dicts(full, "k", "d")


def test_a_work_folder_may_be_used_by_another_stream(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in range(2):
        source = str(tmp_path / f"in{n}")
        rows = [(f"k{n}", day(1), n, at(1 + n), "r")]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        stream_latest(
            stream, path, f"{path}-work", ["k", "d"], partition_by="d", checkpoint=f"{path}-cp{n}"
        ).awaitTermination()
    assert {r["k"] for r in spark.read.parquet(path).collect()} == {"k0", "k1"}


def test_copies_of_finished_batches_are_removed(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(3):
        rows = [(f"k{n}", day(1), n, at(1), "r")]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    fold(spark, source, path, ["k", "d"], "d")
    assert [p.name for p in (tmp_path / "out-work").glob("stream=*/batch=*")] == ["batch=2"]
    assert spark.read.parquet(path).count() == 3


def test_a_stopped_replacement_is_finished_from_its_copy(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("k", day(1), 1, at(1), "r")], SCHEMA).coalesce(1).write.parquet(source)
    fold(spark, source, path, ["k", "d"], "d")
    # As if the batch had stopped before its commit, in the middle of replacing the table.
    for commit in (tmp_path / "out-cp" / "commits").glob("*0*"):
        commit.unlink()
    for file in (tmp_path / "out").rglob("*.parquet"):
        file.unlink()
    fold(spark, source, path, ["k", "d"], "d")
    assert spark.read.parquet(path).count() == 1


def versions(spark, source, path, keys, partition_by, checkpoint):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    stream_latest(
        rows, path, f"{path}-work", keys, partition_by=partition_by, checkpoint=checkpoint, versioned=True
    ).awaitTermination()


@pytest.mark.parametrize(("keys", "partition_by"), [(["k", "d"], "d"), (["k"], None)])
def test_readers_see_a_version_whole(spark, tmp_path, keys, partition_by):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [("a", day(1), 1, at(1), "r1"), ("b", day(2), 2, at(1), "r1"), ("c", None, 3, at(1), "r1")],
        [("a", day(1), 4, at(2), "r2"), ("d", day(3), 5, at(2), "r2")],
        [("c", None, 7, at(3), "r3"), ("a", day(1), 8, at(3), "r3")],
    ]
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read_version(spark, path, schema).count() == 0
    so_far, readers = [], []
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        versions(spark, source, path, keys, partition_by, f"{path}-cp")
        so_far += rows
        full = as_dicts(keep_latest(spark.createDataFrame(so_far, SCHEMA), keys), "k", "d")
        assert as_dicts(read_version(spark, path, schema), "k", "d") == full
        readers.append((read_version(spark, path, schema), full))
        # The reader that began one write ago still sees what it began with.
        for reader, then in readers[-2:]:
            assert as_dicts(reader, "k", "d") == then
    assert sorted(p.name for p in (tmp_path / "out" / "_versions").glob("0*")) == [f"{n:010d}" for n in (2, 3)]
    assert newest_version(spark, path)[0] == 3
    if partition_by:
        # Days that no later batch touched were written once, and outdated ones are gone.
        days = {p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").glob("version=*/d=*")}
        null = "d=__HIVE_DEFAULT_PARTITION__"
        assert days == {
            f"version=1/d={day(2)}", f"version=1/{null}", f"version=2/d={day(1)}", f"version=2/d={day(3)}",
            f"version=3/d={day(1)}", f"version=3/{null}",
        }


def test_a_repeated_or_half_written_version_changes_nothing(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("k", day(1), 1, at(1), "r")], SCHEMA).coalesce(1).write.parquet(source)
    versions(spark, source, path, ["k", "d"], "d", f"{path}-cp")
    for commit in (tmp_path / "out-cp" / "commits").glob("*0*"):
        commit.unlink()
    # Leftovers of a write that stopped before its list appeared.
    spark.createDataFrame([("x", day(9), 9, at(9), "r")], SCHEMA).write.partitionBy("d").parquet(f"{path}/version=2")
    versions(spark, source, path, ["k", "d"], "d", f"{path}-cp")
    schema = spark.createDataFrame([], SCHEMA).schema
    assert newest_version(spark, path)[0] == 1
    assert [r["k"] for r in read_version(spark, path, schema).collect()] == ["k"]
    spark.createDataFrame([("l", day(2), 1, at(2), "r")], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    versions(spark, source, path, ["k", "d"], "d", f"{path}-cp")
    assert {r["k"] for r in read_version(spark, path, schema).collect()} == {"k", "l"}


def test_a_partition_column_outside_the_key_is_refused(spark, folder):
    with pytest.raises(ValueError, match="part of the key"):
        stream_latest(spark.range(1), folder, folder, ["k"], partition_by="d")


def test_stream_progress_lies_in_the_shared_folder(spark):
    assert checkpoint_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# ---- everything ----


def generated_raw(spark, name):
    """A few rows per raw table that pass the error-level tests."""
    contract = CONTRACTS[name]
    values = {"bigint": "3", "double": "0.5", "date": "2026-06-01", "timestamp": "2026-06-01",
              "day": "2026-06-01 10:00:00", "string": "x"}
    special = {"last_modified_seconds": "1780272000", "Event Name": "SplashScreen_Loading",
               "basic_details": '{"name":"n","tags":[]}', "variation": "all_variations"}
    own = {}
    for field in contract.fields:
        column = field[2] if len(field) > 2 else field[0]
        own.setdefault(column, special.get(column, values[field[1]]))
    schema = ", ".join([f"`{c}` string" for c in own] + [f"`{c}` {t}" for c, t in METADATA.items()])
    load = (at(10), "s", "app", "android", "r", day(1), day(2))
    return spark.createDataFrame([(*own.values(), *load)] * 2, schema)


def test_refresh_builds_tests_and_publishes_every_table(spark, tmp_path):
    def landing(name):
        path = f"{tmp_path}/raw/{raw_name(name).replace('.', '/')}"
        return name, lambda: append_raw(generated_raw(spark, name), path)

    traffic = "play_raw/raw_gcs_store_performance_traffic"  # landed, but read by no table
    append_raw(generated_raw(spark, "stg_play_console_gcs_crashes"), f"{tmp_path}/raw/{traffic}")
    tables = refresh(
        spark, f"{tmp_path}/raw", f"{tmp_path}/tables", at(11), [landing(n) for n in CONTRACTS]
    )
    assert set(TABLES) < set(tables)
    for name, spec in TABLES.items():
        assert spark.table(name).columns == tables[name].columns
        assert (tmp_path / "tables" / name).exists() == spec.stored
    assert spark.sql("SELECT cohort_size FROM mart_appsflyer_retention").first()[0] == 1
    assert spark.table("dash_overview_ios").filter(F.col("date") == F.lit(day(1))).count() == 1
    assert tables["data_tests"].count() == 162
    assert tables["data_tests"].filter("status = 'fail'").count() == 0
    ages = tables["freshness"].collect()
    assert len(ages) == 23 and {r["status"] for r in ages} == {"pass"}


def test_failed_error_test_stops_the_run(spark, tmp_path):
    raw = {raw_name(n): generated_raw(spark, n) for n in CONTRACTS}
    bad = "appsflyer_raw.raw_installs"
    raw[bad] = raw[bad].withColumn("_platform", F.lit("windows"))
    for name, df in raw.items():
        append_raw(df, f"{tmp_path}/raw/{name.replace('.', '/')}")
    with pytest.raises(RuntimeError, match="stg_appsflyer_installs._platform accepted_values: 1"):
        refresh(spark, f"{tmp_path}/raw", f"{tmp_path}/tables", at(11))
    # everything was built before the run failed
    assert spark.table("stg_appsflyer_installs").filter("_platform = 'windows'").count() == 1


def test_load_dates_are_dates(spark):
    stamped = stamp(spark.range(1), Load("s", date(2026, 6, 1), date(2026, 6, 2)))
    assert dict(stamped.dtypes)["_extract_from"] == "date"
