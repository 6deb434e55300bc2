"""Reading, typing, loading, logging and generating tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratoform.functions.hashing import Hash
from stratoform.model.schemas import LAYERS, DeclaredTable, schema_of
from stratoform.model.views import TABLES, table
from stratoform.session import scratch_root, stage
from stratoform.sources.changes import KeyedTable, changed_since, newest
from stratoform.sources.files import (
    FrameSource,
    JdbcSource,
    ParquetSource,
    TableSource,
    count_tables,
    preview,
    read_csv,
    read_text_columns,
    type_text_columns,
    write_csv,
)
from stratoform.sources.generate import rows_to_table, sales
from stratoform.sources.jobs import JobConfig, JobRun, JobStore, config_records, log_records
from stratoform.sources.load import TableLoad, load_all, load_mode, summary
from stratoform.sources.partitioned import YearlyTable
from stratoform.streaming.changes import upsert_new_files

T = dt.datetime


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_csv_quoting(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "hi", twice', None), (2, " padded ", ""), (3, 'a""b', "x,y")], "id int, a string, b string"
    )
    write_csv(df, f"file://{tmp_path}/csv")
    expected = df.withColumn("b", F.nullif("b", F.lit("")))
    assert rows(read_csv(spark, f"file://{tmp_path}/csv", df.schema)) == rows(expected)


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,other\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, f"file://{tmp_path}/t.csv", spark.createDataFrame([], "id int, name string").schema).collect()


def test_text_staging(spark, tmp_path):
    (tmp_path / "prd.csv").write_text(
        'a,b,c,d\n1,"x, ""y""",12.50,2024-01-05\n2,,, \n,lost,1,2024-01-01\n3,z,abc,2024-13-01\nfour,z,1,2024-01-01\n'
    )
    staged = read_text_columns(spark, f"file://{tmp_path}/prd.csv", ["id", "name", "cost", "day"])
    types = {"id": "int", "name": "string", "cost": "decimal(10,2)", "day": "date"}
    load = type_text_columns(staged, types, ["id"])
    accepted = load.accepted.withColumn("cost", F.col("cost").cast("double"))
    assert rows(accepted) == [(1, 'x, "y"', 12.5, dt.date(2024, 1, 5)), (2, None, None, None)]
    rejected = {(r.id, r.unparsed, r.missing) for r in load.rejected.collect()}
    assert rejected == {(None, "", "id"), ("3", "cost,day", ""), ("four", "id", "")}


def test_counts_and_preview(spark):
    counts = count_tables({"a": spark.range(3), "b": spark.range(0)})
    assert rows(counts) == [("TOTAL", 3), ("a", 3), ("b", 0)]
    assert [r[0] for r in preview(spark.range(50), [F.desc("id")], 3).collect()] == [49, 48, 47]


def test_jdbc_options():
    plain = JdbcSource("jdbc:postgresql://h/db", "t", {"user": "u"}).options()
    assert plain["dbtable"] == "t" and "partitionColumn" not in plain
    split = JdbcSource("jdbc:x", "t", partition_column="id", lower=0, upper=1000, partitions=50).options()
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "0", "1000", "50",
    )


@pytest.mark.parametrize(("layer", "table"), [(layer, t) for layer, tables in LAYERS.items() for t in tables])
def test_declared_tables(spark, tmp_path, layer, table):
    declared = DeclaredTable(layer, table, database="declared_db")
    declared.create(spark, f"file://{tmp_path}/{layer}_{table}")
    declared.create(spark, f"file://{tmp_path}/{layer}_{table}")
    assert spark.table(declared.full_name).schema.simpleString() == schema_of(layer, table).simpleString()
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {declared.full_name}").collect()}
    assert declared.properties.items() <= shown.items()
    spark.sql(f"DROP TABLE {declared.full_name}")


def test_conform_widens_and_orders(spark):
    df = spark.createDataFrame([("US", "AW1")], "cntry string, cid string").withColumn(
        "src_update_at", F.lit(T(2024, 1, 1)).cast("timestamp")
    )
    assert DeclaredTable("bronze", "erp_loc_a101").conform(df).columns == ["cid", "cntry", "src_update_at"]
    ids = spark.createDataFrame([(1,)], "cst_id int")
    for name in schema_of("bronze", "crm_cust_info").names[1:]:
        ids = ids.withColumn(name, F.lit(None).cast(schema_of("bronze", "crm_cust_info")[name].dataType))
    assert dict(DeclaredTable("bronze", "crm_cust_info").conform(ids).dtypes)["cst_id"] == "bigint"


# --- jobs ------------------------------------------------------------------


def test_job_log(spark, tmp_path):
    start, end = T(2024, 1, 5, 23, 59), T(2024, 1, 6, 0, 1)
    run = JobRun("j" * 300, start, end, 5, "success")
    failed = JobRun("job", start, end, 0, "failed", "e" * 300)
    log = log_records(spark, [run, failed], end)
    assert log.schema == schema_of("jobs", "job_log")
    got = rows(log, "run_date", "record_count", "status", F.length("job_name"), F.length("error_message"))
    assert got == [(dt.date(2024, 1, 5), 0, "failed", 3, 300), (dt.date(2024, 1, 5), 5, "success", 300, None)]
    assert log.select("log_id").distinct().count() == 2
    # A log in which no run failed has a message column of nulls only.
    store = JobStore(f"file://{tmp_path}/jobs")
    for _ in range(2):
        store.append(log_records(spark, [run], end), "job_log")
    assert spark.read.parquet(f"file://{tmp_path}/jobs/job_log").count() == 2


def test_job_config(spark):
    configs = [JobConfig("j", "public", "t", "bronze", "t", mode) for mode in ("full", "increment")]
    df = config_records(spark, configs, T(2024, 1, 1))
    assert df.schema == schema_of("jobs", "job_config")
    assert rows(df, "load_type", "is_active", "schedule_type") == [(0, 1, "manual"), (1, 1, "manual")]


# --- loads -----------------------------------------------------------------

CHANGES = "key int, at timestamp, v string"


def changes(spark, *data):
    return spark.createDataFrame([(k, T(2024, 1, day), v) for k, day, v in data], CHANGES)


def test_changed_since(spark):
    df = changes(spark, (1, 1, "a"), (2, 3, "b"))
    assert newest(df, "at") == T(2024, 1, 3)
    assert rows(changed_since(df, "at", T(2024, 1, 1)), "key") == [(2,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_watermark_does_not_depend_on_the_time_zone(spark, kind):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        data = [(T(2024, 1, 1, 3),), (T(2024, 1, 1, 5),), (T(2024, 1, 1, 23),)]
        df = spark.createDataFrame(data, f"at {kind}")
        assert changed_since(df, "at", newest(df, "at")).count() == 0
        assert changed_since(df, "at", T(2024, 1, 1, 4)).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def keyed(path, keys=("key",)):
    return KeyedTable(f"file://{path}", keys, ("at",))


def test_load_runs(spark, tmp_path):
    target, plain = keyed(tmp_path / "t"), keyed(tmp_path / "plain", keys=())
    store = JobStore(f"file://{tmp_path}/jobs")
    ticks = iter(range(1000))
    clock = lambda: T(2024, 2, 1) + dt.timedelta(seconds=next(ticks))

    def run(df):
        loads = [
            TableLoad("t", FrameSource(df), target, "at"),
            TableLoad("absent", ParquetSource(f"file://{tmp_path}/nowhere"), keyed(tmp_path / "x"), "at"),
            TableLoad("plain", FrameSource(df), plain, "at"),
        ]
        assert load_mode(spark, loads[1]) == "full"
        return load_all(spark, loads, store, clock)

    first = run(changes(spark, (1, 1, "a"), (2, 1, "b")))
    assert rows(first, "table_name", "load_mode", "status", "records") == [
        ("absent", "full", "failed", 0), ("plain", "full", "success", 2), ("t", "full", "success", 2),
    ]
    totals = summary(first).first()
    assert (totals["tables"], totals["succeeded"], totals["failed"], totals["records"]) == (3, 2, 1, 4)
    assert totals["seconds"] > 0

    source = changes(spark, (1, 1, "a"), (2, 1, "b"), (2, 2, "b2"), (3, 2, "c"))
    for _ in range(2):
        again = run(source)
        assert rows(again, "table_name", "load_mode", "records")[1:] == [("plain", "increment", 4), ("t", "increment", 4)]
        assert rows(target.read(spark), "key", "v") == [(1, "a"), (2, "b2"), (3, "c")]
        assert rows(plain.read(spark), "key", "v") == [(1, "a"), (2, "b"), (2, "b2"), (3, "c")]

    log = spark.read.parquet(f"file://{tmp_path}/jobs/job_log")
    assert log.where("status = 'failed' and error_message is not null").count() == 3
    assert log.where("status = 'success'").count() == 6
    config = spark.read.parquet(f"file://{tmp_path}/jobs/job_config")
    assert rows(config.groupBy("load_type").count()) == [(0, 5), (1, 4)]


def test_late_equal_and_undated_rows_are_loaded(spark, tmp_path):
    first = [(1, T(2024, 1, 5, 12), "a"), (2, None, "u")]
    late = [(3, T(2024, 1, 5, 12), "equal"), (4, T(2024, 1, 4), "late"), (5, None, "undated"), (6, T(2024, 1, 6), "new")]
    for name, keys in (("keyed", ("key",)), ("plain", ())):
        target = keyed(tmp_path / name, keys=keys)
        for data in (first, first + late, first + late):
            load_all(spark, [TableLoad(name, FrameSource(spark.createDataFrame(data, CHANGES)), target, "at")])
        assert rows(target.read(spark), "key") == [(k,) for k in range(1, 7)]


def test_without_any_change_time_the_load_is_full(spark, tmp_path):
    target = keyed(tmp_path / "t")
    undated = spark.createDataFrame([(1, None, "a")], CHANGES)
    load = TableLoad("t", FrameSource(undated), target, "at")
    for _ in range(2):
        assert rows(load_all(spark, [load]), "load_mode", "records") == [("full", 1)]
    more = TableLoad("t", FrameSource(spark.createDataFrame([(1, None, "a"), (2, T(2024, 1, 1), "b")], CHANGES)), target, "at")
    load_all(spark, [more])
    assert rows(target.read(spark), "key") == [(1,), (2,)]


def files(path):
    return {p: p.stat().st_size for p in path.rglob("*.parquet") if "_log" not in str(p)}


def test_scattered_changes_write_only_themselves(spark, tmp_path):
    target = keyed(tmp_path / "t")
    rows_ = spark.range(100_000).select(F.col("id").cast("int").alias("key"), F.lit(T(2024, 1, 1)).alias("at"), F.lit("old").alias("v"))
    target.replace(rows_)
    before = files(tmp_path / "t")
    target.upsert(rows_.where("key % 250 = 0").withColumns({"at": F.lit(T(2024, 1, 2)), "v": F.lit("new")}))
    after = files(tmp_path / "t")
    assert before.items() <= after.items()
    written = spark.read.parquet(*{f"file://{p.parent}" for p in set(after) - set(before)})
    assert written.count() == 400
    assert rows(target.read(spark).groupBy("v").count()) == [("new", 400), ("old", 99_600)]


def test_a_failed_load_leaves_the_table_and_can_be_repeated(spark, tmp_path):
    target = keyed(tmp_path / "t")
    target.replace(changes(spark, (1, 1, "a"), (2, 1, "b")))
    bad = changes(spark, (2, 2, "x")).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    for write in (target.replace, target.upsert):
        with pytest.raises(Exception, match="stop"):
            write(bad)
        assert rows(target.read(spark), "key", "v") == [(1, "a"), (2, "b")]
    for _ in range(2):
        target.upsert(changes(spark, (2, 2, "b2")))
    assert rows(target.read(spark), "key", "v") == [(1, "a"), (2, "b2")]


def test_many_changes_become_a_new_base(spark, tmp_path):
    target = KeyedTable(f"file://{tmp_path}/t", ("key",), ("at",), max_deltas=2)
    target.replace(changes(spark, (0, 1, "v0")))
    for k in range(1, 6):
        target.upsert(changes(spark, (k, 1, f"v{k}"), (0, k + 1, f"w{k}")))
    assert rows(target.read(spark), "key", "v") == [(0, "w5"), *((k, f"v{k}") for k in range(1, 6))]
    assert len({p.parent for p in files(tmp_path / "t")}) <= 6


def test_table_source(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert TableSource("three").read(spark).count() == 3


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, target = f"file://{tmp_path}/in", keyed(tmp_path / "t")
    schema = spark.createDataFrame([], CHANGES).schema
    for batch in (changes(spark, (1, 1, "a"), (2, 1, "b")), changes(spark, (2, 2, "b2"))):
        batch.coalesce(1).write.mode("append").parquet(folder)
        for _ in range(2):
            upsert_new_files(spark, folder, schema, target, f"file://{tmp_path}/state")
    assert rows(target.read(spark), "key", "v") == [(1, "a"), (2, "b2")]


# --- partitioned fact ------------------------------------------------------


def test_yearly_table(spark, tmp_path):
    days = [dt.date(2022, 12, 31), dt.date(2023, 1, 1), dt.date(2024, 6, 1), dt.date(2025, 12, 31), dt.date(2026, 1, 1), None]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "sale_date date, n int")
    table = YearlyTable(f"file://{tmp_path}/fact", "sale_date", 2023, 2025)
    table.write(df)
    assert rows(table.rejected(df), "n") == [(0,), (4,), (5,)]
    read = table.read(spark, since=dt.date(2024, 1, 1), until=dt.date(2024, 12, 31))
    assert rows(read, "n") == [(2,)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_year" in plan
    assert table.read(spark).count() == 3


# --- generated rows --------------------------------------------------------


@pytest.mark.parametrize("kind", list(Hash))
def test_generated_sales(spark, kind):
    df = sales(spark.range(1, 1001), "id", 5, 5, 5, kind=kind)
    assert df.schema.simpleString() == schema_of("star", "fact_sales").simpleString()
    assert df.where("total_amount <> quantity * unit_price or net_amount <> total_amount - discount_amount").count() == 0
    bounds = df.agg(
        F.min("sale_date"), F.max("sale_date"), F.min("quantity"), F.max("quantity"),
        F.min("unit_price") >= 20, F.max("unit_price") <= 1500,
        F.max(F.col("discount_amount") / F.col("total_amount")) <= 0.201, F.min("discount_amount") >= 0,
    ).first()
    assert bounds[0] >= dt.date(2024, 1, 1) and bounds[1] <= dt.date(2024, 12, 30)
    assert tuple(bounds)[2:] == (1, 5, True, True, True, True)
    assert df.select("customer_id").distinct().count() == 5
    assert df.where("sale_id rlike '^SALE[0-9]{6}$' and customer_id rlike '^CUST00[1-5]$'").count() == 1000
    again = sales(spark.range(1, 1001).repartition(13), "id", 5, 5, 5, kind=kind)
    assert rows(again) == rows(df)


def test_literal_rows(spark):
    df = rows_to_table(spark, "dim_locations", [{"location_id": "LOC001", "city": "Berlin"}])
    assert df.schema == schema_of("star", "dim_locations")
    assert df.first()["region"] is None
    with pytest.raises(ValueError, match="no column"):
        rows_to_table(spark, "dim_locations", [{"planet": "Mars"}])


def test_declared_schemas_are_those_of_the_files(spark, sf_dir):
    for name in TABLES:
        inferred = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema.simpleString()
        assert table(spark, sf_dir, name).schema.simpleString() == inferred


# --- scratch ---------------------------------------------------------------


def test_scratch_folder_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", "")
    assert scratch_root(spark).startswith(configured or spark.conf.get("spark.sql.warehouse.dir"))
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert staged.schema.simpleString() == spark.range(5).schema.simpleString()
