"""What the plans must look like for the work to hold at scale."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from helpers import data_files, executed_nodes, plan_text, scanned_rows
from smeltery.operators import reports
from smeltery.plans import jobs, sales
from smeltery.run import Run
from smeltery.session import REBALANCE_PARTITIONS, at_least, audit_settings, settings
from smeltery.sources import tables

SF = "/root/testdata/sf0.01"
PYTHON_NODES = ("Python", "Pandas", "Arrow")

# Those of the llm subpackage, where it is present, have tests of their own.
OWN = sorted(k for k in driver.queries() if not (k.startswith("op") or k == "pipeline"))


@pytest.mark.parametrize("key", OWN)
def test_no_python_and_no_cross_join(spark, key):
    text = plan_text(driver.queries()[key](spark, SF))
    assert not any(word in text for word in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key", ["silver_stamped", "cleaned", "enriched", "bronze_stamped"])
def test_row_wise_work_does_not_shuffle(spark, key):
    assert "Exchange" not in plan_text(driver.queries()[key](spark, SF))


@pytest.mark.parametrize("key", ["top_states", "latest_rows", "silver_monitor"])
def test_top_k_is_not_a_full_sort(spark, key):
    assert "TakeOrderedAndProject" in plan_text(driver.queries()[key](spark, SF))


@pytest.mark.parametrize(
    "key, scans",
    [
        ("clean_counts", 1),
        ("null_profile", 1),
        ("critical_nulls", 1),
        ("silver_metrics", 1),
        ("silver_monitor", 1),
        ("bronze_monitor", 1),
        ("quality_report", 2),
    ],
)
def test_number_of_scans(spark, key, scans):
    names = [n for n, _ in executed_nodes(driver.queries()[key](spark, SF))]
    assert names.count("FileSourceScanExec") == scans


@pytest.mark.parametrize(
    "key",
    [
        "duplicate_count",
        "category_distribution",
        "state_category_report",
        "top_states",
        "silver_monitor",
        "lineitem_duplicate_orders",
        "lineitem_top_suppliers",
    ],
)
def test_groups_are_pre_aggregated_before_the_shuffle(spark, key):
    text = plan_text(driver.queries()[key](spark, SF))
    physical = text[text.index("== Physical Plan ==") :].splitlines()
    shuffles = [i for i, line in enumerate(physical) if "Exchange hashpartitioning" in line]
    assert shuffles and all("functions=[partial_" in physical[i + 1] for i in shuffles)


@pytest.fixture
def two_loads(spark, folder):
    """The whole sales rows, delivered on two days."""
    bronze, raw = sales.bronze_table(folder), driver.raw_sales(spark, SF)
    first = driver.BRONZE_RUN
    second = Run("next", first.ts + timedelta(days=1), first.as_of + timedelta(days=1))
    jobs.ingest_bronze(spark, raw, bronze, first)
    return jobs.ingest_bronze(spark, raw, bronze, second)


def test_cleaning_reaches_the_scan(spark, two_loads):
    with settings(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        text = plan_text(sales.to_silver(two_loads.rows))
    scan = [line for line in text.splitlines() if "FileScan" in line][-1]
    pushed = scan[scan.index("PushedFilters") :]
    assert "GreaterThan(valor,0.0)" in pushed and "EqualTo(bronze_is_deleted,true)" in pushed
    assert "IsNotNull(id_venda)" in pushed and "IsNotNull(cliente)" in pushed
    assert "bronze_source_system" not in scan and "bronze_file_name" not in scan


def test_loaded_on_skips_other_loads(two_loads):
    today = reports.loaded_on(two_loads.rows, "bronze_load_timestamp", two_loads.run.as_of)
    assert scanned_rows(today) == [10_000]


def test_latest_rows_open_the_last_load_only(two_loads):
    assert scanned_rows(two_loads.latest) == [10_000, 10_000]
    whole = sales.latest_loads(two_loads.rows)
    assert sorted(scanned_rows(whole)) == [10_000, 20_000]
    narrow = [line for line in plan_text(two_loads.latest).splitlines() if "FileScan" in line]
    assert any("ReadSchema: struct<bronze_load_timestamp:timestamp>" in line for line in narrow)


def test_monitor_counts_from_footers(spark, two_loads):
    files = tables.file_summary(spark, two_loads.table)["files"]
    by_footers = jobs.monitor_files(spark, two_loads.table, two_loads.run)
    assert sorted(scanned_rows(by_footers)) == [files, 10_000]
    assert scanned_rows(two_loads.monitor) == []
    assert by_footers.collect() == two_loads.monitor.collect()


def test_silver_months_are_pruned(spark, folder):
    target = sales.silver_table(folder)
    done = jobs.refresh_silver(spark, driver.sales_rows(spark, SF), target, driver.SILVER_RUN)
    dated = done.rows.where("ano_venda = 2024 AND mes_venda = 1")
    assert scanned_rows(dated.select("valor")) == [9_233 - 167]


def test_file_listing_reads_no_contents(spark, two_loads):
    text = plan_text(tables.file_sizes(spark, two_loads.table))
    assert "ReadSchema: struct<path:string,length:bigint>" in text


def test_rebalance_writes_one_file_per_small_partition(spark, folder):
    bronze = sales.bronze_table(folder)
    raw = driver.raw_sales(spark, SF).repartition(8, "id_venda")
    jobs.ingest_bronze(spark, raw, bronze, driver.BRONZE_RUN)
    assert len(data_files(bronze.path)) == raw.select("data_venda").distinct().count()


def test_hot_partition_is_split_over_tasks(spark, folder):
    """Nearly all rows fall into one month; the write must not put them into one task."""
    target, rows = sales.silver_table(folder), driver.stamped_silver(spark, SF)
    wide = rows.withColumn("produto", F.sha2(F.col("id_venda").cast("string"), 512))
    wide.repartition(8, "id_venda").write.parquet(f"{folder}/in")
    many_files = spark.read.parquet(f"{folder}/in")
    advisory = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    with settings(spark, advisory | {"spark.sql.files.openCostInBytes": "128MB"}):
        tables.stage(many_files, target, "r1")
    hot = data_files(f"{tables.run_path(target, 'r1')}/ano_venda=2024/mes_venda=1")
    assert len(hot) >= 4
    back = tables.read_staged(spark, target, "r1", wide.schema)
    assert back.exceptAll(wide).isEmpty() and wide.exceptAll(back).isEmpty()


def test_footers_answer_after_a_column_was_added(spark, two_loads):
    wider = driver.raw_sales(spark, SF).withColumn("canal", F.lit("web"))
    third = Run("third", two_loads.run.ts + timedelta(days=1), two_loads.run.as_of + timedelta(days=1))
    load = jobs.ingest_bronze(spark, wider, two_loads.table, third)
    files = tables.file_summary(spark, load.table)["files"]
    scanned = scanned_rows(jobs.monitor_files(spark, load.table, third))
    # A row per file and the day's rows; the older version has none of that day.
    assert sum(scanned) == files + 10_000 and max(scanned) == 10_000


def test_the_audit_shuffle_follows_the_staged_bytes(spark):
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    small, large = (audit_settings(spark, n << 20, 8 << 20)[first] for n in (1, 80_000))
    assert int(small) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert int(large) == 10_000
    with settings(spark, {first: "20000"}):
        assert audit_settings(spark, 80_000 << 20, 8 << 20)[first] == "20000"


def test_the_write_shuffle_is_never_below_the_callers(spark):
    mine = "spark.sql.shuffle.partitions"
    with settings(spark, {mine: "5000"}):
        assert at_least(spark, mine, REBALANCE_PARTITIONS) == 5000
    assert at_least(spark, mine, REBALANCE_PARTITIONS) == REBALANCE_PARTITIONS
