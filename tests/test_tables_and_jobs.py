import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from helpers import data_files
from smeltery.plans import jobs, sales
from smeltery.run import Run
from smeltery.session import settings
from smeltery.sources import log, tables
from smeltery.sources.raw import read_raw
from smeltery.sources.schemas import SchemaConflict, extended
from smeltery.sources.tables import NoSuchTable, Table
from test_refine import GOLDEN, RUN

LATER = Run("r2", RUN.ts.replace(hour=10), RUN.as_of)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(GOLDEN, sales.RAW)


@pytest.fixture(params=["parquet", "orc"])
def fmt(request):
    return request.param


# --- bronze


def test_append_twice_and_read_back(spark, folder, raw, fmt):
    bronze = sales.bronze_table(folder, fmt)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    load = jobs.ingest_bronze(spark, raw, bronze, LATER)
    expected = sales.stamp_bronze(raw, RUN).unionByName(sales.stamp_bronze(raw, LATER))
    assert load.rows.columns == sales.BRONZE.names
    assertDataFrameEqual(load.rows, expected)
    assert {r["bronze_load_id"] for r in load.latest.collect()} == {"r2"}


def test_bronze_is_partitioned_by_the_raw_date(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    days = {p.parent.name for p in data_files(bronze.path)}
    assert days == {f"data_venda=2024-06-{d}" for d in (15, 16, 17)}


def test_raw_dates_survive_as_text(spark, folder):
    texts = ["2024-06-15", "2024-6-5", " 2024-06-15", "2024-06-15 10:00:00", "007", "a/b=c", None]
    sold = [(i, "c", "p", 1.0, t, "SP") for i, t in enumerate(texts)]
    raw = spark.createDataFrame(sold, sales.RAW)
    rows = jobs.ingest_bronze(spark, raw, sales.bronze_table(folder), RUN).rows
    assert [r["data_venda"] for r in rows.orderBy("id_venda").collect()] == texts


def test_empty_raw_date_becomes_null(spark, folder):
    raw = spark.createDataFrame([(1, "c", "p", 1.0, "", "SP")], sales.RAW)
    rows = jobs.ingest_bronze(spark, raw, sales.bronze_table(folder), RUN).rows
    assert rows.first()["data_venda"] is None


def test_additive_columns_extend_the_table(spark, folder, raw, fmt):
    bronze = sales.bronze_table(folder, fmt)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    jobs.ingest_bronze(spark, raw.withColumn("canal", F.lit("web")), bronze, LATER)
    third = Run("r3", LATER.ts, LATER.as_of)
    rows = jobs.ingest_bronze(spark, raw.drop("produto"), bronze, third).rows
    by_load = {
        r["bronze_load_id"]: (r["n"], r["canal"], r["produto"])
        for r in rows.groupBy("bronze_load_id")
        .agg(
            F.count("*").alias("n"),
            F.count("canal").alias("canal"),
            F.count("produto").alias("produto"),
        )
        .collect()
    }
    assert by_load == {"r1": (5, 0, 5), "r2": (5, 5, 5), "r3": (5, 0, 0)}


def test_changed_type_is_refused_before_writing(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    before = data_files(bronze.path)
    with pytest.raises(SchemaConflict, match="valor: table has double, rows have string"):
        jobs.ingest_bronze(spark, raw.withColumn("valor", F.lit("1")), bronze, LATER)
    assert data_files(bronze.path) == before
    assert tables.read(spark, bronze).count() == 5


def test_names_match_without_case_and_untyped_nulls_fit(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    odd = raw.withColumnRenamed("produto", "PRODUTO").withColumn("estado", F.lit(None))
    rows = jobs.ingest_bronze(spark, odd, bronze, LATER).rows
    assert rows.columns == sales.BRONZE.names
    assert rows.where("estado IS NULL").count() == 5


def test_extended_reports_every_conflict(spark):
    known = spark.createDataFrame([], "a INT, b STRING").schema
    with pytest.raises(SchemaConflict, match="a: .*; b: "):
        extended(known, spark.createDataFrame([], "a STRING, b INT").schema)


def test_footers_answer_like_a_scan(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    holes = raw.withColumn("produto", F.expr("nullif(produto, 'Produto B')")).withColumn(
        "data_venda", F.expr("nullif(data_venda, '2024-06-17')")
    )
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    monitor = jobs.ingest_bronze(spark, holes, bronze, LATER).monitor
    assert tables.footer_counts(spark, bronze) is not None
    assertDataFrameEqual(monitor, sales.bronze_monitor(tables.read(spark, bronze), LATER))
    assert monitor.first()["produto"] == 2 and monitor.first()["data_venda"] == 1


def test_footers_answer_for_long_texts_and_every_flat_type(spark, folder, raw):
    odd = raw.withColumns(
        {
            "cliente": F.expr("if(id_venda = 1, NULL, repeat('é', 9000))"),
            "produto": F.expr("repeat(produto, 2000)"),
            "a.b": F.expr("if(id_venda = 2, NULL, x'00ff')"),
            "c d": F.expr("if(id_venda = 3, NULL, CAST(valor AS DECIMAL(30, 2)))"),
            "valor": F.expr("if(id_venda = 4, double('NaN'), valor)"),
            "nothing": F.expr("CAST(NULL AS TIMESTAMP_NTZ)"),
        }
    )
    bronze = sales.bronze_table(folder)
    load = jobs.ingest_bronze(spark, odd, bronze, RUN)
    assert tables.footer_counts(spark, bronze) is not None
    assertDataFrameEqual(load.monitor, sales.bronze_monitor(load.rows, RUN))
    counted = load.monitor.first()
    nulls = [counted[c] for c in ("cliente", "produto", "a.b", "c d", "valor", "nothing")]
    assert nulls == [1, 0, 1, 1, 0, 5]


@pytest.mark.parametrize("text", ["z" * 5000 + "3", "é" * 4000, "z", "nope"])
def test_filters_on_long_texts_are_right(spark, folder, text):
    texts = ["z" * 5000 + str(i) for i in range(6)] + ["é" * 4000, None, "a", "z"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").coalesce(1)
    table = Table(folder)
    tables.append(spark, rows, table, "r1")
    stored, held = tables.read(spark, table), [t for t in texts if t is not None]
    assert stored.where(F.col("t") == text).count() == held.count(text)
    assert stored.where(F.col("t") >= text).count() == sum(t >= text for t in held)
    assert stored.where(F.col("t") < text).count() == sum(t < text for t in held)


def test_monitor_of_an_evolved_table_adds_up_its_versions(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    load = jobs.ingest_bronze(spark, raw.withColumn("canal", F.lit("web")), bronze, LATER)
    assert len(tables.footer_counts(spark, bronze)) == 2
    assertDataFrameEqual(load.monitor, sales.bronze_monitor(load.rows, LATER))
    assert load.monitor.first()["canal"] == 5


KINDS = {
    "boolean": "true",
    "tinyint": "1",
    "smallint": "1",
    "bigint": "1",
    "float": "1.5",
    "decimal(38,4)": "1.5",
    "binary": "x'00'",
    "date": "date'2024-01-01'",
    "timestamp": "timestamp'2024-01-01 00:00:00'",
    "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00'",
    "array<int>": "array(1)",
    "map<string,int>": "map('a', 1)",
    "struct<a:int,b:int>": "named_struct('a', 1, 'b', 2)",
    "interval year to month": "interval '1' year",
    "interval day to second": "interval '1 2:00:00' day to second",
    "variant": "parse_json('{\"a\": 1}')",
}


@pytest.mark.parametrize("kind", KINDS)
def test_nulls_after_a_column_of_each_type_are_counted_right(spark, folder, raw, kind):
    odd = raw.withColumns(
        {
            "odd": F.expr(f"if(id_venda = 1, NULL, CAST({KINDS[kind]} AS {kind}))"),
            "late": F.expr("if(id_venda <= 2, NULL, id_venda)"),
        }
    )
    load = jobs.ingest_bronze(spark, odd, sales.bronze_table(folder), RUN)
    counted = load.monitor.first()
    nulls = [counted[c] for c in ("odd", "late", "bronze_load_timestamp", "bronze_is_deleted")]
    assert nulls == [1, 2, 0, 0]


def test_the_monitor_sees_the_callers_settings(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    mine = {"spark.sql.files.maxPartitionBytes": "12345678", "fs.example.key": "secret"}
    with settings(spark, mine):
        session = tables.footer_counts(spark, bronze)[0].sparkSession
        assert {key: session.conf.get(key) for key in mine} == mine


@pytest.mark.parametrize("first", [True, False])
def test_a_failed_load_leaves_no_rows_and_no_columns(spark, folder, raw, first):
    bronze = sales.bronze_table(folder)
    if not first:
        jobs.ingest_bronze(spark, raw, bronze, RUN)
    lost = F.expr("if(id_venda = 5, raise_error('lost'), 1)").cast("int")
    broken = raw.withColumn("canal", lost)
    with pytest.raises(Exception, match="lost"):
        jobs.ingest_bronze(spark, broken, bronze, LATER)
    if first:
        assert not tables.exists(spark, bronze)
    else:
        assert tables.read(spark, bronze).columns == sales.BRONZE.names
        assert tables.read(spark, bronze).count() == 5
    right = jobs.ingest_bronze(spark, raw.withColumn("canal", F.lit("web")), bronze, LATER)
    assert right.rows.where("canal = 'web'").count() == 5
    assert tables.footer_counts(spark, bronze) is not None


def test_a_repeated_run_is_refused(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    with pytest.raises(tables.RunAlreadyLogged):
        jobs.ingest_bronze(spark, raw, bronze, RUN)
    assert tables.read(spark, bronze).count() == 5


def test_formats_with_a_log_of_their_own_are_refused():
    with pytest.raises(ValueError, match="delta keeps a log of its own"):
        Table("/lake/t", fmt="delta")


def test_superseded_runs_are_listed(spark, folder, raw):
    silver, bronze = sales.silver_table(folder), sales.stamp_bronze(raw, RUN)
    jobs.refresh_silver(spark, bronze, silver, LATER)
    assert tables.superseded(spark, silver).isEmpty()
    jobs.refresh_silver(spark, bronze, silver, Run("r3", LATER.ts, LATER.as_of))
    assert [r["run_id"] for r in tables.superseded(spark, silver).collect()] == ["r2"]


def test_footers_are_not_asked_about_nested_columns_or_orc(spark, folder, raw):
    nested = Table(f"{folder}/nested")
    tables.append(spark, raw.withColumn("more", F.array("produto")), nested, "r1")
    assert tables.footer_counts(spark, nested) is None
    orc = sales.bronze_table(folder, "orc")
    assert jobs.ingest_bronze(spark, raw, orc, RUN).monitor.first()["total_rows"] == 5
    assert tables.footer_counts(spark, orc) is None


def test_unpublished_table_is_missing(spark, folder):
    with pytest.raises(NoSuchTable):
        tables.read(spark, sales.silver_table(folder))


@pytest.mark.parametrize("source", ["csv", "json", "parquet"])
def test_delivered_files_are_read_by_their_declared_schema(spark, folder, raw, source):
    options = {"header": True} if source == "csv" else {}
    raw.write.format(source).options(**options).save(f"{folder}/in")
    got = read_raw(spark, f"{folder}/in", sales.RAW, source, **options)
    assert got.schema == sales.RAW
    assertDataFrameEqual(got, raw)


# --- silver


def test_refresh_publishes_and_registers(spark, folder, raw, fmt):
    silver = sales.silver_table(folder, fmt)
    done = jobs.refresh_silver(spark, sales.stamp_bronze(raw, RUN), silver, LATER)
    assert done.ok and done.rows.columns == sales.SILVER.names
    assertDataFrameEqual(
        done.rows, sales.stamp_silver(sales.to_silver(sales.stamp_bronze(raw, RUN)), LATER)
    )
    assert spark.table("vendas_silver").count() == 5
    assert done.report.count() == 5 and done.monitor.count() == 4
    suffix = ".parquet" if fmt == "parquet" else ".orc"
    months = {"/".join(p.parts[-3:-1]) for p in data_files(f"{silver.path}/runs", suffix)}
    assert months == {"ano_venda=2024/mes_venda=6"}


def test_rows_without_a_date_keep_a_partition(spark, folder, raw):
    bad = sales.stamp_bronze(raw.withColumn("data_venda", F.lit("2024-02-30")), RUN)
    done = jobs.refresh_silver(spark, bad, sales.silver_table(folder), LATER)
    assert done.ok and done.rows.where("ano_venda IS NULL AND mes_venda IS NULL").count() == 5


def test_empty_refresh_publishes_nothing(spark, folder, raw):
    silver, empty = sales.silver_table(folder), sales.stamp_bronze(raw.limit(0), RUN)
    first = jobs.refresh_silver(spark, empty, silver, LATER)
    assert (first.ok, first.rows, tables.exists(spark, silver)) == (False, None, False)
    with pytest.raises(NoSuchTable):
        _ = first.report
    counted = first.audit.where("metric = 'rows'").first()
    assert counted["value"] == 0


def test_rejected_refresh_leaves_the_published_rows(spark, folder, raw):
    silver, bronze = sales.silver_table(folder), sales.stamp_bronze(raw, RUN)
    jobs.refresh_silver(spark, bronze, silver, LATER)
    third = Run("r3", LATER.ts, LATER.as_of)
    rejected = jobs.refresh_silver(spark, bronze.limit(0), silver, third)
    assert not rejected.ok
    assert {r["silver_load_id"] for r in rejected.rows.collect()} == {"r2"}


def test_a_refresh_that_breaks_while_writing_leaves_the_published_rows(spark, folder, raw):
    silver, bronze = sales.silver_table(folder), sales.stamp_bronze(raw, RUN)
    jobs.refresh_silver(spark, bronze, silver, LATER)
    broken = bronze.withColumn("valor", F.expr("if(id_venda = 5, raise_error('lost'), valor)"))
    third = Run("r3", LATER.ts, LATER.as_of)
    with pytest.raises(Exception, match="lost"):
        jobs.refresh_silver(spark, broken, silver, third)
    assert {r["silver_load_id"] for r in tables.read(spark, silver).collect()} == {"r2"}


def test_refresh_replaces_the_schema(spark, folder, raw):
    silver = sales.silver_table(folder)
    old = raw.select("id_venda", F.lit(1).alias("ano_venda"), F.lit("x").alias("mes_venda"))
    tables.stage(old, silver, "r0")
    tables.publish(spark, silver, "r0", old.schema)
    done = jobs.refresh_silver(spark, sales.stamp_bronze(raw, RUN), silver, LATER)
    assert done.rows.columns == sales.SILVER.names


def test_a_run_is_never_written_over(spark, folder, raw):
    silver, bronze = sales.silver_table(folder), sales.stamp_bronze(raw, RUN)
    jobs.refresh_silver(spark, bronze, silver, LATER)
    with pytest.raises(AnalysisException, match="already exists"):
        jobs.refresh_silver(spark, bronze, silver, LATER)


def test_a_reader_keeps_its_version_across_a_publish(spark, folder, raw):
    silver, bronze = sales.silver_table(folder), sales.stamp_bronze(raw, RUN)
    before = jobs.refresh_silver(spark, bronze, silver, LATER).rows
    third = Run("r3", LATER.ts, LATER.as_of)
    jobs.refresh_silver(spark, bronze.where("id_venda = 1"), silver, third)
    assert before.count() == 5 and tables.read(spark, silver).count() == 1


def test_compaction_keeps_the_rows_in_fewer_files(spark, folder, raw, fmt):
    silver = sales.silver_table(folder, fmt)
    rows = sales.stamp_silver(sales.to_silver(sales.stamp_bronze(raw, RUN)), LATER)
    scattered = rows.repartition(5, "id_venda")
    tables.stage(scattered, silver, "r1", rebalance=False)
    tables.publish(spark, silver, "r1", scattered.schema)
    before, files = tables.read(spark, silver), tables.file_summary(spark, silver)["files"]
    assert files > 1 and tables.compact(spark, silver, "r2")
    after = tables.read(spark, silver)
    assert tables.file_summary(spark, silver)["files"] == 1
    assert after.columns == before.columns
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
    assert not tables.compact(spark, silver, "r3")  # nothing left to merge


@pytest.mark.parametrize("rebalance", [True, False])
def test_the_published_directory_is_the_audited_one(spark, folder, rebalance):
    rows = [(i, f"name {i}", "p", float(i), f"2024-0{1 + i % 3}-15", "SP") for i in range(1, 91)]
    raw = spark.createDataFrame(rows, sales.RAW).repartition(6, "id_venda")
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    runs = Run("b1", RUN.ts, RUN.as_of), Run("s1", LATER.ts, LATER.as_of)
    done = jobs.run_pipeline(spark, raw, bronze, silver, *runs, rebalance=rebalance)
    assert done.ok and done.load.rows.count() == 90
    entries = log.entries(spark, silver.path).collect()
    assert [(r["run_id"], [p["location"] for p in r["add"]]) for r in entries] == [
        ("s1", [tables.location_of("s1")])
    ]
    assert {r["silver_load_id"] for r in tables.read(spark, silver).collect()} == {"s1"}
    assert done.audit.where("metric IN ('rows_read', 'rows_kept') AND value = 90").count() == 2
    assertDataFrameEqual(spark.read.parquet(f"{silver.path}/audits/s1"), done.audit)


def test_compaction_leaves_packed_directories_alone(spark, folder):
    bronze = sales.bronze_table(folder)
    wide = spark.range(1, 3001).select(
        F.col("id").cast("int").alias("id_venda"),
        F.sha2(F.col("id").cast("string"), 512).alias("cliente"),
        F.lit("p").alias("produto"),
        F.lit(1.0).alias("valor"),
        F.lit("2024-06-15").alias("data_venda"),
        F.lit("SP").alias("estado"),
    )
    jobs.ingest_bronze(spark, wide, bronze, RUN)
    tiny = wide.limit(3).withColumn("data_venda", F.lit("2024-06-16"))
    for i in range(3):
        jobs.ingest_bronze(spark, tiny, bronze, Run(f"t{i}", RUN.ts, RUN.as_of))
    packed = data_files(tables.run_path(bronze, RUN.id))
    assert tables.compact(spark, bronze, "packed", small=100_000)
    assert data_files(tables.run_path(bronze, RUN.id)) == packed
    assert {r["location"] for r in tables.file_sizes(spark, bronze).collect()} == {
        tables.location_of(RUN.id),
        tables.location_of("packed"),
    }
    assert tables.read(spark, bronze).count() == 3009
    gone = {r["run_id"] for r in tables.superseded(spark, bronze).collect()}
    assert gone == {"t0", "t1", "t2"}


def test_bronze_can_be_compacted_and_appended_to_again(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    for i in range(3):
        jobs.ingest_bronze(spark, raw, bronze, Run(f"b{i}", RUN.ts, RUN.as_of))
    assert tables.file_summary(spark, bronze)["files"] == 9
    assert tables.compact(spark, bronze, "packed")
    assert tables.file_summary(spark, bronze)["files"] == 3
    assert jobs.ingest_bronze(spark, raw, bronze, LATER).rows.count() == 20


# --- pipeline


def test_two_runs_double_silver_and_report_duplicates(spark, folder, raw):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    first = jobs.run_pipeline(spark, raw, bronze, silver)
    second = jobs.run_pipeline(spark, raw, bronze, silver)

    def measure(audit, metric):
        return audit.where(F.col("metric") == metric).first()["value"]

    assert (measure(first.audit, "rows"), measure(first.audit, "duplicates")) == (5, 0)
    assert (measure(second.audit, "rows"), measure(second.audit, "duplicates")) == (10, 5)
    total = sales.silver_metrics(second.rows).first()
    assert total["revenue"] == pytest.approx(1561.58) and total["quality_pct"] == 100.0
    loads = second.rows.select("bronze_load_id", "silver_load_id").distinct().collect()
    assert len(loads) == 2 and len({r["silver_load_id"] for r in loads}) == 1


def test_an_empty_delivery_publishes_nothing(spark, folder, raw):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    first = jobs.run_pipeline(spark, raw.limit(0), bronze, silver)
    assert (first.ok, first.rows, tables.read(spark, bronze).count()) == (False, None, 0)
    assert jobs.monitor_bronze(spark, bronze, RUN).first()["total_rows"] == 0
    second = jobs.run_pipeline(spark, raw, bronze, silver)
    assert second.ok and second.rows.count() == 5


def test_failed_ingest_stops_the_refresh(spark, folder, raw):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    jobs.run_pipeline(spark, raw, bronze, silver, RUN, Run("s1", RUN.ts, RUN.as_of))
    wrong = raw.withColumn("id_venda", F.lit("one"))
    with pytest.raises(SchemaConflict):
        jobs.run_pipeline(spark, wrong, bronze, silver, LATER, Run("s2", RUN.ts, RUN.as_of))
    assert {r["silver_load_id"] for r in tables.read(spark, silver).collect()} == {"s1"}


def test_audit_rows_are_stored_with_the_run(spark, folder, raw):
    silver = sales.silver_table(folder)
    done = jobs.refresh_silver(spark, sales.stamp_bronze(raw, RUN), silver, LATER)
    stored = spark.read.parquet(f"{silver.path}/audits/r2")
    assertDataFrameEqual(stored, done.audit)
    measures = stored.where("metric NOT IN ('rows_read', 'rows_kept')")
    assertDataFrameEqual(measures, sales.quality_report(done.rows))


def test_caller_settings_are_put_back(spark, folder, raw):
    mine = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.parquet.outputTimestampType": "INT96",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "3",
    }
    with settings(spark, mine):
        jobs.ingest_bronze(spark, raw, sales.bronze_table(folder), RUN)
        assert {key: spark.conf.get(key) for key in mine} == mine
        with pytest.raises(ZeroDivisionError), settings(spark, {list(mine)[2]: "7"}):
            raise ZeroDivisionError
        assert {key: spark.conf.get(key) for key in mine} == mine
    unset = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(unset, None) is None
