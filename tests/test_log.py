"""The table log: what a commit costs, what a reader opens, what repeats find."""

import gzip
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.testing import assertDataFrameEqual

from helpers import plan_text, scanned_rows
from smeltery.plans import jobs, sales
from smeltery.run import Run
from smeltery.session import settings
from smeltery.sources import files, log, tables
from smeltery.sources.log import Part, Stats
from smeltery.sources.tables import Table
from test_refine import GOLDEN, RUN

DAY = 86_400_000_000
COLUMNS = StructType.fromJson({"type": "struct", "fields": []}).add("a", "integer").add("t", "timestamp")


def part(i, location=None, day=None):
    at = (day if day is not None else i) * DAY
    stats = Stats(10, {"a": i % 3, "t": 0}, {"t": (at, at + 5)}, {"sum:a": 2.5, "max:a": float(i)})
    return Part(location or tables.location_of(f"r{i}"), 2, stats)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(GOLDEN, sales.RAW)


def sizes_of(path, pattern):
    return [p.stat().st_size for p in sorted(Path(path).glob(pattern))]


def test_a_thousand_commits(spark, folder):
    version, opened = None, []
    for i in range(1_000):
        version = log.commit(spark, folder, version, f"r{i}", "append", [part(i)], [], COLUMNS)
        if i % 97 == 0 or i % log.SNAPSHOT_EVERY in (30, 31):
            seen = log.current(spark, folder)
            opened.append(seen.opened)
            assert seen.seq == version.seq == i + 1 and seen.parts == version.parts
    assert max(opened) <= log.SNAPSHOT_EVERY + 1
    entries = sizes_of(folder, "log/entries/*.json")
    assert len(entries) == 1_000 and max(entries[1:]) < min(entries[1:]) + 30 < entries[0]
    snapshots = sorted(Path(folder).glob("log/snapshots/*.gz"))
    assert len(snapshots) == log.SNAPSHOTS_KEPT
    # A part is some 25 bytes of a snapshot, so what is kept grows by less than an entry a load.
    assert sum(p.stat().st_size for p in snapshots) < 1_000 * log.SNAPSHOTS_KEPT * 40 < sum(entries)
    assert log.merged(version.parts).rows == 10_000
    assert log.logged(spark, folder, "r500")["seq"] == 501 and log.logged(spark, folder, "r1000") is None


def test_removals_and_replacements_survive_a_snapshot(spark, folder, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 4)
    version = None
    for i in range(6):
        version = log.commit(spark, folder, version, f"r{i}", "append", [part(i)], [], COLUMNS)
    gone = [p.location for p in version.parts[:3]]
    packed = Part("runs/__run=c", 2, log.merged(version.parts[:3]))
    version = log.commit(spark, folder, version, "c", "compact", [packed], gone, COLUMNS)
    wider = StructType(COLUMNS.fields).add("b", "string")
    for i in range(6, 9):
        version = log.commit(spark, folder, version, f"r{i}", "append", [part(i)], [], wider, i)
    seen = log.current(spark, folder)
    assert seen.parts == version.parts and seen.schema == wider and seen.source_seq == 8
    assert seen.locations[:4] == [tables.location_of(x) for x in ("r3", "r4", "r5", "c")]
    assert seen.parts[3].stats == Stats(
        30, {"a": 3, "t": 0}, {"t": (0, 2 * DAY + 5)}, {"sum:a": 7.5, "max:a": 2.0}
    )
    version = log.commit(spark, folder, version, "p", "publish", [part(99)], None, COLUMNS)
    assert log.current(spark, folder).locations == [tables.location_of("r99")]
    assert log.current(spark, folder).source_seq is None


def test_a_commit_that_another_writer_made_is_refused(spark, folder):
    first = log.commit(spark, folder, None, "r1", "append", [part(1)], [], COLUMNS)
    log.commit(spark, folder, first, "r2", "append", [part(2)], [], COLUMNS)
    with pytest.raises(log.ConcurrentCommit):
        log.commit(spark, folder, first, "r3", "append", [part(3)], [], COLUMNS)
    assert log.logged(spark, folder, "r3") is None
    assert log.current(spark, folder).locations == [tables.location_of(x) for x in ("r1", "r2")]


def test_a_lost_snapshot_costs_opens_and_nothing_else(spark, folder, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 4)
    monkeypatch.setattr(log, "_keep_snapshot", lambda spark, path, version: version)
    version = None
    for i in range(9):
        version = log.commit(spark, folder, version, f"r{i}", "append", [part(i)], [], COLUMNS)
    monkeypatch.undo()
    assert log.current(spark, folder).opened == 9
    log.commit(spark, folder, log.current(spark, folder), "r9", "append", [part(9)], [], COLUMNS)
    assert log.current(spark, folder).seq == 10


def test_statistics_add_up():
    a = Stats(5, {"x": 1}, {"t": None}, {"max:v": float("nan"), "sum:v": None})
    b = Stats(7, {"x": 0, "y": 2}, {"t": (3, 4)}, {"max:v": 8.0, "sum:v": 2})
    both = log.merged([Part("a", 1, a), Part("b", 2, b)])
    assert (both.rows, both.nulls, both.spans) == (12, {"x": 1, "y": 7}, {"t": (3, 4)})
    assert both.measures["max:v"] != both.measures["max:v"] and both.measures["sum:v"] == 2
    assert log.merged([Part("a", 1, a), Part("c", 1)]) is None
    assert log.merged([]).rows == 0


def test_files_beside_a_table(spark, folder):
    path = f"{folder}/a b/x.json"
    assert files.read(spark, path) is None and files.names(spark, folder) == []
    assert files.write(spark, path, b"1") and not files.write(spark, path, b"2")
    assert files.read(spark, path) == b"1"
    assert files.write(spark, path, gzip.compress(b"3"), replace=True)
    assert gzip.decompress(files.read(spark, path)) == b"3"
    assert files.names(spark, f"{folder}/a b") == ["x.json"]
    assert files.total_length(spark, folder) == len(gzip.compress(b"3"))
    files.delete(spark, path)
    assert not files.exists(spark, path)


# --- what is counted with every load


def counted(spark, table):
    return [p.stats for p in tables.current(spark, table).parts]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("rebalance", [True, False])
def test_loads_log_what_a_scan_finds(spark, folder, raw, fmt, rebalance):
    bronze = sales.bronze_table(folder, fmt)
    odd = raw.withColumns(
        {
            "produto": F.expr("nullif(produto, 'Produto B')"),
            "data_venda": F.expr("if(id_venda = 1, '', if(id_venda = 2, NULL, data_venda))"),
            "valor": F.expr("if(id_venda = 4, double('NaN'), valor)"),
            "more.or less": F.expr("if(id_venda = 3, NULL, array(1))"),
        }
    )
    jobs.ingest_bronze(spark, odd, bronze, RUN, rebalance=rebalance)
    (stats,) = counted(spark, bronze)
    version = tables.current(spark, bronze)
    assert stats == tables.recounted(spark, bronze, version.locations[0], version.schema)
    assert (stats.rows, stats.nulls["data_venda"], stats.nulls["produto"]) == (5, 2, 2)
    micros = int(RUN.ts.timestamp()) * 1_000_000
    assert stats.spans == {"bronze_load_timestamp": (micros, micros)}


def test_a_count_that_the_files_contradict_is_made_again(spark, folder, raw, monkeypatch):
    written = tables._write

    def twice(*args, **kwargs):
        stats = written(*args, **kwargs)
        return Stats(2 * stats.rows, stats.nulls, stats.spans, stats.measures)

    monkeypatch.setattr(tables, "_write", twice)
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    done = jobs.run_pipeline(spark, raw, bronze, silver, RUN, Run("s1", RUN.ts, RUN.as_of))
    assert counted(spark, bronze)[0].rows == counted(spark, silver)[0].rows == 5
    found = {r["metric"]: r["value"] for r in done.audit.where("field = '*'").collect()}
    assert found == {"rows": 5, "rows_read": 5, "rows_kept": 5}


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_the_monitor_opens_no_file(spark, folder, raw, fmt):
    bronze = sales.bronze_table(folder, fmt)
    for i in range(3):
        run = Run(f"b{i}", RUN.ts + timedelta(days=i), RUN.as_of + timedelta(days=i))
        wider = raw if i < 2 else raw.withColumn("canal", F.expr("nullif(produto, 'Produto B')"))
        jobs.ingest_bronze(spark, wider, bronze, run)
    monitor = jobs.monitor_bronze(spark, bronze, run)
    assert scanned_rows(monitor) == []
    assertDataFrameEqual(monitor, sales.bronze_monitor(tables.read(spark, bronze), run))
    assert (monitor.first()["loaded_rows"], monitor.first()["canal"]) == (5, 12)
    tables.compact(spark, bronze, "packed")
    packed = jobs.monitor_bronze(spark, bronze, run)
    assertDataFrameEqual(packed, sales.bronze_monitor(tables.read(spark, bronze), run))


def test_the_monitor_counts_a_load_that_a_day_cuts(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    mixed = sales.stamp_bronze(raw, RUN).withColumn(
        "bronze_load_timestamp",
        F.expr("if(id_venda = 1, NULL, bronze_load_timestamp + make_dt_interval(id_venda - 2))"),
    )
    tables.append(spark, mixed, bronze, "mixed")
    for day in range(-1, 5):
        run = Run("x", RUN.ts, RUN.as_of + timedelta(days=day))
        monitor = jobs.monitor_bronze(spark, bronze, run)
        assertDataFrameEqual(monitor, sales.bronze_monitor(tables.read(spark, bronze), run))
    assert monitor.first()["bronze_load_timestamp"] == 1


def test_days_are_those_of_the_session(spark, folder, raw):
    bronze = sales.bronze_table(folder)
    late = Run("late", RUN.ts.replace(hour=23, minute=30), RUN.as_of)
    jobs.ingest_bronze(spark, raw, bronze, late)
    for zone, day, n in (("UTC", 0, 5), ("America/Sao_Paulo", 0, 5), ("+02:00", 0, 0), ("Asia/Tokyo", 1, 5)):
        with settings(spark, {"spark.sql.session.timeZone": zone}):
            run = Run("x", late.ts, late.as_of + timedelta(days=day))
            assert jobs.monitor_bronze(spark, bronze, run).first()["loaded_rows"] == n, zone
            assert jobs.loaded_on(spark, bronze, run.as_of).count() == n


# --- loads chosen before files are listed


@pytest.fixture
def thousand(spark, folder, raw):
    """A thousand logged loads, of which two are there: to list any other one is an error."""
    bronze = sales.bronze_table(folder)
    day = Run("day", RUN.ts + timedelta(days=500), RUN.as_of + timedelta(days=500))
    last = Run("last", RUN.ts + timedelta(days=1_000), RUN.as_of + timedelta(days=1_000))
    version = None
    for i in range(998):
        at = int((RUN.ts + timedelta(days=i + (i >= 500))).timestamp()) * 1_000_000
        stats = Stats(5, {}, {sales.LOADED_AT: (at, at)})
        missing = Part(tables.location_of(f"r{i}"), len(sales.BRONZE), stats)
        version = log.commit(spark, bronze.path, version, f"r{i}", "append", [missing], [], sales.BRONZE)
    for run in (day, last):
        tables.append(spark, sales.stamp_bronze(raw, run), bronze, run.id)
    return bronze, day, last


def paths_of(df):
    return {f.rpartition("/runs/")[2].split("/")[0] for f in df.inputFiles()}


def test_a_day_and_the_latest_rows_list_one_load_of_a_thousand(spark, thousand, raw):
    bronze, day, last = thousand
    rows = jobs.loaded_on(spark, bronze, day.as_of)
    assert paths_of(rows) == {"__run=day"} and "1 paths" in plan_text(rows)
    assertDataFrameEqual(rows, sales.stamp_bronze(raw, day))
    latest = jobs.latest_loads(spark, bronze)
    assert paths_of(latest) == {"__run=last"}
    assert latest.count() == 5
    assert jobs.monitor_bronze(spark, bronze, day).first()["total_rows"] == 5_000
    assert jobs.loaded_on(spark, bronze, day.as_of + timedelta(days=5_000)).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.read(spark, bronze)


@pytest.mark.parametrize("k", [1, 5, 6, 12, 40])
def test_latest_rows_need_as_many_loads_as_hold_them(spark, folder, raw, k):
    bronze = sales.bronze_table(folder)
    for i in (2, 0, 3, 1):
        jobs.ingest_bronze(spark, raw, bronze, Run(f"b{i}", RUN.ts + timedelta(hours=i), RUN.as_of))
    same = Run("same", RUN.ts + timedelta(hours=3), RUN.as_of)
    jobs.ingest_bronze(spark, raw, bronze, same)
    nowhen = sales.stamp_bronze(raw, RUN).withColumn("bronze_load_timestamp", F.expr("CAST(NULL AS TIMESTAMP)"))
    tables.append(spark, nowhen, bronze, "nowhen")
    expected = sales.latest_loads(tables.read(spark, bronze), k)
    found = jobs.latest_loads(spark, bronze, k)
    assert found.select(*sales.RAW.names).collect() == expected.select(*sales.RAW.names).collect()
    loads = len(paths_of(tables.read_newest(spark, bronze, sales.LOADED_AT, k)))
    assert loads == {1: 2, 5: 2, 6: 2, 12: 3, 40: 6}[k]


def test_loads_of_unknown_span_are_read(spark, folder, raw):
    plain = Table(f"{folder}/plain")
    stamped = sales.stamp_bronze(raw, RUN)
    tables.append(spark, stamped, plain, "r1")
    assert jobs.loaded_on(spark, plain, RUN.as_of).count() == 5
    assert jobs.latest_loads(spark, plain).count() == 5
    assert jobs.monitor_bronze(spark, plain, RUN).first()["loaded_rows"] == 5


# --- repeats


SILVER_RUN = Run("s1", RUN.ts, RUN.as_of)
STEPS = {
    "bronze write": (tables, "_write", 1),
    "bronze count": (tables, "stored_rows", 1),
    "bronze entry": (log, "commit", 1),
    "silver write": (tables, "_write", 2),
    "audit": (tables, "keep_audit", 1),
    "silver entry": (log, "commit", 2),
    "view": (sales, "register_view", 1),
}


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_pipeline_broken_at_any_step_is_repeated(spark, folder, raw, monkeypatch, step, after):
    module, name, at = STEPS[step]
    kept, calls = getattr(module, name), []

    def breaks(*args, **kwargs):
        calls.append(name)
        if len(calls) == at and not after:
            raise RuntimeError("lost")
        done = kept(*args, **kwargs)
        if len(calls) == at:
            raise RuntimeError("lost")
        return done

    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    # What an earlier attempt with more rows left behind must not stay.
    monkeypatch.setattr(module, name, breaks)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_pipeline(spark, raw, bronze, silver, RUN, SILVER_RUN)
    monkeypatch.undo()
    for _ in range(2):
        done = jobs.run_pipeline(spark, raw, bronze, silver, RUN, SILVER_RUN)
        expected = sales.stamp_silver(sales.to_silver(sales.stamp_bronze(raw, RUN)), SILVER_RUN)
        assert done.ok and done.load.rows.count() == 5
        assertDataFrameEqual(done.rows, expected)
        assertDataFrameEqual(tables.read(spark, silver), expected)
        assert done.audit.where("metric IN ('rows', 'rows_read') AND value = 5").count() == 2
        assert done.audit.where("metric = 'duplicates'").first()["value"] == 0
    assert len(log.entries(spark, bronze.path).collect()) == 1


def test_a_rejected_refresh_can_be_repeated(spark, folder, raw):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    empty = jobs.run_pipeline(spark, raw.limit(0), bronze, silver, RUN, SILVER_RUN)
    assert not empty.ok
    more = Run("b2", RUN.ts, RUN.as_of)
    again = jobs.run_pipeline(spark, raw, bronze, silver, more, SILVER_RUN)
    assert again.ok and again.rows.count() == 5
    assert again.audit.where("metric = 'rows' AND value = 5").count() == 1


# --- silver extended by the new loads


RUN_COLUMNS = ("silver_load_timestamp", "silver_load_id")


def full(spark, bronze):
    return sales.stamp_silver(sales.to_silver(tables.read(spark, bronze)), SILVER_RUN)


def test_extended_silver_equals_a_full_refresh(spark, folder, raw):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    for i in range(4):
        load = Run(f"b{i}", RUN.ts + timedelta(hours=i), RUN.as_of)
        some = raw.withColumn("id_venda", F.col("id_venda") + 3 * i)
        jobs.ingest_bronze(spark, some, bronze, load)
        if i == 2:
            tables.compact(spark, bronze, "packed")
        done = jobs.extend_silver(spark, bronze, silver, Run(f"s{i}", load.ts, load.as_of))
        assert done.ok and len(tables.current(spark, silver).parts) == i + 1
        assertDataFrameEqual(done.rows.drop(*RUN_COLUMNS), full(spark, bronze).drop(*RUN_COLUMNS))
        measures = done.audit.where("metric NOT IN ('rows_read', 'rows_kept')")
        assertDataFrameEqual(measures, sales.quality_report(done.rows))
        assert done.audit.where("metric = 'rows_read'").first()["value"] == 5 * (i + 1)
    runs = done.rows.select("bronze_load_id", "silver_load_id").distinct().collect()
    assert sorted(map(tuple, runs)) == [(f"b{i}", f"s{i}") for i in range(4)]
    idle = jobs.extend_silver(spark, bronze, silver, Run("s9", RUN.ts, RUN.as_of))
    assert idle.ok and len(tables.current(spark, silver).parts) == 4
    assertDataFrameEqual(idle.audit, done.audit)


def test_extending_reads_the_new_load_alone(spark, folder, raw, monkeypatch):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    seen = []
    kept = sales.to_silver
    monkeypatch.setattr(sales, "to_silver", lambda df: seen.append(paths_of(df)) or kept(df))
    for i in range(3):
        jobs.ingest_bronze(spark, raw, bronze, Run(f"b{i}", RUN.ts, RUN.as_of))
        jobs.extend_silver(spark, bronze, silver, Run(f"s{i}", RUN.ts, RUN.as_of))
    assert seen == [{"__run=b0"}, {"__run=b1"}, {"__run=b2"}]


def test_extending_after_a_load_that_cleaning_removes(spark, folder, raw):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    jobs.run_pipeline(spark, raw, bronze, silver, RUN, SILVER_RUN)
    jobs.ingest_bronze(spark, raw.withColumn("valor", F.lit(-1.0)), bronze, Run("b2", RUN.ts, RUN.as_of))
    done = jobs.extend_silver(spark, bronze, silver, Run("s2", RUN.ts, RUN.as_of))
    assert done.ok and done.rows.count() == 5
    assert done.audit.where("metric = 'rows_read'").first()["value"] == 10


def test_what_is_not_an_added_load_is_refreshed_whole(spark, folder, raw):
    bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
    jobs.ingest_bronze(spark, raw, bronze, RUN)
    jobs.refresh_silver(spark, tables.read(spark, bronze), silver, SILVER_RUN)  # notes no commit
    jobs.ingest_bronze(spark, raw, bronze, Run("b2", RUN.ts, RUN.as_of))
    done = jobs.extend_silver(spark, bronze, silver, Run("s2", RUN.ts, RUN.as_of))
    assert done.rows.count() == 10 and len(tables.current(spark, silver).parts) == 1
    stamped = sales.stamp_bronze(raw, RUN)
    tables.stage(stamped, bronze, "b3")
    tables.publish(spark, bronze, "b3", stamped.schema)
    done = jobs.extend_silver(spark, bronze, silver, Run("s3", RUN.ts, RUN.as_of))
    assert done.rows.count() == 5 and len(tables.current(spark, silver).parts) == 1
