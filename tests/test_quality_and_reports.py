import math
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from smeltery.operators import quality, reports
from smeltery.plans import sales
from smeltery.run import Run
from test_refine import GOLDEN, RUN


@pytest.fixture
def silver(spark):
    stamped = sales.stamp_bronze(spark.createDataFrame(GOLDEN, sales.RAW), RUN)
    return sales.stamp_silver(sales.to_silver(stamped), RUN)


def as_dict(report):
    return {(r["metric"], r["field"]): r["value"] for r in report.collect()}


def test_report_of_the_golden_rows(silver):
    found = as_dict(sales.quality_report(silver))
    average = found.pop(("average", "valor"))
    assert average == pytest.approx(156.158, rel=1e-12)
    assert found == {
        ("rows", "*"): 5,
        ("nulls", "id_venda"): 0,
        ("nulls", "cliente_normalizado"): 0,
        ("nulls", "valor"): 0,
        ("nulls", "data_venda_date"): 0,
        ("maximum", "valor"): 299.99,
        ("band_rows", "Baixo"): 2,
        ("band_rows", "Médio"): 2,
        ("band_rows", "Alto"): 1,
        ("duplicates", "id_venda"): 0,
    }


def test_report_of_no_rows(silver):
    report = sales.quality_report(silver.limit(0))
    assert as_dict(report) == {
        ("rows", "*"): 0,
        ("nulls", "id_venda"): 0,
        ("nulls", "cliente_normalizado"): 0,
        ("nulls", "valor"): 0,
        ("nulls", "data_venda_date"): 0,
        ("average", "valor"): None,
        ("maximum", "valor"): None,
        ("duplicates", "id_venda"): 0,
    }
    assert not quality.passes(report)


def test_findings_do_not_block(silver):
    doubled = silver.unionByName(silver).withColumn(
        "data_venda_date", F.lit(None).cast("date")
    )
    report = sales.quality_report(doubled)
    found = as_dict(report)
    assert found["duplicates", "id_venda"] == 5 and found["nulls", "data_venda_date"] == 10
    assert quality.passes(report)


def test_report_agrees_with_the_single_measures(silver):
    rows = silver.withColumn("categoria_valor", F.expr("nullif(categoria_valor, 'Baixo')"))
    found = as_dict(sales.quality_report(rows))
    stats = quality.value_stats(rows, "valor").first()
    assert found["maximum", "valor"] == stats["maximum"]
    assert found["average", "valor"] == pytest.approx(stats["average"], rel=1e-12)
    bands = {r["categoria_valor"]: r["count"] for r in
             reports.row_distribution(rows, "categoria_valor").collect()}
    assert {f: v for (m, f), v in found.items() if m == "band_rows"} == bands
    assert bands[None] == 2


def test_nan_is_the_maximum(silver):
    rows = silver.withColumn("valor", F.when(F.col("id_venda") == 1, math.nan).otherwise(1.0))
    assert math.isnan(as_dict(sales.quality_report(rows))["maximum", "valor"])


@pytest.mark.parametrize(
    "keys, expected", [([1, 1, None, None, 2], 2), ([], 0), ([7] * 100, 99), ([1, 2, 3], 0)]
)
def test_duplicates(spark, keys, expected):
    rows = spark.createDataFrame([(k,) for k in keys], "k INT")
    assert quality.duplicate_count(rows, "k").first()["duplicates"] == expected


def test_duplicates_of_a_composite_key(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "a")], "k INT, t STRING")
    assert quality.duplicate_count(rows, "k", "t", out="extra").first()["extra"] == 1


def test_null_profile_with_and_without_partitions(spark):
    rows = spark.createDataFrame(
        [(1, None, "d1"), (None, None, None), (3, "x", None)], "a INT, `b.c` STRING, day STRING"
    )
    plain, grouped = quality.null_profile(rows), quality.null_profile(rows, ["day"], total="n")
    assert plain.first().asDict() == {"a": 1, "b.c": 2, "day": 2}
    assert grouped.first().asDict() == {"n": 3, "a": 1, "b.c": 2, "day": 2}
    empty = quality.null_profile(rows.limit(0), ["day"], total="n").first()
    assert empty.asDict() == {"n": 0, "a": 0, "b.c": 0, "day": 0}


def test_quality_share(silver):
    low = silver.withColumn("silver_quality_score", F.col("id_venda") * 20 + 10)
    share = quality.quality_share(low, "silver_quality_score").first()["quality_pct"]
    assert share == 40.0
    empty = quality.quality_share(low.limit(0), "silver_quality_score").first()["quality_pct"]
    assert empty is None


def test_top_states_break_ties_by_name(silver):
    top = [(r["estado"], round(r["receita"], 2)) for r in sales.top_states(silver).collect()]
    assert top == [("SP", 450.49), ("MG", 150.5), ("RJ", 89.9)]


def test_state_category_report(silver):
    got = [tuple(r) for r in sales.state_category_report(silver).collect()]
    assert got == [
        ("SP", "Alto", 1, 299.99, 299.99),
        ("MG", "Médio", 1, 150.5, 150.5),
        ("SP", "Médio", 1, 150.5, 150.5),
        ("RJ", "Baixo", 1, 89.9, 89.9),
        ("RS", "Baixo", 1, 89.9, 89.9),
    ]


def test_report_as_sql_over_the_view(spark, silver):
    sales.register_view(silver)
    got = spark.sql(
        "SELECT estado, sum(valor) AS total FROM vendas_silver WHERE estado = 'SP' GROUP BY estado"
    ).first()
    assert got["total"] == pytest.approx(450.49)


def test_silver_monitor(silver):
    got = [tuple(r) for r in sales.silver_monitor(silver).collect()]
    assert got[0][:3] == ("total", None, 5) and got[0][4] == 100.0
    assert got[0][3] == pytest.approx(780.79)
    assert [r[1] for r in got[1:]] == ["SP", "MG", "RJ"]
    assert sales.silver_metrics(silver).first()["revenue"] == pytest.approx(780.79)


def test_silver_monitor_of_no_rows(silver):
    assert [tuple(r) for r in sales.silver_monitor(silver.limit(0)).collect()] == [
        ("total", None, 0, None, None)
    ]


def timed(spark, hours):
    rows = [(i, h) for i, h in enumerate(hours)]
    day = "timestamp'2024-06-15 00:00:00'"
    return spark.createDataFrame(rows, "id INT, h INT").select(
        "id", F.expr(f"{day} + make_interval(0, 0, 0, 0, h)").alias("at")
    )


@pytest.mark.parametrize(
    "hours, expected",
    [
        ([1, 2, 3, 4, 5, 6, 7], [6, 5, 4, 3, 2]),
        ([9] * 7, [0, 1, 2, 3, 4]),
        ([1, None, 3, None], [2, 0, 1, 3]),
        ([None] * 6, [0, 1, 2, 3, 4]),
        ([5, 5, 5, 6, 1, None], [3, 0, 1, 2, 4]),
        ([], []),
    ],
)
def test_latest_rows_equal_a_plain_sort(spark, hours, expected):
    rows = timed(spark, hours)
    got = [r["id"] for r in reports.latest_rows(rows, "at", "id").collect()]
    plain = rows.orderBy(F.desc("at"), "id").limit(5)
    assert got == expected == [r["id"] for r in plain.collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_loaded_on_uses_the_session_zone(spark, zone):
    instants = ["2024-06-14T23:59:59Z", "2024-06-15T00:00:00Z", "2024-06-15T02:59:59Z",
                "2024-06-15T03:00:00Z", "2024-06-15T23:59:59Z", "2024-06-16T02:59:59Z", None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(t,) for t in instants], "t STRING").select(
            F.col("t").cast("timestamp").alias("at")
        )
        day = date(2024, 6, 15)
        ranged = reports.loaded_on(rows, "at", day).count()
        by_cast = rows.where(F.col("at").cast("date") == F.lit(day)).count()
        monitored = reports.bronze_monitor(rows, "at", day).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ranged == by_cast == monitored["loaded_rows"] == (4 if zone == "UTC" else 3)
    assert (monitored["total_rows"], monitored["at"]) == (7, 1)


def test_monitor_counts_the_runs_day(spark):
    rows = sales.stamp_bronze(spark.createDataFrame(GOLDEN, sales.RAW), RUN)
    later = Run("r2", datetime(2024, 6, 19, tzinfo=timezone.utc), date(2024, 6, 19))
    assert sales.bronze_monitor(rows, RUN).first()["loaded_rows"] == 5
    assert sales.bronze_monitor(rows, later).first()["loaded_rows"] == 0
