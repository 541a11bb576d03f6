"""Row-wise rules, one edge row each."""

import math
import random
import re
from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from smeltery.functions import strict_date
from smeltery.operators import quality, refine
from smeltery.plans import sales
from smeltery.run import Run
from smeltery.session import settings

# The rows on which the expected results are defined.
GOLDEN = [
    (1, "João Silva", "Produto A", 150.50, "2024-06-15", "SP"),
    (2, "Maria Santos", "Produto B", 89.90, "2024-06-15", "RJ"),
    (3, "Pedro Costa", "Produto A", 150.50, "2024-06-16", "MG"),
    (4, "Ana Lima", "Produto C", 299.99, "2024-06-16", "SP"),
    (5, "Carlos Souza", "Produto B", 89.90, "2024-06-17", "RS"),
]
RUN = Run("r1", datetime(2024, 6, 18, 9, tzinfo=timezone.utc), date(2024, 6, 18))
BASE = dict(
    id_venda=1, cliente="x", produto="p", valor=10.0, data_venda="2024-06-15", estado="SP"
)


@pytest.fixture
def bronze(spark):
    def build(**changes):
        row = tuple((BASE | {k: v for k, v in changes.items() if k in BASE}).values())
        deleted = changes.get("bronze_is_deleted", False)
        raw = sales.stamp_bronze(spark.createDataFrame([row], sales.RAW), RUN)
        return raw.withColumn("bronze_is_deleted", F.lit(deleted).cast("boolean"))

    return build


def test_golden_rows(spark):
    silver = sales.to_silver(sales.stamp_bronze(spark.createDataFrame(GOLDEN, sales.RAW), RUN))
    got = silver.orderBy("id_venda").select(
        "id_venda",
        "cliente_normalizado",
        "valor_com_desconto",
        "categoria_valor",
        "data_venda_date",
        "ano_venda",
        "mes_venda",
        "bronze_load_id",
    )
    assert [tuple(r) for r in got.collect()] == [
        (1, "João Silva", 150.5, "Médio", date(2024, 6, 15), 2024, 6, "r1"),
        (2, "Maria Santos", 89.9, "Baixo", date(2024, 6, 15), 2024, 6, "r1"),
        (3, "Pedro Costa", 150.5, "Médio", date(2024, 6, 16), 2024, 6, "r1"),
        (4, "Ana Lima", 269.99100000000004, "Alto", date(2024, 6, 16), 2024, 6, "r1"),
        (5, "Carlos Souza", 89.9, "Baixo", date(2024, 6, 17), 2024, 6, "r1"),
    ]


def test_schemas_are_the_contracts(spark):
    stamped = sales.stamp_bronze(spark.createDataFrame(GOLDEN, sales.RAW), RUN)
    silver = sales.stamp_silver(sales.to_silver(stamped), RUN)

    def nullable(schema):
        return StructType([StructField(f.name, f.dataType) for f in schema.fields])

    assert nullable(stamped.schema) == sales.BRONZE
    assert nullable(silver.schema) == sales.SILVER


def test_control_columns_hold_the_run(spark):
    row = sales.stamp_bronze(spark.createDataFrame(GOLDEN[:1], sales.RAW), RUN, "s", "f").first()
    assert row["bronze_load_timestamp"].replace(tzinfo=timezone.utc) == RUN.ts
    assert (row["bronze_load_id"], row["bronze_is_deleted"]) == ("r1", False)
    assert (row["bronze_source_system"], row["bronze_file_name"]) == ("s", "f")


def test_fresh_runs_differ_and_use_the_session_day(spark):
    one, two = Run.start(spark), Run.start(spark)
    assert one.id != two.id and one.ts <= two.ts
    assert one.as_of == one.ts.date()  # the test session's zone is UTC


@pytest.mark.parametrize("zone", ["Pacific/Kiritimati", "Pacific/Pago_Pago"])
def test_the_runs_day_follows_the_session_zone(spark, zone):
    with settings(spark, {"spark.sql.session.timeZone": zone}):
        run = Run.start(spark)
    assert run.as_of == run.ts.astimezone(ZoneInfo(zone)).date()


@pytest.mark.parametrize(
    "field, value",
    [
        ("id_venda", None),
        ("cliente", None),
        ("valor", None),
        ("valor", -1.0),
        ("valor", 0.0),
        ("bronze_is_deleted", True),
        ("bronze_is_deleted", None),
    ],
)
def test_rows_that_cleaning_drops(bronze, field, value):
    rows = bronze(**{field: value})
    assert sales.clean(rows).count() == 0
    counts = quality.clean_counts(rows, sales.clean_rules()).first()
    assert (counts["rows_in"], counts["rows_kept"]) == (1, 0)


@pytest.mark.parametrize(
    "value, band, reduced",
    [
        (0.01, "Baixo", 0.01),
        (100.0, "Baixo", 100.0),
        (100.01, "Médio", 100.01),
        (200.0, "Médio", 200.0),
        (200.01, "Alto", 180.009),
        (math.inf, "Alto", math.inf),
    ],
)
def test_bands_and_discount(bronze, value, band, reduced):
    row = sales.to_silver(bronze(valor=value)).first()
    assert row["categoria_valor"] == band
    assert row["valor_com_desconto"] == pytest.approx(reduced, rel=1e-12)


def test_nan_is_kept_as_the_top_band(bronze):
    row = sales.to_silver(bronze(valor=math.nan)).first()
    assert row["categoria_valor"] == "Alto" and math.isnan(row["valor_com_desconto"])


def test_null_value_alone_falls_to_the_top_band(bronze):
    row = sales.enrich(bronze(valor=None)).first()
    assert (row["categoria_valor"], row["valor_com_desconto"]) == ("Alto", None)


@pytest.mark.parametrize(
    "text, name",
    [
        ("", ""),
        (" ", ""),
        ("  joão SILVA ", "João Silva"),
        ("ana-maria d'água", "Ana-maria D'água"),
        ("a  b", "A  B"),
        ("\tx y", "\tx Y"),
    ],
)
def test_names(bronze, text, name):
    assert sales.to_silver(bronze(cliente=text)).first()["cliente_normalizado"] == name


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "text",
    [
        "2024-02-30",
        "2024-6-5",
        "",
        " 2024-06-15",
        "2024-06-15 ",
        "2024-06-15 10:00:00",
        "abc",
        None,
    ],
)
def test_bad_dates_are_kept_without_a_date(spark, bronze, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        silver = sales.to_silver(bronze(data_venda=text))
        row = silver.first()
        nulls = quality.critical_nulls(silver, sales.CRITICAL_FIELDS).first()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert (row["data_venda_date"], row["ano_venda"], row["mes_venda"]) == (None, None, None)
    assert nulls["data_venda_date"] == 1


def test_leap_day(bronze):
    row = sales.to_silver(bronze(data_venda="2024-02-29")).first()
    assert (row["data_venda_date"], row["ano_venda"], row["mes_venda"]) == (
        date(2024, 2, 29),
        2024,
        2,
    )


def test_rules_may_be_any_predicates(spark):
    numbers = spark.range(10)
    rules = {"even": F.col("id") % 2 == 0, "small": F.col("id") < 5}
    assert [r["id"] for r in refine.clean(numbers, rules).collect()] == [0, 2, 4]


def test_strict_dates_equal_the_pattern_parser(spark):
    """Mutated dates, within the years that the parser itself can represent."""
    source = random.Random(7)
    seeds = ["2024-06-15", "0000-01-01", "9999-12-31", "+12024-06-15", "-0001-01-01", "2024-6-5",
             "+2024-06-15", "12024-06-15", "2024-06-5T", "      2024", " 2024-06-5", "2023-02-29",
             "+00040-01-01", "-00071-01-01", "-00000-01-01", "1582-10-10", "２０２４-06-15"]
    texts = set(seeds)
    for _ in range(20_000):
        chars = list(source.choice(seeds))
        for _ in range(source.randint(1, 3)):
            at = source.randrange(len(chars))
            chars[at : at + source.randint(0, 1)] = source.choice("0123456789-- +T:Z\t\n/a")
        texts.add("".join(chars))
    texts = [t for t in texts if not re.search(r"\d{6,}-", t)]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    both = rows.select("t", strict_date(F.col("t")).alias("ours"),
                       F.try_to_date("t", "yyyy-MM-dd").alias("parser"))
    assert both.where("ours IS NOT NULL").count() > 100
    assert both.where("NOT ours <=> parser").collect() == []


def test_far_years_do_not_fail(spark):
    rows = spark.createDataFrame([("+999999999-01-01",), ("+5881581-01-01",)], "t STRING")
    assert rows.select(strict_date(F.col("t")).alias("d")).where("d IS NOT NULL").count() == 0


def test_other_date_patterns(spark):
    rows = spark.createDataFrame([("15/06/2024",), ("2024-06-15",)], "t STRING")
    got = rows.select(strict_date(F.col("t"), "dd/MM/yyyy").alias("d")).collect()
    assert [r["d"] for r in got] == [date(2024, 6, 15), None]
