"""The sales rule set: names and thresholds, and the operators applied with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from smeltery.operators import quality, refine, reports, summary
from smeltery.run import Run
from smeltery.sources.log import Stats
from smeltery.sources.summaries import Summary
from smeltery.sources.tables import Table


def _schema(**columns: str) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


# Column names, types, labels and thresholds that users of these tables rely on.

_RAW = dict(
    id_venda="integer",
    cliente="string",
    produto="string",
    valor="double",
    data_venda="string",
    estado="string",
)
RAW = _schema(**_RAW)
BRONZE = _schema(
    **_RAW,
    bronze_load_timestamp="timestamp",
    bronze_load_id="string",
    bronze_source_system="string",
    bronze_file_name="string",
    bronze_is_deleted="boolean",
)
SILVER = _schema(
    id_venda="integer",
    cliente_normalizado="string",
    produto="string",
    valor="double",
    valor_com_desconto="double",
    categoria_valor="string",
    data_venda_date="date",
    ano_venda="integer",
    mes_venda="integer",
    estado="string",
    bronze_load_id="string",
    silver_load_timestamp="timestamp",
    silver_load_id="string",
    silver_quality_score="integer",
)

SILVER_CONTROL = ("silver_load_timestamp", "silver_load_id", "silver_quality_score")
SILVER_COLUMNS = tuple(c for c in SILVER.names if c not in SILVER_CONTROL)
CRITICAL_FIELDS = ("id_venda", "cliente_normalizado", "valor", "data_venda_date")
BANDS = ((100, "Baixo"), (200, "Médio"))
TOP_BAND = "Alto"
BAND_LABELS = (*[label for _, label in BANDS], TOP_BAND)
DISCOUNT_ABOVE = 200
DISCOUNT_FACTOR = 0.9
QUALITY_SCORE = 100
QUALITY_AT_LEAST = 90
SOURCE_SYSTEM = "sistema_vendas"
FILE_NAME = "api_vendas_daily"
SILVER_VIEW = "vendas_silver"
LOADED_AT = "bronze_load_timestamp"


def bronze_table(root: str, fmt: str = "parquet") -> Table:
    return Table(f"{root}/bronze/vendas", ("data_venda",), fmt, (LOADED_AT,))


def silver_table(root: str, fmt: str = "parquet") -> Table:
    return Table(f"{root}/silver/vendas_transformadas", ("ano_venda", "mes_venda"), fmt)


# --- bronze


def stamp_bronze(
    df: DataFrame, run: Run, source_system: str = SOURCE_SYSTEM, file_name: str = FILE_NAME
) -> DataFrame:
    return refine.stamp(
        df,
        bronze_load_timestamp=run.ts,
        bronze_load_id=run.id,
        bronze_source_system=source_system,
        bronze_file_name=file_name,
        bronze_is_deleted=False,
    )


def bronze_monitor(df: DataFrame, run: Run) -> DataFrame:
    return reports.bronze_monitor(df, LOADED_AT, run.as_of)


def latest_loads(df: DataFrame, k: int = 5) -> DataFrame:
    return reports.latest_rows(df, LOADED_AT, RAW.names, k)


# --- silver


def clean_rules() -> dict[str, Column]:
    return {
        "has an id": F.col("id_venda").isNotNull(),
        "is worth something": F.col("valor") > 0,
        "has a customer": F.col("cliente").isNotNull(),
        "is not deleted": ~F.col("bronze_is_deleted"),
    }


def clean(df: DataFrame) -> DataFrame:
    return refine.clean(df, clean_rules())


def enrich(df: DataFrame) -> DataFrame:
    return (
        df.transform(
            refine.with_date_parts,
            text="data_venda",
            date="data_venda_date",
            year="ano_venda",
            month="mes_venda",
        )
        .transform(
            refine.with_discount, "valor", "valor_com_desconto", DISCOUNT_ABOVE, DISCOUNT_FACTOR
        )
        .transform(refine.with_band, "valor", "categoria_valor", BANDS, TOP_BAND)
        .transform(refine.with_normalised_name, "cliente", "cliente_normalizado")
    )


def to_silver(bronze: DataFrame) -> DataFrame:
    """Clean, enrich and select: the silver columns without this run's control columns."""
    return enrich(clean(bronze)).select(*SILVER_COLUMNS)


def stamp_silver(df: DataFrame, run: Run, score: int = QUALITY_SCORE) -> DataFrame:
    return refine.stamp(
        df,
        silver_load_timestamp=run.ts,
        silver_load_id=run.id,
        silver_quality_score=score,
    )


def quality_report(silver: DataFrame) -> DataFrame:
    return quality.quality_report(
        silver, CRITICAL_FIELDS, key="id_venda", value="valor", band="categoria_valor"
    )


def audit_measures() -> dict[str, Column]:
    return quality.audit_measures("valor", "categoria_valor", BAND_LABELS)


def staged_audit(
    rows: DataFrame, stats: Stats, bronze: DataFrame, rows_read: int | None, stored: Observation
) -> DataFrame:
    """The audit of rows counted while they were written: one scan of their keys is left to do.

    ``stored`` gets the number of rows scanned, to be held against the count.
    """
    lines = quality.audit_of_counts(stats, CRITICAL_FIELDS, "valor", "categoria_valor", BAND_LABELS)
    read = quality.rows_read_line(bronze, rows_read)
    duplicates = quality.duplicate_line(rows, "id_venda", stored)
    if lines is None:
        report = quality.with_rows_read(quality_report(rows), bronze)
        return report.where("metric <> 'duplicates'").unionByName(duplicates)
    return quality.report_of(rows, lines).unionByName(duplicates).unionByName(read)


def state_category_report(silver: DataFrame) -> DataFrame:
    return reports.revenue_report(
        silver,
        by=("estado", "categoria_valor"),
        value="valor",
        count="total_vendas",
        total="receita_total",
        average="ticket_medio",
    )


def top_states(silver: DataFrame, k: int = 3) -> DataFrame:
    return reports.top_groups(silver, "estado", "valor", "receita", k)


def silver_metrics(silver: DataFrame) -> DataFrame:
    return reports.silver_metrics(silver, "valor", "silver_quality_score", QUALITY_AT_LEAST)


def silver_monitor(silver: DataFrame, k: int = 3) -> DataFrame:
    return reports.silver_monitor(
        silver, "estado", "valor", "silver_quality_score", QUALITY_AT_LEAST, k
    )


def silver_summary() -> Summary:
    """Silver by state and band: what the report, the top states and the monitor add up."""
    by = ("estado", "categoria_valor")
    return Summary(
        "estado_categoria",
        lambda rows: summary.summarise(
            rows, by, "valor", "silver_quality_score", QUALITY_AT_LEAST
        ),
        lambda groups: summary.added_up(groups, by),
    )


def state_category_of_summary(groups: DataFrame) -> DataFrame:
    return summary.revenue_report(
        groups,
        by=("estado", "categoria_valor"),
        count="total_vendas",
        total="receita_total",
        average="ticket_medio",
    )


def top_states_of_summary(groups: DataFrame, k: int = 3) -> DataFrame:
    return summary.top_groups(groups, "estado", "receita", k)


def silver_monitor_of_summary(groups: DataFrame, k: int = 3) -> DataFrame:
    return summary.monitor(groups, "estado", k)


def register_view(silver: DataFrame, name: str = SILVER_VIEW) -> DataFrame:
    """Make the silver rows available to ``spark.sql`` under ``name``."""
    silver.createOrReplaceTempView(name)
    return silver.sparkSession.table(name)
