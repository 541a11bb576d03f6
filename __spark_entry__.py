"""

All queries run over whole tables. Those on ``sales`` read ``events`` through one SELECT that
both engines understand; it renames the columns and plants the faults the refinement has to
handle (NULL ids, names and values, negative values, impossible dates, repeated ids, deleted
rows) without leaving a row out.

Double sums depend on the order of addition, so results that hold them are rounded on both sides.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from smeltery.operators import quality, refine, reports
from smeltery.plans import jobs, sales
from smeltery.run import Run
from smeltery.sources import summaries, tables
from smeltery.sources.raw import read_raw

SALES = """
SELECT
  CASE WHEN event_id % 50 = 0 THEN NULL
       WHEN event_id % 30 = 1 THEN event_id - 1
       ELSE event_id END AS id_venda,
  CASE WHEN event_id % 70 = 0 THEN NULL
       ELSE concat('  ', upper(event_type), ' uSER ', CAST(user_id AS STRING), ' ') END AS cliente,
  event_type AS produto,
  CASE WHEN event_id % 40 = 0 THEN -value
       WHEN event_id % 45 = 0 THEN NULL
       ELSE value END AS valor,
  CASE WHEN event_id % 60 = 7 THEN '2024-02-30'
       ELSE CAST(CAST(ts AS DATE) AS STRING) END AS data_venda,
  CASE CAST(user_id % 4 AS INT) WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'MG' ELSE 'RS'
       END AS estado,
  ts AS bronze_load_timestamp,
  event_id % 90 = 3 AS bronze_is_deleted,
  'load-1' AS bronze_load_id
FROM {events}
"""

DAY = date(2024, 1, 15)
BRONZE_RUN = Run("load-1", datetime(2024, 1, 15, 12, tzinfo=timezone.utc), DAY)
SECOND_RUN = Run("load-2", datetime(2024, 1, 15, 13, tzinfo=timezone.utc), DAY)
NEXT_DAY_RUN = Run("load-2", datetime(2024, 1, 16, 13, tzinfo=timezone.utc), date(2024, 1, 16))
SILVER_RUN = Run("silver-1", datetime(2024, 1, 16, 12, tzinfo=timezone.utc), DAY)
LATER_SILVER_RUN = Run("silver-2", datetime(2024, 1, 16, 13, tzinfo=timezone.utc), DAY)
try:  # the package works without these, and without what they need
    import corpus_pipeline
    from smeltery.llm import queries as llm
except ImportError:
    llm = None

RAW = sales.RAW.names
LINEITEM = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


# --- inputs


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SALES, events=load(spark, sf_dir, "events"))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_rows(spark, sf_dir).select(*RAW)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.to_silver(sales_rows(spark, sf_dir))


def stamped_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.stamp_silver(silver(spark, sf_dir), SILVER_RUN)


def scored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows with scores on both sides of the threshold, from the rows themselves."""
    score = (F.pmod("id_venda", F.lit(7)) * 20).cast("int")
    return stamped_silver(spark, sf_dir).withColumn("silver_quality_score", score)


def scratch(spark: SparkSession) -> str:
    """A new directory in the folder the session shares between executors.

    Where no folder is named, and driver and executors are one process, one is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base}/smeltery-{uuid.uuid4()}"


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def utc_clock(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, the only kind of timestamp the SQL side has."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    to_utc = partial(F.convert_timezone, F.current_timezone(), F.lit("UTC"))
    return df.withColumns({c: to_utc(F.col(c).cast("timestamp_ntz")) for c in instants})


# --- operators on the sales rows


def cleaned(spark, sf_dir):
    return sales.clean(sales_rows(spark, sf_dir)).select(*RAW)


def clean_counts(spark, sf_dir):
    return quality.clean_counts(sales_rows(spark, sf_dir), sales.clean_rules())


def parsed_dates(spark, sf_dir):
    dated = refine.with_date_parts(
        sales_rows(spark, sf_dir), "data_venda", "data_venda_date", "ano_venda", "mes_venda"
    )
    return dated.select("id_venda", "data_venda_date", "ano_venda", "mes_venda")


def discounted(spark, sf_dir):
    out = refine.with_discount(
        sales_rows(spark, sf_dir),
        "valor",
        "valor_com_desconto",
        sales.DISCOUNT_ABOVE,
        sales.DISCOUNT_FACTOR,
    )
    return out.select("id_venda", "valor_com_desconto")


def banded(spark, sf_dir):
    out = refine.with_band(
        sales_rows(spark, sf_dir), "valor", "categoria_valor", sales.BANDS, sales.TOP_BAND
    )
    return out.select("id_venda", "categoria_valor")


def names_normalised(spark, sf_dir):
    out = refine.with_normalised_name(
        sales_rows(spark, sf_dir), "cliente", "cliente_normalizado"
    )
    return out.select("id_venda", "cliente_normalizado")


def enriched(spark, sf_dir):
    return sales.enrich(sales.clean(sales_rows(spark, sf_dir)))


def bronze_stamped(spark, sf_dir):
    return utc_clock(sales.stamp_bronze(raw_sales(spark, sf_dir), BRONZE_RUN))


def run_ids(spark, sf_dir):
    """Two runs that choose their own ids: one id of the usual form on all rows of a run."""
    rows = raw_sales(spark, sf_dir)
    first, second = (sales.stamp_bronze(rows, Run.start(spark)) for _ in range(2))
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return first.unionByName(second).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("bronze_load_id").rlike(form)).alias("well_formed"),
        F.count_distinct("bronze_load_id").alias("run_ids"),
    )


def preview_found(spark, sf_dir):
    """Any five rows, as a preview shows them; which ones is undecided, but they are silver rows."""
    columns = ["id_venda", "cliente_normalizado", "valor"]
    shown, rows = silver(spark, sf_dir).limit(5), silver(spark, sf_dir)
    known = shown.join(rows.select(columns), columns, "left_semi")
    return known.agg(F.count(F.lit(1)).alias("found"))


def state_category_report(spark, sf_dir):
    report = sales.state_category_report(silver(spark, sf_dir))
    return rounded(report, receita_total=2, ticket_medio=4)


def state_category_sql(spark, sf_dir):
    sales.register_view(silver(spark, sf_dir))
    return spark.sql(
        f"""
        SELECT estado, categoria_valor, count(*) AS total_vendas,
               round(sum(valor), 2) AS receita_total, round(avg(valor), 4) AS ticket_medio
        FROM {sales.SILVER_VIEW}
        GROUP BY ALL ORDER BY receita_total DESC, estado, categoria_valor
        """
    )


def quality_report(spark, sf_dir):
    return rounded(sales.quality_report(stamped_silver(spark, sf_dir)), value=4)


# --- stored tables


def bronze_roundtrip(spark, sf_dir):
    bronze = sales.bronze_table(scratch(spark))
    return utc_clock(
        jobs.ingest_bronze(spark, raw_sales(spark, sf_dir), bronze, BRONZE_RUN).rows
    )


def bronze_evolved(spark, sf_dir):
    bronze, raw = sales.bronze_table(scratch(spark)), raw_sales(spark, sf_dir)
    jobs.ingest_bronze(spark, raw, bronze, BRONZE_RUN)
    wider = raw.withColumn("canal", F.col("produto"))
    return utc_clock(jobs.ingest_bronze(spark, wider, bronze, SECOND_RUN).rows)


def bronze_monitor_stored(spark, sf_dir, fmt="parquet"):
    bronze, raw = sales.bronze_table(scratch(spark), fmt), raw_sales(spark, sf_dir)
    jobs.ingest_bronze(spark, raw, bronze, BRONZE_RUN)
    return jobs.ingest_bronze(spark, raw, bronze, NEXT_DAY_RUN).monitor


def bronze_evolved_monitor(spark, sf_dir):
    """A column that only the second load has; the first load's rows are NULL there."""
    bronze, raw = sales.bronze_table(scratch(spark)), raw_sales(spark, sf_dir)
    jobs.ingest_bronze(spark, raw, bronze, BRONZE_RUN)
    wider = raw.withColumn("canal", F.col("produto"))
    return jobs.ingest_bronze(spark, wider, bronze, NEXT_DAY_RUN).monitor


def bronze_repeated_load(spark, sf_dir):
    """A load that is repeated under its run id is refused, and its rows are there once."""
    bronze, raw = sales.bronze_table(scratch(spark)), raw_sales(spark, sf_dir)
    jobs.ingest_bronze(spark, raw, bronze, BRONZE_RUN)
    try:
        jobs.ingest_bronze(spark, raw, bronze, BRONZE_RUN)
    except tables.RunAlreadyLogged:
        return utc_clock(tables.read(spark, bronze))
    raise AssertionError("the repeated load was accepted")


def bronze_compacted(spark, sf_dir):
    """Three loads, then compaction: all rows, in fewer files than before."""
    bronze, raw = sales.bronze_table(scratch(spark)), raw_sales(spark, sf_dir)
    third = Run("load-3", SECOND_RUN.ts, SECOND_RUN.as_of)
    for run in (BRONZE_RUN, SECOND_RUN, third):
        jobs.ingest_bronze(spark, raw, bronze, run)
    return compacted(spark, bronze)


def compacted(spark, table):
    before = tables.file_summary(spark, table)["files"]
    tables.compact(spark, table, "packed")
    merged = tables.file_summary(spark, table)["files"] < before
    return utc_clock(tables.read(spark, table)).withColumn("files_merged", F.lit(merged))


def latest_loads_stored(spark, sf_dir):
    bronze, raw = sales.bronze_table(scratch(spark)), raw_sales(spark, sf_dir)
    jobs.ingest_bronze(spark, raw, bronze, BRONZE_RUN)
    return utc_clock(jobs.ingest_bronze(spark, raw, bronze, SECOND_RUN).latest)


def loaded_on_date_stored(spark, sf_dir):
    """Three loads on two days; those of the first day are chosen from the log."""
    bronze, raw = sales.bronze_table(scratch(spark)), raw_sales(spark, sf_dir)
    third = Run("load-3", NEXT_DAY_RUN.ts, NEXT_DAY_RUN.as_of)
    for run in (BRONZE_RUN, SECOND_RUN, third):
        jobs.ingest_bronze(spark, raw, bronze, run)
    return utc_clock(jobs.loaded_on(spark, bronze, DAY))


def silver_extended(spark, sf_dir):
    """Two loads, each added to silver by a run that refines that load alone."""
    root, raw = scratch(spark), raw_sales(spark, sf_dir)
    bronze, target = sales.bronze_table(root), sales.silver_table(root)
    for load, run in ((BRONZE_RUN, SILVER_RUN), (SECOND_RUN, LATER_SILVER_RUN)):
        jobs.ingest_bronze(spark, raw, bronze, load)
        done = jobs.extend_silver(spark, bronze, target, run)
    return utc_clock(done.rows)


def summarised(spark, sf_dir):
    """Two loads in two parts of silver, the groups of each kept beside it and added up."""
    root, raw = scratch(spark), raw_sales(spark, sf_dir)
    bronze, target = sales.bronze_table(root), sales.silver_table(root)
    for load, run in ((BRONZE_RUN, SILVER_RUN), (SECOND_RUN, LATER_SILVER_RUN)):
        jobs.ingest_bronze(spark, raw, bronze, load)
        jobs.extend_silver(spark, bronze, target, run)
        summaries.keep(spark, target, sales.silver_summary())
    return summaries.read(spark, target, sales.silver_summary())


def state_category_summary(spark, sf_dir):
    report = sales.state_category_of_summary(summarised(spark, sf_dir))
    return rounded(report, receita_total=2, ticket_medio=4)


def silver_roundtrip(spark, sf_dir, fmt="parquet", rebalance=True):
    target = sales.silver_table(scratch(spark), fmt)
    done = jobs.refresh_silver(spark, sales_rows(spark, sf_dir), target, SILVER_RUN, rebalance)
    return utc_clock(done.rows)


def silver_audit(spark, sf_dir):
    target = sales.silver_table(scratch(spark))
    audit = jobs.refresh_silver(spark, sales_rows(spark, sf_dir), target, SILVER_RUN).audit
    return rounded(audit, value=4)


def silver_published(spark, sf_dir):
    """A refresh that fails its audit leaves the published rows as they were."""
    target, bronze = sales.silver_table(scratch(spark)), sales_rows(spark, sf_dir)
    jobs.refresh_silver(spark, bronze, target, SILVER_RUN)
    all_deleted = bronze.withColumn("bronze_is_deleted", F.lit(True))
    rejected = jobs.refresh_silver(spark, all_deleted, target, LATER_SILVER_RUN)
    return utc_clock(rejected.rows).withColumn("later_run_ok", F.lit(rejected.ok))


def silver_schema_replaced(spark, sf_dir):
    """Publishing replaces the schema: a column only the earlier version had is gone."""
    target, rows = sales.silver_table(scratch(spark)), stamped_silver(spark, sf_dir)
    earlier = rows.withColumn("valor", F.col("valor").cast("string")).withColumn("x", F.lit(1))
    for run, version in ((SILVER_RUN, earlier), (LATER_SILVER_RUN, rows)):
        tables.stage(version, target, run.id)
        tables.publish(spark, target, run.id, version.schema)
    return utc_clock(tables.read(spark, target))


def silver_compacted(spark, sf_dir):
    """Many small files per month, then compaction: same rows."""
    target, rows = sales.silver_table(scratch(spark)), stamped_silver(spark, sf_dir)
    scattered = rows.repartition(16, "id_venda")
    tables.stage(scattered, target, SILVER_RUN.id, rebalance=False)
    tables.publish(spark, target, SILVER_RUN.id, scattered.schema)
    return compacted(spark, target)


def raw_json_read(spark, sf_dir):
    delivered = f"{scratch(spark)}/delivered"
    raw = raw_sales(spark, sf_dir)
    raw.write.json(delivered)
    return read_raw(spark, delivered, raw.schema, "json")


def pipeline_two_runs(spark, sf_dir):
    """Delivering the same rows twice doubles silver and is reported as duplicates."""
    root, raw = scratch(spark), raw_sales(spark, sf_dir)
    bronze, target = sales.bronze_table(root), sales.silver_table(root)
    jobs.run_pipeline(spark, raw, bronze, target, BRONZE_RUN, SILVER_RUN)
    second = jobs.run_pipeline(spark, raw, bronze, target, SECOND_RUN, LATER_SILVER_RUN)
    found = second.audit.where(F.col("metric").isin("rows", "duplicates"))
    return found.select("metric", F.col("value").cast("bigint").alias("found"))


def pipeline_resumed(spark, sf_dir):
    """A refresh that died before its audit: the pipeline is repeated under the same run ids, twice."""
    root, raw = scratch(spark), raw_sales(spark, sf_dir)
    bronze, target = sales.bronze_table(root), sales.silver_table(root)
    stored = jobs.ingest_bronze(spark, raw, bronze, BRONZE_RUN).rows
    partial_rows = sales.to_silver(stored.where("id_venda % 2 = 0"))
    tables.stage(sales.stamp_silver(partial_rows, SILVER_RUN), target, SILVER_RUN.id)
    for _ in range(2):
        done = jobs.run_pipeline(spark, raw, bronze, target, BRONZE_RUN, SILVER_RUN)
    counts = done.audit.where(F.col("metric").isin("rows_read", "rows", "duplicates"))
    stands = done.rows.agg(F.count(F.lit(1)).cast("double").alias("value"))
    stands = stands.select(F.lit("stored").alias("metric"), "value")
    return counts.select("metric", "value").unionByName(stands)


# --- the same operators on other tables


def customer_refined(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    rules = {"key": F.col("c_custkey").isNotNull(), "in credit": F.col("c_acctbal") > 0}
    kept = refine.clean(customer, rules)
    discounted = refine.with_discount(kept, "c_acctbal", "reduced", 5000, 0.9)
    banded = refine.with_band(
        discounted, "c_acctbal", "band", ((1000, "low"), (5000, "middle")), "high"
    )
    named = refine.with_normalised_name(banded, "c_mktsegment", "segment")
    return named.select("c_custkey", "reduced", "band", "segment")


def lineitem_null_profile(spark, sf_dir):
    return quality.null_profile(load(spark, sf_dir, "lineitem"), total="total_rows")


def lineitem_duplicate_orders(spark, sf_dir):
    return quality.duplicate_count(load(spark, sf_dir, "lineitem"), "l_orderkey")


def lineitem_revenue(spark, sf_dir):
    report = reports.revenue_report(
        load(spark, sf_dir, "lineitem"),
        by=("l_returnflag", "l_linestatus"),
        value="l_extendedprice",
        count="line_count",
        total="revenue",
        average="mean_price",
    )
    return rounded(report, revenue=1, mean_price=3)


def lineitem_top_suppliers(spark, sf_dir):
    top = reports.top_groups(
        load(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", "revenue", 10
    )
    return rounded(top, revenue=1)


def orders_quality_report(spark, sf_dir):
    report = quality.quality_report(
        load(spark, sf_dir, "orders"),
        fields=("o_orderkey", "o_custkey", "o_totalprice"),
        key="o_custkey",
        value="o_totalprice",
        band="o_orderstatus",
    )
    return rounded(report, value=3)


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by state and value band over the refined sales rows."""
    return state_category_report(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {} if llm is None else llm.queries() | {"pipeline": corpus_pipeline.run}
    return more | {
        "bronze_stamped": bronze_stamped,
        "cleaned": cleaned,
        "clean_counts": clean_counts,
        "parsed_dates": parsed_dates,
        "discounted": discounted,
        "banded": banded,
        "names_normalised": names_normalised,
        "enriched": enriched,
        "silver": silver,
        "silver_stamped": lambda s, d: utc_clock(stamped_silver(s, d)),
        "run_ids": run_ids,
        "preview_found": preview_found,
        "null_profile": lambda s, d: quality.null_profile(sales_rows(s, d)),
        "critical_nulls": lambda s, d: quality.critical_nulls(silver(s, d), sales.CRITICAL_FIELDS),
        "duplicate_count": lambda s, d: quality.duplicate_count(silver(s, d), "id_venda"),
        "value_stats": lambda s, d: rounded(
            quality.value_stats(silver(s, d), "valor"), average=4
        ),
        "category_distribution": lambda s, d: reports.row_distribution(
            silver(s, d), "categoria_valor"
        ),
        "state_category_report": state_category_report,
        "state_category_sql": state_category_sql,
        "top_states": lambda s, d: rounded(sales.top_states(silver(s, d)), receita=2),
        "silver_metrics": lambda s, d: rounded(
            sales.silver_metrics(scored_silver(s, d)), revenue=2
        ),
        "silver_monitor": lambda s, d: rounded(
            sales.silver_monitor(scored_silver(s, d)), revenue=2
        ),
        "quality_share": lambda s, d: quality.quality_share(
            scored_silver(s, d), "silver_quality_score", sales.QUALITY_AT_LEAST
        ),
        "quality_report": quality_report,
        "bronze_monitor": lambda s, d: reports.bronze_monitor(
            sales_rows(s, d), "bronze_load_timestamp", DAY
        ),
        "loaded_on_date": lambda s, d: reports.loaded_on(
            sales_rows(s, d), "bronze_load_timestamp", DAY
        ),
        "latest_rows": lambda s, d: reports.latest_rows(
            sales_rows(s, d), "bronze_load_timestamp", RAW
        ),
        "raw_json_read": raw_json_read,
        "bronze_roundtrip": bronze_roundtrip,
        "bronze_evolved": bronze_evolved,
        "bronze_monitor_stored": bronze_monitor_stored,
        "bronze_evolved_monitor": bronze_evolved_monitor,
        "bronze_repeated_load": bronze_repeated_load,
        "bronze_compacted": bronze_compacted,
        "latest_loads_stored": latest_loads_stored,
        "loaded_on_date_stored": loaded_on_date_stored,
        "bronze_monitor_orc": lambda s, d: bronze_monitor_stored(s, d, "orc"),
        "silver_extended": silver_extended,
        "state_category_summary": state_category_summary,
        "top_states_summary": lambda s, d: rounded(
            sales.top_states_of_summary(summarised(s, d)), receita=2
        ),
        "silver_monitor_summary": lambda s, d: rounded(
            sales.silver_monitor_of_summary(summarised(s, d)), revenue=2
        ),
        "silver_roundtrip": silver_roundtrip,
        "silver_roundtrip_orc": lambda s, d: silver_roundtrip(s, d, "orc"),
        "silver_unshuffled": lambda s, d: silver_roundtrip(s, d, rebalance=False),
        "silver_audit": silver_audit,
        "silver_published": silver_published,
        "silver_schema_replaced": silver_schema_replaced,
        "silver_compacted": silver_compacted,
        "pipeline_two_runs": pipeline_two_runs,
        "pipeline_resumed": pipeline_resumed,
        "customer_refined": customer_refined,
        "lineitem_null_profile": lineitem_null_profile,
        "lineitem_duplicate_orders": lineitem_duplicate_orders,
        "lineitem_revenue": lineitem_revenue,
        "lineitem_top_suppliers": lineitem_top_suppliers,
        "orders_quality_report": orders_quality_report,
    }


# --- the same results in SQL

CLEAN_ROWS = """
SELECT * FROM sales
WHERE id_venda IS NOT NULL AND valor > 0 AND cliente IS NOT NULL AND NOT bronze_is_deleted
"""

SALE_DATE = """
CASE WHEN regexp_full_match(data_venda, '\\d{4}-\\d{2}-\\d{2}')
     THEN CAST(try_strptime(data_venda, '%Y-%m-%d') AS DATE) END
"""
DISCOUNTED = "CASE WHEN valor > 200 THEN valor * CAST(0.9 AS DOUBLE) ELSE valor END"
BAND = "CASE WHEN valor <= 100 THEN 'Baixo' WHEN valor <= 200 THEN 'Médio' ELSE 'Alto' END"


def _proper(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({text})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def _dates(text: str = SALE_DATE) -> str:
    return (
        f"{text} AS data_venda_date, CAST(year({text}) AS INTEGER) AS ano_venda, "
        f"CAST(month({text}) AS INTEGER) AS mes_venda"
    )


ENRICHED_ROWS = f"""
SELECT *, {_dates()}, {DISCOUNTED} AS valor_com_desconto, {BAND} AS categoria_valor,
       {_proper("cliente")} AS cliente_normalizado
FROM clean_rows
"""
SILVER_LIST = ", ".join(sales.SILVER_COLUMNS)
SILVER_STAMP = (
    "TIMESTAMP '2024-01-16 {hour}:00:00' AS silver_load_timestamp, '{run}' AS silver_load_id, "
    "CAST(100 AS INTEGER) AS silver_quality_score"
)
FIRST_STAMP = SILVER_STAMP.format(hour=12, run="silver-1")
LATER_STAMP = SILVER_STAMP.format(hour=13, run="silver-2")


def _bronze_stamp(run: str, hour: int) -> str:
    return (
        f"TIMESTAMP '2024-01-15 {hour}:00:00' AS bronze_load_timestamp, "
        f"'{run}' AS bronze_load_id, 'sistema_vendas' AS bronze_source_system, "
        "'api_vendas_daily' AS bronze_file_name, FALSE AS bronze_is_deleted"
    )


def _nulls(columns) -> str:
    return ", ".join(f'count(*) - count("{c}") AS "{c}"' for c in columns)


def _report(source: str, fields, key: str, value: str, band: str, digits: int) -> str:
    lines = [
        f"SELECT 'rows' AS metric, '*' AS field, CAST(count(*) AS DOUBLE) AS value FROM {source}",
        *[
            f"SELECT 'nulls', '{f}', CAST(count(*) - count({f}) AS DOUBLE) FROM {source}"
            for f in fields
        ],
        f"SELECT 'average', '{value}', round(avg({value}), {digits}) FROM {source}",
        f"SELECT 'maximum', '{value}', max({value}) FROM {source}",
        f"SELECT 'band_rows', {band}, CAST(count(*) AS DOUBLE) FROM {source} GROUP BY {band}",
        f"SELECT 'duplicates', '{key}', CAST(coalesce(sum(n - 1), 0) AS DOUBLE) "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})",
    ]
    return " UNION ALL ".join(lines)


def oracle_sql() -> dict[str, str]:
    sales_with = f"WITH sales AS ({SALES.format(events='events')}) "
    silver_with = (
        f"WITH sales AS ({SALES.format(events='events')}), clean_rows AS ({CLEAN_ROWS}), "
        f"enriched AS ({ENRICHED_ROWS}), silver AS (SELECT {SILVER_LIST} FROM enriched) "
    )
    raw = ", ".join(RAW)
    bronze_columns = RAW + ["bronze_load_timestamp", "bronze_is_deleted", "bronze_load_id"]
    stored_control = (
        "bronze_load_timestamp",
        "bronze_load_id",
        "bronze_source_system",
        "bronze_file_name",
        "bronze_is_deleted",
    )
    first_load, second_load = _bronze_stamp("load-1", 12), _bronze_stamp("load-2", 13)
    by_state_and_band = (
        "SELECT estado, categoria_valor, count(*) AS total_vendas, "
        "round(sum(valor), 2) AS receita_total, round(avg(valor), 4) AS ticket_medio "
        "FROM silver GROUP BY estado, categoria_valor "
        "ORDER BY receita_total DESC, estado, categoria_valor"
    )
    stamped = f"SELECT *, {FIRST_STAMP} FROM silver"
    stored_monitor = (
        f"{sales_with} SELECT 2 * count(*) AS total_rows, count(*) AS loaded_rows, "
        + ", ".join(f"2 * (count(*) - count({c})) AS {c}" for c in RAW)
        + ", "
        + ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in stored_control)
        + " FROM sales"
    )
    two_loads_with = (
        f"WITH given AS ({SALES.format(events='events')}), "
        f"sales AS (SELECT {raw}, {first_load} FROM given "
        f"UNION ALL SELECT {raw}, {second_load} FROM given), clean_rows AS ({CLEAN_ROWS}), "
        f"enriched AS ({ENRICHED_ROWS}), silver AS (SELECT {SILVER_LIST} FROM enriched) "
    )
    kept = "id_venda IS NOT NULL AND valor > 0 AND cliente IS NOT NULL"
    good_share = (
        "CAST(100.0 AS DOUBLE) * count(*) FILTER (id_venda % 7 * 20 >= 90) / count(*)"
    )
    raw_order = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW)
    audit = _report("silver", sales.CRITICAL_FIELDS, "id_venda", "valor", "categoria_valor", 4)
    more = {} if llm is None else llm.oracle_sql()
    return more | {
        "bronze_stamped": f"{sales_with} SELECT {raw}, {first_load} FROM sales",
        "cleaned": f"{silver_with} SELECT {raw} FROM clean_rows",
        "clean_counts": f"{silver_with} SELECT (SELECT count(*) FROM sales) AS rows_in, "
        "(SELECT count(*) FROM clean_rows) AS rows_kept",
        "parsed_dates": f"{sales_with} SELECT id_venda, {_dates()} FROM sales",
        "discounted": f"{sales_with} SELECT id_venda, {DISCOUNTED} AS valor_com_desconto "
        "FROM sales",
        "banded": f"{sales_with} SELECT id_venda, {BAND} AS categoria_valor FROM sales",
        "names_normalised": f"{sales_with} SELECT id_venda, "
        f"{_proper('cliente')} AS cliente_normalizado FROM sales",
        "enriched": f"{silver_with} SELECT * FROM enriched",
        "silver": f"{silver_with} SELECT * FROM silver",
        "silver_stamped": f"{silver_with} {stamped}",
        "run_ids": f"{sales_with} SELECT 2 * count(*) AS total_rows, 2 * count(*) AS well_formed, "
        "least(2, count(*)) AS run_ids FROM sales",
        "preview_found": f"{silver_with} SELECT least(5, count(*)) AS found FROM silver",
        "null_profile": f"{sales_with} SELECT {_nulls(bronze_columns)} FROM sales",
        "critical_nulls": f"{silver_with} SELECT {_nulls(sales.CRITICAL_FIELDS)} FROM silver",
        "duplicate_count": f"{silver_with} SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates "
        "FROM (SELECT count(*) AS n FROM silver GROUP BY id_venda)",
        "value_stats": f"{silver_with} SELECT round(avg(valor), 4) AS average, "
        "max(valor) AS maximum FROM silver",
        "category_distribution": f'{silver_with} SELECT categoria_valor, count(*) AS "count" '
        "FROM silver GROUP BY categoria_valor",
        "state_category_report": f"{silver_with} {by_state_and_band}",
        "state_category_sql": f"{silver_with} {by_state_and_band}",
        "top_states": f"{silver_with} SELECT estado, round(sum(valor), 2) AS receita FROM silver "
        "GROUP BY estado ORDER BY receita DESC, estado LIMIT 3",
        "silver_metrics": f"{silver_with} SELECT count(*) AS total_rows, "
        f"round(sum(valor), 2) AS revenue, {good_share} AS quality_pct FROM silver",
        "silver_monitor": f"{silver_with} SELECT * FROM (SELECT 'total' AS scope, "
        "CAST(NULL AS VARCHAR) AS estado, count(*) AS total_rows, "
        f"round(sum(valor), 2) AS revenue, {good_share} AS quality_pct FROM silver) "
        "UNION ALL SELECT * FROM (SELECT 'estado', estado, count(*), round(sum(valor), 2), "
        f"{good_share} FROM silver GROUP BY estado ORDER BY 4 DESC, 2 LIMIT 3)",
        "quality_share": f"{silver_with} SELECT {good_share} AS quality_pct FROM silver",
        "quality_report": f"{silver_with} {audit}",
        "bronze_monitor": f"{sales_with} SELECT count(*) AS total_rows, "
        "count(*) FILTER (CAST(bronze_load_timestamp AS DATE) = DATE '2024-01-15') AS loaded_rows, "
        f"{_nulls(bronze_columns)} FROM sales",
        "loaded_on_date": f"{sales_with} SELECT * FROM sales "
        "WHERE CAST(bronze_load_timestamp AS DATE) = DATE '2024-01-15'",
        "latest_rows": f"{sales_with} SELECT * FROM sales "
        f"ORDER BY bronze_load_timestamp DESC, {raw_order} LIMIT 5",
        "raw_json_read": f"{sales_with} SELECT {raw} FROM sales",
        "bronze_roundtrip": f"{sales_with} SELECT {raw}, {first_load} FROM sales",
        "bronze_evolved": f"{sales_with} SELECT {raw}, {first_load}, "
        "CAST(NULL AS VARCHAR) AS canal FROM sales "
        f"UNION ALL SELECT {raw}, {second_load}, produto FROM sales",
        "bronze_monitor_stored": stored_monitor,
        "bronze_monitor_orc": stored_monitor,
        "loaded_on_date_stored": f"{sales_with} SELECT {raw}, {first_load} FROM sales "
        f"UNION ALL SELECT {raw}, {second_load} FROM sales",
        "silver_extended": f"{two_loads_with} SELECT *, {FIRST_STAMP} FROM silver "
        f"WHERE bronze_load_id = 'load-1' UNION ALL SELECT *, {LATER_STAMP} FROM silver "
        "WHERE bronze_load_id = 'load-2'",
        "state_category_summary": f"{two_loads_with} {by_state_and_band}",
        "top_states_summary": f"{two_loads_with} SELECT estado, round(sum(valor), 2) AS receita "
        "FROM silver GROUP BY estado ORDER BY receita DESC, estado LIMIT 3",
        "silver_monitor_summary": f"{two_loads_with} SELECT * FROM (SELECT 'total' AS scope, "
        "CAST(NULL AS VARCHAR) AS estado, count(*) AS total_rows, round(sum(valor), 2) AS revenue, "
        "CAST(100 AS DOUBLE) AS quality_pct FROM silver) "
        "UNION ALL SELECT * FROM (SELECT 'estado', estado, count(*), round(sum(valor), 2), "
        "CAST(100 AS DOUBLE) FROM silver GROUP BY estado ORDER BY 4 DESC, 2 LIMIT 3)",
        "pipeline_resumed": f"{sales_with} , kept AS (SELECT id_venda FROM sales WHERE {kept}) "
        "SELECT 'rows_read' AS metric, CAST(count(*) AS DOUBLE) AS value FROM sales "
        "UNION ALL SELECT unnest(['rows', 'stored']), CAST(count(*) AS DOUBLE) FROM kept "
        "UNION ALL SELECT 'duplicates', CAST(count(*) - count(DISTINCT id_venda) AS DOUBLE) "
        "FROM kept",
        "bronze_evolved_monitor": f"{sales_with} SELECT 2 * count(*) AS total_rows, "
        "count(*) AS loaded_rows, "
        + ", ".join(f"2 * (count(*) - count({c})) AS {c}" for c in RAW)
        + ", "
        + ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in stored_control)
        + ", 2 * count(*) - count(produto) AS canal FROM sales",
        "bronze_repeated_load": f"{sales_with} SELECT {raw}, {first_load} FROM sales",
        "bronze_compacted": f"{sales_with} SELECT *, TRUE AS files_merged FROM ("
        f"SELECT {raw}, {first_load} FROM sales "
        f"UNION ALL SELECT {raw}, {second_load} FROM sales "
        f"UNION ALL SELECT {raw}, {_bronze_stamp('load-3', 13)} FROM sales)",
        "latest_loads_stored": f"{sales_with} SELECT {raw}, {second_load} FROM sales "
        f"ORDER BY {raw_order} LIMIT 5",
        "silver_roundtrip": f"{silver_with} {stamped}",
        "silver_roundtrip_orc": f"{silver_with} {stamped}",
        "silver_unshuffled": f"{silver_with} {stamped}",
        "silver_audit": f"{silver_with} {audit} "
        "UNION ALL SELECT 'rows_read', '*', CAST(count(*) AS DOUBLE) FROM sales "
        "UNION ALL SELECT 'rows_kept', '*', CAST(count(*) AS DOUBLE) FROM silver",
        "silver_published": f"{silver_with} SELECT *, {FIRST_STAMP}, FALSE AS later_run_ok "
        "FROM silver",
        "silver_schema_replaced": f"{silver_with} {stamped}",
        "silver_compacted": f"{silver_with} SELECT *, TRUE AS files_merged FROM ({stamped})",
        "pipeline_two_runs": f"{sales_with} , kept AS (SELECT id_venda FROM sales WHERE id_venda "
        "IS NOT NULL AND valor > 0 AND cliente IS NOT NULL) "
        "SELECT 'rows' AS metric, 2 * count(*) AS found FROM kept "
        "UNION ALL SELECT 'duplicates', 2 * count(*) - count(DISTINCT id_venda) FROM kept",
        "customer_refined": "SELECT c_custkey, CASE WHEN c_acctbal > 5000 "
        "THEN c_acctbal * CAST(0.9 AS DOUBLE) ELSE c_acctbal END AS reduced, "
        "CASE WHEN c_acctbal <= 1000 THEN 'low' WHEN c_acctbal <= 5000 THEN 'middle' "
        f"ELSE 'high' END AS band, {_proper('c_mktsegment')} AS segment "
        "FROM customer WHERE c_custkey IS NOT NULL AND c_acctbal > 0",
        "lineitem_null_profile": f"SELECT count(*) AS total_rows, {_nulls(LINEITEM)} FROM lineitem",
        "lineitem_duplicate_orders": "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicates "
        "FROM lineitem",
        "lineitem_revenue": "SELECT l_returnflag, l_linestatus, count(*) AS line_count, "
        "round(sum(l_extendedprice), 1) AS revenue, round(avg(l_extendedprice), 3) AS mean_price "
        "FROM lineitem GROUP BY ALL ORDER BY revenue DESC",
        "lineitem_top_suppliers": "SELECT l_suppkey, round(sum(l_extendedprice), 1) AS revenue "
        "FROM lineitem GROUP BY l_suppkey ORDER BY revenue DESC, l_suppkey LIMIT 10",
        "orders_quality_report": _report(
            "orders",
            ("o_orderkey", "o_custkey", "o_totalprice"),
            "o_custkey",
            "o_totalprice",
            "o_orderstatus",
            3,
        ),
    }
