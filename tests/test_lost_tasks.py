"""Tasks that die after doing part of their work are run again; no row is lost or doubled."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

# Retries have to be allowed when the session starts, so this needs a session of its own.
SCRIPT = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from smeltery.operators import quality
from smeltery.plans import jobs, sales
from smeltery.sources import tables

spark = (
    SparkSession.builder.master("local[4,3]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
folder = sys.argv[1]


def dies_once(batches):
    context = TaskContext.get()
    for i, batch in enumerate(batches):
        if i == 2 and context.attemptNumber() == 0 and context.partitionId() % 2:
            raise RuntimeError("lost")
        yield batch


rows = spark.range(0, 4000, 1, 4).select(
    F.col("id").cast("int").alias("id_venda"),
    F.lit("name").alias("cliente"),
    F.lit("p").alias("produto"),
    F.lit(10.0).alias("valor"),
    F.concat(F.lit("2024-06-1"), F.col("id") % 4).alias("data_venda"),
    F.lit("SP").alias("estado"),
)
unreliable = rows.mapInPandas(dies_once, sales.RAW)
bronze, silver = sales.bronze_table(folder), sales.silver_table(folder)
done = jobs.run_pipeline(spark, unreliable, bronze, silver)
assert done.ok
stored = tables.read(spark, bronze)
assert stored.count() == 4000 and stored.select("id_venda").distinct().count() == 4000
assert done.rows.count() == 4000
assert quality.duplicate_count(done.rows, "id_venda").first()["duplicates"] == 0

loaded, refreshed = (tables.current(spark, t).parts[0].stats for t in (bronze, silver))
assert loaded.rows == refreshed.rows == 4000 and loaded.nulls["id_venda"] == 0
assert refreshed.measures["sum:total"] == 40000.0

direct = sales.stamp_bronze(unreliable, jobs.Run.start(spark))
again = jobs.refresh_silver(spark, direct, silver, jobs.Run.start(spark), rebalance=False)
assert again.ok and again.rows.count() == 4000
measures = tables.current(spark, silver).parts[0].stats.measures
assert measures["sum:total"] == 40000.0 and measures["sum:valued"] == 4000
assert quality.duplicate_count(again.rows, "id_venda").first()["duplicates"] == 0
print("whole")
"""


def test_retried_tasks_write_each_row_once(folder):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, folder],
        cwd=ROOT,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.stdout.strip().endswith("whole"), done.stderr[-3000:]
