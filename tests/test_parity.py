"""Every registered query against its SQL on the same files."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

SF = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ORDERED = {
    "state_category_report",
    "state_category_sql",
    "top_states",
    "silver_monitor",
    "silver_monitor_summary",
    "state_category_summary",
    "top_states_summary",
    "latest_rows",
    "latest_loads_stored",
    "lineitem_revenue",
    "lineitem_top_suppliers",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


# Those of the llm subpackage, where it is present, have tests of their own.
OWN = sorted(k for k in driver.queries() if not (k.startswith("op") or k == "pipeline"))


def test_every_query_has_sql():
    assert set(OWN) == set(OWN) & set(driver.oracle_sql())


def _types(table) -> dict[str, str]:
    return {field.name: str(field.type) for field in table.schema}


def _values(frame: pd.DataFrame) -> list[tuple]:
    columns = []
    for name in sorted(frame.columns):
        column = frame[name]
        missing = column.isna()
        if pd.api.types.is_datetime64_any_dtype(column) or name.endswith("_date"):
            column = pd.to_datetime(column).astype("datetime64[us]").astype(str)
        elif pd.api.types.is_bool_dtype(column):
            column = column.astype(str)
        elif pd.api.types.is_numeric_dtype(column):
            column = column.astype("float64")
        columns.append([None if m else v for v, m in zip(column.tolist(), missing, strict=True)])
    return list(zip(*columns, strict=True))


@pytest.mark.parametrize("key", OWN)
def test_matches_sql(spark, duck, key):
    ours = driver.queries()[key](spark, SF).toArrow()
    theirs = duck.sql(driver.oracle_sql()[key]).to_arrow_table()
    assert _types(ours) == _types(theirs)
    left, right = _values(ours.to_pandas()), _values(theirs.to_pandas())
    if key not in ORDERED:
        left, right = sorted(left, key=repr), sorted(right, key=repr)
    assert len(left) == len(right) > 0
    assert left == right
