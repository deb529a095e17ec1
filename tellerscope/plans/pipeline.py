"""The batch pipeline over a lake folder, and its tables as SQL views.

Steps can be rerun at any time: files are taken once, silver only gains rows whose id it
lacks, and gold is a view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tellerscope.operators.cdc import current_state
from tellerscope.operators.medallion import gold, silver
from tellerscope.schemas import BRONZE
from tellerscope.sources.files import ingest_files
from tellerscope.sources.tables import new_rows, read_target


def load_bronze(
    spark: SparkSession,
    landing: str,
    root: str,
    fmt: str = "csv",
    schema: T.StructType = BRONZE,
    include_existing: bool = True,
) -> None:
    """Take new landing files into ``root/bronze``."""
    target = f"{root}/bronze"
    ingest_files(
        spark, landing, schema, target, f"{target}-checkpoint", fmt,
        include_existing=include_existing,
    )


def load_silver(bronze: DataFrame, reports: DataFrame, root: str) -> None:
    """Append transactions that ``root/silver`` lacks.

    Rows already loaded are dropped before the label join, so a rerun shuffles only ids
    of old rows.
    """
    path = f"{root}/silver"
    target = read_target(bronze.sparkSession, path)
    fresh = bronze if target is None else new_rows(bronze, target)
    silver(fresh, reports).write.mode("append").parquet(path)


def register_views(
    spark: SparkSession,
    bronze: DataFrame,
    reports: DataFrame,
    countries: DataFrame,
    customers: DataFrame,
    silver_rows: DataFrame | None = None,
    change_log: DataFrame | None = None,
    scored: DataFrame | None = None,
) -> None:
    """Temporary views under the names the bank's SQL uses."""
    labelled = silver(bronze, reports) if silver_rows is None else silver_rows
    views = {
        "bronze_transactions": bronze,
        "fraud_reports": reports,
        "country_coordinates": countries,
        "banking_customers": customers,
        "silver_transactions": labelled,
        "gold_transactions": gold(labelled, countries, customers),
        "live_history": change_log,
        "live_transactions": None if change_log is None else current_state(change_log),
        "scored_transactions": scored,
    }
    for name, rows in views.items():
        if rows is not None:
            rows.createOrReplaceTempView(name)
