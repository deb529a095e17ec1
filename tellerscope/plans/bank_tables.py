"""The bank's tables, derived by Spark from the star-schema test tables.

The mapping is that of FIXTURES.md. Every table is a lazy DataFrame over the parquet
files, so a query reads the columns it needs and nothing is prepared ahead.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tellerscope.functions.skew import skew_hints
from tellerscope.operators.medallion import gold, silver


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_LONG, _INT, _TEXT, _REAL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

# Known schemas spare a look into the files each time a table is opened.
SCHEMAS = {
    "orders": _struct(
        o_orderkey=_LONG, o_custkey=_LONG, o_orderstatus=_TEXT, o_totalprice=_REAL,
        o_orderdate=T.TimestampNTZType(), o_orderpriority=_TEXT,
    ),
    "customer": _struct(
        c_custkey=_LONG, c_name=_TEXT, c_nationkey=_INT, c_acctbal=_REAL, c_mktsegment=_TEXT
    ),
    "nation": _struct(n_nationkey=_INT, n_name=_TEXT, n_regionkey=_INT),
    "events": _struct(
        event_id=_LONG, ts=T.TimestampNTZType(), user_id=_LONG, event_type=_TEXT, value=_REAL,
        props=_TEXT,
    ),
}


def _code(number: str) -> str:
    return f"concat('N', lpad(cast({number} AS string), 2, '0'))"


class Bank:
    """Bank tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # The live tables turn zone-less timestamps into instants.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").where("c_custkey % 50 <> 49").selectExpr(
            "cast(c_custkey AS string) AS id",
            "concat('First', c_custkey % 40) AS firstname",
            "concat('Last', c_custkey % 90) AS lastname",
            "concat('c', c_custkey, '@example.org') AS email",
            f"{_code('c_nationkey')} AS country",
        )

    @cached_property
    def countries(self) -> DataFrame:
        return self.table("nation").where("n_nationkey < 24").selectExpr(
            "n_name AS country",
            "concat(char(65 + n_nationkey), char(65 + n_regionkey)) AS alpha2_code",
            f"{_code('n_nationkey')} AS alpha3_code",
            "n_nationkey AS numeric_code",
            "cast(n_nationkey * 3 - 36 AS double) AS lat_avg",
            "CASE WHEN n_nationkey % 10 <> 7 THEN cast(n_nationkey * 7 - 90 AS double) END AS long_avg",
        )

    @cached_property
    def reports(self) -> DataFrame:
        return self.table("orders").where("o_orderstatus <> 'P'").selectExpr(
            "cast(o_orderkey AS string) AS id",
            """CASE WHEN o_orderpriority LIKE '1%' AND o_orderkey % 5 = 0 THEN 1
                    WHEN o_orderpriority LIKE '2%' AND o_orderkey % 7 = 0 THEN 1
                    ELSE 0 END AS is_fraud""",
        )

    @cached_property
    def txn_base(self) -> DataFrame:
        orders = self.table("orders").withColumnRenamed("o_custkey", "c_custkey")
        return orders.join(self.table("customer"), "c_custkey").selectExpr(
            "o_orderkey AS k",
            """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'TRANSFER' WHEN '2' THEN 'CASH_OUT'
               WHEN '3' THEN 'CASH_IN' WHEN '4' THEN 'PAYMENT' ELSE 'DEBIT' END AS type""",
            "o_totalprice AS amount",
            "if(o_orderkey % 4 = 0, o_totalprice, o_totalprice * 4) AS oldBalanceOrig",
            "if(o_orderkey % 3 = 0, 0D, o_totalprice * 2) AS oldBalanceDest",
            "c_custkey AS o_custkey",
            "c_nationkey",
        )

    @cached_property
    def bronze(self) -> DataFrame:
        return self.txn_base.selectExpr(
            "cast(k AS string) AS id",
            "cast(k % 1000 AS int) AS step",
            "type",
            "amount",
            "cast(o_custkey AS string) AS customer_id",
            "concat('C', o_custkey) AS nameOrig",
            "concat('D', k % 997) AS nameDest",
            f"concat(if(k % 2 = 0, '--', ''), {_code('c_nationkey')}) AS countryOrig",
            f"""concat(if(k % 3 = 0, '--', ''), {_code('(k * 7 + 3) % 25')},
                       if(k % 6 = 0, '--', '')) AS countryDest""",
            "oldBalanceOrig",
            "if(type = 'CASH_IN', oldBalanceOrig + amount, oldBalanceOrig - amount) AS newBalanceOrig",
            "oldBalanceDest",
            "if(k % 7 = 0, oldBalanceDest, oldBalanceDest + amount) AS newBalanceDest",
            "concat('part-', k % 4, '.csv') AS source_file",
        )

    @cached_property
    def hints(self) -> dict[str, list]:
        """Heavy ids and customers of a large bronze table, found in one pass."""
        return skew_hints(self.bronze, ["id", "customer_id"]) or {}

    @cached_property
    def report_hints(self) -> dict[str, list]:
        return skew_hints(self.reports, ["id"]) or {}

    @cached_property
    def silver(self) -> DataFrame:
        return silver(self.bronze, self.reports, self.hints, self.report_hints)

    @cached_property
    def gold(self) -> DataFrame:
        return gold(self.silver, self.countries, self.customers, hints=self.hints)

    @cached_property
    def scored(self) -> DataFrame:
        return scored_from(self.table("events"))

    @cached_property
    def history(self) -> DataFrame:
        """Inserts of all, updates (before and after) of some, deletes of a few, in one scan."""

        def change(condition: str, name: str, offset: int, factor: int) -> str:
            fields = f"'{name}' AS _change_type, k * 10 + {offset} AS _lsn, amount * {factor} AS now"
            return f"if({condition}, struct({fields}), NULL)"

        changes = ", ".join(
            (
                change("true", "insert", 0, 1),
                change("k % 5 = 0", "update_preimage", 2, 1),
                change("k % 5 = 0", "update_postimage", 3, 2),
                change("k % 11 = 0", "delete", 5, 1),
            )
        )
        return self.txn_base.selectExpr("*", f"inline(array_compact(array({changes})))").selectExpr(
            "k AS id",
            "type",
            "now AS amount",
            "oldBalanceOrig AS old_balance_orig",
            "oldBalanceOrig - amount AS new_balance_orig",
            "oldBalanceDest AS old_balance_dest",
            "oldBalanceDest + amount AS new_balance_dest",
            "_change_type",
            "_lsn",
        )


def scored_from(events: DataFrame) -> DataFrame:
    """Scored transactions from the event table (batch or stream)."""
    return events.selectExpr(
        "event_id AS id",
        "cast(ts AS timestamp) AS timestamp",
        """CASE event_type WHEN 'error' THEN 'TRANSFER' WHEN 'purchase' THEN 'CASH_OUT'
           WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'DEBIT' ELSE 'CASH_IN' END AS type""",
        "value AS amount",
        "cast(user_id AS int) AS customer_id",
        f"{_code('user_id % 25')} AS country_orig",
        f"{_code('event_id % 25')} AS country_dest",
        "event_type = 'error' AND value >= 50 AS fraud_prediction",
        "least(value / 500, 1D) AS fraud_probability",
        "cast(ts AS timestamp) + INTERVAL 1 SECOND AS scored_at",
    )
