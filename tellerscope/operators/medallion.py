"""Bronze to silver to gold, and the row rules in between."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscope.functions.columns import (
    BALANCES,
    balance_deltas,
    cast_balances,
    clean_countries,
    fraud_flag,
    star_except,
    to_double,
)
from tellerscope.functions.sizing import broadcast_if_small
from tellerscope.functions.skew import skew_hints, skew_join

# Columns that stop at bronze.
LANDING_ONLY = ("_rescued_data", "_metadata")
# Salt source for transactions of one hot key.
TXN_SPREAD = ("nameDest", "amount", "step")

Hints = dict[str, list] | None


def _hints(given: Hints, df: DataFrame, key: str) -> dict[str, list]:
    """Heavy keys as given by the caller (who may know there are none), else looked for."""
    return (skew_hints(df, [key]) or {}) if given is None else given


def silver(
    bronze: DataFrame, reports: DataFrame, bronze_hints: Hints = None, report_hints: Hints = None
) -> DataFrame:
    """Transactions with their fraud label, clean country codes and balance deltas.

    A transaction without a report keeps a NULL label; several reports for one id give
    several rows. ``source_file`` is kept, as the per-file counts need it.
    """
    bronze_hints = _hints(bronze_hints, bronze, "id")
    report_hints = _hints(report_hints, reports, "id")
    txns = balance_deltas(cast_balances(clean_countries(star_except(bronze, *LANDING_ONLY))))
    return skew_join(
        txns,
        reports.select("id", "is_fraud"),
        "id",
        "left",
        hot_left=bronze_hints.get("id"),
        hot_right=report_hints.get("id"),
        spread_by=[c for c in TXN_SPREAD if c in bronze.columns],
    )


def _country_side(countries: DataFrame, side: str) -> DataFrame:
    return countries.selectExpr(
        f"alpha3_code AS country{side}",
        f"country AS country{side}_name",
        f"long_avg AS countryLong{side}_long",
        f"lat_avg AS countryLat{side}_lat",
    )


def gold(
    silver: DataFrame, countries: DataFrame, customers: DataFrame, hints: Hints = None
) -> DataFrame:
    """Silver enriched with both countries and the customer.

    All three joins are inner: rows with an unknown code or customer are not in gold.
    The country table is counted here and broadcast if its rows and bytes are few; a larger one
    is shuffled.
    """
    hints = _hints(hints, silver, "customer_id")
    countries = countries.select("alpha3_code", "country", "long_avg", "lat_avg")
    if not countries.isStreaming:
        countries = broadcast_if_small(countries)
    orig, dest = _country_side(countries, "Orig"), _country_side(countries, "Dest")
    enriched = silver.join(orig, "countryOrig").join(dest, "countryDest")
    enriched = skew_join(
        enriched,
        customers.withColumnRenamed("id", "customer_id"),
        "customer_id",
        "inner",
        hot_left=hints.get("customer_id"),
        spread_by=[c for c in TXN_SPREAD if c in silver.columns],
    )
    replaced = ("amount", "countryOrig", "countryDest", "is_fraud", "source_file")
    own = [c for c in silver.columns if c not in replaced]
    return enriched.select(
        *own,
        *[c for c in customers.columns if c != "id"],
        *orig.columns,
        *dest.columns,
        to_double("amount").alias("amount"),
        fraud_flag("is_fraud").alias("is_fraud"),
    )


def gold_by_country(gold: DataFrame, country: str | None = None) -> DataFrame:
    """Gold, optionally of the customers of one country (not of the route's countries)."""
    return gold.filter(F.col("country") == country) if country else gold


def gold_unmatched(silver: DataFrame, countries: DataFrame, customers: DataFrame) -> DataFrame:
    """Silver rows each gold join loses, as (reason, rows).

    One pass: codes are looked up first, in a country table that is broadcast if it is small,
    then silver shrinks to one row of counts per customer, which is already placed for the
    customer join.
    """
    countries = broadcast_if_small(countries.select("alpha3_code"))

    def known(dim: DataFrame, key: str, name: str) -> DataFrame:
        return dim.select(F.col(key).alias(name)).distinct().withColumn(f"has_{name}", F.lit(True))

    per_customer = (
        silver.select("countryOrig", "countryDest", "customer_id")
        .join(known(countries, "alpha3_code", "countryOrig"), "countryOrig", "left")
        .join(known(countries, "alpha3_code", "countryDest"), "countryDest", "left")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr("count_if(has_countryOrig IS NULL)").alias("orig"),
            F.expr("count_if(has_countryDest IS NULL)").alias("dest"),
        )
    )
    checked = per_customer.join(known(customers, "id", "customer_id"), "customer_id", "left")
    lost = checked.agg(
        F.expr("coalesce(sum(orig), 0)").alias("orig"),
        F.expr("coalesce(sum(dest), 0)").alias("dest"),
        F.expr("coalesce(sum(if(has_customer_id IS NULL, n, 0)), 0)").alias("customer"),
    )
    return lost.selectExpr(
        "stack(3, 'unknown origin country', orig, 'unknown destination country', dest, "
        "'unknown customer', customer) AS (reason, rows)"
    )


class Rule(NamedTuple):
    name: str
    condition: str
    drop: bool = False


TXN_RULES = (
    Rule("correct_data", "id IS NOT NULL"),
    Rule("correct_customer_id", "customer_id IS NOT NULL"),
    Rule("correct_amount", "try_cast(amount AS DOUBLE) > 0", drop=True),
)


# Balances arrive as text. One that is no number becomes NULL in silver; this rule counts it.
BALANCE_RULES = (
    *TXN_RULES,
    Rule(
        "readable_balances",
        " AND ".join(f"(`{c}` IS NULL OR try_cast(`{c}` AS DOUBLE) IS NOT NULL)" for c in BALANCES),
    ),
)


def _holds(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.condition), F.lit(False))


def _counts(rules: Sequence[Rule]) -> list[Column]:
    total = F.count(F.lit(1)).alias("total_rows")
    return [total, *[F.count_if(~_holds(r)).alias(r.name) for r in rules]]


def keep_valid(df: DataFrame, rules: Sequence[Rule] = TXN_RULES) -> DataFrame:
    """Rows no dropping rule rejects. A rule that is NULL counts as broken."""
    for rule in rules:
        if rule.drop:
            df = df.filter(_holds(rule))
    return df


def apply_expectations(
    df: DataFrame, rules: Sequence[Rule] = TXN_RULES
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, metrics) with metrics (rule, on_violation, violations, total_rows)."""
    args = ", ".join(
        f"'{r.name}', '{'drop' if r.drop else 'keep'}', `{r.name}`, total_rows" for r in rules
    )
    metrics = df.agg(*_counts(rules)).select(
        F.expr(f"stack({len(rules)}, {args}) AS (rule, on_violation, violations, total_rows)")
    )
    return keep_valid(df, rules), metrics


def observe_expectations(
    df: DataFrame, name: str, rules: Sequence[Rule] = TXN_RULES
) -> DataFrame:
    """Valid rows; the rule counts arrive as observed metrics (batch or stream)."""
    first, *others = _counts(rules)
    return keep_valid(df.observe(name, first, *others), rules)
