"""Column helpers shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BALANCES = ("newBalanceOrig", "oldBalanceOrig", "newBalanceDest", "oldBalanceDest")


def to_double(name: str) -> Column:
    """Text to double; unparseable text becomes NULL instead of failing the job."""
    return F.expr(f"try_cast(`{name}` AS double)")


def money_sum(col: Column | str) -> Column:
    """Sum of amounts as double, not rounded, and the same in any order of the rows.

    Amounts below 1e18 are summed as exact decimals with ten digits after the point. The
    others, infinities and NaN are summed as doubles and added.
    """
    amount = (F.col(col) if isinstance(col, str) else col).cast("double")
    exact = F.abs(amount) < 1e18
    small = F.sum(F.when(exact, amount).cast("decimal(28,10)")).cast("double")
    large = F.sum(F.when(~exact, amount))
    return F.when(large.isNull(), small).otherwise(large + F.coalesce(small, F.lit(0.0)))


def clean_code(name: str) -> Column:
    """Country code without any ``--`` mark."""
    return F.expr(f"replace(`{name}`, '--', '')")


def fraud_flag(col: Column | str) -> Column:
    """0/1/NULL label to boolean; no report means no fraud."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(0)).cast("boolean")


def clean_countries(df: DataFrame) -> DataFrame:
    return df.withColumns({c: clean_code(c) for c in ("countryOrig", "countryDest")})


def cast_balances(df: DataFrame) -> DataFrame:
    return df.withColumns({c: to_double(c) for c in BALANCES})


def balance_deltas(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "diffOrig": F.expr("newBalanceOrig - oldBalanceOrig"),
            "diffDest": F.expr("newBalanceDest - oldBalanceDest"),
        }
    )


def star_except(df: DataFrame, *names: str) -> DataFrame:
    """All columns but the named ones; names that are absent are ignored."""
    return df.drop(*names)
