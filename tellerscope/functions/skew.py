"""Joins and reductions that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscope.functions.sizing import input_bytes

# Below this input size a hot key cannot fill a task and is not looked for.
LOOK_FOR_SKEW_BYTES = 8 << 30
WAYS = 64
_HIT, _L, _R = "__hit", "__lsalt", "__rsalt"


def heavy_keys(df: DataFrame, columns: Sequence[str], support: float = 0.01) -> dict[str, list]:
    """Keys that may hold more than ``support`` of the rows, per column.

    One pass with a bounded summary (at most ``1 / support`` keys per column): no
    heavy key is missed, and a key listed without need only costs a few copies.
    NULL is left out; it never joins and is spread by ``skew_join`` itself.
    """
    found = df.select(*columns).freqItems(list(columns), support).first()
    return {c: [k for k in found[f"{c}_freqItems"] if k is not None] for c in columns}


def skew_hints(
    df: DataFrame, columns: Sequence[str], min_bytes: int | None = None
) -> dict[str, list] | None:
    """Heavy keys of a large batch input; ``None`` where the input is small.

    A stream cannot be looked through ahead: no key is named, so ``skew_join`` spreads
    only the rows without a key.
    """
    if df.isStreaming:
        return {c: [] for c in columns}
    min_bytes = LOOK_FOR_SKEW_BYTES if min_bytes is None else min_bytes
    if input_bytes(df.select(*columns)) < min_bytes:
        return None
    return heavy_keys(df, columns)


def _spread(ways: int, columns: Iterable[str]) -> Column:
    # A hash of row content, not rand(): a retried task must give the same salt.
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(ways)).cast("int")


def _all_cells(is_hot: Column, ways: int) -> Column:
    every = F.array(*[F.lit(i) for i in range(ways)])
    return F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    right_key: str | None = None,
    hot_left: Sequence | None = None,
    hot_right: Sequence | None = None,
    spread_by: Sequence[str] = (),
    ways: int = WAYS,
) -> DataFrame:
    """Equi-join on one key with exact handling of heavy keys.

    ``how`` is inner, left, left_semi or left_anti. With neither list given this is a
    plain join (AQE still splits what turns out skewed). Otherwise rows of a heavy
    left key are spread over ``ways`` cells and the matching right rows copied to
    each, and the other way round for a heavy right key; every matching pair still
    meets in exactly one cell. Left rows without a key are spread as well.
    """
    right_key = right_key or key
    if right_key != key:
        right = right.withColumnRenamed(right_key, key)
    existence = how in ("left_semi", "left_anti")
    if hot_left is None and hot_right is None:
        return left.join(right.select(key) if existence else right, key, how)

    hot_left = list(hot_left or [])
    if existence:
        # One row per key is enough on the right, combined before its shuffle.
        right, hot_right = right.select(key).distinct(), []
    hot_right = list(hot_right or [])
    right = right.filter(F.col(key).isNotNull())
    in_left = F.coalesce(F.col(key).isin(hot_left), F.lit(False)) if hot_left else F.lit(False)
    in_right = F.coalesce(F.col(key).isin(hot_right), F.lit(False)) if hot_right else F.lit(False)
    spread_left = list(spread_by) or [c for c in left.columns if c != key][:4] or [key]
    spread_right = [c for c in right.columns if c != key] or [key]

    # pmod(hash, 1) is always 0 but not a constant to the optimizer: a constant salt
    # would be folded out of the join keys and gather the NULL keys in one task again.
    rest = F.pmod(F.hash(F.col(key)), F.lit(1)).cast("int")
    on = [key, _L]
    left_salt = F.when(in_left | F.col(key).isNull(), _spread(ways, spread_left)).otherwise(rest)
    left = left.withColumn(_L, left_salt)
    right = right.withColumn(_L, _all_cells(in_left, ways) if hot_left else rest)
    if hot_right:
        on.append(_R)
        left = left.withColumn(_R, _all_cells(in_right, ways))
        right = right.withColumn(
            _R, F.when(in_right, _spread(ways, spread_right)).otherwise(F.lit(0))
        ).withColumn(_HIT, F.lit(True))
    joined = left.join(right, on, how)
    if how == "left" and hot_right:
        # A heavy right key exists on the right, so a copy of a left row that met
        # nothing in its cell is an artefact; its partners are in other cells.
        joined = joined.filter(~(in_right & F.col(_HIT).isNull()))
    return joined.drop(_L, _R, _HIT)


def one_per_key(df: DataFrame, key: str, order: Sequence[str], newest: bool = True) -> DataFrame:
    """The first or last row per key.

    An aggregate, not a ranking window: rows of a heavy key are reduced to one per
    task before the shuffle. Columns of ``order`` may hold NULL (lowest).
    """
    pick = F.max_by if newest else F.min_by
    rest = [c for c in df.columns if c != key]
    row = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    # The key stays a plain grouping column, so a filter on it still reaches the scan.
    picked = df.groupBy(key).agg(row.alias("__row"))
    return picked.select(*[F.col(c) if c == key else F.col(f"__row.{c}") for c in df.columns])
