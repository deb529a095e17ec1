"""Exact values at given ranks of each group, without gathering a group in one task.

Selection by narrowing: a sketch of each group proposes two values around every wanted rank,
one pass counts what lies below, at and between them, and only the values between go on. Ties
never do, as an interval leaves out its ends. When what is left around the ranks of a group
is at most ``MOST_SORTED`` values, they are sorted. A round cuts an interval to about a
``STEPS``-th, so groups of 10**12 values take three.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscope.functions.sizing import broadcast_if_small, written

MOST_SORTED = 100_000
STEPS = 500
ACCURACY = 10_000
_TARGET = "array<struct<rank:bigint,before:bigint,inside:bigint,low:double,high:double,found:double>>"


def lower_rank(p: float) -> Callable[[Column], Column]:
    """Rank of the least value that at least a share ``p`` of ``m`` values does not exceed."""
    return lambda m: F.greatest(F.lit(1), m - F.floor(m - m * F.lit(p)))


def median_ranks() -> list[Callable[[Column], Column]]:
    """Ranks of the two middle values (the same one twice for an odd number)."""
    return [lambda m: F.floor((m + 1) / 2), lambda m: F.floor(m / 2) + 1]


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be NULL; the keys are those of ``a``."""
    renamed = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return a.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def _target(i: int) -> Column:
    return F.get("t", F.lit(i))


def _inside(i: int) -> Column:
    t, v = _target(i), F.col("value")
    above = t["low"].isNull() | (v > t["low"])
    below = t["high"].isNull() | (v < t["high"])
    return F.coalesce(t["found"].isNull() & above & below, F.lit(False))


def _large(i: int, most: int) -> Column:
    return _target(i)["found"].isNull() & (_target(i)["inside"] > most)


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str], n: int, most: int, first: bool) -> DataFrame:
    """``state`` after one round: each large interval cut around its rank, or its value found."""
    met = _same(rows, broadcast_if_small(state), keys, "inner")
    shares = [j / STEPS for j in range(STEPS + 1)]
    sketches = [  # at first all intervals are the whole group
        F.percentile_approx(F.when(_inside(i) & _large(i, most), F.col("value")), shares, ACCURACY).alias(f"q{i}")
        for i in range(1 if first else n)
    ]
    cut = _same(state, met.groupBy(*keys).agg(*sketches), keys, "left")
    for i in range(n):
        t, q = _target(i), F.col(f"q{0 if first else i}")
        at = F.floor((t["rank"] - t["before"]) * STEPS / t["inside"]).cast("int")
        low, high = (F.get(q, F.greatest(F.lit(0), F.least(F.lit(STEPS), at + d))) for d in (-1, 2))
        cut = cut.withColumns({f"low{i}": F.when(_large(i, most), low), f"high{i}": F.when(_large(i, most), high)})
    cut = written(cut.drop(*[f"q{i}" for i in range(n)]), "quantile-cuts")

    met, v = _same(rows, broadcast_if_small(cut), keys, "inner"), F.col("value")
    counts = []
    for i in range(n):
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        kinds = {"under": v < low, "at_low": v == low, "mid": (v > low) & (v < high), "at_high": (v == high) & (high > low)}
        counts += [F.count_if(_inside(i) & is_).alias(f"{kind}{i}") for kind, is_ in kinds.items()]
    counted = _same(cut, met.groupBy(*keys).agg(*counts), keys, "left")
    targets = []
    for i in range(n):
        t, low, high = _target(i), F.col(f"low{i}"), F.col(f"high{i}")
        under, at_low, mid, at_high = (F.col(f"{kind}{i}") for kind in ("under", "at_low", "mid", "at_high"))
        rank = t["rank"] - t["before"]
        upto = [under, under + at_low, under + at_low + mid, under + at_low + mid + at_high]

        def to(before, inside, a, b, found):
            none = F.lit(None).cast("double")
            return F.struct(
                t["rank"].alias("rank"), before.alias("before"), inside.alias("inside"),
                (none if a is None else a).alias("low"), (none if b is None else b).alias("high"),
                (none if found is None else found).alias("found"),
            )

        # A rank outside of what the sketch proposed only costs another round.
        next_ = (
            F.when(rank <= upto[0], to(t["before"], under, t["low"], low, None))
            .when(rank <= upto[1], to(t["before"], under, t["low"], low, low))
            .when(rank <= upto[2], to(t["before"] + upto[1], mid, low, high, None))
            .when(rank <= upto[3], to(t["before"] + upto[2], at_high, low, high, high))
            .otherwise(to(t["before"] + upto[3], t["inside"] - upto[3], high, t["high"], None))
        )
        targets.append(F.when(_large(i, most), next_).otherwise(t))
    return written(counted.select(*keys, F.array(*targets).cast(_TARGET).alias("t")), "quantile-state")


def values_at_ranks(
    rows: DataFrame,
    keys: Sequence[str],
    ranks: Sequence[Callable[[Column], Column]],
    most: int | None = None,
) -> DataFrame:
    """``keys`` and ``values``: for each group the ``value`` at each rank, from 1.

    ``rows`` has the ``keys`` and a double ``value``. ``ranks`` give a rank for the number of
    the group's values. NULL values do not count; a group with no other has no row. NULL is a
    key like others. NaN ranks above all numbers.
    """
    keys, n, most = list(keys), len(ranks), MOST_SORTED if most is None else most
    rows = rows.select(*keys, F.col("value").cast("double").alias("value")).filter("value IS NOT NULL")
    m = F.col("m")
    none = F.lit(None).cast("double")
    start = [
        F.struct(rank(m).cast("bigint").alias("rank"), F.lit(0).cast("bigint").alias("before"), m.alias("inside"), none.alias("low"), none.alias("high"), none.alias("found"))
        for rank in ranks
    ]
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")).select(*keys, F.array(*start).cast(_TARGET).alias("t"))
    state, first = written(state, "quantile-state"), True

    def any_of(test: Callable[[int], Column]) -> Column:
        found = test(0)
        for i in range(1, n):
            found = found | test(i)
        return found

    while state.filter(any_of(lambda i: _large(i, most))).limit(1).count():
        state = _narrowed(rows, state, keys, n, most, first)
        left = _same(rows, broadcast_if_small(state), keys, "inner").filter(any_of(_inside))
        rows, first = written(left.select(*keys, "value"), "quantile-rows"), False

    met = _same(rows, broadcast_if_small(state), keys, "inner").filter(any_of(_inside))
    skipped = [F.count_if(F.col("value") <= _target(i)["low"]).alias(f"skipped{i}") for i in range(n)]
    ordered = met.groupBy(*keys).agg(F.sort_array(F.collect_list("value")).alias("sorted"), *skipped)
    done = _same(state, ordered, keys, "left")
    values = []
    for i in range(n):
        t = _target(i)
        at = (F.col(f"skipped{i}") + t["rank"] - t["before"]).cast("int")
        values.append(F.when(t["found"].isNotNull(), t["found"]).otherwise(F.get("sorted", at - 1)))
    return done.select(*keys, F.array(*values).alias("values"))


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float], most: int | None = None
) -> DataFrame:
    """``keys``, ``feature`` and ``values``: exact discrete percentiles of each of ``columns``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    rows = df.select(*keys, F.inline(pairs))
    return values_at_ranks(rows, [*keys, "feature"], [lower_rank(p) for p in probs], most)


def exact_medians(df: DataFrame, columns: Sequence[str], most: int | None = None) -> DataFrame:
    """``feature`` and ``median`` of each of ``columns``: the mean of the two middle values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    found = values_at_ranks(df.select(F.inline(pairs)), ["feature"], median_ranks(), most)
    return found.select("feature", ((F.get("values", F.lit(0)) + F.get("values", F.lit(1))) / 2).alias("median"))
