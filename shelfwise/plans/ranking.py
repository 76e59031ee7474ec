"""Distributed rank / row position without a single-task window.

``Window.orderBy(...)`` with no partition, or partitioned by a key that may
hold a third of all rows, sorts everything in one task. Here the sort order is
cut into ranges, each numbered by an ordinary window, and the ranges' offsets
are added:

1. Bounds: of a sixty-fourth of the distinct keys, chosen by hash, one of each
   hash bucket (``PER_RANGE`` buckets a range, so their number is bounded), sorted.
   The bounds are a scalar subquery and depend on the rows' values alone:
   whatever task computes a row again gives it the same range. They only decide
   how even the ranges are, never the result.
2. A row's range is the number of bounds that don't lie after it, by binary search.
3. Rows are counted per (range, group); a running sum over at most one row per
   range and group gives each range its offset inside its group.
4. A window per (range, group) numbers the rows, so a hot group is spread over
   many tasks.

``method="row_number"`` gives ``ROW_NUMBER()`` over the full order;
``method="rank"`` gives SQL ``RANK()`` (ties share the smallest position, gaps
follow). Rank first counts the rows of each (group, order) value, numbers
those values with the counts as weights, and joins them back, so a tie of any
length is one row where it is numbered. Everything is lazy and stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_RANGE = 16
_RANGE, _BOUNDS, _BEFORE, _OFFSET, _WEIGHT = "_rk_range", "_rk_bounds", "_rk_before", "_rk_offset", "_rk_weight"

Order = Sequence[tuple[str, bool]]


def _sooner(a: Column, b: Column, order: Order) -> Column:
    """``a`` sorts before ``b``: structs with fields k0, k1, ... as in ``order`` (column, descending).

    A struct of one field compares nulls first, which is Spark's place for
    them in ascending order, and its reverse is that of descending order.
    """
    result = F.lit(False)
    for i in reversed(range(len(order))):
        x, y = a[f"k{i}"], b[f"k{i}"]
        first = F.struct(y) < F.struct(x) if order[i][1] else F.struct(x) < F.struct(y)
        result = first | (x.eqNullSafe(y) & result)
    return result


def _key(order: Order) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, (c, _) in enumerate(order)])


def _bounds(df: DataFrame, order: Order, ranges: int) -> DataFrame:
    """One row with the sorted array of at most ``ranges - 1`` keys that separate the ranges."""
    hashed = df.select(_key(order).alias("k")).withColumn("h", F.xxhash64("k"))
    picked = (hashed.where(F.col("h").bitwiseAND(F.lit(63)) == 0)
              .groupBy(F.pmod(F.shiftright("h", 6), F.lit(ranges * PER_RANGE)).alias("bucket"))
              .agg(F.min(F.struct("h", "k")).alias("least")).select("least.k"))
    listed = picked.agg(F.array_sort(
        F.collect_list("k"),
        lambda a, b: F.when(_sooner(a, b, order), -1).when(_sooner(b, a, order), 1).otherwise(0)).alias("s"))
    cut = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)),
                      lambda i: F.get("s", F.floor(i * F.size("s") / ranges).cast("int")))
    return listed.select(F.array_distinct(F.filter(cut, lambda k: k.isNotNull())).alias(_BOUNDS))


def _range_of(order: Order, ranges: int) -> Column:
    """How many bounds don't lie after the row's key (binary search, one step per power of two)."""
    steps = [1 << p for p in reversed(range(ranges.bit_length()))]

    def step(at: Column, width: Column) -> Column:
        bound = F.get(F.col(_BOUNDS), at + width - 1)
        inside = at + width <= F.size(_BOUNDS)
        return F.when(inside & ~_sooner(F.col("_rk_key"), bound, order), at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _number(df: DataFrame, order: Order, group: list[str], ranges: int) -> DataFrame:
    """``df`` with ``_rk_before``: the sum of ``_rk_weight`` over the rows of the group that sort before."""
    whole: Order = [(g, False) for g in group] + list(order)
    ranged = df
    if ranges > 1:
        bounds = _bounds(df, whole, ranges).scalar()
        ranged = (df.withColumn(_BOUNDS, bounds).withColumn("_rk_key", _key(whole))
                  .withColumn(_RANGE, _range_of(whole, ranges)).drop(_BOUNDS, "_rk_key"))
    else:
        ranged = df.withColumn(_RANGE, F.lit(0))
    keys = [_RANGE, *group]
    earlier = Window.partitionBy(*group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys).agg(F.sum(_WEIGHT).alias("_n"))
               .withColumn(_OFFSET, F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
               .select(*[F.col(k).alias(f"_rk_o{i}") for i, k in enumerate(keys)], _OFFSET))
    sort = [F.col(c).desc() if down else F.col(c).asc() for c, down in order]
    inside = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.withColumn("_rk_in", F.coalesce(F.sum(_WEIGHT).over(inside), F.lit(0)))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_rk_o{i}"))
    return numbered.join(offsets, same).select(*df.columns, (F.col(_OFFSET) + F.col("_rk_in")).alias(_BEFORE))


def distributed_rank(df: DataFrame, order: Order, group: Sequence[str] = (), tiebreak: Sequence[str] = (),
                     method: str = "rank", out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = RANK() or ROW_NUMBER() over (partition by group order by order).

    ``order`` is a list of (column, descending). ``tiebreak`` columns complete
    the order to a total one for ``row_number``. Descending puts nulls last,
    ascending puts them first, as Spark and SQL ``ORDER BY`` do by default.
    ``partitions`` is the number of ranges, by default the shuffle width.
    """
    if method not in ("rank", "row_number"):
        raise ValueError(f"unknown method {method!r}")
    group, order = list(group), list(order)
    ranges = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = (F.col(_BEFORE) + 1).cast("bigint").alias(out)
    if method == "row_number":
        full = order + [(t, False) for t in tiebreak]
        return _number(df.withColumn(_WEIGHT, F.lit(1)), full, group, ranges).select(*df.columns, value)
    keys = group + [c for c, _ in order]
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_WEIGHT))
    ranked = _number(values, order, group, ranges).select(
        *[F.col(k).alias(f"_rk_v{i}") for i, k in enumerate(keys)], value.alias("_rk_rank"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_rk_v{i}"))
    return df.join(ranked, same).select(*df.columns, F.col("_rk_rank").alias(out))


__all__ = ["distributed_rank"]
