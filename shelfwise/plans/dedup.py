"""Deterministic keep-one-row-per-key, built on aggregation.

``dropDuplicates`` keeps an arbitrary row, and a ``row_number`` window sorts a
whole key group in one task. Taking ``min(struct(order..., rest...))`` per key
is a hash-partitioned aggregate with a map-side partial step, so a key holding
a third of all rows is reduced to one row per map task before the shuffle, and
the survivor is the same on every run (nulls sort first, as in ``ORDER BY``).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` then by the remaining columns."""
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    pick = F.struct(*[F.col(c) for c in order + rest])
    return (
        df.groupBy(*keys)
        .agg(F.min(pick).alias("_keep"))
        .select(*keys, "_keep.*")
        .select(*df.columns)
    )


def split_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, extra copies) for every key, each row exactly once, skew-safe.

    Only the rows of keys that come more than once are looked at for extra copies:
    the keys are counted by a hash aggregate, and the rows are matched with the
    repeated ones by a hash join, so rows that come once are never sorted or held.
    Those left are counted per full value (``groupBy(all columns)``), so copies
    of one row collapse to a count before anything else moves; the survivor per
    key comes from the same ``min(struct)`` aggregate as :func:`keep_first`.
    Extra copies are re-expanded from their counts in bounded chunks.
    """
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    shape = [F.col(c) for c in order + rest]
    repeated = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                .select(*[F.col(k).alias(f"_r_{k}") for k in keys]))
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    several = df.join(repeated.hint("shuffle_hash"), same, "left_semi")
    distinct_rows = several.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    survivors = (
        distinct_rows.groupBy(*keys)
        .agg(F.min(F.struct(*shape)).alias("_keep"))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_keep")
    )
    cond = None
    for k in keys:
        c = distinct_rows[k].eqNullSafe(survivors[f"_k_{k}"])
        cond = c if cond is None else cond & c
    labeled = (
        distinct_rows.join(survivors, cond, "inner")
        .withColumn("_is_keep", F.struct(*shape).eqNullSafe(F.col("_keep")))
    )
    extra = labeled.withColumn(
        "_extra", F.col("_n") - F.when(F.col("_is_keep"), 1).otherwise(0)
    ).filter(F.col("_extra") > 0)
    return keep_first(df, keys, order), expand_counts(extra, "_extra").select(*df.columns)


def expand_counts(df: DataFrame, count_col: str, chunk: int = 65536) -> DataFrame:
    """Emit each row ``count_col`` times; arrays built per row stay below ``chunk``.

    A row first becomes one descriptor per chunk of copies; descriptors are
    hash-spread on (row, chunk) so a row copied a billion times is re-emitted
    by many tasks, not one.
    """
    n = F.col(count_col)
    last_chunk = F.floor((n - 1) / chunk).cast("bigint")
    chunks = df.filter(n > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    chunks = chunks.repartition(*[F.col(c) for c in chunks.columns])
    size = F.least(F.lit(chunk).cast("bigint"), n - F.col("_chunk") * chunk).cast("int")
    return chunks.withColumn("_one", F.explode(F.array_repeat(F.lit(0), size))).drop("_chunk", "_one")
