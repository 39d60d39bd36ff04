"""Joins of many rows to one row per key, where one key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "_key_hash"


def unique_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One whole row per key: the largest, whatever order the rows come in."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_v")).select(*keys, "_v.*")


def newest_per_key(df: DataFrame, keys: list[str], run: str = "run_timestamp") -> DataFrame:
    """One whole row per key: of the newest run where the rows carry one, else as `unique_per_key`."""
    if run not in df.columns or run in keys:
        return unique_per_key(df, keys)
    values = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max(F.struct(run, *[c for c in values if c != run])).alias("_v"))
    return newest.select(*keys, *[F.col("_v")[c].alias(c) for c in values])


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "left",
                 nulls_match: bool = False) -> DataFrame:
    """Join rows to the result of an aggregate over the same keys.

    The aggregate is already partitioned by the keys, so a plain join would not
    exchange it again, and a join is split at run time only where both sides
    come straight from an exchange. The hash as one more key forces that
    exchange of the small side; a hot key of `rows` then spreads over many tasks.
    """
    left = rows.withColumn(_HASH, F.xxhash64(*keys))
    if not nulls_match:
        return left.join(per_key.withColumn(_HASH, F.xxhash64(*keys)), [*keys, _HASH], how).drop(_HASH)
    own = {k: f"_right_{k}" for k in keys}
    right = per_key.withColumn(f"_right{_HASH}", F.xxhash64(*keys)).withColumnsRenamed(own)
    same = [F.col(_HASH) == F.col(f"_right{_HASH}"), *[F.col(k).eqNullSafe(F.col(o)) for k, o in own.items()]]
    return left.join(right, same, how).drop(_HASH, f"_right{_HASH}", *own.values())
