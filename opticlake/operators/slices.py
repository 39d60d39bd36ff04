"""Time series for groups too large for one task.

A window function sorts a whole group in one task. Where the largest group is
measured to be small, that is the best plan. Otherwise the large keys, and they
alone, are cut into ranges of about equal numbers of rows: a sample of a key's
order gives the split points, so a second with a million rows is cut like a
year. Each range is a group of its own and carries in the few rows it needs from
those before, so the result is the same whatever the cut.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake.operators.joins import join_per_key
from opticlake.session import group_limit, heaviest_group, heaviest_slices, materialize

SLICE, CARRY, TIE = "_slice", "_carry", "_tie"
# Rows that are sampled of each range of a large key. With 64 a range of twice the wanted size is out of the question.
SAMPLED = 64


@dataclass(frozen=True)
class Series:
    """Rows of many time series: `ts` in whole seconds, `order` the full order within a key.

    Cut by `cuts` (keys and split points of the large keys), or by time into slices of `width` seconds, or not at all.
    """

    df: DataFrame
    keys: list[str]
    ts: str
    order: list[str]
    width: int | None = None
    cuts: DataFrame | None = None

    @property
    def whole(self) -> bool:
        return self.width is None and self.cuts is None

    def sliced(self) -> DataFrame:
        if self.cuts is None:
            at = F.floor(F.col(self.ts) / self.width) if self.width else F.lit(0).cast("long")
            return self.df.withColumns({SLICE: at, CARRY: F.lit(False)})
        # The number of split points at or before the row: first among every so many of them, then among those between.
        rows, at = join_per_key(self.df, self.cuts, self.keys, nulls_match=True), F.struct(*self.order)
        head = F.size(F.filter("_heads", lambda s: s <= at))
        inner = F.size(F.filter(F.get("_groups", head - 1), lambda s: s <= at))
        number = F.when(head > 0, (head - 1) * F.size(F.get("_groups", F.lit(0))) + inner).otherwise(0)
        return rows.withColumns({SLICE: F.coalesce(number, F.lit(0)).cast("long"), CARRY: F.lit(False)}).drop("_heads", "_groups")

    def window(self, descending: bool = False):
        by = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.keys, SLICE).orderBy(*by)

    def time_window(self, descending: bool = False):
        ts = F.col(self.ts)
        return Window.partitionBy(*self.keys, SLICE).orderBy(ts.desc() if descending else ts.asc())

    def slices(self, descending: bool = False):
        """Over one row per slice of a key."""
        at = F.col(SLICE)
        return Window.partitionBy(*self.keys).orderBy(at.desc() if descending else at.asc())


def series(df: DataFrame, keys: list[str], ts: str, order: list[str] | None = None,
           width: int | str | None = "measure") -> Series:
    """The series, cut into ranges where the largest key is measured to be too large for a task."""
    order = order or [ts]
    if width != "measure":
        return Series(df, keys, ts, order, width)
    limit = group_limit(df.sparkSession)
    if heaviest_group(df, keys) <= limit:
        return Series(df, keys, ts, order)
    # Rows that the order leaves equal are told apart by their values, so that they can be cut too.
    values = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    df, order = df.withColumn(TIE, F.xxhash64(*values)), [*order, TIE]
    return Series(df, keys, ts, order, cuts=range_cuts(df, keys, order, limit))


def range_cuts(df: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """(keys, _heads, _groups): the split points of each key with more than `limit` rows, in groups, and the first of each group.

    Points are about half of `limit` rows apart. Only the sample of a key, `SAMPLED` rows of a range, is sorted as a whole.
    """
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).drop("_n")
    rows = join_per_key(df.select(*{*keys, *order}), hot.withColumn("_hot", F.lit(True)), keys, "inner", nulls_match=True)
    aim = max(1, limit // 2)
    picked = rows.where(F.rand(17) < min(1.0, SAMPLED / aim))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    points = picked.withColumn("_place", place).where((F.col("_place") > 0) & (F.col("_place") % min(SAMPLED, aim) == 0))
    every = points.groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct(*order))).alias("_points"))
    size = F.ceil(F.sqrt(F.size("_points"))).cast("int")
    starts = F.sequence(F.lit(0), F.size("_points") - 1, size)
    groups = every.withColumn("_groups", F.transform(starts, lambda i: F.slice("_points", i + 1, size)))
    heads = F.transform("_groups", lambda g: F.get(g, F.lit(0)))
    # Written once: a sample that is drawn again would cut elsewhere.
    return materialize(groups.select(*keys, heads.alias("_heads"), "_groups"), "range-cuts")


def with_previous(s: Series, values: dict[str, Column]) -> DataFrame:
    """Sliced rows, plus one carried row per slice: the time and last known values before it."""
    rows = s.sliced()
    if s.whole:
        return rows
    at = F.struct(*s.order)
    last = rows.groupBy(*s.keys, SLICE).agg(
        F.max_by(F.struct(*s.order), at).alias("_at"),
        *[F.max_by(v, F.when(v.isNotNull(), at)).alias(name) for name, v in values.items()],
    )
    w = s.slices()
    carried = last.select(
        *s.keys,
        F.lead(SLICE).over(w).alias(SLICE),
        *[F.col("_at")[c].alias(c) for c in s.order],
        *[F.last(name, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(name)
          for name in values],
        F.lit(True).alias(CARRY),
    ).where(F.col(SLICE).isNotNull())
    return rows.unionByName(carried, allowMissingColumns=True)


def with_next(s: Series, test: Column) -> DataFrame:
    """Sliced rows, plus one carried row per slice: the first later row that passes the test."""
    rows = s.sliced()
    if s.whole:
        return rows
    names = s.df.columns
    # Every slice needs a row here, also where nothing in it passes: earlier slices look through it.
    first = rows.groupBy(*s.keys, SLICE).agg(
        F.min_by(F.struct(*names), F.when(test, F.struct(*s.order))).alias("_hit"))
    # Descending, the nearest later slice is the last one seen: a running value instead of a rescan per row.
    later = s.slices(descending=True).rowsBetween(Window.unboundedPreceding, -1)
    hit = F.last("_hit", ignorenulls=True).over(later)
    carried = first.select(*s.keys, SLICE, hit.alias("_hit")).where(F.col("_hit").isNotNull())
    rest = [F.col("_hit")[n].alias(n) for n in names if n not in s.keys]
    return rows.unionByName(carried.select(*s.keys, SLICE, *rest, F.lit(True).alias(CARRY)))


def with_rows_before(s: Series, n: int) -> DataFrame:
    """Sliced rows, plus the up to `n` rows before the start of each slice."""
    rows = s.sliced()
    if s.whole or n == 0:
        return rows
    names = s.df.columns
    recent = rows.withColumn("_back", F.row_number().over(s.window(descending=True))).where(F.col("_back") <= n)
    last = recent.groupBy(*s.keys, SLICE).agg(F.collect_list(F.struct("_back", F.struct(*names).alias("_row"))).alias("_rows"))
    nearest = last.withColumn("_rows", F.array_sort("_rows", lambda a, b: a["_back"] - b["_back"]))
    # The n rows before a slice lie in the n slices before it, each of which has one at least.
    before = F.collect_list("_rows").over(s.slices(descending=True).rowsBetween(1, n))
    carried = nearest.withColumn("_before", F.slice(F.flatten(before), 1, n)).select(*s.keys, SLICE, F.explode("_before").alias("_b"))
    rest = [F.col("_b")["_row"][c].alias(c) for c in names if c not in s.keys]
    return rows.unionByName(carried.select(*s.keys, SLICE, *rest, F.lit(True).alias(CARRY)))


def span_fits(df: DataFrame, keys: list[str], ts: str, seconds: int) -> bool:
    """Whether sliding frames of this span are short: in a sliding frame each row reads its whole frame again."""
    return heaviest_slices(df, keys, ts, [seconds])[seconds] <= group_limit(df.sparkSession) // 100


def span_sums(df: DataFrame, keys: list[str], ts: str, seconds: int, sums: dict[str, Column],
              weighted: Callable[[Column], dict[str, Column]] = lambda at: {}) -> DataFrame:
    """(keys, ts, sums...) over [ts - seconds, ts], one row per key and second, for series of any density.

    Samples of one second are added up before the shuffle, and the series is cut into slices as long as the frame. A
    frame is the start of its own slice up to ts, plus the end of the slice before from ts - seconds on: two running
    sums, one forwards and one backwards, to which values are only ever added. So an infinite or very large value
    acts on the frames that hold it and on no others. `weighted` gives more sums from these and from the second,
    counted from the slice's start.
    """
    per_second = df.groupBy(*keys, ts).agg(*[F.sum(v).alias(name) for name, v in sums.items()])
    s = Series(per_second, keys, ts, [ts], seconds + 1)
    rows = s.sliced()
    before = rows.withColumns({SLICE: F.col(SLICE) + 1, CARRY: F.lit(True)})
    rows = rows.unionByName(before)
    rows = rows.withColumns(weighted((F.col(ts) - F.col(SLICE) * s.width).cast("double")))
    totals = [c for c in rows.columns if c not in (*keys, ts, SLICE, CARRY)]
    # A carried second is in the frames up to `seconds` later.
    rows = rows.withColumn("_upto", F.col(ts) + F.when(F.col(CARRY), seconds).otherwise(0))
    whole = Window.partitionBy(*keys, SLICE)
    forwards = whole.orderBy("_upto").rangeBetween(Window.unboundedPreceding, 0)
    backwards = whole.orderBy(F.col("_upto").desc()).rangeBetween(Window.unboundedPreceding, 0)

    def total(c: str) -> Column:
        own = F.sum(F.when(~F.col(CARRY), F.col(c))).over(forwards)
        carried = F.sum(F.when(F.col(CARRY), F.col(c))).over(backwards)
        return F.when(own.isNull(), carried).when(carried.isNull(), own).otherwise(own + carried)

    return own_rows(rows.withColumns({c: total(c) for c in totals}).drop("_upto"))


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(~F.col(CARRY)).drop(SLICE, CARRY, TIE)
