"""States that merge: quantile sketches and sketches of distinct sets, made per group and hour, stored and merged upwards.

* Quantiles. The ranks of a KLL sketch are off by less than `SLACK` of the group, nearly always. `exact_quantiles` makes the sketches in
  the pass that also gives the other aggregates. Where no group is too large for a task, the built-in quantile follows; else the
  sketches give brackets, what lies in them is counted and ranked, and it is seen whether the wanted rank lies inside: where it does
  not, the bracket is widened to the whole group.
* Distinct sets. A theta sketch is exact up to its nominal size, 2**LOG_SIZE members, and off by about 1 / sqrt(2**LOG_SIZE) of the
  count beyond. Sets can be united, intersected and taken from each other, so "seen before and not after" needs no join of the members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opticlake.operators.joins import join_per_key
from opticlake.session import group_limit, materialize

SIZE = 4096
SLACK = 0.01  # of a group's ranks; the error of the sketch is about a tenth of that
LOG_SIZE = 12
NAN = float("nan")

# --- quantiles ---------------------------------------------------------------


def _number(column: str) -> Column:
    """Values that a sketch can hold: NaN, which stands above all, is counted beside it."""
    c = F.col(column).cast("double")
    return F.when(~F.isnan(c), c)


def quantile_states(df: DataFrame, by: list[str], metrics: list[str], extra: list[Column] = ()) -> DataFrame:
    """One row per group: `<metric>_kll`, `_n`, `_nans`, `_min`, `_max`, and other aggregates in the same pass."""
    return df.groupBy(*by).agg(*extra, *[e for m in metrics for e in (
        F.kll_sketch_agg_double(_number(m), F.lit(SIZE)).alias(f"{m}_kll"), F.count(_number(m)).alias(f"{m}_n"),
        F.count_if(F.isnan(F.col(m).cast("double"))).alias(f"{m}_nans"), F.min(_number(m)).alias(f"{m}_min"), F.max(_number(m)).alias(f"{m}_max"))])


def merged_states(states: DataFrame, by: list[str], metrics: list[str], extra: list[Column] = ()) -> DataFrame:
    """States of larger groups, from those of smaller ones."""
    return states.groupBy(*by).agg(*extra, *[e for m in metrics for e in (
        F.kll_merge_agg_double(f"{m}_kll", F.lit(SIZE)).alias(f"{m}_kll"), F.sum(f"{m}_n").alias(f"{m}_n"), F.sum(f"{m}_nans").alias(f"{m}_nans"),
        F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max"))])


def _between(low: Column, high: Column, rank: Column) -> Column:
    """The value between those of the whole ranks around a rank, as the built-in aggregate has it."""
    below, above = F.floor(rank), F.ceil(rank)
    return F.when(below == above, low).otherwise((above - rank) * low + (rank - below) * high)


def state_quantiles(states: DataFrame, metrics: list[str], shares: dict[str, float]) -> DataFrame:
    """States with `<metric>_<name>`: a value of the group whose rank is near the wanted one."""
    return states.withColumns({
        f"{m}_{name}": F.when(F.col(f"{m}_n") > 0, F.kll_sketch_get_quantile_double(f"{m}_kll", F.lit(float(p)))).when(F.col(f"{m}_nans") > 0, NAN)
        for m in metrics for name, p in shares.items()})


def exact_quantiles(df: DataFrame, by: list[str], metrics: list[str], shares: dict[str, float], extra: list[Column] = (),
                    names: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """One row per group: exact quantiles `<metric>_<name>`, and the aggregates of `extra`, called `names`.

    `columns` are those that `extra` looks at, where the rows are costly: they are then made once and written.
    """
    rows = df if columns is None else materialize(df.select(*dict.fromkeys([*by, *metrics, *columns])), "quantile-rows")
    states = materialize(quantile_states(rows, by, metrics, extra), "quantile-states")
    most = states.agg(F.max(F.greatest(F.lit(0), *[F.col(f"{m}_n") for m in metrics]))).first()[0] or 0
    out = states.select(*by, *names)
    if most <= group_limit(df.sparkSession):
        wide = rows.groupBy(*by).agg(*[F.percentile(m, float(p)).alias(f"{m}_{name}") for m in metrics for name, p in shares.items()])
        return join_per_key(out, wide, by, nulls_match=True)
    for m in metrics:
        found = quantiles_by_bracket(rows, by, m, states, list(shares.values()))
        wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("share") == float(p), F.col("quantile"))).alias(f"{m}_{name}") for name, p in shares.items()])
        out = join_per_key(out, wide, by, nulls_match=True)
        # A group of nothing but NaN has no bounds.
        only = states.where((F.col(f"{m}_n") == 0) & (F.col(f"{m}_nans") > 0)).select(*by, F.lit(NAN).alias("_nan"))
        out = join_per_key(out, only, by, nulls_match=True).withColumns({f"{m}_{name}": F.coalesce(f"{m}_{name}", "_nan") for name in shares}).drop("_nan")
    return out


def quantiles_by_bracket(df: DataFrame, by: list[str], metric: str, states: DataFrame, shares: list[float], slack: float = SLACK) -> DataFrame:
    """(by..., share, quantile) of the groups of `states`: the values near each quantile are counted and ranked."""
    n, nans = F.col(f"{metric}_n"), F.col(f"{metric}_nans")

    def end(p: float, outer: str) -> Column:
        """The value at a share, the outermost one where that is beyond the ends or NaN stand above the values."""
        if not 0 < p < 1:
            return F.col(outer)
        return F.when((n > 0) & (nans == 0), F.kll_sketch_get_quantile_double(f"{metric}_kll", F.lit(float(p)))).otherwise(F.col(outer))

    wanted = F.explode(F.array(*[F.struct(
        F.lit(float(p)).alias("share"), (F.lit(float(p)) * (n + nans - 1)).alias("rank"),
        end(p - slack, f"{metric}_min").alias("low"), end(p + slack, f"{metric}_max").alias("high")) for p in shares]))
    bounds = states.select(*by, n.alias("_n"), F.col(f"{metric}_min").alias("_min"), F.col(f"{metric}_max").alias("_max"), wanted.alias("_w")).select(
        *by, "_n", "_min", "_max", "_w.*")
    good = materialize(_ranked(df, by, metric, bounds).where("inside").select(*by, "share", "quantile"), "quantiles")
    found = good.select(*[F.col(k).alias(f"_m_{k}") for k in by], F.col("share").alias("_m_share"))
    same = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in by]
    missed = bounds.where("_n > 0").join(found, [*same, F.col("share") == F.col("_m_share")], "left_anti")
    if missed.isEmpty():
        return good
    # The sketch was further off than thought: look at the whole group.
    whole = missed.withColumns({"low": F.col("_min"), "high": F.col("_max")})
    return good.unionByName(_ranked(df, by, metric, whole).select(*by, "share", "quantile"))


def _ranked(df: DataFrame, by: list[str], metric: str, bounds: DataFrame) -> DataFrame:
    """(by..., share, quantile, inside) per row of bounds: whether both ranks lie within, and the value if so."""
    rows = df.select(*by, _number(metric).alias("_v")).where(F.col("_v").isNotNull())
    paired = join_per_key(rows, bounds, by, "inner", nulls_match=True)
    # Below the bracket only the count matters; inside, equal values are counted together before the shuffle.
    within = F.when(F.col("_v") >= F.col("low"), F.col("_v"))
    counted = paired.where(F.col("_v") <= F.col("high")).groupBy(*by, "share", "rank", "_n", within.alias("_v")).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*by, "share").orderBy(F.col("_v").asc_nulls_first()))
    ranked = counted.withColumn("_upto", upto)
    lower, upper = F.floor("rank"), F.ceil("rank")
    value = F.when(F.col("_v").isNotNull(), F.col("_v"))
    found = ranked.groupBy(*by, "share", "rank", "_n").agg(
        F.min(F.when(F.col("_upto") > lower, value)).alias("_lo"), F.min(F.when(F.col("_upto") > upper, value)).alias("_hi"),
        F.coalesce(F.max(F.when(F.col("_v").isNull(), F.col("_upto"))), F.lit(0)).alias("_below"), F.max("_upto").alias("_end"))
    # A rank at or beyond the values belongs to a NaN; a group of nothing else has no bounds and no row here.
    lo, hi = (F.when(r >= F.col("_n"), F.lit(NAN)).otherwise(v) for r, v in ((lower, F.col("_lo")), (upper, F.col("_hi"))))
    inside = (F.col("_below") <= F.least(lower, F.col("_n") - 1)) & (F.col("_end") > F.least(upper, F.col("_n") - 1))
    return found.select(*by, "share", _between(lo, hi, F.col("rank")).alias("quantile"), inside.alias("inside"))


# --- distinct sets -----------------------------------------------------------


def member(*columns: str) -> Column:
    """What a set counts: several columns as one text, told apart whatever they hold."""
    return F.to_json(F.struct(*columns))


def distinct_states(df: DataFrame, by: list[str], columns: list[str], name: str = "members") -> DataFrame:
    """One row per group: the sketch of the distinct rows of some columns."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(member(*columns), F.lit(LOG_SIZE)).alias(name))


def merged_sets(states: DataFrame, by: list[str], name: str = "members") -> DataFrame:
    return states.groupBy(*by).agg(F.theta_union_agg(name, F.lit(LOG_SIZE)).alias(name))


def set_sizes(before: str | Column, after: str | Column) -> dict[str, Column]:
    """How many members two sketches have, share, and have alone; NULL counts as empty."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (before, after))
    size = {"before": F.theta_sketch_estimate(a), "after": F.theta_sketch_estimate(b)}
    out = {k: F.coalesce(v, F.lit(0).cast("long")) for k, v in size.items()}
    out["both"] = F.coalesce(F.theta_sketch_estimate(F.theta_intersection(a, b)), F.lit(0).cast("long"))
    out["gone"] = F.coalesce(F.theta_sketch_estimate(F.theta_difference(a, b)), out["before"])
    out["new"] = F.coalesce(F.theta_sketch_estimate(F.theta_difference(b, a)), out["after"])
    return out
