"""Deltas, rates, moving features, drift, labels, scores and health per series.

`ts` is in whole seconds; `tiebreak` orders samples of the same second.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opticlake.operators.as_of import join_as_of
from opticlake.operators.joins import join_per_key
from opticlake.operators.slices import (
    Series,
    own_rows,
    series,
    span_fits,
    span_sums,
    with_next,
    with_previous,
    with_rows_before,
)
from opticlake.operators.sketches import exact_quantiles
from opticlake.session import group_limit

KEYS = ["device", "if_name"]


def counter_deltas(df: DataFrame, counters: list[str], keys: list[str] = KEYS, ts: str = "ts",
                   tiebreak: list[str] = (), width: int | str | None = "measure") -> DataFrame:
    """Interval and delta since the sample before; a counter that fell was reset and counts from zero."""
    s = series(df, keys, ts, [ts, *tiebreak], width=width)
    w = s.window()
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = with_previous(s, {c: F.col(c) for c in counters})
    columns: dict[str, Column] = {"interval": F.col(ts) - F.lag(ts).over(w)}
    for c in counters:
        columns[f"_{c}"] = F.last(c, ignorenulls=True).over(before)
    rows = own_rows(rows.withColumns(columns))
    for c in counters:
        now, last = F.col(c), F.col(f"_{c}")
        rows = rows.withColumns({
            f"{c}_delta": F.when(now >= last, now - last).when(now < last, now),
            f"{c}_reset": now < last,
        })
    return rows.drop(*[f"_{c}" for c in counters])


def counter_rates(deltas: DataFrame, counters: list[str]) -> DataFrame:
    """Delta per second, NULL where no time passed."""
    return deltas.withColumns({
        f"{c}_rate": F.when(F.col("interval") > 0, F.col(f"{c}_delta") / F.col("interval")) for c in counters
    })


def moving_features(df: DataFrame, metrics: list[str], n: int, seconds: int, keys: list[str] = KEYS, ts: str = "ts",
                    tiebreak: list[str] = (), width: int | str | None = "measure") -> DataFrame:
    """Mean and deviation over n samples, mean over a time span, and rate of change."""
    s = series(df, keys, ts, [ts, *tiebreak], width=width)
    w = s.window()
    columns: dict[str, Column] = {}
    for m in metrics:
        frame = w.rowsBetween(-(n - 1), 0)
        gap = F.col(ts) - F.lag(ts).over(w)
        columns |= {
            f"{m}_ma_n": F.avg(m).over(frame),
            f"{m}_sd_n": F.stddev_pop(m).over(frame),
            f"{m}_roc": F.when(gap > 0, (F.col(m) - F.lag(m).over(w)) / gap),
        }
    rows = own_rows(with_rows_before(s, max(n - 1, 1)).withColumns(columns))
    if s.whole and span_fits(df, keys, ts, seconds):
        span = Window.partitionBy(*keys).orderBy(ts).rangeBetween(-seconds, 0)
        return rows.withColumns({f"{m}_ma_t": F.avg(m).over(span) for m in metrics})
    sums = {f"{m}_{part}": v for m in metrics
            for part, v in (("sum", F.col(m).cast("double")), ("count", F.col(m).isNotNull().cast("long")))}
    totals = span_sums(df, keys, ts, seconds, sums)
    means = totals.select(*keys, ts, *[
        F.when(F.col(f"{m}_count") > 0, F.col(f"{m}_sum") / F.col(f"{m}_count")).alias(f"{m}_ma_t") for m in metrics])
    return join_per_key(rows, means, [*keys, ts], "inner", nulls_match=True)


def latest_sample(df: DataFrame, keys: list[str], ts: str = "ts", tiebreak: list[str] = ()) -> DataFrame:
    """Newest whole row per key; combined before the shuffle, nothing is sorted."""
    values = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(ts, *tiebreak)).alias("_v"))
    return newest.select(*keys, "_v.*")


def power_drift(df: DataFrame, metric: str, seconds: int, keys: list[str] = KEYS, ts: str = "ts") -> DataFrame:
    """Slope of a metric per second over the span that ends at each sample, from sums per second at any density."""
    y, name = F.col(metric), f"{metric}_drift"

    def products(x: Column) -> dict[str, Column]:
        return {"_x": F.col("_n") * x, "_xx": F.col("_n") * x * x, "_xy": F.col("_y") * x,
                "_times": (F.col("_n") > 0).cast("long")}

    sums = {"_n": y.isNotNull().cast("double"), "_y": F.coalesce(y.cast("double"), F.lit(0.0))}
    t = span_sums(df, keys, ts, seconds, sums, products)
    spread = F.col("_n") * F.col("_xx") - F.col("_x") * F.col("_x")
    slope = (F.col("_n") * F.col("_xy") - F.col("_x") * F.col("_y")) / spread
    slopes = t.select(*keys, ts, F.when(F.col("_times") > 1, slope).alias(name))
    return join_per_key(df, slopes, [*keys, ts], "inner", nulls_match=True)


def failure_label(df: DataFrame, horizon: int, delta: str = "fec_nccw_delta", keys: list[str] = KEYS, ts: str = "ts",
                  tiebreak: list[str] = (), width: int | str | None = "measure") -> DataFrame:
    """1 if the counter rises within (ts, ts + horizon], 0 if it does not, NULL where the end is not seen yet."""
    s = series(df, keys, ts, [ts, *tiebreak], width=width)
    hit = F.coalesce(F.col(delta) > 0, F.lit(False))
    end = F.col(ts) + horizon
    label = F.when(F.col("_next") <= end, 1).when(end <= F.col("_last"), 0).alias("failure_label")
    # Descending order turns "the first hit after" into a running minimum.
    if s.whole:
        after = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
        following = after.rangeBetween(Window.unboundedPreceding, -1)
        seen = {"_next": F.min(F.when(hit, F.col(ts))).over(following), "_last": F.max(ts).over(after.rangeBetween(Window.unboundedPreceding, 0))}
        return df.withColumns(seen).select(*df.columns, label)
    # All samples of a second have one label: a slice of so many seconds has no more rows than that, whatever the density.
    seconds = df.groupBy(*keys, ts).agg(F.max(hit).alias("_hit"))
    t = Series(seconds, keys, ts, [ts], s.width or group_limit(df.sparkSession))
    after = t.time_window(descending=True).rangeBetween(Window.unboundedPreceding, -1)
    known = own_rows(with_next(t, F.col("_hit")).withColumn("_next", F.min(F.when(F.col("_hit"), F.col(ts))).over(after)))
    last = seconds.groupBy(*keys).agg(F.max(ts).alias("_last"))
    labels = join_per_key(known, last, keys, "inner", nulls_match=True).select(*keys, ts, label)
    return join_per_key(df, labels, [*keys, ts], "inner", nulls_match=True)


def anomaly_score(df: DataFrame, metrics: list[str], method: str = "zscore", keys: list[str] = KEYS) -> DataFrame:
    """Distance of each value from the centre of its series, and the largest over the metrics.

    Centres are aggregated per key and joined back, so a large series needs no sort.
    """
    if method == "zscore":
        centres = df.groupBy(*keys).agg(
            *[f(m).alias(f"_{kind}_{m}") for m in metrics for kind, f in (("c", F.avg), ("s", F.stddev_pop))])
        rows = join_per_key(df, centres, keys, "inner", nulls_match=True)
    elif method == "mad":
        centres = exact_quantiles(df, keys, metrics, {"median": 0.5})
        rows = join_per_key(df, centres, keys, nulls_match=True).withColumnsRenamed({f"{m}_median": f"_c_{m}" for m in metrics})
        apart = rows.select(*keys, *[F.abs(F.col(m) - F.col(f"_c_{m}")).alias(m) for m in metrics])
        spread = exact_quantiles(apart, keys, metrics, {"median": 0.5}, columns=[])
        rows = join_per_key(rows, spread.select(
            *keys, *[(F.col(f"{m}_median") * 1.4826).alias(f"_s_{m}") for m in metrics]), keys, nulls_match=True)
    else:
        raise ValueError(f"unknown method {method!r}: use 'zscore' or 'mad'")
    scores = {
        f"{m}_score": F.when(F.col(f"_s_{m}") > 0, F.abs(F.col(m) - F.col(f"_c_{m}")) / F.col(f"_s_{m}"))
        for m in metrics
    }
    rows = rows.withColumns(scores)
    worst = F.greatest(*scores) if len(scores) > 1 else F.col(next(iter(scores)))
    return rows.withColumn("anomaly_score", worst).drop(*[f"_{k}_{m}" for m in metrics for k in "cs"])


def severity(value: Column, high_alarm: Column, low_alarm: Column, high_warn: Column, low_warn: Column) -> Column:
    """2 Alarm, 1 Warning, 0 OK, NULL without a value; missing bounds do not count."""

    def outside(high: Column, low: Column) -> Column:
        return F.coalesce(value >= high, F.lit(False)) | F.coalesce(value <= low, F.lit(False))

    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when(outside(high_alarm, low_alarm), 2).when(outside(high_warn, low_warn), 1).otherwise(0)
    )


def status_text(code: Column) -> Column:
    return F.when(code == 2, "Alarm").when(code == 1, "Warning").when(code == 0, "OK")


def threshold_status(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Severity per metric against its `<metric>_{high,low}_{alarm,warn}` columns, and the worst as text."""
    bounds = ("high_alarm", "low_alarm", "high_warn", "low_warn")
    codes = {f"{m}_severity": severity(F.col(m), *[F.col(f"{m}_{b}") for b in bounds]) for m in metrics}
    rows = df.withColumns(codes)
    worst = F.greatest(*codes) if len(codes) > 1 else F.col(next(iter(codes)))
    return rows.withColumn("status", status_text(worst))


def lane_threshold_status(lanes: DataFrame, thresholds: DataFrame, metrics: list[str],
                          keys: list[str] = KEYS) -> DataFrame:
    """Lane values against the thresholds of their interface: those of the lane's run, or the newest before it."""
    bounds = [f"{m}_{b}" for m in metrics for b in ("high_alarm", "low_alarm", "high_warn", "low_warn")]
    run = [c for c in ("run_timestamp",) if c in thresholds.columns]
    return threshold_status(join_as_of(lanes, thresholds.select(*keys, *run, *bounds), keys), metrics)


def health_class(df: DataFrame, rate: str = "fec_nccw_rate", drift: str = "rx_power_drift",
                 limit_db_per_hour: float = -0.01) -> DataFrame:
    """critical, degrading or healthy from status, uncorrected rate and power drift (per second)."""
    status = F.col("status")

    def holds(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    return df.withColumn("health", F.when(
        holds(status == "Alarm") | holds(F.col(rate) > 0), "critical"
    ).when(
        holds(status == "Warning") | holds(F.col(drift) * 3600 < limit_db_per_hour), "degrading"
    ).otherwise("healthy"))


def time_to_threshold(df: DataFrame, metric: str, threshold: float | str, keys: list[str] = KEYS,
                      ts: str = "ts") -> DataFrame:
    """Seconds until the fitted line reaches the threshold, NULL where it moves away or is flat."""
    limit = F.max(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    x, y = F.col(ts).cast("double"), F.col(metric)
    known = F.when(y.isNotNull(), x)
    fit = df.groupBy(*keys).agg(
        F.when(F.min(known) < F.max(known), F.regr_slope(y, x)).alias("slope"), F.avg(known).alias("_x"),
        F.avg(y).alias("_y"), F.max(ts).alias("last_ts"), limit.alias("threshold"),
    )
    # The line through the means is the intercept form without its cancellation at large epochs.
    at_last = F.col("_y") + F.col("slope") * (F.col("last_ts") - F.col("_x"))
    left = F.when(F.col("slope") != 0, (F.col("threshold") - at_last) / F.col("slope"))
    return fit.withColumn("seconds_left", F.when(left > 0, left)).drop("_x", "_y")


def degradation_model(frame: DataFrame, features: list[str], label: str = "failure_label",
                      categories: list[str] = (), ts: str = "ts", train_share: float = 0.7,
                      seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees on the failure label, trained on the earlier and scored on all later rows.

    A missing number is 0 with a flag beside it, a missing or new category one of its own, so no row is dropped; rows
    whose label is not known yet are scored too.
    """
    known = frame.where(F.col(label).isNotNull())
    cut = known.approxQuantile(ts, [train_share], 0.001)[0]
    indexed = [f"{c}_index" for c in categories]
    filled = {f"{c}_known": F.coalesce(c, F.lit(0.0)).cast("double") for c in features}
    flags = {f"{c}_missing": F.col(c).isNull().cast("double") for c in features}
    # Trees cannot split on NaN or infinite values: they count as missing.
    finite = frame.withColumns({c: F.when(F.abs(F.col(c)) < float("inf"), F.col(c).cast("double")) for c in features})
    rows = finite.withColumns(filled | flags)
    stages = [StringIndexer(inputCol=c, outputCol=i, handleInvalid="keep") for c, i in zip(categories, indexed)]
    stages.append(VectorAssembler(inputCols=[*filled, *flags, *indexed], outputCol="features", handleInvalid="keep"))
    stages.append(GBTClassifier(labelCol=label, featuresCol="features", maxIter=10, maxDepth=4, seed=seed))
    model = Pipeline(stages=stages).fit(rows.where(F.col(label).isNotNull() & (F.col(ts) <= cut)))
    return model, model.transform(rows.where(F.col(ts) > cut)).drop(*filled, *flags)
