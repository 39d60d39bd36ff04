"""Queries over series: deltas, rates, features, labels, scores, health, model."""

from __future__ import annotations

from pyspark.sql import functions as F

from opticlake.operators import timeseries as W
from opticlake.plans.catalog import query
from opticlake.plans.views import view

_COUNTERS = ["fec_ccw", "fec_nccw"]
_ORDER = ["ts_us", "event_id"]


def _delta_sql(c: str) -> str:
    return f"case when {c} >= last_{c} then {c} - last_{c} when {c} < last_{c} then {c} end as {c}_delta, " \
           f"{c} < last_{c} as {c}_reset"


DELTAS = f"""
    select device, if_name, event_id, ts, ts_us, value, fec_ccw, fec_nccw, interval, {_delta_sql("fec_ccw")},
           {_delta_sql("fec_nccw")}
    from (select *, ts - lag(ts) over w as interval,
                 last_value(fec_ccw ignore nulls) over b as last_fec_ccw,
                 last_value(fec_nccw ignore nulls) over b as last_fec_nccw
          from t_series
          window w as (partition by device, if_name order by ts_us, event_id),
                 b as (partition by device, if_name order by ts_us, event_id
                       rows between unbounded preceding and 1 preceding))"""
RATES = f"""
    select *, case when interval > 0 then fec_ccw_delta / interval end as fec_ccw_rate,
           case when interval > 0 then fec_nccw_delta / interval end as fec_nccw_rate from ({DELTAS})"""


def _deltas(spark, sf, **kw):
    return W.counter_deltas(view(spark, sf, "t_series"), _COUNTERS, tiebreak=_ORDER, **kw)


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("counter_deltas", DELTAS)
def counter_deltas(spark, sf):
    return _deltas(spark, sf)


@query("counter_rates", f"""
    select * exclude (fec_ccw_rate, fec_nccw_rate), round(fec_ccw_rate, 9) as fec_ccw_rate,
           round(fec_nccw_rate, 9) as fec_nccw_rate from ({RATES})""")
def counter_rates(spark, sf):
    return _rounded(W.counter_rates(_deltas(spark, sf), _COUNTERS), "fec_ccw_rate", "fec_nccw_rate", digits=9)


@query("moving_features", """
    select device, if_name, event_id, ts, fec_ccw, round(avg(fec_ccw) over n, 4) as fec_ccw_ma_n,
           round(stddev_pop(fec_ccw) over n, 4) as fec_ccw_sd_n, round(avg(fec_ccw) over t, 4) as fec_ccw_ma_t,
           round(case when ts - lag(ts) over w > 0 then (fec_ccw - lag(fec_ccw) over w) / (ts - lag(ts) over w) end, 6)
             as fec_ccw_roc
    from t_series
    window w as (partition by device, if_name order by ts, ts_us, event_id),
           n as (partition by device, if_name order by ts, ts_us, event_id rows between 4 preceding and current row),
           t as (partition by device, if_name order by ts range between 21600 preceding and current row)""")
def moving_features(spark, sf):
    rows = W.moving_features(view(spark, sf, "t_series"), ["fec_ccw"], 5, 21600, tiebreak=_ORDER)
    rows = _rounded(rows, "fec_ccw_ma_n", "fec_ccw_sd_n", "fec_ccw_ma_t", digits=4)
    return _rounded(rows, "fec_ccw_roc").select(
        "device", "if_name", "event_id", "ts", "fec_ccw", "fec_ccw_ma_n", "fec_ccw_sd_n", "fec_ccw_ma_t", "fec_ccw_roc")


@query("latest_sample", """
    select * exclude (rn) from (select *, row_number() over (partition by device, if_name order by ts_us desc,
        event_id desc) as rn from t_series) where rn = 1""")
def latest_sample(spark, sf):
    return W.latest_sample(view(spark, sf, "t_series"), W.KEYS, "ts_us", ["event_id"])


_DRIFT = """
    select device, if_name, event_id, ts, case when count(value) over t > 1 and min(ts) over t < max(ts) over t
        then regr_slope(value, ts - 1704067200) over t end as value_drift
    from t_series window t as (partition by device, if_name order by ts range between 86400 preceding and current row)"""


@query("power_drift", f"select * exclude (value_drift), round(value_drift, 6) as value_drift from ({_DRIFT})")
def power_drift(spark, sf):
    rows = W.power_drift(view(spark, sf, "t_series"), "value", 86400)
    return _rounded(rows, "value_drift").select("device", "if_name", "event_id", "ts", "value_drift")


_LABEL = """
    select *, case when max(case when fec_nccw_delta > 0 then 1 end) over h = 1 then 1
        when ts + 21600 <= max(ts) over (partition by device, if_name) then 0 end as failure_label
    from ({deltas}) window h as (partition by device, if_name order by ts
                                 range between 1 following and 21600 following)""".replace("{deltas}", DELTAS)


@query("failure_label", _LABEL)
def failure_label(spark, sf):
    return W.failure_label(_deltas(spark, sf), 21600, tiebreak=_ORDER)


@query("anomaly_score", """
    with c as (select device, if_name, avg(fec_ccw) as a, stddev_pop(fec_ccw) as s, avg(fec_nccw) as an,
                      stddev_pop(fec_nccw) as sn, median(fec_ccw) as m from t_series group by device, if_name),
    d as (select device, if_name, 1.4826::double * median(abs(fec_ccw - m)) as mad
          from t_series join c using (device, if_name) group by device, if_name),
    z as (select event_id, device, if_name, case when s > 0 then abs(fec_ccw - a) / s end as x,
                 case when sn > 0 then abs(fec_nccw - an) / sn end as y,
                 case when mad > 0 then abs(fec_ccw - m) / mad end as r
          from t_series join c using (device, if_name) join d using (device, if_name))
    select event_id, device, if_name, round(x, 6) as fec_ccw_score, round(y, 6) as fec_nccw_score,
           round(greatest(x, y), 6) as anomaly_score, round(r, 6) as mad_score from z""")
def anomaly_score(spark, sf):
    rows = W.anomaly_score(view(spark, sf, "t_series"), _COUNTERS)
    rows = rows.select("event_id", *W.KEYS, "fec_ccw", "fec_ccw_score", "fec_nccw_score",
                       F.col("anomaly_score").alias("z_score"))
    robust = W.anomaly_score(rows.drop("fec_ccw_score"), ["fec_ccw"], "mad")
    robust = robust.select("event_id", F.col("anomaly_score").alias("mad_score"))
    joined = rows.drop("fec_ccw").withColumnRenamed("z_score", "anomaly_score").join(robust, "event_id")
    return _rounded(joined, "fec_ccw_score", "fec_nccw_score", "anomaly_score", "mad_score")


# Bounds by part; some are missing.
_BOUNDS = {
    "tx_bias_high_alarm": "case when part_key % 10 <> 0 then 45.0::double end",
    "tx_bias_low_alarm": "case when part_key % 11 <> 0 then 3.0::double end",
    "tx_bias_high_warn": "40.0::double", "tx_bias_low_warn": "case when part_key % 3 = 0 then 10.0::double end",
    "rx_power_high_alarm": "cast(null as double)", "rx_power_low_alarm": "-7.5::double",
    "rx_power_high_warn": "-0.5::double", "rx_power_low_warn": "case when part_key % 2 = 0 then -6.5::double end",
}


def _severity_sql(m: str) -> str:
    return f"""case when {m} is null then null when coalesce({m} >= {m}_high_alarm, false)
        or coalesce({m} <= {m}_low_alarm, false) then 2 when coalesce({m} >= {m}_high_warn, false)
        or coalesce({m} <= {m}_low_warn, false) then 1 else 0 end"""


@query("threshold_status", f"""
    select order_key, device, if_name, lane, tx_bias_severity, rx_power_severity,
           case greatest(tx_bias_severity, rx_power_severity) when 2 then 'Alarm' when 1 then 'Warning' when 0 then 'OK' end
             as status
    from (select *, {_severity_sql("tx_bias")} as tx_bias_severity, {_severity_sql("rx_power")} as rx_power_severity
          from (select *, {", ".join(f"{sql} as {name}" for name, sql in _BOUNDS.items())}
                from (select * replace (case when order_key % 7 <> 0 then tx_bias end as tx_bias) from t_lanes)))""")
def threshold_status(spark, sf):
    lanes = view(spark, sf, "t_lanes").withColumn("tx_bias", F.when(F.col("order_key") % 7 != 0, F.col("tx_bias")))
    # One row of bounds per interface, joined to all its lanes.
    bounds = lanes.selectExpr("device", "if_name", "part_key").distinct().selectExpr(
        "device", "if_name", *[f"{sql} as {name}" for name, sql in _BOUNDS.items()])
    rows = W.lane_threshold_status(lanes, bounds, ["tx_bias", "rx_power"])
    return rows.select("order_key", "device", "if_name", "lane", "tx_bias_severity", "rx_power_severity", "status")


_HEALTH_STATUS = "case when value >= 480 then 'Alarm' when value >= 400 then 'Warning' else 'OK' end"


@query("health_class", f"""
    select r.event_id, r.device, r.if_name, {_HEALTH_STATUS} as status,
           case when value >= 480 or coalesce(fec_nccw_rate > 0.0002, false) then 'critical'
                when value >= 400 or coalesce(d.value_drift * 3600 < -1, false) then 'degrading' else 'healthy' end as health
    from ({RATES}) r join ({_DRIFT}) d on r.event_id = d.event_id""")
def health_class(spark, sf):
    rates = W.counter_rates(_deltas(spark, sf), _COUNTERS)
    rates = rates.withColumn("fec_nccw_rate", F.col("fec_nccw_rate") - 0.0002)
    rows = W.power_drift(rates, "value", 86400).withColumn("status", F.expr(_HEALTH_STATUS))
    rows = W.health_class(rows, drift="value_drift", limit_db_per_hour=-1.0)
    return rows.select("event_id", "device", "if_name", "status", "health")


@query("time_to_threshold", """
    select device, if_name, last_ts, threshold, round(slope * 86400, 6) as slope_per_day,
           case when slope <> 0 and (threshold - y) / slope > 0 then round((threshold - y) / slope / 3600, 2) end as hours_left
    from (select device, if_name, max(ts) as last_ts, 600.0::double as threshold,
                 regr_slope(value, ts - 1704067200) as slope,
                 avg(value) + regr_slope(value, ts - 1704067200) * (max(ts) - 1704067200 - avg(ts - 1704067200)) as y
          from t_series group by device, if_name having min(ts) < max(ts))
    -- No line through fewer than two times.
    union all
    select device, if_name, max(ts), 600.0::double, null, null
    from t_series group by device, if_name having min(ts) = max(ts)""")
def time_to_threshold(spark, sf):
    rows = W.time_to_threshold(view(spark, sf, "t_series"), "value", 600.0)
    return rows.select("device", "if_name", "last_ts", "threshold", F.round(F.col("slope") * 86400, 6).alias("slope_per_day"),
                       F.round(F.col("seconds_left") / 3600, 2).alias("hours_left"))


@query("degradation_model")
def degradation_model(spark, sf):
    rates = W.counter_rates(_deltas(spark, sf), _COUNTERS)
    frame = W.failure_label(rates, 21600, tiebreak=_ORDER)
    _, scored = W.degradation_model(frame, ["fec_ccw_rate", "fec_nccw_rate", "value"], categories=["if_name"])
    return scored.select("event_id", "device", "if_name", "failure_label", "prediction")
