"""Alert rules over the request log, on tables and on streams.

The log holds about fourteen requests an hour, so windows are hours instead
of minutes and the rate limits are scaled with them.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tablewarden.catalog.registry import query, r6, stamp
from tablewarden.catalog.traffic import _ROUTED, TIER_SQL, routed
from tablewarden.operators import alerts
from tablewarden.spec import Thresholds
from tablewarden.streaming.hold import hold_for
from tablewarden.streaming.keyed import ROCKSDB
from tablewarden.streaming.liveness import silent_intervals
from tablewarden.streaming.runner import run_available

WIDTH, SLIDE = "1 hour", "30 minutes"
LIMITS = Thresholds(error_rate=3 / 3600, latency_p95=8.0, low_confidence_share=0.3)

_FMT = "'%Y-%m-%d %H:%M:%S'"
# Every request in the two half-hour-aligned windows that cover it.
SLIDING = _ROUTED + """,
spread as (select *, time_bucket(interval 30 minutes, ts, timestamp '2024-01-01') - k*interval 30 minutes ws from routed, (values (0),(1)) x(k))"""


def _stamped(df):
    return r6(df.withColumns({c: stamp(c) for c, t in df.dtypes if t == "timestamp"}))


_BOUNDS = f"strftime(ws,{_FMT}) window_start, strftime(ws + interval 1 hour,{_FMT}) window_end"


@query("request_rate", f"{SLIDING} select {_BOUNDS}, destination, count(*)::bigint n, round(count(*)/3600.0::double,6) rate from spread group by ws, destination")
def request_rate(spark, sf_dir):
    return _stamped(alerts.request_rate(routed(spark, sf_dir), "ts", ["destination"], WIDTH, SLIDE))


_ERRORS = f"""errors as (select ws, destination, count(*)::bigint n, count(*) filter (status='error')::bigint errors,
 count(*) filter (status='error')/3600.0::double rate from spread group by ws, destination)"""


def error_windows(df, **more):
    return alerts.error_rate(df, "ts", F.col("status") == "error", ["destination"], WIDTH, SLIDE, LIMITS, **more)


@query("alert_error_rate", f"{SLIDING}, {_ERRORS} select {_BOUNDS}, destination, n, errors, round(rate,6) rate, rate > 3/3600.0::double breached from errors")
def alert_error_rate(spark, sf_dir):
    return _stamped(error_windows(routed(spark, sf_dir)))


@query("latency_p95", f"""{SLIDING}, q as (select ws, destination, quantile_cont(latency_s,0.95) p95 from spread group by all)
select {_BOUNDS}, destination, round(p95,6) p95, p95 > 8 breached from q""")
def latency_p95(spark, sf_dir):
    return _stamped(alerts.latency_exact_p95(routed(spark, sf_dir), "ts", "latency_s", ["destination"], WIDTH, SLIDE, LIMITS))


_SKETCH = f"""{SLIDING}, placed as (select ws, destination, latency_s, row_number() over w rn, count(*) over (partition by ws, destination) n
 from spread window w as (partition by ws, destination order by latency_s))
select {_BOUNDS}, destination, n::bigint n, round(latency_s,6) p95, latency_s > 8 breached from placed where rn = ceil(0.95::double*n)"""


def _sketched(rows):
    panes = alerts.latency_panes(rows, "ts", "latency_s", ["destination"], SLIDE)
    return alerts.latency_sketch_p95(panes, ["destination"], WIDTH, SLIDE, LIMITS)


@query("latency_sketch_p95", _SKETCH)
def latency_sketch_p95(spark, sf_dir):
    """From sketches per half hour; windows of fewer requests than a sketch keeps are exact."""
    return _stamped(_sketched(routed(spark, sf_dir)))


def _histogram_sql(source: str, group: str) -> str:
    bounds = [b for b in alerts.LATENCY_BUCKETS if b != float("inf")]
    counts = ", ".join(f"count(*) filter (latency_s <= {b}::double)" for b in bounds)
    edges = ", ".join(f"{b}::double" for b in bounds)
    return f"""hist as (select {group}, [{counts}, count(*)] c, count(*)::bigint n, [{edges}] b from {source} group by {group}),
placed as (select *, list_position(list_transform(c, lambda x: x >= 0.95::double*n), true) i from hist),
quant as (select {group}, n, case when i > {len(bounds)} then b[{len(bounds)}] else
 coalesce(b[i-1],0) + (b[i]-coalesce(b[i-1],0))*(0.95::double*n-coalesce(c[i-1],0))/(c[i]-coalesce(c[i-1],0)) end p95 from placed)"""


@query("histogram_quantile", f"{SLIDING}, {_histogram_sql('spread', 'ws, destination')} select {_BOUNDS}, destination, n, round(p95,6) p95, p95 > 8 breached from quant")
def histogram_quantile(spark, sf_dir):
    return _stamped(alerts.latency_histogram_p95(routed(spark, sf_dir), "ts", "latency_s", ["destination"], WIDTH, SLIDE, LIMITS))


_SILENT = """seen as (select distinct date_trunc('hour', ts) ws, path from routed),
calendar as (select unnest(generate_series((select min(ws) from seen), (select max(ws) from seen), interval 1 hour)) ws),
silent as (select c.ws, p.path from calendar c, (select distinct path from seen) p where not exists (select 1 from seen s where s.ws=c.ws and s.path=p.path))"""


@query("silent_series", f"{_ROUTED}, {_SILENT} select strftime(ws,{_FMT}) window_start, path from silent")
def silent_series(spark, sf_dir):
    return _stamped(alerts.silent_series(routed(spark, sf_dir), "ts", ["path"], "1 hour"))


@query("alert_low_confidence", f"""{SLIDING}, t as (select ws, destination, count(*)::bigint n, count(*) filter ({TIER_SQL}='Low')::bigint low from spread group by ws, destination)
select {_BOUNDS}, destination, n, low, round(low::double/n,6) "share", low::double/n > 0.3::double breached from t""")
def alert_low_confidence(spark, sf_dir):
    return _stamped(alerts.low_confidence_share(routed(spark, sf_dir), "ts", "p", ["destination"], WIDTH, SLIDE, LIMITS))


@query("alert_imbalance", f"""{SLIDING}, t as (select ws, destination, count(*)::bigint n, count(*) filter (prediction=1)::bigint positives from spread group by ws, destination)
select {_BOUNDS}, destination, n, positives, round(abs(positives::double/n-0.6::double),6) imbalance, abs(positives::double/n-0.6::double) > 0.15::double breached from t""")
def alert_imbalance(spark, sf_dir):
    return _stamped(alerts.prediction_imbalance(routed(spark, sf_dir), "ts", F.col("prediction") == 1, ["destination"], WIDTH, SLIDE, LIMITS))


def _runs_sql(where: str = "true") -> str:
    return f"""{_ERRORS},
marks as (select destination, ws + interval 1 hour t, rate > 3/3600.0::double hot from errors where {where}),
steps as (select *, epoch(t)::bigint//1800 - row_number() over (partition by destination order by t) run from marks where hot),
runs as (select destination, min(t) a, max(t) b, count(*)::bigint evaluations from steps group by destination, run),
spans as (select *, b - a >= interval 1 hour fires, b >= (select max(t) from marks) open_end from runs)"""


@query("alert_sustained", f"""{SLIDING}, {_runs_sql()} select destination, strftime(a,{_FMT}) pending_since, strftime(b,{_FMT}) last_true, evaluations,
 case when fires then strftime(a + interval 1 hour,{_FMT}) end firing_since, case when not open_end then strftime(b + interval 30 minutes,{_FMT}) end resolved_at,
 case when fires and open_end then 'firing' when fires then 'resolved' when open_end then 'pending' else 'inactive' end state from spans""")
def alert_sustained(spark, sf_dir):
    windows = error_windows(routed(spark, sf_dir))
    return _stamped(alerts.sustained(windows, "window_end", "breached", ["destination"], SLIDE, "1 hour"))


@query("health_summary", f"""{_ROUTED}, {_SILENT}, hourly as (select *, date_trunc('hour', ts) ws from routed),
{_histogram_sql('hourly', 'ws, path')},
rates as (select ws, path, count(*) filter (status='error')/3600.0::double rate from hourly group by all),
every as (select ws, path, rate <= 3/3600.0::double error_ok, p95 <= 8 latency_ok, true up from rates join quant using (ws, path)
 union all select ws, path, true, true, false from silent)
select strftime(ws,{_FMT}) window_start, bool_and(error_ok) error_ok, bool_and(latency_ok) latency_ok, bool_and(up) up,
 bool_and(error_ok and latency_ok and up) healthy from every group by ws""")
def health_summary(spark, sf_dir):
    return _stamped(alerts.health_summary(
        routed(spark, sf_dir), "ts", F.col("status") == "error", "latency_s", ["path"], "1 hour", LIMITS))


# --- the same rules on a stream ---------------------------------------------------------------

def event_stream(spark, sf_dir):
    """The events file as a stream source."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def routed_stream(spark, sf_dir, delay: str = "10 minutes"):
    from tablewarden.catalog.views import labelled, request_columns
    from tablewarden.operators.traffic import canary_assign

    rows = labelled(request_columns(event_stream(spark, sf_dir)).withWatermark("ts", delay))
    return canary_assign(rows, "event_id")


# A window is out once the watermark has passed it: its end lies before the last event less the delay.
_CLOSED = "ws + interval 1 hour <= (select max(ts) from request) - interval 10 minutes"


@query("stream_error_rate", f"{SLIDING}, {_ERRORS} select {_BOUNDS}, destination, n, errors, round(rate,6) rate, rate > 3/3600.0::double breached from errors where {_CLOSED}")
def stream_error_rate(spark, sf_dir):
    """Append mode: the windows that the watermark has closed."""
    windows, _ = run_available(error_windows(routed_stream(spark, sf_dir)), "error-rate")
    return _stamped(windows)


def _moves_sql(series: str, most: int) -> str:
    """Transitions of the runs of ``series``: closed windows, and runs ended by false or absent evaluations alike."""
    return f"""rates as (select ws, {series}, count(*) filter (status='error') > {most} hot from spread group by all),
steps as (select {series}, ws + interval 1 hour t, epoch(ws)::bigint//1800 - row_number() over (partition by {series} order by ws) run
 from rates where hot and {_CLOSED}),
spans as (select {series}, min(t) a, max(t) b from steps group by {series}, run),
moves as (select {series}, a t, 'pending' state, a from spans
 union all select {series}, a + interval 1 hour, 'firing', a from spans where b - a >= interval 1 hour
 union all select {series}, b + interval 30 minutes, case when b - a >= interval 1 hour then 'resolved' else 'inactive' end, a
  from spans where b + interval 30 minutes <= (select max(ts) from request) - interval 10 minutes)
select {series}, strftime(t,{_FMT}) "at", state, strftime(a,{_FMT}) pending_since from moves"""


@contextmanager
def rocksdb(spark):
    """The state store that timers need, for the queries started inside."""
    before = {key: spark.conf.get(key, None) for key in ROCKSDB}
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@query("stream_latency_sketch", f"{_SKETCH} and {_CLOSED}")
def stream_latency_sketch(spark, sf_dir):
    """The same on a stream: sketches are the state of its panes and windows."""
    windows, _ = run_available(_sketched(routed_stream(spark, sf_dir)), "sketches")
    return _stamped(windows)


@query("stream_sustained", f"{SLIDING}, {_moves_sql('destination', 3)}")
def stream_sustained(spark, sf_dir):
    """Pending, firing and resolved transitions from the stateful rule."""
    with rocksdb(spark):
        windows = error_windows(routed_stream(spark, sf_dir), event_time="event_time")
        moves, _ = run_available(hold_for(windows, "window_end", "breached", ["destination"], SLIDE, "1 hour", "event_time"), "hold")
    return _stamped(moves)


@query("stream_sustained_by_user", f"{SLIDING}, {_moves_sql('user_id', 0)}")
def stream_sustained_by_user(spark, sf_dir):
    """The same per user: series of few events, which fall silent in the middle of a run."""
    limits = Thresholds(error_rate=0.5 / 3600)
    with rocksdb(spark):
        windows = alerts.error_rate(
            routed_stream(spark, sf_dir), "ts", F.col("status") == "error", ["user_id"], WIDTH, SLIDE, limits, "event_time")
        moves, _ = run_available(hold_for(windows, "window_end", "breached", ["user_id"], SLIDE, "1 hour", "event_time"), "hold")
    return _stamped(moves)


@query("stream_silent", f"""{_ROUTED}, seen as (select distinct date_trunc('hour', ts) ws, path from routed
 where date_trunc('hour', ts) + interval 1 hour <= (select max(ts) from routed) - interval 10 minutes),
calendar as (select path, unnest(generate_series(min(ws), date_trunc('hour', (select max(ts) from routed) - interval 10 minutes) - interval 1 hour, interval 1 hour)) ws
 from seen group by path)
select strftime(ws,{_FMT}) window_start, path from calendar c where not exists (select 1 from seen s where s.ws=c.ws and s.path=c.path)""")
def stream_silent(spark, sf_dir):
    """Closed hours without a request of a known path."""
    with rocksdb(spark):
        silent, _ = run_available(silent_intervals(routed_stream(spark, sf_dir), "ts", ["path"], "1 hour"), "silent")
    return _stamped(silent)
