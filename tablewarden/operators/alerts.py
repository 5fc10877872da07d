"""Windowed rules over a request log, for tables and for streams.

Sliding windows are built in two steps. Rows are first combined in panes, the
tumbling windows of one slide, and only the panes are copied into the windows
that cover them. With a five-minute window every thirty seconds that copies
one row per pane and series ten times, not every request.

All functions take a DataFrame with an event-time column of type timestamp. On
a stream the caller sets the watermark; both aggregations then run in append
mode.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.operators.ranks import exact_quantiles
from tablewarden.operators.scoring import confidence_tier
from tablewarden.spec import Thresholds

# Upper bounds of the latency histogram, in seconds; the last bucket is open.
LATENCY_BUCKETS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf"),
)

# Values that a quantile sketch keeps about; its error falls with it.
SKETCH_K = 800

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(duration: str) -> int:
    """Seconds of a duration such as ``30 minutes``."""
    number, unit = duration.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def sliding(
    df: DataFrame, ts: str, width: str, slide: str, keys: Sequence[str], sums: Mapping[str, Column],
    event_time: str | None = None,
) -> DataFrame:
    """(window_start, window_end, keys, sums): additive measures per sliding window.

    ``event_time`` names one more column, the windows' event time, which stateful rules on the same stream need.
    """
    if seconds(width) % seconds(slide):
        raise ValueError("the window must be a whole number of slides")
    panes = df.groupBy(F.window(ts, slide).alias("__pane"), *keys).agg(
        *[c.alias(name) for name, c in sums.items()]
    )
    if width == slide:
        spread = panes.withColumnRenamed("__pane", "__window")
    else:
        spread = panes.groupBy(F.window(F.window_time("__pane"), width, slide).alias("__window"), *keys).agg(
            *[F.sum(name).alias(name) for name in sums]
        )
    times = [F.window_time("__window").alias(event_time)] if event_time else []
    return spread.select(
        F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"), *keys, *sums, *times
    )


def request_rate(df: DataFrame, ts: str, keys: Sequence[str], width: str, slide: str) -> DataFrame:
    """Requests per second of each series and window."""
    out = sliding(df, ts, width, slide, keys, {"n": F.count("*")})
    return out.withColumn("rate", F.col("n") / float(seconds(width)))


def error_rate(
    df: DataFrame, ts: str, failed: Column, keys: Sequence[str], width: str, slide: str,
    limits: Thresholds = Thresholds(), event_time: str | None = None,
) -> DataFrame:
    """Errors per second of each series and window, and whether they breach the limit."""
    out = sliding(df, ts, width, slide, keys, {"n": F.count("*"), "errors": F.count_if(failed)}, event_time)
    out = out.withColumn("rate", F.col("errors") / float(seconds(width)))
    return out.withColumn("breached", F.col("rate") > limits.error_rate)


def bucket_counts(latency: Column) -> dict[str, Column]:
    """Cumulative histogram: requests at or below each bound."""
    return {
        f"le_{i}": F.count("*") if bound == float("inf") else F.count_if(latency <= bound)
        for i, bound in enumerate(LATENCY_BUCKETS)
    }


def histogram_quantile(q: float, counts: Sequence[Column], bounds: Sequence[float] = LATENCY_BUCKETS) -> Column:
    """Quantile of a cumulative histogram, linear inside its bucket.

    The first bucket starts at 0. A rank in the open bucket gives the highest
    finite bound.
    """
    rank = F.lit(q) * counts[-1]
    out = None
    for i, bound in enumerate(bounds):
        low = 0.0 if i == 0 else bounds[i - 1]
        below = F.lit(0) if i == 0 else counts[i - 1]
        if bound == float("inf"):
            value: Column = F.lit(low)
        else:
            value = F.lit(low) + (bound - low) * F.try_divide(rank - below, (counts[i] - below).cast("double"))
        test = counts[i] >= rank
        out = F.when(counts[-1] == 0, None).when(test, value) if out is None else out.when(test, value)
    return out


def latency_histogram_p95(
    df: DataFrame, ts: str, latency: str, keys: Sequence[str], width: str, slide: str,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """p95 from bucket counts: mergeable state of fixed size, fit for streams."""
    counts = bucket_counts(F.col(latency))
    out = sliding(df, ts, width, slide, keys, counts)
    p95 = histogram_quantile(0.95, [F.col(c) for c in counts])
    n = F.col(f"le_{len(LATENCY_BUCKETS) - 1}")
    out = out.select("window_start", "window_end", *keys, n.alias("n"), p95.alias("p95"))
    return out.withColumn("breached", F.col("p95") > limits.latency_p95)


def latency_exact_p95(
    df: DataFrame, ts: str, latency: str, keys: Sequence[str], width: str, slide: str,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Exact p95 per window and series (tables only).

    No group is gathered: ranks come from counts per value, in ranges.
    """
    panes = df.groupBy(F.window(ts, slide).alias("__pane"), *keys, latency).agg(F.count("*").alias("__n"))
    rows = panes.select(F.window(F.window_time("__pane"), width, slide).alias("__window"), *keys, latency, "__n")
    flat = rows.select(
        F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"),
        *keys, latency, "__n",
    )
    grouping = ["window_start", "window_end", *keys]
    found = exact_quantiles(flat, grouping, latency, [0.95], weight="__n")
    return found.select(*grouping, F.col("quantile").alias("p95")).withColumn(
        "breached", F.col("p95") > limits.latency_p95
    )


def latency_panes(
    df: DataFrame, ts: str, latency: str, keys: Sequence[str], slide: str, k: int = SKETCH_K
) -> DataFrame:
    """(pane, keys, sketch): a quantile sketch per tumbling pane, to be stored and merged into any windows of panes.

    A sketch (KLL) holds some multiple of ``k`` values however many requests it has seen. Ranks of its quantiles are off
    by about 2.3 / k of the requests at a confidence of 99 %; up to ``k`` requests are kept as they are, so ranks are exact.
    """
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys)
    return panes.agg(F.kll_sketch_agg_double(F.col(latency).cast("double"), F.lit(k)).alias("sketch"))


def latency_sketch_p95(
    panes: DataFrame, keys: Sequence[str], width: str, slide: str, limits: Thresholds = Thresholds(), k: int = SKETCH_K
) -> DataFrame:
    """p95 per sliding window from the sketches of its panes, on tables and on streams.

    The quantile is a latency that occurs: the smallest one with 95 % of the requests at or below it.
    """
    spread = panes.groupBy(F.window(F.window_time("pane"), width, slide).alias("__window"), *keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    n = F.kll_sketch_get_n_double("sketch")
    p95 = F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.95)))
    return spread.select(
        F.col("__window.start").alias("window_start"), F.col("__window.end").alias("window_end"), *keys, n.alias("n"), p95.alias("p95"),
    ).withColumn("breached", F.col("p95") > limits.latency_p95)


def low_confidence_share(
    df: DataFrame, ts: str, probability: str, keys: Sequence[str], width: str, slide: str,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    low = F.count_if(confidence_tier(F.col(probability)) == "Low")
    out = sliding(df, ts, width, slide, keys, {"n": F.count("*"), "low": low})
    out = out.withColumn("share", F.col("low") / F.col("n").cast("double"))
    return out.withColumn("breached", F.col("share") > limits.low_confidence_share)


def prediction_imbalance(
    df: DataFrame, ts: str, positive: Column, keys: Sequence[str], width: str, slide: str,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Distance of the positive share from the expected one."""
    out = sliding(df, ts, width, slide, keys, {"n": F.count("*"), "positives": F.count_if(positive)})
    share = F.col("positives") / F.col("n").cast("double")
    out = out.withColumn("imbalance", F.abs(share - limits.expected_positive_share))
    return out.withColumn("breached", F.col("imbalance") > limits.positive_share_slack)


def silent_series(df: DataFrame, ts: str, keys: Sequence[str], width: str) -> DataFrame:
    """(window_start, keys) of the intervals in which a known series has no event.

    The calendar is unfolded per series from the extremes of the whole table.
    Its size is series times intervals, independent of the number of events.
    """
    seen = df.groupBy(F.window(ts, width)["start"].alias("window_start"), *keys).agg(F.count("*").alias("n"))
    extremes = seen.agg(F.struct(F.min("window_start").alias("lo"), F.max("window_start").alias("hi")).alias("e")).scalar()
    every = F.expr(f"interval {seconds(width)} seconds")
    calendar = (
        seen.select(*keys).distinct().withColumn("__e", extremes)
        .select(*keys, F.explode(F.sequence(F.col("__e.lo"), F.col("__e.hi"), every)).alias("window_start"))
    )
    return calendar.join(seen.select("window_start", *keys), ["window_start", *keys], "left_anti")


def sustained(
    evaluated: DataFrame, at: str, condition: str, keys: Sequence[str], every: str, hold: str
) -> DataFrame:
    """Runs of a true condition: (keys, pending_since, last_true, evaluations, firing_since, resolved_at, state).

    A run is broken by a false or an absent evaluation. It fires when it has
    lasted for ``hold``. ``resolved_at`` is null while the run reaches the
    latest evaluation of all series. The input has one row per series and
    evaluation, so its windows do not grow with the number of events.
    """
    step, needed = seconds(every), seconds(hold)
    order = Window.partitionBy(*keys).orderBy(at) if keys else Window.partitionBy().orderBy(at)
    latest = evaluated.agg(F.max(at)).scalar()
    runs = evaluated.where(F.col(condition)).withColumn(
        "__run", (F.unix_timestamp(at) / step).cast("long") - F.row_number().over(order)
    )
    spans = runs.groupBy(*keys, "__run").agg(
        F.min(at).alias("pending_since"), F.max(at).alias("last_true"), F.count("*").alias("evaluations")
    )
    lasted = F.unix_timestamp("last_true") - F.unix_timestamp("pending_since")
    fires = lasted >= needed
    open_end = F.col("last_true") >= latest
    return spans.select(
        *keys, "pending_since", "last_true", "evaluations",
        F.when(fires, F.timestamp_seconds(F.unix_timestamp("pending_since") + needed)).alias("firing_since"),
        F.when(~open_end, F.timestamp_seconds(F.unix_timestamp("last_true") + step)).alias("resolved_at"),
        F.when(fires & open_end, "firing").when(fires, "resolved").when(open_end, "pending").otherwise("inactive")
        .alias("state"),
    )


def health_summary(
    df: DataFrame, ts: str, failed: Column, latency: str, keys: Sequence[str], width: str,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Per interval: error rate, p95 latency and liveness of all series, and the overall verdict.

    Absent data passes the two rate rules and fails liveness.
    """
    counts = {"n": F.count("*"), "errors": F.count_if(failed), **bucket_counts(F.col(latency))}
    per_series = sliding(df, ts, width, width, keys, counts)
    p95 = histogram_quantile(0.95, [F.col(f"le_{i}") for i in range(len(LATENCY_BUCKETS))])
    measured = per_series.select(
        "window_start", *keys,
        (F.col("errors") / float(seconds(width)) <= limits.error_rate).alias("error_ok"),
        (p95 <= limits.latency_p95).alias("latency_ok"),
        F.lit(True).alias("up"),
    )
    silent = silent_series(df, ts, keys, width).select(
        "window_start", *keys,
        F.lit(True).alias("error_ok"), F.lit(True).alias("latency_ok"), F.lit(False).alias("up"),
    )
    return measured.unionByName(silent).groupBy("window_start").agg(
        F.bool_and("error_ok").alias("error_ok"),
        F.bool_and("latency_ok").alias("latency_ok"),
        F.bool_and("up").alias("up"),
        F.bool_and(F.col("error_ok") & F.col("latency_ok") & F.col("up")).alias("healthy"),
    )
