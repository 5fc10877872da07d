import pytest
from pyspark.sql import functions as F

from tablewarden.catalog.views import labelled, request, request_columns, table
from tablewarden.operators import alerts, traffic
from tablewarden.session import scratch_path
from tablewarden.spec import SUBJECT, Thresholds
from tablewarden.streaming.hold import hold_for
from tablewarden.streaming.liveness import silent_intervals
from tablewarden.streaming.runner import late_rows, run_available
from tablewarden.streaming.scoring import dead_letters

LIMITS = Thresholds(error_rate=3 / 3600)


def stream_of(spark, parts):
    """A file stream that delivers the given tables one after the other."""
    path = scratch_path(spark, "stream")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def thirds(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    n = e.count()
    return [e.where((F.col("event_id") >= n * i // 3) & (F.col("event_id") < n * (i + 1) // 3)) for i in range(3)]


@pytest.mark.parametrize("rule", [
    lambda df: alerts.request_rate(df, "ts", ["path"], "2 hours", "30 minutes"),
    lambda df: alerts.latency_histogram_p95(df, "ts", "latency_s", ["path"], "1 day", "12 hours"),
    lambda df: alerts.low_confidence_share(df, "ts", "p", [], "1 day", "1 day"),
    lambda df: alerts.prediction_imbalance(df, "ts", F.col("prediction") == 1, ["path"], "1 day", "6 hours"),
], ids=["rate", "p95", "confidence", "imbalance"])
def test_stream_equals_table(spark, sf_dir, rule):
    batch = rule(labelled(request(spark, sf_dir)))
    stream = labelled(request_columns(stream_of(spark, thirds(spark, sf_dir))).withWatermark("ts", "1 hour"))
    got, query = run_available(rule(stream), "out")
    assert late_rows(query) == 0
    closed = batch.where(F.col("window_end") <= F.lit(request(spark, sf_dir).agg(F.max("ts")).first()[0]) - F.expr("interval 1 hour"))
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed).isEmpty()


def test_late_rows_are_counted(spark, sf_dir):
    parts = list(reversed(thirds(spark, sf_dir)))
    stream = request_columns(stream_of(spark, parts)).withWatermark("ts", "10 minutes")
    got, query = run_available(alerts.request_rate(stream, "ts", ["path"], "1 hour", "1 hour"), "late")
    assert late_rows(query) > 0 and got.count() > 0


def evaluated(spark, flags, series="s"):
    rows = [(series, i, f) for i, f in enumerate(flags) if f is not None]
    df = spark.createDataFrame(rows, "series string, i int, hot boolean")
    return df.select("series", F.timestamp_seconds(F.lit(1704067200) + F.col("i") * 1800).alias("at"), "hot")


def test_sustained_states(spark):
    t, f = True, False
    # true twice; a gap; three times (fires at the third); false; true at the end
    df = evaluated(spark, [t, t, None, t, t, t, f, t])
    got = alerts.sustained(df, "at", "hot", ["series"], "30 minutes", "1 hour").orderBy("pending_since").collect()
    assert [(r["evaluations"], r["state"]) for r in got] == [(2, "inactive"), (3, "resolved"), (1, "pending")]
    assert got[1]["firing_since"] == got[1]["last_true"] and got[2]["resolved_at"] is None


def moves_of(runs):
    """The transitions that the runs of a table stand for."""
    rows = runs.collect()
    return sorted(
        [(r.series, r.pending_since, "pending", r.pending_since) for r in rows]
        + [(r.series, r.firing_since, "firing", r.pending_since) for r in rows if r.firing_since]
        + [(r.series, r.resolved_at, r.state, r.pending_since) for r in rows if r.resolved_at])


@pytest.mark.parametrize("cut", ["2024-01-01 02:10:00", "2024-01-01 00:40:00", "2024-01-01 04:10:00"])
def test_hold_on_a_stream_equals_the_table(spark, cut):
    t, f = True, False
    df = evaluated(spark, [t, t, None, t, t, t, f, t, f, f, f, f])
    df = df.unionAll(evaluated(spark, [f, t, t, t, t, None, None, t, t, f], "returns"))
    df = df.unionAll(evaluated(spark, [f, t, t, t], "silent in a firing run")).unionAll(evaluated(spark, [t], "silent at once"))
    df = df.unionAll(evaluated(spark, [f] * 9 + [t, t, t], "open"))
    halves = [df.where(f"at < '{cut}'"), df.where(f"at >= '{cut}'")]
    stream = stream_of(spark, halves).withWatermark("at", "0 seconds")
    events, _ = run_available(hold_for(stream, "at", "hot", ["series"], "30 minutes", "1 hour"), "hold")
    got = sorted((r.series, r.at, r.state, r.pending_since) for r in events.collect())
    assert got == moves_of(alerts.sustained(df, "at", "hot", ["series"], "30 minutes", "1 hour"))
    assert {m[2] for m in got if m[0] == "silent in a firing run"} == {"pending", "firing", "resolved"}


def test_silent_intervals_on_a_stream(spark):
    hour = lambda *h: [(x * 3600 + 60,) for x in h]
    first = [("a", *x) for x in hour(0, 1, 4)] + [("b", *x) for x in hour(2)]
    second = [("a", *x) for x in hour(5, 9)] + [("c", *x) for x in hour(6, 7, 12)]
    parts = [spark.createDataFrame(p, "series string, s long").select("series", F.timestamp_seconds("s").alias("ts")) for p in (first, second)]
    stream = stream_of(spark, parts).withWatermark("ts", "0 seconds")
    silent, _ = run_available(silent_intervals(stream, "ts", ["series"], "1 hour"), "silent")
    got = sorted((r.series, r.at) for r in silent.select("series", (F.unix_timestamp("window_start") / 3600).cast("int").alias("at")).collect())
    want = [("a", x) for x in (2, 3, 6, 7, 8, 10, 11)] + [("b", x) for x in range(3, 12)] + [("c", x) for x in (8, 9, 10, 11)]
    assert got == want


def test_sketch_error(spark):
    """Two hundred thousand latencies in twelve panes: the rank of the merged p95 is off by less than is stated."""
    df = spark.range(200_000).select(
        F.timestamp_seconds(F.col("id") % 3600).alias("ts"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e9).alias("latency_s"))
    panes = alerts.latency_panes(df, "ts", "latency_s", [], "5 minutes", 200)
    assert panes.count() == 12 and panes.select(F.max(F.octet_length("sketch"))).first()[0] < 10_000
    got = alerts.latency_sketch_p95(panes, [], "1 hour", "1 hour", k=200).first()
    rank = df.where(F.col("latency_s") <= got["p95"]).count() / 200_000
    assert got["n"] == 200_000 and abs(rank - 0.95) < 2.3 / 200
    none = alerts.latency_panes(df.limit(5).withColumn("latency_s", F.lit(None).cast("double")), "ts", "latency_s", [], "5 minutes")
    assert alerts.latency_sketch_p95(none, [], "1 hour", "1 hour").first()["p95"] is None


def test_histogram_edges(spark):
    counts = [F.lit(c) for c in (0, 0, 4)]
    df = spark.range(1)
    # All in the open bucket: the highest finite bound.
    assert df.select(alerts.histogram_quantile(0.95, counts, (1.0, 2.0, float("inf")))).first()[0] == 2.0
    half = [F.lit(c) for c in (2, 4, 4)]
    assert df.select(alerts.histogram_quantile(0.75, half, (1.0, 2.0, float("inf")))).first()[0] == 1.5
    assert df.select(alerts.histogram_quantile(0.5, [F.lit(0)] * 3, (1.0, 2.0, float("inf")))).first()[0] is None


def test_canary(spark):
    df = spark.range(20000)
    with pytest.raises(ValueError):
        traffic.canary_assign(df, "id", 1.5)
    low, high = (traffic.canary_assign(df, "id", r).where("destination = 'model_v2'").select("id") for r in (0.2, 0.4))
    assert low.exceptAll(high).isEmpty()  # raising the ratio only adds requests
    none = traffic.canary_verify(traffic.canary_assign(df, "id"), F.lit(False)).first()
    assert (none["canary_share"], none["within_tolerance"], none["errors"]) == (None, False, 20000)
    assert traffic.canary_verify(traffic.canary_assign(df, "id"), F.lit(True)).first()["within_tolerance"]


def test_dead_letters(spark):
    rows = spark.createDataFrame([(1, 50, "Yes", "Local"), (2, 130, "Male", "Regional"), (3, None, "x", "Regional")],
                                 "subject_id int, age int, smoking string, stage string")
    got = {r["subject_id"]: r["errors"] for r in dead_letters(rows, SUBJECT).collect()}
    assert [len(got[i]) for i in (1, 2, 3)] == [1, 1, 2]
