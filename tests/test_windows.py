import random

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from helpers import T0, frame
from eventide.operators import Count, IntAvg, Max, Min, Sum, sliding_agg, tumbling_agg
from eventide.operators.windows import window_spans
from eventide.sources import tables as T


def test_tumbling_edges(spark):
    # window [T0, T0+3600): t = start and t = end - 1 s are inside, t = end starts the next one
    base = T0 - T0 % 3600
    df = frame(spark, "k long, ts_s long", [(1, base), (1, base + 3599), (1, base + 3600), (2, base + 10)])
    out = tumbling_agg(df, "1 hour", [Count("cnt")], keys=["k"], with_start=True)
    got = rows(out, "k", "window_start", "window_end", "cnt")
    e1 = (base + 3600) * 1000
    assert got == [(1, base * 1000, e1, 2), (1, e1, e1 + 3_600_000, 1), (2, base * 1000, e1, 1)]


def test_empty_input(spark):
    df = frame(spark, "k long, ts_s long", [(1, T0)]).filter("k < 0")
    assert sliding_agg(df, "1 hour", "5 minutes", [Count("cnt")], keys=["k"]).count() == 0


def _spark_window(df, size, slide, keys):
    w = F.window("ts", size, slide)
    return (df.groupBy(*keys, w.alias("w"))
              .agg(F.count(F.lit(1)).alias("cnt"), F.sum("v").alias("s"), F.min("v").alias("mn"),
                   F.max("v").alias("mx"), F.expr("sum(v) div count(*)").alias("avg"))
              .select(*keys, F.unix_millis("w.end").alias("window_end"), "cnt", "s", "mn", "mx", "avg"))


def test_panes_equal_window_function(spark):
    random.seed(7)
    data = [(random.randint(0, 3), T0 + random.randint(0, 20_000), random.randint(-50, 50))
            for _ in range(400)]
    df = frame(spark, "k long, ts_s long, v long", data)
    aggs = [Count("cnt"), Sum("s", "v"), Min("mn", "v"), Max("mx", "v"), IntAvg("avg", "v")]
    cols = ["k", "window_end", "cnt", "s", "mn", "mx", "avg"]
    expect = rows(_spark_window(df, "1 hour", "5 minutes", ["k"]), *cols)
    for method in ("panes", "expand"):
        got = rows(sliding_agg(df, "1 hour", "5 minutes", aggs, keys=["k"], method=method), *cols)
        assert got == expect, method
    # integer sums alone: running sums over entering and leaving panes, also with null values
    sums = [Count("cnt"), IntAvg("avg", "v")]
    odd = df.withColumn("v", F.when(F.col("v") % 3 != 0, F.col("v"))).withColumn("k", F.nullif("k", F.lit(1)))
    some = ["k", "window_end", "cnt", "avg"]
    want = rows(_spark_window(odd, "1 hour", "5 minutes", ["k"]).fillna(-9, ["k"]), *some)
    for method in ("panes", "copies"):
        got = sliding_agg(odd, "1 hour", "5 minutes", sums, keys=["k"], method=method)
        assert rows(got.fillna(-9, ["k"]), *some) == want, method
    # size not a multiple of the slide falls back to the expansion
    expect = rows(_spark_window(df, "10 minutes", "3 minutes", ["k"]), *cols)
    assert rows(sliding_agg(df, "10 minutes", "3 minutes", aggs, keys=["k"]), *cols) == expect


def test_int_avg_truncates_toward_zero(spark):
    df = frame(spark, "k long, ts_s long, v long", [(1, T0, -3), (1, T0 + 1, -4)])
    out = tumbling_agg(df, "1 hour", [IntAvg("a", "v")], keys=["k"])
    assert [r.a for r in out.collect()] == [-3]  # -7 div 2 = -3, not floor -4


def test_marketing_panes_on_driver_table(spark):
    ev = T.as_marketing(T.events(spark, SF_SMALL)).filter("behavior <> 'error'")
    got = rows(sliding_agg(ev, "1 hour", "10 seconds", [Count("cnt")], keys=["channel"]),
               "channel", "window_end", "cnt")
    w = F.window("ts", "1 hour", "10 seconds")
    expect = rows(ev.groupBy("channel", w.alias("w")).count()
                    .select("channel", F.unix_millis("w.end").alias("window_end"), F.col("count").alias("cnt")),
                  "channel", "window_end", "cnt")
    assert got == expect


def test_plan_shuffles_only_pane_aggregates(spark):
    ev = T.as_marketing(T.events(spark, SF_SMALL))
    out = sliding_agg(ev, "1 hour", "10 seconds", [Count("cnt")], keys=["behavior", "channel"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one exchange for the pane partial aggregate, one to spread panes by (keys, bucket);
    # the window expansion and the merge happen after the last exchange
    assert plan.count("Exchange") == 2
    last_exchange = plan.index("Exchange")
    assert plan.index("Generate explode(sequence") < last_exchange


def test_random_window_parameters_equal_window_function(spark):
    random.seed(13)
    data = [(random.randint(0, 2), T0 + random.randint(0, 5_000), random.randint(0, 9)) for _ in range(200)]
    df = frame(spark, "k long, ts_s long, v long", data)
    for _ in range(4):
        slide = random.choice([7, 30, 60, 120])
        size = slide * random.randint(1, 6) + random.choice([0, 0, 3])
        aggs = [Count("cnt"), Sum("s", "v"), Min("mn", "v"), Max("mx", "v"), IntAvg("avg", "v")]
        cols = ["k", "window_end", "cnt", "s", "mn", "mx", "avg"]
        expect = rows(_spark_window(df, f"{size} seconds", f"{slide} seconds", ["k"]), *cols)
        got = rows(sliding_agg(df, f"{size} seconds", f"{slide} seconds", aggs, keys=["k"]), *cols)
        assert got == expect, (size, slide)


def test_spans_hold_two_rows_a_pane(spark):
    # one event a key: 360 windows, but one span (two where it reaches over a bucket's end)
    df = frame(spark, "k long, ts_s long", [(k, T0 + 977 * k) for k in range(50)])
    spans = window_spans(df, 3_600_000, 10_000, [Count("cnt")], ["k"])
    assert 50 <= spans.count() <= 100
    assert sliding_agg(df, "1 hour", "10 seconds", [Count("cnt")], keys=["k"]).count() == 50 * 360
