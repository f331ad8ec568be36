"""

H1 pane aggregation vs per-row window expansion; H2 time-bucketed lookahead vs one
partition per key; H3 first-later over the reversed order vs the forward frame;
H4 two-level running count vs one window per time window; H5 cap cut before the
shuffle (WindowGroupLimit) vs after.  Prints one JSON line of warm medians (sec).  ``--hot`` maps every row to one key
(user 0, province "0"): the case the helpers exist for.
Usage: python tools/helper_bench.py [sf_dir] [--hot]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventide.operators import Count, sliding_agg  # noqa: E402
from eventide.operators.distinct import running_distinct  # noqa: E402
from eventide.operators.limits import cap_per_key  # noqa: E402
from eventide.operators.patterns import followed_by, strict_pairs  # noqa: E402
from eventide.session import get_session  # noqa: E402
from eventide.sources import tables as T  # noqa: E402


def timed(build, repeat=3):
    runs = []
    for i in range(repeat + 1):
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        if i:
            runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    hot = "--hot" in sys.argv
    spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "16g"})
    ev = T.events(spark, sf)
    if hot:
        ev = ev.withColumn("user_id", F.lit(0).cast("long"))
    mk = T.as_marketing(ev).filter("behavior <> 'error'")
    fail = F.col("event_type") == "error"
    view, buy = F.col("event_type") == "view", F.col("event_type") == "purchase"
    out = {}
    out["H1_panes"] = timed(lambda: sliding_agg(mk, "1 hour", "10 seconds", [Count("cnt")], ["channel"]))
    out["H1_plain_expand"] = timed(lambda: sliding_agg(mk, "1 hour", "10 seconds", [Count("cnt")], ["channel"],
                                                       method="expand"))
    out["H2_buckets"] = timed(lambda: strict_pairs(ev, fail, fail, "1 hour", keys=["user_id"]))
    out["H2_plain_per_key"] = timed(lambda: strict_pairs(ev, fail, fail, None, keys=["user_id"], method="copy")
                                    .filter(F.unix_micros("second_ts") - F.unix_micros("first_ts") < 3_600_000_000))
    out["H3_reversed"] = timed(lambda: followed_by(ev, view, buy, None, keys=["user_id"], method="copy").matched)
    fwd = Window.partitionBy("user_id").orderBy("ts", "seq").rowsBetween(1, Window.unboundedFollowing)
    out["H3_plain_forward"] = timed(lambda: ev.filter(view | buy).select(
        "user_id", "seq", view.alias("p"),
        F.min(F.when(buy, F.struct("ts", "seq"))).over(fwd).alias("f")).filter("p and f is not null"))
    vw = T.as_user_behavior(ev).filter("behavior = 'view'")
    out["H4_two_level"] = timed(lambda: running_distinct(vw, "user_id", "1 hour"))
    we = F.unix_millis("ts") - F.pmod(F.unix_millis("ts"), F.lit(3_600_000)) + F.lit(3_600_000)
    w1 = Window.partitionBy("window_end", "user_id").orderBy("ts", "seq")
    w2 = Window.partitionBy("window_end").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    out["H4_plain_window"] = timed(lambda: vw.withColumn("window_end", we)
                                   .withColumn("new", (F.row_number().over(w1) == 1).cast("int"))
                                   .select("seq", "window_end", F.sum("new").over(w2).alias("uv")))
    clicks = T.as_ad_clicks(ev)
    if hot:
        clicks = clicks.withColumn("province", F.lit("0"))
    out["H5_limit_before_shuffle"] = timed(lambda: cap_per_key(clicks, ["province"], 10).kept)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    out["H5_plain_limit_after"] = timed(lambda: cap_per_key(clicks, ["province"], 10).kept)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
