"""Run one of the reference's jobs on its text inputs.

    python -m eventide.plans.run hot_items --input behaviour.csv --output out/
    python -m eventide.plans.run receipt_match --input orders.csv --input2 receipts.csv --output out/
    python -m eventide.plans.run --stream hot_items --input in_dir/ --output out/ --checkpoint ckpt/

A ``--stream`` run reads the files that are there, ends, and then finishes what its operators still
hold, so it gives the batch run's rows; ``--continuous`` keeps it running.  A job's output is written as parquet under
``<output>/<branch>``; a job with side outputs is computed and written in one pass, as
``<output>/branch=<name>`` (``read_branch`` gives a branch's own columns).  ``--output -`` prints
every row instead (the reference's print sink).  Parameters default to the reference's.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventide import sources as S
from eventide.plans import jobs
from eventide.streaming.stores import exists


def _branches(result) -> dict[str, DataFrame]:
    if isinstance(result, DataFrame):
        return {"result": result}
    return dict(result._asdict())


def _orders_pays(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("pay_status") == "pay").select("pay_id", "ts", "seq", "order_id")


# job name -> (readers for --input / --input2, job)
JOBS: dict[str, tuple[list[Callable], Callable]] = {
    "hot_items": ([S.read_user_behavior], lambda b: jobs.hot_items(b)),
    "hot_items_report": ([S.read_user_behavior], lambda b: jobs.hot_items_report(b)),
    "page_views": ([S.read_user_behavior], lambda b: jobs.page_views(b)),
    "unique_visitors": ([S.read_user_behavior], lambda b: jobs.unique_visitors(b)),
    "unique_visitors_bitmap": ([S.read_user_behavior], lambda b: jobs.unique_visitors_running(b)),
    "marketing_total": ([S.read_marketing], lambda m: jobs.marketing_total(m, text_bounds=True)),
    "marketing_by_channel": ([S.read_marketing], lambda m: jobs.marketing_by_channel(m, text_bounds=True)),
    "ad_blacklist": ([S.read_ad_clicks], lambda a: jobs.ad_clicks_by_province(a)),
    "login_failures": ([S.read_logins], lambda lg: jobs.login_failures(lg, keyed=False)),
    "order_timeout": ([S.read_orders], lambda o: jobs.order_timeout(o)),
    "receipt_match": ([S.read_orders, S.read_receipts],
                      lambda o, r: jobs.receipt_match(_orders_pays(o), r.drop("ts_s"))),
    "receipt_interval_join": ([S.read_orders, S.read_receipts],
                              lambda o, r: jobs.receipt_interval_join(_orders_pays(o), r.drop("ts_s"))),
    "top_urls": ([S.read_access_log],
                 lambda log: jobs.top_urls(log, delay="5 seconds", lateness="60 seconds")),
}


# the jobs with side outputs as one frame each
OUTCOMES: dict[str, Callable] = {
    "ad_blacklist": lambda a: jobs.ad_outcome(a),
    "order_timeout": lambda o: jobs.order_outcome(o),
    "receipt_match": lambda o, r: jobs.receipt_outcome(_orders_pays(o), r.drop("ts_s")),
}


def run_outcome(spark: SparkSession, name: str, inputs: list[str], output: str, malformed: bool = False) -> dict[str, int]:
    """Run a job with side outputs once: one read of each input, one partitioned write, and the
    branches' row counts taken on the way.  ``malformed``: as in ``run_job``; the lines that do not
    parse go to ``<output>/branch=malformed``."""
    readers, bad = JOBS[name][0], []
    if malformed:
        read = [S.read_branches(r, spark, p) for r, p in zip(readers, inputs)]
        frames, bad = [x.rows for x in read], [x.malformed for x in read]
    else:
        frames = [r(spark, p) for r, p in zip(readers, inputs)]
    outcome = OUTCOMES[name](*frames)
    seen = Observation()
    counts = [F.count(F.when(F.col("branch") == b, 1)).alias(b) for b in outcome.branches]
    outcome.frame.observe(seen, *counts).write.mode("overwrite").partitionBy("branch").parquet(output)
    found = dict(seen.get)
    for i, lines in enumerate(bad, 1):
        lines.select(F.lit(i).alias("input"), "*").write.mode("overwrite" if i == 1 else "append") \
            .parquet(os.path.join(output, "branch=malformed"))
    return found


def read_branch(spark: SparkSession, name: str, inputs: list[str], output: str, branch: str) -> DataFrame:
    """A branch written by ``run_outcome``, with its own columns."""
    outcome = OUTCOMES[name](*[r(spark, p) for r, p in zip(JOBS[name][0], inputs)])
    schema = outcome.frame.drop("branch").schema
    path = os.path.join(output, f"branch={branch}")
    if not exists(spark, path):
        return spark.createDataFrame([], schema).select(*outcome.branches[branch])
    return spark.read.schema(schema).parquet(path).select(*outcome.branches[branch])


def run_job(spark: SparkSession, name: str, inputs: list[str], malformed: bool = False) -> dict[str, DataFrame]:
    """The job's output branches.  A line that does not parse fails the job, or with ``malformed``
    goes to a branch of that name (input, file, line, reason, value)."""
    readers, job = JOBS[name]
    if len(inputs) != len(readers):
        raise SystemExit(f"{name} needs {len(readers)} input(s)")
    if not malformed:
        return _branches(job(*[r(spark, p) for r, p in zip(readers, inputs)]))
    read = [S.read_branches(r, spark, p) for r, p in zip(readers, inputs)]
    bad = [x.malformed.select(F.lit(i).alias("input"), "*") for i, x in enumerate(read, 1)]
    whole = bad[0]
    for more in bad[1:]:
        whole = whole.unionByName(more)
    return {**_branches(job(*[x.rows for x in read])), "malformed": whole}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--stream", action="store_true", help="run the Structured Streaming form")
    ap.add_argument("--checkpoint", help="checkpoint folder (stream); default under spark.checkpoint.dir")
    ap.add_argument("--continuous", action="store_true", help="keep running (stream); default availableNow")
    ap.add_argument("--malformed", action="store_true", help="lines that do not parse become a branch (batch)")
    ap.add_argument("--input", required=True)
    ap.add_argument("--input2")
    ap.add_argument("--output", default="-")
    a = ap.parse_args(argv)
    from eventide.session import get_session
    spark = get_session(master=os.environ.get("EVENTIDE_MASTER", "local[*]"))
    inputs = [p for p in (a.input, a.input2) if p]
    if a.stream:
        from eventide.plans import stream_jobs
        from eventide.streaming.windows import checkpoint_location
        if a.output == "-":
            raise SystemExit("--stream needs --output")
        checkpoint = a.checkpoint or checkpoint_location(spark, a.job)
        stream_jobs.start(spark, a.job, inputs, a.output, checkpoint, not a.continuous).awaitTermination()
        if not a.continuous:
            stream_jobs.finish(spark, a.job, inputs, a.output, checkpoint)
        return
    if a.job in OUTCOMES and a.output != "-":
        print(run_outcome(spark, a.job, inputs, a.output, a.malformed))
        return
    outs = run_job(spark, a.job, inputs, a.malformed)
    for branch, df in outs.items():
        if a.output == "-":
            print(f"== {branch}")
            print(*df.columns, sep="\t")
            for row in df.toLocalIterator():    # one partition at a time
                print(*row, sep="\t")
        else:
            df.write.mode("overwrite").parquet(os.path.join(a.output, branch))


if __name__ == "__main__":
    main()
