"""Streams over plain files that end: the drained run gives the batch run's rows and columns."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventide.plans import stream_jobs
from eventide.plans.run import JOBS, run_job
from eventide.streaming import bounded, checkpoint_location

T = 1_600_000_000 - 1_600_000_000 % 3600


def folder(*files):
    """A folder of text files whose modification times rise (streams read them in this order)."""
    d = tempfile.mkdtemp(prefix="eventide-bounded-")
    for i, lines in enumerate(files):
        p = os.path.join(d, f"part-{i}.csv")
        with open(p, "w") as f:
            f.write("".join(x + "\n" for x in lines))
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    return d


def halves(lines):
    """Two files, in time order as the reference's inputs are."""
    return lines[:len(lines) // 2], lines[len(lines) // 2:]


def behaviour():
    return folder(*halves([f"{u},{10 + u * i % 4},1,{'buy' if i % 7 == 3 else 'pv'},{T + 333 * i + u}"
                           for i in range(40) for u in (1, 2, 5)]))


def marketing():
    return folder(*halves([f"u{i},{('CLICK', 'INSTALL', 'UNINSTALL')[i % 3]},c{i % 2},{(T + 40 * i) * 1000 + i}" for i in range(60)]))


def clicks():
    return folder(*halves([f"{i % 2 if i < 700 else 7},{i % 3 // 2},{('north', 'south')[i % 5 // 3]},c,{T + 15 * i}" for i in range(900)]))


def logins():
    return folder(*halves([f"{i % 3},ip{i},{'fail' if i % 5 < 3 else 'success'},{T + i + i // 4}" for i in range(58)]))


def orders():
    lines = []
    for i in range(30):
        lines.append((T + 200 * i, f"o{i},create,,{T + 200 * i}"))
        if i % 4 != 1:
            t = T + 200 * i + (60 if i % 3 else 900)        # some exactly at the limit
            lines.append((t + 1, f"o{i},pay,p{i},{t + 1 if i % 3 else t}"))
    return folder(*halves([x for _, x in sorted(lines)]))


def receipts():
    return folder(*halves([f"p{i},{('wechat', 'alipay')[i % 2]},{T + 200 * i + 70 - i}" for i in range(0, 36, 1) if i % 6 != 2]))


def log():
    return folder(*halves([f"10.0.0.{i % 3} - - 13/09/2020:{12 + (i * 7) // 3600:02d}:{(i * 7) // 60 % 60:02d}:{i * 7 % 60:02d} +0000 GET /{i % 4}"
                           for i in range(80)]))


INPUTS = {"hot_items": [behaviour], "hot_items_report": [behaviour], "page_views": [behaviour],
          "unique_visitors": [behaviour], "unique_visitors_bitmap": [behaviour], "marketing_total": [marketing],
          "marketing_by_channel": [marketing], "ad_blacklist": [clicks], "login_failures": [logins],
          "order_timeout": [orders], "receipt_match": [orders, receipts],
          "receipt_interval_join": [orders, receipts], "top_urls": [log]}


def same(stream, batch, name):
    assert set(stream.columns) - {"batch"} == set(batch.columns), name
    # arrival numbers differ between streams and files; all else is compared
    cols = [c for c in batch.columns if not c.endswith("seq")]
    assert [stream.schema[c].dataType for c in cols] == [batch.schema[c].dataType for c in cols]
    assert sorted(map(str, rows(stream, *cols))) == sorted(map(str, rows(batch, *cols))), name


@pytest.mark.parametrize("name", sorted(JOBS))
def test_bounded_stream_equals_batch(spark, name):
    inputs = [make() for make in INPUTS[name]]
    out, ckpt = tempfile.mkdtemp(prefix="eventide-bounded-out-"), checkpoint_location(spark, name)
    # one file a micro-batch, so that state is carried from batch to batch
    job = stream_jobs.JOBS[name]()
    job = job._replace(readers=[_one_file(r) for r in job.readers])
    stream_jobs.start(spark, name, inputs, out, ckpt, job=job).awaitTermination()
    before = {b: spark.read.parquet(os.path.join(out, b)).count() for b in os.listdir(out)}
    stream_jobs.finish(spark, name, inputs, out, ckpt, job=job)
    expected = run_job(spark, name, inputs)
    assert set(os.listdir(out)) == set(expected)
    total = 0
    for branch, batch in expected.items():
        got = spark.read.parquet(os.path.join(out, branch))
        same(got, batch, f"{name}/{branch}")
        total += got.count() - before.get(branch, 0)
    # the end really was in the state (an inner join holds nothing back)
    assert total > 0 or name == "receipt_interval_join"


def _one_file(reader):
    def read(spark, path, stream=False):
        return reader(_OneFile(spark), path, stream=stream) if stream else reader(spark, path)
    return read


class _OneFile:
    """A session whose stream reader takes one file a micro-batch."""

    def __init__(self, spark):
        self._spark = spark

    @property
    def readStream(self):
        return self._spark.readStream.option("maxFilesPerTrigger", 1)

    def __getattr__(self, name):
        return getattr(self._spark, name)
