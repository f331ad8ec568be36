"""Batch and streaming readers for the text inputs.

All readers return ``ts`` (TIMESTAMP instant) and ``seq`` (arrival number).
``seq`` follows the order of the files (``files``: by name, or by modification
time), then the order of the lines in a file, whatever the sizes of files and
splits.  Streams cannot number rows: there ``seq`` is a hash of the file path and
the row, a deterministic tie-break for rows with equal event times (stateful
stream operators order by (ts, seq) after buffering).

Lines are parsed whole, whatever columns a job goes on to read, so a bad number in an unused
field counts.  ``mode``: ``FAILFAST`` (the reference's behaviour: a bad line fails the job),
``PERMISSIVE`` (bad fields become null and the raw line is kept in ``_corrupt_record``) or
``DROPMALFORMED``.  ``read_branches`` reads the good rows and the bad lines, these with their file,
line number and reason, from one parse.  Empty lines are no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import to_event_time
from eventide.sources import schemas as S


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


CORRUPT, REASON = "_corrupt_record", "_reason"
MARKED = "MARKED"           # as PERMISSIVE, with the line's place and the reason (read_branches)
PLACE = ("_file", "_place", "_at")


def _csv(spark, path, schema, stream=False, trim=False, mode="FAILFAST", files="name") -> DataFrame:
    return parse_csv(_lines(spark, path, stream, files, mode == MARKED), schema, trim, mode)


def parse_csv(lines: DataFrame, schema: T.StructType, trim: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """The fields of each line's ``value`` by position, and the other columns of ``lines``."""
    lines = lines.filter("trim(value) <> ''")
    options = {"mode": "FAILFAST" if mode == "FAILFAST" else "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
               "ignoreLeadingWhiteSpace": str(trim).lower(), "ignoreTrailingWhiteSpace": str(trim).lower()}
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    # the raw text of a line that does not parse stands next to its null fields
    fields += "" if mode == "FAILFAST" else f", {CORRUPT} string"
    # a generator's output is computed once: filters and projections above it don't parse again
    rows = lines.select("*", F.explode(F.array(F.from_csv("value", fields, options))).alias("_row"))
    reason = [_field_reason(schema, trim).alias(REASON)] if mode == MARKED else []
    out = rows.select("_row.*", *reason, *[c for c in lines.columns if c != "value"])
    if mode == "DROPMALFORMED":
        return out.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return out


def _field_reason(schema: T.StructType, trim: bool) -> Column:
    """Why a line does not parse: the number of its fields, or the first that is no number."""
    parts = F.split("value", ",")
    wrong = F.lit(None).cast("string")
    for i, f in reversed(list(enumerate(schema.fields))):
        if not isinstance(f.dataType, T.StringType):
            text = F.trim(parts[i]) if trim else parts[i]
            kind = f.dataType.simpleString()
            bad = (text != "") & text.try_cast(kind).isNull()
            wrong = F.when(bad, F.concat(F.lit(f"{f.name} is no {kind}: "), text)).otherwise(wrong)
    found, wanted = F.size(parts), len(schema.fields)
    wrong = F.when(found != wanted, F.concat(F.lit(f"{wanted} fields expected, found "), found.cast("string"))).otherwise(wrong)
    return F.when(F.col(f"_row.{CORRUPT}").isNotNull(), F.coalesce(wrong, F.lit("the line does not parse")))


ROW_BITS = 33               # a partition's rows: the low bits of monotonically_increasing_id()
BROADCAST_FILES = 1 << 17   # a larger file list is joined as Catalyst likes
FILE_ORDERS = {"name": "path", "modified": "modified, path"}


def _with_seq(df: DataFrame, stream: bool, path=None, files: str = "name") -> DataFrame:
    if not stream:
        return _arrival(df, path, files)
    # streams cannot number rows; a hash of the file and the row's fields gives rows with
    # equal event times a deterministic order (the same on every replay)
    return df.withColumn("seq", F.xxhash64(F.col("_metadata.file_path"), *[F.col(c) for c in df.columns]))


def _bytes(setting: str) -> int:
    """A Spark size setting ("134217728b", "4m") in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _least_split(spark: SparkSession) -> int:
    """No two splits of a file start nearer to each other than this."""
    sizes = (spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes"))
    return max(1, min(map(_bytes, sizes)))


def _file_places(spark: SparkSession, path, files: str, unit: int) -> DataFrame:
    """(_path, _first): the number of split places in the files before this one (no content is read)."""
    listed = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
        (F.floor(F.col("length") / unit) + 1).alias("places"))
    # one row per file in one task: the list that the driver holds as well
    before = F.expr(f"sum(places) OVER (ORDER BY {FILE_ORDERS[files]} "
                    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return listed.select(F.col("path").alias("_path"), F.coalesce(before, F.lit(0)).alias("_first"))


def _arrival(df: DataFrame, path, files: str, marked: bool = False) -> DataFrame:
    """Add ``seq``: file order, then the split's place in its file, then the row's place in its split.

    The rows of one split are read by one task in order, so their row numbers rise; the place of
    the split comes from its file and offset, not from the way Spark packs splits into tasks.
    """
    spark = df.sparkSession
    unit = _least_split(spark)
    names = df.columns
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    rows = df.select(*names, F.col("_metadata.file_path").alias("_file"),
                     F.floor(F.col("_metadata.file_block_start") / unit).alias("_place"), row.alias("_at"))
    places = _file_places(spark, path, files, unit)
    if places.count() <= BROADCAST_FILES:
        places = F.broadcast(places)
    rows = rows.join(places, F.col("_file") == F.col("_path"))
    return rows.select(*names, F.shiftleft(F.col("_first") + F.col("_place"), ROW_BITS)
                       .bitwiseOR(F.col("_at")).alias("seq"), *(PLACE if marked else ()))


def _lines(spark, path, stream, files, marked=False) -> DataFrame:
    lines = _reader(spark, stream).text(path)
    if stream:
        return _with_seq(lines, True)
    return _arrival(lines, path, files, marked)


def read_lines(spark: SparkSession, path: str, stream: bool = False, files: str = "name") -> DataFrame:
    """One string per line (``value``) plus ``seq``; ``files``: "name" or "modified" order."""
    return _lines(spark, path, stream, files)


class ReadResult(NamedTuple):
    rows: DataFrame         # what the reader gives
    malformed: DataFrame    # file, line (from 1), reason, value


def read_branches(reader: Callable, spark: SparkSession, path: str, **options) -> ReadResult:
    """The rows of ``reader`` and, as a branch of the same parse, the lines that do not parse.

    A line's number in its file is its row's place in its split plus the lines of the splits
    before; these are counted by a pass that reads no fields.
    """
    marked = reader(spark, path, mode=MARKED, **options)
    bad = marked.filter(F.col(CORRUPT).isNotNull())
    rows = marked.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, REASON, *PLACE)
    splits = (_lines(spark, path, False, options.get("files", "name"), True).groupBy("_file", "_place")
              .agg(F.min("_at").alias("_least"), F.count(F.lit(1)).alias("_n")))
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("_file", "_place", "_least", F.coalesce(before, F.lit(0)).alias("_before"))
    bad = bad.join(splits, ["_file", "_place"]).select(
        F.col("_file").alias("file"), (F.col("_at") - F.col("_least") + F.col("_before") + 1).alias("line"),
        F.col(REASON).alias("reason"), F.col(CORRUPT).alias("value"))
    return ReadResult(rows, bad)


def read_user_behavior(spark, path, stream=False, mode="FAILFAST", files="name") -> DataFrame:
    """user_id, item_id, category_id, behavior, ts_s (fields trimmed)."""
    df = _csv(spark, path, S.USER_BEHAVIOR, stream, trim=True, mode=mode, files=files)
    return to_event_time(df, "ts_s", "s")


def read_ad_clicks(spark, path, stream=False, mode="FAILFAST", files="name") -> DataFrame:
    """S3: user_id, ad_id, province, city, ts_s (not trimmed)."""
    return to_event_time(_csv(spark, path, S.AD_CLICK, stream, mode=mode, files=files), "ts_s", "s")


def read_logins(spark, path, stream=False, mode="FAILFAST", files="name") -> DataFrame:
    """user_id, ip, event_type, ts_s."""
    return to_event_time(_csv(spark, path, S.LOGIN, stream, mode=mode, files=files), "ts_s", "s")


def read_orders(spark, path, stream=False, mode="FAILFAST", files="name") -> DataFrame:
    """order_id, pay_status, pay_id, ts_s; an empty pay_id stays ``""``."""
    df = _csv(spark, path, S.ORDER_PAY, stream, mode=mode, files=files)
    df = df.withColumn("pay_id", F.coalesce(F.col("pay_id"), F.lit("")))
    return to_event_time(df, "ts_s", "s")


def read_receipts(spark, path, stream=False, mode="FAILFAST", files="name") -> DataFrame:
    """pay_id, pay_type, ts_s."""
    return to_event_time(_csv(spark, path, S.RECEIPT, stream, mode=mode, files=files), "ts_s", "s")


def read_marketing(spark, path, stream=False, mode="FAILFAST", files="name") -> DataFrame:
    """Marketing events: user_id, behavior, channel, ts_ms (epoch milliseconds)."""
    return to_event_time(_csv(spark, path, S.MARKETING, stream, mode=mode, files=files), "ts_ms", "ms")


LOG_FIELDS = 7


def parse_access_log(lines: DataFrame, tz: str = "UTC", mode: str = "FAILFAST") -> DataFrame:
    """Split each ``value`` on single spaces; ip = field 0, time = field 3
    (``dd/MM/yyyy:HH:mm:ss`` read in zone ``tz``; the zone field 4 is ignored like the
    reference), method = field 5, url = field 6."""
    parts = F.split(F.col("value"), " ")
    raw_time = F.trim(parts.getItem(3))
    fmt = F.lit(S.ACCESS_LOG_TIME_FORMAT)
    if mode == "FAILFAST":
        wall = F.to_timestamp_ntz(raw_time, fmt)
        # the reference reads fields 0, 3, 5 and 6 of every line
        short = F.raise_error(F.concat(F.lit("access log line with too few fields: "), F.col("value")))
        lines = lines.withColumn("value", F.when(F.size(parts) < LOG_FIELDS, short.cast("string")).otherwise(F.col("value")))
    else:
        # parsed in the session zone and cast back: the same wall-clock time, null if malformed
        wall = F.try_to_timestamp(raw_time, fmt).cast(T.TimestampNTZType())
    utc_wall = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    reason = (F.when(F.size(parts) < LOG_FIELDS, F.concat(F.lit(f"{LOG_FIELDS} fields expected, found "), F.size(parts).cast("string")))
              .when(wall.isNull(), F.concat(F.lit("no time: "), raw_time)))
    marks = [c for c in PLACE if c in lines.columns]
    df = lines.select(
        F.trim(parts.getItem(0)).alias("ip"),
        utc_wall.alias("_wall"),
        F.trim(parts.getItem(5)).alias("method"),
        F.trim(parts.getItem(6)).alias("url"),
        "seq", *marks, F.when(reason.isNotNull(), F.col("value")).alias(CORRUPT), reason.alias(REASON))
    df = to_event_time(df, "_wall").drop("_wall")
    if mode == MARKED:
        return df
    if mode == "DROPMALFORMED":
        df = df.filter(F.col(CORRUPT).isNull())
    return df.drop(REASON) if mode == "PERMISSIVE" else df.drop(REASON, CORRUPT)


def read_access_log(spark, path, stream=False, tz="UTC", mode="FAILFAST", files="name") -> DataFrame:
    """S7 reader: ip, method, url, ts, seq."""
    return parse_access_log(_lines(spark, path, stream, files, mode == MARKED), tz, mode)
