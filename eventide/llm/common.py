"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import checkpoint_dir

# Words are maximal runs of anything but ASCII space and the controls 0x09-0x0D;
# ``bytes.split()`` without arguments separates on exactly these six bytes.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id written as text (null id: 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    This cuts the lineage with a copy that outlives any executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_array(values, kind: str) -> Column:
    """A constant array column of numbers (one literal, however long)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def prefix_sums(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str,
                out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``keys`` that come before.

    Rows are ordered by ``bucket``, then ``order``.  Only one bucket of a key is ever in one
    task: sums of whole buckets are scanned first, then each bucket on its own.
    """
    from pyspark.sql import Window as W
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_s"))
    over = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(bucket).alias("_b"),
                       F.coalesce(F.sum("_s").over(over), F.lit(0)).alias("_before"))
    inner = W.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = df.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    on = [F.col(bucket) == F.col("_b")] + [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (rows.join(sums, cond).withColumn(out, F.col("_before") + F.col("_in"))
            .drop("_in", "_before", "_b", *[f"_k{i}" for i in range(len(keys))]))


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the Arrow batches handed to Python workers (whole texts may be long)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def bounded_batches(spark: SparkSession, limit: int = 32 << 20) -> None:
    """Bound the bytes of Arrow batches handed to Python workers (rows may be megabytes)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def by_bytes(items: list, size, limit: int = 2 << 20):
    """Cut a list into runs of about ``limit`` bytes; an item of more is a run of its own."""
    run, total = [], 0
    for x in items:
        n = size(x)
        if run and total + n > limit:
            yield run
            run, total = [], 0
        run.append(x)
        total += n
    if run:
        yield run
