"""Ranking report text (one string per window)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's report layout.
#   header  "时间：" followed by the window end as java.sql.Timestamp text
#   line    "No<rank>:" then " 商品ID=<item>" (hot items) or " url=<url>" (hot URLs),
#           then " 浏览量=<count>", newline
#   footer  24 '=' (hot items) or 28 '=' (hot URLs)
REPORT_HEADER = "时间："
RANK_PREFIX = "No"
ITEM_LABEL = " 商品ID="
URL_LABEL = " url="
COUNT_LABEL = " 浏览量="
ITEM_FOOTER = "=" * 24
URL_FOOTER = "=" * 28


def timestamp_text(ms: Column) -> Column:
    """``java.sql.Timestamp.toString`` of an epoch-ms instant in UTC:
    ``yyyy-MM-dd HH:mm:ss.f`` with the fraction's trailing zeros dropped (``.0`` if none)."""
    # UTC wall-clock time as TIMESTAMP_NTZ, so the text does not depend on the session zone
    ts = F.timestamp_add("MILLISECOND", ms, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    frac = F.pmod(ms, F.lit(1000))
    frac_txt = F.when(frac == 0, F.lit("0")).otherwise(
        F.regexp_replace(F.lpad(frac.cast("string"), 3, "0"), "0+$", ""))
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("."), frac_txt)


def format_ranking(ranked: DataFrame, key: str, metric: str, window_end: str = "window_end",
                   rank: str = "rank", key_label: str = ITEM_LABEL,
                   footer: str = ITEM_FOOTER, group_extra=()) -> DataFrame:
    """One report string per window from the output of ``top_n_per_window``.

    Groups hold at most n rows (the top-N), so ``collect_list`` is bounded.
    ``group_extra`` are columns determined by the window (such as the time bucket of
    ``sliding_top_n``) added to the grouping so the existing partitioning is reused.
    """
    line = F.concat(F.lit(RANK_PREFIX), F.col(rank).cast("string"), F.lit(":"),
                    F.lit(key_label), F.col(key).cast("string"),
                    F.lit(COUNT_LABEL), F.col(metric).cast("string"), F.lit("\n"))
    lines = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), line.alias("l"))))
    return (ranked.groupBy(*group_extra, window_end)
            .agg(lines.alias("_lines"))
            # the field of an array of structs is an array (no lambda, code-generated)
            .withColumn("_body", F.array_join(F.col("_lines.l"), ""))
            .select(window_end,
                    F.concat(F.lit(REPORT_HEADER), timestamp_text(F.col(window_end)), F.lit("\n"),
                             F.col("_body"), F.lit(footer)).alias("report")))
