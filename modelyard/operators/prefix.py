"""Running totals over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelyard.session import settled


def exclusive_running_total(
    rows: DataFrame, order: str, value: str, out: str, group: str | None = None
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over all rows that come before, in (group, order).

    ``order`` must be unique; it may be sparse, negative or of any sortable type. Rows are
    range-partitioned by (group, order) and written with the number of their range, so the
    ranges follow the data: neither a hot group nor sparse ids make one of them long, and
    what feeds them runs once. A window covers one range; the window over all ranges has
    one row for each.
    """
    keys = [group, order] if group else [order]
    rows = settled(rows.repartitionByRange(*keys).withColumn("_block", F.spark_partition_id()))
    before = (W.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    totals = rows.groupBy("_block").agg(F.sum(value).alias("_n"))
    above = W.orderBy("_block").rowsBetween(*before)  # as many rows as ranges
    offsets = totals.select("_block", F.coalesce(F.sum("_n").over(above), none).alias("_offset"))
    inner = W.partitionBy("_block").orderBy(*keys).rowsBetween(*before)
    return (
        rows.join(offsets, "_block")
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum(value).over(inner), none))
        .drop("_block", "_offset")
    )
