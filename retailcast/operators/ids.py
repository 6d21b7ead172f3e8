"""Dense ids and ranks over ranges of the sort key.

``row_number().over(Window.orderBy(...))`` moves every row into one task, and a rank inside a
group moves the whole group.  Here the rows are range-partitioned by the full sort key, ties
included, so Spark samples the split points from the data and every task gets an even range,
however many rows share a group or a value.  Inside a range the place of a row is its position; the
offset of a range is the sum of the counts of the ranges before it.

The placed rows are cut off by a reliable checkpoint: the split points come from a sample, so
the counts and the rows must be of the same placing.  What reaches the driver is one count for each range.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: ``monotonically_increasing_id`` is the partition's number times 2^33 plus the row's position in it.
_POSITION_BITS = 33


def _free(df: DataFrame, base: str) -> str:
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def place_in_ranges(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> tuple[DataFrame, str, str]:
    """Rows sorted by ``order`` over ranges; the names of the columns with the range's number and the position in it."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, pos = _free(df, "_range"), _free(df, "_position")
    at = F.monotonically_increasing_id()
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(pos, at)
              .withColumn(part, F.shiftright(F.col(pos), _POSITION_BITS).cast("int"))
              .withColumn(pos, F.col(pos).bitwiseAND((1 << _POSITION_BITS) - 1)))
    return cut_lineage(placed), part, pos


def dense_ids(df: DataFrame, order_cols: Sequence[str], start: Column | int = 0, name: str = "id",
              ranges: int | None = None) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the order of ``order_cols`` (NULL first).

    Rows that are equal in all ``order_cols`` get consecutive ids in any order.
    """
    placed, part, pos = place_in_ranges(df, [F.col(c).asc() for c in order_cols], ranges)
    counts = {r[0]: r[1] for r in placed.groupBy(part).count().collect()}  # one row for each range
    sizes = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
    before = F.lit([0, *accumulate(sizes)][:len(sizes)] or [0]).cast("array<bigint>")
    base = start if isinstance(start, Column) else F.lit(start)
    return (placed.withColumn(name, (base + F.get(before, F.col(part)) + F.col(pos) + 1).cast("int"))
            .drop(part, pos))


def rank_within(df: DataFrame, group_col: str, value_col: str, tie_col: str,
                ranges: int | None = None, name: str = "rank") -> DataFrame:
    """1-based position inside each group, by ``value_col`` descending (NULL last) then ``tie_col``
    ascending, without a whole group or all ties of a value in one task.

    The ranges are over (group, value, tie).  A group that goes on over several ranges has one
    row of counts for each of them; their running sum, at most ``ranges`` rows of a
    group, gives the offset, and rows meet it by (range, group), of which none is larger than a range.
    """
    order = [F.col(group_col).asc_nulls_first(), F.col(value_col).desc_nulls_last(), F.col(tie_col).asc()]
    placed, part, pos = place_in_ranges(df, order, ranges)
    spans = placed.groupBy(F.col(part).alias("_r"), F.col(group_col).alias("_g")).agg(F.min(pos).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_r", "_g", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return (placed.join(spans, (F.col(part) == F.col("_r")) & F.col(group_col).eqNullSafe(F.col("_g")))
            .withColumn(name, (F.col(pos) + F.col("_shift")).cast("int"))
            .drop(part, pos, "_r", "_g", "_shift"))
