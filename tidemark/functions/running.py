"""Running totals in one global order, without sending all rows through one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import stage_table

RANGES = 1024


def running_totals(
    grouped: DataFrame, order: str, measures: list[str], descending: bool = False, small: bool = False
) -> DataFrame:
    """Add `<measure>_total` (up to and including the row), `_next` (value in the next row) and `_all`.

    `grouped` has one row per value of the numeric column `order`; group before the call, so that a
    value shared by many rows is one row here. With `small=True` the caller vouches for a proven
    bound on the number of rows and one ordered window does the work lazily. Otherwise the rows are
    staged, cut into about equal ranges of `order`, totalled within ranges in parallel, and shifted
    by the totals of the ranges before; only the table of at most RANGES rows is ordered globally.
    """
    direction = F.col(order).desc() if descending else F.col(order).asc()
    if small:
        ordered = Window.orderBy(direction)
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return grouped.select(
            "*",
            *[F.sum(m).over(upto).alias(f"{m}_total") for m in measures],
            *[F.lead(m).over(ordered).alias(f"{m}_next") for m in measures],
            *[F.sum(m).over(Window.partitionBy()).alias(f"{m}_all") for m in measures],
        )

    staged = stage_table(grouped, "running")
    # Fixed cut points: both uses of the ranges below must agree, so they are read once.
    cuts = staged.approxQuantile(order, [i / RANGES for i in range(1, RANGES)], 0.25 / RANGES)
    splits = [float("-inf"), *sorted(set(cuts or [0.0])), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=order, outputCol="_range").transform(staged)

    range_order = Window.orderBy(F.col("_range").desc() if descending else F.col("_range").asc())
    before = range_order.rowsBetween(Window.unboundedPreceding, -1)
    head = F.max_by if descending else F.min_by
    ranges = (
        ranged.groupBy("_range")
        .agg(
            *[F.sum(m).alias(f"_sum_{m}") for m in measures],
            *[head(m, order).alias(f"_head_{m}") for m in measures],
        )
        .select(
            "_range",
            *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
            *[F.lead(f"_head_{m}").over(range_order).alias(f"_after_{m}") for m in measures],
            *[F.sum(f"_sum_{m}").over(Window.partitionBy()).alias(f"{m}_all") for m in measures],
        )
    )
    within = Window.partitionBy("_range").orderBy(direction)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(F.broadcast(ranges), "_range").select(
        *grouped.columns,
        *[(F.col(f"_before_{m}") + F.sum(m).over(upto)).alias(f"{m}_total") for m in measures],
        *[F.coalesce(F.lead(m).over(within), F.col(f"_after_{m}")).alias(f"{m}_next") for m in measures],
        *[f"{m}_all" for m in measures],
    )
