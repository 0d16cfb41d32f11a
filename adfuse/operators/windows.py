"""Window-style operators: trailing averages, shares of total, stacks, ranks.

Scale notes
* ``rolling_mean`` and ``stack`` run on the (date x platform) series, whose
  size is days x platforms and independent of fact volume; never on the fact.
* ``share_of_total`` divides by a scalar subquery (one value computed once
  and shipped to every task), not an unpartitioned window that would pull
  all rows into a single task, and not a join.
* ``global_row_number`` numbers rows in a total order without a single-task
  window: range-partition + sort, number rows inside each partition, then add
  per-partition offsets (one small row per partition).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adfuse.functions.ratios import safe_div


def rolling_mean(
    series: DataFrame,
    value: str,
    n: int = 7,
    frame: str = "rows",
    partition_by: Sequence[str] = ("platform",),
    order_by: str = "date",
    out: str | None = None,
) -> DataFrame:
    """Trailing mean of ``value`` over the last ``n`` rows or ``n`` calendar days.

    frame="rows"  the current row and the n-1 preceding rows of its partition
                  (partial frames at the start: mean of what is available)
    frame="days"  every row dated within the n-1 days before, inclusive; differs
                  from "rows" wherever dates have gaps
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    out = out or f"{value}_{n}d_avg"
    w = Window.partitionBy(*partition_by)
    if frame == "rows":
        w = w.orderBy(order_by).rowsBetween(-(n - 1), Window.currentRow)
    elif frame == "days":
        w = w.orderBy(F.unix_date(F.col(order_by))).rangeBetween(-(n - 1), Window.currentRow)
    else:
        raise ValueError(f"frame must be 'rows' or 'days', not {frame!r}")
    return series.withColumn(out, F.avg(value).over(w))


def refresh_rolling_mean(
    previous: DataFrame,
    series: DataFrame,
    changed: DataFrame,
    value: str,
    n: int = 7,
    frame: str = "rows",
    partition_by: Sequence[str] = ("platform",),
    order_by: str = "date",
    out: str | None = None,
) -> DataFrame:
    """``rolling_mean(series, ...)`` from an earlier result and the days that changed since.

    ``previous`` is the earlier result, ``series`` the rows as they are now and
    ``changed`` the (partition, day) keys that are new, differ or are gone; its
    columns are ``partition_by`` and ``order_by``, none of them NULL.  A changed
    day touches itself and the n-1 rows (or days) after it, nothing else: only
    these rows are computed, from a window over them and the n-1 before, and
    all others are taken over.  The result equals the batch window bit for bit,
    whatever the order in which late days arrive.
    """
    out, keys = out or f"{value}_{n}d_avg", [*partition_by, order_by]
    day = F.col(order_by)
    late = changed.select(*keys).distinct()
    bounds = late.groupBy(*partition_by).agg(F.min(order_by).alias("_low"), F.max(order_by).alias("_high"))
    near = series.join(bounds, list(partition_by))
    if frame == "rows":
        up, down = (Window.partitionBy(*partition_by).orderBy(o) for o in (day.asc(), day.desc()))
        part = lambda rows, w: rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") < n).drop("_k")
        before, after = part(near.where(day < F.col("_low")), down), part(near.where(day > F.col("_high")), up)
        near = near.where(day.between(F.col("_low"), F.col("_high"))).unionByName(before).unionByName(after)
    else:
        near = near.where(day.between(F.date_sub("_low", n - 1), F.date_add("_high", n - 1)))
    near = rolling_mean(near.drop("_low", "_high"), value, n, frame, partition_by, order_by, out)
    # The rows in order, changed days among them; a day that is gone is no row, but touches those after it.
    marks = near.select(*keys, F.lit(1).alias("_row"), F.lit(0).alias("_late")).unionByName(
        late.select(*keys, F.lit(0).alias("_row"), F.lit(1).alias("_late"))
    )
    marks = marks.groupBy(*keys).agg(F.max("_row").alias("_row"), F.max("_late").alias("_late"))
    run = Window.partitionBy(*partition_by).orderBy(order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.sum("_row").over(run) if frame == "rows" else F.unix_date(day)
    last = F.max(F.when(F.col("_late") == 1, F.col("_place"))).over(run)
    marks = marks.withColumn("_place", place).withColumn("_since", F.col("_place") - last)
    touched = marks.where((F.col("_since") < n) & (F.col("_row") == 1)).select(*keys)
    new = near.join(touched, keys, "left_semi").select(*previous.columns)
    return previous.join(touched.unionByName(late).distinct(), keys, "left_anti").unionByName(new)


def share_of_total(
    df: DataFrame, value: str, out: str | None = None, total_out: str | None = None
) -> DataFrame:
    """``value / sum(value)`` for each row (NULL if the total is 0).

    The total is an uncorrelated scalar subquery, referenced once: evaluated
    once, its single value is shipped to the tasks.  When ``df`` is itself an
    aggregate, adaptive execution reuses its shuffle stage for the subquery,
    so the input is read once (see PLANS.md, executed stages).
    """
    out = out or f"{value}_share"
    total_col = total_out or f"_{value}_total"
    total = df.agg(F.sum(value).alias("t")).scalar()
    with_total = df.select("*", total.alias(total_col))
    cols = [F.col(c) for c in df.columns]
    if total_out:
        cols.append(F.col(total_col))
    cols.append(safe_div(F.col(value), F.col(total_col)).alias(out))
    return with_total.select(*cols)


def stack(
    df: DataFrame,
    value: str,
    within: Sequence[str] = ("date",),
    order_by: Sequence[str] = ("platform",),
    out: str | None = None,
) -> DataFrame:
    """Cumulative ``value`` across ``order_by`` inside each ``within`` group
    (the stacked-area layout: the last layer equals the group total)."""
    out = out or f"{value}_stacked"
    w = (
        Window.partitionBy(*within)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(out, F.sum(value).over(w))


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """1-based position of each row in the total order ``order``.

    ``order`` must be a total order (append tie-break columns) for the
    numbering to be deterministic.  Steps:
      1. ``orderBy`` -> range exchange; partition i holds the i-th key range,
         sorted.  ``monotonically_increasing_id`` numbers rows consecutively
         inside each partition, so a row's position there is its id minus the
         partition's smallest id.
      2. ``checkpoint()`` fixes that layout on the shared checkpoint folder, so
         both consumers below see the same partitions even after executor loss.
      3. Row count per partition -> running offsets: one row per partition.  The
         join with them is left to the planner, which picks its strategy from
         the measured size.
    """
    from adfuse.sources.storage import checkpoint_root

    checkpoint_root(df.sparkSession)
    tagged = (
        df.orderBy(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_mid"))
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # The offset window sees one row per partition only.
    offsets = counts.select(
        "_part",
        "_first",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0).cast("bigint"),
        ).alias("_off"),
    )
    position = F.col("_off") + (F.col("_mid") - F.col("_first")) + F.lit(1)
    return (
        tagged.join(offsets, "_part")
        .select(*[F.col(c) for c in df.columns], position.alias(out))
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """First ``n`` rows of a total order, numbered 1..n.

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: each task keeps its
    own top n, so at most n x tasks rows meet in the final step; the numbering
    window then sees at most n rows, in one task: for a very large ``n`` rank
    everything with ``global_row_number`` and filter instead.
    """
    head = df.orderBy(*order).limit(n)
    return head.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
