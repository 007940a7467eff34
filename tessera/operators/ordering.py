"""Skew-safe positional operators.

A plain ``row_number().over(Window.partitionBy(g).orderBy(o))`` sends every row
of a group to one task; with a hot group (a third of all rows) that task sorts
a third of the data.  The helpers here split each group into ordered
sub-buckets (a monotone function of the order key), count the buckets, turn
the counts into offsets with a window over the *aggregated* bucket table and
join the offsets back.  Every step is a normal shuffle with bounded per-task
work; nothing goes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def ordinal(df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column,
            name: str = "ordinal", prev: Sequence[str] = (), prev_prefix: str = "prev_") -> DataFrame:
    """0-based position of each row inside its ``by`` group, ordered by ``order``.

    ``bucket`` must be non-decreasing in ``order`` (e.g. the date of a timestamp,
    ``floor(u*B)`` of a uniform draw, ``key div 4096``).  Optionally also returns
    the ``prev`` columns of the previous row in the group (``prev_<col>``), which
    is ``lag`` without a per-group sort of the whole group.
    """
    by = list(by)
    order = list(order)
    prev = list(prev)
    b = "__bucket"
    x = df.withColumn(b, bucket)
    last_struct = F.struct(*[F.col(c) for c in order],
                           F.struct(*[F.col(c) for c in prev] or [F.lit(None)]).alias("__p"))
    agg = (x.groupBy(*by, b)
           .agg(F.count(F.lit(1)).alias("__n"), F.max(last_struct).alias("__last")))
    wb = Window.partitionBy(*by).orderBy(b)
    agg = agg.select(
        *by, b,
        F.coalesce(F.sum("__n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        F.lag("__last").over(wb).alias("__prev_last"),
    )
    x = x.join(agg, on=by + [b], how="inner")
    w = Window.partitionBy(*by, b).orderBy(*order)
    x = x.withColumn("__rn", F.row_number().over(w))
    x = x.withColumn(name, (F.col("__off") + F.col("__rn") - 1).cast("bigint"))
    for c in prev:
        x = x.withColumn(prev_prefix + c,
                         F.when(F.col("__rn") == 1, F.col("__prev_last")["__p"][c])
                         .otherwise(F.lag(c).over(w)))
    return x.drop(b, "__off", "__prev_last", "__rn")


def prefix_sums(df: DataFrame, order: Sequence, values: Sequence[str], bucket: Column,
                by: Sequence[str] = (), suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``values`` in ``order`` within ``by``.

    Two-level: sums per (group, bucket) are turned into offsets with a window
    over the small bucket table, joined back, and each bucket is then scanned by
    its own window task.  ``bucket`` must be non-decreasing along ``order``
    (pass a decreasing bucket for a descending order)."""
    by = list(by)
    b = "__pbucket"
    x = df.withColumn(b, bucket)
    agg = x.groupBy(*by, b).agg(*[F.sum(v).alias(f"__s_{v}") for v in values])
    wb = Window.partitionBy(*by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    agg = agg.select(*by, b, *[F.coalesce(F.sum(f"__s_{v}").over(wb), F.lit(0)).alias(f"__o_{v}") for v in values])
    x = x.join(agg, on=by + [b], how="inner")
    w = Window.partitionBy(*by, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"{v}{suffix}": F.col(f"__o_{v}") + F.sum(v).over(w) for v in values})
    return x.drop(b, *[f"__o_{v}" for v in values])
