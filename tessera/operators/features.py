"""Feature preparation: buckets, indicators, outlier caps, scalers, splits.

Fitted statistics (quantiles, means, scales, class counts) are computed in one
aggregate per group and joined back; without a group key the statistics table
has one row, so it is broadcast (proven size bound).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_uniform


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _attach(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    by = list(by)
    if by:
        return df.join(stats, on=by, how="inner")
    return df.crossJoin(F.broadcast(stats))  # single statistics row


# -------------------------------------------------------------- scalar feats
def cut(c, bins: Sequence[float], labels: Sequence[str]) -> Column:
    """P10: right-closed bucketize (pandas ``cut``): (b0,b1], (b1,b2], ...;
    outside the range or NULL gives NULL."""
    x = _c(c)
    expr = None
    for lo, hi, lab in zip(bins[:-1], bins[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


# Fixed values of the reference: bounds and names of the buckets of days since the last contact.
PDAYS_BINS = [-1, 0, 3, 10, 999, 1e9]
PDAYS_LABELS = ["0", "1-3", "4-10", "11-999", "999+"]


def indicator(cond: Column) -> Column:
    """Boolean condition as 0/1."""
    return cond.cast("int")


def ratio(a, b) -> Column:
    """A / (1 + b), NULL when 1 + b = 0."""
    return F.try_divide(_c(a).cast("double"), (F.lit(1) + _c(b)).cast("double"))


def binary_target(c, positive) -> Column:
    """P9."""
    return (_c(c) == F.lit(positive)).cast("int")


def engineer(df: DataFrame) -> DataFrame:
    """Campaign feature engineering: pdays bucket, contact flag, intensity."""
    return df.withColumns({
        "pdays_bucket": cut("pdays", PDAYS_BINS, PDAYS_LABELS),
        "contact_last": indicator(F.col("previous") > 0),
        "campaign_intensity": ratio("campaign", "previous"),
    })


def drop_leakage(df: DataFrame, cols: Sequence[str] = ("duration",)) -> DataFrame:
    """P2."""
    return df.drop(*cols)


# ------------------------------------------------------------ outlier capping
def cap_outliers(df: DataFrame, col: str, method: str = "iqr", by: Sequence[str] = (),
                 fit_on: Column | None = None) -> DataFrame:
    """M1/M2: mark outliers (IQR fences, or |z| > 3 with sample std); outliers
    above the median become the 99th percentile, below it the 1st.

    All statistics come from one grouped aggregate (``percentile`` with an
    array of probabilities).  ``fit_on`` restricts the rows used for fitting.
    """
    by = list(by)
    src = df.filter(fit_on) if fit_on is not None else df
    q = F.percentile(col, F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75, 0.01, 0.99)]))
    stats = src.groupBy(*by).agg(q.alias("__q"), F.avg(col).alias("__mu"), F.stddev_samp(col).alias("__sd"))
    x = _attach(df, stats, by)
    v = F.col(col)
    q1, med, q3, p01, p99 = (F.col("__q")[i] for i in range(5))
    if method == "iqr":
        iqr = q3 - q1
        out = (v < q1 - F.lit(1.5) * iqr) | (v > q3 + F.lit(1.5) * iqr)
    elif method == "zscore":
        out = F.abs((v - F.col("__mu")) / F.col("__sd")) > F.lit(3.0)
    else:
        raise ValueError(method)
    out = F.coalesce(out, F.lit(False))
    capped = F.when(out & (v > med), p99).when(out & (v < med), p01).otherwise(v)
    return x.withColumn(col, capped.cast("double")).drop("__q", "__mu", "__sd")


# ------------------------------------------------------------------ scalers
def scale_std_fit(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """M4 fit: population std per column; a zero std becomes 1 (left unscaled)."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c)
        aggs.append(F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"{c}__scale"))
    return df.groupBy(*by).agg(*aggs)


def scale_std_apply(df: DataFrame, stats: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """M4 apply: divide by the scale, never centre (keeps sparsity)."""
    x = _attach(df, stats, by)
    return x.withColumns({c: F.col(c) / F.col(f"{c}__scale") for c in cols}).drop(*[f"{c}__scale" for c in cols])


def scale_minmax_fit(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """M5 fit: min and max per column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return df.groupBy(*by).agg(*aggs)


def scale_minmax_apply(df: DataFrame, stats: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                       inverse: bool = False) -> DataFrame:
    """M5 apply (or inverse); a constant column maps to 0."""
    x = _attach(df, stats, by)
    out = {}
    for c in cols:
        lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
        rng = hi - lo
        if inverse:
            out[c] = F.col(c) * rng + lo
        else:
            out[c] = F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c) - lo) / rng)
    drop = [f"{c}__{s}" for c in cols for s in ("min", "max")]
    return x.withColumns(out).drop(*drop)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M9: class weight n / (k * n_c).  The table of classes is broadcast: a join on the label would send
    every row of a class to one task."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = counts.crossJoin(F.broadcast(tot)).select(  # one-row side
        label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(out))
    return df.join(F.broadcast(w), on=label, how="inner")  # one row per class


# ------------------------------------------------------------------- splits
SPLIT_BUCKETS = 1024


def _rank_in_class(df: DataFrame, label: str, key: str, seed, buckets: int = SPLIT_BUCKETS) -> DataFrame:
    """Exact 0-based rank of each row inside its class in hash order, plus the
    class size.  Skew-safe: each class is cut into ``buckets`` uniform slices of
    the hash draw (so a huge class spreads over many tasks); slice counts become
    offsets through a window over the small (class, slice) table."""
    u = hash_uniform(seed, key)
    x = df.withColumn("__u", u).withColumn("__b", F.floor(F.col("__u") * buckets).cast("int"))
    cnt = x.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    wb = Window.partitionBy(label).orderBy("__b")
    cnt = cnt.select(label, "__b",
                     F.coalesce(F.sum("__cnt").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                     .alias("__off"),
                     F.sum("__cnt").over(Window.partitionBy(label)).alias("__nclass"))
    x = x.join(cnt, on=[label, "__b"], how="inner")
    w = Window.partitionBy(label, "__b").orderBy("__u", key)
    return x.withColumn("__rank", F.col("__off") + F.row_number().over(w) - 1).drop("__b", "__off")


def split_stratified(df: DataFrame, label: str, key: str, test_size: float = 0.2, val_size: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Exact per-class split into train / val / test.

    Per class of size n: the first ceil(n*test) rows in hash order are test,
    of the remaining m the next ceil(m*val) are val, the rest train."""
    x = _rank_in_class(df, label, key, seed)
    n = F.col("__nclass")
    n_test = F.ceil(n * F.lit(test_size))
    n_val = F.ceil((n - n_test) * F.lit(val_size))
    r = F.col("__rank")
    split = F.when(r < n_test, "test").when(r < n_test + n_val, "val").otherwise("train")
    return x.withColumn(out, split).drop("__u", "__rank", "__nclass")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Fold id = rank-in-class (hash order) mod k."""
    x = _rank_in_class(df, label, key, seed)
    return x.withColumn(out, F.pmod(F.col("__rank"), F.lit(k)).cast("int")).drop("__u", "__rank", "__nclass")
