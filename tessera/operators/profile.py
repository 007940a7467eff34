"""Profiling: counts, distinct values, summaries, correlations, histograms,
densities, box statistics, cross tabs, rates, top-k and samples.

Every statistic is a single (grouped) aggregate pass; per-column results are
produced in one ``agg`` and unpivoted, never one job per column.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import hash_uniform
from tessera.operators.ordering import prefix_sums


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_cols(df: DataFrame) -> list[str]:
    """P15."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_cols(df: DataFrame) -> list[str]:
    """P15."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def schema_profile(df: DataFrame) -> DataFrame:
    """A4: one row per column (position, name, type) with the row count."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    spark = df.sparkSession
    meta = spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
                                 "position INT, column_name STRING, data_type STRING")
    return meta.crossJoin(F.broadcast(n))  # one row


def _unpivot(wide: DataFrame, cols: Sequence[str], value: str, ids: Sequence[str] = ()) -> DataFrame:
    return wide.unpivot(list(ids), list(cols), "column_name", value)


def value_counts(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """A3: count and share of each value (share within the ``by`` group)."""
    by = list(by)
    c = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    # group totals as a separate aggregate (no window over all distinct values)
    tot = c.groupBy(*by).agg(F.sum("n").alias("__tot"))
    x = c.join(tot, by) if by else c.crossJoin(F.broadcast(tot))  # one total row
    return x.withColumn("share", F.col("n") / F.col("__tot")).drop("__tot")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: NULL (or NaN) count per column, one pass."""
    cols = list(cols or df.columns)
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for c in cols:
        isnull = F.col(c).isNull()
        if isinstance(fields[c], (T.FloatType, T.DoubleType)):
            isnull = isnull | F.isnan(c)
        aggs.append(F.sum(isnull.cast("long")).alias(c))
    wide = df.agg(*aggs)
    return _unpivot(wide, cols, "n_null")


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column (exact or HyperLogLog++)."""
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    wide = df.agg(*[fn(c).cast("bigint").alias(c) for c in cols])
    return _unpivot(wide, cols, "n_distinct")


def sentinel_counts(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Rows equal to a sentinel per column; only columns with hits."""
    cols = list(sentinels)
    wide = df.agg(*[F.sum((F.col(c) == F.lit(v)).cast("long")).alias(c) for c, v in sentinels.items()])
    x = _unpivot(wide, cols, "n_sentinel").filter(F.col("n_sentinel") > 0)
    m = F.create_map(*[z for c, v in sentinels.items() for z in (F.lit(c), F.lit(str(v)))])
    return x.withColumn("sentinel", m[F.col("column_name")])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Interpolated quantiles ``q0, q1, ...`` of every column as rows (by.., column_name).

    Values are counted first; running counts come from two-level prefix sums over value ranges whose
    number follows the distinct values, and each order statistic is picked by a map-side combined
    aggregate.  No task holds the values of a whole column."""
    keys = [*by, "column_name"]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("__v")) for c in cols])
    long = df.select(*by, F.explode(pairs).alias("__e")).select(*by, "__e.*").filter(F.col("__v").isNotNull())
    counts = long.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    st = counts.groupBy(*keys).agg(F.min("__v").alias("__mn"), F.max("__v").alias("__mx"), F.sum("__n").alias("__total"),
                                   F.count(F.lit(1)).alias("__kinds"))
    x = _join_groups(counts, st, keys)
    span = F.col("__mx") - F.col("__mn")
    ranges = F.greatest(F.lit(1.0), F.col("__kinds") / 4096)
    bucket = F.when(span > 0, F.floor((F.col("__v") - F.col("__mn")) / span * ranges)).otherwise(F.lit(0)).cast("long")
    # a struct of the keys is never null itself, so null groups survive the joins on it
    x = prefix_sums(x.withColumn("__key", F.struct(*keys)), ["__v"], ["__n"], F.coalesce(bucket, F.lit(0)), by=["__key"])

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("__n_cum") - F.col("__n") <= rank) & (rank < F.col("__n_cum")), F.col("__v")))
    place = [(F.col("__total") - 1) * F.lit(float(p)) for p in probs]
    picked = x.groupBy(*keys).agg(F.first("__total").alias("__total"), *[
        f(r).alias(f"__{k}{i}") for i, r in enumerate(place) for k, f in (("lo", lambda r: value_at(F.floor(r))), ("hi", lambda r: value_at(F.ceil(r))))])
    return picked.select(*keys, *[
        (F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * (r - F.floor(r))).alias(f"q{i}") for i, r in enumerate(place)])


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys where a null key is a group of its own."""
    named = right.select(*[F.col(k).alias(f"__k_{k}") if k in keys else F.col(k) for k in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return left.join(named, cond, how).drop(*[f"__k_{k}" for k in keys])


def _quantile_rows(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], approx: bool) -> DataFrame:
    if not approx:
        return exact_quantiles(df, cols, probs, by)
    arr = F.array(*[F.lit(p) for p in probs])
    wide = df.groupBy(*by).agg(*[F.percentile_approx(F.col(c).cast("double"), arr, 10000).alias(f"__q_{c}") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__q_{c}").alias("q")) for c in cols])
    return wide.select(*by, F.explode(rows).alias("__e")).select(
        *by, "__e.column_name", *[F.col("__e.q")[i].alias(f"q{i}") for i in range(len(probs))])


def summary(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Count, missing, mean, sample std, min, Q1, median, Q3, max,
    range, CV % and biased skewness per column: one aggregate, joined with the
    quantiles (``approx=True``: from ``percentile_approx``)."""
    by = list(by)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.count(x).alias("count"), F.sum(x.isNull().cast("long")).alias("missing"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"), F.skewness(x).alias("skewness")).alias(f"__s_{c}"))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__s_{c}").alias("s")) for c in cols])
    long = df.groupBy(*by).agg(*aggs).select(*by, F.explode(rows).alias("__e")).select(*by, "__e.column_name", "__e.s.*")
    q = _quantile_rows(df, cols, (0.25, 0.5, 0.75), by, approx)
    return _join_groups(long, q, [*by, "column_name"], "left").select(
        *by, "column_name", "count", "missing", "mean", "std", "min", F.col("q0").alias("q1"), F.col("q1").alias("median"),
        F.col("q2").alias("q3"), "max", (F.col("max") - F.col("min")).alias("range"),
        (F.col("std") / F.col("mean") * 100).alias("cv_pct"), "skewness")


def iqr_outliers(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Values strictly outside Q1 - 1.5 IQR / Q3 + 1.5 IQR, per column:
    the quantiles, then one conditional-count aggregate."""
    rows = _quantile_rows(df, cols, (0.25, 0.75), [], approx)
    q = rows.agg(*[F.max(F.when(F.col("column_name") == c, F.col(k))).alias(f"__{k}_{c}") for c in cols for k in ("q0", "q1")])
    x = df.crossJoin(F.broadcast(q))  # one row
    aggs = []
    for c in cols:
        q1, q3 = F.col(f"__q0_{c}"), F.col(f"__q1_{c}")
        v = F.col(c)
        aggs.append(F.sum(((v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))).cast("long")).alias(c))
    return _unpivot(x.agg(*aggs), cols, "n_outliers")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, one aggregate."""
    half = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]  # the matrix is symmetric
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in half])
    pairs = [(a, b, (a, b) if (a, b) in half else (b, a)) for a in cols for b in cols]
    wide = wide.select(*[F.col(f"`{x}|{y}`").alias(f"{a}|{b}") for a, b, (x, y) in pairs])
    long = wide.unpivot([], [f"`{a}|{b}`" for a, b, _ in pairs], "pair", "corr")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("col_a"),
                       F.split_part("pair", F.lit("|"), F.lit(2)).alias("col_b"), "corr")


def corr_with(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Correlation of each column with ``target``."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return _unpivot(wide, cols, "corr")


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between min and max, last bin closed, empty bins kept."""
    by = list(by)
    x = F.col(col).cast("double")
    st = df.groupBy(*by).agg(F.min(x).alias("__mn"), F.max(x).alias("__mx"))
    data = df.select(*by, x.alias("__x")).filter(F.col("__x").isNotNull())
    data = data.join(st, on=by, how="inner") if by else data.crossJoin(F.broadcast(st))
    width = F.col("__mx") - F.col("__mn")
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__mn")) / width * F.lit(bins)), F.lit(bins - 1))).cast("int")
    counts = data.groupBy(*by, idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = st.select(*by, "__mn", "__mx", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = spine.join(counts, on=by + ["bin"], how="left")
    w = F.col("__mx") - F.col("__mn")
    return out.select(*by, "bin",
                      (F.col("__mn") + w * F.col("bin") / F.lit(bins)).alias("lo"),
                      (F.col("__mn") + w * (F.col("bin") + 1) / F.lit(bins)).alias("hi"),
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Quartiles, whiskers (extreme values inside 1.5 IQR) and outlier count."""
    by = list(by)
    q = _quantile_rows(df, [col], (0.25, 0.5, 0.75), by, approx).drop("column_name")
    q = q.select(*by, *[F.col(c).alias(f"__{c}") for c in ("q0", "q1", "q2")])
    d = df.select(*by, F.col(col).cast("double").alias("__x"))
    d = _join_groups(d, q, by) if by else d.crossJoin(F.broadcast(q))  # one row
    q1, med, q3 = F.col("__q0"), F.col("__q1"), F.col("__q2")
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    v = F.col("__x")
    return d.groupBy(*by).agg(
        F.first(q1).alias("q1"), F.first(med).alias("median"), F.first(q3).alias("q3"),
        F.min(F.when(v >= lo, v)).alias("whisker_low"), F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.sum(((v < lo) | (v > hi)).cast("long")).alias("n_outliers"),
        F.count(v).alias("n"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long cross tab of counts."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def rate_by(df: DataFrame, key: str, target: str) -> DataFrame:
    """Mean of a 0/1 target per category, with the group size."""
    return df.groupBy(key).agg(F.avg(F.col(target).cast("double")).alias("rate"),
                               F.count(F.lit(1)).alias("n"))


def mean_by(df: DataFrame, key: str | Sequence[str], col: str) -> DataFrame:
    """Group mean."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(F.col(col).cast("double")).alias(f"mean_{col}"))


def reindex(agg: DataFrame, key: str, domain: Sequence[str]) -> DataFrame:
    """Order an aggregate by a literal domain (e.g. jan..dec); values of the
    domain missing in ``agg`` are kept with NULLs."""
    spark = agg.sparkSession
    dom = spark.createDataFrame([(i, v) for i, v in enumerate(domain)], f"position INT, {key} STRING")
    return dom.join(agg, on=key, how="left")


SQRT_2PI = math.sqrt(2 * math.pi)


def kde(df: DataFrame, col: str, grid: int = 1000, by: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth (std * n^-1/5) on a
    grid over [min - range/2, max + range/2].

    Data are first reduced to (value, multiplicity); each distinct value is
    expanded against the ``grid`` points and summed per grid point, so the
    shuffle carries one partial sum per grid point and task.  For continuous
    columns at scale pass ``bins`` (binned KDE, error below one bin width)."""
    by = list(by)
    x = F.col(col).cast("double")
    base = df.select(*by, x.alias("__x")).filter(F.col("__x").isNotNull())
    st = base.groupBy(*by).agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx"),
                               F.count(F.lit(1)).alias("__n"), F.stddev_samp("__x").alias("__sd"))
    st = st.withColumn("__h", F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2)))
    if bins:
        # pre-bin to bin centres: at most ``bins`` distinct values per group, so
        # the grid expansion is bounded by bins * grid whatever the row count
        mm = base.groupBy(*by).agg(F.min("__x").alias("__a"), F.max("__x").alias("__b"))
        base = base.join(mm, by) if by else base.crossJoin(F.broadcast(mm))
        wdt = (F.col("__b") - F.col("__a")) / bins
        k = F.least(F.floor((F.col("__x") - F.col("__a")) / wdt), F.lit(bins - 1))
        base = base.withColumn("__x", F.when(wdt > 0, F.col("__a") + (k + 0.5) * wdt).otherwise(F.col("__x"))) \
                   .drop("__a", "__b")
    vc = base.groupBy(*by, "__x").agg(F.count(F.lit(1)).alias("__c"))
    vc = vc.join(st, on=by, how="inner") if by else vc.crossJoin(F.broadcast(st))
    rng = F.col("__mx") - F.col("__mn")
    g = F.col("__g")
    gx = (F.col("__mn") - rng / 2) + (rng * 2) * g / F.lit(grid - 1)
    e = vc.withColumn("__g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    u = (gx - F.col("__x")) / F.col("__h")
    dens = e.groupBy(*by, "__g").agg(
        F.first(gx).alias("x"),
        (F.sum(F.col("__c") * F.exp(-0.5 * u * u)) / (F.first("__n") * F.first("__h") * F.lit(SQRT_2PI)))
        .alias("density"))
    return dens.withColumnRenamed("__g", "grid_index")


# ------------------------------------------------------------------ top/sample
def head(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """O2: first n rows in an explicit order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """O2: last n rows of an explicit order, returned in that order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def top_k(df: DataFrame, col: str, k: int, tie: str, by: Sequence[str] = ()) -> DataFrame:
    """O3: k largest values, ties broken by ``tie`` ascending; per group when
    ``by`` is given (window rank with a per-group limit)."""
    by = list(by)
    if not by:
        return df.orderBy(F.col(col).desc(), F.col(tie).asc()).limit(k) \
            .withColumn("rank", F.row_number().over(Window.orderBy(F.col(col).desc(), F.col(tie).asc())))
    w = Window.partitionBy(*by).orderBy(F.col(col).desc(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def arg_best(df: DataFrame, col: str, id_col: str, by: Sequence[str] = (), largest: bool = True) -> DataFrame:
    """Row with the best value (first id wins on ties), as a grouped
    ``max_by``/``min`` over a struct — a hash aggregate, no sort."""
    by = list(by)
    key = F.struct((F.col(col) if largest else -F.col(col)).alias("v"), (-F.col(id_col)).alias("i"))
    best = df.groupBy(*by).agg(F.max(F.struct(key.alias("k"), F.struct(*df.columns).alias("row"))).alias("__b"))
    return best.select(*[F.col(f"__b.row.{c}").alias(c) for c in df.columns])


def sample_n(df: DataFrame, n: int, seed: int, key: str, by: Sequence[str] = ()) -> DataFrame:
    """N rows with the smallest hash draw (per group with ``by``)."""
    u = hash_uniform(seed, key)
    by = list(by)
    x = df.withColumn("__u", u)
    if not by:
        return x.orderBy("__u", key).limit(n).drop("__u")
    w = Window.partitionBy(*by).orderBy("__u", key)
    return x.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__u", "__r")


# Rational approximation of the inverse normal CDF (Acklam),
# relative error below 1.2e-9.
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549671010422968e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
P_LOW = 0.02425


def _horner(coefs, x):
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def inv_norm(p) -> Column:
    """Inverse standard normal CDF as a native Column expression."""
    p = _c(p)
    ql = F.sqrt(-2 * F.log(p))
    lower = _horner(_C, ql) / (_horner(_D, ql) * ql + 1)
    q = p - 0.5
    r = q * q
    central = _horner(_A, r) * q / (_horner(_B, r) * r + 1)
    qu = F.sqrt(-2 * F.log(1 - p))
    upper = -(_horner(_C, qu) / (_horner(_D, qu) * qu + 1))
    return F.when(p < P_LOW, lower).when(p > 1 - P_LOW, upper).otherwise(central)


def qq_points(df: DataFrame, col: str, key: str, bucket: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Ordered sample values against normal quantiles at Filliben
    positions ((i - 0.3175) / (n + 0.365); ends 1 - 0.5^(1/n) and 0.5^(1/n)), per group of ``by``.
    The rank is skew-safe (``ordering.ordinal``) when ``bucket`` (a
    monotone function of the value) is given."""
    from tessera.operators.ordering import ordinal
    by = list(by)
    x = df.select(*by, F.col(key), F.col(col).cast("double").alias("sample")).filter(F.col("sample").isNotNull())
    if bucket is None:
        w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("sample", key)
        x = x.withColumn("i", F.row_number().over(w).cast("bigint"))
    else:
        x = ordinal(x, by=by, order=["sample", key], bucket=bucket, name="i").withColumn("i", F.col("i") + 1)
    n = x.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    x = x.join(n, by) if by else x.crossJoin(F.broadcast(n))  # one row
    last = F.pow(F.lit(0.5), F.lit(1.0) / F.col("__n"))
    m = (F.when(F.col("i") == F.col("__n"), last).when(F.col("i") == 1, 1 - last)
         .otherwise((F.col("i") - 0.3175) / (F.col("__n") + 0.365)))
    return x.select(*by, "i", key, "sample", m.alias("position"), inv_norm(m).alias("theoretical"))


def qq_line(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The least-squares line through the points of :func:`qq_points` and their correlation, in one aggregate."""
    return points.groupBy(*by).agg(F.regr_slope("sample", "theoretical").alias("slope"), F.regr_intercept("sample", "theoretical").alias("intercept"),
                                   F.corr("sample", "theoretical").alias("r"), F.count(F.lit(1)).alias("n"))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns that begin with ``prefix``."""
    return [c for c in df.columns if c.startswith(prefix)]


def short_label(c, n: int = 20) -> Column:
    """First ``n`` characters of a label."""
    return F.substring(_c(c), 1, n)
