"""Forecasting for many daily series at once.

Seasonal regression (G1): linear trend + Fourier terms (yearly 365.25 order
10, weekly 7 order 3, monthly 30.5 order 5) + standardized regressors, fitted
by least squares per series.  The fit is expressed as Spark work: each task
forms partial Gram sums X'X, X'y, y'y per series for its rows (numpy over an
Arrow batch), partials are summed by a grouped aggregate (one p*p vector per
series), and only the tiny p x p solve runs per series.  The 95 % band is
yhat +/- 1.96 * residual std.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_uniform

EPOCH = "1970-01-01"
SEASONS = (("yearly", 365.25, 10), ("weekly", 7.0, 3), ("monthly", 30.5, 5))
Z95 = 1.959963984540054


def fourier_terms(ds: str, seasons=SEASONS) -> list[Column]:
    """sin/cos(2 pi k t / P) of days since the epoch (fixed origin, so future
    dates get the same terms)."""
    t = F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double")
    cols = []
    for _name, period, order in seasons:
        for k in range(1, order + 1):
            ang = F.lit(2.0 * math.pi * k / period) * t
            cols += [F.sin(ang), F.cos(ang)]
    return cols


def design(df: DataFrame, ds: str, regressors: Sequence[str], stats: DataFrame | None,
           by: Sequence[str], seasons=SEASONS) -> DataFrame:
    """Feature array x = [1, trend (years), Fourier..., standardized regressors]."""
    by = list(by)
    x = df
    if regressors:
        x = x.join(stats, by, "inner") if by else x.crossJoin(F.broadcast(stats))  # one stats row
    trend = F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double") / F.lit(365.25 * 30)
    regs = [(F.col(r) - F.col(f"__mu_{r}")) / F.col(f"__sd_{r}") for r in regressors]
    feats = [F.lit(1.0), trend] + fourier_terms(ds, seasons) + regs
    return x.withColumn("__x", F.array(*[f.cast("double") for f in feats]))


def regressor_stats(train: DataFrame, regressors: Sequence[str], by: Sequence[str]) -> DataFrame:
    aggs = []
    for r in regressors:
        sd = F.stddev_samp(r)
        aggs += [F.avg(r).alias(f"__mu_{r}"), F.when((sd.isNull()) | (sd == 0), 1.0).otherwise(sd).alias(f"__sd_{r}")]
    return train.groupBy(*by).agg(*aggs)


def _gram_partials(pdfs):
    """mapInPandas: per batch and series, partial X'X, X'y, y'y, n."""
    for pdf in pdfs:
        if pdf.empty:
            continue
        out = []
        for key, g in pdf.groupby("__series", sort=False):
            X = np.vstack(g["__x"].to_numpy())
            y = g["__y"].to_numpy(dtype=float)
            out.append((key, len(g), (X.T @ X).ravel().tolist(), (X.T @ y).tolist(), float(y @ y)))
        yield pd.DataFrame(out, columns=["__series", "n", "g", "b", "yy"])


def gram_sums(x: DataFrame, y: str, by: Sequence[str]) -> DataFrame:
    """Per-series X'X, X'y, y'y, n: partials per task, summed per series."""
    by = list(by)
    key = F.to_json(F.struct(*[F.col(c) for c in by])) if by else F.lit("{}")
    src = x.select(key.alias("__series"), "__x", F.col(y).cast("double").alias("__y")).filter(F.col("__y").isNotNull())
    part = src.mapInPandas(_gram_partials, "__series string, n long, g array<double>, b array<double>, yy double")
    g = part.select("__series", F.posexplode("g").alias("pos", "v")).groupBy("__series", "pos").agg(F.sum("v").alias("v"))
    b = part.select("__series", F.posexplode("b").alias("pos", "v")).groupBy("__series", "pos").agg(F.sum("v").alias("v"))
    n = part.groupBy("__series").agg(F.sum("n").alias("n"), F.sum("yy").alias("yy"))
    ga = g.groupBy("__series").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("g"))
    ba = b.groupBy("__series").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("b"))
    return n.join(ga, "__series").join(ba, "__series")


def _solve(ridge: float):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            p = len(r["b"])
            G = np.asarray(r["g"], dtype=float).reshape(p, p)
            b = np.asarray(r["b"], dtype=float)
            lam = ridge * max(np.trace(G) / p, 1e-12)
            pen = np.eye(p) * lam
            pen[0, 0] = 0.0
            try:
                beta = np.linalg.solve(G + pen, b)
            except np.linalg.LinAlgError:  # a series without variation: the smallest solution
                beta = np.linalg.lstsq(G + pen, b, rcond=None)[0]
            sse = max(float(r["yy"] - 2 * beta @ b + beta @ G @ beta), 0.0)
            dof = max(int(r["n"]) - p, 1)
            rows.append((r["__series"], beta.tolist(), math.sqrt(sse / dof), int(r["n"])))
        return pd.DataFrame(rows, columns=["__series", "beta", "sigma", "n"])
    return fn


def fit_seasonal(train: DataFrame, ds: str = "ds", y: str = "y", regressors: Sequence[str] = (),
                 by: Sequence[str] = (), ridge: float = 1e-6, seasons=SEASONS) -> DataFrame:
    """G1 fit: one coefficient row per series (series key columns, beta,
    sigma, n, regressor means/stds)."""
    by = list(by)
    regressors = list(regressors)
    stats = regressor_stats(train, regressors, by) if regressors else None
    x = design(train, ds, regressors, stats, by, seasons)
    gs = gram_sums(x, y, by)
    coef = gs.groupBy("__series").applyInPandas(_solve(ridge), "__series string, beta array<double>, sigma double, n long")
    if by:
        schema = train.select(*by).schema.simpleString().replace("struct<", "").rstrip(">")
        coef = coef.withColumn("__k", F.from_json("__series", f"struct<{schema}>")).select("*", "__k.*").drop("__k")
    coef = coef.drop("__series")
    if stats is not None:
        coef = coef.join(stats, by) if by else coef.crossJoin(stats)  # one-row side
    return coef


def forecast_seasonal(model: DataFrame, future: DataFrame, ds: str = "ds", regressors: Sequence[str] = (),
                      by: Sequence[str] = (), horizon: int | None = None, seasons=SEASONS) -> DataFrame:
    """Yhat, yhat_lower, yhat_upper on given future rows (their y ignored);
    optionally only the first ``horizon`` rows of each series."""
    by = list(by)
    regressors = list(regressors)
    stats_cols = [c for c in model.columns if c.startswith("__mu_") or c.startswith("__sd_")]
    fut = future
    if horizon is not None:
        w = Window.partitionBy(*by).orderBy(ds) if by else Window.orderBy(ds)
        fut = fut.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= horizon).drop("__r")
    m = model.select(*by, "beta", "sigma", *stats_cols)
    j = fut.join(m, by) if by else fut.crossJoin(F.broadcast(m))  # one coefficient row per series
    trend = F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double") / F.lit(365.25 * 30)
    regs = [(F.col(r) - F.col(f"__mu_{r}")) / F.col(f"__sd_{r}") for r in regressors]
    xs = F.array(*[f.cast("double") for f in [F.lit(1.0), trend] + fourier_terms(ds, seasons) + regs])
    yhat = F.aggregate(F.zip_with(xs, F.col("beta"), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    out = j.withColumn("yhat", yhat)
    return out.withColumn("yhat_lower", F.col("yhat") - Z95 * F.col("sigma")) \
              .withColumn("yhat_upper", F.col("yhat") + Z95 * F.col("sigma")) \
              .drop("beta", "sigma", *stats_cols)


# ------------------------------------------------------------ rolling origin
def cutoffs(df: DataFrame, ds: str = "ds", initial: int = 730, period: int = 180, horizon: int = 90,
            by: Sequence[str] = ()) -> DataFrame:
    """G3 cutoff table: from max - horizon back by ``period`` while the
    cutoff is at least min + initial."""
    by = list(by)
    mm = df.groupBy(*by).agg(F.min(ds).alias("__mn"), F.max(ds).alias("__mx"))
    last = F.date_sub("__mx", horizon)
    n = F.floor(F.datediff(last, F.date_add("__mn", initial)) / period)
    return mm.filter(n >= 0).select(*by, F.explode(F.sequence(F.lit(0), n.cast("int"))).alias("__k"), last.alias("__last")) \
        .select(*by, F.date_sub("__last", F.col("__k") * period).alias("cutoff"))


# ---------------------------------------------------------------- bootstrap
def forecast_bootstrap(df: DataFrame, horizon: int, ds: str = "ds", y: str = "y", context: int = 512,
                       paths: int = 100, period: int = 7, seed: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Sample-path forecast from the last ``context`` rows: seasonal naive
    level + residuals of the seasonal naive fit drawn by hash; median and
    5 / 95 % per step."""
    by = list(by)
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(F.col(ds).desc())
    ctx = df.withColumn("__back", F.row_number().over(w)).filter(F.col("__back") <= context)
    wa = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(ds)
    ctx = ctx.withColumn("__res", F.col(y) - F.lag(y, period).over(wa))
    res = ctx.filter(F.col("__res").isNotNull()).withColumn(
        "__ri", F.row_number().over((Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(ds)) - 1)
    nres = res.groupBy(*by).agg(F.count(F.lit(1)).alias("__nres"))
    last = ctx.filter(F.col("__back") <= period).select(*by, ds, y, "__back")
    mx = df.groupBy(*by).agg(F.max(ds).alias("__mx"))
    steps = mx.select(*by, "__mx", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    steps = steps.withColumn("__src_back", F.lit(period) - F.pmod(F.col("step") - 1, F.lit(period)))
    base = steps.join(last.withColumnRenamed("__back", "__src_back").select(*by, "__src_back", F.col(y).alias("__level")),
                      by + ["__src_back"])
    pth = base.withColumn("path", F.explode(F.sequence(F.lit(0), F.lit(paths - 1))))
    pth = pth.join(nres, by) if by else pth.crossJoin(F.broadcast(nres))
    pth = pth.withColumn("__ri", F.floor(hash_uniform(seed, *by, "path", "step") * F.col("__nres")).cast("long"))
    pth = pth.join(res.select(*by, "__ri", "__res"), by + ["__ri"])
    v = F.col("__level") + F.col("__res")
    return pth.groupBy(*by, "step").agg(
        F.first(F.date_add("__mx", F.col("step"))).alias(ds),
        F.percentile(v, 0.5).alias("yhat"), F.percentile(v, 0.05).alias("yhat_lower"),
        F.percentile(v, 0.95).alias("yhat_upper"))


# ----------------------------------------------------------- window regressor
def fit_window_regressor(train: DataFrame, ds: str = "ds", y: str = "y", length: int = 30, by: Sequence[str] = (),
                         features: Sequence[str] = ()):
    """Next value from the previous ``length`` min-max-scaled values of the
    target and of ``features`` (W5 + M5) with a Spark ML linear regression on the flattened window."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    from tessera.operators import features as fe
    from tessera.operators import timeseries as ts
    cols = [y, *[c for c in features if c != y]]
    stats = fe.scale_minmax_fit(train, cols, by)
    seq = ts.sequence_windows(fe.scale_minmax_apply(train, stats, cols, by), cols, length, y, ds, by)
    data = seq.select(array_to_vector(F.flatten("window")).alias("features"), F.col("label"))
    model = LinearRegression(featuresCol="features", labelCol="label", regParam=1e-4, elasticNetParam=0.0).fit(data)
    return model, stats


def predict_window_regressor(model, stats: DataFrame, test: DataFrame, ds: str = "ds", y: str = "y",
                             length: int = 30, by: Sequence[str] = (), band: float = 0.05, features: Sequence[str] = ()) -> DataFrame:
    """G6 predict on the test rows: windows come from the test rows themselves,
    so the first ``length`` rows get no prediction; band +/- 5 %."""
    from pyspark.ml.functions import array_to_vector

    from tessera.operators import features as fe
    from tessera.operators import timeseries as ts
    cols = [y, *[c for c in features if c != y]]
    seq = ts.sequence_windows(fe.scale_minmax_apply(test, stats, cols, by), cols, length, y, ds, by)
    pred = model.transform(seq.withColumn("features", array_to_vector(F.flatten("window"))))
    pred = pred.select(*by, ds, F.col("prediction").alias(y))
    own = stats.select(*by, f"{y}__min", f"{y}__max")
    inv = fe.scale_minmax_apply(pred, own, [y], by, inverse=True).withColumnRenamed(y, "yhat")
    return inv.withColumn("yhat_lower", F.col("yhat") * (1 - band)).withColumn("yhat_upper", F.col("yhat") * (1 + band))


# ------------------------------------------------------------ generic linear fit
def fit_linear(df: DataFrame, x: Column, y: str, by: Sequence[str] = (), ridge: float = 1e-6) -> DataFrame:
    """Least squares per series for a feature array ``x`` (Gram sums, one tiny
    solve per series); rows with a NULL feature are skipped."""
    by = list(by)
    d = df.withColumn("__x", x).filter(~F.exists("__x", lambda v: v.isNull()))
    gs = gram_sums(d, y, by)
    coef = gs.groupBy("__series").applyInPandas(_solve(ridge), "__series string, beta array<double>, sigma double, n long")
    if by:
        schema = df.select(*by).schema.simpleString().replace("struct<", "").rstrip(">")
        coef = coef.withColumn("__k", F.from_json("__series", f"struct<{schema}>")).select("*", "__k.*").drop("__k")
    return coef.drop("__series")


def _dot(xs: Column, beta: Column) -> Column:
    return F.aggregate(F.zip_with(xs, beta, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def regressor_importance(model: DataFrame, regressors: Sequence[str], seasons=SEASONS) -> DataFrame:
    """Fitted coefficients of the (standardized) regressors and the trend,
    sorted by absolute value."""
    names = ["intercept", "trend"] + [f"{n}_{f}{k}" for n, _p, o in seasons for k in range(1, o + 1)
                                      for f in ("sin", "cos")] + list(regressors)
    nm = F.array(*[F.lit(n) for n in names])
    x = model.select(F.posexplode("beta").alias("pos", "coefficient")).select(
        F.element_at(nm, F.col("pos") + 1).alias("feature"), "coefficient")
    x = x.filter(~F.col("feature").rlike("^(intercept|yearly_|weekly_|monthly_)"))
    return x.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.col("abs_coefficient").desc(), "feature")
