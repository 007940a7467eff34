"""Seasonal autoregression with moving-average terms and regressors, from Gram sums.

The model is (2,1,2)(1,1,1,7): the noise n = y - x'b, differenced by (1 - B)(1 - B^7), follows
(1 - p1 B - p2 B^2)(1 - P B^7) w = (1 + q1 B + q2 B^2)(1 + Q B^7) e.  Multiplied out, w has the lags 1, 2, 7, 8
and 9, the last two with the products of the coefficients, and so have the errors.

Fitting is the two-stage regression of Hannan and Rissanen (1982) with the products kept: a long
autoregression estimates the errors; their lags, those of the differenced target and of the differenced regressors
are the columns of one Gram matrix per series; Gauss-Newton steps over (b, p1, p2, P, q1, q2, Q) then need
that matrix only.  A series whose seasonal form is singular (its weekly differences vanish, say) takes the
non-seasonal (2,1,2) and its row says so.  Forecasts run the multiplied-out recursion; the band is that of the
summed impulse weights.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.forecast import Z95, fit_linear, gram_sums

PERIOD = 7
LONG_AR = 42
LAGS = {"seasonal": (1, 2, PERIOD, PERIOD + 1, PERIOD + 2), "non-seasonal": (1, 2)}
STEPS = 60
MEMORY = 2 * PERIOD + 3  # lags of the multiplied-out recursion


def _window(by: Sequence[str], ds: str):
    return (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(ds)


def _differenced(c: str, form: str, w) -> Column:
    x = F.col(c).cast("double")
    plain = x - F.lag(x, 1).over(w)
    return plain if form == "non-seasonal" else plain - F.lag(x, PERIOD).over(w) + F.lag(x, PERIOD + 1).over(w)


def expanded(par: np.ndarray, form: str, nx: int) -> tuple[np.ndarray, np.ndarray]:
    """The linear coefficients of the columns (lags of w, lags of e, then the regressors at lag 0 and at each lag)
    and their derivatives by the parameters."""
    lags = LAGS[form]
    k, n = len(lags), len(par)
    beta = par[:nx]
    ar, ma = np.zeros(k), np.zeros(k)
    d_ar, d_ma = np.zeros((k, n)), np.zeros((k, n))
    if form == "seasonal":
        p1, p2, ps, q1, q2, qs = par[nx:]
        ar[:] = p1, p2, ps, -p1 * ps, -p2 * ps
        ma[:] = q1, q2, qs, q1 * qs, q2 * qs
        i = nx
        d_ar[0, i], d_ar[1, i + 1], d_ar[2, i + 2] = 1, 1, 1
        d_ar[3, i], d_ar[3, i + 2], d_ar[4, i + 1], d_ar[4, i + 2] = -ps, -p1, -ps, -p2
        d_ma[0, i + 3], d_ma[1, i + 4], d_ma[2, i + 5] = 1, 1, 1
        d_ma[3, i + 3], d_ma[3, i + 5], d_ma[4, i + 4], d_ma[4, i + 5] = qs, q1, qs, q2
    else:
        ar[:], ma[:] = par[nx:nx + 2], par[nx + 2:]
        d_ar[[0, 1], [nx, nx + 1]], d_ma[[0, 1], [nx + 2, nx + 3]] = 1, 1
    coef = [ar, ma, beta, *[-a * beta for a in ar]]
    d_beta = np.eye(n)[:nx]
    slopes = [d_ar, d_ma, d_beta, *[-a * d_beta - np.outer(beta, d) for a, d in zip(ar, d_ar)]]
    return np.concatenate(coef), np.vstack(slopes)


def gauss_newton(g: np.ndarray, b: np.ndarray, yy: float, n: int, form: str, nx: int) -> tuple[np.ndarray, float] | None:
    """(parameters, standard deviation of the errors), or None if the form is singular for these sums."""
    params = nx + (6 if form == "seasonal" else 4)
    if n <= 2 * params or yy <= 1e-9 * n:
        return None
    scale = np.sqrt(np.maximum(np.diag(g), 0))
    if (scale[:2 * len(LAGS[form])] <= 1e-9 * np.sqrt(yy)).any():
        return None

    def sse(par):
        c = expanded(par, form, nx)[0]
        return float(yy - 2 * c @ b + c @ g @ c)
    par = np.zeros(params)
    now = sse(par)
    for _ in range(STEPS):
        c, slope = expanded(par, form, nx)
        bend = slope.T @ g @ slope
        size = np.sqrt(np.maximum(np.diag(bend), 1e-300))
        scaled = bend / np.outer(size, size)
        if not np.isfinite(scaled).all() or np.linalg.matrix_rank(scaled, tol=1e-10) < params:
            return None
        move, step = np.linalg.solve(scaled, slope.T @ (b - g @ c) / size) / size, 1.0
        while sse(par + step * move) > now and step > 1e-6:
            step /= 2
        new = sse(par + step * move)
        if not np.isfinite(new) or new >= now * (1 - 1e-12):
            break
        par, now = par + step * move, new
    return par, float(np.sqrt(max(now, 0.0) / max(n - params, 1)))


def recursion(par: np.ndarray, form: str, nx: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the noise's own lags 1.. and of the errors' lags 1.. with the differences multiplied out."""
    c = expanded(par, form, nx)[0]
    lags = LAGS[form]
    k = len(lags)
    ar, ma = np.zeros(lags[-1] + 1), np.zeros(lags[-1] + 1)
    ar[0] = ma[0] = 1
    ar[list(lags)], ma[list(lags)] = -c[:k], c[k:2 * k]
    ar = np.convolve(ar, [1, -1])
    if form == "seasonal":
        season = np.zeros(PERIOD + 1)
        season[0], season[-1] = 1, -1
        ar = np.convolve(ar, season)
    return -ar[1:], ma[1:]


MODEL = "__series string, form string, beta array<double>, own array<double>, errors array<double>, params array<double>, sigma double, n long"


def _columns(x: DataFrame, form: str, exog: Sequence[str], by: Sequence[str], ds: str, y: str) -> DataFrame:
    """The rows with the differenced target, the estimated errors and the columns of the second regression."""
    w = _window(by, ds)
    x = x.withColumn("__z", _differenced(y, form, w)).withColumns({f"__d_{c}": _differenced(c, form, w) for c in exog})

    def attach(x: DataFrame, coef: DataFrame, name: str) -> DataFrame:
        coef = coef.select(*by, F.col("beta").alias(name))
        return x.join(coef, list(by), "left") if by else x.join(F.broadcast(coef), F.lit(True), "left")  # one row

    def dot(u: Column, v: str) -> Column:
        return F.aggregate(F.zip_with(u, F.col(v), lambda p, q: p * q), F.lit(0.0), lambda s, r: s + r)
    # the regressors' share first, then a long autoregression of what it leaves: its residuals are the errors
    x = x.withColumn("__n", F.col("__z"))
    if exog:
        moves = F.array(*[F.col(f"__d_{c}") for c in exog])
        x = attach(x, fit_linear(x, moves, "__z", by), "__b")
        x = x.withColumn("__n", F.col("__z") - dot(moves, "__b")).drop("__b")
    x = x.withColumn("__first", F.array(*[F.lag("__n", k).over(w) for k in range(1, LONG_AR + 1)]))
    x = attach(x, fit_linear(x, F.col("__first"), "__n", by), "__b")
    x = x.withColumn("__e", F.col("__n") - dot(F.col("__first"), "__b")).drop("__first", "__b", "__n")
    lagged = [F.lag("__z", k).over(w) for k in LAGS[form]] + [F.lag("__e", k).over(w) for k in LAGS[form]] + [F.col(f"__d_{c}") for c in exog]
    lagged += [F.lag(f"__d_{c}", k).over(w) for k in LAGS[form] for c in exog]
    return x.withColumn("__x", F.array(*[c.cast("double") for c in lagged]))


def fit(train: DataFrame, ds: str = "ds", y: str = "y", exog: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """One row per series: form (seasonal or non-seasonal), beta of the regressors, the recursion's coefficients, params,
    sigma, n, and the state that a forecast starts from (last days' noise and errors)."""
    by, exog = list(by), list(exog)
    nx = len(exog)
    sums = {form: _columns(train, form, exog, by, ds, y) for form in LAGS}
    grams = {form: gram_sums(x.filter(~F.exists("__x", lambda v: v.isNull())), "__z", by) for form, x in sums.items()}
    both = (grams["seasonal"].select("__series", *[F.col(c).alias(f"{c}_s") for c in ("g", "b", "yy", "n")])
            .join(grams["non-seasonal"].select("__series", *[F.col(c).alias(f"{c}_p") for c in ("g", "b", "yy", "n")]), "__series", "full"))

    def solve(pdfs):
        for pdf in pdfs:
            rows = []
            for _, r in pdf.iterrows():
                done = None
                for form, end in (("seasonal", "s"), ("non-seasonal", "p")):
                    if r[f"b_{end}"] is not None and r[f"n_{end}"] == r[f"n_{end}"]:
                        b = np.asarray(r[f"b_{end}"], float)
                        done = gauss_newton(np.asarray(r[f"g_{end}"], float).reshape(len(b), -1), b, float(r[f"yy_{end}"]), int(r[f"n_{end}"]), form, nx)
                    if done is not None:
                        break
                if done is None:  # no form can be told: the last value goes on
                    form, done = "none", (np.zeros(nx + 4), 0.0)
                own, errors = recursion(done[0], "non-seasonal" if form == "none" else form, nx)
                rows.append((r["__series"], form, done[0][:nx].tolist(), own.tolist(), errors.tolist(), done[0].tolist(), done[1],
                             int(r["n_s"] if form == "seasonal" else r["n_p"] if form == "non-seasonal" else 0)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in MODEL.split(", ")])
    coef = both.mapInPandas(solve, MODEL)
    # the last rows' values; which errors count depends on the form
    key = F.to_json(F.struct(*[F.col(c) for c in by])) if by else F.lit("{}")
    keep = [*by, ds, F.col(y).cast("double").alias("__v"), F.array(*[F.col(c).cast("double") for c in exog]).cast("array<double>").alias("__r")]
    tail = (sums["seasonal"].select(*keep, F.col("__e").alias("__es"))
            .join(sums["non-seasonal"].select(*by, ds, F.col("__e").alias("__ep")), [*by, ds]))
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(F.col(ds).desc())
    tail = tail.where("__v IS NOT NULL").withColumn("__back", F.row_number().over(w)).where(F.col("__back") <= MEMORY)
    state = tail.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(ds).alias("ds"), F.col("__v").alias("v"), F.col("__r").alias("r"),
                                                                       F.coalesce("__es", F.lit(0.0)).alias("es"), F.coalesce("__ep", F.lit(0.0)).alias("ep")))).alias("last"))
    # a series too short for any lag has no sums: its last value goes on
    own, errors = recursion(np.zeros(nx + 4), "non-seasonal", nx)
    rest = {"form": F.lit("none"), "sigma": F.lit(0.0), "n": F.lit(0).cast("long"),
            **{c: F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")
               for c, values in (("beta", [0.0] * nx), ("own", own), ("errors", errors), ("params", [0.0] * (nx + 4)))}}
    out = state.where(F.size("last") > 0).withColumn("__series", key).join(coef, "__series", "left")
    return out.withColumns({c: F.coalesce(c, v) for c, v in rest.items()}).drop("__series")


def forecast(model: DataFrame, future: DataFrame, ds: str = "ds", exog: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """ds, step, yhat, yhat_lower, yhat_upper and form on the future rows, each series recursively in date order;
    a null regressor counts as 0."""
    by, exog = list(by), list(exog)
    key = F.to_json(F.struct(*[F.col(c) for c in by])) if by else F.lit("{}")
    rows = future.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(ds).alias("ds"), F.array(*[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in exog]).cast("array<double>").alias("r")))).alias("rows"))
    joined = (rows.join(model, by) if by else rows.crossJoin(F.broadcast(model)))  # one row per series
    schema = f"__series string, form string, ds {future.schema[ds].dataType.simpleString()}, step int, yhat double, yhat_lower double, yhat_upper double"

    def run(pdfs):
        for pdf in pdfs:
            out = []
            for _, r in pdf.iterrows():
                own, ma, beta = (np.asarray(r[c], float) for c in ("own", "errors", "beta"))
                noise = [x["v"] - float(np.asarray([v or 0.0 for v in x["r"]], float) @ beta) for x in r["last"]]
                error = [0.0 if r["form"] == "none" else x["es"] if r["form"] == "seasonal" else x["ep"] for x in r["last"]]
                noise, error = [noise[0]] * (len(own) - len(noise)) + noise, [0.0] * (len(ma) - len(error)) + error
                psi = []
                for step, x in enumerate(r["rows"], 1):
                    here = float(own @ noise[-1:-len(own) - 1:-1] + ma @ error[-1:-len(ma) - 1:-1])
                    j = step - 1
                    psi.append(1.0 if j == 0 else (ma[j - 1] if j <= len(ma) else 0.0) + sum(own[i - 1] * psi[j - i] for i in range(1, min(j, len(own)) + 1)))
                    noise.append(here)
                    error.append(0.0)
                    yhat = here + float(np.asarray(x["r"], float) @ beta)
                    band = Z95 * r["sigma"] * float(np.sqrt(np.sum(np.square(psi))))
                    out.append((r["__series"], r["form"], x["ds"], step, yhat, yhat - band, yhat + band))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])
    out = joined.select(key.alias("__series"), "form", "rows", "last", "own", "errors", "beta", "sigma").mapInPandas(run, schema)
    out = out.withColumnRenamed("ds", ds)
    if not by:
        return out.drop("__series")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in future.select(*by).schema.fields)
    return out.withColumn("__k", F.from_json("__series", names)).select("__k.*", *[c for c in out.columns if c != "__series"])
