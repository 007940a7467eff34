"""Seasonal regression from Gram sums: every cutoff and grid point of a search from one pass over the rows.

The model of a series is a piecewise linear trend (level, slope, a change of slope at each knot), Fourier terms and
standardized regressors, either added to the trend or scaling it.  Both are sums of products of a trend
column and a (seasonal or constant) column, so one table of products, the Gram matrix of their sums per
series and segment of days, holds all that a fit needs.  Cutoffs cut the days into segments: the training
rows of a cutoff are the segments up to it, its test rows those of the horizon behind it.  No row is copied
per cutoff or grid point, and none is read again: penalties, standardizing, the alternating fit of the
multiplicative form and the test errors are algebra on the summed matrices.

Penalties are those of normal priors per block, in units of the scaled target: changes of slope, seasons, and
regressors (with holidays) each have their scale; level and slope are free.  Rows with a null target or
regressor are left out.  p product columns move p * (p + 1) / 2 numbers per series, segment and task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.forecast import EPOCH, SEASONS, Z95, cutoffs

# The reference's grid (fixed values).
CHANGEPOINT_SCALES = [0.001, 0.01, 0.05, 0.1]
SEASON_SCALES = [0.01, 1.0, 10.0]
HOLIDAY_SCALES = [0.01, 1.0, 10.0]
MODES = ["additive", "multiplicative"]
GRID = [dict(zip(("changepoint", "season", "holiday", "mode"), v))
        for v in itertools.product(CHANGEPOINT_SCALES, SEASON_SCALES, HOLIDAY_SCALES, MODES)]
DEFAULT = {"changepoint": 0.05, "season": 10.0, "holiday": 10.0, "mode": "additive"}
KNOTS, KNOT_RANGE = 8, 0.8  # changes of slope, evenly over this share of a training span
TURNS = 12                  # alternating fits of the multiplicative form


@dataclass(frozen=True)
class Form:
    """Which columns the model has."""

    regressors: tuple[str, ...] = ()
    seasons: tuple[tuple[str, float, int], ...] = SEASONS
    knots: int = KNOTS

    @property
    def trend_size(self) -> int:
        return 2 + self.knots

    @property
    def season_size(self) -> int:
        return 2 * sum(o for _, _, o in self.seasons)

    @property
    def other_size(self) -> int:
        return 1 + self.season_size + len(self.regressors)

    def knot_places(self) -> np.ndarray:
        return np.arange(1, self.knots + 1) / (self.knots + 1) * KNOT_RANGE

    def trend(self, t: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(t)), t, *[np.maximum(t - k, 0) for k in self.knot_places()]])

    def others(self, day: np.ndarray, regressors: np.ndarray) -> np.ndarray:
        waves = [f(2 * np.pi * k * day / p) for _, p, o in self.seasons for k in range(1, o + 1) for f in (np.sin, np.cos)]
        return np.column_stack([np.ones(len(day)), *waves, regressors])


def spans(df: DataFrame, ds: str, by: Sequence[str]) -> DataFrame:
    """Per series the first day and the number of days that the trend's unit of time spans."""
    return df.groupBy(*by).agg(F.min(ds).alias("__first"), F.greatest(F.datediff(F.max(ds), F.min(ds)), F.lit(1)).alias("__days"))


def _with(df: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.join(small, list(by)) if by else df.crossJoin(F.broadcast(small))  # one row


def _time(ds: str) -> tuple[Column, Column]:
    return (F.datediff(ds, "__first") / F.col("__days")).alias("__t"), F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double").alias("__day")


def _pack(m: np.ndarray) -> bytes:
    return m[np.triu_indices(len(m))].tobytes()


def _unpack(raw: bytes, p: int) -> np.ndarray:
    m = np.zeros((p, p))
    m[np.triu_indices(p)] = np.frombuffer(raw)
    return m + np.triu(m, 1).T


SUMS = "series string, segment int, salt int, n long, yy double, b binary, g binary"


def gram_table(df: DataFrame, form: Form, ds: str, y: str, segment: Column, span: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per series (its keys as JSON) and segment: n, y'y, X'y and the upper half of X'X of the product columns."""
    key = F.to_json(F.struct(*[F.col(c) for c in by])) if by else F.lit("{}")
    x = _with(df, span, by).select(key.alias("series"), segment.cast("int").alias("segment"), *_time(ds), F.col(y).cast("double").alias("__y"),
                                   F.array(*[F.col(r).cast("double") for r in form.regressors]).cast("array<double>").alias("__r"))
    x = x.where("__y IS NOT NULL AND segment IS NOT NULL").where(~F.exists("__r", lambda v: v.isNull()))

    def partial(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        salt = TaskContext.get().partitionId() % 64
        for pdf in pdfs:
            out = []
            for (series, seg), own in pdf.groupby(["series", "segment"], sort=False):
                regs = np.vstack(own["__r"]).astype(float) if form.regressors else np.zeros((len(own), 0))
                z, o = form.trend(own["__t"].to_numpy(float)), form.others(own["__day"].to_numpy(float), regs)
                phi = (z[:, :, None] * o[:, None, :]).reshape(len(own), -1)
                v = own["__y"].to_numpy(float)
                out.append((series, seg, salt, len(own), float(v @ v), (phi.T @ v).tobytes(), _pack(phi.T @ phi)))
            yield pd.DataFrame(out, columns=["series", "segment", "salt", "n", "yy", "b", "g"])

    def added(t: pa.Table) -> pa.Table:
        def total(name):
            out = None
            for raw in t[name]:
                own = np.frombuffer(raw.as_buffer())
                out = own.copy() if out is None else out + own
            return pa.array([out.tobytes()], pa.binary())
        return pa.table([t["series"][:1], t["segment"][:1], t["salt"][:1], pa.array([sum(t["n"].to_pylist())], pa.int64()),
                         pa.array([float(np.sum(t["yy"].to_numpy()))]), total("b"), total("g")], names=t.column_names)
    # two levels, so no task adds up the matrices of all tasks
    some = x.mapInPandas(partial, SUMS).groupBy("series", "segment", "salt").applyInArrow(added, SUMS)
    return some.withColumn("salt", F.lit(0)).groupBy("series", "segment", "salt").applyInArrow(added, SUMS).drop("salt")


# --------------------------------------------------------------- the algebra
@dataclass
class Sums:
    """n, y'y, X'y and X'X of some rows."""

    n: int
    yy: float
    b: np.ndarray
    g: np.ndarray

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.n + other.n, self.yy + other.yy, self.b + other.b, self.g + other.g)

    def through(self, k: np.ndarray) -> Sums:
        """The sums of the columns X @ k."""
        return Sums(self.n, self.yy, k.T @ self.b, k.T @ self.g @ k)

    def errors(self, theta: np.ndarray) -> float:
        return max(float(self.yy - 2 * theta @ self.b + theta @ self.g @ theta), 0.0)


def standardizing(sums: Sums, form: Form) -> np.ndarray:
    """Matrix from the product columns to those with standardized regressors, by the moments in ``sums``."""
    size = form.other_size
    m = np.eye(size)
    for i in range(1 + form.season_size, size):
        mean = sums.g[0, i] / sums.n
        var = max(sums.g[i, i] / sums.n - mean ** 2, 0.0) * sums.n / max(sums.n - 1, 1)
        sd = np.sqrt(var) if var > 1e-12 * max(1.0, mean ** 2) else 1.0
        m[i, i], m[0, i] = 1 / sd, -mean / sd
    return np.kron(np.eye(form.trend_size), m)


def _ridge(g: np.ndarray, b: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(g + np.diag(penalty), b, rcond=1e-12)[0]


def solve(sums: Sums, form: Form, point: dict, last: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(trend coefficients, other coefficients with a leading 1 or 0) of one grid point from standardized sums.

    ``last`` is the training rows' last time; knots beyond ``KNOT_RANGE`` of it are held at 0.  The
    additive form has the products with the level only; the multiplicative one alternates between trend
    and others, each a ridge solve in the sums of the products."""
    zs, xs = form.trend_size, form.other_size
    scale = np.sqrt(sums.yy / max(sums.n, 1)) or 1.0
    used = np.append([True, True], form.knot_places() <= KNOT_RANGE * last + 1e-12)
    season = np.arange(1, xs) <= form.season_size
    level = np.zeros((zs * xs, zs + xs - 1))  # additive columns: trend, then the others
    for a in range(zs):
        level[a * xs, a] = 1.0
    level[np.arange(1, xs), zs + np.arange(xs - 1)] = 1.0
    free = np.append(used, np.ones(xs - 1, dtype=bool))
    plain = sums.through(level[:, free])
    start = _ridge(plain.g, plain.b, np.full(int(free.sum()), 1e-9 * max(np.trace(plain.g) / free.sum(), 1e-12)))
    noise = max(plain.errors(start) / max(sums.n - free.sum(), 1), 1e-12 * scale ** 2) / scale ** 2
    knot_penalty = np.where(np.arange(zs) >= 2, noise / point["changepoint"] ** 2, 0.0)
    other_penalty = noise / np.where(season, point["season"], point["holiday"]) ** 2
    if point["mode"] == "additive":
        theta = np.zeros(zs + xs - 1)
        theta[free] = _ridge(plain.g, plain.b, np.append(knot_penalty, other_penalty)[free])
        return theta[:zs], np.append(0.0, theta[zs:])
    beta = np.zeros(xs - 1)
    eye = np.eye(zs)
    for _ in range(TURNS):
        own = sums.through(np.kron(eye, np.append(1.0, beta)[:, None])[:, used])
        gamma = np.zeros(zs)
        gamma[used] = _ridge(own.g, own.b, knot_penalty[used])
        by_other = np.kron(gamma[:, None], np.eye(xs))
        own = sums.through(by_other)
        # the penalty is on the share of the trend, which is about the target's scale
        beta = _ridge(own.g[1:, 1:], own.b[1:] - own.g[1:, 0], other_penalty * scale ** 2)
    return gamma, np.append(1.0, beta)


def product(gamma: np.ndarray, others: np.ndarray, mode: str) -> np.ndarray:
    """The coefficients of the product columns."""
    if mode == "additive":
        theta = np.zeros((len(gamma), len(others)))
        theta[:, 0], theta[0, 1:] = gamma, others[1:]
        return theta.ravel()
    return np.outer(gamma, others).ravel()


# --------------------------------------------------------------- Spark jobs
def _series_columns(out: DataFrame, df: DataFrame, by: Sequence[str]) -> DataFrame:
    if not by:
        return out.drop("series")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema.fields)
    return out.withColumn("__k", F.from_json("series", schema)).select("__k.*", *[c for c in out.columns if c != "series"])


def cutoff_errors(df: DataFrame, ds: str = "ds", y: str = "y", form: Form = Form(), grid: Sequence[dict] = tuple(GRID), initial: int = 730,
                  period: int = 180, horizon: int = 90, by: Sequence[str] = ()) -> DataFrame:
    """Series, cutoff, grid_index, n_train, n_test, rmse of every cutoff and grid point, from one pass."""
    by, grid = list(by), list(grid)
    cuts = cutoffs(df, ds, initial, period, horizon, by).groupBy(*by).agg(F.sort_array(F.collect_list("cutoff")).alias("__cuts"))
    span = spans(df, ds, by)
    span = span.join(cuts, by) if by else span.crossJoin(F.broadcast(cuts))  # one row per series; cutoffs are bounded by the calendar
    edges = F.array_sort(F.array_distinct(F.concat("__cuts", F.transform("__cuts", lambda c: F.date_add(c, horizon)))))
    sums = gram_table(df, form, ds, y, F.size(F.filter(edges, lambda e: e < F.col(ds))), span, by)
    key = F.to_json(F.struct(*[F.col(c) for c in by])) if by else F.lit("{}")
    named = span.select(key.alias("series"), F.to_json(F.struct(F.col("__cuts").alias("cuts"), edges.alias("edges"), "__first", "__days")).alias("calendar"))
    p = form.trend_size * form.other_size

    def score(t: pa.Table) -> pa.Table:
        import json
        own = {s: Sums(n, yy, np.frombuffer(b), _unpack(g, p)) for s, n, yy, b, g in
               zip(*(t[c].to_pylist() for c in ("segment", "n", "yy", "b", "g")))}
        calendar = json.loads(t["calendar"][0].as_py())
        edges, first = calendar["edges"], np.datetime64(calendar["__first"])
        rows = []
        for cut in calendar["cuts"]:
            end = str(np.datetime64(cut) + np.timedelta64(horizon, "D"))
            train = [s for k, s in own.items() if k <= edges.index(cut)]
            test = [s for k, s in own.items() if edges.index(cut) < k <= edges.index(end)]
            if not train or not test:
                continue
            train, test = (sum(x[1:], x[0]) for x in (train, test))
            turned = standardizing(train, form)
            fit, held = train.through(turned), test.through(turned)
            last = float((np.datetime64(cut) - first) / np.timedelta64(1, "D")) / calendar["__days"]
            for i, point in enumerate(grid):
                theta = product(*solve(fit, form, point, last), point["mode"])
                rows.append((t["series"][0].as_py(), cut, i, fit.n, held.n, float(np.sqrt(held.errors(theta) / held.n))))
        cols = list(zip(*rows)) if rows else [()] * 6
        types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, types)], names=["series", "cutoff", "grid_index", "n_train", "n_test", "rmse"])
    out = (sums.join(named, "series").groupBy("series")
           .applyInArrow(score, "series string, cutoff string, grid_index int, n_train long, n_test long, rmse double"))
    return _series_columns(out.withColumn("cutoff", F.to_date("cutoff")), df, by)


def describe(grid: Sequence[dict]) -> Column:
    """The grid point of ``grid_index`` as JSON."""
    import json
    return F.element_at(F.array(*[F.lit(json.dumps(g)) for g in grid]), F.col("grid_index") + 1)


def mean_errors(errors: DataFrame, grid: Sequence[dict] = tuple(GRID), by: Sequence[str] = ()) -> DataFrame:
    """grid_index, params, mean_rmse over the cutoffs, n_cutoffs."""
    return (errors.groupBy(*by, "grid_index").agg(F.avg("rmse").alias("mean_rmse"), F.count(F.lit(1)).alias("n_cutoffs"))
            .withColumn("params", describe(list(grid))))


MODEL = "series string, mode string, gamma array<double>, others array<double>, sigma double, n long"


def fit(df: DataFrame, chosen: DataFrame | None = None, ds: str = "ds", y: str = "y", form: Form = Form(), by: Sequence[str] = ()) -> DataFrame:
    """One row of coefficients per series at the grid point in ``chosen`` (series columns, params as JSON; else
    ``DEFAULT``), for the columns before standardizing, with the span that its time is measured in."""
    import json
    by = list(by)
    span = spans(df, ds, by)
    sums = gram_table(df, form, ds, y, F.lit(0), span, by)
    key = F.to_json(F.struct(*[F.col(c) for c in by])) if by else F.lit("{}")
    if chosen is not None:
        sums = sums.join(chosen.select(key.alias("series"), "params"), "series")
    else:
        sums = sums.withColumn("params", F.lit(json.dumps(DEFAULT)))
    p = form.trend_size * form.other_size

    def solved(batches):
        for b in batches:
            rows = []
            for series, n, yy, xy, g, params in zip(*(b.column(c).to_pylist() for c in ("series", "n", "yy", "b", "g", "params"))):
                own, point = Sums(n, yy, np.frombuffer(xy), _unpack(g, p)), json.loads(params)
                turned = standardizing(own, form)
                standard = own.through(turned)
                gamma, others = solve(standard, form, point)
                sse = standard.errors(product(gamma, others, point["mode"]))
                m = turned[:form.other_size, :form.other_size]
                raw = m @ others
                if point["mode"] == "additive":  # the regressors' means go to the level
                    gamma = gamma.copy()
                    gamma[0] += raw[0]
                    raw[0] = 0.0
                sigma = float(np.sqrt(sse / max(n - len(gamma) - len(others), 1)))
                rows.append((series, point["mode"], gamma.tolist(), raw.tolist(), sigma, n))
            types = [pa.string(), pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.int64()]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names=["series", "mode", "gamma", "others", "sigma", "n"])
    named = span.select(key.alias("series"), "__first", "__days")
    return _series_columns(sums.mapInArrow(solved, MODEL).join(named, "series"), df, by)


def forecast(model: DataFrame, future: DataFrame, ds: str = "ds", form: Form = Form(), by: Sequence[str] = ()) -> DataFrame:
    """Yhat, yhat_lower and yhat_upper of the future rows."""
    x = _with(future, model, by)
    t, day = _time(ds)
    trend = F.array(F.lit(1.0), t, *[F.greatest(t - F.lit(float(k)), F.lit(0.0)) for k in form.knot_places()])
    waves = [f(F.lit(2 * np.pi * k / p) * day) for _, p, o in form.seasons for k in range(1, o + 1) for f in (F.sin, F.cos)]
    others = F.array(*[c.cast("double") for c in (F.lit(1.0), *waves, *[F.col(r) for r in form.regressors])])

    def dot(a: Column, b: str) -> Column:
        return F.aggregate(F.zip_with(a, F.col(b), lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    yhat = F.when(F.col("mode") == "additive", dot(trend, "gamma") + dot(others, "others")).otherwise(dot(trend, "gamma") * dot(others, "others"))
    out = x.withColumn("yhat", yhat)
    return (out.withColumn("yhat_lower", F.col("yhat") - Z95 * F.col("sigma")).withColumn("yhat_upper", F.col("yhat") + Z95 * F.col("sigma"))
            .drop("mode", "gamma", "others", "sigma", "n", "__first", "__days"))
