"""Seasonal regression from Gram sums against plain least squares on the rows."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import gram

FORM = gram.Form(("r",), (("weekly", 7.0, 2), ("yearly", 365.25, 1)), 3)
POINT = {"changepoint": 0.05, "season": 1.0, "holiday": 0.01, "mode": "additive"}


def made(days=1200, seed=1, scale=False, noise=1.0):
    r = np.random.default_rng(seed)
    day0 = dt.date(2015, 1, 1)
    epoch = (day0 - dt.date(1970, 1, 1)).days
    n = np.arange(days)
    reg = r.normal(10, 3, days)
    wave = 0.1 * np.sin(2 * math.pi * (n + epoch) / 7) + 0.05 * np.cos(2 * math.pi * (n + epoch) / 365.25) + 0.02 * (reg - 10)
    trend = 100 + 60 * n / days + 80 * np.maximum(n / days - 0.4, 0)
    y = (trend * (1 + wave) if scale else trend + 100 * wave) + r.normal(0, noise, days)
    return [(day0 + dt.timedelta(days=int(i)), float(v), float(g)) for i, v, g in zip(n, y, reg)]


def plain_columns(rows, first, days):
    t = np.array([(d - first).days / days for d, _, _ in rows])
    day = np.array([(d - dt.date(1970, 1, 1)).days for d, _, _ in rows], dtype=float)
    z = np.column_stack([np.ones(len(t)), t, *[np.maximum(t - k, 0) for k in FORM.knot_places()]])
    waves = [f(2 * np.pi * k * day / p) for _, p, o in FORM.seasons for k in range(1, o + 1) for f in (np.sin, np.cos)]
    return z, np.column_stack(waves), np.array([g for _, _, g in rows])


def plain_additive(train, point, first, days, last=1.0):
    """Ridge on the rows themselves; returns a function of rows."""
    z, w, r = plain_columns(train, first, days)
    mean, sd = r.mean(), r.std(ddof=1)
    y = np.array([v for _, v, _ in train])
    used = np.append([True, True], FORM.knot_places() <= gram.KNOT_RANGE * last + 1e-12)
    x = np.column_stack([z[:, used], w, (r - mean) / sd])
    scale2 = (y ** 2).mean()
    start = np.linalg.lstsq(x, y, rcond=None)[0]
    noise = ((y - x @ start) ** 2).sum() / (len(y) - x.shape[1]) / scale2
    k = int(used.sum())
    pen = np.array([0, 0] + [noise / point["changepoint"] ** 2] * (k - 2) + [noise / point["season"] ** 2] * w.shape[1] + [noise / point["holiday"] ** 2])
    beta = np.linalg.solve(x.T @ x + np.diag(pen), x.T @ y)

    def predict(rows):
        z, w, r = plain_columns(rows, first, days)
        return np.column_stack([z[:, used], w, (r - mean) / sd]) @ beta
    return predict


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_fit_recovers_the_series(spark, mode):
    rows = made(scale=mode == "multiplicative")
    df = spark.createDataFrame(rows, "ds date, y double, r double").repartition(5)
    chosen = spark.createDataFrame([(f'{{"changepoint": 10.0, "season": 10.0, "holiday": 10.0, "mode": "{mode}"}}',)], "params string")
    m = gram.fit(df, chosen, "ds", "y", FORM)
    row = m.first()
    assert row["sigma"] == pytest.approx(1.0, abs=0.1) and row["mode"] == mode
    out = gram.forecast(m, df, "ds", FORM).orderBy("ds").collect()
    assert np.sqrt(np.mean([(r.y - r.yhat) ** 2 for r in out])) < 1.1
    assert np.mean([r.yhat_lower <= r.y <= r.yhat_upper for r in out]) > 0.92


def test_additive_fit_equals_ridge_on_the_rows(spark):
    import json
    rows = made(500)
    df = spark.createDataFrame(rows + [(dt.date(2015, 3, 3), None, 1.0), (dt.date(2015, 3, 4), 5.0, None)], "ds date, y double, r double").repartition(4)
    m = gram.fit(df, spark.createDataFrame([(json.dumps(POINT),)], "params string"), "ds", "y", FORM)
    got = {r.ds: r.yhat for r in gram.forecast(m, df.where("y is not null and r is not null"), "ds", FORM).collect()}
    want = plain_additive(rows, POINT, rows[0][0], 499)(rows)
    assert m.first()["n"] == 500 and all(got[d] == pytest.approx(v, rel=1e-6) for (d, _, _), v in zip(rows, want))


def test_cutoff_errors_equal_fits_on_the_copied_rows(spark):
    rows = made(900)
    df = spark.createDataFrame([("a", *x) for x in rows] + [("b", *x) for x in made(300, 2)], "s string, ds date, y double, r double").repartition(6)
    grid = [POINT, {**POINT, "season": 10.0, "changepoint": 0.001}]
    got = gram.cutoff_errors(df, "ds", "y", FORM, grid, 400, 120, 150, ["s"]).collect()
    assert {r.s for r in got} == {"a"}  # the other series is too short for a cutoff
    last = rows[-1][0] - dt.timedelta(days=150)
    cuts = [last - dt.timedelta(days=120 * k) for k in range(9) if last - dt.timedelta(days=120 * k) >= rows[0][0] + dt.timedelta(days=400)]
    assert sorted({r.cutoff for r in got}) == sorted(cuts) and len(got) == 2 * len(cuts)
    for r in got:
        train = [x for x in rows if x[0] <= r.cutoff]
        test = [x for x in rows if r.cutoff < x[0] <= r.cutoff + dt.timedelta(days=150)]
        guess = plain_additive(train, grid[r.grid_index], rows[0][0], 899, (r.cutoff - rows[0][0]).days / 899)(test)
        assert (r.n_train, r.n_test) == (len(train), len(test))
        assert r.rmse == pytest.approx(float(np.sqrt(np.mean((guess - [y for _, y, _ in test]) ** 2))), rel=1e-5)


def test_the_scaled_form_wins_where_the_season_grows(spark):
    df = spark.createDataFrame(made(1500, 3, scale=True), "ds date, y double, r double")
    grid = [{"changepoint": 1.0, "season": 10.0, "holiday": 10.0, "mode": m} for m in gram.MODES]
    mean = {r.grid_index: r.mean_rmse for r in gram.mean_errors(gram.cutoff_errors(df, "ds", "y", FORM, grid), grid).collect()}
    assert mean[1] < mean[0]


def test_grid_has_72_points_and_one_job_reads_the_rows_once(spark):
    assert len(gram.GRID) == 72 and len({tuple(g.values()) for g in gram.GRID}) == 72
    df = spark.createDataFrame(made(1100), "ds date, y double, r double")
    out = gram.mean_errors(gram.cutoff_errors(df, "ds", "y", FORM)).collect()
    assert len(out) == 72 and all(r.n_cutoffs == 2 and r.mean_rmse > 0 for r in out)


def test_nothing_to_fit(spark):
    none = spark.createDataFrame([], "ds date, y double, r double")
    assert gram.cutoff_errors(none, "ds", "y", FORM).count() == 0
    assert gram.fit(none, None, "ds", "y", FORM).count() == 0
