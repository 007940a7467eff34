"""The seasonal autoregression: products of lags, recovered coefficients, fallback and recursive forecasts."""

import datetime as dt

import numpy as np
import pytest

from tessera.operators import arima

DAY = dt.date(2010, 1, 1)


def simulated(n=4000, seed=3, p=(0.3, -0.6), ps=0.5, q=(0.7, 0.4), qs=0.4, beta=(2.0,), noise=1.0):
    """y = x'b + noise whose differences follow the model; returns (rows, regressors, errors)."""
    r = np.random.default_rng(seed)
    e = r.normal(0, noise, n + 50)
    ma = np.zeros(10)
    ma[[0, 1, 2]] = 1, *q
    ma = np.convolve(ma[:3], np.r_[1, np.zeros(6), qs])
    ar = np.convolve(np.r_[1, -np.array(p)], np.r_[1, np.zeros(6), -ps])
    w = np.zeros(n + 50)
    for t in range(n + 50):
        w[t] = sum(m * e[t - k] for k, m in enumerate(ma) if t >= k) - sum(a * w[t - k] for k, a in enumerate(ar) if k and t >= k)
    d = np.convolve([1, -1], np.r_[1, np.zeros(6), -1])
    y = np.zeros(n + 50)
    for t in range(n + 50):
        y[t] = w[t] - sum(c * y[t - k] for k, c in enumerate(d) if k and t >= k)
    x = r.normal(0, 2, (n + 50, len(beta)))
    return (y + x @ np.array(beta))[50:], x[50:], e[50:]


def table(spark, y, x, name=None):
    cols = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    rows = [((name,) if name else ()) + (DAY + dt.timedelta(days=i), float(v), *map(float, r)) for i, (v, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, ("s string, " if name else "") + f"ds date, y double{', ' + cols if cols else ''}")


def test_products_of_the_lags():
    par = np.array([2.0, 0.5, -0.2, 0.3, 0.4, 0.1, -0.6])
    coef, slope = arima.expanded(par, "seasonal", 1)
    assert np.allclose(coef[:5], [0.5, -0.2, 0.3, -0.15, 0.06]) and np.allclose(coef[5:10], [0.4, 0.1, -0.6, -0.24, -0.06])
    assert np.allclose(coef[10:], 2.0 * np.array([1, -0.5, 0.2, -0.3, 0.15, -0.06]))
    for i in range(len(par)):
        step = np.zeros(len(par))
        step[i] = 1e-6
        assert np.allclose((arima.expanded(par + step, "seasonal", 1)[0] - arima.expanded(par - step, "seasonal", 1)[0]) / 2e-6, slope[:, i], atol=1e-6)
    own, errors = arima.recursion(par, "seasonal", 1)
    full = np.convolve(np.convolve(np.convolve([1, -0.5, 0.2], np.r_[1, np.zeros(6), -0.3]), [1, -1]), np.r_[1, np.zeros(6), -1])
    assert np.allclose(own, -full[1:]) and np.allclose(errors, np.convolve([1, 0.4, 0.1], np.r_[1, np.zeros(6), -0.6])[1:])


def test_known_coefficients_come_back(spark):
    y, x, _ = simulated()
    r = arima.fit(table(spark, y, x).repartition(3), "ds", "y", ["x0"]).first()
    assert r["form"] == "seasonal" and r["sigma"] == pytest.approx(1.0, abs=0.05)
    assert np.allclose(r["params"], [2.0, 0.3, -0.6, 0.5, 0.7, 0.4, 0.4], atol=0.08) and r["beta"][0] == pytest.approx(2.0, abs=0.03)


def test_forecast_is_the_conditional_mean(spark):
    """One step ahead the error is that of the innovations; the band covers and widens."""
    y, x, e = simulated(3000)
    cut = 2900
    df = table(spark, y, x)
    m = arima.fit(df.where(f"ds < date'{DAY + dt.timedelta(days=cut)}'"), "ds", "y", ["x0"])
    got = arima.forecast(m, df.where(f"ds >= date'{DAY + dt.timedelta(days=cut)}'"), "ds", ["x0"]).orderBy("step").collect()
    assert [g.step for g in got] == list(range(1, 101)) and got[0].ds == DAY + dt.timedelta(days=cut)
    assert abs(got[0].yhat - (y[cut] - e[cut])) < 0.4
    width = [g.yhat_upper - g.yhat_lower for g in got]
    assert width == sorted(width) and width[0] == pytest.approx(2 * 1.96 * m.first()["sigma"], rel=1e-3)
    assert np.mean([g.yhat_lower <= v <= g.yhat_upper for g, v in zip(got, y[cut:])]) > 0.8


def test_a_singular_series_takes_the_fallback_and_says_so(spark):
    r = np.random.default_rng(0)
    n = np.arange(700)
    weekly = 5.0 * np.array([1, 4, 2, 8, 5, 7, 3])[n % 7] + 0.25 * n  # weekly differences vanish after one more
    fine, x, _ = simulated(700, 9, beta=())
    series = {"weekly": weekly, "fine": fine, "flat": np.full(700, 3.0), "short": r.normal(size=12)}
    df = None
    for name, y in series.items():
        own = table(spark, y, np.zeros((len(y), 0)), name)
        df = own if df is None else df.unionByName(own)
    m = arima.fit(df, "ds", "y", [], ["s"])
    form = {x["s"]: x["form"] for x in m.collect()}
    assert form == {"weekly": "non-seasonal", "fine": "seasonal", "flat": "none", "short": "none"}
    future = spark.createDataFrame([(s, DAY + dt.timedelta(days=len(y) + k)) for s, y in series.items() for k in range(5)], "s string, ds date")
    got = {(x.s, x.step): x for x in arima.forecast(m, future, "ds", [], ["s"]).collect()}
    assert len(got) == 20 and all(got["flat", k].yhat == pytest.approx(3.0) for k in range(1, 6))
    assert all(np.isfinite(x.yhat) and x.form == form[x.s] for x in got.values())


def test_nothing_to_fit(spark):
    none = spark.createDataFrame([], "ds date, y double, x0 double")
    assert arima.fit(none, "ds", "y", ["x0"]).count() == 0
