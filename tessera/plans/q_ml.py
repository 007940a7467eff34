"""Registered model jobs (fits: rows-only checks, property tests in pytest)."""

from __future__ import annotations

from tessera.functions.hashing import hash_uniform_sql, np_round, np_round_sql
from tessera.operators import explain as xp
from tessera.operators import ml
from tessera.plans import classify, scoring
from tessera.plans.q_features import ENG_SQL, SPLIT_SQL, U, W
from tessera.plans.registry import register

register("t01_logreg_scores")(lambda s, d: classify.fit_and_score(s, d, "logreg"))
register("t02_rf_scores")(lambda s, d: classify.fit_and_score(s, d, "rf"))
register("t03_gbt_scores")(lambda s, d: classify.fit_and_score(s, d, "gbt"))
register("t04_mlp_scores")(lambda s, d: classify.fit_and_score(s, d, "mlp"))
register("t05_grid_search_logreg")(lambda s, d: classify.search_and_score(s, d, "logreg"))
register("t05_grid_search_rf")(lambda s, d: classify.search_and_score(s, d, "rf"))
register("t05_grid_search_gbt")(lambda s, d: classify.search_and_score(s, d, "gbt"))
register("t05_grid_search_mlp")(lambda s, d: classify.search_and_score(s, d, "mlp"))
register("t05_grid_search_logreg_oversampled")(lambda s, d: classify.search_and_score(s, d, "logreg", oversample=True))
register("t05_oversampled_folds", W + SPLIT_SQL + f""", tr AS (SELECT row_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {U}, row_id) - 1) % 5 AS INT) AS fold
  FROM sp WHERE split = 'train'),
side AS (SELECT held, row_id, y FROM tr, (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS held) WHERE fold <> held),
cnt AS (SELECT held, count(*) FILTER (WHERE y = 'yes') AS n_min, count(*) FILTER (WHERE y <> 'yes') AS n_maj FROM side GROUP BY held),
pos AS (SELECT held, row_id, row_number() OVER (PARTITION BY held ORDER BY row_id) - 1 AS pos FROM side WHERE y = 'yes'),
s AS (SELECT held, n_min, unnest(range(n_maj - n_min)) AS s FROM cnt),
dr AS (SELECT held, CAST(floor({hash_uniform_sql(42, 'held', 's', "'1'")} * n_min) AS BIGINT) AS pos FROM s),
base AS (SELECT dr.held, count(*) AS synthetic, CAST(sum(row_id) AS BIGINT) AS base_sum FROM dr JOIN pos ON dr.held = pos.held AND dr.pos = pos.pos GROUP BY dr.held)
SELECT cnt.held, n_min AS minority, n_maj AS majority, synthetic, base_sum, 0 AS base_held_out, 0 AS neighbour_held_out
FROM cnt JOIN base ON cnt.held = base.held""")(classify.oversampled_folds)
register("t06_leaderboard")(lambda s, d: classify.leaderboard(s, d))
register("t06_leaderboard_oversampled")(lambda s, d: classify.leaderboard(s, d, oversample=True))
register("x03_linear_importance")(lambda s, d: classify.explain_linear(s, d))
register("x02_sampled_shapley_importance")(lambda s, d: classify.explain_sampled(s, d, "rf"))
register("x04_model_importance")(lambda s, d: classify.model_importance(s, d, "rf"))
register("x06_explain_saved_logreg")(lambda s, d: classify.explain_saved(s, d, "logreg"))
register("x06_explain_saved_gbt")(lambda s, d: classify.explain_saved(s, d, "gbt"))

# T7 and ST1 on raw records, with fixed coefficients: P10-P12, the training rows' scales and categories in SQL.
_TRAIN = "(SELECT * FROM sp WHERE split = 'train')"
_Z = " + ".join([repr(scoring.INTERCEPT)] + [f"{w!r}::DOUBLE * (CAST({c} AS DOUBLE) / s_{c})" for c, w in scoring.WEIGHTS.items()]
                + [f"{s!r}::DOUBLE * coalesce(i_{c}.n, 0)" for c, s in scoring.STEPS.items()])
RAW_SQL = (W + ENG_SQL + "," + SPLIT_SQL.replace("FROM campaign", "FROM eng") + ", st AS (SELECT " + ", ".join(
    f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}" for c in ml.NUM_COLS) + f" FROM {_TRAIN})"
    + "".join(f", i_{c} AS (SELECT v, row_number() OVER (ORDER BY v) AS n FROM (SELECT DISTINCT {c} AS v FROM {_TRAIN}))" for c in ml.CAT_COLS)
    + f" SELECT row_id, {np_round_sql(f'1 / (1 + exp(-({_Z})))', 6)} AS score FROM sp CROSS JOIN st"
    + "".join(f" LEFT JOIN i_{c} ON sp.{c} = i_{c}.v" for c in ml.CAT_COLS) + " WHERE split <> 'train'")
register("t07_score_raw", RAW_SQL)(scoring.batch_scores)
register("st01_score_raw_stream", RAW_SQL)(scoring.stream_scores)

# M6, M7, X1 and X3 with the slots of the feature vector in SQL: the categories of the training rows in order, then the scaled numbers.
_CAT_NO = {c: i for i, c in enumerate(ml.CAT_COLS)}
SLOTS_SQL = (W + ENG_SQL + "," + SPLIT_SQL.replace("FROM campaign", "FROM eng") + ", st AS (SELECT " + ", ".join(
    f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}" for c in ml.NUM_COLS) + f" FROM {_TRAIN}),\ndom AS ("
    + " UNION ALL ".join(f"SELECT DISTINCT {i} AS cat, {c} AS v FROM {_TRAIN}" for c, i in _CAT_NO.items()) + "),\n"
    + "known AS (SELECT *, row_number() OVER (ORDER BY cat, v) - 1 AS slot FROM dom),\n"
    + "slots AS (SELECT row_id, split, CAST(slot AS INT) AS slot, (CASE cat " + " ".join(f"WHEN {i} THEN '{c}__oh_'" for c, i in _CAT_NO.items())
    + " END) || v AS name, CASE WHEN (CASE cat " + " ".join(f"WHEN {i} THEN sp.{c}" for c, i in _CAT_NO.items()) + " END) = v THEN 1.0::DOUBLE ELSE 0.0 END AS x FROM sp, known\n"
    + "".join(f"UNION ALL SELECT row_id, split, CAST((SELECT count(*) FROM known) + {k} AS INT), '{c}', CAST({c} AS DOUBLE) / s_{c} FROM sp, st\n" for k, c in enumerate(ml.NUM_COLS)) + ")\n")
_MEANS = (", mean AS (SELECT slot, avg(x) AS m FROM slots WHERE split = 'train' GROUP BY slot), "
          "phi AS (SELECT row_id, name AS feature, (x - m) * (CASE WHEN s.slot % 2 = 0 THEN 1 ELSE -1 END * 0.05::DOUBLE * (s.slot % 7 + 1)) AS phi "
          "FROM slots s JOIN mean ON s.slot = mean.slot WHERE split = 'test')\n")
register("m06_slot_sums", SLOTS_SQL + f"SELECT split, slot, name, count(*) FILTER (WHERE x <> 0) AS filled, {np_round_sql('sum(x)', 4)} AS total FROM slots GROUP BY split, slot, name")(
    classify.slot_sums)
register("x01_fixed_attributions", SLOTS_SQL + _MEANS + f"SELECT row_id, feature, {np_round_sql('phi', 6)} AS phi FROM phi")(
    lambda s, d: classify.fixed_attributions(s, d).withColumn("phi", np_round("phi", 6)))
register("x03_fixed_importance", SLOTS_SQL + _MEANS + f"""SELECT feature, {np_round_sql('avg(abs(phi))', 6)} AS mean_abs_phi,
  CAST(row_number() OVER (ORDER BY avg(abs(phi)) DESC, feature) AS INT) AS rank FROM phi GROUP BY feature ORDER BY rank LIMIT 5""")(
    lambda s, d: xp.global_importance(classify.fixed_attributions(s, d), 5).withColumn("mean_abs_phi", np_round("mean_abs_phi", 6)))
