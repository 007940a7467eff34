"""Model explanation: linear attributions, global importance, model-native
importances and sampled Shapley values (Strumbelj & Kononenko 2014)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_uniform
from tessera.session import checkpoint


def linear_shap(df: DataFrame, coefficients: Sequence[float], background: DataFrame,
                features: str = "features", id_col: str = "row_id", names: Sequence[str] | None = None) -> DataFrame:
    """phi_j = w_j * (x_j - mean_j), mean over the background rows; long
    output (id, feature, phi).  Means are one aggregate (a d-length array)."""
    d = len(coefficients)
    arr = vector_to_array(F.col(features))
    means = background.select(vector_to_array(F.col(features)).alias("__x")) \
        .select([F.col("__x")[i].alias(f"m{i}") for i in range(d)]).agg(
            F.array(*[F.avg(f"m{i}") for i in range(d)]).alias("__mean"))
    w = F.array(*[F.lit(float(c)) for c in coefficients])
    x = df.select(id_col, arr.alias("__x")).crossJoin(F.broadcast(means))  # one row
    phi = F.zip_with(F.zip_with("__x", "__mean", lambda a, m: a - m), w, lambda c, wj: c * wj)
    nm = F.array(*[F.lit(n) for n in (names or [f"f{i}" for i in range(d)])])
    return x.select(id_col, F.posexplode(phi).alias("pos", "phi")).select(
        id_col, F.element_at(nm, F.col("pos") + 1).alias("feature"), "phi")


def global_importance(phi: DataFrame, k: int = 5) -> DataFrame:
    """Mean |phi| per feature, top k (ties by feature name)."""
    g = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    w = Window.orderBy(F.col("mean_abs_phi").desc(), F.col("feature"))
    return g.orderBy(F.col("mean_abs_phi").desc(), "feature").limit(k).withColumn("rank", F.row_number().over(w))


def model_importance(model, names: Sequence[str], k: int = 5) -> list[tuple[str, float]]:
    """Tree importances, or |coefficient| for linear models, top k."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        vals = [abs(v) for v in model.coefficients.toArray()]
    else:
        raise TypeError("model has neither featureImportances nor coefficients")
    pairs = sorted(zip(names, vals), key=lambda t: (-t[1], t[0]))
    return [(n, float(v)) for n, v in pairs[:k]]


def sampled_shapley(df: DataFrame, model, background: DataFrame, n_perm: int = 8, seed: int = 7,
                    features: str = "features", id_col: str = "row_id", n_features: int | None = None) -> DataFrame:
    """Monte-Carlo Shapley values for any model.  For each explained row,
    permutation p and position t, the coalition of the first t features of p
    takes the row's values, the rest a background row's; phi of feature p[t] is
    the mean difference f(S + j) - f(S).  Rows x permutations x positions are
    exploded as a DataFrame and scored by ``model.transform`` in one pass."""
    from pyspark.ml.functions import array_to_vector
    d = n_features or len(df.select(features).first()[features])
    bg = background.select(vector_to_array(F.col(features)).alias("__b")).agg(
        F.array(*[F.avg(F.col("__b")[i]) for i in range(d)]).alias("__bg"))
    x = df.select(id_col, vector_to_array(F.col(features)).alias("__x")).crossJoin(F.broadcast(bg))  # one row
    x = x.withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))))
    # permutation = feature indices sorted by a hash draw
    order = F.transform(F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                                                 lambda j: F.struct(hash_uniform(seed, id_col, "perm", j).alias("u"),
                                                                    j.alias("j")))), lambda s: s["j"])
    # few rows with much work each: the orders are drawn once, and the rows are dealt to tasks that are not merged by size
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    x = checkpoint(x.repartition(tasks, id_col, "perm").withColumn("__order", order))
    # rank of each feature in the permutation
    x = x.withColumn("__rank", F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                                           lambda j: F.array_position(F.col("__order"), j) - 1))
    x = x.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(d))))
    mix = F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                      lambda j: F.when(F.col("__rank")[j] < F.col("t"), F.col("__x")[j]).otherwise(F.col("__bg")[j]))
    x = x.withColumn(features, array_to_vector(mix))
    scored = model.transform(x).withColumn("__f", vector_to_array("probability")[1])
    w = Window.partitionBy(id_col, "perm").orderBy("t")
    diff = scored.withColumn("__delta", F.col("__f") - F.lag("__f").over(w)).filter(F.col("t") > 0)
    diff = diff.withColumn("feature_index", F.col("__order")[F.col("t") - 1])
    return diff.groupBy(id_col, "feature_index").agg(F.avg("__delta").alias("phi"))
