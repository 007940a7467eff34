"""Model preparation, training and scoring on Spark ML.

Feature pipeline (M3, M4, M6): categorical columns go through
StringIndexer(alphabetical, unseen kept) + OneHotEncoder(dropLast) so an unseen
category encodes as all zeros; numeric columns are divided by their
*population* std fitted on the training rows (never centred, constant columns
left unscaled), then everything is assembled into one sparse vector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import features as fe
from tessera.session import checkpoint

CAT_COLS = ["segment", "status", "priority", "month", "poutcome", "pdays_bucket"]
NUM_COLS = ["acctbal", "total", "campaign", "pdays", "previous", "day_of_week", "campaign_intensity", "contact_last"]


def one_hot_stages(cats: Sequence[str]) -> list:
    """M3: alphabetical indexer keeping unseen values + one-hot dropping the
    'unseen' slot, so unseen categories become all-zero vectors."""
    # one multi-column indexer: a single pass over the data for all columns
    stages = [StringIndexer(inputCols=list(cats), outputCols=[f"{c}__idx" for c in cats], handleInvalid="keep",
                            stringOrderType="alphabetAsc")]
    # the indexer's slot for unseen categories is the last, which is the one that is dropped
    stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in cats], outputCols=[f"{c}__oh" for c in cats], dropLast=True))
    return stages


def feature_pipeline(cats: Sequence[str], nums: Sequence[str], out: str = "features") -> Pipeline:
    """M6: one-hot categoricals + (already scaled) numerics -> one vector."""
    return Pipeline(stages=one_hot_stages(cats) + [
        VectorAssembler(inputCols=[f"{c}__oh" for c in cats] + list(nums), outputCol=out, handleInvalid="keep")])


def prepare(df: DataFrame, cats: Sequence[str] = CAT_COLS, nums: Sequence[str] = NUM_COLS,
            split: str = "split", fit_split: str = "train") -> tuple[DataFrame, PipelineModel]:
    """Fit scaling + encoding on the ``fit_split`` rows and apply to all rows."""
    train = df.filter(F.col(split) == fit_split)
    x = df.withColumns({c: F.col(c).cast("double") for c in nums})
    stats = fe.scale_std_fit(train.withColumns({c: F.col(c).cast("double") for c in nums}), nums)
    x = fe.scale_std_apply(x, stats, nums)
    model = feature_pipeline(cats, nums).fit(x.filter(F.col(split) == fit_split))
    return model.transform(x), model


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """M7: names of the assembled vector's slots from the ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    names = [None] * meta.get("num_attrs", len(attrs))
    for a in attrs:
        names[a["idx"]] = a.get("name", f"f{a['idx']}")
    return names


MODELS = {
    "logreg": lambda: LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                                         maxIter=2000, standardization=False),
    "rf": lambda: RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=600, seed=42),
    "gbt": lambda: GBTClassifier(featuresCol="features", labelCol="label", maxIter=800, seed=42),
    "mlp": lambda: MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", seed=42, maxIter=300),
}


BAG_BYTES = 2 * 1024 ** 3  # of a forest's draws that Spark keeps at a time: four bytes a row and tree
LEAST_ROWS = 10_000   # of a task of a fit; fewer rows don't pay for a second task
MOST_ROWS = 500_000


def even_tasks(df: DataFrame) -> int:
    """Tasks that give every core the same share of the rows in the same number of passes; 1 for few rows."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(cores * -(-n // (cores * MOST_ROWS)), n // LEAST_ROWS))


def spread(df: DataFrame, key: str = "row_id") -> DataFrame:
    """Training rows dealt evenly to tasks: a fit passes over them hundreds of times, however few partitions they
    came in.  Rows for one task stay where they are."""
    tasks = even_tasks(df)
    return checkpoint(df.repartition(tasks, key)) if tasks > 1 else df


def train(df: DataFrame, name: str):
    """One model on every row; the logistic penalty is that of C = 1, 1 / (C * sum of weights).
    Grids are searched by ``tuning.search``."""
    df = spread(df)
    est = MODELS[name]()
    if name == "mlp":
        est = est.setLayers([df.select("features").first()["features"].size, 64, 2])
    if name == "logreg":
        est = est.setRegParam(1.0 / max(1.0, df.agg(F.sum("weight")).first()[0] or 0.0))
    if name == "rf":
        return forest(est, df)
    return est.fit(df)


def forest(est: RandomForestClassifier, df: DataFrame):
    """A forest whose draws (a number per row and tree, which Spark keeps for all trees of a fit) would pass ``BAG_BYTES`` is fitted in
    groups of trees with seeds of their own and put together; a smaller one in one fit."""
    trees = est.getNumTrees()
    group = max(1, min(trees, BAG_BYTES // (4 * max(1, df.count()))))
    if group >= trees:
        return est.fit(df)
    fits = [est.copy({est.numTrees: min(group, trees - lo), est.seed: est.getSeed() + lo}).fit(df) for lo in range(0, trees, group)]
    grown = [tree._java_obj for fit in fits for tree in fit.trees]
    sc = df.sparkSession.sparkContext
    own = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, len(grown))
    for k, tree in enumerate(grown):
        own[k] = tree
    first = fits[0]
    whole = sc._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(first.uid, own, first.numFeatures, first.numClasses)
    first._java_obj.copyValues(whole, sc._jvm.org.apache.spark.ml.param.ParamMap.empty().put(whole.getParam("numTrees"), trees))
    model = RandomForestClassificationModel(whole)
    model._transfer_params_from_java()
    return model


def score(df: DataFrame, model, out: str = "score") -> DataFrame:
    """Probability of the positive class."""
    return model.transform(df).withColumn(out, vector_to_array("probability")[1])
