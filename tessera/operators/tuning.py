"""Grid search with stratified folds: every (model, grid point, fold) is one task.

Every fit learns from all training rows of its side.  The rows are written once, in the order of their ids, to the
shared folder; a host maps them into memory from a local file (``opened``), so that all processes of a host share one
copy and none of them holds the rows.  A search over 24 points and 5 folds is one Spark job of 120 tasks, whichever learner
it runs.  The choice is by the mean of the exact ROC-AUC over the folds; the best point is fitted again on all
training rows, and the model scores any number of rows in place.

With oversampling, synthetic minority rows (SMOTE) join the training side of every fold and of the final fit;
their base rows and neighbours come from that side only, so a held-out row never shapes the rows its
fold learns from.  Only the draws (base, neighbour, step) are written; a task builds the rows block by block.
"""

from __future__ import annotations

import fcntl
import itertools
import json
import os
import pickle
import re
import shutil
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import hash_uniform
from tessera.operators import learners as ln
from tessera.operators import ml
from tessera.operators import neighbors as nb
from tessera.session import checkpoint, is_local, ship_package
from tessera.streaming.jobs import scratch

ALL = -1  # the "fold" of the final fit: nothing is held out

# The reference's grids (fixed values).
GRIDS: dict[str, dict[str, list]] = {
    "logreg": {"c": [0.1, 1, 10]},
    "rf": {"trees": [600], "depth": [6, 12, None], "leaf": [1, 5]},
    "gbt": {"rounds": [800], "depth": [3, 6], "rate": [0.01, 0.05, 0.1], "rows": [0.8, 1.0], "columns": [0.8, 1.0]},
    "mlp": {"layers": [[64], [128, 64]], "penalty": [1e-4, 1e-3], "epochs": [300]},
}
LEARNERS = {"logreg": ln.logistic, "rf": ln.forest, "gbt": ln.boost, "mlp": ln.net}


def grid_points(name: str, grids: dict | None = None) -> list[dict]:
    axes = (grids or GRIDS)[name]
    return [dict(zip(axes, values)) for values in itertools.product(*axes.values())]


@dataclass
class Sample:
    """Training rows as arrays, mapped files if they come from ``folder``, and per fold the draws of synthetic rows (base,
    neighbour, step)."""

    x: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    drawn: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    folder: str | None = None

    def __reduce__(self):
        """Mapped rows travel by the name of their folder."""
        return (opened, (self.folder,)) if self.folder else (Sample, (self.x, self.label, self.fold, self.drawn))

    def side(self, fold: int) -> ln.Rows:
        return ln.Rows(self.x, self.label, None if fold == ALL else np.flatnonzero(self.fold != fold), self.drawn.get(fold))

    def training_side(self, fold: int) -> tuple[np.ndarray, np.ndarray]:
        rows = self.side(fold)
        return rows.dense(), rows.y


# the local file of every column that a search reads
STORED = {"row_id": np.int64, "label": np.float64, "fold": np.int32, "i": np.int64, "j": np.int64, "gap": np.float64}


def _mapped(name: str, kind, shape=(-1,)) -> np.ndarray:
    if not os.path.exists(name) or not os.path.getsize(name):
        return np.zeros((0, *shape[1:]), kind)
    return np.memmap(name, kind, "r").reshape(shape)


def _batches(folder: str):
    """The Arrow batches of a folder of Parquet files, in the order of the files' names."""
    at = re.sub(r"^file:/+", "file:///", folder) if folder.startswith("file:") else folder
    fs, root = pafs.FileSystem.from_uri(at) if "://" in at else (pafs.LocalFileSystem(), at)
    files = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    for f in sorted((f for f in files if f.path.endswith(".parquet")), key=lambda f: f.base_name):
        with fs.open_input_file(f.path) as src:
            yield from pq.ParquetFile(src).iter_batches(batch_size=65536)


def _fetch(folder: str, own: str) -> None:
    """Copies the rows of a search to flat local files, one a column."""
    width = 1
    with open(f"{own}/x", "wb") as x, open(f"{own}/row_id", "wb") as ids, open(f"{own}/label", "wb") as label, open(f"{own}/fold", "wb") as fold:
        for b in _batches(f"{folder}/rows"):
            if b.num_rows:
                v = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                width = len(v) // b.num_rows
                v.tofile(x)
                for f, c in ((ids, "row_id"), (label, "label"), (fold, "fold")):
                    b.column(c).to_numpy(zero_copy_only=False).astype(STORED[c]).tofile(f)
    ids, sides = _mapped(f"{own}/row_id", np.int64), {}
    for b in _batches(f"{folder}/drawn"):
        held = b.column("held").to_numpy()
        for side in np.unique(held):
            at = held == side
            for c in ("i", "j", "gap"):
                v = b.column(c).to_numpy(zero_copy_only=False)[at]
                if (c, side) not in sides:
                    sides[c, side] = open(f"{own}/{c}{side}", "wb")
                (v if c == "gap" else np.searchsorted(ids, v)).astype(STORED[c]).tofile(sides[c, side])
    for f in sides.values():
        f.close()
    with open(f"{own}/done", "w") as f:
        json.dump({"width": width, "sides": sorted({int(s) for _, s in sides})}, f)


def _local(folder: str) -> str:
    return os.path.join(SparkFiles.getRootDirectory(), folder.rstrip("/").rsplit("/", 1)[-1])


_OPENED: dict[str, Sample] = {}


def opened(folder: str) -> Sample:
    """The rows of a search, mapped from local files that the first task of a host fetches."""
    if folder not in _OPENED:
        own = _local(folder)
        os.makedirs(own, exist_ok=True)
        with open(f"{own}/lock", "w") as lock:
            fcntl.flock(lock, fcntl.LOCK_EX)
            if not os.path.exists(f"{own}/done"):
                _fetch(folder, own)
        with open(f"{own}/done") as f:
            is_so = json.load(f)
        label = _mapped(f"{own}/label", STORED["label"])
        _OPENED.clear()  # one search at a time
        _OPENED[folder] = Sample(_mapped(f"{own}/x", np.float32, (-1, is_so["width"])), label, _mapped(f"{own}/fold", STORED["fold"]),
                                 {s: tuple(_mapped(f"{own}/{c}{s}", STORED[c]) for c in ("i", "j", "gap")) for s in is_so["sides"]}, folder)
    return _OPENED[folder]


def forget(spark, sample: Sample) -> None:
    """Removes the stored rows of a search that is over; what other hosts fetched goes with their executors' folders."""
    if sample.folder:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sample.folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _OPENED.pop(sample.folder, None)
        if is_local(spark):
            shutil.rmtree(_local(sample.folder), ignore_errors=True)


def fitting_rows(train: DataFrame, fit_rows: int | None = None, seed: int = 42) -> DataFrame:
    """The training rows of a search: all of them, unless a caller asks for a hash draw of about ``fit_rows``."""
    if fit_rows is None:
        return train
    n = train.count()
    return train if n <= fit_rows else train.where(hash_uniform(seed, "row_id", F.lit("fit")) < F.lit(fit_rows / n))


def training_sides(rows: DataFrame, folds: int) -> DataFrame:
    """Every row once for each fold that does not hold it out (``held``), and once for the final fit."""
    held = F.array(*[F.lit(f) for f in range(folds)])
    return rows.withColumn("held", F.explode(F.array_append(F.array_remove(held, F.col("fold")), F.lit(ALL))))


def oversampled(rows: DataFrame, folds: int, k: int = 5, seed: int = 42) -> DataFrame:
    """held, s, i, j, gap: the synthetic rows of every training side (M8 inside T5).  The sides share one
    neighbour search: a side's k nearest are among the k nearest of each of its folds."""
    rows = rows.select("row_id", "label", "fold", vector_to_array("features").alias("v"))
    near = nb.near_pairs(rows.where("label = 1"), "row_id", "v", k, part=["fold"])
    # a row's pairs meet once, and a side takes its k nearest of them: not every pair goes to every side
    every = F.array_sort(F.collect_list(F.struct("d2", "j", "fold")))
    sides = [F.when(F.col("own_fold") != h, F.struct(F.lit(h).alias("held"), F.slice(F.filter("near", lambda p: p["fold"] != F.lit(h)), 1, k).alias("near")))
             for h in (*range(folds), ALL)]
    near = near.groupBy("i", "own_fold").agg(every.alias("near")).select("i", F.explode(F.array_compact(F.array(*sides))).alias("s"))
    near = near.select("i", "s.held", F.explode("s.near").alias("p")).select("held", "i", "p.j", "p.d2")
    return nb.smote_draws(training_sides(rows, folds), "row_id", "v", "label", 1.0, "held", k, seed, near)


def gather(rows: DataFrame, folds: int, oversample: bool = False) -> Sample:
    """All rows with their folds, and the draws of the synthetic ones, stored for the tasks of a search."""
    spark = rows.sparkSession
    ship_package(spark)
    folder, tasks = scratch(spark, "search"), ml.even_tasks(rows)

    def store(df, name, *order):
        df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).write.parquet(f"{folder}/{name}")
    store(rows.select("row_id", "label", "fold", vector_to_array("features", "float32").alias("x")), "rows", "row_id")
    if oversample:
        store(oversampled(rows, folds), "drawn", "held", "s")
    return opened(folder)


def _cost(name: str, point: dict) -> float:
    """Longest fits first, so the last tasks of a job are short."""
    return {"logreg": 0, "mlp": 2, "gbt": point.get("depth") or 0, "rf": 3 * (point.get("depth") or 30)}[name]


def _fit(name: str, point: dict, sample: Sample, fold: int) -> dict:
    return LEARNERS[name](sample.side(fold), None, **{k: tuple(v) if isinstance(v, list) else v for k, v in point.items()})


def fold_scores(spark, sample: Sample, names: Sequence[str], folds: int, grids: dict | None = None) -> DataFrame:
    """model, params (JSON), fold, auc of every fit of the search: one job, one fit a task."""
    todo = [(n, p, f) for n in names for p in grid_points(n, grids) for f in range(folds)]
    todo.sort(key=lambda t: -_cost(t[0], t[1]))
    sent = spark.sparkContext.broadcast(sample)  # the name of its folder

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in part["id"]:
                name, point, fold = todo[at]
                own = sent.value
                held = np.flatnonzero(own.fold == fold)
                model = _fit(name, point, own, fold)
                got = [ln.score(model, own.x[held[lo:lo + ln.BLOCK]]) for lo in range(0, len(held), ln.BLOCK)]
                yield pd.DataFrame({"model": [name], "params": [json.dumps(point)], "fold": [fold],
                                    "auc": [ln.auc(own.label[held], np.concatenate([np.zeros(0), *got]))]})
    return checkpoint(spark.range(0, len(todo), 1, len(todo)).mapInPandas(run, "model string, params string, fold int, auc double"))


def best_points(scores: DataFrame) -> DataFrame:
    """model, params, mean_auc of the best point of each model; of equal ones the first in text order."""
    mean = scores.groupBy("model", "params").agg(F.avg("auc").alias("mean_auc"))
    best = mean.groupBy("model").agg(F.min(F.struct((-F.col("mean_auc")).alias("m"), "params")).alias("b"))
    return best.select("model", F.col("b.params").alias("params"), (-F.col("b.m")).alias("mean_auc"))


def final_models(spark, sample: Sample, chosen: Sequence[tuple[str, dict]]) -> dict[str, dict]:
    """The chosen points fitted on all rows, one task each."""
    sent = spark.sparkContext.broadcast(sample)
    chosen = list(chosen)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in part["id"]:
                name, point = chosen[at]
                yield pd.DataFrame({"model": [name], "fitted": [pickle.dumps(_fit(name, point, sent.value, ALL))]})
    rows = spark.range(0, len(chosen), 1, len(chosen)).mapInPandas(run, "model string, fitted binary").collect()  # one row per model
    return {r["model"]: pickle.loads(r["fitted"]) for r in rows}


def apply(rows: DataFrame, model: dict, out: str = "score") -> DataFrame:
    """``rows`` with the probability of the positive class from a fitted model (T7).  A row meets hundreds of trees, so
    many rows are dealt evenly to all cores first."""
    tasks = ml.even_tasks(rows)
    rows = rows.repartition(tasks) if tasks > 1 else rows
    sent = rows.sparkSession.sparkContext.broadcast(model)
    whole = rows.withColumn("__x", vector_to_array("features", "float32"))
    schema = T.StructType([*rows.drop("features").schema.fields, T.StructField(out, T.DoubleType())])
    keep = [f.name for f in schema.fields[:-1]]

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(ln.score(sent.value, x))], names=schema.names)
    return whole.select(*keep, "__x").mapInArrow(run, schema)


def search(train: DataFrame, names: Sequence[str], folds: int = 5, oversample: bool = False, grids: dict | None = None) -> tuple[DataFrame, DataFrame, dict[str, dict]]:
    """(scores of every fit, the best point per model, the models fitted at it) for ``train`` rows with row_id, label,
    fold and features."""
    spark = train.sparkSession
    sample = gather(train, folds, oversample)
    scores = fold_scores(spark, sample, names, folds, grids)
    best = best_points(scores)
    chosen = [(r["model"], json.loads(r["params"])) for r in best.collect()]  # one row per model
    models = final_models(spark, sample, chosen)
    forget(spark, sample)
    return scores, best, models
