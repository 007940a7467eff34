"""Rounds and tasks of the iterative jobs, on rows built here."""

from __future__ import annotations

import random

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import allocation as al
from tessera.operators import features as fe
from tessera.operators import ml
from tessera.operators import search as se
from tessera.operators import tuning
from tessera.session import checkpoint


def _instance(spark, n: int = 400):
    """Large and small items in turn, so that the greedy skips and takes again many times."""
    rnd = random.Random(3)
    items = [(p, k, 10_000 * n - 10_000 * k) for p in (1, 2) for k in range(n)]
    amounts = {(p, r, k): rnd.choice([0, 1, 2, 60, 90]) for p in (1, 2) for r in range(3) for k in range(n)}
    capacity = {(p, r): 900 + 100 * r + p for p in (1, 2) for r in range(3)}
    return (spark.createDataFrame(items, "problem int, item long, profit long"),
            spark.createDataFrame([(p, r, k, a) for (p, r, k), a in amounts.items() if a], "problem int, resource int, item long, amount long"),
            spark.createDataFrame([(p, r, f"r{r}", c) for (p, r), c in capacity.items()], "problem int, resource int, name string, capacity long"),
            items, amounts, capacity)


def test_greedy_rounds_do_not_follow_rejections(spark, monkeypatch):
    items, cons, res, rows, amounts, left = _instance(spark)
    want, skipped = set(), 0
    for p, k, _ in sorted(rows, key=lambda t: (t[0], -t[2], t[1])):
        own = [amounts[p, r, k] for r in range(3)]
        if all(a <= left[p, r] for r, a in enumerate(own)):
            want.add((p, k))
            left.update({(p, r): left[p, r] - a for r, a in enumerate(own)})
        else:
            skipped += 1
    rounds = []
    plain = al.prefix_greedy
    monkeypatch.setattr(al, "prefix_greedy", lambda *a: rounds.append(1) or plain(*a))
    got = al.greedy_select(items, cons, res, block=150).collect()
    assert {(r["problem"], r["item"]) for r in got} == want and len(got) == len(want)
    assert skipped > 20 and len(rounds) <= 3  # one rejection a round before


def test_items_in_order_of_a_block():
    items = [1, 2, 3, 4, 5]
    assert al.take_in_order(items, [1] * 5, [[6, 0], [5, 1], [3, 1], [2, 0], [0, 1]], [10, 2]) == [True, False, True, False, True]
    # listed twice: charged four times its amount each until the next rejection, decided once
    assert al.take_in_order([1, 1, 2], [2, 2, 1], [[1], [1], [5]], [9]) == [True, True, False]


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(ml, "LEAST_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 4000, 1, 1).select(F.col("id").alias("row_id"))
    got = ml.spread(rows)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == cores and max(sizes) < 2 * min(sizes)  # one partition before
    assert sorted(r["row_id"] for r in got.collect()) == list(range(4000))
    few = spark.range(0, 150, 1, 1).select(F.col("id").alias("row_id"))
    assert ml.spread(few).rdd.getNumPartitions() == 1


def test_class_weights_leave_rows_where_they_are(spark):
    rows = spark.range(0, 2000, 1, 8).select("id", (F.col("id") % 100 == 0).cast("double").alias("label"))
    got = fe.balanced_weights(rows, "label")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) == 250
    assert {(r["label"], round(r["weight"], 6)) for r in got.select("label", "weight").distinct().collect()} == {(0.0, round(2000 / (2 * 1980), 6)), (1.0, 50.0)}


def _population(spark, n: int = 2000):
    loci = spark.range(0, n, 1, 1).select(F.lit(1).alias("problem"), F.col("id").alias("item"), F.col("id").alias("pos"), F.lit(n).cast("long").alias("n_items"))
    runs = se.make_runs(loci, [{"pop_size": 7, "crossover_rate": 0.7, "mutation_rate": 0.01}, {"pop_size": 4, "crossover_rate": 0.0, "mutation_rate": 0.01}])
    return loci, checkpoint(runs)


def test_chromosomes_are_drawn_in_many_tasks(spark):
    loci, runs = _population(spark)
    pop = se.population_init(runs, loci)
    sizes = [r["count"] for r in pop.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 3 and sum(sizes) == 11 * 2000  # one task before
    assert pop.select("run", "chrom", "pos").distinct().count() == 11 * 2000


def test_children_are_cut_from_their_parents_in_place(spark):
    loci, runs = _population(spark)
    pop = checkpoint(se.population_init(runs, loci).repartition(3, "run", "chrom"))
    parents = spark.createDataFrame([(f"1:{g}", k, t, (3 * k + t) % (7, 4)[g]) for g, pairs in ((0, 4), (1, 2)) for k in range(pairs) for t in (0, 1)],
                                    "run string, pair int, slot int, chrom int")
    kids = se.crossover(pop, parents, runs, 0, 4)
    assert kids.rdd.getNumPartitions() == 3  # the population was shuffled twice before
    bits = {(r["run"], r["chrom"], r["pos"]): r["bit"] for r in pop.collect()}
    draw = parents.select("run", "pair").distinct().select("run", "pair", se.hash_uniform(4, F.lit(0), "run", "pair", F.lit("c")).alias("c"),
                                                           se.hash_uniform(4, F.lit(0), "run", "pair", F.lit("p")).alias("p")).collect()
    draw = {(r["run"], r["pair"]): (r["c"], int(r["p"] * 1998) + 1) for r in draw}
    got = kids.collect()
    assert len(got) == 11 * 2000 and any(c < 0.7 for (run, _), (c, _) in draw.items() if run == "1:0")
    for r in got:
        g, pair = int(r["run"][2:]), r["chrom"] // 2
        side, (c, point) = r["chrom"] % 2, draw[r["run"], pair]
        other = c < (0.7, 0.0)[g] and r["pos"] >= point
        source = (3 * pair + (side ^ other)) % (7, 4)[g]
        assert r["bit"] == bits[r["run"], source, r["pos"]]


def test_scored_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(ml, "LEAST_ROWS", 100)
    rows = spark.range(0, 2000, 1, 1).select(F.col("id").alias("row_id"), array_to_vector(F.array(F.col("id") / 1000)).alias("features"))
    got = tuning.apply(rows, {"kind": "logistic", "weights": np.array([2.0, -1.0])})
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)  # one task before
    assert all(abs(r["score"] - 1 / (1 + np.exp(1 - r["row_id"] / 500))) < 1e-6 for r in got.collect())
