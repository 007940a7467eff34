"""Resource-allocation analytics on long tables.

Tables (all keyed by ``problem``):
  items(problem, item, category, profit)
  resources(problem, resource, name, unit, capacity)
  consumption(problem, resource, item, amount)     -- absent pairs mean 0
Every operator is a join / aggregate on (problem, item) or (problem, resource);
resource tables have a handful of rows per problem.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import ordinal, prefix_sums
from tessera.session import ship_package
from tessera.sources.fixtures import (RESOURCE_NAMES_5, RESOURCE_NAMES_10, RESOURCE_UNITS_5,
                                      RESOURCE_UNITS_10, SKU_CATEGORIES, SKU_SERIES)

P = "problem"


# ------------------------------------------------------------ scalar columns
def sku_from_index(i) -> Column:
    """SKU by index arithmetic: category i mod 5, series (i div 20) mod 5,
    number (i mod 20) + 1, e.g. ``Widget-A01``."""
    i = F.col(i) if isinstance(i, str) else i
    cats = F.array(*[F.lit(c) for c in SKU_CATEGORIES])
    series = F.array(*[F.lit(s) for s in SKU_SERIES])
    cat = F.element_at(cats, (F.pmod(i, F.lit(5)) + 1).cast("int"))
    ser = F.element_at(series, (F.pmod(F.floor(i / 20), F.lit(5)) + 1).cast("int"))
    return F.format_string("%s-%s%02d", cat, ser, (F.pmod(i, F.lit(20)) + 1).cast("int"))


def synthesize_items(items: DataFrame) -> DataFrame:
    """Add ``sku`` (by 0-based position of the item in its problem) and the
    SKU category (text before '-').  Position is computed skew-safely."""
    x = ordinal(items, by=[P], order=["item"], bucket=F.floor(F.col("item") / 4096), name="__pos")
    return x.withColumn("sku", sku_from_index("__pos")) \
            .withColumn("sku_category", F.split_part("sku", F.lit("-"), F.lit(1))).drop("__pos")


def resource_dim(resources: DataFrame) -> DataFrame:
    """Resource names/units chosen by the number of resources of the
    problem (5, 10, otherwise generic ``Resource_<k>`` / ``units``)."""
    m = F.count(F.lit(1)).over(Window.partitionBy(P))
    r1 = (F.col("resource") + 1).cast("int")
    n5 = F.array(*[F.lit(x) for x in RESOURCE_NAMES_5])
    n10 = F.array(*[F.lit(x) for x in RESOURCE_NAMES_10])
    u5 = F.array(*[F.lit(x) for x in RESOURCE_UNITS_5])
    u10 = F.array(*[F.lit(x) for x in RESOURCE_UNITS_10])
    x = resources.withColumn("__m", m)
    return x.withColumns({
        "name": F.when(F.col("__m") == 5, F.element_at(n5, r1)).when(F.col("__m") == 10, F.element_at(n10, r1))
                 .otherwise(F.concat(F.lit("Resource_"), r1.cast("string"))),
        "unit": F.when(F.col("__m") == 5, F.element_at(u5, r1)).when(F.col("__m") == 10, F.element_at(u10, r1))
                 .otherwise(F.lit("units")),
    }).drop("__m")


def utilization_band(pct) -> Column:
    """P20: >100 red, >80 orange, else green."""
    pct = F.col(pct) if isinstance(pct, str) else pct
    return F.when(pct > 100, "red").when(pct > 80, "orange").otherwise("green")


def gap_label(gap) -> Column:
    """<1 EXCELLENT, <5 GOOD, else FAIR."""
    gap = F.col(gap) if isinstance(gap, str) else gap
    return F.when(gap < 1, "EXCELLENT").when(gap < 5, "GOOD").otherwise("FAIR")


# ---------------------------------------------------------------- shaping
def densify(items: DataFrame, resources: DataFrame, consumption: DataFrame) -> DataFrame:
    """Every (item, resource) of a problem with a 0 for absent pairs."""
    grid = items.select(P, "item", "profit").join(resources.select(P, "resource", "name", "capacity"), P)
    c = consumption.select(P, "item", "resource", "amount")
    return grid.join(c, [P, "item", "resource"], "left").withColumn("amount", F.coalesce("amount", F.lit(0)).cast("bigint"))


def wide_items(items: DataFrame, consumption: DataFrame, resources: DataFrame) -> DataFrame:
    """One ``Consumes_<name>`` column per resource plus the row total."""
    names = [r["name"] for r in resources.select("name").distinct().orderBy("name").collect()]
    c = consumption.join(resources.select(P, "resource", "name"), [P, "resource"])
    wide = c.groupBy(P, "item").pivot("name", names).agg(F.sum("amount"))
    cols = {f"Consumes_{n}": F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("bigint") for n in names}
    x = items.join(wide, [P, "item"], "left").withColumns(cols).drop(*names)
    total = sum((F.col(f"`Consumes_{n}`") for n in names), F.lit(0).cast("bigint"))
    return x.withColumn("Total_Resource_Consumption", total)


# ------------------------------------------------------------- validation
def check_missing(items: DataFrame, resources: DataFrame) -> DataFrame:
    """K1: NULL profits and capacities per problem."""
    a = items.groupBy(P).agg(F.sum(F.col("profit").isNull().cast("long")).alias("null_profit"))
    b = resources.groupBy(P).agg(F.sum(F.col("capacity").isNull().cast("long")).alias("null_capacity"))
    return a.join(b, P, "full").fillna(0, ["null_profit", "null_capacity"])


def check_negative(items: DataFrame, resources: DataFrame) -> DataFrame:
    """K2: negative profits and capacities per problem."""
    a = items.groupBy(P).agg(F.sum((F.col("profit") < 0).cast("long")).alias("neg_profit"))
    b = resources.groupBy(P).agg(F.sum((F.col("capacity") < 0).cast("long")).alias("neg_capacity"))
    return a.join(b, P, "full").fillna(0, ["neg_profit", "neg_capacity"])


def check_dimensions(items: DataFrame, declared: DataFrame) -> DataFrame:
    """K3: item count against the declared ``n_items`` of each problem."""
    n = items.groupBy(P).agg(F.count(F.lit(1)).alias("n_found"))
    return declared.select(P, "n_items").join(n, P, "left") \
        .withColumn("n_found", F.coalesce("n_found", F.lit(0))) \
        .withColumn("ok", F.col("n_found") == F.col("n_items"))


def infeasible_items(consumption: DataFrame, resources: DataFrame, capacity: str = "capacity") -> DataFrame:
    """K4: items whose amount exceeds a capacity on its own, with the violated
    resource names in resource order (at most m names per item)."""
    c = consumption.join(resources.select(P, "resource", "name", F.col(capacity).alias("__cap")), [P, "resource"])
    v = c.filter(F.col("amount") > F.col("__cap"))
    g = v.groupBy(P, "item").agg(F.array_sort(F.collect_list(F.struct("resource", "name"))).alias("__v"))
    return g.select(P, "item", F.transform("__v", lambda s: s["name"]).alias("violations"),
                    F.size("__v").alias("n_violations"))


DOMINANCE_ROWS = 1 << 19  # items of a side in one task
DOMINANCE_SIDES = 6       # sides at least, so that also a small table spreads over tasks
DOMINANCE_BOX = 2048


def _dominance_boxes(x: np.ndarray) -> list[np.ndarray]:
    """Rows in boxes of at most ``DOMINANCE_BOX``, halved at the medians of the columns in turn."""
    todo, out = [(np.arange(len(x)), 0)], []
    while todo:
        own, c = todo.pop()
        if len(own) <= DOMINANCE_BOX:
            out.append(own)
            continue
        cut = np.argpartition(x[own, c], len(own) // 2)
        todo += [(own[part], (c + 1) % x.shape[1]) for part in (cut[:len(own) // 2], cut[len(own) // 2:])]
    return out


def count_dominated(a: np.ndarray, b: np.ndarray, strict: Sequence[bool]) -> int:
    """Pairs (row of a, row of b) with a < b in the strict columns and a <= b in the others.

    Boxes that cannot meet are skipped and columns that all pairs of two boxes meet are left out; for the others a
    box of b holds, per column, the set of its rows from each place of the column's order on as bits, and a row of
    a intersects one such set per column."""
    if not len(a) or not len(b):
        return 0
    strict, total = np.array(strict), 0
    ours = [a[own] for own in _dominance_boxes(a)]
    low, high = np.array([v.min(0) for v in ours]), np.array([v.max(0) for v in ours])
    for own in _dominance_boxes(b):
        v = b[own]
        least, most = v.min(0), v.max(0)
        some = np.where(strict, low < most, low <= most).all(1)
        sure = np.where(strict, high < least, high <= least)
        total += int(sum(len(ours[k]) for k in np.flatnonzero(sure.all(1)))) * len(v)
        order = np.argsort(v, axis=0, kind="stable")
        sets = {}
        for k in np.flatnonzero(some & ~sure.all(1)):
            rows = None
            for c in np.flatnonzero(~sure[k]):
                if c not in sets:
                    place = np.empty(len(v), np.int64)
                    place[order[:, c]] = np.arange(len(v))
                    packed = np.packbits(place >= np.arange(len(v) + 1)[:, None], axis=1)
                    wide = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
                    wide[:, :packed.shape[1]] = packed
                    sets[c] = v[order[:, c], c], wide.view(np.uint64)
                ordered, bits = sets[c]
                got = bits[np.searchsorted(ordered, ours[k][:, c], side="right" if strict[c] else "left")]
                rows = got if rows is None else np.bitwise_and(rows, got, out=rows)
            total += int(np.bitwise_count(rows).sum())
    return total


def dominated_pairs(items: DataFrame, consumption: DataFrame, resources: DataFrame,
                    symmetric: bool = False) -> DataFrame:
    """Count pairs (i, j), i < j (any order when ``symmetric``), with
    profit_i > profit_j and amount_i <= amount_j on every resource.

    A problem's items are dealt to sides of about ``DOMINANCE_ROWS`` by a hash, and every side meets every side in a
    task of its own (``count_dominated``), so a task's memory is bounded whatever the number of items.
    Only counts leave the tasks."""
    rids = [r["resource"] for r in resources.select("resource").distinct().orderBy("resource").collect()]
    wide = (densify(items, resources, consumption).groupBy(P, "item")
            .pivot("resource", rids).agg(F.first("amount")))
    acols = [f"a{k}" for k in range(len(rids))]
    wide = wide.toDF(P, "item", *acols).join(items.select(P, "item", "profit"), [P, "item"]).dropna(subset=["profit", *acols])
    sides = wide.groupBy(P).agg(F.greatest(F.lit(DOMINANCE_SIDES), F.ceil(F.count(F.lit(1)) / DOMINANCE_ROWS)).cast("int").alias("__sides"))
    wide = wide.join(sides, P).withColumn("__own", F.pmod(F.hash("item"), F.col("__sides")))
    every = F.explode(F.sequence(F.lit(0), F.col("__sides") - 1))
    met = wide.withColumnRenamed("__own", "__i").withColumns({"__j": every, "__first": F.lit(True)}).unionByName(
        wide.withColumnRenamed("__own", "__j").withColumns({"__i": every, "__first": F.lit(False)}))
    columns = [*acols, "profit"] + ([] if symmetric else ["item"])
    strict = [False] * len(acols) + [True] * (len(columns) - len(acols))

    ship_package(items.sparkSession)

    def count(key: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        first = own.column("__first").to_numpy(zero_copy_only=False)
        x = np.stack([own.column(c).to_numpy() * (-1 if c == "profit" else 1) for c in columns], axis=1)
        return pa.table({P: pa.array([key[0].as_py()], own.schema.field(P).type), "n": pa.array([count_dominated(x[first], x[~first], strict)], pa.int64())})
    # few bytes but much work: tasks are not to be merged by their size
    tasks = max(4 * items.sparkSession.sparkContext.defaultParallelism, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = met.repartition(tasks, P, "__i", "__j").groupBy(P, "__i", "__j").applyInArrow(count, items.select(P, F.lit(0).cast("long").alias("n")).schema)
    n = found.groupBy(P).agg(F.sum("n").alias("dominated_pairs"))
    return items.select(P).distinct().join(n, P, "left").fillna(0, ["dominated_pairs"])


def validate(items: DataFrame, resources: DataFrame, consumption: DataFrame, declared: DataFrame,
             capacity: str = "capacity") -> DataFrame:
    """K6: one row per check and problem; overall pass = missing, negative and
    dimension checks (infeasible items and dominance only warn)."""
    m = check_missing(items, resources)
    ng = check_negative(items, resources)
    dm = check_dimensions(items, declared)
    inf = infeasible_items(consumption, resources, capacity).groupBy(P).agg(F.count(F.lit(1)).alias("n"))
    dom = dominated_pairs(items, consumption, resources)
    rows = (m.select(P, F.lit("missing_values").alias("check"), (F.col("null_profit") + F.col("null_capacity")).alias("count"),
                     ((F.col("null_profit") + F.col("null_capacity")) == 0).alias("passed"), F.lit(False).alias("warn_only"))
            .unionByName(ng.select(P, F.lit("negative_values").alias("check"),
                                   (F.col("neg_profit") + F.col("neg_capacity")).alias("count"),
                                   ((F.col("neg_profit") + F.col("neg_capacity")) == 0).alias("passed"),
                                   F.lit(False).alias("warn_only")))
            .unionByName(dm.select(P, F.lit("dimensions").alias("check"), (F.col("n_found") - F.col("n_items")).alias("count"),
                                   F.col("ok").alias("passed"), F.lit(False).alias("warn_only")))
            .unionByName(declared.select(P).join(inf, P, "left").select(
                P, F.lit("infeasible_items").alias("check"), F.coalesce("n", F.lit(0)).alias("count"),
                (F.coalesce("n", F.lit(0)) == 0).alias("passed"), F.lit(True).alias("warn_only")))
            .unionByName(dom.select(P, F.lit("dominated_pairs").alias("check"), F.col("dominated_pairs").alias("count"),
                                    F.lit(True).alias("passed"), F.lit(True).alias("warn_only"))))
    overall = rows.groupBy(P).agg(F.bool_and(F.col("passed") | F.col("warn_only")).alias("all_passed"))
    return rows.join(overall, P).withColumn("count", F.col("count").cast("bigint"))


# ---------------------------------------------------------------- analysis
def capacity_analysis(items: DataFrame, consumption: DataFrame, resources: DataFrame) -> DataFrame:
    """K7: demand if every item were selected vs capacity: total, mean per
    item, utilization % (NULL when capacity is 0), band and flag."""
    n = items.groupBy(P).agg(F.count(F.lit(1)).alias("__n"))
    dem = consumption.groupBy(P, "resource").agg(F.sum("amount").alias("total_demand"))
    x = resources.join(dem, [P, "resource"], "left").join(n, P) \
        .withColumn("total_demand", F.coalesce("total_demand", F.lit(0)).cast("bigint"))
    util = F.try_divide(F.col("total_demand").cast("double"), F.col("capacity").cast("double")) * 100
    return x.select(P, "resource", "name", "capacity", "total_demand",
                    (F.col("total_demand") / F.col("__n")).alias("mean_demand"),
                    util.alias("utilization_pct"),
                    utilization_band(util).alias("band"),
                    F.coalesce(util > 100, F.lit(False)).alias("oversubscribed"))


def bottleneck(cap: DataFrame) -> DataFrame:
    """Resource with the largest utilization (first resource on ties)."""
    key = F.struct(F.col("utilization_pct").alias("u"), (-F.col("resource")).alias("r"),
                   F.col("name").alias("name"), F.col("resource").alias("resource"))
    return cap.groupBy(P).agg(F.max(key).alias("b")).select(
        P, F.col("b.resource").alias("resource"), F.col("b.name").alias("name"), F.col("b.u").alias("utilization_pct"))


def efficiency(items: DataFrame, resources: DataFrame, consumption: DataFrame) -> DataFrame:
    """K8: profit / amount for pairs with amount > 0."""
    d = densify(items, resources, consumption).filter(F.col("amount") > 0)
    return d.select(P, "item", "resource", "name", "profit", "amount",
                    (F.col("profit") / F.col("amount")).alias("efficiency"))


def efficiency_by_resource(eff: DataFrame) -> DataFrame:
    """K8: mean efficiency per resource."""
    return eff.groupBy(P, "resource", "name").agg(F.avg("efficiency").alias("mean_efficiency"))


def top_efficient(eff: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """K9 (+J5): k items with the highest mean efficiency, profit looked up by item id."""
    m = eff.groupBy(P, "item").agg(F.avg("efficiency").alias("mean_efficiency"))
    w = Window.partitionBy(P).orderBy(F.col("mean_efficiency").desc(), F.col("item").asc())
    top = m.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.join(items.select(P, "item", "profit"), [P, "item"])


def efficiency_eps(items: DataFrame, resources: DataFrame, consumption: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Profit / (amount + eps) over every item and resource."""
    d = densify(items, resources, consumption)
    return d.select(P, "item", "resource", "name",
                    (F.col("profit") / (F.col("amount") + F.lit(eps))).alias("efficiency"))


# -------------------------------------------------------------- selections
def prefix_greedy(items: DataFrame, consumption: DataFrame, resources: DataFrame) -> DataFrame:
    """One round of K11: items in profit-descending order (ties by item id);
    the longest prefix whose running usage fits every capacity.  Equal to the
    exact greedy up to its first rejection, not a whole solution."""
    d = densify(items, resources, consumption)
    # rank of the item in (profit desc, item asc) order, skew-safe
    key = items.select(P, "item", "profit")
    ranked = ordinal(key.withColumn("__np", -F.col("profit")), by=[P], order=["__np", "item"],
                     bucket=F.floor(-F.col("profit") / F.lit(1 << 12)), name="__rank")
    d = d.join(ranked.select(P, "item", "__rank"), [P, "item"])
    cum = prefix_sums(d.withColumn("__rb", F.floor(F.col("__rank") / 4096)), ["__rank"], ["amount"],
                      F.col("__rb"), by=[P, "resource"])
    ok = cum.withColumn("__fits", (F.col("amount_cum") <= F.col("capacity")).cast("int"))
    per_item = ok.groupBy(P, "item", "__rank").agg(F.min("__fits").alias("__fits"))
    first_bad = per_item.filter(F.col("__fits") == 0).groupBy(P).agg(F.min("__rank").alias("__stop"))
    sel = per_item.join(first_bad, P, "left").filter(
        F.col("__stop").isNull() | (F.col("__rank") < F.col("__stop")))
    return sel.select(P, "item")


GREEDY_BLOCK = 1 << 17  # items of a problem that one task decides one after another


def take_in_order(items: Sequence, copies: Sequence[int], amounts: Sequence[Sequence[int]], capacity: Sequence[int]) -> list[bool]:
    """The greedy on items in order.  An item listed several times is charged as ``prefix_greedy`` charges it, its
    listings squared, until the next rejection, and is decided once."""
    left = list(capacity)
    charged, used = [0] * len(left), [0] * len(left)
    gone, now, ended, taken = set(), set(), False, []
    for item, k, own in zip(items, copies, amounts):
        taken.append(False)
        if (k > 1 and item in gone) or any(a > c for a, c in zip(own, left)):
            continue
        if not ended and all(u + k * k * a <= c for u, a, c in zip(charged, own, left)):
            charged = [u + k * k * a for u, a in zip(charged, own)]
            used = [u + a for u, a in zip(used, own)]
            taken[-1] = True
            if k > 1:
                now.add(item)
        elif k > 1 and item in now:
            ended = True  # a listing of it is taken already: the next item is the one that is rejected
        else:
            left = [c - u for c, u in zip(left, used)]
            charged, used, ended = [0] * len(left), [0] * len(left), False
            gone |= now | ({item} if k > 1 else set())
            now = set()
    return taken


def greedy_block(todo: DataFrame, consumption: DataFrame, resources: DataFrame, rows: int) -> DataFrame:
    """(problem, item, taken): the greedy's decisions on the first ``rows`` items of each problem's order."""
    ranked = ordinal(todo.withColumn("__np", -F.col("profit")), by=[P], order=["__np", "item"],
                     bucket=F.floor(-F.col("profit") / F.lit(1 << 12)), name="__rank").filter(F.col("__rank") < rows)
    room = resources.select(P, "resource", F.coalesce("capacity", F.lit((1 << 63) - 1)).alias("capacity"))
    use = consumption.groupBy(P, "item", "resource").agg(F.sum("amount").alias("amount"))
    dense = ranked.select(P, "item", "copies", "__rank").join(room, P).join(use, [P, "item", "resource"], "left") \
        .withColumn("amount", F.coalesce("amount", F.lit(0)).cast("bigint"))

    ship_package(todo.sparkSession)

    def decide(own: pa.Table) -> pa.Table:
        own = own.sort_by([("__rank", "ascending"), ("resource", "ascending")])
        m = len(own.column("resource").unique())
        each = own.take(pa.array(np.arange(0, len(own), m)))
        amounts = own.column("amount").to_numpy().reshape(-1, m).tolist()
        taken = take_in_order(each.column("item").to_pylist(), each.column("copies").to_pylist(), amounts, own.column("capacity").to_pylist()[:m])
        return each.select([P, "item"]).append_column("taken", pa.array(taken, pa.bool_()))
    return dense.groupBy(P).applyInArrow(decide, todo.select(P, "item", F.lit(True).alias("taken")).schema)


def greedy_select(items: DataFrame, consumption: DataFrame, resources: DataFrame,
                  checkpoint_every: int = 4, block: int = GREEDY_BLOCK) -> DataFrame:
    """K11 exact: profit-descending greedy, an item is taken when it fits every
    remaining capacity, skipped otherwise.

    Each round (1) drops items that no longer fit on their own, (2) accepts the
    longest fitting prefix of the remaining order with ``prefix_greedy``, (3)
    rejects the first item that does not fit, (4) lowers the remaining
    capacities, (5) drops again, and (6) decides the next ``block`` items of each
    problem in one bounded task.  So the number of rounds is at most the items over
    ``block``, whatever the rejections, and identical decisions to the sequential
    greedy follow because capacities only shrink.  The driver holds only the loop state."""
    from tessera.session import checkpoint

    # inputs are rescanned every round: materialize them once (reliable checkpoint)
    res = checkpoint(resources.select(P, "resource", "name", F.col("capacity").cast("bigint").alias("capacity")))
    # items without key or profit have no place in the order: they are never taken
    todo = items.select(P, "item", "profit", F.count(F.lit(1)).over(Window.partitionBy(P, "item")).alias("copies")) \
        .filter(F.col("item").isNotNull() & F.col("profit").isNotNull())
    cons = checkpoint(consumption.select(P, "item", "resource", "amount"))

    def fitting(left: DataFrame, room: DataFrame) -> DataFrame:
        too_big = cons.join(left.select(P, "item"), [P, "item"]).join(room, [P, "resource"]) \
            .filter(F.col("amount") > F.col("capacity")).select(P, "item").distinct()
        return checkpoint(left.join(too_big, [P, "item"], "left_anti"))

    def lowered(room: DataFrame, taken: DataFrame) -> DataFrame:
        used = cons.join(taken, [P, "item"]).groupBy(P, "resource").agg(F.sum("amount").alias("__u"))
        return checkpoint(room.join(used, [P, "resource"], "left").withColumn(
            "capacity", (F.col("capacity") - F.coalesce("__u", F.lit(0))).cast("bigint")).drop("__u"))

    chosen = None
    rnd = 0
    while True:
        # (1) drop items that exceed a remaining capacity on their own
        todo = fitting(todo, res)
        if todo.isEmpty():
            break
        # (2) accept the longest prefix that fits
        acc = checkpoint(prefix_greedy(todo, cons.join(todo.select(P, "item"), [P, "item"]), res))
        # (3) the first item after the prefix does not fit -> reject it
        order = todo.join(acc, [P, "item"], "left_anti")
        first_left = order.groupBy(P).agg(F.max(F.struct(F.col("profit").alias("p"), (-F.col("item")).alias("ni")))
                                            .alias("__f"))
        reject = first_left.select(P, (-F.col("__f.ni")).alias("item"))
        chosen = acc if chosen is None else chosen.unionByName(acc)
        # (4), (5) lower the capacities, drop what is too big for them
        res = lowered(res, acc)
        todo = fitting(order.join(reject, [P, "item"], "left_anti"), res)
        if todo.isEmpty():
            break
        # (6) the next items of the order, one after another
        done = checkpoint(greedy_block(todo, cons, res, block))
        acc = done.filter("taken").select(P, "item")
        chosen = chosen.unionByName(acc)
        res = lowered(res, acc)
        todo = todo.join(done, [P, "item"], "left_anti")
        rnd += 1
        if rnd % checkpoint_every == 0:
            chosen = checkpoint(chosen)
    if chosen is None:
        return items.select(P, "item").limit(0)
    return chosen


def evaluate_selection(selection: DataFrame, items: DataFrame, consumption: DataFrame,
                       resources: DataFrame) -> DataFrame:
    """Per problem and resource: used, capacity, utilization % (0 when
    capacity is 0), satisfied; plus the problem's profit, item count and overall
    feasibility."""
    sel = selection.select(P, "item").distinct()
    prof = sel.join(items.select(P, "item", "profit"), [P, "item"]).groupBy(P).agg(
        F.sum("profit").alias("total_profit"), F.count(F.lit(1)).alias("n_selected"))
    used = sel.join(consumption, [P, "item"]).groupBy(P, "resource").agg(F.sum("amount").alias("used"))
    r = resources.select(P, "resource", "name", "capacity").join(used, [P, "resource"], "left") \
        .withColumn("used", F.coalesce("used", F.lit(0)).cast("bigint"))
    r = r.withColumn("utilization_pct", F.when(F.col("capacity") > 0, F.col("used") / F.col("capacity") * 100)
                     .otherwise(F.lit(0.0))) \
         .withColumn("satisfied", F.col("used") <= F.col("capacity"))
    feas = r.groupBy(P).agg(F.bool_and("satisfied").alias("feasible"))
    return r.join(prof, P, "left").join(feas, P).fillna(0, ["total_profit", "n_selected"])


def selected_items(selection: DataFrame, items: DataFrame, consumption: DataFrame,
                   resources: DataFrame) -> DataFrame:
    """Selected items with category, profit and a map resource name -> amount."""
    sel = selection.select(P, "item").distinct()
    c = sel.join(consumption, [P, "item"]).join(resources.select(P, "resource", "name"), [P, "resource"])
    usage = c.groupBy(P, "item").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "amount"))))
                                     .alias("resource_usage"))
    return sel.join(items, [P, "item"]).join(usage, [P, "item"], "left")


def compare_solutions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Solution a (heuristic) against b (reference): profit difference
    b - a, gap % (0 when b <= 0), absolute time difference, label.  Inputs:
    (problem, profit, seconds, n_selected)."""
    x = a.alias("a").join(b.alias("b"), P)
    diff = F.col("b.profit") - F.col("a.profit")
    gap = F.when(F.col("b.profit") > 0, diff / F.col("b.profit") * 100).otherwise(F.lit(0.0))
    return x.select(P, F.col("a.profit").alias("profit_a"), F.col("b.profit").alias("profit_b"),
                    F.col("a.n_selected").alias("n_selected_a"), F.col("b.n_selected").alias("n_selected_b"),
                    diff.cast("double").alias("profit_difference"), gap.alias("gap_pct"),
                    F.abs(F.col("b.seconds") - F.col("a.seconds")).alias("time_difference"),
                    gap_label(gap).alias("quality"))


def problem_summary(items: DataFrame, resources: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """Per-problem dimensions, mean/max profit, total capacity and the
    optimum × 1000 ('Unknown' when not positive)."""
    it = items.groupBy(P).agg(F.count(F.lit(1)).alias("n_items"), F.avg("profit").alias("avg_profit"),
                              F.max("profit").alias("max_profit"))
    rs = resources.groupBy(P).agg(F.count(F.lit(1)).alias("n_resources"), F.sum("capacity").alias("total_capacity"))
    x = it.join(rs, P)
    if declared is not None:
        opt = F.col("optimum")
        x = x.join(declared.select(P, "optimum"), P, "left").withColumn(
            "optimal_value", F.when(opt > 0, (opt * 1000).cast("string")).otherwise(F.lit("Unknown"))).drop("optimum")
    return x


def allocation_summary(items: DataFrame, consumption: DataFrame, resources: DataFrame) -> DataFrame:
    """Executive summary per problem: counts, categories, profit mean /
    CV / range, bottleneck, log10 of the search-space size (n · log10 2)."""
    it = items.groupBy(P).agg(
        F.count(F.lit(1)).alias("n_items"), F.count_distinct("category").alias("n_categories"),
        F.avg("profit").alias("profit_mean"), F.stddev_samp("profit").alias("profit_std"),
        F.min("profit").alias("profit_min"), F.max("profit").alias("profit_max"))
    it = it.withColumn("profit_cv_pct", F.col("profit_std") / F.col("profit_mean") * 100) \
           .withColumn("log10_search_space", F.col("n_items") * F.lit(math.log10(2)))
    nres = resources.groupBy(P).agg(F.count(F.lit(1)).alias("n_resources"))
    bn = bottleneck(capacity_analysis(items, consumption, resources)).select(
        P, F.col("name").alias("bottleneck"), F.col("utilization_pct").alias("bottleneck_utilization_pct"))
    return it.join(nres, P).join(bn, P, "left")

