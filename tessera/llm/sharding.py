"""Sharding over fixed virtual slots.

Every record hashes into one of ``slots`` virtual slots; one aggregate counts bytes and rows per slot.
A slot-to-shard map (``slots`` rows, a constant) is stored as a versioned table: version 1 deals the
slots round robin, and a rebalance edits single entries, moving or swapping slots between the
heaviest and the lightest shard until their sizes meet, which becomes the next version.  Records
never move between slots, so an edit moves only the slots it names.

Defined cases: a null text has size 1; null ids hash like any value together with the text's
checksum; an empty table gives an empty result and a map of empty slots; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import new_folder, staged

SLOTS = 4096
MAP_SCHEMA = "version int, slot int, shard int, bytes long, n_rows long"


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def slot_of(*cols: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(slots)).cast("int")


def rebalance(shard: np.ndarray, weight: np.ndarray, shards: int, max_edits: int | None = None) -> np.ndarray:
    """An edited copy of the map: while it helps, move the slot, or swap the pair of slots, that best
    halves the gap between the heaviest and the lightest shard.  Every edit strictly lowers the sum
    of squared shard sizes, so the loop ends."""
    shard = shard.copy()
    load = np.bincount(shard, weights=weight, minlength=shards)
    edits = 0
    while max_edits is None or edits < max_edits:
        done = True
        order = np.argsort(load, kind="stable")
        heavy = order[-1]
        for light in order[:-1]:
            gap = load[heavy] - load[light]
            if gap <= 1:
                break
            mine, theirs = np.flatnonzero(shard == heavy), np.flatnonzero(shard == light)
            mine, theirs = mine[weight[mine] > 0], np.append(theirs, -1)  # -1: a plain move
            back = np.where(theirs >= 0, weight[theirs], 0.0)
            rank = np.argsort(back, kind="stable")
            want = weight[mine] - gap / 2
            at = np.clip(np.searchsorted(back[rank], want), 0, len(rank) - 1)
            best = None
            for near in (at, np.maximum(at - 1, 0)):
                step = weight[mine] - back[rank[near]]
                ok = (step > 0) & (step < gap)
                if ok.any():
                    k = np.flatnonzero(ok)[np.argmin(np.abs(step[ok] - gap / 2))]
                    if best is None or abs(step[k] - gap / 2) < best[0]:
                        best = (abs(step[k] - gap / 2), mine[k], theirs[rank[near[k]]], step[k])
            if best is not None:
                _, out, into, step = best
                shard[out] = light
                if into >= 0:
                    shard[into] = heavy
                load[heavy] -= step
                load[light] += step
                edits += 1
                done = False
                break
        if done:
            break
    return shard


def grow(shard: np.ndarray, weight: np.ndarray, shards: int) -> np.ndarray:
    """A map for one more shard: slots move only into the new shard, heaviest shards give first."""
    shard = shard.copy()
    load = np.bincount(shard, weights=weight, minlength=shards + 1)
    goal = load.sum() / (shards + 1)
    for slot in np.argsort(-weight, kind="stable"):
        old = shard[slot]
        if old < shards and load[old] - weight[slot] >= goal * 0.98 and load[shards] + weight[slot] <= goal * 1.02:
            load[old] -= weight[slot]
            load[shards] += weight[slot]
            shard[slot] = shards
    return shard


def write_version(spark: SparkSession, path: str, version: int, shard: np.ndarray, size: np.ndarray,
                  rows: np.ndarray) -> None:
    """Add one version of the map to the versioned table at ``path``."""
    data = [(version, i, int(s), int(b), int(n)) for i, (s, b, n) in enumerate(zip(shard, size, rows))]
    (spark.createDataFrame(data, MAP_SCHEMA).coalesce(1).write.mode("append").partitionBy("version").parquet(path))


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map (default: the latest)."""
    table = spark.read.parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version).select("version", "slot", "shard", "bytes", "n_rows")


def slot_totals(records: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows per slot (``slots`` rows reach the driver, whatever the input)."""
    size, rows = np.zeros(slots), np.zeros(slots)
    for r in records.groupBy("slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r["slot"]], rows[r["slot"]] = r["b"], r["n"]
    return size, rows


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard, position (gapless from 0 in its shard), map_version.

    Shards get nearly equal bytes.  The map's versions stay at ``map_path``."""
    spark = docs.sparkSession
    text = F.col(text_col)
    records = staged(docs.select(
        F.col(id_col).alias("doc_id"), text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
        .withColumn("slot", slot_of(F.col("doc_id"), F.col("text_crc32"), F.col("size"), slots=slots)), "sizes")
    size, rows = slot_totals(records, slots)
    path = map_path or new_folder(spark, "slot-map")
    first = np.arange(slots) % shards
    write_version(spark, path, 1, first, size, rows)
    write_version(spark, path, 2, rebalance(first, size, shards), size, rows)
    current = read_version(spark, path)
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = current.select("version", "slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("slot").orderBy("doc_id", "text_crc32", "size")) - 1
    # the map has ``slots`` rows: a constant bound for the broadcast
    return (records.withColumn("nth", nth).join(F.broadcast(starts), "slot")
            .select("doc_id", "size", "text_crc32", F.col("slot").alias("virtual_slot"), "shard",
                    (F.col("start") + F.col("nth")).cast("long").alias("position"), F.col("version").alias("map_version")))
