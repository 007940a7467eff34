"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

A first narrow pass stores (doc_id, SHA-256 of the text).  Misra-Gries counters (Spark's frequent
items aggregate, at most ``1 / support`` digests) name every digest that holds more than ``support``
of the rows.  Their exact winners and sizes come from one map-side combined aggregate, are verified
counts and not estimates, and are at most ``1 / support`` rows, so they are broadcast: copies of a
frequent text are settled where they are read.  All other digests hold at most ``support`` of the
rows each and go through an ordinary shuffle.

Defined cases: a null text counts as the empty text; a null doc_id is smaller than any other; of
rows that agree in text and doc_id exactly one is kept; an empty table gives an empty result; other
columns of the input are neither read nor able to clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def heavy_winners(rows: DataFrame, support: float) -> DataFrame:
    """(digest, keep_id, group_size) of the digests that Misra-Gries finds; at most 1 / support rows."""
    found = rows.select(F.hex("digest").alias("h")).stat.freqItems(["h"], support)
    candidates = found.select(F.explode("h_freqItems").alias("h")).select(F.unhex("h").alias("digest"))
    return staged(rows.join(F.broadcast(candidates), "digest").groupBy("digest")
                  .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "heavy-digests")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 support: float = 0.001) -> DataFrame:
    """One row per input row: doc_id, keep_id (largest doc_id of the equal texts), group_size, kept,
    text_sha256."""
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), digest_of(F.col(text_col)).alias("digest")), "digests")
    winners = heavy_winners(rows, support)
    first = F.row_number().over(Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())) == 1
    same = Window.partitionBy("digest")
    light = rows.join(F.broadcast(winners), "digest", "left_anti").select(
        "doc_id", "digest", F.max("doc_id").over(same).alias("keep_id"),
        F.count("*").over(same).alias("group_size"), first.alias("kept"))
    heavy = rows.join(F.broadcast(winners), "digest")
    at_top = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    copies = heavy.where(~at_top).withColumn("kept", F.lit(False))
    tops = heavy.where(at_top).withColumn("kept", first)
    return (light.unionByName(copies).unionByName(tops)
            .select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      support: float = 0.001) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_groups` keeps.

    Copies of frequent texts are removed map-side; what is left is dealt by digest once."""
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), digest_of(F.col(text_col)).alias("digest")), "digests")
    winners = heavy_winners(rows, support).select("digest", F.col("keep_id"), F.lit(True).alias("heavy"))
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("doc_id"),
                        digest_of(F.col(text_col)).alias("digest"))
    left = (whole.join(F.broadcast(winners), "digest", "left")
            .where(F.col("heavy").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())
    return (left.select("row", "digest", F.row_number().over(order).alias("nth"))
            .where("nth = 1").select("row.*"))
