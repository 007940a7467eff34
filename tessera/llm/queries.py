"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@query("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op9_exact_dedup(spark, sf_dir):
    from tessera.llm.exact_dedup import exact_groups
    return exact_groups(read(spark, sf_dir, "documents"))


@query("op5_virtual_slot_shards")
def op5_virtual_slot_shards(spark, sf_dir):
    from tessera.llm.sharding import shard_by_bytes
    out = shard_by_bytes(read(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                      "virtual_slot", "map_version")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op8_histogram_packing")
def op8_histogram_packing(spark, sf_dir):
    from tessera.llm.packing import pack_documents
    packed = pack_documents(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op3_quality_discriminant")
def op3_quality_discriminant(spark, sf_dir):
    from tessera.llm.quality import score_quality
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_toxicity_nnpu")
def op2_toxicity_nnpu(spark, sf_dir):
    from tessera.llm.toxicity import score_toxicity
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_projection_forest")
def op4_projection_forest(spark, sf_dir):
    from tessera.llm.embedding_dedup import near_vectors
    return near_vectors(read(spark, sf_dir, "embeddings"))


@query("op7_order_minhash")
def op7_order_minhash(spark, sf_dir):
    from tessera.llm.order_minhash import near_copies
    return near_copies(read(spark, sf_dir, "documents")).drop("node")


@query("op6_capture_index")
def op6_capture_index(spark, sf_dir):
    from tessera.llm.warc import archive_and_read
    back = archive_and_read(read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_sentencepiece")
def op10_sentencepiece(spark, sf_dir):
    from tessera.llm.sentencepieces import encode_documents
    return encode_documents(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op1_pseudo_likelihood")
def op1_pseudo_likelihood(spark, sf_dir):
    from tessera.llm.lm_scoring import score_documents
    return score_documents(read(spark, sf_dir, "documents"))


#: The rules of op12: host, path prefix and verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op12_url_rules", f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
urls AS (SELECT row_number() OVER () AS row_no, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
fits AS (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST, length(rule_host) DESC) AS nth
         FROM urls LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE nth = 1""")
def op12_url_rules(spark, sf_dir):
    from tessera.llm.url_rules import judge_urls
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages"), rules)


def _repair_sql() -> str:
    """op13 as SQL: the automaton's costs, audits and lines by recursion from a conversation's last row."""
    def made(cost, letter, line, to):
        lines = f"list_prepend({line}, {to}.lines)" if line else f"{to}.lines"
        return f"{{'cost': {to}.cost + {cost}, 'audit': '{letter}' || {to}.audit, 'lines': {lines}}}"
    never = "{'cost': 1000000000, 'audit': '', 'lines': CAST([] AS VARCHAR[])}"
    to = {0: 2, 1: 2, 2: 3, 3: 2}
    keeps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    role = {2: "user", 3: "assistant"}

    def edits(q):
        kept = " ".join(f"WHEN initial = '{i}' THEN {made('late', 'K', 'line', f'b{t}')}" for i, t in keeps[q].items())
        again = made("2 + late", "R", f"'{role[to[q]]}:' || text", f"b{to[q]}")
        own = [made("3", "D", "", f"b{q}"), f"CASE WHEN gone THEN {never} {kept} ELSE {never} END", f"CASE WHEN gone THEN {never} ELSE {again} END"]
        return f"list_sort([{', '.join(own)}])[1] AS w{q}"

    def inserts(q, behind):
        added = made("2", "I", f"'{role[to[q]]}:'", behind)
        return f"list_sort([w{q}, {added}])[1] AS b{q}"
    none = "CAST([] AS VARCHAR[])"
    base = (f"{{'cost': 0, 'audit': '', 'lines': {none}}} AS b0, {{'cost': 4, 'audit': 'II', 'lines': ['user:', 'assistant:']}} AS b1, "
            f"{{'cost': 2, 'audit': 'I', 'lines': ['assistant:']}} AS b2, {{'cost': 0, 'audit': '', 'lines': {none}}} AS b3")
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (SELECT * EXCLUDE (k), xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 20 AS kind FROM keyed, table_of),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER c AS i, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS initial, rtrim(text, {blanks}) AS shown,
                  lag(left(role, 1)) OVER c AS before, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
           FROM hurt WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
faults AS (SELECT *, shown = '' AS blank, shown <> '' AND nth > 1 AS duplicate, shown <> '' AND nth = 1 AND right(shown, 1) NOT IN ('.', '!', '?') AS truncated FROM placed),
steps AS (SELECT conv_id, i, n, initial, text, role || ':' || text AS line, blank OR duplicate AS gone, CAST(truncated AS INTEGER) AS late FROM faults),
costs AS (
  SELECT conv_id, max(n) + 1 AS i, {base} FROM steps GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, {inserts(0, "b2")}, {inserts(1, "b2")}, b2, b3 FROM (
    SELECT conv_id, i, w0, w1, {inserts(2, "w3")}, {inserts(3, "w2")} FROM (
      SELECT s.conv_id, s.i, {", ".join(edits(q) for q in range(4))}
      FROM costs JOIN steps s ON costs.conv_id IS NOT DISTINCT FROM s.conv_id AND costs.i = s.i + 1))),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                count(*) FILTER (truncated) AS truncated, count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(b0.cost, 0) AS BIGINT) AS cost, coalesce(b0.audit, '') AS audit,
       sha256(coalesce(array_to_string(b0.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums ON o.conv_id IS NOT DISTINCT FROM sums.conv_id
LEFT JOIN costs ON o.conv_id IS NOT DISTINCT FROM costs.conv_id AND costs.i = 1"""


@query("op13_conversation_repair", _repair_sql())
def op13_conversation_repair(spark, sf_dir):
    from tessera.llm.conversation_repair import repair_damaged
    return repair_damaged(read(spark, sf_dir, "conversations"))


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    from tessera.llm.token_alignment import align_documents
    return align_documents(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
