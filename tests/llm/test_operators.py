"""Training-data operators against brute force, on awkward rows and on empty tables."""

import base64
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import (embedding_dedup, exact_dedup, lm_scoring, order_minhash, packing, quality, queries, sentencepieces,
                         sharding, toxicity, warc)
from tessera.llm import text as tx
from tessera.llm.common import connected_components, staged

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
WORD_BPE = queries.tokenizer_path("word_bpe_49k.json")
PIECES = queries.tokenizer_path("piece_bpe_32k.model")
EXTRA = "digest string, `row` int, key long, node long, score double, x int, kept boolean, block int, length int, sketch int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "er", "th", "ou", "in", "st"]) for _ in range(r.randint(1, 4))) for _ in range(n)) + "."


def awkward_rows():
    base = prose(1)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", "", "   \n\t", "!!! ???", "a", base, base, base, " ".join(near), prose(2), prose(3, 30_000),
             "it's <|endoftext|> ÀÉ é ́x ΑΣ 日本 \x00 ▁x", prose(4) + "\n\n" + prose(5), "é " * 7, "one two three four"]
    rows = [(i, t, None, None if i % 3 else "s", None if t is None else len(t), *([None] * 10)) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, base, *([None] * 13)), (None, None, *([None] * 13)), (10, prose(6), *([None] * 13))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1 if i % 2 else 0, 1 if i % 4 == 0 else 0) for i in range(12)] + [(None, 1, 1), (3, None, None), (6, 0, 1), (6, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# --- exact copies -----------------------------------------------------------------------------------

@pytest.mark.parametrize("support", [0.001, 0.2])
def test_exact_groups_equal_brute_force(docs, support):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = exact_dedup.exact_groups(docs, support=support).collect()
    assert len(got) == len(rows)
    by = {}
    for i, t in rows:
        by.setdefault(t, []).append(-1 if i is None else i)
    for t, ids in by.items():
        own = [r for r in got if r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()]
        keep = None if max(ids) < 0 else max(ids)
        assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in own) == sorted(ids)
        assert {(r["keep_id"], r["group_size"]) for r in own} == {(keep, len(ids))}
        assert [r["doc_id"] for r in own if r["kept"]] == [keep]


def test_exact_filter_keeps_one_row_per_text_and_all_columns(docs, none):
    kept = exact_dedup.drop_exact_copies(docs, support=0.2)
    assert kept.columns == docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r["text"] or "" for r in docs.collect()})
    assert exact_dedup.drop_exact_copies(none).count() == 0 == exact_dedup.exact_groups(none).count()


# --- sharding ---------------------------------------------------------------------------------------

def test_shards_are_even_and_positions_gapless(spark, docs, none):
    got = sharding.shard_by_bytes(queries.read(spark, SF_MID, "documents")).toPandas()
    load = got.groupby("shard")["size"].sum()
    assert len(load) == 16 and load.max() - load.min() <= 2
    for _, own in got.groupby("shard")["position"]:
        assert sorted(own) == list(range(len(own)))
    odd = sharding.shard_by_bytes(docs, shards=3).collect()
    assert sorted(r["size"] for r in odd) == sorted(len((r["text"] or "").encode()) + 1 for r in docs.collect())
    assert sorted(r["text_crc32"] for r in odd) == sorted(zlib.crc32((r["text"] or "").encode()) for r in docs.collect())
    assert sharding.shard_by_bytes(none).count() == 0


def test_slot_map_versions_and_growth(spark, tmp_path):
    rng = np.random.default_rng(1)
    weight, first = rng.pareto(1.5, 500) * 1000, np.arange(500) % 8
    second = sharding.rebalance(first, weight, 8)
    before, after = (np.bincount(m, weights=weight, minlength=8) for m in (first, second))
    assert np.ptp(after) < np.ptp(before) and after.max() <= max(weight.max(), weight.sum() / 8 * 1.01)
    grown = sharding.grow(second, weight, 8)
    assert set(grown[grown != second]) <= {8} and (grown == 8).any()
    path = str(tmp_path / "map")
    for v, m in enumerate((first, second, grown), 1):
        sharding.write_version(spark, path, v, m, weight, np.ones(500))
    assert [r["shard"] for r in sharding.read_version(spark, path, 2).orderBy("slot").collect()] == second.tolist()
    assert {r["version"] for r in sharding.read_version(spark, path).collect()} == {3}


# --- archives ---------------------------------------------------------------------------------------

def test_archives_round_trip_through_the_index(spark, tmp_path):
    rows = [(1, "http://www.Example.com:80/a?b=1#f", "same"), (2, "https://b.example.com/x", "same"), (3, None, None), (4, "", ""),
            (5, "http://b.example.com/x", "é日本\r\n\r\nWARC/1.1"), (None, "http://b.example.com/x", "same"), (7, "http://b.example.com/x", "x" * 300_000),
            (2, "https://b.example.com/x", "same"), (1, "http://www.Example.com:80/a?b=1#f", "same")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    captures = warc.write_archives(pages, str(tmp_path / "a"))
    warc.write_index(captures, str(tmp_path / "i"), block_lines=2)
    got = warc.lookup(warc.keyed(pages), str(tmp_path / "i"), str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    for page, _, html in set(rows):
        raw = (html or "").encode()
        own = [r for r in got if r["page_id"] == page]
        assert {(r["payload_digest"], r["payload_bytes"]) for r in own} == {(base64.b32encode(hashlib.sha1(raw).digest()).decode(), len(raw))}
        assert all(bytes(r["payload"]) == raw for r in own if r["record_type"] == "response")
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got)
    assert kinds == sorted([("1", "response", None), ("1", "revisit", 1), ("2", "revisit", 1), ("2", "revisit", 1), ("3", "response", None),
                            ("4", "revisit", 3), ("5", "response", None), ("7", "response", None), ("None", "response", None)])
    ix = warc.Index(str(tmp_path / "i"))
    key = warc.url_key("http://b.example.com/x")
    assert key == "com,example,b)/x"
    assert [c[0] for c in ix.captures(key)] == [2, 2, 5, 7, None]
    assert [c[0] for c in ix.captures("com,example)/nothing")] == []


def test_index_search_equals_a_scan(spark, tmp_path):
    r = random.Random(5)
    rows = [(r.choice(["a)/", "b)/", "c)/x", "c)/y"]), r.randint(0, 30), "f", i, 1) for i in range(400)]
    table = spark.createDataFrame(rows, "url_key string, page_id long, file string, offset long, length long")
    warc.write_index(table, str(tmp_path / "i"), block_lines=7)
    ix = warc.Index(str(tmp_path / "i"))
    for key in ("a)/", "b)/", "c)/x", "c)/y", "", "z"):
        assert sorted(c[2] for c in ix.captures(key)) == sorted(x[3] for x in rows if x[0] == key)
        for page in range(0, 31, 5):
            assert sorted(c[2] for c in ix.captures(key, page, any_page=False)) == sorted(x[3] for x in rows if x[:2] == (key, page))


def test_no_pages(spark):
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- packing ----------------------------------------------------------------------------------------

def test_packing_holds_every_id_once(docs, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD_BPE)
    packed = staged(packing.pack_documents(docs, WORD_BPE, with_ids=True), "packed")
    got = packed.collect()
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in docs.collect())
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 2048
    single = {i for i, _ in want if [x[0] for x in want].count(i) == 1}
    for i, ids in want:
        if i in single:
            own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
            assert [t for r in own for t in r["ids"]] == ids and {r["doc_tokens"] for r in own} == {len(ids)}
    assert sum(r["length"] for r in got) == sum(len(ids) for _, ids in want)
    by = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == by.get(r["sequence_id"], 0)
        by[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(by) == list(range(len(by))) and max(by.values()) <= 2048
    for r in packing.sequences(packed).collect():
        n = by[r["sequence_id"]]
        assert r["n_tokens"] == n and len(r["ids"]) == (n if n & (n - 1) == 0 else 2048)
    assert packing.pack_documents(none, WORD_BPE).count() == 0


def test_a_worker_holds_one_model_and_gives_it_back_to_other_operators():
    whole, cache = packing.word_cache(WORD_BPE)
    assert packing.word_cache(WORD_BPE)[1] is cache
    tx.release(WORD_BPE)
    assert packing.word_cache(WORD_BPE)[1] is cache
    ids, begin = packing.token_ids(pa.array(["plain words, Other Words", None, "plain don't"], pa.large_string()), (whole, cache))
    texts = ["plain words, Other Words", "", "plain don't"]
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [whole.encode(x, add_special_tokens=False).ids + [1] for x in texts]
    tx.release()
    assert not tx.HELD and packing.word_cache(WORD_BPE)[1] is not cache
    tx.release()


def test_texts_reach_the_tokenizer_in_batches_of_bounded_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(packing, "staged", lambda df, name: seen.append(
        int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))) or staged(df, name))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    assert packing.pack_documents(spark.createDataFrame([(1, "a text")], "doc_id long, text string"), WORD_BPE).count() == 1
    assert seen[0] == packing.TEXT_BYTES and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_histogram_patterns_use_every_length_and_waste_little():
    r = random.Random(3)
    counts = {n: r.randint(1, 50) for n in range(1, 2049)}
    patterns = packing.pack_histogram(counts)
    used = {}
    for p, n in patterns:
        assert sum(p) <= 2048
        for length in p:
            used[length] = used.get(length, 0) + n
    assert used == counts
    total = sum(k * v for k, v in counts.items())
    assert sum(n for _, n in patterns) * 2048 < 1.01 * total
    assert packing.pack_histogram({1000: 10}) == [((1000, 1000), 5)]
    assert packing.pack_histogram({}) == []


# --- classifiers ------------------------------------------------------------------------------------

def accuracy(scored, labels, column, held_out):
    both = scored.where(F.col("held_out") == held_out).join(labels, "doc_id").select("score", "predicted", column).toPandas()
    y, rank = both[column], both["score"].rank()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (both["predicted"] == y).mean(), (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_quality_of_held_out_documents(spark):
    labels = queries.read(spark, SF_MID, "labels")
    scored = staged(queries.QUERIES["op3_quality_discriminant"](spark, SF_MID), "q")
    hit, auc = accuracy(scored, labels, "quality", True)
    assert hit > 0.95 and auc > 0.97
    for r in scored.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = queries.read(spark, sf, "labels")
    scored = staged(queries.QUERIES["op2_toxicity_nnpu"](spark, sf), "t")
    hit, auc = accuracy(scored, labels, "toxic", True)
    assert hit > 0.95 and auc > 0.9
    for r in scored.limit(500).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1


def test_held_out_labels_change_nothing(spark):
    d, labels = queries.read(spark, SF_MID, "documents"), queries.read(spark, SF_MID, "labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.score_quality(d, x).orderBy("doc_id").toPandas() for x in (labels, turned))
    assert np.allclose(a["score"], b["score"], atol=1e-6)


@pytest.mark.parametrize("score,keep", [(quality.score_quality, quality.keep_quality), (toxicity.score_toxicity, toxicity.drop_toxic)])
def test_classifiers_on_awkward_rows(docs, none, labels, score, keep):
    got = score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    kept = keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    no_labels = labels.where("false")
    assert len({r["score"] for r in score(docs, no_labels).collect()}) == 1
    assert score(none, labels).count() == 0 == keep(none, labels).count()


def test_non_negative_risk_ignores_negative_marks():
    # feature 0 marks half of the positives; the unlabelled rows hold the class prior of positives
    rng = np.random.default_rng(0)
    positive = np.r_[np.ones(400, bool), np.zeros(4000, bool)]
    toxic = np.r_[np.ones(400, bool), rng.random(4000) < 0.1]
    doc = np.flatnonzero(toxic & (rng.random(4400) < 0.8))
    weights, bias = toxicity.fit_nnpu(doc, np.zeros(len(doc), np.int64), positive, 1, 0.1)
    p = 1 / (1 + math.exp(-(weights[0] + bias))), 1 / (1 + math.exp(-bias))
    assert p[0] > 0.8 and p[1] < 0.1


# --- near copies ------------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_banded_alignment_equals_dynamic_programming():
    r = random.Random(1)
    for _ in range(1500):
        a = [r.randint(0, r.choice([1, 3, 20])) for _ in range(r.randint(0, 40))]
        b = list(a)
        for _ in range(r.randint(0, 12)):
            k, at = r.random(), r.randint(0, len(b))
            if k < 0.4:
                b.insert(at, r.randint(0, 20))
            elif b:
                b[min(at, len(b) - 1):at + 1] = [] if k < 0.7 else [r.randint(0, 20)]
        limit, want = r.randint(0, 14), distance(a, b)
        assert order_minhash.edit_distance_within(a, b, limit) == (want if want <= limit else None)


def test_classes_equal_brute_force(spark):
    d = queries.read(spark, SF_MID, "documents").where("n_chars < 3000").select("doc_id", "text")
    rows = d.collect()
    words, first = tx.lower_words(pa.array([r["text"] for r in rows], pa.large_string()))
    kmers, begin = order_minhash.shingles(words, first)
    own = [(kmers[a:b] >> np.uint64(32)).astype("<u4") for a, b in zip(begin, begin[1:])]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            longer, shorter = max(len(own[i]), len(own[j])), min(len(own[i]), len(own[j]))
            if shorter >= 0.8 * longer and len(np.intersect1d(own[i], own[j])) and order_minhash.similar(own[i], own[j], 0.8):
                label[max(root(i), root(j))] = min(root(i), root(j))
    want = {}
    for i, r in enumerate(rows):
        want.setdefault(root(i), set()).add(r["doc_id"])
    got = {}
    for r in order_minhash.near_copies(d).collect():
        got.setdefault(r["class_id"], set()).add(r["doc_id"])
    want, got = {frozenset(x) for x in want.values()}, {frozenset(x) for x in got.values()}
    assert len(want) < len(rows) and len(want ^ got) <= 0.02 * len(rows)


def test_near_copies_on_awkward_rows(spark, docs, none):
    got = order_minhash.near_copies(docs).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] not in (None, 10)}
    assert by[6] == by[7] == by[8] == by[9] == 6 and by[1] == by[2] == by[0] == 0
    assert len({by[3], by[4], by[5], by[11], by[12], by[13]}) == 6
    for c in {(r["class_id"], r["class_size"]) for r in got}:
        assert sum(r["kept"] for r in got if (r["class_id"], r["class_size"]) == c) >= 1
    kept = order_minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in got)
    assert order_minhash.near_copies(none).count() == 0 == order_minhash.drop_near_copies(none).count()


def test_a_large_group_of_near_copies_is_one_class(spark):
    r = random.Random(2)
    base = prose(9, 300).split()
    rows = []
    for i in range(300):
        own = list(base)
        own[r.randrange(300)] = f"w{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, prose(100 + i, 200)) for i in range(30)]
    got = order_minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got if r["doc_id"] < 1000} == {0}
    assert all(r["class_size"] == 1 for r in got if r["doc_id"] >= 1000)


def plain_common(a, b):
    """Shared shingles of two lists, repeats counted."""
    left, n = {}, 0
    for x in a:
        left[x] = left.get(x, 0) + 1
    for x in b:
        if left.get(x, 0):
            left[x] -= 1
            n += 1
    return n


def test_members_meet_over_a_rare_shingle_if_they_may_link(spark):
    """Every pair of one lead that shares enough shingles for a link meets; a group that shares just the lead's text doesn't."""
    r = random.Random(4)
    lead = [r.randrange(1 << 31) for _ in range(100)] * 2
    texts = {0: lead}
    for i in range(1, 120):  # two thirds of the lead's text and a third of their own
        texts[i] = [x if r.random() < 0.62 else r.randrange(1 << 31) for x in lead]
    for i in range(120, 160):  # near copies of members of the group, the lead and each other
        texts[i] = [x if r.random() < 0.85 else r.randrange(1 << 31) for x in texts[r.choice([0, 5, 5, 9, i - 1])]]
    members = [(0, i, i if i < 150 or i % 2 else 0, i < 150 or i % 2 == 1) for i in range(1, 160)]
    table = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in texts.items()], "node long, shingles binary")
    found = order_minhash.rare_meetings(spark.createDataFrame(members, "lead long, node long, part long, apart boolean"), table, 0.8).collect()
    got = {frozenset((x.a, x.b)) for x in found}
    part = {i: p for _, i, p, _ in members}
    apart = {i for _, i, _, x in members if x}
    want = {frozenset((i, j)) for i in part for j in part if i < j and part[i] != part[j] and (i in apart or j in apart)
            and plain_common(texts[i], texts[j]) >= max(len(texts[i]), len(texts[j])) - int(0.2 * max(len(texts[i]), len(texts[j])) + 1e-9)}
    assert want and want <= got and len(got) < 500 and len(got) == len(found)
    assert not any(max(p) < 120 for p in got)


def test_members_that_cannot_link_make_no_pairs(spark):
    """A group whose members share a frequent shingle that their lead lacks, while most differ from each other too much to link."""
    r = random.Random(6)
    base = [r.randrange(1 << 31) for _ in range(150)]
    texts = {0: [r.randrange(1 << 31) if k % 10 == 0 else x for k, x in enumerate(base)]}
    for i in range(1, 150):
        own = set(r.sample(range(150), 12 if i < 120 else 28))
        texts[i] = [r.randrange(1 << 31) if k in own else x for k, x in enumerate(base)]
    texts |= {i: [r.randrange(1 << 31) if k % 50 == i % 50 else x for k, x in enumerate(texts[i - 30])] for i in range(150, 180)}
    members = [(0, i, 0 if i < 120 else i, i >= 120) for i in range(1, 180)]
    table = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in texts.items()], "node long, shingles binary")
    found = order_minhash.rare_meetings(spark.createDataFrame(members, "lead long, node long, part long, apart boolean"), table, 0.8).collect()
    got = {(x.a, x.b) for x in found}
    assert len(got) == len(found) and all(a < b for a, b in got)
    assert {(i - 30, i) for i in range(150, 180)} <= got and len(got) < 100


def test_parities_never_count_more_than_what_two_texts_differ_in():
    r = random.Random(7)
    for n in (0, 1, 30, 146, 900, 5000):
        a = {r.randrange(1 << 40) for _ in range(n)}
        b = set(r.sample(sorted(a), int(0.8 * len(a)))) | {r.randrange(1 << 40) for _ in range(n // 5)}
        x, y = (order_minhash.parities(np.array(sorted(t), dtype=np.int64)).view(np.uint64) for t in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(a ^ b) and not (x ^ x).any()


def test_recall_of_links_on_planted_near_copies(spark):
    """Pairs within the threshold by a plain edit distance are in one class, others apart, very long texts too."""
    r = random.Random(8)
    rows, want = [], []
    for k in range(120):
        base = prose(1000 + k, r.choice([40, 120, 400])).split()
        near = list(base)
        for _ in range(max(1, len(base) // r.choice([10, 16, 30, 45, 100]))):
            near[r.randrange(len(near))] = f"z{r.randrange(9999)}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
        a, b = ([" ".join(w[i:i + 5]).lower().rstrip(".") for i in range(len(w) - 4)] for w in (base, near))
        d = np.arange(len(b) + 1)
        for i, x in enumerate(a):  # one row of the edit distance after another
            now = np.minimum(d[:-1] + np.array([x != y for y in b]), d[1:] + 1)
            d = np.append(i + 1, now)
            d = np.minimum.accumulate(d - np.arange(len(d))) + np.arange(len(d))
        if 1 - d[-1] / max(len(a), len(b)) >= 0.8:
            want.append(k)
    long = prose(77, 150_000)
    rows += [(900, long), (901, long.replace(long.split()[70_000], "changed", 1)), (902, prose(78, 150_000))]
    got = {x["doc_id"]: x["class_id"] for x in order_minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = [k for k in want if got[2 * k + 1] == 2 * k]
    assert 30 < len(want) < 120 and len(hit) >= 0.98 * len(want)
    assert all(got[2 * k + 1] != 2 * k for k in range(120) if k not in want)
    assert got[900] == got[901] == 900 and got[902] == 902


def test_hashes_do_not_depend_on_the_block():
    r = np.random.default_rng(1)
    data = r.integers(0, 256, 5000).astype(np.uint8)
    ends = np.sort(r.choice(np.arange(1, 5001), 300, replace=False))
    starts = np.append(0, ends[:-1] + (np.arange(299) % 2))
    want = tx.hash_runs(data, starts, np.maximum(ends, starts + 1))
    for block in (1, 7, 64, 1000):
        assert (tx.hash_runs(data, starts, np.maximum(ends, starts + 1), block) == want).all()
    assert len(tx._powers(10)[0]) == tx.STEP_BYTES + 1 and len(tx._powers(tx.STEP_BYTES * 2)[0]) == tx.STEP_BYTES * 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)] + [(500 + i, 500) for i in range(1, 50)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[300] == got[100] == got[200] == 100 and all(got[500 + i] == 500 for i in range(50))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- embeddings -------------------------------------------------------------------------------------

def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 24))
    x = np.concatenate([base, base[:20].repeat(15, 0) + rng.normal(size=(300, 24)) * rng.uniform(0.02, 0.3, (300, 1)), base[:3].repeat(4, 0)]).astype("f4")
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] + [1.0] * 23), (904, [None] + [1.0] * 23), (905, [float("inf")] * 24),
           (None, x[0].tolist()), (906, [1.0, 2.0])]
    rows += [(i, v, 1, 2) for i, v in odd]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, mult int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(table, leaf_rows=40, sample=128, block_rows=32).collect()}
    assert len(got) == len(rows)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    want = np.array([link[i].sum() for i in range(len(x))])
    have = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.97 * want.sum()
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(label, np.where(link, label[None, :], len(x)).min(1))
        if (new == label).all():
            break
        label = new
    assert np.mean([got[i]["component_id"] == label[i] for i in range(len(x))]) > 0.98
    for i, _ in odd:
        r = got[i]
        assert r["n_links"] == 0 and r["component_id"] == i and r["kept"] == (i is not None)
    assert embedding_dedup.near_vectors(table.where("false")).count() == 0


def test_recall_on_planted_pairs(spark):
    """Pairs just above the threshold among vectors that are otherwise far apart."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    off = rng.normal(size=base.shape)
    off -= (off * base).sum(1, keepdims=True) * base
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cos = rng.uniform(0.951, 0.96, (3000, 1))
    x = np.concatenate([base, cos * base + np.sqrt(1 - cos ** 2) * off]) * rng.uniform(0.5, 2, (6000, 1))
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    got = embedding_dedup.near_vectors(d).toPandas().sort_values("vec_id")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.95).sum(1) - 1
    assert want.sum() >= 6000 and (got["n_links"].to_numpy() <= want).all() and got["n_links"].sum() >= 0.99 * want.sum()


# --- SentencePiece ----------------------------------------------------------------------------------

def test_encoding_equals_the_library(spark, docs, none):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for table in (docs, queries.read(spark, SF, "documents")):
        encoded = staged(sentencepieces.encode_documents(table, PIECES), "ids")
        got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids"], r["n_tokens"]) for r in encoded.collect())
        want = [(-1 if r["doc_id"] is None else r["doc_id"], sp.encode(r["text"] or "")) for r in table.collect()]
        assert got == sorted((i, ids, len(ids)) for i, ids in want)
        assert all(r["parity"] for r in encoded.collect())
    assert all(r["round_trip"] for r in encoded.collect())
    back = sentencepieces.decode_documents(encoded, PIECES).join(table.withColumnRenamed("text", "was").select("doc_id", "was"), "doc_id").collect()
    assert len(back) == 200 and all(r["text"] == r["was"] for r in back)
    assert sentencepieces.encode_documents(none, PIECES).count() == 0


def _message(no, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    if isinstance(value, int):
        return varint(no << 3) + varint(value)
    if isinstance(value, float):
        return varint(no << 3 | 5) + struct.pack("<f", value)
    return varint(no << 3 | 2) + varint(len(value)) + value


def test_a_unigram_model_is_rebuilt(tmp_path):
    import sentencepiece
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{i:02X}>", 0.0, 6) for i in range(256)],
              ("▁", -2.0, 1), ("▁the", -3.0, 1), ("t", -5.0, 1), ("h", -5.0, 1), ("e", -5.0, 1), ("he", -4.0, 1), ("re", -4.5, 1), ("r", -5.5, 1)]
    data = b"".join(_message(1, _message(1, p.encode()) + _message(2, s) + _message(3, k)) for p, s, k in pieces)
    data += _message(2, _message(3, 1) + _message(35, 1)) + _message(3, _message(1, b"identity") + _message(3, 1) + _message(4, 0) + _message(5, 1))
    path = tmp_path / "uni.model"
    path.write_bytes(data)
    model = sentencepieces.Model.parse(data)
    assert (model.kind, model.byte_fallback, model.dummy_prefix, model.trim, len(model.pieces)) == (1, True, True, False, len(pieces))
    sp = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["the here", "there  the", "x é", "", "the\nhe"]
    ids, begin, same = sentencepieces.Backend(str(path)).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == sp.encode(texts) and same.all()


# --- language model ---------------------------------------------------------------------------------

def test_pseudo_likelihood_equals_brute_force(spark, docs, none):
    vocab = lm_scoring.vocabulary(staged(lm_scoring.word_counts(docs), "counts"))
    rows = staged(lm_scoring.encoded(docs, vocab, "doc_id", "text"), "encoded")
    net = lm_scoring.train(rows, vocab.counts, rounds=1)
    got = {r["doc_id"]: r for r in lm_scoring.score(rows, net).collect()}
    for r in docs.where("doc_id IN (0, 1, 4, 5, 6, 12, 15)").dropDuplicates(["doc_id"]).collect():
        words, _ = tx.lower_words(pa.array([r["text"] or ""], pa.large_string()))
        ids = vocab.look_up(words)
        total = 0.0
        for i, k in enumerate(ids):
            z = net.bias.astype(float).copy()
            for p, off in enumerate((-2, -1, 1, 2)):
                z += net.tables[p][ids[i + off] if 0 <= i + off < len(ids) else lm_scoring.EDGE]
            h = np.tanh(z)
            for logits, at in ((h @ net.to_class + net.class_bias, k // lm_scoring.SIDE),
                               (h @ net.to_word[k // lm_scoring.SIDE] + net.word_bias[k // lm_scoring.SIDE], k % lm_scoring.SIDE)):
                total += logits[at] - np.log(np.exp(logits).sum())
            total += vocab.within[k]
        own = got[r["doc_id"]]
        assert own["n_tokens"] == len(ids) and abs(own["log_likelihood"] - total) < 1e-3 * max(1, len(ids))
        assert (own["mean_log_prob"] is None) == (len(ids) == 0)
    assert len(got) and lm_scoring.score_documents(none).count() == 0


def test_training_beats_the_unigram_start(spark):
    d = queries.read(spark, SF_MID, "documents")
    vocab = lm_scoring.vocabulary(staged(lm_scoring.word_counts(d), "counts"))
    rows = staged(lm_scoring.encoded(d, vocab, "doc_id", "text"), "encoded")
    total = [lm_scoring.score(rows, lm_scoring.train(rows, vocab.counts, n)).agg(F.sum("log_likelihood")).first()[0] for n in (0, 2)]
    assert total[1] > total[0]


def test_rare_words_have_their_share_of_the_corpus(spark):
    often = [f"w{i}" for i in range(1400) for _ in range(9)]
    others = [(f"r{i}", 1 + i % 7) for i in range(3000)]
    random.Random(1).shuffle(often)
    texts = [" ".join(often), *[" ".join([w] * n) for w, n in others], None, "", "r5 w1 r5 r6"]
    d = spark.createDataFrame([(None if i == 9 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    counts = staged(lm_scoring.word_counts(d), "counts")
    vocab = lm_scoring.vocabulary(counts)
    rows = staged(lm_scoring.encoded(d, vocab, "doc_id", "text"), "encoded")
    net = lm_scoring.train(rows, vocab.counts, 0)
    got = {r["doc_id"]: r for r in lm_scoring.with_shares(
        lm_scoring.score(rows, net, ("chunk", "rare")), lm_scoring.word_shares(rows, counts, vocab)).collect()}
    plain = {r["doc_id"]: r for r in lm_scoring.score(rows, net).collect()}
    n = {r["word"]: r["n"] for r in counts.collect()}
    assert len(got) == len(texts) == d.count() and got.keys() == plain.keys()
    for i, t in enumerate(texts):
        words, _ = tx.lower_words(pa.array([t or ""], pa.large_string()))
        own = [(n[int(w)], k) for w, k in zip(words.view(np.int64), vocab.look_up(words))]
        want = sum(math.log(c / vocab.counts[k]) for c, k in own)
        r, p = got[None if i == 9 else i], plain[None if i == 9 else i]
        assert r["n_tokens"] == len(own) and abs(r["log_likelihood"] - p["log_likelihood"] + vocab.within[[k for _, k in own]].sum() - want) < 1e-6 * max(1, len(own))
        assert r["mean_log_prob"] is None if not own else abs(r["mean_log_prob"] - r["log_likelihood"] / len(own)) < 1e-9


def test_number_of_ids_follows_the_distinct_words(spark):
    few, many = (lm_scoring.vocabulary(spark.range(n).select(F.xxhash64("id").alias("word"), F.lit(1).cast("long").alias("n"))) for n in (1000, 200_000))
    assert len(few.counts) == lm_scoring.EDGE and len(many.counts) >= lm_scoring.FREQUENT + 447


def test_training_predicts_every_position(spark):
    d = spark.createDataFrame([(i, "one two three four five six seven eight") for i in range(4000)], "doc_id long, text string")
    vocab = lm_scoring.vocabulary(staged(lm_scoring.word_counts(d), "counts"))
    rows = staged(lm_scoring.encoded(d, vocab, "doc_id", "text"), "encoded")
    padded, place = lm_scoring.windows(*lm_scoring._ids(pa.array([rows.first()["ids"]], pa.binary()), vocab.id_type))
    first, last = (lm_scoring.train(rows, vocab.counts, n).log_probs(lm_scoring.around(padded, place), padded[place]) for n in (0, 2))
    assert (last > first).all()


@pytest.mark.parametrize("rounds", [1, 2, 3, 8, 11])
def test_rounds_share_out_all_words(rounds):
    begin = np.array([0, 1, 1, 20, 23])
    taken = np.concatenate([at for turn in range(min(rounds, lm_scoring.MASK_EVERY)) for at in lm_scoring.masked(begin, turn, rounds)])
    assert sorted(taken) == list(range(23)) and all(list(lm_scoring.masked(begin, t, rounds)) for t in range(rounds))


def test_gradient_of_the_network():
    rng = np.random.default_rng(3)
    net = lm_scoring.Network.start(rng.integers(1, 50, lm_scoring.EDGE).astype(float))
    net.flat = net.flat.astype(np.float64)
    net.__post_init__()
    ids = rng.integers(0, lm_scoring.EDGE, 30)
    around = rng.integers(0, lm_scoring.EDGE + 1, (4, 30))
    loss, grads = net.gradient(around, ids)
    assert abs(loss + net.log_probs(around, ids).mean()) < 1e-6
    whole = np.zeros(len(net.flat))
    for weights, rows, grad in grads:  # the places of the weights in the flat vector
        at = (weights.__array_interface__["data"][0] - net.flat.__array_interface__["data"][0]) // net.flat.itemsize
        view = whole[at:at + weights.size].reshape(weights.shape)
        view[rows] += grad
    for at in [*np.argsort(-np.abs(whole))[::2000][:20], *np.flatnonzero(whole == 0)[::9000]]:
        was = net.flat[at]
        loss = []
        for step in (1e-5, -1e-5):
            net.flat[at] = was + step
            loss.append(-net.log_probs(around, ids).mean())
        net.flat[at] = was
        assert abs((loss[0] - loss[1]) / 2e-5 - whole[at]) < 1e-5


@pytest.mark.parametrize("safe", [True, False])
def test_probabilities_of_more_ids_than_16_bits_and_of_great_logits(safe):
    rng = np.random.default_rng(5)
    side = 300
    net = lm_scoring.Network.start(rng.integers(1, 9, side * side).astype(float))
    if not safe:
        net.to_class[:, 7], net.to_word[299] = 90.0, -80.0
    ids = np.append(rng.integers(0, side * side, 200), [0, 65_535, 65_536, side * side - 1])
    stored = pa.array([ids.astype(lm_scoring.id_type(side * side)).tobytes()], pa.binary())
    again, begin = lm_scoring._ids(stored, lm_scoring.id_type(side * side))
    assert (again == ids).all() and begin.tolist() == [0, 204]
    padded, place = lm_scoring.windows(ids, begin, side * side)
    around = lm_scoring.around(padded, place)
    got = net.log_probs(around, ids)
    h = net.hidden(around).astype(float)

    def log_softmax(z):
        z = z - z.max(-1, keepdims=True)
        return z - np.log(np.exp(z).sum(-1, keepdims=True))
    rows, (cls, word) = np.arange(len(ids)), np.divmod(ids, side)
    of_class = log_softmax(h @ net.to_class.astype(float) + net.class_bias)
    of_word = log_softmax(np.einsum("nh,nhw->nw", h, net.to_word[cls].astype(float)) + net.word_bias[cls])
    assert np.allclose(got, of_class[rows, cls] + of_word[rows, word], atol=2e-3)
    # the sparse step changes what the batch reads and nothing else
    before, squares = net.flat.copy(), lm_scoring.Network(np.full(len(net.flat), 1e-4, np.float32), side)
    lm_scoring.train_on(net, padded, place, squares)
    tables = (net.tables != lm_scoring.Network(before, side).tables).any(axis=2)
    assert all(set(np.flatnonzero(t)) <= set(around[p].tolist()) for p, t in enumerate(tables)) and tables.any()


# --- pipeline ---------------------------------------------------------------------------------------

def test_pipeline_on_awkward_rows(spark, docs, none):
    for table in (docs, none):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, now, SF), name)
            if name != "packing":
                assert out.columns == docs.columns
                assert out.exceptAll(now).count() == 0  # rows are kept or dropped, never made
            now = out
        assert "sequence_id" in now.columns and (table is docs or now.count() == 0)


def test_pipeline_equals_its_operators(spark):
    got = corpus_pipeline.run(spark, SF_MID).select("doc_id").distinct().toPandas()["doc_id"].tolist()
    d, marks = queries.read(spark, SF_MID, "documents"), queries.read(spark, SF_MID, "labels")
    good = {r["doc_id"] for r in quality.score_quality(d, marks).where("predicted = 1").collect()}
    d = staged(d.where(F.col("doc_id").isin(sorted(good))), "good")
    clean = {r["doc_id"] for r in toxicity.score_toxicity(d, marks).where("predicted = 0").collect()}
    d = staged(d.where(F.col("doc_id").isin(sorted(clean))), "clean")
    texts = {}
    for r in d.collect():
        texts[r["text"]] = max(r["doc_id"], texts.get(r["text"], -1))
    d = staged(d.where(F.col("doc_id").isin(sorted(texts.values()))), "once")
    last = {r["doc_id"] for r in order_minhash.near_copies(d).where("kept").collect()}
    assert sorted(got) == sorted(last) and len(last) > 500
