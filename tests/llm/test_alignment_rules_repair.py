"""URL rules, token alignment and conversation repair against brute force, on awkward rows and empty tables."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import conversation_repair, queries, token_alignment, url_rules

RULE = "host string, path string, verdict string"


# --- URL rules --------------------------------------------------------------------------------------

def plain_verdict(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 and url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def random_rules(r):
    hosts = ["net", "example.net", "a.example.net", "b.a.example.net", "org", "x.org", "com"]
    paths = ["", "/", "/e", "/en/", "/en/a", "/en/a/b", "/de/"]
    return [(r.choice(hosts), r.choice(paths), r.choice(["allow", "block"])) for _ in range(14)]


def random_urls(r, n=1500):
    hosts = ["example.net", "EXAMPLE.net", "a.example.net", "c.b.a.example.net", "badexample.net", "net", "x.org", "y.x.org", "example.org", "com.", ".net"]
    tails = ["", "/", "/en", "/en/", "/en/a/b/c", "/EN/", "/de/?q=/en/", "?x=/", "#/en/", "/en/a#b", "/e\nn/"]
    return [r.choice(["http", "https", "x"]) + "://" + (hosts[0] if r.random() < 0.4 else r.choice(hosts)) + r.choice(tails) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_equal_brute_force(spark, seed):
    r = random.Random(seed)
    rules = random_rules(r) + [("Example.NET", "/e", "block"), (None, "/", "block"), ("", "/", "block"), ("org", None, "block")]
    urls = random_urls(r) + [None, "", "no scheme", "a://b://net/", "http://", "http://ünet/Ü", "http://" + "a." * 4000 + "net/" + "x" * 100_000]
    rows = list(enumerate(urls)) + [(None, urls[0]), (0, urls[0]), (0, urls[0])] + [(7, urls[1])] * 9000
    table = spark.createDataFrame([(i, u, "h", "p", 1) for i, u in rows], "page_id long, url string, host string, key string, n int")
    got = sorted(map(tuple, url_rules.judge_urls(table, spark.createDataFrame(rules, RULE)).collect()), key=repr)
    # of repeated rules the verdict that sorts last holds
    clean = {}
    for h, p, v in rules:
        if h:
            k = (h.lower(), p or "")
            clean[k] = max(clean.get(k, ""), v)
    plain = [(h, p, v) for (h, p), v in clean.items()]
    assert got == sorted([(i, *plain_verdict(u, plain)) for i, u in rows], key=repr)


def test_open_rules_reach_later_ranges(spark):
    """One rule covers all rows, which fill several ranges: every range beyond the first gets it."""
    rows = [(i, f"http://h{i % 7}.net/p/{i}") for i in range(20_000)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("h3.net", "/p/1", "allow")], RULE)
    got = url_rules.judge_urls(table, rules)
    assert got.where("rule is null").count() == 0
    want = sum(i % 7 == 3 and str(i).startswith("1") for i in range(20_000))
    assert got.where("verdict = 'allow'").count() == want


def test_urls_without_rules_or_rows(spark):
    none = spark.createDataFrame([], RULE)
    table = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    got = sorted(map(tuple, url_rules.judge_urls(table, none, default="block").collect()), key=repr)
    assert got == sorted([(1, "a.net", "/", None, "block")] * 2 + [(None, "", "", None, "block")], key=repr)
    some = spark.createDataFrame([("net", "/", "block")], RULE)
    assert url_rules.judge_urls(table.limit(0), some).count() == 0


# --- conversation repair ----------------------------------------------------------------------------

EMPTY_SHA = hashlib.sha256().hexdigest()


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, hash of one conversation's rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    after, role_of = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
    keeps = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    best = {0: (0, "", []), 1: (4, "II", ["user:", "assistant:"]), 2: (2, "I", ["assistant:"]), 3: (0, "", [])}
    for (_, _, role, text), f in zip(rows[::-1], faults[::-1]):
        own = {}
        for q in range(4):
            c, a, ls = best[q]
            some = [(c + 3, "D" + a, ls)]
            if f not in ("b", "d"):
                late = f == "t"
                if role[:1] in keeps[q]:
                    c, a, ls = best[keeps[q][role[:1]]]
                    some.append((c + late, "K" + a, [f"{role}:{text}"] + ls))
                c, a, ls = best[after[q]]
                some.append((c + 2 + late, "R" + a, [f"{role_of[after[q]]}:{text}"] + ls))
            own[q] = min(some)
        for _ in range(3):
            for q in range(4):
                c, a, ls = own[after[q]]
                own[q] = min(own[q], (c + 2, "I" + a, [role_of[after[q]] + ":"] + ls))
        best = own
    cost, audit, lines = best[0]
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def plain_conversations(rows, damage=True):
    left = plain_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in left if r[0] == conv]
        out[conv] = plain_repair(own) if own else (0, 0, 0, 0, 0, 0, "", EMPTY_SHA)
    return out


def random_conversations(seed):
    r = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 9)):
            rows.append((conv, r.choice([turn, turn, turn + 3, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         r.choice(["Hi.", "Well", "yes!", "  ", "", None, f"t{r.randint(0, 99)}?", "é. \n", "x ", "?.!"])))
    roles = {100: ["user"], 101: ["tool"], 102: ["user", "assistant"], 103: ["assistant"], 104: ["system", "user", "assistant", "tool"]}
    for conv, some in roles.items():  # long ones: their cost vectors alternate, settle at once or not at all
        rows += [(conv, t, r.choice(some) if conv > 102 else some[t % len(some)], f"text {t}" + r.choice([".", "", "!"])) for t in range(130)]
    rows += [(105, t, "user", "same.") for t in range(90)] + [(None, 1, "user", "Hello."), (None, None, "assistant", "Yes.")]
    rows += [(106, 0, "user", "long. " * 40_000), (106, 1, "assistant", "a" * 200_000)]
    r.shuffle(rows)
    return rows


CONV = "conv_id long, turn long, role string, text string, pos long, code int, chunk long, `at` int, step string"


@pytest.mark.parametrize("seed, bits, passes", [(1, 2, 3), (2, 3, 0), (3, 12, 3), (4, 1, 1)])
def test_repair_equals_brute_force(spark, seed, bits, passes):
    rows = random_conversations(seed)
    table = spark.createDataFrame([(*x, None, None, None, None, None) for x in rows], CONV).repartition(5)
    got = {x[0]: tuple(x[1:]) for x in conversation_repair.repair_damaged(table, bits, passes).collect()}
    assert got == plain_conversations(rows)


def test_repair_writes_the_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "tool", "x"), (2, 0, "user", "Only."), (3, 0, "user", " "), (4, 0, "tool", "No end")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = conversation_repair.repair(table).orderBy("conv_id", "at", "step").collect()
    kept = {c: [(x.new_role, x.new_text) for x in got if x.conv_id == c and x.edit != "D"] for c in (1, 2, 3, 4)}
    plain = {c: v for c, v in plain_conversations(rows, damage=False).items()}
    for c, lines in kept.items():
        assert "".join(x.edit for x in got if x.conv_id == c) == plain[c][6]
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest() == plain[c][7]
    assert kept[2] == [("user", "Only."), ("assistant", "")] and kept[3] == []


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], CONV)
    assert conversation_repair.repair_damaged(none).count() == 0
    assert conversation_repair.repair(none).count() == 0


def test_a_fix_up_pass_stops_where_vectors_agree():
    """A run from another vector ends as soon as the stored vector comes up, and gives the full run's trace."""
    r = random.Random(5)
    codes = pa.array([[r.randrange(8) for _ in range(n)] for n in (0, 1, 5, 40, 40)], pa.list_(pa.int8()))
    chunks = conversation_repair.Chunks(codes)
    a, b = np.tile([0, 4, 2, 0], (5, 1)), np.tile([0, 3, 1, 0], (5, 1))
    old = conversation_repair.run_back(chunks, a)
    again = conversation_repair.run_back(chunks, b, old, np.array([True, True, True, True, False]))
    full = conversation_repair.run_back(chunks, b)
    assert (again[:46] == full[:46]).all() and (again[46:] == old[46:]).all()


# --- token alignment --------------------------------------------------------------------------------

A_PATH, B_PATH = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def plain_tokens(texts):
    """Per text: [(id, bytes)] of A and B, straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    alphabet = {}
    other = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            alphabet[chr(byte)] = byte
        else:
            alphabet[chr(other)] = byte
            other += 1
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()
    out = []
    for t in texts:
        if not t:
            out.append(([], []))
            continue
        own_a = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
        own_b = [(i, piece(i)) for i in b.encode(t)]
        want = (" " + t).encode()
        same = b"".join(x for _, x in own_a) == want == b"".join(x for _, x in own_b)
        out.append((own_a, own_b) if same else ([], []))
    return out


def plain_alignment(texts):
    from collections import Counter
    docs, counts = [], Counter()
    for a, b in plain_tokens(texts):
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, raw in side:
                own.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(own)
        links, j = [], 0
        for s, e, i in spans[0]:
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        counts.update(links)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        text, lo = [], 0
        for c in cuts:
            text.append("|".join(",".join(str(i) for s, e, i in side if lo < e <= c) for side in spans))
            lo = c
        docs.append((len(a), len(b), len(cuts), links, ";".join(text)))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(n_a, n_b, g, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls),
             hashlib.sha256(t.encode()).hexdigest() if n_a else "") for n_a, n_b, g, ls, t in docs]


def alignment_texts(seed):
    r = random.Random(seed)
    words = ["the", "Therapist", "antidisestablishmentarianism", "naïve", "日本語", "😀😀", "don't", "...", "  ", "\n", "\t", "1234567", "x=y;", "é", "\u00a0", "\u3000", "\u2003", "\x1f", "\x0b", "\u00a0\u00a0", "\u0085x", "<s>", "<|endoftext|>"]
    some = [" ".join(r.choice(words) for _ in range(r.randint(1, 40))) for _ in range(40)]
    some += ["".join(r.choice(words + [" "] * 8) for _ in range(60)) for _ in range(40)]
    return some + [None, "", " ", "a", "\u2581", "with \u2581 inside", "\x00 zero", "ё" * 50, some[0], some[0], "word " * 3000, "日本" * 800, "z" * 3000]


@pytest.mark.parametrize("work, segment, chunk", [(1 << 16, 1 << 18, 1 << 24), (3, 40, 200), (1, 1 << 18, 3000), (50, 500, 1)])
def test_alignment_equals_brute_force(spark, work, segment, chunk):
    texts = alignment_texts(7)
    rows = list(enumerate(texts)) + [(None, "the end"), (3, "twice")]
    table = spark.createDataFrame([(i, t, 1, 2, "x", 0) for i, t in rows], "doc_id long, text string, node long, piece int, pair string, chunk long").repartition(3)
    got = sorted(map(tuple, token_alignment.align_documents(table, A_PATH, B_PATH, work=work, segment=segment, chunk_bytes=chunk).collect()), key=repr)
    assert got == sorted([(i, *x) for (i, _), x in zip(rows, plain_alignment([t for _, t in rows]))], key=repr)


@pytest.mark.parametrize("work", [1, 7, 1 << 16])
def test_overlaps_are_the_covering_tokens(spark, work):
    texts = [t for t in alignment_texts(9) if t and "\u2581" not in t]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((x.doc_id, x.start, x.end, x.a_id, x.b_id) for x in token_alignment.overlaps(table, A_PATH, B_PATH, work=work, segment=60).collect())
    want = []
    for d, (a, b) in enumerate(plain_tokens(texts)):
        ends = [np.cumsum([len(raw) for _, raw in side]).tolist() for side in (a, b)]
        lo = 0
        for e in sorted(set(ends[0]) | set(ends[1])):
            want.append((d, lo, e, a[np.searchsorted(ends[0], e)][0], b[np.searchsorted(ends[1], e)][0]))
            lo = e
    assert got == sorted(want)


def test_diagonals_divide_the_merge_path():
    r = np.random.default_rng(3)
    a, b = np.cumsum(r.integers(1, 4, 300)), np.cumsum(r.integers(1, 4, 500))
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    want = np.cumsum([0] + [side == 0 for _, side in merged])
    assert (token_alignment.path_at(a, b, np.arange(801)) == want).all()


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align_documents(none, A_PATH, B_PATH).count() == 0
    assert token_alignment.overlaps(none, A_PATH, B_PATH).count() == 0


# --- shares of very many rows -----------------------------------------------------------------------

def test_a_small_share_is_not_nothing(spark):
    """What a draw keeps follows the share also where the share of a row is far below a millionth."""
    from pyspark.sql import functions as F

    from tessera.llm.common import drawn_share
    rows = spark.range(200_000)
    for share in (0.0, 0.3, 1.0):
        for given in (share, F.lit(share)):
            n = rows.where(drawn_share(given, "id")).count()
            assert abs(n - share * 200_000) < 2000 and (share not in (0.0, 1.0) or n == share * 200_000)
    limit = int(1e-9 * (1 << 62))
    assert 0 < limit and rows.where(drawn_share(1e-9, "id")).count() == rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 62)) < limit).count()


def test_reading_back_takes_batches_by_bytes(spark, monkeypatch):
    from tessera.llm import warc
    monkeypatch.setattr(warc, "BATCH_BYTES", 3000)
    monkeypatch.setattr(warc, "FETCH_BYTES", 4000)
    monkeypatch.setattr(warc, "FETCH_ROWS", 7)
    rows = [(i, f"http://h{i % 5}.net/{i}", "x" * (i % 13) * 400) for i in range(60)] + [(99, None, None)]
    got = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.archive_and_read(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: len(h or "") for i, _, h in rows}
