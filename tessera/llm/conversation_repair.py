"""Conversation structure repair: rank-convergence parallel Viterbi over chunks of rows.

A conversation's rows are taken by turn (nulls first; ties by role and text digest).  A row is blank
without a character other than white space, else duplicate if its role and text stand earlier, else
truncated if its last such character is none of ``.!?``.  Edits are Keep (0), Rerole to user or assistant
(2), Delete (3, required for blank and duplicate rows) and Insert of an empty user or assistant row (2); a
truncated row that stays adds 1.  The role initials that remain must be ``(s?(ua)+)?``, which is an
automaton of four states; the cheapest edits are wanted, of equally cheap ones the least in ASCII.

Least costs to the end are a vector of four numbers per row.  Rows are dealt into ranges by (conversation,
turn, ...), numbered in order and cut into chunks of at most 4096 rows, so that a long conversation is
many rows for Spark.  All chunks run backward at once, each from a speculative vector; a fix-up pass reruns
the chunks whose successor ended in another vector, up to a constant, and stops inside a chunk as soon as
the vector differs from the stored one by a constant only.  After ``FIX_PASSES`` passes the conversations
that still change (their vectors may alternate for ever) run every chunk from the four unit vectors, which
gives its result for any vector; these are joined from chunk to chunk on narrow rows, and one last run stores
the true vectors.  The stitched costs then drive the forward trace: every chunk says where it ends from each of the
four states, the states are joined from chunk to chunk, and each chunk writes its edits from its true state.

Rows that must be deleted leave the state alone and cost the same everywhere, so the chunks skip them.

Defined cases: a null role or text is one space; a null conversation is one of its own; repeated rows are
duplicates; an empty role can't be kept; texts of any length are whole; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import staged

CHUNK_BITS = 12
FIX_PASSES = 3
BLANKS = " \t\n\x0b\x0c\r"
FAR = 1 << 40                      # a cost that no edits reach
NEXT = np.array([2, 2, 3, 2])      # state behind the role that a state waits for
LAST = np.array([0, 4, 2, 0])      # least cost behind the last row: close what is open by inserts
KEEP_TO = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])  # state x initial (s, u, a, other)
ROLE_OF = {2: "user", 3: "assistant"}


# --- rows ------------------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` damaged by crc32(``conv_id:turn``) % 20: 0 drops a row, 1 empties its text, 2 removes its
    ``[.!?]``, 3 repeats it, 4 makes its role user; nulls count as one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    role = F.coalesce(F.col("role").cast("string"), blank)
    return (rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), kind.alias("kind"))
            .where("kind <> 0").select("*", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))


def ordered(rows: DataFrame) -> DataFrame:
    """The rows with their text's digest and ``pos``, a number that grows in the order of conversations and
    turns.  Equal rows of one turn may stand in any order and are dealt to several ranges if need be."""
    blank = F.lit(" ")
    own = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                      F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    own = own.select("*", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("spread"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("spread")]
    return staged(own.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("conv_id", "turn", "role", "text", "digest", F.monotonically_increasing_id().alias("pos")), "repair-rows")


def coded(lines: DataFrame) -> DataFrame:
    """conv_id, pos, fault (blank, duplicate, truncated or null) and code: -1 for rows that must go, else
    the initial (0 s, 1 u, 2 a, 3 other) plus 4 for a truncated row."""
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = lines.select("conv_id", "pos", "role", "digest", (shown == "").alias("blank"),
                          (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("open"))
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (narrow.join(first, "pos", "left").select("conv_id", "pos", fault.alias("fault"), kind.alias("kind"))
            .select("conv_id", "pos", "fault",
                    F.when(F.col("fault").isin("blank", "duplicate"), -1).otherwise(F.col("kind") + F.when(F.col("fault") == "truncated", 4).otherwise(0))
                    .cast("int").alias("code")))


def chunked(rows: DataFrame, bits: int) -> DataFrame:
    """Chunks of at most 2^bits rows of a conversation: chunk (grows in order), and the positions of the rows
    that may stay with their codes."""
    chunk = F.shiftright("pos", bits)
    live = F.filter("rows", lambda r: r["code"] >= 0)
    cut = (rows.groupBy("conv_id", chunk.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("rows"))
           .select("conv_id", "chunk", live.alias("rows"))
           .select("conv_id", "chunk", F.col("rows.pos").alias("pos"), F.col("rows.code").cast("array<tinyint>").alias("codes")))
    return cut


# --- the automaton on many chunks at once -----------------------------------------------------------

def _inserts(v: np.ndarray) -> np.ndarray:
    """Costs with any inserts before the next row allowed."""
    two = np.minimum(v[:, 2], v[:, 3] + 2)
    three = np.minimum(v[:, 3], v[:, 2] + 2)
    return np.stack([np.minimum(v[:, 0], two + 2), np.minimum(v[:, 1], two + 2), two, three], axis=1)


def _candidates(v: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least cost from every state if the row is deleted, kept or reroled; ``v``: costs behind it."""
    stays = (code >= 4).astype(np.int64)[:, None]
    to = KEEP_TO[:, code % 4].T
    kept = np.where(to >= 0, np.take_along_axis(v, np.maximum(to, 0), axis=1) + stays, FAR)
    return v + 3, kept, v[:, NEXT] + 2 + stays


def _back(v: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _inserts(np.minimum.reduce(_candidates(v, code)))


def _level(v: np.ndarray) -> np.ndarray:
    return v - v.min(axis=1, keepdims=True)


class Chunks:
    """Codes of the chunks of one batch, by step from the end or the beginning."""

    def __init__(self, codes: pa.Array):
        offsets = codes.offsets.to_numpy().astype(np.int64)
        self.flat = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.begin, self.size = offsets[:-1] - offsets[0], np.diff(offsets)
        self.by = np.argsort(-self.size, kind="stable")
        self.longest = int(self.size.max()) if len(self.size) else 0
        self.count = np.searchsorted(-self.size[self.by], -np.arange(self.longest), side="left")  # chunks longer than the step

    def backward(self):
        """(chunks, place of their row in ``flat``) for the last row, the last but one, ..."""
        for step in range(self.longest):
            own = self.by[:self.count[step]]
            yield own, self.begin[own] + self.size[own] - 1 - step

    def forward(self):
        for step in range(self.longest):
            own = self.by[:self.count[step]]
            yield own, self.begin[own] + step


def run_back(chunks: Chunks, start: np.ndarray, old: np.ndarray | None = None, where: np.ndarray | None = None) -> np.ndarray:
    """Vectors behind every row (``trace``, levelled, at the row's place); with the vectors ``old`` of a run
    before, only the chunks ``where`` run, and each only until its vector is the old one again."""
    trace = np.zeros((len(chunks.flat), 4), dtype=np.int64) if old is None else old.copy()
    v = _level(start)
    active = np.ones(len(start), dtype=bool) if where is None else where.copy()
    for own, at in chunks.backward():
        here = active[own]
        own, at = own[here], at[here]
        if not len(own):
            break
        if old is not None:
            same = (trace[at] == v[own]).all(axis=1)
            active[own[same]] = False
            own, at = own[~same], at[~same]
        trace[at] = v[own]
        v[own] = _level(_back(v[own], chunks.flat[at]))
    return trace


def first_vectors(chunks: Chunks, trace: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Levelled vector before the first row of every chunk."""
    out = _level(start)
    some = chunks.size > 0
    at = chunks.begin[some]
    out[some] = _level(_back(trace[at], chunks.flat[at]))
    return out


def _edit(state: np.ndarray, v: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inserts before the row, 0 delete / 1 keep / 2 rerole, state behind it): the least in ASCII among the
    cheapest, so delete before insert before keep before rerole."""
    row = np.arange(len(state))
    deleted, kept, reroled = _candidates(v, code)
    ahead = _inserts(np.minimum.reduce([deleted, kept, reroled]))
    inserts = np.zeros(len(state), dtype=np.int64)
    state = state.copy()
    choice = np.full(len(state), -1)
    while (choice < 0).any():
        best = ahead[row, state]
        open_ = choice < 0
        drop = open_ & (deleted[row, state] == best)
        choice[drop] = 0
        more = open_ & ~drop & (ahead[row, NEXT[state]] + 2 == best)
        keep = open_ & ~drop & ~more & (kept[row, state] == best)
        choice[keep] = 1
        choice[open_ & ~drop & ~more & ~keep] = 2
        inserts[more] += 1
        state[more] = NEXT[state[more]]
    behind = np.select([choice == 0, choice == 1], [state, KEEP_TO[state, code % 4]], NEXT[state])
    return inserts, choice, behind


# --- the same as Spark jobs -------------------------------------------------------------------------

VECTOR = "array<long>"
RUN = f"conv_id string, chunk long, pos array<long>, codes array<tinyint>, used {VECTOR}, first {VECTOR}, trace binary"


def _schema(like: DataFrame, ddl: str) -> T.StructType:
    own = T.StructType.fromDDL(ddl)
    return T.StructType([T.StructField(f.name, like.schema["conv_id"].dataType) if f.name == "conv_id" else f for f in own.fields])


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4).astype(np.int64)


def _lists(v: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(v.reshape(-1), pa.int64()), 4).cast(pa.list_(pa.int64()))


def _blobs(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.array([flat[b:b + n].tobytes() for b, n in zip(begin.tolist(), size.tolist())], pa.binary())


def _parts(batches, rows: int = 1 << 18):
    """The batches cut so that a part holds about ``rows`` rows of conversations."""
    for b in batches:
        ends = np.cumsum(np.diff(b.column("codes").offsets.to_numpy()) + 1)
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + rows, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def _run(batches):
    """Run chunks from ``want``; ``trace`` null: the first run, else a fix-up of those where ``used`` differs."""
    for b in _parts(batches):
        chunks = Chunks(b.column("codes"))
        want = _vectors(b.column("want"))
        if b.schema.get_field_index("trace") < 0:
            trace = run_back(chunks, want)
        else:
            old = np.frombuffer(b"".join(x.as_py() for x in b.column("trace")), dtype=np.uint8).reshape(-1, 4).astype(np.int64)
            trace = run_back(chunks, want, old, (_vectors(b.column("used")) != want).any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("chunk"), b.column("pos"), b.column("codes"), _lists(want), _lists(first_vectors(chunks, trace, want)),
             _blobs(trace.astype(np.uint8), chunks.begin, chunks.size)], names=_names(RUN))


def _units(batches):
    """The four vectors that a chunk gives for the four unit vectors, one after another."""
    for b in _parts(batches):
        chunks = Chunks(b.column("codes"))
        out = []
        for k in range(4):
            v = np.full((b.num_rows, 4), FAR, dtype=np.int64)
            v[:, k] = 0
            for own, at in chunks.backward():
                v[own] = np.minimum(_back(v[own], chunks.flat[at]), FAR)
            out.append(v)
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("chunk"), pa.array([x.tolist() for x in np.concatenate(out, axis=1)], pa.list_(pa.int64()))],
                                         names=["conv_id", "chunk", "units"])


def _join_back(batches):
    """The true vector that every chunk starts from; chunks come by conversation, last first."""
    conv, v = object(), None
    for b in batches:
        ids, units, out = b.column(0).to_pylist(), b.column(2).to_pylist(), []
        for c, u in zip(ids, units):
            if c != conv:
                conv, v = c, LAST
            out.append(v.tolist())
            v = (np.array(u).reshape(4, 4) + v[:, None]).min(axis=0)
            v = v - v.min()
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64()))], names=["conv_id", "chunk", "want"])


def cost_vectors(chunks: DataFrame, fix_passes: int = FIX_PASSES) -> DataFrame:
    """The chunks with the vector behind each of their rows (``trace``, four bytes a row)."""
    run = _schema(chunks, RUN)
    last = F.array(*[F.lit(int(x)).cast("long") for x in LAST])
    now = staged(chunks.withColumn("want", last).mapInArrow(_run, run), "repair-run")
    after = Window.partitionBy("conv_id").orderBy("chunk")
    for turn in range(fix_passes + 1):
        # a conversation's summary has one narrow row per 4096 of its rows
        wanted = now.select("conv_id", "chunk", "used", F.coalesce(F.lead("first").over(after), last).alias("want")).where("want <> used")
        if wanted.isEmpty():
            return now
        if turn == fix_passes:
            break
        joined = now.join(wanted.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "want"),
                          F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left").drop("c", "k")
        now = staged(joined.withColumn("want", F.coalesce("want", "used")).mapInArrow(_run, run), "repair-fix")
    moving = wanted.select("conv_id").distinct().select(F.col("conv_id").alias("c"))
    units = (now.join(moving, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").select("conv_id", "chunk", "codes")
             .mapInArrow(_units, _schema(chunks, "conv_id string, chunk long, units array<long>")))
    true = (units.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
            .mapInArrow(_join_back, _schema(chunks, f"conv_id string, chunk long, want {VECTOR}"))
            .select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "want"))
    joined = now.join(true, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left").drop("c", "k")
    return staged(joined.withColumn("want", F.coalesce("want", "used")).mapInArrow(_run, run), "repair-true")


def _trace(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in b.column("trace")), dtype=np.uint8).reshape(-1, 4).astype(np.int64)


def _ends(batches):
    """The state behind a chunk from each of the four states before it."""
    for b in _parts(batches):
        chunks, trace = Chunks(b.column("codes")), _trace(b)
        state = np.tile(np.arange(4), (b.num_rows, 1))
        for own, at in chunks.forward():
            for k in range(4):
                state[own, k] = _edit(state[own, k], trace[at], chunks.flat[at])[2]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("chunk"), _lists(state)], names=["conv_id", "chunk", "ends"])


def _join_forward(batches):
    """The state before every chunk; chunks come by conversation in order."""
    conv, state = object(), 0
    for b in batches:
        out = []
        for c, ends in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if c != conv:
                conv, state = c, 0
            out.append(state)
            state = ends[state]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64())], names=["conv_id", "chunk", "state"])


EDITS = "conv_id string, pos long, step int, edit string, to string"


def _write(batches):
    """The edits of every chunk: inserts (step 0, 1, ...) before the edit of the row itself."""
    for b in _parts(batches):
        chunks, trace = Chunks(b.column("codes")), _trace(b)
        state = b.column("state").to_numpy(zero_copy_only=False).astype(np.int64).copy()
        n = len(chunks.flat)
        before, inserts, choice = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for own, at in chunks.forward():
            before[at] = state[own]
            inserts[at], choice[at], state[own] = _edit(state[own], trace[at], chunks.flat[at])
        pos = b.column("pos").flatten().to_numpy(zero_copy_only=False)
        chunk = np.repeat(np.arange(b.num_rows), chunks.size)
        rows, step, edit, to = [], [], [], []
        for i, (q, m, c) in enumerate(zip(before.tolist(), inserts.tolist(), choice.tolist())):
            for k in range(m):
                q = int(NEXT[q])
                rows.append(i), step.append(k), edit.append("I"), to.append(ROLE_OF[q])
            rows.append(i), step.append(m), edit.append("DKR"[c]), to.append(ROLE_OF[int(NEXT[q])] if c == 2 else None)
        rows = np.array(rows, dtype=np.int64)
        conv = b.column("conv_id").take(pa.array(chunk[rows]))
        yield pa.RecordBatch.from_arrays([conv, pa.array(pos[rows], pa.int64()), pa.array(step, pa.int32()), pa.array(edit, pa.string()), pa.array(to, pa.string())],
                                         names=["conv_id", "pos", "step", "edit", "to"])
        # what is open behind the last chunk is closed by inserts
        tail = [(i, k) for i, (q, end) in enumerate(zip(state.tolist(), b.column("last").to_pylist())) if end for k in range({0: 0, 1: 2, 2: 1, 3: 0}[q])]
        if tail:
            open_ = [int(NEXT[state[i]]) if k == 0 else 3 for i, k in tail]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id").take(pa.array([i for i, _ in tail], pa.int64())), pa.array([None] * len(tail), pa.int64()),
                 pa.array([k for _, k in tail], pa.int32()), pa.array(["I"] * len(tail), pa.string()), pa.array([ROLE_OF[q] for q in open_], pa.string())],
                names=["conv_id", "pos", "step", "edit", "to"])


def least_edits(vectors: DataFrame) -> DataFrame:
    """conv_id, pos, step, edit (D, I, K, R) and the new role of inserts and reroles; inserts behind the
    last row have a null pos."""
    ends = vectors.mapInArrow(_ends, _schema(vectors, f"conv_id string, chunk long, ends {VECTOR}"))
    states = (ends.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
              .mapInArrow(_join_forward, _schema(vectors, "conv_id string, chunk long, state long"))
              .select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "state",
                      F.col("chunk").eqNullSafe(F.max("chunk").over(Window.partitionBy("conv_id"))).alias("last")))
    joined = vectors.join(states, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))).drop("c", "k")
    return joined.mapInArrow(_write, _schema(vectors, EDITS))


def repair(rows: DataFrame, bits: int = CHUNK_BITS, fix_passes: int = FIX_PASSES) -> DataFrame:
    """Every edit of every conversation in order (``at``, ``step``): edit, the row's own turn, role, text and
    fault (null for inserts), and the repaired role and text (null for deleted rows)."""
    lines = ordered(rows)
    codes = staged(coded(lines), "repair-codes")
    vectors = cost_vectors(staged(chunked(codes, bits), "repair-chunks"), fix_passes)
    edits = staged(least_edits(vectors), "repair-edits")
    forced = codes.where("code < 0").select("conv_id", "pos", F.lit(0).alias("step"), F.lit("D").alias("edit"), F.lit(None).cast("string").alias("to"))
    placed = edits.where("pos is not null").unionByName(forced)
    own = lines.select("pos", "turn", "role", "text").join(codes.select("pos", "fault"), "pos")
    inserted = F.col("edit") == "I"
    on_rows = placed.join(own, "pos").select(
        "conv_id", F.col("pos").alias("at"), "step", "edit", "fault", *[F.when(~inserted, F.col(c)).alias(c) for c in ("turn", "role", "text")],
        F.when(F.col("edit") != "D", F.coalesce("to", "role")).alias("new_role"),
        F.when(inserted, "").when(F.col("edit") != "D", F.col("text")).alias("new_text")).withColumn("fault", F.when(~inserted, F.col("fault")))
    behind = edits.where("pos is null").select(
        "conv_id", F.lit((1 << 63) - 1).alias("at"), "step", "edit", F.lit(None).cast("string").alias("fault"),
        F.lit(None).cast(lines.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.col("to").alias("new_role"), F.lit("").alias("new_text"))
    return on_rows.unionByName(behind)


# --- one row per conversation -----------------------------------------------------------------------

DIGEST = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


class _Account:
    """What one conversation's edits, read in order, add up to."""

    def __init__(self, conv):
        self.conv, self.audit, self.sha, self.any = conv, [], hashlib.sha256(), False
        self.low = self.high = self.seen = None
        self.turns = self.illegal = self.cost = 0
        self.initial = None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, edit, fault, turn, role, new_role, new_text):
        self.audit.append(edit)
        self.cost += COST[edit] + (fault == "truncated" and edit != "D")
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.turns += turn != self.seen
                self.high = self.seen = turn
            if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = role[:1]
        if edit != "D":
            self.sha.update(("\n" * self.any + f"{new_role}:{new_text}").encode())
            self.any = True

    def row(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _accounts(batches):
    account = None

    def rows(done, conv_type):
        types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=_names(DIGEST))
    for b in batches:
        done = []
        columns = [b.column(n).to_pylist() for n in ("conv_id", "edit", "fault", "turn", "role", "new_role", "new_text")]
        for conv, *edit in zip(*columns):
            if account is None or conv != account.conv:
                if account is not None:
                    done.append(account.row())
                account = _Account(conv)
            account.add(*edit)
        if done:
            yield rows(done, b.column("conv_id").type)
    if account is not None:
        yield rows([account.row()], b.column("conv_id").type)


def repair_digest(rows: DataFrame, bits: int = CHUNK_BITS, fix_passes: int = FIX_PASSES) -> DataFrame:
    """One row per conversation of ``rows``, from its edits: gaps between turns, faults, illegal neighbours,
    cost, audit and the SHA-256 of the repaired lines.

    A digest reads its lines one after another, so each conversation streams through one task here, from
    sorted rows and without being held; only its audit, one letter an edit, is."""
    edits = repair(rows, bits, fix_passes)
    streamed = edits.repartition("conv_id").sortWithinPartitions("conv_id", "at", "step").drop("text")
    return streamed.mapInArrow(_accounts, _schema(edits, DIGEST))


def repair_damaged(conversations: DataFrame, bits: int = CHUNK_BITS, fix_passes: int = FIX_PASSES) -> DataFrame:
    """:func:`repair_digest` of the damaged rows, with every original conversation."""
    own = repair_digest(damaged(conversations), bits, fix_passes)
    all_ = conversations.select(F.col("conv_id").alias("c")).distinct()
    joined = all_.join(own, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("c").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
