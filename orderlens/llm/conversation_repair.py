r"""Conversation structure repair by integer-minimum paths.

The rows of a conversation, in turn order, are to become a conversation whose
role initials read ``(s?(ua)+)?``.  Four states say what has been written so
far: nothing, a system turn, a user turn, an assistant turn.  Each row is one
layer of a DAG; an edge keeps it (cost 0), gives it the awaited role user or
assistant (3) or deletes it (4, the only edge of a blank or duplicate row), each
but the deletion after at most one inserted empty turn (3), and 3 more where a
truncated row stays.  (Two insertions in a row never pay: what ``ua`` leads to is
reached at no cost from where it began, or by deleting the system turn.)

Weight: one integer a path.  Its high digits are the cost, its low digits, of
three bits, the letters of the audit from the left: the k-th letter of a path
stands at a fixed place k, and places not used yet are zero, so that an audit
that ends early counts as less.  Edges add to the weight, and the ordinary
minimum of integers at every node gives the cheapest edits and among them the
ASCII-least audit (D, I, K, R are 1 to 4).  Paths that meet at a node have used
the same rows and end in a row's letter, so none is the beginning of another and
the least at a node stays the least whatever follows.

Scale: rows are sorted by a range partitioning on conversation and turn, so that
a conversation of any length is spread over many tasks.  A task cuts what it has
of a conversation into segments of bounded rows and characters and solves each from
every state it may be entered in: for each pair of states the least weight.  A
second minimum-weight pass over the segments of a conversation sees four costs
and four ranks a state pair instead of texts and audits (one number: cost, rank
of the way so far, rank inside the segment), and returns the state in which each
segment is entered.  Copies of a row are counted before any sort.  The hash of
the repaired text is defined over the whole of it in order, so the rendered
segments of one conversation pass one task, as a stream of which one segment at
a time is held; the state of the hash is all that is kept.

Defined cases: null role or text counts as one space, a role's initial is its
first character and an empty role has none (such a row cannot be kept as it is);
a null conversation id is a conversation of its own; rows of one turn follow each
other by role, the first characters of the text and its digest; a row repeated
in the input is a duplicate like one repeated by damage; very long texts are one
segment each, read whole; a conversation that loses all rows has zeros, an empty
audit and the hash of the empty text; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from orderlens.llm.common import table
from orderlens.plans.materialize import materialize

SPACES = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
LETTERS = "DIKR"  # in ASCII order: 1 to 4
WIDTH = 3  # bits of a letter
#: state -> the awaited user or assistant turn
AWAITED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: what completes the conversation when the rows have ended in a state
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
SEGMENT_ROWS = 256
SEGMENT_CHARS = 1 << 20
START_CHARS = 64  # of a text, in the order of rows of one turn


# ---- one segment -----------------------------------------------------------

def edges(state: int, role: str, fault: str | None) -> Iterator[tuple[str, int, int]]:
    """(letters, cost, next state) of the edges of one row."""
    yield "D", DELETE, state
    if fault in ("blank", "duplicate"):
        return
    extra = TRUNCATED if fault == "truncated" else 0
    inserted = NEXT[state, AWAITED[state]]
    for letters, cost, at in (("", 0, state), ("I", INSERT, inserted)):
        if (kept := NEXT.get((at, role[:1]))) is not None:
            yield letters + "K", cost + KEEP + extra, kept
        yield letters + "R", cost + REROLE + extra, NEXT[at, AWAITED[at]]


def solve(rows: list[tuple[str, str | None]], entry: int) -> dict[int, tuple[int, str]]:
    """Rows (role, fault) entered in a state -> for each state to end in, the least (cost, audit)."""
    places = 2 * len(rows)  # at most one insertion a row
    high = WIDTH * places
    best = {entry: (0, 0)}  # state -> weight, letters so far
    for role, fault in rows:
        least: dict[int, tuple[int, int]] = {}
        for state, (weight, n) in best.items():
            for letters, cost, to in edges(state, role, fault):
                new, k = weight + (cost << high), n
                for letter in letters:
                    k += 1
                    new += (LETTERS.index(letter) + 1) << WIDTH * (places - k)
                if to not in least or new < least[to][0]:
                    least[to] = new, k
        best = least
    return {state: (weight >> high, _letters(weight, places, n)) for state, (weight, n) in best.items()}


def _letters(weight: int, places: int, n: int) -> str:
    return "".join(LETTERS[(weight >> WIDTH * (places - k) & (1 << WIDTH) - 1) - 1] for k in range(1, n + 1))


def render(rows: Iterable[tuple[str, str]], audit: str, state: int) -> Iterator[str]:
    """The lines of rows (role, text) edited as an audit says, entered in a state."""
    rows = iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        initial = role[:1] if letter == "K" else AWAITED[state]
        state = NEXT[state, initial]
        yield f"{role if letter == 'K' else ROLES[initial]}:{text}"


# ---- rows in order ---------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: what is left, copies of one row counted."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def _row_order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("start"), F.col("digest")]


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, copies) with ``first`` (no equal role and text stands earlier),
    range-partitioned and sorted by conversation and turn."""
    distinct = materialize(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "repair_rows")
    # texts that a conversation has at several turns, with the earliest; written, so that AQE can split a hot one
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = materialize(distinct.groupBy("conv_id", "role", "text").agg(F.min(turn).alias("earliest"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("conv_id", "role", "text", F.col("earliest.turn").alias("earliest"),
                                               F.lit(True).alias("several")), "repair_again")
    r, a = distinct.alias("r"), again.alias("a")
    same = (F.col("r.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("r.role") == F.col("a.role"))
            & (F.col("r.text") == F.col("a.text")))
    first = F.col("several").isNull() | F.col("r.turn").eqNullSafe(F.col("a.earliest"))
    keyed = r.join(a, same, "left").select("r.*", first.alias("first"), F.left("r.text", F.lit(START_CHARS)).alias("start"),
                                           F.md5("r.text").alias("digest"))
    return keyed.repartitionByRange(*_row_order()).sortWithinPartitions(*_row_order())


def fault_of(text: str, repeated: bool) -> str | None:
    if not (bare := text.rstrip(SPACES)):
        return "blank"
    return "duplicate" if repeated else "truncated" if bare[-1] not in ".!?" else None


# ---- segments --------------------------------------------------------------

def _segment_type(conv: str, turn: str) -> str:
    return (f"conv_id {conv}, turn {turn}, role string, start string, digest string, at bigint, roles array<string>, "
            "texts array<string>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role string, "
            "last_role string, entry array<int>, exit array<int>, cost array<bigint>, place array<int>, audit array<string>")


def _segments(rows: Iterable[dict], n_rows: int, n_chars: int) -> Iterator[dict]:
    """Rows of one task in order, copies written out -> segments, each solved from every state."""
    held: list[dict] = []
    size = 0
    for row in rows:
        if held and (held[0]["conv_id"] != row["conv_id"] or len(held) == n_rows or size + len(row["text"]) > n_chars):
            yield _solved(held)
            held, size = [], 0
        held.append(row)
        size += len(row["text"])
    if held:
        yield _solved(held)


def _solved(rows: list[dict]) -> dict:
    faults = [fault_of(r["text"], r["repeated"]) for r in rows]
    roles = [r["role"] for r in rows]
    pairs = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    ways = []
    for entry in STATES:
        found = solve(list(zip(roles, faults)), entry)
        for place, (_, to) in enumerate(sorted((audit, to) for to, (_, audit) in found.items())):
            ways.append((entry, to, found[to][0], place, found[to][1]))
    key = {c: rows[0][c] for c in ("conv_id", "turn", "role", "start", "digest", "at")}
    return key | {
        "roles": roles, "texts": [r["text"] for r in rows], "illegal": pairs, "first_role": roles[0], "last_role": roles[-1],
        **{kind: faults.count(kind) for kind in ("blank", "duplicate", "truncated")},
        **{name: [w[k] for w in ways] for k, name in enumerate(("entry", "exit", "cost", "place", "audit"))}}


def _written_out(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            for row in batch.slice(at, 1024).to_pylist():
                for k in range(row["copies"]):
                    yield row | {"at": k, "repeated": k > 0 or not row["first"]}


def _batches(rows: Iterable[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if len(held) == 1024 or total > 4 * SEGMENT_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def segments(rows: DataFrame, n_rows: int = SEGMENT_ROWS, n_chars: int = SEGMENT_CHARS) -> DataFrame:
    kinds = dict(rows.dtypes)
    return _streamed(rows, lambda batches: _segments(_written_out(batches), n_rows, n_chars), _segment_type(kinds["conv_id"], kinds["turn"]),
                     lambda segment: sum(map(len, segment["texts"])))


def _segment_order() -> list[Column]:
    return [*_row_order(), F.col("at")]


def _by_conversation(frame: DataFrame) -> DataFrame:
    """Segments of a conversation in one task, in order, as a stream."""
    return frame.repartition("conv_id").sortWithinPartitions(*_segment_order())


def advance(best: dict[int, tuple[int, int]], ways: dict[tuple[int, int], tuple[int, int]]) -> tuple[dict, list[int]]:
    """One segment further: state -> (least cost, rank among the states' audits) and, for each state, the one before.

    ways: (entry, exit) -> (cost, rank).  One integer a way: cost, then the rank of the way up to the segment, then
    the rank inside it."""
    least: dict[int, tuple[int, int]] = {}
    for (entry, to), (cost, place) in ways.items():
        if entry in best:
            total, rank = best[entry]
            weight = (total + cost) << 4 | rank << 2 | place
            if to not in least or weight < least[to][0]:
                least[to] = weight, entry
    ranks = sorted((weight & 15, to) for to, (weight, _) in least.items())
    return ({to: (least[to][0] >> 4, rank) for rank, (_, to) in enumerate(ranks)},
            [least[to][1] if to in least else -1 for to in STATES])


def ended(best: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """Least cost with what completes the conversation, and the state its rows end in."""
    ends = {state: (total + INSERT * len(ENDING[state]), rank) for state, (total, rank) in best.items()}
    state = min(ends, key=ends.get)
    return ends[state][0], state


KEY = ("conv_id", "turn", "role", "start", "digest", "at")


def _forward(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Segments in order -> key, state before for each state after; on the last the cost and the state that rows end in."""
    for _, group in groupby((row for batch in batches for row in batch.to_pylist()), key=lambda r: r["conv_id"]):
        best, held = {START: (0, 0)}, None
        for r in group:
            if held:
                crossing = held.pop("last_role")[:1] + r["first_role"][:1] not in ("su", "ua", "au")
                yield held | {"last": False, "state": -1, "total": 0, "crossing": int(crossing)}
            ways = {(e, x): (c, p) for e, x, c, p in zip(r["entry"], r["exit"], r["cost"], r["place"])}
            best, before = advance(best, ways)
            held = {c: r[c] for c in KEY} | {"before": before, "last_role": r["last_role"]}
        total, state = ended(best)
        del held["last_role"]
        yield held | {"last": True, "state": state, "total": total, "crossing": 0}


def _backward(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The same in reverse order -> the states each segment is entered and left in."""
    state = START
    for row in (row for batch in batches for row in batch.to_pylist()):
        state = row["state"] if row["last"] else state
        before = row.pop("before")[state]
        yield row | {"state": state, "entered": before}
        state = before


def _decided(compact: DataFrame) -> DataFrame:
    """Segment keys with ``entered`` and ``state`` (left in), ``last``, ``total`` (the cost, on the last) and ``crossing``."""
    kinds = dict(compact.dtypes)
    known = (f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, start string, digest string, at bigint, "
             "last boolean, state int, total bigint, crossing bigint")
    there = _streamed(_by_conversation(compact), _forward, known + ", before array<int>")
    back = there.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").desc(), F.col("turn").desc_nulls_last(), *(F.col(c).desc() for c in KEY[2:]))
    return _streamed(back, _backward, known + ", entered int")


def _streamed(frame: DataFrame, step, ddl: str, size=lambda row: 64) -> DataFrame:
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return frame.mapInArrow(lambda batches: _batches(step(batches), schema, size), ddl)


def repair(rows: DataFrame, n_rows: int = SEGMENT_ROWS, n_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) -> a row a conversation: conv_id, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256.  Conversations without rows are not in the result."""
    cut = materialize(segments(ordered_rows(rows), n_rows, n_chars), "repair_segments")
    decided = materialize(_decided(cut.select(*KEY, "first_role", "last_role", "entry", "exit", "cost", "place")), "repair_decided")
    s, d = cut.alias("s"), decided.alias("d")
    both = s.join(d, F.expr(" AND ".join(f"s.{c} <=> d.{c}" for c in KEY)))
    way = F.array_position(F.zip_with("entry", "exit", lambda entry, to: entry * 4 + to), F.col("entered") * 4 + F.col("state"))
    chosen = both.select(*(f"s.{c}" for c in KEY), "roles", "texts", "blank", "duplicate", "truncated", "entered", "state", "last",
                         "total", (F.col("illegal") + F.col("crossing")).alias("illegal"),
                         F.element_at("audit", way.cast("int")).alias("audit"))
    conv = dict(rows.dtypes)["conv_id"]
    ddl = (f"conv_id {conv}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
    counts = ("blank", "duplicate", "truncated", "illegal")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        parts = (row for batch in batches for at in range(0, batch.num_rows, 64) for row in batch.slice(at, 64).to_pylist())
        for conv_id, group in groupby(parts, key=lambda r: r["conv_id"]):
            digest, audit, sums, before, cost = hashlib.sha256(), [], dict.fromkeys(counts, 0), False, 0
            for r in group:
                ending = ENDING[r["state"]] if r["last"] else ""
                audit.append(r["audit"] + ending)
                cost += r["total"]
                for c in counts:
                    sums[c] += r[c]
                for line in render(zip(r["roles"], r["texts"]), r["audit"] + ending, r["entered"]):
                    digest.update((b"\n" if before else b"") + line.encode("utf-8", "surrogatepass"))
                    before = True
            yield {"conv_id": conv_id, **sums, "cost": cost, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    return _streamed(_by_conversation(chosen), finish, ddl, lambda row: len(row["audit"]))


def repair_damaged(conversations: DataFrame, n_rows: int = SEGMENT_ROWS, n_chars: int = SEGMENT_CHARS) -> DataFrame:
    """The repair of every conversation of the table after damage, those without rows left included, with their gaps."""
    left = damage(conversations.select("conv_id", "turn", "role", "text"))
    every = materialize(conversations.select("conv_id").distinct(), "repair_ids")
    turns = left.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    result = materialize(repair(left, n_rows, n_chars), "repair_result")
    out = every.alias("e")
    for name, side in (("g", materialize(gaps, "repair_gaps")), ("r", result)):
        out = out.join(side.alias(name), F.col("e.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select("e.conv_id", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))
